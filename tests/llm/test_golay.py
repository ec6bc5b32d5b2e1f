import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from clipfeat.llm import golay


def test_nearest_are_codewords_within_four():
    rng = np.random.default_rng(0)
    words = rng.integers(0, 1 << 24, 500)
    checks, _ = golay._tables()
    near = golay.nearest(words)
    for w, row in zip(words.tolist(), near.tolist(), strict=True):
        kept = [m for m in row if m >= 0]
        gaps = [(w ^ (m << 12 | int(checks[m]))).bit_count() for m in kept]
        assert len(set(gaps)) == 1 and (len(kept) == 1 and gaps[0] <= 3 or len(kept) == 6 and gaps[0] == 4)


def test_code_has_distance_eight():
    checks, _ = golay._tables()
    assert min((m << 12 | int(checks[m])).bit_count() for m in range(1, 4096)) == 8


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 2**64 - 1), st.lists(st.integers(0, 63), max_size=3))
def test_within_three_bits_share_a_key(x, flips):
    y = x
    for f in flips:
        y ^= 1 << f
    a, b = (set(golay.keys_within_three(np.array([v], np.uint64).view(np.int64))[1].tolist()) for v in (x, y))
    assert a & b
