import hashlib
import zlib
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from clipfeat.llm import trie

from ..oracle import rows_of, sql_rows

SCHEMA = "conv_id long, turn long, role string, text string, rep long, key string, depth int, class long, part int, copies int, ends string"


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, "k", 2, 3, 4, 5, "e") for r in rows], SCHEMA)


def brute(rows, block=100, most=6):
    own = defaultdict(list)
    for c, turn, role, text in sorted(((c, (t is not None, t or 0), r or "", x or "") for c, t, r, x in rows if c is not None)):
        own[c].append((role, text))
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % most
        built[c] = tuple([*own.get(c - (abs(c) % block if c >= 0 else -(abs(c) % block)), [])[:h], *turns[h:]])
    nodes = defaultdict(list)
    for c, seq in built.items():
        for d in range(len(seq) + 1):
            nodes[seq[:d]].append(c)
    children = defaultdict(int)
    for p in nodes:
        if p:
            children[p[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for p, members in nodes.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += children[p] == 0
            saved[p[:d]] += (len(members) - 1) * len(p[-1][1]) if p else 0
    out = []
    for p, members in nodes.items():
        ends = ",".join(str(c) for c in sorted(members) if len(built[c]) == len(p))
        out.append((min(members), len(p), min(nodes[p[:-1]]) if p else None, len(members), children[p], leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def got(df):
    return sorted(map(tuple, df.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256").collect()), key=repr)


CASES = {
    "nothing": [],
    "one": [(5, 0, "user", "hi")],
    "no_turns_left": [(103, 0, "user", "hi"), (207, 0, "user", "a"), (207, 1, None, None)],
    "nulls_and_ties": [(0, None, "a", "x"), (0, None, None, "x"), (0, 1, "a", None), (0, 1, "a", None), (None, 0, "user", "lost"), (1, 2, "b", "é😀"), (1, 1, "", ""), (-150, 0, "u", "m"), (-150, 1, "u", "m"), (-101, 0, "u", "m"), (-100, 3, "u", "z")],
    "copies": [(c, t, "user", f"text {t}") for c in range(1000, 1230) for t in range(12)],
    "borders_of_role_and_text": [(600 + k, t, r, x) for k in range(12) for t, (r, x) in enumerate([("ab", "c"), ("a", "bc")] * 4 if k % 2 else [("a", "bc"), ("ab", "c")] * 4)],
    "long": [(c, t, "user", f"{t}" if t < 9 or c < 400 else f"{c} {t}") for c in (300, 301, 302, 477, 478) for t in range(120)],
}


@pytest.mark.parametrize("name", sorted(CASES))
def test_cases(spark, name):
    assert got(trie.prefix_trie(table(spark, CASES[name]), chain_block=50)) == brute(CASES[name])


@settings(max_examples=4, deadline=None)
@given(st.lists(st.tuples(st.sampled_from([0, 1, 2, 7, 100, 101, 105, 2**62 + 1, None]), st.sampled_from([None, 0, 1, 2, 3]), st.sampled_from(["u", None]), st.sampled_from(["x", "yy", None])), max_size=40))
def test_any(spark, rows):
    assert got(trie.prefix_trie(table(spark, rows))) == brute(rows)


def test_one_text_of_a_megabyte(spark):
    rows = [(c, 0, "user", "x" * 1_000_000) for c in (0, 1, 2)]
    assert got(trie.prefix_trie(table(spark, rows), most=1)) == brute(rows, most=1)


def test_op12(spark, sf_dir):
    assert rows_of(trie.op12_trie(spark, sf_dir).toPandas()) == sql_rows(trie.SQL, sf_dir)
