import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from clipfeat.llm import tokens, wavelet
from clipfeat.llm.shared import new_dir

from .edge import documents, empty

WHOLE = Tokenizer.from_file(tokens.default_tokenizer())
ENCODER = tokens.Encoder(tokens.default_tokenizer())


def ids(text):
    return WHOLE.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=500, deadline=None)
@given(st.lists(st.one_of(st.text("ab .,\n\t'sé1²", max_size=12), st.text(max_size=6), st.sampled_from([" don't", " end.", "...", "  ", " \n", "<|endoftext|>", "\0", " １", " ª.", "\xa0x", "\x1c", " ’s", "\n\n", "\n ", "\n\n\n", "\n\t", "\t\n", " %%%", "w$$$", "1.5,", "it'!", "\u3000", "\x85\n"])), max_size=12).map("".join))
def test_pieces_give_the_ids_of_whole_texts(text):
    assert next(ENCODER.encode(pa.array([text]))).tolist() == ids(text)


def test_the_memory_of_pieces_is_bounded():
    e = tokens.Encoder(tokens.default_tokenizer(), limit=50)
    texts = [" ".join(f"w{i}x{j}" for j in range(40)) for i in range(600)]
    assert [x.tolist() for x in e.encode(pa.array(texts))] == [ids(t) for t in texts]
    assert [x.tolist() for x in e.encode(pa.array(texts), 5_000)] == [ids(t) for t in texts]
    assert len(e.known) < 2_500 and e.size < 20_000


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 70_000), max_size=700), st.integers(0, 70_000))
def test_wavelet_matrix(values, other):
    a = np.array(values, np.int64)
    m, meta, arrays = wavelet.unpack(wavelet.pack(a, {"k": 1}, {"z": np.arange(3)}))
    assert m.decode().tolist() == values and meta == {"k": 1} and arrays["z"].tolist() == [0, 1, 2]
    for i in range(0, len(values), 97):
        assert m.access(i) == values[i]
        assert m.rank(values[i], i) == values[:i].count(values[i])
        assert m.select(values[i], values[:i].count(values[i])) == i
    assert m.rank(other, len(values)) == values.count(other) and m.select(other, values.count(other)) == -1


def expected(rows):
    out, start = [], 0
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        x = np.array([*ids(t), 0], "<u4")
        out.append((i, start, len(x), zlib.crc32(x.tobytes())))
        start += len(x)
    return out


@pytest.mark.parametrize("make", [documents, empty])
def test_edge_cases(spark, make):
    docs = make(spark)
    manifest = tokens.write_shards(docs, tokens.default_tokenizer(), new_dir(spark, "t"), shard_tokens=3000)
    got = sorted((tuple(r) for r in tokens.read_shards(manifest).collect()), key=lambda r: r[1])
    assert got == expected([(r.doc_id, r.text) for r in docs.collect()])
    assert manifest.count() > 1 if make is documents else manifest.count() == 0


def test_op9(spark, sf_dir):
    got = sorted(tuple(r) for r in tokens.op9_tokens(spark, sf_dir).collect())
    assert got == expected([(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()])
