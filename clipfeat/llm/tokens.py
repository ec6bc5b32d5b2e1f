"""Token-ID output: whole texts to ids, ids to wavelet-matrix shards, and reading them back.

Documents are dealt out by ranges of doc_id and sorted within each; a task encodes its range and writes shards of
bounded size, each one compressed file. Offsets come from the shards' sizes, one row per shard.

Cases: a null or empty text is its end id alone; a null doc_id comes first; repeated doc_ids are ordered by text;
an empty table writes no shard and gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import ctypes
import itertools
import os
import string
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .shared import new_dir, read_file, staged, table, write_file
from .wavelet import pack, unpack

END = 0

#: White space that may be a token together with what follows it: such a text is encoded whole. Elsewhere each run of white
#: space is a single character, two line feeds before a word, or a line feed and a word's space.
_OTHER = r"\t\x0b\x0c\r\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
_UNSURE = rf"[ {_OTHER}][ \n{_OTHER}]|\n[{_OTHER}]|\n[ \n{_OTHER}][ \n{_OTHER}]|\n[ \n{_OTHER}]\z|<\||\x00"
_MARKS = string.punctuation
#: Byte-level models write a visible byte of Latin-1 as that character and the others as those from 256 on.
_VISIBLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
_LETTERS = {b: b for b in _VISIBLE} | {b: 256 + n for n, b in enumerate(b for b in range(256) if b not in _VISIBLE)}
_SPACE = chr(_LETTERS[32])


class Encoder:
    """Byte-level BPE by the tokenizers library.

    The pre-tokenizer always parts a text before a single space that a word follows and around a single line feed, so a text
    is cut there and each piece is encoded once for as long as it is remembered. Arrow cuts a batch and numbers its distinct
    pieces; only those are looked up, and NumPy puts the ids together. Texts with other white space after white space, or with
    the look of a special token, are encoded whole. The memory of pieces is bounded."""

    def __init__(self, path: str, limit: int = 400_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, decoders

        self.tokenizer, self.limit = Tokenizer.from_file(path), limit
        #: A piece that the pre-tokenizer leaves whole goes straight to the model, its bytes written as the model's letters.
        self.direct = self.tokenizer.model.tokenize if isinstance(self.tokenizer.decoder, decoders.ByteLevel) else None
        self.known: dict[str, int] = {}
        self.size = 0
        self.starts, self.lens, self.seen, self.flat = np.zeros(1024, np.int64), np.zeros(1024, np.int64), np.zeros(1024, np.int64), np.zeros(4096, "<u4")

    def _forget(self) -> None:
        """Keep the half that most batches had; what comes once, mostly the larger part, goes."""
        kept = np.sort(np.argsort(-self.seen[: len(self.known)], kind="stable")[: self.limit // 2])
        names, lens, seen = list(self.known), self.lens[kept], self.seen[kept] // 2
        ends = np.cumsum(lens)
        self.size = int(ends[-1]) if len(ends) else 0
        self.flat[: self.size] = self.flat[np.repeat(self.starts[kept] - (ends - lens), lens) + np.arange(self.size)]
        self.known = {names[k]: i for i, k in enumerate(kept.tolist())}
        self.starts[: len(kept)], self.lens[: len(kept)], self.seen[: len(kept)] = ends - lens, lens, seen

    def _whole(self, piece: str) -> list[int]:
        """The ids of a piece that is one token to the pre-tokenizer."""
        if piece.isascii():
            text = _SPACE + piece[1:] if piece[0] == " " else piece
        else:
            text = piece.encode().decode("latin-1").translate(_LETTERS)
        return [t.id for t in self.direct(text)]

    def _learn(self, pieces: list[str]) -> None:
        """Encode pieces that are not known. Letters, digits and the marks after them are tokens apart to the pre-tokenizer."""
        found, rest, parts = {}, [], {"": []}
        for p in pieces:
            core = p.rstrip(_MARKS)
            bare = core[core[:1] == " " :]
            if self.direct and (bare.isalpha() or bare.isdecimal()):
                tail = p[len(core) :]
                for x in (core, tail):
                    if x not in parts:
                        parts[x] = self._whole(x)
                found[p] = parts[core] + parts[tail]
            else:
                rest.append(p)
        for k in range(0, len(rest), 2_000):
            part = rest[k : k + 2_000]
            got = self.tokenizer.encode(part, is_pretokenized=True, add_special_tokens=False)
            ends = np.cumsum(np.bincount(np.array(got.word_ids, np.int64), minlength=len(part))).tolist()
            found.update((p, got.ids[a:b]) for p, a, b in zip(part, [0, *ends], ends, strict=False))
        lens = np.fromiter(map(len, found.values()), np.int64, len(found))
        first, used = len(self.known), self.size + int(lens.sum())
        self.known.update(zip(found, range(first, first + len(found)), strict=True))
        if len(self.known) > len(self.starts):
            more = np.zeros(len(self.known), np.int64)
            self.starts, self.lens, self.seen = (np.concatenate([x, more]) for x in (self.starts, self.lens, self.seen))
        if used > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros(used, "<u4")])
        self.flat[self.size : used] = np.fromiter(itertools.chain.from_iterable(found.values()), "<u4", used - self.size)
        self.lens[first : len(self.known)] = lens
        self.seen[first : len(self.known)] = 0
        self.starts[first : len(self.known)] = self.size + np.cumsum(lens) - lens
        self.size = used

    def _pieces(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of texts that may be cut."""
        cut = pc.split_pattern(pc.replace_substring(pc.replace_substring(texts, " ", "\0 "), "\n", "\0\n\0"), "\0")
        pieces = cut.flatten().dictionary_encode()
        if len(self.known) > self.limit:
            self._forget()
        names = pieces.dictionary.to_numpy(zero_copy_only=False).tolist()
        if fresh := [p for p in names if p not in self.known]:
            self._learn(fresh)
        place = np.fromiter(map(self.known.__getitem__, names), np.int64, len(names))
        self.seen[place] += 1
        place = place[pieces.indices.to_numpy()]
        lens = self.lens[place]
        ends = np.cumsum(lens)
        ids = self.flat[np.repeat(self.starts[place] - (ends - lens), lens) + np.arange(ends[-1] if len(ends) else 0)]
        of_text = np.concatenate([np.zeros(1, np.int64), ends])[np.asarray(cut.offsets) - cut.offsets[0].as_py()].tolist()
        return [ids[a:b] for a, b in itertools.pairwise(of_text)]

    def encode(self, texts: pa.Array, at_once: int = 2_000_000) -> Iterator[np.ndarray]:
        """The ids of each whole text, some MB of text at a time."""
        ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
        first = 0
        while first < len(texts):
            last = max(first + 1, int(np.searchsorted(ends, (ends[first - 1] if first else 0) + at_once, "right")))
            part = texts.slice(first, last - first)
            unsure = pc.match_substring_regex(part, _UNSURE)
            sure = iter(self._pieces(part.filter(pc.invert(unsure))))
            for i, whole in enumerate(unsure.to_pylist()):
                yield np.array(self.tokenizer.encode(part[i].as_py(), add_special_tokens=False).ids, "<u4") if whole else next(sure)
            first = last


def give_back() -> None:
    """Return memory that is free to the system, where the C library keeps it: a worker lives on for many tasks."""
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)
    pa.default_memory_pool().release_unused()


@lru_cache(maxsize=1)
def _encoder(path: str) -> Encoder:
    """One for each Python worker, which Spark uses for many tasks: the pieces it remembers stay."""
    return Encoder(path)


MANIFEST = pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("path", pa.string()), ("n_docs", pa.int64()), ("n_tokens", pa.int64())])


def write_shards(docs: DataFrame, tokenizer: str, path: str, shard_tokens: int = 4_000_000) -> DataFrame:
    """Write all documents below ``path`` in ascending doc_id; returns the manifest (part, seq, path, n_docs, n_tokens)."""

    def run(batches):
        encoder, part = _encoder(tokenizer), TaskContext.get().partitionId()
        seq, ids, names, lens, n = 0, [], [], [], 0

        def flush():
            nonlocal seq, ids, names, lens, n
            doc = np.array([0 if x is None else x for x in names], "<i8")
            arrays = {"doc_id": doc, "null": np.array([x is None for x in names], "u1"), "n_tokens": np.array(lens, "<i8")}
            name = f"{path}/{part:06d}-{seq:04d}-{uuid.uuid4().hex[:12]}.wvm"
            write_file(name, pack(np.concatenate(ids), {"tokenizer": os.path.basename(tokenizer), "end": END}, arrays))
            row = pa.RecordBatch.from_pydict({"part": [part], "seq": [seq], "path": [name], "n_docs": [len(names)], "n_tokens": [n]}, MANIFEST)
            seq, ids, names, lens, n = seq + 1, [], [], [], 0
            give_back()
            return row

        end = np.array([END], "<u4")
        for batch in batches:
            for doc_id, x in zip(batch.column("doc_id").to_pylist(), encoder.encode(batch.column("text")), strict=True):
                ids += [x, end]
                names.append(doc_id)
                lens.append(len(x) + 1)
                n += len(x) + 1
                if n >= shard_tokens:
                    yield flush()
        if names:
            yield flush()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return staged(rows.mapInArrow(run, "part int, seq int, path string, n_docs long, n_tokens long"), "token-manifest")


def read_shards(manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, decoded from the files."""
    before = W.orderBy("part", "seq").rowsBetween(W.unboundedPreceding, -1)
    offsets = manifest.withColumn("offset", F.coalesce(F.sum("n_tokens").over(before), F.lit(0))).select("path", "offset")

    def run(batches):
        for pdf in batches:
            for path, offset in zip(pdf["path"], pdf["offset"], strict=True):
                matrix, _, arrays = unpack(read_file(path))
                ids, lens = matrix.decode().astype("<u4"), arrays["n_tokens"]
                ends = np.cumsum(lens)
                starts = ends - lens
                crc = [zlib.crc32(ids[a:b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                doc = pd.Series(arrays["doc_id"]).astype("Int64").mask(arrays["null"].astype(bool))
                yield pd.DataFrame({"doc_id": doc, "start": offset + starts, "n_tokens": lens, "ids_crc32": crc})

    spread = offsets.repartition(max(1, 4 * manifest.sparkSession.sparkContext.defaultParallelism), "path")
    return spread.mapInPandas(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def token_output(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    return read_shards(write_shards(docs, tokenizer or default_tokenizer(), new_dir(docs.sparkSession, "tokens")))


def op9_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One shuffle by ranges of doc_id; texts are encoded and stored behind it."""
    return token_output(table(spark, sf_dir, "documents"))
