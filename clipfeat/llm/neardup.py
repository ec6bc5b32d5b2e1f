"""SimHash near-duplicates by Golay-code fuzzy hashing.

``fingerprints`` gives 64-bit SimHashes of word shingles; ``fingerprint_classes`` links fingerprints within three bits,
``near_duplicates`` links texts whose sets of five-word shingles have a similarity of 0.8 or more. Both cut the
fingerprints into segments, use the codewords near each segment as keys, and verify the pairs that share a key.

Cases: a null text is empty; empty texts have fingerprint 0 and are linked like any other; repeated rows and ties fall
into one class; a null doc_id is never the smallest of a class and its row is kept by the filter; an empty table gives
no rows; extra columns are ignored, or carried along by the filter.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .components import linked, linked_throughout, merged
from .golay import keys_of_pairs, keys_within_three
from .shared import map_frames, staged, table
from .words import mix, shingle_hashes, word_lists

SEED = 42


def shingle_xxh64(words: list[bytes], size: int) -> np.ndarray:
    """XXH64 of each shingle of ``size`` words joined by spaces; of the whole sequence where it is shorter."""
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    lens = np.fromiter(map(len, words), np.int64, n)
    ends = np.cumsum(lens + 1) - 1
    starts = (ends - lens).tolist()
    size = min(size, n)
    h = xxhash.xxh64_intdigest
    return np.fromiter((h(joined[a:b], SEED) for a, b in zip(starts, ends[size - 1 :].tolist(), strict=False)), np.uint64, n - size + 1)


def majority(h: np.ndarray) -> int:
    """The fingerprint of hashes: a bit is set if it is set in more than half of them. As a signed 64-bit number."""
    if not len(h):
        return 0
    votes = np.zeros(64, np.int64)
    for at in range(0, len(h), 65536):
        votes += np.unpackbits(h[at : at + 65536].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(votes * 2 > len(h), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, size: int = 3) -> DataFrame:
    """(doc_id, fp) of every whole text."""

    def run(batches):
        for pdf in batches:
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "fp": [majority(shingle_xxh64(w, size)) for w in word_lists(pdf["text"])]})

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_frames(docs.select("doc_id", "text"), run, f"doc_id {kind}, fp long")


def _keyed(rows: DataFrame, column: str, keys) -> DataFrame:
    """(key, id): the keys of each value of ``column``, made for a few thousand rows at a time."""

    def run(batches):
        for pdf in batches:
            values = pdf[column].to_numpy(np.int64)
            for at in range(0, len(values), 4000):
                part = values[at : at + 4000]
                places, k = keys(part)
                yield pd.DataFrame({"key": k, "id": part[places]})

    return rows.select(column).mapInPandas(run, "key long, id long")


def fingerprint_classes(rows: DataFrame) -> DataFrame:
    """``rows`` (doc_id, fp) with component_id: the smallest doc_id that links of three bits or fewer reach."""
    rows = staged(rows, "fingerprints")
    distinct = staged(rows.groupBy("fp").agg(F.min("doc_id").alias("smallest")), "distinct-fingerprints")
    close = lambda a, b: F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= 3
    comp = linked(_keyed(distinct, "fp", keys_within_three), close("id_a", "id_b"), lambda pairs: pairs.filter(close("a", "b")))
    comp = merged(distinct).join(merged(comp), F.col("fp") == F.col("id"), "left").select("fp", "smallest", F.coalesce("comp", "fp").alias("comp"))
    named = comp.groupBy("comp").agg(F.min("smallest").alias("component_id"))
    classes = merged(comp.select("fp", "comp")).join(merged(named), "comp").select("fp", "component_id")
    return merged(rows).join(merged(classes), "fp")


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints in one narrow pass; only distinct fingerprints are keyed and compared."""
    rows = fingerprint_classes(fingerprints(table(spark, sf_dir, "documents")))
    return rows.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


# ---------------------------------------------------------------- texts


def signatures(docs: DataFrame, prints: int = 4) -> DataFrame:
    """(id, n, fp0, fp1, ...): for each distinct text its smallest doc_id, its number of distinct five-word shingles, and
    several SimHashes of its distinct three-word shingles: like the similarity that decides, they don't see how often a
    passage comes in a text. Only these small rows are shuffled, not the texts."""

    def run(batches):
        for pdf in batches:
            out = []
            for w in word_lists(pdf["text"]):
                h = np.unique(shingle_hashes(w, 3))
                fps = [majority(mix(h ^ np.uint64(0x9E3779B97F4A7C15 * (k + 1) & (1 << 64) - 1))) for k in range(prints)]
                out.append((len(np.unique(shingle_hashes(w, 5))), *fps))
            yield pd.concat([pdf[["doc_id", "text_key"]].reset_index(drop=True), pd.DataFrame(out, columns=["n", *names])], axis=1)

    names = [f"fp{k}" for k in range(prints)]
    rows = docs.filter("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.md5(F.coalesce("text", F.lit(""))).alias("text_key"))
    rows = map_frames(rows, run, "doc_id long, text_key string, n long, " + ", ".join(f"{c} long" for c in names))
    return rows.groupBy("text_key").agg(F.min(F.struct(F.col("doc_id").alias("id"), "n", *names)).alias("s")).select("text_key", "s.*")


def text_keys(sigs: DataFrame, prints: int = 4) -> DataFrame:
    """(key, id, fp): pairs of codewords of each fingerprint, together with a band of the text's size. Texts of a similarity of
    0.8 or more differ in size by a quarter at most, so a text near the edge of a band is in both bands."""

    def run(batches):
        for pdf in batches:
            for at in range(0, len(pdf), 4000):
                part = pdf.iloc[at : at + 4000]
                ids, n = part["id"].to_numpy(np.int64), np.maximum(part["n"].to_numpy(np.float64), 1)
                low = np.floor(np.log2(n)).astype(np.int64)
                high = np.floor(np.log2(n * 1.25 + 1e-6)).astype(np.int64)
                for k in range(prints):
                    fp = part[f"fp{k}"].to_numpy(np.int64)
                    places, keys = keys_of_pairs(fp)
                    keys = keys | k << 26
                    both = high[places] > low[places]
                    key = np.concatenate([keys | low[places] << 30, keys[both] | high[places][both] << 30])
                    places = np.concatenate([places, places[both]])
                    yield pd.DataFrame({"key": key, "id": ids[places], "fp": fp[places]})

    return sigs.mapInPandas(run, "key long, id long, fp long")


#: Places of the table of common shingles, a byte each, and how many of them make a block.
PLACES, BLOCK = 1 << 22, 1 << 12


def common_shingles(sets: DataFrame, read=iter) -> np.ndarray:
    """For each place (a shingle's lowest bits) about the logarithm of how many sets hold its most common shingle; 0 where none is
    seen twice in some texts of a task. Of a fixed size; it only orders shingles, so its errors cost time and no result."""

    def repeated(parts):
        held = np.sort(np.concatenate([np.zeros(0, np.int64), *parts]))
        starts = np.flatnonzero(np.diff(held, prepend=held[:1] - 1))
        n = np.diff(starts, append=len(held))
        return pd.DataFrame({"s": held[starts[n > 1]], "n": n[n > 1]})

    def counted(batches):
        parts, size = [], 0
        for pdf in read(batches):
            parts += [np.asarray(s, np.int64) for s in pdf["shingles"]]
            size += sum(map(len, pdf["shingles"]))
            if size > 2_000_000:
                yield repeated(parts)
                parts, size = [], 0
        yield repeated(parts)

    def packed(key, pdf):
        block = np.zeros(BLOCK, np.uint8)
        block[pdf["place"].to_numpy(np.int64) % BLOCK] = np.log2(pdf["n"].to_numpy(np.float64)) + 1
        return pd.DataFrame({"block": [key[0]], "levels": [block.tobytes()]})

    rows = sets.mapInPandas(counted, "s long, n long").groupBy("s").agg(F.sum("n").alias("n"))
    rows = rows.groupBy(F.col("s").bitwiseAND(F.lit(PLACES - 1)).alias("place")).agg(F.max("n").alias("n"))
    rows = rows.withColumn("block", F.floor(F.col("place") / BLOCK).cast("long")).groupBy("block").applyInPandas(packed, "block long, levels binary")
    table = np.zeros((PLACES // BLOCK, BLOCK), np.uint8)
    for r in rows.toLocalIterator():
        table[r.block] = np.frombuffer(bytes(r.levels), np.uint8)
    return table.reshape(-1)


def prefix_pairs(sets: DataFrame, members: DataFrame, similarity: float, read=iter) -> DataFrame:
    """(a, b): all pairs of (id, shingles) of different comp in ``members`` that can have the similarity; none that has it is lost.

    With each set in one order, that of the levels of ``common_shingles`` and then of the hashes, two sets that are similar share
    a shingle among the first few of each (a set of n can miss a fifth of its shingles at most), and at the first one that they
    share there must be enough left in both. So what is common to many sets, which comes late, makes no pairs by itself. Only
    those first few are shuffled, once, and most of them are held by one set. ``read`` makes batches of (id, shingles) of those of
    ``sets``, in the same worker."""
    levels = common_shingles(sets, read)

    def prefixes(batches):
        for pdf in read(batches):
            for at in range(0, len(pdf), 500):
                part, out = pdf.iloc[at : at + 500], []
                for i, s in zip(part["id"], part["shingles"], strict=True):
                    s = np.asarray(s, np.int64)
                    first = s[np.lexsort((s, levels[s & (PLACES - 1)]))][: len(s) - int(np.ceil(similarity * len(s) - 1e-9)) + 1]
                    out.append((np.full(len(first), i, np.int64), np.full(len(first), len(s), np.int32), np.arange(1, len(first) + 1, dtype=np.int32), first))
                yield pd.DataFrame(dict(zip(("id", "n", "at", "s"), map(np.concatenate, zip(*out, strict=True)), strict=True)))

    def shared(rows: DataFrame, column: str) -> DataFrame:
        whole = W.partitionBy("s")
        return rows.withColumn("low", F.min(column).over(whole)).withColumn("high", F.max(column).over(whole)).filter("low < high").drop("low", "high")

    rows = shared(sets.mapInPandas(prefixes, "id long, n int, at int, s long"), "id")
    rows = staged(shared(staged(rows, "shared-shingles").join(members, "id"), "comp"), "prefixes")
    x, y = (rows.select("s", *[F.col(c).alias(f"{c}_{k}") for c in ("id", "comp", "n", "at")]) for k in "ab")
    left = 1 + F.least(F.col("n_a") - F.col("at_a"), F.col("n_b") - F.col("at_b"))
    enough = left * (1 + similarity) >= similarity * (F.col("n_a") + F.col("n_b")) - 1e-9
    return x.join(y, "s").filter((F.col("comp_a") < F.col("comp_b")) & enough).select(F.col("id_a").alias("a"), F.col("id_b").alias("b")).distinct()


def near_duplicates(docs: DataFrame, similarity: float = 0.8, prints: int = 4) -> DataFrame:
    """(text_key, id, component_id, stands): one row per distinct text; the class is named by its smallest doc_id, and ``stands`` marks
    its one text of that doc_id (of several, that of the smallest MD5).

    A doc_id that stands for several texts names each of them: then texts get numbers of their own and are compared under these."""
    sigs = staged(signatures(docs, prints), "signatures")
    if sigs.groupBy("id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").isEmpty():
        return _text_classes(docs, sigs, similarity, prints).withColumn("stands", F.col("id") == F.col("component_id"))
    nodes = staged(sigs.select("text_key", "id", F.monotonically_increasing_id().alias("node")), "text-numbers")
    keyed = docs.filter("doc_id is not null").select("text", F.md5(F.coalesce("text", F.lit(""))).alias("text_key"))
    numbered = staged(keyed.join(nodes, "text_key").select(F.col("node").alias("doc_id"), "text"), "numbered-texts")
    sigs = staged(sigs.drop("id").join(nodes.select("text_key", F.col("node").alias("id")), "text_key").select(sigs.columns), "numbered-signatures")
    comp = _text_classes(numbered, sigs, similarity, prints).select("text_key", F.col("component_id").alias("comp")).join(nodes.drop("node"), "text_key")
    first = comp.groupBy("comp").agg(F.min(F.struct("id", "text_key")).alias("first"))
    return comp.join(first, "comp").select("text_key", "id", F.col("first.id").alias("component_id"), (F.col("text_key") == F.col("first.text_key")).alias("stands"))


def _text_classes(docs: DataFrame, sigs: DataFrame, similarity: float, prints: int) -> DataFrame:
    """(text_key, id, component_id) from ``signatures`` in which each id names one text.

    First, texts that share two codewords of a fingerprint and differ in few bits of all fingerprints are held against one
    another; that leaves less to the second step, which finds every other link by the rarest shingles of all texts. In both
    the exact similarity of the sets of five-word shingles decides."""
    texts = docs.filter("doc_id is not null").select(F.col("doc_id").cast("long").alias("id"), "text")

    def shingled(batches):
        for pdf in batches:
            for at in range(0, len(pdf), 500):
                part = pdf.iloc[at : at + 500]
                yield pd.DataFrame({"id": part["id"], "shingles": [np.unique(shingle_hashes(w, 5)).view(np.int64) for w in word_lists(part["text"])]})

    def once(batches):  # most copies of a text go here, the smallest doc_id of all stays
        for pdf in batches:
            yield from shingled([pdf.sort_values("id").drop_duplicates("text")])

    def sets_of(ids: DataFrame) -> DataFrame:
        return staged(texts.join(ids, "id", "left_semi").dropDuplicates(["id"]).mapInPandas(shingled, "id long, shingles array<long>"), "shingles")

    def exact(pairs: DataFrame, sets: DataFrame) -> DataFrame:
        x, y = sets.select(F.col("id").alias("a"), F.col("shingles").alias("sa")), sets.select(F.col("id").alias("b"), F.col("shingles").alias("sb"))
        both = pairs.join(x, "a").join(y, "b").withColumn("common", F.size(F.array_intersect("sa", "sb")))
        return both.filter(F.col("common") >= similarity * (F.size("sa") + F.size("sb") - F.col("common"))).select("a", "b")

    def verify(pairs: DataFrame) -> DataFrame:
        sig = sigs.drop("text_key")
        a, b = (sig.select(*[F.col(c).alias(f"{c}_{s}") for c in sig.columns]) for s in "ab")
        bits = sum(F.bit_count(F.col(f"fp{k}_a").bitwiseXOR(F.col(f"fp{k}_b"))) for k in range(prints))
        sizes = F.least("n_a", "n_b") >= similarity * F.greatest("n_a", "n_b")
        likely = pairs.join(a, pairs["a"] == a["id_a"]).join(b, F.col("b") == b["id_b"]).filter(sizes & (bits <= 18 * prints)).select("a", "b")
        likely = staged(likely, "likely-pairs")
        return exact(likely, sets_of(likely.select(F.col("a").alias("id")).union(likely.select("b")).distinct()))

    def thorough(members: DataFrame) -> DataFrame:
        pairs = staged(prefix_pairs(texts, members, similarity, once), "prefix-pairs")
        return exact(pairs, sets_of(pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()))

    near = F.bit_count(F.col("fp_a").bitwiseXOR(F.col("fp_b"))) <= 16
    comp = linked_throughout(sigs.select("id"), text_keys(sigs, prints), near, verify, thorough)
    return sigs.join(comp, "id", "left").select("text_key", "id", F.coalesce("comp", "id").alias("component_id"))


def one_of_each(docs: DataFrame, similarity: float = 0.8) -> DataFrame:
    """The rows of ``docs`` with the smallest doc_id of their class, one row each; all columns stay. Rows without a doc_id stay."""
    classes = near_duplicates(docs, similarity)
    keep = classes.filter("stands").select(F.col("id").alias("kept"), F.col("text_key").alias("kept_text"))
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("name"), F.md5(F.coalesce("text", F.lit(""))).alias("key"))
    named = rows.join(keep, (F.col("name") == F.col("kept")) & (F.col("key") == F.col("kept_text")), "left_semi").dropDuplicates(["name", "key"])
    return named.select("row.*").unionByName(docs.filter("doc_id is null"))
