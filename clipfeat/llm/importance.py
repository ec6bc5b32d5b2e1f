"""Target-distribution importance resampling: which documents look most like a target set, with Gumbel noise.

Documents and target are bags of hashed word runs. The logarithm of the ratio of their bucket frequencies is one array of
gains, of fixed size, that every task gets; a document's weight is the sum of the gains of its runs. Noise from a hash of
doc_id makes the highest scores a sample without replacement in proportion to exp(weight). The exact last score that is in
is found by radix selection: the digits of the composite key (score, doc_id) are counted from the most significant on, among
the rows that share the digits before, so no row is sorted for it. Only the drawn rows are sorted, by ranges, and ranked by
sums over the ranges before.

The checksum of a run of words comes from the checksums of its words, since a CRC is linear: texts are only cut into words.

Cases: a null or empty text has no runs and weight 0, and is too short to be drawn; ties of score go to the smaller doc_id, a
null doc_id comes after all and hashes as "null"; of repeated rows, which share their score, as many are drawn as fit; with no
target every document is held against a flat distribution; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .shared import staged, table
from .words import WordTable

BUCKETS = 10_000
#: Runs of this many words and fewer are features.
RUN = 3
#: A-Z in lower case; all other bytes below 128 that are no digits or letters part words.
_PLAIN = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
_ONES = 0xFFFFFFFF
#: Words of more bytes, with the space before them, are added to a checksum byte by byte.
_LONG = 255


def _shifts() -> np.ndarray:
    """For n = 0 to _LONG and each byte of a checksum: what it becomes when n bytes of zero follow."""
    one = np.array([zlib.crc32(b"\0", b ^ _ONES) ^ _ONES for b in range(256)], np.uint32)
    rows = [np.concatenate([np.arange(256, dtype=np.uint32) << np.uint32(8 * k) for k in range(4)])]
    for _ in range(_LONG):
        rows.append((rows[-1] >> np.uint32(8)) ^ one[rows[-1] & np.uint32(255)])
    return np.concatenate(rows)


class RunCrcs:
    """Checksums of runs of words, from those of the words."""

    def __init__(self):
        self.known = WordTable(zlib.crc32, lambda w: zlib.crc32(b" " + w), lambda w: len(w) + 1, of=lambda x: np.fromiter(x, np.uint64, len(x)))
        self.shifts = _shifts()

    def _joined(self, before: np.ndarray, after: np.ndarray, size: np.ndarray, words: list[bytes]) -> np.ndarray:
        """Checksums of what ``before`` stands for, a space and a word each."""
        at = np.minimum(size, _LONG).astype(np.int64) << 10
        out = after.copy()
        for k in range(4):
            out ^= self.shifts[at + (k << 8) + ((before >> np.uint32(8 * k)) & np.uint32(255)).astype(np.int64)]
        for i in np.flatnonzero(size > _LONG):
            out[i] = zlib.crc32(b" " + words[i], int(before[i]))
        return out

    def runs(self, words: list[bytes]) -> list[np.ndarray]:
        """Checksums of the runs of 1, 2 and 3 words, by the place of their last word; the first has one for each word."""
        crc, after, size = self.known.look_up(words)
        found, after = [crc.astype(np.uint32)], after.astype(np.uint32)
        for k in range(1, min(RUN, len(words))):
            found.append(self._joined(found[-1][:-1], after[k:], size[k:], words[k:]))
        return found


def _pieces(text: bytes | None, size: int = 4_000_000) -> Iterator[list[bytes]]:
    """The words of a text, a few megabytes of it at a time."""
    plain, at = (text or b"").translate(_PLAIN), 0
    while at < len(plain):
        end = plain.find(b" ", at + size) if at + size < len(plain) else -1
        end = len(plain) if end < 0 else end
        yield plain[at:end].split()
        at = end


def features(texts, crcs: RunCrcs, at_once: int = 300_000) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(index of the text, bucket) of all features of some texts, many at a time; a long text comes in several parts, and what
    spans two parts is counted with the later one."""
    words, owner, old = [], [], 0

    def flush():
        at = np.repeat(np.array([i for i, _ in owner], np.int64), [n for _, n in owner])
        fresh = np.arange(len(at)) >= old
        of, buckets = [], []
        for k, found in enumerate(crcs.runs(words)):
            there = fresh[k:] & (at[k:] == at[: len(at) - k])
            of.append(at[k:][there])
            buckets.append(found[there] % np.uint32(BUCKETS))
        return np.concatenate(of), np.concatenate(buckets).astype(np.int64)

    for i, text in enumerate(texts):
        for part in _pieces(text):
            if part:
                words += part
                owner.append((i, len(part)))
            if len(words) >= at_once:
                yield flush()
                last = [w for w in words[-(RUN - 1) :]]
                spans = np.repeat(np.array([j for j, _ in owner[-RUN:]]), [n for _, n in owner[-RUN:]])[-(RUN - 1) :]
                words, owner, old = last, [(int(j), 1) for j in spans], len(last)
    if len(words) > old:
        yield flush()


def _texts(batch) -> list:
    return batch.column("text").cast(pa.binary()).to_pylist()


def bucket_counts(rows: DataFrame) -> np.ndarray:
    """How many features of all ``rows`` (text) fall into each bucket: one array a task, summed by bucket."""

    def run(batches):
        crcs, total = RunCrcs(), np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for _, buckets in features(_texts(batch), crcs):
                total += np.bincount(buckets, minlength=BUCKETS)
        kept = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(kept), pa.array(total[kept])], ["bucket", "n"])

    counts = rows.select("text").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    total = np.zeros(BUCKETS, np.int64)
    total[counts["bucket"]] = counts["n"]
    return total


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the logarithm of how much more often a bucket comes in the target, rounded down; counts grow by one each."""
    ratio = (target + 1.0) * (source.sum() + float(BUCKETS)) / ((source + 1.0) * (target.sum() + float(BUCKETS)))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def noise(doc_id: Column, seed: int) -> Column:
    """Gumbel noise in thousandths, rounded down, from a hash of doc_id."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.ln(-F.ln((h + 0.5) / 4294967296.0))).cast("long")


def importance_scores(docs: DataFrame, target: DataFrame, seed: int = 42) -> DataFrame:
    """(doc_id, n_features, weight, score) of every document, a written table. Texts are read twice and never shuffled."""
    shared = docs.sparkSession.sparkContext.broadcast(gains(bucket_counts(docs), bucket_counts(target)))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        crcs, worth = RunCrcs(), shared.value
        for batch in batches:
            n, weight = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            for of, buckets in features(_texts(batch), crcs):
                n += np.bincount(of, minlength=len(n))
                weight += np.bincount(of, worth[buckets], len(n)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n), pa.array(weight)], ["doc_id", "n_features", "weight"])

    weighed = docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_features long, weight long")
    return staged(weighed.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed)), "importance-scores")


_SIGN = 1 << 63


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= _SIGN else x


def kth_value(rows: DataFrame, column: Column, k: int, digit: int = 16) -> tuple[int, int, int]:
    """(value, place, ties): the k-th smallest value of a long column, the place of the k-th row among those of that value,
    and how many these are. A round counts the next ``digit`` bits of the rows that share the bits before: no more than
    2 to the ``digit`` sums come back."""
    low, high = rows.agg(F.min(column), F.max(column)).first()
    bits = ((low + _SIGN) ^ (high + _SIGN)).bit_length()
    prefix, ties = (low + _SIGN) >> bits, None
    key = column.bitwiseXOR(F.lit(-_SIGN))
    while bits or ties is None:
        take = min(digit, bits)
        same = rows.filter(F.shiftrightunsigned(key, bits) == F.lit(_signed(prefix))) if bits < 64 else rows
        bits -= take
        counts = same.groupBy(F.shiftrightunsigned(key, bits).bitwiseAND(F.lit((1 << take) - 1)).alias("digit")).count().collect()
        for d, ties in sorted((r["digit"], r["count"]) for r in counts):
            if k <= ties:
                break
            k -= ties
        prefix = prefix << take | d
    return prefix - _SIGN, k, ties


def ranked_draw(scored: DataFrame, k: int) -> DataFrame:
    """``scored`` (doc_id, n_features, weight, score) with the rank of the ``k`` rows of the highest scores, null for all others.

    Rows that are equal in every column are one row with a count from the selection on, so a row that is repeated very
    often is neither one range nor one task."""
    order = [F.bitwise_not("score"), F.col("doc_id").isNull().cast("long"), F.coalesce(F.col("doc_id").cast("long"), F.lit(0)), F.col("n_features")]
    rows, cut, place, ties = scored, [], k, None
    for column in order if k > 0 else []:
        value, place, ties = kth_value(rows, column, place)
        cut.append(value)
        rows = rows.filter(column == value)
        if place == ties:
            break
    if not cut:
        return scored.withColumn("rank", F.lit(None).cast("long"))
    key, end = F.struct(*order[: len(cut)]), F.struct(*[F.lit(v).cast("long") for v in cut])
    inside, last = key <= end, key == end
    columns = ["doc_id", "n_features", "weight", "score"]
    drawn = scored.filter(inside).groupBy(*columns).agg(F.count(F.lit(1)).alias("copies"))
    drawn = drawn.withColumn("taken", F.when(last & F.lit(place < ties), F.lit(place)).otherwise(F.col("copies")))
    sort = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("n_features")]
    ranged = staged(drawn.repartitionByRange(*sort).withColumn("range", F.spark_partition_id()), "importance-drawn")
    sums = ranged.groupBy("range").agg(F.sum("taken").alias("n"))
    ahead = W.orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    sums = sums.select("range", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("offset"))
    # one row for each range, of which there are as many as shuffle partitions
    placed = ranged.join(F.broadcast(sums), "range")
    inner = W.partitionBy("range").orderBy(*sort).rowsBetween(W.unboundedPreceding, -1)
    placed = placed.withColumn("before", F.col("offset") + F.coalesce(F.sum("taken").over(inner), F.lit(0)))
    copies = placed.select(*columns, "taken", "before", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("i"))
    copies = copies.select(*columns, F.when(F.col("i") <= F.col("taken"), F.col("before") + F.col("i")).alias("rank"))
    return copies.unionByName(scored.filter(~inside).select(*columns, F.lit(None).cast("long").alias("rank")))


def least_features(words: int) -> int:
    """The features of a text of so many words."""
    return sum(max(0, words - k) for k in range(RUN))


def importance_resample(docs: DataFrame, target: DataFrame, percent: int = 5, least_words: int = 20, seed: int = 42) -> DataFrame:
    """(doc_id, n_features, weight, score, rank): of the documents of ``least_words`` words or more, ``percent`` of a hundred
    are drawn and ranked; the others have no rank."""
    scored = importance_scores(docs, target, seed)
    enough = F.col("n_features") >= least_features(least_words)
    able = scored.filter(enough)
    drawn = ranked_draw(able, percent * able.count() // 100)
    return drawn.unionByName(scored.filter(~enough).withColumn("rank", F.lit(None).cast("long")))


def resampled_documents(docs: DataFrame, target: DataFrame, percent: int = 5, least_words: int = 20, seed: int = 42) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose doc_id is drawn."""
    drawn = importance_resample(docs, target, percent, least_words, seed).filter("rank is not null").select(F.col("doc_id").alias("_drawn")).distinct()
    rows = docs.select(F.struct("*").alias("row"))
    return rows.join(drawn, F.col("row.doc_id").eqNullSafe(F.col("_drawn")), "left_semi").select("row.*")


def op11_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents against the texts of the benchmark."""
    rows = importance_resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark").select("text"))
    return rows.select(F.col("doc_id").cast("long").alias("doc_id"), "n_features", "weight", "score", "rank")


SQL = r"""
WITH crc AS (SELECT list(list_reduce([CAST(b AS UBIGINT)] || list_transform(range(8), lambda k: CAST(0 AS UBIGINT)),
    lambda x, k: CASE WHEN x & 1 = 1 THEN xor(x >> 1, CAST(3988292384 AS UBIGINT)) ELSE x >> 1 END) ORDER BY b) AS tab FROM range(256) t(b)),
texts AS (SELECT row_number() OVER () AS k, doc_id, text, true AS source FROM documents UNION ALL SELECT -row_number() OVER (), NULL, text, false FROM benchmark),
words AS (SELECT k, source, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts),
runs AS (SELECT k, source, unnest(w || list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) || list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) AS f FROM words),
counted AS (SELECT k, source, f, count(*) AS n FROM runs GROUP BY ALL),
hashed AS (SELECT f, CAST(xor(list_reduce([CAST(4294967295 AS UBIGINT)] || list_transform(range(CAST(octet_length(encode(f)) AS BIGINT)), lambda i: CAST('0x' || substr(hex(encode(f)), 2 * i + 1, 2) AS UBIGINT)),
    lambda c, b: xor(c >> 8, tab[CAST(xor(c, b) & 255 AS BIGINT) + 1])), CAST(4294967295 AS UBIGINT)) % 10000 AS BIGINT) AS bucket FROM (SELECT DISTINCT f FROM counted), crc),
filled AS (SELECT c.k, c.source, h.bucket, sum(c.n) AS n FROM counted c JOIN hashed h USING (f) GROUP BY ALL),
sums AS (SELECT bucket, coalesce(sum(n) FILTER (source), 0) AS s, coalesce(sum(n) FILTER (NOT source), 0) AS t FROM filled GROUP BY bucket),
totals AS (SELECT sum(s) AS s_all, sum(t) AS t_all FROM sums),
gains AS (SELECT bucket, CAST(floor(1000 * ln(CAST(t + 1 AS DOUBLE) * CAST(s_all + 10000 AS DOUBLE) / (CAST(s + 1 AS DOUBLE) * CAST(t_all + 10000 AS DOUBLE)))) AS BIGINT) AS gain FROM sums, totals),
weighed AS (SELECT k, CAST(sum(n) AS BIGINT) AS n_features, CAST(sum(n * gain) AS BIGINT) AS weight FROM filled JOIN gains USING (bucket) WHERE source GROUP BY k),
scored AS (
  SELECT k, doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 8) AS BIGINT) + 0.5) / CAST(4294967296 AS DOUBLE)))) AS BIGINT) AS score
  FROM texts LEFT JOIN weighed USING (k) WHERE source),
placed AS (SELECT k, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, n_features) AS place, count(*) OVER () AS n FROM scored WHERE n_features >= 57)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= 5 * n // 100 THEN place END AS rank FROM scored LEFT JOIN placed USING (k)
"""
