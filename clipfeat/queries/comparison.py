"""Queries on vectors, checks and comparisons of feature stores."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import vectors as v
from ..jobs.check import check
from ..operators import compare, qa
from . import query
from .standins import ANNOTATIONS, FEATURES, annotations, audio_features, features, r6, visual_features

NORM = "sqrt(list_dot_product({0}, {0}))"
COS = "list_dot_product({0}, {1}) / (sqrt(list_dot_product({0}, {0})) * sqrt(list_dot_product({1}, {1})))"
PER = f"""{FEATURES}, {ANNOTATIONS}, per AS (SELECT video_id, modality, count(*) AS t, avg({NORM.format('feature')}) FILTER (step < 50) AS norm, bool_or(len(feature) <> 64) AS bad FROM features GROUP BY ALL),
joined AS (SELECT a.video_id, v.t AS tv, u.t AS ta, CAST(greatest(0, floor((duration * 16 - 16) / 8)) + 1 AS BIGINT) AS expected, v.norm AS nv, u.norm AS na,
  CASE WHEN v.t IS NULL OR u.t IS NULL THEN 'missing' WHEN v.bad OR u.bad THEN 'bad' ELSE 'valid' END AS status
  FROM annos a LEFT JOIN per v ON v.video_id = a.video_id AND v.modality = 'visual' LEFT JOIN per u ON u.video_id = a.video_id AND u.modality = 'audio'),
judged AS (SELECT *, CASE WHEN status = 'valid' THEN abs(least(tv, ta) - expected) * 0.5e0 END AS deviation FROM joined)"""


def _checked(spark, d):
    return check(annotations(spark, d), features(spark, d), 64)


@query(f"WITH {PER} SELECT video_id, status, tv AS t_visual, ta AS t_audio, expected, round(nv, 6) AS norm_visual, round(na, 6) AS norm_audio, deviation FROM judged")
def qa_join(spark, d):
    r = _checked(spark, d)["videos"]
    return r.withColumn("norm_visual", r6("norm_visual")).withColumn("norm_audio", r6("norm_audio"))


@query(f"""WITH {PER} SELECT count(*) AS annotated, CAST(count(*) FILTER (status = 'valid') AS BIGINT) AS valid, CAST(count(*) FILTER (status = 'missing') AS BIGINT) AS missing, CAST(count(*) FILTER (status = 'bad') AS BIGINT) AS bad,
  round(avg(abs(tv - ta)) FILTER (status = 'valid'), 6) AS mean_apart, max(abs(tv - ta)) FILTER (status = 'valid') AS max_apart, round(avg(deviation), 6) AS mean_deviation, max(deviation) AS max_deviation,
  round(avg(nv) FILTER (status = 'valid'), 6) AS norm_visual, round(avg(na) FILTER (status = 'valid'), 6) AS norm_audio FROM judged""")
def qa_summary(spark, d):
    s = _checked(spark, d)["summary"]
    return s.select(*[r6(c).alias(c) if c in ("mean_apart", "mean_deviation", "norm_visual", "norm_audio") else F.col(c) for c in s.columns])


@query(f"WITH {PER} SELECT video_id, deviation FROM judged WHERE status = 'valid' ORDER BY deviation DESC, video_id LIMIT 5")
def worst_videos(spark, d):
    return _checked(spark, d)["worst"]


@query(f"WITH {PER} SELECT status, CAST(pos AS INTEGER) AS pos, video_id FROM (SELECT *, row_number() OVER (PARTITION BY status ORDER BY video_id) AS pos FROM judged WHERE status <> 'valid') WHERE pos <= CASE status WHEN 'missing' THEN 10 ELSE 5 END")
def qa_examples(spark, d):
    return _checked(spark, d)["examples"]


@query(f"WITH {FEATURES} SELECT video_id, bool_or(len(feature) <> 64 OR video_id % 13 = 3) AS bad FROM features GROUP BY video_id")
def shape_check(spark, d):
    f = features(spark, d)
    return qa.shape_check(f.withColumn("feature", F.when((F.col("video_id") % 13 == 3), F.slice("feature", 1, 63)).otherwise(F.col("feature"))), 64)


@query(f"WITH {FEATURES} SELECT video_id, CASE WHEN max(CASE WHEN video_id % 7 = 2 AND step = 3 THEN 1 ELSE 0 END) = 1 THEN 'failed' ELSE 'ok' END AS status FROM features GROUP BY video_id")
def finite_check(spark, d):
    f = features(spark, d)
    broken = F.transform("feature", lambda x, i: F.when(i == 5, F.lit(float("nan"))).otherwise(x))
    return qa.finite_check(f.withColumn("feature", F.when((F.col("video_id") % 7 == 2) & (F.col("step") == 3), broken).otherwise(F.col("feature"))))


@query(f"WITH {FEATURES} SELECT video_id, modality, count(*) AS t, max(step) + 1 = count(*) AND count(DISTINCT step) = count(*) AS contiguous FROM features WHERE NOT (video_id % 9 = 4 AND step = 2) GROUP BY ALL")
def assemble_video(spark, d):
    return qa.assembled(features(spark, d).filter("not (video_id % 9 = 4 and step = 2)"))


@query(f"WITH {FEATURES} SELECT video_id, modality, round(avg({NORM.format('feature')}), 6) AS norm FROM features WHERE step < 50 GROUP BY ALL")
def feature_norms(spark, d):
    return qa.feature_norms(features(spark, d)).withColumn("norm", r6("norm"))


@query(f"WITH {FEATURES} SELECT modality, count(DISTINCT video_id) AS videos FROM features GROUP BY modality")
def count_features(spark, d):
    return qa.count_features(features(spark, d))


@query(f"WITH {FEATURES} SELECT video_id, step, round({COS.format('v.feature', 'a.feature')}, 6) AS cosine FROM visual v JOIN audio a USING (video_id, step)")
def align_modalities(spark, d):
    return compare.align_modalities(features(spark, d)).select("video_id", "step", r6(v.cosine("left", "right")).alias("cosine"))


def _other(spark, d):
    """The audio store again, shifted a little by label."""
    return audio_features(spark, d).withColumn("feature", F.transform("feature", lambda x, i: x + F.lit(0.001) * F.col("label") * (i % 3)))


OTHER = FEATURES + ", other AS (SELECT video_id, modality, step, label, list_transform(feature, lambda x, i: x + 0.001e0 * label * ((i - 1) % 3)) AS feature FROM audio)"


@query(f"WITH {OTHER} SELECT video_id, step, round({COS.format('a.feature', 'o.feature')}, 6) AS cosine FROM audio a JOIN other o USING (video_id, step) WHERE step <> 4")
def pair_features(spark, d):
    p = compare.pair_features(audio_features(spark, d).filter("step <> 4"), _other(spark, d))
    return p.select("video_id", "step", r6(v.cosine("a", "b")).alias("cosine"))


@query(f"WITH {FEATURES} SELECT a.video_id, 'audio' AS modality, CAST(count(*) FILTER (v.step IS NULL) AS BIGINT) AS only_a, 0::BIGINT AS only_b FROM audio a LEFT JOIN visual v ON a.video_id = v.video_id AND a.step = v.step GROUP BY a.video_id HAVING count(*) FILTER (v.step IS NULL) > 0")
def unpaired_steps(spark, d):
    return compare.unpaired(audio_features(spark, d), visual_features(spark, d).withColumn("modality", F.lit("audio")))


DIFF = f"""WITH {OTHER} SELECT count(*) AS n, round(min({COS.format('a.feature', 'o.feature')}), 6) AS min_cosine,
  round(sqrt(sum(list_sum(list_transform(list_zip(a.feature, o.feature), lambda p: (p[1] - p[2]) * (p[1] - p[2])))) / sum(list_dot_product(o.feature, o.feature))), 6) AS relative_error FROM audio a JOIN other o USING (video_id, step)"""


def _diff(spark, d, wide=False):
    r = compare.feature_diff(compare.pair_features(audio_features(spark, d), _other(spark, d)), wide)
    return r.select("n", r6("min_cosine").alias("min_cosine"), r6("relative_error").alias("relative_error"))


@query(DIFF)
def feature_diff(spark, d):
    return _diff(spark, d)


@query(DIFF)
def feature_diff_wide(spark, d):
    return _diff(spark, d, True)


SUMMARY = f"""WITH {OTHER}, c AS (SELECT 'shifted' AS variant, video_id, avg({COS.format('a.feature', 'o.feature')}) AS c FROM audio a JOIN other o USING (video_id, step) GROUP BY video_id
  UNION ALL SELECT 'visual', video_id, avg({COS.format('a.feature', 'w.feature')}) FROM audio a JOIN visual w USING (video_id, step) GROUP BY video_id)
SELECT variant, count(*) AS n, round(avg(c), 6) AS mean, round(median(c), 6) AS median, round(min(c), 6) AS min, CAST(count(*) FILTER (c > 0.9) AS BIGINT) AS above FROM c GROUP BY variant"""


def _summary(spark, d, wide=False):
    a = audio_features(spark, d)
    pairs = compare.pair_features(a, _other(spark, d)).withColumn("variant", F.lit("shifted")).unionByName(compare.pair_features(a, visual_features(spark, d).withColumn("modality", F.lit("audio"))).withColumn("variant", F.lit("visual")))
    s = compare.cosine_summary(pairs, wide=wide)
    return s.select("variant", "n", *[r6(c).alias(c) for c in ("mean", "median", "min")], "above")


@query(SUMMARY)
def cosine_summary(spark, d):
    return _summary(spark, d)


@query(SUMMARY)
def cosine_summary_wide(spark, d):
    return _summary(spark, d, True)


@query(f"""WITH {FEATURES}, e AS (SELECT modality, unnest(range(64)) AS i, feature, {NORM.format('feature')} AS norm FROM features),
m AS (SELECT modality, i, avg(feature[i + 1]) AS m, avg(feature[i + 1] / norm) AS u FROM e GROUP BY ALL)
SELECT a.modality AS "left", b.modality AS "right", round(sum(a.m * b.m) / (sqrt(sum(a.m * a.m)) * sqrt(sum(b.m * b.m))), 6) AS mean_vector_cosine, round(sum(a.u * b.u), 6) AS mean_pairwise_cosine
FROM m a JOIN m b USING (i) WHERE a.modality <= b.modality GROUP BY ALL""")
def space_similarity(spark, d):
    s = compare.space_similarity(features(spark, d))
    return s.select("left", "right", r6("mean_vector_cosine").alias("mean_vector_cosine"), r6("mean_pairwise_cosine").alias("mean_pairwise_cosine"))


POOL = """WITH e AS (SELECT vec_id // 4 AS clip_idx, label AS video_id, unnest(range(64)) AS i, CAST(embedding AS DOUBLE[]) AS f FROM embeddings),
m AS (SELECT video_id, clip_idx, i, avg(f[i + 1]) AS m, count(*) AS n FROM e GROUP BY ALL) SELECT video_id, clip_idx, max(n) AS n, round(sum(m * (i + 1)), 5) AS weighted FROM m GROUP BY ALL"""


def _frame_vectors(spark, d):
    return spark.read.parquet(f"{d}/embeddings.parquet").select(F.col("label").alias("video_id"), F.expr("vec_id div 4").alias("clip_idx"), F.col("embedding").alias("feature"))


def _weighted(rows):
    return rows.select("video_id", "clip_idx", "n", F.round(F.aggregate(F.transform("mean", lambda x, i: x * (i + 1)), F.lit(0.0), lambda s, x: s + x), 5).alias("weighted"))


@query(POOL)
def pool_clip_mean(spark, d):
    return _weighted(compare.pool_clips(_frame_vectors(spark, d)))


@query(POOL)
def pool_clip_mean_wide(spark, d):
    return _weighted(compare.wide_vector_means(_frame_vectors(spark, d), ["video_id", "clip_idx"]))


@query(f"WITH {FEATURES} SELECT modality, count(*) AS n, round(sum(list_sum(feature)), 3) AS total, 0::BIGINT AS repeated FROM features GROUP BY modality")
def merge_stores(spark, d):
    m = compare.merge_stores(("audio", audio_features(spark, d)), ("visual", visual_features(spark, d)))
    twice = compare.repeated_rows(m).groupBy("modality").agg(F.count(F.lit(1)).alias("repeated"))
    total = F.round(F.sum(F.aggregate("feature", F.lit(0.0), lambda a, x: a + x)), 3)
    return m.groupBy("modality").agg(F.count(F.lit(1)).alias("n"), total.alias("total")).join(twice, "modality", "left").select("modality", "n", "total", F.coalesce("repeated", F.lit(0)).alias("repeated"))


@query("""WITH e AS (SELECT vec_id, CASE WHEN vec_id % 10 = 0 THEN list_transform(CAST(embedding AS DOUBLE[]), lambda x: 0e0) ELSE CAST(embedding AS DOUBLE[]) END AS a, CAST(embedding AS DOUBLE[]) AS b FROM embeddings)
SELECT vec_id, CASE WHEN vec_id % 10 > 0 THEN round(list_dot_product(a, list_reverse(b)) / (sqrt(list_dot_product(a, a)) * sqrt(list_dot_product(b, b))), 6) END AS cosine FROM e""")
def cosine(spark, d):
    e = spark.read.parquet(f"{d}/embeddings.parquet").withColumn("a", F.when(F.col("vec_id") % 10 == 0, F.transform("embedding", lambda x: x * 0)).otherwise(F.col("embedding")))
    return e.select("vec_id", r6(v.cosine("a", F.reverse("embedding"))).alias("cosine"))


@query(f"WITH {FEATURES} SELECT video_id, modality, step, round({NORM.format('feature')}, 6) AS norm FROM features")
def l2_norm(spark, d):
    return features(spark, d).select("video_id", "modality", "step", r6(v.l2_norm("feature")).alias("norm"))


@query(f"WITH {FEATURES} SELECT video_id, modality, step, 1e0 AS norm, round(feature[1] / {NORM.format('feature')}, 6) AS first_value FROM features")
def l2_normalize(spark, d):
    n = features(spark, d).withColumn("u", v.l2_normalize("feature"))
    return n.select("video_id", "modality", "step", r6(v.l2_norm("u")).alias("norm"), r6(F.col("u")[0]).alias("first_value"))


@query("SELECT vec_id, true AS fp16_near, true AS bf16_near, true AS same FROM embeddings")
def cast_precision(spark, d):
    """Whether half precisions lose no more than half a unit of their last place (2^-11 and 2^-8 of a value, and a least number)."""
    near = lambda a, b, rel: F.forall(F.zip_with(a, b, lambda x, y: F.abs(x - y) <= F.abs(x) * rel + 1e-7), lambda t: t)
    e = spark.read.parquet(f"{d}/embeddings.parquet").withColumn("h", v.round_trip("fp16")("embedding")).withColumn("b", v.round_trip("bf16")("embedding"))
    return e.select("vec_id", near("embedding", "h", 2.0**-11).alias("fp16_near"), near("embedding", "b", 2.0**-8).alias("bf16_near"), (v.to_float32(F.col("embedding").cast("array<double>")) == F.col("embedding")).alias("same"))


def _rounded(x: str, kept: int, least: int) -> str:
    """SQL: ``x`` with ``kept`` bits after the first one, half to even, and no unit below 2 to the ``least``."""
    power = f"CASE WHEN abs({x}) < 1e-300 THEN {least} ELSE floor(log2(abs({x}))) END"
    exact = f"({power} + CASE WHEN pow(2e0, {power} + 1) <= abs({x}) THEN 1 WHEN pow(2e0, {power}) > abs({x}) THEN -1 ELSE 0 END)"
    unit = f"pow(2e0, greatest({exact} - {kept}, {least}))"
    return f"round_even({x} / {unit}, 0) * {unit}"


@query(f"""WITH e AS (SELECT vec_id, list_concat(CAST(embedding AS DOUBLE[]), [1 + (2 * (vec_id % 1000) + 1) / 2048e0, 1 + (2 * (vec_id % 100) + 1) / 256e0, -(vec_id % 50) / pow(2e0, 25), 0e0]) AS v FROM embeddings)
SELECT vec_id, CAST(list_sum(list_transform(v, lambda x, i: CAST({_rounded('x', 10, -24)} * pow(2e0, 40) AS BIGINT) * (i % 7 + 1))) AS BIGINT) AS fp16,
  CAST(list_sum(list_transform(v, lambda x, i: CAST({_rounded('x', 7, -133)} * pow(2e0, 40) AS BIGINT) * (i % 7 + 1))) AS BIGINT) AS bf16 FROM e""")
def half_precisions(spark, d):
    """Every element after a round trip through half precisions, to its last bit; some lie just between two values."""
    i = F.col("vec_id")
    more = F.array(1 + (2 * (i % 1000) + 1) / 2048, 1 + (2 * (i % 100) + 1) / 256, -(i % 50) / F.lit(2.0**25), F.lit(0.0))
    e = spark.read.parquet(f"{d}/embeddings.parquet").select("vec_id", F.concat(F.col("embedding").cast("array<double>"), more).cast("array<float>").alias("v"))
    bits = lambda c: F.aggregate(F.transform(c, lambda x, i: F.rint(x.cast("double") * 2.0**40).cast("long") * ((i + 1) % 7 + 1)), F.lit(0).cast("long"), lambda s, x: s + x)
    return e.select("vec_id", bits(v.round_trip("fp16")("v")).alias("fp16"), bits(v.round_trip("bf16")("v")).alias("bf16"))
