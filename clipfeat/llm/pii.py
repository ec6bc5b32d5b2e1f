"""Information-theoretic sanitisation of personal data, in DataFrame functions only.

Emails, addresses of machines, card and phone numbers are found by pattern; they are the protected entities. The words
of their documents are weighed by what they disclose: with the documents that hold the word, the entity, or both counted
over the whole corpus, wherever in a document they are, the pointwise mutual information of word and entity divided by the
entity's information says which part of the entity the word gives away. From ``generalise`` on a word is replaced by a mark
of its kind, from ``remove`` on it goes, at every place in the documents that hold the entity. All pairs of a word and an
entity are assessed. A pair counts if ``support`` different texts hold it, or if so many would hardly do by chance: the chance (a
Poisson tail, bounded by Chernoff), times the number of pairs, is at most ``doubt``. One text that holds both is no evidence where
pairs are many, since what it says of itself is true of every word in it. Words are the runs of ``term``, by default of letters
and digits, of any length; counts and thresholds weed them out, no distance does.

The places of matches are running sums of the lengths between and of them, taken in blocks, and texts are cut by blocks of
characters, so the work on a text grows with its length also where it holds very many spans.

Cases: a null or empty text has no span; matches that fail their check are dropped and not tried again; repeated rows get
equal spans; ties of start are in the order email, ip, card, phone, term; an empty table gives no rows; extra columns are
ignored; a null doc_id is a document like any other.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import staged, table

KINDS = ("email", "ip", "card", "phone")

_LOCAL = "A-Za-z0-9._%+-"
_PART = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"
#: Written so that a run of characters is entered once, at its start or right after a match: long runs cost no more than their
#: length, and no repeated group holds a place to come back to. Only whole runs of 14 to 19 digits count as cards, so the pattern asks for those and for nothing on either side.
PATTERNS = {
    "email": rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]+\.[0-9]+\.[0-9]+",
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){13,18}+(?![ -]?[0-9])",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
_SPAN = "array<struct<start:int,rank:int,end:int,kind:string,value:string>>"
#: A word of the corpus that may be weighed: any run of letters and digits, whatever its length.
TERM = r"[\p{L}\p{N}]+"
#: Elements of an array, and characters of a text, that are taken at once.
_BLOCK, _CHARS = 64, 512


def _seems(text: Column, kind: str) -> Column:
    """A cheap test that texts without a match mostly fail."""
    return {"email": text.contains("@"), "ip": text.rlike(r"[0-9]\.[0-9]"), "card": text.rlike(r"[0-9][ -]?[0-9][ -]?[0-9][ -]?[0-9][ -]?[0-9][ -]?[0-9]"), "phone": text.contains("+")}[kind]


def _passes(value: Column, kind: str) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    return {
        "email": F.lit(True),
        "ip": value.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$"),
        "card": F.call_function("luhn_check", digits),
        "phone": F.length(digits).between(10, 15),
    }[kind]


def _bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often ``body`` names it."""
    return F.transform(F.array(value), body)[0]


def _running(values: Column, zero: Column, op: Callable[[Column, Column], Column], levels: int = 2) -> Column:
    """``op`` over each element and those before it, for an ``op`` that may be grouped at will. Blocks first, then blocks of blocks,
    then over those: no array grows by one element at a time beyond their number, a 4096th of the elements."""

    def along(part):
        grown = F.aggregate(part, F.array(zero), lambda a, v: F.concat(a, F.array(op(F.element_at(a, -1), v))))
        return F.slice(grown, F.lit(2), F.size(part))

    def joined(inner):
        totals = F.transform(inner, lambda p: F.coalesce(F.try_element_at(p, F.lit(-1)), zero))
        before = along(totals) if levels == 1 else F.slice(_running(totals, zero, op, levels - 1), F.lit(1), F.size(totals))
        return _bound(F.concat(F.array(zero), before), lambda z: F.flatten(F.transform(inner, lambda p, i: F.transform(p, lambda v: op(z[i], v)))))

    def blocks(x):
        last = F.greatest(F.lit(0), F.floor((F.size(x) - 1) / _BLOCK).cast("int"))
        return F.transform(F.sequence(F.lit(0), last), lambda b: along(F.slice(x, b * _BLOCK + 1, F.lit(_BLOCK))))

    return _bound(values, lambda x: _bound(blocks(x), joined))


def _cutter(text: Column, body: Callable[[Callable], Column]) -> Column:
    """``body`` of a function that cuts [start, end) out of ``text``, at a cost of what it cuts and no more."""
    blocks = F.regexp_extract_all(text, F.lit(rf"(?s).{{1,{_CHARS}}}"), F.lit(0))

    def cut(held, start, end):
        first = F.floor(start / _CHARS).cast("int")
        some = F.slice(held, first + 1, F.greatest(F.lit(0), F.floor((end - 1) / _CHARS).cast("int") - first + 1))
        return F.when(start < end, F.substr(F.array_join(some, ""), start - first * _CHARS + 1, end - start)).otherwise(F.lit(""))

    return _bound(blocks, lambda held: body(lambda start, end: cut(held, start, end)))


def _ends(hits: Column, gaps: Column) -> Column:
    """Where each match ends, from the matches and the lengths of the gaps before, between and after them."""
    return _running(F.zip_with(F.slice(gaps, F.lit(1), F.size(hits)), hits, lambda g, v: g + F.length(v)), F.lit(0), lambda a, x: a + x)


def _gaps(text: Column, pattern: str) -> Column:
    return F.transform(F.split(text, pattern, -1), F.length)


def _spans(kind: str, rank: int) -> Column:
    hits, gaps = F.col(f"_{kind}"), F.col(f"_{kind}_gaps")
    span = lambda v, end: F.struct((end - F.length(v)).alias("start"), F.lit(rank).alias("rank"), end.alias("end"), F.lit(kind).alias("kind"), v.alias("value"))
    found = F.filter(F.zip_with(hits, _ends(hits, gaps), span), lambda s: _passes(s["value"], kind))
    return F.when(F.size(hits) > 0, found).otherwise(F.array().cast(_SPAN)).cast(_SPAN)


def base_spans(docs: DataFrame) -> DataFrame:
    """``docs`` with a column ``base``: the spans found by pattern, by start and then kind, ends exclusive, in code points."""
    text, none = F.col("text"), F.array().cast("array<string>")
    rows = docs
    for kind in KINDS:
        hits = F.regexp_extract_all(text, F.lit(PATTERNS[kind]), F.lit(0))
        rows = rows.withColumn(f"_{kind}", F.when(_seems(text, kind), hits).otherwise(none))
        rows = rows.withColumn(f"_{kind}_gaps", F.when(F.size(f"_{kind}") > 0, _gaps(text, PATTERNS[kind])).otherwise(F.array().cast("array<int>")))
    spans = [_spans(kind, rank) for rank, kind in enumerate(KINDS)]
    return rows.withColumn("base", F.array_sort(F.concat(*spans))).drop(*[f"_{k}" for k in KINDS], *[f"_{k}_gaps" for k in KINDS])


def _replaced(text: Column, spans: Column, mark: Callable[[Column, Column], Column]) -> Column:
    """``text`` with ``mark(span, before)`` in the place of its spans, which are in order; before is where the spans ahead of this
    one end, at most. Spans that overlap make one place."""

    def pieces(cut):
        def body(until):
            each = F.transform(spans, lambda s, i: _bound(until[i], lambda before: F.concat(cut(before, s["start"]), mark(s, before))))
            return F.concat(F.array_join(each, ""), cut(F.element_at(until, -1), F.length(text)))

        return _bound(F.concat(F.array(F.lit(0)), _running(F.transform(spans, lambda s: s["end"]), F.lit(0), lambda a, x: F.greatest(a, x))), body)

    return _cutter(text, pieces)


def _masked(text: Column, spans: Column) -> Column:
    """``text`` with a zero character for each one inside a span, so that places stay the same."""
    return _replaced(text, spans, lambda s, before: F.repeat(F.lit("\0"), F.greatest(F.lit(0), s["end"] - F.greatest(s["start"], before))))


def _words(text: Column, term: str) -> Column:
    """The distinct words of a text, in lower case."""
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(term), F.lit(0)), F.lower))


def disclosures(docs: DataFrame, found: DataFrame, held: DataFrame, generalise: float, remove: float, support: int, term: str, doubt: float) -> DataFrame:
    """(entity, term, disclosed, action) of the words that give away too much, from counts over all documents.

    The pairs of an entity of one text are held by one text each, whatever the word. How likely that is by chance is known before
    they are formed: at least one in the number of documents. Where that is too likely, none of them can count and they are
    not formed; where pairs are so few that one text is evidence, they are."""
    n = docs.count()
    entities = held.groupBy("entity").agg(F.sum("docs").alias("n_entity"), F.count(F.lit(1)).alias("texts"))
    sizes = found.filter("masked is not null").select("text_key", "masked").dropDuplicates(["text_key"]).select("text_key", F.size(_words(F.col("masked"), term)).alias("words"))
    n_pairs = float(held.join(sizes, "text_key").agg(F.sum("words")).first()[0] or 1)
    bound = math.log(doubt) - math.log(max(n_pairs, 1.0))
    least = 1 if 1 - 1 / max(n, 1) - math.log(max(n, 1)) <= bound else min(2, support)
    often = held.join(entities.filter(F.col("texts") >= least).select("entity"), "entity")
    texts = found.filter("masked is not null").select("text_key", "masked").dropDuplicates(["text_key"]).select("text_key", _words(F.col("masked"), term).alias("words"))
    pairs = often.join(texts, "text_key").select("entity", "docs", F.explode("words").alias("term"))
    pairs = pairs.groupBy("entity", "term").agg(F.sum("docs").alias("n_pair"), F.count(F.lit(1)).alias("texts")).filter(F.col("texts") >= least)
    pairs = staged(pairs, "pii-pairs")
    words = docs.select(F.explode(_words(F.col("text"), term)).alias("term"))
    words = words.groupBy("term").agg(F.count(F.lit(1)).alias("n_term"))
    known = F.log2(F.lit(float(max(n, 2))) / F.col("n_entity"))
    mutual = F.log2(F.col("n_pair") * F.lit(float(max(n, 2))) / (F.col("n_term") * F.col("n_entity")))
    out = pairs.join(entities.select("entity", "n_entity", F.col("texts").alias("of_entity")), "entity").join(words, "term").withColumn("disclosed", F.when(known > 0, mutual / known).otherwise(F.lit(0.0)))
    # texts of the pair that chance alone would give, and a bound on the logarithm of the chance of as many as there are
    chance = F.col("of_entity") * F.col("n_term") / F.lit(float(max(n, 1)))
    unlikely = (F.col("texts") > chance) & (F.col("texts") - chance + F.col("texts") * F.ln(chance / F.col("texts")) <= bound)
    out = out.filter((F.col("texts") >= support) | unlikely)
    return out.filter(F.col("disclosed") >= generalise).select("entity", "term", "disclosed", F.when(F.col("disclosed") >= remove, "remove").otherwise("generalise").alias("action"))


def term_spans(found: DataFrame, actions: DataFrame, term: str) -> DataFrame:
    """(text_key, terms): every place of the words in ``actions`` (text_key, term, action) in their texts, each text once.

    Words meet their actions by text and word in a join, so a text of many words and many actions costs their sum."""
    texts = found.filter("masked is not null").join(actions.select("text_key").distinct(), "text_key", "left_semi").select("text_key", "masked").dropDuplicates(["text_key"])
    texts = texts.select("text_key", F.regexp_extract_all("masked", F.lit(term), F.lit(0)).alias("hits"), _gaps(F.col("masked"), term).alias("gaps"))
    words = texts.select("text_key", F.explode(F.zip_with("hits", _ends(F.col("hits"), F.col("gaps")), lambda v, end: F.struct(v.alias("word"), end.alias("end")))).alias("w"))
    words = words.select("text_key", F.lower("w.word").alias("term"), (F.col("w.end") - F.length("w.word")).alias("start"), F.col("w.end").alias("end")).join(actions, ["text_key", "term"])
    span = F.struct("start", F.lit(len(KINDS)).alias("rank"), "end", F.lit("term").alias("kind"), F.col("action").alias("value"))
    return words.groupBy("text_key").agg(F.array_sort(F.collect_list(span)).cast(_SPAN).alias("terms"))


def find_personal_data(docs: DataFrame, generalise: float = 0.7, remove: float = 0.9, support: int = 3, term: str = TERM, doubt: float = 0.01) -> DataFrame:
    """(doc_id, text_key, base, terms): the spans by pattern, and those of words that disclose too much of an entity of their text.

    One pass over the texts finds the spans and masks them in the texts that have any, one more counts words. Counts are
    summed before each shuffle, so a common word or entity is one row per task."""
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    base = base_spans(docs).withColumn("text_key", F.md5("text"))
    masked = F.when(F.size("base") > 0, _masked(F.col("text"), F.col("base")))
    found = staged(base.select("doc_id", "text_key", "base", masked.alias("masked")), "pii-spans")
    held = found.select("text_key", F.explode(F.array_distinct(F.transform("base", lambda s: F.concat_ws(":", s["kind"], F.lower(s["value"]))))).alias("entity"))
    held = staged(held.groupBy("entity", "text_key").agg(F.count(F.lit(1)).alias("docs")), "pii-entities")
    risky = staged(disclosures(docs, found, held, generalise, remove, support, term, doubt), "pii-terms")
    actions = staged(held.join(risky, "entity").groupBy("text_key", "term").agg(F.max("action").alias("action")), "pii-actions")
    terms = term_spans(found, actions, term)
    none = F.array().cast(_SPAN)
    with_terms = found.filter(F.size("base") > 0).select("doc_id", "text_key", "base").join(terms, "text_key", "left")
    with_terms = with_terms.select("doc_id", "text_key", "base", F.coalesce("terms", none).alias("terms"))
    return with_terms.union(found.filter(F.size("base") == 0).select("doc_id", "text_key", "base", none.alias("terms")))


def listed(spans: Column) -> Column:
    """kind:start:end of the spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def sanitised(text: Column, spans: Column) -> Column:
    """``text`` with its spans, which are in order, replaced: a mark of the kind, or nothing where a word is to be removed. Of
    spans that overlap the first gives the mark, and what any of them holds goes."""
    mark = lambda s: F.when((s["kind"] == "term") & (s["value"] == "remove"), F.lit("")).otherwise(F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")))
    return _replaced(text, spans, lambda s, before: F.when(s["start"] >= before, mark(s)).otherwise(F.lit("")))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of every document, and their digests."""
    rows = find_personal_data(table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return rows.select("doc_id", *map(count, KINDS), F.sha2(listed(F.col("base")), 256).alias("base_sha256"), listed(F.array_sort(F.concat("base", "terms"))).alias("spans"))
