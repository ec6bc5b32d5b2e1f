import random
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from clipfeat.llm import neardup
from clipfeat.llm.components import components, linked

from .edge import documents, empty


def naive_fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    h = [xxhash.xxh64(s, seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def classes(ids, links):
    top = {i: i for i in ids}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        top[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


@pytest.mark.parametrize("few", [-1, 200_000])
def test_components(spark, monkeypatch, few):
    monkeypatch.setattr("clipfeat.llm.components.FEW_LINKS", few)
    random.seed(1)
    links = [(random.randrange(300), random.randrange(300)) for _ in range(180)] + [(i, i + 1) for i in range(1000, 1080)] + [(2000, i) for i in range(2001, 2400)]
    ids = {x for p in links for x in p if p[0] != p[1]}
    got = {r.id: r.comp for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == classes(ids, [p for p in links if p[0] != p[1]])
    assert components(spark.createDataFrame([(3, 3)], "a long, b long")).count() == 0


@pytest.mark.parametrize("step", [10, 40])
def test_linked_loses_no_link(spark, step):
    """Small buckets are compared pair by pair, big ones by stars and then between components."""
    random.seed(2)
    values = {i: random.randrange(60) for i in range(120)}
    rows = [(v // step, i) for i, v in values.items()]
    verify = lambda p: p.filter("abs(a % 40 - b % 40) <= 1")
    near = F.abs(F.col("id_a") % 40 - F.col("id_b") % 40) <= 2
    got = {r.id: r.comp for r in linked(spark.createDataFrame(rows, "key long, id long"), near, verify).collect()}
    links = [(a, b) for ka, a in rows for kb, b in rows if ka == kb and a < b and abs(a % 40 - b % 40) <= 1]
    want = classes(values, links)
    assert all(got.get(i, i) == c for i, c in want.items())


def test_prefix_pairs_lose_no_pair(spark):
    random.seed(6)
    base = [random.randrange(10**6) for _ in range(60)]
    sets = {}
    for i in range(150):
        s = set(base)
        for _ in range(random.randrange(0, 12)):
            s.discard(random.choice(base))
            s.add(random.choice([random.randrange(10**6), random.randrange(8)]))
        sets[i] = s
    rows = spark.createDataFrame([(i, sorted(s)) for i, s in sets.items()], "id long, shingles array<long>")
    members = spark.createDataFrame([(i, i - i % 3) for i in sets], "id long, comp long")
    got = {(min(r), max(r)) for r in neardup.prefix_pairs(rows, members, 0.8).collect()}
    sim = lambda a, b: len(sets[a] & sets[b]) / len(sets[a] | sets[b])
    want = {(a, b) for a in sets for b in sets if a < b and a - a % 3 != b - b % 3 and sim(a, b) >= 0.8}
    assert len(want) > 300 and want <= got


def test_a_big_group_of_near_copies(spark):
    """Copies of one text, most of them within reach of it and some not: as brute force has it."""
    random.seed(8)
    base = [f"word{random.randrange(10**6)}" for _ in range(150)]
    rows = []
    for i in range(120):
        w = list(base)
        for _ in range(random.randrange(0, 7)):
            w[random.randrange(150)] = f"edit{random.randrange(10**6)}"
        rows.append((i, " ".join(w)))
    got = {r.id: r.component_id for r in neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    sets = {i: shingles(t) for i, t in rows if i in got}
    links = [(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    want = classes(sets, links)
    assert len(links) > 300 and len(set(want.values())) > 1
    assert sum(got[i] == want[i] for i in got) >= 0.97 * len(got)
    assert all(want[a] == want[b] for a in got for b in got if got[a] == got[b])


@pytest.mark.parametrize("make", [documents, empty])
def test_fingerprints_and_classes(spark, make):
    docs = make(spark)
    rows = neardup.fingerprint_classes(neardup.fingerprints(docs)).collect()
    texts = [(r.doc_id, naive_fingerprint(r.text)) for r in docs.collect()]
    assert sorted((r.doc_id or 0, r.fp % 2**64) for r in rows) == sorted((i or 0, f) for i, f in texts)
    near = [(a, b) for a in range(len(texts)) for b in range(a) if (texts[a][1] ^ texts[b][1]).bit_count() <= 3]
    comp = classes(range(len(texts)), near)
    small = {c: min((texts[i][0] for i in comp if comp[i] == c and texts[i][0] is not None), default=None) for c in set(comp.values())}
    want = sorted((texts[i][0] or 0, small[c] or 0) for i, c in comp.items())
    assert sorted((r.doc_id or 0, r.component_id or 0) for r in rows) == want


def test_op4_against_brute_force(spark, sf_dir):
    got = neardup.op4_simhash(spark, sf_dir).collect()
    fp = {r.doc_id: naive_fingerprint(r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    ids = sorted(fp)
    comp = classes(ids, [(a, b) for a in ids for b in ids if a < b and (fp[a] ^ fp[b]).bit_count() <= 3])
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in got} == {i: (f"{fp[i]:016x}", comp[i]) for i in ids}


def shingles(text):
    w = (text or "").lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def test_near_duplicates_hold_similar_texts_and_no_others(spark):
    random.seed(4)
    word = lambda: "".join(random.choice("abcdefghij") for _ in range(6))
    rows, i = [], 0
    for _ in range(25):
        base = [word() for _ in range(random.choice([30, 120, 400]))]
        for k in range(4):
            w = list(base)
            for _ in range(k * len(w) // 120):
                w[random.randrange(len(w))] = word()
            rows.append((i, " ".join(w)))
            i += 1
    rows += [(i, None), (i + 1, ""), (i + 2, rows[0][1])]
    got = {r.id: r.component_id for r in neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    sets = {k: shingles(t) for k, t in rows if k in got}
    sim = lambda a, b: len(sets[a] & sets[b]) / max(1, len(sets[a] | sets[b]))
    pairs = [(a, b) for a in sets for b in sets if a < b and sim(a, b) >= 0.8]
    want = classes(sets, pairs)
    assert all(want[a] == want[b] for a in got for b in got if a < b and got[a] == got[b])
    assert sum(got[a] == got[b] for a, b in pairs) >= 0.95 * len(pairs) and len(pairs) > 20


def test_repeated_lines_do_not_part_similar_texts(spark):
    """The same line once or many times: nearly equal sets, so the fingerprints are close and the texts are one class."""
    random.seed(9)
    word = lambda: "".join(random.choice("abcdefghij") for _ in range(6))
    rows = []
    for i in range(0, 60, 2):
        base, line = [word() for _ in range(200)], [word() for _ in range(12)]
        rows += [(i, " ".join(base + line)), (i + 1, " ".join(base + line * random.choice([5, 10, 20])))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    fps = {r.id: [r[f"fp{k}"] for k in range(4)] for r in neardup.signatures(docs).collect()}
    bits = [sum(((a ^ b) % 2**64).bit_count() for a, b in zip(fps[i], fps[i + 1], strict=True)) for i in range(0, 60, 2)]
    assert max(bits) <= 72
    got = {r.id: r.component_id for r in neardup.near_duplicates(docs).collect()}
    assert got == {i: i - i % 2 for i in range(60)}


def test_cut_and_appended_copies_are_all_found(spark):
    """At 0.8 or just above fingerprints miss some; every pair is found nevertheless, and none below."""
    random.seed(10)
    word = lambda: "".join(random.choice("abcdefghij") for _ in range(6))
    rows = []
    for i in range(0, 800, 2):
        base = [word() for _ in range(random.choice([40, 100, 300]))]
        n = len(base) - 4
        k = n * 4 // 5 + (n * 4 % 5 > 0) + 4 - (i % 10 == 8)
        rows += [(i, " ".join(base)), (i + 1, " ".join(base[:k] if i % 4 else base[-k:]))]
    got = {r.id: r.component_id for r in neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    sets = {i: shingles(t) for i, t in rows}
    alike = lambda i: len(sets[i] & sets[i + 1]) >= 0.8 * len(sets[i] | sets[i + 1])
    assert sum(alike(i) for i in range(0, 800, 2)) == 320
    assert got == {i: i - 1 if i % 2 and alike(i - 1) else i for i in range(800)}


def test_classes_of_the_whole_table(spark, sf_dir):
    """Every pair of documents with a shingle in common, by brute force."""
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    sets, holders, links = {i: shingles(t) for i, t in docs.items()}, {}, set()
    for i in sorted(sets):
        common = Counter(j for s in sets[i] for j in holders.get(s, ()))
        links |= {(j, i) for j, n in common.items() if n >= 0.8 * (len(sets[i]) + len(sets[j]) - n)}
        for s in sets[i]:
            holders.setdefault(s, []).append(i)
    empty_ones = [i for i in sorted(sets) if not sets[i]]
    want = classes(docs, [*links, *zip(empty_ones, empty_ones[1:], strict=False)])
    small = {t: min(i for i in docs if docs[i] == t) for t in set(docs.values())}
    got = {r.id: r.component_id for r in neardup.near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet")).collect()}
    assert got == {i: want[i] for i in small.values()} and len(set(got.values())) < len(got)


def test_ids_that_stand_for_several_texts(spark):
    """Texts are compared and kept as if they had ids of their own; a class has the smallest doc_id and one text stays."""
    random.seed(12)
    base = [[f"w{random.randrange(10**6)}" for _ in range(80)] for _ in range(6)]
    rows = []
    for i in range(60):
        w = list(random.choice(base))
        for _ in range(random.randrange(4)):
            w[random.randrange(80)] = f"e{random.randrange(10**6)}"
        rows.append((i % 9, " ".join(w)))
    rows += rows[:5]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    texts = sorted({t for _, t in rows})
    small = {t: min(i for i, x in rows if x == t) for t in texts}
    sets = [shingles(t) for t in texts]
    comp = classes(range(len(texts)), [(a, b) for a in range(len(texts)) for b in range(a) if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])])
    name = {c: min(small[texts[k]] for k in comp if comp[k] == c) for c in set(comp.values())}
    got = neardup.near_duplicates(docs).collect()
    key = {__import__("hashlib").md5(t.encode()).hexdigest(): k for k, t in enumerate(texts)}
    assert {key[r.text_key]: (r.id, r.component_id) for r in got} == {k: (small[texts[k]], name[c]) for k, c in comp.items()}
    assert len(name) < len(texts) and sorted(comp[key[r.text_key]] for r in got if r.stands) == sorted(name)
    kept = neardup.one_of_each(docs).collect()
    assert sorted(comp[texts.index(r.text)] for r in kept) == sorted(name)


def test_unrelated_texts_change_no_class(spark):
    """The same classes whether the texts are alone or among many others that share their buckets and common lines."""
    random.seed(13)
    line = " ".join(f"licence{k}" for k in range(30))
    base = [[f"w{random.randrange(10**6)}" for _ in range(60)] for _ in range(30)]
    rows = []
    for i, b in enumerate(base):
        for k in range(3):
            w = list(b)
            for _ in range(2 * k):
                w[random.randrange(60)] = f"e{random.randrange(10**6)}"
            rows.append((i * 3 + k, " ".join(w) + " " + line))
    others = [(10_000 + i, " ".join(f"x{random.randrange(10**6)}" for _ in range(60)) + " " + line) for i in range(1500)]
    of = lambda r: {x.id: x.component_id for x in neardup.near_duplicates(spark.createDataFrame(r, "doc_id long, text string")).collect() if x.id < 10_000}
    alone = of(rows)
    sets = {i: shingles(t) for i, t in rows}
    assert alone == classes(sets, [(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])])
    assert of(rows + others) == alone and len(set(alone.values())) > 30


@pytest.mark.parametrize("make", [documents, empty])
def test_one_of_each_keeps_columns_and_rows(spark, make):
    docs = make(spark)
    kept = neardup.one_of_each(docs)
    assert kept.columns == docs.columns
    want = [] if make is empty else [1, 3, 6, 8, 10, 11, None]
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(map(str, want))


def test_nothing_that_grows_is_sent_by_way_of_the_driver(spark):
    """F1: keys are some fifty rows for each fingerprint, but Spark took them for one each and broadcast them, 1 GB at 0.5 GB of input."""
    rng = random.Random(5)
    fps = [rng.randrange(-(1 << 62), 1 << 62) for _ in range(400)]
    rows = spark.createDataFrame([(i, f ^ (i % 3 and 1 << i % 60)) for i, f in enumerate(f for f in fps for _ in range(3))], "doc_id long, fp long")
    spark.conf.set("spark.sql.maxBroadcastTableSize", "64k")
    try:
        got = {r.doc_id: r.component_id for r in neardup.fingerprint_classes(rows).collect()}
    finally:
        spark.conf.unset("spark.sql.maxBroadcastTableSize")
    assert got == {i: i - i % 3 for i in range(1200)}
