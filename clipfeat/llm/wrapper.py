"""Main text of web pages, by wrapper induction.

Pages of a host are made from templates. The block-level tree of each page is aligned with that of the host's most common
shape by simple tree matching, so a text has a slot there. Texts that more than half of the host's pages have in one slot are its template;
slots whose texts are mostly links are its menus; the subtree that holds nine tenths of what varies is where the articles are.
Where a page itself says what is article and what is beside it (elements, roles, class names) that decides first. A host
with fewer than ``LEAST`` different pages has no wrapper, and its pages are judged by the same measures on their own.

Pages that are copies of one another would make their article look like a template, so of pages that share the smallest
hash of three words one is counted (as copies with a few changes mostly do); and what is constant is left in if it is most of an article. All pages of a host count, in sums that are
partial before the shuffle: what a page sends is the hashes of its blocks, and what is left of a host is one row of the size of its template.

Cases: a null or empty html has no text; cut-off markup counts as closed at its end; pages without a host have no wrapper;
repeated rows get equal texts; a null page_id or url is kept; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import json
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .dom import Page, matched, parse, read_skeleton
from .shared import staged, table
from .words import shingle_hashes

#: Different pages from which a host's template can be told.
LEAST = 4
#: Bytes of wrappers that are sent to every task; more of them meet the pages in a join by host.
MOST_BYTES = 32_000_000


def host_of(url: Column) -> Column:
    """The host that a URL names, in lower case; empty without one."""
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)), F.lit(""))


def _hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text) - (1 << 63)


def _html(batch) -> list:
    return batch.column("html").to_pylist()


def open_blocks(page: Page) -> list[int]:
    """The blocks that are not beside the article by their elements' own words. An element that holds the article is not beside it,
    a header inside the article belongs to it, and where nothing says what the article is, a form that holds most of a page's text is the page."""
    nodes = page.nodes
    holds = [n.main for n in nodes]
    for i in range(len(nodes) - 1, 0, -1):
        holds[nodes[i].parent] |= holds[i]
    if not holds[0] and any(n.tag in ("form", "fieldset") for n in nodes):
        mass, total = [0] * len(nodes), sum(len(text) for _, text, _ in page.blocks)
        for node, text, _ in page.blocks:
            mass[node] += len(text)
        for i in range(len(nodes) - 1, 0, -1):
            mass[nodes[i].parent] += mass[i]
            holds[i] |= nodes[i].tag in ("form", "fieldset") and mass[i] * 2 > total
    inside, aside = [n.main for n in nodes], [False] * len(nodes)
    for i, n in enumerate(nodes):
        up = n.parent
        inside[i] |= up >= 0 and inside[up]
        own = n.hidden or n.aside and not (holds[i] and not n.tag == "aside") or n.head and not (holds[i] or inside[i])
        aside[i] = own or up >= 0 and aside[up]
    return [k for k, (node, _, _) in enumerate(page.blocks) if not aside[node]]


def page_shapes(pages: DataFrame) -> DataFrame:
    """(host, skeleton, alike, blocks) of the pages that have a host: slots, hashes and sizes of the blocks that may be article."""

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                shapes, alike, blocks = [], [], []
                for html in _html(part):
                    page = parse(html or "")
                    kept = [page.blocks[k] for k in open_blocks(page)]
                    found = [{"slot": page.slots[node], "h": _hash(text), "chars": len(text), "links": links} for node, text, links in kept]
                    shapes.append(page.skeleton)
                    blocks.append(found)
                    h = shingle_hashes(" ".join(text for _, text, _ in kept).encode().split(), 3)
                    alike.append(int(h.min().view(np.int64)) if len(h) else 0)
                kind = pa.list_(pa.struct([("slot", pa.int32()), ("h", pa.int64()), ("chars", pa.int64()), ("links", pa.int64())]))
                yield pa.RecordBatch.from_arrays([part.column("host"), pa.array(shapes, pa.string()), pa.array(alike, pa.int64()), pa.array(blocks, kind)], ["host", "skeleton", "alike", "blocks"])

    rows = pages.select(host_of(F.col("url")).alias("host"), "html").filter("host <> ''")
    return staged(rows.mapInArrow(run, "host string, skeleton string, alike long, blocks array<struct<slot: int, h: long, chars: long, links: long>>"), "wrapper-shapes")


def _aligned(batches):
    for pdf in batches:
        yield pd.DataFrame({"host": pdf["host"], "skeleton": pdf["skeleton"], "slots": [np.array(matched(a, b), np.int32) for a, b in zip(pdf["skeleton"], pdf["reference"], strict=True)]})


def induced(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """(host, wrapper): for each host with ``least`` different pages the skeleton of most of them and, by slot, the texts of the
    template and the characters and link characters that vary."""
    shapes = page_shapes(pages)
    # one page of those that share the smallest hash of three words
    pages_of = shapes.groupBy("host", "alike").agg(F.min_by(F.struct("skeleton", "blocks"), F.xxhash64("skeleton", "blocks")).alias("page"))
    pages_of = staged(pages_of.select("host", "page.*"), "wrapper-pages")
    common = pages_of.groupBy("host", "skeleton").agg(F.count(F.lit(1)).alias("n"))
    hosts = common.groupBy("host").agg(F.sum("n").alias("pages"), F.max_by("skeleton", F.struct("n", -F.length("skeleton"), "skeleton")).alias("reference")).filter(F.col("pages") >= least)
    hosts = staged(hosts, "wrapper-hosts")
    slots = common.join(hosts, "host").select("host", "skeleton", "reference").mapInPandas(_aligned, "host string, skeleton string, slots array<int>")
    slots = staged(slots, "wrapper-slots")
    placed = pages_of.join(slots, ["host", "skeleton"])
    of_slot = F.transform("blocks", lambda b: F.struct(F.get("slots", b["slot"]).alias("slot"), b["h"].alias("h"), b["chars"].alias("chars"), b["links"].alias("links")))
    # a text counts once a page and slot
    texts = placed.select("host", F.explode(F.array_distinct(of_slot)).alias("b")).groupBy("host", "b.slot", "b.h").agg(F.count(F.lit(1)).alias("n"), F.sum("b.chars").alias("chars"), F.sum("b.links").alias("links"))
    texts = texts.join(hosts.select("host", "pages"), "host").withColumn("same", (F.col("n") * 2 > F.col("pages")) & (F.col("n") >= least))
    varying = lambda c: F.sum(F.when(F.col("same"), 0).otherwise(F.col(c)))
    sums = texts.groupBy("host", "slot").agg(varying("chars").alias("chars"), varying("links").alias("links"), F.collect_list(F.when(F.col("same"), F.col("h"))).alias("same"))
    sums = sums.groupBy("host").agg(F.collect_list(F.struct("slot", "chars", "links", "same")).alias("slots"))
    return staged(hosts.join(sums, "host").select("host", F.to_json(F.struct("reference", "slots")).alias("wrapper")), "wrappers")


@lru_cache(512)
def read_wrapper(wrapper: str) -> dict:
    """reference, template texts and menus by slot, and the first slot of the articles and the one after their last."""
    w = json.loads(wrapper)
    slots = {s["slot"]: s for s in w["slots"]}
    same = {k: frozenset(s["same"]) for k, s in slots.items() if s["same"]}
    menus = frozenset(k for k, s in slots.items() if s["links"] * 2 > s["chars"])
    _, children, ends = read_skeleton(w["reference"])
    mass = [0] * len(ends)
    for k, s in slots.items():
        if k not in menus:
            mass[k if k >= 0 else -1 - k] += s["chars"]
    first = _where_most(mass, children, ends)
    return {"reference": w["reference"], "same": same, "menus": menus, "first": first, "end": ends[first]}


def _where_most(mass: list, children: list, ends: list, share: float = 0.9) -> int:
    """The deepest slot whose subtree holds ``share`` of all mass."""
    sums = list(np.concatenate([[0], np.cumsum(mass)]))
    total, at = sums[-1], 0
    while total and (further := [c for c in children[at] if sums[ends[c]] - sums[c] >= share * total]):
        at = further[0]
    return at


def main_blocks(page: Page, wrapper: dict | None) -> list[int]:
    """The blocks of a page that are its article, in order."""
    nodes, kept = page.nodes, open_blocks(page)
    main = [n.main for n in nodes]
    for i, n in enumerate(nodes):
        main[i] |= n.parent >= 0 and main[n.parent]
    slots = matched(page.skeleton, wrapper["reference"]) if wrapper else None
    place = (lambda k: slots[page.slots[page.blocks[k][0]]]) if slots and slots[0] == 0 else None
    same = {k for k in kept if _hash(page.blocks[k][1]) in wrapper["same"].get(place(k), ())} if place else set()
    region = [k for k in kept if main[page.blocks[k][0]]]
    articles = [i for i, n in enumerate(nodes) if n.main and n.tag == "article"]
    if region and articles and any(n.main and n.tag != "article" for n in nodes):
        # an article inside a main part is what is meant, if it holds most of it
        within = [False] * len(nodes)
        for i, n in enumerate(nodes):
            within[i] = n.main and n.tag == "article" or n.parent >= 0 and within[n.parent]
        inner = [k for k in region if within[page.blocks[k][0]]]
        region = inner if sum(len(page.blocks[k][1]) for k in inner) * 2 > sum(len(page.blocks[k][1]) for k in region) else region
    if not region:
        region = [k for k in kept if page.blocks[k][2] * 2 <= len(page.blocks[k][1])]
        if place:
            inside = lambda s: wrapper["first"] <= (s if s >= 0 else -1 - s) < wrapper["end"]
            region = [k for k in region if place(k) not in wrapper["menus"] and inside(place(k))]
        else:
            _, children, ends = read_skeleton(page.skeleton)
            mass = [0] * len(ends)
            for k in region:
                mass[page.slots[page.blocks[k][0]]] += len(page.blocks[k][1])
            first = _where_most(mass, children, ends)
            region = [k for k in region if first <= page.slots[page.blocks[k][0]] < ends[first]]
    size = lambda ks: sum(len(page.blocks[k][1]) for k in ks)
    varying = [k for k in region if k not in same]
    return varying if size(varying) * 2 > size(region) else region


def extracted(pages: DataFrame, wrappers: DataFrame) -> DataFrame:
    """(page_id, url, text): the main text of every page, its blocks parted by line ends."""
    kinds = ", ".join(f"{c} {pages.schema[c].dataType.simpleString()}" for c in ("page_id", "url"))

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                texts = []
                for html, wrapper in zip(_html(part), part.column("wrapper").to_pylist(), strict=True):
                    page = parse(html or "")
                    texts.append("\n".join(page.blocks[k][1] for k in main_blocks(page, read_wrapper(wrapper) if wrapper else None)))
                yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), pa.array(texts, pa.string())], ["page_id", "url", "text"])

    size = wrappers.agg(F.sum(F.octet_length("wrapper") + F.octet_length("host"))).first()[0] or 0
    known = wrappers.select(F.col("host").alias("_host"), "wrapper")
    known = F.broadcast(known) if size <= MOST_BYTES else known
    rows = pages.select("page_id", "url", "html").withColumn("host", host_of(F.col("url"))).join(known, F.col("host") == F.col("_host"), "left")
    return rows.select("page_id", "url", "html", "wrapper").mapInArrow(run, f"{kinds}, text string")


def op13_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wrappers of all hosts, then the main text of every page."""
    pages = table(spark, sf_dir, "pages")
    return extracted(pages, induced(pages)).withColumn("n_chars", F.length("text").cast("long"))


#: For pages that mark their article as these tables do; the operator knows others.
SQL = r"""
WITH blocks AS (
  SELECT page_id, url, list_transform(regexp_split_to_array(replace(regexp_extract(coalesce(html, ''), '(?s)<article>(.*)</article>', 1), '<br>', ' '), '</?(?:p|h1)>'),
    lambda b: trim(regexp_replace(regexp_replace(replace(replace(replace(regexp_replace(b, '<[^>]*>', '', 'g'), '&quot;', '"'), '&lt;', '<'), '&gt;', '>'), '&amp;?', '&', 'g'), '\s+', ' ', 'g'))) AS b FROM pages),
texts AS (SELECT page_id, url, array_to_string(list_filter(b, lambda x: x <> ''), chr(10)) AS text FROM blocks)
SELECT page_id, url, text, length(text) AS n_chars FROM texts
"""
