"""Main text of web pages by wrapper induction.

Pages of one host and layout are aligned: the most frequent tree of the layout
is the reference, and simple tree matching (the largest order-preserving
matching of equal labels) finds for every other tree which node is which node
of the reference. A node whose text is the same on all pages is template, one
whose text varies is a slot. The article's slots are content; parts that name
themselves as menus, notices or the like are not, wherever they vary.

Trees are small (see ``pages``) and few per layout; statistics per node are
pre-aggregated in the tasks that parse, so a host with a third of all pages is
a few rows per task. Pages meet their wrapper by a join in which hot hosts go by broadcast.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm import words as W
from starloom.llm.pages import Page, kind, parse
from starloom.operators.joins import lookup
from starloom.session import materialise

#: Pages that a node must be on before equal text makes it template.
SUPPORT = 3
#: Share of its nodes that a page's tree must have in common with the reference.
ALIKE = 0.5
#: Without an article element the content is the deepest part with this share of the text.
MOST = 0.7
#: Elements of running text: inside an article they stay even if all pages agree (their authors may repeat a line).
FLOW = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd td th blockquote pre figcaption article main body".split())


@dataclass
class Slots:
    """What pages have at each node of a tree."""

    pages: np.ndarray
    same: np.ndarray
    chars: np.ndarray
    linked: np.ndarray


@dataclass
class Wrapper:
    """Per node: whether its text is content, and whether new nodes below it are."""

    keep: list[bool]
    inside: list[bool]


def host_of(url: str | None) -> str:
    found = re.search(r"://([^/?#]*)", url or "")
    return found[1].lower() if found else ""


def _aside(parents: list[int], labels: list[str]) -> tuple[list[bool], list[bool]]:
    """Which nodes lie beside the article, and which in an article element.

    A part that holds all articles is not beside them, whatever its name.
    """
    kinds = [kind(label) for label in labels]
    holds = [0] * len(labels)
    for i in range(len(labels) - 1, 0, -1):
        holds[parents[i]] += holds[i] + (kinds[i] in ("article", "main"))
    aside, within = [False] * len(labels), [False] * len(labels)
    for i in range(1, len(labels)):
        above = parents[i]
        beside = not (0 < holds[i] == holds[0]) and (kinds[i] == "aside" or (kinds[i] == "head" and not within[above]))
        aside[i] = aside[above] or beside
        within[i] = not aside[i] and (within[above] or kinds[i] == "article")
    if not any(within):
        for i in range(1, len(labels)):
            within[i] = not aside[i] and (within[parents[i]] or kinds[i] == "main")
    return aside, within


def induce(parents: list[int], labels: list[str], slots: Slots) -> Wrapper:
    """The wrapper of a layout from the statistics of its reference tree."""
    size = len(labels)
    aside, within = _aside(parents, labels)
    constant = [bool(slots.pages[i] >= SUPPORT and slots.same[i]) for i in range(size)]
    if any(w and slots.chars[i] for i, w in enumerate(within)):
        keep = [w and not (constant[i] and labels[i].split("|")[0] not in FLOW) for i, w in enumerate(within)]
        return Wrapper(keep, within)
    weight = [0 if aside[i] or constant[i] else max(0, int(slots.chars[i] - 2 * slots.linked[i])) for i in range(size)]
    for i in range(size - 1, 0, -1):
        weight[parents[i]] += weight[i]
    root, total = 0, weight[0]
    for i in range(1, size):  # a node comes after the one above it
        if parents[i] == root and weight[i] >= MOST * total > 0 and labels[i].split("|")[0] not in FLOW:
            root = i
    inside = [False] * size
    inside[root] = total > 0
    for i in range(root + 1, size):
        inside[i] = inside[parents[i]] and not aside[i]
    return Wrapper([x and not constant[i] for i, x in enumerate(inside)], inside)


def match(parents: list[int], labels: list[str], ref_parents: list[int], ref_labels: list[str]) -> list[int]:
    """Simple tree matching: for each node its node of the reference, or -1."""
    below, ref_below = ([[] for _ in x] for x in (labels, ref_labels))
    for under, above in ((below, parents), (ref_below, ref_parents)):
        for i, p in enumerate(above[1:], 1):
            under[p].append(i)
    tables: dict[tuple[int, int], list[list[int]]] = {}

    def score(a: int, b: int) -> int:
        if labels[a] != ref_labels[b]:
            return 0
        table = [[0] * (len(ref_below[b]) + 1)]
        for x in below[a]:
            row, above = [0], table[-1]
            for j, y in enumerate(ref_below[b]):
                row.append(max(above[j + 1], row[j], above[j] + (score(x, y) if labels[x] == ref_labels[y] else 0)))
            table.append(row)
        tables[a, b] = table
        return table[-1][-1] + 1

    out = [-1] * len(labels)
    score(0, 0)
    pending = [(0, 0)]
    while pending:
        a, b = pending.pop()
        out[a] = b
        table, i, j = tables[a, b], len(below[a]), len(ref_below[b])
        while i and j:
            if table[i][j] == table[i - 1][j]:
                i -= 1
            elif table[i][j] == table[i][j - 1]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                pending.append((below[a][i], ref_below[b][j]))
    return out


@lru_cache(maxsize=4096)
def _tree(tree: str) -> tuple[list[int], list[str]]:
    parents, labels = json.loads(tree)
    return parents, labels


@lru_cache(maxsize=16384)
def _matched(tree: str, reference: str) -> list[int]:
    return match(*_tree(tree), *_tree(reference))


def _own_slots(nodes: int, blocks: list[tuple[int, int, int]]) -> Slots:
    """Statistics of one page: blocks are (node, characters, characters in links)."""
    chars, linked = np.zeros(nodes, np.int64), np.zeros(nodes, np.int64)
    for node, n, m in blocks:
        chars[node] += n
        linked[node] += m
    return Slots(np.ones(nodes, np.int64), np.zeros(nodes, bool), chars, linked)


_BLOCK = T.StructType([T.StructField("node", T.IntegerType()), T.StructField("text", T.StringType()), T.StructField("linked", T.IntegerType())])


def _layout(page: Page) -> str:
    """Labels above the article, empty without one: pages of one layout share a wrapper."""
    _, within = _aside(page.parents, page.labels)
    node = next((i for i, w in enumerate(within) if w), 0)
    path = []
    while node > 0:
        path.append(page.labels[node])
        node = page.parents[node]
    return "/".join(reversed(path))


def _parsed(chunk: pa.RecordBatch) -> pa.RecordBatch:
    hosts, layouts, trees, nodes, texts, linked, counts = [], [], [], [], [], [], []
    for url, page in zip(chunk.column("url").to_pylist(), chunk.column("html")):
        made = parse(page.as_py() or "")
        hosts.append(host_of(url))
        layouts.append(_layout(made))
        trees.append(json.dumps([made.parents, made.labels], separators=(",", ":"), ensure_ascii=False))
        counts.append(len(made.blocks))
        for node, text, n in made.blocks:
            nodes.append(node), texts.append(text), linked.append(n)
    blocks = pa.StructArray.from_arrays(
        [pa.array(nodes, pa.int32()), pa.array([t.encode("utf-8", "replace") for t in texts], pa.binary()).cast(pa.string()), pa.array(linked, pa.int32())],
        names=_BLOCK.names,
    )
    arrays = [chunk.column("row"), pa.array(hosts, pa.string()), pa.array(layouts, pa.string()), pa.array(trees, pa.string()), W.lists(blocks, np.array(counts, np.int64))]
    return pa.RecordBatch.from_arrays(arrays, ["row", "host", "layout", "tree", "blocks"])


_STATS = "host string, layout string, tree string, node int, pages long, low long, high long, chars long, linked long"
_NAMES = [c.split()[0] for c in _STATS.split(", ")]
_TYPES = [{"string": pa.string(), "int": pa.int32(), "long": pa.int64()}[c.split()[1]] for c in _STATS.split(", ")]


def _statistics(batch: pa.RecordBatch) -> dict[tuple, list[int]]:
    """Per (host, layout, tree, node): pages, smallest and greatest hash of its text, characters, characters in links."""
    out: dict[tuple, list[int]] = {}
    for host, layout, tree, blocks in zip(*(batch.column(c).to_pylist() for c in ("host", "layout", "tree", "blocks"))):
        mine: dict[int, list] = {}
        for block in blocks:
            node = mine.setdefault(block["node"], [hashlib.blake2b(digest_size=8), 0, 0])
            node[0].update(block["text"].encode() + b"\0")
            node[1] += len(block["text"])
            node[2] += block["linked"]
        mine.setdefault(0, [hashlib.blake2b(digest_size=8), 0, 0])  # every page counts at the body
        for node, (digest, chars, linked) in mine.items():
            h = int.from_bytes(digest.digest(), "little", signed=True)
            have = out.setdefault((host, layout, tree, node), [0, h, h, 0, 0])
            have[:] = [have[0] + 1, min(have[1], h), max(have[2], h), have[3] + chars, have[4] + linked]
    return out


def _as_rows(found: dict[tuple, list[int]]) -> pa.RecordBatch:
    columns = list(zip(*[(*k, *v) for k, v in found.items()])) or [[]] * len(_NAMES)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _TYPES)], _NAMES)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(0, batch.num_rows, 512):
            yield _as_rows(_statistics(batch.slice(i, 512)))


def _align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Statistics of a tree's nodes as those of the reference's nodes."""
    for batch in batches:
        nodes = [_matched(t, r)[n] for t, r, n in zip(*(batch.column(c).to_pylist() for c in ("tree", "reference", "node")))]
        arrays = [pa.array(nodes, pa.int32()) if c == "node" else batch.column("reference" if c == "tree" else c) for c in _NAMES]
        rows = pa.RecordBatch.from_arrays(arrays, _NAMES)
        yield rows.filter(pa.array(np.array(nodes, np.int64) >= 0))


_NODE = ("node", "pages", "low", "high", "chars", "linked")


def _merged(rows: DataFrame) -> DataFrame:
    return rows.groupBy("host", "layout", "tree", "node").agg(
        F.sum("pages").alias("pages"), F.min("low").alias("low"), F.max("high").alias("high"), F.sum("chars").alias("chars"), F.sum("linked").alias("linked")
    )


def wrappers(parsed: DataFrame) -> DataFrame:
    """One row per host and layout: reference tree and the statistics of its nodes (``slots``)."""
    stats = materialise(_merged(parsed.select("host", "layout", "tree", "blocks").mapInArrow(_count, _STATS)))
    often = F.struct(F.col("pages"), F.col("tree"))
    references = stats.filter("node = 0").groupBy("host", "layout").agg(F.max_by("tree", often).alias("reference"))
    aligned = lookup(stats, references, ["host", "layout"]).mapInArrow(_align, _STATS)
    return _merged(aligned).groupBy("host", "layout").agg(
        F.first("tree").alias("reference"), F.collect_list(F.struct(*_NODE)).alias("slots")
    )


@lru_cache(maxsize=4096)
def _induced(reference: str, slots: tuple[tuple[int, ...], ...]) -> Wrapper:
    parents, labels = _tree(reference)
    made = Slots(*(np.zeros(len(labels), np.int64) for _ in range(4)))
    for node, pages, low, high, chars, linked in slots:
        made.pages[node], made.same[node], made.chars[node], made.linked[node] = pages, low == high, chars, linked
    return induce(parents, labels, made)


def _kept(tree: str, blocks: list[tuple[int, int, int]], reference: str | None, slots) -> list[bool]:
    """Which nodes of a page hold content."""
    parents, labels = _tree(tree)
    if reference is not None:
        found = _matched(tree, reference)
        common = sum(r >= 0 for r in found)
        wrapper = _induced(reference, slots)
        if common >= ALIKE * max(len(labels), len(_tree(reference)[1])) and any(r >= 0 and wrapper.inside[r] for r in found):
            aside, within = _aside(parents, labels)
            keep, inside = [], []
            for i, r in enumerate(found):
                inside.append(wrapper.inside[r] if r >= 0 else within[i] or (i > 0 and inside[parents[i]] and not aside[i]))
                keep.append(wrapper.keep[r] if r >= 0 else inside[i])
            return keep
    return induce(parents, labels, _own_slots(len(labels), blocks)).keep


def _extract(chunk: pa.RecordBatch) -> tuple[list[str], list[int]]:
    texts = []
    columns = ("tree", "blocks", "reference", "slots")
    for tree, blocks, reference, slots in zip(*(chunk.column(c).to_pylist() for c in columns)):
        stats = None if slots is None else tuple(sorted(tuple(s[c] for c in _NODE) for s in slots))
        keep = _kept(tree, [(b["node"], len(b["text"]), b["linked"]) for b in blocks], reference, stats)
        texts.append(" ".join([b["text"] for b in blocks if keep[b["node"]]]))
    return texts, [len(t) for t in texts]


def main_text(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """Adds ``text`` (empty if none) and ``n_chars`` to each row and drops the page's html.

    Blocks of the main text are joined by one space in page order, with
    character references decoded and white space as one space. Null and empty
    pages have no text; a null url or one without ``://`` is of the host "".
    Equal rows count as so many pages and get equal results. A page of any
    length is read whole and is the most that a task holds. Columns named
    ``text`` or ``n_chars`` are replaced.
    """
    kept = [c for c in pages.columns if c.lower() not in (html.lower(), "text", "n_chars")]
    rows = pages.select(F.struct(*kept).alias("row"), F.col(url).cast("string").alias("url"), F.col(html).cast("string").alias("html"))
    schema = T.StructType([
        rows.schema["row"], T.StructField("host", T.StringType()), T.StructField("layout", T.StringType()), T.StructField("tree", T.StringType()),
        T.StructField("blocks", T.ArrayType(_BLOCK)),
    ])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in W.chunks(batch, "html"):
                yield _parsed(chunk)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                chunk = batch.slice(i, 256)
                texts, sizes = _extract(chunk)
                yield pa.RecordBatch.from_arrays([chunk.column("row"), pa.array(texts, pa.string()), pa.array(sizes, pa.int64())], ["row", "text", "n_chars"])

    parsed = materialise(rows.mapInArrow(read, schema))
    joined = lookup(parsed, materialise(wrappers(parsed)), ["host", "layout"], "left")
    done = joined.select("row", "tree", "blocks", "reference", "slots").mapInArrow(
        write, T.StructType([rows.schema["row"], T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])
    )
    return done.select("row.*", "text", "n_chars")
