"""Near-duplicates by MinHash with tensored banding.

Two collections of ``m`` band values each are computed, every value from ``t``
minima. A table key is a pair of one value of either collection, so m * m
tables of 2t rows come from 2 * m * t minima instead of 2 * m * m * t. Texts
with equal shingle sets are one class from the start; candidates are checked
on whole shingle sets.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm import words as W
from starloom.llm.components import components
from starloom.session import materialise


@dataclass(frozen=True)
class Settings:
    """``percent`` is the least similarity of a link.

    Two texts of similarity s meet in a table with probability
    (1 - (1 - s ** t) ** m) ** 2: 0.99993 at 0.85 and more above. Of texts that
    meet in a table with several components, those are compared that also share
    one of ``fine_m`` bands of ``fine_t`` minima: 0.99995 at 0.85, 0.001 at 0.4.
    """

    words: int = 5
    percent: int = 85
    t: int = 4
    m: int = 14
    fine_t: int = 12
    fine_m: int = 64


def shingles(column: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each text, lower-cased: hashes, and where each text's begin."""
    data, offsets = W.text_bytes(column)
    words = W.find_words(data, offsets, lower=True)
    hashes, counts = words.hashes(), words.counts
    at = W.windows(words, n)
    docs = words.docs()[at]
    values = W.sequence_hashes(hashes, n)[at]
    short = np.flatnonzero((counts > 0) & (counts < n))
    if len(short):
        whole = np.array([W.sequence_hashes(hashes[words.first[d] : words.first[d + 1]], int(counts[d]))[0] for d in short], np.uint64)
        place = np.searchsorted(docs, short)
        docs, values = np.insert(docs, place, short), np.insert(values, place, whole)
    salt = W.mix(np.arange(len(counts), dtype=np.uint64) + np.uint64(1))
    new = ~W.twins(values ^ salt[docs])[1]
    return values[new], np.searchsorted(docs[new], np.arange(len(counts) + 1))


def _bands(values: np.ndarray, begins: np.ndarray, m: int, t: int, seed: int) -> np.ndarray:
    """For each set m values, each made of t minima. Sets stand one after the other and are not empty."""
    rng = np.random.default_rng(seed)
    factors = rng.integers(1, 1 << 63, (m, t), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    bands = np.zeros((len(begins), m), np.uint64)
    for k in range(m if len(begins) else 0):
        for factor in factors[k]:
            least = np.minimum.reduceat((values * factor) >> np.uint64(16), begins)
            bands[:, k] = W.mix(bands[:, k] * np.uint64(0x9E3779B97F4A7C15) + least + np.uint64(k + 1))
    return bands


def _sketch(column: pa.Array, s: Settings) -> list[pa.Array]:
    values, first = shingles(column, s.words)
    sizes = np.diff(first)
    some = np.flatnonzero(sizes)
    sums = []
    for seed in (1, 2):
        total = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(W.mix(values + np.uint64(seed)), out=total[1:])
        sums.append(np.diff(total[first]).view(np.int64))
    bands = _bands(values, first[some], 2 * s.m, s.t, 11)
    counts = np.where(sizes > 0, 2 * s.m, 0)
    return [pa.array(sizes.astype(np.int64)), pa.array(sums[0]), pa.array(sums[1]), W.lists(bands.view(np.int64).ravel(), counts)]


SKETCH = [
    T.StructField("n_shingles", T.LongType(), False),
    T.StructField("set_a", T.LongType(), False),
    T.StructField("set_b", T.LongType(), False),
    T.StructField("bands", T.ArrayType(T.LongType()), False),
]


def _sets(column: pa.Array, n: int) -> list[pa.Array]:
    values, first = shingles(column, n)
    return [pa.array([np.sort(values[i:j]).tobytes() for i, j in zip(first[:-1], first[1:])], pa.binary())]


def _fine(rows, s: Settings):
    for batch in rows:
        column = batch.column("set")
        for i in range(0, batch.num_rows, 256):
            part = [np.frombuffer(x.as_buffer(), np.uint64) for x in column.slice(i, 256)]
            sizes = np.array([len(x) for x in part])
            bands = _bands(np.concatenate(part), np.cumsum(sizes) - sizes, s.fine_m, s.fine_t, 12)
            lists = W.lists(bands.view(np.int64).ravel(), np.full(len(part), s.fine_m))
            yield pa.RecordBatch.from_arrays([batch.column("rep").slice(i, 256), lists], ["rep", "bands"])


def _count_common(rows):
    for batch in rows:
        common, total = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
        for i, (x, y) in enumerate(zip(batch.column("set_x"), batch.column("set_y"), strict=True)):
            both = np.concatenate([np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)])
            both.sort()
            common[i] = (both[1:] == both[:-1]).sum()
            total[i] = len(both) - common[i]
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(common), pa.array(total)], ["a", "b", "common", "total"])


def _with_sets(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    x, y = sets.toDF("a", "set_x"), sets.toDF("b", "set_y")
    return pairs.join(x, "a").join(y, "b").select(*pairs.columns, "set_x", "set_y")


def _compare(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Sizes of intersection and union of the whole sets of each pair."""
    return _with_sets(pairs.select("a", "b"), sets).mapInArrow(_count_common, "a long, b long, common long, total long")


def _differences(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """What tells b from a: shingles lost and added, as ``features``; sizes as in ``_compare``.

    Let two texts x and y lose r and add a shingles against a hub that y is not
    linked with. If x and y are linked, they share more than
    (100 r + percent a) / (100 + percent) of the features of x, r and a being
    those of x. So of any ``spare`` features of x, y has one at least.
    """

    def tell(rows):
        for batch in rows:
            out = []
            for x, y in zip(batch.column("set_x"), batch.column("set_y"), strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                lost, added = np.setdiff1d(x, y, assume_unique=True), np.setdiff1d(y, x, assume_unique=True)
                common = len(x) - len(lost)
                spare = len(lost) + len(added) - (100 * len(lost) + percent * len(added)) // (100 + percent)
                out.append((common, len(x) + len(y) - common, spare, np.concatenate([W.mix(lost ^ np.uint64(1)), added])))
            features = W.lists(np.concatenate([o[3] for o in out]).view(np.int64), np.array([len(o[3]) for o in out])) if out else pa.array([], pa.list_(pa.int64()))
            numbers = [pa.array([o[k] for o in out], pa.int64()) for k in range(3)]
            names = ["a", "b", "inner", "common", "total", "spare", "features"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names[:3]), *numbers, features], names)

    return _with_sets(pairs, sets).mapInArrow(tell, "a long, b long, inner boolean, common long, total long, spare long, features array<long>")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept.

    Texts without words are linked with nothing, a row without an id neither:
    it has no component and is kept. Texts of equal sets are one class,
    represented by its smallest id; ids are meant to be unique, and an id with
    several texts is linked where one of them is.

    First every bucket links its members with its smallest one. Then, of the
    members of a bucket that are still in different components, those are
    compared across components that finer bands bring together: the first
    texts of the components, and members that share a rare difference from
    one of them. Pairs that this leaves out provably are no links, pairs within
    a component need no check, and a group of n near copies costs about n pairs.
    """
    s = settings
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    prints = materialise(W.map_texts(rows, "text", SKETCH, lambda batch: _sketch(batch.column("text"), s), drop=("text",)))
    named = prints.filter("n_shingles > 0 and doc_id is not null")
    key = ["n_shingles", "set_a", "set_b"]
    classes = materialise(named.groupBy(*key).agg(F.min("doc_id").alias("rep"), F.first("bands").alias("bands")))

    # Values that one class alone has cannot meet; only shared ones form keys.
    values = classes.select("rep", F.col("n_shingles").alias("size"), F.posexplode("bands").alias("k", "value"))
    often = values.groupBy("value").count().filter("count > 1").select("value")
    shared = values.join(often, "value").groupBy("rep", "size").agg(
        F.collect_list(F.when(F.col("k") < s.m, F.col("value"))).alias("first"),
        F.collect_list(F.when(F.col("k") >= s.m, F.col("value"))).alias("second"),
    )
    buckets = materialise(
        shared.withColumn("x", F.explode("first")).withColumn("y", F.explode("second"))
        .select("rep", "size", F.xxhash64("x", "y").alias("key"))
    )
    heads = buckets.groupBy("key").agg(F.min(F.struct("rep", "size")).alias("head"), F.count("*").alias("n")).filter("n > 1")
    met = buckets.join(heads.select("key", "head"), "key")
    fits = lambda x, y: F.least(x, y) * 100 >= F.greatest(x, y) * s.percent
    stars = materialise(
        met.filter(F.col("rep") != F.col("head.rep")).filter(fits(F.col("size"), F.col("head.size")))
        .select(F.col("head.rep").alias("a"), F.col("rep").alias("b")).distinct()
    )
    wanted = met.select("rep").distinct()
    sets = materialise(
        W.map_texts(
            rows.filter("doc_id is not null").join(wanted.withColumnRenamed("rep", "doc_id"), "doc_id", "left_semi").withColumnRenamed("doc_id", "rep"),
            "text", [T.StructField("set", T.BinaryType(), False)], lambda batch: _sets(batch.column("text"), s.words), drop=("text",),
        )
    )
    linked = F.col("common") * 100 >= F.col("total") * s.percent
    near = materialise(_compare(stars, sets).filter(linked).select("a", "b"))
    grouped = materialise(components(near))

    # Texts whose bucket holds several components are compared across them.
    label = grouped.withColumnRenamed("node", "rep")
    placed = met.select("key", "rep").join(label, "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    several = lambda df: df.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low < high").select("key")
    open_ = materialise(placed.join(several(placed), "key", "left_semi").select("rep", "component").distinct())
    fine = sets.join(open_.select("rep"), "rep", "left_semi").mapInArrow(lambda batches: _fine(batches, s), "rep long, bands array<long>")
    placed = materialise(fine.select("rep", F.explode("bands").alias("key")).join(open_, "rep"))
    placed = placed.join(several(placed), "key", "left_semi")
    # Distances 1 - s obey the triangle inequality: members of two components
    # can only be linked if the components' first texts are not too far apart.
    distance = 1 - F.col("common") / F.col("total")
    inner = open_.filter("rep <> component").select(F.col("component").alias("a"), F.col("rep").alias("b"))
    away = _compare(inner, sets).select(F.col("a").alias("component"), distance.alias("away"))
    reach = materialise(away.groupBy("component").agg(F.max("away").alias("reach"), F.count("*").alias("n")))
    parts = placed.select("key", "component").distinct()
    sides = parts.withColumnRenamed("component", "a").join(parts.withColumnRenamed("component", "b"), "key").filter("a < b")
    firsts = materialise(_compare(sides.select("a", "b").distinct(), sets))
    close = (
        firsts.join(reach.toDF("a", "a_reach", "a_n"), "a", "left").join(reach.toDF("b", "b_reach", "b_n"), "b", "left")
        .na.fill(0).filter((F.col("a_n") + F.col("b_n") > 0) & (distance <= F.col("a_reach") + F.col("b_reach") + 1 - s.percent / 100 + 1e-9))
    )
    first_is_hub = F.col("a_n") >= F.col("b_n")
    hubs = materialise(close.select(F.when(first_is_hub, F.col("a")).otherwise(F.col("b")).alias("hub"), F.when(first_is_hub, F.col("b")).otherwise(F.col("a")).alias("component")))
    outer = hubs.join(open_, "component").select(F.col("hub").alias("a"), F.col("rep").alias("b"), F.lit(False).alias("inner"))
    inner = inner.join(hubs.select(F.col("hub").alias("a")).distinct(), "a", "left_semi").withColumn("inner", F.lit(True))
    told = materialise(_differences(inner.union(outer), sets, s.percent))
    mine = told.filter("inner").select("a", "b", "spare", F.explode("features").alias("feature"))
    rare = mine.join(mine.groupBy("a", "feature").count(), ["a", "feature"])
    nth = F.row_number().over(Window.partitionBy("a", "b").orderBy("count", "feature"))
    marks = rare.withColumn("nth", nth).filter("nth <= spare").select("a", "feature", F.col("b").alias("x"))
    theirs = told.filter("not inner").select("a", F.col("b").alias("y"), F.explode("features").alias("feature"))
    pairs = marks.join(theirs, ["a", "feature"]).select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
    across = _compare(pairs.join(stars, ["a", "b"], "left_anti"), sets)
    direct = told.filter("not inner").select("a", "b", "common", "total")
    more = materialise(firsts.unionByName(direct).unionByName(across).filter(linked).select("a", "b"))
    if not more.isEmpty():
        grouped = materialise(components(near.union(more)))

    found = classes.select(*key, "rep").join(grouped.withColumnRenamed("node", "rep"), "rep", "left").select(
        *key, F.coalesce("component", "rep").alias("component_id")
    )
    return (
        prints.withColumn("named", F.when(F.col("doc_id").isNotNull(), F.col("n_shingles")).otherwise(F.lit(0)))
        .join(found.withColumnRenamed("n_shingles", "named"), ["named", "set_a", "set_b"], "left")
        .select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )
