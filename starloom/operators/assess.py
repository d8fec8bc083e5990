"""Risk fusion and ranking, evaluation of scores, splits, period search, screening."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.operators.joins import lookup
from starloom.operators.series import Series, global_positions, open_series, running_totals
from starloom.session import materialise

# Confidence and risk thresholds of the threat types, norm of a
# residual that flags a fault, and shares of the default split.
CONFIDENCE = {"asteroid": 0.85, "exoplanet": 0.90}
RISK_THRESHOLD = 0.1
RESIDUAL_LIMIT = 0.05
SPLIT = (0.8, 0.1, 0.1)
#: Samples folded at once.
FOLD_ROWS = 4_096
#: Rows that a tile of a crowded cell may grow to in a large table, and such tiles' worth of rows that it is cut into before they grow.
TILE_ROWS = 16_384
TILES = 1_000
#: Pairs of tiles, or of rows if that makes fewer tasks, that a task compares about; such tasks at most.
TILE_PAIRS, ROW_PAIRS, TILE_TASKS = 4, 4_000_000, 10_000
#: Pairs that make a cell crowded, pairs compared at once, and found pairs after which a task sends them on.
CROWDED_PAIRS = 10_000
PAIRS_AT_ONCE = 100_000
PAIRS_SENT = 250_000
STATE = ["id", "x", "y", "z", "vx", "vy", "vz"]

# Risk categories; the cut-points are parameters of ours.
RISK_CATEGORIES = ("negligible", "low", "medium", "high", "critical")
RISK_CUTS = (1e-6, 1e-4, 1e-2, 1e-1)


def confident(
    df: DataFrame, type_column: str, confidence_column: str, thresholds: dict[str, float] = CONFIDENCE, otherwise: float = RISK_THRESHOLD
) -> DataFrame:
    """Keep rows whose confidence reaches the threshold of their type."""
    needed: Column = F.lit(otherwise)
    for kind, value in thresholds.items():
        needed = F.when(F.col(type_column) == kind, F.lit(value)).otherwise(needed)
    return df.filter(F.col(confidence_column) >= needed)


def risk_category(risk: Column, cuts: tuple[float, ...] = RISK_CUTS) -> Column:
    name: Column = F.lit(RISK_CATEGORIES[-1])
    for cut, category in reversed(list(zip(cuts, RISK_CATEGORIES))):
        name = F.when(risk < cut, F.lit(category)).otherwise(name)
    return name


def distance(a: str, b: str) -> Column:
    """Euclidean norm of the difference of two arrays."""
    return F.sqrt(
        F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, v: s + v)
    )


def dot(a: str, b: str) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, v: s + v)


def residual_faults(df: DataFrame, observed: str, predicted: str, limit: float = RESIDUAL_LIMIT) -> DataFrame:
    residual = distance(observed, predicted)
    return df.withColumn("residual", residual).withColumn("fault", F.col("residual") > limit)


def fused_risk(df: DataFrame, by: list[str]) -> DataFrame:
    """Weighted mean of ``risk`` with ``weight`` over the sources of an object."""
    w = F.col("weight")
    return df.groupBy(*by).agg(
        F.try_divide(F.sum(w * F.col("risk")), F.sum(w)).alias("risk"), F.count(F.lit(1)).alias("n_sources")
    )


def top_per_group(df: DataFrame, by: list[str], order: list[Column], n: int = 5) -> DataFrame:
    """The first n rows per group; map tasks pass on at most n rows per group."""
    spec = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(spec)).filter(F.col("rank") <= n)


def ranked_threats(df: DataFrame, order: list[str]) -> DataFrame:
    """Priority of every row, 1 for the first; no window over the whole table."""
    return global_positions(df, order).withColumn("priority", F.col("pos") + 1).drop("pos")


def transitions(s: Series, state: str) -> DataFrame:
    """Counts and row-wise shares of successive states; needs ``located(1)``."""
    steps = s.windowed(lambda w: {"to_state": w.ahead(state)}).rows().filter("to_state is not null")
    counts = steps.groupBy(F.col(state).alias("from_state"), "to_state").agg(F.count(F.lit(1)).alias("n"))
    row = Window.partitionBy("from_state")
    return counts.withColumn("probability", F.col("n") / F.sum("n").over(row))


def classification_report(df: DataFrame, predicted: str, actual: str) -> DataFrame:
    p, a = F.col(predicted).cast("boolean"), F.col(actual).cast("boolean")
    counts = df.agg(
        F.count_if(p & a).alias("tp"),
        F.count_if(p & ~a).alias("fp"),
        F.count_if(~p & a).alias("fn"),
        F.count_if(~p & ~a).alias("tn"),
    )
    tp, fp, fn, tn = F.col("tp"), F.col("fp"), F.col("fn"), F.col("tn")
    return counts.withColumns(
        {
            "precision": F.try_divide(tp, tp + fp),
            "recall": F.try_divide(tp, tp + fn),
            "f1": F.try_divide(2 * tp, 2 * tp + fp + fn),
            "false_positive_rate": F.try_divide(fp, fp + tn),
        }
    )


def auroc(df: DataFrame, score: str, label: str) -> DataFrame:
    """Area under the curve from mean ranks over distinct scores."""
    per_score = df.groupBy(F.col(score).alias("s")).agg(
        F.count(F.lit(1)).alias("c"), F.sum(F.col(label).cast("long")).alias("c1")
    )
    ranked = running_totals(per_score, [], ["s"], cum="c")
    rank = F.col("cum") - (F.col("c") - 1) / F.lit(2.0)
    sums = ranked.agg(
        F.sum(F.col("c1") * rank).alias("r1"),
        F.sum("c1").cast("double").alias("n1"),
        (F.sum("c") - F.sum("c1")).cast("double").alias("n0"),
    )
    n1, n0 = F.col("n1"), F.col("n0")
    return sums.select(F.try_divide(F.col("r1") - n1 * (n1 + 1) / 2, n1 * n0).alias("auroc"))


def calibration_error(df: DataFrame, probability: str, label: str, bins: int = 10) -> DataFrame:
    p = F.col(probability)
    cell = F.least(F.floor(p * bins), F.lit(bins - 1))
    cells = df.groupBy(cell.alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), F.avg(p).alias("p"), F.avg(F.col(label).cast("double")).alias("y")
    )
    n = F.col("n")
    return cells.agg((F.sum(n * F.abs(F.col("p") - F.col("y"))) / F.sum(n)).alias("ece"))


def split(df: DataFrame, key: str, shares: tuple[float, float, float] = SPLIT, seed: int = 42) -> DataFrame:
    """Train, validation and test by a hash of the key: stable under any partitioning."""
    digest = F.substring(F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}"))), 1, 8)
    place = F.conv(digest, 16, 10).cast("double") / float(16**8)
    name = F.when(place < shares[0], "train").when(place < shares[0] + shares[1], "validation").otherwise("test")
    return df.withColumn("split", name)


def class_balance(df: DataFrame, label: str = "label") -> DataFrame:
    positive = F.count_if(F.col(label) == 1)
    total = F.count(F.lit(1))
    return df.agg(
        positive.alias("n_positive"), (total - positive).alias("n_negative"), F.try_divide(positive, total).alias("ratio")
    )


def latency_report(df: DataFrame, value: str, failed: Column, by: list[str]) -> DataFrame:
    """Median, 95th and 99th percentile and the share of failures per group."""
    groups = open_series(df.select(*by, value, failed.alias("_failed")), by, [value])
    groups = groups.with_quantiles(value, p50=0.5, p95=0.95, p99=0.99)
    return groups.per_key(
        F.count(F.lit(1)).alias("n"),
        *[F.max(p).alias(p) for p in ("p50", "p95", "p99")],
        (F.count_if("_failed") / F.count(F.lit(1))).alias("error_rate"),
    )


# period search


def periodogram(s: Series, frequencies: list[float]) -> DataFrame:
    """Generalised Lomb-Scargle power with a floating mean per id and frequency.

    Map tasks add up a few sums per id and frequency; rows do not move.
    """
    grid = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(float(f)).alias("f")) for i, f in enumerate(frequencies)])
    s = s.with_stats(_t0=F.min("time"), _mean=F.avg("flux"))
    rows = s.rows().select(
        *s.keys, (F.col("time") - F.col("_t0")).alias("t"), (F.col("flux") - F.col("_mean")).alias("y")
    )
    waves = rows.withColumn("g", F.explode(grid))
    angle = F.col("t") * F.col("g.f") * (2 * math.pi)
    waves = waves.select(*s.keys, "g.i", "g.f", "y", F.cos(angle).alias("c"), F.sin(angle).alias("s"))
    c, sn, y = F.col("c"), F.col("s"), F.col("y")
    sums = waves.groupBy(*s.keys, "i", "f").agg(
        F.count(F.lit(1)).alias("n"), F.avg(y).alias("my"), F.avg(c).alias("mc"), F.avg(sn).alias("ms"),
        F.avg(y * y).alias("yy"), F.avg(y * c).alias("yc"), F.avg(y * sn).alias("ys"),
        F.avg(c * c).alias("cc"), F.avg(sn * sn).alias("ss"), F.avg(c * sn).alias("cs"),
    )
    my, mc, ms = F.col("my"), F.col("mc"), F.col("ms")
    sums = sums.select(
        *s.keys, "i", "f",
        (F.col("yy") - my * my).alias("yy"), (F.col("yc") - my * mc).alias("yc"), (F.col("ys") - my * ms).alias("ys"),
        (F.col("cc") - mc * mc).alias("cc"), (F.col("ss") - ms * ms).alias("ss"), (F.col("cs") - mc * ms).alias("cs"),
    )
    det = F.col("cc") * F.col("ss") - F.col("cs") * F.col("cs")
    top = (
        F.col("ss") * F.col("yc") * F.col("yc")
        + F.col("cc") * F.col("ys") * F.col("ys")
        - 2 * F.col("cs") * F.col("yc") * F.col("ys")
    )
    return sums.select(*s.keys, F.col("f").alias("frequency"), F.try_divide(top, F.col("yy") * det).alias("power"))


def periodogram_peaks(power: DataFrame, keys: list[str], n: int = 3) -> DataFrame:
    return top_per_group(power, keys, [F.col("power").desc_nulls_last(), F.col("frequency")], n)


def box_search(s: Series, periods: list[float], bins: int = 50, widths: tuple[int, ...] = (1, 2, 3, 5)) -> DataFrame:
    """Best box-shaped dip per id: period, depth, duration and epoch.

    Samples fold into phase bins per trial period; every later step sees only
    bins. The score is that of Kovacs, Zucker and Mazeh (2002). A series is
    folded and searched in one task, a hot one is folded by the tasks that read
    it. Samples without a finite time fold into no bin.
    """
    s = s.with_stats(_t0=F.min("time"), _mean=F.avg("flux"), _n=F.count(F.lit(1)))
    columns = [
        *s.keys, "_t0", "_n", (F.col("time") - F.col("_t0")).alias("t"),
        F.coalesce(F.col("flux") - F.col("_mean"), F.lit(0.0)).alias("y"),
    ]
    timed = F.abs("t") < F.lit(float("inf"))
    fields = [T.StructField(name, T.DoubleType()) for name in ("period", "depth", "duration", "epoch", "score")]
    schema = T.StructType([*[s.cold.schema[k] for k in s.keys], *fields])
    keys, names, trials, spans = s.keys, schema.names, np.sort(np.asarray(periods, dtype=float)), sorted(widths)

    def result(rows: pa.Table, sums: np.ndarray, counts: np.ndarray) -> pa.Table:
        start, n = rows["_t0"][0].as_py(), rows["_n"][0].as_py()
        best = best_box(trials, spans, sums, counts, n, start)
        ids = [pa.array([rows[k][0].as_py()] * len(best), rows.schema.field(k).type) for k in keys]
        return pa.table([*ids, *[pa.array([b[i] for b in best], pa.float64()) for i in range(5)]], names=names)

    def whole(rows: pa.Table) -> pa.Table:
        return result(rows, *fold(np.asarray(rows["t"]), np.asarray(rows["y"]), trials, bins))

    def gathered(rows: pa.Table) -> pa.Table:
        at = np.asarray(rows["trial"]), np.asarray(rows["bin"])
        sums, counts = np.zeros((2, len(trials), bins))
        sums[at], counts[at] = np.asarray(rows["sy"]), np.asarray(rows["c"])
        return result(rows, sums, counts)

    found = s.cold.select(*columns).filter(timed).groupBy(*s.keys).applyInArrow(whole, schema)
    if s.hot is None:
        return found
    grid = F.array(*[F.lit(float(p)) for p in trials])
    hot = s.hot.filter("_own") if "_own" in s.hot.columns else s.hot
    rows = hot.select(*columns).filter(timed).select("*", F.posexplode(grid).alias("trial", "period"))
    phase = F.col("t") / F.col("period") - F.floor(F.col("t") / F.col("period"))
    cell = F.least(F.floor(phase * bins), F.lit(bins - 1)).cast("int")
    folded = rows.groupBy(*s.keys, "trial", cell.alias("bin")).agg(
        F.sum("y").alias("sy"), F.count(F.lit(1)).alias("c"), F.max("_t0").alias("_t0"), F.max("_n").alias("_n")
    )
    return found.unionByName(folded.groupBy(*s.keys).applyInArrow(gathered, schema))


def fold(t: np.ndarray, y: np.ndarray, periods: np.ndarray, bins: int) -> tuple[np.ndarray, np.ndarray]:
    """Sums of values and numbers of samples per period and phase bin."""
    size = len(periods) * bins
    sums, counts = np.zeros((2, size))
    for first in range(0, len(t), FOLD_ROWS):
        turns = t[first : first + FOLD_ROWS, None] / periods
        place = np.minimum(np.floor((turns - np.floor(turns)) * bins), bins - 1).astype(np.int64)
        place = (place + np.arange(len(periods)) * bins).ravel()
        sums += np.bincount(place, np.repeat(y[first : first + FOLD_ROWS], len(periods)), minlength=size)
        counts += np.bincount(place, minlength=size)
    return sums.reshape(-1, bins), counts.reshape(-1, bins)


def best_box(
    periods: np.ndarray, widths: list[int], sums: np.ndarray, counts: np.ndarray, n: int, start: float
) -> list[tuple[float, float, float, float, float]]:
    """Period, depth, duration, epoch and score of the best dip, or nothing; bins are rows per period, periods ascending."""
    bins = sums.shape[1]
    # every box starts at a bin and goes on around the phase circle
    around = np.arange(bins + widths[-1] - 1) % bins
    both = np.stack([sums, counts])[:, :, around]
    sy, c = np.empty((2, len(periods), len(widths), bins))
    for j, w in enumerate(widths):
        sy[:, j], c[:, j] = sum(both[:, :, o : o + bins] for o in range(w))
    share, mean = c / n, sy / n
    room = share * (1.0 - share)
    score = np.divide(mean * mean, room, out=np.full(sy.shape, -1.0), where=(sy < 0) & (room != 0))
    top = float(score.max())
    if top < 0:
        return []
    # equal boxes sum in different orders: compare rounded, then the first box
    i, j, k = np.unravel_index(np.argmax(np.round(score, 9)), score.shape)
    low, inside = float(sy[i, j, k]), float(c[i, j, k])
    period, width = float(periods[i]), widths[j]
    duration = period * width / bins
    return [(period, -low / (n - inside) - low / inside, duration, start + period * float(k) / bins + duration / 2, top)]


# screening


def closest_approach(objects: DataFrame, catalog: DataFrame, reach: float, horizon: float, block_rows: int = 2_000) -> DataFrame:
    """Pairs that pass within ``reach`` of each other inside ``horizon``.

    Both sides have ``id, x, y, z, vx, vy, vz`` and move in straight lines.
    Objects are classed by speed in powers of two. A pair is compared at the
    level of its faster side, in cells wide enough for two objects of that
    level: the faster side enters the level of its class only, the slower one
    every level above its own. So a few fast objects meet many slow ones, but do
    not bring the slow ones together.

    In a level only neighbours can meet: an object enters its own cell and
    those around it, a catalog row only its own, so a pair meets once. Crowded
    cells are cut into tiles on both sides, so no group compares more than a
    tile with a tile: ``block_rows``, or up to ``TILE_ROWS`` where small blocks
    would copy the rows of a large table too often. Tiles of crowded cells are
    shuffled, meet as arrays and are compared some rows at a time, so a task
    holds two tiles and a stretch of their pairs; the few pairs of other cells are joined.
    """
    left, right, on, tasks = _tiled(objects, catalog, reach, horizon, block_rows)
    few = _pairs(*[side.filter("not crowded") for side in (left, right)], on)
    tiles = [side.filter("crowded").drop("crowded").repartition(tasks, *on).groupBy(*on) for side in (left, right)]
    a_id, b_id = (side.schema[c].dataType.simpleString() for side, c in ((left, "a_id"), (right, "b_id")))
    both = tiles[0].cogroup(tiles[1]).applyInArrow(_both, f"a_id array<{a_id}>, a binary, b_id array<{b_id}>, b binary")
    schema = f"object_id {a_id}, catalog_id {b_id}, time_to_closest_approach double, miss_distance double"
    found = both.mapInArrow(_meeting(float(reach), float(horizon)), schema)
    return _closest(few, reach, horizon).unionByName(found.filter("object_id <> catalog_id"))


def _both(a: pa.Table, b: pa.Table) -> pa.Table:
    """Two tiles that meet as one row: their ids, and x, y, z, vx, vy, vz one after the other as bytes."""
    arrays = []
    for p, side in (("a", a), ("b", b)):
        ids = side[f"{p}_id"].combine_chunks()
        state = np.stack([np.asarray(side[f"{p}_{c}"], "float64") for c in STATE[1:]])
        arrays += [pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids), pa.array([state.tobytes()], pa.binary())]
    return pa.table(arrays, ["a_id", "a", "b_id", "b"]).slice(0, 1 if a.num_rows and b.num_rows else 0)


def _meeting(reach: float, horizon: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Compares tiles of objects with tiles of the catalog, some rows of the first at a time."""

    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, a, others, b in zip(*[batch.column(c) for c in ("a_id", "a", "b_id", "b")]):
                left, right = (np.frombuffer(side.as_buffer()).reshape(len(STATE) - 1, -1) for side in (a, b))
                step = max(1, PAIRS_AT_ONCE // right.shape[1])
                found: list = []
                held = 0
                for first in range(0, left.shape[1], step):
                    i, *rest = near(left[:, first : first + step], right, reach, horizon)
                    found.append((i + first, *rest))
                    held += len(i)
                    if held >= PAIRS_SENT:
                        yield sent(ids.values, others.values, found)
                        found, held = [], 0
                if held:
                    yield sent(ids.values, others.values, found)

    def sent(ids: pa.Array, others: pa.Array, found: list) -> pa.RecordBatch:
        i, j, t, miss = (np.concatenate(part) for part in zip(*found))
        names = ["object_id", "catalog_id", "time_to_closest_approach", "miss_distance"]
        return pa.RecordBatch.from_arrays([ids.take(pa.array(i)), others.take(pa.array(j)), pa.array(t), pa.array(miss)], names)

    return met


def near(a: np.ndarray, b: np.ndarray, reach: float, horizon: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Pairs (index, index) within reach with time and distance; columns are x, y, z, vx, vy, vz, the arithmetic that of ``_closest``."""
    with np.errstate(all="ignore"):
        x, y, z, vx, vy, vz = (q[None, :] - p[:, None] for p, q in zip(a, b))
        speed2 = vx * vx + vy * vy + vz * vz
        approach = -(x * vx + y * vy + z * vz)
        earliest = np.divide(approach, speed2, out=np.zeros_like(speed2), where=speed2 != 0)
        t = np.fmin(np.maximum(earliest, 0.0), horizon)
        x, y, z = x + vx * t, y + vy * t, z + vz * t
        miss = np.sqrt(x * x + y * y + z * z)
        i, j = np.nonzero(miss <= reach)
    return i, j, t[i, j], miss[i, j]


def approach_candidates(objects: DataFrame, catalog: DataFrame, reach: float, horizon: float, block_rows: int = 2_000) -> DataFrame:
    """Pairs of objects that share a cell, columns prefixed ``a_`` and ``b_``."""
    return _pairs(*_tiled(objects, catalog, reach, horizon, block_rows)[:3])


def _pairs(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """Rows of one tile, by a shuffle: sides small enough to broadcast can have very many pairs."""
    return left.drop("crowded").hint("merge").join(right.drop("crowded"), on).filter("a_id <> b_id")


def _tiled(
    objects: DataFrame, catalog: DataFrame, reach: float, horizon: float, block_rows: int
) -> tuple[DataFrame, DataFrame, list[str], int]:
    """Both sides with their cells and tiles, a row for each tile of the other side, the columns that pairs share, and tasks for crowded tiles."""
    speed = F.sqrt(F.col("vx") * F.col("vx") + F.col("vy") * F.col("vy") + F.col("vz") * F.col("vz"))
    unit = reach if reach > 0 else 1.0
    steps = speed * F.lit(float(horizon)) / unit
    grade = F.when(steps > 1, F.ceil(F.log2(steps))).otherwise(0).cast("int")
    objects, catalog = objects.withColumn("_class", grade), catalog.withColumn("_class", grade)
    found = objects.select("_class").union(catalog.select("_class")).distinct().orderBy("_class").collect()
    levels = F.array(*[F.lit(r["_class"]) for r in found if r["_class"] is not None])
    size = (F.lit(float(reach)) + F.pow(F.lit(2.0), F.col("level") + 1) * unit) * (1 + 1e-9)  # for rounding of the class
    cell = ["kind", "level", "cx", "cy", "cz"]

    def graded(df: DataFrame, own_kind: int, strict: bool) -> DataFrame:
        """A row at the level of its class, and one for each level above it for pairs whose other side is faster."""
        own = df.withColumn("kind", F.lit(own_kind)).withColumn("level", F.col("_class"))
        above = F.filter(levels, lambda v: v > F.col("_class") if strict else v >= F.col("_class"))
        return own.unionByName(df.withColumn("kind", F.lit(1 - own_kind)).withColumn("level", F.explode(above)))

    def placed(df: DataFrame, spread: int) -> DataFrame:
        steps = F.sequence(F.lit(-spread), F.lit(spread))
        for axis in "xyz":
            df = df.withColumn(f"_{axis}", F.explode(steps))
            df = df.withColumn(f"c{axis}", F.floor(F.col(axis) / size) + F.col(f"_{axis}")).drop(f"_{axis}")
        return materialise(df.select(*cell, *STATE))

    left, right = placed(graded(objects, 0, True), 1), placed(graded(catalog, 1, False), 0)
    tile = float(max(block_rows, min(TILE_ROWS, max(left.count(), right.count()) // TILES)))
    # cells with both sides; one row per cell
    sizes = [df.groupBy(*cell).agg(F.count(F.lit(1)).alias(name)) for df, name in ((left, "_m"), (right, "_n"))]
    counts = sizes[0].join(sizes[1], cell).withColumn("pairs", F.col("_m").cast("double") * F.col("_n"))
    counts = counts.withColumn("crowded", F.col("pairs") >= CROWDED_PAIRS)
    # written, so that its size is known and no plan sends the rows around instead
    counts = materialise(counts.withColumns({n: F.ceil(F.col(n) / F.lit(tile)) for n in ("_m", "_n")}))
    met = counts.filter("crowded").agg(F.sum(F.col("_m") * F.col("_n")) / TILE_PAIRS, F.sum("pairs") / ROW_PAIRS).first()
    tasks = max(1, int(min(TILE_TASKS, *(n or 0 for n in met))))
    counts = counts.drop("pairs")
    left, right = [lookup(df, counts, cell) for df in (left, right)]
    left = left.withColumn("_a", F.pmod(F.xxhash64("id"), "_m")).withColumn(
        "_b", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1))
    )
    right = right.withColumn("_b", F.pmod(F.xxhash64("id"), "_n")).withColumn(
        "_a", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_m") - 1))
    )
    on = [*cell, "_a", "_b"]
    left = left.select(*on, "crowded", *[F.col(c).alias(f"a_{c}") for c in STATE])
    right = right.select(*on, "crowded", *[F.col(c).alias(f"b_{c}") for c in STATE])
    return left, right, on, tasks


def _closest(pairs: DataFrame, reach: float, horizon: float) -> DataFrame:
    state = ["x", "y", "z", "vx", "vy", "vz"]
    p = {c: F.col(f"b_{c}") - F.col(f"a_{c}") for c in state}
    speed2 = p["vx"] * p["vx"] + p["vy"] * p["vy"] + p["vz"] * p["vz"]
    approach = -(p["x"] * p["vx"] + p["y"] * p["vy"] + p["z"] * p["vz"])
    earliest = F.coalesce(F.try_divide(approach, speed2), F.lit(0.0))
    t = F.least(F.greatest(earliest, F.lit(0.0)), F.lit(float(horizon)))
    away = [p[a] + p[f"v{a}"] * t for a in "xyz"]
    miss = F.sqrt(away[0] * away[0] + away[1] * away[1] + away[2] * away[2])
    close = pairs.filter(miss <= reach)
    return close.select(
        F.col("a_id").alias("object_id"),
        F.col("b_id").alias("catalog_id"),
        t.alias("time_to_closest_approach"),
        miss.alias("miss_distance"),
    )
