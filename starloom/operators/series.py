"""Ordered rows per key, safe for keys of any size.

Most keys fit one task, so a plain window over the key is the best plan: one
exchange serves every step. A key with more rows than a block does not fit.
``open_series`` counts rows per key and, only if such *hot* keys exist, sends
them down a second plan:

* totals are grouped aggregates (partial on the map side) joined back as a
  broadcast, which is bounded because there are at most ``MAX_HOT`` hot keys;
* positions come from a range partitioning over (key, order), which splits a
  key over many tasks, plus one offset per (key, range);
* ordered windows run over blocks of consecutive positions, with copies of the
  neighbouring rows (the halo) so that lags and leads see across block edges;
* quantiles pick the order statistics out of such positions by value.

Both plans give the same rows; nothing is sampled or capped.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from starloom.session import materialise

BLOCK_ROWS = 1_000_000
MAX_HOT = 200_000
#: Rows that fill a task which sorts a range, and ranges that a smaller table may be cut into all the same.
RANGE_ROWS = 250_000
FEW_RANGES = 32


class Neighbours:
    """Rows around a row by position, at most ``halo`` away."""

    def __init__(self, halo: int):
        self.halo = halo
        self.built: dict[str, Callable[[WindowSpec], Column]] = {}

    def _add(self, reach: int, build: Callable[[WindowSpec], Column]) -> Column:
        if reach > self.halo:
            raise ValueError(f"a frame reaches {reach} rows, the halo has {self.halo}; locate the series with more")
        name = f"_near{len(self.built)}"
        self.built[name] = build
        return F.col(name)

    def back(self, column: Column | str, rows: int = 1) -> Column:
        """The value so many rows before, null where there is none."""
        return self._add(abs(rows), lambda spec: F.lag(column, rows).over(spec))

    def ahead(self, column: Column | str, rows: int = 1) -> Column:
        """The value so many rows behind, null where there is none."""
        return self._add(abs(rows), lambda spec: F.lead(column, rows).over(spec))

    def frame(self, aggregate: Column, first: int, last: int) -> Column:
        """An aggregate over the rows from ``first`` to ``last``, both counted from the row (0)."""
        return self._add(max(abs(first), abs(last)), lambda spec: aggregate.over(spec.rowsBetween(first, last)))


@dataclass(frozen=True)
class Series:
    """Rows of ordinary keys (``cold``) and of oversized keys (``hot``)."""

    cold: DataFrame
    hot: DataFrame | None
    keys: tuple[str, ...]
    order: tuple[str, ...]
    block: int
    size: int  # rows when opened
    halo: int = 0  # neighbours that ordered windows may see
    dealt: bool = False  # rows of ordinary keys lie in as many tasks as they fill

    def map(self, fn: Callable[[DataFrame], DataFrame]) -> Series:
        """Apply a row-wise transformation to both plans."""
        return replace(self, cold=fn(self.cold), hot=None if self.hot is None else fn(self.hot))

    def where(self, condition: Column) -> Series:
        return self.map(lambda df: df.filter(condition))

    def with_columns(self, **columns: Column) -> Series:
        return self.map(lambda df: df.withColumns(columns))

    def drop(self, *names: str) -> Series:
        return self.map(lambda df: df.drop(*names))

    def _dealt(self) -> Series:
        """Ordinary keys in as many tasks as the rows of a large table fill, so that no task sorts more with the input.

        Windows over the key find the rows so and do not move them again.
        """
        tasks = -(-self.size // RANGE_ROWS)
        if self.dealt or tasks <= FEW_RANGES:
            return self
        return replace(self, cold=self.cold.repartition(tasks, *self.keys), dealt=True)

    def with_stats(self, **aggregates: Column) -> Series:
        """Attach one value per key to every row of the key; plain aggregates only."""
        self = self._dealt()
        whole = Window.partitionBy(*self.keys)
        cold = self.cold.withColumns({name: agg.over(whole) for name, agg in aggregates.items()})
        if self.hot is None:
            return replace(self, cold=cold)
        per_key = _own(self.hot).groupBy(*self.keys).agg(*[a.alias(n) for n, a in aggregates.items()])
        return replace(self, cold=cold, hot=self.hot.join(F.broadcast(per_key), list(self.keys)))

    def have(self, **aggregates: Column) -> Series:
        """Like ``with_stats`` for names that mean the same everywhere: those present stay."""
        missing = {n: a for n, a in aggregates.items() if n not in self.cold.columns}
        return self.with_stats(**missing) if missing else self

    def with_quantiles(self, value: str, **probabilities: float) -> Series:
        """Attach exact, linearly interpolated quantiles of ``value``."""
        self = self._dealt()
        whole = Window.partitionBy(*self.keys)
        probs = [float(p) for p in probabilities.values()]
        found = F.percentile(F.col(value), F.array(*[F.lit(p) for p in probs])).over(whole)
        cold = self.cold.withColumn("_q", found)
        cold = cold.withColumns({n: F.col("_q")[i] for i, n in enumerate(probabilities)}).drop("_q")
        if self.hot is None:
            return replace(self, cold=cold)
        per_key = _hot_quantiles(_own(self.hot), self.keys, value, probabilities, self.block)
        return replace(self, cold=cold, hot=self.hot.join(F.broadcast(per_key), list(self.keys), "left"))

    def located(self, halo: int = 0) -> Series:
        """Add ``pos``, the 0-based place of the row in its key's order."""
        self = self._dealt()
        spec = Window.partitionBy(*self.keys).orderBy(*self.order)
        cold = self.cold.withColumn("pos", F.row_number().over(spec).cast("long") - 1)
        if self.hot is None:
            return replace(self, cold=cold, halo=halo)
        hot = _positions(_own(self.hot).drop("_own", "_block"), self.keys, self.order, self.block)
        hot = _copied(hot, self.block, halo)
        return replace(self, cold=cold, hot=materialise(hot), halo=halo)

    def windowed(self, make: Callable[[Neighbours], dict[str, Column]]) -> Series:
        """Add columns made of neighbouring rows; needs ``located`` with a wide enough halo.

        ``make`` gets the only frames there are: a number of rows back, ahead
        or around the row. One that reaches past the halo is an error in both
        plans, and so is a window of the caller's own, which would see copied
        rows in the hot plan. Values over all rows before belong to
        ``with_running``, those of the whole key to ``with_stats``.
        """
        near = Neighbours(self.halo)
        columns = make(near)
        for name, column in columns.items():
            if " OVER (" in str(column).upper():
                raise ValueError(f"{name} has a window of its own; build it with back, ahead or frame")

        def add(df: DataFrame, *keys: str) -> DataFrame:
            spec = Window.partitionBy(*keys).orderBy("pos")
            frames = {n: build(spec) for n, build in near.built.items()}
            return df.withColumns(frames).withColumns(columns).drop(*frames)

        hot = None if self.hot is None else add(self.hot, *self.keys, "_block")
        return replace(self, cold=add(self.cold, *self.keys), hot=hot)

    def with_running(self, **values: Column) -> Series:
        """Add inclusive running sums in position order; needs ``located``."""
        return self._scan(F.sum, lambda own, carry: F.coalesce(own, F.lit(0)) + F.coalesce(carry, F.lit(0)), values)

    def with_latest(self, **values: Column) -> Series:
        """Add the largest value seen up to the row; needs ``located``."""
        return self._scan(F.max, F.greatest, values)

    def _scan(self, agg: Callable, merge: Callable, values: dict[str, Column]) -> Series:
        up_to_here = (Window.unboundedPreceding, Window.currentRow)
        spec = Window.partitionBy(*self.keys).orderBy("pos").rowsBetween(*up_to_here)
        cold = self.cold.withColumns({n: agg(v).over(spec) for n, v in values.items()})
        if self.hot is None:
            return replace(self, cold=cold)
        by_block = [*self.keys, "_block"]
        totals = _own(self.hot).groupBy(*by_block).agg(*[agg(v).alias(f"_c_{n}") for n, v in values.items()])
        earlier = Window.partitionBy(*self.keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
        carry = totals.select(*by_block, *[agg(f"_c_{n}").over(earlier).alias(f"_c_{n}") for n in values])
        local = Window.partitionBy(*by_block).orderBy("pos").rowsBetween(*up_to_here)
        hot = _own(self.hot).withColumns({n: agg(v).over(local) for n, v in values.items()})
        hot = hot.join(F.broadcast(carry), by_block, "left")
        hot = hot.withColumns({n: merge(F.col(n), F.col(f"_c_{n}")) for n in values})
        # Neighbouring blocks get their copies anew, with the running values.
        hot = _copied(hot.drop("_own", "_block", *[f"_c_{n}" for n in values]), self.block, self.halo)
        return replace(self, cold=cold, hot=hot)

    def rows(self) -> DataFrame:
        """All rows once, without the helper columns of the hot plan."""
        if self.hot is None:
            return self.cold
        return self.cold.unionByName(_own(self.hot).drop("_own", "_block"))

    def per_key(self, *aggregates: Column) -> DataFrame:
        return self.rows().groupBy(*self.keys).agg(*aggregates)


def open_series(
    df: DataFrame, keys: list[str], order: list[str], block_rows: int | None = None
) -> Series:
    """Sort rows into ordinary and hot keys by a count per key."""
    spark = df.sparkSession
    wanted = block_rows or int(spark.conf.get("spark.starloom.blockRows", str(BLOCK_ROWS)))
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    top = sizes.agg(F.max("_n"), F.sum("_n")).first()
    block = max(wanted, (top[1] or 0) // MAX_HOT)
    if (top[0] or 0) <= block:
        return Series(df, None, tuple(keys), tuple(order), block, top[1] or 0)
    big = materialise(sizes.filter(F.col("_n") > block).select(*keys))
    cold = df.join(F.broadcast(big), keys, "left_anti")
    hot = materialise(df.join(F.broadcast(big), keys, "left_semi"))
    return Series(cold, hot, tuple(keys), tuple(order), block, top[1])


def global_positions(df: DataFrame, order: list[str], name: str = "pos") -> DataFrame:
    """0-based place of each row in one total order over the whole table."""
    block = int(df.sparkSession.conf.get("spark.starloom.blockRows", str(BLOCK_ROWS)))
    return _positions(df, (), tuple(order), block).withColumnRenamed("pos", name)


def running_totals(df: DataFrame, keys: list[str], order: list[str], **values: str) -> DataFrame:
    """Inclusive running sums over rows in order, whatever the size of a key."""
    block = int(df.sparkSession.conf.get("spark.starloom.blockRows", str(BLOCK_ROWS)))
    if keys:
        s = open_series(df, keys, order).located()
        return s.with_running(**{n: F.col(v) for n, v in values.items()}).drop("pos").rows()
    ranged = _ranged(df, (), tuple(order), block)
    return _offset_sums(ranged, (), tuple(order), {n: F.col(v) for n, v in values.items()}).drop("_part", "_copy")


def even_chunk(pos: Column, n: Column, chunks: int) -> Column:
    """Number of the chunk of a 0-based position; the first ``n % chunks`` are one longer."""
    base, longer = F.floor(n / chunks), n % chunks
    turn = longer * (base + 1)
    return F.when(pos < turn, F.floor(pos / (base + 1))).otherwise(longer + F.floor(F.try_divide(pos - turn, base)))


def _copied(hot: DataFrame, block: int, halo: int) -> DataFrame:
    """Rows with the block of their position, and copies for the blocks that see them."""
    size = max(block, halo)
    hot = hot.withColumn("_home", F.expr(f"pos div {size}"))
    if not halo:
        return hot.withColumn("_block", F.col("_home")).withColumn("_own", F.lit(True)).drop("_home")
    inside = F.expr(f"pos % {size}")
    targets = F.array(
        F.col("_home"),
        F.when((inside < halo) & (F.col("_home") > 0), F.col("_home") - 1),
        F.when(inside >= size - halo, F.col("_home") + 1),
    )
    hot = hot.withColumn("_block", F.explode(F.array_compact(targets)))
    return hot.withColumn("_own", F.col("_block") == F.col("_home")).drop("_home")


def _own(df: DataFrame) -> DataFrame:
    return df.filter("_own") if "_own" in df.columns else df


def _ranges(rows: int, block: int) -> int:
    """Number of sorted ranges of a table.

    A range holds at most about a block, but a small block, which says when a
    key is split, does not make more tasks than the rows can fill: ranges are
    cut at any row, so they split keys whatever their size.
    """
    return max(1, min(-(-rows // block), max(FEW_RANGES, -(-rows // RANGE_ROWS))))


def _ranged(df: DataFrame, keys: tuple[str, ...], order: tuple[str, ...], block: int) -> DataFrame:
    """Rows in sorted ranges; ``_copy`` splits even rows equal in every column."""
    numbered = materialise(df.withColumn("_copy", F.monotonically_increasing_id()))
    ranged = numbered.repartitionByRange(_ranges(numbered.count(), block), *keys, *order, "_copy")
    return materialise(ranged.withColumn("_part", F.spark_partition_id()))


def _offset_sums(
    ranged: DataFrame, keys: tuple[str, ...], order: tuple[str, ...], values: dict[str, Column]
) -> DataFrame:
    """Running sums inside a range plus what earlier ranges of the key add.

    The offsets hold one row per (key, range): at most ranges + hot keys.
    """
    group = [*keys, "_part"]
    totals = ranged.groupBy(*group).agg(*[F.sum(v).alias(f"_o_{n}") for n, v in values.items()])
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*group, *[F.sum(f"_o_{n}").over(earlier).alias(f"_o_{n}") for n in values])
    local = Window.partitionBy(*group).orderBy(*order, "_copy").rowsBetween(Window.unboundedPreceding, 0)
    summed = ranged.withColumns({n: F.sum(v).over(local) for n, v in values.items()})
    joined = summed.join(F.broadcast(offsets), group, "left")
    out = joined.withColumns({n: F.col(n) + F.coalesce(F.col(f"_o_{n}"), F.lit(0)) for n in values})
    return out.drop(*[f"_o_{n}" for n in values])


def _positions(df: DataFrame, keys: tuple[str, ...], order: tuple[str, ...], block: int) -> DataFrame:
    ranged = _ranged(df, keys, order, block)
    counted = _offset_sums(ranged, keys, order, {"pos": F.lit(1).cast("long")})
    return counted.withColumn("pos", F.col("pos") - 1).drop("_part", "_copy")


def _hot_quantiles(
    df: DataFrame, keys: tuple[str, ...], value: str, probabilities: dict[str, float], block: int
) -> DataFrame:
    """Order statistics of hot keys, picked by position in value order."""
    values = materialise(df.select(*keys, F.col(value).alias("_v")).filter(F.col("_v").isNotNull()))
    sizes = values.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    placed = _positions(values, keys, ("_v",), block).join(F.broadcast(sizes), list(keys))
    at = {n: (F.col("_n") - 1) * F.lit(float(p)) for n, p in probabilities.items()}
    wanted = reduce(
        lambda a, b: a | b,
        [(F.col("pos") == F.floor(h)) | (F.col("pos") == F.ceil(h)) for h in at.values()],
    )
    picked = placed.filter(wanted).groupBy(*keys).agg(
        *[F.min(F.when(F.col("pos") == F.floor(h), F.col("_v"))).alias(f"_lo_{n}") for n, h in at.items()],
        *[F.min(F.when(F.col("pos") == F.ceil(h), F.col("_v"))).alias(f"_hi_{n}") for n, h in at.items()],
        *[F.first(h).alias(f"_h_{n}") for n, h in at.items()],
    )

    def between(n: str) -> Column:
        """The same arithmetic as ``percentile``, so that ties compare equal."""
        lo, hi, h = F.col(f"_lo_{n}"), F.col(f"_hi_{n}"), F.col(f"_h_{n}")
        return F.when(lo == hi, lo).otherwise((F.ceil(h) - h) * lo + (h - F.floor(h)) * hi)

    return picked.select(*keys, *[between(n).alias(n) for n in probabilities])
