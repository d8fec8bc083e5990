"""Entropies and complexity of series."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.functions.names import feature, flux
from starloom.operators.series import Series


# The published parameter grids of the calculators.
APPROXIMATE_R = (0.1, 0.2, 0.3, 0.5, 0.7, 0.9)
SAMPLE_R = 0.2
PERMUTATION_DIMENSIONS = (3, 4, 5, 6, 7)
LZ_BINS = (2, 3, 5, 10, 100)
TILE = 1024
STRIP = 64
STRETCH = 16  # tiles that a tile is compared with at a time


def _entropy(count: Column, total: Column) -> Column:
    share = count / total
    return -F.sum(share * F.ln(share))


def binned_entropy(s: Series, bins: int = 10) -> DataFrame:
    s = s.with_stats(_n=F.count(F.lit(1)), _low=F.min(flux()), _high=F.max(flux()))
    span = F.col("_high") - F.col("_low")
    place = F.least(F.floor(F.try_divide((flux() - F.col("_low")) * bins, span)), F.lit(bins - 1))
    cells = s.with_columns(_bin=F.coalesce(place, F.lit(0))).rows()
    counted = cells.groupBy(*s.keys, "_bin").agg(F.count(F.lit(1)).alias("c"), F.max("_n").alias("n"))
    return counted.groupBy(*s.keys).agg(
        _entropy(F.col("c"), F.col("n")).alias(feature("binned_entropy", max_bins=bins))
    )


def benford(s: Series) -> DataFrame:
    """Correlation of leading digit shares with Benford's law."""
    digit = F.substring(F.format_string("%.15e", F.abs(flux())), 1, 1).cast("int")
    rows = s.rows().select(*s.keys, digit.alias("_digit"))
    shares = rows.groupBy(*s.keys).agg(
        F.count(F.lit(1)).alias("n"), *[F.count_if(F.col("_digit") == d).alias(f"d{d}") for d in range(1, 10)]
    )
    pairs = shares.select(
        *s.keys,
        F.explode(F.array(*[F.struct(F.lit(d).alias("d"), (F.col(f"d{d}") / F.col("n")).alias("p"))
                            for d in range(1, 10)])).alias("e"),
    )
    law = F.log10(F.lit(1.0) + F.lit(1.0) / F.col("e.d"))
    return pairs.groupBy(*s.keys).agg(F.corr("e.p", law).alias(feature("benford_correlation")))


def permutation_entropy(s: Series) -> DataFrame:
    """Entropy of the ordinal patterns of d neighbouring values.

    The bits of all pairwise comparisons name the pattern; ordered by the
    later member, the comparisons of a shorter tuple are a prefix.
    """
    top = max(PERMUTATION_DIMENSIONS)
    s = s.windowed(lambda w: {f"_x{k}": w.ahead("flux", k) for k in range(1, top)})
    s = s.with_columns(_x0=flux())
    code, patterns = F.lit(0).cast("long"), []
    bit = 1
    for j in range(1, top):
        for i in range(j):
            code = code + F.when(F.col(f"_x{j}") < F.col(f"_x{i}"), F.lit(bit)).otherwise(F.lit(0))
            bit *= 2
        if j + 1 in PERMUTATION_DIMENSIONS:
            full = F.col(f"_x{j}").isNotNull()
            patterns.append(F.when(full, F.struct(F.lit(j + 1).alias("d"), code.alias("code"))))
    tuples = s.rows().select(*s.keys, F.explode(F.array_compact(F.array(*patterns))).alias("p"))
    counted = tuples.groupBy(*s.keys, F.col("p.d").alias("d"), F.col("p.code").alias("code")).agg(
        F.count(F.lit(1)).alias("c")
    )
    # sum of c ln c and of c give the entropy in one pass
    c = F.col("c")
    found = counted.groupBy(*s.keys).pivot("d", list(PERMUTATION_DIMENSIONS)).agg(
        (F.ln(F.sum(c)) - F.sum(c * F.ln(c)) / F.sum(c)).alias("e")
    )
    ids = s.rows().select(*s.keys).distinct()
    return ids.join(found, list(s.keys), "left").select(
        *s.keys,
        *[F.col(str(d)).alias(feature("permutation_entropy", dimension=d, tau=1)) for d in PERMUTATION_DIMENSIONS],
    )


def lempel_ziv(s: Series) -> DataFrame:
    """Phrases of a greedy parse over binned values, per sample.

    The parse is sequential, so rows stream through it in order; only the
    phrases seen so far are held, never the series.
    """
    key = s.keys[0]
    s = s.with_stats(_low=F.min(flux()), _high=F.max(flux()))
    rows = s.rows().select(key, "pos", "flux", "_low", "_high")
    ordered = rows.repartition(F.col(key)).sortWithinPartitions(key, "pos")
    names = [feature("lempel_ziv_complexity", bins=b) for b in LZ_BINS]
    kind = s.cold.schema[key].dataType.simpleString()
    schema = f"{key} {kind}, " + ", ".join(f"`{n}` double" for n in names)

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, tries, length = None, None, 0
        for batch in batches:
            done = []
            for value, part in batch.groupby(key, sort=False):
                if value != current:
                    if current is not None:
                        done.append([current, *[t.phrases / length for t in tries]])
                    current, tries, length = value, [PhraseTrie() for _ in LZ_BINS], 0
                x = part["flux"].to_numpy()
                low, high = part["_low"].iloc[0], part["_high"].iloc[0]
                length += len(x)
                for trie, bins in zip(tries, LZ_BINS):
                    edges = np.linspace(low, high, bins + 1)[1:]
                    trie.feed(np.searchsorted(edges, x, side="left").tolist())
            if done:
                yield pd.DataFrame(done, columns=[key, *names])
        if current is not None:
            yield pd.DataFrame([[current, *[t.phrases / length for t in tries]]], columns=[key, *names])

    return ordered.mapInPandas(parse, schema)


class PhraseTrie:
    """Counts distinct phrases of a greedy parse, symbol by symbol."""

    def __init__(self) -> None:
        self.children: dict[tuple[int, int], int] = {}
        self.node = 0
        self.phrases = 0

    def feed(self, symbols: list[int]) -> None:
        children, node = self.children, self.node
        for symbol in symbols:
            nxt = children.get((node, symbol))
            if nxt is None:
                self.phrases += 1
                children[(node, symbol)] = self.phrases
                node = 0
            else:
                node = nxt
        self.node = node


def template_entropies(s: Series, tile: int = TILE) -> DataFrame:
    """Sample and approximate entropy (m = 2).

    Tiles of templates are compared with longer stretches of the series. Such a
    pair is one bounded step that gives only match counts per template, summed
    over the stretch, so the length of a series sets the number of steps, not
    their size.
    """
    stretch = tile * STRETCH
    key = s.keys[0]
    kind = s.cold.schema[key].dataType.simpleString()
    s = s.with_stats(_n=F.count(F.lit(1)), _std=F.stddev_pop(flux()))
    s = s.windowed(lambda w: {"_y": w.ahead("flux", 1), "_z": w.ahead("flux", 2)})
    rows = s.rows().select(key, "pos", "flux", "_y", "_z", "_n", "_std")

    def cut(name: str, length: int) -> DataFrame:
        found = rows.withColumn(name, F.expr(f"pos div {length}")).groupBy(key, name).agg(
            F.max("_n").alias("_n"),
            F.max("_std").alias("_std"),
            F.array_sort(F.collect_list(F.struct("pos", "flux", "_y", "_z"))).alias("p"),
        )
        return found.select(
            key, name, "_n", "_std",
            F.transform("p", lambda r: r["flux"]).alias("x"),
            F.transform("p", lambda r: r["_y"]).alias("y"),
            F.transform("p", lambda r: r["_z"]).alias("z"),
        )

    # every tile meets every stretch of its series, one pair per row; the pair
    # number spreads a long series over all tasks
    wide = cut("_t", tile).withColumn("_u", F.explode(F.expr(f"sequence(0L, (_n - 1) div {stretch})")))
    other = cut("_u", stretch).select(key, "_u", *[F.col(c).alias(f"o{c}") for c in "xyz"])
    pairs = wide.join(other, [key, "_u"])
    radii = (*APPROXIMATE_R, SAMPLE_R)
    fields = [f"{m}{i}" for m in "ab" for i in range(len(radii))]
    schema = f"{key} {kind}, pos long, _n long, " + ", ".join(f"{f} long" for f in fields)

    def matches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for start in range(0, len(batch), 64):
                part = batch.iloc[start : start + 64]
                yield pd.concat([_tile_matches(row, key, tile, radii, fields) for row in part.itertuples(index=False)])

    counts = pairs.select(
        key, F.col("_t").alias("t"), F.col("_n").alias("n"), F.col("_std").alias("std"), "x", "y", "z", "ox", "oy", "oz"
    ).mapInPandas(matches, schema)
    per_template = counts.groupBy(key, "pos").agg(
        F.max("_n").alias("_n"), *[F.sum(f).alias(f) for f in fields]
    )
    out = []
    n = F.max("_n")
    for i, r in enumerate(APPROXIMATE_R):
        # a counts pairs of values, b triples; templates without a third value have b = 0
        phi_a = F.sum(F.ln(F.when(F.col(f"a{i}") > 0, F.col(f"a{i}")) / (F.col("_n") - 1))) / (n - 1)
        phi_b = F.sum(F.ln(F.when(F.col(f"b{i}") > 0, F.col(f"b{i}")) / (F.col("_n") - 2))) / (n - 2)
        out.append(
            F.when(n > 3, F.abs(phi_a - phi_b)).otherwise(F.lit(0.0)).alias(feature("approximate_entropy", m=2, r=r))
        )
    last = len(radii) - 1
    pairs_of_two = F.sum(F.col(f"a{last}")) - F.count_if(F.col(f"a{last}") > 0)
    pairs_of_three = F.sum(F.col(f"b{last}")) - F.count_if(F.col(f"b{last}") > 0)
    ratio = F.try_divide(pairs_of_three, pairs_of_two)
    out.append(F.when(ratio > 0, -F.ln(ratio)).alias(feature("sample_entropy")))
    found = per_template.groupBy(key).agg(*out)
    ids = s.rows().select(key).distinct()
    return ids.join(found, key, "left")


def _tile_matches(row, key: str, tile: int, radii: tuple[float, ...], fields: list[str]) -> pd.DataFrame:
    x, y, z, ox, oy, oz = [np.asarray(v, dtype=float) for v in (row.x, row.y, row.z, row.ox, row.oy, row.oz)]
    limits = [r * row.std for r in radii]
    counts = np.empty((len(x), 2 * len(radii)), dtype=np.int64)
    # strips of templates keep the comparison inside the processor's cache;
    # one cut off by the end of the series has NaN and matches nothing
    for start in range(0, len(x), STRIP):
        part = slice(start, start + STRIP)
        two = np.abs(np.subtract.outer(x[part], ox))
        np.maximum(two, np.abs(np.subtract.outer(y[part], oy)), out=two)
        three = np.maximum(two, np.abs(np.subtract.outer(z[part], oz)))
        for i, limit in enumerate(limits):
            counts[part, i] = np.count_nonzero(two <= limit, axis=1)
            counts[part, len(radii) + i] = np.count_nonzero(three <= limit, axis=1)
    frame = pd.DataFrame(counts, columns=fields)
    frame.insert(0, "_n", row.n)
    frame.insert(0, "pos", row.t * tile + np.arange(len(x)))
    frame.insert(0, key, row[0])
    return frame
