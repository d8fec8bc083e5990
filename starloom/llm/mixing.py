"""Mixing sources to target weights by exact word budgets.

Documents get hash-random keys. Within a source the keys are cut into ranges
of about equal size; sums per range give every range its offset, a running sum
within a range every document its place, and the source's budget is cut there
exactly. What exceeds a source is taken in further epochs.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm import words as W
from starloom.session import materialise

#: Keys have 60 bits.
KEY_BITS = 60
WORD = r"[^\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Settings:
    """Sources in order of their names, null last, weigh ``weights``, repeating.

    The mix has ``share`` times the words of all sources; no source gives more
    than ``epochs`` times its words. ``range_rows`` documents are about one range.
    """

    weights: tuple[int, ...] = (5, 2, 1)
    share: float = 1.0
    epochs: int = 3
    seed: str = "mix"
    range_rows: int = 5_000


def n_words(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def _targets(sources: DataFrame, s: Settings) -> DataFrame:
    """Budget of each source: its weight's part, at most its cap, the rest shared anew.

    With sources in order of cap per weight, the level at which all shares
    are final is the largest of (total - caps before) / (weights from here on).
    One row per source passes through one task.
    """
    weight = F.element_at(F.array(*[F.lit(w) for w in s.weights]), (F.col("place") % len(s.weights) + 1).cast("int"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), "place").rowsBetween(Window.unboundedPreceding, -1)
    named = (
        sources.withColumn("place", F.row_number().over(by_name) - 1)
        .withColumn("weight", weight.cast("long"))
        .withColumn("cap", F.col("source_size") * s.epochs)
    )
    level = (F.col("total") - F.coalesce(F.sum("cap").over(by_cap), F.lit(0))) / (
        F.col("all_weights") - F.coalesce(F.sum("weight").over(by_cap), F.lit(0))
    )
    total = F.sum("source_size").over(everything)
    if s.share != 1.0:
        total = (total * F.lit(s.share)).cast("long")
    shared = named.withColumn("total", total).withColumn("all_weights", F.sum("weight").over(everything)).withColumn("level", level)
    return (
        shared.withColumn("level", F.max("level").over(everything))
        .withColumn("target", F.least(F.col("cap").cast("double"), F.col("weight") * F.col("level")))
        .withColumn("budget", F.floor(F.col("target") + 0.5))
        .withColumn("ranges", F.ceil(F.col("n_docs") / s.range_rows))
        .select("source", "place", "source_size", "target", "budget", "ranges")
    )


def mix(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", size: str | None = None,
    settings: Settings = Settings(),
) -> DataFrame:
    """Adds ``size``, ``source_size``, ``target`` and ``taken`` (words, repeats counted) to each row.

    The taken words of a source add up to its target, rounded to a word: full
    epochs for all its documents, then one for those that come first in key
    order, the last of them in part. A null text has size 0 and gives nothing.
    Rows of equal key are ordered by id and text; which of several equal rows
    comes first makes no difference. Columns named like a result are replaced.
    ``size`` names a column that has the sizes already; texts are then not read.
    """
    s = settings
    made = ("size", "source_size", "target", "taken")
    own = {c: W.private(docs.columns) + c for c in ("key", "range", "place", "source", "name", "size", "target", "budget", "ranges", "sum", "offset", "before")}
    kept = [c for c in docs.columns if c.lower() not in made]
    name = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    digest = F.md5(F.concat(F.lit(s.seed + ":"), name))
    keyed = docs.select(
        *kept, (F.coalesce(F.col(size), F.lit(0)) if size else n_words(text)).cast("long").alias("size"), F.col(source).cast("string").alias(own["source"]),
        F.conv(F.substring(digest, 1, KEY_BITS // 4), 16, 10).cast("long").alias(own["key"]),
    )
    totals = keyed.groupBy(F.col(own["source"]).alias("source")).agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    sources = materialise(_targets(totals, s))
    known = sources.select(
        F.col("source").alias(own["name"]), F.col("place").alias(own["place"]), F.col("source_size").alias(own["size"]),
        F.col("target").alias(own["target"]), F.col("budget").alias(own["budget"]), F.col("ranges").alias(own["ranges"]),
    )
    ranged = keyed.join(known, F.col(own["source"]).eqNullSafe(F.col(own["name"]))).withColumn(
        own["range"], F.floor(F.col(own["key"]) / (F.lit(float(1 << KEY_BITS)) / F.col(own["ranges"]))).cast("int")
    )
    at = [own["place"], own["range"]]
    sums = ranged.groupBy(*at).agg(F.sum("size").alias(own["sum"]))
    before = Window.partitionBy(own["place"]).orderBy(own["range"]).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(*at, F.coalesce(F.sum(own["sum"]).over(before), F.lit(0)).alias(own["offset"]))
    inside = Window.partitionBy(*at).orderBy(own["key"], doc_id, size or text).rowsBetween(Window.unboundedPreceding, -1)
    placed = ranged.join(offsets, at).withColumn(own["before"], F.col(own["offset"]) + F.coalesce(F.sum("size").over(inside), F.lit(0)))
    whole = F.when(F.col(own["size"]) > 0, F.floor(F.col(own["budget"]) / F.col(own["size"]))).otherwise(F.lit(0))
    rest = F.col(own["budget"]) - whole * F.col(own["size"])
    part = F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col(own["before"])))
    return placed.select(
        *kept, "size", F.col(own["size"]).alias("source_size"), F.col(own["target"]).alias("target"),
        (whole * F.col("size") + part).cast("long").alias("taken"),
    )


def epochs(mixed: DataFrame, text: str = "text", whole: bool = False) -> DataFrame:
    """The mix itself: a row per copy of a document.

    A copy in part holds its first words, one space between. With ``whole`` it
    is a whole copy if at least half of it is taken, else none, which leaves a
    source within one document of its target.
    """
    columns = [c for c in mixed.columns if c not in ("size", "source_size", "target", "taken")]
    own = W.private(mixed.columns) + "copy"
    copies = F.floor(F.col("taken") / F.col("size") + 0.5) if whole else F.ceil(F.col("taken") / F.col("size"))
    each = mixed.filter("taken > 0").withColumn(own, copies.cast("int")).filter(F.col(own) > 0)
    each = each.withColumn(own, F.explode(F.sequence(F.lit(1), F.col(own))))
    if whole:
        return each.select(*columns)
    left = F.col("taken") - (F.col(own) - 1) * F.col("size")
    words = F.regexp_extract_all(F.col(text), F.lit(f"({WORD})"), F.lit(1))
    cut = F.array_join(F.slice(words, F.lit(1), left.cast("int")), " ")
    return each.withColumn(text, F.when(left >= F.col("size"), F.col(text)).otherwise(cut)).select(*columns)
