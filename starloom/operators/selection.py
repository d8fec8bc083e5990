"""Feature selection and ranking.

A feature matrix is wide, with columns ``id`` and ``label``. The tests work on
its long form ``(feature, label, value)``, so any number of features is one
set of grouped aggregates.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.functions.tails import f_pvalue, z_pvalue
from starloom.operators import columns, forest
from starloom.operators.information import neighbour_information
from starloom.operators.series import even_chunk, open_series, running_totals
from starloom.session import materialise

METHODS = ("relevance", "mutual_info", "f_test", "random_forest", "all")
MI_BINS = 10
DEPTH = 30
#: Rows times trees of which the driver holds the nodes at once, and how far the seeds of smaller forests lie apart.
TREE_ROWS = 1_000_000
SEED_STEP = 1_000_003
#: Rows up to which Spark ML grows the forest, and the classes that it infers at most.
SPARK_ROWS, CLASSES = 10_000, 100


def feature_names(df: DataFrame, id_column: str = "id", label_column: str = "label") -> list[str]:
    """Every column but id, label and the batch number, in order."""
    if label_column not in df.columns:
        raise ValueError(f"label column {label_column!r} not found")
    return [c for c in df.columns if c not in (id_column, label_column, "batch_index")]


def long_form(df: DataFrame, names: list[str]) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(n).alias("feature"), F.col(n).cast("double").alias("value")) for n in names])
    return df.select("id", "label", F.explode(pairs).alias("p")).select("id", "label", "p.feature", "p.value")


# correlation filter


def correlations(df: DataFrame, names: list[str], above: float | None = None) -> DataFrame:
    """Pearson correlation of every pair of features, earlier feature first; with ``above`` only stronger ones.

    A pair is compared on the rows that have both values; null, NaN and
    infinite values count as missing. A pair without spread has no correlation (null).
    """
    pairs = columns.named(columns.correlated_pairs(df, names, above), names, "i", "earlier")
    return columns.named(pairs, names, "j", "feature").select("i", "j", "earlier", "feature", "corr")


def uncorrelated(df: DataFrame, names: list[str], threshold: float = 0.95) -> list[str]:
    """Features without a stronger correlation to any earlier one, dropped or not."""
    strong = correlations(df, names, threshold).select("feature").distinct()
    dropped = {row["feature"] for row in strong.collect()}
    return [n for n in names if n not in dropped]


# F test


def f_scores(long: DataFrame) -> DataFrame:
    """Analysis of variance per feature: ``f_score`` and degrees of freedom."""
    return f_of_classes(
        long.groupBy("feature", "label").agg(F.count("value").alias("n"), F.avg("value").alias("m"), F.var_pop("value").alias("v"))
    )


def f_of_classes(groups: DataFrame) -> DataFrame:
    """The same from count, mean and variance per feature and label."""
    n, m = F.col("n"), F.col("m")
    whole = Window.partitionBy("feature")
    groups = groups.withColumn("grand", F.sum(n * m).over(whole) / F.sum(n).over(whole))
    gap = m - F.col("grand")
    sums = groups.groupBy("feature").agg(
        F.sum(n * gap * gap).alias("between"),
        F.sum(n * F.col("v")).alias("within"),
        (F.count(F.lit(1)) - 1).cast("double").alias("d1"),
        (F.sum(n) - F.count(F.lit(1))).cast("double").alias("d2"),
    )
    score = F.try_divide(F.try_divide("between", "d1"), F.try_divide("within", "d2"))
    return sums.select("feature", score.alias("f_score"), "d1", "d2")


def f_test(df: DataFrame, names: list[str]) -> DataFrame:
    """Scores and p-values of the columns of a matrix, from one pass over it."""
    return f_of_classes(columns.class_moments(df, names)).withColumn("p_value", f_pvalue("f_score", "d1", "d2")).drop("d1", "d2")


# mutual information


def mutual_information(long: DataFrame, bins: int = MI_BINS) -> DataFrame:
    """Plug-in mutual information over bins of equal count, ties split by id."""
    s = open_series(long, ["feature"], ["value", "id"]).located().with_stats(_n=F.count(F.lit(1)))
    binned = s.with_columns(bin=even_chunk(F.col("pos"), F.col("_n"), bins)).rows()
    cells = binned.groupBy("feature", "bin", "label").agg(F.count(F.lit(1)).alias("c"))
    row = Window.partitionBy("feature", "bin")
    column = Window.partitionBy("feature", "label")
    whole = Window.partitionBy("feature")
    cells = cells.withColumns(
        {"a": F.sum("c").over(row), "b": F.sum("c").over(column), "t": F.sum("c").over(whole)}
    )
    share = F.col("c") / F.col("t")
    gain = share * F.ln(F.col("c") * F.col("t") / (F.col("a") * F.col("b")))
    return cells.groupBy("feature").agg(F.sum(gain).alias("mutual_info"))


def information_of(df: DataFrame, names: list[str], estimate: str = "neighbours") -> DataFrame:
    """Mutual information of the columns with the label, by nearest neighbours or by bins."""
    if estimate not in ("neighbours", "bins"):
        raise ValueError("information must be 'neighbours' or 'bins'")
    return neighbour_information(df, names) if estimate == "neighbours" else mutual_information(long_form(df, names))


# relevance


def rank_sums(long: DataFrame) -> DataFrame:
    """Mann-Whitney statistics of label 1 against label 0, with tie correction.

    Equal values share their mean rank, so ranks come from running counts over
    distinct values.
    """
    per_value = long.groupBy("feature", "value").agg(
        F.count(F.lit(1)).alias("c"), F.sum(F.col("label").cast("long")).alias("c1")
    )
    ranked = running_totals(per_value, ["feature"], ["value"], cum="c")
    rank = F.col("cum") - (F.col("c") - 1) / F.lit(2.0)
    c = F.col("c").cast("double")
    sums = ranked.groupBy("feature").agg(
        F.count(F.lit(1)).alias("n_distinct"),
        F.sum("c1").cast("double").alias("n1"),
        F.sum("c").cast("double").alias("n"),
        F.sum(F.col("c1") * rank).alias("r1"),
        F.sum(c * c * c - c).alias("ties"),
    )
    n, n1 = F.col("n"), F.col("n1")
    n0 = n - n1
    u = F.col("r1") - n1 * (n1 + 1) / 2
    spread = F.sqrt(n1 * n0 / 12 * (n + 1 - F.try_divide("ties", n * (n - 1))))
    off = F.abs(u - n1 * n0 / 2) - 0.5
    return sums.select(
        "feature", "n_distinct", u.alias("u"), F.try_divide(F.greatest(off, F.lit(0.0)), spread).alias("z")
    )


def fisher_exact(long: DataFrame) -> DataFrame:
    """Two-sided exact test for features with two values; four counts per feature."""
    low = long.groupBy("feature").agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    rows = long.join(F.broadcast(low), "feature").filter("value = lo or value = hi")
    high, one = F.col("value") == F.col("hi"), F.col("label") == 1
    table = rows.groupBy("feature").agg(
        F.count_if(high & one).alias("a"),
        F.count_if(high & ~one).alias("b"),
        F.count_if(~high & one).alias("c"),
        F.count_if(~high & ~one).alias("d"),
    )

    @F.pandas_udf("double")
    def tail(a: pd.Series, b: pd.Series, c: pd.Series, d: pd.Series) -> pd.Series:
        return pd.Series([hypergeometric_tail(*map(int, t)) for t in zip(a, b, c, d)], dtype="float64")

    return table.select("feature", tail("a", "b", "c", "d").alias("p_value"))


def hypergeometric_tail(a: int, b: int, c: int, d: int) -> float:
    """Probability of all tables with these margins no likelier than the given one."""
    n, row, column = a + b + c + d, a + b, a + c

    def choose(m: int, k: int) -> float:
        return math.lgamma(m + 1) - math.lgamma(k + 1) - math.lgamma(m - k + 1)

    def log_p(k: int) -> float:
        return choose(row, k) + choose(n - row, column - k) - choose(n, column)

    given = log_p(a) + 1e-7
    low, high = max(0, row + column - n), min(row, column)
    mode = min(max((row + 1) * (column + 1) // (n + 2), low), high)

    def edge(inside: int, outside: int) -> int | None:
        """The last table from the mode outwards that is likelier than the given one, plus one step."""
        if log_p(outside) > given:
            return None
        while abs(outside - inside) > 1:
            middle = (inside + outside) // 2
            inside, outside = (middle, outside) if log_p(middle) > given else (inside, middle)
        return outside

    def tail(k: int | None, step: int) -> float:
        """Probabilities fall by a growing ratio outwards, so the sum ends when they no longer count."""
        if k is None:
            return 0.0
        term = math.exp(log_p(k))
        total = term
        while low <= k + step <= high and term > total * 1e-17:
            if step > 0:
                term *= (row - k) * (column - k) / ((k + 1) * (n - row - column + k + 1))
            else:
                term *= k * (n - row - column + k) / ((row - k + 1) * (column - k + 1))
            k, total = k + step, total + term
        return total

    if log_p(mode) <= given:
        return 1.0
    return min(1.0, tail(edge(mode, low), -1) + tail(edge(mode, high), 1))


def false_discoveries(tests: DataFrame, fdr_level: float = 0.05, by: Column | None = None) -> DataFrame:
    """Benjamini-Yekutieli control, within each value of ``by``; one row per feature, so small windows."""
    everything = Window.partitionBy(F.lit(1) if by is None else by)
    ordered = everything.orderBy("p_value", "feature")
    rank, m = F.col("_rank"), F.col("_m")
    harmonic = F.aggregate(F.sequence(F.lit(1), m.cast("int")), F.lit(0.0), lambda a, i: a + F.lit(1.0) / i)
    ranked = tests.withColumns(
        {"_rank": F.row_number().over(ordered), "_m": F.count(F.lit(1)).over(everything)}
    )
    ranked = ranked.withColumn("_passes", F.col("p_value") <= rank * fdr_level / (m * harmonic))
    last = F.max(F.when(F.col("_passes"), rank)).over(everything)
    return ranked.withColumn("relevant", F.coalesce(rank <= last, F.lit(False))).drop("_rank", "_m", "_passes")


def relevance(long: DataFrame, fdr_level: float = 0.05) -> DataFrame:
    """Relevance table ``(feature, type, p_value, relevant)``.

    Two classes give one test per feature. With more classes each is tested
    against the rest and a feature counts if any test finds it relevant.
    """
    labels = [row["label"] for row in long.select("label").distinct().orderBy("label").collect()]
    if len(labels) <= 2:
        top = labels[-1] if labels else 1
        return _binary_relevance(long.withColumn("label", (F.col("label") == top).cast("int")), fdr_level)
    each = long.withColumn("_class", F.explode(F.array(*[F.lit(label) for label in labels])))
    each = each.withColumn("label", (F.col("label") == F.col("_class")).cast("int"))
    each = each.withColumn("feature", F.struct("_class", "feature")).drop("_class")
    tables = _binary_relevance(each, fdr_level, F.col("feature._class")).withColumn("feature", F.col("feature.feature"))
    return tables.groupBy("feature").agg(
        F.first("type").alias("type"), F.min("p_value").alias("p_value"), F.bool_or("relevant").alias("relevant")
    )


def _binary_relevance(long: DataFrame, fdr_level: float, by: Column | None = None) -> DataFrame:
    stats = rank_sums(long)
    kind = (
        F.when(F.col("n_distinct") == 1, "constant").when(F.col("n_distinct") == 2, "binary").otherwise("real")
    )
    stats = stats.select("feature", kind.alias("type"), z_pvalue("z").alias("p_rank"))
    exact = fisher_exact(long.join(F.broadcast(stats.filter("type = 'binary'").select("feature")), "feature"))
    tests = stats.join(exact, "feature", "left")
    p = F.when(F.col("type") == "binary", F.col("p_value")).otherwise(F.col("p_rank"))
    tests = tests.select("feature", "type", p.alias("p_value"))
    tested = false_discoveries(tests.filter("type <> 'constant'"), fdr_level, by)
    constant = tests.filter("type = 'constant'").select(
        "feature", "type", F.lit(None).cast("double").alias("p_value"), F.lit(False).alias("relevant")
    )
    return tested.unionByName(constant)


# forest


def forest_importance(
    df: DataFrame,
    names: list[str],
    trees: int = 100,
    seed: int = 42,
    depth: int = DEPTH,
    tree_rows: int = TREE_ROWS,
    spark_rows: int = SPARK_ROWS,
    node_rows: int | None = None,
) -> DataFrame:
    """Importance by a forest of trees of at most ``depth`` levels; at most 30.

    Spark grows a forest's nodes on the driver, about in proportion to rows
    times trees. Above ``tree_rows`` of them the trees are grown in smaller
    forests of seeds of their own, of which only the importances stay: trees
    are independent, and the importance is the mean over the trees that split.

    Above ``spark_rows`` rows the same trees are grown by ``forest.importances``,
    of other random draws: nodes of up to ``node_rows`` rows by a task each.
    """
    vectors = VectorAssembler(inputCols=names, outputCol="_v").transform(df)
    data = vectors.select(F.col("label").cast("double").alias("label"), "_v")
    rows = df.count()
    if rows > spark_rows:
        scores = _grown_in_tasks(data, len(names), rows, trees, seed, depth, node_rows)
    else:
        scores = _grown_by_spark(data, len(names), max(1, min(trees, tree_rows // max(1, rows))), trees, seed, depth)
    return df.sparkSession.createDataFrame(
        pd.DataFrame({"feature": names, "rf_importance": [float(v) for v in scores]}),
        "feature string, rf_importance double",
    )


def _grown_by_spark(data: DataFrame, width: int, at_once: int, trees: int, seed: int, depth: int) -> np.ndarray:
    if at_once < trees:
        data = materialise(data)
    scores, split = np.zeros(width), 0
    for turn, first in enumerate(range(0, trees, at_once)):
        classifier = RandomForestClassifier(
            numTrees=min(at_once, trees - first), seed=seed + SEED_STEP * turn, maxDepth=depth, featuresCol="_v", labelCol="label"
        )
        found, grown = _importances(classifier.fit(data))
        scores, split = scores + found * grown, split + grown
    return scores / max(1, split)


def _grown_in_tasks(
    data: DataFrame, width: int, rows: int, trees: int, seed: int, depth: int, node_rows: int | None
) -> np.ndarray:
    """What Spark's classifier refuses is refused here too; vectors with missing values are by their assembler."""
    if not 0 <= depth <= DEPTH or trees < 1:
        raise ValueError(f"a forest has at least one tree and 0 to {DEPTH} levels")
    data = materialise(data.select("label", vector_to_array("_v").alias("x")))
    whole = F.coalesce((F.col("label") >= 0) & (F.col("label") < CLASSES) & (F.col("label") == F.floor("label")), F.lit(False))
    labels = data.agg(F.count_if(~whole).alias("wrong"), F.max("label").alias("top")).first()
    if labels["wrong"]:
        raise ValueError(f"labels of a forest are whole numbers from 0, fewer than {CLASSES}; {labels['wrong']} are not")
    return forest.importances(data, width, int(labels["top"]) + 1, rows, trees, seed, depth, node_rows)


def _importances(model: RandomForestClassificationModel) -> tuple[np.ndarray, int]:
    """Mean importances of a forest and the number of its trees with a split; the model is free afterwards."""
    return model.featureImportances.toArray(), sum(tree.depth > 0 for tree in model.trees)


def comparable(score: str) -> Column:
    """Scores that differ only by the order of summation compare equal: ten significant digits are kept."""
    value = F.col(score)
    unit = F.pow(F.lit(10.0), F.floor(F.log10(F.abs(value))) - 9)
    return F.when((value == 0) | F.isnan(value) | (F.abs(value) == float("inf")), value).otherwise(F.round(value / unit) * unit)


def top_features(scores: DataFrame, score: str, k: int | None = None) -> DataFrame:
    """The k best by score, ties by name; all of them without k."""
    ordered = scores.filter(F.col(score).isNotNull()).orderBy(comparable(score).desc(), "feature")
    return ordered.limit(k) if k else ordered


def top_forest(scores: DataFrame, k: int | None = None) -> DataFrame:
    if k:
        return top_features(scores, "rf_importance", k)
    return scores.filter(F.col("rf_importance") > 0)


# methods


def select(
    df: DataFrame,
    method: str = "relevance",
    k: int | None = None,
    remove_correlated: bool = True,
    correlation_threshold: float = 0.95,
    fdr_level: float = 0.05,
    seed: int = 42,
    depth: int = DEPTH,
    information: str = "neighbours",
) -> DataFrame:
    """One row per feature that entered the test: ``(feature, score, p_value, selected)``.

    ``all`` keeps features found by relevance, mutual information and forest.
    ``information`` names the estimate of mutual information, "neighbours" or "bins".
    """
    if method not in METHODS:
        raise ValueError(f"unknown method {method!r}; choose from {METHODS}")
    names = feature_names(df)
    if remove_correlated:
        names = uncorrelated(df, names, correlation_threshold)
    long = long_form(df, names)
    none = F.lit(None).cast("double")

    def table(scores: DataFrame, score: Column, p: Column, chosen: DataFrame) -> DataFrame:
        marked = scores.join(F.broadcast(chosen.select("feature", F.lit(True).alias("_in"))), "feature", "left")
        return marked.select(
            "feature", score.alias("score"), p.alias("p_value"), F.coalesce("_in", F.lit(False)).alias("selected")
        )

    def by_relevance() -> DataFrame:
        found = relevance(long, fdr_level)
        return table(found, F.lit(1.0) - F.col("p_value"), F.col("p_value"), found.filter("relevant"))

    def by_information() -> DataFrame:
        found = information_of(df, names, information)
        return table(found, F.col("mutual_info"), none, top_features(found, "mutual_info", k))

    def by_variance() -> DataFrame:
        found = f_test(df, names)
        return table(found, F.col("f_score"), F.col("p_value"), top_features(found, "f_score", k))

    def by_forest() -> DataFrame:
        found = forest_importance(df, names, seed=seed, depth=depth)
        return table(found, F.col("rf_importance"), none, top_forest(found, k))

    if method == "all":
        tested = materialise(by_relevance())
        kept = tested.filter("selected").select("feature")
        for other in (by_information(), by_forest()):
            kept = kept.intersect(other.filter("selected").select("feature"))
        scores = tested.drop("selected")
        return table(scores, F.col("score"), F.col("p_value"), kept)
    return {
        "relevance": by_relevance, "mutual_info": by_information, "f_test": by_variance, "random_forest": by_forest
    }[method]()


def average_rank(scores: DataFrame, columns: list[str]) -> DataFrame:
    """Descending ranks per score, ties at their mean, and the mean of the ranks."""
    out = scores
    for c in columns:
        order = Window.partitionBy(F.lit(1)).orderBy(comparable(c).desc_nulls_last())
        ties = Window.partitionBy(comparable(c))
        out = out.withColumn(f"{c}_rank", F.rank().over(order) + (F.count(F.lit(1)).over(ties) - 1) / F.lit(2.0))
    total = sum([F.col(f"{c}_rank") for c in columns[1:]], F.col(f"{columns[0]}_rank"))
    return out.withColumn("avg_rank", total / len(columns))


def feature_importance(
    df: DataFrame, top_k: int = 50, with_forest: bool = True, seed: int = 42, depth: int = DEPTH, information: str = "neighbours"
) -> DataFrame:
    """Scores by several methods with ranks, the ``top_k`` of best mean rank."""
    names = feature_names(df)
    scores = information_of(df, names, information).join(f_test(df, names), "feature")
    columns = ["mutual_info", "f_score"]
    if with_forest:
        scores = scores.join(forest_importance(df, names, seed=seed, depth=depth), "feature")
        columns.append("rf_importance")
    return average_rank(scores, columns).orderBy("avg_rank", "feature").limit(top_k)


def select_and_save(features: DataFrame, output: str, info_path: str, **options) -> DataFrame:
    """Write id, label and the selected features, and the score table beside them."""
    table = materialise(select(features, **options))
    chosen = {row["feature"] for row in table.filter("selected").select("feature").collect()}
    kept = [n for n in feature_names(features) if n in chosen]
    features.select("id", "label", *kept).write.mode("errorifexists").parquet(output)
    table.write.mode("errorifexists").json(info_path)
    total = len(feature_names(features))
    return table.agg(
        F.count_if("selected").alias("n_selected"),
        F.lit(total).alias("n_total"),
        (F.count_if("selected") / F.lit(total)).alias("selected_ratio"),
    )
