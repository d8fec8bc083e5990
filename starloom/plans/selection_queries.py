"""Queries for feature selection over the embedding matrix, with SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.operators import selection
from starloom.operators.information import neighbour_information
from starloom.plans import bindings
from starloom.plans.compare import r, rounded, t_tail_sql, z_tail_sql

WIDTH = 64
NAMES = [f"f{i}" for i in range(WIDTH)]
THRESHOLD = 0.12


def matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings as a feature matrix; two classes by cluster number."""
    return bindings.table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"),
        (F.col("label") > 4).cast("int").alias("label"),
        *[F.col("embedding")[i].cast("double").alias(n) for i, n in enumerate(NAMES)],
    )


def _long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return selection.long_form(matrix(spark, sf_dir), NAMES)


def _correlated(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = selection.correlations(matrix(spark, sf_dir), NAMES)
    return rounded(pairs.groupBy("feature").agg(
        F.max(F.abs("corr")).alias("strongest"), (F.max(F.abs("corr")) <= THRESHOLD).alias("kept")
    ), 6)


def _f_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(selection.f_scores(_long(spark, sf_dir)).select("feature", "f_score"), 6)


def _rank_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(selection.rank_sums(_long(spark, sf_dir)).select("feature", "u", "z"), 5)


def _top_f(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = selection.select(matrix(spark, sf_dir), "f_test", k=10, correlation_threshold=THRESHOLD)
    return rounded(found.filter("selected").select("feature", "score"), 6)


def _importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = selection.feature_importance(matrix(spark, sf_dir), 50, with_forest=False, information="bins")
    return rounded(found.drop("p_value"), 6)


def _neighbours(block_rows: int | None = None):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return rounded(neighbour_information(matrix(spark, sf_dir), NAMES, block_rows=block_rows), 8)

    return query


def _controlled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """False discovery control with p-values that SQL can form too."""
    scores = selection.f_scores(_long(spark, sf_dir)).select("feature", F.exp(-F.col("f_score")).alias("p_value"))
    return rounded(selection.false_discoveries(scores, 0.05), 6)


LONG = f"""l AS (SELECT vec_id AS id, CAST(label > 4 AS INTEGER) AS label, 'f' || i AS feature, CAST(embedding[i + 1] AS DOUBLE) AS value
  FROM embeddings, range({WIDTH}) AS g(i))"""

F_SCORES = f"""{LONG},
  g AS (SELECT feature, label, count(*) AS n, avg(value) AS m, var_pop(value) AS v FROM l GROUP BY feature, label),
  h AS (SELECT *, sum(n * m) OVER (PARTITION BY feature) / sum(n) OVER (PARTITION BY feature) AS grand FROM g),
  f AS (SELECT feature, sum(n * (m - grand) ** 2) / (count(*) - 1) / (sum(n * v) / (sum(n) - count(*))) AS f_score FROM h GROUP BY feature)"""

MI = """b AS (SELECT *, ntile(10) OVER (PARTITION BY feature ORDER BY value, id) AS bin FROM l),
  c AS (SELECT feature, bin, label, count(*) AS c FROM b GROUP BY feature, bin, label),
  w AS (SELECT *, sum(c) OVER (PARTITION BY feature, bin) AS a, sum(c) OVER (PARTITION BY feature, label) AS b,
    sum(c) OVER (PARTITION BY feature) AS t FROM c),
  mi AS (SELECT feature, sum(c / t * ln(c * t / (a * b))) AS mutual_info FROM w GROUP BY feature)"""

CORR = f"""p AS (SELECT a.feature AS earlier, b.feature AS feature, corr(a.value, b.value) AS c FROM l a JOIN l b ON a.id = b.id
    AND CAST(substr(a.feature, 2) AS INTEGER) < CAST(substr(b.feature, 2) AS INTEGER) GROUP BY 1, 2)"""

RANKS = f"""{LONG}, q AS (SELECT *, rank() OVER (PARTITION BY feature ORDER BY value)
        + (count(*) OVER (PARTITION BY feature, value) - 1) / 2 AS rk, count(*) OVER (PARTITION BY feature, value) AS t FROM l),
      s AS (SELECT feature, CAST(count(*) AS DOUBLE) AS n, CAST(sum(label) AS DOUBLE) AS n1, sum(rk * label) AS r1,
        sum(CAST(t AS DOUBLE) * t - 1) AS ties FROM q GROUP BY feature),
      u AS (SELECT *, n - n1 AS n0, r1 - n1 * (n1 + 1) / 2 AS u FROM s),
      z AS (SELECT feature, u, greatest(abs(u - n1 * n0 / 2) - 0.5, 0) / sqrt(n1 * n0 / 12 * (n + 1 - ties / (n * (n - 1)))) AS z FROM u)"""

QUERIES = {
    "correlation_filter": _correlated,
    "f_score": _f_score,
    "mutual_information": lambda spark, sf_dir: rounded(selection.mutual_information(_long(spark, sf_dir)), 6),
    "neighbour_information": _neighbours(),
    "neighbour_information_split": _neighbours(100),
    "rank_sum": _rank_sums,
    "false_discovery_control": _controlled,
    "select_f_test": _top_f,
    "importance_ranking": _importance,
    "relevance_table": lambda spark, sf_dir: rounded(selection.relevance(_long(spark, sf_dir)), 6),
    "f_test_pvalues": lambda spark, sf_dir: rounded(selection.f_test(matrix(spark, sf_dir), NAMES), 6),
    "forest_importance": lambda spark, sf_dir: selection.top_forest(
        selection.forest_importance(matrix(spark, sf_dir), NAMES)
    ),
    "select_all_methods": lambda spark, sf_dir: rounded(selection.select(matrix(spark, sf_dir), "all"), 6),
    "importance_ranking_with_forest": lambda spark, sf_dir: rounded(
        selection.feature_importance(matrix(spark, sf_dir), 50), 6
    ),
}

ORACLES = {
    "correlation_filter": f"""WITH {LONG}, {CORR}
      SELECT feature, {r('max(abs(c))', 'strongest')}, max(abs(c)) <= {THRESHOLD} AS kept FROM p GROUP BY feature""",
    "f_score": f"WITH {F_SCORES} SELECT feature, {r('f_score', 'f_score')} FROM f",
    "mutual_information": f"WITH {LONG}, {MI} SELECT feature, {r('mutual_info', 'mutual_info')} FROM mi",
    "neighbour_information": f"""WITH {LONG}, o AS (SELECT *, count(*) OVER c AS nc, count(*) OVER (PARTITION BY feature) AS n,
        {", ".join(f"value - lag(value, {j}) OVER s AS b{j}, lead(value, {j}) OVER s - value AS a{j}" for j in (1, 2, 3))}
        FROM l WINDOW c AS (PARTITION BY feature, label), s AS (PARTITION BY feature, label ORDER BY value, id)),
      q AS (SELECT *, list_sort(list_filter([{", ".join(f"a{j}, b{j}" for j in (1, 2, 3))}], lambda d: d IS NOT NULL))[3] AS r FROM o),
      m AS (SELECT q.feature, q.id, any_value(q.n) AS n, any_value(q.nc) AS nc, count(*) AS m FROM q JOIN l ON q.feature = l.feature
        AND (abs(l.value - q.value) < q.r OR (q.r = 0 AND l.value = q.value)) GROUP BY q.feature, q.id),
      h AS (SELECT i, coalesce(sum(1.0 / (i - 1)) FILTER (i > 1) OVER (ORDER BY i), 0) AS psi FROM range(1, (SELECT count(*) FROM embeddings) + 1) AS g(i))
      SELECT feature, {r('greatest(0, avg(hn.psi + 1.5 - hc.psi - hm.psi))', 'mutual_info', 8)}
      FROM m JOIN h hn ON hn.i = m.n JOIN h hc ON hc.i = m.nc JOIN h hm ON hm.i = m.m GROUP BY feature""",
    "rank_sum": f"""WITH {RANKS} SELECT feature, {r('u', 'u', 5)}, {r('z', 'z', 5)} FROM z""",
    "relevance_table": f"""WITH {RANKS}, p AS (SELECT feature, {z_tail_sql('z')} AS p_value FROM z),
      k AS (SELECT *, row_number() OVER (ORDER BY p_value, feature) AS i, count(*) OVER () AS m FROM p),
      hm AS (SELECT sum(1.0 / j) AS c FROM range(1, (SELECT count(*) FROM p) + 1) AS g(j)),
      t AS (SELECT max(i) AS top FROM k, hm WHERE p_value <= i * 0.05 / (m * c))
      SELECT feature, 'real' AS type, {r('p_value', 'p_value')}, coalesce(i <= top, false) AS relevant FROM k, t""",
    "f_test_pvalues": f"""WITH {F_SCORES}, n AS (SELECT count(*) - 2 AS nu FROM embeddings)
      SELECT feature, {r('f_score', 'f_score')}, {r(t_tail_sql('sqrt(f_score)', 'nu'), 'p_value')} FROM f, n""",
    "false_discovery_control": f"""WITH {F_SCORES}, p AS (SELECT feature, exp(-f_score) AS p_value FROM f),
      k AS (SELECT *, row_number() OVER (ORDER BY p_value, feature) AS i, count(*) OVER () AS m FROM p),
      hm AS (SELECT sum(1.0 / j) AS c FROM range(1, (SELECT count(*) FROM p) + 1) AS g(j)),
      t AS (SELECT max(i) AS top FROM k, hm WHERE p_value <= i * 0.05 / (m * c))
      SELECT feature, {r('p_value', 'p_value')}, coalesce(i <= top, false) AS relevant FROM k, t""",
    "select_f_test": f"""WITH {F_SCORES}, {CORR}, d AS (SELECT DISTINCT feature FROM p WHERE abs(c) > {THRESHOLD})
      SELECT feature, {r('f_score', 'score')} FROM (SELECT * FROM f WHERE feature NOT IN (SELECT feature FROM d)
        ORDER BY f_score DESC, feature LIMIT 10)""",
    "importance_ranking": f"""WITH {F_SCORES}, {MI},
      s AS (SELECT * FROM mi JOIN f USING (feature)),
      k AS (SELECT *, rank() OVER (ORDER BY round(mutual_info, 10) DESC) + (count(*) OVER (PARTITION BY round(mutual_info, 10)) - 1) / 2 AS a,
        rank() OVER (ORDER BY round(f_score, 10) DESC) + (count(*) OVER (PARTITION BY round(f_score, 10)) - 1) / 2 AS b FROM s)
      SELECT feature, {r('mutual_info', 'mutual_info')}, {r('f_score', 'f_score')}, {r('a', 'mutual_info_rank')},
        {r('b', 'f_score_rank')}, {r('(a + b) / 2', 'avg_rank')} FROM k ORDER BY (a + b) / 2, feature LIMIT 50""",
}
ORACLES["neighbour_information_split"] = ORACLES["neighbour_information"]
