"""The corpus pipeline: stages over ``documents``, each written and reread.

Every stage takes and returns whole documents with the columns of
``documents``; the last one returns the tokens' table of contents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm import decontaminate, minhash, mixing, quality, queries, token_output
from starloom.session import materialise, scratch_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


#: What the operators read; all other columns travel as one, so that none can clash with a result.
READ = ("doc_id", "text", "source")


def _apart(docs: DataFrame) -> DataFrame:
    others = [c for c in docs.columns if c not in READ]
    return docs.select(*READ, (F.struct(*others) if others else F.lit(None)).alias("others"))


def _whole(found: DataFrame, docs: DataFrame, new_text: bool = False) -> DataFrame:
    """The columns of ``docs`` in their order; a new text has its own length."""
    columns = {c: F.col(c) if c in READ else F.col("others").getField(c) for c in docs.columns}
    if new_text and "n_chars" in columns:
        columns["n_chars"] = F.length("text").cast(docs.schema["n_chars"].dataType)
    return found.select(*[column.alias(c) for c, column in columns.items()])


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go; a null text is rejected."""
    return _whole(quality.quality_rules(_apart(docs)).filter("kept"), docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id stays.

    Of several rows of one id the smallest text stays, of equal texts the one
    whose other columns come first as JSON; rows without an id stay.
    """
    kept = minhash.near_duplicates(docs.select("doc_id", "text")).filter("kept and doc_id is not null").select("doc_id").distinct()
    named = docs.filter("doc_id is not null").join(kept, "doc_id", "left_semi")
    again = materialise(docs.filter("doc_id is not null").groupBy("doc_id").count().filter("count > 1").select("doc_id"))
    if not again.isEmpty():  # only rows of repeated ids are grouped
        row = F.struct(*docs.columns)
        first = F.min_by(row, F.struct(F.col("text"), F.to_json(row))).alias("row")
        one = named.join(again, "doc_id", "left_semi").groupBy("doc_id").agg(first).select("row.*")
        named = named.join(again, "doc_id", "left_anti").select(docs.columns).unionByName(one)
    return named.select(docs.columns).unionByName(docs.filter("doc_id is null"))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of the benchmark are cut out; a document of which no word is left goes."""
    found = decontaminate.decontaminate(_apart(docs), queries.table(spark, sf_dir, "benchmark"))
    left = found.filter("n_hit = 0 or n_hit < n_words")
    return _whole(left.withColumn("text", decontaminate.without_spans()), docs, new_text=True)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in their target shares: a row per whole copy of a document, each source within one document of its target."""
    return _whole(mixing.epochs(mixing.mix(_apart(docs)), whole=True), docs)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in wavelet matrices, and what is read back from them."""
    path = scratch_path(spark)
    token_output.write_tokens(docs, path, queries.vocabulary("word_bpe_49k.json"))
    return token_output.read_tokens(spark, path)


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_stage),
    ("MinHash near-dedup", near_duplicate_stage),
    ("benchmark decontamination", decontamination_stage),
    ("mixing sources to target weights", mixing_stage),
    ("token-ID / binary output", token_stage),
]

#: Tokens cannot be expressed in SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = materialise(docs)
    return docs
