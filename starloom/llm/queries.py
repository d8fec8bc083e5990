"""The operators bound to the given tables, with their SQL twins."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm import chat, decontaminate, minhash, mixing, oracles, page_text, periodic, quality, spelling, substring, token_counts, token_output, url_filter, word_scoring
from starloom.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring.without_repeats(docs).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256")
    )


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    narrow = docs.select("doc_id", "source", mixing.n_words("text").alias("words"))
    return mixing.mix(narrow, size="words").select("doc_id", "source", "size", "source_size", "target", "taken")


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.quality_rules(docs).drop("text")


def vocabulary(name: str) -> str:
    """Place of a public tokenizer's file; the package is installed on every executor."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts.token_counts(docs, vocabulary("byte_bpe_50k.json")).drop("text")


#: Rules of the contract: verdict, host, path. Fixed values.
PLACE_RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = tuple(url_filter.place_rule(*r) for r in PLACE_RULES)
    return url_filter.filter_urls(table(spark, sf_dir, "pages").select("page_id", "url"), rules).drop("url")


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return word_scoring.cross_entropy_difference(docs, table(spark, sf_dir, "labels")).drop("text")


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    kinds = [f"cast({c} as {rows.schema[c].dataType.simpleString()}) as {c}" for c in rows.columns]
    marks = "transform(array('user', 'assistant'), (r, i) -> struct(-7 as conv_id, i as turn, r as role, t as text))"
    extra = spark.range(1).select(F.lit("\\### Assistant: </turn> ok").alias("t")).selectExpr(f"inline({marks})").selectExpr(*kinds)
    chats = chat.read_chats(chat.format_chats(rows.unionByName(extra)))
    loss = F.array_join("loss_texts", "")
    spoken = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return chats.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(F.array_join(spoken, ""), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op10_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark)
    token_output.write_tokens(table(spark, sf_dir, "documents"), path, vocabulary("word_bpe_49k.json"))
    return token_output.read_tokens(spark, path)


#: One of so many runs loses a letter; fixed by the contract.
SLIP = 31


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_groups(table(spark, sf_dir, "documents"), slip=SLIP)


def planted_runs(ids: pa.Array, first: np.ndarray) -> np.ndarray:
    """Word numbers with periodic stretches in a tenth of the texts, as the contract says; a null id counts as an empty one."""
    out = np.arange(first[-1])
    for i, (start, n) in zip(ids.to_pylist(), zip(first[:-1].tolist(), np.diff(first).tolist())):
        h = zlib.crc32(("" if i is None else str(i)).encode())
        if h % 10 == 0 and n:
            a = h // 10 % n
            out[start + a : start + n] = start + a + np.arange(n - a) % (1 + (n - a) // (3 + h // 10 % 8))
    return out


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = periodic.periodic_runs(docs, order=planted_runs).withColumn("best", periodic.strongest(F.col("runs")))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], F.concat(r["period"].cast("string"), F.lit("\n"))))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed_text", 256).alias("collapsed_sha256"),
    )


def op13_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_text.main_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


QUERIES: dict[str, Query] = {
    "op1_minhash_near_dedup": op1_minhash_near_dedup,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_benchmark_decontamination": op3_benchmark_decontamination,
    "op4_mix_sources": op4_mix_sources,
    "op5_quality_rules": op5_quality_rules,
    "op6_token_counts": op6_token_counts,
    "op7_url_filter": op7_url_filter,
    "op8_lm_scoring": op8_lm_scoring,
    "op9_chat_format": op9_chat_format,
    "op10_token_output": op10_token_output,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_html_extraction": op13_html_extraction,
}
ORACLES: dict[str, str] = {
    "op1_minhash_near_dedup": oracles.OP1,
    "op2_substring_dedup": oracles.OP2,
    "op3_benchmark_decontamination": oracles.OP3,
    "op4_mix_sources": oracles.OP4,
    "op5_quality_rules": oracles.OP5,
    "op7_url_filter": oracles.OP7,
    "op9_chat_format": oracles.OP9,
    "op11_spelling_variants": oracles.OP11,
    "op12_periodic_runs": oracles.OP12,
    "op13_html_extraction": oracles.OP13,
}
