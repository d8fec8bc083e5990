"""The pipeline against plain versions of its stages, each over all that the one before kept."""

import re
import zlib

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from starloom.llm.queries import vocabulary
from starloom.llm.tokens import PieceEncoder
from starloom.session import scratch_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def cut(text, hit):
    """The text without its hit words and what stands between two of them."""
    spans = [m.span() for m in re.finditer(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.translate(brute.LOWER))]
    out, at = [], 0
    for j, (a, b) in enumerate(spans):
        if j in hit:
            if j - 1 not in hit:
                out.append(text[at:a])
            at = b
    return "".join([*out, text[at:]])


def plain(docs, benchmark):
    """docs: (id, text, source). Rows (id, start, tokens, crc)."""
    kept = [d for d in docs if brute.quality(d[1])[-1]]
    stays = {i for i, _, _, k in brute.near_duplicates([d[:2] for d in kept]) if k}
    kept = [d for d in kept if d[0] in stays]
    left = []
    for i, t, s in kept:
        _, n, h, _ = brute.decontaminate([(i, t)], benchmark)[0]
        if h == 0:
            left.append((i, t, s))
        elif h < n:
            left.append((i, cut(t, brute.hits(t, benchmark)), s))
    texts = {i: t for i, t, _ in left}
    copies = []
    for i, _, size, taken in brute.mix([(i, s, t) for i, t, s in left]):
        copies += [(i, texts[i])] * ((2 * taken + size) // (2 * size) if size else 0)
    coder, start, out = PieceEncoder(vocabulary("word_bpe_49k.json"), "dropped"), 0, []
    for i, t in sorted(copies):
        ids = np.append(coder.whole(t), 1).astype("<u4")
        out.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


@pytest.fixture(scope="module")
def folder(spark, sf_dir):
    """The smallest documents with a null text, an empty one and copies; the benchmark with a short item."""
    path = scratch_path(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    more = docs.filter("doc_id < 20").withColumn("doc_id", F.col("doc_id") + 5000)
    odd = spark.createDataFrame([(9000, None, "en", "src0", None), (9001, "", "en", None, 0), (9002, "a b", "en", "", 3)], docs.schema)
    docs.unionByName(more).unionByName(odd).write.parquet(f"{path}/documents.parquet")
    spark.read.parquet(f"{sf_dir}/benchmark.parquet").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_pipeline(spark, folder):
    got = sorted(tuple(r) for r in corpus_pipeline.run(spark, folder).collect())
    docs = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", "source").collect()]
    benchmark = [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").select("item_id", "text").collect()]
    assert got == sorted(plain(docs, benchmark))


def test_stages_keep_the_columns_and_take_nothing(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.columns == COLUMNS and out.count() == 0, name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, folder).count() == 0


def test_one_row_of_an_id_stays(spark, folder):
    long = " ".join(f"w{i}" for i in range(60))
    rows = [(1, long, "a"), (1, long, "a"), (1, long + " x", "a"), (2, long, "b"), (None, long, "c"), (None, None, "c")]
    docs = spark.createDataFrame([(i, t, "en", s, 1) for i, t, s in rows], "doc_id long, text string, lang string, source string, n_chars long")
    out = corpus_pipeline.near_duplicate_stage(spark, docs, folder)
    assert sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=repr) == sorted([(1, long), (None, long), (None, None)], key=repr)


#: Result names of the operators, private ones of the library, and names of Spark's own kind.
CLASHES = (
    "size target taken source_size kept n_words n_hit items spans word_spans removed row others key _key __key __place __copy __host _size"
    " base_failed word_chars component_id n_shingles count again n_tokens start"
).split()


def test_extra_columns_of_any_name_stay(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    extra = docs.select("*", *[F.concat(F.lit(f"{c} "), F.col("doc_id").cast("string")).alias(c) for c in CLASHES]).limit(120)
    extra = extra.withColumn("pairs", F.create_map(F.lit("a"), F.col("doc_id")))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, extra, folder)
        plain = stage(spark, extra.select(docs.columns), folder)
        assert out.columns == extra.columns, name
        wrong = out.filter(" or ".join(f"`{c}` is distinct from concat('{c} ', doc_id)" for c in CLASHES) + " or pairs['a'] is distinct from doc_id")
        assert wrong.isEmpty() and sorted(map(repr, out.select(docs.columns).collect())) == sorted(map(repr, plain.collect())), name


def test_reruns_keep_the_same_row(spark, folder):
    long = " ".join(f"w{i}" for i in range(60))
    rows = [(1, long, "en", s, 1) for s in ("c", None, "b", "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for parts in (1, 2, 4):
        assert [r["source"] for r in corpus_pipeline.near_duplicate_stage(spark, docs.repartition(parts), folder).collect()] == [None]  # an absent value comes first in JSON
