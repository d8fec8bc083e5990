"""Word scores against a plain version, on texts that only whole words and characters tell apart."""

from collections import Counter

import numpy as np
import pytest

from starloom.llm import word_scoring
from starloom.llm.queries import op8_lm_scoring
from starloom.session import scratch_path

SMALL = word_scoring.Settings(block_bytes=300, shard_bytes=200)


def plain(texts, good, s):
    """Losses (target, background) of each text, from counts of words and pairs in dictionaries."""
    whole = [[None, *t.split(), None] for t in texts]
    models = []
    for chosen in (good, [True] * len(texts)):
        single, pairs = Counter(), Counter()
        for w, g in zip(whole, chosen, strict=True):
            if g and len(w) > 2:
                single.update(w[1:])
                pairs.update(zip(w, w[1:]))
        models.append((single, pairs, sum(single.values())))
    vocabulary, least = len(models[1][0]), min(m[2] for m in models)
    out = []
    for w in whole:
        row = []
        for single, pairs, size in models:
            scale = least / size if least else 1
            base = lambda x: (scale * single[x] + s.word_prior) / (scale * size + s.word_prior * vocabulary)
            p = [(scale * pairs[a, b] + s.pair_prior * base(b)) / (scale * single[a] + s.pair_prior) for a, b in zip(w, w[1:-1])]
            row.append(-np.mean(np.log(p)) if p else None)
        out.append(tuple(row))
    return out


def rows(spark, texts, marks, settings=SMALL):
    docs = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], "doc_id long, text string, Score string").repartition(3)
    labels = spark.createDataFrame([(i, int(m)) for i, m in enumerate(marks) if m is not None], "doc_id long, quality int")
    scored = word_scoring.cross_entropy_difference(docs, labels, settings=settings)
    assert scored.columns == ["doc_id", "text", "n_tokens", "target_loss", "background_loss", "score"]
    return {r["doc_id"]: r for r in scored.collect()}


@pytest.mark.parametrize("settings", [SMALL, word_scoring.Settings()])
def test_losses_are_those_of_a_plain_count(spark, settings):
    r = np.random.default_rng(5)
    texts = [" ".join(r.choice(["é", "è", "а", "б", "The", "the", "x,"], r.integers(0, 40))) for _ in range(80)] + ["", " \n"]
    marks = [(True, False, None)[i % 3] for i in range(len(texts))]
    got = rows(spark, texts, marks, settings)
    want = plain(texts, [bool(m) for m in marks], settings)
    for i, t in enumerate(texts):
        assert got[i]["n_tokens"] == len(t.split())
        if not t.split():
            assert got[i]["target_loss"] is None and got[i]["score"] is None
        else:
            assert (got[i]["target_loss"], got[i]["background_loss"]) == pytest.approx(want[i], abs=1e-9)
            assert got[i]["score"] == pytest.approx(want[i][0] - want[i][1], abs=1e-9)


def test_query_tells_letters_of_one_byte_class(spark):
    """'é' and 'è', 'а' and 'б', upper and lower case are different words of the corpus."""
    path = scratch_path(spark)
    texts = ["é а The"] * 5 + ["è б the"] * 5 + [None]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, 1) for i in range(4)], "doc_id long, quality int").write.parquet(f"{path}/labels.parquet")
    got = {r["doc_id"]: r for r in op8_lm_scoring(spark, path).collect()}
    assert got[4]["score"] < got[5]["score"] - 0.001
    assert got[10]["score"] is None and got[10]["n_tokens"] == 0


def test_word_scores_tell_good_texts(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = word_scoring.cross_entropy_difference(docs, labels.filter("doc_id % 2 = 0"))
    held = scored.join(labels.filter("doc_id % 2 = 1"), "doc_id").filter("score is not null").toPandas()
    good, bad = held[held.quality == 1].score.to_numpy(), held[held.quality == 0].score.to_numpy()
    assert (good[:, None] < bad[None, :]).mean() > 0.85


def test_nothing_and_no_target(spark, docs, nothing):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert word_scoring.cross_entropy_difference(nothing, labels).count() == 0
    scored = word_scoring.cross_entropy_difference(docs, labels, settings=SMALL)
    assert scored.count() == docs.count()
    assert scored.filter("target_loss is not null").agg({"target_loss": "stddev"}).first()[0] < 1e-9  # one chance for all words
