"""Spelling variants against all pairs of words."""

import random

import brute
import numpy as np
import pytest

from starloom.llm import spelling


def rows_of(df):
    return sorted((tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()), key=repr)


@pytest.fixture(scope="module")
def letters(spark):
    """Few letters, so that many words are near; chains of forms, ties, accents, long words, repeated rows."""
    r = random.Random(7)
    words = ["".join(r.choice("abé") for _ in range(r.randint(6, 9))) for _ in range(300)]
    chain = ["holdfast"] * 300 + ["holdfasst"] * 25 + ["hholdfasst"] * 2 + ["Holdfest"] * 25
    long = "z" * 70_000
    texts = [" ".join(r.choice(words) for _ in range(90)) for _ in range(30)] + [" ".join(chain), f"{long} {long} {long}y-{long}y"]
    rows = [*enumerate(texts), (0, texts[0]), (None, texts[1]), (50, None), (51, ""), (52, "Ünïcode×÷ Ünïcode×÷ ünïcode×÷ short")]
    return rows, spark.createDataFrame([(i, t, "w", 5, "r") for i, t in rows], "doc_id long, text string, word string, n int, root string").repartition(3)


@pytest.mark.parametrize("settings", [spelling.Settings(), spelling.Settings(block=20, task_rows=500), spelling.Settings(segments=2, block=50, refinements=0)])
def test_every_near_pair_counts_once(letters, settings):
    rows, docs = letters
    want = sorted(brute.spelling(rows), key=repr)
    assert rows_of(spelling.spelling_groups(docs, settings=settings, slip=31)) == want


def test_texts_as_they_are_and_none(letters, docs, texts, nothing):
    rows, table = letters
    want = sorted(brute.spelling(rows, slip=0), key=repr)
    assert rows_of(spelling.spelling_groups(table)) == want
    assert {w: (f, x) for w, f, x, *_ in want}["hholdfasst"] == ("holdfasst", "holdfast")
    assert rows_of(spelling.spelling_groups(docs)) == sorted(brute.spelling([r[:2] for r in texts], slip=0), key=repr)
    assert rows_of(spelling.spelling_groups(nothing)) == []


def test_checksums_go_on():
    import zlib

    data = np.random.default_rng(1).integers(0, 256, 5000).astype(np.uint8)
    starts = np.array([0, 3, 3, 100, 400, 4999])
    ends = starts + np.array([1, 0, 90, 300, 64, 1])
    before = np.array([zlib.crc32(b"12:"), 0, 7, 2**32 - 1, zlib.crc32(b":"), 1], np.uint32)
    want = [zlib.crc32(data[a:b].tobytes(), int(c)) for a, b, c in zip(starts, ends, before)]
    assert spelling.crc32(data, starts, ends, before).tolist() == want
