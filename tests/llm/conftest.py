import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))


def prose(n, seed):
    r = random.Random(seed)
    return " ".join("".join(r.choice("aeioustrn") for _ in range(r.randint(1, 6))) for _ in range(n))


def edited(text, step):
    """A near copy: every step-th word replaced."""
    return " ".join("x" + w if i % step == step - 1 else w for i, w in enumerate(text.split(" ")))


@pytest.fixture(scope="session")
def texts():
    """(doc_id, text, source): nulls, empty and long texts, copies, near copies, shared passages, repeated rows."""
    base, passage, long = prose(120, 1), prose(40, 2), prose(40_000, 3)
    line = "this line stands here twice and has a few words\n"
    rows = [
        (1, None, "b"), (2, "", "b"), (3, " \n\t ", None), (4, "One two", "a"), (5, "one TWO", "a"),
        (6, base, "a"), (7, base, "c"), (8, edited(base, 60), "c"), (9, edited(base, 61), "c"), (10, edited(base, 9), "c"),
        (11, prose(30, 4) + "  " + passage, "d"), (12, passage + "\n" + prose(30, 5), "d"), (13, prose(10, 6) + passage.upper(), "d"),
        (14, long, "e"), (15, prose(5, 7) + long, "a"), (16, (line + prose(30, 8) + "\n") * 2 + prose(60, 9), ""),
        (17, "ha " * 4000, "b"), (18, "é日本 ß x  \x0b y\r\n" * 30, None), (19, "$$$ ### " * 40 + prose(60, 10), "b"),
        (20, "a\\b </turn> <|endoftext|> it's 12", "b"), (20, "a\\b </turn> <|endoftext|> it's 12", "b"),
        (None, base, "a"), (None, None, None),
    ]
    r = random.Random(11)
    rows += [(100 + i, prose(r.randint(1, 90), 100 + i) + " " + passage * (i % 5 == 0), "src" + str(i % 3)) for i in range(60)]
    return rows


@pytest.fixture(scope="session")
def docs(spark, texts):
    """The texts with columns whose names clash with results."""
    clash = "doc_id long, text string, source string, n_words string, Kept string, size int, verdict string, spans string, n_chars int"
    return spark.createDataFrame([(*r, "w", "k", 7, "v", "s", len(r[1] or "")) for r in texts], clash).repartition(3)


@pytest.fixture(scope="session")
def nothing(docs):
    return docs.limit(0)
