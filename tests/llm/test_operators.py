"""Every operator against its plain version, over nulls, empty, long, equal and repeated texts."""

import hashlib
import zlib

import brute
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from starloom.llm import chat, components, decontaminate, minhash, mixing, quality, substring, token_counts, token_output
from starloom.llm import url_filter, words
from starloom.llm.fm_index import FMIndex
from starloom.llm.queries import PLACE_RULES, vocabulary
from starloom.llm.tokens import PieceEncoder
from starloom.llm.wavelet import WaveletMatrix
from starloom.session import scratch_path


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def test_word_hashes_do_not_depend_on_blocks(monkeypatch):
    column = pa.array(["a b  cc", None, "", " a\nb", "x" * 5000 + " y"])
    found = words.find_words(*words.text_bytes(column))
    whole = found.hashes()
    assert found.counts.tolist() == [3, 0, 0, 2, 2] and whole[0] == whole[3]
    monkeypatch.setattr(words, "BLOCK", 64)
    words._powers.cache_clear()
    assert (found.hashes() == whole).all()
    words._powers.cache_clear()


@pytest.mark.parametrize("size", [0, 1, 5, 64, 300])
def test_wavelet_matrix(size):
    values = np.random.default_rng(size).integers(0, 20, size)
    m = WaveletMatrix.of(values)
    places = np.arange(size + 1)
    assert (m.all() == values).all() and (m.access(np.arange(size)) == values).all()
    for v in range(40):
        assert m.rank(np.full(size + 1, v), places).tolist() == [int((values[:i] == v).sum()) for i in places]
        at = np.flatnonzero(values == v)
        assert m.select(np.full(len(at), v), np.arange(len(at))).tolist() == at.tolist()


@pytest.mark.parametrize("size", [0, 1, 7, 400])
def test_fm_index_finds_every_occurrence(size):
    r = np.random.default_rng(size)
    text = r.integers(1, 4, size)
    index = FMIndex(text, keep_order=True)
    whole = [*text.tolist(), 0]
    assert index.order.tolist() == sorted(range(size + 1), key=lambda i: whole[i:])
    for n in (1, 3, 8):
        patterns = r.integers(1, 6, (40, n))
        patterns[:3, 0] = -1
        which, at = index.occurrences(*index.search(patterns, np.full(40, n)))
        for k, p in enumerate(patterns.tolist()):
            assert sorted(at[which == k].tolist()) == [i for i in range(size - n + 1) if text[i : i + n].tolist() == p]


def test_near_duplicates(docs, texts, nothing):
    got = rows_of(minhash.near_duplicates(docs), "doc_id", "n_shingles", "component_id", "kept")
    assert got == sorted(brute.near_duplicates([r[:2] for r in texts]), key=repr)
    assert minhash.near_duplicates(nothing).count() == 0


def test_links_across_components_are_found(spark):
    """A chain whose ends are far apart, and texts that share a passage without a link."""
    import random

    r = random.Random(5)
    base = [f"w{r.randint(0, 10**6)}" for _ in range(200)]
    rows, now = [], list(base)
    for i in range(40):
        rows.append((500 - i, " ".join(now)))
        now[(i * 37) % 200] = f"v{i}"
    passage = [f"p{i}" for i in range(60)]
    rows += [(1000 + i, " ".join(passage + [f"q{i}_{j}" for j in range(20 + i % 9)])) for i in range(60)]
    got = rows_of(minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")), "doc_id", "n_shingles", "component_id", "kept")
    assert got == sorted(brute.near_duplicates(rows), key=repr)


@pytest.mark.parametrize("shape", ["path", "star", "ring"])
def test_components(spark, shape):
    n = 300
    pairs = {"path": [(i, i + 1) for i in range(n)], "star": [(n, i) for i in range(n)], "ring": [(i, (i + 7) % n) for i in range(n)]}[shape]
    links = spark.createDataFrame([*pairs, (1000, 1001), (1001, 1000), (2000, 2000)], "a long, b long")
    got = dict(rows_of(components.components(links), "node", "component"))
    assert {v for k, v in got.items() if k < 1000} == {0} and got[1001] == 1000 and 2000 not in got


def test_substring_dedup(docs, texts, nothing):
    want = sorted(brute.without_repeats([r[:2] for r in texts]), key=repr)
    assert rows_of(substring.without_repeats(docs), "doc_id", "n_words", "n_removed", "kept_text") == want
    small = substring.Settings(shard_bytes=30_000, chunk_bytes=20_000)
    assert rows_of(substring.without_repeats(docs, settings=small), "doc_id", "n_words", "n_removed", "kept_text") == want
    assert substring.without_repeats(nothing).count() == 0


def test_texts_of_one_id_are_judged_apart(spark):
    import random

    r = random.Random(9)
    a, b = (" ".join(f"w{r.randint(0, 10**6)}" for _ in range(20)) for _ in range(2))
    rows = [(1, a), (5, a), (5, b), (5, b), (7, b), (None, a), (5, None)]
    got = rows_of(substring.without_repeats(spark.createDataFrame(rows, "doc_id int, text string")), "doc_id", "n_removed", "kept_text")
    assert got == sorted([(1, 0, a), (5, 20, ""), (5, 0, b), (5, 0, b), (7, 20, ""), (None, 0, a), (5, 0, "")], key=repr)


def test_decontamination(spark, docs, texts, nothing):
    passage = texts[10][1].split("  ")[1]
    items = [(1, passage), (1, passage[30:]), (2, "One, TWO!"), (10, "it's"), (None, "ha ha"), (3, None), (4, "!!"), (5, "日本"), (11, "ha " * 30)]
    benchmark = spark.createDataFrame(items, "item_id int, text string")
    found = decontaminate.decontaminate(docs, benchmark)
    want = sorted(((i, n, h, x) for i, n, h, x in brute.decontaminate([r[:2] for r in texts], items)), key=repr)
    assert rows_of(found, "doc_id", "n_words", "n_hit", "items") == want
    blocks = decontaminate.decontaminate(docs, benchmark, block_bytes=40)
    assert rows_of(blocks, "doc_id", "n_hit", "items", "spans") == rows_of(found, "doc_id", "n_hit", "items", "spans")
    assert decontaminate.decontaminate(docs, benchmark.limit(0)).filter("n_hit > 0").count() == 0
    assert decontaminate.decontaminate(nothing, benchmark).count() == 0
    # What is left when the spans are cut holds as many words as were not hit.
    left = found.filter("doc_id = 4 or doc_id = 11").select("doc_id", decontaminate.without_spans().alias("text")).collect()
    for i, t in left:
        assert len(brute.letters(t)) == next(n - h for j, n, h, _ in want if j == i)


def test_mixing(docs, texts, nothing):
    mixed = mixing.mix(docs, settings=mixing.Settings(range_rows=7))
    want = brute.mix([(i, s, t) for i, t, s in texts])
    assert rows_of(mixed, "doc_id", "source", "size", "taken") == sorted(want, key=repr)
    shares = brute.targets({s: sum(r[2] for r in want if r[1] == s) for s in {r[1] for r in want}})
    for s, t, taken in mixed.groupBy("source").agg(F.max("target"), F.sum("taken")).collect():
        assert t == pytest.approx(shares[s]) and abs(taken - t) <= 0.5
    copies = mixing.epochs(mixed)
    assert copies.select(F.sum(mixing.n_words("text"))).first()[0] == sum(r[3] for r in want)
    assert mixing.mix(nothing).count() == 0


def test_quality(docs, texts, nothing):
    got = rows_of(quality.quality_rules(docs), "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    assert got == sorted(((i, *brute.quality(t)) for i, t, _ in texts), key=repr)
    assert quality.quality_rules(nothing).count() == 0


@pytest.mark.parametrize("name,spaces", [("byte_bpe_50k.json", "leading"), ("word_bpe_49k.json", "dropped")])
def test_pieces_give_the_same_tokens(name, spaces):
    import random

    r = random.Random(3)
    parts = [" ", "  ", "\n", "\t", "\r\n", "a", "B", "é", "é", " ", "　", "ß", "İ", "1", "23", "'s", "don't", "<|endoftext|>"]
    parts += ["<|startoftext|>", "!", "...", "日本", "​", "\x1c", "\x0b", "\x85", "ΣΑΣ", "ﬁ", "\U0001f600", "﻿"]
    coder = PieceEncoder(vocabulary(name), spaces, cache=500)
    for _ in range(20):
        texts = ["".join(r.choice(parts) for _ in range(r.randint(0, 14))) for _ in range(200)]
        ids, counts = coder.encode(pa.array(texts))
        assert ids.tolist() == [x for e in coder.tokenizer.encode_batch(texts, add_special_tokens=False) for x in e.ids]
        assert counts.tolist() == [len(e.ids) for e in coder.tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_overlapping_chunks_count_alike():
    import random

    r = random.Random(5)
    parts = [" ", "   ", "\n", "a", "é", " ", "1", "'s", "don't", "<|endoftext|>", "!", "日本", "word", " the", "x" * 60, " " * 90]
    coder = PieceEncoder(vocabulary("byte_bpe_50k.json"), "leading")
    for _ in range(300):
        text = "".join(r.choice(parts) for _ in range(r.randint(0, 300)))
        chunk, overlap = r.choice([(60, 20), (100, 40), (50, 8)])
        assert token_counts.count_huge(coder, text, token_counts.Settings(chunk=chunk, overlap=overlap, margin=16)) == len(coder.whole(text))


def test_token_counts(docs, texts, nothing):
    path = vocabulary("byte_bpe_50k.json")
    coder = PieceEncoder(path, "leading")
    want = [(i, len((t or "").encode()), len(coder.whole(t or "")), len(coder.whole(t or "")) > 512) for i, t, _ in texts]
    settings = token_counts.Settings(chunk=5000)
    got = rows_of(token_counts.token_counts(docs, path, settings=settings), "doc_id", "n_bytes", "n_tokens", "over_limit")
    assert got == sorted(want, key=repr)
    assert token_counts.token_counts(nothing, path).count() == 0


def test_urls(spark):
    rules = tuple(url_filter.place_rule(*r) for r in PLACE_RULES)
    cases = {
        "http://A.example.COM/en/x?q=/fr/": ("a.example.com", "/en/x", "example.com/en/", "block"),
        "https://www.example.com/en/": ("www.example.com", "/en/", "www.example.com/en/", "allow"),
        "https://b.www.example.com/en/1#top": ("b.www.example.com", "/en/1", "www.example.com/en/", "allow"),
        "http://notexample.com/en/": ("notexample.com", "/en/", "com/", "allow"),
        "http://a.net/ES/": ("a.net", "/ES/", None, "allow"),
        "http://a.net/es/": ("a.net", "/es/", "net/es/", "block"),
        "http://a.com": ("a.com", "", None, "allow"),
        "http://a.com?u=http://b.net/es/": ("a.com", "", None, "allow"),
        "http://x.org/poker/1": ("x.org", "/poker/1", None, "block"),
        "http://x.org/pokers/1": ("x.org", "/pokers/1", None, "allow"),
        "http://1.2.3.4/a": ("1.2.3.4", "/a", None, "block"),
        "a.com/en/": ("", "", None, "block"), "": ("", "", None, "block"), None: ("", "", None, "block"),
    }
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(cases)] + [(0, next(iter(cases)), "h")], "page_id int, url string, Host string")
    got = url_filter.filter_urls(pages, rules).select("url", "host", "path", "rule", "verdict").collect()
    assert len(got) == len(cases) + 1 and all(tuple(r[1:]) == cases[r[0]] for r in got)
    assert url_filter.filter_urls(pages.limit(0), rules).count() == 0
    # A word cut off by a rule's path is no whole token of an address.
    assert url_filter.place_rule("block", "a.com", "/fo").tokens == ("a", "com")
    assert url_filter.filter_urls(spark.createDataFrame([("http://a.com/foo",)], "url string"), (url_filter.place_rule("block", "a.com", "/fo"),)).first()["verdict"] == "block"


def test_chats_read_back(spark):
    rows = [
        (1, 2, "user", "a\\"), (1, 1, "user", None), (1, 3, "assistant", "x</turn>\n### user: </turn"),
        (1, 3, "assistant", "x</turn>\n### user: </turn"), (1, None, "sys:tem: \\", "<\\/turn>##\\# \\\\"), (2, 1, None, ""),
        (None, 1, "assistant", "\n### ### #### </turn></turn>"), (3, 0, "assistant", ""), (4, 1, "assistant", "long " * 50_000),
    ]
    table = spark.createDataFrame([(*r, "f") for r in rows], "conv_id long, turn int, role string, text string, formatted string")
    chats = chat.read_chats(chat.format_chats(table)).collect()
    assert len(chats) == 5
    for c in chats:
        own = sorted((r[1] is not None, r[1] or 0, r[2] or "", r[3] or "") for r in rows if r[0] == c["conv_id"])
        assert [tuple(t) for t in c["turns"]] == [r[2:] for r in own]
        assert c["loss_texts"] == [r[3] for r in own if r[2] == "assistant"]
    first = next(c for c in chats if c["conv_id"] == 1)["formatted"]
    assert first.count("\n### user: ") == 1 and first.endswith("</turn>")
    assert chat.read_chats(chat.format_chats(table.limit(0))).count() == 0


def test_chats_of_any_size(spark):
    role = "r:\\" * 33_334
    rows = [(1, i, "assistant" if i % 2 else role if i == 2 else "user", f"t{i} ### ") for i in range(100_000)] + [(2, 0, "assistant", "é\U0001f600" * 90_000)]
    got = {c["conv_id"]: c for c in chat.read_chats(chat.format_chats(spark.createDataFrame(rows, "conv_id long, turn int, role string, text string"))).collect()}
    assert [tuple(t) for t in got[1]["turns"]] == [r[2:] for r in rows[:-1]] and got[1]["loss_texts"] == [r[3] for r in rows[:-1] if r[2] == "assistant"]
    assert got[2]["loss_texts"] == [rows[-1][3]]
    for c in got.values():
        assert [chat_text(c["formatted"][s : s + n]) for s, n in c["loss_spans"]] == c["loss_texts"]


def chat_text(escaped):
    import re

    return re.sub(r"(?s)\\(.)", r"\1", escaped)


def test_tokens_round_trip(spark, docs, texts, nothing):
    path, to = vocabulary("word_bpe_49k.json"), scratch_path(spark)
    settings = token_output.Settings(shard_tokens=9000, partition_bytes=100_000)
    token_output.write_tokens(docs, to, path, settings=settings)
    coder, start, want = PieceEncoder(path, "dropped"), 0, []
    for i, t, _ in sorted(texts, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = np.append(coder.whole(t or ""), 1).astype("<u4")
        want.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    got = rows_of(token_output.read_tokens(spark, to), "doc_id", "start", "n_tokens", "ids_crc32")
    assert got == sorted(want, key=repr)
    assert spark.read.parquet(to).count() > 2
    token_output.write_tokens(nothing, to, path)
    assert token_output.read_tokens(spark, to).count() == 0


def test_shard_answers_from_its_file():
    ids = np.random.default_rng(1).integers(0, 3000, 9000)
    shard = token_output.Shard(token_output.pack(ids, np.arange(2), np.zeros(2, bool), np.array([4000, 5000]), block_bits=1024))
    assert (shard.all() == ids).all() and [shard.access(i) for i in range(0, 9000, 500)] == ids[::500].tolist()
    for token in (0, int(ids[7]), 2999, 3500, 10**6, -1):
        at = np.flatnonzero(ids == token)
        assert shard.count(token) == len(at) and shard.count(token, 100, 7000) == ((at >= 100) & (at < 7000)).sum()
        assert [shard.find(token, n) for n in range(len(at) + 1)] == [*at.tolist(), -1]


def test_digest_of_kept_text_is_the_contract(spark, sf_dir):
    from starloom.llm.queries import op2_substring_dedup

    docs = [(r[0], r[1]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    want = sorted(((i, n, g, hashlib.sha256(t.encode()).hexdigest()) for i, n, g, t in brute.without_repeats(docs)), key=repr)
    assert rows_of(op2_substring_dedup(spark, sf_dir), "doc_id", "n_words", "n_removed", "kept_sha256") == want
