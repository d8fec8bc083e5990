"""A short line inside different texts must not bring its surroundings into one shard."""

import brute
import numpy as np
import pyarrow as pa

from starloom.llm import substring


def test_hot_line_is_spread_over_shards(spark):
    r = np.random.default_rng(3)
    line = "all rights reserved by them"
    words = lambda n: " ".join(f"w{x}" for x in r.integers(0, 10**9, n))
    shared = words(30)
    texts = [f"{words(20)} {line} {words(20)}" + f" {shared}" * (i % 3 == 0) for i in range(600)]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    s = substring.Settings(shard_bytes=12_000, chunk_bytes=40_000)
    total = sum(map(len, texts))
    hot = substring._hot(table, s, total)
    assert len(hot)
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array(range(600), pa.int64()), "key": pa.array([0] * 600, pa.int64()), "text": texts})
    shards = -(-total // s.shard_bytes)

    def largest(hot):
        sizes = np.zeros(shards)
        for k, blob in substring._deal(batch, s, shards, hot):
            text, *_ = substring._unpack(blob, 9)
            sizes[k] += len(text)
        return sizes.max() / sizes.mean()

    # Every sequence of the line is an anchor of some texts: without the count, one shard has many times the mean.
    assert largest(np.zeros(0, np.uint64)) > 2 * largest(hot)
    assert largest(hot) < 2
    got = substring.without_repeats(table, settings=s).select("doc_id", "n_words", "n_removed", "kept_text")
    assert sorted(map(tuple, got.collect())) == sorted(brute.without_repeats(list(enumerate(texts))))
