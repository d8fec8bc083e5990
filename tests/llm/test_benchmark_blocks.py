"""A benchmark of several blocks: one block's broadcast lives at a time, and a plan holds one search."""

from starloom.llm import decontaminate


def test_one_block_is_broadcast_at_a_time(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"one two three four item{i} five six") for i in range(30)], "doc_id long, text string")
    benchmark = spark.createDataFrame([(i, f"item{i} five six") for i in range(0, 30, 2)], "item_id long, text string")
    made, most = [], [0]
    context = type(spark.sparkContext)
    send = context.broadcast

    def broadcast(self, value):
        out = send(self, value)
        if isinstance(value, decontaminate.Phrases):
            destroy = out.destroy
            out.destroy = lambda *a: (made.remove(out), destroy(*a))
            made.append(out)
            most[0] = max(most[0], len(made))
        return out

    want = sorted((r["doc_id"], r["n_hit"], r["items"]) for r in decontaminate.decontaminate(docs, benchmark).collect())
    monkeypatch.setattr(context, "broadcast", broadcast)
    found = decontaminate.decontaminate(docs, benchmark, block_bytes=60)
    assert most[0] == 1 and len(made) == 1
    assert found._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    assert sorted((r["doc_id"], r["n_hit"], r["items"]) for r in found.collect()) == want
    assert sum(n for _, n, _ in want) == 45
