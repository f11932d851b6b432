import json

from gridledger.streaming import pages


def test_pages_arrive_and_replace(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    put = lambda p, v: (source / f"page-{p:04d}.json").write_text(json.dumps({"flags": [v]}))
    put(1, "a")
    put(2, "b")
    (source / "other.json").write_text(json.dumps({"flags": ["x"]}))
    run = lambda: pages.write_page_stream(pages.read_page_stream(spark, str(source), "flags array<string>"), str(tmp_path / "out"), str(tmp_path / "checkpoint"))
    run()
    put(3, "c")
    run()
    assert sorted((r.page, r.flags[0]) for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [(1, "a"), (2, "b"), (3, "c")]


def test_flag_counts(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    for p, v in enumerate("aab"):
        (source / f"page-{p:04d}.json").write_text(json.dumps({"flags": [v]}))
    stream = pages.flag_counts(pages.read_page_stream(spark, str(source), "flags array<string>"))
    q = stream.writeStream.outputMode("complete").format("memory").queryName("flags").trigger(availableNow=True).start()
    q.awaitTermination()
    out = {}
    for r in spark.table("flags").collect():
        out[r.code] = out.get(r.code, 0) + r.n
    assert out == {"a": 2, "b": 1}
