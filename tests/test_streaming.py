import time

import pytest
from pyspark.sql import functions as F

from docketry.streaming import incremental
from docketry.streaming.incremental import collect_pages, once, read_batches, run_pending

SCHEMA = "doc string, page_num int, expected_pages int, markdown string, token_count int, error boolean"


def test_only_pending_work_is_done(spark, tmp_path):
    source, sink, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    work = lambda rows: rows.select("k", (F.col("k") * 10).alias("v"))
    for batch in ([1, 2, 2], [2, 3], []):
        spark.createDataFrame([(k,) for k in batch], "k int").write.mode("append").parquet(source)
        run_pending(spark, source, "k int", sink, mark, work, "k")
    assert sorted(r.k for r in read_batches(spark, sink).collect()) == [1, 2, 3]
    run_pending(spark, source, "k int", sink, str(tmp_path / "fresh"), work, "k")
    assert read_batches(spark, sink).count() == 3


def test_documents_come_out_once_complete(spark, tmp_path):
    source = str(tmp_path / "pages")
    (tmp_path / "pages").mkdir()
    out = collect_pages(spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(source))
    query = out.writeStream.format("memory").queryName("collected").option("checkpointLocation", str(tmp_path / "mark")).start()
    try:
        for rows in ([("a", 2, 2, "y", 1, False), ("bad", 1, 2, "q", 1, True), ("c", 1, 1, "z", 4, False)], [("a", 1, 2, "x", 2, False), ("bad", 2, 2, "r", 1, False)]):
            spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(source)
            query.processAllAvailable()
        got = {tuple(r) for r in spark.sql("SELECT * FROM collected").collect()}
    finally:
        query.stop()
    assert got == {("a", 2, "xy", 3), ("c", 1, "z", 4)}


def test_what_nothing_comes_of_leaves_the_state(spark, tmp_path):
    source = str(tmp_path / "pages")
    spark.createDataFrame([("bad", 1, 2, "q", 1, True), ("late", 1, 2, "s", 1, False), ("c", 1, 1, "z", 4, False)], SCHEMA).coalesce(1).write.parquet(source)
    out = collect_pages(spark.readStream.schema(SCHEMA).parquet(source), "1 second")
    query = out.writeStream.format("memory").queryName("forgotten").option("checkpointLocation", str(tmp_path / "mark")).trigger(processingTime="1 second").start()
    try:
        until = time.time() + 40
        kept = []
        while time.time() < until and not (kept and max(kept) == 3 and kept[-1] == 0):  # a mark of each of two documents, and one page
            time.sleep(0.5)
            kept = [s.numRowsTotal for p in query.recentProgress for s in p.stateOperators]
        assert max(kept) == 3 and kept[-1] == 0 and {r.doc for r in spark.sql("SELECT * FROM forgotten").collect()} == {"c"}
    finally:
        query.stop()


@pytest.mark.parametrize("step", ["rows", "keys"])
def test_a_batch_that_fails_between_its_writes_and_the_commit_is_not_there_twice(spark, tmp_path, monkeypatch, step):
    source, sink, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    work = lambda rows: rows.where("k <> 7").select("k")
    spark.createDataFrame([(k,) for k in (1, 2, 7)], "k int").write.parquet(source)
    run_pending(spark, source, "k int", sink, mark, work, "k")
    spark.createDataFrame([(k,) for k in (2, 3, 4, 7)], "k int").write.mode("append").parquet(source)
    kind = type(spark.range(1).write)
    plain = kind.parquet

    def fails(self, path, *a, **b):
        plain(self, path, *a, **b)
        if "batch=1" in path and (step == "rows") != ("-keys" in path):
            raise RuntimeError("lost")

    monkeypatch.setattr(kind, "parquet", fails)
    with pytest.raises(Exception, match="lost"):
        run_pending(spark, source, "k int", sink, mark, work, "k")
    monkeypatch.setattr(kind, "parquet", plain)
    run_pending(spark, source, "k int", sink, mark, work, "k")
    assert sorted(r.k for r in read_batches(spark, sink).collect()) == [1, 2, 3, 4]
    run_pending(spark, source, "k int", sink, str(tmp_path / "other"), lambda rows: rows.select("k"), "k")
    assert sorted(r.k for r in read_batches(spark, sink).collect()) == [1, 2, 3, 4, 7]  # what gave nothing was pending still


def test_keys_are_made_up_for_where_the_failed_batch_never_ran_again(spark, tmp_path, monkeypatch):
    source, sink = str(tmp_path / "in"), str(tmp_path / "out")
    spark.createDataFrame([(k,) for k in (1, 2)], "k int").write.parquet(source)
    monkeypatch.setattr(incremental, "_folders", lambda *a: [])
    kind = type(spark.range(1).write)
    plain = kind.parquet
    monkeypatch.setattr(kind, "parquet", lambda self, path, *a, **b: plain(self, path, *a, **b) if "-keys" not in path else 1 / 0)
    with pytest.raises(Exception, match="division"):
        run_pending(spark, source, "k int", sink, str(tmp_path / "one"), lambda rows: rows, "k")
    monkeypatch.undo()
    run_pending(spark, source, "k int", sink, str(tmp_path / "two"), lambda rows: rows, "k")
    assert sorted(r.k for r in read_batches(spark, sink).collect()) == [1, 2]


def test_a_thousand_pages_in_a_hundred_batches(spark, tmp_path):
    source, sink, mark = (str(tmp_path / n) for n in ("pages", "out", "mark"))
    rows = [("long", n, 1000, f"p{n};", 1, False) for n in range(1, 1001)]
    order = [rows[k::100] for k in range(100)]
    for k, part in enumerate(order):
        spark.createDataFrame([*part, (f"d{k}", 1, 1, "x", 2, False)], SCHEMA).coalesce(1).write.mode("append").parquet(source)
    stream = collect_pages(spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(source))
    write = stream.writeStream.foreachBatch(once(sink, mark)).option("checkpointLocation", mark).trigger(availableNow=True)
    parts = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        write.start().awaitTermination()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", parts)
    out = {r.doc: r for r in read_batches(spark, sink).collect()}
    assert len(out) == 101 and out["long"].markdown == "".join(f"p{n};" for n in range(1, 1001)) and out["long"].total_token_count == 1000
