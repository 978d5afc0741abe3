from pathlib import Path

from tallyforge.streaming import facts as streaming

from .test_engine import fact, make  # noqa: F401


def run(spark, source, out, check):
    q = streaming.upsert(streaming.read_facts(spark, source), out, check)
    q.awaitTermination(60)
    assert q.exception() is None
    return {(r.ticker, r.line_item): r.value for r in streaming.current(spark, out).collect()}


def files(out, ticker):
    return sorted(str(p) for p in Path(out).glob(f"ticker={ticker}/*/*.parquet"))


def test_late_amendment_replaces_what_it_amends(spark, make, tmp_path):  # noqa: F811
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    make(fact("Revenue", value=1.0)).coalesce(1).write.parquet(source)
    assert run(spark, source, out, str(tmp_path / "check")) == {("T", "Revenue"): 1.0}
    make(fact("Revenue", value=2.0, form="10-Q/A", filed="2024-09-01")).coalesce(1).write.mode("append").parquet(source)
    assert run(spark, source, out, str(tmp_path / "check")) == {("T", "Revenue"): 2.0}


def test_batches_touch_only_their_tickers_and_start_from_what_is_there(spark, make, tmp_path):  # noqa: F811
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    streaming.write_version(make(fact("Cash", value=9.0), fact("Cash", value=7.0, ticker="U")), out, 0)
    kept = files(out, "U")
    make(fact("Revenue", value=1.0)).coalesce(1).write.parquet(source)
    expected = {("T", "Cash"): 9.0, ("T", "Revenue"): 1.0, ("U", "Cash"): 7.0}
    assert run(spark, source, out, str(tmp_path / "a")) == expected
    # another stream over the same source, from its start, is a batch that is run again
    assert run(spark, source, out, str(tmp_path / "b")) == expected
    make(fact("Cash", value=3.0, form="10-K/A", filed="2025-01-01")).coalesce(1).write.mode("append").parquet(source)
    assert run(spark, source, out, str(tmp_path / "a")) | {("T", "Cash"): 3.0} == expected | {("T", "Cash"): 3.0}
    assert files(out, "U") == kept and streaming.vacuum(spark, out) > 0 and len(files(out, "T")) == 1 and files(out, "U") == kept


def test_a_batch_that_is_run_again_gives_the_same_table(spark, make, tmp_path):  # noqa: F811
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    make(fact("Revenue", value=1.0), fact("Cash", value=5.0, ticker="U")).coalesce(1).write.parquet(source)
    once = run(spark, source, out, str(tmp_path / "check"))
    for commit in (tmp_path / "check" / "commits").iterdir():  # as if the batch had been written but not committed
        commit.unlink()
    assert run(spark, source, out, str(tmp_path / "check")) == once == {("T", "Revenue"): 1.0, ("U", "Cash"): 5.0}
    assert len(files(out, "T")) == 1


def test_windows_over_a_stream(spark, data, tmp_path):
    schema = spark.read.parquet(f"{data}/events.parquet").schema
    spark.read.parquet(f"{data}/events.parquet").write.parquet(str(tmp_path / "e"))
    stream = streaming.windowed(spark.readStream.schema(schema).parquet(str(tmp_path / "e")), "1 day")
    q = stream.writeStream.format("memory").queryName("days").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination(60)
    assert spark.table("days").selectExpr("sum(n)").first()[0] == spark.read.parquet(f"{data}/events.parquet").count()
    assert streaming.sessions(spark.read.parquet(f"{data}/events.parquet")).count() > 0
