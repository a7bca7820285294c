"""Windows over a stream give what they give over the batch."""

from tempora.streaming import windows


def test_stream_equals_batch(spark, tmp_path):
    events = spark.sql("select 'u' || (id % 3) as user, timestamp_seconds(id * 600) as ts from range(100)")
    events.write.parquet(str(tmp_path / "in"))
    stream = windows.tumbling(spark.readStream.schema(events.schema).parquet(str(tmp_path / "in")), "ts", "1 hour", "user", late="1 hour")
    query = stream.writeStream.outputMode("complete").format("memory").queryName("windows").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "c")).start()
    query.awaitTermination(120)
    key = lambda r: (r["user"], r["since"], r["n"])
    assert sorted(map(key, spark.table("windows").collect())) == sorted(map(key, windows.tumbling(events, "ts", "1 hour", "user").collect()))


def test_new_files_are_handled_once(spark, tmp_path):
    (tmp_path / "in").mkdir()
    seen = []
    for n in range(2):
        (tmp_path / f"in/{n}.json").write_text('{"x": %d}\n' % n)
        windows.watch_snapshots(spark, str(tmp_path / "in"), "x long", str(tmp_path / "c"), lambda df, _: seen.extend(r["x"] for r in df.collect())).awaitTermination(120)
    assert seen == [0, 1]
