from tessera.streaming import events as ev


def run(stream, name, spark):
    q = stream.writeStream.outputMode("complete").format("memory").queryName(name).trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.table(name)


def test_windows_equal_batch(spark, small_data, tmp_path):
    spark.read.parquet(f"{small_data}/events.parquet").repartition(3).write.parquet(str(tmp_path / "in"))
    got = run(ev.tumbling(ev.read(spark, str(tmp_path / "in"), 5)), "tumbling", spark)
    batch = spark.read.parquet(str(tmp_path / "in")).selectExpr("date_trunc('hour', cast(ts as timestamp)) as w", "event_type").groupBy("w", "event_type").count()
    assert got.count() == batch.count() and got.selectExpr("sum(events)").first()[0] == 1000


def test_idempotent_sink(spark, small_data, tmp_path):
    spark.read.parquet(f"{small_data}/events.parquet").write.parquet(str(tmp_path / "in"))
    for run_ in ("one", "two"):
        ev.write_idempotent(ev.read(spark, str(tmp_path / "in")), str(tmp_path / "out"), "event_type", str(tmp_path / run_)).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1000


def test_sessions(spark, small_data):
    s = ev.sessions(spark.read.parquet(f"{small_data}/events.parquet").withColumn("ts", __import__("pyspark.sql.functions", fromlist=["col"]).col("ts").cast("timestamp")))
    assert s.selectExpr("sum(events)").first()[0] == 1000
