from spotweave.streaming import ingest


def test_fastq_is_loaded_batch_by_batch(spark, tmp_path, rows):
    schema = "row_id bigint, raw_line string"
    for k, line in enumerate(["@a,AC,+,II", "bad", "@b,AC,+,II"]):
        spark.createDataFrame([(k, line)], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    good, bad = str(tmp_path / "good"), str(tmp_path / "bad")
    for _ in range(2):  # a second run finds nothing new
        ingest.load_fastq(stream, good, bad, str(tmp_path / "cp")).awaitTermination(120)
    assert rows(spark.read.parquet(good), "row_id", "name") == [(0, "@a"), (2, "@b")]
    assert rows(spark.read.parquet(bad), "row_id", "reason") == [(1, "columns")]


def test_totals_count_each_record_once(spark, tmp_path, rows):
    schema = "count_id bigint, counted_at timestamp, barcode string, reads bigint"
    first = [(1, "2025-01-01 01:00:00", " ac", 5), (1, "2025-01-01 01:00:00", "AC", 5), (2, "2025-01-01 02:00:00", "AC", 7), (3, "2025-01-01 03:00:00", None, 1)]
    later = [(9, "2025-03-01 00:00:00", "AC", 1)]
    for data in (first, later):
        df = spark.createDataFrame(data, "count_id bigint, counted_at string, barcode string, reads bigint")
        df.withColumn("counted_at", df.counted_at.cast("timestamp")).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    query = ingest.spot_totals(stream).writeStream.format("memory").queryName("totals").outputMode("append").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    query.awaitTermination(120)
    assert rows(spark.table("totals"), "spot", "n_records", "reads") == sorted([("AC", 2, 12), (None, 1, 1)], key=repr)


def test_late_records_correct_the_totals(spark, tmp_path, rows):
    schema = "count_id bigint, counted_at timestamp, barcode string, reads bigint"
    batches = [
        [(1, "2025-01-01 01:00:00", " ac", 5), (1, "2025-01-01 01:00:00", "AC", 5), (None, "2025-01-01 01:00:00", "AC", 2)],
        [(9, "2025-03-01 00:00:00", "AC", 1)],
        [(2, "2025-01-01 02:00:00", "AC", 7), (1, "2025-01-01 01:00:00", "AC", 50), (3, None, "AC", 4)],  # weeks late, and one sent again
    ]
    for k, data in enumerate(batches):
        df = spark.createDataFrame(data, "count_id bigint, counted_at string, barcode string, reads bigint")
        df.withColumn("counted_at", df.counted_at.cast("timestamp")).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        for _ in range(2):  # a second run finds nothing new
            ingest.load_totals(stream, str(tmp_path / "totals"), str(tmp_path / "ids"), str(tmp_path / "cp")).awaitTermination(120)
    found = ingest.merged_totals(spark.read.parquet(str(tmp_path / "totals")))
    days = found.selectExpr("cast(cast(day as date) as string) as day", "spot", "n_records", "reads")
    assert rows(days) == sorted([("2025-01-01", "AC", 3, 14), ("2025-03-01", "AC", 1, 1), (None, "AC", 1, 4)], key=repr)
