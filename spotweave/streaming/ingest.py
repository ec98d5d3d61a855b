"""Loading as files arrive, with Structured Streaming. The batch operators do the work; state is bounded by a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.text import spot_key
from ..operators import rejects


def load_fastq(stream: DataFrame, loaded: str, rejected: str, checkpoint: str, **trigger: object) -> StreamingQuery:
    """Appends the rows of ``stream`` that load to one Parquet folder and the others, with their reason, to another.

    A batch that is run again after a failure is written again to the same folder of its number, so nothing is doubled.
    """

    def write(batch: DataFrame, number: int) -> None:
        parsed = rejects.parse_rows(batch).persist()
        rejects.loaded(parsed).write.mode("overwrite").parquet(f"{loaded}/batch={number}")
        rejects.rejected(parsed).write.mode("overwrite").parquet(f"{rejected}/batch={number}")
        parsed.unpersist()

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def spot_totals(stream: DataFrame, delay: str = "7 days", window: str = "1 day") -> DataFrame:
    """Per window of ``counted_at`` and spot the records and reads, each ``count_id`` once within the delay.

    Records later than ``delay`` are left out (``load_totals`` counts them too); a window comes out when the watermark has passed it (append mode).
    """
    once = stream.withColumn("at", F.col("counted_at").cast("timestamp")).withWatermark("at", delay).dropDuplicatesWithinWatermark(["count_id"])
    keyed = once.withColumn("spot", spot_key("barcode")).groupBy(F.window("at", window), "spot")
    return keyed.agg(F.count(F.lit(1)).alias("n_records"), F.sum("reads").alias("reads")).select(F.col("window.start").alias("day"), "spot", "n_records", "reads")


def load_totals(stream: DataFrame, totals: str, ids: str, checkpoint: str, window: str = "1 day", **trigger: object) -> StreamingQuery:
    """Appends to ``totals`` what each batch adds to the records and reads of a window of ``counted_at`` and spot, however late
    its records come, and to ``ids`` the ``count_id`` it counted; ``merged_totals`` gives the totals so far.

    A ``count_id`` counts once over all batches, as it came first; in one batch that is by ``received_at``, if there is
    one, then by the least values. Records without a ``count_id`` all count, those without a time under a null day. A
    batch that is run again after a failure is written again to the folders of its number, so nothing is doubled.
    """

    def write(batch: DataFrame, number: int) -> None:
        values = ["counted_at", "barcode", "reads"]
        order = F.struct(*(c for c in ["received_at", *values] if c in batch.columns))
        known = batch.where("count_id is not null").groupBy("count_id").agg(F.min_by(F.struct(*values), order).alias("r")).select("count_id", "r.*")
        if number:
            schema = f"count_id {batch.schema['count_id'].dataType.simpleString()}, batch bigint"
            before = batch.sparkSession.read.schema(schema).parquet(ids).where(F.col("batch") < number)
            known = known.join(before.select("count_id"), "count_id", "left_anti")
        rows = known.select(*values).unionByName(batch.where("count_id is null").select(*values))
        rows = rows.select(F.col("counted_at").cast("timestamp").alias("at"), spot_key("barcode").alias("spot"), "reads")
        timed = rows.where("at is not null").withColumn("w", F.window("at", window)).select(F.col("w.start").alias("day"), "spot", "reads")
        placed = timed.unionByName(rows.where("at is null").select(F.col("at").alias("day"), "spot", "reads"))
        added = placed.groupBy("day", "spot").agg(F.count(F.lit(1)).alias("n_records"), F.sum("reads").alias("reads"))
        added.write.mode("overwrite").parquet(f"{totals}/batch={number}")
        known.select("count_id").write.mode("overwrite").parquet(f"{ids}/batch={number}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def merged_totals(totals: DataFrame) -> DataFrame:
    """``day, spot, n_records, reads`` of all that ``load_totals`` appended."""
    return totals.groupBy("day", "spot").agg(F.sum("n_records").alias("n_records"), F.sum("reads").alias("reads"))
