"""Cutoffs that keep a target fraction of each group's records.

Sketch-bracketed exact selection: a sketch of exact counts in logarithmic buckets bounds the wanted quantile
from both sides for certain, the records above that bracket are counted from the sketch, and only the records
within the bracket are sorted to find the cutoff itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..staging import broadcast_if_small, stage

SUB_BITS = 6
BROADCAST_ROWS = 100_000


def latest(df: DataFrame, record_id: str, received: str, *columns: str) -> DataFrame:
    """Of rows with one ``record_id`` the last received; of equal times the greatest values, so that it's defined."""
    best = df.groupBy(record_id).agg(F.max(F.struct(received, *columns)).alias("best"))
    return best.select(record_id, *(F.col(f"best.{c}").alias(c) for c in columns))


def bucket(value: Column) -> Column:
    """A bucket number that never falls as ``value`` (a bigint) grows: exact below 64, then 64 to each doubling."""
    size = F.when(value < 0, -(value + 1)).otherwise(value)
    fine = 1 << SUB_BITS
    power = F.greatest(F.floor(F.log2(size.cast("double"))) - SUB_BITS, F.lit(0)).cast("int")
    place = F.when(size < fine, size).otherwise(
        power.cast("long") * fine + F.floor(size / F.pow(F.lit(2.0), power)).cast("long")
    )
    return F.when(value < 0, -place - 1).otherwise(place)


def cutoffs(records: DataFrame, targets: DataFrame, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Per group ``grp, threshold, n_kept``.

    ``records`` has ``grp`` and ``value`` (bigint), ``targets`` has ``grp`` and ``permille``. The threshold is
    the greatest of the group's values with 1000 x (records at or above it) >= permille x (records); equal
    values stay together, so at least the target is kept. Groups without a target, without records or with
    null values only give no row; of several targets of a group the greatest counts. A target above 1000
    cannot be met and gives no row either; one of 0 or less gives the greatest value.
    """
    kept = stage(records.where("grp is not null and value is not null").select("grp", F.col("value").cast("long")), "cutoff-records")
    aims = targets.where("grp is not null and permille is not null").groupBy("grp").agg(F.max("permille").cast("long").alias("permille"))
    sketch = kept.groupBy("grp", bucket(F.col("value")).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    down = Window.partitionBy("grp").orderBy(F.desc("bucket"))
    whole = Window.partitionBy("grp")
    ranked = sketch.join(aims, "grp").select(
        "grp", "bucket", "permille", "n", F.sum("n").over(down.rowsBetween(Window.unboundedPreceding, 0)).alias("upto"), F.sum("n").over(whole).alias("all")
    )
    reached = F.col("upto") * 1000 >= F.col("permille") * F.col("all")
    brackets = stage(
        ranked.where(reached).groupBy("grp").agg(F.max(F.struct("bucket", (F.col("upto") - F.col("n")).alias("above"), "permille", "all")).alias("b")).select("grp", "b.*"),
        "cutoff-brackets",
    )
    inside = (
        kept.withColumn("bucket", bucket(F.col("value")))
        .join(broadcast_if_small(brackets, broadcast_rows), ["grp", "bucket"])
        .groupBy("grp", "value", "above", "permille", "all")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    order = Window.partitionBy("grp").orderBy(F.desc("value")).rowsBetween(Window.unboundedPreceding, 0)
    found = inside.withColumn("n_kept", F.col("above") + F.sum("n").over(order)).where(F.col("n_kept") * 1000 >= F.col("permille") * F.col("all"))
    best = found.groupBy("grp").agg(F.max(F.struct("value", "n_kept")).alias("b"))
    return best.select("grp", F.col("b.value").alias("threshold"), F.col("b.n_kept").alias("n_kept"))
