"""Per-key processing that stays balanced when a few keys hold most records.

Exact offset chunking: the records of each key are counted per input partition, prefix sums over the
partitions give each partition's offset within the key, each record gets its number within its key, and
chunks of an equal number of records are processed on their own; the ordered states at the chunks'
boundaries are then merged per key. No task ever holds more of one key than one input partition or one
chunk, whatever the share of the key; the size of a chunk follows from the counts and the tasks there are.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..staging import broadcast_if_small, stage

#: Chunks to a task if all keys were one, and the bounds of a chunk's records.
CHUNKS_PER_TASK, LEAST_CHUNK, MOST_CHUNK = 4, 1_000, 1 << 20
#: There is an offset for each key and file; beyond this many they are joined by shuffle, by key and file.
BROADCAST_OFFSETS = 200_000


@dataclass(frozen=True)
class Numbered:
    """Records with ``_key``, their number ``_n`` from 0 within it, and the columns kept; ``total`` counts them all."""

    rows: DataFrame
    total: int

    def chunked(self, chunk_rows: int | None = None) -> DataFrame:
        """``rows`` with ``_chunk``, of ``chunk_rows`` records each, or as many as the counts suggest."""
        n = chunk_rows or chunk_size(self.rows.sparkSession, self.total)
        return self.rows.withColumn("_chunk", F.floor(F.col("_n") / n))


def chunk_size(spark: SparkSession, total: int) -> int:
    """Records to a chunk, so that even a key with all of ``total`` keeps every task busy several times."""
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return min(max(math.ceil(total / (tasks * CHUNKS_PER_TASK)), LEAST_CHUNK), MOST_CHUNK)


def _by_place(staged: DataFrame) -> Numbered:
    """Numbers of rows that lie in their files sorted by key: the place in the file gives the number, without a shuffle of rows.

    Records of a key are counted per file, and prefix sums over the files give the offset of each.
    """
    m = F.col("_metadata")
    rows = staged.select("*", m["file_name"].alias("_file"), m["row_index"].alias("_row"))
    counts = rows.groupBy("_key", "_file").agg(F.count(F.lit(1)).alias("_count"), F.min("_row").alias("_first"))
    before = Window.partitionBy("_key").orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("_count").over(before), F.lit(0)) - F.col("_first")
    offsets = stage(counts.select(F.col("_key").alias("_k"), F.col("_file").alias("_f"), shift.alias("_shift"), "_count"), "chunk-offsets")
    total = offsets.agg(F.coalesce(F.sum("_count"), F.lit(0))).first()[0]
    joined = rows.join(broadcast_if_small(offsets.drop("_count"), BROADCAST_OFFSETS), F.col("_key").eqNullSafe(F.col("_k")) & (F.col("_file") == F.col("_f")))
    return Numbered(joined.withColumn("_n", F.col("_row") + F.col("_shift")).drop("_k", "_f", "_shift", "_file", "_row"), total)


def numbered(df: DataFrame, key: Column, keep: dict[str, Column]) -> Numbered:
    """``_key, _n`` and the columns of ``keep``: each record's number, from 0, within its key, in some order.

    Each input partition is read once, sorted by key on the spot and written to the shared folder, where no retried
    task can change a record's place any more. Null keys form a key of their own.
    """
    picked = df.select(key.alias("_key"), *(c.alias(k) for k, c in keep.items()))
    return _by_place(stage(picked.sortWithinPartitions("_key"), "chunk-rows"))


def numbered_in_order(df: DataFrame, key: Column, order: dict[str, Column], keep: dict[str, Column]) -> Numbered:
    """As ``numbered``, but in the order of ``order`` within each key; its columns are kept too.

    The records are range partitioned by key and order together, so that a hot key spreads over many
    partitions, and sorted there.
    """
    named = {**order, **keep}
    picked = df.select(key.alias("_key"), *(c.alias(k) for k, c in named.items()))
    by = ["_key", *order]
    return _by_place(stage(picked.repartitionByRange(*by).sortWithinPartitions(*by), "chunk-order"))


def running_total(rows: DataFrame, value: str, name: str, chunk_rows: int = MOST_CHUNK) -> DataFrame:
    """``rows`` of ``Numbered`` with ``name``: the sum of ``value`` over the key's records up to this one.

    Chunks are summed on their own; the totals of a key's chunks before give each its offset.
    """
    cut = rows.withColumn("_chunk", F.floor(F.col("_n") / chunk_rows))
    earlier = Window.partitionBy("_key").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    sums = cut.groupBy("_key", "_chunk").agg(F.sum(value).alias("_sum"))
    offsets = sums.select(F.col("_key").alias("_k"), F.col("_chunk").alias("_c"), F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy("_key", "_chunk").orderBy("_n").rowsBetween(Window.unboundedPreceding, 0)
    joined = cut.withColumn("_local", F.sum(value).over(inside)).join(offsets, F.col("_key").eqNullSafe(F.col("_k")) & (F.col("_chunk") == F.col("_c")))
    return joined.withColumn(name, F.col("_local") + F.col("_offset")).drop("_chunk", "_k", "_c", "_local", "_offset")


def _merged_totals(states: DataFrame) -> DataFrame:
    """The states of each key's chunks, in their order, folded into one."""
    nothing = lambda c: F.lit(None).cast(states.schema[c].dataType)
    zero = F.struct(
        F.lit(0).cast("long").alias("rows"), F.lit(0).cast("long").alias("values"), nothing("sum").alias("sum"), nothing("lo").alias("lo"), nothing("hi").alias("hi")
    )
    step = lambda a, s: F.struct(
        (a["rows"] + s["rows"]).alias("rows"), (a["values"] + s["values"]).alias("values"),
        F.coalesce(a["sum"] + s["sum"], a["sum"], s["sum"]).alias("sum"), F.least(a["lo"], s["lo"]).alias("lo"), F.greatest(a["hi"], s["hi"]).alias("hi"),
    )
    chunks = F.array_sort(F.collect_list(F.struct("_chunk", "rows", "values", "sum", "lo", "hi")))  # a state to a chunk
    return states.groupBy(F.col("_key").alias("key")).agg(F.aggregate(chunks, zero, step).alias("t")).select(
        "key", F.col("t.rows").alias("n_rows"), F.col("t.values").alias("n_values"), F.col("t.sum").alias("total"), F.col("t.lo").alias("least"), F.col("t.hi").alias("greatest")
    )


def _totals(df: DataFrame, key: Column, value: Column, chunk_rows: int | None) -> tuple[DataFrame, int]:
    records = numbered(df, key, {"v": value})
    states = (
        records.chunked(chunk_rows)
        .groupBy("_key", "_chunk")
        .agg(F.count(F.lit(1)).alias("rows"), F.count("v").alias("values"), F.sum("v").alias("sum"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    )
    return _merged_totals(states), records.total


def key_totals(df: DataFrame, key: Column, value: Column, chunk_rows: int | None = None) -> DataFrame:
    """Per key: ``key, n_rows, n_values, total, least, greatest``, exact for any skew.

    Null keys give one row with a null key; null values count in ``n_rows`` only, and a key with none but
    null values has a null total. Repeated records count each time. An empty table gives no rows. No other
    column of ``df`` is read.
    """
    return _totals(df, key, value, chunk_rows)[0]


def key_runs(df: DataFrame, key: Column, at: Column, tie: Column, label: Column, chunk_rows: int | None = None) -> DataFrame:
    """Per key, in the order of ``at`` (a number) and ``tie``: ``key, n_rows, n_runs, longest_gap``.

    ``n_runs`` is the number of maximal runs of equal ``label`` (nulls equal), ``longest_gap`` the greatest
    difference in ``at`` between neighbours (null for one record). Chunks yield their own runs and gaps with their first and
    last record; neighbours across a boundary are compared when the chunks are merged. Null ``at`` sort first
    and have no gap. Rows equal in key, ``at`` and ``tie`` are taken in any order, so ``tie`` should be unique.
    """
    rows = numbered_in_order(df, key, {"at": at, "tie": tie}, {"label": label}).chunked(chunk_rows)
    w = Window.partitionBy("_key", "_chunk").orderBy("_n")
    step = rows.select(
        "_key", "_chunk", "_n", "at", "label",
        F.when(F.row_number().over(w) == 1, F.lit(0)).otherwise((~F.col("label").eqNullSafe(F.lag("label").over(w))).cast("int")).alias("new"),
        (F.col("at") - F.lag("at").over(w)).alias("gap"),
    )
    edge = F.struct("_n", "at", "label")
    states = step.groupBy("_key", "_chunk").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("new").alias("new"), F.max("gap").alias("gap"),
        F.min(edge).alias("head"), F.max(edge).alias("tail"),
    )
    c = Window.partitionBy("_key").orderBy("_chunk")
    last = F.lag("tail").over(c)
    merged = states.select(
        "_key", "rows", "new", "gap",
        F.when(F.row_number().over(c) == 1, F.lit(1)).otherwise((~F.col("head.label").eqNullSafe(last["label"])).cast("int")).alias("joint"),
        (F.col("head.at") - last["at"]).alias("joint_gap"),
    )
    return merged.groupBy(F.col("_key").alias("key")).agg(
        F.sum("rows").alias("n_rows"),
        F.sum(F.col("new") + F.col("joint")).alias("n_runs"),
        F.max(F.greatest("gap", "joint_gap")).alias("longest_gap"),
    )


def hot_keys(df: DataFrame, key: Column, value: Column, one_in: int, chunk_rows: int | None = None) -> DataFrame:
    """The keys that each hold more than one ``one_in``-th of all rows of ``df``, null keys never: ``key_totals``' columns."""
    totals, rows = _totals(df, key, value, chunk_rows)
    return totals.where(F.col("key").isNotNull() & (F.col("n_rows") * one_in > rows))
