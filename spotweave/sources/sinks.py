"""Writers of the workflow's file formats, all through Spark's commit protocol."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import formatted
from ..staging import stage

_TAB = "\t"


def _cells(df: DataFrame, formats: dict[str, str], missing: str) -> list[Column]:
    out = []
    for c in df.columns:
        col = F.col(f"`{c}`")
        out.append((formatted(formats[c], missing)(col) if c in formats else F.coalesce(col.cast("string"), F.lit(missing))).alias(c))
    return out


def write_tsv(df: DataFrame, path: str, formats: dict[str, str] | None = None, missing: str = "NA") -> None:
    """The rows in the order of ``df``, every file with the header: nulls as ``NA``, numbers by Python's patterns, lines
    ended by CR LF. A report that should be one file is coalesced by the caller; an empty one is a header."""
    text = df.select(*_cells(df, formats or {}, missing))
    head = _TAB.join(text.columns)
    lines = text.select(F.concat_ws(_TAB, *(F.col(f"`{c}`") for c in text.columns)).alias("value"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = True
        for batch in batches:
            if first and batch.num_rows:
                yield pa.RecordBatch.from_arrays([pa.array([head], batch.schema.field(0).type)], schema=batch.schema)
                first = False
            yield batch

    found = _headed([head], lines) if df.isEmpty() else lines.mapInArrow(run, "value string")
    found.write.mode("overwrite").text(path, lineSep="\r\n")


def _headed(head: list[str], lines: DataFrame) -> DataFrame:
    """The lines with a header as a partition of its own before theirs."""
    first = lines.sparkSession.range(0, 1, 1, 1).select(F.explode(F.array(*map(F.lit, head))).alias("value"))
    return first.union(lines)


def write_coverage(cov: DataFrame, path: str) -> None:
    """Coverage files by spot, in folders ``prefix=../spot=..``: sites in order, each spot within one task."""
    rows = _coverage_lines(cov)
    rows.repartition("spot").sortWithinPartitions("spot", "contig", "pos").write.mode("overwrite").partitionBy("prefix", "spot").csv(path, sep=_TAB)


def _coverage_lines(cov: DataFrame) -> DataFrame:
    cols = ["contig", "pos", F.col("pos").alias("end"), F.format_string("%.2f", "pct").alias("pct"), "meth", "unmeth"]
    extra = [c for c in ("context", "strand") if c in cov.columns]
    return cov.select(*cols, *extra, F.col("spot").cast("string").alias("spot"), F.substring("spot", 1, 3).alias("prefix"))


def write_spot_files(cov: DataFrame, path: str, context: str, roster: DataFrame | None = None) -> None:
    """One file per spot of an array, ``<first three letters>/<spot>.<context>.cov``, as ``tables.coverage`` reads them.

    Spots of ``roster`` (``spot``) without rows get an empty file. The files are written aside, then moved into place one
    by one; those that are there already are replaced.
    """
    spark = cov.sparkSession
    aside = f"{path}/_{context}"
    write_coverage(cov, aside)
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path
    fs = at(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def target(spot: str):
        fs.mkdirs(at(f"{path}/{spot[:3]}"))
        place = at(f"{path}/{spot[:3]}/{spot}.{context}.cov")
        fs.delete(place, False)
        return place

    done = set()
    for file in fs.globStatus(at(f"{aside}/prefix=*/spot=*/part-*")) or []:
        spot = file.getPath().getParent().getName()[5:]
        fs.rename(file.getPath(), target(spot))
        done.add(spot)
    if roster is not None:
        for row in roster.select(F.col("spot").cast("string").alias("spot")).where("spot is not null").distinct().toLocalIterator():  # an array's spots
            if row.spot not in done:
                fs.create(target(row.spot), True).close()
    fs.delete(at(aside), True)


def write_aggregate(cov: DataFrame, path: str, contigs: DataFrame | None = None) -> None:
    """All spots' sites as range-partitioned files that follow each other: in the order of contig, place and spot, or, with
    ``contigs`` (``contig, ord``), the spot first and its sites in the order of their contigs."""
    cols = ["contig", "pos", F.col("pos").alias("end"), F.format_string("%.2f", "pct").alias("pct"), "meth", "unmeth", "spot"]
    if contigs is None:
        cov.select(*cols).orderBy("contig", "pos", "spot").write.mode("overwrite").csv(path, sep=_TAB)
        return
    rows = cov.join(contigs.groupBy("contig").agg(F.min("ord").alias("_ord")), "contig", "left").orderBy("spot", F.asc_nulls_last("_ord"), "contig", "pos")
    rows.select("spot", *cols[:3], "meth", "unmeth").write.mode("overwrite").csv(path, sep=_TAB)


def matrix_entries(matrix: DataFrame, bins: DataFrame, spots: DataFrame, width: int) -> DataFrame:
    """``row, col, meth, cov, frac``: a matrix of one context with the 1-based numbers of its bins and of its spots (sorted)."""
    order = spots.select("spot").distinct().agg(F.sort_array(F.collect_list("spot")).alias("all"))  # an array's spots
    cols = order.select(F.posexplode("all").alias("k", "spot")).select((F.col("k") + 1).alias("col"), "spot")
    rows = bins.select("contig", F.floor(F.col("start") / width).alias("bin"), (F.col("bin_id") + 1).alias("row"))
    return matrix.join(rows, ["contig", "bin"]).join(cols, "spot").select("row", "col", "meth", "cov", "frac")


def write_matrix(matrix: DataFrame, bins: DataFrame, spots: DataFrame, width: int, path: str) -> None:
    """``features``, ``barcodes`` and ``matrix`` folders of gzip text files that follow each other, sorted over all tasks.

    The matrix begins with its MatrixMarket header; gzip files appended to each other are one gzip file.
    """
    entries = stage(matrix_entries(matrix, bins, spots, width), "matrix")
    n_rows, n_cols, n = bins.count(), spots.select("spot").distinct().count(), entries.count()
    head = ["%%MatrixMarket matrix coordinate real general", f"{n_rows} {n_cols} {n}"]
    body = entries.orderBy("col", "row").select(F.concat_ws(" ", "row", "col", "meth", "cov", formatted(".6g")(F.col("frac"))).alias("value"))
    _zipped(_headed(head, body), f"{path}/matrix")
    feature = F.concat(F.col("contig"), F.lit(":"), F.col("start"), F.lit("-"), F.col("end"))
    _zipped(bins.orderBy("bin_id").select(F.concat_ws(_TAB, feature, "contig", "start", "end").alias("value")), f"{path}/features")
    _zipped(spots.select("spot").distinct().orderBy("spot").select(F.col("spot").cast("string").alias("value")), f"{path}/barcodes")


def _zipped(lines: DataFrame, path: str) -> None:
    lines.write.mode("overwrite").option("compression", "gzip").text(path)


def write_demultiplexed(demuxed: DataFrame, path: str) -> None:
    """FASTQ text in folders ``route=demux`` and ``route=spike``, gzip compressed: kept reads and all others.

    With second mates (``r2``) these lie in ``mate=R1`` and ``mate=R2``; a task writes both mates in the same order.
    """
    route = F.when(F.col("reason") == "kept", "demux").otherwise("spike").alias("route")
    record = F.concat_ws("\n", "name", "seq", F.lit("+"), "qual").alias("value")
    if "r2" not in demuxed.columns:
        demuxed.select(record, route).write.mode("overwrite").option("compression", "gzip").partitionBy("route").text(path)
        return
    second = F.concat_ws("\n", "r2.name", "r2.seq", F.col("r2.plus"), "r2.qual")
    both = F.array(F.struct(F.lit("R1").alias("mate"), record), F.struct(F.lit("R2").alias("mate"), second.alias("value")))
    pairs = demuxed.select(route, F.monotonically_increasing_id().alias("k"), both.alias("both")).select("route", "k", F.inline("both"))
    lines = pairs.sortWithinPartitions("mate", "route", "k").select("value", "mate", "route")
    lines.write.mode("overwrite").option("compression", "gzip").partitionBy("mate", "route").text(path)
