"""Readers of the text and JSON files of a workflow folder, as declared schemas: nothing is inferred."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numbers import as_float, as_int, first_json
from ..functions.text import spot_key, trimmed

CG_FIELDS = "contig string, pos bigint, end bigint, pct double, meth bigint, unmeth bigint"
CH_FIELDS = CG_FIELDS + ", context string, strand string"


def coverage(spark: SparkSession, *paths: str, context: str = "CG") -> DataFrame:
    """Sites of headerless coverage files with ``spot`` and ``context``; lines that are too short or hold no counts are left out.

    The spot is the file's name before its first point. CH files carry their context and strand; a file of one CH
    context is also read so, and ``context`` then picks from a file of all of them.
    """
    fields = CG_FIELDS if context == "CG" else CH_FIELDS
    rows = spark.read.schema(fields).csv(list(paths), sep="\t", recursiveFileLookup=True, mode="DROPMALFORMED", pathGlobFilter="*.cov*")
    rows = rows.select("*", F.substring_index("_metadata.file_name", ".", 1).alias("spot")).where("meth is not null and unmeth is not null")
    if context == "CG":
        return rows.select("spot", "contig", "pos", F.lit("CG").alias("context"), F.lit(None).cast("string").alias("strand"), "meth", "unmeth", "pct")
    kept = rows if context == "CH" else rows.where(F.col("context") == context)
    return kept.select("spot", "contig", "pos", "context", "strand", "meth", "unmeth", "pct")


def whitelist(spark: SparkSession, path: str, upper: bool = True) -> DataFrame:
    """``barcode, idx``: the first column of a list without blank and ``#`` lines, in the order of its lines."""
    lines = _numbered_lines(spark, path)
    word = F.split(trimmed("value"), "[\t, ]")[0]
    rows = lines.where((trimmed("value") != "") & ~F.startswith(trimmed("value"), F.lit("#"))).select((F.upper(word) if upper else word).alias("barcode"), "row")
    listed = rows.groupBy("barcode").agg(F.min("row").alias("row"))
    order = listed.agg(F.sort_array(F.collect_list(F.struct("row", "barcode"))).alias("all"))  # a list of an array's barcodes
    return order.select(F.posexplode("all").alias("idx", "b")).select("b.barcode", "idx")


def _numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """``value, row``: the lines of one small file with their numbers."""
    return spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", "\r\n|\n|\r")).alias("row", "value"))


def fasta_index(spark: SparkSession, path: str) -> DataFrame:
    """``contig, length, ord`` of an index's lines; one with fewer than two fields, or none at all, is an error."""
    lines = _numbered_lines(spark, path).where(trimmed("value") != "")
    f = F.split("value", "\t")
    length = F.get(f, F.lit(1)).try_cast("long")
    checked = F.when(length.isNotNull(), length).otherwise(F.raise_error(F.concat(F.lit("no contig and length: "), "value")).cast("long"))
    found = lines.select(f[0].alias("contig"), checked.alias("length"), F.col("row").alias("ord"))
    if found.isEmpty():
        raise ValueError(f"{path} lists no contig")
    return found


def with_header(spark: SparkSession, path: str, required: list[str], sep: str = "\t") -> DataFrame:
    """A text table with a header, all strings; missing required columns are an error."""
    df = spark.read.csv(path, sep=sep, header=True, inferSchema=False)
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"{path} lacks {', '.join(missing)}")
    return df


def read_counts(spark: SparkSession, path: str) -> DataFrame:
    """``spot, reads`` of a counts file; lines without a whole number are left out."""
    df = with_header(spark, path, ["barcode", "reads"])
    return df.select(spot_key("barcode").alias("spot"), as_int(F.col("reads")).alias("reads")).where("reads is not null")


def roster(spark: SparkSession, path: str) -> DataFrame:
    """``spot`` of a roster: a counts file or one barcode to a line."""
    first = F.split(trimmed("value"), "\t")[0]
    return spark.read.text(path).select(spot_key(first).alias("spot")).where("spot <> '' and spot <> 'BARCODE'").distinct()


def meth_stats(spark: SparkSession, path: str) -> DataFrame:
    """Per-spot methylation statistics, ``NA`` as null."""
    df = with_header(spark, path, ["barcode"])
    number = lambda c: F.col(f"`{c}`").try_cast("long" if c.endswith("_count") else "double").alias(c)
    return df.select(spot_key("barcode").alias("spot"), *(number(c) for c in df.columns if c != "barcode"))


def positions(spark: SparkSession, path: str) -> DataFrame:
    """``line_no, barcode, array_row, array_col`` of a positions file, as ``spots.positions`` takes them."""
    lines = _numbered_lines(spark, path)
    f = F.split("value", "\t")
    cell = lambda k: trimmed(F.get(f, F.lit(k))).try_cast("int")
    return lines.where("row > 0").select(F.col("row").alias("line_no"), f[0].alias("barcode"), cell(1).alias("array_row"), cell(2).alias("array_col"))


def _documents(spark: SparkSession, path: str, names: str = "*.json") -> DataFrame:
    return spark.read.text(path, wholetext=True, pathGlobFilter=names, recursiveFileLookup=True).select(F.col("_metadata.file_path").alias("path"), "value")


def trimming_reports(spark: SparkSession, path: str, names: str = "*.json") -> DataFrame:
    """``path, reads_before, reads_after, bases_before, bases_after`` of trimming reports; what isn't there is null."""
    at = lambda when, what: as_int(first_json(F.col("value"), f"$.summary.{when}_filtering.{what}")).alias(f"{what[6:]}_{when}")
    return _documents(spark, path, names).select("path", *(at(w, t) for t in ("total_reads", "total_bases") for w in ("before", "after")))


def demux_reports(spark: SparkSession, path: str) -> DataFrame:
    """``path, total_reads, kept_reads, reject_counts`` of demultiplexing reports; one that is no JSON has nulls."""
    schema = "total_reads bigint, kept_reads bigint, reject_counts map<string, bigint>"
    return _documents(spark, path).select("path", F.from_json("value", schema).alias("j")).select("path", "j.*")


def barcoded_reads(reports: DataFrame) -> DataFrame:
    """``barcoded_reads``: twice the kept pairs of all reports, null if none could be read."""
    return reports.agg((F.sum("kept_reads") * 2).alias("barcoded_reads"))


def funnels(spark: SparkSession, path: str) -> DataFrame:
    """``path`` and the counters and mitochondrial contigs of funnel files."""
    names = ["host_mapped_reads", "host_valid_reads", "host_valid_reads_mito", "host_valid_reads_nuclear"]
    schema = ", ".join(f"{n} bigint" for n in names) + ", mito_chromosomes array<string>"
    return _documents(spark, path).select("path", F.from_json("value", schema).alias("j")).select("path", "j.*")


def discovered_spots(spark: SparkSession, path: str, listed: DataFrame) -> DataFrame:
    """``spot``: the names of coverage files that are in the list, in order."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.cov*").load(path)
    stems = sorted({name.rsplit("/", 1)[-1].split(".", 1)[0] for name in files.inputFiles()})  # an array's files, empty ones too
    names = spark.createDataFrame([(s,) for s in stems], "spot string")
    return names.join(listed.select(F.col("barcode").alias("spot")), "spot", "left_semi").orderBy("spot")


def spike_names(names: list[str]) -> list[str]:
    """The spikes among the names of files: ``pooled.<spike>.sorted.bam`` but the host's and the one by spot, and
    ``<spike>.CG.cov`` but the host's."""
    found = {n[7:-11] for n in names if n.startswith("pooled.") and n.endswith(".sorted.bam")} - {"host", "byCB"}
    found |= {n[:-7] for n in names if n.endswith(".CG.cov") and not n.startswith("host")}
    return sorted(n for n in found if n)


def discovered_spikes(spark: SparkSession, path: str) -> list[str]:
    """``spike_names`` of the files under a folder, on any file system."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).inputFiles()
    return spike_names([f.rsplit("/", 1)[-1] for f in files])


def spike_reports(spark: SparkSession, path: str) -> DataFrame:
    """``path, name, reads_matched, mean_rate`` of the spikes' reports; one that is no JSON, or has no name, gives no row."""
    at = lambda f: F.get_json_object("value", f"$.{f}")
    rows = _documents(spark, path).select("path", trimmed(at("name")).alias("name"), as_int(at("reads_matched")).alias("reads_matched"), as_float(at("mean_conversion_rate")).alias("mean_rate"))
    return rows.where("name <> ''")


def sample_value(df: DataFrame, sample: str, column: str, key: str = "sample_id") -> str | None:
    """A sample's value in a report that is read as text: that of its first line, None for no line or a blank value."""
    found = df.where(trimmed(key) == sample).select(trimmed(column).alias("v")).first()
    return found["v"] or None if found else None
