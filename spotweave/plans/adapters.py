"""Views of the given tables as the entities that the operators work on, each with its SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import rejects, reads, sites, spots
from .problems import table

COV_SQL = """
cov as (select l_suppkey as spot, 'chr' || l_linenumber as contig, l_partkey as pos,
  case when l_linestatus = 'F' then 'CG' when l_returnflag = 'A' then 'CA' when l_returnflag = 'N' then 'CC' else 'CT' end as context,
  cast(sum(cast(l_quantity as bigint)) as bigint) as meth, cast(sum(cast(round_even(l_discount * 100, 0) as bigint)) as bigint) as unmeth
  from lineitem group by all),
covp as (select *, round_even(meth / (meth + unmeth) * 100, 2) as pct from cov where meth + unmeth > 0)"""

ALIGNMENTS_SQL = """
alignments as (select l_suppkey as spot, ([99, 147, 83, 163, 0, 4])[1 + l_linenumber % 6] as flag, cast(l_quantity as int) as mapq,
  case when l_tax > 0.07 then 2 when l_tax > 0.01 then 1 end as hits, 'chr' || l_linenumber as contig, l_orderkey as name from lineitem)"""


def coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sites with methylated and unmethylated counts, from line items."""
    rows = table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("spot"),
        F.concat(F.lit("chr"), F.col("l_linenumber").cast("string")).alias("contig"),
        F.col("l_partkey").alias("pos"),
        F.when(F.col("l_linestatus") == "F", "CG").when(F.col("l_returnflag") == "A", "CA").when(F.col("l_returnflag") == "N", "CC").otherwise("CT").alias("context"),
        F.col("l_quantity").cast("long").alias("m"),
        F.rint(F.col("l_discount") * 100).cast("long").alias("u"),
    )
    return rows.groupBy("spot", "contig", "pos", "context").agg(F.sum("m").alias("meth"), F.sum("u").alias("unmeth"))


def coverage_percent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sites.with_percent(coverage(spark, sf_dir))


def alignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alignment records without bases, from line items."""
    flags = F.array(*map(F.lit, [99, 147, 83, 163, 0, 4]))
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("spot"),
        F.get(flags, F.col("l_linenumber") % 6).alias("flag"),
        F.col("l_quantity").cast("int").alias("mapq"),
        F.when(F.col("l_tax") > 0.07, 2).when(F.col("l_tax") > 0.01, 1).alias("hits"),
        F.concat(F.lit("chr"), F.col("l_linenumber").cast("string")).alias("contig"),
        F.col("l_orderkey").alias("name"),
    )


def fastq(spark: SparkSession, sf_dir: str, *keep: str) -> DataFrame:
    """The FASTQ records that load, with columns of their rows."""
    return rejects.loaded(rejects.parse_rows(table(spark, sf_dir, "fastq_rows"), keep=keep))


def listed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The barcodes of the array."""
    return spots.whitelist(table(spark, sf_dir, "barcode_whitelist"))


def spot_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The partial read counts of spots of the array."""
    rows = table(spark, sf_dir, "spot_counts").select("sample_id", "contig", F.col("barcode").alias("spot"), "reads")
    return spots.on_array(rows, listed(spark, sf_dir), 10)


SPOT_READS_SQL = """
listed as (select upper(trim(barcode)) as barcode, min(idx) as idx from barcode_whitelist where trim(barcode) <> '' group by 1),
spot_reads as (select sample_id, contig, upper(trim(barcode)) as spot, reads from spot_counts
  where length(trim(barcode)) = 20 and upper(trim(barcode))[1:10] in (select barcode from listed) and upper(trim(barcode))[11:20] in (select barcode from listed))"""


def _contig() -> Column:
    """Neighbouring rows are mates, 32 pairs to a contig."""
    return F.concat(F.lit("c"), F.floor(F.col("row_id") / 64).cast("string")).alias("contig")


def placed_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The FASTQ records as aligned reads: neighbouring rows are mates of one pair, which mostly overlap.

    Their place, strand, mapping quality and conversion strand follow from their row, and so do their CIGARs: aligned
    throughout, clipped, with a deletion or with an insertion. Base qualities are their own.
    """
    rows = fastq(spark, sf_dir, "line_no")
    row, n = F.col("row_id"), F.length("seq")
    pair = F.floor(row / 2)
    flags = F.when(pair % 2 == 0, F.when(row % 2 == 0, 99).otherwise(147)).otherwise(F.when(row % 2 == 0, 83).otherwise(163))
    op = lambda o, k: F.struct(F.lit(o).alias("op"), (F.lit(k) if isinstance(k, int) else k).cast("int").alias("len"))
    cigars = [F.array(op("M", n)), F.array(op("S", 3), op("M", n - 3)), F.array(op("M", 10), op("D", 2), op("M", n - 10)), F.array(op("M", 10), op("I", 2), op("M", n - 12))]
    kind = F.when(n >= 20, row % 4).otherwise(0)
    cigar = F.when(kind == 1, cigars[1]).when(kind == 2, cigars[2]).when(kind == 3, cigars[3]).otherwise(cigars[0])
    return rows.select(
        pair.alias("name"), flags.alias("flag"), (row % 17 * 4).cast("int").alias("mapq"), _contig(), (F.col("line_no") % 7).cast("int").alias("start"),
        cigar.alias("cigar"), F.upper("seq").alias("seq"), F.transform(F.split("qual", ""), lambda c: F.ascii(c) - 33).alias("quals"),
        F.when(row % 23 == 0, "u").when(row % 3 == 0, "f").alias("yd"), F.substring(F.upper("seq"), 1, 2).alias("spot"),
    )


def chunk_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A reference per contig of ``placed_reads``: its last read by the alphabet, in pieces of 64 bases with a base beside each."""
    rows = fastq(spark, sf_dir)
    ref = rows.groupBy(_contig()).agg(F.max(F.upper("seq")).alias("s"))
    cut = ref.withColumn("k", F.explode(F.sequence(F.lit(0), F.floor((F.length("s") - 1) / 64)))).withColumn("start", F.col("k") * 64)
    beside = F.struct(
        F.when(F.col("start") > 0, F.substr("s", F.col("start"), F.lit(1))).otherwise("").alias("before"),
        F.substr("s", F.col("start") + 65, F.lit(1)).alias("after"),
    )
    return cut.select("contig", F.col("start").cast("long").alias("start"), F.substr("s", F.col("start") + 1, F.lit(64)).alias("seq"), beside.alias("pad"))


def linker(spark: SparkSession, sf_dir: str) -> str:
    return reads.common_linker(fastq(spark, sf_dir))
