"""Queries that write through the sinks and read back through the sources, and the SQL that checks what came back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import name_spot
from ..operators import reads, sites, skew, spots
from ..sources import sequencing, sinks, tables
from ..staging import new_path
from . import adapters
from .adapters import COV_SQL
from .assay import _COUNTS, _DEMUX, _GOOD, _REF
from .problems import table

QUERIES: dict = {}
SQL: dict[str, str] = {}
_WIDTH = 500


def query(sql: str):
    def add(f):
        QUERIES[f.__name__], SQL[f.__name__] = f, sql
        return f

    return add


@query("with " + COV_SQL + """ select cast(spot as varchar) as spot, contig, pos, context, case when context <> 'CG' then '+' end as strand, meth, unmeth, pct from covp where context in ('CG', 'CA')
  union all select 'off roster', null, null, null, null, null, null, null where false""")  # fmt: skip
def coverage_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coverage written as files per spot, with empty ones for spots of the roster without sites, and read back."""
    cov = adapters.coverage_percent(spark, sf_dir).withColumn("strand", F.lit("+"))
    roster = table(spark, sf_dir, "supplier").select((F.col("s_suppkey") + 1_000_000).alias("spot"))
    path = new_path(spark, "cov")
    sinks.write_spot_files(cov.where("context = 'CG'").drop("context", "strand"), path, "CG", roster)
    sinks.write_spot_files(cov.where("context = 'CA'"), path, "CA")
    found = [tables.coverage(spark, f"{path}/*/*.{c}.cov", context=c) for c in ("CG", "CA")]
    return found[0].unionByName(found[1])


@query("with " + COV_SQL + " select cast(spot as varchar) as spot, count(*) as n from covp where context = 'CG' group by 1 union all select cast(s_suppkey + 1000000 as varchar), 0 from supplier")
def spot_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The spots that have a coverage file, found by the files' names, and how many sites each holds."""
    cov = adapters.coverage_percent(spark, sf_dir).where("context = 'CG'").drop("context")
    path = new_path(spark, "cov")
    roster = table(spark, sf_dir, "supplier").select((F.col("s_suppkey") + 1_000_000).alias("spot"))
    sinks.write_spot_files(cov, path, "CG", roster)
    both = cov.select("spot").unionByName(roster).select(F.col("spot").cast("string").alias("barcode"))
    counts = tables.coverage(spark, f"{path}/*/*.CG.cov").groupBy("spot").agg(F.count(F.lit(1)).alias("n"))
    return tables.discovered_spots(spark, path, both).join(counts, "spot", "left").select("spot", F.coalesce("n", F.lit(0)).alias("n"))


@query("with " + COV_SQL + " select contig, pos, meth, unmeth, pct, cast(spot as varchar) as spot, row_number() over (order by contig, pos, cast(spot as varchar), meth, unmeth) as line from covp where context = 'CG'")
def aggregate_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All spots' sites in one sorted file set; ``line`` is the number of a site's line over the files in their order."""
    cov = adapters.coverage_percent(spark, sf_dir).where("context = 'CG'").withColumn("spot", F.col("spot").cast("string"))
    path = new_path(spark, "aggregate")
    sinks.write_aggregate(cov, path)
    schema = "contig string, pos bigint, end bigint, pct double, meth bigint, unmeth bigint, spot string"
    rows = spark.read.schema(schema).csv(path, sep="\t").drop("end")
    order = {c: F.col(c) for c in ("contig", "pos", "spot", "meth", "unmeth")}
    numbered = skew.numbered_in_order(rows, F.lit(0), order, {"pct": F.col("pct")}).rows
    return numbered.select("contig", "pos", "meth", "unmeth", "pct", "spot", (F.col("_n") + 1).alias("line"))


@query("with " + COV_SQL + ", o as (select cast(spot as varchar) as spot, contig, pos, meth, unmeth, 8 - cast(contig[4:] as int) as ord from covp where context = 'CG') "
       "select spot, contig, pos, meth, unmeth, row_number() over (partition by spot order by ord, pos) as place from o")  # fmt: skip
def aggregate_by_spot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All sites by spot with the contigs in a given, here falling, order; ``place`` is a line's number within its spot."""
    cov = adapters.coverage_percent(spark, sf_dir).where("context = 'CG'").withColumn("spot", F.col("spot").cast("string"))
    contigs = cov.select("contig").distinct().withColumn("ord", 8 - F.substr("contig", F.lit(4)).cast("int"))
    path = new_path(spark, "aggregate")
    sinks.write_aggregate(cov, path, contigs)
    rows = spark.read.schema("spot string, contig string, pos bigint, end bigint, meth bigint, unmeth bigint").csv(path, sep="\t").drop("end")
    m = F.col("_metadata")
    found = skew.numbered_in_order(rows.select("*", m["file_name"].alias("f"), m["file_block_start"].alias("b"), F.monotonically_increasing_id().alias("r")), F.col("spot"),
                                   {c: F.col(c) for c in ("f", "b", "r")}, {c: F.col(c) for c in ("contig", "pos", "meth", "unmeth")}).rows
    return found.select(F.col("_key").alias("spot"), "contig", "pos", "meth", "unmeth", (F.col("_n") + 1).alias("place"))


@query("with " + COV_SQL + ", o as (select spot, contig, pos, context, meth, unmeth, 8 - cast(contig[4:] as int) as ord from covp) select spot, contig, pos, context, meth, unmeth, row_number() over (order by ord, contig, pos, spot, context) as line from o")
def merged_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards by context put together in the order of given contigs and places; ``line`` is a row's number in it."""
    cov = adapters.coverage_percent(spark, sf_dir).drop("pct")
    contigs = cov.select("contig").distinct().withColumn("ord", 8 - F.substr("contig", F.lit(4)).cast("int"))
    merged = sites.in_contig_order([cov.where("context = 'CG'"), cov.where("context <> 'CG'")], contigs, "spot", "context")
    path = new_path(spark, "merged")
    merged.write.parquet(path)
    m = F.col("_metadata")
    rows = spark.read.schema(merged.schema).parquet(path).select("*", m["file_name"].alias("f"), m["row_index"].alias("r"))
    found = skew.numbered_in_order(rows, F.lit(0), {"f": F.col("f"), "r": F.col("r")}, {c: F.col(c) for c in merged.columns}).rows
    return found.select(*merged.columns, (F.col("_n") + 1).alias("line"))


@query("with " + COV_SQL + f""", c as (select contig, max(pos) + 1 as length from cov group by 1), n as (select *, cast(ceil(length / {_WIDTH}) as bigint) as k from c),
  f as (select *, coalesce(sum(k) over (order by contig rows between unbounded preceding and 1 preceding), 0) as first from n),
  cols as (select spot, row_number() over (order by spot) as col from (select distinct spot from cov)),
  m as (select spot, contig, pos // {_WIDTH} as bin, sum(meth) as meth, sum(meth + unmeth) as cov from cov where context = 'CG' group by all having sum(meth + unmeth) > 0)
  select cast(first + bin + 1 as bigint) as row, col, cast(meth as bigint) as meth, cast(cov as bigint) as cov, true as fits from m join f using (contig) join cols using (spot)""")  # fmt: skip
def matrix_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sparse matrix of CG sites by window and spot, written with its header and read back."""
    cov = adapters.coverage(spark, sf_dir)
    contigs = cov.groupBy("contig").agg((F.max("pos") + 1).alias("length")).withColumn("ord", F.col("contig"))
    path = new_path(spark, "matrix")
    sinks.write_matrix(sites.bin_matrix(cov, _WIDTH).where("context = 'CG'"), sites.genomic_bins(contigs, _WIDTH), cov, _WIDTH, path)
    f = F.split("value", " ")
    lines = spark.read.text(f"{path}/matrix").where(~F.startswith("value", F.lit("%")) & (F.size(f) == 5))
    whole = [f[i].cast("long").alias(c) for i, c in enumerate(("row", "col", "meth", "cov"))]
    return lines.select(*whole, (F.abs(f[4].cast("double") - f[2].cast("double") / f[3].cast("double")) <= 1e-6).alias("fits"))


@query(_COUNTS + "select spot, cast(sum(reads) as bigint) as reads from counts group by 1")
def counts_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Read counts written as a report with a header and read back."""
    counts = spots.read_counts(adapters.spot_reads(spark, sf_dir)).select(F.col("spot").alias("barcode"), "reads")
    path = new_path(spark, "counts")
    sinks.write_tsv(counts.orderBy("barcode"), path)
    return tables.read_counts(spark, path)


@query("with " + COV_SQL + ", s as (select cast(spot as varchar) as spot, avg(case when context = 'CG' then pct end) as m, count(case when context = 'CG' then 1 end) as n from covp group by 1 union all select 'NONE', null, 0) "
       "select spot, cast(round(m * 10) as bigint) as mean_tenths, n as cpg_site_count from s")  # fmt: skip
def stats_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics written with two places and ``NA`` and read back, in tenths."""
    stats = spots.meth_stats(adapters.coverage_percent(spark, sf_dir), "spot").select(F.col("spot").cast("string").alias("barcode"), F.col("mean_cg").alias("mean_5mCG"), F.col("n_cg").alias("cpg_site_count"))
    none = spark.range(0, 1, 1, 1).selectExpr("'none' as barcode", "cast(null as double) as mean_5mCG", "0L as cpg_site_count")
    path = new_path(spark, "stats")
    sinks.write_tsv(stats.unionByName(none), path, {"mean_5mCG": ".6f"})
    return tables.meth_stats(spark, path).select("spot", F.round(F.col("mean_5mCG") * 10).cast("long").alias("mean_tenths"), "cpg_site_count")


@query(_DEMUX + """ select case when reason = 'kept' then 'demux' else 'spike' end as route, case when reason = 'kept' then b || a end as spot,
  case when reason = 'kept' then '@' || b || a || ':' || name[2:] else name end as name, case when reason = 'kept' then seq[i + 29:] else seq end as seq, case when reason = 'kept' then qual[i + 29:] else qual end as qual,
  reverse(seq) as mate_seq, reverse(qual) as mate_qual from dm""")  # fmt: skip
def fastq_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs demultiplexed, written as FASTQ by mate and route, and read back by the pair source; spots come from the names."""
    layout = reads.Layout(adapters.linker(spark, sf_dir), indels=False)
    pairs = adapters.fastq(spark, sf_dir).withColumn("r2", F.struct("name", F.reverse("seq").alias("seq"), "plus", F.reverse("qual").alias("qual")))
    path = new_path(spark, "fastq")
    sinks.write_demultiplexed(reads.demultiplex(pairs, adapters.listed(spark, sf_dir), layout), path)
    sequencing.register(spark)
    rows = spark.read.format("fastq_pairs").option("ending", ".txt.gz").load(path)
    route = F.regexp_extract("file", "route=([a-z]+)", 1)
    return rows.select(
        route.alias("route"), F.when(route == "demux", name_spot("r1.name")).alias("spot"), F.col("r1.name").alias("name"), F.col("r1.seq").alias("seq"), F.col("r1.qual").alias("qual"),
        F.col("r2.seq").alias("mate_seq"), F.col("r2.qual").alias("mate_qual"),
    )


@query(_GOOD + " select name, upper(seq) as seq, qual from good")
def fastq_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Single reads written as FASTQ text and read back."""
    record = F.concat_ws("\n", "name", F.upper("seq"), F.lit("+"), "qual").alias("value")
    path = new_path(spark, "fastq")
    adapters.fastq(spark, sf_dir).select(record).write.option("compression", "gzip").text(path)
    sequencing.register(spark)
    return spark.read.format("fastq").option("ending", ".txt.gz").load(path).select("name", "seq", "qual")


@query(_REF + "select * from rs")
def fasta_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reference written as FASTA, read in chunks of 32 bases with a base on either side, and its sites."""
    chunks = adapters.chunk_reference(spark, sf_dir).groupBy("contig").agg(F.array_sort(F.collect_list(F.struct("start", "seq"))).alias("c"))
    lines = F.concat_ws("\n", F.concat(F.lit(">"), "contig", F.lit(" of a chunk")), F.array_join(F.transform("c", lambda x: x["seq"]), "\n"))
    path = new_path(spark, "fasta")
    chunks.select(lines.alias("value")).write.text(path)
    sequencing.register(spark)
    return sites.reference_sites(spark.read.format("fasta").option("ending", ".txt").option("chunk", "32").load(path))


@query("with r as (select sample_id, count(*) as n, cast(coalesce(sum(n_bytes), 0) as bigint) as b from count_files where sample_id is not null group by 1) select sample_id, n as total_reads_before, b as total_bases_before, n - 1 as total_reads_after, null::bigint as total_bases_after from r")
def trimming_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trimming reports as JSON documents, one per sample, read back; a number that isn't there is null."""
    per = table(spark, sf_dir, "count_files").where("sample_id is not null").groupBy("sample_id").agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("n_bytes"), F.lit(0)).alias("b"))
    before = F.struct(F.col("n").alias("total_reads"), F.col("b").cast("double").cast("string").alias("total_bases"))
    after = F.struct((F.col("n") - 1).alias("total_reads"))
    doc = F.to_json(F.struct(F.struct(before.alias("before_filtering"), after.alias("after_filtering")).alias("summary"))).alias("value")
    path = new_path(spark, "json")
    per.select(doc, "sample_id").repartition("sample_id").write.partitionBy("sample_id").text(path)
    found = tables.trimming_reports(spark, path, names="*.txt").withColumn("sample_id", F.regexp_extract("path", "sample_id=([^/]+)", 1))
    return found.select("sample_id", *(F.col(f"{n}_{w}").alias(f"total_{n}_{w}") for w in ("before", "after") for n in ("reads", "bases")))
