"""The queries of the assay's own operators, and the SQL that checks them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numbers import as_float, as_int, first_json
from ..functions.text import name_spot
from ..operators import drift, reads, sites, spots
from . import adapters
from .adapters import ALIGNMENTS_SQL, COV_SQL, SPOT_READS_SQL
from .problems import _FASTQ, COUNTS, MEANS, STATS_SQL, p4_table, table

MITO = ["chr7"]
BIN = 100
MOTIF = "GGC"
QUERIES: dict = {}
SQL: dict[str, str] = {}
_GOOD = _FASTQ + ", good as (select row_id, name, seq, plus, qual from judged where reason is null)"


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


# --- spots -------------------------------------------------------------------------------------------------

_COUNTS = "with " + SPOT_READS_SQL + ", counts as (select sample_id, spot, count(*) as n_records, cast(coalesce(sum(reads), 0) as bigint) as reads from spot_reads group by all)"


def _counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spots.read_counts(adapters.spot_reads(spark, sf_dir), "sample_id")


@query(_COUNTS + "select * from counts")
def spot_read_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _counts(spark, sf_dir)


@query(_COUNTS + "select spot, cast(sum(reads) as bigint) as reads from counts group by spot order by reads desc, spot limit 16")
def top_spots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spots.top_spots(_counts(spark, sf_dir).groupBy("spot").agg(F.sum("reads").alias("reads")))


@query(_COUNTS + "select * from counts where spot in (select spot from counts where sample_id = 'S0000001') and spot not in (select spot from counts where sample_id = 'S0000002' and reads > 100)")
def selected_spots(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = _counts(spark, sf_dir)
    return spots.selected(counts, counts.where("sample_id = 'S0000001'"), counts.where("sample_id = 'S0000002' and reads > 100"))


@query(_COUNTS + "select spot, cast(sum(reads) as bigint) as reads from counts group by spot order by md5('11:' || spot), spot limit 16")
def random_spots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spots.random_spots(_counts(spark, sf_dir).groupBy("spot").agg(F.sum("reads").alias("reads")))


_FUNNEL = """
select {by} count(*) as n_records, cast(count(*) filter (ok) as bigint) as mapped_reads, cast(count(*) filter (ok and v) as bigint) as valid_reads,
  cast(count(*) filter (ok and v and contig = 'chr7') as bigint) as valid_mito, cast(count(*) filter (ok and v and contig <> 'chr7') as bigint) as valid_nuclear
from (select *, flag in (99, 147, 83, 163) as v, flag & 4 = 0 and mapq > 10 and coalesce(hits, 1) <= 1 as ok from alignments) {group}"""


@query("with " + ALIGNMENTS_SQL + _FUNNEL.format(by="", group=""))
def host_funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spots.total_funnel(spots.counts_and_funnel(adapters.alignments(spark, sf_dir), MITO))


@query("with " + ALIGNMENTS_SQL + _FUNNEL.format(by="spot, ", group="group by spot"))
def counts_and_funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spots.counts_and_funnel(adapters.alignments(spark, sf_dir), MITO)


@query("with " + ALIGNMENTS_SQL + "select contig, count(*) as n from alignments where flag & 4 = 0 group by contig")
def contig_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    mapped = adapters.alignments(spark, sf_dir).where(F.col("flag").bitwiseAND(4) == 0)
    return mapped.groupBy("contig").agg(F.count(F.lit(1)).alias("n"))


@query("with " + ALIGNMENTS_SQL + "select * from alignments where cast('0x' || md5('11:' || name)[1:8] as bigint) < cast(floor(0.25 * 4294967296) as bigint)")
def subsampled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spots.subsample(adapters.alignments(spark, sf_dir), "name", 0.25)


_CURVE = _COUNTS + """,
curve as (select sample_id, spot, reads, cast(row_number() over (partition by sample_id order by reads desc, spot) as int) as rk, count(*) over (partition by sample_id) as n
  from counts where reads > 10 and sample_id is not null)"""
_KNEE = _CURVE + """,
y as (select *, log10(reads + 1) as y, case when n > 51 then 25 when n % 2 = 1 then (n - 1) / 2 else greatest(n - 2, 0) / 2 end as half from curve),
x as (select *, rk * case when half > 0 then 25 / half else 26.0 end as x from y),
sm as (select *, (sum(y) over (partition by sample_id order by x range between 25.5 preceding and 25.5 following)
  + greatest(half + 1 - rk, 0) * first_value(y) over (partition by sample_id order by rk rows between unbounded preceding and unbounded following)
  + greatest(rk + half - n, 0) * last_value(y) over (partition by sample_id order by rk rows between unbounded preceding and unbounded following)) / (2 * half + 1) as z from x),
sl as (select *, case when rk = 1 then lead(z) over w - z when rk = n then z - lag(z) over w else 0.5 * (lead(z) over w - lag(z) over w) end as slope
  from sm window w as (partition by sample_id order by rk)),
se as (select *, floor(n * 0.05) as s, n - floor(n * 0.10) as e from sl),
st as (select *, min(slope) over (partition by sample_id) as steepest from se where n >= 2 and e - s >= 2 and rk > s and rk <= e),
knees as (select sample_id, arg_min(reads, rk) as threshold, min(rk) as knee_rank, cast(any_value(s) as bigint) as exclude_start, cast(any_value(e) as bigint) as exclude_end
  from st where slope <= 0.5 * steepest group by sample_id)"""


@query(_CURVE + "select * from curve")
def barcode_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spots.rank_curve(_counts(spark, sf_dir).where("sample_id is not null"), "sample_id")


def _knees(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    counts = _counts(spark, sf_dir).where("sample_id is not null")
    return counts, spots.knee(counts, "sample_id")


@query(_KNEE + "select * from knees")
def knee(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _knees(spark, sf_dir)[1]


@query(_KNEE + "select sample_id, min(rk) as marker_rank from curve join knees using (sample_id) where reads <= threshold group by sample_id")
def knee_marker(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts, found = _knees(spark, sf_dir)
    return spots.knee_marker(spots.rank_curve(counts, "sample_id"), found, "sample_id")


@query(_KNEE + "select sample_id, spot, reads, threshold, case when threshold is not null then cast(reads > threshold as int) end as is_hq from counts left join knees using (sample_id) where sample_id is not null")
def hq_spots(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts, found = _knees(spark, sf_dir)
    joined = counts.join(found.select("sample_id", "threshold"), "sample_id", "left")
    return joined.select("sample_id", "spot", "reads", "threshold", spots.high_quality(F.col("reads"), F.col("threshold")).alias("is_hq"))


# earlier runs' thresholds: the last computed of each sample
@query(_COUNTS + ", k as (select sample_id, arg_max(threshold, struct_pack(computed_at, threshold)) as threshold from knee_results where sample_id is not null and threshold is not null and computed_at is not null group by sample_id) "
       "select sample_id, count(*) as n_spots, count(*) filter (reads > threshold) as n_hq from counts join k using (sample_id) group by sample_id")  # fmt: skip
def hq_by_earlier_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = table(spark, sf_dir, "knee_results").where("sample_id is not null and threshold is not null and computed_at is not null")
    last = runs.groupBy("sample_id").agg(F.max(F.struct("computed_at", "threshold"))["threshold"].alias("threshold"))
    joined = _counts(spark, sf_dir).join(last, "sample_id")
    return joined.groupBy("sample_id").agg(F.count(F.lit(1)).alias("n_spots"), F.count_if(F.col("reads") > F.col("threshold")).alias("n_hq"))


_POSITIONS = """
places as (select spot, p.array_row as array_row, p.array_col as array_col from (
  select upper(trim(barcode)) as spot, max(struct_pack(line_no, array_row, array_col)) as p from barcode_positions
  where trim(barcode) <> '' and array_row is not null and array_col is not null group by 1))"""


@query("with " + _POSITIONS + "select * from places")
def spot_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spots.positions(table(spark, sf_dir, "barcode_positions"))


@query(_COUNTS + ", " + _POSITIONS + """,
  v as (select array_row, array_col, sum(reads) as value from counts join places using (spot) group by 1, 2)
  select r.array_row, c.array_col, cast(value as bigint) as value from (select unnest(range(50))::int as array_row) r cross join (select unnest(range(50))::int as array_col) c
  left join v on v.array_row = r.array_row and v.array_col = c.array_col""")  # fmt: skip
def spot_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = _counts(spark, sf_dir).join(spots.positions(table(spark, sf_dir, "barcode_positions")), "spot")
    return spots.grid(placed.groupBy("array_row", "array_col").agg(F.sum("reads").alias("value")), 50, 50)


_WIDE = "avg(case when context = 'CG' then pct end) as mean_cg, count(case when context = 'CG' then pct end) as n_cg, avg(case when context <> 'CG' then pct end) as mean_ch, count(case when context <> 'CG' then pct end) as n_ch"
_STATS = _WIDE + "".join(f", avg(case when context = '{c}' then pct end) as mean_{c.lower()}, count(case when context = '{c}' then pct end) as n_{c.lower()}" for c in ("CA", "CC", "CT"))
_EXACT = ["cg", "ch", "ca", "cc", "ct"]


def _exact_sums(stats: DataFrame, *keys: str) -> DataFrame:
    """Means as whole hundredths' sums: the same in every order of addition."""
    return stats.select(*keys, *(f"n_{k}" for k in _EXACT), *(F.round(F.col(f"mean_{k}") * F.col(f"n_{k}") * 100).cast("long").alias(f"sum_{k}") for k in _EXACT))


_SUMS = ", ".join(f"n_{k}, cast(round(mean_{k} * n_{k} * 100) as bigint) as sum_{k}" for k in _EXACT)


@query("with " + COV_SQL + ", s as (select spot, " + _STATS + " from covp group by spot) select spot, " + _SUMS + " from s")
def spot_meth_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _exact_sums(spots.meth_stats(adapters.coverage_percent(spark, sf_dir), "spot"), "spot")


@query("with " + COV_SQL + ", s as (select " + _STATS + " from covp) select " + _SUMS + " from s")
def merged_meth_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _exact_sums(spots.merged_stats(spots.meth_stats(adapters.coverage_percent(spark, sf_dir), "spot", "contig")))


@query("with " + COV_SQL + ", s as (select spot, contig, " + _STATS + " from covp group by 1, 2), "
       "a as (select spot, n_cg, n_ch from s where contig = 'chr1'), b as (select spot, n_cg, n_ch from s where contig = 'chr3' and spot not in (select spot from a)) select * from a union all select * from b")  # fmt: skip
def resumed_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    per = spots.meth_stats(adapters.coverage_percent(spark, sf_dir), "spot", "contig")
    one = lambda c: per.where(F.col("contig") == c).select("spot", "n_cg", "n_ch")
    return spots.resumed_stats(one("chr1"), one("chr3"))


@query("with " + COV_SQL + ", s as (select spot, count(*) as n from covp group by spot) select quantile_cont(n, 0.5) as median_sites, cast(sum(n) as bigint) as sites from s")
def median_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    per = adapters.coverage_percent(spark, sf_dir).groupBy("spot").agg(F.count(F.lit(1)).alias("n"))
    return per.agg(F.percentile("n", 0.5).alias("median_sites"), F.sum("n").alias("sites"))


_SUMMARY = "with " + COV_SQL + """,
stats as (select spot, count(case when context = 'CG' then pct end) as n_cg from covp group by spot),
r as (select o_custkey as spot, count(*) as reads from orders group by 1),
places as (select s_suppkey as spot, cast(s_suppkey // 10 as int) as array_row, cast(s_suppkey % 10 as int) as array_col from supplier)
select coalesce(stats.spot, r.spot) as spot, n_cg, reads, array_row, array_col from stats full join r on stats.spot = r.spot left join places on places.spot = coalesce(stats.spot, r.spot)"""


@query(_SUMMARY)
def spot_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = spots.meth_stats(adapters.coverage_percent(spark, sf_dir), "spot").select("spot", "n_cg")
    counts = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("spot")).agg(F.count(F.lit(1)).alias("reads"))
    key = F.col("s_suppkey")
    places = table(spark, sf_dir, "supplier").select(key.alias("spot"), F.floor(key / 10).cast("int").alias("array_row"), (key % 10).cast("int").alias("array_col"))
    return spots.spot_summary(stats, counts, places)


@query(_COUNTS + """, s as (select sample_id, count(distinct spot) as n_spots, cast(sum(reads) as bigint) as reads from counts where sample_id is not null group by 1),
  c as (select sample_id, contig, cast(coalesce(sum(reads), 0) as bigint) as reads from spot_reads where contig in ('chrM', 'chr1', 'chr2') group by all)
  select s.*, (select reads from c where c.sample_id = s.sample_id and contig = 'chr1') as reads_chr1, (select reads from c where c.sample_id = s.sample_id and contig = 'chr2') as reads_chr2,
  (select reads from c where c.sample_id = s.sample_id and contig = 'chrM') as "reads_chrM" from s""")  # fmt: skip
def sample_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = adapters.spot_reads(spark, sf_dir).where("sample_id is not null")
    total = rows.groupBy("sample_id").agg(F.countDistinct("spot").alias("n_spots"), F.coalesce(F.sum("reads"), F.lit(0)).alias("reads"))
    names = ["chr1", "chr2", "chrM"]
    wide = rows.where(F.col("contig").isin(names)).withColumn("contig", F.concat(F.lit("reads_"), "contig")).groupBy("sample_id")
    wide = wide.pivot("contig", [f"reads_{n}" for n in names]).agg(F.first(F.lit(1)).alias("one"), F.sum("reads").alias("sum"))
    cols = [F.when(F.col(f"reads_{n}_one").isNotNull(), F.coalesce(f"reads_{n}_sum", F.lit(0))).alias(f"reads_{n}") for n in names]
    return total.join(wide.select("sample_id", *cols), "sample_id", "left")


@query("with " + COV_SQL + ", s as (select spot, contig, " + _STATS + " from covp group by 1, 2), "
       "a as (select spot, contig, n_cg, n_ch from s where contig <= 'chr4'), b as (select spot, contig, n_cg, n_ch from s where contig >= 'chr3' and (spot, contig) not in (select (spot, contig) from a)) select * from a union all select * from b")  # fmt: skip
def resumed_stats_of_all_contigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs over contigs that overlap and together are all."""
    per = spots.meth_stats(adapters.coverage_percent(spark, sf_dir), "spot", "contig").select("spot", "contig", "n_cg", "n_ch")
    return spots.resumed_stats(per.where("contig <= 'chr4'"), per.where("contig >= 'chr3'"), "contig")


@query("with " + COV_SQL + ", s as (select spot, " + _STATS + " from covp group by spot) "
       "select c.spot, cast(1 + c.c_nationkey * 100000 + c.spot as bigint) as ord, " + _SUMS + " from (select c_custkey as spot, c_nationkey from customer) c left join s on s.spot = c.spot")  # fmt: skip
def roster_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as a roster, by nation: most have no rows."""
    roster = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("spot"), (1 + F.col("c_nationkey").cast("long") * 100000 + F.col("c_custkey")).alias("ord"))
    return _exact_sums(spots.roster_stats(roster, spots.meth_stats(adapters.coverage_percent(spark, sf_dir), "spot")), "spot", "ord")


@query("with " + SPOT_READS_SQL + """ select coalesce(r.sample_id, '') as sample_id, contig, cast(coalesce(sum(reads), 0) as bigint) as reads, count(distinct spot) as n_spots from spot_reads r group by 1, 2""")
def sample_contigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The long form of a sample's summary: every contig has its row."""
    rows = adapters.spot_reads(spark, sf_dir).groupBy(F.coalesce("sample_id", F.lit("")).alias("sample_id"), "contig")
    return rows.agg(F.coalesce(F.sum("reads"), F.lit(0)).alias("reads"), F.countDistinct("spot").alias("n_spots"))


_PAIRS = dict(zip(MEANS, COUNTS))
_REPORT = STATS_SQL + ", " + SPOT_READS_SQL + """,
newest as (select sample_id, arg_max(file_id, n) as file_id from versioned where sample_id is not null group by 1),
means as (select t.sample_id, """ + ", ".join(f'sum(round_even("{m}", 2) * "{c}") filter ("{m}" is not null and "{c}" > 0) / sum("{c}") filter ("{m}" is not null and "{c}" > 0) as "{m}"' for m, c in _PAIRS.items()) + """,
  quantile_cont(cpg_site_count, 0.5) filter ("mean_5mCG" is not null and cpg_site_count > 0) as median_cpg_site_count from tbl t join newest using (file_id) group by 1),
raw as (select sample_id, cast(coalesce(sum(reads), 0) as bigint) as raw_reads from spot_counts where sample_id is not null group by 1),
valid as (select sample_id, cast(coalesce(sum(reads), 0) as bigint) as barcoded_reads, cast(coalesce(sum(reads) filter (contig = 'chrM'), 0) as bigint) as mito_reads from spot_reads where sample_id is not null group by 1),
totals as (select sample_id, raw_reads, barcoded_reads, mito_reads, barcoded_reads - mito_reads as nuclear_reads from raw left join valid using (sample_id))
select coalesce(t.sample_id, m.sample_id) as sample_id, """ + ", ".join(f"coalesce(format('{{:,}}', {c}), 'NA') as {c}" for c in ("raw_reads", "barcoded_reads", "mito_reads", "nuclear_reads")) + """,
  coalesce(case when raw_reads > 0 then printf('%.2f', barcoded_reads / raw_reads * 100) || '%' end, 'NA') as barcoded_reads_rate,
  coalesce(case when barcoded_reads > 0 then printf('%.2f', mito_reads / barcoded_reads * 100) || '%' end, 'NA') as mito_reads_rate, """ + ", ".join(
    f"""coalesce(printf('%.2f', "{c}"), 'NA') as "{c}\"""" for c in [*MEANS, "median_cpg_site_count"]
) + """ from totals t full join means m on t.sample_id = m.sample_id"""


@query(_REPORT)
def sample_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per sample: reads, rates, and the means of the spots of its newest statistics file, as text with ``NA``."""
    files = table(spark, sf_dir, "meth_stats_files").where("sample_id is not null")
    newest = files.groupBy("sample_id").agg(F.max(F.struct("written_at", "file_id"))["file_id"].alias("file_id"))
    stats = p4_table(spark, sf_dir).join(newest.select("file_id"), "file_id", "left_semi")
    means = spots.weighted_means(stats, _PAIRS, "sample_id")
    raw = table(spark, sf_dir, "spot_counts").where("sample_id is not null").groupBy("sample_id").agg(F.coalesce(F.sum("reads"), F.lit(0)).alias("raw_reads"))
    mito = F.sum(F.when(F.col("contig") == "chrM", F.col("reads")))
    valid = adapters.spot_reads(spark, sf_dir).groupBy("sample_id").agg(F.coalesce(F.sum("reads"), F.lit(0)).alias("barcoded_reads"), F.coalesce(mito, F.lit(0)).alias("mito_reads"))
    totals = raw.join(valid, "sample_id", "left").withColumn("nuclear_reads", F.col("barcoded_reads") - F.col("mito_reads"))
    rates = {"barcoded_reads_rate": ("barcoded_reads", "raw_reads"), "mito_reads_rate": ("mito_reads", "barcoded_reads")}
    return spots.sample_report(totals, means, "sample_id", ["raw_reads", "barcoded_reads", "mito_reads", "nuclear_reads"], rates, [*MEANS, "median_cpg_site_count"])


# --- sites -------------------------------------------------------------------------------------------------


@query("with " + COV_SQL + "select * from covp")
def site_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapters.coverage_percent(spark, sf_dir)


@query("with " + COV_SQL + f""", two as (select spot, contig, pos, unnest(case when context = 'CG' then ['CG'] else [context, 'CH'] end) as context, meth, unmeth from cov)
  select spot, contig, cast(pos // {BIN} as bigint) as bin, context, cast(sum(meth) as bigint) as meth, cast(sum(meth + unmeth) as bigint) as cov,
  cast(sum(meth) as bigint) / cast(sum(meth + unmeth) as bigint) as frac from two group by 1, 2, 3, 4 having sum(meth + unmeth) > 0""")  # fmt: skip
def bin_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sites.bin_matrix(adapters.coverage(spark, sf_dir), BIN)


@query("with " + COV_SQL + f""", c as (select contig, max(pos) + 1 as length from cov group by 1), n as (select *, cast(ceil(length / {BIN}) as bigint) as k from c),
  f as (select *, coalesce(sum(k) over (order by contig rows between unbounded preceding and 1 preceding), 0) as first from n),
  g as (select contig, length, first, unnest(range(k)) as i from f)
  select cast(first + i as bigint) as bin_id, contig, cast(i * {BIN} as bigint) as start, cast(least((i + 1) * {BIN}, length) as bigint) as "end" from g""")  # fmt: skip
def genomic_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    contigs = adapters.coverage(spark, sf_dir).groupBy("contig").agg((F.max("pos") + 1).alias("length")).withColumn("ord", F.col("contig"))
    return sites.genomic_bins(contigs, BIN)


@query("with " + COV_SQL + "select spot, meth + unmeth as depth, count(*) as n from cov where meth + unmeth > 0 and context = 'CG' group by 1, 2")
def depth_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sites.depth_histogram(adapters.coverage(spark, sf_dir).where("context = 'CG'"), "spot")


def _saturation(spark: SparkSession, sf_dir: str) -> DataFrame:
    cov = adapters.coverage(spark, sf_dir).where("context = 'CG'")
    return sites.saturation_points(sites.expected_sites(sites.depth_histogram(cov, "spot"), sites.FRACTIONS, "spot"))


def _rounded(df: DataFrame, *names: str) -> DataFrame:
    """Sums of many doubles, which depend on the order of addition, in whole millionths."""
    return df.withColumns({n: F.round(F.col(n) * 1e6).cast("long") for n in names})


@query("with " + COV_SQL + """, h as (select spot, meth + unmeth as d, count(*) as n from cov where context = 'CG' and meth + unmeth > 0 group by 1, 2),
  e as (select spot, f as fraction, sum(n * (1 - power(1 - f, d))) as x from h cross join (select unnest([0.01, 0.02, 0.05, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]::double[]) as f) group by 1, 2),
  q as (select fraction, quantile_cont(x, [0.25, 0.5, 0.75]) as q from e group by 1)
  select fraction, cast(round(q[2] * 1e6) as bigint) as median, cast(round((q[2] - q[1]) * 1e6) as bigint) as below, cast(round((q[3] - q[2]) * 1e6) as bigint) as above from q""")  # fmt: skip
def saturation_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_saturation(spark, sf_dir), "median", "below", "above")


_POINTS = """
  e as (select spot, f as fraction, sum(n * (1 - power(1 - f, d))) as x from h cross join (select unnest([0.01, 0.02, 0.05, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]::double[]) as f) group by 1, 2),
  q as (select fraction, quantile_cont(x, [0.25, 0.5, 0.75]) as q from e group by 1)"""


def _grid(name: str, before: str, exponent: str, count: int) -> str:
    """The best of ``before`` and a grid of rates, the first of equally good ones."""
    return f"""
  {name}b as (select k, power(10.0, {exponent}) as b from (select unnest(range({count})) as k) cross join {before}),
  {name}a as (select k, b, greatest(sum(y * (1 - exp(-b * f))) / sum((1 - exp(-b * f)) * (1 - exp(-b * f))), 0) as a from {name}b cross join pts group by 1, 2),
  {name}e as (select k, b, a, sum((y - a * (1 - exp(-b * f))) * (y - a * (1 - exp(-b * f)))) as err from {name}a cross join pts group by 1, 2, 3),
  {name}n as (select arg_min(struct_pack(a, b, err), struct_pack(err, k)) as s from {name}e),
  {name} as (select case when s.err < err then s.a else a end as a, case when s.err < err then s.b else b end as b, least(s.err, err) as err from {name}n cross join {before})"""


@query("with " + COV_SQL + ", h as (select spot, meth + unmeth as d, count(*) as n from cov where context = 'CG' and meth + unmeth > 0 group by 1, 2)," + _POINTS + """,
  pts as (select fraction as f, q[2] as y from q), line as (select sum(f * y) / sum(f * f) as slope, avg(y) as m from pts),
  fit as (select slope, case when sum((y - m) * (y - m)) <= 0 then 0 else 1 - sum((y - slope * f) * (y - slope * f)) / sum((y - m) * (y - m)) end as r2 from pts cross join line group by slope),
  g as (select 0.0 as a, 1.0 as b, 'infinity'::double as err),""" + _grid("g0", "g", "-4 + k * 6.0 / 799", 800) + "," + ",".join(_grid(f"g{i}", f"g{i - 1}", "log10(b) - 0.7 + k * 1.4 / 239", 240) for i in (1, 2, 3)) + """
  select cast(round(slope * 1e6) as bigint) as slope, cast(round(r2 * 1e6) as bigint) as r2, cast(round(a) as bigint) as a, cast(round(b * 1e3) as bigint) as b, case when r2 >= 0.99 then 'linear' else 'saturation' end as model,
  cast(round(case when r2 >= 0.99 then slope * 2 else a * (1 - exp(-b * 2)) end) as bigint) as predicted, cast(round(case when r2 < 0.99 then a end) as bigint) as most from fit cross join g3""")  # fmt: skip
def saturation_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _rounded(sites.predicted(sites.saturation_fit(_saturation(spark, sf_dir)), 2.0), "slope", "r2")
    whole = {c: F.round(c).cast("long") for c in ("a", "predicted", "most")}
    return found.withColumns({**whole, "b": F.round(F.col("b") * 1e3).cast("long")})


@query("with " + COV_SQL + ", counts as (select 'all' as sample_id, l_suppkey as spot, count(*) as reads from lineitem group by 2)" + _KNEE[len(_COUNTS):] + """,
  hq as (select spot from counts, knees where reads > threshold), facts as (select count(*) as n_hq, (select threshold from knees) as threshold from hq),
  h as (select spot, meth + unmeth as d, count(*) as n from cov where context = 'CG' and meth + unmeth > 0 and spot in (select spot from hq) group by 1, 2),""" + _POINTS + """
  select fraction, cast(round(q[2] * 1e6) as bigint) as median, cast(round((q[2] - q[1]) * 1e6) as bigint) as below, cast(round((q[3] - q[2]) * 1e6) as bigint) as above, n_hq, threshold from q cross join facts""")  # fmt: skip
def hq_saturation(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = spots.read_counts(adapters.alignments(spark, sf_dir).withColumn("reads", F.lit(1)), "contig").groupBy("spot").agg(F.sum("n_records").alias("reads"))
    return _rounded(sites.hq_saturation(counts, adapters.coverage(spark, sf_dir)), "median", "below", "above")


_DELTA = "case when ma + ua > 0 and mb + ub > 0 then abs(ma / (ma + ua) - mb / (mb + ub)) * 100 end"


@query("with " + COV_SQL + """, a as (select contig, pos, spot, sum(meth) as ma, sum(unmeth) as ua from cov where context in ('CG', 'CC') group by all),
  b as (select contig, pos + 1 as pos, spot, sum(meth) as mb, sum(unmeth) as ub from cov where context in ('CA', 'CT') group by all),
  j as (select coalesce(a.contig, b.contig) as contig, ma, ua, mb, ub from a full join b on a.contig = b.contig and a.pos = b.pos and a.spot = b.spot)
  select contig, count(*) filter (ma is not null and mb is not null) as shared, count(*) filter (mb is null) as only_a, count(*) filter (ma is null) as only_b,
  cast(round(corr(ma, mb) * 1e6) as bigint) as corr_meth, cast(round(corr(ua, ub) * 1e6) as bigint) as corr_unmeth, cast(round(avg(""" + _DELTA + """) * 1e6) as bigint) as mean_abs_delta,
  count(*) filter (ma is not null and mb is not null and (ma > ua) <> (mb > ub)) / nullif(count(*) filter (ma is not null and mb is not null), 0) as disagreement from j group by contig""")  # fmt: skip
def caller_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    cov = adapters.coverage(spark, sf_dir)
    one = lambda *c: cov.where(F.col("context").isin(*c)).groupBy("contig", "pos", "spot").agg(F.sum("meth").alias("meth"), F.sum("unmeth").alias("unmeth"))
    a, b = one("CG", "CC"), one("CA", "CT")
    found = sites.compare_coverage(a.withColumn("pos", F.struct("pos", "spot")), b.withColumn("pos", F.struct((F.col("pos") + 1).alias("pos"), "spot")), "contig")
    return _rounded(found, "corr_meth", "corr_unmeth", "mean_abs_delta")


_REF = _GOOD + """,
placed as (select row_id // 2 as name, 'c' || (row_id // 64) as contig, line_no % 7 as start, upper(seq) as seq, qual, upper(seq)[1:2] as spot, row_id % 17 * 4 as mapq, row_id % 23 = 0 as unclear,
  case when row_id // 2 % 2 = 0 then ([99, 147])[1 + row_id % 2] else ([83, 163])[1 + row_id % 2] end as flag, case when length(seq) >= 20 then row_id % 4 else 0 end as kind
  from good join fastq_rows using (row_id)),
refs as (select contig, max(seq) as s from placed group by contig),
walk as (select contig, i - 1 as pos, s[i] as b, case when i > 1 then s[i - 1] end as p, s[i + 1] as n from (select contig, s, unnest(range(1, length(s) + 1)) as i from refs)),
refsites as (select contig, cast(pos as bigint) as pos, case when b = 'C' and n = 'G' then 'CG' when b = 'C' and n in ('A', 'C', 'T') then 'C' || n when b = 'G' and p = 'T' then 'CA' when b = 'G' and p = 'G' then 'CC' when b = 'G' and p = 'A' then 'CT' end as context,
  case when b = 'C' and n = 'G' then null when b = 'C' then '+' else '-' end as strand from walk),
rs as (select * from refsites where context is not null)"""


@query(_REF + "select * from rs")
def reference_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sites.reference_sites(adapters.chunk_reference(spark, sf_dir))


@query(_REF + "select contig, pos, context, strand from (select *, row_number() over (partition by contig order by pos) as k from rs where context = 'CG') where k <= 3")
def first_cg_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sites.first_sites(sites.reference_sites(adapters.chunk_reference(spark, sf_dir)).where("context = 'CG'"), 3)


_BASES = _REF + """,
walked as (select *, length(seq) as n, ascii(qual[q + 1]) - 33 as ql from (select *, unnest(range(length(seq))) as q from placed where mapq >= 10 and not unclear)),
bases as (select *, cast(start + q + case kind when 1 then -3 when 2 then case when q >= 10 then 2 else 0 end when 3 then case when q >= 12 then -2 else 0 end else 0 end as bigint) as pos
  from walked where ql >= 13 and not (kind = 1 and q < 3) and not (kind = 3 and q in (10, 11))),
hit as (select b.*, context, strand, case when context = 'CG' or strand = '+' then 1 else -1 end as side, seq[q + 1] as b0 from bases b join rs using (contig, pos)),
near as (select *, seq[q + 1 + side] as b1, case when flag & 16 <> 0 then n - q else q + 1 end as l0, case when flag & 16 <> 0 then q + 1 else n - q end as r0,
  case when flag & 16 <> 0 then n - q - side else q + side + 1 end as l1, case when flag & 16 <> 0 then q + side + 1 else n - q - side end as r1,
  row_number() over (partition by name, contig, pos order by ql desc, flag & 64 = 0) as mate from hit qualify q + side >= 0 and q + side < n),
kept as (select * from near where mate = 1 and not (flag & 64 <> 0 and (l0 <= 2 or r0 <= 1 or l1 <= 2 or r1 <= 1)) and not (flag & 64 = 0 and (l0 <= 1 or l1 <= 1))),
called as (select spot, contig, pos, context, strand, case
  when context = 'CG' then case when b0 || b1 in ('TG', 'CA') then true when b0 || b1 = 'CG' then false end
  when strand = '+' and flag in (99, 147) and ((context = 'CC' and b1 in ('C', 'T')) or (context <> 'CC' and b1 = context[2])) then case b0 when 'T' then true when 'C' then false end
  when strand = '-' and flag in (83, 163) and ((context = 'CC' and b1 in ('G', 'A')) or (context = 'CA' and b1 = 'T') or (context = 'CT' and b1 = 'A')) then case b0 when 'A' then true when 'G' then false end
  end as m from kept)"""


def _at(spark: SparkSession, sf_dir: str, places=lambda s: s) -> DataFrame:
    """The bases of the placed reads at the sites of their reference."""
    ref = sites.reference_sites(adapters.chunk_reference(spark, sf_dir))
    return sites.bases_at(adapters.placed_reads(spark, sf_dir), places(ref), 10, 13)


@query(_BASES + """ select spot, contig, pos, context, strand, count(*) filter (m) as meth, count(*) filter (not m) as unmeth, round_even(count(*) filter (m) / count(*) * 100, 2) as pct
  from called where m is not null group by 1, 2, 3, 4, 5""")  # fmt: skip
def call_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sites.coverage(sites.site_calls(_at(spark, sf_dir), True, (2, 1), (1, 0)), "spot")


@query(_BASES + """, targeted as (select *, case cast(contig[2:] as bigint) % 5 when 0 then 'host_mito' when 1 then 'spike_a' when 2 then null else 'host' end as target from called where m is not null),
  pooled as (select *, case when target = 'host' then spot end as who from targeted where target is not null)
  select target, who as spot, contig, pos, context, strand, count(*) filter (m) as meth, count(*) filter (not m) as unmeth, round_even(count(*) filter (m) / count(*) * 100, 2) as pct from pooled group by all""")  # fmt: skip
def call_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, mitochondrial and spike contigs called in one pass; only the host's sites are counted by spot."""
    kind = F.substr("contig", F.lit(2)).cast("long") % 5
    target = F.when(kind == 0, "host_mito").when(kind == 1, "spike_a").when(kind == 2, None).otherwise("host")
    targets = adapters.chunk_reference(spark, sf_dir).select("contig").distinct().withColumn("target", target).where("target is not null")
    return sites.coverage_by_target(sites.site_calls(_at(spark, sf_dir), True, (2, 1), (1, 0)), targets)


_MBIAS = """, cyc as (select case when flag & 64 <> 0 then 'R1' else 'R2' end as read, {cycle} as cycle, {state} as m from {rows})
select read, cast(cycle as int) as cycle, count(*) filter (m) as meth, count(*) filter (not m) as unmeth, count(*) as coverage, round_even(count(*) filter (m) / count(*), 6) as rate
from cyc where m is not null and cycle between 1 and 60 group by 1, 2 having count(*) > 5"""
_CYCLE = "case when flag & 16 <> 0 then n - q else q + 1 end"


@query(_BASES + _MBIAS.format(cycle=f"case when flag & 64 <> 0 then 60 - n + q + 1 else {_CYCLE} end", rows="near where context = 'CG'",
       state="case when b0 || b1 in ('TG', 'CA') then true when b0 || b1 = 'CG' then false end"))
def mbias(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sites.mbias(_at(spark, sf_dir, sites.cg_places), max_cycle=60, right_align=True, min_coverage=5)


@query(_BASES + """, two as (select b.*, true as top from bases b join rs using (contig, pos) where context = 'CG'
  union all select b.*, false from bases b join rs on b.contig = rs.contig and b.pos = rs.pos + 1 where context = 'CG'),
  st as (select *, seq[q + 1] as b0 from two where (flag in (99, 147)) = top)""" + _MBIAS.format(cycle=_CYCLE, rows="st",
       state="case when top then case b0 when 'C' then true when 'T' then false end else case b0 when 'G' then true when 'A' then false end end"))
def mbias_by_strand(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sites.mbias_by_strand(_at(spark, sf_dir, sites.strand_places), max_cycle=60, min_coverage=5)


#: The reference's longest cycle: the queries above stop at 60 and leave out the bases of longer reads.
MAX_CYCLE = 150
_MBIAS_ALL = _MBIAS.replace("between 1 and 60", f"between 1 and {MAX_CYCLE}")


@query(_BASES + _MBIAS_ALL.format(cycle=f"case when flag & 64 <> 0 then {MAX_CYCLE} - n + q + 1 else {_CYCLE} end", rows="near where context = 'CG'",
       state="case when b0 || b1 in ('TG', 'CA') then true when b0 || b1 = 'CG' then false end"))
def mbias_all_cycles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sites.mbias(_at(spark, sf_dir, sites.cg_places), max_cycle=MAX_CYCLE, right_align=True, min_coverage=5)


@query(SQL["mbias_by_strand"].replace("between 1 and 60", f"between 1 and {MAX_CYCLE}"))
def mbias_by_strand_all_cycles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sites.mbias_by_strand(_at(spark, sf_dir, sites.strand_places), max_cycle=MAX_CYCLE, min_coverage=5)


_SPANS = _REF + ", spans as (select contig, lead(pos, 3) over (partition by contig order by pos) - pos + 1 as span from rs where context = 'CG'), sp as (select * from spans where span is not null)"


def _spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sites.cpg_spans(sites.reference_sites(adapters.chunk_reference(spark, sf_dir)).where("context = 'CG'"), 4)


@query(_SPANS + "select * from sp")
def cpg_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _spans(spark, sf_dir)


_CTX = "with " + COV_SQL + """, v as (select context, cast(meth as double) as x from cov),
q as (select context, quantile_cont(x, [0.25, 0.75]) as q, count(*) as n from v group by 1),
kept as (select v.context, x from v join q using (context) where n < 4 or q[2] - q[1] <= 0 or x between q[1] - 1.5 * (q[2] - q[1]) and q[2] + 1.5 * (q[2] - q[1]))"""


def _kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sites.without_outliers(adapters.coverage(spark, sf_dir).select("context", F.col("meth").cast("double").alias("x")), "context", "x")


@query(_CTX + "select context, count(*) as n, min(x) as least, avg(x) as mean, quantile_cont(x, 0.5) as median, max(x) as greatest from kept group by 1")
def value_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sites.value_summary(_kept(spark, sf_dir), "context", "x")


@query(_CTX + """, e as (select min(x) as lo, max(x) as hi, (max(x) - min(x)) / 80 as w from kept), b as (select context, cast(least(floor((x - lo) / w), 79) as int) as bin, count(*) as n from kept cross join e group by 1, 2)
  select c.context, cast(g as int) as bin, lo + g * w as low, case when g = 79 then hi else lo + g * w + w end as high, coalesce(n, 0) as n
  from (select distinct context from kept) c cross join (select unnest(range(80)) as g) cross join e left join b on b.context = c.context and b.bin = g""")  # fmt: skip
def value_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sites.histogram(_kept(spark, sf_dir), "context", "x")


# --- regions: filter, profile, smooth, scan and matrix over windows given by parts -----------------------------

_REGIONS = ", regions as (select p_partkey as region, 'chr' || (1 + p_partkey % 7) as contig, p_partkey as start, p_partkey + p_size as \"end\", case when p_size % 2 = 0 then '+' else '-' end as strand from part)"


def _regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(
        key.alias("region"), F.concat(F.lit("chr"), (1 + key % 7).cast("string")).alias("contig"), key.alias("start"), (key + F.col("p_size")).alias("end"),
        F.when(F.col("p_size") % 2 == 0, "+").otherwise("-").alias("strand"),
    )


@query("with " + COV_SQL + ", k as (select spot from cov where meth + unmeth > 0 group by 1 having count(*) >= 600) select cov.* from cov join k using (spot)")
def spots_with_enough_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sites.enough_sites(adapters.coverage(spark, sf_dir), 600)


@query("with " + COV_SQL + _REGIONS + """ select region, spot, cast(sum(meth) as bigint) as meth, cast(sum(meth + unmeth) as bigint) as cov, cast(sum(meth) as bigint) / cast(sum(meth + unmeth) as bigint) as frac
  from cov join regions r on r.contig = cov.contig and pos >= start and pos < r."end" group by 1, 2 having sum(meth + unmeth) > 0""")  # fmt: skip
def region_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sites.region_matrix(adapters.coverage(spark, sf_dir), _regions(spark, sf_dir))


@query("with " + COV_SQL + _REGIONS + """ select cast(floor(case when strand = '-' then r."end" - 1 - pos else pos - start end / 5) * 5 as bigint) as "offset", count(*) as n, cast(round(avg(meth / (meth + unmeth)) * 1e6) as bigint) as mean_frac
  from cov join regions r on r.contig = cov.contig and pos >= start and pos < r."end" where meth + unmeth > 0 group by 1""")  # fmt: skip
def region_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(sites.region_profile(adapters.coverage(spark, sf_dir), _regions(spark, sf_dir), 5), "mean_frac")


@query("with " + COV_SQL + """, s as (select contig, pos, sum(meth) as m, sum(unmeth) as u from cov group by 1, 2 having sum(meth + unmeth) > 0)
  select contig, pos, cast(round(sum(m / (m + u) * ln(1 + m + u)) over w / sum(ln(1 + m + u)) over w * 1e6) as bigint) as smooth from s window w as (partition by contig order by pos range between 50 preceding and 50 following)""")  # fmt: skip
def smoothed_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(sites.smoothed(adapters.coverage(spark, sf_dir), 50, True), "smooth")


@query("with " + COV_SQL + """, k as (select spot, contig, unnest(range(greatest(cast(floor((pos - 100) / 50) as bigint) + 1, 0), pos // 50 + 1)) as k, meth, unmeth from cov),
  f as (select spot, contig, k, cast(sum(meth) as bigint) / cast(sum(meth + unmeth) as bigint) as frac from k group by 1, 2, 3), v as (select contig, k, var_samp(frac) as v from f group by 1, 2 having count(*) > 1),
  c as (select * from v where v >= (select quantile_cont(v, 0.9) from v)), w as (select contig, k * 50 as s, k * 50 + 100 as e, v from c),
  r as (select *, max(e) over (partition by contig order by s rows between unbounded preceding and 1 preceding) as reach from w),
  i as (select *, sum(case when s <= reach then 0 else 1 end) over (partition by contig order by s) as i from r)
  select contig, cast(min(s) as bigint) as start, cast(max(e) as bigint) as "end", cast(round(max(v) * 1e6) as bigint) as variance from i group by contig, i""")  # fmt: skip
def variable_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(sites.variable_regions(adapters.coverage(spark, sf_dir), 100, 50, 0.1), "variance")


_CHAIN = """, strong as (select spot from cov where meth + unmeth > 0 group by 1 having count(*) >= 550), kcov as (select cov.* from cov join strong using (spot)),
  k as (select spot, contig, unnest(range(greatest(cast(floor((pos - 100) / 50) as bigint) + 1, 0), pos // 50 + 1)) as k, meth, unmeth from kcov),
  f as (select spot, contig, k, cast(sum(meth) as bigint) / cast(sum(meth + unmeth) as bigint) as frac from k group by 1, 2, 3), v as (select contig, k, var_samp(frac) as v from f group by 1, 2 having count(*) > 1),
  c as (select * from v where v >= (select quantile_cont(v, 0.9) from v)), w as (select contig, k * 50 as s, k * 50 + 100 as e, v from c),
  r as (select *, max(e) over (partition by contig order by s rows between unbounded preceding and 1 preceding) as reach from w),
  i as (select *, sum(case when s <= reach then 0 else 1 end) over (partition by contig order by s) as i from r),
  g as (select contig || ':' || min(s) as region, contig, cast(min(s) as bigint) as start, cast(max(e) as bigint) as "end" from i group by contig, i)"""


@query("with " + COV_SQL + _CHAIN + """ select region, g.contig, start, g."end", spot, cast(sum(meth) as bigint) as meth, cast(sum(meth + unmeth) as bigint) as cov, cast(sum(meth) as bigint) / cast(sum(meth + unmeth) as bigint) as frac
  from kcov join g on g.contig = kcov.contig and pos >= start and pos < g."end" group by 1, 2, 3, 4, 5 having sum(meth + unmeth) > 0""")  # fmt: skip
def region_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Filter, scan and matrix in one: the regions are found, since none are given."""
    return sites.region_chain(adapters.coverage(spark, sf_dir), 550, 100, 50, 0.1)


# --- reads -------------------------------------------------------------------------------------------------


_DEMUX = _GOOD + """,
wl as (select distinct upper(trim(barcode)) as bc from barcode_whitelist where trim(barcode) <> ''),
lk as (select upper(seq)[11:28] as l, count(*) as n from good where length(upper(seq)[11:28]) = 18 group by 1 order by n desc, l limit 1),
u as (select row_id, name, seq, qual, upper(seq) as s, (select l from lk) as l from good),
w as (select *, least(length(s), 90) - 18 as hi from u where length(s) >= 38),
st as (select row_id, unnest(range(0, hi + 1)) as i from w),
di as (select row_id, i, hamming(s[i + 1:i + 18], l) as d from st join w using (row_id)),
found as (select row_id, coalesce(min(i) filter (d = 0), min(i) filter (d <= 1)) as i from di group by 1),
cut as (select u.*, a.i, a.i >= 10 and a.i + 28 <= length(s) as fits, s[a.i - 9:a.i] as b, s[a.i + 19:a.i + 28] as a from u left join found a using (row_id)),
near as (select obs, bc, hamming(obs, bc) as d from (select a as obs from cut where fits union select b from cut where fits) o cross join wl),
res as (select obs, case when min(d) <= 1 and count(*) filter (d = m) = 1 then min(bc) filter (d = m) end as bc from (select *, min(d) over (partition by obs) as m from near) group by obs),
dm as (select row_id, name, seq, qual, i, ra.bc as a, rb.bc as b, case when length(s) < 38 then 'short_r1' when i is null then 'linker2_not_found' when not fits then 'out_of_bounds'
  when ra.bc is null then 'barcode1_not_in_whitelist' when rb.bc is null then 'barcode2_not_in_whitelist' else 'kept' end as reason
  from cut left join res ra on ra.obs = cut.a and fits left join res rb on rb.obs = cut.b and fits)"""


def _demuxed(spark: SparkSession, sf_dir: str, indels: bool = False) -> DataFrame:
    layout = reads.Layout(adapters.linker(spark, sf_dir), indels=indels)
    return reads.demultiplex(adapters.fastq(spark, sf_dir), adapters.listed(spark, sf_dir), layout)


@query(_DEMUX + """ select row_id, reason, case when reason = 'kept' then b end as barcode_b, case when reason = 'kept' then a end as barcode_a,
  case when reason = 'kept' then '@' || b || a || ':' || name[2:] else name end as name, case when reason = 'kept' then seq[i + 29:] else seq end as seq, case when reason = 'kept' then qual[i + 29:] else qual end as qual from dm""")  # fmt: skip
def demultiplexed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _demuxed(spark, sf_dir)


@query()
def demultiplexed_with_indels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _demuxed(spark, sf_dir, True)


_REASONS = ", ".join(f"count(*) filter (reason = '{r}') as {r}" for r in ("short_r1", "linker2_not_found", "tn5_not_found", "barcode1_not_in_whitelist", "barcode2_not_in_whitelist"))


@query(_DEMUX + " select count(*) as total_reads, count(*) filter (reason = 'kept') as kept_reads, count(*) filter (reason in ('linker2_not_found', 'out_of_bounds')) as structure_mismatch, " + _REASONS + " from dm")
def demux_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reads.demux_stats(_demuxed(spark, sf_dir))


@query("with wl as (select distinct upper(trim(barcode)) as bc from barcode_whitelist where trim(barcode) <> ''), o as (select distinct upper(trim(barcode))[1:10] as seen from spot_counts where length(trim(barcode)) = 20), "
       "d as (select seen, bc, hamming(seen, bc) as d from o cross join wl), m as (select *, min(d) over (partition by seen) as m from d) "
       "select seen, min(bc) as barcode, cast(min(d) as int) as distance from m where d = m and m <= 1 group by seen having count(*) = 1")  # fmt: skip
def whitelist_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen = table(spark, sf_dir, "spot_counts").select(F.upper(F.trim("barcode")).alias("b")).where(F.length("b") == 20).select(F.substring("b", 1, 10).alias("seen")).distinct()
    return seen.join(reads.neighbourhood(table(spark, sf_dir, "barcode_whitelist"), 1), "seen")


# both barcodes of a spot: letters 1 to 10 and 11 to 20
@query("with wl as (select distinct upper(trim(barcode)) as bc from barcode_whitelist where trim(barcode) <> ''), b as (select distinct upper(trim(barcode)) as b from spot_counts where length(trim(barcode)) = 20), "
       "o as (select b[1:10] as seen from b union select b[11:20] from b), d as (select seen, bc, hamming(seen, bc) as d from o cross join wl), m as (select *, min(d) over (partition by seen) as m from d) "
       "select seen, min(bc) as barcode, cast(min(d) as int) as distance from m where d = m and m <= 1 group by seen having count(*) = 1")  # fmt: skip
def whitelist_nearest_halves(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = table(spark, sf_dir, "spot_counts").select(F.upper(F.trim("barcode")).alias("b")).where(F.length("b") == 20)
    seen = b.select(F.explode(F.array(F.substring("b", 1, 10), F.substring("b", 11, 10))).alias("seen")).distinct()
    return seen.join(reads.neighbourhood(table(spark, sf_dir, "barcode_whitelist"), 1), "seen")


_HITS = _GOOD + ", m as (select row_id, seq, len(regexp_extract_all(upper(seq), 'GG[CT]')) as k from good)"


def _upper(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapters.fastq(spark, sf_dir).withColumn("seq", F.upper("seq"))


@query(_HITS + " select count(*) as n_scanned, count(*) filter (length(seq) >= 3 and k = 1) as n_hit, count(*) filter (length(seq) >= 3 and k = 0) as n_none, count(*) filter (length(seq) >= 3 and k > 1) as n_ambiguous, count(*) filter (length(seq) < 3) as n_too_short from m")
def motif_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reads.motif_status(_upper(spark, sf_dir), MOTIF)


@query(_HITS + ", h as (select regexp_extract(upper(seq), 'GG[CT]')[3] as b from m where k = 1) select 2 as site, count(*) filter (b = 'C') as retained, count(*) filter (b = 'T') as converted, count(*) filter (b not in ('C', 'T')) as other, count(*) filter (b = 'T') / count(*) filter (b in ('C', 'T')) * 100 as rate from h")
def motif_conversion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reads.site_conversion(_upper(spark, sf_dir), MOTIF, [2])


#: Where a linker may end: its last begin, and its length.
_LINKER_END = reads.ANCHOR_SPAN + 28
_LINKER = _GOOD + f""",
lk as (select upper(seq)[11:28] as l, count(*) as n from good where length(upper(seq)[11:28]) = 18 group by 1 order by n desc, l limit 1),
win as (select row_id, upper(seq) as s, unnest(range(10, least(length(seq), {_LINKER_END}) - 17)) as p from good where length(seq) >= 28),
off as (select row_id, s, p, l, len(list_filter(range(1, 19), lambda k: l[k] <> 'C' and s[p + k] <> l[k])) as d from win cross join lk),
best as (select *, min(d) over (partition by row_id) as m from off),
spot as (select row_id, any_value(s) as s, any_value(l) as l, min(p) as p from best where d = m and m <= 1 group by row_id having count(*) = 1)"""


@query(_LINKER + """, shown as (select s[p + 4] || s[p + 7] || s[p + 11] as three, l[4] || l[7] || l[11] as ref from spot),
  used as (select list_filter([1, 2, 3], lambda i: ref[i] = 'C') as picks, three from shown),
  n as (select len(list_filter(picks, lambda i: three[i] = 'T')) as t, len(list_filter(picks, lambda i: three[i] = 'C')) as c, len(picks) as k from used)
  select count(*) as scored_reads, cast(round(avg(case when t + c > 0 then t / (t + c) end) * 1e6) as bigint) as mean_rate_fraction, cast(round(count(*) filter (t = k) / count(*) * 1e6) as bigint) as all_t_fraction from n""")  # fmt: skip
def linker_conversion(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = adapters.fastq(spark, sf_dir)
    return _rounded(reads.linker_conversion(rows, adapters.linker(spark, sf_dir), 10, _LINKER_END, 1), "mean_rate_fraction", "all_t_fraction")


@query(_LINKER + """, cs as (select s, p, l, unnest(list_filter(range(0, 18), lambda k: l[k + 1] = 'C')) as site from spot)
  select cast(site as int) as site, count(*) filter (s[p + site + 1] = 'T') as n_t, count(*) filter (s[p + site + 1] = 'C') as n_c, count(*) filter (s[p + site + 1] not in ('T', 'C')) as n_other from cs group by 1""")  # fmt: skip
def linker_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts behind the linkers' conversion, for each of their Cs."""
    return reads.linker_sites(adapters.fastq(spark, sf_dir), adapters.linker(spark, sf_dir), 10, _LINKER_END, 1)


_UMI = _GOOD + """,
wl as (select distinct upper(trim(barcode)) as bc from barcode_whitelist where trim(barcode) <> ''),
lk as (select upper(seq)[11:28] as l, count(*) as n from good where length(upper(seq)[11:28]) = 18 group by 1 order by n desc, l limit 1),
u as (select row_id, seq as s, qual, l from good cross join lk),
win as (select row_id, unnest(range(0, length(s) - 17)) as i from u where length(s) >= 18),
di as (select row_id, i, hamming(s[i + 1:i + 18], l) as d from win join u using (row_id)),
found as (select row_id, coalesce(min(i) filter (d = 0), min(i) filter (d <= 1)) as i from di group by 1),
cut as (select u.*, i, case when i >= 10 then s[i - 9:i] end as b, s[i + 19:i + 28] as a from u left join found using (row_id)),
near as (select obs, bc, hamming(obs, bc) as d from (select a as obs from cut union select b from cut) o cross join wl where length(obs) = 10),
res as (select obs, case when min(d) <= 1 and count(*) filter (d = m) = 1 then min(bc) filter (d = m) end as bc from (select *, min(d) over (partition by obs) as m from near) group by obs),
halves as (select cut.*, ra.bc as na, rb.bc as nb, s[i + 30:i + 37] as umi, qual[i + 30:i + 37] as own from cut left join res ra on ra.obs = a left join res rb on rb.obs = b),
told as (select *, case when i is null then 'linker_not_found' when nb is null then 'bad_barcode2' when na is null then 'bad_barcode1' when s[i + 29:i + 29] <> 'G' then 'umi_left_not_found' when length(umi) < 8 then 'umi_too_short' else 'kept' end as reason from halves)"""


@query(_UMI + " select row_id, reason, case when reason = 'kept' then nb || na || umi end as seq, case when reason = 'kept' then repeat('I', 20) || own end as qual from told")
def umi_demultiplexed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reads.demultiplex_umi(adapters.fastq(spark, sf_dir), adapters.listed(spark, sf_dir), adapters.linker(spark, sf_dir), "G", 8)


#: A short anchor, which many reads lack or have twice.
_ANCHOR = "ACGTC"
_DEMUX_PAIRS = _DEMUX.replace("length(s) >= 38", "length(s) >= 43").replace("length(s) < 38", "length(s) < 43").replace("when ra.bc is null then", "when z.p is null then 'tn5_not_found' when ra.bc is null then").replace(
    "from cut left join res ra", "from cut left join seed z using (row_id) left join res ra"
).replace("dm as (select row_id, name, seq, qual, i,", f"""an as (select row_id, s, i + 28 as e, unnest(range(i + 28, least(length(s), i + 68) - 4)) as p from cut where fits),
ad as (select row_id, p, hamming(s[p + 1:p + 5], '{_ANCHOR}') as d from an), am as (select *, min(d) over (partition by row_id) as m from ad),
seed as (select row_id, min(p) as p from am where d = m and m <= 1 group by 1 having count(*) = 1),
dm as (select row_id, name, seq, qual, z.p as ins,""")  # fmt: skip


@query(_DEMUX_PAIRS + """ select row_id, reason, case when reason = 'kept' then b || a end as spot, case when reason = 'kept' then '@' || b || a || ':' || name[2:] else name end as name,
  case when reason = 'kept' then seq[ins + 6:] else seq end as seq, case when reason = 'kept' then qual[ins + 6:] else qual end as qual,
  case when reason = 'kept' then '@' || b || a || ':' || name[2:] else name end as mate_name, reverse(seq) as mate_seq, reverse(qual) as mate_qual from dm""")  # fmt: skip
def demultiplexed_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of reads with an anchor; the spot is read back from the names."""
    layout = reads.Layout(adapters.linker(spark, sf_dir), _ANCHOR, indels=False)
    rows = adapters.fastq(spark, sf_dir)
    pairs = rows.withColumn("r2", F.struct("name", F.reverse("seq").alias("seq"), "plus", F.reverse("qual").alias("qual")))
    found = reads.demultiplex(pairs, adapters.listed(spark, sf_dir), layout)
    mate = [F.col(f"r2.{c}").alias(f"mate_{c}") for c in ("name", "seq", "qual")]
    return found.select("row_id", "reason", F.when(F.col("reason") == "kept", name_spot("name")).alias("spot"), "name", "seq", "qual", *mate)


@query(_DEMUX_PAIRS + " select count(*) as total_reads, count(*) filter (reason = 'kept') as kept_reads, count(*) filter (reason in ('linker2_not_found', 'out_of_bounds', 'tn5_not_found')) as structure_mismatch, " + _REASONS + " from dm")
def demux_reasons_with_anchor(spark: SparkSession, sf_dir: str) -> DataFrame:
    layout = reads.Layout(adapters.linker(spark, sf_dir), _ANCHOR, indels=False)
    return reads.demux_stats(reads.demultiplex(adapters.fastq(spark, sf_dir), adapters.listed(spark, sf_dir), layout))


# --- formats -----------------------------------------------------------------------------------------------


@query("select event_type, count(*) as n, cast(coalesce(sum(try_cast(props ->> '$.k' as bigint)), 0) as bigint) as k, count(*) filter (props ->> '$.k' is null) as missing from events group by 1")
def json_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = first_json(F.col("props"), "$.summary.k", "$.k")
    return table(spark, sf_dir, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(as_int(k)), F.lit(0)).alias("k"), F.count_if(k.isNull()).alias("missing"))


@query(r"""with c as (select distinct file_id, content from meth_stats_files), l as (select file_id, unnest(string_split_regex(content, '\r\n|\n|\r')[2:]) as line from c), f as (select file_id, unnest(string_split(line, chr(9))[2:]) as cell from l where trim(line) <> '')
  select file_id, count(*) as cells, count(case when isfinite(try_cast(trim(cell) as double)) then 1 end) as numbers, cast(coalesce(sum(case when isfinite(try_cast(trim(cell) as double)) then trunc(try_cast(trim(cell) as double)) end), 0) as bigint) as whole from f group by 1""")  # fmt: skip
def tolerant_casts(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = drift.read_files(table(spark, sf_dir, "meth_stats_files").withColumnRenamed("sample_id", "grp"))
    cells = parsed.select("file_id", F.explode("rows").alias("r")).select("file_id", F.explode(F.slice("r", 2, F.size("r"))).alias("cell"))
    return cells.groupBy("file_id").agg(F.count(F.lit(1)).alias("cells"), F.count(as_float(F.col("cell"))).alias("numbers"), F.coalesce(F.sum(as_int(F.col("cell"))), F.lit(0)).alias("whole"))
