"""Operators on spots of the array: read counts, funnel, thresholds, statistics and summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.bases import PAIRED_FLAGS, confident
from ..functions.numbers import formatted
from ..functions.text import spot_key

#: Defaults of the knee search (fixed values).
MIN_READS, SMOOTH, SKIP_TOP, SKIP_BOTTOM, STEEP = 10, 51, 0.05, 0.10, 0.5
BROADCAST_BARCODES = 100_000


def whitelist(df: DataFrame, barcode: str = "barcode") -> DataFrame:
    """``barcode, idx``: the listed barcodes in upper case, each once with its first index; nulls and blanks are left out."""
    rows = df.select(spot_key(barcode).alias("barcode"), F.col("idx").cast("int").alias("idx")).where("barcode <> ''")
    return rows.groupBy("barcode").agg(F.min("idx").alias("idx"))


def on_array(df: DataFrame, listed: DataFrame, length: int, spot: str = "spot") -> DataFrame:
    """``df`` with only the spots of which both halves, each of ``length`` letters, are listed.

    ``spot`` is trimmed and upper-cased. The list is an array's barcodes, so it's small; the hint is given only
    after its size is checked.
    """
    small = F.broadcast(listed) if listed.limit(BROADCAST_BARCODES + 1).count() <= BROADCAST_BARCODES else listed
    codes = small.select(F.col("barcode").alias("_half"))
    rows = df.withColumn(spot, spot_key(spot)).where(F.length(spot) == 2 * length)
    for half in (F.substring(spot, 1, length), F.substring(spot, length + 1, length)):
        rows = rows.join(codes, half == F.col("_half"), "left_semi")
    return rows


def pairs_of(listed: DataFrame) -> DataFrame:
    """``spot``: every listed barcode before every listed one, the array's spots (a list's square, so for an array's list only)."""
    codes = listed.select("barcode").agg(F.sort_array(F.collect_set("barcode")).alias("all"))
    halves = codes.select("all", F.explode("all").alias("b")).select("b", F.explode("all").alias("a"))
    return halves.select(F.concat("b", "a").alias("spot"))


def expanded_whitelist(listed: DataFrame, observed: DataFrame) -> DataFrame:
    """``spot``: the listed barcodes that are observed as spots; if there are none, the pairs of listed ones that are."""
    seen = observed.select("spot").distinct()
    direct = listed.select(F.col("barcode").alias("spot")).join(seen, "spot", "left_semi")
    return direct if not direct.isEmpty() else pairs_of(listed).join(seen, "spot", "left_semi")


def read_counts(df: DataFrame, *by: str, reads: str = "reads") -> DataFrame:
    """Records and reads per spot and ``by``; null reads count as records only."""
    return df.groupBy(*by, "spot").agg(F.count(F.lit(1)).alias("n_records"), F.coalesce(F.sum(reads), F.lit(0)).alias("reads"))


def funnel(alignments: DataFrame, mito: list[str], *by: str) -> DataFrame:
    """Records, confidently mapped and valid ones, and the valid ones on and off ``mito`` contigs.

    ``alignments`` has ``flag, mapq, hits, contig``. Valid is confidently mapped with one of the four flags of
    proper pairs; a null contig is not mitochondrial.
    """
    ok = confident(F.col("flag"), F.col("mapq"), F.col("hits"))
    valid = ok & F.col("flag").isin(PAIRED_FLAGS)
    on_mito = F.coalesce(F.col("contig").isin(mito), F.lit(False))
    return alignments.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_records"),
        F.count_if(ok).alias("mapped_reads"),
        F.count_if(valid).alias("valid_reads"),
        F.count_if(valid & on_mito).alias("valid_mito"),
        F.count_if(valid & ~on_mito).alias("valid_nuclear"),
    )


def counts_and_funnel(alignments: DataFrame, mito: list[str]) -> DataFrame:
    """Per spot its records and its part of the funnel, from one scan; ``total_funnel`` adds the parts up."""
    return funnel(alignments, mito, "spot")


def total_funnel(per_spot: DataFrame) -> DataFrame:
    """The funnel of all spots together."""
    names = ["n_records", "mapped_reads", "valid_reads", "valid_mito", "valid_nuclear"]
    return per_spot.agg(*(F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names))


def top_spots(counts: DataFrame, n: int = 16) -> DataFrame:
    """The ``n`` spots with most reads, equal ones by name."""
    return counts.orderBy(F.desc("reads"), "spot").limit(n)


def rank_curve(counts: DataFrame, grp: str, min_reads: float = MIN_READS) -> DataFrame:
    """``grp, spot, reads, rk, n``: spots with more than ``min_reads`` reads, ranked within their group by reads, then name."""
    w = Window.partitionBy(grp)
    return counts.where(F.col("reads") > min_reads).select(
        grp, "spot", "reads", F.row_number().over(w.orderBy(F.desc("reads"), "spot")).alias("rk"), F.count(F.lit(1)).over(w).alias("n")
    )


def slopes(curve: DataFrame, grp: str, window: int = SMOOTH) -> DataFrame:
    """``curve`` with ``smooth``, the edge-padded rolling mean of log10(reads + 1), and ``slope``, its central difference.

    The window shrinks to the greatest odd number up to the group's size. A group has at most one row per spot.
    """
    n, rk = F.col("n"), F.col("rk")
    width = F.when(n > window, F.lit(window)).otherwise(F.when(n % 2 == 1, n).otherwise(F.greatest(n - 1, F.lit(1))))
    half = (width - 1) / 2
    rows = curve.withColumn("y", F.log10(F.col("reads") + 1)).withColumn("half", half)
    reach = window // 2  # ranks are stretched so that half a window always spans this far
    rows = rows.withColumn("x", rk * F.when(F.col("half") > 0, reach / F.col("half")).otherwise(float(reach + 1)))
    frame = f"sum(y) over (partition by {grp} order by x range between {reach}.5D preceding and {reach}.5D following)"
    w = Window.partitionBy(grp).orderBy("rk")
    every = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    pad_left = F.greatest(F.col("half") + 1 - rk, F.lit(0.0)) * F.first("y").over(every)
    pad_right = F.greatest(rk + F.col("half") - n, F.lit(0.0)) * F.last("y").over(every)
    rows = rows.withColumn("smooth", (F.expr(frame) + pad_left + pad_right) / (2 * F.col("half") + 1))
    after, before, z = F.lead("smooth").over(w), F.lag("smooth").over(w), F.col("smooth")
    slope = F.when(rk == 1, after - z).when(rk == n, z - before).otherwise((after - before) * 0.5)
    return rows.withColumn("slope", slope).drop("x", "half")


def knee(counts: DataFrame, grp: str) -> DataFrame:
    """``grp, threshold, knee_rank, exclude_start, exclude_end``: the reads at the leftmost rank that is half as steep as the steepest.

    The top 5 % and the bottom 10 % of the ranks are not searched. Groups with fewer than two spots over the
    least reads, or fewer than two to search, have no row.
    """
    found = slopes(rank_curve(counts, grp), grp)
    start, end = F.floor(F.col("n") * SKIP_TOP), F.col("n") - F.floor(F.col("n") * SKIP_BOTTOM)
    searched = found.withColumn("exclude_start", start).withColumn("exclude_end", end)
    searched = searched.where("n >= 2 and exclude_end - exclude_start >= 2 and rk > exclude_start and rk <= exclude_end")
    steepest = F.min("slope").over(Window.partitionBy(grp))
    steep = searched.withColumn("steepest", steepest).where(F.col("slope") <= STEEP * F.col("steepest"))
    best = steep.groupBy(grp, "exclude_start", "exclude_end").agg(F.min(F.struct("rk", "reads")).alias("k"))
    return best.select(grp, F.col("k.reads").alias("threshold"), F.col("k.rk").alias("knee_rank"), "exclude_start", "exclude_end")


def knee_marker(curve: DataFrame, thresholds: DataFrame, grp: str) -> DataFrame:
    """``grp, marker_rank``: the first rank with reads at or below the group's threshold."""
    return curve.join(thresholds.select(grp, "threshold"), grp).where("reads <= threshold").groupBy(grp).agg(F.min("rk").alias("marker_rank"))


def high_quality(reads: Column, threshold: Column) -> Column:
    """1 for more reads than the threshold, 0 for others, null if either is missing."""
    return (reads > threshold).cast("int")


def meth_stats(sites: DataFrame, *by: str) -> DataFrame:
    """Per group the mean of the sites' percentages and the number of sites, for CG, CH and each CH context.

    ``sites`` has ``context`` and ``pct``. Any context but CG counts to CH, an unknown one to CH only; a mean of no
    sites is null.
    """
    is_cg = F.col("context") == "CG"
    pick = {"cg": is_cg, "ch": ~is_cg, **{c.lower(): F.col("context") == c for c in ("CA", "CC", "CT")}}
    aggs = [a for k, c in pick.items() for a in (F.avg(F.when(c, F.col("pct"))).alias(f"mean_{k}"), F.count_if(c & F.col("pct").isNotNull()).alias(f"n_{k}"))]
    return sites.groupBy(*by).agg(*aggs)


def merged_stats(parts: DataFrame, *by: str) -> DataFrame:
    """Statistics of parts (``mean_*`` and ``n_*``) merged: the means weighted by their sites, the sites added."""
    keys = [c[5:] for c in parts.columns if c.startswith("mean_")]
    aggs = [(F.sum(F.col(f"mean_{k}") * F.col(f"n_{k}")) / F.nullif(F.sum(f"n_{k}"), F.lit(0))).alias(f"mean_{k}") for k in keys]
    return parts.groupBy(*by).agg(*aggs, *(F.sum(f"n_{k}").alias(f"n_{k}") for k in keys))


def positions(df: DataFrame) -> DataFrame:
    """``spot, array_row, array_col`` by the last line of each barcode; lines without a barcode or a place are left out."""
    rows = df.select(spot_key("barcode").alias("spot"), "line_no", "array_row", "array_col").where("spot <> '' and array_row is not null and array_col is not null")
    last = rows.groupBy("spot").agg(F.max(F.struct("line_no", "array_row", "array_col")).alias("p"))
    return last.select("spot", "p.array_row", "p.array_col")


def spot_summary(stats: DataFrame, reads: DataFrame, places: DataFrame, *by: str) -> DataFrame:
    """Statistics and reads of all spots that have either, with their places on the array."""
    return stats.join(reads, [*by, "spot"], "full").join(places, "spot", "left")


def grid(values: DataFrame, rows: int, cols: int) -> DataFrame:
    """``array_row, array_col, value``: every place of the array, null where no spot has a value (``values`` has one row per place)."""
    one = values.sparkSession.range(1).select(F.explode(F.sequence(F.lit(0), F.lit(rows - 1))).alias("array_row"))
    places = one.select("array_row", F.explode(F.sequence(F.lit(0), F.lit(cols - 1))).alias("array_col"))
    return places.join(values.select("array_row", "array_col", "value"), ["array_row", "array_col"], "left")


def subsample(df: DataFrame, name: str, fraction: float, seed: int = 11) -> DataFrame:
    """The rows whose name falls into ``fraction`` by its hash, so that mates stay together; null names never do."""
    part = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.col(name).cast("string"))), 1, 8), 16, 10).cast("long")
    return df.where(part < int(fraction * (1 << 32)))


def selected(df: DataFrame, roster: DataFrame | None = None, skip: DataFrame | None = None) -> DataFrame:
    """The rows of spots that are on the roster, if there is one, and not to be skipped; a null spot is on no roster."""
    rows = df.where("spot is not null")
    rows = rows if roster is None else rows.join(roster.select("spot").distinct(), "spot", "left_semi")
    return rows if skip is None else rows.join(skip.select("spot").distinct(), "spot", "left_anti")


def only_contigs(df: DataFrame, known: DataFrame, wanted: list[str]) -> DataFrame:
    """The rows on the wanted contigs; one that isn't among the known ones is an error."""
    missing = set(wanted) - {r.contig for r in known.where(F.col("contig").isin(wanted)).select("contig").distinct().collect()}
    if missing:
        raise ValueError(f"unknown contigs: {', '.join(sorted(missing))}")
    return df.where(F.col("contig").isin(wanted))


def random_spots(counts: DataFrame, n: int = 16, seed: int = 11) -> DataFrame:
    """``n`` spots drawn by a hash of their name and the seed, the same in every run."""
    return counts.withColumn("_h", F.md5(F.concat(F.lit(f"{seed}:"), "spot"))).orderBy("_h", "spot").limit(n).drop("_h")


def resumed_stats(new: DataFrame, prior: DataFrame, *by: str) -> DataFrame:
    """Statistics of all spots of either run: the new ones where there are any, else those of the earlier run."""
    keys = [*by, "spot"]
    kept = prior.join(new.select(*keys).distinct(), keys, "left_anti")
    return new.unionByName(kept.select(*new.columns))


def capped_fraction(requested: float, mapped: int, most: int = 10_000_000) -> float:
    """The fraction to keep so that no more than ``most`` of ``mapped`` reads stay."""
    return min(requested, most / mapped) if mapped else requested


def roster_stats(roster: DataFrame, stats: DataFrame) -> DataFrame:
    """The statistics of each spot of ``roster`` (``spot, ord``), in its order; a spot without any has nulls.

    A spot that is listed several times counts where it's listed first; spots off the roster are left out.
    """
    first = roster.where("spot is not null").groupBy("spot").agg(F.min("ord").alias("ord"))
    return first.join(stats, "spot", "left").orderBy("ord")


def weighted_means(stats: DataFrame, pairs: dict[str, str], *by: str) -> DataFrame:
    """Per ``by`` the means of spots (``pairs``' keys), as written to two places, weighted by their sites (its values), and
    ``median_<sites>`` over the spots; spots without a mean or sites don't count, and with none left there is a null."""
    aggs = []
    for mean, sites in pairs.items():
        counts = F.col(mean).isNotNull() & (F.col(sites) > 0)
        weighted = F.sum(F.when(counts, F.bround(F.col(mean), 2) * F.col(sites)))
        aggs += [(weighted / F.sum(F.when(counts, F.col(sites)))).alias(mean), F.percentile(F.when(counts, F.col(sites)), 0.5).alias(f"median_{sites}")]
    return stats.groupBy(*by).agg(*aggs)


def sample_report(totals: DataFrame, means: DataFrame, key: str, counts: list[str], rates: dict[str, tuple[str, str]], shown: list[str]) -> DataFrame:
    """One row of text per sample that has ``totals`` or ``means``: ``key``, ``counts`` with commas, ``rates`` (name: part, whole) as
    ``12.34%``, and the values ``shown`` to two places; what isn't known, and a rate of nothing, is ``NA``."""
    rows = totals.join(means, key, "full")
    rate = lambda part, whole: F.when(F.col(whole) > 0, F.col(part) / F.col(whole) * 100)
    text = lambda c: F.when(c.isNull(), "NA").otherwise(F.concat(formatted(".2f")(c), F.lit("%")))
    return rows.select(
        key, *(formatted(",")(F.col(c)).alias(c) for c in counts), *(text(rate(*r)).alias(n) for n, r in rates.items()), *(formatted(".2f")(F.col(c)).alias(c) for c in shown)
    )
