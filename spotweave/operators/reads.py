"""Operators on reads: demultiplexing by barcodes and linkers, conversion of linkers and of spiked-in oligos."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import patterns
from ..functions.text import spot_key
from ..staging import broadcast_if_small, stage

#: Letters of reads; any other is compared as a question mark.
LETTERS = "ACGTN?"
#: A linker is looked for this far behind where it should begin, an anchor's seed within this span.
LINKER_SLACK, ANCHOR_SPAN, SEED = 62, 40, 15
BROADCAST_VARIANTS = 500_000


@dataclass(frozen=True)
class Layout:
    """How a read is built: barcode B, linker, barcode A and, if there is one, the anchor before the insert."""

    linker: str
    anchor: str = ""
    b_length: int = 10
    a_length: int = 10
    pattern_distance: int = 1
    barcode_distance: int = 1
    indels: bool = True


def neighbourhood(listed: DataFrame, distance: int) -> DataFrame:
    """``seen, barcode, distance``: every spelling within ``distance`` mismatches of a listed barcode and the one it stands for.

    A spelling as near to several barcodes stands for none, unless it is one of them. A list of n barcodes of length
    L has at most n (4 L)^distance spellings: a lookup by equality then replaces comparing every read with every
    barcode. The lists differ in this from a search whose outcome depends on the order of the list: nearest means
    nearest here.
    """
    near = listed.select(spot_key("barcode").alias("barcode")).where("barcode <> ''").distinct()
    near = near.select(F.col("barcode").alias("seen"), "barcode", F.lit(0).alias("distance"))
    for d in range(1, distance + 1):
        place = near.withColumn("i", F.explode(F.sequence(F.lit(1), F.length("seen")))).withColumn("ch", F.explode(F.array(*map(F.lit, LETTERS))))
        other = F.concat(F.substr("seen", F.lit(1), F.col("i") - 1), "ch", F.substr("seen", F.col("i") + 1))
        near = near.unionByName(place.select(other.alias("seen"), "barcode", F.lit(d).alias("distance")))
        near = near.groupBy("seen", "barcode").agg(F.min("distance").alias("distance"))
    best = near.groupBy("seen").agg(F.min(F.struct("distance", "barcode")).alias("b"), F.collect_list("distance").alias("all"))
    alone = F.size(F.filter("all", lambda d: d == F.col("b.distance"))) == 1
    return best.where(alone).select("seen", "b.barcode", "b.distance")


def _looked_up(df: DataFrame, near: DataFrame, raw: str, name: str) -> DataFrame:
    seen = df.withColumn("_seen", F.regexp_replace(raw, f"[^{LETTERS[:-1]}]", LETTERS[-1]))
    return seen.join(near.select(F.col("seen").alias("_seen"), F.col("barcode").alias(name)), "_seen", "left").drop("_seen")


def with_linker_place(df: DataFrame, text: str, layout: Layout) -> DataFrame:
    """``df`` with ``_at``, where the linker begins: the first exact place, else the leftmost with few mismatches, else the best with indels."""
    end = F.least(F.length(text), F.lit(layout.b_length + len(layout.linker) + LINKER_SLACK))
    plain = df.withColumn("_at", patterns.leftmost_place(F.col(text), layout.linker, layout.pattern_distance, 0, end))
    if not layout.indels or not layout.pattern_distance:
        return plain
    windows = plain.withColumn("_w", F.when(F.col("_at").isNull(), F.substr(text, F.lit(1), end)))
    return patterns.with_edit_places(windows, "_at", "_w", layout.linker, layout.pattern_distance).drop("_w")


def anchor_end(text: Column, after: Column, layout: Layout) -> Column:
    """Where the insert begins: behind the anchor, found by its last letters in a window behind ``after``."""
    if not layout.anchor:
        return after
    seed = layout.anchor[-SEED:]
    first = after + len(layout.anchor) - len(seed)
    last = F.least(F.length(text), first + ANCHOR_SPAN)
    end = patterns.unique_place(text, seed, layout.pattern_distance, first, last) + len(seed)
    return F.when((end >= len(layout.anchor)) & (end <= F.length(text)), end)


def demultiplex(reads: DataFrame, listed: DataFrame, layout: Layout) -> DataFrame:
    """Every read of ``row_id, name, seq, qual`` with ``reason``, ``barcode_b, barcode_a`` and ``name, seq, qual`` as they go on.

    ``reason`` is the first that holds of ``short_r1``, ``linker2_not_found``, ``out_of_bounds``, ``tn5_not_found``,
    ``barcode1_not_in_whitelist`` and ``barcode2_not_in_whitelist``, or ``kept``. A kept read's name begins with its
    spot, ``@<B><A>:``, and its sequence and qualities begin at the insert; others go on as they came. Barcodes are
    compared in upper case and rescued if exactly one listed one is nearest within the distance. A second mate, the
    struct ``r2`` of read pairs, goes on whole; a kept one's name begins with the spot too.
    """
    least = layout.b_length + len(layout.linker) + layout.a_length + len(layout.anchor)
    near = broadcast_if_small(stage(neighbourhood(listed, layout.barcode_distance), "barcode-spellings"), BROADCAST_VARIANTS)
    rows = reads.withColumn("_u", F.upper("seq")).withColumn("_long", F.least(F.length("seq"), F.length("qual")) >= least)
    rows = with_linker_place(rows.withColumn("_s", F.when(F.col("_long"), F.col("_u"))), "_s", layout)
    a_end = F.col("_at") + len(layout.linker) + layout.a_length
    rows = rows.withColumn("_fits", (F.col("_at") >= layout.b_length) & (a_end <= F.length("_u")))
    rows = rows.withColumn("_insert", F.when(F.col("_fits"), anchor_end(F.col("_u"), a_end, layout)))
    rows = rows.withColumn("_b", F.when(F.col("_fits"), F.substr("_u", F.col("_at") - layout.b_length + 1, F.lit(layout.b_length))))
    rows = rows.withColumn("_a", F.when(F.col("_fits"), F.substr("_u", a_end - layout.a_length + 1, F.lit(layout.a_length))))
    rows = _looked_up(_looked_up(rows, near, "_a", "barcode_a"), near, "_b", "barcode_b")
    reason = (
        F.when(F.coalesce(~F.col("_long"), F.lit(True)), "short_r1")
        .when(F.col("_at").isNull(), "linker2_not_found")
        .when(~F.col("_fits"), "out_of_bounds")
        .when(F.col("_insert").isNull(), "tn5_not_found")
        .when(F.col("barcode_a").isNull(), "barcode1_not_in_whitelist")
        .when(F.col("barcode_b").isNull(), "barcode2_not_in_whitelist")
        .otherwise("kept")
    )
    rows = rows.withColumn("reason", reason)
    kept = F.col("reason") == "kept"
    marked = lambda name: F.concat(F.lit("@"), "barcode_b", "barcode_a", F.lit(":"), F.substr(name, F.lit(2)))
    mate = [F.col("r2").withField("name", F.when(kept, marked(F.col("r2.name"))).otherwise(F.col("r2.name"))).alias("r2")] if "r2" in reads.columns else []
    cut = lambda c: F.when(kept, F.substr(c, F.col("_insert") + 1)).otherwise(F.col(c)).alias(c)
    return rows.select(
        "row_id", "reason", F.when(kept, F.col("barcode_b")).alias("barcode_b"), F.when(kept, F.col("barcode_a")).alias("barcode_a"),
        F.when(kept, marked(F.col("name"))).otherwise(F.col("name")).alias("name"), cut("seq"), cut("qual"), *mate,
    )


def demux_stats(demuxed: DataFrame, *by: str) -> DataFrame:
    """Per ``by`` the reads, the kept ones and how many were rejected for each reason; structure mismatches are counted again as such."""
    count = lambda *r: F.count_if(F.col("reason").isin(*r))
    structure = ("linker2_not_found", "out_of_bounds", "tn5_not_found")
    names = ["short_r1", "linker2_not_found", "tn5_not_found", "barcode1_not_in_whitelist", "barcode2_not_in_whitelist"]
    return demuxed.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total_reads"), count("kept").alias("kept_reads"), count(*structure).alias("structure_mismatch"), *(count(n).alias(n) for n in names)
    )


def demultiplex_umi(reads: DataFrame, listed: DataFrame, linker: str, umi_left: str, umi_length: int, length: int = 10, distance: int = 1) -> DataFrame:
    """For transcript reads: ``row_id, reason, seq, qual``, where a kept read is both barcodes and its UMI.

    Case counts, the linker may stand anywhere (leftmost within ``distance`` mismatches), the letters before the UMI
    must be exact. Barcodes get the best quality, the UMI keeps its own.
    """
    near = broadcast_if_small(stage(neighbourhood(listed, distance), "barcode-spellings"), BROADCAST_VARIANTS)
    part = lambda first, n: F.substr("seq", first + 1, F.lit(n))
    at = F.col("_at")
    a_at = at + len(linker)
    umi_at = a_at + length + len(umi_left)
    rows = reads.withColumn("_at", patterns.leftmost_place(F.col("seq"), linker, distance))
    rows = rows.withColumn("_b", F.when(at >= length, part(at - length, length))).withColumn("_a", F.when(at.isNotNull(), part(a_at, length)))
    rows = _looked_up(_looked_up(rows, near, "_a", "barcode_a"), near, "_b", "barcode_b")
    umi = part(umi_at, umi_length)
    reason = (
        F.when(at.isNull(), "linker_not_found")
        .when(F.col("barcode_b").isNull(), "bad_barcode2")
        .when(F.col("barcode_a").isNull(), "bad_barcode1")
        .when(part(a_at + length, len(umi_left)) != umi_left, "umi_left_not_found")
        .when(F.length(umi) < umi_length, "umi_too_short")
        .otherwise("kept")
    )
    own = F.substr("qual", umi_at + 1, F.lit(umi_length))
    qual = F.when(F.length(own) == umi_length, own).otherwise("I" * umi_length)
    kept = F.col("reason") == "kept"
    return rows.withColumn("reason", reason).select(
        "row_id", "reason", F.when(kept, F.concat("barcode_b", "barcode_a", umi)).alias("seq"), F.when(kept, F.concat(F.repeat(F.lit("I"), F.lit(2 * length)), qual)).alias("qual")
    )


def cell_index(cells: DataFrame, listed: DataFrame, half: int = 8, strict: bool = False) -> DataFrame:
    """``cells`` with ``index_b, index_a``, the places of both halves of ``cell`` in the list.

    An unlisted half, or a cell of another length, gives nulls, or with ``strict`` an error when the row is read.
    """
    places = broadcast_if_small(listed.select("barcode", "idx"), BROADCAST_VARIANTS)
    cells = cells.withColumn("_ok", F.length("cell") == 2 * half)
    part = lambda at: F.when(F.col("_ok"), F.substring("cell", at, half))
    rows = cells.withColumn("_b", part(1)).withColumn("_a", part(half + 1))
    for raw, name in (("_b", "index_b"), ("_a", "index_a")):
        rows = rows.join(places.select(F.col("barcode").alias(raw), F.col("idx").alias(name)), raw, "left").drop(raw)
    if strict:
        known = F.col("index_b").isNotNull() & F.col("index_a").isNotNull()
        error = F.raise_error(F.concat(F.lit("no listed cell: "), F.coalesce("cell", F.lit("null")))).cast("int")
        rows = rows.withColumn("index_b", F.when(known, F.col("index_b")).otherwise(error))
    return rows.drop("_ok")


def site_conversion(reads: DataFrame, sequence: str, sites: list[int], *by: str) -> DataFrame:
    """Per ``by`` and C of a motif (``site``, its place): ``retained``, ``converted``, ``other`` and ``rate``, in percent.

    Only reads that hold the motif exactly once, apart from converted Cs, count.
    """
    hit = reads.withColumn("_m", patterns.motif_place(F.col("seq"), sequence)).where("_m.status = 'hit'")
    rows = hit.select(*by, F.explode(F.array(*map(F.lit, sites))).alias("site"), F.col("_m.place").alias("_p"), "seq")
    base = F.substr("seq", F.col("_p") + F.col("site") + 1, F.lit(1))
    sums = rows.select(*by, "site", base.alias("_base")).groupBy(*by, "site").agg(
        F.count_if(F.col("_base") == "C").alias("retained"), F.count_if(F.col("_base") == "T").alias("converted"), F.count_if(~F.col("_base").isin("C", "T")).alias("other")
    )
    known = F.col("retained") + F.col("converted")
    return sums.withColumn("rate", F.when(known > 0, F.col("converted") / known * 100))


def motif_status(reads: DataFrame, sequence: str, *by: str) -> DataFrame:
    """Per ``by`` how many reads have the motif once, not, several times, or are too short for it."""
    rows = reads.select(*by, patterns.motif_place(F.col("seq"), sequence)["status"].alias("_s"))
    return rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n_scanned"), *(F.count_if(F.col("_s") == s).alias(f"n_{s}") for s in ("hit", "none", "ambiguous", "too_short")))


def mean_conversion(sites: DataFrame, score: list[int], *by: str) -> DataFrame:
    """Per ``by`` over the scored sites: the mean of their rates and the rate of all their reads together, in percent."""
    picked = sites.where(F.col("site").isin(score))
    known = F.sum(F.col("converted") + F.col("retained"))
    return picked.groupBy(*by).agg(F.avg("rate").alias("mean_rate"), F.when(known > 0, F.sum("converted") / known * 100).alias("pooled_rate"))


def linker_conversion(reads: DataFrame, masked: str, first: int, last: int, distance: int, *by: str) -> DataFrame:
    """Per ``by``: reads with the anchor found, the mean of their conversion at its assay sites and the share with all converted (fractions).

    ``masked`` is the anchor; its Cs are compared as N. Assay sites are its Cs at 3, 6 and 10. The place must be the
    only exact or the only best one that begins at ``first`` and ends by ``last``.
    """
    assay = [p for p in (3, 6, 10) if p < len(masked) and masked[p] == "C"]
    place = patterns.unique_place(F.upper("seq"), masked.replace("C", "N"), distance, first, F.lit(last))
    rows = reads.withColumn("_p", place).where("_p is not null")
    at = [F.substr(F.upper("seq"), F.col("_p") + p + 1, F.lit(1)) for p in assay]
    count = lambda base: sum((F.when(b == base, 1).otherwise(0) for b in at), F.lit(0))
    scored = rows.withColumn("_t", count("T")).withColumn("_c", count("C"))
    known = F.col("_t") + F.col("_c")
    return scored.groupBy(*by).agg(
        F.count(F.lit(1)).alias("scored_reads"),
        F.avg(F.when(known > 0, F.col("_t") / known)).alias("mean_rate_fraction"),
        (F.count_if(F.col("_t") == len(assay)) / F.count(F.lit(1))).alias("all_t_fraction"),
    )


def linker_sites(reads: DataFrame, masked: str, first: int, last: int, distance: int, *by: str) -> DataFrame:
    """Per ``by`` and C of the anchor (``site``, its place): how many of the reads with the anchor found show ``n_t``, ``n_c`` and ``n_other`` there."""
    text = F.upper("seq")
    place = patterns.unique_place(text, masked.replace("C", "N"), distance, first, F.lit(last))
    at = F.array(*(F.lit(i) for i, c in enumerate(masked) if c == "C"))
    rows = reads.select(*by, text.alias("_u"), place.alias("_p")).where("_p is not null").select(*by, "_u", "_p", F.explode(at).alias("site"))
    base = F.substr("_u", F.col("_p") + F.col("site") + 1, F.lit(1))
    return rows.select(*by, "site", base.alias("_b")).groupBy(*by, "site").agg(
        F.count_if(F.col("_b") == "T").alias("n_t"), F.count_if(F.col("_b") == "C").alias("n_c"), F.count_if(~F.col("_b").isin("T", "C")).alias("n_other")
    )


def merged_linker_conversion(parts: DataFrame, *by: str) -> DataFrame:
    """The conversion of several runs' linkers, their rates weighted by the reads scored."""
    n = F.col("scored_reads")
    weighted = lambda c: (F.sum(F.col(c) * n) / F.nullif(F.sum(F.when(F.col(c).isNotNull(), n)), F.lit(0))).alias(c)
    return parts.groupBy(*by).agg(F.sum(n).alias("scored_reads"), weighted("mean_rate_fraction"), weighted("all_t_fraction"))


def first_reads(reads: DataFrame, n: int, *order: str) -> DataFrame:
    """The first ``n`` reads of all files in order."""
    return reads.orderBy(*order).limit(n)


def all_converted(reads: DataFrame, place: str, sites: list[int]) -> DataFrame:
    """The reads of which every listed site behind ``place`` is a T."""
    return reads.where(F.forall(F.array(*map(F.lit, sites)), lambda s: F.substr("seq", F.col(place) + s + 1, F.lit(1)) == "T"))


def common_linker(reads: DataFrame, first: int = 10, length: int = 18) -> str:
    """The letters that most reads have behind their first barcode: the linker of a run; equally common ones by the alphabet."""
    seen = reads.select(F.upper(F.substr("seq", F.lit(first + 1), F.lit(length))).alias("l")).where(F.length("l") == length)
    found = seen.groupBy("l").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "l").first()
    return found["l"] if found else ""
