"""Operators on sites: calls from aligned reads, coverage, bins, saturation, read-cycle bias and spans of CpGs."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import bases
from ..functions.numbers import percent
from ..staging import stage
from . import skew
from . import spots as spot_ops

#: Fractions of the reads at which saturation is estimated (fixed values).
FRACTIONS = [0.01, 0.02, 0.05, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]
MIN_CYCLE_COVERAGE = 500


def reference_sites(chunks: DataFrame) -> DataFrame:
    """``contig, pos, context, strand`` of the CG and CH sites of a reference.

    ``chunks`` has ``contig, start, seq, pad`` with 0-based starts: the bases of a chunk and, in ``pad``, one
    more base on either side (an empty text at a contig's end), so that contexts don't break at its borders.
    """
    s = F.upper(F.concat(F.rpad(F.coalesce(F.col("pad.before"), F.lit("")), 1, "-"), "seq", F.coalesce(F.col("pad.after"), F.lit(""))))
    letters = chunks.where(F.length("seq") > 0).select("contig", "start", F.length("seq").alias("n"), F.split(s, "").alias("c"))
    three = F.transform(F.sequence(F.lit(1), F.col("n")), lambda i: F.struct(i.alias("i"), F.get("c", i - 1).alias("p"), F.get("c", i).alias("b"), F.get("c", i + 1).alias("a")))
    found = letters.select("contig", "start", F.explode(F.filter(three, lambda t: t["b"].isin("C", "G"))).alias("t"))  # the chunk itself isn't repeated
    context = bases.site_context(F.col("t.p"), F.col("t.b"), F.col("t.a"))
    rows = found.select("contig", (F.col("start") + F.col("t.i") - 1).cast("long").alias("pos"), F.col("t.b").alias("base"), context.alias("context"))
    return rows.where("context is not null").select("contig", "pos", "context", bases.site_strand(F.col("context"), F.col("base")).alias("strand"))


def first_sites(sites: DataFrame, n: int) -> DataFrame:
    """The first ``n`` sites of each contig."""
    w = Window.partitionBy("contig").orderBy("pos")
    return sites.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def _blocks(alignments: DataFrame, min_mapq: int) -> DataFrame:
    """Properly paired reads with ``blocks``, their aligned stretches (``q`` in the read, ``r`` on the contig, ``n`` long).

    Reads with an unclear conversion strand (``yd`` is u) are left out.
    """
    ok = F.col("flag").isin(bases.PAIRED_FLAGS) & (F.coalesce("mapq", F.lit(0)) >= min_mapq) & (F.coalesce("yd", F.lit("")) != "u")
    step = lambda a, c: F.struct(
        (a["q"] + F.when(c["op"].isin("M", "=", "X", "I", "S"), c["len"]).otherwise(0)).alias("q"),
        (a["r"] + F.when(c["op"].isin("M", "=", "X", "D", "N"), c["len"]).otherwise(0)).alias("r"),
        F.when(c["op"].isin("M", "=", "X"), F.array_append(a["blocks"], F.struct(a["q"].alias("q"), a["r"].alias("r"), c["len"].alias("n")))).otherwise(a["blocks"]).alias("blocks"),
    )
    begin = F.struct(F.lit(0).alias("q"), F.col("start").cast("int").alias("r"), F.expr("cast(array() as array<struct<q:int,r:int,n:int>>)").alias("blocks"))
    cigar = F.transform("cigar", lambda c: F.struct(c["op"].alias("op"), c["len"].cast("int").alias("len")))
    reads = alignments.where(ok & F.col("seq").isNotNull()).withColumn("blocks", F.aggregate(cigar, begin, step, lambda a: a["blocks"]))
    return reads.select("name", "flag", "spot", "contig", F.upper("seq").alias("seq"), F.length("seq").alias("n"), "quals", "blocks")


def _shown(q: Column) -> list[Column]:
    """The quality and the base at a place of a read, and the bases beside it (empty past an end)."""
    at = lambda k: F.substr("seq", q + k, F.lit(1))
    return [q.alias("qpos"), F.get("quals", q).alias("qual"), at(1).alias("base"), F.when(q > 0, at(0)).otherwise("").alias("before"), at(2).alias("after")]


def aligned_bases(alignments: DataFrame, min_mapq: int = 0, min_base_quality: int = 0) -> DataFrame:
    """One row per aligned base of properly paired reads: ``name, flag, spot, contig, pos, qpos, n, qual, base, before, after``.

    ``alignments`` has ``name, flag, mapq, contig, start, cigar, seq, quals, yd, spot``: ``cigar`` is an array of
    ``(op, len)``, ``quals`` an array of numbers or null. Reads with an unclear conversion strand (``yd`` is u) are
    left out. Deleted and skipped bases give no row; inserted and clipped ones have no reference place. For bases at
    given places only, ``bases_at`` moves far fewer rows.
    """
    blocks = _blocks(alignments, min_mapq).withColumn("b", F.explode("blocks"))
    rows = blocks.withColumn("k", F.explode(F.sequence(F.lit(0), F.col("b.n") - 1)))
    out = rows.select("name", "flag", "spot", "contig", (F.col("b.r") + F.col("k")).cast("long").alias("pos"), "n", *_shown(F.col("b.q") + F.col("k")))
    return out.where(F.coalesce("qual", F.lit(255)) >= min_base_quality)


#: Reference bases to a bucket in which reads and places meet.
PLACES_BUCKET = 128


def bases_at(alignments: DataFrame, places: DataFrame, min_mapq: int = 0, min_base_quality: int = 0, bucket: int = PLACES_BUCKET) -> DataFrame:
    """The rows of ``aligned_bases`` at ``places`` (``contig, pos`` and other columns, which are kept).

    Aligned stretches of reads, not bases, are shuffled: they meet the places of each bucket they touch as one array, and
    only their bases at places become rows. A place stands in one bucket, so none comes out twice.
    """
    extra = [c for c in places.columns if c not in ("contig", "pos")]
    held = places.groupBy("contig", F.floor(F.col("pos") / bucket).alias("_bucket")).agg(F.collect_list(F.struct(F.col("pos").cast("long").alias("pos"), *extra)).alias("_places"))
    blocks = _blocks(alignments, min_mapq).select("name", "flag", "spot", "contig", "seq", "n", "quals", F.inline("blocks").alias("_q", "_r", "_n"))
    touched = F.sequence(F.floor(F.col("_r") / bucket), F.floor((F.col("_r") + F.col("_n") - 1) / bucket))
    met = blocks.withColumn("_bucket", F.explode(touched)).join(held, ["contig", "_bucket"])
    rows = met.select("name", "flag", "spot", "contig", "seq", "n", "quals", "_q", "_r", "_n", F.explode("_places").alias("p"))
    inside = rows.where((F.col("p.pos") >= F.col("_r")) & (F.col("p.pos") < F.col("_r") + F.col("_n")))
    place = (F.col("p.pos") - F.col("_r") + F.col("_q")).cast("int")
    out = inside.select("name", "flag", "spot", "contig", F.col("p.pos").alias("pos"), "n", *_shown(place), *(F.col(f"p.{c}").alias(c) for c in extra))
    return out.where(F.coalesce("qual", F.lit(255)) >= min_base_quality)


def without_overlaps(rows: DataFrame) -> DataFrame:
    """Of mates that cover one reference place the base of better quality, of equal ones the first mate's."""
    w = Window.partitionBy("name", "contig", "pos").orderBy(F.desc_nulls_last("qual"), F.col("flag").bitwiseAND(64) == 0)
    return rows.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def with_depth_up_to(rows: DataFrame, most: int) -> DataFrame:
    """At most ``most`` bases to a place, in the order of the reads' names: for comparisons with callers that cap the depth."""
    w = Window.partitionBy("contig", "pos").orderBy("name", "flag", "qpos")
    return rows.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= most).drop("_rn")


def site_calls(rows: DataFrame, converted: bool = True, r1: tuple[int, int] = (0, 0), r2: tuple[int, int] = (0, 0), mates_once: bool = True) -> DataFrame:
    """``spot, contig, pos, context, strand, methylated``: one row per aligned base that shows a state of a site.

    ``rows`` are the bases at sites (``bases_at``). A CG site takes reads of all four flags and reads two bases there; a
    CH site takes reads of its strand, and the base beside it in the read must fit its context. Both bases must lie
    outside the trimmed cycles. With ``mates_once`` overlapping mates count once.
    """
    joined = without_overlaps(rows) if mates_once else rows
    flag, q, n, base, after = (F.col(c) for c in ("flag", "qpos", "n", "base", "after"))
    is_cg, plus = F.col("context") == "CG", F.col("strand") == "+"
    side = F.when(is_cg | plus, 1).otherwise(-1)
    beside = F.when(is_cg | plus, after).otherwise(F.col("before"))
    inside = (q + side >= 0) & (q + side < n)
    kept = ~bases.trimmed(flag, q, n, r1, r2) & ~bases.trimmed(flag, q + side, n, r1, r2)
    on_strand = F.when(is_cg, F.lit(True)).when(plus, flag.isin(bases.TOP_FLAGS)).otherwise(flag.isin(bases.BOTTOM_FLAGS))
    fits = is_cg | bases.neighbour_fits(F.col("context"), F.col("strand"), beside)
    state = F.when(is_cg, bases.cg_methylated(F.concat(base, after), converted)).otherwise(bases.ch_methylated(base, F.col("strand"), converted))
    called = joined.where(inside & kept & on_strand & fits).withColumn("methylated", state).where("methylated is not null")
    return called.select("spot", "contig", "pos", "context", "strand", "methylated")


def coverage(calls: DataFrame, *by: str) -> DataFrame:
    """``by, contig, pos, context, strand, meth, unmeth, pct``: the calls of each site counted."""
    sums = calls.groupBy(*by, "contig", "pos", "context", "strand").agg(F.count_if("methylated").alias("meth"), F.count_if(~F.col("methylated")).alias("unmeth"))
    return with_percent(sums)


def coverage_by_target(calls: DataFrame, targets: DataFrame, whole: str = "host") -> DataFrame:
    """``target, spot, contig, pos, context, strand, meth, unmeth, pct``: the calls of all targets from one pass.

    ``targets`` (``contig, target``) says which contigs are the host's, mitochondrial or a spike's. Those of the target
    ``whole`` are counted by spot, all others over the spots (a null spot); contigs that aren't listed are left out.
    """
    named = calls.join(targets.dropDuplicates(["contig"]), "contig")
    return coverage(named.withColumn("spot", F.when(F.col("target") == whole, F.col("spot"))), "target", "spot")


def in_contig_order(shards: list[DataFrame], contigs: DataFrame, *then: str) -> DataFrame:
    """The rows of all shards in the order of their contigs (``contig, ord``), places and ``then``, in sorted ranges; the
    columns that one of them lacks are null there, and contigs that aren't listed come last."""
    rows = shards[0]
    for other in shards[1:]:
        rows = rows.unionByName(other, allowMissingColumns=True)
    known = contigs.groupBy("contig").agg(F.min("ord").alias("_ord"))
    return rows.join(known, "contig", "left").orderBy(F.asc_nulls_last("_ord"), "contig", "pos", *then).drop("_ord")


def with_percent(cov: DataFrame) -> DataFrame:
    """Sites with reads and their percentage of methylated ones, rounded to two places."""
    total = F.col("meth") + F.col("unmeth")
    return cov.where(total > 0).withColumn("pct", percent(F.col("meth"), total))


def genomic_bins(contigs: DataFrame, width: int) -> DataFrame:
    """``bin_id, contig, start, end``: half-open windows over ``contig, length, ord``; the last of a contig is short."""
    count = F.ceil(F.col("length") / width)
    w = Window.orderBy("ord").rowsBetween(Window.unboundedPreceding, -1)  # one row per contig
    firsts = contigs.where("length > 0").withColumn("first", F.coalesce(F.sum(count).over(w), F.lit(0)))
    rows = firsts.select("contig", "length", "first", F.explode(F.sequence(F.lit(0), (count - 1).cast("int"))).alias("k"))
    return rows.select(
        (F.col("first") + F.col("k")).cast("long").alias("bin_id"), "contig", (F.col("k") * width).cast("long").alias("start"),
        F.least((F.col("k") + 1) * width, F.col("length")).cast("long").alias("end"),
    )


def bin_matrix(cov: DataFrame, width: int) -> DataFrame:
    """``spot, contig, bin, context, meth, cov, frac``: counts per spot and window, for each context and all CH together.

    The window is computed, not joined. Sites past a contig's end must be left out before.
    """
    rows = cov.select("spot", "contig", F.floor(F.col("pos") / width).alias("bin"), "context", "meth", "unmeth")
    both = F.when(F.col("context") == "CG", F.array(F.lit("CG"))).otherwise(F.array("context", F.lit("CH")))
    rows = rows.withColumn("context", F.explode(both))
    sums = rows.groupBy("spot", "contig", "bin", "context").agg(F.sum("meth").alias("meth"), F.sum(F.col("meth") + F.col("unmeth")).alias("cov"))
    return sums.where("cov > 0").withColumn("frac", F.col("meth") / F.col("cov"))


def depth_histogram(cov: DataFrame, *by: str) -> DataFrame:
    """``by, depth, n``: how many sites have each depth over 0."""
    rows = cov.withColumn("depth", F.col("meth") + F.col("unmeth")).where("depth > 0")
    return rows.groupBy(*by, "depth").agg(F.count(F.lit(1)).alias("n"))


def expected_sites(histogram: DataFrame, fractions: list[float] = FRACTIONS, *by: str) -> DataFrame:
    """``by, fraction, expected``: sites expected to be seen with a fraction of the reads."""
    rows = histogram.withColumn("fraction", F.explode(F.array(*map(F.lit, fractions))))
    seen = F.col("n") * (1 - F.pow(1 - F.col("fraction"), F.col("depth")))
    return rows.groupBy(*by, "fraction").agg(F.sum(seen).alias("expected"))


def saturation_points(expected: DataFrame) -> DataFrame:
    """``fraction, median, below, above``: the median over spots and its distance to the quartiles (exact, inclusive)."""
    q = F.percentile("expected", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    rows = expected.groupBy("fraction").agg(q.alias("q"))
    return rows.select("fraction", F.col("q")[1].alias("median"), F.greatest(F.col("q")[1] - F.col("q")[0], F.lit(0.0)).alias("below"), F.greatest(F.col("q")[2] - F.col("q")[1], F.lit(0.0)).alias("above"))


def hq_saturation(counts: DataFrame, cov: DataFrame) -> DataFrame:
    """``saturation_points`` over the CG sites of spots above the knee, with ``n_hq``, how many these are, and the ``threshold``.

    ``counts`` has ``spot, reads``. Spots above the threshold without covered sites count in ``n_hq``, not in the points.
    Without a knee there are no rows.
    """
    grouped = counts.select(F.lit("all").alias("grp"), "spot", "reads")
    threshold = spot_ops.knee(grouped, "grp").select("threshold")
    high = grouped.join(F.broadcast(threshold)).where("reads > threshold").select("spot", "threshold")  # one row
    covered = cov.where("context = 'CG'").join(high.select("spot"), "spot", "left_semi")
    points = saturation_points(expected_sites(depth_histogram(covered, "spot"), FRACTIONS, "spot"))
    facts = high.agg(F.count(F.lit(1)).alias("n_hq"), F.first("threshold").alias("threshold")).where("n_hq > 0")
    return points.join(F.broadcast(facts))  # one row


def saturation_fit(points: DataFrame) -> DataFrame:
    """``slope, r2, a, b, model``: a line through the origin and y = a (1 - exp(-b f)) fitted to ``fraction, median``.

    b is searched on a grid over ten decades and three times around the best so far, a follows in closed form and is
    not negative; of equally good ones the first is taken. The model is linear from a fit of 0.99 on.
    """
    f, y = F.col("f"), F.col("y")
    pts = points.agg(F.sort_array(F.collect_list(F.struct(F.col("fraction").alias("f"), F.col("median").alias("y")))).alias("p"))
    pts = pts.select(F.col("p.f").alias("f"), F.col("p.y").alias("y")).where(F.size("f") > 0)
    add = lambda arr, g: F.aggregate(arr, F.lit(0.0), lambda s, x: s + g(x))
    zipped = F.arrays_zip("f", "y")
    slope = F.coalesce(add(zipped, lambda z: z["f"] * z["y"]) / F.nullif(add(f, lambda x: x * x), F.lit(0.0)), F.lit(0.0))
    pts = pts.withColumn("slope", slope)
    mean = add(y, lambda v: v) / F.size("y")
    sst, sse = add(y, lambda v: (v - mean) * (v - mean)), add(zipped, lambda z: (z["y"] - F.col("slope") * z["f"]) * (z["y"] - F.col("slope") * z["f"]))
    pts = pts.withColumn("r2", F.when(sst <= 0, F.when(sse <= 0, 1.0).otherwise(0.0)).otherwise(1 - sse / sst))

    def search(center: Column, reach: float, low: float, count: int, best: Column | None) -> Column:
        step = (2 * reach if best is not None else 6.0) / (count - 1)
        base = center - reach if best is not None else F.lit(low)

        def tried(k: Column) -> Column:
            b = F.pow(F.lit(10.0), base + k * step)
            g = lambda x: 1 - F.exp(-b * x)
            den = add(f, lambda x: g(x) * g(x))
            a = F.greatest(add(zipped, lambda z: z["y"] * g(z["f"])) / den, F.lit(0.0))
            err = add(zipped, lambda z: (z["y"] - a * g(z["f"])) * (z["y"] - a * g(z["f"])))
            return F.when(den > 0, F.struct(err.alias("err"), k.alias("k"), a.alias("a"), b.alias("b")))

        found = F.array_min(F.transform(F.sequence(F.lit(0), F.lit(count - 1)), tried))
        return found if best is None else F.when(found["err"] < best["err"], found).otherwise(best)

    pts = pts.withColumn("best", search(F.lit(0.0), 0.0, -4.0, 800, None))
    for _ in range(3):
        pts = pts.withColumn("best", search(F.log10(F.col("best.b")), 0.7, 0.0, 240, F.col("best")))
    return pts.select("slope", "r2", "best.a", "best.b", F.when(F.col("r2") >= 0.99, "linear").otherwise("saturation").alias("model"))


def predicted(fit: DataFrame, fraction: float) -> DataFrame:
    """``fit`` with the value its model gives at ``fraction`` of the reads, and the most it ever gives (null for a line)."""
    curve = F.col("a") * (1 - F.exp(-F.col("b") * fraction))
    linear = F.col("model") == "linear"
    return fit.withColumn("predicted", F.when(linear, F.col("slope") * fraction).otherwise(curve)).withColumn("most", F.when(~linear, F.col("a")))


def cg_places(sites: DataFrame) -> DataFrame:
    """``contig, pos`` of the CG sites."""
    return sites.where("context = 'CG'").select("contig", "pos")


def strand_places(sites: DataFrame) -> DataFrame:
    """``contig, pos, top``: both bases of each CG site, the C for reads of top strands and the G for those of bottom ones."""
    cg = sites.where("context = 'CG'")
    top = cg.select("contig", "pos", F.lit(True).alias("top"))
    return top.unionByName(cg.select("contig", (F.col("pos") + 1).alias("pos"), F.lit(False).alias("top")))


def mbias(rows: DataFrame, max_cycle: int, right_align: bool = False, min_coverage: int = MIN_CYCLE_COVERAGE) -> DataFrame:
    """``read, cycle, meth, unmeth, coverage, rate``: conversion by read and cycle, over cycles with more than ``min_coverage``.

    ``rows`` are the bases at ``cg_places``.
    """
    flag, q, n = F.col("flag"), F.col("qpos"), F.col("n")
    state = bases.cg_methylated(F.concat("base", "after"))
    cyc = bases.cycle(flag, q, n, max_cycle if right_align else None)
    return _by_cycle(rows.where(q + 1 < n), cyc, state, max_cycle, min_coverage)


def mbias_by_strand(rows: DataFrame, max_cycle: int, min_coverage: int = MIN_CYCLE_COVERAGE) -> DataFrame:
    """As ``mbias`` where unmethylated bases are converted: single bases at ``strand_places``, C on top strands and G on bottom ones."""
    flag = F.col("flag")
    state = bases.top_bottom_methylated(F.col("base"), flag)
    return _by_cycle(rows.where(flag.isin(bases.TOP_FLAGS) == F.col("top")), bases.cycle(flag, F.col("qpos"), F.col("n")), state, max_cycle, min_coverage)


def _by_cycle(rows: DataFrame, cyc: Column, state: Column, max_cycle: int, min_coverage: int) -> DataFrame:
    picked = rows.select(bases.read_label(F.col("flag")).alias("read"), cyc.alias("cycle"), state.alias("m")).where(F.col("cycle").between(1, max_cycle) & F.col("m").isNotNull())
    sums = picked.groupBy("read", "cycle").agg(F.count_if("m").alias("meth"), F.count_if(~F.col("m")).alias("unmeth"))
    return sums.withColumn("coverage", F.col("meth") + F.col("unmeth")).where(F.col("coverage") > min_coverage).withColumn("rate", F.bround(F.col("meth") / F.col("coverage"), 6))


def cpg_spans(sites: DataFrame, n: int = 10) -> DataFrame:
    """``contig, span``: the length of each window over ``n`` neighbouring sites; contigs with fewer have none.

    Sites are numbered along each contig in sorted ranges, and each meets the one ``n`` - 1 further on: no task holds a contig.
    """
    placed = skew.numbered_in_order(sites, F.col("contig"), {"pos": F.col("pos")}, {}).rows
    ends = placed.select("_key", (F.col("_n") - (n - 1)).alias("_n"), F.col("pos").alias("end"))
    return placed.join(ends, ["_key", "_n"]).select(F.col("_key").alias("contig"), (F.col("end") - F.col("pos") + 1).alias("span"))


def without_outliers(values: DataFrame, grp: str, value: str) -> DataFrame:
    """Values within 1.5 interquartile ranges of their group's quartiles; groups of under four or without spread stay whole."""
    q = values.groupBy(grp).agg(F.percentile(value, F.array(F.lit(0.25), F.lit(0.75))).alias("q"), F.count(value).alias("n"))
    lo, hi = F.col("q")[0], F.col("q")[1]
    iqr = hi - lo
    keep = (F.col("n") < 4) | (iqr <= 0) | F.col(value).between(lo - 1.5 * iqr, hi + 1.5 * iqr)
    return values.join(q, grp).where(keep).select(*values.columns)


def value_summary(values: DataFrame, grp: str, value: str) -> DataFrame:
    """Per group the number, least, mean, exact median and greatest of the values."""
    v = F.col(value)
    return values.groupBy(grp).agg(F.count(v).alias("n"), F.min(v).alias("least"), F.avg(v).alias("mean"), F.percentile(v, 0.5).alias("median"), F.max(v).alias("greatest"))


def histogram(values: DataFrame, grp: str, value: str, bins: int = 80) -> DataFrame:
    """``grp, bin, low, high, n``: counts in ``bins`` equal bins over the range of all groups, zeros included.

    The last bin is closed; if all values are equal there is one bin.
    """
    v = F.col(value).cast("double")
    edges = values.agg(F.min(v).alias("lo"), F.max(v).alias("hi"))
    counted = values.select(grp, v.alias("v")).join(F.broadcast(edges))  # one row
    width = (F.col("hi") - F.col("lo")) / bins
    place = F.when(width > 0, F.least(F.floor((F.col("v") - F.col("lo")) / width), F.lit(bins - 1))).otherwise(0).cast("int")
    n = counted.groupBy(grp, place.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    last = F.when(F.col("hi") > F.col("lo"), bins - 1).otherwise(0)
    every = values.select(grp).distinct().join(F.broadcast(edges)).select(grp, "lo", "hi", F.explode(F.sequence(F.lit(0), last)).alias("bin"))
    low = F.col("lo") + F.col("bin") * width
    return every.join(n, [grp, "bin"], "left").select(grp, "bin", low.alias("low"), F.when(F.col("bin") == last, F.col("hi")).otherwise(low + width).alias("high"), F.coalesce("n", F.lit(0)).alias("n"))


def compare_coverage(a: DataFrame, b: DataFrame, *by: str, shift: int = 0) -> DataFrame:
    """Per ``by``: how two callers agree on sites; ``shift`` is added to the places of the second.

    ``shared, only_a, only_b`` count sites; over shared ones the correlations of methylated and unmethylated counts,
    the mean absolute difference of percentages and the share of differing majority calls.
    """
    keys = list(dict.fromkeys([*by, "contig", "pos"]))
    left = a.select(*keys, F.col("meth").alias("ma"), F.col("unmeth").alias("ua"))
    right = (b.withColumn("pos", F.col("pos") + shift) if shift else b).select(*keys, F.col("meth").alias("mb"), F.col("unmeth").alias("ub"))
    both = left.join(right, keys, "full")
    shared = F.col("ma").isNotNull() & F.col("mb").isNotNull()
    pa, pb = F.col("ma") / (F.col("ma") + F.col("ua")) * 100, F.col("mb") / (F.col("mb") + F.col("ub")) * 100
    return both.groupBy(*by).agg(
        F.count_if(shared).alias("shared"),
        F.count_if(F.col("mb").isNull()).alias("only_a"),
        F.count_if(F.col("ma").isNull()).alias("only_b"),
        F.corr("ma", "mb").alias("corr_meth"),
        F.corr("ua", "ub").alias("corr_unmeth"),
        F.avg(F.abs(pa - pb)).alias("mean_abs_delta"),
        (F.count_if(shared & ((F.col("ma") > F.col("ua")) != (F.col("mb") > F.col("ub")))) / F.nullif(F.count_if(shared), F.lit(0))).alias("disagreement"),
    )


#: Widths of the buckets in which sites meet regions: the least that is four times a region's length or more.
WIDTHS = (1 << 8, 1 << 11, 1 << 14)


def _kind() -> Column:
    """The place in ``WIDTHS`` of a region's width; their number for longer regions and those without a length."""
    return F.coalesce(*(F.when(F.col("end") - F.col("start") <= w // 4, k) for k, w in enumerate(WIDTHS)), F.lit(len(WIDTHS)))


def _met(sites: DataFrame, regions: DataFrame, kinds: list[int], cut: int = WIDTHS[-1]) -> DataFrame:
    """``sites`` and the ``regions`` of ``kinds`` that they lie in, with the ``_bucket`` where they met.

    A region stands only in the bucket of its start; a site near the start of its own stands in the one before too.
    Longer regions stand in each bucket of ``cut`` places. A bucket is known by one long that sorts fast and differs
    for all buckets of a contig; contigs are compared by two inequalities, so that they don't become a second key.
    """
    n = len(WIDTHS) + 1
    start, pos = F.col("start"), F.col("pos")
    homes, near = [], []
    for k in kinds:
        key = lambda at, k=k: F.floor(at / [*WIDTHS, cut][k]) * n + k
        if k < len(WIDTHS):
            own, before = key(pos), key(pos - (WIDTHS[k] // 4 - 1))
            homes.append(F.when(_kind() == k, F.array(key(start))))
            near.append(F.when(own == before, F.array(own)).otherwise(F.array(before, own)))
        else:
            homes.append(F.when(_kind() == k, F.sequence(key(start), key(F.col("end") - 1), F.lit(n).cast("long"))))
            near.append(F.array(key(pos)))
    hashed = lambda df, buckets: df.withColumn("_bucket", F.explode(buckets)).withColumn("_bucket", F.col("_bucket").bitwiseXOR(F.xxhash64("contig")))
    placed = hashed(regions, F.coalesce(*homes)).withColumnRenamed("contig", "_contig")
    return hashed(sites, F.concat(*near)).join(placed, "_bucket").where("pos >= start and pos < end and contig <= _contig and contig >= _contig").drop("_contig")


def intervals_joined(sites: DataFrame, regions: DataFrame, bucket: int = WIDTHS[-1]) -> DataFrame:
    """``sites`` (``contig, pos``) joined with every region (``region, contig, start, end``, half-open) they lie in.

    Both sides meet by contig and bucket of places, so no contig is held whole. Buckets are as wide as the regions' lengths
    ask for, so that a site meets few regions it doesn't lie in; only regions longer than a quarter of the widest are cut, by
    ``bucket``. ``regions`` are read twice, once for their lengths.
    """
    kinds = sorted(k for (k,) in regions.select(_kind()).distinct().collect())
    return _met(sites, regions, kinds or [0], bucket).drop("_bucket")


def smoothed(sites: DataFrame, bandwidth: int, weighted: bool = False) -> DataFrame:
    """``contig, pos, smooth``: the mean fraction of sites within ``bandwidth`` bases, weighted by log(1 + reads) if asked.

    Contigs are cut into stretches of many bandwidths; a site near a border stands in both, so no task holds a contig.
    """
    total = F.col("meth") + F.col("unmeth")
    rows = sites.groupBy("contig", "pos").agg(F.sum("meth").alias("meth"), F.sum("unmeth").alias("unmeth")).where(total > 0)
    stretch = max(64 * bandwidth, 1 << 16)
    near = F.sequence(F.floor((F.col("pos") - bandwidth) / stretch), F.floor((F.col("pos") + bandwidth) / stretch))
    cut = rows.select("contig", "pos", (F.col("meth") / total).alias("frac"), (F.log1p(total) if weighted else F.lit(1.0)).alias("w"), F.explode(near).alias("k"))
    w = Window.partitionBy("contig", "k").orderBy("pos").rangeBetween(-bandwidth, bandwidth)
    mean = F.sum(F.col("frac") * F.col("w")).over(w) / F.sum("w").over(w)
    return cut.withColumn("smooth", mean).where(F.floor(F.col("pos") / stretch) == F.col("k")).select("contig", "pos", "smooth")


def exact_quantile(df: DataFrame, value: str, share: float) -> float | None:
    """The exact quantile of a double column, between neighbours in proportion, null for no values.

    A sketch of the values' ranks brackets it, the values below the bracket are counted, and only those within are
    sorted, each once with its count, so no task holds all values. ``df`` should be a staged table, since it's read three times.
    """
    v = F.col(value)
    n, low, high = df.agg(F.count(v), *(F.percentile_approx(v, min(max(share + d, 0.0), 1.0), 1000) for d in (-0.003, 0.003))).first()
    if not n:
        return None
    at = share * (n - 1)
    first, last = math.floor(at), math.ceil(at)
    while True:
        below, inside = df.agg(F.count_if(v < low), F.count_if(v.between(low, high))).first()
        if below <= first and last < below + inside:
            break
        low, high = df.agg(F.min(v), F.max(v)).first()  # the sketch's bracket missed: all values are sorted, in ranges
    ties = df.where(v.between(low, high)).groupBy(v.alias("v")).agg(F.count(F.lit(1)).alias("n"))
    ranks = skew.running_total(skew.numbered_in_order(ties, F.lit(0), {"v": F.col("v")}, {"n": F.col("n")}).rows, "n", "upto")
    holds = lambda k: F.min(F.when(F.col("upto") > k - below, F.col("v")))
    a, b = ranks.agg(holds(first), holds(last)).first()
    return a + (b - a) * (at - first)


def variable_regions(cov: DataFrame, width: int, step: int, share: float) -> DataFrame:
    """``contig, start, end, variance``: windows in the top ``share`` of variance between spots, touching ones merged."""
    places = F.sequence(F.greatest(F.floor((F.col("pos") - width) / step) + 1, F.lit(0)), F.floor(F.col("pos") / step))
    rows = cov.select("spot", "contig", F.explode(places).alias("k"), "meth", "unmeth")
    spots = rows.groupBy("spot", "contig", "k").agg((F.sum("meth") / F.sum(F.col("meth") + F.col("unmeth"))).alias("frac"))
    windows = stage(spots.groupBy("contig", "k").agg(F.var_samp("frac").alias("variance")).where("variance is not null"), "windows")
    kept = windows.where(F.col("variance") >= exact_quantile(windows, "variance", 1 - share)).select("contig", (F.col("k") * step).alias("start"), (F.col("k") * step + width).alias("end"), "variance")
    w = Window.partitionBy("contig").orderBy("start")
    open_ = F.max("end").over(w.rowsBetween(Window.unboundedPreceding, -1))
    island = F.sum(F.when(F.col("start") <= F.col("reach"), 0).otherwise(1)).over(w)
    return kept.withColumn("reach", open_).withColumn("island", island).groupBy("contig", "island").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.max("variance").alias("variance")).drop("island")


def region_matrix(cov: DataFrame, regions: DataFrame) -> DataFrame:
    """``region, spot, meth, cov, frac`` of the sites in each region.

    Short regions are summed up in the bucket where they meet their sites, without a shuffle of the pairs; those that are
    cut or consist of several intervals are summed up by region and spot.
    """
    alone = F.count(F.lit(1)).over(Window.partitionBy("region")) == 1
    short = F.col("_kind") < len(WIDTHS)
    marked = stage(regions.select("region", "contig", "start", "end", _kind().alias("_kind"), alone.alias("_alone")), "regions")
    found = sorted(marked.select("_kind", short & F.col("_alone")).distinct().collect())
    parts = []
    for whole in (True, False):
        kinds = [k for k, w in found if w == whole]
        if kinds or (whole and not found):
            rows = _met(cov.select("spot", "contig", "pos", "meth", "unmeth"), marked.where((short & F.col("_alone")) == whole), kinds or [0])
            by = ["_bucket", "region", "spot"] if whole else ["region", "spot"]
            sums = rows.groupBy(*by).agg(F.sum("meth").alias("meth"), F.sum(F.col("meth") + F.col("unmeth")).alias("cov"))
            parts.append(sums.select("region", "spot", "meth", "cov"))
    return reduce(DataFrame.union, parts).where("cov > 0").withColumn("frac", F.col("meth") / F.col("cov"))


def region_chain(cov: DataFrame, least: int, width: int, step: int, share: float, regions: DataFrame | None = None) -> DataFrame:
    """``region, contig, start, end, spot, meth, cov, frac``: the matrix of the spots with at least ``least`` sites over
    ``regions``, or over their variable regions if none are given; ``region`` numbers these from their contig and place."""
    kept = enough_sites(cov, least)
    if regions is None:
        found = variable_regions(kept, width, step, share)
        regions = found.select(F.concat_ws(":", "contig", "start").alias("region"), "contig", "start", "end")
    regions = stage(regions.select("region", "contig", "start", "end"), "regions")
    return region_matrix(kept, regions).join(regions, "region")


def region_profile(cov: DataFrame, regions: DataFrame, bin_width: int) -> DataFrame:
    """``offset, n, mean_frac``: the mean fraction of sites by their place from a region's start, from its end on the minus strand."""
    rows = intervals_joined(cov.where("meth + unmeth > 0"), regions)
    at = F.when(F.col("strand") == "-", F.col("end") - 1 - F.col("pos")).otherwise(F.col("pos") - F.col("start"))
    frac = F.col("meth") / (F.col("meth") + F.col("unmeth"))
    return rows.groupBy((F.floor(at / bin_width) * bin_width).cast("long").alias("offset")).agg(F.count(F.lit(1)).alias("n"), F.avg(frac).alias("mean_frac"))


def enough_sites(cov: DataFrame, least: int) -> DataFrame:
    """The rows of spots with at least ``least`` covered sites."""
    spots = cov.where("meth + unmeth > 0").groupBy("spot").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)
    return cov.join(spots.select("spot"), "spot", "left_semi")


