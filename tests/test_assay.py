"""The operators of the assay on small inputs with known results."""

import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from spotweave.functions import bases, numbers, patterns
from spotweave.functions.text import parse_list
from spotweave.operators import reads, sites, spots

COV = "spot string, contig string, pos bigint, context string, meth bigint, unmeth bigint, strand string"


def cov(spark, *data):
    return spark.createDataFrame([(*d, "+")[:7] for d in data], COV)


def test_bins_and_matrix(spark, rows):
    contigs = spark.createDataFrame([("chr1", 250, 0), ("chr2", 100, 1)], "contig string, length bigint, ord int")
    assert rows(sites.genomic_bins(contigs, 100)) == [(0, "chr1", 0, 100), (1, "chr1", 100, 200), (2, "chr1", 200, 250), (3, "chr2", 0, 100)]
    a, b = "AAAABBBB", "CCCCDDDD"
    df = cov(
        spark, (a, "chr1", 10, "CG", 3, 1), (a, "chr1", 150, "CG", 1, 1), (b, "chr1", 20, "CG", 0, 2), (a, "chr1", 5, "CA", 2, 2),
        (a, "chr1", 130, "CA", 1, 1), (a, "chr1", 120, "CC", 4, 0), (b, "chr1", 8, "CT", 1, 0),
    )
    m = sites.bin_matrix(df, 100)
    assert rows(m.where("context = 'CG'"), "bin", "spot", "meth", "cov", "frac") == sorted([(0, a, 3, 4, 0.75), (1, a, 1, 2, 0.5), (0, b, 0, 2, 0.0)], key=repr)
    assert rows(m.where("context = 'CA'"), "bin", "spot", "meth", "cov") == [(0, a, 2, 4), (1, a, 1, 2)]
    assert rows(m.where("context = 'CH'"), "bin", "spot", "meth", "cov", "frac") == sorted([(0, a, 2, 4, 0.5), (1, a, 5, 6, 5 / 6), (0, b, 1, 1, 1.0)], key=repr)


@pytest.mark.parametrize(
    ("width", "label"), [(500, "500bp"), (999, "999bp"), (1000, "1k"), (10_000, "10k"), (1500, "1.5k"), (1_000_000, "1M"), (2_500_000, "2.5M")]
)
def test_bin_labels(width, label):
    assert numbers.bin_label(width) == label
    with pytest.raises(ValueError):
        numbers.bin_label(0)
    assert [numbers.bin_label(w) for w in (10_000_001, 1_234_567, 12_345, 20_000_000)] == ["10.000001M", "1.234567M", "12.345k", "20M"]


def test_whitelist_expansion(spark, rows):
    listed = spark.createDataFrame([("AAAA", 0), ("TTTT", 1)], "barcode string, idx int")
    seen = spark.createDataFrame([("AAAATTTT",), ("TTTTAAAA",), ("GGGGCCCC",)], "spot string")
    assert rows(spots.expanded_whitelist(listed, seen)) == [("AAAATTTT",), ("TTTTAAAA",)]
    assert rows(spots.expanded_whitelist(listed, spark.createDataFrame([("AAAA",), ("AAAATTTT",)], "spot string"))) == [("AAAA",)]


def test_counts_and_funnel(spark, rows):
    listed = spark.createDataFrame([("AAAA", 0), ("CCCC", 1)], "barcode string, idx int")
    d = ("CCCCAAAA", 99, 60, 1, "chr1")
    change = lambda **k: tuple({**dict(zip(("spot", "flag", "mapq", "hits", "contig"), d)), **k}.values())
    data = [d, change(contig="chrM"), change(flag=0), change(mapq=5), change(hits=2), change(flag=4, contig=None), change(spot="TTTTAAAA"), change(spot=None, flag=147, contig="chr2")]
    df = spark.createDataFrame(data, "spot string, flag int, mapq int, hits int, contig string")
    assert rows(spots.on_array(df, listed, 4).groupBy("spot").count()) == [("CCCCAAAA", 6)]
    assert rows(spots.funnel(df, ["chrM"]), "mapped_reads", "valid_reads", "valid_mito", "valid_nuclear") == [(5, 4, 1, 3)]
    assert rows(spots.total_funnel(spots.counts_and_funnel(df, ["chrM"]))) == [(8, 5, 4, 1, 3)]


def test_stats(spark):
    df = cov(spark, ("s", "c", 1, "CG", 8, 2), ("s", "c", 2, "CG", 3, 2), ("s", "c", 3, "CA", 1, 9), ("s", "c", 4, "CC", 2, 8), ("s", "c", 5, "XX", 0, 5), ("t", "c", 5, "CG", 0, 0))
    r = spots.meth_stats(sites.with_percent(df), "spot").first()
    assert (r.mean_cg, r.n_cg, r.mean_ch, r.n_ch, r.mean_ca, r.mean_cc, r.mean_ct, r.n_ct) == (70.0, 2, 10.0, 3, 10.0, 20.0, None, 0)
    parts = spots.meth_stats(sites.with_percent(df), "spot", "pos")
    assert spots.merged_stats(parts, "spot").first().mean_cg == 70.0


def test_percent_rounds_halves_to_even(spark):
    df = spark.range(1, 400).select(F.col("id").alias("t")).withColumn("m", F.explode(F.sequence(F.lit(0), F.col("t")))).withColumn("p", numbers.percent(F.col("m"), F.col("t")))
    assert all(r.p == round(100 * (r.m / r.t), 2) or r.p == round(r.m / r.t * 100, 2) for r in df.collect())


def test_top_spots(spark):
    df = spark.createDataFrame([(f"B{i:02}A{i:02}", i) for i in range(20)] + [("A", 19)], "spot string, reads bigint")
    assert [r.spot for r in spots.top_spots(df).collect()][:3] == ["A", "B19A19", "B18A18"]
    assert spots.top_spots(df).count() == 16


@pytest.mark.parametrize("converted", [True, False])
def test_calls(spark, converted):
    pairs = spark.createDataFrame([(p,) for p in ("TG", "CA", "CG", "CC", "TT")], "p string")
    assert [r[0] for r in pairs.select(bases.cg_methylated(F.col("p"), converted)).collect()] == [converted, converted, not converted, None, None]
    df = spark.createDataFrame([("+", "C"), ("+", "T"), ("-", "G"), ("-", "A"), ("+", "G")], "s string, b string")
    assert [r[0] for r in df.select(bases.ch_methylated(F.col("b"), F.col("s"), converted)).collect()] == [not converted, converted, not converted, converted, None]


def test_neighbours(spark):
    fits = lambda c, s, n: spark.range(1).select(bases.neighbour_fits(F.lit(c), F.lit(s), F.lit(n))).first()[0]
    assert [fits("CC", "+", n) for n in "CTAG"] == [True, True, False, False] and [fits("CC", "-", n) for n in "GACT"] == [True, True, False, False]
    assert [fits("CA", "+", "A"), fits("CA", "+", "T"), fits("CT", "+", "T"), fits("CA", "-", "T"), fits("CT", "-", "A"), fits("CT", "-", "T")] == [True, False, True, True, True, False]


def chunk(spark, seq, size=4):
    data = [("c", i, seq[i : i + size], (seq[i - 1 : i] if i else "", seq[i + size : i + size + 1])) for i in range(0, len(seq), size)]
    return spark.createDataFrame(data, "contig string, start bigint, seq string, pad struct<before: string, after: string>")


@pytest.mark.parametrize("size", [1, 2, 3, 4, 50])
def test_reference_sites(spark, rows, size):
    found = sites.reference_sites(chunk(spark, "ACGCATGCT", size))
    assert rows(found, "pos", "context", "strand") == [(1, "CG", None), (3, "CA", "+"), (6, "CA", "-"), (7, "CT", "+")]
    assert rows(sites.first_sites(found.where("context <> 'CG'"), 2), "pos") == [(3,), (6,)]


ALIGNED = "name string, flag int, mapq int, contig string, start int, cigar array<struct<op: string, len: int>>, seq string, quals array<int>, yd string, spot string"


def test_aligned_bases(spark, rows):
    data = [
        ("a", 99, 60, "c", 10, [("S", 1), ("M", 2), ("I", 1), ("M", 1), ("D", 2), ("M", 1)], "xACxGT", [40] * 6, None, "s"),
        ("b", 99, 60, "c", 10, [("M", 2)], "AC", [40, 5], None, "s"),
        ("u", 99, 60, "c", 10, [("M", 2)], "AC", None, "u", "s"),
        ("o", 0, 60, "c", 10, [("M", 2)], "AC", None, None, "s"),
        ("n", 163, 60, "c", 10, [("M", 1)], "A", None, None, "s"),
    ]
    got = sites.aligned_bases(spark.createDataFrame(data, ALIGNED), 10, 13)
    assert rows(got, "name", "pos", "qpos") == [("a", 10, 1), ("a", 11, 2), ("a", 12, 4), ("a", 15, 5), ("b", 10, 0), ("n", 10, 0)]


@pytest.mark.parametrize("bucket", [1, 3, 128])
def test_bases_at_places_are_those_of_all_bases(spark, rows, bucket):
    data = [
        ("a", 99, 60, "c", 10, [("S", 1), ("M", 2), ("I", 1), ("M", 1), ("D", 2), ("N", 300), ("M", 1)], "xACxGT", [40] * 6, None, "s"),
        ("b", 83, 60, "c", 11, [("M", 4)], "acgt", None, None, None),
        ("x", 83, 60, "d", 11, [("S", 4)], "ACGT", None, None, "s"),
    ]
    reads = spark.createDataFrame(data, ALIGNED)
    places = spark.createDataFrame([("c", p, p % 3) for p in range(8, 320)] + [("e", 10, 1)], "contig string, pos bigint, extra int")
    all_ = sites.aligned_bases(reads)
    assert rows(sites.bases_at(reads, places, bucket=bucket), *all_.columns) == rows(all_.where("contig = 'c'"))
    assert rows(sites.bases_at(reads, places.where("extra = 1"), bucket=bucket), "pos", "extra") == rows(all_.where("pos % 3 = 1").selectExpr("pos", "1"))


def test_mates_that_overlap_count_once(spark, rows):
    data = [("m", 99, 60, "c", 0, [("M", 2)], "TG", [30, 30], None, "s"), ("m", 147, 60, "c", 0, [("M", 2)], "CG", [35, 20], None, "s")]
    kept = sites.without_overlaps(sites.aligned_bases(spark.createDataFrame(data, ALIGNED)))
    assert rows(kept, "pos", "flag") == [(0, 147), (1, 99)]


def test_site_calls_and_trimming(spark, rows):
    ref = sites.reference_sites(chunk(spark, "ACGCATGCT", 50))
    data = [("r", 99, 60, "c", 0, [("M", 9)], "ATGTATGCT", None, None, "s"), ("q", 83, 60, "c", 0, [("M", 9)], "ACGCATACT", None, None, "s")]
    rows_ = sites.bases_at(spark.createDataFrame(data, ALIGNED), ref)
    got = rows(sites.coverage(sites.site_calls(rows_), "spot"), "pos", "context", "meth", "unmeth")
    assert got == [(1, "CG", 1, 1), (3, "CA", 1, 0), (6, "CA", 1, 0), (7, "CT", 0, 1)]
    cut = sites.site_calls(rows_, True, (2, 0), (0, 0))
    assert rows(sites.coverage(cut, "spot"), "pos", "meth", "unmeth") == [(1, 0, 1), (3, 1, 0), (6, 1, 0), (7, 0, 1)]


@pytest.mark.parametrize(("flag", "q", "plain", "right"), [(99, 0, 1, 51), (83, 0, 50, 51), (147, 0, 50, 50), (163, 9, 10, 10)])
def test_cycles(spark, flag, q, plain, right):
    f = lambda m: spark.range(1).select(bases.cycle(F.lit(flag), F.lit(q), F.lit(50), m)).first()[0]
    assert (f(None), f(100)) == (plain, right)


def by_hand_knee(values):
    t = sorted((v for v in values if v > 10), reverse=True)
    n = len(t)
    s, e = math.floor(n * 0.05), n - math.floor(n * 0.1)
    w = 51 if 51 < n else (n if n % 2 else max(1, n - 1))
    h = w // 2
    y = [math.log10(v + 1) for v in t]
    pad = [y[0]] * h + y + [y[-1]] * h
    z = [sum(pad[i : i + w]) / w for i in range(n)]
    d = [z[1] - z[0] if i == 0 else z[-1] - z[-2] if i == n - 1 else (z[i + 1] - z[i - 1]) / 2 for i in range(n)]
    least = min(d[s:e])
    k = min(i for i in range(s, e) if d[i] <= 0.5 * least)
    return t[k], k + 1, s, e


def test_knee(spark, rows):
    cliff = [1000 - 2 * i for i in range(80)] + [800.0 * math.exp(-0.08 * i) + 15.0 for i in range(60)] + [8, 6, 4, 2]
    r = random.Random(2)
    groups = {"cliff": cliff, "few": [90, 70, 12], "mid": [r.randint(11, 900) for _ in range(50)], "odd": [r.randint(11, 900) for _ in range(31)], "one": [50, 3], "big": [r.randint(1, 9000) for _ in range(300)]}
    data = [(g, f"{i:04}", v) for g, vs in groups.items() for i, v in enumerate(map(float, vs))]
    got = {k[0]: k[1:] for k in rows(spots.knee(spark.createDataFrame(data, "grp string, spot string, reads double"), "grp"))}
    assert "one" not in got
    for g in ("cliff", "few", "mid", "odd", "big"):
        assert got[g] == by_hand_knee(groups[g]), g


def test_saturation(spark, rows):
    hist = spark.createDataFrame([("a", 1, 5), ("a", 4, 2), ("b", 2, 3), ("c", 3, 1)], "spot string, depth bigint, n bigint")
    want = lambda s, f: sum(n * (1 - (1 - f) ** d) for k, d, n in [("a", 1, 5), ("a", 4, 2), ("b", 2, 3), ("c", 3, 1)] if k == s)
    pts = {r.fraction: r for r in sites.saturation_points(sites.expected_sites(hist, [0.1, 0.5, 1.0], "spot")).collect()}
    for f, r in pts.items():
        v = [want(s, f) for s in "abc"]
        q = statistics.quantiles(v, n=4, method="inclusive")
        assert math.isclose(r.median, q[1]) and math.isclose(r.below, q[1] - q[0]) and math.isclose(r.above, q[2] - q[1])


@pytest.mark.parametrize(("a", "b"), [(1000.0, 2.0), (50.0, 0.01), (7.0, 30.0)])
def test_fit(spark, a, b):
    pts = spark.createDataFrame([(f, a * (1 - math.exp(-b * f))) for f in sites.FRACTIONS], "fraction double, median double")
    r = sites.predicted(sites.saturation_fit(pts), 2.0).first()
    assert r.model == ("linear" if b < 0.1 else "saturation")
    if r.model == "saturation":
        assert math.isclose(r.a, a, rel_tol=0.01) and math.isclose(r.b, b, rel_tol=0.02) and math.isclose(r.predicted, a * (1 - math.exp(-2 * b)), rel_tol=0.01)
    else:
        assert math.isclose(r.predicted, 2 * r.slope) and r.most is None


def test_spans(spark, rows):
    df = spark.createDataFrame([("a", i * 3) for i in range(11)] + [("b", i) for i in range(10)] + [("c", i) for i in range(9)], "contig string, pos bigint")
    assert rows(sites.cpg_spans(df)) == [("a", 28), ("a", 28), ("b", 10)]


def test_histogram_edges(spark, rows):
    df = spark.createDataFrame([("a", 0.0), ("a", 10.0), ("b", 5.0)], "g string, x double")
    got = rows(sites.histogram(df, "g", "x", 2))
    assert got == [("a", 0, 0.0, 5.0, 1), ("a", 1, 5.0, 10.0, 1), ("b", 0, 0.0, 5.0, 0), ("b", 1, 5.0, 10.0, 1)]
    assert rows(sites.histogram(df.where("x = 5"), "g", "x", 2)) == [("b", 0, 5.0, 5.0, 1)]
    few = spark.createDataFrame([("a", 0.0), ("a", 1.0), ("a", 1000.0)], "g string, x double")
    assert sites.without_outliers(few, "g", "x").count() == 3


OLIGO = "AAGGTGCAATCAGGTGTCAGTCTTAAAGGATCGATAAGGAAGCGGAA"


def test_motif(spark):
    t = OLIGO.replace("C", "T")
    cases = {"GGG" + t: ("hit", 3), OLIGO: ("hit", 0), t.replace("GG", "GA", 1): ("none", None), OLIGO.replace("C", "A", 1): ("none", None), t + t: ("ambiguous", None), "AC": ("too_short", None)}
    df = spark.createDataFrame([(k,) for k in cases], "s string").select("s", patterns.motif_place(F.col("s"), OLIGO).alias("m"))
    assert {r.s: (r.m.status, r.m.place) for r in df.collect()} == cases


def test_site_conversion(spark, rows):
    df = spark.createDataFrame([("xACAGC",), ("ATAGC",), ("ATAGT",), ("AGAGC",)], "seq string")
    assert rows(reads.site_conversion(df, "ACAGC", [1, 4])) == [(1, 1, 2, 0, 2 / 3 * 100), (4, 2, 1, 0, 1 / 3 * 100)]


def edit(a, b):
    prev = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        prev = _row(prev, x, b, i)
    return prev[-1]


def _row(prev, x, b, i):
    row = [i]
    for j, y in enumerate(b, 1):
        row.append(min(prev[j] + 1, row[-1] + 1, prev[j - 1] + (x != y)))
    return row


def test_indel_search_finds_only_near_windows():
    r = random.Random(4)
    for _ in range(300):
        pattern = "".join(r.choice("ACGT") for _ in range(8))
        inner = list(pattern)
        k = r.randrange(1, 7)
        if r.random() < 0.5:
            del inner[k]
        else:
            inner.insert(k, r.choice("ACGT"))
        text = "".join(r.choice("ACGT") for _ in range(r.randint(0, 12))) + "".join(inner) + "".join(r.choice("ACGT") for _ in range(r.randint(0, 12)))
        at = patterns.nearest_place(text, pattern, 1)
        windows = {i for i in range(len(text)) for n in (7, 8, 9) if i + n <= len(text) and edit(text[i : i + n], pattern) <= 1}
        assert windows and (at is None or any(abs(at - w) <= 1 for w in windows))


def test_searches(spark):
    one = lambda c, s: spark.createDataFrame([(s,)], "s string").select(c).first()[0]
    s = F.col("s")
    assert one(patterns.exact_places(s, "AA"), "AAAxAA") == [0, 1, 4]
    assert one(patterns.leftmost_place(s, "ACGT", 1), "AGGTACGT") == 4 and one(patterns.leftmost_place(s, "ACGT", 1), "AGGTACCT") == 0
    assert one(patterns.leftmost_place(s, "ACGT", 1), "TTTTTT") is None and one(patterns.leftmost_place(s, "ACGT", 1), "AC") is None
    assert one(patterns.unique_place(s, "ANGT", 1), "xxATGTxACCT") == 2 and one(patterns.unique_place(s, "ACGT", 1), "ACGTACGT") is None


def demux(spark, layout, *seqs, **k):
    data = [(i, f"@r{i} x", s, "I" * len(s)) for i, s in enumerate(seqs)]
    listed = spark.createDataFrame([("AAAA",), ("AATT",), ("GGCC",)], "barcode string")
    return {r.row_id: r for r in reads.demultiplex(spark.createDataFrame(data, "row_id bigint, name string, seq string, qual string"), listed, layout).collect()}


def test_demultiplexing(spark):
    layout = reads.Layout("TGTGTGTG", "CATCATCAT", 4, 4)
    link, anchor = layout.linker, layout.anchor
    seqs = [
        f"AAAA{link}GGCC{anchor}ACGTACGT", "AAAA", "A" * 60, f"AA{link}GGCC{anchor}ACGTACGTTT", f"AAAA{link}GGCC{'G' * 60}", f"AAAA{link}TTTT{anchor}ACGT", f"TTTT{link}GGCC{anchor}ACGT",
        f"aaac{link}GGCC{anchor}acGT", f"AAAT{link}GGCC{anchor}ACGT", f"AAAA{link[:4]}{link[5:]}GGCC{anchor}ACGTA",
    ]
    got = demux(spark, layout, *seqs)
    assert [got[i].reason for i in range(10)] == [
        "kept", "short_r1", "linker2_not_found", "out_of_bounds", "tn5_not_found", "barcode1_not_in_whitelist", "barcode2_not_in_whitelist", "kept", "barcode2_not_in_whitelist", got[9].reason,
    ]
    assert (got[0].name, got[0].seq, got[0].qual) == ("@AAAAGGCC:r0 x", "ACGTACGT", "I" * 8)
    assert (got[7].barcode_b, got[7].seq) == ("AAAA", "acGT") and got[1].seq == "AAAA" and got[1].barcode_b is None


def test_neighbourhood(spark, rows):
    listed = spark.createDataFrame([("AA",), ("AT",), (" cc ",), (None,), ("",)], "barcode string")
    got = {r.seen: r.barcode for r in reads.neighbourhood(listed, 1).collect()}
    assert got["AA"] == "AA" and got["AT"] == "AT" and got["CC"] == "CC" and "AC" not in got and got["TA"] == "AA" and got["NT"] == "AT"


def test_umi(spark, rows):
    listed = spark.createDataFrame([("AAAA",), ("GGCC",)], "barcode string")
    data = [(0, "AAAATGTGTGTGGGCCTTACGTAC", "abcdefghijklmnopqrstuvwx"), (1, "AAAATGTGTGTGGGCCTT", "x" * 18), (2, "AAAATGTGTGTGGGCCAAACGTAC", "x" * 24), (3, "CCCC", "xxxx")]
    df = spark.createDataFrame(data, "row_id bigint, seq string, qual string")
    got = rows(reads.demultiplex_umi(df, listed, "TGTGTGTG", "TT", 6, 4))
    assert got == [(0, "kept", "AAAAGGCCACGTAC", "IIIIIIIIstuvwx"), (1, "umi_too_short", None, None), (2, "umi_left_not_found", None, None), (3, "linker_not_found", None, None)]


def test_summary_joins_fully(spark, rows):
    stats = spark.createDataFrame([("CCCCAAAA", 1)], "spot string, n_cg bigint")
    counts = spark.createDataFrame([("CCCCAAAA", 100), ("GGGGAAAA", 5)], "spot string, reads bigint")
    places = spots.positions(spark.createDataFrame([(1, "ccccaaaa", 9, 9), (2, "CCCCAAAA", 0, 1), (3, "GGGGAAAA", 2, 3), (4, "CCCCAAAA", None, 3)], "line_no int, barcode string, array_row int, array_col int"))
    assert rows(spots.spot_summary(stats, counts, places)) == [("CCCCAAAA", 1, 100, 0, 1), ("GGGGAAAA", None, 5, 2, 3)]


def test_formats(spark):
    df = spark.createDataFrame([(1234567.0,), (0.125,), (None,)], "x double")
    assert [r[0] for r in df.select(numbers.formatted(".2f")(F.col("x"))).collect()] == ["1234567.00", "0.12", "NA"]
    assert [r[0] for r in df.select(numbers.formatted(",")(F.col("x"))).collect()] == ["1,234,567", "0", "NA"]
    assert [r[0] for r in df.select(numbers.formatted(".6g")(F.col("x"))).collect()] == ["1.23457e+06", "0.125", "NA"]
    texts = spark.createDataFrame([("12",), (" 12.9 ",), ("1e3",), ("x",), ("NaN",), ("inf",), (None,)], "t string")
    assert [r[0] for r in texts.select(numbers.as_int(F.col("t"))).collect()] == [12, 12, 1000, None, None, None, None]


def test_selection(spark, rows):
    df = spark.createDataFrame([("a", "c1"), ("b", "c1"), (None, "c2")], "spot string, contig string")
    one = lambda *x: spark.createDataFrame([(v,) for v in x], "spot string")
    assert rows(spots.selected(df, one("a", "b", "b"), one("b")), "spot") == [("a",)] and spots.selected(df).count() == 2
    assert spots.only_contigs(df, df, ["c2"]).count() == 1
    with pytest.raises(ValueError, match="c9"):
        spots.only_contigs(df, df, ["c1", "c9"])
    stats = lambda *x: spark.createDataFrame(list(x), "spot string, n_cg bigint")
    assert rows(spots.resumed_stats(stats(("a", 1)), stats(("a", 9), ("b", 2)))) == [("a", 1), ("b", 2)]
    deep = spark.createDataFrame([("c", 1, f"r{i}", 99, 0) for i in range(5)], "contig string, pos bigint, name string, flag int, qpos int")
    assert rows(sites.with_depth_up_to(deep, 2), "name") == [("r0",), ("r1",)]


def test_merged_linker_conversion(spark, rows):
    parts = spark.createDataFrame([(10, 0.5, 0.2), (30, 1.0, 0.4), (5, None, 0.0)], "scored_reads bigint, mean_rate_fraction double, all_t_fraction double")
    r = reads.merged_linker_conversion(parts).first()
    assert r.scored_reads == 45 and math.isclose(r.mean_rate_fraction, 35 / 40) and math.isclose(r.all_t_fraction, 14 / 45)
    assert spots.capped_fraction(0.5, 40_000_000) == 0.25 and spots.capped_fraction(0.5, 0) == 0.5


def test_lists():
    assert parse_list(" a, b,,a ") == ["a", "b"]
    with pytest.raises(ValueError):
        parse_list(" , ")


def test_smoothing_across_stretches(spark):
    r = random.Random(3)
    data = {p: (r.randint(0, 5), r.randint(1, 5)) for p in r.sample(range((1 << 16) * 3), 4000)}
    df = cov(spark, *(("s", "c", p, "CG", m, u) for p, (m, u) in data.items()))
    for x in sites.smoothed(df, 40).collect():
        near = [m / (m + u) for p, (m, u) in data.items() if abs(p - x.pos) <= 40]
        assert math.isclose(x.smooth, sum(near) / len(near))
    assert sites.smoothed(df, 40).count() == len(data)


def test_regions_by_brute_force(spark, rows):
    r = random.Random(4)
    places = [(r.choice("ab"), r.randint(0, 60_000)) for _ in range(500)]
    regions = [(i, r.choice("ab"), s, s + r.randint(1, 30_000)) for i, s in enumerate(r.sample(range(50_000), 20))]
    got = sites.intervals_joined(spark.createDataFrame(places, "contig string, pos bigint"), spark.createDataFrame(regions, "region int, contig string, start bigint, end bigint"))
    want = [(i, c, p) for c, p in places for i, d, s, e in regions if c == d and s <= p < e]
    assert rows(got, "region", "contig", "pos") == sorted(want, key=repr)


LENGTHS = [1, 2, 63, 64, 65, 511, 512, 513, 4096, 4097, 40_000, 0, -5]


def _odd_regions(r):
    """Regions of all lengths, at borders of buckets, given twice, of several intervals and with nulls: region, contig, start, end."""
    starts = [-300, -64, -1, 0, 192, 193, 255, 256, 2047, 2048, 16_383, 16_384]
    some = [(r.choice("ab"), r.choice(starts), r.choice(LENGTHS)) for _ in range(150)]
    regions = [(i if i % 3 else i // 9, c, s, s + n) for i, (c, s, n) in enumerate(some)]
    return [*regions, *regions[:5], (None, "a", 10, 40), (900, None, 0, 500), (901, "a", None, 500), (902, "b", 0, None)]


@pytest.mark.parametrize("seed", [1, 2])
def test_region_matrix_by_brute_force(spark, rows, seed):
    r = random.Random(seed)
    regions = _odd_regions(r)
    places = [(r.choice("xyz"), r.choice(["a", "b", None]), r.choice([r.randint(-400, 3000), r.randint(-400, 60_000), 192, 255, 256, 319, 320, None]), r.randint(0, 3), r.randint(0, 3)) for _ in range(1500)]
    df = spark.createDataFrame(places, "spot string, contig string, pos bigint, meth bigint, unmeth bigint")
    want = {}
    for i, c, s, e in regions:
        for spot, d, p, m, u in places:
            if None not in (c, d, p, s, e) and c == d and s <= p < e:
                a = want.setdefault((i, spot), [0, 0])
                a[0], a[1] = a[0] + m, a[1] + m + u
    shape = "region int, contig string, start bigint, end bigint"
    got = sites.region_matrix(df, spark.createDataFrame(regions, shape))
    assert rows(got, "region", "spot", "meth", "cov", "frac") == sorted(((*k, m, n, m / n) for k, (m, n) in want.items() if n), key=repr)
    assert sites.region_matrix(df, spark.createDataFrame([], shape)).count() == 0


def test_pairs_of_short_regions_are_not_shuffled(spark):
    regions = spark.range(1000).selectExpr("id as region", "'c' as contig", "id * 7 as start", "id * 7 + 50 as end")
    places = spark.range(1000).selectExpr("'s' as spot", "'c' as contig", "id * 5 as pos", "id as meth", "id as unmeth")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = sites.region_matrix(places, regions)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("Exchange hashpartitioning(") == 2  # sites and regions


def _pairs_met(spark, joined):
    """The number of rows of the topmost join in a plan, before what is filtered after it."""
    node = joined._jdf.queryExecution().analyzed()
    while node.nodeName() != "Join":
        node = node.children().head()
    return spark._jvm.org.apache.spark.sql.classic.Dataset.ofRows(spark._jsparkSession, node).count()


def test_sites_meet_few_regions_that_they_are_not_in(spark):
    regions = spark.range(2000).selectExpr("id as region", "'c' as contig", "id * 7 as start", "id * 7 + 1 + id % 50 as end")
    places = spark.range(2000).selectExpr("'c' as contig", "id * 7 as pos")
    got = sites.intervals_joined(places, regions)
    assert got.count() > 2000
    assert _pairs_met(spark, got) < 20 * got.count()


@pytest.mark.parametrize("bucket", [100, 1 << 14])
def test_regions_of_all_lengths_by_brute_force(spark, rows, bucket):
    r = random.Random(5)
    regions = _odd_regions(r)
    places = [(r.choice(["a", "b", None]), r.choice([r.randint(-400, 3000), r.randint(-400, 60_000), 192, 255, 256, 319, 320, None])) for _ in range(800)]
    shape = "region int, contig string, start bigint, end bigint"
    df = spark.createDataFrame(places, "contig string, pos bigint")
    got = sites.intervals_joined(df, spark.createDataFrame(regions, shape), bucket)
    want = [(i, c, p) for c, p in places for i, d, s, e in regions if None not in (c, d, p, s, e) and c == d and s <= p < e]
    assert rows(got, "region", "contig", "pos") == sorted(want, key=repr)
    assert sites.intervals_joined(df, spark.createDataFrame([], shape), bucket).count() == 0
    assert set(got.columns) == {"contig", "pos", "region", "start", "end"}
