"""Rosters, reports, saturation over high-quality spots, exact quantiles, names, targets and the small read operators."""

import random

import pytest
from pyspark.sql import functions as F

from spotweave.functions import patterns
from spotweave.functions.text import name_spot
from spotweave.operators import reads, sites, spots
from spotweave.sources import tables


def test_roster_keeps_its_order_and_its_empty_spots(spark):
    roster = spark.createDataFrame([("C", 1), ("A", 2), (None, 0), ("C", 3), ("B", 4)], "spot string, ord int")
    stats = spark.createDataFrame([("A", 1.5), ("X", 9.0)], "spot string, mean double")
    assert [tuple(r) for r in spots.roster_stats(roster, stats).collect()] == [("C", 1, None), ("A", 2, 1.5), ("B", 4, None)]


def test_means_are_of_rounded_means(spark):
    stats = spark.createDataFrame([("s", 10.004, 3), ("s", 20.0, 1), ("s", None, 7), ("s", 5.0, 0), ("t", None, None)], "sample string, m double, n bigint")
    got = {r["sample"]: (r["m"], r["median_n"]) for r in spots.weighted_means(stats, {"m": "n"}, "sample").collect()}
    assert got == {"s": (12.5, 2.0), "t": (None, None)}


def test_report_has_text_and_na(spark, rows):
    totals = spark.createDataFrame([("s", 12345, 100), ("u", 0, None)], "sample string, raw bigint, kept bigint")
    means = spark.createDataFrame([("s", 1.005), ("t", 2.0)], "sample string, m double")
    got = spots.sample_report(totals, means, "sample", ["raw", "kept"], {"rate": ("kept", "raw")}, ["m"])
    assert rows(got) == [("s", "12,345", "100", "0.81%", "1.00"), ("t", "NA", "NA", "NA", "2.00"), ("u", "0", "NA", "NA", "NA")]


def test_saturation_of_spots_above_the_knee(spark):
    counts = [(f"p{i:03}", 1000 - 2 * i) for i in range(80)] + [(f"q{i:03}", int(800 * 2.718281828 ** (-0.08 * i)) + 15) for i in range(60)]
    df = spark.createDataFrame(counts, "spot string, reads bigint")
    cov = spark.createDataFrame([("p000", "c", i, "CG", 1, 1) for i in range(10)] + [("q059", "c", 1, "CG", 1, 0), ("p001", "c", 1, "CA", 1, 0)],
                                "spot string, contig string, pos bigint, context string, meth bigint, unmeth bigint")
    got = sites.hq_saturation(df, cov).orderBy("fraction").collect()
    assert len(got) == 13 and got[-1]["median"] == pytest.approx(10.0)
    assert got[0]["n_hq"] == sum(n > got[0]["threshold"] for _, n in counts) > 1  # most of them without sites
    assert sites.hq_saturation(df.limit(0), cov).count() == 0


@pytest.mark.parametrize("share", [0.0, 0.25, 0.5, 0.9, 1.0])
def test_exact_quantiles(spark, share):
    r = random.Random(3)
    values = [r.choice([r.gauss(0, 1), 0.5]) for _ in range(2000)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
    assert sites.exact_quantile(df, "v", share) == pytest.approx(df.agg(F.percentile("v", share)).first()[0], abs=1e-12)
    assert sites.exact_quantile(df.limit(0), "v", share) is None


def test_spans_over_neighbouring_sites(spark, rows):
    df = spark.createDataFrame([("a", p) for p in (1, 5, 9, 20)] + [("b", 1), (None, 7)], "contig string, pos bigint")
    assert rows(sites.cpg_spans(df, 3)) == [("a", 16), ("a", 9)]


def test_names_give_their_spot(spark):
    names = [("@ACGT:r1 1:N",), ("ACGT:r1",), ("@r1",), ("",), (None,)]
    assert [r[0] for r in spark.createDataFrame(names, "n string").select(name_spot("n")).collect()] == ["ACGT", "ACGT", None, None, None]


def test_pairs_with_an_anchor(spark, rows):
    listed = spark.createDataFrame([("AAAA", 0), ("CCCC", 1)], "barcode string, idx int")
    layout = reads.Layout("GGTTGG", "ACGTC", 4, 4, 1, 1, False)
    start = "CCCCGGTTGGAAAA"
    given = [(1, "@x", start + "ACGTCTTT"), (2, "@x", start + "TTTTTTTT"), (3, "@x", start + "TACGACTT"), (4, "@x", start + "ACGTCACGTC")]
    df = spark.createDataFrame([(i, n, s, "+", "I" * len(s)) for i, n, s in given], "row_id bigint, name string, seq string, plus string, qual string")
    df = df.withColumn("r2", F.struct("name", "seq", "plus", "qual"))
    got = reads.demultiplex(df, listed, layout)
    assert rows(got, "row_id", "reason", "name", "seq") == [
        (1, "kept", "@CCCCAAAA:x", "TTT"), (2, "tn5_not_found", "@x", start + "TTTTTTTT"), (3, "kept", "@CCCCAAAA:x", "TT"), (4, "tn5_not_found", "@x", start + "ACGTCACGTC"),
    ]
    assert {r["n"] for r in got.where("reason = 'kept'").select(F.col("r2.name").alias("n")).collect()} == {"@CCCCAAAA:x"}


def test_conversion_per_site_of_the_linker(spark, rows):
    df = spark.createDataFrame([("AATGCGTC",), ("AATGTGTC",), ("AATGAGTT",), ("CCCCCCCC",)], "seq string")
    assert rows(reads.linker_sites(df, "TGCGTC", 0, 8, 0)) == [(2, 1, 1, 1), (5, 1, 2, 0)]


def test_cells_are_two_listed_halves(spark, rows):
    listed = spark.createDataFrame([("AA", 0), ("CC", 1)], "barcode string, idx int")
    cells = spark.createDataFrame([("AACC",), ("AAGG",), ("AAC",)], "cell string")
    assert rows(reads.cell_index(cells, listed, 2)) == sorted([("AACC", 0, 1), ("AAGG", 0, None), ("AAC", None, None)], key=repr)
    assert rows(reads.cell_index(cells.where("cell = 'AACC'"), listed, 2, strict=True)) == [("AACC", 0, 1)]
    with pytest.raises(Exception, match="no listed cell: AA(GG|C)"):
        reads.cell_index(cells, listed, 2, strict=True).collect()


def test_small_read_operators(spark, rows):
    sites_ = spark.createDataFrame([(0, 1, 3, 75.0), (1, 4, 0, 0.0), (2, 9, 9, 50.0)], "site int, retained bigint, converted bigint, rate double")
    assert rows(reads.mean_conversion(sites_, [0, 1])) == [(37.5, 37.5)]
    df = spark.createDataFrame([("b", 1, "ATT"), ("a", 2, "ATC"), ("a", 1, "TTT")], "file string, ord int, seq string").withColumn("p", F.lit(1))
    assert rows(reads.all_converted(df, "p", [0, 1]), "seq") == [("ATT",), ("TTT",)]
    assert [r.seq for r in reads.first_reads(df, 2, "file", "ord").collect()] == ["TTT", "ATC"]


def test_many_mismatches_compare_every_window(spark):
    df = spark.createDataFrame([("TTTT" + "ACGTACGTACGTACGTACGTACGT".replace("ACG", "TTG", 2) + "A",), ("T" * 40,), ("",)], "s string")
    got = df.select(patterns.leftmost_place(F.col("s"), "ACGTACGTACGTACGTACGTACGT", 4)).collect()
    assert [r[0] for r in got] == [4, None, None]


def test_targets_are_counted_by_spot_only_in_the_host(spark, rows):
    calls = spark.createDataFrame([("s", "h", 1, "CG", None, True), ("t", "h", 1, "CG", None, False), ("s", "m", 1, "CG", None, True), ("t", "m", 1, "CG", None, False), ("s", "x", 1, "CG", None, True)],
                                  "spot string, contig string, pos bigint, context string, strand string, methylated boolean")
    targets = spark.createDataFrame([("h", "host"), ("m", "mito")], "contig string, target string")
    assert rows(sites.coverage_by_target(calls, targets), "target", "spot", "meth", "unmeth") == [("host", "s", 1, 0), ("host", "t", 0, 1), ("mito", None, 1, 1)]


def test_order_of_contigs(spark):
    a = spark.createDataFrame([("c1", 5), ("c2", 1)], "contig string, pos int")
    b = spark.createDataFrame([("c1", 2, "x"), ("c9", 1, "y")], "contig string, pos int, extra string")
    contigs = spark.createDataFrame([("c2", 0), ("c1", 1)], "contig string, ord int")
    assert [tuple(r) for r in sites.in_contig_order([a, b], contigs).collect()] == [("c2", 1, None), ("c1", 2, "x"), ("c1", 5, None), ("c9", 1, "y")]


def test_spikes_and_their_reports(spark, tmp_path, rows):
    assert tables.spike_names(["pooled.host.sorted.bam", "pooled.byCB.sorted.bam", "pooled.lambda.sorted.bam", "puc.CG.cov", "host_mito.CG.cov", "x.txt"]) == ["lambda", "puc"]
    (tmp_path / "a.json").write_text('{"name": " o1 ", "reads_matched": "12", "mean_conversion_rate": 3.5}')
    (tmp_path / "b.json").write_text('{"name": ""}')
    (tmp_path / "c.json").write_text("none")
    assert rows(tables.spike_reports(spark, str(tmp_path)).drop("path")) == [("o1", 12, 3.5)]
    df = spark.createDataFrame([("s", " 0.5 "), ("s", "0.7"), ("t", " ")], "sample_id string, rate string")
    assert [tables.sample_value(df, s, "rate") for s in ("s", "t", "u")] == ["0.5", None, None]
