import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from spotweave.functions.text import spot_key
from spotweave.operators import skew


@pytest.fixture(scope="module")
def counts(spark, tmp_path_factory):
    r = random.Random(5)
    data = []
    for i in range(3000):
        key = "hot" if r.random() < 0.4 else r.choice(["a", " A", "b", None, "c"])
        at = dt.datetime(2025, 1, 1) + dt.timedelta(seconds=r.randint(0, 500))
        data.append((key, None if r.random() < 0.1 else r.randint(0, 9), at, i % 700, r.choice(["x", "y", None])))
    df = spark.createDataFrame(data, "barcode string, reads bigint, at timestamp, id bigint, label string")
    path = str(tmp_path_factory.mktemp("counts") / "t")
    df.repartition(5).write.parquet(path)
    return spark.read.parquet(path), data


def norm(k):
    return None if k is None else k.strip().upper()


@pytest.mark.parametrize("chunk", [1, 7, 100, None])
def test_totals(counts, rows, chunk):
    df, data = counts
    want = {}
    for k, v, *_ in data:
        want.setdefault(norm(k), []).append(v)
    for given in (df, df.repartition(3)):  # a scan, and rows that have no place in a file
        got = skew.key_totals(given, spot_key("barcode"), F.col("reads"), chunk)
        expect = [(k, len(v), len([x for x in v if x is not None]), sum(x or 0 for x in v), min(x for x in v if x is not None), max(x for x in v if x is not None)) for k, v in want.items()]
        assert rows(got) == sorted(expect, key=repr)


def test_numbers_are_exact(counts):
    df, _ = counts
    got = skew.numbered(df, spot_key("barcode"), {}).rows.groupBy("_key").agg(F.count("*").alias("n"), F.countDistinct("_n").alias("d"), F.min("_n").alias("lo"), F.max("_n").alias("hi"))
    assert all(r.n == r.d == r.hi + 1 and r.lo == 0 for r in got.collect())


@pytest.mark.parametrize("chunk", [1, 13, None])
def test_runs(counts, rows, chunk):
    df, data = counts
    at = F.unix_seconds("at")
    tie = F.struct("id", F.coalesce("reads", F.lit(-1)), F.coalesce("label", F.lit("")))
    got = skew.key_runs(df, spot_key("barcode"), at, tie, F.col("label"), chunk)
    groups = {}
    for k, v, t, i, label in data:
        groups.setdefault(norm(k), []).append(((t - dt.datetime(2025, 1, 1)).total_seconds(), i, -1 if v is None else v, label or "", label))
    expect = []
    for k, g in groups.items():
        g.sort(key=lambda x: x[:4])
        runs = 1 + sum(a[4] != b[4] for a, b in zip(g, g[1:]))
        expect.append((k, len(g), runs, int(max(b[0] - a[0] for a, b in zip(g, g[1:])))))
    assert rows(got) == sorted(expect, key=repr)


def test_hot_keys(counts, rows):
    df, _ = counts
    assert [r.key for r in skew.hot_keys(df, spot_key("barcode"), F.col("reads"), 3).collect()] == ["HOT"]


def test_edges(spark, rows):
    empty = spark.createDataFrame([], "barcode string, reads bigint")
    assert skew.key_totals(empty, F.col("barcode"), F.col("reads")).count() == 0
    assert skew.hot_keys(empty, F.col("barcode"), F.col("reads"), 2).count() == 0
    odd = spark.createDataFrame([("a", None, 1), ("a", None, 1), ("x" * 100_000, 3, 1)], "_key string, _n bigint, _part int")
    assert rows(skew.key_totals(odd, F.col("_key"), F.col("_n"))) == sorted([("a", 2, 0, None, None, None), ("x" * 100_000, 1, 1, 3, 3, 3)], key=repr)
    one = spark.createDataFrame([("a", 1)], "barcode string, reads bigint")
    assert rows(skew.key_runs(one, F.col("barcode"), F.col("reads"), F.lit(1), F.lit("x"))) == [("a", 1, 1, None)]


def test_a_hot_key_has_several_chunks_by_itself(spark, counts):
    df, data = counts
    cut = skew.numbered(df.unionAll(df).unionAll(df).unionAll(df), spot_key("barcode"), {})
    assert cut.total == 4 * len(data)
    sizes = cut.chunked().where("_key = 'HOT'").groupBy("_chunk").count().collect()
    assert len(sizes) > 2 and max(r["count"] for r in sizes) <= skew.chunk_size(spark, cut.total)


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.1"), reason="needs the test tables")
def test_the_hot_barcodes_are_cut(spark):
    cut = skew.numbered(spark.read.parquet("/root/testdata/sf0.1/spot_counts.parquet"), spot_key("barcode"), {})
    chunks = cut.chunked().groupBy("_key").agg(F.count(F.lit(1)).alias("n"), F.max("_chunk").alias("last"))
    hot = chunks.where((F.col("n") * 50 > cut.total) & F.col("_key").isNotNull()).collect()
    assert len(hot) == 8 and max(r["last"] for r in hot) >= 1
    assert all(r["last"] == (r["n"] - 1) // skew.chunk_size(spark, cut.total) for r in hot)


@pytest.mark.parametrize("chunk", [1, 3, 100])
def test_running_totals(spark, rows, chunk):
    df = spark.createDataFrame([(k, i, i % 3) for i in range(20) for k in ("a", None)], "k string, i bigint, v bigint")
    got = skew.running_total(skew.numbered_in_order(df, F.col("k"), {"i": F.col("i")}, {"v": F.col("v")}).rows, "v", "upto", chunk)
    assert rows(got, "_key", "i", "upto") == sorted([(k, i, sum(j % 3 for j in range(i + 1))) for i in range(20) for k in ("a", None)], key=repr)
