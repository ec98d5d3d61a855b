import random

import pytest
from pyspark.sql import functions as F

from spotweave.llm import cutoff


def by_hand(values, permille):
    values = [v for v in values if v is not None]
    for t in sorted(set(values), reverse=True):
        n = sum(v >= t for v in values)
        if 1000 * n >= permille * len(values):
            return t, n
    return None


def test_against_sorting(spark, rows):
    r = random.Random(3)
    groups = {
        "ties": [r.choice([0, 1, 1, 1, 500]) for _ in range(400)],
        "wide": [int(10 ** r.uniform(0, 15)) for _ in range(500)],
        "signed": [r.randint(-5000, 5000) for _ in range(300)],
        "ends": [-(2**63), 2**63 - 1, 0, None, None],
        "one": [7],
        "nulls": [None, None],
        "untold": [1, 2],
    }
    data = [(g, v) for g, vs in groups.items() for v in vs] + [(None, 3)] * 5
    records = spark.createDataFrame(data, "grp string, value bigint")
    for permille in (0, 1, 137, 500, 999, 1000):
        targets = spark.createDataFrame([(g, permille) for g in groups if g != "untold"] + [("untold", None), ("absent", 5), (None, 5)], "grp string, permille int")
        expect = [(g, *by_hand(vs, permille)) for g, vs in groups.items() if g not in ("nulls", "untold")]
        assert rows(cutoff.cutoffs(records, targets)) == sorted(expect, key=repr)
        assert rows(cutoff.cutoffs(records, targets, broadcast_rows=0)) == sorted(expect, key=repr)


def test_edges(spark):
    records = spark.createDataFrame([("a", 1)], "grp string, value bigint")
    assert cutoff.cutoffs(records, spark.createDataFrame([("a", 1001)], "grp string, permille int")).count() == 0
    assert cutoff.cutoffs(records.limit(0), spark.createDataFrame([("a", 5)], "grp string, permille int")).count() == 0
    assert cutoff.cutoffs(records, spark.createDataFrame([], "grp string, permille int")).count() == 0


@pytest.mark.parametrize("low", [0, 2**31, 2**53 - 500, 2**62])
def test_buckets_never_fall(spark, low):
    df = spark.range(low, low + 1000).select("id", cutoff.bucket(F.col("id")).alias("b"), cutoff.bucket(-F.col("id")).alias("m")).orderBy("id").collect()
    assert all(x.b <= y.b and x.m >= y.m for x, y in zip(df, df[1:]))


def test_latest(spark, rows):
    df = spark.createDataFrame([(1, 5, "a", 1), (1, 6, None, None), (2, 5, "a", 1), (2, 5, "a", 2), (3, None, "z", 9)], "id int, at int, s string, n int")
    assert rows(cutoff.latest(df, "id", "at", "s", "n")) == [(1, None, None), (2, "a", 2), (3, "z", 9)]
