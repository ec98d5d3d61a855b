"""Queries that do the whole of what an older query does in part."""

import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the test tables")
QUERIES = entry.queries()


def found(spark, name, *columns):
    return {tuple(r) for r in QUERIES[name](spark, "/root/testdata/sf0.01").select(*columns).collect()}


@pytest.mark.parametrize("name, shift", [("mbias", 90), ("mbias_by_strand", 0)])
def test_cycles_over_60_are_counted(spark, name, shift):
    cols = ["read", "cycle", "meth", "unmeth"]
    part, whole = found(spark, name, *cols), found(spark, f"{name}_all_cycles", *cols)
    moved = {(read, cycle + (shift if read == "R1" else 0), *rest) for read, cycle, *rest in part}
    assert moved < whole  # R1 is aligned to its right end, which moves from 60 to 150
    left = whole - moved
    assert any(r == "R2" and c > 60 for r, c, *_ in left) and any(r == "R1" and (c > 60 if not shift else c <= 90) for r, c, *_ in left)


def test_both_halves_are_looked_up(spark, tmp_path):
    counts = [(" aaaaaaaaaaccccccccct ",), ("AAAAAAAAAACCCCCCCCCC",), ("CCCCCCCCCCGGGGGGGGGG",), ("AAAAAAAAAA",), (None,)]
    spark.createDataFrame(counts, "barcode string").write.parquet(str(tmp_path / "spot_counts.parquet"))
    spark.createDataFrame([("AAAAAAAAAA",), ("CCCCCCCCCC",)], "barcode string").write.parquet(str(tmp_path / "barcode_whitelist.parquet"))
    df = QUERIES["whitelist_nearest_halves"](spark, str(tmp_path))
    assert sorted(map(tuple, df.select("seen", "barcode", F.col("distance")).collect())) == [
        ("AAAAAAAAAA", "AAAAAAAAAA", 0), ("CCCCCCCCCC", "CCCCCCCCCC", 0), ("CCCCCCCCCT", "CCCCCCCCCC", 1)
    ]
