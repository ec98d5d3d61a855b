import pytest
from pyspark.sql import functions as F

from spotweave.operators import drift

SCHEMA = "file_id bigint, grp string, written_at bigint, received_at bigint, content string, names string"


def parsed(spark, *files):
    data = [(i, g, w, w, t, "clash") for i, g, w, t in files]
    return drift.read_files(spark.createDataFrame(data, SCHEMA))


def test_changes(spark, rows):
    p = parsed(
        spark,
        (1, "S", 10, "barcode\tm\tn\tq\nAC\t1.5\t7\tx\nGT\tNA\t8\ty\n"),
        (2, "S", 20, "n\tBarcode\tmm \tz\r\n7\tac\t1.5\t1\r\n8\tgt\t.\t2\r\n\r\n9\tTT\t5\t3"),  # m renamed, q gone, z new
        (3, "S", 30, "barcode\tn\tmm\tz\nAC\t\t2\t1\nGT\tnull\t3\t2\n"),  # n without values keeps its type, mm is integer now
        (4, "S", 40, "barcode\tn\tmm\tz\nAC\t7.0\t2\t0x1\n"),  # n decimal, z text
        (9, "T", 5, "barcode\tother\nAC\t1\n"),
        (2, "S", 20, "n\tBarcode\tmm \tz\r\n7\tac\t1.5\t1\r\n8\tgt\t.\t2\r\n\r\n9\tTT\t5\t3"),
    )
    assert rows(drift.changes(p)) == sorted(
        [(2, "renamed", "m", "mm"), (2, "removed", "q", ""), (2, "added", "", "z"), (3, "retyped", "mm", "mm"), (4, "retyped", "n", "n"), (4, "retyped", "z", "z")], key=repr
    )


def test_types_are_carried_through_empty_files_and_renames(spark, rows):
    p = parsed(
        spark,
        (1, "S", 1, "barcode\ta\nX\t1\n"),
        (2, "S", 2, "barcode\ta\nX\t\n"),
        (3, "S", 3, "barcode\tb\nX\tNA\n"),
        (4, "S", 4, "barcode\tb\nX\t.\n"),
        (5, "S", 5, "barcode\tb\nX\t2.5\n"),
        (6, "S", 6, "barcode\tb\tc\nX\t2.5\t\n"),
        (7, "S", 7, "barcode\tb\tc\nX\t2.5\t3\n"),  # c had no type before
    )
    assert rows(drift.changes(p)) == sorted([(3, "renamed", "a", "b"), (5, "retyped", "b", "b"), (6, "added", "", "c")], key=repr)


def test_no_shared_row_shows_no_rename(spark, rows):
    p = parsed(spark, (1, "S", 1, "barcode\ta\nX\t1\n"), (2, "S", 2, "barcode\tb\nY\t1\n"))
    assert rows(drift.changes(p)) == [(2, "added", "", "b"), (2, "removed", "a", "")]


def test_null_and_empty_files(spark, rows):
    p = parsed(spark, (1, "S", 1, None), (2, "S", 2, ""), (3, "S", 3, "barcode\ta\nX\t1"), (4, None, 4, "barcode\tb\nX\t1"), (5, None, 5, "﻿barcode\tb\nX\t1"))
    assert rows(drift.changes(p)) == [(3, "added", "", "a")]
    assert drift.changes(parsed(spark, (1, "S", 1, None)).limit(0)).count() == 0


def test_one_table(spark, rows):
    p = parsed(
        spark,
        (1, "S", 1, "barcode\tmean_5mCG\tcpg_site_count\nAC\t81.5\t1,234\nAC\t80%\t12 sites\nGT\tNA\t0x10\n"),
        (2, "S", 2, "barcode\tpct\tcpg_site_count\nAC\t80%\t+7\nGT\t\todd\n"),
    )
    got = drift.unified(p, ["mean_5mCG", "cpg_site_count"], {"cpg_site_count"})
    assert rows(got, "file_id", "version", "key", "mean_5mCG", "cpg_site_count", "n_uncast") == [
        (1, 1, "AC", 80.0, 12, 0), (1, 1, "GT", None, 16, 0), (2, 2, "AC", 80.0, 7, 0), (2, 2, "GT", None, None, 1),
    ]


@pytest.mark.parametrize(
    ("text", "number"),
    [("1.5", 1.5), (" +3 ", 3.0), ("1e3", 1000.0), (".5", 0.5), ("3,29", 3.29), ("1,234", 1234.0), ("1,234,567.5", 1234567.5), ("5%", 5.0), ("~7", 7.0), ("<3", 3.0), ("9 sites", 9.0), ("0x1F", 31.0), ("r4", None), ("NaN", None), ("", None), ("inf", None)],
)
def test_casts(spark, text, number):
    assert spark.createDataFrame([(text,)], "t string").select(drift.as_number(F.col("t"))).first()[0] == number


def test_columns_find_their_field_by_any_name_or_by_an_alias(spark, rows):
    p = parsed(
        spark,
        (1, "S", 1, "barcode\tmCG\todd\nAC\t81.5\t1\nGT\t3\t2\n"),  # first called otherwise, later by its name
        (2, "S", 2, "barcode\tmean_5mCG\todd\nAC\t81.5\t1\nGT\t3\t2\n"),
        (3, "S", 3, "barcode\tmean_5mCG\todd\nAC\t81.5\t1\nGT\t3\t2\n"),  # nothing changed
        (7, "T", 1, "barcode\tmCG\nAC\t7\n"),  # an alias proven in S
        (8, "U", 1, "barcode\tmCG\tMean_5mCG\nAC\t7\t9\n"),  # the name itself is nearer
    )
    found = drift.compared(p)
    assert rows(drift.file_columns(found, ["mean_5mCG"])) == sorted([
        (1, "mCG", "mean_5mcg", "renamed"), (1, "odd", None, "unknown"), (2, "mean_5mCG", "mean_5mcg", "name"), (2, "odd", None, "unknown"),
        (3, "mean_5mCG", "mean_5mcg", "name"), (3, "odd", None, "unknown"), (7, "mCG", "mean_5mcg", "alias"), (8, "mCG", None, "shadowed"), (8, "Mean_5mCG", "mean_5mcg", "name"),
    ], key=repr)
    assert rows(found.seen.files, "file_id", "version") == [(1, 1), (2, 2), (3, 2), (7, 1), (8, 1)]
    got = drift.unified(p, ["mean_5mCG"], set())
    assert rows(got.where("key = 'AC'"), "file_id", "mean_5mCG", "n_unmapped") == [(1, 81.5, 1), (2, 81.5, 1), (3, 81.5, 1), (7, 7.0, 0), (8, 9.0, 1)]
    assert rows(drift.steps(found)) == [(2, "S", 2, "renamed", "mCG", "mean_5mCG", "decimal", "decimal")]
    nothing = drift.compared(p.limit(0))
    assert drift.file_columns(nothing, ["mean_5mCG"]).count() == 0 and drift.steps(nothing).count() == 0
