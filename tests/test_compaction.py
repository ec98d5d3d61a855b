import pytest
from pyspark.sql import functions as F

from spotweave.operators import compaction as c

SCHEMA = "file_id bigint, sample_id string, chunk_id int, n_bytes bigint, content string, extra string"


def files(spark, *given):
    return spark.createDataFrame([(i, s, k, len(t or ""), t, "x") for i, s, k, t in given], SCHEMA)


@pytest.fixture
def table(spark, tmp_path):
    return c.SnapshotTable(spark, str(tmp_path / "t"))


def run(df, table, **k):
    parted = c.with_parts(df)
    c.compact(parted, table, k.pop("max_small_files", 1), 1 << 20, **k)
    return parted, c.all_records(parted, table)


def test_records_once_with_their_first_file(spark, table, rows):
    df = files(
        spark,
        (3, "S", 1, "barcode\treads\nAC\t5\n"),
        (1, "S", 1, " Reads \tx\tBARCODE\r\n007\tq\t ac \r\n\r\n5\tq\tac\r\nbad\tq\tAC\r\n9\r\n"),
        (2, "S", 2, "barcode\treads\nAC\t5\nAC\t5"),
        (4, None, None, "barcode\treads\nAC\t5"),
        (5, None, None, "barcode\treads\nac\t5"),
        (6, "S", 1, ""),
        (7, "S", 1, None),
        (8, "S", 1, "nothing\there\nAC\t5"),
        (6, "S", 1, ""),
    )
    parted, found = run(df, table)
    assert rows(found, *c.RECORD, "file_id") == sorted([("S", 1, "AC", 7, 1), ("S", 1, "AC", 5, 1), ("S", 2, "AC", 5, 2), (None, None, "AC", 5, 4)], key=repr)
    assert rows(c.adding_nothing(parted, found)) == [(3,), (5,), (6,), (7,), (8,)]


def test_only_partitions_with_many_small_files_are_rewritten(spark, table, rows):
    df = files(spark, (1, "A", 1, "barcode\treads\nAC\t1"), (2, "A", 1, "barcode\treads\nAC\t2"), (3, "B", 1, "barcode\treads\nAC\t3"))
    parted = df.withColumn("part", F.when(F.col("sample_id") == "A", 0).otherwise(1))
    done = c.compact(parted, table, 1, 1 << 20)
    assert rows(done, "part", "n_files") == [(0, 2)]
    assert rows(table.read(), "reads") == [(1,), (2,)]
    assert rows(c.all_records(parted, table), "reads") == [(1,), (2,), (3,)]


def test_unchanged_partitions_are_left_alone_and_new_files_are_taken_up(spark, table, rows):
    first = files(spark, (1, "A", 1, "barcode\treads\nAC\t1"), (2, "A", 1, "barcode\treads\nAC\t2")).withColumn("part", F.lit(0))
    c.compact(first, table, 1, 1 << 20)
    assert table.version() == 1
    assert c.compact(first, table, 1, 1 << 20).count() == 0 and table.version() == 1
    more = first.unionByName(files(spark, (9, "A", 1, "barcode\treads\nAC\t9")).withColumn("part", F.lit(0)))
    c.compact(more, table, 1, 1 << 20)
    assert table.version() == 2 and rows(table.read(), "reads") == [(1,), (2,), (9,)]


def test_two_runs_cannot_write_one_version(spark, table):
    df = files(spark, (1, "A", 1, "barcode\treads\nAC\t1"), (2, "A", 1, "barcode\treads\nAC\t2")).withColumn("part", F.lit(0))
    assert table.claim(0) == 1
    other = c.SnapshotTable(spark, table.path)
    with pytest.raises(c.ConflictError):
        c.compact(df, other, 1, 1 << 20)
    other.release(1)  # not its own
    with pytest.raises(c.ConflictError):
        other.claim(0)
    assert table.version() == 0
    table.release(1)
    c.compact(df, other, 1, 1 << 20)
    with pytest.raises(c.ConflictError):
        table.claim(0)


def test_a_failed_run_gives_up_its_claim(spark, table):
    df = files(spark, (1, "A", 1, "barcode\treads\nAC\t1"), (2, "A", 1, "barcode\treads\nAC\t2")).withColumn("part", F.lit(0))
    with pytest.raises(Exception, match="broken"):
        c.compact(df.withColumn("content", F.raise_error(F.lit("broken")).cast("string")), table, 1, 1 << 20)
    assert c.compact(df, table, 1, 1 << 20).count() == 1 and table.version() == 1


def test_large_partitions_become_several_files(spark, table, tmp_path):
    text = "barcode\treads\n" + "".join(f"AC\t{i}\n" for i in range(500))
    df = files(spark, (1, "A", 1, text), (2, "A", 1, text)).withColumn("part", F.lit(0))
    c.compact(df, table, 1, 1 << 20, target_bytes=len(text) // 6 + 1)
    assert len(list((tmp_path / "t").glob("run=*/part=0/*.parquet"))) == 2
    assert table.read().count() == 500


def test_empty(spark, table):
    parted, found = run(spark.createDataFrame([], SCHEMA), table)
    assert found.count() == 0 and c.adding_nothing(parted, found).count() == 0


def test_clashing_columns(spark, table, rows):
    clash = {n: F.lit(7) for n in ("reads", "barcode", "lines", "line", "slices", "first", "part", "n_small", "fingerprint", "text")}
    df = files(spark, (1, "S", 1, "barcode\treads\nAC\t5\n"), (2, "S", 1, "barcode\treads\nAC\t5\n")).withColumns(clash)
    parted, found = run(df, table)
    assert rows(found, *c.RECORD, "file_id") == [("S", 1, "AC", 5, 1)] and rows(c.adding_nothing(parted, found)) == [(2,)]


def test_files_newer_than_the_table_are_read(spark, table, rows):
    first = files(spark, (1, "A", 1, "barcode\treads\nAC\t1"), (2, "A", 1, "barcode\treads\nAC\t2")).withColumn("part", F.lit(0))
    c.compact(first, table, 1, 1 << 20)
    more = first.unionByName(files(spark, (9, "A", 1, "barcode\treads\nAC\t9\nAC\t2")).withColumn("part", F.lit(0)))
    assert rows(c.all_records(more, table), "reads", "file_id") == [(1, 1), (2, 2), (9, 9)]
    assert rows(c.all_records(first, table), "reads", "file_id") == [(1, 1), (2, 2)]
    assert c.compact(more, table, 5, 1 << 20).count() == 0  # few enough small files to stay as they are
    assert rows(c.all_records(more, table), "reads", "file_id") == [(1, 1), (2, 2), (9, 9)]


def test_nothing_is_read_of_a_run_that_failed_to_commit(spark, table, rows, monkeypatch, tmp_path):
    first = files(spark, (1, "A", 1, "barcode\treads\nAC\t1"), (2, "A", 1, "barcode\treads\nAC\t2")).withColumn("part", F.lit(0))
    c.compact(first, table, 1, 1 << 20)
    more = first.unionByName(files(spark, (9, "A", 1, "barcode\treads\nAC\t9")).withColumn("part", F.lit(0)))
    more = more.unionByName(files(spark, (4, "B", 1, "barcode\treads\nAC\t4"), (5, "B", 1, "barcode\treads\nAC\t5")).withColumn("part", F.lit(1)))
    with monkeypatch.context() as m:
        m.setattr(c.SnapshotTable, "commit", lambda *_: (_ for _ in ()).throw(RuntimeError("died")))
        with pytest.raises(RuntimeError, match="died"):
            c.compact(more, table, 1, 1 << 20)
    assert rows(table.read(), "reads") == [(1,), (2,)]
    assert rows(c.all_records(first, table), "reads") == [(1,), (2,)]
    assert rows(c.all_records(more, table), "reads") == [(1,), (2,), (4,), (5,), (9,)]
    c.compact(more, table, 1, 1 << 20)
    assert rows(table.read(), "reads") == rows(c.all_records(more, table), "reads") == [(1,), (2,), (4,), (5,), (9,)]
    last = more.unionByName(files(spark, (6, "B", 1, "barcode\treads\nAC\t6")).withColumn("part", F.lit(1)))
    c.compact(last, table, 1, 1 << 20)
    assert rows(table.read(), "reads") == [(1,), (2,), (4,), (5,), (6,), (9,)]
    c.compact(last.unionByName(files(spark, (7, "B", 1, "barcode\treads\nAC\t7")).withColumn("part", F.lit(1))), table, 1, 1 << 20)
    left = [(p.parent.parent.name.split("-")[0], p.parent.name) for p in (tmp_path / "t").glob("run=*/part=*/*.parquet")]
    assert sorted(left) == [("run=2", "part=0"), ("run=3", "part=1"), ("run=4", "part=1")]  # of the last two versions


def test_a_table_keeps_its_number_of_partitions(spark, table, rows):
    text = "barcode\treads\nAC\t1"
    few = files(spark, *((i, f"S{i}", i, text) for i in range(4)))
    many = files(spark, *((i, f"S{i}", i, text) for i in range(40)))
    size = 2 * len(text)
    before = {(r["file_id"], r["part"]) for r in c.with_parts(few, size, table, 1).collect()}
    after = {(r["file_id"], r["part"]) for r in c.with_parts(many, size, table, 1).collect()}
    assert before <= after and {p for _, p in after} <= {0, 1}


def test_a_growing_table_keeps_each_record_once(spark, table, rows):
    text = "barcode\treads\nAC\t{}\n"
    given = [(i, f"S{i % 7}", i % 5, text.format(i)) for i in range(200)]
    for n in (60, 200):
        parted = c.with_parts(files(spark, *given[:n]), 10 * len(text), table, 1)
        c.compact(parted, table, 1, 1 << 20)
        assert table.read().count() == n == c.all_records(parted, table).count()


def test_a_file_sent_again_with_another_content_is_read(spark, table, rows):
    put = lambda n: files(spark, (1, "A", 1, f"barcode\treads\nAC\t{n}"), (2, "A", 1, "barcode\treads\nAC\t2")).withColumn("part", F.lit(0))
    c.compact(put(1), table, 1, 1 << 20)
    assert rows(c.all_records(put(7), table), "reads") == [(2,), (7,)]
    assert c.compact(put(7), table, 1, 1 << 20).count() == 1 and rows(table.read(), "reads") == [(2,), (7,)]


def test_a_partition_without_files_leaves_the_table(spark, table, rows):
    a = files(spark, (1, "A", 1, "barcode\treads\nAC\t1"), (2, "A", 1, "barcode\treads\nAC\t2")).withColumn("part", F.lit(0))
    b = files(spark, (3, "B", 1, "barcode\treads\nAC\t3"), (4, "B", 1, "barcode\treads\nAC\t4")).withColumn("part", F.lit(1))
    c.compact(a.unionByName(b), table, 1, 1 << 20)
    assert rows(c.all_records(b, table), "reads") == [(3,), (4,)]
    c.compact(b, table, 1, 1 << 20)
    assert table.version() == 2 and rows(table.read(), "reads") == [(3,), (4,)]


def test_an_expired_claim_is_taken_over_and_only_one_run_commits(spark, table, rows, monkeypatch):
    df = files(spark, (1, "A", 1, "barcode\treads\nAC\t1"), (2, "A", 1, "barcode\treads\nAC\t2")).withColumn("part", F.lit(0))
    assert table.claim(0) == 1  # and dies
    other = c.SnapshotTable(spark, table.path)
    real = c._rewrite

    def late(*given):
        real(*given)
        monkeypatch.setattr(c, "_rewrite", real)
        assert c.compact(df, c.SnapshotTable(spark, table.path), 1, 1 << 20, expires=-1).count() == 1  # overtakes it

    monkeypatch.setattr(c, "_rewrite", late)
    with pytest.raises(c.ConflictError):
        c.compact(df, other, 1, 1 << 20, expires=-1)
    assert table.version() == 1 and rows(table.read(), "reads") == [(1,), (2,)]


def test_two_runs_at_one_time(spark, table, rows):
    from concurrent.futures import ThreadPoolExecutor

    df = files(spark, *((i, "A", 1, f"barcode\treads\nAC\t{i}") for i in range(20))).withColumn("part", F.lit(0))

    def one(_):
        try:
            return c.compact(df, c.SnapshotTable(spark, table.path), 1, 1 << 20).count()
        except c.ConflictError:
            return -1

    with ThreadPoolExecutor(3) as pool:
        found = list(pool.map(one, range(3)))
    assert found.count(1) == 1 and table.read().count() == 20


def test_files_that_change_while_they_are_read_are_not_committed(spark, table, rows, monkeypatch):
    df = files(spark, (1, "A", 1, "barcode\treads\nAC\t1"), (2, "A", 1, "barcode\treads\nAC\t2")).withColumn("part", F.lit(0))
    real, calls = c.listing, []

    def changing(given, small):
        calls.append(1)
        return real(given, small) if len(calls) == 1 else real(given, small).withColumn("fingerprint", F.col("fingerprint") + 1)

    monkeypatch.setattr(c, "listing", changing)
    with pytest.raises(c.ConflictError, match="changed"):
        c.compact(df, table, 1, 1 << 20)
    assert table.version() == 0 and table.read().count() == 0
