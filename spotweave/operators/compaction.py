"""Compaction of very many small count files into few files of good size.

Partition-local: the listing of the files gives the partitions that hold too many small ones, and only these are
rewritten, by dynamic overwrite into folders of the run that does it. Snapshots protect it: every run works on the
version it saw, claims the next one, marks what it writes with a name of its own, and commits by creating one file that
no other run can create; its manifest says which set of files each partition covers and which run wrote it. Only
what the last manifest lists is read: what a failed run left isn't. Files that come, go or change meanwhile change the
fingerprint of their partition, which is then read from its files until a run has taken it again, so no record is lost.
"""

from __future__ import annotations

import math
import time
import uuid
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import spot_key, text_lines, trimmed
from ..staging import broadcast_if_small, stage

#: Size of a compacted file.
TARGET_BYTES = 128 << 20
#: Text to a partition of a new table, and the fewest partitions it gets.
PART_BYTES, LEAST_PARTS = 4 << 30, 8
#: Bytes of text that become one byte of Parquet, until the table knows its own figure.
TEXT_RATIO = 6.0
#: A claim older than this may be taken over.
CLAIM_SECONDS = 6 * 3600
BROADCAST_PARTS = 100_000
RECORD = ["sample_id", "chunk_id", "barcode", "reads"]
_MANIFEST = "part int, n_files bigint, n_small bigint, n_bytes bigint, fingerprint bigint, run string"
_ROWS = "sample_id string, chunk_id int, barcode string, reads bigint, file_id bigint, run string, part int"


class ConflictError(RuntimeError):
    """Another run claimed or committed the same version of the table, or its files changed meanwhile."""


@dataclass(frozen=True)
class SnapshotTable:
    """A table of Parquet files under ``path``, in folders ``run=../part=..``, with the log of its versions.

    The log is the folder ``_snapshots``: ``N.claim-K`` (the K-th run that wants to write version N), ``N.ok`` (the run
    that committed it), the manifests, and ``parts``, the table's number of partitions.
    """

    spark: SparkSession
    path: str
    owner: str = field(default_factory=lambda: uuid.uuid4().hex)

    def _fs(self, name: str = "") -> tuple:
        jvm = self.spark.sparkContext._jvm
        at = jvm.org.apache.hadoop.fs.Path(f"{self.path}/_snapshots/{name}" if name else f"{self.path}/_snapshots")
        return at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), at

    def _create(self, name: str, text: str) -> None:
        """A new file of the log; a ``ConflictError`` if it's there. Of several who try one succeeds."""
        fs, at = self._fs(name)
        try:
            out = fs.create(at, False)
        except Py4JJavaError as e:
            if "FileAlreadyExistsException" in str(e.java_exception) or fs.exists(at):
                raise ConflictError(f"{at} is there already") from e
            raise
        out.write(bytearray(text.encode()))
        out.close()

    def _text(self, name: str) -> str:
        fs, at = self._fs(name)
        with_stream = fs.open(at)
        try:
            return bytes(with_stream.readAllBytes()).decode()
        finally:
            with_stream.close()

    def _log(self) -> dict[str, float]:
        """The names in the log and when they were written, in seconds."""
        fs, at = self._fs()
        return {s.getPath().getName(): s.getModificationTime() / 1000 for s in fs.listStatus(at)} if fs.exists(at) else {}

    def commits(self) -> dict[int, str]:
        """The committed versions and the names of their manifests; a commit file without its text counts for nothing."""
        found = {int(n[:-3]): self._text(n) for n in self._log() if n.endswith(".ok")}
        return {n: run for n, run in sorted(found.items()) if run}

    def version(self) -> int:
        """The last committed version, 0 for none."""
        return max(self.commits(), default=0)

    def claim(self, base: int, expires: float = CLAIM_SECONDS) -> int:
        """The right to write the version after ``base``, the last one; gives its number.

        A ``ConflictError`` if another run holds it, which it does until it commits, gives up or its claim expires.
        """
        if self.version() != base:
            raise ConflictError(f"version {base} isn't the last one any more")
        log = self._log()
        version = 1 + max((int(n[:-3]) for n in log if n.endswith(".ok")), default=0)
        rivals = {int(n.rsplit("-", 1)[1]): at for n, at in log.items() if n.startswith(f"{version}.claim-")}
        if any(at > time.time() - expires for at in rivals.values()):
            raise ConflictError(f"version {version} is claimed")
        self._create(f"{version}.claim-{1 + max(rivals, default=0)}", self.owner)
        return version

    def release(self, version: int) -> None:
        """Gives up this run's claim, so that another may write the version."""
        for name in self._log():
            if name.startswith(f"{version}.claim-") and self._text(name) == self.owner:
                fs, at = self._fs(name)
                fs.delete(at, False)

    def commit(self, base: int, version: int, manifest: DataFrame, run: str) -> None:
        """Writes the manifest and makes the version the last one, unless another run has come after ``base``."""
        manifest.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/_snapshots/manifest-{run}")
        if self.version() != base:
            raise ConflictError(f"version {base} isn't the last one any more")
        self._create(f"{version}.ok", run)

    def manifest(self, version: int | None = None) -> DataFrame:
        """``part, n_files, n_small, n_bytes, fingerprint, run`` of the partitions as they were last rewritten."""
        commits = self.commits()
        run = commits.get(max(commits, default=0) if version is None else version)
        return self.spark.read.schema(_MANIFEST).parquet(f"{self.path}/_snapshots/manifest-{run}") if run else self.spark.createDataFrame([], _MANIFEST)

    def n_parts(self, first: int) -> int:
        """How many partitions the table's files are spread over: ``first``, unless that was settled before."""
        try:
            self._create("parts", str(first))
        except ConflictError:
            pass
        for _ in range(50):  # another run may be about to write it
            if settled := self._text("parts"):
                return int(settled)
            time.sleep(0.1)
        raise ConflictError(f"{self.path} has no number of partitions")

    def read(self, parts: DataFrame | None = None) -> DataFrame:
        """The compacted records with the least ``file_id`` that holds each, of the rows ``parts`` of the manifest (all by default)."""
        if not self.version():
            return self.spark.createDataFrame([], _ROWS).drop("run")
        listed = (self.manifest() if parts is None else parts).select(F.col("part").alias("_part"), F.col("run").alias("_run"))
        rows = self.spark.read.schema(_ROWS).parquet(self.path)  # run and part are folders: only listed ones are opened
        kept = rows.join(broadcast_if_small(listed, BROADCAST_PARTS), (F.col("part") == F.col("_part")) & (F.col("run") == F.col("_run")), "left_semi")
        return kept.select(*RECORD, "file_id", "part")

    def text_ratio(self) -> float:
        """Bytes of text to a byte of Parquet, over the partitions of the last manifest."""
        if not self.version():
            return TEXT_RATIO
        text = self.manifest().agg(F.sum("n_bytes")).first()[0]
        live = {(r.run, r.part) for r in self.manifest().select("run", "part").toLocalIterator()}
        written = sum(size for key, (_, size) in self._folders().items() if key in live)
        return max(text / written, 1.0) if text and written else TEXT_RATIO

    def _folders(self) -> dict[tuple[str, int], tuple[object, int]]:
        """The folder of each run and partition and the bytes in it: a listing, nothing is opened."""
        fs, at = self._fs()
        out = {}
        for run in fs.listStatus(at.getParent()) if fs.exists(at) else []:
            if (name := run.getPath().getName()).startswith("run="):
                for part in fs.listStatus(run.getPath()):
                    if part.getPath().getName().startswith("part="):
                        out[name[4:], int(part.getPath().getName()[5:])] = part.getPath(), fs.getContentSummary(part.getPath()).getLength()
        return out

    def clear(self) -> None:
        """Deletes the folders that neither of the last two versions lists, so that who reads the one before can end."""
        fs, _ = self._fs()
        live = {(r.run, r.part) for v in sorted(self.commits())[-2:] for r in self.manifest(v).select("run", "part").toLocalIterator()}
        for key, (folder, _size) in self._folders().items():
            if key not in live:
                fs.delete(folder, True)


def records(files: DataFrame) -> DataFrame:
    """``part, sample_id, chunk_id, barcode, reads, file_id`` of the lines that are records.

    ``files`` has ``file_id, sample_id, chunk_id, content, part``. The header names the columns in any order,
    case and with blanks around; a record is a line with a barcode (trimmed, upper case) and a whole number of
    reads within 64 bits. Blank, cut and other lines, and files without content or without those columns, give none.
    """
    lines = files.select("part", "file_id", "sample_id", "chunk_id", text_lines("content").alias("lines"))
    names = F.transform(F.split(F.ltrim(F.col("lines")[0], F.lit("\ufeff")), "\t"), lambda n: F.lower(trimmed(n)))
    place = lambda n: F.array_position(names, n).cast("int").alias(n)
    rows = lines.select("part", "file_id", "sample_id", "chunk_id", place("barcode"), place("reads"), F.explode(F.slice("lines", 2, F.greatest(F.size("lines") - 1, F.lit(0)))).alias("line"))
    fields = F.split("line", "\t")
    read = rows.where("barcode > 0 and reads > 0").select(
        "part", "file_id", "sample_id", "chunk_id",
        spot_key(F.get(fields, F.col("barcode") - 1)).alias("barcode"),
        trimmed(F.get(fields, F.col("reads") - 1)).alias("text"),
    )
    number = F.when(F.col("text").rlike("^[+-]?[0-9]+$"), F.col("text")).try_cast("long")
    return read.select("part", *RECORD[:3], number.alias("reads"), "file_id").where("barcode <> '' and reads is not null")


def unique(recs: DataFrame) -> DataFrame:
    """Each record once, with the least ``file_id`` that holds it; equal means equal in all of ``RECORD``, nulls included."""
    return recs.groupBy("part", *RECORD).agg(F.min("file_id").alias("file_id"))


def listing(files: DataFrame, small_bytes: int) -> DataFrame:
    """Per partition how many files and small files it has, their bytes, and a fingerprint of their set.

    The fingerprint covers ids, sizes and contents: a file that is sent again with another content changes it.
    """
    one = files.select("part", "file_id", "n_bytes", F.xxhash64("content").alias("hash")).distinct()
    return one.groupBy("part").agg(
        F.count(F.lit(1)).alias("n_files"),
        F.count_if(F.coalesce("n_bytes", F.lit(0)) < small_bytes).alias("n_small"),
        F.coalesce(F.sum("n_bytes"), F.lit(0)).cast("long").alias("n_bytes"),
        F.bit_xor(F.xxhash64("file_id", "n_bytes", "hash")).alias("fingerprint"),
    )


def partition_of(n_parts: int) -> Column:
    """The partition of a file: all files of a sample's chunk are in one, so equal records meet there."""
    return F.pmod(F.xxhash64("sample_id", "chunk_id"), F.lit(n_parts)).cast("int")


def compact(
    files: DataFrame, table: SnapshotTable, max_small_files: int, small_bytes: int, target_bytes: int = TARGET_BYTES, expires: float = CLAIM_SECONDS,
    listed: DataFrame | None = None,
) -> DataFrame:
    """Rewrites the partitions of ``table`` with more than ``max_small_files`` small files; gives their listing.

    ``files`` has the columns of ``records`` and ``n_bytes``; ``listed`` is their ``listing`` by ``small_bytes``, if it's known
    already. A partition that the last manifest covers, with the
    same set of files, is left alone, and one without files any more leaves the manifest. A partition that makes more
    than ``target_bytes`` of Parquet, by the table's own ratio to the text, is written as several files, its records
    spread evenly by their hash whatever their keys. A ``ConflictError`` means that another run came first, or that
    the files of a partition changed while it was read; nothing is committed then.
    """
    base = table.version()
    done = table.manifest(base)
    now = stage(listing(files, small_bytes), "compact-listing") if listed is None else listed
    todo = stage(now.where(F.col("n_small") > max_small_files).join(done.select("part", "fingerprint"), ["part", "fingerprint"], "left_anti"), "compact-todo")
    n = todo.count()
    if not n and done.join(now, "part", "left_anti").isEmpty():
        return todo
    version = table.claim(base, expires)
    run = f"{version}-{uuid.uuid4().hex}"
    try:
        if n:
            _rewrite(files, todo, n, table, run, target_bytes)
            again = listing(files.join(F.broadcast(todo.select("part")) if n <= BROADCAST_PARTS else todo.select("part"), "part", "left_semi"), small_bytes)
            if not todo.join(again.select("part", "fingerprint"), ["part", "fingerprint"], "left_anti").isEmpty():
                raise ConflictError("files changed while they were read")
        kept = done.join(todo.select("part"), "part", "left_anti").join(now.select("part"), "part", "left_semi")
        table.commit(base, version, kept.unionByName(todo.withColumn("run", F.lit(run))), run)
        table.clear()
    except BaseException:
        table.release(version)
        raise
    return todo


def _rewrite(files: DataFrame, todo: DataFrame, n: int, table: SnapshotTable, run: str, target_bytes: int) -> None:
    """Writes the records of the ``n`` partitions in ``todo``, a task to each file."""
    slices = F.greatest(F.ceil(F.col("n_bytes") / F.lit(table.text_ratio() * target_bytes)), F.lit(1)).cast("int")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each partition of the table
    plan = todo.select("part", slices.alias("slices"), F.coalesce(F.sum(slices).over(before), F.lit(0)).cast("int").alias("first"))
    n_out = int(todo.agg(F.sum(slices)).first()[0])
    small = F.broadcast if n <= BROADCAST_PARTS else (lambda d: d)  # few partitions are a poor key to shuffle by
    kept = unique(records(files.join(small(todo.select("part")), "part", "left_semi")))
    out = F.col("first") + F.pmod(F.xxhash64(*RECORD), "slices").cast("int")
    (
        kept.join(small(plan), "part")
        .repartitionById(n_out, out)
        .sortWithinPartitions("part", *RECORD)
        .select(*RECORD, "file_id", F.lit(run).alias("run"), "part")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "zstd")
        .partitionBy("run", "part")
        .parquet(table.path)
    )


def with_parts(files: DataFrame, part_bytes: int = PART_BYTES, table: SnapshotTable | None = None, least: int = LEAST_PARTS) -> DataFrame:
    """``files`` with ``part``, in as many partitions as make about ``part_bytes`` of text each, or as ``table`` already has."""
    total = files.agg(F.sum("n_bytes")).first()[0] or 0
    n = max(least, math.ceil(total / part_bytes))
    return files.withColumn("part", partition_of(table.n_parts(n) if table else n))


def all_records(files: DataFrame, table: SnapshotTable, listed: DataFrame | None = None) -> DataFrame:
    """Every record of ``files`` once: those of partitions that ``table`` covers with the same set of files from it,
    the others wholly from their files. ``listed`` is the ``listing`` of ``files``, if it's known already."""
    if not table.version():
        return unique(records(files))
    covered = stage(table.manifest().join((listing(files, 0) if listed is None else listed).select("part", "fingerprint"), ["part", "fingerprint"]), "compact-covered")
    rest = files.join(broadcast_if_small(covered.select("part"), BROADCAST_PARTS), "part", "left_anti")
    return table.read(covered).select("part", *RECORD, "file_id").unionByName(unique(records(rest)))


def adding_nothing(files: DataFrame, compacted: DataFrame) -> DataFrame:
    """``file_id`` of the files of which no record is the first of its kind: all of them also stand in a file of
    smaller id, or there are none. Files listed twice count once; a null id is no file."""
    return files.where("file_id is not null").select("file_id").distinct().join(compacted.select("file_id").distinct(), "file_id", "left_anti")
