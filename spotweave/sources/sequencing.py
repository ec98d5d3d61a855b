"""Spark data sources for FASTQ, FASTA and BAM files, Arrow batches out.

A gzip stream can't be split, so the parallelism of a scan of FASTQ or FASTA is the number of files, which a sequencer
writes in chunks; BAM files are split at their blocks. Register with ``register(spark)``, then ``spark.read.format("fastq").load(folder_or_file)``.
"""

from __future__ import annotations

import bisect
import fnmatch
import gzip
import io
import math
import os
import re
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

BATCH = 8192
FASTQ = "file string, ord bigint, name string, seq string, plus string, qual string"
PAIRS = "file string, ord bigint, r1 struct<name: string, seq: string, plus: string, qual: string>, r2 struct<name: string, seq: string, plus: string, qual: string>"
FASTA = "contig string, start bigint, seq string, pad struct<before: string, after: string>"
BAM = (
    "name string, flag int, contig string, start int, mapq int, cigar array<struct<op: string, len: int>>, seq string,"
    " quals array<int>, spot string, hits int, yd string"
)
_OPS, _BASES = "MIDNSHP=X", "=ACMGRSVTWYHKDBN"
_SIZES = {"c": 1, "C": 1, "s": 2, "S": 2, "i": 4, "I": 4, "f": 4, "A": 1}
_CODES = {"c": "b", "C": "B", "s": "h", "S": "H", "i": "i", "I": "I", "f": "f"}


@dataclass
class File(InputPartition):
    path: str
    mate: str | None = None
    start: int = 0
    end: int | None = None


def _located(path: str) -> tuple[fs.FileSystem, str, str]:
    """The file system of a path, the path there, and what to put before one of its paths to name it again."""
    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem(), path, ""
    found, inner = fs.FileSystem.from_uri(path)
    return found, inner, path[: path.index(inner)] if inner in path else ""


def files_of(path: str, endings: tuple[str, ...]) -> list[str]:
    """The files with such an ending under a folder, or those that a pattern names, on any file system that Arrow knows."""
    found, inner, prefix = _located(path)
    fixed = re.split(r"[*?\[]", inner, maxsplit=1)[0]
    base = inner if fixed == inner else os.path.dirname(fixed) or "."
    if found.get_file_info(base).type == fs.FileType.File:
        return [path]
    names = [i.path for i in found.get_file_info(fs.FileSelector(base, allow_not_found=True, recursive=True)) if i.type == fs.FileType.File]
    if base == inner:
        return sorted(prefix + n for n in names if n.endswith(endings))
    depth = inner.count("/")
    return sorted(prefix + n for n in names if n.count("/") == depth and fnmatch.fnmatchcase(n, inner))


def _bytes(path: str) -> io.BufferedIOBase:
    found, inner, _ = _located(path)
    return found.open_input_file(inner)


def _open(path: str) -> io.TextIOWrapper:
    raw = _bytes(path)
    return io.TextIOWrapper(gzip.GzipFile(fileobj=raw) if path.endswith(".gz") else raw)


def fastq_records(path: str) -> Iterator[tuple[str, str, str, str]]:
    """The records of a file; one of fewer than four lines, or that doesn't begin with ``@``, is an error."""
    with _open(path) as f:
        while head := f.readline():
            rest = [f.readline() for _ in range(3)]
            if not rest[2]:
                raise ValueError(f"{path} ends within a record")
            if not head.startswith("@"):
                raise ValueError(f"{path}: no record begins with {head[:40]!r}")
            yield (head.rstrip("\r\n"), *(x.rstrip("\r\n") for x in rest))


def _batched(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    some: list[tuple] = []

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*some), schema)], schema=schema)

    for row in rows:
        some.append(row)
        if len(some) == BATCH:
            yield batch()
            some = []
    if some:
        yield batch()


class _Source(DataSource):
    fields, endings = "", ()

    def schema(self) -> str:
        return self.fields

    def reader(self, schema) -> DataSourceReader:
        from pyspark.sql.pandas.types import to_arrow_schema

        return _Reader(self, to_arrow_schema(schema))

    def partitions(self) -> list[File]:
        return [File(p) for p in files_of(self.options["path"], self.wanted())]

    def wanted(self) -> tuple[str, ...]:
        """The endings of files that are read: the format's own, or the one given as ``ending``."""
        return (self.options["ending"],) if "ending" in self.options else self.endings

    def rows(self, part: File) -> Iterator[tuple]:
        raise NotImplementedError


class _Reader(DataSourceReader):
    def __init__(self, source: _Source, schema: pa.Schema):
        self.source, self.schema = source, schema

    def partitions(self) -> list[File]:
        return self.source.partitions()

    def read(self, partition: File) -> Iterator[pa.RecordBatch]:
        return _batched(self.source.rows(partition), self.schema)


class FastqSource(_Source):
    """Records with their file and number."""

    fields, endings = FASTQ, (".fastq", ".fq", ".fastq.gz", ".fq.gz")

    @classmethod
    def name(cls) -> str:
        return "fastq"

    def rows(self, part: File) -> Iterator[tuple]:
        for i, record in enumerate(fastq_records(part.path)):
            yield (part.path, i, *record)


class FastqPairSource(_Source):
    """Mates by their number: ``path`` names the first mates' files, in whose names ``R1`` becomes ``R2`` for the second, or
    whose folders ``mate=R1`` have a ``mate=R2`` beside them with a file of the same name.

    Files of different lengths are an error, or with ``truncate=true`` end with the shorter one.
    """

    fields, endings = PAIRS, FastqSource.endings

    @classmethod
    def name(cls) -> str:
        return "fastq_pairs"

    def partitions(self) -> list[File]:
        return [File(p, self._mate(p)) for p in files_of(self.options["path"], self.wanted()) if self._mate(p)]

    @staticmethod
    def _mate(path: str) -> str | None:
        folder, name = os.path.split(path)
        if "mate=R1" in folder:
            return os.path.join(folder.replace("mate=R1", "mate=R2"), name)
        return os.path.join(folder, name.replace("R1", "R2")) if "R1" in name else None

    def rows(self, part: File) -> Iterator[tuple]:
        strict = self.options.get("truncate", "false") != "true"
        keys = ("name", "seq", "plus", "qual")
        for i, (a, b) in enumerate(zip(fastq_records(part.path), fastq_records(part.mate), strict=strict)):
            yield (part.path, i, dict(zip(keys, a)), dict(zip(keys, b)))


class FastaSource(_Source):
    """Contigs in chunks of ``chunk`` bases (100,000 if not given) with one more base on either side in ``pad``."""

    fields, endings = FASTA, (".fa", ".fasta", ".fa.gz", ".fasta.gz")

    @classmethod
    def name(cls) -> str:
        return "fasta"

    def rows(self, part: File) -> Iterator[tuple]:
        size = int(self.options.get("chunk", 100_000))
        contig, start, before, held = None, 0, "", ""

        def cut(final: bool) -> Iterator[tuple]:
            nonlocal start, before, held
            while len(held) > size or (final and held):
                seq, held = held[:size], held[size:]
                yield contig, start, seq, {"before": before, "after": held[:1]}
                start, before = start + len(seq), seq[-1]

        with _open(part.path) as f:
            for line in f:
                if line.startswith(">"):
                    yield from cut(True)
                    contig, start, before = (line[1:].split() or [""])[0], 0, ""
                else:
                    held += line.strip().upper()
                    if len(held) > 2 * size:
                        yield from cut(False)
            yield from cut(True)


def _block_size(head: bytes) -> int:
    """The bytes of the BGZF block that begins with ``head``, 0 if none does."""
    if len(head) < 18 or head[:4] != b"\x1f\x8b\x08\x04" or head[12:16] != b"BC\2\0":
        return 0
    return struct.unpack("<H", head[16:18])[0] + 1


class _Blocks:
    """The inflated blocks of a BGZF file from a compressed place on, as one buffer that knows where each block began."""

    def __init__(self, f: io.BufferedIOBase, at: int):
        self.f, self.at, self.data, self.places = f, at, bytearray(), []

    def more(self) -> bool:
        """Reads another block; False at the end."""
        self.f.seek(self.at)
        size = _block_size(head := self.f.read(18))
        if not size:
            if head:
                raise ValueError(f"no BGZF block at {self.at}")
            return False
        self.places.append((len(self.data), self.at))
        self.data += zlib.decompress(self.f.read(size - 18)[:-8], -15)
        self.at += size
        return True

    def upto(self, n: int) -> bool:
        """Whether the buffer has, or now gets, ``n`` bytes."""
        while len(self.data) < n:
            if not self.more():
                return False
        return True

    def place(self, offset: int) -> int:
        """Where the block with this byte of the buffer began in the file."""
        return self.places[bisect.bisect_right(self.places, (offset, math.inf)) - 1][1]

    def drop(self, n: int) -> None:
        """Forgets the first ``n`` bytes."""
        del self.data[:n]
        k = max(bisect.bisect_right(self.places, (n, math.inf)) - 1, 0)
        self.places = [(max(o - n, 0), at) for o, at in self.places[k:]]


def _first_block(f: io.BufferedIOBase, start: int) -> int | None:
    """The first place from ``start`` on where a BGZF block begins that another, or the end, follows."""
    f.seek(start)
    near = f.read(1 << 18)
    at = near.find(b"\x1f\x8b\x08\x04")
    while at >= 0:
        f.seek(start + at)
        if size := _block_size(f.read(18)):
            f.seek(start + at + size)
            following = f.read(18)
            if not following or _block_size(following):
                return start + at
        at = near.find(b"\x1f\x8b\x08\x04", at + 1)
    return None


def _is_record(data: bytearray, at: int, contigs: int) -> bool:
    """Whether the 36 bytes and the name at a place can be the head of an alignment record."""
    size, ref, pos, n_name, _, _, n_cigar, _, n_seq, mate, mate_pos, _ = struct.unpack_from("<iiiBBHHHiiii", data, at)
    if not (-1 <= ref < contigs and -1 <= mate < contigs and pos >= -1 and mate_pos >= -1 and n_name >= 1 and n_seq >= 0):
        return False
    if size < 32 + n_name + 4 * n_cigar + (n_seq + 1) // 2 + n_seq or size > 1 << 28:
        return False
    name = data[at + 36 : at + 36 + n_name]
    return len(name) < n_name or name[-1] == 0 and all(32 < c < 127 for c in name[:-1])


#: A place begins a record if so many in a row can be records.
_CHAIN = 5


class BamSource(_Source):
    """Alignment records; ``spot`` is the tag named in ``tag`` (``CB``), ``hits`` is ``NH`` and ``yd`` is ``YD``.

    BGZF files are split into ranges of ``split`` bytes (64 MB if not given): a range's records are those that begin in a
    block that begins there. The first is found by trying each place of its first blocks until several records in a
    row fit. Other gzip files are one partition each.
    """

    fields, endings = BAM, (".bam",)

    @classmethod
    def name(cls) -> str:
        return "bam"

    def partitions(self) -> list[File]:
        step, parts = int(self.options.get("split", 64 << 20)), []
        for path in files_of(self.options["path"], self.wanted()):
            found, inner, _ = _located(path)
            size = found.get_file_info(inner).size
            with _bytes(path) as f:
                whole = size <= step or not _block_size(f.read(18))
            parts += [File(path)] if whole else [File(path, None, at, at + step) for at in range(0, size, step)]
        return parts

    def rows(self, part: File) -> Iterator[tuple]:
        wanted = self.options.get("tag", "CB")
        with _bytes(part.path) as raw:
            f = gzip.GzipFile(fileobj=raw)
            contigs, head = self._contigs(f, part.path)
            if part.end is None:
                while size := f.read(4):
                    yield self._record(f.read(struct.unpack("<i", size)[0]), contigs, wanted)
                return
            if part.start == 0:
                blocks, at = _Blocks(raw, 0), head
                blocks.upto(head)
            else:
                first = _first_block(raw, part.start)
                if first is None or first >= part.end:
                    return
                blocks = _Blocks(raw, first)
                at = self._first_record(blocks, part.end, len(contigs))
            while at is not None and blocks.upto(at + 4) and blocks.place(at) < part.end:
                size = struct.unpack_from("<i", blocks.data, at)[0]
                if not blocks.upto(at + 4 + size):
                    raise ValueError(f"{part.path} ends within a record")
                yield self._record(bytes(blocks.data[at + 4 : at + 4 + size]), contigs, wanted)
                at += 4 + size
                if at > 1 << 20:
                    blocks.drop(at)
                    at = 0

    @staticmethod
    def _contigs(f: gzip.GzipFile, path: str) -> tuple[list[str], int]:
        """The contigs in a file's header, and the header's length."""
        if f.read(4) != b"BAM\1":
            raise ValueError(f"{path} is no BAM file")
        text = struct.unpack("<i", f.read(4))[0]
        f.read(text)
        contigs, length = [], 12 + text
        for _ in range(struct.unpack("<i", f.read(4))[0]):
            n = struct.unpack("<i", f.read(4))[0]
            contigs.append(f.read(n)[:-1].decode())
            f.read(4)
            length += 8 + n
        return contigs, length

    @staticmethod
    def _first_record(blocks: _Blocks, end: int, contigs: int) -> int | None:
        """The first place in a range's blocks where a record begins, None if there is none."""
        at = 0
        while blocks.upto(at + 1) and blocks.place(at) < end:
            place, fits = at, 0
            while fits < _CHAIN and blocks.upto(place + 36) and _is_record(blocks.data, place, contigs):
                fits, place = fits + 1, place + 4 + struct.unpack_from("<i", blocks.data, place)[0]
            if fits and (fits == _CHAIN or place == len(blocks.data) and not blocks.upto(place + 1)):
                return at
            at += 1
        return None

    @staticmethod
    def _record(raw: bytes, contigs: list[str], wanted: str) -> tuple:
        ref, pos, n_name, mapq, _, n_cigar, flag, n_seq, *_ = struct.unpack("<iiBBHHHiiii", raw[:32])
        at = 32 + n_name
        name = raw[32 : at - 1].decode()
        cigar = [{"op": _OPS[c & 15], "len": c >> 4} for c in struct.unpack(f"<{n_cigar}I", raw[at : at + 4 * n_cigar])]
        at += 4 * n_cigar
        packed = raw[at : at + (n_seq + 1) // 2]
        seq = "".join(_BASES[b >> 4] + _BASES[b & 15] for b in packed)[:n_seq]
        at += (n_seq + 1) // 2
        quals = None if n_seq == 0 or raw[at] == 255 else list(raw[at : at + n_seq])
        tags = _tags(raw, at + n_seq)
        spot, hits, yd = tags.get(wanted), tags.get("NH"), tags.get("YD")
        return (name, flag, contigs[ref] if ref >= 0 else None, pos, mapq, cigar, seq or None, quals, None if spot is None else str(spot), hits if isinstance(hits, int) else None, yd)


def _tags(raw: bytes, at: int) -> dict[str, object]:
    """The tags of a record; arrays are skipped."""
    out: dict[str, object] = {}
    while at < len(raw):
        tag, kind = raw[at : at + 2].decode(), chr(raw[at + 2])
        at += 3
        if kind in "ZH":
            end = raw.index(b"\0", at)
            out[tag], at = raw[at:end].decode(), end + 1
        elif kind == "B":
            n = struct.unpack("<i", raw[at + 1 : at + 5])[0]
            at += 5 + n * _SIZES[chr(raw[at])]
        elif kind == "A":
            out[tag], at = chr(raw[at]), at + 1
        else:
            n = _SIZES[kind]
            out[tag], at = struct.unpack("<" + _CODES[kind], raw[at : at + n])[0], at + n
    return out


def register(spark: SparkSession) -> None:
    """Makes the formats ``fastq``, ``fastq_pairs``, ``fasta`` and ``bam`` known to the session."""
    for source in (FastqSource, FastqPairSource, FastaSource, BamSource):
        spark.dataSource.register(source)
