"""File formats: written here, read back."""

import gzip
import struct
import zlib

import pytest
from pyspark.sql import functions as F

from spotweave.operators import sites, spots
from spotweave.sources import sequencing, sinks, tables


@pytest.fixture(scope="module", autouse=True)
def formats(spark):
    sequencing.register(spark)


def write(path, text):
    with (gzip.open(path, "wt") if str(path).endswith(".gz") else open(path, "w")) as f:
        f.write(text)


def test_fastq(spark, tmp_path, rows):
    write(tmp_path / "a.fastq.gz", "@r1 x\nACGT\n+\nIIII\n@r2\nAC\n+r2\nI@\n")
    write(tmp_path / "b.fq", "")
    df = spark.read.format("fastq").load(str(tmp_path))
    assert rows(df, "ord", "name", "seq", "plus", "qual") == [(0, "@r1 x", "ACGT", "+", "IIII"), (1, "@r2", "AC", "+r2", "I@")]
    write(tmp_path / "c.fq", "@r1\nAC\n+\n")
    with pytest.raises(Exception, match="ends within a record"):
        spark.read.format("fastq").load(str(tmp_path / "c.fq")).count()


def test_pairs(spark, tmp_path, rows):
    write(tmp_path / "s_R1_1.fq", "@a\nAC\n+\nII\n@b\nGG\n+\nII\n")
    write(tmp_path / "s_R2_1.fq", "@a\nTT\n+\nII\n")
    with pytest.raises(Exception, match="zip"):
        spark.read.format("fastq_pairs").load(str(tmp_path)).count()
    df = spark.read.format("fastq_pairs").option("truncate", "true").load(str(tmp_path))
    assert rows(df, "r1.seq", "r2.seq") == [("AC", "TT")]


@pytest.mark.parametrize("chunk", [1, 3, 100])
def test_fasta(spark, tmp_path, rows, chunk):
    write(tmp_path / "g.fa", ">c1 first\nacgc\nATG\n\nCT\n>c2\nCG\n>c3\n")
    df = spark.read.format("fasta").option("chunk", chunk).load(str(tmp_path / "g.fa"))
    assert "".join(r.seq for r in df.where("contig = 'c1'").orderBy("start").collect()) == "ACGCATGCT"
    assert rows(sites.reference_sites(df), "contig", "pos", "context") == [("c1", 1, "CG"), ("c1", 3, "CA"), ("c1", 6, "CA"), ("c1", 7, "CT"), ("c2", 0, "CG")]


def bgzf(data, size):
    """``data`` in blocks of ``size`` bytes, whatever records they cut, and the empty block at the end."""
    out = b""
    for piece in [data[i : i + size] for i in range(0, len(data), size)] + [b""]:
        c = zlib.compressobj(6, zlib.DEFLATED, -15)
        body = c.compress(piece) + c.flush()
        out += b"\x1f\x8b\x08\x04" + b"\0" * 5 + b"\xff" + struct.pack("<H", 6) + b"BC" + struct.pack("<HH", 2, len(body) + 25) + body + struct.pack("<II", zlib.crc32(piece), len(piece))
    return out


def bam(path, records, block=None):
    def text(kind, s):
        return kind + s.encode() + b"\0"

    out = b"BAM\1" + struct.pack("<i", 0) + struct.pack("<i", 2)
    for name in ("chr1", "chrM"):
        out += struct.pack("<i", len(name) + 1) + name.encode() + b"\0" + struct.pack("<i", 1000)
    for name, flag, ref, pos, mapq, cigar, seq, quals, tags in records:
        codes = ["=ACMGRSVTWYHKDBN".index(c) for c in seq] + [0] * (len(seq) % 2)
        body = struct.pack("<iiBBHHHiiii", ref, pos, len(name) + 1, mapq, 0, len(cigar), flag, len(seq), -1, -1, 0) + name.encode() + b"\0"
        body += b"".join(struct.pack("<I", n << 4 | "MIDNSHP=X".index(op)) for op, n in cigar)
        body += bytes(a << 4 | b for a, b in zip(codes[::2], codes[1::2])) + (bytes(quals) if quals else b"\xff" * len(seq)) + tags
        out += struct.pack("<i", len(body)) + body
    if block:
        path.write_bytes(bgzf(out, block))
        return
    half = len(out) // 2  # members one after another, as in blocked gzip
    path.write_bytes(gzip.compress(out[:half]) + gzip.compress(out[half:]) + gzip.compress(b""))


def test_bam(spark, tmp_path, rows):
    tags = b"CBZAAAA\0" + b"NHC\x01" + b"XBBs" + struct.pack("<ihh", 2, 1, 2) + b"YDZu\0" + b"XAAx" + b"XFf" + struct.pack("<f", 1.5)
    bam(tmp_path / "x.bam", [("r1", 99, 0, 10, 60, [("S", 1), ("M", 4)], "ACGTN", [1, 2, 3, 4, 5], tags), ("r2", 4, -1, -1, 0, [], "", None, b"")])
    got = rows(spark.read.format("bam").load(str(tmp_path)).select("name", "flag", "contig", "start", "mapq", F.to_json("cigar").alias("c"), "seq", "quals", "spot", "hits", "yd"))
    assert got == [
        ("r1", 99, "chr1", 10, 60, '[{"op":"S","len":1},{"op":"M","len":4}]', "ACGTN", [1, 2, 3, 4, 5], "AAAA", 1, "u"),
        ("r2", 4, None, -1, 0, "[]", None, None, None, None, None),
    ]
    assert sites.aligned_bases(spark.read.format("bam").load(str(tmp_path))).count() == 0  # its strand is unclear


@pytest.mark.parametrize("block", [97, 1000, 20_000])
def test_bam_in_splits(spark, tmp_path, block):
    bases = "ACGTTGCA" * 40
    data = [(f"read{i:05}", 99, i % 2, i, 60, [("M", 20 + i % 300)], bases[: 20 + i % 300], None, b"CBZAA\0") for i in range(600)]
    bam(tmp_path / "x.bam", data, block)
    read = lambda split: [r.name for r in spark.read.format("bam").option("split", split).load(str(tmp_path)).select("name").collect()]
    want = [d[0] for d in data]
    assert read(1 << 30) == want
    for split in (700, 5000, 40_000):
        df = spark.read.format("bam").option("split", split).load(str(tmp_path))
        assert df.rdd.getNumPartitions() > 1 or (tmp_path / "x.bam").stat().st_size <= split
        assert sorted(read(split)) == want


def test_lists(spark, tmp_path, rows):
    write(tmp_path / "w.txt", "# list\nacgt\tx\n\nTTTT\nACGT\n")
    assert rows(tables.whitelist(spark, str(tmp_path / "w.txt"))) == [("ACGT", 0), ("TTTT", 1)]
    assert rows(tables.whitelist(spark, str(tmp_path / "w.txt"), upper=False)) == [("ACGT", 2), ("TTTT", 1), ("acgt", 0)]
    write(tmp_path / "g.fai", "chr1\t250\t5\t60\t61\nchr2\t100\n")
    assert rows(tables.fasta_index(spark, str(tmp_path / "g.fai"))) == [("chr1", 250, 0), ("chr2", 100, 1)]
    write(tmp_path / "bad.fai", "chr1\n")
    with pytest.raises(Exception, match="no contig and length"):
        tables.fasta_index(spark, str(tmp_path / "bad.fai")).collect()
    write(tmp_path / "none.fai", "")
    with pytest.raises(ValueError, match="lists no contig"):
        tables.fasta_index(spark, str(tmp_path / "none.fai"))


def test_tables(spark, tmp_path, rows):
    write(tmp_path / "counts.tsv", "barcode\treads\nac\t5\nGT\tx\n")
    assert rows(tables.read_counts(spark, str(tmp_path / "counts.tsv"))) == [("AC", 5)]
    assert rows(tables.roster(spark, str(tmp_path / "counts.tsv"))) == [("AC",), ("GT",)]
    write(tmp_path / "w2.tsv", "barcode\tn\n")
    with pytest.raises(ValueError, match="lacks reads, x"):
        tables.with_header(spark, str(tmp_path / "w2.tsv"), ["reads", "x"])
    write(tmp_path / "stats.tsv", "barcode\tmean_5mCG\tcpg_site_count\nAC\t70.00\t2\nGT\tNA\tNA\n")
    assert rows(tables.meth_stats(spark, str(tmp_path / "stats.tsv"))) == [("AC", 70.0, 2), ("GT", None, None)]
    write(tmp_path / "pos.tsv", "barcode\tarray_row\tarray_col\nac\t1\t2\nAC\t3\t4\nGT\tx\t1\n")
    assert rows(spots.positions(tables.positions(spark, str(tmp_path / "pos.tsv")))) == [("AC", 3, 4)]


def test_json(spark, tmp_path, rows):
    write(tmp_path / "a.json", '{"summary": {"before_filtering": {"total_reads": 10, "total_bases": "1e3"}, "after_filtering": {"total_reads": 8}}, "total_reads": 4, "kept_reads": 3, "reject_counts": {"short_r1": 1}}')
    write(tmp_path / "b.json", "not json")
    assert rows(tables.trimming_reports(spark, str(tmp_path)).drop("path")) == sorted([(10, 8, 1000, None), (None,) * 4], key=repr)
    reports = tables.demux_reports(spark, str(tmp_path))
    assert rows(reports.drop("path")) == sorted([(4, 3, {"short_r1": 1}), (None, None, None)], key=repr)
    assert tables.barcoded_reads(reports).first()[0] == 6 and tables.barcoded_reads(reports.where("kept_reads is null")).first()[0] is None


def test_coverage_files(spark, tmp_path, rows):
    cov = spark.createDataFrame([("AACC", "chr1", 5, "CG", None, 1, 3, 25.0), ("AACC", "chr1", 9, "CG", None, 2, 1, 66.67), ("GGTT", "chr2", 1, "CG", None, 0, 1, 0.0)],
                                "spot string, contig string, pos bigint, context string, strand string, meth bigint, unmeth bigint, pct double")
    sinks.write_coverage(cov.drop("context", "strand"), str(tmp_path / "out"))
    text = next((tmp_path / "out" / "prefix=AAC" / "spot=AACC").glob("*.csv")).read_text()
    assert text == "chr1\t5\t5\t25.00\t1\t3\nchr1\t9\t9\t66.67\t2\t1\n"
    (tmp_path / "in" / "AAC").mkdir(parents=True)
    write(tmp_path / "in" / "AAC" / "AACC.CG.cov", text + "short\t1\nchr1\tx\t1\t1\t1\t1\n")
    write(tmp_path / "in" / "AAC" / "GGTT.CH.cov", "chr1\t5\t5\t50.00\t1\t1\tCA\t+\nchr1\t6\t6\t50.00\t1\t1\tCC\t-\n")
    cg = tables.coverage(spark, str(tmp_path / "in" / "AAC" / "AACC.CG.cov"))
    assert rows(cg, "spot", "pos", "meth", "unmeth") == [("AACC", 5, 1, 3), ("AACC", 9, 2, 1)]
    assert rows(tables.coverage(spark, str(tmp_path / "in" / "AAC" / "GGTT.CH.cov"), context="CC"), "spot", "pos", "strand") == [("GGTT", 6, "-")]
    listed = spark.createDataFrame([("GGTT", 0), ("TTTT", 1)], "barcode string, idx int")
    assert [r.spot for r in tables.discovered_spots(spark, str(tmp_path / "in"), listed).collect()] == ["GGTT"]
    roster = spark.createDataFrame([("CCCC",), ("AACC",), (None,)], "spot string")
    sinks.write_spot_files(cov.drop("context", "strand"), str(tmp_path / "spots"), "CG", roster)
    assert {str(p.relative_to(tmp_path / "spots")): p.read_text() for p in (tmp_path / "spots").rglob("*.cov")} == {
        "AAC/AACC.CG.cov": text, "GGT/GGTT.CG.cov": "chr2\t1\t1\t0.00\t0\t1\n", "CCC/CCCC.CG.cov": ""
    }
    named = listed.unionByName(spark.createDataFrame([("CCCC", 2)], listed.schema))
    assert [r.spot for r in tables.discovered_spots(spark, str(tmp_path / "spots"), named).collect()] == ["CCCC", "GGTT"]
    sinks.write_aggregate(cov, str(tmp_path / "agg"))
    lines = "".join(p.read_text() for p in sorted((tmp_path / "agg").glob("*.csv"))).splitlines()
    assert [x.split("\t")[1] for x in lines] == ["5", "9", "1"]


def test_matrix_and_reports(spark, tmp_path):
    contigs = spark.createDataFrame([("chr1", 250, 0)], "contig string, length bigint, ord int")
    bins = sites.genomic_bins(contigs, 100)
    cov = spark.createDataFrame([("BB", "chr1", 150, "CG", 3, 1), ("AA", "chr1", 10, "CG", 1, 2)], "spot string, contig string, pos bigint, context string, meth bigint, unmeth bigint")
    sinks.write_matrix(sites.bin_matrix(cov, 100).where("context = 'CG'"), bins, cov, 100, str(tmp_path))
    text = {n: "".join(gzip.open(p, "rt").read() for p in sorted((tmp_path / n).glob("*.gz"))) for n in ("matrix", "features", "barcodes")}
    assert text["matrix"].splitlines() == ["%%MatrixMarket matrix coordinate real general", "3 2 2", "1 1 1 3 0.333333", "2 2 3 4 0.75"]
    assert text["features"].splitlines()[2] == "chr1:200-250\tchr1\t200\t250" and text["barcodes"] == "AA\nBB\n"
    sinks.write_tsv(spark.createDataFrame([("a", 1234.5, None)], "s string, x double, n int"), str(tmp_path / "r"), {"x": ".2f"})
    assert b"".join(p.read_bytes() for p in sorted((tmp_path / "r").glob("*.txt"))) == b"s\tx\tn\r\na\t1234.50\tNA\r\n"


def test_reports_are_read_back_whatever_their_files(spark, tmp_path, rows):
    sinks.write_tsv(spark.range(100).selectExpr("concat('AC', id) as barcode", "id as reads").repartition(7), str(tmp_path / "many"))
    assert tables.read_counts(spark, str(tmp_path / "many")).count() == 100
    sinks.write_tsv(spark.createDataFrame([], "barcode string, reads int"), str(tmp_path / "none"))
    assert tables.read_counts(spark, str(tmp_path / "none")).count() == 0


def test_listing_by_pattern_and_address(tmp_path):
    (tmp_path / "a" / "b").mkdir(parents=True)
    for n in ("a/x.fq", "a/b/y.fq", "a/b/z.txt"):
        write(tmp_path / n, "")
    found = lambda p: [x.rsplit("/", 1)[1] for x in sequencing.files_of(p, (".fq",))]
    assert found(str(tmp_path)) == ["y.fq", "x.fq"] and found(f"{tmp_path}/a/*.fq") == ["x.fq"] and found(f"file://{tmp_path}/a/b") == ["y.fq"]
    assert found(f"{tmp_path}/a/x.fq") == ["x.fq"] and found(f"{tmp_path}/none") == []


def test_demultiplexed_files(spark, tmp_path):
    df = spark.createDataFrame([("kept", "@AC:r", "AC", "II"), ("short_r1", "@q", "A", "I")], "reason string, name string, seq string, qual string")
    sinks.write_demultiplexed(df, str(tmp_path / "d"))
    read = lambda r: "".join(gzip.open(p, "rt").read() for p in (tmp_path / "d" / f"route={r}").glob("*.gz"))
    assert read("demux") == "@AC:r\nAC\n+\nII\n" and read("spike") == "@q\nA\n+\nI\n"


def test_both_mates_of_pairs_are_written(spark, tmp_path):
    from spotweave.operators import reads

    pair = "row_id bigint, name string, seq string, qual string, r2 struct<name: string, seq: string, plus: string, qual: string>"
    data = []
    for i in range(40):
        seq = "AAAATGTGTGTGGGCCACGT" if i % 3 else "AC"
        data.append((i, f"@r{i} 1", seq, "I" * len(seq), (f"@r{i} 2", "TTTT", "+x", "JJJJ")))
    listed = spark.createDataFrame([("AAAA",), ("GGCC",)], "barcode string")
    found = reads.demultiplex(spark.createDataFrame(data, pair).repartition(3), listed, reads.Layout("TGTGTGTG", "", 4, 4))
    sinks.write_demultiplexed(found, str(tmp_path / "d"))

    def read(mate, route):
        files = sorted((tmp_path / "d" / f"mate={mate}" / f"route={route}").glob("*.gz"))
        lines = "".join(gzip.open(p, "rt").read() for p in files).splitlines()
        return [tuple(lines[i : i + 4]) for i in range(0, len(lines), 4)]

    for route, n in (("demux", 26), ("spike", 14)):
        first, second = read("R1", route), read("R2", route)
        assert len(first) == n and [r[0][:-1] for r in first] == [r[0][:-1] for r in second]
        assert {r[1:] for r in second} == {("TTTT", "+x", "JJJJ")}
    assert ("@AAAAGGCC:r1 2", "TTTT", "+x", "JJJJ") in read("R2", "demux") and ("@r0 2", "TTTT", "+x", "JJJJ") in read("R2", "spike")
    assert ("@AAAAGGCC:r1 1", "ACGT", "+", "IIII") in read("R1", "demux")
