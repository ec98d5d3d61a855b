"""Loading of comma-separated FASTQ records with the rows that cannot be read set aside.

Structural rejects (broken quoting, wrong number of fields) come out first, the second kind through the
invalid-row callback of pyarrow's CSV reader; the fields of the others are read as strings, and vectorised
checks label the first failing cell. Everything happens within one pass over the input, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import csv
from pyspark.sql import DataFrame
from pyspark.sql import types as T

FIELDS = ["name", "seq", "plus", "qual"]
_FIELD = r'(?:"(?:[^"]|"")*"|[^",]*)'
_WELL_QUOTED = rf"(?s)\A{_FIELD}(?:,{_FIELD})*\z"
_ARROW = pa.schema([("row_id", pa.int64()), *((f, pa.string()) for f in FIELDS), ("reason", pa.string())])
_MARK = "\ue000"


def _hidden(lines: pa.ChunkedArray | pa.Array, back: bool = False) -> pa.Array:
    """Line breaks within a row, written so that the CSV reader takes them for ordinary characters."""
    pairs = [(_MARK, _MARK + "m"), ("\n", _MARK + "n"), ("\r", _MARK + "r")]
    for plain, hidden in reversed(pairs) if back else pairs:
        old, new = (hidden, plain) if back else (plain, hidden)
        lines = pc.replace_substring(lines, old, new)
    return lines


def _fields(numbers: pa.Array, lines: pa.Array) -> tuple[pa.Table, set[int]]:
    """The fields of well-quoted lines with their numbers, and the numbers of lines with other than four fields."""
    wrong: set[int] = set()

    def invalid(row: csv.InvalidRow) -> str:
        wrong.add(int(row.text.partition(",")[0]))
        return "skip"

    text = pc.binary_join_element_wise(pc.cast(numbers, pa.string()), lines, ",")
    data = pc.binary_join(pa.ListArray.from_arrays([0, len(text)], text), "\n")[0].as_py().encode()
    table = csv.read_csv(
        pa.BufferReader(data),
        read_options=csv.ReadOptions(column_names=["i", *FIELDS], use_threads=False, block_size=len(data) + 2),
        parse_options=csv.ParseOptions(invalid_row_handler=invalid, ignore_empty_lines=False),
        convert_options=csv.ConvertOptions(
            column_types={"i": pa.int64(), **{f: pa.string() for f in FIELDS}}, strings_can_be_null=False, quoted_strings_can_be_null=False
        ),
    )
    return table, wrong


def _labels(t: pa.Table) -> pa.Array:
    """The first reason that holds for each row of fields, or null."""
    ok = [
        ("name", pc.match_substring_regex(t["name"], r"(?s)\A@.")),
        ("seq", pc.match_substring_regex(t["seq"], r"\A[ACGTNacgtn]+\z")),
        ("plus", pc.starts_with(t["plus"], "+")),
        ("qual", pc.match_substring_regex(t["qual"], r"\A[!-~]+\z")),
        ("length", pc.equal(pc.utf8_length(t["seq"]), pc.utf8_length(t["qual"]))),
    ]
    return pc.case_when(pc.make_struct(*(pc.invert(x) for _, x in ok)), *(pa.scalar(k) for k, _ in ok), pa.scalar(None, pa.string()))


def _split(ids: pa.Array, lines: pa.Array) -> pa.Table:
    number = pa.array(range(len(ids)), pa.int64())
    given = pc.is_valid(lines)
    well = pc.and_(given, pc.fill_null(pc.match_substring_regex(lines, _WELL_QUOTED), False))
    out = []

    def rejected(rows: pa.Array, reason: str) -> None:
        n = len(rows)
        if n:
            out.append(pa.table([pc.take(ids, rows), *([pa.nulls(n, pa.string())] * 4), pa.array([reason] * n, pa.string())], schema=_ARROW))

    rejected(pc.filter(number, pc.invert(given)), "columns")
    rejected(pc.filter(number, pc.and_(given, pc.invert(well))), "quoting")
    rows = pc.filter(number, well)
    if len(rows):
        text = _hidden(pc.filter(lines, well))
        fields, wrong = _fields(rows, text)
        rejected(pa.array(sorted(wrong), pa.int64()), "columns")
        if fields.num_rows:
            cells = fields.select(FIELDS)
            if pc.any(pc.match_substring(text, _MARK)).as_py():
                cells = pa.table([_hidden(cells[f], back=True) for f in FIELDS], FIELDS)
            reason = _labels(cells)
            out.append(pa.table([pc.take(ids, fields["i"]), *cells.columns, reason], schema=_ARROW))
    return pa.concat_tables(out) if out else _ARROW.empty_table()


def _each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            found = _split(pa.array(range(batch.num_rows), pa.int64()), batch.column(1))
            place, others = found["row_id"].combine_chunks(), [0, *range(2, batch.num_columns)]
            kept, names = [batch.column(k).take(place) for k in others], [batch.schema.names[k] for k in others]
            cells = [found[f].combine_chunks() for f in (*FIELDS, "reason")]
            yield pa.RecordBatch.from_arrays([kept[0], *cells, *kept[1:]], [names[0], *FIELDS, "reason", *names[1:]])


def parse_rows(df: DataFrame, row_id: str = "row_id", raw_line: str = "raw_line", keep: tuple[str, ...] = ()) -> DataFrame:
    """``row_id, name, seq, plus, qual, reason`` and the columns of ``keep``: one row for each row of ``df``.

    ``reason`` is null for a row that loads; else it is the first that holds of ``quoting``, ``columns``,
    ``name``, ``seq``, ``plus``, ``qual`` and ``length``. A structural reject has null fields, another keeps
    what was read. A null line has no fields: ``columns``; so has an empty one. Nothing is trimmed, a field
    in quotes may hold commas, doubled quotes and line breaks, texts may be of any length. Rows sent twice
    come out twice, an empty table gives an empty one, and no other column of ``df`` is read.
    """
    rows = df.select(df[row_id].cast("long").alias("row_id"), df[raw_line].alias("raw_line"), *keep)
    text = [T.StructField(f, T.StringType()) for f in (*FIELDS, "reason")]
    return rows.mapInArrow(_each, T.StructType([rows.schema["row_id"], *text, *rows.schema.fields[2:]]))


def loaded(parsed: DataFrame) -> DataFrame:
    """The rows of ``parse_rows`` that load."""
    return parsed.where("reason is null").drop("reason")


def rejected(parsed: DataFrame) -> DataFrame:
    """``row_id, reason`` of the rows of ``parse_rows`` that don't load."""
    return parsed.where("reason is not null").select("row_id", "reason")
