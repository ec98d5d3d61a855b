"""Column expressions that find short patterns in reads. Places are 0-based; null means not found.

Windows are compared inside one expression, so a read never leaves its row or the JVM. Only the search that
allows insertions and deletions runs over Arrow batches, and only on reads that nothing simpler matched.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def hamming(a: Column, b: Column, n: int) -> Column:
    """How many of the first ``n`` letters differ."""
    return F.aggregate(
        F.sequence(F.lit(1), F.lit(n)), F.lit(0), lambda d, i: d + F.when(F.substr(a, i, F.lit(1)) != F.substr(b, i, F.lit(1)), 1).otherwise(0)
    )


def exact_places(text: Column, pattern: str, first: Column | int = 0, last: Column | None = None) -> Column:
    """All places of ``pattern``, overlapping ones too, that begin at ``first`` at least and end by ``last``."""
    lo = F.lit(first) if isinstance(first, int) else first
    hi = (F.length(text) if last is None else F.least(last, F.length(text))) - len(pattern)
    starts = F.when(hi >= lo, F.sequence(lo.cast("int"), hi.cast("int"))).otherwise(F.array().cast("array<int>"))
    return F.filter(starts, lambda i: F.substr(text, i + 1, F.lit(len(pattern))) == pattern)


#: Up to so many spellings with wildcards are searched as one regular expression.
MAX_SPELLINGS = 2000


def leftmost_place(text: Column, pattern: str, distance: int, first: Column | int = 0, last: Column | None = None) -> Column:
    """The first exact place, else the leftmost, not the best, place with at most ``distance`` mismatches.

    A place with few mismatches fits the pattern with wildcards at so many of its letters; the alternation of these
    spellings is one regular expression, which finds its leftmost fit. With too many spellings each window is compared.
    """
    n = len(pattern)
    lo = F.lit(first) if isinstance(first, int) else first
    end = F.length(text) if last is None else F.least(last, F.length(text))
    window = F.substr(text, lo + 1, F.greatest(end - lo, F.lit(0)))
    found = F.nullif(F.instr(window, pattern), F.lit(0))
    if distance:
        if math.comb(n, distance) > MAX_SPELLINGS:
            starts = F.when(end - n >= lo, F.sequence(lo.cast("int"), (end - n).cast("int"))).otherwise(F.array().cast("array<int>"))
            near = F.filter(starts, lambda i: hamming(F.substr(text, i + 1, F.lit(n)), F.lit(pattern), n) <= distance)
            return F.coalesce(lo + found - 1, F.get(near, F.lit(0)))
        spellings = ("".join("." if i in k else re.escape(c) for i, c in enumerate(pattern)) for k in map(set, combinations(range(n), distance)))
        found = F.coalesce(found, F.nullif(F.regexp_instr(window, F.lit("(?s)" + "|".join(spellings))), F.lit(0)))
    return lo + found - 1


def unique_place(text: Column, pattern: str, distance: int, first: Column | int = 0, last: Column | None = None) -> Column:
    """The only exact place; without an exact one, the only place of the least number of mismatches up to ``distance``.

    ``N`` in the pattern fits every base. Several equally good places give null.
    """
    n = len(pattern)
    fixed = [i for i, c in enumerate(pattern, 1) if c != "N"]
    lo = F.lit(first) if isinstance(first, int) else first
    hi = (F.length(text) if last is None else F.least(last, F.length(text))) - n
    starts = F.when(hi >= lo, F.sequence(lo.cast("int"), hi.cast("int"))).otherwise(F.array().cast("array<int>"))
    wrong = lambda i: F.aggregate(
        F.array(*map(F.lit, fixed)), F.lit(0),
        lambda d, k: d + F.when(F.substr(text, i + k, F.lit(1)) != F.substr(F.lit(pattern), k, F.lit(1)), 1).otherwise(0),
    )
    scored = F.transform(starts, lambda i: F.struct(wrong(i).alias("d"), i.alias("i")))
    nothing = F.struct(F.lit(distance + 1).alias("d"), F.lit(0).alias("n"), F.lit(-1).alias("i"))
    better = lambda b, s: F.struct(
        F.least(b["d"], s["d"]).alias("d"),
        F.when(s["d"] < b["d"], 1).otherwise(b["n"] + F.when(s["d"] == b["d"], 1).otherwise(0)).alias("n"),
        F.when(s["d"] < b["d"], s["i"]).otherwise(b["i"]).alias("i"),
    )
    best = F.aggregate(scored, nothing, better)
    return F.aggregate(F.array(best), F.lit(-1), lambda _, b: F.when((b["d"] <= distance) & (b["n"] == 1), b["i"]).otherwise(-1), lambda i: F.when(i >= 0, i))


def motif_pattern(sequence: str) -> str:
    """A regular expression in which each C of the sequence may have been read as T."""
    return re.sub("C", "[CT]", sequence.upper())


def motif_place(text: Column, sequence: str) -> Column:
    """A struct of ``status`` (``hit``, ``none``, ``ambiguous``, ``too_short``) and ``place`` of a motif with converted Cs."""
    p = F.lit(motif_pattern(sequence))
    n = F.regexp_count(text, p)
    status = F.when(F.length(text) < len(sequence), "too_short").when(n == 0, "none").when(n == 1, "hit").otherwise("ambiguous")
    return F.struct(status.alias("status"), F.when(status == "hit", F.regexp_instr(text, p) - 1).alias("place"))


def _near_places(text: str, pattern: str, distance: int) -> list[tuple[int, int]]:
    """Ends and edit distances of the substrings of ``text`` that are locally nearest to ``pattern`` (numpy column sweep)."""
    m = len(pattern)
    codes = np.frombuffer(pattern.encode(), np.uint8)
    column = np.arange(m + 1)
    rows, out = np.arange(m + 1), []
    for j, ch in enumerate(text.encode(), 1):
        step = np.empty(m + 1, int)
        step[0] = 0
        step[1:] = np.minimum(column[:-1] + (codes != ch), column[1:] + 1)
        column = np.minimum.accumulate(step - rows) + rows
        if column[m] <= distance:
            out.append((j, int(column[m])))
    return out


def nearest_place(text: str, pattern: str, distance: int) -> int | None:
    """Where the only substring of least edit distance up to ``distance`` begins; separate equally near ones give None."""
    near = _near_places(text, pattern, distance)
    if not near:
        return None
    least = min(d for _, d in near)
    ends = [j for j, d in near if d == least]
    if ends[-1] - ends[0] != len(ends) - 1 or len(ends) > 1 + least:
        return None
    back = _near_places(text[: ends[0]][::-1], pattern[::-1], least)
    fits = [j for j, d in back if d == least and j >= len(pattern) - least]
    return ends[0] - fits[0] if fits else None


def with_edit_places(df: DataFrame, place: str, text: str, pattern: str, distance: int) -> DataFrame:
    """``df`` with nulls of ``place`` filled by the search that allows indels, in Arrow batches; a null text stays without."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, texts = batch[place].to_pylist(), batch[text].to_pylist()
            found = [nearest_place(t, pattern, distance) if p is None and t else p for p, t in zip(at, texts)]
            k = batch.schema.get_field_index(place)
            yield batch.set_column(k, place, pa.array(found, pa.int32()))

    return df.withColumn(place, F.col(place).cast("int")).mapInArrow(run, df.withColumn(place, F.col(place).cast("int")).schema)
