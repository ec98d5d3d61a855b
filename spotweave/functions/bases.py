"""Column expressions on bases: contexts of reference positions, conversion calls, read cycles and trimming.

``converted`` says what a converted base means: True where conversion marks methylated cytosines, False where
it marks unmethylated ones.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Flags of properly paired primary reads of the top and of the bottom strand (fixed values).
TOP_FLAGS, BOTTOM_FLAGS = [99, 147], [83, 163]
PAIRED_FLAGS = TOP_FLAGS + BOTTOM_FLAGS


def site_context(before: Column, base: Column, after: Column) -> Column:
    """``CG``, ``CA``, ``CC``, ``CT`` or null for a reference base between its neighbours (upper case; null past an end)."""
    forward = F.when(base == "C", F.when(after == "G", "CG").when(after.isin("A", "C", "T"), F.concat(F.lit("C"), after)))
    backward = F.when(base == "G", F.when(before == "T", "CA").when(before == "G", "CC").when(before == "A", "CT"))
    return F.coalesce(forward, backward)


def site_strand(context: Column, base: Column) -> Column:
    """``+`` or ``-`` for CH sites, null for CG sites, which stand for both strands."""
    return F.when(context != "CG", F.when(base == "C", "+").otherwise("-"))


def cg_methylated(pair: Column, converted: bool = True) -> Column:
    """Whether two read bases over a CG site show methylation; null if they show neither state."""
    return F.when(pair.isin("TG", "CA"), F.lit(converted)).when(pair == "CG", F.lit(not converted))


def ch_methylated(base: Column, strand: Column, converted: bool = True) -> Column:
    """Whether a read base over a CH site shows methylation; null if it shows neither state."""
    plus = F.when(base == "T", F.lit(converted)).when(base == "C", F.lit(not converted))
    minus = F.when(base == "A", F.lit(converted)).when(base == "G", F.lit(not converted))
    return F.when(strand == "+", plus).when(strand == "-", minus)


def neighbour_fits(context: Column, strand: Column, neighbour: Column) -> Column:
    """Whether the read base beside a CH site fits its context: CC also takes a converted neighbour."""
    plus = F.when(context == "CC", neighbour.isin("C", "T")).otherwise(neighbour == F.substring(context, 2, 1))
    minus = F.when(context == "CC", neighbour.isin("G", "A")).when(context == "CA", neighbour == "T").otherwise(neighbour == "A")
    return F.coalesce(F.when(strand == "+", plus).otherwise(minus), F.lit(False))


def top_bottom_methylated(base: Column, flag: Column) -> Column:
    """For the chemistry that converts unmethylated bases: C over T on the top strand, G over A on the bottom one."""
    top = F.when(base == "C", True).when(base == "T", False)
    bottom = F.when(base == "G", True).when(base == "A", False)
    return F.when(flag.isin(TOP_FLAGS), top).when(flag.isin(BOTTOM_FLAGS), bottom)


def is_reverse(flag: Column) -> Column:
    return flag.bitwiseAND(16) != 0


def read_label(flag: Column) -> Column:
    """``R1``, ``R2`` or null."""
    return F.when(flag.bitwiseAND(64) != 0, "R1").when(flag.bitwiseAND(128) != 0, "R2")


def cycle(flag: Column, qpos: Column, length: Column, max_cycle: int | None = None) -> Column:
    """The sequencing cycle (from 1) of a 0-based place in a read; with ``max_cycle`` R1 is aligned to its right end."""
    plain = F.when(is_reverse(flag), length - qpos).otherwise(qpos + 1)
    return plain if max_cycle is None else F.when(read_label(flag) == "R1", max_cycle - length + qpos + 1).otherwise(plain)


def trimmed(flag: Column, qpos: Column, length: Column, r1: tuple[int, int], r2: tuple[int, int]) -> Column:
    """Whether a place lies within the cycles cut from the left or right of its read; reverse reads are mirrored."""
    if not any(r1 + r2):
        return F.lit(False)
    cut = lambda k: F.when(read_label(flag) == "R1", r1[k]).when(read_label(flag) == "R2", r2[k]).otherwise(0)
    left = F.when(is_reverse(flag), length - qpos).otherwise(qpos + 1)
    right = F.when(is_reverse(flag), qpos + 1).otherwise(length - qpos)
    return (left <= cut(0)) | (right <= cut(1))


def confident(flag: Column, mapq: Column, hits: Column) -> Column:
    """Mapped, with a mapping quality over 10 and not known to have several hits."""
    return (flag.bitwiseAND(4) == 0) & (F.coalesce(mapq, F.lit(0)) > 10) & (F.coalesce(hits, F.lit(1)) <= 1)
