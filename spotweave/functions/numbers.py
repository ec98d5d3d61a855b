"""Column expressions on numbers, tolerant casts and text forms of numbers."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def percent(meth: Column, total: Column) -> Column:
    """``meth`` in percent of ``total`` to two places, halves to even; null for an empty total."""
    return F.when(total > 0, F.bround(meth / total * 100, 2))


def as_int(text: Column) -> Column:
    """A whole number from a text such as ``12``, ``12.0`` or ``1e3``, cut towards zero; null for anything else."""
    value = F.trim(text).try_cast("double")
    return F.when(~F.isnan(value) & (F.abs(value) < 9e18), value.cast("long"))


def as_float(text: Column) -> Column:
    """A finite number from a text, else null."""
    value = F.trim(text).try_cast("double")
    return F.when(~F.isnan(value) & (F.abs(value) < float("inf")), value)


def first_json(document: Column, *paths: str) -> Column:
    """The first of several JSON paths that holds something; null for what is no JSON."""
    return F.coalesce(*(F.get_json_object(document, p) for p in paths))


def bin_label(width: int) -> str:
    """``500bp``, ``10k``, ``1.5k``, ``1M``; a width under 1 is an error."""
    if width < 1:
        raise ValueError(f"bin width {width}")
    for size, unit in ((1_000_000, "M"), (1_000, "k")):
        if width >= size:
            whole, rest = divmod(width, size)
            return f"{whole}{f'.{rest:0{len(str(size)) - 1}}'.rstrip('0').rstrip('.')}{unit}"
    return f"{width}bp"


def formatted(pattern: str, missing: str = "NA"):
    """A UDF that writes numbers as Python's ``pattern`` does (``.2f``, ``,``, ``.6g``) and nulls as ``missing``."""

    @F.pandas_udf(T.StringType())
    def write(values: pd.Series) -> pd.Series:
        whole = "f" not in pattern and "g" not in pattern
        return values.map(lambda v: missing if pd.isna(v) else format(int(v) if whole else v, pattern))

    return write
