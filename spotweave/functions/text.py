"""Column expressions on text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WHITE = " \t\n\x0b\x0c\r"


def trimmed(c: Column | str) -> Column:
    """Without leading and trailing ASCII white space."""
    return F.btrim(F.col(c) if isinstance(c, str) else c, F.lit(WHITE))


def spot_key(c: Column | str) -> Column:
    """A barcode in its one spelling: trimmed, upper case."""
    return F.upper(trimmed(c))


def text_lines(c: Column | str) -> Column:
    """The lines of a text with any kind of line ends."""
    return F.split(F.col(c) if isinstance(c, str) else c, "\r\n|\n|\r")


def parse_list(text: str) -> list[str]:
    """The items of a comma-separated list, trimmed, each once; an empty list is an error."""
    items = list(dict.fromkeys(x.strip() for x in text.split(",") if x.strip()))
    if not items:
        raise ValueError("the list is empty")
    return items


def name_spot(name: Column | str) -> Column:
    """The spot at the front of a read's name, ``@<spot>:`` or ``<spot>:``, null for a name without one."""
    return F.nullif(F.regexp_extract(F.col(name) if isinstance(name, str) else name, "^@?([ACGTN]+):", 1), F.lit(""))
