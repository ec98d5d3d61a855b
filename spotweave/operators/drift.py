"""One consistent table from files whose fields drift, and a report of every change.

Each file has a schema fingerprint: its column names and the types of their values. The registry holds each
fingerprint once with its schema. The files of a group are numbered in the order of their writing, and its schema
version rises wherever the fingerprint differs from that of the file before; only there are two files compared, and
the differences kept as migration steps: columns renamed (recognised by their unchanged values), dropped, given a
default and cast. Reading into one table then routes every file by its group and version through the chained
renames to the known fields, defaults for absent ones and cast rules; columns that lead to no field are reported.

Only schemas travel between files, one to a version; the values of two files meet only where columns both went and
came, and then by file and row key. A group with very many files is numbered in chunks like any other. Staged tables
are joined without hints: Spark knows the size of their files and broadcasts only those under its own limit.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import text_lines, trimmed
from ..staging import stage
from . import skew

#: Marks of a missing value, in lower case (fixed values).
MISSING = ["", "na", "n/a", "nan", "null", "."]
#: Types in the order of their codes; 0 is a column without values.
TYPES = ["none", "integer", "decimal", "text"]
_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def _missing(value: Column) -> Column:
    """Of trimmed text; no mark is longer than four letters."""
    return value.isNull() | ((F.length(value) <= 4) & F.lower(value).isin(MISSING))


def _type_code(value: Column) -> Column:
    return F.when(_missing(value), 0).when(~value.rlike(_NUMBER), 3).when(value.rlike("[.eE]"), 2).otherwise(1)


def read_files(files: DataFrame) -> DataFrame:
    """``file_id, grp, written_at, names, rows``: tab-separated files with a header, each file once.

    ``files`` has ``file_id, grp, written_at, received_at, content``. Of entries with one ``file_id`` the last
    received counts. ``names`` are the header's names, trimmed, with case; ``rows`` holds the lines' fields,
    trimmed too, blank lines left out. Null and empty contents have no names and no rows. Only the contents of files
    that are listed more than once are shuffled.
    """
    whole = files.select("file_id", "grp", "written_at", "received_at", "content")
    twice = whole.groupBy(F.col("file_id").alias("_id")).count().where("count > 1").select("_id")
    same = F.col("file_id").eqNullSafe(F.col("_id"))
    last = whole.join(twice, same, "left_semi").groupBy("file_id").agg(F.max(F.struct("received_at", "written_at", "grp", "content")).alias("f"))
    one = whole.join(twice, same, "left_anti").drop("received_at").unionByName(last.select("file_id", "f.grp", "f.written_at", "f.content"))
    lines = text_lines(F.ltrim(F.coalesce("content", F.lit("")), F.lit("﻿")))
    fields = lambda line: F.transform(F.split(line, "\t"), lambda x: trimmed(x))
    return (
        one.withColumn("lines", lines)
        .withColumn("names", fields(F.col("lines")[0]))
        .select(
            "file_id", "grp", "written_at",
            F.when(F.array_join("names", "") == "", F.array().cast("array<string>")).otherwise(F.col("names")).alias("names"),
            F.transform(F.filter(F.slice("lines", 2, F.greatest(F.size("lines") - 1, F.lit(0))), lambda x: trimmed(x) != ""), fields).alias("rows"),
        )
    )


def schemas(parsed: DataFrame, row_key: str = "barcode") -> DataFrame:
    """``file_id, grp, written_at, names, types, fingerprint``: the columns but the row key of each file and their type codes.

    A name that stands twice in a header counts where it stands first. The order of columns is not in the fingerprint.
    """
    names = F.filter(F.array_distinct("names"), lambda n: F.lower(n) != row_key)
    codes = F.aggregate("rows", F.transform("names", lambda n: F.lit(0)), lambda best, row: F.zip_with(best, row, lambda b, v: F.greatest(b, _type_code(v))))
    own = parsed.select("file_id", "grp", "written_at", F.col("names").alias("header"), names.alias("cols"), codes.alias("codes"))
    types = F.transform("cols", lambda n: F.get("codes", F.array_position("header", n).cast("int") - 1))
    rows = own.select("file_id", "grp", "written_at", F.col("cols").alias("names"), types.alias("types"))
    shape = F.array_sort(F.arrays_zip("names", "types")).cast("string")
    return rows.withColumn("fingerprint", F.sha2(F.concat_ws("\t", shape), 256))


@dataclass(frozen=True)
class History:
    """The schema versions of all groups: ``registry`` (``fingerprint, names, types``), ``files`` (``file_id, grp,
    version``) and ``runs``, the first file of each version (``head, grp, version, fingerprint, before, was``: that file,
    the one written just before and its fingerprint, null for a group's first). ``grp`` is the group with nulls as a key."""

    registry: DataFrame
    files: DataFrame
    runs: DataFrame


def history(parsed: DataFrame, row_key: str = "barcode") -> History:
    """Versions of the files of each group in the order of ``written_at``, then ``file_id``."""
    own = stage(schemas(parsed, row_key), "drift-schemas")
    registry = stage(own.groupBy("fingerprint").agg(F.first(F.struct("names", "types")).alias("s")).select("fingerprint", "s.*"), "drift-registry")
    key = F.coalesce(F.concat(F.lit("="), F.col("grp").cast("string")), F.lit(""))
    placed = skew.numbered_in_order(own, key, {"written_at": F.col("written_at"), "file_id": F.col("file_id")}, {"fingerprint": F.col("fingerprint")}).rows
    before = placed.select("_key", (F.col("_n") + 1).alias("_n"), F.col("file_id").alias("before"), F.col("fingerprint").alias("was"))
    pairs = placed.join(before, ["_key", "_n"], "left").withColumn("changed", F.when(F.col("fingerprint") == F.col("was"), 0).otherwise(1))
    counted = stage(skew.running_total(pairs, "changed", "version").withColumnRenamed("_key", "grp"), "drift-versions")
    runs = counted.where("changed = 1").select(F.col("file_id").alias("head"), "grp", "version", "fingerprint", "before", "was")
    return History(registry, counted.select("file_id", "grp", "version"), runs)


def _transitions(seen: History) -> DataFrame:
    """``runs`` that follow another, with the names that went (``gone``), came (``came``) and stayed (``stays``), by the registry."""
    now = seen.registry.select("fingerprint", F.col("names").alias("new"))
    then = seen.registry.select(F.col("fingerprint").alias("was"), F.col("names").alias("old"))
    kinds = seen.runs.where("before is not null").select("was", "fingerprint").distinct().join(now, "fingerprint").join(then, "was")
    sets = (F.array_except("old", "new").alias("gone"), F.array_except("new", "old").alias("came"), F.array_intersect("new", "old").alias("stays"))
    return seen.runs.join(kinds.select("was", "fingerprint", *sets), ["was", "fingerprint"])


def _rows(files: DataFrame, columns: list[str], row_key: str) -> DataFrame:
    """``columns, key, values`` of ``files`` with ``wanted``, the names whose values are picked: each row key by its last line.

    A file's rows lie in one record, so they are sorted by key there and nothing is shuffled.
    """
    at = F.array_position(F.transform("names", lambda n: F.lower(n)), row_key).cast("int") - 1
    spots = F.transform("wanted", lambda n: F.array_position("names", n).cast("int") - 1)
    placed = files.select(*columns, "rows", at.alias("_at"), spots.alias("_spots"))
    row = lambda f, i: F.struct(F.upper(F.get(f, F.col("_at"))).alias("key"), (-i).alias("line"), F.transform("_spots", lambda p: F.get(f, p)).alias("values"))
    keyed = F.filter(F.transform("rows", row), lambda r: r["key"].isNotNull() & (r["key"] != ""))
    ordered = placed.select(*columns, F.array_sort(keyed).alias("_r"))
    first = F.filter("_r", lambda x, i: (i == 0) | (F.get("_r", i - 1)["key"] != x["key"]))
    return ordered.select(*columns, F.explode(first).alias("_r")).select(*columns, "_r.key", "_r.values")


def renames(parsed: DataFrame, changed: DataFrame, row_key: str = "barcode") -> DataFrame:
    """``head, old_name, new_name``: columns that went and came with the same text, or missing, at all shared rows.

    At least one row must be shared. Equal columns that go together may pair with each other in every way.
    """
    both = changed.where((F.size("gone") > 0) & (F.size("came") > 0)).select("head", "before", "gone", "came")
    side = lambda file, names: parsed.join(both.select("head", F.col(file).alias("file_id"), F.col(names).alias("wanted")), "file_id")
    now = _rows(side("head", "came"), ["head"], row_key).withColumnRenamed("values", "news")
    then = _rows(side("before", "gone"), ["head"], row_key).withColumnRenamed("values", "olds")
    text = lambda v: F.when(~_missing(v), v)
    met = now.join(then, ["head", "key"]).select("head", F.posexplode("news").alias("i", "n"), "olds").select("head", "i", "n", F.posexplode("olds").alias("j", "o"))
    alike = met.groupBy("head", "i", "j").agg(F.bool_and(text(F.col("n")).eqNullSafe(text(F.col("o")))).alias("same")).where("same")
    named = alike.join(both.select("head", "gone", "came"), "head")
    return named.select("head", F.get("gone", F.col("j")).alias("old_name"), F.get("came", F.col("i")).alias("new_name"))


def _columns(seen: History, changed: DataFrame, moved: DataFrame) -> DataFrame:
    """``head, grp, version, name, code, prev, old_name``: each column of each version and the column of the version before (first file ``prev``) it continues."""
    prev = seen.runs.select("grp", (F.col("version") + 1).alias("version"), F.col("head").alias("prev"))
    runs = seen.runs.select("head", "grp", "version", "fingerprint").join(prev, ["grp", "version"], "left")
    cols = runs.join(seen.registry, "fingerprint").select("head", "grp", "version", "prev", F.explode(F.arrays_zip("names", "types")).alias("c"))
    stays = changed.select("head", F.explode("stays").alias("name")).select("head", "name", F.col("name").alias("old_name"))
    step = stays.unionByName(moved.groupBy("head", F.col("new_name").alias("name")).agg(F.min("old_name").alias("old_name")))
    own = cols.select("head", "grp", "version", F.col("c.names").alias("name"), F.col("c.types").alias("code"), "prev")
    return own.join(step, ["head", "name"], "left")


def _ends(links: DataFrame) -> DataFrame:
    """``a, b, to_a, to_b`` with each pointer moved on to the first place from which none leads on, by doubling.

    Only places from which a pointer leads on are held; there is one round for each doubling of the longest chain.
    """
    links = stage(links.select("a", "b", "to_a", "to_b"), "drift-links")
    while True:
        onward = links.select(F.col("a").alias("to_a"), F.col("b").alias("to_b"), F.col("to_a").alias("next_a"), F.col("to_b").alias("next_b"))
        jumped = links.join(onward, ["to_a", "to_b"], "left")
        moves = F.col("next_b").isNotNull()
        moved = stage(
            jumped.select("a", "b", F.when(moves, F.col("next_a")).otherwise(F.col("to_a")).alias("to_a"), F.when(moves, F.col("next_b")).otherwise(F.col("to_b")).alias("to_b"), moves.alias("moves")),
            "drift-links",
        )
        links = moved.drop("moves")
        if moved.where("moves").isEmpty():
            return links


def _typed(columns: DataFrame) -> DataFrame:
    """``head, name, code`` of the columns with the type of the values they have or, without values, last had."""
    known = columns.where("code > 0").select("head", "name", "code")
    open_ = columns.where("code = 0 and old_name is not null").select(F.col("head").alias("a"), F.col("name").alias("b"), F.col("prev").alias("to_a"), F.col("old_name").alias("to_b"))
    if open_.isEmpty():
        return known
    target = known.select(F.col("head").alias("to_a"), F.col("name").alias("to_b"), "code")
    return known.unionByName(_ends(open_).join(target, ["to_a", "to_b"]).select(F.col("a").alias("head"), F.col("b").alias("name"), "code"))


@dataclass(frozen=True)
class Drift:
    """What ``compared`` found: the versions, the runs that changed, the renames, and each column with the one it continues."""

    seen: History
    changed: DataFrame
    moved: DataFrame
    columns: DataFrame


def compared(parsed: DataFrame, row_key: str = "barcode") -> Drift:
    """The neighbouring versions of each group compared."""
    seen = history(parsed, row_key)
    changed = stage(_transitions(seen), "drift-changed")
    moved = stage(renames(parsed, changed, row_key), "drift-renames")
    return Drift(seen, changed, moved, stage(_columns(seen, changed, moved), "drift-columns"))


def _changed(found: Drift, code: DataFrame) -> DataFrame:
    """``head, change, old_name, new_name``."""
    moved = found.moved
    gone = found.changed.select("head", F.explode("gone").alias("old_name")).join(moved, ["head", "old_name"], "left_anti").withColumn("new_name", F.lit(""))
    came = found.changed.select("head", F.explode("came").alias("new_name")).join(moved, ["head", "new_name"], "left_anti").withColumn("old_name", F.lit(""))
    now, then = code.select("head", F.col("name").alias("new_name"), F.col("code").alias("new")), code.select(F.col("head").alias("prev"), F.col("name").alias("old_name"), F.col("code").alias("old"))
    kept = found.columns.where("old_name is not null").select("head", "prev", "old_name", F.col("name").alias("new_name"))
    kept = kept.join(now, ["head", "new_name"]).join(then, ["prev", "old_name"]).where("new <> old").select("head", "old_name", "new_name")
    parts = [d.select("head", F.lit(c).alias("change"), "old_name", "new_name") for c, d in (("renamed", moved), ("removed", gone), ("added", came), ("retyped", kept))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


def changes(parsed: DataFrame, row_key: str = "barcode") -> DataFrame:
    """``file_id, change, old_name, new_name`` against the file of the group written just before.

    ``renamed``, ``removed`` (``new_name`` is ''), ``added`` (``old_name`` is '') and ``retyped`` (a column that
    stays or is renamed and whose type differs). Types: text if any value is no number, else decimal if any has a
    point or an exponent, else integer; a column without values keeps the type it had, and one that never had
    values has none and is not retyped when they come. The first file of a group, the order of columns and rows
    sent twice are no change; an empty table has none.
    """
    found = compared(parsed, row_key)
    return _changed(found, _typed(found.columns)).withColumnRenamed("head", "file_id")


def steps(found: Drift) -> DataFrame:
    """``file_id, grp, version, change, old_name, new_name, old_type, new_type``: the migration steps into each version of a
    group, at its first file: the ``changes`` with the types of both columns; an added column's default is null."""
    code = stage(_typed(found.columns), "drift-types")
    prev = found.columns.where("prev is not null").select("head", "prev").distinct()
    now, then = code.select("head", F.col("name").alias("new_name"), F.col("code").alias("new")), code.select(F.col("head").alias("prev"), F.col("name").alias("old_name"), F.col("code").alias("old"))
    rows = _changed(found, code).join(found.seen.runs.select("head", "grp", "version"), "head").join(prev, "head", "left")
    rows = rows.join(now, ["head", "new_name"], "left").join(then, ["prev", "old_name"], "left")
    kind = lambda c: F.get(F.array(*map(F.lit, TYPES)), F.coalesce(F.col(c), F.lit(0)))
    return rows.select(
        F.col("head").alias("file_id"), _group("grp"), "version", "change", "old_name", "new_name",
        F.when(F.col("old_name") != "", kind("old")).alias("old_type"), F.when(F.col("new_name") != "", kind("new")).alias("new_type"),
    )


def _group(key: str) -> Column:
    return F.when(F.col(key) != "", F.substr(key, F.lit(2))).alias("grp")


def fields_of(found: Drift, fields: list[str]) -> DataFrame:
    """``head, grp, version, name, field, how``: what each column of each version is.

    A column is linked with all it was renamed from and to. It is the field that one of these is called (in any case),
    the earliest if there are several: ``how`` is ``name`` or, under another name, ``renamed``. A column linked
    with no field, but called what was renamed from or to a field in other places, is that field too: ``alias``, by
    the most such renames, of equally many the first by the alphabet. Of several columns of one version that are the same field the most direct counts, the
    others are ``shadowed``. All others have no field: ``unknown``.
    """
    first = F.col("old_name").isNull() | (F.col("old_name") != F.col("name"))
    w = Window.partitionBy("grp", "name").orderBy("version")  # the times that a name came in a group
    events = found.columns.where(first).select("head", "grp", "name", "version", "old_name", (F.lead("version").over(w) - 1).alias("until"))
    events = stage(events.withColumn("until", F.coalesce("until", F.lit((1 << 62)))), "drift-events")
    spans = events.select("grp", F.col("name").alias("_name"), F.col("version").alias("_since"), "until", F.col("head").alias("_from"))

    def event_of(df: DataFrame, name: str, version: Column) -> DataFrame:
        """``df`` with ``_from``, the first file of the span in which the group's column of that name lies."""
        at = df.withColumn("_at", version).withColumn("_name", F.col(name)).join(spans, ["grp", "_name"])
        return at.where(F.col("_at").between(F.col("_since"), F.col("until"))).drop("_at", "_name", "_since", "until")

    linked = event_of(events.where("old_name is not null").drop("until"), "old_name", F.col("version") - 1)
    ends = _ends(linked.select(F.col("head").alias("a"), F.col("name").alias("b"), F.col("_from").alias("to_a"), F.col("old_name").alias("to_b")))
    ends = ends.select(F.col("a").alias("head"), F.col("b").alias("name"), F.struct("to_a", "to_b").alias("root"))
    own = F.struct(F.col("head").alias("to_a"), F.col("name").alias("to_b"))
    chains = stage(events.join(ends, ["head", "name"], "left").select("head", "name", "version", F.coalesce("root", own).alias("root"), F.lower("name").alias("low")), "drift-chains")
    known = F.col("low").isin([f.lower() for f in fields])
    named = chains.where(known).groupBy("root").agg(F.min(F.struct("version", "low"))["low"].alias("known"))
    other = chains.where(~known).join(named, "root", "left")
    proofs = other.where("known is not null").select("root", "low", "known").distinct().groupBy("low", "known").agg(F.count(F.lit(1)).alias("n"))
    alias = proofs.groupBy("low").agg(F.min_by("known", F.struct(-F.col("n"), "known")).alias("alias"))
    proven = other.where("known is null").join(alias, "low")
    called = proven.groupBy("root").agg(F.min(F.struct("version", "low", "alias"))["alias"].alias("alias"))
    what = chains.join(named, "root", "left").join(called, "root", "left").select(F.col("head").alias("_from"), F.col("name").alias("_own"), "known", "alias")
    placed = event_of(found.columns.select("head", "grp", "version", "name"), "name", F.col("version")).withColumn("_own", F.col("name"))
    rows = placed.join(what, ["_from", "_own"]).withColumn("field", F.coalesce("known", "alias"))
    rank = F.when(F.col("field") == F.lower("name"), 0).when(F.col("known").isNotNull(), 1).when(F.col("alias").isNotNull(), 2)
    best = Window.partitionBy("head", "field").orderBy("_rank", "name")  # the columns of one version
    ranked = rows.withColumn("_rank", rank).withColumn("_place", F.row_number().over(best))
    how = F.when(F.col("field").isNull(), "unknown").when(F.col("_place") > 1, "shadowed").otherwise(F.get(F.array(*map(F.lit, ["name", "renamed", "alias"])), F.col("_rank")))
    return ranked.select("head", "grp", "version", "name", F.when(how != "shadowed", F.col("field")).alias("field"), how.alias("how"))


def file_columns(found: Drift, fields: list[str]) -> DataFrame:
    """``file_id, name, field, how`` of the columns of all files, as ``fields_of`` says for their versions."""
    maps = stage(fields_of(found, fields).drop("head"), "drift-fields")
    return found.seen.files.join(maps, ["grp", "version"]).select("file_id", "name", "field", "how")


def as_number(value: Column) -> Column:
    """The cast rules: a number as it stands, or without a leading mark (``+ ~ < > =``), a percent sign or a unit
    behind it; with a decimal comma or grouping commas; hexadecimal (``0x``); else null."""
    v = trimmed(value)
    bare = F.regexp_replace(v, r"^[~<>=]+\s*|\s*%$|\s+[A-Za-z]+$", "")
    grouped = F.when(bare.rlike(r"^[+-]?\d{1,3}(,\d{3})+(\.\d+)?$"), F.replace(bare, F.lit(","), F.lit("")))
    comma = F.when(bare.rlike(r"^[+-]?\d+,\d+$"), F.replace(bare, F.lit(","), F.lit(".")))
    hexed = F.when(bare.rlike(r"^0[xX][0-9A-Fa-f]{1,15}$"), F.conv(F.substring(bare, 3, 15), 16, 10))
    odd = F.coalesce(F.when(bare.rlike(_NUMBER), bare), grouped, comma, hexed)
    return F.when(_missing(v), None).when(v.rlike(_NUMBER), v).otherwise(odd).try_cast("double")


def unified(parsed: DataFrame, fields: list[str], counts: set[str], row_key: str = "barcode") -> DataFrame:
    """``file_id, grp, version, key`` and ``fields`` of all files: one consistent table, one row per row key and file.

    Columns are taken by ``fields_of``. Fields in ``counts`` are bigint, the others double; an absent
    field, a missing value and one that no cast rule reads are null. ``n_uncast`` counts the latter, and ``n_unmapped`` the
    file's columns that are no field. Of lines with one row key the last counts.
    """
    found = compared(parsed, row_key)
    maps = fields_of(found, fields).groupBy("grp", "version").agg(
        *(F.max(F.when(F.col("field") == f.lower(), F.col("name"))).alias(f"_{i}") for i, f in enumerate(fields)), F.count_if(F.col("field").isNull()).cast("int").alias("n_unmapped")
    )
    routes = found.seen.files.join(stage(maps, "drift-maps"), ["grp", "version"], "left")
    wanted = F.array(*(F.coalesce(f"_{i}", F.lit("")) for i in range(len(fields)))).alias("wanted")
    routes = routes.select("file_id", "grp", "version", F.coalesce("n_unmapped", F.lit(0)).alias("n_unmapped"), wanted)
    files = parsed.select("file_id", F.transform("names", lambda n: F.when(n != "", n)).alias("names"), "rows").join(routes, "file_id")
    cells = _rows(files, ["file_id", "grp", "version", "n_unmapped"], row_key)
    raw = [F.get("values", F.lit(i)) for i in range(len(fields))]
    typed = cells.select("file_id", "grp", "version", "key", "n_unmapped", *(r.alias(f"_r{i}") for i, r in enumerate(raw)), *(as_number(r).alias(f"_n{i}") for i, r in enumerate(raw)))
    uncast = sum((F.when(~_missing(F.col(f"_r{i}")) & F.col(f"_n{i}").isNull(), 1).otherwise(0) for i in range(len(fields))), F.lit(0))
    cast = [(F.round(f"_n{i}").cast("long") if f in counts else F.col(f"_n{i}")).alias(f) for i, f in enumerate(fields)]
    return typed.select("file_id", _group("grp"), "version", "key", *cast, uncast.alias("n_uncast"), "n_unmapped")
