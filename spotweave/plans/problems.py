"""The queries of the general data-preparation problems, and the SQL that checks them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import spot_key
from ..operators import compaction, drift, rejects, skew
from ..staging import new_path, stage

#: Fields of the per-spot methylation statistics (fixed values).
MEANS = ["mean_5mCG", "mean_5mCH", "mean_5mCA", "mean_5mCC", "mean_5mCT"]
COUNTS = ["cpg_site_count", "ch_site_count", "ca_site_count", "cc_site_count", "ct_site_count"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _compacted(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    store = compaction.SnapshotTable(spark, new_path(spark, "compacted"))
    files = compaction.with_parts(table(spark, sf_dir, "count_files"), table=store)
    small = compaction.TARGET_BYTES // 2
    listed = stage(compaction.listing(files, small), "compact-listing")
    compaction.compact(files, store, max_small_files=1, small_bytes=small, listed=listed)
    return files, compaction.all_records(files, store, listed)


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compaction.adding_nothing(*_compacted(spark, sf_dir))


def p1_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _compacted(spark, sf_dir)[1].drop("part")


def p1_in_two_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table after two runs: one when half of the files had come, one when all had."""
    store = compaction.SnapshotTable(spark, new_path(spark, "compacted"))
    files = compaction.with_parts(table(spark, sf_dir, "count_files"), table=store)
    half = files.agg(F.percentile_approx("received_at", 0.5)).first()[0]
    for some in (files.where(F.col("received_at") <= half), files):
        compaction.compact(some, store, max_small_files=1, small_bytes=compaction.TARGET_BYTES // 2)
    return store.read().drop("part")


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rejects.rejected(rejects.parse_rows(table(spark, sf_dir, "fastq_rows")))


def p2_loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rejects.loaded(rejects.parse_rows(table(spark, sf_dir, "fastq_rows")))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    hot = skew.hot_keys(table(spark, sf_dir, "spot_counts"), spot_key("barcode"), F.col("reads"), one_in=50)
    return hot.select(F.col("key").alias("barcode"))


def p3_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = skew.key_totals(table(spark, sf_dir, "spot_counts"), spot_key("barcode"), F.col("reads"))
    return totals.select(F.col("key").alias("barcode"), "n_rows", "n_values", "total", "least", "greatest")


def p3_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = F.unix_micros(F.col("counted_at").cast("timestamp"))
    tie = F.struct("count_id", "received_at", F.coalesce("contig", F.lit("")))
    runs = skew.key_runs(table(spark, sf_dir, "spot_counts"), spot_key("barcode"), at, tie, F.col("contig"))
    return runs.select(F.col("key").alias("barcode"), "n_rows", "n_runs", F.col("longest_gap").alias("longest_gap_us"))


def _stats_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage(drift.read_files(table(spark, sf_dir, "meth_stats_files").withColumnRenamed("sample_id", "grp")), "drift-parsed")


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drift.changes(_stats_files(spark, sf_dir))


def p4_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The statistics of all files in one table."""
    one = drift.unified(_stats_files(spark, sf_dir), MEANS + COUNTS, set(COUNTS))
    return one.withColumnsRenamed({"grp": "sample_id", "key": "barcode"})


def p4_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drift.steps(drift.compared(_stats_files(spark, sf_dir))).withColumnRenamed("grp", "sample_id")


def p4_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each column of each file is: a field by its name, by renames, by an alias proven elsewhere, or none."""
    return drift.file_columns(drift.compared(_stats_files(spark, sf_dir)), MEANS + COUNTS)


QUERIES = {f.__name__: f for f in (p1_found, p1_compacted, p1_in_two_runs, p2_found, p2_loaded, p3_found, p3_totals, p3_runs, p4_found, p4_steps, p4_columns, p4_table)}

_COUNT_RECORDS = r"""
with lines as (select file_id, sample_id, chunk_id, string_split_regex(content, '\r\n|\n|\r') as l from count_files),
heads as (select *, list_transform(string_split(l[1], chr(9)), lambda x: lower(trim(x))) as h from lines),
cells as (select file_id, sample_id, chunk_id, list_position(h, 'barcode') as b, list_position(h, 'reads') as r, unnest(l[2:]) as line from heads),
recs as (select file_id, sample_id, chunk_id, upper(trim(string_split(line, chr(9))[b])) as barcode,
         trim(string_split(line, chr(9))[r]) as n from cells where b > 0 and r > 0),
good as (select file_id, sample_id, chunk_id, barcode, cast(n as bigint) as reads from recs
         where barcode <> '' and regexp_full_match(n, '[+-]?[0-9]+')),
firsts as (select sample_id, chunk_id, barcode, reads, min(file_id) as file_id from good group by all)
"""

_FASTQ = r"""
with given as (select row_id, raw_line,
  regexp_full_match(raw_line, '(?:"(?:[^"]|"")*"|[^",]*)(?:,(?:"(?:[^"]|"")*"|[^",]*))*', 's') as well,
  list_transform(regexp_extract_all(raw_line || ',', '("(?:[^"]|"")*"|[^",]*),', 1, 's'),
    lambda f: case when f like '"%' then replace(f[2:-2], '""', '"') else f end) as f from fastq_rows),
named as (select row_id, well, len(f) as n, f[1] as name, f[2] as seq, f[3] as plus, f[4] as qual from given),
judged as (select row_id, name, seq, plus, qual,
  case when not well then 'quoting' when n <> 4 then 'columns'
       when not (starts_with(name, '@') and length(name) > 1) then 'name'
       when not regexp_full_match(seq, '[ACGTNacgtn]+') then 'seq'
       when not starts_with(plus, '+') then 'plus'
       when not regexp_full_match(qual, '[!-~]+') then 'qual'
       when length(seq) <> length(qual) then 'length' end as reason from named)
"""

_DRIFT = r"""
with recursive once as (select distinct file_id, sample_id, written_at, content from meth_stats_files),
cut as (select *, string_split_regex(content, '\r\n|\n|\r') as l from once),
heads as (select file_id, sample_id, written_at, list_transform(string_split(l[1], chr(9)), lambda x: trim(x)) as h, l[2:] as body from cut),
vers as (select file_id, h, lag(file_id) over w as before, lag(h) over w as was from heads window w as (partition by sample_id order by written_at, file_id)),
lines as (select file_id, h, string_split(line, chr(9)) as c from (select file_id, h, unnest(body) as line from heads) where trim(line) <> ''),
vals as (select file_id, upper(trim(c[1])) as spot, unnest(h[2:]) as name, trim(unnest(c[2:])) as raw from lines),
cells as (select distinct file_id, spot, name, case when lower(raw) not in ('', 'na', 'n/a', 'nan', 'null', '.') then raw end as v from vals),
gone as (select file_id, before, unnest(list_filter(was, lambda x: not list_contains(h, x))) as old_name from vers where before is not null),
came as (select file_id, before, unnest(list_filter(h, lambda x: not list_contains(was, x))) as new_name from vers where before is not null),
moved as (select g.file_id, g.before, old_name, new_name from gone g join came c on g.file_id = c.file_id
  join cells o on o.file_id = g.before and o.name = old_name join cells n on n.file_id = g.file_id and n.name = new_name and n.spot = o.spot
  group by all having bool_and(o.v is not distinct from n.v)),
own as (select file_id, name, max(case when v is null then 0 when not regexp_full_match(v, '[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?') then 3
  when regexp_matches(v, '[.eE]') then 2 else 1 end) as code from cells group by all),
steps as (select o.file_id, o.name, o.code, case when list_contains(was, o.name) then o.name else m.old_name end as old_name, v.before
  from own o join vers v on o.file_id = v.file_id left join moved m on m.file_id = o.file_id and m.new_name = o.name),
typed as (select file_id, name, code, null::bigint as before, null::varchar as old_name, 0 as prior from steps where old_name is null
  union all select s.file_id, s.name, case when s.code > 0 then s.code else t.code end, s.before, s.old_name, t.code
  from steps s join typed t on s.before = t.file_id and s.old_name = t.name)
"""

_CHANGES = """
select file_id, 'renamed' as change, old_name, new_name from moved
union all select file_id, 'removed', old_name, '' from gone g where not exists (select 1 from moved m where m.file_id = g.file_id and m.old_name = g.old_name)
union all select file_id, 'added', '', new_name from came g where not exists (select 1 from moved m where m.file_id = g.file_id and m.new_name = g.new_name)
union all select file_id, 'retyped', old_name, name from typed where old_name is not null and prior > 0 and code <> prior
"""

_VERSIONS = """,
prints as (select file_id, string_agg(name || ':' || code, '|' order by name) as print from own group by 1),
ranked as (select file_id, sample_id, row_number() over w as n, print is distinct from lag(print) over w or row_number() over w = 1 as fresh
  from heads left join prints using (file_id) window w as (partition by sample_id order by written_at, file_id)),
versioned as (select file_id, sample_id, n, cast(sum(case when fresh then 1 else 0 end) over (partition by sample_id order by n) as bigint) as version from ranked)
"""

_STEPS = _DRIFT + _VERSIONS + ", change as (" + _CHANGES + """)
select c.file_id, v.sample_id, v.version, change, c.old_name, c.new_name,
  case when c.old_name <> '' then (['none', 'integer', 'decimal', 'text'])[1 + coalesce(o.code, 0)] end as old_type,
  case when c.new_name <> '' then (['none', 'integer', 'decimal', 'text'])[1 + coalesce(n.code, 0)] end as new_type
from change c join versioned v using (file_id) join vers b on b.file_id = c.file_id
left join typed n on n.file_id = c.file_id and n.name = c.new_name left join typed o on o.file_id = b.before and o.name = c.old_name
"""

_FIELDS = _DRIFT + _VERSIONS + """,
links as (select o.file_id, o.name, b.before, case when list_contains(was, o.name) then o.name else m.old_name end as old_name
  from own o join vers b using (file_id) left join (select file_id, new_name, min(old_name) as old_name from moved group by 1, 2) m on m.file_id = o.file_id and m.new_name = o.name),
chain as (select file_id, name, file_id as root_file, name as root_name from links where old_name is null
  union all select l.file_id, l.name, root_file, root_name from links l join chain c on l.before = c.file_id and l.old_name = c.name),
called as (select root_file, root_name, lower(name) as low, min(n) as first from chain join versioned using (file_id) group by 1, 2, 3),
fields as (select unnest(""" + repr([f.lower() for f in MEANS + COUNTS]) + """) as low),
named as (select root_file, root_name, arg_min(low, struct_pack(first, low)) as known from called join fields using (low) group by 1, 2),
other as (select c.*, known from called c left join named using (root_file, root_name) where low not in (select low from fields)),
proofs as (select low, known, count(*) as n from other where known is not null group by 1, 2),
alias as (select low, arg_min(known, struct_pack(m := -n, k := known)) as alias from proofs group by 1),
by_alias as (select root_file, root_name, arg_min(alias, struct_pack(first, low)) as alias from other join alias using (low) where known is null group by 1, 2),
sorted as (select c.file_id, c.name, coalesce(known, alias) as field, case when coalesce(known, alias) = lower(c.name) then 0 when known is not null then 1 when alias is not null then 2 end as rk
  from chain c left join named using (root_file, root_name) left join by_alias using (root_file, root_name)),
placed as (select *, row_number() over (partition by file_id, field order by rk, name) as place from sorted),
told as (select file_id, name, case when place = 1 then field end as field,
  case when field is null then 'unknown' when place > 1 then 'shadowed' else (['name', 'renamed', 'alias'])[1 + rk] end as how from placed)
"""

_ODD = r"regexp_replace(v, '^[~<>=]+\s*|\s*%$|\s+[A-Za-z]+$', '', 'g')"
STATS_SQL = _FIELDS + r""",
numbered as (select file_id, h, string_split(unnest(body), chr(9)) as c, generate_subscripts(body, 1) as k, body from heads),
lasts as (select file_id, upper(trim(c[1])) as barcode, arg_max(c, k) as c, any_value(h) as h from numbered where trim(body[k]) <> '' and trim(c[1]) <> '' group by 1, 2),
given as (select file_id, barcode, field, trim(c[list_position(h, name)]) as raw from lasts join told using (file_id) where field is not null),
texts as (select file_id, barcode, field, case when lower(raw) not in ('', 'na', 'n/a', 'nan', 'null', '.') then raw end as v from given),
bared as (select *, """ + _ODD + r""" as b from texts),
numbers as (select file_id, barcode, field, v, case when regexp_full_match(v, '[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?') then try_cast(v as double)
  when regexp_full_match(b, '[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?') then try_cast(b as double)
  when regexp_full_match(b, '[+-]?\d{1,3}(,\d{3})+(\.\d+)?') then try_cast(replace(b, ',', '') as double)
  when regexp_full_match(b, '[+-]?\d+,\d+') then try_cast(replace(b, ',', '.') as double)
  when regexp_full_match(b, '0[xX][0-9A-Fa-f]{1,15}') then cast(try_cast(lower(b) as bigint) as double) end as x from bared),
tbl as (select l.file_id, v.sample_id, v.version, l.barcode, """ + ", ".join(
    (f"cast(round(max(x) filter (field = '{f.lower()}')) as bigint)" if f in COUNTS else f"max(x) filter (field = '{f.lower()}')") + f' as "{f}"' for f in MEANS + COUNTS
) + """, cast(count(*) filter (n.v is not null and x is null) as int) as n_uncast,
  cast((select count(*) from told t where t.file_id = l.file_id and t.field is null) as int) as n_unmapped
from lasts l join versioned v using (file_id) left join numbers n using (file_id, barcode) group by all)
"""

SQL = {
    "p4_found": _DRIFT + _CHANGES,
    "p4_steps": _STEPS,
    "p4_columns": _FIELDS + "select file_id, name, field, how from told",
    "p4_table": STATS_SQL + "select * from tbl",
    "p1_found": _COUNT_RECORDS + "select distinct file_id from count_files where file_id not in (select file_id from firsts)",
    "p1_compacted": _COUNT_RECORDS + "select sample_id, chunk_id, barcode, reads, file_id from firsts",
    "p1_in_two_runs": _COUNT_RECORDS + "select sample_id, chunk_id, barcode, reads, file_id from firsts",
    "p2_found": _FASTQ + "select row_id, reason from judged where reason is not null",
    "p2_loaded": _FASTQ + "select row_id, name, seq, plus, qual from judged where reason is null",
    "p3_found": "select upper(trim(barcode)) as barcode from spot_counts where barcode is not null group by 1 having count(*) * 50 > (select count(*) from spot_counts)",
    "p3_totals": "select upper(trim(barcode)) as barcode, count(*) as n_rows, count(reads) as n_values, cast(sum(reads) as bigint) as total, min(reads) as least, max(reads) as greatest from spot_counts group by 1",
    "p3_runs": """
with s as (select upper(trim(barcode)) as barcode, contig, counted_at,
  row_number() over w as rn, lag(contig) over w as was, lag(counted_at) over w as before
  from spot_counts window w as (partition by upper(trim(barcode)) order by counted_at, count_id, received_at, coalesce(contig, '')))
select barcode, count(*) as n_rows, cast(sum(case when rn = 1 or contig is distinct from was then 1 else 0 end) as bigint) as n_runs,
  max(epoch_us(counted_at) - epoch_us(before)) as longest_gap_us from s group by barcode""",
}
