"""The queries on text corpora, and the SQL that checks them where SQL can."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, cutoff, moderation, packing


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet")
    rows = cutoff.latest(read("spot_counts"), "count_id", "received_at", "sample_id", "reads")
    targets = read("keep_targets").select(F.col("sample_id").alias("grp"), F.col("keep_permille").alias("permille"))
    return cutoff.cutoffs(rows.select(F.col("sample_id").alias("grp"), F.col("reads").alias("value")), targets).withColumnRenamed("grp", "sample_id")


def p6_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(_documents(spark, sf_dir))


def p6_decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.decode(bpe.encode(_documents(spark, sf_dir)))


def _packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(bpe.lengths(_documents(spark, sf_dir)))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.split_texts(_packed(spark, sf_dir))


def p7_packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _packed(spark, sf_dir)


def p7_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.containers(_packed(spark, sf_dir)).withColumn("filled", 1 - F.col("n_unused") / packing.CAPACITY)


def _moderated(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/moderation_labels.parquet")
    return moderation.moderated(_documents(spark, sf_dir), labels, "source")


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _moderated(spark, sf_dir).where("abusive").select("doc_id")


def p8_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _moderated(spark, sf_dir)


def p8_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return moderation.rates(_moderated(spark, sf_dir))


QUERIES = {f.__name__: f for f in (p5_found, p6_ids, p6_decoded, p7_found, p7_packed, p7_containers, p8_found, p8_scores, p8_rates)}

SQL = {
    "p5_found": """
with last as (select count_id, arg_max(struct_pack(sample_id, reads), struct_pack(received_at, sample_id, reads)) as r from spot_counts group by count_id),
recs as (select r.sample_id as sample_id, r.reads as reads from last where r.sample_id is not null and r.reads is not null),
vals as (select sample_id, reads, count(*) as n from recs group by all),
cum as (select sample_id, reads, sum(n) over (partition by sample_id order by reads desc) as upto, sum(n) over (partition by sample_id) as total from vals)
select sample_id, max(reads) as threshold, cast(min(upto) as bigint) as n_kept
from cum join keep_targets using (sample_id) where 1000 * upto >= keep_permille * total group by sample_id""",
    "p6_decoded": "select doc_id, coalesce(text, '') as text from documents",
}
