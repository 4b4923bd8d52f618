"""From raw documents to training shards: five stages, each written and read again.

Every stage works on all rows that its predecessor kept. All but the last return the columns of
documents as they came; the last returns the shard of every document that is left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from fieldgauge.llm import toxicity
from fieldgauge.llm.decontamination import KEY, row_key, without_contaminated
from fieldgauge.llm.mixing import mix
from fieldgauge.llm.ngram_join import similar_documents
from fieldgauge.llm.sharding import shard
from fieldgauge.llm.tables import read, stored

NEAR_WORDS, NEAR_PERCENT = 5, 80
SHARDS = 8
#: Several stages cannot be written in SQL; tests compare them with brute force.
ORACLE_SQL = None

_ROW = "__row"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity grammar does not reject; NULL and empty texts stay."""
    model = toxicity.fit(docs, read(spark, sf_dir, "labels"))
    scored = toxicity.score_documents(docs.select("text", F.struct(*docs.columns).alias(_ROW)), model)
    return scored.filter(F.col("predicted") == 0).select(f"{_ROW}.*")


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the least id and, of other texts
    under that id, the least checksum of the text.

    A document is its id and its text: texts that share an id are judged apart, and of rows equal
    in both one stays, the least by its other columns as JSON. Documents without words, and rows
    without an id, are in no group and stay.
    """
    keyed = docs.filter(F.col("doc_id").isNotNull()).withColumn(KEY, row_key())
    found = similar_documents(keyed.select(F.col(KEY).alias("doc_id"), "text"), NEAR_WORDS, NEAR_PERCENT)
    groups = found.select(F.col("doc_id").alias(KEY), "component_id")
    order = F.struct("doc_id", F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("checksum"), KEY)
    places = keyed.select(KEY, order.alias("place")).join(groups.distinct(), KEY)
    keepers = places.groupBy("component_id").agg(F.min("place").alias("place")).select(f"place.{KEY}")
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    one = keyed.join(keepers, KEY, "left_semi").groupBy(KEY).agg(F.min_by(F.struct(*docs.columns), F.to_json(F.struct(F.lit(0), *others))).alias("__least"))
    return one.select("__least.*").unionByName(docs.filter(F.col("doc_id").isNull())).select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    return without_contaminated(docs, read(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample of the documents whose tokens meet the source, language and topic targets."""
    mixed = mix(docs.select("doc_id", "text", "source", "lang", F.struct(*docs.columns).alias(_ROW)))
    return mixed.filter("kept").select(f"{_ROW}.*")


def assign_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) of every document."""
    return shard(docs, shards=SHARDS)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", keep_one_of_each),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("sharding", assign_shards),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to the documents table."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
