"""One query per operator with production parameters, over whole tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from fieldgauge.llm import language, toxicity
from fieldgauge.llm.decontamination import contamination
from fieldgauge.llm.html_text import extract
from fieldgauge.llm.importance import resample
from fieldgauge.llm.line_dedup import dedup_lines
from fieldgauge.llm.mixing import mix
from fieldgauge.llm.nearest import nearest
from fieldgauge.llm.ngram_join import similar_documents
from fieldgauge.llm.oracles import LLM_ORACLES
from fieldgauge.llm.packing import pack
from fieldgauge.llm.periodic_runs import periodic_runs
from fieldgauge.llm.secret_scan import BASE_KINDS, find_secrets
from fieldgauge.llm.sharding import shard
from fieldgauge.llm.tables import read

SHARDS = 8


def _written(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _of_kinds(*kinds: str) -> Column:
    return F.filter("spans", lambda s: s["kind"].isin(*kinds))


def op1_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(read(spark, sf_dir, "pages")).withColumn("n_chars", F.char_length("text").cast("long"))


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(read(spark, sf_dir, "documents"))
    counts = [F.size(_of_kinds(k)).cast("long").alias(f"n_{k}") for k in BASE_KINDS]
    base = _of_kinds(*BASE_KINDS)
    return found.select("doc_id", *counts, F.sha2(_written(base), 256).alias("base_sha256"), _written(F.col("spans")).alias("spans"))


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_documents(read(spark, sf_dir, "documents"))


def op4_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.withColumn("items_sha256", F.sha2(F.concat_ws(",", "items"), 256)).drop("items")


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read(spark, sf_dir, "documents")
    return language.identify(documents, language.fit(documents))


def op7_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(read(spark, sf_dir, "documents"), shards=SHARDS)


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(read(spark, sf_dir, "documents"))


def op9_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(read(spark, sf_dir, "documents"))
    return mixed.select(
        "doc_id", "source", "lang", "topic", "tokens", F.round("ratio", 6).alias("ratio"),
        F.round("chance", 6).alias("chance"), F.col("kept").cast("int").alias("kept"),
    )


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read(spark, sf_dir, "documents")
    scored = toxicity.score_documents(documents.select("doc_id", "text"), toxicity.fit(documents, read(spark, sf_dir, "labels")))
    return scored.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op11_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")).drop("n_words")


def op12_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack(read(spark, sf_dir, "documents"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op13_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(read(spark, sf_dir, "documents"), fold=True)
    longest = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("down"), r["start"].alias("start"), r["period"].alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n")))
    named = found.select("doc_id", "runs", "collapsed", longest.alias("longest"), F.array_join(lines, "").alias("lines"))
    return named.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "longest.start", (-F.col("longest.down")).alias("length"), "longest.period",
        F.expr("-longest.down * 1000 div longest.period").alias("exponent_milli"),
        F.sha2("lines", 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


LLM_QUERIES = {
    "op1_html": op1_html,
    "op2_secrets": op2_secrets,
    "op3_ngram_join": op3_ngram_join,
    "op4_nearest": op4_nearest,
    "op5_decontaminate": op5_decontaminate,
    "op6_language": op6_language,
    "op7_shard": op7_shard,
    "op8_line_dedup": op8_line_dedup,
    "op9_mix": op9_mix,
    "op10_toxicity": op10_toxicity,
    "op11_resample": op11_resample,
    "op12_pack": op12_pack,
    "op13_runs": op13_runs,
}

__all__ = ["LLM_ORACLES", "LLM_QUERIES"]
