"""The queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.llm import bpe, langid, media, mixing, pii, preference, quality, sharding, simhash, warc
from lodestone.session import table


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.near_duplicate_groups(table(spark, sf_dir, "documents"))
    return groups.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_round_trip(table(spark, sf_dir, "pages"))


def op2_preference(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preference.spell_masks(preference.assemble(preference.format_pairs(preference.neighbours(table(spark, sf_dir, "conversations")))))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.range_sorted(mixing.mix(table(spark, sf_dir, "documents")))
    spelled = F.transform("passes", lambda p: F.concat_ws(":", p["pass"].cast("string"), p["words"].cast("string"), p["position"].cast("string")))
    return mixed.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken", "copies", "position", F.array_join(spelled, ",").alias("passes"))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op7_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = langid.train_and_identify(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"), drop=("text", "lang"))
    return labelled.select("doc_id", "held_out", "lang_pred", "score")


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", *(f"n_{k}" for k in pii.KINDS), "base_sha256", "spans")


def op9_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = media.store_text(table(spark, sf_dir, "documents").select("doc_id", "text"), drop=("text",))
    return media.read_back(stored)


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


QUERIES = {
    "op1_warc": op1_warc,
    "op2_preference": op2_preference,
    "op3_mixing": op3_mixing,
    "op4_bpe": op4_bpe,
    "op5_simhash": op5_simhash,
    "op6_sharding": op6_sharding,
    "op7_langid": op7_langid,
    "op8_pii": op8_pii,
    "op9_media": op9_media,
    "op10_quality": op10_quality,
}

ORACLES: dict[str, str] = {
    "op1_warc": warc.OP1_SQL,
    "op2_preference": preference.OP2_SQL,
    "op10_quality": quality.OP10_SQL,
}
