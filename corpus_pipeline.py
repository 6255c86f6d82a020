"""From documents to token records: quality, near duplicates, test items, source mix, token ids.

Each stage takes what its predecessor kept, written as Parquet and read again, so a
lost executor costs no more than the stage at work.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pushbroom.llm import decontaminate, mixing, partenum, quality, registry, tokens
from pushbroom.llm.store import Workspace, broadcast_within


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learned from ``labels``, does not reject.

    Null and empty texts get the score of a text that compresses to nothing; rows that repeat are judged alike. Without labels every text scores a half and stays.
    """
    model = quality.fit(spark, docs, registry.table(spark, sf_dir, "labels"))
    return quality.score(spark, docs, model, output="_quality").where(F.col("_quality") >= quality.THRESHOLD).drop("_quality")


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates (five-word shingles, similarity 0.8): that of the least doc_id.

    Rows are judged by their own texts, so texts that are not alike neither join groups nor go for sharing a doc_id. Of several rows of
    a group with its least doc_id the one whose values hash least stays. Rows without a doc_id, and those whose text is null or has no words, stay, all of them.
    An empty table gives an empty one.
    """
    rows = partenum.text_classes(spark, docs, k=5, percent=80)[0].where("component IS NOT NULL")
    # most documents are one row that stays; the others are told apart by doc_id, and their rows by their sets' keys where there are several
    odd = rows.groupBy("doc_id").agg((F.count("*") > 1).alias("_several"), F.max(F.col("component") != F.col("doc_id")).alias("_goes")).where("_several OR _goes")
    odd = Workspace(spark, "rows").table(odd.withColumnRenamed("doc_id", "_id"), "odd")
    odd = broadcast_within(odd, odd.count(), partenum.MANY_CLASSES)
    first = rows.where("component = doc_id").groupBy("doc_id", "label").agg(F.min(F.struct("key", "n")).alias("_first")).withColumnRenamed("doc_id", "_i")
    silent = F.col("doc_id").isNull() | F.col("text").isNull() | ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    named = docs.where(~silent).join(odd, F.col("doc_id") == F.col("_id"), "left")
    several = partenum.with_keys(named.where("_several"), k=5).join(first, F.col("_id") == F.col("_i")).where("_key = _first.key AND _n = _first.n")
    values = [F.to_json(F.struct(F.col(c).alias("v"))) if "map<" in kind else F.col(c) for c, kind in docs.dtypes]
    one = several.groupBy("_id", "_first").agg(F.min_by(F.struct(*docs.columns), F.xxhash64(*values)).alias("_row")).select("_row.*")
    return docs.where(silent).unionByName(named.where("_id IS NULL").select(*docs.columns)).unionByName(one)


def drop_test_items(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no item of ``benchmark``; null and empty texts contain none, rows that repeat are judged alike, and an empty table gives an empty one."""
    return decontaminate.clean(spark, docs, registry.table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: rows of no words never, rows that repeat each on its own; an empty table gives an empty one."""
    return mixing.mixed(spark, docs)


def to_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token records of the mix, read back: one for each row, rows without a doc_id first; null and empty texts are the end id alone."""
    return tokens.token_table(spark, docs, registry.vocabulary())


STAGES = [
    ("quality", keep_quality),
    ("near_duplicates", keep_one_of_each_group),
    ("test_items", drop_test_items),
    ("source_mix", mix_sources),
    ("token_records", to_tokens),
]

#: The classifier's dictionaries are beyond SQL; the stages are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ws = Workspace(spark, "pipeline")
    docs = registry.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = ws.table(stage(spark, docs, sf_dir), name)
    return docs
