"""The corpus pipeline: from raw documents to packed training sequences.

Every stage takes ``(spark, docs, sf_dir)`` and works on all rows that the stage
before kept; its result is written as Parquet and read again.  All but the last
return the columns of ``documents``.  Rows without ``doc_id`` cannot be told
apart by an operator's verdict, so the two dedup stages and the mixing pass them
on as they are; repeated rows of one id leave exact dedup once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from promolens.llm.common import with_plain_names, written
from promolens.llm.exact_dedup import exact_dedup
from promolens.llm.mixing import mix, times_used
from promolens.llm.near_dedup import near_dedup
from promolens.llm.packing import pack
from promolens.llm.quality import good_documents
from promolens.llm.queries import graded, languages_as_domains, vocabulary
from promolens.session import configure


def named(docs: DataFrame) -> tuple[DataFrame, Column, Column]:
    """The rows under plain names (no extra column can clash), their id and text."""
    place = {name: f"c{i}" for i, name in enumerate(docs.columns)}
    return with_plain_names(docs), F.col(place["doc_id"]), F.col(place["text"])


def staying(docs: DataFrame, verdict: DataFrame) -> DataFrame:
    """The rows whose id the verdict keeps, and those without an id."""
    plain, doc_id, _ = named(docs)
    ids = verdict.where("kept AND doc_id IS NOT NULL").select(F.col("doc_id").alias("kept_id")).distinct()
    return plain.join(ids, doc_id == F.col("kept_id"), "left_semi").union(
        plain.where(doc_id.isNull())).toDF(*docs.columns)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ordinal classifier does not reject."""
    configure(spark)
    return good_documents(docs, graded(spark.read.parquet(f"{sf_dir}/labels.parquet")))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    configure(spark)
    verdict = written(exact_dedup(docs))
    out = staying(docs, verdict)
    repeated = verdict.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1")
    if repeated.isEmpty():
        return out
    plain, doc_id, text = named(out)
    once = plain.where(doc_id.isNotNull()).withColumn("key_id", doc_id).withColumn("key_text", text).dropDuplicates(
        ["key_id", "key_text"]).drop("key_id", "key_text")
    return plain.where(doc_id.isNull()).union(once).toDF(*docs.columns)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five words, 0.8)."""
    configure(spark)
    return staying(docs, near_dedup(docs))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the target weights of the languages ask, at least once."""
    configure(spark)
    rates = mix(docs, languages_as_domains(docs), vocabulary("byte_bpe_50k.json"), least=1.0)
    uses = (rates.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("rate").alias("rate"))
            .select(F.col("doc_id").alias("used_id"), times_used(F.col("rate"), F.col("doc_id")).alias("uses")))
    plain, doc_id, _ = named(docs)
    used = plain.join(uses, doc_id == F.col("used_id")).withColumn(
        "uses", F.explode(F.sequence(F.lit(1), F.col("uses"))))
    return used.select(plain.columns).union(plain.where(doc_id.isNull())).toDF(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, packed into sequences of 2048 tokens."""
    configure(spark)
    return pack(docs, vocabulary("word_bpe_49k.json"))


STAGES = [("quality classifier", quality), ("exact dedup", exact), ("MinHash near-dedup", near),
          ("mixing to target weights", mixing), ("best-fit packing", packing)]

#: The classifier, the sketches and the tokenizer cannot be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = written(docs)
    return docs
