"""A corpus from documents: known language, one of each group of near copies, sources mixed, packed.

Each stage takes (spark, docs, sf_dir) and returns a table that is written as Parquet and read again as the
next one's documents. All but the last return the columns they were given.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.llm import jaccard, language, mixing, packing
from tierline.llm.common import cut, free_name, held_out, text_of
from tierline.llm.queries import tokenizer_path


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is found; those without letters, or like no language learned, go."""
    names = free_name(docs, "lang_pred"), free_name(docs, "score")
    found = language.identify(docs, ~held_out("doc_id", 4, 2), names=names)
    return found.where((F.col(names[0]) != language.UNKNOWN) & (F.col(names[1]) > 0)).drop(*names)


def _row_key() -> Column:
    """What tells a row by its id and whole text, null ids and texts included."""
    digest = F.sha2(text_of("text").cast("binary"), 256)
    return F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), digest)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that links connect, the one with the smallest id, of equal ids the one with the smaller
    digest, of rows equal in both the one whose columns have the least hash; documents without words all stay. Null
    ids stand before others."""
    key = free_name(docs, "row_key")
    ids = docs.select(F.struct(F.col("doc_id"), _row_key().alias("key")).alias("doc_id"), "text")
    groups = jaccard.similar_components(ids).where(F.col("doc_id.key") != F.col("component_id.key"))
    copies = groups.select(F.col("doc_id.key").alias(key)).distinct()
    columns = [F.col(f"`{c}`") for c in docs.columns]
    single = docs.withColumn(key, _row_key()).join(copies, key, "left_anti")
    return single.groupBy(key).agg(F.min_by(F.struct(*columns), F.xxhash64(*columns)).alias("row")).select("row.*")


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, in part counting as once, in training order.

    Documents without words (null and empty texts) are not taken; repeated rows stand together; columns come out as
    they are, whatever their names; an empty table gives none.
    """
    return mixing.in_training_order(docs, _row_key())


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 1024 tokens, with their place in a sequence; a null text has its end only, an empty table no pieces.

    Columns other than doc_id and text are left out.
    """
    return packing.pack(docs, tokenizer_path("byte_bpe_50k.json"))


STAGES = [
    ("language", known_language),
    ("jaccard", one_of_each_group),
    ("mixing", mixed),
    ("packing", packed),
]

#: SQL expresses none of language, mixing by position and packing; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of all stages, applied to the documents at ``sf_dir`` one after the other."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
