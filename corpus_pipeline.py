"""From raw documents to token ids: quality, near-duplicates, personal data, mixing, encoding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardlens.llm import mixing, near_dups, pieces, pii, quality_model
from hazardlens.llm.queries import LEVELS, PERCENT, WEIGHTS
from hazardlens.llm.staging import staged


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality model accepts; it learns from the labels that are not held out.

    Without any label nothing can be judged, and all documents are kept.
    """
    model = quality_model.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    if not model.learned:
        return docs
    whole = docs.select(F.struct("*").alias("_row"), "text")
    return quality_model.score(whole, model).where("predicted = 1").select("_row.*")


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that of the smallest id.

    Documents without an id are kept as they are. If ids repeat, rows are judged one by
    one, ordered by id and text, so different texts under one id all stay.
    """
    named = docs.where("doc_id is not null")
    if named.groupBy("doc_id").count().where("count > 1").isEmpty():
        rows = named.withColumn("_row", F.col("doc_id"))
    else:
        # numbers that rise with the order, fixed by writing them
        rows = staged(named.orderBy("doc_id", "text", mixing.row_key(docs)).withColumn("_row", F.monotonically_increasing_id()))
    kept = near_dups.near_duplicates(rows, id="_row").where("kept").select(F.col("doc_id").alias("_row"))
    return rows.join(kept, "_row").select(docs.columns).unionByName(docs.where("doc_id is null"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind; ``n_chars`` follows the text."""
    return pii.redact(docs).withColumn("n_chars", F.length("text").cast("bigint")).select(docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the target weights take, each as often as it has copies."""
    rows = docs.withColumn("_row", mixing.row_key(docs))
    taken = mixing.mix(rows, LEVELS, WEIGHTS, PERCENT, key="_row")
    return mixing.select_documents(rows, taken, "_row").select(docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, ids, n_tokens, n_byte_tokens`` of every document left."""
    return pieces.encode(docs)


STAGES = [
    ("quality classifier", quality),
    ("MinHash near-dedup", deduplicate),
    ("PII", personal_data),
    ("mixing sources to target weights", mix),
    ("SentencePiece encoding and decoding", encode),
]

# models, hashes and an iterated graph stand in the way of SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other on ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
