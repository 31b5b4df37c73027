"""The registered queries of the thirteen operators, over whole tables."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardlens.llm import codes, line_rules, lm, mixing, near_dups, notices, pieces, pii, quality_model, suffix_dedup, topk, turns, urls
from hazardlens.llm.staging import staged

RULES = (
    urls.Rule("org/", "allow"),
    urls.Rule("example.org/es/", "block"),
    urls.Rule("example.org/en/1", "block"),
    urls.Rule("com/fr/", "allow"),
    urls.Rule("com/de/", "block"),
)


# the tree of documents: sources fall into four domains by their number
LEVELS = {
    "domain": "'domain' || try_cast(regexp_extract(source, '([0-9]+)$', 1) as int) % 4",
    "lang": "lang",
    "source": "source",
}
WEIGHTS = {
    "domain": "case domain when 'domain1' then 4 when 'domain0' then 3 else 1 end",
    "lang": "case lang when 'en' then 5 when 'es' then 3 else 1 end",
}
PERCENT = 80


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_topk_search(spark: SparkSession, folder: str) -> DataFrame:
    """The five best inner products of every 50th vector against all others."""
    vectors = table(spark, folder, "embeddings")
    return topk.top_k(vectors.where(F.col("vec_id") % 50 == 0), vectors, k=5)


def op2_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """Documents taken, with copies, for 80 % of all tokens under the target weights."""
    documents = table(spark, folder, "documents").select("doc_id", "text", "lang", "source")
    return mixing.mix(documents, LEVELS, WEIGHTS, PERCENT)


def op3_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    """A verdict for every page's URL."""
    judged = urls.judge_urls(table(spark, folder, "pages").select("page_id", "url"), rules=RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op4_minhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's class of near-duplicates on four-word shingles."""
    return near_dups.near_duplicates(table(spark, folder, "documents").select("doc_id", "text"), width=4)


def op5_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """What is left of every document without the 100-byte strings that occurred before."""
    return suffix_dedup.remove_repeats(table(spark, folder, "documents").select("doc_id", "text"))


def op6_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    """Every document encoded and decoded again."""
    return pieces.encode_and_check(table(spark, folder, "documents").select("doc_id", "text"))


def op7_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data in every document, by fixed patterns and by discovered contexts."""
    documents = table(spark, folder, "documents").select("doc_id", "text")
    return pii.summary(pii.find_spans(documents))


def op8_quality_model(spark: SparkSession, folder: str) -> DataFrame:
    """A quality score for every document, learned from the labels that are not held out."""
    documents = table(spark, folder, "documents").select("doc_id", "text")
    model = quality_model.train(documents, table(spark, folder, "labels"))
    scored = quality_model.score(documents, model)
    return scored.select("doc_id", quality_model.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op9_line_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Counts and verdict of the line rules for every document."""
    return line_rules.clean_lines(table(spark, folder, "documents").select("doc_id", "text")).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "n_lines_removed",
        "lost_chars",
    )


def op10_cross_entropy(spark: SparkSession, folder: str) -> DataFrame:
    """Cross-entropy difference of every document; documents labelled good are the target."""
    good = table(spark, folder, "labels").where("quality = 1")
    return lm.cross_entropy_difference(table(spark, folder, "documents").select("doc_id", "text"), good)


def op11_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    """Faults, cheapest edits and a digest of the repaired text of every damaged conversation."""
    conversations = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    found = turns.summaries(turns.repair(turns.damage(conversations))).withColumnRenamed("conv_id", "_found")
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    every = conversations.select("conv_id").distinct()
    return every.join(found, F.col("conv_id").eqNullSafe(F.col("_found")), "left").select(
        "conv_id",
        *(F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in counts),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


def op12_license_notices(spark: SparkSession, folder: str) -> DataFrame:
    """Which licences every document names, by exact phrases and by notices with a few edits."""
    found = notices.find_notices(table(spark, folder, "documents").select("doc_id", "text"))
    exact = F.filter("spans", lambda s: s["kind"] == "phrase")
    labels = lambda spans: F.array_join(F.array_sort(F.array_distinct(F.transform(spans, lambda s: s["label"]))), ",")
    return found.select(
        "doc_id",
        "n_words",
        F.size(exact).cast("bigint").alias("n_base"),
        F.array_min(F.transform(exact, lambda s: s["word"])).alias("first_word"),
        F.array_max(F.transform(exact, lambda s: s["word"])).alias("last_word"),
        labels(exact).alias("base_labels"),
        labels(F.col("spans")).alias("labels"),
        F.coalesce(F.array_max(F.transform("spans", lambda s: s["likeness"])), F.lit(0.0)).alias("score"),
    )


def op13_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    """Every vector as four codebook indexes, its error, that of its label, and a digest of the codebooks."""
    found = codes.compress(table(spark, folder, "embeddings"), keep=("label",))
    digest = hashlib.sha256(",".join(map(str, found.codebooks.ravel().tolist())).encode()).hexdigest()
    # no label is a label too
    label = [F.col("label").isNull().alias("_none"), F.coalesce(F.col("label").cast("bigint"), F.lit(0)).alias("_label")]
    rows = staged(found.rows.select("vec_id", "codes", "error", *label))
    sums = rows.groupBy("_none", "_label").agg(F.sum("error").alias("label_error"))
    hexed = F.transform("codes", lambda c: F.lpad(F.lower(F.hex(c)), 2, "0"))
    return rows.join(sums, ["_none", "_label"]).select(
        "vec_id",
        F.array_join(hexed, "").alias("code"),
        "error",
        "label_error",
        F.lit(digest).alias("codebooks_sha256"),
    )


_ALL = (
    op1_topk_search,
    op2_mixing,
    op3_url_filter,
    op4_minhash_dedup,
    op5_suffix_dedup,
    op6_sentencepiece,
    op7_personal_data,
    op8_quality_model,
    op9_line_rules,
    op10_cross_entropy,
    op11_conversation_repair,
    op12_license_notices,
    op13_vector_codes,
)
QUERIES = {f.__name__: f for f in _ALL}
