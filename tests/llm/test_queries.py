"""Registered queries: SQL where there is some, whole results, the pipeline."""

import hashlib
import random
import re
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as spark_entry
import corpus_pipeline
from hazardlens.llm import near_dups, pieces
from hazardlens.llm.oracle import ORACLE
from hazardlens.llm.queries import QUERIES
from tools.run_queries import TABLES, compare

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF}/{name}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, db, name):
    outcome = compare(QUERIES[name](spark, SF), ORACLE[name], db)
    assert outcome.startswith("ok") and "types" not in outcome, outcome


def test_one_query_per_operator():
    numbers = sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES)
    assert numbers == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(spark_entry.queries())


@pytest.mark.parametrize("name", ["op5_suffix_dedup", "op6_sentencepiece", "op7_personal_data", "op8_quality_model", "op10_cross_entropy"])
def test_a_row_for_every_document(spark, name):
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    got = QUERIES[name](spark, SF)
    assert sorted(r[0] for r in got.select("doc_id").collect()) == sorted(r[0] for r in documents.select("doc_id").collect())
    if name == "op6_sentencepiece":
        assert got.where("not round_trip").count() == 0


def test_suffix_dedup_equals_brute_force(spark):
    seen, want = set(), {}
    for r in spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect():
        data = (r["text"] or "").encode()
        gone = bytearray(len(data))
        for at in range(len(data) - 99):
            part = data[at : at + 100]
            if part in seen:
                gone[at : at + 100] = b"\1" * 100
            seen.add(part)
        want[r["doc_id"]] = hashlib.sha256(bytes(b for b, g in zip(data, gone) if not g)).hexdigest()
    got = {r["doc_id"]: r["kept_sha256"] for r in QUERIES["op5_suffix_dedup"](spark, SF).collect()}
    assert got == want


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES][1].startswith("MinHash")
    good = corpus_pipeline.quality(spark, docs, SF)
    assert good.columns == docs.columns and 0 < good.count() < docs.count()
    labels = spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1")
    assert docs.join(labels, "doc_id").join(good.select("doc_id"), "doc_id", "left_anti").count() <= 1
    kept = corpus_pipeline.deduplicate(spark, good, SF)
    classes = near_dups.near_duplicates(good)
    assert kept.columns == docs.columns and kept.count() == classes.select("component_id").distinct().count()
    clean = corpus_pipeline.personal_data(spark, kept, SF)
    assert clean.columns == docs.columns and clean.count() == kept.count()
    assert clean.where("text rlike '[a-z]@[a-z]' or n_chars <> length(text)").count() == 0
    mixed = corpus_pipeline.mix(spark, clean, SF)
    assert mixed.columns == docs.columns and mixed.select("doc_id").distinct().count() > 0
    coded = corpus_pipeline.encode(spark, mixed, SF)
    texts = {(r["doc_id"], r["text"]) for r in pieces.decode_ids(coded).collect()}
    assert texts == {(r["doc_id"], r["text"]) for r in mixed.collect()}


def test_pipeline_on_odd_documents(spark, tmp_path):
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choice("abcdefgh") * 4 for _ in range(60)) + ".", "en", f"src{i % 5}", 1) for i in range(40)]
    rows += [(50, None, None, None, None), (51, "", "en", "src1", 0), (None, "a b c", "en", "src1", 5), (1, rows[1][1], "en", "src1", 1)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    for name, part in (("some", rows), ("none", [])):
        folder = Path(tmp_path / name)
        spark.createDataFrame(part, schema).write.parquet(str(folder / "documents.parquet"))
        spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(folder / "labels.parquet"))
        assert corpus_pipeline.run(spark, str(folder)).columns[0] == "doc_id"
        corpus_pipeline.run(spark, str(folder)).collect()


def test_pipeline_keeps_rows_without_or_with_repeated_ids(spark, tmp_path):
    rng = random.Random(6)

    def text():
        return " ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(60)) + "."

    rows = [(i, text(), "en", "src1", 1) for i in range(6)]
    rows += [(None, text(), "en", "src1", 1) for _ in range(6)] + [(2, text(), "en", "src1", 1) for _ in range(3)]
    rows += [rows[0], (9, rows[1][1], "en", "src1", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    spark.createDataFrame([(i, 1) for i in range(6)], "doc_id long, quality int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([], "doc_id long, quality int").write.parquet(str(tmp_path / "none" / "labels.parquet"))
    want = sorted(((i, t) for i, t, *_ in rows[:15]), key=str)
    pairs = lambda df: sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=str)
    assert corpus_pipeline.quality(spark, docs, str(tmp_path / "none")).count() == len(rows)
    good = corpus_pipeline.quality(spark, docs, str(tmp_path))
    assert pairs(good) == sorted(((i, t) for i, t, *_ in rows), key=str)
    kept = corpus_pipeline.deduplicate(spark, good, "")
    assert pairs(kept) == want
    mixed = corpus_pipeline.mix(spark, kept, "")
    # 80 % of 900 words, in documents of 60
    assert mixed.columns == docs.columns and mixed.count() == 12 and set(pairs(mixed)) < set(want)
    assert any(r["doc_id"] is None for r in mixed.collect())
    # equal rows share their key, and each is taken
    twice = corpus_pipeline.mix(spark, kept.unionByName(kept), "")
    assert twice.count() == 24
