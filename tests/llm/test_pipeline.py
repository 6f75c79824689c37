"""The corpus pipeline: stages by hand on odd rows, and the whole on a small folder."""

from __future__ import annotations

import shutil

import corpus_pipeline as cp
import pytest
from conftest import SMALL
from llm.conftest import CLASHING, LONG
from pyspark.sql import functions as F


def test_stages_on_odd_rows(spark, odd):
    copies = cp.drop_copies(spark, odd, SMALL)
    assert copies.columns == odd.columns
    texts = sorted((r.text or "") for r in copies.collect())
    assert len(texts) == len(set(texts)) == 6 and texts.count(LONG) == 1
    near = cp.drop_near_copies(spark, odd, SMALL)
    assert near.columns == odd.columns and near.where("text is null or text = ''").count() == 1
    assert near.where("text like 'The first%'").select("doc_id").collect() == [(0,)]
    clean = cp.drop_benchmark_text(spark, odd, SMALL)
    assert clean.columns == odd.columns and clean.count() == odd.count()
    good = cp.keep_good(spark, odd, SMALL)
    assert good.columns == odd.columns
    coded = cp.encode(spark, odd, SMALL)
    assert coded.count() == odd.count() and coded.where("round_trip").count() == odd.count()
    assert set(CLASHING) & set(coded.columns) == {"ids"}


def test_stages_on_an_empty_table(spark, none):
    for _, stage in cp.STAGES:
        assert stage(spark, none, SMALL).count() == 0


def test_run(spark, tmp_path):
    """Planted rows: copies and benchmark text go, clean text stays."""
    for name in ("documents", "labels", "benchmark"):
        shutil.copy(f"{SMALL}/{name}.parquet", tmp_path)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    item = spark.read.parquet(f"{SMALL}/benchmark.parquet").orderBy("item_id").first()
    base = docs.where("length(text) > 300 and doc_id < 60").orderBy("doc_id").first()
    planted = docs.where(F.col("doc_id") == base.doc_id)
    more = planted.withColumn("doc_id", F.lit(5000)).union(
        planted.withColumns({"doc_id": F.lit(5001), "text": F.concat("text", F.lit(" " + item.text))})
    )
    (tmp_path / "in").mkdir()
    docs.union(more.select(docs.columns)).write.parquet(str(tmp_path / "in" / "documents.parquet"))
    for name in ("labels", "benchmark"):
        shutil.copy(f"{SMALL}/{name}.parquet", tmp_path / "in")
    rows = cp.run(spark, str(tmp_path / "in")).collect()
    ids = {r.doc_id for r in rows}
    assert 5000 not in ids and 5001 not in ids and len(ids) == len(rows) > 100
    assert all(r.round_trip and r.n_tokens == len(r["ids"]) for r in rows)


@pytest.mark.parametrize("drop", [cp.drop_copies, cp.drop_near_copies])
def test_partitioned_tables_keep_their_rows(spark, tmp_path, drop):
    """Files in folders of a partitioned table may have one name."""
    words = "alpha beta gamma delta epsilon zeta eta theta".split()
    rows = [(i, " ".join(f"{w}{i * 31 % 97}{n}" for n, w in enumerate(words * 5)), f"l{i % 4}") for i in range(40)]
    rows.append((99, rows[0][1], "l0"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").coalesce(1)
    docs.write.partitionBy("lang").parquet(str(tmp_path / "docs"))
    got = drop(spark, spark.read.parquet(str(tmp_path / "docs")), SMALL)
    assert sorted(r.doc_id for r in got.collect()) == list(range(40))
