import numpy as np
import pytest
from pyspark.sql import functions as F

from neardup.functions.embedding import embed, hashed_bag_of_words
from neardup.operators.extraction import removed_ids
from neardup.operators.pairs import copy_keys, max_prior_similarity
from neardup.plans.table_queries import documents


def make_length_model():
    def predict(texts):
        return np.array([[len(t), 1.0] for t in texts], dtype=np.float32)

    return predict


def test_caller_model_and_missing_text(spark):
    rows = spark.createDataFrame([(0, "abc"), (1, None), (2, "")], "id long, text string")
    raw = embed(rows, make_length_model, normalize=False, batch_size=2).orderBy("id").collect()
    assert [r.embedding for r in raw] == [[3.0, 1.0], [0.0, 1.0], [0.0, 1.0]]
    unit = embed(rows, make_length_model).where("id = 0").first().embedding
    assert np.allclose(unit, np.array([3.0, 1.0]) / np.sqrt(10))


def test_batches_and_partitions_do_not_matter(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    model = hashed_bag_of_words(16)
    one = embed(docs, model, batch_size=7).orderBy("doc_id").collect()
    two = embed(docs, model, batch_size=1000, num_partitions=5).orderBy("doc_id").collect()
    assert one == two
    assert np.allclose([np.linalg.norm(r.embedding) for r in one], 1)


def test_the_model_runs_once_under_a_later_filter(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = embed(docs, hashed_bag_of_words(16), num_partitions=3)
    plan = rows.where(F.size("embedding") > 0)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


@pytest.mark.parametrize("block_rows", [300, 4096])
def test_known_numbers_of_flagged_documents(spark, block_rows):
    docs = documents(spark, "/root/testdata/sf0.01")
    prior = max_prior_similarity(docs, ("lang",), ("id",), block_rows=block_rows)
    eps = [0.01, 0.02, 0.03, 0.05, 0.07]
    counts = {r.eps: r["count"] for r in removed_ids(prior, eps).groupBy("eps").count().collect()}
    assert counts == dict(zip(eps, [126, 179, 262, 406, 550]))


def test_stored_copy_keys_save_the_second_scan_of_vectors(spark, tmp_path):
    docs = documents(spark, "/root/testdata/sf0.01")
    path = str(tmp_path / "keyed")
    docs.select("*", *copy_keys()).write.parquet(path)
    keyed = spark.read.parquet(path)
    prior = max_prior_similarity(keyed, ("lang",), ("id",))
    plan = prior._jdf.queryExecution().executedPlan().toString()
    # The location is shortened in a plan; only this table stores copy keys.
    scans = [line for line in plan.splitlines() if "FileScan" in line and "copy_key_0" in line]
    assert scans and not any("embedding" in line for line in scans)
    assert sorted(prior.collect()) == sorted(max_prior_similarity(docs, ("lang",), ("id",)).collect())
