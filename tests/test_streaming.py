import json
import shutil

import pytest

from tests.conftest import SF_SMALL
from vigil.operators.completeness import scorecard
from vigil.streaming.micro_batch import score_micro_batches

RULES = {"o_orderpriority": "o_orderpriority IN ('1-URGENT', '2-HIGH')", "o_totalprice": "o_totalprice < 300000"}


def test_each_micro_batch_is_scored(spark, tmp_path):
    batch = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    landing = tmp_path / "landing"
    landing.mkdir()
    shutil.copy(f"{SF_SMALL}/orders.parquet", landing / "part-0.parquet")
    stream = spark.readStream.schema(batch.schema).parquet(str(landing))
    q = score_micro_batches(
        stream, RULES, str(tmp_path / "out"), "tpch", "orders",
        checkpoint=str(tmp_path / "ckpt"), available_now=True,
    )
    q.awaitTermination(120)
    got = spark.read.parquet(str(tmp_path / "out" / "df_dqu_completeness"))
    assert "batch_id" in got.columns
    want = {r["column"]: tuple(r) for r in scorecard(batch, RULES, "tpch", "orders").collect()}
    rows = got.drop("batch_id").collect()
    assert {r["column"]: tuple(r) for r in rows} == want  # one file, one micro-batch
    assert json.loads(rows[0]["data_invalid"])


def test_restart_scores_only_new_files(spark, tmp_path):
    batch = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    landing = tmp_path / "landing"
    landing.mkdir()
    shutil.copy(f"{SF_SMALL}/orders.parquet", landing / "part-0.parquet")

    def start():
        stream = spark.readStream.schema(batch.schema).parquet(str(landing))
        return score_micro_batches(stream, RULES, str(tmp_path / "out"), "tpch", "orders",
                                   checkpoint=str(tmp_path / "ckpt"), available_now=True)

    start().awaitTermination(120)
    shutil.copy(f"{SF_SMALL}/orders.parquet", landing / "part-1.parquet")
    start().awaitTermination(120)  # same checkpoint: resumes after the first file
    got = spark.read.parquet(str(tmp_path / "out" / "df_dqu_completeness"))
    per_batch = {r["batch_id"]: r["n"] for r in got.groupBy("batch_id").count().withColumnRenamed("count", "n").collect()}
    assert per_batch == {0: len(RULES), 1: len(RULES)}
    assert {r["count_data"] for r in got.collect()} == {batch.count()}


def test_a_new_checkpoint_does_not_overwrite_old_batches(spark, tmp_path):
    batch = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    landing = tmp_path / "landing"
    landing.mkdir()
    shutil.copy(f"{SF_SMALL}/orders.parquet", landing / "part-0.parquet")
    stream = spark.readStream.schema(batch.schema).parquet(str(landing))
    start = lambda **at: score_micro_batches(stream, RULES, str(tmp_path / "out"), available_now=True, **at)
    start().awaitTermination(120)
    start().awaitTermination(120)  # the default checkpoint lies beside the results
    with pytest.raises(ValueError, match="another checkpoint"):
        start(checkpoint=str(tmp_path / "new"))
    assert spark.read.parquet(str(tmp_path / "out" / "df_dqu_completeness")).count() == len(RULES)
