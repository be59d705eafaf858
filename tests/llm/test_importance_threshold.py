"""The threshold of all labelled rows, against numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from locusframe.llm import importance as I


def by_numpy(bad, good, loss):
    seen = np.unique(np.concatenate([bad, good]))
    tries = np.concatenate([seen[:1], (seen[1:] + seen[:-1]) / 2])
    lost = np.searchsorted(np.sort(good), tries, "left") / len(good)
    caught = np.searchsorted(np.sort(bad), tries, "left") / len(bad)
    return tries[np.argmax(np.where(lost <= loss, caught - lost, -1))]


@pytest.mark.parametrize("n,loss", [(30_000, 0.005), (60, 0.3)])
def test_all_labelled_rows_count(spark, n, loss):
    rows = spark.range(n).select(F.col("id").alias("doc_id"), (F.floor(F.rand(3) * 4000) / 100 - F.when(F.col("id") % 2 == 0, 12).otherwise(0)).alias("log_weight"))
    rows = spark.createDataFrame(rows.toPandas())
    labels = spark.range(n).selectExpr("id AS doc_id", "cast(id % 2 AS int) AS quality")
    p = rows.toPandas()
    w = [p["log_weight"][p["doc_id"] % 2 == q].to_numpy() for q in (0, 1)]
    assert I.fit_threshold(rows, labels, loss=loss) == by_numpy(*w, loss)


def test_one_kind_only(spark):
    rows = spark.createDataFrame([(1, 0.5)], "doc_id long, log_weight double")
    assert I.fit_threshold(rows, spark.createDataFrame([(1, 1)], "doc_id long, quality int")) == float("-inf")


def test_every_good_row_is_in_the_target(spark):
    labels = spark.range(25_000).selectExpr("id AS doc_id", "1 AS quality")
    last = labels.orderBy(F.xxhash64("doc_id").desc()).first()["doc_id"]
    docs = labels.select("doc_id", F.when(F.col("doc_id") == last, "zebra crossing").otherwise("abcd").alias("text"))
    with_it, without = I.fit_ratio(docs, labels), I.fit_ratio(docs, labels.where(F.col("doc_id") != last))
    assert (with_it > without).sum() >= 5
