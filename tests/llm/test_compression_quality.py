import zlib

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from fraudlake.llm.compression_quality import Model, chunked, compressor, fit, logistic, quality_query, size_difference
from tests.llm import cases


def remainder(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 4


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    found = quality_query(cases.table_of(spark, sf), cases.table_of(spark, sf, "labels")).toPandas()
    assert len(found) == 1000
    assert (found["held_out"] == found["doc_id"].map(lambda d: remainder(d) == 2)).all()
    assert found["score"].between(0, 1).all()
    assert (found["predicted"] == (found["score"] >= 0.7)).all()
    held = found[found["held_out"]].merge(cases.table_of(spark, sf, "labels").toPandas(), on="doc_id")
    assert len(held) > 60
    assert (held["predicted"] == held["quality"]).mean() >= 0.95
    good, bad = held[held["quality"] == 1]["score"].to_numpy(), held[held["quality"] == 0]["score"].to_numpy()
    assert (good[:, None] > bad[None, :]).mean() >= 0.97


def test_score_is_that_of_plain_compression(spark):
    sf = "/root/testdata/sf0.001"
    docs, labels = cases.table_of(spark, sf), cases.table_of(spark, sf, "labels")
    model = fit(docs, labels)
    good, bad = compressor(model.good), compressor(model.bad)
    found = {r["doc_id"]: r["score"] for r in quality_query(docs, labels).collect()}
    for row in docs.collect():
        data = row["text"].encode()
        parts = [data[k : k + 2048] for k in range(0, len(data), 2048)]
        a, b = (sum(len(c.compress(p)) for p in parts) for c in (good, bad))
        want = 1 / (1 + np.exp(-(model.slope * (b - a) / (a + b) + model.intercept))) if parts else model.base
        assert abs(found[row["doc_id"]] - want) < 1e-9


def test_held_out_labels_and_other_columns_teach_nothing(spark):
    sf = "/root/testdata/sf0.001"
    docs, labels = cases.table_of(spark, sf), cases.table_of(spark, sf, "labels")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    wrong = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    scores = lambda d, x: sorted(map(tuple, quality_query(d, x).collect()))
    assert scores(docs, labels) == scores(docs.withColumn("lang", F.lit("xx")), wrong)


def test_sample_is_bounded_and_repeats_count_once(spark):
    docs = spark.createDataFrame([(1, "the same text")] * 300 + [(k, f"text number {k}") for k in range(2, 200)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(1, 200)], "doc_id long, quality int")
    assert fit(docs, labels, sample_rows=20).base == fit(docs.distinct(), labels, sample_rows=20).base


def test_conflicting_or_missing_labels(spark):
    docs = spark.createDataFrame([(1, "a b c"), (3, "d e f"), (None, "g"), (4, "")], "doc_id long, text string")
    none = spark.createDataFrame([(1, 0), (1, 1), (3, None), (None, 1), (4, 7)], "doc_id long, quality int")
    assert fit(docs, none) is None
    assert {(r["score"], r["predicted"]) for r in quality_query(docs, none).collect()} == {(0.5, 0)}
    one = spark.createDataFrame([(1, 1), (3, 1)], "doc_id long, quality int")
    scores = {r["score"] for r in quality_query(docs, one).collect()}
    assert len(scores) == 1 and 0.5 < scores.pop() < 1


def test_few_rows_of_a_class_make_a_model_still():
    rows = pd.DataFrame({"quality": [1, 1, 1, 0], "chunks": [[b"good words here"], [b"good words there"], [b"more good words"], [b"@@ ## @@ ##"]]})
    model = Model.fit(rows)
    assert model.good and model.bad and model.slope > 0


def test_logistic_curve_is_calibrated():
    rng = np.random.default_rng(3)
    x = rng.normal(size=20_000) / 50
    y = (rng.random(20_000) < 1 / (1 + np.exp(-(80 * x - 1)))).astype(float)
    slope, intercept = logistic(x, y)
    assert abs(slope - 80) < 5 and abs(intercept + 1) < 0.1
    assert np.isfinite(logistic(np.array([-1.0, 1.0]), np.array([0.0, 1.0]))).all()


def test_chunks_hold_the_whole_text():
    text = "é" * 5000
    assert b"".join(chunked(text)).decode() == text
    assert size_difference([], None, None) == 0.0


def test_odd_rows_and_empty_table(spark):
    labels = spark.createDataFrame([(1, 1), (4, 0), (5, 0), (6, 1), (8, 1), (10, 0)], "doc_id long, quality int")
    rows = quality_query(cases.documents(spark), labels).collect()
    assert len(rows) == len(cases.ROWS)
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert {r["held_out"] for r in rows if r["doc_id"] is None} == {True}
    assert len({r["score"] for r in rows if r["doc_id"] in (2, 3)}) == 1
    assert quality_query(cases.empty(spark), labels).collect() == []
    assert len(quality_query(cases.documents(spark), labels.limit(0)).collect()) == len(cases.ROWS)
