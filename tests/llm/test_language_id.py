import inspect
import pickle
import tracemalloc
import zlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from fraudlake.llm import language_id
from fraudlake.llm.common import written
from fraudlake.llm.language_id import DIMENSIONS, Hierarchy, features, fit, language_query
from tests.llm import cases

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = cases.table_of(spark, SF)
    found = language_query(docs).join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    assert len(found) == docs.count()
    assert (found["held_out"] == found["doc_id"].map(lambda d: zlib.crc32(str(d).encode()) % 5 == 0)).all()
    held = found[found["held_out"]]
    assert len(held) > 150
    assert (held["lang"] == held["lang_pred"]).mean() >= 0.97
    assert found["score"].between(0, 1).all()


def test_held_out_labels_teach_nothing(spark):
    docs = cases.table_of(spark, "/root/testdata/sf0.001")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    wrong = docs.withColumn("lang", F.when(held, "xx").otherwise(F.col("lang")))
    key = lambda df: sorted(map(tuple, language_query(df).collect()))
    assert key(docs) == key(wrong)
    assert "xx" not in {r["lang_pred"] for r in language_query(wrong).collect()}


def test_odd_rows_and_empty_table(spark):
    rows = language_query(cases.documents(spark)).collect()
    assert len(rows) == len(cases.ROWS)
    for row in rows:
        if row["doc_id"] in (2, 3, 4, 5):
            assert (row["lang_pred"], row["score"]) == ("und", 0.0)
    assert {r["lang_pred"] for r in rows if r["doc_id"] == 6} <= {"en", "de", "fr"}
    assert language_query(cases.empty(spark)).collect() == []


@pytest.mark.parametrize("text", ["½ ² 3", "① Ⅷ", "12 _ !", "五"])
def test_only_letters_count(text):
    letters = [c for c in text if c.isalpha()]
    assert (features(text) is not None) == bool(letters)


def test_repeated_ids_teach_the_same_in_any_order(spark):
    rows = [(k, f"the text number {k} of the table", "en") for k in range(30)] + [(k, f"der Text mit der Nummer {k}", "de") for k in range(20, 50)]
    schema = "doc_id long, text string, lang string"
    one, other = (fit(spark.createDataFrame(r, schema).repartition(n)) for r, n in ((rows, 1), (rows[::-1], 7)))
    assert np.array_equal(one.languages["germanic"].weights, other.languages["germanic"].weights)


def test_sample_is_the_share_of_smallest_hashes(spark, monkeypatch):
    docs = cases.table_of(spark, "/root/testdata/sf0.001").withColumn("lang", F.coalesce("lang", F.lit("en")))
    seen = []
    monkeypatch.setattr(language_id, "written", lambda df, label: seen.append((label, df)) or written(df, label))
    fit(docs, sample_rows=40)
    got = {(r["lang"], r["doc_id"]) for r in dict(seen)["sample"].collect()}
    ids = docs.filter(~language_id.held_out()).select("lang", "doc_id", F.xxhash64("doc_id").alias("h")).collect()
    langs = {r["lang"] for r in ids}
    want = {(r["lang"], r["doc_id"]) for lang in langs for r in sorted((x for x in ids if x["lang"] == lang), key=lambda x: x["h"])[: 40 // len(langs)]}
    assert got == want


def test_no_labels_means_undetermined(spark):
    docs = cases.documents(spark).withColumn("lang", F.lit(None).cast("string"))
    assert fit(docs) is None
    assert {r["lang_pred"] for r in language_query(docs).collect()} == {"und"}


def test_long_text_in_blocks_counts_all_n_grams(monkeypatch):
    text = "abc déf ghi " * 50
    whole = features(text)
    monkeypatch.setattr("fraudlake.llm.language_id._BLOCK", 7)
    assert np.allclose(whole, features(text))


def test_families_come_first():
    rng = np.random.default_rng(1)
    words = {"en": "the and with", "de": "der und mit", "fr": "les et avec", "es": "los y con"}
    texts = [(lang, " ".join(rng.choice(w.split(), 20))) for lang, w in words.items() for _ in range(20)]
    model = Hierarchy.fit(np.stack([features(t) for _, t in texts]), np.array([lang for lang, _ in texts], dtype=object))
    assert model.families.classes == ["germanic", "romance"]
    assert model.languages["romance"].classes == ["es", "fr"]
    assert model.families.weights.shape == (1, DIMENSIONS + 1)
    assert model.predict(np.stack([features("les et avec et")]))[0].tolist() == ["fr"]


def test_the_sample_is_not_halved():
    assert inspect.signature(fit).parameters["sample_rows"].default == 4000


def test_tasks_hold_the_sample_once(spark, monkeypatch):
    docs = cases.table_of(spark, SF).filter("doc_id is not null and text rlike '[a-z]'")
    frame, tasks = type(docs), []
    usual = frame.mapInPandas
    monkeypatch.setattr(frame, "mapInPandas", lambda self, task, *a, **b: tasks.append(task) or usual(self, task, *a, **b))
    rows = 300
    fit(docs, sample_rows=rows)
    vectors, trained = tasks
    sample = docs.filter(~language_id.held_out()).dropDuplicates(["doc_id"]).select("doc_id", "lang", "text").toPandas()
    sample = sample.dropna().groupby("lang").head(rows // sample["lang"].nunique()).sort_values(["lang", "doc_id"], ignore_index=True)

    frames = list(vectors(iter([pd.concat([sample] * 4, ignore_index=True)])))
    assert sum(map(len, frames)) == 4 * len(sample) > 900
    assert max(map(len, frames)) <= 256

    made = next(vectors(iter([sample])))["x"].tolist()[:256]
    langs = sample["lang"].tolist()
    tracemalloc.start()
    batches = (pd.DataFrame({"doc_id": [k], "lang": [langs[k]], "x": [bytes(bytearray(made[k]))]}) for k in range(len(made)))
    model = pickle.loads(next(trained(batches))["model"][0])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 1.5 * 4 * DIMENSIONS * len(made) + 2e6
    want = Hierarchy.fit(np.stack([np.frombuffer(v, dtype=np.float32) for v in made]), np.array(langs[: len(made)], dtype=object))
    assert np.array_equal(model.families.weights, want.families.weights)
