import math
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from fraudlake.functions import draws
from fraudlake.operators.rules import score_transactions
from fraudlake.sources.reference import CHANNELS, CITIES, MERCHANT_CATEGORIES, city_table
from fraudlake.synth import (
    STATED_MODEL,
    fit,
    generate,
    inject_patterns,
    load_model,
    row_ids,
    sample,
    sample_stored,
    save_model,
    seed_rows,
)
from fraudlake.synth.patterns import EVENT, HIGH_AMOUNTS
from fraudlake.synth.stored import _cell
from tests.rows import by_id

N = 20_000


@pytest.fixture(scope="module")
def seeds(spark):
    return seed_rows(row_ids(spark, N)).cache()


@pytest.fixture(scope="module")
def model(seeds):
    return fit(seeds)


def test_seed_ranges(seeds):
    row = seeds.agg(
        F.avg(F.col("is_fraud").cast("int")).alias("share"),
        F.min(F.when(F.col("is_fraud"), F.col("amount"))).alias("fraud_low"),
        F.max(F.when(~F.col("is_fraud"), F.col("amount"))).alias("usual_high"),
        F.min("amount").alias("low"),
        F.max("amount").alias("high"),
        F.min("event_timestamp").cast("string").alias("first"),
        F.max("event_timestamp").cast("string").alias("last"),
        F.count_if(~F.col("account_id").rlike(r"^ACC[1-9]\d{4}$")).alias("odd_accounts"),
        F.count_if(~F.col("merchant_id").rlike(r"^MER[1-9]\d{3}$")).alias("odd_merchants"),
        F.collect_set("channel").alias("channels"),
        F.collect_set("merchant_cat").alias("categories"),
    ).first()
    assert row["share"] == pytest.approx(0.05, abs=0.006)
    assert row["low"] >= 100 and row["usual_high"] <= 50_000
    assert row["fraud_low"] >= 300_000 and row["high"] <= 2_000_000
    assert row["first"] >= "2024-01-01 00:00:00" and row["last"] <= "2024-01-07 02:00:00"
    assert (row["odd_accounts"], row["odd_merchants"]) == (0, 0)
    assert set(row["channels"]) == set(CHANNELS) and set(row["categories"]) == set(MERCHANT_CATEGORIES)


def test_seed_rows_lie_near_a_city(spark, seeds):
    near = (F.abs(F.col("location_lat") - F.col("lat")) <= 0.500001) & (
        F.abs(F.col("location_lon") - F.col("lon")) <= 0.500001
    )
    assert seeds.join(F.broadcast(city_table(spark)), near, "left_anti").isEmpty()
    assert city_table(spark).count() == len(CITIES)


def test_draws_do_not_depend_on_partitions(spark):
    a = seed_rows(spark.range(0, 500, 1, 1)).collect()
    b = seed_rows(spark.range(0, 500, 1, 9).repartition(3)).collect()
    assert sorted(a) == sorted(b)
    assert sorted(a) != sorted(seed_rows(spark.range(500), seed=7).collect())


def test_draws_are_uniform_and_normal(spark):
    row = F.col("id")
    got = (
        spark.range(N)
        .select(
            draws.uniform(row, 1, "u").alias("u"),
            draws.uniform(row, 1, "v").alias("v"),
            draws.normal(row, 1, "n").alias("n"),
        )
        .agg(F.avg("u"), F.stddev("u"), F.corr("u", "v"), F.avg("n"), F.stddev("n"), F.min("u"), F.max("u"))
        .first()
    )
    assert got[0] == pytest.approx(0.5, abs=0.01)
    assert got[1] == pytest.approx(math.sqrt(1 / 12), abs=0.01)
    assert abs(got[2]) < 0.03
    assert got[3] == pytest.approx(0, abs=0.03)
    assert got[4] == pytest.approx(1, abs=0.03)
    assert 0 < got[5] < got[6] < 1


def test_fit_finds_marginals_and_dependence(model):
    assert model.rows == N
    assert sum(share for _, share in model.categories["channel"]) == pytest.approx(1)
    assert dict(model.categories["is_fraud"])["true"] == pytest.approx(0.05, abs=0.006)
    assert np.allclose(model.correlation, model.correlation.T)
    assert np.allclose(np.diag(model.correlation), 1)
    names = ["event_second", "amount", "location_lat", "location_lon", "merchant_cat", "channel", "is_fraud"]
    amount_fraud = model.correlation[names.index("amount"), names.index("is_fraud")]
    assert amount_fraud > 0.4
    assert abs(model.correlation[names.index("amount"), names.index("channel")]) < 0.05
    assert np.allclose(model.cholesky @ model.cholesky.T, model.correlation)


def test_sample_follows_the_model(spark, seeds, model):
    drawn = sample(row_ids(spark, N), model, 5).cache()
    assert drawn.columns == EVENT.names
    assert drawn.select("transaction_id").distinct().count() == N
    a, b = (
        d.agg(
            F.percentile_approx("amount", [0.1, 0.5, 0.9]).alias("amount"),
            F.percentile_approx("location_lat", [0.1, 0.5, 0.9]).alias("lat"),
            F.avg(F.col("is_fraud").cast("int")).alias("fraud"),
            F.avg((F.col("channel") == "POS").cast("int")).alias("pos"),
        ).first()
        for d in (seeds, drawn)
    )
    assert b["amount"] == pytest.approx(a["amount"], rel=0.08)
    assert b["lat"] == pytest.approx(a["lat"], rel=0.05)
    assert b["fraud"] == pytest.approx(a["fraud"], abs=0.01)
    assert b["pos"] == pytest.approx(a["pos"], abs=0.02)
    high = drawn.filter("amount > 300000").agg(F.avg(F.col("is_fraud").cast("int"))).first()[0]
    assert high > 2 * a["fraud"]


def test_null_values_and_constants_are_learnt(spark):
    ids = row_ids(spark, 4000)
    rows = seed_rows(ids).withColumns(
        {"amount": F.when(F.col("id") % 4 != 0, F.col("amount")), "location_lat": F.lit(10.0), "channel": F.lit("POS")}
    )
    model = fit(rows)
    assert model.null_share["amount"] == pytest.approx(0.25)
    drawn = sample(ids, model, 3)
    row = drawn.agg(
        F.avg(F.col("amount").isNull().cast("int")), F.collect_set("location_lat"), F.collect_set("channel")
    ).first()
    assert row[0] == pytest.approx(0.25, abs=0.03)
    assert (row[1], row[2]) == ([10.0], ["POS"])


def test_many_categories(spark):
    rows = seed_rows(row_ids(spark, 20_000)).withColumn("merchant_cat", F.concat(F.lit("c"), F.col("id")))
    model = fit(rows)
    assert len(model.categories["merchant_cat"]) == 20_000
    assert sample(row_ids(spark, 100), model, 1).filter("merchant_cat LIKE 'c%'").count() == 100


def test_fit_needs_rows(spark):
    with pytest.raises(ValueError, match="nothing"):
        fit(seed_rows(row_ids(spark, 0)))


def test_injected_patterns_are_found(spark):
    events = sample(row_ids(spark, 300), fit(seed_rows(row_ids(spark, 1000))), 1).withColumn("amount", F.lit(10.0))
    made = inject_patterns(events)
    assert made.count() == 305
    raised = made.filter("amount >= 600000").select("amount", "is_fraud").collect()
    assert sorted(r["amount"] for r in raised) == sorted(HIGH_AMOUNTS)
    assert all(r["is_fraud"] for r in raised)
    found = by_id(score_transactions(made).filter("account_id LIKE 'ACC_FRAUD%'"), "fraud_reasons")
    assert found == {
        "ACC_FRAUD_VEL-0": "",
        "ACC_FRAUD_VEL-1": "",
        "ACC_FRAUD_VEL-2": "VELOCITY",
        "ACC_FRAUD_GEO-0": "",
        "ACC_FRAUD_GEO-1": "GEO_ANOMALY",
    }
    labels = by_id(made.filter("account_id = 'ACC_FRAUD_GEO'"), "is_fraud")
    assert labels == {"ACC_FRAUD_GEO-0": False, "ACC_FRAUD_GEO-1": True}


def test_generate(spark):
    events = generate(spark, 200, seeds=500)
    assert events.count() == 205
    assert sorted(events.collect()) == sorted(generate(spark, 200, seeds=500).collect())


def stored(spark, model, folder):
    save_model(spark, model, folder)
    return load_model(spark, folder)


def test_a_saved_model_draws_the_same_events(spark, model, folder):
    ids = row_ids(spark, 5000)
    assert sorted(sample_stored(ids, stored(spark, model, folder), 5).collect(), key=str) == sorted(
        sample(ids, model, 5).collect(), key=str
    )


def test_a_saved_model_with_nulls_constants_and_many_categories(spark, folder):
    rows = seed_rows(row_ids(spark, 4000)).withColumns(
        {
            "amount": F.when(F.col("id") % 4 != 0, F.col("amount")),
            "location_lat": F.lit(10.0),
            "channel": F.when(F.col("id") % 3 != 0, F.lit("POS")),
            "merchant_cat": F.when(F.col("id") % 2 == 0, "usual").otherwise(F.concat(F.lit("c"), F.col("id"))),
        }
    )
    model, ids = fit(rows), row_ids(spark, 2000)
    drawn = sample_stored(ids, stored(spark, model, folder), 3)
    assert sorted(drawn.collect(), key=str) == sorted(sample(ids, model, 3).collect(), key=str)


def test_intervals_of_one_cell_are_few(spark, folder):
    """A third of all rows in one category, the others each in their own: a score meets few intervals."""
    rows = seed_rows(row_ids(spark, 3000)).withColumn(
        "merchant_cat", F.when(F.col("id") % 3 == 0, "usual").otherwise(F.concat(F.lit("c"), F.col("id")))
    )
    found = stored(spark, fit(rows), folder)
    cells = found.categories.filter("name = 'merchant_cat'")
    n = cells.count()
    listed = cells.select(F.explode(F.sequence(_cell(F.col("low"), n), _cell(F.col("high"), n))).alias("cell"))
    assert listed.count() <= 2 * n
    assert listed.groupBy("cell").count().agg(F.max("count")).first()[0] <= 8


def test_saving_again_replaces_the_model(spark, model, folder):
    save_model(spark, model, folder)
    again = stored(spark, STATED_MODEL, folder)
    assert again.steps.count() == 4 + 7 + 6 + 6
    assert sample_stored(row_ids(spark, 50), again, 1).count() == 50


def test_an_incomplete_model_is_an_error(spark, model, folder):
    found = stored(spark, model, folder)
    for part in ({"weights": found.weights.limit(1)}, {"steps": found.steps.limit(0)}, {"categories": found.categories.limit(0)}):
        with pytest.raises(ValueError, match="model"):
            sample_stored(row_ids(spark, 5), replace(found, **part), 1)
