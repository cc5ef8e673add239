"""The command line jobs, one after the other."""

import pytest
from pyspark.sql import functions as F

from fraudlake.__main__ import main
from fraudlake.sources.records import RecordSource


def test_from_generated_events_to_reports(spark, folder, tmp_path, capsys):
    suffix = folder.rsplit("-", 1)[1]
    lake = ["--lake", f"{folder}/lake", "--raw-db", f"raw_{suffix}", "--curated-db", f"curated_{suffix}"]
    assert main(["check", *lake], spark) == 1
    assert main(["bootstrap", *lake], spark) == 0
    assert main(["check", *lake], spark) == 0

    assert main(["generate", "--rows", "60", "--output", f"{folder}/csv"], spark) == 0
    sent = ["--records", f"{folder}/records"]
    assert main(["produce", "--input", f"{folder}/csv", "--rate", "0", *sent], spark) == 0
    assert main(["produce", "--rows", "15", "--rate", "10", *sent], spark) == 0
    assert RecordSource.files(f"{folder}/records").batch(spark).count() == 65 + 20

    ingest = ["ingest", *lake, *sent, "--checkpoint", f"{folder}/cp"]
    assert main(ingest, spark) == 0
    assert main(ingest, spark) == 0
    assert spark.table(f"raw_{suffix}.transactions").count() == 85

    other = ["--lake", f"{folder}/other", "--raw-db", f"raw2_{suffix}", "--curated-db", f"curated2_{suffix}"]
    assert main(["ingest", *other, *sent, "--offsets", f"{folder}/offsets"], spark) == 0
    assert spark.table(f"raw2_{suffix}.transactions").count() == 85

    assert main(["day", *lake, "--dt", "2024-07-01"], spark) == 0
    assert main(["day", *lake], spark) == 0  # yesterday has no data
    days = spark.table(f"curated_{suffix}.transactions").groupBy("dt").agg(F.count("*").alias("n")).collect()
    assert [(r["dt"], r["n"]) for r in days] == [("2024-07-01", 4)]

    capsys.readouterr()
    assert main(["report", *lake, "--as-of", "2024-07-01"], spark) == 0
    shown = capsys.readouterr().out
    assert "kpi_day" in shown and "GEO_ANOMALY" in shown
    assert main(["report", *lake, "--name", "fraud_type"], spark) == 0
    assert "kpi_day" not in capsys.readouterr().out
    own = tmp_path / "own.sql"
    own.write_text(f"SELECT COUNT(*) AS n FROM raw_{suffix}.transactions; -- all\n\nSELECT ';' AS mark;\n")
    assert main(["report", *lake, "--file", str(own)], spark) == 0
    shown = capsys.readouterr().out
    assert "statement_2" in shown and "85" in shown
    assert main(["report", *lake, "--as-of", "2024-07-01", "--output", f"{folder}/out"], spark) == 0
    assert spark.read.option("header", True).csv(f"{folder}/out/fraud_type").count() == 1
    assert main(["fold", *lake, "--dt", "2024-07-01"], spark) == 0


def test_two_deliveries_arrive(spark, folder):
    suffix = folder.rsplit("-", 1)[1]
    lake = ["--lake", f"{folder}/lake", "--raw-db", f"raw3_{suffix}", "--curated-db", f"curated3_{suffix}"]
    for seed in ("1", "2"):
        assert main(["produce", "--rows", "20", "--seed", seed, "--rate", "0", "--records", f"{folder}/r"], spark) == 0
        assert main(["ingest", *lake, "--records", f"{folder}/r", "--offsets", f"{folder}/o"], spark) == 0
    assert spark.table(f"raw3_{suffix}.transactions").count() == 50


def test_json_output(spark, folder):
    assert main(["generate", "--rows", "20", "--output", f"{folder}/json", "--format", "json"], spark) == 0
    assert spark.read.json(f"{folder}/json").count() == 25


def test_a_learnt_model_is_used_again(spark, folder):
    assert main(["generate", "--rows", "200", "--output", f"{folder}/seen"], spark) == 0
    assert main(["learn", "--input", f"{folder}/seen", "--model", f"{folder}/model"], spark) == 0
    for out in ("a", "b"):
        assert main(["generate", "--rows", "30", "--model", f"{folder}/model", "--output", f"{folder}/{out}"], spark) == 0
    a, b = (spark.read.option("header", True).csv(f"{folder}/{out}") for out in ("a", "b"))
    assert a.count() == 35 and a.exceptAll(b).isEmpty()


def test_bad_arguments(spark):
    with pytest.raises(SystemExit):
        main(["produce", "--rows", "1", "--input", "x"], spark)
    with pytest.raises(SystemExit):
        main(["produce", "--rows", "1", "--rate", "0"], spark)
    with pytest.raises(ValueError):
        main(["day", "--lake", "/tmp/none", "--dt", "not-a-day"], spark)
