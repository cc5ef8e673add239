import re

from pyspark.sql import functions as F

from fraudlake.llm.license_rules import rules
from fraudlake.llm.license_scan import BASE, license_query, scan
from tests.llm import cases

WORD = re.compile("[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+")


def words_of(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return WORD.findall(lower)


def phrase_places(words):
    return sorted(
        (k, rule.label)
        for rule in BASE
        for k in range(len(words))
        if words[k : k + len(rule.pattern.split())] == rule.pattern.split()
    )


def found_by_hand(words):
    text = " " + "".join(w + " " for w in words)
    found = []
    for rule in rules():
        if rule.keyword in text:
            for m in re.finditer(f"(?<= )(?:{rule.pattern})(?= )", text):
                start = text[: m.start()].count(" ") - 1
                found.append((start, -(start + m.group().count(" ") + 1), rule.priority, rule.label, rule.confidence))
    kept = []
    for start, neg_end, priority, label, _ in sorted(found):
        new = (start, -neg_end, label, priority)
        clash = [d for d in kept if d[0] < new[1] and new[0] < d[1]]
        assert len(clash) <= 1
        if clash and (new[1] <= clash[0][1] or priority >= clash[0][3]):
            continue
        kept = [d for d in kept if d not in clash] + [new]
    assert all(a[1] <= b[0] for a, b in zip(kept, kept[1:], strict=False))
    return [d[:3] for d in kept]


TEXTS = [
    "Licensed under CC BY-NC 4.0. cc  by; CC_BY cc--by ccby",
    "GNU General Public License, version 3 or later. General public licenses. general PUBLIC license",
    "SPDX-License-Identifier: GPL-2.0-only\nAll rights reserved. ALL RIGHTS\nRESERVED",
    "Released under the MIT License. Copyright (c) 2020-2024 X. All Rights Reserved all rights reserved",
    "Apache License, Version 2.0 and the Mozilla Public License 2.0; bsd 3-clause license",
    "bacKed İce cc by cc by all rights reserved",
    "cc by cc by cc by",
    "may not be reproduced without permission to use copy modify and or distribute this software",
]


def check(rows, texts):
    assert len(rows) == len(texts)
    for row in rows:
        words = words_of(texts[row["doc_id"]])
        base = phrase_places(words)
        found = found_by_hand(words)
        assert row["n_words"] == len(words)
        assert row["n_base"] == len(base)
        assert row["first_word"] == min((k for k, _ in base), default=None)
        assert row["last_word"] == max((k for k, _ in base), default=None)
        assert row["base_labels"] == ",".join(sorted({label for _, label in base}))
        assert [tuple(d) for d in row["detections"]] == found
        assert row["labels"] == ",".join(sorted({label for _, label in base} | {d[2] for d in found}))
        assert 0 <= row["score"] <= 1
        assert (row["score"] > 0) == bool(base or found)


def test_against_brute_force(spark):
    docs = cases.table_of(spark, "/root/testdata/sf0.01")
    check(license_query(docs).collect(), {r["doc_id"]: r["text"] for r in docs.collect()})


def test_written_out_texts(spark):
    texts = dict(enumerate(TEXTS))
    rows = license_query(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()
    check(rows, texts)
    labels = {r["doc_id"]: r["labels"] for r in rows}
    assert labels[0] == "cc-by,cc-by-nc-4.0"
    assert labels[1] == "gpl,gpl-3.0"
    assert "gpl-2.0" in labels[2] and "reserved" in labels[2]
    assert "mit" in labels[3] and "copyright" in labels[3]


def test_odd_rows(spark):
    docs = cases.documents(spark)
    rows = license_query(docs).collect()
    assert len(rows) == len(cases.ROWS)
    assert {r["n_words"] for r in rows if r["doc_id"] in (2, 3, 4)} == {0}
    assert [r["n_words"] for r in rows if r["doc_id"] == 6] == [120_000]
    assert license_query(cases.empty(spark)).collect() == []


def test_many_places_in_one_text(spark):
    docs = spark.range(1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("all rights reserved. "), 3000).alias("text"))
    row = license_query(docs).first()
    assert (row["n_base"], row["first_word"], row["last_word"]) == (3000, 0, 8997)


def test_there_are_hundreds_of_rules_and_no_python(spark, capsys):
    assert len(rules()) >= 200
    scan(cases.documents(spark)).explain()
    plan = capsys.readouterr().out
    assert "Python" not in plan and "Exchange" not in plan
