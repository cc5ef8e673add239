import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from fraudlake.llm import near_dedup
from fraudlake.llm.components import component_labels
from fraudlake.llm.near_dedup import BINS, ORDERS, PROBES, WordHashes, bins_of, equal_bins, near_duplicates, shingles, sketch_of
from tests.llm import cases


def plain_set(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for space in "\t\n\v\f\r":
        words = words.replace(space, " ")
    words = [w for w in words.split(" ") if w]
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def by_hand(docs):
    """doc_id: (n_shingles, component_id, kept) by comparing all pairs."""
    sets = {d: plain_set(t) for d, t in docs}
    root = {d: d for d in sets}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * len(sets[a] | sets[b]):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return {d: (len(sets[d]), find(d), find(d) == d) for d in ids}


def found(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in near_duplicates(df).collect()}


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_whole_table_against_all_pairs(spark, sf):
    docs = cases.table_of(spark, f"/root/testdata/{sf}")
    assert found(docs) == by_hand([(r["doc_id"], r["text"]) for r in docs.collect()])


def families(seed, groups, copies, most):
    """Copies of a text with differing shares of words replaced: similarities on both sides of 0.75."""
    rng = random.Random(seed)
    rows = []
    for _ in range(groups):
        text = [f"w{rng.randrange(5000)}" for _ in range(rng.choice([6, 12, 60, 200]))]
        for _ in range(copies):
            share = rng.random() * most
            rows.append(" ".join(f"n{rng.randrange(10**6)}" if rng.random() < share else w for w in text))
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("groups, copies, most", [(3, 150, 0.12), (60, 6, 0.06), (1, 400, 0.08)])
def test_no_link_is_lost_around_the_threshold(spark, groups, copies, most):
    rows = families(groups, groups, copies, most)
    want = by_hand(rows)
    assert len({c for _, c, _ in want.values()}) > groups
    assert found(spark.createDataFrame(rows, "doc_id long, text string")) == want


def test_blocks_of_a_large_bucket(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK_ROWS", 16)
    rows = families(9, 2, 120, 0.12)
    assert found(spark.createDataFrame(rows, "doc_id long, text string")) == by_hand(rows)


def test_exact_threshold_and_short_texts(spark):
    words = [f"a{k}" for k in range(9)]
    rows = [
        (1, " ".join(words[:7])),  # 3 shingles, inside the 4 of the next: exactly 0.75
        (2, " ".join(words[:8])),
        (3, "one two"),
        (4, "ONE\ttwo"),
        (5, "one two three"),
        (6, "é b c d e f"),
        (7, "É b c d e f"),
        (8, "a b c d e f"),
        (9, "a b c d e f"),
    ]
    assert found(spark.createDataFrame(rows, "doc_id long, text string")) == by_hand(rows)


def test_a_text_and_its_first_seven_words_are_linked(spark):
    text = "w581491 w662449 w586868 w205276 w199220 w803682 w891521 w410843"  # 3 of 4 shingles
    rows = [(1, text), (2, text.rsplit(" ", 1)[0])]
    assert found(spark.createDataFrame(rows, "doc_id long, text string")) == {1: (4, 1, True), 2: (3, 1, False)}


def test_short_pairs_at_the_threshold_are_all_linked(spark):
    rng = random.Random(4)
    rows = []
    for shingled in (4, 8, 12, 24, 48, 64, 68):
        for _ in range(60):
            words = [f"w{rng.randrange(10**6)}" for _ in range(shingled + 4)]
            rows += [" ".join(words), " ".join(words[: 3 * shingled // 4 + 4])]
    want = {k: (k - k % 2, k % 2 == 0) for k in range(len(rows))}
    got = found(spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string"))
    assert {k: v[1:] for k, v in got.items()} == want


@pytest.mark.parametrize("size", [65, 88, 300, 1000])
def test_larger_sets_at_the_threshold_pass_the_sketch(size):
    rng = np.random.default_rng(size)
    for _ in range(400):
        hashes = rng.integers(0, 2**64, size, dtype=np.uint64)
        part = hashes[: -(-3 * size // 4)]
        x, y = (bins_of(np.sort(h)) for h in (hashes, part))
        assert equal_bins(sketch_of(x), sketch_of(y)) >= near_dedup.LEAST_EQUAL_BINS


def test_no_step_makes_a_table_of_pairs(spark, monkeypatch):
    """Rows of every table grow with the documents of a family, not with its pairs."""
    sizes = {}

    def counting(df, label, plain=near_dedup.written):
        out = plain(df, label)
        sizes.setdefault(label, []).append(out.count())
        return out

    monkeypatch.setattr(near_dedup, "written", counting)
    rows = families(3, 1, 600, 0.1)
    assert found(spark.createDataFrame(rows, "doc_id long, text string")) == by_hand(rows)
    members = sum(sizes["buckets"])
    assert all(sum(n) <= members for label, n in sizes.items() if label != "buckets")
    assert sizes["stars"][0] <= len(rows)


def test_buckets_of_the_same_components_give_the_same_edges():
    """Whichever members meet, and in whatever order, so the edges of many buckets are not as many tables of edges."""
    hashes = np.sort(np.random.default_rng(1).integers(0, 2**64, 40, dtype=np.uint64))

    def edges(ids, components):
        block = pd.DataFrame({"id": ids, "component": components, "n": 40, "half": 0, "block_a": 0, "block_b": 0})
        block["sketch"], block["small"] = sketch_of(bins_of(hashes)).tobytes(), hashes.tobytes()
        return sorted(near_dedup._forest(block, False).itertuples(index=False, name=None))

    assert edges([1, 5, 9], [1, 5, 9]) == edges([9, 6, 2], [9, 5, 1]) == edges([7, 2, 9, 1], [5, 1, 9, 1]) == [(1, 5), (1, 9)]


def test_new_labels_go_to_components_not_to_rows(spark, monkeypatch):
    """A large family needs them; small ones, whose buckets are of one component, and the rows of its own have no part."""
    monkeypatch.setattr(near_dedup, "BLOCK_ROWS", 16)
    sizes = {}

    def counting(df, label, plain=near_dedup.written):
        out = plain(df, label)
        sizes.setdefault(label, []).append(out.count())
        return out

    monkeypatch.setattr(near_dedup, "written", counting)
    rows = families(9, 1, 120, 0.12) + [(1000 + k, t) for k, t in families(5, 40, 5, 0.01)]
    assert found(spark.createDataFrame(rows, "doc_id long, text string")) == by_hand(rows)
    assert 0 < sizes["joined"][0] < sizes["placed"][0] / 2


def test_groups_that_their_parts_join_meet_in_no_block(spark):
    rows = spark.createDataFrame([(g, k, k % 3) for g in (1, 2) for k in range(30)], "bucket long, id long, component long")
    counts = near_dedup.counted(rows, "bucket", F.lit(0))
    assert near_dedup.blocked(rows, "bucket", counts).select("bucket", "id").distinct().count() == 60
    in_one = counts.withColumn("joined", F.when(F.col("bucket") == 1, 0).when(F.col("component") == 2, 1).otherwise(F.col("component")))
    left = near_dedup.blocked(rows, "bucket", in_one).collect()
    assert {r["bucket"] for r in left} == {2}
    assert {(r["id"], r["component"]) for r in left} == {(k, min(k % 3, 1)) for k in range(30)}


def test_odd_rows(spark):
    rows = near_duplicates(cases.documents(spark)).collect()
    assert len(rows) == len(cases.ROWS)
    named = {r["doc_id"]: (r["component_id"], r["kept"]) for r in rows if r["doc_id"] is not None}
    assert named == {1: (1, True), 2: (2, True), 3: (3, True), 4: (4, True), 5: (5, True), 6: (6, True), 7: (6, False), 8: (8, True),
                     9: (9, True), 10: (10, True)}
    assert [(r["component_id"], r["kept"]) for r in rows if r["doc_id"] is None] == [(None, True)] * 2
    assert {r["n_shingles"] for r in rows if r["doc_id"] in (2, 3, 4)} == {0}
    assert near_duplicates(cases.empty(spark)).collect() == []


def test_a_doc_id_of_several_texts_is_linked_by_each_of_them(spark):
    texts = [" ".join(f"t{k}w{i}" for i in range(40)) for k in range(12)]
    rows = [(5, text) for text in texts] + [(5, None), (5, "")]
    rows += [(100 + k, text + " more") for k, text in enumerate(texts)]  # a near copy of each
    rows += [(3, texts[4] + " and more"), (200, "something else that nobody else has said so far")]
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == len(rows)
    want = {d: 3 for d in [3, 5, *range(100, 112)]} | {200: 200}
    labels = {}
    for r in got:
        if r["n_shingles"]:
            labels.setdefault(r["doc_id"], set()).add(r["component_id"])
            assert r["kept"] == (r["doc_id"] == want[r["doc_id"]])
    assert labels == {d: {c} for d, c in want.items()}


def test_a_group_of_copies(spark):
    docs = spark.range(5000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "one and the same text for all of us").otherwise(F.concat(F.lit("t "), "id")).alias("text")
    )
    rows = near_duplicates(docs)
    assert rows.filter("kept").count() == 5000 - (5000 + 2) // 3 + 1
    assert rows.filter("doc_id % 3 = 0").select("component_id").distinct().collect()[0][0] == 0


def test_sketches_estimate_similarity():
    rng = random.Random(8)
    for size in (2, 8, 40, 900):
        equal = []
        for _ in range(20):
            common = [f"c{rng.random()}" for _ in range(3 * size // 4 + 5)]
            left = shingles(" ".join(common + [f"l{rng.random()}" for _ in range(size // 8)]), WordHashes())
            right = shingles(" ".join(common + [f"r{rng.random()}" for _ in range(size // 8)]), WordHashes())
            truth = len(np.intersect1d(left, right)) / len(np.union1d(left, right))
            x, y = bins_of(left), bins_of(right)
            assert equal_bins(sketch_of(x), sketch_of(y)) >= (x == y).sum()
            equal.append((x == y).mean() - truth)
        assert abs(np.mean(equal)) < 0.03
    assert (np.sort(PROBES, axis=1) == np.arange(BINS)).all()
    assert (PROBES[np.arange(BINS), ORDERS] == np.arange(BINS)[:, None]).all()


def test_components_of_chains_and_stars(spark):
    edges = [(k, k + 1) for k in range(100, 160)] + [(5, k) for k in range(200, 400)] + [(399, 3), (7, 7)]
    got = {r["id"]: r["component"] for r in component_labels(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {got[k] for k in range(100, 161)} == {100}
    assert {got[k] for k in [3, 5, *range(200, 400)]} == {3}
    assert 7 not in got
    assert component_labels(spark.createDataFrame([], "a long, b long")).collect() == []
