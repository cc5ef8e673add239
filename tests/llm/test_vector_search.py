import math
import random

import pytest

from fraudlake.llm import vector_search
from fraudlake.llm.vector_search import SEARCH_SQL, search_query, top_scores
from tests.compare import connect, differences

SCHEMA = "vec_id long, embedding array<double>, label int, ids string, v string, score string, pivot int"


def by_hand(rows, divisor, top):
    valid = []
    for vec_id, x in rows:
        if vec_id is not None and x is not None and all(c is not None and math.isfinite(c) for c in x):
            valid.append((vec_id, [math.floor(64 * c) for c in x]))
    out = set()
    for q, x in valid:
        if q % divisor == 0:
            scored = sorted((-sum(a * b for a, b in zip(x, y, strict=False)), c) for c, y in valid if c != q)
            out |= {(q, k + 1, c, -s) for k, (s, c) in enumerate(scored[:top])}
    return out


def frame(spark, rows):
    return spark.createDataFrame([(i, x, 0, "other", "other", "other", 1) for i, x in rows], SCHEMA)


def found(df, *args):
    rows = [tuple(r) for r in top_scores(df, *args).collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_query_equals_sql(spark):
    assert differences(spark, connect("/root/testdata/sf0.001"), search_query, SEARCH_SQL, "/root/testdata/sf0.001") == []


@pytest.mark.parametrize("seed", range(6))
def test_against_all_pairs(spark, monkeypatch, seed):
    monkeypatch.setattr(vector_search, "STREAM_BLOCKS", 3)
    monkeypatch.setattr(vector_search, "QUERY_ROWS", 20)
    rng = random.Random(seed)
    dims, spread = rng.choice([(2, 1), (5, 1), (16, 0.2), (3, 50_000)]), rng.choice([0.01, 0.1, 1])
    centres = [[rng.gauss(0, dims[1]) for _ in range(dims[0])] for _ in range(6)]
    rows = [(k, [c + rng.gauss(0, spread * dims[1]) for c in rng.choice(centres)]) for k in range(700)]
    rows += [(k, [0.5] * dims[0]) for k in range(700, 1400)]  # one vector for many
    rng.shuffle(rows)
    assert found(frame(spark, rows), 10, 7) == by_hand(rows, 10, 7)


def test_odd_rows(spark):
    rows = [
        (0, [1.0, -0.5]), (20, [0.3, 0.3]), (40, []), (60, None), (80, [None, 1.0]), (None, [1.0, 1.0]),
        (100, [float("nan"), 1.0]), (120, [float("inf"), 0.0]), (1, [0.3, 0.3]), (2, [0.3, 0.3]), (3, [-1.0]),
    ]
    got = found(frame(spark, rows))
    assert got == by_hand(rows, 20, 20)
    assert {q for q, *_ in got} == {0, 20, 40}


def test_few_rows_and_empty_table(spark):
    assert found(frame(spark, [(0, [1.0])])) == set()
    assert found(frame(spark, [])) == set()
    assert found(frame(spark, [(None, [1.0]), (7, None)])) == set()


def test_negative_ids_and_zero_vectors(spark):
    rows = [(-20, [0.0, 0.0]), (-3, [0.0, 0.0]), (5, [0.0, -0.0]), (0, [1e-9, -1e-9])]
    assert found(frame(spark, rows)) == by_hand(rows, 20, 20)


def test_large_components_are_not_cut(spark):
    rows = [(0, [1.0]), (1, [float(2**26)]), (2, [float(2**27)])]
    assert found(frame(spark, rows)) == {(0, 1, 2, 549755813888), (0, 2, 1, 274877906944)}


def test_scores_that_do_not_fit_are_an_error(spark):
    with pytest.raises(ValueError, match="64 bits"):
        found(frame(spark, [(0, [float(2**30)]), (1, [float(2**40)])]))
