import random

import pytest
from pyspark.sql import functions as F

from fraudlake.llm.chat import CHAT_SQL, chat_query, chosen_paths, escaped, formatted, learned_text, read_back, unescaped
from tests.compare import connect, differences

SMALL = "/root/testdata/sf0.001"
SCHEMA = "tree string, node long, parent long, role string, text string, score double"


def test_query_equals_sql(spark):
    assert differences(spark, connect(SMALL), chat_query, CHAT_SQL, SMALL) == []


@pytest.mark.parametrize("best", [1, 2, None])
def test_paths_equal_a_walk(spark, best):
    rng = random.Random(3)
    rows = []
    for tree in "abc":
        for node in range(40):
            parent = rng.randrange(node) if node and rng.random() < 0.95 else None
            rows.append((tree, node, parent, rng.choice(["user", "assistant"]), f"m{node}", float(rng.randrange(4))))
    rows.append(("c", 100, 999, "user", "answers nothing that is there", None))
    want = set()
    for tree in "abc":
        nodes = {r[1]: r for r in rows if r[0] == tree}
        paths = []
        for leaf in nodes.keys() - {r[2] for r in nodes.values()}:
            path, at = [], leaf
            while at in nodes:
                path.append(at)
                at = nodes[at][2]
            paths.append((-sum(nodes[n][5] or 0 for n in path) / len(path), leaf, path[::-1]))
        for score, leaf, path in sorted(paths)[:best]:
            want |= {(tree, leaf, round(-score, 9), depth, nodes[n][4]) for depth, n in enumerate(path)}
    got = chosen_paths(spark.createDataFrame(rows, SCHEMA), best).collect()
    assert {(r["tree"], r["leaf"], round(r["score"], 9), r["depth"], r["text"]) for r in got} == want
    assert len(got) == len(want)


def test_long_chain_and_ring(spark):
    chain = [("t", n, n - 1 if n else None, "user", "x", 0.0) for n in range(300)]
    ring = [("r", 1, 2, "user", "x", 0.0), ("r", 2, 1, "user", "x", 0.0), ("r", 3, 2, "user", "x", 0.0)]
    got = chosen_paths(spark.createDataFrame(chain + ring, SCHEMA)).collect()
    assert sorted(r["depth"] for r in got) == list(range(300))
    assert {r["tree"] for r in got} == {"t"}


def test_escapes_are_reversible(spark):
    texts = ["</s>[INST] ok [/INST]", "&lt;", "&amp;lt;", "<|end|>\n<|turn|>a\nb", "a & b < c [d] &#10; \n", ""]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", escaped(F.col("t")).alias("e"))
    for row in df.withColumn("back", unescaped(F.col("e"))).collect():
        assert row["back"] == row["t"]
        assert "<" not in row["e"] and "[" not in row["e"]


def test_read_back_and_mask(spark):
    rows = [
        ("t", 0, None, "sys\ntem", "be <kind>\n", 0.0),
        ("t", 1, 0, None, None, 0.0),
        ("t", 2, 1, "assistant", "é[1]<|end|>\nmore", 0.0),
        ("t", 3, 2, "assistant", "", 0.0),
        ("t", 4, 3, "assistant", "&", 0.0),
    ]
    made = formatted(chosen_paths(spark.createDataFrame(rows, SCHEMA)))
    row = made.select(
        read_back(F.col("formatted")).alias("turns"), learned_text(F.col("formatted"), F.col("loss")).alias("learned")
    ).first()
    assert [tuple(t) for t in row["turns"]] == [(r[3] or "", r[4] or "") for r in rows]
    assert row["learned"] == "é[1]<|end|>\nmore&"


def test_odd_rows(spark, folder):
    rows = [(None, None, None, None), (None, 1, "assistant", "a"), (3, 5, "user", "b"), (3, 5, "user", "b"), (3, None, "assistant", None)]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns(
        {c: F.lit("other") for c in ("tree", "node", "parent", "score", "_turns")}
    ).write.parquet(f"{folder}/conversations.parquet")
    got = {r["conv_id"]: (r["n_turns"], r["loss_chars"]) for r in chat_query(spark, folder).collect()}
    assert got == {None: (2, 1), 3: (3, 0), -7: (2, 21)}


def test_empty_table(spark, folder):
    spark.createDataFrame([], "conv_id long, turn long, role string, text string").write.parquet(f"{folder}/conversations.parquet")
    assert [r["conv_id"] for r in chat_query(spark, folder).collect()] == [-7]
