import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from fraudlake.llm.merkle import exchanged, folded, manifest, manifest_leaves, manifest_query
from fraudlake.session import written
from tests.llm import cases


def digest(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf(row, more=0):
    values = [row["doc_id"], row["source"], row["lang"], row["n_chars"] if row["n_chars"] is None else row["n_chars"] + more, row["text"]]
    return digest(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def climb(nodes, fanout):
    """The root, and of each node the runs of siblings (before, after) up to it."""
    proofs, above = [[] for _ in nodes], [[k] for k in range(len(nodes))]
    while len(nodes) > 1:
        parents, held = [], []
        for k in range(0, len(nodes), fanout):
            run = nodes[k : k + fanout]
            for place, _ in enumerate(run):
                for one in above[k + place]:
                    proofs[one].append(("".join(run[:place]), "".join(run[place + 1 :])))
            parents.append(digest(*run))
            held.append([x for part in above[k : k + fanout] for x in part])
        nodes, above = parents, held
    return nodes[0] if nodes else None, proofs


def expected(rows, fanout=2):
    by_lang = {}
    for row in rows:
        by_lang.setdefault(row["lang"], []).append((row["doc_id"] is not None, row["doc_id"] or 0, leaf(row), row))
    langs = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    trees = {lang: sorted(by_lang[lang], key=lambda x: x[:3]) for lang in langs}
    climbed = {lang: climb([x[2] for x in trees[lang]], fanout) for lang in langs}
    root, tops = climb([climbed[lang][0] for lang in langs], fanout)
    out = []
    for lang, top in zip(langs, tops, strict=True):
        subroot, proofs = climbed[lang]
        for (_, _, mine, row), proof in zip(trees[lang], proofs, strict=True):
            path = [*proof, *top]
            due = row["doc_id"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 7 == 0
            now = leaf(row, int(due))
            for before, after in path:
                now = digest(before, now, after)
            out.append((row["doc_id"], mine, subroot, root, digest(*(x for p in path for x in p)), now, now == root))
    return sorted(out, key=str)


def found(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_whole_table(spark):
    docs = cases.table_of(spark, "/root/testdata/sf0.01")
    rows = found(manifest_query(docs))
    assert rows == expected(docs.collect())
    assert any(not r[-1] for r in rows) and any(r[-1] for r in rows)


@pytest.mark.parametrize(("fanout", "levels"), [(2, 2), (3, 1)])
def test_exchange_over_many_blocks_is_the_plain_tree(spark, fanout, levels):
    docs = cases.table_of(spark, "/root/testdata/sf0.001")
    assert found(manifest_query(docs, fanout=fanout, levels=levels, rows_per_range=30)) == expected(docs.collect(), fanout)


@pytest.mark.parametrize("members", [1, 3, 13])
def test_every_member_gets_the_root_and_its_proof(spark, members):
    nodes = [digest(str(k)) for k in range(members)]
    nothing = F.expr("cast(array() as array<string>)")
    state = spark.createDataFrame([(7, k, members, n) for k, n in enumerate(nodes)], "tree long, member long, members long, root string")
    rows = exchanged(written(state.withColumns({"before": nothing, "after": nothing}), "state")).orderBy("member").collect()
    root, proofs = climb(nodes, 2)
    assert {r["root"] for r in rows} == {root}
    assert [list(zip(r["before"], r["after"], strict=True)) for r in rows] == proofs


def test_one_lang_and_equal_rows(spark):
    docs = spark.range(200).select(
        F.when(F.col("id") % 3 > 0, F.col("id")).alias("doc_id"), F.lit("x").alias("text"), F.lit("en").alias("lang"), F.lit("s").alias("source"), F.lit(1).alias("n_chars")
    )
    assert found(manifest_query(docs, levels=2, rows_per_range=20)) == expected(docs.collect())


def test_general_interface_keeps_columns(spark):
    docs = cases.table_of(spark, "/root/testdata/sf0.001")
    leaves = docs.select("source", "doc_id", F.sha2("text", 256).alias("leaf"), F.lit(5).alias("extra"))
    rows = manifest(leaves, "source", ["doc_id"], fanout=4, levels=2).withColumn("back", folded(F.col("leaf"))).collect()
    assert len(rows) == docs.count()
    assert all(r["back"] == r["root"] and r["extra"] == 5 for r in rows)
    assert len({r["root"] for r in rows}) == 1
    assert len({r["subroot"] for r in rows}) == len({r["source"] for r in rows})


def test_odd_rows_and_empty_table(spark):
    docs = cases.documents(spark).drop("leaf")
    names = cases.SCHEMA.replace(" bigint", "").replace(" string", "").split(", ")
    assert found(manifest_query(docs, levels=1)) == expected([dict(zip(names, r, strict=True)) for r in cases.ROWS])
    clashing = docs.withColumns({c: F.lit("other") for c in ("leaf", "tampered", "before", "after", "place", "tree", "block", "n", "root")})
    assert found(manifest_query(clashing)) == found(manifest_query(docs))
    assert manifest_query(cases.empty(spark)).collect() == []
    most = docs.limit(1).withColumn("n_chars", F.lit(2**63 - 1)).withColumn("doc_id", F.lit(9).cast("long"))
    assert manifest_leaves(most).count() == 1


def test_any_change_of_a_row_breaks_its_proof(spark):
    docs = cases.table_of(spark, "/root/testdata/sf0.001")
    other = manifest_leaves(docs.withColumn("source", F.lit("other"))).select("doc_id", F.col("leaf").alias("changed"))
    rows = manifest(manifest_leaves(docs), "lang", ["doc_id"], levels=3).join(other, "doc_id")
    assert rows.filter(folded(F.col("changed")) == F.col("root")).count() == 0
