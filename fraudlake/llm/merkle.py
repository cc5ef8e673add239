"""A manifest of a dataset as Merkle trees, proofs made by a butterfly exchange.

Each group (language) is a tree of its rows in order, and the groups' roots are the leaves of a last
tree. Rows are cut into aligned blocks of fanout ** levels leaves, and each block builds its own
subtree. Then the blocks exchange: in round r, aligned groups of fanout ** r blocks hold the same
subtree root, and every block swaps it with a member of each sibling group. It hashes the common
parent itself, redundantly, and adds the siblings to its proof. After the last round every block holds
the root and the upper part of its rows' proofs, so nothing has to be sent back down the tree. The
roots of the groups go through the same exchange.

A row's proof is two lists, from the bottom up: the digests before and after it in its run, each run
as one string. Digests are lowercase hex text, and a parent hashes its children's text.
"""

from __future__ import annotations

from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fraudlake.llm.common import written
from fraudlake.operators.ranks import ROWS_PER_RANGE, ranked

FANOUT = 2
LEVELS = 12


def digest_of(*fields: Column) -> Column:
    """SHA-256 of fields, each as its UTF-8 byte count, a colon and its text, or as '-' if null."""
    text = [f.cast("string") for f in fields]
    return F.sha2(F.concat(*(F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in text)), 256)


def height(leaves: int, fanout: int) -> int:
    """Levels above the leaves until one node remains."""
    levels = 0
    while leaves > 1:
        leaves, levels = -(-leaves // fanout), levels + 1
    return levels


def runs(nodes: list[str], fanout: int) -> list[list[str]]:
    return [nodes[k : k + fanout] for k in range(0, len(nodes), fanout)]


def subtree(leaves: list[str], levels: int, fanout: int) -> list[list[str]]:
    """All levels of a subtree, the leaves first."""
    out = [leaves]
    for _ in range(levels):
        out.append([sha256("".join(run).encode()).hexdigest() for run in runs(out[-1], fanout)])
    return out


def paths(leaves: list[str], levels: int, fanout: int) -> tuple[list[list[str]], list[list[str]]]:
    """For each leaf, level by level, the digests before and after its ancestor in its run."""
    tree = [runs(nodes, fanout) for nodes in subtree(leaves, levels, fanout)[:levels]]
    before: list[list[str]] = [[] for _ in leaves]
    after: list[list[str]] = [[] for _ in leaves]
    for leaf in range(len(leaves)):
        at = leaf
        for level in tree:
            run, place = level[at // fanout], at % fanout
            before[leaf].append("".join(run[:place]))
            after[leaf].append("".join(run[place + 1 :]))
            at //= fanout
    return before, after


def exchanged(state: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """state (tree, member from 0, members, root, before, after; written) after all rounds.

    Every member has the root of its whole tree, and its proof from its own root up to that. A member
    asks one member of each sibling group, each member of it equally often, so no member is a centre.
    Every round is a written table.
    """
    most, span = state.agg(F.max("members")).first()[0] or 0, 1
    while span < most:
        mine = F.expr(f"member div {span}")
        groups = F.expr(f"(members + {span - 1}) div {span}")
        first = F.expr(f"(member div {span * fanout}) * {fanout}")
        asks = (
            state.filter(groups > 1)
            .select("tree", "member", "members", F.explode(F.sequence(first, F.least(first + fanout, groups) - 1)).alias("theirs"))
            .select(
                "tree",
                "member",
                "theirs",
                F.expr(f"theirs * {span} + (member % {span}) % least({span}, members - theirs * {span})").alias("ask"),
            )
        )
        held = state.select("tree", F.col("member").alias("ask"), F.col("root").alias("digest"))
        swapped = (
            asks.join(held, ["tree", "ask"])
            .groupBy("tree", "member")
            .agg(F.sort_array(F.collect_list(F.struct("theirs", "digest"))).alias("run"))  # fanout of them at most
        )

        def text(keep, run: Column = F.col("run")) -> Column:
            return F.array_join(F.transform(F.filter(run, keep), lambda x: x["digest"]), "")

        swap = F.col("run").isNotNull()
        state = written(
            state.join(swapped, ["tree", "member"], "left").select(
                "tree",
                "member",
                "members",
                F.when(swap, F.sha2(text(lambda x: F.lit(True)), 256)).otherwise(F.col("root")).alias("root"),
                F.when(swap, F.concat("before", F.array(text(lambda x: x["theirs"] < mine)))).otherwise(F.col("before")).alias("before"),
                F.when(swap, F.concat("after", F.array(text(lambda x: x["theirs"] > mine)))).otherwise(F.col("after")).alias("after"),
            ),
            "exchanged",
        )
        span *= fanout
    return state


def manifest(
    leaves: DataFrame,
    group: str,
    order: list[str],
    fanout: int = FANOUT,
    levels: int = LEVELS,
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """leaves (with a column leaf) with before, after (its proof), subroot, root.

    Rows of a group ascend by order, nulls first, ties by leaf; groups ascend likewise, null first.
    Rows that are equal in all of these are leaves of their own. An empty table has no root.
    """
    placed = ranked(leaves, [group], [*order, "leaf"], "place", rows_per_range)
    counts = written(placed.groupBy(group).agg(F.count(F.lit(1)).alias("n")), "groups")
    trees = ranked(counts, [], [group], "tree", rows_per_range).withColumnRenamed(group, "_group")
    block_rows = fanout**levels
    placed = written(
        placed.join(trees, placed[group].eqNullSafe(trees["_group"]))
        .drop("_group")
        .withColumn("block", F.expr(f"place div {block_rows}")),
        "placed",
    )

    def local_levels(n: int) -> int:
        return min(levels, height(n, fanout))

    def block_root(rows: pd.DataFrame) -> pd.DataFrame:
        digests = rows.sort_values("place")["leaf"].to_list()
        n = int(rows["n"].iat[0])
        root = subtree(digests, local_levels(n), fanout)[-1][0]
        return pd.DataFrame({"tree": rows["tree"].iloc[:1], "member": rows["block"].iloc[:1], "members": -(-n // block_rows), "root": root})

    nothing = F.expr("cast(array() as array<string>)")
    blocks = (
        placed.select("tree", "block", "place", "n", "leaf")
        .groupBy("tree", "block")
        .applyInPandas(block_root, "tree bigint, member bigint, members bigint, root string")
    )
    blocks = exchanged(written(blocks.withColumns({"before": nothing, "after": nothing}), "blocks"), fanout)
    tops = blocks.filter("member = 0").select(
        F.lit(0).cast("long").alias("tree"),
        F.col("tree").alias("member"),
        F.lit(trees.count()).cast("long").alias("members"),
        "root",
        nothing.alias("before"),
        nothing.alias("after"),
    )
    tops = exchanged(written(tops, "tops"), fanout).select(
        F.col("member").alias("tree"), F.col("root").alias("top"), F.col("before").alias("top_before"), F.col("after").alias("top_after")
    )
    cards = blocks.join(tops, "tree").select(
        "tree",
        F.col("member").alias("block"),
        F.col("root").alias("subroot"),
        F.col("top").alias("root"),
        F.concat("before", "top_before").alias("before"),
        F.concat("after", "top_after").alias("after"),
    )

    names = [*leaves.columns, "before", "after", "subroot", "root"]

    def proofs(rows: pd.DataFrame, card: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("place", ignore_index=True)
        before, after = paths(rows["leaf"].to_list(), local_levels(int(rows["n"].iat[0])), fanout)
        above, below = list(card["before"].iat[0]), list(card["after"].iat[0])
        rows["before"], rows["after"] = [b + above for b in before], [a + below for a in after]
        rows["subroot"], rows["root"] = card["subroot"].iat[0], card["root"].iat[0]
        return rows[names]

    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in leaves.schema]
    return (
        placed.groupBy("tree", "block")
        .cogroup(cards.groupBy("tree", "block"))
        .applyInPandas(proofs, ", ".join([*kinds, "before array<string>, after array<string>, subroot string, root string"]))
    )


def folded(leaf: Column) -> Column:
    """The root that follows from a leaf and the proof in before, after."""
    return F.aggregate(
        F.arrays_zip("before", "after"), leaf, lambda digest, run: F.sha2(F.concat(run["before"], digest, run["after"]), 256)
    )


def manifest_leaves(docs: DataFrame) -> DataFrame:
    """doc_id, lang, leaf of every row, and tampered: the leaf with 1 added to n_chars.

    tampered is null but for the rows due to be tampered with, where 7 divides crc32(doc_id as text); a
    null doc_id is never due, and a null n_chars stays null.
    """

    def leaf(n_chars: Column) -> Column:
        return digest_of(F.col("doc_id"), F.col("source"), F.col("lang"), n_chars, F.col("text"))

    due = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    return docs.select(
        "doc_id",
        "lang",
        leaf(F.col("n_chars")).alias("leaf"),
        F.when(due, leaf(F.col("n_chars").cast("decimal(20,0)") + 1)).alias("tampered"),
    )


def manifest_query(docs: DataFrame, **options: int) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified for every row of docs.

    Null text, lang or doc_id is a value of its own ('-'); documents of null lang are the first tree, and
    null doc_ids come first in theirs. Columns other than the five are not read.
    """
    rows = manifest(manifest_leaves(docs), "lang", ["doc_id"], **options)
    siblings = F.array_join(F.transform(F.arrays_zip("before", "after"), lambda run: F.concat(run["before"], run["after"])), "")
    return rows.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(siblings, 256).alias("proof_sha256"), folded(F.coalesce("tampered", "leaf")).alias("folded_root")
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


#: crc32 bit by bit, and each level of a tree from the one below.
MANIFEST_SQL = """
WITH RECURSIVE d AS (
  SELECT doc_id, source, lang, n_chars, text,
    list_reduce(
      list_prepend(4294967295::BIGINT, list_transform(range(1, length(doc_id::VARCHAR) + 1), lambda i: ascii(substr(doc_id::VARCHAR, i, 1))::BIGINT)),
      lambda c, b: list_reduce(list_prepend(xor(c, b), list_transform(range(8), lambda j: j::BIGINT)),
        lambda x, j: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END)::BIGINT)) AS crc
  FROM documents
), f AS (
  SELECT doc_id, lang, n_chars, xor(crc, 4294967295) % 7 = 0 AS due,
    coalesce(octet_length(encode(doc_id::VARCHAR)) || ':' || doc_id, '-') || coalesce(octet_length(encode(source)) || ':' || source, '-')
      || coalesce(octet_length(encode(lang)) || ':' || lang, '-') AS head,
    coalesce(octet_length(encode(text)) || ':' || text, '-') AS tail
  FROM d
), l AS (
  SELECT doc_id, lang, sha256(head || coalesce(length(n_chars::VARCHAR) || ':' || n_chars, '-') || tail) AS leaf,
    sha256(head || coalesce(length((n_chars + due::INT)::VARCHAR) || ':' || (n_chars + due::INT), '-') || tail) AS now
  FROM f
), trees AS (
  SELECT lang, count(*) AS n, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree FROM l GROUP BY lang
), p AS (
  SELECT doc_id, tree, n, leaf, now, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place
  FROM l JOIN trees ON l.lang IS NOT DISTINCT FROM trees.lang
), up AS (
  SELECT tree, 0 AS level, place AS idx, n, leaf AS digest FROM p
  UNION ALL
  SELECT tree, level + 1, idx // 2, (n + 1) // 2, sha256(string_agg(digest, '' ORDER BY idx)) FROM up WHERE n > 1 GROUP BY tree, level, idx // 2, n
), subroots AS (
  SELECT tree, level, digest FROM up WHERE n = 1
), top AS (
  SELECT 0 AS level, tree AS idx, (SELECT count(*) FROM trees) AS n, digest FROM subroots
  UNION ALL
  SELECT level + 1, idx // 2, (n + 1) // 2, sha256(string_agg(digest, '' ORDER BY idx)) FROM top WHERE n > 1 GROUP BY level, idx // 2, n
), steps AS (
  SELECT p.doc_id, p.leaf, u.level, CASE WHEN s.digest IS NULL THEN '-' WHEN s.idx < u.idx THEN 'L' || s.digest ELSE 'R' || s.digest END AS step
  FROM p JOIN up u ON u.tree = p.tree AND u.idx = p.place // (1::BIGINT << u.level) AND u.n > 1
  LEFT JOIN up s ON s.tree = u.tree AND s.level = u.level AND s.idx = xor(u.idx, 1)
  UNION ALL
  SELECT p.doc_id, p.leaf, 1000 + u.level, CASE WHEN s.digest IS NULL THEN '-' WHEN s.idx < u.idx THEN 'L' || s.digest ELSE 'R' || s.digest END
  FROM p JOIN top u ON u.idx = p.tree // (1::BIGINT << u.level) AND u.n > 1
  LEFT JOIN top s ON s.level = u.level AND s.idx = xor(u.idx, 1)
), proofs AS (
  SELECT doc_id, leaf, list(step ORDER BY level) AS steps FROM steps GROUP BY doc_id, leaf
), folded AS (
  SELECT p.doc_id, p.leaf, p.tree, coalesce(steps, []) AS steps,
    list_reduce(list_prepend(now, coalesce(steps, [])),
      lambda a, s: sha256(CASE WHEN s[1] = 'L' THEN s[2:] || a WHEN s[1] = 'R' THEN a || s[2:] ELSE a END)) AS folded_root
  FROM p LEFT JOIN proofs q ON q.doc_id IS NOT DISTINCT FROM p.doc_id AND q.leaf = p.leaf
)
SELECT doc_id, leaf, s.digest AS subroot, t.digest AS root,
  sha256(array_to_string(list_transform(list_filter(steps, lambda x: x <> '-'), lambda x: x[2:]), '')) AS proof_sha256,
  folded_root, folded_root = t.digest AS verified
FROM folded JOIN subroots s USING (tree) CROSS JOIN (SELECT digest FROM top WHERE n = 1) t
"""
