"""Byte-balanced shards of indivisible groups by Karmarkar-Karp differencing.

Differencing takes the two partial partitions with the largest spread and joins them in opposite
order. It runs over groups of equal texts in three steps, each in tasks of bounded size:

1. Groups heavier than total / (shards * BUCKET_ROWS), fewer than shards * BUCKET_ROWS of them, are
   differenced in one task.
2. The others are dealt by bit length of their weight and by hash into buckets of about BUCKET_ROWS.
   Each is differenced with one node more, its share (by weight) of what the heavy groups put into
   each shard, so that it fills the gaps that these leave.
3. Up to about shards * BUCKET_ROWS light groups, as many of each bit length, are kept back and
   differenced last, with the shards' sums as they then are. They even out what the buckets left.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fraudlake.llm.common import written
from fraudlake.operators.ranks import ranked

SHARDS = 8
BUCKET_ROWS = 4096
LAW = "bytes"


def differenced(nodes: list[list[int]]) -> list[list[int]]:
    """For each node (a weight for each of its parts) the subset its parts go to, a number for each part.

    Subsets are numbered by falling weight, so subset 0 of the result is the heaviest.
    """
    heap = []
    for k, weights in enumerate(nodes):
        order = sorted(range(len(weights)), key=lambda p: (-weights[p], p))
        sums = [weights[p] for p in order]
        heap.append((sums[-1] - sums[0], k, sums, [("part", k, p) for p in order]))
    heapq.heapify(heap)
    serial = len(nodes)
    while len(heap) > 1:
        _, _, sums, held = heapq.heappop(heap)
        _, _, more, other = heapq.heappop(heap)
        joined = sorted(
            ((a + b, ("both", x, y)) for a, b, x, y in zip(sums, reversed(more), held, reversed(other), strict=True)),
            key=lambda s: -s[0],
        )
        sums = [s for s, _ in joined]
        heapq.heappush(heap, (sums[-1] - sums[0], serial, sums, [t for _, t in joined]))
        serial += 1
    out = [[0] * len(weights) for weights in nodes]
    for subset, tree in enumerate(heap[0][3] if heap else []):
        stack = [tree]
        while stack:
            kind, x, y = stack.pop()
            if kind == "part":
                out[x][y] = subset
            else:
                stack += [x, y]
    return out


def _filled(start: Callable[[int], list[int]]) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """Differences the groups of a bucket with one node more: what lies in each shard already, start(bucket's weight)."""

    def bucket(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("group", ignore_index=True)
        weights = [int(w) for w in rows["weight"]]
        there = start(sum(weights))
        turn = int(rows["bucket"].iat[0]) % len(there)  # ties between shards fall differently in each bucket
        *to, shard_of = differenced([[w, *[0] * (len(there) - 1)] for w in weights] + [there[turn:] + there[:turn]])
        shard_at = {subset: (p + turn) % len(there) for p, subset in enumerate(shard_of)}
        rows["shard"] = [shard_at[subsets[0]] for subsets in to]
        return rows[["group", "weight", "shard"]]

    return bucket


def shards_of(groups: DataFrame, shards: int = SHARDS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """group, shard for groups (group: binary and distinct, weight; a written table)."""
    most = shards * bucket_rows
    total = groups.agg(F.sum("weight")).first()[0] or 0
    is_heavy = F.col("weight") > total // most  # fewer than most groups can be

    def placed(rows: DataFrame, keys: list[str], start: Callable[[int], list[int]]) -> tuple[DataFrame, list[int]]:
        found = rows.groupBy(*keys).applyInPandas(_filled(start), "group binary, weight bigint, shard int")
        found = written(found, "dealt")
        sums = {r["shard"]: r["weight"] for r in found.groupBy("shard").agg(F.sum("weight").alias("weight")).collect()}
        return found.select("group", "shard"), [sums.get(k, 0) for k in range(shards)]

    heavy, heavy_sums = placed(
        groups.filter(is_heavy).select("group", "weight", F.lit(0).alias("bucket")), ["bucket"], lambda _: [0] * shards
    )
    light = groups.filter(~is_heavy).withColumn("class", F.length(F.bin("weight")))
    counts = {r["class"]: r["count"] for r in light.groupBy("class").count().collect()}  # at most 64 rows
    if not counts:
        return heavy
    last = max(most // len(counts), 1)  # groups of each class that the last task has

    def by_class(rows: int) -> Column:
        parts = F.create_map(*(F.lit(x) for c, n in counts.items() for x in (c, -(-n // rows))))
        return parts[F.col("class")]

    light = light.select(
        "group",
        "weight",
        "class",
        F.pmod(F.xxhash64("group"), by_class(bucket_rows)).alias("bucket"),
        (F.pmod(F.xxhash64("group", F.lit("last")), by_class(last)) == 0).alias("last"),
    )
    light_weight = total - sum(heavy_sums)
    middle, sums = placed(
        light.filter("NOT last"), ["class", "bucket"], lambda weight: [h * weight // light_weight for h in heavy_sums]
    )
    sums = [h + s for h, s in zip(heavy_sums, sums, strict=True)]
    rest, _ = placed(light.filter("last").select("group", "weight", F.lit(0).alias("bucket")), ["bucket"], lambda _: sums)
    return heavy.unionByName(middle).unionByName(rest)


def shard(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot of every row of docs; equal texts share a shard.

    Null text has no bytes, as has an empty one; they are one group. Slots run from 0 in each shard.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = written(
        docs.select(
            "doc_id",
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.unhex(F.sha2(text, 256)).alias("group"),
        ),
        "sized",
    )
    groups = written(rows.groupBy("group").agg(F.sum("size").alias("weight")), "groups")
    placed = rows.join(shards_of(groups, shards), "group").drop("group")
    return ranked(placed, ["shard"], ["doc_id", "size", "text_crc32"], "slot")


def sharding_query(docs: DataFrame) -> DataFrame:
    return shard(docs).select(
        "doc_id", "size", "text_crc32", F.lit(LAW).alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
