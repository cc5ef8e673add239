"""Best-fit-decreasing packing of documents into token sequences of fixed capacity.

All pieces of one length are alike to the packing, so it needs only how many there are of each
length: at most `capacity` numbers, however large the corpus. The driver runs best-fit decreasing
on these over a segment tree of remaining capacities; a run of equal pieces that goes into equal
bins is one step. Tasks number the pieces of each length and look up their places. The result is
that of best-fit decreasing over all pieces at once; no task or driver holds the pieces.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fraudlake.llm.common import whole_text, written
from fraudlake.llm.tokens import RANKS, token_ids
from fraudlake.operators.ranks import ranked

CAPACITY = 2048
END_ID = 0
BROADCAST_RUNS = 100_000


def pieces(docs: DataFrame, capacity: int = CAPACITY, ranks_path: str = RANKS, added: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids (little-endian unsigned 32-bit) of every document.

    A document is its text's ids, then END_ID; null text is empty text, so it is END_ID alone.
    added: as in `tokens`. Only documents of more than capacity ids are cut; then the first piece is the shorter one.
    """

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                ids = np.append(token_ids(text, ranks_path, added), np.uint32(END_ID)).astype("<u4")
                first = len(ids) % capacity or capacity
                bounds = [0, *range(first, len(ids) + 1, capacity)]
                rows += [
                    (doc_id, k, a, b - a, ids[a:b].tobytes())
                    for k, (a, b) in enumerate(zip(bounds[:-1], bounds[1:], strict=True))
                ]
                if len(rows) >= 1000:
                    yield pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids"])
                    rows = []
            yield pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", whole_text().alias("text")).mapInPandas(
        cut, f"doc_id {kind}, piece int, start bigint, length bigint, ids binary"
    )


class OpenBins:
    """Numbers of open bins by remaining capacity, under a segment tree that finds the tightest fit."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.any = bytearray(2 * self.leaves)
        self.spans: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]  # (first bin, bins)

    def put(self, remaining: int, first: int, bins: int) -> None:
        if bins:
            self.spans[remaining].append((first, bins))
            node = self.leaves + remaining
            while node and not self.any[node]:
                self.any[node] = 1
                node >>= 1

    def take(self, remaining: int) -> tuple[int, int]:
        span = self.spans[remaining].pop()
        node = self.leaves + remaining
        if not self.spans[remaining]:
            self.any[node] = 0
            while node > 1:
                node >>= 1
                self.any[node] = self.any[2 * node] | self.any[2 * node + 1]
        return span

    def tightest(self, length: int) -> int | None:
        """The smallest remaining capacity of at least length that an open bin has."""
        node = self.leaves + length
        if node >= 2 * self.leaves:
            return None
        while not self.any[node]:
            while node & 1:  # a right child, up to where something lies to the right
                node >>= 1
                if node <= 1:
                    return None
            node += 1
        while node < self.leaves:
            node = 2 * node if self.any[2 * node] else 2 * node + 1
        return node - self.leaves


def best_fit_runs(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Steps (length, first_rank, items, first_bin, per_bin, offset) of best-fit decreasing.

    Items first_rank, first_rank + 1, ... of this length go per_bin at a time into bins first_bin,
    first_bin + 1, ... from offset on. The number of steps depends on the capacity, not on the counts:
    each length adds at most two spans of bins that differ.
    """
    bins, runs, next_bin = OpenBins(capacity), [], 0
    for length in sorted((n for n, c in counts.items() if c), reverse=True):
        left, rank = counts[length], 0
        while left:
            remaining = bins.tightest(length)
            if remaining is None:
                new = -(-left // (capacity // length))
                bins.put(capacity, next_bin, new)
                next_bin += new
                continue
            first, spans = bins.take(remaining)
            # a bin that took an item is the tightest still, as long as another one fits
            per = min(remaining // length, left)
            used = min(spans, left // per)
            runs.append((length, rank, used * per, first, per, capacity - remaining))
            bins.put(remaining, first + used, spans - used)
            if remaining > per * length:
                bins.put(remaining - per * length, first, used)
            left -= used * per
            rank += used * per
    return runs


def pack(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """cut (doc_id, piece, length and more; a written table) with sequence_id and offset.

    Pieces are numbered in ranges of bounded size, also where most rows are equal (no doc_id, no text).
    """
    counts = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}  # at most capacity rows
    runs = best_fit_runs(counts, capacity)
    plan = cut.sparkSession.createDataFrame(
        runs, "_length long, _rank long, _items long, _bin long, _per long, _offset long"
    )
    if len(runs) <= BROADCAST_RUNS:
        plan = F.broadcast(plan)
    order = [c for c in ("doc_id", "piece", "start", "ids_crc32") if c in cut.columns]
    placed = ranked(cut, ["length"], order, "_number")
    past = F.col("_number") - F.col("_rank")
    return (
        placed.join(plan, (F.col("length") == F.col("_length")) & (past >= 0) & (past < F.col("_items")))
        .withColumn("sequence_id", F.col("_bin") + F.floor(past / F.col("_per")))
        .withColumn("offset", F.col("_offset") + past % F.col("_per") * F.col("length"))
        .drop("_number", "_length", "_rank", "_items", "_bin", "_per", "_offset")
    )


def place(docs: DataFrame, capacity: int = CAPACITY, ranks_path: str = RANKS, added: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece of docs.

    Every row of docs is packed, repeated rows as often as they stand there; other columns are not read.
    """
    cut = pieces(docs, capacity, ranks_path, added).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return pack(written(cut, "pieces"), capacity)


def sequences(docs: DataFrame, placed: DataFrame, capacity: int = CAPACITY, ranks_path: str = RANKS, added: bool = False) -> DataFrame:
    """sequence_id and ids (array) of every packed sequence, at most capacity ids in each.

    doc_id must tell the rows of docs apart here.
    """
    cut = pieces(docs, capacity, ranks_path, added).select("doc_id", "piece", "ids")
    return (
        placed.select("doc_id", "piece", "sequence_id", "offset")
        .join(cut, ["doc_id", "piece"])
        .groupBy("sequence_id")
        .agg(F.array_sort(F.collect_list(F.struct("offset", F.hex("ids").alias("ids")))).alias("_parts"))
        .select("sequence_id", F.unhex(F.concat_ws("", F.col("_parts.ids"))).alias("ids"))
    )
