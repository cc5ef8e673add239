"""Benchmark decontamination by pigeonhole edit matching.

A test item may stand in a document with up to one edit per EDIT_EVERY characters. If it is cut into
one piece more than it may have edits, at least one piece is there unchanged: all pieces are searched
at once, and around each hit the whole item is verified with Myers' bit-parallel edit distance.

Items go to the tasks in groups of bounded size, one pass over the documents for each group.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fraudlake.llm.common import fresh

EDIT_EVERY = 20
GROUP_CHARS = 1_000_000

_WORDS = re.compile(r"[^\W_]+")


def normal(text: str) -> str:
    """Lower-cased words between single spaces, one before and one after; empty without a word."""
    words = " ".join(_WORDS.findall(text.lower()))
    return f" {words} " if words else ""


def best_distance(item: str, text: str) -> tuple[int, int]:
    """The least edit distance of item to any part of text, and where the first such part ends."""
    size = len(item)
    every, last = (1 << size) - 1, 1 << (size - 1)
    equal: dict[str, int] = {}
    for k, c in enumerate(item):
        equal[c] = equal.get(c, 0) | 1 << k
    plus, minus, score = every, 0, size
    best, end = size, 0
    for k, c in enumerate(text, 1):
        eq = equal.get(c, 0)
        vertical = eq | minus
        across = (((eq & plus) + plus) ^ plus) | eq
        up = minus | ~(across | plus)
        down = plus & across
        if up & last:
            score += 1
        elif down & last:
            score -= 1
        up, down = up << 1, down << 1
        plus = (down | ~(vertical | up)) & every
        minus = up & vertical & every
        if score < best:
            best, end = score, k
    return best, end


@dataclass(frozen=True)
class Match:
    item: int  # its place in the list of items
    distance: int
    end: int  # in the normal form of the text


class Matcher:
    def __init__(self, items: list[str], edit_every: int = EDIT_EVERY):
        self.items = [normal(item) for item in items]
        self.budgets = [len(item) // edit_every for item in self.items]
        places: dict[str, list[tuple[int, int]]] = {}
        for k, (item, budget) in enumerate(zip(self.items, self.budgets, strict=True)):
            cuts = [len(item) * c // (budget + 1) for c in range(budget + 2)]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if a < b:
                    places.setdefault(item[a:b], []).append((k, a))
        self.pieces = ahocorasick.Automaton()
        for piece, where in places.items():
            self.pieces.add_word(piece, (len(piece), where))
        if places:
            self.pieces.make_automaton()

    def matches(self, text: str | None) -> list[Match]:
        """The best match of every item that text contains within its budget."""
        text = normal(text or "")
        if not text or not len(self.pieces):
            return []
        starts: dict[int, list[int]] = {}
        for end, (size, where) in self.pieces.iter(text):
            for item, offset in where:
                starts.setdefault(item, []).append(end + 1 - size - offset)
        out = []
        for item, found in starts.items():
            budget, size, best = self.budgets[item], len(self.items[item]), None
            for first, last in _clusters(sorted(found), 2 * budget):
                low = max(0, first - budget)
                distance, end = best_distance(self.items[item], text[low : last + size + budget])
                if distance <= budget and (best is None or distance < best.distance):
                    best = Match(item, distance, low + end)
            if best:
                out.append(best)
        return sorted(out, key=lambda m: m.item)


def _clusters(starts: list[int], gap: int) -> Iterator[tuple[int, int]]:
    """First and last of runs of starts that are at most gap apart."""
    first = last = starts[0]
    for start in starts[1:]:
        if start - last > gap:
            yield first, last
            first = start
        last = start
    yield first, last


def item_groups(items: DataFrame, group_chars: int = GROUP_CHARS) -> Iterator[pd.DataFrame]:
    """item_id and text of the items, in groups of about group_chars characters; one group at a time
    is on the driver. Items without a letter or digit match nothing."""
    items = items.select("item_id", F.col("text").cast("string")).filter(F.length("text") > 0)
    groups = -(-(items.agg(F.sum(F.length("text"))).first()[0] or 0) // group_chars)
    for k in range(groups):
        yield items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(groups)) == k).toPandas()


def leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, item_id, distance, match_end of every item row that a row of docs contains.

    Null and empty texts contain nothing; other columns of either side are not read.
    """
    kinds = (docs.schema["doc_id"].dataType.simpleString(), items.schema["item_id"].dataType.simpleString())
    schema = "doc_id {}, item_id {}, distance int, match_end int".format(*kinds)
    docs = docs.select("doc_id", F.col("text").cast("string"))
    out = docs.sparkSession.createDataFrame([], schema)
    for group in item_groups(items):
        ids, texts = group["item_id"].tolist(), group["text"].tolist()  # at most about GROUP_CHARS

        def search(batches: Iterator[pd.DataFrame], ids=ids, texts=texts) -> Iterator[pd.DataFrame]:
            matcher = Matcher(texts)
            for batch in batches:
                rows = [
                    (doc_id, ids[m.item], m.distance, m.end)
                    for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True)
                    for m in matcher.matches(text)
                ]
                yield pd.DataFrame(rows, columns=["doc_id", "item_id", "distance", "match_end"])

        out = out.unionByName(docs.mapInPandas(search, schema))
    return out


def clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of docs, all columns, that contain no test item."""
    flag = fresh(docs, "_leaked")
    for group in item_groups(items):
        docs = docs.withColumn(flag, _leaked(group["text"].tolist())(F.col("text").cast("string"))).filter(~F.col(flag)).drop(flag)
    return docs


def _leaked(items: list[str]):
    """Whether a text contains any of the items, as a function of columns."""

    @F.pandas_udf("boolean")
    def leaked(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        matcher = Matcher(items)
        for batch in batches:
            yield pd.Series([bool(matcher.matches(t)) for t in batch], dtype=bool)

    return leaked
