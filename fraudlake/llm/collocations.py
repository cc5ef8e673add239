"""Collocations from count streams in prefix and suffix order.

1. Counting. Words first, then (by hash) pairs of frequent words, then all phrases whose pairs are frequent.
   A phrase occurs at most as often as any part of it, so what is left out cannot reach the least count.
   Which words or pairs are frequent, tasks learn from a Bloom filter of at most 16 MB; filters and
   hashes may let more through, never less, and the counts of the phrases themselves decide.
2. The counts of frequent phrases are kept as a stream in prefix order (by their words) and one in
   suffix order (by their words from the last to the first). In the one a phrase follows all its
   beginnings, in the other all its ends. So one walk along each, with a stack of the phrases that the
   present one extends, joins every phrase with the counts of its first words (left), or of its
   last words (right), and finds the phrases that occur as often in a phrase one word longer. No
   count is looked up by hash.
3. Streams are cut into ranges of bounded size. A range that starts amid the extensions of a phrase gets
   that phrase's row in addition, at most one for each of its lengths.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fraudlake.llm.common import bounded_batches, whole_text, written
from fraudlake.operators.ranks import in_ranges

LONGEST = 5  # words
LEAST = 100  # occurrences
ABSORBED = 100  # per cent of its occurrences that lie in one longer phrase
TOP = 2000
CHUNK_BYTES = 4 << 20
FILTER_BITS = 1 << 27
ROWS_PER_RANGE = 20_000
TOP_SALTS = 16

# pieces end at the line feed then, words at the space
_MARKS = bytes.maketrans(b".,;:!?\x0b\x0c\r\t", b"\n" * 9 + b" ")
_ODD = np.uint64(0x9E3779B97F4A7C15)


def segments(text: bytes, most: int = CHUNK_BYTES) -> Iterator[bytes]:
    """The marked text, cut between pieces where it is longer than most. A longer piece stays whole."""
    text = text.lower().translate(_MARKS)  # bytes: ASCII only
    start = 0
    while len(text) - start > most:
        end = text.rfind(b"\n", start, start + most)
        if end <= start:
            end = text.find(b"\n", start + most)
        if end < 0:
            break
        yield text[start:end]
        start = end
    yield text[start:]


def chunks(batches: Iterator[pa.RecordBatch], most: int = CHUNK_BYTES) -> Iterator[tuple[str, bytes]]:
    """Language and marked texts, joined up to about most bytes over all languages."""
    held: dict[str, list[bytes]] = {}
    size = 0
    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
            for part in segments(text, most):
                held.setdefault(lang, []).append(part)
                size += len(part)
                if size >= most:
                    yield from ((k, b"\n".join(v)) for k, v in held.items())
                    held, size = {}, 0
    yield from ((k, b"\n".join(v)) for k, v in held.items())


class Ids(dict):
    """Numbers for words as they come."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = len(self)
        return value


def word_ids(chunk: bytes) -> tuple[list[bytes], np.ndarray]:
    """The different words of a chunk, and the number of each word in turn; -1 between pieces."""
    ids = Ids({b"": 0, b"\n": 1})
    tokens = chunk.replace(b"\n", b" \n ").split(b" ")
    each = np.fromiter(map(ids.__getitem__, tokens), dtype=np.int64, count=len(tokens))
    return list(ids)[2:], np.append(each[each > 0], 1) - 2


@dataclass(frozen=True)
class Filter:
    """A Bloom filter with two places for each hash."""

    bits: np.ndarray  # uint64

    @staticmethod
    def places(hashes: np.ndarray, size: int) -> np.ndarray:
        width = np.uint64(size.bit_length() - 1)
        return np.stack([hashes >> (np.uint64(64) - width), (hashes * _ODD) >> (np.uint64(64) - width)])

    def has(self, hashes: np.ndarray) -> np.ndarray:
        found = np.ones(len(hashes), dtype=bool)
        for place in Filter.places(hashes, len(self.bits) * 64):
            found &= (self.bits[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63)) & np.uint64(1)).astype(bool)
        return found


def word_hashes(lang: str, words: list[bytes]) -> np.ndarray:
    seed = xxhash.xxh32_intdigest(lang.encode())
    return np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in words), dtype=np.uint64, count=len(words))


def pair_hashes(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    mixed = (first * _ODD) ^ (second >> np.uint64(7)) ^ second
    mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return mixed ^ (mixed >> np.uint64(29))


def filter_of(hashes: DataFrame, most_bits: int = FILTER_BITS) -> Filter:
    """The filter of hashes (column h), 16 bits for each as far as most_bits goes."""
    size = 1 << 12
    while size < min(most_bits, 16 * hashes.count()):
        size *= 2

    def places(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"place": Filter.places(batch["h"].to_numpy(dtype=np.int64).view(np.uint64), size).ravel().astype(np.int64)})

    cells = (
        hashes.select("h")
        .mapInPandas(places, "place bigint")
        .groupBy(F.shiftright("place", 6).alias("cell"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(place & 63 as int))")).alias("bits"))
        .toPandas()  # at most most_bits / 64 rows
    )
    bits = np.zeros(size // 64, dtype=np.uint64)
    bits[cells["cell"].to_numpy(dtype=np.int64)] = cells["bits"].to_numpy(dtype=np.int64).view(np.uint64)
    return Filter(bits)


def texts_of(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), whole_text().cast("binary").alias("text"))


def _counted(lang: str, phrases: list[bytes], counts: np.ndarray) -> Iterator[pa.RecordBatch]:
    for k in range(0, len(phrases), 100_000):
        part = phrases[k : k + 100_000]
        yield pa.record_batch(
            [pa.array([lang] * len(part), pa.string()), pa.array(part, pa.string()), pa.array(counts[k : k + 100_000], pa.int64())],
            ["lang", "phrase", "n"],
        )


def word_counts(texts: DataFrame, chunk_bytes: int) -> DataFrame:
    """lang, phrase, f of all words of texts (lang, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, chunk in chunks(batches, chunk_bytes):
            words, ids = word_ids(chunk)
            yield from _counted(lang, words, np.bincount(ids[ids >= 0], minlength=len(words)))

    each = texts.mapInArrow(run, "lang string, phrase string, n bigint")
    return each.groupBy("lang", "phrase").agg(F.sum("n").alias("f"))


def frequent_words(words: DataFrame) -> DataFrame:
    """h of words (lang, phrase)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for lang, rows in batch.groupby("lang"):
                yield pd.DataFrame({"h": word_hashes(lang, [p.encode() for p in rows["phrase"]]).view(np.int64)})

    return words.select("lang", "phrase").mapInPandas(run, "h bigint")


def frequent_pairs(texts: DataFrame, allowed: Filter, least: int, chunk_bytes: int) -> DataFrame:
    """h of the pairs of allowed words that may occur least times: pairs of equal hash are counted as one."""
    shared = texts.sparkSession.sparkContext.broadcast(allowed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, chunk in chunks(batches, chunk_bytes):
            words, ids = word_ids(chunk)
            hashes = word_hashes(lang, words)
            good = np.append(shared.value.has(hashes), False)[ids]  # the last one is that of -1
            at = np.flatnonzero(good[:-1] & good[1:])
            code = np.sort(ids[at] * len(words) + ids[at + 1])
            first = np.flatnonzero(np.append(True, code[1:] != code[:-1])) if len(code) else at
            counts, code = np.diff(np.append(first, len(code))), code[first]
            h = pair_hashes(hashes[code // len(words)], hashes[code % len(words)]).view(np.int64)
            for k in range(0, len(h), 500_000):
                yield pa.record_batch([pa.array(h[k : k + 500_000]), pa.array(counts[k : k + 500_000])], ["h", "n"])

    each = texts.mapInArrow(run, "h bigint, n bigint")
    return each.groupBy("h").agg(F.sum("n").alias("n")).filter(F.col("n") >= least).select("h")


def phrase_counts(texts: DataFrame, longest: int, allowed: Filter, chunk_bytes: int) -> DataFrame:
    """lang, phrase, f of the phrases of 2 to longest words all of whose pairs are allowed."""
    shared = texts.sparkSession.sparkContext.broadcast(allowed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, chunk in chunks(batches, chunk_bytes):
            words, ids = word_ids(chunk)
            hashes = np.append(word_hashes(lang, words), np.uint64(0))
            at = np.flatnonzero((ids[:-1] >= 0) & (ids[1:] >= 0))
            at = at[shared.value.has(pair_hashes(hashes[ids[at]], hashes[ids[at + 1]]))]
            pair = np.zeros(len(ids) + longest, dtype=bool)
            pair[at] = True
            first = ids[at]
            for size in range(2, longest + 1):
                goes_on = pair[at + size - 2]
                at, first = at[goes_on], first[goes_on]
                code, first = np.unique(first * len(words) + ids[at + size - 1], return_inverse=True)
                where = np.zeros(len(code), dtype=np.int64)
                where[first] = at
                phrases = [b" ".join([words[i] for i in ids[p : p + size].tolist()]) for p in where.tolist()]
                yield from _counted(lang, phrases, np.bincount(first, minlength=len(code)))

    each = texts.mapInArrow(run, "lang string, phrase string, n bigint")
    return each.groupBy("lang", "phrase").agg(F.sum("n").alias("f"))


def frequent(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, chunk_bytes: int = CHUNK_BYTES) -> tuple[DataFrame, DataFrame]:
    """lang, phrase, f of all phrases of up to longest words that occur least times; and n, all words of each lang."""
    texts = texts_of(docs)
    words = written(word_counts(texts, chunk_bytes), "words")
    totals = written(words.groupBy("lang").agg(F.sum("f").alias("n")), "totals")
    words = words.filter(F.col("f") >= least)
    pairs = written(frequent_pairs(texts, filter_of(frequent_words(words)), least, chunk_bytes), "pairs")
    phrases = phrase_counts(texts, longest, filter_of(pairs), chunk_bytes).filter(F.col("f") >= least)
    return words.unionByName(written(phrases, "phrases")), totals


def along(stream: DataFrame, key: str, counts: str, absorbed: int = ABSORBED, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """stream (lang, f, key: words in the order of the stream, other columns) with counts, whole.

    counts: f of the first 1, 2 ... words of key, without f itself. whole: false if some phrase that is
    one word longer in this order has absorbed per cent of f.
    """
    columns = [f for f in stream.schema if f.name != "whole"]
    names = [f.name for f in columns]
    dealt = in_ranges(stream.select(*names), ["lang", key], rows_per_range)
    heads = dealt.groupBy("_range").agg(F.min(F.struct("lang", key)).alias("_head")).select("_range", "_head.*")
    heads = heads.filter(F.size(key) > 1).select("_range", "lang", F.explode(F.expr(f"transform(sequence(1, size({key}) - 1), k -> slice({key}, 1, k))")).alias(key))
    opened = heads.join(dealt.drop("_range"), ["lang", key]).withColumn("_guest", F.lit(True))
    rows = dealt.withColumn("_guest", F.lit(False)).unionByName(opened)

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        stack: list[list] = []  # the phrases that the present one extends: values, key, f, guest, whole
        out: list[tuple] = []

        def close(depth: int) -> None:
            while len(stack) > depth:
                values, _, _, guest, whole = stack[-1]
                if not guest or not whole:
                    out.append((*values, [s[2] for s in stack[:-1]], whole, guest))
                stack.pop()

        for batch in batches:
            for values in batch[[*names, "_range", "_guest"]].itertuples(index=False, name=None):
                *values, part, guest = values
                words, f = list(values[names.index(key)]), int(values[names.index("f")])
                place = (part, values[names.index("lang")])
                while stack and not (stack[-1][1][0] == place and stack[-1][1][1] == words[: len(stack[-1][1][1])]):
                    close(len(stack) - 1)
                if stack and 100 * f >= absorbed * stack[-1][2]:
                    stack[-1][4] = False
                stack.append([values, (place, words), f, guest, True])
            if len(out) >= 10_000:
                yield pd.DataFrame(out, columns=[*names, counts, "whole", "_guest"])
                out.clear()
        close(0)
        yield pd.DataFrame(out, columns=[*names, counts, "whole", "_guest"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in columns)
    walked = written(
        rows.repartition("_range").sortWithinPartitions("_range", "lang", key).mapInPandas(walk, f"{kinds}, `{counts}` array<bigint>, whole boolean, _guest boolean"),
        "walked",
    )
    absorbed_elsewhere = walked.filter("_guest").select("lang", key, F.lit(False).alias("_whole")).distinct()  # a few for each range
    return (
        walked.filter("NOT _guest")
        .join(absorbed_elsewhere, ["lang", key], "left")
        .withColumn("whole", F.col("whole") & F.coalesce("_whole", F.lit(True)))
        .drop("_guest", "_whole")
    )


def collocations(
    docs: DataFrame,
    *,
    least: int = LEAST,
    longest: int = LONGEST,
    absorbed: int = ABSORBED,
    rows_per_range: int = ROWS_PER_RANGE,
    chunk_bytes: int = CHUNK_BYTES,
) -> DataFrame:
    """lang, phrase, a, l, r, n, score of all phrases of 2 to longest words that occur least times in a lang
    and are not absorbed by a longer one.

    score is the lowest floor(1000 * a * n / (l * r)) of all cuts into first and last words; l and r are of
    that cut. Null lang is ``und``; null, empty or blank texts have no words. Rows that repeat count each.

    A phrase that a longer one absorbs is absorbed by one that is a single word longer, too: what lies
    between them occurs at least as often as the longer one.
    """
    bounded_batches(docs.sparkSession)
    phrases, totals = frequent(docs, least, longest, chunk_bytes)
    stream = phrases.select("lang", F.split("phrase", " ").alias("words"), "f")
    firsts = along(stream, "words", "lefts", absorbed, rows_per_range).withColumnRenamed("whole", "_so_far")
    firsts = firsts.withColumn("back", F.reverse("words"))
    lasts = along(firsts, "back", "rights", absorbed, rows_per_range).filter("whole AND _so_far AND size(words) > 1")
    cut = F.expr(
        """array_min(transform(sequence(1, size(words) - 1), k -> named_struct(
             'score', (1000 * (cast(f AS DECIMAL(19,0)) * cast(n AS DECIMAL(19,0))))
                      div (cast(lefts[k - 1] AS DECIMAL(19,0)) * cast(rights[size(words) - k - 1] AS DECIMAL(19,0))),
             'k', k, 'l', lefts[k - 1], 'r', rights[size(words) - k - 1])))"""
    )
    return (
        lasts.join(totals, "lang")
        .withColumn("_cut", cut)
        .select("lang", F.array_join("words", " ").alias("phrase"), F.col("f").alias("a"), "_cut.l", "_cut.r", "n", F.col("_cut.score").cast("long").alias("score"))
    )


def top(found: DataFrame, most: int = TOP) -> DataFrame:
    """The best most collocations of each lang with their rank, ties by a, then by phrase.

    First among those of one salt, so the last step has most * TOP_SALTS rows of a lang at the most.
    """
    best = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salted = found.withColumn("_salt", F.pmod(F.xxhash64("phrase"), F.lit(TOP_SALTS)))
    few = salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "_salt").orderBy(*best))).filter(F.col("rank") <= most)
    return few.drop("_salt").withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best)).cast("long")).filter(F.col("rank") <= most)


def collocation_query(docs: DataFrame, **options: int) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the first 2000 of each lang."""
    return top(collocations(docs, **options)).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


COLLOCATION_SQL = """
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
    unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents
), lists AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[ \\t]+'), lambda w: w <> '') AS words FROM pieces
), totals AS (
  SELECT lang, sum(len(words)) AS n FROM lists GROUP BY lang
), spans AS (
  SELECT lang, words, m, unnest(range(1, len(words) - m + 2)) AS i FROM lists, unnest([1, 2, 3, 4, 5]) AS sizes(m) WHERE len(words) >= m
), counts AS (
  SELECT lang, words[i : i + m - 1] AS words, count(*) AS f FROM spans GROUP BY ALL HAVING count(*) >= 100
), candidates AS (
  SELECT * FROM counts WHERE len(words) > 1
), cuts AS (
  SELECT c.lang, c.words, c.f AS a, x.f AS l, y.f AS r, k, n::BIGINT AS n, (1000::HUGEINT * c.f * n::BIGINT) // (x.f::HUGEINT * y.f) AS score
  FROM candidates c CROSS JOIN unnest([1, 2, 3, 4]) AS ks(k)
  JOIN counts x ON x.lang = c.lang AND x.words = c.words[1 : k]
  JOIN counts y ON y.lang = c.lang AND y.words = c.words[k + 1 :]
  JOIN totals t ON t.lang = c.lang
  WHERE k < len(c.words)
), lowest AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, words ORDER BY score, k) = 1
), inside AS (
  SELECT DISTINCT lang, f, words[i : j] AS words
  FROM candidates, unnest(range(1, 6)) AS starts(i), unnest(range(1, 6)) AS ends(j)
  WHERE i < j AND j <= len(words) AND j - i + 1 < len(words)
), kept AS (
  SELECT lang, array_to_string(words, ' ') AS phrase, a, l, r, n, score::BIGINT AS score FROM lowest c
  WHERE NOT EXISTS (SELECT 1 FROM inside i WHERE i.lang = c.lang AND i.words = c.words AND i.f >= c.a)
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM kept QUALIFY rank <= 2000
"""
