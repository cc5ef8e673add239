"""Quality by compression: how much smaller a text gets with a dictionary of good text than with one of bad text.

Two zstandard dictionaries are built from labelled text, one of each class. A text is cut into chunks, so
that the dictionary matters all along and not only where the text has nothing of its own to refer to yet;
every chunk is compressed with either dictionary. The difference of the sizes over their sum is turned
into a probability by logistic regression, fitted on labelled rows that are in neither dictionary.

Dictionaries and regression are made in one task from a sample of at most SAMPLE_ROWS labelled rows;
the driver gets the model, two dictionaries of DICTIONARY_BYTES at the most and a few numbers.
"""

from __future__ import annotations

import pickle
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fraudlake.llm.common import written

SAMPLE_ROWS = 6000
CHUNK_BYTES = 2048
CHUNKS_PER_ROW = 16  # of a sampled row; a text to be scored counts whole
DICTIONARY_BYTES = 65_536
LEVEL = 3
THRESHOLD = 0.7


def chunked(text: str) -> list[bytes]:
    data = text.encode("utf-8", "surrogatepass")
    return [data[k : k + CHUNK_BYTES] for k in range(0, len(data), CHUNK_BYTES)]


def dictionary(chunks: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A trained dictionary; the chunks themselves where they are too few to train one."""
    try:
        return zstandard.train_dictionary(size, chunks).as_bytes()
    except zstandard.ZstdError:
        return b"".join(chunks)[-size:]


def compressor(content: bytes) -> zstandard.ZstdCompressor:
    made = zstandard.ZstdCompressionDict(content)
    made.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=made, write_content_size=False, write_checksum=False, write_dict_id=False)


def size_difference(chunks: list[bytes], good: zstandard.ZstdCompressor, bad: zstandard.ZstdCompressor) -> float:
    """Between -1 and 1, above 0 if the chunks are smaller with the good dictionary; 0 without chunks."""
    with_good, with_bad = (sum(len(c.compress(x)) for x in chunks) for c in (good, bad))
    return (with_bad - with_good) / max(with_bad + with_good, 1)


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3) -> tuple[float, float]:
    """Slope and intercept of the likeliest logistic curve, by Newton's method."""
    scale = max(float(np.abs(x).max(initial=0.0)), 1e-9)
    data, weights = np.stack([x / scale, np.ones(len(x))], axis=1), np.zeros(2)
    penalty = np.diag([ridge, ridge])

    def loss(w: np.ndarray) -> float:
        return float(np.logaddexp(0, -(2 * y - 1) * (data @ w)).sum() + w @ penalty @ w / 2)

    for _ in range(50):
        p = 1 / (1 + np.exp(-(data @ weights)))
        step = np.linalg.solve((data * (p * (1 - p))[:, None]).T @ data + penalty, data.T @ (y - p) - penalty @ weights)
        share = 1.0
        while share > 1e-6 and loss(weights + share * step) > loss(weights):
            share /= 2
        weights = weights + share * step
        if np.abs(share * step).max() < 1e-8:
            break
    return float(weights[0] / scale), float(weights[1])


@dataclass(frozen=True)
class Model:
    """Without dictionaries (one class has no text) every text gets base, the share of good rows."""

    base: float
    good: bytes | None = None
    bad: bytes | None = None
    slope: float = 0.0
    intercept: float = 0.0

    @staticmethod
    def fit(rows: pd.DataFrame) -> Model:
        """From quality and chunks of rows; every second row is for the dictionaries, the others for the curve."""
        good = rows["quality"].to_numpy() == 1
        base = (good.sum() + 1) / (len(rows) + 2)
        for_words = np.arange(len(rows)) % 2 == 0
        if not all(((good == kind) & part).any() for kind in (True, False) for part in (for_words, ~for_words)):
            for_words = np.ones(len(rows), dtype=bool)  # too few of a class to part them
        both = [dictionary([c for chunks in rows["chunks"][for_words & (good == kind)] for c in chunks]) for kind in (True, False)]
        if not all(both):
            return Model(base)
        curve = ~for_words if not for_words.all() else for_words
        machines = [compressor(d) for d in both]
        x = np.array([size_difference(list(c), *machines) for c in rows["chunks"][curve]])
        return Model(base, *both, *logistic(x, good[curve].astype(float)))


def held_out() -> Column:
    """crc32 of doc_id as text, modulo 4, is 2; rows without doc_id are held out too."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(True))


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model | None:
    """The model, from text and quality of rows that are not held out; None if there are none.

    A doc_id that is labelled both 0 and 1 teaches nothing, nor does any other quality. The sample is the
    sample_rows rows of the smallest hash of doc_id and text; rows equal in both count once.
    """
    known = (
        labels.select("doc_id", F.col("quality").cast("int").alias("quality"))
        .filter("doc_id IS NOT NULL AND quality IN (0, 1)")
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"), F.max("quality").alias("_most"))
        .filter("quality = _most")
        .drop("_most")
    )
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text")).filter(~held_out() & (F.length("text") > 0))
    texts = texts.withColumn("key", F.xxhash64("doc_id", "text"))
    keys = written(texts.select("doc_id", "key").join(known, "doc_id").groupBy("key").agg(F.first("quality").alias("quality")), "labelled")
    rows = keys.count()
    if not rows:
        return None
    likely = F.pmod(F.xxhash64("key", F.lit(13)), F.lit(1 << 31)) <= int((1 << 31) * min(1.0, (1.2 * sample_rows + 100) / rows))
    chosen = written(keys.filter(likely).orderBy(F.xxhash64("key", F.lit(13)), "key").limit(sample_rows), "sample")

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            chunks = [sorted(chunked(t), key=zlib.crc32)[:CHUNKS_PER_ROW] for t in batch["text"]]
            yield pd.DataFrame({"key": batch["key"], "quality": batch["quality"], "chunks": chunks})

    def trained(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sample = pd.concat([b for b in batches if len(b)], ignore_index=True)
        sample = sample.sort_values("key", ignore_index=True)
        yield pd.DataFrame({"model": [pickle.dumps(Model.fit(sample))]})

    found = (
        texts.join(F.broadcast(chosen), "key")  # at most sample_rows keys
        .select("key", "quality", "text")
        .mapInPandas(cut, "key bigint, quality int, chunks array<binary>")
        .dropDuplicates(["key"])
        .repartition(1)  # at most sample_rows rows of CHUNKS_PER_ROW chunks
        .mapInPandas(trained, "model binary")
        .first()
    )
    return pickle.loads(found["model"])


def quality_score(text: Column, model: Model | None, docs: DataFrame) -> Column:
    """The probability that whole texts are good; without a model 0.5, for an empty or null text the share of good rows."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known = shared.value
        machines = [compressor(d) for d in (known.good, known.bad)] if known and known.good and known.bad else None
        for texts in batches:
            out = np.full(len(texts), known.base if known else 0.5)
            for k, text in enumerate(texts if machines else ()):
                if text:
                    x = known.slope * size_difference(chunked(text), *machines) + known.intercept
                    out[k] = 1 / (1 + np.exp(-np.clip(x, -500, 500)))
            yield pd.Series(out)

    return score(text.cast("string"))


def quality_query(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of docs, from its text alone. Null doc_id: held out.

    Repeated rows are scored each; other columns are not read.
    """
    docs = docs.select("doc_id", "text")
    model = fit(docs, labels, sample_rows)
    return docs.select("doc_id", held_out().alias("held_out"), quality_score(F.col("text"), model, docs).alias("score")).withColumn(
        "predicted", (F.col("score") >= THRESHOLD).cast("int")
    )
