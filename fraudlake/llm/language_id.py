"""Language ID: the family first, then one-versus-one linear SVMs between the languages of that family.

Features are hashed character n-grams (1 to 3) of the whole lower-cased text, letters only. Both
levels use the same machine: a linear SVM for every pair of classes, by votes, ties by margin.
The SVMs are fitted in one task from a sample of at most SAMPLE_ROWS labelled rows, whatever the size
of the corpus; the driver sees only the weights. Features and predictions are made in tasks as well.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fraudlake.llm.common import written

SAMPLE_ROWS = 4000
DIMENSIONS = 4096
UNDETERMINED = "und"

# Families of ISO 639-1 codes. A code not listed is a family of its own.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is fy af lb yi",
    "romance": "fr es pt it ro ca gl oc",
    "slavic": "ru uk be pl cs sk sl hr sr bs mk bg",
    "baltic": "lt lv",
    "uralic": "fi et hu",
    "celtic": "ga gd cy br",
    "indo-aryan": "hi bn mr gu pa ne si ur",
    "iranian": "fa ps ku tg",
    "turkic": "tr az kk ky uz tk tt",
    "semitic": "ar he mt am",
    "dravidian": "ta te kn ml",
    "sinitic": "zh",
    "austronesian": "id ms tl jv mg",
}
FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes.split()}

_NOT_LETTERS = re.compile(r"[\W\d_]+")
_BLOCK = 1 << 20
_ROWS = 256
_MIX = [np.uint64(m) for m in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]


def family(lang: str) -> str:
    return FAMILY_OF.get(lang.lower().split("-")[0], lang)


def letters_of(text: str) -> str:
    """The text's letters with a space for each stretch of anything else, none at the ends."""
    letters = _NOT_LETTERS.sub(" ", text)
    # \w also has numerals that are neither letters nor digits, such as fractions and Roman ones; few texts have any
    if not letters.replace(" ", "").isalpha():
        letters = " ".join("".join(c if c.isalpha() else " " for c in letters).split())
    return letters.strip()


def features(text: str, dimensions: int = DIMENSIONS) -> np.ndarray | None:
    """Roots of hashed n-gram counts, of length 1; None if the text has no letter."""
    letters = letters_of(text.lower())
    if not letters:
        return None
    codes = np.frombuffer(f" {letters} ".encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    shift = np.uint64(64 - (dimensions.bit_length() - 1))
    counts = np.zeros(dimensions)
    with np.errstate(over="ignore"):
        for start in range(0, len(codes), _BLOCK):
            for n in (1, 2, 3):
                part = codes[start : start + _BLOCK + n - 1]
                if len(part) < n:
                    continue
                size = len(part) - n + 1
                mixed = np.full(size, n, dtype=np.uint64)
                for k in range(n):
                    mixed += part[k : k + size] * _MIX[k]
                mixed ^= mixed >> np.uint64(29)
                mixed *= _MIX[0]
                counts += np.bincount((mixed >> shift).astype(np.int64), minlength=dimensions)
    roots = np.sqrt(counts)
    return (roots / np.linalg.norm(roots)).astype(np.float32)


def fit_svm(x: np.ndarray, rows: np.ndarray, y: np.ndarray, cost: float = 10.0, epochs: int = 12) -> np.ndarray:
    """Weights (the last one is the bias) of an L2-regularised squared-hinge SVM between rows of x, by
    dual coordinate descent. y is 1 or -1 for each of rows; x, whose rows have length 1, is not copied."""
    alpha, weights, bias = np.zeros(len(rows)), np.zeros(x.shape[1]), 0.0
    norm, slack = 2.0 + 0.5 / cost, 0.5 / cost  # the bias counts as a component of 1
    order = np.random.default_rng(7)
    for _ in range(epochs):
        for i in order.permutation(len(rows)):
            row = x[rows[i]]
            step = (y[i] * (row @ weights + bias) - 1 + alpha[i] * slack) / norm
            new = max(alpha[i] - step, 0.0)
            if new != alpha[i]:
                change = (new - alpha[i]) * y[i]
                weights += change * row
                bias += change
                alpha[i] = new
    return np.append(weights, bias).astype(np.float32)


@dataclass(frozen=True)
class OneVersusOne:
    classes: list[str]
    pairs: list[tuple[int, int]]
    weights: np.ndarray  # a row for each pair

    @staticmethod
    def fit(x: np.ndarray, rows: np.ndarray, labels: np.ndarray) -> OneVersusOne:
        """Between the labels of these rows of x."""
        classes = sorted(set(labels))
        pairs = list(combinations(range(len(classes)), 2))
        weights = np.zeros((len(pairs), x.shape[1] + 1), dtype=np.float32)
        for row, (a, b) in enumerate(pairs):
            of = (labels == classes[a]) | (labels == classes[b])
            weights[row] = fit_svm(x, rows[of], np.where(labels[of] == classes[a], 1.0, -1.0))
        return OneVersusOne(classes, pairs, weights)

    def predict(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of each row's class, and the mean certainty of its duels (1 if there are none)."""
        n = len(self.classes)
        if n == 1:
            return np.zeros(len(x), dtype=int), np.ones(len(x))
        sure = 1 / (1 + np.exp(-2 * (x @ self.weights[:, :-1].T + self.weights[:, -1])))
        votes, certain = np.zeros((len(x), n)), np.zeros((len(x), n))
        for row, (a, b) in enumerate(self.pairs):
            votes[:, a] += sure[:, row] > 0.5
            votes[:, b] += sure[:, row] <= 0.5
            certain[:, a] += sure[:, row]
            certain[:, b] += 1 - sure[:, row]
        best = (votes + certain / n).argmax(axis=1)
        return best, certain[np.arange(len(x)), best] / (n - 1)


@dataclass(frozen=True)
class Hierarchy:
    families: OneVersusOne
    languages: dict[str, OneVersusOne]

    @staticmethod
    def fit(x: np.ndarray, labels: np.ndarray) -> Hierarchy:
        rows, kin = np.arange(len(x)), np.array([family(lang) for lang in labels], dtype=object)
        within = {f: OneVersusOne.fit(x, rows[kin == f], labels[kin == f]) for f in sorted(set(kin))}
        return Hierarchy(OneVersusOne.fit(x, rows, kin), within)

    def predict(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        first, score = self.families.predict(x)
        langs = np.empty(len(x), dtype=object)
        for k, name in enumerate(self.families.classes):
            rows = np.flatnonzero(first == k)
            if len(rows):
                machine = self.languages[name]
                best, certain = machine.predict(x[rows])
                langs[rows] = [machine.classes[b] for b in best]
                score[rows] *= certain
        return langs, score


def has_letter(text: Column) -> Column:
    """Whether features() finds a letter; false for null."""

    @F.pandas_udf("boolean")
    def found(texts: pd.Series) -> pd.Series:
        return pd.Series([t is not None and bool(letters_of(t)) for t in texts], dtype=bool)

    return found(text)


def held_out() -> Column:
    """crc32 of doc_id as text, modulo 5, is 0; rows without doc_id are held out too."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(True))


def fit(docs: DataFrame, sample_rows: int = SAMPLE_ROWS, dimensions: int = DIMENSIONS) -> Hierarchy | None:
    """The classifier, learned from doc_id, text, lang of rows that are not held out; None if there are none.

    sample_rows bounds the sample: every language gets an equal share of it, in the order of a hash
    of doc_id. A repeated doc_id counts once, with its smallest lang and of that lang's texts the one whose
    features come first as bytes.
    """
    docs = docs.select("doc_id", "text", "lang").filter(~held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull())
    named = docs.groupBy("doc_id").agg(F.min("lang").alias("lang")).select("doc_id", "lang", F.xxhash64("doc_id").alias("_hash"))
    ids = written(named, "labelled")
    counts = written(ids.groupBy("lang").count(), "langs")
    languages = counts.count()
    if not languages:
        return None
    share = max(1, sample_rows // languages)
    # the smallest hashes hold each language's share with a margin, so the window has few rows of any size of corpus
    part = F.least(F.lit(1.0), F.lit(2.0 * share + 100) / F.col("count"))
    low = (F.shiftrightunsigned("_hash", 12) * F.lit(2.0**-52)) <= part
    by_hash = Window.partitionBy("lang").orderBy("_hash", "doc_id")
    chosen = written(
        ids.join(counts, "lang").filter(low).withColumn("_place", F.row_number().over(by_hash)).filter(F.col("_place") <= share).select("doc_id", "lang"),
        "sample",
    )
    places = chosen.count()

    def vectors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for start in range(0, len(batch), _ROWS):
                part = batch.iloc[start : start + _ROWS]
                made = [features(t, dimensions) for t in part["text"]]
                yield pd.DataFrame(
                    {"doc_id": part["doc_id"], "lang": part["lang"], "x": [None if v is None else v.tobytes() for v in made]}
                ).dropna(subset=["x"])

    def trained(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """The model of a stream sorted by lang and doc_id; holds the sample's matrix and one batch."""
        x, labels = np.empty((places, dimensions), dtype=np.float32), []
        for batch in batches:
            for lang, row in zip(batch["lang"], batch["x"], strict=True):
                x[len(labels)] = np.frombuffer(row, dtype=np.float32)
                labels.append(lang)
        if labels:
            yield pd.DataFrame({"model": [pickle.dumps(Hierarchy.fit(x[: len(labels)], np.array(labels, dtype=object)))]})

    kind = docs.schema["doc_id"].dataType.simpleString()
    found = (
        docs.join(F.broadcast(chosen), ["doc_id", "lang"])  # at most sample_rows ids
        .mapInPandas(vectors, f"doc_id {kind}, lang string, x binary")
        .groupBy("doc_id")
        .agg(F.min("lang").alias("lang"), F.min("x").alias("x"))
        .repartition(1)  # at most sample_rows rows
        .sortWithinPartitions("lang", "doc_id")
        .mapInPandas(trained, "model binary")
        .collect()
    )
    return pickle.loads(found[0]["model"]) if found else None


def predict(docs: DataFrame, model: Hierarchy | None, out: str, dimensions: int = DIMENSIONS) -> DataFrame:
    """docs with out, a struct of lang and score, from the text alone.

    A text that is null, empty or without letters, or any text without a model, is undetermined, score 0.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # classes x dimensions, not the corpus

    @F.pandas_udf("lang string, score double")
    def classify(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        machine = shared.value
        for texts in batches:
            langs = np.full(len(texts), UNDETERMINED, dtype=object)
            scores = np.zeros(len(texts))
            for start in range(0, len(texts) if machine else 0, _ROWS):
                made = [None if t is None else features(t, dimensions) for t in texts.iloc[start : start + _ROWS]]
                rows = [k for k, v in enumerate(made) if v is not None]
                if rows:
                    where = start + np.array(rows)
                    langs[where], scores[where] = machine.predict(np.stack([made[k] for k in rows]))
            yield pd.DataFrame({"lang": langs, "score": np.clip(scores, 0, 1)})

    return docs.withColumn(out, classify(F.col("text").cast("string")))


def language_query(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row of docs. Null doc_id: held out."""
    docs = docs.select("doc_id", "text", "lang")
    return predict(docs, fit(docs), "_found").select(
        "doc_id", held_out().alias("held_out"), F.col("_found.lang").alias("lang_pred"), F.col("_found.score").alias("score")
    )
