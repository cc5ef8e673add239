"""Exact top-k inner products over a pivot-distance index.

Vectors get one more coordinate that gives all of them the same length; then the largest inner
product is the smallest distance. Each vector is keyed by its nearest pivot and its distance from
it; keys are cut into annuli and annuli into blocks of bounded size. By the triangle inequality a
vector of an annulus is at least as far from a query as the query's own distance from the pivot lies
outside the annulus. A block of queries meets the blocks that may hold a better neighbour than those
already known, in the order of that bound, and stops where it falls below the k-th score.

Vectors are integers, so all scores are exact.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fraudlake.llm.common import table, written

TOP = 20
SCALE = 64
PIVOTS = 64
BLOCK_ROWS = 512
QUERY_ROWS = 256
STREAM_BLOCKS = 64
RINGS = 32


@dataclass(frozen=True)
class Space:
    """What all vectors share: dimensions, the largest squared length, and the pivots."""

    dims: int
    longest: float
    pivots: np.ndarray
    kind: str  # how components are stored
    exact: bool  # float64 products are exact

    def matrix(self, rows) -> np.ndarray:
        flat = np.frombuffer(b"".join(rows), dtype=self.kind).reshape(-1, self.dims)
        return flat.astype(np.float64 if self.exact else np.int64)

    def distances(self, x: np.ndarray, lengths: np.ndarray, queries: bool = False) -> np.ndarray:
        """Distance of each row from each pivot in the lengthened space; a query's further coordinate is 0."""
        x = x.astype(np.float64)
        own = (self.pivots**2).sum(axis=1)
        higher = np.sqrt(np.maximum(self.longest - own, 0))
        mine = np.zeros(len(x)) if queries else np.sqrt(np.maximum(self.longest - lengths, 0))
        squared = lengths[:, None] + own - 2 * x @ self.pivots.T + (mine[:, None] - higher) ** 2
        return np.sqrt(np.maximum(squared, 0))

    def bound(self, lengths: np.ndarray, near: np.ndarray, low: float, high: float) -> np.ndarray:
        """No vector of an annulus low..high scores more with queries at distances near from its pivot."""
        apart = np.maximum(0, np.maximum(near - high, low - near)) * (1 - 1e-9) - 1e-6
        return (lengths + self.longest - np.maximum(apart, 0) ** 2) / 2 + 1e-3 + 1e-6 * self.longest


def integer_vectors(rows: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id, v (array of floor(scale * x)) of rows that take part: vec_id and all components there and finite."""
    whole = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & whole).select(
        "vec_id", F.transform("embedding", lambda x: F.floor(x.cast("double") * scale)).alias("v")
    )


def space_of(vectors: DataFrame, divisor: int, pivots: int = PIVOTS) -> Space | None:
    """Pivots are the distinct vectors among the first by a hash of vec_id; None without vectors.

    Scores are 64-bit integers. Vectors so long that a score might not fit (the
    longest query times the longest vector) are an error, never another score.
    """
    length = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x)
    top = F.aggregate("v", F.lit(0.0), lambda s, x: F.greatest(s, F.abs(x.cast("double"))))
    asked = F.coalesce(F.max(F.when(F.col("vec_id") % divisor == 0, length)), F.lit(0.0))
    dims, longest, most, asks = vectors.agg(F.max(F.size("v")), F.max(length), F.max(top), asked).first()
    if not dims:
        return None
    if most >= 2.0**62 or (asks * longest) ** 0.5 >= 2.0**62:
        raise ValueError(f"vectors of lengths up to {longest**0.5:.4g}, queries up to {asks**0.5:.4g}: scores would not fit 64 bits")
    chosen = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(4 * pivots).collect()
    rows = dict.fromkeys(tuple(r["v"]) for r in chosen)
    matrix = np.array([list(r) + [0] * (dims - len(r)) for r in list(rows)[:pivots]], dtype=np.float64)
    return Space(dims, float(longest), matrix, "<i2" if most < 2**15 else "<i8", dims * float(most) ** 2 < 2**53)


def _keyed(vectors: DataFrame, space: Space, divisor: int) -> DataFrame:
    """vec_id, v (bytes, zeros to the full dimension), pivot, distance, asks of every vector."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            rows = np.zeros((len(batch), space.dims), dtype=space.kind)
            for k, v in enumerate(batch["v"]):
                rows[k, : len(v)] = v
            wide = rows.astype(np.float64)
            near = space.distances(wide, (wide**2).sum(axis=1))
            pivot = near.argmin(axis=1)
            yield pd.DataFrame(
                {
                    "vec_id": batch["vec_id"],
                    "v": [r.tobytes() for r in rows],
                    "pivot": pivot.astype(np.int32),
                    "distance": near[np.arange(len(rows)), pivot],
                }
            )

    keyed = vectors.mapInPandas(run, "vec_id bigint, v binary, pivot int, distance double")
    return keyed.withColumn("asks", F.col("vec_id") % divisor == 0)


def _blocks(keyed: DataFrame, space: Space, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """block, pivot, low, high, size, ids, vs: annuli of each pivot, cut by hash to about block_rows rows."""
    width = (space.longest**0.5 * 2 or 1.0) / RINGS
    ringed = keyed.withColumn("ring", F.floor(F.col("distance") / width).cast("int"))
    cuts = ringed.groupBy("pivot", "ring").agg(F.ceil(F.count(F.lit(1)) / block_rows).cast("int").alias("_cuts"))  # pivots x rings rows
    return (
        ringed.join(F.broadcast(cuts), ["pivot", "ring"])
        .withColumn("_cut", F.pmod(F.xxhash64("vec_id", "v"), F.col("_cuts")))
        .groupBy("pivot", "ring", "_cut")
        .agg(
            F.min("distance").alias("low"),
            F.max("distance").alias("high"),
            F.count(F.lit(1)).alias("size"),
            F.collect_list("vec_id").alias("ids"),
            F.collect_list("v").alias("vs"),
        )
        .withColumn("block", F.xxhash64("pivot", "ring", "_cut"))
        .drop("ring", "_cut")
    )


def _best(ids: np.ndarray, scores: np.ndarray, top: int) -> np.ndarray:
    """Places of the top scores, ties to the smaller id."""
    if len(scores) > top:
        least = np.partition(scores, len(scores) - top)[len(scores) - top]
        rows = np.flatnonzero(scores >= least)
    else:
        rows = np.arange(len(scores))
    return rows[np.lexsort((ids[rows], -scores[rows]))][:top]


class Running:
    """The best so far of a block of queries."""

    def __init__(self, space: Space, ids, vs, known, top: int):
        self.space, self.top = space, top
        self.ids = np.array(ids, dtype=np.int64)
        self.x = space.matrix(vs)
        wide = self.x.astype(np.float64)
        self.lengths = (wide**2).sum(axis=1)
        self.near = space.distances(wide, self.lengths, queries=True)
        self.least = np.array([-np.inf if k is None or k != k else float(k) for k in known])
        self.found = [(np.empty(0, np.int64), np.empty(0, np.int64)) for _ in self.ids]

    def bounds(self, pivot: int, low: float, high: float) -> np.ndarray:
        return self.space.bound(self.lengths, self.near[:, pivot], low, high)

    def meet(self, pivot: int, low: float, high: float, ids, vs) -> None:
        asks = np.flatnonzero(self.bounds(pivot, low, high) >= self.least)
        if not len(asks):
            return
        ids = np.array(ids, dtype=np.int64)
        scores = (self.x[asks] @ self.space.matrix(vs).T).astype(np.int64)
        for row, q in enumerate(asks):
            ok = np.flatnonzero((scores[row] >= self.least[q]) & (ids != self.ids[q]))
            if not len(ok):
                continue
            all_ids = np.concatenate([self.found[q][0], ids[ok]])
            all_scores = np.concatenate([self.found[q][1], scores[row][ok]])
            best = _best(all_ids, all_scores, self.top)
            self.found[q] = all_ids[best], all_scores[best]
            if len(best) == self.top:
                self.least[q] = max(self.least[q], float(all_scores[best[-1]]))

    def rows(self) -> pd.DataFrame:
        sizes = [len(i) for i, _ in self.found]
        return pd.DataFrame(
            {
                "query_id": np.repeat(self.ids, sizes),
                "vec_id": np.concatenate([i for i, _ in self.found]),
                "score": np.concatenate([s for _, s in self.found]),
            }
        )


_SCORES = "query_id bigint, vec_id bigint, score bigint"


def _first_scores(queries: DataFrame, blocks: DataFrame, space: Space, top: int) -> DataFrame:
    """vec_id, known: the top-th score in the block of the own pivot that is nearest by its annulus
    among those large enough; null if there is none. A first bound for all others."""
    apart = F.greatest(F.lit(0.0), F.col("distance") - F.col("high"), F.col("low") - F.col("distance"))
    home = (
        queries.join(blocks.filter(F.col("size") > top).select("pivot", "block", "low", "high"), "pivot")
        .groupBy("vec_id")
        .agg(F.first("v").alias("v"), F.min_by("block", F.struct(apart, "block")).alias("block"))
    )
    asked = home.join(blocks.select("block", "ids", "vs"), "block")

    @F.pandas_udf("bigint")
    def last_score(query: pd.Series, v: pd.Series, ids: pd.Series, vs: pd.Series) -> pd.Series:
        out = []
        for q, x, i, m in zip(query, v, ids, vs, strict=True):
            scores = (space.matrix(m) @ space.matrix([x])[0])[np.asarray(i) != q]
            out.append(int(np.sort(scores)[-top]) if len(scores) >= top else None)
        return pd.Series(out, dtype="Int64")

    return asked.select("vec_id", last_score("vec_id", "v", "ids", "vs").alias("known"))


def top_scores(rows: DataFrame, divisor: int = 20, top: int = TOP, scale: int = SCALE) -> DataFrame:
    """query_id, rank, vec_id, score: for each vec_id that divisor divides, its top other rows by inner product.

    Shorter vectors count as filled up with zeros. A vec_id that is repeated asks once, with the vector
    that comes first by its bytes; none of its own rows is a candidate, all of them are for others. An empty table gives no rows.
    """
    vectors = integer_vectors(rows.select("vec_id", "embedding"), scale)
    space = space_of(vectors, divisor)
    if space is None:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    keyed = written(_keyed(vectors, space, divisor), "keyed")
    blocks = written(_blocks(keyed, space), "blocks")
    queries = keyed.filter("asks").groupBy("vec_id").agg(F.min(F.struct("v", "pivot", "distance")).alias("_q")).select("vec_id", "_q.*")
    known = _first_scores(queries, blocks, space, top)
    parts = -(-queries.count() // QUERY_ROWS) or 1
    asked = queries.join(known, "vec_id", "left")
    asking = written(
        asked.groupBy(F.pmod(F.xxhash64("vec_id", "v"), F.lit(parts)).cast("int").alias("part")).agg(
            F.collect_list("vec_id").alias("ids"),
            F.collect_list("v").alias("vs"),
            F.collect_list(F.coalesce(F.col("known").cast("double"), F.lit(float("nan")))).alias("known"),
        ),
        "asking",
    )

    streams = -(-blocks.count() // STREAM_BLOCKS) or 1
    return _merged(_met(asking, blocks, space, streams, top), top)


def _met(asking: DataFrame, blocks: DataFrame, space: Space, streams: int, top: int) -> DataFrame:
    """Every block of queries before the blocks it needs, in streams of about STREAM_BLOCKS blocks each.

    Which blocks are needed is decided on annuli alone; vectors travel only where they are.
    """
    stream = F.pmod(F.xxhash64("block"), F.lit(streams)).cast("int")
    edges = blocks.select(stream.alias("stream"), F.struct("block", "pivot", "low", "high").alias("edge"))
    annuli = edges.groupBy("stream").agg(F.collect_list("edge").alias("edges"))  # about STREAM_BLOCKS in each

    def needs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for part, stream, ids, vs, known, edges in batch[["part", "stream", "ids", "vs", "known", "edges"]].itertuples(index=False):
                run, found = Running(space, ids, vs, known, top), []
                for e in edges:
                    over = float((run.bounds(e["pivot"], e["low"], e["high"]) - run.least).max())
                    if over >= 0:
                        found.append((part, stream, e["block"], -run.bounds(e["pivot"], e["low"], e["high"]).max()))
                if found:
                    yield pd.DataFrame(found, columns=["part", "stream", "block", "place"])

    # the stated queries against all rows, block by block: parts x streams rows
    meetings = asking.crossJoin(annuli).mapInPandas(
        needs, "part int, stream int, block bigint, place double"
    )
    meetings = written(meetings, "meetings")
    kept = "part", "stream", "place", "ids", "vs", "known", "pivot", "low", "high"
    none = F.lit(None)
    heads = asking.join(meetings.select("part", "stream").distinct(), "part").select(
        "part", "stream", F.lit(-float("inf")).alias("place"), "ids", "vs", "known",
        none.cast("int").alias("pivot"), none.cast("double").alias("low"), none.cast("double").alias("high"),
    )
    bodies = meetings.join(blocks.drop("size"), "block").withColumn("known", none.cast("array<double>")).select(*kept)
    both = heads.unionByName(bodies).repartition("part", "stream").sortWithinPartitions("part", "stream", "place")

    def expand(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        run = None
        for batch in batches:
            for row in batch.itertuples(index=False):
                if row.known is not None:
                    if run:
                        yield run.rows()
                    run = Running(space, row.ids, row.vs, row.known, top)
                else:
                    run.meet(int(row.pivot), row.low, row.high, row.ids, row.vs)
        if run:
            yield run.rows()

    return both.mapInPandas(expand, _SCORES)


def _merged(scores: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        scores.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= top)
        .select("query_id", "rank", "vec_id", "score")
    )


def search_query(spark, sf_dir: str) -> DataFrame:
    return top_scores(table(spark, sf_dir, "embeddings"))


SEARCH_SQL = """
WITH vectors AS (
    SELECT vec_id, [floor(64 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
    FROM vectors q JOIN vectors c ON q.vec_id <> c.vec_id
    WHERE q.vec_id % 20 = 0
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM scored QUALIFY rank <= 20
"""
