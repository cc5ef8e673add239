"""Near duplicates by one-permutation MinHash with optimal densification, banded buckets and stars.

1. One hash per shingle; the hash's upper bits name one of 1024 bins, each bin keeps its smallest
   hash. An empty bin borrows from the first filled bin of its own random probing order (optimal
   densification). The first 256 bins make 64 bands of four, the bucket keys: at a similarity of
   0.75 two documents share none of them with a probability of about 3e-11. All bins, four bits of
   each, make a sketch that estimates similarity.
2. Documents with equal shingle sets are one class, known by a 64-bit hash of the set, so that a
   doc_id may stand for several texts. Doc_ids come back in only as the components' labels.
3. In each bucket a star joins the smallest member with all others. Of its stars each member keeps the one whose
   centre it shares most buckets with, so there is one candidate per member. Stars are confirmed on the full
   sets and give components.
4. A bucket whose members are still in several components has pairs that no star compared. They are compared
   in blocks of bounded size, by size and by sketch (sets of up to 64 shingles: by their hashes), and a block
   gives a spanning forest of the components that may belong together. Its edges name the components, not
   the members, and start at the smallest one, so buckets with much the same members give the same edges.
   Buckets larger than a block are first compared within parts of a block's size, so few of their components
   are apart when all their blocks meet. These edges gather the components into clusters.
5. In a cluster of several components all pairs across components are compared on their full sets, again in
   blocks that give spanning forests. So no link is lost to the choice of centres, and no step makes a table
   of all pairs. In steps 4 and 5 the largest component of a group is never compared with itself.

Hot buckets and copies are counted with map-side aggregates, joined under adaptive skew handling and
cut into blocks; nothing collects a bucket.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fraudlake.llm.common import sorted_runs, written
from fraudlake.llm.components import component_labels

SHINGLE_WORDS = 5
THRESHOLD = 75  # per cent
BINS = 1024
BAND_BINS = 4
BANDS = 64
BLOCK_ROWS = 1024
BLOCK_BYTES = 8 << 20
# Bins whose four bits must be equal before larger sets are compared. At 0.75 they are equal with a
# probability of 0.766 each; this is 7 deviations below, a similarity of about 0.65.
LEAST_EQUAL_BINS = 690
# Sets of up to so many shingles are compared by their hashes: few hashes fill few bins, which makes sketches uncertain.
SMALL = 64
# Up to so many ids are sent to every task that picks their texts, some 16 MB; more are shuffled.
BROADCAST_IDS = 1_000_000

_U = np.uint64
_ODD = _U(0x9E3779B97F4A7C15)
_WORD_FACTORS = np.random.default_rng(5).integers(1, 2**63, SHINGLE_WORDS, dtype=np.uint64) * _U(2) + _U(1)
_BAND_FACTORS = np.random.default_rng(6).integers(1, 2**63, BANDS * BAND_BINS, dtype=np.uint64) * _U(2) + _U(1)
# ORDERS[k, i]: the bin that bin i asks as the k-th; PROBES[i, j]: when bin i asks bin j
ORDERS = np.random.default_rng(7).permuted(np.tile(np.arange(BINS, dtype=np.uint16), (BINS, 1)), axis=1).T.copy()
PROBES = np.argsort(ORDERS, axis=0).T.astype(np.uint16)


def _scrambled(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class WordHashes(dict):
    """64-bit hashes of words, remembered up to a bounded number."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 200_000:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def shingles(text: str | None, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's word shingles, A-Z as a-z; empty without a word."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: ASCII only
    if not words:
        return np.empty(0, dtype=np.uint64)
    if len(words) < SHINGLE_WORDS:
        return _scrambled(np.array([xxhash.xxh64_intdigest(b" ".join(words), seed=len(words))], dtype=np.uint64))
    each = np.fromiter(map(hashes.__getitem__, words), dtype=np.uint64, count=len(words))
    size = len(each) - SHINGLE_WORDS + 1
    mixed = np.zeros(size, dtype=np.uint64)
    for k in range(SHINGLE_WORDS):
        mixed += each[k : k + size] * _WORD_FACTORS[k]
    return np.unique(_scrambled(mixed))


def bins_of(hashes: np.ndarray) -> np.ndarray:
    """The densified one-permutation signature of a sorted, non-empty set of hashes."""
    filled, first = np.unique((hashes >> _U(64 - 10)).astype(np.int64), return_index=True)
    out, there = np.empty(BINS, dtype=np.uint64), np.zeros(BINS, dtype=bool)
    out[filled], there[filled] = hashes[first], True
    empty = np.flatnonzero(~there)
    if len(filled) < 160:  # of few filled bins, the one that is asked first
        out[empty] = out[filled[PROBES[np.ix_(empty, filled)].argmin(axis=1)]]
        return out
    for asked in ORDERS:
        if not len(empty):
            break
        found = there[asked[empty]]
        out[empty[found]] = out[asked[empty[found]]]
        empty = empty[~found]
    return out


def bands_of(bins: np.ndarray) -> np.ndarray:
    """A bucket key for each band of neighbouring bins; keys of different bands differ."""
    mixed = (bins[: BANDS * BAND_BINS] * _BAND_FACTORS).reshape(BANDS, BAND_BINS).sum(axis=1)
    return _scrambled(mixed + np.arange(BANDS, dtype=np.uint64)).view(np.int64)


def sketch_of(bins: np.ndarray) -> np.ndarray:
    """Four bits of each bin, two bins to a byte."""
    bits = (bins * _ODD >> _U(60)).astype(np.uint8)
    return bits[::2] << 4 | bits[1::2]


def equal_bins(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """How many bins of sketches are equal, row by row."""
    differ = x ^ y
    return ((differ & 0xF0) == 0).sum(axis=-1) + ((differ & 0x0F) == 0).sum(axis=-1)


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= THRESHOLD * (len(a) + len(b) - both)


def sketched(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, set_id (hash of the set), bands, sketch, small (the set itself if it is small) of every row."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = WordHashes()
        for batch in batches:
            for start in range(0, len(batch), 1000):
                part = batch.iloc[start : start + 1000]
                rows = []
                for doc_id, text in zip(part["doc_id"], part["text"], strict=True):
                    hashes = shingles(text, words)
                    if len(hashes):
                        bins = bins_of(hashes)
                        small = hashes.tobytes() if len(hashes) <= SMALL else None
                        rows.append((doc_id, len(hashes), xxhash.xxh3_128_digest(hashes), bands_of(bins), sketch_of(bins).tobytes(), small))
                    else:
                        rows.append((doc_id, 0, b"", None, None, None))
                yield pd.DataFrame(rows, columns=["doc_id", "n_shingles", "set_id", "bands", "sketch", "small"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInPandas(
        run, "doc_id bigint, n_shingles bigint, set_id binary, bands array<bigint>, sketch binary, small binary"
    )


def among(df: DataFrame, columns: list[str], ids: DataFrame, how: str = "left_semi") -> DataFrame:
    """The rows of df whose columns are in ids (or with left_anti, are not); ids is a written table.

    A wide df stays where it is as long as there are at most BROADCAST_IDS ids.
    """
    return df.join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, columns, how)


def class_id() -> Column:
    return F.xxhash64("set_id")


def with_sets(docs: DataFrame) -> DataFrame:
    """set_id, set (its hashes) of every row of docs (doc_id, text) whose text has words."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = WordHashes()
        for batch in batches:
            for start in range(0, len(batch), 1000):  # sets are larger than their texts
                sets = [shingles(text, words) for text in batch["text"].iloc[start : start + 1000]]
                rows = [(xxhash.xxh3_128_digest(hashes), hashes.tobytes()) for hashes in sets if len(hashes)]
                yield pd.DataFrame(rows, columns=["set_id", "set"])

    return docs.select("doc_id", "text").mapInPandas(run, "set_id binary, set binary")


def sets_of(wanted: DataFrame, docs: DataFrame, classes: DataFrame) -> DataFrame:
    """id, set of the classes (id, doc_id; written) in wanted (id; written)."""
    named = written(among(classes.select("id", "doc_id"), ["id"], wanted).select("doc_id").distinct(), "named")
    rows = among(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), ["doc_id"], named)
    found = among(with_sets(rows).select(class_id().alias("id"), "set"), ["id"], wanted)
    return written(found.groupBy("id").agg(F.first("set").alias("set")), "full")  # a class has one set


def confirmed(pairs: DataFrame, docs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs (a, b; written) of classes whose full shingle sets reach the threshold."""
    wanted = written(pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct(), "wanted")
    sets = sets_of(wanted, docs, classes)

    @F.pandas_udf("boolean")
    def linked(left: pd.Series, right: pd.Series) -> pd.Series:
        both = zip(left, right, strict=True)
        return pd.Series([similar(np.frombuffer(x, dtype=np.uint64), np.frombuffer(y, dtype=np.uint64)) for x, y in both], dtype=bool)

    return (
        pairs.select("a", "b")
        .join(sets.select(F.col("id").alias("a"), F.col("set").alias("_left")), "a")
        .join(sets.select(F.col("id").alias("b"), F.col("set").alias("_right")), "b")
        .filter(linked("_left", "_right"))
        .select("a", "b")
    )


def counted(rows: DataFrame, group: str, row_bytes: Column) -> DataFrame:
    """group, component, joined (the component itself), _n, _size (written) of those groups of rows (group, id, component,
    more; written) that have several components. The others have nothing to compare."""
    each = rows.groupBy(group, "component").agg(F.count(F.lit(1)).alias("_n"), F.sum(row_bytes).alias("_size"))
    several = rows.groupBy(group).agg(F.min("component").alias("_least"), F.max("component").alias("_last")).filter("_least <> _last")
    return written(each.join(several.select(group), group, "left_semi").withColumn("joined", F.col("component")), "counted")


def block_count(rows: str, size: str) -> Column:
    return F.ceil(F.greatest(F.col(rows) / BLOCK_ROWS, F.col(size) / BLOCK_BYTES)).cast("int")


def blocked(rows: DataFrame, group: str, counts: DataFrame) -> DataFrame:
    """rows (group, id, component, more; written) of groups with several components, copied to blocks.

    counts (as counted gives them; written) says by joined which components are one by now. A block (group, block_a,
    block_b) has two halves of bounded size, or one if block_a = block_b. Every two rows of different components of a
    group meet in a block. The largest component has blocks of its own, which only meet those of the others: it is
    copied once for each block of these.
    """
    each = counts.groupBy(group, "joined").agg(F.sum("_n").alias("n"), F.sum("_size").alias("size"))
    mixed = (
        each.groupBy(group)
        .agg(
            F.max(F.struct("n", "joined", "size")).alias("_largest"), F.sum("n").alias("_rows"), F.sum("size").alias("_total")
        )
        .filter(F.col("_rows") > F.col("_largest.n"))
        .select(
            group,
            F.col("_largest.joined").alias("_large"),
            F.col("_largest.n").alias("_n"),
            F.col("_largest.size").alias("_size"),
            (F.col("_rows") - F.col("_largest.n")).alias("_rest"),
            (F.col("_total") - F.col("_largest.size")).alias("_rest_size"),
        )
        .select(group, "_large", block_count("_n", "_size").alias("_theirs"), block_count("_rest", "_rest_size").alias("_blocks"))
    )
    is_large = F.col("joined") == F.col("_large")
    own = F.when(is_large, F.col("_blocks") + F.pmod(F.xxhash64("id"), F.col("_theirs"))).otherwise(F.pmod(F.xxhash64("id"), F.col("_blocks")))
    last = F.when(is_large, F.col("_blocks")).otherwise(F.col("_blocks") + F.col("_theirs")) - 1
    return (
        rows.join(counts.select(group, "component", "joined").join(mixed, group), [group, "component"])
        .withColumn("_own", own.cast("int"))
        .withColumn("_other", F.explode(F.sequence(F.lit(0), last)))
        .withColumn("block_a", F.least("_own", "_other"))
        .withColumn("block_b", F.greatest("_own", "_other"))
        .withColumn("half", (F.col("_own") > F.col("_other")).cast("int"))
        .withColumn("component", F.col("joined"))
        .drop("joined", "_large", "_theirs", "_blocks", "_own", "_other")
    )


def joined(rows: DataFrame, group: str, counts: DataFrame, seen: DataFrame, exactly: bool) -> DataFrame:
    """Edges (a, b; written) between components of rows (group, id, component, more; written), which join those of
    a group as far as they are alike. counts: what counted gives of rows. seen: id and what a comparison reads.

    Groups larger than a block are compared within parts of a block's size first, and what is joined then counts as
    one component when their blocks meet. So there are not as many edges as pairs of blocks could give. The new
    labels go to the components of each group, not to its rows, and groups of one component by then are left out.
    """

    def forests(blocks: DataFrame) -> DataFrame:
        runs = sorted_runs(blocks.join(seen, "id"), [group, "block_a", "block_b"], lambda b: _forest(b, exactly), "a bigint, b bigint")
        return written(runs.distinct(), "near")

    sizes = counts.groupBy(group).agg(F.sum("_n").alias("_n"), F.sum("_size").alias("_size"))
    large = written(sizes.select(group, block_count("_n", "_size").alias("_parts")).filter("_parts > 1"), "large")
    if large.isEmpty():
        return forests(blocked(rows, group, counts))
    part = F.pmod(F.xxhash64("id"), "_parts").cast("int")
    within = rows.join(large, group).withColumns({"block_a": part, "block_b": part, "half": F.lit(0)}).drop("_parts")
    edges = forests(within)
    labels = component_labels(edges).select(F.col("id").alias("component"), F.col("component").alias("_joined"))
    relabelled = counts.join(labels, "component", "left").withColumn("joined", F.coalesce("_joined", "component")).drop("_joined")
    return edges.unionByName(forests(blocked(rows, group, written(relabelled, "joined"))))


def _forest(block: pd.DataFrame, exactly: bool) -> pd.DataFrame | None:
    """Edges between the components of a block as far as pairs across them are alike: by size and sketch, or
    also by their full sets. No edge is between what components and earlier edges join already."""
    block = block.sort_values(["component", "id"])
    size, components, half = (block[c].to_numpy() for c in ("n", "component", "half"))
    root = components.copy()
    sketch = np.frombuffer(b"".join(block["sketch"]), dtype=np.uint8).reshape(len(block), -1)
    if exactly:
        sets = [np.frombuffer(x, dtype=np.uint64) for x in block["set"]]
    else:
        sets = [None if x is None else np.frombuffer(x, dtype=np.uint64) for x in block["small"]]
    small = size <= SMALL
    hashes = np.zeros((len(block), SMALL), dtype=np.uint64)
    for k in np.flatnonzero(small):
        hashes[k, : size[k]] = sets[k]
        hashes[k, size[k] :] = sets[k][0]  # repeats, which an intersection of sets leaves out
    one_half = block["block_a"].iat[0] == block["block_b"].iat[0]
    later = np.arange(len(block))
    found = []
    for k in range(len(block)) if one_half else np.flatnonzero(half == 0):
        fits = (root != root[k]) & (100 * np.minimum(size, size[k]) >= THRESHOLD * np.maximum(size, size[k]))
        fits &= (later > k) if one_half else (half == 1)
        rows = np.flatnonzero(fits)
        if not len(rows):
            continue
        alike = np.zeros(len(rows), dtype=bool)
        by_hash = small[rows] if small[k] else alike
        if by_hash.any():
            mine = rows[by_hash]
            common = np.isin(hashes[mine], sets[k])
            both = common.sum(axis=1) - np.where(common[:, 0], SMALL - size[mine], 0)
            alike[by_hash] = 100 * both >= THRESHOLD * (size[k] + size[mine] - both)
        if not by_hash.all():
            alike[~by_hash] = equal_bins(sketch[rows[~by_hash]], sketch[k]) >= LEAST_EQUAL_BINS
        for i in rows[alike]:
            if root[i] != root[k] and (not exactly or small[i] & small[k] or similar(sets[k], sets[i])):
                found.append((min(components[k], components[i]), max(components[k], components[i])))
                root[root == root[i]] = root[k]
    return pd.DataFrame(found, columns=["a", "b"]) if found else None


def links(classes: DataFrame, docs: DataFrame) -> DataFrame:
    """Links (a, b) that connect exactly the classes (id, doc_id, n, bands, sketch, small) that belong together."""
    spread = classes.select("id", F.explode("bands").alias("bucket"))
    centres = spread.groupBy("bucket").agg(F.min("id").alias("centre"), F.count(F.lit(1)).alias("members")).filter("members > 1")
    members = written(spread.join(centres, "bucket").select("bucket", "id", "centre"), "buckets")
    classes = written(among(classes, ["id"], written(members.select("id").distinct(), "ids")), "known")

    shared = members.filter("id <> centre").groupBy("id", "centre").agg(F.count(F.lit(1)).alias("_buckets"))
    stars = shared.groupBy(F.col("id").alias("b")).agg(F.max_by("centre", F.struct("_buckets", "centre")).alias("a"))
    first = written(confirmed(written(stars.select("a", "b"), "stars"), docs, classes), "links")
    labels = component_labels(first)

    placed = written(members.join(labels, "id", "left").select("bucket", "id", F.coalesce("component", "id").alias("component")), "placed")
    near = joined(placed, "bucket", counted(placed, "bucket", F.lit(0)), classes.select("id", "n", "sketch", "small"), False)
    stars = labels.select(F.col("id").alias("a"), F.col("component").alias("b")).filter("a <> b")
    if near.isEmpty():
        return stars

    clusters = component_labels(near).select(F.col("id").alias("component"), F.col("component").alias("cluster"))
    several = clusters.join(labels, "component", "left").select("cluster", F.coalesce("id", "component").alias("id"), "component")
    sketches = classes.select("id", "n", "sketch")
    several = written(several.join(sketches.select("id", "n"), "id"), "clusters")
    counts = counted(several, "cluster", 8 * F.col("n"))
    wanted = written(blocked(several, "cluster", counts).select("id").distinct(), "wanted")
    sets = sets_of(wanted, docs, classes).join(sketches.drop("n"), "id")
    return stars.unionByName(joined(several, "cluster", counts, sets, True))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of docs.

    Null, empty or blank text has no shingles and is linked with nothing. A doc_id stands for one
    document: rows that repeat it are in one component and get the same answer. Rows without doc_id
    are linked with nothing and kept; their component_id is null. Other columns are not read.
    """
    docs = docs.select("doc_id", "text")
    sets = written(sketched(docs), "sets")
    classes = classes_of(sets)
    labels = component_labels(links(classes, docs).unionByName(_repeated(sets)))
    narrow = classes.select("set_id", "id", F.col("doc_id").alias("_smallest"))
    linked = written(narrow.join(labels, "id").select("set_id", "_smallest", "component"), "linked")
    label = linked.groupBy("component").agg(F.min("_smallest").alias("_label"))
    roots = (
        narrow.join(linked.join(label, "component").select("set_id", "_label"), "set_id", "left")
        .select("set_id", F.coalesce("_label", "_smallest").alias("component"))
    )
    found = sets.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0), F.col("set_id")).alias("set_id"))
    component = F.coalesce("component", "doc_id")
    return found.join(roots, "set_id", "left").select(
        "doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept")
    )


def classes_of(sets: DataFrame) -> DataFrame:
    """set_id, id (its hash), doc_id (the smallest), n, bands, sketch of each different set.

    Copies are found on ids alone and left out; only if rows repeat a doc_id with the same set are
    whole rows grouped.
    """
    named = sets.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    each = named.groupBy("set_id", "doc_id").agg(F.count(F.lit(1)).alias("_rows"))
    copied = written(
        each.groupBy("set_id")
        .agg(F.min("doc_id").alias("_id"), F.count(F.lit(1)).alias("_docs"), F.max("_rows").alias("_rows"))
        .filter("_docs > 1 OR _rows > 1"),
        "copied",
    )
    columns = ["set_id", "doc_id", "n_shingles", "bands", "sketch", "small"]
    if copied.filter("_rows > 1").isEmpty():
        copies = named.select("set_id", "doc_id").join(copied.select("set_id", "_id"), "set_id").filter("doc_id <> _id")
        first = among(named.select(*columns), ["set_id", "doc_id"], written(copies.select("set_id", "doc_id"), "copies"), "left_anti")
    else:
        first = named.groupBy("set_id").agg(F.min("doc_id").alias("doc_id"), *(F.first(c).alias(c) for c in columns[2:]))
    return first.withColumnRenamed("n_shingles", "n").withColumn("id", class_id())


def _repeated(sets: DataFrame) -> DataFrame:
    """Links between the classes of a doc_id that stands for several texts."""
    named = sets.filter("n_shingles > 0 AND doc_id IS NOT NULL").select("doc_id", class_id().alias("b"))
    several = named.groupBy("doc_id").agg(F.min("b").alias("a"), F.max("b").alias("_last")).filter("a <> _last").drop("_last")
    return named.join(several, "doc_id").filter("a <> b").select("a", "b").distinct()


NEAR_DEDUP_SQL = """
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS words
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(words[i : i + 4], ' ') AS shingle
  FROM w, unnest(range(1, greatest(len(words) - 3, 2))) AS starts(i) WHERE len(words) > 0
), n AS (
  SELECT doc_id, count(*) AS size FROM s GROUP BY doc_id
), alike AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL
), linked AS (
  SELECT a, b FROM alike JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * common >= 75 * (x.size + y.size - common)
), reached AS (
  SELECT doc_id, doc_id AS other FROM n
  UNION
  SELECT doc_id, b FROM reached JOIN linked ON a = other
)
SELECT w.doc_id, coalesce(size, 0) AS n_shingles, coalesce(component, w.doc_id) AS component_id, coalesce(component, w.doc_id) = w.doc_id AS kept
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT doc_id, min(other) AS component FROM reached GROUP BY doc_id) USING (doc_id)
"""
