"""Personal data: fixed kinds by pattern, and further identifiers by bootstrapped contexts.

Spans of the fixed kinds are the seeds. The words around them are lexical patterns. Tokens that look
like identifiers (enough digits) are instances as well, unproven ones. Patterns and instances form a
graph that Spark scores in rounds: a pattern is as good as the mean of its instances, an unproven
instance as the mean of its patterns, a seed is always certain. A pattern that stays confident over
enough distinct instances discovers the unproven tokens that stand in it, as spans of kind `id`.
The graph is shuffled by pattern and by instance with map-side sums; nothing of it is collected.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fraudlake.llm.common import fresh, written

# The kinds in their order, and the patterns of the base kinds.
KINDS = ("email", "ip", "card", "phone", "id")
LOCAL = re.compile(r"[A-Za-z0-9._%+-]+")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

ROUNDS = 3
CONFIDENCE = 0.8
SUPPORT = 5
LEAST_DIGITS = 4

_DOTTED = re.compile(r"[0-9][0-9.]*")
_LOCAL_CHARS = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_TOKEN = re.compile(r"[A-Za-z0-9][A-Za-z0-9._+-]*")
_DIGITS = re.compile("[0-9]")
_CONTEXT_CHARS = 64

Span = tuple[str, int, int]


def emails(text: str) -> list[Span]:
    """As a search for LOCAL@DOMAIN finds them, but from each @ backwards: linear in long runs too."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            out.append(("email", start, domain.end()))
        free = domain.end() if domain else at + 1
        at = text.find("@", free)
    return out


def ips(text: str) -> list[Span]:
    return [
        ("ip", run.start() + m.start(), run.start() + m.end())
        for run in _DOTTED.finditer(text)
        if run.group().count(".") >= 3
        for m in IP.finditer(run.group())
        if all(len(part.lstrip("0")) <= 3 and int(part) <= 255 for part in m.group().split("."))
    ]


def luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    return (odd + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def base_spans(text: str) -> list[Span]:
    """Spans (kind, start, end) of the base kinds, leftmost and not overlapping within a kind; by kind and start."""
    out = emails(text) + ips(text)
    for m in CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    if "+" in text:
        out += [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(_DIGITS.findall(m.group())) <= 15]
    return out


def contexts(text: str, start: int, end: int) -> list[str]:
    """The lexical patterns a span stands in: the word before it, the two words before it, the word after it."""
    before = text[max(0, start - _CONTEXT_CHARS) : start].lower().split()
    after = text[end : end + _CONTEXT_CHARS].lower().split()
    out = [f"1 {before[-1]}"] if before else []
    out += [f"2 {before[-2]} {before[-1]}"] if len(before) > 1 else []
    return out + ([f"3 {after[0]}"] if after else [])


def instances(text: str, base: list[Span]) -> Iterator[tuple[bool, int, int, int, list[str]]]:
    """seed, start, end, hash and contexts of every base span and of every unproven token beside them."""
    at, spans = 0, sorted((s, e) for _, s, e in base)
    for start, end in spans:
        yield True, start, end, xxhash.xxh64_intdigest(text[start:end].lower().encode("utf-8", "surrogatepass")) >> 1, contexts(text, start, end)
    if not _DIGITS.search(text):
        return
    for token in _TOKEN.finditer(text):
        start, end = token.start(), token.start() + len(token.group().rstrip("._+-"))
        if len(_DIGITS.findall(token.group())) < LEAST_DIGITS:
            continue
        while at < len(spans) and spans[at][1] <= start:
            at += 1
        # spans of different kinds may overlap, so look a few ahead
        if any(s < end and e > start for s, e in spans[max(0, at - 3) : at + 3]):
            continue
        yield False, start, end, xxhash.xxh64_intdigest(text[start:end].lower().encode("utf-8", "surrogatepass")) >> 1, contexts(text, start, end)


_FOUND = "base array<struct<kind:string,start:bigint,end:bigint>>, seen array<struct<seed:boolean,start:bigint,end:bigint,instance:bigint,patterns:array<string>>>"


def text_key() -> Column:
    return F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))


def extract(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, base, seen of every row; doc_id and text_key together name a text (a table)."""

    @F.pandas_udf(_FOUND)
    def extracted(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            base = [base_spans(t or "") for t in texts]
            seen = [list(instances(t or "", b)) for t, b in zip(texts, base, strict=True)]
            yield pd.DataFrame({"base": base, "seen": seen})

    found = docs.select("doc_id", text_key().alias("text_key"), extracted(F.col("text").cast("string")).alias("_found"))
    return written(found.select("doc_id", "text_key", "_found.base", "_found.seen"), "seen")


def confident_patterns(seen: DataFrame, rounds: int = ROUNDS, confidence: float = CONFIDENCE, support: int = SUPPORT) -> DataFrame:
    """pattern, score of the patterns that proved themselves over the instances of seen (from extract())."""
    each = seen.select(F.explode("seen").alias("s"))
    edges = written(
        each.select("s.seed", "s.instance", F.explode("s.patterns").alias("pattern"))
        .groupBy("pattern", "instance")
        .agg(F.max("seed").alias("seed")),
        "graph",
    )
    certain = edges.groupBy("instance").agg(F.max("seed").alias("certain"))
    belief = written(certain.select("instance", "certain", F.col("certain").cast("double").alias("belief")), "belief")
    for step in range(rounds):
        patterns = (
            edges.join(belief, "instance")
            .groupBy("pattern")
            .agg((F.sum("belief") / F.count(F.lit(1))).alias("score"), F.count(F.lit(1)).alias("instances"))
        )
        if step == rounds - 1:
            break
        told = edges.join(patterns, "pattern").groupBy("instance").agg(F.avg("score").alias("_told"))
        belief = written(
            belief.join(told, "instance").select("instance", "certain", F.when(F.col("certain"), F.lit(1.0)).otherwise(F.col("_told")).alias("belief")),
            "belief",
        )
    return patterns.filter((F.col("score") >= confidence) & (F.col("instances") >= support)).select("pattern", "score")


def discovered(seen: DataFrame, patterns: DataFrame) -> DataFrame:
    """doc_id, text_key and ids (array of kind, start, end) of texts where a confident pattern holds an unproven token."""
    tokens = seen.select("doc_id", "text_key", F.explode("seen").alias("s")).filter("NOT s.seed")
    return (
        tokens.select("doc_id", "text_key", "s.start", "s.end", F.explode("s.patterns").alias("pattern"))
        .join(patterns, "pattern")
        .groupBy("doc_id", "text_key")
        .agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("_ids"))
        .select(
            "doc_id",
            "text_key",
            F.transform("_ids", lambda s: F.struct(F.lit("id").alias("kind"), s["start"].alias("start"), s["end"].alias("end"))).alias("ids"),
        )
    )


def find(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, base, ids of every row of docs. Null text is empty; rows without doc_id take part."""
    seen = extract(docs.select("doc_id", "text"))
    ids = discovered(seen, confident_patterns(seen)).withColumnsRenamed({"doc_id": "_doc_id", "text_key": "_text_key"})
    same = F.col("doc_id").eqNullSafe(F.col("_doc_id")) & (F.col("text_key") == F.col("_text_key"))
    none = F.expr("CAST(array() AS array<struct<kind:string,start:bigint,end:bigint>>)")
    return seen.select("doc_id", "text_key", "base").join(ids, same, "left").select(
        "doc_id", "text_key", "base", F.coalesce("ids", none).alias("ids")
    )


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def pii_query(docs: DataFrame) -> DataFrame:
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return find(docs).select(
        "doc_id",
        *(count(kind) for kind in KINDS[:4]),
        F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
        _joined(F.concat("base", "ids")).alias("spans"),
    )


def masked_text(text: str, spans: list[Span]) -> str:
    """The text with <KIND> in place of each span; overlapping spans become one, named after the first."""
    out, at = [], 0
    for start, end, kind in sorted((s["start"], s["end"], s["kind"]) for s in spans):
        if start >= at:
            out += [text[at:start], f"<{kind.upper()}>"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def mask(docs: DataFrame) -> DataFrame:
    """docs, all columns, with personal data replaced in text; n_chars, if there, follows the new text.

    Null text stays null. Rows without any span are unchanged.
    """
    found = find(docs).filter("size(base) + size(ids) > 0").dropDuplicates(["doc_id", "text_key"])
    names = {"id": fresh(docs, "_doc_id"), "key": fresh(docs, "_text_key"), "spans": fresh(docs, "_spans")}
    spans = found.select(
        F.col("doc_id").alias(names["id"]), F.col("text_key").alias(names["key"]), F.concat("base", "ids").alias(names["spans"])
    )

    @F.pandas_udf("string")
    def replaced(texts: pd.Series, spans: pd.Series) -> pd.Series:
        return pd.Series([t if s is None else masked_text(t, s) for t, s in zip(texts, spans, strict=True)], dtype=object)

    same = F.col("doc_id").eqNullSafe(F.col(names["id"])) & (text_key() == F.col(names["key"]))
    joined = docs.join(spans, same, "left")
    text = F.when(F.col(names["spans"]).isNull(), F.col("text")).otherwise(replaced(F.col("text"), F.col(names["spans"])))
    new = joined.withColumn("text", text)
    if "n_chars" in docs.columns:
        clean = F.col(names["spans"]).isNull()
        new = new.withColumn("n_chars", F.when(clean, F.col("n_chars")).otherwise(F.length("text").cast("long")))
    return new.select(docs.columns)
