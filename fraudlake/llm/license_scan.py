"""License scan: ordered signature rules behind a keyword prefilter, with DataFrame functions only.

Everything happens within the row: a text becomes words, a rule is tried only where its keyword
occurs, and overlapping detections are resolved by interval and priority. There is no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fraudlake.llm.common import whole_text
from fraudlake.llm.license_rules import Rule, grouped_json, rules

# The base phrases, as words, and their labels.
BASE = (
    Rule("cc by", "cc-by", 0, 0.6, "cc by"),
    Rule("general public license", "gpl", 0, 0.6, "general public license"),
    Rule("all rights reserved", "reserved", 0, 0.6, "all rights reserved"),
)

_GROUPS = "array<struct<keyword:string,rules:array<struct<label:string,priority:int,confidence:double,pattern:string>>>>"
_PLACES = "array<struct<start:int,neg_end:int,priority:int,label:string,confidence:double>>"


def words_text(text: Column) -> Column:
    """The words of a text between single spaces, with a space before and after; ' ' if there are none.

    Words are runs of a-z, 0-9 and everything beyond ASCII; A-Z count as a-z. lower() also turns two
    characters beyond ASCII into ASCII letters, which are therefore put aside first.
    """
    kept = F.replace(F.replace(text, F.lit("K"), F.lit("κ")), F.lit("İ"), F.lit("ι"))
    return F.regexp_replace(F.concat(F.lit(" "), F.lower(kept), F.lit(" ")), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " ")


def spaces(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def _matches(words: Column, rule: Column) -> Column:
    """Places where one rule's pattern stands, by word number, the end exclusive."""
    found = F.regexp_extract_all(words, rule["pattern"], F.lit(0))
    between = F.slice(F.split(words, rule["pattern"], -1), F.lit(1), F.size(found))
    sizes = F.zip_with(between, found, lambda b, f: F.struct(spaces(b).alias("before"), spaces(f).alias("inner")))

    def further(seen: Column, size: Column) -> Column:
        # the text starts with a space, so a word's number is one less than the spaces before it
        start = seen["spaces"] + size["before"] - 1
        place = F.struct(
            start.alias("start"),
            (-start - size["inner"] - 1).alias("neg_end"),
            rule["priority"].alias("priority"),
            rule["label"].alias("label"),
            rule["confidence"].alias("confidence"),
        )
        return F.struct(
            (seen["spaces"] + size["before"] + size["inner"]).alias("spaces"), F.concat(seen["places"], F.array(place)).alias("places")
        )

    nothing = F.expr(f"named_struct('spaces', 0, 'places', CAST(array() AS {_PLACES}))")
    return F.aggregate(sizes, nothing, further, lambda seen: seen["places"])


def detections(words: Column, signature: list[Rule]) -> Column:
    """All places of all rules whose keyword occurs, in the order of start, longer first, priority."""
    groups = F.from_json(F.lit(grouped_json(signature)), _GROUPS)
    hit = F.filter(groups, lambda g: F.contains(words, g["keyword"]))
    tried = F.flatten(F.transform(hit, lambda g: g["rules"]))
    return F.array_sort(F.flatten(F.transform(tried, lambda r: _matches(words, r))))


def resolved(found: Column) -> Column:
    """found (in order) without overlaps. A detection inside the one kept before it, equal intervals included,
    goes. If it only overlaps that one, the better priority stays, and the earlier one if they are equal."""

    def further(seen: Column, d: Column) -> Column:
        overlaps = d["start"] < seen["end"]
        goes = (-d["neg_end"] <= seen["end"]) | (overlaps & (d["priority"] >= seen["priority"]))
        # what is kept does not overlap, so a new one can only overlap the last
        before = F.when(overlaps, F.slice(seen["kept"], F.lit(1), F.size(seen["kept"]) - 1)).otherwise(seen["kept"])
        kept = F.struct((-d["neg_end"]).alias("end"), d["priority"].alias("priority"), F.concat(before, F.array(d)).alias("kept"))
        return F.when(goes, seen).otherwise(kept)

    nothing = F.expr(f"named_struct('end', 0, 'priority', 0, 'kept', CAST(array() AS {_PLACES}))")
    return F.aggregate(found, nothing, further, lambda seen: seen["kept"])


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, base and found (arrays of start, neg_end = -end, priority, label, confidence)
    for every row; null text is empty."""
    words = docs.select("doc_id", words_text(whole_text()).alias("_words"))
    return words.select(
        "doc_id",
        (spaces(F.col("_words")) - 1).cast("long").alias("n_words"),
        detections(F.col("_words"), list(BASE)).alias("base"),
        resolved(detections(F.col("_words"), rules())).alias("found"),
    )


def _labels(*places: str) -> Column:
    every = F.flatten(F.array(*(F.transform(p, lambda d: d["label"]) for p in places)))
    return F.array_join(F.array_sort(F.array_distinct(every)), ",")


def license_query(docs: DataFrame) -> DataFrame:
    """scan() as doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    score is the greatest confidence of any detection, 0 without one.
    """
    starts = F.transform("base", lambda d: d["start"].cast("long"))
    sure = F.transform(F.concat("base", "found"), lambda d: d["confidence"])
    return scan(docs).select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        _labels("base").alias("base_labels"),
        _labels("base", "found").alias("labels"),
        F.coalesce(F.array_max(sure), F.lit(0.0)).alias("score"),
        F.transform("found", lambda d: F.struct(d["start"].alias("start"), (-d["neg_end"]).alias("end"), d["label"].alias("label"))).alias(
            "detections"
        ),
    )
