"""The fraud rules.

A rule names its flag column and gives the columns it derives and its predicate. All rules of
a run share one ``account_history``; the rest is a projection.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fraudlake.config import GEO_ANOMALY, HIGH_AMOUNT, VELOCITY, FraudConfig
from fraudlake.functions import epoch_seconds, haversine_km
from fraudlake.operators.history import COUNT_COLUMN, PREVIOUS, account_history


@dataclass(frozen=True)
class Rule:
    """A reason code (no comma), the flag column it fills, its weight and its predicate.

    ``derived`` names columns to add first. With ``trailing`` these and the predicate may use
    txn_count_5min, with ``previous`` prev_lat, prev_lon and prev_ts.
    """

    reason: str
    flag: str
    weight: Callable[[FraudConfig], float]
    predicate: Callable[[FraudConfig], Column]
    derived: Callable[[], dict[str, Column]] = dict
    trailing: bool = False
    previous: bool = False


def _travel() -> dict[str, Column]:
    lat1, lon1, lat2, lon2 = (F.col(c) for c in ("prev_lat", "prev_lon", "location_lat", "location_lon"))
    return {
        "geo_distance_km": haversine_km(lat1, lon1, lat2, lon2),
        "time_diff_sec": epoch_seconds(F.col("event_timestamp")) - epoch_seconds(F.col("prev_ts")),
    }


HIGH_AMOUNT_RULE = Rule(
    reason=HIGH_AMOUNT,
    flag="fraud_flag_high_amount",
    weight=lambda cfg: cfg.high_amount_weight,
    predicate=lambda cfg: F.col("amount") > cfg.high_amount,
)
VELOCITY_RULE = Rule(
    reason=VELOCITY,
    flag="fraud_flag_velocity",
    weight=lambda cfg: cfg.velocity_weight,
    predicate=lambda cfg: F.col(COUNT_COLUMN) >= cfg.velocity_min_count,
    trailing=True,
)
GEO_ANOMALY_RULE = Rule(
    reason=GEO_ANOMALY,
    flag="fraud_flag_geo_anomaly",
    weight=lambda cfg: cfg.geo_weight,
    predicate=lambda cfg: (F.col("geo_distance_km") > cfg.geo_distance_km)
    & F.col("time_diff_sec").between(1, cfg.geo_window_s),
    derived=_travel,
    previous=True,
)
DEFAULT_RULES = (HIGH_AMOUNT_RULE, VELOCITY_RULE, GEO_ANOMALY_RULE)


def apply_rules(df: DataFrame, cfg: FraudConfig = FraudConfig(), rules: Sequence[Rule] = DEFAULT_RULES) -> DataFrame:
    """Add the derived columns and the flag of each rule. A predicate that is NULL is no hit."""
    trailing = any(r.trailing for r in rules)
    previous = any(r.previous for r in rules)
    if trailing or previous:
        df = account_history(df, cfg, trailing=trailing, previous=previous)
    derived = reduce(lambda cols, rule: cols | rule.derived(), rules, {})
    if derived:
        df = df.withColumns(derived)
    flags = {r.flag: F.coalesce(r.predicate(cfg), F.lit(False)) for r in rules}
    return df.withColumns(flags).drop(*PREVIOUS)


def flag_high_amount(df: DataFrame, cfg: FraudConfig = FraudConfig()) -> DataFrame:
    """Add ``fraud_flag_high_amount``."""
    return apply_rules(df, cfg, [HIGH_AMOUNT_RULE])


def flag_velocity(df: DataFrame, cfg: FraudConfig = FraudConfig()) -> DataFrame:
    """Add ``txn_count_5min`` and ``fraud_flag_velocity``."""
    return apply_rules(df, cfg, [VELOCITY_RULE])


def flag_geo_anomaly(df: DataFrame, cfg: FraudConfig = FraudConfig()) -> DataFrame:
    """Add ``geo_distance_km``, ``time_diff_sec`` and ``fraud_flag_geo_anomaly``."""
    return apply_rules(df, cfg, [GEO_ANOMALY_RULE])


def add_verdict(
    df: DataFrame, cfg: FraudConfig = FraudConfig(), rules: Sequence[Rule] = DEFAULT_RULES
) -> DataFrame:
    """Add ``fraud_reasons`` (comma-separated, '' if none), ``fraud_score`` and ``is_fraud``."""
    reasons = F.concat_ws(",", *(F.when(F.col(r.flag), F.lit(r.reason)) for r in rules))
    score = _score({r.reason: F.col(r.flag) for r in rules}, cfg, rules)
    return df.withColumns({"fraud_reasons": reasons, "fraud_score": score, "is_fraud": score > 0.0})


def score_of_reasons(
    reasons: Column, cfg: FraudConfig = FraudConfig(), rules: Sequence[Rule] = DEFAULT_RULES
) -> Column:
    """The score again, from a stored ``fraud_reasons`` text."""
    hits = F.split(reasons, ",")
    return _score({r.reason: F.array_contains(hits, r.reason) for r in rules}, cfg, rules)


def score_transactions(
    df: DataFrame, cfg: FraudConfig = FraudConfig(), rules: Sequence[Rule] = DEFAULT_RULES
) -> DataFrame:
    """All flags and the verdict.

    Input columns: transaction_id, account_id, event_timestamp, amount, location_lat,
    location_lon; others are kept.
    """
    return add_verdict(apply_rules(df, cfg, rules), cfg, rules)


def _score(hits: dict[str, Column], cfg: FraudConfig, rules: Sequence[Rule]) -> Column:
    parts = [hits[r.reason].cast("double") * F.lit(float(r.weight(cfg))) for r in rules]
    return F.least(F.lit(1.0), reduce(add, parts))
