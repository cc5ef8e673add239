"""Scoring of one day of the raw table into the curated tables."""

from __future__ import annotations

import logging
from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fraudlake.config import FraudConfig
from fraudlake.operators import curate
from fraudlake.operators.rules import DEFAULT_RULES, Rule, score_of_reasons, score_transactions
from fraudlake.session import shuffle_sized_for
from fraudlake.sources.lake import Lake

log = logging.getLogger(__name__)


def run_day(
    lake: Lake,
    dt: str,
    cfg: FraudConfig = FraudConfig(),
    run_at: Column | None = None,
    rules: Sequence[Rule] = DEFAULT_RULES,
) -> bool:
    """Score ``dt`` and replace that day in the three curated tables; False if it is empty.

    A day that has become empty is emptied there as well. The scored rows are written once, as curated transactions. Alerts and summary are built
    from the written day: it holds all they need, survives the loss of an executor, and
    costs a pruned scan instead of a cache of the whole day.
    """
    batches = lake.batches_of(dt)  # before the rows are read: what comes meanwhile makes the day due again
    raw = lake.read(lake.raw)
    if curate.raw_day(raw, dt).isEmpty():
        log.warning("no data for %s", dt)
        for table in (lake.transactions, lake.alerts, lake.summary):
            held = lake.read(table).filter(F.col("dt") == dt)
            if not held.isEmpty():
                lake.overwrite_day(table, lake.spark.createDataFrame([], held.schema), dt)
        lake.note_built(dt, batches)
        return False

    with shuffle_sized_for(curate.raw_day(raw, dt)):
        scored = score_day(raw, dt, cfg, rules)
        lake.overwrite_day(lake.transactions, curate.curated_transactions(scored, run_at), dt)

    written = scored_day(lake, dt, cfg, rules)
    lake.overwrite_day(lake.alerts, curate.fraud_alerts(written, run_at).hint("rebalance", "fraud_reason"), dt)
    lake.overwrite_day(lake.summary, curate.fraud_summary(written, run_at).hint("rebalance"), dt)

    lake.note_built(dt, batches)
    totals = lake.read(lake.summary).filter(F.col("dt") == dt).agg(F.sum("total_txn"), F.sum("fraud_txn")).first()
    log.info("%s: %s transactions, %s fraudulent", dt, *totals)
    return True


def run_changed_days(
    lake: Lake,
    cfg: FraudConfig = FraudConfig(),
    run_at: Column | None = None,
    rules: Sequence[Rule] = DEFAULT_RULES,
) -> list[str]:
    """Score the days that got rows since they were scored, or never were; which these are.

    With ``lookback`` a day also reads the end of the day before, so the day after a changed one is due as well.
    """
    days = set(lake.changed_days())
    if cfg.lookback:
        after = {str(date.fromisoformat(d) + timedelta(days=1)) for d in days}
        days |= {d for d in after if lake.batches_of(d)}
    for dt in sorted(days):
        run_day(lake, dt, cfg, run_at, rules)
    return sorted(days)


def score_day(
    raw: DataFrame, dt: str, cfg: FraudConfig = FraudConfig(), rules: Sequence[Rule] = DEFAULT_RULES
) -> DataFrame:
    """Scored transactions of one day.

    With ``lookback`` the rules also see the last part of the day before, as long as the
    longest time window among them.
    """
    if not cfg.lookback:
        return score_transactions(_prepared(curate.raw_day(raw, dt), cfg), cfg, rules)
    day_before = str(date.fromisoformat(dt) - timedelta(days=1))
    reach = max(cfg.velocity_window_s, cfg.geo_window_s)
    since = F.lit(f"{dt} 00:00:00").cast("timestamp_ntz") - F.make_dt_interval(secs=F.lit(reach))
    both_days = curate.usable(raw.filter(F.col("dt").isin(day_before, dt) & (F.col("event_timestamp") >= since)))
    return score_transactions(_prepared(both_days, cfg), cfg, rules).filter(F.col("dt") == dt)


def scored_day(
    lake: Lake, dt: str, cfg: FraudConfig = FraudConfig(), rules: Sequence[Rule] = DEFAULT_RULES
) -> DataFrame:
    """A written day with its score, which follows from the stored reasons."""
    day = lake.read(lake.transactions).filter(F.col("dt") == dt)
    return day.withColumn("fraud_score", score_of_reasons(F.col("fraud_reasons"), cfg, rules))


def _prepared(day: DataFrame, cfg: FraudConfig) -> DataFrame:
    return curate.keep_first_copy(day) if cfg.dedupe else day
