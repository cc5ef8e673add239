"""The seven reports over the curated tables.

Windows of days are counted back from ``as_of`` (default: today), and ties in an order are
broken by a key, so a report is reproducible.
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fraudlake.functions import days_before

Day = dt.date | str | None

REPORT_DAYS = 7


def daily_summary(summary: DataFrame, newest: int = 30) -> DataFrame:
    """Totals of the newest ``newest`` dates that have data."""
    return (
        summary.groupBy(F.col("dt").alias("txn_date"))
        .agg(*_totals(), _amount(F.sum("fraud_amount")), _rate_pct(F.sum("fraud_txn"), F.sum("total_txn")))
        .orderBy(F.desc("txn_date"))
        .limit(newest)
    )


def channel_rate(summary: DataFrame, as_of: Day = None, days: int = REPORT_DAYS) -> DataFrame:
    return (
        _recent(summary, as_of, days)
        .groupBy("channel")
        .agg(*_totals(), _rate_pct(F.sum("fraud_txn"), F.sum("total_txn")), _amount(F.sum("fraud_amount")))
        .orderBy(F.desc("fraud_rate_pct"), "channel")
    )


def fraud_type(alerts: DataFrame) -> DataFrame:
    return (
        alerts.groupBy(F.col("fraud_reason").alias("fraud_type"))
        .agg(
            F.count(F.lit(1)).alias("fraud_cnt"),
            F.round(F.sum("amount"), 0).alias("total_amount_INR"),
            F.round(F.avg("fraud_score"), 4).alias("avg_fraud_score"),
            F.round(F.max("amount"), 0).alias("max_amount_INR"),
        )
        .orderBy(F.desc("fraud_cnt"), "fraud_type")
    )


def hourly_heatmap(summary: DataFrame, as_of: Day = None, days: int = REPORT_DAYS) -> DataFrame:
    """Fraud count by day and hour; the rate is the plain mean of the channels' rates."""
    return (
        _recent(summary, as_of, days)
        .groupBy(F.col("dt").alias("txn_date"), F.col("hour").alias("hour_of_day"))
        .agg(
            F.sum("fraud_txn").alias("fraud_count"),
            F.round(F.avg("fraud_rate"), 4).alias("avg_fraud_rate_pct"),
        )
        .orderBy("txn_date", "hour_of_day")
    )


def top_accounts(alerts: DataFrame, top: int = 10) -> DataFrame:
    """Accounts with most alerts, with the set of their reasons: a few values, so one aggregate."""
    return (
        alerts.groupBy("account_id")
        .agg(*_account_totals(), F.sort_array(F.collect_set("fraud_reason")).alias("fraud_types"))
        .withColumn("fraud_amount_INR", F.round("_amount", 0))
        .orderBy(F.desc("fraud_count"), "account_id")
        .limit(top)
        .select("account_id", "fraud_count", "fraud_amount_INR", "first_fraud_at", "last_fraud_at", "fraud_types")
    )


def top_accounts_basic(alerts: DataFrame, top: int = 10) -> DataFrame:
    """``top_accounts`` without the reasons."""
    return (
        alerts.groupBy("account_id")
        .agg(*_account_totals())
        .select(
            "account_id",
            "fraud_count",
            F.round("_amount", 0).alias("fraud_amount_INR"),
            "first_fraud_at",
            "last_fraud_at",
        )
        .orderBy(F.desc("fraud_count"), "account_id")
        .limit(top)
    )


def latest_alerts(alerts: DataFrame, newest: int = 100) -> DataFrame:
    """The newest alerts. One run stamps all its alerts alike, so event time comes next."""
    return (
        alerts.orderBy(F.desc("alerted_at"), F.desc("event_timestamp"), "transaction_id", "fraud_reason")
        .limit(newest)
        .select(
            "alert_id",
            "transaction_id",
            "account_id",
            F.col("event_timestamp").alias("txn_timestamp"),
            F.col("amount").alias("amount_INR"),
            "channel",
            F.col("fraud_reason").alias("fraud_type"),
            "fraud_score",
            F.col("location_lat").alias("latitude"),
            F.col("location_lon").alias("longitude"),
            "alerted_at",
        )
    )


def kpi_day(transactions: DataFrame, as_of: Day = None) -> DataFrame:
    """One row of totals for the day ``as_of``."""
    fraud = F.count_if("is_fraud")
    return transactions.filter(F.col("dt") == days_before(as_of, 0)).agg(
        F.lit("TODAY").alias("period"),
        F.count(F.lit(1)).alias("total_txn"),
        # over no rows at all these are NULL, as sums are
        F.sum(F.col("is_fraud").cast("long")).alias("fraud_count"),
        _rate_pct(fraud, F.count(F.lit(1))),
        _amount(F.sum(F.when(F.col("is_fraud"), F.col("amount")).otherwise(0.0))),
    )


def run_reports(
    transactions: DataFrame, alerts: DataFrame, summary: DataFrame, as_of: Day = None
) -> dict[str, DataFrame]:
    """All reports by name; nothing runs until one is shown or written."""
    return {
        "daily_summary": daily_summary(summary),
        "channel_rate": channel_rate(summary, as_of),
        "fraud_type": fraud_type(alerts),
        "hourly_heatmap": hourly_heatmap(summary, as_of),
        "top_accounts": top_accounts(alerts),
        "latest_alerts": latest_alerts(alerts),
        "kpi_day": kpi_day(transactions, as_of),
    }


def _recent(summary: DataFrame, as_of: Day, days: int) -> DataFrame:
    return summary.filter(F.col("dt").between(days_before(as_of, days), days_before(as_of, 0)))


def _totals() -> list[Column]:
    return [F.sum("total_txn").alias("total_txn_count"), F.sum("fraud_txn").alias("fraud_count")]


def _account_totals() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("fraud_count"),
        F.sum("amount").alias("_amount"),
        F.min("event_timestamp").alias("first_fraud_at"),
        F.max("event_timestamp").alias("last_fraud_at"),
    ]


def _amount(total: Column) -> Column:
    return F.round(total, 0).alias("fraud_amount_INR")


def _rate_pct(part: Column, whole: Column) -> Column:
    """Percent to two places, divided as decimals; NULL when there is nothing to divide by."""
    rate = part * F.lit(Decimal("100.0")) / F.nullif(whole, F.lit(0))
    return F.round(rate, 2).cast("double").alias("fraud_rate_pct")
