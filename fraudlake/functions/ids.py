"""Identifiers that stay the same when a job runs again."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def alert_id(transaction_id: Column, reason: Column, day: Column) -> Column:
    return F.sha2(F.concat_ws(":", transaction_id, reason, day), 256)
