"""Settings of the fraud rules and of the plans that evaluate them."""

from __future__ import annotations

from dataclasses import dataclass

# Reason codes, default thresholds and weights of the three rules.
HIGH_AMOUNT = "HIGH_AMOUNT"
VELOCITY = "VELOCITY"
GEO_ANOMALY = "GEO_ANOMALY"


@dataclass(frozen=True)
class FraudConfig:
    # HIGH_AMOUNT: amount strictly above this value (INR)
    high_amount: float = 500_000.0
    high_amount_weight: float = 0.5

    # VELOCITY: at least this many transactions in the trailing window, both ends included
    velocity_window_s: int = 300
    velocity_min_count: int = 3
    velocity_weight: float = 0.4

    # GEO_ANOMALY: farther than this from the previous transaction, within this time
    geo_distance_km: float = 500.0
    geo_window_s: int = 1800
    geo_weight: float = 0.6

    # True: a day never looks at another day's rows (input must have a ``dt`` column).
    isolate_days: bool = False
    # Day job only: also read the end of the previous day so bursts survive midnight.
    lookback: bool = False
    # Keep one row per transaction_id before scoring.
    dedupe: bool = False
    # Rows without an account are never compared with each other.
    exempt_null_accounts: bool = False

    # Accounts with more rows than this are scored in ranges of about so many rows (None: never).
    slice_rows: int | None = 500_000
