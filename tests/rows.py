"""Hand-made transactions."""

from __future__ import annotations

import datetime as dt

START = dt.datetime(2024, 1, 1, 12, 0, 0)
DELHI = (28.6139, 77.2090)
MUMBAI = (19.0760, 72.8777)
PUNE = (18.5204, 73.8567)

SCHEMA = (
    "transaction_id STRING, account_id STRING, event_timestamp TIMESTAMP_NTZ, amount DOUBLE, merchant_id STRING, "
    "merchant_cat STRING, location_lat DOUBLE, location_lon DOUBLE, channel STRING, is_fraud_label BOOLEAN, dt STRING"
)


def txn(number, second, *, account="A", amount=100.0, at=DELHI, channel="POS", start=START):
    when = start + dt.timedelta(seconds=second)
    lat, lon = at
    return (f"t{number:04d}", account, when, amount, "M", "C", lat, lon, channel, False, when.date().isoformat())


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def by_id(df, *columns):
    """Values of ``columns`` by transaction_id, a single column unwrapped."""
    out = {}
    for r in df.select("transaction_id", *columns).collect():
        values = tuple(r[c] for c in columns)
        out[r["transaction_id"]] = values[0] if len(columns) == 1 else values
    return out
