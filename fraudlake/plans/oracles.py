"""DuckDB SQL for the registered queries, over the same tables, for checking results."""

from __future__ import annotations

from fraudlake.plans.queries import AS_OF, LATE_RUN_AT_TEXT, REPORT_DAY, RUN_AT_TEXT, SEED
from fraudlake.schemas import CURATED_TRANSACTIONS, FRAUD_ALERTS, FRAUD_SUMMARY, QUARANTINE, RAW_TRANSACTIONS, Table
from fraudlake.sources.lake import INGEST_BATCH
from fraudlake.sources.reference import CHANNELS, CITIES, MERCHANT_CATEGORIES
from fraudlake.synth import STATED_MODEL, seeds, stored
from fraudlake.synth.copula import CATEGORICAL, NUMERIC
from fraudlake.synth.patterns import HIGH_AMOUNTS, SAMPLE_SEED

_CITY_VALUES = ", ".join(f"({i}, '{c.name}', {c.lat}, {c.lon})" for i, c in enumerate(CITIES))

# Transactions as the bridge derives them from events.
TXN = f"""
cities AS (SELECT * FROM (VALUES {_CITY_VALUES}) AS c(city_id, city, lat, lon)),
placed AS (
  SELECT e.*, make_timestamp(1704067200000000 + ((epoch_us(e.ts) - 1704067200000000) // 10000000) * 1000000) AS moment,
         CAST(c.lat AS DOUBLE) AS lat, CAST(c.lon AS DOUBLE) AS lon
  FROM events e LEFT JOIN cities c ON c.city_id = TRY_CAST(json_extract_string(e.props, '$.k') AS INT) % 8
),
txn AS (
  SELECT CAST(event_id AS VARCHAR) AS transaction_id,
         CONCAT('ACC', CAST(10000 + user_id AS VARCHAR)) AS account_id,
         moment AS event_timestamp,
         CASE WHEN event_id % 97 = 0 THEN NULL ELSE ROUND(value * 3000, 2) END AS amount,
         CONCAT('MER', CAST(1000 + event_id % 9000 AS VARCHAR)) AS merchant_id,
         UPPER(event_type) AS merchant_cat,
         CASE WHEN event_id % 89 = 0 THEN NULL ELSE lat END AS location_lat,
         CASE WHEN event_id % 89 = 0 THEN NULL ELSE lon END AS location_lon,
         CASE event_id % 3 WHEN 0 THEN 'ONLINE' WHEN 1 THEN 'ATM' ELSE 'POS' END AS channel,
         event_id % 20 = 0 AS is_fraud_label,
         CAST(CAST(moment AS DATE) AS VARCHAR) AS dt
  FROM placed
),
raw AS (
  SELECT *, CAST(CAST(transaction_id AS BIGINT) % 6 AS INTEGER) AS kafka_partition,
         CAST(transaction_id AS BIGINT) // 6 AS kafka_offset
  FROM txn
)"""


def _history(source: str, keys: str, window_s: int = 300) -> str:
    return f"""
ordered AS (SELECT *, CAST(floor(epoch(event_timestamp)) AS BIGINT) AS ep FROM {source}),
history AS (
  SELECT *,
         COUNT(transaction_id) OVER (PARTITION BY {keys} ORDER BY ep
             RANGE BETWEEN {window_s} PRECEDING AND CURRENT ROW) AS txn_count_5min,
         LAG(location_lat) OVER w AS prev_lat, LAG(location_lon) OVER w AS prev_lon,
         LAG(event_timestamp) OVER w AS prev_ts, LAG(ep) OVER w AS prev_ep
  FROM ordered
  WINDOW w AS (PARTITION BY {keys} ORDER BY ep NULLS FIRST, event_timestamp NULLS FIRST, transaction_id NULLS FIRST)
)"""


def _km(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    hav = (
        f"(pow(sin(radians({lat2} - {lat1}) / 2), 2)"
        f" + cos(radians({lat1})) * cos(radians({lat2})) * pow(sin(radians({lon2} - {lon1}) / 2), 2))"
    )
    return f"2 * 6371.0 * asin(sqrt(CASE WHEN {hav} > 1 THEN 1 ELSE {hav} END))"


def _scored(source: str = "txn", keys: str = "account_id, dt", apart: bool = False) -> str:
    """CTEs up to ``scored``. ``apart``: rows without an account have no history."""
    exempt = "account_id IS NULL" if apart else "FALSE"
    return f"""{_history(source, keys)},
travelled AS (
  SELECT * EXCLUDE (txn_count_5min),
         CASE WHEN {exempt} THEN 1 ELSE txn_count_5min END AS txn_count_5min,
         CASE WHEN {exempt} THEN NULL ELSE {_km("prev_lat", "prev_lon", "location_lat", "location_lon")} END AS geo_distance_km,
         CASE WHEN {exempt} THEN NULL ELSE ep - prev_ep END AS time_diff_sec
  FROM history
),
flagged AS (
  SELECT *,
         COALESCE(amount > 500000, FALSE) AS fraud_flag_high_amount,
         txn_count_5min >= 3 AS fraud_flag_velocity,
         COALESCE(geo_distance_km > 500 AND time_diff_sec <= 1800 AND time_diff_sec > 0, FALSE)
             AS fraud_flag_geo_anomaly
  FROM travelled
),
scored AS (
  SELECT *,
         CONCAT_WS(',', CASE WHEN fraud_flag_high_amount THEN 'HIGH_AMOUNT' END,
                        CASE WHEN fraud_flag_velocity THEN 'VELOCITY' END,
                        CASE WHEN fraud_flag_geo_anomaly THEN 'GEO_ANOMALY' END) AS fraud_reasons,
         LEAST(CAST(1.0 AS DOUBLE),
               CAST(fraud_flag_high_amount AS DOUBLE) * CAST(0.5 AS DOUBLE)
             + CAST(fraud_flag_velocity AS DOUBLE) * CAST(0.4 AS DOUBLE)
             + CAST(fraud_flag_geo_anomaly AS DOUBLE) * CAST(0.6 AS DOUBLE)) AS fraud_score,
         fraud_flag_high_amount OR fraud_flag_velocity OR fraud_flag_geo_anomaly AS is_fraud
  FROM flagged
)"""


ALERTS = """
alerts AS (
  SELECT sha256(CONCAT_WS(':', transaction_id, reason, dt)) AS alert_id, transaction_id, account_id,
         event_timestamp, amount, channel, fraud_score, location_lat, location_lon, dt, reason AS fraud_reason
  FROM (SELECT *, UNNEST(string_split(fraud_reasons, ',')) AS reason FROM scored WHERE is_fraud)
  WHERE reason <> ''
)"""

SUMMARY = """
summary AS (
  SELECT CAST(hour(event_timestamp) AS INTEGER) AS hour, channel,
         COUNT(transaction_id) AS total_txn,
         COUNT(*) FILTER (is_fraud) AS fraud_txn,
         COALESCE(SUM(amount) FILTER (is_fraud), 0.0) AS fraud_amount,
         ROUND(AVG(CAST(is_fraud AS DOUBLE)) * 100, 4) AS fraud_rate,
         dt
  FROM scored GROUP BY dt, hour(event_timestamp), channel
)"""

SCORED_COLUMNS = """transaction_id, account_id, event_timestamp, amount, merchant_id, merchant_cat,
  location_lat, location_lon, channel, is_fraud_label, dt, txn_count_5min,
  ROUND(geo_distance_km, 4) AS geo_distance_km, CAST(time_diff_sec AS DOUBLE) AS time_diff_sec, fraud_flag_high_amount,
  fraud_flag_velocity, fraud_flag_geo_anomaly, fraud_reasons, fraud_score, is_fraud"""

RAW_COLUMNS = """transaction_id, account_id, event_timestamp, amount, merchant_id, merchant_cat,
  location_lat, location_lon, channel, is_fraud_label, kafka_offset, kafka_partition, dt"""

DAILY = f"WITH {TXN},{_scored()}"
ACROSS = f"WITH {TXN},{_scored(keys='account_id')}"
RATE = "ROUND(100 * CAST(SUM(fraud_txn) AS DOUBLE) / SUM(total_txn), 2) AS fraud_rate_pct"
TOTALS = "CAST(SUM(total_txn) AS BIGINT) AS total_txn_count, CAST(SUM(fraud_txn) AS BIGINT) AS fraud_count"
RECENT = f"dt BETWEEN CAST(DATE '{REPORT_DAY}' - 7 AS VARCHAR) AND '{REPORT_DAY}'"
ACCOUNT_TOTALS = """account_id, COUNT(*) AS fraud_count, ROUND(SUM(amount), 0) AS "fraud_amount_INR",
  MIN(event_timestamp) AS first_fraud_at, MAX(event_timestamp) AS last_fraud_at"""

_RAW = RAW_TRANSACTIONS._replace(fields=(*RAW_TRANSACTIONS.fields, INGEST_BATCH), partitions=(INGEST_BATCH.name, "dt"))
_SET_ASIDE = QUARANTINE._replace(fields=(*QUARANTINE.fields, INGEST_BATCH), partitions=(INGEST_BATCH.name,))
TABLES: dict[str, Table] = {
    "raw.transactions": _RAW,
    "raw.quarantine": _SET_ASIDE,
    "curated.transactions": CURATED_TRANSACTIONS,
    "curated.fraud_alerts": FRAUD_ALERTS,
    "curated.fraud_summary": FRAUD_SUMMARY,
}


def _catalog_columns() -> str:
    """Partition columns come last in a table, in the order they are declared."""
    rows = []
    for name, table in TABLES.items():
        ordered = [f for f in table.fields if f.name not in table.partitions]
        ordered += [f for p in table.partitions for f in table.fields if f.name == p]
        rows += [
            f"('{name}', {i}, '{f.name}', '{f.type.lower()}', {f.name in table.partitions})"
            for i, f in enumerate(ordered)
        ]
    return ", ".join(rows)


SEED_DRAWS = ("fraud", "city", "amount", "time", "lat", "lon", "account", "merchant", "category", "channel")


def _seed_rows() -> str:
    names = ", ".join(f"('{n}')" for n in SEED_DRAWS)
    uniforms = ", ".join(f"MAX(u) FILTER (WHERE draw = '{n}') AS {n}" for n in SEED_DRAWS)
    (a_low, a_high), (m_low, m_high) = seeds.ACCOUNTS, seeds.MERCHANTS
    (f_low, f_high), (u_low, u_high) = seeds.FRAUD_AMOUNT, seeds.USUAL_AMOUNT
    jitter = seeds.JITTER_DEGREES
    return f"""WITH drawn AS (
          SELECT event_id AS id, draw,
                 (CAST('0x' || substr(md5(event_id || ':{SEED}:' || draw), 1, 13) AS BIGINT) + 0.5::DOUBLE) * pow(2::DOUBLE, -52) AS u
          FROM events CROSS JOIN (VALUES {names}) AS n(draw)),
        wide AS (SELECT id, {uniforms} FROM drawn GROUP BY id),
        cities AS (SELECT * FROM (VALUES {_CITY_VALUES}) AS c(city_id, city_name, city_lat, city_lon))
        SELECT id,
               'ACC' || CAST({a_low} + floor(account * {a_high - a_low + 1}) AS BIGINT) AS account_id,
               make_timestamp(({seeds.FIRST_SECOND} + CAST(floor("time" * {seeds.SECONDS + 1}) AS BIGINT)) * 1000000) AS event_timestamp,
               ROUND(CASE WHEN fraud < {seeds.FRAUD_SHARE} THEN {f_low} + amount * {f_high - f_low}
                          ELSE {u_low} + amount * {u_high - u_low} END, 2) AS amount,
               'MER' || CAST({m_low} + floor(merchant * {m_high - m_low + 1}) AS BIGINT) AS merchant_id,
               {list(MERCHANT_CATEGORIES)}[CAST(1 + floor(category * {len(MERCHANT_CATEGORIES)}) AS INT)] AS merchant_cat,
               ROUND(CAST(city_lat AS DOUBLE) + (-{jitter} + lat), 6) AS location_lat,
               ROUND(CAST(city_lon AS DOUBLE) + (-{jitter} + lon), 6) AS location_lon,
               {list(CHANNELS)}[CAST(1 + floor(channel * {len(CHANNELS)}) AS INT)] AS channel,
               fraud < {seeds.FRAUD_SHARE} AS is_fraud
        FROM wide JOIN cities ON city_id = floor(city * {len(CITIES)})"""


def _uniform(name: str) -> str:
    """A draw for an event; name is a SQL expression."""
    return f"((CAST('0x' || substr(md5(event_id || ':{SEED}:' || {name}), 1, 13) AS BIGINT) + 0.5::DOUBLE) * pow(2::DOUBLE, -52))"


def _stated_sample() -> str:
    def value(v) -> str:
        if v is None:
            return "NULL"
        return f"CAST('{v}' AS DOUBLE)" if isinstance(v, float) else repr(v)

    tables = ", ".join(
        f"{name}({', '.join(c.split()[0] for c in stored.TABLES[name].split(', '))}) AS (VALUES "
        + ", ".join("(" + ", ".join(map(value, row)) + ")" for row in rows)
        + ")"
        for name, rows in stored.model_rows(STATED_MODEL).items()
    ).replace("start, end)", 'start, "end")')
    drawn = ", ".join(f"({j}, '{n}')" for j, n in enumerate(NUMERIC + CATEGORICAL))
    low, high = f"greatest(low, -{stored.FARTHEST})", f"least(high, {stored.FARTHEST})"
    (a_low, a_high), (m_low, m_high) = seeds.ACCOUNTS, seeds.MERCHANTS
    numbers = ", ".join(f"MAX(number) FILTER (WHERE name = '{n}') AS {n}" for n in NUMERIC)
    words = ", ".join(f"MAX(word) FILTER (WHERE name = '{n}') AS {n}" for n in CATEGORICAL)
    return f"""WITH {tables},
        drawn(draw, drawn_name) AS (VALUES {drawn}),
        normals AS (
          SELECT event_id, draw, sqrt(-2::DOUBLE * ln({_uniform("drawn_name || '/r'")})) * cos(2 * pi() * {_uniform("drawn_name || '/a'")}) AS v
          FROM events CROSS JOIN drawn),
        scores AS (
          SELECT event_id, name, SUM(v * weight) AS z FROM normals JOIN weights USING (draw) GROUP BY event_id, name),
        found AS (
          SELECT event_id, name, NULL AS word, CASE WHEN {_uniform("name || '/known'")} >= share THEN
                 start + greatest(0, least(1, (z - {low}) / ({high} - {low}))) * ("end" - start) END AS number
          FROM scores JOIN steps USING (name) JOIN missing USING (name) WHERE z >= low AND z < high
          UNION ALL
          SELECT event_id, name, value, NULL FROM scores JOIN categories USING (name) WHERE z >= low AND z < high),
        wide AS (SELECT event_id, md5('txn:{SEED}:' || event_id) AS digest, {numbers}, {words} FROM found GROUP BY event_id)
        SELECT CONCAT_WS('-', substr(digest, 1, 8), substr(digest, 9, 4), substr(digest, 13, 4), substr(digest, 17, 4),
                         substr(digest, 21, 12)) AS transaction_id,
               'ACC' || CAST({a_low} + floor({_uniform("'account'")} * {a_high - a_low + 1}) AS BIGINT) AS account_id,
               make_timestamp(CAST(floor(event_second) AS BIGINT) * 1000000) AS event_timestamp,
               ROUND(amount, 2) AS amount,
               'MER' || CAST({m_low} + floor({_uniform("'merchant'")} * {m_high - m_low + 1}) AS BIGINT) AS merchant_id,
               merchant_cat, ROUND(location_lat, 6) AS location_lat, ROUND(location_lon, 6) AS location_lon, channel,
               CAST(is_fraud AS BOOLEAN) AS is_fraud
        FROM wide"""


ORACLES: dict[str, str] = {
    "synth_seed": _seed_rows(),
    "synth_sample_from_model": _stated_sample(),
    "synth_category_shares": f"""WITH {TXN},
        total AS (SELECT COUNT(*) AS n FROM txn),
        shares AS (
        SELECT 'merchant_cat' AS column_name, merchant_cat AS "value", COUNT(*) / (SELECT n FROM total) AS share
        FROM txn GROUP BY merchant_cat
        UNION ALL SELECT 'channel', channel, COUNT(*) / (SELECT n FROM total) FROM txn GROUP BY channel
        UNION ALL SELECT 'is_fraud', CAST(is_fraud_label AS VARCHAR), COUNT(*) / (SELECT n FROM total)
        FROM txn GROUP BY is_fraud_label
        UNION ALL SELECT 'amount', 'NULL', COUNT(*) FILTER (WHERE amount IS NULL) / (SELECT n FROM total) FROM txn
        UNION ALL SELECT 'location_lat', 'NULL', COUNT(*) FILTER (WHERE location_lat IS NULL) / (SELECT n FROM total)
        FROM txn)
        SELECT column_name, "value", ROUND(share, 10) AS share FROM shares""",
    "ingest_parse_json": f"WITH {TXN} SELECT {RAW_COLUMNS} FROM raw",
    "ingest_available_now": f"WITH {TXN} SELECT {RAW_COLUMNS} FROM raw",
    "ingest_batch": f"WITH {TXN} SELECT {RAW_COLUMNS} FROM raw",
    "ingest_two_sources": f"WITH {TXN} SELECT {RAW_COLUMNS} FROM raw",
    "fold_raw_day": f"WITH {TXN} SELECT {RAW_COLUMNS} FROM raw",
    "csv_by_name": f"""WITH {TXN}
        SELECT account_id AS record_key, transaction_id, amount, merchant_cat,
               'said "so", once' AS note FROM txn""",
    "schema_evolution_tables": f"""{DAILY}
        SELECT transaction_id, dt, fraud_reasons, CASE WHEN dt > '{AS_OF}' THEN NULL END AS device FROM scored""",
    "synth_copula_checks": """SELECT check_name, CAST(0 AS BIGINT) AS failures FROM (VALUES
        ('quantile rank off by more than 0.02'), ('share differs'), ('null share differs'), ('correlation outside -1..1'),
        ('sample rows missing'), ('sample ids repeated'), ('sample values outside the quantiles')) AS c(check_name)""",
    "ingest_derive_dt": f"""WITH {TXN}
        SELECT transaction_id,
               CASE WHEN CAST(transaction_id AS BIGINT) % 71 = 0 THEN NULL ELSE event_timestamp END AS event_timestamp,
               CASE WHEN CAST(transaction_id AS BIGINT) % 71 = 0 THEN '{RUN_AT_TEXT[:10]}' ELSE dt END AS dt
        FROM txn""",
    "ingest_quarantine": f"""WITH {TXN},
        spoilt AS (
          SELECT account_id AS record_key, kafka_offset, kafka_partition,
                 CASE WHEN CAST(transaction_id AS BIGINT) % 53 = 0 THEN 'NOT_JSON'
                      WHEN CAST(transaction_id AS BIGINT) % 59 = 0 THEN 'NO_TRANSACTION_ID'
                      WHEN CAST(transaction_id AS BIGINT) % 61 = 0 THEN 'EMPTY'
                      WHEN CAST(transaction_id AS BIGINT) % 67 = 0 THEN 'EMPTY' END AS reason,
                 CAST(transaction_id AS BIGINT) % 61 = 0 AS blank
          FROM raw)
        SELECT record_key,
               CASE reason WHEN 'NOT_JSON' THEN 'not json'
                           WHEN 'NO_TRANSACTION_ID' THEN '{{"account_id":"ACC1"}}'
                           ELSE CASE WHEN blank THEN '' END END AS record_value,
               kafka_offset, kafka_partition, reason
        FROM spoilt WHERE reason IS NOT NULL""",
    "ingest_next_offsets": f"""WITH {TXN}
        SELECT kafka_partition AS "partition", MAX(kafka_offset) + 1 AS next_offset FROM raw GROUP BY kafka_partition""",
    "kafka_payload": f"""WITH {TXN}
        SELECT account_id AS record_key, kafka_partition, kafka_offset, transaction_id, account_id,
               strftime(event_timestamp, '%Y-%m-%dT%H:%M:%S') AS event_time, amount, merchant_id, merchant_cat,
               location_lat, location_lon, channel, is_fraud_label AS is_fraud
        FROM raw""",
    "csv_roundtrip": f"WITH {TXN} SELECT * FROM txn",
    "json_roundtrip": f"WITH {TXN} SELECT * FROM txn",
    "schema_evolution": f"""WITH {TXN}
        SELECT transaction_id, account_id, event_timestamp, amount, dt,
               CASE WHEN dt > '2024-01-01' THEN merchant_cat END AS merchant_cat,
               CASE WHEN dt > '2024-01-01' THEN location_lat END AS location_lat,
               CASE WHEN dt > '2024-01-01' THEN location_lon END AS location_lon,
               CASE WHEN dt > '2024-01-02' THEN channel END AS channel
        FROM txn""",
    "dim_city_coords": f"""WITH {TXN}
        SELECT CAST(COALESCE(c.city_id, -1) AS INTEGER) AS city_id, c.city, t.location_lat, t.location_lon, COUNT(*) AS txn_count
        FROM txn t LEFT JOIN cities c ON CAST(c.lat AS DOUBLE) = t.location_lat AND CAST(c.lon AS DOUBLE) = t.location_lon
        GROUP BY ALL""",
    "scan_raw_day": f"""WITH {TXN}
        SELECT * FROM txn WHERE dt = '{AS_OF}' AND transaction_id IS NOT NULL AND event_timestamp IS NOT NULL""",
    "rule_high_amount": f"""WITH {TXN}
        SELECT transaction_id, amount, COALESCE(amount > 500000, FALSE) AS fraud_flag_high_amount FROM txn""",
    "rule_velocity": f"{DAILY} SELECT transaction_id, txn_count_5min, fraud_flag_velocity FROM scored",
    "rule_velocity_custom": f"""WITH {TXN},{_history("txn", "account_id, dt", 3600)}
        SELECT transaction_id, txn_count_5min, txn_count_5min >= 2 AS fraud_flag_velocity FROM history""",
    "rule_geo_anomaly": f"""{DAILY}
        SELECT transaction_id, ROUND(geo_distance_km, 4) AS geo_distance_km, CAST(time_diff_sec AS DOUBLE) AS time_diff_sec, fraud_flag_geo_anomaly
        FROM scored""",
    "velocity_count": f"""WITH {TXN},{_history("txn", "account_id")}
        SELECT transaction_id, account_id, event_timestamp, txn_count_5min FROM history""",
    "prev_transaction": f"""WITH {TXN},{_history("txn", "account_id")}
        SELECT transaction_id, prev_lat, prev_lon, prev_ts FROM history""",
    "time_since_previous": f"""WITH {TXN},{_history("txn", "account_id")}
        SELECT transaction_id, CAST(ep - prev_ep AS DOUBLE) AS time_diff_sec FROM history""",
    "haversine_distance": f"""WITH {TXN}
        SELECT transaction_id,
               ROUND({_km("28.6139", "77.2090", "location_lat", "location_lon")}, 4) AS distance_km
        FROM txn""",
    "score_transactions": f"{DAILY} SELECT {SCORED_COLUMNS} FROM scored",
    "score_transactions_across_days": f"{ACROSS} SELECT {SCORED_COLUMNS} FROM scored",
    "score_transactions_hot_account": f"""WITH {TXN},
        hot AS (
          SELECT * REPLACE (CASE WHEN CAST(transaction_id AS BIGINT) % 3 = 0 THEN 'ACC_HOT'
                                 WHEN CAST(transaction_id AS BIGINT) % 11 <> 0 THEN account_id END AS account_id)
          FROM txn),{_scored("hot", "account_id")}
        SELECT {SCORED_COLUMNS} FROM scored""",
    "score_transactions_hot_second": f"""WITH {TXN},
        hot AS (
          SELECT * REPLACE (CASE WHEN CAST(transaction_id AS BIGINT) % 3 = 0 THEN 'ACC_HOT' ELSE account_id END AS account_id,
                            CASE WHEN CAST(transaction_id AS BIGINT) % 39 = 0 THEN NULL
                                 WHEN CAST(transaction_id AS BIGINT) % 3 = 0 THEN TIMESTAMP '{REPORT_DAY} 10:00:00'
                                 ELSE event_timestamp END AS event_timestamp)
          FROM txn),{_scored("hot", "account_id")}
        SELECT {SCORED_COLUMNS} FROM scored""",
    "late_rows_rerun": f"""{DAILY}
        SELECT dt, channel, CASE WHEN dt = '{REPORT_DAY}' THEN '{LATE_RUN_AT_TEXT}' ELSE '{RUN_AT_TEXT}' END AS processed_at,
               COUNT(*) AS row_count, ROUND(SUM(amount), 2) AS amount, COUNT(*) FILTER (is_fraud) AS fraud_count
        FROM scored GROUP BY dt, channel""",
    "score_transactions_null_accounts_apart": f"""WITH {TXN},
        partly AS (
          SELECT * REPLACE (CASE WHEN CAST(transaction_id AS BIGINT) % 5 <> 0 THEN account_id END AS account_id)
          FROM txn),{_scored("partly", "account_id", apart=True)}
        SELECT {SCORED_COLUMNS} FROM scored""",
    "dedupe_transactions": f"WITH {TXN} SELECT * FROM txn",
    "curated_transactions": f"""{DAILY}
        SELECT transaction_id, account_id, event_timestamp, amount, merchant_id, merchant_cat, location_lat,
               location_lon, is_fraud, fraud_reasons, dt, channel
        FROM scored""",
    "fraud_alerts": f"{DAILY},{ALERTS} SELECT * FROM alerts",
    "fraud_summary": f"{DAILY},{SUMMARY} SELECT * FROM summary",
    "detection_metrics": f"""{DAILY}
        SELECT COUNT(*) AS total_txn, COUNT(*) FILTER (WHERE is_fraud) AS fraud_txn,
               ROUND(AVG(CAST(is_fraud AS DOUBLE)) * 100, 4) AS fraud_rate_pct
        FROM scored""",
    "rerun_day_idempotent": f"""{DAILY},{ALERTS},{SUMMARY}
        SELECT 'transactions' AS table_name, dt, channel AS part, COUNT(*) AS row_count, ROUND(SUM(amount), 2) AS amount
        FROM scored GROUP BY dt, channel
        UNION ALL
        SELECT 'fraud_alerts', dt, fraud_reason, COUNT(*), ROUND(SUM(amount), 2) FROM alerts GROUP BY dt, fraud_reason
        UNION ALL
        SELECT 'fraud_summary', dt, channel, COUNT(*), ROUND(SUM(fraud_amount), 2) FROM summary GROUP BY dt, channel""",
    "ddl_bootstrap": f"""{DAILY},{ALERTS},{SUMMARY},
        held AS (
          SELECT 'raw.transactions' AS table_name, COUNT(*) AS n FROM txn
          UNION ALL SELECT 'raw.quarantine', 0
          UNION ALL SELECT 'curated.transactions', COUNT(*) FROM scored
          UNION ALL SELECT 'curated.fraud_alerts', COUNT(*) FROM alerts
          UNION ALL SELECT 'curated.fraud_summary', COUNT(*) FROM summary)
        SELECT CAST(1 AS INTEGER) AS step, 'loaded' AS "action", table_name, CAST(n AS BIGINT) AS row_count,
               TRUE AS table_exists FROM held
        UNION ALL SELECT 2, 'truncated', table_name, 0, TRUE FROM held
        UNION ALL SELECT 3, 'dropped', table_name, 0, FALSE FROM held""",
    "ddl_describe": f"""WITH {TXN},
        described AS (
          SELECT * FROM (VALUES {_catalog_columns()})
              AS c(table_name, "position", column_name, data_type, is_partition))
        SELECT table_name, CAST("position" AS INTEGER) AS "position", column_name, data_type, is_partition,
               CAST(CASE WHEN table_name = 'raw.transactions' THEN (SELECT COUNT(*) FROM txn) ELSE 0 END AS BIGINT)
                   AS row_count
        FROM described""",
    "readiness_report": f"""{DAILY},{ALERTS},{SUMMARY},
        held AS (
          SELECT 'raw rows' AS check_name, COUNT(*) AS "value" FROM txn
          UNION ALL SELECT 'raw rows without an id', COUNT(*) FILTER (transaction_id IS NULL) FROM txn
          UNION ALL SELECT 'records set aside', COUNT(*) FROM txn WHERE CAST(transaction_id AS BIGINT) % 43 = 0
          UNION ALL SELECT 'scored days without a summary', COUNT(DISTINCT dt) FROM scored WHERE dt NOT IN (SELECT dt FROM summary)
          UNION ALL SELECT 'alerts without a transaction', COUNT(*) FROM alerts WHERE transaction_id NOT IN (SELECT transaction_id FROM scored)
          UNION ALL SELECT 'transactions missing in the summary', COUNT(*) - (SELECT SUM(total_txn) FROM summary) FROM scored)
        SELECT check_name, CAST("value" AS BIGINT) AS "value",
               CASE check_name WHEN 'raw rows' THEN "value" > 0 WHEN 'records set aside' THEN TRUE ELSE "value" = 0 END AS passed
        FROM held""",
    "reports_over_tables": f"""{DAILY},{ALERTS},{SUMMARY}
        SELECT report, CAST(n AS BIGINT) AS row_count,
               CASE report WHEN 'kpi_day' THEN (SELECT ROUND(SUM(amount) FILTER (is_fraud), 0) FROM scored WHERE dt = '{REPORT_DAY}') END
                   AS "fraud_amount_INR"
        FROM (SELECT 'daily_summary' AS report, LEAST(30, COUNT(DISTINCT dt)) AS n FROM summary
              UNION ALL SELECT 'channel_rate', COUNT(DISTINCT channel) FROM summary WHERE {RECENT}
              UNION ALL SELECT 'fraud_type', COUNT(DISTINCT fraud_reason) FROM alerts
              UNION ALL SELECT 'hourly_heatmap', COUNT(DISTINCT dt || ' ' || hour) FROM summary WHERE {RECENT}
              UNION ALL SELECT 'top_accounts', LEAST(10, COUNT(DISTINCT account_id)) FROM alerts
              UNION ALL SELECT 'latest_alerts', LEAST(100, COUNT(*)) FROM alerts
              UNION ALL SELECT 'kpi_day', 1)""",
    "report_daily_summary": f"""{DAILY},{SUMMARY}
        SELECT dt AS txn_date, {TOTALS}, ROUND(SUM(fraud_amount), 0) AS "fraud_amount_INR", {RATE}
        FROM summary GROUP BY dt ORDER BY dt DESC LIMIT 30""",
    "report_channel_rate": f"""{DAILY},{SUMMARY}
        SELECT channel, {TOTALS}, {RATE}, ROUND(SUM(fraud_amount), 0) AS "fraud_amount_INR"
        FROM summary WHERE {RECENT} GROUP BY channel ORDER BY fraud_rate_pct DESC, channel""",
    "report_fraud_type": f"""{DAILY},{ALERTS}
        SELECT fraud_reason AS fraud_type, COUNT(*) AS fraud_cnt, ROUND(SUM(amount), 0) AS "total_amount_INR",
               ROUND(AVG(fraud_score), 4) AS avg_fraud_score, ROUND(MAX(amount), 0) AS "max_amount_INR"
        FROM alerts GROUP BY fraud_reason ORDER BY fraud_cnt DESC, fraud_type""",
    "report_hourly_heatmap": f"""{DAILY},{SUMMARY}
        SELECT dt AS txn_date, hour AS hour_of_day, CAST(SUM(fraud_txn) AS BIGINT) AS fraud_count,
               ROUND(AVG(fraud_rate), 4) AS avg_fraud_rate_pct
        FROM summary WHERE {RECENT} GROUP BY dt, hour ORDER BY dt, hour""",
    "report_top_accounts": f"""{DAILY},{ALERTS}
        SELECT {ACCOUNT_TOTALS}, array_to_string(list_sort(list(DISTINCT fraud_reason)), ',') AS fraud_types
        FROM alerts GROUP BY account_id ORDER BY fraud_count DESC, account_id LIMIT 10""",
    "report_top_accounts_basic": f"""{DAILY},{ALERTS}
        SELECT {ACCOUNT_TOTALS} FROM alerts GROUP BY account_id ORDER BY fraud_count DESC, account_id LIMIT 10""",
    "report_latest_alerts": f"""{DAILY},{ALERTS}
        SELECT alert_id, transaction_id, account_id, event_timestamp AS txn_timestamp, amount AS "amount_INR", channel,
               fraud_reason AS fraud_type, fraud_score, location_lat AS latitude, location_lon AS longitude
        FROM alerts ORDER BY event_timestamp DESC, transaction_id, fraud_reason LIMIT 100""",
    "report_kpi_day": f"""{DAILY}
        SELECT 'TODAY' AS period, COUNT(*) AS total_txn, COUNT(*) FILTER (is_fraud) AS fraud_count,
               ROUND(100 * AVG(CAST(is_fraud AS DOUBLE)), 2) AS fraud_rate_pct,
               ROUND(COALESCE(SUM(amount) FILTER (is_fraud), 0), 0) AS "fraud_amount_INR"
        FROM scored WHERE dt = '{REPORT_DAY}'""",
    "inject_patterns": f"""WITH {TXN},
        picks AS (
          SELECT transaction_id AS id, ROW_NUMBER() OVER (ORDER BY md5('{SAMPLE_SEED}:' || transaction_id), transaction_id) AS pick
          FROM txn QUALIFY pick <= 5),
        raised AS (
          SELECT t.transaction_id, t.account_id, t.event_timestamp,
                 COALESCE(CAST([{", ".join(str(a) for a in HIGH_AMOUNTS)}][p.pick] AS DOUBLE), t.amount) AS amount,
                 t.merchant_id, t.merchant_cat, t.location_lat, t.location_lon, t.channel,
                 p.id IS NOT NULL OR t.is_fraud_label AS is_fraud
          FROM txn t LEFT JOIN picks p ON p.id = t.transaction_id)
        SELECT * FROM raised
        UNION ALL
        SELECT 'ACC_FRAUD_VEL-' || i, 'ACC_FRAUD_VEL', TIMESTAMP '2024-06-15 14:00:00' + INTERVAL 1 MINUTE * i,
               20000.0, 'MER' || (7000 + i), 'ECOMMERCE', 28.6139, 77.2090, 'ONLINE', TRUE
        FROM range(3) r(i)
        UNION ALL VALUES
          ('ACC_FRAUD_GEO-0', 'ACC_FRAUD_GEO', TIMESTAMP '2024-07-01 10:00:00', 15000.0, 'MER8001', 'RESTAURANT',
           28.6139, 77.2090, 'POS', FALSE),
          ('ACC_FRAUD_GEO-1', 'ACC_FRAUD_GEO', TIMESTAMP '2024-07-01 10:10:00', 25000.0, 'MER8002', 'JEWELLERY',
           19.0760, 72.8777, 'POS', TRUE)""",
}
