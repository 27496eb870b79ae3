"""The registered queries as SQL over the same test tables."""

from __future__ import annotations

PAYLOAD = (
    "step, type, amount, nameOrig, oldbalanceOrg, newbalanceOrig, nameDest, oldbalanceDest, "
    "newbalanceDest, isFraud, isFlaggedFraud"
)

# Common table expressions, each building on the ones before it.
RAW = """
ev AS (
  SELECT event_id AS k, CAST(value AS DECIMAL(18,2)) AS amt, user_id, event_type,
         date_diff('hour', TIMESTAMP '2024-01-01 00:00:00', ts) + 1 AS hr
  FROM events
),
raw AS (
  SELECT k,
    CASE WHEN k % 211 = 7 THEN '0' WHEN k % 223 = 11 THEN '744' WHEN k % 227 = 13 THEN 'x1'
         ELSE CAST(hr AS VARCHAR) END AS step,
    CASE WHEN k % 229 = 17 THEN 'WIRE' WHEN event_type = 'click' THEN 'PAYMENT'
         WHEN event_type = 'view' THEN 'CASH_IN' WHEN event_type = 'signup' THEN 'DEBIT'
         WHEN event_type = 'purchase' THEN 'TRANSFER' WHEN event_type = 'error' THEN 'CASH_OUT'
         END AS type,
    CASE WHEN k % 233 = 19 THEN NULL WHEN k % 239 = 23 THEN '0.00' WHEN k % 241 = 29 THEN 'abc'
         WHEN k % 251 = 31 THEN '-' || CAST(amt AS VARCHAR) ELSE CAST(amt AS VARCHAR) END AS amount,
    CASE WHEN k % 257 = 37 THEN NULL ELSE 'C' || CAST(user_id AS VARCHAR) END AS nameOrig,
    CASE WHEN k % 263 = 41 THEN '-1.00'
         ELSE CAST(CAST(amt * 10 AS DECIMAL(18,2)) AS VARCHAR) END AS oldbalanceOrg,
    CASE WHEN k % 269 = 43 THEN '-1.00'
         ELSE CAST(CAST(amt * 9 AS DECIMAL(18,2)) AS VARCHAR) END AS newbalanceOrig,
    'M' || CAST((k * 7919) % 97 AS VARCHAR) AS nameDest,
    CASE WHEN k % 271 = 47 THEN '-1.00'
         ELSE CAST(k % 1000 AS VARCHAR) || '.00' END AS oldbalanceDest,
    CAST(CAST(k % 1000 + amt AS DECIMAL(18,2)) AS VARCHAR) AS newbalanceDest,
    CASE WHEN k % 277 = 53 THEN '2' WHEN k % 281 = 59 THEN NULL
         WHEN k % 20 = 3 AND event_type IN ('purchase', 'error') THEN '1' ELSE '0' END AS isFraud,
    CASE WHEN k % 293 = 67 THEN 'Y'
         WHEN k % 100 = 3 AND event_type IN ('purchase', 'error') THEN '1'
         WHEN k % 283 = 61 THEN '1' ELSE '0' END AS isFlaggedFraud
  FROM ev
)"""

BRONZE = f"""{RAW},
bronze AS (
  SELECT {PAYLOAD},
    CASE WHEN k % 307 = 71 OR k % 422 = 7 THEN NULL
         ELSE 1767225600000 + k * 1000 + copy * 60000 END AS kafka_timestamp
  FROM raw JOIN (VALUES (0), (1)) AS c(copy) ON copy = 0 OR k % 40 = 5
)"""

LABELLED = f"""{BRONZE},
labelled AS (
  SELECT *,
    CASE
      WHEN step IS NULL OR amount IS NULL OR nameOrig IS NULL OR type IS NULL OR nameDest IS NULL
        THEN 'parse_error'
      WHEN TRY_CAST(amount AS DOUBLE) IS NULL OR TRY_CAST(amount AS DOUBLE) <= 0
        THEN 'invalid_amount'
      WHEN TRY_CAST(step AS INTEGER) IS NULL OR TRY_CAST(step AS INTEGER) NOT BETWEEN 1 AND 743
        THEN 'invalid_step'
      WHEN type NOT IN ('PAYMENT', 'TRANSFER', 'CASH_OUT', 'CASH_IN', 'DEBIT')
        THEN 'invalid_type'
      WHEN isFraud NOT IN ('0', '1') OR isFlaggedFraud NOT IN ('0', '1') THEN 'invalid_flag'
      WHEN TRY_CAST(oldbalanceOrg AS DOUBLE) < 0 OR TRY_CAST(newbalanceOrig AS DOUBLE) < 0
        THEN 'negative_balance'
    END AS reject_reason
  FROM bronze
)"""

TYPED = f"""{LABELLED},
typed AS (
  SELECT
    sha256(nameOrig || '|' || step || '|' || type || '|' || amount || '|' || nameDest) AS row_id,
    CAST(step AS INTEGER) AS step,
    TIMESTAMP '2016-01-01 00:00:00' + to_hours(CAST(step AS BIGINT) - 1) AS tx_timestamp,
    CAST(TIMESTAMP '2016-01-01 00:00:00' + to_hours(CAST(step AS BIGINT) - 1) AS DATE) AS tx_date,
    kafka_timestamp,
    type,
    CAST(amount AS DECIMAL(18,2)) AS amount,
    nameOrig,
    CAST(oldbalanceOrg AS DECIMAL(18,2)) AS oldbalanceOrg,
    CAST(newbalanceOrig AS DECIMAL(18,2)) AS newbalanceOrig,
    nameDest,
    CAST(oldbalanceDest AS DECIMAL(18,2)) AS oldbalanceDest,
    CAST(newbalanceDest AS DECIMAL(18,2)) AS newbalanceDest,
    CAST(isFraud AS INTEGER) AS isFraud,
    CAST(isFlaggedFraud AS INTEGER) AS isFlaggedFraud,
    (isFraud = '1' AND isFlaggedFraud = '0') AS is_suspicious
  FROM labelled WHERE reject_reason IS NULL
)"""

SILVER = f"""{TYPED},
silver AS (
  SELECT * EXCLUDE (copy) FROM (
    SELECT *, row_number() OVER (
      PARTITION BY row_id
      ORDER BY kafka_timestamp NULLS LAST, isFraud NULLS LAST, isFlaggedFraud NULLS LAST,
               oldbalanceOrg NULLS LAST, newbalanceOrig NULLS LAST, oldbalanceDest NULLS LAST,
               newbalanceDest NULLS LAST) AS copy
    FROM typed)
  WHERE copy = 1
)"""

GOLD = f"""{SILVER},
undetected AS (
  SELECT * EXCLUDE (step, kafka_timestamp),
         CAST(oldbalanceOrg - newbalanceOrig AS DECIMAL(19,2)) AS orig_balance_drop,
         CAST(newbalanceDest - oldbalanceDest AS DECIMAL(19,2)) AS dest_balance_gain
  FROM silver WHERE is_suspicious
),
hourly AS (
  SELECT date_trunc('hour', tx_timestamp) AS tx_hour, type, COUNT(*) AS tx_count,
         CAST(SUM(amount) AS DECIMAL(28,2)) AS total_amount,
         COUNT(*) FILTER (WHERE isFraud = 1) AS fraud_count,
         COUNT(*) FILTER (WHERE is_suspicious) AS suspicious_count,
         CAST(SUM(CASE WHEN isFraud = 1 THEN amount ELSE 0 END) AS DECIMAL(28,2)) AS fraud_amount
  FROM silver GROUP BY 1, 2
),
accounts AS (
  SELECT nameOrig AS account_id, COUNT(*) AS total_tx_count,
         CAST(SUM(amount) AS DECIMAL(28,2)) AS total_amount,
         COUNT(*) FILTER (WHERE isFraud = 1) AS fraud_tx_count,
         COUNT(*) FILTER (WHERE is_suspicious) AS suspicious_tx_count,
         CAST(SUM(CASE WHEN isFraud = 1 THEN amount ELSE 0 END) AS DECIMAL(28,2)) AS fraud_amount,
         ROUND(CAST(COUNT(*) FILTER (WHERE isFraud = 1) AS DOUBLE) / COUNT(*) * 100, 2)
           AS fraud_rate_pct,
         MAX(tx_timestamp) AS last_tx_at
  FROM silver GROUP BY 1 HAVING COUNT(*) FILTER (WHERE isFraud = 1) > 0
)"""

DAYS = f"""{GOLD},
silver_days AS (
  SELECT tx_date, COUNT(*) AS silver_rows, COUNT(*) FILTER (WHERE isFraud = 1) AS fraud_rows,
         COUNT(*) FILTER (WHERE is_suspicious) AS suspicious_rows
  FROM silver GROUP BY 1
),
gold_days AS (SELECT tx_date, COUNT(*) AS gold_rows FROM undetected GROUP BY 1),
cast_bronze AS (
  SELECT TRY_CAST(step AS BIGINT) AS n, TRY_CAST(amount AS DOUBLE) AS paid,
         COALESCE(TRY_CAST(oldbalanceOrg AS DOUBLE), 0) AS opening,
         COALESCE(TRY_CAST(newbalanceOrig AS DOUBLE), 0) AS closing,
         concat_ws('|', nameOrig, step, type, amount, nameDest) AS payment, *
  FROM bronze
),
bronze_days AS (
  SELECT DATE '2016-01-01' + CAST((n - 1) // 24 AS INTEGER) AS tx_date,
         COUNT(DISTINCT payment) AS bronze_rows
  FROM cast_bronze
  WHERE n >= 1 AND n <= 743 AND paid > 0 AND LEAST(opening, closing) >= 0
    AND nameOrig || nameDest IS NOT NULL AND isFraud || isFlaggedFraud IN ('00', '01', '10', '11')
    AND list_contains(['CASH_IN', 'CASH_OUT', 'DEBIT', 'PAYMENT', 'TRANSFER'], type)
  GROUP BY 1
),
days AS (
  SELECT tx_date, COALESCE(bronze_rows, 0) AS bronze_rows, COALESCE(silver_rows, 0) AS silver_rows,
         COALESCE(fraud_rows, 0) AS fraud_rows, COALESCE(suspicious_rows, 0) AS suspicious_rows,
         COALESCE(gold_rows, 0) AS gold_rows,
         COALESCE(bronze_rows, 0) - COALESCE(silver_rows, 0) AS bs_diff,
         COALESCE(suspicious_rows, 0) - COALESCE(gold_rows, 0) AS sg_diff
  FROM silver_days FULL JOIN bronze_days USING (tx_date) FULL JOIN gold_days USING (tx_date)
)"""

CONFUSION = f"""{DAYS},
confusion AS (
  SELECT COUNT(*) FILTER (WHERE isFraud = 1) AS actual,
         COUNT(*) FILTER (WHERE isFlaggedFraud = 1) AS flagged,
         COUNT(*) FILTER (WHERE isFraud = 1 AND isFlaggedFraud = 1) AS true_positive,
         COUNT(*) FILTER (WHERE isFraud = 0 AND isFlaggedFraud = 1) AS false_positive,
         COUNT(*) FILTER (WHERE is_suspicious) AS false_negative
  FROM silver
),
quality AS (
  SELECT CASE WHEN flagged = 0 THEN 0.0 ELSE CAST(true_positive AS DOUBLE) / flagged END
           AS rule_precision,
         CASE WHEN actual = 0 THEN 0.0 ELSE CAST(true_positive AS DOUBLE) / actual END
           AS rule_recall
  FROM confusion
)"""

RUN_LOG = """
run_log AS (
  SELECT CAST(ts AS DATE) AS logical_date,
         CASE event_type WHEN 'purchase' THEN 'success' WHEN 'error' THEN 'failed'
              ELSE 'running' END AS state
  FROM events
),
runs AS (
  SELECT logical_date, COUNT(*) FILTER (WHERE state = 'success') AS success_runs,
         COUNT(*) FILTER (WHERE state = 'failed') AS failed_runs
  FROM run_log GROUP BY 1
)"""

# While the first run publishes, every asked day has one run that neither ended nor failed.
FIRST_RUN_LOG = """
runs AS (
  SELECT DATE '2016-01-01' + CAST(d AS INTEGER) AS logical_date, 0 AS success_runs, 0 AS failed_runs
  FROM range(31) AS g(d)
)"""


SILVER_COLUMNS = """SELECT row_id, step, tx_timestamp, tx_date, kafka_timestamp, type, amount,
  nameOrig, oldbalanceOrg, newbalanceOrig, nameDest, oldbalanceDest, newbalanceDest, isFraud,
  isFlaggedFraud, is_suspicious FROM silver"""

INGEST_DATE = "CAST(epoch_ms(kafka_timestamp) AS DATE)"
LANDED = f"SELECT {PAYLOAD}, kafka_timestamp, {INGEST_DATE} AS date FROM bronze"


def _json_fields(keep_nulls: bool) -> str:
    """JSON text of the payload fields; their values hold nothing that needs escaping."""
    names = PAYLOAD.split(", ")
    if keep_nulls:
        parts = [f"""'"{n}":' || COALESCE('"' || {n} || '"', 'null')""" for n in names]
    else:
        parts = [f"""'"{n}":"' || {n} || '"'""" for n in names]
    return f"'{{' || concat_ws(',', {', '.join(parts)}) || '}}'"


def _day_ms(column: str) -> str:
    return f"CAST(epoch_ms(CAST({column} AS TIMESTAMP)) AS VARCHAR)"


def _metrics(run_log: str | None = None) -> str:
    def plain(metric: str, value: str, source: str) -> str:
        return f"SELECT '{metric}' AS metric, '' AS label_value, CAST({value} AS DOUBLE) AS value FROM {source}"

    def labelled(metric: str, label: str, value: str, source: str) -> str:
        return (
            f"SELECT '{metric}' AS metric, {label} AS label_value, "
            f"CAST({value} AS DOUBLE) AS value FROM {source}"
        )

    days = "days WHERE silver_rows > 0"
    hour = "hourly GROUP BY tx_hour"
    kind = "hourly GROUP BY type"
    undetected = "(SELECT COUNT(*) AS n FROM undetected)"
    match = "CASE WHEN n = false_negative THEN 1.0 ELSE 0.0 END"
    parts = [
        plain("fraud_undetected_total", "n", undetected),
        plain("fraud_suspicious_total", "false_negative", "confusion"),
        plain("fraud_actual_total", "actual", "confusion"),
        plain("fraud_flagged_total", "flagged", "confusion"),
        plain("fraud_true_positive_total", "true_positive", "confusion"),
        plain("fraud_false_positive_total", "false_positive", "confusion"),
        plain("fraud_rule_precision", "rule_precision", "quality"),
        plain("fraud_rule_recall", "rule_recall", "quality"),
        plain("fraud_reconcile_match", match, f"confusion, {undetected}"),
        labelled("fraud_by_date_rows", _day_ms("tx_date"), "silver_rows", days),
        labelled("fraud_by_date_fraud", _day_ms("tx_date"), "fraud_rows", days),
        labelled("fraud_by_date_bs_diff", _day_ms("tx_date"), "bs_diff", days),
        labelled("fraud_by_date_sg_diff", _day_ms("tx_date"), "sg_diff", days),
        labelled("fraud_by_hour_tx", _day_ms("tx_hour"), "SUM(tx_count)", hour),
        labelled("fraud_by_hour_fraud", _day_ms("tx_hour"), "SUM(fraud_count)", hour),
        labelled("fraud_type_tx", "type", "SUM(tx_count)", kind),
        labelled("fraud_type_fraud", "type", "SUM(fraud_count)", kind),
        labelled("fraud_mule_recv_count", "nameDest", "recv_count", "receivers"),
        labelled("fraud_dagrun_success", _day_ms("logical_date"), "success_runs", "runs"),
        labelled("fraud_dagrun_failed", _day_ms("logical_date"), "failed_runs", "runs"),
    ]
    receivers = """receivers AS (
      SELECT nameDest, COUNT(*) AS recv_count FROM silver WHERE isFraud = 1
      GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10)"""
    return f"WITH {CONFUSION},{run_log or RUN_LOG},{receivers} " + " UNION ALL ".join(parts)


def _not_null(table: str, name: str, column: str) -> str:
    return f"""SELECT '{name}' AS table_name, 'not_null' AS check_name, '{column}' AS column_name,
      COUNT(*) AS failures, COUNT(*) AS failed_rows FROM {table} WHERE {column} IS NULL"""


def _unique(table: str, name: str, column: str) -> str:
    return f"""SELECT '{name}' AS table_name, 'unique' AS check_name, '{column}' AS column_name,
      COUNT(*) AS failures, CAST(COALESCE(SUM(n), 0) AS BIGINT) AS failed_rows
      FROM (SELECT {column}, COUNT(*) AS n FROM {table} WHERE {column} IS NOT NULL
            GROUP BY 1 HAVING COUNT(*) > 1)"""


def _values(table: str, name: str, column: str, values: str) -> str:
    return f"""SELECT '{name}' AS table_name, 'accepted_values' AS check_name,
      '{column}' AS column_name, COUNT(*) AS failures,
      CAST(COALESCE(SUM(n), 0) AS BIGINT) AS failed_rows
      FROM (SELECT {column}, COUNT(*) AS n FROM {table} WHERE {column} NOT IN ({values})
            GROUP BY 1)"""


def _ready(valid_only: bool) -> str:
    span = "TRY_CAST(step AS INTEGER) BETWEEN 1 AND 743" if valid_only else "TRUE"
    return f"""arrivals AS (
      SELECT CAST(TIMESTAMP '2016-01-01 00:00:00'
                  + to_hours(CAST(TRY_CAST(step AS INTEGER) AS BIGINT) - 1) AS DATE) AS tx_date
      FROM bronze WHERE TRY_CAST(step AS INTEGER) IS NOT NULL AND {span})"""


def _day_ready(valid_only: bool, done: bool = False) -> str:
    return f"""WITH {BRONZE}, {_ready(valid_only)}
      SELECT day_rows, later_rows, day_rows > 0 AND (later_rows > 0 OR {done}) AS ready
      FROM (SELECT COUNT(*) FILTER (WHERE tx_date = DATE '2016-01-30') AS day_rows,
                   COUNT(*) FILTER (WHERE tx_date > DATE '2016-01-30') AS later_rows
            FROM arrivals)"""


def _csv_fields() -> str:
    """Fields as they come back from a CSV file in which account names are quoted."""
    values = {name: name for name in PAYLOAD.split(", ")} | {"nameOrig": "'\"' || nameOrig || '\"'"}
    return ", ".join(f"COALESCE({value}, '') AS {name}" for name, value in values.items())


ORACLE: dict[str, str] = {
    "q_raw_csv": f"WITH {RAW} SELECT {_csv_fields()} FROM raw",
    "q_raw_csv_multiline": f"""WITH {RAW}, broken AS (SELECT * REPLACE (
        '"' || nameOrig || chr(10) || ',"' || chr(10) || type AS nameOrig) FROM raw)
        SELECT {", ".join(f"COALESCE({name}, '') AS {name}" for name in PAYLOAD.split(", "))} FROM broken""",
    "q_messages": f"WITH {RAW} SELECT nameOrig AS key, {_json_fields(True)} AS value FROM raw",
    "q_publish_resume": f"""WITH {RAW}, told AS (
        SELECT {", ".join(f"COALESCE({name}, '') AS {name}" for name in PAYLOAD.split(", "))} FROM raw)
        SELECT nameOrig AS key, {_json_fields(True)} AS value FROM told""",
    "q_first_days": f"""WITH {RAW} SELECT {PAYLOAD} FROM raw
        WHERE FLOOR((TRY_CAST(step AS INTEGER) - 1) / 24.0) < 3""",
    "q_stream_ingest": f"WITH {BRONZE} {LANDED}",
    "q_stream_roll": f"""WITH {BRONZE}, landed AS ({LANDED})
        SELECT date, COUNT(*) AS n, CAST(0 AS BIGINT) AS over_full FROM landed GROUP BY 1""",
    "q_bronze_scan": f"WITH {BRONZE} {LANDED}",
    "q_silver_by_type": f"""WITH {SILVER} SELECT type, COUNT(*) AS tx_count,
        CAST(SUM(amount) AS DECIMAL(28,2)) AS total_amount FROM silver GROUP BY 1""",
    "q_quarantine_table": f"""WITH {LABELLED} SELECT {INGEST_DATE} AS ingest_date, reject_reason,
        COUNT(*) AS n FROM labelled WHERE reject_reason IS NOT NULL GROUP BY 1, 2""",
    "q_gold_table": f"WITH {GOLD} SELECT * FROM accounts ORDER BY fraud_amount DESC, account_id",
    "q_metrics_table": _metrics(),
    "q_run_metrics": _metrics(FIRST_RUN_LOG),
    "q_panel_total_rows": f"WITH {SILVER} SELECT CAST(COUNT(*) AS DOUBLE) AS total_rows FROM silver",
    "q_panel_top_receivers": f"""WITH {SILVER} SELECT nameDest AS account,
        CAST(COUNT(*) AS DOUBLE) AS value FROM silver WHERE isFraud = 1
        GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""",
    "q_panel_runs": f"""WITH {RUN_LOG} SELECT {_day_ms("logical_date")} AS d_ms,
        CAST(success_runs AS DOUBLE) AS success_runs, CAST(failed_runs AS DOUBLE) AS failed_runs
        FROM runs""",
    "q_panel_last_success": "SELECT COUNT(*) >= 0 AS is_now FROM events",
    "q_run_day_by_day": f"WITH {SILVER} {SILVER_COLUMNS}",
    "q_reject_reasons": f"""WITH {LABELLED} SELECT COALESCE(reject_reason, 'valid') AS reason,
        COUNT(*) AS n FROM labelled GROUP BY 1""",
    "q_valid": f"""WITH {LABELLED} SELECT {PAYLOAD}, kafka_timestamp FROM labelled
        WHERE reject_reason IS NULL""",
    "q_quarantine": f"""WITH {LABELLED} SELECT kafka_timestamp, reject_reason,
        {INGEST_DATE} AS ingest_date FROM labelled WHERE reject_reason IS NOT NULL""",
    "q_quarantine_payload": f"""WITH {LABELLED} SELECT {_json_fields(False)} AS value,
        reject_reason FROM labelled WHERE reject_reason IS NOT NULL""",
    "q_silver": f"WITH {SILVER} {SILVER_COLUMNS}",
    "q_silver_day": f"WITH {SILVER} {SILVER_COLUMNS} WHERE tx_date = DATE '2016-01-05'",
    "q_dedup": f"""WITH {SILVER} SELECT row_id, tx_date, isFraud,
        kafka_timestamp AS first_seen_ms FROM silver""",
    "q_row_id": f"WITH {TYPED} SELECT row_id, COUNT(*) AS copies FROM typed GROUP BY 1",
    "q_undetected_fraud": f"WITH {GOLD} SELECT * FROM undetected",
    "q_hourly_summary": f"WITH {GOLD} SELECT * FROM hourly ORDER BY tx_hour, type",
    "q_account_risk": f"WITH {GOLD} SELECT * FROM accounts ORDER BY fraud_amount DESC, account_id",
    "q_gold_by_day_accounts": f"""WITH {GOLD} SELECT * FROM accounts
        ORDER BY fraud_amount DESC, account_id""",
    "q_gold_by_day_hours": f"WITH {GOLD} SELECT * FROM hourly ORDER BY tx_hour, type",
    "q_store_payments": f"WITH {SILVER} {SILVER_COLUMNS}",
    "q_store_repeated": f"""WITH {TYPED} SELECT 'row_id' AS column_name, COUNT(*) AS failures,
        CAST(COALESCE(SUM(n), 0) AS BIGINT) AS failed_rows
        FROM (SELECT row_id, COUNT(DISTINCT COALESCE(kafka_timestamp // 60000 % 2, 0)) AS n
              FROM typed GROUP BY 1) WHERE n > 1""",
    "q_store_merged": f"""WITH {SILVER} SELECT tx_date, COUNT(*) AS n,
        CAST(SUM(amount) AS DECIMAL(28,2)) AS total_amount FROM silver GROUP BY 1""",
    "q_gold_by_day_receivers": f"""WITH {SILVER} SELECT nameDest, COUNT(*) AS recv_count
        FROM silver WHERE isFraud = 1 GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""",
    "q_bronze_days": f"WITH {DAYS} SELECT * FROM bronze_days",
    "q_silver_by_date": f"WITH {DAYS} SELECT * FROM silver_days",
    "q_gold_by_date": f"WITH {DAYS} SELECT * FROM gold_days",
    "q_bronze_valid_by_date": f"WITH {DAYS} SELECT * FROM bronze_days",
    "q_by_hour": f"""WITH {GOLD} SELECT tx_hour, CAST(SUM(tx_count) AS BIGINT) AS tx_count,
        CAST(SUM(fraud_count) AS BIGINT) AS fraud_count FROM hourly GROUP BY 1""",
    "q_by_type": f"""WITH {GOLD} SELECT type, CAST(SUM(tx_count) AS BIGINT) AS tx_count,
        CAST(SUM(fraud_count) AS BIGINT) AS fraud_count FROM hourly GROUP BY 1""",
    "q_confusion": f"WITH {CONFUSION} SELECT * FROM confusion",
    "q_rule_quality": f"WITH {CONFUSION} SELECT * FROM quality",
    "q_conservation": f"""WITH {LABELLED} SELECT COUNT(*) AS bronze_rows,
        COUNT(*) FILTER (WHERE reject_reason IS NULL) AS valid_rows,
        COUNT(*) FILTER (WHERE reject_reason IS NOT NULL) AS quarantine_rows, TRUE AS conserved
        FROM labelled""",
    "q_run_summary": f"""WITH {SILVER},
        l AS (SELECT COUNT(*) AS bronze_rows,
                COUNT(*) FILTER (WHERE reject_reason IS NULL) AS valid_rows,
                COUNT(*) FILTER (WHERE reject_reason IS NOT NULL) AS quarantine_rows
              FROM labelled),
        s AS (SELECT COUNT(*) AS silver_rows,
                COUNT(*) FILTER (WHERE is_suspicious) AS suspicious_rows FROM silver)
        SELECT bronze_rows, valid_rows, quarantine_rows, valid_rows - silver_rows AS dedup_removed,
               silver_rows, suspicious_rows FROM l, s""",
    "q_mule_top_n": f"""WITH {SILVER} SELECT nameDest, COUNT(*) AS recv_count FROM silver
        WHERE isFraud = 1 GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""",
    "q_total_rows": f"""WITH {DAYS} SELECT CAST(SUM(silver_rows) AS BIGINT) AS total_rows
        FROM silver_days""",
    "q_undetected_total": f"WITH {GOLD} SELECT COUNT(*) AS undetected_total FROM undetected",
    "q_reconcile_by_date": f"WITH {DAYS} SELECT * FROM days",
    "q_reconcile_worst": f"""WITH {DAYS} SELECT MAX(ABS(bs_diff)) AS bs_diff_max,
        MAX(ABS(sg_diff)) AS sg_diff_max FROM days""",
    "q_reconcile_total": f"""WITH {GOLD},
        g AS (SELECT COUNT(*) AS gold_rows FROM undetected),
        s AS (SELECT COUNT(*) FILTER (WHERE is_suspicious) AS suspicious_rows FROM silver)
        SELECT gold_rows, suspicious_rows, gold_rows = suspicious_rows AS matches FROM g, s""",
    "q_expect_not_null": f"WITH {GOLD} "
    + " UNION ALL ".join(
        [
            _not_null("silver", "silver", "row_id"),
            _not_null("silver", "silver", "is_suspicious"),
            _not_null("undetected", "undetected_fraud", "row_id"),
            _not_null("hourly", "hourly_summary", "tx_hour"),
            _not_null("accounts", "account_risk", "account_id"),
            _not_null("accounts", "account_risk", "fraud_tx_count"),
        ]
    ),
    "q_expect_unique": f"WITH {GOLD} "
    + " UNION ALL ".join(
        [
            _unique("silver", "silver", "row_id"),
            _unique("undetected", "undetected_fraud", "row_id"),
            _unique("accounts", "account_risk", "account_id"),
        ]
    ),
    "q_expect_values": f"WITH {GOLD} "
    + " UNION ALL ".join(
        [
            _values(
                "silver", "silver", "type", "'PAYMENT','TRANSFER','CASH_OUT','CASH_IN','DEBIT'"
            ),
            _values("undetected", "undetected_fraud", "is_suspicious", "TRUE"),
            _values("undetected", "undetected_fraud", "type", "'CASH_OUT','TRANSFER'"),
        ]
    ),
    "q_day_ready": _day_ready(True),
    "q_day_ready_any_step": _day_ready(False),
    "q_day_ready_done": _day_ready(True, done=True),
    "q_ready_days": f"""WITH {BRONZE}, {_ready(True)}
        SELECT tx_date, COUNT(*) AS day_rows,
               tx_date < (SELECT MAX(tx_date) FROM arrivals) AS ready
        FROM arrivals GROUP BY 1""",
    "q_stream_ready_days": f"""WITH {BRONZE}, {_ready(True)}
        SELECT tx_date, COUNT(*) AS day_rows,
               tx_date < (SELECT MAX(tx_date) FROM arrivals) AS ready
        FROM arrivals GROUP BY 1""",
    "q_run_days": f"WITH {SILVER} {SILVER_COLUMNS}",
    "q_metrics": _metrics(),
    "q_runs_by_day": f"WITH {RUN_LOG} SELECT * FROM runs",
    "q_task_duration": """SELECT event_type AS task_id, ROUND(AVG(value), 6) AS mean_duration_s
        FROM events GROUP BY 1""",
    "q_failed_tasks": """SELECT COUNT(*) FILTER (WHERE event_type = 'error') AS failed_tasks
        FROM events""",
}
