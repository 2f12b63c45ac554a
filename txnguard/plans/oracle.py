"""DuckDB SQL for every registered query that has an SQL equivalent.

The fixture mapping and reference tables are written once as CTEs with the same
parameters as the Spark side (``FixtureSpec`` / ``ScoringConfig``). Doubles are
rounded to 6 places, counts are BIGINT and flags INTEGER on both sides.
"""

from __future__ import annotations

import re
from datetime import datetime

from txnguard.config import FixtureSpec, ModelConfig, ScoringConfig, duration_micros

SPEC = FixtureSpec()
CFG = SPEC.scoring()


def _ts(dt: datetime) -> str:
    return f"TIMESTAMP '{dt:%Y-%m-%d %H:%M:%S}'"


def _iv(text: str) -> str:
    return f"INTERVAL '{text}'"


def _d(x: float) -> str:
    return f"{x!r}::DOUBLE"


def src_cte(spec: FixtureSpec = SPEC, ms: bool = False) -> str:
    """events -> payment rows (same rules as sources.fixtures.transaction_source).
    ms=True truncates times to milliseconds, as the JSON wire format does."""
    et = "date_trunc('millisecond', ts)" if ms else "ts"
    it = f"date_trunc('millisecond', ts + to_seconds((event_id * 13) % 60))" if ms \
        else "ts + to_seconds((event_id * 13) % 60)"
    return f"""src AS (
  SELECT event_id, user_id, k,
    'TXN_' || lpad(event_id::VARCHAR, 9, '0') AS txn_id,
    'USER_' || lpad(user_id::VARCHAR, 6, '0') AS sender_id,
    'USER_' || lpad(((event_id * 31 + k) % (SELECT max(user_id) + 1 FROM events))::VARCHAR, 6, '0') AS receiver_id,
    value AS amount,
    (['VND', 'USD', 'EUR'])[k % 3 + 1] AS currency,
    event_type AS txn_type,
    (['APP', 'WEB', 'USSD'])[event_id % 3 + 1] AS channel,
    'DEV_' || (k + 1000)::VARCHAR AS device_id,
    (['ANDROID', 'IOS', 'BROWSER'])[(event_id // 3) % 3 + 1] AS device_type,
    '192.168.' || (k % 16)::VARCHAR || '.' || (user_id % 256)::VARCHAR AS ip_address,
    (1000 + (event_id * 37) % 1300)::DOUBLE / 100.0::DOUBLE AS lat,
    (10200 + (event_id * 53) % 750)::DOUBLE / 100.0::DOUBLE AS lon,
    'MER_' || (100 + (event_id * 7) % 900)::VARCHAR AS merchant_id,
    (['RETAIL', 'FOOD', 'TRAVEL', 'FINANCE', 'GAMING'])[event_id % 5 + 1] AS merchant_cat,
    {et} AS event_time,
    {it} AS ingest_time
  FROM (SELECT *, json_extract(props, '$.k')::BIGINT AS k FROM events) e)"""


def bl_users_cte(spec: FixtureSpec = SPEC) -> str:
    return f"""bl_users AS (
  SELECT 'USER_' || lpad(u::VARCHAR, 6, '0') AS entity_id, 'USER' AS entity_type,
         ((u // 10) % 5 + 1)::INTEGER AS severity
  FROM (SELECT DISTINCT user_id AS u FROM events
        WHERE user_id % {spec.blacklist_user_mod} = {spec.blacklist_user_rem}))"""


def bl_long_cte() -> str:
    return """bl_long AS (
  SELECT entity_id, entity_type, 'receiver_report' AS reason, severity,
         TIMESTAMP '2023-12-01 00:00:00' AS listed_at, NULL::TIMESTAMP AS expires_at FROM bl_users
  UNION ALL
  SELECT 'DEV_' || (k + 1000)::VARCHAR, 'DEVICE', 'chargeback', (k % 5 + 1)::INTEGER,
         TIMESTAMP '2024-01-01 00:00:00' + to_days((k % 10)::INTEGER),
         TIMESTAMP '2024-01-01 00:00:00' + to_days((k % 10)::INTEGER) + to_days(7)
  FROM (SELECT DISTINCT k FROM src WHERE k % 7 = 3)
  UNION ALL
  SELECT 'DEV_' || (k + 1000)::VARCHAR, 'DEVICE', 'device_farm', ((k + 2) % 5 + 1)::INTEGER,
         TIMESTAMP '2024-01-05 00:00:00' + to_days((k % 6)::INTEGER),
         TIMESTAMP '2024-01-05 00:00:00' + to_days((k % 6)::INTEGER) + to_days(10)
  FROM (SELECT DISTINCT k FROM src WHERE k % 7 = 3)
  UNION ALL
  SELECT '192.168.5.' || u4::VARCHAR, 'IP', 'proxy', (u4 % 5 + 1)::INTEGER,
         TIMESTAMP '2024-01-08 00:00:00' + to_days((u4 % 7)::INTEGER),
         TIMESTAMP '2024-01-08 00:00:00' + to_days((u4 % 7)::INTEGER) + to_days(6)
  FROM (SELECT DISTINCT user_id % 256 AS u4 FROM src WHERE k % 16 = 5))"""


def base_cte(spec: FixtureSpec = SPEC) -> str:
    return f"""base AS (
  SELECT sender_id AS user_id, avg(amount) AS avg_amount, stddev_samp(amount) AS stddev_amount
  FROM src WHERE event_time < {_ts(spec.history_before)}
    AND user_id % {spec.baseline_skip_mod} <> {spec.baseline_skip_rem}
  GROUP BY sender_id)"""


def dev_cte(spec: FixtureSpec = SPEC) -> str:
    return f"""dev AS (
  SELECT DISTINCT sender_id AS user_id, device_id FROM src
  WHERE event_time < {_ts(spec.history_before)} AND device_id IS NOT NULL)"""


def vel_cte(cfg: ScoringConfig = CFG, source: str = "src") -> str:
    w1 = f"PARTITION BY sender_id ORDER BY event_time RANGE BETWEEN {_iv(cfg.short_window)} PRECEDING AND CURRENT ROW"
    w2 = f"PARTITION BY sender_id ORDER BY event_time RANGE BETWEEN {_iv(cfg.long_window)} PRECEDING AND CURRENT ROW"
    return f"""vel AS (
  SELECT *, count(*) OVER w1 AS txn_count_1m, sum(amount) OVER w1 AS total_amount_1m,
         count(*) OVER w2 AS txn_count_10m, sum(amount) OVER w2 AS total_amount_10m,
         avg(amount) OVER w2 AS avg_amount_10m, stddev_samp(amount) OVER w2 AS stddev_amount_10m
  FROM {source} WINDOW w1 AS ({w1}), w2 AS ({w2}))"""


def feat_cte(spec: FixtureSpec = SPEC, score_from: datetime | None = SPEC.score_from) -> str:
    where = f"WHERE v.event_time >= {_ts(score_from)}" if score_from else ""
    return f"""feat AS (
  SELECT v.*, b.severity AS bl_receiver_severity, ba.avg_amount, ba.stddev_amount,
    CASE WHEN ba.stddev_amount > 0 THEN (v.amount - ba.avg_amount) / ba.stddev_amount ELSE 0.0::DOUBLE END AS amount_zscore,
    CASE WHEN d.device_id IS NULL THEN 1 ELSE 0 END AS is_new_device,
    hour(v.event_time) AS hour_of_day,
    CASE WHEN dayofweek(v.event_time) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend
  FROM vel v
  LEFT JOIN (SELECT entity_id, max(severity) AS severity FROM bl_users WHERE entity_type = 'USER' GROUP BY 1) b
    ON v.receiver_id = b.entity_id
  LEFT JOIN base ba ON v.sender_id = ba.user_id
  LEFT JOIN dev d ON v.sender_id = d.user_id AND v.device_id = d.device_id
  {where})"""


def rules_cte(cfg: ScoringConfig = CFG) -> str:
    w = cfg.weights
    z = _d(0.0)
    return f"""rul AS (
  SELECT *,
    CASE WHEN txn_count_1m >= {cfg.short_count_limit} THEN {_d(w.velocity)} ELSE {z} END AS r1_velocity,
    CASE WHEN bl_receiver_severity IS NOT NULL
         THEN (bl_receiver_severity / {_d(cfg.severity_scale)}) * {_d(w.blacklist)} ELSE {z} END AS r2_blacklist,
    CASE WHEN (amount > avg_amount * {_d(cfg.amount_ratio)}) OR (amount_zscore > {_d(cfg.zscore_limit)})
         THEN {_d(w.amount_anomaly)} ELSE {z} END AS r3_amount_anomaly,
    CASE WHEN is_new_device = 1 THEN {_d(w.new_device)} ELSE {z} END AS r4_new_device,
    CASE WHEN hour_of_day BETWEEN {cfg.odd_hour_from} AND {cfg.odd_hour_to} AND amount > {_d(cfg.large_amount)}
         THEN {_d(w.odd_hour)} ELSE {z} END AS r5_odd_hour,
    CASE WHEN txn_count_10m >= {cfg.long_count_limit} AND bl_receiver_severity IS NOT NULL
         THEN {_d(w.bl_velocity)} ELSE {z} END AS r6_bl_velocity
  FROM feat),
scored AS (
  SELECT *, r1_velocity + r2_blacklist + r3_amount_anomaly + r4_new_device + r5_odd_hour + r6_bl_velocity AS raw_rule_sum,
    least({_d(cfg.score_cap)}, r1_velocity + r2_blacklist + r3_amount_anomaly + r4_new_device + r5_odd_hour + r6_bl_velocity)
      AS fraud_rule_score,
    concat_ws('|', CASE WHEN r1_velocity > 0 THEN 'HIGH_VELOCITY' ELSE '-' END,
                   CASE WHEN r2_blacklist > 0 THEN 'BLACKLIST_RECEIVER' ELSE '-' END,
                   CASE WHEN r3_amount_anomaly > 0 THEN 'AMOUNT_ANOMALY' ELSE '-' END,
                   CASE WHEN r4_new_device > 0 THEN 'NEW_DEVICE' ELSE '-' END,
                   CASE WHEN r5_odd_hour > 0 THEN 'ODD_HOUR_LARGE_TXN' ELSE '-' END,
                   CASE WHEN r6_bl_velocity > 0 THEN 'HIGH_BL_VELOCITY' ELSE '-' END) AS rule_flags_text,
    ((r1_velocity > 0)::INTEGER + (r2_blacklist > 0)::INTEGER + (r3_amount_anomaly > 0)::INTEGER
     + (r4_new_device > 0)::INTEGER + (r5_odd_hour > 0)::INTEGER + (r6_bl_velocity > 0)::INTEGER) AS n_flags
  FROM rul)"""


def scoring_with(spec: FixtureSpec = SPEC, cfg: ScoringConfig = CFG, score_from: datetime | None = SPEC.score_from,
                 ms: bool = False, exclude_faults: bool = False) -> str:
    """Scored rows. exclude_faults: corrupted wire rows never reach velocity or
    scoring, while reference tables still come from every row."""
    scored_src = "src"
    parts = [src_cte(spec, ms)]
    if exclude_faults:
        parts.append(f"srcv AS (SELECT * FROM src WHERE event_id % {spec.fault_mod} <> 0)")
        scored_src = "srcv"
    parts += [bl_users_cte(spec), base_cte(spec), dev_cte(spec), vel_cte(cfg, scored_src),
              feat_cte(spec, score_from), rules_cte(cfg)]
    return "WITH " + ",\n".join(parts)


def label_sql() -> str:
    return "((amount > 120.0::DOUBLE) AND ((event_id * 17 + k) % 10 < 7))::INTEGER"


def sliding_sql(size: str, slide: str, suffix: str, full: bool, end_col: str,
                extra_where: str = "") -> str:
    size_us, slide_us = duration_micros(size), duration_micros(slide)
    n = -(-size_us // slide_us)
    aggs = [f"count(*)::BIGINT AS txn_count_{suffix}", f"round(sum(amount), 6) AS total_amount_{suffix}"]
    if full:
        aggs += [f"round(avg(amount), 6) AS avg_amount_{suffix}", f"round(stddev_samp(amount), 6) AS stddev_amount_{suffix}"]
    return f"""
SELECT sender_id, make_timestamp(ws + {size_us}) AS {end_col}, {', '.join(aggs)}
FROM (SELECT sender_id, amount, us, (us // {slide_us} - i) * {slide_us} AS ws
      FROM (SELECT sender_id, amount, epoch_us(event_time) AS us FROM src) s, range(0, {n}) t(i)) x
WHERE us >= ws AND us < ws + {size_us} {extra_where}
GROUP BY sender_id, ws"""


R6 = "round({0}, 6) AS {0}"


def _r(*cols: str) -> str:
    return ", ".join(R6.format(c) for c in cols)


def oracle_queries() -> dict[str, str]:
    spec, cfg = SPEC, CFG
    W = "WITH " + src_cte(spec)
    Wms = "WITH " + src_cte(spec, ms=True)
    hist = _ts(spec.history_before)
    q: dict[str, str] = {}

    q["q01_parse"] = f"""{Wms}
SELECT txn_id, sender_id, receiver_id, amount, currency, txn_type, channel, device_id, device_type,
       ip_address, lat, lon, merchant_id, merchant_cat, event_time, ingest_time,
       ts + to_seconds((event_id * 13) % 60) AS kafka_ts
FROM src JOIN (SELECT event_id AS eid, ts FROM events) e ON src.event_id = e.eid"""

    q["q02_rejects"] = f"""
SELECT CASE WHEN event_id % {spec.fault_mod} <> 0 THEN 'valid'
            WHEN (event_id // {spec.fault_mod}) % 4 IN (0, 3) THEN 'malformed'
            ELSE 'missing_required' END AS status,
       count(*)::BIGINT AS n_rows
FROM events GROUP BY 1"""

    q["q03_sliding_short"] = W + sliding_sql("1 minute", "30 seconds", "1m", False, "window_end")
    q["q04_sliding_long"] = W + sliding_sql("10 minutes", "1 minute", "10m", True, "window_end_10m")

    q["q05_blacklist_receiver"] = f"""WITH {src_cte(spec)}, {bl_users_cte(spec)}
SELECT t.txn_id, t.receiver_id, b.severity::INTEGER AS bl_receiver_severity
FROM src t LEFT JOIN (SELECT entity_id, max(severity) AS severity FROM bl_users
                      WHERE entity_type = 'USER' GROUP BY 1) b ON t.receiver_id = b.entity_id"""

    q["q06_blacklist_device_ip"] = f"""WITH {src_cte(spec)}, {bl_users_cte(spec)}, {bl_long_cte()}
SELECT t.txn_id,
  (SELECT max(severity) FROM bl_long b WHERE b.entity_type = 'DEVICE' AND b.entity_id = t.device_id)::INTEGER
    AS bl_device_severity,
  (SELECT max(severity) FROM bl_long b WHERE b.entity_type = 'IP' AND b.entity_id = t.ip_address)::INTEGER
    AS bl_ip_severity
FROM src t"""

    valid = "b.listed_at <= t.event_time AND (b.expires_at IS NULL OR t.event_time < b.expires_at)"
    q["q07_blacklist_validity"] = f"""WITH {src_cte(spec)}, {bl_users_cte(spec)}, {bl_long_cte()}
SELECT t.txn_id,
  (SELECT max(severity) FROM bl_long b WHERE b.entity_type = 'DEVICE' AND b.entity_id = t.device_id
     AND {valid})::INTEGER AS bl_device_severity,
  (SELECT max(severity) FROM bl_long b WHERE b.entity_type = 'IP' AND b.entity_id = t.ip_address
     AND {valid})::INTEGER AS bl_ip_severity
FROM src t"""

    q["q08_baseline_zscore"] = f"""WITH {src_cte(spec)}, {base_cte(spec)}
SELECT t.txn_id, {_r('avg_amount', 'stddev_amount')},
  round(CASE WHEN b.stddev_amount > 0 THEN (t.amount - b.avg_amount) / b.stddev_amount ELSE 0.0::DOUBLE END, 6)
    AS amount_zscore
FROM src t LEFT JOIN base b ON t.sender_id = b.user_id"""

    q["q09_build_baseline"] = f"""{W}
SELECT sender_id AS user_id, round(avg(amount), 6) AS avg_amount, round(stddev_samp(amount), 6) AS stddev_amount,
       count(*)::BIGINT AS n_txn
FROM src WHERE event_time < {hist} GROUP BY sender_id"""

    q["q09_baseline_refresh"] = q["q09_build_baseline"].replace("(amount), 6", "(amount) + 1e-9, 6")

    q["q10_new_device"] = f"""WITH {src_cte(spec)}, {dev_cte(spec)}
SELECT t.txn_id, CASE WHEN d.device_id IS NULL THEN 1 ELSE 0 END AS is_new_device
FROM src t LEFT JOIN dev d ON t.sender_id = d.user_id AND t.device_id = d.device_id"""

    q["q08_baseline_bucketed"], q["q10_device_bucketed"] = q["q08_baseline_zscore"], q["q10_new_device"]

    q["q11_build_device_history"] = f"""{W}
SELECT sender_id AS user_id, device_id, min(event_time) AS first_seen, count(*)::BIGINT AS n_txn
FROM src WHERE event_time < {hist} AND device_id IS NOT NULL GROUP BY 1, 2"""

    vel_out = f"""SELECT txn_id, txn_count_1m::BIGINT AS txn_count_1m, {_r('total_amount_1m')},
       txn_count_10m::BIGINT AS txn_count_10m, {_r('total_amount_10m', 'avg_amount_10m', 'stddev_amount_10m')}
FROM vel"""
    q["q12_trailing_velocity"] = f"WITH {src_cte(spec)}, {vel_cte(cfg)}\n{vel_out}"

    q["q13_self_velocity"] = f"""WITH {src_cte(spec)}, {base_cte(spec)}
SELECT t.txn_id, 1 AS txn_count_1m, round(t.amount, 6) AS total_amount_1m, 1 AS txn_count_10m,
       round(t.amount, 6) AS total_amount_10m, round(b.avg_amount, 6) AS avg_amount_10m,
       round(b.stddev_amount, 6) AS stddev_amount_10m
FROM src t LEFT JOIN base b ON t.sender_id = b.user_id"""

    wm_us = duration_micros(ScoringConfig().watermark)
    q["q14_stream_sliding_window"] = Wms + sliding_sql(
        "10 minutes", "1 minute", "10m", True, "window_end_10m",
        extra_where=f"AND ws + {duration_micros('10 minutes')} <= "
                    f"(SELECT max(epoch_us(event_time)) FROM src) - {wm_us}")

    q["q15_stream_trailing_velocity"] = f"WITH {src_cte(spec, ms=True)}, {vel_cte(cfg)}\n{vel_out}"

    hot = "srch AS (SELECT * REPLACE (CASE WHEN event_id % 3 = 0 THEN 'USER_HOT' ELSE sender_id END AS sender_id) FROM src)"
    settled = re.sub(r"round\((avg|stddev)_amount_10m", r"round(\1_amount_10m + 1e-9", vel_out)
    q["q15_stream_hot_sender"] = f"WITH {src_cte(spec, ms=True)}, {hot}, {vel_cte(cfg, 'srch')}\n{settled}"

    q["q17_stream_dedup"] = f"{Wms}\nSELECT txn_id, sender_id, amount, event_time FROM src"

    q["q16_lateness_report"] = f"""{W}
SELECT date_trunc('hour', event_time) AS hour_start, count(*)::BIGINT AS n_rows,
       sum(CASE WHEN delay > 30.0 THEN 1 ELSE 0 END)::BIGINT AS n_late,
       round(max(delay), 6) AS max_delay_seconds, round(avg(delay), 6) AS avg_delay_seconds
FROM (SELECT event_time, (epoch_us(ingest_time) - epoch_us(event_time))::DOUBLE / 1000000.0::DOUBLE AS delay FROM src)
GROUP BY 1"""

    q["q17_dedup"] = f"""{Wms}
SELECT txn_id, sender_id, amount, event_time,
       CASE WHEN event_id % {spec.duplicate_mod} = 0 THEN 2 ELSE 1 END::BIGINT AS n_copies
FROM src"""

    S = scoring_with(spec, cfg, score_from=None)
    q["q18_rule_components"] = f"""{S}
SELECT txn_id, {_r('r1_velocity', 'r2_blacklist', 'r3_amount_anomaly', 'r4_new_device', 'r5_odd_hour', 'r6_bl_velocity')}
FROM scored"""
    q["q19_rule_score"] = f"""{S}
SELECT txn_id, {_r('fraud_rule_score', 'raw_rule_sum')} FROM scored"""
    q["q20_rule_flags"] = f"""{S}
SELECT txn_id, rule_flags_text, n_flags::INTEGER AS n_flags FROM scored"""

    q["q21_calendar"] = f"""{W}
SELECT txn_id, hour(event_time)::INTEGER AS hour_of_day, (dayofweek(event_time) + 1)::INTEGER AS day_of_week,
       CASE WHEN dayofweek(event_time) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend
FROM src"""

    all_rows = scoring_with(spec, cfg, score_from=None)
    cut = _ts(spec.score_from)
    q["q22_split_class_weight"] = f"""{all_rows},
lab AS (SELECT CASE WHEN event_time < {cut} THEN 'train' ELSE 'test' END AS split, {label_sql()} AS isFraud FROM scored),
w AS (SELECT isFraud, count(*) AS n FROM lab WHERE split = 'train' GROUP BY 1),
tot AS (SELECT sum(n) AS total, count(*) AS classes FROM w)
SELECT l.split, l.isFraud, count(*)::BIGINT AS n_rows,
       round(any_value(tot.total::DOUBLE / (tot.classes * w.n)), 6) AS class_weight
FROM lab l LEFT JOIN w ON l.isFraud = w.isFraud CROSS JOIN tot
GROUP BY l.split, l.isFraud"""

    imp_rows = "\nUNION ALL ".join(
        f"SELECT '{c}' AS feature, count(*) - count({c}) AS n_missing, "
        f"quantile_disc({c}, 0.5)::DOUBLE AS surrogate FROM train" for c in ModelConfig().numeric_features)
    q["q23_imputed_columns"] = f"""{all_rows},
train AS (SELECT * FROM scored WHERE event_time < {cut}),
m AS ({imp_rows})
SELECT feature, n_missing::BIGINT AS n_missing, surrogate FROM m"""

    q["q23_impute"] = f"""{all_rows},
train AS (SELECT * FROM scored WHERE event_time < {cut}),
m AS ({imp_rows})
SELECT feature, round(surrogate, 6) AS surrogate FROM m"""

    test_rows = f"WITH {src_cte(spec)} SELECT txn_id, {{}} FROM src WHERE event_time >= {cut}"
    q["q27_fit_score"] = test_rows.format("1::INTEGER AS in_range, 1::INTEGER AS only_score_added")
    q["q28_save_load"] = test_rows.format("1::INTEGER AS same")
    q["q29_pr_auc_model"] = f"""{all_rows}
SELECT 1::INTEGER AS equals_evaluator, sum({label_sql()})::BIGINT AS n_pos, sum(1 - {label_sql()})::BIGINT AS n_neg
FROM scored WHERE event_time >= {cut}"""

    q["q24_index"] = f"""{all_rows},
train AS (SELECT * FROM scored WHERE event_time < {cut}),
c AS (SELECT 'txn_type' AS feature, txn_type AS value, count(*) AS n FROM train GROUP BY 2
      UNION ALL SELECT 'channel', channel, count(*) FROM train GROUP BY 2)
SELECT feature, value, (row_number() OVER (PARTITION BY feature ORDER BY n DESC, value) - 1)::DOUBLE AS idx,
       n::BIGINT AS n_rows
FROM c"""

    folds = [(0, datetime(2024, 1, 11), spec.score_from), (1, spec.score_from, datetime(2024, 1, 21))]
    fold_rows = "\nUNION ALL ".join(
        f"SELECT {i} AS fold, sum((event_time < {_ts(a)})::INTEGER)::BIGINT AS n_train, "
        f"sum((event_time >= {_ts(a)} AND event_time < {_ts(b)})::INTEGER)::BIGINT AS n_valid, "
        f"sum(CASE WHEN event_time >= {_ts(a)} AND event_time < {_ts(b)} THEN {label_sql()} ELSE 0 END)::BIGINT AS n_pos FROM src"
        for i, a, b in folds)
    q["q35_model_search"] = f"""{W}, f AS ({fold_rows})
SELECT setting, fold::INTEGER AS fold, n_train, n_valid, n_pos, 1::INTEGER AS in_range
FROM f, (VALUES ('stumps'), ('deeper')) s(setting)"""

    mc = ModelConfig()
    med_cols = ", ".join(f"quantile_disc({c}, 0.5) AS {c}" for c in mc.numeric_features)
    f_cols = [f"coalesce(t.{c}, med.{c})::DOUBLE AS f_{c}" for c in mc.numeric_features]
    f_cols += ["coalesce(it.idx, nt.n)::DOUBLE AS f_txn_type", "coalesce(ic.idx, nc.n)::DOUBLE AS f_channel"]
    pos_rows = "\nUNION ALL ".join(f"SELECT txn_id, '{c}' AS feature, round(f_{c}, 6) AS value FROM f"
                                   for c in (*mc.numeric_features, *mc.categorical_features))
    q["q25_assemble"] = f"""{all_rows},
train AS (SELECT * FROM scored WHERE event_time < {cut}),
test AS (SELECT * FROM scored WHERE event_time >= {cut}),
med AS (SELECT {med_cols} FROM train),
it AS (SELECT txn_type AS v, row_number() OVER (ORDER BY count(*) DESC, txn_type) - 1 AS idx FROM train
       WHERE txn_type IS NOT NULL GROUP BY 1),
ic AS (SELECT channel AS v, row_number() OVER (ORDER BY count(*) DESC, channel) - 1 AS idx FROM train
       WHERE channel IS NOT NULL GROUP BY 1),
nt AS (SELECT count(*) AS n FROM it),
nc AS (SELECT count(*) AS n FROM ic),
f AS (SELECT t.txn_id, {", ".join(f_cols)}
      FROM test t CROSS JOIN med CROSS JOIN nt CROSS JOIN nc
      LEFT JOIN it ON t.txn_type = it.v LEFT JOIN ic ON t.channel = ic.v)
{pos_rows}"""

    num = ModelConfig().numeric_features
    sev_m = "coalesce(bl_receiver_severity, (SELECT m FROM med))"
    cols = [(c, sev_m if c == "bl_receiver_severity" else c) for c in num]
    cols += [("txn_type", "ti"), ("channel", "ci")]
    std_rows = "\nUNION ALL ".join(
        f"SELECT '{name}' AS feature, round(stddev_samp(({expr})::DOUBLE), 6) AS std FROM f" for name, expr in cols)
    q["q26_scale"] = f"""{all_rows},
train AS (SELECT * FROM scored WHERE event_time < {cut}),
med AS (SELECT quantile_disc(bl_receiver_severity, 0.5) AS m FROM train),
it AS (SELECT txn_type AS v, row_number() OVER (ORDER BY count(*) DESC, txn_type) - 1 AS idx FROM train GROUP BY 1),
ic AS (SELECT channel AS v, row_number() OVER (ORDER BY count(*) DESC, channel) - 1 AS idx FROM train GROUP BY 1),
f AS (SELECT t.*, it.idx AS ti, ic.idx AS ci FROM train t JOIN it ON t.txn_type = it.v JOIN ic ON t.channel = ic.v)
{std_rows}"""

    q["q29_pr_auc"] = f"""{S},
lab AS (SELECT fraud_rule_score AS s, {label_sql()} AS y FROM scored),
pts AS (SELECT s, sum(y) AS tp, sum(1 - y) AS fp FROM lab GROUP BY s),
cum AS (SELECT tp, fp, sum(tp) OVER (ORDER BY s DESC ROWS UNBOUNDED PRECEDING) AS ctp,
               sum(fp) OVER (ORDER BY s DESC ROWS UNBOUNDED PRECEDING) AS cfp, sum(tp) OVER () AS p,
               sum(fp) OVER () AS n FROM pts),
pr AS (SELECT ctp::DOUBLE / p AS recall, (ctp - tp)::DOUBLE / p AS prev_recall,
              ctp::DOUBLE / (ctp + cfp) AS prec,
              CASE WHEN ctp - tp + cfp - fp = 0 THEN ctp::DOUBLE / (ctp + cfp)
                   ELSE (ctp - tp)::DOUBLE / (ctp - tp + cfp - fp) END AS prev_prec, p, n FROM cum)
SELECT round(sum((recall - prev_recall) * (prec + prev_prec) / 2.0::DOUBLE), 6) AS pr_auc,
       max(p)::BIGINT AS n_pos, max(n)::BIGINT AS n_neg FROM pr"""

    q["q30_alerts"] = f"""{S}
SELECT txn_id, sender_id, receiver_id, amount, txn_type, channel, bl_receiver_severity::INTEGER AS bl_receiver_severity,
       round(amount_zscore, 6) AS amount_zscore, is_new_device::INTEGER AS is_new_device,
       round(fraud_rule_score, 6) AS fraud_rule_score, NULL::DOUBLE AS ml_fraud_score,
       round(fraud_rule_score, 6) AS final_fraud_score, rule_flags_text AS rule_flags
FROM scored WHERE fraud_rule_score >= {_d(cfg.alert_threshold)}"""

    final = f"fraud_rule_score * {_d(cfg.rule_weight)} + ((event_id * 37) % 101)::DOUBLE / 100.0::DOUBLE * {_d(cfg.ml_weight)}"
    q["q30_alerts_blended"] = f"""{S}
SELECT txn_id, sender_id, receiver_id, amount, txn_type, channel, bl_receiver_severity::INTEGER AS bl_receiver_severity,
       round(amount_zscore, 6) AS amount_zscore, is_new_device::INTEGER AS is_new_device,
       round(fraud_rule_score, 6) AS fraud_rule_score,
       round(((event_id * 37) % 101)::DOUBLE / 100.0::DOUBLE, 6) AS ml_fraud_score,
       round({final}, 6) AS final_fraud_score, rule_flags_text AS rule_flags
FROM scored WHERE {final} >= {_d(cfg.alert_threshold)}"""

    Sx = scoring_with(spec, cfg, score_from=None, ms=True, exclude_faults=True)
    q["q31_alert_report"] = f"""{Sx},
al AS (SELECT * FROM scored WHERE fraud_rule_score >= {_d(cfg.alert_threshold)}),
fl AS (SELECT channel, unnest(string_split(rule_flags_text, '|')) AS flag FROM al)
SELECT flag, channel, count(*)::BIGINT AS n_alerts FROM fl WHERE flag <> '-' GROUP BY 1, 2"""

    q["q31_alert_listing"] = f"""{Sx}
SELECT txn_id, sender_id, receiver_id, amount, round(fraud_rule_score, 6) AS final_fraud_score,
       rule_flags_text AS rule_flags
FROM scored WHERE fraud_rule_score >= {_d(cfg.alert_threshold)}"""

    n_again = f"sum((event_id % {spec.duplicate_mod} = 0)::INTEGER)"
    n_kept = f"""sum((event_id % {spec.duplicate_mod} = 0 AND event_id % {spec.fault_mod} = 0
         AND (event_id // {spec.fault_mod}) % 4 IN (0, 3))::INTEGER)"""  # redelivered without an id: stay
    q["q16_progress_metrics"] = f"""SELECT (count(*) + {n_again})::BIGINT AS n_delivered, ({n_again} - {n_kept})::BIGINT AS n_redelivered,
       (count(*) + {n_kept})::BIGINT AS n_rows, 0::BIGINT AS n_batches_differ FROM events"""

    q["q31_alert_table"] = f"""{Sx}
SELECT strftime(event_time, '%Y-%m-%d') AS date, count(*)::BIGINT AS n_alerts, round(sum(amount), 6) AS total_amount
FROM scored WHERE fraud_rule_score >= {_d(cfg.alert_threshold)} GROUP BY 1"""

    # redelivered rejects without a transaction id cannot be told apart and stay
    rejects = f"""SELECT 'rejects', (count(*) + sum(CASE WHEN event_id % {spec.duplicate_mod} = 0
         AND (event_id // {spec.fault_mod}) % 4 IN (0, 3) THEN 1 ELSE 0 END))::BIGINT, NULL::DOUBLE
FROM events WHERE event_id % {spec.fault_mod} = 0"""
    q["q32_sink_readback"] = f"""{Sx}
SELECT CASE WHEN fraud_rule_score >= {_d(cfg.alert_threshold)} THEN 'alerts' ELSE 'safe' END AS sink,
       count(*)::BIGINT AS n_rows, round(sum(amount), 6) AS total_amount
FROM scored GROUP BY 1
UNION ALL
{rejects}"""

    # on-time rows never see the held-back ones; these see all
    parts = [src_cte(spec, True), f"srcv AS (SELECT * FROM src WHERE event_id % {spec.fault_mod} <> 0)",
             f"src_on AS (SELECT * FROM srcv WHERE event_id % {spec.late_mod} <> 0)",
             bl_users_cte(spec), base_cte(spec), dev_cte(spec),
             vel_cte(cfg, "srcv").replace("vel AS", "vel_all AS", 1), vel_cte(cfg, "src_on").replace("vel AS", "vel_on AS", 1),
             f"vel AS (SELECT * FROM vel_all WHERE event_id % {spec.late_mod} = 0 UNION ALL SELECT * FROM vel_on)",
             feat_cte(spec, None), rules_cte(cfg)]
    q["q16_late_rows_scored"] = "WITH " + ",\n".join(parts) + f"""
SELECT CASE WHEN fraud_rule_score >= {_d(cfg.alert_threshold)} THEN 'alerts' ELSE 'safe' END AS sink,
       count(*)::BIGINT AS n_rows, round(sum(amount), 6) AS total_amount
FROM scored GROUP BY 1
UNION ALL
{rejects}"""

    q["q32_model_stream"] = """SELECT 0::BIGINT AS n_stream_only, 0::BIGINT AS n_batch_only, 0::BIGINT AS n_different,
       (count(*) > 0)::INTEGER AS has_alerts FROM events"""

    q["q33_geo_velocity"] = f"""{W},
p AS (SELECT txn_id, lat, lon, epoch_us(event_time) AS us,
             lag(lat) OVER w AS plat, lag(lon) OVER w AS plon, lag(epoch_us(event_time)) OVER w AS pus
      FROM src WINDOW w AS (PARTITION BY sender_id ORDER BY event_time, txn_id)),
g AS (SELECT txn_id,
        2.0::DOUBLE * 6371.0::DOUBLE * asin(CASE WHEN sqrt(a) > 1.0 THEN 1.0::DOUBLE ELSE sqrt(a) END) AS distance_km,
        (us - pus)::DOUBLE / 1000000.0::DOUBLE AS gap_seconds
      FROM (SELECT *, pow(sin(radians(lat - plat) / 2), 2)
                      + cos(radians(plat)) * cos(radians(lat)) * pow(sin(radians(lon - plon) / 2), 2) AS a FROM p))
SELECT txn_id, round(distance_km, 6) AS distance_km, round(gap_seconds, 6) AS gap_seconds,
       round(CASE WHEN gap_seconds > 0 THEN distance_km / (gap_seconds / 3600.0::DOUBLE) END, 6) AS speed_kmh
FROM g"""

    q["q34_zscore_unit"] = f"""WITH {src_cte(spec)}, {base_cte(spec)}
SELECT t.txn_id, round((t.amount - b.avg_amount) / CASE WHEN b.stddev_amount = 0 THEN 1.0::DOUBLE
                                                       ELSE b.stddev_amount END, 6) AS amount_zscore_unit
FROM src t LEFT JOIN base b ON t.sender_id = b.user_id"""
    return q
