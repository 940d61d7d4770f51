"""The same results in DuckDB SQL, written on their own terms: direct joins and window functions where
the library uses sums, slices or buckets."""

from __future__ import annotations

READINGS = """
k_events AS (
  SELECT *, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events),
base AS (
  SELECT event_id AS reading_id, printf('sensor_%04d', user_id) AS device_id,
    CASE event_type WHEN 'click' THEN 'industrial_sensor' WHEN 'view' THEN 'hvac_monitor'
      WHEN 'error' THEN 'machinery_sensor' ELSE event_type END AS device_type,
    ts AS "timestamp", 9::DOUBLE + value / 4::DOUBLE AS temperature,
    round(k * k / 1200::DOUBLE, 3) AS vibration, event_type = 'error' AS true_anomaly,
    k, value, user_id
  FROM k_events),
readings AS (SELECT * EXCLUDE (k, value, user_id) FROM base),
clock AS (SELECT max(ts) AS as_of FROM events)"""

RULED = READINGS + """,
limits AS (
  SELECT *,
    CASE device_type WHEN 'hvac_monitor' THEN 15 WHEN 'machinery_sensor' THEN 12 ELSE 10 END AS t_min,
    CASE device_type WHEN 'hvac_monitor' THEN 30 WHEN 'machinery_sensor' THEN 40 ELSE 35 END AS t_max,
    CASE device_type WHEN 'hvac_monitor' THEN 3.0 WHEN 'machinery_sensor' THEN 8.0 ELSE 5.0 END AS v_max
  FROM readings),
marked AS (
  SELECT *, temperature < t_min OR temperature > t_max AS temp_anomaly, vibration > v_max AS vibration_anomaly,
    CASE WHEN temperature < t_min THEN concat('Temperature too low: ', temperature, '°C < ', t_min, '°C')
      WHEN temperature > t_max THEN concat('Temperature too high: ', temperature, '°C > ', t_max, '°C') END
      AS t_reason,
    CASE WHEN vibration > v_max THEN concat('Vibration too high: ', vibration, ' mm/s > ', v_max, ' mm/s') END
      AS v_reason
  FROM limits),
flagged AS (
  SELECT *, temp_anomaly OR vibration_anomaly AS is_anomaly,
    CASE WHEN temp_anomaly AND vibration_anomaly THEN 'critical'
      WHEN temp_anomaly OR vibration_anomaly THEN 'warning' ELSE 'normal' END AS anomaly_severity,
    CASE WHEN temp_anomaly AND vibration_anomaly THEN 1.0::DOUBLE
      WHEN temp_anomaly OR vibration_anomaly THEN 0.6::DOUBLE ELSE 0.0::DOUBLE END AS anomaly_score,
    concat_ws('|', t_reason, v_reason) AS reasons
  FROM marked)"""

WIDE = READINGS + """,
wide_base AS (
  SELECT reading_id, device_id, device_type, "timestamp", vibration,
    CASE WHEN reading_id % 97 = 0 THEN -999::DOUBLE WHEN reading_id % 13 = 0 THEN -60::DOUBLE + value
      ELSE temperature END AS temperature,
    k * 1.2::DOUBLE - 5::DOUBLE AS humidity, (780 + reading_id % 450)::DOUBLE AS pressure,
    CASE WHEN reading_id % 11 <> 0 THEN vibration END AS vibration_level,
    CASE WHEN reading_id % 7 <> 0 THEN value * 2::DOUBLE END AS power_consumption,
    substr('ABCD', CAST(user_id % 4 + 1 AS BIGINT), 1) AS zone,
    CASE user_id % 4 WHEN 0 THEN 'low' WHEN 1 THEN 'medium' WHEN 2 THEN 'high' END AS criticality
  FROM base),
points AS (
  SELECT *,
    0::DOUBLE + CASE WHEN temperature < -10 OR temperature > 40 THEN 0.3::DOUBLE ELSE 0::DOUBLE END
    + CASE WHEN temperature < -50 OR temperature > 60 THEN 0.5::DOUBLE ELSE 0::DOUBLE END
    + CASE WHEN humidity < 10 OR humidity > 90 THEN 0.2::DOUBLE ELSE 0::DOUBLE END
    + CASE WHEN humidity < 0 OR humidity > 100 THEN 0.4::DOUBLE ELSE 0::DOUBLE END
    + CASE WHEN pressure < 950 OR pressure > 1050 THEN 0.2::DOUBLE ELSE 0::DOUBLE END
    + CASE WHEN pressure < 800 OR pressure > 1200 THEN 0.4::DOUBLE ELSE 0::DOUBLE END AS added,
    temperature = -999 OR humidity = -1 OR pressure = 0 AS failed
  FROM wide_base),
scored AS (
  SELECT *, least(1::DOUBLE, CASE WHEN failed THEN 1::DOUBLE ELSE added END
    + CASE WHEN coalesce(vibration_level, 0) > 2 THEN 0.3::DOUBLE ELSE 0::DOUBLE END) AS anomaly_score
  FROM points)"""

# trend by regression, residuals joined back to the readings
FORECAST = READINGS + """,
span AS (
  SELECT as_of, as_of - INTERVAL 14 DAY AS train_start,
    date_trunc('hour', as_of - INTERVAL 23 HOUR) AS train_end,
    CAST(CAST(as_of - INTERVAL 14 DAY AS DATE) AS TIMESTAMP) AS origin FROM clock),
train AS (
  SELECT device_id, device_type, "timestamp", hour("timestamp") AS h, temperature AS y,
    (epoch_us("timestamp") - epoch_us(origin)) / 3600000000::DOUBLE AS t
  FROM readings, span WHERE "timestamp" >= train_start AND "timestamp" < train_end),
trend AS (
  SELECT device_id, regr_slope(y, t) AS b, regr_intercept(y, t) AS a,
    arg_max(device_type, "timestamp") AS own_type
  FROM train GROUP BY device_id),
residuals AS (
  SELECT train.*, a, b, own_type, y - a - b * t AS r FROM train JOIN trend USING (device_id)),
own_hours AS (SELECT device_id, h, count(*) AS n, avg(r) AS effect FROM residuals GROUP BY ALL),
type_hours AS (SELECT device_type AS own_type, h, avg(r) AS effect FROM residuals GROUP BY ALL),
effects AS (
  SELECT device_id, own_type, h, CASE WHEN n >= 3 THEN o.effect ELSE t.effect END AS effect
  FROM own_hours o JOIN trend USING (device_id) LEFT JOIN type_hours t USING (own_type, h)),
spread AS (
  SELECT device_id, sqrt(sum((r - coalesce(effect, 0)) ** 2) / (count(*) - 1)) AS deviation
  FROM residuals JOIN effects USING (device_id, h) GROUP BY device_id),
horizon AS (
  SELECT train_end + to_hours(i) AS hour_bucket, origin FROM span, range(24) AS steps(i)),
forecast AS (
  SELECT device_id, hour_bucket,
    a + b * ((epoch_us(hour_bucket) - epoch_us(origin)) / 3600000000::DOUBLE)
      + coalesce(e.effect, t.effect, 0) AS predicted, 1.959963984540054::DOUBLE * deviation AS reach
  FROM trend CROSS JOIN horizon JOIN spread USING (device_id)
  LEFT JOIN effects e ON e.device_id = trend.device_id AND e.h = hour(hour_bucket)
  LEFT JOIN type_hours t ON t.own_type = trend.own_type AND t.h = hour(hour_bucket)
  WHERE device_id IN (SELECT device_id FROM readings GROUP BY device_id HAVING count(*) > 60)),
hits AS (
  SELECT device_id, "timestamp", hour_bucket, temperature AS actual, predicted, reach,
    abs(temperature - predicted) AS error
  FROM readings JOIN forecast USING (device_id), clock
  WHERE date_trunc('hour', "timestamp") = hour_bucket AND "timestamp" >= as_of - INTERVAL 1 DAY
    AND abs(temperature - predicted) > 2),
forecast_anomalies AS (
  SELECT *,
    CASE WHEN abs(actual - predicted) > reach THEN 0.8::DOUBLE WHEN error > 5 THEN 0.6::DOUBLE
      WHEN error > 3 THEN 0.4::DOUBLE ELSE 0.2::DOUBLE END AS anomaly_score,
    CASE WHEN abs(actual - predicted) > reach THEN 'HIGH' WHEN error > 5 THEN 'MEDIUM'
      WHEN error > 3 THEN 'LOW' ELSE 'NORMAL' END AS anomaly_severity
  FROM hits)"""

MODELS = READINGS + """,
tops AS (SELECT max(vibration) AS v, max(temperature) AS t, max(k) AS k FROM base),
scored_models AS (
  SELECT reading_id, "timestamp", true_anomaly::INT AS y_true, 'vibration_rule' AS model_name, '1' AS model_version,
    (vibration > 5)::INT AS y_pred, vibration / tops.v AS score FROM base, tops
  UNION ALL SELECT reading_id, "timestamp", true_anomaly::INT, 'temperature_rule', '1',
    (temperature > 30)::INT, temperature / tops.t FROM base, tops
  UNION ALL SELECT reading_id, "timestamp", true_anomaly::INT, 'load_rule', '1',
    (base.k >= 80)::INT, base.k / tops.k FROM base, tops)"""


def metrics(table: str, by: str) -> str:
    """CTEs counts, areas, evaluated for a table with y_true, y_pred, score."""
    return f""",
counts AS (
  SELECT {by}, count(*) FILTER (y_true = 1 AND y_pred = 1) AS tp, count(*) FILTER (y_true = 0 AND y_pred = 1) AS fp,
    count(*) FILTER (y_true = 0 AND y_pred = 0) AS tn, count(*) FILTER (y_true = 1 AND y_pred = 0) AS fn,
    count(*) AS size
  FROM {table} GROUP BY {by}),
ranked AS (
  SELECT *, rank() OVER (PARTITION BY {by} ORDER BY score)
    + (count(*) OVER (PARTITION BY {by}, score) - 1) / 2::DOUBLE AS place FROM {table}),
areas AS (
  SELECT {by}, sum(y_true) AS p, count(*) - sum(y_true) AS q,
    sum(place) FILTER (y_true = 1) AS places FROM ranked GROUP BY {by}),
evaluated AS (
  SELECT {by}, tp, fp, tn, fn, size,
    CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END AS precision,
    CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END AS recall,
    CASE WHEN tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0 END AS f1_score,
    (tp + tn) / size AS accuracy,
    CASE WHEN fp + tn > 0 THEN fp / (fp + tn) ELSE 0 END AS false_positive_rate,
    CASE WHEN fn + tp > 0 THEN fn / (fn + tp) ELSE 0 END AS false_negative_rate,
    CASE WHEN p > 0 AND q > 0 THEN (places - p * (p + 1) / 2) / (p * q) ELSE 0 END AS auc_roc
  FROM counts JOIN areas USING ({by}))"""


METRICS = ("precision", "recall", "f1_score", "accuracy", "false_positive_rate", "false_negative_rate")

PERFORMANCE = MODELS + """,
daily AS (SELECT *, date_trunc('day', "timestamp")::TIMESTAMP AS evaluation_timestamp FROM scored_models)""" \
    + metrics("daily", "model_name, model_version, evaluation_timestamp") + """,
performance AS (
  SELECT * REPLACE (CASE WHEN day(evaluation_timestamp) % 2 = 1 THEN auc_roc END AS auc_roc),
    8000::BIGINT AS training_data_size, size::BIGINT AS evaluation_data_size
  FROM evaluated),
recent AS (
  SELECT * FROM performance WHERE evaluation_timestamp >=
    (SELECT max(evaluation_timestamp) FROM performance) - INTERVAL 30 DAY),
latest AS (
  SELECT model_name, max(evaluation_timestamp) AS evaluation_timestamp,
    arg_max(model_version, evaluation_timestamp) AS model_version,
    arg_max(training_data_size, evaluation_timestamp) AS training_data_size,
    arg_max(evaluation_data_size, evaluation_timestamp) AS evaluation_data_size,
    """ + ", ".join(f"arg_max({m}, evaluation_timestamp) FILTER ({m} IS NOT NULL) AS {m}"
                    for m in (*METRICS, "auc_roc")) + """
  FROM recent GROUP BY model_name)"""


def r(expr: str, name: str | None = None, digits: int = 6) -> str:
    return f"round({expr}, {digits}) + 0.0::DOUBLE AS {name or expr}"


def rs(*names: str) -> str:
    return ", ".join(r(n) for n in names)


def select(ctes: str, body: str) -> str:
    return f"WITH {ctes.strip()}\n{body.strip()}"


SER = 'WINDOW s AS (PARTITION BY device_id ORDER BY "timestamp", reading_id)'


def frame(rows: int) -> str:
    return ('(PARTITION BY device_id ORDER BY "timestamp", reading_id '
            f"ROWS BETWEEN {rows - 1} PRECEDING AND CURRENT ROW)")


VIEW = RULED + f""",
ranged AS (
  SELECT reading_id, device_id, device_type, "timestamp", temperature, vibration, is_anomaly AS label
  FROM flagged, clock WHERE "timestamp" >= as_of - INTERVAL 30 DAY),
training AS (
  SELECT *, temperature - lag(temperature) OVER s AS temp_change, vibration - lag(vibration) OVER s AS vibration_change,
    avg(temperature) OVER {frame(5)} AS temp_avg_5min, avg(vibration) OVER {frame(5)} AS vibration_avg_5min,
    stddev_samp(temperature) OVER {frame(10)} AS temp_stddev_10min,
    stddev_samp(vibration) OVER {frame(10)} AS vibration_stddev_10min
  FROM ranged {SER})"""

PAGE = RULED + f""",
page AS (
  SELECT reading_id, device_id, device_type, "timestamp", temperature, vibration, is_anomaly,
    (temperature - avg(temperature) OVER {frame(11)}) / nullif(stddev_samp(temperature) OVER {frame(11)}, 0) AS temp_z_score,
    (vibration - avg(vibration) OVER {frame(11)}) / nullif(stddev_samp(vibration) OVER {frame(11)}, 0) AS vibration_z_score
  FROM flagged, clock WHERE "timestamp" >= as_of - INTERVAL {{days}} DAY)"""

LADDER = ("CASE WHEN anomaly_score > 0.8 THEN 'HIGH' WHEN anomaly_score > 0.6 THEN 'MEDIUM' "
          "WHEN anomaly_score > 0.4 THEN 'LOW' ELSE 'NORMAL' END")

DETECTIONS = FORECAST + "," + RULED[len(READINGS):].strip().lstrip(",") + "," \
    + WIDE[len(READINGS):].strip().lstrip(",") + f""",
detections AS (
  SELECT device_id, "timestamp", anomaly_score, anomaly_severity, 'time_series_forecast' AS detection_method
  FROM forecast_anomalies
  UNION ALL SELECT device_id, "timestamp", anomaly_score, {LADDER}, 'threshold_rules' FROM flagged WHERE is_anomaly
  UNION ALL SELECT device_id, "timestamp", anomaly_score, {LADDER}, 'wide_rules' FROM scored WHERE anomaly_score > 0.4)"""

DISTANCES = READINGS + """,
far AS (
  SELECT reading_id, device_id, "timestamp",
    abs(temperature - 22::DOUBLE) + abs(vibration - 2::DOUBLE) AS distance_to_centroid FROM readings),
cuts AS (
  SELECT quantile_disc(distance_to_centroid, 0.95) AS p95, quantile_disc(distance_to_centroid, 0.99) AS p99 FROM far)"""

# the messages of the test table: the reading's number modulo 50 decides on the damage
MESSAGES = READINGS + """,
messages AS (
  SELECT *, reading_id % 50 AS damage, strftime("timestamp", '%Y-%m-%dT%H:%M:%S.%f') AS iso,
    'Building_' || substr('ABC', CAST(user_id % 3 + 1 AS BIGINT), 1) AS building, user_id % 10 + 1 AS floor,
    'Room_' || (user_id % 900 + 100) AS room FROM base),
parsed AS (
  SELECT CASE WHEN damage NOT IN (1, 5) THEN device_id END AS device_id,
    CASE WHEN damage NOT IN (1, 4) THEN "timestamp" END AS "timestamp",
    CASE WHEN damage = 4 THEN 'nope' WHEN damage <> 1 THEN iso END AS timestamp_text,
    CASE WHEN damage <> 1 THEN device_type END AS device_type, CASE WHEN damage <> 1 THEN building END AS building,
    CASE WHEN damage <> 1 THEN floor END AS floor, CASE WHEN damage <> 1 THEN room END AS room,
    CASE WHEN damage NOT IN (1, 2, 3) THEN temperature END AS temperature,
    CASE WHEN damage <> 1 THEN vibration END AS vibration, damage <> 1 AND true_anomaly AS is_anomaly,
    CASE damage WHEN 1 THEN 'malformed_json' WHEN 2 THEN 'missing_temperature' WHEN 3 THEN 'bad_type'
      WHEN 4 THEN 'bad_timestamp' WHEN 5 THEN 'missing_device_id' END AS reject_reason
  FROM messages)"""

RULED_MESSAGES = RULED + "," + MESSAGES[len(READINGS):].strip().lstrip(",") + """,
ruled AS (
  SELECT f.*, m.iso, m.building, m.floor, m.room FROM flagged f JOIN messages m USING (reading_id)
  WHERE m.damage NOT IN (1, 2, 3, 4, 5))"""

FLAGS = RULED + """,
flags AS (
  SELECT reading_id, true_anomaly::INT AS y_true, temp_anomaly::INT AS temperature_flag,
    vibration_anomaly::INT AS vibration_flag, (anomaly_severity = 'critical')::INT AS critical_flag FROM flagged),
voted AS (
  SELECT *, CASE WHEN (temperature_flag + vibration_flag + critical_flag) / 3 > 0.5 THEN 1 ELSE 0 END AS ensemble
  FROM flags),
long AS (
  SELECT y_true, model_name, y_pred, y_pred::DOUBLE AS score FROM voted
  UNPIVOT (y_pred FOR model_name IN (temperature_flag, vibration_flag, critical_flag, ensemble)))"""


def least_squares(target: str, other: str) -> str:
    """Ordinary least squares by taking one feature after another out of all later ones and of the
    target, with sums over the last 7 days; a prediction is the target less what is left of it."""
    types = ("industrial_sensor", "hvac_monitor", "machinery_sensor", "purchase")
    features = ["1::DOUBLE", *[f"(device_type = '{t}')::INT::DOUBLE" for t in types], 'hour("timestamp")::DOUBLE',
                '(dayofweek("timestamp") + 1)::DOUBLE', "temp_avg_5min", "vibration_avg_5min", other]
    ctes = VIEW + f""",
l0 AS (
  SELECT {', '.join(f'{x} AS x{i}' for i, x in enumerate(features))}, {target} AS y, reading_id, device_id, "timestamp",
    {target} AS truth, "timestamp" >= as_of - INTERVAL 7 DAY AS fits FROM training, clock)"""
    for i in range(len(features)):
        later = [f"x{j}" for j in range(i + 1, len(features))] + ["y"]
        ctes += f""",
l{i + 1} AS (
  SELECT {', '.join(f'{c} - x{i} * (sum({c} * x{i}) FILTER (fits) OVER () / sum(x{i} * x{i}) FILTER (fits) OVER ()) AS {c}'
                    for c in later)}, reading_id, device_id, "timestamp", truth, fits FROM l{i})"""
    return select(ctes, f"""
SELECT reading_id, device_id, "timestamp", {r('truth', target)}, {r('truth - y', f'predicted_{target}')}
FROM l{len(features)}""")


def histogram(ctes: str, table: str, column: str, by: str | None) -> str:
    cls = f"{by}, " if by else ""
    return select(ctes + f""",
ends AS (SELECT min({column}) AS lo, max({column}) AS hi FROM {table} WHERE {column} IS NOT NULL),
binned AS (
  SELECT {cls}least(29, floor(({column} - lo) / (hi - lo) * 30::DOUBLE))::INT AS bin, lo, hi
  FROM {table}, ends WHERE {column} IS NOT NULL)""", f"""
SELECT {cls}bin, count(*) AS readings, {r('lo + (hi - lo) * bin / 30::DOUBLE', 'bin_start')},
  {r('lo + (hi - lo) * (bin + 1) / 30::DOUBLE', 'bin_end')} FROM binned GROUP BY {cls}bin, lo, hi""")


def summary(days: int) -> str:
    return select(DETECTIONS, f"""
SELECT device_id, detection_method, count(*) AS anomaly_count, {r('avg(anomaly_score)', 'avg_anomaly_score')},
  {r('max(anomaly_score)', 'max_anomaly_score')},
  count(*) FILTER (anomaly_severity = 'HIGH') AS high_severity_count,
  count(*) FILTER (anomaly_severity = 'MEDIUM') AS medium_severity_count,
  count(*) FILTER (anomaly_severity = 'LOW') AS low_severity_count,
  min("timestamp") AS first_anomaly, max("timestamp") AS last_anomaly
FROM detections, clock WHERE "timestamp" >= as_of - INTERVAL {days} DAY
GROUP BY device_id, detection_method ORDER BY anomaly_count DESC, avg_anomaly_score DESC""")


REPORT_BEST = ", ".join(
    f"(SELECT model_name FROM recent WHERE {m} IS NOT NULL ORDER BY {m} DESC, model_name, model_version, "
    f"evaluation_timestamp LIMIT 1) AS best_{m}_model, (SELECT round(max({m}), 6) FROM recent) AS best_{m}"
    for m in ("f1_score", "precision", "recall"))


def build() -> dict[str, str]:
    from checks import learned  # which uses the tables above
    found = _plain() | learned.sql()
    # written and read back, or run as a stream: the rows are the same
    same = {"A2_message_batch": "B1_parse_messages", "A3_append_readings": "B9_format_reading",
            "A6_publish_alerts": "B10_format_alert", "A9_append_metrics": "D9_classification_metrics",
            "A11_model_registry": "J1_fit_temperature", "J7_members": "D1_device_profile", "S1_run_detection": "B9_format_reading",
            "S1_alerts": "B10_format_alert", "S6_ordered_features": "S6_stream_features", "S2_consume_and_score": "B11_rule_score"}
    return found | {name: found[other] for name, other in same.items()}


def above_quantile(rows: str, share: float) -> str:
    """How many of so many different values lie above their interpolated quantile."""
    return f"{rows} - 1 - floor({share}::DOUBLE * ({rows} - 1))::BIGINT"


def last_day_high(flagged: float | None, high: float) -> str:
    """Rows of the last day beyond the quantiles that are values of rows."""
    def beyond(share: float) -> str:
        return f"count(*) - ceil({share}::DOUBLE * count(*))::BIGINT"
    return select(WIDE, f"""
SELECT {beyond(flagged) if flagged else 'count(*)'} AS readings, {beyond(high)} AS high
FROM wide_base, clock WHERE "timestamp" >= as_of - INTERVAL 1 DAY""")


USABLE = """temp_avg_5min IS NOT NULL AND temp_stddev_10min > 0 AND vibration_stddev_10min > 0"""
FULL = "(SELECT coalesce(sum(greatest(c - 9, 0)), 0)::BIGINT AS m, sum(c)::BIGINT AS n FROM " \
       "(SELECT count(*) AS c FROM readings GROUP BY device_id))"


def _plain() -> dict[str, str]:
    s = 'reading_id, device_id, "timestamp"'
    lag = select(READINGS, f"""
SELECT reading_id, {r('temperature - lag(temperature) OVER s', 'temp_change')},
  {r('vibration - lag(vibration) OVER s', 'vibration_change')} FROM readings {SER}""")
    return {
        "A5_scan_range": select(READINGS, f"""
SELECT {s}, {r('temperature')} FROM readings, clock WHERE "timestamp" >= as_of - INTERVAL 7 DAY"""),
        "A5_past_range": select(READINGS, f"""
SELECT {s}, {r('temperature')} FROM readings
WHERE "timestamp" BETWEEN TIMESTAMP '2024-01-13' AND TIMESTAMP '2024-01-20'"""),
        "A8_register_view": select(READINGS, f"SELECT {s}, {r('temperature')} FROM readings"),
        "A10_export_csv": select(READINGS, f"SELECT reading_id, device_id, {r('temperature')} FROM readings"),
        "A12_quarantine": select(MESSAGES, """
SELECT reject_reason, count(*) AS messages FROM parsed WHERE reject_reason IS NOT NULL GROUP BY ALL"""),
        "A13_anomaly_subscription": select(RULED, f"""
SELECT {s}, {r('anomaly_score')}, anomaly_severity FROM flagged WHERE is_anomaly"""),
        "B1_parse_messages": select(MESSAGES, f"""
SELECT * REPLACE (round(temperature, 6) AS temperature, round(vibration, 6) AS vibration) FROM parsed"""),
        "B2_validate_required": select(MESSAGES, """
SELECT * EXCLUDE (reject_reason) REPLACE (round(temperature, 6) AS temperature, round(vibration, 6) AS vibration)
FROM parsed WHERE reject_reason IS NULL"""),
        "B3_detect_temperature": select(RULED, """
SELECT reading_id, temp_anomaly, coalesce(t_reason, '') AS reasons FROM flagged"""),
        "B4_detect_vibration": select(RULED, """
SELECT reading_id, vibration_anomaly, coalesce(v_reason, '') AS reasons FROM flagged"""),
        "B5_combine_flags": select(RULED, """
SELECT reading_id, is_anomaly AS anomaly_detected, anomaly_severity FROM flagged"""),
        "B6_merge_reasons": select(RULED, "SELECT reading_id, reasons FROM flagged"),
        "B7_flag_score": select(RULED, f"SELECT reading_id, {r('anomaly_score')} FROM flagged"),
        "B8_baseline_zscore": select(READINGS, f"""
SELECT reading_id, {r('(temperature - 22) / 5', 'temp_z_score')}, {r('(vibration - 2) / 1', 'vibration_z_score')}
FROM readings"""),
        "B9_format_reading": select(RULED_MESSAGES, f"""
SELECT device_id, device_type,
  concat('{{"building":"', building, '","floor":', floor, ',"room":"', room, '"}}') AS location, "timestamp",
  {r('temperature')}, {r('vibration', 'vibration_level')}, is_anomaly, anomaly_severity AS anomaly_type,
  {r('anomaly_score')},
  CASE WHEN is_anomaly THEN concat('["', replace(reasons, '|', '","'), '"]') ELSE '[]' END AS anomaly_reasons,
  anomaly_severity, temp_anomaly, vibration_anomaly, {r('(temperature - 22) / 5', 'temp_z_score')},
  {r('vibration - 2', 'vibration_z_score')} FROM ruled"""),
        "B10_format_alert": select(RULED_MESSAGES, f"""
SELECT device_id || '_' || iso AS alert_id, device_id, iso AS "timestamp", anomaly_severity AS severity,
  'Anomaly detected on device ' || device_id AS message, {rs('temperature', 'vibration')}, reasons, building
FROM ruled WHERE is_anomaly"""),
        "B11_rule_score": select(WIDE, f"""
SELECT reading_id, {r('anomaly_score')}, anomaly_score > 0.7 AS rule_based_anomaly FROM scored"""),
        "B12_encode_categories": select(WIDE, """
SELECT reading_id,
  CASE device_type WHEN 'environmental_sensor' THEN 1 WHEN 'industrial_sensor' THEN 2 WHEN 'smart_meter' THEN 3
    ELSE 0 END AS device_type_encoded,
  CASE zone WHEN 'A' THEN 1 WHEN 'B' THEN 2 WHEN 'C' THEN 3 ELSE 0 END AS zone_encoded,
  CASE criticality WHEN 'low' THEN 1 WHEN 'medium' THEN 2 WHEN 'high' THEN 3 ELSE 2 END AS criticality_encoded
FROM wide_base"""),
        "B13_coalesce_features": select(WIDE, f"""
SELECT reading_id, {r('coalesce(vibration_level, 0)', 'vibration_level')},
  {r('coalesce(power_consumption, 0)', 'power_consumption')} FROM wide_base"""),
        "B14_severity_ladder": select(WIDE, f"SELECT reading_id, {LADDER} AS anomaly_severity FROM scored"),
        "B15_device_filter": select(READINGS, f"SELECT {s} FROM readings WHERE contains(device_id, '_001')"),
        "B16_interaction_features": select(READINGS, """
SELECT reading_id, temperature / (vibration + 1e-8::DOUBLE) AS temp_vibration_ratio,
  temperature * vibration AS temp_vibration_product FROM readings"""),
        "B17_calendar_features": select(READINGS, """
SELECT reading_id, hour("timestamp")::INT AS hour_of_day, (dayofweek("timestamp") + 1)::INT AS day_of_week,
  dayofyear("timestamp")::INT AS day_of_year FROM readings"""),
        "B18_split_by_verdict": select(RULED, """
SELECT reading_id, CASE WHEN is_anomaly THEN 'anomaly' ELSE 'normal' END AS subset FROM flagged"""),
        "B19_zscore_flag": select(PAGE.format(days=30), """
SELECT reading_id, coalesce(abs(temp_z_score) > 2, false) AS temp_z_score_outside,
  coalesce(abs(vibration_z_score) > 2, false) AS vibration_z_score_outside FROM page"""),
        "C1_join_forecast": select(FORECAST, f"""
SELECT device_id, "timestamp", hour_bucket, {r('actual', 'actual_temperature')},
  {r('predicted', 'predicted_temperature')}, {r('error', 'prediction_error')} FROM hits"""),
        "C2_cross_scalar": select(READINGS, """
SELECT reading_id, round(temperature, 6) AS temperature, round(lo, 6) AS coldest, round(hi, 6) AS hottest,
  round(v, 6) AS strongest
FROM readings CROSS JOIN (SELECT min(temperature) AS lo, max(temperature) AS hi, max(vibration) AS v FROM readings)"""),
        "C3_devices_with_history": select(READINGS, f"""
SELECT {s} FROM readings, clock WHERE "timestamp" >= as_of - INTERVAL 14 DAY
  AND device_id IN (SELECT device_id FROM readings GROUP BY device_id HAVING count(*) > 60)"""),
        "C4_limits_lookup": select(RULED, """
SELECT reading_id, device_type, t_min::DOUBLE AS temp_min, t_max::DOUBLE AS temp_max, v_max::DOUBLE AS vibration_max
FROM limits"""),
        "D0_severity_counts": select(RULED, f"""
SELECT device_id, anomaly_severity, count(*) AS readings, {r('avg(anomaly_score)', 'avg_score')}
FROM flagged GROUP BY device_id, anomaly_severity"""),
        "D1_device_profile": select(READINGS, f"""
SELECT device_id, device_type, {r('avg(temperature)', 'avg_temperature', 8)}, {r('avg(vibration)', 'avg_vibration', 8)},
  {r('stddev_samp(temperature)', 'temp_variability', 8)}, {r('stddev_samp(vibration)', 'vibration_variability', 8)},
  count(*) AS reading_count
FROM readings, clock WHERE "timestamp" >= as_of - INTERVAL 7 DAY GROUP BY device_id, device_type"""),
        "D2_anomaly_summary": summary(1),
        "D3_distance_quantiles": select(DISTANCES, f"SELECT {rs('p95', 'p99')} FROM cuts"),
        "D4_kpis": select(RULED, f"""
SELECT count(*) AS total_readings, count(*) FILTER (is_anomaly) AS anomaly_count,
  {r('count(*) FILTER (is_anomaly) / count(*) * 100', 'anomaly_rate')},
  count(DISTINCT device_id) AS active_devices, {r('avg(temperature)', 'avg_temperature')} FROM flagged"""),
        "D5_device_stats": select(RULED, f"""
SELECT device_id, {', '.join(r(f'{f}({c})', f'{c}_{n}') for c in ('temperature', 'vibration')
                             for n, f in (('mean', 'avg'), ('std', 'stddev_samp'), ('min', 'min'), ('max', 'max')))},
  count(*) FILTER (is_anomaly) AS is_anomaly_sum FROM flagged GROUP BY device_id"""),
        "D6_histogram_temperature": histogram(RULED, "flagged", "temperature", "is_anomaly"),
        "D6_histogram_vibration": histogram(RULED, "flagged", "vibration", "is_anomaly"),
        "D6_histogram_zscore": histogram(PAGE.format(days=30), "page", "temp_z_score", None),
        "D7_temp_vibration_relation": select(RULED, f"""
SELECT is_anomaly, count(*) AS readings, {r('corr(temperature, vibration)', 'correlation')},
  {r('avg(temperature)', 'avg_temperature')}, {r('avg(vibration)', 'avg_vibration')}
FROM flagged GROUP BY is_anomaly"""),
        "D7_temp_vibration_grid": select(RULED, """
SELECT is_anomaly, floor(temperature / 5)::BIGINT AS temperature_cell, floor(vibration)::BIGINT AS vibration_cell,
  count(*) AS readings FROM flagged GROUP BY ALL"""),
        "D8_confusion": select(MODELS + metrics("scored_models", "model_name"),
                               "SELECT model_name, tp, fp, tn, fn FROM counts"),
        "D9_classification_metrics": select(MODELS + metrics("scored_models", "model_name"),
                                            f"SELECT model_name, {rs(*METRICS)} FROM evaluated"),
        "D10_auc_roc": select(MODELS + metrics("scored_models", "model_name"),
                              f"SELECT model_name, {r('auc_roc')} FROM evaluated"),
        "D11_latest_per_model": select(PERFORMANCE.replace(
            "FROM recent GROUP BY model_name", "FROM performance GROUP BY model_name"), f"""
SELECT model_name, model_version, evaluation_timestamp, training_data_size, evaluation_data_size,
  {rs(*METRICS, 'auc_roc')} FROM latest"""),
        "D12_performance_report": select(PERFORMANCE, f"""
SELECT count(*) AS models, (SELECT count(*) FROM recent) AS evaluations, {REPORT_BEST},
  concat_ws('|', CASE WHEN max(f1_score) < 0.7 THEN
      'Consider retraining models with more data or different hyperparameters.' END,
    CASE WHEN max(false_positive_rate) > 0.1 THEN
      'High false positive rate detected. Consider adjusting decision thresholds.' END,
    CASE WHEN max(false_negative_rate) > 0.2 THEN
      'High false negative rate detected. This could lead to missed anomalies.' END) AS advice
FROM latest HAVING count(*) > 0"""),
        "D13_class_report": select(MODELS + metrics("scored_models", "model_name") + """,
lines AS (
  SELECT model_name, '0' AS label, CASE WHEN tn + fn > 0 THEN tn / (tn + fn) ELSE 0 END AS p,
    CASE WHEN tn + fp > 0 THEN tn / (tn + fp) ELSE 0 END AS q,
    CASE WHEN tn + fp + fn > 0 THEN 2 * tn / (2 * tn + fp + fn) ELSE 0 END AS f, tn + fp AS support FROM counts
  UNION ALL
  SELECT model_name, '1', precision, recall, f1_score, tp + fn FROM evaluated)""", f"""
SELECT model_name, label, {r('p', 'precision')}, {r('q', 'recall')}, {r('f', 'f1_score')}, support::BIGINT AS support
FROM lines
UNION ALL SELECT model_name, 'macro avg', {r('avg(p)', 'precision')}, {r('avg(q)', 'recall')},
  {r('avg(f)', 'f1_score')}, sum(support)::BIGINT FROM lines GROUP BY model_name
UNION ALL SELECT model_name, 'weighted avg', {r('sum(p * support) / sum(support)', 'precision')},
  {r('sum(q * support) / sum(support)', 'recall')}, {r('sum(f * support) / sum(support)', 'f1_score')},
  sum(support)::BIGINT FROM lines GROUP BY model_name"""),
        "D14_anomaly_rate": select(FLAGS, f"""
SELECT model_name AS detector, {r('avg(y_pred)', 'anomaly_rate')} FROM long WHERE model_name <> 'ensemble'
GROUP BY model_name"""),
        "E1_change_features": lag,
        "E2_rolling_mean": select(READINGS, f"""
SELECT reading_id, {r(f'avg(temperature) OVER {frame(5)}', 'temp_avg_5')},
  {r(f'avg(vibration) OVER {frame(5)}', 'vibration_avg_5')} FROM readings"""),
        "E3_rolling_std": select(READINGS, f"""
SELECT reading_id, {r(f'stddev_samp(temperature) OVER {frame(10)}', 'temp_stddev_10')},
  {r(f'stddev_samp(vibration) OVER {frame(10)}', 'vibration_stddev_10')} FROM readings"""),
        "E4_training_view": select(VIEW, f"""
SELECT {s}, device_type, label, {rs('temperature', 'vibration', 'temp_change', 'vibration_change', 'temp_avg_5min',
                                   'vibration_avg_5min', 'temp_stddev_10min', 'vibration_stddev_10min')}
FROM training"""),
        "E5_training_zscore": select(VIEW, f"""
SELECT reading_id, {r('abs(temperature - temp_avg_5min) / nullif(temp_stddev_10min, 0)', 'temp_z_score')},
  {r('abs(vibration - vibration_avg_5min) / nullif(vibration_stddev_10min, 0)', 'vibration_z_score')}
FROM training WHERE temp_stddev_10min > 0 AND vibration_stddev_10min > 0"""),
        "E6_dashboard_zscore": select(PAGE.format(days=30), f"""
SELECT {s}, device_type, is_anomaly, {rs('temperature', 'vibration', 'temp_z_score', 'vibration_z_score')} FROM page"""),
        "E7_eps_features": select(READINGS + f""",
f AS (
  SELECT *, avg(temperature) OVER {frame(5)} AS tm, stddev_samp(temperature) OVER {frame(5)} AS td,
    avg(vibration) OVER {frame(5)} AS vm, stddev_samp(vibration) OVER {frame(5)} AS vd,
    temperature - lag(temperature) OVER s AS tc, vibration - lag(vibration) OVER s AS vc
  FROM readings {SER})""", f"""
SELECT {s}, {rs('temperature', 'vibration')}, {r('tm', 'temp_rolling_mean')}, {r('td', 'temp_rolling_std')},
  {r('vm', 'vibration_rolling_mean')}, {r('vd', 'vibration_rolling_std')}, {r('tc', 'temp_change')},
  {r('vc', 'vibration_change')}, {r('abs((temperature - tm) / (td + 1e-8::DOUBLE))', 'temp_z_score')},
  {r('abs((vibration - vm) / (vd + 1e-8::DOUBLE))', 'vibration_z_score')},
  temperature / (vibration + 1e-8::DOUBLE) AS temp_vibration_ratio,
  temperature * vibration AS temp_vibration_product FROM f"""),
        "E8_fill_gaps": select(WIDE + """,
ordered AS (SELECT * FROM wide_base)""", f"""
SELECT {s}, {', '.join(r(f'''coalesce(
  first_value({c} IGNORE NULLS) OVER (PARTITION BY device_id ORDER BY "timestamp", reading_id
    ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING),
  last_value({c} IGNORE NULLS) OVER (PARTITION BY device_id ORDER BY "timestamp", reading_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))''', c) for c in ('vibration_level', 'power_consumption'))}
FROM ordered"""),
        "E9_sequences": select(READINGS + f""",
seq AS (
  SELECT reading_id, list(temperature) OVER {frame(10)} AS ts, list(vibration) OVER {frame(10)} AS vs FROM readings)""",
                               f"""
SELECT reading_id, 10 AS steps, {r('ts[1]', 'first_temperature')},
  {r('list_sum([ts[i] * (2 * i - 1) + vs[i] * (2 * i) for i in range(1, 11)])', 'checksum')}
FROM seq WHERE len(ts) = 10"""),
        "F1_recent_anomalies": select(RULED, f"""
SELECT "timestamp", device_id, {rs('temperature', 'vibration')} FROM flagged WHERE is_anomaly
ORDER BY "timestamp" DESC, device_id LIMIT 10"""),
        "F2_raw_page": select(PAGE.format(days=1), f"""
SELECT {s}, device_type, is_anomaly, {rs('temperature', 'vibration', 'temp_z_score', 'vibration_z_score')} FROM page
ORDER BY "timestamp" DESC, device_id LIMIT 100"""),
        "F3_best_model": select(PERFORMANCE, f"""
SELECT model_name, model_version, evaluation_timestamp, {r('"precision"', '"precision"')} FROM recent
ORDER BY recent."precision" DESC, model_name, model_version, evaluation_timestamp LIMIT 1"""),
        "F4_compare_models": select(PERFORMANCE, f"""
SELECT model_name, model_version, evaluation_timestamp, {rs(*METRICS, 'auc_roc')} FROM performance
WHERE evaluation_timestamp >= (SELECT max(evaluation_timestamp) FROM performance) - INTERVAL 14 DAY
ORDER BY evaluation_timestamp DESC"""),
        "F5_order_summary": summary(7),
        "G1_unified_anomalies": select(DETECTIONS, f"""
SELECT device_id, "timestamp", {r('anomaly_score')}, anomaly_severity, detection_method FROM detections"""),
        "J1_fit_temperature": least_squares("temperature", "vibration"),
        "J2_fit_vibration": least_squares("vibration", "temperature"),
        "J3_gradient": select(VIEW, f"""
SELECT feature, count(*) AS readings, true AS is_optimal FROM training,
  unnest(['temperature', 'vibration', 'temp_change', 'vibration_change', 'temp_avg_5min', 'vibration_avg_5min',
    'temp_stddev_10min', 'vibration_stddev_10min', 'temp_z_score', 'vibration_z_score']) AS names(feature)
WHERE {USABLE} GROUP BY feature"""),
        "J5_confusion": select(VIEW, f"""
SELECT count(*) FILTER (label) AS positives, count(*) FILTER (NOT label) AS negatives FROM training, clock
WHERE {USABLE} AND "timestamp" >= as_of - INTERVAL 1 DAY"""),
        "J6_feature_names": select(VIEW, f"""
SELECT 'device_type=' || device_type AS feature FROM (
  SELECT device_type, row_number() OVER (ORDER BY count(*), device_type DESC) AS place FROM training
  WHERE {USABLE} GROUP BY device_type) WHERE place > 1
UNION ALL SELECT unnest(['temperature', 'vibration', 'temp_change', 'vibration_change', 'temp_avg_5min',
  'vibration_avg_5min', 'temp_stddev_10min', 'vibration_stddev_10min', 'temp_z_score', 'vibration_z_score'])"""),
        "J8_shares": last_day_high(0.95, 0.99),
        "J11_shares": last_day_high(None, 0.98),
        "J12_flagged": select(READINGS, f"""
SELECT count(*) AS readings, count(*) AS scored, {above_quantile('count(*)', 0.95)} AS flagged FROM readings"""),
        "J13_flagged": select(READINGS, """
SELECT count(*) AS readings, count(*) AS scored, ceil(0.05::DOUBLE * (count(*) - 1))::BIGINT AS flagged FROM readings"""),
        "J14_flagged": select(READINGS, f"""
SELECT n AS readings, m AS scored, {above_quantile('m', 0.95)} AS flagged FROM {FULL}"""),
        "J19_model_flags": select(READINGS, f"""
SELECT n AS readings, {above_quantile('n', 0.95)} AS isolation_forest,
  ceil(0.05::DOUBLE * (n - 1))::BIGINT AS one_class_boundary, {above_quantile('m', 0.95)} AS sequences FROM {FULL}"""),
        "J8_distance_anomalies": select(DISTANCES, f"""
SELECT {s}, {r('distance_to_centroid')},
  CASE WHEN distance_to_centroid > p99 THEN 0.9::DOUBLE ELSE 0.7::DOUBLE END AS anomaly_score,
  CASE WHEN distance_to_centroid > p99 THEN 'HIGH' ELSE 'MEDIUM' END AS anomaly_severity,
  'kmeans' AS detection_method FROM far, cuts WHERE distance_to_centroid > p95"""),
        "J9_forecast_temperature": select(FORECAST, f"""
SELECT device_id, hour_bucket, {r('predicted', 'predicted_temperature')},
  {r('predicted - reach', 'prediction_interval_lower_bound')},
  {r('predicted + reach', 'prediction_interval_upper_bound')} FROM forecast"""),
        "J10_forecast_anomalies": select(FORECAST, f"""
SELECT device_id, "timestamp", {r('actual', 'actual_temperature')}, {r('predicted', 'predicted_temperature')},
  {r('predicted - reach', 'prediction_interval_lower_bound')},
  {r('predicted + reach', 'prediction_interval_upper_bound')}, {r('error', 'prediction_error')},
  {r('anomaly_score')}, anomaly_severity, 'time_series_forecast' AS detection_method FROM forecast_anomalies"""),
        "J15_ensemble_vote": select(FLAGS, """
SELECT reading_id, temperature_flag, vibration_flag, critical_flag, ensemble::INT AS ensemble FROM voted"""),
        "J16_ensemble_score": select(READINGS, f"""
SELECT reading_id, {r('30 - temperature', 'temperature_decision')}, {r('5 - vibration', 'vibration_decision')},
  {r('(temperature - 30 + vibration - 5) / 2', 'ensemble_score')} FROM readings"""),
        "J17_scale_standard": select(READINGS, f"""
SELECT reading_id, {r('(temperature - tm) / td', 'temperature_scaled')}, {r('(vibration - vm) / vd', 'vibration_scaled')}
FROM readings, (SELECT avg(temperature) AS tm, stddev_pop(temperature) AS td, avg(vibration) AS vm,
  stddev_pop(vibration) AS vd FROM readings)"""),
        "J17_scale_minmax": select(READINGS, f"""
SELECT reading_id, {r('(temperature - tl) / (th - tl)', 'temperature_scaled')},
  {r('(vibration - vl) / (vh - vl)', 'vibration_scaled')}
FROM readings, (SELECT min(temperature) AS tl, max(temperature) AS th, min(vibration) AS vl, max(vibration) AS vh
  FROM readings)"""),
        "J18_ordered_split": select(READINGS, """
SELECT reading_id, row_number() OVER (PARTITION BY device_id ORDER BY "timestamp", reading_id)
  <= floor(0.8::DOUBLE * count(*) OVER (PARTITION BY device_id)) AS is_train FROM readings"""),
        "J19_evaluate_all": select(FLAGS + metrics("long", "model_name"), f"""
SELECT model_name, {rs(*METRICS, 'auc_roc')} FROM evaluated"""),
        "S3_anomaly_rates": select(RULED + """,
windows AS (
  SELECT date_trunc('minute', "timestamp") - to_minutes(i) AS window_start, is_anomaly
  FROM flagged, range(5) AS offsets(i))""", f"""
SELECT window_start, window_start + INTERVAL 5 MINUTE AS window_end, count(*) AS readings,
  count(*) FILTER (is_anomaly) AS anomalies, {r('count(*) FILTER (is_anomaly) / count(*)', 'anomaly_rate')}
FROM windows GROUP BY window_start HAVING count(*) FILTER (is_anomaly) / count(*) > 0.1"""),
        "S4_replay_safe_ingest": select(READINGS, f"""
SELECT device_id, "timestamp", {r('temperature')} FROM readings"""),
        "S6_stream_features": select(READINGS, f"""
SELECT device_id, "timestamp", {rs('temperature', 'vibration')},
  {r('temperature - lag(temperature) OVER s', 'temp_change')}, {r('vibration - lag(vibration) OVER s', 'vibration_change')},
  {r(f'avg(temperature) OVER {frame(5)}', 'temp_avg_5min')}, {r(f'avg(vibration) OVER {frame(5)}', 'vibration_avg_5min')},
  {r(f'stddev_samp(temperature) OVER {frame(10)}', 'temp_stddev_10min')},
  {r(f'stddev_samp(vibration) OVER {frame(10)}', 'vibration_stddev_10min')} FROM readings {SER}"""),
        "S5_alert_lines": select(RULED, f"""
SELECT 'WARNING' AS level, device_id, "timestamp", {r('anomaly_score')} FROM flagged WHERE is_anomaly"""),
    }
