"""Queries of the models that learn sequences, boundaries and forecasts ahead, each beside its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.oracle import READINGS, RULED, USABLE, VIEW
from kelvibra import fixtures as X
from kelvibra import settings as S
from kelvibra.functions.expressions import known
from kelvibra.models import clusters, regression, sequences
from kelvibra.models.autoregression import forecast_ahead
from kelvibra.operators.features import training_view
from kelvibra.operators.rules import rule_score, wide_features
from kelvibra.operators.scans import scan_range
from kelvibra.operators.stats import device_profile
from kelvibra.plans.lineage import cut, shared_folder
from kelvibra.sources import refresh, summaries
from kelvibra.sources.tables import partition_and_cluster
from kelvibra.streaming import jobs
from kelvibra.streaming.ordered import ordered_features

HISTORY = 60


def j9_ahead(spark, sf):
    return forecast_ahead(X.readings(spark, sf), min_rows=HISTORY)


def j9_fleet(spark, sf):
    """All readings of a type as one series, in which hardly an hour is without readings."""
    rows = X.readings(spark, sf)
    return forecast_ahead(rows.withColumn("device_id", F.col("device_type")), min_rows=HISTORY)


def _ahead(key: str) -> str:
    limit = "greatest(-0.98::DOUBLE, least(0.98::DOUBLE, {}))"
    return READINGS.replace("WITH", "") + f""",
edge AS (SELECT as_of, date_trunc('hour', as_of) AS origin FROM clock),
means AS (
  SELECT {key} AS device_id, date_trunc('hour', "timestamp") AS hr, avg(temperature) AS m,
    arg_max(device_type, "timestamp") AS type
  FROM readings, edge WHERE "timestamp" >= origin - INTERVAL 335 HOUR GROUP BY ALL),
hourly AS (SELECT means.*, (epoch_us(hr) - epoch_us(origin)) / 3600000000::DOUBLE AS t FROM means, edge),
lines AS (SELECT device_id, regr_slope(m, t) AS b, regr_intercept(m, t) AS a, arg_max(type, hr) AS own_type FROM hourly GROUP BY device_id),
trended AS (SELECT hourly.*, coalesce(b, 0) AS b, CASE WHEN b IS NULL THEN m ELSE a END AS a, own_type, hour(hr) AS h,
    m - CASE WHEN b IS NULL THEN m ELSE a + b * t END AS r FROM hourly JOIN lines USING (device_id)),
type_hours AS (SELECT own_type, h, avg(r) AS type_effect FROM trended GROUP BY ALL),
own_hours AS (SELECT device_id, h, count(*) AS cell, avg(r) AS own FROM trended GROUP BY ALL),
rests AS (
  SELECT device_id, own_type, h, t::INT + 335 AS k, cell, CASE WHEN cell >= 3 THEN own ELSE type_effect END AS effect,
    r - CASE WHEN cell >= 3 THEN own ELSE type_effect END AS e
  FROM trended JOIN own_hours USING (device_id, h) JOIN type_hours USING (own_type, h)),
sizes AS (SELECT device_id, count(*) AS n0, sum(e * e) AS s0, 2 + count(DISTINCT CASE WHEN cell >= 3 THEN h END) AS used
  FROM rests GROUP BY device_id),
lags AS (SELECT x.device_id, y.k - x.k AS lag, count(*) AS n, sum(x.e * y.e) AS s
  FROM rests AS x JOIN rests AS y ON x.device_id = y.device_id AND y.k - x.k IN (1, 2) GROUP BY ALL),
rhos AS (
  SELECT sizes.device_id, n0, s0, used, s0 / greatest(n0 - used, 1) AS spread,
    coalesce(CASE WHEN p.n >= 8 THEN (p.s / p.n) / nullif(s0 / n0, 0) END, 0) AS rho1,
    coalesce(CASE WHEN q.n >= 8 THEN (q.s / q.n) / nullif(s0 / n0, 0) END, 0) AS rho2
  FROM sizes LEFT JOIN lags AS p ON p.device_id = sizes.device_id AND p.lag = 1
  LEFT JOIN lags AS q ON q.device_id = sizes.device_id AND q.lag = 2),
one AS (SELECT *, {limit.format('rho1')} AS k1 FROM rhos),
two AS (SELECT *, 1 - k1 * k1 AS share1, {limit.format('(rho2 - k1 * rho1) / (1 - k1 * k1)')} AS k2 FROM one),
aics AS (SELECT *, share1 * (1 - k2 * k2) AS share2, 0::DOUBLE AS aic0, n0 * ln(share1) + 2 AS aic1,
    n0 * ln(share1 * (1 - k2 * k2)) + 4 AS aic2 FROM two),
fits AS (
  SELECT device_id, spread, CASE WHEN aic0 <= aic1 AND aic0 <= aic2 THEN 0 WHEN aic1 <= aic2 THEN 1 ELSE 2 END AS ar_order,
    CASE ar_order WHEN 0 THEN 0 WHEN 1 THEN k1 ELSE k1 - k2 * k1 END AS f1, CASE ar_order WHEN 2 THEN k2 ELSE 0 END AS f2,
    spread * CASE ar_order WHEN 0 THEN 1 WHEN 1 THEN share1 ELSE share2 END AS noise FROM aics),
grid AS (SELECT fits.device_id, f1, f2, g.k, e FROM fits CROSS JOIN range(360) AS g(k)
  LEFT JOIN rests ON rests.device_id = fits.device_id AND rests.k = g.k),
walk AS (
  WITH RECURSIVE w AS (
    SELECT device_id, -1 AS k, 0::DOUBLE AS x1, 0::DOUBLE AS x2, 0 AS since FROM fits
    UNION ALL
    SELECT w.device_id, grid.k, coalesce(grid.e, f1 * x1 + f2 * x2), x1,
      CASE WHEN grid.e IS NULL AND grid.k < 336 THEN since + 1 WHEN grid.k < 336 THEN 0 ELSE since END
    FROM w JOIN grid ON grid.device_id = w.device_id AND grid.k = w.k + 1)
  SELECT * FROM w),
answers AS (
  WITH RECURSIVE p AS (
    SELECT device_id, f1, f2, 1 AS j, 1::DOUBLE AS p1, 0::DOUBLE AS p2, 1::DOUBLE AS sums FROM fits
    UNION ALL
    SELECT device_id, f1, f2, j + 1, f1 * p1 + f2 * p2, p1, sums + (f1 * p1 + f2 * p2) ** 2 FROM p WHERE j < 360)
  SELECT * FROM p),
ahead AS (
  SELECT device_id, origin, origin + to_hours(w.k - 335) AS hour_bucket, w.k - 335 AS step, ar_order,
    any_value(l.a) AS a, any_value(l.b) AS b, w.x1, w.since, noise, spread
  FROM walk AS w JOIN fits USING (device_id) JOIN trended AS l USING (device_id), edge WHERE w.k > 335
  GROUP BY ALL),
valued AS (
  SELECT ahead.*, ahead.a + ahead.b * step + coalesce(CASE WHEN o.cell >= 3 THEN o.own END, t.type_effect, 0) + x1 AS predicted,
    1.959963984540054::DOUBLE * sqrt(noise * sums + CASE WHEN o.cell >= 3 THEN spread / o.cell ELSE 0 END) AS reach
  FROM ahead JOIN answers ON answers.device_id = ahead.device_id AND answers.j = step + since
  JOIN lines ON lines.device_id = ahead.device_id
  LEFT JOIN own_hours AS o ON o.device_id = ahead.device_id AND o.h = hour(hour_bucket)
  LEFT JOIN type_hours AS t ON t.own_type = lines.own_type AND t.h = hour(hour_bucket))
SELECT device_id, origin, hour_bucket, step, ar_order, round(predicted, 6) AS predicted_temperature,
  round(predicted - reach, 6) AS prediction_interval_lower_bound, round(predicted + reach, 6) AS prediction_interval_upper_bound
FROM valued WHERE device_id IN (SELECT {key} FROM readings GROUP BY ALL HAVING count(*) > {HISTORY})"""


def _summarized(spark, sf):
    """The flagged readings as a table written in two batches, and its summaries."""
    rows = X.flagged(spark, sf).withColumn("vibration_level", F.col("vibration"))
    folder = shared_folder(spark)
    for part in (0, 1):
        batch = rows.filter(F.col("reading_id") % 2 == part)
        partition_and_cluster(batch, f"{folder}/table")
        summaries.append_summaries(batch, f"{folder}/days")
    return rows, summaries.read_summaries(spark, f"{folder}/days")


def a4_days(spark, sf):
    """What the lines of a day add up to."""
    _, lines = _summarized(spark, sf)
    days = lines.groupBy("event_date").agg(
        F.sum("readings").alias("readings"), F.sum("anomalies").alias("anomalies"), F.min("first").alias("first"),
        F.max("last").alias("last"), F.min("temperature_min").alias("least"), F.max("temperature_max").alias("most"),
        (F.sum("temperature_sum") / F.sum("temperature_known")).alias("mean"))
    return days.withColumn("event_date", F.col("event_date").cast("date"))


def d4_days(spark, sf):
    """D4 without reading readings; the number of devices within five in a hundred."""
    rows, lines = _summarized(spark, sf)
    devices = rows.agg(F.count_distinct("device_id").alias("n"))
    return summaries.kpis_of(lines).withColumn(
        "active_devices", F.abs(F.col("active_devices") / devices.select("n").scalar() - 1) < 0.05)


def d3_days(spark, sf):
    """Quantiles without reading readings: whether the share of readings up to each is that asked for, within four
    standard errors."""
    rows, lines = _summarized(spark, sf)
    found = summaries.quantiles_of(lines, "temperature", (0.05, 0.5, 0.95, 0.99))
    near = [(F.abs(F.avg((F.col("temperature") <= found.select(c).scalar()).cast("double")) - int(c[1:]) / 100)
             < 4 * summaries.QUANTILE_ERROR + 0.001).alias(c) for c in found.columns]
    return rows.agg(F.count("temperature").alias("readings"), *near)


def a5_days(spark, sf):
    """A5 with the newest time from the summaries."""
    rows, lines = _summarized(spark, sf)
    return scan_range(rows, "7 DAYS", summaries.newest(lines)).select("reading_id", "device_id", "timestamp")


def a7_days(spark, sf):
    """Counts by device and day, refreshed after an append that touches some days."""
    rows, folder = X.flagged(spark, sf).select("reading_id", "device_id", "timestamp", "temperature"), shared_folder(spark)
    late = (F.dayofmonth("timestamp") % 7 == 0) & (F.col("reading_id") % 2 == 0)
    for part in (rows.filter(~late), rows.filter(late)):
        partition_and_cluster(part, f"{folder}/table", cluster_by=("device_id",))
        refresh.refresh_days(spark.read.parquet(f"{folder}/table"), f"{folder}/daily", lambda days: days.groupBy(
            "device_id", "event_date").agg(F.count(F.lit(1)).alias("readings"), F.avg("temperature").alias("mean")))
    return refresh.read_days(spark, f"{folder}/daily")


def s6_ordered(spark, sf):
    """The features of readings that come in no order: every batch has readings of all times. A last reading far ahead
    lets the watermark pass all others. The stream is started anew for each batch, so that a batch may be many files."""
    rows = X.readings(spark, sf).select("device_id", F.col("timestamp").cast("timestamp").alias("timestamp"), "temperature", "vibration")
    folder = shared_folder(spark)
    ahead = rows.agg(F.lit("ahead").alias("device_id"), (F.max("timestamp") + F.expr("INTERVAL 100 DAYS")).alias("timestamp"),
                     F.lit(1.0).alias("temperature"), F.lit(1.0).alias("vibration"))
    for part in (rows.filter(F.xxhash64("*") % 2 == 0), rows.filter(F.xxhash64("*") % 2 != 0), ahead):
        part.write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema(rows.schema).parquet(f"{folder}/in")
        jobs.streaming_row_sink(ordered_features(stream, "60 days", width=86_400), f"{folder}/table", f"{folder}/state").awaitTermination()
    out = spark.read.parquet(f"{folder}/table").drop("batch_id").withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))
    return out.withColumns({c: known(c) for c, kind in out.dtypes if kind == "double"})


def j14_moments(spark, sf):
    """Mean and mean square of each place of all full sequences, from lagged sums."""
    rows = X.readings(spark, sf).select("reading_id", "device_id", "timestamp", "temperature", "vibration")
    scale, _ = sequences.fit_scale(rows)
    found = sequences.moments(sequences.with_lags(rows, scale, 10), 10, 2)
    lines = [(i // 2, ("temperature", "vibration")[i % 2], found.count, float(found.mean[i]),
              float(found.products[i, i] / found.count), float(found.products[i, i % 2] / found.count)) for i in range(20)]
    return spark.createDataFrame(lines, "place int, value string, sequences long, mean double, square double, with_first double")


def _view(spark, sf):
    return training_view(X.stored(spark, sf))


def j4_probability(spark, sf):
    """Every row of the last day scored again with the coefficients alone: rows flagged otherwise than by a probability
    above one half, or with another probability."""
    wide = wide_features(rule_score(X.readings_wide(spark, sf)).drop("anomaly_score"))
    model = regression.fit_supervised(wide, "rule_based_anomaly")
    curve = model.stages[-1]
    names = list(S.WIDE_FEATURES)
    rows = scan_range(wide, "1 DAYS").dropna(subset=names)
    margin = sum((F.lit(float(w)) * F.col(c).cast("double") for c, w in zip(names, curve.coefficients.toArray())), F.lit(float(curve.intercept)))
    want = rows.select("device_id", "timestamp", (1 / (1 + F.exp(-margin))).alias("p")).filter("p > 0.5")
    got = regression.supervised_anomalies(model, wide).select("device_id", "timestamp", "anomaly_probability", "anomaly_score")
    both = got.join(want, ["device_id", "timestamp"], "full")
    wrong = F.count_if(~F.coalesce(F.abs(F.col("p") - F.col("anomaly_probability")) < 1e-9, F.lit(False)))
    return both.agg(wrong.alias("wrong"), (F.count("p") > 0).alias("some_flagged"))


def j5_metrics(spark, sf):
    """J5's line against the scored rows: the metrics that differ from their definitions."""
    view = _view(spark, sf)
    model = regression.fit_anomaly_classifier(view)
    line = regression.evaluate_classifier(model, view)
    rows = regression.predict(model, scan_range(regression.classifier_inputs(view), "1 DAYS"))
    hit, said = F.col("label"), F.col("prediction") == 1.0
    own = F.when(hit, F.col("anomaly_probability")).otherwise(1 - F.col("anomaly_probability"))
    want = rows.agg(F.avg((hit == said).cast("double")).alias("accuracy_"), F.try_divide(F.count_if(hit & said), F.count_if(said)).alias("precision_"),
                    F.try_divide(F.count_if(hit & said), F.count_if(hit)).alias("recall_"),
                    F.avg(-F.ln(F.greatest(own, F.lit(1e-15)))).alias("log_loss_"))
    names = ("accuracy", "precision", "recall", "log_loss")
    line = line.select(*names, *[want.select(f"{c}_").scalar().alias(f"{c}_") for c in names])
    lines = [(F.abs(F.coalesce(F.col(c), F.lit(0.0)) - F.coalesce(F.col(f"{c}_"), F.lit(0.0))) < 1e-9).alias(c) for c in names]
    return line.select(*lines)


def j6_deviations(spark, sf):
    """The deviation by which each coefficient is multiplied."""
    view = _view(spark, sf)
    lines = regression.feature_importance(regression.fit_anomaly_classifier(view), regression.classifier_inputs(view))
    return lines.filter("feature NOT LIKE 'device_type=%' AND feature NOT LIKE '%z_score'").select(
        "feature", F.round(F.col("importance") / F.abs("coefficient"), 4).alias("deviation"))


def j7_nearest(spark, sf):
    """Whether devices are at the nearest of their clusters' means, and as far from it as they say."""
    profile = device_profile(X.stored(spark, sf))
    placed = cut(clusters.device_clusters(profile))
    filled = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in clusters.PROFILE]
    ends = placed.agg(*[f(c).alias(f"{n}{i}") for i, c in enumerate(filled) for n, f in (("m", F.avg), ("s", F.stddev_samp))]).first()
    scaled = [((c - F.lit(ends[f"m{i}"])) / F.lit(ends[f"s{i}"] or 1.0)).alias(f"z{i}") for i, c in enumerate(filled)]
    rows = placed.select("device_id", "device_type", "cluster_id", "distance_to_centroid", *scaled)
    names = [f"z{i}" for i in range(len(filled))]
    means = rows.groupBy("cluster_id").agg(*[F.avg(c).alias(c) for c in names]).collect()  # five lines
    away = {r["cluster_id"]: F.sqrt(sum((F.col(c) - F.lit(r[c])) * (F.col(c) - F.lit(r[c])) for c in names)) for r in means}
    own = F.coalesce(*[F.when(F.col("cluster_id") == k, d) for k, d in away.items()])
    return rows.agg(F.count(F.lit(1)).alias("devices"), (F.avg((own <= F.least(*away.values()) + 0.02).cast("double")) > 0.99).alias("nearest"),
                    (F.avg(F.abs(own - F.col("distance_to_centroid"))) < 0.02).alias("centred"))


MOMENTS = READINGS + """,
ends AS (SELECT min(temperature) AS t0, max(temperature) AS t1, min(vibration) AS v0, max(vibration) AS v1 FROM readings),
scaled AS (SELECT device_id, (temperature - t0) / (t1 - t0) AS t, (vibration - v0) / (v1 - v0) AS v,
    row_number() OVER (PARTITION BY device_id ORDER BY "timestamp", reading_id) AS p FROM readings, ends),
places AS (
  SELECT x.t, x.v, y.t AS t_first, y.v AS v_first, n.i AS place
  FROM scaled AS last CROSS JOIN range(10) AS n(i)
  JOIN scaled AS x ON x.device_id = last.device_id AND x.p = last.p - 9 + n.i
  JOIN scaled AS y ON y.device_id = last.device_id AND y.p = last.p - 9)
SELECT place::INT AS place, 'temperature' AS value, count(*) AS sequences, round(avg(t), 6) AS mean, round(avg(t * t), 6) AS square,
  round(avg(t * t_first), 6) AS with_first FROM places GROUP BY place
UNION ALL SELECT place::INT, 'vibration', count(*), round(avg(v), 6), round(avg(v * v), 6), round(avg(v * v_first), 6) FROM places GROUP BY place"""


def build():
    return {
        "A4_day_summaries": a4_days,
        "A5_range_by_summaries": a5_days,
        "A7_refresh_by_day": a7_days,
        "D3_quantiles_by_summaries": d3_days,
        "D4_kpis_by_summaries": d4_days,
        "J4_probability": j4_probability,
        "J5_metrics": j5_metrics,
        "J6_deviations": j6_deviations,
        "J7_nearest": j7_nearest,
        "J14_sequence_moments": j14_moments,
        "S6_ordered_features": s6_ordered,
        "J9_forecast_ahead": j9_ahead,
        "J9_forecast_fleet": j9_fleet,
    }


def sql() -> dict[str, str]:
    return {
        "A4_day_summaries": "WITH" + RULED + """
SELECT "timestamp"::DATE AS event_date, count(*)::BIGINT AS readings, count(*) FILTER (is_anomaly)::BIGINT AS anomalies,
  min("timestamp") AS first, max("timestamp") AS last, round(min(temperature), 6) AS least, round(max(temperature), 6) AS most,
  round(avg(temperature), 6) AS mean FROM flagged GROUP BY ALL""",
        "A5_range_by_summaries": "WITH" + READINGS + """
SELECT reading_id, device_id, "timestamp" FROM readings, clock WHERE "timestamp" >= as_of - INTERVAL 7 DAY""",
        "A7_refresh_by_day": "WITH" + READINGS + """
SELECT device_id, "timestamp"::DATE AS event_date, count(*) AS readings, round(avg(temperature), 6) AS mean FROM readings GROUP BY ALL""",
        "D3_quantiles_by_summaries": "WITH" + READINGS + """
SELECT count(temperature) AS readings, true AS p5, true AS p50, true AS p95, true AS p99 FROM readings""",
        "D4_kpis_by_summaries": "WITH" + RULED + """
SELECT count(*) AS total_readings, count(*) FILTER (is_anomaly) AS anomaly_count,
  round(count(*) FILTER (is_anomaly) / count(*) * 100, 8) AS anomaly_rate, true AS active_devices,
  round(avg(temperature), 8) AS avg_temperature FROM flagged""",
        "J4_probability": "SELECT 0::BIGINT AS wrong, true AS some_flagged",
        "J5_metrics": "SELECT true AS accuracy, true AS precision, true AS recall, true AS log_loss",
        "J6_deviations": "WITH" + VIEW + " UNION ALL ".join(
            f"SELECT '{c}' AS feature, round(stddev_samp({c}), 4) AS deviation FROM training WHERE {USABLE}"
            for c in regression.CLASS_FEATURES if not c.endswith("z_score")),
        "J7_nearest": "WITH" + READINGS + """
SELECT count(*) AS devices, true AS nearest, true AS centred FROM (SELECT DISTINCT device_id, device_type FROM readings, clock
WHERE "timestamp" >= as_of - INTERVAL 7 DAY)""",
        "J14_sequence_moments": "WITH" + MOMENTS,
        "J9_forecast_ahead": "WITH" + _ahead("device_id"),
        "J9_forecast_fleet": "WITH" + _ahead("device_type"),
    }
