"""The registered queries: every operator over the whole derived tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks import learned
from kelvibra import fixtures as X
from kelvibra import settings as S
from kelvibra.functions.expressions import (calendar_features, interaction_features, iso_text, known,
                                            severity_ladder)
from kelvibra.models import clusters, reconstruct, regression
from kelvibra.models.boundary import one_class_boundary
from kelvibra.models.forecast import forecast_temperature
from kelvibra.models.isolation import isolation_forest
from kelvibra.models.registry import ModelRegistry
from kelvibra.models.run import model_run, model_votes
from kelvibra.operators import detection as D
from kelvibra.operators import evaluation as E
from kelvibra.operators import features as W
from kelvibra.operators import parsing as P
from kelvibra.operators import rules as R
from kelvibra.operators import scans, stats
from kelvibra.plans.lineage import cut, shared_folder
from kelvibra.sources import messages as M
from kelvibra.sources import tables as T
from kelvibra.streaming import jobs
from kelvibra.streaming.features import stream_features
from kelvibra.streaming.jobs import alert_lines, anomaly_subscription
from kelvibra.streaming.rates import anomaly_rates

HISTORY = 60  # readings a device needs; the test devices have 45 to 99


# one operation on equal inputs: the same number everywhere, compared to the last bit
EXACT = ("temp_vibration_ratio", "temp_vibration_product")


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c, kind in df.dtypes
                           if kind == "double" and c not in EXACT})


def ntz(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in cols})


def joined(column: str) -> F.Column:
    return F.concat_ws("|", column)


# means of eight values end in a 5 at the seventh place, where summation order decides the sixth
DIGITS = {"D1_device_profile": 8, "D4_kpis_by_summaries": 8, "J7_members": 8}


def query(fn, digits: int = 6):
    return lambda spark, sf: rounded(fn(spark, sf), digits)


# --- 2.1 and 2.2 ------------------------------------------------------------------------------------

def places(location):
    return [F.try_variant_get(location, f"$.{c}", kind).alias(c)
            for c, kind in (("building", "string"), ("floor", "bigint"), ("room", "string"))]


def parsed(spark, sf):
    out = ntz(P.parse_messages(X.raw_messages(spark, sf)), "timestamp")
    return out.select("*", *places("location"))


RECORD = ("device_id", "timestamp", "timestamp_text", "device_type", "building", "floor", "room",
          "temperature", "vibration", "is_anomaly")


def ruled_messages(spark, sf):
    records = P.validate_required(P.parse_messages(X.raw_messages(spark, sf)))
    return R.apply_rules(ntz(records, "timestamp"))


def b9(spark, sf):
    return R.format_reading(ruled_messages(spark, sf), F.lit(None).cast("timestamp")).drop("processed_at")


def b10(spark, sf):
    return R.format_alert(ruled_messages(spark, sf)).select(
        "alert_id", "device_id", "timestamp", "severity", "message", "details.temperature",
        "details.vibration", joined("details.reasons").alias("reasons"),
        places("details.location")[0])


def rule_scores(spark, sf):
    return R.rule_score(X.readings_wide(spark, sf))


def b18(spark, sf):
    normal, anomalous = stats.split_by_verdict(X.flagged(spark, sf))
    return normal.select("reading_id", F.lit("normal").alias("subset")).unionByName(
        anomalous.select("reading_id", F.lit("anomaly").alias("subset")))


def page(spark, sf, days=1):
    """The monitoring page's frame: last days, z-scores over 11 rows."""
    rows = scans.scan_range(X.flagged(spark, sf), f"{days} DAYS")
    return W.dashboard_zscore(rows.select("reading_id", "device_id", "device_type", "timestamp",
                                          "temperature", "vibration", "is_anomaly"))


# --- 2.3 and detections --------------------------------------------------------------------------------

def forecast(spark, sf):
    return forecast_temperature(X.readings(spark, sf), min_rows=HISTORY)


def last_day(df):
    return scans.scan_range(df, "1 DAYS")


def c1(spark, sf):
    actual = X.readings(spark, sf).select("device_id", "timestamp",
                                          F.col("temperature").alias("actual_temperature"))
    return D.join_forecast(last_day(actual), forecast(spark, sf)).select(
        "device_id", "timestamp", "hour_bucket", "actual_temperature", "predicted_temperature",
        "prediction_error")


def c2(spark, sf):
    rows = X.readings(spark, sf)
    extremes = rows.agg(F.min("temperature").alias("coldest"), F.max("temperature").alias("hottest"),
                        F.max("vibration").alias("strongest"))
    return D.cross_scalar(rows.select("reading_id", "temperature"), extremes)


def c4(spark, sf):
    limits = spark.createDataFrame(
        [(k, float(lo), float(hi), S.VIBRATION_LIMITS[k]) for k, (lo, hi) in S.TEMPERATURE_LIMITS.items()],
        "device_type string, temp_min double, temp_max double, vibration_max double")
    return R.limits_lookup(X.readings(spark, sf).select("reading_id", "device_type"), limits)


def forecast_hits(spark, sf):
    return D.forecast_anomalies(last_day(X.readings(spark, sf)), forecast(spark, sf))


def rule_hits(spark, sf):
    rows = X.flagged(spark, sf).filter("is_anomaly")
    return rows.select("device_id", "timestamp", "anomaly_score",
                       severity_ladder("anomaly_score").alias("anomaly_severity"),
                       F.lit("threshold_rules").alias("detection_method"))


def wide_hits(spark, sf):
    rows = rule_scores(spark, sf).filter("anomaly_score > 0.4")
    return rows.select("device_id", "timestamp", "anomaly_score",
                       severity_ladder("anomaly_score").alias("anomaly_severity"),
                       F.lit("wide_rules").alias("detection_method"))


def detections(spark, sf):
    return D.unified_anomalies(forecast_hits(spark, sf), rule_hits(spark, sf), wide_hits(spark, sf))


def clock(spark, sf):
    """The newest reading's time stands for the current time."""
    return X.events(spark, sf).agg(F.max("ts")).scalar()


# --- 2.4 to 2.6 ------------------------------------------------------------------------------------------

def far_readings(spark, sf):
    """A given distance: how far a reading lies from (22, 2)."""
    rows = X.readings(spark, sf)
    away = F.abs(F.col("temperature") - F.lit(22.0)) + F.abs(F.col("vibration") - F.lit(2.0))
    return rows.select("reading_id", "device_id", "timestamp", away.alias("distance_to_centroid"))


def flags(spark, sf):
    rows = X.flagged(spark, sf)
    return rows.select(
        "reading_id", F.col("true_anomaly").cast("int").alias("y_true"),
        F.col("temp_anomaly").cast("int").alias("temperature_flag"),
        F.col("vibration_anomaly").cast("int").alias("vibration_flag"),
        (F.col("anomaly_severity") == "critical").cast("int").alias("critical_flag"))


FLAGS = ["temperature_flag", "vibration_flag", "critical_flag"]


def d6(column):
    return lambda spark, sf: stats.histogram(X.flagged(spark, sf), column)


def d6z(spark, sf):
    # the histogram reads its column twice: the window runs once
    return stats.histogram(cut(W.dashboard_zscore(X.flagged(spark, sf)).select("temp_z_score")),
                           "temp_z_score", by=None)


# --- 2.5 ---------------------------------------------------------------------------------------------------

SERIES = ("reading_id", "device_id", "timestamp")


def series(spark, sf, *more):
    return X.readings(spark, sf).select(*SERIES, "temperature", "vibration", *more)


def e8(spark, sf):
    rows = X.readings_wide(spark, sf).select(*SERIES, "vibration_level", "power_consumption")
    return W.fill_gaps(rows, ["vibration_level", "power_consumption"])


def e9(spark, sf):
    rows = W.sequences(series(spark, sf))
    flat = F.flatten("sequence")
    weights = F.zip_with(flat, F.sequence(F.lit(1), F.size(flat)), lambda x, i: x * i)
    return rows.select("reading_id", F.size("sequence").alias("steps"),
                       F.element_at(F.element_at("sequence", 1), 1).alias("first_temperature"),
                       F.aggregate(weights, F.lit(0.0), lambda a, x: a + x).alias("checksum"))


def view(spark, sf):
    return W.training_view(X.stored(spark, sf))


# --- 2.9 ---------------------------------------------------------------------------------------------------

def j1(spark, sf):
    v = view(spark, sf)
    return regression.predict(regression.fit_temperature(v), regression.trend_inputs(v)).select(
        *SERIES, "temperature", "predicted_temperature")


def j2(spark, sf):
    v = view(spark, sf)
    return regression.predict(regression.fit_vibration(v), regression.trend_inputs(v)).select(
        *SERIES, "vibration", "predicted_vibration")


def j3(spark, sf):
    v = view(spark, sf)
    scored = regression.predict(regression.fit_anomaly_classifier(v), regression.classifier_inputs(v))
    return scored.select(*SERIES, "label", "prediction", "anomaly_probability")


def labelled_wide(spark, sf):
    wide = R.rule_score(X.readings_wide(spark, sf)).drop("anomaly_score")
    return R.wide_features(wide)


def j4(spark, sf):
    wide = labelled_wide(spark, sf)
    return regression.supervised_anomalies(regression.fit_supervised(wide, "rule_based_anomaly"), wide)


def j5(spark, sf):
    v = view(spark, sf)
    return regression.evaluate_classifier(regression.fit_anomaly_classifier(v), v)


def j6(spark, sf):
    v = view(spark, sf)
    return regression.feature_importance(regression.fit_anomaly_classifier(v), regression.classifier_inputs(v))


def j6_global(spark, sf):
    v = view(spark, sf)
    return regression.global_explain(regression.fit_anomaly_classifier(v), regression.classifier_inputs(v))


def j7(spark, sf):
    return clusters.device_clusters(stats.device_profile(X.stored(spark, sf)))


def j8(spark, sf):
    wide = X.wide_inputs(spark, sf)
    return clusters.kmeans_anomalies(clusters.fit_clusters(wide, clusters.WIDE), wide)


def j8_ladder(spark, sf):
    rows = far_readings(spark, sf)
    return D.distance_anomalies(rows, stats.distance_quantiles(rows, "distance_to_centroid", exact=True))


def j11(spark, sf):
    wide = X.wide_inputs(spark, sf)
    return reconstruct.autoencoder_anomalies(reconstruct.fit_autoencoder(wide), wide)


def j15(spark, sf):
    return D.ensemble_vote(flags(spark, sf).drop("y_true"), FLAGS)


def j16(spark, sf):
    rows = X.readings(spark, sf).select(
        "reading_id", (F.lit(30.0) - F.col("temperature")).alias("temperature_decision"),
        (F.lit(5.0) - F.col("vibration")).alias("vibration_decision"))
    return D.ensemble_score(rows, ["temperature_decision", "vibration_decision"])


def g1_models(spark, sf):
    return D.unified_anomalies(j11(spark, sf), j8(spark, sf), forecast_hits(spark, sf), j4(spark, sf))


# --- what holds of every fit, whatever its model ------------------------------------------------------------

def flagged_share(df, flag, of="true"):
    """Rows, those that a model scored, and those that it flagged."""
    return df.agg(F.count(F.lit(1)).alias("readings"), F.count_if(F.expr(of)).alias("scored"),
                  F.count_if(F.col(flag) == 1).alias("flagged"))


def severity_shares(df):
    return df.agg(F.count(F.lit(1)).alias("readings"),
                  F.count_if(F.col("anomaly_severity") == "HIGH").alias("high"))


def j3_gradient(spark, sf):
    """The balanced likelihood's slope in each feature at the fitted coefficients, as a share of the feature's
    mean size: it is 0 at the optimum."""
    rows = regression.classifier_inputs(view(spark, sf))
    scored = regression.predict(regression.fit_anomaly_classifier(view(spark, sf)), rows)
    sizes = rows.agg(F.count_if("label").alias("pos"), F.count_if(~F.col("label")).alias("neg"))
    weight = F.when(F.col("label"), 1 / sizes.select("pos").scalar()).otherwise(1 / sizes.select("neg").scalar())
    away = (F.col("anomaly_probability") - F.col("label").cast("double")) * weight
    slopes = scored.agg(F.count(F.lit(1)).alias("readings"), *[
        F.abs(F.sum(away * F.col(c)) / F.sum(weight * F.abs(F.col(c)))).alias(c) for c in regression.CLASS_FEATURES])
    return slopes.unpivot(["readings"], list(regression.CLASS_FEATURES), "feature", "slope").select(
        "feature", "readings", (F.col("slope") < 0.001).alias("is_optimal"))


def j5_confusion(spark, sf):
    v = view(spark, sf)
    rows = scans.scan_range(regression.classifier_inputs(v), "1 DAYS")
    scored = regression.predict(regression.fit_anomaly_classifier(v), rows)
    counts = E.confusion(scored.select(F.col("label").cast("int").alias("y_true"),
                                       F.col("prediction").cast("int").alias("y_pred")))
    return counts.select((F.col("tp") + F.col("fn")).alias("positives"), (F.col("fp") + F.col("tn")).alias("negatives"))


def j6_names(spark, sf):
    return j6(spark, sf).select("feature")


def j7_members(spark, sf):
    """Each device is in one cluster, its profile unchanged."""
    return j7(spark, sf).filter(F.col("cluster_id").between(0, 4) & (F.col("distance_to_centroid") >= 0)) \
        .drop("cluster_id", "distance_to_centroid")


def j8_shares(spark, sf):
    return severity_shares(j8(spark, sf))


def model_run_query(spark, sf):
    return model_run(series(spark, sf), flags(spark, sf).select("reading_id", "y_true"))


def model_run_shares(spark, sf):
    """How many rows each of the three models flags among all readings."""
    votes = model_votes(series(spark, sf))
    return votes.agg(F.count(F.lit(1)).alias("readings"), *[F.sum(c).alias(c) for c in votes.columns
                                                            if c not in ("reading_id", "ensemble")])


# --- sources, tables and streams, written and read back ------------------------------------------------------

def inbox(spark, sf):
    """The messages as JSON lines in files."""
    folder = shared_folder(spark)
    X.raw_messages(spark, sf).repartition(8).write.text(folder)
    return folder


def a2(spark, sf):
    records = P.parse_messages(M.message_batch(spark, inbox(spark, sf)))
    return ntz(records, "timestamp").select("*", *places("location")) \
        .select(*RECORD, "reject_reason")


def table_rows(spark, folder):
    columns = [c for c in S.READING_COLUMNS if c != "processed_at"]
    return ntz(spark.read.parquet(folder), "timestamp").select(*columns)


def a3(spark, sf):
    folder = shared_folder(spark)
    T.append_readings(R.format_reading(ruled_messages(spark, sf)), folder)
    return table_rows(spark, folder)


def a5_past(spark, sf):
    """A range of the stored table that ends at a past moment: days are pruned."""
    folder = shared_folder(spark)
    T.partition_and_cluster(X.readings(spark, sf), folder)
    moment = F.lit("2024-01-20 00:00:00").cast("timestamp_ntz")
    return scans.scan_range(spark.read.parquet(folder), "7 DAYS", moment).select(*SERIES, "temperature")


def a6(spark, sf):
    folder = shared_folder(spark)
    M.publish_alerts(R.format_alert(ruled_messages(spark, sf)), folder)
    return alerts_read(spark, folder)


def alerts_read(spark, folder):
    kind = ("alert_id string, device_id string, timestamp string, severity string, message string, details struct<"
            f"temperature: double, vibration: double, reasons: array<string>, location: {S.LOCATION}>")
    return spark.read.schema(kind).json(folder).select(
        "alert_id", "device_id", "timestamp", "severity", "message", "details.temperature", "details.vibration",
        joined("details.reasons").alias("reasons"), places("details.location")[0])


def a8(spark, sf):
    return T.register_view(X.readings(spark, sf), "kelvibra_readings").select(*SERIES, "temperature")


def a9(spark, sf):
    folder = shared_folder(spark)
    T.append_metrics(E.classification_metrics(X.scored_models(spark, sf), ["model_name"]), folder)
    names = [c for c in S.METRIC_COLUMNS if c != "auc_roc"]
    return T.read_metrics(spark, folder).select("model_name", *names)


def a10(spark, sf):
    folder = shared_folder(spark)
    T.export_csv(X.readings(spark, sf).select("reading_id", "device_id", "temperature"), folder)
    return spark.read.schema("reading_id long, device_id string, temperature double").csv(folder, header=True)


def a11(spark, sf):
    """J1 with a model that was saved and loaded."""
    folder, v = shared_folder(spark), view(spark, sf)
    models = ModelRegistry()
    models.add("temperature", regression.fit_temperature(v))
    models.save(spark, folder)
    return regression.predict(ModelRegistry.load(spark, folder).models["temperature"], regression.trend_inputs(v)).select(
        *SERIES, "temperature", "predicted_temperature")


def s1(spark, sf):
    return table_rows(spark, detection_folders(spark, sf)[0])


def s1_alerts(spark, sf):
    return alerts_read(spark, detection_folders(spark, sf)[1])


def detection_folders(spark, sf):
    """The detection job over the messages as a stream of files."""
    folder = shared_folder(spark)
    places = [f"{folder}/{n}" for n in ("table", "alerts", "rejects", "state")]
    stream = M.message_stream(spark, "text", inbox(spark, sf), maxFilesPerTrigger="4")
    jobs.run_detection(stream, *places).awaitTermination()
    return places


def s2(spark, sf):
    """Wide readings as JSON messages, scored by the streaming consumer."""
    folder, source = shared_folder(spark), shared_folder(spark)
    rows = X.readings_wide(spark, sf)
    rows.select(F.to_json(F.struct(
        F.col("reading_id").cast("string").alias("device_id"), iso_text("timestamp").alias("timestamp"), "device_type",
        "temperature", "humidity", "pressure", "vibration_level", "power_consumption")).alias("value")).write.text(source)
    stream = M.message_stream(spark, "text", source)
    jobs.consume_and_score(stream, f"{folder}/table", f"{folder}/state").awaitTermination()
    return spark.read.parquet(f"{folder}/table").select(
        F.col("device_id").cast("bigint").alias("reading_id"), "anomaly_score", "rule_based_anomaly")


def file_stream(spark, rows):
    folder = shared_folder(spark)
    rows.write.parquet(folder)
    return spark.readStream.schema(rows.schema).parquet(folder)


def s4(spark, sf):
    """Readings delivered twice, stored once."""
    rows = X.readings(spark, sf).select("device_id", F.col("timestamp").cast("timestamp").alias("timestamp"), "temperature")
    folder = shared_folder(spark)
    once = jobs.replay_safe_ingest(file_stream(spark, rows.union(rows)))
    jobs.streaming_row_sink(once, f"{folder}/table", f"{folder}/state").awaitTermination()
    return ntz(spark.read.parquet(f"{folder}/table"), "timestamp").select("device_id", "timestamp", "temperature")


def s6(spark, sf):
    """The stream's features, of the readings that both devices and batch have in one order."""
    rows = X.readings(spark, sf).select("device_id", F.col("timestamp").cast("timestamp").alias("timestamp"),
                                        "temperature", "vibration")
    folder = shared_folder(spark)
    jobs.streaming_row_sink(stream_features(file_stream(spark, rows)), f"{folder}/table", f"{folder}/state").awaitTermination()
    out = ntz(spark.read.parquet(f"{folder}/table").drop("batch_id"), "timestamp")
    return out.withColumns({c: known(c) for c, kind in out.dtypes if kind == "double"})


def readings_counted(spark, sf):
    return stats.severity_counts(X.flagged(spark, sf))


def build() -> dict:
    q = {
        "A5_scan_range": lambda s, f: scans.scan_range(X.readings(s, f), "7 DAYS").select(*SERIES, "temperature"),
        "A2_message_batch": a2,
        "A3_append_readings": a3,
        "A5_past_range": a5_past,
        "A6_publish_alerts": a6,
        "A8_register_view": a8,
        "A9_append_metrics": a9,
        "A10_export_csv": a10,
        "A11_model_registry": a11,
        "A12_quarantine": lambda s, f: P.quarantine(parsed(s, f)).groupBy("reject_reason")
        .agg(F.count(F.lit(1)).alias("messages")),
        "A13_anomaly_subscription": lambda s, f: anomaly_subscription(X.flagged(s, f)).select(
            *SERIES, "anomaly_score", "anomaly_severity"),
        "B1_parse_messages": lambda s, f: parsed(s, f).select(*RECORD, "reject_reason"),
        "B2_validate_required": lambda s, f: P.validate_required(parsed(s, f)).select(*RECORD),
        "B3_detect_temperature": lambda s, f: R.detect_temperature(X.readings(s, f)).select(
            "reading_id", "temp_anomaly", joined("temp_reasons").alias("reasons")),
        "B4_detect_vibration": lambda s, f: R.detect_vibration(X.readings(s, f)).select(
            "reading_id", "vibration_anomaly", joined("vibration_reasons").alias("reasons")),
        "B5_combine_flags": lambda s, f: X.flagged(s, f).select(
            "reading_id", "anomaly_detected", "anomaly_severity"),
        "B6_merge_reasons": lambda s, f: X.flagged(s, f).select(
            "reading_id", joined("anomaly_reasons").alias("reasons")),
        "B7_flag_score": lambda s, f: X.flagged(s, f).select("reading_id", "anomaly_score"),
        "B8_baseline_zscore": lambda s, f: R.baseline_zscore(X.readings(s, f)).select(
            "reading_id", "temp_z_score", "vibration_z_score"),
        "B9_format_reading": b9,
        "B10_format_alert": b10,
        "B11_rule_score": lambda s, f: rule_scores(s, f).select(
            "reading_id", "anomaly_score", "rule_based_anomaly"),
        "B12_encode_categories": lambda s, f: R.encode_categories(X.readings_wide(s, f)).select(
            "reading_id", *[f"{c}_encoded" for c in S.CATEGORY_CODES]),
        "B13_coalesce_features": lambda s, f: R.coalesce_features(X.readings_wide(s, f)).select(
            "reading_id", "vibration_level", "power_consumption"),
        "B14_severity_ladder": lambda s, f: rule_scores(s, f).select(
            "reading_id", severity_ladder("anomaly_score").alias("anomaly_severity")),
        "B15_device_filter": lambda s, f: scans.device_filter(X.readings(s, f), "_001").select(*SERIES),
        "B16_interaction_features": lambda s, f: interaction_features(series(s, f)).select(
            "reading_id", "temp_vibration_ratio", "temp_vibration_product"),
        "B17_calendar_features": lambda s, f: calendar_features(series(s, f)).select(
            "reading_id", "hour_of_day", "day_of_week", "day_of_year"),
        "B18_split_by_verdict": b18,
        "B19_zscore_flag": lambda s, f: stats.zscore_flag(W.dashboard_zscore(series(s, f))).select(
            "reading_id", "temp_z_score_outside", "vibration_z_score_outside"),
        "C1_join_forecast": c1,
        "C2_cross_scalar": c2,
        "C3_devices_with_history": lambda s, f: D.devices_with_history(
            scans.scan_range(X.readings(s, f), "14 DAYS"), HISTORY, X.readings(s, f)).select(*SERIES),
        "C4_limits_lookup": c4,
        "D0_severity_counts": readings_counted,
        "D1_device_profile": lambda s, f: stats.device_profile(X.stored(s, f)),
        "D2_anomaly_summary": lambda s, f: stats.anomaly_summary(detections(s, f), clock(s, f)),
        "D3_distance_quantiles": lambda s, f: stats.distance_quantiles(
            far_readings(s, f), "distance_to_centroid", exact=True),
        "D4_kpis": lambda s, f: stats.kpis(X.flagged(s, f)),
        "D5_device_stats": lambda s, f: stats.device_stats(X.flagged(s, f), digits=6),
        "D6_histogram_temperature": d6("temperature"),
        "D6_histogram_vibration": d6("vibration"),
        "D6_histogram_zscore": d6z,
        "D7_temp_vibration_relation": lambda s, f: stats.temp_vibration_relation(X.flagged(s, f)),
        "D7_temp_vibration_grid": lambda s, f: stats.temp_vibration_grid(X.flagged(s, f)),
        "D8_confusion": lambda s, f: E.confusion(X.scored_models(s, f), ["model_name"]),
        "D9_classification_metrics": lambda s, f: E.classification_metrics(
            X.scored_models(s, f), ["model_name"]),
        "D10_auc_roc": lambda s, f: E.auc_roc(X.scored_models(s, f), ["model_name"]),
        "D11_latest_per_model": lambda s, f: E.latest_per_model(X.model_performance(s, f)),
        "D12_performance_report": lambda s, f: E.performance_report(X.model_performance(s, f)),
        "D13_class_report": lambda s, f: E.class_report(X.scored_models(s, f), ["model_name"]),
        "D14_anomaly_rate": lambda s, f: stats.anomaly_rate(flags(s, f), FLAGS),
        "E1_change_features": lambda s, f: W.change_features(series(s, f)).select(
            "reading_id", "temp_change", "vibration_change"),
        "E2_rolling_mean": lambda s, f: W.rolling_mean(series(s, f)).select(
            "reading_id", "temp_avg_5", "vibration_avg_5"),
        "E3_rolling_std": lambda s, f: W.rolling_std(series(s, f)).select(
            "reading_id", "temp_stddev_10", "vibration_stddev_10"),
        "E4_training_view": view,
        "E5_training_zscore": lambda s, f: W.training_zscore(view(s, f)).select(
            "reading_id", "temp_z_score", "vibration_z_score"),
        "E6_dashboard_zscore": lambda s, f: page(s, f, 30),
        "E7_eps_features": lambda s, f: W.eps_features(series(s, f)),
        "E8_fill_gaps": e8,
        "E9_sequences": e9,
        "F1_recent_anomalies": lambda s, f: scans.recent_anomalies(X.flagged(s, f)),
        "F2_raw_page": lambda s, f: scans.raw_page(page(s, f)),
        "F3_best_model": lambda s, f: E.best_model(X.model_performance(s, f), "precision"),
        "F4_compare_models": lambda s, f: E.compare_models(X.model_performance(s, f), days=14),
        "F5_order_summary": lambda s, f: stats.order_summary(stats.anomaly_summary(
            detections(s, f), clock(s, f), days=7)),
        "G1_unified_anomalies": detections,
        "G1_unified_detectors": g1_models,
        "J1_fit_temperature": j1,
        "J2_fit_vibration": j2,
        "J3_anomaly_classifier": j3,
        "J3_gradient": j3_gradient,
        "J4_supervised_anomalies": j4,
        "J5_evaluate_classifier": j5,
        "J5_confusion": j5_confusion,
        "J6_feature_names": j6_names,
        "J6_feature_importance": j6,
        "J6_global_explain": j6_global,
        "J7_device_clusters": j7,
        "J7_members": j7_members,
        "J8_shares": j8_shares,
        "J8_kmeans_anomalies": j8,
        "J8_distance_anomalies": j8_ladder,
        "J9_forecast_temperature": forecast,
        "J10_forecast_anomalies": forecast_hits,
        "J11_autoencoder_anomalies": j11,
        "J12_isolation_forest": lambda s, f: isolation_forest(series(s, f)),
        "J13_one_class_boundary": lambda s, f: one_class_boundary(series(s, f)),
        "J14_sequence_anomalies": lambda s, f: reconstruct.sequence_anomalies(series(s, f)),
        "J11_shares": lambda s, f: severity_shares(j11(s, f)),
        "J12_flagged": lambda s, f: flagged_share(isolation_forest(series(s, f)), "isolation_anomaly",
                                                  "isolation_score between 0 and 1"),
        "J13_flagged": lambda s, f: flagged_share(one_class_boundary(series(s, f)), "boundary_anomaly"),
        "J14_flagged": lambda s, f: flagged_share(reconstruct.sequence_anomalies(series(s, f)), "sequence_anomaly",
                                                  "sequence_error is not null"),
        "J19_model_run": model_run_query,
        "J19_model_flags": model_run_shares,
        "J15_ensemble_vote": j15,
        "J16_ensemble_score": j16,
        "J17_scale_standard": lambda s, f: W.scale_standard(series(s, f), W.VALUES).select(
            "reading_id", "temperature_scaled", "vibration_scaled"),
        "J17_scale_minmax": lambda s, f: W.scale_minmax(series(s, f), W.VALUES).select(
            "reading_id", "temperature_scaled", "vibration_scaled"),
        "J18_ordered_split": lambda s, f: W.ordered_split(series(s, f)).select("reading_id", "is_train"),
        "J19_evaluate_all": lambda s, f: E.evaluate_all(
            D.ensemble_vote(flags(s, f), FLAGS), [*FLAGS, "ensemble"]),
        "S1_run_detection": s1,
        "S1_alerts": s1_alerts,
        "S2_consume_and_score": s2,
        "S4_replay_safe_ingest": s4,
        "S6_stream_features": s6,
        "S3_anomaly_rates": lambda s, f: ntz(anomaly_rates(X.flagged(s, f)), "window_start", "window_end"),
        "S5_alert_lines": lambda s, f: alert_lines(X.flagged(s, f)).select(
            "level", "device_id", "timestamp", "anomaly_score"),
    }
    return {name: query(fn, DIGITS.get(name, 6)) for name, fn in (q | learned.build()).items()}
