"""Registered queries: one DataFrame per operator of the inventory.

Every query reads the driver tables (``events``; reference tables are derived from
it by ``sources.fixtures``) and runs over all rows. Output shapes are chosen for an
engine-independent comparison: doubles rounded to 6 places, counts BIGINT, flags
INT, flag arrays rendered as text (positions kept).
"""

from __future__ import annotations

import uuid
from dataclasses import replace
from datetime import datetime
from typing import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from txnguard.config import FixtureSpec, ModelConfig, ScoringConfig
from txnguard.functions.expressions import (
    epoch_micros, instant_to_utc_ntz, ntz_literal, rounded, zscore_unit,
)
from txnguard.operators import ml
from txnguard.operators.dims import materialize
from txnguard.operators.enrich import (
    add_calendar, enrich_with_baseline, enrich_with_blacklist, enrich_with_device,
    enrich_with_entity_blacklist, enrich_with_entity_blacklist_asof,
)
from txnguard.operators.geo import geo_velocity
from txnguard.operators.rules import apply_rules, blend, flags_text
from txnguard.operators.search import rolling_search
from txnguard.operators.velocity import self_velocity, sliding_velocity, trailing_velocity
from txnguard.plans.scoring import ReferenceTables, alerts, features, score
from txnguard.session import new_work_path
from txnguard.sources import fixtures as fx
from txnguard.sources.reference import (
    baseline_of_moments, build_baseline, build_known_devices, read_snapshot, refresh_baseline, write_bucketed, write_history,
    write_snapshot,
)
from txnguard.sources.sinks import alert_report, read_alerts, write_batch_parquet
from txnguard.sources.wire import (
    first_delivery, parse_transactions, read_transactions, reject_reason, wire_rows,
)
from txnguard.streaming import runner
from txnguard.streaming.batch_tables import BatchTable
from txnguard.streaming.job import JobPaths, first_deliveries, start_scoring_job
from txnguard.streaming.metrics import BatchMetrics
from txnguard.streaming.second_sums import SecondSums
from txnguard.streaming.velocity_state import trailing_velocity_stream

SPEC = FixtureSpec()
CFG = SPEC.scoring()          # fixture windows 1 day / 3 days, large amount 100
REF_CFG = ScoringConfig()     # the original operating point (1 min / 10 min windows)
MCFG = ModelConfig()
EXACT = replace(MCFG, median_relative_error=0.0)

Query = Callable[[SparkSession, str], DataFrame]


def _r(*cols: str) -> list:
    return [rounded(c).alias(c) for c in cols]


def _settled(df: DataFrame, *cols: str) -> DataFrame:
    """Averages of amounts often lie on a tie of the sixth place, where the last bit of a sum decides; a thousandth of
    that place is added before they are rounded, here and in the SQL."""
    return df.withColumns({c: F.col(c) + F.lit(1e-9) for c in cols})


def refs(spark: SparkSession, sf: str) -> ReferenceTables:
    return ReferenceTables(fx.blacklist_users(spark, sf, SPEC), fx.baseline(spark, sf, SPEC),
                           fx.known_devices(spark, sf, SPEC))


def scored(spark: SparkSession, sf: str, model=None) -> DataFrame:
    """Every payment, scored."""
    return score(fx.transaction_source(spark, sf), refs(spark, sf), CFG, model=model, mcfg=MCFG)


# ---- parsing, rejects, dedup ----------------------------------------------------

def q01_parse(spark, sf):
    """Wire rows laid down as files, read back by the source reader, repartitioned by sender as the original does."""
    path = new_work_path(spark, "wire-batch")
    wire_rows(fx.transaction_source(spark, sf), SPEC).write.parquet(path)
    p = parse_transactions(read_transactions(spark, "parquet", path, streaming=False), repartition=4)
    return p.withColumns({c: instant_to_utc_ntz(c) for c in ("event_time", "ingest_time", "kafka_ts")})


def q02_rejects(spark, sf):
    raw = wire_rows(fx.transaction_source(spark, sf), SPEC, faults=True)
    p = parse_transactions(raw)
    return (p.select(F.coalesce(reject_reason(), F.lit("valid")).alias("status"))
            .groupBy("status").agg(F.count(F.lit(1)).alias("n_rows")))


def q17_dedup(spark, sf):
    raw = wire_rows(fx.transaction_source(spark, sf), SPEC, duplicates=True)
    d = first_delivery(parse_transactions(raw))
    return d.select("txn_id", "sender_id", "amount", instant_to_utc_ntz("event_time").alias("event_time"),
                    "n_copies")


# ---- sliding windows, velocity -------------------------------------------------

def q03_sliding_short(spark, sf):
    v = sliding_velocity(fx.transactions(spark, sf), REF_CFG.short_window, REF_CFG.short_slide, "1m")
    return v.select("sender_id", "window_end", "txn_count_1m", *_r("total_amount_1m"))


def q04_sliding_long(spark, sf):
    v = sliding_velocity(fx.transactions(spark, sf), REF_CFG.long_window, REF_CFG.long_slide, "10m", full=True)
    return v.select("sender_id", "window_end_10m", "txn_count_10m",
                    *_r("total_amount_10m", "avg_amount_10m", "stddev_amount_10m"))


def _velocity_out(df):
    return df.select("txn_id", F.col("txn_count_1m").cast("long").alias("txn_count_1m"), *_r("total_amount_1m"),
                     F.col("txn_count_10m").cast("long").alias("txn_count_10m"),
                     *_r("total_amount_10m", "avg_amount_10m", "stddev_amount_10m"))


def q12_trailing_velocity(spark, sf):
    return _velocity_out(trailing_velocity(fx.transactions(spark, sf), CFG))


def q13_self_velocity(spark, sf):
    df = self_velocity(enrich_with_baseline(fx.transactions(spark, sf), fx.baseline(spark, sf, SPEC), CFG))
    return df.select("txn_id", "txn_count_1m", *_r("total_amount_1m"), "txn_count_10m",
                     *_r("total_amount_10m", "avg_amount_10m", "stddev_amount_10m"))


# ---- enrichment joins ------------------------------------------------------------

SNAPSHOT_DATE = "2024-01-16"


def via_snapshot(spark, df: DataFrame, label: str) -> DataFrame:
    """Reference table as production reads it: a dated Parquet snapshot in the shared
    folder, read back with a partition filter (only that date's folder is listed)."""
    path = new_work_path(spark, label)
    write_snapshot(df, path, SNAPSHOT_DATE)
    return read_snapshot(spark, path, SNAPSHOT_DATE)


def q05_blacklist_receiver(spark, sf):
    bl = via_snapshot(spark, fx.blacklist_users(spark, sf, SPEC), "blacklist")
    df = enrich_with_blacklist(fx.transactions(spark, sf), bl, CFG)
    return df.select("txn_id", "receiver_id", "bl_receiver_severity")


def q06_blacklist_device_ip(spark, sf):
    df = enrich_with_entity_blacklist(fx.transactions(spark, sf), fx.blacklist_long(spark, sf, SPEC), CFG)
    return df.select("txn_id", "bl_device_severity", "bl_ip_severity")


def q07_blacklist_validity(spark, sf):
    df = enrich_with_entity_blacklist_asof(fx.transactions(spark, sf), fx.blacklist_long(spark, sf, SPEC), CFG)
    return df.select("txn_id", "bl_device_severity", "bl_ip_severity")


def q08_baseline_zscore(spark, sf):
    base = via_snapshot(spark, fx.baseline(spark, sf, SPEC), "baseline")
    df = enrich_with_baseline(fx.transactions(spark, sf), base, CFG)
    return df.select("txn_id", *_r("avg_amount", "stddev_amount", "amount_zscore"))


def _bucketed(spark, df: DataFrame, label: str, keys: list[str]) -> DataFrame:
    name = f"{label}_{uuid.uuid4().hex[:8]}"
    return write_bucketed(df, new_work_path(spark, label), name, keys, int(spark.conf.get("spark.sql.shuffle.partitions")))


def q08_baseline_bucketed(spark, sf):
    """J2 against a baseline above the broadcast bound: a table bucketed by the user, joined where it lies."""
    base = _bucketed(spark, fx.baseline(spark, sf, SPEC), "baseline", ["user_id"])
    df = enrich_with_baseline(fx.transactions(spark, sf), base, CFG.with_(broadcast_max_rows=0))
    return df.select("txn_id", *_r("avg_amount", "stddev_amount", "amount_zscore"))


def q10_device_bucketed(spark, sf):
    """J3 against a device history above the broadcast bound, bucketed by both keys."""
    dev = _bucketed(spark, fx.known_devices(spark, sf, SPEC), "devices", ["user_id", "device_id"])
    df = enrich_with_device(fx.transactions(spark, sf), dev, CFG.with_(broadcast_max_rows=0))
    return df.select("txn_id", "is_new_device")


def q09_build_baseline(spark, sf):
    b = build_baseline(fx.history(fx.transactions(spark, sf), SPEC))
    return b.select("user_id", *_r("avg_amount", "stddev_amount"), "n_txn")


def q09_baseline_refresh(spark, sf):
    """A3 and S9 as a daily job: the history lies under one folder a day; each day's refresh merges that day into the
    snapshot of the day before."""
    root = new_work_path(spark, "daily")
    write_history(fx.history(fx.transactions(spark, sf), SPEC), root + "/history")
    days = sorted(r.event_date for r in spark.read.parquet(root + "/history").select(F.col("event_date").cast("string")).distinct().collect())
    for previous, day in zip([None, *days], days, strict=False):
        refresh_baseline(spark, root + "/history", root + "/moments", day, previous)
    return _settled(baseline_of_moments(read_snapshot(spark, root + "/moments", days[-1])), "avg_amount", "stddev_amount").select(
        "user_id", *_r("avg_amount", "stddev_amount"), "n_txn")


def q10_new_device(spark, sf):
    dev = via_snapshot(spark, fx.known_devices(spark, sf, SPEC), "devices")
    df = enrich_with_device(fx.transactions(spark, sf), dev, CFG)
    return df.select("txn_id", "is_new_device")


def q11_build_device_history(spark, sf):
    return build_known_devices(fx.history(fx.transactions(spark, sf), SPEC))


def q21_calendar(spark, sf):
    return add_calendar(fx.transactions(spark, sf), CFG, with_day=True).select(
        "txn_id", "hour_of_day", "day_of_week", "is_weekend")


def q33_geo_velocity(spark, sf):
    g = geo_velocity(fx.transactions(spark, sf))
    return g.select("txn_id", *_r("distance_km", "gap_seconds", "speed_kmh"))


def q34_zscore_unit(spark, sf):
    df = fx.transactions(spark, sf).join(
        fx.baseline(spark, sf, SPEC).withColumnRenamed("user_id", "sender_id"), "sender_id", "left")
    return df.select("txn_id", rounded(zscore_unit()).alias("amount_zscore_unit"))


def q16_lateness_report(spark, sf):
    t = fx.transactions(spark, sf)
    delay = (epoch_micros("ingest_time") - epoch_micros("event_time")).cast("double") / F.lit(1e6)
    return (t.select(F.date_trunc("hour", "event_time").alias("hour_start"), delay.alias("delay"))
            .groupBy("hour_start")
            .agg(F.count(F.lit(1)).alias("n_rows"),
                 F.sum(F.when(F.col("delay") > 30.0, 1).otherwise(0)).cast("long").alias("n_late"),
                 rounded(F.max("delay")).alias("max_delay_seconds"),
                 rounded(F.avg("delay")).alias("avg_delay_seconds")))


# ---- rules -------------------------------------------------------------------------

RULE_COLS = ("r1_velocity", "r2_blacklist", "r3_amount_anomaly", "r4_new_device", "r5_odd_hour", "r6_bl_velocity")


def q18_rule_components(spark, sf):
    return scored(spark, sf).select("txn_id", *_r(*RULE_COLS))


def q19_rule_score(spark, sf):
    s = scored(spark, sf)
    raw = F.col(RULE_COLS[0])
    for c in RULE_COLS[1:]:
        raw = raw + F.col(c)
    return s.select("txn_id", rounded("fraud_rule_score").alias("fraud_rule_score"),
                    rounded(raw).alias("raw_rule_sum"))


def q20_rule_flags(spark, sf):
    s = scored(spark, sf)
    return s.select("txn_id", flags_text().alias("rule_flags_text"),
                    F.size(F.array_compact("rule_flags")).alias("n_flags"))


def _alert_out(df):
    return df.select("txn_id", "sender_id", "receiver_id", "amount", "txn_type", "channel", "bl_receiver_severity",
                     *_r("amount_zscore"), "is_new_device", *_r("fraud_rule_score", "ml_fraud_score",
                                                                "final_fraud_score"),
                     flags_text().alias("rule_flags"))


def q30_alerts(spark, sf):
    return _alert_out(alerts(scored(spark, sf), CFG))


# ---- model --------------------------------------------------------------------------

def labelled(spark, sf) -> DataFrame:
    f = features(fx.transaction_source(spark, sf), refs(spark, sf), CFG)
    return f.withColumn(MCFG.label, ml.fraud_label())


def _kept(spark, key: str, make):
    """What one session has prepared already; it goes with the session."""
    kept = spark.__dict__.setdefault("_txnguard_kept", {})
    if key not in kept:
        kept[key] = make()
    return kept[key]


#: What the model queries read of a payment: its id and time, the model's inputs and the label.
MODEL_COLUMNS = ("txn_id", "event_time", *MCFG.numeric_features, *MCFG.categorical_features, MCFG.label)


def feature_table(spark, sf) -> DataFrame:
    """Every payment's ``MODEL_COLUMNS``, written once per session and table folder: the windows and joins before carry no
    other column."""
    return _kept(spark, f"features:{sf}", lambda: materialize(labelled(spark, sf).select(*MODEL_COLUMNS), "features"))


def split(spark, sf) -> tuple[DataFrame, DataFrame]:
    """(train, test) of the written feature table: joins and windows run once for both parts."""
    return ml.time_split(feature_table(spark, sf), SPEC.score_from)


def fitted(spark, sf):
    """The whole pipeline, fitted once per session and table folder."""
    return _kept(spark, f"model:{sf}", lambda: ml.fit_model(split(spark, sf)[0], MCFG))


def fitted_until(spark, sf, stage: str, mcfg: ModelConfig = MCFG):
    """The pipeline's stages up to ``stage`` (a class name), fitted without the trees."""
    return ml.fit_stages(split(spark, sf)[0], stage, mcfg)


def q22_split_class_weight(spark, sf):
    lab = labelled(spark, sf)
    part = F.when(F.col("event_time") < ntz_literal(SPEC.score_from), "train").otherwise("test")
    lab = lab.select(part.alias("split"), MCFG.label)
    w = ml.class_weight_table(lab.filter(F.col("split") == "train"), MCFG.label).select(MCFG.label, "class_weight")
    return (lab.groupBy("split", MCFG.label).agg(F.count(F.lit(1)).alias("n_rows"))
            .join(F.broadcast(w), MCFG.label, "left")
            .select("split", MCFG.label, "n_rows", rounded("class_weight").alias("class_weight")))


def _medians(model) -> DataFrame:
    sur = model.stages[0].surrogateDF
    return sur.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("surrogate")) for c in sur.columns])).alias("s")
    ).select("s.*")


def q23_impute(spark, sf):
    """The exact median of every numeric feature over the training rows."""
    return _medians(fitted_until(spark, sf, "Imputer", EXACT)).select("feature", rounded("surrogate").alias("surrogate"))


def q23_imputed_columns(spark, sf):
    """Per numeric feature: how many training values were missing, and the median used."""
    model = fitted_until(spark, sf, "Imputer", EXACT)
    train, _ = split(spark, sf)
    missing = train.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.sum(F.col(c).isNull().cast("long")).alias("n_missing"))
        for c in model.stages[0].getInputCols()])).alias("m")).select("m.*")
    return missing.join(_medians(model), "feature")


def q24_index(spark, sf):
    model = fitted_until(spark, sf, "StringIndexer")
    train, _ = split(spark, sf)
    out = None
    for stage in model.stages[1:]:
        c = stage.getInputCol()
        part = (stage.transform(train.select(c))
                .groupBy(F.col(c).alias("value"), F.col(stage.getOutputCol()).alias("idx"))
                .agg(F.count(F.lit(1)).alias("n_rows"))
                .select(F.lit(c).alias("feature"), "value", "idx", "n_rows"))
        out = part if out is None else out.unionByName(part)
    return out


def q25_assemble(spark, sf):
    """The assembled feature vector of each scored (test) row, one row per position:
    txn_id, feature, value (imputed numerics, then category indexes)."""
    _, test = split(spark, sf)
    out = fitted_until(spark, sf, "VectorAssembler").transform(ml.prepare_features(test, MCFG))
    names = F.array(*[F.lit(c) for c in (*MCFG.numeric_features, *MCFG.categorical_features)])
    return (out.select("txn_id", F.posexplode(vector_to_array("features_raw")).alias("pos", "value"))
            .select("txn_id", F.element_at(names, F.col("pos") + 1).alias("feature"),
                    rounded("value").alias("value")))


def q26_scale(spark, sf):
    scaler = fitted_until(spark, sf, "StandardScaler").stages[-1]
    names = [*ml.model_inputs(MCFG), *MCFG.categorical_features]
    std = [float(x) for x in scaler.std.toArray()]  # one number per feature
    return spark.createDataFrame(list(zip(names, std, strict=True)), "feature string, std double").select(
        "feature", rounded("std").alias("std"))


def q27_fit_score(spark, sf):
    """Every test row scored: whether the score is a probability, and whether the only column added is the score."""
    _, test = split(spark, sf)
    s = ml.score_with_model(test, fitted(spark, sf), MCFG)
    added = [c for c in s.columns if c not in test.columns]
    return s.select("txn_id", F.col("ml_fraud_score").between(0, 1).cast("int").alias("in_range"),
                    F.lit(int(added == ["ml_fraud_score"] and s.columns[:-1] == test.columns)).alias("only_score_added"))


def q28_save_load(spark, sf):
    """Every test row scored by the fitted and by the saved and reloaded model: 1 where both agree."""
    model = fitted(spark, sf)
    path = new_work_path(spark, "model")
    ml.save_model(model, path)
    again = ml.load_model(path)
    _, test = split(spark, sf)
    a = ml.score_with_model(test, model, MCFG).select("txn_id", "ml_fraud_score")
    b = ml.score_with_model(test, again, MCFG).select("txn_id", F.col("ml_fraud_score").alias("reloaded_score"))
    return a.join(b, "txn_id").select("txn_id", (F.col("ml_fraud_score") == F.col("reloaded_score")).cast("int").alias("same"))


def q29_pr_auc(spark, sf):
    s = scored(spark, sf).withColumn("y", ml.fraud_label())
    return ml.pr_auc_frame(s, "fraud_rule_score", "y").select(rounded("pr_auc").alias("pr_auc"), "n_pos", "n_neg")


def q29_pr_auc_model(spark, sf):
    """PR-AUC of the model on the later part: class counts, and 1 if it equals MLlib's own evaluator within 1e-9."""
    _, test = split(spark, sf)
    model = fitted(spark, sf)
    pred = materialize(model.transform(ml.prepare_features(test, MCFG)).select(
        MCFG.label, "probability", vector_to_array("probability")[1].alias("ml_fraud_score")), "predictions")
    reference = ml.pr_auc_evaluator(pred, MCFG.label, "probability")
    return ml.pr_auc_frame(pred, "ml_fraud_score", MCFG.label).select(
        (F.abs(F.col("pr_auc") - reference) < 1e-9).cast("int").alias("equals_evaluator"), "n_pos", "n_neg")


def q30_alerts_blended(spark, sf):
    """R9: equal parts of the rule score and a score of the model's range that follows from event_id."""
    f = features(fx.transaction_source(spark, sf), refs(spark, sf), CFG)
    ml_score = ((F.col("event_id") * 37) % 101).cast("double") / F.lit(100.0)
    return _alert_out(alerts(blend(apply_rules(f, CFG).withColumn("ml_fraud_score", ml_score), CFG), CFG))


SEARCH_CUTS = [datetime(2024, 1, 11), SPEC.score_from, datetime(2024, 1, 21)]
SEARCH_SETTINGS = {"stumps": {"max_iter": 3, "max_depth": 1}, "deeper": {"max_iter": 3, "max_depth": 4}}


def q35_model_search(spark, sf):
    """M11: two settings on two rolling-origin folds of the feature table; the sizes of each fold's parts, and whether the
    area lies between 0 and 1 (which setting is better only a fit can tell; a test compares areas with single fits)."""
    got = rolling_search(feature_table(spark, sf), SEARCH_SETTINGS, SEARCH_CUTS, MCFG)
    return got.select("setting", "fold", "n_train", "n_valid", "n_pos", F.col("pr_auc").between(0, 1).cast("int").alias("in_range"))


# ---- streaming ----------------------------------------------------------------------

def _wire_stream(spark, sf, faults=False, duplicates=False, n_files=4, last=None) -> DataFrame:
    """The derived wire rows laid down as event-time slices, replayed one slice per
    trigger by the file source."""
    path = new_work_path(spark, "wire")
    wire = wire_rows(fx.transaction_source(spark, sf, spread=True), SPEC, faults=faults, duplicates=duplicates)
    k = runner.write_wire_files(wire, path, n_files, last=last)
    return runner.read_wire_stream(spark, path, files_per_trigger=k)


def q14_stream_sliding_window(spark, sf):
    stream = parse_transactions(_wire_stream(spark, sf), watermark=REF_CFG.watermark)
    agg = sliding_velocity(stream, REF_CFG.long_window, REF_CFG.long_slide, "10m", full=True)
    out = new_work_path(spark, "q14")
    runner.run_to_parquet(agg, out + "/data", out + "/_checkpoint")
    got = spark.read.parquet(out + "/data")
    return got.select("sender_id", instant_to_utc_ntz("window_end_10m").alias("window_end_10m"), "txn_count_10m",
                      *_r("total_amount_10m", "avg_amount_10m", "stddev_amount_10m"))


def q15_stream_trailing_velocity(spark, sf):
    stream = parse_transactions(_wire_stream(spark, sf), watermark=REF_CFG.watermark)
    vel = trailing_velocity_stream(stream, CFG)
    out = new_work_path(spark, "q15")
    runner.run_to_parquet(vel, out + "/data", out + "/_checkpoint")
    return _velocity_out(spark.read.parquet(out + "/data"))


def _hot_sender(src: DataFrame) -> DataFrame:
    """A third of the payments come from one sender."""
    return src.withColumn("sender_id", F.when(F.col("event_id") % 3 == 0, F.lit("USER_HOT")).otherwise(F.col("sender_id")))


def q15_stream_hot_sender(spark, sf):
    """V4 on summaries a second: a third of the feed has one sender; velocity of every row at the original's windows."""
    path = new_work_path(spark, "wire")
    k = runner.write_wire_files(wire_rows(_hot_sender(fx.transaction_source(spark, sf, spread=True)), SPEC), path, 4)
    stream = parse_transactions(runner.read_wire_stream(spark, path, files_per_trigger=k))
    out = new_work_path(spark, "q15-hot")
    sums = SecondSums(spark, out + "/state", CFG)

    def write(batch, batch_id):
        batch = batch.persist()  # read for the state's rows and again for the output
        try:
            write_batch_parquet(sums.add(batch, batch_id), out + "/data", batch_id)
        finally:
            batch.unpersist()
        sums.tidy(batch_id)

    _finish(stream.writeStream.foreachBatch(write).option("checkpointLocation", out + "/_checkpoint")
            .trigger(availableNow=True).start())
    return _velocity_out(_settled(spark.read.parquet(out + "/data"), "avg_amount_10m", "stddev_amount_10m"))


def q17_stream_dedup(spark, sf):
    """V8 keyed by the id alone: every redelivery has another sender, time and amount than the first delivery."""
    path = new_work_path(spark, "wire")
    src = fx.transaction_source(spark, sf, spread=True)
    k = runner.write_wire_files(wire_rows(src, SPEC), path, 3)
    later = F.timestamp_add("DAY", F.lit(40), F.col("event_time"))
    again = src.filter(F.col("event_id") % SPEC.duplicate_mod == 0).withColumns(
        {"sender_id": F.col("receiver_id"), "event_time": later, "ingest_time": later, "amount": F.col("amount") + 1})
    runner.write_wire_files(wire_rows(again, SPEC), path, 1, files_per_slice=k)
    out = new_work_path(spark, "q17")
    stream = first_deliveries(parse_transactions(runner.read_wire_stream(spark, path, files_per_trigger=k)), CFG)
    runner.run_to_parquet(stream, out + "/data", out + "/_checkpoint")
    return spark.read.parquet(out + "/data").select(
        "txn_id", "sender_id", "amount", instant_to_utc_ntz("event_time").alias("event_time"))


def _run_job(spark, sf) -> JobPaths:
    raw = _wire_stream(spark, sf, faults=True, duplicates=True)
    paths = JobPaths(new_work_path(spark, "job"))
    _finish(start_scoring_job(spark, raw, lambda: refs(spark, sf), paths, CFG, available_now=True))
    return paths


def _finish(query) -> None:
    query.awaitTermination()
    if query.exception():
        raise query.exception()


def q31_alert_report(spark, sf):
    paths = _run_job(spark, sf)
    return alert_report(read_alerts(spark, paths.alerts))["by_flag"]


def q31_alert_listing(spark, sf):
    """The original readback: 6-column listing of the stored alerts."""
    listing = alert_report(read_alerts(spark, _run_job(spark, sf).alerts))["listing"]
    return listing.select("txn_id", "sender_id", "receiver_id", "amount", *_r("final_fraud_score"),
                          flags_text().alias("rule_flags"))


def q16_progress_metrics(spark, sf):
    """V5: what the job's progress reports say of all its batches, and whether each batch's rows are those of the stats sink."""
    raw = _wire_stream(spark, sf, faults=True, duplicates=True)
    paths = JobPaths(new_work_path(spark, "metered-job"))
    name = "metered_" + uuid.uuid4().hex[:8]
    with BatchMetrics(spark, name) as metrics:
        _finish(start_scoring_job(spark, raw, lambda: refs(spark, sf), paths, CFG, available_now=True, name=name))
    stats = spark.read.parquet(paths.stats).select(F.col("batch_id").cast("long").alias("batch_id"), F.col("n_rows").alias("n_sink"))
    return (metrics.frame().join(stats, "batch_id", "full")
            .agg(F.sum("n_delivered").alias("n_delivered"), F.sum("n_redelivered").alias("n_redelivered"),
                 F.sum("n_rows").alias("n_rows"),
                 F.sum((~F.coalesce(F.col("n_rows") == F.col("n_sink"), F.lit(False))).cast("long")).alias("n_batches_differ")))


def q31_alert_table(spark, sf):
    """S2 by date: the job's alert table after its batches were compacted; alerts and their amount a date."""
    raw = _wire_stream(spark, sf, faults=True, duplicates=True)
    paths = JobPaths(new_work_path(spark, "dated-job"))
    _finish(start_scoring_job(spark, raw, lambda: refs(spark, sf), paths, CFG, available_now=True, dated_alerts=True))
    table = BatchTable(spark, paths.alert_table, ["date"])
    table.compact(keep_last=1)
    stored = table.read(StructType([*spark.read.parquet(paths.alerts).drop("batch_id").schema.fields,
                                    StructField("date", StringType())]))
    return stored.groupBy("date").agg(F.count(F.lit(1)).alias("n_alerts"), rounded(F.sum("amount")).alias("total_amount"))


def _sink_counts(spark, paths: JobPaths) -> DataFrame:
    a = spark.read.parquet(paths.alerts).select(F.lit("alerts").alias("sink"), "amount")
    s = spark.read.parquet(paths.safe).select(F.lit("safe").alias("sink"), "amount")
    r = spark.read.parquet(paths.rejects).select(F.lit("rejects").alias("sink"),
                                                 F.lit(None).cast("double").alias("amount"))
    return (a.unionByName(s).unionByName(r).groupBy("sink")
            .agg(F.count(F.lit(1)).alias("n_rows"), rounded(F.sum("amount")).alias("total_amount")))


def q32_sink_readback(spark, sf):
    return _sink_counts(spark, _run_job(spark, sf))


def q16_late_rows_scored(spark, sf):
    """V5: the job over a feed in which every ``late_mod``-th payment is delivered after all others. Each
    distinct delivered payment is in exactly one sink."""
    raw = _wire_stream(spark, sf, faults=True, duplicates=True,
                       last=F.substring("txn_id", 5, 9).cast("long") % SPEC.late_mod == 0)
    paths = JobPaths(new_work_path(spark, "late-job"))
    cfg = CFG.with_(allowed_lateness="31 days")
    _finish(start_scoring_job(spark, raw, lambda: refs(spark, sf), paths, cfg, available_now=True))
    return _sink_counts(spark, paths)


def q32_model_stream(spark, sf):
    """The job with a model (ten trees) on the stream against the same plan in batch: alerts on one side only, and
    alerts whose scores differ."""
    model = _kept(spark, f"stream-model:{sf}", lambda: ml.fit_model(split(spark, sf)[0], replace(MCFG, max_iter=10)))
    paths = JobPaths(new_work_path(spark, "model-job"))
    _finish(start_scoring_job(spark, _wire_stream(spark, sf), lambda: refs(spark, sf), paths, CFG, model=model,
                              available_now=True, mcfg=MCFG))
    path = new_work_path(spark, "wire-batch")
    wire_rows(fx.transaction_source(spark, sf), SPEC).write.parquet(path)
    batch = parse_transactions(read_transactions(spark, "parquet", path, streaming=False))
    batch = materialize(features(batch, refs(spark, sf), CFG), "batch-features")  # the model's plan repeats its inputs
    batch = alerts(blend(apply_rules(ml.score_with_model(batch, model, MCFG), CFG), CFG), CFG)
    a = spark.read.parquet(paths.alerts).select("txn_id", rounded("final_fraud_score").alias("a"))
    b = batch.select("txn_id", rounded("final_fraud_score").alias("b"))
    both = a.join(b, "txn_id", "full")
    count = lambda c: F.coalesce(F.sum(c.cast("long")), F.lit(0)).alias
    return both.agg(count(F.col("b").isNull())("n_stream_only"), count(F.col("a").isNull())("n_batch_only"),
                    count(F.col("a") != F.col("b"))("n_different"),
                    (F.count(F.lit(1)) > 0).cast("int").alias("has_alerts"))


QUERIES: dict[str, Query] = {name: fn for name, fn in sorted(globals().items())
                             if name[:1] == "q" and name[1:3].isdigit() and callable(fn)}
