"""Model search in time order (M11): every setting is fitted on the past of a cutoff and judged on what follows it.

Folds are rolling origins, never random splits: fold i learns from the rows before ``cuts[i]`` and is judged on those from
there up to ``cuts[i + 1]``. All folds read one written feature table; a fold's rows are a filter on it that reaches the scan.
Fits run side by side from as many driver threads as asked; their work is Spark's.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace
from datetime import datetime

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnguard.config import ModelConfig
from txnguard.functions.expressions import ntz_literal
from txnguard.operators import ml
from txnguard.operators.dims import materialize


def fold_parts(table: DataFrame, cuts: Sequence[datetime], fold: int, ts: str = "event_time") -> tuple[DataFrame, DataFrame]:
    """(rows to learn from, rows to judge on) of a fold."""
    t = F.col(ts).cast("timestamp_ntz")
    train, later = ml.time_split(table, cuts[fold], ts)
    return train, later.filter(t < ntz_literal(cuts[fold + 1]))


def rolling_search(table: DataFrame, settings: dict[str, dict], cuts: Sequence[datetime], mcfg: ModelConfig = ModelConfig(),
                   parallelism: int = 2, ts: str = "event_time") -> DataFrame:
    """setting, fold, n_train, n_valid, n_pos, pr_auc: a row for each of ``settings`` (name -> changes of ``mcfg``) and fold.
    A fold whose later part holds no positive row has no area (null)."""
    if len(cuts) < 2 or list(cuts) != sorted(set(cuts)):
        raise ValueError("cuts must be at least two ascending times")
    spark = table.sparkSession

    def judged(job):
        name, fold = job
        own = replace(mcfg, **settings[name])
        train, valid = fold_parts(table, cuts, fold, ts)
        n_train = train.count()
        model = ml.fit_model(train, own)
        scored = materialize(ml.score_with_model(valid, model, own).select("ml_fraud_score", own.label), "fold-scores")
        got = ml.pr_auc_frame(scored, "ml_fraud_score", own.label).first()
        return (name, fold, n_train, (got.n_pos or 0) + (got.n_neg or 0), got.n_pos or 0, got.pr_auc)

    jobs = [(name, fold) for name in settings for fold in range(len(cuts) - 1)]
    with ThreadPoolExecutor(max(1, parallelism)) as pool:
        rows = list(pool.map(inheritable_thread_target(judged), jobs))
    return spark.createDataFrame(rows, "setting string, fold int, n_train long, n_valid long, n_pos long, pr_auc double")


def best_setting(results: DataFrame) -> DataFrame:
    """setting, mean_pr_auc, n_folds, best first (equal ones by name)."""
    return (results.groupBy("setting").agg(F.avg("pr_auc").alias("mean_pr_auc"), F.count("pr_auc").alias("n_folds"))
            .orderBy(F.desc_nulls_last("mean_pr_auc"), "setting"))
