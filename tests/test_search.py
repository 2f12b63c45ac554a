"""Time-ordered model search, and scores recomputed from the trees' nodes."""

from datetime import datetime

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from txnguard.config import ModelConfig
from txnguard.operators import ml
from txnguard.operators.search import best_setting, fold_parts, rolling_search
from txnguard.plans.catalog import split

SMALL = ModelConfig(max_iter=2, max_depth=2)
CUTS = [datetime(2024, 1, 11), datetime(2024, 1, 16), datetime(2024, 1, 21)]


def whole(spark):
    a, b = split(spark, SF_SMALL)
    return a.unionByName(b)


def test_folds_never_see_the_future(spark):
    for fold in (0, 1):
        train, valid = fold_parts(whole(spark), CUTS, fold)
        assert train.agg(F.max("event_time")).first()[0] < CUTS[fold] <= valid.agg(F.min("event_time")).first()[0]
        assert valid.agg(F.max("event_time")).first()[0] < CUTS[fold + 1]
    with pytest.raises(ValueError):
        rolling_search(whole(spark), {"a": {}}, CUTS[::-1])


def test_search_areas_equal_single_fits(spark):
    got = rolling_search(whole(spark), {"a": {}, "b": {"max_depth": 3}}, CUTS[:2], SMALL)
    rows = {r.setting: r for r in got.collect()}
    train, valid = fold_parts(whole(spark), CUTS, 0)
    alone = ml.pr_auc_frame(ml.score_with_model(valid, ml.fit_model(train, SMALL), SMALL), "ml_fraud_score", SMALL.label).first()
    assert abs(rows["a"].pr_auc - alone.pr_auc) < 1e-12 and rows["a"].n_valid == alone.n_pos + alone.n_neg
    assert best_setting(got).first().setting == max(rows.values(), key=lambda r: (r.pr_auc, r.setting == "a")).setting


def test_scores_follow_from_the_trees(spark):
    """Every test row's probability, recomputed in plain Python from the saved trees' nodes and weights."""
    import math
    train, test = split(spark, SF_SMALL)
    model = ml.fit_model(train, SMALL)
    gbt = model.stages[-1]

    def value(node, x):
        while node.numDescendants():
            s = node.split()
            name = s.getClass().getSimpleName()
            if name == "ContinuousSplit":
                left = x[s.featureIndex()] <= s.threshold()
            else:
                left = x[s.featureIndex()] in list(s.leftCategories())
            node = node.leftChild() if left else node.rightChild()
        return node.prediction()

    rows = model.transform(test).select(vector_to_array("features").alias("x"), vector_to_array("probability")[1].alias("p")).limit(40).collect()
    trees = [(t._java_obj if hasattr(t, "_java_obj") else t._call_java, w) for t, w in zip(gbt.trees, gbt.treeWeights)]
    for r in rows:
        margin = sum(w * value(t.rootNode(), r.x) for t, w in trees)
        assert abs(1 / (1 + math.exp(-2 * margin)) - r.p) < 1e-9
    assert len({round(r.p, 6) for r in rows}) > 1
