from __future__ import annotations

import datetime as dt

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

import __spark_entry__
from delinq import schemas
from delinq.models import scoring, training
from delinq.models.oversample import nearest_neighbours, oversample_minority
from delinq.models.store import load_models, save_models
from delinq.models.training import (
    FULL_GRIDS,
    ModelSet,
    feature_importance,
    make_classifier,
    param_grid,
    top_features,
    train_all,
    train_model,
)
from delinq.plans import jobs
from delinq.plans.queries import models as model_queries
from delinq.sources import catalog, files

AS_OF = dt.datetime(2025, 1, 1)
LIGHT = {
    "logistic_regression": {"maxIter": 20},
    "random_forest": {"numTrees": 10, "maxDepth": 4},
    "gradient_boosting": {"maxIter": 3},
    "xgboost": {"maxIter": 3},
}


@pytest.fixture(scope="module")
def trained(domain):
    return jobs.train_from_master(domain["master"], AS_OF.date(), params=LIGHT, balance="weights")


def brute_neighbours(points, k):
    ids = [p[0] for p in points]
    x = np.array([p[1] for p in points])
    dist = np.sqrt(((x[:, None, :] - x[None, :, :]) ** 2).sum(2))
    np.fill_diagonal(dist, np.inf)
    return {ids[i]: sorted(dist[i])[:k] for i in range(len(ids))}


@pytest.mark.parametrize("block_rows", [10, 64, 5000])
@pytest.mark.parametrize("dims", [1, 3, 12])
def test_neighbours_equal_brute_force(spark, block_rows, dims):
    rng = np.random.default_rng(dims)
    points = [(f"P{i:04d}", [float(v) for v in rng.normal(size=dims)]) for i in range(200)]
    # A third of all points are copies of one.
    points += [(f"C{i:04d}", points[0][1]) for i in range(100)]
    df = spark.createDataFrame(points, "id string, x array<double>")
    got = {r["id"]: [f["dist"] for f in r["found"]] for r in nearest_neighbours(df, 5, block_rows).collect()}
    want = brute_neighbours(points, 5)
    assert got.keys() == want.keys()
    for key, distances in want.items():
        assert got[key] == pytest.approx(distances, abs=1e-7)


def labelled(spark, n_major, n_minor, dims=4):
    rng = np.random.default_rng(1)
    rows = [(f"M{i}", 0, Vectors.dense(rng.normal(size=dims))) for i in range(n_major)]
    rows += [(f"m{i}", 1, Vectors.dense(rng.normal(5, 1, size=dims))) for i in range(n_minor)]
    return spark.createDataFrame(rows, ["borrower_id", "is_delinquent", "features"])


def test_oversampling_balances_between_neighbours(spark):
    df = labelled(spark, 130, 37)
    out = oversample_minority(df, block_rows=10)
    assert {r[0]: r[1] for r in out.groupBy("is_delinquent").count().collect()} == {0: 130, 1: 130}
    assert out.select("borrower_id").distinct().count() == 260
    new = out.filter(F.col("borrower_id").contains("#")).select("borrower_id", vector_to_array("features").alias("x")).collect()
    base = {r["borrower_id"]: np.array(r["features"].toArray()) for r in df.filter("is_delinquent = 1").collect()}
    near = brute_neighbours(list(base.items()), 5)
    for row in new:
        start = base[row["borrower_id"].split("#")[0]]
        step = np.array(row["x"]) - start
        inside = [
            other
            for other in base.values()
            if 0 < np.linalg.norm(other - start) <= near[row["borrower_id"].split("#")[0]][-1] + 1e-9
            and np.linalg.norm(np.cross(step[:3], (other - start)[:3])) < 1e-6
            and np.linalg.norm(step) <= np.linalg.norm(other - start) + 1e-9
        ]
        assert inside, row["borrower_id"]


def test_oversampling_is_repeatable(spark):
    df = labelled(spark, 60, 20)
    read = lambda parts: sorted(
        (r["borrower_id"], tuple(np.round(r["features"].toArray(), 9))) for r in oversample_minority(df.repartition(parts)).collect()
    )
    assert read(1) == read(7)


def test_oversampling_leaves_balanced_and_tiny_classes(spark):
    assert oversample_minority(labelled(spark, 10, 10)).count() == 20
    assert oversample_minority(labelled(spark, 10, 1)).count() == 11


def test_grid_sizes():
    sizes = {n: int(np.prod([len(v) for v in g.values()])) for n, g in FULL_GRIDS.items()}
    # The random forest grid has one setting fewer than published: no minimum split size here.
    assert sizes == {"logistic_regression": 6, "random_forest": 27, "gradient_boosting": 18, "xgboost": 36}


def test_inverse_penalty(spark):
    classifier = make_classifier("logistic_regression")
    maps = param_grid(classifier, {"C": [0.1, 10.0]}, 50)
    assert [list(m.values())[0] for m in maps] == pytest.approx([0.2, 0.002])


def test_training_reaches_a_floor(trained):
    models, features = trained
    assert list(models.models) == ["logistic_regression", "random_forest", "gradient_boosting", "xgboost"]
    assert models.models["random_forest"].metrics["test_auc"] > 0.6
    assert models.best_name in models.models


def test_importance(spark, trained):
    models, features = trained
    for name in ("random_forest", "logistic_regression"):
        rows = feature_importance(models.models[name], features.feature_names, spark).collect()
        assert len(rows) == len(features.feature_names)
        assert [r["importance"] for r in rows] == sorted((r["importance"] for r in rows), reverse=True)
    assert top_features(models.models["random_forest"], features.feature_names, spark, 10).count() == 10


def test_failing_model_is_skipped(spark, trained, domain):
    _, features = trained
    rows = features.assemble(domain["master"])
    with pytest.warns(UserWarning, match="no_such_model skipped"):
        out = train_all(rows, rows, features.feature_names, names=["no_such_model"])
    assert out.models == {} and out.best_name is None
    with pytest.raises(ValueError):
        _ = out.best


def _forest_fails(monkeypatch):
    real = training.train_model

    def fails(train, name, *args, **options):
        if name == "random_forest":
            raise ArithmeticError("no tree grew")
        return real(train, name, *args, **options)

    monkeypatch.setattr(training, "train_model", fails)


@pytest.mark.parametrize("query", ["a13_model_store", "j1_model_stream"])
def test_queries_give_no_result_without_all_models(spark, small, trained, domain, monkeypatch, query):
    """The training data is that of the fixture; a model that fails must not leave the query a smaller set to agree on."""
    _, features = trained
    rows = features.assemble(domain["master"])
    monkeypatch.setattr(model_queries, "_training_data", lambda spark, d: (rows, rows, features))
    monkeypatch.setattr(model_queries, "_trained", {})
    monkeypatch.setattr(model_queries, "_scoring", {})
    _forest_fails(monkeypatch)
    with pytest.raises(RuntimeError, match="random_forest failed: no tree grew"):
        __spark_entry__.queries()[query](spark, small)
    assert model_queries._trained == {}


def test_failure_in_training_or_evaluation_is_an_error(spark, trained, domain, monkeypatch):
    _, features = trained
    rows = features.assemble(domain["master"])
    with pytest.raises(RuntimeError, match="logistic_regression failed: .*maxIter"):
        train_all(rows, rows, features.feature_names, names=["logistic_regression"], params={"logistic_regression": {"maxIter": -1}}, balance="none")
    monkeypatch.setattr(training, "evaluate", lambda model, test: 1 / 0)
    with pytest.raises(RuntimeError, match="logistic_regression failed: division by zero"):
        train_all(rows, rows, features.feature_names, names=["logistic_regression"], params=LIGHT, balance="none")


def test_skipped_models_are_named_in_the_set_and_its_store(spark, trained, domain, monkeypatch, tmp_path):
    _, features = trained
    rows = features.assemble(domain["master"])
    _forest_fails(monkeypatch)
    with pytest.warns(UserWarning, match="random_forest skipped: no tree grew"):
        out = train_all(rows, rows, features.feature_names, names=["random_forest", "logistic_regression"], params=LIGHT, skip_failing=True, balance="none")
    assert list(out.models) == ["logistic_regression"] and out.failed == {"random_forest": "no tree grew"}
    save_models(spark, out, features, str(tmp_path / "m"))
    assert load_models(spark, str(tmp_path / "m"))[0].failed == out.failed


def test_grid_search_with_oversampled_folds(spark, trained, domain):
    _, features = trained
    rows = features.assemble(domain["master"])
    fitted = train_model(rows, "logistic_regression", {"C": [0.01, 1.0]}, folds=2, balance="smote", maxIter=5)
    assert set(fitted.params) == {"regParam"} and 0.5 < fitted.cv_score <= 1
    assert hasattr(fitted.model, "coefficients")


def test_predictions(spark, trained, domain):
    models, features = trained
    scored = scoring.predict(domain["master"], models, features, "random_forest")
    rows = scored.collect()
    assert len(rows) == domain["master"].count()
    assert all(0 <= r["risk_probability"] <= 1 and r["risk_prediction"] in (0, 1) for r in rows)
    assert all(r["risk_prediction"] == int(r["risk_probability"] > 0.5) for r in rows)
    with pytest.raises(ValueError, match="not found"):
        scoring.predict(domain["master"], models, features, "nobody")


def test_predict_all_answers_and_errors(spark, trained, domain):
    models, features = trained
    requests = domain["master"].select("borrower_id", *schemas.CORE_FIELDS)
    some = requests.limit(5).unionByName(requests.limit(1).withColumns({"borrower_id": F.lit(None).cast("string"), "age": F.lit(None).cast("int")}))
    rows = scoring.predict_all(some, models, features, AS_OF).collect()
    good = [r for r in rows if r["error"] is None]
    bad = [r for r in rows if r["error"]]
    assert len(good) == 5 and len(bad) == 1
    for r in good:
        assert r["model_used"] == "random_forest" and set(r["all_model_predictions"]) == set(models.models)
        assert r["risk_assessment"] == r["all_model_predictions"]["random_forest"]
    assert bad[0]["borrower_id"] == "UNKNOWN" and bad[0]["risk_assessment"] is None and bad[0]["model_used"] is None
    assert "age" in bad[0]["error"]
    others = ModelSet({n: m for n, m in models.models.items() if n != "random_forest"}, models.feature_names)
    assert scoring.predict_all(some, others, features, AS_OF).first()["model_used"] == "logistic_regression"


def test_store_round_trip(spark, trained, domain, tmp_path):
    models, features = trained
    save_models(spark, models, features, str(tmp_path / "m"))
    again, features_again = load_models(spark, str(tmp_path / "m"))
    assert again.best_name == models.best_name and features_again == features
    assert again.feature_names == models.feature_names
    assert again.models["xgboost"].metrics == models.models["xgboost"].metrics
    a = scoring.predict(domain["master"], models, features).select("borrower_id", "risk_probability")
    b = scoring.predict(domain["master"], again, features_again).select("borrower_id", "risk_probability")
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_batch_score_files(spark, trained, domain, tmp_path):
    models, features = trained
    source = files.write_csv(catalog.conform(domain["master"], schemas.REQUEST), str(tmp_path / "in.csv"))
    summary = jobs.batch_score(spark, source, str(tmp_path / "out.csv"), models, features, AS_OF).first()
    assert summary["total_records"] == domain["master"].count()
    written = spark.read.option("header", True).csv(str(tmp_path / "out.csv"))
    assert written.columns[0] == "borrower_id" and "lower_bound" in written.columns


def test_fit_on_train_only(spark, domain):
    models, features = jobs.train_from_master(
        domain["master"], AS_OF.date(), fit_on="train", names=["logistic_regression"], params=LIGHT, balance="none"
    )
    assert list(models.models) == ["logistic_regression"]
