"""Registered queries: features, models, scoring, outreach runs."""

from __future__ import annotations

import datetime as dt

from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from delinq import schemas
from delinq.functions.numeric import np_round
from delinq.models import racing, registry, scoring
from delinq.models.neighbours import nearest_neighbours
from delinq.models.oversample import oversample_minority
from delinq.models.compiled import model_nodes, node_importance
from delinq.models.second_order import SecondOrderBooster
from delinq.models.store import load_models, save_models
from delinq.models.training import (
    MODEL_NAMES,
    SMALL_GRIDS,
    ModelSet,
    evaluate,
    feature_importance,
    top_features,
    train_all,
    train_model,
)
from delinq.operators import loans as loan_ops
from delinq.operators import metrics, preprocess, sampling
from delinq.operators import outreach as out_ops
from delinq.plans import jobs
from delinq.plans.base import (
    AS_OF,
    AS_OF_TIME,
    CHECKS,
    core_requests_of,
    master_of,
    outreach_of,
    payment_rows_of,
    register,
    rule_scored_of,
    scored_docs_of,
)
from delinq.plans.check_sql import SIGMOID, fallback, rounded, service_scale, with_ctes
from delinq.session import materialise, scratch_path
from delinq.sources import adapters, catalog, files
from delinq.streaming.scoring import read_stream, score_stream_by_registry


_SHOWN = ["age", "annual_income", "debt_to_income_ratio", "risk_score", "years_since_graduation", "high_debt_burden"]
_ENCODED = {
    "state_FL": "state = 'FL'",
    "gender_M": "gender = 'M'",
    "housing_status_Rent": "housing_status = 'Rent'",
    "age_group_Middle": "age_group = 'Middle'",
    "income_category_nan": "income_category is null",
    "credit_category_Poor": "credit_category = 'Poor'",
}


@register(
    "h1_features",
    with_ctes(
        "select borrower_id, graduate_degree::double as graduate_degree, "
        + ", ".join(
            f"""{rounded(f"({c} - (select avg({c}) from imputed)) / (select stddev_pop({c}) from imputed)", 6)} as {c}"""
            for c in _SHOWN
        )
        + ", "
        + ", ".join(f"coalesce({test}, false)::int::double as {name}" for name, test in _ENCODED.items())
        + " from imputed",
        "imputed",
    ),
)
def _(spark, d):
    master = materialise(master_of(spark, d), "master")
    wide = preprocess.fit_features(master, AS_OF).transform(master)
    return wide.select(
        "borrower_id",
        "graduate_degree",
        *[np_round(F.col(c), 6).alias(c) for c in _SHOWN],
        *[F.col(c) for c in _ENCODED],
    )


_EACH_MODEL = f"(select unnest({sorted(MODEL_NAMES)}) as model)"
# Moderate settings: enough to rank borrowers, one short fit each.
_LIGHT = {
    "logistic_regression": {"maxIter": 50},
    "random_forest": {"numTrees": 20, "maxDepth": 5},
    "gradient_boosting": {"maxIter": 10},
    "xgboost": {"maxIter": 10},
}
_masters: dict[tuple[str, str], tuple[DataFrame, DataFrame]] = {}
_prepared: dict[tuple[str, str], tuple] = {}
_trained: dict[tuple[str, str], ModelSet] = {}


def _master(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Payments and the master table, both written, shared by the model queries of a session."""
    key = (spark.sparkContext.applicationId, d)
    if key not in _masters:
        payments = payment_rows_of(spark, d)
        _masters[key] = (payments, materialise(master_of(spark, d, payments), "master"))
    return _masters[key]


def _training_data(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, preprocess.FeatureModel]:
    """Train and test rows and the fitted preprocessing, shared by the model queries of a session."""
    key = (spark.sparkContext.applicationId, d)
    if key not in _prepared:
        split = materialise(sampling.stratified_split(_master(spark, d)[1]), "split")
        features = preprocess.fit_features(split, AS_OF)
        train, test = (materialise(part, "features") for part in scoring.training_frame(split, features))
        _prepared[key] = (train, test, features)
    return _prepared[key]


def _models(spark: SparkSession, d: str) -> tuple[ModelSet, preprocess.FeatureModel]:
    key = (spark.sparkContext.applicationId, d)
    train, test, features = _training_data(spark, d)
    if key not in _trained:
        _trained[key] = train_all(train, test, features.feature_names, params=_LIGHT, balance="weights")
    return _trained[key], features


@register(
    "h2_oversample",
    with_ctes(
        """select l as is_delinquent, (select max(n) from (select count(*) as n from split where split = 'train'
            group by is_delinquent)) as samples from (select 0 as l union all select 1)""",
        "split",
    ),
)
def _(spark, d):
    train, _test, _features = _training_data(spark, d)
    return oversample_minority(train).groupBy("is_delinquent").agg(F.count(F.lit(1)).alias("samples"))


@register(
    "h2_neighbours",
    """select vec_id, rank, other, round_even(dist * 1e6, 0) / 1e6 as dist from (
      select a.vec_id, b.vec_id::varchar as other, list_distance(a.embedding::double[], b.embedding::double[]) as dist,
        (row_number() over (partition by a.vec_id order by list_distance(a.embedding::double[], b.embedding::double[]), b.vec_id::varchar))::int as rank
      from embeddings a join embeddings b on a.vec_id <> b.vec_id) where rank <= 5""",
)
def _(spark, d):
    """Five nearest neighbours of every vector."""
    vectors = adapters.table(spark, d, "embeddings")
    points = vectors.select(F.col("vec_id").cast("string").alias("id"), F.col("embedding").cast("array<double>").alias("x"))
    found = nearest_neighbours(points, 5, block_rows=100)
    return found.select(F.col("id").cast("long").alias("vec_id"), F.posexplode("found").alias("rank", "f")).select(
        "vec_id", (F.col("rank") + 1).alias("rank"), F.col("f.other").alias("other"), np_round(F.col("f.dist"), 6).alias("dist")
    )


def _fit_and_measure(spark: SparkSession, d: str, name: str, **options) -> DataFrame:
    train, test, features = _training_data(spark, d)
    fitted = train_model(train, name, **{"balance": "weights", **options}, **_LIGHT[name])
    fitted.metrics = evaluate(fitted.model, test)
    table = ModelSet({name: fitted}, features.feature_names).metric_table(spark)
    return table.withColumn("cv_auc", F.lit(fitted.cv_score).cast("double"))


@register("h3_logistic_regression")
def _(spark, d):
    return _fit_and_measure(spark, d, "logistic_regression")


@register("h4_random_forest")
def _(spark, d):
    return _fit_and_measure(spark, d, "random_forest")


@register("h5_gradient_boosting")
def _(spark, d):
    return _fit_and_measure(spark, d, "gradient_boosting")


@register("h6_boosting_subsample")
def _(spark, d):
    return _fit_and_measure(spark, d, "xgboost")


#: Raw columns of the one-split check; nulls count as 0.
_SPLIT_COLUMNS = ["age", "annual_income", "credit_score_at_origination", "debt_to_income_ratio", "total_loan_amount", "missed_payment_rate"]


@register(
    "h6_first_split",
    with_ctes(
        f"""select f as feature_number, e as threshold, {rounded("gain", 9)} as gain, {rounded("-gl / (hl + 1)", 9)} as left_weight,
          {rounded("-gr / (hr + 1)", 9)} as right_weight, h as cover
        from (select *, 0.5::double * (gl * gl / (hl + 1) + gr * gr / (hr + 1) - g * g / (h + 1)) as gain
          from (select *, g - gl as gr, h - hl as hr
            from (select f, e, sum(0.5::double - y) filter (where v <= e) as gl, 0.25::double * count(*) filter (where v <= e) as hl,
                sum(0.5::double - y) as g, 0.25::double * count(*) as h from cells join ends using (f) group by f, e)))
        where hl >= 1 and hr >= 1 and gain > 0 order by gain desc, f, e limit 1""".replace(
            "from cells join ends using (f)",
            f"""from (select is_delinquent::double as y, unnest(range({len(_SPLIT_COLUMNS)}))::int as f,
                  unnest([{", ".join(f"coalesce({c}, 0)::double" for c in _SPLIT_COLUMNS)}]) as v from master) cells
                join (select distinct f, v as e from (select f, v, row_number() over (partition by f order by v) as rank,
                    count(*) over (partition by f) as n, max(v) over (partition by f) as top
                  from (select unnest(range({len(_SPLIT_COLUMNS)}))::int as f,
                    unnest([{", ".join(f"coalesce({c}, 0)::double" for c in _SPLIT_COLUMNS)}]) as v from master))
                  cross join (select unnest(range(1, 32)) as k) where rank = (k * n + 31) // 32 and v < top) ends using (f)""",
        ),
        "master",
    ),
)
def _(spark, d):
    """The root of the first tree: its cut, its gain and the weights of both sides."""
    x = F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in _SPLIT_COLUMNS])
    rows = master_of(spark, d).select("borrower_id", schemas.TARGET, array_to_vector(x).alias("features"))
    booster = SecondOrderBooster(labelCol=schemas.TARGET, maxIter=1, maxDepth=1, maxBins=32, stepSize=1.0)
    nodes = model_nodes(spark, booster.fit(materialise(rows, "rows")))
    side = nodes.select(F.col("node").alias("side"), "value")
    left, right = (side.select(F.col("side").alias(n), F.col("value").alias(f"{n}_weight")) for n in ("left", "right"))
    return nodes.where("node = 0").join(left, "left").join(right, "right").select(
        F.col("feature").alias("feature_number"),
        "threshold",
        *[np_round(F.col(c), 9).alias(c) for c in ("gain", "left_weight", "right_weight")],
        "cover",
    )


@register("h7_grid_search")
def _(spark, d):
    return _fit_and_measure(spark, d, "logistic_regression", grid={"C": [0.1, 1.0]}, folds=3)


#: A small race: two settings a model, short fits.
_RACE_PARAMS = {
    "logistic_regression": {"maxIter": 20},
    "random_forest": {"numTrees": 10},
    "gradient_boosting": {"maxIter": 4},
    "xgboost": {"maxIter": 4},
}


@register(
    "h7_racing",
    f"select model, 2::bigint as settings, 1::bigint as overall_winners, true as winner_ran_all_folds, true as dropped_ones_stopped from {_EACH_MODEL}",
)
def _(spark, d):
    """All four models on shared folds, clear losers dropped: what holds for the race of every model."""
    train, _test, _features = _training_data(spark, d)
    table = racing.race(train, grids=SMALL_GRIDS, folds=3, balance="weights", params=_RACE_PARAMS, parallelism=4).table(spark)
    per = table.groupBy("model", "setting").agg(
        F.count(F.lit(1)).alias("fits"), F.max("dropped_after").alias("dropped_after"), F.max("winner").alias("winner")
    )
    stopped = F.col("fits") == F.coalesce(F.col("dropped_after") + 1, F.lit(3))
    total = per.agg(F.count_if("winner").alias("n"), F.bool_or(F.col("winner") & (F.col("fits") == 3)).alias("whole"))
    return per.groupBy("model").agg(F.count(F.lit(1)).alias("settings"), F.bool_and(stopped).alias("dropped_ones_stopped")).select(
        "model",
        "settings",
        total.select("n").scalar().alias("overall_winners"),
        total.select("whole").scalar().alias("winner_ran_all_folds"),
        "dropped_ones_stopped",
    )


@register(
    "h8_select_best",
    with_ctes(
        """select model, position, test_f1, test_accuracy, adjusted_score from (
          select *, case when test_accuracy >= 1 then test_f1 * 0.9 else test_f1 end as adjusted_score from (
            select t as model, cast(t / 500 as int) as position, coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) as test_f1,
              (tp + tn) / (tp + fp + fn + tn) as test_accuracy
            from (select t, count(*) filter (where n_chars > t and quality = 1) as tp,
                count(*) filter (where n_chars > t and quality <> 1) as fp,
                count(*) filter (where n_chars <= t and quality = 1) as fn,
                count(*) filter (where n_chars <= t and quality <> 1) as tn
              from scored_docs cross join (select unnest([500, 1000, 2000]) as t) group by t)))
        where adjusted_score > 0 order by adjusted_score desc, position limit 1""",
        "scored_docs",
    ),
)
def _(spark, d):
    docs = scored_docs_of(spark, d)
    table = None
    for threshold in (500, 1000, 2000):
        called = docs.withColumn("prediction", (F.col("n_chars") > threshold).cast("int"))
        row = metrics.class_metrics(called, "prediction", "quality").select(
            F.lit(threshold).alias("model"), F.lit(threshold // 500).alias("position"), "test_f1", "test_accuracy"
        )
        table = row if table is None else table.unionByName(row)
    return metrics.select_best(table)


@register("h9_predict_all")
def _(spark, d):
    models, features = _models(spark, d)
    answers = scoring.predict_all(core_requests_of(spark, d), models, features, AS_OF_TIME)
    return answers.select(
        "borrower_id", "risk_assessment.*", "model_used", F.size("all_model_predictions").alias("models"), "error", "error_type"
    )


@register("h10_predict")
def _(spark, d):
    models, features = _models(spark, d)
    scored = scoring.predict(_master(spark, d)[1], models, features)
    return scored.select("borrower_id", "risk_probability", "risk_prediction", "risk_category", "risk_score")


@register("h11_batch_score")
def _(spark, d):
    models, features = _models(spark, d)
    source = f"{scratch_path(spark, 'requests')}.csv"
    files.write_csv(catalog.conform(_master(spark, d)[1], schemas.REQUEST), source)
    return jobs.batch_score(spark, source, f"{scratch_path(spark, 'scores')}.json", models, features, AS_OF_TIME)


@register("h12_importance")
def _(spark, d):
    models, features = _models(spark, d)
    return top_features(models.models["random_forest"], features.feature_names, spark, 20)


_scoring: dict[tuple[str, str], scoring.ScoringSet] = {}


def _compiled(spark: SparkSession, d: str) -> scoring.ScoringSet:
    key = (spark.sparkContext.applicationId, d)
    if key not in _scoring:
        _scoring[key] = scoring.ScoringSet.of(spark, *_models(spark, d))
    return _scoring[key]


#: Probabilities of compiled and library models may differ in the last digits.
_SAME = 1e-12


@register("b34_responses", with_ctes(
    " union all ".join(
        f"select borrower_id, '{name}' as model, {rounded(p, 4)} as risk_probability, {rounded(f'({p}) * 100', 2)} as risk_score,"
        f" {service_scale(f'({p})')} as risk_category from master"
        for name, p in {
            "fallback": fallback("credit_score_at_origination", "debt_to_income_ratio"), "factor": "risk_score / 100", "sigmoid": SIGMOID
        }.items()
    ),
    "master",
))
def _(spark, d):
    """Formatted responses of three rule models for every borrower."""
    views = jobs.rule_predictions(master_of(spark, d))
    return views.select("borrower_id", F.explode("predictions").alias("model", "p")).select("borrower_id", "model", "p.*")


@register(
    "h9_compiled",
    with_ctes(
        """select count(*) as requests, count(*) filter (where annual_income is not null) as answered,
          count(*) filter (where annual_income is null) as errors, 0::bigint as differing
        from borrowers join loan_summary using (borrower_id)""",
        "borrowers",
        "loan_summary",
    ),
)
def _(spark, d):
    """Answers of all compiled models against those of the library's models."""
    models, features = _models(spark, d)
    requests = materialise(core_requests_of(spark, d), "requests")
    answers = [
        scoring.predict_all(requests, m, features, AS_OF_TIME).select("borrower_id", F.to_json(F.struct("*")).alias(side), "model_used")
        for m, side in ((models, "a"), (_compiled(spark, d), "b"))
    ]
    both = answers[0].drop("model_used").join(answers[1], "borrower_id")
    return both.agg(
        F.count(F.lit(1)).alias("requests"),
        F.count("model_used").alias("answered"),
        F.count_if(F.col("model_used").isNull()).alias("errors"),
        F.count_if(F.col("a") != F.col("b")).alias("differing"),
    )


@register(
    "h10_compiled",
    with_ctes(f"select model, count(*) as borrowers, 0::bigint as differing from master cross join {_EACH_MODEL} group by model", "master"),
)
def _(spark, d):
    """Probabilities, predictions and categories of each compiled model against those of the library's model."""
    models, features = _models(spark, d)
    master = _master(spark, d)[1]
    out = None
    for name in sorted(models.models):
        first, second = (
            scoring.predict(master, m, features, name).select("borrower_id", F.struct("risk_probability", "risk_prediction", "risk_category").alias(side))
            for m, side in ((models, "a"), (_compiled(spark, d), "b"))
        )
        same = (F.abs(F.col("a.risk_probability") - F.col("b.risk_probability")) <= _SAME) & (
            F.struct("a.risk_prediction", "a.risk_category").eqNullSafe(F.struct("b.risk_prediction", "b.risk_category"))
        )
        row = first.join(second, "borrower_id").agg(
            F.lit(name).alias("model"), F.count(F.lit(1)).alias("borrowers"), F.count_if(~F.coalesce(same, F.lit(False))).alias("differing")
        )
        out = row if out is None else out.unionByName(row)
    return out


@register(
    "j1_model_stream",
    with_ctes(
        """select count(*) as requests, count(*) filter (where annual_income is null) as errors, 0::bigint as differing, 1::bigint as versions
        from borrowers join loan_summary using (borrower_id)""",
        "borrowers",
        "loan_summary",
    ),
)
def _(spark, d):
    """Arriving requests scored by the newest published models, against the batch answers of the library's models."""
    models, features = _models(spark, d)
    root, output = scratch_path(spark, "registry"), scratch_path(spark, "scored")
    registry.publish(spark, root, _compiled(spark, d), 1)
    registry.publish(spark, root, _compiled(spark, d), 2)
    arriving = adapters.borrowers_from(read_stream(spark, d, adapters.table(spark, d, "customer").schema, glob="customer.parquet"))
    summary = loan_ops.loan_summary(adapters.loans(spark, d))
    incoming = arriving.join(summary, "borrower_id").select("borrower_id", *schemas.CORE_FIELDS)
    score_stream_by_registry(incoming, root, output, scratch_path(spark, "state"), AS_OF_TIME).awaitTermination()
    scored = spark.read.parquet(output).drop("batch")
    batch = scoring.predict_all(core_requests_of(spark, d), models, features, AS_OF_TIME)
    a = scored.select("borrower_id", "model_version", "error", F.to_json(F.struct(*batch.columns)).alias("a"))
    both = a.join(batch.select("borrower_id", F.to_json(F.struct("*")).alias("b")), "borrower_id", "full")
    return both.agg(
        F.count("a").alias("requests"),
        F.count("error").alias("errors"),
        F.count_if(~F.col("a").eqNullSafe(F.col("b"))).alias("differing"),
        F.count_distinct("model_version").alias("versions"),
    )


@register("h11_compiled", with_ctes("select count(*) as records, 0::bigint as differing from master", "master"))
def _(spark, d):
    """Batch records of the best compiled model against those of the library's model."""
    models, features = _models(spark, d)
    requests = catalog.conform(_master(spark, d)[1], schemas.REQUEST)
    first, second = (
        scoring.batch_records(requests, m, features, AS_OF_TIME).select(
            "borrower_id", np_round(F.col("risk_probability"), 9).alias(f"p{side}"), F.struct("risk_prediction", "risk_category", "model_version", "lower_bound", "upper_bound").alias(side)
        )
        for m, side in ((models, "a"), (_compiled(spark, d), "b"))
    )
    both = first.join(second, "borrower_id")
    same = (F.col("pa") == F.col("pb")) & F.col("a").eqNullSafe(F.col("b"))
    return both.agg(F.count(F.lit(1)).alias("records"), F.count_if(~F.coalesce(same, F.lit(False))).alias("differing"))


@register("h12_compiled", f"select model, 0::bigint as differing, model <> 'logistic_regression' as sums_to_one from {_EACH_MODEL}")
def _(spark, d):
    """Importance (absolute coefficient) of each feature from the node table against the model's own; F1 orders by it."""
    models, features = _models(spark, d)
    kinds = {"random_forest": "forest", "gradient_boosting": "boosted", "xgboost": "second"}
    names = spark.createDataFrame(list(enumerate(features.feature_names)), "number int, feature string")
    out = None
    for name in sorted(models.models):
        nodes = materialise(model_nodes(spark, models.models[name].model), "nodes")
        if name in kinds:
            own = node_importance(nodes, kinds[name])
        else:
            own = nodes.where("feature >= 0").select("feature", F.abs("value").alias("importance"))
        named = names.join(own.withColumnRenamed("feature", "number"), "number", "left").select(
            "feature", F.coalesce("importance", F.lit(0.0)).alias("own")
        )
        both = feature_importance(models.models[name], features.feature_names, spark).join(named, "feature", "full")
        row = both.agg(
            F.lit(name).alias("model"),
            F.count_if(F.coalesce(F.abs(F.col("own") - F.col("importance")) > 1e-9, F.lit(True))).alias("differing"),
            (F.abs(F.sum("own") - 1) < 1e-9).alias("sums_to_one"),
        )
        out = row if out is None else out.unionByName(row)
    return out


@register("h14_compiled", "select 0::bigint as differing, true as lists_someone")
def _(spark, d):
    """The outreach list by the compiled forest against that by the library's forest."""
    models, features = _models(spark, d)
    payments, master = _master(spark, d)
    first, second = (
        out_ops.high_risk(jobs.outreach_table(jobs.with_model_scores(master, m, features, "random_forest"), payments, AS_OF_TIME)).select(
            "borrower_id", F.to_json(F.struct("*")).alias(side)
        )
        for m, side in ((models, "a"), (_compiled(spark, d), "b"))
    )
    both = first.join(second, "borrower_id", "full")
    return both.agg(F.count_if(~F.col("a").eqNullSafe(F.col("b"))).alias("differing"), (F.count("a") > 0).alias("lists_someone"))


@register("a13_model_store", with_ctes("select count(*) as borrowers, 0::bigint as differing from master", "master"))
def _(spark, d):
    models, features = _models(spark, d)
    root = scratch_path(spark, "models")
    save_models(spark, models, features, root)
    again, features_again = load_models(spark, root)
    master = _master(spark, d)[1]
    first = scoring.predict(master, models, features).select("borrower_id", F.col("risk_probability").alias("a"))
    second = scoring.predict(master, again, features_again).select("borrower_id", F.col("risk_probability").alias("b"))
    both = first.join(second, "borrower_id")
    return both.agg(F.count(F.lit(1)).alias("borrowers"), F.count_if(F.col("a") != F.col("b")).alias("differing"))


@register("h14_outreach_rules", with_ctes("select * from high_risk", "high_risk"))
def _(spark, d):
    root = scratch_path(spark, "outreach-run")
    result = jobs.run_outreach(rule_scored_of(spark, d), adapters.payments(spark, d), root, AS_OF_TIME)
    return files.read_json(spark, result.output_files["json"], outreach_of(spark, d).schema, array=False)


@register("h14_outreach_models")
def _(spark, d):
    models, features = _models(spark, d)
    payments, master = _master(spark, d)
    scored = jobs.with_model_scores(master, models, features, "random_forest")
    return out_ops.high_risk(jobs.outreach_table(scored, payments, AS_OF_TIME))


def _rule_scored(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Borrowers scored by the rules, and their payments; any number of runs may read them."""
    payments = payment_rows_of(spark, d)
    return jobs.with_rule_scores(materialise(master_of(spark, d, payments), "master")), payments


@register("a11_summary_sink", CHECKS["d10_summary"])
def _(spark, d):
    result = jobs.run_outreach(*_rule_scored(spark, d), scratch_path(spark, "outreach-run"), AS_OF_TIME)
    written = spark.read.json(result.output_files["summary"])
    return written.select(
        "total_borrowers",
        "average_risk_score",
        "delinquent_borrowers",
        "total_outstanding_balance",
        "average_outstanding_balance",
        "data_quality.completeness",
        "data_quality.missing_values",
    )


@register(
    "a12_output_runs",
    with_ctes(
        """select '20250101_000000' as run_ts, count(*) as borrowers from high_risk
        union all select '20250201_000000', count(*) from outreach""",
        "high_risk",
    ),
)
def _(spark, d):
    root = scratch_path(spark, "outreach-run")
    scored, payments = _rule_scored(spark, d)
    jobs.run_outreach(scored, payments, root, AS_OF_TIME)
    jobs.run_outreach(scored, payments, root, dt.datetime(2025, 2, 1), filter_high_risk=False)
    runs = spark.read.schema("borrower_id string, run_ts string").json(f"{root}/json")
    return runs.groupBy("run_ts").agg(F.count(F.lit(1)).alias("borrowers"))
