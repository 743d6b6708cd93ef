"""The batch jobs: training, batch scoring, outreach run, borrower reports."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from delinq import schemas
from delinq.functions.response import models_text, prediction_map, profile_text, result_text
from delinq.functions.risk import (
    delinquency_probability,
    fallback_probability,
    score_category,
    service_category,
)
from delinq.models.scoring import batch_records, predict, training_frame
from delinq.models.training import ModelSet, train_all
from delinq.operators import outreach as O
from delinq.operators.preprocess import FeatureModel, fit_features
from delinq.operators.requests import require_core_fields
from delinq.operators.sampling import stratified_split
from delinq.session import materialise
from delinq.sources.files import read_records, write_output_set, write_records


def train_from_master(
    master: DataFrame, as_of: dt.date, fit_on: str = "all", test_size: float = 0.2, seed: int = 42, **options
) -> tuple[ModelSet, FeatureModel]:
    """Split, fit the preprocessing, train and compare all models.

    ``fit_on="all"`` fits the preprocessing before the split, as the published results do;
    ``"train"`` keeps test rows out of it.
    """
    split = materialise(stratified_split(materialise(master, "master"), test_size=test_size, seed=seed), "split")
    features = fit_features(split if fit_on == "all" else split.filter(F.col("split") == "train"), as_of)
    train, test = (materialise(part, "features") for part in training_frame(split, features))
    models = train_all(train, test, features.feature_names, seed=seed, **options)
    return models, features


def batch_score(
    spark: SparkSession,
    input_path: str,
    output_path: str,
    models: ModelSet,
    features: FeatureModel,
    as_of: dt.datetime,
) -> DataFrame:
    """Score a CSV or JSON file into another and return the one-row summary.

    The summary reads the written scores, so models run once.
    """
    records = require_core_fields(read_records(spark, input_path, schemas.REQUEST), with_id=True)
    scored = batch_records(records, models, features, as_of)
    write_records(scored, output_path)
    written = read_records(spark, output_path, scored.schema, array=False)
    return O.batch_summary(written)


def with_rule_scores(master: DataFrame) -> DataFrame:
    """Probability, 0-100 score and category from the rule-based fallback."""
    p = fallback_probability(F.col("credit_score_at_origination"), F.col("debt_to_income_ratio"))
    return (
        master.withColumn("delinquency_probability", p)
        .withColumn("risk_score", F.col("delinquency_probability") * 100)
        .withColumn("risk_category", score_category(F.col("risk_score")))
    )


def with_model_scores(
    master: DataFrame, models: ModelSet, features: FeatureModel, name: str | None = None
) -> DataFrame:
    scored = predict(master, models, features, name)
    return scored.withColumnRenamed("risk_probability", "delinquency_probability")


def outreach_table(scored: DataFrame, payments: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Scored borrowers with loan details and actions, as the outreach contract."""
    return O.outreach_projection(O.with_actions(O.with_loan_details(scored, payments)), as_of)


@dataclass(frozen=True)
class OutreachResult:
    status: str
    records_processed: int
    high_risk_identified: int
    output_files: dict[str, str]


def run_outreach(
    scored: DataFrame,
    payments: DataFrame,
    root: str,
    as_of: dt.datetime,
    filter_high_risk: bool = True,
    min_risk_score: float = 50.0,
) -> OutreachResult:
    """Write the outreach list, its summary and headline figures; counts in the result.

    The table is computed once and written to the shared folder; counts, outputs and figures
    read that copy, with the filter pushed down to it.
    """
    table = materialise(outreach_table(scored, payments, as_of), "outreach")
    listed = O.high_risk(table, min_risk_score) if filter_high_risk else table
    files = write_output_set(listed, O.summary_report(listed, as_of), O.short_summary(listed), root, as_of)
    return OutreachResult("success", table.count(), listed.count(), files)


def rule_predictions(master: DataFrame) -> DataFrame:
    """Three rule-based views of the same borrower as a map of predictions."""
    c = F.col
    rules = {
        "fallback": fallback_probability(c("credit_score_at_origination"), c("debt_to_income_ratio")),
        "factor": c("risk_score") / 100,
        "sigmoid": delinquency_probability(c("risk_score")),
    }
    return master.withColumn("predictions", prediction_map(rules))


def borrower_reports(master: DataFrame, model_name: str = "fallback") -> DataFrame:
    """Profile and model text block per borrower, scored by the rule-based fallback."""
    p = fallback_probability(F.col("credit_score_at_origination"), F.col("debt_to_income_ratio"))
    text = F.concat_ws(
        "\n\n",
        profile_text(),
        result_text(F.lit(model_name), p, p * 100, service_category(p)),
        models_text(F.col("predictions")),
    )
    return rule_predictions(master).select("borrower_id", text.alias("report"))
