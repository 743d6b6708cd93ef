"""Prediction responses: formatting, consensus, report text, JSON wrapping and unwrapping."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from delinq.functions.numeric import np_round
from delinq.functions.risk import service_category

PREDICTION_TYPE = "struct<risk_probability:double,risk_score:double,risk_category:string>"


def prediction(probability: Column) -> Column:
    """Formatted prediction of one model; NULL if the model gave none."""
    return F.when(
        probability.isNotNull(),
        F.struct(
            np_round(probability, 4).alias("risk_probability"),
            np_round(probability * 100, 2).alias("risk_score"),
            service_category(probability).alias("risk_category"),
        ),
    )


def prediction_map(probabilities: dict[str, Column]) -> Column:
    """map<model, prediction> with the models that gave a result."""
    parts: list[Column] = []
    for name, probability in probabilities.items():
        parts += [F.lit(name), prediction(probability)]
    return F.map_filter(F.create_map(*parts), lambda _, v: v.isNotNull())


def category_count(predictions: Column, category: str) -> Column:
    hits = F.filter(F.map_values(predictions), lambda p: p["risk_category"] == category)
    return F.size(hits)


def consensus_text(predictions: Column) -> Column:
    return F.format_string(
        "Consensus: %d High, %d Medium, %d Low risk predictions",
        category_count(predictions, "High"),
        category_count(predictions, "Medium"),
        category_count(predictions, "Low"),
    )


def _text(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit("Unknown"))


def _dollars(value: Column) -> Column:
    return F.concat(F.lit("$"), F.format_number(F.coalesce(value.cast("double"), F.lit(0.0)), 0))


def _one_decimal(value: Column) -> Column:
    return F.format_string("%.1f", np_round(value, 1))


def profile_text() -> Column:
    """Borrower block of the report, from the master columns."""
    c = F.col
    dti = F.coalesce(c("debt_to_income_ratio"), F.lit(0.0))
    # Line labels of the block.
    return F.concat_ws(
        "\n",
        F.lit("Borrower Profile:"),
        F.concat(F.lit("- ID: "), _text(c("borrower_id"))),
        F.concat(F.lit("- Age: "), _text(c("age"))),
        F.concat(F.lit("- Credit Score: "), _text(c("credit_score_at_origination"))),
        F.concat(F.lit("- Annual Income: "), _dollars(c("annual_income"))),
        F.concat(F.lit("- Employment: "), _text(c("employment_status"))),
        F.concat(F.lit("- Total Loan Amount: "), _dollars(c("total_loan_amount"))),
        F.concat(F.lit("- Debt-to-Income Ratio: "), _one_decimal(dti * 100), F.lit("%")),
        F.concat(
            F.lit("- Education: "),
            _text(c("degree_type")),
            F.lit(" degree, graduated "),
            _text(c("graduation_year")),
        ),
        F.concat(F.lit("- GPA: "), _text(c("gpa"))),
        F.concat(F.lit("- Location: "), _text(c("state"))),
        F.concat(F.lit("- Housing: "), _text(c("housing_status"))),
    )


def result_text(model: Column, probability: Column, score: Column, category: Column) -> Column:
    """Model block of the report; missing parts get the documented defaults."""
    return F.concat_ws(
        "\n",
        F.lit("ML Model Results:"),
        F.concat(F.lit("- Primary Model: "), F.coalesce(model, F.lit("Machine Learning Model"))),
        F.concat(F.lit("- Risk Category: "), F.coalesce(category, F.lit("Medium"))),
        F.concat(F.lit("- Risk Score: "), _one_decimal(F.coalesce(score, F.lit(50.0))), F.lit("/100")),
        F.concat(
            F.lit("- Risk Probability: "),
            _one_decimal(F.coalesce(probability, F.lit(0.5)) * 100),
            F.lit("%"),
        ),
    )


def models_text(predictions: Column) -> Column:
    """One line per model, in name order, and the consensus line."""
    names = F.array_sort(F.map_keys(predictions))
    lines = F.transform(
        names,
        lambda n: F.concat(
            F.lit("- "),
            n,
            F.lit(": "),
            _text(predictions[n]["risk_category"]),
            F.lit(" ("),
            _one_decimal(F.coalesce(predictions[n]["risk_score"], F.lit(0.0))),
            F.lit("/100)"),
        ),
    )
    return F.concat_ws(
        "\n",
        F.lit("Model Consensus Analysis:"),
        F.array_join(lines, "\n"),
        F.concat(F.lit("- "), consensus_text(predictions)),
    )


_ASSESSMENT = "risk_probability double, overall_risk_probability double, risk_score double, risk_category string"


def unwrap_response(body: Column) -> Column:
    """Risk assessment struct out of response JSON, newest shape first, older shapes after.

    Shapes tried in order: response.prediction.risk_assessment, the first entry of
    response.prediction.all_model_predictions, risk_assessment, response.risk_assessment,
    response, the body itself.
    """
    path = lambda p: F.get_json_object(body, p)
    prediction_part = path("$.response.prediction.risk_assessment")
    model_map = F.from_json(path("$.response.prediction.all_model_predictions"), "map<string,string>")
    first_model = F.try_element_at(F.map_keys(model_map), F.lit(1))
    model_part = F.when(prediction_part.isNull(), model_map[first_model])
    assessment = F.coalesce(
        prediction_part,
        model_part,
        path("$.risk_assessment"),
        path("$.response.risk_assessment"),
        path("$.response"),
        body,
    )
    parsed = F.from_json(assessment, _ASSESSMENT)
    probability = F.coalesce(parsed["risk_probability"], parsed["overall_risk_probability"], F.lit(0.0))
    score = parsed["risk_score"]
    return F.struct(
        probability.alias("risk_probability"),
        F.when(score.isNull() | (score == 0), probability * 100).otherwise(score).alias("risk_score"),
        F.coalesce(F.nullif(parsed["risk_category"], F.lit("")), service_category(probability)).alias(
            "risk_category"
        ),
        F.when(prediction_part.isNotNull(), F.coalesce(path("$.response.prediction.model_used"), F.lit("unknown")))
        .when(model_part.isNotNull(), first_model)
        .alias("model_used"),
    )


def request_json(fields: list[str]) -> Column:
    """Request body with the given fields."""
    return F.to_json(F.struct(*[F.col(f) for f in fields]))
