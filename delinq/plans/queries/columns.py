"""Registered queries: projections and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from delinq import schemas
from delinq.functions import borrower as B
from delinq.functions import loan as L
from delinq.functions import response as R
from delinq.functions import risk as K
from delinq.functions.action import priority_level, recommended_action
from delinq.functions.numeric import np_round
from delinq.operators import requests
from delinq.operators import loans as loan_ops
from delinq.operators import master as master_ops
from delinq.operators import outreach as out_ops
from delinq.operators import payments as pay_ops
from delinq.plans import jobs
from delinq.plans.base import (
    AS_OF,
    core_requests_of,
    joined_of,
    master_of,
    outreach_of,
    register,
    rule_scored_of,
    time_text,
)
from delinq.plans.check_sql import (
    ENGINEERED,
    FACTOR_SCORE,
    SIGMOID,
    fallback,
    rounded,
    score_scale,
    service_scale,
    unit,
    with_ctes,
)
from delinq.sources import adapters


@register("b1_age_group", with_ctes(f"select borrower_id, age_group from (select *, {ENGINEERED} from master)", "master"))
def _(spark, d):
    return master_of(spark, d).select("borrower_id", B.age_group(F.col("age")).alias("age_group"))


@register(
    "b2_income_category",
    with_ctes(f"select borrower_id, income_category from (select *, {ENGINEERED} from master)", "master"),
)
def _(spark, d):
    return master_of(spark, d).select("borrower_id", B.income_category(F.col("annual_income")).alias("income_category"))


@register(
    "b3_credit_category",
    with_ctes(f"select borrower_id, credit_category from (select *, {ENGINEERED} from master)", "master"),
)
def _(spark, d):
    return master_of(spark, d).select(
        "borrower_id", B.credit_category(F.col("credit_score_at_origination")).alias("credit_category")
    )


_FLAGS = [f for f in schemas.FLAG_FEATURES if f not in ("years_since_graduation", "recent_graduate")]


@register(
    "b4_flags",
    with_ctes(f"select borrower_id, {', '.join(_FLAGS)} from (select *, {ENGINEERED} from master)", "master"),
)
def _(spark, d):
    return master_of(spark, d).select("borrower_id", *[c.alias(n) for n, c in B.flag_columns().items()])


@register(
    "b8_years_since",
    with_ctes(
        f"select borrower_id, years_since_graduation, recent_graduate from (select *, {ENGINEERED} from master)", "master"
    ),
)
def _(spark, d):
    year = F.col("graduation_year")
    return master_of(spark, d).select(
        "borrower_id",
        B.years_since_graduation(year, AS_OF).alias("years_since_graduation"),
        B.recent_graduate(year, AS_OF).alias("recent_graduate"),
    )


@register(
    "b9_clip",
    with_ctes(
        """select borrower_id, case when annual_income is not null then greatest(0, least(500000, annual_income)) end as annual_income,
          case when debt_to_income_ratio is not null then greatest(0, least(5, debt_to_income_ratio)) end as debt_to_income_ratio,
          greatest(0, least(100, risk_score)) as risk_score
        from (select borrower_id, annual_income * 5 as annual_income, debt_to_income_ratio * 4 as debt_to_income_ratio,
          risk_score * 2 - 40 as risk_score from master)""",
        "master",
    ),
)
def _(spark, d):
    spread = master_of(spark, d).select(
        "borrower_id",
        (F.col("annual_income") * 5).alias("annual_income"),
        (F.col("debt_to_income_ratio") * 4).alias("debt_to_income_ratio"),
        (F.col("risk_score") * 2 - 40).alias("risk_score"),
    )
    return spread.withColumns(B.clipped_columns())


@register(
    "b10_amortise",
    with_ctes(
        f"""select loan_id, {rounded('''loan_amount * (interest_rate / 1200.0::double)
          / (1 - pow(1 + interest_rate / 1200.0::double, -loan_term_months))''', 2)} as level_payment from loans""",
        "loans",
    ),
)
def _(spark, d):
    c = F.col
    payment = L.monthly_payment(c("loan_amount"), c("interest_rate"), c("loan_term_months"))
    return adapters.loans(spark, d).select("loan_id", payment.alias("level_payment"))


@register(
    "b11_schedule",
    with_ctes(
        """select loan_id, borrower_id, m as month_offset,
          strftime(origination_date + to_months(m), '%Y-%m-%d %H:%M:%S') as due_date, monthly_payment as scheduled_amount
        from loans cross join (select cast(range as int) as m from range(24))""",
        "loans",
    ),
)
def _(spark, d):
    return loan_ops.payment_schedule(adapters.loans(spark, d)).withColumn("due_date", time_text("due_date"))


@register(
    "b12_payment_status",
    with_ctes(
        "select payment_id, payment_status as status, actual_amount as amount from payments",
        "payments",
    ),
)
def _(spark, d):
    days = F.col("days_late")
    return adapters.payments(spark, d).select(
        "payment_id",
        L.payment_status(days).alias("status"),
        L.paid_amount(days, F.col("scheduled_amount")).alias("amount"),
    )


@register(
    "b13_ids",
    """select 'BOR_' || lpad(cast(o_custkey as varchar), 6, '0') as borrower_id,
      'LOAN_' || lpad(cast(o_orderkey as varchar), 8, '0') as loan_id,
      'PAY_' || lpad(cast(o_orderkey as varchar), 8, '0') as payment_id,
      'ML_' || lpad(cast(o_custkey as varchar), 8, '0') as account_id from orders""",
)
def _(spark, d):
    c = F.col
    return adapters.table(spark, d, "orders").select(
        L.format_id("borrower", c("o_custkey")).alias("borrower_id"),
        L.format_id("loan", c("o_orderkey")).alias("loan_id"),
        L.format_id("payment", c("o_orderkey")).alias("payment_id"),
        L.format_id("account", c("o_custkey")).alias("account_id"),
    )


@register("b14_dti", with_ctes("select borrower_id, debt_to_income_ratio from joined", "joined"))
def _(spark, d):
    return joined_of(spark, d).select("borrower_id", "debt_to_income_ratio")


@register("b15_behaviour_score", with_ctes("select borrower_id, risk_score from features", "features"))
def _(spark, d):
    return pay_ops.delinquency_features(adapters.payments(spark, d)).select("borrower_id", "risk_score")


@register("b16_behaviour_target", with_ctes("select borrower_id, is_delinquent from features", "features"))
def _(spark, d):
    return pay_ops.delinquency_features(adapters.payments(spark, d)).select("borrower_id", "is_delinquent")


@register("b17_factor_score", with_ctes(f"select borrower_id, {FACTOR_SCORE} as risk_score from joined", "joined"))
def _(spark, d):
    return master_of(spark, d).select("borrower_id", "risk_score")


@register(
    "b18_sigmoid",
    with_ctes(
        f"""select borrower_id, {rounded(SIGMOID, 9)} as delinquency_probability,
          ({unit("borrower_id")} < {SIGMOID})::int as is_delinquent from master""",
        "master",
    ),
)
def _(spark, d):
    master = master_ops.with_probability(master_of(spark, d))
    return master.select(
        "borrower_id", np_round(F.col("delinquency_probability"), 9).alias("delinquency_probability"), "is_delinquent"
    )


@register(
    "b19_b21_scales",
    with_ctes(
        f"""select borrower_id, case when p <= 0 then null when p <= 0.3 then 'Low' when p <= 0.6 then 'Medium'
            when p <= 0.8 then 'High' when p <= 1 then 'Critical' end as model_category,
          {service_scale("p")} as service_category, {score_scale("risk_score")} as score_category
        from (select borrower_id, risk_score, risk_score / 100 as p from master)""",
        "master",
    ),
)
def _(spark, d):
    score = F.col("risk_score")
    return master_of(spark, d).select(
        "borrower_id",
        K.model_category(score / 100).alias("model_category"),
        K.service_category(score / 100).alias("service_category"),
        K.score_category(score).alias("score_category"),
    )


_QUICK = """case when credit_score_at_origination + annual_income + total_loan_amount is not null
  then least(100.0, greatest(0.0, (800.0 - credit_score_at_origination) / 10
  + greatest(0.0, (50000.0 - annual_income) / 5000) + (total_loan_amount - 30000) / 5000)) end"""
_FILLED = f"""select borrower_id, age, credit_score_at_origination, annual_income, 1 as dependents, 3.0::double as gpa,
  2020 as graduation_year, total_loan_amount, loan_count, total_loan_amount / nullif(loan_count, 0) as avg_loan_amount,
  6.0::double as avg_interest_rate, total_loan_amount * 0.9::double as total_current_balance, total_monthly_payment,
  total_monthly_payment * 12 / nullif(annual_income, 0) as debt_to_income_ratio, 5.0::double as avg_days_late,
  30 as max_days_late, 10.0::double as std_days_late, total_monthly_payment * 12 as total_payments_made,
  12 as total_payment_count, total_monthly_payment * 12 * 1.05::double as total_scheduled, 1 as missed_payment_count,
  0.95::double as payment_ratio, 0.05::double as missed_payment_rate, 5.0::double as recent_avg_days_late,
  1 as recent_missed_payments, {_QUICK} as risk_score, 'Other' as gender, 'CA' as state,
  'Employed' as employment_status, 'Rent' as housing_status, 'State University' as school_name,
  'Bachelors' as degree_type, 'Business' as major, 'Public' as school_type, 'Completed' as completion_status
from borrowers join loan_summary using (borrower_id)"""


@register("b22_default_fill", with_ctes(_FILLED, "borrowers", "loan_summary"))
def _(spark, d):
    return requests.fill_request_defaults(core_requests_of(spark, d))


@register(
    "b23_quick_score",
    with_ctes(
        f"select borrower_id, {rounded(_QUICK, 9)} as quick_score from borrowers join loan_summary using (borrower_id)",
        "borrowers",
        "loan_summary",
    ),
)
def _(spark, d):
    c = F.col
    score = K.quick_score(c("credit_score_at_origination"), c("annual_income"), c("total_loan_amount"))
    return core_requests_of(spark, d).select("borrower_id", np_round(score, 9).alias("quick_score"))


_FALLBACK = fallback("credit_score_at_origination", "debt_to_income_ratio")


@register(
    "b25_fallback_score",
    with_ctes(
        f"""select borrower_id, {rounded(_FALLBACK, 9)} as risk_probability, {rounded(f"{_FALLBACK} * 100", 7)} as risk_score,
          {service_scale(_FALLBACK)} as risk_category from master""",
        "master",
    ),
)
def _(spark, d):
    p = K.fallback_probability(F.col("credit_score_at_origination"), F.col("debt_to_income_ratio"))
    return master_of(spark, d).select(
        "borrower_id",
        np_round(p, 9).alias("risk_probability"),
        np_round(p * 100, 7).alias("risk_score"),
        K.service_category(p).alias("risk_category"),
    )


@register(
    "b26_interval",
    with_ctes(
        f"""select borrower_id, {rounded("greatest(0, p - 0.005)", 4)} as lower_bound,
          {rounded("least(1, p + 0.005)", 4)} as upper_bound
        from (select borrower_id, {rounded(_FALLBACK, 5)} as p from master)""",
        "master",
    ),
)
def _(spark, d):
    p = K.fallback_probability(F.col("credit_score_at_origination"), F.col("debt_to_income_ratio"))
    interval = K.confidence_interval(np_round(p, 5))
    return master_of(spark, d).select(
        "borrower_id", interval["lower_bound"].alias("lower_bound"), interval["upper_bound"].alias("upper_bound")
    )


@register(
    "b27_loan_details",
    with_ctes(
        f"""select borrower_id, loan_id, current_balance, days_delinquent, last_payment_date, next_due_date,
          {rounded("total_owed", 4)} as total_owed from details""",
        "details",
    ),
)
def _(spark, d):
    detailed = out_ops.with_loan_details(rule_scored_of(spark, d), adapters.payments(spark, d))
    return detailed.select(
        "borrower_id",
        "loan_id",
        "current_balance",
        "days_delinquent",
        "last_payment_date",
        "next_due_date",
        np_round(F.col("total_owed"), 4).alias("total_owed"),
    )


@register(
    "b30_actions",
    with_ctes("select borrower_id, recommended_action, priority_level from outreach", "outreach"),
)
def _(spark, d):
    listed = out_ops.with_loan_details(rule_scored_of(spark, d), adapters.payments(spark, d))
    action = recommended_action(F.col("days_delinquent"), F.col("risk_category"))
    return listed.select(
        "borrower_id", action.alias("recommended_action"), priority_level(action).alias("priority_level")
    )


@register("b32_outreach", with_ctes("select * from outreach", "outreach"))
def _(spark, d):
    return outreach_of(spark, d)


@register("b33_high_risk", with_ctes("select * from high_risk", "high_risk"))
def _(spark, d):
    return out_ops.high_risk(outreach_of(spark, d))


_RULE_P = f"{_FALLBACK} as p1, risk_score / 100 as p2, {SIGMOID} as p3"
_COUNT = "((c1 = '{0}')::int + (c2 = '{0}')::int + (c3 = '{0}')::int)"
_CONSENSUS = (
    "'Consensus: ' || " + _COUNT.format("High") + " || ' High, ' || " + _COUNT.format("Medium")
    + " || ' Medium, ' || " + _COUNT.format("Low") + " || ' Low risk predictions'"
)


@register(
    "b35_consensus",
    with_ctes(
        f"""select borrower_id, {_COUNT.format("High")} as high, {_COUNT.format("Medium")} as medium,
          {_COUNT.format("Low")} as low, {_CONSENSUS} as consensus
        from (select borrower_id, {service_scale("p1")} as c1, {service_scale("p2")} as c2, {service_scale("p3")} as c3
          from (select borrower_id, {_RULE_P} from master))""",
        "master",
    ),
)
def _(spark, d):
    p = F.col("predictions")
    return jobs.rule_predictions(master_of(spark, d)).select(
        "borrower_id",
        R.category_count(p, "High").alias("high"),
        R.category_count(p, "Medium").alias("medium"),
        R.category_count(p, "Low").alias("low"),
        R.consensus_text(p).alias("consensus"),
    )


def _line(label: str, text: str) -> str:
    return f"'- {label}: ' || {text}"


def _one(x: str) -> str:
    return f"format('{{:.1f}}', {rounded(x, 1)})"


_REPORT = " || chr(10) || ".join(
    [
        "'Borrower Profile:'",
        _line("ID", "borrower_id"),
        _line("Age", "age"),
        _line("Credit Score", "credit_score_at_origination"),
        _line("Annual Income", "'$' || format('{:,.0f}', coalesce(annual_income, 0.0::double))"),
        _line("Employment", "coalesce(employment_status, 'Unknown')"),
        _line("Total Loan Amount", "'$' || format('{:,.0f}', total_loan_amount)"),
        _line("Debt-to-Income Ratio", _one("coalesce(debt_to_income_ratio, 0) * 100") + " || '%'"),
        _line("Education", "coalesce(degree_type, 'Unknown') || ' degree, graduated ' || graduation_year"),
        _line("GPA", "coalesce(cast(gpa as varchar), 'Unknown')"),
        _line("Location", "coalesce(state, 'Unknown')"),
        _line("Housing", "coalesce(housing_status, 'Unknown') || chr(10)"),
        "'ML Model Results:'",
        _line("Primary Model", "'fallback'"),
        _line("Risk Category", "c1"),
        _line("Risk Score", _one("p1 * 100") + " || '/100'"),
        _line("Risk Probability", _one("p1 * 100") + " || '%' || chr(10)"),
        "'Model Consensus Analysis:'",
        _line("factor", "c2 || ' (' || " + _one(rounded("p2 * 100", 2)) + " || '/100)'"),
        _line("fallback", "c1 || ' (' || " + _one(rounded("p1 * 100", 2)) + " || '/100)'"),
        _line("sigmoid", "c3 || ' (' || " + _one(rounded("p3 * 100", 2)) + " || '/100)'"),
        f"'- ' || {_CONSENSUS}",
    ]
)


@register(
    "b36_report_text",
    with_ctes(
        f"""select borrower_id, {_REPORT} as report
        from (select *, {service_scale("p1")} as c1, {service_scale("p2")} as c2, {service_scale("p3")} as c3
          from (select *, {_RULE_P} from master))""",
        "master",
    ),
)
def _(spark, d):
    return jobs.borrower_reports(master_of(spark, d))


# Response bodies of all known shapes, made from borrowers by text both engines share.
_BODIES = """
select borrower_id, age % 7 as shape, case age % 7
  when 0 then concat('{{"response":{{"prediction":{{"borrower_id":"', borrower_id, '","model_used":"random_forest","risk_assessment":', a, '}}}}}}')
  when 1 then concat('{{"response":{{"prediction":{{"all_model_predictions":{{"gradient_boosting":', a, ',"random_forest":', b, '}}}}}}}}')
  when 2 then concat('{{"risk_assessment":', a, '}}')
  when 3 then concat('{{"response":{{"risk_assessment":', b, '}}}}')
  when 4 then concat('{{"response":', a, '}}')
  when 5 then concat('{{"overall_risk_probability":0.', cast(credit_score_at_origination as string), '}}')
  else a end as body
from (select borrower_id, age, credit_score_at_origination,
    concat('{{"risk_probability":0.', cast(credit_score_at_origination as string), ',"risk_score":', cast(age as string),
      '.5,"risk_category":"Medium"}}') as a,
    concat('{{"risk_probability":0.', cast(credit_score_at_origination as string), ',"risk_score":0}}') as b
  from {borrowers}) x
"""


def _json(path: str, kind: str = "varchar") -> str:
    return f"cast(json_extract_string(part, '{path}') as {kind})"


_UNWRAPPED = f"""select borrower_id, risk_probability, case when coalesce(risk_score, 0) = 0
    then {rounded("risk_probability * 100", 6)} else risk_score end as risk_score,
  coalesce(risk_category, {service_scale("risk_probability")}) as risk_category, model_used
from (select borrower_id, model_used, {_json("$.risk_score", "double")} as risk_score, {_json("$.risk_category")} as risk_category,
    coalesce({_json("$.risk_probability", "double")}, {_json("$.overall_risk_probability", "double")}, 0) as risk_probability
  from (select borrower_id,
      case shape when 0 then json_extract(body, '$.response.prediction.risk_assessment')
        when 1 then json_extract(body, '$.response.prediction.all_model_predictions.gradient_boosting')
        when 2 then json_extract(body, '$.risk_assessment') when 3 then json_extract(body, '$.response.risk_assessment')
        when 4 then json_extract(body, '$.response') else body::json end as part,
      case shape when 0 then json_extract_string(body, '$.response.prediction.model_used')
        when 1 then 'gradient_boosting' end as model_used
    from ({_BODIES.format(borrowers="borrowers")})))"""


@register("b37_unwrap", with_ctes(_UNWRAPPED, "borrowers"))
def _(spark, d):
    bodies = spark.sql(_BODIES, borrowers=adapters.borrowers(spark, d))
    found = bodies.select("borrower_id", R.unwrap_response(F.col("body")).alias("r")).select("borrower_id", "r.*")
    return found.withColumn("risk_score", np_round(F.col("risk_score"), 6))


@register(
    "b37_request_json",
    with_ctes(
        """select borrower_id, '{"borrower_id":"' || borrower_id || '","age":' || age || ',"credit_score_at_origination":'
          || credit_score_at_origination || ',"loan_count":' || loan_count || '}' as request
        from borrowers join loan_summary using (borrower_id)""",
        "borrowers",
        "loan_summary",
    ),
)
def _(spark, d):
    fields = ["borrower_id", "age", "credit_score_at_origination", "loan_count"]
    return core_requests_of(spark, d).select("borrower_id", R.request_json(fields).alias("request"))


@register(
    "b37_parse_requests",
    with_ctes(
        """select borrower_id || suffix as borrower_id, age, loan_count, total_loan_amount from (
          select *, unnest(case when age % 3 = 2 then ['', 'X'] else [''] end) as suffix
          from borrowers join loan_summary using (borrower_id))""",
        "borrowers",
        "loan_summary",
    ),
)
def _(spark, d):
    record = R.request_json(["borrower_id", *schemas.CORE_FIELDS])
    twin = F.regexp_replace(record, '("borrower_id":"[^"]*)"', '$1X"')
    shape = F.col("age") % 3
    body = (
        F.when(shape == 0, record)
        .when(shape == 1, F.concat(F.lit("["), record, F.lit("]")))
        .otherwise(F.concat(F.lit('{"data":['), record, F.lit(","), twin, F.lit("]}")))
    )
    parsed = requests.parse_requests(core_requests_of(spark, d).select(body.alias("body")))
    return parsed.select("borrower_id", "age", "loan_count", "total_loan_amount")
