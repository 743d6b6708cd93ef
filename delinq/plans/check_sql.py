"""Shared parts of the SQL texts that check the registered queries on a second engine."""

from __future__ import annotations

from delinq import schemas
from delinq.sources import adapters

NAMES = {n: n for n in ("customer", "orders", "lineitem")}


def rounded(x: str, digits: int) -> str:
    return f"round_even(({x}) * 1e{digits}, 0) / 1e{digits}"


def money(x: str) -> str:
    return f"cast(sum(cast({x} as decimal(18,2))) as double)"


def mean(x: str) -> str:
    return f"cast(sum(cast({x} as decimal(20,6))) as double) / count({x})"


def unit(key: str, seed: int = 42) -> str:
    return f"cast('0x' || substr(md5({key} || ':{seed}'), 1, 8) as bigint) / 4294967296.0"


def fallback(credit: str, dti: str) -> str:
    return f"greatest(0.1, least(0.9, (850.0 - coalesce({credit}, 650)) / 550 + coalesce({dti}, 0.5) * 0.3))"


def service_scale(p: str) -> str:
    return f"case when {p} > 0.7 then 'High' when {p} > 0.3 then 'Medium' when {p} is not null then 'Low' end"


def score_scale(s: str) -> str:
    return (
        f"case when {s} <= 0 then null when {s} <= 25 then 'Low' when {s} <= 50 then 'Medium'"
        f" when {s} <= 75 then 'High' when {s} <= 100 then 'Critical' end"
    )


RECENT = "payment_date >= (select max(payment_date) - interval 6 month from payments)"
MISSED = "payment_status = 'Missed Payment'"
SIGMOID = "1 / (1 + exp(-(risk_score - 50) / 10))"

STATS = f"""
  {rounded("avg(days_late)", 2)} as avg_days_late, max(days_late) as max_days_late,
  {rounded("coalesce(stddev_samp(days_late), 0)", 2)} as std_days_late,
  {money("actual_amount")} as total_payments_made, count(actual_amount) as total_payment_count,
  {money("scheduled_amount")} as total_scheduled, count(*) filter (where {MISSED}) as missed_payment_count"""

RATIOS = """coalesce(total_payments_made / nullif(total_scheduled, 0), 0) as payment_ratio,
  coalesce(missed_payment_count / nullif(total_payment_count, 0), 0) as missed_payment_rate"""

FACTOR_SCORE = """least(100.0, greatest(0.0,
  case when credit_score_at_origination < 580 then 35 when credit_score_at_origination < 650 then 20
    when credit_score_at_origination < 720 then 10 else 2 end
  + case when debt_to_income_ratio > 0.25 then 25 when debt_to_income_ratio > 0.15 then 15
    when debt_to_income_ratio > 0.10 then 8 else 2 end
  + least(20, missed_payment_rate * 50) + least(10, recent_missed_payments * 3)
  + case when employment_status = 'Unemployed' then 15 when employment_status = 'Student' then 8
    when employment_status in ('Part-time', 'Employed Part-time') then 5 else 0 end))"""

ACTION = """case when days_delinquent > 90 then 'Immediate Collection Action'
  when days_delinquent > 30 then 'Urgent Payment Arrangement'
  when risk_category = 'Critical' then 'Proactive Outreach - High Priority'
  when risk_category = 'High' then 'Proactive Outreach - Medium Priority'
  when risk_category = 'Medium' then 'Educational Communication' else 'Standard Monitoring' end"""

PRIORITY = f"""case {ACTION} when 'Immediate Collection Action' then 1 when 'Urgent Payment Arrangement' then 2
  when 'Proactive Outreach - High Priority' then 2 when 'Proactive Outreach - Medium Priority' then 3
  when 'Educational Communication' then 4 else 5 end"""

_NUMERIC = schemas.NUMERIC_FEATURES
_CATEGORICAL = schemas.CATEGORICAL_FEATURES


def _mode(column: str) -> str:
    return (
        f"(select {column} from master where {column} is not null group by {column}"
        f" order by count(*) desc, {column} limit 1)"
    )


ENGINEERED = """
  case when age <= 0 then null when age <= 25 then 'Young' when age <= 35 then 'Middle' when age <= 45 then 'Mature'
    when age <= 100 then 'Senior' end as age_group,
  case when annual_income <= 0 then null when annual_income <= 30000 then 'Low' when annual_income <= 50000 then 'Lower-Middle'
    when annual_income <= 75000 then 'Middle' when annual_income <= 100000 then 'Upper-Middle'
    when annual_income > 100000 then 'High' end as income_category,
  case when credit_score_at_origination <= 0 then null when credit_score_at_origination <= 580 then 'Poor'
    when credit_score_at_origination <= 670 then 'Fair' when credit_score_at_origination <= 740 then 'Good'
    when credit_score_at_origination <= 800 then 'Very Good' when credit_score_at_origination <= 850 then 'Excellent' end
    as credit_category,
  coalesce(debt_to_income_ratio > 0.4, false)::int as high_debt_burden,
  coalesce(loan_count > 1, false)::int as multiple_loans,
  coalesce(total_loan_amount > 50000, false)::int as large_loan_amount,
  coalesce(missed_payment_rate > 0.1, false)::int as frequent_late_payments,
  coalesce(recent_missed_payments > 0, false)::int as recent_payment_issues,
  coalesce(gpa > 3.5, false)::int as high_gpa,
  coalesce(degree_type in ('Masters', 'Doctorate'), false)::int as graduate_degree,
  coalesce(completion_status = 'Completed', false)::int as completed_education,
  coalesce(state in ('NV', 'FL', 'AZ', 'CA', 'MI'), false)::int as high_risk_state,
  coalesce(employment_status = 'Employed Full-time', false)::int as stable_employment,
  2025 - graduation_year as years_since_graduation,
  coalesce(2025 - graduation_year <= 2, false)::int as recent_graduate"""

_CLIPS = {
    "annual_income": (0, 500000),
    "debt_to_income_ratio": (0, 5),
    "risk_score": (0, 100),
}


def _imputed_column(name: str) -> str:
    filled = f"coalesce(cast({name} as double), (select median({name}) from master))"
    if name in _CLIPS:
        low, high = _CLIPS[name]
        filled = f"greatest({low}, least({high}, {filled}))"
    return f"{filled} as {name}"


CTES: dict[str, tuple[list[str], str]] = {
    "borrowers": ([], adapters.BORROWERS_SQL.format(**NAMES)),
    "education": ([], adapters.EDUCATION_SQL.format(**NAMES)),
    "loans": ([], adapters.LOANS_SQL.format(**NAMES)),
    "payments": ([], adapters.PAYMENTS_SQL.format(**NAMES)),
    "stats": (["payments"], f"select *, {RATIOS} from (select borrower_id, {STATS} from payments group by 1)"),
    "recent": (
        ["payments"],
        f"""select borrower_id, {rounded("avg(days_late)", 2)} as recent_avg_days_late,
            count(*) filter (where {MISSED}) as recent_missed_payments
            from payments where {RECENT} group by 1""",
    ),
    "features": (
        ["stats", "recent"],
        f"""select *,
          (recent_missed_payments >= 2 or recent_avg_days_late > 30 or max_days_late > 90)::int as is_delinquent,
          {rounded('''least(100.0, greatest(0.0, missed_payment_rate * 40 + recent_avg_days_late / 30 * 30
            + (max_days_late > 60)::int * 30))''', 1)} as risk_score
        from (select s.*, coalesce(r.recent_avg_days_late, 0) as recent_avg_days_late,
            cast(coalesce(r.recent_missed_payments, 0) as double) as recent_missed_payments
          from stats s left join recent r using (borrower_id))""",
    ),
    "loan_summary": (
        ["loans"],
        f"""select borrower_id, {money("loan_amount")} as total_loan_amount, count(loan_amount) as loan_count,
          {rounded(mean("loan_amount"), 2)} as avg_loan_amount, {rounded(mean("interest_rate"), 2)} as avg_interest_rate,
          {money("current_balance")} as total_current_balance, {money("monthly_payment")} as total_monthly_payment
        from loans group by 1""",
    ),
    "joined": (
        ["borrowers", "education", "features", "loan_summary"],
        f"""select {", ".join(schemas.MASTER.names)} from (
          select *, {rounded("total_monthly_payment * 12 / nullif(annual_income, 0)", 3)} as debt_to_income_ratio
          from borrowers join education using (borrower_id) join features using (borrower_id)
            join loan_summary using (borrower_id))""",
    ),
    "master": (
        ["joined"],
        f"""select * replace (({unit("borrower_id")} < {SIGMOID})::int as is_delinquent)
          from (select * replace ({FACTOR_SCORE} as risk_score) from joined)""",
    ),
    "engineered": (["master"], f"select *, {ENGINEERED} from master"),
    "imputed": (
        ["engineered"],
        "select * replace ("
        + ", ".join(_imputed_column(n) for n in _NUMERIC)
        + ", "
        + ", ".join(f"coalesce({c}, {_mode(c)}) as {c}" for c in _CATEGORICAL)
        + ") from engineered",
    ),
    "split": (
        ["master"],
        """select *, case when row_number() over (partition by is_delinquent order by md5(borrower_id || ':42'))
            <= round_even(0.2 * count(*) over (partition by is_delinquent), 0) then 'test' else 'train' end as split
          from master""",
    ),
    "activity": (
        ["payments"],
        f"""select borrower_id,
          coalesce(max(days_late) filter (where {MISSED} and {RECENT}), 0) as days_delinquent,
          strftime(max(payment_date) filter (where actual_amount > 0), '%Y-%m-%d') as last_payment_date,
          strftime(cast(max(payment_date) as date) + interval 1 month, '%Y-%m-%d') as next_due_date
        from payments group by 1""",
    ),
    "rule_scored": (
        ["master"],
        f"""select * replace (delinquency_probability * 100 as risk_score),
            {score_scale("delinquency_probability * 100")} as risk_category
          from (select *, {fallback("credit_score_at_origination", "debt_to_income_ratio")} as delinquency_probability
            from master)""",
    ),
    "details": (
        ["rule_scored", "activity"],
        """select *, current_balance * case when days_delinquent > 0 then 1.1::double else 1.0::double end as total_owed
          from (select r.*, 'ML_' || lpad(substr(borrower_id, 5), 8, '0') as loan_id,
              total_current_balance as current_balance,
              coalesce(a.days_delinquent, 0) as days_delinquent, a.last_payment_date, a.next_due_date
            from rule_scored r left join activity a using (borrower_id))""",
    ),
    "outreach": (
        ["details"],
        f"""select borrower_id, state, loan_id, {rounded("current_balance", 2)} as current_balance, days_delinquent,
          {rounded("risk_score", 2)} as risk_score, risk_category,
          {rounded("delinquency_probability", 2)} as delinquency_probability,
          {ACTION} as recommended_action, {PRIORITY} as priority_level, last_payment_date, next_due_date,
          {rounded("total_owed", 2)} as total_owed, '2025-01-01 00:00:00' as processing_date
        from details""",
    ),
    "high_risk": (
        ["outreach"],
        """select * from outreach
          where risk_score >= 50 or days_delinquent > 0 or risk_category in ('High', 'Critical')""",
    ),
    "scored_docs": ([], "select n_chars, quality, toxic from labels join documents using (doc_id)"),
}


def with_ctes(body: str, *names: str) -> str:
    """Prefix the body with the named tables and all they build on."""
    order: list[str] = []

    def visit(name: str) -> None:
        for parent in CTES[name][0]:
            visit(parent)
        if name not in order:
            order.append(name)

    for name in names:
        visit(name)
    parts = [f"{n} as materialized ({CTES[n][1]})" for n in order]
    return f"with {', '.join(parts)} {body}" if parts else body
