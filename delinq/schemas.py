"""Table contracts, feature groups and the request contract.

Column names, types, order, ranges and allowed values are fixed values: results are only
right if they equal the published contract.
"""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {"STRING": T.StringType(), "INT": T.IntegerType(), "DOUBLE": T.DoubleType()}


def _struct(text: str) -> T.StructType:
    fields = []
    for item in text.split(","):
        name, kind = item.split()
        fields.append(T.StructField(name, _TYPES[kind], True))
    return T.StructType(fields)


# The seven table contracts.
BORROWERS = _struct(
    "borrower_id STRING, _risk_segment STRING, age INT, credit_score_at_origination INT,"
    "annual_income DOUBLE, employment_status STRING, gender STRING, state STRING,"
    "dependents INT, housing_status STRING"
)
EDUCATION = _struct(
    "borrower_id STRING, school_name STRING, degree_type STRING, major STRING,"
    "graduation_year INT, gpa DOUBLE, school_type STRING, completion_status STRING"
)
LOANS = _struct(
    "loan_id STRING, borrower_id STRING, loan_amount DOUBLE, origination_date STRING,"
    "loan_term_months INT, interest_rate DOUBLE, loan_type STRING, loan_status STRING,"
    "current_balance DOUBLE, monthly_payment DOUBLE"
)
PAYMENTS = _struct(
    "payment_id STRING, loan_id STRING, borrower_id STRING, payment_date STRING,"
    "scheduled_amount DOUBLE, actual_amount DOUBLE, payment_status STRING, days_late INT"
)
DELINQUENCY_FEATURES = _struct(
    "borrower_id STRING, avg_days_late DOUBLE, max_days_late INT, std_days_late DOUBLE,"
    "total_payments_made DOUBLE, total_payment_count INT, total_scheduled DOUBLE,"
    "missed_payment_count INT, payment_ratio DOUBLE, missed_payment_rate DOUBLE,"
    "recent_avg_days_late DOUBLE, recent_missed_payments DOUBLE, is_delinquent INT,"
    "risk_score DOUBLE"
)
LOAN_SUMMARY_COLUMNS = _struct(
    "total_loan_amount DOUBLE, loan_count INT, avg_loan_amount DOUBLE,"
    "avg_interest_rate DOUBLE, total_current_balance DOUBLE, total_monthly_payment DOUBLE,"
    "debt_to_income_ratio DOUBLE"
)
MASTER = T.StructType(
    [f for f in BORROWERS if f.name != "_risk_segment"]
    + [f for f in EDUCATION if f.name != "borrower_id"]
    + [f for f in DELINQUENCY_FEATURES if f.name != "borrower_id"]
    + list(LOAN_SUMMARY_COLUMNS)
)
# The same 36 columns as the master table, in another order.
REALISTIC = T.StructType(
    [
        MASTER[name]
        for name in (
            "borrower_id age credit_score_at_origination annual_income employment_status"
            " total_loan_amount loan_count total_monthly_payment debt_to_income_ratio"
            " gender state housing_status gpa graduation_year degree_type major school_name"
            " school_type completion_status avg_days_late max_days_late std_days_late"
            " total_payments_made total_payment_count total_scheduled missed_payment_count"
            " payment_ratio missed_payment_rate recent_avg_days_late recent_missed_payments"
            " total_current_balance risk_score is_delinquent avg_loan_amount"
            " avg_interest_rate dependents"
        ).split()
    ]
)
TABLES: dict[str, T.StructType] = {
    "student_loan_borrowers": BORROWERS,
    "student_loan_education": EDUCATION,
    "student_loan_loans": LOANS,
    "student_loan_payments": PAYMENTS,
    "student_loan_delinquency_features": DELINQUENCY_FEATURES,
    "student_loan_master_dataset": MASTER,
    "realistic_student_loan_dataset": REALISTIC,
}

# Feature groups of the model input.
NUMERIC_FEATURES = (
    "age credit_score_at_origination annual_income dependents gpa graduation_year"
    " total_loan_amount loan_count avg_loan_amount avg_interest_rate total_current_balance"
    " total_monthly_payment debt_to_income_ratio avg_days_late max_days_late std_days_late"
    " total_payments_made total_payment_count total_scheduled missed_payment_count"
    " payment_ratio missed_payment_rate recent_avg_days_late recent_missed_payments"
    " risk_score"
).split()
CATEGORICAL_FEATURES = (
    "gender state employment_status housing_status school_name degree_type major"
    " school_type completion_status"
).split()
BAND_FEATURES = ["age_group", "income_category", "credit_category"]
FLAG_FEATURES = (
    "high_debt_burden multiple_loans large_loan_amount frequent_late_payments"
    " recent_payment_issues high_gpa graduate_degree completed_education high_risk_state"
    " stable_employment years_since_graduation recent_graduate"
).split()
# graduate_degree is the one engineered flag that is not standardised.
SCALED_FEATURES = NUMERIC_FEATURES + [f for f in FLAG_FEATURES if f != "graduate_degree"]
TARGET = "is_delinquent"

# Outreach work-list columns in order.
OUTREACH_COLUMNS = (
    "borrower_id first_name last_name ssn_last_4 phone_number email address city state"
    " zip_code loan_id current_balance days_delinquent risk_score risk_category"
    " delinquency_probability recommended_action priority_level contact_preference"
    " best_contact_time last_payment_date next_due_date total_owed processing_date"
    " account_status"
).split()

# Request contract.
CORE_FIELDS = (
    "age credit_score_at_origination annual_income total_loan_amount loan_count"
    " total_monthly_payment"
).split()
REQUEST = T.StructType(
    [
        f
        for f in MASTER
        if f.name == "borrower_id" or f.name in NUMERIC_FEATURES + CATEGORICAL_FEATURES
    ]
)
# field -> (minimum, maximum); None leaves a side open.
FIELD_RANGES: dict[str, tuple[float | None, float | None]] = {
    "age": (18, 80),
    "credit_score_at_origination": (300, 850),
    "annual_income": (0, None),
    "dependents": (0, None),
    "graduation_year": (1990, 2030),
    "gpa": (0.0, 4.0),
    "total_loan_amount": (0, None),
    "loan_count": (1, None),
    "avg_interest_rate": (0, None),
    "total_current_balance": (0, None),
    "total_monthly_payment": (0, None),
    "avg_days_late": (0, None),
    "max_days_late": (0, None),
    "missed_payment_count": (0, None),
    "recent_missed_payments": (0, None),
}
FIELD_VALUES: dict[str, list[str]] = {
    "gender": ["M", "F", "O"],
    "employment_status": ["Employed Full-time", "Employed Part-time", "Unemployed", "Student"],
    "housing_status": ["Own", "Rent", "Family"],
    "degree_type": ["Associates", "Bachelors", "Masters", "Doctorate", "Certificate"],
    "school_type": ["Public", "Private"],
    "completion_status": ["Completed", "Dropped Out", "Transferred"],
}
