"""Domain tables derived from the supplied TPC-H-like tables by fixed arithmetic.

The SQL text is valid in Spark and in DuckDB, so both sides of a check read the same rows.
Placeholders name the input tables. Identifiers are padded with ``lpad``, which is compiled into the
scan stage; ``printf`` would format every row through an interpreter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

BORROWERS_SQL = """
select concat('BOR_', case when c_custkey < 1000000 then lpad(cast(c_custkey as string), 6, '0') else cast(c_custkey as string) end) as borrower_id,
  case when c_acctbal < 2000 then 'high' when c_acctbal < 6000 then 'medium' else 'low' end as _risk_segment,
  cast(18 + c_custkey % 48 as int) as age,
  cast(300 + (c_custkey * 7919) % 551 as int) as credit_score_at_origination,
  case when c_custkey % 97 = 13 then null else cast(20000 + (c_custkey * 104729) % 130001 as double) end as annual_income,
  case c_mktsegment when 'AUTOMOBILE' then 'Employed' when 'BUILDING' then 'Part-time' when 'FURNITURE' then 'Student'
    when 'HOUSEHOLD' then 'Unemployed' else 'Employed Full-time' end as employment_status,
  case when c_custkey % 20 = 0 then 'O' when c_custkey % 20 < 11 then 'F' else 'M' end as gender,
  case c_nationkey when 0 then 'CA' when 1 then 'TX' when 2 then 'FL' when 3 then 'NY' when 4 then 'PA' when 5 then 'IL'
    when 6 then 'OH' when 7 then 'GA' when 8 then 'NC' when 9 then 'MI' when 10 then 'NJ' when 11 then 'VA' when 12 then 'WA'
    when 13 then 'AZ' when 14 then 'MA' when 15 then 'TN' when 16 then 'IN' when 17 then 'MO' when 18 then 'MD'
    when 19 then 'WI' when 20 then 'NV' else 'OR' end as state,
  cast(c_custkey % 5 as int) as dependents,
  case when c_custkey % 89 = 7 then null when c_custkey % 10 < 4 then 'Own' when c_custkey % 10 < 9 then 'Rent'
    else 'Family' end as housing_status
from {customer}
"""

EDUCATION_SQL = """
select concat('BOR_', case when c_custkey < 1000000 then lpad(cast(c_custkey as string), 6, '0') else cast(c_custkey as string) end) as borrower_id,
  case c_custkey % 8 when 0 then 'State University' when 1 then 'Community College' when 2 then 'Private University'
    when 3 then 'Technical Institute' when 4 then 'Online University' when 5 then 'Liberal Arts College'
    when 6 then 'Research University' else 'Regional University' end as school_name,
  case (c_custkey * 3) % 5 when 0 then 'Associates' when 1 then 'Bachelors' when 2 then 'Masters' when 3 then 'Doctorate'
    else 'Certificate' end as degree_type,
  case (c_custkey * 7) % 10 when 0 then 'Business' when 1 then 'Engineering' when 2 then 'Education' when 3 then 'Healthcare'
    when 4 then 'Liberal Arts' when 5 then 'Computer Science' when 6 then 'Psychology' when 7 then 'Biology'
    when 8 then 'Art' else 'Communications' end as major,
  cast(2010 + (c_custkey * 11) % 14 as int) as graduation_year,
  case when c_custkey % 83 = 5 then null else cast(200 + (c_custkey * 37) % 201 as double) / 100 end as gpa,
  case when (c_custkey * 13) % 10 < 7 then 'Public' else 'Private' end as school_type,
  case when (c_custkey * 17) % 20 < 15 then 'Completed' when (c_custkey * 17) % 20 < 18 then 'Dropped Out'
    else 'Transferred' end as completion_status
from {customer}
"""

LOANS_SQL = """
select loan_id, borrower_id, loan_amount, origination_date, loan_term_months, interest_rate, loan_type,
  'Active' as loan_status,
  floor(loan_amount * b + 0.5) / 100 as current_balance,
  floor(100 * loan_amount * (interest_rate / 1200) / (1 - pow(1 + interest_rate / 1200, -loan_term_months)) + 0.5) / 100
    as monthly_payment
from (select concat('LOAN_', case when o_orderkey < 100000000 then lpad(cast(o_orderkey as string), 8, '0') else cast(o_orderkey as string) end) as loan_id, concat('BOR_', case when o_custkey < 1000000 then lpad(cast(o_custkey as string), 6, '0') else cast(o_custkey as string) end) as borrower_id,
    floor(o_totalprice * 10 + 0.5) / 100 as loan_amount, o_orderdate as origination_date,
    cast(case o_orderkey % 3 when 0 then 120 when 1 then 240 else 360 end as int) as loan_term_months,
    cast(200 + (o_orderkey * 37) % 1001 as double) / 100 as interest_rate,
    case when o_orderkey % 20 < 8 then 'Subsidized' when o_orderkey % 20 < 17 then 'Unsubsidized' else 'PLUS' end as loan_type,
    50 + o_orderkey % 51 as b
  from {orders}) x
"""

PAYMENTS_SQL = """
select payment_id, loan_id, borrower_id, payment_date, scheduled_amount,
  case when days_late > 60 then cast(0 as double) else scheduled_amount end as actual_amount,
  case when days_late = 0 then 'On Time' when days_late <= 30 then '1-30 Days Late' when days_late <= 60 then '31-60 Days Late'
    else 'Missed Payment' end as payment_status, days_late
from (select payment_id, loan_id, borrower_id, payment_date, scheduled_amount,
    cast(case when h < 920 then 0 when h < 968 then 1 + k % 30 when h < 984 then 31 + k % 30 else 61 + k % 59 end as int) as days_late
  from (select concat('PAY_', case when l_orderkey < 100000000 then lpad(cast(l_orderkey as string), 8, '0')
        else cast(l_orderkey as string) end, '_', cast(l_linenumber as string), '_', cast(l_partkey as string), '_', cast(l_suppkey as string)) as payment_id,
      concat('LOAN_', case when l_orderkey < 100000000 then lpad(cast(l_orderkey as string), 8, '0') else cast(l_orderkey as string) end) as loan_id, concat('BOR_', case when o_custkey < 1000000 then lpad(cast(o_custkey as string), 6, '0') else cast(o_custkey as string) end) as borrower_id,
      l_shipdate as payment_date, l_extendedprice as scheduled_amount,
      (l_orderkey * 31 + l_linenumber * 17 + l_partkey * 7 + l_suppkey * 3) % 1000 as h,
      l_orderkey * 13 + l_partkey * 5 as k
    from {lineitem} join {orders} on l_orderkey = o_orderkey) a) b
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def borrowers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(BORROWERS_SQL, customer=table(spark, sf_dir, "customer"))


def borrowers_from(customer: DataFrame) -> DataFrame:
    """The borrower view over any customer frame, a stream included."""
    return customer.sparkSession.sql(BORROWERS_SQL, customer=customer)


def education(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(EDUCATION_SQL, customer=table(spark, sf_dir, "customer"))


def loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(LOANS_SQL, orders=table(spark, sf_dir, "orders"))


#: The rows of ``PAYMENTS_SQL`` with the delay worked out before the join, so the columns behind it aren't shuffled.
_LINES_SQL = """
select l_orderkey, l_shipdate as payment_date, l_extendedprice as scheduled_amount,
  concat('PAY_', case when l_orderkey < 100000000 then lpad(cast(l_orderkey as string), 8, '0')
    else cast(l_orderkey as string) end, '_', cast(l_linenumber as string), '_', cast(l_partkey as string), '_', cast(l_suppkey as string)) as payment_id,
  cast(case when h < 920 then 0 when h < 968 then 1 + k % 30 when h < 984 then 31 + k % 30 else 61 + k % 59 end as int) as days_late
from (select *, (l_orderkey * 31 + l_linenumber * 17 + l_partkey * 7 + l_suppkey * 3) % 1000 as h, l_orderkey * 13 + l_partkey * 5 as k
  from {lineitem}) a
"""

_PAYMENTS_OF_LINES_SQL = """
select payment_id, concat('LOAN_', case when l_orderkey < 100000000 then lpad(cast(l_orderkey as string), 8, '0') else cast(l_orderkey as string) end) as loan_id,
  concat('BOR_', case when o_custkey < 1000000 then lpad(cast(o_custkey as string), 6, '0') else cast(o_custkey as string) end) as borrower_id,
  payment_date, scheduled_amount,
  case when days_late > 60 then cast(0 as double) else scheduled_amount end as actual_amount,
  case when days_late = 0 then 'On Time' when days_late <= 30 then '1-30 Days Late' when days_late <= 60 then '31-60 Days Late'
    else 'Missed Payment' end as payment_status, days_late
from {lines} join {orders} on l_orderkey = o_orderkey
"""


def payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = spark.sql(_LINES_SQL, lineitem=table(spark, sf_dir, "lineitem"))
    return spark.sql(_PAYMENTS_OF_LINES_SQL, lines=lines, orders=table(spark, sf_dir, "orders"))
