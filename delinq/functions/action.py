"""Outreach decisions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Action names with their priority (1 = most urgent).
ACTION_PRIORITY = {
    "Immediate Collection Action": 1,
    "Urgent Payment Arrangement": 2,
    "Proactive Outreach - High Priority": 2,
    "Proactive Outreach - Medium Priority": 3,
    "Educational Communication": 4,
    "Standard Monitoring": 5,
}


def recommended_action(days_delinquent: Column, category: Column) -> Column:
    """Days past due decide first, then the risk category."""
    return (
        F.when(days_delinquent > 90, "Immediate Collection Action")
        .when(days_delinquent > 30, "Urgent Payment Arrangement")
        .when(category == "Critical", "Proactive Outreach - High Priority")
        .when(category == "High", "Proactive Outreach - Medium Priority")
        .when(category == "Medium", "Educational Communication")
        .otherwise("Standard Monitoring")
    )


def priority_level(action: Column) -> Column:
    pairs = [F.lit(x) for item in ACTION_PRIORITY.items() for x in item]
    return F.element_at(F.create_map(*pairs), action)


def total_owed(balance: Column, days_delinquent: Column) -> Column:
    """Balance plus a 10 % fee when past due."""
    return balance * F.when(days_delinquent > 0, F.lit(1.1)).otherwise(F.lit(1.0))
