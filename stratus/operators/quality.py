"""Data-quality checks: one aggregate pass per table, one output row per rule.

Each rule is a violation predicate; all of a table's rules are counted in a
single ``agg`` (partial + final), then turned into rows with ``inline`` over
an array of structs.  No rule scans the table on its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Table constraints of the observation table.
NOT_NULL_COLUMNS = ["city", "country", "temperature", "feels_like", "humidity", "pressure",
                    "wind_speed", "weather_condition", "weather_description", "recorded_at"]
CHECKS = {
    "humidity": "humidity >= 0 AND humidity <= 100",
    "pressure": "pressure >= 800 AND pressure <= 1100",
    "wind_speed": "wind_speed >= 0",
    "cloudiness": "cloudiness >= 0 AND cloudiness <= 100",
}
# Declared model tests.
STAGING_NOT_NULL = ["city", "temperature_c", "humidity_pct", "temperature_category",
                    "wind_category", "recorded_at"]
MART_NOT_NULL = ["city", "country", "recorded_date", "avg_temperature_c", "record_count"]
ACCEPTED_VALUES = {
    "temperature_category": ["freezing", "cold", "mild", "warm", "hot"],
    "wind_category": ["calm", "light_breeze", "moderate", "strong"],
}


def count_rules(df: DataFrame, rules: list[tuple[str, str, Column]], scope: str) -> DataFrame:
    """``rules`` = (check, column, violation predicate) -> rows (scope, check, column, violations)."""
    sums = [F.sum(F.when(pred, 1).otherwise(0)).alias(f"_v{i}") for i, (_, _, pred) in enumerate(rules)]
    agg = df.agg(*sums)
    rows = F.array(*[F.struct(F.lit(scope).alias("scope"), F.lit(chk).alias("check_name"),
                              F.lit(col).alias("column_name"),
                              F.coalesce(F.col(f"_v{i}"), F.lit(0)).cast("long").alias("violations"))
                     for i, (chk, col, _) in enumerate(rules)])
    return agg.select(F.inline(rows))


def constraint_rules() -> list[tuple[str, str, Column]]:
    rules = [("not_null", c, F.col(c).isNull()) for c in NOT_NULL_COLUMNS]
    # A CHECK passes when it is true or unknown (null input), as in SQL DDL.
    rules += [("check", c, ~F.coalesce(F.expr(cond), F.lit(True))) for c, cond in CHECKS.items()]
    return rules


def constraints(df: DataFrame) -> DataFrame:
    return count_rules(df, constraint_rules(), "observations")


def not_null(df: DataFrame, columns: list[str], scope: str) -> DataFrame:
    return count_rules(df, [("not_null", c, F.col(c).isNull()) for c in columns], scope)


def accepted_values(df: DataFrame, spec: dict[str, list[str]], scope: str) -> DataFrame:
    """Values outside the accepted set; nulls are not reported."""
    return count_rules(df, [("accepted_values", c, F.col(c).isNotNull() & ~F.col(c).isin(v))
                            for c, v in spec.items()], scope)


def duplicates(df: DataFrame, key: str) -> DataFrame:
    """Keys occurring more than once (uniqueness test), with their counts."""
    return (df.groupBy(key).agg(F.count(F.lit(1)).alias("occurrences"))
              .filter(F.col("occurrences") > 1))
