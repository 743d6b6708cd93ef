"""Imputation, one-hot encoding and scaling as one immutable fitted object."""

from __future__ import annotations

import datetime as dt
import json
from dataclasses import asdict, dataclass

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from delinq import schemas
from delinq.functions.borrower import clipped_columns, engineered_columns
from delinq.functions.numeric import nan_to_null
from delinq.operators.ranking import exact_medians
from delinq.session import materialise

ENCODED_FEATURES = schemas.CATEGORICAL_FEATURES + schemas.BAND_FEATURES
NULL_CATEGORY = "nan"


def category_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows (column, category, rows) with a NULL category where there are nulls.

    The columns are unfolded and pre-aggregated in the scan stage; what is shuffled is one row
    per distinct category and partition.
    """
    cells = [F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("category")) for c in columns]
    return (
        df.select(F.inline(F.array(*cells))).groupBy("column", "category").agg(F.count(F.lit(1)).alias("rows"))
    )


def most_frequent(counts: DataFrame) -> DataFrame:
    """Rows (column, mode): most rows first, then the smallest category; nulls do not count."""
    best = F.min(F.struct(-F.col("rows"), F.col("category"))).alias("best")
    return (
        counts.filter(F.col("category").isNotNull())
        .groupBy("column")
        .agg(best)
        .select("column", F.col("best.category").alias("mode"))
    )


def category_positions(counts: DataFrame) -> DataFrame:
    """Rows (column, position, category): sorted categories, a NULL category last."""
    order = Window.partitionBy("column").orderBy(F.col("category").asc_nulls_last())
    return counts.select("column", (F.row_number().over(order) - 1).alias("position"), "category")


def scaling_stats(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows (column, mean, std) with the population deviation, from one aggregation."""
    wide = df.agg(*[F.struct(F.avg(c).alias("mean"), F.stddev_pop(c).alias("std")).alias(c) for c in columns])
    cells = [
        F.struct(F.lit(c).alias("column"), F.col(c)["mean"].alias("mean"), F.col(c)["std"].alias("std"))
        for c in columns
    ]
    return wide.select(F.inline(F.array(*cells)))


@dataclass(frozen=True)
class FeatureModel:
    """Fitted state of the preprocessing; small scalars only."""

    as_of: dt.date
    medians: dict[str, float | None]
    modes: dict[str, str | None]
    categories: dict[str, list[str | None]]
    means: dict[str, float]
    stds: dict[str, float]

    @property
    def encoded_names(self) -> list[str]:
        """One name per category but the first."""
        return [
            f"{column}_{NULL_CATEGORY if category is None else category}"
            for column in ENCODED_FEATURES
            for category in self.categories[column][1:]
        ]

    @property
    def feature_names(self) -> list[str]:
        return schemas.NUMERIC_FEATURES + schemas.FLAG_FEATURES + self.encoded_names

    def engineer(self, df: DataFrame) -> DataFrame:
        """Engineered columns; flags see the values before imputation."""
        return add_engineered(df, self.as_of)

    def impute(self, df: DataFrame) -> DataFrame:
        return impute(df, self.medians, self.modes)

    def _encoded_columns(self) -> dict[str, Column]:
        out: dict[str, Column] = {}
        for column in ENCODED_FEATURES:
            for category in self.categories[column][1:]:
                value = F.col(column)
                hit = value.isNull() if category is None else value == category
                name = f"{column}_{NULL_CATEGORY if category is None else category}"
                out[name] = F.when(hit, F.lit(1.0)).otherwise(F.lit(0.0))
        return out

    def _scaled_columns(self) -> dict[str, Column]:
        out: dict[str, Column] = {}
        for name in schemas.SCALED_FEATURES:
            mean, std = self.means.get(name), self.stds.get(name)
            x = F.col(name).cast("double")
            scaled = x if mean is None else (x - F.lit(mean)) / F.lit(std or 1.0)
            out[name] = F.coalesce(scaled, F.lit(0.0))
        return out

    def transform(self, df: DataFrame, keep: list[str] | None = None) -> DataFrame:
        """Kept columns and one double column per feature, in the fitted order.

        A feature column the input does not have counts as 0 after scaling; an unknown
        category gives all zeros. All steps are projections: the plan is one scan.
        """
        keep = [c for c in (keep or ["borrower_id", schemas.TARGET]) if c in df.columns]
        absent = [c for c in schemas.NUMERIC_FEATURES + schemas.CATEGORICAL_FEATURES if c not in df.columns]
        types = {f.name: f.dataType for f in schemas.MASTER}
        # Typed nulls let the same expressions run; flags then see "unknown".
        complete = df.withColumns({c: F.lit(None).cast(types[c]) for c in absent})
        ready = self.impute(self.engineer(nan_to_null(complete)))
        features: dict[str, Column] = {
            **self._scaled_columns(),
            "graduate_degree": F.col("graduate_degree").cast("double"),
            **self._encoded_columns(),
        }
        for name in absent:
            if name in features:
                features[name] = F.lit(0.0)
        return ready.select(*keep, *[features[n].alias(n) for n in self.feature_names])

    def assemble(self, df: DataFrame, keep: list[str] | None = None) -> DataFrame:
        """Kept columns and the ``features`` vector."""
        wide = self.transform(df, keep)
        kept = [c for c in wide.columns if c not in self.feature_names]
        assembler = VectorAssembler(inputCols=self.feature_names, outputCol="features")
        return assembler.transform(wide).select(*kept, "features")

    def to_json(self) -> str:
        return json.dumps({**asdict(self), "as_of": self.as_of.isoformat()})

    @staticmethod
    def from_json(text: str) -> FeatureModel:
        state = json.loads(text)
        return FeatureModel(**{**state, "as_of": dt.date.fromisoformat(state["as_of"])})

    def save(self, spark: SparkSession, path: str) -> None:
        spark.range(1).select(F.lit(self.to_json()).alias("value")).write.mode("overwrite").text(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> FeatureModel:
        return FeatureModel.from_json(spark.read.text(path, wholetext=True).first()["value"].strip())


def add_engineered(df: DataFrame, as_of: dt.date) -> DataFrame:
    return df.withColumns(engineered_columns(as_of))


def impute(df: DataFrame, medians: dict[str, float | None], modes: dict[str, str | None]) -> DataFrame:
    """Fill nulls with medians and modes, then bound extreme values."""
    fills = {c: F.coalesce(F.col(c).cast("double"), F.lit(m)) for c, m in medians.items() if m is not None}
    fills |= {c: F.coalesce(F.col(c), F.lit(m)) for c, m in modes.items() if m is not None}
    return df.withColumns(fills).withColumns(clipped_columns())


def fit_features(df: DataFrame, as_of: dt.date, max_categories: int = 1000) -> FeatureModel:
    """Fit medians, modes, categories and scaling on the rows of ``df``.

    The engineered rows are written once; two passes over them give the medians, one the
    categories, one the scaling. Each category becomes a feature column, so a column with more than
    ``max_categories`` is an error, not a truncation.
    """
    base = materialise(add_engineered(nan_to_null(df), as_of), "engineered")
    medians = exact_medians(base, schemas.NUMERIC_FEATURES)
    counts = materialise(category_counts(base, ENCODED_FEATURES), "categories")  # a row a category, read twice
    modes: dict[str, str | None] = {c: None for c in schemas.CATEGORICAL_FEATURES}
    for row in most_frequent(counts.filter(F.col("column").isin(schemas.CATEGORICAL_FEATURES))).collect():
        modes[row["column"]] = row["mode"]
    # Imputation turns nulls of a categorical feature into its mode; bands keep theirs.
    imputed = schemas.CATEGORICAL_FEATURES
    seen = counts.filter(F.col("category").isNotNull() | ~F.col("column").isin(imputed))
    categories: dict[str, list[str | None]] = {c: [] for c in ENCODED_FEATURES}
    within = category_positions(seen).filter(F.col("position") <= max_categories)
    for row in within.orderBy("column", "position").collect():
        categories[row["column"]].append(row["category"])
    crowded = [c for c, values in categories.items() if len(values) > max_categories]
    if crowded:
        raise ValueError(f"more than {max_categories} categories in {crowded}")
    stats = scaling_stats(impute(base, medians, modes), schemas.SCALED_FEATURES).collect()
    return FeatureModel(
        as_of=as_of,
        medians=medians,
        modes=modes,
        categories=categories,
        means={r["column"]: r["mean"] for r in stats},
        stds={r["column"]: r["std"] for r in stats},
    )
