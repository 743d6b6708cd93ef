"""CSV and JSON files in and out."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from delinq.functions.numeric import nan_to_null


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with header and a declared schema (no inference pass over the data).

    Columns are matched by the header, so the schema may list them in another order or only
    some of them.
    """
    header = spark.read.option("header", True).csv(path).columns
    positional = T.StructType(
        [schema[name] if name in schema.names else T.StructField(name, T.StringType()) for name in header]
    )
    df = spark.read.schema(positional).option("header", True).csv(path)
    return nan_to_null(df.select(*[name for name in schema.names if name in header]))


def read_json(spark: SparkSession, path: str, schema: T.StructType, array: bool = True) -> DataFrame:
    """JSON records; ``array`` reads files that hold one array, otherwise one record per line.

    A file with one array cannot be split over tasks; large inputs should be record lines.
    """
    return nan_to_null(spark.read.schema(schema).option("multiLine", array).json(path))


def read_records(spark: SparkSession, path: str, schema: T.StructType, array: bool = True) -> DataFrame:
    """Choose the reader by the file suffix."""
    suffix = path.rsplit(".", 1)[-1].lower()
    if suffix == "csv":
        return read_csv(spark, path, schema)
    if suffix == "json":
        return read_json(spark, path, schema, array)
    raise ValueError("Unsupported file format. Use CSV or JSON.")


_LINE = "_line"
REJECTS = "record string, column string, value string, reason string"


def _raw_records(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The fields of the schema as text, and the whole record in ``_line`` where it can't be read."""
    suffix = path.rsplit(".", 1)[-1].lower()
    text = T.StringType()
    if suffix == "csv":
        header = spark.read.option("header", True).csv(path).columns
        fields = T.StructType([T.StructField(n, text) for n in header] + [T.StructField(_LINE, text)])
        options = {"header": True, "columnNameOfCorruptRecord": _LINE, "columnPruning": False}  # all fields show a bad record
        raw = spark.read.schema(fields).options(**options).csv(path)
        # Spark gives the bad record only along with another column.
        raw = raw.where(F.length(F.coalesce(F.col(f"`{header[0]}`"), F.lit(""))) >= 0)
        return raw.select(*[F.col(f"`{n}`") if n in header else F.lit(None).cast("string").alias(n) for n in schema.names], _LINE)
    if suffix == "json":
        lines = spark.read.text(path).select("value", F.from_json("value", "map<string,string>").alias("m"))
        fields = [F.try_element_at("m", F.lit(n)).alias(n) for n in schema.names]
        return lines.select(*fields, F.when(F.col("m").isNull(), F.col("value")).alias(_LINE))
    raise ValueError("Unsupported file format. Use CSV or JSON.")


def cast_or_reject(raw: DataFrame, schema: T.StructType, key: str) -> tuple[DataFrame, DataFrame]:
    """Typed rows of text columns, and a row of ``REJECTS`` for each value that its type can't hold.

    A rejected value is null in the typed row. A record that can't be read at all (``_line``, if the input has it) has no
    typed row and one reject without a column. Both are projections over the same scan; nothing is shuffled.
    """
    line = F.col(_LINE) if _LINE in raw.columns else F.lit(None).cast("string")
    typed = {f.name: F.col(f"`{f.name}`").try_cast(f.dataType) for f in schema}
    rows = raw.where(line.isNull()).select(*[c.alias(n) for n, c in typed.items()])
    cells = [
        F.when(
            F.col(f"`{f.name}`").isNotNull() & typed[f.name].isNull(),
            F.struct(
                F.lit(f.name).alias("column"),
                F.col(f"`{f.name}`").alias("value"),
                F.lit(f"not a {f.dataType.simpleString()}").alias("reason"),
            ),
        )
        for f in schema
    ]
    unread = F.struct(F.lit(None).cast("string").alias("column"), line.alias("value"), F.lit("unreadable record").alias("reason"))
    found = F.when(line.isNotNull(), F.array(unread)).otherwise(F.array_compact(F.array(*cells)))
    record = F.when(line.isNull(), F.col(f"`{key}`")).alias("record")
    return nan_to_null(rows), raw.select(record, F.inline(found))


def read_checked(spark: SparkSession, path: str, schema: T.StructType, key: str) -> tuple[DataFrame, DataFrame]:
    """CSV with a header or JSON lines by suffix, as typed rows and rejects (record: the text of ``key``)."""
    return cast_or_reject(_raw_records(spark, path, schema), schema, key)


def write_csv(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").option("header", True).csv(path)
    return path


def write_json(df: DataFrame, path: str) -> str:
    """One record per line, ISO timestamps."""
    df.write.mode("overwrite").option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSS").json(path)
    return path


def write_records(df: DataFrame, path: str) -> str:
    """Choose the writer by the path suffix."""
    suffix = path.rsplit(".", 1)[-1].lower()
    if suffix == "csv":
        return write_csv(df, path)
    if suffix == "json":
        return write_json(df, path)
    raise ValueError("Unsupported file format. Use CSV or JSON.")


def write_output_set(
    outreach: DataFrame, summary: DataFrame, short: DataFrame, root: str, as_of: dt.datetime
) -> dict[str, str]:
    """Write list, summary and headline figures under ``run_ts=<as_of>`` of each output, then commit them together.

    The run time is a partition directory, so readers can prune to one run. Every set has folders of its own. Its row in
    the manifest is written last, as one file that appears when it is whole: until then, and if a write fails, readers of
    ``committed_paths`` see the sets before it, and nothing of an earlier set is touched.
    """
    run = as_of.strftime("%Y%m%d_%H%M%S")
    own = uuid.uuid4().hex
    paths = {kind: f"{root}/{kind}/run_ts={run}/set={own}" for kind in ("csv", "json", "summary", "headline")}
    write_csv(outreach, paths["csv"])
    write_json(outreach, paths["json"])
    write_json(summary, paths["summary"])
    write_csv(short, paths["headline"])
    row = outreach.sparkSession.range(1).select(
        F.lit(run).alias("run_ts"),
        F.lit(own).alias("set"),
        F.current_timestamp().alias("committed_at"),
        F.create_map(*[F.lit(x) for pair in paths.items() for x in pair]).alias("paths"),
    )
    row.coalesce(1).write.parquet(f"{root}/_manifest/{run}-{own}")
    return paths


_MANIFEST = "run_ts string, set string, committed_at timestamp, paths map<string,string>"


def committed_sets(spark: SparkSession, root: str) -> DataFrame:
    """run_ts, set, committed_at, paths: the newest committed set of every run."""
    rows = spark.read.schema(_MANIFEST).parquet(f"{root}/_manifest/*")
    newest = F.max_by(F.struct("set", "committed_at", "paths"), F.struct("committed_at", "set")).alias("m")
    return rows.groupBy("run_ts").agg(newest).select("run_ts", "m.set", "m.committed_at", "m.paths")


def committed_paths(spark: SparkSession, root: str, run_ts: str | None = None) -> dict[str, str]:
    """Path of each output of a run, by default of the run committed last."""
    sets = committed_sets(spark, root)
    sets = sets if run_ts is None else sets.where(F.col("run_ts") == run_ts)
    row = sets.orderBy(F.desc("committed_at"), "set").first()
    if row is None:
        raise ValueError(f"no committed run in {root}")
    return row["paths"]


def with_iso_dates(df: DataFrame) -> DataFrame:
    """Timestamps as ISO text, for text sinks."""
    stamps = [f.name for f in df.schema if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType))]
    if not stamps:
        return df
    return df.withColumns({c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSS") for c in stamps})
