"""Sources and sinks: panel readers, prediction writer, output validation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skein.spec import PanelSpec, clean_numeric, panel_schema

PREDICTION_SCHEMA = T.StructType([
    T.StructField("id", T.LongType(), True),
    T.StructField("target", T.DoubleType(), True),
])


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_panel(spark: SparkSession, path: str, spec: PanelSpec = PanelSpec(),
               fmt: str = "csv", with_target: bool = True) -> DataFrame:
    """Read a panel with an explicit schema (no inference); NaN becomes NULL.

    Nothing is sorted here: every ordered operator states its own order.
    """
    schema = panel_schema(spec, with_target)
    if fmt == "csv":
        df = (spark.read.schema(schema).option("header", True)
              .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").csv(path))
    elif fmt == "parquet":
        df = spark.read.schema(schema).parquet(path)
    else:
        raise ValueError(f"Unknown format: {fmt}")
    numeric = list(spec.features) + ([spec.target] if with_target else [])
    return clean_numeric(df, numeric)


def read_panel_checked(spark: SparkSession, path: str, spec: PanelSpec = PanelSpec(), with_target: bool = True,
                       rejects: str = "rejects") -> DataFrame:
    """S1/S2 for CSV files that may hold malformed rows: the panel plus ``rejects``, an array with the name of each field
    that could not be read ('_row' for a line with too few or too many fields). No row is dropped and no job fails.

    All fields are read as text and cast with ``try_cast``, so that a bad field turns NULL by itself. An id is the row's
    key: an absent one is a reject too. Empty fields are NULL, which is not malformed; so is NaN, the missing marker.
    """
    schema = panel_schema(spec, with_target)
    bad = "_bad_line"
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields] + [T.StructField(bad, T.StringType())])
    # a bad line is told from all fields of the file, not from those that a later step happens to need
    raw = (spark.read.schema(text).option("header", True).option("enforceSchema", False).option("mode", "PERMISSIVE")
           .option("columnPruning", False).option("columnNameOfCorruptRecord", bad).csv(path))
    fields, found = [], [F.when(F.col(bad).isNotNull(), F.lit("_row"))]
    for f in schema.fields:
        value = F.trim(F.col(f.name))
        read = F.col(f.name) if isinstance(f.dataType, T.StringType) else value.try_cast(f.dataType)
        if isinstance(f.dataType, T.DoubleType):
            read = F.when(~F.isnan(read), read)
        fields.append(read.alias(f.name))
        unread = (value != "") & (F.lower(value) != "nan") & value.try_cast(f.dataType).isNull()
        found.append(F.when(unread | (F.col(f.name).isNull() if f.name == spec.id else F.lit(False)), F.lit(f.name)))
    return raw.select(*fields, F.array_compact(F.array(*found)).alias(rejects))


def accepted_rows(checked: DataFrame, rejects: str = "rejects") -> DataFrame:
    """The rows of a checked panel that were read whole, with the panel's columns."""
    return checked.where(F.size(rejects) == 0).drop(rejects)


def reject_report(checked: DataFrame, rejects: str = "rejects") -> DataFrame:
    """``field, n_rows, min_id, max_id``: how many rows of a checked panel had each field malformed."""
    return checked.select("id", F.explode(rejects).alias("field")).groupBy("field").agg(
        F.count("*").alias("n_rows"), F.min("id").alias("min_id"), F.max("id").alias("max_id"))


def write_panel(df: DataFrame, path: str, spec: PanelSpec = PanelSpec(), with_target: bool = True) -> None:
    """A panel as CSV part files with a header, in the columns and formats that ``read_panel`` takes."""
    (df.select(*[f.name for f in panel_schema(spec, with_target).fields]).write.mode("overwrite").option("header", True)
     .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").csv(path))


def load_train_test(spark: SparkSession, train_path: str, test_path: str,
                    spec: PanelSpec = PanelSpec(), fmt: str = "csv"):
    """S1 for both files: the test panel has no target column."""
    return (read_panel(spark, train_path, spec, fmt, True),
            read_panel(spark, test_path, spec, fmt, False))


def parse_times(df: DataFrame, cols, fmt: str | None = None) -> DataFrame:
    """Text timestamps to timestamp_ntz; unparsable text becomes NULL."""
    wanted = set(cols)
    out = []
    for c in df.columns:
        if c in wanted:
            txt = F.col(c).cast("string")
            parsed = (F.try_to_timestamp(txt, F.lit(fmt)) if fmt else F.try_to_timestamp(txt))
            out.append(parsed.cast(T.TimestampNTZType()).alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


def read_panel_text_dates(spark: SparkSession, path: str, spec: PanelSpec = PanelSpec(),
                          with_target: bool = True) -> DataFrame:
    """Read a CSV panel keeping dates as text, then parse them."""
    schema = panel_schema(spec, with_target)
    text_schema = T.StructType([
        T.StructField(f.name, T.StringType(), True) if f.name in (spec.time, spec.end) else f
        for f in schema.fields
    ])
    df = spark.read.schema(text_schema).option("header", True).csv(path)
    numeric = list(spec.features) + ([spec.target] if with_target else [])
    return parse_times(clean_numeric(df, numeric), [spec.time, spec.end])


def read_predictions(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """S3: read an (id, target) prediction set."""
    if fmt == "csv":
        return spark.read.schema(PREDICTION_SCHEMA).option("header", True).csv(path)
    return spark.read.schema(PREDICTION_SCHEMA).parquet(path)


def write_predictions(df: DataFrame, path: str, id_col: str = "id", value_col: str = "target",
                      fmt: str = "csv") -> None:
    """Write (id, target) with a header as a directory of part files (no coalesce(1))."""
    out = df.select(F.col(id_col).cast("long").alias("id"),
                    F.col(value_col).cast("double").alias("target"))
    writer = out.write.mode("overwrite")
    if fmt == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.parquet(path)


def prediction_report(df: DataFrame, id_col: str = "id", value_col: str = "target") -> DataFrame:
    """One-row quality report of a prediction set, computed in one aggregate."""
    v = F.col(value_col)
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct(F.col(id_col)).alias("n_distinct_ids"),
        F.min(id_col).alias("min_id"),
        F.max(id_col).alias("max_id"),
        F.sum(F.when(v.isNull(), 1).otherwise(0)).cast("long").alias("n_null"),
        F.sum(F.when(v.isNotNull() & (F.isnan(v) | (F.abs(v) == float("inf"))), 1)
              .otherwise(0)).cast("long").alias("n_not_finite"),
    )


def validate_predictions(df: DataFrame, id_col: str = "id", value_col: str = "target",
                         expected_rows: int | None = None, min_id: int | None = None,
                         max_id: int | None = None) -> dict:
    """Raise when the prediction set breaks the submission rules; return the report."""
    if list(df.columns) != [id_col, value_col]:
        raise AssertionError(f"Wrong columns: {df.columns}")
    rep = prediction_report(df, id_col, value_col).first().asDict()
    problems = []
    if expected_rows is not None and rep["n_rows"] != expected_rows:
        problems.append(f"row count {rep['n_rows']} != {expected_rows}")
    if min_id is not None and rep["min_id"] != min_id:
        problems.append(f"min id {rep['min_id']} != {min_id}")
    if max_id is not None and rep["max_id"] != max_id:
        problems.append(f"max id {rep['max_id']} != {max_id}")
    if rep["n_null"]:
        problems.append(f"{rep['n_null']} null predictions")
    if rep["n_not_finite"]:
        problems.append(f"{rep['n_not_finite']} non-finite predictions")
    if problems:
        raise AssertionError("; ".join(problems))
    return rep


def shape_report(df: DataFrame) -> DataFrame:
    """(rows, columns) of a frame as a one-row table."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        "n_rows", F.lit(len(df.columns)).cast("long").alias("n_columns"))
