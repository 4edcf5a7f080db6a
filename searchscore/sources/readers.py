"""CSV and Parquet readers and the Parquet writer.

Input schemas are declared, never inferred. Keys are read as bigint and the
relevance score as string (cast later by ``operators.merge.relevance_to_double``),
as in the source CSV files.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TRAIN_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("product_uid", T.LongType()),
    T.StructField("product_title", T.StringType()),
    T.StructField("search_term", T.StringType()),
    T.StructField("relevance", T.StringType()),
])

DESCRIPTIONS_SCHEMA = T.StructType([
    T.StructField("product_uid", T.LongType()),
    T.StructField("product_description", T.StringType()),
])

ATTRIBUTES_SCHEMA = T.StructType([
    T.StructField("product_uid", T.LongType()),
    T.StructField("name", T.StringType()),
    T.StructField("value", T.StringType()),
])

SCHEMAS = {
    "train": TRAIN_SCHEMA,
    "product_descriptions": DESCRIPTIONS_SCHEMA,
    "attributes": ATTRIBUTES_SCHEMA,
}


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
             all_strings: bool = False, null_value: str | None = None, multi_line: bool = False) -> DataFrame:
    """CSV with a header row.

    ``schema`` fixes the column types (no inference pass over the data).
    ``all_strings=True`` reads every column as string, the raw form.
    Quotes inside fields are doubled (RFC 4180). ``multi_line=True`` lets quoted
    fields span lines; each file is then one task, so it is off by default and a
    large file is split. By default Spark reads an empty field
    as NULL; ``null_value`` (e.g. ``\\N``) names an explicit NULL marker so
    empty strings stay empty.
    """
    reader = spark.read.option("header", True).option("multiLine", multi_line).option("escape", '"')
    if null_value is not None:
        reader = reader.option("nullValue", null_value)
    if schema is not None and not all_strings:
        reader = reader.schema(schema)
    return reader.csv(path)


def read_csv_with_rejects(spark: SparkSession, path: str, schema: T.StructType, null_value: str | None = None) -> DataFrame:
    """S1 with a reject channel: the declared columns, ``_reject``, ``_parsed`` and ``_file``.

    A line that does not fit the schema (a value of another type, too few or too many
    fields) stays a row: its text is in ``_reject``, null for good lines; ``_parsed`` is the
    number of fields that have a value. ``good_rows``, ``rejected_lines`` and
    ``reject_report`` split and count them. All of these read every declared column,
    whatever is asked for later: a line is told by all its fields."""
    whole = T.StructType([*schema.fields, T.StructField("_reject", T.StringType())])
    reader = (spark.read.option("header", True).option("escape", '"').option("mode", "PERMISSIVE").option("enforceSchema", True)
              .option("columnNameOfCorruptRecord", "_reject").schema(whole))
    if null_value is not None:
        reader = reader.option("nullValue", null_value)
    values = F.array(*[F.col(f"`{f.name}`").cast("string") for f in schema.fields])
    return reader.csv(path).withColumns({"_file": F.col("_metadata.file_name"), "_parsed": F.size(F.filter(values, lambda v: v.isNotNull()))})


def good_rows(rows: DataFrame) -> DataFrame:
    """The lines that fit the schema, without the reject channel."""
    return rows.where(F.col("_reject").isNull() & (F.col("_parsed") >= 0)).drop("_reject", "_parsed", "_file")


def rejected_lines(rows: DataFrame) -> DataFrame:
    """(file, line, n_parsed) of each line that does not fit."""
    return rows.where(F.col("_reject").isNotNull() & (F.col("_parsed") >= 0)).select(F.col("_file").alias("file"), F.col("_reject").alias("line"), F.col("_parsed").alias("n_parsed"))


def reject_report(rows: DataFrame) -> DataFrame:
    """(file, n_lines, n_rejected), one row a file."""
    return rows.where("_parsed >= 0").groupBy(F.col("_file").alias("file")).agg(F.count("*").alias("n_lines"), F.count("_reject").alias("n_rejected"))


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists",
              null_value: str | None = "\\N") -> None:
    """CSV sink matching ``read_csv``: header, doubled quotes, NULL marker."""
    writer = df.write.mode(mode).option("header", True).option("escape", '"')
    if null_value is not None:
        writer = writer.option("nullValue", null_value)
    writer.csv(path)


def read_sources(spark: SparkSession, train_path: str, descriptions_path: str,
                 attributes_path: str, fmt: str = "csv",
                 null_value: str | None = None, multi_line: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Read the three inputs with their declared schemas (CSV or Parquet)."""
    if fmt == "csv":
        return (read_csv(spark, train_path, TRAIN_SCHEMA, null_value=null_value, multi_line=multi_line),
                read_csv(spark, descriptions_path, DESCRIPTIONS_SCHEMA, null_value=null_value, multi_line=multi_line),
                read_csv(spark, attributes_path, ATTRIBUTES_SCHEMA, null_value=null_value, multi_line=multi_line))
    return (read_parquet(spark, train_path), read_parquet(spark, descriptions_path),
            read_parquet(spark, attributes_path))


def write_parquet(df: DataFrame, path: str, mode: str = "errorifexists",
                  partition_by: list[str] | None = None) -> None:
    """S3: Parquet sink. The default mode fails when the target exists."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Parquet scan (filters and projections reach the scan)."""
    return spark.read.parquet(path)
