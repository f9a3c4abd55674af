"""CSV and other delimited text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

QUARANTINE = "bad_line"


def _string_schema(fields: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in fields])


def read_csv_raw(
    spark: SparkSession,
    path: str,
    header_fields: Sequence[str],
    sep: str = ",",
    multiline: bool = False,
) -> DataFrame:
    """All columns as strings; a missing field is NULL.

    ``multiline`` allows line breaks inside quotes, at the price that Spark can no longer split
    one file between tasks. Leave it off for big files with one record per line.
    """
    return (
        spark.read.schema(_string_schema(header_fields))
        .option("header", True)
        .option("sep", sep)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", multiline)
        .option("enforceSchema", False)
        .csv(path)
    )


def read_csv_fields(
    spark: SparkSession, path: str, header_fields: Sequence[str], wanted: Sequence[str]
) -> DataFrame:
    """Only the wanted columns; the CSV reader skips parsing the others."""
    return read_csv_raw(spark, path, header_fields).select(*wanted)


def read_csv_typed(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | str,
    sep: str = ",",
    date_format: str = "yyyy-MM-dd",
) -> DataFrame:
    """Declared types, a free separator, and one path or several with the same columns.

    A header in another order, a value that does not fit its type, and a line with another number
    of fields are errors; :func:`read_csv_checked` sets such lines aside instead.
    """
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("sep", sep)
        .option("quote", '"')
        .option("escape", '"')
        .option("dateFormat", date_format)
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        .csv(path)
    )


def read_csv_checked(
    spark: SparkSession, path: str | list[str], schema: T.StructType, sep: str = ","
) -> tuple[DataFrame, DataFrame]:
    """Typed rows, and the lines with a wrong number of fields or a value of another type.

    A header in another order is an error. Dates and timestamps are in their usual form.
    """
    raw = _string_schema([f.name for f in schema]).add(QUARANTINE, T.StringType())
    lines = (
        spark.read.schema(raw)
        .option("header", True)
        .option("sep", sep)
        .option("quote", '"')
        .option("escape", '"')
        .option("enforceSchema", False)
        .option("columnNameOfCorruptRecord", QUARANTINE)
        .csv(path)
    )
    typed, bad = [], F.col(QUARANTINE).isNotNull()
    for field in schema:
        value = F.col(field.name).try_cast(field.dataType)
        typed.append(value.alias(field.name))
        bad = bad | (F.col(field.name).isNotNull() & value.isNull())
    line = F.coalesce(QUARANTINE, _joined(lines, [f.name for f in schema], sep))
    return lines.where(~bad).select(*typed), lines.where(bad).select(line.alias(QUARANTINE))


def write_csv(df: DataFrame, path: str, sep: str = ",") -> None:
    df.write.option("header", True).option("sep", sep).option("escape", '"').csv(path)


def parse_lines(lines: DataFrame, sep: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """Split a one-column text DataFrame into typed fields.

    Returns the good rows and the lines with a wrong number of fields or a value that does not
    fit its declared type; nothing is dropped unseen.
    """
    text = F.col(lines.columns[0])
    parts = F.split(text, f"\\Q{sep}\\E", -1)
    raw = [F.get(parts, F.lit(i)) for i in range(len(schema))]
    typed = [
        part.try_cast(field.dataType).alias(field.name) for part, field in zip(raw, schema)
    ]
    good = F.size(parts) == len(schema)
    for part, field in zip(raw, schema):
        if not isinstance(field.dataType, T.StringType):
            good = good & (part.try_cast(field.dataType).isNotNull() | (part == ""))
    good = F.coalesce(good, F.lit(False))
    return lines.where(good).select(*typed), lines.where(~good).select(text.alias(QUARANTINE))


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def _joined(df: DataFrame, columns: Sequence[str], sep: str) -> Column:
    return F.concat_ws(sep, *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])


def write_delimited(
    df: DataFrame, path: str, columns: Sequence[str], sep: str = "|"
) -> None:
    """One line per row, fields in the given order, without header or quotes."""
    df.select(_joined(df, columns, sep).alias("value")).write.text(path)


def write_lines(df: DataFrame, column: str, path: str) -> None:
    """One value per line."""
    df.select(F.col(column).cast("string").alias("value")).where("value IS NOT NULL").write.text(
        path
    )
