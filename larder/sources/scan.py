"""Typed scans: the declared schema is applied, never inferred."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .tables import TABLES, TableSpec


class MissingSource(FileNotFoundError):
    """A declared table has no file at the given place."""


class SchemaDrift(ValueError):
    """A source lacks declared columns or holds them with another type."""


def type_fits(declared: T.DataType, actual: T.DataType) -> bool:
    """Same family; any number but a boolean is acceptable as floating."""
    if isinstance(declared, T.IntegralType):
        return isinstance(actual, T.IntegralType)
    if isinstance(declared, T.FractionalType):
        return isinstance(actual, T.NumericType)
    if isinstance(declared, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return isinstance(actual, (T.DateType, T.TimestampType, T.TimestampNTZType))
    return type(declared) is type(actual)


def schema_drift(actual: T.StructType, spec: TableSpec) -> tuple[list[str], list[str], dict[str, str]]:
    """Missing columns, unexpected ones, and those of another type with that type."""
    found = {f.name: f.dataType for f in actual}
    declared = {f.name: f.dataType for f in spec.schema}
    missing = [c for c in declared if c not in found]
    unexpected = [c for c in found if c not in declared]
    mismatched = {
        c: found[c].simpleString() for c in declared if c in found and not type_fits(declared[c], found[c])
    }
    return missing, unexpected, mismatched


def stored_schema(spark: SparkSession, name: str, path: str) -> T.StructType:
    """The schema a Parquet source really has, from its footer."""
    return _load(lambda: spark.read.parquet(path), name, path).schema


def lower_case_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[name.lower() for name in df.columns])


def without_nan(df: DataFrame) -> DataFrame:
    """NULL is the only missing value past this point."""
    return df.selectExpr(
        *[
            f"nullif(`{f.name}`, double('NaN')) AS `{f.name}`"
            if isinstance(f.dataType, (T.DoubleType, T.FloatType))
            else f"`{f.name}`"
            for f in df.schema
        ]
    )


def scan_csv(spark: SparkSession, table: str | TableSpec, path: str) -> DataFrame:
    """CSV with a header; a drifted header or a value of another type fails."""
    spec = table if isinstance(table, TableSpec) else TABLES[table]
    reader = (
        spark.read.schema(spec.schema)
        .option("header", True)
        .option("mode", "FAILFAST")
        .option("enforceSchema", False)
        .option("dateFormat", "yyyy-MM-dd")
    )
    return without_nan(_load(lambda: reader.csv(path), spec.name, path))


def scan_parquet(spark: SparkSession, table: TableSpec, path: str) -> DataFrame:
    """Parquet with the declared schema, after the stored one was held against it.

    A column that is not there would read as NULL, so a missing or mistyped one
    fails here; further columns are not read.
    """
    missing, _, mismatched = schema_drift(stored_schema(spark, table.name, path), table)
    if missing or mismatched:
        raise SchemaDrift(f"{table.name} at {path}: missing {missing}, of another type {mismatched}")
    return without_nan(_load(lambda: spark.read.schema(table.schema).parquet(path), table.name, path))


def _load(read, name: str, path: str) -> DataFrame:
    try:
        return read()
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            raise MissingSource(f"no file for table '{name}' at {path}") from error
        raise


def select_declared(df: DataFrame, spec: TableSpec) -> DataFrame:
    """The declared columns, in order, cast to their declared types."""
    return df.selectExpr(
        *[f"CAST({f.name} AS {f.dataType.simpleString()}) AS {f.name}" for f in spec.schema]
    )
