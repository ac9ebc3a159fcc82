"""File and catalog sources (S-series): typed / inferred CSV, CSV folders,
external tables, SQL-or-table sources, previews, schema-derived tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from retailcast.contract import RAW_SCHEMA
from retailcast.functions.columns import sanitize_column_name


def scan_typed_csv(spark: SparkSession, path: str, schema: T.StructType = RAW_SCHEMA,
                   mode: str = "PERMISSIVE", corrupt_col: str | None = None) -> DataFrame:
    """Header CSV with an explicit schema (no inference pass). In
    PERMISSIVE mode a `corrupt_col` keeps the raw text of malformed lines."""
    r = spark.read.option("header", True).option("quote", '"').option("mode", mode)
    if corrupt_col:
        schema = T.StructType(schema.fields + [T.StructField(corrupt_col, T.StringType(), True)])
        r = r.option("columnNameOfCorruptRecord", corrupt_col)
    return r.schema(schema).csv(path)


def scan_inferred_csv(spark: SparkSession, path: str) -> DataFrame:
    """Header CSV with type inference (one extra pass over the files)."""
    return spark.read.option("header", True).option("inferSchema", True).csv(path)


def scan_csv_dir(spark: SparkSession, folder: str, schema: T.StructType = RAW_SCHEMA) -> DataFrame:
    """S3: every *.csv file of a folder as one table; error when there is none."""
    try:
        return scan_typed_csv(spark, folder.rstrip("/") + "/*.csv", schema)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        raise RuntimeError(f"{folder} holds no *.csv file") from e


def ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def register_external_table(spark: SparkSession, database: str, table: str, location: str,
                            schema: T.StructType = RAW_SCHEMA, db_location: str | None = None) -> DataFrame:
    """CREATE DATABASE / CREATE TABLE IF NOT EXISTS over a CSV folder (header skipped)."""
    loc = f" LOCATION '{db_location}'" if db_location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{loc}")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{table} ({ddl(schema)}) USING csv "
              f"OPTIONS (header 'true') LOCATION '{location}'")
    return spark.table(f"{database}.{table}")


def source_table_or_query(spark: SparkSession, query: str | None = None, database: str | None = None,
                          table: str | None = None) -> DataFrame:
    """A custom SQL query if given, else the whole table; neither is an error."""
    if query:
        return spark.sql(query)
    if database and table:
        return spark.table(f"{database}.{table}")
    raise ValueError("Either a query or database and table must be given")


def preview_limit(df: DataFrame, n: int = 10, order_by: str | list[str] = "record_id") -> DataFrame:
    """First n rows by an explicit order (TakeOrderedAndProject)."""
    cols = [order_by] if isinstance(order_by, str) else order_by
    return df.orderBy(*cols).limit(n)


def create_table_from_schema(df: DataFrame, table: str, path: str) -> DataFrame:
    """Sanitize column names, keep types, create the table at `path` if absent."""
    spark = df.sparkSession
    clean = df.toDF(*[sanitize_column_name(c) for c in df.columns])
    if not spark.catalog.tableExists(table):
        spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({ddl(clean.schema)}) USING parquet LOCATION '{path}'")
    clean.write.mode("append").insertInto(table)
    return spark.table(table)


def read_profile_json(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Nested (multi-line) profile JSON with an explicit schema."""
    return spark.read.option("multiLine", True).schema(schema).json(path)
