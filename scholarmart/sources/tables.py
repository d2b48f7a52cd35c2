"""Table scans, generated tables and sinks."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scholarmart.contracts import SOURCE_TABLES, WAREHOUSE_TABLES, Contract, check_schema
from scholarmart.sources import versions

MONTH_PARTITION = "mes_fecha"


def contract_of(name: str) -> Contract:
    return SOURCE_TABLES.get(name) or WAREHOUSE_TABLES[name]


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Scan one declared table, as the newest manifest has it if the folder is versioned; the schema is given, never inferred."""
    contract = contract_of(name)
    if versions.is_versioned(spark, root) and name in (now := versions.manifest(spark, root)).tables:
        return versions.scan(spark, root, now, name, contract.schema)
    return check_schema(spark.read.schema(contract.schema).parquet(f"{root}/{name}"), contract)


def read_jdbc_table(
    spark: SparkSession, url: str, name: str, partition_column: str, lower: int, upper: int, parts: int, **options: str
) -> DataFrame:
    """Scan a declared table of a live database in ``parts`` key ranges."""
    reader = spark.read.format("jdbc").options(
        url=url, dbtable=name, partitionColumn=partition_column, lowerBound=lower, upperBound=upper, numPartitions=parts
    )
    return check_schema(reader.options(**options).load(), contract_of(name.split(".")[-1]))


def read_since(source: DataFrame, ts_col: str, low: Column, high: Column) -> DataFrame:
    """Rows of the half-open window ``low < ts <= high``."""
    return source.filter((F.col(ts_col) > low) & (F.col(ts_col) <= high))


def exists(spark: SparkSession, path: str) -> bool:
    jvm = spark._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def table_exists(spark: SparkSession, root: str, name: str) -> bool:
    return exists(spark, f"{root}/{name}/_SUCCESS")


def with_partitions(df: DataFrame, contract: Contract) -> DataFrame:
    """Add the month column a partitioned fact is laid out by."""
    if MONTH_PARTITION in contract.partition_by:
        return df.withColumn(MONTH_PARTITION, F.date_format("fecha", "yyyy-MM"))
    return df


def balanced(df: DataFrame, contract: Contract) -> DataFrame:
    """Spread a write over the partition columns; AQE splits big partitions and joins small ones."""
    return df.hint("rebalance", *contract.partition_by) if contract.partition_by else df.hint("rebalance")


def write_table(df: DataFrame, root: str, contract: Contract, mode: str = "overwrite") -> None:
    writer = balanced(with_partitions(df, contract), contract).write.mode(mode)
    if contract.partition_by:
        writer = writer.partitionBy(*contract.partition_by)
    writer.parquet(f"{root}/{contract.name}")


def ensure_table(spark: SparkSession, root: str, contract: Contract) -> DataFrame:
    """Create the table empty if it is not there; then scan it."""
    if not table_exists(spark, root, contract.name):
        write_table(spark.createDataFrame([], contract.schema), root, contract)
    return read_table(spark, root, contract.name)


def ensure_schema(spark: SparkSession, root: str, contracts: Iterable[Contract] = WAREHOUSE_TABLES.values()) -> None:
    for contract in contracts:
        ensure_table(spark, root, contract)


def list_tables(spark: SparkSession, database: str | None = None, pattern: str = "*") -> DataFrame:
    """Names of the tables and views of a schema, sorted."""
    names = spark.sql(f"SHOW TABLES IN {database} LIKE '{pattern}'" if database else f"SHOW TABLES LIKE '{pattern}'")
    return names.select(F.col("tableName").alias("table_name")).orderBy("table_name")


def write_version(df: DataFrame, root: str, folder: str, contract: Contract) -> dict[str, list[str]]:
    """Write content of a declared table below a fresh folder of a versioned root; returns its parts for a commit."""
    by = contract.partition_by[0] if contract.partition_by else None
    return versions.write_parts(balanced(with_partitions(df, contract), contract), root, f"{folder}/{contract.name}", by)


def write_pieces(frames: Sequence[DataFrame], root: str, folder: str, contract: Contract) -> dict[str, list[str]]:
    """Like ``write_version``, for content in several frames, one after the other."""
    if len(frames) == 1:
        return write_version(frames[0], root, folder, contract)
    parts: dict[str, list[str]] = {}
    for k, df in enumerate(frames):
        for part, folders in write_version(df, root, f"{folder}/{k}", contract).items():
            parts.setdefault(part, []).extend(folders)
    return parts


def append(df: DataFrame, root: str, contract: Contract) -> None:
    write_table(df, root, contract, "append")


def reload(frames: dict[str, DataFrame], root: str) -> None:
    """Replace whole tables by new content."""
    for name, df in frames.items():
        contract = contract_of(name)
        writer = balanced(with_partitions(df, contract), contract).write.mode("overwrite")
        writer = writer.option("partitionOverwriteMode", "static")
        if contract.partition_by:
            writer = writer.partitionBy(*contract.partition_by)
        writer.parquet(f"{root}/{name}")


def replace_day(df: DataFrame, root: str, contract: Contract) -> None:
    """Replace the days present in ``df``; other days keep their rows.

    The table is partitioned by day, so a dynamic overwrite deletes and inserts in one commit.
    """
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*contract.partition_by)
        .parquet(f"{root}/{contract.name}")
    )


def inline_table(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType | str) -> DataFrame:
    return spark.createDataFrame(list(rows), schema)


def date_series(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    """One row per day, both ends included."""
    days = F.sequence(F.lit(start), F.lit(end), F.expr("interval 1 day"))
    return spark.range(1).select(F.explode(days).alias("fecha"))


def number_series(spark: SparkSession, first: int, last: int) -> DataFrame:
    return spark.range(first, last + 1).withColumnRenamed("id", "n")


def month_series(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    """Months with their position, counted from one."""
    months = F.sequence(F.lit(start), F.lit(end), F.expr("interval 1 month"))
    return spark.range(1).select(F.posexplode(months).alias("pos", "mes")).select("mes", (F.col("pos") + 1).alias("ord"))


def publish_views(spark: SparkSession, root: str, names: Iterable[str] = WAREHOUSE_TABLES) -> None:
    """Register the warehouse tables as views for SQL readers such as dashboards."""
    for name in names:
        read_table(spark, root, name).createOrReplaceTempView(name)
