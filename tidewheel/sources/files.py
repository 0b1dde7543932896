"""Files and warehouse tables. Schemas are declared, so no source is read twice to guess one."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def parquet_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def warehouse_table(spark: SparkSession, url: str, table: str, key: str | None = None, bounds: tuple[int, int] | None = None, parts: int = 16, **options: str) -> DataFrame:
    """A table or view of a SQL warehouse over JDBC, read in `parts` ranges of an integer key if given, whose bounds the
    warehouse tells if they aren't. Filters and columns are left to the warehouse. Needs the driver's jar on the class path."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **options)
    if key and bounds is None:
        name = spark._jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(url).quoteIdentifier(key)
        ends = spark.read.format("jdbc").options(url=url, dbtable=f"(SELECT MIN({name}) AS lo, MAX({name}) AS hi FROM {table}) bounds", **options).load().first()
        bounds = None if ends[0] is None else (int(ends[0]), int(ends[1]) + 1)
    if key and bounds:
        reader = reader.options(partitionColumn=key, lowerBound=str(bounds[0]), upperBound=str(bounds[1]), numPartitions=str(parts))
    return reader.load()


def warehouse_catalog(spark: SparkSession, name: str, url: str, **options: str) -> None:
    """Makes a warehouse's tables known as name.schema.table, for SQL too. Besides filters and columns, Spark leaves
    aggregates, limits and sorting for these to the warehouse where its dialect has them."""
    for key, value in {"": "org.apache.spark.sql.execution.datasources.v2.jdbc.JDBCTableCatalog", ".url": url, ".pushDownAggregate": "true", ".pushDownLimit": "true", **{f".{k}": v for k, v in options.items()}}.items():
        spark.conf.set(f"spark.sql.catalog.{name}{key}", value)


def write_warehouse(df: DataFrame, url: str, table: str, mode: str = "overwrite", types: str | None = None, **options: str) -> None:
    """df as a table of a SQL warehouse; each partition is a connection of its own, in batches. types: the warehouse's
    types of columns, as DDL, where they should be others than Spark's choice (some can't compare their unbounded texts)."""
    if types:
        options["createTableColumnTypes"] = types
    df.write.format("jdbc").options(url=url, dbtable=table, batchsize="5000", **options).mode(mode).save()


def csv_table(spark: SparkSession, path: str, schema: StructType | str, encoding: str = "UTF-8", header: bool = True, sep: str = ",", errors: str | None = None, multi_line: bool = False) -> DataFrame:
    """A CSV file or folder. multi_line: line breaks may stand in quoted fields; then a file can't be split, and is
    one task however large it is. errors: a column of the schema that takes lines that don't fit. Code page 1252 is read
    as ISO-8859-1, and the 27 characters in which they differ are put right."""
    windows = encoding.lower().replace("windows-", "cp") == "cp1252"
    reader = spark.read.schema(schema).option("header", header).option("encoding", "ISO-8859-1" if windows else encoding).option("sep", sep).option("multiLine", multi_line)
    if errors:
        reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", errors)
    out = reader.csv(path)
    if windows:
        out = out.withColumns({c: F.translate(c, *_windows()) for c, k in out.dtypes if k == "string"})
    return out


def _windows() -> tuple[str, str]:
    """The characters 128 to 159 that code page 1252 has, as ISO-8859-1 reads them and as they are."""
    codes = [b for b in range(128, 160) if bytes((b,)).decode("cp1252", "ignore")]
    return "".join(map(chr, codes)), bytes(codes).decode("cp1252")


def json_table(spark: SparkSession, path: str, schema: StructType | str, lines: bool = True) -> DataFrame:
    return spark.read.schema(schema).option("multiLine", not lines).json(path)


def latest_file(spark: SparkSession, folder: str, pattern: str = r"FY(\d{4})") -> str | None:
    """The path of the file in folder whose name has the largest number in the pattern's group, of equal ones the
    last by name; None if no name fits. Lists through Hadoop's API, so any store will do."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    where = jvm.org.apache.hadoop.fs.Path(folder)
    best: tuple[int, str, str] | None = None
    for status in where.getFileSystem(conf).listStatus(where):
        path = status.getPath()
        if m := re.search(pattern, path.getName()):
            found = (int(m[1]), path.getName(), path.toString())
            best = found if best is None else max(best, found)
    return best[2] if best else None


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None, mode: str = "overwrite") -> None:
    writer = df.write.mode(mode)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", True).csv(path)
