"""Batch sources. Schemas are given, not inferred, unless the caller leaves them out."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TRANSACTION_SCHEMA = (
    "transaction_id string, customer_id string, product_id string, product_name string, category string, quantity int, "
    "unit_price double, total_amount double, transaction_date string, transaction_time string, city string, "
    "payment_method string, discount double, year int, month int, day int"
)
SENSOR_SCHEMA = (
    "timestamp string, sensor_id string, location string, temperature double, humidity double, pressure double, "
    "battery_level int, status string"
)
LOG_SCHEMA = (
    "timestamp string, level string, service string, message string, trace_id string, response_time_ms int"
)
REJECTED = "_corrupt_record"

# The tables of a data folder. Declared, so that opening a table costs no job that reads file footers.
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": (
        "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"
    ),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    ),
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


@dataclass(frozen=True)
class CsvDialect:
    """Quoting and comment rules of a delimited file."""

    sep: str = ","
    quote: str = '"'
    escape: str = "\\"
    comment: str | None = "#"
    header: bool = True
    multi_line: bool = False

    def options(self) -> dict[str, object]:
        options = {"sep": self.sep, "quote": self.quote, "escape": self.escape, "header": self.header, "multiLine": self.multi_line}
        if self.comment:
            options["comment"] = self.comment
        return options


def _schema(schema: T.StructType | str) -> T.StructType:
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One Parquet table of a data folder."""
    reader = spark.read.schema(TABLES[name]) if name in TABLES else spark.read
    return reader.parquet(f"{sf_dir}/{name}.parquet")


def register(spark: SparkSession, tables: Mapping[str, DataFrame]) -> None:
    """Make DataFrames readable by name in SQL."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def read_csv(spark: SparkSession, path: str | list[str], schema: T.StructType | str | None = None, dialect: CsvDialect = CsvDialect(comment=None)) -> DataFrame:
    """CSV files; without a schema the types are inferred, which costs an extra pass over the data."""
    reader = spark.read.options(**dialect.options())
    reader = reader.option("inferSchema", True) if schema is None else reader.schema(_schema(schema))
    return reader.csv(path)


def read_csv_tolerant(
    spark: SparkSession, path: str | list[str], schema: T.StructType | str, dialect: CsvDialect = CsvDialect()
) -> tuple[DataFrame, DataFrame]:
    """Rows that fit the schema, and the raw text of those that do not (with whatever fields could be parsed).

    Spark judges a row by the columns a query needs, so a pruned scan would let a malformed field pass. Each side
    therefore tests a hash of all columns in a way that always holds, which keeps them all in the scan.
    """
    full = T.StructType([*_schema(schema).fields, T.StructField(REJECTED, T.StringType())])
    rows = (
        spark.read.options(**dialect.options())
        .options(mode="PERMISSIVE", columnNameOfCorruptRecord=REJECTED, columnPruning=False)
        .schema(full)
        .csv(path)
    )
    all_parsed = F.xxhash64(*_schema(schema).names) >= F.lit(-(2**63))
    good = rows.filter(F.col(REJECTED).isNull() & all_parsed).drop(REJECTED)
    return good, rows.filter(F.col(REJECTED).isNotNull() & all_parsed)


def read_json(spark: SparkSession, path: str | list[str], schema: T.StructType | str, multi_line: bool = True) -> DataFrame:
    """JSON files: pretty-printed documents or arrays, or one record per line with ``multi_line=False``.

    A multi-line file is one task's work; large feeds belong in JSON lines, which split.
    """
    return spark.read.schema(_schema(schema)).json(path, multiLine=multi_line)


def read_orc(spark: SparkSession, path: str | list[str], schema: T.StructType | str | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(_schema(schema))
    return reader.orc(path)


def read_any(spark: SparkSession, fmt: str, path: str | list[str], schema: T.StructType | str | None = None, **options: object) -> DataFrame:
    """One named file, a list of files, or a wildcard, in any format Spark reads."""
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(_schema(schema))
    return reader.load(path)


def read_files(
    spark: SparkSession,
    fmt: str,
    path: str,
    schema: T.StructType | str,
    glob: str | None = None,
    recursive: bool = False,
    max_bytes: int | None = None,
    **options: object,
) -> DataFrame:
    """Files of a folder picked by name pattern, below subfolders too if asked, and by size.

    The size test is on file metadata, which the scan applies while listing: larger files are never opened.
    """
    if glob:
        options["pathGlobFilter"] = glob
    if recursive:
        options["recursiveFileLookup"] = True
    rows = read_any(spark, fmt, path, schema, **options)
    return rows if max_bytes is None else rows.filter(F.col("_metadata.file_size") <= max_bytes)


def external_table(spark: SparkSession, name: str, path: str, schema: T.StructType | str, fmt: str = "csv", by: Sequence[str] = (), **options: object) -> DataFrame:
    """Register a table over files that already exist; dropping the table leaves them."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in _schema(schema).fields)
    extras = ", ".join(f"'{k}' '{str(v).lower() if isinstance(v, bool) else v}'" for k, v in options.items())
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING {fmt}"
        + (f" OPTIONS ({extras})" if extras else "")
        + (f" PARTITIONED BY ({', '.join(by)})" if by else "")
        + f" LOCATION '{path}'"
    )
    if by:
        spark.catalog.recoverPartitions(name)
    return spark.table(name)


def read_xml_records(spark: SparkSession, path: str | list[str], row_tag: str, schema: T.StructType | str) -> DataFrame:
    """Repeated elements of XML files as rows, nested elements as structs and arrays.

    A file is one task's work; ``writers.write_xml`` keeps files small.
    """
    return spark.read.schema(_schema(schema)).option("rowTag", row_tag).xml(path)


def payload_table(spark: SparkSession, path: str | list[str], schema: T.StructType | str, fields: Mapping[str, str | Column]) -> DataFrame:
    """Staged API payloads (JSON lines) as a flat table; ``fields`` names each column and its nested source."""
    payloads = read_json(spark, path, schema, multi_line=False)
    return payloads.select(*[(F.col(source) if isinstance(source, str) else source).alias(name) for name, source in fields.items()])


def read_incremental(df: DataFrame, column: str, high_water_mark: object) -> DataFrame:
    """Rows above the mark of the last run; the comparison is pushed down to Parquet, ORC and database scans."""
    return df if high_water_mark is None else df.filter(F.col(column) > F.lit(high_water_mark))


def next_high_water_mark(df: DataFrame, column: str, previous: object = None) -> object:
    """The mark to keep for the next run."""
    highest = df.agg(F.max(column).alias("mark")).first()["mark"]
    return previous if highest is None else highest
