"""Relational sources and sinks over JDBC. The driver jar is the caller's to supply."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Partitioning:
    """How a database read is split: ranges of a numeric, date or timestamp column, one connection each."""

    column: str
    lower: object
    upper: object
    count: int

    def options(self) -> dict[str, str]:
        return {
            "partitionColumn": self.column,
            "lowerBound": str(self.lower),
            "upperBound": str(self.upper),
            "numPartitions": str(self.count),
        }


def read_options(url: str, source: str, partitioning: Partitioning | None = None, **options: object) -> dict[str, str]:
    """Reader options; ``source`` is a table name or a query."""
    is_query = source.lstrip().lower().startswith(("select", "with"))
    settings = {"url": url, "dbtable": f"({source}) q" if is_query else source}
    settings.update({k: str(v) for k, v in options.items()})
    if partitioning:
        settings.update(partitioning.options())
    return settings


def read_jdbc(spark: SparkSession, url: str, source: str, partitioning: Partitioning | None = None, **options: object) -> DataFrame:
    """A table or the result of a query; without a partitioning the read is one task, so give one for large tables."""
    return spark.read.format("jdbc").options(**read_options(url, source, partitioning, **options)).load()


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append", connections: int = 8, **options: object) -> None:
    """Rows into a table over at most ``connections`` parallel connections."""
    df.write.format("jdbc").mode(mode).options(url=url, dbtable=table, numPartitions=connections, **options).save()
