"""Reading layer tables and relational tables, and guards for missing sources."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from tierlake.session import ensure_folder


def scan_table(spark: SparkSession, path: str, schema: StructType | None = None,
               dates: tuple[date, date] | None = None,
               date_column: str = "ingestion_date") -> DataFrame:
    """Scan a Parquet table; ``dates`` (both ends included) prunes its date partitions."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    df = reader.parquet(path)
    if dates is not None:
        df = df.filter(F.col(date_column).between(F.lit(dates[0]), F.lit(dates[1])))
    return df


def table_stream(spark: SparkSession, path: str, schema: StructType,
                 max_files_per_trigger: int | None = None) -> DataFrame:
    """Stream the files of a Parquet table, which may have none yet: its schema is declared."""
    ensure_folder(spark, path)
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def scan_or_none(spark: SparkSession, path: str,
                 schema: StructType | None = None) -> DataFrame | None:
    """A table, or None when its path does not exist or holds no readable files."""
    try:
        return scan_table(spark, path, schema)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def has_rows(df: DataFrame) -> bool:
    """Whether a source has any row; stops at the first one instead of counting."""
    return not df.isEmpty()


@dataclass(frozen=True)
class Jdbc:
    """A relational database reached through a JDBC driver the caller puts on the classpath."""

    url: str
    driver: str
    properties: dict[str, str] | None = None

    def options(self, table: str) -> dict[str, str]:
        return {"url": self.url, "driver": self.driver, "dbtable": table,
                **(self.properties or {})}


@dataclass(frozen=True)
class JdbcSplit:
    """How a relational scan is divided: a numeric or date column, its bounds, and the number
    of concurrent range queries."""

    column: str
    lower: str
    upper: str
    partitions: int

    def options(self) -> dict[str, str]:
        return {"partitionColumn": self.column, "lowerBound": self.lower,
                "upperBound": self.upper, "numPartitions": str(self.partitions)}


def read_relational(spark: SparkSession, database: Jdbc, table: str,
                    split: JdbcSplit | None = None) -> DataFrame:
    """Scan a relational table, in parallel ranges when ``split`` is given."""
    options = database.options(table) | (split.options() if split else {})
    return spark.read.format("jdbc").options(**options).load()
