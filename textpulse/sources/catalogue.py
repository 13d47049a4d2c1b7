"""The star schema and the staging table in Spark's catalogue, with column defaults, for SQL users."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from textpulse import schemas, storage
from textpulse.sources.warehouse import FACTS, PARTITIONED, Version, Warehouse

STAGING = "raw_data"
TABLES: dict[str, StructType] = {STAGING: schemas.RAW_DATA, **schemas.STAR_TABLES}
# What a column holds where an insert does not name it.
DEFAULTS = {"load_dt": "current_timestamp()"}
# The warehouse version that the catalogue's tables hold.
_VERSION = "textpulse.version"


@contextmanager
def _only_their_partitions(spark: SparkSession) -> Iterator[None]:
    """Overwriting inserts replace the partitions of their rows and no other. Tables take this from the session only."""
    setting = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(setting, before)


@dataclass(frozen=True)
class Catalogue:
    """Tables of one database, each a folder under ``location``."""

    spark: SparkSession
    database: str
    location: str

    def name(self, table: str) -> str:
        return f"`{self.database}`.`{table}`"

    def create(self) -> Catalogue:
        """Database and tables where they are missing."""
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{self.database}` LOCATION '{self.location}'")
        codec = ", ".join(f"'{key}' '{value}'" for key, value in storage.TEXT_CODEC.items())
        for table, schema in TABLES.items():
            coded = f" OPTIONS ({codec})" if "text" in schema.names else ""
            columns = ", ".join(
                f"`{c.name}` {c.dataType.simpleString()}" + (f" DEFAULT {DEFAULTS[c.name]}" if c.name in DEFAULTS else "")
                for c in schema.fields
            )
            split = f" PARTITIONED BY ({PARTITIONED[table]})" if table in PARTITIONED else ""
            self.spark.sql(
                f"CREATE TABLE IF NOT EXISTS {self.name(table)} ({columns}) USING parquet{coded}{split} "
                f"LOCATION '{self.location}/{table}'"
            )
        return self

    def table(self, table: str) -> DataFrame:
        return self.spark.table(self.name(table))

    def insert(self, table: str, rows: DataFrame) -> None:
        """Appends rows by column name. Columns that the rows lack get their default, or null without one."""
        names = ", ".join(f"`{c}`" for c in rows.columns)
        self.spark.sql(f"INSERT INTO {self.name(table)} ({names}) SELECT {names} FROM {{rows}}", rows=rows)

    def insert_missing(self, table: str, rows: DataFrame, key: str) -> None:
        """``insert`` of those rows whose key the table lacks."""
        self.insert(table, rows.join(self.table(table).select(key), key, "left_anti"))

    def held_version(self) -> int:
        held = self.spark.sql(f"SHOW TBLPROPERTIES {self.name(FACTS)}").where(F.col("key") == _VERSION).first()
        return int(held["value"]) if held else 0

    def refresh(self, warehouse: Warehouse) -> None:
        """Brings the tables up to the warehouse's newest version. Dimension rows are added; of the facts, only days
        whose folders changed since the version held here are written, and days without facts go. Where that version
        is no longer kept, all days are written."""
        new = warehouse.pinned()
        for table, key in (("dim_source", "source_id"), ("dim_date", "date_id"), ("dim_topic", "topic_id")):
            self.insert_missing(table, new.table(table), key)
        number = self.held_version()
        kept = number in warehouse.versions()
        old = Warehouse(self.spark, warehouse.root, number).version() if kept else Version()
        before, after = _days(old), _days(new.version())
        changed = sorted(d for d in after if before.get(d) != after[d])
        if changed:
            facts = new.facts.where(F.col("date_id").isin(changed)).select(*self.table(FACTS).columns)
            with _only_their_partitions(self.spark):
                facts.write.mode("overwrite").insertInto(self.name(FACTS))
        here = {row["date_id"] for row in self.table(FACTS).select("date_id").distinct().collect()}
        for day in sorted(here - set(after)):
            self.spark.sql(f"ALTER TABLE {self.name(FACTS)} DROP IF EXISTS PARTITION (date_id = {day})")
        self.spark.sql(
            f"ALTER TABLE {self.name(FACTS)} SET TBLPROPERTIES ('{_VERSION}' = '{new.version().number}')"
        )

    def described(self) -> DataFrame:
        """(table_name, columns, partitioned_by, defaults, row_count) as the catalogue has them, a row per table."""
        out = None
        for table in TABLES:
            listed = self.spark.catalog.listColumns(self.name(table))
            given = {c.name: c.metadata.get("CURRENT_DEFAULT") for c in self.table(table).schema.fields}
            row = self.table(table).agg(F.count(F.lit(1)).alias("row_count")).select(
                F.lit(table).alias("table_name"),
                F.lit(", ".join(f"{c.name} {c.dataType}" for c in listed)).alias("columns"),
                F.lit(", ".join(c.name for c in listed if c.isPartition)).alias("partitioned_by"),
                F.lit(", ".join(f"{n} {d}" for n, d in given.items() if d)).alias("defaults"),
                "row_count",
            )
            out = row if out is None else out.unionByName(row)
        return out


def _days(version: Version) -> dict[int, list[str]]:
    days: dict[int, list[str]] = {}
    for load, day in version.folders.get(FACTS, ()):
        days.setdefault(day, []).append(load)
    return days

