"""The star schema as Parquet folders under one root, in versions.

Each load writes folders of its own, ``<table>/load=<load>[/date_id=<day>]``, and changes no other. A version is a
small file, ``versions/v<number>``, that names the folders which make up the tables and the staged batches they hold.
Readers resolve the newest one; a load becomes visible as a whole when its version file is renamed into place.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from textpulse import schemas, storage
from textpulse.operators import hours, keyfilter

FACTS, KEY_FILTERS, HOURS = "fact_sentiment", "fact_keys", "fact_hours"
# Tables with a folder for each fact folder, and what they hold of it.
BESIDE_FACTS = {KEY_FILTERS: keyfilter.filters, HOURS: hours.hourly}
PARTITIONED = {FACTS: "date_id"}
# A day or dimension in this many folders is written anew by the next load that adds to it.
MOST_FOLDERS = 16

Folder = tuple[str, int | None]
Batch = tuple[str, int]


@dataclass(frozen=True)
class Version:
    """The folders (load, day) of each table, and the staged batches (run, number) with the load that took each in."""

    number: int = 0
    folders: dict[str, tuple[Folder, ...]] = field(default_factory=dict)
    batches: dict[Batch, str] = field(default_factory=dict)

    def text(self) -> str:
        folders = [
            {"table": table, "load": load, "date_id": day} for table, held in self.folders.items() for load, day in held
        ]
        batches = [{"run": run, "batch_id": n, "load": load} for (run, n), load in self.batches.items()]
        return "\n".join(json.dumps(line) for line in [*folders, *batches])

    @classmethod
    def parsed(cls, number: int, text: str) -> Version:
        folders: dict[str, list[Folder]] = {}
        batches: dict[Batch, str] = {}
        for line in map(json.loads, text.splitlines()):
            if "table" in line:
                folders.setdefault(line["table"], []).append((line["load"], line["date_id"]))
            else:
                batches[line["run"], line["batch_id"]] = line["load"]
        return cls(number, {table: tuple(held) for table, held in folders.items()}, batches)


# Version files never change once they are there.
_read: dict[str, Version] = {}


@dataclass(frozen=True)
class Warehouse:
    """Tables of the newest version, whatever it is at the time, or of the one it is pinned to."""

    spark: SparkSession
    root: str
    pinned_to: int | None = None

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def _version_path(self, number: int) -> str:
        return f"{self.path('versions')}/v{number:010d}"

    def versions(self) -> list[int]:
        names = storage.names(self.spark, self.path("versions"))
        return sorted(int(name[1:]) for name in names if name.startswith("v"))

    def version(self) -> Version:
        number = self.pinned_to
        if number is None:
            number = max(self.versions(), default=0)
        if number == 0:
            return Version()
        path = self._version_path(number)
        if path not in _read:
            _read[path] = Version.parsed(number, storage.read_text(self.spark, path))
        return _read[path]

    def pinned(self) -> Warehouse:
        """The same tables at one version: what several reads see fits together."""
        return replace(self, pinned_to=self.version().number)

    def create(self) -> Warehouse:
        """A first version without rows where there is none."""
        if not self.versions():
            self.publish(Version(1))
        return self

    def publish(self, version: Version) -> None:
        """Makes a version the newest one, or fails where another load has taken its number."""
        path = self._version_path(version.number)
        try:
            storage.write_new_text(self.spark, path, version.text())
        except Exception as error:
            if storage.exists(self.spark, path):
                raise RuntimeError(f"{self.root}: another load has published meanwhile; load again") from error
            raise

    def _rows(self, table: str, schema: StructType, folders: Iterable[Folder]) -> DataFrame:
        base = self.path(table)
        paths = [f"{base}/load={load}" + (f"/date_id={day}" if day is not None else "") for load, day in folders]
        if not paths:
            return self.spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])
        asked = schema.fields if "load" in schema.names else [*schema.fields, StructField("load", StringType())]
        reader = self.spark.read.schema(StructType(asked)).option("basePath", base)
        return reader.parquet(*paths).select(*schema.names)

    def table(self, name: str) -> DataFrame:
        return self._rows(name, schemas.STAR_TABLES[name], self.version().folders.get(name, ()))

    @property
    def facts(self) -> DataFrame:
        return self.table(FACTS)

    @property
    def sources(self) -> DataFrame:
        return self.table("dim_source")

    @property
    def topics(self) -> DataFrame:
        return self.table("dim_topic")

    @property
    def dates(self) -> DataFrame:
        return self.table("dim_date")

    def folders_of_facts(self, folders: Iterable[Folder]) -> DataFrame:
        """The facts of some folders, with the load that wrote each."""
        return self._rows(FACTS, StructType([*schemas.FACT.fields, StructField("load", StringType())]), folders)

    def key_filters(self) -> DataFrame:
        """The filters of all fact folders: which days may hold a fact id."""
        return self._rows(KEY_FILTERS, schemas.KEY_FILTERS, self.version().folders.get(FACTS, ()))

    @property
    def hours(self) -> DataFrame:
        """Measures of all facts per hour, source, topic and class."""
        return self._rows(HOURS, schemas.FACT_HOURS, self.version().folders.get(FACTS, ()))

    def ledger(self) -> DataFrame:
        """(run, batch_id, load) of every staged batch the facts hold."""
        rows = [(run, n, load) for (run, n), load in self.version().batches.items()]
        return self.spark.createDataFrame(rows, schemas.LEDGER)

    def vacuum(self, keep: int = 2) -> None:
        """Deletes versions but the newest ``keep``, and folders of loads that none of those names: loads that were
        cut short, and days that were written anew. No load may be running, no reader on an older version."""
        numbers = self.versions()
        for number in numbers[:-keep]:
            storage.delete(self.spark, self._version_path(number))
        kept = [replace(self, pinned_to=n).version() for n in numbers[-keep:]]
        for table in (*schemas.STAR_TABLES, *BESIDE_FACTS):
            named = {f for v in kept for f in v.folders.get(FACTS if table in BESIDE_FACTS else table, ())}
            loads = {load for load, _ in named}
            for name in storage.names(self.spark, self.path(table)):
                load, path = name.removeprefix("load="), f"{self.path(table)}/{name}"
                if load not in loads:
                    storage.delete(self.spark, path)
                    continue
                for day in storage.names(self.spark, path):
                    if day.startswith("date_id=") and (load, int(day[8:])) not in named:
                        storage.delete(self.spark, f"{path}/{day}")


class Change:
    """A load in the making: folders nobody sees before ``publish``."""

    def __init__(self, warehouse: Warehouse):
        self.held = warehouse.pinned()
        self.load = f"{self.held.version().number + 1:010d}-{uuid.uuid4().hex[:12]}"
        self.folders = dict(self.held.version().folders)

    def crowded(self, table: str) -> set[int | None]:
        """Days (None for a dimension) in so many folders that they should be written anew."""
        count: dict[int | None, int] = {}
        for _, day in self.folders.get(table, ()):
            count[day] = count.get(day, 0) + 1
        return {day for day, n in count.items() if n >= MOST_FOLDERS}

    def add(self, table: str, rows: DataFrame, instead: bool = False) -> None:
        """Rows for a dimension, added or in place of all it holds; no folder where there are none."""
        seen, path = Observation(), f"{self.held.path(table)}/load={self.load}"
        rows.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("errorifexists").parquet(path)
        if seen.get["n"] or instead:
            before = () if instead else self.folders.get(table, ())
            self.folders[table] = (*before, (self.load, None))
        else:
            storage.delete(self.held.spark, path)

    def add_facts(self, rows: DataFrame, instead_of: set[int]) -> None:
        """Facts in a folder per day, with the filters of their ids and their hours; days in ``instead_of`` consist of these
        alone. Filters and hours are brought together by day before they are written: else every task would write a file
        for every day, and with tasks and days the files would grow as their product.
        """
        spark, path = self.held.spark, f"{self.held.path(FACTS)}/load={self.load}"
        rows.write.mode("errorifexists").options(**storage.TEXT_CODEC).partitionBy("date_id").parquet(path)
        days = [int(n[8:]) for n in storage.names(spark, path) if n.startswith("date_id=")]
        added = [(self.load, day) for day in days]
        written = self.held._rows(FACTS, schemas.FACT, added)
        for table, made in BESIDE_FACTS.items():
            by_day = made(written).hint("rebalance", "date_id").sortWithinPartitions("date_id")
            by_day.write.mode("errorifexists").partitionBy("date_id").parquet(f"{self.held.path(table)}/load={self.load}")
        staying = [f for f in self.folders.get(FACTS, ()) if f[1] not in instead_of]
        self.folders[FACTS] = (*staying, *added)

    def publish(self, batches: Iterable[Batch] = ()) -> None:
        before = self.held.version()
        taken = {**before.batches, **dict.fromkeys(batches, self.load)}
        self.held.publish(Version(before.number + 1, self.folders, taken))
