"""Layered tables that are replaced whole or slice by slice, and only once the new data is complete.

Overwriting a Parquet table in place deletes the old files before the new ones are there. Here every
write goes to a folder of its own, is audited there, and is then published by pointing the catalog
entry at that folder; a panel is a view, pointed at a new list of slices. A failed or rejected build leaves the
published data as it was, an empty slice replaces a full one, and no data is cached or computed twice
between audit and publication.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from datetime import UTC, date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillpanel.schemas import GOLD_TABLE, LAYERS
from tillpanel.storage.layout import dated


PANEL_VERSION = "panel.version"
VERSION_MARK = "__v"


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)


class Warehouse:
    """The three layers as databases; ``prefix`` keeps several warehouses apart in one catalog."""

    def __init__(self, spark: SparkSession, root: str, prefix: str = ""):
        self.spark, self.root, self.prefix = spark, root.rstrip("/"), prefix
        for layer in LAYERS:
            spark.sql(
                f"CREATE DATABASE IF NOT EXISTS `{prefix}{layer}` LOCATION '{self.root}/{layer}'"
            )

    def qualified(self, table: str) -> str:
        return self.prefix + table

    def exists(self, table: str) -> bool:
        return self.spark.catalog.tableExists(self.qualified(table))

    def table(self, table: str) -> DataFrame:
        return self.spark.table(self.qualified(table))

    def dated_table(self, table: str) -> DataFrame:
        """A table with the day of its rows beside its columns; see ``layout``."""
        (path,) = self._published_folders(table)
        return dated(self.spark, path, self.table(table).schema)

    def tables(self) -> dict[str, DataFrame]:
        """Every table of the layers, ordered by layer and then by name."""
        listed = {
            layer: sorted(
                t.name
                for t in self.spark.catalog.listTables(self.prefix + layer)
                if not t.isTemporary and VERSION_MARK not in t.name
            )
            for layer in LAYERS
        }
        names = [f"{layer}.{name}" for layer in LAYERS for name in listed[layer]]
        return {name: self.table(name) for name in names}

    # ---- write, audit, publish ---------------------------------------------------------------

    def _new_version(self, table: str) -> str:
        layer, name = table.split(".")
        stamp = datetime.now(UTC).strftime("%Y%m%dT%H%M%S%f")
        return f"{self.root}/{layer}/{name}/v{stamp}-{uuid.uuid4().hex[:8]}"

    def stage(self, frame: DataFrame, table: str) -> str:
        """Write ``frame`` as an unpublished version; ``read_staged`` gives it back."""
        path = self._new_version(table)
        frame.write.mode("errorifexists").parquet(path)
        return path

    def read_staged(self, path: str, schema: T.StructType) -> DataFrame:
        return self.spark.read.schema(schema).parquet(path)

    def publish(self, path: str, table: str, schema: T.StructType) -> None:
        """Make a staged version the content of ``table``, in one catalog change."""
        name = self.qualified(table)
        if self.exists(table):
            self.spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
        else:
            self.spark.sql(f"CREATE TABLE {name} ({_ddl(schema)}) USING parquet LOCATION '{path}'")
        self.spark.catalog.refreshTable(name)

    def replace(self, frame: DataFrame, table: str, schema: T.StructType) -> DataFrame:
        """Full replacement of a table, without an audit in between."""
        self.publish(self.stage(frame, table), table, schema)
        return self.table(table)

    # ---- the panel, one partition per cutoff ---------------------------------------------------

    def _panel_version(self, table: str) -> str | None:
        """The catalog entry that holds the panel's slices; the panel itself is a view of it."""
        if not self.exists(table):
            return None
        properties = self.spark.sql(f"SHOW TBLPROPERTIES {self.qualified(table)}").collect()
        return next((r.value for r in properties if r.key == PANEL_VERSION), None)

    def _slices(self, version: str | None) -> dict[str, str]:
        """Folder of each cutoff (as text) of a version."""
        found = {}
        for row in self.spark.sql(f"SHOW PARTITIONS {version}").collect() if version else ():
            _, _, day = row.partition.partition("=")
            described = self.spark.sql(f"DESCRIBE FORMATTED {version} PARTITION (as_of_date = '{day}')").collect()
            # The slice comes first, the table after it.
            found[day] = next(r.data_type for r in described if r.col_name == "Location")
        return found

    def publish_slices(self, paths: Mapping[date, str], schema: T.StructType, table: str = GOLD_TABLE) -> None:
        """Make staged slices (without their ``as_of_date``) the panel's content for their dates.

        A new version takes over the folders of all other slices; then the view that readers know is
        pointed at it. That is one catalog change, so readers have all new slices or none of them.
        """
        slices = self._slices(self._panel_version(table)) | {d.isoformat(): p for d, p in paths.items()}
        stamp = f"{datetime.now(UTC):%Y%m%dt%H%M%S%f}_{uuid.uuid4().hex[:8]}"
        version, (layer, name) = f"{self.qualified(table)}{VERSION_MARK}{stamp}", table.split(".")
        self.spark.sql(
            f"CREATE TABLE {version} ({_ddl(schema)}) USING parquet PARTITIONED BY (as_of_date) "
            f"LOCATION '{self.root}/{layer}/{name}/slices-{stamp}'"
        )
        added = " ".join(f"PARTITION (as_of_date = DATE'{d}') LOCATION '{p}'" for d, p in sorted(slices.items()))
        if added:
            self.spark.sql(f"ALTER TABLE {version} ADD {added}")
        columns = ", ".join(f"`{f.name}`" for f in schema)
        self.spark.sql(
            f"CREATE OR REPLACE VIEW {self.qualified(table)} TBLPROPERTIES ('{PANEL_VERSION}' = '{version}') "
            f"AS SELECT {columns} FROM {version}"
        )

    def publish_slice(
        self, path: str, as_of: date, schema: T.StructType, table: str = GOLD_TABLE
    ) -> None:
        self.publish_slices({as_of: path}, schema, table)

    def upsert_slice(
        self, snapshot: DataFrame, as_of: date, schema: T.StructType, table: str = GOLD_TABLE
    ) -> None:
        """Replace the rows of one cutoff; other cutoffs stay. An empty snapshot clears the slice."""
        wrong_date = F.raise_error(F.lit(f"row outside the slice {as_of}")).cast("string")
        checked = snapshot.withColumn(
            "customer_id",
            F.when(F.col("as_of_date") == F.lit(as_of), F.col("customer_id")).otherwise(wrong_date),
        )
        self.publish_slice(self.stage(checked.drop("as_of_date"), table), as_of, schema, table)

    def stage_slices(
        self, panel: DataFrame, days: list[date], table: str = GOLD_TABLE
    ) -> tuple[str, dict[date, str]]:
        """Write many slices at once; gives the folder of all of them and of each.

        Rebalancing by cutoff keeps a slice in few files of even size.
        """
        root = self._new_version(table)
        panel.hint("rebalance", "as_of_date").write.partitionBy("as_of_date").parquet(root)
        # One folder per cutoff that has rows; the others get an empty slice of their own.
        filled = {r.as_of_date for r in self.spark.read.schema(panel.schema).parquet(root)
                  .select("as_of_date").distinct().collect()}
        empty = self.spark.createDataFrame([], panel.drop("as_of_date").schema)
        return root, {
            day: f"{root}/as_of_date={day.isoformat()}" if day in filled
            else self.stage(empty, table)
            for day in days
        }

    # ---- housekeeping and export ----------------------------------------------------------------

    def _published_folders(self, table: str) -> set[str]:
        """Folders the catalog points at: of the table, or of each slice of a panel."""
        if version := self._panel_version(table):
            return set(self._slices(version).values())
        described = self.spark.sql(f"DESCRIBE FORMATTED {self.qualified(table)}")
        return {row.data_type for row in described.filter("col_name = 'Location'").collect()}

    def remove_superseded(self, table: str) -> list[str]:
        """Delete the versions of a table that are published no more, of a panel the catalog entries too.

        Not part of a build: readers may still be on the previous version.
        """
        layer, name = table.split(".")
        current = self._panel_version(table)
        for other in self.spark.catalog.listTables(self.prefix + layer):
            entry = f"{self.prefix}{layer}.{other.name}"
            if other.name.startswith(name + VERSION_MARK) and entry != current:
                self.spark.sql(f"DROP TABLE {entry}")
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        folder = hadoop.Path(f"{self.root}/{layer}/{name}")
        files = folder.getFileSystem(self.spark._jsc.hadoopConfiguration())
        published = [hadoop.Path(p).toUri().getPath() for p in self._published_folders(table)]
        removed = []
        for status in files.listStatus(folder):
            version = status.getPath()
            own = version.toUri().getPath()
            used = any(p == own or p.startswith(own + "/") for p in published)
            if version.getName().startswith("v") and not used:
                files.delete(version, True)
                removed.append(version.getName())
        return sorted(removed)

    def drop(self) -> None:
        """Remove the catalog entries; the files stay."""
        for layer in LAYERS:
            self.spark.sql(f"DROP DATABASE IF EXISTS `{self.prefix}{layer}` CASCADE")

    def export(self, table: str, path: str, frame: DataFrame | None = None) -> str:
        """A Parquet copy of a table, or of ``frame`` out of it, outside the warehouse; replaces ``path``."""
        if f"{path.rstrip('/')}/".startswith(f"{self.root}/"):
            raise ValueError(f"{path} is inside the warehouse at {self.root}")
        (self.table(table) if frame is None else frame).write.mode("overwrite").parquet(path)
        return path
