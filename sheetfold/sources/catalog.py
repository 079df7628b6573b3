"""Named exports: find a table by name in a folder, create it if it is missing, replace it if it is there.

A folder is a database of the session's catalog and an export a table of it, so "find by name" is a
catalog lookup and not a guess at a path. Titles may hold anything; catalog names are made from
them, and the title itself is kept as a table property.
"""

from __future__ import annotations

import hashlib
import re
import uuid

from pyspark.sql import DataFrame, SparkSession

from sheetfold.sources.sinks import dates_to_text, stage

TITLE = "sheetfold.title"


def catalog_name(title: str) -> str:
    """A catalog identifier for a title: its letters and digits, and a digest that keeps unlike titles apart."""
    plain = re.sub(r"[^a-z0-9]+", "_", title.lower()).strip("_")[:40]
    return f"{plain or 'x'}_{hashlib.sha256(title.encode()).hexdigest()[:12]}"


class Folder:
    """One export folder: the tables of a database. ``location``: where their files lie, a place that
    all executors write to; needed when the folder is made."""

    def __init__(self, spark: SparkSession, title: str, location: str | None = None):
        self.spark, self.title, self.database = spark, title, catalog_name(title)
        if not spark.catalog.databaseExists(self.database):
            at = f" LOCATION '{location}'" if location else ""
            spark.sql(f"CREATE DATABASE IF NOT EXISTS `{self.database}`{at} WITH DBPROPERTIES ('{TITLE}' = {_text(title)})")
        self.location = spark.catalog.getDatabase(self.database).locationUri

    def identifier(self, name: str) -> str:
        return f"`{self.database}`.`{catalog_name(name)}`"

    def find(self, name: str) -> DataFrame | None:
        """The export called ``name``, or None."""
        if not self.spark.catalog.tableExists(f"{self.database}.{catalog_name(name)}"):
            return None
        return self.spark.table(self.identifier(name))

    def names(self) -> list[str]:
        """Titles of the folder's exports."""
        tables = self.spark.catalog.listTables(self.database)
        return sorted(self._property(f"`{self.database}`.`{t.name}`") for t in tables if not t.isTemporary)

    def _property(self, identifier: str) -> str:
        return self.spark.sql(f"SHOW TBLPROPERTIES {identifier} ('{TITLE}')").first()["value"]

    def _version(self, identifier: str) -> str:
        rows = self.spark.sql(f"DESCRIBE TABLE EXTENDED {identifier}").where("col_name = 'Location'")
        return rows.first()["data_type"]

    def save(self, df: DataFrame, name: str, skip_empty: bool = True) -> tuple[str, int]:
        """``df`` as the export ``name``: ``("created" | "replaced" | "skipped", rows)``.

        Every save writes a version of its own and compares its rows with those observed; then the
        table points to it, one change of the catalog if the columns stayed as they were. Until then
        readers have the version before. An empty ``df`` is skipped and the table left as it is.
        """
        spark, identifier = self.spark, self.identifier(name)
        version = f"{self.location}/{catalog_name(name)}/version-{uuid.uuid4().hex}"
        out = dates_to_text(df)
        rows = stage(out, version, "parquet")
        if not rows and skip_empty:
            _delete(spark, version)
            return "skipped", 0
        found = self.find(name)
        create = f"CREATE TABLE {identifier} USING parquet LOCATION '{version}' TBLPROPERTIES ('{TITLE}' = {_text(name)})"
        if found is None:
            spark.sql(create)
            return "created", rows
        before = self._version(identifier)
        if found.schema.simpleString() == out.schema.simpleString():
            spark.sql(f"ALTER TABLE {identifier} SET LOCATION '{version}'")
        else:
            spark.sql(f"DROP TABLE {identifier}")      # the files of a table with a location stay
            spark.sql(create)
        spark.catalog.refreshTable(identifier)
        _delete(spark, before)
        return "replaced", rows


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
