"""Names of tables: which database a model goes to, how it is kept, and how it is found again by name."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

# Model groups of installed packages that share one database.
CORE_GROUPS = ("core", "terminology")


@dataclass(frozen=True)
class Databases:
    """Where models go: the default, and the two that models of installed packages are gathered in."""

    default: str = "default"
    core: str = "analytics_core"
    marts: str = "analytics_marts"

    def of(self, wanted: str | None, own: bool = True) -> str:
        """The database of a model that asks for ``wanted``; an ``own`` model gets what it asks for, others by their group."""
        if wanted is None:
            return self.default
        name = wanted.strip()
        if own:
            return name
        return self.core if name in CORE_GROUPS else self.marts


@dataclass
class Catalog:
    """Models by name. A view is computed anew at each use; a table is kept, and its database is made when it is missing."""

    spark: SparkSession
    databases: Databases = field(default_factory=Databases)

    def view(self, name: str, df: DataFrame) -> DataFrame:
        df.createOrReplaceTempView(name)
        return self.spark.table(name)

    def table(self, name: str, df: DataFrame, database: str | None = None, own: bool = True) -> DataFrame:
        at = self.databases.of(database, own)
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{at}`")
        df.write.mode("overwrite").option("compression", "zstd").saveAsTable(f"`{at}`.`{name}`")
        return self.spark.table(f"`{at}`.`{name}`")

    def ref(self, name: str, database: str | None = None, own: bool = True) -> DataFrame:
        """A view of that name if no database is asked for and there is one, else the table."""
        if database is None and self.spark.catalog.tableExists(name):
            return self.spark.table(name)
        return self.spark.table(f"`{self.databases.of(database, own)}`.`{name}`")
