"""Table naming and reads.

Tables are parquet directories laid out as ``<root>/<catalog>/<schema>/<table>``
and registered under their names, by which jobs and queries read them. The
catalog comes from the session configuration (``CATALOG_NAME``), with a
default, so the same code runs against any environment. Where the session has a
catalog of that name, a table is ``<catalog>.<schema>.<table>`` there; else it is in
the session's own catalog, as ``spark_catalog.<catalog>_<schema>.<table>``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructField, StructType

CATALOG_CONF = "CATALOG_NAME"
DEFAULT_CATALOG = "lake"


def catalog_name(spark: SparkSession, default: str = DEFAULT_CATALOG) -> str:
    v = spark.conf.get(CATALOG_CONF, None)
    return v or default


@dataclass(frozen=True)
class TableNames:
    """``bronze_table('gps_events')`` -> ``<catalog>.bronze.gps_events``
    and its storage path."""

    root: str
    catalog: str

    @classmethod
    def from_session(cls, spark: SparkSession, root: str) -> "TableNames":
        return cls(root.rstrip("/"), catalog_name(spark))

    def name(self, schema: str, table: str) -> str:
        return f"{self.catalog}.{schema}.{table}"

    def spark_name(self, spark: SparkSession, schema: str, table: str) -> str:
        """The name under which Spark knows the table."""
        if spark.conf.get(f"spark.sql.catalog.{self.catalog}", None):
            return f"`{self.catalog}`.`{schema}`.`{table}`"
        return f"spark_catalog.`{self.catalog}_{schema}`.`{table}`"

    def path(self, schema: str, table: str) -> str:
        return f"{self.root}/{self.catalog}/{schema}/{table}"

    def bronze_table(self, table: str) -> str:
        return self.path("bronze", table)

    def silver_table(self, table: str) -> str:
        return self.path("silver", table)

    def gold_table(self, table: str) -> str:
        return self.path("gold", table)


WATERMARK_META = "spark.watermarkDelayMs"
#: Partition of a table that micro-batches write folder by folder; it is no column of the table's data.
BATCH = "_batch"


def _plain_schema(schema: StructType) -> StructType:
    """The stored schema without event-time markers: a table written by one
    query must not carry that query's watermark into the next one."""
    fields = []
    for f in schema.fields:
        if f.name == BATCH:
            continue
        meta = {k: v for k, v in f.metadata.items() if k != WATERMARK_META}
        fields.append(StructField(f.name, f.dataType, f.nullable, meta))
    return StructType(fields)


def read_static(spark: SparkSession, path: str) -> DataFrame:
    """A10: snapshot read of a table (the static side of a stream-static join)."""
    df = spark.read.parquet(path)
    return spark.read.schema(_plain_schema(df.schema)).parquet(path).drop(BATCH)


def read_stream(spark: SparkSession, path: str, schema: StructType | None = None, max_files: int | None = None) -> DataFrame:
    """Rows appended to a table, as a stream. Without a schema the table's
    current schema is used."""
    schema = _plain_schema(schema or spark.read.parquet(path).schema)
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    return reader.parquet(path).drop(BATCH)


def _in_namespace(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {name.rpartition('.')[0]}")


def register(spark: SparkSession, name: str, path: str) -> str:
    """Make the parquet folder ``path`` the table ``name`` (A14). An external table: its data are the folder's, whatever
    becomes of the name."""
    _in_namespace(spark, name)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.catalog.createTable(name, path=path, source="parquet", schema=_plain_schema(spark.read.parquet(path).schema))
    return name


def register_view(spark: SparkSession, name: str, select: str) -> str:
    """Make a query the table ``name``, in place of the view that was it before."""
    _in_namespace(spark, name)
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {select}")
    return name


def static_table(spark: SparkSession, name: str) -> DataFrame:
    """A10 by name: the table as it stands now."""
    spark.catalog.refreshTable(name)
    return spark.table(name).drop(BATCH)


def temp_view(df: DataFrame, name: str) -> DataFrame:
    """Name an intermediate (stream or batch) and read it by that name."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def stream_table(spark: SparkSession, name: str, max_files: int | None = None) -> DataFrame:
    """A9 by name: rows appended to the table, as a stream."""
    reader = spark.readStream
    if max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    return reader.table(name).drop(BATCH)
