"""Tables: scans, literal rows, managed tables with comments, and their description as text."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def scan(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def literal_rows(spark: SparkSession, rows: Iterable[Mapping], schema: T.StructType) -> DataFrame:
    """A few literal records with an explicit schema (inference would sort the columns by name)."""
    return spark.createDataFrame([tuple(r.get(f.name) for f in schema.fields) for r in rows], schema)


def ensure_namespace(spark: SparkSession, namespace: str, location: str | None = None) -> None:
    """Create the schema if it is missing, in the warehouse or at the given location."""
    at = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {namespace}{at}")


def overwrite_table(df: DataFrame, table: str) -> None:
    """Replace a managed table, schema included."""
    df.write.mode("overwrite").option("overwriteSchema", "true").saveAsTable(table)


def comment_table(spark: SparkSession, table: str, comment: str, columns: Mapping[str, str] | None = None) -> None:
    def quoted(text: str) -> str:
        return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"

    spark.sql(f"COMMENT ON TABLE {table} IS {quoted(comment)}")
    for column, text in (columns or {}).items():
        spark.sql(f"ALTER TABLE {table} ALTER COLUMN `{column}` COMMENT {quoted(text)}")


def listed_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column_name, listed)``: all values of the columns that the caller declares as enumerations.

    Values are distinct before they meet, so a list is as long as its enumeration, whatever the number of rows.
    """
    pairs = F.explode(
        F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("v")) for c in columns])
    )
    distinct = df.select(pairs.alias("p")).select("p.*").where(F.col("v").isNotNull()).distinct()
    gathered = distinct.groupBy("column_name").agg(F.array_sort(F.collect_list("v")).alias("vs"))
    return gathered.select("column_name", F.array_join("vs", " | ").alias("listed"))


def schema_context(spark: SparkSession, tables: Mapping[str, Sequence[str]]) -> DataFrame:
    """``(table_name, context)``: name, description and columns with types, comments and listed values.

    ``tables`` maps each catalog table to its enumerations, the columns whose values are listed.
    """
    lines = []
    values: DataFrame | None = None
    for table, enumerated in tables.items():
        description = spark.catalog.getTable(table).description or ""
        for position, column in enumerate(spark.catalog.listColumns(table)):
            lines.append((table, description, position, column.name, column.dataType, column.description or ""))
        if enumerated:
            found = listed_values(spark.table(table), enumerated).withColumn("table_name", F.lit(table))
            values = found if values is None else values.unionByName(found)
    catalog = spark.createDataFrame(
        lines, "table_name string, description string, position int, column_name string, type string, note string"
    )
    if values is None:
        catalog = catalog.withColumn("listed", F.lit(None).cast("string"))
    else:
        catalog = catalog.join(values, ["table_name", "column_name"], "left")
    about = F.array_join(
        F.filter(
            F.array(F.nullif("note", F.lit("")), F.col("listed")),
            lambda x: x.isNotNull(),
        ),
        ": ",
    )
    entry = F.concat(
        F.col("column_name"), F.lit(" ("), F.col("type"), F.when(about != "", F.concat(F.lit(", "), about)).otherwise(F.lit("")), F.lit(")")
    )
    # A few hundred catalog rows at most: columns of the named tables.
    return (
        catalog.groupBy("table_name", "description")
        .agg(F.array_sort(F.collect_list(F.struct("position", entry.alias("entry")))).alias("cols"))
        .select(
            "table_name",
            F.concat(
                F.lit("Table: "), F.col("table_name"),
                F.lit("\n  Description: "), F.col("description"),
                F.lit("\n  Columns: "), F.array_join(F.col("cols.entry"), ", "),
            ).alias("context"),
        )
    )


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``(table_name, n)``; Parquet answers a bare count from its footers."""
    counted = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(t).alias("table_name"), "n") for t, df in tables.items()]
    out = counted[0]
    for other in counted[1:]:
        out = out.unionByName(other)
    return out
