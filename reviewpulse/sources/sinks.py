"""Sinks: full overwrite, append-only history, JSON manifest and the section report."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def overwrite(df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None) -> None:
    writer = df.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        # Keep line breaks and outer blanks of review text through a round trip.
        writer = (writer.option("header", True).option("escape", '"').option("quoteAll", True)
                  .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def append_history(df: DataFrame, path: str, columns: list[str]) -> None:
    """Append rows in one fixed column order; columns the frame lacks become null text."""
    fixed = [F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in columns]
    df.select(*fixed).write.mode("append").parquet(path)


def replace_runs(df: DataFrame, path: str, keys: list[str]) -> None:
    """Store rows by run: the runs that ``df`` holds replace what was stored of them, all others stay."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def report_rows(df: DataFrame, section: str, subsection: str, table: str, numbered: DataFrame) -> DataFrame:
    """One report table as (section, subsection, table, row_no, payload).

    The payload is a JSON object of text values: fractions with six decimals, everything else as is.
    ``numbered`` is the table with its ``row_no``.
    """
    def as_text(field):
        col = F.col(field.name)
        if field.dataType.typeName() in ("double", "float"):
            col = col.cast("decimal(30,6)")
        return col.cast("string").alias(field.name)

    payload = F.to_json(F.struct(*[as_text(f) for f in df.schema.fields]), {"ignoreNullFields": "false"})
    return numbered.select(
        F.lit(section).alias("section"), F.lit(subsection).alias("subsection"),
        F.lit(table).alias("table_name"), F.col("row_no").cast("bigint").alias("row_no"),
        payload.alias("payload"),
    )


def report_bundle(parts: list[DataFrame | None]) -> DataFrame:
    """All section tables in one long dataset; a missing table is left out."""
    present = [p for p in parts if p is not None]
    if not present:
        raise ValueError("no section table to bundle")
    return reduce(DataFrame.unionByName, present)
