"""CSV input that keeps malformed rows apart instead of stopping at them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tariffa.sources.schemas import INPUT_SCHEMAS
from tariffa.sources.sinks import stored

CORRUPT = "_corrupt_record"
ROW_SHAPE = "(row shape)"


@dataclass(frozen=True)
class Diverted:
    """``rows`` as the schema has them; ``quarantine`` has table_name, text and the names of the columns that do not fit."""

    rows: DataFrame
    quarantine: DataFrame

    def counts(self) -> DataFrame:
        """Quarantined rows per table and column; a row with two bad columns counts for both."""
        return (
            self.quarantine.select("table_name", F.explode("columns").alias("column_name"))
            .groupBy("table_name", "column_name")
            .agg(F.count(F.lit(1)).alias("row_count"))
        )


def checked_schema(spark: SparkSession, name: str) -> StructType:
    """The schema of an input table with its dates and timestamps as such, so that a bad one is a malformed row."""
    schema = spark.createDataFrame([], INPUT_SCHEMAS[name]).schema
    kinds = {f.name: "timestamp" if f.name.endswith(("_timestamp", "_date", "_at")) else f.dataType.simpleString() for f in schema}
    return spark.createDataFrame([], ", ".join(f"{c} {kind}" for c, kind in kinds.items())).schema


def read_csv_diverting(spark: SparkSession, path: str, name: str, *, header: bool = True) -> Diverted:
    """Read CSV with the fixed schema of table ``name``; malformed rows go to the quarantine with their text.

    A row is malformed if a number or a date cannot be read or if it has too few or too many fields; an empty field is a missing value.  The text is
    parsed once, with all its columns, and written: a scan of fewer columns would not see what is wrong with the others.
    """
    schema = checked_schema(spark, name)
    parsed = stored(
        spark.read.schema(StructType([*schema]).add(CORRUPT, "string"))
        .option("header", str(header).lower())
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .csv(path),
        f"csv-{name}",
    )
    # the few bad rows are taken apart once more, as text, to name their bad columns
    as_text = ", ".join(f"`{f.name}` string" for f in schema)
    fields = F.from_csv(
        F.col(CORRUPT), f"{as_text}, `{CORRUPT}` string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    )
    broken = F.col(f"__f.{CORRUPT}").isNotNull()

    def misread(column: str) -> Column:
        text = F.col(f"__f.{column}")
        return ~broken & text.isNotNull() & F.col(column).isNull()

    reasons = [F.when(broken, F.lit(ROW_SHAPE)), *[F.when(misread(f.name), F.lit(f.name)) for f in schema if f.dataType.typeName() != "string"]]
    quarantine = parsed.filter(F.col(CORRUPT).isNotNull()).withColumn("__f", fields).select(
        F.lit(name).alias("table_name"), F.col(CORRUPT).alias("text"), F.array_compact(F.array(*reasons)).alias("columns")
    )
    return Diverted(parsed.filter(F.col(CORRUPT).isNull()).drop(CORRUPT), quarantine)
