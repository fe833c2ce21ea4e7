"""What the operators share: reading tables, words, row locators and the shared folder."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tariffa.session import prepare
from tariffa.sources.sinks import stored

# A word is a run of anything but these six bytes; Python's ``bytes.split()`` cuts at the same ones.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    # long texts: small batches between the JVM and Python
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(key: str | Column, folds: int) -> Column:
    """crc32 of a key as text, modulo ``folds``; a null key counts as empty text."""
    column = F.col(key) if isinstance(key, str) else key
    return F.crc32(F.coalesce(column.cast("string"), F.lit(""))) % folds


def _place(df: DataFrame) -> tuple[Column, Column]:
    # the hidden column itself, even where the table has a column of that name
    place = df.metadataColumn("_metadata")
    return place["file_path"].alias("_file"), place["row_index"].alias("_row")


def on_files(df: DataFrame) -> DataFrame:
    """The table itself if its rows lie in files, else a copy written to the shared folder."""
    try:
        df.select(*_place(df))
    except AnalysisException:
        return stored(df, "located")
    return df


def with_locator(df: DataFrame, *columns: str | Column) -> DataFrame:
    """The given columns with ``_file`` and ``_row``: where each row lies, the same in every scan of one table on files."""
    df = on_files(df)
    return df.select(*columns, *_place(df))


def numbered_columns(df: DataFrame) -> list[Column]:
    """All columns under names (c0, c1, ...) that cannot clash with those of an operator."""
    return [F.col(f"`{name}`").alias(f"c{i}") for i, name in enumerate(df.columns)]


def renamed_back(df: DataFrame, columns: list[str]) -> DataFrame:
    """Undoes ``numbered_columns``."""
    return df.select(*[F.col(f"c{i}").alias(name) for i, name in enumerate(columns)])


def without_rows(df: DataFrame, rows: DataFrame) -> DataFrame:
    """The table, which must lie in files, without the rows at the places ``_file`` and ``_row``."""
    kept = with_locator(df, *numbered_columns(df)).join(rows.select("_file", "_row"), ["_file", "_row"], "left_anti")
    return renamed_back(kept, df.columns)


def words_of(text: str | None) -> list[bytes]:
    """Words with A-Z lower-cased and every other character left alone."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def pieces(frames: Iterator[pd.DataFrame], text: str, most: int = 4_000_000) -> Iterator[pd.DataFrame]:
    """Cut incoming batches so that one piece holds about ``most`` characters or one long text."""
    for frame in frames:
        sizes = frame[text].str.len().fillna(0)
        for _, piece in frame.groupby((sizes.cumsum() // most).to_numpy(), sort=False):
            yield piece


def collectable(df: DataFrame, most: int, what: str) -> list:
    """Rows of a table that is small by construction; more than ``most`` of them is an error."""
    rows = df.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"{what}: more than {most} rows")
    return rows
