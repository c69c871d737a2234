"""Helpers shared by the text operators: shared tables, row keys, word rules."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scenecast.session import checkpoint_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
# The white space of the text contracts: [\x20\x09-\x0D].
SPACE_CHARS = " \t\n\x0b\x0c\r"


# The tables that each open scratch block will delete.
_SCRATCH: ContextVar[tuple[list[str], ...]] = ContextVar("scratch", default=())


def stored(df: DataFrame, name: str, outlive: bool = False) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Cuts the lineage without tying the rows to one executor's disk, and lets
    several later branches read the rows instead of computing them again.
    ``outlive``: the table stays when the :func:`scratch` block around the call ends.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    blocks = _SCRATCH.get()[:-1] if outlive else _SCRATCH.get()
    if blocks:
        blocks[-1].append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete at the end the tables that :func:`stored` made inside, or a failed call left.

    No frame that reads them may be used afterwards.
    """
    paths: list[str] = []
    before = _SCRATCH.set((*_SCRATCH.get(), paths))
    try:
        yield
    finally:
        _SCRATCH.reset(before)
        for path in paths:
            _delete(spark, path)


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def drop_stored(df: DataFrame) -> None:
    """Delete the files behind a frame made by :func:`stored`."""
    spark = df.sparkSession
    base = checkpoint_dir(spark).removeprefix("file:").lstrip("/")
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if base in folder:
            _delete(spark, folder)


def require(df: DataFrame, *names: str) -> None:
    """Fail early, by name, when an input column is missing."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; found {df.columns}")


def row_keys(*cols: str) -> list[Column]:
    """Two 64-bit hashes that name a row by its content (nulls told from values)."""
    parts = [F.col(c) for c in cols] + [F.col(c).isNull() for c in cols]
    return [F.xxhash64(*parts).alias("_k1"), F.xxhash64(F.lit("second"), *parts).alias("_k2")]


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it.

    An expression named inside a lambda is computed again for every element; a lambda's
    own argument is not.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def ascii_lower(col: Column) -> Column:
    """Lower-case A-Z only.  ``lower`` does exactly that on text without other letters."""
    return F.when(F.octet_length(col) == F.char_length(col), F.lower(col)).otherwise(
        F.translate(col, UPPER, LOWER))


def words_of(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z lower-cased, as UTF-8."""
    return (text or "").encode().lower().split()


# SQL (DuckDB): CRC-32 of ASCII text, bit by bit (reflected polynomial 0xEDB88320).
CRC32_SQL = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT,
    list_transform(string_split({0}, ''), lambda c: ord(c)::BIGINT)), lambda crc, byte:
    list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, step:
      CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)))"""
