"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from promoflow.session import checkpoint_dir

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Rows of one Arrow batch: whole texts of up to some 100 kB each stay within tens of MB.
BATCH_ROWS = 512


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings the Arrow functions rely on: small batches of whole texts."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to a new table in the shared checkpoint folder and read back.

    It cuts the lineage, so nothing before it runs twice and a lost executor costs a reread.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ascii_lower(c: Column) -> Column:
    """A-Z to a-z, every other character as it is; null becomes the empty text."""
    return F.translate(F.coalesce(c, F.lit("")), UPPER, LOWER)


def utf8(texts: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string array; null becomes the empty text."""
    kind = pa.large_binary() if pa.types.is_large_string(texts.type) else pa.binary()
    return [b"" if x is None else x for x in texts.cast(kind).to_pylist()]


def whole_row(df: DataFrame, name: str = "__row") -> DataFrame:
    """All columns packed into one struct, so added columns cannot clash with theirs."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(name))


def sha256_hex(c: Column) -> Column:
    return F.sha2(c.cast("binary"), 256)
