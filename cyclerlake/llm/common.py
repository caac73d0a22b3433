"""Pieces that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cyclerlake.session import landed

__all__ = ["SPACE", "WORD", "landed", "table", "whole_text", "word_count"]

# white space and words, in bytes below 128 alone
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def whole_text(text: str) -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(text).cast("string"), F.lit(""))


def word_count(text: str) -> Column:
    return F.regexp_count(whole_text(text), F.lit(WORD)).cast("long")
