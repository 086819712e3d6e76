"""Repeatable train / test / fold assignment from a row key.

The bucket depends on the key alone, so the split is the same for any file
layout, partition count or retry - unlike a seeded random column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

BUCKETS = 100
TRAIN_BUCKETS = 70


def bucket_of(key: Column) -> Column:
    """Bucket 0..99 from the first four hex digits of the key's MD5."""
    digits = F.substring(F.md5(key.cast("binary")), 1, 4)
    return F.conv(digits, 16, 10).cast("int") % BUCKETS


def with_bucket(df: DataFrame, *key_cols: str) -> DataFrame:
    """Add ``row_key`` (the joined key columns) and its ``bucket``."""
    key = F.concat_ws("|", *[F.col(c).cast("string") for c in key_cols])
    return df.withColumn("row_key", key).withColumn("bucket", bucket_of(F.col("row_key")))


def train_part(df: DataFrame, train_buckets: int = TRAIN_BUCKETS) -> DataFrame:
    return df.where(F.col("bucket") < train_buckets)


def test_part(df: DataFrame, train_buckets: int = TRAIN_BUCKETS) -> DataFrame:
    return df.where(F.col("bucket") >= train_buckets)


def split(df: DataFrame, train_buckets: int = TRAIN_BUCKETS) -> tuple[DataFrame, DataFrame]:
    """70 / 30 split by default."""
    return train_part(df, train_buckets), test_part(df, train_buckets)


def fold_of(folds: int = 10) -> Column:
    """Fold number of a row that has a bucket."""
    return F.col("bucket") % folds
