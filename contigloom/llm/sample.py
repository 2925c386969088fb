"""A bounded sample that is the same on every run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_by_hash(rows: DataFrame, on: str, n: int) -> DataFrame:
    """At most ``n`` rows: the first by a hash of column ``on``, one for each of its values.

    Rows whose hash is sure to be too great are dropped where they are, so about ``2 * n`` values meet, whatever the input.
    """
    columns = rows.columns
    hashed = rows.withColumn("hash_", F.xxhash64(on))
    values = hashed.agg(F.approx_count_distinct("hash_")).first()[0]
    if values > 4 * n:
        hashed = hashed.filter(F.col("hash_") < int(2 ** 64 * (2 * n / values)) - 2 ** 63)
    one = hashed.groupBy("hash_").agg(F.first(F.struct(*columns)).alias("row_"))
    return one.orderBy("hash_").limit(n).select("row_.*")
