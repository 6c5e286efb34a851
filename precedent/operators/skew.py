"""Equi-joins that stay balanced when a few keys hold most of the rows."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT_KEYS = 1024
SALTS = 64

# What may be sent to every executor, by measured size.
BROADCAST_BYTES = 64 << 20


def text_bytes(df: DataFrame, *columns: str) -> int:
    """Size of some text columns over all rows, plus a little per row."""
    size = F.lit(32)
    for column in columns:
        size = size + F.coalesce(F.octet_length(column), F.lit(0))
    return int(df.agg(F.coalesce(F.sum(size), F.lit(0))).head()[0])


def salted_join(
    rows: DataFrame,
    table: DataFrame,
    key: str,
    salt_by: str,
    how: str = "left",
    counts: DataFrame | None = None,
) -> DataFrame:
    """Join ``rows`` to ``table`` on ``key`` with the hot keys of ``rows`` salted.

    The ``HOT_KEYS`` most frequent keys are spread over ``SALTS`` partitions, with
    one copy of their table rows in each. Only these keys are broadcast, at most
    ``HOT_KEYS`` of them; every other key holds under 1/HOT_KEYS of the rows.
    ``counts`` is ``(key, n)`` where frequencies are known already.
    """
    if counts is None:
        counts = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    # A total order: both sides below have to agree on which keys are hot.
    hot = F.broadcast(
        counts.orderBy(F.desc("n"), key).limit(HOT_KEYS).select(key, F.lit(True).alias("_hot"))
    )
    salt = F.when(F.col("_hot"), F.pmod(F.xxhash64(salt_by), F.lit(SALTS))).otherwise(F.lit(0))
    every_salt = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(
        F.array(F.lit(0))
    )
    left = rows.join(hot, key, "left").withColumn("_salt", salt.cast("int")).drop("_hot")
    right = table.join(hot, key, "left").withColumn("_salt", F.explode(every_salt)).drop("_hot")
    return left.join(right, [key, "_salt"], how).drop("_salt")
