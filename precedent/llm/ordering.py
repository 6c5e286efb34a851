"""Row numbers and running sums per group, without a window over a whole group.

Rows are dealt out by ranges of (group, order), so a group of any size lies in many neighbouring
partitions. A task numbers its sorted rows; the totals of each (partition, group) are a small
table, and its running sums shift every task's numbers to their place in the group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from precedent.llm.common import Tables
from precedent.session import ship_package

#: Column of a stored table that tells apart rows equal in everything else.
TIE = "_tie"


def with_tie(df: DataFrame) -> DataFrame:
    """``df`` with a number per row. It holds still only once the table is stored."""
    return df.withColumn(TIE, F.monotonically_increasing_id())


def group_key(group: Column) -> Column:
    """A non-null key of a text column; null sorts before all texts, these by their UTF-8 bytes."""
    return F.when(group.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), group))


def _number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds partition, row number and running sum of ``_size`` within the partition's group."""
    part = TaskContext.get().partitionId()
    last, rows, total = None, 0, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        codes = batch.column("_group").dictionary_encode()
        ids = codes.indices.to_numpy(zero_copy_only=False)
        size = batch.column("_size").to_numpy(zero_copy_only=False).astype(np.int64)
        begins = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]])
        ends = np.r_[begins[1:], len(ids)]
        row, before = np.empty(len(ids), np.int64), np.empty(len(ids), np.int64)
        for begin, end in zip(begins, ends):
            name = codes.dictionary[int(ids[begin])].as_py()
            if name != last:
                last, rows, total = name, 0, 0
            sums = np.cumsum(size[begin:end])
            row[begin:end] = rows + np.arange(end - begin)
            before[begin:end] = total + sums - size[begin:end]
            rows, total = rows + int(end - begin), total + int(sums[-1])
        columns = [*batch.columns, pa.array(np.full(len(ids), part, np.int64)), pa.array(row), pa.array(before)]
        yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "_part", "_row", "_sum"])


def place_rows(stored: DataFrame, tables: Tables, name: str, group: Column, order: list[Column], size: Column) -> DataFrame:
    """``stored`` with ``_group``, ``_row`` (from 0), ``_sum`` (sizes of earlier rows), ``_rows`` and ``_total`` of its group.

    ``stored`` is a written table with a ``_tie``, and ``group`` a text without nulls. Rows that only the tie tells apart may
    change places between runs, which changes no result made of their columns.
    """
    spark = stored.sparkSession
    ship_package(spark)
    keyed = stored.withColumn("_group", group).withColumn("_size", size.cast("long"))
    by = [F.col("_group").asc(), *order, F.col(TIE).asc()]
    ranged = keyed.repartitionByRange(*by).sortWithinPartitions(*by)
    extra = [StructField(c, LongType()) for c in ("_part", "_row", "_sum")]
    numbered = tables.store(ranged.mapInArrow(_number, StructType(ranged.schema.fields + extra)), f"{name}-rows")
    parts = numbered.groupBy("_group", "_part").agg(
        F.count(F.lit(1)).alias("_n"), F.sum("_size").alias("_s")
    )
    # At most one row per partition and group: a window over one group holds as many rows as there are partitions.
    earlier = Window.partitionBy("_group").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("_group")
    starts = tables.store(
        parts.select(
            "_group",
            "_part",
            F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_rows_before"),
            F.coalesce(F.sum("_s").over(earlier), F.lit(0)).alias("_sum_before"),
            F.sum("_n").over(whole).alias("_rows"),
            F.sum("_s").over(whole).alias("_total"),
        ),
        f"{name}-starts",
    )
    return (
        numbered.join(starts, ["_group", "_part"])
        .withColumn("_row", F.col("_row") + F.col("_rows_before"))
        .withColumn("_sum", F.col("_sum") + F.col("_sum_before"))
        .drop("_part", "_rows_before", "_sum_before", "_size")
    )
