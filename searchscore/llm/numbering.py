"""Numbering rows inside groups without bringing a group into one task.

Rows are dealt by ranges of (group, order), so a hot group is spread over many
partitions; each partition numbers its runs, and a run that goes on from the
partition before is moved up by the rows the group has had there. At most the
first run of a partition can go on, so that table has one row a partition.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from searchscore.session import cut_lineage


def numbered(rows: DataFrame, group: str, order: list[Column], place: str) -> DataFrame:
    """``rows`` with a column ``place``: 0, 1, ... inside each ``group`` by ``order``.

    ``group`` must not be null. Rows equal in ``order`` may go to different ranges
    (their place in the input decides), so many equal rows do not meet in one task.
    ``rows`` should read a table or a checkpoint; the result is checkpointed."""
    spark = rows.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(group), *order, F.col("_tie")]
    dealt = rows.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(n, *keys).sortWithinPartitions(*keys).drop("_tie")

    def number(batches):
        part, last, had = TaskContext.get().partitionId(), None, 0
        for b in batches:
            if not b.num_rows:
                continue
            k = b.column(b.schema.get_field_index(group)).to_numpy(zero_copy_only=False)
            at = np.arange(len(k), dtype=np.int64)
            starts = np.concatenate(([True], k[1:] != k[:-1]))
            rank = at - np.maximum.accumulate(np.where(starts, at, 0))
            if last is not None and k[0] == last:
                rank[:int(starts[1:].argmax()) + 1 if starts[1:].any() else len(k)] += had
            last, had = k[-1], int(rank[-1]) + 1
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.full(len(k), part, np.int32)), pa.array(rank)],
                                             names=[*b.schema.names, "_part", "_rank"])

    schema = T.StructType([*dealt.schema.fields, T.StructField("_part", T.IntegerType()), T.StructField("_rank", T.LongType())])
    ranked = cut_lineage(dealt.mapInArrow(number, schema))
    counts = ranked.groupBy("_part", group).agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    later = counts.withColumn("_start", before).where("_start > 0").select("_part", F.col(group).alias("_group"), "_start")
    # at most one row a partition, see above
    out = ranked.alias("r").join(F.broadcast(later).alias("s"), (F.col("r._part") == F.col("s._part")) & (F.col(f"r.{group}") == F.col("_group")), "left")
    return out.select(*[F.col(f"r.{c}") for c in rows.columns], (F.col("_rank") + F.coalesce("_start", F.lit(0))).alias(place))
