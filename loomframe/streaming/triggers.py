"""Insert triggers as Structured Streaming jobs.

A trigger reacts to each inserted row. The totals and the places taken per key are kept in Spark's
own state store, which a micro-batch reads and writes only for the keys it holds (totals) or their
groups (places); the checkpoint restores it after a failure. Results are appended to a folder, one
part per batch: a batch that runs again overwrites its own part.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

#: Groups of keys that share a state; a stream keeps the number it began with in its checkpoint.
GROUPS = 1_024


def _part(root: str, batch: int) -> str:
    return f"{root}/batch={batch}"


def _run(results: DataFrame, mode: str, root: str, checkpoint: str) -> StreamingQuery:
    def store(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(_part(root, batch_id))

    return (
        results.writeStream.outputMode(mode).foreachBatch(store)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def stored(spark: SparkSession, root: str, schema: T.StructType | str) -> DataFrame:
    """What all batches have written, with the number of the ``batch``."""
    kind = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    return spark.read.schema(T.StructType([*kind.fields, T.StructField("batch", T.LongType())])).parquet(root)


def rollup_batches(
    stream: DataFrame, key: str, amount: Column, root: str, checkpoint: str
) -> StreamingQuery:
    """Keep the total amount per key up to date while rows arrive.

    Each batch writes the new totals of the keys it has touched; :func:`totals` reads the last ones.
    """
    sums = stream.groupBy(key).agg(F.sum(amount).cast("decimal(38,2)").alias("total"))
    return _run(sums, "update", root, checkpoint)


def totals(spark: SparkSession, root: str, key: str, kind: str) -> DataFrame:
    """The total of each key after the last batch; ``kind`` is the type of the key."""
    rows = stored(spark, root, f"`{key}` {kind}, total decimal(38,2)")
    return rows.groupBy(key).agg(F.max_by("total", "batch").alias("total"))


def admission_batches(
    stream: DataFrame,
    capacity: DataFrame,
    key: str,
    limit: str,
    order_by: Sequence[str],
    root: str,
    checkpoint: str,
) -> StreamingQuery:
    """Admit arrivals while there is room, counting those of earlier batches first.

    Writes the arrivals with ``accepted`` 1 or 0. ``capacity`` is a static table with one row per
    key; a NULL limit, or no row for the key, always admits. Keys are dealt out to :data:`GROUPS`
    groups; the state of a group is the number of places taken by each of its keys, and one call
    judges all rows that a batch has for a group. They are put in order together, so a batch is to
    be bounded (``maxFilesPerTrigger``).
    """
    room = capacity.select(F.col(key).alias("__key"), F.col(limit).cast("bigint").alias("__limit"))
    arrivals = stream.join(room, stream[key] == room["__key"], "left").drop("__key")
    # as Spark groups them, 0.0 and -0.0 are one key
    value = stream[key] + F.lit(0.0).cast(stream.schema[key].dataType) if _is_float(stream, key) else stream[key]
    name = F.coalesce(F.concat(F.lit("="), value.cast("string")), F.lit(""))
    named = arrivals.withColumn("__name", name)
    grouped = named.withColumn("__group", F.pmod(F.xxhash64("__name"), F.lit(GROUPS)).cast("int"))
    columns, order = stream.columns, list(order_by)
    schema = T.StructType([*stream.schema.fields, T.StructField("accepted", T.IntegerType())])

    def admit(_: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        taken = dict(zip(*state.get)) if state.exists else {}
        rows = pd.concat(parts).sort_values(order, kind="stable", na_position="first").reset_index(drop=True)
        codes, names = pd.factorize(rows["__name"])
        place = rows.groupby(codes).cumcount().to_numpy()
        first = np.flatnonzero(place == 0)  # names are in the order of their first rows
        limits = rows["__limit"].iloc[first].to_numpy(dtype=float, na_value=np.inf)[codes]
        before = np.array([taken.get(n, 0) for n in names], dtype="int64")
        accepted = (place < limits - before[codes]) | np.isinf(limits)
        after = before + np.bincount(codes, weights=accepted, minlength=len(names)).astype("int64")
        taken.update(zip(names, after.tolist()))
        state.update((list(taken), list(taken.values())))
        yield rows[columns].assign(accepted=accepted.astype("int32"))

    judged = grouped.groupBy("__group").applyInPandasWithState(
        admit, schema, "names array<string>, taken array<long>", "append", GroupStateTimeout.NoTimeout
    )
    return _run(judged, "append", root, checkpoint)


def _is_float(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, (T.DoubleType, T.FloatType))
