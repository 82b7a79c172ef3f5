"""Stock changelogs: the new total of a key after each transaction.

The reference emits, per transaction, the new running total of its SKU.
As a batch query that is a running sum per key in transaction order. A
plain ``Window.partitionBy(key).orderBy(order)`` puts every row of a key
into one task, so a key holding a third of all rows would run in a single
task. Instead the order axis is cut into fixed-width blocks:

1. per (key, block): block total — partial aggregate, map-side combined;
2. per (key, block): offset = sum of the key's earlier block totals — a
   window over the small totals table (one row per key and block);
3. per row: offset + running sum inside its (key, block) — a window whose
   partitions hold at most ``block_width`` rows when the order column is a
   unique integer (ids, offsets), so a hot key spreads over many tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skuflow.config import scratch_path
from skuflow.operators.stock import signed_delta

# Rows per (key, block) window partition, at most, for a unique integer order.
DEFAULT_BLOCK_WIDTH = 1 << 20
# Width, in order units, of one emission batch of the compacted changelog
# (the batch analogue of one micro-batch of ``maxOffsetsPerTrigger`` records).
DEFAULT_BATCH_WIDTH = 1000
# Block of rows whose order value is null: sorts before every real block.
NULL_ORDER_BLOCK = -(2**63)


def floor_div(order: str, width: int):
    """Exact integer floor(order / width) in LONG arithmetic (no double rounding)."""
    return F.expr(f"(`{order}` - pmod(`{order}`, {int(width)})) div {int(width)}").cast("long")


def _order_cols(order: str | Sequence[str]) -> list[str]:
    return [order] if isinstance(order, str) else list(order)


def running_sum(
    df: DataFrame,
    keys: Sequence[str],
    order: str | Sequence[str],
    value: str,
    out: str,
    block_width: int = DEFAULT_BLOCK_WIDTH,
) -> DataFrame:
    """Skew-safe ``sum(value) over (partition by keys order by order rows unbounded preceding)``.

    ``order`` is one column or several (e.g. Kafka's ``timestamp, partition,
    offset``); blocks are cut on the first, which must be integral, so they
    stay contiguous in the lexicographic order of all of them. Ties in the
    full order are summed in an arbitrary order, as with the plain window.
    Null keys form their own group and null order values come first (NULLS
    FIRST), as with the plain window; no row is ever dropped.

    ``df`` is evaluated twice (block totals, then rows), which for a parquet
    scan is two column-pruned reads. When ``df`` is expensive to produce
    (e.g. JSON decoded from a topic), persist it or write it to a table
    under ``spark.checkpoint.dir`` first; the streaming changelog caches
    each micro-batch for this reason.
    """
    keys = list(keys)
    order = _order_cols(order)
    kk, blk = "__kk", "__block"
    # Keys travel as one struct: struct equality matches null fields, so the
    # join keeps null-key rows, and the join and the window share one
    # hash partitioning on (__kk, __block) — the big side is shuffled once.
    with_block = df.withColumn(kk, F.struct(*keys)).withColumn(
        blk, F.coalesce(floor_div(order[0], block_width), F.lit(NULL_ORDER_BLOCK).cast("long"))
    )
    totals = with_block.groupBy(kk, blk).agg(F.sum(value).alias("__block_total"))
    before = Window.partitionBy(kk).orderBy(blk).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        kk,
        blk,
        F.coalesce(F.sum("__block_total").over(before), F.lit(0)).cast("long").alias("__offset"),
    )
    inside = Window.partitionBy(kk, blk).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    joined = with_block.join(offsets, on=[kk, blk], how="inner")
    return joined.withColumn(out, (F.col("__offset") + F.sum(value).over(inside)).cast("long")).drop(
        kk, blk, "__offset"
    )


def _local_sums(n_keys: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Running sums along a sorted partition: of the last column, within equal values of the first ``n_keys``."""
    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at = TaskContext.get().partitionId(), 0
        last: tuple | None = None
        carried, first = 0, True
        for b in batches:
            n = b.num_rows
            if not n:
                continue
            # a null value adds nothing
            value = pc.fill_null(b.column(b.num_columns - 1), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            new = np.zeros(n, bool)
            for c in b.columns[:n_keys]:
                code = pc.fill_null(pc.dictionary_encode(c, null_encoding="encode").indices, -1).to_numpy()
                new[1:] |= code[1:] != code[:-1]
            head = tuple(c[0].as_py() for c in b.columns[:n_keys])
            if head != last:
                first, carried = last is None, 0
            start = np.flatnonzero(np.append(True, new[1:]))
            total = np.cumsum(value)
            before = total[start] - value[start]
            before[0] -= carried
            run = total - np.repeat(before, np.diff(np.append(start, n)))
            _checked(value, run)
            # the partition's first key may go on from the partition before
            mine = np.repeat(np.append(first, np.zeros(len(start) - 1, bool)), np.diff(np.append(start, n)))
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(run), pa.array(np.full(n, part, np.int32)), pa.array(np.arange(at, at + n)), pa.array(mine)],
                [*b.schema.names, "__run", "__part", "__at", "__first"])
            at += n
            last = tuple(c[n - 1].as_py() for c in b.columns[:n_keys])
            carried, first = int(run[-1]), first and len(start) == 1

    return summed


def _checked(value: np.ndarray, run: np.ndarray) -> None:
    """Fail, as ANSI mode does, where a running sum leaves the long range (sums here wrap)."""
    if ((((run - value) ^ run) & (value ^ run)) < 0).any():
        raise ArithmeticError("ARITHMETIC_OVERFLOW: a running sum does not fit a long")


def ordered_running_sum(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, out: str,
                        partitions: int | None = None) -> DataFrame:
    """:func:`running_sum` as a prefix scan, for orders that cannot be cut into even blocks.

    1. the rows are range-partitioned by (keys, order) and sorted, so partitions are of
       like size whatever the order's values are, and a hot key spans several;
    2. each partition sums its own rows along the keys and is written once;
    3. only a partition's first key may go on from earlier ones, so what came before it is
       one number a partition, from the partitions' last keys and sums; it is broadcast.

    Rows that are equal in every column stay in one partition; all others are told apart,
    also where the whole order is null (nulls come first). No row is dropped; null keys
    form their own group. ``value`` is a long, a null one adds nothing.
    """
    spark = df.sparkSession
    keys, order = list(keys), list(order)
    rest = [c for c in df.columns if c not in (*keys, value)]
    tie = F.xxhash64(*[F.col(c) for c in df.columns])
    place = [F.col(c).asc_nulls_first() for c in (*keys, *order)] + [tie.asc()]
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    dealt = df.select(*keys, *rest, F.col(value).cast("long").alias(value)).repartitionByRange(n, *place).sortWithinPartitions(*place)
    schema = T.StructType([*dealt.schema.fields, T.StructField("__run", T.LongType()), T.StructField("__part", T.IntegerType()),
                           T.StructField("__at", T.LongType()), T.StructField("__first", T.BooleanType())])
    path = scratch_path(spark, "running-sum")
    dealt.mapInArrow(_local_sums(len(keys)), schema).write.parquet(path)
    scanned = spark.read.schema(schema).parquet(path)
    # one row a partition: its first and last key, and the last key's sum in it
    key = F.struct(*keys)
    ends = scanned.groupBy("__part").agg(F.min_by(key, "__at").alias("__head"), F.max_by(key, "__at").alias("__tail"),
                                         F.max_by("__run", "__at").alias("__sum"))
    in_order = Window.orderBy("__part")
    upto = Window.partitionBy("__tail").orderBy("__part").rowsBetween(Window.unboundedPreceding, 0)
    before = ends.withColumn("__upto", F.sum("__sum").over(upto)).select(
        "__part", F.when(F.lag("__tail").over(in_order).eqNullSafe(F.col("__head")), F.lag("__upto").over(in_order)).alias("__before"))
    total = F.col("__run") + F.when(F.col("__first"), F.coalesce("__before", F.lit(0))).otherwise(F.lit(0))
    # one number a partition: bounded by the number of partitions
    return scanned.join(F.broadcast(before), "__part").select(*df.columns, total.cast("long").alias(out))


def running_stock(
    tx: DataFrame,
    keys: Sequence[str] = ("itemID",),
    order: str | Sequence[str] = "id",
    block_width: int = DEFAULT_BLOCK_WIDTH,
) -> DataFrame:
    """Every change: one row per transaction with the new total of its key."""
    order = _order_cols(order)
    keep = [c for c in ("id", "storeName") if c in tx.columns]
    keep += [c for c in order if c not in keep]
    d = signed_delta(tx, keep=keep).where(F.col("itemID").isNotNull())  # null SKU: dropped (P3)
    if len(order) > 1:
        # values of a composite order repeat, so blocks of them have no row bound
        out = ordered_running_sum(d, keys, order, "delta", "currentStock")
    else:
        out = running_sum(d, keys, order, "delta", "currentStock", block_width)
    return out.select(*[c for c in keep if c not in keys], *keys, "delta", "currentStock")


def item_changelog(
    tx: DataFrame, order: str | Sequence[str] = "id", block_width: int = DEFAULT_BLOCK_WIDTH
) -> DataFrame:
    """``<order columns>, itemID, currentStock`` — the stock of the item after each transaction."""
    return running_stock(tx, ["itemID"], order, block_width).select(*_order_cols(order), "itemID", "currentStock")


def store_item_changelog(
    tx: DataFrame, order: str | Sequence[str] = "id", block_width: int = DEFAULT_BLOCK_WIDTH
) -> DataFrame:
    """``<order columns>, storeName, itemID, currentStock`` — per store and item, after each transaction."""
    return running_stock(tx, ["storeName", "itemID"], order, block_width).select(
        *_order_cols(order), "storeName", "itemID", "currentStock"
    )


def item_changelog_compacted(
    tx: DataFrame,
    order: str | Sequence[str] = "id",
    batch_width: int = DEFAULT_BATCH_WIDTH,
    block_width: int = DEFAULT_BLOCK_WIDTH,
    keys: Sequence[str] = ("itemID",),
    batch: Column | None = None,
) -> DataFrame:
    """Compacted changelog: the last total per key per emission batch.

    The batch is ``floor(order / batch_width)`` on the (first) order column,
    or any ``batch`` expression that never decreases along the order (e.g.
    a record-time interval). Output ``batch, <keys>, <order columns>,
    currentStock``: the order columns are those of the key's last
    transaction in the batch (``keys=("storeName", "itemID")`` gives it per
    store and item). Built from per-(key, batch) totals, so no per-row
    window is needed.
    """
    keys = list(keys)
    order_cols = _order_cols(order)
    keep = order_cols + [k for k in keys if k != "itemID" and k not in order_cols]
    d = signed_delta(tx, keep=keep).where(F.col("itemID").isNotNull())
    b = batch if batch is not None else floor_div(order_cols[0], batch_width)
    if len(order_cols) == 1:
        last = F.max(order_cols[0]).alias(order_cols[0])
    else:
        last = F.max(F.struct(*order_cols)).alias("__last")
    per_batch = d.groupBy(*keys, b.alias("batch")).agg(F.sum("delta").alias("batch_delta"), last)
    if len(order_cols) > 1:
        per_batch = per_batch.select("*", *[F.col(f"__last.{c}").alias(c) for c in order_cols]).drop("__last")
    out = running_sum(per_batch, keys, "batch", "batch_delta", "currentStock", block_width)
    return out.select("batch", *keys, *order_cols, "currentStock")
