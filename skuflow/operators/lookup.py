"""Keyed lookups: bulk stock lookups and first-record finders."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skuflow.operators.stock import item_stock, store_item_stock


def stock_lookup(stock: DataFrame, requests: DataFrame) -> DataFrame:
    """Answer a table of item IDs: ``itemID, found, currentStock``.

    Missing items give ``found = false`` and a null stock (the reference's
    not-found result). A left join keeps every request; the stock side is
    one row per item, and AQE turns the join into a broadcast hash join at
    run time only when that side's measured size is under the broadcast
    threshold — otherwise both sides are shuffled on ``itemID``.
    """
    s = stock.select("itemID", "currentStock", F.lit(True).alias("__hit"))
    return requests.select("itemID").join(s, "itemID", "left").select(
        "itemID", F.coalesce(F.col("__hit"), F.lit(False)).alias("found"), "currentStock"
    )


def stock_lookup_tx(tx: DataFrame, requests: DataFrame) -> DataFrame:
    """Bulk lookup straight from transactions: ``itemID, found, currentStock``.

    A semi join first keeps the requested SKUs, so only those are summed; AQE
    picks the join from measured sizes.
    """
    wanted = requests.select(F.col("itemID").alias("sku"))
    return stock_lookup(item_stock(tx.join(wanted, "sku", "left_semi")), requests)


def store_stock_lookup_tx(tx: DataFrame, stores: DataFrame) -> DataFrame:
    """Store lookup straight from transactions: only the requested stores are summed."""
    return store_stock_lookup(store_item_stock(tx.join(stores.select("storeName"), "storeName", "left_semi")), stores)


def as_query_result(lookup: DataFrame) -> DataFrame:
    """Nest a lookup into the reference's result shape: ``result`` struct or null."""
    return lookup.select(
        "itemID",
        "found",
        F.when(F.col("found"), F.struct("itemID", "currentStock")).alias("result"),
    )


def store_stock_lookup(store_stock: DataFrame, stores: DataFrame) -> DataFrame:
    """Stock of every item of each requested store.

    ``storeName, found, itemID, currentStock``; an unknown store gives one
    row with ``found = false`` and null item fields.
    """
    wanted = stores.select("storeName")
    # an inner join, so that a hot store splits on either side; the unknown stores beside it
    hits = wanted.join(store_stock, "storeName").select("storeName", F.lit(True).alias("found"), "itemID", "currentStock")
    known = store_stock.select("storeName").distinct()
    misses = wanted.join(known, "storeName", "left_anti").select(
        "storeName", F.lit(False).alias("found"), F.lit(None).cast("string").alias("itemID"),
        F.lit(None).cast("long").alias("currentStock"))
    return hits.unionByName(misses)


# Offsets per partition in a record's place; offsets are 64-bit, so places never overlap.
_PLACES = 2**64


def _place() -> F.Column:
    """(partition, offset) as one number in that order; a null sorts before every value."""
    places = F.lit(str(_PLACES)).cast("decimal(20,0)")
    part = F.coalesce(F.col("partition").cast("decimal(10,0)"), F.lit(-1).cast("decimal(10,0)"))
    return part * places + F.coalesce(F.col("offset").cast("decimal(20,0)"), F.lit(-1).cast("decimal(20,0)"))


# Bits of the map of winning places, and of one of its words: at most 2**18 rows of two longs.
_MAP_BITS, _WORD_BITS = 24, 6


def _bit() -> F.Column:
    return F.xxhash64("__place").bitwiseAND(F.lit((1 << _MAP_BITS) - 1))


def _first(df: DataFrame, match: F.Column, match_name: str) -> DataFrame:
    """The record of the least place for each value of ``match``, payloads of the winners only moved.

    1. the least place per value: one number, so the aggregate hashes and never sees a payload;
    2. a bit map of the winning places, of bounded size, so it is broadcast at any input size;
    3. a second scan drops records whose place is not in it and fetches the winners by place.
       With many values more losers pass the map, which costs time, never results.
    """
    # behind a Generate, so that the filter and the column do not evaluate the match twice
    placed = df.select(F.inline(F.array(F.struct(match.alias("__match"), _place().alias("__place"))))).where(
        F.col("__match").isNotNull())
    least = placed.groupBy("__match").agg(F.min("__place").alias("__place"))
    words = least.select(_bit().alias("__bit")).groupBy(F.shiftright("__bit", _WORD_BITS).alias("__word")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, cast(__bit & {(1 << _WORD_BITS) - 1} as int))")).alias("__bits"))
    records = df.select("topic", "partition", "offset", "key", "value", _place().alias("__place")).withColumn("__bit", _bit())
    near = records.withColumn("__word", F.shiftright("__bit", _WORD_BITS)).join(F.broadcast(words), "__word").where(
        F.expr(f"(shiftrightunsigned(__bits, cast(__bit & {(1 << _WORD_BITS) - 1} as int)) & 1L) = 1L"))
    found = near.join(least, "__place")
    # topics may share a place, so the value decides again, among the few records fetched
    record = F.when(match == F.col("__match"), F.struct("partition", "offset", "topic", "key", "value"))
    first = found.groupBy("__match").agg(F.min(record).alias("__r"))
    return first.select(
        F.col("__match").alias(match_name),
        *[F.col(f"__r.{c}").alias(c) for c in ("topic", "partition", "offset", "key", "value")],
    )


def first_event_by_key(envelope: DataFrame, keys: DataFrame | None = None) -> DataFrame:
    """First record (lowest partition, then offset) for each message key.

    An empty key never matches (the reference refuses it). With ``keys``
    (a one-column ``key`` table) only those keys are answered.
    """
    src = envelope.where(F.col("key") != F.lit(""))
    if keys is not None:
        src = src.join(keys.select("key").distinct(), "key", "left_semi")
    return _first(src, F.col("key"), "match").drop("match").select("key", "topic", "partition", "offset", "value")


def first_event_by_payload(envelope: DataFrame, name: str, path: str = "$.payload") -> DataFrame:
    """First record for each value of JSON field ``<path>.<name>`` of the value.

    The reference's helper looks at ``event["payload"][name]``; item
    messages carry the transaction at the root, so pass ``path="$"``.
    """
    # bracket notation keeps names with dots, spaces or quotes intact
    quoted = name.replace("\\", "\\\\").replace("'", "\\'")
    step = f".{name}" if name.isidentifier() else f"['{quoted}']"
    field = F.get_json_object(F.col("value"), f"{path}{step}")
    return _first(envelope, field, "match")
