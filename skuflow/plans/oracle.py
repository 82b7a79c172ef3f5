"""DuckDB oracle SQL for every registered query with a SQL equivalent.

Tables ``events lineitem part customer ...`` are views over the same
parquet files. The adapters are repeated here in DuckDB dialect
(``json_extract_string`` for ``get_json_object``, ``strftime`` for
``date_format``); DuckDB ``sum(BIGINT)`` is HUGEINT, hence the casts.
"""

from __future__ import annotations

TX_EVENTS = """
    SELECT event_id AS id,
           'Store-' || CAST(user_id AS VARCHAR) AS storeName,
           CASE WHEN json_extract_string(props, '$.k') = '0' THEN NULL
                ELSE 'Item-' || json_extract_string(props, '$.k') END AS sku,
           CAST(floor(value) AS INTEGER) AS quantity,
           CASE event_type WHEN 'purchase' THEN 'SALE' WHEN 'click' THEN 'SALE'
                           WHEN 'signup' THEN 'RESTOCK' WHEN 'error' THEN 'ADJUST'
                           ELSE NULL END AS type,
           value AS price,
           strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS timestamp,
           event_type
    FROM events
"""

TX_LINEITEM = """
    SELECT 'Store-' || CAST(l_suppkey AS VARCHAR) AS storeName,
           'Item-' || CAST(l_partkey AS VARCHAR) AS sku,
           CAST(floor(l_quantity) AS INTEGER) AS quantity,
           CASE l_returnflag WHEN 'A' THEN 'SALE' WHEN 'R' THEN 'RESTOCK' ELSE NULL END AS type,
           l_extendedprice AS price
    FROM lineitem
"""

DELTA = "CASE WHEN type = 'SALE' THEN -CAST(coalesce(quantity, 0) AS BIGINT) ELSE CAST(coalesce(quantity, 0) AS BIGINT) END"

def _stock(src: str) -> str:
    return f"""
        SELECT sku AS itemID, CAST(sum({DELTA}) AS BIGINT) AS currentStock
        FROM ({src}) WHERE sku IS NOT NULL GROUP BY sku
    """


def _store_stock(src: str) -> str:
    return f"""
        SELECT storeName, sku AS itemID, CAST(sum({DELTA}) AS BIGINT) AS currentStock
        FROM ({src}) WHERE sku IS NOT NULL GROUP BY storeName, sku
    """


def _spark_hash(text: str) -> str:
    """Spark's 32-bit hash (Murmur3, seed 42) of an ASCII text, as an unsigned number: whole words
    of four bytes first, then the bytes left over one by one."""
    def mul(x: str, by: int) -> str:
        return f"(({x}) * {by}::UBIGINT) % 4294967296::UBIGINT"

    def turn(x: str, by: int) -> str:
        return f"((({x}) << {by}) % 4294967296::UBIGINT | (({x}) >> {32 - by}))"

    byte = f"ord(substr({text}, CAST({{i}} AS BIGINT), 1))::UBIGINT"
    word = " + ".join(f"{byte.format(i=f'4 * i + {j + 1}')} * {256 ** j}" for j in range(4))
    parts = (f"list_concat([42::UBIGINT], [{word} FOR i IN range(length({text}) // 4)], "
             f"[{byte.format(i='i + 1')} FOR i IN range(length({text}) // 4 * 4, length({text}))])")
    mixed = mul(turn(mul("k", 0xCC9E2D51), 15), 0x1B873593)
    step = f"({turn(f'xor(h, {mixed})', 13)} * 5 + 3864292196::UBIGINT) % 4294967296::UBIGINT"
    h = f"xor(list_reduce({parts}, lambda h, k: {step}), length({text})::UBIGINT)"
    for shift, by in ((16, 0x85EBCA6B), (13, 0xC2B2AE35)):
        h = mul(f"[xor(x, x >> {shift}) FOR x IN [{h}]][1]", by)
    return f"[xor(x, x >> 16) FOR x IN [{h}]][1]"


def _changelog(src: str) -> str:
    return f"""
        SELECT id, sku AS itemID,
               CAST(sum({DELTA}) OVER (PARTITION BY sku ORDER BY id
                    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS currentStock
        FROM ({src}) WHERE sku IS NOT NULL
    """


def _batch(q: dict[str, str]) -> None:
    q["item_stock"] = _stock(TX_LINEITEM)
    q["store_item_stock"] = _store_stock(TX_LINEITEM)
    q["signed_delta"] = f"""
        SELECT id, storeName, sku AS itemID, {DELTA} AS delta FROM ({TX_EVENTS})
    """
    q["seeded_stock"] = f"""
        SELECT itemID, CAST(sum(delta) AS BIGINT) AS currentStock FROM (
            SELECT itemID, currentStock AS delta FROM ({_stock(TX_LINEITEM)})
            UNION ALL
            SELECT sku AS itemID, {DELTA} AS delta FROM ({TX_EVENTS}) WHERE sku IS NOT NULL
        ) GROUP BY itemID
    """
    q["item_changelog"] = _changelog(TX_EVENTS)
    q["store_item_changelog"] = f"""
        SELECT id, storeName, sku AS itemID,
               CAST(sum({DELTA}) OVER (PARTITION BY storeName, sku ORDER BY id
                    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS currentStock
        FROM ({TX_EVENTS}) WHERE sku IS NOT NULL
    """
    q["item_changelog_compacted"] = f"""
        SELECT batch, itemID, id, currentStock FROM (
            SELECT CAST(floor(id / 1000) AS BIGINT) AS batch, sku AS itemID, id,
                   CAST(sum({DELTA}) OVER (PARTITION BY sku ORDER BY id
                        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS currentStock,
                   row_number() OVER (PARTITION BY sku, floor(id / 1000) ORDER BY id DESC) AS rn
            FROM ({TX_EVENTS}) WHERE sku IS NOT NULL
        ) WHERE rn = 1
    """
    q["stock_lookup"] = f"""
        SELECT r.itemID, s.itemID IS NOT NULL AS found, s.currentStock
        FROM (SELECT 'Item-' || CAST(p_partkey AS VARCHAR) AS itemID FROM part) r
        LEFT JOIN ({_stock(TX_EVENTS)}) s ON r.itemID = s.itemID
    """
    q["store_stock_lookup"] = f"""
        SELECT r.storeName, s.storeName IS NOT NULL AS found, s.itemID, s.currentStock
        FROM (SELECT 'Store-' || CAST(c_custkey AS VARCHAR) AS storeName FROM customer) r
        LEFT JOIN ({_store_stock(TX_EVENTS)}) s ON r.storeName = s.storeName
    """


def _json_str(field: str, expr: str) -> str:
    return f"""CASE WHEN {expr} IS NOT NULL THEN '"{field}":"' || {expr} || '"' END"""


def _json_num(field: str, expr: str) -> str:
    return f"""CASE WHEN {expr} IS NOT NULL THEN '"{field}":' || CAST({expr} AS VARCHAR) END"""


TX_JSON = (
    "'{' || concat_ws(',', "
    + ", ".join(
        [
            _json_num("id", "id"),
            _json_str("storeName", "storeName"),
            _json_str("sku", "sku"),
            _json_num("quantity", "quantity"),
            _json_str("type", "type"),
            _json_num("price", "price"),
            _json_str("timestamp", "timestamp"),
        ]
    )
    + ") || '}'"
)

ITEM_MESSAGES = f"""
    SELECT 'items' AS topic, CAST(e.user_id % 3 AS INTEGER) AS partition, t.id AS "offset",
           t.storeName AS key,
           CASE WHEN e.event_type = 'view' THEN e.props ELSE {TX_JSON} END AS value,
           CAST(epoch_us(e.ts) // 1000 AS BIGINT) AS ts_ms,
           t.*
    FROM ({TX_EVENTS}) t JOIN events e ON e.event_id = t.id
"""


def _codec_and_streams(q: dict[str, str]) -> None:
    valid = TX_EVENTS  # streams read the whole table
    q["decode_transactions"] = f"""
        SELECT topic, partition, "offset", id, storeName, sku, quantity, type, price, timestamp
        FROM ({ITEM_MESSAGES}) WHERE event_type <> 'view'
    """
    q["quarantine_transactions"] = f"""
        SELECT topic, partition, "offset", key, value, 'unknown field' AS reason
        FROM ({ITEM_MESSAGES}) WHERE event_type = 'view'
    """
    q["encode_transactions"] = f"SELECT storeName AS key, {TX_JSON} AS value FROM ({TX_EVENTS})"
    q["encode_inventory"] = f"""
        SELECT itemID AS key,
               '{{"itemID":"' || itemID || '","currentStock":' || CAST(currentStock AS VARCHAR) || '}}' AS value
        FROM ({_stock(TX_LINEITEM)})
    """
    q["decode_inventory"] = _stock(TX_LINEITEM)
    q["inventory_trace"] = f"""
        SELECT id, itemID, '{{ itemID: ' || itemID || ' -> ' || CAST(currentStock AS VARCHAR) AS line
        FROM ({_changelog(TX_EVENTS)})
    """
    q["record_trace"] = f'SELECT topic, partition, "offset", key, value FROM ({ITEM_MESSAGES})'
    q["first_event_by_key"] = f"""
        SELECT key, topic, partition, "offset", value FROM ({ITEM_MESSAGES})
        WHERE key IS NOT NULL AND key <> ''
        QUALIFY row_number() OVER (PARTITION BY key ORDER BY partition, "offset") = 1
    """
    q["first_event_by_payload"] = f"""
        SELECT json_extract_string(value, '$.sku') AS match, topic, partition, "offset", key, value
        FROM ({ITEM_MESSAGES})
        WHERE json_extract_string(value, '$.sku') IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY json_extract_string(value, '$.sku')
                                   ORDER BY partition, "offset") = 1
    """
    q["topic_changelog"] = f"""
        SELECT ts_ms, partition, "offset", sku AS itemID,
               CAST(sum({DELTA}) OVER (PARTITION BY sku ORDER BY ts_ms, partition, "offset"
                    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS currentStock
        FROM ({ITEM_MESSAGES}) WHERE sku IS NOT NULL
    """
    q["topic_changelog_compacted"] = f"""
        SELECT batch, itemID, ts_ms, partition, "offset", currentStock FROM (
            SELECT CAST(floor(ts_ms / 30000) AS BIGINT) AS batch, sku AS itemID, ts_ms, partition, "offset",
                   CAST(sum({DELTA}) OVER (PARTITION BY sku ORDER BY ts_ms, partition, "offset"
                        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS currentStock,
                   row_number() OVER (PARTITION BY sku, floor(ts_ms / 30000)
                                      ORDER BY ts_ms DESC, partition DESC, "offset" DESC) AS rn
            FROM ({ITEM_MESSAGES}) WHERE sku IS NOT NULL
        ) WHERE rn = 1
    """
    q["stamp_transactions"] = f"""
        SELECT id, storeName, sku, quantity, type, price, timestamp FROM ({TX_EVENTS})
        UNION ALL
        SELECT NULL AS id, storeName, sku, quantity, type, price, '2024-01-01T00:00:00.000000' AS timestamp
        FROM ({TX_LINEITEM})
    """
    q["store_metadata"] = f"""
        SELECT 'ItemStock' AS storeName, 8 AS numPartitions, count(*) AS numKeys FROM ({_stock(valid)})
    """
    q["item_stock_stream"] = _stock(valid)
    q["item_stock_table"] = _stock(valid)
    # three deliveries of equal offset ranges; what the second and third put into the state
    q["stock_state_changes"] = f"""
        WITH ends AS (SELECT min(event_id) AS lo, (max(event_id) - min(event_id)) // 3 + 1 AS width FROM events),
        t AS (SELECT sku AS itemID, least((id - lo) // width, 2) AS batch_id, {DELTA} AS d FROM ({valid}), ends WHERE sku IS NOT NULL),
        per AS (SELECT itemID, batch_id, sum(d) AS d FROM t GROUP BY ALL)
        SELECT CAST(batch_id AS BIGINT) AS batch_id, itemID, CAST(stock AS BIGINT) AS currentStock
        FROM (SELECT *, sum(d) OVER (PARTITION BY itemID ORDER BY batch_id) AS stock FROM per) WHERE batch_id > 0
    """
    q["partition_holders"] = f"""
        WITH placed AS (SELECT sku, 'items-' || (e.user_id % 3) AS part, {_spark_hash("sku")} % 8 AS holder
                        FROM ({valid}) t JOIN events e ON e.event_id = t.id WHERE sku IS NOT NULL)
        SELECT CAST(holder AS INTEGER) AS holder, string_agg(DISTINCT part, ',' ORDER BY part) AS partitions,
               count(DISTINCT sku) AS numKeys
        FROM placed GROUP BY holder
    """
    q["item_stock_replay"] = _stock(valid)
    q["store_item_stock_stream"] = _store_stock(valid)
    q["store_item_changelog_stream"] = f"""
        SELECT id, storeName, sku AS itemID,
               CAST(sum({DELTA}) OVER (PARTITION BY storeName, sku ORDER BY id
                    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS currentStock
        FROM ({valid}) WHERE sku IS NOT NULL
    """
    q["seeded_stock_stream"] = f"""
        SELECT itemID, CAST(sum(delta) AS BIGINT) AS currentStock FROM (
            SELECT itemID, currentStock AS delta FROM ({_stock(TX_LINEITEM)})
            UNION ALL
            SELECT sku AS itemID, {DELTA} AS delta FROM ({valid}) WHERE sku IS NOT NULL
        ) GROUP BY itemID
    """
    q["item_changelog_stream"] = _changelog(valid)
    q["rescaled_changelog_stream"] = _changelog(valid)
    q["item_changelog_published"] = f"""
        SELECT id, itemID, currentStock, row_number() OVER (PARTITION BY itemID ORDER BY id) AS change_no
        FROM ({_changelog(valid)})
    """
    q["seeded_changelog_stream"] = f"""
        SELECT c.id, c.itemID, CAST(c.currentStock + coalesce(o.currentStock, 0) AS BIGINT) AS currentStock
        FROM ({_changelog(valid)}) c LEFT JOIN ({_stock(TX_LINEITEM)}) o ON c.itemID = o.itemID
    """
    q["stock_point_lookup"] = f"""
        SELECT r.itemID, s.itemID IS NOT NULL AS found, s.currentStock
        FROM (SELECT 'Item-' || CAST(p_partkey AS VARCHAR) AS itemID FROM part) r
        LEFT JOIN ({_stock(valid)}) s ON r.itemID = s.itemID
    """


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    _batch(q)
    _codec_and_streams(q)
    return q
