"""JSON decode / encode of item records (JVM-side ``from_json`` / ``to_json``).

Decode follows the reference's default JSON mapper as far as Spark allows
(SURVEY §2.10): numbers are parsed from their text so that a quoted
``"5"`` still counts, fractions truncate toward zero, an absent or null
quantity is 0, and a record is *corrupt* when it is null, not a JSON
object, has a field the record does not declare (names are
case-sensitive), an object or array where a text field is expected, or
a number field that is not a number in range (or a quoted fraction
where an integer is expected).

Policies: ``strict`` raises on the first corrupt record (the reference
stops); ``permissive`` splits corrupt records into a quarantine frame.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skuflow.schema import INVENTORY_FIELDS, TRANSACTION_FIELDS

INT_MIN, INT_MAX = -(2**31), 2**31 - 1
_CORRUPT = "_corrupt"


@dataclass(frozen=True)
class RecordSpec:
    """What a JSON record may hold: its declared fields (anything else is
    an unknown field), its integral fields ``(name, lo, hi, type)`` and its
    floating fields, in the order their checks run."""

    label: str
    fields: tuple[str, ...]
    integral: tuple[tuple[str, int | None, int | None, str], ...]
    floating: tuple[str, ...] = ()

    @property
    def texts(self) -> tuple[str, ...]:
        numbers = {name for name, *_ in self.integral} | set(self.floating)
        return tuple(f for f in self.fields if f not in numbers)

    @property
    def parse_schema(self) -> T.StructType:
        return T.StructType(
            [T.StructField(f, T.StringType(), True) for f in self.fields]
            + [T.StructField(_CORRUPT, T.StringType(), True)]
        )


TRANSACTION_SPEC = RecordSpec(
    "item transaction",
    TRANSACTION_FIELDS,
    (("quantity", INT_MIN, INT_MAX, "int"), ("id", None, None, "long")),
    ("price",),
)
INVENTORY_SPEC = RecordSpec("inventory", INVENTORY_FIELDS, (("currentStock", None, None, "long"),))


# a JSON number: no literal suffix, no hex, no NaN
_NUMBER = r"^-?[0-9]+(\.[0-9]+)?([eE][+-]?[0-9]+)?$"


def _num(text: Column) -> Column:
    return F.when(F.trim(text).rlike(_NUMBER), text.try_cast("double"))


def _integral(text: Column, lo: int | None, hi: int | None, target: str) -> tuple[Column, Column]:
    """(value, is_bad) for an integral field given its JSON text.

    Fractions truncate toward zero; anything that is no number or does not fit a long is bad.
    The JSON parser reads a number with a fraction or exponent as a double, so one beyond
    2^53 may have been altered already: it is bad too.
    """
    t = F.trim(text)
    exact = t.try_cast("decimal(38,9)")
    trunc = F.when(exact >= 0, F.floor(exact)).otherwise(F.ceil(exact)).try_cast("long")
    value = (F.when(t.rlike(r"^-?[0-9]+$"), t.try_cast("long"))
             .when(t.rlike(_NUMBER) & (F.abs(exact) < F.lit(1 << 53)), trunc))
    bad = text.isNotNull() & value.isNull()
    if lo is not None:
        bad = bad | (value < F.lit(lo)) | (value > F.lit(hi))
    return F.when(~bad, value.cast(target)), bad


def _kind(value: Column, name: str) -> Column:
    """JSON type of a field, by a VARIANT of the record. It stands behind a test of the field's
    text, so only records whose text could be of either type are parsed for it."""
    field = F.try_variant_get(F.try_parse_json(value), f"$.{name}", "variant")
    return F.schema_of_variant(field)


def _parse(envelope: DataFrame, spec: RecordSpec = TRANSACTION_SPEC) -> DataFrame:
    """Envelope + ``__j`` (parsed struct), ``__keys``, ``__reason`` (null when
    valid) and ``__<field>`` typed values of the numeric fields."""
    v = F.col("value").cast("string")
    parsed = F.from_json(
        v, spec.parse_schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT, "allowSingleQuotes": "false"}
    )
    # Parse once per record behind a Generate: a filter on the decode result
    # cannot be pushed below it, so Catalyst never inlines (and re-runs) the
    # JSON parse into every predicate and field that reads it.
    once = envelope.select(
        "*", F.inline(F.array(F.struct(parsed.alias("__j"), F.json_object_keys(v).alias("__keys"))))
    )
    known = F.array(*[F.lit(f) for f in spec.fields])
    j = F.col("__j")
    reason = (
        F.when(v.isNull(), F.lit("null value"))
        .when(j.isNull() | j[_CORRUPT].isNotNull() | F.col("__keys").isNull(), F.lit("not a JSON object"))
        .when(F.size(F.array_except(F.col("__keys"), known)) > 0, F.lit("unknown field"))
    )
    values = {}
    for name, lo, hi, target in spec.integral:
        value, bad = _integral(j[name], lo, hi, target)
        reason = reason.when(bad, F.lit(f"bad {name}"))
        # a quoted number is read as an integer only if it is written as one
        quoted = ~F.trim(j[name]).rlike(r"^[-+]?[0-9]+$") & (_kind(v, name) == "STRING")
        reason = reason.when(quoted, F.lit(f"bad {name}"))
        values[name] = value
    for name in spec.texts:
        nested = j[name].rlike(r"^[\[{]") & _kind(v, name).rlike("^(OBJECT|ARRAY)")
        reason = reason.when(nested, F.lit(f"bad {name}"))
    for name in spec.floating:
        value = _num(j[name])
        reason = reason.when(j[name].isNotNull() & value.isNull(), F.lit(f"bad {name}"))
        values[name] = value
    out = once.withColumn("__reason", reason)
    for name, value in values.items():
        out = out.withColumn(f"__{name}", value)
    return out


def _decoded(df: DataFrame, keep: tuple[str, ...]) -> DataFrame:
    j = F.col("__j")
    return df.select(
        *keep,
        F.col("__id").alias("id"),
        j["storeName"].alias("storeName"),
        j["sku"].alias("sku"),
        # a primitive int: absent and null both read as 0
        F.coalesce(F.col("__quantity"), F.lit(0)).alias("quantity"),
        j["type"].alias("type"),
        F.col("__price").alias("price"),
        j["timestamp"].alias("timestamp"),
    )


ENVELOPE_KEEP = ("topic", "partition", "offset")


def _apply_policy(p: DataFrame, policy: str, label: str) -> DataFrame:
    if policy == "strict":
        ok = F.when(
            F.col("__reason").isNotNull(),
            F.raise_error(F.concat(F.lit(f"corrupt {label}: "), F.col("__reason"))),
        ).otherwise(F.lit(True))
        # the check sits in a filter, so column pruning can never drop it
        return p.where(ok.cast("boolean"))
    if policy != "permissive":
        raise ValueError(f"unknown policy {policy!r}")
    return p.where(F.col("__reason").isNull())


def decode_transactions(
    envelope: DataFrame, policy: str = "permissive", keep: tuple[str, ...] = ENVELOPE_KEEP
) -> DataFrame:
    """Valid transactions from an envelope with a ``value`` column.

    ``keep`` envelope columns are carried through (for ordering / tracing).
    ``strict``: the query fails on a corrupt record. ``permissive``: corrupt
    records are skipped — read them with :func:`quarantine_transactions`.
    """
    keep = tuple(c for c in keep if c in envelope.columns)
    return _decoded(_apply_policy(_parse(envelope, TRANSACTION_SPEC), policy, TRANSACTION_SPEC.label), keep)


def quarantine_transactions(envelope: DataFrame) -> DataFrame:
    """Corrupt records with the first reason found: envelope columns + ``reason``."""
    return _quarantine(envelope, TRANSACTION_SPEC)


def _quarantine(envelope: DataFrame, spec: RecordSpec) -> DataFrame:
    return _parse(envelope, spec).where(F.col("__reason").isNotNull()).select(
        *envelope.columns, F.col("__reason").alias("reason")
    )


def decode_inventory(
    envelope: DataFrame, policy: str = "permissive", keep: tuple[str, ...] = ENVELOPE_KEEP
) -> DataFrame:
    """Inventory changes (the output topic) back to ``itemID, currentStock``.

    ``currentStock`` is a boxed long defaulting to 0: an absent field reads
    as 0, an explicit JSON null stays null.
    """
    keep = tuple(c for c in keep if c in envelope.columns)
    p = _apply_policy(_parse(envelope, INVENTORY_SPEC), policy, INVENTORY_SPEC.label)
    stock = F.when(F.array_contains(F.col("__keys"), "currentStock"), F.col("__currentStock")).otherwise(
        F.lit(0).cast("long")
    )
    return p.select(*keep, F.col("__j")["itemID"].alias("itemID"), stock.alias("currentStock"))


def quarantine_inventory(envelope: DataFrame) -> DataFrame:
    """Corrupt inventory records with the first reason found."""
    return _quarantine(envelope, INVENTORY_SPEC)


def encode_transactions(tx: DataFrame, key: str = "storeName") -> DataFrame:
    """Keyed JSON publish: ``key`` = text of the key field, ``value`` = the record.

    Null fields are omitted, like a producer sending only the keys it has.
    """
    fields = [c for c in TRANSACTION_FIELDS if c in tx.columns]
    return tx.select(
        F.col(key).cast("string").alias("key"),
        F.to_json(F.struct(*fields)).alias("value"),
    )


def encode_records(records: DataFrame, key: str, columns: tuple[str, ...] | None = None) -> DataFrame:
    """Keyed JSON publish of any record: ``key`` = text of the key field, ``value`` = all its columns
    (or ``columns``), nested ones too; null fields are omitted."""
    fields = [F.col(f"`{c}`") for c in (columns or records.columns)]
    return records.select(F.col(f"`{key}`").cast("string").alias("key"), F.to_json(F.struct(*fields)).alias("value"))


def encode_inventory(stock: DataFrame) -> DataFrame:
    """Inventory change as a keyed message: key = itemID, value = JSON with nulls written."""
    return stock.select(
        F.col("itemID").alias("key"),
        F.to_json(F.struct("itemID", "currentStock"), {"ignoreNullFields": "false"}).alias("value"),
    )
