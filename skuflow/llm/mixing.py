"""Mixing sources to target weights: capped water-filling and a seeded sample.

Targets share the corpus size by weight; a source stops at ``max_epochs`` times
its own size and its excess is shared again by weight until no source is above
(water-filling, solved over the sources ordered by the level at which each one
fills up). A source whose target is e epochs then takes floor(e) repetitions of
every document and one more of a seeded share of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skuflow.llm.common import once, written

SPACE = r"[\x20\x09-\x0D]+"
CELLS = 4096
HASH_DIGITS = 15   # hexadecimal digits of a row's hash (60 bits, so a long holds it)


def word_count(text: Column) -> Column:
    return F.size(F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")).cast("long")


def water_fill(sources: DataFrame, total: Column | None = None, max_epochs: float = 3.0) -> DataFrame:
    """``sources`` (source, source_size, weight > 0) with ``target``, one row a source.

    A source of size 0 gets 0. Ties in the fill level share it. The window runs
    over the one-row-a-source table (a mixture's list of sources).
    """
    cap = F.col("source_size") * F.lit(max_epochs)
    s = sources.withColumn("cap", cap).withColumn("level", F.col("cap") / F.col("weight"))
    whole = Window.orderBy("level", F.col("source").asc_nulls_last())
    before = whole.rowsBetween(Window.unboundedPreceding, -1)
    every = whole.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    s = s.select(
        "source", "source_size", "weight", "cap", "level",
        (total if total is not None else F.sum("source_size").over(every)).alias("total"),
        F.coalesce(F.sum("cap").over(before), F.lit(0.0)).alias("filled"),
        (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0))).alias("open"))
    # a source is clamped when the level reached with all before it clamped lies above its own
    s = s.withColumn("reached", (F.col("total") - F.col("filled")) / F.col("open"))
    clamped = F.col("reached") >= F.col("level")
    water = F.max(F.when(~clamped, F.col("reached"))).over(every)
    return s.select("source", "source_size", "weight",
                    F.when(clamped, F.col("cap")).otherwise(water * F.col("weight")).alias("target"))


def source_weights(sizes: DataFrame, weights: list[float] = (5, 2, 1)) -> DataFrame:
    """Sources by code point, null last, weighing ``weights`` in turn."""
    n = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    table = F.array(*[F.lit(w) for w in weights])
    return sizes.withColumn("weight", F.get(table, n % len(weights)))


def _hash(seed: int, *cols: str) -> Column:
    """A row's place in the seeded order, by md5, which SQL engines share."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols])
    return F.conv(F.substring(F.md5(text), 1, HASH_DIGITS), 16, 10).cast("long")


def _measured(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: int, keep: bool) -> DataFrame:
    """doc, source, size, a seeded hash of the row and its two cells; with ``keep`` the whole row as well."""
    row = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")] if keep else []
    return (
        docs.select(F.col(id_col).alias("doc"), F.col(source_col).alias("source"), F.col(text_col).alias("_text"), *row)
        .select("doc", "source", *(["_row"] if keep else []), once(word_count(F.col("_text")), "size"),
                once(_hash(seed, "doc", "_text"), "h"))
        .withColumns({f"c{i}": F.shiftright("h", bit).bitwiseAND(F.lit(CELLS - 1).cast("long")) for i, bit in ((1, 48), (2, 36))}))


def _border(cells: DataFrame, cell: str, quota: str) -> DataFrame:
    """The cell of each source in which the quota runs out."""
    c = cells.withColumn("upto", F.sum("size").over(Window.partitionBy("source").orderBy(cell)))
    return c.where((F.col("upto") >= F.col(quota)) & (F.col("upto") - F.col("size") < F.col(quota)))


def mix_plan(sizes: DataFrame, weights: tuple = (5, 2, 1), max_epochs: float = 3.0) -> DataFrame:
    """One row a source: its target, whole repetitions, and the two hash cells
    (b1, b2) in which the fractional repetition ends with ``left2`` words to go."""
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    filled = water_fill(source_weights(by_source, list(weights)), max_epochs=max_epochs)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    targets = written(
        filled.select(F.col("source").alias("t_source"), "source_size", "target", whole.alias("whole"))
        .withColumn("quota", F.greatest(F.lit(0), F.round("target").cast("long") - F.col("whole") * F.col("source_size"))),
        "mix-targets")
    same = F.col("t_source").eqNullSafe(F.col("source"))
    cells1 = sizes.groupBy("source", "c1").agg(F.sum("size").alias("size")).join(targets, same)
    b1 = written(_border(cells1, "c1", "quota").select(
        F.col("source").alias("s1"), F.col("c1").alias("b1"),
        (F.col("quota") - F.col("upto") + F.col("size")).alias("left1")), "mix-border")
    cells2 = (sizes.join(b1, F.col("s1").eqNullSafe(F.col("source")) & (F.col("c1") == F.col("b1")))
              .groupBy("source", "left1", "c2").agg(F.sum("size").alias("size")))
    b2 = _border(cells2, "c2", "left1").select(
        F.col("source").alias("s2"), F.col("c2").alias("b2"),
        (F.col("left1") - F.col("upto") + F.col("size")).alias("left2"))
    plan = (targets.join(b1, F.col("t_source").eqNullSafe(F.col("s1")), "left")
            .join(b2, F.col("t_source").eqNullSafe(F.col("s2")), "left"))
    return written(plan.select("t_source", "source_size", "target", "whole", "b1", "b2", "left2"), "mix-plan")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple = (5, 2, 1), max_epochs: float = 3.0, seed: int = 17, keep: bool = False) -> DataFrame:
    """One row per input row: size, source_size, target (its source's), repeats, taken.

    ``repeats`` counts whole repetitions. In each source the extra repetition goes
    to rows in seeded hash order until the target's fraction is spent; the one row
    on the border takes only the words still wanted, so a source's taken words
    equal its rounded target. Null texts have size 0 and take nothing. Equal rows
    are interchangeable. The order is found by two levels of hash cells summed
    before any sort, so no task sorts a whole source. An empty table gives none.
    With ``keep`` all input columns come along; of clashing names the new ones stay.
    """
    sizes = written(_measured(docs, id_col, text_col, source_col, seed, keep=False), "mix-sizes")
    plan = mix_plan(sizes, weights, max_epochs)
    rows = (_measured(docs, id_col, text_col, source_col, seed, keep=True) if keep else sizes)
    rows = rows.join(plan, F.col("t_source").eqNullSafe(F.col("source")), "left").drop("t_source")
    on_border = F.coalesce((F.col("c1") == F.col("b1")) & (F.col("c2") == F.col("b2")), F.lit(False))
    below = (F.col("c1") < F.col("b1")) | ((F.col("c1") == F.col("b1")) & (F.col("c2") < F.col("b2")))
    rest = rows.where(~on_border).withColumn("extra", F.when(below, F.col("size")).otherwise(F.lit(0)))
    inside = rows.where(on_border).withColumn("upto", F.sum("size").over(
        Window.partitionBy("source").orderBy("h", F.col("doc").asc_nulls_last(), "size")
        .rowsBetween(Window.unboundedPreceding, 0)))
    inside = inside.withColumn("extra", F.greatest(F.lit(0), F.least(
        F.col("size"), F.col("left2") - F.col("upto") + F.col("size"))))
    full = (F.col("extra") == F.col("size")) & (F.col("size") > 0)
    new = {"size": F.col("size"), "source_size": F.col("source_size"), "target": F.col("target"),
           "repeats": F.col("whole") + F.when(full, 1).otherwise(0),
           "taken": (F.col("whole") * F.col("size") + F.col("extra")).cast("long")}
    kept = ([F.col(f"_row.`{c}`").alias(c) for c in docs.columns if c not in new] if keep
            else [F.col("doc").alias(id_col), F.col("source").alias(source_col)])
    return rest.unionByName(inside.drop("upto")).select(*kept, *[v.alias(k) for k, v in new.items()])
