"""License scans: exact set-similarity join of text blocks with license templates.

A text is cut into overlapping blocks of words. A block matches a template when
it holds at least ``threshold`` of the template's distinct words (containment).
The join is exact: vocabulary words are ordered globally by document frequency
(rarest first); a block and a template that meet the threshold must share a word
of both their prefixes (prefix filter), a block needs enough vocabulary words
(length filter), and the words that can still follow the first shared one must
suffice (positional filter). Survivors are verified by their intersection.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skuflow.llm.common import once, row_key

NON_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BLOCK_WORDS = 64
MAX_TEMPLATE_WORDS = BLOCK_WORDS // 2
MAX_TEMPLATES = 1000

# Phrases of the base scan and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# License notices as they stand in files, by label.
TEMPLATES = {
    "apache-2.0": ["licensed under the apache license version 2.0"],
    "bsd": ["redistribution and use in source and binary forms with or without modification are permitted"
            " provided that the following conditions are met"],
    "cc-by": ["this work is licensed under a creative commons attribution 4.0 international license",
              "licensed under cc by 4.0"],
    "cc-by-nc": ["licensed under cc by nc 4.0"],
    "gpl": ["this work is licensed under the gnu general public license version 3",
            "this program is free software you can redistribute it and or modify it under the terms of the gnu"
            " general public license"],
    "mit": ["released under the mit license",
            "permission is hereby granted free of charge to any person obtaining a copy of this software"],
    "mpl-2.0": ["this source code form is subject to the terms of the mozilla public license v 2.0"],
}


def words_of(text: Column) -> Column:
    """Words of the text; ``lower`` moves no word boundary (whatever a non-ASCII
    letter becomes is again a word character), so places equal those of A-Z lowering."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), NON_WORD), "")


def _phrase_places(words: str, phrase: str) -> Column:
    parts = phrase.split()
    hit = lambda i: _all_of([F.get(F.col(words), i + k) == p for k, p in enumerate(parts)])
    last = F.size(words) - len(parts)
    places = F.filter(F.sequence(F.lit(0), last), hit)
    return F.when((last >= 0) & F.array_contains(words, parts[-1]), places).otherwise(F.array().cast("array<int>"))


def _all_of(conds: list[Column]) -> Column:
    out = conds[0]
    for c in conds[1:]:
        out = out & c
    return out


def _template_sets(templates: dict[str, list[str]], threshold: float) -> list[tuple[str, list[str], int]]:
    out = []
    for label in sorted(templates):
        for text in templates[label]:
            ws = "".join(c if c.isalnum() else " " for c in text.lower()).split()
            toks = sorted(set(ws))
            if not ws or len(ws) > MAX_TEMPLATE_WORDS:  # longer ones might lie across two blocks
                raise ValueError(f"template of {label}: 1 to {MAX_TEMPLATE_WORDS} words, got {len(ws)}")
            out.append((label, toks, math.ceil(threshold * len(toks) - 1e-9)))
    if not out or len(out) > MAX_TEMPLATES:
        raise ValueError(f"1 to {MAX_TEMPLATES} templates, got {len(out)}")
    return out


def _frequencies(words: DataFrame, vocab: list[str]) -> dict[str, int]:
    """Documents that hold each vocabulary word, over the whole corpus (at most one row a word)."""
    lit = F.array(*[F.lit(v) for v in vocab])
    rows = words.select(F.explode(F.array_intersect(lit, "w")).alias("t")).groupBy("t").count().collect()
    return {r["t"]: r["count"] for r in rows}


def license_blocks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   templates: dict[str, list[str]] | None = None, threshold: float = 0.8,
                   keys: bool = False) -> DataFrame:
    """Every (row, block, template) whose containment meets the threshold.

    Columns: the id, block (long, its first word is block * 32), label, template
    (its number), score. Rows with a null or wordless text have no block. Equal
    rows each give their matches. Only the id and the text are read.
    """
    sets = _template_sets(TEMPLATES if templates is None else templates, threshold)
    vocab = sorted({t for _, toks, _ in sets for t in toks})
    base = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    keyed = base.select("_id", *row_key("_id", "_text"), "_text")
    words = keyed.select("_id", "_k1", "_k2", once(words_of(F.col("_text")), "w"))
    freq = _frequencies(words, vocab)
    order = sorted(vocab, key=lambda v: (freq.get(v, 0), v))
    rank = {v: i for i, v in enumerate(order)}
    lit_order = F.array(*[F.lit(v) for v in order])
    ordered = [(n, label, sorted(toks, key=rank.get), a) for n, (label, toks, a) in enumerate(sets)]
    prefix = [(t, n, label, toks, i, len(toks), a) for n, label, toks, a in ordered
              for i, t in enumerate(toks[: len(toks) - a + 1])]
    index = docs.sparkSession.createDataFrame(
        prefix, "tok string, template int, label string, toks array<string>, i int, nt int, need int")
    least = min(a for *_, a in ordered)

    rare = F.array(*[F.lit(t) for t in sorted({p[0] for p in prefix})])
    half = MAX_TEMPLATE_WORDS
    blocks = (
        words.where(F.arrays_overlap("w", rare))
        .select("_id", "_k1", "_k2", "w", F.explode(F.sequence(
            F.lit(0), F.greatest(F.lit(0), F.ceil((F.size("w") - BLOCK_WORDS) / half)).cast("int"))).alias("block"))
        .select("_id", "_k1", "_k2", "block",
                once(F.array_intersect(lit_order, F.slice("w", F.col("block") * half + 1, BLOCK_WORDS)), "b"))
        .withColumn("nb", F.size("b"))
        .where(F.col("nb") >= least)                                                       # length
        .select("_id", "_k1", "_k2", "block", "b", "nb",
                F.posexplode(F.slice("b", F.lit(1), F.col("nb") - least + 1)).alias("j", "tok"))   # block prefix
    )
    # the index is bounded by MAX_TEMPLATES * MAX_TEMPLATE_WORDS rows
    pairs = blocks.join(F.broadcast(index), "tok").where(
        (F.col("nb") >= F.col("need")) & (F.least(F.col("nt") - F.col("i"), F.col("nb") - F.col("j")) >= F.col("need")))
    hits = pairs.withColumn("common", F.array_intersect("b", "toks")).where(
        (F.size("common") >= F.col("need")) & (F.get("common", F.lit(0)) == F.col("tok")))  # once: at its first shared word
    out = hits.select(F.col("_id").alias(id_col), F.col("block").cast("long").alias("block"), "label", "template",
                      (F.size("common") / F.col("nt")).alias("score"), "_k1", "_k2")
    return out if keys else out.drop("_k1", "_k2")


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 templates: dict[str, list[str]] | None = None, threshold: float = 0.8) -> DataFrame:
    """One row per input row: base phrase places and the labels of matching blocks.

    Null and empty texts have 0 words and empty labels; repeated rows are each
    returned; extra columns are ignored. ``score`` is 1 where a phrase stands,
    else the largest containment of a matching block, else 0.
    """
    keyed = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    keyed = keyed.select("_id", *row_key("_id", "_text"), "_text")
    words = keyed.select("_id", "_k1", "_k2", once(words_of(F.col("_text")), "w"))
    found = words.select("_id", "_k1", "_k2", F.size("w").cast("long").alias("n_words"),
                         *[once(_phrase_places("w", p), f"p{i}") if i == 0 else _phrase_places("w", p).alias(f"p{i}")
                           for i, p in enumerate(PHRASES)])
    places = [f"p{i}" for i in range(len(PHRASES))]
    base = found.select(
        "_id", "_k1", "_k2", "n_words",
        sum((F.size(p) for p in places[1:]), F.size(places[0])).cast("long").alias("n_base"),
        F.array_min(F.concat(*places)).cast("long").alias("first_word"),
        F.array_max(F.concat(*places)).cast("long").alias("last_word"),
        F.array_compact(F.array(*[F.when(F.size(p) > 0, F.lit(label)) for p, label in zip(places, PHRASES.values())]))
        .alias("base"))
    # equal rows have one key: each of their blocks counts once
    method = (license_blocks(docs, id_col, text_col, templates, threshold, keys=True)
              .dropDuplicates(["_k1", "_k2", "block", "template"]).groupBy("_k1", "_k2").agg(F.collect_set("label").alias("more"), F.max("score").alias("top"),
                                         F.count(F.lit(1)).alias("n_blocks")))
    labels = F.array_sort(F.array_distinct(F.concat("base", F.coalesce("more", F.array().cast("array<string>")))))
    return base.join(method, ["_k1", "_k2"], "left").select(
        F.col("_id").alias(id_col), "n_words", "n_base", "first_word", "last_word",
        F.array_join(F.array_sort("base"), ",").alias("base_labels"), F.array_join(labels, ",").alias("labels"),
        F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("top", F.lit(0.0))).alias("score"),
        F.coalesce("n_blocks", F.lit(0)).cast("long").alias("n_blocks"))
