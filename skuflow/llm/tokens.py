"""Token counts: whole tokens are counted directly, only the rest is merged.

One narrow pass over the texts; see :mod:`skuflow.llm.bytebpe` for the proof of
the whole tokens, which is made once on the driver and sent along with the
tokenizer file's text, so that executors need no copy of the file.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skuflow.llm import bytebpe


def token_counts(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = 512) -> DataFrame:
    """``<id>, n_bytes, n_tokens, over_limit`` of every row.

    A null text counts as empty, an empty one has no tokens; equal rows are counted
    each, ids may be null or repeat, and other columns are not read, whatever their
    names. Long texts are split some 65,000 characters at a time. A byte that is no
    UTF-8 counts as the replacement character's tokens. An empty table gives none.
    """
    with open(tokenizer_path, encoding="utf-8") as f:
        spec = f.read()
    whole = bytebpe.ByteBPE(spec).whole

    @F.pandas_udf("long")
    def counted(texts: pd.Series) -> pd.Series:
        bpe = bytebpe.loaded(spec, whole)
        return pd.Series([bpe.count(bytebpe.plain_text(t)) for t in texts], dtype="int64")

    text = F.col(text_col)
    return docs.select(
        F.col(id_col),
        F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"),
        counted(text.cast("binary")).alias("n_tokens"),
    ).withColumn("over_limit", F.col("n_tokens") > limit)
