"""Rows told apart, and texts fetched for chosen rows."""

from pyspark.sql import DataFrame, functions as F

from eventlens.session import broadcast_if_small

LAST = (1 << 63) - 1  # stands for a null id, larger than all others
ROW = ["key", "rid"]


def identified(docs: DataFrame) -> DataFrame:
    """``docs`` with ``key``, the id, and ``rid``, a number of id and text: rows that agree in
    both are alike."""
    return docs.withColumns({
        "key": F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)), "rid": F.xxhash64("doc_id", "text")})


def with_text(chosen: DataFrame, rows: DataFrame) -> DataFrame:
    """``chosen`` (one row for each key and rid, counted here) with the texts of ``rows``.

    Few chosen rows are broadcast to the scan of the texts, so only their texts are
    shuffled; otherwise all texts are.
    """
    few, _ = broadcast_if_small(chosen.select(ROW), chosen.count())
    texts = rows.select(*ROW, "text").join(few, ROW, "left_semi").dropDuplicates(ROW)
    return texts.join(chosen, ROW)
