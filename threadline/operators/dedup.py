"""Keep-first deduplication on a text fingerprint.

``row_number() over (partition by key)`` would send a hot key (a boilerplate
first turn shared by a third of all rows) to one task.  Instead the winner of
each key is found with ``min(struct(order))`` - a partial aggregate combined
map-side - and the rows are kept with a left-semi join on the (unique)
order key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadline.functions import text as T


def _names(cols) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def keep_first(df: DataFrame, key: Column, order_cols) -> DataFrame:
    """One row per distinct ``key``: the one smallest in ``order_cols`` (a unique key).

    Keys are grouped by their md5, so the shuffle carries 32 characters per key
    and row group whatever the key's length; a single order column keeps the
    aggregate a hash aggregate.
    """
    order_cols = _names(order_cols)
    keyed = df.select(*order_cols, F.md5(key).alias("_tl_key"))
    if len(order_cols) == 1:
        winners = keyed.groupBy("_tl_key").agg(F.min(order_cols[0]).alias(order_cols[0])).select(order_cols[0])
        # min skips nulls: a key all of whose rows lack the order value keeps them (null-safe join below)
    else:
        winners = (keyed.groupBy("_tl_key")
                   .agg(F.min(F.struct(*[F.col(c) for c in order_cols])).alias("_tl_w"))
                   .select(*[F.col(f"_tl_w.{c}").alias(c) for c in order_cols]))
    if not any(df.schema[c].nullable for c in order_cols):
        # plain equi-join: keeps the (order_cols) partitioning of ``df`` (no re-shuffle),
        # and with non-nullable keys no IsNotNull filter is inferred into one branch only,
        # so both uses of ``df`` canonicalise alike and the upstream shuffle is reused
        return df.join(winners, on=order_cols, how="left_semi")
    # nullable keys: null-safe equality keeps rows whose order key has nulls
    cond = None
    for c in order_cols:
        e = df[c].eqNullSafe(winners[c])
        cond = e if cond is None else cond & e
    return df.join(winners, cond, how="left_semi")


def dedup_prefix(records: DataFrame, chars: int = T.FINGERPRINT_CHARS, order_cols=("conv_id", "start"),
                 turns_col: str = "turns") -> DataFrame:
    """Drop empty records, then keep the first record per fingerprint of its first turn."""
    non_empty = records.filter(F.coalesce(F.size(turns_col) > 0, F.lit(False)))
    key = T.fingerprint(F.try_element_at(F.col(turns_col), F.lit(1))["text"], chars)
    return keep_first(non_empty, key, order_cols)


def dedup_text_prefix(df: DataFrame, text_col: str = "text", chars: int = T.FINGERPRINT_CHARS,
                      order_cols="doc_id") -> DataFrame:
    """Flat variant: keep the first row per fingerprint of a text column.

    Winners are ids from one partial aggregate over (id, md5); the rows are kept by a
    semi join on the id, never joined on the (possibly hot) fingerprint.
    """
    return keep_first(df, T.fingerprint(text_col, chars), order_cols)
