"""Keyed replace (insert or overwrite) and latest-version-per-key reads.

``replace_into(target, batch, keys)`` is ``REPLACE INTO`` as a DataFrame
plan: the batch is first reduced to one row per key (the row with the
greatest ``order`` value wins), target rows whose key is in the batch are
dropped (left anti join), and the batch rows are added. Applying the same
batch twice gives the same table.

Both sides of the anti join hold at most one row per key, so no key can be
hot in the join; the dedupe is a grouped ``max`` of a struct that Spark combines
partially before its shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from navedge.schema import KEY_COLUMNS


def _null_safe_cond(left: DataFrame, right: DataFrame, keys: list[str], prefix: str):
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(right[f"{prefix}{k}"])
        cond = c if cond is None else (cond & c)
    return cond


def _greatest_per_key(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Each key's row with the greatest ``order``; equal ``order`` values are
    settled by the remaining columns, so the choice never depends on row order.
    ``max`` of a struct combines partially before the shuffle."""
    values = [c for c in df.columns if c not in keys and c != order]
    packed = F.max(F.struct(F.col(order).alias("_nv_o"), *[F.col(c) for c in values])).alias("_nv_v")
    picked = df.groupBy(*keys).agg(packed)
    return picked.select(*keys, F.col("_nv_v._nv_o").alias(order),
                         *[F.col(f"_nv_v.{c}").alias(c) for c in values])


def one_per_key(batch: DataFrame, keys: list[str], order: str | None = None) -> DataFrame:
    """One row per key: that with the greatest ``order``, or else with the greatest values, column by column."""
    if order is None:
        values = [c for c in batch.columns if c not in keys]
        if not values:
            return batch.select(*keys).distinct()
        order = values[0]
    return _greatest_per_key(batch, keys, order)


def matching_keys(rows: DataFrame, batch_keys: DataFrame, keys: list[str], how: str) -> DataFrame:
    """``left_semi`` or ``left_anti`` join by key in which null equals null."""
    renamed = batch_keys.select(*[F.col(k).alias(f"_nv_k_{k}") for k in keys])
    return rows.join(renamed, _null_safe_cond(rows, renamed, keys, "_nv_k_"), how)


def replace_into(target: DataFrame, batch: DataFrame, keys: list[str] | None = None,
                 order: str | None = None) -> DataFrame:
    keys = list(keys or KEY_COLUMNS)
    cols = target.columns
    carry = [order] if order and order not in cols else []
    fresh = one_per_key(batch.select(*cols, *carry), keys, order).select(*cols)
    return matching_keys(target, fresh, keys, "left_anti").unionByName(fresh.select(*cols))


def latest_per_key(log: DataFrame, keys: list[str], version: str = "batch_id") -> DataFrame:
    """Fold of ``replace_into`` over versions: each key's row of its highest version."""
    return _greatest_per_key(log, keys, version).drop(version)
