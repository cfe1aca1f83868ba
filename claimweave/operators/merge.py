"""Keyed merges as pure functions: (current snapshot, incoming rows) -> next snapshot.

None of these collects a key group.  De-duplication filters ``row_number() = 1``, which
Spark also applies before the shuffle (window group limit), so a key that holds a large
share of the rows sends at most one row per map task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from claimweave.functions.identity import canonical_text


def first_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column] = ()) -> DataFrame:
    """One row per key, the first in ``order``; remaining ties break on the whole row."""
    plain = [f.name for f in df.schema.fields if f.dataType.typeName() not in ("map", "variant")]
    total = [*order, F.md5(canonical_text([c for c in plain if c not in keys] or list(keys)))]
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(*total))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def merge_by_key(
    current: DataFrame, incoming: DataFrame, keys: Sequence[str], order_by: Sequence[Column] = ()
) -> DataFrame:
    """Incoming rows replace current rows of the same key; incoming is de-duplicated first."""
    fresh = first_by_key(incoming, keys, order_by)
    kept = current.join(incoming.select(*keys).distinct(), list(keys), "left_anti")
    return kept.select(*current.columns).unionByName(fresh.select(*current.columns))


def replace_window(
    current: DataFrame, incoming: DataFrame, key: str, window: str, order_by: Sequence[Column] = ()
) -> DataFrame:
    """As :func:`merge_by_key`, but every current row of an incoming window value goes too.

    A table stored partitioned by ``window`` can write only the incoming windows with
    dynamic partition overwrite when keys never move between windows.
    """
    fresh = first_by_key(incoming, [key], order_by)
    kept = current.join(incoming.select(window).distinct(), window, "left_anti")
    kept = kept.join(incoming.select(key).distinct(), key, "left_anti")
    return kept.select(*current.columns).unionByName(fresh.select(*current.columns))


def _same(left: DataFrame, right: DataFrame, strict: Sequence[str], null_safe: Sequence[str]) -> Column:
    tests = [left[c] == right[c] for c in strict] + [left[c].eqNullSafe(right[c]) for c in null_safe]
    condition = tests[0]
    for test in tests[1:]:
        condition = condition & test
    return condition


def missing_from(
    incoming: DataFrame, current: DataFrame, strict_keys: Sequence[str], null_safe_keys: Sequence[str] = ()
) -> DataFrame:
    """Incoming rows without an equal current row; null-safe keys treat null as a value."""
    known = current.select(*[F.col(c).alias(f"_k_{c}") for c in (*strict_keys, *null_safe_keys)])
    renamed = known.toDF(*strict_keys, *null_safe_keys).alias("known")
    return incoming.join(renamed, _same(incoming, renamed, strict_keys, null_safe_keys), "left_anti")


def insert_missing(
    current: DataFrame, incoming: DataFrame, strict_keys: Sequence[str], null_safe_keys: Sequence[str] = ()
) -> DataFrame:
    fresh = missing_from(incoming, current, strict_keys, null_safe_keys)
    return current.unionByName(fresh, allowMissingColumns=True)
