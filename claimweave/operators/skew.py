"""Many-to-one joins whose hot keys adaptive execution can split.

The one-row-per-key side is mostly an aggregate. A join on its own grouping keys would read that aggregate directly
from the exchange below it, and adaptive execution splits a hot partition only where both sides of the
join come straight from a shuffle. So the join is on a hash of the key, which the aggregate is not partitioned by:
the reduced side is shuffled once more, and then all rows of a hot key on the many side are cut into pieces that
each meet a copy of the one row they need. The hash also makes sorting cheap; the keys themselves still decide.
Small reduced sides are broadcast by the planner as ever.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def many_to_one(many: DataFrame, one: DataFrame, keys: Sequence[str], how: str = "inner", null_safe: Sequence[str] = ()) -> DataFrame:
    """``many`` joined (``inner`` or ``left``) with the row of ``one`` that has its key, with the columns of both.

    ``one`` has at most one row per key. ``null_safe`` keys take null as a value; a null in another key finds nothing.
    """
    every = [*keys, *null_safe]
    kinds = many.schema
    others = [c for c in one.columns if c not in every]

    def hashed(prefix: str = "") -> Column:
        # keys of another type are read as those of the many side
        return F.xxhash64(*[F.col(f"{prefix}{k}").cast(kinds[k].dataType) for k in every])

    right = one.select(*[F.col(c).alias(f"_uma_{c}") for c in every], *others)
    condition = hashed() == hashed("_uma_")  # of expressions: no hash is carried through the shuffle
    # Written as no equality the planner would add to the join keys, which would bring the aggregate's partitioning back.
    for c in keys:
        condition = condition & F.coalesce(F.col(c) == F.col(f"_uma_{c}"), F.lit(False))
    for c in null_safe:
        condition = condition & F.coalesce(F.col(c).eqNullSafe(F.col(f"_uma_{c}")), F.lit(False))
    return many.join(right, condition, how).select(*many.columns, *others)
