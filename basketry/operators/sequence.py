"""Numbering rows within a group, without one task holding a hot group."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.session import dealt

# Order positions per slice when the position column gives no bound of its own.
SLICE_LENGTH = 4096


def position_slice(df: DataFrame, position: str) -> Column | None:
    """The slice to number by, or None when the type already bounds a group.

    Positions are unique within a group, so a 16-bit position caps the group at
    32,767 rows: one shuffle on the group keys is enough.  A wider type proves
    nothing, and the group is cut into ranges of positions.
    """
    if isinstance(df.schema[position].dataType, (T.ByteType, T.ShortType)):
        return None
    return F.floor(F.col(position) / SLICE_LENGTH).cast("bigint")


def number_rows(
    rows: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    number: str,
    previous: Mapping[str, str],
    slice_by: Column | None = None,
    count: int = 0,
) -> DataFrame:
    """Add the 1-based place ``number`` of each row within its group, and for
    each ``new: column`` in ``previous`` the value of the row before.

    ``slice_by`` must not decrease along ``order_by``.  With it, windows run
    over slices of a group; what a slice needs from the slices before it (row
    count and last row) comes from one pre-aggregated row per slice.  ``count``,
    the number of rows about, bounds what a task holds.
    """
    order = [F.col(c) for c in order_by]
    if slice_by is None:
        window = Window.partitionBy(*keys).orderBy(*order)
        return dealt(rows, count, *keys).select(
            "*",
            F.row_number().over(window).cast("bigint").alias(number),
            *[F.lag(source).over(window).alias(new) for new, source in previous.items()],
        )

    sliced = rows.withColumn("_slice", slice_by)
    slice_keys = [*keys, "_slice"]
    inside = Window.partitionBy(*slice_keys).orderBy(*order)
    numbered = dealt(sliced, count, *slice_keys).select(
        "*",
        F.row_number().over(inside).cast("bigint").alias(number),
        *[F.lag(source).over(inside).alias(new) for new, source in previous.items()],
    )
    across = Window.partitionBy(*keys).orderBy("_slice")
    last_row = F.max_by(F.struct(*previous.values()), F.struct(*order)) if previous else F.lit(None)
    carried = (
        sliced.groupBy(*slice_keys)
        .agg(F.count("*").alias("_size"), last_row.alias("_last"))
        .select(
            *slice_keys,
            F.sum("_size").over(across.rowsBetween(Window.unboundedPreceding, -1)).alias("_before"),
            F.lag("_last").over(across).alias("_carried"),
        )
        .filter(F.col("_before").isNotNull())  # nothing to carry into a first slice
    )
    changed = {number: F.col(number) + F.coalesce(F.col("_before"), F.lit(0))}
    for new, source in previous.items():
        changed[new] = F.coalesce(F.col(new), F.col(f"_carried.{source}"))
    return numbered.join(carried, slice_keys, "left").withColumns(changed).select(*rows.columns, number, *previous)
