"""Consecutive numbering and running totals without a global or per-key single-task window.

Rows are cut into id blocks of fixed width. Ids are unique, so a block holds at most ``width`` rows
however skewed any other key is. Positions inside a block come from a window over the block; the start of
each block comes from running sums over the small table of block totals.

Made for row numbers and the like: with ids scattered over a wide range choose a wider block, or the table of
block totals grows towards the size of the data.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def block_of(id_col: str, width: int) -> Column:
    """Block number of an integer id."""
    return F.floor(F.col(id_col) / F.lit(width)).cast("bigint")


def running_totals(
    df: DataFrame,
    id_col: str,
    width: int,
    totals: Mapping[str, tuple[Sequence[str], Column]],
) -> DataFrame:
    """Add exclusive running sums in id order.

    ``totals`` maps an output name to (group columns, value). ``<name>`` becomes the sum of the value
    over the earlier rows of the same group, ``<name>_total`` the sum over the whole group. All
    windows share one exchange by block, for whatever group.
    """
    values = df.withColumn("_block", block_of(id_col, width))
    values = values.withColumns({f"_v_{name}": value.cast("bigint") for name, (_, value) in totals.items()})
    by_group: dict[tuple[str, ...], list[str]] = {}
    for name, (group, _) in totals.items():
        by_group.setdefault(tuple(group), []).append(name)

    parts = []
    for group, names in by_group.items():
        # from the unshuffled rows, so that totals are combined before anything moves
        blocks = values.groupBy("_block", *group).agg(*[F.sum(f"_v_{n}").alias(f"_s_{n}") for n in names])
        order = Window.partitionBy(*group).orderBy("_block")
        whole_group = Window.partitionBy(*group)
        earlier = order.rowsBetween(Window.unboundedPreceding, -1)
        parts.append((group, names, blocks.select(
            F.col("_block").alias("_b"),
            *[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)],
            *[F.coalesce(F.sum(f"_s_{n}").over(earlier), F.lit(0)).alias(f"_o_{n}") for n in names],
            *[F.sum(f"_s_{n}").over(whole_group).alias(f"{n}_total") for n in names],
        )))

    out = values.repartition("_block")
    for group, names in by_group.items():
        earlier = (
            Window.partitionBy("_block", *group).orderBy(id_col)
            .rowsBetween(Window.unboundedPreceding, -1)
        )
        out = out.withColumns(
            {f"_l_{n}": F.coalesce(F.sum(f"_v_{n}").over(earlier), F.lit(0)) for n in names}
        )
    for group, names, starts in parts:
        same = out["_block"] == starts["_b"]
        for i, g in enumerate(group):
            same = same & out[g].eqNullSafe(starts[f"_g{i}"])
        out = out.join(starts, same).drop("_b", *[f"_g{i}" for i in range(len(group))])
        out = out.withColumns({n: F.col(f"_l_{n}") + F.col(f"_o_{n}") for n in names})
    scratch = [c for c in out.columns if c.startswith(("_v_", "_l_", "_o_"))]
    return out.drop("_block", *scratch)
