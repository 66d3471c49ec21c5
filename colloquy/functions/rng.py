"""Reproducible random numbers as plain column expressions.

A draw is a function of (seed, purpose, keys) only, so it does not depend on partitioning, task
retries or the order of rows. One digest holds four independent 32-bit lanes; operators that need
several draws per row take them from one digest.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

LANES = 4
WIDE_LANES = 2
_WIDE_SCALE = 4503599627370496.0
_SCALE = 4294967296.0


def digest(seed: int, purpose: str, *keys: Column | str) -> Column:
    """Hex digest of the seed, a purpose label and any number of key columns."""
    cols = [F.col(k) if isinstance(k, str) else k for k in keys]
    return F.md5(F.concat_ws("|", F.lit(str(seed)), F.lit(purpose), *[c.cast("string") for c in cols]))


def lane(digest_col: Column | str, index: int | Column = 0) -> Column:
    """The ``index``-th uniform number in [0, 1) of a digest."""
    col = F.col(digest_col) if isinstance(digest_col, str) else digest_col
    if isinstance(index, int):
        part = F.substring(col, 8 * index + 1, 8)
    else:
        part = F.substr(col, index * 8 + 1, F.lit(8))
    return F.conv(part, 16, 10).cast("bigint") / F.lit(_SCALE)


def uniform01(seed: int, purpose: str, *keys: Column | str) -> Column:
    """One uniform number in [0, 1)."""
    return lane(digest(seed, purpose, *keys))


def wide_lane(digest_col: Column, index: int | Column = 0) -> Column:
    """The ``index``-th of ``WIDE_LANES`` uniform numbers with 52 bits: fine enough to draw from any table's rows."""
    at = F.lit(index) if isinstance(index, int) else index
    part = F.substr(digest_col, at * 13 + 1, F.lit(13))
    return F.conv(part, 16, 10).cast("bigint") / F.lit(_WIDE_SCALE)


def wide01(seed: int, purpose: str, *keys: Column | str) -> Column:
    """One uniform number in [0, 1) with 52 bits."""
    return wide_lane(digest(seed, purpose, *keys))


def wide_digests(seed: int, purpose: str, count: int, *keys: Column | str) -> Column:
    """Enough digests for ``count`` wide draws per row, as an array; read it with ``wide_nth``."""
    blocks = F.sequence(F.lit(0), F.lit((count - 1) // WIDE_LANES))
    return F.transform(blocks, lambda b: digest(seed, purpose, *keys, b))


def wide_nth(many: Column, i: Column) -> Column:
    """Wide draw number ``i`` of an array of digests."""
    return wide_lane(F.element_at(many, (F.floor(i / WIDE_LANES) + 1).cast("int")), (i % WIDE_LANES).cast("int"))


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and use it any number of times in ``body``."""
    return F.element_at(F.transform(F.array(value), body), 1)


def between(u: Column, low: float, high: float) -> Column:
    """Map a uniform number to [low, high)."""
    return F.lit(float(low)) + F.lit(float(high) - float(low)) * u


def whole(x: Column) -> Column:
    """Truncate towards zero."""
    return x.cast("bigint")


def below(u: Column, n: Column | int) -> Column:
    """Uniform integer in [0, n)."""
    return F.floor(u * n).cast("bigint")


def integer(u: Column, low: int, high: int) -> Column:
    """Uniform integer in [low, high], both ends included."""
    return F.lit(low).cast("bigint") + below(u, high - low + 1)


def one_of(u: Column, values: Sequence[str]) -> Column:
    """Uniform choice from a short list of literals."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (below(u, len(values)) + 1).cast("int"))


def weighted(u: Column, table: Sequence[tuple[str, float]], fallback: str) -> Column:
    """Choice by cumulative probability in table order; ``fallback`` if rounding leaves a gap."""
    choice, total = None, 0.0
    for name, p in table:
        total += p
        choice = (F if choice is None else choice).when(u <= F.lit(total), F.lit(name))
    return choice.otherwise(F.lit(fallback))


def distinct_below(n: Column, k: Column, draw: Callable[[Column], Column]) -> Column:
    """``k`` distinct integers out of [0, n): every k-subset is equally likely.

    ``draw(i)`` is the uniform number of step ``i``. Step ``i`` looks at the first ``n - k + i + 1``
    values and takes the drawn one, or the last one if the drawn one is taken already; so the cost is
    ``k`` steps whatever ``n`` is, and no candidate list is ever formed.
    """
    empty = F.array().cast("array<bigint>")
    steps = F.sequence(F.lit(0).cast("bigint"), F.greatest(k, F.lit(1)) - 1)

    def settle(drawn: Column) -> Column:
        def step(taken: Column, i: Column) -> Column:
            own = F.element_at(drawn, (i + 1).cast("int"))
            return F.array_append(taken, F.when(F.array_contains(taken, own), n - k + i).otherwise(own))

        # mostly no value is drawn twice, and then every step keeps its own
        return F.when(F.size(F.array_distinct(drawn)) == F.size(drawn), drawn).otherwise(F.aggregate(steps, empty, step))

    return F.when(k > 0, bind(F.transform(steps, lambda i: below(draw(i), n - k + i + 1)), settle)).otherwise(empty)
