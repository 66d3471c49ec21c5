"""Word columns and small expression helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    """Words of a text: runs free of blanks and of the characters U+0009 to U+000D; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def n_words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("bigint")


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, and only where the whole expression is evaluated."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def hash63(*keys: Column) -> Column:
    """Non-negative hash of the keys."""
    return F.shiftrightunsigned(F.xxhash64(*keys), 1)


def require(df: DataFrame, *columns: str) -> None:
    """Raise where a needed column is absent; other columns never matter."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; there are {df.columns}")


def packed(df: DataFrame) -> Column:
    """All columns of a row as one value, so that working columns cannot clash with them; ``row.*`` unpacks it."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row")


def unpacked(df: DataFrame, without: Sequence[str] = ()) -> list[Column]:
    """The packed columns but for those that an output column of the same name replaces."""
    taken = {name.lower() for name in without}
    return [F.col(f"row.`{c}`").alias(c) for c in df.schema["row"].dataType.names if c.lower() not in taken]
