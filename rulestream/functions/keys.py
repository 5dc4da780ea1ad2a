"""Composite record keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

SEPARATOR = "^"


def composite_key(
    prefix: str, parts: Sequence[str | Column], only_if: Column | None = None
) -> Column:
    """``prefix^part^part``; null when a part is null or ``only_if`` does not hold.

    Computing the key as a column keeps a join on it an equi-join. Written as a CASE
    inside the ON clause the same condition runs as a nested loop.
    """
    pieces: list[Column] = [F.lit(prefix)]
    for part in parts:
        pieces.append(F.lit(SEPARATOR))
        pieces.append((F.col(part) if isinstance(part, str) else part).cast("string"))
    key = F.concat(*pieces)
    return key if only_if is None else F.when(only_if, key)


def key_part(key: str | Column, position: int) -> Column:
    """One part of a composite key; negative positions count from the end."""
    column = F.col(key) if isinstance(key, str) else key
    return F.element_at(F.split(column, r"\^"), position)
