"""Small helpers shared by the operators."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BROADCAST_BYTES = 64 << 20      # measured size up to which a table is sent to every executor


def sent_if_small(df: DataFrame, row_bytes: int | Column) -> DataFrame:
    """A broadcast hint, but only when the rows' measured bytes stay below the bound; beyond it Spark
    shuffles both sides. ``df`` should be stored, as it is read once more for this."""
    size = row_bytes if isinstance(row_bytes, Column) else F.lit(row_bytes)
    total = df.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]
    return F.broadcast(df) if total <= BROADCAST_BYTES else df


def fold(key: Column, folds: int = 5) -> Column:
    """The fold of a row: CRC-32 of its id as text, modulo ``folds``; rows without an id are in fold 1,
    so they can be learned from and are never held out."""
    return F.coalesce(F.crc32(F.encode(key.cast("string"), "UTF-8")) % folds, F.lit(1))


def held_out(key: Column) -> Column:
    return fold(key) == 0


_caches: dict[str, Callable[[], None]] = {}


def own_cache(name: str, clear: Callable[[], None]) -> None:
    """Called in a worker before an operator fills what it remembers there: what other operators remember is
    dropped, as workers live on from one operator to the next."""
    for other, drop in _caches.items():
        if other != name:
            drop()
    _caches[name] = clear
