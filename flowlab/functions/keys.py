"""Repeatable row selection by key hash.

``randomSplit`` and ``sample`` draw per partition, so their result moves with the file layout.
A hash of the row key does not, needs no shuffle, and gives the same rows in any engine with md5.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def key_hash(key: str, salt: str = "") -> Column:
    """The first 32 bits of the key's md5 as a bigint; a NULL key counts as empty text."""
    text = F.coalesce(F.col(key).cast("string"), F.lit(""))
    if salt:
        text = F.concat(F.lit(salt), text)
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def hash_percent(key: str, salt: str = "") -> Column:
    """A bigint in [0, 100)."""
    return key_hash(key, salt) % 100


def in_percent(key: str, percent: int, salt: str = "") -> Column:
    return hash_percent(key, salt) < percent


def fold_number(key: str, folds: int, salt: str = "fold:") -> Column:
    """An int in [0, folds). The salt makes it independent of ``in_percent`` of the same key, so that the
    training rows of a split are spread over all folds."""
    return (key_hash(key, salt) % folds).cast("int")
