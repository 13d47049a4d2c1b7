"""Keys and hashes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def surrogate_key(name: Column | str) -> Column:
    """CRC-32 of the name: 0 to 2^32-1, hence a bigint."""
    return F.crc32(name)


def digest(text: Column | str) -> Column:
    return F.sha2(text, 256)


def message_key(text: Column | str) -> Column:
    """Identity of a message: the first 128 bits of its text's SHA-256, shaped as a UUID.

    Fixed width, so grouping, joining and sorting never use texts as keys; and repeatable, so a load
    or a task that runs again yields the same ids.
    """
    places = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    first, *rest = [F.substring(digest(text), start, size) for start, size in places]
    return F.concat(first, *[part for chunk in rest for part in (F.lit("-"), chunk)])


def slot(key: Column | str, slots: int) -> Column:
    """Even, repeatable slot of a hexadecimal hash key."""
    return F.conv(F.substring(key, 1, 8), 16, 10).cast("bigint") % slots
