"""Deterministic ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import URL_NAMESPACE_HEX


def point_id(tweet_id: Column) -> Column:
    """Version-5 UUID of an id in the URL namespace."""
    name = F.concat(F.unhex(F.lit(URL_NAMESPACE_HEX)), F.encode(tweet_id, "UTF-8"))
    digest = F.sha1(name)
    variant = F.translate(digest.substr(17, 1), "0123456789abcdef", "89ab89ab89ab89ab")
    return F.concat_ws(
        "-",
        digest.substr(1, 8),
        digest.substr(9, 4),
        F.concat(F.lit("5"), digest.substr(14, 3)),
        F.concat(variant, digest.substr(18, 3)),
        digest.substr(21, 12),
    )


def partition_of(key: Column, partitions: int) -> Column:
    """Partition of a keyed message: equal keys always share one."""
    head = F.conv(F.substring(F.md5(key.cast("binary")), 1, 8), 16, 10)
    return F.pmod(head.cast("bigint"), F.lit(partitions)).cast("int")
