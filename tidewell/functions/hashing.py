"""Stable shards of keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def md5_shard(key: Column, n: int) -> Column:
    """The md5 of the key's UTF-8, read as one number, modulo n."""
    digits = F.split(F.md5(F.coalesce(key, F.lit("")).cast("binary")), "")
    value = lambda c: F.instr(F.lit("0123456789abcdef"), c).cast("long") - 1
    return F.aggregate(F.slice(digits, 1, 32), F.lit(0).cast("long"), lambda a, c: (a * 16 + value(c)) % n).cast("int")


def bucket_shard(id_: Column, n: int, buckets: int = 1000) -> Column:
    """id modulo buckets, modulo n: neighbouring ids spread over shards."""
    return (F.pmod(id_, F.lit(buckets)) % n).cast("int")
