"""Buckets that grow: a bucket is a prefix of the bits of its keys' hash.

A table starts as one bucket without bits.  A bucket that passes a limit is split
by its next bits; no other bucket is touched.  The names of the buckets are the
directory: "b" and the bits.  A bucket that got no rows has no files, but belongs
to the directory all the same, because its sibling does.
"""

from __future__ import annotations

import math
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

ROOT = "b"
#: Bits that one split adds at most, and bits of a bucket at most.
STEP, DEPTH = 12, 48


def bits(columns: Iterable[str]) -> Column:
    """64 bits of a key's hash.  Keys are hashed as text, the same for all number types."""
    return F.lpad(F.bin(F.xxhash64(*[F.col(c).cast("string") for c in columns])), 64, "0")


def directory(names: Iterable[str]) -> list[str]:
    """All buckets, given those that hold rows: every way of bits leads to one."""
    held = set(names)
    inner = {name[:n] for name in held for n in range(1, len(name))}
    both = {f"{name}{bit}" for name in inner for bit in "01"}
    return sorted(held | (both - inner)) or [ROOT]


def bucket_of(columns: Iterable[str], buckets: Iterable[str]) -> Column:
    """Name of the bucket of a row.  The bits of most buckets are the default, so
    that only the others have to be looked up."""
    by_depth: dict[int, list[str]] = {}
    for name in buckets:
        by_depth.setdefault(len(name) - 1, []).append(name)
    hashed = bits(columns)
    prefix = lambda depth: F.concat(F.lit(ROOT), F.substring(hashed, 1, depth)) if depth else F.lit(ROOT)
    common = max(by_depth, key=lambda depth: len(by_depth[depth]))
    out = prefix(common)
    for depth in sorted(by_depth.keys() - {common}):
        out = F.when(prefix(depth).isin(by_depth[depth]), prefix(depth)).otherwise(out)
    return out


def steps(size: int, limit: int, name: str) -> int:
    """Bits to split a bucket by, so that its parts are within the limit."""
    if size <= limit:
        return 0
    return min(math.ceil(math.log2(size / limit)), STEP, DEPTH - len(name) + 1)


def split(name: str, by: int) -> list[str]:
    """The buckets that a split makes."""
    return [f"{name}{n:0{by}b}" for n in range(1 << by)]
