"""Row hashes that tell changed attributes."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def hashdiff(columns: Iterable[Column | str]) -> Column:
    """md5 of the trimmed texts joined by ``#``, without trailing ``#``; nulls count as empty.

    Trailing empty columns therefore do not change the hash: adding a column keeps old hashes.
    """
    texts = [F.trim(F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(""))) for c in columns]
    return F.md5(F.regexp_replace(F.concat_ws("#", *texts), "#+$", ""))


def joined_hash(columns: Iterable[str], side: str = "") -> Column:
    """md5 of untrimmed texts joined by ``_``; null and empty compare equal."""
    return F.md5(F.concat_ws("_", *[F.coalesce(F.col(f"{side}{c}").cast("string"), F.lit("")) for c in columns]))


def null_safe(left: Iterable[str], right: Iterable[str]) -> Column:
    out = F.lit(True)
    for a, b in zip(left, right, strict=True):
        out = out & F.col(a).eqNullSafe(F.col(b))
    return out
