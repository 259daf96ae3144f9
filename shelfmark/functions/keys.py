"""Row-key and hashing expressions (F8, repeatable sampling)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfmark.functions.util import as_col


def md5_row_key(*cols, sep: str = "=") -> Column:
    """F8. md5 of the ``sep``-joined text of the columns; NULLs are skipped
    as ``concat_ws`` does.  Timestamps render as ``yyyy-MM-dd HH:mm:ss[.f]``."""
    return F.md5(F.concat_ws(sep, *[as_col(c).cast("string") for c in cols]))


def md5_bucket(c, buckets: int) -> Column:
    """Bucket 0..buckets-1 from the first 32 bits of md5(text); portable to any
    engine with md5, so a sample drawn with it can be checked elsewhere."""
    h = F.conv(F.substring(F.md5(as_col(c).cast("string")), 1, 8), 16, 10).cast("long")
    return F.pmod(h, F.lit(buckets))
