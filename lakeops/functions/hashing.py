"""Row hashes for change detection."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def row_hash(columns: list[str], sep: str = "\x1f", null: str = "\x00") -> Column:
    """MD5 over the columns as text. The separator keeps ('ab','c') and ('a','bc') apart, `null` keeps NULL and ''
    apart."""
    return F.md5(F.concat_ws(sep, *[F.coalesce(F.col(c).cast("string"), F.lit(null)) for c in columns]))


def plain_hash(columns: list[str]) -> Column:
    """MD5 over the bare concatenation with NULL as '': equal to hashes already stored by older jobs."""
    return F.md5(F.concat(*[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]))
