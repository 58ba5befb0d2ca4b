"""Change hashes and surrogate keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .expressions import ColumnOrName, as_column

# Stands for NULL inside hashed text, so that (a, NULL, b) and (a, b, NULL) differ.
NULL_TOKEN = "<null>"


def _joined(separator: str, columns: tuple[ColumnOrName, ...], null_token: str | None) -> Column:
    texts = [as_column(c).cast("string") for c in columns]
    if null_token is not None:
        texts = [F.coalesce(t, F.lit(null_token)) for t in texts]
    return F.concat_ws(separator, *texts)


def change_hash(*columns: ColumnOrName, null_token: str | None = NULL_TOKEN) -> Column:
    """H1/H2: SHA-256 over the ``|``-joined string casts of the tracked columns.

    ``null_token=None`` skips NULLs instead, which reproduces hashes stored by
    earlier loads that used plain ``concat_ws``. Rows without NULLs hash the
    same either way.
    """
    return F.sha2(_joined("|", columns, null_token), 256)


def row_hash(columns: Sequence[str]) -> Column:
    """64-bit hash of a row that tells which columns are NULL; ``xxhash64`` alone skips NULLs."""
    marks = [F.col(c).isNull() for c in columns]
    return F.xxhash64(*[F.col(c) for c in columns], *marks)


def surrogate_key(*columns: ColumnOrName, null_token: str = NULL_TOKEN) -> Column:
    """H3: MD5 over the ``-``-joined string casts of the key columns."""
    return F.md5(_joined("-", columns, null_token))
