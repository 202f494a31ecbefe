"""Grouping keys of bounded width."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_DIGEST_BYTES = 32


def group_key(df: DataFrame, name: str) -> Column:
    """A column that is equal for two rows exactly when ``name`` is.

    Long text would travel whole through the shuffle of a group-by, so text of
    32 bytes and more is replaced by its SHA-256. Shorter text stays as it is
    and can never equal a digest, whose length is 32. Other types group by value.
    """
    column = F.col(f"`{name}`")
    kind = df.schema[name].dataType
    # Text under another collation may be equal without having equal bytes.
    bytewise = isinstance(kind, T.StringType) and kind.collation == "UTF8_BINARY"
    if not bytewise and not isinstance(kind, T.BinaryType):
        return column
    raw = column.cast("binary")
    return F.when(F.octet_length(column) < _DIGEST_BYTES, raw).otherwise(
        F.unhex(F.sha2(raw, 256))
    )
