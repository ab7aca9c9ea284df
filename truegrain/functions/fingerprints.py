"""Order-insensitive column fingerprints."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A 32-bit hash summed over 10^12 equal rows leaves the bigint range, a 64-bit
# one much sooner, so the sums are decimal.
_WIDE = "decimal(20,0)"


def checksum(column: Column) -> Column:
    """Sum of the 32-bit hashes of all values; NULL hashes to the seed, 42."""
    return F.sum(F.hash(column).cast(_WIDE))


def row_bound_checksum(column: Column, row_hash: Column) -> Column:
    """A checksum that also depends on which row each value stands in.

    Two columns agree on it only if they agree row by row (up to hash collisions),
    so a permuted copy is told apart from a real one.
    """
    return F.sum(F.xxhash64(column, row_hash).cast(_WIDE))


def portable_checksum(column: Column) -> Column:
    """Sum of the first 60 bits of the MD5 of each value's text.

    Slower than :func:`checksum`, but other engines can compute the same number.
    NULL adds nothing.
    """
    digits = F.substring(F.md5(column.cast("string")), 1, 15)
    return F.sum(F.conv(digits, 16, 10).cast(_WIDE))
