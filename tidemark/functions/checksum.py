"""Row and dataset checksums that do not depend on row order or engine."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Columns left out of a row checksum unless the caller says otherwise.
DEFAULT_EXCLUDE = ("created_at", "updated_at")
NULL_SIGN = "-"
ALGORITHMS = ("md5", "sha1", "sha256", "xxhash64")
SUM_TYPE = "decimal(24,0)"
TOTAL_TYPE = "decimal(38,0)"


def _text(c: Column) -> Column:
    """Length and value, or a sign that no length begins with: no two lists of values give the same text."""
    value = c.cast("string")
    return F.coalesce(F.concat(F.length(value).cast("string"), F.lit(":"), value), F.lit(NULL_SIGN))


def checksum_columns(
    df: DataFrame, columns: Sequence[str] | None = None, exclude: Sequence[str] | None = None
) -> list[str]:
    """Columns of a checksum in name order. ``exclude=[]`` means nothing is left out."""
    left_out = set(DEFAULT_EXCLUDE if exclude is None else exclude)
    return sorted(c for c in (columns or df.columns) if c not in left_out)


def row_text(columns: Sequence[str]) -> Column:
    return F.concat_ws("|", *[F.concat(F.lit(c + "="), _text(F.col(c))) for c in columns])


def row_checksum(columns: Sequence[str], algorithm: str = "md5") -> Column:
    """Checksum text of a row over the named columns (null and empty text differ)."""
    text = row_text(columns)
    if algorithm == "md5":
        return F.md5(text)
    if algorithm == "sha1":
        return F.sha1(text)
    if algorithm == "sha256":
        return F.sha2(text, 256)
    if algorithm == "xxhash64":
        return F.lower(F.hex(F.xxhash64(text)))
    raise ValueError(f"unknown checksum algorithm {algorithm!r}; one of {ALGORITHMS}")


PIECE_BITS = 20
_MASK = (1 << PIECE_BITS) - 1


def number60(checksum: Column) -> Column:
    """First 60 bits of a hex checksum as a number."""
    return F.conv(F.substring(checksum, 1, 15), 16, 10).cast("bigint")


def piece_sums(number: Column, prefix: str) -> list[Column]:
    """Sums of the low, middle and high 20 bits: plain long sums that hold for 2^43 rows, so an exact
    order-independent total needs no decimal arithmetic per row."""
    return [
        F.sum(F.shiftright(number, k * PIECE_BITS).bitwiseAND(F.lit(_MASK))).alias(f"{prefix}{k}") for k in range(3)
    ]


def total_of_pieces(prefix: str) -> Column:
    """The exact sum behind the three piece sums."""
    parts = [
        F.coalesce(F.col(f"{prefix}{k}"), F.lit(0)).cast(SUM_TYPE) * F.lit(1 << (k * PIECE_BITS)).cast("decimal(13,0)")
        for k in range(3)
    ]
    return (parts[0] + parts[1] + parts[2]).cast(TOTAL_TYPE)


def row_hash(columns: Sequence[str], salt: str = "") -> Column:
    """64-bit hash of the typed values, for comparing rows inside Spark; another ``salt`` gives another
    hash. Nulls are marked, as the hash function itself passes over them."""
    nulls = F.concat(F.lit(salt), *[F.when(F.col(c).isNull(), F.lit("1")).otherwise(F.lit("0")) for c in columns])
    return F.xxhash64(nulls, *[F.col(c) for c in columns])


def hash_sums(number: Column, prefix: str, sign: Column) -> list[Column]:
    """Signed sums of the three 22-bit pieces of a 64-bit hash: bags of rows that are equal on the plus
    and the minus side come to zero."""
    mask = F.lit((1 << 22) - 1)
    return [
        F.sum(F.shiftrightunsigned(number, k * 22).bitwiseAND(mask) * sign).alias(f"{prefix}{k}") for k in range(3)
    ]
