"""Column helpers shared by the operators. All of them stay inside whole-stage codegen."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Operation codes of the change-event format and their names.
OP_NAMES = {"c": "INSERT", "u": "UPDATE", "d": "DELETE", "r": "READ"}
UNKNOWN_OP = "UNKNOWN"
# Texts read as boolean true.
TRUE_TEXTS = ("true", "1", "yes")
# Units of the human-readable size text.
BYTE_UNITS = ("B", "KB", "MB", "GB", "TB", "PB")

NULL_TEXT = "\\N"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def op_name(op: str | Column, read_as: str = "READ") -> Column:
    """Name of an operation code; ``read_as`` is the name for snapshot reads."""
    op = col(op)
    names = {**OP_NAMES, "r": read_as}
    out = F.when(F.lit(False), F.lit(None).cast("string"))
    for code, name in names.items():
        out = out.when(op == code, F.lit(name))
    return out.otherwise(F.lit(UNKNOWN_OP))


def _non_empty(c: str | Column) -> Column:
    return F.nullif(col(c), F.lit(""))


def joined_text(parts: Sequence[str | Column], sep: str, default: str | None) -> Column:
    """Join the parts that are neither null nor empty; ``default`` when nothing is left."""
    text = F.nullif(F.concat_ws(sep, *[_non_empty(p) for p in parts]), F.lit(""))
    return text if default is None else F.coalesce(text, F.lit(default))


def full_name(first: str | Column, last: str | Column, default: str = "Unknown") -> Column:
    return joined_text([first, last], " ", default)


def location(city: str | Column, state: str | Column, country: str | Column, default: str = "Unknown") -> Column:
    return joined_text([city, state, country], ", ", default)


def epoch_millis(c: str | Column) -> Column:
    """Epoch milliseconds to timestamp."""
    return F.timestamp_millis(col(c).cast("bigint"))


def epoch_micros(c: str | Column) -> Column:
    return F.timestamp_micros(col(c).cast("bigint"))


def any_timestamp(c: str | Column) -> Column:
    """Text holding either epoch milliseconds or an ISO time to timestamp; anything else is null."""
    text = F.trim(col(c).cast("string"))
    return F.when(text.rlike(r"^-?\d{9,}$"), F.timestamp_millis(text.try_cast("bigint"))).otherwise(
        F.try_to_timestamp(text)
    )


def iso_text(c: str | Column) -> Column:
    return F.date_format(col(c), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def iso_timestamp(c: str | Column) -> Column:
    return F.try_to_timestamp(col(c))


def iso_date(c: str | Column) -> Column:
    """ISO date text to date, null when it is not one."""
    return col(c).try_cast("date")


def to_int(c: str | Column) -> Column:
    text = F.trim(col(c))
    return F.when(text.rlike(r"^[+-]?\d+$"), text.try_cast("bigint"))


def to_float(c: str | Column) -> Column:
    return F.trim(col(c)).try_cast("double")


def to_bool(c: str | Column) -> Column:
    """True for the texts in TRUE_TEXTS, false for other text, null for null."""
    return F.lower(col(c)).isin(*TRUE_TEXTS)


def clean_email(c: str | Column) -> Column:
    return F.lower(F.trim(col(c)))


def title_case(c: str | Column) -> Column:
    """First letter of each blank-separated word in upper case, the rest in lower case."""
    return F.initcap(col(c))


def mask_email(c: str | Column) -> Column:
    """Stable pseudonym of an address; null for a missing or empty one."""
    return F.concat(F.lit("user_"), F.substring(F.md5(_non_empty(c)), 1, 8), F.lit("@masked.com"))


def mask_hash(c: str | Column) -> Column:
    return F.sha2(col(c).cast("string"), 256)


def mask_redact(c: str | Column, text: str = "***") -> Column:
    return F.when(col(c).isNotNull(), F.lit(text))


def mask_partial(c: str | Column, keep: int = 4) -> Column:
    """Keep the last ``keep`` characters, replace every other one by ``*``."""
    s = col(c).cast("string")
    hidden = F.greatest(F.length(s) - F.lit(keep), F.lit(0))
    return F.concat(F.repeat(F.lit("*"), hidden), F.substring(s, hidden + 1, F.length(s)))


def human_bytes(c: str | Column) -> Column:
    """Size text with two decimals, in the largest unit that keeps the number under 1024."""
    size = col(c).cast("double")
    out = None
    for i, unit in enumerate(BYTE_UNITS):
        # ties go to the even digit
        number = F.bround(size / F.lit(float(1024**i)), 2)
        text = F.concat(F.format_string("%.2f", number), F.lit(f" {unit}"))
        last = i == len(BYTE_UNITS) - 1
        if out is None:
            out = F.when(size < 1024.0, text)
        elif last:
            out = out.otherwise(text)
        else:
            out = out.when(size < float(1024 ** (i + 1)), text)
    return F.when(size.isNotNull(), out)


def event_id(*parts: str | Column) -> Column:
    """Deterministic event id: replaying the same position yields the same id."""
    return F.md5(F.concat_ws("-", *[col(p).cast("string") for p in parts]))


def default_on_missing(c: str | Column, default) -> Column:
    return F.coalesce(col(c), F.lit(default))


def map_value(m: str | Column, key: str, default=None) -> Column:
    got = F.try_element_at(col(m), F.lit(key))
    return got if default is None else F.coalesce(got, F.lit(default))
