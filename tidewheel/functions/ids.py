"""Stream ids: `<ms>-<seq>`, both unsigned 64-bit, ordered as a pair of numbers and not as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_U64 = "decimal(20,0)"
MAX_U64 = 18446744073709551615


def _part(text: Column, group: int) -> Column:
    number = F.regexp_extract(text, r"^(\d{1,20})-(\d{1,20})$", group).try_cast(_U64)
    return F.when(number <= F.lit(str(MAX_U64)).cast(_U64), number)


def parse_id(text: Column) -> Column:
    """STRUCT<ms, seq>, which compares as the id does; null for what is no id. `0` is the id before all others."""
    ms, seq = _part(text, 1), _part(text, 2)
    zero = F.lit(0).cast(_U64)
    return F.when(text == "0", F.struct(zero.alias("ms"), zero.alias("seq"))).when(ms.isNotNull() & seq.isNotNull(), F.struct(ms.alias("ms"), seq.alias("seq")))


def is_valid_id(text: Column) -> Column:
    return parse_id(text).isNotNull()


def id_literal(text: str) -> Column:
    """A bound that was checked on the driver."""
    ms, seq = (0, 0) if text == "0" else map(int, text.split("-"))
    return F.struct(F.lit(str(ms)).cast(_U64).alias("ms"), F.lit(str(seq)).cast(_U64).alias("seq"))


def python_id(text: str | None) -> tuple[int, int] | None:
    """The same rule on the driver."""
    if text == "0":
        return (0, 0)
    ms, dash, seq = (text or "").partition("-")
    if not dash or not (ms.isascii() and ms.isdigit() and seq.isascii() and seq.isdigit()):
        return None
    pair = (int(ms), int(seq))
    return pair if max(pair) <= MAX_U64 else None
