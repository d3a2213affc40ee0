"""Expressions that turn raw text columns into typed ones; anything unreadable becomes NULL."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spellings that mean "missing" after trimming.
UNKNOWN_TOKENS = ["Unknown", "unknown", "UNKNOWN", ""]

# Cell texts a reader treats as missing. The two-letter code NA is a real continent
# and country code, so it is only part of the compatible preset.
NA_TOKENS = ["", "N/A", "null", "NaN"]
NA_TOKENS_COMPAT = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# Date layouts tried in turn.
DATE_FORMATS = ["yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd", "MM/dd/yyyy"]

_WHITESPACE = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000"
    + "".join(chr(code) for code in range(0x2000, 0x200B)))
_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def strip(text: Column) -> Column:
    """Trim every kind of whitespace, not only spaces."""
    return F.trim(text, F.lit(_WHITESPACE))


def null_if(text: Column, tokens: Iterable[str]) -> Column:
    return F.when(~text.isin(list(tokens)), text)


def null_unknown(text: Column, tokens: Iterable[str] = UNKNOWN_TOKENS) -> Column:
    return null_if(strip(text), tokens)


def to_number(text: Column) -> Column:
    """Double or NULL. The guard keeps out suffixed literals such as ``1d``, which a cast accepts."""
    trimmed = strip(text)
    return F.when(trimmed.rlike(_NUMBER), trimmed.try_cast("double"))


def to_whole(text: Column) -> Column:
    """Bigint or NULL; fractional values are not whole numbers."""
    number = to_number(text)
    return F.when(number == F.floor(number), number.try_cast("bigint"))


# Layout parts of fixed width; all other characters stand for themselves.
_FIXED_PARTS = ["yyyy", "MM", "dd", "HH", "mm", "ss"]


# Digit shape of a moment with a fraction of a second, a zone, or both.
_FINE_SHAPE = r"^0000-00-00[T ]00:00:00(\.0{1,9}|(\.0{1,9})? ?(Z|[+-]00(:?00)?))$"


def _shape(layout: str) -> str | None:
    """The layout with a 0 for every digit, or None when its width can vary."""
    shape = layout
    for part in _FIXED_PARTS:
        shape = shape.replace(part, "0" * len(part))
    shape = shape.replace("'T'", "\N{SECTION SIGN}")
    return None if re.search("[A-Za-z']", shape) else shape.replace("\N{SECTION SIGN}", "T")


def to_timestamp_any(text: Column, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """The first layout that fits. A text is only parsed by layouts of its own digit shape, because
    a failing parse costs far more than comparing shapes. Moments with a fraction of up to nine digits (cut to
    microseconds) or a zone are read whatever the layouts; without a zone they are in the session's."""
    shape = F.translate(text, "123456789", "000000000")
    tries = []
    for layout in formats:
        parsed = F.try_to_timestamp(text, F.lit(layout))
        fixed = _shape(layout)
        tries.append(F.when(shape == fixed, parsed) if fixed else parsed)
    tries.append(F.when(shape.rlike(_FINE_SHAPE), text.try_cast("timestamp")))
    return F.coalesce(*tries)


def map_values(value: Column, mapping: Mapping) -> Column:
    """Value lookup; anything not in the mapping becomes NULL."""
    (first, result), *others = mapping.items()
    mapped = F.when(value == F.lit(first), F.lit(result))
    for key, other in others:
        mapped = mapped.when(value == F.lit(key), F.lit(other))
    return mapped


def ordinal(value: Column, levels: Sequence[str]) -> Column:
    """Position of an ordered level, NULL outside the levels."""
    return map_values(value, {level: rank for rank, level in enumerate(levels)})


def extract_whole(text: Column, pattern: str, group: int = 1) -> Column:
    found = F.regexp_extract(text, pattern, group)
    return F.when(found != "", found).try_cast("int")


def split_list(text: Column, drop: Iterable[str] = UNKNOWN_TOKENS) -> Column:
    """Comma list to array: trimmed, without blanks and unknown tokens; NULL gives an empty array."""
    gone = list(drop)
    parts = F.transform(F.split(text, ","), strip)
    return F.coalesce(F.filter(parts, lambda p: ~p.isin(gone)), F.array().cast("array<string>"))


def split_quoted_list(text: Column) -> Column:
    """Comma list that may be wrapped in double quotes to array, without blanks."""
    parts = F.transform(F.split(F.trim(text, F.lit('"')), r",\s*"), strip)
    return F.coalesce(F.filter(parts, lambda p: p != ""), F.array().cast("array<string>"))


def parse_list_literal(text: Column) -> Column:
    """Bracketed list text to array; plain comma text is split; NULL or blank gives an empty array."""
    parsed = F.from_json(text, "array<string>")
    fallback = F.filter(F.transform(F.split(text, ","), strip), lambda p: p != "")
    return (
        F.when(text.isNull() | text.isin("", "[]"), F.array().cast("array<string>"))
        .otherwise(F.coalesce(parsed, fallback)))


def epoch_to_timestamp(epoch: Column) -> Column:
    """Epoch seconds, or milliseconds when the number is too large for seconds; NULL outside years 1 to 9999."""
    millis = F.timestamp_millis(epoch.cast("bigint"))
    seconds = F.timestamp_micros((epoch * 1_000_000).cast("bigint"))
    return F.when((epoch > 1e11) & (epoch < 253_402_300_800_000), millis).when(
        (epoch >= -62_135_596_800) & (epoch <= 1e11), seconds)


def concat_text(*texts: Column) -> Column:
    """Space-joined text; a NULL part counts as empty text and keeps its separator."""
    pieces: list[Column] = []
    for text in texts:
        if pieces:
            pieces.append(F.lit(" "))
        pieces.append(F.coalesce(text, F.lit("")))
    return F.concat(*pieces)


def join_arrays(*arrays: Column, separator: str = " ") -> Column:
    return F.array_join(F.concat(*arrays), separator)


def first_or(array: Column, default: str) -> Column:
    return F.coalesce(strip(F.get(array, F.lit(0))), F.lit(default))
