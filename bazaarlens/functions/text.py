"""Text, URL and display expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

PATH_SEPARATOR = " > "
KEY_SEPARATOR = "__"


def contains_any(text: Column, terms: Iterable[str]) -> Column:
    """True when any term occurs in the text (already lower-cased by the caller)."""
    found = F.lit(False)
    for term in terms:
        found = found | text.contains(term)
    return found


def joined_key(*parts: Column) -> Column:
    """Null as soon as one part is null, unlike ``concat_ws``."""
    pieces: list[Column] = []
    for part in parts:
        pieces += [part, F.lit(KEY_SEPARATOR)]
    return F.concat(*pieces[:-1])


def path_depth(path: Column) -> Column:
    parts = F.split(F.coalesce(path, F.lit("")), PATH_SEPARATOR, -1)
    return F.size(F.filter(parts, lambda p: p != "")).cast("bigint")


def csv_list(text: Column) -> Column:
    """Comma list to array: trimmed, without empty entries."""
    return F.filter(F.transform(F.split(text, ","), lambda p: F.trim(p)), lambda p: p != "")


def url_query_param(url: Column, name: str) -> Column:
    """First non-blank value of a query parameter, percent- and plus-decoded; null when absent.

    ``parse_url`` rejects the raw spaces that landed endpoints contain and does not decode. An
    undecodable escape leaves the raw value.
    """
    raw = F.regexp_extract(url, r"\?(?:[^#]*?&)?" + name + r"=([^&#]+)", 1)
    decoded = F.coalesce(F.try_url_decode(raw), raw)
    return F.when(raw != "", decoded)


def pt_thousands(value: Column) -> Column:
    """1234567 as ``1.234.567``."""
    return F.replace(F.format_number(value.cast("bigint"), 0), F.lit(","), F.lit("."))


def pt_compact(value: Column) -> Column:
    """Millions as ``1,2M``, thousands as ``3 mil``, smaller numbers in full."""
    number = value.cast("double")
    millions = F.format_string("%.1fM", F.rint(number / 1e5) / 10)
    thousands = F.format_string("%.0f mil", F.rint(number / 1e3))
    return (
        F.when(F.abs(number) >= 1e6, F.replace(millions, F.lit("."), F.lit(",")))
        .when(F.abs(number) >= 1e3, thousands)
        .otherwise(pt_thousands(number))
    )


def sentence(template: str, *values: Column) -> Column:
    """Fill the ``%s`` marks of a fixed sentence; a missing value reads ``None``."""
    texts = [F.coalesce(v.cast("string"), F.lit("None")) for v in values]
    return F.format_string(template, *texts)


# Separator, and escape: escape 0 is an escape, escape 1 a separator, and escape 2 alone a null.
_NEXT, _ESCAPE = "\x1f", "\x1b"


def packed(values: Iterable[Column]) -> Column:
    """Texts, some of them null, as one text: a row of many short columns is mostly lengths, offsets and padding.

    :func:`unpacked` gives them back. The texts are valid UTF-8.
    """
    escaped = (F.replace(F.replace(v, F.lit(_ESCAPE), F.lit(_ESCAPE + "0")), F.lit(_NEXT), F.lit(_ESCAPE + "1")) for v in values)
    return F.concat_ws(_NEXT, *(F.coalesce(text, F.lit(_ESCAPE + "2")) for text in escaped))


def unpacked(parts: Column, place: int) -> Column:
    """The text at a place, from 0, of a packed text that is split into its parts."""
    part = F.get(parts, F.lit(place))
    plain = F.replace(F.replace(part, F.lit(_ESCAPE + "1"), F.lit(_NEXT)), F.lit(_ESCAPE + "0"), F.lit(_ESCAPE))
    return F.when(part != _ESCAPE + "2", plain)


def packed_parts(text: Column) -> Column:
    return F.split(text, _NEXT)
