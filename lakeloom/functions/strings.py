"""String functions with Python's conventions: 0-based places, -1 where absent."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _pattern(pat: str, case: bool = True, regex: bool = True) -> str:
    body = pat if regex else re.escape(pat)
    return body if case else f"(?i){body}"


def capitalize(c: Column) -> Column:
    """First character upper, the rest lower."""
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substr(c, F.lit(2))))


def cat(c: Column, others: list[Column], sep: str = "", na_rep: str | None = None) -> Column:
    """Row-wise join with other columns; a NULL of those is skipped or stands as na_rep. A NULL c gives NULL."""
    rest = others if na_rep is None else [F.coalesce(o, F.lit(na_rep)) for o in others]
    base = c if na_rep is None else F.coalesce(c, F.lit(na_rep))
    return F.when(base.isNotNull(), F.concat_ws(sep, base, *rest))


def contains(c: Column, pat: str, case: bool = True, regex: bool = True) -> Column:
    """Regular expression search, or a literal one."""
    return c.rlike(_pattern(pat, case, regex)) if regex or not case else F.contains(c, F.lit(pat))


def count(c: Column, pat: str, case: bool = True) -> Column:
    """Matches that don't overlap."""
    return F.regexp_count(c, F.lit(_pattern(pat, case)))


def extract(c: Column, pat: str, group: int = 0, case: bool = True) -> Column:
    """The group of the first match anywhere; NULL without one."""
    p = _pattern(pat, case)
    return F.when(c.rlike(p), F.regexp_extract(c, p, group))


def find(c: Column, sub: str, start: int = 0, end: int | None = None) -> Column:
    """First place at or after start, or -1."""
    within = c if end is None else F.substring(c, 1, end)
    return F.locate(sub, within, start + 1) - 1


def rfind(c: Column, sub: str, start: int = 0, end: int | None = None) -> Column:
    """Last place, or -1."""
    within = c if end is None else F.substring(c, 1, end)
    at = F.locate(sub[::-1], F.reverse(within))
    place = F.length(within) - at - len(sub) + 1
    return F.when(c.isNull(), None).when((at > 0) & (place >= start), place).otherwise(F.lit(-1))


def replace(c: Column, pat: str, repl: str, n: int = -1, case: bool = True, regex: bool = True) -> Column:
    """Replacement of all matches, or of the first n; backslash groups as in Python."""
    p = _pattern(pat, case, regex)
    new = re.sub(r"\\(\d)", r"$\1", repl) if regex else repl.replace("\\", "\\\\").replace("$", "\\$")
    if n < 0:
        return F.regexp_replace(c, p, new)
    out = c
    for _ in range(n):  # one more occurrence each time, marked so that it isn't met again
        out = F.regexp_replace(out, f"(?s)^((?:.*\\x00)?)((?:(?!{p}).)*+){p}", f"$1$2{new}\\\x00")
    return F.regexp_replace(out, "\\x00", "")


def get(c: Column, i: int) -> Column:
    """The character at a 0-based place; negative counts from the end."""
    return F.substring(c, i + 1 if i >= 0 else i, 1)


def join_characters(c: Column, sep: str) -> Column:
    """The characters with sep between them."""
    return F.array_join(F.split(c, ""), sep)


def ljust(c: Column, width: int, fill: str = " ") -> Column:
    """Padded on the right, never cut."""
    return F.concat(c, F.repeat(F.lit(fill), F.greatest(F.lit(0), width - F.length(c))))


def rjust(c: Column, width: int, fill: str = " ") -> Column:
    """Padded on the left, never cut."""
    return F.concat(F.repeat(F.lit(fill), F.greatest(F.lit(0), width - F.length(c))), c)


def pad(c: Column, width: int, side: str = "left", fill: str = " ") -> Column:
    """Padded on a side, or on both with the odd character on the right."""
    if side == "left":
        return rjust(c, width, fill)
    if side == "right":
        return ljust(c, width, fill)
    gap = F.greatest(F.lit(0), width - F.length(c))
    left = F.floor(gap / 2).cast("int")
    return F.concat(F.repeat(F.lit(fill), left), c, F.repeat(F.lit(fill), (gap - left).cast("int")))


def zfill(c: Column, width: int) -> Column:
    """Zeros on the left; a sign is not looked at."""
    return rjust(c, width, "0")


def strip(c: Column, chars: str = " ") -> Column:
    """Without these characters at both ends."""
    return F.trim(c, F.lit(chars))


def lstrip(c: Column, chars: str = " ") -> Column:
    """Without these characters at the start."""
    return F.ltrim(c, F.lit(chars))


def rstrip(c: Column, chars: str = " ") -> Column:
    """Without these characters at the end."""
    return F.rtrim(c, F.lit(chars))


def split(c: Column, pat: str, n: int = -1) -> Column:
    """Pieces between a literal separator, at most n cuts."""
    return F.split(c, re.escape(pat), n + 1 if n >= 0 else -1)


def rsplit(c: Column, pat: str, n: int = -1) -> Column:
    """Pieces between a literal separator, at most n cuts from the right."""
    parts = F.split(c, re.escape(pat), -1)
    if n < 0:
        return parts
    k = F.size(parts)
    head = F.array_join(F.slice(parts, F.lit(1), k - n), pat)
    return F.when(k <= n + 1, parts).otherwise(F.concat(F.array(head), F.slice(parts, k - n + 1, F.lit(n))))


def repeat(c: Column, n) -> Column:
    """c n times; n may be a column."""
    return F.repeat(c, n)


def slice_(c: Column, start: int | None = None, stop: int | None = None, step: int | None = None) -> Column:
    """Python's slice of the characters; step is positive."""
    n = F.length(c)
    place = lambda x, other: other if x is None else (F.least(F.lit(x), n) if x >= 0 else F.greatest(n + x, F.lit(0)))
    a, b = place(start, F.lit(0)), place(stop, n)
    out = F.substr(c, a + 1, F.greatest(b - a, F.lit(0)))
    if step in (None, 1):
        return out
    return F.array_join(F.filter(F.split(out, ""), lambda _, i: i % step == 0), "")


def swapcase(c: Column) -> Column:
    """Upper and lower of A-Z swapped."""
    small = "abcdefghijklmnopqrstuvwxyz"
    return F.translate(c, small + small.upper(), small.upper() + small)


@F.pandas_udf(T.StringType())
def title(s: pd.Series) -> pd.Series:
    """Python's title case: each run of letters capitalised."""
    return s.str.title()


@F.pandas_udf(T.BooleanType())
def is_title(s: pd.Series) -> pd.Series:
    """Python's test for title case."""
    return s.map(lambda x: None if x is None else x.istitle())


def is_alnum(c: Column) -> Column:
    """Letters and digits only, and some."""
    return c.rlike(r"^[\p{L}\p{N}]+$")


def is_alpha(c: Column) -> Column:
    """Letters only, and some."""
    return c.rlike(r"^\p{L}+$")


def is_digit(c: Column) -> Column:
    """Decimal digits or superscripts only, and some."""
    return c.rlike("^[\\p{Nd}\u00b2\u00b3\u00b9\u2070-\u2079\u2080-\u2089]+$")


def is_numeric(c: Column) -> Column:
    """Numbers of any kind only, and some."""
    return c.rlike(r"^\p{N}+$")


def is_decimal(c: Column) -> Column:
    """Decimal digits only, and some."""
    return c.rlike(r"^\p{Nd}+$")


def is_space(c: Column) -> Column:
    """Blanks only, and some."""
    return c.rlike(r"^\s+$")


def is_lower(c: Column) -> Column:
    """A cased character and none upper."""
    return (c == F.lower(c)) & (c != F.upper(c))


def is_upper(c: Column) -> Column:
    """A cased character and none lower."""
    return (c == F.upper(c)) & (c != F.lower(c))


def to_dict(c: Column, item: str = ",", kv: str = "=") -> Column:
    """`k=v,k2=v2` as a map."""
    return F.str_to_map(c, F.lit(re.escape(item)), F.lit(re.escape(kv)))


#: Python's date directives and Spark's pattern letters.
DIRECTIVES = {
    "Y": "yyyy", "m": "MM", "d": "dd", "H": "HH", "I": "hh", "M": "mm", "S": "ss", "f": "SSSSSS", "y": "yy",
    "j": "DDD", "p": "a", "b": "MMM", "B": "MMMM", "a": "EEE", "A": "EEEE", "%": "%",
}


def date_pattern(fmt: str) -> str:
    """A Python date format as a Spark one; an unknown directive is an error."""
    out, i, plain = "", 0, ""
    while i < len(fmt):
        if fmt[i] == "%":
            out += (f"'{plain}'" if plain else "") + DIRECTIVES[fmt[i + 1]]
            plain, i = "", i + 2
        else:
            plain += "''" if fmt[i] == "'" else fmt[i]
            i += 1
    return out + (f"'{plain}'" if plain else "")


def strptime(c: Column, fmt: str) -> Column:
    """A timestamp from a Python format; NULL where it doesn't fit."""
    return F.try_to_timestamp(c, F.lit(date_pattern(fmt)))
