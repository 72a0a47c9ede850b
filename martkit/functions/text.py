"""Label cleaning and normalising."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# All Unicode white space; the \s of a JVM pattern is ASCII-only.
WHITE = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
_SPACES = f"[{WHITE}]+"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def squeeze(c: Column | str) -> Column:
    """Whitespace runs become one blank, ends trimmed."""
    return F.trim(F.regexp_replace(_col(c), _SPACES, " "))


def squeeze_or_null(c: Column | str) -> Column:
    return F.nullif(squeeze(c), F.lit(""))


def normalise_header(c: Column | str) -> Column:
    return F.coalesce(F.lower(squeeze(c)), F.lit(""))


def header_key(name: str | None) -> str:
    """Driver-side twin of :func:`normalise_header`, for the handful of names in a file header."""
    return re.sub(r"\s+", " ", name or "").strip().lower()


def strip(c: Column | str) -> Column:
    return F.btrim(_col(c), F.lit(WHITE))


def strip_or_null(c: Column | str) -> Column:
    return F.nullif(strip(c), F.lit(""))


def squash(c: Column | str) -> Column:
    """Lower case with all whitespace removed."""
    return F.lower(F.regexp_replace(_col(c), _SPACES, ""))


def mentions(c: Column | str, key: str) -> Column:
    return squash(c).contains(key)


def default_label(c: Column | str, default: str) -> Column:
    """Null or blank text becomes ``default``; other text is trimmed of blanks."""
    return F.coalesce(F.nullif(F.btrim(_col(c)), F.lit("")), F.lit(default))


def member_label(c: Column | str, groups: Mapping[str, Sequence[str]], default: str) -> Column:
    """Label of the group whose (lower-case) spellings hold the value, else ``default``."""
    key = F.lower(F.btrim(_col(c)))
    out = None
    for label, spellings in groups.items():
        hit = key.isin(*spellings)
        out = F.when(hit, label) if out is None else out.when(hit, label)
    return out.otherwise(default)


def _lookup(key: Column, table: Mapping[str, str]) -> Column:
    pairs = [F.lit(x) for item in table.items() for x in item]
    return F.try_element_at(F.create_map(*pairs), key)


def canonical_synonym(c: Column | str, synonyms: Mapping[str, str], default: str) -> Column:
    """Known spellings map to one value; others keep their trimmed text; blank gives ``default``."""
    text = F.btrim(_col(c))
    return F.coalesce(_lookup(F.lower(text), synonyms), F.nullif(text, F.lit("")), F.lit(default))


def last_segment(c: Column | str, delimiter: str = ",") -> Column:
    """Trimmed text behind the last delimiter; the whole text when there is none."""
    return F.btrim(F.substring_index(_col(c), delimiter, -1))


def aliased_segment(
    c: Column | str, aliases: Mapping[str, str], default: str, delimiter: str = ","
) -> Column:
    """Last segment with its code spelled out, ``default`` when nothing is left."""
    segment = last_segment(c, delimiter)
    return F.coalesce(_lookup(segment, aliases), F.nullif(segment, F.lit("")), F.lit(default))


def shorten(c: Column | str, replacements: Sequence[tuple[str, str]]) -> Column:
    """Replace the first occurrence of each text, in the given order."""
    out = _col(c)
    for old, new in replacements:
        at = F.locate(old, out)
        out = F.when(at > 0, F.overlay(out, F.lit(new), at, F.lit(len(old)))).otherwise(out)
    return out
