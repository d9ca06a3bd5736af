"""Text normalisation, all as native column expressions."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Markers that stand for a missing value.
NA_MARKERS = ("", "NA", "N/A", "NaN", "NULL")
NA_MARKERS_BACKSLASH = (*NA_MARKERS, "\\N")

# Letters that do not decompose into a base letter and a mark.
LETTERS_WITHOUT_DECOMPOSITION = {
    "ß": "ss", "Æ": "AE", "æ": "ae", "Œ": "OE", "œ": "oe", "Ø": "O", "ø": "o",
    "Ł": "L", "ł": "l", "Đ": "D", "đ": "d", "Ð": "D", "ð": "d", "Þ": "Th",
    "þ": "th", "ı": "i", "‘": "'", "’": "'", "“": '"', "”": '"', "–": "-",
    "—": "--", "…": "...",
}

# Latin-1 signs and spaces and their usual ASCII spelling.
LATIN1_SIGNS = {
    "\u00a0": " ", "¡": "!", "¢": "C/", "£": "PS", "¤": "$?", "¥": "Y=", "¦": "|", "§": "SS", "¨": '"', "©": "(c)",
    "ª": "a", "«": "<<", "¬": "!", "\u00ad": "", "®": "(r)", "¯": "-", "°": "deg", "±": "+-", "²": "2", "³": "3",
    "´": "'", "µ": "u", "¶": "P", "·": "*", "¸": ",", "¹": "1", "º": "o", "»": ">>", "¼": " 1/4", "½": " 1/2",
    "¾": " 3/4", "¿": "?", "×": "x", "÷": "/",
}

# Blocks whose letters decompose: Latin-1 Supplement to Latin Extended-B, Latin Extended Additional.
_LATIN_BLOCKS = (range(0x00C0, 0x0250), range(0x1E00, 0x1F00))


def _base_letters() -> tuple[str, str]:
    """Accented Latin letters and their base letters, read off the Unicode data."""
    accented, plain = [], []
    for block in _LATIN_BLOCKS:
        for code in block:
            base = "".join(c for c in unicodedata.normalize("NFD", chr(code)) if not unicodedata.combining(c))
            if len(base) == 1 and base != chr(code):
                accented.append(chr(code))
                plain.append(base)
    return "".join(accented), "".join(plain)


_ACCENTED, _PLAIN = _base_letters()


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]


def squeeze(col: Column) -> Column:
    """One blank for each run of white space, none at the ends."""
    return F.trim(F.regexp_replace(col, r"\s+", " "))


def missing_if_marker(col: Column, markers: Iterable[str] = NA_MARKERS) -> Column:
    return F.when(~col.isin(list(markers)), col)


def _rewrite_strings(df: DataFrame, rewrite, columns: list[str] | None) -> DataFrame:
    targets = set(string_columns(df) if columns is None else columns)
    return df.select(*[rewrite(F.col(f"`{c}`")).alias(c) if c in targets else F.col(f"`{c}`") for c in df.columns])


def normalize_whitespace(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    return _rewrite_strings(df, squeeze, columns)


def nullify(df: DataFrame, markers: Iterable[str] = NA_MARKERS, columns: list[str] | None = None) -> DataFrame:
    markers = list(markers)
    return _rewrite_strings(df, lambda c: missing_if_marker(c, markers), columns)


def format_values(df: DataFrame, markers: Iterable[str] = NA_MARKERS) -> DataFrame:
    """Both steps over every string column in a single projection."""
    markers = list(markers)
    return _rewrite_strings(df, lambda c: missing_if_marker(squeeze(c), markers), None)


def fold_accents(col: Column, expand_letters: bool = True) -> Column:
    """Drop diacritics. ``expand_letters`` also spells out ß, Æ, ø, typographic quotes and Latin-1 signs.

    Text of plain ASCII is passed on after one quick look.
    """
    folded = _folded(col, expand_letters)
    return F.when(F.octet_length(col) == F.length(col), col).otherwise(folded)


def _folded(col: Column, expand_letters: bool) -> Column:
    marks_gone = F.regexp_replace(F.translate(col, _ACCENTED, _PLAIN), r"[\u0300-\u036F]", "")
    if not expand_letters:
        return marks_gone
    spelled = LETTERS_WITHOUT_DECOMPOSITION | LATIN1_SIGNS
    single = {k: v for k, v in spelled.items() if len(v) == 1}
    longer = {k: v for k, v in spelled.items() if len(v) != 1}
    short = F.translate(marks_gone, "".join(single), "".join(single.values()))
    return reduce(lambda c, kv: F.replace(c, F.lit(kv[0]), F.lit(kv[1])), longer.items(), short)


def shorten(col: Column, width: int = 30) -> Column:
    """Chart label: the first ``width`` characters and an ellipsis if cut."""
    return F.when(F.length(col) > width, F.concat(F.substring(col, 1, width), F.lit("..."))).otherwise(col)


def pair_label(left: Column, right: Column) -> Column:
    return F.concat(left, F.lit(" & "), right)
