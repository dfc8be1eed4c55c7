"""Text extraction and formatting on built-in expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F


_MARK = "\u0001 "


def concat_skip_null(*parts: Column) -> Column:
    """Concatenation that reads NULL as empty text; ``F.concat`` gives NULL instead."""
    return F.concat(*[F.coalesce(part.cast("string"), F.lit("")) for part in parts])


def extract(text: Column, pattern: str, group: int = 1) -> Column:
    """One capture group of the first match, NULL without a match. ``.`` also fits a line break."""
    # regexp_extract gives '' without a match, and testing for that would run the pattern twice.
    return F.get(F.regexp_extract_all(text, F.lit(f"(?s){pattern}"), F.lit(group)), 0)


def extract_last(text: Column, key: str) -> Column:
    """The last non-empty quoted value of a ``key`` such as ``"message":``, NULL if there is none.

    Cutting the text at the last key is a plain search. Only where no value follows that key does a
    pattern look for an earlier one; its anchor keeps it from trying every start of a long text.
    """
    after_last = extract(F.substring_index(text, key, -1), r'^\s*"([^"]+)"')
    earlier = extract(text, rf'^.*{re.escape(key)}\s*"([^"]+)"')
    return F.when(F.contains(text, F.lit(key)), F.coalesce(after_last, earlier))


def marked(text: Column, pattern: str) -> Column:
    """``ILIKE``, after a plain search for the longest literal piece of a pattern with several."""
    pieces = [piece for piece in pattern.split("%") if piece and not set(piece) & {"_", "\\"}]
    liked = F.ilike(text, F.lit(pattern))
    if pattern.strip("%").count("%") == 0 or not pieces:
        return liked
    return F.contains(F.lower(text), F.lit(max(pieces, key=len).lower())) & liked


def code_and_message(text: Column, pattern: str) -> Column:
    """``code -> message`` from a pattern with two groups, NULL when it does not match."""
    # The text is searched once; both groups are cut out of the matched piece.
    piece = F.regexp_substr(text, F.lit(f"(?s){pattern}"))
    return F.concat(extract(piece, pattern, 1), F.lit(" -> "), extract(piece, pattern, 2))


def between_markers(text: Column, before: str, after: str) -> Column:
    """The text after the first ``before`` and ahead of the next ``after``."""
    return extract(text, f"{re.escape(before)}(.*?){re.escape(after)}")


def looks_like_object(text: Column) -> Column:
    """Starts with ``{`` and ends with ``}``."""
    return F.startswith(text, F.lit("{")) & F.endswith(text, F.lit("}"))


def grouped_digits(number: Column, places: int = 0) -> Column:
    """Thousands separators, rounded half up (``format_number`` alone rounds half to even)."""
    return F.format_number(F.round(number, places), places)


def two_decimals(number: Column) -> Column:
    """Text with exactly two decimals, rounded half up."""
    return F.round(number, 2).cast("decimal(38,2)").cast("string")


def title_words(text: Column) -> Column:
    """Words joined by single blanks, every letter after a non-letter in upper case."""
    # initcap knows blanks as word ends only, so a marked blank is put behind every other one.
    parted = F.regexp_replace(text, r"(?<=\P{L})(?=\p{L})", _MARK)
    titled = F.replace(F.initcap(parted), F.lit(_MARK), F.lit(""))
    return F.trim(F.regexp_replace(titled, r"(?U)\s+", " "))


def contains_first(text: Column, labels: dict[str, str]) -> Column:
    """Label of the first key, in the given order, that occurs in ``text``."""
    ladder = F
    for key, label in labels.items():
        ladder = ladder.when(F.contains(text, F.lit(key)), F.lit(label))
    return ladder
