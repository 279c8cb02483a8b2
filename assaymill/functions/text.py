"""Text functions (PRJ5-PRJ7, PRJ16, FLT6)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import fixed_values as fixed

# The code points that count as white space (Unicode white space and the four ASCII
# separators). Listed, because a listed class is matched several times faster than a Unicode one.
_OTHER_SPACE = (r"\t-\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000")
_SPACE = f"[ {_OTHER_SPACE}]"
_EDGES = f"^{_SPACE}+|{_SPACE}+$"
# Only what has to change: a run of two or more, or a single one that is not a plain blank. Text
# that is already clean is scanned but never rebuilt.
_RUNS = f"[{_OTHER_SPACE}]{_SPACE}*| {_SPACE}+"
# Visible ASCII words with single blanks between: nothing to collapse, told without trying both kinds of
# run at every character.
_PLAIN = r"^[!-~]++(?: [!-~]++)*+\z"


def strip(c: Column) -> Column:
    """PRJ5: drop leading and trailing white space of any kind."""
    return F.regexp_replace(c, _EDGES, "")


def collapse_spaces(c: Column) -> Column:
    """PRJ7: every run of white space becomes one blank."""
    return F.regexp_replace(c, _RUNS, " ")


def standardize(c: Column, lower: bool = True) -> Column:
    """PRJ5-PRJ7 together: strip, lower-case (optional), collapse.

    Plain words between blanks are only trimmed. For other texts, collapsing first turns every edge run
    into one plain blank, which ``trim`` removes without a second regular expression.
    """
    text = c.cast("string")
    trimmed = F.trim(text)
    clean = F.when(trimmed.rlike(_PLAIN), trimmed).otherwise(F.trim(collapse_spaces(text)))
    return F.lower(clean) if lower else clean


def contains_any(c: Column, words: Sequence[str]) -> Column:
    """Case-insensitive substring test; null counts as no (``words`` in lower case)."""
    text = F.lower(c)
    hit = F.lit(False)
    for w in words:
        hit = hit | text.contains(w)
    return F.coalesce(hit, F.lit(False))


def is_finished(c: Column) -> Column:
    """FLT6: the status mentions one of the finished words."""
    return contains_any(c, fixed.FINISHED_WORDS)


def composite_code(*columns: Column | str) -> Column:
    """PRJ16: key parts joined by ``-``."""
    parts = [F.col(c) if isinstance(c, str) else c for c in columns]
    return F.concat_ws("-", *[p.cast("string") for p in parts])
