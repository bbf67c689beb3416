"""Stop-tag pattern (full-match semantics).

A tag is dropped when the whole tag matches either
  (a) a concatenation, in the listed order, of zero or more repeats of each stop
      literal - this alternative also matches the empty tag - or
  (b) a year 19xx / 20xx followed by any number of the character 年.
Reversed orders (e.g. "nulldv") are kept, as are years embedded in longer tags.
"""

from __future__ import annotations

import re

# The built-in stop literals, in the order the pattern lists them.
DEFAULT_STOP_TERMS: tuple[str, ...] = ("优酷", "原创", "拍客", "自拍", "视频", "牛人", "dv", "null")

# Fixed value: the year alternative of the stop pattern.
YEAR_PATTERN = r"(20|19)\d\d(年)*"


def stop_pattern(stop_terms=DEFAULT_STOP_TERMS, drop_years: bool = True) -> str:
    """Unanchored pattern; callers must apply it as a *full* match."""
    concat = "".join(f"({re.escape(t)})*" for t in stop_terms)
    alternatives = [concat] + ([YEAR_PATTERN] if drop_years else [])
    return "|".join(alternatives)


def spark_full_match(pattern: str) -> str:
    """Spark's ``rlike`` searches; anchor with \\A ... \\z for a whole-string match."""
    return rf"\A(?:{pattern})\z"


def stop_charset(stop_terms=DEFAULT_STOP_TERMS, drop_years: bool = True) -> str:
    """Every character a stop tag can contain. A tag with any other character cannot
    match the pattern, so ``translate(tag, charset, '') = ''`` is a cheap necessary
    condition checked before the regex."""
    chars = set("".join(stop_terms))
    if drop_years:
        chars |= set("0123456789年")
    return "".join(sorted(chars))


def stop_starts(stop_terms=DEFAULT_STOP_TERMS, drop_years: bool = True) -> list[str]:
    """What the first character of a stop tag can be, "" for the empty tag: cheaper still, it
    rules out most tags before their other characters are looked at."""
    return sorted({"", *(t[:1] for t in stop_terms), *("12" if drop_years else "")})
