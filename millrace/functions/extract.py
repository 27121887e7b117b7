"""Column expressions of the extraction side: lexicon hits, time stamps, authors, ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import fixed
from .text import SPACE, WORD, strip


def lexicon_pattern(terms: tuple[fixed.Term, ...] = fixed.LEXICON) -> str:
    """One alternation over lower-cased text, in lexicon order, behind a test of the first letter."""
    alternatives = []
    for t in terms:
        p = t.pattern.lower()
        alternatives.append(rf"(?<![{WORD}]){p}(?![{WORD}])" if t.whole_word else p)
    first = "".join(sorted({t.pattern[0].lower() for t in terms}))
    return f"(?=[{first}])(?:{'|'.join(alternatives)})"


def lexicon_hits(text: Column, terms: tuple[fixed.Term, ...] = fixed.LEXICON) -> Column:
    """Distinct matches, lower-cased and sorted by code point."""
    return F.array_sort(F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(lexicon_pattern(terms)), F.lit(0))))


def post_text(title: Column, content: Column) -> Column:
    return F.concat(F.coalesce(title, F.lit("")), F.lit(" "), F.coalesce(content, F.lit("")))


_STAMP = rf"(?i)([A-Z]{{3}})[{SPACE}]+(\p{{Nd}}{{1,2}}),[{SPACE}]+(\p{{Nd}}{{4}})[{SPACE}]*[•·][{SPACE}]*(\p{{Nd}}{{1,2}}):(\p{{Nd}}{{2}})[{SPACE}]*(AM|PM)"


def parse_stamp(text: Column) -> Column:
    """``Jan 12, 2012 • 4:11 PM`` as ``2012-01-12T16:11:00``; anything else is an empty string. No calendar check."""
    part = lambda i: F.regexp_extract(text, _STAMP, i)
    number = lambda i: F.coalesce(part(i).try_cast("int"), F.lit(0))
    month = F.array_position(F.array(*[F.lit(m.lower()) for m in fixed.MONTHS]), F.lower(part(1))).cast("int")
    hour = number(4) % 12 + F.when(F.upper(part(6)) == "PM", 12).otherwise(0)
    stamp = F.format_string("%04d-%02d-%02dT%02d:%02d:00", number(3), month, number(2), hour, number(5))
    return F.when(F.coalesce(month, F.lit(0)) > 0, stamp).otherwise(F.lit(""))


_INACTIVE = rf"(?i)[{SPACE}]*\([{SPACE}]*inactive[{SPACE}]*\)[{SPACE}]*\z"


def author_name(raw: Column) -> Column:
    return strip(F.regexp_replace(strip(F.coalesce(raw, F.lit(""))), _INACTIVE, ""))


def author_inactive(raw: Column) -> Column:
    return strip(F.coalesce(raw, F.lit(""))).rlike(_INACTIVE)


def is_staff(author: Column, staff: tuple[str, ...]) -> Column:
    return F.lower(strip(author)).isin(*staff) if staff else F.lit(False)


def last_segment(url: Column) -> Column:
    """What follows the last slash, trailing slashes aside: a thread's id, a topic's slug."""
    return F.element_at(F.split(F.regexp_replace(url, r"/+\z", ""), "/", -1), -1)


def first_number(text: Column) -> Column:
    return F.coalesce(F.regexp_extract(F.coalesce(text, F.lit("")), r"(\p{Nd}+)", 1).try_cast("int"), F.lit(0))
