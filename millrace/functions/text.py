"""Text cleaning as Column expressions: mojibake, Unicode folding, link, e-mail and phone masks, white space.

The order of the whole chain is part of its meaning; clean_text() in plans.clean applies
it. All functions expect non-null text (coalesce first) and give null for null.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable
from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import fixed

#: White space, word characters and word boundaries, spelled out: Java's own classes differ.
SPACE = r"\t\n\x0B\f\r \x1C-\x1F\x85\xA0  -     　"
WORD = r"\p{L}\p{N}_"
BOUNDARY = rf"(?:(?<=[{WORD}])(?![{WORD}])|(?<![{WORD}])(?=[{WORD}]))"

_NOT_IN_URL = rf"{SPACE}<>\"'\)\]}}"
URL = rf"(?i)https?://[^{_NOT_IN_URL}]+"
BARE_URL = rf"(?i){BOUNDARY}www\.[a-z0-9][a-z0-9.-]*\.[a-z]{{2,}}(?:/[^{_NOT_IN_URL}]*)?"
EMAIL = rf"[{WORD}.+-]+@[{WORD}-]+\.[{WORD}.]{{2,}}"
PHONE = rf"{BOUNDARY}(?:\+?1[-. ]?)?\(?\p{{Nd}}{{3}}\)?[-. ]\p{{Nd}}{{3}}[-. ]\p{{Nd}}{{4}}{BOUNDARY}"


def fix_mojibake(text: Column) -> Column:
    """Undo common double encodings; text without a telltale letter is left alone at once."""
    fixed_text = reduce(lambda t, pair: F.replace(t, F.lit(pair[0]), F.lit(pair[1])), fixed.MOJIBAKE, text)
    return F.when(text.rlike("[ÂÃâ]"), fixed_text).otherwise(text)


@F.pandas_udf(T.StringType())
def nfc(text: pd.Series) -> pd.Series:
    """Unicode NFC, which Spark has no expression for; ASCII passes through."""
    return text.map(lambda t: t if t is None or t.isascii() else unicodedata.normalize("NFC", t))


def fold_unicode(text: Column) -> Column:
    """Drop zero-width characters; plain spaces, quotes and dots for exotic ones. Expects NFC."""
    text = F.regexp_replace(text, fixed.ZERO_WIDTH, "")
    singles, doubles, spaces = fixed.SINGLE_QUOTES, fixed.DOUBLE_QUOTES, fixed.EXOTIC_SPACES
    text = F.translate(text, spaces + singles + doubles, " " * len(spaces) + "'" * len(singles) + '"' * len(doubles))
    return F.replace(text, F.lit("…"), F.lit("..."))


def count_emoji(text: Column) -> Column:
    return F.regexp_count(text, F.lit(fixed.EMOJI))


def _may_match(text: Column, pattern: str) -> Column:
    """A cheap test that every text with a match passes."""
    if pattern == BARE_URL:
        return F.lower(text).contains("www.")
    return text.contains({URL: "://", EMAIL: "@"}.get(pattern, ""))


def matches(text: Column, pattern: str) -> Column:
    """All matches; the pattern runs only where it can match at all. A null text has null matches."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return F.when(_may_match(text, pattern) | text.isNull(), found).otherwise(F.array().cast("array<string>"))


def mask_with(text: Column, pattern: str, token: Callable[[Column], Column]) -> Column:
    """Replace every match by a value computed from it: what lies between, interleaved with the tokens."""
    between = F.split(text, pattern, -1)
    tokens = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), token)
    masked = F.array_join(F.zip_with(between, tokens, lambda s, t: F.concat(s, F.coalesce(t, F.lit("")))), "")
    return F.when(_may_match(text, pattern), masked).otherwise(text)


def trim_url(url: Column) -> Column:
    """Without the punctuation that ends the sentence rather than the URL."""
    return F.regexp_replace(url, r"[.,;:!?]+\z", "")


def domain_of(url: Column) -> Column:
    host = F.regexp_extract(url, rf"(?i)^(?:https?://)?([^/{SPACE}:]+)", 1)
    return F.regexp_replace(F.lower(host), r"^www\.", "")


def _link_token(url: Column) -> Column:
    domain = domain_of(trim_url(url))
    return F.when(domain == "", F.lit("[URL]")).otherwise(F.concat(F.lit("[URL:"), domain, F.lit("]")))


def mask_urls(text: Column) -> Column:
    return mask_with(text, URL, _link_token)


def mask_bare_urls(text: Column) -> Column:
    return mask_with(text, BARE_URL, _link_token)


def links_in(text: Column, after_urls: Column) -> Column:
    """(domain, url) of every link: those with a scheme in order, then the bare ones of the text masked so far."""
    found = F.concat(matches(text, URL), matches(after_urls, BARE_URL))
    return F.transform(found, lambda u: F.struct(domain_of(trim_url(u)).alias("domain"), trim_url(u).alias("url")))


def email_domain(address: Column) -> Column:
    return F.regexp_replace(F.lower(F.regexp_extract(address, "(?s)^[^@]*@(.*)$", 1)), r"\.+\z", "")


def mask_emails(text: Column, personal: tuple[str, ...] | list[str] = tuple(fixed.PERSONAL_MAIL)) -> Column:
    return mask_with(text, EMAIL, lambda a: F.when(email_domain(a).isin(*personal), F.lit("[EMAIL]")).otherwise(F.lit("[EMAIL:ORG]")))


def email_domains(text: Column) -> Column:
    return F.transform(matches(text, EMAIL), email_domain)


def count_phones(text: Column) -> Column:
    return F.regexp_count(text, F.lit(PHONE))


def mask_phones(text: Column) -> Column:
    return F.regexp_replace(text, PHONE, "[PHONE]")


def strip(text: Column) -> Column:
    return F.regexp_replace(text, rf"\A[{SPACE}]+|[{SPACE}]+\z", "")


def tidy_whitespace(text: Column) -> Column:
    text = F.replace(F.replace(text, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))
    text = F.regexp_replace(text, " +\n", "\n")
    text = F.regexp_replace(text, " {2,}", " ")
    return strip(F.regexp_replace(text, "\n{3,}", "\n\n"))


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(f"[^{SPACE}]+"))


def author_hash(author: Column, salt: str) -> Column:
    """Twelve hex digits of a salted SHA-256; a missing author hashes as the word nan."""
    return F.left(F.sha2(F.concat(F.lit(salt), F.coalesce(author, F.lit("nan"))), 256), F.lit(12))
