"""URL filters: pattern rules indexed by their rarest literal token.

A rule is a verdict and either a host and path prefix (``allow example.com/en/7``) or a
regular expression over host + path. Every rule carries literal tokens that any URL it
fits must contain whole. Token counts over all URLs choose, for each rule, the rarest of
its tokens; the index maps that token to its rules. A URL's tokens fetch candidate rules
from the index, and regular expressions run for those alone.

All of it is column expressions: up to max_indexed rules the index is a map literal next
to the data and nothing is shuffled. Beyond that, rules are a table, joined on the token
of each distinct URL.

Defined cases: a null URL or one without :// has an empty host and path and fits no rule;
repeated rows are judged alike; empty tables give no rows. Extra columns are carried;
columns named like an output are replaced.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import apart, without

OUTPUTS = ("host", "path", "rule", "verdict", "pattern_rule")


@dataclass(frozen=True)
class Rule:
    verdict: str  # allow or block
    name: str
    pattern: str  # Java regular expression over host + path
    tokens: tuple[str, ...]  # lower-case literals, each a whole token of any URL that fits
    prefix: bool  # a host and path rule: the longest of these decides before any pattern


def prefix_rule(verdict: str, where: str) -> Rule:
    """The host and its subdomains, where the path starts as the rule's does."""
    host, slash, path = where.partition("/")
    tokens = re.findall(r"[a-z0-9]+", host.lower())
    # The last path token may go on in the URL, so it isn't literal unless a delimiter follows it.
    tokens += [t.lower() for t in re.findall(r"[A-Za-z0-9]+(?=[^A-Za-z0-9])", path)]
    return Rule(verdict, where, rf"^(?:[^/]*\.)?{_quoted(host + slash + path)}", tuple(tokens), True)


def _quoted(text: str) -> str:
    return re.sub(r"([^A-Za-z0-9/])", r"\\\1", text)


def pattern_rule(verdict: str, name: str, pattern: str, *tokens: str) -> Rule:
    return Rule(verdict, name, pattern, tokens, False)


#: Patterns of this filter's own: advertising, adult and gambling pages.
DEFAULT_PATTERNS = (
    pattern_rule("block", "ad-server", r"(?:^|\.)(?:ads|adserver)\.[^/]+", "ads"),
    pattern_rule("block", "ad-server-host", r"(?:^|\.)adserver\.[^/]+", "adserver"),
    pattern_rule("block", "banner-path", r"/banner/", "banner"),
    pattern_rule("block", "casino", r"(?:^|[./-])casino(?:[./-]|$)", "casino"),
    pattern_rule("block", "porn", r"(?:^|[./-])porn(?:[./-]|$)", "porn"),
    pattern_rule("block", "login-page", r"/login(?:\.[a-z]+)?/?$", "login"),
)


def host_of(url: Column) -> Column:
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(F.coalesce(host, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _tokens(place: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(place), F.lit(r"([a-z0-9]+)"), F.lit(1)))


def rarest_tokens(pages: DataFrame, rules: list[Rule], url_col: str = "url") -> dict[int, str]:
    """For each rule's index, its token in the fewest URLs. Counts come from every URL; one row per literal returns."""
    literals = sorted({t for r in rules for t in r.tokens})
    url = F.col(f"`{url_col}`")
    found = F.array_intersect(_tokens(F.concat(host_of(url), path_of(url))), F.array(*[F.lit(t) for t in literals]))
    counts = dict(pages.select(F.explode(found).alias("token")).groupBy("token").count().collect()) if literals else {}
    return {i: min(r.tokens, key=lambda t: (counts.get(t, 0), -len(t), t)) for i, r in enumerate(rules)}


_CANDIDATE = "struct<verdict:string,name:string,pattern:string,prefix:boolean,rank:int>"


def filter_urls(pages: DataFrame, rules: list[Rule], url_col: str = "url", default: str = "allow", max_indexed: int = 2000) -> DataFrame:
    """pages with host, path, rule (the prefix rule that decides), pattern_rule and verdict."""
    if any(not r.tokens for r in rules):
        raise ValueError("every rule needs a literal token")
    pages = without(pages, *OUTPUTS)
    url = F.col(f"`{url_col}`")
    at_place, at_hits, at_rule, at_pattern, at_url = apart(pages, "__place", "__hits", "__rule", "__pattern", "__url")
    index = rarest_tokens(pages, rules, url_col)
    place = F.concat(host_of(url), path_of(url))
    # Prefix rules first, the longest first; then patterns as listed.
    order = sorted(range(len(rules)), key=lambda i: (not rules[i].prefix, -len(rules[i].name) if rules[i].prefix else i, i))
    rows = [(index[i], (rules[i].verdict, rules[i].name, rules[i].pattern, rules[i].prefix, n)) for n, i in enumerate(order)]
    fits = lambda r: F.call_function("rlike", F.col(at_place), r["pattern"])
    if len(rows) <= max_indexed:
        by_token: dict[str, list] = {}
        for token, rule in rows:
            by_token.setdefault(token, []).append(rule)
        entry = lambda r: F.struct(*[F.lit(v).alias(k) for k, v in zip(("verdict", "name", "pattern", "prefix", "rank"), r)])
        items = [x for token, rs in by_token.items() for x in (F.lit(token), F.array(*[entry(r) for r in rs]))]
        held = pages.withColumn(at_place, place)
        if items:
            candidates = F.flatten(F.filter(F.transform(_tokens(F.col(at_place)), lambda t: F.try_element_at(F.create_map(*items), t)), lambda c: c.isNotNull()))
            held = held.withColumn(at_hits, F.filter(candidates, fits))
        else:
            held = held.withColumn(at_hits, F.lit(None).cast(f"array<{_CANDIDATE}>"))
    else:
        table = pages.sparkSession.createDataFrame(rows, f"token string, r {_CANDIDATE}")
        urls = pages.select(url.alias(at_url), place.alias(at_place)).distinct()
        hits = (
            urls.withColumn("token", F.explode(_tokens(F.col(at_place))))
            .join(table, "token")
            .where(fits(F.col("r")))
            .groupBy(at_url)
            .agg(F.collect_list("r").alias(at_hits))
        )
        held = pages.withColumn(at_place, place).join(hits, url == F.col(at_url), "left").drop(at_url)
    first = lambda prefix: F.array_min(F.transform(F.filter(F.col(at_hits), lambda r: r["prefix"] == F.lit(prefix)), lambda r: F.struct(r["rank"].alias("rank"), r["name"].alias("name"), r["verdict"].alias("verdict"))))
    held = held.withColumns({at_rule: first(True), at_pattern: first(False)})
    return held.select(
        *[F.col(f"`{c}`") for c in pages.columns],
        host_of(url).alias("host"),
        path_of(url).alias("path"),
        F.col(f"{at_rule}.name").alias("rule"),
        F.col(f"{at_pattern}.name").alias("pattern_rule"),
        F.coalesce(F.col(f"{at_rule}.verdict"), F.col(f"{at_pattern}.verdict"), F.lit(default)).alias("verdict"),
    )
