"""Relevance of threads: by lexicon terms, by topic, or off."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed
from ..functions.extract import lexicon_hits, post_text

MODES = ("terms", "topic", "off")


def relevant(mode: str, title: Column, content: Column, topic_slug: Column, topics: tuple[str, ...] = fixed.TOPIC_SLUGS, terms: tuple[fixed.Term, ...] = fixed.LEXICON) -> tuple[Column, Column]:
    """(keep, relevance_hits) of an original post."""
    if mode not in MODES:
        raise ValueError(f"mode is one of {MODES}")
    if mode == "off":
        return F.lit(True), F.lit("")
    on_topic = F.coalesce(topic_slug.isin(*topics), F.lit(False))
    if mode == "topic":
        return on_topic, F.lit("")
    hits = lexicon_hits(post_text(title, content), terms)
    return (F.size(hits) > 0) | on_topic, F.array_join(hits, "|")


def with_relevance(posts: DataFrame, mode: str = "terms", title: str = "title", content: str = "content", topic_slug: str = "topic_slug", **lists) -> DataFrame:
    """posts with _keep and relevance_hits. Write the result before filtering by _keep: hits are then computed once."""
    keep, hits = relevant(mode, F.col(title), F.col(content), F.col(topic_slug), **lists)
    return posts.withColumns({"relevance_hits": hits, "_keep": keep})
