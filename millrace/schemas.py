"""Schemas of the stored tables. Nothing is inferred on read."""

from __future__ import annotations

from pyspark.sql import types as T


def _schema(text: str) -> T.StructType:
    return T._parse_datatype_string(text)


POST_FIELDS = (
    "post_id string, url string, title string, topic string, topic_slug string, author string, author_inactive boolean, "
    "is_staff boolean, publish_time string, publish_time_iso string, lastmod string, content string, word_count int, "
    "char_count int, replies_reported int, replies_scraped int, reply_pages_total int, reply_pages_fetched int, "
    "hit_page_cap boolean, relevance_hits string"
)
REPLY_FIELDS = (
    "reply_id string, post_id string, post_url string, seq int, page_no int, author string, author_inactive boolean, "
    "is_staff boolean, publish_time string, publish_time_iso string, content string, word_count int, reactions int"
)
SITEMAP_FIELDS = "loc string, lastmod string"
PAGE_FIELDS = "url string, page_no int, status int, html string"
LINK_FIELDS = "doc_id string, doc_type string, domain string, url string"


def names(fields: str) -> list[str]:
    return [x.split()[0] for x in fields.split(", ")]


def checkpoint_fields() -> str:
    struct = lambda fields: ", ".join(x.replace(" ", ": ", 1) for x in fields.split(", "))
    return f"post struct<{struct(POST_FIELDS)}>, replies array<struct<{struct(REPLY_FIELDS)}>>"


POST_COLUMNS = names(POST_FIELDS)
REPLY_COLUMNS = names(REPLY_FIELDS)
LINK_COLUMNS = names(LINK_FIELDS)
CLEAN_COLUMNS = ["n_url", "n_email", "n_phone", "n_emoji", "text_changed"]
