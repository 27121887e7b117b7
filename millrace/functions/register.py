"""SQL names for the functions that aren't built in."""

from __future__ import annotations

from pyspark.sql import SparkSession

from ..fixed import SiteProfile
from . import html, text


def register(spark: SparkSession, site: SiteProfile | None = None) -> None:
    site = site or SiteProfile()
    spark.udf.register("nfc", text.nfc)
    spark.udf.register("parse_page", html.page_parser(site))
    spark.udtf.register("page_replies", html.replies_table(site))
    spark.udf.register("article", html.article_reader())
