"""Cleaning against pinned cases and against an independent model in plain Python."""

import hashlib
import random
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from millrace import fixed
from millrace.functions import text as X
from millrace.plans.clean import clean_text, links_of


def cleaned(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, content string")
    return {r.doc_id: r for r in clean_text(df, steps=True).collect()}


PINNED = [
    ("see (www.x.com/a), and HTTPS://Y.org/.", "see ([URL:x.com]), and [URL:y.org]"),
    ("http://www.www.x.com", "[URL:[URL:x.com]]"),
    ("http://u@h.com/x", "[URL:[EMAIL:ORG]]"),
    ("http://u:p@h.com", "[URL:u]"),
    ("http://x.com?q=1", "[URL:x.com?q=1]"),
    ("http://www./", "[URL]"),
    ("http://a.com/?r=http://b.com", "[URL:a.com]"),
    ("www.x.org/p?q=1, y", "[URL:x.org] y"),
    ("mail a@b.com.", "mail [EMAIL:ORG]"),
    ("mail A.B@GMail.com ok", "mail [EMAIL] ok"),
    ("a@x-y.co-op.com", "[EMAIL:ORG]-op.com"),
    ("(555) 123-4567", "([PHONE]"),
    ("+1 555-123-4567", "+[PHONE]"),
    ("5551234567", "5551234567"),
    ("(555)123-4567", "(555)123-4567"),
    ("a \r\nb\r\rc\n\n\n\nd  e ", "a\nb\n\nc\n\nd e"),
    ("thatâ€™s cafÃ©", "that's café"),
    ("Âge", "ge"),
    (None, ""),
    ("", ""),
]


def test_pinned_cases(spark):
    got = cleaned(spark, [t for t, _ in PINNED])
    assert {i: got[i].content for i in got} == {i: want for i, (_, want) in enumerate(PINNED)}
    assert not got[18].text_changed and got[17].text_changed
    assert [(x.domain, x.url) for x in got[0]._links] == [("y.org", "HTTPS://Y.org/"), ("x.com", "www.x.com/a")]
    assert got[1].n_url == 2


def test_links_are_one_row_each_in_order(spark):
    df = spark.createDataFrame([(1, "http://b.org www.a.org"), (2, "none"), (3, None)], "doc_id long, content string")
    rows = links_of(clean_text(df), "doc_id", "post").orderBy("doc_id", "pos").collect()
    assert [(r.doc_id, r.domain, r.pos) for r in rows] == [(1, "b.org", 0), (1, "a.org", 1)]


def test_emoji_count_code_points(spark):
    got = cleaned(spark, ["\U0001f44d\U0001f3fd and \U0001f1e9\U0001f1ea", "a❤️", "x"])
    assert [got[i].n_emoji for i in range(3)] == [4, 1, 0]


def test_author_hash(spark):
    row = spark.range(1).select(X.author_hash(F.lit("ann"), "s::").alias("a"), X.author_hash(F.lit(None).cast("string"), "s::").alias("b")).first()
    want = lambda t: hashlib.sha256(t.encode()).hexdigest()[:12]
    assert (row.a, row.b) == (want("s::ann"), want("s::nan"))


# ---- an independent model, written from the rules ----

_WORD = r"[^\W]"


def model(text):
    if text is None:
        return "", [], 0, 0
    t = text
    if any(c in t for c in "ÂÃâ"):
        for bad, good in fixed.MOJIBAKE:
            t = t.replace(bad, good)
    t = unicodedata.normalize("NFC", t)
    t = re.sub("[​-‍⁠﻿]", "", t)
    t = "".join(" " if c in fixed.EXOTIC_SPACES else "'" if c in fixed.SINGLE_QUOTES else '"' if c in fixed.DOUBLE_QUOTES else c for c in t).replace("…", "...")
    links = []

    def domain(u):
        m = re.match(r"(?:https?://)?([^/\s:]+)", u, re.IGNORECASE)
        return m[1].lower().removeprefix("www.") if m else ""

    def link(m):
        u = m[0].rstrip(".,;:!?")
        links.append(u)
        return f"[URL:{domain(u)}]" if domain(u) else "[URL]"

    stop = r"\s<>\"'\)\]}"
    t = re.sub(rf"https?://[^{stop}]+", link, t, flags=re.IGNORECASE)
    t = re.sub(rf"\bwww\.[a-z0-9][a-z0-9.-]*\.[a-z]{{2,}}(?:/[^{stop}]*)?", link, t, flags=re.IGNORECASE)
    emails = 0

    def mail(m):
        nonlocal emails
        emails += 1
        return "[EMAIL]" if m[0].split("@", 1)[1].lower().rstrip(".") in fixed.PERSONAL_MAIL else "[EMAIL:ORG]"

    t = re.sub(r"[\w.+-]+@[\w-]+\.[\w.]{2,}", mail, t)
    t, phones = re.subn(r"\b(?:\+?1[-. ]?)?\(?\d{3}\)?[-. ]\d{3}[-. ]\d{4}\b", "[PHONE]", t)
    t = t.replace("\r\n", "\n").replace("\r", "\n")
    t = re.sub(" +\n", "\n", t)
    t = re.sub(" {2,}", " ", t)
    return re.sub("\n{3,}", "\n\n", t).strip(), links, emails, phones


PIECES = [*"ab1 .,:/@-()'\"", "  ", "\n", "\r\n", "\r", "\n\n\n", "http://", "HTTPS://", "www.", "x.org", "gmail.com", "a@b.co", "555-123-4567", "+1 ", "(555) 123 4567",
          "é", "é", "Ã©", "â€™", "Â", " ", "　", "‍", "’", "“", "…", "\x1c", "\x85", " ", "ß", "漢", "\U0001f44d", "$1", "\\", "_"]


def test_random_texts_agree_with_the_model(spark):
    rng = random.Random(5)
    texts = ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 24))) for _ in range(4000)]
    got = cleaned(spark, texts)
    for i, text in enumerate(texts):
        want, links, emails, phones = model(text)
        row = got[i]
        assert (row.content, [x.url for x in row._links], row.n_email, row.n_phone) == (want, links, emails, phones), repr(text)
        assert row.text_changed == (want != text)


def test_word_count_is_that_of_split(spark):
    texts = ["", " a  b\n", "a\x1cb\x85c d", " x"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", X.word_count(F.col("t")).alias("n")).orderBy("i").collect()
    assert [r.n for r in rows] == [len(t.split()) for t in texts]


@pytest.mark.parametrize("url,domain", [("HTTP://www.A.org:80/x", "a.org"), ("www.www.x.com", "www.x.com"), ("https://", "https"), ("x/y", "x"), ("", "")])
def test_domain_of(spark, url, domain):
    assert spark.range(1).select(X.domain_of(F.lit(url)).alias("d")).first().d == domain
