import re

import pytest
from pyspark.sql import functions as F

from millrace import fixed
from millrace.fixed import SiteProfile
from millrace.functions import extract as E
from millrace.functions import html as H
from millrace.operators.relevance import relevant


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


@pytest.mark.parametrize(
    "text,iso",
    [
        ("Jan 12, 2012 • 4:11 PM", "2012-01-12T16:11:00"),
        ("posted jan 3, 2020 · 12:05 am by", "2020-01-03T00:05:00"),
        ("Dec 31, 1999•12:05 PM", "1999-12-31T12:05:00"),
        ("Jan 12, 2012 - 4:11 PM", ""),
        ("Feb 31, 2012 • 1:99 PM", "2012-02-31T13:99:00"),
        ("Foo 1, 2012 • 1:00 PM", ""),
        ("January 1, 2012 • 1:00 PM", ""),
        ("", ""),
        (None, ""),
    ],
)
def test_stamps(spark, text, iso):
    assert one(spark, E.parse_stamp(F.lit(text).cast("string"))) == iso


@pytest.mark.parametrize("raw,name,gone", [("Ann (Inactive)", "Ann", True), ("Ann ( INACTIVE ) ", "Ann", True), ("(inactive) Ann", "(inactive) Ann", False), (None, "", False), (" Bo ", "Bo", False)])
def test_authors(spark, raw, name, gone):
    c = F.lit(raw).cast("string")
    assert (one(spark, E.author_name(c)), one(spark, E.author_inactive(c))) == (name, gone)


def test_ids_numbers_and_staff(spark):
    assert one(spark, E.last_segment(F.lit("https://x.org/d/my-thread//"))) == "my-thread"
    assert one(spark, E.last_segment(F.lit("https://x.org/d/t?p=2"))) == "t?p=2"
    assert one(spark, E.first_number(F.lit("about 12 of 30"))) == 12
    assert one(spark, E.first_number(F.lit("none"))) == 0
    assert one(spark, E.is_staff(F.lit(" Helper "), ("helper",)))


def test_lexicon_against_plain_python(spark):
    pattern = re.compile("|".join(rf"\b{t.pattern}\b" if t.whole_word else t.pattern for t in fixed.LEXICON), re.IGNORECASE)
    texts = ["My heart attack and Heart  attack", "consistent stents; atorvastatin", "MI, a-fib, AFIB and mi", "ischemic echo echoes ECHO", "congenital heart disease", "betablocker beta-blocker beta  blocker", "EF efx", "atrial fibrillation atrial", "", "naïve échoecho echoé", "_echo_ echo_"]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", E.lexicon_hits(F.col("t")).alias("h")).collect()
    for r in rows:
        assert r.h == sorted({m.lower() for m in pattern.findall(texts[r.i])}), texts[r.i]
    assert len(fixed.LEXICON) == 87 and sum(t.whole_word for t in fixed.LEXICON) == 22 and len(fixed.TOPIC_SLUGS) == 22


def test_relevance_modes(spark):
    df = spark.createDataFrame([("t", "a stent", "x"), ("t", "nothing", "caregiver-corner"), (None, None, None)], "title string, content string, slug string")
    judge = lambda mode: [tuple(r) for r in df.select(*relevant(mode, F.col("title"), F.col("content"), F.col("slug"))).collect()]
    assert judge("terms") == [(True, "stent"), (True, ""), (False, "")]
    assert judge("topic") == [(False, ""), (True, ""), (False, "")]
    assert judge("off") == [(True, "")] * 3
    with pytest.raises(ValueError):
        relevant("some", F.lit(""), F.lit(""), F.lit(""))


PAGE = """<html><body><div class="number-of-replies">3 Replies</div>
<ins-intouch-post><h1 class="pb-title big">A &amp; B</h1><a class="pb-topic" href="/g/topic/valves/">Valves</a>
<span class="pb-author-name">Ann (Inactive)</span><span class="pb-created-date">Jan 12, 2012 • 4:11 PM</span>
<div class="pb-desc"><p>one<p>two<br>three <!-- no --><script>var x = "</p>";</script></div></ins-intouch-post>
<ins-anon-reply><a class="rhb-name">Bo</a><span class="rhb-stamp">Jan 13, 2012 · 1:00 AM</span><p>x</p><p> </p><p>y</p><span class="rbw-foot">2 likes</span></ins-anon-reply>
<ins-anon-reply><p></p></ins-anon-reply>
<a href="/g/discussion/t/?p=2">2</a><a href="/other/?p=3">3</a><a href="/g/discussion/t?p=x">n</a></body></html>"""


def test_page_reading():
    site, root = SiteProfile(), H.parse(PAGE)
    post = H.read_post(root, site)
    assert post == {"title": "A & B", "topic": "Valves", "topic_href": "/g/topic/valves/", "author_raw": "Ann (Inactive)", "publish_time": "Jan 12, 2012 • 4:11 PM", "content": "one\n\ntwo\n\nthree"}
    assert H.read_replies(root, site) == [{"author_raw": "Bo", "publish_time": "Jan 13, 2012 · 1:00 AM", "content": "x\n\ny", "foot": "2 likes"}]
    assert H.pager_pages(root, "https://x.org/g/discussion/t") == [2]
    assert H.read_post(H.parse("<p>nothing"), site) is None
    assert H.parse(None).text() == ""


def test_html_depth_is_no_problem():
    assert H.parse("<div>" * 5000 + "deep").text() == "deep"


def test_sql_names(spark):
    from millrace.functions.register import register

    register(spark)
    spark.createDataFrame([(1, PAGE), (2, None)], "id int, html string").createOrReplaceTempView("pages_here")
    rows = spark.sql("SELECT id, r.* FROM pages_here, LATERAL page_replies(html) r").collect()
    assert [(r.id, r.pos, r.author_raw, r.content) for r in rows] == [(1, 0, "Bo", "x\n\ny")]
    assert spark.sql("SELECT nfc('e\u0301') AS x, parse_page(html, 'u').reported AS n FROM pages_here WHERE id = 1").first() == ("é", "3 Replies")
