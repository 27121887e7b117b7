"""From a made-up site to the report, with a fetcher that reads a dictionary."""

import json
import os

import pytest
from pyspark.sql import functions as F

from millrace import cli, schemas
from millrace.fixed import SiteProfile
from millrace.lock import Busy, run_lock
from millrace.operators import enrich, frontier
from millrace.plans import clean, ingest, report
from millrace.sources import tables
from millrace.streaming import incremental

ENTRY_FIELDS = "loc string, lastmod string, shard_file string, pos long"
BASE = "https://x.org/g/discussion/"


def page(post="", replies=(), reported=0, pager=(), url="", author="Ann"):
    head = f'<ins-intouch-post><h1 class="pb-title">T</h1><a class="pb-topic" href="/topic/other/">O</a><span class="pb-author-name">{author}</span><span class="pb-created-date">Jan 12, 2012 • 4:11 PM</span><div class="pb-desc">{post}</div></ins-intouch-post>'
    body = "".join(f'<ins-anon-reply><a class="rhb-name">{a}</a><span class="rhb-stamp">Feb 1, 2013 • 1:00 AM</span><p>{t}</p></ins-anon-reply>' for a, t in replies)
    links = "".join(f'<a href="/g/discussion/{url}?p={n}">{n}</a>' for n in pager)
    return f'{head}<div class="number-of-replies">{reported} replies</div>{body}{links}'


class Site:
    """A fetcher; what it was asked for is kept in a file, as it runs in another process."""

    def __init__(self, pages, log):
        self.pages, self.log = pages, str(log)

    def __call__(self, url):
        with open(self.log, "a") as f:
            f.write(url + "\n")
        got = self.pages.get(url)
        if isinstance(got, list):
            got = got[min(open(self.log).read().split("\n").count(url), len(got)) - 1]
        return (200, got) if got is not None else (404, None)

    def asked(self):
        return open(self.log).read().split()


def sitemap(urls):
    rows = "".join(f"<url><loc>{u}</loc>{f'<lastmod>{m}</lastmod>' if m else ''}</url>" for u, m in urls)
    return f'<?xml version="1.0"?><urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">{rows}</urlset>'


@pytest.fixture
def site(tmp_path):
    two = [("Ann", "mine"), ("Bo", "yours")]
    pages = {
        "https://x.org/sitemap.xml": '<?xml version="1.0"?><sitemapindex xmlns="http://www.sitemaps.org/schemas/sitemap/0.9"><sitemap><loc>https://x.org/sitemap_disc_g__1.xml</loc></sitemap><sitemap><loc>https://x.org/sitemap_disc_other__1.xml</loc></sitemap><sitemap><loc>https://x.org/sitemap_disc_g__2.xml</loc></sitemap></sitemapindex>',
        "https://x.org/sitemap_disc_g__1.xml": sitemap([(BASE + "paged", "2024-01-03"), (BASE + "dull", "2024-01-09"), ("https://x.org/about", "2024-01-10"), (BASE + "hollow", ""), (BASE + "late-body", "2024-01-01"), (BASE + "gone", "2024-01-02")]),
        BASE + "paged": page("A stent, see http://a.org.", two, 5, [2], "paged"),
        BASE + "paged?p=2": page("", two, 5, [], "paged"),  # the pager is wrong here, but replies are missing
        BASE + "paged?p=3": page("", [("Helper", "five")], 5, [], "paged"),
        BASE + "dull": page("Nothing here", two, 9),
        BASE + "hollow": page(" "),
        BASE + "late-body": [page(" "), page("my cardiac story", [("Ann", "again"), ("Ann", "again")], 0)],
    }
    return Site(pages, tmp_path / "asked")


PROFILE = {"group": "g", "sitemap_index": "https://x.org/sitemap.xml", "salt": "s::", "staff": ["helper"]}


def run(spark, tmp_path, site, *args):
    (tmp_path / "site.json").write_text(json.dumps(PROFILE))
    return cli.main([*args, "--root", str(tmp_path / "data"), "--site", str(tmp_path / "site.json"), "--quiet"], spark, site)


def test_run_resume_clean_report(spark, tmp_path, site, capsys):
    assert run(spark, tmp_path, site, "run") == 0
    threads = tables.read_checkpoint(spark, str(tmp_path / "data/raw/threads.jsonl"))
    posts, replies = (df.cache() for df in ingest.flatten(threads))
    assert posts.columns == schemas.POST_COLUMNS and replies.columns == schemas.REPLY_COLUMNS
    by_id = {r.post_id: r for r in posts.collect()}
    assert set(by_id) == {"paged", "late-body"}
    p = by_id["paged"]
    assert (p.replies_reported, p.replies_scraped, p.reply_pages_fetched, p.hit_page_cap, p.relevance_hits, p.lastmod) == (5, 5, 3, False, "stent", "2024-01-03")
    assert by_id["late-body"].replies_scraped == 2  # twins are genuine
    seq = [(r.reply_id, r.page_no, r.author, r.is_staff) for r in replies.where("post_id = 'paged'").orderBy("seq").collect()]
    assert seq == [("paged#1", 1, "Ann", False), ("paged#2", 1, "Bo", False), ("paged#3", 2, "Ann", False), ("paged#4", 2, "Bo", False), ("paged#5", 3, "Helper", True)]
    assert BASE + "dull?p=2" not in site.asked() and BASE + "paged?p=4" not in site.asked()
    assert site.asked().count(BASE + "hollow") == 2  # fetched once more before it counts as failed

    clean_posts = tables.read_csv(spark, str(tmp_path / "data/clean/corpus_posts"), "post_id string")
    assert clean_posts.count() == 2
    text = (tmp_path / "data/clean/report.txt").read_text()
    assert "posts    2 rows, 27 columns" in text and "replies  7 rows, 21 columns" in text and "a.org" in text

    asked = len(site.asked())
    assert run(spark, tmp_path, site, "run") == 0  # nothing new: kept threads aren't fetched again
    assert BASE + "paged" not in site.asked()[asked:]
    assert tables.read_checkpoint(spark, str(tmp_path / "data/raw/threads.jsonl"), distinct=False).count() == 2

    assert run(spark, tmp_path, site, "status") == 0
    out = capsys.readouterr().out
    assert "threads      2 of about" in out and "replies      7" in out and "newest post  2012-01-12" in out


def test_target_counts_kept_threads(spark, tmp_path, site):
    assert run(spark, tmp_path, site, "crawl", "--target", "1") == 0
    first = tables.read_checkpoint(spark, str(tmp_path / "data/raw/threads.jsonl"))
    assert [r.post.post_id for r in first.collect()] == ["paged"]
    before = len(site.asked())
    assert run(spark, tmp_path, site, "crawl", "--target", "1") == 0
    assert all("sitemap" in u for u in site.asked()[before:])


def test_outcomes_can_be_kept(spark, tmp_path, site):
    entries = spark.createDataFrame([(BASE + n, "2024", "s", i) for i, n in enumerate(("dull", "hollow", "gone", "paged"))], ENTRY_FIELDS)
    log = str(tmp_path / "outcomes")
    done, failed = ingest.crawl(spark, entries, str(tmp_path / "t.jsonl"), site, SiteProfile(), batch=3, outcome_log=log)
    assert done == {"kept": 1, "failed": 2, "skipped_irrelevant": 1} and failed == [BASE + "hollow", BASE + "gone"]
    assert {r.url.rsplit("/", 1)[1]: r.outcome for r in spark.read.parquet(log).collect()} == {"dull": "skipped_irrelevant", "hollow": "failed", "gone": "failed", "paged": "kept"}


def test_failures_exit_with_1(spark, tmp_path):
    assert run(spark, tmp_path, Site({}, tmp_path / "asked"), "run") == 1
    assert not (tmp_path / "data/run.lock").exists()


def test_assembled_pages_follow_the_same_rules(spark):
    pages = [("u/paged", 1, page("x", [("a", "1")] * 2, 5, [2], "paged")), ("u/paged", 2, page("", [("a", "2")] * 2, 5)), ("u/paged", 3, page("", [("a", "3")], 5)), ("u/paged", 4, page("", [("a", "4")], 5)),
             ("u/zero", 1, page("x", [("a", "1")], 0, [2], "zero")), ("u/zero", 2, page("", [("a", "2")], 0)), ("u/zero", 3, page("", [("a", "3")], 0)),
             ("u/hole", 1, page("x", [("a", "1")], 9)), ("u/hole", 3, page("", [("a", "3")], 9)),
             ("u/empty", 1, page("x", [("a", "1")], 9)), ("u/empty", 2, page("", [], 9)), ("u/empty", 3, page("", [("a", "1")], 9))]
    pages = [(u.replace("u/", "https://x.org/g/discussion/"), n, h) for u, n, h in pages]
    df = spark.createDataFrame(pages, "url string, page_no int, html string")
    walked = ingest.assemble_threads(ingest.parse_pages(df, SiteProfile()))
    got = {}
    for r in walked.select("url", "page_no").collect():
        got.setdefault(r.url.rsplit("/", 1)[1], []).append(r.page_no)
    assert {k: sorted(v) for k, v in got.items()} == {"paged": [1, 2, 3], "zero": [1, 2], "hole": [1], "empty": [1]}
    capped = ingest.assemble_threads(ingest.parse_pages(df, SiteProfile()), max_pages=2)
    assert capped.where("page_no > 2").isEmpty()


def test_checkpoint_reading(spark, tmp_path):
    rec = lambda url, title: json.dumps({"post": {"url": url, "title": title, "publish_time_iso": "2020-01-01"}, "replies": [{"publish_time_iso": "2021-01-01"}, {"publish_time_iso": None}]})
    path = tmp_path / "c.jsonl"
    path.write_text("\n".join([rec("a", "first"), "", rec("b", "b")[:30], "[1]", rec("a", "second"), rec("c", "ü"), '{"x": 1}']))
    got = {r.post.url: r.post.title for r in tables.read_checkpoint(spark, str(path)).collect()}
    assert got == {"a": "first", "c": "ü"}
    t = report.checkpoint_totals(tables.read_checkpoint(spark, str(path), distinct=False)).first()
    assert tuple(t) == (3, 6, "2020-01-01", "2021-01-01")
    empty = spark.createDataFrame([], schemas.checkpoint_fields())
    assert tuple(report.checkpoint_totals(empty).first()) == (0, 0, "", "")
    assert report.status(spark, str(tmp_path / "nothing"), {}) == "No data yet."


def test_csv_round_trip(spark, tmp_path):
    rows = [("1", 'say "hi"\nthere, \\ ok', None), ("2", "NA", "x")]
    df = spark.createDataFrame(rows, "a string, b string, c string")
    tables.write_csv(df, str(tmp_path / "t"))
    back = tables.read_csv(spark, str(tmp_path / "t"), "a string, b string, c string")
    assert sorted(map(tuple, back.collect())) == rows
    assert sorted(r.b or "" for r in tables.read_csv(spark, str(tmp_path / "t"), "a string, b string, c string", tables.PANDAS_MISSING).collect()) == ["", rows[0][1]]
    (tmp_path / "bom.csv").write_bytes(b"\xef\xbb\xbfa,b\n1,2\n")
    assert [tuple(r) for r in tables.read_csv(spark, str(tmp_path / "bom.csv"), "a string, b string").collect()] == [("1", "2")]


def test_is_op(spark):
    posts = spark.createDataFrame([("p", "Ann"), ("q", None)], "post_id string, author string")
    replies = spark.createDataFrame([("p", "Ann"), ("p", "Bo"), ("q", None), ("r", "Ann"), ("p", None)], "post_id string, author string")
    got = enrich.with_is_op(replies, posts).collect()
    assert len(got) == 5 and [(r.post_id, r.author) for r in got if r.is_op] == [("p", "Ann")]
    with pytest.raises(ValueError):
        enrich.with_is_op(replies, posts.union(posts))
    assert enrich.with_is_op(replies, posts.union(posts), check=False).count() == 5


def test_frontier(spark):
    e = spark.createDataFrame([("a", "2024", "s", 1), ("b", "", "s", 2), ("c", "2024", "s", 3), ("a", "2020", "s", 4), ("d", "2023", "s", 5)], "loc string, lastmod string, shard_file string, pos long")
    seen = spark.createDataFrame([("d",)], "url string")
    got = frontier.newest_first(frontier.new_entries(e, seen)).collect()
    assert [(r.loc, r.lastmod) for r in got] == [("a", "2024"), ("c", "2024"), ("b", "")]
    assert frontier.remaining(None, 3) is None and frontier.remaining(0, 3) is None and frontier.remaining(2, 3) == 0


def test_streaming_is_incremental(spark, tmp_path):
    folder, sink, state = (str(tmp_path / n) for n in ("in", "sink", "state"))
    os.makedirs(folder)
    rec = lambda url, t: json.dumps({"post": {"url": url, "title": t}, "replies": []}) + "\n"
    (tmp_path / "in/1.jsonl").write_text(rec("a", "1") + rec("b", "1") + "broken\n")
    seen = []
    after = lambda df: seen.append(df.count())
    incremental.ingest_threads(spark, folder, sink, state, after)
    incremental.ingest_threads(spark, folder, sink, state, after)
    (tmp_path / "in/2.jsonl").write_text(rec("b", "2") + rec("c", "2"))
    incremental.ingest_threads(spark, folder, sink, state, after)
    got = {r.url: r.post.title for r in spark.read.parquet(sink).collect()}
    assert got == {"a": "1", "b": "1", "c": "2"} and seen == [2, 1]


def test_lock(tmp_path):
    path = tmp_path / "l"
    with run_lock(path):
        with pytest.raises(Busy):
            with run_lock(path):
                pass
    assert not path.exists()
    for stale in ('{"pid": 999999999}', "broken", ""):
        path.write_text(stale)
        with run_lock(path):
            assert json.loads(path.read_text())["pid"] == os.getpid()


def test_clean_corpus_of_empty_tables(spark):
    posts = spark.createDataFrame([], schemas.POST_FIELDS)
    replies = spark.createDataFrame([], schemas.REPLY_FIELDS)
    corpus = clean.clean_corpus(posts, replies, "s::")
    assert (corpus.posts.count(), corpus.links.count(), len(corpus.posts.columns), len(corpus.replies.columns)) == (0, 0, 27, 21)
    assert "posts    0 rows" in report.render_report(corpus)


def test_research_subsets(spark):
    r = spark.createDataFrame([(True, False, "2020-01-01T00:00:00"), (False, True, "2010-01-01T00:00:00"), (False, False, "")], "is_staff boolean, is_op boolean, publish_time_iso string")
    got = {k: v.count() for k, v in enrich.research_subsets(r).items()}
    assert got == {"non_staff": 2, "non_staff_non_op": 1, "recent": 1}
    assert spark.range(1).select(F.lit(1)).count() == 1


def fake_fetch(url):
    return (200, f"<p>{url}</p>") if "gone" not in url else (404, None)


def test_pages_as_a_data_source(spark):
    from millrace.sources.fetch import PageSource

    spark.dataSource.register(PageSource)
    df = spark.read.format("pages").option("urls", json.dumps(["u/a", "u/gone"])).option("fetcher", "test_ingest:fake_fetch").load()
    assert sorted(map(tuple, df.collect())) == [("u/a", 1, 200, "<p>u/a</p>"), ("u/gone", 1, 404, None)]
