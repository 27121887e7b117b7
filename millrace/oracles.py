"""DuckDB SQL for the engine's queries, written apart from the operators, in RE2's dialect."""

from __future__ import annotations

from . import fixed
from .queries import SALT, dirty_sql

_SPACE = r"\t\n\x0B\f\r \x1C-\x1F\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
_NOT_IN_URL = rf"""{_SPACE}<>"''\)\]}}"""
_URL = rf"(?i)https?://[^{_NOT_IN_URL}]+"
_BARE = rf"(?i)\bwww\.[a-z0-9][a-z0-9.-]*\.[a-z]{{2,}}(?:/[^{_NOT_IN_URL}]*)?"
_EMAIL = r"[\pL\pN_.+-]+@[\pL\pN_-]+\.[\pL\pN_.]{2,}"
_PHONE = r"\b(?:\+?1[-. ]?)?\(?\d{3}\)?[-. ]\d{3}[-. ]\d{4}\b"
_EMOJI = fixed.EMOJI


def _q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _mojibake(t: str) -> str:
    out = t
    for bad, good in fixed.MOJIBAKE:
        out = f"replace({out}, {_q(bad)}, {_q(good)})"
    return f"CASE WHEN regexp_matches({t}, '[ÂÃâ]') THEN {out} ELSE {t} END"


def _fold(t: str) -> str:
    singles, doubles, spaces = fixed.SINGLE_QUOTES, fixed.DOUBLE_QUOTES, fixed.EXOTIC_SPACES
    plain = " " * len(spaces) + "'" * len(singles) + '"' * len(doubles)
    return f"replace(translate(regexp_replace({t}, {_q(fixed.ZERO_WIDTH)}, '', 'g'), {_q(spaces + singles + doubles)}, {_q(plain)}), '…', '...')"


def _count(t: str, rx: str) -> str:
    return f"CAST(len(regexp_extract_all({t}, '{rx}')) AS INTEGER)"


def _trim(u: str) -> str:
    return f"regexp_replace({u}, '[.,;:!?]+$', '')"


def _domain(u: str) -> str:
    return rf"regexp_replace(lower(regexp_extract({u}, '(?i)^(?:https?://)?([^/{_SPACE}:]+)', 1)), '^www\.', '')"


def _mask(t: str, rx: str, token: str) -> str:
    pairs = f"list_zip(string_split_regex({t}, '{rx}'), regexp_extract_all({t}, '{rx}'))"
    return f"array_to_string(list_transform({pairs}, lambda z: coalesce(z[1], '') || CASE WHEN z[2] IS NULL THEN '' ELSE {token} END), '')"


def _link_token(u: str) -> str:
    d = _domain(_trim(u))
    return f"CASE WHEN {d} = '' THEN '[URL]' ELSE '[URL:' || {d} || ']' END"


def _urls(t: str) -> str:
    return _mask(t, _URL, _link_token("z[2]"))


def _www(t: str) -> str:
    return _mask(t, _BARE, _link_token("z[2]"))


def _email_domain(a: str) -> str:
    return rf"regexp_replace(lower(regexp_extract({a}, '(?s)^[^@]*@(.*)$', 1)), '\.+$', '')"


def _personal(d: str) -> str:
    return f"{d} IN ({', '.join(map(_q, fixed.PERSONAL_MAIL))})"


def _emails(t: str) -> str:
    return _mask(t, _EMAIL, f"CASE WHEN {_personal(_email_domain('z[2]'))} THEN '[EMAIL]' ELSE '[EMAIL:ORG]' END")


def _phones(t: str) -> str:
    return f"regexp_replace({t}, '{_PHONE}', '[PHONE]', 'g')"


def _strip(t: str) -> str:
    return f"regexp_replace(regexp_replace({t}, '^[{_SPACE}]+', ''), '[{_SPACE}]+$', '')"


def _tidy(t: str) -> str:
    lines = f"replace(replace({t}, chr(13) || chr(10), chr(10)), chr(13), chr(10))"
    return _strip(rf"regexp_replace(regexp_replace(regexp_replace({lines}, ' +\n', chr(10), 'g'), ' {{2,}}', ' ', 'g'), '\n{{3,}}', chr(10) || chr(10), 'g')")


def _words(t: str) -> str:
    return _count(t, f"[^{_SPACE}]+")


_DOCS = f"d AS (SELECT doc_id, source, text, {dirty_sql('duckdb')} AS content FROM documents)"

#: The whole chain, one step a CTE, as c.
_CHAIN = f"""{_DOCS},
c1 AS (SELECT doc_id, content AS raw, {_mojibake("content")} AS t1 FROM d),
c2 AS (SELECT *, {_fold("nfc_normalize(t1)")} AS t2 FROM c1),
c3 AS (SELECT *, {_urls("t2")} AS t3 FROM c2),
c4 AS (SELECT *, {_www("t3")} AS t4 FROM c3),
c5 AS (SELECT *, {_emails("t4")} AS t5 FROM c4),
c6 AS (SELECT *, {_phones("t5")} AS t6 FROM c5),
c7 AS (SELECT *, {_tidy("t6")} AS t7,
              list_concat(regexp_extract_all(t2, '{_URL}'), regexp_extract_all(t3, '{_BARE}')) AS found FROM c6),
c AS (SELECT doc_id, t7 AS content, CAST(len(found) AS INTEGER) AS n_url, {_count("t4", _EMAIL)} AS n_email, {_count("t5", _PHONE)} AS n_phone,
             {_count("t2", _EMOJI)} AS n_emoji, t7 <> raw AS text_changed, t1 <> raw AS mojibake, t4, found, {_words("t7")} AS word_count,
             CAST(length(t7) AS INTEGER) AS char_count FROM c7)"""

_LINKS = f"""{_CHAIN},
l AS (SELECT doc_id, pos - 1 AS pos, {_trim("found[pos]")} AS url FROM (SELECT doc_id, found, unnest(range(1, len(found) + 1)) AS pos FROM c)),
links AS (SELECT CAST(doc_id AS BIGINT) AS doc_id, 'post' AS doc_type, {_domain("url")} AS domain, url, CAST(pos AS INTEGER) AS pos FROM l)"""

_TURNS = """t AS (SELECT CAST(conv_id AS VARCHAR) AS post_id, CAST(turn AS INTEGER) AS turn, role AS author, text AS content FROM conversations),
p AS (SELECT * FROM t WHERE turn = 0),
r0 AS (SELECT *, CAST(floor((turn - 1) / 15) AS INTEGER) + 1 AS page_no FROM t WHERE turn > 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY post_id ORDER BY page_no, turn) AS INTEGER) AS seq,
             post_id || '#' || CAST(row_number() OVER (PARTITION BY post_id ORDER BY page_no, turn) AS VARCHAR) AS reply_id,
             lower(author) = 'system' AS is_staff FROM r0)"""


def _lexicon() -> str:
    return "|".join(rf"\b{t.pattern.lower()}\b" if t.whole_word else t.pattern.lower() for t in fixed.LEXICON)


def _hits(t: str) -> str:
    """RE2's word boundary is ASCII: other letters and digits become 0, anything else beyond ASCII a space."""
    plain = rf"regexp_replace(regexp_replace(lower({t}), '[^\pL\pN\x00-\x7F]', ' ', 'g'), '[^\x00-\x7F]', '0', 'g')"
    return f"array_to_string(list_sort(list_distinct(regexp_extract_all({plain}, '{_lexicon()}'))), '|')"


def _docs_query(**columns: str) -> str:
    return f"WITH {_DOCS} SELECT doc_id, {', '.join(f'{e} AS {n}' for n, e in columns.items())} FROM d"


_ENTRIES = """e AS (SELECT url AS loc, CASE WHEN page_id % 9 = 0 THEN '' ELSE '2024-01-' || lpad(CAST(page_id % 28 + 1 AS VARCHAR), 2, '0') END AS lastmod, page_id AS pos FROM pages)"""


_THREADS = r"""b AS (SELECT conv_id, CAST(turn AS INTEGER) AS turn, role, 'm ' || trim(regexp_replace(text, '[^A-Za-z0-9]+', ' ', 'g')) AS body,
                 'https://example.org/discussion/conv-' || conv_id AS url, 'conv-' || conv_id AS post_id FROM conversations),
r AS (SELECT *, CAST(ceil(turn / 2.0) AS INTEGER) AS page_no FROM b WHERE turn > 0),
s AS (SELECT conv_id, max(page_no) AS pages, count(*) AS n FROM r GROUP BY conv_id),
p AS (SELECT b.*, coalesce(s.pages, 1) AS pages, coalesce(s.n, 0) AS n FROM b LEFT JOIN s ON s.conv_id = b.conv_id WHERE turn = 0),
posts AS (SELECT post_id, url, 'Title ' || conv_id AS title, 'Topic' AS topic, 't-' || conv_id % 3 AS topic_slug, role AS author, false AS author_inactive, role = 'system' AS is_staff,
                 'Feb 3, 2024 • 12:05 AM' AS publish_time, '2024-02-03T00:05:00' AS publish_time_iso, '2024-02-03' AS lastmod, CASE WHEN conv_id % 4 = 1 THEN '' ELSE body END AS content,
                 CASE WHEN conv_id % 4 = 1 THEN 0 ELSE CAST(len(string_split(body, ' ')) AS INTEGER) END AS word_count, CASE WHEN conv_id % 4 = 1 THEN 0 ELSE CAST(length(body) AS INTEGER) END AS char_count,
                 CAST(n AS INTEGER) AS replies_reported, CASE WHEN conv_id % 4 = 1 THEN 'failed' WHEN conv_id % 3 < 2 THEN 'kept' ELSE 'skipped_irrelevant' END AS outcome FROM p),
pg AS (SELECT p.conv_id, p.url, p.pages, p.n, CAST(unnest(range(1, p.pages + 1)) AS INTEGER) AS page_no FROM p),
have AS (SELECT * FROM pg WHERE NOT (conv_id % 5 = 0 AND page_no = 2)),
walk AS (SELECT * FROM pg WHERE conv_id % 5 <> 0 OR page_no = 1)"""


def oracle_sql() -> dict[str, str]:
    relevance = f"SELECT doc_id, source, {_hits(chr(39) * 2 + ' || lang || ' + _q(' ') + ' || text')} AS relevance_hits FROM documents"
    return {
        "q_mask_email": _docs_query(masked=_emails("content"), n_email=_count("content", _EMAIL)),
        "q_mask_phone": _docs_query(masked=_phones("content"), n_phone=_count("content", _PHONE)),
        "q_mask_url": _docs_query(masked=_urls("content")),
        "q_mask_www": f"WITH {_DOCS}, u AS (SELECT doc_id, {_urls('content')} AS m FROM d) SELECT doc_id, {_www('m')} AS masked FROM u",
        "q_mojibake": _docs_query(fixed=_mojibake("content")),
        "q_nfc": _docs_query(composed="nfc_normalize(content)"),
        "q_unicode_fold": _docs_query(folded=_fold("content")),
        "q_emoji_count": _docs_query(n_emoji=_count("content", _EMOJI)),
        "q_tidy_whitespace": _docs_query(tidy=_tidy("content")),
        "q_lengths": _docs_query(word_count=_words("content"), char_count="CAST(length(content) AS INTEGER)"),
        "q_text_changed": f"WITH {_CHAIN} SELECT doc_id, text_changed FROM c",
        "q_clean_full": f"WITH {_CHAIN} SELECT doc_id, content, n_url, n_email, n_phone, n_emoji, text_changed, mojibake, word_count, char_count FROM c",
        "q_links": f"WITH {_LINKS} SELECT doc_id, doc_type, domain, url, pos FROM links",
        "q_links_top_domains": f"WITH {_LINKS} SELECT domain, count(*) AS n FROM links GROUP BY domain ORDER BY n DESC, domain LIMIT 15",
        "q_links_distinct": f"WITH {_LINKS} SELECT count(*) AS links, count(DISTINCT domain) AS domains FROM links",
        "q_email_domains": f"""WITH {_CHAIN}, e AS (SELECT unnest(regexp_extract_all(t4, '{_EMAIL}')) AS a FROM c), m AS (SELECT {_email_domain("a")} AS domain FROM e)
            SELECT domain, count(*) AS n, {_personal("domain")} AS personal FROM m GROUP BY domain""",
        "q_domain_of": f"SELECT page_id, {_domain('url')} AS domain FROM pages",
        "q_post_id": "SELECT page_id, regexp_extract(regexp_replace(url, '/+$', ''), '(?s)([^/]*)$', 1) AS post_id FROM pages",
        "q_lexicon_hits": f"SELECT doc_id, {_hits('text')} AS hits FROM documents",
        "q_relevance_terms": f"SELECT doc_id, relevance_hits FROM ({relevance}) WHERE relevance_hits <> '' OR source IN ('src3', 'src7')",
        "q_relevance_topic": "SELECT doc_id, '' AS relevance_hits FROM documents WHERE source IN ('src3', 'src7')",
        "q_relevance_off": "SELECT doc_id, '' AS relevance_hits FROM documents",
        "q_author_hash": f"SELECT conv_id, turn, left(sha256('{SALT}' || CASE WHEN turn % 5 = 4 THEN 'nan' ELSE role || ' ' || CAST(conv_id AS VARCHAR) END), 12) AS author_hash FROM conversations",
        "q_split_author": "SELECT conv_id, turn, CASE WHEN turn % 3 = 2 THEN role || '(inactive)x' ELSE role END AS author, turn % 3 = 1 AS author_inactive FROM conversations",
        "q_staff_flag": "SELECT conv_id, turn, role = 'system' AS is_staff FROM conversations",
        "q_parse_stamp": "SELECT event_id, CASE WHEN event_id % 4 = 0 THEN '' ELSE strftime(ts, '%Y-%m-%dT%H:%M') || ':00' END AS publish_time_iso FROM events",
        "q_is_op": f"WITH {_TURNS} SELECT r.reply_id, r.author, coalesce(r.author = p.author, false) AS is_op FROM r LEFT JOIN p ON r.post_id = p.post_id",
        "q_is_short": f"WITH {_TURNS} SELECT post_id, {_words('content')} AS word_count, {_words('content')} < 20 AS is_short FROM p",
        "q_reply_seq": f"WITH {_TURNS} SELECT post_id, turn, page_no, seq, reply_id FROM r",
        "q_thread_rollup": f"WITH {_TURNS} SELECT post_id, count(*) AS replies, count(*) FILTER (WHERE is_staff) AS staff_replies, max(seq) AS last_seq, CAST(sum({_words('content')}) AS BIGINT) AS words FROM r GROUP BY post_id",
        "q_subset_nonstaff_nonop": f"WITH {_TURNS} SELECT r.reply_id, r.author, r.is_staff, false AS is_op FROM r LEFT JOIN p ON r.post_id = p.post_id WHERE NOT r.is_staff AND NOT coalesce(r.author = p.author, false)",
        "q_completeness": """SELECT l_orderkey, max(l_linenumber) AS replies_reported, count(*) AS replies_scraped, count(*) < max(l_linenumber) AS is_incomplete, count(*) >= 7 AS hit_page_cap
            FROM lineitem GROUP BY l_orderkey""",
        "q_frontier_new": f"WITH {_ENTRIES} SELECT loc, max(lastmod) AS lastmod FROM e WHERE loc NOT IN (SELECT loc FROM e WHERE pos % 4 = 1) GROUP BY loc",
        "q_frontier_order": f"WITH {_ENTRIES} SELECT loc, lastmod, pos FROM e ORDER BY lastmod DESC, pos",
        "q_dedupe_first": "SELECT user_id, event_type, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS n FROM events) WHERE n = 1",
        "q_checkpoint_nest_flatten": f"WITH {_TURNS} SELECT r.post_id, p.author AS post_author, r.seq, r.reply_id, r.author, CAST(length(r.content) AS INTEGER) AS chars FROM r JOIN p ON r.post_id = p.post_id",
        "q_checkpoint_posts": f"WITH {_TURNS} SELECT post_id, 'https://example.org/discussion/' || post_id AS url, author, content, '2024-01-' || lpad(CAST(CAST(post_id AS INTEGER) % 28 + 1 AS VARCHAR), 2, '0') AS publish_time_iso FROM p",
        "q_csv_round_trip": """SELECT conv_id, turn, role, 'say "a, b"' || chr(10) || 'and ' || text || chr(10) || chr(10) || ',end' AS text FROM conversations""",
        "q_thread_posts": f"WITH {_THREADS} SELECT * FROM posts",
        "q_thread_outcomes": f"WITH {_THREADS} SELECT outcome, count(*) AS n FROM posts GROUP BY outcome",
        "q_thread_replies": f"""WITH {_THREADS}, k AS (SELECT r.*, CAST(row_number() OVER (PARTITION BY r.conv_id ORDER BY r.turn) AS INTEGER) AS seq FROM r JOIN have h ON h.conv_id = r.conv_id AND h.page_no = r.page_no)
            SELECT post_id || '#' || seq AS reply_id, post_id, url AS post_url, seq, page_no, role AS author, turn % 3 = 0 AS author_inactive, role = 'system' AS is_staff,
            'Jan ' || (turn + 1) || ', 2024 • 3:0' || turn % 10 || ' PM' AS publish_time, '2024-01-' || lpad(CAST(turn + 1 AS VARCHAR), 2, '0') || 'T15:0' || turn % 10 || ':00' AS publish_time_iso,
            body AS content, CAST(len(string_split(body, ' ')) AS INTEGER) AS word_count, turn AS reactions FROM k""",
        "q_thread_pager": f"""WITH {_THREADS} SELECT url, page_no, array_to_string(range(1, pages + 1), ',') AS pager, CAST(n AS INTEGER) AS reported,
            CAST((SELECT count(*) FROM r WHERE r.conv_id = have.conv_id AND r.page_no = have.page_no) AS INTEGER) AS replies FROM have""",
        "q_thread_walk": f"WITH {_THREADS} SELECT url, page_no FROM walk",
        "q_thread_records": f"""WITH {_THREADS}, w AS (SELECT conv_id, url, CAST(max(page_no) AS INTEGER) AS f FROM walk WHERE page_no <= 2 GROUP BY conv_id, url),
            c AS (SELECT w.url, f, CAST(count(r.turn) AS INTEGER) AS k FROM w LEFT JOIN r ON r.conv_id = w.conv_id AND r.page_no <= f GROUP BY w.url, f)
            SELECT post_id, replies_reported, k AS replies_scraped, f AS reply_pages_fetched, f >= 2 AS hit_page_cap, k AS n FROM posts JOIN c ON c.url = posts.url WHERE outcome = 'kept'""",
        "q_sitemap_index": "SELECT 'https://example.org/sitemap_disc_group__' || page_id || '.xml' AS loc, CAST(page_id AS INTEGER) AS shard_no FROM pages WHERE page_id % 3 = 1",
        "q_sitemap_shards": """SELECT 'https://example.org/discussion/' || page_id || '?a=1&b=2' AS loc, CASE WHEN page_id % 4 = 0 THEN '' ELSE '2024-01-' || lpad(CAST(page_id % 28 + 1 AS VARCHAR), 2, '0') END AS lastmod
            FROM pages WHERE page_id % 3 <> 0""",
        "q_subset_nonstaff": f"WITH {_TURNS} SELECT reply_id, author, CASE WHEN turn % 6 = 5 THEN '' ELSE CAST(2013 + turn AS VARCHAR) || '-03-04T05:06:00' END AS publish_time_iso FROM r WHERE NOT is_staff",
        "q_subset_recent": f"WITH {_TURNS} SELECT reply_id, author, CAST(2013 + turn AS VARCHAR) || '-03-04T05:06:00' AS publish_time_iso FROM r WHERE turn % 6 <> 5 AND 2013 + turn >= 2017",
        "q_frontier_target": f"WITH {_ENTRIES} SELECT loc, lastmod FROM e WHERE pos % 4 <> 1 ORDER BY lastmod DESC, pos LIMIT 40",
        "q_corpus_report": f"""WITH {_CHAIN} SELECT count(*) FILTER (WHERE doc_id % 4 = 0) AS posts, count(*) FILTER (WHERE doc_id % 4 <> 0) AS replies, count(*) FILTER (WHERE mojibake) AS mojibake_docs,
            CAST(sum(n_url) AS BIGINT) AS urls, CAST(sum(n_email) AS BIGINT) AS emails, CAST(sum(n_phone) AS BIGINT) AS phones, count(*) FILTER (WHERE text_changed) AS changed,
            count(*) FILTER (WHERE n_emoji > 0) AS with_emoji, count(*) FILTER (WHERE doc_id % 4 <> 0 AND doc_id % 12 = 0) AS staff_replies, count(*) FILTER (WHERE doc_id % 4 <> 0 AND doc_id % 15 = 0) AS op_replies,
            count(*) FILTER (WHERE doc_id % 10 = 0) AS inactive_docs, count(*) FILTER (WHERE doc_id % 4 = 0 AND word_count < 20) AS short_posts, CAST(sum(word_count) AS BIGINT) AS words FROM c""",
        "q_status": f"""WITH {_TURNS} SELECT count(*) AS threads, (SELECT count(*) FROM r) AS replies,
            max('2024-01-' || lpad(CAST(CAST(post_id AS INTEGER) % 28 + 1 AS VARCHAR), 2, '0')) AS newest_post,
            (SELECT max('2024-01-' || lpad(CAST(turn % 28 + 1 AS VARCHAR), 2, '0')) FROM r) AS newest_reply FROM p""",
        "q_stream_incremental": """SELECT CAST(user_id AS VARCHAR) || '/' || event_type AS key, event_id, value
            FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS n FROM events) WHERE n = 1""",
    }
