"""SQL that checks the registered queries on the same tables (DuckDB dialect)."""

from __future__ import annotations

# Canonical URL of pages.url: no ports, upper-case hosts or ";" occur there.
_CANONICAL = r"""
CASE WHEN p IN ('', '/') THEN h || '/' WHEN p LIKE '%/' THEN h || left(p, length(p) - 1) ELSE h || p END
|| CASE WHEN q = '' THEN '' ELSE '?' || q END
"""

_PAGES = rf"""
parts AS (
  SELECT page_id, url, html,
         regexp_extract(url, '^[a-z]+://[^/?#]*') AS h,
         regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1) AS p,
         regexp_extract(url, '^[^?#]*\?([^#]*)', 1) AS q
  FROM pages
),
canon AS (
  SELECT page_id, url, html, h AS origin, regexp_extract(h, '://(.*)$', 1) AS netloc, {_CANONICAL} AS canonical_url
  FROM parts
),
hrefs AS (
  SELECT page_id, origin, netloc, canonical_url,
         unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS href,
         generate_subscripts(regexp_extract_all(html, '<a href="([^"]*)"', 1), 1) AS n
  FROM canon
),
links AS (
  SELECT page_id, netloc, canonical_url, min(n) AS n,
         origin || CASE WHEN href <> '/' AND href LIKE '%/' THEN left(href, length(href) - 1) ELSE href END AS link
  FROM hrefs GROUP BY ALL
),
plain AS (
  SELECT *, regexp_replace(regexp_replace(html, '<(script|style)>.*?</(script|style)>', ' ', 'gs'), '<!--.*?-->', ' ', 'gs') AS body
  FROM canon
),
mails AS (
  SELECT DISTINCT page_id, unnest(regexp_extract_all(
    regexp_replace(body, '<[^>]*>', ' ', 'g'),
    '[A-Za-z0-9._%+\-]+@[A-Za-z0-9.\-]+\.[A-Za-z]{{2,}}')) AS email
  FROM plain
),
titles AS (
  SELECT page_id, nullif(trim(
    regexp_replace(replace(replace(replace(regexp_extract(html, '<title>([^<]*)</title>', 1),
      '&quot;', '"'), '&copy;', '©'), '&middot;', '·'), '&amp;?', '&', 'g')), '') AS title
  FROM pages
)
"""

_PAGE_TITLE = f"WITH {_PAGES} SELECT page_id, title FROM titles"

_PAGE_LINKS = f"""WITH {_PAGES}
SELECT page_id, row_number() OVER (PARTITION BY page_id ORDER BY n) - 1 AS pos, link FROM links"""

_PAGE_PROFILE_COUNTS = f"""WITH {_PAGES}
SELECT c.page_id, c.canonical_url AS url,
       (SELECT count(*) FROM links l WHERE l.page_id = c.page_id) AS n_internal_links,
       0::BIGINT AS n_external_links,
       (SELECT count(*) FROM mails m WHERE m.page_id = c.page_id) AS n_emails,
       0::BIGINT AS n_images
FROM canon c"""

_URL_NORMALIZE = f"WITH {_PAGES} SELECT page_id, url, canonical_url, netloc FROM canon"

_URL_DEDUPE = f"""WITH {_PAGES}
SELECT page_id, canonical_url AS requested_url, length(html)::BIGINT AS n_chars FROM canon
QUALIFY row_number() OVER (PARTITION BY canonical_url ORDER BY page_id) = 1"""

_HOST_PAGE_COUNTS = f"WITH {_PAGES} SELECT netloc, count(*) AS n_pages FROM canon GROUP BY netloc"

_TEXT_EMAILS = r"""
SELECT DISTINCT doc_id, unnest(regexp_extract_all(text, '[A-Za-z0-9._%+\-]+@[A-Za-z0-9.\-]+\.[A-Za-z]{2,}')) AS email
FROM documents"""

_EMAILS_FIRST_SEEN = f"SELECT email, min(doc_id) AS doc_id FROM ({_TEXT_EMAILS}) GROUP BY email"

_PAGE_EMAILS = f"WITH {_PAGES} SELECT page_id, email FROM mails"

# The first paragraph ends where its nested ones have all ended, or with the article.
_PAGE_DESCRIPTION = f"""WITH {_PAGES},
tags AS (
  SELECT page_id, regexp_extract_all(body, '</?p>') AS tags, string_split_regex(body, '</?p>') AS pieces FROM plain
),
walk AS (
  SELECT page_id, unnest(tags) AS tag, generate_subscripts(tags, 1) AS n FROM tags
),
depth AS (
  SELECT page_id, n, sum(CASE tag WHEN '<p>' THEN 1 ELSE -1 END) OVER (PARTITION BY page_id ORDER BY n) AS open
  FROM walk
),
ends AS (
  SELECT page_id, min(n) AS n FROM depth WHERE open = 0 GROUP BY page_id
),
first_p AS (
  SELECT t.page_id,
         regexp_replace(array_to_string(pieces[2:coalesce(e.n, len(pieces))], '<p>'), '</article>.*$', '', 's') AS inner_html
  FROM tags t LEFT JOIN ends e ON e.page_id = t.page_id
)
SELECT page_id, nullif(array_to_string(
  [trim(regexp_replace(replace(x, '&quot;', '"'), '&amp;?', '&', 'g')) for x in string_split_regex(inner_html, '<[^>]*>')],
  ''), '') AS description
FROM first_p"""

_BFS_LEVELS = """
SELECT 'r' || r_regionkey AS seed, 'r' || r_regionkey AS node, 0::BIGINT AS level FROM region
UNION ALL SELECT 'r' || n_regionkey, 'n' || n_nationkey, 1 FROM nation JOIN region ON r_regionkey = n_regionkey
UNION ALL SELECT 'r' || n_regionkey, 'c' || c_custkey, 2
FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey"""

_BFS_BUDGET = """
WITH reached AS (
  SELECT c_custkey AS s, 'c' || c_custkey AS node, 0 AS level, 0 AS p1, 0 AS p2 FROM customer
  UNION ALL SELECT o_custkey, 'o' || o_orderkey, 1, o_orderkey, 0 FROM orders
  UNION ALL SELECT o_custkey, 'p' || l_partkey, 2, o_orderkey, min(l_partkey)
  FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_custkey, l_partkey, o_orderkey
),
firsts AS (
  SELECT *, row_number() OVER (PARTITION BY s, node ORDER BY level, p1, p2) AS n FROM reached
),
queue AS (
  SELECT *, row_number() OVER (PARTITION BY s ORDER BY level, p1, p2) AS place FROM firsts WHERE n = 1
)
SELECT 'c' || s AS seed, node, level::BIGINT AS level FROM queue
WHERE place <= 20 AND s IN (SELECT c_custkey FROM customer)"""

# One seed per host; no link of these pages is itself a page.
_HOST_CRAWL = rf"""{_PAGES},
deduped AS (
  SELECT * FROM canon QUALIFY row_number() OVER (PARTITION BY canonical_url ORDER BY page_id) = 1
),
seeds AS (
  SELECT d.* FROM deduped d JOIN (SELECT netloc, min(canonical_url) AS u FROM canon GROUP BY netloc) s ON s.u = d.canonical_url
),
children AS (
  SELECT s.canonical_url AS seed, l.link, row_number() OVER (PARTITION BY s.canonical_url ORDER BY l.n) AS place
  FROM seeds s JOIN links l ON l.page_id = s.page_id WHERE l.link <> s.canonical_url
),
visits AS (
  SELECT s.canonical_url AS seed, s.canonical_url AS url, 200::BIGINT AS status, t.title, 0::BIGINT AS level,
         (SELECT count(*) FROM links l WHERE l.page_id = s.page_id) AS n_internal,
         (SELECT count(*) FROM mails m WHERE m.page_id = s.page_id) AS n_emails, s.page_id
  FROM seeds s JOIN titles t ON t.page_id = s.page_id
  UNION ALL SELECT seed, link, 0, NULL, 1, 0, 0, NULL FROM children WHERE place < 50
)"""

_CRAWL_VISITS = f"""WITH {_HOST_CRAWL}
SELECT seed, url, status, title, level, n_internal, 0::BIGINT AS n_external, n_emails, 0::BIGINT AS n_images FROM visits"""

_CRAWL_ROWS = f"""WITH {_HOST_CRAWL},
shown AS (
  SELECT page_id, link, row_number() OVER (PARTITION BY page_id ORDER BY n) - 1 AS pos FROM links
)
SELECT seed, url, status, level, least(n_internal, 5)::BIGINT AS n_internal_links, pos::BIGINT AS pos, link
FROM visits v LEFT JOIN shown s ON s.page_id = v.page_id AND s.pos < 5"""

_SHOPS = """
o AS (
  SELECT o_orderkey AS k, o_orderkey // 64 AS b, o_orderkey // 1024 AS h, o_custkey AS c,
         o_orderstatus = 'P' AS pending, o_orderpriority = '1-URGENT' AS urgent
  FROM orders
),
lines AS (
  SELECT DISTINCT l_orderkey AS k, l_partkey AS part, l_suppkey AS supp FROM lineitem
),
lists AS (SELECT b, h, count(*) AS n, row_number() OVER (PARTITION BY h ORDER BY b) AS p1 FROM o GROUP BY b, h),
shops AS (SELECT h, count(*) AS n FROM lists GROUP BY h),
found AS (
  SELECT l.h, l.p1, row_number() OVER (PARTITION BY o.b ORDER BY o.k) AS p2, 'o' AS kind, o.k AS id
  FROM lists l JOIN o ON o.b = l.b
  UNION ALL SELECT h, p1, n + 1, 'list', b + 1 FROM lists
  UNION ALL SELECT h, p1, n + 2, 'o', (b + 1) * 64 FROM lists
),
queued AS (
  SELECT f.*, row_number() OVER (PARTITION BY f.h, kind, id ORDER BY f.p1, f.p2) AS seen FROM found f
  WHERE NOT (kind = 'list' AND EXISTS (SELECT 1 FROM lists l WHERE l.h = f.h AND l.b = f.id))
),
order_facts AS (
  SELECT o.k, o.h, o.pending, o.urgent,
         count(DISTINCT (l.supp, l.part)) FILTER (l.k IS NOT NULL) AS n_external,
         count(DISTINCT l.supp) + 1 AS n_emails,
         count(DISTINCT l.part) AS n_images
  FROM o LEFT JOIN lines l ON l.k = o.k GROUP BY o.k, o.h, o.pending, o.urgent
),
visits AS (
  SELECT h, 'http://h' || h || '.shop.example/' AS url, 200 AS status, 'Shop ' || h AS title, 0 AS level,
         n AS n_internal, 1 AS n_external, 0 AS n_emails, 0 AS n_images, 0 AS p1, 0 AS p2, NULL AS k
  FROM shops
  UNION ALL
  SELECT h, 'http://h' || h || '.shop.example/list/' || b, 200, 'List ' || b, 1, n + 3, 0, 0, 0, p1, 0, NULL FROM lists
  UNION ALL
  SELECT q.h, 'http://h' || q.h || '.shop.example/' || kind || '/' || q.id || CASE WHEN f.urgent THEN '/final' ELSE '' END,
         CASE WHEN f.k IS NULL THEN 0 WHEN f.pending THEN 404 ELSE 200 END,
         CASE WHEN NOT f.pending THEN 'Order ' || f.k || ' & parts' END, 2,
         CASE WHEN NOT f.pending THEN 3 ELSE 0 END,
         CASE WHEN NOT f.pending THEN f.n_external ELSE 0 END,
         CASE WHEN NOT f.pending THEN f.n_emails ELSE 0 END,
         CASE WHEN NOT f.pending THEN f.n_images ELSE 0 END, q.p1, q.p2, CASE WHEN NOT f.pending THEN f.k END
  FROM queued q LEFT JOIN order_facts f ON q.kind = 'o' AND f.k = q.id AND f.h = q.h WHERE q.seen = 1
),
placed AS (
  SELECT *, 'http://h' || h || '.shop.example/' AS seed,
         row_number() OVER (PARTITION BY h ORDER BY level, p1, p2) AS place
  FROM visits
)"""

_SHOP_COLUMNS = """seed, url, status::BIGINT AS status, title, level::BIGINT AS level, n_internal::BIGINT AS n_internal,
n_external::BIGINT AS n_external, n_emails::BIGINT AS n_emails, n_images::BIGINT AS n_images"""

_CRAWL_SHOPS = f"WITH {_SHOPS} SELECT {_SHOP_COLUMNS} FROM placed"
_CRAWL_SHOPS_BUDGET = f"WITH {_SHOPS} SELECT {_SHOP_COLUMNS} FROM placed WHERE place <= 100"

_CRAWL_SHOPS_READ = f"""WITH {_SHOPS}
SELECT count(*) AS pages_read, 0::BIGINT AS pages_refused, 0::BIGINT AS refs_left_out
FROM placed WHERE place <= 100 AND status <> 0"""

_CRAWL_SHOP_ROWS = f"""WITH {_SHOPS}
SELECT seed, level::BIGINT AS level, status::BIGINT AS status, count(*) AS n_pages,
       sum(least(n_internal, 5))::BIGINT AS n_internal_links, sum(n_external)::BIGINT AS n_external_links,
       sum(n_emails)::BIGINT AS n_emails, sum(n_images)::BIGINT AS n_images
FROM placed GROUP BY ALL"""

_SHOP_VALUES = f"""{_SHOPS},
vals AS (
  SELECT p.seed, p.url, p.place, 'image' AS kind,
         'http://h' || p.h || '.shop.example/img/' || l.part || '.png' AS value
  FROM placed p JOIN lines l ON l.k = p.k
  UNION ALL
  SELECT p.seed, p.url, p.place, 'offsite_link', 'http://s' || l.supp || '.supplier.example/p/' || l.part || '?o=1'
  FROM placed p JOIN lines l ON l.k = p.k
  UNION ALL SELECT seed, url, place, 'offsite_link', 'https://about.example/' FROM placed WHERE level = 0
  UNION ALL
  SELECT p.seed, p.url, p.place, 'email', 'sales' || l.supp || '@supplier.example' FROM placed p JOIN lines l ON l.k = p.k
  UNION ALL
  SELECT p.seed, p.url, p.place, 'email', 'clerk' || o.c || '@shop.example' FROM placed p JOIN o ON o.k = p.k
),
scraped AS (
  SELECT seed, kind, value, arg_min(url, place) AS source_url FROM vals GROUP BY seed, kind, value
)"""


def _scraped_shops(kind: str) -> str:
    return f"WITH {_SHOP_VALUES} SELECT seed, kind, value, source_url FROM scraped WHERE kind = '{kind}'"


# Given pages as one visit sequence, seen from the first host.
_PAGE_VALUES = rf"""{_PAGES},
first_host AS (SELECT min(netloc) AS host FROM canon),
vals AS (
  SELECT page_id, 'offsite_link' AS kind, link AS value FROM links, first_host WHERE netloc <> host
  UNION ALL SELECT page_id, 'email', email FROM mails
),
scraped AS (
  SELECT kind, value, min(page_id) AS page_id FROM vals GROUP BY kind, value
)"""


def _scraped_pages(kind: str) -> str:
    return f"""WITH {_PAGE_VALUES}
SELECT host AS seed, kind, value, canonical_url AS source_url
FROM scraped s JOIN canon c ON c.page_id = s.page_id, first_host WHERE kind = '{kind}'"""


_SUMMARY_CRAWL = f"""WITH {_PAGE_VALUES},
per_page AS (
  SELECT c.page_id, canonical_url, netloc = host AS own,
         (SELECT count(*) FROM links l WHERE l.page_id = c.page_id) AS n_links,
         (SELECT count(*) FROM mails m WHERE m.page_id = c.page_id) AS n_mails
  FROM canon c, first_host
)
SELECT count(*) AS total_rows, count(DISTINCT canonical_url) AS unique_urls, count(*) AS status_2xx,
       0::BIGINT AS status_3xx, 0::BIGINT AS status_4xx, 0::BIGINT AS status_5xx,
       coalesce(sum(CASE WHEN own THEN least(n_links, 5) ELSE 0 END), 0)::BIGINT AS total_internal_links,
       coalesce(sum(CASE WHEN own THEN 0 ELSE n_links END), 0)::BIGINT AS total_external_links,
       coalesce(sum(n_mails), 0)::BIGINT AS total_emails, 0::BIGINT AS total_images
FROM per_page"""

_SUMMARY_SCRAPE = f"""WITH {_PAGE_VALUES}
SELECT count(*) AS total_rows, count(DISTINCT canonical_url) AS unique_urls,
       0::BIGINT AS status_2xx, 0::BIGINT AS status_3xx, 0::BIGINT AS status_4xx, 0::BIGINT AS status_5xx,
       0::BIGINT AS total_internal_links, count(*) FILTER (kind = 'offsite_link') AS total_external_links,
       count(*) FILTER (kind = 'email') AS total_emails, 0::BIGINT AS total_images
FROM scraped s JOIN canon c ON c.page_id = s.page_id"""

_SUMMARY_BY_FILE = f"""WITH {_PAGE_VALUES}
SELECT 'crawl' AS run, * FROM ({_SUMMARY_CRAWL})
UNION ALL
SELECT CASE kind WHEN 'email' THEN 'emails' ELSE 'offsite' END, count(*), count(DISTINCT canonical_url), 0, 0, 0, 0, 0,
       count(*) FILTER (kind = 'offsite_link'), count(*) FILTER (kind = 'email'), 0
FROM scraped s JOIN canon c ON c.page_id = s.page_id GROUP BY kind"""

_SUMMARY_MIXED = f"""WITH {_SHOP_VALUES},
posts AS (
  SELECT 'https://posts.example/p/' || c_custkey || '/' AS url, c_acctbal >= 0 AS has_image FROM customer WHERE c_nationkey <> 0
),
urls AS (
  SELECT url FROM placed UNION SELECT source_url FROM scraped UNION SELECT url FROM posts
)
SELECT ((SELECT count(*) FROM placed) + (SELECT count(*) FROM scraped) + (SELECT count(*) FROM posts))::BIGINT AS total_rows,
       (SELECT count(*) FROM urls) AS unique_urls,
       ((SELECT count(*) FROM placed WHERE status = 200) + (SELECT count(*) FROM posts))::BIGINT AS status_2xx,
       0::BIGINT AS status_3xx, (SELECT count(*) FROM placed WHERE status = 404) AS status_4xx, 0::BIGINT AS status_5xx,
       (SELECT sum(least(n_internal, 5)) FROM placed)::BIGINT AS total_internal_links,
       ((SELECT sum(n_external) FROM placed) + (SELECT count(*) FROM scraped WHERE kind = 'offsite_link'))::BIGINT AS total_external_links,
       ((SELECT sum(n_emails) FROM placed) + (SELECT count(*) FROM scraped WHERE kind = 'email'))::BIGINT AS total_emails,
       ((SELECT sum(n_images) FROM placed) + (SELECT count(*) FROM scraped WHERE kind = 'image')
        + (SELECT count(*) FROM posts WHERE has_image))::BIGINT AS total_images"""

_SUMMARY_REPORT = f"""WITH totals AS ({_SUMMARY_CRAWL})
SELECT 1::BIGINT AS ordinal, 'Total rows' AS label, total_rows AS value FROM totals
UNION ALL SELECT 2, 'Unique URLs', unique_urls FROM totals
UNION ALL SELECT 3, '2xx statuses', status_2xx FROM totals
UNION ALL SELECT 4, '3xx statuses', status_3xx FROM totals
UNION ALL SELECT 5, '4xx statuses', status_4xx FROM totals
UNION ALL SELECT 6, '5xx statuses', status_5xx FROM totals
UNION ALL SELECT 7, 'Total internal links', total_internal_links FROM totals
UNION ALL SELECT 8, 'Total external links', total_external_links FROM totals
UNION ALL SELECT 9, 'Total emails', total_emails FROM totals
UNION ALL SELECT 10, 'Total images', total_images FROM totals"""

_ATTEMPTS = """
WITH a AS (
  SELECT 'http://u' || user_id || '.example/' || strftime(ts, '%Y-%m-%d') AS url, event_type AS kind, event_id, props,
         row_number() OVER (PARTITION BY user_id, strftime(ts, '%Y-%m-%d') ORDER BY ts, event_id) AS attempt
  FROM events
),
tried AS (
  SELECT *, kind = 'signup' AND event_id % 8 = 7 AS refused, kind <> 'signup' AS answered,
         kind IN ('view', 'click', 'purchase') OR (kind = 'error' AND attempt = 2) OR (kind = 'signup' AND event_id % 8 = 7) AS ends
  FROM a WHERE attempt <= 2
),
verdict AS (
  SELECT url, coalesce(min(attempt) FILTER (ends), max(attempt) FILTER (answered)) AS attempt FROM tried GROUP BY url
)"""

_QUARANTINED = f"""{_ATTEMPTS}
SELECT t.url AS requested_url, t.attempt, 'TooManyRedirects' AS error
FROM tried t JOIN verdict v ON v.url = t.url AND v.attempt = t.attempt WHERE t.refused"""

_RESOLVE_ATTEMPTS = f"""{_ATTEMPTS}
SELECT v.url AS requested_url,
       (CASE t.kind WHEN 'error' THEN 503 WHEN 'purchase' THEN 404 WHEN 'view' THEN 200 WHEN 'click' THEN 200 ELSE 0 END)::BIGINT AS status,
       CASE WHEN t.kind IS NULL THEN v.url ELSE v.url || '/e' || t.event_id END AS final_url,
       CASE WHEN t.kind = 'view' THEN t.props END AS html
FROM verdict v LEFT JOIN tried t ON t.url = v.url AND t.attempt = v.attempt WHERE NOT coalesce(t.refused, false)"""

_POST_USERNAME = """
SELECT c_custkey, CASE WHEN c_custkey % 4 IN (0, 1, 2, 3) THEN lower(c_mktsegment) || '_' || c_custkey END AS username
FROM customer"""

_POST_METADATA = """
SELECT 'instagram_post' AS kind, 'https://posts.example/p/' || c_custkey || '/' AS url, 200::BIGINT AS status,
       CASE WHEN c_mktsegment = 'BUILDING' THEN 'Instagram' ELSE c_name END AS title,
       CASE c_custkey % 4 WHEN 0 THEN '9 likes - ' || lower(c_mktsegment) || '_' || c_custkey || ' on May 1'
         WHEN 1 THEN lower(c_mktsegment) || '_' || c_custkey || ' on May 1' WHEN 2 THEN 'Photo by someone' END AS description,
       CASE WHEN c_acctbal >= 0 THEN 'https://img.example/' || c_custkey || '.jpg' END AS image_url,
       lower(c_mktsegment) || '_' || c_custkey AS username
FROM customer WHERE c_nationkey <> 0"""

ORACLES: dict[str, str] = {
    "page_title": _PAGE_TITLE,
    "page_links": _PAGE_LINKS,
    "page_profile_counts": _PAGE_PROFILE_COUNTS,
    "url_normalize": _URL_NORMALIZE,
    "url_dedupe": _URL_DEDUPE,
    "host_page_counts": _HOST_PAGE_COUNTS,
    "text_emails": _TEXT_EMAILS,
    "emails_first_seen": _EMAILS_FIRST_SEEN,
    "page_emails": _PAGE_EMAILS,
    "page_description": _PAGE_DESCRIPTION,
    "bfs_levels": _BFS_LEVELS,
    "bfs_budget": _BFS_BUDGET,
    "crawl_visits": _CRAWL_VISITS,
    "crawl_rows": _CRAWL_ROWS,
    "crawl_shops": _CRAWL_SHOPS,
    "crawl_shops_budget": _CRAWL_SHOPS_BUDGET,
    "crawl_shop_rows": _CRAWL_SHOP_ROWS,
    "crawl_shop_attempts": _CRAWL_SHOPS,
    "scrape_offsite": _scraped_pages("offsite_link"),
    "scrape_emails": _scraped_pages("email"),
    "scrape_shop_emails": _scraped_shops("email"),
    "scrape_shop_offsite": _scraped_shops("offsite_link"),
    "scrape_shop_images": _scraped_shops("image"),
    "summary_crawl": _SUMMARY_CRAWL,
    "summary_scrape": _SUMMARY_SCRAPE,
    "summary_by_file": _SUMMARY_BY_FILE,
    "summary_mixed": _SUMMARY_MIXED,
    "summary_report": _SUMMARY_REPORT,
    "resolve_attempts": _RESOLVE_ATTEMPTS,
    "quarantined_urls": _QUARANTINED,
    "post_username": _POST_USERNAME,
    "post_metadata": _POST_METADATA,
    "stream_page_links": _PAGE_LINKS,
    "stream_scrape_emails": f"SELECT kind, value, source_url FROM ({_scraped_pages('email')})",
    "stream_summary": _SUMMARY_CRAWL,
    "stream_unique_urls": f"SELECT unique_urls FROM ({_SUMMARY_CRAWL})",
    "crawl_clamped": _CRAWL_VISITS,
    "crawl_shops_read": _CRAWL_SHOPS_READ,
    "posts_written": _POST_METADATA,
    "rows_written": "SELECT count(*) AS n_rows FROM pages",
}
