"""Independent SQL oracle (DuckDB dialect) for the registered queries.

It never parses JSON: every value is recomputed from the base columns of
the test tables by the fixture rules (see ``sources.fixtures``)."""

from __future__ import annotations

AS_OF = "TIMESTAMP '2024-01-31 00:00:00'"

# Common table expressions shared by the oracle queries.
BASE = f"""
tw AS (
  SELECT e.event_id AS tid,
         ((e.user_id + 100000 * (e.event_id % 7)) % 100000 + 100000) % 100000 AS uid,
         e.user_id + 100000 * (e.event_id % 7) AS uid_raw,
         date_trunc('second', e.ts) AS time,
         d.lang AS lang,
         d.text AS text,
         md5(d.text) AS text_md5,
         e.event_id % 100 AS retweet_count,
         c.c_name AS author_name,
         'u' || CAST(e.user_id AS VARCHAR) AS author_screen_name,
         CASE e.event_id % 3 WHEN 0 THEN NULL WHEN 1 THEN e.event_type
              ELSE e.event_type || ', k' || json_extract_string(e.props, '$.k') END AS hashtags
  FROM events e
  JOIN documents d ON d.doc_id = e.event_id % (SELECT count(*) FROM documents)
  LEFT JOIN customer c ON c.c_custkey = e.user_id
),
en AS (SELECT * FROM tw WHERE lang = 'en'),
edges AS (
  SELECT DISTINCT l_suppkey AS uid, o_custkey AS follower
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
),
ledges AS (
  SELECT l_suppkey AS uid, o_custkey AS follower
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
),
fset AS (SELECT uid, follower FROM edges UNION SELECT DISTINCT uid, 0 FROM edges),
fan AS (SELECT f.follower AS uid, en.time, en.tid FROM en JOIN fset f ON f.uid = en.uid),
inbox AS (SELECT uid, time, max(tid) AS tid FROM fan GROUP BY uid, time),
inbox_vis AS (SELECT * FROM inbox WHERE time + INTERVAL 7 DAY > {AS_OF}),
home_vis AS (SELECT uid, time, max(tid) AS tid FROM en GROUP BY uid, time),
home_vis2 AS (SELECT * FROM home_vis WHERE time + INTERVAL 7 DAY > {AS_OF}),
tweets_vis AS (SELECT * FROM en WHERE time + INTERVAL 7 DAY > {AS_OF}),
unames AS (SELECT s_suppkey AS uid, s_name AS uname FROM supplier),
requesters AS (SELECT DISTINCT user_id AS uid FROM events),
users AS (SELECT c_custkey AS uid FROM customer)
"""


def local_time(col: str) -> str:
    return (f"strftime(timezone('America/New_York', timezone('UTC', {col})), "
            f"'%a %b %d %H:%M:%S')")


def _timeline(ids: str, req: str, profile: bool, text: str = "text") -> str:
    author = "coalesce(u.uname, 'unknown')" if profile else "t.author_name"
    return f"""WITH {BASE},
req AS ({req}),
pg AS (SELECT uid, CASE WHEN n < 50 THEN n + 5 ELSE n END AS page_size FROM req),
rk AS (SELECT i.uid, i.time, i.tid,
              row_number() OVER (PARTITION BY i.uid ORDER BY i.time DESC, i.tid DESC) AS rn
       FROM {ids} i WHERE i.uid IN (SELECT uid FROM pg))
SELECT rk.uid, coalesce(u.uname, 'unknown') AS uname, CAST(pg.page_size AS INTEGER) AS page_size,
       CAST(rk.rn AS INTEGER) AS rn, rk.tid, {local_time('t.time')} AS local_time, t.{text},
       {author} AS author_name, t.author_screen_name, t.hashtags,
       'https://twitter.com/' || t.author_screen_name AS profile_url
FROM rk JOIN pg ON pg.uid = rk.uid AND rk.rn <= pg.page_size
JOIN tweets_vis t ON t.tid = rk.tid
LEFT JOIN unames u ON u.uid = rk.uid"""


ORACLE: dict[str, str] = {}

ORACLE["home_timeline"] = _timeline("inbox_vis", "SELECT uid, 0 AS n FROM requesters", profile=False)

_EXPIRE = "time + INTERVAL 7 DAY"
_HALF = "TIMESTAMP '2024-01-16 00:00:00'"


def _q(body: str) -> str:
    return f"WITH {BASE}\n{body}"


# 2.1 ---------------------------------------------------------------------------
ORACLE["parse_tweets"] = _q("""SELECT tid, uid_raw,
  strftime(time, '%a %b %d %H:%M:%S +0000 %Y') AS created_at, lang, text, author_name,
  author_screen_name, hashtags FROM tw""")

ORACLE["parse_created_at"] = _q("""SELECT tid, time, strftime(time, '%Y-%m-%d %H:%M:%S+0000') AS stored_time FROM tw""")

ORACLE["fold_users"] = _q("SELECT tid, uid_raw, uid FROM tw")

ORACLE["filter_language"] = _q("SELECT tid, uid, time, lang FROM en")

ORACLE["dead_letter"] = """SELECT
  CASE event_id % 6 WHEN 0 THEN 'malformed_json' WHEN 1 THEN 'missing_id' WHEN 2 THEN 'missing_user'
       WHEN 3 THEN 'bad_id' WHEN 4 THEN 'bad_created_at' ELSE 'bad_user_id' END AS reason,
  CASE WHEN event_id % 6 = 3 THEN 'x' || CAST(event_id AS VARCHAR) ELSE CAST(event_id AS VARCHAR) END AS ref
FROM events"""

ORACLE["raw_roundtrip"] = _q("""SELECT tid, uid, time, text, author_name, author_screen_name, hashtags,
  retweet_count FROM tw""")

ORACLE["stream_ingest_parse"] = _q("SELECT tid, uid, time, lang FROM en")

# 2.2 ---------------------------------------------------------------------------
ORACLE["join_followers_left"] = _q("""SELECT en.tid, en.uid, s.n_followers, s.sum_followers
FROM en LEFT JOIN (SELECT uid, count(*) AS n_followers, CAST(sum(follower) AS BIGINT) AS sum_followers
                   FROM fset GROUP BY uid) s ON s.uid = en.uid""")

ORACLE["fanout_listener"] = _q("SELECT uid, CAST(follower AS BIGINT) AS follower FROM fset")

ORACLE["authors_without_followers"] = _q("SELECT tid, uid FROM en WHERE uid NOT IN (SELECT uid FROM edges)")

ORACLE["fanout_norm"] = _q("SELECT uid, time, tid FROM fan")

ORACLE["fanout_denorm"] = _q("""SELECT f.tid, f.tid AS payload_id, en.text_md5, count(*) AS n_receivers,
  CAST(sum(f.uid) AS BIGINT) AS sum_uid FROM fan f JOIN en ON en.tid = f.tid GROUP BY f.tid, en.text_md5""")

ORACLE["fanout_denorm_receivers"] = _q("""SELECT f.uid, f.time, f.tid, f.tid AS payload_id, en.text_md5
FROM fan f JOIN en ON en.tid = f.tid""")

ORACLE["fanout_list_store"] = _q("""SELECT l.follower AS uid, en.time, en.tid FROM en JOIN ledges l ON l.uid = en.uid""")

ORACLE["list_store_following"] = _q("""SELECT follower AS uid, uid AS followee, count(*) AS n_pushed
FROM ledges WHERE follower IN (SELECT uid FROM requesters) GROUP BY follower, uid""")

ORACLE["fanout_variants"] = _q("""
, lfan AS (SELECT l.follower AS uid, en.time, en.tid FROM en JOIN ledges l ON l.uid = en.uid)
, v AS (
  SELECT 'set' AS store, (SELECT count(*) FROM fan) AS n_rows,
         (SELECT count(*) FROM (SELECT DISTINCT uid, time FROM fan)) AS n_resolved
  UNION ALL
  SELECT 'list', (SELECT count(*) FROM lfan), (SELECT count(*) FROM (SELECT DISTINCT uid, time FROM lfan)))
SELECT 'norm' AS layout, store, n_rows, n_resolved FROM v
UNION ALL
SELECT 'denorm' AS layout, store, n_rows, n_resolved FROM v""")

# 2.3 ---------------------------------------------------------------------------
ORACLE["sink_tweets"] = _q(f"SELECT tid, text, {_EXPIRE} AS expire_at FROM tweets_vis")

ORACLE["sink_homepages"] = _q(f"SELECT uid, time, tid, {_EXPIRE} AS expire_at FROM home_vis2")

ORACLE["sink_inboxes"] = _q(f"SELECT uid, time, tid, {_EXPIRE} AS expire_at FROM inbox_vis")

ORACLE["sink_historytweets"] = _q(f"""SELECT h.uid, h.time, h.tid, en.text, h.{_EXPIRE} AS expire_at
FROM home_vis2 h JOIN en ON en.tid = h.tid""")

ORACLE["sink_feedslists"] = _q(f"""SELECT i.uid, i.time, i.tid, en.text_md5, i.{_EXPIRE} AS expire_at
FROM inbox_vis i JOIN en ON en.tid = i.tid""")



def _chunk(member: str) -> str:
    return f"CAST('0x' || substr(md5(CAST({member} AS VARCHAR)), 1, 8) AS BIGINT) % 16"


ORACLE["followers_lists"] = _q(f"""SELECT uid, {_chunk('follower')} AS chunk, count(*) AS n_followers,
       string_agg(CAST(follower AS VARCHAR), ',' ORDER BY follower) AS followerslist
FROM edges WHERE uid <> follower GROUP BY uid, {_chunk('follower')}""")

ORACLE["following_lists"] = _q(f"""
, sets AS (SELECT follower AS uid, {_chunk('uid')} AS chunk, count(*) AS n_following,
                  string_agg(CAST(uid AS VARCHAR), ',' ORDER BY uid) AS followinglist
           FROM edges WHERE uid <> follower GROUP BY follower, {_chunk('uid')})
SELECT * FROM sets
UNION ALL
SELECT uid, CAST(0 AS BIGINT), CAST(0 AS BIGINT), '' FROM users WHERE uid NOT IN (SELECT uid FROM sets)""")

# 2.4 ---------------------------------------------------------------------------
ORACLE["upsert_uid_time"] = _q("""SELECT uid, date_trunc('hour', time) AS time, max(tid) AS tid
FROM fan GROUP BY uid, date_trunc('hour', time)""")

ORACLE["upsert_tid"] = _q("SELECT tid, text, 1 AS edited, time + INTERVAL 1 HOUR AS ingest_ts FROM en")

ORACLE["ttl_visible"] = _q(f"""SELECT uid, count(*) AS n_rows,
  CAST(count(*) FILTER (WHERE {_EXPIRE} > {AS_OF}) AS BIGINT) AS n_visible FROM inbox GROUP BY uid""")

ORACLE["compact_store"] = ORACLE["sink_inboxes"]

ORACLE["user_page"] = _q("SELECT uid, time, tid FROM inbox_vis WHERE uid = 0 ORDER BY time DESC LIMIT 20")

# 2.5 ---------------------------------------------------------------------------
ORACLE["profile_timeline"] = _timeline("home_vis2", "SELECT uid, 0 AS n FROM requesters", profile=True)

ORACLE["paged_timeline"] = _timeline(
    "inbox_vis", "SELECT uid, CASE uid % 5 WHEN 0 THEN 0 WHEN 1 THEN 45 WHEN 2 THEN 49 "
                 "WHEN 3 THEN 50 ELSE 60 END AS n FROM requesters", profile=False, text="text_md5")

ORACLE["timeline_state"] = f"""WITH ht AS ({ORACLE['home_timeline']}),
c AS (SELECT uid, count(*) AS n FROM ht GROUP BY uid)
SELECT u.uid, CAST(coalesce(c.n, 0) AS BIGINT) AS n_rows, c.n IS NOT NULL AS has_tweets
FROM (SELECT DISTINCT user_id AS uid FROM events) u LEFT JOIN c ON c.uid = u.uid"""


def _topn(src: str, n: int = 20) -> str:
    return f"""SELECT * FROM (SELECT uid, CAST(row_number() OVER (PARTITION BY uid ORDER BY time DESC, tid DESC)
AS INTEGER) AS rn, time, tid FROM {src}) WHERE rn <= {n}"""


ORACLE["inbox_topn"] = _q(_topn("inbox_vis"))
ORACLE["homepage_topn"] = _q(_topn("home_vis2"))
ORACLE["feed_topn_denorm"] = _q(f"SELECT r.*, en.text_md5 FROM ({_topn('inbox_vis')}) r JOIN en ON en.tid = r.tid")
ORACLE["feed_topn_norm"] = ORACLE["feed_topn_denorm"]

ORACLE["followers_of"] = _q("""SELECT uid, follower FROM edges
WHERE uid <> follower AND uid IN (SELECT uid FROM requesters)""")

ORACLE["timeline_resolve"] = _q("SELECT i.uid, i.time, i.tid, en.text_md5 FROM inbox_vis i JOIN en ON en.tid = i.tid")

ORACLE["tweets_in_set"] = _q(f"""SELECT tid, text FROM tweets_vis
WHERE tid IN (SELECT tid FROM ({_topn('inbox_vis')}))""")

ORACLE["username_default"] = _q("""SELECT r.uid, coalesce(u.uname, 'unknown') AS uname
FROM requesters r LEFT JOIN unames u ON u.uid = r.uid""")

# 2.6 ---------------------------------------------------------------------------
ORACLE["render_tweets"] = _q("""SELECT tid, text, author_name, author_screen_name,
  'https://twitter.com/' || author_screen_name AS profile_url FROM tweets_vis""")

ORACLE["localized_time"] = _q(f"SELECT tid, time, {local_time('time')} AS local_time FROM en")

ORACLE["hashtags_joined"] = _q("SELECT tid, hashtags FROM tweets_vis")

# 2.7 ---------------------------------------------------------------------------
ORACLE["follower_counts"] = _q("SELECT uid, count(*) AS n_followers FROM edges WHERE uid <> follower GROUP BY uid")

ORACLE["following_counts"] = _q("""SELECT users.uid, CAST(coalesce(c.n, 0) AS BIGINT) AS n_following
FROM users LEFT JOIN (SELECT follower AS uid, count(*) AS n FROM edges WHERE uid <> follower GROUP BY follower) c
ON c.uid = users.uid""")

ORACLE["graph_totals"] = _q("""SELECT CAST(sum(n) AS BIGINT) AS n_edges, count(*) AS n_users_with_followers,
  max(n) AS max_followers FROM (SELECT uid, count(*) AS n FROM edges WHERE uid <> follower GROUP BY uid)""")


# Tier rule written out: position below a share of n; bounds mean +- (variance - 1).
_TIERS_SQL = """
, cnt AS (SELECT uid, count(*) AS c FROM edges WHERE uid <> follower GROUP BY uid)
, base AS (SELECT users.uid AS uid, (SELECT count(*) FROM users) AS n,
                  CAST(coalesce(cnt.c, 0) AS BIGINT) AS n_followers
           FROM users LEFT JOIN cnt ON cnt.uid = users.uid)
, placed AS (SELECT uid, n, n_followers,
                    CASE WHEN uid < n * 0.05 / 100 THEN 't1' WHEN uid < n * 0.15 / 100 THEN 't2'
                         WHEN uid < n * 0.3 / 100 THEN 't3' WHEN uid < n * 0.5 / 100 THEN 't4'
                         WHEN uid < n * 10.5 / 100 THEN 't5' WHEN uid < n * 50.5 / 100 THEN 't6'
                         WHEN uid < n * 90.5 / 100 THEN 't7' ELSE 't8' END AS tier
             FROM base)
, pu AS (SELECT uid, tier, n_followers,
                CAST(CASE tier WHEN 't1' THEN n * 10 // 100 - n * 4 // 100 + 1 WHEN 't2' THEN n * 5 // 100 - n * 2 // 100 + 1
                               WHEN 't3' THEN n * 2 // 100 - n * 1 // 100 + 1 WHEN 't4' THEN n * 1 // 100 - n * 1 // 200 + 1
                               WHEN 't5' THEN 101 WHEN 't6' THEN 41 WHEN 't7' THEN 21 ELSE 5 END AS BIGINT) AS lo,
                CAST(CASE tier WHEN 't1' THEN n * 10 // 100 + n * 4 // 100 - 1 WHEN 't2' THEN n * 5 // 100 + n * 2 // 100 - 1
                               WHEN 't3' THEN n * 2 // 100 + n * 1 // 100 - 1 WHEN 't4' THEN n * 1 // 100 + n * 1 // 200 - 1
                               WHEN 't5' THEN 299 WHEN 't6' THEN 79 WHEN 't7' THEN 39 ELSE 5 END AS BIGINT) AS hi
         FROM placed)
SELECT tier, lo, hi, count(*) AS n_users, min(n_followers) AS min_followers,
       round(avg(n_followers), 6) AS avg_followers, max(n_followers) AS max_followers,
       CAST(sum(CASE WHEN n_followers BETWEEN lo AND hi THEN 1 ELSE 0 END) AS BIGINT) AS n_in_bounds
FROM pu GROUP BY tier, lo, hi"""


ORACLE["audience_tiers"] = _q(_TIERS_SQL)

# both feeds derived on their own: ids ranked then joined to tweets, and payload rows ranked
_FEEDS = f"""
, ids AS ({_topn('inbox_vis')})
, norm AS (SELECT ids.uid, ids.tid, t.text_md5 AS h FROM ids JOIN tweets_vis t ON t.tid = ids.tid)
, payloads AS (SELECT i.uid, i.time, i.tid, en.text_md5 FROM inbox_vis i JOIN en ON en.tid = i.tid)
, den AS (SELECT uid, tid, text_md5 AS h FROM (
            SELECT *, row_number() OVER (PARTITION BY uid ORDER BY time DESC, tid DESC) AS rn FROM payloads) WHERE rn <= 20)
, only_n AS (SELECT * FROM norm EXCEPT ALL SELECT * FROM den)
, only_d AS (SELECT * FROM den EXCEPT ALL SELECT * FROM norm)
, every AS (SELECT uid, 1 AS n, 0 AS d, 0 AS xn, 0 AS xd FROM norm UNION ALL SELECT uid, 0, 1, 0, 0 FROM den
            UNION ALL SELECT uid, 0, 0, 1, 0 FROM only_n UNION ALL SELECT uid, 0, 0, 0, 1 FROM only_d)"""

ORACLE["layout_equivalence"] = _q(_FEEDS + """
SELECT uid, CAST(sum(n) AS BIGINT) AS n_norm, CAST(sum(d) AS BIGINT) AS n_denorm,
       CAST(sum(xn) AS BIGINT) AS n_only_norm, CAST(sum(xd) AS BIGINT) AS n_only_denorm FROM every GROUP BY uid""")

# which users the sample takes depends on a Spark hash; how many have a feed must not
ORACLE["layout_equivalence_sample"] = _q(_FEEDS + """
, asked AS (SELECT uid FROM every WHERE uid IN (SELECT uid FROM requesters))
SELECT least(40, count(DISTINCT uid)) AS n_users, CAST(0 AS BIGINT) AS n_only_norm, CAST(0 AS BIGINT) AS n_only_denorm
FROM asked""")

# 2.8 ---------------------------------------------------------------------------
ORACLE["stream_fanout"] = _q(f"""
SELECT 'tweets' AS "table", CAST(NULL AS BIGINT) AS uid, CAST(NULL AS TIMESTAMP) AS time, tid, text_md5,
       {_EXPIRE} AS expire_at FROM tweets_vis
UNION ALL SELECT 'homepages', uid, time, tid, NULL, {_EXPIRE} FROM home_vis2
UNION ALL SELECT 'inboxes', uid, time, tid, NULL, {_EXPIRE} FROM inbox_vis""")

ORACLE["stream_denorm"] = _q(f"""SELECT 'historytweets' AS "table", h.uid, h.time, h.tid, en.text_md5, h.{_EXPIRE} AS expire_at
FROM home_vis2 h JOIN en ON en.tid = h.tid
UNION ALL SELECT 'feedslists', i.uid, i.time, i.tid, en.text_md5, i.{_EXPIRE} FROM inbox_vis i JOIN en ON en.tid = i.tid""")

ORACLE["stream_list_denorm"] = _q(f"""
, lbox AS (SELECT l.follower AS uid, en.time, max(en.tid) AS tid FROM en JOIN ledges l ON l.uid = en.uid
           GROUP BY l.follower, en.time)
SELECT b.uid, b.time, b.tid, en.text_md5, b.{_EXPIRE} AS expire_at FROM lbox b JOIN en ON en.tid = b.tid
WHERE b.{_EXPIRE} > {AS_OF}""")

ORACLE["stream_static_join"] = ORACLE["join_followers_left"]

ORACLE["stream_topics"] = _q("SELECT tid, uid, time, lang, 't' || CAST(tid % 3 AS VARCHAR) AS topic FROM en")

ORACLE["stream_dedup"] = _q("""SELECT en.tid, count(DISTINCT en.tid) AS n_written, CAST(0 AS BIGINT) AS n_edited,
  count(f.uid) AS n_receivers FROM en LEFT JOIN fan f ON f.tid = en.tid GROUP BY en.tid""")

ORACLE["stream_inbox_topn"] = _q(_topn("inbox_vis"))

ORACLE["stream_list_store"] = _q(f"""
, lbox AS (SELECT l.follower AS uid, en.time, max(en.tid) AS tid FROM en JOIN ledges l ON l.uid = en.uid
           GROUP BY l.follower, en.time)
SELECT uid, count(*) AS n_rows, max(tid) AS max_tid FROM lbox WHERE {_EXPIRE} > {AS_OF} GROUP BY uid""")

ORACLE["stream_replay"] = _q(f"SELECT uid, time, tid, {_EXPIRE} AS expire_at FROM inbox")

ORACLE["stream_dimension_refresh"] = _q(f"""
, e0 AS (SELECT DISTINCT l_suppkey AS uid, o_custkey AS follower
         FROM lineitem JOIN orders ON l_orderkey = o_orderkey
         WHERE o_orderdate < TIMESTAMP '1995-01-01')
, f0 AS (SELECT uid, follower FROM e0 UNION SELECT DISTINCT uid, 0 FROM e0)
, fan2 AS (SELECT f.follower AS uid, en.time, en.tid FROM en JOIN f0 f ON f.uid = en.uid WHERE en.time < {_HALF}
           UNION ALL
           SELECT f.follower AS uid, en.time, en.tid FROM en JOIN fset f ON f.uid = en.uid WHERE en.time >= {_HALF})
, ib AS (SELECT uid, time, max(tid) AS tid FROM fan2 GROUP BY uid, time)
SELECT uid, time, tid, {_EXPIRE} AS expire_at FROM ib""")
