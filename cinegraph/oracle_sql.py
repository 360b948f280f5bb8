"""DuckDB SQL for every exact query in ``queries.py`` (the correctness gate)."""

from __future__ import annotations

from .operators.select import MIX, ROUNDS
from .plans.models import ALS_REGS
from .oracle_fixtures import (CREDIT_NAMES, FX_ACTOR, FX_BRIDGE, FX_EVENT, FX_ITEM, FX_LATEST, FX_MOVIE_RAW, FX_RATING,
                              FX_RATING_RAW,
                              with_ctes)

ORACLE: dict[str, str] = {}

_RECALL_TAIL = """
liked AS (SELECT uid, mid FROM fx_latest WHERE rating > 6),
people AS (SELECT DISTINCT l.uid, b.role, b.pid FROM liked l JOIN fx_bridge b ON b.mid = l.mid),
hop AS MATERIALIZED (SELECT DISTINCT p.uid, b.mid FROM people p JOIN fx_bridge b ON b.role = p.role AND b.pid = p.pid),
related AS (SELECT h.uid, h.mid FROM hop h
            WHERE NOT EXISTS (SELECT 1 FROM fx_latest r WHERE r.uid = h.uid AND r.mid = h.mid)),
s1 AS MATERIALIZED (SELECT uid, pos, mid FROM (
         SELECT r.uid, r.mid, row_number() OVER (PARTITION BY r.uid ORDER BY i.rating DESC, r.mid) - 1 AS pos
         FROM related r JOIN fx_item i ON i.id = r.mid WHERE i.rating > 6) t WHERE pos < 50),
user_n AS MATERIALIZED (SELECT u.uid, count(s1.mid) AS n FROM (SELECT DISTINCT uid FROM fx_latest) u
           LEFT JOIN s1 ON s1.uid = u.uid GROUP BY u.uid),
ranked AS MATERIALIZED (SELECT id AS mid, rating, row_number() OVER (ORDER BY rating DESC, id) AS rnk FROM fx_item),
from_top AS (SELECT n.uid, n.rnk - 1 AS pos, rk.mid
             FROM (SELECT uid, unnest(range(1, 51)) AS rnk FROM user_n WHERE n = 0) n JOIN ranked rk ON rk.rnk = n.rnk),
excluded AS MATERIALIZED (SELECT h.uid, h.mid FROM hop h JOIN user_n n ON n.uid = h.uid AND n.n > 0 AND n.n < 50
                          UNION SELECT uid, mid FROM fx_latest),
excluded_n AS (SELECT uid, count(*) AS e FROM excluded GROUP BY uid),
wanted AS (SELECT n.uid, n.n, unnest(range(1, 50 - n.n + e.e + 1)) AS rnk
           FROM user_n n JOIN excluded_n e ON e.uid = n.uid WHERE n.n > 0 AND n.n < 50),
free AS (SELECT w.uid, w.n, w.rnk, rk.mid FROM wanted w JOIN ranked rk ON rk.rnk = w.rnk
         ANTI JOIN excluded x ON x.uid = w.uid AND x.mid = rk.mid),
fill AS (SELECT uid, pos, mid FROM (
           SELECT uid, n + row_number() OVER (PARTITION BY uid ORDER BY rnk) - 1 AS pos, mid FROM free) t
         WHERE pos < 50),
recall_out AS (SELECT uid, CAST(pos AS BIGINT) AS pos, mid FROM s1
               UNION ALL SELECT uid, CAST(pos AS BIGINT), mid FROM from_top
               UNION ALL SELECT uid, CAST(pos AS BIGINT), mid FROM fill)
"""

_RECALL_BASE = with_ctes(FX_ITEM, FX_ACTOR, FX_RATING, FX_LATEST, FX_BRIDGE, _RECALL_TAIL)

ORACLE["latest_rating"] = with_ctes(FX_RATING, FX_LATEST) + "SELECT uid, mid, time, rating FROM fx_latest"
ORACLE["related_movies"] = _RECALL_BASE + "SELECT uid, mid FROM related"
ORACLE["recall_stage1"] = _RECALL_BASE + "SELECT uid, CAST(pos AS BIGINT) AS pos, mid FROM s1"
ORACLE["recall"] = _RECALL_BASE + "SELECT uid, pos, mid FROM recall_out"
ORACLE["recall_all_users"] = _RECALL_BASE + """, everyone AS (
  SELECT uid, pos, mid FROM recall_out
  UNION ALL SELECT c.uid, CAST(rk.rnk - 1 AS BIGINT), rk.mid
  FROM (SELECT c_custkey AS uid, unnest(range(1, 51)) AS rnk FROM customer ANTI JOIN fx_latest ON uid = c_custkey) c
  JOIN ranked rk ON rk.rnk = c.rnk)
SELECT uid, pos, mid FROM everyone"""
ORACLE["recommend_by_score"] = _RECALL_BASE + """, scored AS (
  SELECT uid, mid, ((uid * 31 + mid * 17) % 1000) / CAST(100 AS DOUBLE) AS prediction FROM recall_out),
best AS (SELECT *, row_number() OVER (PARTITION BY uid ORDER BY prediction DESC, mid) - 1 AS pos FROM scored)
SELECT b.uid, CAST(b.pos AS BIGINT) AS pos, b.mid, i.name, i.rating, b.prediction
FROM best b JOIN fx_item i ON i.id = b.mid WHERE b.pos < 3"""
ORACLE["top_popular"] = with_ctes(FX_ITEM) + """
SELECT rnk AS rank, mid, rating FROM (
  SELECT id AS mid, rating, row_number() OVER (ORDER BY rating DESC, id) AS rnk FROM fx_item) t
WHERE rnk <= 50"""

# ---- C1 catalog -------------------------------------------------------------
_CATALOG = with_ctes(FX_MOVIE_RAW, """
first_rows AS (SELECT row_ord, name, actor, district, director, rating FROM (
    SELECT *, row_number() OVER (PARTITION BY name ORDER BY row_ord) AS rn FROM fx_movie_raw) t WHERE rn = 1),
movies AS (SELECT *, row_number() OVER (ORDER BY row_ord) - 1 AS mid FROM first_rows),
district_ids AS (SELECT district AS name, row_number() OVER (ORDER BY min(row_ord)) - 1 AS id
                 FROM movies GROUP BY district),
actor_occ AS (SELECT m.mid, m.row_ord, t.pos - 1 AS pos, t.pname FROM movies m,
    unnest(list_filter(string_split(coalesce(m.actor, ''), '|'), lambda x: x <> '')) WITH ORDINALITY AS t(pname, pos)),
director_occ AS (SELECT m.mid, m.row_ord, t.pos - 1 AS pos, t.pname FROM movies m,
    unnest(list_filter(string_split(coalesce(m.director, ''), '|'), lambda x: x <> '')) WITH ORDINALITY AS t(pname, pos)),
actor_ids AS (SELECT pname AS name, row_number() OVER (ORDER BY row_ord, pos) - 1 AS id FROM (
    SELECT *, row_number() OVER (PARTITION BY pname ORDER BY row_ord, pos) AS rn FROM actor_occ) t WHERE rn = 1),
director_ids AS (SELECT pname AS name, row_number() OVER (ORDER BY row_ord, pos) - 1 AS id FROM (
    SELECT *, row_number() OVER (PARTITION BY pname ORDER BY row_ord, pos) AS rn FROM director_occ) t WHERE rn = 1),
movie_actor AS (SELECT o.mid, o.pos, a.id AS aid FROM actor_occ o JOIN actor_ids a ON a.name = o.pname),
movie_director AS (SELECT o.mid, o.pos, d.id AS did FROM director_occ o JOIN director_ids d ON d.name = o.pname),
genre_ids AS (SELECT genre AS name, row_number() OVER (ORDER BY min(row_ord)) - 1 AS id FROM fx_movie_raw GROUP BY genre),
trait_ids AS (SELECT trait AS name, row_number() OVER (ORDER BY min(row_ord)) - 1 AS id FROM fx_movie_raw GROUP BY trait),
movie_genre AS (SELECT DISTINCT m.mid, g.id AS gid FROM fx_movie_raw r JOIN movies m ON m.name = r.name
                JOIN genre_ids g ON g.name = r.genre),
movie_trait AS (SELECT DISTINCT m.mid, g.id AS tid FROM fx_movie_raw r JOIN movies m ON m.name = r.name
                JOIN trait_ids g ON g.name = r.trait),
b_actor AS (SELECT DISTINCT aid AS id, mid FROM movie_actor),
b_director AS (SELECT DISTINCT did AS id, mid FROM movie_director),
b_genre AS (SELECT gid AS id, mid FROM movie_genre),
b_trait AS (SELECT tid AS id, mid FROM movie_trait),
b_district AS (SELECT d.id, m.mid FROM movies m JOIN district_ids d ON d.name = m.district)
""")

ORACLE["catalog_movie"] = _CATALOG + """
SELECT m.mid AS id, m.name,
  coalesce((SELECT string_agg(CAST(gid AS VARCHAR), ',' ORDER BY gid) FROM movie_genre x WHERE x.mid = m.mid), '') AS genres,
  coalesce((SELECT string_agg(CAST(aid AS VARCHAR), ',' ORDER BY pos) FROM movie_actor x WHERE x.mid = m.mid), '') AS actors,
  d.id AS district,
  coalesce((SELECT string_agg(CAST(did AS VARCHAR), ',' ORDER BY pos) FROM movie_director x WHERE x.mid = m.mid), '') AS directors,
  coalesce((SELECT string_agg(CAST(tid AS VARCHAR), ',' ORDER BY tid) FROM movie_trait x WHERE x.mid = m.mid), '') AS traits,
  m.rating
FROM movies m LEFT JOIN district_ids d ON d.name = m.district"""

for _dim in ("actor", "director", "genre", "district", "trait"):
    ORACLE[f"catalog_{_dim}"] = _CATALOG + f"""
SELECT n.id, n.name, row_number() OVER (PARTITION BY n.id ORDER BY m.rating DESC, m.mid) - 1 AS pos, m.mid
FROM b_{_dim} b JOIN {_dim}_ids n ON n.id = b.id JOIN movies m ON m.mid = b.mid"""

# ---- C2 interactions --------------------------------------------------------
_INTERACTIONS = _CATALOG + """,
""" + FX_RATING_RAW + """,
resolved AS (SELECT r.row_ord, r.name AS uname, m.mid, r.time, r.rating
             FROM fx_rating_raw r JOIN movies m ON m.name = r.movie),
users AS (SELECT uname AS name, row_number() OVER (ORDER BY min(row_ord)) - 1 AS id FROM resolved GROUP BY uname),
firsts AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY uname, mid ORDER BY row_ord) AS rn
                          FROM resolved) t WHERE rn = 1),
rating AS (SELECT row_number() OVER (ORDER BY f.row_ord) - 1 AS id, u.id AS uid, f.mid, f.time, f.rating
           FROM firsts f JOIN users u ON u.name = f.uname)
"""

ORACLE["interactions_rating"] = _INTERACTIONS + "SELECT id, uid, mid, time, rating FROM rating"
ORACLE["interactions_user"] = _INTERACTIONS + """
SELECT u.id, u.name, row_number() OVER (PARTITION BY u.id ORDER BY m.rating DESC, m.mid) - 1 AS pos, m.mid
FROM (SELECT DISTINCT uid, mid FROM rating) r JOIN users u ON u.id = r.uid JOIN movies m ON m.mid = r.mid"""
ORACLE["rating_rejects"] = _INTERACTIONS + """
SELECT r.rating, r.name, r.time, r.uid, r.movie FROM fx_rating_raw r
WHERE NOT EXISTS (SELECT 1 FROM movies m WHERE m.name = r.movie)"""
ORACLE["etl_summary"] = _INTERACTIONS + """
SELECT 'movies' AS entity, count(*) AS n FROM movies
UNION ALL SELECT 'directors', count(*) FROM director_ids
UNION ALL SELECT 'actors', count(*) FROM actor_ids
UNION ALL SELECT 'users', count(*) FROM users
UNION ALL SELECT 'ratings', count(*) FROM rating
UNION ALL SELECT 'csv_rows', count(*) FROM fx_rating_raw"""

# ---- C3-C7 serving ----------------------------------------------------------
_SERVING = _INTERACTIONS + """,
latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY uid, mid ORDER BY time DESC, id DESC) AS rn
                          FROM rating) t WHERE rn = 1)
"""


def _names(bridge, ids, idcol, order):
    return (f"coalesce((SELECT string_agg(CAST(n.id AS VARCHAR) || ':' || n.name, '|' ORDER BY {order}) FROM {bridge} x "
            f"JOIN {ids} n ON n.id = x.{idcol} WHERE x.mid = m.mid), '')")


ORACLE["movie_detail"] = _SERVING + f"""
SELECT m.mid AS id, m.name, m.rating, d.name AS district,
  {_names('movie_actor', 'actor_ids', 'aid', 'x.pos, x.aid')} AS actors,
  {_names('movie_director', 'director_ids', 'did', 'x.pos, x.did')} AS directors,
  {_names('movie_trait', 'trait_ids', 'tid', 'n.id')} AS traits,
  {_names('movie_genre', 'genre_ids', 'gid', 'n.id')} AS genres
FROM movies m LEFT JOIN district_ids d ON d.name = m.district"""

ORACLE["movies_by_request"] = _CATALOG + "," + FX_EVENT + """
SELECT m.mid AS id, m.name, d.id AS district, m.rating
FROM movies m LEFT JOIN district_ids d ON d.name = m.district
WHERE m.mid IN (SELECT mid FROM fx_event)"""

ORACLE["my_rating"] = _SERVING + "," + FX_EVENT + """
SELECT q.uid, q.mid, CAST(coalesce(l.rating, 0) AS BIGINT) AS myrating,
       CAST(coalesce(l.rating, 0) * 10 AS BIGINT) AS stars
FROM (SELECT uid, mid FROM fx_event UNION SELECT uid, mid FROM rating) q
LEFT JOIN latest l ON l.uid = q.uid AND l.mid = q.mid"""

for _dim in ("actor", "director"):
    ORACLE[f"person_page_{_dim}"] = _CATALOG + f"""
SELECT n.id, n.name, row_number() OVER (PARTITION BY n.id ORDER BY m.rating DESC, m.mid) - 1 AS pos, m.mid,
       m.name AS movie, m.rating
FROM b_{_dim} b JOIN {_dim}_ids n ON n.id = b.id JOIN movies m ON m.mid = b.mid"""

ORACLE["user_history"] = _SERVING + """
SELECT l.uid, u.name AS "user", row_number() OVER (PARTITION BY l.uid ORDER BY l.time DESC, l.mid) - 1 AS pos,
       l.mid, m.name AS movie, l.time, strftime(l.time, '%Y-%m-%d %H:%M') AS time_text, l.rating
FROM latest l JOIN users u ON u.id = l.uid JOIN movies m ON m.mid = l.mid"""

ORACLE["random_users"] = _INTERACTIONS.replace("WITH ", "WITH RECURSIVE ", 1) + f""",
size AS (SELECT count(*) AS n, greatest(1, (length(bin(count(*) - 1)) + 1) // 2) AS bits FROM users),
walk(pos, round, l, r) AS (
  SELECT pos, 0, pos >> bits, pos & ((1 << bits) - 1) FROM size, (SELECT unnest(range(5)) AS pos) p WHERE pos < n
  UNION ALL
  SELECT pos, e + 1, r, xor(l, xor(t >> 11, t >> 21) & ((1 << bits) - 1))
  FROM (SELECT *, (xor(u, u >> 7) * {MIX[1]}) & 4294967295 AS t
        FROM (SELECT *, (r * {MIX[0]} + {list(ROUNDS)}[e + 1]) & 2147483647 AS u
              FROM (SELECT *, CASE WHEN round = {len(ROUNDS)} THEN 0 ELSE round END AS e FROM walk, size) a) b) c
  WHERE round < {len(ROUNDS)} OR ((l << bits) | r) >= n)
SELECT w.pos, u.id, u.name FROM walk w, size s JOIN users u ON u.id = ((w.l << s.bits) | w.r)
WHERE w.round = {len(ROUNDS)} AND ((w.l << s.bits) | w.r) < s.n"""


def _paged(src, cols):
    return f"""
SELECT CAST(floor(id / 20) AS BIGINT) AS page, id, {cols},
       floor(id / 20) > 0 AS has_prev,
       count(*) OVER (PARTITION BY CAST(floor(id / 20) AS BIGINT)) = 20 AS has_next
FROM {src}"""


ORACLE["page_movies"] = _CATALOG + _paged("(SELECT mid AS id, name, rating FROM movies) t", "name, rating")
ORACLE["page_users"] = _INTERACTIONS + _paged("users", "name")
ORACLE["page_actors"] = _CATALOG + _paged("actor_ids", "name")
ORACLE["page_directors"] = _CATALOG + _paged("director_ids", "name")
ORACLE["home"] = _CATALOG + """
SELECT 'movie' AS kind, mid AS id, name, rating FROM movies WHERE mid < 4
UNION ALL SELECT 'actor', id, name, NULL FROM actor_ids WHERE id < 4
UNION ALL SELECT 'director', id, name, NULL FROM director_ids WHERE id < 4"""
ORACLE["movie_rejects"] = with_ctes(FX_MOVIE_RAW) + """
SELECT genre, actor, district, director, trait, rating, CAST(NULL AS VARCHAR) AS name FROM fx_movie_raw
WHERE CAST(split_part(name, '#', -1) AS BIGINT) % 50 = 0"""
ORACLE["catalog_dense_ids"] = with_ctes(FX_MOVIE_RAW, """
kept AS (SELECT * FROM fx_movie_raw WHERE CAST(split_part(name, '#', -1) AS BIGINT) % 50 <> 0),
firsts AS (SELECT name, min(row_ord) AS k, arg_min(district, row_ord) AS district FROM kept GROUP BY name)
""") + """
SELECT 'movie' AS kind, row_number() OVER (ORDER BY k) - 1 AS id, name FROM firsts
UNION ALL SELECT 'genre', row_number() OVER (ORDER BY min(row_ord)) - 1, genre FROM kept GROUP BY genre
UNION ALL SELECT 'district', row_number() OVER (ORDER BY min(k)) - 1, district FROM firsts GROUP BY district"""
ORACLE["published_movies"] = _CATALOG + """
SELECT m.mid AS id, m.name, d.id AS district, m.rating
FROM movies m LEFT JOIN district_ids d ON d.name = m.district"""
ORACLE["published_preview"] = _INTERACTIONS + "SELECT id, name FROM users WHERE id < 20"
ORACLE["append_ratings"] = _INTERACTIONS + "," + FX_EVENT + """
SELECT id, uid, mid, time, rating FROM rating
UNION ALL SELECT (SELECT max(id) FROM rating) + row_number() OVER (ORDER BY ts, uid, mid), uid, mid, ts, rating FROM fx_event"""

# ---- M1 / F8 / A8 -----------------------------------------------------------
_SPLIT = _INTERACTIONS + """,
tagged AS (SELECT id, uid, mid, rating, row_number() OVER (ORDER BY substr(md5(CAST(id AS VARCHAR)), 1, 13), id)
             <= floor(0.75 * count(*) OVER () + 0.5) AS is_train FROM rating),
train AS (SELECT id, uid, mid, rating FROM tagged WHERE is_train),
test_warm AS (SELECT id, uid, mid, rating FROM tagged t WHERE NOT is_train
              AND uid IN (SELECT uid FROM train) AND mid IN (SELECT mid FROM train))
"""
ORACLE["split_train"] = _SPLIT + "SELECT * FROM train"
ORACLE["split_test_warm"] = _SPLIT + "SELECT * FROM test_warm"
ORACLE["rmse_mean_baseline"] = _SPLIT + """
SELECT round(sqrt(avg(pow(t.rating - m.mu, 2))), 6) AS rmse
FROM test_warm t CROSS JOIN (SELECT avg(rating) AS mu FROM train) m"""

ORACLE["libsvm_roundtrip"] = _SPLIT + """
SELECT CAST(rating AS DOUBLE) AS label, uid, mid, CAST(2 AS DOUBLE) AS ones FROM test_warm"""


def _ridge(name, key, rows):
    """Closed solution for two factors: rows has (key, a, b, r)."""
    return f"""{name} AS (
  SELECT {key} AS id, (sbb * sar - sab * sbr) / (saa * sbb - sab * sab) AS a,
         (saa * sbr - sab * sar) / (saa * sbb - sab * sab) AS b
  FROM (SELECT {key}, sum(a * a) + 0.1 * count(*) AS saa, sum(b * b) + 0.1 * count(*) AS sbb, sum(a * b) AS sab,
               sum(a * r) AS sar, sum(b * r) AS sbr FROM ({rows}) x GROUP BY {key}) y)"""


ORACLE["fold_in"] = with_ctes(FX_ITEM, FX_RATING, FX_LATEST, """
known_items AS (SELECT id, rating / CAST(5 AS DOUBLE) AS a, 1 + id % 7 / CAST(7 AS DOUBLE) AS b FROM fx_item WHERE id % 10 <> 0),
known_users AS (SELECT DISTINCT uid AS id, uid % 11 / CAST(11 AS DOUBLE) AS a, 2 - uid % 3 / CAST(3 AS DOUBLE) AS b
                FROM fx_latest WHERE uid % 5 <> 0)""",
    _ridge("new_items", "mid", "SELECT l.mid, u.a, u.b, l.rating AS r FROM fx_latest l JOIN known_users u ON u.id = l.uid "
                               "WHERE l.mid % 10 = 0"),
    "items AS (SELECT * FROM known_items UNION ALL SELECT * FROM new_items)",
    _ridge("users", "uid", "SELECT l.uid, i.a, i.b, l.rating AS r FROM fx_latest l JOIN items i ON i.id = l.mid")) + """
SELECT 'user' AS kind, id, round(a, 6) AS f1, round(b, 6) AS f2 FROM users
UNION ALL SELECT 'movie', id, round(a, 6), round(b, 6) FROM new_items"""


def _damped(algo, key, first):
    return f"""
SELECT '{algo}' AS algo, g.reg, {first} + g.i AS run_ord,
       round(sqrt(avg(pow(t.rating - s.s / (s.n + g.reg), 2))), 9) AS rmse
FROM test_warm t JOIN (SELECT {key}, sum(rating) AS s, count(*) AS n FROM train GROUP BY {key}) s ON s.{key} = t.{key}
CROSS JOIN (SELECT unnest(range({len(_REGS)})) AS i, CAST(unnest({_REGS}) AS DOUBLE) AS reg) g
GROUP BY g.reg, g.i"""


_REGS = sorted({float(r) for r in ALS_REGS})
ORACLE["model_report"] = _SPLIT + f""", runs AS ({_damped('movie_mean', 'mid', 0)}
UNION ALL {_damped('user_mean', 'uid', len(_REGS))}),
best AS (SELECT *, row_number() OVER (PARTITION BY algo ORDER BY rmse, run_ord) AS rn FROM runs)
SELECT algo, CAST(0 AS INT) AS rank, CAST(0 AS INT) AS max_iter, reg, rmse FROM best WHERE rn = 1"""

# ---- X8 / ST1-ST3 -----------------------------------------------------------
RAW_EVENT = """raw_event AS (
  SELECT event_id, ts, user_id AS uid, json_extract_string(props, '$.k') AS mid_text,
         CAST(CAST(floor(value / 25) AS BIGINT) AS VARCHAR) AS rating_text FROM events)"""
_VALID = with_ctes(RAW_EVENT, """valid AS (
  SELECT event_id, ts, uid, TRY_CAST(mid_text AS INT) AS mid, TRY_CAST(rating_text AS INT) AS rating
  FROM raw_event WHERE TRY_CAST(mid_text AS INT) IS NOT NULL AND TRY_CAST(rating_text AS INT) BETWEEN 1 AND 10)
""")
ORACLE["rating_input_valid"] = _VALID + "SELECT * FROM valid"
ORACLE["stream_ingest"] = _VALID + """
SELECT row_number() OVER (ORDER BY ts, event_id) - 1 AS id, uid, mid, ts, rating, event_id FROM valid"""
ORACLE["stream_latest"] = with_ctes(FX_EVENT) + """
SELECT uid, mid, rating, ts, event_id FROM (
  SELECT *, row_number() OVER (PARTITION BY uid, mid ORDER BY ts DESC, event_id DESC) AS rn FROM fx_event) t
WHERE rn = 1"""
_LATEST_WITH_EVENTS = """fx_latest AS (SELECT uid, mid, rating FROM (
  SELECT *, row_number() OVER (PARTITION BY uid, mid ORDER BY time DESC, k1 DESC, k2 DESC, k3 DESC, k4 DESC) AS rn
  FROM (SELECT o_custkey AS uid, l_partkey AS mid, o_orderdate AS time, CAST(ceil(l_quantity / 5) AS BIGINT) AS rating,
               l_orderkey AS k1, l_linenumber AS k2, l_suppkey AS k3, l_extendedprice AS k4
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        UNION ALL SELECT uid, mid, ts, rating, event_id, 0, 0, 0.0 FROM fx_event) u) t WHERE rn = 1)"""
ORACLE["stream_refresh"] = with_ctes(FX_ITEM, FX_ACTOR, FX_EVENT, _LATEST_WITH_EVENTS, FX_BRIDGE,
                                     _RECALL_TAIL) + """
SELECT uid, pos, mid FROM recall_out WHERE uid IN (SELECT uid FROM fx_event)"""

# ---- S1 / S2 / S3 -------------------------------------------------------------
ORACLE["catalog_from_csv"] = ORACLE["catalog_movie"]
ORACLE["interactions_from_csv"] = ORACLE["interactions_rating"]
ORACLE["crawl_normalised"] = with_ctes("""casts AS (
  SELECT mid, string_agg(actor_name, '|' ORDER BY actor_name) AS casts
  FROM """ + CREDIT_NAMES + """ x GROUP BY mid)""") + """
SELECT p_brand || '-' || CAST(p_size AS VARCHAR) AS directors,
       CASE WHEN p_size % 10 = 0 THEN 0.0 ELSE ((p_partkey * 37) % 1000) / CAST(100 AS DOUBLE) END AS rate,
       p_name || '#' || CAST(p_partkey AS VARCHAR) AS title, coalesce(c.casts, '') AS casts,
       '电影' AS form, '战争' AS Type,
       ['美国', '香港', '台湾', '日本', '韩国', '英国', '法国'][CAST(p_size % 7 + 1 AS INT)] AS country,
       ['经典', '青春', '文艺', '搞笑', '励志', '魔幻', '感人', '女性', '黑帮'][CAST(p_partkey % 9 + 1 AS INT)] AS genres
FROM part LEFT JOIN casts c ON c.mid = p_partkey"""
ORACLE["append_csv"] = ORACLE["crawl_normalised"].replace("SELECT p_brand", "SELECT * FROM (SELECT p_brand", 1) + """
) x CROSS JOIN (SELECT unnest([1, 2])) twice(n)"""
ORACLE["append_csv"] = ORACLE["append_csv"].replace("SELECT * FROM (", "SELECT x.* FROM (", 1)
ORACLE["crawl_rejects"] = """
SELECT p_partkey AS start, CASE p_partkey % 10 WHEN 3 THEN '{"data":[{"directors":["x'
         WHEN 7 THEN '<html>busy</html>' ELSE '{"message":"none"}' END AS body
FROM part WHERE p_partkey % 10 IN (3, 7, 9)
UNION ALL SELECT count(*), 'rows kept' FROM part WHERE p_partkey % 10 NOT IN (3, 5, 7, 9)"""
ORACLE["crawl_tokens"] = r"""
SELECT p_partkey AS id, array_to_string(regexp_extract_all(
  '{''rate'': ''' || CAST(p_size % 10 AS VARCHAR) || '.5'', ''title'': ''' ||
  ['美国', '香港', '台湾', '日本', '韩国', '英国', '法国'][CAST(p_size % 7 + 1 AS INT)] || '：经典 ' || p_brand || ' ' ||
  CAST(p_partkey AS VARCHAR) || ''', ''casts'': [''徐峥'', ''周-杰·伦'']}',
  '\d\.\d|[\p{L}\p{N}_]+(?:[ ，\-：·！。？()][\p{L}\p{N}_]*)*'), '|') AS tokens
FROM part"""
ORACLE["csv_malformed"] = """
WITH movies AS (
  SELECT p_partkey % 20 AS k, p_type || ',A|B,D1,' || p_brand || ',T,' ||
         CASE WHEN p_partkey % 20 = 3 THEN 'n/a' ELSE CAST(p_partkey % 10 AS VARCHAR) END || ',' || p_partkey AS line, p_type
  FROM part),
ratings AS (
  SELECT o_orderkey % 50 AS k, CASE WHEN o_orderkey % 50 = 1 THEN '7.5' ELSE CAST(o_orderkey % 10 AS VARCHAR) END || ',' ||
         o_custkey || ',' || CASE WHEN o_orderkey % 50 = 2 THEN 'yesterday' ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END
         || ',' || o_custkey || ',' || o_orderkey AS line
  FROM orders)
SELECT 'movie' AS kind, CASE k WHEN 7 THEN line || ',more' WHEN 11 THEN p_type ELSE line END AS line, 1 AS n
FROM movies WHERE k IN (3, 7, 11)
UNION ALL SELECT 'movie', 'good', count(*) FROM movies WHERE k NOT IN (3, 7, 11)
UNION ALL SELECT 'rating', line, 1 FROM ratings WHERE k IN (1, 2)
UNION ALL SELECT 'rating', 'good', count(*) FROM ratings WHERE k NOT IN (1, 2)"""
