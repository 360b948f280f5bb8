"""SQL text of the driver-table mapping (FIXTURES.md section 2), as DuckDB CTEs.

Used only by the correctness gate (``oracle_sql``) and the tests; the Spark side
builds the same frames with the DataFrame API in ``sources/driver_tables.py``.
"""

FX_ITEM = """fx_item AS (
  SELECT p_partkey AS id, p_name || '#' || CAST(p_partkey AS VARCHAR) AS name,
         ((p_partkey * 37) % 1000) / CAST(100 AS DOUBLE) AS rating,
         p_brand || '-' || CAST(p_size AS VARCHAR) AS director,
         p_type AS genre, 'D' || CAST(p_size % 25 AS VARCHAR) AS district
  FROM part)"""

FX_ACTOR = """fx_actor AS (
  SELECT DISTINCT l_partkey AS mid,
         l_suppkey * 1000 + (l_orderkey % 20) * 50 + CAST(l_quantity AS BIGINT) - 1 AS aid FROM lineitem
  WHERE l_partkey % 5 <> 0)"""

CREDIT_NAMES = """(SELECT DISTINCT l_partkey AS mid, s_name || '/' ||
         CAST((l_orderkey % 20) * 50 + CAST(l_quantity AS BIGINT) - 1 AS VARCHAR) AS actor_name
       FROM lineitem JOIN supplier ON s_suppkey = l_suppkey WHERE l_partkey % 5 <> 0)"""

FX_RATING = """fx_rating AS (
  SELECT o_custkey AS uid, l_partkey AS mid, o_orderdate AS time,
         CAST(ceil(l_quantity / 5) AS BIGINT) AS rating,
         row_number() OVER (PARTITION BY o_custkey, l_partkey
           ORDER BY o_orderdate DESC, l_orderkey DESC, l_linenumber DESC, l_suppkey DESC,
                    l_extendedprice DESC) AS rn
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

FX_LATEST = """fx_latest AS (SELECT uid, mid, time, rating FROM fx_rating WHERE rn = 1)"""

FX_BRIDGE = """fx_bridge AS (
  SELECT mid, 'a' AS role, CAST(aid AS VARCHAR) AS pid FROM fx_actor
  UNION ALL SELECT id AS mid, 'd' AS role, director AS pid FROM fx_item)"""

FX_MOVIE_RAW = f"""fx_movie_raw AS (
  SELECT row_number() OVER (ORDER BY p_partkey, l_returnflag, l_linestatus) - 1 AS row_ord,
         p_type || '-' || l_linestatus AS genre, actor, 'D' || CAST(p_size % 25 AS VARCHAR) AS district,
         p_brand || '-' || CAST(p_size AS VARCHAR) AS director, 'T' || l_returnflag AS trait,
         ((p_partkey * 37) % 1000) / CAST(100 AS DOUBLE)
           + CASE WHEN l_linestatus = 'O' THEN 0.5 ELSE 0.0 END AS rating,
         p_name || '#' || CAST(p_partkey AS VARCHAR) AS name
  FROM part
  JOIN (SELECT DISTINCT l_partkey, l_returnflag, l_linestatus FROM lineitem) f ON f.l_partkey = p_partkey
  LEFT JOIN (SELECT mid, string_agg(actor_name, '|' ORDER BY actor_name) AS actor
             FROM {CREDIT_NAMES} x GROUP BY mid) a ON a.mid = p_partkey)"""

FX_RATING_RAW = """fx_rating_raw AS (
  SELECT row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity) - 1 AS row_ord,
         CAST(ceil(l_quantity / 5) AS BIGINT) AS rating, c_name AS name, o_orderdate AS time,
         o_custkey AS uid,
         CASE WHEN l_linenumber = 7 THEN p_name ELSE p_name || '#' || CAST(p_partkey AS VARCHAR) END AS movie
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON c_custkey = o_custkey
       JOIN part ON p_partkey = l_partkey)"""

FX_EVENT = """fx_event AS (
  SELECT event_id, ts, user_id AS uid, CAST(regexp_replace(props, '[^0-9]', '', 'g') AS INT) AS mid,
         CAST(least(10, 1 + floor(value / 50)) AS INT) AS rating
  FROM events)"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"
