"""SQL building blocks for the second engine: the same tables, written as CTEs."""

COHORT = """
WITH line_totals AS (
  SELECT l_orderkey AS id, count(*) AS k,
         sum(CAST(l_quantity AS BIGINT)) AS qty, max(CAST(l_quantity AS BIGINT)) AS max_qty,
         sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS cents,
         sum(CAST(round(l_discount * 100) AS BIGINT)) AS disc,
         sum(CAST(round(l_tax * 100) AS BIGINT)) AS tax,
         sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS returned
  FROM lineitem GROUP BY l_orderkey),
base_rows AS (
  SELECT o_orderkey AS id,
         CAST(o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' AS INTEGER) AS label,
         c_mktsegment AS segment, n_name AS grp, substr(o_orderpriority, 1, 1) AS priority,
         CAST(year(o_orderdate) AS INTEGER) AS order_year, c_acctbal AS balance,
         CAST(k AS DOUBLE) AS n_lines, CAST(qty AS DOUBLE) AS qty,
         CAST(max_qty AS DOUBLE) AS max_qty, CAST(cents AS DOUBLE) / 100.0::DOUBLE AS price,
         CAST(disc AS DOUBLE) / (CAST(k AS DOUBLE) * 100.0::DOUBLE) AS avg_disc,
         CAST(tax AS DOUBLE) / (CAST(k AS DOUBLE) * 100.0::DOUBLE) AS avg_tax,
         CAST(returned AS DOUBLE) AS returned
  FROM orders JOIN customer ON o_custkey = c_custkey
       JOIN nation ON c_nationkey = n_nationkey
       LEFT JOIN line_totals t ON t.id = o_orderkey),
cohort AS (
  SELECT *,
    coalesce(floor((avg_disc / 0.1::DOUBLE * 0.5::DOUBLE + avg_tax / 0.08::DOUBLE * 0.25::DOUBLE
             + label * 0.2::DOUBLE) * 10000 + 0.5::DOUBLE) / 10000.0::DOUBLE, 0) AS score,
    coalesce(floor((avg_tax / 0.08::DOUBLE * 0.8::DOUBLE + label * 0.2::DOUBLE)
             * 10000 + 0.5::DOUBLE) / 10000.0::DOUBLE, 0) AS score_b,
    coalesce(floor((avg_disc / 0.1::DOUBLE * 0.7::DOUBLE + label * 0.2::DOUBLE * 0.5::DOUBLE)
             * 10000 + 0.5::DOUBLE) / 10000.0::DOUBLE, 0) AS score_c
  FROM base_rows)"""

SEASON = COHORT + """,
season AS (
  SELECT CAST(id AS VARCHAR) AS player_id, label AS drafted,
    CASE segment WHEN 'AUTOMOBILE' THEN 'Combo G' WHEN 'BUILDING' THEN 'PG'
      WHEN 'FURNITURE' THEN 'Stretch 4' WHEN 'HOUSEHOLD' THEN 'C'
      WHEN 'MACHINERY' THEN 'Wing G' ELSE segment END AS type,
    CASE grp WHEN 'NATION_1' THEN 'B10' WHEN 'NATION_2' THEN 'B12' WHEN 'NATION_3' THEN 'ACC'
      WHEN 'NATION_4' THEN 'SEC' WHEN 'NATION_5' THEN 'P12' WHEN 'NATION_6' THEN 'BE'
      ELSE grp END AS conf,
    CASE priority WHEN '1' THEN 'Fr' WHEN '2' THEN 'So' WHEN '3' THEN 'Jr' WHEN '4' THEN 'Sr'
      ELSE priority END AS yr,
    CASE WHEN id % 10 = 0 THEN 'n/a' ELSE CAST(order_year AS VARCHAR) END AS year,
    n_lines * 4 AS "GP", qty / 10 AS mp, qty / 4 AS "Min_per", n_lines * 3 + 5 AS usg,
    avg_disc * 600 AS "eFG", avg_disc * 500 + 20 AS "TS_per",
    CASE WHEN returned > 0 THEN avg_tax * 1000 END AS "TP_per",
    CASE WHEN returned > 0 THEN n_lines / returned END AS ast_tov,
    returned * 8 AS "AST_per", n_lines * 2 AS "TO_per", avg_tax * 40 AS stl_per,
    avg_disc * 60 AS blk_per, avg_tax * 150 AS "ORB_per", avg_disc * 200 AS "DRB_per",
    price / 49999 - 4 AS bpm, qty / 8 AS pts, max_qty / 5 AS treb,
    returned * 1.5::DOUBLE AS ast, avg_tax * 20 AS stl, avg_disc * 25 AS blk,
    max_qty / 2 + 60 AS height_numeric,
    CASE WHEN returned > 1 THEN balance / 10 + 100 END AS "Rec_Rank"
  FROM cohort)"""

HEIGHTS = """
WITH parts AS (
  SELECT p_partkey AS id, p_brand AS brand, p_size % 12 AS inches, p_partkey % 3 + 5 AS feet,
    CASE p_partkey % 3 + 5 WHEN 5 THEN 'May' WHEN 6 THEN 'Jun' ELSE 'Jul' END AS mon
  FROM part),
heights AS (
  SELECT id, brand, CASE id % 13
    WHEN 0 THEN inches || '-' || mon
    WHEN 1 THEN mon || '-' || lpad(CAST(inches AS VARCHAR), 2, '0')
    WHEN 2 THEN inches || '/' || mon
    WHEN 3 THEN inches || '-' || lower(mon) || 'e'
    WHEN 4 THEN feet || '-' || inches
    WHEN 5 THEN feet || '-00'
    WHEN 6 THEN CAST(feet AS VARCHAR)
    WHEN 7 THEN CAST(feet * 12 + inches AS VARCHAR)
    WHEN 8 THEN '9' WHEN 9 THEN '-' WHEN 10 THEN ''
    WHEN 11 THEN '  ' || inches || '-' || mon || ' '
    END AS ht
  FROM parts)"""


def on_cohort(body: str) -> str:
    return f"{COHORT}\n{body}"


def on_season(body: str) -> str:
    return f"{SEASON}\n{body}"


def on_heights(body: str) -> str:
    return f"{HEIGHTS}\n{body}"
