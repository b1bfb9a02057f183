"""Inputs derived from the driver's tables, in SQL that Spark and DuckDB both take."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

RAW = """raw AS (
  SELECT l_partkey AS pk, CAST(l_shipdate AS DATE) AS d, CAST(l_linenumber % 3 AS INT) AS sn,
         min(l_orderkey) AS ok, min(l_suppkey) AS sk, min(l_linenumber) AS ln, min(l_quantity) AS qty,
         min(l_extendedprice) AS ep, min(l_discount) AS disc, min(l_tax) AS tax,
         min(l_returnflag) AS rf, min(l_linestatus) AS ls
  FROM lineitem GROUP BY l_partkey, CAST(l_shipdate AS DATE), CAST(l_linenumber % 3 AS INT))"""

OBS = (
    RAW
    + """,
obs AS (
  SELECT CASE sn WHEN 0 THEN 'LT5' WHEN 1 THEN 'LE7' ELSE 'LT4' END || '035032' || CAST(year(d) AS STRING)
           || lpad(CAST(dayofyear(d) AS STRING), 3, '0') || 'XXX03' AS scene_id,
         CAST(35 AS INT) AS path, CAST(32 AS INT) AS row,
         CAST(year(d) AS INT) AS year, CAST(month(d) AS INT) AS month, CAST(dayofyear(d) AS INT) AS julian,
         CAST(floor(pk / 50) AS INT) AS y, CAST(pk % 50 AS INT) AS x,
         CAST(100 + floor(qty * 20) AS INT)              AS b1,
         CAST(150 + (ok * 3 + ln) % 1200 AS INT)         AS b2,
         CAST(200 + ok % 1500 AS INT)                    AS b3,
         CAST(500 + CAST(floor(ep) AS BIGINT) % 4000 AS INT) AS b4,
         CAST(300 + (sk * 37 + ln * 113) % 3500 AS INT)  AS b5,
         CAST(100 + (ok * 7 + pk * 13) % 2500 AS INT)    AS b7,
         CAST(CASE WHEN disc > 0.095 THEN 1 ELSE 0 END AS INT)               AS qa_fill,
         CAST(CASE WHEN rf = 'R' AND ls = 'O' THEN 1 ELSE 0 END AS INT)      AS qa_cloud,
         CAST(CASE WHEN tax > 0.075 THEN 1 ELSE 0 END AS INT)                AS qa_adjacent,
         CAST(CASE WHEN ln = 7 THEN 1 ELSE 0 END AS INT)                     AS qa_shadow,
         CAST(CASE WHEN month(d) IN (12, 1, 2) AND qty > 45 THEN 1 ELSE 0 END AS INT) AS qa_snow,
         CAST(CASE WHEN pk % 29 = 0 THEN 1 ELSE 0 END AS INT)                AS qa_water,
         CAST(qty * 2 AS INT) AS raw_prob
  FROM raw)"""
)

SCENES = """scenes AS (
  SELECT *, sensor || lpad(CAST(path AS STRING), 3, '0') || lpad(CAST(row AS STRING), 3, '0') || CAST(year(d) AS STRING)
            || lpad(CAST(dayofyear(d) AS STRING), 3, '0') || 'XXX' || lpad(CAST(o % 100 AS STRING), 2, '0') AS scene_id,
         '/data/' || sensor || lpad(CAST(path AS STRING), 3, '0') || lpad(CAST(row AS STRING), 3, '0') || CAST(year(d) AS STRING)
            || lpad(CAST(dayofyear(d) AS STRING), 3, '0') || 'XXX' || lpad(CAST(o % 100 AS STRING), 2, '0')
            || CASE WHEN o % 17 = 0 THEN '.aux.xml' ELSE '.xml' END AS file,
         ul_x + 30.0 * 199 AS lr_x, ul_y - 30.0 * 149 AS lr_y
  FROM (SELECT o_orderkey AS o, CAST(o_orderdate AS DATE) AS d, CAST(CAST(o_orderdate AS DATE) AS STRING) AS acq_date,
         CAST(10 + o_custkey % 39 AS INT) AS path, CAST(26 + CAST(floor(o_custkey / 39) AS INT) % 18 AS INT) AS row,
         CASE o_orderkey % 3 WHEN 0 THEN 'LT4' WHEN 1 THEN 'LT5' ELSE 'LE7' END AS sensor,
         CASE WHEN o_orderkey % 23 = 0 THEN NULL WHEN o_orderstatus = 'P' THEN 'L1G' ELSE 'L1T' END AS data_type,
         CAST((o_custkey % 130) / 10.0 AS DOUBLE) AS rmse,
         CAST(CAST(floor(o_totalprice) AS BIGINT) % 101 AS DOUBLE) AS cloud_cover,
         CAST(300000 + 30 * (o_custkey % 50) AS DOUBLE) AS ul_x, CAST(4500000 - 30 * (o_custkey % 40) AS DOUBLE) AS ul_y,
         CASE WHEN o_orderkey % 2 = 0 THEN 'CENTER' ELSE 'UL' END AS grid_origin,
         CAST(30.0 AS DOUBLE) AS dx, CAST(30.0 AS DOUBLE) AS dy, CAST(150 AS INT) AS nrow, CAST(200 AS INT) AS ncol, CAST(13 AS INT) AS utm_zone
        FROM orders) s)"""

POINTS = """points AS (
  SELECT c_custkey AS point_id, CAST(300000 + 7.5 * (c_custkey % 997) AS DOUBLE) AS px, CAST(4500000 - 7.5 * (c_custkey % 613) AS DOUBLE) AS py
  FROM customer)"""

GRIDS = """grids AS (
  SELECT scene_id, path, row, CAST(CASE substr(scene_id, 1, 3) WHEN 'LT5' THEN 300000 WHEN 'LE7' THEN 300030 ELSE 299970 END AS DOUBLE) AS west,
         CAST(4500000 AS DOUBLE) AS north, CAST(30 AS DOUBLE) AS dx, CAST(30 AS DOUBLE) AS dy
  FROM (SELECT DISTINCT scene_id, path, row FROM obs) s)"""

#: Grids that are out of phase: one sensor by 0.4 of a pixel, one by half a pixel and three whole ones.
PHASES = """grids AS (
  SELECT scene_id, path, row, CAST(CASE substr(scene_id, 1, 3) WHEN 'LT5' THEN 300000 WHEN 'LE7' THEN 300012 ELSE 299985 END AS DOUBLE) AS west,
         CAST(CASE substr(scene_id, 1, 3) WHEN 'LT5' THEN 4500000 WHEN 'LE7' THEN 4499994 ELSE 4500105 END AS DOUBLE) AS north, CAST(30 AS DOUBLE) AS dx, CAST(30 AS DOUBLE) AS dy
  FROM (SELECT DISTINCT scene_id, path, row FROM obs) s)"""

#: The same rules as functions.quality and functions.indices, for the oracles.
QA = "CAST(CASE WHEN qa_fill > 0 THEN -9999 WHEN qa_cloud > 0 THEN -7 WHEN qa_adjacent > 0 THEN -6 WHEN qa_shadow > 0 THEN -5 WHEN qa_snow > 0 THEN -4 WHEN qa_water > 0 THEN -3 ELSE 0 END AS INT)"
OBS_QA = OBS + f",\nobs_qa AS (SELECT *, {QA} AS qa FROM obs)"


def _ratio(a: str, b: str) -> str:
    return f"CASE WHEN {a} + {b} = 0 THEN 0.0 ELSE CAST({a} - {b} AS DOUBLE) / CAST({a} + {b} AS DOUBLE) END"


BANDS_OF = {"ndvi": ("b4", "b3"), "ndmi": ("b4", "b5"), "nbr": ("b4", "b7"), "nbr2": ("b5", "b7")}
STORED = {n: f"CAST(CASE WHEN qa < 0 OR {a} = -9999 OR {b} = -9999 THEN -9999 ELSE greatest(least(round(({_ratio(a, b)}) * 1000), 32767.0), -32768.0) END AS SMALLINT)" for n, (a, b) in BANDS_OF.items()}
FEATURE = {n: f"CAST(CASE WHEN qa = -9999 THEN 0.0 ELSE ({_ratio(a, b)}) * 1000 END AS DOUBLE)" for n, (a, b) in BANDS_OF.items()}


def two_stacks(ctes: str) -> str:
    """The same with looks of two stacks on the same lines and columns; those of the second one are four years later."""
    path = "CAST(32 + CAST(floor(pk / 50) AS INT) % 2 AS INT)"
    two = OBS.replace("'035032'", f"lpad(CAST({path} AS STRING), 3, '0') || '032'").replace("CAST(35 AS INT) AS path", f"{path} AS path")
    two = two.replace("CAST(floor(pk / 50) AS INT) AS y", "CAST(floor(pk / 100) AS INT) AS y").replace("FROM raw)", f"FROM (SELECT pk, sn, ok, sk, ln, qty, ep, disc, tax, rf, ls, CASE WHEN {path} = 33 THEN d + 1461 ELSE d END AS d FROM raw) r)")
    return ctes.replace(OBS, two)


SHOTS = """shots AS (
  SELECT DISTINCT scene_id, path, row, CAST(make_date(year, 1, 1) + CAST(julian - 1 AS INT) AS STRING) AS acq_date,
         CASE WHEN julian % 11 = 0 THEN 'L1G' ELSE 'L1T' END AS data_type, CAST((julian % 23) / 2.0 AS DOUBLE) AS rmse,
         CAST((year * 7 + julian) % 101 AS DOUBLE) AS cloud_cover
  FROM obs)"""


def screened(ctes: str) -> str:
    """The same with the scenes of the looks, and only looks of scenes that pass the usual screen."""
    all_looks = f"{QA} AS qa FROM obs)"
    kept = "scene_id IN (SELECT scene_id FROM shots WHERE data_type <> 'L1G' AND rmse <= 10.0 AND cloud_cover <= 80.0)"
    return ctes.replace(f",\nobs_qa AS (SELECT *, {all_looks}", f",\n{SHOTS},\nobs_qa AS (SELECT *, {QA} AS qa FROM obs WHERE {kept})")


LOOKS = OBS_QA + ",\nlooks AS (SELECT *, " + ", ".join(f"{e} AS {n}" for n, e in STORED.items()) + " FROM obs_qa)"
BURN_PROB = OBS_QA + """,
burn_prob AS (
  SELECT CAST(year * 10 + CAST(floor((month - 1) / 6) AS INT) AS INT) AS scene, y, x,
         CAST(max(CASE WHEN qa = -9999 THEN -9999 WHEN qa < 0 THEN -9998 ELSE raw_prob END) AS INT) AS burn_prob
  FROM obs_qa GROUP BY 1, 2, 3)"""

_TABLES = ("lineitem", "orders", "customer")


def view(spark: SparkSession, sf_dir: str, ctes: str, name: str) -> DataFrame:
    """The last result of some of the above, as a DataFrame."""
    for t in _TABLES:
        if t in ctes:
            spark.read.parquet(f"{sf_dir}/{t}.parquet").createOrReplaceTempView(t)
    return spark.sql(f"WITH {ctes} SELECT * FROM {name}")
