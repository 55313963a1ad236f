"""Driver queries: each operator run on the star-schema tables, with a DuckDB oracle.

Analogy: orders = matches, lineitem = deliveries, supplier/part/customer = people,
nation = the name source, region = team -> league. Each `q_*` takes (spark, sf_dir)
and reads whole tables; `ORACLE[name]` is the same query in ANSI SQL for DuckDB.
Fixture derivations (e.g. forced lookup misses) are the same on both sides.
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scorebook.functions.columns import (ball_facts, blank_to_null, cast_timestamps_to_date, cast_to_schema,
                                         drop_prefixed, innings_key, match_type_fix, nested_json_value,
                                         opponent, rename_columns, replace_values)
from scorebook.operators import keys as K
from scorebook.operators.extract import (attach_events, extract_deliveries, extract_match_info,
                                         extract_registry, quarantine_reasons, readable_documents, valid_documents)
from scorebook.operators.resolve import (name_override, person_dimension, person_names, resolve_roles,
                                         resolve_roles_by_map)
from scorebook.operators.sequence import (Scratch, attach_positions, first_appearance_order, running_total,
                                          running_total_with_ids, sequential_id, stage)
from scorebook.plans.dataset import build_dataset
from scorebook.plans.search import competition_search, event_rows, register
from scorebook.schemas import DOCUMENT_DDL, INFO_DDL
from scorebook.session import default_partitions
from scorebook.sources.documents import json_text, key_from_path, parse_documents, yaml_to_json
from scorebook.sources.tables import sql_parquet

_view_ids = itertools.count()


def t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d.rstrip('/')}/{name}.parquet")


def _s(prefix: str, c: str) -> Column:
    return F.concat(F.lit(prefix), F.col(c).cast("string"))


def _miss(cond: Column, key: Column) -> Column:
    """`key`, or a key that nothing else has where `cond` holds: that row's lookups miss."""
    return F.when(cond, F.concat(F.lit("x"), key)).otherwise(key)


ORACLE: dict[str, str] = {}

# ---------------------------------------------------------------------------------------
# shared star fixtures (Spark side and SQL side, kept next to each other)

def star_people(spark, d) -> DataFrame:
    # every row is kept; a lookup miss is forced by a changed key ("x..."), the same on the SQL side
    sup = t(spark, d, "supplier").select(
        _miss(F.col("s_nationkey") == 3, _s("S", "s_suppkey")).alias("identifier"), F.col("s_nationkey").cast("string").alias("key_cricinfo"),
        F.col("s_name").alias("name"), _s("S", "s_suppkey").alias("unique_name"))
    part = t(spark, d, "part").select(
        _miss(F.col("p_size") == 7, _s("P", "p_partkey")).alias("identifier"), F.lit(None).cast("string").alias("key_cricinfo"),
        F.col("p_name").alias("name"), _s("P", "p_partkey").alias("unique_name"))
    cust = t(spark, d, "customer").select(
        _miss(F.col("c_mktsegment") == "MACHINERY", _s("C", "c_custkey")).alias("identifier"), F.col("c_nationkey").cast("string").alias("key_cricinfo"),
        F.col("c_name").alias("name"), _s("C", "c_custkey").alias("unique_name"))
    return sup.unionByName(part).unionByName(cust)


def star_cricinfo(spark, d) -> DataFrame:
    """Raw headers (upper case, spaces) to exercise the P4 rename."""
    return t(spark, d, "nation").select(
        _miss(F.col("n_regionkey") == 1, F.col("n_nationkey").cast("string")).alias("ID"),
        F.concat(F.lit("Full "), F.col("n_name")).alias("NAME"),
        F.lit("Right-hand bat").alias("BATTING STYLE"), F.lit("Right-arm").alias("BOWLING STYLE"))


def star_leagues(spark, d) -> DataFrame:
    r = t(spark, d, "region")
    return r.select(
        F.when(F.col("r_regionkey") == 0, "Team A").when(F.col("r_regionkey") == 1, "Team N")
        .when(F.col("r_regionkey") == 2, "Royal Challengers Bangalore").otherwise(F.concat(F.lit("x"), "r_name"))
        .alias("team_name"),
        F.when(F.col("r_regionkey") == 0, F.concat("r_name", F.lit(" International")))
        .otherwise(F.concat("r_name", F.lit(" League"))).alias("league"),
        F.col("r_regionkey").alias("league_tier"))


SQL_PEOPLE = """
people AS (
  SELECT CASE WHEN s_nationkey = 3 THEN 'x' ELSE '' END || 'S' || CAST(s_suppkey AS VARCHAR) AS person_id,
         CAST(s_nationkey AS VARCHAR) AS key_cricinfo,
         s_name AS person_name, 'S' || CAST(s_suppkey AS VARCHAR) AS person_unique_name
  FROM supplier
  UNION ALL
  SELECT CASE WHEN p_size = 7 THEN 'x' ELSE '' END || 'P' || CAST(p_partkey AS VARCHAR), CAST(NULL AS VARCHAR), p_name,
         'P' || CAST(p_partkey AS VARCHAR)
  FROM part
  UNION ALL
  SELECT CASE WHEN c_mktsegment = 'MACHINERY' THEN 'x' ELSE '' END || 'C' || CAST(c_custkey AS VARCHAR),
         CAST(c_nationkey AS VARCHAR), c_name, 'C' || CAST(c_custkey AS VARCHAR)
  FROM customer),
ci AS (SELECT CASE WHEN n_regionkey = 1 THEN 'x' ELSE '' END || CAST(n_nationkey AS VARCHAR) AS key_cricinfo,
              'Full ' || n_name AS person_name_espn
       FROM nation),
pdim AS (SELECT p.person_id, p.key_cricinfo, COALESCE(ci.person_name_espn, p.person_name) AS person_name,
                p.person_unique_name
         FROM people p LEFT JOIN ci ON p.key_cricinfo = ci.key_cricinfo)"""
SQL_NAMES = SQL_PEOPLE + """,
names AS MATERIALIZED (SELECT DISTINCT r.match_id, COALESCE(pd.person_name, r.person_name) AS person_name, r.person_id,
                 pd.person_unique_name
          FROM registry r LEFT JOIN pdim pd ON r.person_id = pd.person_id)"""

# registry: suppliers and parts of each order's lines, plus the order's customer
SQL_REGISTRY = """
registry AS MATERIALIZED (
  SELECT DISTINCT CAST(l_orderkey AS VARCHAR) AS match_id, 'S' || CAST(l_suppkey AS VARCHAR) AS person_name,
         'S' || CAST(l_suppkey AS VARCHAR) AS person_id FROM lineitem
  UNION
  SELECT DISTINCT CAST(l_orderkey AS VARCHAR), 'P' || CAST(l_partkey AS VARCHAR), 'P' || CAST(l_partkey AS VARCHAR)
  FROM lineitem
  UNION
  SELECT CAST(o_orderkey AS VARCHAR), 'C' || CAST(o_custkey AS VARCHAR), 'C' || CAST(o_custkey AS VARCHAR)
  FROM orders)"""


def star_registry(spark, d) -> DataFrame:
    """A person of an order once for each line; `person_names` makes them distinct."""
    li = t(spark, d, "lineitem")
    mid = F.col("l_orderkey").cast("string").alias("match_id")
    s = li.select(mid, _s("S", "l_suppkey").alias("person_name"), _s("S", "l_suppkey").alias("person_id"))
    p = li.select(mid, _s("P", "l_partkey").alias("person_name"), _s("P", "l_partkey").alias("person_id"))
    c = t(spark, d, "orders").select(F.col("o_orderkey").cast("string").alias("match_id"),
                                     _s("C", "o_custkey").alias("person_name"), _s("C", "o_custkey").alias("person_id"))
    return s.unionByName(p).unionByName(c)


def star_names(spark, d, registry: DataFrame | None = None) -> DataFrame:
    people = person_dimension(star_people(spark, d), star_cricinfo(spark, d))
    return person_names(registry if registry is not None else star_registry(spark, d), people)


# ---------------------------------------------------------------------------------------
# F11, F12, C6

def _li_delivery(li: DataFrame) -> DataFrame:
    return li.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                     (F.col("l_linenumber").cast("double") + (F.col("l_quantity") % 10) / 10).alias("delivery"),
                     F.floor(F.col("l_quantity") / 8).cast("bigint").alias("batter_runs"),
                     F.when(F.col("l_returnflag") == "R", "bowled").otherwise("").alias("wicket_type"))


def q_over_ball(spark, d):
    return ball_facts(_li_delivery(t(spark, d, "lineitem")))


ORACLE["over_ball"] = """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, delivery, batter_runs, wicket_type,
  CAST(trunc(delivery) AS BIGINT) + 1 AS over,
  CAST(round((delivery - trunc(delivery)) * 10) AS BIGINT) AS ball,
  CASE WHEN wicket_type IS NOT NULL AND wicket_type <> '' THEN 1 ELSE 0 END AS wickets,
  CASE WHEN batter_runs >= 6 THEN 1 ELSE 0 END AS six,
  CASE WHEN batter_runs BETWEEN 4 AND 5 THEN 1 ELSE 0 END AS four
FROM (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
             CAST(l_linenumber AS DOUBLE) + (l_quantity % 10) / 10 AS delivery,
             CAST(floor(l_quantity / 8) AS BIGINT) AS batter_runs,
             CASE WHEN l_returnflag = 'R' THEN 'bowled' ELSE '' END AS wicket_type
      FROM lineitem)"""


# W3, C4
def q_running_count(spark, d):
    ev = t(spark, d, "events").select("event_id", "user_id", "ts", "event_type")
    out = running_total(ev, ["user_id"], ["ts", "event_id"],
                        F.when(F.col("event_type") == "error", 1).otherwise(0), "errors_so_far", stored=True)
    return out.select("event_id", "user_id", "event_type", "errors_so_far")


ORACLE["running_count"] = """
SELECT event_id, user_id, event_type,
  CAST(SUM(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END)
       OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
       AS BIGINT) AS errors_so_far
FROM events"""


# entities = (event_type, props.k) per user, in (ts, event_id) order
def _event_pairs(spark, d):
    return t(spark, d, "events").select("event_id", "user_id", "ts", F.col("event_type").alias("batter"),
                                        nested_json_value("props", ["k"]).alias("non_striker"))


def q_first_appearance(spark, d):
    return first_appearance_order(_event_pairs(spark, d), ["user_id"], ["ts", "event_id"],
                                  ["batter", "non_striker"])


SQL_FIRSTS = """
pairs AS (
  SELECT user_id, ts, event_id, 0 AS pos, event_type AS entity FROM events
  UNION ALL
  SELECT user_id, ts, event_id, 1 AS pos, json_extract_string(props, '$.k') AS entity FROM events),
firsts AS (
  SELECT user_id, entity, ts, event_id, pos FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id, entity ORDER BY ts, event_id, pos) AS rn
    FROM pairs WHERE entity IS NOT NULL) WHERE rn = 1),
ranks AS (
  SELECT user_id, entity,
         CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id, pos, entity) AS INTEGER) AS rank
  FROM firsts)"""

ORACLE["first_appearance"] = f"WITH {SQL_FIRSTS} SELECT user_id, entity, rank FROM ranks"


# C3, J10, J11
def q_participant_position(spark, d):
    pairs = _event_pairs(spark, d)
    order = first_appearance_order(pairs, ["user_id"], ["ts", "event_id"], ["batter", "non_striker"])
    out = attach_positions(pairs, order, ["user_id"],
                           {"batter": "batter_number", "non_striker": "non_striker_number"})
    return out.select("event_id", "user_id", "batter", "non_striker", "batter_number", "non_striker_number")


ORACLE["participant_position"] = f"""
WITH {SQL_FIRSTS}
SELECT e.event_id, e.user_id, e.event_type AS batter, json_extract_string(e.props, '$.k') AS non_striker,
       b.rank AS batter_number, n.rank AS non_striker_number
FROM events e
LEFT JOIN ranks b ON b.user_id = e.user_id AND b.entity = e.event_type
LEFT JOIN ranks n ON n.user_id = e.user_id AND n.entity = json_extract_string(e.props, '$.k')"""


# Lineitem in the order of all its columns
LI_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
           "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


def q_sequential_id(spark, d):
    out = sequential_id(t(spark, d, "lineitem"), LI_COLS, "line_id", stored=True)
    return out.withColumn("l_shipdate", F.col("l_shipdate").cast("date"))


ORACLE["sequential_id"] = f"""
SELECT {', '.join(c for c in LI_COLS if c != 'l_shipdate')}, CAST(l_shipdate AS DATE) AS l_shipdate,
  CAST(row_number() OVER (ORDER BY {', '.join(c + ' NULLS FIRST' for c in LI_COLS)}) AS BIGINT) AS line_id
FROM lineitem"""


# C4 + C5 in one pass, shaped like the dataset: lines grouped by order, global order by
# order date first, so the group does not lead the sort key
def q_running_ids(spark, d):
    li = t(spark, d, "lineitem")
    o = t(spark, d, "orders").select("o_orderkey", "o_orderdate")
    x = li.join(o, li["l_orderkey"] == o["o_orderkey"]).drop("o_orderkey")
    rest = [c for c in LI_COLS if c != "l_orderkey"]
    out = running_total_with_ids(x, ["l_orderkey"], ["o_orderdate", "l_orderkey", *rest],
                                 F.col("l_quantity").cast("bigint"), "qty_so_far", "line_id")
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
                      F.col("o_orderdate").cast("date").alias("o_orderdate"), "qty_so_far", "line_id")


ORACLE["running_ids"] = f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, CAST(o_orderdate AS DATE) AS o_orderdate,
  CAST(SUM(CAST(l_quantity AS BIGINT)) OVER (PARTITION BY l_orderkey ORDER BY {', '.join(c for c in LI_COLS if c != 'l_orderkey')}
       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS qty_so_far,
  CAST(row_number() OVER (ORDER BY o_orderdate, l_orderkey, {', '.join(c for c in LI_COLS if c != 'l_orderkey')}) AS BIGINT)
    AS line_id
FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""


# C4 with null values, and with groups scattered over the order
def q_running_nulls(spark, d):
    ev = t(spark, d, "events").select("event_id", "user_id", "ts", "event_type")
    out = running_total(ev, ["user_id"], ["ts", "event_id"],
                        F.when(F.col("event_type") == "error", F.col("event_id") % 7), "error_sum", stored=True)
    return out.select("event_id", "user_id", "error_sum")


ORACLE["running_nulls"] = """
SELECT event_id, user_id,
  CAST(SUM(CASE WHEN event_type = 'error' THEN event_id % 7 END)
       OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
       AS BIGINT) AS error_sum
FROM events"""


def q_running_scattered(spark, d):
    ev = t(spark, d, "events").select("event_id", "user_id", "ts", "event_type")
    out = running_total_with_ids(ev, ["event_type"], ["ts", "event_id"], F.when(F.col("user_id") % 3 != 0, F.col("user_id")),
                                 "user_sum", "position", stored=True)
    return out.select("event_id", "event_type", "user_sum", "position")


ORACLE["running_scattered"] = """
SELECT event_id, event_type,
  CAST(SUM(CASE WHEN user_id % 3 <> 0 THEN user_id END)
       OVER (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
       AS BIGINT) AS user_sum,
  CAST(row_number() OVER (ORDER BY ts, event_id) AS BIGINT) AS position
FROM events"""


# C1 (J1-J6, F6, F8, P3, A4): lineitem roles batter = supplier, bowler = part, per order
def _role_fact(spark, d):
    return t(spark, d, "lineitem").select(F.col("l_orderkey").cast("string").alias("match_id"), "l_linenumber",
                                          _s("S", "l_suppkey").alias("batter"), _s("P", "l_partkey").alias("bowler"))


ROLE_OUT = ["match_id", "l_linenumber", "batter", "batter_id", "missing_batter_name",
            "bowler", "bowler_id", "missing_bowler_name"]


def q_resolve_roles(spark, d):
    return resolve_roles(_role_fact(spark, d), star_names(spark, d), ["batter", "bowler"]).select(*ROLE_OUT)


def q_role_map_lookup(spark, d):
    return resolve_roles_by_map(_role_fact(spark, d), star_names(spark, d), ["batter", "bowler"]).select(*ROLE_OUT)


# the registry is made of these very lines, so a line's own supplier and part are always in it, once: a role is
# resolved if the person dimension knows its id
ORACLE["resolve_roles"] = f"""
WITH {SQL_PEOPLE}
SELECT CAST(l.l_orderkey AS VARCHAR) AS match_id, l.l_linenumber,
  COALESCE(b.person_name, 'S' || CAST(l.l_suppkey AS VARCHAR)) AS batter, b.person_id AS batter_id,
  b.person_name IS NULL AS missing_batter_name,
  COALESCE(w.person_name, 'P' || CAST(l.l_partkey AS VARCHAR)) AS bowler, w.person_id AS bowler_id,
  w.person_name IS NULL AS missing_bowler_name
FROM lineitem l
LEFT JOIN pdim b ON b.person_id = 'S' || CAST(l.l_suppkey AS VARCHAR)
LEFT JOIN pdim w ON w.person_id = 'P' || CAST(l.l_partkey AS VARCHAR)"""
ORACLE["role_map_lookup"] = ORACLE["resolve_roles"]


# C10, J7
def q_dimension_name_override(spark, d):
    mi = t(spark, d, "orders").select(F.col("o_orderkey").cast("string").alias("match_id"), "o_orderstatus",
                                      _s("C", "o_custkey").alias("player_of_match"))
    return name_override(mi, star_names(spark, d), "player_of_match").select("match_id", "o_orderstatus",
                                                                             "player_of_match")


ORACLE["dimension_name_override"] = f"""
WITH {SQL_REGISTRY}, {SQL_NAMES}
SELECT CAST(o.o_orderkey AS VARCHAR) AS match_id, o.o_orderstatus,
       COALESCE(n.person_name, 'C' || CAST(o.o_custkey AS VARCHAR)) AS player_of_match
FROM orders o LEFT JOIN names n
  ON n.person_unique_name = 'C' || CAST(o.o_custkey AS VARCHAR) AND n.match_id = CAST(o.o_orderkey AS VARCHAR)"""


# J9, C7, F3, F4, F7
def q_league_type_fix(spark, d):
    cust = t(spark, d, "customer").select(
        "c_custkey", _s("Team ", "c_nationkey").alias("batting_team"),
        F.when(F.col("c_mktsegment").isin("MACHINERY", "BUILDING"), "ODM").otherwise(F.col("c_mktsegment"))
        .alias("match_type"))
    nat = t(spark, d, "nation")
    reg = t(spark, d, "region")
    m = nat.join(reg, nat["n_regionkey"] == reg["r_regionkey"]).select(
        _miss(F.col("n_regionkey") == 4, _s("Team ", "n_nationkey")).alias("team_name"),
        F.concat("r_name", F.when(F.col("r_regionkey").isin(0, 2), F.lit(" INTERNATIONAL cup"))
                 .otherwise(F.lit(" League"))).alias("league"))
    out = cust.join(m, cust["batting_team"] == m["team_name"], "left").drop("team_name")
    return out.withColumn("match_type", match_type_fix()).select("c_custkey", "batting_team", "match_type", "league")


ORACLE["league_type_fix"] = """
WITH c AS (SELECT c_custkey, 'Team ' || CAST(c_nationkey AS VARCHAR) AS batting_team,
                  CASE WHEN c_mktsegment IN ('MACHINERY', 'BUILDING') THEN 'ODM' ELSE c_mktsegment END AS match_type
           FROM customer),
m AS (SELECT CASE WHEN n_regionkey = 4 THEN 'x' ELSE '' END || 'Team ' || CAST(n_nationkey AS VARCHAR) AS team_name,
             r_name || CASE WHEN r_regionkey IN (0, 2) THEN ' INTERNATIONAL cup' ELSE ' League' END AS league
      FROM nation JOIN region ON n_regionkey = r_regionkey)
SELECT c.c_custkey, c.batting_team,
       CASE WHEN c.match_type = 'ODM' AND contains(lower(m.league), 'international') THEN 'ODI'
            ELSE c.match_type END AS match_type,
       m.league
FROM c LEFT JOIN m ON c.batting_team = m.team_name"""


# Whole-value replace over every string column of part
UNIFY = {"ECONOMY": "BUDGET", "Brand#1": "Brand#01"}


def q_unify_values(spark, d):
    return replace_values(t(spark, d, "part"), UNIFY)


def _sql_replace(c: str) -> str:
    whens = " ".join(f"WHEN {c} = '{o}' THEN '{n}'" for o, n in UNIFY.items())
    return f"CASE {whens} ELSE {c} END AS {c}"


ORACLE["unify_values"] = f"""
SELECT p_partkey, {_sql_replace('p_name')}, {_sql_replace('p_brand')}, {_sql_replace('p_type')},
       p_size, p_retailprice FROM part"""


# F14, P7, P10
def q_blank_to_null(spark, d):
    p = t(spark, d, "part").select(
        "p_partkey", F.when(F.col("p_size") < 5, "").otherwise(F.col("p_name")).alias("p_name"), "p_brand",
        F.when(F.col("p_size") > 45, "").otherwise(F.col("p_type")).alias("p_type"), "p_size")
    return p.transform(blank_to_null)


ORACLE["blank_to_null"] = """
SELECT p_partkey, NULLIF(CASE WHEN p_size < 5 THEN '' ELSE p_name END, '') AS p_name, NULLIF(p_brand, '') AS p_brand,
       NULLIF(CASE WHEN p_size > 45 THEN '' ELSE p_type END, '') AS p_type, p_size
FROM part"""


# P8, P9
ORDERS_SCHEMA = T.StructType([
    T.StructField("o_orderkey", T.LongType()), T.StructField("o_custkey", T.LongType()),
    T.StructField("o_orderstatus", T.StringType()), T.StructField("o_totalprice", T.DoubleType()),
    T.StructField("o_orderdate", T.DateType()), T.StructField("o_orderpriority", T.StringType())])


def q_cast_dates(spark, d):
    return cast_to_schema(cast_timestamps_to_date(t(spark, d, "orders")), ORDERS_SCHEMA)


ORACLE["cast_dates"] = """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority
FROM orders"""


# F1, F2, F15
def q_innings_key(spark, d):
    o = t(spark, d, "orders").select(
        "o_orderkey", F.col("o_orderkey").cast("string").alias("match_id"),
        F.when(F.col("o_orderstatus") == "P", None).otherwise(F.col("o_orderpriority")).alias("innings"))
    return o.select("o_orderkey", innings_key("match_id", "innings").alias("innings_id"))


ORACLE["innings_key"] = """
SELECT o_orderkey, CAST(o_orderkey AS VARCHAR) || '_' ||
       substr(CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderpriority END, 1, 1) AS innings_id
FROM orders"""


# Orders split by date into landed / processed
def _landed(spark, d):
    return t(spark, d, "orders").where(F.col("o_orderdate") >= F.lit("1997-01-01").cast("timestamp_ntz")) \
        .withColumnRenamed("o_orderkey", "match_id")


def _processed(spark, d):
    return t(spark, d, "orders").where(F.col("o_orderdate") < F.lit("1999-01-01").cast("timestamp_ntz")) \
        .withColumnRenamed("o_orderkey", "match_id")


SQL_SPLIT = """
landed AS (SELECT o_orderkey AS match_id, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
           FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01'),
processed AS (SELECT o_orderkey AS match_id FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01')"""


def q_new_keys(spark, d):
    return K.new_keys(_landed(spark, d), _processed(spark, d))


ORACLE["new_keys"] = f"""WITH {SQL_SPLIT}
SELECT l.match_id FROM landed l WHERE NOT EXISTS (SELECT 1 FROM processed p WHERE p.match_id = l.match_id)"""


# I1, I2 for documents that come again: version = a date, digest = a status; every third customer's orders are corrected
def q_version_decisions(spark, d):
    day = lambda shift: F.date_add(F.col("o_orderdate").cast("date"), shift).cast("string")
    held = _processed(spark, d).select("match_id", F.when(F.col("o_orderstatus") != "P", day(0)).alias("drop"),
                                       F.col("o_orderstatus").alias("digest"))
    status = F.when(F.col("o_custkey") % 3 == 0, F.concat("o_orderstatus", F.lit("x"))).otherwise(F.col("o_orderstatus"))
    shift = F.when(F.col("o_orderpriority") == "1-URGENT", 1).otherwise(-1)
    batch = _landed(spark, d).select("match_id", F.when(F.col("o_custkey") % 7 != 0, day(shift)).alias("drop"), status.alias("digest"))
    return K.version_decisions(held, batch)


ORACLE["version_decisions"] = """
WITH held AS (SELECT o_orderkey AS match_id, o_orderstatus AS digest,
                     CASE WHEN o_orderstatus <> 'P' THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS v
              FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01'),
batch AS (SELECT o_orderkey AS match_id, o_orderstatus || CASE WHEN o_custkey % 3 = 0 THEN 'x' ELSE '' END AS digest,
                 CASE WHEN o_custkey % 7 <> 0 THEN CAST(CAST(o_orderdate AS DATE)
                      + CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE -1 END AS VARCHAR) END AS v
          FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01')
SELECT b.match_id, b.v AS "drop", b.digest,
       CASE WHEN h.match_id IS NULL THEN 'new' WHEN b.digest IS NOT DISTINCT FROM h.digest THEN 'same'
            WHEN b.v IS NOT NULL AND (h.v IS NULL OR b.v > h.v) THEN 'replace' ELSE 'late' END AS decision
FROM batch b LEFT JOIN held h USING (match_id)"""


def q_seen_keys(spark, d):
    return K.seen_keys(_landed(spark, d), _processed(spark, d))


ORACLE["seen_keys"] = f"""WITH {SQL_SPLIT}
SELECT l.match_id FROM landed l WHERE EXISTS (SELECT 1 FROM processed p WHERE p.match_id = l.match_id)"""


def q_key_setops(spark, d):
    return K.key_setops(_landed(spark, d), _processed(spark, d))


ORACLE["key_setops"] = f"""WITH {SQL_SPLIT}
SELECT match_id, 'only_landed' AS side FROM (SELECT match_id FROM landed EXCEPT SELECT match_id FROM processed)
UNION ALL
SELECT match_id, 'both' AS side FROM (SELECT match_id FROM landed INTERSECT SELECT match_id FROM processed)"""


def q_duplicate_guard(spark, d):
    landed, processed = _landed(spark, d), _processed(spark, d)
    try:
        K.duplicate_guard(landed, processed)
        raised = False
    except ValueError:
        raised = True
    hits = K.seen_keys(landed, processed)
    return hits.agg(F.lit(raised).alias("has_duplicates"), F.count(F.lit(1)).alias("n_seen"))


ORACLE["duplicate_guard"] = f"""WITH {SQL_SPLIT}
SELECT COUNT(*) > 0 AS has_duplicates, COUNT(*) AS n_seen FROM landed l
WHERE EXISTS (SELECT 1 FROM processed p WHERE p.match_id = l.match_id)"""


def q_delta_count(spark, d):
    landed, processed = _landed(spark, d), _processed(spark, d)
    fresh = landed.join(processed.select("match_id"), "match_id", "left_anti")
    return fresh.limit(0).agg(F.lit(K.delta_count(fresh)).cast("bigint").alias("n_new"))


ORACLE["delta_count"] = f"""WITH {SQL_SPLIT}
SELECT COUNT(*) AS n_new FROM landed l
WHERE NOT EXISTS (SELECT 1 FROM processed p WHERE p.match_id = l.match_id)
  AND l.match_id IS NOT NULL AND o_custkey IS NOT NULL AND o_orderstatus IS NOT NULL
  AND o_totalprice IS NOT NULL AND o_orderdate IS NOT NULL AND o_orderpriority IS NOT NULL"""


def q_merge_append(spark, d):
    o = t(spark, d, "orders")
    old = o.where(F.col("o_orderdate") < F.lit("1998-06-01").cast("timestamp_ntz"))
    new = o.where(F.col("o_orderdate") >= F.lit("1998-06-01").cast("timestamp_ntz")).select(
        "o_orderkey", F.col("o_custkey").cast("int").alias("o_custkey"), "o_orderstatus", "o_totalprice",
        F.col("o_orderdate").cast("date").alias("o_orderdate"), "o_orderpriority")
    return K.merge_append(old, new, ORDERS_SCHEMA)


ORACLE["merge_append"] = """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority
FROM orders WHERE o_orderdate < TIMESTAMP '1998-06-01'
UNION ALL
SELECT o_orderkey, CAST(CAST(o_custkey AS INTEGER) AS BIGINT), o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE),
       o_orderpriority
FROM orders WHERE o_orderdate >= TIMESTAMP '1998-06-01'"""


# ---------------------------------------------------------------------------------------
# One match document per order, built in Spark from orders + lineitem

LINE_FIELDS = ["l_returnflag", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
               "l_discount", "l_tax", "l_linestatus", "l_shipdate"]


def _team(f: Column) -> Column:
    return F.when(f == "R", F.lit("Royal Challengers Bengaluru")).otherwise(F.concat(F.lit("Team "), f))


def _ball(damage: str | None = None, texts: bool = False) -> Column:
    """One ball entry of a row of `lineitem`. With `damage` (a priority), line 3 loses its required `runs`, line 2
    gets a ball key that is not a number and line 1 runs that are none (quarantine fixtures); `texts`: quoted runs."""
    batsman = _s("S", "l_suppkey")
    runs_bat = F.floor(F.col("l_quantity") / 8).cast("bigint")
    extras = F.when(F.col("l_discount") != 0, F.round(F.col("l_discount") * 100).cast("bigint"))
    key = (F.col("l_linenumber").cast("double") + (F.col("l_quantity") % 10) / 10).cast("string")
    shown = F.lit("four") if damage == "3-MEDIUM" else runs_bat.cast("string") if texts else runs_bat
    runs = F.struct(shown.alias("batsman"), extras.alias("extras"),
                    (runs_bat + F.coalesce(extras, F.lit(0).cast("bigint"))).alias("total"))
    if damage == "4-NOT SPECIFIED":
        key = F.concat(F.lit("ball "), key)
    if damage == "5-LOW":
        runs = F.lit(None).cast("struct<batsman:string,extras:bigint,total:bigint>")
    return F.create_map(
        key,
        F.struct(batsman.alias("batsman"),
                 _s("P", "l_partkey").alias("bowler"),
                 F.concat(F.lit("S"), (F.col("l_suppkey") + 1).cast("string")).alias("non_striker"),
                 F.when(F.col("l_tax") == 0, F.lit("yes")).alias("declared"),
                 runs.alias("runs"),
                 F.when((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F"),
                        F.struct(F.lit("bowled").alias("kind"), batsman.alias("player_out"))).alias("wicket")))


def _sorted_set(values: Column) -> Column:
    """array_sort(array_distinct(...)), nulls last, by the native sort, which has the one null first."""
    a = F.sort_array(F.array_distinct(values))
    return F.when(F.get(a, 0).isNull() & (F.size(a) > 1), F.concat(F.slice(a, F.lit(2), F.size(a) - 1), F.array(F.lit(None)))).otherwise(a)


#: The line that a priority damages.
DAMAGED_LINES = {"3-MEDIUM": 1, "4-NOT SPECIFIED": 2, "5-LOW": 3}


def _lines(li: DataFrame, damaged: bool, yaml: bool = False, parts: int | None = None) -> DataFrame:
    """The lines of each order in their order, with the texts that the document takes of each: made row by row, after
    the one shuffle by order (the texts do not cross it; `parts`: in so many tasks, whatever their size), so that no list
    is walked by lambdas. `yaml`: with the ball's key and `declared` as YAML writes them."""
    texts = {"day": F.date_format("l_shipdate", "yyyy-MM-dd"), "batsman": _s("S", "l_suppkey"), "bowler": _s("P", "l_partkey"),
             "ball": F.to_json(_ball(texts=damaged))}
    if yaml:
        key = F.regexp_replace(texts["ball"], r'^\{"(\d+\.\d+)":', "{$1: ")
        texts["ball"] = F.replace(key, F.lit('"declared":"yes"'), F.lit("declared: yes"))
    if damaged:
        hit = bad = F
        for priority, line in DAMAGED_LINES.items():
            hit = hit.when(F.col("l_linenumber") == line, F.lit(priority))
            bad = bad.when(F.col("l_linenumber") == line, F.to_json(_ball(priority, texts=True)))
        texts |= {"hit": hit, "bad": bad}
    rows = li.select("l_orderkey", *LINE_FIELDS)
    rows = rows.repartition(parts, "l_orderkey") if parts else rows.repartition("l_orderkey")
    line = F.struct(*LINE_FIELDS, *[c.alias(n) for n, c in texts.items()])
    return (rows.select("l_orderkey", line.alias("line")).groupBy("l_orderkey")
            .agg(F.sort_array(F.collect_list("line")).alias("lines")))


def _document_parts(spark, d, damaged: bool = False, yaml: bool = False, parts: int | None = None) -> DataFrame:
    """(match_id, info, innings): the texts of one match document per order. An order has a
    handful of lines, so each collected list is bounded by the lines of one order."""
    lines = _lines(t(spark, d, "lineitem"), damaged, yaml, parts)
    o = t(spark, d, "orders")
    j = o.join(lines, o["o_orderkey"] == lines["l_orderkey"], "left")
    empty = F.array().cast(lines.schema["lines"].dataType)
    j = j.withColumn("lines", F.coalesce(F.col("lines"), empty))
    of = lambda field: F.col("lines")[field]  # noqa: E731 - the field of every line, as an array
    flags = _sorted_set(of("l_returnflag"))
    teams = F.transform(flags, _team)
    status = F.col("o_orderstatus")
    n_lines = F.size("lines").cast("double")
    margin = n_lines.cast("string")  # a quoted margin is a number all the same
    if damaged:
        margin = F.when(F.col("o_orderpriority") == "2-HIGH", F.concat(margin, F.lit(" wickets"))).otherwise(margin)
    by = (F.when(status == "P", F.create_map(F.lit("innings"), F.lit("1.0"), F.lit("runs"),
                                             F.col("o_custkey").cast("double").cast("string")))
          .when(status == "F", F.create_map(F.lit("wickets"), margin)))
    dates = _sorted_set(of("day"))
    if damaged:  # text behind the first date
        first = F.concat(F.coalesce(F.get(dates, 0), F.lit("")), F.lit("garbage"))
        rest = F.slice(dates, F.lit(2), F.greatest(F.size(dates) - 1, F.lit(0)))
        dates = F.when(F.col("o_custkey") % 10 == 3, F.concat(F.array(first), rest)).otherwise(dates)
    people = F.array_distinct(F.concat(of("batsman"), of("bowler"), F.array(_s("C", "o_custkey"))))
    info = F.struct(
        F.col("o_orderpriority").alias("city"),
        dates.alias("dates"),
        F.when(status == "F", "ODM").when(status == "O", "T20").otherwise("Test").alias("match_type"),
        F.when(F.col("o_totalprice") > 150000, "male").otherwise("female").alias("gender"),
        _sorted_set(of("l_linestatus")).alias("umpires"),
        F.concat(F.lit("Ground "), F.col("o_custkey").cast("string")).alias("venue"),
        F.struct(by.alias("by"), F.when(status == "F", F.lit("Team A")).alias("winner")).alias("outcome"),
        F.array(F.concat(F.lit("C"), F.col("o_custkey").cast("string"))).alias("player_of_match"),
        teams.alias("teams"),
        F.struct(F.when(F.col("o_totalprice") > 100000, "bat").otherwise("field").alias("decision"),
                 F.get(teams, 0).alias("winner")).alias("toss"),
        F.struct(F.map_from_arrays(people, people).alias("people")).alias("registry"),
        F.struct(F.when(F.col("o_orderpriority").like("1-%"), F.concat(F.lit("World Cup "), status))
                 .alias("name")).alias("event"))

    def one(f: Column) -> Column:
        """The innings of a flag, put around the texts of its lines."""
        own = F.filter("lines", lambda x: x["l_returnflag"] == f)
        balls = own["ball"]
        if damaged:
            balls = F.transform(own, lambda x: F.when(x["hit"] == F.col("o_orderpriority"), x["bad"]).otherwise(x["ball"]))
        head = F.to_json(F.create_map(F.concat(f, F.lit(" innings")), F.struct(_team(f).alias("team"))))
        return F.concat(F.substring(head, F.lit(1), F.length(head) - 2), F.lit(',"deliveries":['), F.array_join(balls, ","), F.lit("]}}"))

    innings = F.concat(F.lit("["), F.array_join(F.transform(flags, one), ","), F.lit("]"))
    return j.select(F.col("o_orderkey").cast("string").alias("match_id"), F.to_json(info).alias("info"), innings.alias("innings"))


def order_documents(spark, d, damaged: bool = False) -> DataFrame:
    """(match_id, path, doc_json): one JSON match document per order."""
    text = F.concat(F.lit('{"info":'), "info", F.lit(',"innings":'), "innings", F.lit("}"))
    return _document_parts(spark, d, damaged).select(
        "match_id", F.concat(F.lit("orders/"), "match_id", F.lit(".json")).alias("path"), text.alias("doc_json"))


def order_docs_parsed(spark, d, damaged: bool = False, ddl: str = DOCUMENT_DDL) -> DataFrame:
    """The documents by the JSON route; the key comes from the path."""
    raw = order_documents(spark, d, damaged)
    files = raw.select(key_from_path("path").alias("match_id"), "path", F.col("doc_json").cast("binary").alias("content"))
    return parse_documents(json_text(files), ddl)


def q_doc_quarantine(spark, d):
    """Problems of damaged documents, each with the table it is about."""
    return quarantine_reasons(order_docs_parsed(spark, d, damaged=True)).select("match_id", "table", "reason", "fatal")


ORACLE["doc_quarantine"] = """
WITH o AS (SELECT o_orderkey, o_orderpriority, o_orderstatus, o_custkey,
                  EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o_orderkey) AS has_lines,
                  EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o_orderkey AND l.l_linenumber = 3) AS has3,
                  EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o_orderkey AND l.l_linenumber = 2) AS has2,
                  EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o_orderkey AND l.l_linenumber = 1) AS has1
           FROM orders),
p AS (
  SELECT o_orderkey, 'deliveries' AS "table", 'missing_runs' AS reason, true AS fatal FROM o WHERE o_orderpriority = '5-LOW' AND has3
  UNION ALL SELECT o_orderkey, 'deliveries', 'bad_ball_key', true FROM o WHERE o_orderpriority = '4-NOT SPECIFIED' AND has2
  UNION ALL SELECT o_orderkey, 'deliveries', 'bad_runs', true FROM o WHERE o_orderpriority = '3-MEDIUM' AND has1
  UNION ALL SELECT o_orderkey, 'deliveries', 'empty_innings', false FROM o WHERE NOT has_lines
  UNION ALL SELECT o_orderkey, 'match_info', 'bad_margin', false FROM o WHERE o_orderpriority = '2-HIGH' AND o_orderstatus = 'F'
  UNION ALL SELECT o_orderkey, 'match_info', 'bad_date', false FROM o WHERE o_custkey % 10 = 3)
SELECT CAST(o_orderkey AS VARCHAR) AS match_id, "table", reason, fatal FROM p"""


def q_doc_deliveries(spark, d):
    """S1 (JSON), then E1-E7."""
    return extract_deliveries(valid_documents(order_docs_parsed(spark, d), "deliveries"))


def order_yaml(spark, d, parts: int | None = None) -> DataFrame:
    """(match_id, path, content): the documents as YAML text as it is landed: plain dates, `yes`, numbers as ball keys."""
    info = F.regexp_replace("info", r'"(\d{4}-\d{2}-\d{2})"', "$1")
    text = F.concat(F.lit("# one match\n---\ninfo: "), info, F.lit("\ninnings: "), "innings", F.lit("\n"))
    path = F.concat(F.lit("orders/"), "match_id", F.lit(".yaml")).alias("path")
    raw = _document_parts(spark, d, yaml=True, parts=parts).select(path, text.cast("binary").alias("content"))
    return raw.withColumn("match_id", key_from_path("path"))


def q_yaml_deliveries(spark, d):
    """S1 (YAML), then E1-E7, in one pass: the parse, which is Python, is an operator of the plan, which no filter or projection
    repeats. The orders are dealt to as many tasks as the session has, else they are coalesced to few by the size of their
    lines; the texts are parsed where they are made."""
    docs = yaml_to_json(order_yaml(spark, d, default_partitions(spark)))
    return extract_deliveries(valid_documents(parse_documents(docs), "deliveries"))


# match info and registry of damaged documents: a bad ball, margin or date does not remove them
def q_doc_match_info(spark, d):
    # parsed once for both sides of the event join
    docs = stage(readable_documents(order_docs_parsed(spark, d, damaged=True, ddl=INFO_DDL)).select("match_id", "doc"), "docs")
    event = docs.select("match_id", F.col("doc.info.event.name").alias("event"))  # E15 from the document
    return attach_events(extract_match_info(docs), event)


def q_doc_registry(spark, d):
    return extract_registry(readable_documents(order_docs_parsed(spark, d, damaged=True, ddl=INFO_DDL)))


def q_doc_event(spark, d):
    """E14 on event JSON text: a present path and an absent one with a default."""
    return t(spark, d, "events").select("event_id", nested_json_value("props", ["k"]).alias("k"),
                                        nested_json_value("props", ["info", "name"], "none").alias("event_name"))


ORACLE["doc_event"] = """
SELECT event_id, json_extract_string(props, '$.k') AS k,
       COALESCE(json_extract_string(props, '$.info.name'), 'none') AS event_name FROM events"""


def _sql_team(x: str) -> str:
    return f"CASE WHEN {x} = 'R' THEN 'Royal Challengers Bengaluru' ELSE 'Team ' || {x} END"


SQL_DELIVERIES = f"""
fl AS (SELECT l_orderkey, l_returnflag,
              CAST(dense_rank() OVER (PARTITION BY l_orderkey ORDER BY l_returnflag) - 1 AS INTEGER) AS innings_seq
       FROM (SELECT DISTINCT l_orderkey, l_returnflag FROM lineitem)),
dl AS (
  SELECT CAST(l.l_orderkey AS VARCHAR) AS match_id, l.l_returnflag || ' innings' AS innings,
    {_sql_team('l.l_returnflag')} AS batting_team,
    COALESCE((SELECT {_sql_team('min(f2.l_returnflag)')} FROM fl f2
              WHERE f2.l_orderkey = l.l_orderkey AND f2.l_returnflag <> l.l_returnflag), 'Unknown') AS bowling_team,
    CAST(CASE WHEN l.l_tax = 0 THEN 1 ELSE 0 END AS BIGINT) AS declared,
    CAST(l.l_linenumber AS DOUBLE) + (l.l_quantity % 10) / 10 AS delivery,
    'S' || CAST(l.l_suppkey AS VARCHAR) AS batter, 'P' || CAST(l.l_partkey AS VARCHAR) AS bowler,
    'S' || CAST(l.l_suppkey + 1 AS VARCHAR) AS non_striker,
    CAST(floor(l.l_quantity / 8) AS BIGINT) AS batter_runs,
    CASE WHEN l.l_discount <> 0 THEN CAST(round(l.l_discount * 100) AS BIGINT) ELSE 0 END AS extra_runs,
    CAST(floor(l.l_quantity / 8) AS BIGINT)
      + CASE WHEN l.l_discount <> 0 THEN CAST(round(l.l_discount * 100) AS BIGINT) ELSE 0 END AS total_runs,
    CASE WHEN l.l_returnflag = 'R' AND l.l_linestatus = 'F' THEN 'bowled' ELSE '' END AS wicket_type,
    CASE WHEN l.l_returnflag = 'R' AND l.l_linestatus = 'F' THEN 'S' || CAST(l.l_suppkey AS VARCHAR) ELSE '' END
      AS player_out,
    fl.innings_seq,
    CAST(row_number() OVER (PARTITION BY l.l_orderkey, l.l_returnflag
         ORDER BY {', '.join('l.' + c for c in LINE_FIELDS[1:])}) - 1 AS INTEGER) AS ball_seq
  FROM lineitem l JOIN fl ON fl.l_orderkey = l.l_orderkey AND fl.l_returnflag = l.l_returnflag)"""

DELIVERY_OUT = ["match_id", "innings", "batting_team", "bowling_team", "declared", "delivery", "batter", "bowler",
                "non_striker", "batter_runs", "extra_runs", "total_runs", "wicket_type", "player_out",
                "innings_seq", "ball_seq"]

ORACLE["doc_deliveries"] = f"WITH {SQL_DELIVERIES} SELECT {', '.join(DELIVERY_OUT)} FROM dl"
ORACLE["yaml_deliveries"] = ORACLE["doc_deliveries"]

SQL_MATCH_INFO = f"""
ag AS (SELECT l_orderkey, min(CAST(l_shipdate AS DATE)) AS d1, max(CAST(l_shipdate AS DATE)) AS d2,
              min(l_linestatus) AS u1, max(l_linestatus) AS u2, count(*) AS n,
              min(l_returnflag) AS f1, max(l_returnflag) AS f2
       FROM lineitem GROUP BY l_orderkey),
mi AS (
  SELECT CAST(o.o_orderkey AS VARCHAR) AS match_id, o.o_orderpriority AS city,
    ag.d1 AS match_start_date, ag.d2 AS match_end_date,
    CASE o.o_orderstatus WHEN 'F' THEN 'ODM' WHEN 'O' THEN 'T20' ELSE 'Test' END AS match_type,
    CASE WHEN o.o_totalprice > 150000 THEN 'male' ELSE 'female' END AS gender,
    ag.u1 AS umpire_1, ag.u2 AS umpire_2,
    CASE o.o_orderstatus WHEN 'P' THEN 'innings' WHEN 'F' THEN 'wickets' END AS win_by,
    CASE o.o_orderstatus WHEN 'P' THEN CAST(1.0 AS DOUBLE) WHEN 'F' THEN CAST(COALESCE(ag.n, 0) AS DOUBLE)
         ELSE CAST(0.0 AS DOUBLE) END AS win_margin,
    CASE WHEN o.o_orderstatus = 'F' THEN 'Team A' END AS winner,
    'C' || CAST(o.o_custkey AS VARCHAR) AS player_of_match,
    {_sql_team('ag.f1')} AS team1, {_sql_team('ag.f2')} AS team2,
    CASE WHEN o.o_totalprice > 100000 THEN 'bat' ELSE 'field' END AS toss_decision,
    {_sql_team('ag.f1')} AS toss_winner,
    'Ground ' || CAST(o.o_custkey AS VARCHAR) AS venue,
    CASE WHEN o.o_orderpriority LIKE '1-%' THEN 'World Cup ' || o.o_orderstatus END AS event
  FROM orders o LEFT JOIN ag ON ag.l_orderkey = o.o_orderkey)"""

MATCH_INFO_OUT = ["match_id", "city", "match_start_date", "match_end_date", "match_type", "gender", "umpire_1",
                  "umpire_2", "win_by", "win_margin", "winner", "player_of_match", "team1", "team2",
                  "toss_decision", "toss_winner", "venue"]

_DAMAGED = f"""
SELECT mi.* REPLACE (
    CASE WHEN o.o_custkey % 10 = 3 THEN NULL ELSE mi.match_start_date END AS match_start_date,
    CASE WHEN o.o_orderpriority = '2-HIGH' AND o.o_orderstatus = 'F' THEN NULL ELSE mi.win_margin END AS win_margin,
    -- the last of one date is the damaged one
    CASE WHEN o.o_custkey % 10 = 3 AND mi.match_start_date IS NOT DISTINCT FROM mi.match_end_date THEN NULL
         ELSE mi.match_end_date END AS match_end_date)
FROM mi JOIN orders o ON mi.match_id = CAST(o.o_orderkey AS VARCHAR)"""
ORACLE["doc_match_info"] = f"WITH {SQL_MATCH_INFO} SELECT {', '.join([*MATCH_INFO_OUT, 'event'])} FROM ({_DAMAGED})"
ORACLE["doc_registry"] = f"WITH {SQL_REGISTRY} SELECT match_id, person_name, person_id FROM registry"


# E2
def q_opponent(spark, d):
    li = t(spark, d, "lineitem")
    teams = F.when(F.col("l_quantity") < 3, F.lit(None)).otherwise(
        F.array(_s("T", "l_linestatus"), _s("T", "l_returnflag")))
    batting = F.when(F.col("l_quantity") > 40, _s("T", "l_linestatus")).otherwise(_s("T", "l_returnflag"))
    x = li.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", teams.alias("teams"),
                  batting.alias("batting_team"))
    return x.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "batting_team",
                    opponent("teams", "batting_team").alias("bowling_team"))


ORACLE["opponent"] = """
WITH x AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity < 3 AS no_teams,
                  'T' || l_linestatus AS t1, 'T' || l_returnflag AS t2,
                  CASE WHEN l_quantity > 40 THEN 'T' || l_linestatus ELSE 'T' || l_returnflag END AS batting_team
           FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, batting_team,
  CASE WHEN no_teams THEN 'Unknown' WHEN t1 IS DISTINCT FROM batting_team THEN t1
       WHEN t2 IS DISTINCT FROM batting_team THEN t2 ELSE 'Unknown' END AS bowling_team
FROM x"""


# Q1-Q4, A5, F5, S9
def q_search_distinct(spark, d):
    view = f"sb_search_{next(_view_ids)}"
    src = sql_parquet(spark, f"{d.rstrip('/')}/part.parquet")
    register(src.select(F.col("p_type").alias("match_type"), F.col("p_name").alias("event"),
                        F.when(F.col("p_size") > 25, "male").otherwise("female").alias("gender")), view)
    return competition_search(spark, view, ["R", "ing"], gender="male", match_type="ECONOMY")


ORACLE["search_distinct"] = """
SELECT DISTINCT p_type AS match_type, p_name AS event FROM part
WHERE p_size > 25 AND contains(lower(p_name), 'r') AND contains(lower(p_name), 'ing') AND p_type = 'ECONOMY'"""


def q_search_like(spark, d):
    view = f"sb_rows_{next(_view_ids)}"
    li = t(spark, d, "lineitem")
    register(li.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.when(F.col("l_returnflag") == "A", F.concat(F.lit("National Super League "), "l_linestatus"))
        .otherwise(F.concat(F.lit("Club "), "l_linestatus")).alias("event"),
        F.nullif(F.when(F.col("l_linestatus") == "F", "bowled").otherwise(""), F.lit("")).alias("wicket_type")), view)
    return event_rows(spark, view, "%Super League%")


ORACLE["search_like"] = """
SELECT * FROM (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
    CASE WHEN l_returnflag = 'A' THEN 'National Super League ' || l_linestatus ELSE 'Club ' || l_linestatus END
      AS event,
    NULLIF(CASE WHEN l_linestatus = 'F' THEN 'bowled' ELSE '' END, '') AS wicket_type
  FROM lineitem)
WHERE event LIKE '%Super League%' AND wicket_type IS NULL"""


# P1, P4-P6
def q_normalised_columns(spark, d):
    c = t(spark, d, "customer").select(
        F.col("c_custkey").alias("Cust Key"), F.col("c_name").alias("Cust Name"),
        F.col("c_mktsegment").alias("MKT Segment"), (F.col("c_acctbal") < 0).alias("missing_balance"))
    return drop_prefixed(rename_columns(c), "missing_")


ORACLE["normalised_columns"] = "SELECT c_custkey AS cust_key, c_name AS cust_name, c_mktsegment AS mkt_segment FROM customer"


# C9 flagship: documents -> three tables -> wide dataset
def q_wide_dataset(spark, d):
    with Scratch() as texts:
        docs = stage(valid_documents(order_docs_parsed(spark, d), "deliveries").select("match_id", "doc"), "docs")
    deliveries = extract_deliveries(docs)
    events = docs.select("match_id", F.col("doc.info.event.name").alias("event"))
    match_info = attach_events(extract_match_info(docs), events)
    registry = extract_registry(docs)
    return build_dataset(deliveries, match_info, registry, star_people(spark, d), star_cricinfo(spark, d),
                         star_leagues(spark, d), spent=texts)


ROLES4 = ["batter", "bowler", "non_striker", "player_out"]
JOINED_STRINGS = ["match_id", "innings_id", "innings", "batting_team", "bowling_team", "bowler", "batter",
                  "non_striker", "player_out", "wicket_type", "batter_id", "bowler_id", "non_striker_id",
                  "player_out_id", "city", "match_type", "gender", "umpire_1", "umpire_2", "win_by", "winner",
                  "player_of_match", "team1", "team2", "toss_decision", "toss_winner", "venue", "event"]
WIDE_OUT = ["delivery_id", "match_id", "innings_id", "innings", "batting_team", "bowling_team", "declared", "bowler",
            "batter", "non_striker", "player_out", "delivery", "over", "ball", "wickets", "batter_runs",
            "extra_runs", "total_runs", "six", "four", "wicket_type", "batter_id", "bowler_id", "non_striker_id",
            "player_out_id", *MATCH_INFO_OUT[1:], "event", "league", "league_tier", "batter_number",
            "non_striker_number", "wickets_down"]


def _wide_sql() -> str:
    role_joins = "\n".join(
        f"LEFT JOIN names n_{r} ON n_{r}.person_unique_name = dl.{r} AND n_{r}.match_id = dl.match_id"
        for r in ROLES4)
    role_cols = ", ".join(f"COALESCE(n_{r}.person_name, dl.{r}) AS {r}, n_{r}.person_id AS {r}_id" for r in ROLES4)
    fix = "'Royal Challengers Bengaluru'"
    replaced = ", ".join(f"CASE WHEN {c} = {fix} THEN 'Royal Challengers Bangalore' ELSE {c} END AS {c}"
                         for c in JOINED_STRINGS if c not in ("match_id", "innings_id"))
    blanks = ", ".join(f"NULLIF({c}, '') AS {c}" for c in JOINED_STRINGS + ["league"])
    return f"""
WITH {SQL_REGISTRY}, {SQL_NAMES}, {SQL_DELIVERIES}, {SQL_MATCH_INFO},
d1 AS (
  SELECT dl.match_id, dl.match_id || '_' || substr(dl.innings, 1, 1) AS innings_id, dl.innings, dl.batting_team,
    dl.bowling_team, dl.declared, dl.delivery, dl.batter_runs, dl.extra_runs, dl.total_runs, dl.wicket_type,
    dl.innings_seq, dl.ball_seq, {role_cols},
    CAST(trunc(dl.delivery) AS BIGINT) + 1 AS over,
    CAST(round((dl.delivery - trunc(dl.delivery)) * 10) AS BIGINT) AS ball,
    CASE WHEN dl.wicket_type IS NOT NULL AND dl.wicket_type <> '' THEN 1 ELSE 0 END AS wickets,
    CASE WHEN dl.batter_runs >= 6 THEN 1 ELSE 0 END AS six,
    CASE WHEN dl.batter_runs BETWEEN 4 AND 5 THEN 1 ELSE 0 END AS four
  FROM dl {role_joins}),
m2 AS (SELECT mi.* REPLACE (COALESCE(np.person_name, mi.player_of_match) AS player_of_match)
       FROM mi LEFT JOIN names np ON np.person_unique_name = mi.player_of_match AND np.match_id = mi.match_id),
j AS (SELECT * FROM d1 JOIN m2 USING (match_id)),
rep AS (SELECT * REPLACE ({replaced}) FROM j),
lg AS (SELECT CASE r_regionkey WHEN 0 THEN 'Team A' WHEN 1 THEN 'Team N' WHEN 2 THEN 'Royal Challengers Bangalore'
                   ELSE 'x' || r_name END AS team_name,
              CASE WHEN r_regionkey = 0 THEN r_name || ' International' ELSE r_name || ' League' END AS league,
              r_regionkey AS league_tier
       FROM region),
k AS (SELECT rep.* REPLACE (CASE WHEN rep.match_type = 'ODM' AND contains(lower(lg.league), 'international')
                                 THEN 'ODI' ELSE rep.match_type END AS match_type),
             lg.league, lg.league_tier
      FROM rep LEFT JOIN lg ON rep.batting_team = lg.team_name),
bp AS (SELECT innings_id, delivery, innings_seq, ball_seq, 0 AS pos, batter AS entity FROM k
       UNION ALL SELECT innings_id, delivery, innings_seq, ball_seq, 1, non_striker FROM k),
bf AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY innings_id, entity
                                                   ORDER BY delivery, innings_seq, ball_seq, pos) AS rn
                      FROM bp WHERE entity IS NOT NULL) WHERE rn = 1),
br AS (SELECT innings_id, entity, CAST(row_number() OVER (PARTITION BY innings_id
              ORDER BY delivery, innings_seq, ball_seq, pos, entity) AS INTEGER) AS rank FROM bf),
w AS (SELECT k.*, rb.rank AS batter_number, rn.rank AS non_striker_number,
             CAST(SUM(k.wickets) OVER (PARTITION BY k.innings_id ORDER BY k.delivery, k.innings_seq, k.ball_seq
                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS wickets_down
      FROM k LEFT JOIN br rb ON rb.innings_id = k.innings_id AND rb.entity = k.batter
             LEFT JOIN br rn ON rn.innings_id = k.innings_id AND rn.entity = k.non_striker),
nb AS (SELECT * REPLACE ({blanks}) FROM w)
SELECT CAST(row_number() OVER (ORDER BY match_start_date NULLS FIRST, match_id, innings_id, delivery, innings_seq,
                               ball_seq) AS BIGINT) AS delivery_id,
       {', '.join(c for c in WIDE_OUT if c != 'delivery_id')}
FROM nb"""


ORACLE["wide_dataset"] = _wide_sql()


QUERIES = {
    "over_ball": q_over_ball,
    "running_count": q_running_count,
    "first_appearance": q_first_appearance,
    "participant_position": q_participant_position,
    "sequential_id": q_sequential_id,
    "running_ids": q_running_ids,
    "running_nulls": q_running_nulls,
    "running_scattered": q_running_scattered,
    "resolve_roles": q_resolve_roles,
    "role_map_lookup": q_role_map_lookup,
    "dimension_name_override": q_dimension_name_override,
    "league_type_fix": q_league_type_fix,
    "unify_values": q_unify_values,
    "blank_to_null": q_blank_to_null,
    "cast_dates": q_cast_dates,
    "innings_key": q_innings_key,
    "new_keys": q_new_keys,
    "seen_keys": q_seen_keys,
    "version_decisions": q_version_decisions,
    "key_setops": q_key_setops,
    "duplicate_guard": q_duplicate_guard,
    "delta_count": q_delta_count,
    "merge_append": q_merge_append,
    "doc_deliveries": q_doc_deliveries,
    "yaml_deliveries": q_yaml_deliveries,
    "doc_quarantine": q_doc_quarantine,
    "doc_match_info": q_doc_match_info,
    "doc_registry": q_doc_registry,
    "doc_event": q_doc_event,
    "opponent": q_opponent,
    "search_distinct": q_search_distinct,
    "search_like": q_search_like,
    "normalised_columns": q_normalised_columns,
    "wide_dataset": q_wide_dataset,
}
