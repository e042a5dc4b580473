"""Masks, row filters, secured views, privileges."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeloom.cases.registry import case
from lakeloom.operators import governance as g
from lakeloom.session import scratch_path, table

EMAIL_SQL = "lower(replace(c_name, '#', '.')) || '@example.com'"


def _people(spark, d):
    return table(spark, d, "customer").select(
        "c_custkey", F.expr("lower(replace(c_name, '#', '.')) || '@example.com'").alias("email"),
        F.expr("CASE c_custkey % 3 WHEN 0 THEN 'East' WHEN 1 THEN 'West' ELSE 'Central' END").alias("region"),
        "c_mktsegment")


PEOPLE_SQL = f"SELECT c_custkey, {EMAIL_SQL} AS email, CASE c_custkey % 3 WHEN 0 THEN 'East' WHEN 1 THEN 'West' ELSE 'Central' END AS region, c_mktsegment FROM customer"


@case("p01_column_mask", f"""
SELECT 'reader' AS seen_by, c_custkey, '***@example.com' AS email FROM ({PEOPLE_SQL}) AS p
UNION ALL SELECT 'admin', c_custkey, email FROM ({PEOPLE_SQL}) AS p UNION ALL SELECT 'prefix', c_custkey, left(email, 2) || '***@***.***' FROM ({PEOPLE_SQL}) AS p""")
def p01(spark, d):
    people = _people(spark, d).select("c_custkey", "email")
    views = {"reader": g.apply_masks(people, {"email": g.mask_keep_domain}, {"staff"}),
             "admin": g.apply_masks(people, {"email": g.mask_keep_domain}, {"admins"}),
             "prefix": g.apply_masks(people, {"email": g.mask_keep_prefix}, set())}
    out = [df.select(F.lit(n).alias("seen_by"), "c_custkey", "email") for n, df in views.items()]
    return out[0].unionByName(out[1]).unionByName(out[2])


RULES = {"admins": "true", "us_team": "region = 'East'", "eu_team": "region = 'West'"}


@case("p02_row_filter", f"""
SELECT 'us_team' AS reader, region, count(*) AS n FROM ({PEOPLE_SQL}) AS p WHERE region = 'East' GROUP BY region
UNION ALL SELECT 'both', region, count(*) FROM ({PEOPLE_SQL}) AS p WHERE region IN ('East', 'West') GROUP BY region
UNION ALL SELECT 'admins', region, count(*) FROM ({PEOPLE_SQL}) AS p GROUP BY region""")
def p02(spark, d):
    people, out = _people(spark, d), []
    for reader, groups in {"us_team": {"us_team"}, "both": {"us_team", "eu_team"}, "admins": {"admins"}, "none": set()}.items():
        out.append(g.apply_row_filter(people, RULES, groups).groupBy("region").agg(F.count(F.lit(1)).alias("n"))
                   .select(F.lit(reader).alias("reader"), "region", "n"))
    return out[0].unionByName(out[1]).unionByName(out[2]).unionByName(out[3])


@case("p03_secured_view", f"SELECT c_custkey, '***@example.com' AS email, region, c_mktsegment FROM ({PEOPLE_SQL}) AS p WHERE region = 'West'")
def p03(spark, d):
    name = scratch_path(spark, "secured").rsplit("/", 1)[1].replace("-", "_")
    g.secured_view(_people(spark, d), name, {"email": g.mask_keep_domain}, RULES, {"eu_team"})
    return spark.table(name)
