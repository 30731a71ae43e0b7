"""Declared catalog tables, conformance, stable keys, snapshot views, deletes on any table,
exports, and landed JSON, bound to the benchmark tables."""

import datetime as dt
import uuid

from pyspark.sql import functions as F

from hearth.bindings import binding, table
from hearth.bindings.families import GEO_SQL, RUN_TS, inventory_landed, inventory_sql  # noqa: F401
from hearth.operators import load_keys
from hearth.plans import families as fam
from hearth.plans import specs as S
from hearth.plans.registry import declared_layout, registry
from hearth.quality import conformance_report
from hearth.session import scratch_path
from hearth.sinks import (
    create_declared, delete_period, dimension_snapshot, drop_declared, export_sample, insert_declared, overwrite_periods,
    read_table, replace_declared, snapshot_view, write_create, write_replace,
)
from hearth.sources import flatten_json, malformed_json, read_delimited, read_json_documents


def _declared_sql(geo: str) -> str:
    spec = registry()["inventory", geo]
    columns = [f"CAST(trunc({c}) AS INTEGER) AS {c}" if t == "int" else c for c, t in declared_layout(spec)]
    return f"SELECT {', '.join(columns)} FROM ({inventory_sql(geo)})"


@binding("declared_table", _declared_sql("county"))
def declared_table_q(spark, sf):
    """The county inventory in its declared layout (whole numbers, text lengths): created, not
    created twice, appended to, replaced by a swap, read back."""
    spec = registry()["inventory", "county"]
    layout, name = declared_layout(spec), f"{spec.table}_{uuid.uuid4().hex[:8]}"
    rows = fam.inventory_transform(inventory_landed(spark, sf, "county"), S.INVENTORY_GEOGRAPHIES["county"], RUN_TS)
    where = scratch_path(spark, "declared_table")
    create_declared(spark, name, layout, where)
    try:
        create_declared(spark, name, layout, where)
        raise AssertionError("the table was created twice")
    except Exception as e:
        if "ALREADY_EXISTS" not in str(e):
            raise
    insert_declared(rows.where("county_fips % 4 = 1"), name, layout)
    replace_declared(spark, rows, name, layout, where)
    out = spark.table(name)
    drop_declared(spark, name)  # the definition; the rows stay at their location
    return out


# A declared layout that the documents table does not meet.
DOCUMENT_LAYOUT = [("doc_id", "bigint"), ("text", "varchar(2000)"), ("lang", "varchar(2)"), ("source", "varchar(100)"),
                   ("n_chars", "string"), ("quality", "int")]


@binding("conformance_report", """
SELECT * FROM (VALUES (0, 'doc_id', 'bigint', 'bigint', NULL::INTEGER, NULL::INTEGER, NULL::BIGINT, 'ok'),
                      (4, 'n_chars', 'string', (SELECT CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' END
                          FROM (SELECT any_value(typeof(n_chars)) AS data_type FROM documents)), NULL, NULL, NULL, 'type'),
                      (5, 'quality', 'int', NULL, NULL, NULL, NULL, 'missing'))
  t(position, column_name, declared_type, actual_type, declared_length, max_length, rows_over, status)
UNION ALL
SELECT 1, 'text', 'varchar(2000)', 'string', 2000, CAST(max(length(text)) AS INTEGER), count(*) FILTER (WHERE length(text) > 2000),
       CASE WHEN count(*) FILTER (WHERE length(text) > 2000) > 0 THEN 'length' ELSE 'ok' END FROM documents
UNION ALL
SELECT 2, 'lang', 'varchar(2)', 'string', 2, CAST(max(length(lang)) AS INTEGER), count(*) FILTER (WHERE length(lang) > 2),
       CASE WHEN count(*) FILTER (WHERE length(lang) > 2) > 0 THEN 'length' ELSE 'ok' END FROM documents
UNION ALL
SELECT 3, 'source', 'varchar(100)', 'string', 100, CAST(max(length(source)) AS INTEGER), count(*) FILTER (WHERE length(source) > 100),
       CASE WHEN count(*) FILTER (WHERE length(source) > 100) > 0 THEN 'length' ELSE 'ok' END FROM documents""")
def conformance_report_q(spark, sf):
    return conformance_report(table(spark, sf, "documents"), DOCUMENT_LAYOUT)


@binding("stable_keys", """
WITH first AS (SELECT p_name, row_number() OVER (ORDER BY p_name) - 1 AS k FROM (SELECT DISTINCT p_name FROM part WHERE p_partkey % 3 = 0)),
later AS (SELECT p_name, row_number() OVER (ORDER BY p_name) - 1 + (SELECT count(*) FROM first) AS k
          FROM (SELECT DISTINCT p_name FROM part WHERE p_name NOT IN (SELECT p_name FROM first)))
SELECT p_name AS label, CAST(k AS BIGINT) AS lookup_key FROM (SELECT * FROM first UNION ALL SELECT * FROM later)""")
def stable_keys_q(spark, sf):
    """A lookup that is loaded three times: some labels, all labels (old keys stay), all again."""
    part = table(spark, sf, "part").select("p_name")
    some = table(spark, sf, "part").where("p_partkey % 3 = 0").select("p_name")
    path = scratch_path(spark, "stable_keys")
    load_keys(some, "p_name", path)
    load_keys(part, "p_name", path)
    return load_keys(part, "p_name", path).select(F.col("p_name").alias("label"), "lookup_key")


@binding("snapshot_view", """
SELECT DISTINCT c_nationkey, c_mktsegment FROM customer WHERE c_custkey % 2 = 0 OR c_nationkey < 12""")
def snapshot_view_q(spark, sf):
    """The distinct view over an archive, queried after a second snapshot was added to it."""
    c = table(spark, sf, "customer")
    path = scratch_path(spark, "snapshot_view")
    columns = ["c_nationkey", "c_mktsegment"]
    dimension_snapshot(c.where("c_custkey % 2 = 0"), columns, path, dt.date(2025, 1, 1), "Home_Values")
    dimension_snapshot(c.where("c_nationkey < 12"), columns, path, dt.date(2025, 2, 1), "Home_Values")
    return snapshot_view(spark, path, columns, f"lkp_zip_location_{uuid.uuid4().hex[:8]}")


@binding("delete_period_any_table", """
WITH o AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, date_trunc('month', o_orderdate) AS month FROM orders),
m AS (SELECT max(day) AS d, date_trunc('month', max(day)) AS t FROM o)
SELECT 'plain, date' AS kind, o_orderkey FROM o, m WHERE day <> d
UNION ALL SELECT 'folders, date', o_orderkey FROM o, m WHERE date_trunc('month', day) <> t
UNION ALL SELECT 'folders, timestamp', o_orderkey FROM o, m WHERE month <> t
UNION ALL SELECT 'plain, timestamp', o_orderkey FROM o, m WHERE month <> t""")
def delete_period_any_table_q(spark, sf):
    """The newest period removed from tables with and without period folders, by dates and timestamps."""
    o = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("day"),
                                          F.trunc(F.col("o_orderdate").cast("date"), "month").alias("first"))
    o = o.withColumn("month", F.col("first").cast("timestamp_ntz"))
    newest = o.agg(F.max("day")).first()[0]
    month = dt.datetime(newest.year, newest.month, 1)
    base = scratch_path(spark, "delete_period_any_table")
    write_replace(o.select("o_orderkey", "day"), f"{base}/a")
    overwrite_periods(o.select("o_orderkey", "first"), f"{base}/b", "first")
    overwrite_periods(o.select("o_orderkey", "month"), f"{base}/c", "month")
    write_replace(o.select("o_orderkey", "month"), f"{base}/d")
    out = None
    for kind, at, column, value in (("plain, date", "a", "day", newest), ("folders, date", "b", "first", month.date()),
                                    ("folders, timestamp", "c", "month", month), ("plain, timestamp", "d", "month", month)):
        if not delete_period(spark, f"{base}/{at}", column, value):
            raise AssertionError(f"{kind}: no such period")
        left = read_table(spark, f"{base}/{at}").select(F.lit(kind).alias("kind"), "o_orderkey")
        out = left if out is None else out.unionByName(left)
    return out


@binding("sink_create", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'O'")
def sink_create_q(spark, sf):
    """Drop, then create: nothing of the earlier table is left."""
    o = table(spark, sf, "orders")
    path = scratch_path(spark, "sink_create")
    write_replace(o.where("o_orderstatus = 'F'"), path, ["o_orderstatus"])
    write_create(spark, o.where("o_orderstatus = 'O'").select("o_orderkey", "o_totalprice"), path)
    return read_table(spark, path)


@binding("sample_export", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 1000")
def sample_export_q(spark, sf):
    path = scratch_path(spark, "sample_export")
    export_sample(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), path, 1000, [F.col("o_totalprice").desc(), "o_orderkey"])
    return read_delimited(spark, path, [("o_orderkey", "bigint"), ("o_totalprice", "double")])


def _landed_json(spark, sf):
    """Events as JSON lines with nested fields; some lines are cut short."""
    e = table(spark, sf, "events")
    document = F.to_json(F.struct(F.col("event_id").alias("id"), F.struct(F.col("event_type").alias("type"), F.struct(
        F.col("user_id").alias("id")).alias("user")).alias("event"), F.array(F.lit("x"), F.col("event_type")).alias("tags"),
        F.array().cast("array<string>").alias("none")))
    line = F.when(F.col("event_id") % 20 == 3, F.substring(document, 1, 12)).otherwise(document)
    path = scratch_path(spark, "landed_json")
    e.select(line.alias("value")).write.text(path)
    return read_json_documents(spark, path, multi_line=False)


@binding("json_landed_paths", """
WITH e AS (SELECT * FROM events WHERE event_id % 20 <> 3)
SELECT '$.id' AS path, CAST(event_id AS VARCHAR) AS value FROM e
UNION ALL SELECT '$.event.type', event_type FROM e
UNION ALL SELECT '$.event.user.id', CAST(user_id AS VARCHAR) FROM e
UNION ALL SELECT '$.tags[0]', 'x' FROM e
UNION ALL SELECT '$.tags[1]', event_type FROM e
UNION ALL SELECT '$.none', '[]' FROM e""")
def json_landed_paths_q(spark, sf):
    return flatten_json(_landed_json(spark, sf), "document")


@binding("json_malformed", """
SELECT substr('{"id":' || CAST(event_id AS VARCHAR) || ',"event":{"type"', 1, 12) AS text FROM events WHERE event_id % 20 = 3""")
def json_malformed_q(spark, sf):
    return malformed_json(_landed_json(spark, sf)).select("text")
