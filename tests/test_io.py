"""Sources, sinks and cells."""

import os
import tempfile

from pyspark.sql import functions as F

from idweave.operators import profiles
from idweave.schemas import USER_SCHEMA, Catalog
from idweave.sources import cells, sinks, tables

from .conftest import rows


def _tmp():
    return tempfile.mkdtemp(prefix="idweave-test-")


def test_dynamic_partition_overwrite_keeps_other_partitions(spark):
    path = os.path.join(_tmp(), "t")
    df = spark.createDataFrame([("a", "d1", "p1"), ("b", "d1", "p2"), ("c", "d2", "p1")],
                               "v string, time string, platform string")
    sinks.write_partitions(df, path)
    sinks.write_partitions(spark.createDataFrame([("z", "d1", "p1")], "v string, time string, platform string"), path)
    back = spark.read.schema("v string, time string, platform string").parquet(path)
    assert sorted(rows(back)) == [("b", "d1", "p2"), ("c", "d2", "p1"), ("z", "d1", "p1")]
    one = tables.read_partition(spark, path, "platform", "p1").filter(F.col("time") == "d2")
    assert rows(one, "v") == [("c",)]


def test_partition_scan_prunes(spark):
    path = os.path.join(_tmp(), "t")
    df = spark.createDataFrame([("a", "d1", "p1"), ("b", "d2", "p2")], "v string, time string, platform string")
    sinks.write_partitions(df, path)
    plan = spark.read.parquet(path).filter(F.col("platform") == "p1")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(platform" in plan


def test_cells_roundtrip(spark):
    cat = Catalog.for_columns("T", "rowkey", "INFO", ["rowkey", "name", "age", "ok", "day"],
                              {"age": "int", "ok": "boolean", "day": "date"})
    df = spark.createDataFrame([("r1", "ann", 30, True, "2024-01-02"), ("r2", None, None, False, None)],
                               "rowkey string, name string, age int, ok boolean, day string"
                               ).withColumn("day", F.to_date("day"))
    c = cells.to_cells(df, cat)
    assert ("r2", "INFO", "NAME") not in {(r.rowkey, r.family, r.qualifier) for r in c.collect()}
    back = cells.from_cells(c, cat).orderBy("rowkey")
    assert rows(back, "rowkey", "name", "age", "ok") == [("r1", "ann", 30, True), ("r2", None, None, False)]
    cat.domain = "age > 1"
    assert rows(cells.from_cells(c, cat), "rowkey") == [("r1",)]


def test_cell_records_last_write_wins(spark):
    recs = spark.createDataFrame([(
        "r1", '{"columnFamily":"I","qualifier":"N","value":"a"}\n{"columnFamily":"I","qualifier":"N","value":"b"}')],
        "rowkey string, cells string")
    from idweave.schemas import CellColumn
    cat = Catalog("T", "rowkey", {"n": CellColumn("I", "N")})
    got = cells.from_cells(cells.decode_cell_records(recs), cat, seq_col="seq")
    assert rows(got) == [("r1", "b")]


def test_csv_json_with_schema(spark):
    d = _tmp()
    p = os.path.join(d, "x.csv")
    with open(p, "w") as f:
        f.write("id,n\n1,a\nnot_a_number,b\n")
    df = tables.read_csv(spark, p, spark.createDataFrame([], "id int, n string").schema)
    got = sorted(rows(df), key=str)
    assert got[0][0] == 1 and got[1][0] is None and got[1][2] is not None
    j = os.path.join(d, "x.json")
    with open(j, "w") as f:
        f.write('{"id": 1, "n": "a"}\n{"id": 2}\n')
    assert sorted(rows(tables.read_json(spark, j, spark.createDataFrame([], "id int, n string").schema)),
                  key=str) == [(1, "a"), (2, None)]


def test_import_table(spark):
    ev = spark.createDataFrame([("r1", "mail"), ("r1", "mail")], "rowkey string, attr string")
    tables.import_table(spark, ev, "idweave_test_db", "ev", path=os.path.join(_tmp(), "tbl"))
    assert spark.table("idweave_test_db.ev").count() == 2


def test_upsert_paths_and_catalog_schema(spark):
    d = _tmp()
    old = spark.createDataFrame([("t1", 1), ("t2", 2)], "time string, n int")
    targets = []
    for name in ("a", "b", "c"):
        old.write.parquet(os.path.join(d, name, "v1"))
        targets.append((os.path.join(d, name, "v1"), os.path.join(d, name, "v2")))
    sinks.upsert_paths(spark, spark.createDataFrame([("t2", 20)], "time string, n int"), ["time"], targets)
    for _, new in targets:
        assert sorted(rows(spark.read.parquet(new))) == [("t1", 1), ("t2", 20)]
    cat = Catalog.for_columns("T", "id", "INFO", ["id", "a", "b"], {"b": "float"})
    assert [(f.name, f.dataType.simpleString()) for f in cat.schema().fields] == [
        ("id", "string"), ("a", "string"), ("b", "double")]
    assert cat.columns["a"].qualifier == "A"


def test_bucketed_tables_join_without_shuffle(spark):
    from idweave.operators.resolve import resolve_column
    d = _tmp()
    msgs = spark.createDataFrame([(f"u{i % 50}", i) for i in range(2000)], "user string, v int")
    links = spark.createDataFrame([(f"u{i}", f"C{i % 7}") for i in range(50)], "org_id string, connect_id string")
    sinks.write_bucketed(msgs, "idweave_b_msgs", ["user"], 8, path=os.path.join(d, "m"))
    sinks.write_bucketed(links, "idweave_b_links", ["org_id"], 8, path=os.path.join(d, "l"))
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = resolve_column(spark.table("idweave_b_msgs"), spark.table("idweave_b_links"), "user")
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert out.count() == 2000 and out.filter("user like 'C%'").count() == 2000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)


def test_jobs_end_to_end(spark):
    from idweave import jobs
    from idweave.operators.conform import spec_basic
    from idweave.plans import catalog, views
    d = _tmp()
    sf = "/root/testdata/sf0.001"
    views.dirty(spark, sf).write.parquet(os.path.join(d, "users_src"))
    views.fanout_source(spark, sf).write.parquet(os.path.join(d, "contacts_src"))
    views.message_source(spark, sf).write.parquet(os.path.join(d, "msgs_src"))
    views.prefixes(spark, sf).write.parquet(os.path.join(d, "prefixes"))
    spec = spec_basic("pa", "c_custkey", "raw_name", "raw_phone", "raw_mail")
    written = jobs.run_platform_day(spark, spec, os.path.join(d, "users_src"), "20240101", os.path.join(d, "day"),
                                    os.path.join(d, "contacts_src"), os.path.join(d, "msgs_src"),
                                    os.path.join(d, "prefixes"))
    assert set(written) == {"users", "contacts", "messages", "region"}
    users = spark.read.parquet(os.path.join(d, "day", "users")).filter("time = '20240101'")
    assert users.count() == catalog.q_platform_day_users(spark, sf).count()

    # E2 on E1's outputs
    views.links(spark, sf).write.parquet(os.path.join(d, "links"))
    day = os.path.join(d, "day")
    jobs.run_load_profiles(spark, f"{day}/users", f"{day}/contacts", f"{day}/region", os.path.join(d, "links"),
                           os.path.join(d, "profiles_ev"))
    ev_rows = spark.read.parquet(os.path.join(d, "profiles_ev"))
    assert set(r.attr for r in ev_rows.select("attr").distinct().collect()) >= {"mail", "phone", "name", "platform"}
    assert ev_rows.filter("score < 1").count() == 0

    # E3 on the stored tables
    catalog.messages(spark, sf).write.parquet(os.path.join(d, "msgs"))
    catalog.group_messages(spark, sf).write.parquet(os.path.join(d, "gmsgs"))
    views.contacts(spark, sf).write.parquet(os.path.join(d, "edges"))
    views.packed_profiles(spark, sf).write.parquet(os.path.join(d, "profiles"))
    c = spark.read.parquet(f"{sf}/customer.parquet")
    c.select(F.expr(views.LINK_CONNECT).alias("org_id"), F.concat(F.lit("N"), F.col("c_nationkey").cast("string"))
             .alias("connect_id"), F.lit(1).alias("status"), F.lit("20240101").alias("insert_time")).distinct() \
        .write.parquet(os.path.join(d, "requests"))
    outs = jobs.run_identity_merge(spark, *(os.path.join(d, x) for x in
                                            ("profiles", "msgs", "gmsgs", "edges", "links", "requests")),
                                   "20240101", os.path.join(d, "merge"))
    assert "links" in outs
    new_links = spark.read.parquet(os.path.join(d, "merge", "links"))
    assert sorted(rows(new_links)) == sorted(rows(catalog.q_merge_job_links(spark, sf)))
    assert spark.read.parquet(os.path.join(d, "merge", "requests")).count() == 0

    # E4
    ev = views.events_by_day(spark, sf)
    for name, df in {"signup": ev.filter("event_type = 'signup'"), "purchase": ev.filter("event_type = 'purchase'")}.items():
        df.select("day", F.col("user_id").alias("uid")).write.parquet(os.path.join(d, name))
    ev.select("day", "user_id", "event_type").write.parquet(os.path.join(d, "contacts_ev"))
    ev.filter("event_type = 'click'").select("day", F.col("event_id").alias("mid")).write.parquet(os.path.join(d, "m"))
    ev.filter("event_type = 'view'").select("day", F.col("event_id").alias("mid")).write.parquet(os.path.join(d, "g"))
    jobs.run_daily_counters(spark, [os.path.join(d, "signup"), os.path.join(d, "purchase")],
                            os.path.join(d, "contacts_ev"), os.path.join(d, "m"), os.path.join(d, "g"),
                            os.path.join(d, "daily"))
    assert sorted(rows(spark.read.parquet(os.path.join(d, "daily")))) == \
        sorted(rows(catalog.q_daily_counters(spark, sf)))
