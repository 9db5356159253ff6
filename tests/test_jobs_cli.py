"""The job command line drives the same jobs."""

import json
import os
import tempfile

from pyspark.sql import functions as F

from idweave import jobs
from idweave.plans import catalog, views

from .conftest import rows


def test_cli_daily_counters_and_platform_day(spark):
    d = tempfile.mkdtemp(prefix="idweave-cli-")
    sf = "/root/testdata/sf0.001"
    ev = views.events_by_day(spark, sf)
    for name, t in (("signup", "signup"), ("purchase", "purchase")):
        ev.filter(F.col("event_type") == t).select("day", F.col("user_id").alias("uid")).write.parquet(f"{d}/{name}")
    ev.select("day", "user_id", "event_type").write.parquet(f"{d}/contacts")
    ev.filter("event_type = 'click'").select("day", F.col("event_id").alias("mid")).write.parquet(f"{d}/m")
    ev.filter("event_type = 'view'").select("day", F.col("event_id").alias("mid")).write.parquet(f"{d}/g")
    jobs.main(["daily-counters", "--users", f"{d}/signup", f"{d}/purchase", "--contacts", f"{d}/contacts",
               "--messages", f"{d}/m", "--group-messages", f"{d}/g", "--out", f"{d}/daily"], spark=spark)
    assert sorted(rows(spark.read.parquet(f"{d}/daily"))) == sorted(rows(catalog.q_daily_counters(spark, sf)))

    views.dirty(spark, sf).write.parquet(f"{d}/users_src")
    spec = {"platform": "pa", "id": "c_custkey", "columns": {"name": "raw_name", "phone": "raw_phone", "mail": "raw_mail"},
            "cleaners": {"name": "name", "phone": "phone", "mail": "mail"}, "constants": {"name_source": "Unknown"}}
    jobs.main(["platform-day", "--spec", json.dumps(spec), "--users", f"{d}/users_src", "--day", "20240101",
               "--out", f"{d}/day"], spark=spark)
    got = spark.read.parquet(f"{d}/day/users").drop("time")
    want = catalog.conformed_users(spark, sf).filter(F.col("platform") == "pa")
    cols = sorted(c for c in want.columns)
    assert sorted(rows(got.select(*cols)), key=str) == sorted(rows(want.select(*cols).distinct()), key=str)
    assert os.path.isdir(f"{d}/day/users/time=20240101/platform=pa")
