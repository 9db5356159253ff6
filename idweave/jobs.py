"""The reference's four job entry points as Spark jobs.

Each job reads parquet inputs, builds one lazy plan per output and writes new
snapshot paths (never the paths it reads). Nothing is collected to the
driver; a failed job can be re-run, because every write replaces its whole
output (or, for partitioned tables, only the partitions it produces).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators.conform import PlatformSpec
from .plans import pipelines
from .sources.sinks import write_partitions


def _write(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def run_platform_day(spark: SparkSession, spec: PlatformSpec, users_path: str, day: str, out_base: str,
                     contacts_path: str | None = None, messages_path: str | None = None,
                     prefixes_path: str | None = None) -> list[str]:
    """Clean one platform's day; tables are written partitioned by (time, platform)."""
    rd = spark.read.parquet
    outs = pipelines.platform_day(rd(users_path), spec, rd(contacts_path) if contacts_path else None,
                                  rd(messages_path) if messages_path else None,
                                  rd(prefixes_path) if prefixes_path else None, time=day)
    written = []
    for name, df in outs.items():
        if "platform" not in df.columns:
            df = df.withColumn("platform", F.lit(spec.platform))
        write_partitions(df, f"{out_base}/{name}")
        written.append(name)
    return written


def run_load_profiles(spark: SparkSession, users_path: str, edges_path: str, regions_path: str,
                      links_path: str, out_path: str, stored_path: str | None = None) -> None:
    """Resolve ids, build evidence for every attribute, merge with the stored state."""
    rd = spark.read.parquet
    ev = pipelines.load_profiles(rd(users_path), rd(edges_path), rd(regions_path), rd(links_path),
                                 rd(stored_path) if stored_path else None)
    _write(ev, out_path)


def run_identity_merge(spark: SparkSession, profiles_path: str, messages_path: str, group_messages_path: str,
                       edges_path: str, links_path: str, requests_path: str, insert_time: str,
                       out_base: str) -> list[str]:
    """Process all pending links of ``insert_time``; every output is a new snapshot."""
    rd = spark.read.parquet
    outs = pipelines.identity_merge_job(rd(profiles_path), rd(messages_path), rd(group_messages_path),
                                        rd(edges_path), rd(links_path), rd(requests_path), insert_time)
    for name, df in outs.items():
        _write(df, f"{out_base}/{name}")
    return list(outs)


def run_daily_counters(spark: SparkSession, user_paths: list[str], contacts_path: str, messages_path: str,
                       group_messages_path: str, out_path: str, day: str | None = None) -> None:
    """Per-day counters; inputs carry ``day`` (yyyyMMdd) plus ``uid`` / ``mid``.

    With ``day`` only that day is counted (the reference's daily run). The
    result is written to ``out_path``; merging it into a stored counter
    table is ``sources.sinks.upsert`` / ``upsert_paths`` on ``time``.
    """
    from .operators.counts import daily_counters

    def rd(p):
        df = spark.read.parquet(p)
        return df.filter(F.col("day") == day) if day else df

    counts = daily_counters([rd(p) for p in user_paths], rd(contacts_path), rd(messages_path),
                            rd(group_messages_path))
    _write(counts, out_path)


def _spec_from_json(text: str) -> PlatformSpec:
    """Platform spec from JSON: {"platform", "id", "columns": {model: source},
    "cleaners": {model: cleaner name}, "constants": {model: value}, "is_user"}."""
    import json

    from .functions import cleaners as C

    names = {"phone": C.clean_phone, "name": C.clean_name, "mail": C.clean_mail, "birth": C.clean_birth,
             "gender": lambda c, t=None: C.clean_gender(c)}
    d = json.loads(text)
    token = d.get("null_token", "null")
    return PlatformSpec(d["platform"], d["id"], dict(d.get("columns", {})),
                        {k: (lambda c, f=names[v]: f(c, token)) for k, v in d.get("cleaners", {}).items()},
                        dict(d.get("constants", {})), int(d.get("is_user", 1)))


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    """Command line: ``python -m idweave.jobs <job> ...`` (see ``--help``)."""
    import argparse

    ap = argparse.ArgumentParser(prog="idweave.jobs")
    sub = ap.add_subparsers(dest="job", required=True)
    p = sub.add_parser("platform-day", help="E1: clean one platform's day")
    p.add_argument("--spec", required=True, help="platform spec as JSON")
    p.add_argument("--users", required=True)
    p.add_argument("--day", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--contacts")
    p.add_argument("--messages")
    p.add_argument("--prefixes")
    p = sub.add_parser("load-profiles", help="E2: evidence profiles merged with the stored state")
    for a in ("users", "edges", "regions", "links", "out"):
        p.add_argument(f"--{a}", required=True)
    p.add_argument("--stored")
    p = sub.add_parser("identity-merge", help="E3: process pending links")
    for a in ("profiles", "messages", "group-messages", "edges", "links", "requests", "insert-time", "out"):
        p.add_argument(f"--{a}", required=True)
    p = sub.add_parser("daily-counters", help="E4: per-day counters")
    p.add_argument("--users", required=True, nargs="+")
    for a in ("contacts", "messages", "group-messages", "out"):
        p.add_argument(f"--{a}", required=True)
    p.add_argument("--day")
    a = ap.parse_args(argv)

    if spark is None:
        from .session import configure
        spark = configure(SparkSession.builder.getOrCreate())
    if a.job == "platform-day":
        run_platform_day(spark, _spec_from_json(a.spec), a.users, a.day, a.out, a.contacts, a.messages, a.prefixes)
    elif a.job == "load-profiles":
        run_load_profiles(spark, a.users, a.edges, a.regions, a.links, a.out, a.stored)
    elif a.job == "identity-merge":
        run_identity_merge(spark, a.profiles, a.messages, a.group_messages, a.edges, a.links, a.requests,
                           a.insert_time, a.out)
    else:
        run_daily_counters(spark, a.users, a.contacts, a.messages, a.group_messages, a.out, a.day)


if __name__ == "__main__":
    main()
