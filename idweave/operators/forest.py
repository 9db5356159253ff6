"""The merge forest: a log of links by generation, so a merge can be undone to any earlier one.

A log row (generation, org_id, connect_id) says that a merge of this generation
put ``org_id`` under ``connect_id``. Nothing is rewritten when an id that
others were merged into is itself merged: the log keeps both links, and the
canonical ids of a generation are the ends of the links up to it. An id linked
again in a later generation follows its last link (all of them where one
generation links it more than once).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .components import connected
from .merge import close_links


def grown(log: DataFrame, links: DataFrame, generation: int) -> DataFrame:
    """The log with the links of one more merge."""
    new = links.select(F.lit(generation).cast("bigint").alias("generation"), "org_id", "connect_id").distinct()
    return log.select("generation", "org_id", "connect_id").unionByName(new)


def links_at(log: DataFrame, generation: int) -> DataFrame:
    """(org_id, connect_id) in force after ``generation``: each id's links of its last merge until then."""
    last = Window.partitionBy("org_id").orderBy(F.desc("generation"))
    return (log.filter(F.col("generation") <= generation).withColumn("__rank", F.rank().over(last)).filter("__rank = 1")
            .select("org_id", "connect_id"))


def canonical_at(log: DataFrame, generation: int) -> DataFrame:
    """Every merged id with its canonical id after ``generation`` (chains followed to their end; cycles have none)."""
    direct = links_at(log, generation)
    return close_links(direct.limit(0), direct)["rekey"]


def split_to(log: DataFrame, targets: DataFrame, generation: int, last: int) -> DataFrame:
    """The ids under the canonical ids ``targets`` (connect_id) after generation ``last``, put back as they were
    after ``generation``: (org_id, was, connect_id). An id that was not merged then comes back as itself."""
    now = canonical_at(log, last).join(targets.select("connect_id").distinct(), "connect_id", "left_semi")
    then = canonical_at(log, generation).select("org_id", F.col("connect_id").alias("then"))
    return now.join(then, "org_id", "left").select(
        "org_id", F.col("connect_id").alias("was"), F.coalesce("then", "org_id").alias("connect_id"))


def undone_log(log: DataFrame, split: DataFrame, generation: int) -> DataFrame:
    """The log after the split: links made later than ``generation`` by an id that came back are dropped."""
    back = split.select("org_id").distinct()
    later = log.filter(F.col("generation") > generation)
    return log.filter(F.col("generation") <= generation).unionByName(later.join(back, "org_id", "left_anti"))


def restored_rows(archive: DataFrame, split: DataFrame, generation: int) -> DataFrame:
    """Archived profile rows (generation, rowkey, ...) of the ids that the split brings back to life as themselves.

    Of several archives of an id, the first one after ``generation`` counts:
    that is its profile as it stood then.
    """
    alive = split.filter("org_id = connect_id").select(F.col("org_id").alias("rowkey"))
    later = archive.filter(F.col("generation") > generation).join(alive, "rowkey", "left_semi")
    first = later.groupBy("rowkey").agg(F.min("generation").alias("generation"))
    return later.join(first, ["rowkey", "generation"], "left_semi").drop("generation")


def merge_groups(groups: DataFrame) -> DataFrame:
    """Links for merging the ids of every group (group, id) under a repeatable new id.

    Groups that share an id are merged together. The new id is made from the
    smallest member, so the order and the names of the groups change nothing.
    A group of one id gives no link; NULL ids and groups are left out.
    """
    rows = groups.select("group", "id").dropna().distinct()
    heads = rows.groupBy("group").agg(F.min("id").alias("head"))
    star = rows.join(heads, "group").filter("id != head").select(F.col("id").alias("org_id"), F.col("head").alias("connect_id"))
    nodes = connected(star, "org_id", "connect_id")
    smallest = nodes.groupBy("label").agg(F.min("node").alias("first"))
    return nodes.join(smallest, "label").select(F.col("node").alias("org_id"), F.concat(F.md5("first"), F.lit("-group")).alias("connect_id"))
