"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

A document belongs to a block of its source (a hash of its id). A source's
draw list is its blocks in a random order, once per epoch; its quota is the
number of whole blocks that fit its target, where one that does not fit the
rest is passed over. A tree halves the output shards
again and again and gives each half a multivariate-hypergeometric draw of the
quotas, so every shard holds an exact, random share of every source's blocks;
shards take disjoint runs of the draw list and shuffle locally. The documents
of blocks passed over are taken one by one in random order, as far as each
fits the rest, before the next epoch begins. At last one more document, the
nearest in size, closes the gap to the target.

Block totals, quotas (sources x shards) and, at a
time, the sizes of ``AT_ONCE`` documents or one block of a source reach the driver.

Defined results: null text has size 0, a null source is a source of its own
(last), a null id is placed by its row; repeated ids are separate documents;
sources without words have target 0; no rows give no rows.
"""

from __future__ import annotations

from fractions import Fraction

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, WORD, free_name, numbered, store

WEIGHTS, SHARE, MOST, SEED = (3, 1, 2), Fraction(3, 2), 2, 17
#: At least so many blocks a source and shards; more keep a block's mean rows and a shard's mean bytes of text within bounds.
BLOCKS, SHARDS, BLOCK_ROWS, SHARD_BYTES = 256, 64, 1 << 16, 1 << 30
#: Documents of a source that are looked at together where blocks do not fit, unless one block has more.
AT_ONCE = 4096


def targets(sizes: list[int], weights: list[int], total: Fraction, most: int = MOST) -> list[Fraction]:
    """Shares of ``total`` by weight, none above ``most`` times its size; excess is shared again by weight."""
    out: dict[int, Fraction] = {}
    while len(out) < len(sizes):
        open_ = [i for i in range(len(sizes)) if i not in out]
        rest, weight = total - sum(out.values()), sum(weights[i] for i in open_)
        share = {i: rest * weights[i] / weight for i in open_}
        over = [i for i in open_ if share[i] > most * sizes[i]]
        out |= {i: Fraction(most * sizes[i]) for i in over} if over else share
    return [out[i] for i in range(len(sizes))]


def split_quotas(quotas: np.ndarray, shards: int, rng: np.random.Generator) -> np.ndarray:
    """Quotas (per source) of each shard, by recursive halving with multivariate-hypergeometric draws."""
    if shards == 1:
        return quotas[None, :]
    left = shards // 2
    n = int(quotas.sum())
    drawn = rng.multivariate_hypergeometric(quotas, n * left // shards, method="marginals") if n else quotas
    return np.vstack([split_quotas(drawn, left, rng), split_quotas(quotas - drawn, shards - left, rng)])


def parts(rows: list[int], sizes: list[int], most: int) -> tuple[list[int], int]:
    """Number of blocks of each source and of shards, for the counted rows and bytes of the sources.

    Four blocks of a like size to a shard let the shards be nearly alike.
    """
    total = sum(sizes)
    shards = max(SHARDS, -(-most * total // SHARD_BYTES))
    return [max(BLOCKS, -(-4 * shards * b // max(1, total)), -(-n // BLOCK_ROWS)) for n, b in zip(rows, sizes)], shards


def sized(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: int) -> DataFrame:
    """Rows of ``docs`` (a table just read) with size, bytes, a block hash and a random order key; stored once."""
    key = F.coalesce(F.col(id_col).cast("bigint"), F.col("row_no"))
    size = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("bigint")
    return store(numbered(docs).select(
        "row_no", F.col(id_col).cast("bigint").alias("id"), F.col(source_col).cast("string").alias("source"),
        size.alias("size"), F.coalesce(F.octet_length(text_col), F.lit(0)).alias("bytes"),
        F.xxhash64(key, F.lit(seed)).alias("block_key"), F.xxhash64(key, F.lit(seed + 1)).alias("order_key")), "sized")


def fill(rows: DataFrame, held: list[dict], want: list[Fraction], most: int, seed: int) -> tuple[list, list, list]:
    """Per source its whole blocks (epoch, block); single copies (row_no, source_no, size, epoch, order_key); open gaps.

    ``held`` has per source and block the size, the documents with words and
    the least of their sizes. A gap is (source_no, epoch of the first block
    passed over, words). What does not fit the rest of a target never will, as
    the rest only shrinks; so each document is looked at once an epoch.
    """
    spark = rows.sparkSession
    taken, drawn, singles, ends = [0] * len(held), [[] for _ in held], [], {}
    rngs = [np.random.default_rng([seed, i]) for i in range(len(held))]
    for e in range(most):
        left: dict[int, list[int]] = {}
        for i, by_block in enumerate(held):
            for b in rngs[i].permutation(sorted(by_block)).tolist():
                size = by_block[b].size
                if size and taken[i] + size <= want[i]:
                    drawn[i].append((e, b))
                    taken[i] += size
                elif size:
                    left.setdefault(i, []).append(b)
                    ends.setdefault(i, e)
        while True:
            asked = []
            for i, open_ in left.items():
                gap, n, count = int(want[i] - taken[i]), 0, 0
                open_ = [b for b in open_ if held[i][b].least <= gap]
                while n < len(open_) and (not n or count + held[i][open_[n]].docs <= AT_ONCE):
                    count += held[i][open_[n]].docs
                    n += 1
                asked += [(i, b, gap) for b in open_[:n]]
                left[i] = open_[n:]
            if not asked:
                break
            wanted = spark.createDataFrame(asked, "source_no int, block int, gap bigint")
            wanted = F.broadcast(wanted) if len(asked) <= BROADCAST_ROWS else wanted
            fit = rows.join(wanted, ["source_no", "block"]).filter("size BETWEEN 1 AND gap").select(
                "row_no", "source_no", "size", "order_key").collect()
            for r in sorted(fit, key=lambda r: (r.order_key, r.row_no)):
                if taken[r.source_no] + r.size <= want[r.source_no]:
                    singles.append((r.row_no, r.source_no, r.size, e, r.order_key))
                    taken[r.source_no] += r.size
    return drawn, singles, [(i, e, float(want[i] - taken[i])) for i, e in ends.items()]


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple[int, ...] = WEIGHTS, share: Fraction = SHARE, most: int = MOST, blocks: int | None = None,
        shards: int | None = None, seed: int = SEED) -> tuple[DataFrame, DataFrame, int]:
    """(rows, draws, shards): per row its source's target and size; per taken copy row_no, epoch, shard and order_key.

    The numbers of blocks and shards follow from the counted input unless they are given.
    """
    spark = docs.sparkSession
    rows = sized(docs, id_col, text_col, source_col, seed)
    counted = {c.source: c for c in rows.groupBy("source").agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes")).collect()}
    names = sorted(counted, key=lambda s: (s is None, (s or "").encode()))
    each, most_shards = parts([counted[s].n for s in names], [counted[s].bytes for s in names], most)
    shards = shards or most_shards
    small = F.broadcast if len(names) <= BROADCAST_ROWS else (lambda df: df)
    cut = small(spark.createDataFrame([(s, i, blocks or each[i]) for i, s in enumerate(names)],
                                      "source string, source_no int, blocks int"))
    rows = rows.join(cut, rows.source.eqNullSafe(cut.source)).drop(cut.source).withColumn(
        "block", F.pmod("block_key", "blocks").cast("int")).drop("block_key", "blocks", "bytes")
    totals = rows.groupBy("source_no", "block").agg(
        F.sum("size").alias("size"), F.count(F.when(F.col("size") > 0, 1)).alias("docs"),
        F.min(F.when(F.col("size") > 0, F.col("size"))).alias("least")).collect()  # the blocks of all sources
    held: list[dict] = [{} for _ in names]
    for t in totals:
        held[t.source_no][t.block] = t
    sizes = [sum(t.size for t in b.values()) for b in held]
    want = targets(sizes, [weights[i % len(weights)] for i in range(len(names))], share * sum(sizes), most)
    info = spark.createDataFrame([(i, sizes[i], float(want[i])) for i in range(len(names))],
                                 "source_no int, source_size bigint, target double")
    rows = rows.join(small(info), "source_no")
    drawn, singles, ends = fill(rows, held, want, most, seed)
    quotas = split_quotas(np.array([len(d) for d in drawn], dtype=np.int64), shards, np.random.default_rng([seed, 1 << 20]))
    plan = [(i, b, e, int(k)) for i, order in enumerate(drawn)
            for (e, b), k in zip(order, np.repeat(np.arange(shards), quotas[:, i]))]
    plan_df = spark.createDataFrame(plan, "source_no int, block int, epoch int, shard int")
    ends_df = spark.createDataFrame(ends, "source_no int, epoch int, gap double")
    singles_df = spark.createDataFrame(singles, "row_no bigint, source_no int, size bigint, epoch int, order_key bigint")
    small = F.broadcast if len(plan) + len(singles) <= BROADCAST_ROWS else (lambda df: df)
    whole = rows.join(small(plan_df), ["source_no", "block"]).select("row_no", "source_no", "size", "epoch", "shard",
                                                                     "order_key")
    own_shard = F.pmod("order_key", F.lit(shards)).cast("int").alias("shard")
    single = singles_df.select("row_no", "source_no", "size", "epoch", own_shard, "order_key")
    # the nearest of the documents not taken in the epoch closes the gap
    spare = rows.join(small(ends_df), "source_no").join(
        small(plan_df.select("source_no", "block", "epoch")), ["source_no", "block", "epoch"], "left_anti").join(
        small(singles_df.select("row_no", "epoch")), ["row_no", "epoch"], "left_anti")
    miss = F.abs(F.col("size") - F.col("gap"))
    near = spare.filter((miss < F.col("gap")) & (F.col("size") > 0)).groupBy("source_no", "epoch").agg(
        F.min(F.struct(miss.alias("miss"), "order_key", "row_no", "size")).alias("b"))
    closing = near.select("b.row_no", "source_no", "b.size", "epoch", "b.order_key").select(
        "row_no", "source_no", "size", "epoch", own_shard, "order_key")
    draws = whole.unionByName(single).unionByName(closing)
    return rows, draws, shards


def mixed_sizes(docs: DataFrame, **options) -> DataFrame:
    """Per row of ``docs``: row_no, id, size, source_size, target and taken (words taken, repeats counted)."""
    rows, draws, _ = mix(docs, **options)
    taken = store(draws.groupBy("row_no").agg(F.sum("size").alias("taken")), "taken")
    return rows.join(taken, "row_no", "left").select("row_no", "id", "size", "source_size", "target",
                                                     F.coalesce("taken", F.lit(0)).cast("bigint").alias("taken"))


def mixture(docs: DataFrame, **options) -> DataFrame:
    """The mixed rows of ``docs`` (repeats included), one partition run per shard, shuffled within it."""
    _, draws, shards = mix(docs, **options)
    row, shard, order = (free_name(docs, n) for n in ("llm_row_no", "llm_shard", "llm_order"))
    draws = store(draws.select(F.col("row_no").alias(row), F.col("shard").alias(shard),
                               F.xxhash64("order_key", "epoch").alias(order)), "draws")
    chosen = F.broadcast(draws) if draws.count() <= BROADCAST_ROWS else draws
    mixed = numbered(docs, row).join(chosen, row)
    return mixed.repartition(shards, shard).sortWithinPartitions(shard, order).select(*docs.columns)
