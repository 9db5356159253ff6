"""Robust multivariate outliers: minimum-covariance-determinant estimates per language and source.

Every text gives a few counts; smoothed shares of them, transformed, are its
vector. Per group (language, source) the estimate starts from coordinate-wise
medians and takes concentration steps: distances of all rows, the ``SUBSET``
share with the smallest, and centre and covariance of those. Each step is
aggregation over all rows of all groups; a group's rows are never gathered. A
language's own estimate stands behind those of its sources with the weight of
``PRIOR`` rows, so small groups are defined too. Values, distances and
quantiles are on integer grids, so sums do not depend on the order of rows.

A row is kept when it passes the base rules and its squared Mahalanobis
distance is at most the chi-square quantile of ``CUTOFF``, times the group's
consistency factor where that is above 1.

Defined results: null text has no words and fails the base rules; null
language or source is a group of its own; one row is a group too; repeated
rows are rows; no rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, WHITE_SPACE, Bounded, numbered, slices, store, texts
from .ngram_join import mixed

SUBSET, STEPS, PRIOR, CUTOFF = 0.75, 4, 200, 0.99999
#: Fixed values of the base rules.
SYMBOLS, MIN_WORDS, MOST_REPEATED, WINDOW = b"#*$%&|<>", 10, 20, 5
UPPER, DIGITS, POINTS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b".,;:!?'\"()-"
#: Values are held in this many steps a unit; the spread added to each coordinate, so that a constant one stays defined.
GRID = 1000
FLOORS = {"word_length": 0.08, "symbols": 0.04, "dup_lines": 0.12, "repeats": 0.12, "upper": 0.06, "points": 0.06,
          "digits": 0.16, "line_words": 0.5}
NAMES = list(FLOORS)
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def repeated_words(words: list[list[bytes]], hashes: Bounded, window: int = WINDOW) -> np.ndarray:
    """Per text: its words that lie in a ``window``-word run found twice or more in that text."""
    counts = np.array([len(w) for w in words])
    out, total = np.zeros(len(words), dtype=np.int64), int(counts.sum())
    if total < window + 1:
        return out
    ids = np.fromiter((h for w in words for h in map(hashes.__getitem__, w)), dtype=np.uint64, count=total)
    text = np.repeat(np.arange(len(words)), counts)
    h = mixed(text[:total - window + 1].astype(np.uint64) + np.uint64(1))
    for i in range(window):
        h = mixed(h * np.uint64(0x9E3779B97F4A7C15) + ids[i:total - window + 1 + i])
    inside = text[:total - window + 1] == text[window - 1:]
    ordered = np.sort(h[inside])
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if len(twice):
        at = np.minimum(np.searchsorted(twice, h), len(twice) - 1)
        starts = np.flatnonzero(inside & (twice[at] == h))
        edge = np.zeros(total + 1, dtype=np.int64)
        np.add.at(edge, starts, 1)
        np.add.at(edge, starts + window, -1)
        out += np.bincount(text[np.cumsum(edge[:-1]) > 0], minlength=len(words))
    return out


def text_counts(part: pa.RecordBatch, hashes: Bounded) -> dict[str, np.ndarray]:
    """The base counts of each text, and those that the vector needs besides."""
    data = texts(part)
    size = np.array([len(t) for t in data])
    words = [t.split() for t in data]
    without = lambda chars: size - np.array([len(t.translate(None, chars)) for t in data])
    points = np.array(pc.fill_null(pc.utf8_length(part.column("text")), 0).to_pylist())
    lines = [[x for x in t.split(b"\n") if x.strip(WHITE_SPACE)] for t in data]
    return {"n_words": np.array([len(w) for w in words]), "word_chars": points - without(WHITE_SPACE),
            "n_symbols": without(SYMBOLS), "n_dup_lines": np.array([len(x) - len(set(x)) for x in lines]),
            "n_repeat_words": repeated_words(words, hashes), "n_lines": np.array([len(x) for x in lines]),
            "n_upper": without(UPPER), "n_points": without(POINTS), "n_digits": without(DIGITS)}


def vectors(c: dict[str, np.ndarray]) -> np.ndarray:
    """Transformed statistics, on the integer grid; shares are smoothed, so that short texts are not extreme."""
    share = lambda k, n, more: np.sqrt(c[k] / (c[n] + more))
    x = {"word_length": np.log((c["word_chars"] + 100) / (c["n_words"] + 20)),
         "symbols": share("n_symbols", "word_chars", 100), "dup_lines": share("n_dup_lines", "n_lines", 10),
         "repeats": share("n_repeat_words", "n_words", 40), "upper": share("n_upper", "word_chars", 100),
         "points": share("n_points", "word_chars", 100), "digits": share("n_digits", "word_chars", 100),
         "line_words": np.log((c["n_words"] + 40) / (c["n_lines"] + 4))}
    return np.stack([np.rint(x[k] * GRID).astype(np.int64) for k in NAMES], axis=1)


def text_stats(docs: DataFrame, id_col: str, text_col: str, keys: list[str]) -> DataFrame:
    """Per row: row_no, id, the group keys (as g0, g1, ...), the base counts and the vector (x0, x1, ...)."""
    groups, xs = [f"g{i}" for i in range(len(keys))], [f"x{i}" for i in range(len(NAMES))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = Bounded(xxhash.xxh3_64_intdigest)
        for batch in batches:
            for part in slices(batch):
                counts = text_counts(part, hashes)
                x = vectors(counts)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(k) for k in ("row_no", "id", *groups)), *(pa.array(counts[k], pa.int64()) for k in BASE),
                     *(pa.array(x[:, i], pa.int64()) for i in range(x.shape[1]))],
                    names=["row_no", "id", *groups, *BASE, *xs])

    rows = numbered(docs).select("row_no", F.col(id_col).cast("bigint").alias("id"), *(
        F.col(k).cast("string").alias(g) for k, g in zip(keys, groups)), F.col(text_col).alias("text"))
    schema = ", ".join(["row_no bigint", "id bigint", *(f"{g} string" for g in groups), *(f"{c} bigint" for c in BASE + xs)])
    return rows.mapInArrow(run, schema)


def same_group(left: DataFrame, right: DataFrame, keys: list[str], small: bool = True) -> DataFrame:
    """Null-safe equi-join of a large and a per-group table; ``small`` says that the groups were counted."""
    right = right.withColumnsRenamed({k: f"__{k}" for k in keys})
    on = [left[k].eqNullSafe(right[f"__{k}"]) for k in keys]
    return left.join(F.broadcast(right) if small else right, on).drop(*(f"__{k}" for k in keys))


def bin_quantile(rows: DataFrame, keys: list[str], bin_: Column, share: float, name: str) -> DataFrame:
    """Per group the smallest bin with at least ``share`` of its rows at or below it (one row a bin and group is sorted)."""
    bins = rows.groupBy(*keys, bin_.alias(name)).agg(F.count("*").alias("n"))
    up = Window.partitionBy(*keys).orderBy(name)
    counted = bins.withColumn("up", F.sum("n").over(up)).withColumn("all", F.sum("n").over(Window.partitionBy(*keys)))
    return counted.filter(F.col("up") >= share * F.col("all")).groupBy(*keys).agg(F.min(name).alias(name))


def distance(p: int) -> Column:
    """Squared Mahalanobis distance of the columns x* from ``centre`` by ``precision`` (row by row)."""
    d = [F.col(f"x{i}") / GRID - F.col("centre")[i] for i in range(p)]
    terms = [F.col("precision")[i * p + j] * d[i] * d[j] * (1 if i == j else 2) for i in range(p) for j in range(i, p)]
    total = terms[0]
    for t in terms[1:]:
        total = total + t
    return F.greatest(total, F.lit(0.0))


#: Distances are binned by their logarithm, in steps of under 0.3 %.
def distance_bin(d2: Column) -> Column:
    return F.floor(F.log2(d2 + 1) * 256).cast("int")


def chi_square(share: float, p: int) -> float:
    """Quantile of the chi-square distribution (Wilson and Hilferty's approximation)."""
    from statistics import NormalDist
    return p * (1 - 2 / (9 * p) + NormalDist().inv_cdf(share) * (2 / (9 * p)) ** 0.5) ** 3


def estimates(stats: DataFrame, keys: list[str], backing: DataFrame | None, steps: int, subset: float) -> DataFrame:
    """Per group: centre, covariance, precision (arrays) and factor, by concentration steps from the medians.

    ``backing`` holds such estimates for the first of ``keys``.
    """
    p, spark = len(NAMES), stats.sparkSession
    xs = [f"x{i}" for i in range(p)]
    long_ = stats.select(*keys, F.explode(F.array(*(F.struct(F.lit(i).alias("i"), F.col(c).alias("v")) for i, c in enumerate(xs)))
                                          ).alias("e")).select(*keys, "e.i", "e.v")
    middle = bin_quantile(long_, [*keys, "i"], F.col("v"), 0.5, "m")
    start = store(middle.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("i", "m")))["m"].alias("m0")), "medians")
    small = start.count() <= BROADCAST_ROWS // 10
    floors = np.array(list(FLOORS.values()))
    params = start.select(*keys, "m0", F.transform("m0", lambda v: v / GRID).alias("centre"), F.array(
        *(F.lit(float(1 / floors[i] ** 2) if i == j else 0.0) for i in range(p) for j in range(p))).alias("precision"))
    pairs = [(i, j) for i in range(p) for j in range(i, p)]
    rows = None

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for r in b.to_dict("records"):
                n, m0 = float(r["n"]), np.array(r["m0"], dtype=float) / GRID
                mean = np.array([r[f"s{i}"] for i in range(p)], dtype=float) / GRID / n
                second = np.zeros((p, p))
                for i, j in pairs:
                    second[i, j] = second[j, i] = float(r[f"q{i}_{j}"]) / GRID ** 2 / n
                cov, centre = second - np.outer(mean, mean), m0 + mean
                if r["back_centre"] is not None:
                    w = n / (n + PRIOR)
                    back, far = np.array(r["back_cov"]).reshape(p, p), np.array(r["back_centre"]) - centre
                    cov = w * cov + (1 - w) * back + w * (1 - w) * np.outer(far, far)
                    centre = centre + (1 - w) * far
                inverse = np.linalg.inv(cov + np.diag(floors ** 2))
                out.append({k: r[k] for k in keys} | {"m0": list(r["m0"]), "centre": centre.tolist(),
                                                      "cov": cov.ravel().tolist(), "precision": inverse.ravel().tolist()})
            yield pd.DataFrame(out, columns=[*keys, "m0", "centre", "cov", "precision"])

    types = ", ".join([*(f"{k} string" for k in keys), "m0 array<bigint>", "centre array<double>", "cov array<double>",
                       "precision array<double>"])
    for _ in range(steps):
        rows = same_group(stats.select(*keys, *xs), params, keys, small).withColumn("bin", distance_bin(distance(p)))
        limit = bin_quantile(rows, keys, F.col("bin"), subset, "limit")
        near = same_group(rows, store(limit, "limits"), keys, small).filter(F.col("bin") <= F.col("limit"))
        y = [F.col(c) - F.col("m0")[i] for i, c in enumerate(xs)]
        sums = near.groupBy(*keys).agg(
            F.count("*").alias("n"), F.first("m0").alias("m0"), *(F.sum(y[i]).alias(f"s{i}") for i in range(p)),
            *(F.sum(y[i] * y[j]).alias(f"q{i}_{j}") for i, j in pairs))
        if backing is None:
            sums = sums.withColumns({"back_centre": F.lit(None).cast("array<double>"), "back_cov": F.lit(None).cast("array<double>")})
        else:
            sums = same_group(sums, backing.select(keys[0], F.col("centre").alias("back_centre"),
                                                   F.col("cov").alias("back_cov")), keys[:1], small)
        params = store(sums.mapInPandas(solve, types), "estimates")
    rows = same_group(stats.select(*keys, *xs), params, keys, small).withColumn("bin", distance_bin(distance(p)))
    half = bin_quantile(rows, keys, F.col("bin"), 0.5, "half")
    factor = F.greatest((F.pow(F.lit(2.0), (F.col("half") + 1) / 256) - 1) / chi_square(0.5, p), F.lit(1.0))
    return store(same_group(params, half, keys, small).withColumn("factor", factor).drop("half"), "group_estimates")


def robust_outliers(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keys: tuple[str, str] = ("lang", "source"),
                    steps: int = STEPS, subset: float = SUBSET, cutoff: float = CUTOFF) -> DataFrame:
    """Per row of ``docs`` (a table just read): row_no, id, the base counts, base_failed, distance and kept."""
    stats = store(text_stats(docs, id_col, text_col, list(keys)), "stats")
    groups = [f"g{i}" for i in range(len(keys))]
    language = estimates(stats, groups[:1], None, steps, subset)
    found = estimates(stats, groups, language, steps, subset)
    rows = same_group(stats, found, groups, found.count() <= BROADCAST_ROWS // 10)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    scaled = distance(len(NAMES)) / F.col("factor")
    return rows.select("row_no", "id", *BASE, failed.alias("base_failed"), scaled.alias("distance"),
                       (~failed & (scaled <= chi_square(cutoff, len(NAMES)))).alias("kept"))
