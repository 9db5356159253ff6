"""Blocking and weighted-Jaccard matching of identities.

Input is a *token* table ``(rowkey, attr, value)`` — one row per distinct
value of a set attribute (phone, name, mail, contacts) of a profile. Sets
are never collected into one row, so a profile with a huge contact list or
a phone shared by a third of all profiles stays spread over many tasks.

Pair scoring is exact for ``score >= threshold`` without enumerating every
pair of a block, and no pair is ever exchanged:

* generalized pigeonhole: every attribute gets a bound ``θ_k``; a pair below
  all of them has ``J_k <= p_k``, the largest value under ``θ_k`` that sets of
  the sizes at hand can have. When ``Σ w_k p_k`` is below τ = threshold/100, a
  qualifying pair reaches some ``θ_k``. Of all such bounds those with the
  fewest expected pairs are taken (``_bounds``), so a hot phone block or a hot
  name is no reason to compare two ids where another attribute must agree;
* prefix filtering: a pair with ``J_k >= θ_k`` shares a token among the
  ``n - ceil(θ_k n) + 1`` rarest tokens of each side; frequent tokens sit
  at the end of the order and rarely enter a prefix;
* candidates must share a block value (the join key includes it);
* an id travels with its sets (up to ``ROW_SET`` values an attribute, as 64-bit ids) to each of its prefix
  tokens, so a pair is scored where it meets. It counts only at the first
  block, attribute and token that it shares, hence once. A posting list of
  more than ``tile`` ids is cut into tiles, and two tiles meet in one task:
  the work of a hot list is spread, and memory is bounded by the tile.

Ids with larger sets are never gathered into a row; pairs with such an id are
scored from intersection counts (joins on the token) and set sizes:
``J = |A∩B| / (|A| + |B| - |A∩B|)``. Self-joins stay inner
equi-joins, which AQE's skew handling can split when one key is hot.
"""

from __future__ import annotations

import itertools
import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.similarity import DEFAULT_WEIGHTS
from ..session import checkpoint_dir
from ..sources.scratch import store

EPS = 1e-9
#: Values of one attribute that an id may carry in a row.
ROW_SET = 4096
#: Values held by more ids are ranked by their frequency, the others come before them.
FREQUENT = 256
_HASH_BITS = 57


def tokens_from_columns(df: DataFrame, key: str, columns: dict[str, str], null_token: str | None = "null"
                        ) -> DataFrame:
    """A6 (long form): rows of ``df`` -> distinct (rowkey, attr, value)."""
    parts = [df.select(F.col(key).alias("rowkey"), F.lit(attr).alias("attr"), F.col(col).cast("string").alias("value"))
             for attr, col in columns.items()]
    out = reduce(DataFrame.unionByName, parts)
    out = out.filter(F.col("value").isNotNull() & F.col("rowkey").isNotNull())
    if null_token is not None:
        out = out.filter(F.col("value") != F.lit(null_token))
    return out.distinct()


def block_keys(tokens: DataFrame, block_attr: str = "phone") -> DataFrame:
    """I1 (A7 + N1): (gid, rowkey) for block values held by more than one id.

    ``countDistinct`` per value is a two-level aggregate; the membership is a
    semi-join, so no id list per value is ever built.
    """
    b = tokens.filter(F.col("attr") == block_attr).select(F.col("value").alias("gid"), "rowkey").distinct()
    shared = b.groupBy("gid").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1).select("gid")
    return b.join(shared, on="gid", how="left_semi")


def comparison_records(tokens: DataFrame, blocks: DataFrame) -> DataFrame:
    """I2 (long form): tokens of every blocked id, tagged with its block."""
    return blocks.join(tokens, on="rowkey", how="inner").select("gid", "rowkey", "attr", "value")


def candidate_bounds(threshold: float, weights: dict[str, float], block_attr: str) -> dict[str, float]:
    """Per-attribute Jaccard bounds θ_k with Σ w_k θ_k <= τ (see module doc)."""
    tau = threshold / 100.0
    wb = weights.get(block_attr, 0.0)
    others = {k: w for k, w in weights.items() if k != block_attr}
    if tau > wb and sum(others.values()) > 0:
        theta = (tau - wb) / sum(others.values())
        bounds = {k: theta for k in others}
        bounds[block_attr] = math.inf
    else:
        bounds = {k: max(tau, 0.0) for k in weights}
    return bounds


def _prefix_tokens(tokn: DataFrame, bounds: dict[str, float], max_ranked_set: int = 100_000) -> DataFrame:
    """Tokens inside each set's prefix (rarest first) for candidate attributes.

    ``tokn`` carries the set size ``n`` of (rowkey, attr). Token order is
    global: ascending frequency, then value.
    """
    usable = [k for k, t in bounds.items() if t <= 1.0]
    theta = F.create_map(*[x for k in usable for x in (F.lit(k), F.lit(float(bounds[k])))])
    tok = tokn.filter(F.col("attr").isin(usable)).withColumn("theta", theta[F.col("attr")])
    # Sets above the window bound keep all their tokens: a superset of the
    # prefix is still a valid prefix (more candidates, none lost), and no
    # single task has to rank an unbounded set.
    big = tok.filter(F.col("n") > F.lit(max_ranked_set))
    small = tok.filter(F.col("n") <= F.lit(max_ranked_set))
    freq = small.groupBy("attr", "value").agg(F.count(F.lit(1)).alias("f"))
    ranked = (small.join(freq, on=["attr", "value"])
              .withColumn("pos", F.row_number().over(
                  Window.partitionBy("rowkey", "attr").orderBy("f", "value"))))
    plen = F.col("n") - F.ceil(F.col("theta") * F.col("n") - F.lit(EPS)) + F.lit(1)
    cols = ["rowkey", "attr", "value", "n", "theta"]
    return ranked.filter(F.col("pos") <= plen).select(*cols).unionByName(big.select(*cols))


def _id128(c):
    return F.struct(F.xxhash64(c).alias("h1"), F.xxhash64(F.concat(F.lit("\u0001"), c)).alias("h2"))


def _hot_tokens_cannot_qualify(hot: DataFrame, sizes: DataFrame, weights: dict[str, float], block_attr: str,
                               threshold: float) -> bool:
    """True when no pair can reach the threshold through hot tokens alone.

    A pair sharing only hot tokens of attribute k has J_k <= hot_a / n_a, so
    J_k <= M_k = max over ids of (hot share of the set). Bounds
    θ_k = M_k + ε are a valid pigeonhole allocation whenever
    Σ w_k θ_k <= τ - w_block; then every qualifying pair has J_k >= θ_k for
    some k, which forces a shared rare token — and the rare self-join
    already finds all such pairs. M_k is one small aggregate (a row per
    attribute).
    """
    tau = threshold / 100.0
    wb = weights.get(block_attr, 0.0)
    if tau <= wb:
        return False
    h = hot.select("rowkey", "attr", "value").distinct().groupBy("rowkey", "attr").agg(F.count(F.lit(1)).alias("h"))
    shares = {r["attr"]: r["m"] for r in
              h.join(sizes, on=["rowkey", "attr"]).groupBy("attr").agg(F.max(F.col("h") / F.col("n")).alias("m"))
              .collect()}
    need = sum(w * (shares.get(k, 0.0) + 1e-9) for k, w in weights.items() if k != block_attr)
    return need <= tau - wb - 1e-12


def _self_pairs(df: DataFrame, keys: list[str], extra: list[str] = ()) -> DataFrame:
    """Inner equi self-join on ``keys`` with ``a.rowkey < b.rowkey``, of which one at least has a ``long`` set."""
    a, b = df.alias("a"), df.alias("b")
    cond = [F.col(f"a.{k}") == F.col(f"b.{k}") for k in keys]
    cond += [F.col("a.rowkey") < F.col("b.rowkey"), F.col("a.long") | F.col("b.long")]
    j = a.join(b, reduce(lambda x, y: x & y, cond))
    return j.select(F.col("a.rowkey").alias("ra"), F.col("b.rowkey").alias("rb"),
                    *[F.col(f"a.{c}").alias(c) for c in ("attr", "value")], *extra)


def pair_scores(tokens: DataFrame, threshold: float = 50.0, weights: dict[str, float] | None = None,
                block_attr: str = "phone", hot_postings: int = 256, decimals: int = 6,
                max_ranked_set: int = 100_000, tile: int = 1024) -> DataFrame:
    """I3 + I4: pairs (rowkey_a < rowkey_b) that share a block value and score
    ``100 * Σ w_k J_k >= threshold``. Each pair appears once, however many
    blocks it shares. Exact; see the module doc.

    Ids whose sets have at most ``ROW_SET`` (and ``max_ranked_set``) values are
    scored where they meet (``_pairs_of_rows``), pairs with a larger set by
    joins on the token (``_pair_scores_encoded``, with ``hot_postings``).
    """
    weights = weights or DEFAULT_WEIGHTS
    src = tokens.filter(F.col("attr").isin(list(weights)) & F.col("rowkey").isNotNull()).select("rowkey", "attr", "value").distinct()
    src = store(src, "tokens")  # sizes, frequencies and sets are made from it
    n = F.count(F.lit(1))
    over = src.groupBy("rowkey", "attr").agg(n.alias("n")).filter(F.col("n") > min(ROW_SET, max_ranked_set))
    long = store(over.select("rowkey").distinct(), "long")
    if long.isEmpty():
        return _pairs_of_rows(src, threshold, weights, block_attr, decimals, tile)
    rows = _pairs_of_rows(src.join(long, "rowkey", "left_anti"), threshold, weights, block_attr, decimals, tile)
    # Row keys and values become 128-bit ids (two 64-bit hashes in a struct):
    # joins and shuffles move 16 bytes instead of long text, with no dictionary
    # job. A collision needs two of n keys to agree on 128 bits (about n²/2^129,
    # the same assumption as the md5 row keys of the data model).
    checkpoint_dir(src.sparkSession)
    marked = src.join(long.withColumn("long", F.lit(True)), "rowkey", "left").withColumn("long", F.coalesce("long", F.lit(False)))
    tok = marked.select(_id128(F.col("rowkey")).alias("rowkey"), "attr",
                        _id128(F.concat_ws("\u0000", "attr", "value")).alias("value"), "long")
    keys = src.select("rowkey").distinct().select(_id128(F.col("rowkey")).alias("rid"), "rowkey")
    pairs = _pair_scores_encoded(tok, threshold, weights, block_attr, hot_postings, decimals, max_ranked_set)
    ka = keys.select(F.col("rid").alias("ra"), F.col("rowkey").alias("ka"))
    kb = keys.select(F.col("rid").alias("rb"), F.col("rowkey").alias("kb"))
    dec = pairs.join(ka, "ra").join(kb, "rb")
    return rows.unionByName(dec.select(F.least("ka", "kb").alias("rowkey_a"), F.greatest("ka", "kb").alias("rowkey_b"), "score"))


def _id_sets(src: DataFrame, attrs: list[str]) -> DataFrame:
    """One row an id: (rowkey, one sorted array of value ids for each attribute), rarest values first.

    A value id is its frequency's power of two above 57 bits of a hash of attribute
    and value. That the hash tells all of them apart is checked against a second
    one; if it does not, another seed is taken.
    """
    value = F.concat_ws("\u0000", "attr", "value")
    for seed in itertools.count(1):
        h = F.xxhash64(F.lit(seed), value).bitwiseAND(F.lit((1 << _HASH_BITS) - 1))
        tok = src.select("rowkey", "attr", h.alias("h"), F.xxhash64(value, F.lit(-seed)).alias("again"))
        seen = store(tok.groupBy("h").agg(F.count(F.lit(1)).alias("f"), F.min("again").alias("x"), F.max("again").alias("y"))
                     .filter((F.col("f") > FREQUENT) | (F.col("x") != F.col("y"))), "frequent")
        if seen.filter("x != y").isEmpty():
            break
    frequent = seen.select("h", F.floor(F.log2("f")).cast("bigint").alias("power"))
    ids = tok.drop("again").join(frequent, "h", "left").select("rowkey", "attr", F.shiftleft(
        F.coalesce("power", F.lit(1).cast("bigint")), _HASH_BITS).bitwiseOR(F.col("h")).alias("id"))
    return ids.groupBy("rowkey").agg(*[F.array_sort(F.collect_list(F.when(F.col("attr") == k, F.col("id")))).alias(f"s{i}")
                                       for i, k in enumerate(attrs)])


def _prefix(ids: Column, theta: float) -> Column:
    """The rarest values of a set, one of which it shares with any set that is ``theta`` similar to it."""
    n = F.size(ids)
    return F.slice(ids, 1, F.greatest(F.lit(0), n - F.ceil(F.lit(theta) * n - F.lit(EPS)).cast("int") + F.lit(1)))


def _bounds(sets: DataFrame, weights: list[float], tau: float, margin: float, block: int) -> dict[int, float]:
    """Attribute (by place) -> similarity that a pair must reach in one of them (see the module doc)."""
    ids = [f"s{i}" for i in range(len(weights))]
    sizes = sets.agg(F.count(F.lit(1)).alias("ids"), *[F.sort_array(F.collect_set(F.size(c))).alias(c) for c in ids]).first()
    options: list[list[tuple[float, float]]] = []  # per attribute: (bound, largest similarity below it)
    for c in ids:
        some = [n for n in sizes[c] or [] if n]
        if len(some) <= 4 and max(some, default=0) <= 4:
            found = sorted({i / (a + b - i) for a in some for b in some for i in range(1, min(a, b) + 1)})
            options.append([*zip(found, [0.0, *found]), (math.inf, found[-1] if found else 0.0)])
        else:
            options.append([(1e-9, 0.0), *[(x / 20, x / 20) for x in range(1, 21)], (math.inf, 1.0)])

    def often(v):
        return F.pow(F.lit(2.0), F.shiftright(v, _HASH_BITS))
    # The ids of a block that a value meets: its own number, cut to the block's share of all ids.
    share = often(F.array_max(f"s{block}")) / F.lit(float(sizes["ids"] or 1))

    def price(i):
        return lambda x, v: x + (often(v) if i == block else F.greatest(F.lit(1.0), often(v) * share))
    each = {(i, t): F.sum(F.aggregate(_prefix(F.col(c), t), F.lit(0.0), price(i)))
            for i, c in enumerate(ids) for t, _ in options[i] if t <= 1.0}
    costs = sets.agg(*[e.alias(f"c{n}") for n, e in enumerate(each.values())]).first() if each else []
    cost = {k: x or 0.0 for k, x in zip(each, costs)}
    fit = [some for some in itertools.product(*options) if sum(w * p for w, (_, p) in zip(weights, some)) <= tau - margin]
    if not fit:  # every pair of a block
        return {block: 1e-9}
    best = min(fit, key=lambda some: sum(cost.get((i, t), 0.0) for i, (t, _) in enumerate(some)))
    return {i: t for i, (t, _) in sorted(enumerate(best), key=lambda x: cost.get((x[0], x[1][0]), 0.0)) if t <= 1.0}


def _pairs_of_rows(src: DataFrame, threshold: float, weights: dict[str, float], block_attr: str, decimals: int, tile: int) -> DataFrame:
    """Pairs of ids that carry their sets in a row: each is made and scored in one join, at the first place it shares."""
    attrs = list(weights)
    none = src.select(F.col("rowkey").alias("rowkey_a"), F.col("rowkey").alias("rowkey_b"), F.lit(0.0).alias("score")).filter("false")
    if block_attr not in attrs:
        return none
    block = attrs.index(block_attr)
    sets = store(_id_sets(src, attrs).filter(F.size(f"s{block}") > 0), "sets")
    bounds = _bounds(sets, list(weights.values()), threshold / 100.0, 2 * 10.0 ** -(decimals + 2), block)
    if not bounds:
        return none
    ids = [f"s{i}" for i in range(len(attrs))]
    last, theta = [*bounds.items()][-1]

    def of(i):
        return lambda x: F.named_struct(F.lit("last"), F.lit(i == last), F.lit("token"), x)
    # The places of an id: its blocks, and in each the prefix tokens of all attributes in one order. ``seen`` and ``met``
    # are those before a place: a pair counts at a place that both have if nothing before it is shared, hence once.
    places = F.concat(*[F.transform(_prefix(F.col(f"s{i}"), t), of(i)) for i, t in bounds.items()])
    rest = F.lit(0)
    for i in bounds:
        rest = rest + (F.size(_prefix(F.col(f"s{i}"), bounds[i])) if i != last else F.lit(0))
    at = sets.select("rowkey", *ids, places.alias("places"), rest.alias("first"), F.posexplode(f"s{block}").alias("bpos", "gid"))
    at = at.select("rowkey", *ids, "gid", "bpos", "places", "first", F.posexplode("places").alias("pos", "p")).select(
        "rowkey", *ids, "gid", F.slice(f"s{block}", 1, F.col("bpos")).alias("seen"), "p.token",
        F.slice(F.col("places.token"), 1, F.col("pos")).alias("met"),
        # In the last attribute a pair must reach its bound: its set's size, and what is left of the set behind the token.
        F.when(F.col("p.last"), F.size(f"s{last}")).otherwise(0).alias("n"),
        F.when(F.col("p.last"), F.size(f"s{last}") - 1 - (F.col("pos") - F.col("first"))).otherwise(0).alias("left"))
    key = ["gid", "token"]
    large = store(at.groupBy(*key).agg(F.count(F.lit(1)).alias("f")).filter(F.col("f") > tile)
                  .select(*key, F.ceil(F.col("f") / F.lit(tile)).cast("int").alias("tiles")), "large")  # at most a row for ``tile``
    mine = at.join(large, key, "left").withColumn("tiles", F.coalesce("tiles", F.lit(1))).withColumn(
        "mine", F.pmod(F.xxhash64("rowkey"), F.col("tiles")).cast("int"))
    tiled = mine.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))).select(
        "rowkey", *ids, *key, "seen", "met", "n", "left", "mine", F.least("mine", "other").alias("low"),
        F.greatest("mine", "other").alias("high"))
    a, b = tiled.alias("a"), tiled.alias("b")

    def two(name):
        return F.col(f"a.{name}"), F.col(f"b.{name}")
    same = reduce(Column.__and__, [two(k)[0] == two(k)[1] for k in [*key, "low", "high"]])
    once = F.when(F.col("a.low") == F.col("a.high"), F.col("a.rowkey") < F.col("b.rowkey")).otherwise(
        (F.col("a.mine") == F.col("a.low")) & (F.col("b.mine") == F.col("b.high")))
    n, left = two("n"), two("left")
    may = ((F.lit(theta) * F.greatest(*n) <= F.least(*n) + F.lit(EPS))
           & (F.lit(theta / (1.0 + theta)) * (n[0] + n[1]) <= F.least(*left) + F.lit(1 + EPS)))
    total = F.lit(0.0)
    for i, w in enumerate(weights.values()):
        x, y = two(f"s{i}")
        both = F.size(F.array_intersect(x, y))
        total = total + F.lit(float(w) * 100.0) * F.coalesce(F.try_divide(both, F.size(x) + F.size(y) - both), F.lit(0.0))
    met = a.join(b, same & once & may & ~F.arrays_overlap(*two("met")) & ~F.arrays_overlap(*two("seen")))
    # Exploded, the score is worked out once, not for the filter and again for the result.
    return met.select(F.least(*two("rowkey")).alias("rowkey_a"), F.greatest(*two("rowkey")).alias("rowkey_b"), F.explode(
        F.array(F.round(total, decimals))).alias("score")).filter(F.col("score") >= F.lit(float(threshold)))


def _pair_scores_encoded(tok: DataFrame, threshold: float, weights: dict[str, float], block_attr: str,
                         hot_postings: int, decimals: int, max_ranked_set: int = 100_000) -> DataFrame:
    """Pairs of which one at least is ``long`` (a column of ``tok``), from joins on the token.

    * rare tokens — a (block, attr, value) posting list of at most
      ``hot_postings`` ids — are self-joined inside their block: this
      enumerates the pairs sharing them and their shared values at once,
      at a cost bounded by ``hot_postings`` times the token rows;
    * hot tokens are never self-joined unless they sit in a prefix
      (candidate bound); their share in each candidate pair's intersection
      is found by a membership join from the candidate, not by expanding
      the hot posting list;
    * the blocking attribute, when it cannot qualify a pair by itself, is
      only looked up for candidates (it is always "hot" in a big block).
    """
    sizes = tok.groupBy("rowkey", "attr").agg(F.count(F.lit(1)).alias("n"))
    # Every token carries its set size; this table feeds four branches, so it
    # is written once (checkpoint) rather than re-joined in each.
    tokn = tok.join(sizes, on=["rowkey", "attr"]).checkpoint()
    blocks = block_keys(tok, block_attr)
    bounds = candidate_bounds(threshold, weights, block_attr)
    cand_attrs = [k for k, t in bounds.items() if t <= 1.0]

    tb = tokn.filter(F.col("attr").isin(cand_attrs)).join(blocks, on="rowkey", how="inner")
    post = tb.groupBy("gid", "attr", "value").agg(F.count(F.lit(1)).alias("f"))
    tbf = tb.join(post, on=["gid", "attr", "value"], how="inner").checkpoint()   # feeds four branches
    cols = ["gid", "rowkey", "attr", "value", "n", "long"]
    rare = tbf.filter(F.col("f") <= hot_postings).select(*cols)
    hot = tbf.filter(F.col("f") > hot_postings).select(*cols)
    sizes_ab = [F.col("a.n").alias("na"), F.col("b.n").alias("nb")]

    # Pairs sharing rare tokens, with the shared values (exact, bounded cost).
    shared_rare = _self_pairs(rare, ["gid", "attr", "value"], sizes_ab)
    if _hot_tokens_cannot_qualify(hot, sizes, weights, block_attr, threshold):
        # Every qualifying pair shares a rare token: no hot token is self-joined.
        cand = shared_rare.select("ra", "rb").distinct()
    else:
        # Pairs that may qualify only through a hot token: hot tokens in a prefix.
        pre = _prefix_tokens(tokn, bounds, max_ranked_set).select("rowkey", "attr", "value", "theta")
        hot_pre = hot.join(pre, on=["rowkey", "attr", "value"], how="inner")
        hot_cand = (_self_pairs(hot_pre, ["gid", "attr", "value"], [F.col("a.theta").alias("theta"), *sizes_ab])
                    .filter(F.col("theta") * F.greatest("na", "nb") <= F.least("na", "nb") + F.lit(EPS))
                    .select("ra", "rb"))
        cand = shared_rare.select("ra", "rb").unionByName(hot_cand).distinct()

    # Shared values through hot tokens and the blocking attribute: membership.
    lookup = (hot.select("rowkey", "attr", "value", "n")
              .unionByName(tokn.filter(~F.col("attr").isin(cand_attrs)).select("rowkey", "attr", "value", "n"))
              .distinct())
    ta = lookup.select(F.col("rowkey").alias("ra"), "attr", "value", F.col("n").alias("na"))
    tbk = tokn.select(F.col("rowkey").alias("rb"), "attr", "value", F.col("n").alias("nb"))
    shared_other = cand.join(ta, on="ra").join(tbk, on=["rb", "attr", "value"])
    shared = shared_rare.unionByName(shared_other.select("ra", "rb", "attr", "value", "na", "nb"))
    # A value can be reached twice (two shared blocks, or rare in one and hot
    # in another), so values are de-duplicated per pair. One shuffle on the
    # pair serves the de-duplication and both aggregations after it.
    inter = (shared.repartition("ra", "rb").dropDuplicates(["ra", "rb", "attr", "value"])
             .groupBy("ra", "rb", "attr")
             .agg(F.count(F.lit(1)).alias("i"), F.first("na").alias("na"), F.first("nb").alias("nb")))
    return _score_inter(inter, weights, block_attr, threshold, decimals)


def score_pairs(cand: DataFrame, tok: DataFrame, sizes: DataFrame, weights: dict[str, float],
                block_attr: str, threshold: float | None, decimals: int = 6) -> DataFrame:
    """Exact weighted Jaccard of given candidate pairs (ra, rb) by membership
    joins (use when the candidate list is small)."""
    ta = tok.select(F.col("rowkey").alias("ra"), "attr", "value")
    tb = tok.select(F.col("rowkey").alias("rb"), "attr", "value")
    inter = (cand.join(ta, on="ra").join(tb, on=["rb", "attr", "value"])
             .groupBy("ra", "rb", "attr").agg(F.count(F.lit(1)).alias("i")))
    out = _score(inter, sizes, weights, block_attr, threshold, decimals)
    return out.select(F.col("ra").alias("rowkey_a"), F.col("rb").alias("rowkey_b"), "score")


def _score(inter: DataFrame, sizes: DataFrame, weights: dict[str, float], block_attr: str,
           threshold: float | None, decimals: int) -> DataFrame:
    sa = sizes.select(F.col("rowkey").alias("ra"), "attr", F.col("n").alias("na"))
    sb = sizes.select(F.col("rowkey").alias("rb"), "attr", F.col("n").alias("nb"))
    return _score_inter(inter.join(sa, on=["ra", "attr"]).join(sb, on=["rb", "attr"]),
                        weights, block_attr, threshold, decimals)


def _score_inter(inter: DataFrame, weights: dict[str, float], block_attr: str,
                 threshold: float | None, decimals: int) -> DataFrame:
    """(ra, rb, attr, i, na, nb) -> (ra, rb, score) for qualifying blocked pairs."""
    w = F.create_map(*[x for k, v in weights.items() for x in (F.lit(k), F.lit(float(v) * 100.0))])
    per = inter.withColumn("part", w[F.col("attr")] * F.col("i") / (F.col("na") + F.col("nb") - F.col("i")))
    scored = per.groupBy("ra", "rb").agg(
        F.round(F.sum("part"), decimals).alias("score"),
        F.max((F.col("attr") == F.lit(block_attr)).cast("int")).alias("blocked"))
    out = scored.filter(F.col("blocked") == 1)
    if threshold is not None:
        out = out.filter(F.col("score") >= F.lit(float(threshold)))
    return out.select("ra", "rb", "score")


def links_from_pairs(pairs: DataFrame) -> DataFrame:
    """Turn matched pairs into link rows (the smaller id is canonical)."""
    return pairs.select(F.col("rowkey_b").alias("org_id"), F.col("rowkey_a").alias("connect_id"))
