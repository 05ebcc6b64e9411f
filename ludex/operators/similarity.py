"""Item-item similarity: co-rating pair sums, cosine, damped centred cosine
("Pearson"), full-vector cosine, and top-k neighbours.

Plan shape (for every similarity):

1. pre-aggregate the rows per (user, item): n, sum, sum of squares. Repeated
   ratings of one item by one user are combined before any shuffle, so the
   pair step works on distinct (user, item) cells.
2. self-join the cells on user with ``i1 < i2`` (half the pairs) and turn
   each match into the three products that the pair sums need. The products
   of repeated rows are exact: sum over row pairs of x*y = S1*S2, of x*x =
   Q1*N2, of y*y = N1*Q2.
3. group by (i1, i2) and sum, in one of two ways (``summed_pairs``):
   * Items that are dense (many more pairs than items): Spark runs the partial
     aggregate inside the join's stage, so matched pairs are summed in the task
     that makes them and only one partial row per (task, pair) is shuffled.
   * All others, whose pairs hardly repeat, so that partial sums would be as
     many as pairs: not the pairs are shuffled but each cell with the list of
     its user's items, by i1. Pairs are made after that shuffle and summed where
     they are made; a list is packed (see ``pairlists``) and holds some bytes per item.
4. emit both orders of each pair in one pass (an explode, no second
   evaluation of the sums).

Hot users. A user with m items makes m^2/2 pairs. Each user's cells are cut
into slices of about half of PAIR_SLICE_ITEMS items by a hash of the item, and
the join key is (user, left slice, right slice): the left side is repeated for
every right slice of its user and the other way round, so no key holds more
than PAIR_SLICE_ITEMS items on either side, nor more than PAIR_SLICE_ITEMS^2
pairs, whatever the user. Users of one slice are not repeated. Both sides are
hash-partitioned by number on that key, so the expanding join keeps its
parallelism even when its input is small.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from ludex.functions.columns import rank_key, safe_div
from ludex.operators import pairlists
from ludex.operators.indexing import dense_index
from ludex.session import drop_tables, shuffle_partitions, stage_table, staged_paths

# Fixed value: damping added to the denominator of the centred similarity.
DAMPING = 0.5
# Number of neighbours kept per item.
TOP_K = 5
# Decimal places similarities and scores are rounded to before ranking, so
# that sums taken in another order rank the same.
RANK_DIGITS = 9
# Largest number of a user's items on either side of one key of the pair join
# (see "Hot users" above).
PAIR_SLICE_ITEMS = 2048


# An item with more pair rows than this is summed partially before the shuffle,
# as its pairs by one key would be one task's work (see summed_pairs).
ITEM_PAIR_ROWS = 1 << 21
# Pair rows that are summed at once behind the shuffle of lists.
TASK_PAIR_ROWS = 1 << 21

# Share of a user's items up to which pairs are made first (see top_k_bounded).
HUB_SHARE = 1 / 16


def cells(rows: DataFrame, value: str) -> DataFrame:
    """Per (user, item): n rows, sum and sum of squares of ``value``."""
    v = F.col(value).cast("double")
    return rows.groupBy("user_id", "item").agg(
        F.count(F.lit(1)).alias("n"), F.sum(v).alias("s"), F.sum(v * v).alias("q"))


def _sliced(c: DataFrame, slice_items: int, centre: bool = False) -> DataFrame:
    """The per-user table ``c`` with ``_m`` (items of the user) and ``_k`` (slices
    they are cut into); ``centre``: see ``salted_self_join``. Eager."""
    c = stage_table(c, "cells")
    stats = [F.count(F.lit(1)).alias("_m")]
    if centre:
        stats.append((F.sum("s") / F.sum("n")).alias("_mu"))
    per_user = stage_table(c.groupBy("user_id").agg(*stats), "users")
    cs = c.join(per_user, "user_id", "inner").withColumn(
        "_k", F.when(F.col("_m") <= slice_items, 1)
        .otherwise(F.ceil(F.lit(2) * F.col("_m") / F.lit(slice_items))).cast("int"))
    if centre:
        n, s, q, mu = (F.col(x) for x in ("n", "s", "q", "_mu"))
        cs = cs.withColumns({"s": s - n * mu, "q": q - F.lit(2.0) * mu * s + n * mu * mu})
    return cs


def _sides(cs: DataFrame, left: list, right: list,
           keep: tuple = (None, None)) -> tuple[DataFrame, DataFrame]:
    """Both sides of the join of a ``_sliced`` table with itself, partitioned by
    number on its key (user_id, _a, _b)."""
    parts = shuffle_partitions(cs.sparkSession)
    own = F.pmod(F.xxhash64("item"), F.col("_k")).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.col("_k") - F.lit(1)))
    ls, rs = (cs if k is None else cs.where(k) for k in keep)
    return (ls.select("user_id", *left, own.alias("_a"), every.alias("_b"))
              .repartition(parts, "user_id", "_a", "_b"),
            rs.select("user_id", *right, own.alias("_b"), every.alias("_a"))
              .repartition(parts, "user_id", "_a", "_b"))


def salted_self_join(c: DataFrame, left: list, right: list,
                     slice_items: int = PAIR_SLICE_ITEMS, centre: bool = False,
                     keep: tuple = (None, None)) -> DataFrame:
    """Join the per-user table ``c`` (user_id, item, ...) with itself on the
    user, by pairs of slices (columns _a, _b); ``left`` / ``right`` are the
    column expressions kept per side. ``centre`` turns the sums of ``cells``
    into sums of deviations from the user's mean, which comes from the same
    per-user table, so a user's rows meet in no aggregate by user alone.
    ``keep`` are conditions on the rows of either side.

    Eager: the cells and the table per user are written, so that AQE can split
    the rows of a hot user where the two are joined."""
    a, b = _sides(_sliced(c, slice_items, centre), left, right, keep)
    return a.join(b, ["user_id", "_a", "_b"], "inner")


def _pair_totals() -> list:
    """The sums of a pair, from its sides' n, s, q (``left_side``, ``right_side``)."""
    return [F.sum(F.col("q1") * F.col("n2")).alias("sx"), F.sum(F.col("n1") * F.col("q2")).alias("sy"),
            F.sum(F.col("s1") * F.col("s2")).alias("sxy"), F.count(F.lit(1)).alias("n_users")]


def _side(x: int) -> list:
    return [F.col("item").alias(f"i{x}"), *[F.col(c).alias(f"{c}{x}") for c in ("n", "s", "q")]]


_FACTS = ("total", "number", "_m")


def _facts() -> list[Column]:
    """Of a user: sum and number of ratings, cells."""
    return [F.sum("s").alias("total"), F.sum("n").alias("number"), F.count(F.lit(1)).alias("_m")]


def _heavy_users(c: DataFrame, slice_items: int) -> DataFrame:
    """The users of ``c`` with more than ``slice_items`` cells, written."""
    return stage_table(c.where("user_id is not null").groupBy("user_id").agg(*_facts())
                       .where(F.col("_m") > slice_items), "heavy")


def _user_lists(c: DataFrame, cell: Column, slice_items: int, heavy: DataFrame,
                keep: str | None = None) -> DataFrame:
    """Cells of a user as lists, for ``pairlists.send``: left, right (NULL: the same
    cells), the user's ``total`` and ``number``; of ``_heavy_users`` all pairs of
    slices. With ``keep`` (a field of ``cell``) only lists with such a left cell. Lists
    are written."""
    parts = shuffle_partitions(c.sparkSession)
    known = c.where("user_id is not null")
    listed = F.collect_list(F.when(F.col("item").isNotNull(), cell)).alias("left")

    def used(lists: DataFrame) -> DataFrame:
        return lists.where(F.exists("left", lambda x: x[keep])) if keep else lists

    none = heavy.isEmpty()
    light = known if none else known.join(heavy.select("user_id"), "user_id", "left_anti")
    few = stage_table(used(light.groupBy("user_id").agg(*_facts(), listed)), "lists")
    few = few.select("left", F.lit(None).cast(few.schema["left"].dataType).alias("right"), *_FACTS[:2])
    cut = heavy.withColumn("_k", F.ceil(F.lit(2) * F.col("_m") / F.lit(slice_items)).cast("int"))
    own = F.pmod(F.xxhash64("item"), F.col("_k")).cast("int")
    slices = stage_table(
        known.where(F.lit(False) if none else F.col("item").isNotNull())
        .join(cut, "user_id").withColumn("_a", own)
        .repartition(parts, "user_id", "_a").groupBy("user_id", "_a")
        .agg(*[F.first(x).alias(x) for x in ("total", "number", "_k")], listed), "lists")
    every = F.explode(F.sequence(F.lit(0), F.col("_k") - F.lit(1)))
    a = (used(slices).select("user_id", "_a", "left", "total", "number", every.alias("_b"))
         .repartition(parts, "user_id", "_a", "_b"))
    b = (slices.select("user_id", F.col("_a").alias("_b"), F.col("left").alias("right"), every.alias("_a"))
         .repartition(parts, "user_id", "_a", "_b"))
    return few.unionByName(a.join(b, ["user_id", "_a", "_b"]).select(*few.columns))


def _coded_pairs(c: DataFrame, centre: bool, only: str, keep: Column | None, **limits) -> DataFrame:
    """``summed_pairs`` of items that are no whole numbers: by codes in their order."""
    codes = dense_index(c, "item", "_code")
    held = c.join(codes, "item", "left").withColumnRenamed("item", "_item").withColumn("item", F.col("_code"))
    if only in ("near", "far"):
        held = held.drop("_code").join(codes.select(F.col("item").alias("top"), "_code"), "top", "left")
        held = held.withColumn("top", F.col("_code"))
    out = summed_pairs(held.drop("_code", "_item"), centre, only, keep, **limits)
    for x in ("i1", "i2"):
        out = out.join(codes.select(F.col("_code").alias(x), F.col("item").alias(f"_{x}")), x)
    sums = ("sx", "sy", "sxy", "n_users")
    return out.select(F.col("_i1").alias("i1"), F.col("_i2").alias("i2"), *sums)


@dataclass
class PairLists:
    """What ``summed_pairs`` reads (see ``pair_lists``)."""

    lists: DataFrame
    cells: DataFrame  # with _kept and _dense
    dense: bool       # some items are dense
    listed: bool      # some items are not
    total: int        # at least the pairs of the lists, both orders
    low: int


def pair_lists(c: DataFrame, tops: bool = False, keep: Column | None = None,
               slice_items: int = PAIR_SLICE_ITEMS, item_rows: int = ITEM_PAIR_ROWS,
               heavy: DataFrame | None = None) -> PairLists:
    """The cells ``c`` for ``summed_pairs``; ``tops``: with the column ``top``. ``heavy``
    are the ``_heavy_users`` if they are known. Eager: cells and lists are written;
    of the tables on the way only those that are read later stay."""
    spark = c.sparkSession
    kept = F.lit(True) if keep is None else F.coalesce(keep, F.lit(False))
    with staged_paths() as paths:
        held = stage_table(c.withColumn("_kept", kept), "cells")
        many = _heavy_users(held, slice_items) if heavy is None else heavy

        def lists_of(cells: DataFrame, kept: Column) -> DataFrame:
            cell = F.struct(F.col("item").cast("bigint").alias("item"), "n", "s", "q", kept.alias("kept"),
                            *([F.col("top").cast("bigint").alias("top")] if tops else []))
            return _user_lists(cells, cell, slice_items, many, "kept")

        lists = lists_of(held, F.col("_kept"))
        load = stage_table(lists.select(
            F.explode(F.filter("left", lambda x: x["kept"])["item"]).alias("item"),
            F.size(F.coalesce("right", "left")).alias("_m"))
            .groupBy("item").agg(F.sum("_m").alias("_load")), "load")
        n_items, total, low = load.agg(F.count(F.lit(1)), F.coalesce(F.sum("_load"), F.lit(0)),
                                       F.min("item")).first()
        most = min(item_rows, n_items * shuffle_partitions(spark))
        # Sums leave out NULLs, which lists of numbers don't hold.
        if not held.where("s is null or q is null").isEmpty():
            most = -1
        dense = load.where(F.col("_load") > most).select("item", F.lit(True).alias("_dense"))
        any_dense = not dense.isEmpty()
        if any_dense:
            held = stage_table(held.join(dense, "item", "left")
                               .withColumn("_dense", F.col("_dense").isNotNull()), "cells")
            if most >= 0:
                lists = lists_of(held, F.col("_kept") & ~F.col("_dense"))
    if not any_dense:
        drop_tables(spark, [x for x in paths if "/lists-" not in x])
    return PairLists(lists, held, any_dense, most >= 0 or not any_dense, total, low or 0)


def summed_pairs(c: DataFrame, centre: bool = False, only: str = "half",
                 keep: Column | None = None, slice_items: int = PAIR_SLICE_ITEMS,
                 item_rows: int = ITEM_PAIR_ROWS, task_rows: int = TASK_PAIR_ROWS,
                 best: tuple | None = None, lists: PairLists | None = None) -> DataFrame:
    """(i1, i2, sx, sy, sxy, n_users) of the pairs of different items that a user
    has both, summed over the users. ``c`` comes from ``cells``, ``centre`` is that
    of ``salted_self_join``, ``keep`` a condition on i1's rows. ``only``: 'all'
    pairs, the 'half' with i1 < i2, or the 'near' or 'far' ones, whose i2 is at
    most or above the column ``top`` of i1's row (NULL: all are near). With ``best``
    (kind, k) pairs that are not among i1's k most similar ones (those that ``top_k``
    keeps of 'cosine' or 'pearson') may be left out. ``lists`` are the ``pair_lists``
    of ``c`` and ``keep``, if they are made already.

    An item's pair rows are at most the items of its users, summed. Where they
    exceed the items there are, once per map task, partial sums are fewer rows
    than pairs: such items, and those with over ``item_rows`` of them, are joined
    and summed by (i1, i2) with a shuffle. Of the others each cell goes to the
    bucket of its item with the list of its user's items, packed (``pairlists``);
    about ``task_rows`` pairs of a bucket are summed where they are unpacked. Eager
    (``pair_lists``)."""
    spark, kind = c.sparkSession, c.schema["item"].dataType
    if not isinstance(kind, IntegralType):
        return _coded_pairs(c, centre, only, keep, slice_items=slice_items, item_rows=item_rows,
                            task_rows=task_rows)
    tops = only in ("near", "far")
    made = lists or pair_lists(c, tops, keep, slice_items, item_rows)
    buckets = max(shuffle_partitions(spark),
                  math.ceil(made.total / (2 if only == "half" else 1) / task_rows))
    ranking = best and (best[0], DAMPING, RANK_DIGITS, best[1])
    sent = (made.lists.mapInArrow(pairlists.send(only, buckets, made.low, centre), pairlists.SENT)
            .repartition(max(shuffle_partitions(spark), math.ceil(buckets / 16)), "bucket")
            .sortWithinPartitions("bucket"))
    pairs = (sent.mapInArrow(pairlists.receive(only, made.low, centre, ranking), pairlists.SUMS)
             .select("i1", F.explode("pairs").alias("_p")))
    out = pairs.select(F.col("i1").cast(kind).alias("i1"), F.col("_p.i2").cast(kind).alias("i2"),
                       *[F.col(f"_p.{x}").alias(x) for x in ("sx", "sy", "sxy", "n_users")])
    if not made.dense:
        return out
    left = [*_side(1), *([F.col("top")] if tops else [])]
    a, b = _sides(_sliced(made.cells, slice_items, centre).where("item is not null"), left, _side(2),
                  (F.col("_kept") & F.col("_dense"), None))
    i1, i2 = F.col("i1"), F.col("i2")
    wanted = i2 > i1 if only == "half" else i2 != i1
    if tops:
        near = F.col("top").isNull() | (i2 <= F.col("top"))
        wanted &= near if only == "near" else ~near
    sums = (a.join(b, ["user_id", "_a", "_b"]).where(wanted)
            .groupBy("i1", "i2").agg(*_pair_totals()))
    return out.unionByName(sums) if made.listed else sums


def pair_rows(c: DataFrame, slice_items: int = PAIR_SLICE_ITEMS,
              centre: bool = False) -> DataFrame:
    """One row per (user, i1 < i2) co-rating, with its contributions
    ``xx, yy, xy`` to the pair sums. ``c`` comes from ``cells``."""
    left = [F.col("item").alias("i1"), F.col("n").alias("n1"),
            F.col("s").alias("s1"), F.col("q").alias("q1")]
    right = [F.col("item").alias("i2"), F.col("n").alias("n2"),
             F.col("s").alias("s2"), F.col("q").alias("q2")]
    j = salted_self_join(c, left, right, slice_items, centre).filter(F.col("i1") < F.col("i2"))
    return j.select("user_id", "i1", "i2",
                    (F.col("q1") * F.col("n2")).alias("xx"),
                    (F.col("n1") * F.col("q2")).alias("yy"),
                    (F.col("s1") * F.col("s2")).alias("xy"))


def pair_sums(rows: DataFrame, value: str, centre: bool = False) -> DataFrame:
    """(i1 < i2, sx, sy, sxy, n_users): sums over the users who rated both, of
    ``value`` or (``centre``) of its deviation from the user's mean."""
    return summed_pairs(cells(rows, value), centre)


def mirror(half: DataFrame, swap: dict[str, str] | None = None) -> DataFrame:
    """Both orders of each pair: (i1, i2) and (i2, i1); columns in ``swap``
    are exchanged in the second copy. One pass: each row explodes into its
    two orders, so the half is evaluated once."""
    swap = swap or {}
    cols = [c for c in half.columns if c not in ("i1", "i2")]
    fwd = F.struct(F.col("i1").alias("i1"), F.col("i2").alias("i2"),
                   *[F.col(c).alias(c) for c in cols])
    rev = F.struct(F.col("i2").alias("i1"), F.col("i1").alias("i2"),
                   *[F.col(swap.get(c, c)).alias(c) for c in cols])
    return half.select(F.explode(F.array(fwd, rev)).alias("_p")).select("_p.*")


def cosine_from_sums(sx, sy, sxy) -> F.Column:
    """sxy / (sqrt(sx) * sqrt(sy)); 0 when a norm is 0."""
    return F.coalesce(safe_div(sxy, F.sqrt(sx) * F.sqrt(sy)), F.lit(0.0))


def damped_from_sums(sx, sy, sxy, damping: float = DAMPING) -> F.Column:
    """sxy / (sqrt(sx) * sqrt(sy) + damping); 0 when undefined."""
    return F.coalesce(safe_div(sxy, F.sqrt(sx) * F.sqrt(sy) + F.lit(damping)), F.lit(0.0))


def co_rated_cosine(ratings: DataFrame, value: str = "rating") -> DataFrame:
    """Cosine over co-rating users, both orders: (i1, i2, sx, sy, sxy, similarity)."""
    s = pair_sums(ratings, value)
    both = mirror(s, {"sx": "sy", "sy": "sx"})
    return both.withColumn("similarity", cosine_from_sums(F.col("sx"), F.col("sy"), F.col("sxy")))


def damped_pearson(ratings: DataFrame | None, mode: str = "intended",
                   damping: float = DAMPING, sums: DataFrame | None = None) -> DataFrame:
    """Damped cosine of user-centred ratings (the deviation of ``rating`` from
    the user's mean).

    mode 'intended': x = deviation on i1, y = deviation on i2 (symmetric).
    mode 'faithful': x = y = deviation on i1, as when the left deviation is
    selected twice; then similarity(i1 -> i2) = sx / (sx + damping) with sx
    over the users who also rated i2, which is not symmetric.
    ``sums`` (from ``pair_sums(ratings, 'rating', centre=True)``) lets several
    modes share one pair computation.
    """
    s = sums if sums is not None else pair_sums(ratings, "rating", centre=True)
    # Both orders; i2 -> i1 takes i2's own squares (sy) as its sx.
    both = mirror(s, {"sx": "sy", "sy": "sx"})
    if mode == "intended":
        sim = damped_from_sums(F.col("sx"), F.col("sy"), F.col("sxy"), damping)
    elif mode == "faithful":
        sim = damped_from_sums(F.col("sx"), F.col("sx"), F.col("sx"), damping)
    else:
        raise ValueError(mode)
    # Rounding noise of centred sums is no similarity.
    return both.withColumn("similarity", F.when(F.abs(sim) < F.lit(1e-12), F.lit(0.0))
                           .otherwise(sim))


def top_k(sims: DataFrame, k: int = TOP_K, digits: int | None = RANK_DIGITS) -> DataFrame:
    """k most similar neighbours per item: similarity desc, neighbour id asc.

    ``row_number() <= k`` is planned as a WindowGroupLimit before the
    shuffle, so each map task forwards at most k rows per item.
    """
    key = rank_key(F.col("similarity"), digits) if digits is not None else F.col("similarity")
    w = Window.partitionBy("i1").orderBy(key.desc(), F.col("i2").asc())
    return (sims.withColumn("rank", F.row_number().over(w))
                .filter(F.col("rank") <= F.lit(k))
                .withColumn("rank", F.col("rank").cast("bigint")))


@dataclass
class Hubs:
    """Cells with their items' tops, for ``top_k_bounded`` of any kind."""

    cells: DataFrame
    tops: DataFrame
    heavy: DataFrame
    lists: PairLists


def hubs_of(ratings: DataFrame, k: int = TOP_K, share: float = HUB_SHARE) -> Hubs:
    """Step 1 of ``top_k_bounded`` up to the lists of cells. Eager."""
    held = stage_table(cells(ratings, "rating"), "cells")
    heavy = _heavy_users(held, PAIR_SLICE_ITEMS)
    # Of a user in slices each slice has a limit of its own: any top would be right.
    with staged_paths() as paths:
        order = F.sort_array(F.col("left.item"))
        at = F.greatest(F.lit(k), F.ceil(F.lit(share) * F.size("left")).cast("int") - F.lit(1))
        limits = (_user_lists(held, F.struct("item"), PAIR_SLICE_ITEMS, heavy)
                  .where(F.size("left") > k).select(order.alias("items"), F.get(order, at).alias("limit")))
        tops = stage_table(limits.select(F.explode("items").alias("item"), "limit")
                           .groupBy("item").agg(F.min("limit").alias("top")), "tops")
    drop_tables(held.sparkSession, [x for x in paths if "/tops-" not in x])
    lists = pair_lists(held.join(tops, "item", "left"), True, heavy=heavy)
    return Hubs(held, tops, heavy, lists)


def top_k_bounded(ratings: DataFrame, kind: str = "cosine", k: int = TOP_K,
                  share: float = HUB_SHARE, hubs: Hubs | None = None) -> DataFrame:
    """``top_k`` of ``co_rated_cosine`` (``kind`` 'cosine') or of the intended
    ``damped_pearson`` ('pearson'), without summing pairs that cannot enter it.

    1. Every item has a top: the least, over its users with more than k items, of
       a user's item number k + 1 or about at ``share`` of its items, whichever is
       further by id (no top if there is no such user). The
       pairs of the item with all items up to its top are summed, whichever
       users they share; the k-th best is a lower bound of its k-th similarity.
    2. No similarity of an item exceeds its bound: 1 for the cosine, for the
       damped one p / (p + damping) with p the root of its whole squared norm
       times the largest one. An item whose bound is below its k-th best, or
       equal to it (ties go to the least id, and those up to the top have the
       least), is closed: no other item can enter its list.
    3. Of the other pairs, only those of items that are not closed are made. Where
       nothing closes, the lists of step 1 are read again.

    A top depends on the item's own users only, so the share of items that close
    does not fall when tables grow by other users and items. Columns i1, i2,
    similarity, rank. ``hubs`` are those of the same ratings, k and share, which
    serve both kinds. Eager: cells, the first sums and the items that are not
    closed are written."""
    if kind not in ("cosine", "pearson"):
        raise ValueError(kind)
    centre = kind == "pearson"
    value = cosine_from_sums if kind == "cosine" else damped_from_sums
    hubs = hubs or hubs_of(ratings, k, share)
    held, tops = hubs.cells, hubs.tops

    def similar(c: DataFrame, only: str, keep: Column | None, lists: PairLists) -> DataFrame:
        sim = value(F.col("sx"), F.col("sy"), F.col("sxy"))
        if centre:  # rounding noise of centred sums is no similarity
            sim = F.when(F.abs(sim) < F.lit(1e-12), F.lit(0.0)).otherwise(sim)
        return summed_pairs(c, centre, only, keep, best=(kind, k), lists=lists).select(
            "i1", "i2", sim.alias("similarity"))

    with staged_paths() as paths:
        near = stage_table(top_k(similar(held, "near", None, hubs.lists), k), "near")
        kth = stage_table(near.where(F.col("rank") == k).select(
            F.col("i1").alias("item"), rank_key(F.col("similarity"), RANK_DIGITS).alias("kth")), "kth")
        if centre:  # squares of deviations from the user's mean, from the table per user
            means = stage_table(held.groupBy("user_id").agg(
                (F.sum("s") / F.sum("n")).alias("_mu")), "means")
            n, sm, q, mu = (F.col(x) for x in ("n", "s", "q", "_mu"))
            norms = stage_table(held.join(means, "user_id").groupBy("item").agg(
                F.sum(q - F.lit(2.0) * mu * sm + n * mu * mu).alias("x")), "norms")
            root = F.sqrt(F.greatest(F.col("x"), F.lit(0.0)) * norms.select(F.max("x")).scalar())
            # A little more than the true bound, for the rounding of the sums.
            bound = root / (root + F.lit(DAMPING)) * F.lit(1 + 1e-9) + F.lit(1e-9)
            shut = norms.join(kth, "item").where(F.col("kth") >= rank_key(bound, RANK_DIGITS))
        else:
            shut = kth.where(F.col("kth") >= rank_key(F.lit(1.0), RANK_DIGITS))
        shut = stage_table(shut.select("item", F.lit(False).alias("open")), "shut")
        # Open items with those above their top. Nothing else enters a list.
        c, keep, lists = held, None, hubs.lists
        if not shut.isEmpty():
            c = held.join(tops, "item", "left").join(shut, "item", "left")
            keep = F.col("open").isNull()
            lists = pair_lists(c, True, keep, heavy=hubs.heavy)
    drop_tables(held.sparkSession, [x for x in paths if "/lists-" not in x and "/near-" not in x
                                    and (not lists.dense or "/cells-" not in x)])
    return top_k(near.drop("rank").unionByName(similar(c, "far", keep, lists)), k)


def utility_cells(ratings: DataFrame) -> DataFrame:
    """Sparse utility matrix: avg rating per (item, user), NULL ratings dropped."""
    r = ratings.filter(F.col("user_id").isNotNull() & F.col("item").isNotNull()
                       & F.col("rating").isNotNull())
    return r.groupBy("item", "user_id").agg(F.avg("rating").alias("value"))


def l2_normalised(ratings: DataFrame) -> DataFrame:
    """Long form of the L2-normalised item vectors over all users:
    (item, user_id, value, norm, norm_value). A zero vector stays zero.

    The norm is a per-item aggregate joined back, not a window, so a hot
    item is combined map-side instead of landing in one task. Eager: cells and
    norms are written, so that AQE can split the hot item in the join.
    """
    u = stage_table(utility_cells(ratings), "utility")
    norms = stage_table(u.groupBy("item").agg(
        F.sqrt(F.sum(F.col("value") * F.col("value"))).alias("norm")), "norms")
    return (u.join(norms, "item", "inner")
             .withColumn("norm_value", F.coalesce(safe_div(F.col("value"), F.col("norm")),
                                                  F.lit(0.0))))


def full_cosine(ratings: DataFrame) -> DataFrame:
    """Cosine of whole item vectors (norms over all users, not only the
    co-rating ones): sum over shared users of the normalised entries."""
    nv = l2_normalised(ratings).select("user_id", "item", F.col("norm_value").alias("v"))
    j = salted_self_join(nv, [F.col("item").alias("i1"), F.col("v").alias("v1")],
                         [F.col("item").alias("i2"), F.col("v").alias("v2")])
    half = (j.filter(F.col("i1") < F.col("i2"))
             .groupBy("i1", "i2").agg(F.sum(F.col("v1") * F.col("v2")).alias("similarity")))
    return mirror(half)
