"""First-wins dedupe, top-k, quotas, slices: everything that depends on an order.

An order is always given by columns (for instance ``source_prio, seq``). Ranks inside a
group that may hold most of the table are never computed in one task: top-n goes through
salted partial ranks, full ranks through range partitions plus offsets.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contactloom.operators.join import without, lookup
from contactloom.session import materialise


def _orders(order: Sequence[str | Column]) -> list[Column]:
    return [F.col(o) if isinstance(o, str) else o for o in order]


def union_sources(*frames: DataFrame, prio: str = "source_prio") -> DataFrame:
    """Stack sources of different columns and number them in the given order."""
    tagged = [f.withColumn(prio, F.lit(i)) for i, f in enumerate(frames)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def first_nonempty(*frames: DataFrame) -> DataFrame:
    """The first source that has a row; looks at one row of each at most."""
    for frame in frames[:-1]:
        if not frame.isEmpty():
            return frame
    return frames[-1]


def first_wins(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """One row per key, the first in order.

    The limit of one row per key is applied before the shuffle too, so a key that holds
    a third of the table reaches its reducer as one row per map task.
    """
    window = Window.partitionBy(*keys).orderBy(*_orders(order))
    return df.withColumn("_rn", F.row_number().over(window)).where("_rn = 1").drop("_rn")


def exclude_seen(df: DataFrame, seen: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is not in the stored table."""
    return without(df, seen, keys)


def done_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.select(*keys).where(" AND ".join(f"{k} IS NOT NULL" for k in keys)).distinct()


def top_candidates(df: DataFrame, key: str, k: int | None, by: str = "score",
                   item: str = "email") -> DataFrame:
    """First k distinct items per key (all of them without k), with their ``rank``.

    ``by='score'``: score down, then position. ``'pos'``: discovery order only.
    ``'personal'``: personal inboxes first, those with a dot before others.
    """
    order = {"score": [F.col("score").desc(), F.col("pos")],
             "pos": [F.col("pos")],
             "personal": [F.col("is_personal").desc(),
                          F.contains(F.split_part(F.col(item), F.lit("@"), F.lit(1)),
                                     F.lit(".")).desc(), F.col("pos")]}[by]
    unique = first_wins(df, [key, item], order)
    return top_n(unique, [key], k, [*order, F.col(item)], name="rank", salts=1)


def stop_at_score(df: DataFrame, key: str, path: str = "path_no", score: int = 100) -> DataFrame:
    """Drop candidates of pages read after the one that first gave a top score.

    ``df`` is gone through twice; where its columns are costly, hand over a written table.
    """
    limit = (df.where(F.col("score") == score).groupBy(key)
             .agg(F.min(path).alias("_stop")))
    return (lookup(df, limit, key)
            .where(F.col("_stop").isNull() | (F.col(path) <= F.col("_stop"))).drop("_stop"))


def top_n(df: DataFrame, group: Sequence[str], n: int | None, order: Sequence[str | Column],
          name: str = "rank", salts: int | None = None) -> DataFrame:
    """First n rows per group with their rank, in two steps.

    Rows are first ranked among those of some input partitions only, then the survivors
    of all parts are ranked together. The last step sees at most ``salts * n`` rows of a
    group, however large the group is. Which part a row falls into does not matter for the
    result. ``salts=1`` leaves the first step out; for a small n the limit Spark applies
    before the shuffle is enough. Without n, every row is ranked.
    """
    order = _orders(order)
    if n is None:
        return running_rank(df, order, group, name)
    if salts is None:
        salts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = df
    if salts > 1:
        rows = rows.withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
        part = Window.partitionBy(*group, "_salt").orderBy(*order)
        rows = (rows.withColumn("_rn", F.row_number().over(part)).where(F.col("_rn") <= n)
                .drop("_rn", "_salt"))
    whole = Window.partitionBy(*group).orderBy(*order)
    return rows.withColumn(name, F.row_number().over(whole)).where(F.col(name) <= n)


def running_rank(df: DataFrame, order: Sequence[str | Column], group: Sequence[str] = (),
                 name: str = "rank") -> DataFrame:
    """Rank of every row within its group (or the table), without a one-task sort.

    Rows are range-partitioned by group and order and written once, so that counting and
    numbering see the same partitions. Each partition numbers its own rows; the counts of
    earlier partitions (one small row per partition and group) are added. The order must
    be total for the result to be unique.
    """
    order = _orders(order)
    spark = df.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2)
    ranged = (df.select("*", *[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)])
              .repartitionByRange(parts, *[F.col(f"_g{i}") for i in range(len(group))], *order)
              .withColumn("_part", F.spark_partition_id()))
    ranged = materialise(ranged)
    groups = [f"_g{i}" for i in range(len(group))]
    counts = ranged.groupBy("_part", *groups).agg(F.count(F.lit(1)).alias("_n"))
    before = (Window.partitionBy(*groups).orderBy("_part")
              .rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("_part", *groups,
                            F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    # only the group that a partition starts with can have begun earlier, so at most one
    # offset per partition is not zero: a broadcast of that size is safe
    offsets = F.broadcast(offsets.where("_off > 0"))
    inside = Window.partitionBy("_part", *groups).orderBy(*order)
    ranked = ranged.withColumn("_rn", F.row_number().over(inside)).alias("r")
    same = [F.col("r._part") == F.col("o._part")]
    same += [F.col(f"r.{g}").eqNullSafe(F.col(f"o.{g}")) for g in groups]
    joined = ranked.join(offsets.alias("o"), reduce(lambda a, b: a & b, same), "left")
    return joined.select(*[F.col(f"r.{c}") for c in df.columns],
                         (F.col("r._rn") + F.coalesce("o._off", F.lit(0))).alias(name))


def quota(df: DataFrame, category: str, n: int, order: Sequence[str | Column]) -> DataFrame:
    """First n rows of each category, with ``niche_rank``. No spill."""
    return top_n(df, [category], n, order, name="niche_rank")


def quota_with_spill(df: DataFrame, matches: dict[str, Column], n: int, key: str,
                     order: Sequence[str]) -> DataFrame:
    """Quota where a row goes to its first matching category that still has room.

    Row by row this is: take the first matching category that is not full; a key already
    taken is skipped. Between two fill-ups the set of open categories is fixed, so the
    outcome is found in at most ``len(matches)`` rounds. A round assigns all remaining rows
    among the open categories, finds the place where the first of them fills up, keeps the
    rows up to there and closes that category. Only that place (one order value per
    category) reaches the driver.
    """
    names = list(matches)
    place = F.struct(*[F.col(o) for o in order])
    # keep the category tests as one small array, so texts are read once
    rest = df.withColumn("_fits", F.array_compact(F.array(
        *[F.when(cond, F.lit(name)) for name, cond in matches.items()])))
    rest = materialise(rest.where(F.size("_fits") > 0).withColumn("_place", place))
    room = {name: n for name in names}
    taken: DataFrame | None = None
    while True:
        open_names = [c for c in names if room[c] > 0]
        if not open_names:
            break
        still = F.filter("_fits", lambda c: c.isin(*open_names))
        pool = rest.withColumn("niche", F.get(still, F.lit(0))).where("niche IS NOT NULL")
        if taken is not None:
            pool = exclude_seen(pool, taken, [key])
        pool = first_wins(pool, [key], ["_place"])
        left = F.create_map(*[F.lit(x) for c in open_names for x in (c, room[c])])
        ends = (top_n(pool, ["niche"], max(room.values()), ["_place"], name="_rank")
                .where(F.col("_rank") == left[F.col("niche")])
                .select("niche", "_place").orderBy("_place").limit(1).collect())
        if not ends:
            taken = pool if taken is None else taken.unionByName(pool)
            break
        end = ends[0]
        limit = F.struct(*[F.lit(v).cast(rest.schema[o].dataType).alias(o)
                           for o, v in zip(order, end["_place"])])
        kept = materialise(pool.where(F.col("_place") <= limit))
        for row in kept.groupBy("niche").count().collect():  # one row per category
            room[row["niche"]] -= row["count"]
        room[end["niche"]] = 0
        taken = kept if taken is None else taken.unionByName(kept)
        rest = rest.where(F.col("_place") > limit)
    if taken is None:
        taken = rest.withColumn("niche", F.lit(None).cast("string")).limit(0)
    return taken.drop("_fits", "_place")


def interleave(df: DataFrame, category: str, categories: Sequence[str],
               order: Sequence[str | Column], name: str = "position") -> DataFrame:
    """Round-robin position over the categories: first rows of each, second rows, ...

    The position follows from the rank within the category and the category sizes, so
    no sort of the whole table is needed.
    """
    place = F.array_position(F.array(*[F.lit(c) for c in categories]), F.col(category))
    known = df.where(place > 0)
    ranked = running_rank(known, order, [category], name="_rank")
    sizes = ranked.groupBy(category).agg(F.count(F.lit(1)).alias("_n"))
    table = sizes.agg(F.map_from_entries(F.collect_list(F.struct(category, "_n")))
                      .alias("_sizes"))  # one entry per category
    ranked = ranked.withColumn("_sizes", table.scalar())
    position = F.lit(0)
    for i, c in enumerate(categories, start=1):
        size = F.coalesce(F.col("_sizes")[F.lit(c)], F.lit(0))
        ahead = F.when(place > i, F.col("_rank")).otherwise(F.col("_rank") - 1)
        position = position + F.least(size, ahead)
    return (ranked.withColumn(name, position + 1)
            .withColumnRenamed("_rank", "niche_rank").drop("_sizes"))


def slices(df: DataFrame, n: int, position: str | None = None,
           key: str | None = None) -> DataFrame:
    """Slice number 0..n-1: by round-robin position, or by the MD5 of a key (no order needed),
    which other engines have too."""
    if position is not None:
        number = F.pmod(F.col(position) - 1, F.lit(n))
    else:
        head = F.substring(F.md5(F.col(key).cast("string").cast("binary")), 1, 15)
        number = F.pmod(F.conv(head, 16, 10).cast("long"), F.lit(n))
    return df.withColumn("slice", number.cast("int"))


def batch_no(df: DataFrame, n: int, order: Sequence[str | Column]) -> DataFrame:
    """Number of the n-row batch a row falls into, from 1."""
    ranked = running_rank(df, order, name="_rank")
    return ranked.withColumn("batch", (F.floor((F.col("_rank") - 1) / n) + 1).cast("long")
                             ).drop("_rank")


def prioritise(df: DataFrame, category: str, categories: Sequence[str], rank: str,
               name: str = "work_no") -> DataFrame:
    """Work-list position: categories in the given order, then by rank."""
    place = F.array_position(F.array(*[F.lit(c) for c in categories]), F.col(category))
    return running_rank(df, [F.when(place > 0, place).otherwise(len(categories) + 1),
                             F.col(rank)], name=name)


def limit_ranked(df: DataFrame, n: int, order: Sequence[str | Column]) -> DataFrame:
    """First n rows of the table in a stated order (a distributed top-n)."""
    return df.orderBy(*_orders(order)).limit(n)


def siblings(df: DataFrame, domain: str, email: str, n: int | None = None, sep: str = "; ",
             order: Sequence[str] = ("pos",), distinct: bool = True) -> DataFrame:
    """For each address the other addresses of its domain in order, as one text.

    With ``n`` the first n of them; then only the first n + 1 of a domain are collected, which
    is all any of its addresses can need. ``sibling_rows`` gives the set in long form, for
    domains whose addresses would not fit one text. ``distinct=False`` is for input that has
    each address of a domain once already.
    """
    unique = first_wins(df, [domain, email], order) if distinct else df
    head = unique
    if n is not None:
        head = top_n(unique, [domain], n + 1, [*order, email], salts=1)
    lists = (head.groupBy(domain)
             .agg(F.array_sort(F.collect_list(F.struct(*order, email))).alias("_head")))
    listed = F.transform("_head", lambda s: s[email])
    others = F.filter(listed, lambda e: e != F.col(email))
    others = others if n is None else F.slice(others, 1, n)
    return (lookup(unique, lists, domain)
            .withColumn("secondary_email", F.array_join(others, sep)).drop("_head"))


def sibling_rows(df: DataFrame, domain: str, email: str,
                 order: Sequence[str] = ("pos",)) -> DataFrame:
    """Distinct addresses per domain with their rank: the siblings of all, unshortened."""
    unique = first_wins(df, [domain, email], order)
    return running_rank(unique, [*order, email], [domain], name="rank")


def top_list(df: DataFrame, group: str, item: str, n: int, order: Sequence[str | Column],
             sep: str = ", ", name: str = "items") -> DataFrame:
    """First n items per group joined into one text (repeats stay)."""
    head = top_n(df, [group], n, order, name="_rank", salts=1)
    return head.groupBy(group).agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("_rank", item))), lambda s: s[item]), sep)
        .alias(name))
