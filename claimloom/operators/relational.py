"""Relational operators that claim analytics needs beyond the plain DataFrame API."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from claimloom.operators.scans import scan
from claimloom.sources.scratch import stored

#: Rows of a side that may be broadcast by hand.
SMALL = 100_000
#: Rows or pairs that one task is dealt.
PART = 1_000_000
#: Buckets of 64-bit hashes in which words are counted, a byte each in every task; bits of a set's parity.
BUCKETS, PARITY = 1 << 24, 512


def small(df: DataFrame, most: int = SMALL) -> DataFrame:
    """Mark a side for broadcast after counting it; a larger one is left to the optimizer."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def join_hot(rows: DataFrame, keyed: DataFrame, keys: list[str], size: str = "size", large: int = 20_000, most: int = 1_000_000) -> DataFrame:
    """Inner join of ``rows`` with the one row of their (non-null) keys in ``keyed``, whose column ``size`` is the number of rows of the key.

    Keys of more than ``large`` rows, of which there are fewer than rows / ``large``, are counted and broadcast, so their rows
    stay where they are; the others meet by a shuffle. ``size`` itself isn't returned.
    """
    hot = keyed.where(F.col(size) > large)
    if not 0 < (n := hot.count()) <= most:
        return rows.join(keyed.drop(size), keys)
    more = [c for c in keyed.columns if c not in (*keys, size)]
    met = rows.join(F.broadcast(hot.select(*keys, F.struct(F.lit(True).alias("_"), *more).alias("_hot"))), keys, "left")
    columns = [F.col(c) for c in rows.columns]
    quick = met.where("_hot is not null").select(*columns, *[F.col("_hot")[c].alias(c) for c in more])
    return quick.unionByName(met.where("_hot is null").select(*columns).join(keyed.where(F.col(size) <= large).drop(size), keys).select(*rows.columns, *more))


def fill_dimension(counts: DataFrame, key: str, members: list[str], columns: list[str]) -> DataFrame:
    """One row for each member of a fixed dimension, zero where nothing was counted."""
    dimension = counts.sparkSession.createDataFrame([(m,) for m in members], f"{key} string")
    return dimension.join(counts, key, "left").fillna(0, columns)


def zero_filled_counts(rows: DataFrame, key: str, members: list[str]) -> DataFrame:
    return fill_dimension(rows.groupBy(key).agg(F.count("*").alias("n")), key, members, ["n"])


def parts_for(rows: int, each: int = PART) -> int:
    """Partitions of ``each`` rows at most, so that a task's memory doesn't grow with the input."""
    return max(1, -(-rows // each))


def in_pairs(rows: DataFrame, group: str, ident: str, block: int = 2_000, each: int = PART) -> DataFrame:
    """All pairs of rows within groups: ``group``, then every other column as ``a_`` and ``b_``, either row being ``a``.

    Rows are distinct in (group, ident); null groups and idents make no pairs. A group of more than ``block`` rows is dealt to
    blocks by ``ident``, and each two blocks meet under a key of their own, so no task has more than block x block pairs to make,
    whatever a group's size. Large groups, of which there are fewer than rows / block, are counted and broadcast.
    """
    return _in_pairs(rows, group, ident, block, each)[0]


def _in_pairs(rows: DataFrame, group: str, ident: str, block: int, each: int) -> tuple[DataFrame, DataFrame, int]:
    """The pairs, made in tasks of about ``each`` as counted from the groups' sizes; the rows that they were made of; how many there are at most."""
    held = stored(rows.where(F.col(group).isNotNull() & F.col(ident).isNotNull()), "members")
    sizes = held.groupBy(group).agg(F.count("*").alias("_n"))
    n = int(sizes.agg(F.sum(F.col("_n").cast("double") * (F.col("_n") - 1) / 2)).first()[0] or 0)
    large = sizes.select(group, F.ceil(F.col("_n") / block).cast("int").alias("_blocks")).where("_blocks > 1")
    dealt = held.join(small(stored(large, "large-groups"), 1_000_000), group, "left").withColumn("_blocks", F.coalesce("_blocks", F.lit(1))).withColumn("_own", F.pmod(F.xxhash64(ident), F.col("_blocks")).cast("int"))
    more = [c for c in rows.columns if c != group]
    dealing = (lambda df: df.repartition(parts_for(n, each), group, "_i", "_j")) if n > each else lambda df: df
    side = lambda df, p: dealing(df.select(group, "_i", "_j", *[F.col(c).alias(f"{p}_{c}") for c in more]))
    a = side(dealt.withColumn("_i", F.col("_own")).withColumn("_j", F.explode(F.sequence("_own", F.col("_blocks") - 1))), "a")
    b = side(dealt.withColumn("_j", F.col("_own")).withColumn("_i", F.explode(F.sequence(F.lit(0), "_own"))), "b")
    return a.join(b, [group, "_i", "_j"]).where((F.col("_i") < F.col("_j")) | (F.col(f"a_{ident}") < F.col(f"b_{ident}"))).drop("_i", "_j"), held, n


def co_members(rows: DataFrame, group: str, member: str, count: str, differ: str | None = None, block: int = 2_000, each: int = PART) -> DataFrame:
    """Pairs of members that share groups, with the number of groups; ``differ`` names a column on which they must differ.

    Rows are distinct (group, member). A group of n members makes n (n - 1) / 2 pairs, in blocks (see :func:`in_pairs`); what is
    asked of nodes alone, :func:`member_weights` and :func:`classes` tell without pairs. Few members make few pairs, which are
    summed before they are shuffled; those of many are dealt to tasks of about ``each``, whatever the session's partitions.
    """
    pairs, held, n = _in_pairs(rows.select(group, member, *([differ] if differ else [])), group, member, block, each)
    if differ:
        pairs = pairs.where(F.col(f"a_{differ}") != F.col(f"b_{differ}"))
    pairs = pairs.select(F.least(f"a_{member}", f"b_{member}").alias("left_id"), F.greatest(f"a_{member}", f"b_{member}").alias("right_id"))
    members = held.select(member).distinct().count()
    if members * (members - 1) // 2 > each:
        pairs = pairs.repartition(parts_for(n, each), "left_id", "right_id")
    return pairs.groupBy("left_id", "right_id").agg(F.count("*").alias(count))


def member_weights(rows: DataFrame, group: str, member: str) -> DataFrame:
    """``(member, weight)``: the sum over a member's groups of their other members, which is the sum of its pairs' weights.

    Rows are distinct (group, member). Linear in them: no pair is made.
    """
    sizes = rows.groupBy(group).agg(F.count("*").alias("size")).withColumn("others", F.col("size") - 1)
    return join_hot(rows.select(group, member), sizes, [group]).groupBy(member).agg(F.sum("others").alias("weight"))


def classes(rows: DataFrame, group: str, member: str) -> tuple[DataFrame, DataFrame]:
    """Members with the same groups are one class: ``(class, n, top, next, groups)`` and ``(member, class)``.

    ``top`` and ``next`` are the two greatest members. A network of many members in few combinations of groups is as small as the
    combinations; pairs of members follow from pairs of classes.
    """
    own = rows.groupBy(member).agg(F.sort_array(F.collect_set(group)).alias("groups")).withColumn("class", F.sha2(F.to_json(F.struct("groups")), 256))
    own = stored(own, "classes")
    first = own.groupBy("class").agg(F.count("*").alias("n"), F.max(member).alias("top"), F.first("groups").alias("groups"))
    second = join_hot(own.select("class", member), first.select("class", "top", F.col("n").alias("size")), ["class"]).where(F.col(member) < F.col("top")).groupBy("class").agg(F.max(member).alias("next"))
    return stored(first.join(second, "class", "left").select("class", "n", "top", "next", "groups"), "classes"), own.select(member, "class")


def class_links(found: DataFrame, block: int = 2_000) -> DataFrame:
    """``(left_class, right_class, shared)`` of two classes that share groups, each pair once."""
    return co_members(found.select("class", F.explode("groups").alias("g")), "g", "class", "shared", block=block).withColumnsRenamed({"left_id": "left_class", "right_id": "right_class"})


def group_links(members: DataFrame, member: str, roles: DataFrame, role: str, group: str = "g") -> DataFrame:
    """Weight 3 for each shared member and 1 for each shared role between two groups."""
    shared, common = co_members(members, member, group, "shared"), co_members(roles, role, group, "roles")
    return shared.join(common, ["left_id", "right_id"], "full").select("left_id", "right_id", (3 * F.coalesce("shared", F.lit(0)) + F.coalesce("roles", F.lit(0))).cast("bigint").alias("weight"))


def dangling(checks: list[tuple[str, DataFrame, str, DataFrame, str]]) -> DataFrame:
    """Counts of references without target, zeros included: (name, referring rows, column, target rows, column)."""
    out = None
    for name, rows, column, targets, target in checks:
        missing = rows.select(F.col(column).alias("k")).join(targets.select(F.col(target).alias("k")), "k", "left_anti")
        counted = missing.agg(F.lit(name).alias("relation"), F.count("*").alias("n_dangling"))
        out = counted if out is None else out.unionByName(counted)
    return out


def both_ways(left: DataFrame, right: DataFrame, keys: list[str], left_only: str, right_only: str) -> DataFrame:
    """Keys that only one side has, with the side's name."""
    one = left.join(right, keys, "left_anti").select(F.lit(left_only).alias("side"), *keys)
    return one.unionByName(right.join(left, keys, "left_anti").select(F.lit(right_only).alias("side"), *keys))


def version_diff(before: DataFrame, after: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """Full outer comparison: status (added, removed, modified, unchanged) and which fields changed where both exist."""
    old = before.select(key, *[F.col(f).alias(f"{f}_before") for f in fields], F.lit(True).alias("in_before"))
    new = after.select(key, *[F.col(f).alias(f"{f}_after") for f in fields], F.lit(True).alias("in_after"))
    rows = old.join(new, key, "full")
    both = F.col("in_before").isNotNull() & F.col("in_after").isNotNull()
    same = F.lit(True)
    for f in fields:
        same = same & F.col(f"{f}_before").eqNullSafe(F.col(f"{f}_after"))
    status = F.when(F.col("in_before").isNull(), "added").when(F.col("in_after").isNull(), "removed").when(same, "unchanged").otherwise("modified")
    changed = [(both & ~F.col(f"{f}_before").eqNullSafe(F.col(f"{f}_after"))).alias(f"{f}_changed") for f in fields]
    return rows.select(key, status.alias("status"), *changed, *[f"{f}_{side}" for f in fields for side in ("before", "after")])


def keep_first(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The first row of each key by ``order``; rows lacking a key go."""
    present = rows
    for k in keys:
        present = present.where(F.col(k).isNotNull())
    return present.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(order))).where("_n = 1").drop("_n")


def keep_most_complete(rows: DataFrame, keys: list[str], fields: list[str], order: str) -> DataFrame:
    """Of the rows with equal keys the one with the most fields filled, the first among equals."""
    filled = sum((F.col(f).isNotNull().cast("int") for f in fields), F.lit(0))
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(filled.desc(), order))).where("_n = 1").drop("_n")


def duplicates(rows: DataFrame, keys: list[str], *more: Column) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count("*").alias("n"), *more).where("n > 1")


def has_repeats(array: Column | str) -> Column:
    return F.size(F.array_distinct(array)) < F.size(array)


def batches(rows: DataFrame, keys: list[str], order: str, size: int) -> DataFrame:
    n = F.row_number().over(Window.partitionBy(*keys).orderBy(order))
    return rows.withColumn("batch", (F.floor((n - 1) / size) + 1).cast("int"))


def saturation(rows: DataFrame, rate: float, floor: int) -> DataFrame:
    """For each pass: items not seen before, all seen so far, their rate, and whether two passes in a row stayed under it.

    ``rows`` are (pass, item). Passes are few; items are counted before the running sums.
    """
    first = rows.groupBy("item").agg(F.min("pass").alias("pass")).groupBy("pass").agg(F.count("*").alias("fresh"))
    active = rows.groupBy("pass").agg(F.count_distinct("item").alias("active"))
    w = Window.orderBy("pass")
    n = active.join(first, "pass", "left").fillna(0, ["fresh"]).withColumn("rate", F.col("fresh") / F.col("active")).withColumn("seen", F.sum("fresh").over(w))
    low = F.col("rate") < rate
    return n.withColumn("saturated", low & F.coalesce(F.lag("rate").over(w) < rate, F.lit(False)) & (F.col("seen") >= floor))


def overlaps(spans: DataFrame, keys: list[str], ident: str) -> DataFrame:
    """Pairs of overlapping half-open spans (start, end) with equal keys, clipped to their overlap.

    A span's level is the power of two that its length fits in. Spans are cut to bins of their level's width, and to those of
    every wider level there is, of which a span touches three at most; a pair meets at the level of its longer span, in the bin
    where the later of both begins, and so once. Nothing is joined on the keys alone, so a key may hold any number of spans, and
    long spans aren't cut into many pieces. A span without start or end overlaps nothing.
    """
    width = F.greatest(F.col("end") - F.col("start"), F.lit(1)).cast("double")
    rows = stored(spans.where("start is not null and end is not null").select(*keys, ident, "start", "end", F.ceil(F.log2(width)).cast("int").alias("_level")), "spans")
    levels = F.array(*[F.lit(r["_level"]) for r in rows.select("_level").distinct().orderBy("_level").collect()])  # some sixty at most
    bin_of = lambda x: F.floor(x / F.pow(F.lit(2.0), F.col("_at"))).cast("bigint")
    each = rows.withColumn("_at", F.explode(F.filter(levels.cast("array<int>"), lambda x: x >= F.col("_level")))).withColumn("_bin", F.explode(F.sequence(bin_of(F.col("start")), bin_of(F.col("end")))))
    side = lambda df, p: df.select(*keys, "_at", "_bin", *[F.col(c).alias(f"{p}_{c}") for c in (ident, "start", "end", "_level")])
    a, b = side(each.where("_level = _at"), "a"), side(each, "b")
    once = (F.col("b__level") < F.col("_at")) | (F.col(f"a_{ident}") < F.col(f"b_{ident}"))
    hit = once & (F.col(f"a_{ident}") != F.col(f"b_{ident}")) & (F.col("a_start") < F.col("b_end")) & (F.col("a_end") > F.col("b_start"))
    met = a.join(b, [*keys, "_at", "_bin"]).where(hit & (bin_of(F.greatest("a_start", "b_start")) == F.col("_bin")))
    return met.select(*keys, F.least(f"a_{ident}", f"b_{ident}").alias("left_id"), F.greatest(f"a_{ident}", f"b_{ident}").alias("right_id"), F.greatest("a_start", "b_start").alias("clip_start"), F.least("a_end", "b_end").alias("clip_end"))


def repeatable_sample(rows: DataFrame, keys: list[str], hashed: Column, order: str, share: float, least: int, prefix: int = 4) -> DataFrame:
    """The same share of each group every time, ``least`` rows at least: those of the smallest ``hashed`` (hexadecimal text).

    Rows are counted by group and the hash's first ``prefix`` digits; only those that share the prefix in which a group's
    share ends need be ranked, so that a group that holds most rows is no task of its own.
    """
    marked = rows.withColumn("_h", hashed).withColumn("_p", F.substring("_h", 1, prefix))
    counts = marked.groupBy(*keys, "_p").agg(F.count("*").alias("_in"))
    w = Window.partitionBy(*keys)
    upto = counts.withColumn("_upto", F.sum("_in").over(w.orderBy("_p"))).withColumn("_quota", F.greatest(F.lit(least), F.ceil(F.sum("_in").over(w) * share)))
    bounds = upto.where(F.col("_upto") - F.col("_in") < F.col("_quota")).withColumn("_take", F.col("_quota") - F.col("_upto") + F.col("_in")).select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("_p").alias("_q"), "_take", "_in")
    same = F.col("_p") == F.col("_q")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    picked = marked.join(bounds, same).drop("_q", *[f"_{k}" for k in keys])
    sure = picked.where("_take >= _in")
    ends = picked.where("_take < _in").withColumn("_k", F.row_number().over(Window.partitionBy(*keys, "_p").orderBy("_h", order))).where("_k <= _take").drop("_k")
    return sure.unionByName(ends).drop("_h", "_p", "_take", "_in")


def places(rows: DataFrame, keys: list[str], coarse: list[Column], order: list[Column | str], name: str) -> DataFrame:
    """``name``: each row's place in its group by ``order``, from 1. ``coarse`` rises with the order and parts large groups, whose parts are counted first."""
    parted = rows
    for i, c in enumerate(coarse):
        parted = parted.withColumn(f"_c{i}", c)
    parts = [*keys, *[f"_c{i}" for i in range(len(coarse))]]
    counts = parted.groupBy(*parts).agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.partitionBy(*keys).orderBy(*parts[len(keys) :])) - F.col("_n")
    counts = counts.select(*[F.col(c).alias(f"r{c}") for c in parts], before.alias("_before"))
    same = F.lit(True)
    for c in parts:
        same = same & F.col(c).eqNullSafe(F.col(f"r{c}"))
    own = F.row_number().over(Window.partitionBy(*parts).orderBy(*order))
    return parted.withColumn("_own", own).join(counts, same).withColumn(name, (F.col("_own") + F.col("_before")).cast("int")).drop("_own", "_before", *parts[len(keys) :], *[f"r{c}" for c in parts])


def running_places(rows: DataFrame, keys: list[str], order: str, length: Column) -> DataFrame:
    """Start and end of each piece in the text that its group's pieces make one after the other."""
    return scan(rows, keys, [order], {"end_at": ("sum", length)}).withColumn("start_at", F.col("end_at") - length)


def nearest_before(rows: DataFrame, keys: list[str], order: str, wanted: Column, barrier: Column) -> DataFrame:
    """``anchor``: the order value of the nearest earlier wanted row with no barrier between."""
    last = lambda c: ("last", F.when(c, F.col(order)))
    found = scan(rows, keys, [order], {"_a": last(wanted), "_b": last(barrier)}, before=True)
    return found.withColumn("anchor", F.when(F.col("_b").isNull() | (F.col("_a") > F.col("_b")), F.col("_a"))).drop("_a", "_b")


def through(rows: DataFrame, group: str, member: str) -> Callable[[DataFrame], DataFrame]:
    """Edges between the members of a group, for :func:`snowball_rounds`, without making them: from a front to its groups and on to their members."""

    def step(front: DataFrame) -> DataFrame:
        held = rows.join(front.withColumnRenamed("node", member), member).select(group).distinct()
        return rows.join(small(stored(held, "groups")), group).select(F.col(member).alias("node"), F.lit("backward").alias("way")).where("node is not null")

    return step


def snowball_rounds(seeds: DataFrame, edges: DataFrame | Callable[[DataFrame], DataFrame], rounds: int, most_each: int | None = None, scores: DataFrame | None = None, accepted: DataFrame | None = None, both: bool = True) -> tuple[DataFrame, DataFrame]:
    """Expansion in rounds along edges (u refers to v): nodes ``(node, round)`` and a log row for each round.

    A round goes out from the ``most_each`` best (by ``scores``: node, score; then the least node) of the whole set so far, or from
    all of it, to what they refer to and, with ``both``, to what refers to them. All that is new and, where given, ``accepted``
    joins the set; the limit is on what is expanded, never on what is found. A node that was expanded has nothing new to give and
    isn't expanded again; one that wasn't accepted is remembered and not found again. The set is a stored table after each round,
    so plans don't grow with the rounds. In place of edges there may be a function from a front (node) to what it reaches (node, way).
    """
    seen = stored(seeds.select("node", F.lit(0).alias("round"), F.lit(False).alias("done"), F.lit(True).alias("kept")).distinct(), "snowball")
    log = None
    for n in range(1, rounds + 1):
        best = seen.where("kept")
        if most_each:
            ranked = best.join(scores, "node", "left") if scores is not None else best.withColumn("score", F.lit(0))
            best = ranked.orderBy(F.col("score").desc_nulls_last(), "node").limit(most_each)  # the limit is the feature
        front = stored(best.where("not done").select("node"), "front")
        near = small(front)
        step = edges(near) if callable(edges) else edges.join(near.withColumnRenamed("node", "u"), "u").select(F.col("v").alias("node"), F.lit("backward").alias("way"))
        if both and not callable(edges):
            step = step.unionByName(edges.join(near.withColumnRenamed("node", "v"), "v").select(F.col("u").alias("node"), F.lit("forward").alias("way")))
        fresh = step.groupBy("node").agg(F.min("way").alias("way")).join(seen.select("node"), "node", "left_anti")
        kept = F.lit(True)
        if accepted is not None:
            fresh = fresh.join(accepted.select("node", F.lit(True).alias("_ok")).distinct(), "node", "left")
            kept = F.coalesce("_ok", F.lit(False))
        fresh = stored(fresh.select("node", "way", kept.alias("kept")), "found")
        done = seen.join(near.withColumn("_now", F.lit(True)), "node", "left").select("node", "round", (F.col("done") | F.col("_now").isNotNull()).alias("done"), "kept")
        seen = stored(done.unionByName(fresh.select("node", F.lit(n).alias("round"), F.lit(False).alias("done"), "kept")), "snowball")
        counted = fresh.agg(F.count_if(F.col("way") == "backward").alias("backward_added"), F.count_if(F.col("way") == "forward").alias("forward_added"), F.count_if("kept").alias("after_screen"))
        row = counted.crossJoin(best.agg(F.count("*").alias("seed_papers"))).crossJoin(seen.agg(F.count_if("kept").alias("cumulative_unique"))).select(F.lit(n).alias("round"), "seed_papers", "backward_added", "forward_added", "after_screen", "cumulative_unique")
        log = row if log is None else log.unionByName(row)
    empty = seeds.sparkSession.createDataFrame([], "round int, seed_papers bigint, backward_added bigint, forward_added bigint, after_screen bigint, cumulative_unique bigint")
    return seen.where("kept").select("node", "round"), empty if log is None else log


def snowball(seeds: DataFrame, edges: DataFrame | Callable[[DataFrame], DataFrame], rounds: int, **more) -> DataFrame:
    """The nodes of :func:`snowball_rounds`."""
    return snowball_rounds(seeds, edges, rounds, **more)[0]


def topic_hits(hays: DataFrame, ident: str, queries: DataFrame, items: list[str]) -> DataFrame:
    """``(ident, *items)`` of texts ``hay`` (normalised words) that hold every one of a query's ``tokens`` within some word.

    Tokens are looked for in the distinct words of all texts, whose texts are counted; only texts that hold a query's rarest
    token are tried with its other tokens, and no text meets a query that it shares no word with.
    """
    hays = stored(hays, "hays")  # normalising a text costs more than reading it again
    asked = queries.where(F.size("tokens") > 0).select("tokens", *items).distinct()
    asked = stored(asked.withColumn("_q", F.monotonically_increasing_id()), "asked")  # numbered once; pairs carry numbers
    words = hays.select(ident, F.explode(F.array_distinct(F.split("hay", " "))).alias("word"))
    # a token has three characters at least; words are joined with it on its last three before the whole is looked for
    grams = F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.length("word") - 2, F.lit(1))), lambda i: F.substr("word", i, F.lit(3))))
    known = words.groupBy("word").agg(F.count("*").alias("n")).where(F.length("word") >= 3).select("word", "n", F.explode(grams).alias("gram"))
    each = asked.select("_q", F.explode("tokens").alias("token"))
    keys = small(each.select("token", F.substr("token", F.length("token") - 2, F.lit(3)).alias("gram")).distinct())
    holding = stored(known.join(keys, "gram").where(F.expr("contains(word, token)")).select("word", "token", "n"), "holding")
    held = holding.groupBy("token").agg(F.sum("n").alias("n"))
    rarest = each.join(held, "token", "left").groupBy("_q").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token")).alias("r")).select("_q", "r.token")
    # only words that hold some query's rarest token are met; a text's queries are one list, so that the text itself meets them once
    met = stored(holding.join(rarest, "token").groupBy("word").agg(F.collect_set("_q").alias("_qs")), "rarest")
    tried = words.join(small(met), "word").select(F.col(ident).alias("_id"), F.explode("_qs").alias("_q")).groupBy("_id").agg(F.collect_set("_q").alias("_qs"))
    pairs = tried.join(hays.select(ident, "hay"), F.col("_id").eqNullSafe(F.col(ident))).select(ident, "hay", F.explode("_qs").alias("_q")).join(small(asked), "_q")
    return pairs.where(F.forall("tokens", lambda x: F.contains(F.col("hay"), x))).select(ident, *items)


def quote_hits(texts: DataFrame, ident: str, quotes: DataFrame, item: str, width: int = 3) -> DataFrame:
    """``(ident, item, text, quote)`` of texts that hold a quote, character by character.

    The middle words of a quote stand in the text between spaces as they do in the quote. So a text that holds it shares the
    ``width`` words in the quote's middle, on which the two are joined; quotes too short for that are tried with every text.
    """
    words = F.split("quote", " ")
    keyed = quotes.withColumn("_w", words).withColumn("_long", F.size("_w") >= width + 2)
    middle = F.array_join(F.slice("_w", F.floor((F.size("_w") - width) / 2).cast("int") + 1, width), " ")
    keys = keyed.where("_long").select(item, "quote", middle.alias("_key"))
    runs = lambda p: F.transform(F.slice(p, F.lit(1), F.greatest(F.size(p) - width + 1, F.lit(0))), lambda _, i: F.array_join(F.slice(p, i + 1, width), " "))
    grams = F.array_distinct(F.flatten(F.transform(F.array(F.split("text", " ")), runs)))  # the words are bound once, not for each run
    found = texts.select(F.col(ident).alias("_id"), F.explode(grams).alias("_key")).join(small(keys), "_key").select("_id", item, "quote").distinct()
    near = found.join(texts.select(ident, "text"), F.col("_id").eqNullSafe(F.col(ident))).where(F.expr("contains(text, quote)")).select(ident, item, "text", "quote")
    short = small(keyed.where("not _long").select(item, "quote"))
    return near.unionByName(texts.select(ident, "text").join(short, F.expr("contains(text, quote)")).select(ident, item, "text", "quote"))


def word_classes(terms: DataFrame, word: str) -> tuple[bytes, int]:
    """How common 64-bit hashes are, one byte for each of ``BUCKETS`` of them, and how many rows there are.

    A byte rises by eight with each doubling of its bucket's rows; 0 is one row at most. The table has the same size whatever the
    input, so that tasks can hold it and order a row's words without a shuffle of words.
    """
    counts = terms.groupBy(F.shiftrightunsigned(word, 64 - BUCKETS.bit_length() + 1).cast("int").alias("bucket")).agg(F.count("*").alias("n"))
    rows = counts.select(F.shiftright("bucket", 16).alias("slab"), F.col("bucket").bitwiseAND(65535).alias("low"), F.least(F.floor(8 * F.log2("n")), F.lit(255)).cast("int").alias("class"), "n")

    def packed(table):
        import numpy as np
        import pyarrow as pa

        held = np.zeros(1 << 16, np.uint8)
        held[table["low"].to_numpy()] = table["class"].to_numpy()
        return pa.table({"slab": table["slab"].slice(0, 1), "classes": pa.array([held.tobytes()], pa.binary()), "n": pa.array([int(table["n"].to_numpy().sum())], pa.int64())})

    slabs = {r["slab"]: r for r in rows.groupBy("slab").applyInArrow(packed, "slab int, classes binary, n bigint").collect()}
    return b"".join(bytes(slabs[i]["classes"]) if i in slabs else bytes(1 << 16) for i in range(BUCKETS >> 16)), sum(r["n"] for r in slabs.values())


def jaccard_pairs(rows: DataFrame, ident: str, words: str, above: float) -> DataFrame:
    """Pairs with Jaccard similarity over ``above``: a prefix join on the rarest words, then exact.

    ``words`` are arrays of distinct 64-bit hashes. Two sets that are similar enough share a word among the first
    n - ceil(above n) + 1 words of each in the order of rarity, so that frequent words are never joined on. Any order that all
    sets keep would do; this one is that of their buckets' counts (:func:`word_classes`), found within a set's row. Sets whose
    sizes, or whose words on either side of the shared one, leave too few in common are no candidates, nor are those whose
    parities (``PARITY`` bits, each flipped by some words) differ in more bits than the sets may in words. So what is shuffled is
    prefixes, and words of those that are left.
    """
    spark = rows.sparkSession
    sets = rows.select(F.col(ident).alias("id"), F.col(words).alias("w"))
    classes, n_terms = word_classes(sets.select(F.explode("w").alias("word")), "word")
    told, shift, bits = spark.sparkContext.broadcast(classes), 64 - BUCKETS.bit_length() + 1, PARITY
    parity = [f"p{i}" for i in range(bits // 64)]

    def prefixes(batches):
        import numpy as np
        import pyarrow as pa

        rank = np.frombuffer(told.value, np.uint8)
        for batch in batches:
            sizes = batch["w"].value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            at = 0
            while at < len(sizes):  # a thousand sets, or half a million words, at once
                upto = at + max(1, min(1000, int(np.searchsorted(np.cumsum(sizes[at : at + 1000]), 500_000, "right"))))
                n, w = sizes[at:upto], batch["w"].slice(at, upto - at).flatten().to_numpy(zero_copy_only=False).view(np.uint64)
                row = np.repeat(np.arange(len(n)), n)
                odd = (np.bincount(row * bits + (w & np.uint64(bits - 1)).astype(np.int64), minlength=len(n) * bits) & 1).astype(np.uint8)
                sketch = np.packbits(odd).view(np.int64).reshape(len(n), -1)
                common = rank[w >> np.uint64(shift)]
                order = np.lexsort((w, common, row))
                k = np.arange(1, len(w) + 1) - np.repeat(np.cumsum(n) - n, n)
                kept = (k <= (n - np.ceil(n * above) + 1)[row]) & (common[order] > 0)  # a word of class 0 is in no other set
                own, word = row[kept], w[order][kept].view(np.int64)
                columns = [batch["id"].take(pa.array(own + at)), pa.array(word), pa.array(n[own].astype(np.int32)), pa.array(k[kept].astype(np.int32)), *[pa.array(x) for x in sketch[own].T]]
                yield pa.RecordBatch.from_arrays(columns, ["id", "word", "n", "k", *parity])
                at = upto

    kind = sets.schema["id"].dataType.simpleString()
    prefix = sets.mapInArrow(prefixes, f"id {kind}, word bigint, n int, k int, " + ", ".join(f"{p} bigint" for p in parity))
    prefix = prefix.repartition(parts_for(int(n_terms * (1 - above))), "word")
    a, b = (prefix.select("word", *[F.col(c).alias(f"{x}_{c}") for c in ("id", "n", "k", *parity)]) for x in ("left", "right"))
    both_n = F.col("left_n") + F.col("right_n")
    most = F.least("left_k", "right_k") + F.least(F.col("left_n") - F.col("left_k"), F.col("right_n") - F.col("right_k"))
    enough = most * (1 + above) >= both_n * above - 1e-6
    differ = sum((F.bit_count(F.col(f"left_{p}").bitwiseXOR(F.col(f"right_{p}"))) for p in parity), F.lit(0))
    near = differ * (1 + above) <= both_n * (1 - above) + 1e-6
    pairs = a.join(b, "word").where((F.col("left_id") < F.col("right_id")) & enough & near).select("left_id", "right_id").distinct()
    counted = _shared_words(stored(pairs, "near"), sets)
    value = F.col("shared") / (F.col("left_n") + F.col("right_n") - F.col("shared"))
    return counted.withColumn("similarity", value).where(F.col("similarity") > above).select("left_id", "right_id", F.round("similarity", 6).alias("similarity"))


def _shared_words(pairs: DataFrame, sets: DataFrame, each: int = 4 * PART) -> DataFrame:
    """``(left_id, right_id, left_n, right_n, shared)`` of pairs (left_id, right_id) of sets (id, w), whose words meet once for many pairs.

    Pairs are dealt by the least id that two steps along pairs lead to from the left one, so that sets that are alike come to one
    place, once each, and not once a pair. A place of more than ``each`` words is parted by either id.
    """
    ways = pairs.unionByName(pairs.select(F.col("right_id").alias("left_id"), F.col("left_id").alias("right_id")))
    label = ways.groupBy("left_id").agg(F.least(F.min("right_id"), F.col("left_id")).alias("label"))
    label = ways.join(label.withColumnsRenamed({"left_id": "right_id"}), "right_id").groupBy("left_id").agg(F.min("label").alias("label"))
    label = stored(label, "near-labels")
    met = stored(sets.join(small(label.select(F.col("left_id").alias("id")), PART), "id", "left_semi"), "near-sets")
    n_words = met.agg(F.sum(F.size("w").cast("bigint"))).first()[0] or 0
    place = F.pmod(F.xxhash64("label"), F.lit(parts_for(n_words, each // 4)))
    dealt = stored(pairs.join(label, "left_id").select(place.alias("place"), "left_id", "right_id"), "near-dealt")
    seats = dealt.select("place", F.explode(F.array("left_id", "right_id")).alias("id")).distinct()
    held = seats.join(met.select("id", F.size("w").alias("n")), "id").groupBy("place").agg(F.ceil(F.sum("n") / each).cast("int").alias("_m")).where("_m > 1")
    dealt = dealt.join(small(stored(held, "near-large")), "place", "left").withColumn("_m", F.coalesce("_m", F.lit(1)))
    at = lambda c: F.pmod(F.xxhash64(c), F.col("_m")).cast("int")
    dealt = dealt.select("place", at("left_id").alias("i"), at("right_id").alias("j"), "left_id", "right_id")
    there = ["_place", "_i", "_j"]
    seats = dealt.select(*[F.col(c[1:]).alias(c) for c in there], F.explode(F.array("left_id", "right_id")).alias("id")).distinct().join(met, "id")

    def count(asked, held):
        import numpy as np
        import pyarrow as pa

        words = held["w"].combine_chunks()
        ends = np.cumsum(words.value_lengths().to_numpy(zero_copy_only=False)) if len(words) else np.zeros(0, np.int64)
        codes = np.unique(words.flatten().to_numpy(zero_copy_only=False), return_inverse=True)[1] if len(words) else np.zeros(0, np.int64)
        rows: dict = {}  # rows of one id may be several sets
        for i, x in enumerate(held["id"].to_pylist()):
            rows.setdefault(x, []).append(codes[ends[i - 1] if i else 0 : ends[i]])
        mark, out, partners = np.zeros(len(codes), bool), [], {}
        for x, y in zip(asked["left_id"].to_pylist(), asked["right_id"].to_pylist()):
            partners.setdefault(x, []).append(y)
        for x, ys in partners.items():
            for own in rows.get(x, ()):
                mark[own] = True
                out += [(x, y, len(own), len(other), int(np.count_nonzero(mark[other]))) for y in ys for other in rows.get(y, ())]
                mark[own] = False
        kind = asked.schema.field("left_id").type
        return pa.table([pa.array([r[c] for r in out], t) for c, t in enumerate((kind, kind, pa.int32(), pa.int32(), pa.int32()))], ["left_id", "right_id", "left_n", "right_n", "shared"])

    kind = pairs.schema["left_id"].dataType.simpleString()
    return dealt.groupBy("place", "i", "j").cogroup(seats.groupBy(*there)).applyInArrow(count, f"left_id {kind}, right_id {kind}, left_n int, right_n int, shared int")


def block_jaccard(rows: DataFrame, keys: list[str], ident: str, words: str, above: float) -> DataFrame:
    """Pairs within blocks of equal ``keys`` (nulls are a value) with Jaccard similarity over ``above``.

    Equal sets of a block are merged first: the least id stands for them and makes a pair of similarity 1 with each other
    one, so that n copies are n - 1 rows; pairs of differing sets are those of their least ids. Words are told apart by
    64-bit hashes with their block's keys. Rows without words or id have no pairs.
    """
    block = [x for k in keys for x in (F.col(k).isNull(), F.col(k))]
    hashed = F.transform(words, lambda w: F.xxhash64(*block, w))
    sets = rows.where(F.col(ident).isNotNull()).select(F.col(ident).alias("id"), F.sort_array(F.array_distinct(hashed)).alias("w")).where(F.size("w") > 0).withColumn("set", F.unhex(F.sha2(F.array_join(F.transform("w", lambda x: x.cast("string")), ","), 256)))
    sets = stored(sets, "sets")
    # sets are told apart by digests; their words stay where they are
    least = sets.groupBy("set").agg(F.min("id").alias("left_id"), F.count("*").alias("n")).where("n > 1").select("set", "left_id")
    copies = stored(sets.select("id", "set").join(least, "set").select("set", "left_id", F.col("id").alias("right_id")).distinct().where("left_id <> right_id"), "copies")
    firsts = sets.join(small(copies.select("set", F.col("right_id").alias("id")), 1_000_000), ["set", "id"], "left_anti")
    return jaccard_pairs(firsts, "id", "w", above).distinct().unionByName(copies.select("left_id", "right_id", F.lit(1.0).alias("similarity")))
