"""The prefix trie of conversations, by partition refinement.

Method: all conversations begin in one class, the root. A round splits the classes that are still active by their next turns;
each class at each turn is a node. A class of one member is retired: the rest of its turns is a chain of single nodes, made at
the end in one step. Copies are merged first, so that a class of one member is one *text*, however many conversations have it,
and long copies don't keep a class active. A round reads twice as many turns as the one before (1, 1, 2, 4, ...) and splits
turn after turn within them, so its number grows with the logarithm of the deepest shared prefix.

A class is known by its depth and 128 bits made of all its turns, each of which stands for (place, digest of role and text), so
members find their class without being joined with it; what is joined is only which classes stay active.

Folding back takes one pass, not one a depth: a node is named by its smallest member, and a member owns the nodes that it names,
which are an unbroken end of its path. A subtree's sum is what its namesake owns from there down and all that its other members
own in total, as they branch off below. So it is one sum over (member, shared depth), and one running sum along each path.

Everything wide is shuffled by conversation or class in narrow rows (digests and counts, no texts). Places and running sums in
conversations of any length come from prefix scans; classes of many members are summed on the map side, and the join that keeps
them active broadcasts the few large ones after it counted them. Ids of copies are joined to a text for the digest in runs of
4,096 neighbouring ids; only a group of copies that spans several runs goes through one task, as a stream of runs, since a
SHA-256 can't be computed from parts.

Edges: turns are ordered by ``turn`` (null first), then by the digest of role and text; a null role or text is empty; rows
without ``conv_id`` are left out; repeated rows are turns of their own; texts are read whole. A conversation whose turns all
go in the rebuilding is a member of the root. An empty table has no nodes, not even a root. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from claimloom.operators.relational import join_hot
from claimloom.operators.scans import numbered, scan

from .common import drop_stored, stored

#: Ids whose decimal texts are joined in one row for the digests of copies.
RUN_IDS = 4096
KEY = ["depth", "f0", "f1"]


def own_turns(conversations: DataFrame) -> DataFrame:
    """``(conv_id, n, what, words)``: each conversation's turns from 1, with a digest of role and text."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    what = F.substring(F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)), 1, 16)
    rows = conversations.where("conv_id is not null").select("conv_id", "turn", what.alias("what"), F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint").alias("words"))
    return numbered(rows, ["conv_id"], ["turn", "what"], "n").select("conv_id", "n", "what", "words")


def rebuilt(turns: DataFrame, family: int = 20, most: int = 4) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin as the first of their ``family`` does: their first ``crc32(id) % most`` turns are that one's.

    Returns ``(conv_id, n_turns)`` for every id and ``(conv_id, depth, what, words)`` for the new turns.
    """
    turns = stored(turns, "own-turns")
    head = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("bigint")
    each = turns.groupBy("conv_id").agg(F.count("*").alias("size")).select("conv_id", "size", head.alias("h"), (F.col("conv_id") - F.col("conv_id") % family).alias("base"))
    first = turns.where(F.col("n") < most).select(F.col("conv_id").alias("base"), "n", "what", "words")
    have = first.groupBy("base").agg(F.count("*").alias("have"))
    each = stored(each.join(have, "base", "left").withColumn("lent", F.least("h", F.coalesce("have", F.lit(0)))), "each")
    lent = each.where("lent > 0").select("conv_id", "base", "lent").join(first, "base").where("n <= lent").select("conv_id", F.col("n").alias("depth"), "what", "words")
    kept = join_hot(turns, each.where("size > h").select("conv_id", "size", "h", "lent"), ["conv_id"]).where("n > h")
    kept = kept.select("conv_id", (F.col("n") - F.col("h") + F.col("lent")).alias("depth"), "what", "words")
    return each.select("conv_id", (F.greatest(F.col("size") - F.col("h"), F.lit(0)) + F.col("lent")).alias("n_turns")), stored(lent.unionByName(kept), "rebuilt")


def _marks():
    """Two words of 64 bits that stand for a turn at its place."""
    return [F.xxhash64("depth", "what", F.lit(seed)).alias(f"x{seed}") for seed in (0, 1)]


def _joined_digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each group's runs of ids, which come sorted; only the digest's state is held."""
    now, state = None, None

    def done():
        return pa.RecordBatch.from_pydict({"rep": pa.array([now], pa.int64()), "ends": pa.array([state.hexdigest()], pa.string())})

    for batch in batches:
        for rep, ids in zip(batch["rep"].to_pylist(), batch["ids"].to_pylist()):
            if rep != now:
                if state:
                    yield done()
                now, state = rep, hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
    if state:
        yield done()


def distinct_texts(each: DataFrame, turns: DataFrame) -> DataFrame:
    """``(rep, n_turns, weight, ends)``: a row for each distinct sequence of turns, by its smallest conversation.

    ``ends`` is the digest of the ids of all conversations that have it.
    """
    marked = turns.select("conv_id", *_marks()).groupBy("conv_id").agg(F.bit_xor("x0").alias("f0"), F.bit_xor("x1").alias("f1"))
    same = ["n_turns", "f0", "f1"]
    runs = each.join(marked, "conv_id", "left").fillna(0, ["f0", "f1"]).groupBy(*same, F.floor(F.col("conv_id") / RUN_IDS).alias("run")).agg(F.sort_array(F.collect_list("conv_id")).alias("ids"))
    runs = stored(runs.select(*same, "run", F.col("ids")[0].alias("least"), F.size("ids").cast("bigint").alias("n"), F.array_join(F.transform("ids", lambda x: x.cast("string")), ",").alias("ids")), "runs")
    groups = stored(runs.groupBy(*same).agg(F.min("least").alias("rep"), F.sum("n").alias("weight"), F.count("*").alias("size"), F.sha2(F.max("ids"), 256).alias("one")), "copies")
    many = groups.where("size > 1").select(*same, "rep", "size")
    streams = join_hot(runs.select(*same, "run", "ids"), many, same).repartition("rep").sortWithinPartitions("rep", "run").select("rep", "ids")
    ends = streams.mapInArrow(_joined_digest, "rep bigint, ends string")
    out = groups.join(ends, "rep", "left").select("rep", "n_turns", "weight", F.when(F.col("size") == 1, F.col("one")).otherwise(F.col("ends")).alias("ends"))
    return stored(out, "texts")


def refine(texts: DataFrame, turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split classes until each has one member: ``(members by depth, nodes by depth)``.

    Members are ``(rep, n_turns, weight, depth, f0, f1, p0, p1, words)``, nodes the same key with their smallest member ``name``,
    numbers of members ``n_seq`` and conversations ``n_convs``, parent's key ``p0, p1``, and ``ender``, the member that ends there.
    """
    zero = F.lit(0).cast("bigint")
    rows = stored(texts.select("rep", "n_turns", "weight", *[zero.alias(c) for c in ("depth", "f0", "f1", "p0", "p1", "words")]), "members")
    members, nodes, depth, step = None, None, 0, 1
    while True:
        ender = F.min(F.when(F.col("n_turns") == F.col("depth"), F.col("rep")))
        found = rows.groupBy(*KEY).agg(F.min("rep").alias("name"), F.count("*").alias("n_seq"), F.sum("weight").alias("n_convs"), F.max("n_turns").alias("longest"), F.max("words").alias("words"), F.max("p0").alias("p0"), F.max("p1").alias("p1"), ender.alias("ender"))
        found = stored(found, "nodes")
        members, nodes = (rows, found) if members is None else (members.unionByName(rows), nodes.unionByName(found))
        wide = found.where((F.col("depth") == depth) & (F.col("n_seq") > 1)).select(*KEY, F.col("n_seq").alias("size"))
        active = join_hot(rows.where(F.col("depth") == depth), wide, KEY).where(F.col("n_turns") > depth).select("rep", "n_turns", "weight", "f0", "f1")
        nexts = turns.where((F.col("depth") > depth) & (F.col("depth") <= depth + step)).select(F.col("conv_id").alias("rep"), "depth", "words", *_marks())
        along = Window.partitionBy("rep").orderBy("depth")
        rows = nexts.join(active, "rep").withColumn("g0", F.col("f0").bitwiseXOR(F.bit_xor("x0").over(along))).withColumn("g1", F.col("f1").bitwiseXOR(F.bit_xor("x1").over(along)))
        rows = stored(rows.select("rep", "n_turns", "weight", "depth", F.col("g0").alias("f0"), F.col("g1").alias("f1"), F.col("g0").bitwiseXOR(F.col("x0")).alias("p0"), F.col("g1").bitwiseXOR(F.col("x1")).alias("p1"), "words"), "members")
        if not rows.head(1):
            drop_stored(rows)
            return members, nodes
        depth, step = depth + step, max(1, depth + step)


def fold(texts: DataFrame, turns: DataFrame, members: DataFrame, nodes: DataFrame) -> DataFrame:
    """All nodes with parents, children, and the sums over their subtrees."""
    kids = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("p0").alias("f0"), F.col("p1").alias("f1")).agg(F.count("*").alias("kids"))
    alone = (F.col("n_seq") == 1) & (F.col("longest") > F.col("depth"))  # goes on in its own chain
    shared = stored(nodes.join(kids, KEY, "left").withColumn("n_children", F.when(alone, F.lit(1)).otherwise(F.coalesce("kids", F.lit(0))).cast("bigint")).drop("kids"), "shared")
    parents = shared.where("n_children > 0").select((F.col("depth") + 1).alias("depth"), F.col("f0").alias("p0"), F.col("f1").alias("p1"), F.col("name").alias("parent"), F.col("n_children").alias("size"))
    below = join_hot(shared.where("depth > 0"), parents, ["depth", "p0", "p1"])
    top = shared.where("depth = 0").withColumn("parent", F.lit(None).cast("bigint"))
    columns = ["name", "depth", "parent", "n_convs", "n_children", "words", "ender"]
    more = ["f0", "f1"]
    upper = below.select(*columns, *more).unionByName(top.select(*columns, *more))
    last = members.groupBy("rep").agg(F.max("depth").alias("last")).join(texts.select("rep", "weight", "n_turns"), "rep").where("n_turns > last")
    tails = join_hot(turns.withColumnRenamed("conv_id", "rep"), last.withColumn("size", F.col("n_turns")), ["rep"]).where("depth > last")
    ends = F.col("n_turns") == F.col("depth")
    tails = tails.select(F.col("rep").alias("name"), "depth", F.col("rep").alias("parent"), F.col("weight").alias("n_convs"), (~ends).cast("bigint").alias("n_children"), "words", F.when(ends, F.col("rep")).alias("ender"))
    for c in more:
        tails = tails.withColumn(c, F.lit(None).cast("bigint"))
    every = upper.unionByName(tails).withColumn("saved", (F.col("n_convs") - 1) * F.col("words")).withColumn("leaf", (F.col("n_children") == 0).cast("bigint")).withColumn("up", -F.col("depth"))
    every = stored(scan(every, ["name"], ["up"], {"saved_below": ("sum", F.col("saved")), "leaves_below": ("sum", F.col("leaf"))}), "paths")
    total = stored(every.groupBy(F.col("name").alias("rep")).agg(F.sum("saved").alias("saved_all"), F.sum("leaf").alias("leaves_all")), "totals")
    # what all members own, but for the namesake, of whom only what lies below counts
    around = members.select("rep", *KEY).join(total, "rep").groupBy(*KEY).agg(F.sum("saved_all").alias("saved_in"), F.sum("leaves_all").alias("leaves_in"))
    inner = every.where("f0 is not null").join(around, KEY).join(total.withColumnRenamed("rep", "name"), "name")
    inner = inner.withColumn("saved_below", F.expr("saved_below + saved_in - saved_all")).withColumn("leaves_below", F.expr("leaves_below + leaves_in - leaves_all"))
    out = inner.select(*columns, "saved_below", "leaves_below").unionByName(every.where("f0 is null").select(*columns, "saved_below", "leaves_below"))
    done = texts.select(F.col("rep").alias("ender"), "ends")
    return out.join(done, "ender", "left").select(
        F.col("name").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children", F.col("leaves_below").alias("n_leaves"), F.col("saved_below").alias("saved_tokens"),
        F.coalesce("ends", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )


def prefix_trie(conversations: DataFrame, family: int = 20, most: int = 4) -> DataFrame:
    """The trie's nodes over the rebuilt conversations (see :func:`rebuilt`; ``most=1`` leaves them as they are)."""
    each, turns = rebuilt(own_turns(conversations), family, most)
    texts = distinct_texts(each, turns)
    turns = stored(turns.join(texts.select(F.col("rep").alias("conv_id")), "conv_id", "left_semi"), "turns")
    return fold(texts, turns, *refine(texts, turns))
