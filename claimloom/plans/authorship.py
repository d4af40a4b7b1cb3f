"""Contributors: memberships, networks, orders, time lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from claimloom.functions import text as tx
from claimloom.functions import values as vl
from claimloom.operators.relational import class_links, classes, in_pairs, join_hot, member_weights
from claimloom.sources.scratch import stored

LEVELS = ["lead", "equal", "supporting"]


def affiliated(people: DataFrame, affiliations: DataFrame) -> DataFrame:
    """People's affiliation ids resolved in their order; an unknown id stands for its own name."""
    ids = people.select("person", F.posexplode("affiliations").alias("ord", "id"))
    named = ids.join(affiliations.select("id", "name"), "id", "left").select("person", "ord", F.coalesce("name", "id").alias("name"))
    return named.groupBy("person").agg(F.transform(F.array_sort(F.collect_list(F.struct("ord", "name"))), lambda x: x["name"]).alias("institutions"))


def institutions(people: DataFrame, none: str = "__none__") -> DataFrame:
    """Institution and its members; people without one share a bucket."""
    return people.select("person", F.explode_outer("institutions").alias("i")).groupBy(F.coalesce("i", F.lit(none)).alias("institution")).agg(F.array_sort(F.collect_set("person")).alias("members"))


def institution_count(people: DataFrame) -> DataFrame:
    return people.select(F.explode("institutions").alias("i")).agg(F.count_distinct("i").alias("n_institutions"))


def role_members(people: DataFrame, roles: DataFrame) -> DataFrame:
    """Members of each role of the list (role_ord, role); empty roles go."""
    held = people.select("person", F.explode("roles").alias("r")).select("person", tx.fold_role("r").alias("folded"))
    return roles.withColumn("folded", tx.fold_role("role")).join(held, "folded").groupBy("role_ord", "role").agg(F.array_sort(F.collect_set("person")).alias("members"))


def section_and_figure_members(sections: DataFrame, figures: DataFrame) -> DataFrame:
    grouped = lambda df, c, kind: df.groupBy(F.col(c).alias("item")).agg(F.array_sort(F.collect_set("person")).alias("members")).withColumn("kind", F.lit(kind))
    return grouped(sections, "section", "section").unionByName(grouped(figures, "figure", "figure"))


def memberships(people: DataFrame, sections: DataFrame) -> DataFrame:
    """Distinct ``(ord, g)``: the roles and sections of each person, by the person's place in the list."""
    roles = people.select("ord", F.explode("roles").alias("g")).select("ord", F.concat(F.lit("role:"), tx.fold_role("g")).alias("g"))
    parts = sections.join(people.select("person", "ord"), "person").select("ord", F.concat(F.lit("section:"), "section").alias("g"))
    return roles.unionByName(parts).distinct()


def network(people: DataFrame, sections: DataFrame, block: int = 2_000) -> DataFrame:
    """Author pairs with the numbers of shared roles and sections; ``ord`` is the person's place in the list."""
    pairs = in_pairs(memberships(people, sections), "g", "ord", block)
    ends = [F.least("a_ord", "b_ord").alias("i"), F.greatest("a_ord", "b_ord").alias("j")]
    pairs = pairs.groupBy(*ends).agg(F.count_if(F.col("g").startswith("role:")).alias("shared_roles"), F.count_if(F.col("g").startswith("section:")).alias("shared_sections"))
    return pairs.withColumn("weight", F.col("shared_roles") + F.col("shared_sections"))


def network_totals(people: DataFrame, sections: DataFrame, block: int = 2_000) -> tuple[DataFrame, DataFrame]:
    """What :func:`node_totals` and :func:`network_stats` tell, without the pairs of people: ``(ord, weight, n_links)``, and one row.

    Weights follow from the sizes of groups. Links and the strongest pair follow from classes of people with the same roles and
    sections: of two classes that share any, all are linked alike, and so are all within one.
    """
    rows = stored(memberships(people, sections), "memberships")
    found, own = classes(rows, "g", "ord")
    links = stored(class_links(found, block), "class-links")
    ends = links.select(F.col("left_class").alias("class"), F.col("right_class").alias("other"), "shared").unionByName(links.select(F.col("right_class").alias("class"), F.col("left_class").alias("other"), "shared"))
    around = ends.join(found.select(F.col("class").alias("other"), "n"), "other").groupBy("class").agg(F.sum("n").alias("n_around"))
    degree = found.join(around, "class", "left").select("class", F.col("n").alias("size"), (F.coalesce("n_around", F.lit(0)) + F.col("n") - 1).alias("n_links"))
    nodes = member_weights(rows, "g", "ord").join(join_hot(own, degree, ["class"]).select("ord", "n_links"), "ord").where("n_links > 0")
    inner = found.where("n > 1").select(F.struct(F.size("groups").cast("bigint").alias("weight"), F.col("next").alias("i"), F.col("top").alias("j")).alias("best"), (F.col("n") * (F.col("n") - 1) / 2).cast("bigint").alias("n"))
    side = lambda p: found.select(F.col("class").alias(f"{p}_class"), F.col("n").alias(f"{p}_n"), F.col("top").alias(f"{p}_top"))
    outer = links.join(side("left"), "left_class").join(side("right"), "right_class")
    outer = outer.select(F.struct(F.col("shared").alias("weight"), F.least("left_top", "right_top").alias("i"), F.greatest("left_top", "right_top").alias("j")).alias("best"), (F.col("left_n") * F.col("right_n")).alias("n"))
    told = inner.unionByName(outer).agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("n_links"), F.max("best").alias("best"))
    mean = people.agg(F.round(F.avg(F.size("roles")), 2).alias("mean_roles"))
    return nodes, mean.crossJoin(told).select("mean_roles", "n_links", F.struct("best.i", "best.j").alias("strongest"), F.col("best.weight").alias("weight"))


def network_stats(people: DataFrame, edges: DataFrame) -> DataFrame:
    """Mean number of roles, links and the strongest pair (the last of equals)."""
    top = F.struct("weight", "i", "j")
    return people.agg(F.round(F.avg(F.size("roles")), 2).alias("mean_roles")).crossJoin(edges.agg(F.count("*").alias("n_links"), F.max_by(F.struct("i", "j"), top).alias("strongest"), F.max("weight").alias("weight")))


def node_totals(edges: DataFrame) -> DataFrame:
    ends = edges.select(F.col("i").alias("ord"), "weight").unionByName(edges.select(F.col("j").alias("ord"), "weight"))
    return ends.groupBy("ord").agg(F.sum("weight").alias("weight"), F.count("*").alias("n_links"))


def by_level(people: DataFrame, levels: DataFrame, role: str) -> DataFrame:
    """People by their level in a role, then by last name; ``levels`` has (person, role, level)."""
    rank = vl.ladder([(F.col("level") == x, len(LEVELS) - i) for i, x in enumerate(LEVELS)], 0)
    held = levels.where(tx.fold_role("role") == tx.fold_role(F.lit(role))).groupBy("person").agg(F.max(rank).alias("rank"))
    return people.select("person").join(held, "person", "left").fillna(0, ["rank"]).orderBy(F.desc("rank"), tx.last_name("person"), "person")


def by_joining(people: DataFrame) -> DataFrame:
    """The earliest first; people without a date come last. Equal ones stay in the list's order (``ord``)."""
    return people.orderBy(F.coalesce("joined", F.lit("9999")), "ord")


def by_last_name(people: DataFrame) -> DataFrame:
    return people.orderBy(tx.last_name("person"), "ord")


def by_roles(people: DataFrame) -> DataFrame:
    """Those with the most roles first."""
    return people.orderBy(F.coalesce(F.size("roles"), F.lit(0)).desc(), "ord")


def affiliation_numbers(people: DataFrame) -> DataFrame:
    """Numbers of institutions in the order in which the list of people first names them."""
    first = people.select("ord", F.posexplode("institutions").alias("k", "institution")).groupBy("institution").agg(F.min(F.struct("ord", "k")).alias("first"))
    return first.select("institution", F.dense_rank().over(Window.orderBy("first")).alias("number"))


def timeline(people: DataFrame, until: str) -> DataFrame:
    """Bars in percent of the whole span; months are ``YYYY-MM``, people still there end at ``until``."""
    month = lambda c: F.to_date(F.concat(c, F.lit("-01")))
    rows = people.select("person", month(F.col("joined")).alias("a"), month(F.coalesce("left", F.lit(until))).alias("b")).where(F.col("a").isNotNull())
    whole = rows.agg(F.min("a").alias("low"), F.max("b").alias("high"))
    span = F.greatest(F.datediff("high", "low"), F.lit(1))
    return rows.crossJoin(F.broadcast(whole)).select("person", F.round(100 * F.datediff("a", "low") / span, 3).alias("left_percent"), F.round(100 * F.datediff("b", "a") / span, 3).alias("width_percent"))


def matches(people: DataFrame, query: str) -> DataFrame:
    """People whose name, roles or institutions hold the text."""
    q = F.lower(F.lit(query))
    held = lambda c: F.exists(c, lambda x: F.contains(F.lower(x), q))
    return people.where(F.contains(F.lower("person"), q) | held("roles") | held("institutions"))
