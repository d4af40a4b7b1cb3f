"""Nested trees of any depth as rows, level by level.

A document is JSON text whose nodes hold their children in an array. Each level's nodes are a stored table; the next level is one
explode of it, until a level is empty, so a depth needn't be known and the plan of a level doesn't hold those above it. A row is
known by its path, the places of its ancestors and its own; paths in their order are the nodes as a reader meets them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from claimloom.operators.scans import numbered
from claimloom.sources.scratch import stored


def tree_rows(documents: DataFrame, ident: str, text: str, fields: dict[str, str] | None = None, children: str = "children") -> DataFrame:
    """``(ident, path, depth, kind, value, n_children)`` of all nodes; ``fields`` names further members to be read as text.

    Text that isn't JSON, or null, has no node; a node that is no object is one without kind and children. Children that aren't
    an array are none. The root's path is empty.
    """
    read = {"kind": "type", "value": "value"} | (fields or {})
    held = F.col("node")
    kids = F.try_variant_get(held, f"$.{children}", "array<variant>")
    flat = [*[F.try_variant_get(held, f"$.{name}", "string").alias(c) for c, name in read.items()], F.coalesce(F.size(kids), F.lit(0)).alias("n_children")]
    # (the explode keeps the filter on the node from parsing, and making, each text a second time)
    level = documents.select(ident, F.array().cast("array<int>").alias("path"), F.explode(F.array(F.try_parse_json(text))).alias("node")).where("node is not null")
    out, depth = None, 0
    while True:
        level = stored(level.select(ident, "path", *flat, F.when(F.size(kids) > 0, kids).alias("kids")), "tree-level")
        if depth and not level.head(1):
            return out
        rows = level.select(ident, "path", F.lit(depth).alias("depth"), *read, "n_children")
        out = rows if out is None else out.unionByName(rows)
        level = level.select(ident, "path", F.posexplode("kids").alias("i", "node")).select(ident, F.concat("path", F.array("i")).alias("path"), "node")
        depth += 1


def widths(rows: DataFrame) -> DataFrame:
    """``(depth, n, most_children)``: how wide the trees are at each depth."""
    return rows.groupBy("depth").agg(F.count("*").alias("n"), F.max("n_children").alias("most_children"))


def in_order(rows: DataFrame, ident: str, chosen: Column, name: str) -> DataFrame:
    """The ``chosen`` nodes with their place (``name``, from 1) as a document's reader meets them."""
    return numbered(rows.where(chosen), [ident], ["path"], name)


def text_content(rows: DataFrame, ident: str, under: str | None = None) -> DataFrame:
    """``(ident, under, text)``: the values below each node of kind ``under`` (below the root without one), joined in order.

    The nearest such ancestor counts. A node's text is one row, so it is as large as what it says.
    """
    if under is None:
        owned = rows.withColumn("under", F.array().cast("array<int>"))
    else:
        tops = rows.where(F.col("kind") == under).select(F.col(ident).alias("_ident"), F.col("path").alias("under"))
        above = F.transform(F.sequence(F.lit(0), F.size("path")), lambda n: F.slice("path", 1, n))
        each = rows.select(ident, "path", "value", F.explode(above).alias("under"))
        met = each.join(tops, (F.col(ident) == F.col("_ident")) & each["under"].eqNullSafe(tops["under"])).select(ident, "path", "value", each["under"])
        owned = met.groupBy(ident, "path").agg(F.max_by("value", F.size("under")).alias("value"), F.max_by("under", F.size("under")).alias("under"))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("path", "value"))), lambda x: x["value"]), "")
    return owned.where("value is not null").groupBy(ident, "under").agg(joined.alias("text"))


def sibling_before(rows: DataFrame, ident: str, wanted: Column, barrier: Column, name: str) -> DataFrame:
    """``name``: the path of the nearest earlier ``wanted`` sibling, with no ``barrier`` from there up to the node.

    Siblings come from one array of one document, so each document's nodes are dealt to one task and a window's frame runs through
    them; large groups spill.
    """
    parent = F.when(F.size("path") > 0, F.slice("path", 1, F.greatest(F.size("path") - 1, F.lit(0))))  # the root has none
    placed = rows.withColumn("_parent", parent).withColumn("_at", F.coalesce(F.try_element_at("path", F.lit(-1)), F.lit(0)))
    w = Window.partitionBy(ident, "_parent").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    box = F.when(wanted, F.struct(F.lit(True).alias("ok"), F.col("_at").alias("at"))).when(barrier, F.struct(F.lit(False).alias("ok"), F.lit(None).cast("int").alias("at")))
    held = placed.repartition(ident).withColumn("_box", F.last(box, ignorenulls=True).over(w))
    about = F.when(F.col("_box.ok") & ~F.coalesce(barrier, F.lit(False)), F.when(F.size("path") > 0, F.concat("_parent", F.array("_box.at"))))
    return held.withColumn(name, about).drop("_parent", "_at", "_box")
