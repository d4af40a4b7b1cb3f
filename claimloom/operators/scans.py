"""Running sums, maxima, last values and places in groups of any size, by prefix scans on two levels.

Rows are dealt by range of (keys, order), so that parts are of like size, and every part is a run of the sorted rows. Within a
part a window makes the running values; what a group carries from its earlier parts comes from the totals of those parts. A
group that holds a third of all rows is as many tasks as it fills parts. A part continues at most one group, so there is one
carried row for each part at most, which is what bounds the broadcast.

``order`` (column names) tells the rows of a group apart; rows that don't differ in it come in any order, and stay in one part.
Nulls are first, as in Spark's sorts, and null keys are a group. The input's columns stay as they are; names that begin with
``_scan`` are refused. An empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from claimloom.sources.scratch import stored

KINDS = ("sum", "max", "min", "last")


def in_parts(rows: DataFrame, keys: list[str], order: list[str], parts: int | None = None) -> DataFrame:
    """``rows`` with ``_scan_part``, which rises with (keys, order); a stored table, so that it stays what it is."""
    if taken := [c for c in rows.columns if c.startswith("_scan")]:
        raise ValueError(f"columns {taken} clash with those of the scan")
    columns = [*keys, *order]
    dealt = rows.repartitionByRange(parts, *columns) if parts else rows.repartitionByRange(*columns)
    return stored(dealt.withColumn("_scan_part", F.spark_partition_id()), "scan-parts")


def _same(left: list[str], right: list[str]) -> Column:
    out = F.lit(True)
    for a, b in zip(left, right):
        out = out & F.col(a).eqNullSafe(F.col(b))
    return out


def scan(rows: DataFrame, keys: list[str], order: list[str], values: dict[str, tuple[str, Column]], before: bool = False, parts: int | None = None) -> DataFrame:
    """``rows`` and, for each name in ``values``, a running value of its column: ``sum``, ``max``, ``min`` or ``last`` non-null.

    The row itself counts, with ``before`` only those before it (a sum of none is 0, others are null). Nulls are passed over.
    """
    if bad := [k for k, _ in values.values() if k not in KINDS]:
        raise ValueError(f"no such scan: {bad}")
    for i, (_, column) in enumerate(values.values()):
        rows = rows.withColumn(f"_s{i}", column)
    held = in_parts(rows, keys, order, parts)
    group = [*keys, "_scan_part"]
    w = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1 if before else 0)
    earlier = Window.partitionBy(*keys).orderBy("_scan_part").rowsBetween(Window.unboundedPreceding, -1)
    run = {"sum": F.sum, "max": F.max, "min": F.min, "last": lambda c: F.last(c, ignorenulls=True)}
    # the last value of a part is the one of the greatest place; (a struct of the order compares as the order does)
    place = F.struct(*order)
    totals, carried, local = [], [], []
    for i, (kind, _) in enumerate(values.values()):
        column = F.col(f"_s{i}")
        totals.append((F.max_by(column, F.when(column.isNotNull(), place)) if kind == "last" else run[kind](column)).alias(f"_t{i}"))
        carried.append(run[kind](f"_t{i}").over(earlier).alias(f"_scan{i}"))
        local.append(run[kind](column).over(w))
    of_parts = held.groupBy(*group).agg(*totals).select(*group, F.lag(F.lit(True)).over(Window.partitionBy(*keys).orderBy("_scan_part")).alias("_more"), *carried)
    names = [f"_scan_k{i}" for i in range(len(group))]
    carry = stored(of_parts.where("_more").select(*[F.col(c).alias(n) for c, n in zip(group, names)], *[f"_scan{i}" for i in range(len(values))]), "scan-carry")
    out = held
    for i, column in enumerate(local):
        out = out.withColumn(f"_l{i}", column)
    out = out.join(F.broadcast(carry), _same(group, names), "left")  # a row for each part at most
    for i, (name, (kind, _)) in enumerate(values.items()):
        a, b = F.col(f"_l{i}"), F.col(f"_scan{i}")
        whole = {"sum": F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0)), "max": F.greatest(a, b), "min": F.least(a, b), "last": F.coalesce(a, b)}[kind]
        out = out.withColumn(f"_v{i}", whole)
    spare = [f"_{x}{i}" for x in "sl" for i in range(len(values))] + [f"_scan{i}" for i in range(len(values))]
    out = out.drop("_scan_part", *names, *spare, *[c for c in values if c in rows.columns])
    return out.withColumnsRenamed({f"_v{i}": name for i, name in enumerate(values)})


def numbered(rows: DataFrame, keys: list[str], order: list[str], name: str, parts: int | None = None) -> DataFrame:
    """``name``: each row's place in its group, from 1."""
    return scan(rows, keys, order, {name: ("sum", F.lit(1).cast("bigint"))}, parts=parts)


def anchored(rows: DataFrame, keys: list[str], order: list[str], wanted: Column, barrier: Column, value: Column, name: str, parts: int | None = None) -> DataFrame:
    """``name``: ``value`` of the nearest earlier ``wanted`` row of the group with no ``barrier`` row from there up to this one.

    A row that is both is a barrier for what lies before it and an anchor for what follows.
    """
    boxed = F.when(wanted, F.struct(F.lit(True).alias("ok"), value.alias("v"))).when(barrier, F.struct(F.lit(False).alias("ok"), F.lit(None).alias("v")))
    held = scan(rows, keys, order, {"_box": ("last", boxed)}, before=True, parts=parts)
    return held.withColumn(name, F.when(F.col("_box.ok") & ~F.coalesce(barrier, F.lit(False)), F.col("_box.v"))).drop("_box")


def sessions(rows: DataFrame, keys: list[str], order: str, gap: Column | float, name: str, parts: int | None = None) -> DataFrame:
    """``name``: number of the row's run in its group, from 1; a run ends where ``order`` (a number) leaps by more than ``gap``."""
    steps = scan(rows, keys, [order], {"_prev": ("last", F.col(order))}, before=True, parts=parts)
    new = F.col("_prev").isNull() | (F.col(order) - F.col("_prev") > gap)
    return scan(steps.withColumn("_new", new.cast("bigint")).drop("_prev"), keys, [order], {name: ("sum", F.col("_new"))}, parts=parts).drop("_new")
