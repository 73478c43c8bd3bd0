"""Ordered work over groups of any size: ranges of a group, scans within them, and carries between them.

A running sum, a number, a neighbour or the last known value needs a group in order, but no task needs the
whole group. `ranges` cuts each group that holds more than about `ROWS` rows in ranges of its order
with about so many each; `scan` runs windows within the ranges, gathers what a range hands to the next
ones (its sums, last values, first row) in a small table, scans that table, and joins it back. Groups of
a single range need no carry: where all are, the plan is one plain window."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tracewell.sources.scratch import saved

ROWS = 1 << 18  # rows of a range, about
CELLS = 16  # cells that are counted for a range
TASK = 1 << 19  # rows that a task sorts, about, where their number follows the input
AT_ONCE = 1 << 16  # rows of whole groups that a task works on at once, about


def met(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join on the columns `keys` of both sides, where a null is a value like any other. The left
    side's stay."""
    if not keys:
        return left.join(right, F.lit(True), how)  # one group a side
    named = {k: f"_met_{k}" for k in keys}
    on = [F.col(k).eqNullSafe(F.col(n)) for k, n in named.items()]
    return left.join(right.withColumnsRenamed(named), on, how).drop(*named.values())


def tasks_of(df: DataFrame) -> int | None:
    """Tasks of about TASK rows for a table, where the session's number of partitions would make larger ones; so what
    a task holds doesn't grow with the table. Counts the table."""
    tasks = -(-df.count() // TASK)
    return tasks if tasks > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else None


def ranges(df: DataFrame, keys: list[str], order: str, rows: int | None = None, of: DataFrame | None = None) -> tuple[DataFrame, bool]:
    """Adds `_cut`, the number of each row's range in its group, ascending with the number `order`; and
    whether any group has more than one. Equal values of `order` stay together. Large groups are counted
    by fine cells of `order`, and neighbouring cells make a range. Groups are counted first, which reads
    `df` once more, or `of`, a table that is cheaper to read and has no fewer rows a group."""
    rows = rows or ROWS
    at = F.col(order).cast("double")
    spans = (df if of is None else of).groupBy(*keys).agg(F.min(at).alias("_cut_lo"), F.max(at).alias("_cut_hi"), F.count("*").alias("_cut_rows")).where(F.col("_cut_rows") > rows)
    if spans.isEmpty():
        return df.withColumn("_cut", F.lit(0).cast("long")), False
    spans = saved(spans, "spans").withColumn("_cut_cells", F.ceil(CELLS * F.col("_cut_rows") / rows)).withColumn("_cut_step", (F.col("_cut_hi") - F.col("_cut_lo")) / F.col("_cut_cells"))
    cell = F.least(F.col("_cut_cells") - 1, F.floor(F.try_divide(at - F.col("_cut_lo"), F.col("_cut_step"))))
    placed = met(df, spans.drop("_cut_rows", "_cut_hi"), keys, "left").withColumn("_cut_cell", F.coalesce(cell, F.lit(0))).drop("_cut_lo", "_cut_cells", "_cut_step")
    counts = placed.groupBy(*keys, "_cut_cell").agg(F.count("*").alias("_cut_n"))
    before = F.sum("_cut_n").over(Window.partitionBy(*keys).orderBy("_cut_cell").rowsBetween(Window.unboundedPreceding, -1))
    cuts = saved(counts.select(*keys, "_cut_cell", F.floor(F.coalesce(before, F.lit(0)) / rows).alias("_cut")), "ranges")
    return met(placed, cuts, [*keys, "_cut_cell"]).drop("_cut_cell"), True


def scan(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    many: bool,
    number: str | None = None,
    sums: dict[str, Column] | None = None,
    lasts: dict[str, Column] | None = None,
    nexts: dict[str, Column] | None = None,
    previous: dict[str, Column] | None = None,
    following: dict[str, Column] | None = None,
) -> DataFrame:
    """Adds columns that follow from a group's order; `df` is as `ranges` gives it. `number`: the row's
    number from 1; `sums`: sum up to the row; `lasts`: last value up to the row that isn't null; `nexts`:
    first one from the row on; `previous` and `following`: the neighbouring row's value, null at the
    ends. `order` should leave no ties; it begins with the column that `ranges` has cut by."""
    sums = ({number: F.lit(1).cast("long")} if number else {}) | (sums or {})
    lasts, nexts, previous, following = lasts or {}, nexts or {}, previous or {}, following or {}
    by = [*keys, "_cut"]
    on, back = Window.partitionBy(*by).orderBy(*order), Window.partitionBy(*by).orderBy(*[F.desc(c) for c in order])
    upto, onward = on.rowsBetween(Window.unboundedPreceding, 0), back.rowsBetween(Window.unboundedPreceding, 0)
    # From the row on, read backwards: a frame that grows by a row costs a row.
    out = df.withColumns({c: F.last(v, ignorenulls=True).over(onward) for c, v in nexts.items()}) if nexts else df
    forward = {c: F.coalesce(F.sum(v).over(upto), F.lit(0)) for c, v in sums.items()} | {c: F.last(v, ignorenulls=True).over(upto) for c, v in lasts.items()}
    forward |= {c: F.lag(v).over(on) for c, v in previous.items()} | {c: F.lead(v).over(on) for c, v in following.items()}
    if many and (previous or following):
        forward |= {"_first": F.lag(F.lit(1)).over(on).isNull(), "_final": F.lead(F.lit(1)).over(on).isNull()}
    out = out.withColumns(forward) if forward else out
    if not many:
        return out.drop("_cut")
    place = F.struct(*order)
    known = lambda f, v: f(F.struct(v.alias("v")), F.when(v.isNotNull(), place))  # noqa: E731  of the rows that have a value
    gathered = [F.sum(v).alias(f"_c_{c}") for c, v in sums.items()]
    gathered += [known(F.max_by, v).alias(f"_c_{c}") for c, v in lasts.items()] + [known(F.min_by, v).alias(f"_c_{c}") for c, v in nexts.items()]
    gathered += [F.max_by(F.struct(v.alias("v")), place).alias(f"_c_{c}") for c, v in previous.items()] + [F.min_by(F.struct(v.alias("v")), place).alias(f"_c_{c}") for c, v in following.items()]
    handed = df.groupBy(*by).agg(*gathered)  # a row a range
    row, behind = Window.partitionBy(*keys).orderBy("_cut"), Window.partitionBy(*keys).orderBy(F.desc("_cut"))
    ahead, rest = row.rowsBetween(Window.unboundedPreceding, -1), behind.rowsBetween(Window.unboundedPreceding, -1)
    carried = {c: F.coalesce(F.sum(f"_c_{c}").over(ahead), F.lit(0)) for c in sums} | {c: F.last(f"_c_{c}", ignorenulls=True).over(ahead).getField("v") for c in lasts}
    carried |= {c: F.last(f"_c_{c}", ignorenulls=True).over(rest).getField("v") for c in nexts} | {c: F.lag(f"_c_{c}").over(row).getField("v") for c in previous} | {c: F.lead(f"_c_{c}").over(row).getField("v") for c in following}
    carry = saved(handed.select(*by, *[v.alias(f"_c_{c}") for c, v in carried.items()]), "carries")
    out = met(out, carry, by)
    whole = {c: F.col(c) + F.col(f"_c_{c}") for c in sums} | {c: F.coalesce(F.col(c), F.col(f"_c_{c}")) for c in (*lasts, *nexts)}
    whole |= {c: F.when(F.col(at), F.col(f"_c_{c}")).otherwise(F.col(c)) for at, cs in (("_first", previous), ("_final", following)) for c in cs}
    return out.withColumns(whole).drop("_cut", "_first", "_final", *[f"_c_{c}" for c in carried])


def together(df: DataFrame, keys: list[str], work: Callable[[pa.Table, np.ndarray], pa.Table], schema: StructType, order: list[str] | None = None) -> DataFrame:
    """What `work` makes of tables that hold whole groups, some AT_ONCE rows of them; it gets the table, with the rows
    of a group side by side (by `order`), and the number of each group's first row. One shuffle and one sort serve
    all groups, and none costs a call of its own. A task holds its largest group, so it is for groups of a bounded
    size (`by_size`)."""
    at_once = AT_ONCE

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for b in batches:
            held.append(b)
            if sum(h.num_rows for h in held) < at_once:
                continue
            table = pa.Table.from_batches(held).combine_chunks()
            firsts = _firsts(table, keys)
            if firsts[-1]:  # the last group may go on
                yield from work(table.slice(0, firsts[-1]), firsts[:-1]).to_batches()
            held = table.slice(firsts[-1]).to_batches()
        if sum(h.num_rows for h in held):
            table = pa.Table.from_batches(held).combine_chunks()
            yield from work(table, _firsts(table, keys)).to_batches()

    return df.repartition(*keys).sortWithinPartitions(*keys, *(order or [])).mapInArrow(run, schema)


def _firsts(table: pa.Table, keys: list[str]) -> np.ndarray:
    """Numbers of the rows whose keys differ from those of the row before; nulls, and NaNs, are equal."""
    new = np.zeros(table.num_rows, bool)
    new[0] = True
    for k in keys:
        c = table.column(k)
        a, b = c.slice(1), c.slice(0, table.num_rows - 1)
        other = pc.coalesce(pc.not_equal(a, b), pc.xor(pc.is_null(a), pc.is_null(b)))
        if pa.types.is_floating(c.type):
            other = pc.and_not(other, pc.coalesce(pc.and_(pc.is_nan(a), pc.is_nan(b)), pa.scalar(False)))
        new[1:] |= other.to_numpy()
    return np.flatnonzero(new)


def by_size(df: DataFrame, keys: list[str], most: int, alone: Callable[[DataFrame], DataFrame], spread: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """`alone` of the groups of up to `most` rows, `spread` of larger ones. Groups are counted first."""
    if not keys:
        return spread(df)
    large = saved(df.groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") > most).drop("_n"), "large-groups")
    if large.isEmpty():
        return alone(df)
    return alone(met(df, large, keys, "left_anti")).unionByName(spread(met(df, large, keys, "left_semi")))
