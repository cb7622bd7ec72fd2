"""Tables between steps of an operator, and numbering of whole tables."""

from __future__ import annotations

import tempfile
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Rows that one task sorts; tables of few rows are dealt more finely, for as many tasks as the session has shuffle partitions.
PART_ROWS, FEW_ROWS = 200_000, 10_000


def kept(df: DataFrame) -> DataFrame:
    """``df`` written once to the folder that the session names in spark.checkpoint.dir, without its lineage.

    Where that is unset a local folder is made, which only a local session can use; any other
    session is refused.
    """
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        named = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not named and not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="attestry-"))
    return df.checkpoint(eager=True)


def parts_for(spark: SparkSession, n: int) -> int:
    """So many parts has a table of ``n`` rows that is dealt anew."""
    return max(1, -(-n // PART_ROWS), min(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n // FEW_ROWS)))


def ordinal(rows: DataFrame, order: list[str], name: str = "seq") -> DataFrame:
    """``rows`` numbered from 1 in ``order``, whose columns must tell all rows apart.

    Rows are written, dealt and sorted by range and written again; a row's number is its place in
    its part and the count of rows in the parts before, one number a part. A part has about
    ``PART_ROWS`` at most, so what one task sorts does not grow with the table.
    """
    held = kept(rows)
    parts = parts_for(rows.sparkSession, held.count())
    placed = kept(held.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()))
    part, place = F.shiftright("_at", 33), F.col("_at").bitwiseAND((1 << 33) - 1)
    sizes = sorted(placed.groupBy(part.alias("part")).count().collect())
    starts, before = [], 0
    for p, n in sizes:
        starts.append((p, before))
        before += n
    table = F.broadcast(rows.sparkSession.createDataFrame(starts, "_part long, _start long"))
    return placed.withColumn("_part", part).join(table, "_part").withColumn(name, F.col("_start") + place + 1).drop("_part", "_start", "_at")


def whole(dealt: DataFrame) -> DataFrame:
    """``dealt``, of which every reader takes all columns.

    So Spark sees one exchange in the steps of a plan that read the same table for different columns,
    and writes it once. The condition is always true; being nondeterministic it stays where it is.
    """
    used = F.xxhash64(*(F.size(c) if kind.startswith("map") else F.col(c) for c, kind in dealt.dtypes))
    return dealt.where(used % 2 <= F.monotonically_increasing_id() + 1)


def cuts(rows: DataFrame, key: str) -> list[int]:
    """Values of ``key`` (whole numbers) that part ``rows`` into about equal ranges of ``PART_ROWS`` at most."""
    parts = parts_for(rows.sparkSession, rows.count())
    return sorted({int(x) for x in rows.approxQuantile(key, [k / parts for k in range(1, parts)], 1 / (4 * parts))}) if parts > 1 else []


def part_of(key: Column, at: list[int]) -> Column:
    """The range between cuts that ``key`` lies in, by bisection."""

    def among(low: int, high: int) -> Column:
        mid = (low + high) // 2
        return F.lit(low) if low == high else F.when(key < at[mid], among(low, mid)).otherwise(among(mid + 1, high))

    return among(0, len(at))


def ranged(rows: DataFrame, key: str, at: list[int]) -> DataFrame:
    """``rows`` dealt by ranges of ``key``, a partition a range; the order within is open."""
    return whole(rows.repartitionById(len(at) + 1, part_of(F.col(key), at)))


def in_sequence(tables: list[tuple[Callable[[bool], DataFrame], Column]], name: str = "seq") -> DataFrame:
    """All rows of ``tables`` numbered from 1, table by table, without a copy of them.

    A table is a function and the range that a row lies in. The function gives rows in the
    partitions of ``ranged``, in order if it is told so; they are made twice, first to be counted by
    range. A row's number is its place in its range and the count of rows in the ranges before.
    """
    sizes = [rows(False).groupBy(part.alias("_part")).count().select(F.lit(k).alias("_table"), "_part", "count") for k, (rows, part) in enumerate(tables)]
    before = F.sum("count").over(Window.orderBy("_table", "_part").rowsBetween(Window.unboundedPreceding, -1))
    starts = _united(sizes).select("_table", "_part", F.coalesce(before, F.lit(0)).alias("_start"))
    place = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    placed = [rows(True).withColumn("_at", place).withColumns({"_part": part, "_table": F.lit(k)}) for k, (rows, part) in enumerate(tables)]
    numbered = [p.join(F.broadcast(starts), ["_table", "_part"]).withColumn(name, F.col("_start") + F.col("_at") + 1).drop("_table", "_part", "_start", "_at") for p in placed]
    return _united(numbered)


def _united(tables: list[DataFrame]) -> DataFrame:
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t)
    return out
