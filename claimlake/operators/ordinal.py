"""Global row numbers and running totals without putting all rows, or all of a large group, in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import materialise


def with_ordinal(rows: DataFrame, keys: list[Column], name: str) -> DataFrame:
    """Adds 1, 2, ... in the order of the keys, which must be total: rows are range-partitioned, numbered within their
    partition, and moved up by the sizes of the partitions before it, of which there are as many as partitions. All columns are sorted
    along, so rows should have few."""
    dealt = materialise(rows.repartitionByRange(*keys).withColumn("__part", F.spark_partition_id()), "ordinal")
    sizes = dealt.groupBy("__part").agg(F.count(F.lit(1)).alias("__size"))
    before = sizes.select("__part", (F.sum("__size").over(Window.orderBy("__part")) - F.col("__size")).alias("__before"))
    numbered = dealt.withColumn("__local", F.row_number().over(Window.partitionBy("__part").orderBy(*keys)))
    return numbered.join(F.broadcast(before), "__part").withColumn(name, F.col("__before") + F.col("__local")).drop("__part", "__local", "__before")


def _dealt(rows: DataFrame, by: str, order: list[str]) -> DataFrame:
    """Rows range-partitioned by group and order, with the number of their part: a large group is dealt over several, in order."""
    return materialise(rows.repartitionByRange(by, *order).withColumn("__part", F.spark_partition_id()), "dealt")


def _of_part(by: str, to: str) -> Column:
    return F.col(by).eqNullSafe(F.col(to)) & (F.col("__part") == F.col("__of"))


def running_total(rows: DataFrame, by: str, order: list[str], value: Column, name: str) -> DataFrame:
    """Adds the running sum of a value in each group, up to and with the row; the order must be total.

    Groups of any size are dealt over several tasks; a part starts from the sums of the group's parts before it, of which there are as many as partitions and groups.
    Rows travel with all their columns, so they should have few.
    """
    dealt = _dealt(rows.withColumn("__value", value), by, order)
    sums = dealt.groupBy(by, "__part").agg(F.sum("__value").alias("__sum"))
    before = F.sum("__sum").over(Window.partitionBy(by).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    starts = sums.select(F.col(by).alias("__by"), F.col("__part").alias("__of"), F.coalesce(before, F.lit(0)).alias("__before"))
    local = F.sum("__value").over(Window.partitionBy("__part", by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    met = dealt.withColumn("__local", local).join(starts, _of_part(by, "__by"))
    return met.withColumn(name, F.col("__before") + F.col("__local")).drop("__value", "__part", "__local", "__by", "__of", "__before")


def with_previous(rows: DataFrame, by: str, order: list[str], value: str, previous: str, number: str) -> DataFrame:
    """Adds the row's number in its group, from 1, and a value of the row before it, null for the first; the order must be total.

    As running_total: parts of a group get the count of the parts before them, and the last value of the nearest one.
    """
    dealt = _dealt(rows, by, order)
    last = F.max_by(F.struct(value), F.struct(*order)).alias("__last")
    sums = dealt.groupBy(by, "__part").agg(F.count(F.lit(1)).alias("__n"), last)
    earlier = Window.partitionBy(by).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(F.col(by).alias("__by"), F.col("__part").alias("__of"), F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before"), F.last("__last").over(earlier).alias("__carried"))
    local = Window.partitionBy("__part", by).orderBy(*order)
    met = dealt.withColumns({"__local": F.row_number().over(local), "__own": F.lag(value).over(local)}).join(starts, _of_part(by, "__by"))
    found = F.when(F.col("__local") > 1, F.col("__own")).otherwise(F.col(f"__carried.{value}"))
    return met.withColumns({number: F.col("__before") + F.col("__local"), previous: found}).drop("__part", "__local", "__own", "__by", "__of", "__before", "__carried")


def rolling_mean(rows: DataFrame, order: list[str], value: Column, size: int, name: str) -> DataFrame:
    """Adds the mean of a value over the row and the size - 1 rows before it, of all rows in a total order.

    Rows are range-partitioned by the order; each part gets the last size - 1 rows before it as a halo, which come from as many parts as are needed, and no part is held by one row of another.
    """
    dealt = materialise(rows.withColumn("__value", value).repartitionByRange(*order).withColumn("__part", F.spark_partition_id()), "rolling")
    sizes = [(r["__part"], r["n"]) for r in dealt.groupBy("__part").agg(F.count(F.lit(1)).alias("n")).orderBy("__part").collect()]
    # (part, part whose last rows it needs, how many): as many as partitions, and a few more where parts are small
    needs = []
    for i, (part, _) in enumerate(sizes):
        missing = size - 1
        for other, n in reversed(sizes[:i]):
            if missing <= 0:
                break
            needs.append((part, other, min(missing, n)))
            missing -= n
    own = dealt.withColumns({"__to": F.col("__part"), "__halo": F.lit(False)})
    if needs:
        backwards = F.row_number().over(Window.partitionBy("__part").orderBy(*(F.desc(c) for c in order)))
        tails = dealt.withColumn("__back", backwards).where(F.col("__back") < size)
        table = rows.sparkSession.createDataFrame(needs, "__to int, __from int, __most int")
        halo = tails.join(F.broadcast(table), (F.col("__part") == F.col("__from")) & (F.col("__back") <= F.col("__most"))).withColumn("__halo", F.lit(True))
        own = own.unionByName(halo.select(own.columns))
    frame = Window.partitionBy("__to").orderBy(*order).rowsBetween(1 - size, 0)
    return own.withColumn(name, F.avg("__value").over(frame)).where(~F.col("__halo")).drop("__value", "__part", "__to", "__halo")
