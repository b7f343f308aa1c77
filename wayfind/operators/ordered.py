"""Order within groups that may be hot: previous rows, running totals, first rows that reach a limit, chains in time, order statistics.

A group's rows never meet in one task. They are cut into slices of their order (seconds, hours, ranges
of values); what a slice needs to know of those before comes from a table of one row per slice and
group, and is added to the slice's rows as one more row that comes first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wayfind.sources.scratch import discard, materialise, step

#: Values of a range of an order statistic that are told apart in one step, as a power of two.
DIGIT = 10


def micros(ts: Column) -> Column:
    """Microseconds since 1970 of a timestamp without time zone."""
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), ts)


def product(left: DataFrame, right: DataFrame, salts: int = 64) -> DataFrame:
    """Every row of left with every row of right, a smaller table: right goes to each of `salts` parts, left is dealt over them by its rows, so that neither the driver nor one task holds the pairs."""
    dealt = left.withColumn("__salt", F.pmod(F.xxhash64(*left.columns), F.lit(salts)).cast("int"))
    return dealt.join(right.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))), "__salt").drop("__salt")


def previous(rows: DataFrame, group: list[str], at: str, width: int, name: str) -> DataFrame:
    """rows with the value of `at`, whole numbers, in the row before of the same group, null in the first; slices are `width` wide.

    Rows without a value of `at` have no order and no previous one. Null groups are a group.
    """
    known = rows.filter(F.col(at).isNotNull()).withColumn("__slice", F.floor(F.col(at) / width))
    ends = known.groupBy(*group, "__slice").agg(F.max(at).alias(at))  # only slices with rows, so the one before is the last with any
    carried = ends.withColumn(at, F.lag(at).over(Window.partitionBy(*group).orderBy("__slice"))).filter(F.col(at).isNotNull())
    both = known.withColumn("__carried", F.lit(0)).unionByName(carried.withColumn("__carried", F.lit(1)), allowMissingColumns=True)
    order = Window.partitionBy(*group, "__slice").orderBy(at, F.desc("__carried"))
    told = both.withColumn(name, F.lag(at).over(order)).filter("__carried = 0").drop("__carried", "__slice")
    return told.unionByName(rows.filter(F.col(at).isNull()).withColumn(name, F.lit(None).cast(rows.schema[at].dataType)))


def numbered(rows: DataFrame, group: str, order: list[str], name: str = "o") -> DataFrame:
    """rows with their place from 0 in their group, which is never null: counted by ranges of the order, so that a large group is ranked in many tasks."""
    ranged, _ = materialise(rows.repartitionByRange(group, *order).withColumn("__part", F.spark_partition_id()), "ranged")
    counts = ranged.groupBy(group, "__part").agg(F.count(F.lit(1)).alias("__m"))
    before = F.coalesce(F.sum("__m").over(Window.partitionBy(group).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # a row per group and range
    counts = counts.select(group, "__part", before.alias("__before"))
    within = F.row_number().over(Window.partitionBy(group, "__part").orderBy(*order)) - 1
    placed = ranged.withColumn("__within", within).join(counts, [group, "__part"])
    return placed.withColumn(name, F.col("__within") + F.col("__before")).drop("__part", "__within", "__before")


def first_reached(rows: DataFrame, group: str, order: list[str], slices: Column, counted: Column, target: int, elapsed: tuple[str, int]) -> DataFrame:
    """Per group the first of rows in `order` by which `counted` was true `target` times or elapsed[1] have gone by since the group's first elapsed[0]; with `reason`, the count tested first.

    slices must rise with the order. Sums of slices tell in which one a group stops; only its rows are ranked.
    """
    at, limit = elapsed
    rows = rows.withColumn("__slice", slices).withColumn("__one", counted.cast("long"))
    own = Window.partitionBy("__of").orderBy("__slice")
    told = rows.groupBy(F.col(group).alias("__of"), F.col("__slice").alias("__s")).agg(F.sum("__one").alias("__n"), F.min(at).alias("__least"), F.max(at).alias("__most")).withColumnRenamed("__s", "__slice")
    told = told.withColumn("__before", F.coalesce(F.sum("__n").over(own.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).withColumn("__begin", F.min("__least").over(own.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    reached = told.filter((F.col("__before") + F.col("__n") >= target) | (F.col("__most") - F.col("__begin") >= limit))
    stop = reached.groupBy("__of").agg(F.min(F.struct("__slice", "__before", "__begin")).alias("__stop")).select("__of", F.col("__stop.__slice").alias("__at"), "__stop.__before", "__stop.__begin")
    last = rows.join(stop, rows[group].eqNullSafe(stop["__of"]) & (F.col("__slice") == F.col("__at")))
    n = F.col("__before") + F.sum("__one").over(Window.partitionBy(group).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    last = last.withColumn("__n", n)
    last = last.withColumn("reason", F.when(F.col("__n") >= target, "target_reached").when(F.col(at) - F.col("__begin") >= limit, "time_limit")).filter("reason is not null")
    kept = [c for c in last.columns if not c.startswith("__")]
    return last.groupBy(group).agg(F.min_by(F.struct(*(c for c in kept if c != group)), F.struct(*order)).alias("__row")).select(group, "__row.*")


def spaced(rows: DataFrame, group: str, at: str, least: int) -> DataFrame:
    """group, at of the rows that a throttle lets through: of each group the first, and then each first one that comes at least `least` after the one let through before.

    `at` are whole numbers. A row that comes so long after the row before it is let through whatever
    was before, so chains begin there. Every other row points to the first one at least `least` after
    it, and pointers are doubled round by round, so a chain of n takes log n rounds of joins by row.
    Of two rows let through no two lie in one period of length `least`, which bounds the windows here.
    Rows without `at` are left out, null groups are a group.
    """
    with step(rows.sparkSession) as keep:
        reached, path = _reached(rows, group, at, least)
        keep(path)
    return reached.select(F.col("g.of").alias(group), F.col("t").alias(at))


def _reached(rows: DataFrame, group: str, at: str, least: int) -> tuple[DataFrame, str]:
    nodes = rows.select(F.struct(F.col(group).alias("of")).alias("g"), F.col(at).cast("long").alias("t")).filter("t is not null").distinct()
    nodes = previous(nodes, ["g"], "t", max(least, 1) * 64, "before")
    nodes, _ = materialise(nodes.select("g", "t", (F.col("before").isNull() | (F.col("t") - F.col("before") >= least)).alias("begins"), F.floor(F.col("t") / least).alias("p")), "nodes")
    later = _later_periods(nodes)
    # the first row of the next period that is late enough: rows and probes of a period in one falling order, the least row so far
    probes = nodes.select("g", "t", (F.col("p") + 1).alias("p"), (F.col("t") + least).alias("x"), F.lit(None).cast("long").alias("y"))
    ahead = probes.unionByName(nodes.select("g", F.lit(None).cast("long").alias("t"), "p", F.col("t").alias("x"), F.col("t").alias("y")))
    down = Window.partitionBy("g", "p").orderBy(F.desc("x")).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    near = ahead.withColumn("near", F.min("y").over(down)).filter("t is not null").select("g", "t", (F.col("p") - 1).alias("p"), "near")
    links = near.join(later, ["g", "p"]).select("g", "t", F.when(F.col("p1") == F.col("p") + 1, F.coalesce("near", "t2")).otherwise(F.col("t1")).alias("to"))
    begins = nodes.filter("begins").select("g", F.col("t").alias("to"))
    links, path = materialise(links.filter("to is not null").join(begins, ["g", "to"], "left_anti"), "links")
    reached, at_reached = materialise(nodes.filter("begins").select("g", "t"), "reached")
    while not links.isEmpty():
        reached, at_reached = materialise(reached.unionByName(reached.join(links, ["g", "t"]).select("g", F.col("to").alias("t"))).distinct(), "reached")
        twice = links.join(links.select("g", F.col("t").alias("to"), F.col("to").alias("on")), ["g", "to"]).select("g", "t", F.col("on").alias("to"))
        before, (links, path) = path, materialise(twice, "links")
        discard(rows.sparkSession, before)
    return reached, at_reached


def _later_periods(nodes: DataFrame) -> DataFrame:
    """g, p of nodes(g, t, p) with the next two periods that have rows: p1 and its first row t1, and the first row t2 of the one after."""
    periods = nodes.groupBy("g", "p").agg(F.min("t").alias("first")).withColumn("s", F.floor(F.col("p") / 4096))
    heads = periods.groupBy("g", "s").agg(F.slice(F.sort_array(F.collect_list(F.struct("p", "first"))), 1, 2).alias("head"))  # at most 4,096 to a slice
    two = Window.partitionBy("g").orderBy("s")
    heads = heads.select("g", "s", F.slice(F.concat(F.coalesce(F.lead("head", 1).over(two), F.slice("head", 1, 0)), F.coalesce(F.lead("head", 2).over(two), F.slice("head", 1, 0))), 1, 2).alias("next"))
    extra = heads.select("g", "s", F.explode("next").alias("n")).select("g", "s", "n.p", "n.first", F.lit(True).alias("extra"))
    order = Window.partitionBy("g", "s").orderBy("p")
    both = periods.withColumn("extra", F.lit(False)).unionByName(extra)
    both = both.withColumn("p1", F.lead("p").over(order)).withColumn("t1", F.lead("first").over(order)).withColumn("t2", F.lead("first", 2).over(order))
    return both.filter("not extra").select("g", "p", "p1", "t1", "t2")


def order_statistics(rows: DataFrame, keys: list[str], value: str, wanted: dict[str, float]) -> DataFrame:
    """Nearest-rank percentiles of whole numbers by keys (none: one row): the least value that covers its share of the rows, null values left out.

    Equal values are counted first. Then each rank is looked for digit by digit, in base 1,024 from the
    top: counts per digit and group tell which digit holds it, and only the values with that digit go
    on. A window holds the digits of one group, so its values never meet. Values may lie 2^62 apart.
    """
    counts, path = materialise(rows.filter(F.col(value).isNotNull()).groupBy(*keys, F.col(value).cast("long").alias("__v")).agg(F.count(F.lit(1)).alias("__n")), "counts")
    ends = counts.agg(F.min("__v").alias("least"), F.max("__v").alias("most")).first()
    key = F.struct(F.lit(0).alias("all"), *keys)  # equal where keys are null alike
    bits = max(1, ((ends["most"] or 0) - (ends["least"] or 0)).bit_length())
    totals = counts.groupBy(key.alias("__k")).agg(F.sum("__n").alias("__all"))
    ranks = F.explode(F.array(*(F.struct(F.lit(name).alias("name"), F.ceil(F.col("__all") * q).alias("rank")) for name, q in wanted.items())))
    found = totals.select("__k", ranks.alias("r")).select("__k", "r.name", F.greatest("r.rank", F.lit(1)).alias("rank"), F.lit(0).cast("long").alias("prefix"))
    values = counts.select(key.alias("__k"), (F.col("__v") - F.lit(ends["least"] or 0)).alias("__v"), "__n")
    for shift in range((bits - 1) // DIGIT * DIGIT, -1, -DIGIT):
        inside = values.join(found, "__k").filter(F.shiftright("__v", shift + DIGIT) == F.col("prefix"))
        digits = inside.groupBy("__k", "name", "rank", F.shiftright("__v", shift).alias("prefix")).agg(F.sum("__n").alias("n"))
        upto = Window.partitionBy("__k", "name").orderBy("prefix").rowsBetween(Window.unboundedPreceding, Window.currentRow)  # at most 1,024 rows
        digits = digits.withColumn("upto", F.sum("n").over(upto)).filter((F.col("upto") >= F.col("rank")) & (F.col("upto") - F.col("n") < F.col("rank")))
        found = digits.select("__k", "name", (F.col("rank") - F.col("upto") + F.col("n")).alias("rank"), "prefix")
    own = found.groupBy("__k").agg(*(F.max(F.when(F.col("name") == name, F.col("prefix") + F.lit(ends["least"] or 0))).alias(name) for name in wanted))
    if not keys:
        own = rows.sparkSession.range(1).select(F.struct(F.lit(0).alias("all")).alias("__k")).join(own, "__k", "left")
    return own.select(*(F.col("__k").getField(k).alias(k) for k in keys), *wanted)
