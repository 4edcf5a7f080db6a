"""Mixing sources to target weights by Pfair scheduling.

The rows of a source, in a fixed pseudo-random order, are cut into blocks of
``block_rows``. Block j of a source of weight w (from 0) is released at slot
floor(j / w) and has its deadline at ceil((j + 1) / w); in every slot the released
block with the earliest deadline goes next. Earliest deadline first meets all
deadlines of such windows, so after any number of slots t each source has had more
than w t - 1 and fewer than w t + 1 blocks, however long the table is. Weights are
exact to 1 / WEIGHT_UNITS.

The slots are worked out in stretches, each by a SQL fold of its own and in
parallel. A stretch is no shorter than the longest window, so of each source at
most one block has a window across its end. Which of these go before the end is
found by themselves: in order of deadline, as long as they and all windows that
end there still fit into the slots before it. Any number of sources is mixed; the
work of a stretch grows with its slots times the sources.

With a ``period`` the weights are rounded to k / period instead, and one schedule
of that many slots is repeated; no more sources than slots then fit.
Rows are numbered within a source in two steps (inside 4,096 hash ranges, then
over the counts of the ranges), so a hot source is never sorted in one task.

Sources run out at different times. Nothing is dropped or repeated: when a source
has no block left its slots stay empty, and the others keep their proportions.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .columns import fresh_prefix

#: Slots of a period of rounded weights, and of a stretch of true ones at least.
PERIOD = 1_000
#: Parts of the whole that true weights are counted in.
WEIGHT_UNITS = 1 << 31
#: Rows of a block.
BLOCK_ROWS = 64
#: Hexadecimal digits of the order key that name a range.
RANGE_DIGITS = 3


def smoothed_weights(docs: DataFrame, source: str = "source") -> DataFrame:
    """(source, weight): square root of each source's rows, the usual flattening
    between proportional and equal shares. Null is a source of its own."""
    return docs.groupBy(F.col(f"`{source}`").alias("source")).agg(F.sqrt(F.count("*").cast("double")).alias("weight"))


def shares(weights: DataFrame, period: int = PERIOD) -> DataFrame:
    """(no, source, k, slots): k whole slots of the period for each weight above 0.

    Every source gets one slot, the rest go by weight, whole parts first and then
    the largest remainders (ties by source name, null last). ``slots`` is the
    period. Raises when there are more sources than slots."""
    one = Window.partitionBy()
    w = weights.where("weight > 0").select("source", F.col("weight").cast("double").alias("weight"))
    w = w.withColumn("n", F.count("*").over(one))
    w = w.withColumn("n", F.when(F.col("n") <= period, F.col("n")).otherwise(F.raise_error(F.lit(f"more sources than the {period} slots of a period")).cast("long")))
    w = w.withColumn("quota", F.col("weight") / F.sum("weight").over(one.orderBy(F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)) * (F.lit(period) - F.col("n")))
    w = w.withColumn("whole", F.floor("quota").cast("int"))
    w = w.withColumn("left", (F.lit(period) - F.col("n") - F.sum("whole").over(one)).cast("int"))
    w = w.withColumn("place", F.row_number().over(one.orderBy(F.round(F.col("quota") - F.col("whole"), 9).desc(), F.col("source").asc_nulls_last())))
    w = w.withColumn("no", F.row_number().over(one.orderBy(F.col("source").asc_nulls_last())) - 1)
    return w.select("no", "source", (F.lit(1) + F.col("whole") + (F.col("place") <= F.col("left")).cast("int")).cast("int").alias("k"), F.lit(period).alias("slots"))


def _release(j: Column, k: Column, period: int) -> Column:
    return F.floor(j * period / k).cast("int")


def _deadline(j: Column, k: Column, period: int) -> Column:
    return F.ceil((j + 1) * period / k).cast("int")


def period_schedule(weights: DataFrame, period: int = PERIOD) -> DataFrame:
    """(source, k, j, slot): the slot of each block j of a period, by earliest deadline first.

    At most ``period`` rows, from one row that holds the sources' shares."""
    one = shares(weights, period).agg(F.array_sort(F.collect_list(F.struct("no", "source", "k"))).alias("s"))
    # state: blocks had so far per source, and the source of each slot
    start = F.struct(F.transform("s", lambda x: F.lit(0)).alias("had"), F.array().cast("array<int>").alias("order"))

    def pick(state, t):
        had = state["had"]
        due = F.transform(F.col("s"), lambda x: F.struct(
            F.when(_release(F.get(had, x["no"]), x["k"], period) <= t, _deadline(F.get(had, x["no"]), x["k"], period)).otherwise(F.lit(2 * period)).alias("deadline"),
            x["no"].alias("no")))
        best = F.array_min(due)["no"]
        return F.struct(F.transform(had, lambda n, i: n + (i == best).cast("int")).alias("had"), F.concat(state["order"], F.array(best)).alias("order"))

    order = one.select("s", F.aggregate(F.sequence(F.lit(0), F.lit(period - 1)), start, pick, lambda z: z["order"]).alias("order"))
    slots = order.where(F.size("s") > 0).select("s", F.posexplode("order").alias("slot", "no")).select("slot", F.get("s", F.col("no")).alias("x"))
    j = F.row_number().over(Window.partitionBy("x.no").orderBy("slot")) - 1
    return slots.select(F.col("x.source").alias("source"), F.col("x.k").alias("k"), j.alias("j"), "slot")


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def _end_state(t: Column, least: Column) -> Column:
    """Blocks had by each source after slot t - 1 (array by number), from columns w and m of whole weights."""
    w, m = F.col("w"), F.col("m")
    up = lambda x, y: _div(x + y - 1, y)
    across = F.filter(F.transform(w, lambda x, i: F.struct(
        up((_div(x * t, m) + 1) * m, x).alias("deadline"), i.alias("no"), _div(_div(x * t, m) * m, x).alias("release"), (x * t % m > 0).alias("open"))), lambda c: c["open"])
    done = F.transform(w, lambda x: _div(x * t, m))
    total = lambda xs: F.aggregate(xs, F.lit(0).cast("long"), lambda acc, x: acc + x)
    state = F.transform(F.array(F.struct(F.array_sort(across).alias("c"), done.alias("done"))), lambda z: F.struct(z["c"].alias("c"), z["done"].alias("done"), (t - total(z["done"])).alias("m")))

    def slack(z, c):
        """Slots free for blocks across t in the tightest stretch up to t that c is the first release in."""
        before = F.coalesce(F.array_max(F.filter(F.transform(z["c"], lambda o: o["release"]), lambda r: r < c["release"])), F.greatest(t - least, F.lit(0).cast("long")) - 1)
        return F.array_min(F.transform(F.sequence(before + 1, c["release"]), lambda at: t - at - total(F.zip_with(
            w, z["done"], lambda x, n: F.greatest(n - up(x * at, m), F.lit(0).cast("long"))))))

    def choose(z):
        free = F.transform(z["c"], lambda c: slack(z, c))

        def one(acc, c):
            fits = (F.size(acc["got"]) < z["m"]) & F.forall(F.arrays_zip(z["c"].alias("c"), acc["free"].alias("free")), lambda o: (o["c"]["release"] > c["release"]) | (o["free"] >= 1))
            return F.get(F.transform(F.array(fits), lambda yes: F.struct(
                F.zip_with(z["c"], acc["free"], lambda o, n: n - (yes & (o["release"] <= c["release"])).cast("long")).alias("free"),
                F.when(yes, F.concat(acc["got"], F.array(c["no"]))).otherwise(acc["got"]).alias("got"))), F.lit(0))

        return F.aggregate(z["c"], F.struct(free.alias("free"), F.array().cast("array<int>").alias("got")), one, lambda acc: acc["got"])

    picked = F.transform(state, lambda z: F.struct(z["done"].alias("done"), choose(z).alias("got")))
    return F.get(F.transform(picked, lambda z: F.transform(z["done"], lambda n, i: n + F.array_contains(z["got"], i).cast("long"))), F.lit(0))


def true_schedule(weights: DataFrame, blocks: DataFrame, least: int = PERIOD) -> DataFrame:
    """(source, mix_block, mix_release, mix_deadline, mix_slot) of every block, by earliest deadline first.

    Sources are named by ``mix``'s keys, ``null`` the last; ``blocks`` is (source, blocks). One row holds the sources, one row of its own
    each stretch of at least ``least`` slots."""
    n = blocks.select(F.col("source").alias("of"), F.col("blocks").cast("long").alias("blocks"))
    each = weights.where("weight > 0").join(n, F.col("source").eqNullSafe(F.col("of")))
    # sources without rows keep their share of the slots
    each = each.select("source", "weight", "blocks").unionByName(
        weights.where("weight > 0").join(n, F.col("source").eqNullSafe(F.col("of")), "left_anti").select("source", "weight", F.lit(0).cast("long").alias("blocks")))
    m = F.col("m")
    up = lambda x, y: _div(x + y - 1, y)
    # totals over the sources by windows: in a lambda they would be worked out anew for each source
    whole = Window.partitionBy()
    each = each.withColumn("last", F.col("source") == "null").withColumn("weight", F.col("weight").cast("double"))
    each = each.withColumn("sum", F.sum("weight").over(whole.orderBy("last", "source").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    each = each.withColumn("w", F.greatest(F.round(F.col("weight") / F.col("sum") * WEIGHT_UNITS).cast("long"), F.lit(1).cast("long")))
    each = each.withColumn("m", F.sum("w").over(whole))
    one = each.agg(F.array_sort(F.collect_list(F.struct("last", "source", "blocks", "w"))).alias("s"), F.max("m").alias("m"),
                   F.max(up(F.col("blocks") * m, F.col("w"))).alias("end"), F.min("w").alias("least")).where("end > 0")
    one = one.select("s", F.transform("s", lambda x: x["w"]).alias("w"), "m", "end", F.greatest(F.lit(least).cast("long"), up(m, F.col("least")) + 1).alias("length"))
    one = one.select("s", "w", "m", "end", "length", F.explode(F.sequence(F.lit(0).cast("long"), _div(F.col("end") - 1, F.col("length")))).alias("p"))
    one = one.repartition(int(weights.sparkSession.conf.get("spark.sql.shuffle.partitions")), "p")  # a fixed number: few bytes, much work
    start, stop = F.col("p") * F.col("length"), F.least((F.col("p") + 1) * F.col("length"), F.col("end"))
    final = stop == F.col("end")
    one = one.select("s", "w", "m", start.alias("start"), stop.alias("stop"), _end_state(start, F.col("length")).alias("had"),
                     F.when(~final, _end_state(stop, F.col("length"))).alias("until"))

    def pick(state, t):
        due = F.array_min(F.transform(state["had"], lambda n, i: F.when(
            (_div(n * m, F.get("w", i)) <= t) & (F.col("until").isNull() | (n < F.get("until", i))),
            F.struct(F.least(up((n + 1) * m, F.get("w", i)), F.when(F.col("until").isNotNull(), F.col("stop"))).alias("deadline"), i.alias("no")))))
        return F.get(F.transform(F.array(due["no"]), lambda best: F.struct(
            F.transform(state["had"], lambda n, i: n + (i == best).cast("long")).alias("had"), F.concat(state["order"], F.array(best)).alias("order"), state["full"].alias("full"))), F.lit(0))

    # slots go by hundreds, so that what is done is not copied for every slot
    def hundred(state, t):
        begin = F.struct(state["had"].alias("had"), F.array().cast("array<int>").alias("order"), F.concat(state["full"], F.array(state["order"])).alias("full"))
        return F.aggregate(F.sequence(t, F.least(t + 99, F.col("stop") - 1)), begin, pick)

    zero = F.struct(F.col("had").alias("had"), F.array().cast("array<int>").alias("order"), F.array().cast("array<array<int>>").alias("full"))
    order = F.aggregate(F.sequence(F.col("start"), F.col("stop") - 1, F.lit(100).cast("long")), zero, hundred, lambda z: F.flatten(F.concat(z["full"], F.array(z["order"]))))
    slots = one.select("s", "w", "m", "start", "had", F.posexplode_outer(order).alias("i", "no"))  # outer: no filter that folds again
    slots = slots.select("start", "i", "no", "m", F.get("s", F.col("no")).alias("x"), F.get("w", F.col("no")).alias("w"), F.get("had", F.col("no")).alias("first"))
    j = F.col("first") + F.row_number().over(Window.partitionBy("start", "no").orderBy("i")) - 1
    slots = slots.withColumn("mix_block", j).where(F.col("mix_block") < F.col("x.blocks"))
    return slots.select(F.col("x.source").alias("source"), "mix_block", _div(F.col("mix_block") * m, F.col("w")).alias("mix_release"),
                        up((F.col("mix_block") + 1) * m, F.col("w")).alias("mix_deadline"), (F.col("start") + F.col("i")).cast("long").alias("mix_slot"))


def mix(docs: DataFrame, weights: DataFrame | None = None, period: int | None = None, block_rows: int = BLOCK_ROWS,
        doc_id: str = "doc_id", source: str = "source", tie: list[str] | None = None) -> DataFrame:
    """``docs`` with (mix_block, mix_release, mix_deadline, mix_slot, mix_row), all rows kept.

    Ordered by (mix_slot, mix_row), the rows are the mix. mix_block counts a
    source's blocks from 0; mix_release and mix_deadline are the block's window
    (mix_release <= mix_slot < mix_deadline); mix_row is the row's place in its
    block. ``weights`` is (source, weight), default ``smoothed_weights``; with
    ``period`` they are rounded to 1 / period, else taken as they are. A source
    without a weight above 0 has no place in the mix: its rows stay, with nulls.
    Null sources form one source. Rows go by the MD5 of their doc_id (null as
    empty), then doc_id, then the columns ``tie``; rows equal in all of these are
    interchangeable. Columns of the five names in ``docs`` are replaced."""
    added = ["mix_block", "mix_release", "mix_deadline", "mix_slot", "mix_row"]
    docs = docs.drop(*added)
    p = fresh_prefix(docs)
    weights = smoothed_weights(docs, source) if weights is None else weights
    ident = F.col(f"`{doc_id}`")
    # one key for the source, null included, so that window and join share a partitioning
    named = lambda c: F.coalesce(F.concat(F.lit("s"), c.cast("string")), F.lit("null"))
    key = F.md5(F.coalesce(ident.cast("string"), F.lit("")))
    rows = docs.withColumn(p + "s", named(F.col(f"`{source}`"))).withColumn(p + "key", key).withColumn(p + "r", F.substring(p + "key", 1, RANGE_DIGITS))
    small = rows.groupBy(p + "s", p + "r").agg(F.count("*").alias(p + "n"))
    before = F.sum(p + "n").over(Window.partitionBy(p + "s").orderBy(p + "r").rowsBetween(Window.unboundedPreceding, -1))
    starts = small.select(p + "s", p + "r", F.coalesce(before, F.lit(0)).alias(p + "start"))
    inside = Window.partitionBy(p + "s", p + "r").orderBy(p + "key", ident, *[F.col(f"`{c}`") for c in tie or []])
    rows = rows.withColumn(p + "place", F.row_number().over(inside) - 1).join(starts, [p + "s", p + "r"], "left")
    rows = rows.withColumn(p + "place", F.col(p + "place") + F.col(p + "start"))
    if period is None:
        blocks = small.groupBy(p + "s").agg(F.ceil(F.sum(p + "n") / block_rows).alias("blocks")).select(F.col(p + "s").alias("source"), "blocks")
        slots = true_schedule(weights.select(named(F.col("source")).alias("source"), "weight"), blocks).withColumnRenamed("source", p + "s")
        rows = rows.withColumn("mix_block", F.floor(F.col(p + "place") / block_rows).cast("long")).join(slots, [p + "s", "mix_block"], "left")
        known = F.col("mix_slot").isNotNull()
        return rows.select(
            *[F.col(f"`{c}`") for c in docs.columns], F.when(known, F.col("mix_block")).alias("mix_block"), "mix_release", "mix_deadline", "mix_slot",
            F.when(known, F.col(p + "place") % block_rows).cast("int").alias("mix_row"))
    plan = period_schedule(weights, period).withColumn(p + "s", named(F.col("source")))
    rows = rows.join(F.broadcast(plan.groupBy(p + "s").agg(F.first("k").alias(p + "k"))), p + "s", "left")
    block, k = F.col("mix_block"), F.col(p + "k")
    rows = rows.withColumn("mix_block", F.when(k.isNotNull(), F.floor(F.col(p + "place") / block_rows)).cast("long"))
    rows = rows.withColumn(p + "j", (block % k).cast("int")).withColumn(p + "turn", F.floor(block / k).cast("long"))
    slots = plan.select(p + "s", F.col("j").alias(p + "j"), F.col("slot").alias(p + "slot"))  # at most ``period`` rows
    rows = rows.join(F.broadcast(slots), [p + "s", p + "j"], "left")
    at = F.col(p + "turn") * period
    return rows.select(
        *[F.col(f"`{c}`") for c in docs.columns], block,
        (at + _release(F.col(p + "j"), k, period)).alias("mix_release"), (at + _deadline(F.col(p + "j"), k, period)).alias("mix_deadline"),
        (at + F.col(p + "slot")).alias("mix_slot"), F.when(k.isNotNull(), F.col(p + "place") % block_rows).cast("int").alias("mix_row"))
