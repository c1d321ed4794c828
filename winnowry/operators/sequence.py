"""Ordered rules per run: sequence guard, restarts, staleness, running extremes.

A run may own a third of all rows, so nothing here windows or collects a whole run.  Rows are once
range-partitioned and sorted by key and position, numbered in that order and written; a block is a
fixed count of consecutive numbers, whatever the positions are.  Blocks are summarized, the short list
of summaries is scanned, and every block then finishes on its own with all its columns.  Null keys are
a key like any other, and rows without a position come first.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from winnowry import fixed_values as fv
from winnowry.session import stored

PART_BITS = 33  # of the numbers that monotonically_increasing_id gives within a partition
BLOCK_BITS = 16
FAN_BITS = 6


def placed(df: DataFrame, keys: list[str], pos: str) -> DataFrame:
    """The rows in order of key and position, with that order as ``_at``."""
    ranged = df.repartitionByRange(*keys, pos).sortWithinPartitions(*keys, pos)
    return stored(ranged.withColumn("_at", F.monotonically_increasing_id()), "sequence")


def dense(rows: DataFrame) -> DataFrame:
    """``_at`` without the gaps between partitions, so that equal bits are equal counts of rows."""
    part = F.shiftright("_at", PART_BITS)
    before, starts = 0, []
    for row in rows.groupBy(part.alias("part")).count().orderBy("part").collect():  # one row a partition
        starts.append((row["part"], before))
        before += row["count"]
    local = rows.sparkSession.createDataFrame(starts, "_part bigint, _start bigint")
    return rows.withColumn("_part", part).join(F.broadcast(local), "_part").withColumn(
        "_at", F.col("_start") + F.col("_at").bitwiseAND((1 << PART_BITS) - 1)).drop("_part", "_start")


def opened(parents: DataFrame, fold: Callable, walked: Callable) -> DataFrame:
    """_first, start of every child: its first number and the state before it."""
    return parents.select(F.explode(F.arrays_zip(
        F.col("bs").alias("b"), walked(F.col("bs"), F.col("start"), fold).alias("start"))).alias("z")).select(
        F.col("z.b.at").alias("_first"), F.col("z.start").alias("start"))


def same(rows: DataFrame, other: DataFrame, names: dict[str, str]) -> Column:
    """Null-safe equality of the named columns, as join condition."""
    out = F.lit(True)
    for left, right in names.items():
        out = out & rows[left].eqNullSafe(other[right])
    return out


def running_extreme(df: DataFrame, keys: list[str], pos: str, value: Column, out: str,
                    greatest: bool = True, block_bits: int = BLOCK_BITS) -> DataFrame:
    """Extreme of ``value`` over all earlier rows of the key (the row itself excluded).

    ``value`` may be a struct.  A window runs over at most 2 ** block_bits rows of a block, over the
    block totals of one partition, or over one total per partition.
    """
    agg: Callable[[Column], Column] = F.max if greatest else F.min
    pick = F.greatest if greatest else F.least
    rows = placed(df.withColumn("_value", value), keys, pos).withColumn("_block", F.shiftright("_at", block_bits))
    blocks = rows.groupBy(*keys, "_block").agg(agg("_value").alias("_total")).withColumn(
        "_part", F.shiftright("_block", PART_BITS - block_bits))
    parts = blocks.groupBy(*keys, "_part").agg(agg("_total").alias("_total"))
    before = Window.unboundedPreceding, -1
    over_keys = Window.partitionBy(*keys) if keys else Window.partitionBy()
    upper = parts.select(*[F.col(k).alias(f"_u_{k}") for k in keys], F.col("_part").alias("_u_part"),
                         agg("_total").over(over_keys.orderBy("_part").rowsBetween(*before)).alias("_upper"))
    lower = blocks.withColumn("_lower", agg("_total").over(Window.partitionBy(*keys, "_part").orderBy("_block").rowsBetween(*before)))
    both = lower.join(upper, same(lower, upper, {k: f"_u_{k}" for k in keys} | {"_part": "_u_part"}))
    carries = both.select(*[F.col(k).alias(f"_c_{k}") for k in keys], F.col("_block").alias("_c_block"),
                          pick("_upper", "_lower").alias("_carry"))
    inside = Window.partitionBy(*keys, "_block").orderBy("_at").rowsBetween(*before)
    joined = rows.join(carries, same(rows, carries, {k: f"_c_{k}" for k in keys} | {"_block": "_c_block"}))
    return joined.withColumn("_local", agg("_value").over(inside)).select(*df.columns, pick("_carry", "_local").alias(out))


def guard_sequence(df: DataFrame, keys: list[str], pos: str = "pos", seq: str = "seq") -> DataFrame:
    """Add ``accepted``: the sequence number exceeds every earlier one of the key."""
    seen = running_extreme(df, keys, pos, F.col(seq), "_seen")
    return seen.withColumn("accepted", F.coalesce(F.col(seq) > F.col("_seen"), F.lit(True))).drop("_seen")


def replay_sequence(df: DataFrame, key: str = "run_id", pos: str = "pos", seq: str = "seq", ts: str | None = None,
                    gap: int = fv.RESTART_GAP, fan_bits: int = FAN_BITS, own: str | None = None) -> DataFrame:
    """Add ``last_before``, ``restarted`` and ``accepted`` of the guarded update rule.

    With ``ts`` also ``last_ts_before``, the time of the last accepted update.  A number below the last
    accepted one L by more than ``gap`` restarts the run and is accepted; otherwise it is accepted only
    above L.  Unless L lies between a block's first number and ``gap`` above it, that first number is
    accepted.  So the outcomes for these starts and one for all others describe a block; such tables
    compose, so blocks are folded in a tree of summaries and started from its way down.  No row holds
    more than 2 ** fan_bits children, however long a key's sequence is.

    ``own`` names a boolean column that is false for updates of others: they are accepted above L, but
    restart nothing.  Those before a block's first own number only raise L, so their maximum describes
    them, and the outcomes are counted from the first own number.
    """
    ours = F.coalesce(F.col(own), F.lit(False)) if own else F.lit(True)
    time = F.col(ts) if ts else F.lit(None).cast("timestamp")
    ordered = placed(df, [key], pos)
    rows = dense(ordered)
    by_at = lambda a, b: F.when(a["at"] < b["at"], F.lit(-1)).when(a["at"] > b["at"], F.lit(1)).otherwise(F.lit(0))

    def state(v: Column, t: Column, changed: Column) -> Column:
        return F.struct(v.cast("bigint").alias("v"), t.cast("timestamp").alias("t"), changed.alias("changed"))

    def taken(last: Column, s: Column, mine: Column) -> Column:
        return F.coalesce(last.isNull() | (s > last) | (mine & (s < last - gap)), F.lit(False))

    def step(acc: Column, s: Column, t: Column, mine: Column) -> Column:
        return F.when(taken(acc["v"], s, mine), state(s, t, F.lit(True))).otherwise(acc)

    def enter(entry: Column, acc: Column) -> Column:
        """The state behind an entry of a list, for the state before it."""
        def through(raised: Column) -> Column:
            offset = raised["v"] - entry["first"]
            slot = F.when(F.coalesce(offset.between(0, gap), F.lit(False)), offset).otherwise(F.lit(gap + 1)).cast("int")
            met = F.get(entry["table"], slot)
            return F.when(met["changed"], met).otherwise(raised)

        if own is None:
            return through(acc)
        above = F.coalesce(acc["v"].isNull() | (entry["most"] > acc["v"]), F.lit(False)) & entry["most"].isNotNull()
        return F.get(F.transform(F.array(F.when(above, state(entry["most"], entry["most_t"], F.lit(True))).otherwise(acc)), through), F.lit(0))

    def tabled(entries: Column, fold: Callable[[Column, Column], Column]) -> Column:
        """Outcomes for the first own number plus 0 .. gap, and for every other start: one that it restarts."""
        other = state(F.greatest("first", "most") + gap + 1, F.lit(None), F.lit(False)) if own else state(F.lit(None), F.lit(None), F.lit(False))
        near = F.transform(F.sequence(F.lit(0), F.lit(gap)), lambda d: F.aggregate(
            entries, state(F.col("first") + d, F.lit(None), F.lit(False)), fold))
        return F.concat(near, F.array(F.aggregate(entries, other, fold)))

    def walked(entries: Column, start: Column, fold: Callable[[Column, Column], Column]) -> Column:
        """The state before each entry."""
        seen = F.struct(start.alias("s"), F.array().cast("array<struct<v:bigint,t:timestamp,changed:boolean>>").alias("seen"))
        return F.aggregate(entries, seen, lambda acc, x: F.struct(
            fold(acc["s"], x).alias("s"), F.array_append(acc["seen"], acc["s"]).alias("seen")))["seen"]

    def gathered(entries: DataFrame, keys: list) -> DataFrame:
        """A key's entries of one parent in order, as ``bs``, with the first own number and what raises L before it."""
        parts = ("at", "first", "table", "most", "most_t") if own else ("at", "first", "table")
        out = entries.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(*parts)), by_at).alias("bs"))
        out = out.withColumn("at", F.get("bs", F.lit(0))["at"])
        if own is None:
            return out.withColumn("first", F.get("bs", F.lit(0))["first"])
        begun = F.get(F.filter("bs", lambda b: b["first"].isNotNull()), F.lit(0))
        early = F.filter("bs", lambda b: F.coalesce(b["at"] <= F.col("begun")["at"], F.lit(True)) & b["most"].isNotNull())
        return highest(out.withColumn("begun", begun).withColumn("first", F.col("begun")["first"]), early, "most", "most_t")

    def highest(df: DataFrame, entries: Column, value: str, at: str) -> DataFrame:
        """The first of the greatest values among the entries, as ``most`` and ``most_t``."""
        top = F.aggregate(entries, state(F.lit(None), F.lit(None), F.lit(False)), lambda acc, x: F.when(
            F.coalesce(x[value] > acc["v"], F.lit(True)), state(x[value], x[at], F.lit(True))).otherwise(acc))
        return df.withColumn("top", top).withColumns({"most": F.col("top")["v"], "most_t": F.col("top")["t"]})

    def by_row(acc: Column, r: Column) -> Column:
        return step(acc, r["seq"], r["t"], r["mine"])

    def by_entry(acc: Column, e: Column) -> Column:
        return enter(e, acc)

    # Up: every level folds at most 2 ** fan_bits entries of a key into one, until a key has so few left.
    longest = ordered.groupBy(key).count().agg(F.max("count")).first()[0] or 0
    parents_of = lambda n: (max(n - 2, 0) >> fan_bits) + 2  # at most, of n in a row
    spread = parents_of(longest)
    leaf = [F.col("_at").alias("at"), F.col(seq).cast("bigint").alias("seq"), time.alias("t"), ours.alias("mine")]
    blocks = rows.groupBy(key, F.shiftright("_at", fan_bits).alias("_block")).agg(F.array_sort(F.collect_list(F.struct(*leaf)), by_at).alias("rs"))
    blocks = blocks.withColumn("at", F.get("rs", F.lit(0))["at"])
    kept = (key, "_block", "at", "first", "table")
    if own:
        kept = (*kept, "most", "most_t")
        begun = F.get(F.filter("rs", lambda r: r["mine"] & r["seq"].isNotNull()), F.lit(0))
        early = F.filter("rs", lambda r: ~r["mine"] & r["seq"].isNotNull() & F.coalesce(r["at"] < F.col("begun")["at"], F.lit(True)))
        blocks = highest(blocks.withColumn("begun", begun).withColumn("first", F.col("begun")["seq"]), early, "seq", "t")
    else:
        blocks = blocks.withColumn("first", F.get("rs", F.lit(0))["seq"])
    level = blocks.withColumn("table", tabled(F.col("rs"), by_row)).select(*kept)
    levels = [stored(level, "sequence-level")]
    while spread > max(2, 1 << fan_bits):
        spread = parents_of(spread)
        levels.append(stored(gathered(levels[-1], [key, F.shiftright("_block", fan_bits).alias("_block")]).withColumn(
            "table", tabled(F.col("bs"), by_entry)).select(*kept), "sequence-level"))

    # Down: the state before an entry, from the one before its parent; the first of a key starts from nothing.
    nothing = state(F.lit(None), F.lit(None), F.lit(False))
    begun = gathered(levels.pop(), [key]).withColumn("start", nothing)
    carried = opened(begun, by_entry, walked)
    while levels:
        parents = gathered(levels.pop(), [key, F.shiftright("_block", fan_bits).alias("_block")])
        carried = opened(parents.join(carried, parents["at"] == carried["_first"]), by_entry, walked)

    # Every block replays its own rows, which carry all their columns; its first number is unique.
    names = df.columns
    own = rows.groupBy(key, F.shiftright("_at", fan_bits).alias("_block")).agg(
        F.array_sort(F.collect_list(F.struct(*leaf, F.struct(*names).alias("row"))), by_at).alias("rs"), F.min("_at").alias("_own_first"))
    replayed = own.join(carried, F.col("_own_first") == F.col("_first")).select(F.explode(F.arrays_zip(
        F.col("rs").alias("r"), walked(F.col("rs"), F.col("start"), by_row).alias("before"))).alias("z")).select(
        "z.r.row.*", F.col("z.before.v").alias("last_before"), F.col("z.before.t").alias("last_ts_before"))
    s, last = F.col(seq), F.col("last_before")
    out = replayed.withColumns({"restarted": F.coalesce(ours & (s < last - gap), F.lit(False)), "accepted": taken(last, s, ours)})
    return out if ts else out.drop("last_ts_before")


def stale_flags(replayed: DataFrame, ts: str = "ts", seconds: int = fv.STALE_SECONDS) -> DataFrame:
    """Add ``stale``: not accepted, and the last accepted update is more than ``seconds`` of real time older.

    ``replayed`` comes from ``replay_sequence`` with ``ts``.
    """
    late = ~F.col("accepted") & (F.col(ts) > F.col("last_ts_before") + F.expr(f"INTERVAL {seconds} SECONDS"))
    return replayed.withColumn("stale", F.coalesce(late, F.lit(False)))


def best_so_far(runs: DataFrame, pos: str, loss: str, keys: list[str] | None = None) -> DataFrame:
    """Add ``is_best``: the loss is strictly below every earlier one."""
    seen = running_extreme(runs, keys or [], pos, F.col(loss), "_best", greatest=False)
    return seen.withColumn("is_best", F.coalesce(F.col(loss) < F.col("_best"), F.lit(True))).drop("_best")
