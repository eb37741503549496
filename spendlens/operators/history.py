"""Ordered history of a customer at a merchant, as a distributed prefix scan.

A window over (customer, merchant) puts a whole history into one task, and a single
corporate card can hold a large part of all rows. So histories are scanned like one
sorted sequence: it is cut at quantiles, whoever holds the rows, each slice is scanned
by itself, and starts from the merged state of the slices before it.

* The order is (customer, merchant, date, time, key). A sample of the rows, in that order,
  gives the cuts: one for every ``slice_rows`` rows, at most ``MOST_CUTS`` at any size of
  the table. A history without a cut in it is one slice.
* Cuts are kept by history and joined to its rows; they have at most ``MOST_CUTS`` rows. A
  row finds its slice among them by binary search. Windows run per slice, which has about
  ``slice_rows`` rows and is a task's share at most. A history with fewer than
  ``LEAST_CUTS`` cuts has about two shares at most and stays one slice, so a table without
  a hot history needs no carried state at all.
* The state of a slice is a handful of exact sums and its last ``TAIL`` rows. Only slices of
  histories with cuts have one, so there are at most two for each cut, and the scan over
  them is small. Results do not depend on where the cuts are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import squared, units
from ..sources.store import materialize, remove

SLICE_ROWS = 1_000_000
MOST_CUTS = 1 << 16
SAMPLES = 16
LEAST_CUTS = 2
# Up to this share of the rows a sample is taken without counting the table before.
UNCOUNTED = 0.001
SEED = 7
# Histories of a large customer are dealt over this many tasks.
SALTS = 1 << 12
TAIL = 3

HISTORY = ["history_owner", "merchant_key"]
SLICE = [*HISTORY, "history_part"]
ORDER = ["txn_date", "txn_ts", "txn_key"]
# All that the windows over slices read of a row. Rows of these columns alone move once, for
# the carried state and the rows themselves.
NARROW = {"CUST_NUM", "merchant_key", *ORDER, "txn_amount"}
RUNNING = (Window.unboundedPreceding, Window.currentRow)

# The number of cuts at or before a row, by halving; an array of MOST_CUTS takes 17 steps.
_FIND = """
aggregate(sequence(1, 17), named_struct('low', 0, 'high', size(history_cuts)), (s, i) -> CASE
  WHEN s.low >= s.high THEN s
  WHEN get(history_cuts, cast((s.low + s.high) div 2 AS int)) <= struct(txn_date, txn_ts, txn_key)
  THEN named_struct('low', cast((s.low + s.high) div 2 + 1 AS int), 'high', s.high)
  ELSE named_struct('low', s.low, 'high', cast((s.low + s.high) div 2 AS int)) END, s -> s.low)"""


def slice_window() -> Window:
    return Window.partitionBy(*SLICE).orderBy(*ORDER)


def running_window() -> Window:
    return slice_window().rowsBetween(*RUNNING)


def add_owner(df: DataFrame) -> DataFrame:
    """The customer as a never-NULL key, so that windows and joins share one plain hash
    partitioning."""
    return df.withColumn("history_owner", F.coalesce(F.col("CUST_NUM").cast("string"), F.lit("\0")))


def history_cuts(df: DataFrame, named, slice_rows: int = SLICE_ROWS, least: int = LEAST_CUTS) -> DataFrame:
    """(history_owner, merchant_key, history_cuts): where histories of ``least`` cuts or
    more are cut.

    ``df`` are typed transactions and ``named`` adds their merchant key, if they lack it, which
    is then computed for sampled rows only. The sample holds ``SAMPLES`` rows for each cut and is
    sorted as a whole: at most a million narrow rows. Only slices so small that the sample
    would be a large part of the table have the table counted first.
    """
    def keyed(rows: DataFrame) -> DataFrame:
        return add_owner(named(rows)).select(*HISTORY, *ORDER)

    types = dict(keyed(df).dtypes)
    types["history_cuts"] = f"array<struct<{', '.join(f'{c}: {types[c]}' for c in ORDER)}>>"
    none = df.sparkSession.range(1).where("false").select(
        *[F.lit(None).cast(types[name]).alias(name) for name in (*HISTORY, "history_cuts")])

    if SAMPLES / slice_rows > UNCOUNTED:
        total = df.count()
        share = max(slice_rows, -(-total // MOST_CUTS))
        if total <= share:  # one slice
            return none
        fraction = min(1.0, SAMPLES / share)
        sample, step = keyed(df.sample(fraction, SEED) if fraction < 1 else df), max(1, round(fraction * share))
        kept = None
    else:
        kept = sample = materialize(keyed(df.sample(SAMPLES / slice_rows, SEED)), "history_sample")
        step = max(SAMPLES, -(-sample.count() // MOST_CUTS))
    place = F.row_number().over(Window.orderBy(*HISTORY, *ORDER))
    # Equal rows stay in one slice, so cuts among them are one cut.
    cuts = materialize(sample.withColumn("place", place).where(F.col("place") % step == 0).groupBy(*HISTORY).agg(
        F.array_sort(F.collect_set(F.struct(*ORDER))).alias("history_cuts"),
        F.count("*").alias("found")).where(F.col("found") >= least).drop("found"), "cuts")
    if kept is not None:
        remove(kept)
    return none if cuts.isEmpty() else cuts


def large_owners(df: DataFrame, slice_rows: int = SLICE_ROWS, least: int = LEAST_CUTS) -> DataFrame | None:
    """(history_owner): customers with about ``least`` slices or more of rows, by a sample; at
    most one for each slice. None where there are none."""
    fraction = min(1.0, SAMPLES / slice_rows)
    found = materialize(add_owner(df.sample(fraction, SEED)).groupBy("history_owner").count().where(
        F.col("count") >= least * slice_rows * fraction).select("history_owner"), "large_owners")
    return None if found.isEmpty() else found


def add_history_part(df: DataFrame, cuts: DataFrame, large: DataFrame | None = None) -> DataFrame:
    """Number the slice of each row within its history; the same number in all of a history
    without cuts. ``history_is_cut`` tells whether there are any. The histories of ``large``
    customers start at different numbers, so that owner and number alone deal them over tasks."""
    sliced = add_owner(df).join(F.broadcast(cuts), HISTORY, "left")  # at most MOST_CUTS cuts in all
    part = F.when(F.col("history_cuts").isNotNull(), F.expr(_FIND)).otherwise(F.lit(0))
    if large is not None:
        sliced = sliced.join(large.withColumn("_large", F.lit(True)), "history_owner", "left")
        start = F.pmod(F.xxhash64("merchant_key"), F.lit(SALTS)).cast("int") * MOST_CUTS
        part = part + F.when(F.col("_large"), start).otherwise(F.lit(0))
    return sliced.withColumns({
        "history_part": part, "history_is_cut": F.col("history_cuts").isNotNull()}).drop("history_cuts", "_large")


def held_as(column: str) -> str:
    return f"_held_{column}"


def store_rows(named: DataFrame, source: list[str], held: list[str]) -> DataFrame:
    """The ``source`` columns and the ``held`` ones that cost most to derive, stored. The cuts,
    the distinct texts and the rows themselves are three passes, and a source that is a join
    would be joined, and its texts cleaned, in each of them."""
    return materialize(named.select(*source, *[F.col(c).alias(held_as(c)) for c in held]), "named")


def move_by_history(
    sliced: DataFrame, source: list[str], held: list[str], key: Column, derive, by_owner: bool = False,
) -> DataFrame:
    """The rows of each slice together, for the windows over slices.

    Only the ``source`` columns, the owner and number of the slice and the ``held`` columns
    move; ``derive`` makes all others again where the rows arrive. So rows are narrow in the
    shuffle, whatever is derived from them. ``key`` is the merchant key as ``derive`` makes
    it of held columns: rows are dealt by it, but the digest itself does not move. ``by_owner``
    deals by owner and number alone, so that a customer's rows stay together and aggregates
    of customers combine before they shuffle; only for numbers that spread large customers.
    """
    held = list(dict.fromkeys([*held, *[c for c in SLICE if c != "merchant_key"], "history_is_cut"]))
    dealt = [key if c == "merchant_key" else F.col(held_as(c)) for c in SLICE if c != "merchant_key" or not by_owner]
    moved = sliced.select(*source, *[F.col(c).alias(held_as(c)) for c in held]).repartition(*dealt)
    return derive(moved).withColumns({c: F.col(held_as(c)) for c in held}).drop(*[held_as(c) for c in held])


def move_by_month(rows: DataFrame, source: list[str], held: list[str], derive) -> DataFrame:
    """The rows of each month together, as ``write_table`` wants them, moved before the columns
    that need no other row are made: as in ``move_by_history``, only the ``source`` and the
    ``held`` columns and the month move, and ``derive`` makes all others again."""
    held = list(dict.fromkeys([*held, "txn_month"]))
    moved = rows.select(*source, *[F.col(c).alias(held_as(c)) for c in held]).hint("rebalance", held_as("txn_month"))
    return derive(moved).withColumns({c: F.col(held_as(c)) for c in held}).drop(*[held_as(c) for c in held])


def add_carry(df: DataFrame) -> DataFrame:
    """Join to each row of a cut history what the earlier slices end with: rows, sums of
    amounts, gaps and their squares, and the last ``TAIL`` rows.

    Rows with ``NARROW`` columns alone are dealt by slice once, and both sides of the join
    read that shuffle. For that they must ask it for the same columns and the same rows, so
    the histories without cuts are left out behind an aggregate, which no filter passes.
    """
    if set(df.columns) <= NARROW | {*SLICE, "history_is_cut"}:
        local = df = df.repartition(*SLICE)
    else:
        # Without cuts this filter is an inner join with nothing, and the branch is dropped.
        local = df.where("history_is_cut")
    gap = F.datediff("txn_date", F.lag("txn_date").over(slice_window()))
    # Of the last rows of a slice, no row is ``TAIL`` places later.
    is_tail = F.lead(F.lit(1), TAIL).over(slice_window()).isNull()
    amount = units("txn_amount")
    slices = (
        local.select(*SLICE, *ORDER, "txn_amount", "history_is_cut").withColumns({"_gap": gap, "_tail": is_tail})
        .groupBy(*SLICE)
        .agg(
            *[F.max(c).alias(f"_k_{c}") for c in SLICE],
            F.max("history_is_cut").alias("_cut"),
            F.count("*").alias("rows"),
            F.count("txn_amount").alias("n"),
            F.sum(amount).alias("s1"),
            F.sum(squared(amount)).alias("s2"),
            F.count("_gap").alias("gaps"),
            F.sum("_gap").alias("gap_sum"),
            F.sum(F.col("_gap") * F.col("_gap")).alias("gap_sq"),
            F.min_by("txn_date", F.struct(*ORDER)).alias("first_date"),
            F.sort_array(F.collect_list(F.when(
                F.col("_tail"), F.struct(*ORDER, "txn_amount")))).alias("tail"),
        )
        .where("_cut")
    )
    in_order = Window.partitionBy(*[f"_k_{c}" for c in HISTORY]).orderBy("_k_history_part")
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    # The gap between two slices belongs to the later one.
    last_before = F.try_element_at(F.lag("tail").over(in_order), F.lit(-1))["txn_date"]
    border = F.datediff("first_date", last_before)
    slices = slices.withColumn("_border", border).withColumns({
        "gaps": F.col("gaps") + F.when(F.col("_border").isNotNull(), 1).otherwise(0),
        "gap_sum": F.coalesce("gap_sum", F.lit(0)) + F.coalesce("_border", F.lit(0)),
        "gap_sq": F.coalesce("gap_sq", F.lit(0)) + F.coalesce(F.col("_border") * F.col("_border"), F.lit(0)),
    })
    carry = slices.select(
        *[f"_k_{c}" for c in SLICE],
        *[F.sum(c).over(before).alias(f"c_{c}") for c in ("rows", "n", "s1", "s2", "gaps", "gap_sum", "gap_sq")],
        F.slice(
            F.concat(F.array_repeat(F.lit(None).cast(slices.schema["tail"].dataType.elementType), TAIL),
                     F.flatten(F.collect_list("tail").over(in_order.rowsBetween(-TAIL, -1)))),
            -TAIL, TAIL).alias("c_tail"),
    )
    # Partition by all three keys. The windows above left the slices partitioned by
    # history, and a join that took that over would bring hot histories together.
    carry = carry.repartition(*[F.col(f"_k_{c}") for c in SLICE])
    same = [df["history_is_cut"], *[df[c] == F.col(f"_k_{c}") for c in SLICE]]
    return df.join(carry, same, "left").drop(*[f"_k_{c}" for c in SLICE])


def previous(field: str, back: int = 1) -> Column:
    """The field ``back`` rows earlier in the whole history."""
    here = F.row_number().over(slice_window())
    from_carry = F.get("c_tail", (F.lit(TAIL - 1 - back) + here).cast("int"))[field]
    return F.when(here > back, F.lag(field, back).over(slice_window())).otherwise(from_carry)
