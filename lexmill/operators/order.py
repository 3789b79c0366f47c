"""Seeded shuffles, splits and row caps, and exact row numbers, without a global sort in one task.

A shuffle is the order of ``md5(seed:id)``. Splits and caps never rank rows: they need only
the key at one or two positions of that order, found from the counts of 4 096 equal slices
of the hash range, and then compare each row with it. Rows and their texts stay where they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexmill.config import JobConfigError
from lexmill.sources.workspace import materialise

_KEY_HEX_DIGITS = 15
_SLICE_BITS = 12
_SLICE_ROWS = 1 << 20
SPLITS = ("train", "test", "validation")


def order_key(id_column: str, seed: int) -> Column:
    """60 bits of the seeded hash; ids break its ties."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_column).cast("string")).cast("binary"))
    return F.conv(F.substring(digest, 1, _KEY_HEX_DIGITS), 16, 10).cast("bigint")


def _slice_of(key: Column, bits: int = _SLICE_BITS) -> Column:
    return F.shiftright(key, 4 * _KEY_HEX_DIGITS - bits)


def _slices(keys: DataFrame) -> DataFrame:
    """Rows before and up to each slice of the hash range, and ``_n`` in all: one row per slice."""
    counts = keys.groupBy("_slice").agg(F.count("*").alias("_rows"))
    so_far = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    everything = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return counts.select(
        "_slice",
        (F.sum("_rows").over(so_far) - F.col("_rows")).alias("_before"),
        F.sum("_rows").over(so_far).alias("_upto"),
        F.sum("_rows").over(everything).alias("_n"),
    )


def _keys(df: DataFrame, id_column: str, seed: int, bits: int = _SLICE_BITS) -> DataFrame:
    keyed = df.select(order_key(id_column, seed).alias("_key"), F.col(id_column).alias("_id"))
    return keyed.withColumn("_slice", _slice_of(F.col("_key"), bits))


def shuffle_rank(df: DataFrame, id_column: str, seed: int, name: str = "shuffle_rank") -> DataFrame:
    """Exact 1-based position of each row in the seeded shuffle.

    The hash range has as many slices as keep one at ``_SLICE_ROWS`` rows on average, so the windows do not grow with the table.
    """
    bits = max(_SLICE_BITS, (df.count() // _SLICE_ROWS).bit_length())
    keyed = df.withColumn("_key", order_key(id_column, seed)).withColumn("_slice", _slice_of(F.col("_key"), bits))
    offsets = _slices(_keys(df, id_column, seed, bits)).select("_slice", "_before")
    within = F.row_number().over(Window.partitionBy("_slice").orderBy("_key", id_column))
    return (
        keyed.join(F.broadcast(offsets), "_slice")
        .withColumn(name, (F.col("_before") + within).cast("bigint"))
        .drop("_key", "_slice", "_before")
    )


def _keys_at(keys: DataFrame, positions: dict[str, Column]) -> DataFrame:
    """One row: per name the (key, id) found at that 1-based position of the shuffle.

    ``positions`` are expressions of the row count ``_n``; a position of 0 gives null.
    Only the slices holding a wanted position are numbered.
    """
    wanted = F.array(*[F.struct(F.lit(k).alias("_name"), p.cast("bigint").alias("_at")) for k, p in positions.items()])
    located = (
        _slices(keys)
        .select("_slice", "_before", "_upto", F.inline(wanted))
        .where((F.col("_at") > F.col("_before")) & (F.col("_at") <= F.col("_upto")))
        .select("_slice", "_name", (F.col("_at") - F.col("_before")).alias("_nth"))
    )
    nth = F.row_number().over(Window.partitionBy("_slice").orderBy("_key", "_id"))
    numbered = keys.join(F.broadcast(located.select("_slice")), "_slice", "left_semi").select(
        "_slice", F.struct("_key", "_id").alias("_cut"), nth.cast("bigint").alias("_nth")
    )
    return numbered.join(F.broadcast(located), ["_slice", "_nth"]).agg(
        *[F.max(F.when(F.col("_name") == k, F.col("_cut"))).alias(k) for k in positions]
    )


def split_sizes(n: Column, holdout_share: float) -> dict[str, Column]:
    """Rows per split: the hold-out is rounded up, then halved with the larger half for validation."""
    holdout = F.ceil(F.lit(float(holdout_share)) * n)
    validation = F.ceil(holdout / 2)
    return {"train": n - holdout, "test": holdout - validation, "validation": validation}


def assign_split(df: DataFrame, id_column: str, holdout_share: float, seed: int, name: str = "split") -> DataFrame:
    """Add the split each row belongs to: in shuffle order test, then validation, then train."""
    sizes = split_sizes(F.col("_n"), holdout_share)
    cuts = _keys_at(
        _keys(df, id_column, seed),
        {"test_cut": sizes["test"], "holdout_cut": sizes["test"] + sizes["validation"]},
    )
    cut = cuts.select(F.struct("test_cut", "holdout_cut")).scalar()
    own = F.struct(order_key(id_column, seed).alias("_key"), F.col(id_column).alias("_id"))
    return (
        df.withColumn("_own", own)
        .withColumn("_cut", cut)
        .withColumn(
            name,
            F.when(F.coalesce(F.col("_own") <= F.col("_cut.test_cut"), F.lit(False)), "test")
            .when(F.coalesce(F.col("_own") <= F.col("_cut.holdout_cut"), F.lit(False)), "validation")
            .otherwise("train"),
        )
        .drop("_own", "_cut")
    )


def require_non_empty_splits(n_rows: int, holdout_share: float) -> None:
    """Fail early when a split would have no rows."""
    holdout = -int(-(holdout_share * n_rows) // 1)
    validation = -(-holdout // 2)
    sizes = {"train": n_rows - holdout, "test": holdout - validation, "validation": validation}
    empty = [k for k, v in sizes.items() if v <= 0]
    if empty:
        raise JobConfigError(f"holdout_share={holdout_share} leaves no rows for {', '.join(empty)} out of {n_rows}")


def cap_rows(
    df: DataFrame, id_column: str, max_rows: int, seed: int = 0, loaded_rows: int | None = None
) -> DataFrame:
    """Keep the first ``max_rows`` of the shuffle if more rows were loaded, else everything.

    ``loaded_rows`` is the size before rows with missing values were dropped; by default it
    is the size of ``df``.
    """
    if loaded_rows is not None and loaded_rows <= max_rows:
        return df
    cuts = _keys_at(_keys(df, id_column, seed), {"last": F.least(F.col("_n"), F.lit(max_rows))})
    own = F.struct(order_key(id_column, seed).alias("_key"), F.col(id_column).alias("_id"))
    return df.where(own <= cuts.select("last").scalar())


def head_rows(indexed: DataFrame, index_column: str, n: int) -> DataFrame:
    """The first ``n`` rows in file order, from their zero-based index."""
    return indexed.where(F.col(index_column) < n)


def preview(df: DataFrame, order_column: str, n: int = 10) -> DataFrame:
    return df.orderBy(order_column).limit(n)


def number_rows(df: DataFrame, order: list[Column], name: str, start: int = 1) -> DataFrame:
    """Exact consecutive numbers in a total order, over any number of rows.

    The range-partitioned sort is stored with each row's task and place, so counting the
    tasks' rows and numbering them see the same partitions. Only one row per task is
    exchanged besides the sort itself. The order must have no ties.
    """
    placed = df.orderBy(*order).withColumn("_place", F.monotonically_increasing_id())
    stored = materialise(placed, name).withColumn("_task", F.shiftright("_place", 33))
    tasks = stored.groupBy("_task").agg(F.min("_place").alias("_first"), F.count("*").alias("_rows"))
    before = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = tasks.select("_task", "_first", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    return (
        stored.join(F.broadcast(offsets), "_task")
        .withColumn(name, (F.col("_offset") + F.col("_place") - F.col("_first") + start).cast("bigint"))
        .drop("_task", "_place", "_first", "_offset")
    )
