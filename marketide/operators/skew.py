"""Joins that stay balanced when a few keys hold most of the rows.

A plain hash shuffle sends all rows of one key to one task. Here the frequent keys
of the large side are counted first, on the key columns alone; their rows are dealt
over several tasks by a salt, and the few matching rows of the other side are repeated
once per salt. All other keys keep salt 0 and are shuffled once, as usual.

The list of frequent keys is computed once and written to the shared folder, so that
both sides of a join see the same one.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketide.session import materialise


@dataclass(frozen=True)
class Spread:
    """When and how far to spread.

    ``above_bytes``: a side smaller than this fits in one task whatever its keys are,
    so looking for frequent keys would only cost a scan.
    ``rows_per_task``: a frequent key is dealt over enough tasks to leave each about this many.
    There are at most rows / rows_per_task frequent keys, each listed in 12 bytes: 3 MB for
    1e12 rows.
    ``broadcast_small``: a right side below the session's broadcast threshold is left to
    Catalyst, which then broadcasts it and shuffles nothing.
    """

    above_bytes: int = 256 * 1024 * 1024
    rows_per_task: int = 4_000_000
    broadcast_small: bool = True


DEFAULT = Spread()

#: Slots that keys are counted in before they are counted one by one: what a task shuffles at most.
#: They tell keys apart up to some 1e11 rows; with more, most slots are full and more keys are counted.
SLOTS = 1 << 16


def estimated_bytes(df: DataFrame) -> int | None:
    """Catalyst's size estimate, from file sizes and pruned columns; no job is run.

    None if it cannot be had, which callers take as large.
    """
    if not hasattr(df, "_jdf"):  # remote session, no plan at hand
        return None
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def is_large(df: DataFrame, spread: Spread = DEFAULT) -> bool:
    size = estimated_bytes(df)
    return size is None or size > spread.above_bytes


def fits_broadcast(df: DataFrame) -> bool:
    """Whether Catalyst itself would broadcast ``df``, by its own estimate and threshold."""
    size = estimated_bytes(df)
    if size is None:
        return False
    threshold = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return size <= threshold


def meets_broadcast(right: DataFrame, spread: Spread = DEFAULT) -> bool:
    """Whether ``join_spread`` leaves ``right`` to Catalyst's broadcast, however large the left side is."""
    return spread.broadcast_small and fits_broadcast(right)


def _any_null(columns: list[Column]) -> Column:
    missing = F.lit(False)
    for c in columns:
        missing = missing | c.isNull()
    return missing


def frequent_keys(
    df: DataFrame, key_sets: dict[str, list[str]], spread: Spread = DEFAULT
) -> dict[str, DataFrame]:
    """Per named key set: hash of every frequent key, tasks to deal it over.

    All key sets are counted together, in two scans of their columns: by slots of the hash,
    then by key in the slots that have enough rows. Counting starts in each task, so a
    frequent key is a row per task by the time it is shuffled. Keys with a NULL are not counted.
    """
    hashes = [
        F.struct(
            F.lit(i).cast("byte").alias("key_set"),
            F.when(~_any_null([F.col(k) for k in keys]), F.xxhash64(*keys)).alias("item"),
        )
        for i, keys in enumerate(key_sets.values())
    ]
    items = df.select(F.inline(F.array(*hashes))).where(F.col("item").isNotNull()).withColumn(
        "slot", F.pmod("item", F.lit(SLOTS)).cast("int")
    )
    # A slot with few rows holds no frequent key, so what is shuffled first does not grow with the
    # number of keys. Of the others there are no more than rows / ``rows_per_task`` as well.
    full = items.groupBy("key_set", "slot").agg(F.count("*").alias("n")).where(F.col("n") > spread.rows_per_task)
    counted = (
        items.join(F.broadcast(full.drop("n")), ["key_set", "slot"], "left_semi")
        .groupBy("key_set", "item")
        .agg(F.count("*").alias("n"))
    )
    found = materialise(counted.where(F.col("n") > spread.rows_per_task))
    return {
        name: found.where(F.col("key_set") == i).select(
            F.col("item").alias(f"{name}_hash"),
            F.ceil(F.col("n") / spread.rows_per_task).cast("int").alias(f"{name}_tasks"),
        )
        for i, name in enumerate(key_sets)
    }


def _tag(df: DataFrame, keys: list[str], hot: DataFrame, prefix: str) -> DataFrame:
    """Add ``{prefix}_tasks``: NULL unless the row's key is frequent.

    The broadcast list has at most rows / ``rows_per_task`` rows, see ``Spread``.
    """
    hashed = df.withColumn(f"{prefix}_hash", F.xxhash64(*[F.col(k) for k in keys]))
    return hashed.join(F.broadcast(hot), f"{prefix}_hash", "left").drop(f"{prefix}_hash")


def _dealt(tasks: Column) -> Column:
    """A salt from the input split: fixed for a task, so a retried task deals the same."""
    return F.pmod(F.spark_partition_id(), tasks)


def _same_key_types(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Equal keys must hash alike, so the right keys take the types of the left ones."""
    return right.withColumns({k: F.col(k).cast(left.schema[k].dataType) for k in keys})


def join_spread(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    how: str = "left",
    probe: DataFrame | None = None,
    spread: Spread = DEFAULT,
    hot: DataFrame | None = None,
) -> DataFrame:
    """``left.join(right, keys, how)`` for ``how`` in left/inner, safe for frequent left keys.

    ``probe`` is a cheap frame with the key columns of ``left`` (its source scan) for
    counting; by default ``left`` itself. Where the frequent keys are known, ``hot`` lists
    them with the ``tasks`` each is to be dealt over, and nothing is counted. Rows of ``left`` with a NULL key never match
    and are dealt over many tasks instead of meeting in one. Both sides are placed by
    an explicit repartition: left to itself, Spark may keep a side where an earlier
    aggregate on ``keys`` put it and pull the salted rows together again.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"join_spread supports left and inner, not {how}")
    source = left if probe is None else probe
    if not is_large(source, spread) or meets_broadcast(right, spread):
        return left.join(right, keys, how)

    if hot is None:
        hot = frequent_keys(source, {"hot": keys}, spread)["hot"]
    else:
        hot = hot.select(F.xxhash64(*keys).alias("hot_hash"), F.col("tasks").alias("hot_tasks"))
    right = _same_key_types(left, right, keys)
    columns = [F.col(k) for k in keys]
    salt = (
        F.when(_any_null(columns), F.spark_partition_id())
        .when(F.col("hot_tasks").isNotNull(), _dealt(F.col("hot_tasks")))
        .otherwise(F.lit(0))
    )
    salted_left = _tag(left, keys, hot, "hot").withColumn("salt", salt).drop("hot_tasks")
    copies = F.sequence(F.lit(0), F.coalesce(F.col("hot_tasks"), F.lit(1)) - 1)
    salted_right = (
        _tag(right, keys, hot, "hot").withColumn("salt", F.explode(copies)).drop("hot_tasks")
    )
    place = [*keys, "salt"]
    joined = salted_left.repartition(*place).join(salted_right.repartition(*place), place, how)
    return joined.select(*left.columns, *[c for c in right.columns if c not in keys])


def is_even(df: DataFrame, keys: list[str], found: DataFrame, spread: Spread = DEFAULT) -> bool:
    """Whether a shuffle of ``df`` by ``keys`` is even: ``found`` lists no frequent key, and few rows lack one."""
    if not found.isEmpty():
        return False
    missing = df.where(_any_null([F.col(k) for k in keys])).agg(F.count("*")).first()[0]
    return missing <= spread.rows_per_task


def placed(df: DataFrame, keys: list[str], spread: Spread = DEFAULT) -> DataFrame:
    """``df`` shuffled by ``keys``, for an aggregate and a join that both can use that; as it is, if uneven or broadcast."""
    if fits_broadcast(df):
        return df
    if is_large(df, spread) and not is_even(df, keys, frequent_keys(df, {"hot": keys}, spread)["hot"], spread):
        return df
    return df.repartition(*keys)


def attach_to_lines(
    lines: DataFrame,
    by_order: DataFrame,
    by_line: list[DataFrame],
    spread: Spread = DEFAULT,
    probe: DataFrame | None = None,
    even: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Order lines, with one order-grain table and any (order, product)-grain tables joined on.

    ``probe`` is a cheap frame with the keys of ``lines``, as in ``join_spread``. Where no order is
    frequent, plain joins by order do, which shuffle none of the order-grain tables again; ``even``
    then adds the columns of ``by_order`` to the lines, if there is a shorter way. Otherwise:
    Every side is placed by (order_id, salt) with an explicit repartition, which also
    serves the joins on (order_id, product_id): the lines are shuffled once. An order too
    large for a task is cut by product; a single (order, product) too large for a task, and
    the lines of such an order that have no product, are dealt out by input split.
    """
    pair = ["order_id", "product_id"]
    source = lines if probe is None else probe
    hot = frequent_keys(source, {"order": ["order_id"], "pair": pair}, spread) if is_large(source, spread) else {}
    if not hot or is_even(source, ["order_id"], hot["order"], spread):
        out = lines.join(by_order, "order_id", "left") if even is None else even(lines)
        for table in by_line:
            out = out.join(table, pair, "left")
        extra = [c for t in (by_order, *by_line) for c in t.columns if c not in pair]
        return out.select(*lines.columns, *extra)

    order_tasks, pair_tasks = F.col("order_tasks"), F.col("pair_tasks")
    by_product = F.pmod(F.xxhash64(F.col("product_id")), order_tasks).cast("int")
    tags = ("order_tasks", "pair_tasks")
    place = ("order_id", "salt")

    def tag(df: DataFrame) -> DataFrame:
        return _tag(_tag(df, ["order_id"], hot["order"], "order"), pair, hot["pair"], "pair")

    out = tag(lines).withColumn(
        "salt",
        F.when(F.col("order_id").isNull(), F.spark_partition_id())
        .when(order_tasks.isNull(), F.lit(0))
        .when(pair_tasks.isNotNull() | F.col("product_id").isNull(), _dealt(order_tasks))
        .otherwise(by_product),
    ).drop(*tags).repartition(*place)

    orders = _tag(
        _same_key_types(lines, by_order, ["order_id"]), ["order_id"], hot["order"], "order"
    )
    every = F.sequence(F.lit(0), F.coalesce(order_tasks, F.lit(1)) - 1)
    orders = orders.withColumn("salt", F.explode(every)).drop("order_tasks")
    out = out.join(orders.repartition(*place), list(place), "left")
    for table in by_line:
        tagged = tag(_same_key_types(lines, table, pair))
        one = F.array(F.coalesce(by_product, F.lit(0)))
        salts = F.when(pair_tasks.isNotNull() & order_tasks.isNotNull(), every).otherwise(one)
        table = tagged.withColumn("salt", F.explode(salts)).drop(*tags)
        out = out.join(table.repartition(*place), [*pair, "salt"], "left")
    extra = [c for c in by_order.columns if c != "order_id"]
    for table in by_line:
        extra += [c for c in table.columns if c not in pair]
    return out.select(*lines.columns, *extra)
