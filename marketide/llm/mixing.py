"""Mixing sources to target weights.

A source's weight is its share of all tokens raised to an exponent, normalised. The
exponent (a temperature's inverse) is found by bisection: weights reach a target entropy,
or no source is repeated more often than a limit. Weights become token budgets, and a
source meets its budget by whole passes over its documents and a part of one, each in
an order of its own: documents are dealt into blocks by a hash, and blocks and documents
within them are permuted anew in every pass.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketide.llm.tables import free_names, kept

#: Tokens are white-space separated words unless the caller has better counts.
WORDS = r"[^\x20\x09-\x0D]+"
#: Halvings of the exponent's interval; 60 exhaust a double.
STEPS = 60
#: Share of the greatest possible entropy that weights should reach, and passes over a source at most.
EVENNESS, REPEATS = 0.95, 4.0
#: Documents to a block, roughly.
BLOCK_ROWS = 4_096
SALTS = 64
#: Blocks whose sums are added up by one task.
STRETCH = 1_024


@dataclass(frozen=True)
class Mix:
    """Per source: tokens, weight and token budget; the exponent that gives the weights."""

    exponent: float
    tokens: dict[str, int]
    weights: dict[str, float]
    budgets: dict[str, float]


def word_count(text: str = "text") -> Column:
    """Words of a text; none for a null."""
    # Only where words begin, so that nothing is copied but one character per word.
    return F.coalesce(F.regexp_count(F.col(text).cast("string"), F.lit(WORDS)), F.lit(0)).cast("long")


def tempered(tokens: dict[str, int], exponent: float) -> dict[str, float]:
    """Normalised weights: shares to the power of ``exponent``. Sources without tokens weigh nothing."""
    logs = {s: exponent * math.log(n) for s, n in tokens.items() if n > 0}
    if not logs:
        return dict.fromkeys(tokens, 0.0)
    top = max(logs.values())
    powers = {s: math.exp(v - top) for s, v in logs.items()}
    total = math.fsum(powers[s] for s in sorted(powers))
    return {s: powers.get(s, 0.0) / total for s in tokens}


def entropy(weights: dict[str, float]) -> float:
    return -math.fsum(w * math.log(w) for _, w in sorted(weights.items()) if w > 0)


def bisect_exponent(tokens: dict[str, int], evenness: float, repeats: float, budget: float | None) -> float:
    """The largest exponent in 0..1 that reaches the entropy, raised until no source exceeds its repeats.

    With exponent 1 weights are the shares themselves; with 0 all sources weigh the same.
    Entropy falls and the most repeated source's repeats fall as the exponent rises, so
    both are bisected. If they contradict each other, the repetition limit holds.
    """
    some = {s: n for s, n in tokens.items() if n > 0}
    if len(some) < 2:
        return 1.0
    target = evenness * math.log(len(some))

    def even(e: float) -> bool:
        return entropy(tempered(some, e)) >= target

    def within(e: float) -> bool:
        weights = tempered(some, e)
        total = budget if budget is not None else cover(some, weights)
        return max(total * weights[s] / n for s, n in some.items()) <= repeats * (1 + 1e-12)

    exponent = 1.0
    if not even(1.0):
        low, high = 0.0, 1.0
        for _ in range(STEPS):
            middle = (low + high) / 2
            low, high = (middle, high) if even(middle) else (low, middle)
        exponent = low
    if not within(exponent):
        low, high = exponent, 1.0
        for _ in range(STEPS):
            middle = (low + high) / 2
            low, high = (low, middle) if within(middle) else (middle, high)
        exponent = high
    return exponent


def cover(tokens: dict[str, int], weights: dict[str, float]) -> float:
    """The smallest total budget with which every source is read in full at least once."""
    return max((n / weights[s] for s, n in tokens.items() if weights[s] > 0), default=0.0)


def plan(tokens: dict[str, int], evenness: float = EVENNESS, repeats: float = REPEATS, budget: float | None = None) -> Mix:
    """Weights and budgets for these token counts.

    Without ``budget`` no document is left out: the total is ``cover``, so weights are met
    by repeating the smaller sources.
    """
    exponent = bisect_exponent(tokens, evenness, repeats, budget)
    weights = tempered(tokens, exponent)
    total = budget if budget is not None else cover(tokens, weights)
    return Mix(exponent, tokens, weights, {s: total * w for s, w in weights.items()})


def source_name() -> Column:
    """A null source is a source of its own, named by the empty string's neighbour."""
    return F.coalesce(F.col("source").cast("string"), F.lit("\0"))


def draws(
    docs: DataFrame, evenness: float = EVENNESS, repeats: float = REPEATS, budget: float | None = None,
    tokens: Column | None = None, seed: int = 0,
) -> tuple[DataFrame, Mix]:
    """A row for every draw of a row of ``docs``, and the mix.

    doc_id, text_key, source, n_tokens, pass (from 0) and position: how many tokens of
    the source come before it in that pass. Full passes draw every row. In the last one a
    row is drawn whole if it begins within what is left of the budget. Rows without tokens
    (null or empty texts) cost nothing and are drawn as their place has it. Rows that repeat
    a doc_id are drawn each for itself; those that repeat source and text as well stand
    next to each other. A null source is one of its own. ``budget`` counts tokens in all.
    """
    text_key = F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("text_key")
    rows = kept(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"), text_key, source_name().alias("source"),
            (tokens if tokens is not None else word_count()).alias("n_tokens"),
        )
    )
    sums = rows.groupBy("source").agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("rows"))
    # One row for each source.
    found = {r["source"]: (r["tokens"], r["rows"]) for r in sums.collect()}
    chosen = plan({s: n for s, (n, _) in found.items()}, evenness, repeats, budget)
    spark = docs.sparkSession
    table = spark.createDataFrame(
        [
            (s, *_passes(n, chosen.budgets[s]), max(1, -(-count // BLOCK_ROWS)))
            for s, (n, count) in sorted(found.items())
        ],
        "source string, full long, rest double, blocks long",
    )
    # A source may hold a third of all rows, so its one line is repeated for SALTS tasks.
    salt = F.pmod(F.xxhash64("doc_id", "text_key"), F.lit(SALTS)).cast("int")
    salted = table.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    known = rows.withColumn("_salt", salt).join(salted, ["source", "_salt"]).drop("_salt")
    last = F.col("full") - F.when(F.col("rest") > 0, 0).otherwise(1)
    each = known.where(last >= 0).withColumn("pass", F.explode(F.sequence(F.lit(0), last.cast("int"))))
    drawn = permuted(each, seed).where((F.col("pass") < F.col("full")) | (F.col("position") < F.col("rest")))
    source = F.when(F.col("source") != "\0", F.col("source")).alias("source")
    return drawn.select("doc_id", "text_key", source, "n_tokens", "pass", "position"), chosen


def _passes(tokens: int, budget: float) -> tuple[int, float]:
    """Full passes, and tokens of the part of one more. Rounding in the last digits makes no part."""
    if tokens <= 0:
        return 1, 0.0
    full = math.floor(budget / tokens * (1 + 1e-12))
    rest = budget - full * tokens
    return full, rest if rest > 1e-9 * tokens else 0.0


def dealt(rows: DataFrame, seed: int) -> DataFrame:
    """``rows`` with their block and their order within it, both by a hash that differs from pass to pass."""
    own = ("doc_id", "text_key", "pass")
    block = F.pmod(F.xxhash64(*own, F.lit(seed)), F.col("blocks")).alias("_block")
    return rows.withColumns({"_block": block, "_order": F.xxhash64(*own, F.lit(seed + 1))})


def permuted(rows: DataFrame, seed: int) -> DataFrame:
    """``rows`` with position: the tokens that come before each in its pass over its source.

    Blocks are summed first, and stretches of blocks before blocks, so no task holds more
    than a block of rows, a stretch of block sums or the stretches of one source.
    """
    stream = ["source", "pass"]
    spread = dealt(rows, seed)
    within = Window.partitionBy(*stream, "_block").orderBy("_order", "doc_id", "text_key")
    inside = spread.withColumn("_inside", _before("n_tokens", within))
    sums = spread.groupBy(*stream, "_block").agg(F.sum("n_tokens").alias("_sum"))
    stretches = sums.withColumn("_stretch", F.floor(F.col("_block") / STRETCH))
    near = stretches.withColumn("_near", _before("_sum", Window.partitionBy(*stream, "_stretch").orderBy("_block")))
    far = stretches.groupBy(*stream, "_stretch").agg(F.sum("_sum").alias("_all"))
    far = far.withColumn("_far", _before("_all", Window.partitionBy(*stream).orderBy("_stretch")))
    bases = near.join(far, [*stream, "_stretch"]).select(*stream, "_block", (F.col("_near") + F.col("_far")).alias("_base"))
    placed = inside.join(bases, [*stream, "_block"])
    return placed.withColumn("position", F.col("_base") + F.col("_inside")).drop("_block", "_order", "_inside", "_base")


def _before(value: str, order) -> Column:
    return F.coalesce(F.sum(value).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, each as often as it is drawn, with all their columns.

    Rows that repeat doc_id, source and text are drawn equally often: each as often as
    the first of them. Null ids and null texts are values like others.
    """
    drawn, _ = draws(docs, **options)
    names = free_names(docs, "drawn_id", "drawn_key", "drawn_source", "copies", "copy", "text_key")
    drawn_id, drawn_key, drawn_source, copies, copy, key = names
    times = drawn.groupBy("doc_id", "text_key", "source").agg((F.max("pass") + 1).alias(copies))
    times = times.toDF(drawn_id, drawn_key, drawn_source, copies)
    same = (
        F.col("doc_id").cast("long").eqNullSafe(F.col(drawn_id)) & (F.col(key) == F.col(drawn_key))
        & F.col("source").cast("string").eqNullSafe(F.col(drawn_source))
    )
    keyed = docs.withColumn(key, F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))))
    joined = keyed.join(times, same)
    return joined.withColumn(copy, F.explode(F.array_repeat(F.lit(0), F.col(copies)))).select(docs.columns)
