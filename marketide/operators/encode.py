"""Encoding labels as numbers."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketide.operators.skew import DEFAULT, Spread, join_spread
from marketide.session import materialise

# Ordinal codes.
SIZE_CODES = {"S": 1, "M": 2, "L": 3, "XL": 4, "XXL": 5}
AGE_CODES = {"Unknown": 0, "18-24": 1, "25-34": 2, "35-44": 3, "45-54": 4, "55+": 5}
OTHER_CODE = 0

#: Marks the 0/1 columns of ``one_hot`` in a schema, and how many of them a whole number holds.
FLAG, WORD_BITS = {"one_hot_flag": True}, 64

ALL_CATEGORIES = "all_categories"


def ordinal(df: DataFrame, column: str, codes: Mapping[str, int], out: str | None = None) -> DataFrame:
    """Codes for the known labels, ``OTHER_CODE`` for any other label and for NULL."""
    pairs = [F.lit(part) for item in codes.items() for part in item]
    code = F.try_element_at(F.create_map(*pairs), F.col(column))
    return df.withColumn(out or column, F.coalesce(code, F.lit(OTHER_CODE)).cast("int"))


def labels_of(df: DataFrame, column: str) -> list[str]:
    """The sorted labels of a column that is to become a column per label.

    Such columns must be known when the plan is built, so this is for as many labels as a
    plan can have columns. Any number of them fits ``label_dictionary`` and ``one_hot_sparse``.
    """
    return sorted(str(row[0]) for row in df.select(column).where(F.col(column).isNotNull()).distinct().collect())


def _numbered(rows: DataFrame, order: list[Column | str], out: str) -> DataFrame:
    """``rows`` with their place (from 0) in an order.

    Rows are range-partitioned, so every task numbers its own range; the sizes of earlier
    ranges (one figure per range) are added.
    """
    # The high bits of the id are the range, the low 33 the place in it.
    placed = materialise(
        rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__id", F.monotonically_increasing_id())
    ).withColumn("__range", F.shiftright("__id", 33))
    sizes = placed.groupBy("__range").agg(F.count("*").alias("__size"))
    earlier = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("__range", F.coalesce(F.sum("__size").over(earlier), F.lit(0)).alias("__before"))
    place = F.col("__before") + F.col("__id").bitwiseAND((1 << 33) - 1)
    return placed.join(before, "__range").withColumn(out, place).drop("__id", "__range", "__before")


def label_dictionary(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """(column_name, label, label_id): ids from 0 over all labels of all columns, by column name and label.

    Labels stay in the cluster, however many there are. NULL is no label.
    """
    long = df.select(*[F.col(c).cast("string").alias(c) for c in columns]).unpivot([], list(columns), "column_name", "label")
    return _numbered(long.where(F.col("label").isNotNull()).distinct(), ["column_name", "label"], "label_id")


def one_hot_sparse(
    df: DataFrame, columns: Iterable[str], dictionary: DataFrame, out: str = "label_ids", keep: bool = False,
    spread: Spread = DEFAULT,
) -> DataFrame:
    """``one_hot`` as one column: the ascending ids of a row's labels, the places of its ones.

    A label that the dictionary does not have is none. Frequent labels are dealt over
    many tasks.
    """
    listed, rows = list(columns), df
    for i, c in enumerate(listed):
        own = dictionary.where(F.col("column_name") == c).select(F.col("label").alias("__label"), F.col("label_id").alias(f"__of_{i}"))
        probe = df.select(F.col(c).cast("string").alias("__label"))
        rows = join_spread(rows.withColumn("__label", F.col(c).cast("string")), own, ["__label"], "left", probe, spread).drop("__label")
    ids = F.array_sort(F.array_compact(F.array(*[F.col(f"__of_{i}") for i in range(len(listed))])))
    kept = [F.col(f"`{c}`") for c in df.columns if keep or c not in listed]
    return rows.select(*kept, ids.alias(out))


def dense(rows: DataFrame, ids: str, dictionary: DataFrame, labels: Mapping[str, list[str]]) -> DataFrame:
    """0/1 columns ``{column}_{label}`` for some labels, from the ids of ``one_hot_sparse``."""
    known = ids_of(dictionary, labels)
    flags = [
        F.array_contains(ids, F.lit(known[c, label])).cast("int").alias(f"{c}_{label}") if (c, label) in known
        else F.lit(0).alias(f"{c}_{label}")
        for c, values in labels.items() for label in values
    ]
    return rows.select(*[F.col(f"`{c}`") for c in rows.columns if c != ids], *flags)


def ids_of(dictionary: DataFrame, labels: Mapping[str, list[str]]) -> dict[tuple[str, str], int]:
    """The ids of some labels, which are as many as the columns asked for."""
    wanted = F.lit(False)
    for c, values in labels.items():
        wanted = wanted | ((F.col("column_name") == c) & F.col("label").isin(list(values)))
    return {(r["column_name"], r["label"]): r["label_id"] for r in dictionary.where(wanted).collect()}


def one_hot(
    df: DataFrame, columns: Iterable[str] | Mapping[str, list[str]], keep: bool = False
) -> DataFrame:
    """A 0/1 column ``{column}_{label}`` per label; NULL is 0 in all of them.

    Give a mapping of column to labels to plan without reading the data.
    """
    if isinstance(columns, Mapping):
        labels = dict(columns)
    else:
        labels = {c: labels_of(df, c) for c in columns}
    flags = [
        F.coalesce((F.col(c).cast("string") == label).cast("int"), F.lit(0)).alias(f"{c}_{label}", metadata=FLAG)
        for c, values in labels.items() for label in values
    ]
    kept = [F.col(f"`{c}`") for c in df.columns if keep or c not in labels]
    return df.select(*kept, *flags)


def packed_flags(df: DataFrame, out: str) -> tuple[DataFrame, dict[str, Column]]:
    """``df`` with the columns that ``one_hot`` made as bits of a few whole numbers ``{out}_{n}``,
    and the expression that gives each of them back.

    Where rows are shuffled, a flag takes a bit instead of eight bytes. A row that a left join
    did not find has no number and gets NULLs.
    """
    flags = [f.name for f in df.schema if FLAG.items() <= f.metadata.items()]
    words = []
    for n, start in enumerate(range(0, len(flags), WORD_BITS)):
        bits = [F.shiftleft(F.col(f"`{c}`").cast("long"), i) for i, c in enumerate(flags[start:start + WORD_BITS])]
        words.append(reduce(Column.bitwiseOR, bits).alias(f"{out}_{n}"))
    back = {
        c: F.getbit(F.col(f"{out}_{i // WORD_BITS}"), F.lit(i % WORD_BITS)).cast("int") for i, c in enumerate(flags)
    }
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c not in back], *words), back


def frequency_rank(df: DataFrame, column: str) -> DataFrame:
    """Per label (NULL included) its count and its rank, rarest = 1, ties in label order.

    A plain ranking would sort all labels in one task; here they are numbered range by range.
    """
    counts = df.groupBy(F.col(column).alias("label")).agg(F.count("*").alias("n"))
    placed = _numbered(counts, ["n", F.col("label").asc_nulls_first()], "place")
    return placed.select(F.col("label").alias(column), "n", (F.col("place") + 1).cast("int").alias("rank"))


def rank_encode(df: DataFrame, column: str, spread: Spread = DEFAULT) -> DataFrame:
    """Replace a label by its frequency rank. NULL is a label like any other."""
    def key(c: str) -> Column:
        return F.coalesce(F.concat(F.lit("="), F.col(c)), F.lit(""))

    ranks = frequency_rank(df, column).select(key(column).alias("rank_key"), "rank")
    keyed = df.withColumn("rank_key", key(column))
    joined = join_spread(keyed, ranks, ["rank_key"], "left", spread=spread)
    return joined.select(
        *[F.col("rank").alias(c) if c == column else F.col(f"`{c}`") for c in df.columns]
    )


def encode_products(products: DataFrame, labels: Mapping[str, list[str]] | None = None) -> DataFrame:
    return one_hot(
        ordinal(products, "size", SIZE_CODES), labels or ["category", "segment", "color"]
    )


def fill_category(promotions: DataFrame) -> DataFrame:
    return promotions.withColumn(
        "applicable_category", F.coalesce("applicable_category", F.lit(ALL_CATEGORIES))
    )


def encode_promotions(promotions: DataFrame, labels: Mapping[str, list[str]] | None = None) -> DataFrame:
    return one_hot(fill_category(promotions), labels or ["promo_type", "promo_channel"])


def encode_customers(customers: DataFrame, labels: Mapping[str, list[str]] | None = None) -> DataFrame:
    coded = ordinal(rank_encode(customers, "city"), "age_group", AGE_CODES)
    return one_hot(coded, labels or ["gender", "acquisition_channel"])


def encode_geography(geography: DataFrame, labels: Mapping[str, list[str]] | None = None) -> DataFrame:
    return one_hot(geography, labels or ["region"])


def scaler_stages(features: list[str], out: str = "features") -> list:
    """Assemble and scale to zero mean and unit (sample) deviation."""
    return [
        VectorAssembler(inputCols=features, outputCol="raw_features"),
        StandardScaler(inputCol="raw_features", outputCol=out, withMean=True, withStd=True),
    ]


def scaled(df: DataFrame, features: list[str]) -> DataFrame:
    """The features at zero mean and unit population deviation, as a vector column ``features``.

    A feature that never changes becomes 0 throughout.
    """
    figures = df.agg(*[
        f(name).alias(f"{f.__name__}_{i}") for i, name in enumerate(features) for f in (F.avg, F.stddev_pop)
    ]).first()
    columns = [
        (F.col(name) - F.lit(figures[f"avg_{i}"])) / F.lit(figures[f"stddev_pop_{i}"] or 1.0)
        for i, name in enumerate(features)
    ]
    return df.withColumn("features", array_to_vector(F.array(*[c.cast("double") for c in columns])))
