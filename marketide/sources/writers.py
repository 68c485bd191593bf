"""Writing tables: CSV, Parquet, the star schema, dated exports."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from marketide.sources.readers import CSV_DIALECT

DATED_FACTS = {"fact_sales": "order_date", "fact_webtraffic": "date"}
#: The file that names the current version of a published star.
CURRENT = "current.json"


BOM = "\ufeff"


def write_csv(df: DataFrame, path: str, date_column: str | None = None, bom: bool = False) -> None:
    """A folder of UTF-8 CSV parts with headers, each begun by a byte-order mark if asked for.

    The mark goes in front of the first header name, so it is the first thing in a file.
    """
    out = df
    if date_column is not None:
        out = df.withColumn(date_column, F.date_format(date_column, "yyyy-MM-dd"))
    if bom:
        out = out.toDF(*[BOM + c if i == 0 else c for i, c in enumerate(out.columns)])
    out.write.mode("overwrite").csv(path, header=True, **CSV_DIALECT)


def write_parquet(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def _figures(df: DataFrame) -> list[Column]:
    """Rows, and per column the known values and the sum of their hashes, which does not hang on the order of rows."""
    out = [F.count("*").alias("n_rows")]
    for i, c in enumerate(df.columns):
        value = F.col(f"`{c}`")
        hashed = F.when(value.isNotNull(), F.xxhash64(value)).cast("decimal(38,0)")
        out += [F.count(value).alias(f"known_{i}"), F.coalesce(F.sum(hashed), F.lit(0)).alias(f"sum_{i}")]
    return out


def _write_table(df: DataFrame, name: str, path: str, fmt: str) -> dict:
    """Write one table of the star; the figures of what was written."""
    parts = ()
    if fmt != "csv" and name in DATED_FACTS and DATED_FACTS[name] in df.columns:
        day, parts = F.col(DATED_FACTS[name]), ("part_year", "part_month")
        df = df.withColumns({"part_year": F.year(day), "part_month": F.month(day)}).hint("rebalance", *parts)
    # Seen by the tasks that write, each of which counts once however often it is tried.
    seen = Observation(f"{name}-{uuid.uuid4().hex}")
    watched = df.observe(seen, *_figures(df.drop(*parts)))
    write_csv(watched, path) if fmt == "csv" else write_parquet(watched, path, parts)
    return dict(seen.get)


def publish_star(tables: dict[str, DataFrame], root: str, fmt: str = "parquet") -> dict[str, str]:
    """Write the star schema below ``root`` as a new version, and make that the current one.

    The tables go to a folder of their own and are read back: rows, known values and hash
    sums of every column must be those that were written (CSV: the rows). Only then the
    manifest is swapped, in one step, so that ``current_star`` names the old version until
    the new one is whole. Old versions stay.

    Dated facts are partitioned by year and month. The rebalance hint gathers a month's
    rows so that it does not end as one tiny file per task, and adaptive execution splits
    a month that is too large, so that a month with a third of all rows still has many writers.
    """
    spark = next(iter(tables.values())).sparkSession
    version = f"version-{uuid.uuid4().hex}"
    paths = {}
    for name, df in tables.items():
        paths[name] = f"{root}/{version}/{name}"
        written = _write_table(df, name, paths[name], fmt)
        if fmt == "csv":
            back = spark.read.csv(paths[name], header=True, **CSV_DIALECT).agg(F.count("*").alias("n_rows"))
        else:
            stored = spark.read.schema(df.schema).parquet(paths[name]).select(*[F.col(f"`{c}`") for c in df.columns])
            back = stored.agg(*_figures(stored))
        found = back.first().asDict()
        if any(found[k] != written[k] for k in found):
            raise RuntimeError(f"{name} was not stored as it was written: {paths[name]}")
    replace_text(spark, f"{root}/{CURRENT}", json.dumps({"version": version, "format": fmt, "tables": list(paths)}))
    return paths


def current_star(spark: SparkSession, root: str) -> dict[str, str]:
    """The paths of the tables that were published last."""
    manifest = json.loads(spark.read.text(f"{root}/{CURRENT}", wholetext=True).first()[0])
    return {name: f"{root}/{manifest['version']}/{name}" for name in manifest["tables"]}


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """A small text file, put in the place of an older one in one step."""
    fs = spark._jvm.org.apache.hadoop.fs
    conf = spark._jsc.hadoopConfiguration()
    target, fresh = fs.Path(path), fs.Path(f"{path}-{uuid.uuid4().hex}")
    system = target.getFileSystem(conf)
    out = system.create(fresh)
    out.write(bytearray(text.encode()))
    out.close()
    options = spark.sparkContext._gateway.new_array(fs.Options.Rename, 1)
    options[0] = fs.Options.Rename.OVERWRITE
    context = fs.FileContext.getFileContext(system.getUri(), conf)
    context.rename(system.makeQualified(fresh), system.makeQualified(target), options)
