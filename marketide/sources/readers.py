"""Reading tables: CSV with or without BOM, Parquet, optional inputs."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DoubleType, FloatType, StructType

from marketide.sources.schemas import TABLES


# Quotes inside a field are doubled, and blanks around a value belong to it.
CSV_DIALECT = {
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def find_column(df: DataFrame, name: str) -> str | None:
    """The real spelling of ``name`` in ``df``, ignoring case."""
    return next((c for c in df.columns if c.lower() == name.lower()), None)


def conform(df: DataFrame, schema: StructType | None) -> DataFrame:
    """Give the columns of ``schema`` their types, by name; keep other columns as they are."""
    if schema is None:
        return df
    typed = {field.name.lower(): field for field in schema}
    picked = []
    for name in df.columns:
        field = typed.get(name.lower())
        column = F.col(f"`{name}`")
        if field is None:
            picked.append(column)
        else:
            picked.append(column.cast(field.dataType).alias(field.name))
    return nan_to_null(df.select(*picked))


def nan_to_null(df: DataFrame) -> DataFrame:
    """Missing floating-point values become NULL, the one mark of missing data here."""
    floating = [f.name for f in df.schema if isinstance(f.dataType, (DoubleType, FloatType))]
    return df.withColumns(
        {c: F.when(~F.isnan(f"`{c}`"), F.col(f"`{c}`")) for c in floating}
    ) if floating else df


def parse_dates(df: DataFrame, columns: Iterable[str], fmt: str | None = None) -> DataFrame:
    """Text or timestamp columns to dates; text that is no date raises, as under ANSI."""
    return df.withColumns({c: F.to_date(F.col(f"`{c}`"), fmt) for c in columns})


def parse_all_dates(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Every column whose schema says date, in every known table."""
    parsed = {}
    for name, df in tables.items():
        schema = TABLES.get(name)
        wanted = [
            f.name for f in (schema or [])
            if isinstance(f.dataType, DateType) and find_column(df, f.name)
        ]
        parsed[name] = parse_dates(df, wanted) if wanted else df
    return parsed


def read_csv(
    spark: SparkSession,
    path: str,
    schema: StructType | None = None,
    date_format: str | None = None,
    multiline: bool = False,
) -> DataFrame:
    """One CSV file or folder. A byte-order mark and CRLF line ends are accepted.

    Columns are matched by header name, never by position: the files of a folder may
    have their columns in different orders. ``multiline`` allows line breaks inside quoted
    fields; such a file cannot be split among tasks.
    """
    options = {"header": True, "encoding": "UTF-8", "multiLine": multiline, **CSV_DIALECT}
    raw = _by_header(spark, path, options)
    if schema is not None and date_format is not None:
        raw = parse_dates(
            raw,
            [
                found for f in schema
                if isinstance(f.dataType, DateType) and (found := find_column(raw, f.name))
            ],
            date_format,
        )
    return conform(raw, schema)


def _first_line(spark: SparkSession, path: str) -> str:
    """The header of a file, without byte-order mark and line end."""
    jvm_path, system = _file_system(spark, path)
    java = spark._jvm.java.io
    lines = java.BufferedReader(java.InputStreamReader(system.open(jvm_path), "UTF-8"))
    try:
        return (lines.readLine() or "").lstrip("\ufeff")
    finally:
        lines.close()


def _by_header(spark: SparkSession, path: str, options: dict) -> DataFrame:
    """The files of ``path``, those with one header read together, and all joined by column name."""
    files = [path]
    jvm_path, system = _file_system(spark, path)
    if system.exists(jvm_path) and system.getFileStatus(jvm_path).isDirectory():
        listed = (f.getPath() for f in system.listStatus(jvm_path) if f.isFile() and f.getLen() > 0)
        files = sorted(f.toString() for f in listed if not f.getName().startswith(("_", ".")))
    if len(files) < 2:
        return spark.read.csv(path, **options)
    groups: dict[str, list[str]] = {}
    for name in files:
        groups.setdefault(_first_line(spark, name), []).append(name)
    frames = [spark.read.csv(group, **options) for group in groups.values()]
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


def read_table(spark: SparkSession, root: str, name: str, fmt: str = "csv") -> DataFrame:
    """A table of the catalog from ``root``, in its declared types."""
    schema = TABLES.get(name)
    if fmt == "csv":
        return read_csv(spark, f"{root}/{name}.csv", schema)
    return conform(spark.read.format(fmt).load(f"{root}/{name}.{fmt}"), schema)


def read_catalog(
    spark: SparkSession, root: str, fmt: str = "csv", names: Iterable[str] = TABLES
) -> dict[str, DataFrame]:
    """All tables of the catalog, each also registered as a temporary view."""
    tables = {name: read_table(spark, root, name, fmt) for name in names}
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    return tables


def _file_system(spark: SparkSession, path: str):
    """``path`` for the JVM, and the file system it is on."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path, jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    jvm_path, system = _file_system(spark, path)
    return system.exists(jvm_path)


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Size of a file or folder, 0 if it is not there; asks the file system, runs no job."""
    jvm_path, system = _file_system(spark, path)
    return system.getContentSummary(jvm_path).getLength() if system.exists(jvm_path) else 0


def read_optional(
    spark: SparkSession, path: str, schema: StructType | None = None
) -> DataFrame | None:
    """A CSV that may be absent. The operators that take it fall back on a constant."""
    return read_csv(spark, path, schema) if exists(spark, path) else None


def monthly_index(cpi: DataFrame) -> DataFrame:
    """The price-index file as (month_start, CPI), whatever its date column is called."""
    value = find_column(cpi, "CPI")
    month = next(c for c in cpi.columns if c != value)
    return cpi.select(
        F.to_date(F.col(f"`{month}`")).alias("month_start"),
        F.col(f"`{value}`").cast("double").alias("CPI"),
    )
