import pytest
from pyspark.sql import functions as F

from helpers import d, retail, rows
from marketide.operators.star import star_schema
from marketide.sources import readers, schemas, writers


def _file(folder, name, text):
    path = folder / name
    path.write_bytes(text)
    return str(path)


def test_bom_and_crlf(spark, tmp_path):
    text = "﻿promo_id,promo_type,discount_value,start_date\r\nA,fixed,5.5,2020-01-02\r\nB,,,\r\n"
    path = _file(tmp_path, "promotions.csv", text.encode())
    got = readers.read_csv(spark, path, schemas.PROMOTIONS)
    assert got.columns == ["promo_id", "promo_type", "discount_value", "start_date"]
    assert rows(got) == [("A", "fixed", 5.5, d("2020-01-02")), ("B", None, None, None)]


def test_columns_are_found_by_name_not_place(spark, tmp_path):
    path = _file(tmp_path, "sales.csv", b"COGS,date,Revenue,note\n1.5,2020-01-01,2.5,x\n")
    got = readers.read_csv(spark, path, schemas.SALES)
    assert got.columns == ["COGS", "Date", "Revenue", "note"]
    assert rows(got) == [(1.5, d("2020-01-01"), 2.5, "x")]
    assert readers.find_column(got, "DATE") == "Date"
    assert readers.find_column(got, "nothing") is None


def test_files_of_a_folder_may_order_their_columns(spark, tmp_path):
    (tmp_path / "orders.csv").mkdir()
    _file(tmp_path / "orders.csv", "a.csv", b"order_id,customer_id\n1,100\n2,200\n")
    _file(tmp_path / "orders.csv", "b.csv", "\ufeffcustomer_id,order_id\r\n300,3\r\n".encode())
    _file(tmp_path / "orders.csv", "c.csv", b"order_id,customer_id\n4,400\n")
    got = readers.read_csv(spark, str(tmp_path / "orders.csv"))
    assert rows(got.select("order_id", "customer_id")) == [("1", "100"), ("2", "200"), ("3", "300"), ("4", "400")]


def test_byte_order_mark_on_request(spark, tmp_path):
    df = spark.createDataFrame([(1, "x"), (2, None), (3, "")], "a int, b string")
    writers.write_csv(df, str(tmp_path / "out"), bom=True)
    parts = [p for p in (tmp_path / "out").glob("part-*") if p.stat().st_size]
    assert parts and all(p.read_bytes().startswith(b"\xef\xbb\xbfa,b") for p in parts)
    # An empty text is missing, as in any CSV.
    assert rows(readers.read_csv(spark, str(tmp_path / "out"))) == [("1", "x"), ("2", None), ("3", None)]


def test_quotes_blanks_and_line_breaks(spark, tmp_path):
    text = b'a,b\n"say ""hi"", all", x \n'
    assert rows(readers.read_csv(spark, _file(tmp_path, "q.csv", text))) == [('say "hi", all', " x ")]
    broken = b'a,b\n"two\nlines",1\n'
    got = readers.read_csv(spark, _file(tmp_path, "m.csv", broken), multiline=True)
    assert rows(got) == [("two\nlines", "1")]
    writers.write_csv(got, str(tmp_path / "again"))
    assert rows(readers.read_csv(spark, str(tmp_path / "again"), multiline=True)) == rows(got)


def test_date_format_and_bad_dates(spark, tmp_path):
    path = _file(tmp_path, "s.csv", b"Date,Revenue,COGS\n02/01/2020,1,1\n")
    got = readers.read_csv(spark, path, schemas.SALES, date_format="dd/MM/yyyy")
    assert rows(got)[0][0] == d("2020-01-02")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|CANNOT_PARSE"):
        readers.read_csv(spark, path, schemas.SALES).collect()


def test_price_index_with_local_column_name(spark, tmp_path):
    path = _file(tmp_path, "cpi.csv", "﻿CPI,Thời Gian\r\n89.84,2016-04-01\r\n".encode())
    got = readers.monthly_index(readers.read_csv(spark, path, schemas.CPI))
    assert rows(got) == [(d("2016-04-01"), 89.84)]


def test_optional_source(spark, tmp_path):
    assert readers.read_optional(spark, str(tmp_path / "none.csv")) is None
    path = _file(tmp_path, "there.csv", b"a\n1\n")
    assert readers.read_optional(spark, path).count() == 1


def test_nan_becomes_null(spark):
    df = spark.createDataFrame([(1, float("nan")), (2, 1.0)], "a int, b double")
    assert rows(readers.nan_to_null(df)) == [(1, None), (2, 1.0)]


def test_catalog_round_trip(spark, tmp_path):
    tables = retail(spark)
    for name, df in tables.items():
        writers.write_csv(df, str(tmp_path / f"{name}.csv"))
    back = readers.read_catalog(spark, str(tmp_path), names=tables)
    for name, df in tables.items():
        assert rows(back[name]) == rows(df), name
        assert spark.table(name).count() == df.count()


def test_parse_all_dates(spark):
    orders = spark.createDataFrame([(1, "2020-01-05")], "order_id long, Order_Date string")
    parsed = readers.parse_all_dates({"orders": orders})["orders"]
    assert rows(parsed.select("order_date")) == [(d("2020-01-05"),)]


def test_publish_star(spark, tmp_path):
    tables = retail(spark)
    tables["inventory"] = tables["products"]
    tables["web_traffic"] = spark.createDataFrame(
        [(d("2020-01-01"), "ads", 0.5), (d("2020-02-01"), "ads", 0.4)],
        "date date, traffic_source string, bounce_rate double",
    )
    star = star_schema(tables)
    for fmt in ("parquet", "csv"):
        paths = writers.publish_star(star, str(tmp_path / fmt), fmt)
        assert list(paths) == [
            "dim_product", "dim_customer", "dim_promotion",
            "fact_sales", "fact_inventory", "fact_webtraffic",
        ]
        for name, path in paths.items():
            reader = spark.read.parquet(path) if fmt == "parquet" else readers.read_csv(spark, path)
            assert reader.count() == star[name].count(), (fmt, name)
    facts = spark.read.parquet(writers.current_star(spark, str(tmp_path / "parquet"))["fact_sales"])
    january = facts.where((F.col("part_year") == 2020) & (F.col("part_month") == 1))
    assert january.count() == star["fact_sales"].where(F.month("order_date") == 1).count()


def test_dated_export(spark, tmp_path):
    df = spark.createDataFrame([(d("2020-01-05"), 1.5)], "Date date, Revenue double")
    writers.write_csv(df, str(tmp_path / "out"), "Date")
    assert rows(readers.read_csv(spark, str(tmp_path / "out"))) == [("2020-01-05", "1.5")]


def test_a_failed_publication_leaves_the_old_star(spark, tmp_path):
    """The fourth table fails: the last whole version stays the current one."""
    root = str(tmp_path / "star")
    table = lambda v: spark.createDataFrame([(1, v), (2, None), (2, v)], "id int, name string")
    first = {f"t{i}": table("old") for i in range(5)}
    assert writers.publish_star(first, root) == writers.current_star(spark, root)
    broken = {f"t{i}": table("new") for i in range(5)}
    broken["t3"] = broken["t3"].withColumn("name", F.when(F.col("id") == 2, F.raise_error(F.lit("lost"))).otherwise("x"))
    with pytest.raises(Exception, match="lost"):
        writers.publish_star(broken, root)
    for path in writers.current_star(spark, root).values():
        assert rows(spark.read.parquet(path)) == [(1, "old"), (2, "old"), (2, None)]
    again = writers.publish_star({f"t{i}": table("new") for i in range(2)}, root)
    assert writers.current_star(spark, root) == again
    assert rows(spark.read.parquet(again["t1"])) == [(1, "new"), (2, "new"), (2, None)]


def test_stored_rows_must_be_those_written(spark, tmp_path, monkeypatch):
    table = spark.createDataFrame([(1, 0.5), (2, None)], "id int, v double")
    true = writers.write_parquet
    monkeypatch.setattr(writers, "write_parquet", lambda df, path, parts=(): (true(df, path, parts), df.limit(1).write.mode("overwrite").parquet(path)))
    with pytest.raises(RuntimeError, match="not stored"):
        writers.publish_star({"t": table}, str(tmp_path / "star"))
