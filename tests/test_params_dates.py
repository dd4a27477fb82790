"""Parameter extraction edges and date helpers."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from touchpath.functions import dates as D
from touchpath.functions.params import INT, event_param

PSCHEMA = ("id int, event_params array<struct<key:string,value:struct<string_value:string,int_value:bigint,"
           "float_value:double,double_value:double>>>")


def _p(k, s=None, i=None):
    return (k, (s, i, None, None))


def test_param_edges(spark):
    rows = [
        (1, [_p("a", "x"), _p("b", None, 5)]),
        (2, [_p("b", None, 6)]),                  # missing key
        (3, [_p("a", "first"), _p("a", "second")]),  # duplicate key
        (4, []),                                  # empty array
        (5, None),                                # NULL array
        (6, [_p("a", None, 7)]),                  # wrong value slot
    ]
    df = spark.createDataFrame(rows, PSCHEMA)
    got = {r.id: (r.a, r.b) for r in df.select("id", event_param("a").alias("a"),
                                               event_param("b", INT).alias("b")).collect()}
    assert got == {1: ("x", 5), 2: (None, 6), 3: ("first", None), 4: (None, None), 5: (None, None), 6: (None, None)}
    with pytest.raises(Exception):
        df.select(event_param("a", on_duplicate="error")).collect()


def test_date_helpers(spark):
    assert D.minus_years(date(2024, 2, 29)) == date(2023, 2, 28)
    assert D.prev_year_bounds(date(2024, 2, 29), 120) == (date(2022, 10, 31), date(2023, 2, 28))
    assert D.last_n_days_bounds(date(2024, 1, 1), 2) == (date(2023, 12, 30), date(2023, 12, 31))
    df = spark.createDataFrame([("tbl/events_20240229/x.parquet",), ("tbl/events_intraday_20231231/y",), ("other",)], "p string")
    got = [r.d for r in df.select(D.shard_date(F.col("p")).alias("d")).collect()]
    assert got == [date(2024, 2, 29), date(2023, 12, 31), None]
    df = spark.createDataFrame([("a1b22",), ("none",)], "s string")
    assert [r.n for r in df.select(D.first_number(F.col("s")).alias("n")).collect()] == ["1", None]
    x = spark.createDataFrame([(date(2023, 3, 1),), (date(2023, 3, 2),), (date(2024, 3, 1),), (date(2024, 3, 2),)], "d date")
    got = [r.d for r in x.where(D.last_n_days_prev_year(F.col("d"), date(2025, 3, 1), 365)).collect()]
    assert got == [date(2023, 3, 2), date(2024, 3, 1)]   # leap year: 2024-03-01 minus 365 days


def test_items_json_and_page_paths(spark):
    from touchpath.functions.keys import items_json
    from touchpath.functions.paths import page_path, page_path_and_querystring
    df = spark.createDataFrame([(1, [("a",)]), (2, [(None,)]), (3, []), (4, None)],
                               "id int, items array<struct<item_id:string>>")
    got = {r.id: r.j for r in df.select("id", items_json(F.col("items")).alias("j")).collect()}
    assert got == {1: '[{"item_id":"a"}]', 2: '[{"item_id":null}]', 3: "[]", 4: "[]"}
    urls = spark.createDataFrame([
        ("https://www.shop.de/p/1?q=2?z",), ("http://www.shop.co.uk/x",), ("https://www.shop.store/x",),
        ("https://other.example/x?y=1",), (None,), ("",)], "u string")
    got = [(r.p, r.q) for r in urls.select(page_path(F.col("u"), "shop").alias("p"),
                                           page_path_and_querystring(F.col("u"), "shop").alias("q")).collect()]
    assert got == [("/p/1", "/p/1?q=2?z"), ("/x", "/x"), ("e/x", "e/x"),   # long TLD leaves a rest
                   ("https://other.example/x", "https://other.example/x?y=1"), (None, None), ("", "")]


def test_parse_yyyymmdd_strict_and_safe(spark):
    df = spark.createDataFrame([("20240229",), ("2024-02-30",)], "s string")
    got = [r.d for r in df.select(D.parse_yyyymmdd(F.col("s"), safe=True).alias("d")).collect()]
    assert got == [date(2024, 2, 29), None]
    if spark.conf.get("spark.sql.ansi.enabled") == "true":
        with pytest.raises(Exception):
            df.select(D.parse_yyyymmdd(F.col("s")).alias("d")).collect()
