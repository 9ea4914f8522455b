import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from shelfmatch.functions import dates as D
from shelfmatch.functions import fields as C
from shelfmatch.functions.rounding import round_exact, round_scaled


def test_round_exact_is_half_even_on_the_stored_value(apply):
    random.seed(5)
    values = [2.675, 1.005, 0.125, 0.135, 0.285, 1.115, -2.675, -0.125, 0.0, 1e15, 123456.785]
    values += [random.randint(0, 10**7) / 1000 for _ in range(3000)] + [random.random() * 100 for _ in range(500)]
    for digits in (2, 4):
        assert apply(lambda x: round_exact(x, digits), values, "x double") == [round(v, digits) for v in values]


def test_round_scaled(apply):
    assert apply(lambda x: round_scaled(x, 2), [0.125, 0.135, 2.675], "x double") == [0.12, 0.14, 2.68]


@pytest.mark.parametrize("text, value", [
    ("$1,234.50", 1234.5), ('"12"', 12.0), ("35.9 c/u", 35.9), ("12.345", round(12.345, 2)),
    ("n/a", None), ("", None), ("12d", None), ("nan", None), (None, None), ("1e2", 100.0), (".5", 0.5), ("5.", 5.0), ("u12c", 12.0),
])
def test_parse_price(apply, text, value):
    assert apply(C.parse_price, [text]) == [None if value is None else pytest.approx(value)]


def test_parse_price_first_version(apply):
    assert apply(lambda x: C.parse_price(x, digits=None, on_error=0.0), ["x", "1.23456"]) == [0.0, 1.23456]


def test_check_url(apply):
    texts = ["http://a.b/c", "https://x-y.z", "shop.example.com/p", "short.com", None, "ftp://example.com"]
    assert apply(C.check_url, texts) == ["http://a.b/c", "https://x-y.z", "https://shop.example.com/p", None, None, "https://ftp://example.com"]


def test_split_gift(apply):
    texts = ["leche + vaso + taza", "leche+vaso", "leche"]
    assert apply(lambda x: C.split_gift(x)[0], texts) == ["leche", "leche+vaso", "leche"]
    assert apply(lambda x: C.split_gift(x)[1], texts) == ["vaso + taza", "None", "None"]


def test_check_name(apply):
    texts = ["LECHE de LALA 1l", "dos palabras", "a b c", "ñandú ES grande", "agua  doble"]
    assert apply(C.check_name, texts) == ["Leche de Lala 1l", None, None, "Ñandú es Grande", "Agua  Doble"]


def test_ids_and_zone(apply):
    assert apply(C.strip_zeros, ["00012 ", "0", " 01", "100"]) == ["12", "", "01", "100"]
    assert apply(C.float_id, [12.0, 3.9], "x double") == ["12", "3"]
    assert apply(C.replace_zone, ["unique", "uniques", None]) == ["Nacional", "uniques", None]


def test_sanitize_name():
    assert C.sanitize_name("c_Big - Store_sku") == "c_Big_Store_sku"


def test_parse_dmy(apply):
    texts = ["05-01-26", "5-1-26", "31-02-26", "01-01-69", "01-01-68", "2026-01-05", "05/01/26", "x", None]
    assert apply(D.parse_dmy, texts) == [
        dt.date(2026, 1, 5), dt.date(2026, 1, 5), None, dt.date(1969, 1, 1), dt.date(2068, 1, 1), None, None, None, None]


def test_two_formats_and_weeks(apply):
    assert apply(D.parse_two_formats, ["05-01-26", "2026-1-5", "05.01.26"]) == [dt.date(2026, 1, 5), dt.date(2026, 1, 5), None]
    days = [dt.date(2023, 1, 1), dt.date(2024, 1, 1), dt.date(2022, 12, 31), dt.date(2021, 1, 3), dt.date(2021, 1, 2)]
    assert apply(D.week_of_year, days, "x date") == [int(d.strftime("%U")) for d in days]


def test_formats(apply):
    day = [dt.date(2023, 11, 10)]
    assert apply(D.to_dmy, day, "x date") == ["10-11-23"]
    assert apply(D.to_ydm, day, "x date") == ["2023-10-11"]
    assert apply(D.to_ddmmyyyy, day, "x date") == ["10112023"]
    assert D.as_date("10-11-23") == D.as_date("2023-11-10") == day[0]


def test_lookback_excludes_the_fifteenth_day_back(apply):
    days = [dt.date(2026, 1, d) for d in (4, 5, 6, 20, 21)]
    assert apply(lambda x: D.in_lookback(x, F.lit("2026-01-20").cast("date")), days, "x date") == [False, False, True, True, False]


def test_local_today(apply):
    now = [dt.datetime(2026, 1, 5, 5, 59), dt.datetime(2026, 1, 5, 6, 0)]
    assert apply(D.local_today, now, "x timestamp") == [dt.date(2026, 1, 4), dt.date(2026, 1, 5)]


def test_large_values_are_rounded(apply):
    assert apply(lambda x: round_exact(x, 2), [20000000000000.00390625, 9e15, float("inf")], "x double") == [20000000000000.0, 9e15, float("inf")]


def test_row_key_keeps_nulls_apart(spark):
    from shelfmatch.operators.catalog import row_key

    rows = spark.createDataFrame([("a", None), (None, "a"), ("a", ""), ("a", None)], "x string, y string")
    assert rows.select(row_key("x", "y")).distinct().count() == 3


def test_competitors_of_one_column_name_are_an_error(spark):
    from shelfmatch.operators.reports import column_names

    assert column_names(["a b", "c"]).keys() == {"a b", "c"}
    with pytest.raises(ValueError, match="a-b, ab"):
        column_names(["ab", "a-b", "c"])
