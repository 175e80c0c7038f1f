import datetime

import pytest
from pyspark.sql import functions as F

from lexstrata.functions import dates, numbers, text


def one(spark, column, *values):
    names = [f"c{k}" for k in range(len(values))]
    df = spark.createDataFrame([values], ", ".join(f"{n} string" for n in names))
    return df.select(column(*[F.col(n) for n in names]).alias("x")).first().x


DAY = datetime.date(2026, 8, 19)


@pytest.mark.parametrize(("given", "want"), [("19.08.2026", DAY), ("2026-08-19", DAY), ("19/08/2026", DAY), ("1.8.2026", datetime.date(2026, 8, 1)), ("19.99.2026", None), ("", None), (None, None)])
def test_parse_date(spark, given, want):
    assert one(spark, dates.parse_date, given) == want


def test_bad_and_shown_dates(spark):
    assert [one(spark, dates.bad_date, v) for v in ("19.99.2026", "", None, "19.08.2026")] == [True, False, False, False]
    assert one(spark, lambda c: dates.format_date(dates.parse_date(c)), "2026-08-19") == "19.08.2026"
    assert one(spark, lambda c: dates.format_date(dates.parse_date(c)), None) == ""
    assert one(spark, lambda c: dates.closing_date(dates.parse_date(c)), "01.03.2024") == datetime.date(2024, 2, 29)


@pytest.mark.parametrize(("kind", "have", "want", "fits"), [("point", "1)", "1", True), ("point", "1", "1)", True), ("part", "1.", "1", True), ("part", "II", "2", True), ("part", "", None, True), ("part", "5", None, False), ("appendix", "5", None, True), ("preamble", None, None, True), ("point", "2", "1", False)])
def test_number_matches(spark, kind, have, want, fits):
    assert one(spark, numbers.number_matches, kind, have, want) is fits


def test_numbers(spark):
    assert [one(spark, numbers.roman_value, v) for v in ("XIV", "iv", "MCMXC", "IIII", "", "abc")] == [14, 4, 1990, None, None, None]
    assert [one(spark, numbers.number_tuple, v) for v in ("1.2)", "5²", "x", None, "10")] == [[1, 2], [5, 2], [0], [0], [10]]
    assert one(spark, lambda c: numbers.item_number(F.lit("point"), c), "1") == "1)"
    assert one(spark, lambda c: numbers.item_number(F.lit("article"), c), "5.1") == "5.1"
    assert one(spark, numbers.clean_number, "s") == "s"
    assert one(spark, numbers.sup_tags_to_unicode, "5<sup>12</sup> x") == "5¹² x"
    assert [one(spark, numbers.ordinal, v) for v in ("первый", "десятая", "7", "нет")] == [1, 10, 7, None]
    assert one(spark, numbers.number_path, "1)->а)") == ["1", "а"]
    assert one(spark, lambda c: numbers.shift_position(c, F.lit(3), F.lit(2)), "5-1") == "7-1"


def test_text(spark):
    assert one(spark, text.base_type, "Пункта") == "пункт"
    assert one(spark, text.element_type, "статью") == "article"
    assert one(spark, text.without_tags, "<p>a  <b>b</b></p>") == "a b"
    assert one(spark, text.paragraphs, "<p>a</p><p> </p><p>b</p>") == ["a", "b"]
    assert one(spark, text.paragraphs, "plain") == ["plain"]
    assert one(spark, text.paragraphs, None) == []
    assert one(spark, text.without_thinking, "<think>x</think>\n```json\n{}\n```") == "{}"
    assert one(spark, lambda c: text.without_leading_number(c, F.lit("1)")), "<p>1) text</p>") == "<p>text</p>"
    assert one(spark, text.file_number, "№ 380-ЗС") == "380"
    assert one(spark, text.file_number, None) == "unknown"
    assert [tuple(p) for p in one(spark, text.replacement_pairs, "слова «a b» заменить словами «c»")] == [("a b", "c")]
    assert one(spark, text.listed_numbers, "пункты 3-5, 7") == [3, 4, 5, 7]
