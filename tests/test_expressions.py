from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from fieldprep.functions import clock, numeric, recode, text

A = F.col


@pytest.mark.parametrize(
    "given, expected",
    [
        ("cutts (hwy 93)", "Cutts (Hwy 93)"),
        ("OKANAGAN-north lake", "Okanagan-North Lake"),
        ("o'reilly 3rd", "O'reilly 3rd"),
        ("mt.robson", "Mt.robson"),
        ("straße ßa", "Straße Ssa"),
        ("élan vital", "Élan Vital"),
        ("plain WORDS 12th", "Plain Words 12th"),
        ("", ""),
        (None, None),
    ],
)
def test_title_case(one, given, expected):
    assert one({"a": ("string", given)}, text.title_case(A("a"))) == expected


@pytest.mark.parametrize(
    "make, given, expected",
    [
        (text.split_digits_from_letters, "100mile 20km", "100 mile 20km"),
        (lambda c: text.remove_first(c, ", Bc"), "a, Bc, Bc", "a, Bc"),
        (lambda c: text.replace_first(c, "(b)(c)", "$2$1"), "abcbc", "acbbc"),
        (text.between_commas, "Spokane, Washington, USA", "Washington"),
        (text.between_commas, "a, b, c, d", "b, c"),
        (text.between_commas, "a, b", None),
        (text.between_commas, "a, ,", ""),
        (text.before_comma, "Kelowna, British Columbia", "Kelowna"),
        (text.leading_word, "Fernie BC", "Fernie"),
        (text.leading_word, "Fernie", None),
        (text.province_code, "Fernie BC AB", "BC"),
        (text.without_province, "Fernie BC AB", "Fernie  "),
        (text.strip_country_prefix, "CA.BC", "BC"),
        (lambda c: text.strip_year_prefix(c, 2016), "2016-7-2016-", "7-2016-"),
        (text.plain_placename, "Montréal (QC) (x)", "Montreal"),
        (text.query_placename, "New Town (x)", "New%20Town"),
        (text.pad_clock, "2015-07-01 5:30", "2015-07-01 05:30:00"),
        (text.pad_clock, "2015-07-01 05:30", "2015-07-01 05:30:00"),
        (text.pad_clock, "2015-07-01 05:30:10", "2015-07-01 05:30:10"),
        (text.whole_number, "2.34", 2),
        (text.whole_number, "two", None),
    ],
)
def test_strings(one, make, given, expected):
    assert one({"a": ("string", given)}, make(A("a"))) == expected


def test_flags_know_unknown(one):
    cell = lambda v: {"a": ("string", v)}
    assert [one(cell(v), recode.normalise_flag_text(A("a"))) for v in (None, "TRUE", "FALSE", "x")] == ["false", "true", "false", "x"]
    assert [one(cell(v), recode.flag_text_to_boolean(A("a"))) for v in (None, "TRUE", "true", "yes")] == [None, True, True, False]
    assert [one(cell(v), recode.yes_no(A("a"))) for v in ("yes", "no", "maybe", None)] == ["true", "false", None, None]
    assert [one(cell(v), recode.flag_text(A("a") == "yes")) for v in ("yes", "no", None)] == ["true", "false", "false"]
    assert [one(cell(v), recode.in_set(A("a"), ["x"])) for v in ("x", "y", None)] == [True, False, False]
    assert [one(cell(v), recode.in_set(A("a"), ["x", None])) for v in ("x", "y", None)] == [True, False, True]
    assert one({"a": ("string", None), "b": ("boolean", True)}, recode.either_flag(A("a"), A("b"))) is True
    assert one({"a": ("string", None), "b": ("boolean", None)}, recode.either_flag(A("a"), A("b"))) is False


def test_rules_take_the_first_hit_and_keep_the_rest(one):
    rules = [("Keremeos (Hwy 3)", "Keremeos"), ("Hwy", "Road"), ("a.c", "dot")]
    cell = lambda v: one({"a": ("string", v)}, recode.recode_first_match(A("a"), rules))
    # Brackets of a pattern group: they match the text without brackets only.
    assert cell("Keremeos Hwy 3") == "Keremeos"
    assert cell("Keremeos (Hwy 3)") == "Road"
    assert cell("abc") == "dot"
    assert cell("other") == "other"
    assert cell(None) is None
    assert one({"a": ("string", "W")}, recode.recode_exact(A("a"), {"W": "WA"})) == "WA"


def test_other_falls_back_to_text(one):
    cell = lambda v, always=False: one(
        {"a": ("string", v), "b": ("string", "free")}, recode.other_to_text(A("a"), A("b"), always)
    )
    assert [cell("Other"), cell("Canoe"), cell(None)] == ["free", "Canoe", None]
    assert [cell("Canoe", True), cell(None, True)] == ["free", None]


def test_totals(one):
    total = lambda a, b: one({"a": ("string", a), "b": ("string", b)}, numeric.total_at_least_one(A("a"), A("b")))
    assert [total("0", "0"), total("2", "1"), total("1", None), total("1", "x")] == [1.0, 3.0, None, None]


@pytest.mark.parametrize(
    "given, expected",
    [
        ("2021-07-01 05:30:00", datetime(2021, 7, 1, 5, 30)),
        ("2021-07-01-05:30:00", datetime(2021, 7, 1, 5, 30)),
        ("2021/7/1 5.30.9", datetime(2021, 7, 1, 5, 30, 9)),
        ("2021-07-01T05:30:00Z", datetime(2021, 7, 1, 5, 30)),
        ("2021-07-01 05:30", None),
        ("2021-13-01 05:30:00", None),
        ("soon", None),
        (None, None),
    ],
)
def test_lenient_parse(one, given, expected):
    assert one({"a": ("string", given)}, clock.parse_wall_clock(A("a"))) == expected


def test_serials(one):
    cell = {"a": ("string", "42186.3125")}
    assert one(cell, clock.serial_to_timestamp(A("a"))) == datetime(2015, 7, 1, 7, 30)
    assert one(cell, clock.serial_to_date(A("a"))) == date(2015, 7, 1)
    assert one({"a": ("string", "n/a")}, clock.serial_to_timestamp(A("a")), clock.serial_to_date(A("a"))) == (None, None)


def test_zones(one):
    at = lambda v: {"a": ("timestamp_ntz", v)}
    summer, gap, doubled = datetime(2021, 7, 1, 6), datetime(2021, 3, 14, 2, 30), datetime(2021, 11, 7, 1, 30)
    force = lambda v: one(at(v), clock.force_zone(A("a"), clock.PACIFIC))
    assert force(summer) == datetime(2021, 7, 1, 13)
    assert force(gap) is None
    assert force(doubled) == datetime(2021, 11, 7, 8, 30)
    assert one(at(summer), clock.in_zone(A("a"), clock.PACIFIC)) == datetime(2021, 6, 30, 23)
    assert one(at(summer), clock.utc_clock(clock.to_instant(A("a")))) == summer


def test_instants_do_not_depend_on_the_session_zone(spark, one):
    at = {"a": ("timestamp_ntz", datetime(2021, 7, 1, 6))}
    expressions = clock.utc_clock(clock.to_instant(A("a"))), F.unix_micros(clock.to_instant(A("a")))
    before = one(at, *expressions)
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        assert one(at, *expressions) == before
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_hour_zero_belongs_to_the_end_of_the_day(one):
    at = lambda s: one(
        {"d": ("timestamp_ntz", datetime(2017, 5, 1, 12)), "s": ("string", s)},
        clock.date_plus_clock(A("d"), clock.seconds_of_clock_text(A("s"))),
    )
    assert at("00:05:00") == datetime(2017, 5, 2, 0, 5)
    assert at("11:30:00") == datetime(2017, 5, 1, 11, 30)
    assert at("late") is None


def test_hours(one):
    at = {"s": ("timestamp_ntz", datetime(2021, 7, 1, 8)), "e": ("timestamp_ntz", datetime(2021, 7, 1, 6, 30))}
    assert one(at, clock.shift_hours(A("s"), A("e"))) == 1.5
    assert one(at, clock.ceil_hour(A("e")), clock.ceil_hour(A("s"))) == (datetime(2021, 7, 1, 7), datetime(2021, 7, 1, 8))


def test_flags_in_capitals_and_iso_clocks(one):
    A = F.col
    assert one({"a": ("string", "TRUE"), "b": ("string", None)}, recode.either_flag(A("a"), A("b"))) is True
    read = lambda t: str(one({"a": ("string", t)}, clock.parse_iso_clock(A("a"))))
    assert read("2016-05-01 12:30") == "2016-05-01 12:30:00" and read("2016-05-01") == "2016-05-01 00:00:00"
    assert read("2016/5/1 1:2:3") == "2016-05-01 01:02:03" and read("May 1") == "None" and read("2016-13-01") == "None"
    cut = lambda t: one({"a": ("string", t)}, text.between_commas(A("a")))
    assert [cut(t) for t in ("City, Region, Country", "a, b, c, d", "a, b", "a,b,c", "no", None, "a, , b", "x\ny, z, w", "é, 日本, b")] == [
        "Region", "b, c", None, None, None, None, "", "z", "日本"]
