from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from eventstats import functions as fn

TIMES = [
    ("2015-09-22T16:01:01.910651+00:00", "2015-09-23 00:01:01"),
    ("2015-09-22 16:01:01.910651+00:00", "2015-09-23 00:01:01"),
    ("2015-09-22T16:01:01.910651+00", "2015-09-23 00:01:01"),
    ("2015-09-22T16:01:01.910651+0530", "2015-09-22 18:31:01"),
    ("2015-09-22T16:01:01+00:00", "2015-09-23 00:01:01"),
    ("2015-09-22T16:01:01Z", "2015-09-23 00:01:01"),
    ("2015-09-22T16:01:01-05:00", "2015-09-23 05:01:01"),
    ("2015-09-22T16:01:01.910+08:00", "2015-09-22 16:01:01"),
    ("2015-09-22T16:01:01", "2015-09-22 16:01:01"),
    ("2015-09-22 16:01:01.910651", "2015-09-22 16:01:01"),
    ('"2015-09-22T16:01:01+00:00"', "2015-09-23 00:01:01"),
    ("2015-03-08T02:30:00+08:00", "2015-03-08 02:30:00"),  # does not exist in New York
    ("2015-09-22T16:01:01.910651+", None),
    ("2015-09-22T16:01:01+99:00", None),
    ("2015-09-22", None),
    ("", None),
    (None, None),
    ("2015-13-22T16:01:01", None),
    ("2015-09-22T25:01:01", None),
    ("bad-time", None),
    ("some text that is longer than nineteen", None),
]


def test_normalize_time(values):
    got = values(fn.normalize_time(F.col("t")), [(t,) for t, _ in TIMES], "t string")
    assert got == [want for _, want in TIMES]


def test_normalize_time_default_offset(values):
    got = values(
        fn.normalize_time(F.col("t"), default_offset="+00:00"),
        [("2015-09-22 16:01:01",), ("2015-09-22 16:01:01+08:00",)],
        "t string",
    )
    assert got == ["2015-09-23 00:01:01", "2015-09-22 16:01:01"]


def test_time_bucket(values):
    rows = [("2015-10-26 14:59:59",), ("2015-10-26 14:00:00",)]
    for minutes, want in {
        1: [("14:59:00", "14:59:59"), ("14:00:00", "14:00:59")],
        10: [("14:50:00", "14:59:59"), ("14:00:00", "14:09:59")],
        60: [("14:00:00", "14:59:59"), ("14:00:00", "14:59:59")],
    }.items():
        start, end = fn.time_bucket(F.col("t"), minutes)
        assert values(start, rows, "t string") == [f"2015-10-26 {s}" for s, _ in want]
        assert values(end, rows, "t string") == [f"2015-10-26 {e}" for _, e in want]


@pytest.mark.parametrize("minutes", [0, 7, 45, 90])
def test_time_bucket_rejects_lengths_that_cross_the_hour(spark, minutes):
    with pytest.raises(ValueError):
        fn.time_bucket(F.col("t"), minutes)


def test_bucket_keys(values):
    want = {
        "minutely": "201511131658",
        "hourly": "2015111316",
        "daily": "20151113",
        "monthly": "201511",
        "yearly": "2015",
        "all": "",
    }
    for interval, key in want.items():
        got = values(fn.bucket_key(F.col("t"), interval), [("2015-11-13 16:58:01",)], "t string")
        assert got == [key]
    with pytest.raises(ValueError):
        fn.bucket_key(F.col("t"), "weekly")


def test_millis_both_ways(values):
    rows = [("1970-01-01 08:00:00",), ("2015-09-22 16:01:01",), ("1969-12-31 23:00:00",), ("x",)]
    ms = values(fn.text_to_millis(F.col("t")), rows, "t string")
    assert ms == [0, 1442908861000, -32400000, None]
    back = values(fn.millis_to_text(F.col("m")), [(m,) for m in ms[:3]], "m bigint")
    assert back == [r[0] for r in rows[:3]]
    day = values(fn.millis_to_text(F.col("m"), "yyyy/MM/dd"), [(ms[1],)], "m bigint")
    assert day == ["2015/09/22"]
    custom = fn.text_to_millis(F.col("t"), "yyyy/MM/dd", "+00:00")
    assert values(custom, [("1970/01/02",)], "t string") == [86400000]


def test_is_int32(values):
    rows = ["5", "-1", "+7", " 5 ", "5.0", "", None, "2147483647", "2147483648", "!5", "５"]
    got = values(fn.is_int32(F.col("t")), [(r,) for r in rows], "t string")
    assert got == [True, True, True, False, False, False, False, True, False, False, False]


def test_url_domain(values):
    rows = ["http://a.b/c", "https://a.b/", "http://a.b", "ftp://a.b/c", "plain", "", None]
    got = values(fn.url_domain(F.col("t")), [(r,) for r in rows], "t string")
    assert got == ["a.b", "a.b", "http://a.b", "ftp://a.b/c", "plain", "", None]


def test_blank_default_and_quotes(values):
    got = values(fn.blank_default(F.col("t"), "d"), [("a",), ("",), ("  ",), (None,)], "t string")
    assert got == ["a", "d", "d", "d"]
    got = values(fn.strip_quotes(F.col("t")), [('"a"',), ('""a',), ("a",), ('a"b',)], "t string")
    assert got == ["a", '"a', "a", 'a"b']


def test_duration_text(values):
    rows = {
        35: "35 ms", 999: "999 ms", 1000: "1.0 s", 1250: "1.3 s", 1500: "1.5 s",
        120_000: "2.0 m", 3_600_000: "1.00 h", 68_057_999: "18.91 h",
    }
    got = values(fn.duration_text(F.col("m")), [(m,) for m in rows], "m bigint")
    assert got == list(rows.values())


def test_typed_cast(values):
    def cast(text, name):
        return values(fn.typed_cast(F.col("t"), name), [(text,)], "t string")[0]

    assert (cast("5", "int"), cast("5", "Interger"), cast("5", "LONG")) == (5, 5, 5)
    assert (cast("5.5", "double"), cast("5", "text"), cast("x", "int")) == (5.5, "5", None)


def test_doc_id_does_not_depend_on_column_order(values):
    a = values(fn.doc_id("b", "a"), [("1", "2")], "a string, b string")
    b = values(fn.doc_id("a", "b"), [("2", "1")], "b string, a string")
    assert a == b == [hashlib.md5(b'{"a":"1","b":"2"}').hexdigest()]


AGENTS = [("app TV/", "tv"), ("app", "phone"), ("app Pad/", "never, the prefix before fits")]


def test_platform_takes_the_first_prefix(values):
    rows = [("app TV/1",), ("app Pad/1",), ("x app TV/",), (None,)]
    got = values(fn.platform_of(F.col("t"), AGENTS), rows, "t string")
    assert got == ["tv", "phone", "web", "web"]


def test_event_group_defaults(values):
    rows = {
        "api.user.register": "register",
        "edx.course.enrollment.activated": "enrollment",
        "x/courses/a/courseware/b": "access_courseware",
        "/courses/courseware/": "unknown",
        "": "unknown",
    }
    got = values(fn.event_group(F.col("t")), [(r,) for r in rows], "t string")
    assert got == list(rows.values())


def test_resolve_user_id(values):
    rows = {
        ("5", "6", "n", "u"): "5",
        ("-1", "6", "n", "u"): "6",
        ("-1", "-1", "n", "u"): "n",
        ("!u", None, "", "u"): "u",
        ("!u", "", None, None): "!u",
        ("99999999999", None, None, None): "99999999999",
        (None, None, None, None): "",
    }
    col = fn.resolve_user_id(*[F.col(c) for c in "abcd"])
    got = values(col, list(rows), "a string, b string, c string, d string")
    assert got == list(rows.values())


def test_resolve_user_id_strict(values):
    rows = {
        (5, 6, 7, "n", "u"): "5",
        (0, 6, 7, "n", "u"): "6",
        (-1, -1, 7, "n", "u"): "7",
        (None, None, 0, " ", "u"): "u",
        (None, None, None, None, None): "",
    }
    col = fn.resolve_user_id_strict([F.col(c) for c in "abc"], F.col("d"), F.col("e"))
    got = values(col, list(rows), "a bigint, b bigint, c bigint, d string, e string")
    assert got == list(rows.values())


PROCESS = {
    ("1", "-1", None, None): 1,
    ("1", "0", None, None): 0,
    ("0", "-1", "2020-01-01 00:00:00", None): -1,
    ("0", "0", None, None): -1,
    ("0", "0", "2030-01-01 00:00:00", None): -1,
    ("0", "0", "2020-01-01 00:00:00", None): 0,
    ("0", "0", "2020-01-01 00:00:00", "2030-01-01 00:00:00"): 0,
    ("0", "0", "2020-01-01 00:00:00", "2021-01-01 00:00:00.0"): 1,
    ("0", "0", "no time", "2021-01-01 00:00:00"): 1,
    ("0", "0", "2020-01-01 00:00:00", "no time"): 0,
    ("2", "-1", None, None): -1,
    (None, None, None, None): -1,
}


def test_course_process(values):
    now = F.lit("2025-01-01 00:00:00").cast("timestamp_ntz")
    col = fn.course_process(*[F.col(c) for c in "abcd"], now)
    got = values(col, list(PROCESS), "a string, b string, c string, d string")
    assert got == list(PROCESS.values())
    exists = fn.course_process(*[F.col(c) for c in "abcd"], now, finished=F.lit(True))
    assert values(exists, [("0", "0", "2020-01-01 00:00:00", None)],
                  "a string, b string, c string, d string") == [1]


def test_course_process_has_a_default_clock(values):
    col = fn.course_process(*[F.col(c) for c in "abcd"])
    got = values(col, [("0", "0", "2020-01-01 00:00:00", "2021-01-01 00:00:00")],
                 "a string, b string, c string, d string")
    assert got == [1]
