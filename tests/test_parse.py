"""P1-P10, F1 on literal access-log lines (FIXTURES.md section 2)."""

from datetime import datetime

from conftest import rows

from logweave.operators import parse

GOOD = '66.249.75.159 - - [29/Nov/2015:03:50:05 +0000] "GET /robots.txt HTTP/1.1" 200 55 "-" "Googlebot"'
LINES = [
    (1, GOOD),
    (2, ' - - [29/Nov/2015:03:50:06 +0000] "GET /a HTTP/1.1" 404 1 "http://r/" "UA one"'),      # missing ip
    (3, "this is not a log line"),                                                               # corrupt
    (4, "junk " + GOOD),                                                                         # prefix junk
    (5, GOOD + " junk"),                                                                         # suffix junk
    (6, '1.2.3.4 - - [29/Nov/2015:03:50:07 +0000] "GET" 302 - "-" "ua"'),                       # 1 token, bytes -
    (7, '1.2.3.4 - - [29/Nov/2015:03:50:08 +0000] "GET /two" 500 10 "-" "ua"'),                 # 2 tokens
    (8, '1.2.3.4 - - [29/Nov/2015:03:50:09 +0000] "GET /x HTTP/1.1 extra" 599 10 "-" "ua"'),    # 4 tokens
    (9, '1.2.3.4 - - [29/Nov/2015:03:50:10 +0000] "GET /y HTTP/1.1 " 199 10 "-" "ua"'),         # trailing space
    (10, '1.2.3.4 - - [29/Foo/2015:03:50:11 +0000] "GET /z HTTP/1.1" 299 10 "-" "ua"'),         # bad month
    (11, '1.2.3.4 - - [29/Nov/2015:03:50:12 +0000] "GET /q"uote HTTP/1.1" 399 10 "-" "ua"'),    # quote in request
]


def _lines(spark):
    return spark.createDataFrame(LINES, "id int, value string")


def test_log_entries_drop_corrupt_and_parse(spark):
    e = parse.log_entries(_lines(spark), keep=["id"])
    got = {r["id"]: r for r in e.collect()}
    assert set(got) == {1, 2, 6, 7, 8, 9, 10, 11}
    assert got[1]["ip"] == "66.249.75.159" and got[1]["status"] == "200" and got[1]["agent"] == "Googlebot"
    assert got[1]["ts"] == datetime(2015, 11, 29, 3, 50, 5)
    assert got[1]["dateTime"] == "2015-11-29 03:50:05.0"
    assert got[2]["ip"] is None and got[2]["referer"] == "http://r/"
    assert got[6]["bytes"] == "-"
    assert got[10]["ts"] is None and got[10]["dateTime"] == ""
    assert got[11]["request"] == 'GET /q"uote HTTP/1.1'


def test_field_or_error(spark):
    r = dict(rows(parse.field_or_error(_lines(spark), "referer", keep=["id"])))
    assert r[1] == "-" and r[3] == "[error]" and r[4] == "[error]" and r[5] == "[error]"


def test_requests_and_sentinels(spark):
    r = {t[0]: t[1:] for t in rows(parse.requests(_lines(spark), keep=["id"]))}
    assert r[1] == ("/robots.txt", 200, "Googlebot")
    assert r[3] == ("error", 0, "error")
    assert r[6][0] == "[error]"            # one token
    assert r[7][0] == "/two" and r[8][0] == "/x" and r[9][0] == "/y"
    k = {t[0]: t[1:] for t in rows(parse.keyed_requests(_lines(spark), keep=["id"]))}
    assert k[3] == ("error", "error", 0, "error") and k[2][0] is None
    s = {t[0]: t[1:] for t in rows(parse.session_requests(_lines(spark), keep=["id"]))}
    assert s[3] == ("error", "error", "0") and s[1] == ("66.249.75.159", "/robots.txt", "200")


def test_strict_url(spark):
    u = dict(rows(parse.strict_urls(_lines(spark), keep=["id"])))
    assert u[1] == "/robots.txt"
    assert u[6] == u[7] == u[8] == "[error]"      # 1, 2 and 4 tokens
    assert u[9] == "/y"                           # trailing space: Java split drops the empty token
    assert u[3] == "[error]"                      # bad line


def test_status_classes(spark):
    c = dict(rows(parse.status_classes(_lines(spark), keep=["id"])))
    assert c[1] == "Success" and c[7] == "Failure" and c[8] == "Failure"
    assert c[9] == "Other" and c[10] == "Success" and c[6] == "Other" and c[3] == "Other" and c[2] == "Other"


def test_success_predicate(spark):
    from pyspark.sql import functions as F

    from logweave.functions.accesslog import is_success_code
    df = spark.createDataFrame([("199",), ("200",), ("302",), ("399",), ("400",), ("abc",)], "s string")
    got = dict(rows(df.select("s", is_success_code(F.col("s")).alias("ok"))))
    assert got == {"199": False, "200": True, "302": True, "399": True, "400": False, "abc": False}


def test_decode_payload(spark):
    df = spark.createDataFrame([(bytearray(GOOD.encode()),)], "body binary")
    assert parse.decode_payload(df).first()["value"] == GOOD


def test_control_characters_keep_their_field(spark):
    bad = ["a\u0001b\u0002c", "\u0001", "\u0002a\u0001b\u0002", "\u0000LW\u0001x"]
    lines = [(i, f'1.2.3.4 c{b} u [29/Nov/2015:03:50:05 +0000] "GET /{b} HTTP/1.1" 200 55 "{b}" "ua {b}"') for i, b in enumerate(bad)]
    lines += [(10 + i, f"\u0000LW\u0001{b} no log line") for i, b in enumerate(bad)]
    out = {r.id: r for r in parse.log_entries(spark.createDataFrame(lines, "id int, value string"), keep=["id"]).collect()}
    assert sorted(out) == [0, 1, 2, 3]
    for i, b in enumerate(bad):
        r = out[i]
        assert (r.ip, r.client, r.user, r.request, r.status, r.referer, r.agent) == (
            "1.2.3.4", "c" + b, "u", f"GET /{b} HTTP/1.1", "200", b, "ua " + b)


def test_wall_clock_in_a_gap_of_the_session_zone(spark):
    """02:30 does not exist on that day in New York; the log's wall clock is kept all the same."""
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        line = '1.2.3.4 - - [08/Mar/2015:02:30:00 -0500] "GET /a HTTP/1.1" 200 55 "-" "ua"'
        r = parse.log_entries(spark.createDataFrame([(line,)], "value string")).collect()[0]
        assert r.ts == datetime(2015, 3, 8, 2, 30) and r.dateTime == "2015-03-08 02:30:00.0"
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
