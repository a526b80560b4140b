"""ST1-ST3, T4, P10: gap edges, url cap, ties, chunk stitching, invariants."""

from datetime import datetime, timedelta

from conftest import rows

from logweave.operators import sessions

T0 = datetime(2024, 1, 1, 0, 0, 0)


def _rows(spark, spec):
    """spec: list of (ip, seconds offset, url, status)."""
    data = [(i, ip, T0 + timedelta(seconds=s), u, st) for i, (ip, s, u, st) in enumerate(spec)]
    return spark.createDataFrame(data, "event_id long, ip string, ts timestamp_ntz, url string, status string")


def test_gap_boundaries(spark):
    spec = [("a", 0, "/1", "200"), ("a", 1799, "/2", "200"),       # 29:59 -> same
            ("a", 1799 + 1800, "/3", "200"),                        # 30:00 -> same
            ("a", 1799 + 1800 + 1801, "/4", "500")]                 # 30:01 -> new
    got = rows(sessions.sessions(_rows(spark, spec), chunk="10 minutes"),
               "session_start", "sessionLength", "clickstream", "successCodes", "errorCodes")
    assert got == [(T0, 3, ["/1", "/2", "/3"], 3, 0),
                   (T0 + timedelta(seconds=5400), 1, ["/4"], 0, 1)]


def test_first_ten_urls_and_ties(spark):
    spec = [("b", i // 2, f"/u{i}", "404") for i in range(11)]      # equal timestamps in pairs
    spec += [("c", i, f"/c{i}", "200") for i in range(9)] + [("d", i, f"/d{i}", "200") for i in range(10)]
    got = {r["ip"]: r for r in sessions.sessions(_rows(spark, spec), chunk="5 seconds").collect()}
    assert got["b"]["clickstream"] == [f"/u{i}" for i in range(10)]   # first 10, ties by input order
    assert got["b"]["sessionLength"] == 11 and got["b"]["errorCodes"] == 11   # all-error session
    assert len(got["c"]["clickstream"]) == 9 and len(got["d"]["clickstream"]) == 10


def _brute(spec, gap=1800):
    out, state = {}, {}
    for i, (ip, s, u, st) in sorted(enumerate(spec), key=lambda x: (x[1][0], x[1][1], x[0])):
        last = state.get(ip)
        if last is None or s - last[1] > gap:
            last = [s, s, 0, [], 0, 0]
        last[1] = s
        last[2] += 1
        if len(last[3]) < 10:
            last[3] = last[3] + [u]
        ok = st.isdigit() and 200 <= int(st) < 400
        last[4 if ok else 5] += 1
        state[ip] = last
        out[i] = (ip, T0 + timedelta(seconds=last[0]), last[2], list(last[3]), last[4], last[5])
    return out


def test_session_updates_match_brute_force_across_chunks(spark):
    import random
    rnd = random.Random(7)
    spec = []
    for ip in ["hot", "x", "y"]:
        t = 0
        for _ in range(300 if ip == "hot" else 40):
            t += rnd.choice([5, 60, 600, 1799, 1800, 1801, 4000])
            spec.append((ip, t, f"/p{rnd.randint(0, 30)}", rnd.choice(["200", "302", "404", "500", "x"])))
    df = _rows(spark, spec)
    upd = sessions.session_updates(df, chunk="15 minutes")
    got = {r["event_id"]: (r["ip"], r["session_start"], r["sessionLength"], r["clickstream"],
                           r["successCodes"], r["errorCodes"]) for r in upd.collect()}
    assert got == _brute(spec)
    # invariant: the session lengths add up to the input rows
    total = sessions.sessions(df, chunk="15 minutes").agg({"sessionLength": "sum"}).first()[0]
    assert total == len(spec)


def test_null_key_sessions(spark):
    spec = [(None, 0, "/a", "200"), (None, 10, "/b", "200")]
    got = sessions.sessions(_rows(spark, spec)).collect()
    assert len(got) == 1 and got[0]["sessionLength"] == 2


def test_live_sessions(spark):
    spec = [("a", 0, "/1", "200"), ("b", 5300, "/2", "200"), ("c", 5000, "/9", "200"), ("a", 7000, "/3", "200")]
    s = sessions.sessions(_rows(spark, spec))
    from pyspark.sql import functions as F
    live = sessions.live_sessions(s, F.lit(T0 + timedelta(seconds=7000)))
    assert rows(live, "ip", "sessionLength") == [("a", 1), ("b", 1)]   # c idle 2000 s > 30 min
