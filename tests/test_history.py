"""SCD2, as-of lookups and range lookups against brute force."""

import ipaddress
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from clickstar.operators import locate, scd2
from clickstar.operators.carry import carry_value, time_chunk


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def history(spark):
    """Events of five devices over half a year; one device has a third of them, some clash in a second."""
    draw = random.Random(7)
    rows = []
    for i in range(1500):
        device = "hot" if i % 3 == 0 else f"d{draw.randrange(4)}"
        second = draw.randrange(180) * 86400 + draw.randrange(3)
        rows.append((i, device, second, draw.choice(["a", "b", None]), draw.choice([None, None, "u"]), draw.choice([None, "e"])))
    return pd.DataFrame(rows, columns=["id", "device", "second", "agent", "user", "email"]).astype({"agent": object, "user": object, "email": object})


def frame(spark, history):
    df = spark.createDataFrame(
        [tuple(None if pd.isna(v) else v for v in row) for row in history.itertuples(index=False)],
        "id int, device string, second long, agent string, user string, email string",
    )
    return df.withColumn("ts", F.timestamp_seconds("second"))


def brute_versions(history):
    found = {}
    for device, events in history.groupby("device"):
        best = {}
        for row in events.itertuples():
            state = tuple(None if pd.isna(v) else v for v in (row.email, row.user, row.agent))
            rank = tuple(v is not None for v in state) + tuple(v or "" for v in state)
            if row.second not in best or rank > best[row.second][0]:
                best[row.second] = (rank, state)
        versions, previous = [], object()
        for second in sorted(best):
            if best[second][1] != previous:
                previous = best[second][1]
                versions.append([second, previous])
        found[device] = versions
    return found


def test_versions_match_brute_force(spark, history):
    versions = scd2.build_versions(
        frame(spark, history), "device", "ts", ["agent", "user", "email"], ["email", "user", "agent"], chunk_days=14
    )
    got = {}
    for row in versions.select("*", F.unix_seconds("start_time").alias("s")).orderBy("device", "s").collect():
        got.setdefault(row["device"], []).append([row["s"], (row["email"], row["user"], row["agent"])])
    assert got == brute_versions(history)


def test_versions_tile_time(spark, history):
    versions = scd2.build_versions(frame(spark, history), "device", "ts", ["agent", "user", "email"], chunk_days=14)
    pdf = versions.select(
        "device", F.unix_seconds("start_time").alias("s"), F.unix_seconds("end_time").alias("e"), "is_current"
    ).toPandas().sort_values(["device", "s"])
    for _, own in pdf.groupby("device"):
        assert list(own["s"])[1:] == list(own["e"])[:-1]
        assert own["is_current"].sum() == 1 and own["is_current"].iloc[-1]


def test_golden_versions(spark):
    rows = [("d", t, s) for t, s in zip(range(1, 6), "AABBA")] + [("d", 3, None), ("d", None, "Z"), (None, 1, "Z")]
    df = spark.createDataFrame(rows, "device string, second long, agent string").withColumn("ts", F.timestamp_seconds("second"))
    versions = scd2.build_versions(df, "device", "ts", ["agent"])
    got = versions.select(F.unix_seconds("start_time"), "agent", "is_current").orderBy("start_time").collect()
    assert [tuple(r) for r in got] == [(1, "A", False), (3, "B", False), (5, "A", True)]


def test_null_is_a_change(spark):
    df = spark.createDataFrame([("d", 1, None), ("d", 2, "A"), ("d", 3, None)], "device string, s long, a string")
    versions = scd2.build_versions(df.withColumn("ts", F.timestamp_seconds("s")), "device", "ts", ["a"])
    assert versions.count() == 3


@pytest.mark.parametrize("days", [1, 30, 1000])
def test_asof_matches_brute_force(spark, history, days):
    versions = scd2.build_versions(frame(spark, history), "device", "ts", ["agent", "user", "email"])
    draw = random.Random(3)
    points = [(i, draw.choice(["hot", "d0", "d1", "none", None]), draw.randrange(-5 * 86400, 200 * 86400)) for i in range(800)]
    points += [(1000 + i, d, v[0][0]) for i, (d, v) in enumerate(brute_versions(history).items())]
    facts = spark.createDataFrame(points, "i int, device string, second long").withColumn("at", F.timestamp_seconds("second"))
    found = scd2.asof_lookup(facts, versions, on=("device", "device"), ts="at", key="version_key", chunk_days=days)
    brute = facts.alias("f").join(
        versions.alias("v"),
        F.expr("f.device = v.device AND f.at >= v.start_time AND f.at < v.end_time"), "left",
    )
    got = sorted((r["i"], r["version_key"]) for r in found.select("i", "version_key").collect())
    want = sorted((r["i"], r["version_key"]) for r in brute.select("i", "version_key").collect())
    assert got == want
    assert "NestedLoop" not in plan(found) and "Cartesian" not in plan(found)


@pytest.mark.parametrize("ahead", [False, True])
@pytest.mark.parametrize("inclusive", [False, True])
def test_carry_matches_plain_window(spark, history, ahead, inclusive):
    df = frame(spark, history).withColumns(
        {"day": time_chunk(F.col("ts"), 1), "week": time_chunk(F.col("ts"), 7)}
    )
    carried = carry_value(df, ["device"], ["week", "day"], ["ts", "id"], "agent", "out", inclusive=inclusive, ahead=ahead)
    plain = carry_value(df, ["device"], [], ["ts", "id"], "agent", "out", inclusive=inclusive, ahead=ahead)
    rows = [sorted((r["id"], r["out"] or "") for r in x.select("id", "out").collect()) for x in (carried, plain)]
    assert rows[0] == rows[1]


def place_rows(ranges):
    return [(a, b, f"city {i}", "r", "DE", "Germany", "1.5", "x") for i, (a, b) in enumerate(ranges)]


RANGE = "city_name string, region_name string, country_code string, country_name string, latitude string, longitude string"


def test_ranges_match_brute_force(spark):
    draw = random.Random(5)
    edges = sorted(draw.sample(range(2**20, 2**27), 400))
    v4 = [(a, b - draw.choice([0, 1, 5000])) for a, b in zip(edges[::2], edges[1::2])]
    base = int(ipaddress.ip_address("2001:db8::"))
    cuts = sorted(draw.randrange(2**90) for _ in range(60))
    v6 = [(base + a, base + b) for a, b in zip(cuts[::2], cuts[1::2])]
    probes = [draw.randrange(2**20, 2**27) for _ in range(300)] + [x for r in v4 for x in r]
    texts = [str(ipaddress.IPv4Address(p)) for p in probes]
    texts += [str(ipaddress.IPv6Address(base + draw.randrange(2**90))) for _ in range(60)]
    texts += [str(ipaddress.IPv6Address(x)) for r in v6 for x in r]
    texts = sorted(set(texts))
    r4 = spark.createDataFrame(place_rows(v4), f"ip_from long, ip_to long, {RANGE}")
    r6 = spark.createDataFrame(
        place_rows([(str(ipaddress.IPv6Address(a)), str(ipaddress.IPv6Address(b))) for a, b in v6]),
        f"ip_from string, ip_to string, {RANGE}",
    )
    found = locate.locate_ips(spark.createDataFrame([(t,) for t in texts], "ip string"), r4, r6)

    def brute(text):
        address = ipaddress.ip_address(text)
        ranges = v4 if address.version == 4 else v6
        return next((f"city {i}" for i, (a, b) in enumerate(ranges) if a <= int(address) <= b), None)

    got = {r["ip"]: r["city_name"] for r in found.collect()}
    assert got == {t: brute(t) for t in texts}
    assert "NestedLoop" not in plan(found) and "Cartesian" not in plan(found)


def test_place_needs_a_country(spark):
    rows = [("a", " - ", "N/A", "DE", "Germany", "1.5", "inf"), ("b", "c", "r", "DEU", "Germany", "1", "2"), ("c", "c", "", "-", "x", "1", "2")]
    df = spark.createDataFrame(rows, f"ip string, {RANGE}")
    cleaned = locate.clean_place({n: F.col(n) for n in locate.PLACE})
    got = [tuple(r) for r in df.select("ip", *[c.alias(n) for n, c in cleaned.items()]).orderBy("ip").collect()]
    assert got == [("a", None, None, "DE", "Germany", 1.5, None), ("b", *[None] * 6), ("c", *[None] * 6)]


def test_ip_statistics(spark):
    raw = spark.createDataFrame([(v,) for v in (" 8.8.8.8 ", "8.8.8.8", "2001:0db8::1", "bad", None)], "ip string")
    row = locate.ip_scan_statistics(raw).first()
    assert (row["mongo_unique"], row["valid_unique"], row["invalid"], row["normalized_duplicates"]) == (5, 2, 2, 1)


def test_missing_range_keeps_the_ip(spark):
    events = spark.createDataFrame([("9.9.9.9",), ("2001:0db8::1",), ("x",)], "ip string")
    ranges = spark.createDataFrame(place_rows([(1, 2)]), f"ip_from long, ip_to long, {RANGE}")
    got = {r["ip"]: r["city_name"] for r in locate.ip_locations(events, ranges).collect()}
    assert got == {"9.9.9.9": None, "2001:db8::1": None}


def test_narrowest_of_nested_and_overlapping_ranges(spark):
    """Random ranges of both kinds of addresses, against a search of all of them."""
    import ipaddress
    import random

    from clickstar.operators import ip_ranges

    rng = random.Random(5)
    for digits, low, size in ((8, int(ipaddress.ip_address("10.0.0.0")), 1 << 20), (32, int(ipaddress.ip_address("2001:db8::")), 1 << 70)):
        ends = [sorted(low + rng.randrange(size) for _ in range(2)) for _ in range(40)]
        ends += [[low, low + size // 2], [low + 5, low + 5], [low + (1 << 16), low + (1 << 17) - 1], [0, 16**digits - 1], [low + 9, low + 3]]
        ends += [[e[0], e[0] + rng.randrange(1 << 18)] for e in ends[:20]]
        text = lambda n: f"{n:0{digits}x}"  # noqa: B023, E731
        rows = [(text(a), text(b), f"r{i}") for i, (a, b) in enumerate(ends)] + [(None, text(5), "none")]
        points = sorted({p for a, b in ends for p in (a, b, max(a - 1, 0), min(b + 1, 16**digits - 1), (a + b) // 2)})
        segments = ip_ranges.flatten(spark.createDataFrame(rows, "low string, high string, name string"), ["name"])
        frame = spark.createDataFrame([(str(p), text(p)) for p in points] + [("none", None)], "ip string, key string")
        got = {r.ip: r.name for r in ip_ranges.narrowest(frame, "key", digits, segments, ["name"]).collect()}
        for p in points:
            covering = [(b - a, -a, i) for i, (a, b) in enumerate(ends) if a <= p <= b]
            best = min(c[:2] for c in covering)
            assert got[str(p)] in {f"r{i}" for w, s, i in covering if (w, s) == best}
        assert got["none"] is None and len(got) == len(points) + 1
        assert segments.count() <= 2 * len(rows) * digits // 4 * 3


def test_records_of_no_use_are_counted(spark):
    fields = "ip_from long, ip_to long, city_name string, region_name string, country_code string, country_name string, latitude string, longitude string"
    ranges = spark.createDataFrame([
        (0, 2**32 - 1, "World", None, "WW", None, None, None), (134744072, 134744072, "x", None, "A1", None, None, None),
        (134744074, 134744075, "x", None, None, None, None, None),
    ], fields)
    events = spark.createDataFrame([("8.8.8.8",), ("8.8.8.9",), ("8.8.8.10",), ("bad",), (" 8.8.8.8 ",)], "ip string")
    located = locate.ip_locations(events, ranges, errors=True)
    assert {(r.ip, r.city_name, r.lookup_error) for r in located.collect()} == {
        ("8.8.8.8", None, True), ("8.8.8.9", "World", False), ("8.8.8.10", None, True)
    }
    stats = locate.location_statistics(locate.distinct_ips(events), located).first()
    assert (stats.written, stats.lookup_errors, stats.invalid, stats.normalized_duplicates) == (3, 2, 1, 1)
