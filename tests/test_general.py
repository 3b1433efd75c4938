"""History, snapshots, timestamps and intervals against plain Python."""

import random
from collections import defaultdict
from datetime import datetime, timedelta, timezone
from zoneinfo import ZoneInfo

import pandas as pd
import pytest

from palimpsest.functions import timestamps as T
from palimpsest.functions.numerals import chinese_number
from palimpsest.functions.zones import zone
from palimpsest.operators.history import store_history, version_history, version_paths
from palimpsest.operators.intervals import merge_intervals
from palimpsest.operators.links import follow_links
from palimpsest.operators.snapshots import consecutive_editions, snapshot_changes
from palimpsest.operators.timestamps import iso_seconds, utc_start
from pyspark.sql import functions as F


def read(texts, zones=None, precisions=None):
    series = lambda x: pd.Series(x, dtype=object) if x is not None else None
    return T.iso_utc(T.utc_seconds(series(texts), series(zones), series(precisions))).tolist()


@pytest.mark.parametrize(
    ("text", "clock_zone", "precision", "expected"),
    [
        ("105/9/29 21:27", None, None, "2016-09-29T13:27:00Z"),
        ("99/2 /1", None, None, "2010-01-31T16:00:00Z"),
        ("113／7／2", None, None, "2024-07-01T16:00:00Z"),
        ("（100/9/10）", None, None, "2011-09-09T16:00:00Z"),
        ("通則(105.01.19更新)", None, None, "2016-01-18T16:00:00Z"),
        ("105年11月6日 上午12時26分", None, None, "2016-11-05T16:26:00Z"),
        ("105年11月6日 下午02時26分", None, None, "2016-11-06T06:26:00Z"),
        ("中華民國一百零七年十月", None, None, "2018-09-30T16:00:00Z"),
        ("中華民國一百零二年版", None, None, "2012-12-31T16:00:00Z"),
        ("November 20, 2006", None, None, "2006-11-19T16:00:00Z"),
        ("Mar 11, 2010 12:01 PM", None, None, "2010-03-11T04:01:00Z"),
        ("13-MAY-2007", None, None, "2007-05-12T16:00:00Z"),
        ("Wed, 20 Aug 2008 12:34:33 GMT", "Asia/Tokyo", None, "2008-08-20T12:34:33Z"),
        ("2010-06-13 05:03:28 EDT", None, None, "2010-06-13T09:03:28Z"),
        ("2010-06-13 05:03:28 CST", None, None, "2010-06-12T21:03:28Z"),
        ("2008-08-02 21:24:37 UTC+8", None, None, "2008-08-02T13:24:37Z"),
        ("2014-09-03T10:21:39-03:30", None, None, "2014-09-03T13:51:39Z"),
        ("2015-06-01T09:17:55.728936Z", None, None, "2015-06-01T09:17:55Z"),
        ("2010-05-28T07:49:41[America/New_York]", None, None, "2010-05-28T11:49:41Z"),
        ("31.08.2011 06:32:51 Asia/Tokyo", None, None, "2011-08-30T21:32:51Z"),
        ("20030307143637", None, None, "2003-03-07T06:36:37Z"),
        ("1464974711320", None, None, "2016-06-03T17:25:11Z"),
        ("1190690712", "Europe/Zurich", None, "2007-09-25T03:25:12Z"),
        ("109", None, "year", "2019-12-31T16:00:00Z"),
        ("2017", None, "year", "2016-12-31T16:00:00Z"),
        ("202007", None, "month", "2020-06-30T16:00:00Z"),
        ("920128", None, "day", "2003-01-27T16:00:00Z"),
        ("09902", None, "month", "2010-01-31T16:00:00Z"),
        # Skipped and repeated clock readings.
        ("2011/3/13 2:38", "America/Chicago", None, "2011-03-13T08:38:00Z"),
        ("2010-11-07 01:30:00", "America/New_York", None, "2010-11-07T05:30:00Z"),
        ("2010-11-07 01:30:00 EST", "Asia/Tokyo", None, "2010-11-07T06:30:00Z"),
        # No real date, no clock, nothing at all.
        ("108/2/30", None, None, None),
        ("2012-02-31T08:00:00Z", None, None, None),
        ("97/00/01", None, None, None),
        ("2012-02-03T25:00:00Z", None, None, None),
        ("未定", None, None, None),
        ("-", None, None, None),
        ("N/A", None, None, None),
        ("", None, None, None),
        (None, None, None, None),
        ("1" * 100, None, None, None),
        ("2010-01-01 10:00:00 XYZ", None, None, None),
        ("2010-01-01 10:00:00", "No/Where", None, "2010-01-01T02:00:00Z"),
    ],
)
def test_timestamp_notations(text, clock_zone, precision, expected):
    assert read([text], [clock_zone], [precision]) == [expected]


def test_zone_tables_agree_with_the_rules():
    rng = random.Random(1)
    for name in ("America/New_York", "Europe/London", "Asia/Taipei", "Australia/Lord_Howe"):
        table, tz = zone(name), ZoneInfo(name)
        for _ in range(300):
            local = datetime(1930, 1, 1) + timedelta(seconds=rng.randrange(150 * 365 * 86400))
            seconds = int(local.replace(tzinfo=timezone.utc).timestamp())
            # fold 0: the first of two readings; a skipped one keeps the old offset.
            want = int(local.replace(tzinfo=tz, fold=0).timestamp())
            assert table.to_utc(pd.Series([seconds]).to_numpy())[0] == want


def test_chinese_numbers():
    assert [chinese_number(x) for x in ("十", "二十三", "一百零七", "二〇一五", "3百", "廿一", "x", "")] == [10, 23, 107, 2015, 300, 21, None, None]


def test_utc_start_column(spark):
    rows = spark.createDataFrame([(1, "105/9/29 21:27", None), (2, None, "UTC"), (3, "2010-01-01", "UTC")], "i int, v string, z string")
    got = {r.i: r.u for r in rows.select("i", utc_start(F.col("v"), F.col("z")).alias("u")).collect()}
    assert got == {1: "2016-09-29T13:27:00Z", 2: None, 3: "2010-01-01T00:00:00Z"}
    one = spark.range(1).select(iso_seconds(F.lit(-1).cast("long")).alias("x")).first().x
    assert one == "1969-12-31T23:59:59Z"


def test_links_follow_chains_cycles_and_missing_parents(spark):
    rows = [(f"n{i:03}", f"n{i - 1:03}" if i else None) for i in range(70)]
    rows += [("a", "b"), ("b", "a"), ("t", "a"), ("o", "nowhere"), (None, "a"), ("n005", "n004")]
    got = {r.node: (r.root, r.depth) for r in follow_links(spark.createDataFrame(rows, "id string, up string"), "id", "up").collect()}
    assert all(got[f"n{i:03}"] == ("n000", i) for i in range(70))
    assert got["a"] == got["b"] == got["t"] == ("a", None)
    assert got["o"] == ("o", 0) and None not in got


def test_links_of_an_empty_table(spark):
    assert follow_links(spark.createDataFrame([], "id string, up string"), "id", "up").collect() == []


def test_version_history(spark):
    versions = [("v1", "2001-01-01", "w", 1), ("v1", "2000-05-05", "w", 2), ("v2", None, "w", 3), ("v4", "2003-03-03", "w", 4), (None, "2009-09-09", "w", 5), ("x", "2010-10-10", "u", 6)]
    edges = [("v1", "v2"), ("v2", "v3"), ("v3", "v4"), ("v1", "v2"), (None, "v1"), ("v4", None)]
    df = spark.createDataFrame(versions, "source_version_id string, effective_from string, w string, position int")
    ed = spark.createDataFrame(edges, "o string, n string")
    kw = dict(version="source_version_id", valid_from="effective_from", older="o", newer="n", attributes=["w"])
    got = {r.version: (r.valid_from, r.valid_to, r.w) for r in version_history(df, ed, **kw).collect()}
    assert got == {"v1": ("2000-05-05", "2003-03-03", "w"), "v4": ("2003-03-03", None, "w"), "x": ("2010-10-10", None, "u")}
    assert version_history(df.limit(0), ed.limit(0), **kw).collect() == []


def test_versions_that_merge_or_run_in_circles(spark):
    dates = {"a": "01", "b": "02", "d": "04", "e": "05", "x": "07", "y": "08", "g": "09"}
    df = spark.createDataFrame([(v, dates.get(v)) for v in "abcdefghxyz"], "v string, f string")
    # a and b become c, d; e becomes f, which joins b's line at c; g ends in h; x, y, z go round.
    edges = spark.createDataFrame([("a", "c"), ("b", "c"), ("c", "d"), ("e", "f"), ("f", "b"), ("g", "h"), ("x", "y"), ("y", "z"), ("z", "x")], "o string, n string")
    got = {r.version: (r.valid_from, r.valid_to) for r in version_history(df, edges, version="v", valid_from="f", older="o", newer="n").collect()}
    assert got == {"a": ("01", "04"), "b": ("02", "04"), "d": ("04", None), "e": ("05", "02"), "g": ("09", None), "x": ("07", "08"), "y": ("08", None)}
    far = spark.createDataFrame([("a", "c"), ("b", "c"), ("c", "k"), ("j", "k"), ("k", "m"), ("l", "m")], "o string, n string")
    df = spark.createDataFrame([("b", "1"), ("l", "2"), ("m", "3"), ("j", "4")], "v string, f string")
    got = {r.version: r.valid_to for r in version_history(df, far, version="v", valid_from="f", older="o", newer="n").collect()}
    assert got == {"b": "3", "j": "3", "l": "3", "m": None}


def test_versions_with_several_successors(spark):
    """Every period ends with the earliest date that any chain of edges leads to."""
    rng = random.Random(31)
    for _ in range(3):
        n = 40
        dates = {f"v{i:02}": f"20{rng.randrange(10, 30)}-01-{i % 28 + 1:02}" if rng.random() < 0.6 else None for i in range(n)}
        links = {(f"v{i:02}", f"v{min(n - 1, i + rng.randrange(1, 9)):02}") for i in range(n - 1) for _ in range(rng.choice([1, 1, 1, 2]))}

        def after(v, seen=()):
            found = [dates[b] or after(b) for a, b in links if a == v and a != b]
            return min([d for d in found if d], default=None)

        versions = spark.createDataFrame([(v, d) for v, d in dates.items()], "v string, d string")
        edges = spark.createDataFrame(sorted(links), "o string, n string")
        got = {r.version: r.valid_to for r in version_history(versions, edges, version="v", valid_from="d", older="o", newer="n").collect()}
        assert got == {v: after(v) for v, d in dates.items() if d}


def test_attributes_are_of_one_row(spark):
    rows = [("a", "2020-01-01", 2, "x", "9"), ("a", "2019-01-01", 1, "y", "1"), ("b", "2021-01-01", 1, None, "1"), ("b", "2022-01-01", 2, "z", "2")]
    versions = spark.createDataFrame(rows, "v string, d string, n int, p string, q string")
    edges = spark.createDataFrame([("a", "b")], "o string, n string")
    got = version_history(versions, edges, version="v", valid_from="d", older="o", newer="n", attributes=["p", "q"], observed=["n"])
    assert sorted(tuple(r) for r in got.select("version", "valid_from", "valid_to", "p", "q").collect()) == [("a", "2019-01-01", "2021-01-01", "y", "1"), ("b", "2021-01-01", None, None, "1")]


def test_long_history_is_split_into_checkpoints(spark):
    n = 100
    versions = spark.createDataFrame([(f"v{i:03}", f"2{i:03}-01-01" if i % 7 else None, "same") for i in range(n)], "v string, f string, a string")
    edges = spark.createDataFrame([(f"v{i:03}", f"v{i + 1:03}") for i in range(n - 1)], "o string, n string")
    placed = version_paths(versions, edges, "v", "o", "n")
    store = store_history(versions, placed, "v", ["f", "a"]).collect()
    assert sum(r.full for r in store) == 7
    assert all([x["name"] for x in r.attrs] != ["f", "a"] for r in store if not r.full)
    got = {r.version: (r.valid_from, r.valid_to) for r in version_history(versions, edges, version="v", valid_from="f", older="o", newer="n").collect()}
    dated = [i for i in range(n) if i % 7]
    assert got == {f"v{i:03}": (f"2{i:03}-01-01", f"2{j:03}-01-01" if j else None) for i, j in zip(dated, [*dated[1:], None])}


def test_snapshot_changes(spark):
    editions = spark.createDataFrame([("r", "e1", 5), ("r", "e2", 9), ("r", "e2", 9), ("r", "e3", 12), ("q", "f1", 0), (None, "z", 1)], "run string, ed string, o int")
    docs = spark.createDataFrame(
        [("e1", "a", "x"), ("e1", "b", None), ("e1", "c", "y"), ("e2", "a", "x"), ("e2", "a", "x"), ("e2", "b", ""), ("e2", "d", "n"), ("e3", "a", "X"), ("f1", "a", "x"), ("e3", None, "x")],
        "ed string, k string, t string",
    ).withColumn("series", F.lit("clash"))
    pairs = consecutive_editions(editions, "run", "ed", "o")
    got = {(r.newer, r.key, r.change_kind) for r in snapshot_changes(docs, pairs, "ed", "k", ["t"]).collect()}
    assert got == {("e2", "b", "changed"), ("e2", "c", "removed"), ("e2", "d", "added"), ("e3", "a", "changed"), ("e3", "b", "removed"), ("e3", "d", "removed")}
    assert snapshot_changes(docs.limit(0), pairs, "ed", "k", ["t"]).collect() == []


def merged(rows):
    """Plain interval merging; a null end is open."""
    by = defaultdict(list)
    for e, s, t in rows:
        if e is not None and s is not None and (t is None or t > s):
            by[e].append((s, float("inf") if t is None else t))
    out = set()
    for e, own in by.items():
        own.sort()
        periods = []
        for s, t in own:
            if periods and s <= periods[-1][1]:
                periods[-1][1] = max(periods[-1][1], t)
            else:
                periods.append([s, t])
        end = lambda x: None if x == float("inf") else x
        out |= {(e, "period", s, end(t)) for s, t in periods}
        out |= {(e, "gap", a[1], b[0]) for a, b in zip(periods, periods[1:])}
    return out


def test_intervals_against_brute_force(spark):
    rng = random.Random(3)
    rows = [("hot", rng.randrange(4000), None) for _ in range(1)]
    for _ in range(1500):
        s = rng.randrange(3000)
        rows.append((rng.choice(["hot", "hot", "a", "b", None]), s if rng.random() > 0.02 else None, s + rng.randrange(-2, 5) if rng.random() > 0.001 else None))
    rows += [("t", 0, 5), ("t", 5, 9), ("t", 5, 9), ("t", 20, 21), ("n", 0, 100), ("n", 10, 20)]
    df = spark.createDataFrame(rows, "kind string, s long, t long")
    got = [tuple(r) for r in merge_intervals(df, "kind", "s", "t", bucket_width=100).collect()]
    assert len(got) == len(set(got)) and set(got) == merged(rows)
    assert merge_intervals(df.limit(0), "kind", "s", "t").collect() == []


def test_timestamps_in_long_values(spark):
    day = "2024-06-30T16:00:00Z"
    texts = [
        " " * 70 + "113/7/1" + "\u3000" * 70, "\n" * 200 + "2024-07-01" + " " * 5000, "（" + "給付規定修正" * 30 + "）113/7/1", "113年7月1日" + "版本" * 40, "規定" * 100_000 + "2024/07/01" + "，" * 100_000,
        "0" * 70 + "113/7/1", "1" + "0" * 64 + "113/7/1", "1" + " " * 100_000 + "1", "規" * 100, " " * 100, "113/7/1", None,
    ]
    want = [day] * 6 + [None] * 4 + [day, None]
    assert read(texts) == want
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    assert [r.u for r in df.select("i", utc_start(F.col("t")).alias("u")).orderBy("i").collect()] == want
