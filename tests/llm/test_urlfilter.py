import datetime as dt
import random

import pytest

from gridpulse.llm import urlfilter

ENTRIES = "list string, pattern string, action string, date timestamp"
CAPTURES = "page_id long, url string, fetched timestamp"
DAY = dt.datetime(2024, 1, 1)


def at(d):
    return DAY + dt.timedelta(days=d)


def lists(spark, captures, entries):
    got = urlfilter.check(spark.createDataFrame(captures, CAPTURES), spark.createDataFrame(entries, ENTRIES)).collect()
    return {r.page_id: list(r.lists) for r in got}


def test_as_of_the_fetch_time(spark):
    entries = [("x", "bad.example.com", "add", at(5)), ("x", "bad.example.com", "remove", at(9)), ("y", "Example.COM.", "add", at(7)), ("p", "https://a.org/dir/", "add", at(0))]
    captures = [
        (1, "http://bad.example.com/", at(4)), (2, "https://www.BAD.example.com:80/q?x#y", at(5)), (3, "http://u@bad.example.com", at(9)), (4, "http://notbad.example.com", at(6)),
        (5, "http://a.org/dir/x/y.html", at(1)), (6, "http://a.org/directory", at(1)), (7, "http://sub.a.org/dir", at(1)), (8, None, at(8)), (9, "http://bad.example.com/", None), (10, "no url", at(8)),
    ]
    got = lists(spark, captures, entries)
    assert got == {1: [], 2: ["x"], 3: ["y"], 4: [], 5: ["p"], 6: [], 7: ["p"], 8: [], 9: [], 10: []}


def test_ties_repeats_and_bad_entries(spark):
    entries = [("x", "a.b", "add", at(1)), ("x", "a.b", "add", at(1)), ("x", "a.b", "add", at(2)), ("x", "a.b", "remove", at(3)), ("x", "a.b", "add", at(3)), (None, "a.b", "add", at(0)), ("z", "a.b", "odd", at(0)), ("z", None, "add", at(0)), ("z", "a.b", "add", None), ("w", "a.b", "REMOVE", at(0))]
    got = lists(spark, [(1, "http://a.b/", at(2)), (2, "http://a.b/", at(3)), (3, "http://a.b/", at(0)), (3, "http://a.b/", at(0))], entries)
    assert got == {1: ["x"], 2: [], 3: []}
    assert urlfilter.intervals(spark.createDataFrame(entries, ENTRIES)).count() == 1


def test_empty_tables_and_clashing_columns(spark):
    c = spark.createDataFrame([(1, "http://a.b/", at(1), "x", 3)], CAPTURES + ", blocked string, pattern int")
    none = spark.createDataFrame([], ENTRIES)
    got = urlfilter.check(c, none)
    assert got.columns == ["page_id", "url", "fetched", "pattern", "lists", "blocked"] and not got.first().blocked
    assert urlfilter.check(c.limit(0), none).count() == 0


@pytest.mark.parametrize("most", [urlfilter.MAX_BROADCAST, 0])
def test_random_cases_by_brute_force(spark, monkeypatch, most):
    monkeypatch.setattr(urlfilter, "MAX_BROADCAST", most)
    rnd = random.Random(3)
    hosts = ["a.x.com", "b.x.com", "x.com", "y.org", "c.d.y.org", "org", "1.2.3.4"]
    entries = [(rnd.choice("lm"), rnd.choice(hosts) + rnd.choice(["", "/p", "/p/q"]), rnd.choice(["add", "remove"]), at(rnd.randrange(30))) for _ in range(40)]
    captures = [(i, f"http://{rnd.choice(hosts)}{rnd.choice(['', '/p', '/p/q/r', '/z'])}", at(rnd.randrange(32))) for i in range(80)]

    def on(name, pattern, t):
        past = sorted((d, a) for n, p, a, d in entries if n == name and p == pattern and d <= t)
        return bool(past) and past[-1][1] == "add"

    def want(url, t):
        host, _, path = url[7:].partition("/")
        parts, segs = [host] if host == "1.2.3.4" else host.split("."), path.split("/") if path else []
        keys = [".".join(parts[i:]) + "".join("/" + s for s in segs[:k]) for i in range(len(parts)) for k in range(len(segs) + 1)]
        return sorted({n for n in "lm" for k in keys if on(n, k, t)})

    assert lists(spark, captures, entries) == {i: want(u, t) for i, u, t in captures}


def test_ports_top_level_hosts_and_addresses(spark):
    entries = [("port", "b.example.xyz:80/p/", "add", at(0)), ("user", "http://u:pw@C.example.xyz:8080", "add", at(0)), ("tld", "xyz", "add", at(0)), ("ip", "10.0.0.1", "add", at(0)), ("part", "0.1", "add", at(0)), ("v6", "[::1]:80/x", "add", at(0))]
    captures = [(1, "http://b.example.xyz/p/q", at(1)), (2, "http://c.example.xyz/", at(1)), (3, "http://10.0.0.1:99/", at(1)), (4, "http://[::1]/x/y", at(1)), (5, "http://b.example.com/p", at(1))]
    assert lists(spark, captures, entries) == {1: ["port", "tld"], 2: ["tld", "user"], 3: ["ip"], 4: ["v6"], 5: []}


def test_a_hot_host_with_many_patterns(spark, monkeypatch):
    monkeypatch.setattr(urlfilter, "MAX_BROADCAST", 10)
    entries = [("x", f"hot.org/{k}", "add", at(k % 5)) for k in range(50)]
    captures = [(i, f"http://www.hot.org:80/{i % 60}/x", at(i % 7)) for i in range(600)]
    assert lists(spark, captures, entries) == {i: ["x"] if i % 60 < 50 and i % 60 % 5 <= i % 7 else [] for i in range(600)}
