from __future__ import annotations

import random

from llm_fixtures import _importable  # noqa: F401
from pyspark.sql import functions as F

from tallywind.llm import url_lists as U

DAY = 86400


def plain(captures, entries):
    """Every capture against every entry."""
    held = {}
    for pattern, verdict, at in entries:
        if pattern is not None and at is not None:
            moments = held.setdefault(pattern.strip().lower(), {})
            moments[at] = max(moments.get(at, verdict), verdict, key=U.VERDICTS.index)
    out = []
    for url, t in captures:
        best = None
        if url and t is not None and "://" in url:
            host, _, rest = url.lower().split("://")[1].partition("/")
            path = "/" + rest.split("#")[0]
            for pattern, moments in held.items():
                domain, slash, folder = pattern.partition("/")
                past = [at for at in moments if at <= t]
                if past and moments[max(past)] != "remove" and (host == domain or host.endswith("." + domain)) and path.startswith(slash + folder):
                    best = max(best or (0, "", ""), (len(pattern), moments[max(past)], pattern))
        out.append(best and (best[2], best[1]))
    return out


def made(seed):
    rng = random.Random(seed)
    hosts = ["a.example.com", "b.a.example.com", "example.com", "x.test.org", "hot.example.net", "localhost"]
    patterns = [*hosts, "a.example.com/en/", "example.com/p", " X.Test.org ", "com", None]
    entries = [(rng.choice(patterns), rng.choice(U.VERDICTS), rng.choice([None, *range(0, 400 * DAY, 7919)])) for _ in range(400)]
    captures = [(f"https://{rng.choice(hosts + ['hot.example.net'] * 20)}/{rng.choice(['en/', 'p', 'de/q?x=1', ''])}{rng.choice(['', '#top'])}", rng.randrange(400 * DAY)) for _ in range(500)]
    return captures + [(None, 5), ("no url", 5), ("https://a.example.com/", None), ("http:///x", 9)] + captures[:5], entries


def test_as_of_every_fetch(spark):
    for seed, most in ((1, U.BROADCAST_BYTES), (2, U.BROADCAST_BYTES), (3, 0)):
        captures, entries = made(seed)
        rows = spark.createDataFrame([(i, *c, "old") for i, c in enumerate(captures)], "id int, url string, fetched_at long, verdict string").repartition(4)
        log = spark.createDataFrame(entries, "pattern string, verdict string, at long").repartition(4)
        got = {r["id"]: r for r in U.judge(rows, log, broadcast_bytes=most).collect()}
        want = plain(captures, entries)
        assert len(got) == len(captures)
        for i, best in enumerate(want):
            assert (got[i]["pattern"], got[i]["verdict"]) == (best or (None, None)), captures[i]
            assert got[i]["blocked"] == (best is not None and best[1] == "block")


def test_intervals_close_at_the_next_entry(spark):
    log = spark.createDataFrame([("h", "block", 10), ("h", "allow", 20), ("h", "remove", 3 * DAY), ("h", "block", 9 * DAY), ("h", "remove", 10), ("g", "bogus", 1)], "pattern string, verdict string, at long")
    rows = [(r["verdict"], r["start"], r["end"]) for r in U.intervals(log).orderBy("start").collect()]
    assert rows == [("block", 10, 20), ("allow", 20, 3 * DAY), ("block", 9 * DAY, U.FOREVER)]


def test_empty_tables(spark):
    log = spark.createDataFrame([("h", "block", 10)], "pattern string, verdict string, at long")
    captures = spark.createDataFrame([("https://h/", 20)], "url string, fetched_at long")
    assert U.judge(captures.limit(0), log).count() == 0
    assert [r["blocked"] for r in U.judge(captures, log.limit(0)).collect()] == [False]
    assert [r["blocked"] for r in U.judge(captures, log).collect()] == [True]
    assert captures.select(U.host_of(F.lit("HTTP://u:p@Host.Example.:80/x"))).first()[0] == "host.example"
