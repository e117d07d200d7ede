"""URL filters by dated lists: a temporal join of captures with list entries.

A list is a log of dated entries: from its date on a pattern is on the list with a verdict (``block`` or ``allow``), or
off it (``remove``). Consecutive entries of a pattern become validity intervals, closed at the start and open at the end.
A pattern is a host, which holds for its subdomains too, or a host with a path, which holds for paths that begin so.
A capture is judged by the entries that were active when it was fetched: the longest pattern decides.

Entries stay rows. A capture asks for each domain that its host lies in with each beginning of its path that is as long as
some path listed for that domain, so it meets a pattern by equality, and of the pattern's intervals only those of its own
era. What is gathered is the lengths of a domain's listed paths, at most as many as the longest has characters, and the
intervals of one pattern in one era. Hosts, patterns and captures that hold more than a fair share of the rows are dealt
out by the join.

Defined results: a null URL or fetch time, or one without a host, is judged by no entry (null verdict); entries with a
null pattern or date are ignored; of entries of one pattern and moment ``remove`` yields to ``allow`` and that to
``block``; captures are judged one by one, equal ones alike; empty tables give empty or unjudged results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywind.operators.joins import BROADCAST_BYTES, attach
from tallywind.storage import store

ERA = 64 * 86400
FOREVER = (1 << 62) - 1

# Entries of one moment, the later in the list wins.
VERDICTS = ["remove", "allow", "block"]


def host_of(url: Column) -> Column:
    """Host of a URL in lower case, without user, port and a closing dot; null if there is none."""
    host = F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return F.nullif(F.regexp_replace(host, r"\.+$", ""), F.lit(""))


def path_of(url: Column) -> Column:
    """Path of a URL with its query, at least a slash."""
    path = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^#]*)", 1)
    return F.when(path.startswith("/"), path).otherwise(F.concat(F.lit("/"), path))


def suffixes(host: Column) -> Column:
    """The host and the domains it lies in."""
    labels = F.split(host, r"\.")
    n = F.size(labels)
    return F.transform(F.sequence(F.lit(1), n), lambda i: F.array_join(F.slice(labels, i, n), "."))


def intervals(entries: DataFrame, pattern: str = "pattern", verdict: str = "verdict", at: str = "at") -> DataFrame:
    """(pattern, verdict, start, end): when each verdict held. Removals end an interval and open none.

    Entries are put in order per pattern and day, and days per pattern, so that a pattern that changes without rest is
    still dealt over many tasks.
    """
    rank = F.array_position(F.array(*[F.lit(v) for v in VERDICTS]), F.col(verdict))
    rows = entries.where(F.col(pattern).isNotNull() & F.col(at).isNotNull() & (rank > 0))
    moments = rows.groupBy(F.lower(F.trim(pattern)).alias("pattern"), F.col(at).cast("long").alias("start")).agg(F.max_by(verdict, rank).alias("verdict"))
    moments = store(moments.withColumn("day", F.floor(F.col("start") / 86400))).df
    days = moments.groupBy("pattern", "day").agg(F.min("start").alias("first"))
    days = days.withColumn("next_day", F.lead("first").over(Window.partitionBy("pattern").orderBy("day")))
    inside = Window.partitionBy("pattern", "day").orderBy("start")
    held = moments.withColumn("next", F.lead("start").over(inside)).join(days.select("pattern", "day", "next_day"), ["pattern", "day"])
    return held.where("verdict <> 'remove'").select("pattern", "verdict", "start", F.coalesce("next", "next_day", F.lit(FOREVER)).alias("end"))


def _by_era(held: DataFrame, low: int, high: int) -> DataFrame:
    """Intervals with the domain and path of their pattern, once per era they touch between two moments."""
    eras = F.sequence(F.floor(F.greatest("start", F.lit(low)) / ERA), F.floor((F.least("end", F.lit(high + 1)) - 1) / ERA))
    split = F.instr("pattern", "/")
    domain = F.when(split > 0, F.substr(F.col("pattern"), F.lit(1), split - 1)).otherwise(F.col("pattern"))
    path = F.when(split > 0, F.substr(F.col("pattern"), split)).otherwise(F.lit(""))
    inside = held.where((F.col("start") <= high) & (F.col("end") > low))
    return inside.select(domain.alias("domain"), path.alias("path"), "pattern", "verdict", "start", "end", F.explode(eras).alias("era"))


def _decided(asked: DataFrame, active: DataFrame, broadcast_bytes: int) -> DataFrame:
    """(_url, _at, n, best) of the captures that an entry decides."""
    share = {"broadcast_bytes": broadcast_bytes}
    sizes = active.groupBy("domain").agg(F.collect_set(F.length("path")).alias("sizes"))
    domains = asked.groupBy("_host").agg(F.count("*").alias("hosted")).select("_host", "hosted", F.explode(suffixes(F.col("_host"))).alias("domain"))
    listed = attach(store(domains).df, sizes, ["domain"], spread_by=("_host",), **share).where("sizes is not null")
    listed = listed.select("_host", "hosted", "domain", F.explode("sizes").alias("size"))
    reach = listed.groupBy("_host").agg(F.max("hosted").alias("hosted"), F.collect_list(F.struct("domain", "size")).alias("reach"))
    asking = attach(asked, reach, ["_host"], weight="hosted", spread_by=("_url", "_at"), **share)
    asking = asking.select("_url", "_at", "n", "_path", F.col("_era").alias("era"), F.explode("reach").alias("r")).where(F.length("_path") >= F.col("r.size"))
    asking = asking.select("_url", "_at", "n", "era", F.col("r.domain").alias("domain"), F.substr("_path", F.lit(1), F.col("r.size")).alias("path"))
    held = active.groupBy("domain", "path", "era").agg(F.collect_list(F.struct("start", "end", "verdict", "pattern")).alias("held"))
    met = attach(asking, held, ["domain", "path", "era"], spread_by=("_url", "_at"), **share)
    now = F.filter("held", lambda e: (e["start"] <= F.col("_at")) & (F.col("_at") < e["end"]))
    best = F.array_max(F.transform(now, lambda e: F.struct(F.length(e["pattern"]).alias("size"), e["verdict"].alias("verdict"), e["pattern"].alias("pattern"))))
    return met.select("_url", "_at", "n", best.alias("best")).where("best is not null").groupBy("_url", "_at").agg(F.max("n").alias("n"), F.max("best").alias("best"))


def judge(captures: DataFrame, entries: DataFrame, url: str = "url", fetched: str = "fetched_at", broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``captures`` with pattern and verdict of the entry that decides, and blocked. ``fetched`` is in epoch seconds."""
    kept = [c for c in captures.columns if c.lower() not in ("pattern", "verdict", "blocked")]
    low, high = captures.agg(F.min(fetched), F.max(fetched)).first()
    if low is None:
        nothing = F.lit(None).cast("string")
        return captures.select(*kept, nothing.alias("pattern"), nothing.alias("verdict"), F.lit(False).alias("blocked"))
    rows = captures.select(*kept, F.col(url).alias("_url"), F.col(fetched).alias("_at"), F.monotonically_increasing_id().alias("_spread"))
    asked = rows.groupBy("_url", "_at").agg(F.count("*").alias("n"))
    asked = asked.select("*", host_of(F.col("_url")).alias("_host"), path_of(F.lower("_url")).alias("_path"), F.floor(F.col("_at") / ERA).alias("_era"))
    asked = store(asked.where("_host is not null and _era is not null")).df
    active = store(_by_era(intervals(entries), int(low), int(high))).df
    judged = attach(rows, _decided(asked, active, broadcast_bytes), ["_url", "_at"], weight="n", spread_by=("_spread",), broadcast_bytes=broadcast_bytes)
    return judged.select(*kept, F.col("best.pattern").alias("pattern"), F.col("best.verdict").alias("verdict"), F.coalesce(F.col("best.verdict") == "block", F.lit(False)).alias("blocked"))
