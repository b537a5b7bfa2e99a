"""URL filters by temporal list join (native).

Dated list entries (an addition or a removal of a pattern) become intervals in which the pattern is on the list.
Every capture is looked up under each suffix of its host, alone and with each path prefix, and joined with the
intervals as of its fetch time.

A pattern is a host, which covers its subdomains (a top-level domain too), or a host and a path prefix, whole segments.
Schemes, user names, ports, the case of the host and a last dot don't matter. An IP address covers itself only.

Nulls and edge cases: a null or unreadable url, or a null fetch time, is on no list; entries without a list,
pattern, date or a known action are ignored; of several entries for one pattern at one time a removal wins; an
entry counts from its date on, a removal ends it at its date; repeated captures get equal answers; an empty list
table leaves every capture free. Other columns are kept, and those named like the added ones replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import cut

SCHEME = r"[A-Za-z][A-Za-z0-9+.\-]*://"
#: A host behind a user name; what follows it, a port or a path, isn't looked at.
HOST = r"(?:[^/?#@]*@)?(\[[^\]/?#]*\]|[^/?#:@\[]+)"
ADDRESS = r"^\[|^[0-9.]+$"
#: Up to so many intervals (about 100 bytes each) are broadcast; beyond it captures are dealt by pattern.
MAX_BROADCAST = 200_000
#: Copies of each interval in that case, so that a hot host is spread over so many tasks.
SALTS = 64


def host_of(url: Column) -> Column:
    """The host in lower case; empty if there is none."""
    found = F.regexp_extract(url, rf"^\s*{SCHEME}{HOST}", 1)
    return F.coalesce(F.rtrim(F.lower(found), F.lit(".")), F.lit(""))


def path_of(url: Column) -> Column:
    """The path without its first slash."""
    found = F.regexp_extract(url, rf"^\s*{SCHEME}[^/?#]+/([^?#]*)", 1)
    return F.coalesce(found, F.lit(""))


def pattern(text: Column) -> Column:
    """A pattern in the form captures are looked up by: host, or host/path without a last slash."""
    bare = F.regexp_replace(F.trim(text), f"^{SCHEME}", "")
    host = F.rtrim(F.lower(F.regexp_extract(bare, f"^{HOST}", 1)), F.lit("."))
    path = F.regexp_replace(F.regexp_extract(bare, r"^[^/?#]*/([^?#]*)", 1), r"/+$", "")
    return F.when(path == "", host).otherwise(F.concat_ws("/", host, path))


def intervals(entries: DataFrame) -> DataFrame:
    """list, pattern, since, until (null: still on the list) from list, pattern, action and date."""
    dated = (
        entries.select("list", pattern(F.col("pattern")).alias("pattern"), F.lower("action").alias("action"), F.col("date").cast("timestamp").alias("since"))
        .where("list is not null and pattern != '' and since is not null and action in ('add', 'remove')")
        .groupBy("list", "pattern", "since")
        .agg((F.max("action") == "add").alias("on"))  # 'remove' is the greater
    )
    order = W.partitionBy("list", "pattern").orderBy("since")
    turns = dated.withColumn("was", F.coalesce(F.lag("on").over(order), F.lit(False))).where("on != was")
    return turns.withColumn("until", F.lead("since").over(order)).where("on").select("list", "pattern", "since", "until")


def lookups(url: Column, depth: int) -> Column:
    """The patterns that cover a url, with at most so many path segments."""
    host = host_of(url)
    labels = F.when(host.rlike(ADDRESS), F.array(host)).otherwise(F.split(host, r"\."))
    hosts = F.transform(
        F.sequence(F.lit(0), F.size(labels) - 1), lambda i: F.array_join(F.slice(labels, i + 1, F.size(labels)), ".")
    )
    if not depth:
        return hosts
    segments = F.slice(F.split(path_of(url), "/"), 1, depth)
    paths = F.transform(
        F.sequence(F.lit(1), F.size(segments)), lambda n: F.array_join(F.slice(segments, 1, n), "/")
    )
    paths = F.concat(F.array(F.lit("")), F.filter(paths, lambda p: ~p.endswith("/") & (p != "")))
    return F.array_distinct(
        F.flatten(F.transform(hosts, lambda h: F.transform(paths, lambda p: F.when(p == "", h).otherwise(F.concat_ws("/", h, p)))))
    )


def check(captures: DataFrame, entries: DataFrame, url: str = "url", fetched: str = "fetched") -> DataFrame:
    """The captures with lists (those that cover the url at its fetch time, in order) and blocked."""
    added = ("lists", "blocked")
    captures = captures.select(*[c for c in captures.columns if c.lower() not in added])
    spans = cut(intervals(entries))
    size = spans.agg(F.count("*").alias("n"), F.max(F.size(F.split("pattern", "/")) - 1).alias("depth")).first()
    key = captures.select(F.col(url).alias("__url"), F.col(fetched).cast("timestamp").alias("__at")).where("__url is not null and __at is not null").distinct()
    asked = key.withColumn("pattern", F.explode(lookups(F.col("__url"), size.depth or 0)))
    if size.n <= MAX_BROADCAST:
        on, spans = ["pattern"], F.broadcast(spans)
    else:
        on = ["pattern", "__salt"]
        asked = asked.withColumn("__salt", F.pmod(F.xxhash64("__url", "__at"), F.lit(SALTS)).cast("int"))
        spans = spans.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    active = (F.col("__at") >= F.col("since")) & (F.col("until").isNull() | (F.col("__at") < F.col("until")))
    hits = asked.join(spans, on).where(active).groupBy("__url", "__at").agg(F.sort_array(F.collect_set("list")).alias("lists"))
    found = captures.join(hits, (captures[url] == F.col("__url")) & (captures[fetched].cast("timestamp") == F.col("__at")), "left")
    lists = F.coalesce("lists", F.array().cast("array<string>"))
    return found.select(*[captures[c] for c in captures.columns], lists.alias("lists"), (F.size(lists) > 0).alias("blocked"))
