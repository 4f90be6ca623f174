"""URL rules by sort-merge range joins over reversed hosts and paths.

A host is turned into a key that starts with its last label ("www.example.com" gives "com/example/www/"), so the host of a rule with all its subdomains
is one interval of keys; so are the paths that start with a rule's. Intervals of prefixes nest or do not touch. A sweep over the sorted keys of
starts and points meets each point behind the start of the intervals that hold it: these are all on the stack as it was when the last
start in front of the point was pushed, and those of the stack that have ended are told by their prefix.

Two sweeps: hosts among the hosts of rules, then (host of a rule, path) among the rules. A stack holds what is nested, not all rules of a host,
and a point is compared with one stack. Only distinct hosts and paths are swept, so a url of very many rows is one point; ranges of keys
are swept apart from each other, each with the last start of the ranges in front of it carried in.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rideflow.llm.positions import with_position
from rideflow.sources.workdir import materialize, work_dir

SPAN = 100_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _behind(url: Column) -> Column:
    """What follows the first "://"; empty for null or without it."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))


def url_host(url: Column) -> Column:
    """What follows the first "://" up to "/", "?", "#" or the end, A-Z as a-z; empty for null or without "://"."""
    host = _behind(url)
    for mark in "/?#":
        host = F.substring_index(host, mark, 1)
    return F.translate(host, UPPER, LOWER)


def url_path(url: Column) -> Column:
    """What follows the host up to "?", "#" or the end; empty for null or without "://"."""
    path = F.substr(_behind(url), F.length(url_host(url)) + 1)
    return F.substring_index(F.substring_index(path, "?", 1), "#", 1)


def host_key(host: Column) -> Column:
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "/"), F.lit("/"))


def _nearest(points: DataFrame, starts: DataFrame) -> DataFrame:
    """key, near: for each key of `points` the last key of `starts` that does not sort behind it, by the sweep. Keys are distinct in each."""
    both = points.select("key", F.lit(1).alias("kind")).unionByName(starts.select("key", F.lit(0).alias("kind")))
    # starts sort in front of the points with the same key
    swept = with_position(both, [F.col("key"), F.col("kind")])
    span = F.floor(F.col("position") / SPAN).alias("span")
    start = F.when(F.col("kind") == 0, F.col("key"))
    swept = swept.withColumn("span", span).withColumn("start", start)
    upto = Window.partitionBy("span").orderBy("position").rowsBetween(Window.unboundedPreceding, 0)
    # keys ascend, so the last start of a span is its largest, and of all spans in front the largest of theirs; one row a span
    ends = swept.groupBy("span").agg(F.max("start").alias("last"))
    before = Window.orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select("span", F.max("last").over(before).alias("carried"))
    return (swept.withColumn("near", F.last("start", ignorenulls=True).over(upto)).where("kind = 1").join(carried, "span")
            .select("key", F.coalesce("near", "carried").alias("near")))


def _stacks(rules: DataFrame, prefixes: Column, *carry: str) -> DataFrame:
    """key, stack: for each distinct key of `rules` what has a key among its `prefixes`, which are as many as it has labels or characters. They are
    found by an equality join, which spreads over the cluster for rule lists of any length."""
    leading = rules.select("key").distinct().select("key", F.explode(prefixes).alias("_held"))
    held = leading.join(rules.select(F.col("key").alias("_held"), *carry).distinct(), "_held")
    return held.groupBy("key").agg(F.collect_list(F.struct(F.col("_held").alias("held"), *carry)).alias("stack"))


def _met(points: DataFrame, stacks: DataFrame) -> DataFrame:
    """key, stack: the part of the nearest start's stack that holds the point; points that nothing holds are left out."""
    met = _nearest(points, stacks).join(stacks.select(F.col("key").alias("near"), "stack"), "near")
    return met.select("key", F.filter("stack", lambda r: F.startswith(F.col("key"), r.held)).alias("stack")).where(F.size("stack") > 0)


def apply_url_rules(urls: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = "allow") -> DataFrame:
    """page_id, host, path, rule, verdict of every row of `urls`.

    A rule (host, path, verdict) fits a url whose host is the rule's or a subdomain of it and whose path starts with the rule's. The longest
    of the fitting rules (host and path together; a longer host, then "block" decides between equal ones) gives rule and verdict. No
    rule: null and `default`. Null urls and urls without "://" have an empty host and path, and no rule. Repeated rules
    count once, rules with a null or an empty host, or a host that no url can have, never fit. An empty table of rules gives `default` everywhere.
    Other columns of `urls` are ignored.
    """
    spark = urls.sparkSession
    rows = urls.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"))
    rows = rows.select("page_id", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    rows = materialize(rows, work_dir(spark))
    known = (rules.where("path IS NOT NULL AND host <> '' AND NOT host RLIKE '[/?#]'").select("host", "path", "verdict").distinct()
             .withColumn("holder", host_key(F.translate("host", UPPER, LOWER))))
    known = materialize(known.withColumn("key", F.concat("holder", F.lit("?"), "path")), work_dir(spark))

    # hosts: the rules' hosts around each host
    labels = F.split("key", "/")
    around = F.transform(F.sequence(F.lit(1), F.size(labels) - 1), lambda i: F.concat(F.array_join(F.slice(labels, 1, i), "/"), F.lit("/")))
    holders = materialize(_stacks(known.select(F.col("holder").alias("key")), around), work_dir(spark))
    hosts = rows.where("host <> ''").select(host_key(F.col("host")).alias("key")).distinct()
    held = materialize(_met(hosts, holders).select(F.col("key").alias("host_key"), F.explode("stack.held").alias("holder")), work_dir(spark))

    # paths: the rules of each of these hosts whose path begins the url's; "?" stands in no host and no path of a url
    places = materialize(rows.where("host <> ''").select("host", "path").distinct().withColumn("host_key", host_key(F.col("host")))
                         .join(held, "host_key").select("host", "path", F.concat("holder", F.lit("?"), "path").alias("key")), work_dir(spark))
    begins = F.transform(F.sequence(F.instr("key", "?"), F.length("key")), lambda i: F.substr(F.col("key"), F.lit(1), i))
    stacks = materialize(_stacks(known, begins, "holder", "host", "path", "verdict"), work_dir(spark))
    fits = _met(places.select("key").distinct(), stacks)
    best = F.array_max(F.transform("stack", lambda r: F.struct(
        F.length(F.concat(r.host, r.path)).alias("long"), F.length(r.holder).alias("deep"), (r.verdict == "block").alias("hard"),
        F.concat(r.host, r.path).alias("rule"), r.verdict.alias("verdict"))))
    chosen = places.join(fits.select("key", best.alias("best")), "key").groupBy("host", "path").agg(F.max("best").alias("best"))
    found = rows.join(materialize(chosen, work_dir(spark)), ["host", "path"], "left")
    return found.select("page_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict"))
