"""URL filter rules by a sort-merge range join.

A rule is (host, path): it fits its host and all subdomains if the url's path
starts with the rule's path. With host labels reversed ("org.example.") every
rule is a prefix, and a prefix is an interval of the sorted keys. Intervals of
prefixes nest or are disjoint, so a sweep over the sorted union of rule starts
and url keys needs only the stack of rules that are open at the last rule
start; the active ones are those whose key is a prefix of the url's.

Two sweeps find all fitting rules: one over distinct hosts gives the stack of
active rule hosts, one over (rule host, path) the stack of active paths below
each of them. The sweep is cut into key ranges; each range starts from the
last stack of the ranges before it. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from salescube.llm.common import ascii_lower, ranged

# The five production rules.
RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]
RULE_SCHEMA = "host string, path string, verdict string"


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + F.lit(3), F.length(url))).otherwise("")


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path); both empty for a null url or one without ``://``.

    The host keeps a port or user name; only A-Z are lower-cased.
    """
    rest = F.coalesce(_after_scheme(url), F.lit(""))
    return (ascii_lower(F.regexp_extract(rest, r"^([^/?#]*)", 1)),
            F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1))


def host_key(host: Column) -> Column:
    """Labels reversed, each closed by a dot: a.example.org -> org.example.a."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), "."), F.lit("."))


def _with_stacks(rules: DataFrame) -> DataFrame:
    """rules(key) distinct -> (key, stack): the rule keys that are prefixes of it, shortest first."""
    cuts = rules.select("key", F.explode(F.transform(
        F.sequence(F.lit(1), F.length("key")), lambda n: F.substring(F.col("key"), F.lit(1), n))).alias("open"))
    nested = cuts.join(rules.select(F.col("key").alias("open")), "open")
    return nested.groupBy("key").agg(F.array_sort(F.collect_set("open")).alias("stack"))


def sweep(rules: DataFrame, points: DataFrame, name: str) -> DataFrame:
    """For each point key, the stack of rule keys that are prefixes of it.

    ``rules`` (key) and ``points`` (key) are distinct non-null strings. Points
    without an active rule are left out. Returns (key, active array<string>).
    """
    marks = (_with_stacks(rules).select("key", F.lit(0).alias("kind"), "stack")
             .union(points.select("key", F.lit(1), F.lit(None).cast("array<string>"))))
    parts = ranged(marks, ["key", "kind"], name)
    in_order = Window.orderBy("key", "kind")
    upto = in_order.partitionBy("_pid").rowsBetween(Window.unboundedPreceding, 0)
    # One row for each range, so this window is bounded by the number of ranges.
    ends = parts.groupBy("_pid").agg(
        F.max(F.when(F.col("kind") == 0, F.struct("key", "stack"))).alias("top"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select("_pid", F.last("top.stack", True).over(before).alias("carried"))
    swept = (parts.withColumn("own", F.last("stack", True).over(upto))
             .where("kind = 1").join(carried, "_pid"))
    open_now = F.coalesce("own", "carried")
    return (swept.select("key", F.filter(open_now, lambda r: F.startswith(F.col("key"), r)).alias("active"))
            .where(F.size("active") > 0))


def match_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """Longest fitting rule of each distinct (host, path).

    ``urls`` (host, path) distinct, ``rules`` (host, path, verdict). Returns
    (host, path, rule, verdict) for the urls that a rule fits. Longest is by the
    characters of host and path together; ties go to the longer host, then to
    the smaller path. Of rules that are given twice with different verdicts,
    block holds. Null parts of a rule count as empty.
    """
    rule = (rules.select(ascii_lower(F.coalesce("host", F.lit(""))).alias("rhost"),
                         F.coalesce("path", F.lit("")).alias("rpath"), "verdict")
            .groupBy("rhost", "rpath").agg(F.max("verdict").alias("verdict"))
            .withColumn("hkey", host_key(F.col("rhost"))))
    hosts = urls.select("host").distinct().withColumn("key", host_key(F.col("host")))
    chains = (sweep(rule.select(F.col("hkey").alias("key")).distinct(), hosts.select("key"), "host-sweep")
              .join(hosts, "key").select("host", F.explode("active").alias("hkey")))
    # Below one rule host, the path continues the key.
    below = (urls.join(chains, "host")
             .select("host", "path", F.concat("hkey", F.lit("/"), "path").alias("key")))
    named = rule.withColumn("rkey", F.concat("hkey", F.lit("/"), "rpath"))
    found = (sweep(named.select(F.col("rkey").alias("key")), below.select("key").distinct(), "path-sweep")
             .select("key", F.explode("active").alias("rkey")))
    best = F.struct((F.length("rhost") + F.length("rpath")).alias("chars"), F.length("rhost").alias("hchars"),
                    F.concat("rhost", "rpath").alias("rule"), "verdict")
    longest = (found.join(named, "rkey").groupBy("key").agg(F.max(best).alias("b")))
    return (below.join(longest, "key").groupBy("host", "path").agg(F.max("b").alias("b"))
            .select("host", "path", "b.rule", "b.verdict"))


def filter_urls(pages: DataFrame, rules: DataFrame, default: str = "allow",
                id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """Judge every row's url: (id, host, path, rule, verdict).

    Urls that no rule fits get a null rule and the method's ``default`` verdict.
    Null, empty and malformed urls have empty host and path. Repeated rows are
    each returned; an empty table gives an empty result; other columns are not
    read.
    """
    host, path = split_url(F.col(url_col))
    rows = pages.select(F.col(id_col).alias("id"), host.alias("host"), path.alias("path"))
    matched = match_rules(rows.select("host", "path").distinct(), rules)
    return (rows.join(matched, ["host", "path"], "left")
            .select(F.col("id").alias(id_col), "host", "path", "rule",
                    F.coalesce("verdict", F.lit(default)).alias("verdict")))


def production_rules(spark) -> DataFrame:
    rows = [F.struct(*[F.lit(x).alias(c) for c, x in zip(("host", "path", "verdict"), rule)]) for rule in RULES]
    return spark.range(1).select(F.inline(F.array(*rows)))
