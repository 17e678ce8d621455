"""URL filters: a sort-merge range join of URLs with rules, with DataFrame functions alone.

A rule names a host, which stands for its subdomains too, and a beginning of the path. Written label
by label from the end, each with a dot behind it, the hosts under a host are the keys that begin
with its key: an interval from the key itself to the key followed by byte FF, which no UTF-8 text
holds. Such intervals nest or are apart. A sweep sorts the ends of the intervals and the keys asked
for; the running sum of +1 and -1 is the depth of the stack, the last interval opened at each depth up
to it is the stack.

Two sweeps answer all URLs. The first finds the rule hosts that are active for each distinct host. The
second takes, for each distinct pair of rule host and path, the key of that host followed by the path,
against the rules' own; its innermost interval is the longest rule there. Most hosts have no active rule
host, and their URLs go no further than the first. The sorted table is dealt into ranges, and what is
open at a border is handed on as one row a range, so neither sweep has a task that sees more than
its range. Hosts and paths are distinct before they are sorted; a hot host or URL only meets joins, which
adaptive execution splits.

Defined results. A URL that is null or has no `://` has an empty host and path, which no rule fits. The
host is all that stands before `/`, `?` or `#`, port and user included, so such hosts fit rules by their
ending alone. The longest rule is the one whose host and path together have the most characters, and
with equals the one with the longer host. Of rules with the same host and path the verdict that is later
in the alphabet (block) holds. Rules without a host, or with a null path, fit nothing. Repeated
rows are judged alike. An empty table gives no rows, no rules leave the default verdict.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeflow.llm.common import quoted, written
from tradeflow.plans.running import in_ranges, running

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ALLOW, BLOCK = "allow", "block"
# What follows every key that begins with another, and what parts a host from its path.
LAST, BETWEEN = b"\xff", b"\x00"
CLOSE, OPEN, ASK = 0, 1, 2


def lowered(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def host_and_path(url: Column) -> list[Column]:
    """host, path of a URL; both empty if it is null or has no `://`."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    return [
        F.coalesce(lowered(F.regexp_extract(rest, "^[^/?#]*", 0)), F.lit("")).alias("host"),
        F.coalesce(F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1), F.lit("")).alias("path"),
    ]


def host_key(host: Column) -> Column:
    """Key of a host: the keys of its subdomains, and no others, begin with it."""
    labels = F.reverse(F.split(host, r"\."))
    return F.encode(F.concat(F.array_join(labels, "."), F.lit(".")), "UTF-8")


def path_key(host: Column, path: Column) -> Column:
    return F.concat(host, F.lit(BETWEEN), F.encode(path, "UTF-8"))


def swept(prefixes: DataFrame, asked: DataFrame) -> DataFrame:
    """key, stack: for each key asked the prefixes that it begins with, shortest first; none, no row.

    Both tables have one column, key, with distinct bytes.
    """
    order = ["at", "kind"]
    marks = prefixes.select(
        F.explode(
            F.array(
                F.struct(F.col("key").alias("at"), F.lit(OPEN).alias("kind"), F.lit(1).alias("step")),
                F.struct(F.concat("key", F.lit(LAST)).alias("at"), F.lit(CLOSE).alias("kind"), F.lit(-1).alias("step")),
            )
        ).alias("mark")
    ).select("mark.*")
    keys = asked.select(F.col("key").alias("at"), F.lit(ASK).alias("kind"), F.lit(0).alias("step"))
    ranges = in_ranges(marks.unionByName(keys), order, "url-marks")
    deep = written(running(ranges, [], order, {"depth": ("sum", F.col("step"))}), "url-depths")
    deepest = deep.agg(F.max("depth")).first()[0] or 0  # bounded by the labels, or the nesting, of the rules
    if deepest == 0:
        return asked.select("key", F.array("key").alias("stack")).filter("false")
    opened = {
        f"open{d}": ("max", F.when((F.col("kind") == OPEN) & (F.col("depth") == d), F.col("at")))
        for d in range(1, deepest + 1)
    }
    levels = running(deep, [], order, opened).filter((F.col("kind") == ASK) & (F.col("depth") > 0))
    stack = F.slice(F.array(*opened), F.lit(1), F.col("depth").cast("int"))
    return levels.select(F.col("at").alias("key"), stack.alias("stack"))


def judged(
    pages: DataFrame, rules: DataFrame, key: str = "page_id", url: str = "url", default: str = ALLOW
) -> DataFrame:
    """key, host, path, rule and verdict of every row of pages.

    rules has host, path and verdict. rule is the host and path of the rule that decided, null where none
    did; then the verdict is the default.
    """
    named = written(pages.select(quoted(key).alias("key"), *host_and_path(quoted(url))), "urls")
    listed = (
        rules.select(lowered(F.col("host")).alias("host"), "path", "verdict")
        .filter("host != '' AND path IS NOT NULL")
        .groupBy("host", "path")
        .agg(F.max("verdict").alias("verdict"))
        .select(
            host_key(F.col("host")).alias("rule_host"),
            path_key(host_key(F.col("host")), F.col("path")).alias("rule_key"),
            F.struct(
                F.length(F.concat("host", "path")).alias("length"),
                F.length("host").alias("host_length"),
                F.concat("host", "path").alias("rule"),
                "verdict",
            ).alias("found"),
        )
    )
    listed = written(listed, "url-rules")
    hosts = named.filter("host != ''").select(host_key(F.col("host")).alias("key")).distinct()
    active = swept(listed.select(F.col("rule_host").alias("key")).distinct(), hosts)
    active = written(active.select(F.col("key").alias("host_key"), F.explode("stack").alias("rule_host")), "url-hosts")
    places = named.select("host", "path").distinct().withColumn("host_key", host_key(F.col("host")))
    pairs = places.join(active, "host_key").select(
        "host", "path", path_key(F.col("rule_host"), F.col("path")).alias("key")
    )
    pairs = written(pairs, "url-pairs")
    inner = swept(listed.select(F.col("rule_key").alias("key")), pairs.select("key").distinct())
    inner = inner.select("key", F.element_at("stack", -1).alias("rule_key"))
    inner = written(inner.join(listed, "rule_key").select("key", "found"), "url-inner")
    best = pairs.join(inner, "key").groupBy("host", "path").agg(F.max("found").alias("found"))
    best = written(best, "url-verdicts")
    return named.join(best, ["host", "path"], "left").select(
        F.col("key").alias(key),
        "host",
        "path",
        F.col("found.rule").alias("rule"),
        F.coalesce("found.verdict", F.lit(default)).alias("verdict"),
    )


def url_filters(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """The pages under four rules, as a digest."""
    rules = spark.sql(
        "SELECT * FROM VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), "
        "('example.com', '/de/', 'block'), ('org', '/fr/', 'allow') AS rules(host, path, verdict)"
    )
    return judged(pages, rules)
