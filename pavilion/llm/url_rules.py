"""Block and allow rules on host and path prefixes, by a sort-merge range join.

A key is a reversed host and a path, as in ``net.example`` and ``/en/``. A rule
fits its host and all below it, so a URL is looked up once under each host above
its own that has rules. There, a path prefix is an interval of paths: it opens at
the prefix and closes after its last extension. Rules and URLs of one host are
sorted together and swept once. Prefixes nest, so the open rules form a stack. A
running sum of openings and closings is its height, and the rule on top is the
last one that opened at this height.

Hosts with many URLs are cut into parts, each of which gets the host's rules.
DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pavilion.llm.expressions import let, upto
from pavilion.llm.storage import fresh, stored

# URLs of one host in one part of the sweep, about.
PART_URLS = 1_000_000


def _lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.char_length(url))).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    """From the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    rest = _after_scheme(F.coalesce(url, F.lit("")))
    return _lower(F.regexp_extract(rest, r"^[^/?#]*", 0))


def path_of(url: Column) -> Column:
    """After the host, up to ``?``, ``#`` or the end."""
    rest = _after_scheme(F.coalesce(url, F.lit("")))
    return F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def reversed_host(host: Column) -> Column:
    return F.array_join(F.reverse(F.split(host, r"\.", -1)), ".")


def _levels(host: Column) -> Column:
    """The reversed host and all hosts above it."""
    return let(
        F.reverse(F.split(host, r"\.", -1)),
        lambda labels: F.transform(upto(F.size(labels)), lambda i: F.array_join(F.slice(labels, 1, i + 1), ".")),
    )


def _canonical(rules: DataFrame) -> DataFrame:
    """Rules by reversed host and path; of equal ones, block wins."""
    host = _lower(F.col("host"))
    named = rules.where("host IS NOT NULL AND path IS NOT NULL AND verdict IS NOT NULL").select(
        reversed_host(host).alias("level"), "path", F.concat(host, "path").alias("rule"), "verdict"
    )
    return named.groupBy("level", "path").agg(F.max("verdict").alias("verdict"), F.min("rule").alias("rule"))


def matched(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``host``, ``path``, ``rule``, ``verdict`` of the distinct URLs that a rule fits.

    ``urls`` has ``host`` and ``path``, ``rules`` has ``host``, ``path`` and
    ``verdict``. The longest rule wins: the one with the longer text, host and path
    together.
    """
    rules = stored(_canonical(rules), "rules")
    distinct = stored(urls.where("host != ''").select("host", "path").distinct(), "urls")
    # Only hosts with rules have anything to sweep.
    hosts = rules.select("level").distinct()
    looked_up = distinct.select("host", "path", F.explode(_levels(F.col("host"))).alias("level"))
    looked_up = stored(looked_up.join(stored(hosts, "hosts"), "level", "left_semi"), "lookups")
    counts = looked_up.groupBy("level").agg(F.ceil(F.count("*") / PART_URLS).cast("int").alias("parts"))
    counts = stored(counts, "parts")
    part = F.pmod(F.xxhash64("host", "path"), F.col("parts")).cast("int")
    points = looked_up.join(counts, "level").select(
        "level", part.alias("part"), F.encode("path", "utf-8").alias("key"), F.lit(1).alias("kind"), "host", "path",
        F.lit(None).cast("string").alias("rule"), F.lit(None).cast("string").alias("verdict"),
    )
    copies = rules.join(counts, "level").withColumn("part", F.explode(upto(F.col("parts"))))
    prefix = F.encode("path", "utf-8")

    def ends(key: Column, kind: int) -> DataFrame:
        return copies.select(
            "level", "part", key.alias("key"), F.lit(kind).alias("kind"), F.lit(None).cast("string").alias("host"),
            F.lit(None).cast("string").alias("path"), "rule", "verdict",
        )

    # The byte FF is in no text, so the close comes after every extension of the prefix.
    events = points.unionAll(ends(prefix, 0)).unionAll(ends(F.concat(prefix, F.lit(b"\xff")), 2))
    in_order = [F.col("key"), F.col("kind")]
    sweep = Window.partitionBy("level", "part").orderBy(*in_order).rowsBetween(Window.unboundedPreceding, 0)
    step = F.when(F.col("kind") == 0, 1).when(F.col("kind") == 2, -1).otherwise(0)
    deep = events.withColumn("height", F.sum(step).over(sweep))
    stack = Window.partitionBy("level", "part", "height").orderBy(*in_order).rowsBetween(Window.unboundedPreceding, 0)
    opened = F.when(F.col("kind") == 0, F.struct("rule", "verdict"))
    top = deep.withColumn("top", F.last(opened, ignorenulls=True).over(stack))
    fits = top.where("kind = 1 AND height > 0").select("host", "path", "top.*")
    best = F.max(F.struct(F.char_length("rule").alias("size"), "rule", "verdict")).alias("best")
    return fits.groupBy("host", "path").agg(best).select("host", "path", "best.rule", "best.verdict")


def judged(pages: DataFrame, rules: DataFrame, url_column: str = "url", default: str = "allow") -> tuple[DataFrame, list[str]]:
    """``pages`` with four more columns, and their names: host, path, rule, verdict.

    Where no rule fits, the rule is null and the verdict is ``default``. A null URL,
    or one without ``://``, has an empty host and path, and no rule fits it. Repeated
    rows get equal answers, each one; names that ``pages`` has get underscores.
    """
    names = fresh(pages, "host", "path", "rule", "verdict")
    host, path, rule, verdict = names
    known = pages.withColumns({host: host_of(F.col(f"`{url_column}`")), path: path_of(F.col(f"`{url_column}`"))})
    urls = known.select(F.col(host).alias("host"), F.col(path).alias("path"))
    found = stored(matched(urls, rules), "verdicts")
    found = found.select(
        F.col("host").alias(host), F.col("path").alias(path), F.col("rule").alias(rule), F.col("verdict").alias(verdict)
    )
    result = known.join(found, [host, path], "left").withColumn(verdict, F.coalesce(verdict, F.lit(default)))
    return result.select(*[F.col(f"`{c}`") for c in pages.columns], *names), names
