"""URL filter: host rules by suffix, pattern rules found through their rarest literal token."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ALLOW, BLOCK = "allow", "block"

# Rules of fewer characters than this are sent to all tasks; more are joined by a shuffle.
SMALL = 4_000_000

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Any scheme and leading host labels, or the start of the host itself.
HOST_START = r"^[a-z][a-z0-9+.-]*://([^/?#]*\.)?"
SEPARATOR = r"([^a-z0-9_.%-]|$)"


@dataclass(frozen=True)
class HostRule:
    """Fits ``host`` and its subdomains where the path starts with ``path``."""

    verdict: str
    host: str
    path: str = ""

    @property
    def text(self) -> str:
        return self.host + self.path


@dataclass(frozen=True)
class PatternRule:
    """A pattern over the lower-cased URL.

    ``*`` stands for anything, ``^`` for a separator or the end, ``|`` at either end for that end
    of the URL, ``||`` for the start of the host or of one of its labels. An allowing pattern
    overrides blocking ones.
    """

    verdict: str
    pattern: str

    @property
    def regex(self) -> str:
        body, start, end = self.pattern, "", ""
        if body.startswith("||"):
            body, start = body[2:], HOST_START
        elif body.startswith("|"):
            body, start = body[1:], "^"
        if body.endswith("|"):
            body, end = body[:-1], "$"
        special = {"*": ".*", "^": SEPARATOR}
        return start + "".join(special.get(c) or re.escape(c) for c in body) + end

    @property
    def tokens(self) -> list[str]:
        """Runs of letters and digits that every fitting URL holds as whole tokens."""
        pattern = self.pattern
        found = []
        for m in re.finditer("[a-z0-9]+", pattern):
            before, after = pattern[: m.start()][-1:], pattern[m.end() :][:1]
            if before not in ("", "*") and after not in ("", "*"):
                found.append(m[0])
        return found


def lowered(column: Column) -> Column:
    """A-Z in lower case, everything else as it is."""
    return F.translate(column, UPPER, LOWER)


def url_host(url: Column) -> Column:
    return lowered(F.coalesce(F.regexp_extract(url, r"://([^/?#]*)", 1), F.lit("")))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def url_tokens(url: Column) -> Column:
    """The distinct runs of letters and digits; an empty token fetches rules without a token."""
    return F.array_union(F.split(lowered(url), "[^a-z0-9]+"), F.array(F.lit("")))


def rule_index(urls: DataFrame, url: str, rules: Sequence[PatternRule]) -> DataFrame:
    """(token, verdict, pattern, regex): each rule under the token that the URLs hold least often.

    Ties go to the smaller token; a rule without a whole literal token stands under the empty one.
    """
    spark = urls.sparkSession
    rows = [(r.verdict, r.pattern, r.regex, sorted(set(r.tokens)) or [""]) for r in rules]
    table = spark.createDataFrame(
        rows, "verdict string, pattern string, regex string, tokens array<string>"
    )
    table = table.withColumn("token", F.explode("tokens")).drop("tokens")
    held = urls.select(F.explode(url_tokens(F.col(url))).alias("token"))
    counts = held.groupBy("token").agg(F.count("*").alias("n"))
    ranked = table.join(counts, "token", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    return ranked.groupBy("verdict", "pattern", "regex").agg(
        F.min(F.struct("n", "token"))["token"].alias("token")
    )


def judge_urls(
    pages: DataFrame,
    url: str,
    host_rules: Sequence[HostRule],
    pattern_rules: Sequence[PatternRule],
) -> DataFrame:
    """All rows and columns of ``pages`` with host, path, rule, verdict and pattern.

    The longest host rule that fits gives the verdict and ``rule``; without one, an allowing
    pattern, then a blocking one, whose text is in ``pattern``; else the URL is allowed. A URL
    that is NULL or has no ``://`` has empty host and path; a NULL one is allowed. Repeated rows
    are judged each. Columns of the result that ``pages`` already has are replaced.

    URL tokens meet the rules in one equi-join, so a rule's expression runs only on URLs that
    hold its token; the rows of a URL come together again by a row number.
    """
    spark = pages.sparkSession
    rest = [c for c in pages.columns if c not in {"host", "path", "rule", "verdict", "pattern"}]
    row = pages.select(F.struct(*rest).alias("row"), F.col(url).alias("url")).withColumns(
        {
            "id": F.monotonically_increasing_id(),
            "host": url_host(F.col("url")),
            "path": url_path(F.col("url")),
        }
    )
    depth = max([1, *(r.host.count(".") + 1 for r in host_rules)])
    suffixes = F.array_distinct(
        F.array(*[F.substring_index("host", ".", -k) for k in range(1, depth + 1)])
    )
    hosts = spark.createDataFrame(
        [(f"h:{r.host}", r.path, r.text, r.verdict, None, None) for r in host_rules],
        "key string, prefix string, rule string, verdict string, pattern string, regex string",
    )
    patterns = rule_index(pages, url, pattern_rules).select(
        F.concat(F.lit("t:"), "token").alias("key"),
        F.lit(None).cast("string").alias("prefix"),
        F.lit(None).cast("string").alias("rule"),
        "verdict", "pattern", "regex",
    )
    keys = F.array_union(
        F.transform(suffixes, lambda s: F.concat(F.lit("h:"), s)),
        F.transform(
            F.coalesce(url_tokens(F.col("url")), F.array()), lambda t: F.concat(F.lit("t:"), t)
        ),
    )
    rules = hosts.unionByName(patterns)
    if sum(len(r.text) for r in host_rules) + sum(len(r.regex) for r in pattern_rules) < SMALL:
        rules = F.broadcast(rules)
    met = row.withColumn("key", F.explode(keys)).join(rules, "key", "left")
    fits = F.when(F.col("prefix").isNotNull(), F.startswith("path", "prefix")).otherwise(
        F.rlike(lowered(F.col("url")), F.col("regex"))
    )
    # Compared in this order: host rules before patterns, longer before shorter, allow before block.
    best = F.when(
        F.coalesce(fits, F.lit(False)),
        F.struct(
            F.col("prefix").isNotNull().alias("by_host"),
            F.coalesce(F.length("rule"), F.lit(0)).alias("length"),
            (F.col("verdict") == ALLOW).alias("allows"),
            "rule", "pattern", "verdict",
        ),
    )
    judged = met.groupBy("id").agg(
        F.first("row").alias("row"),
        F.first("host").alias("host"),
        F.first("path").alias("path"),
        F.max(best).alias("best"),
    )
    return judged.select(
        "row.*", "host", "path",
        F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(ALLOW)).alias("verdict"),
        F.col("best.pattern").alias("pattern"),
    )
