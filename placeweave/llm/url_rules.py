"""URL filtering with pattern rules indexed by their rarest literal token; DataFrame functions only.

A rule is a pattern over ``host + path`` in the syntax of common block lists: ``||`` at the start
anchors at the host or at a label of it, ``^`` stands for a separator or an end, ``*`` for
anything; all else is literal.  A run of letters and digits that the pattern bounds on both sides
is a token that every matching URL must have.  Each rule is filed under that one of its tokens
which the fewest URLs have (counted over all of them), each URL looks up its own tokens, and only
the rules found so run their regular expressions.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Up to so many rules the index is a literal in the plan, and nothing is shuffled.
INLINE_RULES = 1_000
#: Up to so many rules (a few MB) the index is broadcast; beyond that it is an ordinary join side.
BROADCAST_RULES = 50_000
TOKEN = "[a-z0-9]+"


@dataclass(frozen=True)
class Rule:
    """``listed``: an explicit host and path rule, which goes before every other; the longest wins."""

    pattern: str
    action: str
    listed: bool = False

    @property
    def name(self) -> str:
        return self.pattern.removeprefix("||")

    @property
    def regex(self) -> str:
        body = self.name if self.pattern.startswith("||") else self.pattern
        parts = {"^": "(?:^|[^A-Za-z0-9]|$)", "*": ".*"}
        out = "".join(parts.get(c) or (c if c.isalnum() else "\\" + c) for c in body)
        return ("(?s)^(?:[^/]*\\.)?" if self.pattern.startswith("||") else "(?s)") + out

    @property
    def tokens(self) -> list[str]:
        """Literal tokens that are whole tokens of any URL that the rule matches."""
        found = []
        for m in re.finditer(r"[A-Za-z0-9]+", self.pattern):
            before, after = self.pattern[: m.start()][-1:], self.pattern[m.end() :][:1]
            if before not in ("", "*") and after not in ("", "*"):
                found.append(m.group().lower())
        return found


#: The host and path rules, then the patterns for everything they leave open.
LISTED = [
    Rule("||net/", "block", True),
    Rule("||example.net/en/", "allow", True),
    Rule("||example.com/de/", "block", True),
    Rule("||org/fr/", "allow", True),
]
PATTERNS = [
    Rule("^casino-win^", "block"),
    Rule("^adult-x^", "block"),
    Rule("^ads-track^", "block"),
    Rule("^cheap-pills^", "block"),
    Rule("^casino^", "block"),
    Rule("^porn^", "block"),
    Rule("^xxx^", "block"),
    Rule("^viagra^", "block"),
    Rule("^poker^", "block"),
    Rule("^doubleclick^", "block"),
    Rule("^adserver^", "block"),
    Rule("/ads/*/click^", "block"),
]


#: The longest rule list that is read: rules pass through the driver.
MOST_RULES = 1_000_000


def parse_rules(lines: Iterable[str]) -> list[Rule]:
    """Rules of a block list: ``!`` and ``[`` begin comments, ``@@`` exceptions, ``$`` options, which are left out; a
    rule with an option that narrows it to a kind of page content is left out whole."""
    out = []
    for line in lines:
        line = line.strip()
        if not line or line[0] in "![" or "##" in line or "#@#" in line:
            continue
        pattern, _, options = line.removeprefix("@@").partition("$")
        if pattern and not options:
            out.append(Rule(pattern, "allow" if line.startswith("@@") else "block"))
    return list(dict.fromkeys(out))


def read_rules(spark: SparkSession, path: str) -> list[Rule]:
    """The rules of a list that Spark reads as text; a list beyond ``MOST_RULES`` is refused, not cut."""
    lines = spark.read.text(path).limit(MOST_RULES + 1).collect()
    if len(lines) > MOST_RULES:
        raise ValueError(f"more than {MOST_RULES} rules")
    return parse_rules(r["value"] for r in lines)


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.translate(F.coalesce(F.regexp_extract(url, "(?s)^.*?://([^/?#]*)", 1), F.lit("")), upper, lower)


def path(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, "(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _file(rules: list[Rule], counts: dict[str, int]) -> dict[str | None, list[Rule]]:
    """Rules by their rarest token; under None those that have no token, which every URL must try."""
    index: dict[str | None, list[Rule]] = {}
    for r in rules:
        index.setdefault(min(r.tokens, key=lambda t: (counts.get(t, 0), t), default=None), []).append(r)
    return index


def _struct(r: Rule) -> Column:
    return F.struct(
        F.lit(r.listed).alias("listed"), F.lit(len(r.name)).alias("size"), F.lit(r.name).alias("name"),
        F.lit(r.action).alias("action"), F.lit(r.regex).alias("regex"),
    )


KIND = "array<struct<listed:boolean,size:int,name:string,action:string,regex:string>>"


def judge(pages: DataFrame, rules: list[Rule], url: str = "url") -> DataFrame:
    """``pages`` with host, path, rule and verdict (columns of these names are replaced).

    The longest listed rule that fits decides, and is named in ``rule``; ties go to the name that
    sorts last.  Else the verdict is block if the longest other rule that fits says so, and allow
    if it says so or none fits.  A null URL, or one without ``://``, has an empty host and path.
    """
    spark = pages.sparkSession
    rows = pages.drop("host", "path", "rule", "verdict")
    rows = rows.withColumns({"host": host(F.col(url)), "path": path(F.col(url))})
    target = F.concat("host", "path")
    rows = rows.withColumn("__target", target)
    tokens = F.array_distinct(F.regexp_extract_all(F.lower("__target"), F.lit(f"({TOKEN})"), F.lit(1)))
    wanted = sorted({t for r in rules for t in r.tokens})
    named = rows.select(F.explode(tokens).alias("token"))
    if len(wanted) <= INLINE_RULES:
        named = named.filter(F.col("token").isin(wanted))
    else:
        known = spark.createDataFrame([(t,) for t in wanted], "token string")
        named = named.join(F.broadcast(known) if len(wanted) <= BROADCAST_RULES else known, "token", "left_semi")
    # One count for each token of the rules reaches the driver.
    counts = dict(map(tuple, named.groupBy("token").agg(F.count("*").alias("n")).collect())) if wanted else {}
    index = _file(rules, counts)
    always = F.array(*[_struct(r) for r in index.pop(None, [])]).cast(KIND)
    fits = lambda found: F.filter(found, lambda r: F.rlike(F.col("__target"), r["regex"]))

    if len(rules) <= INLINE_RULES:
        found = always
        if index:
            table = F.create_map(*[x for t, rs in sorted(index.items()) for x in (F.lit(t), F.array(*map(_struct, rs)))])
            hits = F.filter(tokens, lambda t: F.map_contains_key(table, t))
            found = F.concat(always, F.flatten(F.transform(hits, lambda t: F.element_at(table, t))).cast(KIND))
        rows = rows.withColumn("__fit", fits(found))
    else:
        filed = [(t, r.listed, len(r.name), r.name, r.action, r.regex) for t, rs in index.items() for r in rs]
        side = spark.createDataFrame(filed, "token string, listed boolean, size int, name string, action string, regex string")
        side = side.select("token", F.struct("listed", "size", "name", "action", "regex").alias("r"))
        side = F.broadcast(side) if len(rules) <= BROADCAST_RULES else side
        # The largest of each kind per distinct target: aggregates that are combined before the shuffle.
        one = rows.select("__target", F.explode(tokens).alias("token")).join(side, "token").filter(F.rlike("__target", F.col("r.regex")))
        best = one.groupBy("__target").agg(
            F.array_compact(F.array(F.max(F.when(F.col("r.listed"), F.col("r"))), F.max(F.when(~F.col("r.listed"), F.col("r"))))).alias("__hit")
        )
        rows = rows.join(best, "__target", "left")
        rows = rows.withColumn("__fit", F.concat(fits(always), F.coalesce("__hit", F.array().cast(KIND)))).drop("__hit")
    # array_max orders by (listed, size, name).
    rows = rows.withColumn("__best", F.array_max("__fit"))
    return rows.select(
        *[c for c in rows.columns if not c.startswith("__")],
        F.when(F.col("__best.listed"), F.col("__best.name")).alias("rule"),
        F.coalesce(F.col("__best.action"), F.lit("allow")).alias("verdict"),
    )
