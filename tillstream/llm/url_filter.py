"""URL filters: pattern rules indexed by their rarest literal token.

A rule is a pattern over ``host + path``. Its *literal tokens* are the
alphanumeric runs that any matching URL must contain whole. Each rule is filed
under the one of them that is rarest in the corpus (counted by a grouped
aggregation), a URL's own tokens fetch the candidate rules, and only those run
their regular expressions. Rules come as a short list (compiled into one
projection) or as a table of any size, whose patterns are compiled by column
functions and which is joined by token.

Pattern syntax: ``||`` anchors at a host label, ``|`` at the start or end,
``*`` matches anything, ``^`` a separator or an end; all else is literal.

Defined results: a null URL or one without ``://`` has an empty host and path
(no rule fits, verdict ``allow``); repeated rows are judged alike; longest rule
wins, equal lengths go to the greater rule in code point order; very long URLs
are matched whole; an empty table or rule list is fine; rules without a text or
pattern are left out; clashing input columns are replaced by result columns.
"""

from __future__ import annotations

import re
from collections import defaultdict
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import RESERVED

#: Up to this many rules the index is a literal of the projection; beyond, a joined table.
INLINE_RULES = 64
#: Tasks that the rows of one token are spread over.
SALTS = 16
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TOKEN_SPLIT = "[^A-Za-z0-9]+"


@dataclass(frozen=True)
class Rule:
    """``text`` as reported, ``pattern`` to match, ``action`` allow or block.
    Tier 0 rules (host and path lists) decide before tier 1 (patterns)."""
    text: str
    pattern: str
    action: str
    tier: int = 1

    @property
    def regex(self) -> str:
        body, out = self.pattern, "^"
        if body.startswith("||"):
            body, out = body[2:], r"^(?:[^/]*\.)?"
        elif body.startswith("|"):
            body = body[1:]
        else:
            out = ""
        end = body.endswith("|")
        for part in re.findall(r"[*^]|[^*^]+", body[:-1] if end else body):
            out += {"*": ".*", "^": "(?:^|$|[^A-Za-z0-9])"}.get(part, re.escape(part))
        return "(?s)" + out + ("$" if end else "")

    @property
    def tokens(self) -> list[str]:
        """Alphanumeric runs bounded on both sides in every match."""
        bounded = self.pattern.replace("||", "|", 1) if self.pattern.startswith("||") else self.pattern
        return [m[0] for m in re.finditer(r"[A-Za-z0-9]+", bounded)
                if m.start() > 0 and bounded[m.start() - 1] != "*"
                and m.end() < len(bounded) and bounded[m.end()] != "*"]


def host_rule(host: str, path: str, action: str) -> Rule:
    """Fits a host and its subdomains where the URL's path starts with ``path``."""
    return Rule(host + path, "||" + host + path, action, 0)


#: Host and path list of the contract.
HOST_RULES = (
    host_rule("net", "/", "block"),
    host_rule("example.net", "/en/", "allow"),
    host_rule("example.com", "/de/", "block"),
    host_rule("org", "/fr/", "allow"),
)
#: Host labels of advertising, gambling, adult and spam sites.
PATTERN_RULES = tuple(Rule(p, p, "block") for p in (
    "||ads-", "||adult-", "||casino-", "||cheap-pills.", "||free-bets.", "||spam-", "||xxx."))


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path): host after the first ``://``, ASCII-lowered; then the path."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    part = lambda k: F.coalesce(F.regexp_extract(rest, r"^([^/?#]*)([^?#]*)", k), F.lit(""))
    return F.translate(part(1), UPPER, LOWER), part(2)


def _tokens(subject: Column) -> Column:
    # The empty token stands for rules without any literal token: every URL fetches them.
    return F.array_distinct(F.concat(F.array(F.lit("")), F.split(subject, TOKEN_SPLIT)))


def token_counts(urls: DataFrame, subject: str, rules) -> dict[str, int]:
    """Corpus frequency of the rules' own tokens (at most as many rows as the rules have)."""
    wanted = sorted({t for r in rules for t in r.tokens})
    if not wanted:
        return {}
    found = (urls.select(F.explode(_tokens(F.col(subject))).alias("token"))
             .where(F.col("token").isin(*wanted)).groupBy("token").count())
    return {r["token"]: r["count"] for r in found.collect()}


def build_index(rules, counts: dict[str, int]) -> dict[str, list[Rule]]:
    """Token -> rules filed under it: each rule under its rarest token ('' if it has none)."""
    index = defaultdict(list)
    for r in rules:
        index[min(r.tokens, key=lambda t: (counts.get(t, 0), t), default="")].append(r)
    return dict(index)


def _struct(r: Rule) -> Column:
    return F.struct(F.lit(len(r.text)).alias("size"), F.lit(r.text).alias("text"),
                    F.lit(r.action).alias("action"), F.lit(r.tier).alias("tier"),
                    F.lit(r.regex).alias("regex"))


_HIT = "struct<size:int,text:string,action:string,tier:int,regex:string>"


def _hits_inline(df: DataFrame, subject: str, index) -> DataFrame:
    """Candidates from a literal map: one projection, no shuffle."""
    if not index:
        return df.withColumn(f"{RESERVED}hits", F.lit(None).cast(f"array<{_HIT}>"))
    literal = F.create_map(*[x for t, rs in sorted(index.items())
                             for x in (F.lit(t), F.array(*[_struct(r) for r in rs]))])
    fetched = F.flatten(F.array_compact(F.transform(
        _tokens(F.col(subject)), lambda t: F.try_element_at(literal, t))))
    return df.withColumn(f"{RESERVED}hits",
                         F.filter(fetched, lambda r: F.regexp_like(F.col(subject), r["regex"])))


#: ASCII punctuation to escape in a pattern (not ``*`` and ``^``).
_SPECIAL = r"([\x20-\x29\x2B-\x2F\x3A-\x40\x5B-\x5D\x5F\x60\x7B-\x7E])"


def regex_of(pattern: Column) -> Column:
    """``Rule.regex`` as a column function."""
    head = F.when(pattern.startswith("||"), F.lit(r"^(?:[^/]*\.)?")).when(pattern.startswith("|"), F.lit("^")).otherwise("")
    body = F.regexp_replace(F.regexp_replace(pattern, r"^\|\|?", ""), r"\|$", "")
    body = F.regexp_replace(F.regexp_replace(body, _SPECIAL, r"\\$1"), r"\*", ".*")
    body = F.regexp_replace(body, r"\^", r"(?:^|\$|[^A-Za-z0-9])")
    ends = pattern.endswith("|") & (F.length(F.regexp_replace(pattern, r"^\|\|?", "")) > 0)
    return F.concat(F.lit("(?s)"), head, body, F.when(ends, "$").otherwise(""))


def tokens_of(pattern: Column) -> Column:
    """``Rule.tokens`` as a column function."""
    bounded = F.regexp_replace(pattern, r"^\|\|", "|")
    return F.regexp_extract_all(bounded, F.lit("(?<=[^*A-Za-z0-9])[A-Za-z0-9]+(?=[^*A-Za-z0-9])"), F.lit(0))


def rule_frame(spark, rules) -> DataFrame:
    """A list of rules as a table (text, pattern, action, tier)."""
    fields = "text string, pattern string, action string, tier int"
    rows = F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in (
        ("text", r.text), ("pattern", r.pattern), ("action", r.action), ("tier", r.tier))]) for r in rules])
    return spark.range(1).select(F.explode(rows.cast(f"array<struct<{fields.replace(' ', ':').replace(',:', ',')}>>"))
                                 .alias("rule")).select("rule.*")


def _spread(many: DataFrame, few: DataFrame, token: str, unique: str, how: str) -> DataFrame:
    """``many`` joined with ``few`` by ``token``; a token's rows of ``many`` are dealt to several tasks by ``unique``."""
    salt = f"{RESERVED}salt"
    dealt = many.withColumn(salt, F.pmod(F.xxhash64(unique), F.lit(SALTS)).cast("int"))
    copied = few.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return dealt.join(copied, [token, salt], how).drop(salt)


def filed_rules(rules: DataFrame, urls: DataFrame, subject: str) -> DataFrame:
    """(token, size, text, action, tier, regex): each rule under its rarest token in ``urls``."""
    pattern = F.col("pattern")
    made = (rules.where(F.col("text").isNotNull() & pattern.isNotNull()).distinct()
            .select(F.length("text").alias("size"), "text", "action", "tier", regex_of(pattern).alias("regex"),
                    tokens_of(pattern).alias("tokens")))
    own = made.select("text", "tier", "action", "regex", "size", F.explode_outer("tokens").alias("token"))
    counts = (urls.select(F.explode(_tokens(F.col(subject))).alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n"))
              .join(own.select("token").distinct(), "token"))
    return (_spread(own, counts, "token", "regex", "left").groupBy("size", "text", "action", "tier", "regex")
            .agg(F.coalesce(F.min(F.when(F.col("token").isNotNull(), F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token")))["token"],
                            F.lit("")).alias("token")))


def _hits_joined(df: DataFrame, subject: str, filed: DataFrame) -> DataFrame:
    """Candidates by a join of the distinct subjects' tokens with the filed rules.

    Only tokens that some rule is filed under survive the join. The best hits
    are maxima per subject (combined map-side), joined back by subject: the
    right side is unique and AQE splits a hot subject on the left.
    """
    hit = F.struct("size", "text", "action", "tier", "regex")
    fetching = df.select(F.col(subject).alias(f"{RESERVED}key")).distinct().withColumn(
        "token", F.explode(_tokens(F.col(f"{RESERVED}key"))))
    best = (
        _spread(fetching, filed, "token", f"{RESERVED}key", "inner")
        .where(F.regexp_like(F.col(f"{RESERVED}key"), F.col("regex")))
        .groupBy(f"{RESERVED}key")
        .agg(F.array_compact(F.array(F.max(F.when(F.col("tier") == 0, hit)),
                                     F.max(F.when(F.col("tier") == 1, hit)))).alias(f"{RESERVED}hits"))
    )
    return df.join(best, F.col(subject) == F.col(f"{RESERVED}key"), "left").drop(f"{RESERVED}key")


def judge_urls(pages: DataFrame, url: str = "url", host_rules=HOST_RULES,
               pattern_rules=PATTERN_RULES, inline_rules: int = INLINE_RULES,
               rule_table: DataFrame | None = None) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` (host rule that won, or null),
    ``pattern`` (pattern rule that fits, or null) and ``verdict``: the host
    rule's action, else the pattern's, else ``allow``. ``rule_table``: further
    rules (text, pattern, action, tier), of any number."""
    rules = [*host_rules, *pattern_rules]
    host, path = url_parts(F.col(url))
    subject = f"{RESERVED}subject"
    parts = pages.withColumns({f"{RESERVED}host": host, f"{RESERVED}path": path}) \
        .withColumn(subject, F.concat(f"{RESERVED}host", f"{RESERVED}path"))
    if rule_table is None and len(rules) <= inline_rules:
        hits = _hits_inline(parts, subject, build_index(rules, token_counts(parts, subject, rules)))
    else:
        table = rule_frame(pages.sparkSession, rules)
        if rule_table is not None:
            table = table.unionByName(rule_table.select("text", "pattern", "action", F.col("tier").cast("int").alias("tier")))
        hits = _hits_joined(parts, subject, filed_rules(table, parts, subject))
    best = lambda tier: F.array_max(F.filter(F.col(f"{RESERVED}hits"), lambda r: r["tier"] == tier))
    return (
        hits.withColumns({f"{RESERVED}rule": best(0), f"{RESERVED}pattern": best(1)})
        .withColumns({
            "host": F.col(f"{RESERVED}host"),
            "path": F.col(f"{RESERVED}path"),
            "rule": F.col(f"{RESERVED}rule.text"),
            "verdict": F.coalesce(f"{RESERVED}rule.action", f"{RESERVED}pattern.action", F.lit("allow")),
            "pattern": F.col(f"{RESERVED}pattern.text"),
        })
        .drop(*[f"{RESERVED}{x}" for x in ("host", "path", "subject", "hits", "rule", "pattern")])
    )
