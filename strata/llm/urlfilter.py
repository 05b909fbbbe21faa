"""URL rules in a trie over reversed host labels, then path segments.

A rule is (verdict, host, path).  It fits its host and all subdomains if the
URL's path starts with the rule's.  The longest match wins: more host labels
first, then the longer path; of equal rules, block.

Up to ``max_trie_bytes`` of rule text (measured before anything is collected)
the trie is built once and broadcast.  Beyond that the rules stay a table: each
distinct URL looks up all its (host suffix, path prefix) pairs by an equi-join
and the longest is kept.  Both give the same rows.

Defined cases: a null URL or one without ``://`` has an empty host and path and
fits no rule with a host; repeated rows each get their verdict; null rule
fields count as empty; with no rules every URL gets ``default``.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import lower_ascii, read_table

RULE_SCHEMA = "verdict string, host string, path string"
MAX_TRIE_BYTES = 8 << 20


def host_of(url: Column) -> Column:
    """Between the first ``://`` and the next ``/``, ``?``, ``#`` or the end; A-Z lower-cased."""
    return lower_ascii(F.coalesce(F.regexp_extract(url, r"://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    """After the host, up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


class RuleTrie:
    """Nodes are dicts: host labels from the right, then ``/`` and the segments
    that a slash ends.  At a node, ``""`` holds (rest of path, rule, verdict)
    for rules that end there, longest rest first."""

    def __init__(self, rules: Iterable[tuple[str, str, str]] = (), root: dict | None = None):
        self.root: dict = {} if root is None else root
        for verdict, host, path in sorted(rules, key=lambda r: r[0] != "block"):
            node = self.root
            for label in reversed(host.split(".")):
                node = node.setdefault(label, {})
            node = node.setdefault("/", {})
            *whole, rest = path.split("/")
            for segment in whole:
                node = node.setdefault("/" + segment, {})
            ends = node.setdefault("", [])
            if rest not in [e[0] for e in ends]:  # block came first
                ends.append((rest, host + path, verdict))
                ends.sort(key=lambda e: -len(e[0]))

    def match(self, host: str, path: str) -> tuple[str | None, str | None]:
        best, node = None, self.root
        for label in reversed(host.split(".")):
            node = node.get(label)
            if node is None:
                break
            if "/" in node:
                best = self._path(node["/"], path) or best
        return best or (None, None)

    @staticmethod
    def _path(node: dict, path: str) -> tuple[str, str] | None:
        best, pieces = None, path.split("/")
        for i, piece in enumerate(pieces):
            for rest, rule, verdict in node.get("", ()):
                if piece.startswith(rest) or not rest:
                    best = rule, verdict
                    break
            node = node.get("/" + piece) if i < len(pieces) - 1 else None
            if node is None:
                break
        return best


def judge_urls(
    urls: DataFrame,
    rules: DataFrame,
    default: str = "allow",
    url_col: str = "url",
    max_trie_bytes: int = MAX_TRIE_BYTES,
) -> DataFrame:
    """``urls`` with host, path, rule and verdict added (columns of ``urls``
    that have these names are replaced)."""
    rules = rules.select(
        F.lower(F.col("verdict")).alias("verdict"),
        lower_ascii(F.coalesce("host", F.lit(""))).alias("host"),
        F.coalesce("path", F.lit("")).alias("path"),
    )
    size = rules.agg(F.sum(F.octet_length("host") + F.octet_length("path") + 16)).first()[0] or 0
    parsed = urls.withColumns({"host": host_of(F.col(url_col)), "path": path_of(F.col(url_col))})
    if size > max_trie_bytes:
        return _judge_by_join(parsed, rules, default)
    trie = urls.sparkSession.sparkContext.broadcast(RuleTrie([tuple(r) for r in rules.collect()]).root)

    @F.pandas_udf("rule string, verdict string")
    def judged(pairs: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        rules_by_host = RuleTrie(root=trie.value)
        for hosts, paths in pairs:
            yield pd.DataFrame([rules_by_host.match(h, p) for h, p in zip(hosts, paths)], columns=["rule", "verdict"])

    found = parsed.withColumn("_found", judged("host", "path"))
    return found.withColumns(
        {"rule": F.col("_found.rule"), "verdict": F.coalesce("_found.verdict", F.lit(default))}
    ).drop("_found")


def _judge_by_join(parsed: DataFrame, rules: DataFrame, default: str) -> DataFrame:
    """For rule sets too large for a broadcast: every (host suffix, path up to
    a slash) of each distinct URL against the rules with that host and stem."""
    rules = rules.select(
        F.col("host").alias("_host"),
        F.regexp_extract("path", r"^(?s:.*/)?", 0).alias("_stem"),
        F.col("path").alias("_path"),
        F.col("verdict").alias("_verdict"),
    )
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    pieces = F.split("path", "/")
    stems = F.transform(
        F.sequence(F.lit(1), F.size(pieces)), lambda i: F.concat(F.array_join(F.slice(pieces, 1, i - 1), "/"), F.when(i > 1, "/").otherwise(""))
    )
    distinct = parsed.select("host", "path").distinct()
    tried = distinct.withColumn("_host", F.explode(suffixes)).withColumn("_stem", F.explode(stems))
    hits = tried.join(rules, ["_host", "_stem"]).where(F.col("path").startswith(F.col("_path")))
    rank = F.struct(F.length("_host"), F.length("_path"), (F.col("_verdict") == "block"))
    best = hits.groupBy("host", "path").agg(F.max_by(F.struct("_host", "_path", "_verdict"), rank).alias("_best"))
    best = best.select(F.col("host").alias("_h"), F.col("path").alias("_p"), "_best")
    return (
        parsed.join(best, (F.col("host") == F.col("_h")) & (F.col("path") == F.col("_p")), "left")
        .withColumns({"rule": F.concat("_best._host", "_best._path"), "verdict": F.coalesce("_best._verdict", F.lit(default))})
        .drop("_h", "_p", "_best")
    )


#: Fixed values of the query: verdict, host, path.
QUERY_RULES = [
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
]


def op2_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(QUERY_RULES, RULE_SCHEMA)
    urls = read_table(spark, sf_dir, "pages").select("page_id", "url")
    return judge_urls(urls, rules).select("page_id", "host", "path", "rule", "verdict")


OP2_SQL = """
WITH parsed AS (
  SELECT page_id,
         translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path,
         row_number() OVER () AS r
  FROM pages
),
rules(verdict, rule_host, rule_path) AS (
  VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')
),
best AS (
  SELECT r, arg_max(rule_host || rule_path, length(rule_host) * 1000 + length(rule_path)) AS rule,
         arg_max(verdict, length(rule_host) * 1000 + length(rule_path)) AS verdict
  FROM parsed JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY r
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM parsed LEFT JOIN best USING (r)
"""
