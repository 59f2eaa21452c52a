"""URL allow and block lists as a trie over reversed host labels and path segments."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: (verdict, rule): a rule is a host, then a path that begins with a slash.
RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)
DEFAULT_VERDICT = "allow"
#: Rule lists of at most this many rules are broadcast as a trie, which takes one or two
#: kilobytes a rule in each worker; longer ones are joined, with the same verdicts.
BROADCAST_RULES = 50_000
#: Copies of joined rules, over which the urls of one host are spread.
SALTS = 16

HOST = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def split_rule(rule: str) -> tuple[str, str]:
    host, slash, path = rule.partition("/")
    return host, slash + path


class Trie:
    """Nodes by reversed host label, then by path segment.

    A rule's last, unended segment (after its last slash) is kept as a tail, since a rule
    fits a path that starts with it, also inside a segment.  A node looks up a segment's
    beginnings of the lengths that its tails have, so its work grows with those lengths,
    not with its tails.
    """

    def __init__(self, rules: Iterator[tuple[str, str]] | tuple = RULES):
        self.root: dict = {}
        for verdict, rule in rules:
            host, path = split_rule(rule)
            node = self.root
            for label in reversed(host.split(".")):
                node = node.setdefault("h", {}).setdefault(label, {})
            *whole, tail = path.split("/")
            for segment in whole:
                node = node.setdefault("p", {}).setdefault(segment, {})
            tails, lengths = node.setdefault("t", ({}, set()))
            tails[tail] = max(tails.get(tail, (rule, "")), (rule, verdict))
            lengths.add(len(tail))

    def match(self, host: str, path: str) -> tuple[str, str] | None:
        """(rule, verdict) of the longest rule that fits, the more specific host first."""
        node, best, size = self.root, None, (-1, -1)
        segments = path.split("/")
        for depth, label in enumerate(reversed(host.split("."))):
            node = node.get("h", {}).get(label)
            if node is None:
                break
            found = self._path(node, segments)
            if found:
                length, hit = found
                # the longest rule wins: every fitting host is a suffix of this one
                key = (len(hit[0]), depth)
                if key > size:
                    best, size = hit, key
        return best

    @staticmethod
    def _path(node: dict, segments: list[str]) -> tuple[int, tuple[str, str]] | None:
        best, length = None, 0
        for k, segment in enumerate(segments):
            tails, lengths = node.get("t", ({}, ()))
            fits = [n for n in lengths if n <= len(segment) and segment[:n] in tails]
            if fits:  # what is found in a later segment is longer
                best = (length + max(fits), tails[segment[: max(fits)]])
            if k == len(segments) - 1:
                break
            node = node.get("p", {}).get(segment)
            if node is None:
                break
            length += len(segment) + 1
        return best


def parts(pages: DataFrame) -> DataFrame:
    """``(page_id, host, path)``; both empty for a null url or one without ``://``."""
    url = F.coalesce(F.col("url").cast("string"), F.lit(""))
    host = F.translate(F.regexp_extract(url, HOST, 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return pages.select(F.col("page_id").cast("long").alias("page_id"), host.alias("host"), F.regexp_extract(url, HOST, 2).alias("path"))


def judge(pages: DataFrame, rules: tuple[tuple[str, str], ...] = RULES, default: str = DEFAULT_VERDICT, most: int = BROADCAST_RULES) -> DataFrame:
    """``(page_id, host, path, rule, verdict)`` of every row of ``pages(page_id, url)``.

    The longest fitting rule decides, of equally long ones that of the deeper host, else
    ``default`` with a null rule.  A rule that is listed with several verdicts has the
    largest by name, so it blocks.  Null urls have no host, so no rule fits.  Repeated
    rows each come back, other columns are ignored, an empty table gives none.
    """
    if len(rules) > most:
        spark = pages.sparkSession
        return judge_by_join(pages, spark.createDataFrame(list(rules), "verdict string, rule string"), default)
    held = pages.sparkSession.sparkContext.broadcast(Trie(rules))

    @F.pandas_udf("rule string, verdict string")
    def look(host: pd.Series, path: pd.Series) -> pd.DataFrame:
        match = held.value.match
        found = [match(h, p) or (None, default) for h, p in zip(host, path, strict=True)]
        return pd.DataFrame(found, columns=["rule", "verdict"])

    found = parts(pages).withColumn("found", look("host", "path"))
    return found.select("page_id", "host", "path", "found.rule", "found.verdict")


def judge_by_join(pages: DataFrame, rules: DataFrame, default: str = DEFAULT_VERDICT) -> DataFrame:
    """As ``judge`` for rule tables of any size: host suffixes and path beginnings meet
    rules in equal joins.

    ``rules(verdict, rule)``.  Distinct (host, path) pairs are judged once.  A pair has as
    many suffixes as its host has labels, and for each as many beginnings as that suffix's
    rules have lengths, so many rules of one host cost a url no more than their lengths.
    Pairs are dealt to ``SALTS`` copies of the rules, so one host may have most of them.
    """
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    parted = rules.select("verdict", "rule", F.split("rule", "/", 2)[0].alias("suffix"), F.regexp_extract("rule", r"(?s)^[^/]*(.*)$", 1).alias("begin"))
    listed = parted.groupBy("suffix", "begin").agg(F.max("rule").alias("rule"), F.max("verdict").alias("verdict"))
    lengths = listed.groupBy("suffix").agg(F.collect_set(F.length("begin")).alias("lengths")).select("*", salts)
    own = parts(pages)
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."))
    keys = own.select("host", "path").distinct().withColumn("salt", F.pmod(F.xxhash64("host", "path"), F.lit(SALTS)).cast("int"))
    beginnings = F.transform(F.filter("lengths", lambda n: n <= F.length("path")), lambda n: F.substring(F.col("path"), F.lit(1), n))
    asked = keys.withColumn("suffix", F.explode(suffixes)).join(lengths, ["suffix", "salt"]).withColumn("begin", F.explode(beginnings)).drop("lengths")
    hits = asked.join(listed.select("*", salts), ["suffix", "begin", "salt"])
    best = hits.groupBy("host", "path").agg(F.max(F.struct(F.length("rule").alias("n"), F.length("suffix").alias("m"), "rule", "verdict")).alias("x"))
    return own.join(best, ["host", "path"], "left").select("page_id", "host", "path", F.col("x.rule").alias("rule"), F.coalesce("x.verdict", F.lit(default)).alias("verdict"))


def op4_url_filter(spark, sf_dir: str) -> DataFrame:
    """Verdicts on all pages."""
    return judge(spark.read.parquet(f"{sf_dir}/pages.parquet"))


OP4_SQL = """
with u as (select page_id, regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', ['h', 'p']) as x from pages),
p as (select page_id, translate(x['h'], 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host, x['p'] as path from u),
r(verdict, rule, rhost, rpath) as (values ('allow', 'com/', 'com', '/'), ('block', 'example.com/en/', 'example.com', '/en/'),
  ('allow', 'www.example.com/en/', 'www.example.com', '/en/'), ('block', 'net/es/', 'net', '/es/'), ('block', 'net/fr/', 'net', '/fr/')),
h as (select page_id, arg_max(rule, length(rule)) as rule, arg_max(verdict, length(rule)) as verdict
      from p join r on (host = rhost or ends_with(host, '.' || rhost)) and starts_with(path, rpath) group by page_id)
select p.page_id, host, path, h.rule, coalesce(h.verdict, 'allow') as verdict from p left join h using (page_id)
"""
