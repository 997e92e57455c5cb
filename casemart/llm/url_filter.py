"""URL allow/block lists as a broadcast trie.

The trie runs over the reversed host labels (``net``, ``example``, ...) and
then over the complete path segments of a rule.  A rule that ends inside a
segment stands at its node under the text it ends with; a lookup tries one
slice of the url's segment per distinct length there, the longest first, so
its cost does not grow with the rules of a node.  A lookup walks down the
labels of the url's host once and, at every node that carries path rules, down
its path segments; the deepest rule that fits is the verdict.  A longer host
beats a shorter one and, for the same host, a longer path a shorter one.  Of
rules with the same host and path ``block`` beats every other verdict, else
the smallest verdict stays, whatever the order of the list.

Rules are a configuration list: ``UrlTrie`` refuses more than ``MAX_RULES``,
so the broadcast has a proven size bound.

Edge cases: a null url or one without ``://`` has empty host and path, fits no
rule and gets the default verdict.  Ports and user names are part of the host,
as in the definition.  An empty table gives an empty result; extra columns are
ignored; repeated rows are judged one by one.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casemart.llm.common import ORACLE, field_type, query, read

MAX_RULES = 1_000_000
_LOWER = {c: c + 32 for c in range(65, 91)}


@dataclass(frozen=True)
class Rule:
    verdict: str            # "allow" or "block"
    host: str
    path: str = "/"

    @property
    def label(self) -> str:
        return self.host + self.path


@dataclass
class _Node:
    children: dict[str, _Node] = field(default_factory=dict)
    rule: Rule | None = None                                    # ends exactly here
    partial: dict[str, Rule] = field(default_factory=dict)      # path ends inside the next segment
    lengths: list[int] = field(default_factory=list)            # of those ends, the longest first
    paths: _Node | None = None                                  # path trie of a host node


def _stronger(old: Rule | None, new: Rule) -> Rule:
    """The rule that stays where two have the same host and path."""
    return new if old is None else min(old, new, key=lambda r: (r.verdict != "block", r.verdict))


class UrlTrie:
    def __init__(self, rules: Sequence[Rule]):
        if len(rules) > MAX_RULES:
            raise ValueError(f"more than {MAX_RULES} rules: the trie is broadcast")
        self.root = _Node()
        for r in rules:
            node = self.root
            for label in reversed(r.host.translate(_LOWER).split(".")):
                node = node.children.setdefault(label, _Node())
            node.paths = node.paths or _Node()
            *whole, rest = r.path.split("/")
            node = node.paths
            for segment in whole:
                node = node.children.setdefault(segment, _Node())
            if rest:
                node.partial[rest] = _stronger(node.partial.get(rest), r)
                if len(rest) not in node.lengths:
                    node.lengths = sorted([*node.lengths, len(rest)], reverse=True)
            else:
                node.rule = _stronger(node.rule, r)

    def find(self, host: str, path: str) -> Rule | None:
        """The rule with the longest host, then the longest path, that fits."""
        best, node = None, self.root
        for label in reversed(host.split(".")) if host else ():
            node = node.children.get(label)
            if node is None:
                break
            if node.paths is not None:
                best = self._by_path(node.paths, path) or best
        return best

    @staticmethod
    def _by_path(node: _Node, path: str) -> Rule | None:
        best, at = node.rule, 0
        while True:
            slash = path.find("/", at)
            left = (len(path) if slash < 0 else slash) - at
            for n in node.lengths:
                hit = node.partial.get(path[at:at + n]) if n <= left else None
                if hit:
                    best = hit
                    break
            if slash < 0:
                return best
            node = node.children.get(path[at:slash])
            if node is None:
                return best
            best, at = node.rule or best, slash + 1


def judge_urls(df: DataFrame, rules: Sequence[Rule], id_col: str = "page_id", url_col: str = "url",
               default: str = "allow") -> DataFrame:
    """``(id, host, path, rule, verdict)`` of every row."""
    trie = df.sparkSession.sparkContext.broadcast(UrlTrie(rules))
    url = F.col(f"`{url_col}`")
    after = F.instr(url, "://")
    rest = F.when(after > 0, F.substring(url, after + 3, F.length(url)))
    host = F.coalesce(F.regexp_extract(rest, r"(?s)\A[^/?#]*", 0), F.lit(""))
    path = F.coalesce(F.regexp_extract(rest, r"(?s)\A[^/?#]*([^?#]*)", 1), F.lit(""))
    host = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = trie.value.find
        for b in batches:
            hits = [find(h, p) for h, p in zip(b.column(1).to_pylist(), b.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), b.column(2), pa.array([r and r.label for r in hits], pa.string()),
                 pa.array([r.verdict if r else default for r in hits], pa.string())],
                names=[id_col, "host", "path", "rule", "verdict"])

    return (df.select(F.col(f"`{id_col}`"), host.alias("host"), path.alias("path"))
            .mapInArrow(judge, f"`{id_col}` {field_type(df, id_col)}, host string, path string, rule string, verdict string"))


#: The rules that the query is asked to apply.
QUERY_RULES = (Rule("block", "net"), Rule("allow", "example.net", "/en/"), Rule("block", "example.com", "/de/"),
               Rule("allow", "org", "/fr/"))


@query("op8_url_filter")
def op8_url_filter(spark, sf_dir):
    return judge_urls(read(spark, sf_dir, "pages"), QUERY_RULES)


ORACLE["op8_url_filter"] = r"""
WITH cut AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
rules(verdict, rhost, rpath) AS (
  VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
ranked AS (
  SELECT p.page_id, p.host, p.path, rhost || rpath AS rule, verdict,
         row_number() OVER (PARTITION BY p.page_id, p.host, p.path ORDER BY length(rhost) DESC, length(rpath) DESC) AS rk
  FROM parts p JOIN rules ON (p.host = rhost OR ends_with(p.host, '.' || rhost)) AND starts_with(p.path, rpath))
SELECT p.page_id, p.host, p.path, r.rule, coalesce(r.verdict, 'allow') AS verdict
FROM parts p LEFT JOIN ranked r ON r.page_id = p.page_id AND r.host = p.host AND r.path = p.path AND r.rk = 1
"""
