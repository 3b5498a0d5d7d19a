"""URL filters (2): a trie over reversed host labels and path segments, broadcast.

A rule is (host, path, verdict). It fits its host and all subdomains if the url's path starts with the
rule's. A walk goes from the top-level label down and, at every host node that has rules, along the path's
segments. Among the rules that fit, the one of most characters (host and path) wins, then the one of the
longer host, then block before allow.

The trie's size is bounded: beyond ``RULE_CHARS`` characters the rules are dealt over several tries, and
the pages pass through them one after the other as further map steps, the best match riding along.

Defined cases: a null url or one without ``://`` has empty host and path and fits no rule; urls that fit no
rule get the ``default`` verdict (allow: a filter blocks what is listed); no rules: all get it; repeated
rows are judged one by one; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: (host, path, verdict): the rules of the registered query.
RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
         ("net", "/es/", "block"), ("net", "/fr/", "block")]
#: Characters of rules in one trie; about 100 bytes of memory each at most.
RULE_CHARS = 2_000_000
_AZ = {c: c + 32 for c in range(65, 91)}


def split_url(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path of a url."""
    at = -1 if url is None else url.find("://")
    if at < 0:
        return "", ""
    rest = url[at + 3:]
    end = re.search("[/?#]", rest)
    host, rest = (rest[:end.start()], rest[end.start():]) if end else (rest, "")
    return host.translate(_AZ), re.split("[?#]", rest, maxsplit=1)[0]


class Trie:
    """Node: [children by host label, path node or None]; path node: [children by segment, ends].

    An end is (what the next segment must start with, characters, host characters, verdict, rule).
    """

    def __init__(self, rules: Iterable[tuple[str, str, str]]):
        self.root: list = [{}, None]
        for host, path, verdict in rules:
            host, node = host.translate(_AZ), self.root
            for label in reversed(host.split(".")) if host else ():
                node = node[0].setdefault(label, [{}, None])
            node[1] = node[1] or [{}, []]
            parts, at = path.split("/"), node[1]
            for segment in parts[:-1]:
                at = at[0].setdefault(segment, [{}, []])
            at[1].append((parts[-1], len(host) + len(path), len(host), verdict == "block", host + path))

    def longest(self, host: str, path: str) -> tuple | None:
        """The winning end for a url, without what the next segment must start with."""
        best, node, parts = None, self.root, path.split("/")
        for label in [None, *reversed(host.split("."))] if host else []:
            if label is not None:
                node = node[0].get(label)
                if node is None:
                    break
            at = node[1]
            for segment in parts:
                if at is None:
                    break
                for start, *end in at[1]:
                    if segment.startswith(start) and (best is None or end > best):
                        best = end
                at = at[0].get(segment)
        return best


def _judge(shared, first: bool):
    state = pa.struct([("size", pa.int32()), ("host", pa.int32()), ("block", pa.bool_()), ("rule", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = Trie([])
        trie.root = shared.value
        for b in batches:
            got = [split_url(u) for u in b.column("url").to_pylist()]
            olds = [None] * len(got) if first else b.column("best").to_pylist()
            out = []
            for (host, path), old in zip(got, olds):
                new = trie.longest(host, path)
                old = list(old.values()) if old else None
                win = max(new, old) if new and old else new or old
                out.append(dict(zip(("size", "host", "block", "rule"), win)) if win else None)
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), b.column("url"), pa.array([h for h, _ in got], pa.string()),
                 pa.array([p for _, p in got], pa.string()), pa.array(out, state)],
                names=["id", "url", "host", "path", "best"])
    return run


def parts_of(rules: list[tuple[str, str, str]], limit: int) -> list[list[tuple[str, str, str]]]:
    parts: list[list[tuple[str, str, str]]] = [[]]
    held = 0
    for rule in rules:
        if held > limit:
            parts.append([])
            held = 0
        parts[-1].append(rule)
        held += len(rule[0]) + len(rule[1])
    return parts


def url_filter(pages: DataFrame, rules: list[tuple[str, str, str]], id_col: str = "page_id", url_col: str = "url",
               default: str = "allow", limit: int = RULE_CHARS) -> DataFrame:
    """One row per row of ``pages``: ``page_id, host, path, rule, verdict``."""
    rows = pages.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{url_col}`").alias("url"))
    kind = rows.schema["id"].dataType.simpleString()
    schema = f"id {kind}, url string, host string, path string, best struct<size:int,host:int,block:boolean,rule:string>"
    for k, part in enumerate(parts_of(rules, limit)):
        shared = pages.sparkSession.sparkContext.broadcast(Trie(part).root)
        rows = rows.mapInArrow(_judge(shared, k == 0), schema)
    verdict = F.when(F.col("best").isNull(), F.lit(default)).when(F.col("best.block"), "block").otherwise("allow")
    return rows.select(F.col("id").alias(id_col), "host", "path", F.col("best.rule").alias("rule"), verdict.alias("verdict"))


def op2_url_filter(spark, sf_dir: str) -> DataFrame:
    from .common import table
    return url_filter(table(spark, sf_dir, "pages"), RULES)


SQL = """
WITH u AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r FROM pages),
s AS (SELECT page_id, translate(regexp_extract(r, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(substr(r, length(regexp_extract(r, '^[^/?#]*')) + 1), '^[^?#]*') AS path FROM u),
rule(h, p, verdict) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
                               ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
fit AS (SELECT page_id, host, path, max_by(struct_pack(r := h || p, v := verdict), length(h || p)) AS best
        FROM s JOIN rule ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY ALL)
SELECT s.page_id, s.host, s.path, best.r AS rule, coalesce(best.v, 'allow') AS verdict
FROM s LEFT JOIN fit ON s.page_id = fit.page_id AND s.host = fit.host AND s.path = fit.path
"""
