"""Block and allow lists for URLs: a trie over reversed host labels and path segments.

The trie is built from the list on the driver and sent to the tasks; ``build`` refuses a list of more than ``MOST_RULES`` entries.
A URL's host labels are walked from the right, so one walk meets every rule on the host and the domains above it; at each of these
the path's segments are walked.  The rule with the longest host wins, then the one with the longest path; of two entries for the same
place the block wins.

Defined results: a null URL and one without ``://`` have an empty host and path and no rule, and the verdict is the default.  A host
keeps user names and ports as they stand.  Repeated rows give repeated results.
"""

from __future__ import annotations

from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame

from remitlens.llm.support import ship

ALLOW, BLOCK = "allow", "block"
#: About 100 bytes each in every worker.
MOST_RULES = 1_000_000
HOSTS_REMEMBERED = 100_000

JUDGED = "page_id long, host string, path string, rule string, verdict string"

_LOWER = {65 + k: 97 + k for k in range(26)}


def split_url(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path."""
    rest = "" if url is None else url.partition("://")[2]
    if not rest:
        return "", ""
    stop = min((k for c in "?#" if (k := rest.find(c)) >= 0), default=len(rest))
    slash = rest.find("/", 0, stop)
    if slash < 0:
        return rest[:stop].translate(_LOWER), ""
    return rest[:slash].translate(_LOWER), rest[slash:stop]


def build(rules: Iterable[tuple[str, str, str]]) -> dict:
    """The trie of (verdict, host, path) rules.

    A node is a dict from host label to node; under the key None it holds the path trie of its host: a dict from whole segment to
    node, whose key None holds the unfinished last segments that end there, as a dict from prefix to (rule, verdict).
    """
    top: dict = {}
    for count, (verdict, host, path) in enumerate(rules):
        if count >= MOST_RULES:
            raise ValueError("too many rules to send to every task")
        node = top
        for label in reversed(host.lower().split(".")):
            node = node.setdefault(label, {})
        node = node.setdefault(None, {})
        *whole, last = path.split("/")
        for segment in whole:
            node = node.setdefault(segment, {})
        ends = node.setdefault(None, {})
        if last not in ends or verdict == BLOCK:
            ends[last] = (host + path, verdict)
    return top


def path_tries(trie: dict, host: str) -> list[dict]:
    """The path tries of the host and the domains above it that have rules, longest host first."""
    found, node = [], trie
    for label in reversed(host.split(".")):
        node = node.get(label)
        if node is None:
            break
        if None in node:
            found.append(node[None])
    return found[::-1]


def longest_path(trie: dict, path: str) -> tuple[str, str] | None:
    """The rule of a path trie with the longest path that ``path`` starts with."""
    best, node = None, trie
    for segment in path.split("/"):
        ends = node.get(None)
        if ends:
            fit = max((p for p in ends if segment.startswith(p)), key=len, default=None)
            if fit is not None:
                best = ends[fit]
        node = node.get(segment)
        if node is None:
            break
    return best


def match(trie: dict, host: str, path: str) -> tuple[str, str] | None:
    for tries in path_tries(trie, host):
        if found := longest_path(tries, path):
            return found
    return None


def judged(pages: DataFrame, rules: Iterable[tuple[str, str, str]], default: str = ALLOW) -> DataFrame:
    """Per row of ``pages`` (page_id, url): host, path, the rule that fits (null: none) and the verdict."""
    ship(pages.sparkSession)
    sent = pages.sparkSession.sparkContext.broadcast(build(rules))

    def run(batches):
        trie, hosts = sent.value, {}
        for batch in batches:
            host, path, rule, verdict = [], [], [], []
            for url in batch.column(1).to_pylist():
                h, p = split_url(url)
                if h not in hosts:
                    if len(hosts) >= HOSTS_REMEMBERED:
                        hosts.clear()
                    hosts[h] = path_tries(trie, h)
                found = next((f for t in hosts[h] if (f := longest_path(t, p))), None)
                host.append(h)
                path.append(p)
                rule.append(found[0] if found else None)
                verdict.append(found[1] if found else default)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(x, pa.string()) for x in (host, path, rule, verdict))], ["page_id", "host", "path", "rule", "verdict"])

    return pages.select("page_id", "url").mapInArrow(run, JUDGED)


#: DuckDB's statement of the contract, for the rules of the query.
SQL = """
WITH parts AS (
  SELECT page_id, CASE WHEN contains(coalesce(url, ''), '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), cut AS (
  SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS raw_host, rest FROM parts
), split AS (
  SELECT page_id, translate(raw_host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(substr(rest, length(raw_host) + 1), '^[^?#]*') AS path FROM cut
), rules(host, path, verdict) AS (
  VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
), fit AS (
  SELECT s.page_id, arg_max(r.host || r.path, length(r.host) * 10000 + length(r.path)) AS rule, arg_max(r.verdict, length(r.host) * 10000 + length(r.path)) AS verdict
  FROM split s JOIN rules r ON (s.host = r.host OR s.host LIKE '%.' || r.host) AND starts_with(s.path, r.path)
  GROUP BY s.page_id
)
SELECT s.page_id, s.host, s.path, f.rule, coalesce(f.verdict, 'allow') AS verdict FROM split s LEFT JOIN fit f ON f.page_id = s.page_id
"""
