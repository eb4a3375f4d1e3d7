"""Operator 8: URL filters by a trie over reversed host labels, then path prefixes."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import query, table
from .text import column

# (verdict, host, path) of the rules that the registered query applies.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
# Bound for the trie, which every task gets; longer lists have to be split by host.
MAX_RULE_BYTES = 64 << 20


class Trie:
    """Rules under their host's labels, from the last label to the first.

    A node of labels holds a second trie with the paths of its rules by segments; the last segment
    of a rule may end within a segment of a path, so it is kept with its node as a prefix.
    """

    def __init__(self, rules: Sequence[tuple[str, str, str]]):
        self.root: dict = {}
        for verdict, host, path in rules:
            node = self.root
            for label in reversed(host.split(".")):
                node = node.setdefault("labels", {}).setdefault(label, {})
            place = node.setdefault("paths", {})
            *whole, last = path.split("/")
            for segment in whole:
                place = place.setdefault("segments", {}).setdefault(segment, {})
            ends = place.setdefault("ends", {})
            place["longest"] = max(place.get("longest", 0), len(last))
            # Of two rules for the same place, the blocking one holds.
            if ends.get(last, ("", ""))[1] != "block":
                ends[last] = (host + path, verdict)

    @staticmethod
    def _longest_path(place: dict, path: str) -> tuple[str, str] | None:
        found = None
        segments = path.split("/")
        for i, segment in enumerate(segments):
            ends = place.get("ends")
            if ends:  # a rule's last part may end within this segment
                for length in range(min(len(segment), place["longest"]), -1, -1):
                    if segment[:length] in ends:
                        found = ends[segment[:length]]
                        break
            place = place.get("segments", {}).get(segment) if i + 1 < len(segments) else None
            if place is None:
                return found
        return found

    def find(self, host: str, path: str) -> tuple[str | None, str | None]:
        """(rule, verdict) of the rule with the most host labels, then the longest path."""
        node, best = self.root, None
        for label in reversed(host.split(".")):
            node = node.get("labels", {}).get(label)
            if node is None:
                break
            if "paths" in node:
                best = self._longest_path(node["paths"], path) or best
        return best if best else (None, None)


def parts(url):
    """Columns for the host and the path of a url; both are empty where it is null or has no `://`."""
    url = F.coalesce(url.cast("string"), F.lit(""))
    rest = F.substring_index(url, "://", 1)
    rest = F.when(F.instr(url, "://") > 0, url.substr(F.length(rest) + 4, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest.substr(F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.translate(host, upper, lower), path


def judge(
    pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, page_id: str = "page_id", url: str = "url",
    otherwise: str = "allow",
) -> DataFrame:
    """One row per page: id, host, path, rule, verdict.

    A rule fits its host and that host's subdomains where the url's path starts with the rule's
    path. The rule with the most host labels wins, of these the one with the longest path; of an
    allowing and a blocking entry for one place the blocking one. Urls without a rule (null and
    malformed ones too) get `otherwise`. Rows with the same id are judged one by one.
    """
    if sum(len(h) + len(p) for _, h, p in rules) > MAX_RULE_BYTES:
        raise ValueError("the rules are too many to send to every task")
    trie = pages.sparkSession.sparkContext.broadcast(Trie(rules))
    host, path = parts(pages[url])
    id_type = pages.schema[page_id].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = trie.value.find
        for batch in batches:
            hits = [find(h, p) for h, p in zip(column(batch, "host").to_pylist(), column(batch, "path").to_pylist())]
            rule = pa.array([r for r, _ in hits], type=pa.string())
            verdict = pa.array([v or otherwise for _, v in hits], type=pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, rule, verdict], names=[page_id, "host", "path", "rule", "verdict"])

    rows = pages.select(pages[page_id].alias("id"), host.alias("host"), path.alias("path"))
    return rows.mapInArrow(work, f"`{page_id}` {id_type}, host string, path string, rule string, verdict string")


_ORACLE = """
WITH rules(verdict, host, path) AS (VALUES
  ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
  ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
cut AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
named AS (
  SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS h, rest FROM cut),
split AS (
  SELECT row_number() OVER () AS r, page_id,
    translate(h, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(substr(rest, length(h) + 1), '^[^?#]*') AS path
  FROM named),
fits AS (
  SELECT s.r, u.host || u.path AS rule, u.verdict,
    row_number() OVER (PARTITION BY s.r ORDER BY length(u.host) DESC, length(u.path) DESC) AS place
  FROM split s JOIN rules u
    ON (s.host = u.host OR ends_with(s.host, '.' || u.host)) AND starts_with(s.path, u.path))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM split LEFT JOIN (SELECT * FROM fits WHERE place = 1) f USING (r)
"""


@query("op8_url_filters", _ORACLE)
def op8(spark, folder):
    """Every page's url, judged by the fixed rules."""
    return judge(table(spark, folder, "pages"))
