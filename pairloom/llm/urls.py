"""URL filters with a sorted digest array.

Rules such as ``example.net/en/`` are kept as 64-bit xxhash digests in a sorted array, beside the rules themselves.
Both are files that Spark hands to every executor once; its workers map them into memory together. A URL asks for
each of its domains with each length of path that a rule has: one vectorised binary search for a whole batch. A
digest that is found is confirmed on the stored rule, so a collision changes nothing.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.llm.shared import stored

# Fixed values of the contract.
RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]
OTHERWISE = "allow"

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ENTRY = np.dtype([("digest", "<u8"), ("begin", "<i8"), ("end", "<i8"), ("block", "?")])
OUT_DDL = "page_id long, host string, path string, rule string, verdict string"


def digest(rule: str) -> int:
    return xxhash.xxh64_intdigest(rule.encode())


def compiled(rules: list[tuple[str, str]]) -> tuple[bytes, bytes]:
    """The array, sorted by digest, and the rules' text. Of a rule that is given twice the last verdict holds."""
    known = dict(rules)
    ordered = sorted(known, key=lambda r: (digest(r), r))
    texts = [r.encode() for r in ordered]
    ends = np.cumsum([len(t) for t in texts], dtype=np.int64)
    table = np.zeros(len(ordered), dtype=ENTRY)
    table["digest"] = [digest(r) for r in ordered]
    table["begin"], table["end"] = ends - [len(t) for t in texts], ends
    table["block"] = [known[r] == "block" for r in ordered]
    return table.tobytes(), b"".join(texts)


@dataclass
class RuleArray:
    table: np.ndarray
    texts: np.ndarray
    path_lengths: list[int]

    @classmethod
    def opened(cls, table_file: str, texts_file: str, path_lengths: list[int]) -> RuleArray:
        return cls(np.memmap(table_file, dtype=ENTRY, mode="r"), np.memmap(texts_file, np.uint8, "r"), path_lengths)

    def found(self, asked: list[str]) -> list[int]:
        """For each string, the index of the rule that is that string, or -1."""
        keys = np.array([digest(x) for x in asked], dtype=np.uint64)
        low = np.searchsorted(self.table["digest"], keys, "left")
        high = np.searchsorted(self.table["digest"], keys, "right")
        out = [-1] * len(asked)
        for i in np.flatnonzero(high > low):
            for at in range(low[i], high[i]):  # more than one only where digests collide
                entry = self.table[at]
                if self.texts[entry["begin"] : entry["end"]].tobytes() == asked[i].encode():
                    out[i] = at
        return out

    def longest(self, hosts: list[str], paths: list[str]) -> list[tuple[str | None, bool]]:
        """For each URL the longest rule that fits, the one with the longer host among equals, and its verdict."""
        asked: list[str] = []
        owner: list[int] = []
        for i, (host, path) in enumerate(zip(hosts, paths)):
            starts = [0, *(at + 1 for at, c in enumerate(host) if c == ".")] if host else []
            lengths = [n for n in self.path_lengths if n <= len(path)]
            for at in starts:
                for n in lengths:
                    asked.append(host[at:] + path[:n])
                    owner.append(i)
        out: list[tuple[str | None, bool]] = [(None, False)] * len(hosts)
        for i, text, at in zip(owner, asked, self.found(asked)):
            if at >= 0 and len(text) > len(out[i][0] or ""):  # domains come from the longest
                out[i] = (text, bool(self.table[at]["block"]))
        return out


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Both empty for null and for URLs without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.char_length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.char_length(host) + 1, F.char_length(rest)), "^[^?#]*", 0)
    return F.translate(host, UPPER, LOWER), path


def filtered(pages: DataFrame, rules: list[tuple[str, str]], otherwise: str = OTHERWISE) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule`` and ``verdict`` of every row of ``pages``.

    A rule (host, then path from its first slash) fits its host and all subdomains if the URL's path starts with the
    rule's; the longest decides. ``otherwise`` holds where none fits, and for null or malformed URLs, whose host and
    path are empty. The rules are an argument, so they fit the driver; tasks only map them. Repeated rows stay; an
    empty table gives no rows, an empty list of rules ``otherwise`` for all; other columns are not read.
    """
    if any("/" not in rule for rule, _ in rules):
        raise ValueError("a rule is a host and a path that begins with a slash")
    spark = pages.sparkSession
    table, texts = compiled(rules)
    lengths = sorted({len(rule) - rule.index("/") for rule, _ in rules})
    mark = hashlib.sha256(table + texts).hexdigest()[:24]
    names = [f"rules-{mark}.digests", f"rules-{mark}.texts"]
    for name, data in zip(names, (table, texts)):
        spark.sparkContext.addFile(stored(spark, name, data))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        array = RuleArray.opened(*map(SparkFiles.get, names), lengths) if table else None
        for batch in batches:
            hosts, paths = batch.column("host").to_pylist(), batch.column("path").to_pylist()
            best = array.longest(hosts, paths) if array else [(None, False)] * len(hosts)
            verdicts = [otherwise if rule is None else "block" if block else "allow" for rule, block in best]
            yield pa.record_batch(
                [
                    *(batch.column(c) for c in ("page_id", "host", "path")),
                    pa.array([rule for rule, _ in best], pa.string()),
                    pa.array(verdicts, pa.string()),
                ],
                names=["page_id", "host", "path", "rule", "verdict"],
            )

    host, path = host_and_path(F.col("url"))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), host.alias("host"), path.alias("path"))
    return rows.mapInArrow(run, OUT_DDL)


ORACLE_SQL = """
WITH rest AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r FROM pages
),
parts AS (
  SELECT page_id, regexp_extract(r, '^[^/?#]*') AS raw, substr(r, length(regexp_extract(r, '^[^/?#]*')) + 1) AS tail
  FROM rest
),
named AS (
  SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(tail, '^[^?#]*') AS path FROM parts
),
ruled AS (
  SELECT page_id, host, path, CASE
    WHEN (host = 'example.net' OR host LIKE '%.example.net') AND path LIKE '/en/%' THEN 'example.net/en/'
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/de/%' THEN 'example.com/de/'
    WHEN (host = 'org' OR host LIKE '%.org') AND path LIKE '/fr/%' THEN 'org/fr/'
    WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/%' THEN 'net/'
  END AS rule FROM named
)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict
FROM ruled
"""
