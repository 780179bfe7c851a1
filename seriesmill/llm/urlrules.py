"""URL rules by a sort-merge range join.

A host's labels in reverse order, each closed by a low sign, make a key in which a host and
all its subdomains are one interval that starts at the host's key; intervals nest or are
disjoint.  URLs and rules are dealt to ranges of keys and sorted together; a sweep keeps a
stack of the rules whose interval is open, innermost last, and each URL takes the longest rule
on the stack whose path its own path starts with.

Ranges come from a sample of the URLs' keys, which decides how even the work is and nothing
else.  A rule goes to every range its interval touches, so no range depends on another; a hot
host is cut by path and id into several ranges.

Defined results
    host and path follow the first `://` (else both are empty); a rule without host fits no
    url; of rules equally long the deeper host wins, then block; no rule: ``default``; null
    rule fields count as empty; repeated rows are judged each; rules and tables may be empty.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

CLOSE, AFTER = "\x01", "\x02"
#: URLs per range and sampled keys per range.
RANGE_ROWS, SAMPLED = 50_000, 40
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def key_of(host: str) -> str:
    return "".join(label + CLOSE for label in reversed(host.split("."))) if host else ""


def fits(rule_host: str, host: str) -> bool:
    return bool(rule_host) and (host == rule_host or host.endswith("." + rule_host))


class Stack:
    """Open rule hosts, outermost first; each with its paths."""

    def __init__(self):
        self.open: list[tuple[str, str, dict[str, str], list[int]]] = []

    def close(self, key: str) -> None:
        """Drop the intervals that end before ``key``."""
        while self.open and not key.startswith(self.open[-1][0]):
            self.open.pop()

    def add(self, key: str, host: str, path: str, verdict: str) -> None:
        self.close(key)
        if not self.open or self.open[-1][0] != key or self.open[-1][1] != host:
            self.open.append((key, host, {}, []))
        paths, sizes = self.open[-1][2], self.open[-1][3]
        if path not in paths or verdict == "block":
            paths[path] = verdict
        if len(path) not in sizes:
            sizes.append(len(path))
            sizes.sort(reverse=True)

    def longest(self, key: str, host: str, path: str) -> tuple[str, str] | None:
        self.close(key)
        best, found = -1, None
        for _, rule_host, paths, sizes in reversed(self.open):
            if fits(rule_host, host):
                for n in sizes:
                    if len(rule_host) + n <= best:
                        break
                    if n <= len(path) and path[:n] in paths:
                        best, found = len(rule_host) + n, (rule_host + path[:n], paths[path[:n]])
                        break
        return found


def judged(urls: DataFrame, rules: DataFrame, page_id: str = "page_id", url: str = "url", default: str = "allow") -> DataFrame:
    """``page_id, host, path, rule, verdict`` per row; ``rules`` has ``host, path, verdict``."""
    rows = urls.select(F.col(page_id).cast("bigint").alias("page_id"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    total = rows.count()
    ranges = max(1, -(-total // RANGE_ROWS), rows.sparkSession.sparkContext.defaultParallelism)
    share = min(1.0, SAMPLED * ranges / max(total, 1))
    # at most a few dozen keys per range reach the driver
    sample = sorted((key_of(r["host"]) + r["path"], r["spread"]) for r in rows.withColumn(
        "spread", F.xxhash64("page_id")).where(F.abs(F.hash("page_id", "path", F.lit(8)) % 1_000_000) < share * 1_000_000).select(
        "host", "path", "spread").collect())
    bounds = sorted({sample[len(sample) * k // ranges] for k in range(1, ranges)}) if sample else []

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keys = [key_of(h) + p for h, p in zip(batch["host"], batch["path"])]
            yield batch.assign(range=[bisect_right(bounds, k) for k in zip(keys, batch["spread"])], key=keys, kind=1, verdict="").drop(
                columns="spread")

    def copies(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for host, path, verdict in zip(batch["host"], batch["path"], batch["verdict"]):
                if host:
                    key = key_of(host)
                    first, last = bisect_right(bounds, (key, -1 << 63)), bisect_right(bounds, (key[:-1] + AFTER, 1 << 63))
                    out += [(host, path, k, key, verdict) for k in range(first, last + 1)]
            found = pd.DataFrame(out, columns=["host", "path", "range", "key", "verdict"])
            yield found.assign(page_id=pd.array([None] * len(found), dtype="Int64"), kind=0)

    schema = "page_id bigint, host string, path string, range int, key string, kind int, verdict string"
    placed = rows.withColumn("spread", F.xxhash64("page_id")).mapInPandas(place, schema)
    marked = rules.select(F.coalesce(F.translate("host", UPPER, LOWER), F.lit("")).alias("host"),
                          F.coalesce("path", F.lit("")).alias("path"), "verdict").mapInPandas(copies, schema)
    swept = placed.unionByName(marked).repartition(ranges, "range").sortWithinPartitions("range", "key", "kind", "host", "path")

    def sweep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        stack, at = Stack(), None
        for batch in batches:
            out = []
            for page, host, path, which, key, kind, verdict in batch[
                    ["page_id", "host", "path", "range", "key", "kind", "verdict"]].itertuples(index=False, name=None):
                if which != at:
                    stack, at = Stack(), which
                if kind == 0:
                    stack.add(key, host, path, verdict)
                else:
                    rule = stack.longest(key, host, path)
                    out.append((page, host, path, *(rule or (None, default))))
            found = pd.DataFrame(out, columns=["page_id", "host", "path", "rule", "verdict"])
            yield found.astype({"page_id": "Int64", "rule": "object"})

    return swept.mapInPandas(sweep, "page_id bigint, host string, path string, rule string, verdict string")
