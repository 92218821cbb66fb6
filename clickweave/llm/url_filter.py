"""URL filter: rules in a sorted array of 64-bit xxhash keys that every task maps into memory.

A rule is ``host/path``: it fits its host and all subdomains when the path of the url starts with the
rule's path. The longest fitting rule decides (of equally long ones that with the longer host); without
one, the filter's default does.

The array is one file: sorted keys, offsets, verdicts and the rules' full strings. It is written to the
shared folder and given to the executors by Spark's own file distribution; a task maps it and touches only
the pages it probes. A url asks for each suffix of its host that begins at a label and has the length of
some rule's host, with each path prefix that has the length of some rule's path. All keys of a batch are
searched at once, and every hit is confirmed against the stored string, so equal keys of different strings
never matter.

Null urls and urls without ``://`` have an empty host and path, which no rule fits. Empty rules and rules
without a host are refused. Of a rule given twice the last verdict holds. Other columns of the pages are
not read; repeated rows are judged one by one.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from clickweave.llm.common import ascii_lower
from clickweave.workspace import fresh_dir

_MAGIC = b"CWURLS01"
_HEAD = struct.Struct("<8sQQQQ")  # magic, rules, bytes of strings, host lengths, path lengths
VERDICTS = ("allow", "block")


def host_of(url: Column) -> Column:
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return ascii_lower(found)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_parts(rule: str) -> tuple[str, str]:
    host, slash, path = rule.partition("/")
    if not host:
        raise ValueError(f"a rule needs a host: {rule!r}")
    return host.translate({c: c + 32 for c in range(65, 91)}), slash + path


def packed(rules: Sequence[tuple[str, str]], key=lambda s: xxhash.xxh64_intdigest(s)) -> bytes:
    """The index file of (verdict, rule) pairs. ``key`` is a parameter so that tests can force collisions."""
    last = {}
    for verdict, rule in rules:
        host, path = rule_parts(rule)
        last[host + path] = (VERDICTS.index(verdict), len(host), len(path))
    entries = sorted((key(name), name, *what) for name, what in last.items())
    names = [e[1].encode() for e in entries]
    keys = np.array([e[0] for e in entries], "<u8")
    ends = np.cumsum([0, *map(len, names)]).astype("<u8")
    hosts, paths = (np.array(sorted({e[i] for e in entries}), "<u8") for i in (3, 4))
    blob = b"".join(names)
    head = _HEAD.pack(_MAGIC, len(names), len(blob), len(hosts), len(paths))
    verdicts, cuts = np.array([e[2] for e in entries], "u1"), np.array([e[3] for e in entries], "<u8")
    return b"".join([head, keys.tobytes(), ends.tobytes(), cuts.tobytes(), hosts.tobytes(), paths.tobytes(), verdicts.tobytes(), blob])


class Mapped:
    """The index as views of a mapped file."""

    def __init__(self, path: str, key=lambda s: xxhash.xxh64_intdigest(s)):
        self.key = key
        raw = np.memmap(path, dtype="u1", mode="r")
        magic, n, blob, hosts, paths = _HEAD.unpack(raw[: _HEAD.size].tobytes())
        if magic != _MAGIC:
            raise ValueError(f"{path} is no rule index")
        at = _HEAD.size

        def view(count: int, kind: str):
            nonlocal at
            size = count * np.dtype(kind).itemsize
            at += size
            return raw[at - size : at].view(kind)

        self.keys, self.ends, self.cuts = view(n, "<u8"), view(n + 1, "<u8"), view(n, "<u8")
        self.host_lengths, self.path_lengths = set(view(hosts, "<u8").tolist()), view(paths, "<u8").tolist()
        self.verdicts, self.blob = view(n, "u1"), view(blob, "u1")

    def probes(self, host: str, path: str) -> list[str]:
        found = []
        tails = [path[:n] for n in self.path_lengths if n <= len(path)]
        longest, at = max(self.host_lengths, default=0), len(host)
        while at >= 0 and tails:
            at = host.rfind(".", 0, at)
            size = len(host) - at - 1
            if size > longest:
                break
            if size in self.host_lengths and size:
                found += [host[at + 1 :] + tail for tail in tails]
            if at < 0:
                break
        return found

    def judge(self, hosts: Sequence[str], paths: Sequence[str]) -> list[tuple[str, int] | None]:
        """The deciding rule of each (host, path) and its verdict's number."""
        asked: list[str] = []
        rows: list[int] = []
        for row, (host, path) in enumerate(zip(hosts, paths)):
            mine = self.probes(host, path)
            asked += mine
            rows += [row] * len(mine)
        best: list[tuple[int, int, str, int] | None] = [None] * len(hosts)
        if asked and len(self.keys):
            digests = np.fromiter(map(self.key, asked), "<u8", len(asked))
            first = np.searchsorted(self.keys, digests, "left")
            last = np.searchsorted(self.keys, digests, "right")
            for i in np.flatnonzero(last > first):
                wanted = asked[i].encode()
                for slot in range(first[i], last[i]):
                    if self.blob[int(self.ends[slot]) : int(self.ends[slot + 1])].tobytes() == wanted:
                        cut = int(self.cuts[slot])
                        here = (len(asked[i]), cut, asked[i], int(self.verdicts[slot]))
                        if best[rows[i]] is None or here[:2] > best[rows[i]][:2]:
                            best[rows[i]] = here
        return [b and (b[2], b[3]) for b in best]


@lru_cache(maxsize=2)
def _mapped(name: str) -> Mapped:
    return Mapped(SparkFiles.get(name))


def publish(spark: SparkSession, rules: Sequence[tuple[str, str]], max_bytes: int = 1 << 28) -> str:
    """Write the index to the shared folder, hand it to every executor, and return its name.

    The list may hold up to ``max_bytes`` bytes of rules; each node keeps one copy on disk.
    """
    size = sum(len(rule.encode()) for _, rule in rules)
    if size > max_bytes:
        raise ValueError(f"{size} bytes of rules are more than max_bytes={max_bytes}")
    path = fresh_dir(spark, "url-rules")
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).create(target)
    out.write(bytearray(packed(rules)))
    out.close()
    spark.sparkContext.addFile(path)
    return path.rsplit("/", 1)[1]


def filter_urls(
    pages: DataFrame, rules: Sequence[tuple[str, str]], page_id: str = "page_id", url: str = "url", default: str = "allow"
) -> DataFrame:
    """page_id, host, path, the deciding rule and the verdict of every row of ``pages``."""
    name = publish(pages.sparkSession, rules)
    parts = pages.select(F.col(page_id).alias("page_id"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))

    def judged(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index = _mapped(name)
        for batch in batches:
            found = index.judge(batch["host"].tolist(), batch["path"].tolist())
            batch["rule"] = [f and f[0] for f in found]
            batch["verdict"] = [VERDICTS[f[1]] if f else default for f in found]
            yield batch

    kind = parts.schema["page_id"].dataType.simpleString()
    return parts.mapInPandas(judged, f"page_id {kind}, host string, path string, rule string, verdict string")
