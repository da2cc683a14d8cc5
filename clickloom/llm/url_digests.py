"""URL filter: a sorted array of 64-bit digests, memory-mapped and probed by binary search.

A rule is a host and a path prefix written together, as in ``example.org/es/``. All rules
lie in three flat arrays: digests in ascending order, offsets, and the rules' own bytes. A
URL is probed with every host suffix joined to every path prefix whose length some rule
has; a hit counts only if the stored string is equal, so digest collisions do no harm.
"""

from __future__ import annotations

import tempfile
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ARRAY_BYTES = 64 << 20


def host_and_path(url) -> tuple:
    """Columns host and path of a URL column; null or no ``://`` gives empty strings."""
    text = F.coalesce(url, F.lit(""))
    host = F.regexp_extract(text, r"(?s)^.*?://([^/?#]*)", 1)
    path = F.regexp_extract(text, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)
    return F.translate(host, UPPER, LOWER), path


def digest_array(rules: list[tuple[str, str]]) -> bytes:
    """The arrays of ``(rule, verdict)`` pairs as one byte string; equal rules: the first."""
    named = dict(reversed([(rule.encode(), verdict) for rule, verdict in rules]))
    keyed = sorted((xxhash.xxh64_intdigest(rule), rule, verdict == "block") for rule, verdict in named.items())
    ends = np.cumsum([0, *(len(k[1]) for k in keyed)], dtype=np.int64)
    lengths = np.unique([len(k[1].decode()) - k[1].decode().index("/") for k in keyed] or [0]).astype(np.int64)
    head = np.array([len(keyed), len(lengths)], np.int64)
    return b"".join([head.tobytes(), np.array([k[0] for k in keyed], np.uint64).tobytes(), ends.tobytes(),
                     np.array([k[2] for k in keyed], np.int64).tobytes(), lengths.tobytes(),
                     *(k[1] for k in keyed)])


class Digests:
    """A digest array mapped from an unlinked temporary file of this task's machine."""

    def __init__(self, data: bytes):
        with tempfile.TemporaryFile() as file:
            file.write(data)
            file.flush()
            whole = np.memmap(file, np.uint8, mode="r")
        n, n_lengths = whole[:16].view(np.int64)
        cut = 16 + 8 * np.cumsum([0, n, n + 1, n, n_lengths])
        self.keys = whole[cut[0]:cut[1]].view(np.uint64)
        self.ends = whole[cut[1]:cut[2]].view(np.int64)
        self.block = whole[cut[2]:cut[3]].view(np.int64)
        self.lengths = whole[cut[3]:cut[4]].view(np.int64).tolist()
        self.text = whole[cut[4]:]

    def find(self, strings: list[bytes]) -> np.ndarray:
        """Place of each string in the array, or -1."""
        asked = np.fromiter(map(xxhash.xxh64_intdigest, strings), np.uint64, len(strings))
        low = np.searchsorted(self.keys, asked, "left")
        high = np.searchsorted(self.keys, asked, "right")
        found = np.full(len(strings), -1, np.int64)
        for i in np.flatnonzero(low < high):
            for k in range(low[i], high[i]):  # more than one only where digests collide
                if self.rule(k) == strings[i]:
                    found[i] = k
        return found

    def rule(self, k: int) -> bytes:
        return self.text[self.ends[k]:self.ends[k + 1]].tobytes()


@lru_cache(maxsize=2)
def _mapped(data: bytes) -> Digests:
    return Digests(data)


def probes(host: str, path: str, lengths: list[int]) -> list[bytes]:
    """All rules that could fit: host suffixes with path prefixes of the given lengths."""
    labels = host.split(".")
    paths = [path[:n] for n in lengths if n <= len(path)]
    return [f"{'.'.join(labels[k:])}{p}".encode("utf-8", "surrogatepass") for k in range(len(labels)) for p in paths]


def judged(urls: DataFrame, rules: list[tuple[str, str]], default: str = "allow") -> DataFrame:
    """``urls(page_id, url)`` with ``host``, ``path``, ``rule`` and ``verdict``.

    The longest fitting rule gives the verdict; without one it is ``default`` and ``rule``
    is null. A rule fits its host and all subdomains if the path starts with its path.
    A rule needs a host and a path of at least ``/``. Null or odd URLs have empty host and
    path and fit no rule. The array must stay under ``ARRAY_BYTES``, which is checked; for
    more rules use :func:`judged_by_join`. Repeated rows are judged alike.
    """
    data = digest_array(rules)
    if len(data) > ARRAY_BYTES:
        raise ValueError(f"{len(data)} bytes of rules; use judged_by_join")
    array = urls.sparkSession.sparkContext.broadcast(data)

    def run(batches):
        digests = _mapped(array.value)
        for batch in batches:
            asked, row = [], []
            for i, (host, path) in enumerate(zip(batch.column("host").to_pylist(), batch.column("path").to_pylist())):
                own = probes(host, path, digests.lengths) if host else []
                asked += own
                row += [i] * len(own)
            rule, verdict = [None] * batch.num_rows, [default] * batch.num_rows
            places = digests.find(asked)
            for hit in np.flatnonzero(places >= 0):
                i, text = row[hit], asked[hit].decode()
                if rule[i] is None or len(text) > len(rule[i]):
                    rule[i] = text
                    verdict[i] = "block" if digests.block[places[hit]] else "allow"
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(rule, pa.string()), pa.array(verdict, pa.string())],
                [*batch.schema.names, "rule", "verdict"])

    host, path = host_and_path(F.col("url"))
    return urls.select(F.col("page_id").cast("long").alias("page_id"), host.alias("host"), path.alias("path")).mapInArrow(
        run, "page_id long, host string, path string, rule string, verdict string")


def judged_by_join(urls: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """:func:`judged` for any number of rules ``(rule, verdict)``.

    The distinct (host, path) pairs emit their probes, for the path lengths that rules
    have; digests meet the rules in an equality join that also compares the strings, and
    the longest hit of a pair is kept. ``rules`` must hold each rule once.
    """
    host, path = host_and_path(F.col("url"))
    keyed = urls.select(F.col("page_id").cast("long").alias("page_id"), host.alias("host"), path.alias("path"))
    at = F.instr("rule", "/")
    lengths = sorted(r[0] for r in rules.select(F.length("rule") - at + 1).distinct().collect())
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)),
                           lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."))
    probe = (keyed.select("host", "path").distinct().where("host <> ''")
             .select("host", "path", F.explode(suffixes).alias("suffix"))
             .select("host", "path", "suffix", F.explode(F.array(*map(F.lit, lengths))).alias("n"))
             .where("n <= length(path)")
             .select("host", "path", F.expr("concat(suffix, substring(path, 1, n))").alias("probe"))
             .withColumn("digest", F.xxhash64("probe")))
    hits = (probe.join(rules.withColumn("digest", F.xxhash64("rule")), "digest").where("probe = rule")
            .groupBy("host", "path").agg(F.max_by(F.struct("rule", "verdict"), F.length("rule")).alias("hit")))
    return keyed.join(hits, ["host", "path"], "left").select(
        "page_id", "host", "path", F.col("hit.rule").alias("rule"),
        F.coalesce("hit.verdict", F.lit(default)).alias("verdict"))
