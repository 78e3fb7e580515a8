"""Allow and block rules for URLs, looked up in a sorted digest array.

The rules are kept in one file that every task maps into memory: the XXH64 of each entry in ascending order, where each
entry's string stands, its verdict, and the strings. Tasks hash what might match in each URL, probe the array with vectorised
binary searches, and compare the stored strings, so that equal digests of different strings do no harm.
"""

from __future__ import annotations

import os
import re
import tempfile
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession

_UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_MAGIC = 0x7E11D16E
ALLOW, BLOCK = 0, 1


def split_url(url: str | None) -> tuple[str, str]:
    """Host and path: the host after the first ``://`` up to ``/``, ``?`` or ``#``, A-Z lower-cased; the path from there up to ``?`` or ``#``."""
    _, found, rest = (url or "").partition("://")
    if not found:
        return "", ""
    host = re.split("[/?#]", rest, maxsplit=1)[0]
    return host.translate(_UPPER), re.split("[?#]", rest[len(host) :], maxsplit=1)[0]


def write_array(rules: Iterable[tuple[str, str]], file: str) -> None:
    """Write (verdict, rule) pairs as a sorted digest array; a rule is a host followed by a path that begins with ``/``.

    Of repeated rules block wins. Rules without a path or with an empty host are refused.
    """
    verdicts: dict[bytes, int] = {}
    for verdict, rule in rules:
        host, slash, _ = rule.partition("/")
        if not host or not slash or verdict not in ("allow", "block"):
            raise ValueError(f"not a rule: {verdict} {rule}")
        data = rule.encode("utf-8")
        verdicts[data] = max(verdicts.get(data, 0), BLOCK if verdict == "block" else ALLOW)
    entries = sorted((xxhash.xxh64_intdigest(data), data) for data in verdicts)
    paths = sorted({len(data.decode("utf-8").partition("/")[2]) + 1 for _, data in entries})
    labels = sorted({data.decode("utf-8").partition("/")[0].count(".") + 1 for _, data in entries})
    ends = np.cumsum([len(d) for _, d in entries], dtype=np.int64) if entries else np.zeros(0, np.int64)
    with open(file, "wb") as out:
        np.array([_MAGIC, len(entries), len(paths), len(labels)], "<u8").tofile(out)
        np.array([*paths, *labels], "<i8").tofile(out)
        np.array([d for d, _ in entries], "<u8").tofile(out)
        ends.astype("<i8").tofile(out)
        np.array([verdicts[d] for _, d in entries], np.uint8).tofile(out)
        out.write(b"".join(d for _, d in entries))


class DigestArray:
    """A sorted digest array, mapped into memory."""

    def __init__(self, file: str):
        self.data = np.memmap(file, np.uint8, "r")
        magic, self.size, paths, labels = (int(x) for x in self.data[:32].view("<u8"))
        if magic != _MAGIC:
            raise ValueError(f"not a digest array: {file}")
        at = 32
        self.lengths = self.data[at : at + 8 * paths].view("<i8").tolist()  # of the rules' paths
        at += 8 * paths
        self.labels = self.data[at : at + 8 * labels].view("<i8").tolist()  # how many labels the rules' hosts have
        at += 8 * labels
        self.digests = self.data[at : at + 8 * self.size].view("<u8")
        at += 8 * self.size
        self.ends = self.data[at : at + 8 * self.size].view("<i8")
        at += 8 * self.size
        self.verdicts = self.data[at : at + self.size]
        self.strings = self.data[at + self.size :]

    def find(self, keys: list[bytes]) -> np.ndarray:
        """The number of each key's entry, -1 for none."""
        digests = np.fromiter(map(xxhash.xxh64_intdigest, keys), np.uint64, len(keys))
        slots = np.searchsorted(self.digests, digests)
        found = np.full(len(keys), -1, np.int64)
        inside = np.flatnonzero(slots < self.size)
        for n in inside[self.digests[slots[inside]] == digests[inside]].tolist():
            slot = int(slots[n])
            while slot < self.size and self.digests[slot] == digests[n]:  # all entries with this digest
                if self.strings[self.ends[slot - 1] if slot else 0 : self.ends[slot]].tobytes() == keys[n]:
                    found[n] = slot
                    break
                slot += 1
        return found

    def judge(self, urls: list[tuple[str, str]]) -> list[tuple[str | None, int]]:
        """For each host and path the longest rule that fits (None: no rule) and its verdict (then: allow)."""
        keys, owners = [], []
        for n, (host, path) in enumerate(urls):
            # only as many labels from the end as some rule has
            parts = host.rsplit(".", self.labels[-1]) if host and self.labels else []
            suffixes = [host if size == host.count(".") + 1 else ".".join(parts[-size:]) for size in self.labels if size <= host.count(".") + 1]
            heads = [path[:size] for size in self.lengths if size <= len(path)]
            new = [(s + h).encode("utf-8", "surrogatepass") for s in suffixes for h in heads if s]
            keys += new
            owners += [n] * len(new)
        best: list[tuple[int, int, int]] = [(0, 0, -1)] * len(urls)
        for key, owner, slot in zip(keys, owners, self.find(keys).tolist()):
            if slot >= 0:
                rule = key.decode("utf-8")
                best[owner] = max(best[owner], (len(rule), rule.index("/"), slot))
        said = []
        for _, _, slot in best:
            rule = self.strings[self.ends[slot - 1] if slot else 0 : self.ends[slot]].tobytes().decode("utf-8") if slot >= 0 else None
            said.append((rule, int(self.verdicts[slot]) if slot >= 0 else ALLOW))
        return said


def ship(spark: SparkSession, rules: Iterable[tuple[str, str]]) -> str:
    """Make the array of the rules known to all executors, present and future; returns its name."""
    with tempfile.NamedTemporaryFile(prefix="url-rules-", suffix=".bin", delete=False) as file:
        pass
    write_array(rules, file.name)
    spark.sparkContext.addFile(file.name)
    return os.path.basename(file.name)


def judged(spark: SparkSession, pages: DataFrame, rules: Iterable[tuple[str, str]]) -> DataFrame:
    """(page_id, host, path, rule, verdict) per row of ``pages`` (page_id, url).

    A rule fits its host and all subdomains of it if the URL's path starts with the rule's; the longest wins, and of equally long ones that
    with the longer host. rule is null where none fits; the verdict is then allow, as the array lists what is known and
    blocks nothing else. A null URL or one without ``://`` has an empty host and path, which no rule fits. Repeated rows and null
    page_ids are carried along; other columns are not looked at. An empty table or no rules are fine.
    """
    name = ship(spark, rules)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        array = DigestArray(SparkFiles.get(name))
        for batch in batches:
            urls = [split_url(u) for u in batch.column(1).to_pylist()]
            said = array.judge(urls)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([h for h, _ in urls], pa.string()),
                    pa.array([p for _, p in urls], pa.string()),
                    pa.array([r for r, _ in said], pa.string()),
                    pa.array(["block" if v == BLOCK else "allow" for _, v in said], pa.string()),
                ],
                ["page_id", "host", "path", "rule", "verdict"],
            )

    kind = pages.schema["page_id"].dataType.simpleString()
    columns = f"page_id {kind}, host string, path string, rule string, verdict string"
    return pages.select("page_id", "url").mapInArrow(run, columns)
