"""URL filters: a bit-parallel wildcard automaton.

Every rule is a glob over a canonical URL. All globs together are one bit vector, cut into 64-bit words: each glob owns a start bit and a
bit for each of its literals. A byte of the URL moves all globs at once by Shift-And: bits shift to the next literal where that
literal takes the byte, and bits before a wildcard stay where the wildcard takes it. A batch of URLs runs side by side, so a step is
a few array operations whatever the number of rules; URLs that have ended drop out.

Canonical URL: ``.`` + host + path. Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; path: from there up
to ``?``, ``#`` or the end. The leading ``.`` lets ``*.net/**`` fit ``net`` and all its subdomains. ``*`` takes any run without ``/``, ``**`` any
run, ``?`` one byte that is not ``/``.

The rule with the longest name decides; of equally long ones that with the longer host part, then block before allow. A URL that no
rule fits gets the default verdict.

Defined results: a null URL, an empty one and one without ``://`` have empty host and path, and so the default verdict (unless a rule
fits the empty URL); rows are judged one by one, so repeated rows repeat and an empty table stays empty; only the named columns are
read; URLs of any length are matched whole.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from siftwright.llm.common import map_batches

_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_HOST_END = re.compile(r"[/?#]")
_PATH_END = re.compile(r"[?#]")


@dataclass(frozen=True)
class Rule:
    """``name`` is what results show. ``glob`` runs over the canonical URL."""

    name: str
    glob: str
    verdict: str  # allow or block
    shown: bool = True  # rules that aren't shown decide only where no shown rule fits

    @staticmethod
    def host_path(rule: str, verdict: str) -> "Rule":
        """``example.net/en/``: the host, its subdomains, and paths that start with ``/en/``."""
        host, slash, rest = rule.partition("/")
        return Rule(rule, f"*.{host.translate(_LOWER)}{slash}{rest}**", verdict)


def host_and_path(url: str | None) -> tuple[str, str]:
    at = (url or "").find("://")
    if at < 0:
        return "", ""
    rest = url[at + 3 :]
    end = m.start() if (m := _HOST_END.search(rest)) else len(rest)
    path = rest[end:]
    return rest[:end].translate(_LOWER), path[: m.start()] if (m := _PATH_END.search(path)) else path


class Automaton:
    """Shift-And over multiword masks for many globs at once."""

    def __init__(self, rules: list[Rule]):
        self.rules = sorted(rules, key=lambda r: (not r.shown, -len(r.name), -len(r.name.partition("/")[0]), r.verdict != "block", r.name))
        n_bits = 0
        takes: list[tuple[int, object]] = []  # bit, byte or None for ?
        stays: list[tuple[int, bool]] = []  # bit, whether / too
        self.starts, self.ends = [], []
        for rule in self.rules:
            self.starts.append(n_bits)
            bit, n_bits = n_bits, n_bits + 1
            for part in re.findall(r"\*\*|\*|\?|[^*?]+", rule.glob):
                if part in ("*", "**"):
                    stays.append((bit, part == "**"))
                    continue
                for byte in [None] if part == "?" else part.encode():
                    bit, n_bits = n_bits, n_bits + 1
                    takes.append((bit, byte))
            self.ends.append(bit)
        self.words = max(1, -(-n_bits // 64))
        self.take = np.zeros((256, self.words), np.uint64)
        self.stay = np.zeros((256, self.words), np.uint64)
        self.begin = np.zeros(self.words, np.uint64)
        one = lambda bit: np.uint64(1 << bit % 64)
        not_slash = np.arange(256) != ord("/")
        for bit, byte in takes:
            self.take[not_slash if byte is None else byte, bit // 64] |= one(bit)
        for bit, slash in stays:
            self.stay[slice(None) if slash else not_slash, bit // 64] |= one(bit)
        for bit in self.starts:
            self.begin[bit // 64] |= one(bit)

    def run(self, urls: list[bytes]) -> np.ndarray:
        """For each URL the index of the first of ``self.rules`` that fits, or -1."""
        lengths = np.array([len(u) for u in urls], np.int64)
        order = np.argsort(-lengths, kind="stable")
        state = np.repeat(self.begin[None, :], len(urls), axis=0)
        offsets = np.concatenate([[0], np.cumsum(lengths[order])[:-1]])
        data = np.frombuffer(b"".join([urls[i] for i in order]), np.uint8)
        alive = -np.sort(-lengths)
        n = len(urls)
        for t in range(int(alive[0]) if n else 0):
            while n and alive[n - 1] <= t:
                n -= 1
            now = state[:n]
            byte = data[offsets[:n] + t]
            moved = now << np.uint64(1)
            moved[:, 1:] |= now[:, :-1] >> np.uint64(63)
            state[:n] = (moved & self.take[byte]) | (now & self.stay[byte])
        out = np.full(len(urls), -1, np.int64)
        for k in reversed(range(len(self.rules))):
            bit = self.ends[k]
            out[order[(state[:, bit // 64] >> np.uint64(bit % 64)) & np.uint64(1) == 1]] = k
        return out


def judge(df: DataFrame, rules: list[Rule], id_col: str = "page_id", url_col: str = "url", default: str = "allow") -> DataFrame:
    """``id_col, host, path, rule, verdict``: ``rule`` is the name of the deciding rule where it is shown, else null."""
    automaton = Automaton(rules)

    def f(batch: pa.RecordBatch) -> pa.RecordBatch:
        split = [host_and_path(u) for u in batch.column(1).to_pylist()]
        found = automaton.run([f".{h}{p}".encode("utf-8", "surrogatepass") if h or p else b"" for h, p in split])
        hits = [automaton.rules[k] if k >= 0 else None for k in found.tolist()]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([h for h, _ in split], pa.string()), pa.array([p for _, p in split], pa.string()), pa.array([r.name if r and r.shown else None for r in hits], pa.string()), pa.array([r.verdict if r else default for r in hits], pa.string())],
            ["id", "host", "path", "rule", "verdict"],
        )

    kind = df.schema[id_col].dataType.simpleString()
    return map_batches(df.select(df[id_col].alias("id"), df[url_col].alias("url")), f, f"id {kind}, host string, path string, rule string, verdict string").withColumnRenamed("id", id_col)
