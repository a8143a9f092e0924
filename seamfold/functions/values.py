"""Values of words, pairs of words and lines, added up in tasks."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa

#: Words that a task holds before it sends on what they add up to.
HELD = 1_000_000
_WORDS = re.compile("[a-z']+")


def _value(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode(), digest_size=8).digest(), "little", signed=True)


def counted(schema: pa.Schema) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """What makes batches of (keys, lower-case text) into (keys, kind, g, h, n): kind 1 a word, 2 a pair within a line, l a line."""

    def added(groups: dict[tuple, int], found: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        group = np.concatenate([np.full(len(k), i) for i, k, _, _ in found])
        kind, g, h = (np.concatenate([x[c] for x in found]) for c in (1, 2, 3))
        sums = pa.table({"group": group, "kind": kind, "g": g, "h": h}).group_by(["group", "kind", "g", "h"], use_threads=False).aggregate([([], "count_all")])
        keys = [pa.array([k[i] for k in groups], f.type).take(sums["group"]) for i, f in enumerate(list(schema)[:-4])]
        kinds = pa.array(["1", "2", "l"]).take(sums["kind"])
        yield from pa.table([*keys, kinds, sums["g"], sums["h"], sums["count_all"]], names=schema.names).cast(schema).to_batches()

    def run(batches):
        groups, found, known, n = {}, [], {}, 0
        for batch in batches:
            for *key, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = _WORDS.findall(text)
                for w in words:
                    if w not in known:
                        known[w] = _value(w)
                own = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
                line = np.frombuffer(hashlib.blake2b(" ".join(words).encode(), digest_size=16).digest(), np.int64)
                m = len(words)
                pairs = max(0, m - 1)
                kind = np.repeat(np.array([0, 1, 2], np.int8), [m, pairs, 1])
                g, h = np.concatenate([own, own[:pairs], line[:1]]), np.concatenate([np.zeros(m, np.int64), own[1:], line[1:]])
                found.append((groups.setdefault(tuple(key), len(groups)), kind, g, h))
                n += m + 1
                if n >= HELD:
                    yield from added(groups, found)
                    groups, found, known, n = {}, [], {}, 0
        if found:
            yield from added(groups, found)

    return run
