"""The stream of line hashes against counting by hand, however it is cut into batches."""

import numpy as np
import pyarrow as pa
import pytest

from tempograin.llm import lines


def batches(rows, size):
    for s in range(0, len(rows), size):
        part = rows[s : s + size]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in part], f.type) for i, f in enumerate(lines._LINES)], schema=lines._LINES)


def by_hand(rows, least):
    holders = {}
    for h1, h2, i, *_ in rows:
        holders.setdefault((h1, h2), set()).add(i)
    return sorted((i, r, n, at) for h1, h2, i, r, n, at in rows if len(holders[h1, h2]) >= least and i != max(holders[h1, h2]))


@pytest.mark.parametrize("size", [1, 2, 3, 7, 50, 1000])
@pytest.mark.parametrize("parts", [1, 2, 5])
def test_any_batches_and_partitions(size, parts):
    rng = np.random.default_rng(size * 10 + parts)
    # Runs of few and of many documents; a document may hold a hash in several rows.
    rows = [(h, -h, int(i), k, 9, [k, k + 1]) for h in range(40) for i in rng.integers(0, 12, rng.integers(1, 20)) for k in range(rng.integers(1, 3))]
    rows = sorted(rows, key=lambda r: (r[0], r[1], -r[2]))
    # Partitions end between documents, as ranges of (hash, id) do.
    ends = sorted({next((j for j in range(e, len(rows)) if rows[j][:3] != rows[j - 1][:3]), len(rows)) for e in range(len(rows) // parts, len(rows), len(rows) // parts)} | {len(rows)})
    dealt = [rows[s:e] for s, e in zip([0, *ends], ends, strict=False)]
    shared = {}
    for part in dealt:
        for b in lines._edges(batches(part, size)):
            for h1, h2, docs, top in zip(*(c.to_pylist() for c in b.columns), strict=True):
                n, t = shared.get((h1, h2), (0, top))
                shared[h1, h2] = (n + docs, max(t, top))
    found = [tuple(r.values()) for part in dealt for b in lines._stream(shared, 5, batches(part, size)) for r in b.to_pylist()]
    assert sorted(found) == by_hand(rows, 5)
