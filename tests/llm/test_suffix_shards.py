"""What a shard of repeated passages gives to the suffix sort, and that its marks are those of all strings."""

import numpy as np
import pyarrow as pa

from barloom.llm import induced, suffix_dedup


def shard(pieces):
    """pieces: (id, start, bytes)."""
    one = lambda k, t: [np.array([k], t).tobytes()]
    rows = [pa.table({"shard": [0], "mark": [False], "id": pa.array([None], pa.int64()), "hash": pa.array([None], pa.int64()), "data": pa.array([None], pa.binary()), "bytes": [b], "lens": one(len(b), "<u4"), "ids": one(i, "<i8"), "hashes": one(0, "<i8"), "starts": one(s, "<i8")}) for i, s, b in pieces]
    return pa.concat_tables(rows)


def removed(pieces):
    """Bytes of strings that have an equal one before them, by id."""
    seen, out = set(), {}
    for i, s, b in sorted(pieces, key=lambda x: x[:2]):
        for k in range(len(b) - 99):
            if b[k : k + 100] in seen:
                out.setdefault(i, set()).update(range(s + k, s + k + 100))
            seen.add(b[k : k + 100])
    return out


def test_only_strings_that_may_be_repeated_are_sorted(monkeypatch):
    rng = np.random.default_rng(3)
    text = lambda n: rng.integers(97, 100, n).astype(np.uint8).tobytes()
    common = text(150)
    pieces = [(i, 7 * i, text(168)) for i in range(200)] + [(300, 5, text(9) + common), (301, 0, common + text(9)), (302, 11, common[20:130] + text(40)), (303, 0, text(30) + common[:99])]
    sorted_ = []
    suffixes = induced.suffixes
    monkeypatch.setattr(induced, "suffixes", lambda t, cap: (sorted_.append(len(t)), suffixes(t, cap))[1])
    got = {}
    for r in suffix_dedup._sort(shard(pieces)).to_pylist():
        for lo, hi in np.frombuffer(r["data"], "<i8").reshape(-1, 2).tolist():
            got.setdefault(r["id"], set()).update(range(lo, hi))
    assert got == removed(pieces) and set(got) == {301, 302}
    assert sum(sorted_) < 1000
    assert len(suffix_dedup._sort(shard(pieces[:200]))) == 0
