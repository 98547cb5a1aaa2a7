"""Blocks of near_dedup bring bounded sets to a task, and every pair meets."""

import random

import numpy as np
import pandas as pd

from beacongrid.llm import near_dedup


def _block(left: list[int], right: list[int]) -> pd.DataFrame:
    size = np.array(left + right)
    ids = np.arange(len(size))
    odd = ids < len(left)
    return pd.DataFrame({"k": 1, "band": 0, "id": ids, "label": ids, "size": size, "sig": [b"a" * 256] * len(ids), "bands": [np.arange(24)] * len(ids), "odd": odd, "i": 0, "j": 0})


def test_long_sets_are_dealt_to_parts():
    for left, right in (([20_000] * 50, [19_000] * 120), ([5] * 30, [5] * 70), ([600_000] * 3, [590_000] * 2), ([5], [900])):
        pdf = _block(left, right)
        size = dict(zip(pdf["id"], pdf["size"], strict=True))
        got = near_dedup._involved(0.7, 85, near_dedup.MOST_SET)(pdf)
        met = []
        for _, part in got.groupby(["k", "i", "j", "s", "t"]):
            for side in (True, False):
                own = part.loc[part["odd"] == side, "id"]
                assert len(own) and sum(size[x] for x in own) <= near_dedup.MOST_SET + max(size[x] for x in own)
            met += [(a, b) for a in part.loc[part["odd"], "id"] for b in part.loc[~part["odd"], "id"]]
        near = [(a, b) for a in range(len(left)) for b in range(len(left), len(size)) if 100 * min(size[a], size[b]) >= 85 * max(size[a], size[b])]
        assert sorted(met) == near


def test_parts_lose_no_link(spark, monkeypatch):
    """A chain of texts that share a bucket with others just beyond the threshold, by blocks of few rows and parts of few sets: as by brute force."""
    rng = random.Random(3)
    word = [f"w{i}" for i in range(400)]
    rows = []
    for g in range(4):
        text = [rng.choice(word) for _ in range(90)]
        for i in range(25):
            at = rng.randrange(len(text))
            text = [*text[:at], rng.choice(word), *text[at + 1 :]] if i % 3 else text
            other = list(text)
            for _ in range(rng.randint(0, 5)):
                other[rng.randrange(len(other))] = rng.choice(word)
            rows.append((100 * g + i, " ".join(other)))
    sets = {i: {tuple(w[j : j + 3]) for j in range(len(w) - 2)} for i, t in rows for w in [t.split()]}
    label = {i: i for i in sets}
    for _ in sets:
        for a in sets:
            for b in sets:
                if 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                    label[a] = label[b] = min(label[a], label[b])
        if all(label[a] == label[b] for a in sets for b in sets if 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])):
            break
    monkeypatch.setattr(near_dedup, "MOST_SET", 100)
    got = near_dedup.near_dedup(spark.createDataFrame(rows, "doc_id long, text string"), shingle=3, percent=85, block=8).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == label
    assert 1 < len(set(label.values())) < len(rows)
