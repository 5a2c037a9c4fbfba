"""Hard negatives against brute force over all pairs."""

import math
import random

import numpy as np
import pytest

from recbrook.llm import negatives


def brute(rows):
    part = []
    for i, x, lab in rows:
        if i is None or lab is None or x is None or any(v is None or not math.isfinite(v) for v in x):
            continue
        part.append((i, (lab + 1) % 10 if i % 7 == 0 else lab, [math.floor(256 * v) for v in x]))
    anchors = {}
    for i, lab, q in part:
        if i % 100 == 0 and (i not in anchors or (lab, q) < anchors[i]):
            anchors[i] = (lab, q)
    out = []
    for a, (lab, q) in anchors.items():
        s = [(-sum(x * y for x, y in zip(q, r)), i, l == lab) for i, l, r in part if i != a and len(r) == len(q)]
        for ps, p, _ in sorted(x for x in s if x[2])[:5]:
            ok = sorted(x for x in s if not x[2] and 80 * -ps <= 100 * -x[0] <= 100 * -ps)[:5]
            out += [(a, p, r, n, -ps, -ns) for r, (ns, n, _) in enumerate(ok, 1)]
    return sorted(out)


def run(spark, rows, schema="vec_id long, embedding array<float>, label int"):
    got = negatives.hard_negatives(spark.createDataFrame(rows, schema))
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in got.collect())


def vectors(rng, n, dim, labels, spread=0.6):
    base = rng.normal(size=(5, dim))
    x = base[rng.integers(0, 5, n)] + spread * rng.normal(size=(n, dim))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    return [(i, [float(np.float32(v)) for v in x[i]], int(rng.integers(0, labels))) for i in range(n)]


@pytest.mark.parametrize("spread", [0.1, 0.6, 3.0])
def test_matches_brute_force(spark, monkeypatch, spread):
    monkeypatch.setattr(negatives, "STEP", 16)
    monkeypatch.setattr(negatives, "BLOCK", 150)
    monkeypatch.setattr(negatives, "GROUP", 3)
    rows = vectors(np.random.default_rng(3), 900, 6, 4, spread)
    want = brute(rows)
    assert len(want) > 100
    assert run(spark, rows) == want


def test_odd_rows(spark):
    rng = random.Random(1)
    # Few distinct values, so most scores tie; repeated rows; one hot label.
    rows = [(i, [rng.choice([0.0, 0.5, -0.5]) for _ in range(3)], 1 if i % 3 else 2) for i in range(300)]
    rows += [(5, [0.5, 0.5, 0.5], 1)] * 8 + [(6, [0.5, 0.5, 0.5], 2)] * 8
    rows += [(100, None, 1), (None, [1.0, 1.0, 1.0], 1), (301, [1.0, None, 1.0], 1), (302, [float("nan")] * 3, 2),
             (303, [float("inf")] * 3, 2), (304, [1.0, 1.0, 1.0], None), (400, [], 3), (401, [], 3), (402, [], 1),
             (500, [0.0, 0.0, 0.0], 1), (600, [1.0, 2.0], 1), (601, [1.0, 2.0], 1), (602, [1.0, 1.9], 2), (-100, [0.5, 0.0, 0.5], 2)]
    assert run(spark, rows) == brute(rows)


def test_scores_beyond_53_bits(spark):
    rows = [(i, [float(2 ** 21 + i % 7), float(2 ** 20 + i % 5)], i % 2) for i in range(60)]
    got, want = run(spark, rows), brute(rows)
    assert got == want and max(r[4] for r in want) > 2 ** 53
    huge = [(i, [3e38, 3e38], i % 2) for i in range(40)]
    assert {r[4] for r in run(spark, huge)} == {2 ** 63 - 1}


def test_empty_and_clashing_columns(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, [1.0], 1), (2, [1.0], 2)]) == []  # no anchor
    rows = [(i, [1.0, 0.5], i % 2, 0, "k") for i in range(100, 120)]
    assert run(spark, rows, "vec_id long, embedding array<float>, label int, q int, block string") == brute([r[:3] for r in rows])


def test_walk_stops_early():
    """On vectors in tight directions a member reads a small part of the list."""
    import pandas as pd
    rng = np.random.default_rng(5)
    rows = vectors(rng, 4000, 16, 1, 0.05)
    q = np.floor(256 * np.array([r[1] for r in rows]))
    lists = negatives.Lists(pd.DataFrame({"vec_id": range(4000), "label": 0, "q": [v.astype("<f4").tobytes() for v in q]}), 16)
    read = []

    class Spy(np.ndarray):
        def __getitem__(self, i):
            read.append(len(i))
            return np.asarray(super().__getitem__(i))

    lists.x = lists.x.view(Spy)
    one = np.zeros(1, int)
    ask, ids, score = lists.walk(q[:1], np.array([0]), lists.labels == 0, one, np.array([-np.inf]), np.array([np.inf]))
    assert sum(read) < 2000
    want = sorted(((-int(v), i) for i, v in enumerate(q @ q[0]) if i))[:5]
    assert sorted(zip((-score).tolist(), ids.tolist())) == want


def test_query_matches_brute_force(spark):
    from recbrook.llm.queries import QUERIES
    d = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{d}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    assert sorted(tuple(r) for r in QUERIES["op13_hard_negatives"](spark, d).collect()) == brute(rows)
