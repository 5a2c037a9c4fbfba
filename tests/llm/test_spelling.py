"""Spelling variants against brute force over all pairs of words."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from recbrook.llm import spelling


def words_of(rows):
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m.group().lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 7:
                n[run] += 1
    return {w: c for w, c in n.items() if c >= 2}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(rows):
    n = words_of(rows)
    form, out = {}, {}
    for w in n:
        close = [v for v in n if one_edit(w, v)]
        best = min(close, key=lambda v: (-n[v], v), default=None)
        out[w] = len(close)
        form[w] = best if best is not None and n[best] >= 10 * n[w] else None
    res = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        res.append((w, form[w], root, n[w], out[w], n[form[w]] if form[w] else None))
    return sorted(res)


def run(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = spelling.spelling_variants(df)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted(tuple(r) for r in got.collect())


def test_matches_brute_force(spark):
    rng = random.Random(4)
    base = ["".join(rng.choices("abcdeéÉÿ", k=rng.randrange(6, 10))) for _ in range(60)]
    rows = []
    for i in range(300):
        line = []
        for w in rng.choices(base, [1 / (k + 1) ** 2 for k in range(60)], k=60):
            r = rng.random()
            at = rng.randrange(len(w))
            if r < 0.02:
                w = w[:at] + rng.choice("abcde") + w[at + 1:]
            elif r < 0.04:
                w = w[:at] + rng.choice("ab") + w[at:]
            line.append(w.upper() if r > 0.9 else w)
        rows.append((i, " ".join(line)))
    rows += [(None, "abcdefgh abcdefgh"), (7, None), (8, ""), (9, "12 .. !"), (10, "x" * 5000 + " " + "x" * 5000 + " " + "x" * 5001),
             (11, "x" * 5001), (12, "STRASSE Straßenn straßenn"), (13, "abc×def÷ abc×def÷")]
    rows += [rows[0]] * 3
    want = brute(rows)
    assert any(r[1] for r in want) and any(r[4] > 3 for r in want)
    assert run(spark, rows) == want


def test_chain_of_forms_and_ties(spark):
    # Ids chosen so that no run loses a letter.
    texts = {"aaaaaaaa": 2, "aaaaaaab": 20, "aaaaaabb": 200, "aaaaaaac": 20, "zzzzzzzz": 3}
    rows, i = [], 0
    for w, n in texts.items():
        while n:
            i += 1
            if zlib.crc32(f"{i}:{w}".encode()) % 31:
                rows.append((i, w))
                n -= 1
    got = {r[0]: r[1:] for r in run(spark, rows)}
    assert got["aaaaaaaa"] == ("aaaaaaab", "aaaaaabb", 2, 2, 20)
    assert got["aaaaaaab"][:2] == ("aaaaaabb", "aaaaaabb") and got["zzzzzzzz"] == (None, "zzzzzzzz", 3, 0, None)


def test_many_chunks_of_one_block(spark, monkeypatch):
    monkeypatch.setattr(spelling, "CHUNK", 4)
    monkeypatch.setattr(spelling, "TILE", 2)
    rng = random.Random(6)
    words = {"".join(rng.choices("ab", k=8)) for _ in range(90)} | {"".join(rng.choices("ab", k=9)) for _ in range(60)}
    rows = [(i, " ".join(sorted(words))) for i in range(3)]
    assert run(spark, rows) == brute(rows)


def test_empty_and_clashing_columns(spark):
    assert run(spark, []) == [] and run(spark, [(1, "short words only")]) == []
    df = spark.createDataFrame([(1, "wordone wordone wordtwo", 3, "k")], "doc_id long, text string, n int, word string")
    assert [r["word"] for r in spelling.spelling_variants(df).collect()] == ["wordone"]


def test_near_on_long_words():
    a, b = "b" * 5000, "b" * 4999 + "c"
    x, y = spelling.Chunk(a + b, 5000), spelling.Chunk("b" * 4999, 4999)
    assert [v.tolist() for v in spelling.near(x, x)] == [[0, 1], [1, 0]]
    assert [v.tolist() for v in spelling.near(x, y)] == [[0, 1], [0, 0]]
    assert np.isfinite(x.square).all()


@pytest.mark.parametrize("sf", ["sf0.001"])
def test_query_matches_brute_force(spark, sf):
    from recbrook.llm.queries import QUERIES
    d = f"/root/testdata/{sf}"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{d}/documents.parquet").collect()]
    assert sorted(tuple(r) for r in QUERIES["op11_spelling_variants"](spark, d).collect()) == brute(rows)
