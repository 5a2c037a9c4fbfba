"""Toxicity: features by hand, folds, odd rows and held-out quality."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from recbrook.llm import toxicity as tx


def code(token, lexicon=None):
    return tx.Tokens(lexicon or {}).code(token)


def test_token_codes():
    lex = {"grob*": 3.0, "flurb": 2.0}
    assert code("Grobian,", lex) & tx.LEARNED and code("Grobian,", lex) >> 8 == 48
    assert not code("gro", lex) & tx.LEARNED and code("flurb", lex) & tx.LEARNED and not code("flurbs", lex) & tx.LEARNED
    assert code("idiot!!") & tx.FIXED and not code("idiot!!") & tx.MIXED
    for t in ("1d10t", "st*pid***", "tr@sh", "$tupid", "id1ot."):
        assert code(t) & tx.MIXED, t
    for t in ("1d10t", "tr@sh", "$tupid", "mor0n"):
        assert code(t) & tx.FOLDED, t
    assert code("i.d.i.o.t") & tx.FIXED and code("stuuuuupid") & tx.FIXED and code("IDIOT") & tx.SHOUT
    assert code("You") & tx.SECOND and code("x") & tx.SINGLE and code("...") == 0 and code("") == 0


def test_the_short_way_gives_the_same_codes():
    import random
    rng = random.Random(4)
    known = tx.Tokens({"grob*": 3.0, "flurb": 2.0, "élan*": 1.5})
    parts = ["grob", "flurb", "idiot", "élan", "elan", "you", "x", "Ü", "ß", "a1", "!!", ",", "$", "THE", "zzz", "iiidiot", "-", ""]
    for _ in range(5000):
        t = "".join(rng.choices(parts, k=rng.randrange(1, 4)))
        t = t.upper() if rng.random() < 0.2 else t
        assert t == "" or known[t] == known.code(t), t


def test_features_by_hand():
    known = tx.Tokens({})
    x = tx.features("You are an idiot, you MORON!! fine words follow here", known)
    assert x[1] == x[3] == 2 / 10 and x[5] == 2 and x[11] == 2 / 10 and x[12] == 1 and x[14] == 1 / 10
    assert tx.features("s t u p i d person", known)[2] == 1 / 7
    far = "idiot " + "word " * 100 + "you"
    assert tx.features(far, known)[12] == 0
    long = "word " * 30_000 + "idiot moron scum"
    assert tx.features(long, known)[5] == 3  # whole texts, densest window
    for t in ("", " ", "\ud800", "é" * 5, "a" * 100_000, "!!!"):
        v = tx.features(t, known)
        assert v.shape == (tx.FEATURES,) and np.isfinite(v).all()


def made(spark, n=900):
    rng = np.random.default_rng(2)
    vocab = [a + b for a in ("ba", "do", "ki", "lu") for b in ("ren", "sto", "mip", "var", "tel")]
    docs, labels = [], []
    for i in range(n):
        bad = i % 6 == 0
        words = rng.choice(vocab, 40).tolist()
        if bad:
            for at in rng.choice(40, 6, replace=False):
                words[at] = "grz" + rng.choice(vocab)  # a stem only the labels tell of
        docs.append((i, " ".join(words)))
        labels.append((i, int(bad)))
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_learned_stem_reaches_unseen_words(spark):
    docs, labels = made(spark)
    model = tx.fit(docs, labels, ~tx.held_out())
    assert any(t.startswith("grz") for t in model.terms) and model.isotonic is not None
    new = spark.createDataFrame([(1, "grzunseen words grzother grznew baren dosto"), (2, "baren dosto kimip lutel words unseen"),
                                 (3, None), (4, ""), (5, "baren " * 20_000), (None, "dosto")], "doc_id long, text string")
    new = new.withColumn("__x", F.lit(1)).withColumn("score", F.lit("clash"))
    got = [tuple(r) for r in tx.score(new, model).collect()]
    by = {r[0]: r[1:] for r in got}
    assert len(got) == 6 and by[1][1] == 1 and all(by[i][1] == 0 for i in (2, 3, 4, 5, None))
    assert all(0 <= r[1] <= 1 for r in got) and by[3] == by[4]


def test_held_out_labels_are_not_read(spark):
    docs, labels = made(spark, 400)
    held = tx.held_out()
    assert {r.doc_id for r in docs.filter(held).collect()} == {i for i in range(400) if zlib.crc32(str(i).encode()) % 3 == 1}
    turned = labels.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = (sorted(map(tuple, tx.score(docs, tx.fit(docs, x, ~held)).collect())) for x in (labels, turned))
    assert a == b


def test_few_or_no_labels(spark):
    docs, labels = made(spark, 60)
    none = labels.filter("false")
    assert {r.score for r in tx.score(docs, tx.fit(docs, none, ~tx.held_out())).collect()} == {0.0}
    ones = labels.withColumn("toxic", F.lit(1)).unionByName(labels.withColumn("toxic", F.lit(None).cast("int")))
    assert {r.predicted for r in tx.score(docs, tx.fit(docs, ones, ~tx.held_out())).collect()} == {1}
    few = tx.fit(docs, labels.unionByName(labels), ~tx.held_out())  # repeated labels count once
    assert few.trees is not None and few.isotonic is None
    assert tx.score(docs.filter("false"), few).collect() == []


@pytest.mark.parametrize("sf, least", [("sf0.01", 0.7), ("sf0.1", 0.9)])
def test_held_out_quality(spark, sf, least):
    """Some 6 % of the labelled documents hold no marking word at all; sf0.01 has
    two or three labelled documents a language to learn from."""
    from recbrook.llm.queries import QUERIES
    d = f"/root/testdata/{sf}"
    got = QUERIES["op12_toxicity"](spark, d)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    assert got.count() == spark.read.parquet(f"{d}/documents.parquet").count()
    r = got.filter("held_out").join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id").select("score", "predicted", "toxic").toPandas()
    pos, neg = r[r.toxic == 1], r[r.toxic == 0]
    assert len(pos) > 5 and (pos.predicted == 1).mean() >= least and (neg.predicted == 0).mean() >= 0.99
    auc = (pos.score.to_numpy()[:, None] > neg.score.to_numpy()).mean()
    assert auc >= least
