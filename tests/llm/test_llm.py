"""Each operator against brute force on small tables, with the awkward cases."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

public_tokenizers = pytest.importorskip("public_tokenizers")

from recbrook.llm import embeddings, fingerprints, html, language, lines, lm, mixing, neardup, packing, tokens
from recbrook.llm.common import components


def rows(df):
    return [r.asDict() for r in df.collect()]


def empty(docs):
    return docs.filter("false")


def test_components_match_union_find(spark):
    rng = random.Random(3)
    pairs = [(rng.randrange(120), rng.randrange(120)) for _ in range(70)] + [(i, i + 1) for i in range(200, 260)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in pairs:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    got = {r["id"]: r["component"] for r in rows(components(spark.createDataFrame(pairs, "a long, b long")))}
    want = {x: find(x) for p in pairs for x in p if p[0] != p[1]}
    assert got == want
    assert rows(components(spark.createDataFrame([], "a long, b long"))) == []


def test_pieces_and_packing(spark, docs):
    from tokenizers import Tokenizer
    path = public_tokenizers.path("word_bpe_49k.json")
    tok = Tokenizer.from_file(path)
    got = rows(packing.pack_documents(docs, path, ids=True))
    by_text = sorted((r["doc_id"] or 0, r["text"] or "") for r in rows(docs))
    want = sorted((d, tok.encode(t, add_special_tokens=False).ids + [0]) for d, t in by_text)
    back = {}
    for r in sorted(got, key=lambda r: r["start"]):
        back.setdefault((r["doc_id"] or 0, r["piece"]), []).append(r["ids"])
    assert sum(len(r["ids"]) for r in got) == sum(len(w) for _, w in want)
    one = {d: w for d, w in want}
    for d in (1, 6, 7):
        assert [x for p in sorted(k[1] for k in back if k[0] == d) for x in back[(d, p)][0]] == one[d]
    for _, seq in itertools.groupby(sorted(got, key=lambda r: (r["sequence_id"], r["offset"])), key=lambda r: r["sequence_id"]):
        at = 0
        for r in seq:
            assert r["offset"] == at
            at += r["length"]
        assert at <= 2048
    assert rows(packing.pack_documents(empty(docs), path)) == []


def test_best_fit_is_tight_and_bounded():
    rng = random.Random(1)
    sizes = sorted((rng.randrange(1, 2048) for _ in range(5000)), reverse=True)
    bins = packing.BestFit(2048)
    used = {}
    for s in sizes:
        b, o = bins.place(s)
        assert used.get(b, 0) == o
        used[b] = o + s
    assert max(used.values()) <= 2048
    assert len(used) <= 1.01 * sum(sizes) / 2048 + 1
    few = packing.BestFit(100, open_bins=2)
    assert [few.place(60)[0], few.place(70)[0], few.place(80)[0], few.place(30)[0]] == [0, 1, 2, 0]  # the fullest, of 70, had closed


def test_encoder_matches_library_on_odd_texts():
    from tokenizers import Tokenizer
    for name in ("word_bpe_49k.json", "byte_bpe_50k.json"):
        path = public_tokenizers.path(name)
        tok, enc = Tokenizer.from_file(path), packing.Encoder(open(path, encoding="utf-8").read())
        texts = ["", " a  b\n\nc ", "Ünïcode É. ΟΔΟΣ. İ. ß, ½. ²", "<|ENDOFTEXT|> <|endoftext|>x", "it's 'LL x..", "a\x1cb　c "]
        got = [np.frombuffer(x, "<u4").tolist() for x in enc.encode(texts)]
        assert got == [tok.encode(t, add_special_tokens=False).ids for t in texts]


def test_language(spark, docs):
    rng = random.Random(2)
    vocab = {"aa": "thing other which after house".split(), "bb": "chose autre apres maison quelle".split()}
    data = [(i, " ".join(rng.choices(vocab[l], k=12)), l) for i, l in ((i, rng.choice(["aa", "bb"])) for i in range(400))]
    df = spark.createDataFrame(data, "doc_id long, text string, lang string")
    usable, held = language.learnable()
    out = rows(language.predict(df.withColumn("held", held), language.fit(df, usable)))
    test = [r for r in out if r["held"]]
    assert test and np.mean([r["lang"] == r["lang_pred"] for r in test]) > 0.98
    assert all(0 <= r["score"] <= 1 for r in out)
    odd = language.predict(docs, language.fit(df, usable))
    by = {(r["doc_id"], r["text"] is None): r["lang_pred"] for r in rows(odd)}
    assert by[(4, True)] == by[(5, False)] == by[(None, False)] == "und" and by[(1, False)] in vocab
    usable, _ = language.learnable()
    assert {r["lang_pred"] for r in rows(language.predict(docs, language.fit(empty(docs), usable)))} == {"und"}


def test_language_stage_acts_on_the_model(spark):
    import corpus_pipeline as p
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    lettered = docs.filter(F.col("text").rlike(r"\p{L}"))
    for unlabelled in (docs.withColumn("lang", F.lit(None).cast("string")), docs.filter(language.learnable()[1])):
        after = p.language_id(spark, unlabelled, "")
        assert after.columns == docs.columns
        assert after.count() == unlabelled.filter(F.col("text").rlike(r"\p{L}")).count() > 0
    odd = spark.createDataFrame([(10_000_000, "xkcd" * 30)], "doc_id long, text string")
    got = p.language_id(spark, docs.unionByName(odd, allowMissingColumns=True), "")
    assert got.count() == lettered.count() and got.filter("doc_id = 10000000").count() == 0
    one = spark.createDataFrame([(i, f"some text {i}", "en") for i in range(20)], "doc_id long, text string, lang string")
    assert p.language_id(spark, one, "").count() == 20


def test_mixing(spark, docs):
    got = rows(mixing.mix(docs, copies=True))
    assert len(got) == docs.count()
    assert all(0 <= r["taken"] <= 2 * r["size"] and 0 <= r["copies"] <= 2 for r in got)
    assert rows(mixing.mix(empty(docs))) == []
    rng = random.Random(5)
    many = spark.createDataFrame([(i, "x " * rng.randrange(1, 900), rng.choice("aaaaabcd")) for i in range(3000)],
                                 "doc_id long, text string, source string")
    m = mixing.mix(many).groupBy("source_size").agg(F.sum("taken").alias("t"), F.first("target").alias("g"))
    for r in rows(m):
        assert abs(r["t"] - r["g"]) <= 0.01 * r["g"]
    total = sum(r["source_size"] for r in rows(m))
    assert sum(r["g"] for r in rows(m)) == pytest.approx(1.5 * total)
    assert sorted(map(str, rows(mixing.mix(many)))) == sorted(map(str, rows(mixing.mix(many.repartition(7)))))


def test_apportion_is_sainte_lague(spark):
    rng = random.Random(9)
    votes = [rng.randrange(0, 10_000) for _ in range(23)]
    df = spark.createDataFrame(list(enumerate(votes)), "p long, v long")
    got = {r["p"]: r["s"] for r in rows(mixing.apportion(df, "v", F.lit(997).cast("bigint"), (), ("p",), "s"))}
    want = [0] * len(votes)
    for _ in range(997):
        want[max(range(len(votes)), key=lambda i: (votes[i] / (2 * want[i] + 1), -i))] += 1
    assert got == dict(enumerate(want))


def test_lines_match_brute_force(spark):
    rng = random.Random(4)
    base = [" ".join(rng.choice("abcdefghij") * rng.randrange(1, 4) + str(rng.randrange(40)) for _ in range(40)) for _ in range(12)]
    texts = []
    for i in range(40):
        mine = []
        for l in rng.sample(base, 3):
            w = l.split()
            if rng.random() < 0.5:
                w[rng.randrange(40)] = "changed"
            mine.append(" ".join(w) + rng.choice(["", ".", " !"]))
        texts.append((i, "\n".join(mine)))
    df = spark.createDataFrame(texts, "doc_id long, text string")
    got = rows(lines.fuzzy_lines(df))
    assert len(got) == 120
    norm = {(i, k): tuple(x for x in t.lower().replace(".", " ").replace("!", " ").split())
            for i, text in texts for k, t in enumerate(text.split("\n"))}
    group = {(r["doc_id"], r["line"]): r["group"] for r in got}
    for x, y in itertools.combinations(norm, 2):
        if norm[x] == norm[y]:
            assert group[x] == group[y]
        if sum(a != b for a, b in zip(norm[x], norm[y])) > 16:
            assert group[x] != group[y]  # never lines of different origin
    for g in set(group.values()):
        of = sorted(k for k in group if group[k] == g)
        assert [k for k in of if next(r["kept"] for r in got if (r["doc_id"], r["line"]) == k)] == of[:1]


def word_edits(x, y):
    last = list(range(len(y) + 1))
    for i, a in enumerate(x, 1):
        here = [i]
        for j, b in enumerate(y, 1):
            here.append(min(last[j] + 1, here[-1] + 1, last[j - 1] + (a != b)))
        last = here
    return last[-1]


@pytest.mark.parametrize("similarity", [0.8, 0.6])
def test_no_similar_lines_are_left_out(spark, similarity):
    """Groups are the components of all pairs, at every length and just at the threshold."""
    rng = random.Random(21)
    vocabulary = [f"w{int(rng.paretovariate(0.6)) % 400}" for _ in range(2000)]
    texts = ["a a a a", "a a a a b", "a a a a c", "x y", "x z", "one", "p q r s", "p q r s t", "q p s r"]
    for n in [3, 4, 5, 6, 9, 10, 11, 14, 20, 33, 60]:
        base = [rng.choice(vocabulary) for _ in range(n)]
        texts.append(" ".join(base))
        for _ in range(8):
            w = list(base)
            for _ in range(rng.randrange(1, 2 + int((1.05 - similarity) * n))):
                at = rng.randrange(len(w))
                if (kind := rng.randrange(3)) == 0 and len(w) > 1:
                    del w[at]
                elif kind == 1:
                    w.insert(at, rng.choice(vocabulary))
                else:
                    w[at] = rng.choice(vocabulary)
            texts.append(" ".join(w))
    got = {r["doc_id"]: r["group"] for r in rows(lines.fuzzy_lines(
        spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), similarity=similarity))}
    part = list(range(len(texts)))
    split = [t.split() for t in texts]
    for x, y in itertools.combinations(range(len(texts)), 2):
        n = max(len(split[x]), len(split[y]))
        if word_edits(split[x], split[y]) <= int((1 - similarity) * n + 1e-9):
            part = [part[x] if p == part[y] else p for p in part]
    same = lambda of: {frozenset(i for i in range(len(texts)) if of[i] == g) for g in set(of[i] for i in range(len(texts)))}
    assert same(got) == same(part)


def test_lines_leave_only_what_the_result_reads(spark, monkeypatch, tmp_path):
    """The words, buckets, pairs and spellings go from the shared folder when nothing reads them again."""
    monkeypatch.setattr("recbrook.llm.common.shared_dir", lambda spark: f"file://{tmp_path}")
    texts = [(i, "\n".join(f"w{j} a b c d e f g h w{j + i % 2}" for j in range(i, i + 9))) for i in range(12)]
    got = lines.fuzzy_lines(spark.createDataFrame(texts, "doc_id long, text string"))
    assert {p.name.rsplit("-", 1)[0] for p in tmp_path.iterdir()} == {"line-nodes", "line-parts"}
    assert got.count() == 108


def test_long_strangers_are_no_candidates(spark, monkeypatch):
    """Lines of 200 words that share a pair of words do not go on to have their words compared."""
    rng = random.Random(9)
    texts = [(i, " ".join([f"v{rng.randrange(2000)}" for _ in range(198)] + ["shared", "pair"])) for i in range(60)]
    texts.append((60, " ".join(texts[7][1].split()[:170])))
    texts.append((61, " ".join(f"v{i}" for i in range(2000)) * 80))  # makes the shared pair the rarest
    pairs, written = [], lines.written

    def counted(df, name):
        out = written(df, name)
        if name == "line-pairs":
            pairs.append(out.count())
        return out

    monkeypatch.setattr(lines, "written", counted)
    got = rows(lines.fuzzy_lines(spark.createDataFrame(texts, "doc_id long, text string")))
    assert [r["doc_id"] for r in got if not r["kept"]] == [60]
    assert sum(pairs) <= 10  # of 1830


def test_bucket_plans_stay_short(spark):
    """The words' ranks are repeated in every plan the driver keeps."""
    texts = spark.createDataFrame([(1, 6, [5, 6, 7, 8, 9, 10])], "node long, n int, words array<int>")
    assert len(lines.keyed(texts, lines.SIMILARITY)._jdf.queryExecution().toString()) < 500_000


def test_close_simhashes_are_complete(spark):
    rng = random.Random(6)
    sims = [rng.getrandbits(64) - (1 << 63) for _ in range(40)]
    sims += [s ^ (1 << rng.randrange(63)) ^ (1 << rng.randrange(63)) ^ (1 << rng.randrange(63)) for s in sims]
    df = spark.createDataFrame([(s,) for s in set(sims)], "sim long")
    want = {(x, y) for x, y in itertools.permutations(set(sims), 2) if bin((x ^ y) & (2**64 - 1)).count("1") <= 3}
    for c in (1, 2, 3):
        d = lines.dealt(df, c)
        got = d.join(d.withColumnRenamed("sim", "m"), ["choice", "key"]).filter(
            f"{lines.close('sim', 'm')} and choice = {lines.first_choice('sim', 'm', c)}").select("sim", "m").collect()
        assert len(got) == len(set(got)) and set(map(tuple, got)) == want


def test_lines_awkward(spark, docs):
    got = lines.fuzzy_lines(docs)
    out = rows(lines.drop_lines(docs, got))
    assert len(out) == docs.count() and set(out[0]) == set(docs.columns)
    texts = {r["doc_id"]: r["text"] for r in out}
    assert texts[4] is None and texts[5] == "" and texts[8] == ""
    assert sorted(r["text"] == "" for r in out if r["doc_id"] == 3) == [False, True]
    assert rows(lines.fuzzy_lines(empty(docs))) == []
    long = spark.createDataFrame([(1, "a " * 70_000), (2, "a " * 70_000), (3, "a b")], "doc_id long, text string")
    assert sorted((r["doc_id"], r["kept"]) for r in rows(lines.fuzzy_lines(long))) == [(1, True), (2, False), (3, True)]


def test_embeddings_match_brute_force(spark):
    rng = np.random.default_rng(8)
    centre = rng.normal(size=(30, 16))
    x = np.concatenate([centre[rng.integers(0, 30, 200)] + 0.12 * rng.normal(size=(200, 16)), np.repeat(centre[:3], 5, 0)])
    x = x.astype(np.float32).astype(float)
    bad = [None, [], [0.0] * 16, [float("nan")] + [1.0] * 15, [None] + [1.0] * 15, [1.0] * 7, [float("inf")] * 16]
    df = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(x)] + [(1000 + i, v, None) for i, v in enumerate(bad)],
                               "vec_id long, embedding array<double>, label int")
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    links = (u @ u.T >= 0.95) & ~np.eye(len(u), dtype=bool)
    label = np.arange(len(u))
    while True:
        new = np.minimum(label, np.where(links, label[None], len(u)).min(1))
        if (new == label).all():
            break
        label = new
    got = {r["vec_id"]: r for r in rows(embeddings.near_duplicates(df))}
    assert [got[i]["n_links"] for i in range(len(u))] == links.sum(1).tolist()
    assert [got[i]["component_id"] for i in range(len(u))] == label.tolist()
    assert all(got[1000 + i]["n_links"] == 0 and got[1000 + i]["kept"] for i in range(len(bad)))
    assert rows(embeddings.near_duplicates(df.filter("false"))) == []


def test_neardup_matches_brute_force(spark, docs):
    rng = random.Random(7)
    texts = []
    for b in range(25):
        base = [f"v{rng.randrange(5000)}" for _ in range(200)]
        for k in range(4):
            w = list(base)
            for _ in range(k):
                w[rng.randrange(200)] = f"n{rng.randrange(10**6)}"
            texts.append((len(texts), " ".join(w)))
    texts.append((500, texts[0][1]))
    s = {i: neardup.shingles(t) for i, t in texts}
    link = {(i, j) for i, j in itertools.combinations(s, 2) if neardup.probability_jaccard(s[i], s[j]) >= 0.8}
    root = {i: i for i in s}
    for _ in range(6):
        for i, j in link:
            root[i] = root[j] = min(root[i], root[j])
    got = {r["doc_id"]: r for r in rows(neardup.near_duplicates(spark.createDataFrame(texts, "doc_id long, text string")))}
    assert {i: r["group_id"] for i, r in got.items()} == root
    odd = rows(neardup.near_duplicates(docs))
    by = {}
    for r in odd:
        by.setdefault(r["doc_id"], []).append(r)
    assert by[2][0]["group_id"] == 1 and by[8][0]["group_id"] == 1 and not by[2][0]["kept"]
    assert sorted(r["kept"] for r in by[3]) == [False, True] and by[4][0]["kept"]
    assert rows(neardup.near_duplicates(empty(docs))) == []


def test_probability_jaccard_and_registers():
    a, b = neardup.shingles("a b c d e f g h i j k"), neardup.shingles("a b c d e f g h i j x")
    assert neardup.probability_jaccard(a, b) == pytest.approx(6 / 8)
    h = np.random.default_rng(1).integers(1, 1 << 63, 60).astype(np.uint64)
    x, y = (h[:40], np.arange(1, 41)), (h[10:50], np.arange(5, 45))
    ox, oy = (tuple(v[np.argsort(k[0])] for v in k) for k in (x, y))
    exact = 0.0
    wx, wy = dict(zip(x[0].tolist(), x[1].tolist())), dict(zip(y[0].tolist(), y[1].tolist()))
    for d in set(wx) & set(wy):
        exact += 1 / sum(max(wx.get(e, 0) / wx[d], wy.get(e, 0) / wy[d]) for e in set(wx) | set(wy))
    assert neardup.probability_jaccard(ox, oy) == pytest.approx(exact)
    sig = neardup.signatures([ox, oy], 4096)
    assert (sig[0] == sig[1]).mean() == pytest.approx(exact, abs=0.04)


def test_fingerprints_against_direct(spark, docs):
    import hashlib
    got = rows(fingerprints.neighbour_fingerprints(docs))
    order = sorted(((r["doc_id"] is not None, r["doc_id"] or 0), r["text"] or "") for r in rows(docs))
    texts = [t for _, t in order]
    want = {}
    for i, t in enumerate(texts):
        n = texts[(i + 1) % len(texts)]
        e = fingerprints.edited(t, n)
        fp = [fingerprints.fingerprint_lanes(v.split("\n")) for v in (t, e, n)]
        want.setdefault(order[i][0][1] if order[i][0][0] else None, []).append(
            (len(t), hashlib.sha256(e.encode()).hexdigest(), fingerprints.encode(fp[0]), fingerprints.encode(fp[1]),
             fingerprints.likeness(fp[0], fp[1]), fingerprints.likeness(fp[0], fp[2])))
    have = {}
    for r in got:
        have.setdefault(r["doc_id"], []).append(tuple(r[c] for c in fingerprints.NAMES[1:]))
    assert {k: sorted(v) for k, v in have.items()} == {k: sorted(v) for k, v in want.items()}
    one = fingerprints.fingerprint_lanes
    assert fingerprints.encode(one(["a", "b", "a"])) == fingerprints.encode(one(["a", "a", "b"]))
    assert fingerprints.encode(fingerprints.subtract(one(["a", "b"]), one(["b"]))) == fingerprints.encode(one(["a"]))
    assert rows(fingerprints.neighbour_fingerprints(empty(docs))) == []


def test_token_counts_match_library(spark, docs):
    from tokenizers import Tokenizer
    path = public_tokenizers.path("byte_bpe_50k.json")
    tok = Tokenizer.from_file(path)
    odd = ["  a", "a\n\nb", "\t\tx \t y", "a\x85b\xa0 c \x1c d", "<|endoftext|>x <|endoftext|>", "don't I'll 've 123abc ４５ ñ",
           "a" * 3000, " 　  x", "\U0001F600 abc", "x  \n  y ", "᠎ ​ a", "﻿hi"]
    df = docs.select("text").union(spark.createDataFrame([(t,) for t in odd], "text string")).withColumn("n_tokens", F.lit("clash"))
    for r in rows(tokens.count_tokens(df, path)):
        assert r["n_tokens"] == len(tok.encode(r["text"] or "", add_special_tokens=False).ids), r["text"]


def test_lm_counts_and_losses(spark, docs):
    df = docs.withColumn("good", F.col("lang") == "en")
    t, b = lm.corpus_counts(df, "text", "good")
    for hit, got in ((True, t), (None, b)):
        want = np.zeros(lm.CELLS, np.int64)
        for r in rows(df):
            if r["text"] and (hit is None or r["good"] is True):
                np.add.at(want, lm.grams(r["text"].encode()), 1)
        assert (got == want).all()
    p = np.exp(-lm.losses(t)).reshape(-1, lm.SYMBOLS)
    assert np.allclose(p.sum(1), 1)
    out = rows(lm.score(df, (t, b)))
    assert len(out) == docs.count() and {r["score"] for r in out if not r["text"]} == {0.0}
    french = next(r for r in out if r["doc_id"] == 6)
    english = next(r for r in out if r["doc_id"] == 1)
    assert english["score"] < french["score"]
    rows(lm.score(empty(docs), lm.corpus_counts(df.filter("false"), "text", "good")))


def test_plain_words_are_those_of_the_full_pattern():
    from recbrook.llm import wordlm
    rng = random.Random(8)
    alphabet = [chr(c) for c in range(0x2E80) if not 0xD800 <= c < 0xE000]
    texts = ["".join(rng.choices(alphabet, k=400)) for _ in range(300)]
    texts += ["a\x1cb\x85c\xa0d\u2028e don’t 3½ ÉÀx\u0301", "漢字 kana カナ x", "", "\ud800 a", "\U0001f600 smile é"]
    texts += [t + "語" for t in texts[:20]]
    for t in texts:
        assert wordlm.tokens(t) == wordlm._TOKEN(t)
    assert wordlm._BEYOND("語") and not wordlm._BEYOND(texts[0])


def test_word_lm_matches_direct_counts(spark, docs, monkeypatch):
    from collections import Counter
    from recbrook.llm import wordlm
    monkeypatch.setattr(wordlm, "BLOCK", 2000)  # several blocks and ranges
    monkeypatch.setattr(wordlm, "RANGE", 20_000)
    more = [(100 + i, t, None, None, None) for i, t in enumerate(
        ["кот сидит дома", "кот спит дома", "дом стоит тут", "漢字の文", "字漢の文", "in 1999", "in 2024"])]
    df = docs.unionByName(spark.createDataFrame(more, docs.schema))
    good = spark.createDataFrame([(1,), (3,), (3,), (100,), (103,), (105,), (None,), (999,)], "doc_id long")
    marks = {1, 3, 100, 103, 105}
    texts = [(r["doc_id"], ["<s>", *wordlm.tokens(r["text"]), "</s>"]) for r in rows(df) if r["text"]]
    loss = []
    for of in ([w for i, w in texts if i in marks], [w for _, w in texts]):
        c, ctx, pair = Counter(), Counter(), Counter()
        for w in of:
            c.update(w[1:])
            ctx.update(w[:-1])
            pair.update(zip(w, w[1:]))
        size = len({x for _, w in texts for x in w[1:]})
        p = lambda x, c=c, s=size: (c[x] + 1) / (sum(c.values()) + s + 1)
        loss.append(lambda w, p=p, ctx=ctx, pair=pair: np.mean([-np.log(
            (pair[h, x] + wordlm.PRIOR * p(x)) / (ctx[h] + wordlm.PRIOR)) for h, x in zip(w, w[1:])]))
    got = rows(wordlm.score(df, good))
    assert len(got) == df.count() and sorted(r["n_symbols"] for r in got if r["n_symbols"]) == sorted(len(w) - 1 for _, w in texts)
    by = {(r["doc_id"], r["n_symbols"]): r for r in got}
    for i, w in texts:
        r = by[i, len(w) - 1]
        assert r["target"] == (i in marks)
        assert r["target_loss"] == pytest.approx(loss[0](w)) and r["background_loss"] == pytest.approx(loss[1](w))
    assert {r["score"] for r in got if not r["n_symbols"]} == {0.0}
    at = {r["doc_id"]: r["score"] for r in got}
    assert at[100] < at[101] < at[102] and at[103] != at[104] and at[105] != at[106]  # alike as bytes, other words
    assert rows(wordlm.score(empty(docs), good)) == []


PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var x="</p><p>no";</script></head><body class="main-content">
<header><a href=/>Home</a> site name</header><nav><ul><li><a href="/a">One</a><li><a href="/b">Two</a></ul></nav>
<div class="cookie-notice">We use cookies to make this a longer and nicer sentence for you, dear reader of pages.</div>
<article><h1>Title &amp; more</h1><p>First <b>bold
 text</b> of&nbsp;it, caf&eacute; &#233;.<p>Second.<br>line <!-- hidden --> done<form><input> sign up here</form>
<div id="ad-7">Buy this now and be happy</div><p>Last words <a href="x">here</a>.</p></article>
<section id="comments"><p>I liked this article a lot and this is my very long comment about all of it.</p></section>
<aside>Related stories</aside><footer>&copy; 2020</footer></body></html>"""


def test_html(spark):
    tree = html.train_tree()
    assert all(html.classify(tree, r[:7]) == r[7] for r in html.LABELLED)
    df = spark.createDataFrame([(1, "u", PAGE, "x"), (2, None, None, "x"), (3, "u", "", None), (4, "u", "<nav>a</nav", "x"),
                                (5, "u", "<p>" + "word " * 50_000, "x"), (1, "u", PAGE, "x")],
                               "page_id int, url string, html string, Text string")
    got = rows(html.extract_main_text(df.drop("Text")))
    by = {r["page_id"]: r["text"] for r in got}
    assert by[1] == "Title & more\nFirst bold text of it, café é.\nSecond. line done\nLast words here."
    assert by[2] == by[3] == by[4] == "" and by[5] == " ".join(["word"] * 50_000)
    assert len(rows(html.extract_main_text(df))) == 6  # a clashing column is replaced
    assert rows(html.extract_main_text(df.drop("Text").filter("false"))) == []


def test_html_names_are_no_shortcut():
    tree = html.train_tree()
    for attrs in ('style="overflow:hidden"', 'class="overflow-hidden"', 'title="The hidden cost"', "data-x='display: none'",
                  'class="content with-sidebar"', 'class="post share-enabled"'):
        page = f"<div {attrs}><article><p>The first paragraph of it.</p><p>And the second one.</p></article></div>"
        assert html.main_text(page, tree) == "The first paragraph of it.\nAnd the second one.", attrs
    assert html.main_text('<article><p>See <a href="/hidden-gems">the gems</a> of it.</p></article>', tree) == "See the gems of it."
    assert html.main_text('<div class="page-sidebar-left"><article><p>Whole text here.</p></article></div>', tree) == "Whole text here."
    assert html.main_text('<article><div class="entry-header"><h1>The title</h1></div><p>Text of it.</p></article>', tree) \
        == "The title\nText of it."
    for attrs in ("hidden", "hidden=''", 'style="color:red; display : none"', 'style="visibility:hidden"', 'aria-hidden="true"'):
        assert html.main_text(f"<article><p>Seen.</p><p {attrs}>Not seen.</p></article>", tree) == "Seen.", attrs
    assert html.main_text('<section id="comments"><article class="comment"><p>I like it.</p></article></section>', tree) == ""
    assert {(r[6], r[7]) for r in html.LABELLED} == {(0, 0), (1, 0), (1, 1), (2, 0), (2, 1)}  # no aside is content


def test_html_asides_after_long_paragraphs():
    tree = html.train_tree()
    para = "word " * 150
    for extra in ("<footer>Copyright someone 2020, all rights reserved</footer>", "<aside>Buy this now, it is cheap</aside>",
                  "<div class='comments'><p>" + "I liked this very much indeed. " * 20 + "</p><p>Me too</p></div>",
                  "<div class='ad-banner'>" + "offer " * 120 + "</div>", "<nav><a href=x>next</a> one</nav>",
                  "<section id='disqus'><p>" + "said " * 90 + "</p></section>"):
        for page in (f"<article><p>{para}</p></article>{extra}", f"<body><p>{para}</p>{extra}<p>{para}</p>",
                     f"<main><p>{para}</p>{extra}<p>{para}</p></main>"):
            kept = html.main_text(page, tree).split("\n")
            assert set(kept) == {para.strip()}, (extra, kept)


def test_no_aside_block_of_the_given_pages_is_kept(spark):
    tree = html.train_tree()
    leaks = 0
    for (page,) in spark.read.parquet("/root/testdata/sf0.1/pages.parquet").select("html").collect():
        found = html.blocks(page or "")
        for i, (_, words, linked, region) in enumerate(found):
            if region == html.BOILER:
                w0, l0 = (found[i - 1][1], found[i - 1][2]) if i else (0, 0)
                w1, l1 = (found[i + 1][1], found[i + 1][2]) if i + 1 < len(found) else (0, 0)
                leaks += html.classify(tree, (words, linked / words, w0, l0 / w0 if w0 else 0.0, w1, l1 / w1 if w1 else 0.0, region))
    assert leaks == 0


def test_likeness_of_long_repetitive_texts():
    """Sketch lanes hold counts past 16 bits: the same edit looks alike at any length."""
    got = []
    for n in (4_000, 40_000, 400_000):
        t = "a b c d " * n
        e = fingerprints.edited(t, "e f g h " * n)
        x, y = (fingerprints.fingerprint_lanes(v.split("\n")) for v in (t, e))
        got.append(fingerprints.likeness(x, y))
        assert fingerprints.encode(fingerprints.decode(fingerprints.encode(x))) == fingerprints.encode(x)
    assert max(got) - min(got) < 0.01 and got[0] > 0.8


def test_pipeline(spark):
    import corpus_pipeline as p
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    sf, here = "/root/testdata/sf0.001", docs
    for name, stage in p.STAGES[:-1]:
        after = stage(spark, here, sf)
        assert after.columns == docs.columns, name
        after = p.written(after, "test")
        if name == "language_id":
            assert after.count() == docs.filter(F.col("text").rlike(r"\p{L}")).count()
        if name == "line_dedup":
            assert after.count() == here.count()
        if name == "minhash_dedup":
            assert after.count() == neardup.near_duplicates(here).filter("kept").count()
        here = after
    total = p.run(spark, sf).agg(F.sum("length")).first()[0]
    assert total > 0


def test_pipeline_stages_with_clashing_columns(spark):
    """Extra columns of the stages' own names pass through; of rows of one id and
    text that differ elsewhere the same one stays every time."""
    import corpus_pipeline as p
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(60)
    extra = {c: F.lit(i) for i, c in enumerate(("__id", "__KEY", "__k", "__r", "__lang", "__score", "__n", "__size", "__times",
                                                "__copy", "__drop", "row"))}
    here = p.written(docs.withColumns(extra).unionByName(docs.limit(5).withColumns(extra).withColumn("source", F.lit("zz"))), "clash")
    once = p.minhash_dedup(spark, here, "")
    assert once.count() == once.select("doc_id").distinct().count() and once.filter("source = 'zz'").count() == 0
    for name, stage in p.STAGES[:-1]:
        after = p.written(stage(spark, here, ""), "clash")
        assert after.columns == here.columns and after.count() > 0, name
        here = after
