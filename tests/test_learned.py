"""Learned vectors, the candidate index, the joint ranker, merging and splits."""

import datetime as dt
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from recbrook.operators import content as CT, ivf, merge as MG, ranker as RK, split as SP
from recbrook.operators.metrics import auc


# ---- content vectors -----------------------------------------------------------------
TOPICS = {0: "river boat water fish".split(), 1: "piano song drum opera".split(), 2: "bread flour oven salt".split()}


def text(rng, topic):
    return " ".join(rng.choices(TOPICS[topic], k=8) + rng.choices("and the of with".split(), k=6))


def test_content_vectors_share_one_space(spark):
    rng = random.Random(1)
    posts = [(i, text(rng, i % 3)) for i in range(120)]
    users = [(i, posts[i][1]) for i in range(30)] + [(100 + i, text(rng, i % 3)) for i in range(30)]
    users += [(200, None), (201, ""), (202, "!!!"), (203, "unheard" + " words" * 3)]
    posts += [(300, "word " * 30_000), (301, None)]
    got = CT.content_embeddings(spark.createDataFrame(users, "uid long, text string"),
                                spark.createDataFrame(posts, "po_id long, text string"))
    v = {(r.side, r.id): np.array(r.embedding) for r in got.collect()}
    assert len(v) == len(users) + len(posts) and all(x.shape == (32,) and np.isfinite(x).all() for x in v.values())
    for i in range(30):  # the same text, the same vector, on either side
        assert np.allclose(v["user", i], v["post", i], atol=1e-6)
    assert not any(np.abs(v[k]).any() for k in (("user", 200), ("user", 201), ("user", 202), ("post", 301)))
    for i in range(30):
        near = max(range(120), key=lambda p: v["user", 100 + i] @ v["post", p])
        assert near % 3 == i % 3
    assert math.isclose(np.linalg.norm(v["post", 0]), 1, abs_tol=1e-5)


def test_content_model_is_the_svd(spark):
    """On a small corpus the projection is that of the exact singular vectors."""
    rng = random.Random(2)
    rows = [("post", i, " ".join(rng.choices([f"t{j}" for j in range(30)], [1 / (j + 1) for j in range(30)], k=25))) for i in range(80)]
    texts = spark.createDataFrame(rows, "side string, id long, text string")
    terms = {r.term: np.array(r.v) for r in CT.fit_terms(texts, dim=4).collect()}
    names = sorted(terms)
    tf = np.array([[t.split().count(n) for n in names] for _, _, t in rows], float)
    x = np.where(tf > 0, 1 + np.log(np.maximum(tf, 1)), 0)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    idf = np.log(81 / (1 + (tf > 0).sum(0))) + 1
    _, _, vt = np.linalg.svd(x * idf, full_matrices=False)
    got = np.stack([terms[n] for n in names]) / idf[:, None]
    # 30 terms fit in the sketch: the spans agree.
    q, _ = np.linalg.qr(got)
    assert np.allclose(np.linalg.svd(q.T @ vt[:4].T)[1], 1, atol=1e-6)


def test_content_of_nothing(spark):
    none = spark.createDataFrame([], "uid long, text string")
    posts = spark.createDataFrame([(1, ""), (2, None)], "po_id long, text string")
    assert [(r.side, r.id, set(r.embedding)) for r in CT.content_embeddings(none, posts).orderBy("id").collect()] == [
        ("post", 1, {0.0}), ("post", 2, {0.0})]


def test_content_blocks_cut_repeated_ids_and_no_row_per_text_and_term(spark, monkeypatch):
    rng = random.Random(7)
    rows = [("post" if i % 2 else "user", i, text(rng, i % 3)) for i in range(60)]
    rows += [("post", 1, "piano piano"), ("user", None, "salt oven"), ("user", None, "fish"), ("post", 500, "late " * 40), ("post", 501, None),
             ("post", 2 ** 60 + 1, "boat")]
    df = spark.createDataFrame(rows, "side string, id long, text string").repartition(3)
    merged = {}
    for s, i, t in rows:
        merged[s, i] = f"{merged.get((s, i), '')} {t or ''}"
    whole = spark.createDataFrame([(*k, t) for k, t in merged.items()], "side string, id long, text string").coalesce(1)
    want = {(r.side, r.id): np.array(r.embedding) for r in CT.project(whole, CT.fit_terms(whole)).collect()}
    monkeypatch.setattr(CT, "BLOCK", 50)
    monkeypatch.setattr(CT, "ENTRIES", 11)
    blocks = CT.text_blocks(df).collect()
    assert len(blocks) > 10 and len({b.block for b in blocks}) == len(blocks) and sum(len(b.id) for b in blocks) == len(merged)
    got = {(r.side, r.id): np.array(r.embedding) for r in CT.project(df, CT.fit_terms(df)).collect()}
    assert set(got) == set(want) and not got["user", None].any() and not got["post", 501].any()
    assert all(np.allclose(got[k], want[k], atol=1e-6) for k in want)


def test_content_ranges_of_terms_give_what_one_gives_and_blocks_bound_their_texts(spark, monkeypatch):
    """Terms mostly met in one text, as order numbers are, summed in many ranges; very many texts
    of a word are several blocks."""
    rng = random.Random(11)
    posts = [(i, f"{text(rng, i % 3)} {100_000 + i} {200_000 + i // 2}") for i in range(90)] + [(None, "salt oven")]
    users = [(i, "boat" if i % 2 else "drum") for i in range(300)]
    u, p = spark.createDataFrame(users, "uid long, text string"), spark.createDataFrame(posts, "po_id long, text string")
    of = lambda: {(r.side, r.id): np.array(r.embedding) for r in CT.content_embeddings(u, p).collect()}
    want = of()
    assert len(want) == 391 and not want["post", None].any()
    texts = u.select(F.lit("user").alias("side"), F.col("uid").alias("id"), "text").coalesce(1)
    monkeypatch.setattr(CT, "BLOCK", 1_000)
    assert max(len(b.id) for b in CT.text_blocks(texts).collect()) <= 1_000 // CT.PER_TEXT + 1
    monkeypatch.setattr(CT, "RANGE", 20)
    parts, rank = CT._ranges(CT.text_blocks(texts.unionByName(p.select(F.lit("post").alias("side"), F.col("po_id").alias("id"), "text"))), names=False)
    assert parts.filter("block < 0").count() > 5 and rank <= CT.SKETCH  # a Gram matrix a range
    got = of()
    assert set(got) == set(want) and all(np.allclose(got[k], want[k], atol=2e-6) for k in want)


# ---- index ---------------------------------------------------------------------------
def vectors(spark, n, seed, dim=32, latent=6):
    """Vectors of unequal length on a few latent directions, as learned ones are."""
    rng = np.random.default_rng(seed)
    mix = np.random.default_rng(0).normal(size=(latent, dim))
    x = rng.normal(size=(n, latent)) @ mix / math.sqrt(latent) + 0.05 * rng.normal(size=(n, dim))
    import pandas as pd
    return spark.createDataFrame(pd.DataFrame({"id": np.arange(n), "embedding": list(x)}), "id long, embedding array<double>")


def test_index_recall_and_work_at_three_sizes(spark, tmp_path):
    users = vectors(spark, 64, 7)
    scored = {}
    for n in (2_500, 25_000, 200_000):
        index = ivf.build_index(vectors(spark, n, 8), str(tmp_path / str(n)))
        assert index.posts.count() == n == index.posts.select("post_id").distinct().count()
        probes, recall = ivf.choose_probes(index, users, k=10, wanted=0.95)
        found = ivf.search(ivf.open_index(spark, index.path), users, 10, probes)  # as reopened
        exact = ivf.brute_force(users, index, 10)
        assert recall >= 0.9 and ivf.recall_of(found, exact) >= 0.9
        assert found.groupBy("user_id").count().filter("count = 10").count() == 64
        scored[n] = ivf.probed_cells(index, users, probes).agg(F.sum("n")).first()[0] / 64
    assert scored[200_000] < 2.5 * scored[25_000] and scored[200_000] < 0.1 * 200_000


def test_index_odd_vectors(spark, tmp_path):
    same = [(i, [1.0, 0.0]) for i in range(700)] + [(1000, [0.0, 3.0]), (1001, [0.0, 0.0]), (1002, None)]
    index = ivf.build_index(spark.createDataFrame(same, "id long, embedding array<double>"), str(tmp_path / "a"))
    users = spark.createDataFrame([(1, [0.0, 1.0]), (2, [1.0, 0.0]), (3, [0.0, 0.0]), (4, None)], "id long, embedding array<double>")
    got = {(r.user_id, r["rank"]): (r.post_id, r.score) for r in ivf.search(index, users, 2, 64).collect()}
    assert got[1, 1] == (1000, 3.0) and got[2, 1] == (0, 1.0) and got[2, 2] == (1, 1.0) and (4, 1) not in got
    none = ivf.build_index(spark.createDataFrame([], "id long, embedding array<double>"), str(tmp_path / "b"))
    assert ivf.search(none, users, 2, 4).collect() == [] and ivf.choose_probes(none, users)[1] == 1.0


def test_cells_of_users_are_ranked_in_bounded_slices(spark, tmp_path, monkeypatch):
    """No task makes more than ``ROWS`` rows at once, and the cells are the same."""
    index, users = ivf.build_index(vectors(spark, 3_000, 8), str(tmp_path / "i"), cell=16), vectors(spark, 200, 7)
    cells = lambda: {tuple(r) for r in ivf.ranked_cells(index, users, 6).select("user_id", "coarse", "fine", "rank").collect()}
    want = cells()
    monkeypatch.setattr(ivf, "ROWS", 64)
    ranked = ivf.ranked_cells(index, users, 6)
    assert {tuple(r) for r in ranked.select("user_id", "coarse", "fine", "rank").collect()} == want
    sliced = []
    monkeypatch.setattr(ivf, "_per_slice", lambda c, s, of=ivf._per_slice: sliced.append(s) or of(c, s))
    ivf.ranked_cells(index, users, 6)
    assert sliced[0].agg(F.sum("slices")).first()[0] >= 200 * 6 * 6 / 64 / 2


def test_index_moves_vectors_as_given(spark, tmp_path):
    """Floats stay floats on disk and in the rows of (user, cell), and find what doubles of them find."""
    posts, users = (vectors(spark, n, seed).withColumn("embedding", F.col("embedding").cast("array<float>")) for n, seed in ((3_000, 8), (100, 7)))
    wide = lambda df: df.withColumn("embedding", F.col("embedding").cast("array<double>"))
    index = ivf.build_index(posts, str(tmp_path / "f"), cell=64)
    assert index.posts.schema["p"].dataType.simpleString() == "array<float>"
    assert [t for _, t in spark.read.parquet(str(tmp_path / "f" / "staged")).dtypes if t.startswith("array")] == ["array<float>"]
    assert ivf.ranked_cells(index, users, 4).schema["u"].dataType.simpleString() == "array<float>"
    again = ivf.build_index(wide(posts), str(tmp_path / "d"), cell=64)
    rows = lambda i, u: sorted(map(tuple, ivf.search(i, u, 10, 4).collect()))
    assert rows(index, users) == rows(again, wide(users))


# ---- ranker --------------------------------------------------------------------------
def planted(spark, n, seed):
    """Whether the vectors agree in sign of two products: no linear signal."""
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 4 + 4 + 4 + 7 + 2))
    x[:, -2:] = 1
    y = ((x[:, 0] * x[:, 4] + x[:, 9] * x[:, 13] > 0)).astype(int)
    import pandas as pd
    return spark.createDataFrame(pd.DataFrame({"features": list(x), "label": y, "weight": y * 1.0}),
                                 "features array<double>, label int, weight double")


def test_joint_ranker_finds_what_the_wide_part_cannot(spark, tmp_path):
    shape = RK.Shape(4, 4, 4, 7)
    fit, held = planted(spark, 6000, 1), planted(spark, 3000, 2)

    def held_auc(model):
        return auc(RK.predict(model, held, ["label"]).withColumnRenamed("probability", "score")).first().auc

    joint = RK.fit(fit, shape, epochs=10, batch_rows=1500, path=str(tmp_path / "joint"))
    wide = RK.fit(fit, shape, epochs=4, batch_rows=1500, wide_only=True)
    a, b = held_auc(joint), held_auc(wide)
    assert a > 0.7 and a > b + 0.05
    # An interrupted fit goes on from its last epoch to the same weights.
    again = RK.fit(fit, shape, epochs=10, batch_rows=1500, path=str(tmp_path / "joint"))
    assert np.array_equal(again.flat, joint.flat)
    loaded, _ = RK.load(spark, str(tmp_path / "joint"), 10)
    assert np.array_equal(loaded.flat, joint.flat) and loaded.shape == shape


def test_ranker_gradient_is_the_derivative():
    shape = RK.Shape(3, 3, 2, 2)
    rng = np.random.default_rng(3)
    x, y, w = rng.normal(size=(6, 12)), rng.integers(0, 2, 6).astype(float), rng.uniform(1, 3, 6)
    flat = RK.start(shape, 4) + 0.01 * rng.normal(size=len(RK.start(shape, 4)))
    _, g = RK.gradient(shape, flat, x, y, w)
    for i in rng.choice(len(flat), 40, replace=False):
        up, down = flat.copy(), flat.copy()
        up[i] += 1e-6
        down[i] -= 1e-6
        num = (RK.gradient(shape, up, x, y, w)[0] - RK.gradient(shape, down, x, y, w)[0]) / 2e-6
        assert abs(num - g[i]) < 1e-4 * max(1, abs(num))


def test_ranker_keeps_the_rows_as_floats(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(RK, "scratch_path", lambda _, name: str(tmp_path / "work"))
    shape = RK.Shape(4, 4, 4, 7)
    rows = planted(spark, 300, 1).withColumn("features", F.col("features").cast("array<float>"))
    narrow = RK.fit(rows, shape, epochs=1)
    assert spark.read.parquet(str(tmp_path / "work" / "rows")).schema["x"].dataType.simpleString() == "array<float>"
    assert np.isfinite(narrow.flat).all() and (narrow.flat != RK.start(shape, 9)).any()


def test_ranker_plans_a_batch_once_for_all_epochs(spark, monkeypatch):
    rows, planned = planted(spark, 6000, 1), []
    frame = type(rows)
    monkeypatch.setattr(frame, "mapInArrow", lambda self, *a, f=frame.mapInArrow, **k: planned.append(1) or f(self, *a, **k))
    RK.fit(rows, RK.Shape(4, 4, 4, 7), epochs=3, batch_rows=1500)
    assert len(planned) <= 5  # four batches and the means; a plan a step were 13
    assert not spark.sparkContext._jsc.getPersistentRDDs()


# ---- merging and cold start ------------------------------------------------------------
def test_merge_by_quantiles_and_fill_up(spark):
    a = spark.createDataFrame([(1, p, float(p)) for p in range(100)], "user_id long, post_id long, score double")
    b = spark.createDataFrame([(1, p, p / 1e6) for p in range(50, 150)] + [(2, 7, 9e-5)], "user_id long, post_id long, score double")
    got = {(r.user_id, r.post_id): r for r in MG.merge_spaces({"a": a, "b": b}).collect()}
    assert got[1, 99].quantile == 1.0 and got[1, 99].spaces == ["a", "b"] and got[1, 149].quantile == 1.0
    assert got[1, 0].quantile < 0.02 and got[1, 149].spaces == ["b"]
    users = spark.createDataFrame([(1,), (2,), (3,)], "user_id long")
    posts = spark.createDataFrame([(p,) for p in range(20)], "po_id long")
    seen = spark.createDataFrame([(4, 2.0), (4, 1.0), (9, 2.0), (999, 50.0)], "post_id long, weight double")
    pop = MG.popular_posts(posts, seen, 3)
    assert sorted(r.post_id for r in pop.collect()) == [0, 4, 9]
    full = MG.fill_up(MG.merge_spaces({"a": a, "b": b}), users, pop, 3)
    n = {r.user_id: r["count"] for r in full.groupBy("user_id").count().collect()}
    assert n[3] == 3 and n[2] == 4 and n[1] == 150


def test_recommend_reaches_cold_users_and_posts(spark):
    """Every user gets k rows, those without interactions too, and posts without
    any interaction are found by their content."""
    from recbrook.plans import recommend as RC
    from conftest import SF_SMALL
    got = RC.recommend_with_spaces(spark, SF_SMALL, k=5, n_candidates=10).cache()
    r = RC.Ranking.load(spark, SF_SMALL)
    users = r.x.profile.select("uid")
    assert {x["count"] for x in got.groupBy("user_id").count().collect()} == {5}
    assert got.select("user_id").distinct().count() == users.count()
    active = r.split.filter("weight > 0 and not held_out").select("user_id").distinct()
    assert got.join(active, "user_id", "left_anti").count() > 0
    cold = got.join(r.split.filter("weight > 0").select("post_id"), "post_id", "left_anti")
    assert cold.count() > 0 and "content" in {s for x in cold.collect() for s in x.spaces}


# ---- splits ------------------------------------------------------------------------------
def test_temporal_split_and_user_auc(spark):
    t = dt.datetime(2024, 1, 1)
    rows = [(i, 1, i, t + dt.timedelta(hours=i % 5), 1.0) for i in range(10)] + [(20, 2, 3, None, 2.0)]
    rows += [(None, 1, p, None, 0.0) for p in range(50)] + [(30, None, 3, t, 1.0)]
    df = spark.createDataFrame(rows, "event_id long, user_id long, post_id long, interaction_time timestamp_ntz, weight double")
    got = SP.temporal_split(df).collect()
    assert len(got) == len(rows)
    assert sorted(r.event_id for r in got if r.held_out and r.weight > 0) == [4, 9, 20, 30]
    assert sorted(r.post_id for r in got if r.held_out and r.weight == 0) == [p for p in range(50) if (31 + 17 * p) % 5 == 0]
    rng = random.Random(5)
    scored = [(rng.randrange(6), rng.randrange(8) / 4, rng.randrange(2)) for _ in range(200)] + [(9, 1.0, 1)]
    want = {}
    for u in range(6):
        pos, neg = ([s for w, s, y in scored if w == u and y == v] for v in (1, 0))
        want[u] = sum((p > q) + (p == q) / 2 for p in pos for q in neg) / (len(pos) * len(neg))
    out = {r.user_id: r.auc for r in SP.user_auc(spark.createDataFrame(scored, "user_id long, score double, label int")).collect()}
    assert out == pytest.approx(want)


def test_diverse_lists_equal_brute_force(spark):
    from recbrook.operators.retrieval import retrieve_diverse
    rng = np.random.default_rng(4)
    us, ps = rng.normal(size=(20, 5)), rng.normal(size=(300, 5))
    uv = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(us)], "id long, embedding array<double>")
    pv = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(ps)], "id long, embedding array<double>")
    cl = spark.createDataFrame([(i, int(i % 7 if i < 250 else 0)) for i in range(300)], "post_id long, cluster int")
    got = sorted((r.user_id, r["rank"], r.post_id, r.cluster) for r in retrieve_diverse(uv, pv, cl, 10, 2).collect())
    want = []
    for u in range(20):
        best = []
        for c in range(7):
            best += sorted((-float(ps[i] @ us[u]), i, c) for i in range(300) if (i % 7 if i < 250 else 0) == c)[:2]
        want += [(u, r, i, c) for r, (_, i, c) in enumerate(sorted(best)[:10], 1)]
    assert got == sorted(want)


# ---- published examples, logins, points -----------------------------------------------------
def test_readers_see_whole_versions_only(spark, tmp_path):
    from recbrook.plans import job
    out = str(tmp_path / "examples")
    with pytest.raises(FileNotFoundError):
        job.read_published(spark, out)
    one = {n: spark.range(3) for n in job.TABLES}
    first = job.publish(one, out)
    # A job that died half way: some tables, no list.
    spark.range(9).write.parquet(f"{out}/version=99999999999999999-dead/users")
    assert job.newest_version(spark, out) == first
    second = job.publish({n: spark.range(5) for n in job.TABLES}, out)
    assert second > first and {n: t.count() for n, t in job.read_published(spark, out).items()} == {n: 5 for n in job.TABLES}


def test_login_gaps_of_a_hot_user(spark):
    from recbrook.operators import users as U
    t = dt.datetime(2024, 1, 1)
    rng = random.Random(3)
    rows = [(1, t + dt.timedelta(seconds=rng.randrange(10_000))) for _ in range(400)]
    rows += [(u, t + dt.timedelta(seconds=rng.randrange(100))) for u in range(2, 60) for _ in range(u % 4)]
    rows += [(None, t), (5, None), (77, t), (78, t), (78, t)]
    df = spark.createDataFrame(rows, "uid long, ts timestamp_ntz").repartition(5)
    want, freq = [], {}
    for u in sorted({u for u, x in rows if u is not None}):
        ts = sorted(x for v, x in rows if v == u and x is not None)
        gaps = [int((b - a).total_seconds()) for a, b in zip(ts, ts[1:])]
        want += [(u, i, g) for i, g in enumerate(gaps)]
        if gaps:
            pos = [math.log(g) for g in gaps if g > 0]
            freq[u] = math.exp(sum(pos) / len(pos)) if pos else 0.0
    assert sorted(tuple(r) for r in U.login_gaps(df).collect()) == want
    plan = U.login_frequency_by_user(df)
    assert "collect_list" not in plan._jdf.queryExecution().toString()
    assert {r.uid: r.login_frequency for r in plan.collect()} == pytest.approx(freq)
    none = spark.createDataFrame([], "uid long, ts timestamp_ntz")
    assert U.login_gaps(none).collect() == []


def test_malformed_points_are_marked(spark):
    from recbrook.functions.geo import decode_wkb_point
    from recbrook.operators import geo
    good = ["0101000000000000000000F03F0000000000000040", "00000000013ff00000000000004000000000000000",
            "0101000020E6100000000000000000F03F0000000000000040", "0020000001000010E63FF00000000000004000000000000000"]
    bad = ["", "01", "zz" * 21, good[0][:-1], good[0][:-2], good[0] + "00", "0102" + good[0][4:], "02" + good[0][2:], "é" * 42,
           good[0][:-1] + "G"]
    df = spark.createDataFrame([(i, h) for i, h in enumerate(good + bad)] + [(99, None)], "uid long, lat_long string")
    got = {r.uid: (r.lon, r.lat, r.rejected) for r in geo.read_points(df).collect()}
    for i, h in enumerate(good):
        assert got[i] == (*decode_wkb_point(bytes.fromhex(h)), False)
    assert all(got[len(good) + i] == (1.0, 1.0, True) for i in range(len(bad))) and got[99] == (1.0, 1.0, False)
    assert tuple(geo.rejected_points(df).first()) == (len(good) + len(bad) + 1, len(bad))
