"""Literal rows for the cases the synthetic tables do not cover, and
property checks of the operators."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from recbrook.functions.arrays import array_mean_or_zero, prepend
from recbrook.functions.geo import decode_wkb_point
from recbrook.operators import clean, collabs, encode, geo, interactions as I, metrics, posts, scale
from recbrook.operators import users as U
from recbrook.operators.ordering import global_index, running_sum_before
from recbrook.operators.retrieval import retrieve_topk

T = dt.datetime
_RND = random.Random(3)


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


# ---- login interval / frequency -------------------------------------------------
def test_login_intervals_edge_cases(spark):
    df = spark.createDataFrame([
        (1, [T(2024, 1, 1)]),                                                   # one login
        (2, [T(2024, 1, 1), T(2024, 1, 1)]),                                    # zero gap
        (3, [T(2024, 1, 1, 0, 0, 0, 900000), T(2024, 1, 1, 0, 0, 2, 100000)]),  # fractions
        (4, [T(2024, 1, 3), T(2024, 1, 1), T(2024, 1, 2)]),                     # unsorted
        (5, None),
    ], "uid long, login_times array<timestamp_ntz>")
    iv = rows(U.login_intervals(df), "uid", "i", "interval")
    assert iv == [(2, 0, 0), (3, 0, 1), (4, 0, -172800), (4, 1, 86400)]
    fr = dict(rows(U.user_login_frequency(df), "uid", "login_frequency"))
    assert fr[1] is None and fr[5] is None
    assert fr[2] == 0.0                      # all gaps zero: matched, COALESCE -> 0
    assert fr[3] == pytest.approx(1.0)
    assert fr[4] == pytest.approx(86400.0)   # array order kept; the negative gap has no LN


def test_geometric_mean(spark):
    df = spark.createDataFrame([(1, [T(2024, 1, 1), T(2024, 1, 1, 0, 0, 10), T(2024, 1, 1, 0, 0, 50)])],
                               "uid long, login_times array<timestamp_ntz>")
    (v,) = [r.login_frequency for r in U.user_login_frequency(df).collect()]
    assert v == pytest.approx(math.exp((math.log(10) + math.log(40)) / 2))


# ---- array aggregates ---------------------------------------------------------------
def test_project_titles_membership(spark):
    users = spark.createDataFrame([(1,), (2,), (3,)], "uid long")
    cb = spark.createDataFrame([
        (10, 1, "b", [2, 2]),      # uid 2 listed twice: matches once
        (11, 2, "a", [1]),
        (12, 3, "a", None),        # NULL team: owner is not a member either
    ], "collab_id long, owner_uid long, title string, team_uids array<long>")
    got = dict(rows(collabs.user_project_titles(users, cb), "uid", "project_titles"))
    assert got == {1: ["a", "b"], 2: ["a", "b"], 3: None}


def test_prepend_null(spark):
    df = spark.createDataFrame([(1, None), (2, [5])], "o long, t array<long>")
    got = dict(rows(df.select("o", prepend(F.col("o"), F.col("t")).alias("m")), "o", "m"))
    assert got == {1: None, 2: [2, 5]}


def test_post_comments_order_and_empty(spark):
    p = spark.createDataFrame([(1,), (2,)], "po_id long")
    c = spark.createDataFrame([(1, 2, "z"), (1, 0, "x"), (1, 1, "x")], "po_id long, turn long, content string")
    got = dict(rows(posts.post_comments(p, c), "po_id", "comments"))
    assert got == {1: ["x", "x", "z"], 2: None}


# ---- recent titles -----------------------------------------------------------------
def test_recent_titles_limit_ties_and_nulls(spark):
    keys = spark.createDataFrame([(1,), (2,)], "uid long")
    pt = spark.createDataFrame([(i, f"t{i}") for i in range(20)], "po_id long, title string")
    base = T(2024, 1, 1)
    data = [(1, i, base + dt.timedelta(hours=i)) for i in range(12)]
    data += [(1, 15, None), (1, 14, base + dt.timedelta(hours=11))]  # tie at the top, NULL time
    it = spark.createDataFrame(data, "user_id long, post_id long, interaction_time timestamp_ntz")
    got = dict(rows(U.user_recent_titles(keys, it, pt), "uid", "recent_titles"))
    assert got[1] == ["t11", "t14", "t10", "t9", "t8", "t7", "t6", "t5", "t4", "t3"]
    assert got[2] is None


# ---- mean view time, CTR --------------------------------------------------------------
def test_array_mean_nulls_count_in_divisor(spark):
    df = spark.createDataFrame([(1, [1.0, None, 3.0]), (2, []), (3, None)], "k int, a array<double>")
    got = dict(rows(df.select("k", array_mean_or_zero(F.col("a")).alias("m")), "k", "m"))
    assert got == {1: pytest.approx(4 / 3), 2: 0.0, 3: 0.0}


def test_ctr_zero_cases(spark):
    keys = spark.createDataFrame([(1,), (2,), (3,)], "po_id long")
    fed = spark.createDataFrame([(7, 1), (8, 1)], "user_id long, post_id long")   # post 1 fed, never viewed
    it = spark.createDataFrame([(7, 2, "view"), (7, 2, "view")],                # post 2 viewed, never fed
                               "user_id long, post_id long, interaction_type string")
    got = {r.po_id: (r.fed_users, r.viewers, r.ctr) for r in posts.post_ctr(keys, fed, it).collect()}
    assert got == {1: (2, 0, None), 2: (0, 1, 0.0), 3: (0, 0, None)}


# ---- scaling ----------------------------------------------------------------------
def test_scaling_zero_variance_nulls_single_row(spark):
    df = spark.createDataFrame([(1, 5.0, 1.0), (2, 5.0, None), (3, 5.0, 3.0)], "k int, a double, b double")
    got = {r.k: (r.a, r.b) for r in scale.standard_scale(df, ["a", "b"]).collect()}
    assert got == {1: (0.0, -1.0), 2: (0.0, None), 3: (0.0, 1.0)}
    one = spark.createDataFrame([(1, 2.0)], "k int, a double")
    assert scale.standard_scale(one, ["a"]).first().a == 0.0


# ---- WKB ----------------------------------------------------------------------------
def test_wkb_literals():
    assert decode_wkb_point(bytes.fromhex("0101000000000000000000F03F0000000000000040")) == (1.0, 2.0)
    assert decode_wkb_point(bytes.fromhex(
        "0101000020E6100000000000000000F03F0000000000000040")) == (1.0, 2.0)
    assert decode_wkb_point(bytes.fromhex("00000000013FF00000000000004000000000000000")) == (1.0, 2.0)


def test_wkb_udf_and_default(spark):
    df = spark.createDataFrame([(1, "0101000000000000000000F03F0000000000000040"), (2, None)],
                               "uid long, lat_long string")
    got = {r.uid: (r.lon, r.lat) for r in geo.decode_points(df).collect()}
    assert got == {1: (1.0, 2.0), 2: (1.0, 1.0)}


def test_rbf_range(spark):
    df = spark.createDataFrame([(i, float(i % 7), float(i % 5)) for i in range(30)], "uid long, lat double, lon double")
    sp = geo.scaled_points(geo.points(df))
    vals = [v for r in geo.geo_rbf(sp, geo.rbf_centers(sp)).collect() for v in r.geo_rbf]
    assert len(vals) == 30 * geo.NUM_CENTERS and all(0.0 < v <= 1.0 for v in vals)


# ---- encoding ---------------------------------------------------------------------
def test_encode_empty_unknown_truncated_padded(spark):
    vocab = spark.createDataFrame([("a", 4, 9), ("b", 5, 3)], "token string, token_id int, n long")
    df = spark.createDataFrame([(1, ""), (2, "a zz B"), (3, "a a a a a a a a")], "k long, t string")
    enc = encode.encode(df, "k", {"t": 5}, vocab)
    got = dict(rows(enc, "k", "t"))
    assert got == {1: [2, 3], 2: [2, 4, 1, 5, 3], 3: [2, 4, 4, 4, 3]}
    padded = dict(rows(encode.pad(enc, {"t": 5}), "k", "t"))
    assert padded[1] == [2, 3, 0, 0, 0] and len({len(v) for v in padded.values()}) == 1


def test_vocabulary_order(spark):
    texts = spark.createDataFrame([("b a, a; c",), ("B",)], "text string")
    got = rows(encode.build_vocabulary(texts), "token_id", "token", "n")
    assert got == [(4, "a", 2), (5, "b", 2), (6, "c", 1)]


# ---- ordering and metrics --------------------------------------------------------------
def test_global_index_and_running_sum(spark):
    df = spark.createDataFrame([(k, k % 3) for k in random.Random(1).sample(range(1000), 500)], "k long, v long")
    idx = rows(global_index(df, [F.col("k")]), "k", "idx")
    assert [i for _, i in idx] == list(range(500))
    rs = rows(running_sum_before(df, [F.col("k")], "v", "before"), "k", "v", "before")
    acc = 0
    for _, v, before in rs:
        assert before == acc
        acc += v


def _brute_auc(pairs):
    pos = [s for s, y in pairs if y == 1]
    neg = [s for s, y in pairs if y == 0]
    if not pos or not neg:
        return None
    tot = sum((1.0 if p > n else 0.5 if p == n else 0.0) for p in pos for n in neg)
    return tot / (len(pos) * len(neg))


@pytest.mark.parametrize("pairs", [
    [(0.5, 1), (0.5, 0), (0.5, 1), (0.5, 0)],             # all tied
    [(0.1, 1), (0.2, 1)],                                  # one class only
    [(_RND.random() // 0.1 / 10, _RND.random() < 0.4) for _ in range(200)],
])
def test_auc_matches_brute_force(spark, pairs):
    pairs = [(s, int(y)) for s, y in pairs]
    df = spark.createDataFrame(pairs, "score double, label int")
    got = metrics.auc(df).first().auc
    want = _brute_auc(pairs)
    assert (got is None and want is None) or got == pytest.approx(want)


def test_log_loss_clips(spark):
    df = spark.createDataFrame([(1.0, 0), (0.0, 1)], "probability double, label int")
    assert metrics.log_loss(df).first().log_loss == pytest.approx(-math.log(1e-7))


# ---- retrieval ----------------------------------------------------------------------------
def test_exact_topk_equals_brute_force(spark):
    rnd = random.Random(5)
    def vec(c):
        return [c[j] + rnd.gauss(0, 0.3) for j in range(8)]
    centres = [[rnd.gauss(0, 1) for _ in range(8)] for _ in range(4)]
    users = [(i, vec(centres[i % 4])) for i in range(40)]
    posts_ = [(i, vec(centres[i % 4])) for i in range(300)]
    uv = spark.createDataFrame(users, "id long, embedding array<double>")
    pv = spark.createDataFrame(posts_, "id long, embedding array<double>")
    got = rows(retrieve_topk(uv, pv, k=7, block_size=16), "user_id", "rank", "post_id")
    want = []
    for uid, u in users:
        sc = sorted(((-sum(a * b for a, b in zip(u, p)), pid) for pid, p in posts_))[:7]
        want += [(uid, r + 1, pid) for r, (_, pid) in enumerate(sc)]
    assert got == sorted(want)


def test_topk_prunes_clustered_vectors(spark):
    """On well-separated clusters of vectors of unequal norm, under a fifth of
    all pairs is scored."""
    from recbrook.operators.retrieval import candidate_clusters, second_pass
    rnd = random.Random(9)
    centres = [[rnd.gauss(0, 1) for _ in range(16)] for _ in range(25)]
    def vec(i):
        scale = rnd.uniform(0.9, 1.1)
        return [scale * (x + rnd.gauss(0, 0.02)) for x in centres[i % 25]]
    uv = spark.createDataFrame([(i, vec(i)) for i in range(100)], "id long, embedding array<double>")
    pv = spark.createDataFrame([(i, vec(i)) for i in range(1000)], "id long, embedding array<double>")
    bounds = candidate_clusters(uv, pv)[2]
    top = retrieve_topk(uv, pv, k=5)
    scored = (bounds.filter("before < 5").select("n").unionByName(second_pass(bounds, top, 5).select("n"))
              .agg(F.sum("n")).first()[0])
    assert scored < 0.2 * 100 * 1000


def test_topk_fewer_posts_than_k(spark):
    uv = spark.createDataFrame([(1, [1.0, 0.0])], "id long, embedding array<double>")
    pv = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0])], "id long, embedding array<double>")
    assert rows(retrieve_topk(uv, pv, k=5), "rank", "post_id") == [(1, 1), (2, 2)]


# ---- properties on the synthetic tables ------------------------------------------------------
def test_negatives_disjoint_from_interactions(spark):
    from recbrook.sources import derived as D
    d = "/root/testdata/sf0.001"
    it = D.interactions(spark, d)
    neg = I.negative_samples(I.fed_posts(D.users(spark, d)), it)
    assert neg.join(it, ["user_id", "post_id"]).count() == 0


def test_scaled_columns_mean_zero_std_one(spark):
    from recbrook.plans import features as FT
    d = "/root/testdata/sf0.001"
    sc = FT.scaled_post_features(FT.post_table(FT.Inputs.load(spark, d)))
    st = sc.agg(F.avg("post_length").alias("m"), F.stddev_pop("post_length").alias("s")).first()
    assert st.m == pytest.approx(0.0, abs=1e-9) and st.s == pytest.approx(1.0)


def test_clean_interactions_fills(spark):
    df = spark.createDataFrame([(None, None, None, None)],
                               "interaction_type string, interaction_time timestamp_ntz, "
                               "view_duration_secs double, comment_length int")
    r = clean.clean_interactions(df).first()
    assert (r.interaction_type, r.view_duration_secs, r.comment_length, r.hour_of_day, r.day_of_week) == \
        ("unknown", 0.0, 0, 0, 0)


def test_auc_agrees_with_evaluator_and_planted_signal(spark):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    rnd = random.Random(9)
    data = [(float(y) + rnd.gauss(0, 0.8), y) for y in (rnd.random() < 0.3 for _ in range(400))]
    df = spark.createDataFrame([(s, int(y)) for s, y in data], "score double, label int")
    ours = metrics.auc(df).first().auc
    ev = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label", numBins=0)
    assert ours == pytest.approx(ev.evaluate(df.withColumn("label", F.col("label").cast("double"))))
    assert ours > 0.7


def test_lsh_candidates_are_exact_pairs(spark):
    from recbrook.operators.retrieval import retrieve_lsh
    from recbrook.sources import derived as D
    d = "/root/testdata/sf0.001"
    uv, pv = D.side_vectors(spark, d, "user"), D.side_vectors(spark, d, "post")
    lsh = retrieve_lsh(uv, pv, k=5)
    exact = retrieve_topk(uv, pv, k=10_000)
    assert lsh.count() == 5 * uv.count()
    best = exact.filter("rank <= 5").join(lsh, ["user_id", "post_id"], "left_semi").count()
    assert best >= 0.9 * lsh.count()
    joined = lsh.join(exact.withColumnRenamed("score", "exact").drop("rank"), ["user_id", "post_id"])
    assert joined.count() == lsh.count() > 0
    assert joined.filter(F.abs(F.col("score") - F.col("exact")) > 1e-9).count() == 0


def test_diverse_list_is_refilled_from_other_clusters(spark):
    import numpy as np
    from recbrook.operators.retrieval import retrieve_diverse
    rng = np.random.default_rng(3)
    centre = np.eye(8)[:3]  # 60 posts near the user, 3 and 1 far from it
    vecs = [c + 0.05 * rng.normal(size=8) for c, n in zip(centre, (60, 3, 1)) for _ in range(n)]
    of = [c for c, n in enumerate((60, 3, 1)) for _ in range(n)]
    user = np.array([3, 2, 1, 0, 0, 0, 0, 0.0])
    posts = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(vecs)], "id long, embedding array<double>")
    users = spark.createDataFrame([(1, [float(x) for x in user])], "id long, embedding array<double>")
    clusters = spark.createDataFrame(list(enumerate(of)), "post_id long, cluster int")
    got = retrieve_diverse(users, posts, clusters, k=4, per_cluster=2).orderBy("rank").collect()
    want = sorted((i for c in range(3) for i in sorted((i for i in range(64) if of[i] == c),
                                                       key=lambda i: -(user @ vecs[i]))[:2]), key=lambda i: -(user @ vecs[i]))[:4]
    assert [r.post_id for r in got] == want and [r["rank"] for r in got] == [1, 2, 3, 4]


def test_rerun_gives_same_rows(spark):
    from recbrook.sources import derived as D
    d = "/root/testdata/sf0.001"
    a = collabs.collab_members(D.collabs(spark, d))
    b = collabs.collab_members(collabs.collab_members(D.collabs(spark, d)).drop("all_team_uids"))
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_scale_conf_sizes_partitions():
    from recbrook.session import scale_conf
    conf = scale_conf(100 * 2 ** 40, total_cores=8000)
    assert int(conf["spark.sql.shuffle.partitions"]) == 100 * 2 ** 40 // (128 << 20)
    assert int(scale_conf(10 << 20, total_cores=8)["spark.sql.shuffle.partitions"]) == 16


def test_als_takes_large_ids(spark):
    from recbrook.operators.models import als_embeddings
    big = 3_000_000_000
    iwn = spark.createDataFrame([(big + u, big + p, 1.0) for u in range(4) for p in range(3) if (u + p) % 2],
                                "user_id long, post_id long, weight double")
    got = als_embeddings(iwn, rank=4, max_iter=2).collect()
    assert {r.id for r in got if r.side == "user"} == {big + u for u in range(4)}
    assert {r.id for r in got if r.side == "post"} == {big + p for p in range(3)}


def test_leading_texts_hold_the_first_tokens(spark):
    """Cutting to the rows that fill the encoded length gives the tokens that
    joining all of them gives."""
    from recbrook.operators.collabs import leading_titles
    from recbrook.operators.posts import leading_comments
    com = spark.createDataFrame([(1, t, "..." if t % 3 else f"w{t} x") for t in range(30)] + [(2, 0, None)],
                                "po_id long, turn long, content string")
    assert rows(leading_comments(com, 4), "po_id", "comments") == [(1, ["w0 x", "w3 x", "w6 x", "w9 x"])]
    col = spark.createDataFrame([(i, 7, f"t{i}", [8]) for i in range(9)],
                                "collab_id long, owner_uid long, title string, team_uids array<long>")
    assert rows(leading_titles(col, 2), "uid", "project_titles") == [(7, ["t0", "t1"]), (8, ["t0", "t1"])]


# ---- what moves ---------------------------------------------------------------------------------
def _explained(df, capsys):
    capsys.readouterr()
    df.explain("formatted")
    return capsys.readouterr().out


def test_post_features_shuffle_no_description(spark, capsys):
    text = spark.createDataFrame([(1, "abc"), (2, None), (None, "x")], "po_id long, description string")
    its = spark.createDataFrame([(1, 5, "view", 2.0)], "post_id long, user_id long, interaction_type string, view_duration_secs double")
    com = spark.createDataFrame([(1, 0, "hi")], "po_id long, turn int, content string")
    got = posts.post_features(text.hint("merge"), its, com)
    plan = _explained(got, capsys)
    exchanges = [x.split("\n\n")[0] for x in plan.split("Exchange\n")[1:]]
    assert exchanges and not any("description" in x for x in exchanges)
    assert sorted((r.post_length for r in got.collect()), key=str) == [1, 3, None]


def test_examples_join_each_side_once_posts_first(spark):
    from recbrook.operators import examples
    iwn = spark.createDataFrame([(1, 7, "view", 1.0), (None, 7, None, 0.0), (2, None, "view", 1.0), (3, 8, "view", 0.0)],
                                "user_id long, post_id long, interaction_type string, weight double")
    ud = spark.createDataFrame([(1, [1.0] * 4), (2, [2.0] * 4)], "uid long, user_dense array<float>")
    pd_ = spark.createDataFrame([(7, [3.0] * 7)], "po_id long, post_dense array<float>")
    uv = spark.createDataFrame([(1, [0.5]), (3, [0.25]), (3, [0.75])], "id long, embedding array<float>")
    pv = spark.createDataFrame([(8, [0.125]), (None, [9.0])], "id long, embedding array<float>")
    got = examples.training_examples(iwn, ud, pd_, uv, pv)
    have = sorted(((r.user_id, r.post_id, r.user_embedding, r.user_dense[0], r.post_embedding, r.post_dense[0], r.has_user_vector,
                    r.has_post_vector) for r in got.collect()), key=str)
    assert have == sorted([(1, 7, [0.5], 1.0, [0.0], 3.0, 1, 0), (None, 7, [0.0], 0.0, [0.0], 3.0, 0, 0),
                           (2, None, [0.0], 2.0, [0.0], 0.0, 0, 0), (3, 8, [0.25], 0.0, [0.125], 0.0, 1, 1),
                           (3, 8, [0.75], 0.0, [0.125], 0.0, 1, 1)], key=str)
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Join LeftOuter") == 2


def test_text_widths_without_a_vocabulary(spark):
    from recbrook.operators import encode
    lengths = {"a": 10, "b": 5}
    rows_ = [(1, "a", "one two three"), (1, "a", "four"), (2, "a", None), (2, "b", "x " * 50), (3, "b", "")]
    texts = spark.createDataFrame(rows_, "k long, _col string, text string")
    vocab = encode.build_vocabulary(texts.select("text"))
    for some in (texts, texts.filter("k = 1"), texts.filter("k = 3"), texts.limit(0)):
        want = encode.token_widths(encode.encode_long(some, "k", lengths, vocab), lengths).first()
        assert tuple(encode.text_widths(some, "k", lengths).first()) == tuple(want)


def test_topk_in_blocks_ties_groups_and_no_row_per_user_and_cell(spark, monkeypatch):
    from recbrook.operators import retrieval as R
    monkeypatch.setattr(R, "candidate_clusters", None)  # a row per user and cell outgrew the shuffle
    monkeypatch.setattr(R, "PART", 64)
    rnd = random.Random(6)
    us = [(i % 17, [rnd.gauss(0, 1) for _ in range(3)]) for i in range(18)] + [(90, None), (None, [1.0] * 3)]
    ps = [(i, [1.0, 2.0, -1.0] if i % 3 else [rnd.gauss(0, 1) for _ in range(3)]) for i in range(60)] + [(99, None)]
    uv = spark.createDataFrame(us, "id long, embedding array<double>")
    pv = spark.createDataFrame(ps, "id long, embedding array<double>")
    grp = spark.createDataFrame([(i, i % 4 if i % 8 else None) for i in range(60)], "post_id long, grp int")
    dot = lambda u, p: sum(a * b for a, b in zip(u, p))
    for groups, of in ((None, lambda i: 0), (grp, lambda i: i % 4 if i % 8 else None)):
        found = R.retrieve_topk_by_group(uv, pv, groups, 3, block_size=7, user_cap=5).collect()
        got = [(r.user_id, r.grp, r["rank"], r.post_id) for r in found]
        want = []
        for uid in range(17):
            # id 0 has two rows, so each counts twice
            for g in {of(i) for i in range(60)} - {None}:
                sc = sorted((-dot(u, p), pid) for w, u in us if w == uid for pid, p in ps if p and of(pid) == g
                            for _ in range(1 + (uid == 0)))[:3]
                want += [(uid, g, r, pid) for r, (_, pid) in enumerate(sc, 1)]
        assert sorted(map(str, got)) == sorted(map(str, want))
    assert R.retrieve_topk(uv, pv.limit(0)).collect() == [] == R.retrieve_topk(uv.limit(0), pv).collect()


def test_lsh_scores_a_bucket_at_once(spark):
    """Of a bucket that all users and posts share only the best of each user leave it."""
    from recbrook.operators import retrieval as R
    uv = spark.createDataFrame([(i, [1.0, 1.0 + i / 100]) for i in range(30)], "id long, embedding array<double>")
    pv = spark.createDataFrame([(i, [1.0, 1.0 + i % 7]) for i in range(90)], "id long, embedding array<double>")
    got = R.retrieve_lsh(uv, pv, k=4, bucket_cap=8)
    assert {(r["rank"], r.post_id) for r in got.collect()} == {(1, 6), (2, 13), (3, 20), (4, 27)}
    assert "FlatMapGroupsInPandas" in got._jdf.queryExecution().optimizedPlan().toString()


def test_lsh_groups_give_what_single_buckets_give(spark, monkeypatch):
    """However many buckets move together, a user meets the same posts, and a post moves once
    per table and first bit, not once per bit."""
    import random
    from recbrook.operators import retrieval as R
    rng = random.Random(3)
    vecs = [spark.createDataFrame([(i, [rng.gauss(0, 1) for _ in range(8)]) for i in range(n)], "id long, embedding array<double>")
            for n in (30, 200)]
    moved = []
    score = R._score_blocks
    monkeypatch.setattr(R, "_score_blocks", lambda c, b, *a: moved.append(b.count()) or score(c, b, *a))
    a, b = (sorted(map(tuple, R.retrieve_lsh(*vecs, k=5, bucket_posts=4, bucket_cap=cap).collect())) for cap in (4, 64))
    assert a == b and moved[1] == 8 * 200 < moved[0]


def test_whole_examples_join_posts_first(spark):
    from recbrook.operators import examples
    ex = spark.createDataFrame([(7, 1, 0.5), (7, None, 0.25), (None, 2, 0.125)], "post_id long, user_id long, x double")
    users = spark.createDataFrame([(1, [1]), (3, [3])], "uid long, bio array<int>")
    where = spark.createDataFrame([(1, [0.1]), (2, [0.2])], "uid long, geo_rbf array<double>")
    texts = spark.createDataFrame([(7, [7])], "po_id long, title array<int>")
    got = examples.with_texts_and_location(ex, users, texts, where)
    assert got.columns == ["post_id", "user_id", "x", "bio", "geo_rbf", "title"]
    assert sorted(map(tuple, got.collect()), key=str) == [(7, 1, 0.5, [1], [0.1], [7]), (7, None, 0.25, None, None, [7]),
                                                          (None, 2, 0.125, None, [0.2], None)]
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Join LeftOuter") == 2
