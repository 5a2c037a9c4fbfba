"""Model stages run with shape checks; sinks round-trip."""

import os
import tempfile

from pyspark.sql import functions as F

from conftest import SF_SMALL
from recbrook.operators import models
from recbrook.plans import features as FT
from recbrook.plans.recommend import ranking_examples, recommend
from recbrook.sources import io


def test_als_shapes_and_save_load(spark):
    from pyspark.ml.recommendation import ALSModel  # noqa: F401
    iwn = FT.interactions_with_negatives(FT.Inputs.load(spark, SF_SMALL))
    emb = models.als_embeddings(iwn, max_iter=2)
    widths = {r.w for r in emb.select(F.size("embedding").alias("w")).distinct().collect()}
    assert widths == {32} and emb.filter(F.col("side") == "user").count() > 0
    path = io.write_embeddings(emb.filter(F.col("side") == "post"), tempfile.mkdtemp() + "/post")
    back = io.read_embeddings(spark, path)
    assert back.count() == emb.filter(F.col("side") == "post").count()


def test_ranker_beats_constant_and_recommend_shape(spark):
    ex = ranking_examples(spark, SF_SMALL)[0]
    m = models.rank_wide(ex, max_iter=10)
    pred = models.predict(m, ex, ["label"])
    from recbrook.operators.metrics import auc
    a = auc(pred.withColumnRenamed("probability", "score")).first().auc
    assert a is None or 0.0 <= a <= 1.0
    path = io.save_model(m, os.path.join(tempfile.mkdtemp(), "wide"))
    from pyspark.ml.classification import LogisticRegressionModel
    assert io.load_model(LogisticRegressionModel, path).numFeatures == len(ex.first().features)
    rec = recommend(spark, SF_SMALL, k=3, n_candidates=6)
    per_user = rec.groupBy("user_id").count().agg(F.max("count")).first()[0]
    assert per_user == 3


def test_write_examples_and_read_features(spark):
    out = tempfile.mkdtemp()
    df = spark.createDataFrame([(1, 2, 0, 1, 0.5)], "uid long, viewed_posts long, upvoted_posts long, "
                                                     "commented_posts long, login_frequency double")
    paths = io.write_examples({"users": df}, out)
    back = io.read_user_features(spark, paths["users"] + "/*.parquet").first()
    assert back.viewed_posts == 2.0 and back.login_frequency == 0.5


def test_fit_input_is_dealt_evenly(spark, monkeypatch):
    """Every pass over the fit input waits for its longest partition."""
    monkeypatch.setattr(models, "FIT_ROWS", 100)
    ex = spark.createDataFrame([([float(i % 3), 1.0], i % 2) for i in range(1000)], "features array<float>, label int")
    lengths = lambda df: df.rdd.glom().map(len).collect()
    uneven = ex.repartition(1).unionByName(ex.limit(5).repartition(1))
    train = models._training_set(uneven, ["fv", "y"])
    got = lengths(train)
    assert len(got) == 11 and sum(got) == 1005 and max(got) <= 100
    rows = lambda df: sorted((tuple(r.fv.toArray()), r.y) for r in df.collect())
    assert rows(train) == rows(models._vectorised(uneven).select("fv", "y"))
    assert lengths(models._training_set(ex.limit(60).repartition(1), ["fv", "y"])) == [60]  # few rows stay as they come
    model = models.rank_mlp(uneven, max_iter=3)
    assert model.numFeatures == 2 and models.predict(model, uneven, ["label"]).count() == 1005
