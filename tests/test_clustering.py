"""Segmentation: closed forms against Spark ML, naming goldens, repeatability."""

import math

from pyspark.sql import functions as F

from clickseg.operators import clustering as CU
from clickseg.operators import scoring as SC
from clickseg.plans import catalog
from clickseg.plans.params import SEGMENTS
from conftest import SF


def _feats(spark):
    return CU.layout(catalog.buyer_features(spark, "/root/testdata/sf0.01"), 4)


def test_silhouette_and_assignment_match_spark_ml(spark):
    feats = _feats(spark)
    model = CU.fit_kmeans(feats, 3, with_mean=False)
    pred = model.transform(feats)
    ml = CU.silhouette_score(pred)
    ours = CU.silhouette(pred).first().silhouette
    assert math.isclose(ml, ours, abs_tol=1e-9)
    # assignment to the model's own centers equals model.transform
    mine = CU.assign_clusters(pred.drop("prediction"), CU.centers_frame(model), "scaledFeatures",
                              "mine")
    joined = mine.join(pred.select("user_id", "prediction"), "user_id")
    assert joined.filter(F.col("prediction") != F.col("mine")).count() == 0
    cost = CU.wss(pred, CU.centers_frame(model)).first().wss
    # The training cost is that of the centers before the last update: equal at convergence only.
    assert cost <= model.stages[-1].summary.trainingCost * (1 + 1e-9)
    centers = model.stages[-1].clusterCenters()
    direct = sum(min(float(((r.scaledFeatures.toArray() - c) ** 2).sum()) for c in centers)
                 for r in pred.select("scaledFeatures").collect())
    assert math.isclose(cost, direct, rel_tol=1e-9)


def test_fit_is_repeatable_and_sizes_sum(spark):
    feats = _feats(spark)
    a = CU.cluster_sizes(CU.fit_kmeans(feats, 2).transform(feats)).orderBy("prediction").collect()
    b = CU.cluster_sizes(CU.fit_kmeans(feats, 2).transform(feats)).orderBy("prediction").collect()
    assert a == b
    assert sum(r.n_users for r in a) == feats.count()


def test_scaling_matches_closed_form(spark):
    feats = catalog.buyer_features(spark, SF)
    scaled = CU.scale(CU.assemble(feats), with_mean=True)
    std = feats.agg(F.stddev_samp("monetary").alias("s"), F.avg("monetary").alias("m")).first()
    for r in scaled.select("monetary", CU.vector_to_array("scaledFeatures")[2].alias("z")).collect():
        assert math.isclose(r.z, (r.monetary - std.m) / std.s, rel_tol=1e-9, abs_tol=1e-12)


def test_segment_name_goldens(spark):
    prof = spark.createDataFrame([
        (0, 128.43, 1.39, 269.49, 0.10), (1, 45.58, 3.22, 704.60, 0.12),
        (2, 20.0, 20.0, 600.0, 0.5), (3, 100.0, 11.0, 100.0, 0.5), (4, 90.0, 1.0, 100.0, 0.05)],
        "cluster int, recency_mean double, frequency_mean double, monetary_mean double, "
        "conversion_rate_mean double")
    names = {r.cluster: r.segment_name for r in CU.name_segments(prof).collect()}
    assert names == {0: "Clients Dormants", 1: "Cluster Moyen Cluster 1", 2: "Clients Premium",
                     3: "Chasseurs de Promos", 4: "Window Shoppers"}


def test_k_search_and_best_k(spark):
    feats = _feats(spark)
    search = CU.k_search(feats, range(2, 5))
    rows = search.orderBy("k").collect()
    serial = CU.k_search(feats, range(2, 5), parallelism=1).orderBy("k").collect()
    assert rows == serial  # concurrent fits give the same results
    assert [r.k for r in rows] == [2, 3, 4]
    assert all(-1 <= r.silhouette <= 1 and r.wss > 0 for r in rows)
    best = CU.best_k(search).first()
    assert best.silhouette == max(r.silhouette for r in rows)


def test_recommendations_and_scoring(spark):
    feats = _feats(spark)
    model = CU.fit_kmeans(feats, 3)
    seg = SC.segment_table(spark, SEGMENTS)
    out = SC.segment_recommendations(SC.score_profiles(model, feats).select("user_id", "prediction"),
                                     seg)
    assert out.filter("prediction = 2 AND warning IS NULL").count() == 0
    assert out.filter("prediction < 2 AND name IS NULL").count() == 0
    one = spark.createDataFrame([(30, 3, 700.0, 5, 40, 4, 3, 0.1)],
                                "recency int, frequency int, monetary double, unique_products int, "
                                "views int, carts int, purchases int, conversion_rate double")
    assert SC.score_profiles(model, one).select("prediction").first()[0] in (0, 1, 2)


def test_streaming_scoring_equals_batch(spark, tmp):
    feats = _feats(spark)
    model = CU.fit_kmeans(feats, 2)
    feats.write.parquet(f"{tmp}/in")
    stream = spark.readStream.schema(feats.schema).parquet(f"{tmp}/in")
    q = (SC.score_profiles(model, stream).select("user_id", "prediction").writeStream
         .format("memory").queryName("scored").option("checkpointLocation", f"{tmp}/ck")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    batch = model.transform(feats).select("user_id", "prediction")
    streamed = spark.sql("select * from scored")
    assert streamed.count() == batch.count()
    assert streamed.exceptAll(batch).count() == 0


def test_score_typed_profiles_like_table(spark):
    feats = _feats(spark)
    model = CU.fit_kmeans(feats, 3)
    rows = [r.asDict() for r in feats.orderBy("user_id").limit(20).collect()]
    by_dict = SC.score_profiles(model, SC.profile_frame(spark, rows)).select("user_id", "prediction")
    by_table = model.transform(feats).select("user_id", "prediction")
    got = {r.user_id: r.prediction for r in by_dict.collect()}
    want = {r.user_id: r.prediction for r in by_table.collect() if r.user_id in got}
    assert got == want and len(got) == 20


def test_assign_clusters_on_a_stream(spark, tmp):
    feats = _feats(spark)
    model = CU.fit_kmeans(feats, 3, with_mean=False)
    centers = CU.centers_frame(model)
    scaled = model.transform(feats).select("user_id", CU.vector_to_array("scaledFeatures")
                                           .alias("x"))
    scaled.write.parquet(f"{tmp}/in")
    stream = spark.readStream.schema(scaled.schema).parquet(f"{tmp}/in")
    q = (CU.assign_clusters(stream, centers, "x").select("user_id", "prediction").writeStream
         .format("memory").queryName("assigned").option("checkpointLocation", f"{tmp}/ck")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    batch = CU.assign_clusters(scaled, centers, "x").select("user_id", "prediction")
    got = spark.sql("select * from assigned")
    assert got.count() == batch.count() and got.exceptAll(batch).count() == 0
