import random

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tillroll.operators import clustering, evaluation, features
from tillroll.plans import satisfaction, segments

METRICS = (
    "order_id string, customer_id string, order_status string, spend_total double, "
    "freight_total double, item_count double, avg_score double"
)


def metrics(make, n=400, label=lambda spend, rng: 5.0 if spend > 100 else 1.0, seed=1):
    rng = random.Random(seed)
    data = []
    for i in range(n):
        spend = rng.randrange(100, 20_000) / 100
        status = rng.choice(["delivered", "delivered", "shipped", "canceled"])
        data.append(
            (f"o{i}", f"c{i % 9}", status, spend, rng.randrange(10, 900) / 100,
             float(rng.randrange(1, 6)), label(spend, rng))
        )
    return make.frame(data, METRICS)


def blobs(make, sizes=(40, 30, 20), seed=2):
    """Three far groups of orders; the order id starts with the group's number."""
    rng = random.Random(seed)
    places = [(10.0, 1.0, 1.0, 2.0), (500.0, 40.0, 5.0, 3.0), (5000.0, 5.0, 20.0, 4.5)]
    data = [
        (f"{g}-{i}", "c", "delivered" if i % 2 else "shipped", round(spend + rng.random(), 2),
         round(freight + rng.random(), 2), count, score)
        for g, (spend, freight, count, score) in enumerate(places)
        for i in range(sizes[g])
    ]
    return make.frame(data, METRICS)


def test_clean_and_label(make, rows):
    frame = make.frame(
        [("a", "c", "s", 1.0, 1.0, 1.0, 4.0), ("b", "c", "s", 1.0, 1.0, 1.0, 3.9),
         ("d", "c", "s", 1.0, 1.0, 1.0, None), ("e", "c", None, 1.0, 1.0, 1.0, 5.0)],
        METRICS,
    )
    labelled = satisfaction.labelled_metrics(frame)
    assert rows(labelled, "order_id", "satisfied") == [("a", 1.0), ("b", 0.0)]
    assert rows(satisfaction.label_distribution(labelled)) == [(0.0, 1), (1.0, 1)]


def test_status_index_by_frequency_then_name(make, rows):
    frame = make.frame([(s,) for s in ["b", "b", "c", "a"]], "order_status string")
    indexed = features.status_indexer().fit(frame).transform(frame)
    assert rows(indexed.distinct()) == [("a", 1.0), ("b", 0.0), ("c", 2.0)]


def test_unseen_status_drops_the_row(make):
    known = make.frame([("a",), ("b",)], "order_status string")
    seen_later = make.frame([("a",), ("rare",)], "order_status string")
    assert features.status_indexer().fit(known).transform(seen_later).count() == 1


def test_scaled_features_have_zero_mean_and_unit_deviation(make):
    scaled = features.scaled_features(metrics(make)).select(features.SCALED)
    wide = features.vector_columns(scaled, features.SCALED, features.FEATURE_NAMES)
    for name in features.FEATURE_NAMES:
        mean, deviation = wide.agg(F.avg(name), F.stddev_samp(name)).first()
        assert mean == pytest.approx(0, abs=1e-9) and deviation == pytest.approx(1)


def test_constant_feature_scales_to_zero(make):
    frame = metrics(make).withColumn("item_count", F.lit(2.0))
    scaled = features.scaled_features(frame).select(features.SCALED)
    wide = features.vector_columns(scaled, features.SCALED, features.FEATURE_NAMES)
    assert wide.select("item_count").distinct().collect() == [(0.0,)]


def test_split_by_key_is_whole_and_repeatable(make):
    frame = metrics(make, 1000)
    sides = []
    for partitions in (1, 7):
        train, test = features.split_by_key(frame.repartition(partitions), "order_id")
        sides.append({row["order_id"] for row in train.collect()})
        assert train.count() + test.count() == 1000
        assert train.join(test, "order_id").count() == 0
    assert sides[0] == sides[1] and 700 < len(sides[0]) < 900


def test_random_split_is_whole(make):
    train, test = features.split_at_random(metrics(make, 500))
    assert train.count() + test.count() == 500 and train.count() > test.count()


def test_area_under_roc_equals_pairwise_count(make):
    rng = random.Random(4)
    data = [(float(rng.randrange(2)), rng.randrange(15) / 2) for _ in range(80)]
    wins = [
        1.0 if p > n else 0.5 if p == n else 0.0
        for lp, p in data if lp == 1
        for ln, n in data if ln == 0
    ]
    frame = make.frame(data, "label double, score double")
    assert evaluation.area_under_roc(frame, "label", "score") == pytest.approx(
        sum(wins) / len(wins)
    )


def test_accuracy_and_majority(make):
    data = [(1.0, 1.0), (1.0, 0.0), (1.0, 1.0), (0.0, 0.0), (0.0, 1.0)]
    frame = make.frame(data, "label double, prediction double")
    assert evaluation.accuracy(frame, "label") == pytest.approx(0.6)
    assert evaluation.majority_share(frame, "label") == pytest.approx(0.6)


def test_silhouette_equals_brute_force(make):
    rng = random.Random(5)
    points = [(i % 3, rng.random() + i % 3, rng.random()) for i in range(30)]
    frame = make.frame(points, "prediction int, x double, y double").withColumn(
        "scaled_features", array_to_vector(F.array("x", "y"))
    )
    place = np.array([[x, y] for _, x, y in points])
    label = np.array([c for c, _, _ in points])
    distance = ((place[:, None] - place[None]) ** 2).sum(axis=2)
    values = []
    for i in range(len(points)):
        own = distance[i][label == label[i]].sum() / ((label == label[i]).sum() - 1)
        other = min(distance[i][label == c].mean() for c in range(3) if c != label[i])
        values.append((other - own) / max(own, other))
    assert evaluation.silhouette(frame) == pytest.approx(np.mean(values))


def test_separable_label_is_learned(make, spark):
    run = satisfaction.fit_satisfaction(satisfaction.labelled_metrics(metrics(make, 600)))
    scores = run.metrics()
    assert scores["auc"] > 0.99 and scores["accuracy"] > 0.9
    weights = {row["feature"]: row["weight"] for row in run.coefficients(spark).collect()}
    assert list(weights) == [*features.FEATURE_NAMES, "intercept"]
    assert weights["spend_total"] > 10 * abs(weights["freight_total"])
    report = run.prediction_report()
    assert report.count() == run.test.count()
    assert report.columns == ["order_id", "spend_total", "avg_score", "satisfied", "prediction"]


def test_random_label_is_not_learned(make):
    frame = metrics(make, 1500, label=lambda spend, rng: rng.choice([1.0, 5.0]))
    scores = satisfaction.fit_satisfaction(satisfaction.labelled_metrics(frame)).metrics()
    assert 0.4 < scores["auc"] < 0.6 and scores["majority_share"] < 0.6


def test_weights_minimise_the_regularised_loss(make, spark):
    """At the fitted weights the gradient of log loss plus L2 penalty is near zero."""
    def noisy(spend, rng):
        return 5.0 if spend + rng.gauss(0, 60) > 100 else 1.0

    labelled = satisfaction.labelled_metrics(metrics(make, 500, label=noisy))
    run = satisfaction.fit_satisfaction(labelled)
    scored = run.model.transform(run.train).select(features.SCALED, "satisfied").collect()
    x = np.array([row[0].toArray() for row in scored])
    y = np.array([row[1] for row in scored])
    model = run.model.stages[-1]
    w = model.coefficients.toArray()
    p = 1 / (1 + np.exp(-(x @ w + model.intercept)))
    gradient = x.T @ (p - y) / len(y) + satisfaction.REGULARISATION * w
    assert np.abs(gradient).max() < 1e-3 and abs((p - y).mean()) < 1e-3


def test_three_blobs_are_found(make, spark):
    segmentation = segments.fit_segments(blobs(make))
    k, value, _ = segmentation.best
    assert [row["k"] for row in segmentation.silhouettes(spark).collect()] == [2, 3, 4, 5, 6]
    assert segments.best_of(segmentation.silhouettes(spark)).first()["k"] == k
    fixed = next(result for result in segmentation.results if result[0] == 3)
    three = segments.Segmentation(segmentation.features, [fixed])
    groups = {}
    for row in three.assignments().collect():
        groups.setdefault(row["prediction"], set()).add(row["order_id"][0])
    assert groups == {0: {"0"}, 1: {"1"}, 2: {"2"}}
    profile = three.profile().collect()
    assert [row["n_orders"] for row in profile] == [40, 30, 20]
    assert [row["avg_score"] for row in profile] == [2.0, 3.0, 4.5]
    centers = three.centers(spark).collect()
    assert [row["prediction"] for row in centers] == [0, 1, 2]
    assert centers[0]["spend_total"] < centers[1]["spend_total"] < centers[2]["spend_total"]


def test_best_k_is_the_planted_one_without_the_status(make):
    frame = blobs(make).withColumn("order_status", F.lit("delivered"))
    assert segments.fit_segments(frame).best[0] == 3


def test_segments_do_not_depend_on_input_partitions(make, rows):
    frame = metrics(make, 500)
    seen = {
        str(rows(segments.fit_segments(frame.repartition(n), ks=[3], partitions=4)
                 .assignments(), "order_id", "prediction"))
        for n in (1, 5, 7)
    }
    assert len(seen) == 1


def test_features_are_released_after_fitting(make, spark):
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    segmentation = segments.fit_segments(blobs(make), ks=[2])
    assert not segmentation.features.storageLevel.useMemory
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before


def test_a_model_of_given_points_has_them_as_centers(make):
    points = [(5.0, 1.0), (1.0, 2.0), (9.0, 3.0)]
    frame = make.frame(points, "x double, y double").withColumn(
        "scaled_features", array_to_vector(F.array("x", "y"))
    )
    model = clustering.fit_kmeans(frame, 3)
    assert sorted(map(tuple, model.clusterCenters())) == sorted(points)
    assigned = clustering.assign_clusters(model, frame).orderBy("x").collect()
    assert [row["prediction"] for row in assigned] == [0, 1, 2]


def test_segments_do_not_depend_on_the_number_of_rows(make):
    few, many = metrics(make, 40), metrics(make, 400)
    for frame in (few, many):
        placed = clustering.placed_by_key(frame, "order_id")
        assert placed.rdd.getNumPartitions() == clustering.PARTITIONS > 1


def test_rows_without_a_key_are_on_one_side(make):
    frame = make.frame([(None, 1), (None, 2), ("a", 3), ("b", 4)], "key string, x int")
    train, test = features.split_by_key(frame, "key")
    assert train.count() + test.count() == 4
    assert train.where("key IS NULL").count() == 2


def test_profile_means_are_free_of_row_order(make):
    data = [(f"o{i}", "c", "s", 1.0, 1.0, float(1 + i % 2), [4.0, 4.01][i % 2]) for i in range(1000)]
    for seed in range(3):
        random.Random(seed).shuffle(data)
        row = clustering.cluster_profile(make.frame(data, METRICS), "order_status").first()
        assert (row["avg_items"], row["avg_score"]) == (1.5, 4.01)  # 4.005 rounds up


def test_best_k_takes_the_smallest_among_equals():
    assert clustering.best_k([(4, 0.5, None), (2, 0.5, None), (3, 0.4, None)])[0] == 2
