import base64
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.llm import language, quality
from riskloom.llm.common import fold
from riskloom.llm.language import distance_limits, fit_languages, predict_languages
from riskloom.llm.quality import best_bin_prior, fit_quality, minimise_risk, score_quality, stored_shares
from riskloom.llm.queries import llm_queries


def test_language_held_out_accuracy(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    found = llm_queries()["op1_language_id"](spark, tables).join(docs.select("doc_id", "lang"), "doc_id")
    held = found.where("held_out")
    assert held.where("lang = lang_pred").count() >= 0.97 * held.count()
    assert found.count() == docs.count() and found.where("score < 0 or score > 1").isEmpty()
    assert found.where("rejected").count() <= 0.02 * docs.count()


def test_language_of_odd_texts(odd_docs, no_docs):
    model = fit_languages(odd_docs, F.col("doc_id").isNotNull())
    rows = predict_languages(odd_docs, model).collect()
    assert len(rows) == odd_docs.count()
    by_id = {r["doc_id"]: r for r in rows}
    for k in (3, 4, 5):
        assert by_id[k]["lang_pred"] == "und" and by_id[k]["score"] == 0 and by_id[k]["rejected"]
    assert by_id[0]["lang_pred"] == by_id[1]["lang_pred"] == "en"
    assert by_id[0]["score"] == by_id[1]["score"]
    assert predict_languages(no_docs, model).count() == 0
    nothing = fit_languages(no_docs, F.lit(True))
    unknown = predict_languages(odd_docs, nothing).collect()
    assert {r["lang_pred"] for r in unknown} == {"und"} and sum(r["rejected"] for r in unknown) == 3


def test_texts_far_from_all_languages_are_rejected(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    model = fit_languages(docs, fold(3) != 1)
    strange = spark.createDataFrame([(1, "жшщъыьэюя " * 40), (2, "zqxj " * 60)], "doc_id long, text string")
    assert [r["rejected"] for r in predict_languages(strange, model).orderBy("doc_id").collect()] == [True, True]


def test_quality_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    found = llm_queries()["op4_quality"](spark, folder)
    held = found.where("held_out").join(labels, "doc_id")
    assert held.where("predicted = quality").count() >= 0.95 * held.count()
    assert found.count() == spark.read.parquet(f"{folder}/documents.parquet").count()
    assert found.where("score < 0 or score > 1 or score is null").isEmpty()


def test_quality_of_odd_texts(spark, odd_docs, no_docs):
    labels = spark.createDataFrame(
        [(0, 1, 0), (0, 0, 0), (8, 0, 0), (9, None, 0), (None, 1, 0), (77, 1, 0)], "doc_id long, quality int, toxic int"
    )
    shares = stored_shares(odd_docs)
    scored = score_quality(shares, fit_quality(shares, labels, fold(4) < 4)).collect()
    assert len(scored) == odd_docs.count()
    by_id = {r["doc_id"]: r["score"] for r in scored}
    assert by_id[0] == by_id[1] and by_id[3] == by_id[4] == by_id[5]
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in scored)
    none = score_quality(shares, fit_quality(shares, labels.limit(0), F.lit(True))).collect()
    assert len({round(r["score"], 12) for r in none}) == 1
    empty = stored_shares(no_docs)
    assert score_quality(empty, fit_quality(empty, labels, F.lit(True))).count() == 0


def test_risk_of_separable_rows_stays_non_negative():
    import numpy as np

    from riskloom.llm.quality import WIDTH

    draw = np.random.default_rng(0)

    def rows(n, high):
        x = np.zeros((n, WIDTH))
        x[:, 0], x[:, 1], x[:, -1] = high, draw.uniform(size=n), 1
        return x

    p, u = rows(300, 1.0), np.vstack([rows(240, 1.0), rows(60, 0.0)])
    weights = minimise_risk(p.T @ p / len(p), u.T @ u / len(u), 0.8)
    assert (p @ weights > 0.5).all() and (rows(50, 0.0) @ weights < -0.5).all()


def test_long_junk_is_rejected_and_prose_is_kept(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = fit_languages(docs, fold(3) != 1)
    draw = random.Random(1)
    letters = ["".join(draw.choices("abcdefghijklmnopqrstuvwxyz", k=draw.randint(2, 10))) for _ in range(1500)]
    junk = [(1, " ".join(letters)), (2, base64.b64encode(draw.randbytes(20_000)).decode()), (3, " ".join(letters[:500]))]
    assert all(r["rejected"] for r in predict_languages(spark.createDataFrame(junk, "doc_id long, text string"), model).collect())
    gone = predict_languages(docs, model).where("rejected and lang_pred <> 'und'").join(docs.select("doc_id", "text"), "doc_id")
    # of the documents only some that repeat one word go
    assert gone.count() <= 5
    assert all(len(set(r["text"].split())) <= 20 for r in gone.collect())


def test_equal_rows_count_once_in_the_sample(spark):
    same = spark.range(9_000).selectExpr("id AS doc_id", "'the same text again' AS text", "'en' AS lang")
    others = spark.range(9_000, 18_000).selectExpr("id AS doc_id", "concat('text ', id) AS text", "'en' AS lang")
    key = F.struct(F.xxhash64("text").alias("a"), F.xxhash64("text", F.lit(1)).alias("b")).alias("key")
    rows = same.union(others).select("lang", "text", key)
    drawn = language._different(rows, 2_000)
    assert drawn.count() == 2_000 and drawn.distinct().count() == 2_000
    assert language._different(rows, 20_000).count() == 9_001


def test_limits_follow_the_training_distances():
    lengths = np.repeat([6, 9, 11], [20, 200, 50])
    distances = np.r_[np.full(20, 0.8), np.linspace(0, 0.5, 200), np.full(50, 0.2)]
    limits = distance_limits(lengths, distances)
    assert limits[7] == language.NOTHING_SHARED and limits[8] == language.FEW_LIMIT
    assert limits[9] == pytest.approx(np.quantile(distances[20:220], 0.995) + 0.1)
    assert limits[11] == pytest.approx(np.quantile(distances[20:], 0.995) + 0.1) and limits[20] <= limits[11]
    assert (distance_limits(lengths[:20], distances[:20]) == language.NOTHING_SHARED).all()


def test_prediction_is_the_nearest_centroid_by_plain_sums(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet").where("length(text) < 2000")
    model = fit_languages(docs, fold(3) != 1)
    found = {r["doc_id"]: r for r in predict_languages(docs, model).collect()}
    for r in docs.limit(30).collect():
        places, counts = language._trigrams(r["text"])
        weights = {int(p): (1 + np.log(float(c))) * float(model.idf[p]) for p, c in zip(places, counts, strict=True)}
        size = sum(w * w for w in weights.values()) ** 0.5
        near = [sum(w * float(c[p]) for p, w in weights.items()) / max(size, 1e-12) for c in model.centroids]
        if language.has_letter(r["text"]):
            assert found[r["doc_id"]]["score"] == pytest.approx(min(1, max(0, max(near))), abs=1e-4)
            pairs = zip(near, model.languages, strict=True)
            assert found[r["doc_id"]]["lang_pred"] in {lang for n, lang in pairs if n > max(near) - 1e-4}


def test_prior_needs_no_negative_label(spark):
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    shares = stored_shares(spark.read.parquet(f"{folder}/documents.parquet"))
    model = fit_quality(shares, labels, fold(4) != 2)
    share = labels.agg(F.avg("quality")).first()[0]  # labels are a random part of the rows
    assert abs(model.prior - share) < 0.06
    positives = fit_quality(shares, labels.where("quality = 1"), fold(4) != 2)
    assert positives.prior == pytest.approx(model.prior) and np.allclose(positives.weights, model.weights)


@pytest.mark.parametrize("prior", [0.2, 0.5, 0.9])
def test_best_bin_prior(prior):
    draw = np.random.default_rng(3)
    positive = np.bincount(draw.integers(400, 1000, 20_000), minlength=1000)
    n = int(20_000 * prior)
    mixed = np.r_[draw.integers(400, 1000, n), draw.integers(0, 600, 20_000 - n)]
    assert best_bin_prior(np.bincount(mixed, minlength=1000), positive) == pytest.approx(prior, abs=0.04)


def test_moments_equal_plain_sums(spark, tables):
    shares = stored_shares(spark.read.parquet(f"{tables}/documents.parquet"))
    rows = shares.selectExpr("shares", "doc_id % 3 = 0 AS positive", "cast(doc_id % 2 AS int) AS half")
    sums, plain = quality._moments(rows), np.zeros((2, 2, quality.WIDTH, quality.WIDTH))
    for r in rows.collect():
        x = quality.basis(np.array([r["shares"]]))[0]
        plain[r["half"], 0] += np.outer(x, x)
        plain[r["half"], 1] += np.outer(x, x) * r["positive"]
    assert np.allclose(sums, plain)
