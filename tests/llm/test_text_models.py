"""Classifier and language network: held-out accuracy, gradients, and rows without usable text."""

import numpy as np
from pyspark.sql import functions as F

from tallyriver.llm import language, quality
from tallyriver.llm.queries import QUERIES
from tallyriver.llm.text import bounded_sample, held_out, quotas, stratified_sample


def test_quality_on_held_out_rows(spark, sf_dir):
    scored = QUERIES["op6_quality_classifier"](spark, sf_dir)
    assert scored.columns == ["doc_id", "held_out", "score", "predicted"]
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    rows = scored.filter("held_out").join(labels, "doc_id").collect()
    assert len(rows) > 5 and np.mean([r["predicted"] == r["quality"] for r in rows]) >= 0.8
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in rows)


def test_quality_learns_nothing_from_the_held_out_fold(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    turned = labels.withColumn("quality", F.when(held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = quality.fit_quality(docs, labels), quality.fit_quality(docs, turned)
    assert np.array_equal(a.weights, b.weights) and a[1:] == b[1:]


def test_quality_edges(spark, frame, edges):
    docs = frame(edges)
    labels = spark.createDataFrame([(4, 1), (None, 0), (5, None), (5, 7), (99, 1)], "doc_id bigint, quality int")
    model = quality.fit_quality(docs, labels)
    rows = quality.with_quality(docs, model).collect()
    assert len(rows) == len(edges) and set(rows[0].asDict()) == set(docs.columns)
    assert len({r["score"] for r in rows}) == 1
    assert quality.with_quality(frame([]), quality.fit_quality(frame([]), labels.limit(0))).count() == 0


def test_quality_model_separates_and_scores_empty_texts_alike():
    finder = quality.Indicators()
    texts = [b"calm plain words in a row %d" % i for i in range(40)] + [b"###!!! $$$%%%%%% %d" % i for i in range(40)]
    positive = np.array([True] * 40 + [False] * 40)
    model = quality.fit_rows([finder.of(t) for t in texts], positive)
    scores = np.array([quality.probability(model, finder.of(t)) for t in texts])
    assert (scores[:40] > 0.5).all() and (scores[40:] < 0.5).all()
    assert quality.probability(model, finder.of(None)) == quality.probability(model, finder.of(b""))


def plain_scores(texts, positive, asked):
    """The classifier in plain Python: sets of n-grams, the same formulas, margins by models without the row's fold."""
    import math

    def grams(text):
        found = {(n, text[i : i + n]) for n in quality.ORDERS for i in range(len(text) - n + 1)}
        words = text.split()
        for times in quality.REPEATS:
            if any(len(set(words[i : i + times])) == 1 for i in range(len(words) - times + 1)):
                found.add(("repeat", times))
        return found

    def separator(rows, good):
        names = sorted(set().union(*rows), key=str)
        counts = [{g: 1.0 + sum(g in r for r, y in zip(rows, good) if y == kind) for g in names} for kind in (False, True)]
        # columns that no row has count one in either class, as hashing leaves them
        sums = [sum(c.values()) + quality.COLUMNS - len(names) for c in counts]
        ratio = {g: math.log((counts[1][g] / sums[1]) / (counts[0][g] / sums[0])) for g in names}
        other = math.log((1 / sums[1]) / (1 / sums[0]))

        def vector(row):
            values = {g: ratio.get(g, other) for g in row}
            length = max(math.sqrt(sum(v * v for v in values.values())), 1e-9)
            return {g: v / length for g, v in values.items()}

        vectors, weights, intercept, alpha = [vector(r) for r in rows], {}, 0.0, [0.0] * len(rows)
        costs = [len(rows) / (2 * sum(y == kind for y in good)) for kind in good]
        order, shuffle = np.arange(len(rows)), np.random.default_rng(7)
        for _ in range(12):
            shuffle.shuffle(order)
            moved = 0.0
            for i in order:
                sign = 1.0 if good[i] else -1.0
                slack = sign * (sum(weights.get(g, 0.0) * v for g, v in vectors[i].items()) + intercept) - 1
                step = min(max(alpha[i] - slack / (sum(v * v for v in vectors[i].values()) + 1), 0.0), costs[i]) - alpha[i]
                alpha[i] += step
                intercept += step * sign
                for g, v in vectors[i].items():
                    weights[g] = weights.get(g, 0.0) + step * sign * v
                moved = max(moved, abs(step))
            if moved < 1e-4:
                break
        return lambda row: sum(weights.get(g, 0.0) * v for g, v in vector(row).items()) + intercept

    rows, good = [grams(t) for t in texts], list(positive)
    whole, seen, fold = separator(rows, good), {True: 0, False: 0}, []
    for y in good:
        seen[y] += 1
        fold.append(seen[y] % 5)
    margins = []
    for r, f in zip(rows, fold):
        part = [i for i in range(len(rows)) if fold[i] != f]
        margins.append(separator([rows[i] for i in part], [good[i] for i in part])(r))
    slope, offset = quality.sigmoid_fit(np.array(margins), np.array(good))
    return [1 / (1 + math.exp(-(slope * whole(grams(t)) + offset))) for t in asked]


def test_scores_equal_a_plain_classifier():
    rng = np.random.default_rng(4)
    good = [b"the cat and a dog ran to town %d" % i for i in range(9)]
    bad = [bytes(rng.integers(33, 60, 20, np.uint8)) + b" buy buy %d" % i for i in range(7)]
    texts, positive = good + bad, np.array([True] * 9 + [False] * 7)
    finder = quality.Indicators()
    model = quality.fit_rows([finder.of(t) for t in texts], positive)
    asked = [*texts, b"", b"unseen words here", b"!!! buy buy buy"]
    got = [quality.probability(model, finder.of(t)) for t in asked]
    # hashed columns may meet; single precision
    assert np.allclose(got, plain_scores(texts, positive, asked), atol=0.02)


def test_held_out_bad_rows_are_rejected(spark, sf_dir):
    """Few labelled bad rows are enough: margins of rows that a model has not seen set its threshold."""
    scored = QUERIES["op6_quality_classifier"](spark, sf_dir)
    bad = spark.read.parquet(f"{sf_dir}/labels.parquet").filter("quality = 0").select("doc_id")
    rows = scored.filter("held_out").join(bad, "doc_id").collect()
    assert sum(r["predicted"] == 0 for r in rows) >= 2 / 3 * len(rows) > 0


def test_indicators_do_not_depend_on_chunks(monkeypatch):
    text = bytes(np.random.default_rng(1).integers(0, 256, 5000, np.uint8))
    whole = quality.Indicators().of(text)
    monkeypatch.setattr(quality, "CHUNK", 100)
    assert np.array_equal(quality.Indicators().of(text), whole)


def test_dual_coordinate_descent_meets_the_margin():
    rows = [(np.array([i % 2]), np.array([1.0])) for i in range(20)]
    signs = np.array([1.0 if i % 2 else -1.0 for i in range(20)])
    weights, intercept = quality.dual_coordinate_descent(rows, signs, np.full(20, 1.0), epochs=200)
    margins = [s * (weights[c] @ v + intercept) for (c, v), s in zip(rows, signs)]
    assert min(margins) > 0.95


def test_language_on_held_out_rows(spark, sf_dir):
    found = QUERIES["op10_language_id"](spark, sf_dir)
    assert found.columns == ["doc_id", "held_out", "lang_pred", "score"]
    truth = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang")
    rows = found.filter("held_out").join(truth, "doc_id").collect()
    assert np.mean([r["lang_pred"] == r["lang"] for r in rows]) >= 0.9


def _windows(texts):
    cut = [language.windows_of(t) for t in texts]
    return np.concatenate([c for c, _ in cut]), np.concatenate([s for _, s in cut])


def test_gradients_match_differences():
    data, sizes = _windows([b"abcabc" * 20, b"xyz zyx" * 15])
    classes = np.array([0, 0, 1, 1])[: len(sizes)]
    model = language.train(data, sizes, ["a", "a", "b", "b"][: len(sizes)], steps=2)
    values = [v.astype(np.float64) for v in model[:4]]
    _, gradients = language._gradients(model, data, sizes, classes)
    for k, at in ((0, (0, 3, 98)), (0, (1, 20, 120)), (1, (0, 4, 2)), (1, (1, 17, 5)), (2, (1, 3)), (3, (0,))):
        ends = []
        for step in (1e-3, -1e-3):
            moved = [v.copy() for v in values]
            moved[k][at] += step
            ends.append(language._gradients(language.Model(*moved, model.names), data, sizes, classes)[0])
        assert abs((ends[0] - ends[1]) / 2e-3 - gradients[k][at]) < 1e-4


def test_pooling_equals_one_text_at_a_time(monkeypatch):
    texts = [b"abc" * 700, b"", None, b"x", b"abc xyz " * 300, b"q" * 64]
    data, sizes = _windows([b"abcabc" * 20, b"xyz zyx" * 15])
    model = language.train(data, sizes, ["a", "a", "b", "b"][: len(sizes)], steps=5)
    monkeypatch.setattr(language, "LANES", 8)
    many = list(language.document_probabilities(model, iter(texts)))
    assert many[1] is None and many[2] is None
    for text, p in zip(texts, many):
        if text:
            cut, size = language.windows_of(text)
            assert np.allclose(p, language.window_sums(model, cut, size).sum(axis=0) / len(text), atol=1e-5)
            assert abs(p.sum() - 1) < 1e-4


def test_language_edges(spark, frame, edges):
    docs = frame([*edges, (8, "12345 !?")]).withColumn("lang", F.when(F.col("doc_id") == 1, "xx").otherwise("en"))
    model = language.fit_language(docs)
    rows = language.with_language(docs, model).collect()
    assert len(rows) == len(edges) + 1
    for r in rows:
        letters = any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"], r["score"] > 0) == (("en", True) if letters else ("und", False))
    empty = docs.limit(0)
    none = language.fit_language(empty)
    assert language.with_language(empty, none).count() == 0
    assert {r["lang_pred"] for r in language.with_language(docs, none).collect()} == {"und"}


def test_bounded_sample(spark):
    rows = spark.range(20_000).withColumnRenamed("id", "doc_id")
    n = bounded_sample(rows, "doc_id", 1_000).count()
    assert 800 < n < 1200
    assert bounded_sample(rows.limit(50), "doc_id", 1_000).count() == 50
    assert bounded_sample(rows.limit(0), "doc_id", 1_000).count() == 0


def test_quotas_give_what_small_classes_leave():
    assert quotas({"a": 1000, "b": 3, "c": 40}, 100) == {"b": 3, "c": 40, "a": 57}
    assert quotas({"a": 5, "b": 3}, 100) == {"a": 5, "b": 3}
    assert quotas({"a": 9, "b": 9, "c": 9}, 2) == {"a": 1, "b": 1, "c": 1} and quotas({}, 5) == {}


def test_stratified_sample_has_every_class(spark):
    rows = spark.range(20_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 5000 == 7, "xx").otherwise("en").alias("lang"))
    drawn = stratified_sample(rows.union(rows), "doc_id", "lang", 100).groupBy("lang").count().collect()
    assert {r["lang"]: r["count"] for r in drawn} == {"xx": 4, "en": 96}


def test_a_rare_language_is_learnt(spark):
    text = F.when(F.col("id") % 4000 < 2, F.lit("zq zq zqz qz zqq ")).otherwise(F.lit("the old house and the sea "))
    rows = spark.range(20_000).select(F.col("id").alias("doc_id"), F.repeat(text, 20).alias("text"), text.startswith("zq").alias("rare"))
    docs = rows.withColumn("lang", F.when(F.col("rare"), "xx").otherwise("en"))
    model = language.fit_language(docs, max_rows=60, windows=4, steps=40)
    assert model.names == ["en", "xx"]
    found = language.with_language(docs.filter("doc_id % 4000 < 4"), model).collect()
    assert all(r["lang_pred"] == r["lang"] for r in found)


def test_windows_are_drawn_over_the_whole_text():
    text = b"".join(bytes([65 + i % 60]) * language.WINDOW for i in range(50)) + b"end"
    cut, sizes = language.drawn_windows(text, 20)
    whole, _ = language.windows_of(text)
    assert len({c.tobytes() for c in cut}) == 20 == len(sizes) and {c.tobytes() for c in cut} <= {c.tobytes() for c in whole}
    assert len(language.drawn_windows(text, 99)[0]) == 51 and len(language.drawn_windows(b"", 3)[0]) == 0


def test_a_rare_label_is_learnt(spark):
    bad = F.col("id") % 5000 < 2
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), F.when(bad, "###!!! $$$%%%").otherwise("calm plain words").alias("text"))
    labels = spark.range(30_000).select(F.col("id").alias("doc_id"), F.when(bad, 0).otherwise(1).alias("quality"))
    model = quality.fit_quality(docs, labels, max_rows=60)
    scored = {r["text"]: r["score"] for r in quality.with_quality(docs.filter("doc_id < 4"), model).collect()}
    assert scored["###!!! $$$%%%"] < 0.5 < scored["calm plain words"]


def test_repeated_labels_and_documents_count_as_often(spark):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(40)] + [(1, "text 1")], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(1, 1), (2, 0)], "doc_id bigint, quality int")
    seen = []
    real, quality.fit_rows = quality.fit_rows, lambda rows, positive: seen.append(positive) or real(rows, positive)
    try:
        quality.fit_quality(docs, labels)
    finally:
        quality.fit_rows = real
    kept = labels.filter(~held_out(F.col("doc_id"))).join(docs, "doc_id").groupBy("quality").count().collect()
    assert {r["quality"]: r["count"] for r in kept} == {1: int(seen[0].sum()), 0: int((~seen[0]).sum())}
