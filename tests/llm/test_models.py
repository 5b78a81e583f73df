"""Toxicity and quality: held-out accuracy, gradients, flat trees; rules and outliers against plain versions."""

import random
import re
import zlib

import numpy as np
import pytest
from cases import WORD, awkward, empty, prose, table
from pyspark.sql import functions as F

from callmart.llm import outliers, quality, toxicity
from callmart.llm.common import crc_fold, labelled_sample
from callmart.llm.queries import QUERIES

LARGE = "/root/testdata/sf0.1"


def test_folds(spark):
    rows = [(i,) for i in (0, 1, 17, 123456, None)]
    found = spark.createDataFrame(rows, "doc_id long").select("doc_id", crc_fold("doc_id", 5).alias("f")).collect()
    assert all(r.f == zlib.crc32(b"" if r.doc_id is None else str(r.doc_id).encode()) % 5 for r in found)


@pytest.mark.parametrize("name, label, folds, held, least", [("op5_toxicity", "toxic", 5, 0, 0.97), ("op8_quality", "quality", 4, 2, 0.93)])
def test_held_out_accuracy(spark, name, label, folds, held, least):
    found = {r.doc_id: r for r in QUERIES[name](spark, LARGE).collect()}
    assert len(found) == spark.read.parquet(f"{LARGE}/documents.parquet").count()
    labels = {r.doc_id: r[label] for r in spark.read.parquet(f"{LARGE}/labels.parquet").collect() if r.doc_id in found}
    held_out = {i: y for i, y in labels.items() if zlib.crc32(str(i).encode()) % folds == held}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % folds == held) and 0 <= r.score <= 1 for i, r in found.items())
    right = [found[i].predicted == y for i, y in held_out.items()]
    for y in (0, 1):
        own = [found[i].predicted == y for i in held_out if held_out[i] == y]
        print(name, y, len(own), sum(own) / len(own))
    assert sum(right) / len(right) >= least


def test_offending_sentences(spark):
    rnd = random.Random(5)
    bad = "awful nasty vile".split()
    rows, labels = [], []
    for i in range(600):
        sentences = [prose(rnd, 8) for _ in range(rnd.randint(1, 12))]
        if i % 4 == 0:
            k = rnd.randrange(len(sentences))
            sentences[k] = f"{prose(rnd, 3)} {rnd.choice(bad)} {prose(rnd, 3)}"
        rows.append((i, ". ".join(sentences) + "."))
        labels.append((i, 1, int(i % 4 == 0)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([*labels, (None, 1, 1), (7, None, None)], "doc_id long, quality int, toxic int")
    model = toxicity.train(docs, labels, F.col("doc_id") < 400)
    texts = dict(rows)
    for r in toxicity.score(docs, model).collect():
        assert r.predicted == int(r.doc_id % 4 == 0)
        spots = [texts[r.doc_id][x["first"] : x["end"]] for x in r.offending]
        assert len(spots) == r.predicted and all(re.search("|".join(bad), s) for s in spots)
    kept = toxicity.keep_clean(docs, model)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {i for i in range(600) if i % 4}
    # Both bounds of the sample hold.
    assert toxicity.train(docs, labels, F.lit(True), rows=0).weights.any() == False  # noqa: E712
    assert toxicity.train(docs, labels, F.lit(True), max_bytes=10).weights.any() == False  # noqa: E712


def test_awkward_rows_are_scored(spark):
    rows = awkward()
    docs = table(spark, rows)
    weights = np.zeros(toxicity.PLACES, np.float32)
    weights[toxicity.features("House,")[0]] = 9
    model = toxicity.SentenceModel(weights, -6.0)
    found = toxicity.score(docs, model).collect()
    assert len(found) == len(rows)
    for r in found:
        if r.doc_id in (400, 401, 402):
            assert r.score < 0.01 and not r.offending
    assert toxicity.keep_clean(docs, model).columns == docs.columns
    trees = quality.fit(np.zeros((0, len(quality.STATISTICS))), np.zeros(0))
    assert {r.score for r in quality.score(docs, trees).collect()} == {0.5}
    assert toxicity.score(empty(spark), model).count() == quality.score(empty(spark), trees).count() == 0
    assert toxicity.keep_clean(empty(spark), model).count() == 0


def test_noisy_or():
    p = np.array([0.1, 0.5, 0.2])
    assert toxicity.noisy_or(p) == pytest.approx(1 - 0.9 * 0.5 * 0.8)
    assert toxicity.noisy_or(np.array([])) == 0 and toxicity.noisy_or(np.array([1.0, 0.3])) == 1


def test_trees_learn_and_walk_like_nodes():
    rnd = np.random.default_rng(6)
    x = rnd.normal(size=(3000, 5))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    trees = quality.fit(x[:2000], y[:2000], trees=40)
    assert ((trees.score(x[2000:]) > 0.5) == y[2000:]).mean() > 0.95

    def walk(row):
        total = trees.base
        for t in range(len(trees.value)):
            node = 0
            while node < trees.feature.shape[1]:
                node = 2 * node + 1 + (row[trees.feature[t, node]] > trees.limit[t, node])
            total += trees.value[t, node - trees.feature.shape[1]]
        return 1 / (1 + np.exp(-total))

    assert np.allclose([walk(r) for r in x[:50]], trees.score(x[:50]))
    assert np.allclose(quality.fit(x, np.ones(len(x))).score(x), 1, atol=1e-3)


def plain_statistics(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    count: dict = {}
    for w in windows:
        count[w] = count.get(w, 0) + 1
    covered = {i + k for i, w in enumerate(windows) if count[w] > 1 for k in range(3)}
    return (
        len(words),
        sum(map(len, words)),
        sum(c in "#*$%&|<>" for c in text),
        len(lines) - len(set(lines)),
        len(covered),
    )


def test_statistics_and_base_rules(spark):
    rows = [*awkward(), (600, "#a# *b* $%&|<>\n"), (601, "x y z x y z q x y"), (602, "\x85   \xa0a b")]
    found = outliers.judge(table(spark, rows)).collect()
    want = []
    for i, t in rows:
        s = plain_statistics(t)
        want.append((str(i), *s, s[0] < 50 or 100 * s[4] > 50 * s[0]))
    got = [(str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in found]
    assert sorted(got) == sorted(want)
    assert all(not r.kept for r in found if r.base_failed)
    assert outliers.judge(empty(spark)).count() == 0


def test_outliers_of_each_group_are_rejected(spark):
    """A third of a group is odd in the same way, which a plain covariance would get used to."""
    rnd = random.Random(8)
    rows = []
    for i in range(1200):
        group, odd = i % 2, i % 3 == 0 and i >= 600
        words = [rnd.choice("abcdefgh") * rnd.randint(2, 9) + str(rnd.randint(0, 99)) for _ in range(rnd.randint(60, 200))]
        if odd:
            words = [w + "$$$##" for w in words]
        rows.append((i, " ".join(words), "en", f"s{group}", odd))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, odd boolean")
    found = {r.doc_id: r for r in outliers.judge(docs).collect()}
    for i, _, _, _, odd in rows:
        assert found[i].kept != odd


def test_covariance_determinant(spark):
    """The estimate's half has a determinant near the best that many random starts find."""
    rnd = np.random.default_rng(9)
    x = np.vstack([rnd.normal(0, 1, (700, 5)), rnd.normal(6, 0.3, (300, 5))])
    points = spark.createDataFrame(
        [(i, "g", *map(float, r)) for i, r in enumerate(x)], "doc_id long, grp string, " + ", ".join(f"{f} double" for f in outliers.FEATURES)
    )
    found = outliers.covariance_estimates(points, steps=8).collect()
    assert len(found) == 1

    def logdet(own):
        return np.linalg.slogdet(np.cov(x[own].T, bias=True) + outliers.FLOOR * np.eye(5))[1]

    best = np.inf
    for _ in range(30):
        own = rnd.choice(len(x), 12, replace=False)
        for _ in range(15):
            centre, cov = x[own].mean(axis=0), np.cov(x[own].T, bias=True) + outliers.FLOOR * np.eye(5)
            d = np.einsum("ij,jk,ik->i", x - centre, np.linalg.inv(cov), x - centre)
            own = np.argsort(d)[: len(x) // 2]
        best = min(best, logdet(own))
    assert found[0].logdet <= best + 0.3


def test_a_text_that_does_not_fit_is_passed_over(spark):
    """The first in hash order is longer than all others together."""
    ids = [r.doc_id for r in spark.range(50).select(F.col("id").alias("doc_id")).orderBy(F.xxhash64("doc_id")).collect()]
    rows = [(i, "x" * 5000 if i == ids[0] else f"text {i:03d}") for i in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(50)], "doc_id long, toxic int")
    draw = lambda size, **more: labelled_sample(docs, labels, "toxic", F.lit(True), 100, size, **more)
    assert draw(1000) == [(f"text {i:03d}".encode(), i % 2) for i in ids[1:]]
    assert draw(16) == [(f"text {i:03d}".encode(), i % 2) for i in ids[1:3]]
    assert draw(5) == []
    with pytest.raises(ValueError, match="fits"):
        draw(5, required=True)


def test_moderate_outliers_are_rejected(spark):
    """A few in a hundred with 0.3 to 0.5 symbols a word, or with 30 to 45 % of their lines repeated; ordinary ones stay."""
    rnd = random.Random(12)
    rows = []
    for i in range(800):
        words = [rnd.choice("abcdefgh") * rnd.randint(2, 9) + str(rnd.randint(0, 99)) for _ in range(rnd.randint(100, 300))]
        lines = [" ".join(words[k : k + 5]) for k in range(0, len(words), 5)]
        odd = i % 20 if i % 20 < 2 else None
        if odd == 0:
            lines = [line.replace(" ", "$ ", 2) if rnd.random() < rnd.uniform(0.75, 1.0) else line for line in lines]
        if odd == 1:
            lines += [rnd.choice(lines[:3])] * round(len(lines) * rnd.uniform(0.45, 0.8))
        rows.append((i, "\n".join(lines), "en", "web", odd is not None))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, odd boolean")
    found = {r.doc_id: r for r in outliers.judge(docs).collect()}
    odd = [found[i] for i, _, _, _, x in rows if x and not found[i].base_failed]
    assert len(odd) >= 40 and not any(r.kept for r in odd)
    assert sum(not found[i].kept for i, _, _, _, x in rows if not x) <= 8


def odd_and_plain(rnd, n, source, first):
    """Texts of one source, one in twelve with many symbols."""
    rows = []
    for i in range(n):
        words = [rnd.choice("abcdefgh") * rnd.randint(2, 9) + str(rnd.randint(0, 99)) for _ in range(rnd.randint(80, 250))]
        odd = i % 12 == 3
        text = " ".join(w + "$#" if odd else w for w in words)
        rows.append((first + i, text, "en" if source != "other" else None, source, odd))
    return rows


def test_every_group_has_an_estimate(spark):
    """Groups of 30 to 199 rows by themselves, small ones together, a small rest by all rows, and a table of 171 rows."""
    rnd = random.Random(21)
    sizes = {"a": 30, "b": 90, "c": 199, "d": 15, "e": 25, "other": 12}
    rows = [r for k, (s, n) in enumerate(sizes.items()) for r in odd_and_plain(rnd, n, s, 1000 * k)]
    schema = "doc_id long, text string, lang string, source string, odd boolean"
    for part in (rows, rows[:171], [r for r in rows if r[3] == "other"]):
        found = {r.doc_id: r for r in outliers.judge(spark.createDataFrame(part, schema)).collect()}
        assert not any(found[i].kept for i, *_, odd in part if odd)
        assert sum(not found[i].kept for i, *_, odd in part if not odd) <= len(part) // 25
        assert all(r.distance is not None for r in found.values())


def test_distances_by_numpy(spark):
    """The distance of each row from its group's estimate, over the group's median distance."""
    rnd = random.Random(22)
    rows = odd_and_plain(rnd, 120, "a", 0) + odd_and_plain(rnd, 60, "b", 500)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, odd boolean")
    found = {r.doc_id: r for r in outliers.judge(docs).collect()}
    stats = outliers._features(outliers.statistics(docs)).collect()
    assert not any(r.base_failed for r in found.values())
    for source in "ab":
        own = [r for r in stats if r.source == source]
        x = np.array([[r[f] for f in outliers.FEATURES] for r in own])
        points = spark.createDataFrame([(r.doc_id, "own/=en/=" + source, *map(float, v)) for r, v in zip(own, x, strict=True)],
            "doc_id long, grp string, " + ", ".join(f"{f} double" for f in outliers.FEATURES))
        e = outliers.covariance_estimates(points).first()
        centre = np.array([e[f"m{i}"] for i in range(5)])
        root = np.array([[e[f"l{i}{j}"] if j <= i else 0.0 for j in range(5)] for i in range(5)])
        distance = np.sqrt((np.linalg.solve(root, (x - centre).T) ** 2).sum(axis=0))
        # The estimate is the moments of about half of the rows, those nearest to it or nearly so.
        near = np.argsort(distance)[: len(x) // 2]
        cov = np.cov(x[near].T, bias=True) + outliers.FLOOR * np.eye(5)
        assert abs(np.linalg.slogdet(cov)[1] - np.linalg.slogdet(root @ root.T)[1]) < 1.0
        scale = max(1.0, np.median(distance) / 2.086) * (1 + outliers.FEW / len(x))
        got = np.array([found[r.doc_id].distance for r in own])
        assert np.allclose(got, distance / scale, rtol=0.06)
        assert [found[r.doc_id].kept for r in own] == (got <= outliers.CUT).tolist()
