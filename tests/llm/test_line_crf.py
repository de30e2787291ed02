import itertools

import numpy as np
import pyarrow as pa

from corpusproof.llm.line_crf import LineCrf, fit, quality_scores


def test_marginals_are_those_of_all_labelings():
    draw = np.random.RandomState(3)
    first = np.array([0, 4, 4, 5, 11])
    features = draw.randint(0, 7, (11, 2))
    model = LineCrf(draw.normal(size=7), draw.normal(size=(2, 2)), 0.3)
    got = model.marginals(features, first)
    e = model.emissions(features)
    for a, b in zip(first[:-1], first[1:], strict=True):
        total, ones = 0.0, np.zeros(b - a)
        for labels in itertools.product((0, 1), repeat=b - a):
            if not labels:
                continue
            score = model.begin * labels[0] + sum(e[a + i] * y for i, y in enumerate(labels)) + sum(model.trans[x, y] for x, y in itertools.pairwise(labels))
            total += np.exp(score)
            ones += np.exp(score) * np.array(labels)
        if b > a:
            assert np.allclose(got[a:b], ones / total)


def _texts(n, seed):
    draw = np.random.RandomState(seed)
    words = ["the", "of", "rain", "stone", "answer", "and", "paper", "walks"]
    good = ["\n".join(" ".join(draw.choice(words, 9)).capitalize() + "." for _ in range(4)) for _ in range(n)]
    bad = ["\n".join(" ".join(w + "$$$" for w in draw.choice(words, 9)) for _ in range(3)) for _ in range(n)]
    return good + bad, np.array([1] * n + [0] * n)


def test_held_out_accuracy():
    texts, labels = _texts(60, 1)
    model = fit(pa.array(texts), labels, rounds=40)
    texts, labels = _texts(60, 2)
    scores = model.scores(pa.array(texts))
    assert ((scores >= 0.5) == (labels == 1)).mean() > 0.97
    assert ((scores >= 0) & (scores <= 1)).all()


def test_whole_table_with_awkward_rows(spark, awkward, nothing):
    labels = spark.createDataFrame([(20 + k, k % 2, 0) for k in range(40)] + [(None, 1, 0), (1, None, 0)], "doc_id long, quality int, toxic int")
    got = quality_scores(awkward, labels)
    assert got.columns == [*awkward.columns, "quality_score"]
    rows = got.toPandas()
    assert len(rows) == awkward.count() and rows.quality_score.between(0, 1).all()
    assert rows[rows.doc_id == 2].quality_score.nunique() == 1
    assert rows[rows.doc_id == 4].quality_score.iloc[0] == rows[rows.doc_id == 5].quality_score.iloc[0]
    assert quality_scores(nothing, labels).count() == 0
    assert quality_scores(awkward, labels.limit(0)).select("quality_score").distinct().count() >= 1
