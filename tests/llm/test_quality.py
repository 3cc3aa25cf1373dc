"""Quality votes: held-out accuracy, a plain version of features and votes, odd rows."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from clickmetrics.llm import quality
from clickmetrics.llm.queries import table

SF = "/root/testdata/sf0.01"
GOOD = "The road of thanks was long and they went on, so we read it."
BAD = "BUY!! NOW!! CLICK!! HERE!! WIN!!"


def _crc(key):
    return zlib.crc32(str(key).encode())


def test_held_out_accuracy(spark):
    scored = quality.score_documents(table(spark, SF, "documents"), table(spark, SF, "labels"))
    labels = table(spark, SF, "labels").select("doc_id", "quality")
    rows = scored.join(labels, "doc_id").collect()
    assert all(r["held_out"] == (_crc(r["doc_id"]) % 3 == 1) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    for label in (0, 1):
        held = [r["predicted"] == label for r in rows if r["held_out"] and r["quality"] == label]
        assert len(held) > 10 and sum(held) / len(held) >= 0.95


def test_held_out_labels_change_nothing(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    flipped = labels.selectExpr(
        "doc_id", "IF(crc32(CAST(CAST(doc_id AS string) AS binary)) % 3 = 1, 1 - quality, quality) AS quality"
    )
    first, second = (sorted(map(tuple, quality.score_documents(docs, x).collect())) for x in (labels, flipped))
    assert first == second


def _plain_terms(text):
    """Places and counts, word by word."""
    words = text.split()
    plain = [zlib.crc32((w.strip(quality.EDGE).lower() or w).encode()) for w in words]
    out = Counter(p % quality.WORD_PLACES for p in plain)
    for w in words:
        form = "".join(
            "A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c for c in w
        )
        form = re.sub(r"([Aa0])\1+", r"\1", form)
        form = re.sub(r"(.)\1+", r"\1\1", form)
        out[quality.WORD_PLACES + zlib.crc32(form.encode()) % quality.SHAPE_PLACES] += 1
    for k, p in enumerate(plain):
        back = 1 if k > 0 and plain[k - 1] == p else 2 if k > 1 and plain[k - 2] == p else 0
        out[quality.WORD_PLACES + quality.SHAPE_PLACES + back] += 1
    return out


def _plain_weights(terms, idf):
    first_shape, first_repeat = quality.WORD_PLACES, quality.WORD_PLACES + quality.SHAPE_PLACES
    out = {}
    for lo, hi in ((0, first_shape), (first_shape, first_repeat), (first_repeat, quality.PLACES)):
        view = {p: (math.log1p(n) if p < first_shape else n) * idf[p] for p, n in terms.items() if lo <= p < hi}
        length = math.sqrt(sum(v * v for v in view.values()))
        out.update((p, v / length / math.sqrt(3)) for p, v in view.items())
    return out


def test_scores_equal_plain_votes():
    texts = [GOOD, BAD, "the the the the", "Ab,c 12 x!!", GOOD + " " + BAD, "über NAÏVE - - ok", ""]
    learnt = [(k % 2, t + f" w{k}") for k, t in enumerate([GOOD, BAD] * 12 + ["the the", "a 1 b 2"])]
    idf = 1 + (np.arange(quality.PLACES) % 7) / 3
    rows = [(label, *quality.term_counts([t])[1:]) for label, t in learnt]
    model = quality.fit(rows, idf, latent=8)

    def project(text):
        terms = _plain_weights(_plain_terms(text), idf)
        v = sum((w * model.projection[p].astype(float) for p, w in terms.items()), np.zeros(8))
        return v / (np.linalg.norm(v) or 1)

    known = [(label, project(t)) for label, t in learnt]
    expected = []
    for text in texts:
        v = project(text)
        near = sorted(((float(v @ u), label) for label, u in known), key=lambda x: -x[0])[: quality.NEIGHBOURS]
        weight = [max(s, 0) ** quality.SHARPNESS for s, _ in near]
        total = sum(weight)
        expected.append(sum(w * label for w, (_, label) in zip(weight, near)) / total if total else 0.5)
    assert model.vote(model.latent(texts)) == pytest.approx(expected, abs=2e-3)


def test_latent_space_is_the_leading_one():
    rows = [(k % 2, *quality.term_counts([t])[1:]) for k, t in enumerate([GOOD, BAD, "x y z", "1 2 3", "the the"] * 3)]
    idf = np.ones(quality.PLACES)
    model = quality.fit(rows, idf, latent=3)
    x = np.zeros((len(rows), quality.PLACES))
    for k, (_, place, count) in enumerate(rows):
        x[k, place] = quality.weights(np.zeros(len(place), np.int64), place, count, idf)
    exact = np.linalg.svd(x, full_matrices=False)[2][:3]
    assert np.linalg.svd(exact @ model.projection)[1] == pytest.approx(np.ones(3), abs=1e-3)


def _docs(spark, rows):
    extra = "doc_id bigint, text string, score double, quality int, places int, held_out int"
    return spark.createDataFrame([(i, t, 0.1, 0, 1, 2) for i, t in rows], extra).repartition(2)


def test_odd_rows(spark):
    rows = [(k, (GOOD if k % 2 else BAD) + f" no {k}") for k in range(60)]
    rows += [(100, None), (101, ""), (102, " \n"), (None, BAD), (None, GOOD), (7, "again seven"), (103, "a" * 2_000_000)]
    rows += [(104, (BAD + " ") * 20_000)]
    labels = [(k, k % 2) for k in range(60)] + [(None, 1), (3, None), (5, 7), (8, 1), (999, 1)]
    marked = spark.createDataFrame([(i, q, "t") for i, q in labels], "doc_id bigint, quality int, text string")
    found = quality.score_documents(_docs(spark, rows), marked).collect()
    assert sorted((r["doc_id"] for r in found), key=str) == sorted((i for i, _ in rows), key=str)
    by_id = {r["doc_id"]: r for r in found if r["doc_id"] not in (None, 7)}
    assert [by_id[k]["score"] for k in (100, 101, 102)] == [0.5] * 3
    assert all(by_id[k]["predicted"] == k % 2 for k in range(60) if k != 7)
    assert by_id[104]["predicted"] == 0
    assert sorted(r["predicted"] for r in found if r["doc_id"] is None) == [0, 1]
    assert not any(r["held_out"] for r in found if r["doc_id"] is None)


@pytest.mark.parametrize("labels", [[], [(1, 1), (2, 1)]])
def test_without_both_labels_or_rows(spark, labels):
    marked = spark.createDataFrame(labels, "doc_id bigint, quality int")
    found = quality.score_documents(_docs(spark, [(1, GOOD), (2, BAD)]), marked).collect()
    assert [r["score"] for r in found] == [0.5, 0.5]
    assert quality.score_documents(_docs(spark, []), marked).collect() == []
