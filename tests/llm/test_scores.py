"""Held-out accuracy of the classifiers, and their defined results."""

import math
import random

import numpy as np
import pytest

from tests.llm import brute
from tidemill.llm import language, quality, toxicity

MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def marks(spark):
    rows = spark.read.parquet(f"{MEDIUM}/labels.parquet").collect()
    return {r.doc_id: r for r in rows}


def test_toxicity_held_out(spark, marks):
    found = toxicity.op1_toxicity(spark, MEDIUM).collect()
    assert len(found) == 1000
    assert all(r.held_out == (brute.crc(r.doc_id, 3) == 1) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in found)
    scored = [(r.score, marks[r.doc_id].toxic) for r in found if r.held_out and r.doc_id in marks]
    good, bad = [s for s, y in scored if y == 1], [s for s, y in scored if y == 0]
    assert sum((a > b) + 0.5 * (a == b) for a in good for b in bad) / (len(good) * len(bad)) > 0.85
    assert sum(s >= 0.7 for s in bad) <= 0.02 * len(bad)


def test_toxicity_locates_sentences():
    texts = [f"A calm start {k}. Then vile{k % 3} words come. And it ends." for k in range(30)] + [f"A calm start {k}. Then kind words come. And it ends." for k in range(60)]
    model = toxicity.SentenceModel(toxicity.fit_noisy_or(texts, [1] * 30 + [0] * 60))
    text = "All is calm. Some vile1 thing. The end."
    worst = max(model.sentences(text), key=lambda s: s[2])
    assert "vile1" in text[worst[0] : worst[1]] and worst[2] > 0.5
    assert model.score(model.sentences("")) == 0
    assert model.score(model.sentences(text)) == model.score(model.sentences(text))


def test_language_held_out(spark):
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{MEDIUM}/documents.parquet").select("doc_id", "lang").collect()}
    found = language.op2_language(spark, MEDIUM).collect()
    assert all(r.held_out == (brute.crc(r.doc_id, 3) == 1) and 0 <= r.score <= 1 for r in found)
    held = [r.lang_pred == lang[r.doc_id] for r in found if r.held_out]
    assert sum(held) > 0.97 * len(held)


def test_quality_held_out(spark, marks):
    found = quality.op5_quality(spark, MEDIUM).collect()
    assert all(r.held_out == (brute.crc(r.doc_id, 4) == 2) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in found)
    held = [r.predicted == marks[r.doc_id].quality for r in found if r.held_out and r.doc_id in marks]
    assert sum(held) > 0.95 * len(held)


def test_quality_counts_the_commonest_of_all_words():
    at = quality.FEATURES.index("commonest")
    assert quality.features("a title line " + "buy this " * 20)[at] == quality.features("buy this " * 20 + "a title line")[at] == 20 / 43
    assert quality.features("")[at] == 0 and quality.features("one")[at] == 1


def test_ngrams_count_both_ways():
    few, many = "abc de, f", "".join(chr(0x4E00 + k) for k in range(90)) + " ab"
    for text in (few, many):
        codes, counts = language.ngrams(text)
        clean = "_" + "_".join("".join(c if c.isalpha() else " " for c in text).split()) + "_"
        wanted = {}
        for n in (1, 2, 3):
            for k in range(len(clean) - n + 1):
                g = clean[k : k + n]
                if "_" in g[1:-1] or g == "_":
                    continue
                code = 0
                for c in g:
                    code = code << 21 | ord(c)
                wanted[code] = wanted.get(code, 0) + 1
        assert dict(zip(codes.tolist(), counts.tolist(), strict=True)) == wanted


def _plain_ngrams(text):
    clean = "_" + "_".join("".join(c if c.isalpha() else " " for c in text.lower()).split()) + "_"
    found = {}
    for n in (1, 2, 3):
        for k in range(len(clean) - n + 1):
            g = clean[k : k + n]
            if g != "_" and "_" not in g[1:-1]:
                found[g] = found.get(g, 0) + 1
    return found


def _plain_order(found, size):
    code = lambda g: sum(ord(c) << 21 * k for k, c in enumerate(reversed(g)))
    return sorted(found, key=lambda g: (-found[g], code(g)))[:size]


def test_language_by_the_plain_rule(spark):
    """Profiles and out-of-place distances, counted by dictionaries and lists."""
    r = random.Random(2)
    rows = [(k, " ".join("".join(r.choice("abcdeé" if k % 2 else "cdefgß") for _ in range(r.randrange(1, 7))) for _ in range(r.randrange(1, 30))), ("xx", "yy")[k % 2]) for k in range(40)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    profiles = language.fit_profiles(frame, size=50)
    plain = {}
    for lang in ("xx", "yy"):
        total = {}
        for _, text, own in rows:
            if own == lang:
                for g, n in _plain_ngrams(text).items():
                    total[g] = total.get(g, 0) + n
        plain[lang] = _plain_order(total, 50)
    for _, text, _ in [*rows, (0, "Zz cde 1", None), (0, "é", None)]:
        ordered = _plain_order(_plain_ngrams(text), 50)
        away = {lang: sum(abs(known.index(g) - k) if g in known else 50 for k, g in enumerate(ordered)) for lang, known in plain.items()}
        best = min(sorted(away), key=away.get)
        assert profiles.predict(text) == (best, 1 - away[best] / (50 * len(ordered)))
    with pytest.raises(ValueError, match="more than 1 different"):
        language.fit_profiles(frame, languages=1)


def test_noisy_or_is_fitted(spark):
    """The score is one minus the product of the sentences' complements, and no single weight can be moved to a better likelihood."""
    r = random.Random(5)
    say = lambda words: " ".join(r.choice(words) for _ in range(4))
    texts = [". ".join(say(["mild", "calm", "soft", "grim"]) for _ in range(3)) + (". " + say(["grim", "vile", "mild"]) if k % 3 == 0 else "") for k in range(60)]
    marks = [int("vile" in t or k % 20 == 1) for k, t in enumerate(texts)]
    at, starts, owner, words = [], [], [], ["mild", "calm", "soft", "grim", "vile"]
    counts = np.zeros(60)
    for k, t in enumerate(texts):
        for sentence in t.split(". "):
            starts.append(len(at))
            owner.append(k)
            at += [words.index(w) for w in sorted(set(sentence.split()))]
            counts[k] += 1
    y = np.array(marks, float)
    w = toxicity._descend(np.array(at, np.int32), np.array(starts), np.array(owner), y, counts, np.append(np.zeros(5), -2.0), 3000, 0.05, 0.0)

    def loss(w):
        total, clean = 0.0, [1.0] * 60
        for k, (a, b) in enumerate(zip(starts, [*starts[1:], len(at)], strict=True)):
            clean[owner[k]] *= 1 - 1 / (1 + math.exp(-(sum(w[at[a:b]]) + w[-1])))
        for k in range(60):
            weight = 60 / (2 * y.sum()) if y[k] else 60 / (2 * (60 - y.sum()))
            total -= weight / 60 * math.log(max(1 - clean[k], 1e-9) if y[k] else clean[k])
        return total

    found = loss(w)
    for k in range(6):
        for step in (0.05, -0.05):
            moved = w.copy()
            moved[k] += step
            assert loss(moved) >= found - 1e-5
    model = toxicity.SentenceModel({"": -1.0, "vile": 2.0, "mild": -1.0})
    p = [1 / (1 + math.exp(-z)) for z in (1.0, -2.0, -1.0)]
    assert model.score(model.sentences("A vile one. Mild! Neither?")) == pytest.approx(1 - (1 - p[0]) * (1 - p[1]) * (1 - p[2]))


def test_ranking_is_fitted_and_cut_by_quantile():
    """Logistic loss on differences of pairs, against the gradient summed pair by pair; the cut leaves the share of good documents above."""
    random_numbers = np.random.default_rng(1)
    values = random_numbers.normal(size=(200, len(quality.FEATURES)))
    marks = (values[:, 0] - 2 * values[:, 1] + random_numbers.normal(size=200) > 0.5).astype(float)
    share = float(marks.mean())
    ranking = quality.fit_ranking(values, marks, share, pairs=3000, steps=3000)
    again = np.random.default_rng(quality.SEED)
    scaled = (values - values.mean(axis=0)) / (values.std(axis=0) + 1e-6)
    better, worse = again.choice(np.flatnonzero(marks == 1), 3000), again.choice(np.flatnonzero(marks == 0), 3000)
    w = np.array(ranking.weights) * (values.std(axis=0) + 1e-6)
    gradient = quality.L2 * w
    for a, b in zip(better.tolist(), worse.tolist(), strict=True):
        d = scaled[a] - scaled[b]
        gradient = gradient - d / (1 + math.exp(d @ w)) / 3000
    assert np.abs(gradient).max() < 2e-3
    assert w[0] > 0 > w[1] and abs((ranking.score(values) >= 0.7).mean() - share) < 0.01


def test_ranking_counts_all_pairs_of_all_rows(spark):
    """The gradient summed over every pair of training rows vanishes, the cut is the quantile of all their scores, and partitions change nothing."""
    r = random.Random(8)
    rows = [(k, " ".join(r.choice(("Some", "words", "9", "go.", "on,", "##" if k % 3 else "and")) for _ in range(r.randint(1, 40))), int(r.random() < (0.3, 0.8, 0.7)[k % 3])) for k in range(1200)]
    docs = spark.createDataFrame([(k, t) for k, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(k, m) for k, _, m in rows], "doc_id long, quality int")
    ranking = quality.fit_quality(docs, labels)
    train = [(quality.features(t), m) for k, t, m in rows if brute.crc(k, 4) != 2]
    values, marks = np.array([v for v, _ in train]), np.array([m for _, m in train])
    spread = values.std(axis=0) + 1e-6
    scaled, w = (values - values.mean(axis=0)) / spread, np.array(ranking.weights) * spread
    good, bad = scaled[marks == 1], scaled[marks == 0]
    gradient = quality.L2 * w
    for a in good:
        lose = 1 / (1 + np.exp((a - bad) @ w))
        gradient = gradient - lose @ (a - bad) / (len(good) * len(bad))
    assert np.abs(gradient).max() < 2e-4
    scores = np.sort(ranking.raw(values))
    assert ranking.cut == (scores[len(bad) - 1] + scores[len(bad)]) / 2
    assert ranking == quality.fit_quality(docs.repartition(7), labels.repartition(3))


def test_values_beside_a_place(spark):
    values = [0.5] * 40 + [float(k) ** 3 for k in range(-20, 20)] + [1e-300, -1e300, 0.5000000000000001]
    raw = spark.createDataFrame([(v,) for v in values], "raw double")
    for place in (1, 20, 22, 23, 62, 63, 64, len(values) - 1):
        assert quality._beside(raw, place) == tuple(sorted(values)[place - 1 : place + 1])


def test_odd_rows(odd, odd_rows, spark):
    labels = spark.createDataFrame([(k, k % 2, (k + 1) % 2) for k in range(60)] + [(None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int")
    for scored in (
        toxicity.score_toxicity(odd, toxicity.fit_toxicity(odd, labels)),
        quality.score_quality(odd, quality.fit_quality(odd, labels)),
        language.predict_languages(odd, language.fit_profiles(odd)),
    ):
        rows = scored.collect()
        assert sorted((r.doc_id for r in rows), key=repr) == sorted((i for i, _ in odd_rows), key=repr)
        assert all(0 <= r.score <= 1 for r in rows)
    unknown = {r.doc_id: r.lang_pred for r in rows}
    assert all(unknown[i] == "und" for i in (1, 2, 3, 52))


def test_empty_tables(nothing, spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert toxicity.score_toxicity(nothing, toxicity.fit_toxicity(nothing, labels)).count() == 0
    assert quality.score_quality(nothing, quality.fit_quality(nothing, labels)).count() == 0
    assert language.predict_languages(nothing, language.fit_profiles(nothing)).count() == 0
