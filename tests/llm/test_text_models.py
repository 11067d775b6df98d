import hashlib
import math
import random

import numpy as np
import pytest

from quarry.llm import fingerprints, language_id, logistic, quality, toxicity
from quarry.llm.common import table

from conftest import SF_MID
from llm_fixtures import no_docs, odd_docs  # noqa: F401


@pytest.fixture(scope="session")
def odd_labels(spark):
    return spark.createDataFrame([(5, 1, 0), (5, 1, 0), (6, 0, 1), (None, 1, 1), (8, None, None), (77, 0, 1)], "doc_id long, quality int, toxic int")


def test_scores_of_odd_documents(odd_docs, no_docs, odd_labels):
    for op in (quality, toxicity):
        rows = op.report(odd_docs, odd_labels).collect()
        assert len(rows) == odd_docs.count() and all(0 <= r.score <= 1 and r.held_out is not None for r in rows)
        assert op.report(no_docs, odd_labels.limit(0)).count() == 0
    assert toxicity.clean(odd_docs, odd_labels).columns == odd_docs.columns


def test_language_of_odd_documents(odd_docs, no_docs):
    got = [(r.lang_pred, r.score) for r in language_id.report(odd_docs).collect()]
    for r, (lang, score) in zip(odd_docs.collect(), got):
        assert 0 <= score <= 1 and (lang == "und") == (not any(c.isalpha() for c in r.text or ""))
    assert language_id.report(no_docs).count() == 0


def test_held_out_accuracy(spark):
    docs, labels = table(spark, SF_MID, "documents"), table(spark, SF_MID, "labels")
    lang = language_id.report(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out and lang is not null").collect()
    assert sum(r.lang == r.lang_pred for r in lang) >= 0.98 * len(lang)
    good = quality.report(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert sum(r.predicted == r.quality for r in good) >= 0.97 * len(good)
    toxic = toxicity.report(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert sum(r.predicted == r.toxic for r in toxic) >= 0.93 * len(toxic)


def test_grammar_reads_clauses():
    g = toxicity.Grammar(toxicity.base_lexicon())
    score = lambda t: sum(g.clauses(t)[0])
    assert score("you are an idiot") > score("an idiot") > score("not an idiot") > 0
    assert score("he said an idiot") < score("an idiot") and score("") == 0 and score("a calm text.") == 0
    assert score("i will kill you idiot") > score("kill it. idiot")


def test_fingerprints_against_brute_force(odd_docs, no_docs):
    rows = sorted(odd_docs.collect(), key=lambda r: r.text or "")
    rows.sort(key=lambda r: (r.doc_id is not None, r.doc_id or 0), reverse=True)
    texts = [r.text or "" for r in rows]
    order = sorted(range(len(rows)), key=lambda i: (-(rows[i].doc_id or -1) if rows[i].doc_id is not None else 10**9, texts[i]))
    want = []
    for a, i in enumerate(order):
        t, nxt = texts[i], texts[order[(a + 1) % len(order)]]
        e = t[:len(t) - len(t) // 2] + nxt[:len(t) // 2]
        f, fe = fingerprints.fingerprint(t), fingerprints.fingerprint(e)
        want.append((rows[i].doc_id, len(t), hashlib.sha256(e.encode()).hexdigest(), f, fe, fingerprints.likeness(f, fe),
                     fingerprints.likeness(f, fingerprints.fingerprint(nxt))))
    got = [tuple(r) for r in fingerprints.compare_neighbours(odd_docs).collect()]
    assert sorted(map(str, got)) == sorted(map(str, want))
    assert fingerprints.compare_neighbours(no_docs).count() == 0


# --- op3 against plain arithmetic


def language_docs(spark, languages, texts=8):
    rng = random.Random(1)
    rows = []
    for i in range(languages):
        letters = [chr(0x4E00 + (i * 37 + j) % 20_000) for j in range(9)]
        rows += [(100 * i + 3 * t, "".join(rng.choices(letters, k=40)), f"l{i:04d}") for t in range(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def naive_cosines(model, text):
    """Cosines with all centroids, n-grams counted one by one."""
    codes = [ord(c) if c.isalpha() else 0 for c in text.lower()]
    codes = [0, *[c for i, c in enumerate(codes) if c or not i or codes[i - 1]], 0]
    counts = {}
    for n in language_id.GRAMS:
        for at in range(len(codes) - n + 1):
            key = 0
            for c in codes[at:at + n]:
                key = (key * 0x100000001B3 + c + 1) & 0xFFFFFFFFFFFFFFFF
            hashed = int(language_id.mix64(np.array([key], np.uint64), n)[0]) >> 40
            counts[hashed % language_id.BINS] = counts.get(hashed % language_id.BINS, 0) + 1
    v = {b: (1 + math.log(c)) * model.idf[b] for b, c in counts.items()}
    norm = math.sqrt(sum(x * x for x in v.values()))
    return [sum(x * c[b] for b, x in v.items()) / norm for c in model.centroids]


def test_predictions_against_plain_cosines(spark):
    docs = language_docs(spark, 5)
    model = language_id.train(docs)
    for text in [r.text for r in docs.collect()] + ["mixed 漢字 text, Ünï", "a"]:
        cosines = naive_cosines(model, text)
        lang, score, distance, rejected = model.predict(text)
        best = [max(c for c, o in zip(cosines, model.owner) if o == i) for i in range(5)]
        if max(best) > 1e-9:
            assert lang == model.languages[int(np.argmax(best))]
            assert abs(distance - (1 - max(best))) < 1e-9
            assert abs(score - 1 / sum(math.exp(20 * (b - max(best))) for b in best)) < 1e-9
            assert rejected == (max(best) < model.reach[int(np.argmax(best))]) or abs(max(best) - model.reach[int(np.argmax(best))]) < 1e-8


def test_noise_is_rejected_and_its_own_texts_are_not(spark):
    docs = table(spark, SF_MID, "documents").where("lang is not null")
    noise = spark.createDataFrame([(10**9 + 3 * i, "".join(random.Random(i).choices("qxzjkvwyq 漢кжщ", k=400))) for i in range(30)], "doc_id long, text string")
    got = language_id.report(docs.unionByName(noise, allowMissingColumns=True)).collect()
    own, far = [r for r in got if r.doc_id < 10**9], [r for r in got if r.doc_id >= 10**9]
    assert all(r.rejected for r in far) and sum(r.rejected for r in own) <= 0.02 * len(own)
    assert all(r.lang_pred != "und" or r.rejected for r in got)


def test_more_than_a_thousand_languages(spark, monkeypatch):
    docs = language_docs(spark, 1001, texts=14)
    monkeypatch.setattr(language_id, "SAMPLE_TOTAL", 2500)
    model = language_id.train(docs)
    assert len(model.languages) == 1001 and len(model.owner) >= 900
    monkeypatch.setattr(language_id, "MODEL_BYTES", 8 * language_id.BINS * 1001)
    assert len(language_id.train(docs).owner) <= 1001  # one centroid a language is all that fits
    monkeypatch.setattr(language_id, "MODEL_BYTES", 8 * language_id.BINS * 10)
    with pytest.raises(ValueError):
        language_id.train(docs)


# --- op5 and op7: the fits are minima


def test_pairwise_loss_has_no_slope_at_the_learned_weights():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 4))
    y = (x @ [2.0, -1.0, 0.5, 0.0] + rng.normal(size=300) > 0).astype(int)
    w = quality.bradley_terry(x, y, pairs_per_row=3, seed=5, l2=1e-3)
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    n, order = 3 * max(len(good), len(bad)), np.random.default_rng(5)
    pairs = list(zip(good[np.arange(n) % len(good)], bad[order.permutation(n) % len(bad)]))

    def loss(v):
        return sum(math.log1p(math.exp(-float((x[a] - x[b]) @ v))) for a, b in pairs) / n + 1e-3 * float(v @ v)

    for i in range(4):
        e = np.eye(4)[i] * 1e-4
        assert abs(loss(w + e) - loss(w - e)) / 2e-4 < 1e-4
        assert loss(w) <= min(loss(w + 100 * e), loss(w - 100 * e))


def test_logistic_fit_against_small_steps():
    rng = np.random.default_rng(4)
    x, weight = rng.normal(size=(200, 3)), rng.uniform(0.5, 2, 200)
    y = (rng.uniform(size=200) < 1 / (1 + np.exp(-(x @ [1.0, -2.0, 0.0] + 0.5)))).astype(float)
    w = logistic.fit_logistic(x, y, weight, l2=1e-3)
    z = np.hstack([x, np.ones((200, 1))])
    plain = np.zeros(4)
    for _ in range(20_000):
        p = 1 / (1 + np.exp(-z @ plain))
        plain -= 0.005 * (z.T @ (weight * (p - y)) + 2e-3 * 200 * np.array([1, 1, 1, 0]) * plain)
    assert np.allclose(w, plain, atol=1e-4)


# --- op7: the composed automaton


def naive_clauses(lexicon, text):
    """Clause scores by the four transducers run one after another, word by word."""
    parts = [toxicity.negation(), toxicity.reported(), toxicity.target(), toxicity.chain()]
    scores, score, hits, states = [], 0.0, False, [p.start for p in parts]
    for token in [*toxicity._TOKEN.findall(text.lower()), "."]:
        if token in ".!?;\n":
            scores += [score] if hits else []
            score, hits, states = 0.0, False, [p.start for p in parts]
            continue
        found = [lexicon[s] for s in toxicity.stems(token) if s in lexicon]
        kind, weight = ("Q", 0.0) if token in "\"“”«»" else max(found, key=lambda f: f[1]) if found else ("o", 0.0)
        factor = 1.0
        for i, p in enumerate(parts):
            states[i], times, plus = p.at(states[i], kind)
            factor *= times
            if hits and kind not in "IT":
                score += plus
        if kind in "IT":
            score, hits = score + weight * factor, True
    return scores


def test_composed_automaton_against_its_transducers():
    rng = random.Random(6)
    words = [*"idiot moron kill hurt you them not never said claims calm words here and".split(), '"', "«", ".", "!", "\n"]
    lexicon = toxicity.base_lexicon()
    grammar = toxicity.Grammar(lexicon)
    for _ in range(800):
        text = " ".join(rng.choices(words, k=rng.randrange(0, 25)))
        assert np.allclose(grammar.clauses(text)[0], naive_clauses(lexicon, text))


def test_learned_stems_against_plain_counts(spark):
    rng = random.Random(8)
    rows = [(1, "xylo plain " + " ".join(f"w{rng.randrange(60)}" for _ in range(8))) for _ in range(60)]
    rows += [(0, "plain " + " ".join(f"w{rng.randrange(60)}" for _ in range(8)) + (" vorbit" if i < 2 else "")) for i in range(90)]
    rows += [(1, "vorbit")] * 30
    got = toxicity.learned_stems(spark.createDataFrame(rows, "y int, text string"), 90, 90)
    count = {y: {} for y in (0, 1)}
    for y, text in rows:
        for s in {s for w in set(text.split()) for s in toxicity.stems(w)}:
            count[y][s] = count[y].get(s, 0) + 1
    candidates = {s: n for s, n in count[1].items() if n >= toxicity.MIN_DF}

    def likelihood(k, n, p):
        return (k * math.log(p) if k else 0) + ((n - k) * math.log(1 - p) if n > k else 0)

    want = {}
    for s, a in candidates.items():
        b = count[0].get(s, 0)
        p = (a + b) / 180
        llr = 2 * (likelihood(a, 90, a / 90) + likelihood(b, 90, b / 90) - likelihood(a, 90, p) - likelihood(b, 90, p)) if p < 1 else 0
        if a / 90 > toxicity.MIN_RATIO * b / 90 and llr >= 2 * math.log(len(candidates)) + 2:
            want[s] = math.log((a + 0.5) / 91) - math.log((b + 0.5) / 91)
    assert {"=xylo", "=vorbit"} <= set(want) and set(got) == set(want)
    assert all(abs(got[s] - want[s]) < 1e-9 for s in want)


def test_more_stems_than_a_driver_list_would_hold(spark):
    """120,000 candidate words in toxic texts; the one that matters is found."""
    words = spark.range(40_000).selectExpr("concat_ws(' ', concat('a', id, 'x'), concat('b', id, 'y'), concat('c', id, 'z')) as t")
    words = words.unionAll(words).unionAll(words)
    rows = words.selectExpr("1 as y", "concat('zorgo ', t) as text").unionAll(words.selectExpr("0 as y", "t as text"))
    assert set(toxicity.learned_stems(rows, 120_000, 120_000)) == {"zorg", "zorgo", "=zorgo"}
    assert len(toxicity.learned_stems(rows, 120_000, 120_000, max_bytes=150)) == 2


def test_one_repeated_label_does_not_fill_the_driver(spark):
    rows = [(1, f"text {i}") for i in range(3000)] + [(1, "same")] * 500 + [(i, f"other {i}") for i in range(2, 200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 200)], "doc_id long, toxic int")
    from pyspark.sql import functions as F
    sample, _ = toxicity.labelled_sample(docs, labels, "toxic", 100, F.lit(True))
    assert sample.count() <= 600 and sample.where("text = 'same'").count() <= 1


# --- op4: the parse and the signature


def test_fingerprints_against_a_plain_parse():
    rng = random.Random(9)
    for _ in range(60):
        text = "".join(rng.choices("abé漢 ", k=rng.randrange(0, 120)))
        phrases, at = [], 0
        while at < len(text):  # the shortest phrase that is new
            end = at + 1
            while end < len(text) and text[at:end] in phrases:
                end += 1
            phrases.append(text[at:end])
            at = end
        assert set(phrases) == fingerprints.Phrases().feed(text).finished()
        if not text:
            assert fingerprints.fingerprint(text) == ""
            continue
        hashes = []
        for p in set(phrases):
            h = 0
            for c in p:
                h = (h * fingerprints._BASE + ord(c) + 1) & (2**64 - 1)
            hashes.append(int(fingerprints.mix64(np.array([(h * fingerprints._BASE + len(p)) & (2**64 - 1)], np.uint64))[0]))
        slots = []
        for seed in fingerprints._SEEDS.tolist():
            mixed = [(h * seed) & (2**64 - 1) for h in hashes]
            slots.append(min(m ^ (m >> 29) for m in mixed))
        want = (fingerprints.mix64(np.array(slots, np.uint64)) >> np.uint64(48)).astype(">u2").tobytes().hex()
        assert fingerprints.fingerprint(text) == want
