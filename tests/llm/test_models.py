"""Toxicity, language ID and language model: brute force, gradients and held-out figures."""

import collections
import math
import random
import re
import zlib

import numpy as np

from audience_engine.llm import gru, langid, lm_score, queries, toxicity

SF, SF2 = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, "clash", 0.5) for i, t, lang in rows], "doc_id long, text string, lang string, h string, score double")


# -- toxicity -------------------------------------------------------------------------

def all_maximal(scores):
    """All maximal scoring segments by their definition: best segment first, then what is left and right of it."""
    best = max(((sum(scores[a:b]), a - b, a, b) for a in range(len(scores)) for b in range(a + 1, len(scores) + 1)), default=(0, 0, 0, 0))
    if best[0] <= 0:
        return []
    _, _, a, b = max((x for x in ((sum(scores[a:b]), b - a, a, b) for a in range(len(scores)) for b in range(a + 1, len(scores) + 1)) if abs(x[0] - best[0]) < 1e-12), key=lambda x: x[1])
    return all_maximal(scores[:a]) + [(a, b, sum(scores[a:b]))] + [(s + b, e + b, x) for s, e, x in all_maximal(scores[b:])]


def test_segments_are_the_maximal_ones():
    draw = random.Random(4)
    for _ in range(200):
        n = draw.randrange(1, 14)
        hits = [(i, draw.choice([2.13, 1.37, 0.91, -1.71]) + draw.random() / 100) for i in range(n) if draw.random() < 0.5]
        scores = [dict(hits).get(i, -0.7) for i in range(n)]
        got = sorted((s, e, round(x, 9)) for s, e, x in toxicity.segments(hits, n, -0.7))
        assert got == sorted((s, e, round(x, 9)) for s, e, x in all_maximal(scores))


def test_toxicity_held_out(spark):
    labels = dict(tuple(r) for r in spark.read.parquet(f"{SF2}/labels.parquet").select("doc_id", "toxic").collect())
    got = queries.QUERIES["op1_toxicity"](spark, SF2).collect()
    assert len(got) == 1000 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    own = [(labels[r.doc_id], r.predicted) for r in got if r.held_out and r.doc_id in labels]
    assert sum(a == b for a, b in own) / len(own) > 0.9
    assert sum(b for a, b in own if a) >= 0.5 * sum(a for a, _ in own)


def test_toxicity_precision_and_recall(spark):
    """sf0.1: sf0.01 has six held-out toxic documents, and few to learn from in each language."""
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").select("doc_id", "toxic")
    got = queries.QUERIES["op1_toxicity"](spark, "/root/testdata/sf0.1").where("held_out").join(labels, "doc_id")
    count = collections.Counter((r.toxic, r.predicted) for r in got.select("toxic", "predicted").collect())
    assert count[1, 1] >= 0.9 * (count[1, 1] + count[1, 0]) and count[1, 1] >= 0.9 * (count[1, 1] + count[0, 1])


def test_toxicity_edges(spark):
    bad = [(i, f"some plain words here {i} and then awful nasty words again", None) for i in range(0, 60)]
    good = [(i, f"some plain words here {i} and then other kind words again", None) for i in range(60, 200)]
    rows = bad + good + [(300, None, None), (301, "", None), (302, "123 !!", None), (303, "plain " * 20000 + "awful nasty", None), (304, "AWFUL nasty", None), (304, "AWFUL nasty", None)]
    labels = spark.createDataFrame([(i, int(i < 60)) for i in range(200)] + [(5, 0), (6, None), (None, 1)], "doc_id long, toxic int")
    got = toxicity.score_toxicity(frame(spark, rows), labels).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == len(rows)
    assert all(by[i].predicted == int(i < 60) for i in range(200))
    assert by[300].predicted == by[301].predicted == by[302].predicted == 0 and by[304].predicted == 1
    # passages, with a given model
    model = {"lexicon": {"awful$": 6.0, "nasty$": 6.0}, "miss": -0.02, "lam": 1.0, "k": 0.01, "slope": 1.0, "at": -4.0}
    found = {r.doc_id: r.passages for r in toxicity.score_toxicity(frame(spark, rows), labels, model).collect()}
    text = dict((i, t) for i, t, _ in rows)
    assert [text[304][p.start:p.end] for p in found[304]] == ["AWFUL nasty"]
    assert [text[303][p.start:p.end] for p in found[303]] == ["awful nasty"]
    assert not found[300] and not found[100]
    none = toxicity.score_toxicity(frame(spark, rows), labels.where("doc_id < 0")).collect()
    assert len(none) == len(rows) and all(r.score == 0 for r in none)
    few = toxicity.score_toxicity(frame(spark, rows), labels.where(f"toxic = 0 or doc_id < {toxicity.LEAST_DOCS - 1}")).collect()
    assert len(few) == len(rows) and all(r.score == 0 and not r.passages for r in few)
    assert toxicity.score_toxicity(frame(spark, rows).where("doc_id < 0"), labels).count() == 0


# -- language ID ----------------------------------------------------------------------

def test_language_held_out(spark):
    truth = {r.doc_id: r for r in spark.read.parquet(f"{SF2}/documents.parquet").collect()}
    got = queries.QUERIES["op2_langid"](spark, SF2).collect()
    assert len(got) == 1000 and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    own = [r for r in got if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id].lang for r in own) / len(own) > 0.97
    assert sum(r.rejected for r in got) / len(got) < 0.01


def test_language_edges(spark):
    rows = [(i, f"the house and the garden of them {i}", "en") for i in range(40)] + [(i, f"das haus und der garten von uns {i}", "de") for i in range(40, 80)]
    rows += [(100, None, "en"), (101, "", None), (102, "123 !? 4", "de"), (103, "the garden\n\nof the house", None), (104, "GARTEN und HAUS " * 30000, None), (105, "Ωμέγα και άλφα", None), (106, "the", "en"), (106, "the", "en")]
    by = {r.doc_id: r for r in langid.identify(frame(spark, rows)).collect()}
    assert {i: by[i].lang_pred for i in (100, 101, 102)} == {100: "und", 101: "und", 102: "und"}
    assert by[103].lang_pred == "en" and by[104].lang_pred == "de" and by[106].lang_pred == "en"
    assert by[105].rejected and by[105].lang_pred in ("en", "de") and not by[103].rejected and by[100].rejected
    assert all(by[i].lang_pred == ("en" if i < 40 else "de") for i in range(80))
    nothing = langid.identify(frame(spark, [(1, "text", None), (2, None, None)])).collect()
    assert [r.lang_pred for r in nothing] == ["und", "und"]
    assert langid.identify(frame(spark, rows).where("doc_id < 0")).count() == 0


def test_language_rejects_by_length(spark):
    """Long foreign or random texts go, as short ones do; short clean texts stay, and repeated ones."""
    docs = spark.read.parquet(f"{SF2}/documents.parquet")
    model, draw = langid.train(docs), random.Random(8)
    letters = {"greek": "αβγδεζηθικλμνξοπρστυφχψω", "cyrillic": "абвгдежзийклмнопрстуфхцчшщыьэюя", "han": "".join(chr(0x4E00 + i) for i in range(3000)), "latin": "abcdefghijklmnopqrstuvwxyz"}
    foreign = [(i, " ".join("".join(draw.choice(a) for _ in range(draw.randint(2, 9))) for _ in range(n)), None)
               for i, (a, n) in enumerate((a, n) for a in letters.values() for n in (10, 50, 300, 2000) for _ in range(5))]
    rows = sorted((r.doc_id, r.text) for r in docs.where("text is not null and doc_id % 5 = 0").collect())
    clean = [(1000 + j, t, None) for j, t in enumerate([t[:n] for _, t in rows for n in (20, 60, 200)] + ["Das " * 500, "the " * 5000]) if any(c.isalpha() for c in t)]
    got = {r.doc_id: r.rejected for r in langid.identify(frame(spark, foreign + clean), model).collect()}
    assert [t[:40] for i, t, _ in foreign if not got[i]] == []
    # one learning row of a language is its own centroid: its short beginnings still belong to it
    idf = model["idf"]
    text = max((t for _, t in rows), key=len)
    (_, _, whole, _), = langid.vectors([text], idf)
    floor = langid._floors([text], idf, whole)
    short = [(v, langid._length_class(v)) for _, _, v, _ in langid.vectors([text[:n] for n in (16, 40, 100)], idf)]
    assert all((v @ whole.T)[j, 0] >= langid.REJECT_AT * floor[c[j]] for v, c in short for j in range(len(v)))
    assert sum(got[i] for i, _, _ in clean) <= 0.002 * len(clean) and not got[clean[-1][0]] and not got[clean[-2][0]]


def test_letters_of_all_planes():
    table = langid._letter_table()
    assert table[0x30010] == 0x30010 and table[ord("É")] == ord("é") and table[ord("7")] == 0


def test_gram_counts_do_not_depend_on_slices():
    texts = ["The garden, of it", "x", "", "über-all " * 50, "zz"]
    old = langid.SLICE
    whole = np.concatenate([c for _, _, c in langid.gram_counts(texts)])
    try:
        langid.SLICE = 16
        assert (np.concatenate([c for _, _, c in langid.gram_counts(texts)]) == whole).all()
    finally:
        langid.SLICE = old


# -- language model -------------------------------------------------------------------

def small_model():
    class_of = np.array([0, 0, 0, 1, 1, 2, 3])
    weights = np.array([9.0, 5, 2, 4, 4, 6, 3])
    return gru.initial(class_of, weights, 4, 5), gru.Output(class_of, 5)


def test_model_is_a_distribution_and_carries_state():
    p, out = small_model()
    rng = np.random.default_rng(0)
    docs = [rng.integers(0, 7, n).astype(np.int32) for n in (90, 3, 1, 40, 71)]
    together = gru.score(p, out, docs)
    assert np.allclose(together, [gru.score(p, out, [d])[0] for d in docs], atol=1e-3)  # lanes and windows change nothing
    h = rng.standard_normal((6, gru.HIDDEN)).astype(np.float32)
    every = np.stack([out.log_probs(p, h, np.full(6, y)) for y in range(7)])
    assert np.allclose(np.exp(every).sum(axis=0), 1, atol=1e-5)


def test_gradients_of_the_recurrent_model():
    p, out = small_model()
    p = {k: v.astype(np.float64) for k, v in p.items()}
    x = np.random.default_rng(1).integers(0, 7, (6, 3))
    seen = {}

    def loss(q):
        keep = np.ones((6, 3))
        keep[0] = 0
        hb, _ = gru._states(q, x, keep, np.zeros((3, gru.HIDDEN)), None)
        return -out.log_probs(q, hb.reshape(-1, gru.HIDDEN).astype(np.float64), x.ravel()).mean()

    # one step of plain Adam moves every parameter against the sign of its gradient
    after = gru.learn({k: v.astype(np.float32) for k, v in p.items()}, out, [x[:, j].astype(np.int32) for j in range(3)], rate=1e-3)
    for k in ("u", "cw", "ww", "gates", "cb"):
        moved = (after[k] - p[k].astype(np.float32)).ravel()
        i = int(np.abs(moved).argmax())
        step = np.zeros(p[k].size)
        step[i] = 1e-2
        up, down = dict(p), dict(p)
        up[k], down[k] = p[k] + step.reshape(p[k].shape), p[k] - step.reshape(p[k].shape)
        slope = loss(up) - loss(down)
        seen[k] = slope * moved[i]
    assert all(v < 0 for v in seen.values()), seen


def test_the_model_against_plain_loops(monkeypatch):
    """Scores, whatever number of states is computed at a time, and one learning step against numeric gradients of the whole mean loss."""
    p, out = small_model()
    rng = np.random.default_rng(2)
    docs = [rng.integers(0, 7, n).astype(np.int32) for n in (20, 3, 11, 1)]

    def loss_of(p, doc):
        h, total = np.zeros(gru.HIDDEN), 0.0
        for y in doc:
            c = out.class_of[y]
            logits = p["cw"] @ h + p["cb"]
            total += logits[c] - np.log(np.exp(logits).sum())
            if y < out.heads:
                own = np.flatnonzero(out.class_of[:out.heads] == c)
                logits = p["ww"][own] @ h + p["wb"][own]
                total += logits[y - own[0]] - np.log(np.exp(logits).sum())
            (az, ar, an), (uz, ur, un) = np.split(p["gates"][y], 3), np.split(h @ p["u"], 3)
            z, r = 1 / (1 + np.exp(-az - uz)), 1 / (1 + np.exp(-ar - ur))
            new = np.tanh(an + r * un)
            h = new + z * (h - new)
        return total

    want = [loss_of(p, d) for d in docs]
    for size in (1, 7, gru.AT_ONCE):
        monkeypatch.setattr(gru, "AT_ONCE", size)
        assert np.allclose(gru.score(p, out, docs), want, atol=1e-4)
    wide = {k: v.astype(np.float64) for k, v in p.items()}
    after = gru.learn(p, out, docs, rate=1e-3)
    for k, v in wide.items():
        for i in rng.integers(0, v.size, 12):
            step = np.zeros(v.size)
            step[i] = 1e-4
            up, down = ({**wide, k: v + f * step.reshape(v.shape)} for f in (1, -1))
            slope = -sum(loss_of(up, d) - loss_of(down, d) for d in docs) / 2e-4 / sum(map(len, docs))
            # Adam's first step has the rate's size, a tenth of it in the last window, against the gradient
            assert np.allclose((after[k] - p[k]).ravel()[i], -1e-4 * slope / (abs(slope) + 1e-6), atol=5e-6), (k, i, slope)


def test_scores_against_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    old = lm_score.DICTIONARY
    lm_score.DICTIONARY = 3000  # so that rare words go through the join
    try:
        got = {r.doc_id: r for r in queries.QUERIES["op3_lm_score"](spark, SF).collect()}
    finally:
        lm_score.DICTIONARY = old
    check_base(rows, got)
    held = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_model_learns_from_every_learning_document(spark, monkeypatch):
    rows = [(i, f"one two three {i % 7}", None) for i in range(200)] + [(None, "four", None), (3, None, None)]
    seen, averaged = [], lm_score._averaged

    def watched(part, vocabulary, start):
        seen.extend((r.doc_id, r.text) for r in part.collect())
        return averaged(part, vocabulary, start)

    monkeypatch.setattr(lm_score, "_averaged", watched)
    _, p, _ = lm_score.train(frame(spark, rows))
    assert p is not None
    assert sorted(seen, key=str) == sorted(((i, t or "") for i, t, _ in rows if i is None or zlib.crc32(str(i).encode()) % 7 != 2), key=str)


def check_base(rows, got):
    tokens = {i: re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower()) + [b""] for i, t in rows}
    count = collections.Counter()
    for i, w in tokens.items():
        if zlib.crc32(str(i).encode()) % 7 != 2:
            count.update(w)
    n, v = sum(count.values()), len(count)
    for i, w in tokens.items():
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (zlib.crc32(str(i).encode()) % 7 == 2, len(w), sum(count[x] > 0 for x in w), n)
        assert math.isclose(r.base_score, sum(math.log10((count[x] + 1) / (n + v + 1)) for x in w), rel_tol=1e-9)
        assert r.score <= 0


def test_score_edges(spark):
    rows = [(i, f"one two three {i % 7}", None) for i in range(40)] + [(50, None, None), (51, "", None), (52, "É é ONE", None), (53, "unseen " * 30000, None)]
    got = {r.doc_id: r for r in lm_score.score_documents(frame(spark, rows)).collect()}
    check_base([(i, t) for i, t, _ in rows], got)
    twice = lm_score.score_documents(frame(spark, rows + rows[:3])).collect()
    assert len(twice) == len(rows) + 3
    assert lm_score.score_documents(frame(spark, rows).where("doc_id < 0")).count() == 0


def test_scores_do_not_depend_on_the_partitioning(spark, monkeypatch):
    """The same rows in one and in seven partitions, in another order, learned in several parts."""
    monkeypatch.setattr(lm_score, "PART_TOKENS", 60_000)
    monkeypatch.setattr(lm_score, "STEP", 50)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    docs = docs.union(docs.limit(0)).union(spark.createDataFrame([(None, "no id here"), (None, None)], "doc_id long, text string"))
    ways = [docs.repartition(1), docs.repartition(7, "text"), docs.orderBy("text", ascending=False)]
    first, *others = [sorted(((r.doc_id is None, r.doc_id or 0, r.n_tokens, r.n_known, r.base_score, r.score) for r in lm_score.score_documents(w).collect())) for w in ways]
    for other in others:
        assert [r[:4] for r in other] == [r[:4] for r in first]
        np.testing.assert_allclose([r[4:] for r in other], [r[4:] for r in first], rtol=1e-5)
    assert len(first) == docs.count()


def test_language_learns_from_every_learning_row(spark):
    """Frequencies, centroids and floors are those of all rows, far more than 1,500 of a language: one row in 30 is of another kind."""
    rows = [(i, f"alpha beta gamma {i % 7}" if i % 30 else f"ολα αυτα ειναι αλλο {i % 7}", "xx") for i in range(1, 6001)]
    texts = [t for i, t, _ in sorted(rows) if zlib.crc32(str(i).encode()) % 4 != 2]
    model = langid.train(frame(spark, rows).repartition(5))
    seen = sum((c > 0).sum(axis=0) for _, _, c in langid.gram_counts(texts))
    np.testing.assert_allclose(model["idf"], np.log((len(texts) + 1) / (seen + 1)) + 0.05, rtol=1e-6)
    v = np.concatenate([x for _, _, x, _ in langid.vectors(texts, model["idf"])])
    near = (v @ model["centres"].T).argmax(axis=1)
    for c, centre in enumerate(model["centres"]):
        if (near == c).any():
            mean = v[near == c].sum(axis=0)
            np.testing.assert_allclose(mean / np.linalg.norm(mean), centre, atol=1e-4)
    np.testing.assert_allclose(model["floor"][0], langid._floors(texts, model["idf"], model["centres"]), atol=1e-9)
    other = [j for j, t in enumerate(texts) if t[0] == "ο"]
    assert len(texts) > 4000 and ((v @ model["centres"].T).max(axis=1)[other] > 0.9).all()


def test_groups_come_from_every_learning_document(spark, monkeypatch):
    """The words' groups are those of the counts over all learning documents, and the two rounds share all parts."""
    monkeypatch.setattr(lm_score, "PART_TOKENS", 300)
    rows = [(i, f"one two w{i % 50} v{i % 11}", None) for i in range(400)]
    docs = [t.split() for i, t, _ in rows if zlib.crc32(str(i).encode()) % 7 != 2]
    dealt, rounds = [], lm_score._round

    def watched(part, parts, *a):
        dealt.append([(r.doc_id, r.part) for r in part.select("doc_id", "part").collect()])
        return rounds(part, parts, *a)

    monkeypatch.setattr(lm_score, "_round", watched)
    vocabulary, p, _ = lm_score.train(frame(spark, rows))
    near = lm_score._together(frame(spark, [(i, " ".join(d), None) for i, d in enumerate(docs)]), vocabulary)
    names = {n: w.decode() for w, n in vocabulary.number.items()}
    for i, w in names.items():
        want = [sum(w in d and names[j] in d for d in docs) if j in names else 0 for j in range(lm_score.CONTEXT)]
        assert near[i].tolist() == want, w
    assert len(dealt) == 2 and sorted(i for d in dealt for i, _ in d) == [i for i, _, _ in rows if zlib.crc32(str(i).encode()) % 7 != 2]
    assert len({k for _, k in dealt[0]}) < len({k for _, k in dealt[1]})
