import random
import zlib
from itertools import product

import numpy as np

from lodestone.llm import langid

WORDS = {
    "en": "the of and that with have this from which would there their about could other".split(),
    "fr": "le la des une avec pour être dans cette mais nous vous leur deux tout".split(),
    "de": "der die und das nicht eine auch werden haben über durch nach schon wenn".split(),
}


def sentence(rng, lang, n):
    return " ".join(rng.choice(WORDS[lang]) + rng.choice(["", "", ".", ","]) for _ in range(n))


def labelled(n=300, seed=1):
    rng = random.Random(seed)
    return [(sentence(rng, lang, rng.randint(5, 60)), lang) for lang in rng.choices(list(WORDS), k=n)]


def test_forward_backward_matches_enumeration():
    rng = np.random.default_rng(0)
    lengths = np.array([3, 1, 4, 4])
    scores = rng.normal(size=(12, 3))
    start, trans = rng.normal(size=3), rng.normal(size=(3, 3))
    got, moves = langid.forward_backward(scores, lengths, start, trans)
    at, want_moves = 0, np.zeros((3, 3))
    for n in lengths:
        e = scores[at : at + n]
        total, want, hops = 0.0, np.zeros((n, 3)), np.zeros((3, 3))
        for path in product(range(3), repeat=n):
            p = np.exp(start[path[0]] + sum(e[i, y] for i, y in enumerate(path)) + sum(trans[a, b] for a, b in zip(path, path[1:])))
            total += p
            for i, y in enumerate(path):
                want[i, y] += p
            for a, b in zip(path, path[1:]):
                hops[a, b] += p
        np.testing.assert_allclose(got[at : at + n], want / total, atol=1e-9)
        want_moves += hops / total
        at += n
    np.testing.assert_allclose(moves, want_moves, atol=1e-9)


def test_held_out_accuracy_and_code_switching():
    model = langid.fit(labelled(), epochs=20)
    test = labelled(200, seed=2)
    names, scores = langid.predict_texts(model, [t for t, _ in test])
    assert sum(a == b for a, (_, b) in zip(names, test)) >= 196 and ((scores >= 0) & (scores <= 1)).all()
    rng = random.Random(4)
    mixed = sentence(rng, "de", 30) + " " + sentence(rng, "fr", 12)
    name, score = langid.predict_texts(model, [mixed])
    assert name == ["de"] and 0.55 < score[0] < 0.85
    assert np.diag(model.trans).min() > (model.trans - np.diag(np.diag(model.trans))).max() - 1


def test_texts_without_letters():
    model = langid.fit(labelled(60), epochs=3)
    names, scores = langid.predict_texts(model, [None, "", "12 + ² ½ !!", "x", "le " * 30_000, "ß" * 5000])
    assert names[:3] == ["und"] * 3 and not scores[:3].any() and "und" not in names[3:]
    assert langid.predict_texts(langid.fit([]), ["the"]) [0] == ["und"]


def test_batches_do_not_change_results():
    model = langid.fit(labelled(60), epochs=3)
    texts = [t for t, _ in labelled(50, seed=9)]
    together = langid.predict_texts(model, texts)
    for i, t in enumerate(texts):
        name, score = langid.predict_texts(model, [t])
        assert name[0] == together[0][i] and abs(score[0] - together[1][i]) < 1e-5


def test_query_learns_only_outside_the_fold(spark):
    rows = [(i, t, lang, 0.5) for i, (t, lang) in enumerate(labelled(200))]
    spoiled = [(i, t, "xx" if zlib.crc32(str(i).encode()) % 5 == 0 else lang, s) for i, t, lang, s in rows]
    rows = [*spoiled, (900, None, "en", 0.0), (900, "??", None, 0.0), (None, "the of and", "zz", 0.0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, score double")
    out = langid.train_and_identify(df).collect()
    assert len(out) == len(rows)
    for r in out:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert r.lang_pred in ({"und"} if not r.text or r.text == "??" else {"en", "fr", "de"})
    assert langid.train_and_identify(df.limit(0)).collect() == []


def test_sample_is_bounded(spark):
    df = spark.createDataFrame([(t + f" tail{i}" * 50, lang) for i, (t, lang) in enumerate(labelled(300))], "text string, lang string")
    sample = langid.sample_labelled(df, per_language=10, window=100)
    assert 0 < len(sample) <= 30 and all(len(t) <= 100 for t, _ in sample)


def test_long_runs_are_read_to_their_last_letter():
    """Every trigram of a run is a feature of exactly one piece; short words are as before."""
    rng = random.Random(12)
    for n in (40, 41, 42, 79, 80, 81, 100, 1000):
        run = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n))
        pieces = langid.words_of(run)
        assert len(pieces) == -(-n // langid.PIECE)
        grams = []
        for p in pieces:
            w = p[1:] if p[0] == "\t" else "^" + p
            w = w[:-1] if w[-1] == "\t" else w + "$"
            grams += [w[i : i + 3] for i in range(len(w) - 2)]
            assert all(c >= 0 for c in langid.features(p, {}, langid._Cells(1 << 16)))
        marked = f"^{run}$"
        assert grams == [marked[i : i + 3] for i in range(len(marked) - 2)]
    assert langid.words_of("the end") == ["the", "end"]


def test_script_without_blanks():
    rng = random.Random(13)
    letters = {"aa": "あいうえおかきくけこ", "bb": "ㄱㄴㄷㄹㅁㅂㅅㅇㅈㅊ"}
    made = lambda k, n: "".join(rng.choice(letters[k]) for _ in range(n))
    model = langid.fit([(made(k, 120), k) for k in letters for _ in range(40)], epochs=10)
    name, score = langid.predict_texts(model, [made("aa", 45) + made("bb", 300)])
    assert name == ["bb"] and 0.7 < score[0] < 0.95  # the middle of the run decides, not its ends


def test_batched_gradient_equals_the_numeric_one():
    """The gradient over batches is that of the conditional likelihood, by enumeration of all labellings."""
    rng = np.random.default_rng(3)
    feats = [np.array(sorted(rng.choice(9, size=rng.integers(1, 5), replace=False)), np.int32) for _ in range(6)]
    sequences = [([0, 1, 2], [0, 1, 1]), ([3, 0], [1, 0]), ([4, 5, 4, 1], [1, 1, 0, 1])]
    params = [rng.normal(size=(9, 2)), rng.normal(size=2), rng.normal(size=(2, 2))]

    def likelihood(w, start, trans):
        total = 0.0
        for ids, labels in sequences:
            score = lambda ys: start[ys[0]] + sum(w[feats[i], y].sum() for i, y in zip(ids, ys)) + sum(trans[a, b] for a, b in zip(ys, ys[1:]))  # noqa: E731, B023
            total += score(labels) - np.log(sum(np.exp(score(ys)) for ys in product(range(2), repeat=len(ids))))
        return total

    for most in (2, 100):
        grads = [np.zeros_like(p) for p in params]
        for part in langid._batches_of(sequences, most):
            langid._Batch(part, feats).add_gradient(params, grads)
        for ids, labels in sequences:
            for a, b in zip(labels, labels[1:]):
                grads[2][a, b] += 1
        for p, g in zip(params, grads):
            for at in np.ndindex(*p.shape):
                kept, step = p[at], 1e-5
                p[at] = kept + step
                up = likelihood(*params)
                p[at] = kept - step
                down = likelihood(*params)
                p[at] = kept
                assert abs((up - down) / (2 * step) - g[at]) < 1e-6


def test_label_of_a_whole_text_by_hand():
    """Score and label against emission scores added feature by feature and paths enumerated."""
    model = langid.fit(labelled(60), epochs=5)
    cells = langid._Cells(model.dim)
    for text in ("the une der", "le", "and that le und nicht", "Über cette"):
        words = langid.words_of(text)
        emit = np.array([model.weights[langid.features(w, model.lexicons, cells)].sum(axis=0) for w in words], np.float64)
        shares = np.zeros(3)
        total = 0.0
        for path in product(range(3), repeat=len(words)):
            p = np.exp(model.start[path[0]] + sum(emit[i, y] for i, y in enumerate(path)) + sum(model.trans[a, b] for a, b in zip(path, path[1:])))
            total += p
            for y in path:
                shares[y] += p / len(words)
        name, score = langid.predict_texts(model, [text])
        assert name[0] == model.languages[int(shares.argmax())] and abs(score[0] - shares.max() / total) < 1e-4


def test_many_languages_are_learned_from_a_bounded_sample(spark):
    rows = [(f"word{k} text{k} some{k} " * 5 + str(i), f"l{k:03d}") for k in range(620) for i in range(2 if k < 600 else 1)]
    df = spark.createDataFrame(rows, "text string, lang string")
    sample = langid.sample_labelled(df, per_language=5, most_windows=700)
    assert len(sample) == len({k for _, k in sample}) == 620
    assert {k for _, k in langid.sample_labelled(df, per_language=5, most_windows=600)} == {f"l{k:03d}" for k in range(600)}
