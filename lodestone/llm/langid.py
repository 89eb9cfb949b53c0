"""Language identification with a linear-chain conditional random field over words.

Each word of a text is labelled with a language.  Emission scores come from affixes, character
n-grams and lexicon entries of the word, hashed into ``dim`` cells; transitions between the languages
of neighbouring words are learned too, from code-switched sequences spliced out of labelled texts.
Marginals come from the forward-backward recursion over the whole text, and a document takes the
language that holds the largest share of its words.  A run of more than ``PIECE`` letters, as in scripts
without blanks, is labelled piece by piece; pieces overlap by two letters, so every n-gram of the run is
scored once.

Fitting uses a bounded sample of labelled rows: at most ``per_language`` windows of ``window`` characters
for each language and ``most_windows`` in all, of the languages with most rows if there are more
languages than windows.  Prediction reads whole texts and nothing but the text.  A text that is null or
has no letter is ``und`` with score 0; so is everything if no labelled row was given.  Ties go to the
language that sorts first.  Rows that repeat are labelled alike, very long texts whole, in memory of the
order of the text; an empty table gives an empty result.  Other columns stay; ``lang_pred``, ``score`` and,
in :func:`train_and_identify`, ``held_out`` give way to the new ones.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestone.llm.batches import with_columns

UNKNOWN = "und"
_RUNS = re.compile(r"[^\W\d_]+")
_STEP_WORDS = 300_000
_CACHE_WORDS = 400_000
#: Letters of a long run that make one position of the chain.
PIECE = 40
#: Stands where a piece goes on.
_ON = "\t"


def _pieces(run: str) -> list[str]:
    """Pieces of a long run; each but the first begins with the two letters before it."""
    cuts = range(0, len(run), PIECE)
    return [(_ON + run[a - 2 : a + PIECE] if a else run[:PIECE]) + (_ON if a + PIECE < len(run) else "") for a in cuts]


def words_of(text: str | None) -> list[str]:
    runs = _RUNS.findall(text.lower()) if text else []
    if any(len(r) > PIECE for r in runs):
        return [p for r in runs for p in (_pieces(r) if len(r) > PIECE else (r,))]
    return runs


def has_letter(word: str) -> bool:
    return any(map(str.isalpha, word))


class _Cells(dict):
    """Cell of each feature name; forgets all when it holds too many."""

    def __init__(self, dim: int):
        super().__init__()
        self.dim = dim

    def __missing__(self, name: str) -> int:
        if len(self) > 200_000:
            self.clear()
        cell = self[name] = zlib.crc32(name.encode()) % self.dim
        return cell


def features(word: str, lexicons: dict[str, str], cells: _Cells) -> list[int]:
    """Hashed affix, n-gram and lexicon features of one lower-case word, or of a piece of a long run."""
    w = word[1:] if word[0] == _ON else f"^{word}"
    w = w[:-1] if w[-1] == _ON else f"{w}$"
    n = len(w)
    out = [cells["p" + w[:3]], cells["p" + w[:4]]] if w[0] == "^" else []
    out += [cells["s" + w[-3:]], cells["s" + w[-4:]]] if w[-1] == "$" else []
    out += [cells[w[i : i + 3]] for i in range(n - 2)]
    if word in lexicons:
        out += [cells["=" + word], cells["lexicon " + lexicons[word]]]
    return out


def forward_backward(scores: np.ndarray, lengths: np.ndarray, start: np.ndarray, trans: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marginals of many sequences at once.

    ``scores`` holds the emission scores of all sequences end to end; ``lengths`` must not be zero.
    Returns the marginals in the same order and the expected transition counts, summed.
    """
    langs = scores.shape[1]
    order = np.argsort(-lengths, kind="stable")
    sizes = lengths[order]
    begin = np.concatenate([[0], np.cumsum(lengths)[:-1]])[order]
    active = np.searchsorted(-sizes, -np.arange(sizes[0]), side="left")
    at = np.concatenate([[0], np.cumsum(active)])
    rank = np.concatenate([np.arange(a) for a in active]) if len(active) < 4096 else np.arange(at[-1]) - np.repeat(at[:-1], active)
    where = begin[rank] + np.repeat(np.arange(len(active)), active)
    emit = scores[where]
    emit = np.exp(emit - emit.max(axis=1, keepdims=True))
    hop, first = np.exp(trans), np.exp(start)
    alpha = np.empty_like(emit)
    state = None
    for t in range(len(active)):
        a, b = at[t], at[t + 1]
        state = emit[a:b] * (first if t == 0 else state[: b - a] @ hop)
        state /= state.sum(axis=1, keepdims=True)
        alpha[a:b] = state
    moves = np.zeros((langs, langs))
    back = np.ones((active[-1], langs), emit.dtype)
    for t in range(len(active) - 1, 0, -1):
        a, b = at[t], at[t + 1]
        ahead = emit[a:b] * back
        before = alpha[at[t - 1] : at[t - 1] + (b - a)]
        joint = ahead @ hop.T
        norm = (before * joint).sum(axis=1, keepdims=True)
        moves += hop * (before.T @ (ahead / norm))
        alpha[a:b] *= back
        grown = np.ones((active[t - 1], langs), emit.dtype)
        grown[: b - a] = joint / joint.sum(axis=1, keepdims=True)
        back = grown
    alpha[: at[1]] *= back
    alpha /= alpha.sum(axis=1, keepdims=True)
    out = np.empty_like(alpha)
    out[where] = alpha
    return out, moves


@dataclass
class Crf:
    languages: list[str]
    lexicons: dict[str, str] = field(default_factory=dict)
    weights: np.ndarray | None = None
    start: np.ndarray | None = None
    trans: np.ndarray | None = None
    dim: int = 1 << 16


def fit(samples: list[tuple[str, str]], dim: int = 1 << 16, epochs: int = 30, rate: float = 0.15, decay: float = 1e-4, seed: int = 17, batch_cells: int = 2_000_000) -> Crf:
    """Fit on ``(text, language)`` pairs by full-batch gradient ascent on the conditional likelihood.

    The gradient is summed over batches of ``batch_cells / languages`` words, so beside the weights, ``dim``
    by languages three times over, memory does not grow with words times languages.
    """
    langs = sorted({lang for _, lang in samples})
    model = Crf(langs, dim=dim)
    spoken = [([w for w in words_of(t) if has_letter(w)], langs.index(lang)) for t, lang in samples]
    spoken = [(ws, k) for ws, k in spoken if ws]
    if not spoken:
        return Crf([])
    counts = [Counter() for _ in langs]
    for ws, k in spoken:
        counts[k].update(ws)
    everywhere: Counter = Counter()
    for spoken_here in counts:
        everywhere.update(spoken_here)
    for k, spoken_here in enumerate(counts):
        for word, here in spoken_here.items():
            if (n := everywhere[word]) >= 3 and here >= 0.8 * n:
                model.lexicons[word] = langs[k]
    rng = np.random.default_rng(seed)
    vocabulary: dict[str, int] = {}
    sequences: list[tuple[list[int], list[int]]] = []
    pool = [(ws[i : i + 12], k) for ws, k in spoken for i in range(0, len(ws), 12)]
    order = rng.permutation(len(pool))
    at = 0
    while at < len(order):
        take = int(rng.integers(1, 5))
        group = [pool[i] for i in order[at : at + take]]
        at += take
        if rng.random() < 0.5:
            group = [g for g in group if g[1] == group[0][1]]
        ids = [vocabulary.setdefault(w, len(vocabulary)) for ws, _ in group for w in ws]
        sequences.append((ids, [k for ws, k in group for _ in ws]))
    cells = _Cells(dim)
    feats = [np.array(features(w, model.lexicons, cells), np.int32) for w in vocabulary]
    n_langs, n = len(langs), sum(len(ids) for ids, _ in sequences)
    batches, seen_moves = [], np.zeros((n_langs, n_langs))
    for part in _batches_of(sequences, max(2_000, batch_cells // n_langs)):
        batch = _Batch(part, feats)
        batches.append(batch)
        np.add.at(seen_moves, (batch.labels[:-1][batch.inner[1:]], batch.labels[1:][batch.inner[1:]]), 1)
    kinds = np.float64 if n_langs * dim <= 1 << 20 else np.float32
    params = [np.zeros((dim, n_langs), kinds), np.zeros(n_langs), np.zeros((n_langs, n_langs))]
    speed = [np.zeros_like(p) for p in params]
    scale = [np.zeros_like(p) for p in params]
    for step in range(1, epochs + 1):
        grads = [np.zeros_like(p) for p in params]
        for batch in batches:
            batch.add_gradient(params, grads)
        grads[1] /= len(sequences)
        grads[2] += seen_moves
        for g in (grads[0], grads[2]):
            g /= n
        for p, g, v, s in zip(params, grads, speed, scale):
            g -= decay * p
            v += 0.1 * (g - v)
            s += 0.01 * (g * g - s)
            p += rate * (v / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-8)
    model.weights, model.start, model.trans = params[0].astype(np.float32), params[1].astype(np.float32), params[2].astype(np.float32)
    return model


def _batches_of(sequences: list[tuple[list[int], list[int]]], most: int):
    """Runs of sequences of about ``most`` words."""
    held, words = [], 0
    for x in sequences:
        held.append(x)
        words += len(x[0])
        if words >= most:
            yield held
            held, words = [], 0
    if held:
        yield held


class _Batch:
    """Sequences whose gradient is computed at once; holds whole numbers only."""

    def __init__(self, sequences: list[tuple[list[int], list[int]]], feats: list[np.ndarray]):
        words, self.ids = np.unique(np.concatenate([ids for ids, _ in sequences]), return_inverse=True)
        self.labels = np.concatenate([labels for _, labels in sequences]).astype(np.int32)
        self.lengths = np.array([len(ids) for ids, _ in sequences])
        self.first = np.concatenate([[0], np.cumsum(self.lengths)[:-1]])
        self.inner = np.ones(len(self.ids), bool)
        self.inner[self.first] = False
        sizes = np.array([len(feats[w]) for w in words])
        self.cell = np.concatenate([feats[w] for w in words])
        self.edge = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        by_word = np.argsort(self.ids, kind="stable")
        self.by_word, self.word_edge = by_word, np.searchsorted(self.ids[by_word], np.arange(len(words)))
        by_cell = np.argsort(self.cell, kind="stable")
        self.owner = np.repeat(np.arange(len(words), dtype=np.int32), sizes)[by_cell]
        self.cells, self.cell_edge = np.unique(self.cell[by_cell], return_index=True)

    def add_gradient(self, params: list[np.ndarray], grads: list[np.ndarray]) -> None:
        scores = np.add.reduceat(params[0][self.cell], self.edge, axis=0)
        miss, moves = forward_backward(scores[self.ids], self.lengths, params[1], params[2])
        np.negative(miss, out=miss)
        miss[np.arange(len(miss)), self.labels] += 1
        per_word = np.add.reduceat(miss[self.by_word], self.word_edge, axis=0)
        grads[0][self.cells] += np.add.reduceat(per_word[self.owner], self.cell_edge, axis=0)
        grads[1] += miss[self.first].sum(axis=0)
        grads[2] -= moves


class _Scorer(dict):
    """Row of each word in a growing table of emission scores; -1 for runs without a letter."""

    def __init__(self, model: Crf):
        super().__init__()
        self.model, self.cells = model, _Cells(model.dim)
        self.forget()

    def forget(self) -> None:
        self.clear()
        self.table = np.zeros((1024, len(self.model.languages)), np.float32)
        self.n, self.pending = 0, []

    def __missing__(self, word: str) -> int:
        row = -1
        if has_letter(word):
            row = self.n + len(self.pending)
            self.pending.append(word)
        self[word] = row
        return row

    def scores(self) -> np.ndarray:
        """The table, with all words that were asked for."""
        if self.pending:
            cells = [features(w, self.model.lexicons, self.cells) for w in self.pending]
            sizes = np.fromiter(map(len, cells), np.int64, len(cells))
            flat = np.fromiter((c for row in cells for c in row), np.int64, int(sizes.sum()))
            new = np.add.reduceat(self.model.weights[flat], np.cumsum(sizes) - sizes, axis=0)
            while self.n + len(new) > len(self.table):
                self.table = np.concatenate([self.table, np.zeros_like(self.table)])
            self.table[self.n : self.n + len(new)] = new
            self.n += len(new)
            self.pending = []
        return self.table


def predict_texts(model: Crf, texts: list[str | None], scorer: _Scorer | None = None) -> tuple[list[str], np.ndarray]:
    """Language and score of each whole text."""
    names = [UNKNOWN] * len(texts)
    marks = np.zeros(len(texts))
    if not model.languages:
        return names, marks
    scorer = _Scorer(model) if scorer is None else scorer
    order = sorted(range(len(texts)), key=lambda i: len(texts[i] or ""))
    group: list[tuple[int, np.ndarray]] = []

    def flush() -> None:
        if group:
            lengths = np.array([len(x) for _, x in group])
            gamma, _ = forward_backward(scorer.scores()[np.concatenate([x for _, x in group])], lengths, model.start, model.trans)
            share = np.add.reduceat(gamma, np.concatenate([[0], np.cumsum(lengths)[:-1]]), axis=0, dtype=np.float64) / lengths[:, None]
            for (i, _), row in zip(group, share):
                k = int(row.argmax())
                names[i], marks[i] = model.languages[k], min(1.0, float(row[k]))
            group.clear()
        if len(scorer) > _CACHE_WORDS:
            scorer.forget()

    held = 0
    for i in order:
        rows = np.array([scorer[w] for w in words_of(texts[i])], np.int32)
        rows = rows[rows >= 0]
        if len(rows):
            group.append((i, rows))
            held += len(rows)
        if held > _STEP_WORDS:
            flush()
            held = 0
    flush()
    return names, marks


def sample_labelled(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", per_language: int = 250, window: int = 1200, most_windows: int = 20_000) -> list[tuple[str, str]]:
    """Text windows of each language, chosen and placed by hash.

    At most ``per_language`` of a language and ``most_windows`` in all (24 MB of text at 1,200 characters).
    """
    labelled = docs.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(text_col).alias("t"), F.col(lang_col).alias("k"))
    counts = labelled.groupBy("k").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "k").limit(most_windows).collect()
    if not counts:
        return []
    each = min(per_language, max(1, most_windows // len(counts)))
    whole = 1 << 40
    rates = docs.sparkSession.createDataFrame([(r.k, max(1, min(whole, 4 * each * whole // r.n))) for r in counts], f"k {labelled.schema['k'].dataType.simpleString()}, rate bigint")
    thin = (
        labelled.join(F.broadcast(rates), "k")
        .withColumn("h", F.xxhash64("t"))
        .filter(F.pmod("h", F.lit(whole)) < F.col("rate"))
        .withColumn("t", F.expr(f"substring(t, cast(pmod(xxhash64(t, 1), greatest(char_length(t) - {window}, 0) + 1) as int) + 1, {window})"))
        .select("t", "k", "h")
        .distinct()
    )
    ranked = thin.withColumn("r", F.row_number().over(Window.partitionBy("k").orderBy("h", "t"))).filter(F.col("r") <= each)
    return sorted((r.t, r.k) for r in ranked.select("t", "k").collect())


def held_out(id_col: str = "doc_id", folds: int = 5) -> Column:
    """True for rows that must not be learned from; a null id is never learned from nor held out."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % folds == 0


def identify(docs: DataFrame, model: Crf, text_col: str = "text", drop: tuple[str, ...] = ()) -> DataFrame:
    """``docs``, less the columns ``drop``, with ``lang_pred`` and ``score``."""
    fields = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    held = docs.sparkSession.sparkContext.broadcast(model)

    def start():
        scorer = _Scorer(held.value)
        return lambda texts: predict_texts(held.value, texts.to_pylist(), scorer)

    return with_columns(docs, [text_col], fields, start, drop)


def train_and_identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int = 250, drop: tuple[str, ...] = ()) -> DataFrame:
    """Fit on the rows outside the held-out fold, then label every row."""
    model = fit(sample_labelled(docs.filter(~held_out(id_col)), text_col, lang_col, per_language))
    return identify(docs.withColumn("held_out", F.coalesce(held_out(id_col), F.lit(False))), model, text_col, drop)
