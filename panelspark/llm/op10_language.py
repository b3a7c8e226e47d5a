"""Language identification by a linear-chain conditional random field over words.

A word's features are its prefixes, suffixes and character n-grams, itself if
the lexicon of the training sample has it, and the languages whose lexicon it
belongs to; feature weights and label transitions are learned by maximising the
conditional likelihood. Training sequences are spans of sampled texts, also
several spans of different languages in a row, so that transitions cover
code-switching. Forward-backward then gives each word's label probabilities; a
document's language is the label with the largest expected share of its words
and that share is the score.

The model is fitted on a bounded sample (`per_language` documents a language,
`max_words` words of each) on the driver; prediction covers whole texts.

Defined cases: null text and text without letters is `und` with score 0; texts
of any length are labelled whole; of equal shares the first label by name wins;
repeated rows each get a prediction; without a labelled row everything is
`und`; extra columns stay and new columns are renamed if a name is taken.
"""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from panelspark.llm.common import free_name, split_words

PER_LANGUAGE = 250
MAX_WORDS = 200
FEATURE_BITS = 17
ROUNDS = 25
CACHE_WORDS = 250_000
SLICE_WORDS = 500_000
UNKNOWN = "und"
SEEN = 3
DEVIATIONS = 2.0
WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> list[str]:
    found = WORD.findall(text.lower()) if text else []
    return found if any(c.isalpha() for w in found for c in w) else []


def feature_ids(word: str, lexicon: dict[str, tuple[int, ...]]) -> list[int]:
    w = f"<{word}>"
    n = len(w)
    names = ["p" + w[:i] for i in (2, 3, 4) if i < n] + ["s" + w[-i:] for i in (2, 3, 4) if i < n]
    names += ["n" + w[i:i + 2] for i in range(n - 1)] + ["n" + w[i:i + 3] for i in range(n - 2)]
    if word in lexicon:
        names.append("w" + word)
        names += [f"l{k}" for k in lexicon[word]]
    mask = (1 << FEATURE_BITS) - 1
    return [zlib.crc32(x.encode()) & mask for x in names]


@dataclass
class Model:
    labels: list[str]
    weights: np.ndarray  # feature x label
    transitions: np.ndarray  # log scores, from x to
    lexicon: dict[str, tuple[int, ...]]
    seen: dict[str, tuple[int, ...]]  # languages in which a word occurs SEEN times or more
    levels: np.ndarray  # by label: the share of seen words below which a text is of no learned language
    known: dict[str, int] = field(default_factory=dict)  # word -> row of `scores`, in a worker
    scores: np.ndarray | None = None
    is_seen: np.ndarray | None = None  # same rows: whether the word is seen in each language

    def rows(self, words: list[str]) -> np.ndarray:
        """Emission rows of the words, by a table that is started anew when full."""
        if self.scores is None or len(self.known) > CACHE_WORDS:
            self.known, self.scores = {}, np.zeros((0, len(self.labels)))
            self.is_seen = np.zeros((0, len(self.labels)), bool)
        known, added, seen = self.known, [], []
        out = [known.get(w, -1) for w in words]
        for i, r in enumerate(out):
            if r < 0:
                w = words[i]
                r = known.get(w, -1)
                if r < 0:
                    r = known[w] = len(self.scores) + len(added)
                    added.append(self.weights[feature_ids(w, self.lexicon)].sum(0))
                    seen.append([k in self.seen.get(w, ()) for k in range(len(self.labels))])
                out[i] = r
        if added:
            self.scores = np.concatenate([self.scores, np.array(added)])
            self.is_seen = np.concatenate([self.is_seen, np.array(seen)])
        return np.array(out, dtype=np.int64)


def forward_backward(emission: np.ndarray, lengths: np.ndarray, transitions: np.ndarray) -> np.ndarray:
    """Label probabilities of every word. Sequences lie one after the other in `emission`; all are advanced together,
    a word a step, the longest first, so that the running ones are a prefix."""
    order = np.argsort(-lengths, kind="stable")
    starts = (np.cumsum(lengths) - lengths)[order]
    size = lengths[order]
    psi = np.exp(emission - emission.max(1, keepdims=True))
    move = np.exp(transitions - transitions.max())
    out = np.empty_like(psi)
    steps = int(size[0]) if len(size) else 0
    running = np.searchsorted(-size, -np.arange(steps), side="left")  # sequences longer than t
    alpha = None
    for t in range(steps):
        m = running[t]
        at = starts[:m] + t
        alpha = psi[at] if alpha is None else (alpha[:m] @ move) * psi[at]
        alpha /= alpha.sum(1, keepdims=True)
        out[at] = alpha
    beta = None
    for t in range(steps - 1, -1, -1):
        m = running[t]
        at = starts[:m] + t
        now = np.ones((m, psi.shape[1]))
        if beta is not None and len(beta):
            k = len(beta)
            back = (beta * psi[at[:k] + 1]) @ move.T
            now[:k] = back / back.sum(1, keepdims=True)
        beta = now
        both = out[at] * beta
        out[at] = both / both.sum(1, keepdims=True)
    return out


def seen_levels(samples: list[tuple[str, list[str]]], number: dict[str, int], counts: dict[str, dict[int, int]]) -> np.ndarray:
    """By language, the middle between two medians over the sample's texts: the share of words seen in the language's
    other texts, of its own texts; and the same of texts of the nearest other language, which stand for unlearned ones."""
    own: list[list[float]] = [[] for _ in number]
    other: dict[tuple[int, int], list[float]] = {}
    for lang, words in samples:
        if words:
            y, mine = number[lang], Counter(words)
            for k in number.values():
                n = sum(c for w, c in mine.items() if counts[w].get(k, 0) - (c if k == y else 0) >= SEEN)
                (own[y] if k == y else other.setdefault((k, y), [])).append(n / len(words))
    return np.array([(np.median(own[k]) + max((np.median(v) for (a, _), v in other.items() if a == k), default=0.0)) / 2 for k in range(len(number))])


def train(samples: list[tuple[str, list[str]]], seed: int = 7) -> Model | None:
    """samples: (language, words)."""
    labels = sorted({lang for lang, w in samples if w})
    if not labels:
        return None
    number = {lang: i for i, lang in enumerate(labels)}
    counts: dict[str, dict[int, int]] = {}
    for lang, words in samples:
        for w in words:
            c = counts.setdefault(w, {})
            c[number[lang]] = c.get(number[lang], 0) + 1
    lexicon = {w: tuple(k for k, n in sorted(c.items()) if n * 5 >= sum(c.values())) for w, c in counts.items() if sum(c.values()) >= 3}
    rng = random.Random(seed)
    sequences: list[list[tuple[str, int]]] = []
    spans = [(number[lang], words[a:a + n]) for lang, words in samples if words
             for n in (rng.randint(4, 40),) for a in range(0, len(words), n)]
    rng.shuffle(spans)
    k = 0
    while k < len(spans):
        take = rng.choice((1, 1, 2, 3))
        sequences.append([(w, y) for y, part in spans[k:k + take] for w in part])
        k += take
    vocabulary = {w: i for i, w in enumerate(sorted(counts))}
    features = [feature_ids(w, lexicon) for w in vocabulary]
    sizes = np.array([len(f) for f in features])
    flat = np.concatenate([np.array(f) for f in features])
    first = np.cumsum(sizes) - sizes
    tokens = np.array([vocabulary[w] for s in sequences for w, _ in s])
    truth = np.array([y for s in sequences for _, y in s])
    lengths = np.array([len(s) for s in sequences])
    ends = np.cumsum(lengths) - 1
    inner = np.setdiff1d(np.arange(len(tokens)), ends)
    n_labels = len(labels)
    weights, moves = np.zeros((1 << FEATURE_BITS, n_labels)), np.zeros((n_labels, n_labels))
    seen = np.bincount(truth[inner] * n_labels + truth[inner + 1], minlength=n_labels * n_labels).reshape(n_labels, n_labels)
    square_w, square_m = np.zeros_like(weights), np.zeros_like(moves)
    target = np.zeros((len(tokens), n_labels))
    target[np.arange(len(tokens)), truth] = 1
    for _ in range(ROUNDS):
        emission = np.add.reduceat(weights[flat], first)[tokens]
        p = forward_backward(emission, lengths, moves)
        slope = target - p
        by_word = np.stack([np.bincount(tokens, slope[:, y], len(vocabulary)) for y in range(n_labels)], 1)
        by_feature = np.stack([np.bincount(flat, np.repeat(by_word[:, y], sizes), 1 << FEATURE_BITS) for y in range(n_labels)], 1)
        expected = pair_counts(emission, lengths, moves, inner)
        by_move = seen - expected
        square_w += by_feature ** 2
        square_m += by_move ** 2
        weights += 0.3 * by_feature / np.sqrt(square_w + 1e-8)
        moves += 0.3 * by_move / np.sqrt(square_m + 1e-8)
    seen = {w: known for w, c in counts.items() if (known := tuple(k for k, n in sorted(c.items()) if n >= SEEN))}
    return Model(labels, weights.astype(np.float32), moves, lexicon, seen, seen_levels(samples, number, counts))


def pair_counts(emission: np.ndarray, lengths: np.ndarray, transitions: np.ndarray, inner: np.ndarray) -> np.ndarray:
    """Expected number of transitions between labels. Uses p(y, y' | x) ~ forward(y) move(y, y') psi(y') backward(y')."""
    forward, backward, psi, move = messages(emission, lengths, transitions)
    a, b = forward[inner], (psi * backward)[inner + 1]
    norm = np.einsum("ni,ij,nj->n", a, move, b)
    return np.einsum("ni,nj->ij", a / norm[:, None], b) * move


def messages(emission, lengths, transitions):
    order = np.argsort(-lengths, kind="stable")
    starts, size = (np.cumsum(lengths) - lengths)[order], lengths[order]
    psi = np.exp(emission - emission.max(1, keepdims=True))
    move = np.exp(transitions - transitions.max())
    forward, backward = np.empty_like(psi), np.ones_like(psi)
    running = np.searchsorted(-size, -np.arange(int(size[0])), side="left")
    for t, m in enumerate(running):
        at = starts[:m] + t
        f = psi[at] if t == 0 else (forward[at - 1] @ move) * psi[at]
        forward[at] = f / f.sum(1, keepdims=True)
    for t in range(len(running) - 2, -1, -1):
        at = starts[:running[t + 1]] + t
        b = (backward[at + 1] * psi[at + 1]) @ move.T
        backward[at] = b / b.sum(1, keepdims=True)
    return forward, backward, psi, move


def may_learn(doc_id: Column) -> Column:
    """Documents outside the held-out fifth: crc32 of the id as text, modulo 5, is not 0."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 != 0


def fit(df: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", per_language: int = PER_LANGUAGE,
        max_words: int = MAX_WORDS) -> Model | None:
    """Fits on the `per_language` documents of each language with the smallest hash of their id, outside the held-out
    fifth; at most `max_words` words of each reach the driver."""
    rows = df.filter(may_learn(F.col(doc_id)) & F.col(lang).isNotNull() & F.col(text).rlike(r"\p{L}")) \
        .select(F.col(lang).cast("string").alias("lang"), F.xxhash64(F.col(doc_id)).alias("h"), F.col(text).alias("text"))
    rows = rows.select("lang", "h", F.array_join(F.slice(split_words(F.col("text")), 1, max_words), " ").alias("text"))
    best = rows.withColumn("n", F.row_number().over(W.partitionBy("lang").orderBy("h", "text"))).filter(F.col("n") <= per_language)
    return train([(r.lang, words_of(r.text)) for r in best.orderBy("lang", "h", "text").collect()])


def _predict(df: DataFrame, model: Model | None, text: str, fields: list[T.StructField], result) -> DataFrame:
    schema = T.StructType([*df.schema.fields, *fields])
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        model = shared.value
        for batch in batches:
            texts, at = batch.column(text), 0
            done: list = []
            while at < batch.num_rows:  # slices of about SLICE_WORDS words
                held, n = [], 0
                while at < batch.num_rows and n < SLICE_WORDS:
                    held.append(words_of(texts[at].as_py()) if model else [])
                    n += len(held[-1])
                    at += 1
                done += result(model, held)
            arrays = [pa.array(c, t) for c, t in zip(zip(*done) if done else [[]] * len(fields), [TYPES[f.dataType.simpleString()] for f in fields])]
            yield pa.RecordBatch.from_arrays([*batch.columns, *arrays], names=schema.fieldNames())

    return df.mapInArrow(run, schema)


TYPES = {"string": pa.string(), "double": pa.float64(), "array<string>": pa.list_(pa.string())}


def _marginals(model: Model, held: list[list[str]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    lengths = np.array([len(h) for h in held])
    rows = model.rows([w for h in held for w in h])
    return forward_backward(model.scores[rows], lengths[lengths > 0], model.transitions), lengths, rows


def predict(df: DataFrame, model: Model | None, text: str = "text", lang_pred: str = "lang_pred", score: str = "score") -> DataFrame:
    """Adds the predicted language and the expected share of words in it."""
    names = [free_name(df, lang_pred), free_name(df, score)]

    def result(model, held):
        out = [(UNKNOWN, 0.0)] * len(held)
        if model and any(held):
            p, lengths, _ = _marginals(model, held)
            some = np.flatnonzero(lengths)
            share = np.add.reduceat(p, np.cumsum(lengths[some]) - lengths[some]) / lengths[some, None]
            for i, s in zip(some, share):
                k = int(s.argmax())
                out[i] = (model.labels[k], float(min(1.0, max(0.0, s[k]))))
        return out

    return _predict(df, model, text, [T.StructField(names[0], T.StringType()), T.StructField(names[1], T.DoubleType())], result)


def label_words(df: DataFrame, model: Model | None, text: str = "text", out: str = "word_langs") -> DataFrame:
    """Adds the most probable language of every word, in order: the labelling of code-switched text."""
    def result(model, held):
        if not model or not any(held):
            return [([],)] * len(held)
        p, lengths, _ = _marginals(model, held)
        best = [model.labels[k] for k in p.argmax(1)]
        ends = np.cumsum(lengths)
        return [(best[b - n:b],) for n, b in zip(lengths, ends)]

    return _predict(df, model, text, [T.StructField(free_name(df, out), T.ArrayType(T.StringType()))], result)


def with_evidence(df: DataFrame, model: Model | None, text: str, score: str, lack: str) -> DataFrame:
    """Adds the largest expected share of words in one language (0 without words) and what the text lacks, in words, to
    be of the learned languages. Shares sum to 1 over the learned labels whatever the text is; the lack does not: every
    word counts as evidence if it is seen in the language it is labelled with, and that count is held against the
    languages' levels, less DEVIATIONS standard deviations, so that a short text does not lack by chance."""
    def result(model, held):
        out = [(0.0, 0.0)] * len(held)
        if model and any(held):
            p, lengths, rows = _marginals(model, held)
            some = np.flatnonzero(lengths)
            first, best = np.cumsum(lengths[some]) - lengths[some], p.argmax(1)
            share = np.add.reduceat(p, first).max(1) / lengths[some]
            level = model.levels[best]
            need, spread = np.add.reduceat(level, first), np.sqrt(np.add.reduceat(level * (1 - level), first))
            short = need - DEVIATIONS * spread - np.add.reduceat(model.is_seen[rows, best].astype(float), first)
            for i, s, x in zip(some, share, short):
                out[i] = (float(s), float(x))
        return out

    return _predict(df, model, text, [T.StructField(score, T.DoubleType()), T.StructField(lack, T.DoubleType())], result)


def keep_known(df: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", least: float = 0.3) -> DataFrame:
    """The rows whose text has words that are evidence enough for the learned languages, and one of these for at least
    the given share; same columns."""
    score, lack = free_name(df, "score"), free_name(df, "lang_lack")
    out = with_evidence(df, fit(df, doc_id, text, lang), text, score, lack)
    return out.filter((F.col(score) > 0) & (F.col(score) >= least) & (F.col(lack) <= 0)).select(*df.columns)
