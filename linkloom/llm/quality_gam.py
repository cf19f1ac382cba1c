"""Quality classifier: a generalised additive model with pairwise interactions.

Features of a text are cut into bins. One shallow tree at a time is fitted to the gradient on
one feature, in cycles over all features; its leaves are added to that feature's look-up table.
Then pairs of features are ranked by how much a coarse grid of them explains of the remaining
gradient, and the best ones get two-dimensional tables in the same way. A document's score is a
sum of looked-up bins.

Most features are figures of the surface. The others say how much a text's words, and the
beginnings of its words, speak for toxicity: log-odds learned from the labelled documents. What
a labelled document is given when the tables are fitted was learned from other documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from linkloom.llm.common import buffers, cut, drop_cut, gram_hashes, release, slices, text_or_empty, word_hashes, words

FEATURES = ["words", "word_bytes", "upper", "symbols", "marks", "bars", "digits", "distinct_words", "repeats_next", "top_word", "distinct_trigrams", "repeated_lines", "line_words", "stops", "non_ascii"]
LEXICAL = ["mean_of_words", "most_of_words", "mean_of_stems", "most_of_stems"]
FOLDS = 5
#: Bytes of text that are looked at at once.
_SLICE = 2 << 20
#: Bytes of a word's beginning that count as its stem.
STEM = 5
_LOWER, _UPPER, _DIGIT, _SPACE, _LINE, _SYMBOL, _MARK, _BAR, _STOP, _HIGH = range(10)
_CLASS = np.full(256, _SYMBOL, np.int8)
_CLASS[97:123] = _LOWER
_CLASS[65:91] = _UPPER
_CLASS[48:58] = _DIGIT
_CLASS[[32, 9, 13]] = _SPACE
_CLASS[10] = _LINE
_CLASS[33] = _MARK
_CLASS[124] = _BAR
_CLASS[[ord(c) for c in ".,;:?'\"()-"]] = _STOP
_CLASS[128:] = _HIGH


def _distinct(of: np.ndarray, h: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """For each text, how many different hashes it has, and how often it has the most frequent one."""
    order = np.lexsort((h, of))
    o, v = of[order], h[order]
    new = np.flatnonzero(np.r_[True, (o[1:] != o[:-1]) | (v[1:] != v[:-1])]) if len(o) else np.zeros(0, np.int64)
    top = np.zeros(n)
    np.maximum.at(top, o[new], np.diff(np.r_[new, len(o)]))
    return np.bincount(o[new], minlength=n), top


def features(texts: pa.Array) -> np.ndarray:
    """A row for each text, a column for each of FEATURES. Nulls count as empty."""
    n = len(texts)
    data, offsets = buffers(texts)
    kind = _CLASS[data]
    # capital letters of two bytes, such as É
    second = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E)) + 1 if len(data) else np.zeros(0, np.int64)
    kind[second] = _UPPER
    cell = np.repeat(np.arange(n, dtype=np.int32) * 10, np.diff(offsets))
    cell += kind
    count = np.bincount(cell, minlength=n * 10).reshape(n, 10).astype(np.float64)
    del cell, kind
    size = np.maximum(np.diff(offsets), 1)

    start, end, word_of = words(data, offsets)
    h = word_hashes(data, start, end)
    n_words = np.bincount(word_of, minlength=n)
    some = np.maximum(n_words, 1)
    distinct, top = _distinct(word_of, h, n)
    same = np.flatnonzero((h[1:] == h[:-1]) & (word_of[1:] == word_of[:-1]))
    repeats = np.bincount(word_of[same], minlength=n)
    g, g_of = gram_hashes(h, word_of, 3)
    trigrams, _ = _distinct(g_of, g, n)

    breaks = np.flatnonzero(data == 10)
    edges = np.unique(np.concatenate([offsets[:-1], breaks + 1, [len(data)]]))
    line_start, line_end = edges[:-1], edges[1:].copy()
    if len(line_end):
        line_end -= data[line_end - 1] == 10
    keep = line_end > line_start
    line_start, line_end = line_start[keep], line_end[keep]
    line_of = np.searchsorted(offsets, line_start, "right") - 1
    n_lines = np.bincount(line_of, minlength=n)
    lines, _ = _distinct(line_of, word_hashes(data, line_start, line_end), n)

    letters = np.maximum(count[:, _LOWER] + count[:, _UPPER] + count[:, _HIGH], 1)
    x = np.stack(
        [
            np.log1p(n_words),
            np.bincount(word_of, weights=end - start, minlength=n) / some,
            count[:, _UPPER] / letters,
            count[:, _SYMBOL] / size,
            count[:, _MARK] / some,
            count[:, _BAR] / some,
            count[:, _DIGIT] / size,
            distinct / some,
            repeats / some,
            top / some,
            trigrams / np.maximum(np.bincount(g_of, minlength=n), 1),
            1 - lines / np.maximum(n_lines, 1),
            np.log1p(n_words / np.maximum(n_lines, 1)),
            count[:, _STOP] / some,
            count[:, _HIGH] / size,
        ],
        axis=1,
    )
    return np.nan_to_num(x)


_SMALL = np.arange(256, dtype=np.uint8)
_SMALL[65:91] += 32
_STEM_SALT = np.uint64(0xA5A5A5A5A5A5A5A5)


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all words in small letters, hashes of their stems, and the number of each word's text."""
    data, offsets = buffers(texts)
    small = _SMALL[data]
    if len(data):
        second = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E)) + 1
        small[second] += 32
    start, end, of = words(data, offsets)
    h = word_hashes(small, np.r_[start, start], np.r_[end, np.minimum(start + STEM, end)])
    return h[: len(start)], h[len(start) :] ^ _STEM_SALT, of


@dataclass
class Lexicon:
    """Sorted hashes of words and stems, and the log-odds of each that a text with it is toxic."""

    hashes: np.ndarray
    weights: np.ndarray

    def features(self, texts: pa.Array) -> np.ndarray:
        """A row for each text, a column for each of LEXICAL. Unknown words weigh nothing."""
        n = len(texts)
        x = np.zeros((n, len(LEXICAL)))
        if not len(self.hashes):
            return x
        *both, of = tokens(texts)
        some = np.maximum(np.bincount(of, minlength=n), 1)
        for k, h in enumerate(both):
            at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
            w = np.where(self.hashes[at] == h, self.weights[at], 0.0)
            x[:, 2 * k] = np.bincount(of, w, n) / some
            np.maximum.at(x[:, 2 * k + 1], of, w)
        return x


def lexicon(hashes: np.ndarray, toxic: np.ndarray, clean: np.ndarray, n_toxic: int, n_clean: int, least: int = 2) -> Lexicon:
    """From the numbers of toxic and clean documents with each hash. Counts are compared with those expected if toxicity didn't matter, one document added to each, so rare words weigh little."""
    if not n_toxic or not n_clean:
        return Lexicon(hashes[:0], np.zeros(0))
    keep = toxic + clean >= least
    hashes, toxic, clean = hashes[keep], toxic[keep], clean[keep]
    share = n_toxic / (n_toxic + n_clean)
    weights = np.log((toxic + 1) / ((toxic + clean) * share + 1)) - np.log((clean + 1) / ((toxic + clean) * (1 - share) + 1))
    order = np.argsort(hashes)
    return Lexicon(hashes[order], weights[order])


@dataclass
class Model:
    """Bin edges and tables of single features, and of pairs on coarser bins."""

    edges: list[np.ndarray]
    coarse: list[np.ndarray]
    bias: float
    single: list[np.ndarray]
    pairs: list[tuple[int, int, np.ndarray]]
    lexicon: Lexicon | None = None

    def logit(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.bias)
        for j, t in enumerate(self.single):
            z += t[np.searchsorted(self.edges[j], x[:, j], "right")]
        grid = {j: np.searchsorted(self.coarse[j], x[:, j], "right") for p in self.pairs for j in p[:2]}
        for a, b, t in self.pairs:
            z += t[grid[a], grid[b]]
        return z

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logit(x), -35, 35)))

    def judge(self, texts: pa.Array) -> np.ndarray:
        """The probability of each text."""
        return self.probability(np.hstack([features(texts), self.lexicon.features(texts)]))


def _edges(v: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(v, np.arange(1, bins) / bins, method="higher")) if len(v) else np.zeros(0)


def _gain(g: np.ndarray, h: np.ndarray, l2: float) -> np.ndarray:
    return g * g / (h + l2)


def _tree(g: np.ndarray, h: np.ndarray, leaves: int, l2: float) -> np.ndarray:
    """Newton steps of a tree with so many leaves over ordered bins, best split first."""
    parts = [(0, len(g))]

    def best(lo: int, hi: int) -> tuple[float, int]:
        if hi - lo < 2:
            return 0.0, -1
        cg, ch = np.cumsum(g[lo:hi]), np.cumsum(h[lo:hi])
        gain = _gain(cg[:-1], ch[:-1], l2) + _gain(cg[-1] - cg[:-1], ch[-1] - ch[:-1], l2) - _gain(cg[-1], ch[-1], l2)
        k = int(np.argmax(gain))
        return float(gain[k]), lo + k + 1

    while len(parts) < leaves:
        found = [(*best(*p), p) for p in parts]
        gain, at, p = max(found, key=lambda x: x[0])
        if gain <= 1e-12:
            break
        parts.remove(p)
        parts += [(p[0], at), (at, p[1])]
    out = np.zeros(len(g))
    for lo, hi in parts:
        out[lo:hi] = g[lo:hi].sum() / (h[lo:hi].sum() + l2)
    return out


def _grid_tree(g: np.ndarray, h: np.ndarray, leaves: int, l2: float) -> tuple[np.ndarray, float]:
    """The same over a grid, split across either axis; also the gain."""
    parts = [(0, g.shape[0], 0, g.shape[1])]
    total = 0.0

    def best(p: tuple[int, int, int, int]) -> tuple[float, int, int]:
        found = (0.0, -1, -1)
        gg, hh = g[p[0] : p[1], p[2] : p[3]], h[p[0] : p[1], p[2] : p[3]]
        for axis in (0, 1):
            cg, ch = np.cumsum(gg.sum(1 - axis)), np.cumsum(hh.sum(1 - axis))
            if len(cg) > 1:
                gain = _gain(cg[:-1], ch[:-1], l2) + _gain(cg[-1] - cg[:-1], ch[-1] - ch[:-1], l2) - _gain(cg[-1], ch[-1], l2)
                k = int(np.argmax(gain))
                if gain[k] > found[0]:
                    found = (float(gain[k]), axis, p[2 * axis] + k + 1)
        return found

    while len(parts) < leaves:
        gain, axis, at, p = max(((*best(p), p) for p in parts), key=lambda x: x[0])
        if gain <= 1e-12:
            break
        total += gain
        parts.remove(p)
        parts += [(*p[:1], at, *p[2:]), (at, *p[1:])] if axis == 0 else [(*p[:3], at), (*p[:2], at, p[3])]
    out = np.zeros(g.shape)
    for a, b, c, d in parts:
        out[a:b, c:d] = g[a:b, c:d].sum() / (h[a:b, c:d].sum() + l2)
    return out, total


def fit(x: np.ndarray, y: np.ndarray, *, bins: int = 32, coarse_bins: int = 8, rounds: int = 80, pair_rounds: int = 30, n_pairs: int = 6, leaves: int = 3, rate: float = 0.2, l2: float = 1.0) -> Model:
    """Fits the tables. Without rows of both classes the model is the (smoothed) share of good rows."""
    share = (y.sum() + 1) / (len(y) + 2) if len(y) else 0.5
    edges = [_edges(x[:, j], bins) for j in range(x.shape[1])]
    coarse = [_edges(x[:, j], coarse_bins) for j in range(x.shape[1])]
    model = Model(edges, coarse, float(np.log(share / (1 - share))), [np.zeros(len(e) + 1) for e in edges], [])
    if not len(y) or y.min() == y.max():
        return model
    z = np.full(len(y), model.bias)
    at = [np.searchsorted(e, x[:, j], "right") for j, e in enumerate(edges)]

    def gradient() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-z))
        return y - p, p * (1 - p)

    for _ in range(rounds):
        for j, t in enumerate(model.single):
            if len(t) < 2:
                continue
            g, h = gradient()
            step = rate * _tree(np.bincount(at[j], g, len(t)), np.bincount(at[j], h, len(t)), leaves, l2)
            t += step
            z += step[at[j]]
    cells = [np.searchsorted(e, x[:, j], "right") for j, e in enumerate(coarse)]
    sizes = [len(e) + 1 for e in coarse]

    def grid(a: int, b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        cell = cells[a] * sizes[b] + cells[b]
        g, h = gradient()
        shape = (sizes[a], sizes[b])
        return np.bincount(cell, g, shape[0] * shape[1]).reshape(shape), np.bincount(cell, h, shape[0] * shape[1]).reshape(shape), cell

    ranked = sorted(((-_grid_tree(*grid(a, b)[:2], 4, l2)[1], a, b) for a in range(x.shape[1]) for b in range(a)), key=lambda r: r)
    model.pairs = [(a, b, np.zeros((sizes[a], sizes[b]))) for _, a, b in ranked[:n_pairs]]
    for _ in range(pair_rounds):
        for a, b, t in model.pairs:
            g, h, cell = grid(a, b)
            step = rate * _grid_tree(g, h, 4, l2)[0]
            t += step
            z += step.reshape(-1)[cell]
    return model


def _feature_rows(lexicons: list[Lexicon]):
    """(y, x) of each labelled text; its lexical features are those of its fold's lexicon."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", _SLICE):
                texts, fold = part.column("text"), part.column("fold").to_numpy()
                lexical = np.zeros((len(texts), len(LEXICAL)))
                for k in np.unique(fold):
                    at = np.flatnonzero(fold == k)
                    lexical[at] = lexicons[k].features(texts.take(pa.array(at)))
                x = np.hstack([features(texts), lexical])
                yield pa.RecordBatch.from_arrays([part.column("y"), pa.FixedSizeListArray.from_arrays(pa.array(x.reshape(-1)), x.shape[1]).cast(pa.list_(pa.float64()))], ["y", "x"])
            release()

    return run


def _token_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many texts of a slice have each hash, by fold and toxicity."""
    for batch in batches:
        for part in slices(batch, "text", _SLICE):
            h_words, h_stems, of = tokens(part.column("text"))
            h, of = np.r_[h_words, h_stems], np.r_[of, of]
            order = np.lexsort((of, h))
            h, of = h[order], of[order]
            new = np.r_[True, (h[1:] != h[:-1]) | (of[1:] != of[:-1])] if len(h) else np.zeros(0, bool)
            h, of = h[new], of[new]
            kind = (2 * part.column("fold").to_numpy() + part.column("toxic").to_numpy())[of]
            order = np.lexsort((kind, h))
            h, kind = h[order], kind[order]
            new = np.flatnonzero(np.r_[True, (h[1:] != h[:-1]) | (kind[1:] != kind[:-1])]) if len(h) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(h[new].view(np.int64)), pa.array(kind[new].astype(np.int32)), pa.array(np.diff(np.r_[new, len(h)]))], ["hash", "kind", "n"])
        release()


def _lexicons(rows: DataFrame) -> list[Lexicon]:
    """A lexicon for each fold, learned from the others, and one learned from all."""
    sizes = np.zeros(2 * FOLDS, np.int64)
    for r in rows.groupBy("fold", "toxic").count().collect():
        sizes[2 * r["fold"] + r["toxic"]] += r["count"]
    if not sizes[1::2].sum():
        return [lexicon(np.zeros(0, np.uint64), *[np.zeros(0)] * 2, 0, 0)] * (FOLDS + 1)
    counts = rows.select("text", "fold", "toxic").mapInArrow(_token_rows, "hash long, kind int, n long").groupBy("hash").agg(*[F.sum(F.when(F.col("kind") == k, F.col("n")).otherwise(0)).alias(f"n{k}") for k in range(2 * FOLDS)])
    table = counts.where("+".join(f"n{k}" for k in range(2 * FOLDS)) + " >= 2").toArrow()
    hashes = table.column("hash").to_numpy().view(np.uint64)
    n = np.stack([table.column(f"n{k}").to_numpy() for k in range(2 * FOLDS)])
    out = []
    for k in range(FOLDS + 1):
        used = [j for j in range(FOLDS) if j != k]
        toxic, clean = [2 * j + 1 for j in used], [2 * j for j in used]
        out.append(lexicon(hashes, n[toxic].sum(0), n[clean].sum(0), int(sizes[toxic].sum()), int(sizes[clean].sum())))
    return out


def train(docs: DataFrame, labels: DataFrame, *, max_train_rows: int = 20_000, **options) -> Model:
    """Fits the model to labelled documents. One is good if its quality is 1 and it isn't toxic.

    ``max_train_rows`` bounds the labels used: those with the smallest hash of doc_id. A
    document with several labels has its lowest quality, and is toxic if one says so. A toxic
    one is bad whatever its quality, even null; a null toxic counts as 0. Null ids, and rows
    that say nothing of quality and aren't toxic, are left out.
    """
    toxic = F.coalesce(labels["toxic"].cast("double") > 0.5, F.lit(False)).cast("int") if "toxic" in labels.columns else F.lit(0)
    known = labels.select(labels["doc_id"].cast("long").alias("id"), labels["quality"].cast("double").alias("y"), toxic.alias("toxic")).withColumn("y", F.when(F.col("toxic") == 1, 0.0).otherwise(F.col("y")))
    known = known.where("id is not null and y is not null").groupBy("id").agg(F.min("y").alias("y"), F.max("toxic").alias("toxic"))
    known = known.orderBy(F.xxhash64("id"), "id").limit(max_train_rows).withColumn("fold", F.pmod(F.xxhash64("id", F.lit("fold")), F.lit(FOLDS)).cast("int"))
    rows = cut(docs.select(docs["doc_id"].cast("long").alias("id"), text_or_empty(docs["text"]).alias("text")).join(F.broadcast(known), "id").select("y", "toxic", "fold", "text"))
    lexicons = _lexicons(rows)
    table = rows.select("y", "fold", "text").mapInArrow(_feature_rows(lexicons), "y double, x array<double>").toArrow()
    drop_cut(rows)
    y = table.column("y").to_numpy()
    width = len(FEATURES) + len(LEXICAL)
    x = np.asarray(table.column("x").combine_chunks().flatten()).reshape(len(y), width) if len(y) else np.zeros((0, width))
    order = np.lexsort((*x.T, y))
    model = fit(x[order], (y[order] > 0.5).astype(np.float64), **options)
    model.lexicon = lexicons[-1]
    return model


def score(text: Column, model: Model) -> Column:
    """The probability that a text is good. Null counts as empty."""

    @F.arrow_udf(DoubleType())
    def run(t: pa.Array) -> pa.Array:
        batch = pa.RecordBatch.from_arrays([pc.fill_null(t, "")], ["text"])
        parts = [model.judge(p.column("text")) for p in slices(batch, "text", _SLICE)]
        release()
        return pa.array(np.concatenate(parts) if parts else np.zeros(0))

    return run(text)


def quality_scores(docs: DataFrame, labels: DataFrame, *, accept: float = 0.5, max_train_rows: int = 20_000, **options) -> DataFrame:
    """(doc_id, quality_score, accepted) for each row of ``docs``.

    ``quality_score`` is the model's probability, rounded to 6 digits; ``accepted`` if the
    unrounded one is at least ``accept``. The model is fitted to ``labels`` (doc_id, quality,
    toxic) as in ``train``, and good means of good quality and not toxic; with no usable label, or labels of one class, every document has the same
    score. Null texts count as empty; repeated rows are scored each; a null doc_id stays null;
    long texts are read whole; an empty table gives an empty result; other columns are ignored.
    """
    model = train(docs, labels, max_train_rows=max_train_rows, **options)
    scored = docs.select(docs["doc_id"].cast("long").alias("doc_id"), score(text_or_empty(docs["text"]), model).alias("p"))
    return scored.select("doc_id", F.round("p", 6).alias("quality_score"), (F.col("p") >= F.lit(accept)).alias("accepted"))


def keep_good(docs: DataFrame, labels: DataFrame, *, accept: float = 0.5, max_train_rows: int = 20_000, **options) -> DataFrame:
    """The rows of ``docs`` that ``quality_scores`` accepts, with their own columns."""
    model = train(docs, labels, max_train_rows=max_train_rows, **options)
    return docs.where(score(text_or_empty(docs["text"]), model) >= F.lit(accept))
