"""Benchmark decontamination: training passages query a BM25 index of test items with block-max WAND.

An item's BM25 weights are divided by its score against itself, so one threshold suits all
items. Posting lists are cut into blocks of items, and the greatest weight is kept for each term
and for each of its blocks. All passages of a slice of documents are queried at once:

1. a passage whose terms' greatest weights don't add up to the threshold has no pivot: skipped;
2. a block of items whose block maxima don't add up to the threshold is skipped for a passage;
3. the rest is scored exactly.

No bound is ever below a score, so all items above the threshold are retrieved. Retrieved items
are verified by the word n-grams of their question and answer that the passage holds.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from linkloom.llm.common import buffers, gram_hashes, release, slices, text_or_empty, word_hashes, words

SCHEMA = "doc_id long, passage long, item_id long, bm25 double, question_overlap double, answer_overlap double, contaminated boolean"
_FIELDS = pa.schema([("doc_id", pa.int64()), ("passage", pa.int64()), ("item_id", pa.int64()), ("bm25", pa.float64()), ("question_overlap", pa.float64()), ("answer_overlap", pa.float64()), ("contaminated", pa.bool_())])
#: Postings that are scored at once, so that memory follows neither the slice nor the number of items.
_POSTINGS_AT_ONCE = 1 << 20
#: Bytes of text that are searched at once.
_SLICE = 2 << 20
_SENTENCE = re.compile(r"(?<=[.?!])\s+|\n+")


def hashed(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of the lower-cased texts, and the number of each word's text."""
    data, offsets = buffers(pc.utf8_lower(texts))
    start, end, of = words(data, offsets)
    return word_hashes(data, start, end), of


def question_and_answer(text: str) -> tuple[str, str]:
    """The last sentence or line is the answer, what comes before it the question; a single sentence is both."""
    parts = [p for p in _SENTENCE.split(text) if p.strip()]
    if len(parts) < 2:
        return text, text
    return "\n".join(parts[:-1]), parts[-1]


@dataclass
class Index:
    """Items' parts as posting lists by term, with maxima by term and by block of items."""

    terms: np.ndarray
    seen: np.ndarray
    ends: np.ndarray
    items: np.ndarray
    weights: np.ndarray
    greatest: np.ndarray
    block_ends: np.ndarray
    blocks: np.ndarray
    block_greatest: np.ndarray
    n_blocks: int
    block_items: int
    ids: np.ndarray
    questions: list[np.ndarray]
    answers: list[np.ndarray]
    whole: list[tuple[bool, bool]]
    n: int


def _grams(h: np.ndarray, n: int) -> np.ndarray:
    return np.unique(gram_hashes(h, np.zeros(len(h), np.int64), n)[0])


def parts_of(rows: list[tuple[int, str]], most_words: int) -> list[tuple[int, np.ndarray, np.ndarray, np.ndarray, tuple[bool, bool]]]:
    """(item, word hashes, those of the question, those of the answer, whether these two are looked for in the whole text) of runs of at most ``most_words`` words of each item.

    An item of one run is looked for in a passage, both question and answer. A run of a longer
    item has the share of the question, or of the answer, that falls in it, which is looked for
    in the passage; what it has no share of is the item's own, wherever the text holds it.
    """
    out = []
    for item, text in rows:
        q, a = question_and_answer(text)
        h, of = hashed(pa.array([text, q, a]))
        whole, question, answer = h[of == 0], h[of == 1], h[of == 2]
        single = q is text or not len(question) or not len(answer)
        for at in range(0, len(whole), most_words):
            run = whole[at : at + most_words]
            if single:
                out.append((item, run, run, run, (False, False)))
            else:
                cut = min(max(len(question) - at, 0), len(run))
                out.append((item, run, run[:cut] if cut else question, run[cut:] if cut < len(run) else answer, (not cut, cut == len(run))))
    return out


def frequencies(parts: list[tuple], into: dict[int, int]) -> None:
    """Adds the number of parts that hold each term."""
    for part in parts:
        for t in np.unique(part[1]).tolist():
            into[t] = into.get(t, 0) + 1


def build_index(parts: list[tuple], df: dict[int, int], n_parts: int, mean_words: float, *, k1: float, b: float, block_items: int, n: int) -> Index:
    term, item, weight = [], [], []
    for i, (_, run, *_) in enumerate(parts):
        t, tf = np.unique(run, return_counts=True)
        d = np.array([df[x] for x in t.tolist()], np.float64)
        idf = np.log1p((n_parts - d + 0.5) / (d + 0.5))
        w = idf * tf * (k1 + 1) / (tf + k1 * (1 - b + b * len(run) / mean_words))
        term.append(t)
        item.append(np.full(len(t), i))
        weight.append(w / w.sum())
    term, item, weight = (np.concatenate(x) if x else np.zeros(0, np.uint64) for x in (term, item, weight))
    order = np.lexsort((item, term))
    term, item, weight = term[order], item[order].astype(np.int64), weight[order].astype(np.float64)
    terms, first = np.unique(term, return_index=True)
    of_term = np.searchsorted(terms, term)
    greatest = np.zeros(len(terms))
    np.maximum.at(greatest, of_term, weight)
    block = item // block_items
    new = np.flatnonzero(np.r_[True, (of_term[1:] != of_term[:-1]) | (block[1:] != block[:-1])]) if len(term) else np.zeros(0, np.int64)
    seen = np.zeros(1 << 20, bool)
    seen[(terms & np.uint64((1 << 20) - 1)).astype(np.int64)] = True
    return Index(
        terms, seen, np.r_[first, len(term)].astype(np.int64), item, weight, greatest,
        np.searchsorted(of_term[new], np.arange(len(terms) + 1)), block[new], np.maximum.reduceat(weight, new) if len(new) else np.zeros(0),
        -(-len(parts) // block_items), block_items, np.array([p[0] for p in parts], np.int64), [_grams(p[2], n) for p in parts], [_grams(p[3], n) for p in parts], [p[4] for p in parts], n,
    )


def _spread(ends: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each entry, the places of its term's list: (number of the entry, place)."""
    count = ends[of + 1] - ends[of]
    entry = np.repeat(np.arange(len(of)), count)
    return entry, np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(ends[of], count)


def retrieve(index: Index, passage: np.ndarray, term: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(passage, part, score) of all parts that reach the threshold, given each passage's different terms. Passages are numbered from 0."""
    eps = 1e-9
    n = int(passage.max()) + 1 if len(passage) else 0
    live = np.bincount(passage, index.greatest[term], n) >= threshold - eps
    keep = live[passage]
    passage, term = passage[keep], term[keep]
    if not len(passage):
        return (np.zeros(0, np.int64),) * 2 + (np.zeros(0),)
    order = np.argsort(passage, kind="stable")
    passage, term = passage[order], term[order]
    # whole passages at a time, with about so many postings
    work = np.cumsum(index.ends[term + 1] - index.ends[term])
    new = np.r_[True, passage[1:] != passage[:-1]]
    run = (work[new] // _POSTINGS_AT_ONCE)[np.cumsum(new) - 1]
    bounds = np.r_[np.flatnonzero(np.r_[True, run[1:] != run[:-1]]), len(passage)].tolist()
    found = [_scored(index, passage[lo:hi], term[lo:hi], threshold) for lo, hi in zip(bounds, bounds[1:])]
    return tuple(np.concatenate(c) for c in zip(*found))


def _scored(index: Index, passage: np.ndarray, term: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Block maxima, then exact scores, of passages that are left."""
    eps = 1e-9
    ids, passage = np.unique(passage, return_inverse=True)
    entry, at = _spread(index.block_ends, term)
    bound = np.bincount(passage[entry] * index.n_blocks + index.blocks[at], index.block_greatest[at], len(ids) * index.n_blocks)
    live = bound >= threshold - eps
    some = live.reshape(len(ids), -1).any(1)[passage]
    passage, term = passage[some], term[some]
    entry, at = _spread(index.ends, term)
    keep = live[passage[entry] * index.n_blocks + index.items[at] // index.block_items]
    entry, at = entry[keep], at[keep]
    pair, inverse = np.unique(passage[entry] * len(index.ids) + index.items[at], return_inverse=True)
    score = np.bincount(inverse, index.weights[at], len(pair))
    hit = score >= threshold - eps
    return ids[pair[hit] // len(index.ids)], pair[hit] % len(index.ids), score[hit]


def search(index: Index, texts: pa.Array, window: int, threshold: float, overlap: float) -> list[tuple[int, int, int, float, float, float, bool]]:
    """(text, passage, item, score, question overlap, answer overlap, contaminated): the best passage for each text and item."""
    h, of = hashed(texts)
    if not len(h) or not len(index.ids):
        return []
    n_texts = len(texts)
    first = np.searchsorted(of, np.arange(n_texts + 1))
    n_words = np.diff(first)
    step = window // 2
    n_passages = np.maximum(1, -(-(n_words - window) // step) + 1)
    base = np.cumsum(n_passages) - n_passages
    hit = np.flatnonzero(index.seen[(h & np.uint64((1 << 20) - 1)).astype(np.int64)])
    term = np.minimum(np.searchsorted(index.terms, h[hit]), len(index.terms) - 1)
    right = index.terms[term] == h[hit]
    hit, term = hit[right], term[right]
    text = of[hit]
    late = (hit - first[text]) // step
    last = n_passages[text] - 1
    both = (late > 0) & (late <= last)
    passage = np.concatenate([base[text] + np.minimum(late, last), (base[text] + late - 1)[both]])
    term = np.concatenate([term, term[both]])
    key = np.unique(passage * len(index.terms) + term)
    found = retrieve(index, key // len(index.terms), key % len(index.terms), threshold)
    best: dict[tuple[int, int], tuple] = {}
    held: tuple[int, np.ndarray] = (-1, np.zeros(0, np.uint64))
    for p, part, score in zip(found[0].tolist(), found[1].tolist(), found[2].tolist()):
        t = int(np.searchsorted(base, p, "right") - 1)
        if held[0] != p:
            lo = first[t] + (p - base[t]) * step
            run = h[lo : min(lo + window, first[t + 1])]
            held = (p, run)
        shares = [_share(grams, h[first[t] : first[t + 1]] if whole else held[1], index.n) for grams, whole in zip((index.questions[part], index.answers[part]), index.whole[part])]
        item = int(index.ids[part])
        row = (t, p - int(base[t]), item, round(score, 6), round(shares[0], 6), round(shares[1], 6), min(shares) >= overlap - 1e-9)
        key_ = (t, item)
        rank = (row[6], min(row[4:6]), row[3], -row[1])
        if key_ not in best or rank > best[key_][0]:
            best[key_] = (rank, row)
    return [best[k][1] for k in sorted(best)]


def _share(grams: np.ndarray, run: np.ndarray, n: int) -> float:
    """Share of an item's grams that a run of words holds; grams of fewer than n words, from short parts, are looked for as such."""
    inside = [gram_hashes(run, np.zeros(len(run), np.int64), n)[0]]
    if len(grams) == 1:
        inside += [short_grams(run, k) for k in range(1, n)]
    return float(np.isin(grams, np.concatenate(inside)).mean()) if len(grams) else 0.0


def short_grams(run: np.ndarray, k: int) -> np.ndarray:
    """Every run of k words, hashed as the single gram of a text of just those k words when grams have more."""
    m = len(run) - k + 1
    if m < 1:
        return np.zeros(0, np.uint64)
    idx = (np.arange(m)[:, None] + np.arange(k)).reshape(-1)
    return gram_hashes(run[idx], np.repeat(np.arange(m), k), k + 1)[0]


class Searcher:
    """An index of all or a share of the items, with what the search needs beside it."""

    def __init__(self, index: Index, window: int, threshold: float, overlap: float):
        self.index, self.window, self.threshold, self.overlap = index, window, threshold, overlap

    def rows(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", _SLICE):
                found = search(self.index, part.column("text"), self.window, self.threshold, self.overlap)
                release()
                if found:
                    ids = part.column("id")
                    columns = list(zip(*found))
                    yield pa.RecordBatch.from_arrays([ids.take(pa.array(columns[0])), *[pa.array(c, f.type) for c, f in zip(columns[1:], list(_FIELDS)[1:])]], schema=_FIELDS)

    def dirty(self, texts: pa.Array) -> np.ndarray:
        out = []
        for part in slices(pa.RecordBatch.from_arrays([pc.fill_null(texts, "")], ["text"]), "text", _SLICE):
            flag = np.zeros(part.num_rows, bool)
            for row in search(self.index, part.column("text"), self.window, self.threshold, self.overlap):
                flag[row[0]] |= row[6]
            out.append(flag)
            release()
        return np.concatenate(out) if out else np.zeros(0, bool)


def searchers(benchmark: DataFrame, *, threshold: float, overlap: float, most_words: int, k1: float, b: float, block_items: int, n: int, most_index_bytes: int) -> list[Searcher]:
    """Indexes of the items, each of at most about ``most_index_bytes`` of item text; the statistics are those of all items."""
    items = benchmark.select(benchmark["item_id"].cast("long").alias("id"), benchmark["text"].cast("string").alias("text")).where("id is not null and text is not null").distinct()
    size = items.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    shards = max(1, -(-size // most_index_bytes))

    def shard(k: int) -> list[tuple]:
        rows = items if shards == 1 else items.where(F.pmod(F.xxhash64("id"), F.lit(shards)) == k)
        return parts_of(sorted((r["id"], r["text"]) for r in rows.collect()), most_words)

    df: dict[int, int] = {}
    n_parts = n_words = longest = 0
    kept = []
    for k in range(shards):
        parts = shard(k)
        frequencies(parts, df)
        n_parts += len(parts)
        n_words += sum(len(p[1]) for p in parts)
        longest = max([longest, *(len(p[1]) for p in parts)])
        kept = parts
    window = 2 * max(32, longest)
    options = {"k1": k1, "b": b, "block_items": block_items, "n": n}
    mean = n_words / max(1, n_parts)
    return [Searcher(build_index(kept if shards == 1 else shard(k), df, n_parts, mean, **options), window, threshold, overlap) for k in range(shards)]


def _options(threshold: float = 0.5, overlap: float = 0.5, most_words: int = 128, k1: float = 1.2, b: float = 0.75, block_items: int = 16, n: int = 3, most_index_bytes: int = 16 << 20) -> dict:
    if not 0 < threshold <= 1 or not 0 < overlap <= 1 or min(most_words, block_items, n) < 1:
        raise ValueError("threshold and overlap must be in (0, 1], sizes positive")
    return dict(threshold=threshold, overlap=overlap, most_words=most_words, k1=k1, b=b, block_items=block_items, n=n, most_index_bytes=most_index_bytes)


def benchmark_hits(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """Items that passages of the documents retrieve: (doc_id, passage, item_id, bm25, question_overlap, answer_overlap, contaminated).

    A passage is a window of words, twice as long as the longest indexed item and 64 words at
    least, beginning every half window, so that an item lies whole in one; together they cover
    the whole text. ``bm25`` is the passage's score as a share of the item's score against
    itself (each term of the passage counts once); all items with ``threshold`` or more are
    retrieved. ``contaminated`` if question and answer both have a share of ``overlap`` or more
    of their word ``n``-grams in the passage. For a document and item there is one row, of the
    passage with the greatest overlap (then score, then the earliest). Items longer than
    ``most_words`` are indexed in runs of so many words. A run's share of question or answer is
    looked for in the passage; if it has none of one of them, the item's own is looked for in
    the whole text.
    Item text beyond ``most_index_bytes`` is searched in several indexes, one after another.

    Null or wordless texts and items, and items without id, retrieve nothing; documents without
    id have a null doc_id; repeated documents give repeated rows, repeated items don't; items
    with one text are all retrieved; an empty table gives an empty result; other columns are
    ignored.
    """
    rows = docs.select(docs["doc_id"].cast("long").alias("id"), text_or_empty(docs["text"]).alias("text"))
    found = [rows.mapInArrow(s.rows, SCHEMA) for s in searchers(benchmark, **_options(**options))]
    out = found[0]
    for x in found[1:]:
        out = out.unionByName(x)
    return out


def is_contaminated(text: Column, searcher: Searcher) -> Column:
    """Whether a text leaks an item of the searcher's index."""

    @F.arrow_udf(BooleanType())
    def run(t: pa.Array) -> pa.Array:
        return pa.array(searcher.dirty(t))

    return run(text)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that leak no item, as ``benchmark_hits`` judges, with their own columns."""
    for s in searchers(benchmark, **_options(**options)):
        docs = docs.where(~is_contaminated(text_or_empty(docs["text"]), s))
    return docs
