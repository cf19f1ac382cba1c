"""Language-model scoring by a hierarchical Pitman-Yor model of words.

A restaurant stands for a context, the word before; its customers are the words that follow it
in all documents, and its tables are customers of the parent, the root, which all contexts
share. The root's tables are drawn from all words of the corpus alike. Contexts, dishes and
words are those of the corpus, so the model grows with it; nothing is folded or cut off.

Gibbs sampling seats the customers: for one dish of one restaurant after the other the number
of tables is drawn given all others. Dishes of a restaurant are drawn in ``BLOCKS`` blocks by
their place, so in restaurants of no more dishes one after the other, in larger ones many at
once given the tables of the rest. Between rounds the root's customers are counted anew and its
tables are drawn. Predictive probabilities are averaged over samples and give each document's
perplexity.

Pairs of words travel once, from chunks of documents to parts of the hash space of contexts, in
sorted messages with the documents that they occur in; counts are sums over all documents. Each
part then stays where it was written, in a table bucketed by part, and only its root words and
their counts travel in a round. A part sends each chunk the sums of its documents' logarithms.
A context that is frequent enough to fill a part is spread over several by a hash of the word
after it; the parts' tables of it are added up between rounds.
"""

from __future__ import annotations

import math
import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.llm.common import buffers, cut, drop_cut, ensure_checkpoint_dir, mix, partitions, release, slices, text_or_empty, word_hashes, words
from linkloom.llm.ngram_join import _expand, _squeeze

#: Dishes of one restaurant are drawn in so many blocks.
BLOCKS = 8
_EXACT = 256
_FEW = 48
_BEGIN = np.uint64(0x9B1A5F3C7D2E4861)
_MOST_DOCS = 1 << 16
_MOST_OCCURRENCES = 255


def pack(*arrays: np.ndarray) -> bytes:
    return struct.pack(f"<{len(arrays)}q", *(a.nbytes for a in arrays)) + b"".join(a.tobytes() for a in arrays)


def unpack(payload: bytes, *kinds: type) -> list[np.ndarray]:
    sizes = struct.unpack_from(f"<{len(kinds)}q", payload)
    at = 8 * len(kinds)
    out = []
    for kind, size in zip(kinds, sizes):
        out.append(np.frombuffer(payload, kind, size // np.dtype(kind).itemsize, at))
        at += size
    return out


def _sorted_bytes(a: np.ndarray) -> np.ndarray:
    """Sorted numbers as differences of as few bytes as they need."""
    if not len(a):
        return np.zeros(0, np.uint8)
    width, payload = _squeeze(a.astype(np.uint64))
    return np.frombuffer(bytes([width]) + payload, np.uint8)


def _from_sorted_bytes(b: np.ndarray) -> np.ndarray:
    return _expand(int(b[0]), b[1:].tobytes()) if len(b) else np.zeros(0, np.uint64)


def pieces(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``words``, but each character from U+3000 on is a word by itself: these scripts have no spaces between words, or need none."""
    start, end, of = words(data, offsets)
    wide = np.flatnonzero(data >= 0xE3)
    if not len(wide) or not len(start):
        return start, end, of
    after = wide + np.where(data[wide] < 0xF0, 3, 4)
    at = np.unique(np.concatenate([start, wide, after]))
    word = np.searchsorted(start, at, "right") - 1
    inside = at < end[word]
    at, word = at[inside], word[inside]
    until = np.minimum(np.r_[at[1:], end[-1]], end[word])
    return at, until, of[word]


def _part_of(h: np.ndarray, parts: int) -> np.ndarray:
    """The part of a hash, by equal ranges of its upper half."""
    return ((h >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)


def _places(start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """start[k], start[k] + 1, ..., n[k] places for each k."""
    ends = np.cumsum(n)
    return np.repeat(start - (ends - n), n) + np.arange(ends[-1] if len(ends) else 0)


_MESSAGE = pa.schema([("part", pa.int64()), ("chunk", pa.int64()), ("payload", pa.binary())])
_MESSAGE_SQL = "part long, chunk long, payload binary"


def bigrams(h: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(context, word, number of occurrences) of the pairs of words in order of both, and the documents of all occurrences. ``h``: words in order; ``doc``: the document of each."""
    known, inverse = np.unique(np.concatenate([h, [_BEGIN]]), return_inverse=True)
    w, begin = inverse[:-1].astype(np.uint64), inverse[-1]
    v = np.empty_like(w)
    v[1:] = w[:-1]
    v[np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])] = begin
    bits = int(len(known)).bit_length()
    if 2 * bits + 16 <= 64:
        key = np.sort(v << np.uint64(bits + 16) | w << np.uint64(16) | doc.astype(np.uint64))
        doc = (key & np.uint64(0xFFFF)).astype(np.uint16)
        v, w = key >> np.uint64(bits + 16), (key >> np.uint64(16)) & np.uint64((1 << bits) - 1)
    else:
        order = np.lexsort((doc, w, v))
        v, w, doc = v[order], w[order], doc[order]
    first = np.flatnonzero(np.r_[True, (v[1:] != v[:-1]) | (w[1:] != w[:-1])])
    return known[v[first].astype(np.int64)], known[w[first].astype(np.int64)], np.diff(np.r_[first, len(v)]), doc


def _messages(parts: int, hot: np.ndarray, pieces_of_hot: np.ndarray, chunk_bytes: int):
    """A header for each chunk of documents, and a message for each part of the contexts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 32
        number = docs = held = 0
        hashes: list[np.ndarray] = []
        of: list[np.ndarray] = []
        heads: list[tuple[np.ndarray, ...]] = []

        def flush() -> pa.RecordBatch:
            nonlocal number, docs, held
            chunk = first + number
            h, doc = np.concatenate(hashes), np.concatenate(of)
            ids, missing, n_words = (np.concatenate(x) for x in zip(*heads))
            hashes.clear(), of.clear(), heads.clear()
            rows: list[tuple] = []
            common_n, common_docs = np.zeros(0, np.int64), np.zeros(0, np.uint16)
            if len(h):
                v, w, n, doc = bigrams(h, doc)
                part = _part_of(v, parts).astype(np.int64)
                if len(hot):
                    at = np.minimum(np.searchsorted(hot, v), len(hot) - 1)
                    is_hot = np.flatnonzero(hot[at] == v)
                    piece = mix(w[is_hot]) % pieces_of_hot[at[is_hot]]
                    part[is_hot] = _part_of(mix(v[is_hot] + piece), parts)
                order = np.argsort(part, kind="stable")
                start = (np.cumsum(n) - n)[order]
                v, w, n, part = v[order], w[order], n[order], part[order]
                common = n > _MOST_OCCURRENCES
                common_n, common_docs = n[common], doc[_places(start[common], n[common])]
                edges = np.searchsorted(part, np.arange(parts + 1))
                for p in np.flatnonzero(np.diff(edges)).tolist():
                    own = slice(edges[p], edges[p + 1])
                    runs = np.flatnonzero(np.r_[True, v[own][1:] != v[own][:-1]])
                    here, index = np.unique(w[own], return_inverse=True)
                    rare = ~common[own]
                    rows.append((p, chunk, pack(_sorted_bytes(v[own][runs]), np.diff(np.r_[runs, own.stop - own.start]).astype(np.uint32), _sorted_bytes(here), index.astype(np.uint16 if len(here) <= 1 << 16 else np.uint32), np.where(rare, n[own], 0).astype(np.uint8), doc[_places(start[own][rare], n[own][rare])], n[own][~rare])))
            rows.append((-1 - chunk, chunk, pack(ids, missing, n_words, common_n, common_docs)))
            docs = held = 0
            number += 1
            release()
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _MESSAGE)], schema=_MESSAGE)

        for batch in batches:
            for part in slices(batch):
                if docs and (docs + part.num_rows > _MOST_DOCS or held >= chunk_bytes):
                    yield flush()
                data, offsets = buffers(pc.utf8_lower(part.column("text")))
                start, end, text = pieces(data, offsets)
                hashes.append(word_hashes(data, start, end))
                of.append((text + docs).astype(np.uint16))
                ids = part.column("id")
                heads.append((pc.fill_null(ids, 0).to_numpy(zero_copy_only=False).astype(np.int64), np.asarray(ids.is_null().cast(pa.uint8())), np.bincount(text, minlength=part.num_rows)))
                docs += part.num_rows
                held += part.column("text").nbytes
        if docs:
            yield flush()

    return run


_STATE_SQL = "part long, header binary, words binary, contexts binary, types binary, hot binary, refs binary, sums binary, seated binary, n1 long, n2 long, hot_rows array<struct<hot:long,c:long,t:long>>"
_STATE = pa.schema([("part", pa.int64()), *[(x, pa.binary()) for x in ("header", "words", "contexts", "types", "hot", "refs", "sums", "seated")], ("n1", pa.int64()), ("n2", pa.int64()), ("hot_rows", pa.list_(pa.struct([("hot", pa.int64()), ("c", pa.int64()), ("t", pa.int64())])))])


def _index_kind(message: bytes) -> type:
    sizes = struct.unpack_from("<7q", message)
    return np.uint16 if sizes[3] == 2 * sizes[4] else np.uint32


def _merge(hot: np.ndarray):
    """Of one part: its contexts, the words after each with their counts, and where each message's pairs are among them."""

    def run(group: pa.Table) -> pa.Table:
        release()
        part = group.column("part")[0].as_py()
        if part < 0:
            row = [part, group.column("payload")[0].as_py(), *[None] * 7, 0, 0, []]
            return pa.table([pa.array([x], f.type) for x, f in zip(row, _STATE)], schema=_STATE)
        group = group.sort_by("chunk")
        v, w, n, rest = [], [], [], []
        for payload in group.column("payload").to_pylist():
            context, runs, here, index, few, docs, many = unpack(payload, np.uint8, np.uint32, np.uint8, _index_kind(payload), np.uint8, np.uint16, np.int64)
            v.append(np.repeat(_from_sorted_bytes(context), runs))
            w.append(_from_sorted_bytes(here)[index])
            count = few.astype(np.int64)
            count[few == 0] = many
            n.append(count)
            rest.append((few, docs))
        sizes = [len(x) for x in v]
        known_v, iv = np.unique(np.concatenate(v), return_inverse=True)
        known_w, iw = np.unique(np.concatenate(w), return_inverse=True)
        del v, w
        types, place = np.unique(iv * len(known_w) + iw, return_inverse=True)
        del iv, iw
        c = np.bincount(place, np.concatenate(n)).astype(np.int64)
        of, word = types // len(known_w), types % len(known_w)
        contexts = np.bincount(of).astype(np.int64)
        refs = []
        for chunk, at, (few, docs) in zip(group.column("chunk").to_pylist(), np.split(place, np.cumsum(sizes)[:-1]), rest):
            refs.append(pack(np.array([chunk]), _sorted_bytes(at), few, docs))
        at = np.minimum(np.searchsorted(hot, known_v), max(0, len(hot) - 1)) if len(hot) else np.zeros(len(known_v), np.int64)
        is_hot = np.flatnonzero(hot[at] == known_v) if len(hot) else np.zeros(0, np.int64)
        ends = np.cumsum(contexts)
        sums = np.r_[0, np.cumsum(c)]
        hot_rows = [{"hot": int(at[k]), "c": int(sums[ends[k]] - sums[ends[k] - contexts[k]]), "t": int(contexts[k])} for k in is_hot]
        row = [part, None, _sorted_bytes(known_w).tobytes(), contexts.astype(np.uint32).tobytes(), pack(word.astype(np.uint32), c), pack(is_hot, at[is_hot].astype(np.int64)), pack(np.array([len(r) for r in refs]), np.frombuffer(b"".join(refs), np.uint8)), np.bincount(word, minlength=len(known_w)).tobytes(), None, int((c == 1).sum()), int((c == 2).sum()), hot_rows]
        return pa.table([pa.array([x], f.type) for x, f in zip(row, _STATE)], schema=_STATE)

    return run


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Of positive numbers, by Stirling's series after a shift."""
    x = np.asarray(x, np.float64)
    shift = np.zeros_like(x)
    for k in range(8):
        shift += np.log(x + k)
    y = x + 8
    return (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - shift


def log_stirling(discount: float, most: int = _EXACT) -> np.ndarray:
    """Logarithms of generalised Stirling numbers: at [c, t - 1] the total weight of seatings of c customers at t tables."""
    s = np.full((most + 1, most), -np.inf)
    s[1, 0] = 0
    for c in range(1, most):
        t = np.arange(1, most + 1)
        stay = np.log(np.maximum(c - discount * t, 1e-300)) + s[c]
        s[c + 1] = np.logaddexp(stay, np.r_[-np.inf, s[c, :-1]])
        s[c + 1, c + 1 :] = -np.inf
    return s


def few_tables(c: np.ndarray, discount: float, most: int) -> np.ndarray:
    """``log_stirling`` of any numbers of customers, less log_gamma(c), for up to ``most`` tables, by the alternating sum over Gamma(c - j d) / Gamma(-j d). It is exact to rounding where tables are much fewer than customers."""
    j = np.arange(1, most + 1)
    sign = np.array([0.0 if float(k * discount).is_integer() else (-1.0) ** (k + math.floor(k * discount) + 1) for k in j])
    size = np.array([0.0 if s == 0 else -math.lgamma(-k * discount) for k, s in zip(j, sign)])
    terms = sign * np.exp(log_gamma(c[:, None] - j * discount) - log_gamma(c)[:, None] + size)
    choose = np.array([[math.comb(t, k) for k in j] for t in j], np.float64)
    with np.errstate(divide="ignore"):
        return np.log(np.maximum(terms @ choose.T, 0)) - j * math.log(discount) - np.array([math.lgamma(t + 1) for t in j])


def sample_tables(c: np.ndarray, others: np.ndarray, p: np.ndarray, strength: float, discount: float, stirling: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Numbers of tables of one dish in many restaurants, given the customers ``c``, the ``others``' tables there, and the dish's probability ``p`` in the parent.

    The weight of t tables is S(c, t) * prod_{i < t} (strength + discount * (others + i)) * p**t.
    The draw is from these weights for up to 256 customers, and for any number where less than
    12 tables are expected. Beyond, it is from the normal distribution at their saddle point,
    where a table's weight equals that of a new table in a process with c customers and as many
    expected tables.
    """
    t = np.minimum(c, 1)
    low = 1
    for high in (4, 16, 64, _EXACT):
        every = np.flatnonzero((c > low) & (c <= high))
        low = high
        for k in range(0, len(every), (1 << 20) // high):
            at = every[k : k + (1 << 20) // high]
            i = np.arange(high)
            w = stirling[c[at], :high] + np.cumsum(np.log(strength + discount * (others[at, None] + i)), 1) + (i + 1) * np.log(p[at, None])
            w = np.cumsum(np.exp(w - w.max(1, keepdims=True)), 1)
            t[at] = (w < rng.random((len(at), 1)) * w[:, -1:]).sum(1) + 1
    at = np.flatnonzero(c > _EXACT)
    if len(at):
        n, q = c[at].astype(np.float64), np.minimum(p[at], 1 - 1e-9)
        top = (strength + discount * others[at]) * q
        lo, hi = np.full(len(at), -discount + 1e-9), top.copy()

        def tables(a: np.ndarray) -> np.ndarray:
            return np.exp(log_gamma(a + n + discount) + log_gamma(a + 1) - log_gamma(a + n) - log_gamma(a + discount)) / discount - a / discount

        for _ in range(40):
            a = (lo + hi) / 2
            over = tables(a) > (top - a) / (discount * (1 - q))
            hi, lo = np.where(over, a, hi), np.where(over, lo, a)
        a = (lo + hi) / 2
        mean = np.clip(tables(a), 1, n)
        step = 1e-4 * np.maximum(np.abs(a), 1)
        slope = np.maximum((tables(a + step) - mean) / step, 1e-12)
        curve = (1 / slope + discount) / np.maximum(a + discount * mean, 1e-9) - discount / (strength + discount * (others[at] + mean))
        normal = mean + rng.standard_normal(len(at)) / np.sqrt(np.maximum(curve, 1e-12))
        t[at] = np.clip(np.rint(normal), 1, n).astype(t.dtype)
        few = at[mean < 12]
        for k in range(0, len(few), 1 << 14):
            x = few[k : k + (1 << 14)]
            i = np.arange(_FEW)
            w = few_tables(c[x].astype(np.float64), discount, _FEW) + np.cumsum(np.log(strength + discount * (others[x, None] + i)), 1) + (i + 1) * np.log(p[x, None])
            w = np.cumsum(np.exp(w - w.max(1, keepdims=True)), 1)
            t[x] = (w < rng.random((len(x), 1)) * w[:, -1:]).sum(1) + 1
    return t


class Restaurants:
    """Those of one part: ``sizes`` dishes each, one after the other, with their ``word`` and customers ``c``; ``extra_c`` and ``extra_t`` are customers and tables of the same restaurants in other parts."""

    def __init__(self, sizes: np.ndarray, word: np.ndarray, c: np.ndarray, t: np.ndarray, extra_c: np.ndarray, extra_t: np.ndarray, strength: float, discount: float):
        self.word, self.c, self.t, self.strength, self.discount = word, c, t, strength, discount
        self.of = np.repeat(np.arange(len(sizes)), sizes)
        place = np.arange(len(c)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        some = np.flatnonzero(c > 1)
        self.blocks = [some[place[some] % BLOCKS == b] for b in range(BLOCKS)]
        self.extra_t = extra_t
        self.customers = np.bincount(self.of, c, len(sizes)) + extra_c
        self.tables = np.bincount(self.of, t, len(sizes)).astype(np.int64) + extra_t

    def sweep(self, p: np.ndarray, stirling: np.ndarray, rng: np.random.Generator) -> None:
        """Draws the tables of every dish, block by block. ``p``: probabilities of the words in the root."""
        for at in self.blocks:
            if len(at):
                new = sample_tables(self.c[at], self.tables[self.of[at]] - self.t[at], p[self.word[at]], self.strength, self.discount, stirling, rng)
                np.add.at(self.tables, self.of[at], new - self.t[at])
                self.t[at] = new

    def predictive(self, p: np.ndarray) -> np.ndarray:
        """The probability of each dish."""
        return (self.c - self.discount * self.t + (self.strength + self.discount * self.tables[self.of]) * p[self.word]) / (self.strength + self.customers[self.of])

    def auxiliary(self, rng: np.random.Generator) -> tuple[float, float]:
        """Of restaurants that are whole here, what the strength's posterior depends on: the sum of Bernoulli draws for tables, and of logarithms of Beta draws."""
        at = np.flatnonzero((self.customers > 1) & (self.extra_t == 0))
        x = rng.beta(self.strength + 1, self.customers[at] - 1) if len(at) else np.ones(0)
        n = self.tables[at] - 1
        i = _places(np.ones(len(n), np.int64), n)
        y = rng.random(len(i)) < self.strength / (self.strength + self.discount * i)
        return float(y.sum()), float(np.log(np.maximum(x, 1e-300)).sum())


def _discount(n1: float, n2: float) -> float:
    """Kneser and Ney's estimate from the numbers of counts of one and two."""
    return min(0.95, max(0.05, n1 / max(1.0, n1 + 2.0 * n2)))


def _root_messages(ranges: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for part, known, sums, seated in zip(*(batch.column(x).to_pylist() for x in ("part", "words", "sums", "seated"))):
                known, sums, seated = _from_sorted_bytes(np.frombuffer(known, np.uint8)), np.frombuffer(sums, np.int64), np.frombuffer(seated or b"", np.uint32)
                edges = np.searchsorted(_part_of(known, ranges), np.arange(ranges + 1))
                for r in np.flatnonzero(np.diff(edges)).tolist():
                    own = slice(edges[r], edges[r + 1])
                    rows.append((r, part, pack(_sorted_bytes(known[own]), sums[own].astype(np.uint32), seated[own])))
            for at in range(0, len(rows), 512):
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows[at : at + 512]), _MESSAGE)], ["range", "part", "payload"])

    return run


_REPLY_SQL = "part long, range long, payload binary, n_words long, customers long, tables long, n1 long, n2 long"
_REPLY = pa.schema([("part", pa.int64()), ("range", pa.int64()), ("payload", pa.binary()), *[(x, pa.int64()) for x in ("n_words", "customers", "tables", "n1", "n2")]])


def _root(number: int, totals: dict | None, strength: float, discount: float | None, seed: int):
    """The root's dishes of one range: customers are the sums of the parts' tables. The first time each dish has one table; later tables are drawn given those before."""

    def run(group: pa.Table) -> pa.Table:
        release()
        r = group.column("range")[0].as_py()
        group = group.sort_by("part")
        known, sums, seated = zip(*(unpack(x, np.uint8, np.uint32, np.uint32) for x in group.column("payload").to_pylist()))
        known = [_from_sorted_bytes(k) for k in known]
        words_, place = np.unique(np.concatenate(known), return_inverse=True)
        c = np.bincount(place, np.concatenate(sums)).astype(np.int64)
        if totals is None:
            t = np.ones(len(c), np.int64)
        else:
            rng = np.random.default_rng([seed, number, 1, r])
            own = np.empty(len(c), np.int64)
            own[place] = np.concatenate(seated)
            t = sample_tables(c, totals["tables"] - own, np.full(len(c), 1 / totals["n_words"]), strength, discount, log_stirling(discount), rng)
        out = [(p, r, pack(c[x].astype(np.uint32), t[x].astype(np.uint32)), 0, 0, 0, 0, 0) for p, x in zip(group.column("part").to_pylist(), np.split(place, np.cumsum([len(k) for k in known])[:-1]))]
        out.append((-1, r, b"", len(c), int(c.sum()), int(t.sum()), int((c == 1).sum()), int((c == 2).sum())))
        return pa.table([pa.array(x, f.type) for x, f in zip(zip(*out), _REPLY)], schema=_REPLY)

    return run


_ROUND_SQL = "part long, words binary, tables binary, sums binary, seated binary, y double, x double, hot_rows array<struct<hot:long,c:long,t:long>>"
_ROUND = pa.schema([("part", pa.int64()), ("words", pa.binary()), ("tables", pa.binary()), ("sums", pa.binary()), ("seated", pa.binary()), ("y", pa.float64()), ("x", pa.float64()), ("hot_rows", _STATE.field("hot_rows").type)])
_SCORES_SQL = "chunk long, part long, payload binary"
_SCORES = pa.schema([("chunk", pa.int64()), ("part", pa.int64()), ("payload", pa.binary())])


def _part(number: int, sweeps: int, samples: int, model: dict, seed: int):
    """Sweeps over a part's restaurants. Without ``samples`` the tables are returned; with them, so many of the last sweeps are averaged and the documents scored."""

    def run(state: pa.Table, news: pa.Table) -> pa.Table:
        release()
        empty = (_SCORES if samples else _ROUND).empty_table()
        if not state.num_rows:
            return empty
        row = {c: state.column(c)[0].as_py() for c in state.column_names}
        part = row["part"]
        if part < 0:
            return pa.table([pa.array([x], f.type) for x, f in zip([-1 - part, -1, row["header"]], _SCORES)], schema=_SCORES) if samples else empty
        news = news.sort_by("range")
        c0, t0, t = [], [], None
        for r, payload in zip(news.column("range").to_pylist(), news.column("payload").to_pylist()):
            if r < 0:
                t = np.frombuffer(payload, np.uint32).astype(np.int64)
            else:
                c, tables = unpack(payload, np.uint32, np.uint32)
                c0.append(c), t0.append(tables)
        root = model["root"]
        p = (np.concatenate(c0) - root["discount"] * np.concatenate(t0) + (root["strength"] + root["discount"] * root["tables"]) / root["n_words"]) / (root["strength"] + root["customers"])
        sizes = np.frombuffer(row["contexts"], np.uint32).astype(np.int64)
        word, c = unpack(row["types"], np.uint32, np.int64)
        word = word.astype(np.int64)
        t = np.minimum(c, 1) if t is None else t
        own, which = unpack(row["hot"], np.int64, np.int64)
        extra_c, extra_t = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
        if len(own):
            all_c, all_t = (np.array([model["hot"][k][x] for k in which.tolist()]) for x in (0, 1))
            of = np.repeat(np.arange(len(sizes)), sizes)
            extra_c[own] = all_c - np.bincount(of, c, len(sizes))[own].astype(np.int64)
            extra_t[own] = all_t - np.bincount(of, t, len(sizes))[own].astype(np.int64)
        seats = Restaurants(sizes, word, c, t, extra_c, extra_t, model["strength"], model["discount"])
        stirling = log_stirling(model["discount"])
        rng = np.random.default_rng([seed, number, 0, part])
        mean = np.zeros(len(c)) if samples else None
        for s in range(sweeps):
            seats.sweep(p, stirling, rng)
            if samples and s >= sweeps - samples:
                mean += seats.predictive(p) / samples
        if samples:
            logs = -np.log2(mean)
            lengths, refs = unpack(row["refs"], np.int64, np.uint8)
            ends = np.cumsum(lengths)
            out = []
            for a, b in zip((ends - lengths).tolist(), ends.tolist()):
                chunk, at, few, docs = unpack(refs[a:b].tobytes(), np.int64, np.uint8, np.uint8, np.uint16)
                bits = logs[_from_sorted_bytes(at).astype(np.int64)]
                sums = np.bincount(docs, np.repeat(bits, few)) if len(docs) else np.zeros(0)
                some = np.flatnonzero(sums)
                out.append((int(chunk[0]), part, pack(some.astype(np.uint16), sums[some].astype(np.float32), bits[few == 0])))
            return pa.table([pa.array(x, f.type) for x, f in zip(zip(*out), _SCORES)], schema=_SCORES)
        y, x = seats.auxiliary(rng)
        tables = np.bincount(seats.of, seats.t, len(sizes)).astype(np.int64)
        hot_rows = [{"hot": int(k), "c": 0, "t": int(tables[o])} for o, k in zip(own, which)]
        new = [part, row["words"], seats.t.astype(np.uint32).tobytes(), np.bincount(word, seats.t, len(p)).astype(np.int64).tobytes(), np.concatenate(t0).tobytes(), y, x, hot_rows]
        return pa.table([pa.array([x], f.type) for x, f in zip(new, _ROUND)], schema=_ROUND)

    return run


_OUT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("bits", pa.float64()), ("perplexity", pa.float64())])
_OUT_SQL = "doc_id long, n_words long, bits double, perplexity double"


def _documents(group: pa.Table) -> pa.Table:
    """One chunk's documents with the sums of all parts."""
    release()
    group = group.sort_by("part")
    payload = group.column("payload").to_pylist()
    ids, missing, n, common_n, common_docs = unpack(payload[0], np.int64, np.uint8, np.int64, np.int64, np.uint16)
    bits = np.zeros(len(ids))
    common = []
    for x in payload[1:]:
        docs, sums, many = unpack(x, np.uint16, np.float32, np.float64)
        bits[docs] += sums
        common.append(many)
    if len(common_docs):
        bits += np.bincount(common_docs, np.repeat(np.concatenate(common), common_n), len(ids))
    perplexity = np.exp2(np.minimum(bits / np.maximum(n, 1), 1000))
    return pa.table([pa.array(ids, mask=missing.astype(bool)), pa.array(n), pa.array(np.round(bits, 1) + 0.0), pa.array(np.round(perplexity, 2), mask=n == 0)], schema=_OUT)


def frequent_contexts(texts: DataFrame, parts: int, fraction: float) -> tuple[np.ndarray, np.ndarray]:
    """Words with more than a quarter of a part's share of the text, and into how many pieces they are to be spread: at most 4 * parts words and 8 * parts pieces. Estimated from a sample of documents, as just the layout depends on it."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                data, offsets = buffers(pc.utf8_lower(part.column("text")))
                start, end, _ = pieces(data, offsets)
                begun = np.full(int((np.diff(offsets) > 0).sum()), _BEGIN)
                h, n = np.unique(np.concatenate([word_hashes(data, start, end), begun]), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n)], ["word", "n"])

    counted = cut(texts.select("text").sample(fraction=fraction, seed=1).mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")))
    total = counted.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    rows = counted.where(F.col("n") * 4 * parts > total).collect()
    drop_cut(counted)
    rows = sorted((r["word"] % (1 << 64), -(-r["n"] * 4 * parts // total)) for r in rows)
    return np.array([w for w, _ in rows], np.uint64), np.array([n for _, n in rows], np.uint64)


def perplexities(docs: DataFrame, *, rounds: int = 3, sweeps: int = 3, samples: int = 2, strength: float | None = None, discount: float | None = None, root_strength: float = 1.0, root_discount: float | None = None, chunk_bytes: int = 24 << 20, hot_sample: float = 0.0625, seed: int = 11) -> DataFrame:
    """(doc_id, n_words, bits, perplexity) for each row of ``docs``, under the model of all of them.

    Words are runs of letters, digits and characters beyond ASCII of the lower-cased text;
    characters from U+3000 on are words by themselves. ``bits`` is the sum over the text's
    words of minus the logarithm (base 2) of the averaged predictive probability given the word
    before, rounded to 1 digit; perplexity is 2 to the power of bits per word, rounded to 2.

    There are ``rounds`` of ``sweeps``, and the root's tables are drawn before each but the
    first; the last ``samples`` sweeps are averaged. Discounts that aren't given are estimated
    from the numbers of counts of one and two. A ``strength`` that isn't given begins at 1 and
    is drawn from its posterior after each round, with a prior of Gamma(1, 1). ``chunk_bytes``
    and ``hot_sample``, the share of documents that frequent contexts are estimated from, are
    for the layout only.

    Null and empty texts, and texts without a word, have 0 words, 0 bits and no perplexity
    (null); a null doc_id stays null; repeated rows count and are scored each; long texts are
    read whole; an empty table gives an empty result; other columns are ignored.
    """
    spark = docs.sparkSession
    ranges = partitions(docs)
    parts = 2 * ranges
    texts = docs.select(docs["doc_id"].cast("long").alias("id"), text_or_empty(docs["text"]).alias("text"))
    hot, pieces_of_hot = frequent_contexts(texts, parts, hot_sample)
    sent = texts.mapInArrow(_messages(parts, hot, pieces_of_hot, chunk_bytes), _MESSAGE_SQL)
    name = f"linkloom_seats_{uuid.uuid4().hex}"
    path = f"{ensure_checkpoint_dir(spark)}/table-{name}"
    merged = sent.repartition(parts, "part").groupBy("part").applyInArrow(_merge(hot), _STATE_SQL)
    merged.write.format("parquet").option("path", path).option("compression", "zstd").bucketBy(parts, "part").saveAsTable(name)
    state = spark.table(name)
    found = state.where("part >= 0")
    n = found.agg(F.sum("n1").alias("n1"), F.sum("n2").alias("n2")).first()
    model: dict = {"strength": 1.0 if strength is None else strength, "discount": _discount(n["n1"] or 0, n["n2"] or 0) if discount is None else discount}
    latest, totals, tables, old = found, None, None, []
    customers: dict[int, int] = {}
    for r in range(rounds):
        before = model.get("root", {})
        news = cut(latest.select("part", "words", "sums", "seated").mapInArrow(_root_messages(ranges), "range long, part long, payload binary").groupBy("range").applyInArrow(_root(r, totals, root_strength, before.get("discount"), seed), _REPLY_SQL))
        totals = news.where("part < 0").agg(*[F.coalesce(F.sum(x), F.lit(0)).alias(x) for x in ("n_words", "customers", "tables", "n1", "n2")]).first().asDict()
        model["root"] = {**totals, "strength": root_strength, "discount": root_discount if root_discount is not None else before.get("discount", _discount(totals["n1"], totals["n2"]))}
        hot_rows = latest.select(F.explode("hot_rows").alias("h")).groupBy("h.hot").agg(F.sum("h.c").alias("c"), F.sum("h.t").alias("t")).collect()
        customers = customers or {x["hot"]: x["c"] for x in hot_rows}
        model["hot"] = {x["hot"]: (customers[x["hot"]], x["t"]) for x in hot_rows}
        told = news.where("part >= 0").select("part", "range", "payload")
        if tables is not None:
            told = told.unionByName(tables.select("part", F.lit(-1).cast("long").alias("range"), F.col("tables").alias("payload")))
        last = r == rounds - 1
        columns = ["part", "words", "contexts", "types", "hot", *(["header", "refs"] if last else [])]
        seated = (state if last else found).select(*columns).groupBy("part").cogroup(told.groupBy("part")).applyInArrow(_part(r, sweeps, min(samples, sweeps) if last else 0, dict(model), seed), _SCORES_SQL if last else _ROUND_SQL)
        old += [news]
        if last:
            out = cut(seated.groupBy("chunk").applyInArrow(_documents, _OUT_SQL))
            break
        tables = latest = cut(seated)
        old += [tables]
        if strength is None:
            a = tables.agg(F.coalesce(F.sum("y"), F.lit(0.0)).alias("y"), F.coalesce(F.sum("x"), F.lit(0.0)).alias("x")).first()
            model["strength"] = max(1e-3, float(np.random.default_rng([seed, r]).gamma(1 + a["y"]) / (1 - a["x"])))
    for x in old:
        drop_cut(x)
    spark.sql(f"DROP TABLE {name}")
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
    return out
