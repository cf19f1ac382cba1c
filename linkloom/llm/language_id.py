"""Language identification by a bidirectional gated recurrent network over bytes.

A text's UTF-8 bytes are cut into windows that cover all of it. In each window one network reads
forwards and one backwards; at every byte both states give the probabilities of the languages.
A document's probabilities are the means over its bytes. The network is trained here, in numpy,
by backpropagation through time.

Arrays have a row for each unit and a column for each window, so a step is a few operations on
contiguous blocks for thousands of windows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linkloom.llm.common import buffers, slices, text_or_empty

_WINDOWS_AT_ONCE = 2048


@dataclass
class Direction:
    """One direction's weights. ``gates`` gives update and reset from (embedded byte, 1, state); ``new`` gives the candidate from (reset state, embedded byte, 1); ``out`` the languages' scores."""

    gates: np.ndarray
    new: np.ndarray
    out: np.ndarray


@dataclass
class Network:
    embedding: np.ndarray
    directions: list[Direction]
    bias: np.ndarray
    languages: list[str]

    def parameters(self) -> list[np.ndarray]:
        return [self.embedding, self.bias, *(w for d in self.directions for w in (d.gates, d.new, d.out))]


def initial(languages: list[str], hidden: int, embedded: int, seed: int, kind: type = np.float32) -> Network:
    rng = np.random.default_rng(seed)

    def some(rows: int, columns: int) -> np.ndarray:
        return (rng.standard_normal((rows, columns)) / np.sqrt(columns)).astype(kind)

    directions = [Direction(some(2 * hidden, embedded + 1 + hidden), some(hidden, hidden + embedded + 1), some(len(languages), hidden)) for _ in range(2)]
    return Network(some(embedded, 256), directions, np.zeros((len(languages), 1), kind), languages)


def _pass(net: Network, d: Direction, windows: np.ndarray, valid: np.ndarray | None, steps: range, scores: np.ndarray, keep: list | None) -> None:
    """Adds one direction's scores at every byte to ``scores`` (byte, language, window). ``keep`` gets what backpropagation needs."""
    n = windows.shape[1]
    hidden, embedded = d.new.shape[0], net.embedding.shape[0]
    kind = net.embedding.dtype
    # rows: reset state, embedded byte, 1, state; both products read contiguous rows
    held = np.zeros((2 * hidden + embedded + 1, n), kind)
    reset_state, x, state = held[:hidden], held[hidden : hidden + embedded], held[hidden + embedded + 1 :]
    held[hidden + embedded] = 1
    first, second = held[: hidden + embedded + 1], held[hidden:]
    gate, new, score = np.empty((2 * hidden, n), kind), np.empty((hidden, n), kind), np.empty((len(net.bias), n), kind)
    halved = d.gates * kind.type(0.5)
    half = kind.type(0.5)
    for t in steps:
        np.take(net.embedding, windows[t], axis=1, out=x, mode="clip")
        np.matmul(halved, second, out=gate)
        np.tanh(gate, out=gate)
        gate *= half
        gate += half
        np.multiply(gate[hidden:], state, out=reset_state)
        np.matmul(d.new, first, out=new)
        np.tanh(new, out=new)
        if keep is not None:
            keep.append((held.copy(), gate.copy(), new.copy()))
        state -= new
        state *= gate[:hidden]
        state += new
        if valid is not None:
            state *= valid[t]
        np.matmul(d.out, state, out=score)
        scores[t] += score


def position_scores(net: Network, windows: np.ndarray, valid: np.ndarray | None = None, keep: list | None = None) -> np.ndarray:
    """Scores of the languages at every byte, before the softmax. ``windows``: a column for each window; ``valid``: 1 for bytes, 0 after a window's end."""
    length, n = windows.shape
    scores = np.empty((length, len(net.bias), n), net.embedding.dtype)
    scores[:] = net.bias
    for k, steps in enumerate((range(length), range(length - 1, -1, -1))):
        kept = None if keep is None else []
        _pass(net, net.directions[k], windows, valid, steps, scores, kept)
        if keep is not None:
            keep.append(kept)
    return scores


def _softmax(scores: np.ndarray) -> np.ndarray:
    p = scores - scores.max(1, keepdims=True)
    np.exp(p, out=p)
    p /= p.sum(1, keepdims=True)
    return p


def loss_and_gradient(net: Network, windows: np.ndarray, language: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Mean cross-entropy over all bytes of full windows, and its gradient, by backpropagation through time."""
    keep: list = []
    p = _softmax(position_scores(net, windows, None, keep))
    length, n = windows.shape
    loss = float(-np.log(np.maximum(p[:, language, np.arange(n)], 1e-12)).mean())
    p[:, language, np.arange(n)] -= 1
    p /= length * n
    hidden, embedded = net.directions[0].new.shape[0], net.embedding.shape[0]
    d_bias = p.sum((0, 2))[:, None]
    d_x = np.zeros((length, embedded, n), p.dtype)
    grads = []
    for k, d in enumerate(net.directions):
        kept = keep[k]
        order = range(length) if k == 0 else range(length - 1, -1, -1)
        d_gates, d_new, d_out = np.zeros_like(d.gates), np.zeros_like(d.new), np.zeros_like(d.out)
        d_state = np.zeros((hidden, n), p.dtype)
        for s in range(length - 1, -1, -1):
            t = order[s]
            held, gate, new = kept[s]
            before, update, reset = held[hidden + embedded + 1 :], gate[:hidden], gate[hidden:]
            state = new + update * (before - new)
            d_out += p[t] @ state.T
            d_state += d.out.T @ p[t]
            into_new = d_state * (1 - update) * (1 - new * new)
            d_new += into_new @ held[: hidden + embedded + 1].T
            back = d.new.T @ into_new
            into_update = d_state * (before - new) * update * (1 - update)
            into_reset = back[:hidden] * before * reset * (1 - reset)
            into_gates = np.concatenate([into_update, into_reset])
            d_gates += into_gates @ held[hidden:].T
            back_gates = d.gates.T @ into_gates
            d_state = d_state * update + back[:hidden] * reset + back_gates[embedded + 1 :]
            d_x[t] += back[hidden : hidden + embedded] + back_gates[:embedded]
        grads += [d_gates, d_new, d_out]
    flat = windows.reshape(-1)
    d_embedding = np.stack([np.bincount(flat, d_x[:, j].reshape(-1), 256) for j in range(embedded)]).astype(p.dtype)
    return loss, [d_embedding, d_bias.astype(p.dtype), *grads]


def train_network(windows: np.ndarray, language: np.ndarray, languages: list[str], *, hidden: int = 8, embedded: int = 6, steps: int = 220, batch: int = 384, rate: float = 0.02, seed: int = 7) -> Network:
    """Fits a network to windows (a column each) of known language, by Adam on batches drawn evenly from the languages."""
    net = initial(languages, hidden, embedded, seed)
    if not windows.shape[1] or len(languages) < 2:
        return net
    rng = np.random.default_rng(seed)
    by_language = [np.flatnonzero(language == k) for k in range(len(languages))]
    by_language = [x for x in by_language if len(x)]
    first, second = ([np.zeros_like(w) for w in net.parameters()] for _ in range(2))
    for step in range(1, steps + 1):
        which = rng.integers(0, len(by_language), batch)
        chosen = np.array([by_language[k][rng.integers(len(by_language[k]))] for k in which])
        _, gradient = loss_and_gradient(net, np.ascontiguousarray(windows[:, chosen]), language[chosen])
        size = np.sqrt(sum(float((g * g).sum()) for g in gradient))
        now = rate * min(1.0, 4 * (steps - step + 1) / steps)
        for w, g, a, b in zip(net.parameters(), gradient, first, second):
            g = g * min(1.0, 1.0 / max(size, 1e-9))
            a += 0.1 * (g - a)
            b += 0.01 * (g * g - b)
            w -= now * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.99**step)) + 1e-8)
    return net


def cut_windows(offsets: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, text) of consecutive windows that cover every text."""
    sizes = np.diff(offsets)
    per = -(-sizes // window)
    of = np.repeat(np.arange(len(sizes)), per)
    start = (np.arange(len(of)) - np.repeat(np.cumsum(per) - per, per)) * window
    length = np.minimum(window, sizes[of] - start)
    return offsets[of] + start, length, of


def classify(net: Network, texts: pa.Array, window: int) -> tuple[np.ndarray, np.ndarray]:
    """For each text the sum of the languages' probabilities over its bytes, and the number of bytes labelled with each language."""
    data, offsets = buffers(texts)
    start, length, of = cut_windows(offsets, window)
    k = len(net.languages)
    sums, labelled = np.zeros((len(texts), k)), np.zeros((len(texts), k), np.int64)
    full = np.flatnonzero(length == window)
    short = np.flatnonzero(length < window)
    short = short[np.argsort(length[short], kind="stable")]
    for group, whole in ((full, True), (short, False)):
        for at in range(0, len(group), _WINDOWS_AT_ONCE):
            w = group[at : at + _WINDOWS_AT_ONCE]
            size = window if whole else int(length[w].max())
            place = start[w] + np.arange(size)[:, None]
            valid = None
            if whole:
                windows = data[place]
            else:
                inside = np.arange(size)[:, None] < length[w]
                windows = np.where(inside, data[np.minimum(place, len(data) - 1)], 0)
                valid = inside.astype(net.embedding.dtype)
            scores = position_scores(net, windows, valid)
            label = scores.argmax(1)
            p = _softmax(scores)
            if valid is not None:
                p *= valid[:, None]
                label[~inside] = k
            pooled = p.sum(0, dtype=np.float64)
            for j in range(k):
                sums[:, j] += np.bincount(of[w], pooled[j], len(texts))
                labelled[:, j] += np.bincount(of[w], (label == j).sum(0), len(texts)).astype(np.int64)
    return sums, labelled


def training_windows(docs: DataFrame, *, max_train_docs: int, per_doc: int, window: int) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Windows spread evenly over each sampled document, their languages, and the names. Each language has an equal share of the sample, if it has so many documents; a shorter text is repeated to fill a window."""
    known = docs.select(docs["doc_id"].cast("long").alias("id"), docs["lang"].cast("string").alias("lang"), docs["text"].cast("string").alias("text")).where("id is not null and lang is not null and text <> ''")
    counts = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}
    per = max(1, max_train_docs // max(1, len(counts)))
    # a share by hash that holds enough documents of a language but for bad luck, so that few are ordered
    shares = known.sparkSession.createDataFrame([(x, min(1 << 30, -(-(1 << 30) * (3 * per + 100) // n))) for x, n in counts.items()], "lang string, share long")
    some = known.select("lang", "id").join(F.broadcast(shares), "lang").where(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < F.col("share")).select("lang", "id").distinct()
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("id"), "id"))
    chosen = some.withColumn("place", place).where(F.col("place") <= per).select("lang", "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: tuple[list, list, list] = ([], [], [])
            for i, lang, text in zip(*(c.to_pylist() for c in batch.columns)):
                b = text.encode()
                b = b if len(b) >= window else b * (window // len(b) + 1)
                last = len(b) - window if len(text.encode()) >= window else 0
                for at in sorted({round(j * last / max(1, per_doc - 1)) for j in range(per_doc)}):
                    for column, v in zip(rows, (i, lang, b[at : at + window])):
                        column.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(rows[0], pa.int64()), pa.array(rows[1], pa.string()), pa.array(rows[2], pa.binary())], ["id", "lang", "bytes"])

    table = known.join(F.broadcast(chosen), ["lang", "id"]).select("id", "lang", "text").mapInArrow(run, "id long, lang string, bytes binary").toArrow()
    rows = sorted(zip(*(c.to_pylist() for c in table.columns)))
    languages = sorted({r[1] for r in rows})
    number = {x: k for k, x in enumerate(languages)}
    windows = np.frombuffer(b"".join(r[2] for r in rows), np.uint8).reshape(-1, window).T if rows else np.zeros((window, 0), np.uint8)
    return np.ascontiguousarray(windows), np.array([number[r[1]] for r in rows], np.int64), languages


def language_ids(docs: DataFrame, *, window: int = 96, train_window: int = 48, max_train_docs: int = 1500, per_doc: int = 6, **options) -> DataFrame:
    """(doc_id, lang, probability, n_bytes, labelled_bytes) for each row of ``docs``.

    ``lang`` has the greatest mean probability over the bytes, rounded to 4 digits in
    ``probability`` (of ties, the first by name); ``labelled_bytes`` maps each language to the
    number of bytes labelled with it. States begin anew every ``window`` bytes. The network is
    fitted to at most ``per_doc`` windows of ``train_window`` bytes, spread over the text, of
    each of at most ``max_train_docs`` documents with a language: equally many of each language,
    where it has so many, those with the smallest hash of doc_id.

    Null and empty texts have no language (null, probability 0); when no document has one, no
    row has. Long texts are labelled whole; repeated rows each; a null doc_id stays null; an
    empty table gives an empty result; other columns are ignored.
    """
    windows, language, languages = training_windows(docs, max_train_docs=max_train_docs, per_doc=per_doc, window=train_window)
    net = train_network(windows, language, languages, **options) if languages else None
    schema = "doc_id long, lang string, probability double, n_bytes long, labelled_bytes map<string,long>"
    fields = pa.schema([("doc_id", pa.int64()), ("lang", pa.string()), ("probability", pa.float64()), ("n_bytes", pa.int64()), ("labelled_bytes", pa.map_(pa.string(), pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                size = np.diff(buffers(part.column("text"))[1])
                n = part.num_rows
                if net is None:
                    sums, labelled = np.zeros((n, 0)), np.zeros((n, 0), np.int64)
                else:
                    sums, labelled = classify(net, part.column("text"), window)
                has = (size > 0) & (net is not None)
                mean = np.round(sums / np.maximum(size, 1)[:, None], 4)
                best = mean.argmax(1) if net is not None else np.zeros(n, np.int64)
                names = pa.array([languages[b] if h else None for b, h in zip(best.tolist(), has.tolist())], pa.string())
                probability = np.where(has, mean[np.arange(n), best] if net is not None else 0.0, 0.0)
                counts = pa.MapArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * len(languages)), pa.array(languages * n, pa.string()), pa.array(labelled.reshape(-1)))
                yield pa.RecordBatch.from_arrays([part.column("id"), names, pa.array(probability), pa.array(size), counts], schema=fields)

    return docs.select(docs["doc_id"].cast("long").alias("id"), text_or_empty(docs["text"]).alias("text")).mapInArrow(run, schema)
