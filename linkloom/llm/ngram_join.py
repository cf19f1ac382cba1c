"""Exact Jaccard self-join of documents on word n-grams, with adaptive multi-match prefixes.

Every document is a set of hashed n-grams, ordered by document frequency, rare first. If two
sets reach the threshold t, then for every level l their prefixes of |x| - ceil(t |x|) + l
grams share l grams. Each document picks its own level: longer prefixes cost more joined rows,
but ask for more shared grams before a pair is verified. A pair is judged at the lower of its
two levels.

No row is made per gram of the corpus. Grams travel in sorted binary messages from chunks of
documents to ranges of the hash space, where frequencies are counted over all documents, and
back. Grams that occur in one document only come first in its order and can match nothing, so
they are counted but not carried further; most documents end there.

Documents with equal sets are one record with their number, and the result has a row for each
document, with its class and its number of links, so that large groups of copies cost no more
than their members.

Near copies of one text would meet in the list of nearly every gram of it, all pairs each time.
Documents that share much of their prefixes with the same hub have a home together: they are
compared with each other by products of matrices, and lists only bring pairs of different homes.
Homes are a matter of cost; any would give the same result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.llm.common import SLICE_BYTES, buffers, cut, drop_cut, gram_hashes, mix, partitions, release, slices, word_hashes, words
from linkloom.llm.links import classes, in_blocks, linked, linked_at_home, pairs_of_lists

_LOCAL = np.uint64(16)
_MASK = np.uint64(0xFFFF)
_CHUNK_DOCS = 1 << 16

_MESSAGE = pa.schema([("part", pa.int64()), ("chunk", pa.int64()), ("width", pa.int32()), ("payload", pa.binary()), ("frequency", pa.binary())])
_MESSAGE_SQL = "part long, chunk long, width int, payload binary, frequency binary"
_SETS = pa.schema([("id", pa.int64()), ("key1", pa.int64()), ("key2", pa.int64()), ("size", pa.int64()), ("level", pa.int64()), ("n_shared", pa.int64()), ("prefix", pa.list_(pa.int64())), ("shared", pa.binary())])
_SETS_SQL = "id long, key1 long, key2 long, size long, level long, n_shared long, prefix array<long>, shared binary"


def _squeeze(a: np.ndarray) -> tuple[int, bytes]:
    """A sorted array as differences of as few bytes each as all of them need."""
    d = np.diff(a, prepend=np.uint64(0))
    top = int(d[1:].max()) if len(d) > 1 else 0
    width = max(1, (top.bit_length() + 7) // 8)
    first = d[:1].tobytes()
    return width, first + d[1:].view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def _expand(width: int, payload: bytes) -> np.ndarray:
    first = np.frombuffer(payload[:8], np.uint64)
    rest = np.frombuffer(payload, np.uint8, offset=8).reshape(-1, width)
    d = np.zeros((len(rest) + 1, 8), np.uint8)
    d[1:, :width] = rest
    d = d.reshape(-1).view(np.uint64)
    d[0] = first[0]
    return np.cumsum(d, dtype=np.uint64)


def _six_bytes(grams: np.ndarray) -> bytes:
    """48-bit numbers without their two empty bytes."""
    return np.ascontiguousarray(grams.astype(np.uint64)).view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _from_six_bytes(payload: bytes) -> np.ndarray:
    a = np.frombuffer(payload, np.uint8).reshape(-1, 6)
    wide = np.zeros((len(a), 8), np.uint8)
    wide[:, :6] = a
    return wide.reshape(-1).view(np.uint64)


def document_grams(texts: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct 48-bit gram hashes of each text, as (gram << 16 | text) sorted by text; the second array is each text's number of grams. At most 65,536 texts."""
    data, offsets = buffers(texts)
    start, end, of = words(data, offsets)
    g, text = gram_hashes(word_hashes(data, start, end), of, n)
    by_text = np.sort((text.astype(np.uint64) << np.uint64(48)) | (g >> _LOCAL))
    if len(by_text):
        by_text = by_text[np.r_[True, by_text[1:] != by_text[:-1]]]
    counts = np.bincount((by_text >> np.uint64(48)).astype(np.int64), minlength=len(texts))
    return ((by_text & np.uint64((1 << 48) - 1)) << _LOCAL) | (by_text >> np.uint64(48)), counts


def _messages(parts: int, n: int, chunk_bytes: int):
    """Chunks of documents as one header, and one message for each range of the hash space."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 32
        number = 0
        grams: list[np.ndarray] = []
        heads: list[np.ndarray] = []
        docs = held = 0

        def flush() -> pa.RecordBatch:
            nonlocal number, docs, held
            chunk = first + number
            every = np.sort(np.concatenate(grams))
            bounds = [(p << 64) // parts for p in range(1, parts)]
            at = [0, *np.searchsorted(every, np.array(bounds, np.uint64)).tolist(), len(every)] if bounds else [0, len(every)]
            rows: list[tuple] = [(-1 - chunk, chunk, 0, np.concatenate(heads).tobytes(), b"")]
            for p in range(parts):
                if at[p + 1] > at[p]:
                    rows.append((p, chunk, *_squeeze(every[at[p] : at[p + 1]]), b""))
            grams.clear()
            heads.clear()
            docs = held = 0
            number += 1
            release()
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _MESSAGE)], schema=_MESSAGE)

        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                if docs and (docs + part.num_rows > _CHUNK_DOCS or held >= chunk_bytes):
                    yield flush()
                low = pc.utf8_lower(part.column("text"))
                g, counts = document_grams(low, n)
                every_doc = np.cumsum(counts)
                starts = every_doc - counts
                bare = g >> _LOCAL
                key1, key2 = np.zeros(len(counts), np.uint64), np.zeros(len(counts), np.uint64)
                if len(g):
                    a, b = mix(bare), mix(bare ^ np.uint64(0xA5A5A5A5A5A5A5A5))
                    some = counts > 0
                    key1[some] = np.add.reduceat(a, starts[some])
                    key2[some] = np.add.reduceat(b, starts[some])
                grams.append(g + np.uint64(docs))
                heads.append(np.stack([part.column("id").to_numpy().astype(np.uint64), key1, key2, counts.astype(np.uint64)], axis=1))
                docs += part.num_rows
                held += part.column("text").nbytes
        if docs:
            yield flush()
        release()

    return run


def to_rarity(frequency: np.ndarray) -> np.ndarray:
    """Frequencies in steps of a twelfth of a doubling, as bytes: enough to order grams by, the same for all documents that hold one."""
    return np.minimum(np.rint(12 * np.log2(frequency)), 255).astype(np.uint8)


def from_rarity(code: np.ndarray) -> np.ndarray:
    return 2 ** (code / 12)


def _frequencies(group: pa.Table) -> pa.Table:
    """For one range of the hash space: back to each chunk, the grams that occur in several documents, with their frequencies."""
    if group.column("part")[0].as_py() < 0:
        return group
    release()
    found = [_expand(w, p) for w, p in zip(group.column("width").to_pylist(), group.column("payload").to_pylist())]
    every = np.sort(np.concatenate([a >> _LOCAL for a in found]))
    edges = np.flatnonzero(np.r_[True, every[1:] != every[:-1]])
    counts = np.diff(np.r_[edges, len(every)])
    several = counts > 1
    grams, rarity = every[edges[several]], to_rarity(counts[several])
    out: list[tuple] = []
    for chunk, a in zip(group.column("chunk").to_pylist(), found):
        if not len(grams):
            break
        bare = a >> _LOCAL
        at = np.minimum(np.searchsorted(grams, bare), len(grams) - 1)
        hit = grams[at] == bare
        if hit.any():
            out.append((0, chunk, *_squeeze(a[hit]), rarity[at[hit]].tobytes()))
    columns = list(zip(*out)) if out else [()] * 5
    return pa.table([pa.array(c, f.type) for c, f in zip(columns, _MESSAGE)], schema=_MESSAGE)


def prefix_length(size: int, threshold: float, level: int) -> int:
    """Grams in the prefix of a set at a level, the whole set at most."""
    return min(size, size - math.ceil(threshold * size - 1e-9) + level)


def choose_level(frequencies: np.ndarray, alone: int, size: int, threshold: float, most: int, verify_cost: float) -> int:
    """The level, from 1 to ``most``, of least estimated cost for one document.

    ``frequencies``: those of its shared grams, in order; ``alone`` grams come before them.
    At a level the document meets sum(frequency - 1) postings of its prefix; pairs that are
    to be verified are estimated as postings divided by level, since each has to bring so
    many. A verification costs as much as ``verify_cost`` postings.
    """
    base = prefix_length(size, threshold, 1) - alone
    if base <= 0 or not len(frequencies):
        return 1
    sums = np.cumsum(frequencies - 1.0)
    levels = np.arange(1, min(most, size - prefix_length(size, threshold, 1) + 1) + 1)
    postings = sums[np.clip(base + levels - 2, 0, len(sums) - 1)]
    return int(levels[np.argmin(postings + verify_cost * postings / levels)])


def _sets(threshold: float, most: int, verify_cost: float):
    def run(group: pa.Table) -> pa.Table:
        release()
        parts = group.column("part").to_pylist()
        payload = group.column("payload").to_pylist()
        head = np.frombuffer(payload[next(i for i, p in enumerate(parts) if p < 0)], np.uint64).reshape(-1, 4)
        rest = [i for i, p in enumerate(parts) if p >= 0]
        out: list[tuple] = []
        if rest:
            widths, frequencies = group.column("width").to_pylist(), group.column("frequency").to_pylist()
            a = np.concatenate([_expand(widths[i], payload[i]) for i in rest])
            f = np.concatenate([np.frombuffer(frequencies[i], np.uint8) for i in rest])
            doc, gram = (a & _MASK).astype(np.int64), a >> _LOCAL
            order = np.lexsort((gram, f, doc))
            doc, gram, f = doc[order], gram[order], f[order]
            at = np.searchsorted(doc, np.arange(len(head) + 1))
            for d in np.flatnonzero(np.diff(at)):
                lo, hi = at[d], at[d + 1]
                size = int(head[d, 3])
                alone = size - int(hi - lo)
                if prefix_length(size, threshold, 1) <= alone:
                    continue
                level = choose_level(from_rarity(f[lo:hi]), alone, size, threshold, most, verify_cost)
                end = lo + prefix_length(size, threshold, level) - alone
                out.append((*head[d, :3].astype(np.int64).tolist(), size, level, int(hi - lo), gram[lo:end].astype(np.int64), _six_bytes(np.sort(gram[lo:hi]))))
        columns = list(zip(*out)) if out else [()] * 8
        return pa.table([pa.array(c, x.type) for c, x in zip(columns, _SETS)], schema=_SETS)

    return run


def gram_sets(docs: DataFrame, *, n: int, threshold: float, most: int, verify_cost: float, chunk_bytes: int) -> DataFrame:
    """Documents whose prefix has a gram of another document, with what the join needs; in the shared checkpoint folder."""
    parts = 2 * partitions(docs)
    rows = docs.select(docs["doc_id"].cast("long").alias("id"), docs["text"].cast("string").alias("text")).where("id is not null and text is not null")
    sent = rows.mapInArrow(_messages(parts, n, chunk_bytes), _MESSAGE_SQL)
    returned = sent.groupBy("part").applyInArrow(_frequencies, _MESSAGE_SQL)
    return cut(returned.groupBy("chunk").applyInArrow(_sets(threshold, most, verify_cost), _SETS_SQL))


def _since(threshold: float) -> Column:
    """The level from which a gram at place ``pos`` of ``prefix`` is in the document's prefix."""
    base = F.col("size") - F.ceil(F.col("size") * F.lit(threshold) - F.lit(1e-9)).cast("long") + 1
    shared_places = base - (F.col("size") - F.col("n_shared"))
    return F.greatest(F.lit(1).cast("long"), F.col("pos").cast("long") - shared_places + 2)


def _met(threshold: float, at_once: int = 250_000):
    """Makes pairs of the entries of lists, with the number of grams that they meet in."""
    fields = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("met", pa.int64()), ("needed", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("entries")
            offsets = lists.offsets.to_numpy().astype(np.int64)
            offsets -= offsets[0]
            entries = lists.flatten()
            home, ids, code, block = (np.asarray(entries.field(k)) for k in range(4))
            size, level, since = code >> 16, (code >> 8) & 255, code & 255
            apart, n = np.asarray(batch.column("apart").cast(pa.int8())).astype(bool), batch.column("n").to_numpy()
            for of, i, j in pairs_of_lists(offsets, at_once, home):
                lower = np.minimum(level[i], level[j])
                keep = (np.minimum(size[i], size[j]) >= np.maximum(size[i], size[j]) * threshold - 1e-9) & (np.maximum(since[i], since[j]) <= lower)
                keep &= ~apart[of] | (block[i] != block[j])
                of, i, j, lower = of[keep], i[keep], j[keep], lower[keep]
                a, b = np.minimum(ids[i], ids[j]), np.maximum(ids[i], ids[j])
                order = np.lexsort((b, a))
                a, b, lower, met = a[order], b[order], lower[order], n[of][order]
                first = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])]) if len(a) else np.zeros(0, np.int64)
                if len(first):
                    yield pa.RecordBatch.from_arrays([pa.array(a[first]), pa.array(b[first]), pa.array(np.add.reduceat(met, first)), pa.array(lower[first].astype(np.int64))], schema=fields)
            release()

    return run


def _homes(whole: DataFrame, lengths: DataFrame) -> DataFrame:
    """(id, home) of sets that share a quarter of their prefix or more with a hub.

    The hub of a gram in ``lengths`` is that of its sets with the smallest share of grams that
    no other document has, for near copies the text that they come from.
    """
    alone = F.col("size") - F.col("n_shared")
    rank = F.struct(F.floor(100 * alone / F.col("size")).alias("rank"), (-F.col("size")).alias("less"), "id").alias("hub")
    postings = whole.select("id", (alone + F.size("prefix")).alias("places"), rank, F.explode("prefix").alias("gram")).join(lengths.select("gram"), "gram")
    hubs = postings.groupBy("gram").agg(F.min("hub").alias("hub")).select("gram", F.col("hub.id").alias("home"))
    votes = postings.select("id", "places", "gram").join(hubs, "gram").groupBy("id", "home").agg(F.count(F.lit(1)).alias("votes"), F.first("places").alias("places"))
    return votes.where("4 * votes >= places").groupBy("id").agg(F.max(F.struct("votes", "home")).alias("most")).select("id", F.col("most.home").alias("home"))


def _candidates(whole: DataFrame, lengths: DataFrame, threshold: float, list_at_once: int) -> DataFrame:
    """(a, b) of sets of different homes that share enough grams of their prefixes, a < b.

    Near duplicates share many grams, and these have the same lists of documents. Lists that
    are equal are one list with a count before any pair is made of them.
    """
    postings = whole.select("id", "home", "size", "level", "n_shared", F.posexplode("prefix").alias("pos", "gram"))
    code = F.shiftleft("size", 16) + F.shiftleft("level", 8) + _since(threshold)
    lists = in_blocks(postings, "gram", code, list_at_once, lengths).groupBy("apart", "entries").agg(F.count(F.lit(1)).alias("n"))
    met = lists.mapInArrow(_met(threshold), "a long, b long, met long, needed long").groupBy("a", "b").agg(F.sum("met").alias("met"), F.first("needed").alias("needed"))
    return met.where("met >= needed").select("a", "b")


def _both(one: list[np.ndarray], other: list[np.ndarray] | None, at_once: int = 4 << 20) -> np.ndarray:
    """How many grams each of ``one`` shares with each of ``other``, or of ``one``: products for grams of many sets, sums for the others. Grams of one set alone aren't counted."""
    sides = [one] if other is None else [one, other]
    code = np.unique(np.concatenate([g for side in sides for g in side]), return_inverse=True)[1]
    n, m = len(one), len(sides[-1])
    row = [np.repeat(np.arange(len(side)), [len(g) for g in side]) for side in sides]
    code = np.split(code, [len(row[0])])[: len(sides)]
    kinds = max((int(c.max()) + 1 for c in code if len(c)), default=0)
    held = [np.bincount(c, minlength=kinds) for c in code]
    many = held[0] * held[-1] * 200 >= n * m
    if other is None:
        many &= held[0] > 1
    both = np.zeros((n, m), np.float32)
    at = np.cumsum(many) - 1
    dense = [(r[many[c]], at[c[many[c]]]) for r, c in zip(row, code)]
    width = max(1, at_once // max(n, m))
    for lo in range(0, int(many.sum()), width):
        parts = []
        for (r, c), rows in zip(dense, (n, m)):
            x = np.zeros((rows, width), np.float32)
            here = (c >= lo) & (c < lo + width)
            x[r[here], c[here] - lo] = 1
            parts.append(x)
        both += parts[0] @ parts[-1].T
    left, right = ((r[~many[c]], c[~many[c]]) for r, c in ((row[0], code[0]), (row[-1], code[-1])))
    order = np.argsort(right[1], kind="stable")
    partner, of = right[0][order], right[1][order]
    start = np.searchsorted(of, left[1])
    times = np.searchsorted(of, left[1], "right") - start
    if other is None:
        times[times == 1] = 0
    ends = np.cumsum(times)
    lo = 0
    while lo < len(times):
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + at_once, "right")))
        t = times[lo:hi]
        place = np.repeat(start[lo:hi] - (np.cumsum(t) - t), t) + np.arange(int(t.sum()))
        np.add.at(both.reshape(-1), np.repeat(left[0][lo:hi], t) * m + partner[place], np.float32(1))
        lo = hi
    return both


def _similar_blocks(threshold: float):
    """As ``_similar``, all pairs of two blocks, or of one, as a matrix."""

    def judge(one: list[bytes], other: list[bytes] | None) -> np.ndarray:
        sides = [one] if other is None else [one, other]
        size = [np.array([int.from_bytes(p[:8], "big") for p in side], np.float64) for side in sides]
        both = _both(*([_from_six_bytes(p[8:]) for p in side] for side in sides), *([None] * (2 - len(sides)))).astype(np.float64)
        return both >= threshold * (size[0][:, None] + size[-1] - both) - 1e-9

    return judge


def _similar(threshold: float):
    """Which pairs of sets reach the threshold. A payload is the size of the set and its shared grams."""

    def judge(payload: list[bytes], a: np.ndarray, b: np.ndarray) -> np.ndarray:
        size = np.array([int.from_bytes(p[:8], "big") for p in payload], np.int64)
        grams = [_from_six_bytes(p[8:]) for p in payload]
        count = np.array([len(g) for g in grams], np.int64)
        start = np.cumsum(count) - count
        every = np.concatenate(grams)
        del grams
        code = np.unique(every, return_inverse=True)[1].astype(np.int32)
        del every
        held = np.zeros(int(code.max()) + 1 if len(code) else 0, bool)
        order = np.argsort(a, kind="stable")
        edge = np.flatnonzero(np.r_[True, a[order][1:] != a[order][:-1], True])
        both = np.zeros(len(a), np.int64)
        for lo, hi in zip(edge[:-1].tolist(), edge[1:].tolist()):
            own = code[start[a[order[lo]]] : start[a[order[lo]]] + count[a[order[lo]]]]
            held[own] = True
            for at in range(lo, hi, 512):
                partners = b[order[at : min(at + 512, hi)]]
                n = count[partners]
                ends = np.cumsum(n)
                place = np.repeat(start[partners] - (ends - n), n) + np.arange(ends[-1])
                sums = np.r_[0, np.cumsum(held[code[place]])]
                both[order[at : min(at + 512, hi)]] = sums[ends] - sums[ends - n]
            held[own] = False
        return both >= threshold * (size[a] + size[b] - both) - 1e-9

    return judge


def ngram_jaccard_classes(docs: DataFrame, *, n: int = 3, threshold: float = 0.6, most_shared: int = 12, verify_cost: float = 8.0, chunk_bytes: int = 12 << 20, list_at_once: int = 2048, pairs_at_once: int = 250_000, crowd: int = 64) -> DataFrame:
    """(doc_id, class_id, n_links): a row for each document with a link to another one.

    Two documents are linked if the Jaccard similarity of their gram sets is ``threshold`` at
    least; all links are found. ``n_links`` counts a document's links, copies included.
    Documents that links lead to, over others too, are a class; ``class_id`` is its smallest
    doc_id. A document without a link has no row.

    Grams are runs of ``n`` words of the lower-cased text; a text with fewer words is one gram
    of them all; repeated grams count once. ``most_shared`` bounds the levels that a document
    chooses from, ``verify_cost`` weighs a verification against a posting; neither changes the
    result, nor do ``chunk_bytes``, ``list_at_once`` and ``pairs_at_once``, which bound the
    memory of a task, nor ``crowd``, the number of sets from which a gram has a hub. Grams are compared by 48 bits of a hash: two texts of a thousand grams
    each have a chance of 4e-9 that grams which differ count as shared, at any size of the corpus.

    Texts without a word, null texts and null doc_ids match nothing. Repeated rows count once;
    of a doc_id with several texts one text that could match is used. An empty table gives an
    empty result; other columns are ignored.
    """
    if not 0 < threshold <= 1 or n < 1 or not 1 <= most_shared < 256:
        raise ValueError("threshold must be in (0, 1], n positive, most_shared from 1 to 255")
    sets = gram_sets(docs, n=n, threshold=threshold, most=most_shared, verify_cost=verify_cost, chunk_bytes=chunk_bytes)
    own = sets.groupBy("id").agg(F.min(F.struct("key1", "key2")).alias("key")).select("id", "key.*")
    # documents with equal sets are one record from here on
    equal = cut(own.groupBy("key1", "key2").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("copies")))
    firsts = equal.select(F.col("first").alias("id"), "key1", "key2", "copies")
    # the sets themselves travel once, when pairs are verified; until then there are only their prefixes
    whole = sets.drop("shared").join(firsts, ["id", "key1", "key2"], "left_semi").dropDuplicates(["id"])
    lengths = cut(whole.select(F.explode("prefix").alias("gram")).groupBy("gram").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > min(crowd, list_at_once)))
    homes = cut(_homes(whole, lengths))
    # a set without a home has its own, where its hub's others may be too
    whole = whole.join(homes, "id", "left").withColumn("home", F.coalesce("home", "id"))
    found = cut(_candidates(whole, lengths, threshold, list_at_once))
    payload = F.concat(F.to_binary(F.lpad(F.hex("size"), 16, "0"), F.lit("hex")), F.col("shared"))

    def with_payload(needed: DataFrame) -> DataFrame:
        return needed.join(firsts, "id").join(sets.select("id", "key1", "key2", "size", "shared"), ["id", "key1", "key2"]).select("of", "id", F.col("copies").alias("weight"), payload.alias("payload"))

    hubs = homes.select(F.col("home").alias("hub")).distinct().join(homes.select("id"), F.col("hub") == F.col("id"), "left_anti")
    housed = homes.unionByName(hubs.select(F.col("hub").alias("id"), F.col("hub").alias("home")))
    at_home = linked_at_home(with_payload(housed.withColumnRenamed("home", "of")).withColumnRenamed("of", "home"), _similar_blocks(threshold), list_at_once, 8 << 20)
    near = classes(linked(found, with_payload, _similar(threshold), pairs_at_once).unionByName(at_home)).withColumnRenamed("id", "first")
    rows = own.join(equal, ["key1", "key2"]).join(near, "first", "left")
    out = cut(rows.select(F.col("id").alias("doc_id"), F.coalesce("class_id", "first").alias("class_id"), (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")).where("n_links > 0"))
    for done in (sets, equal, lengths, homes, found):
        drop_cut(done)
    return out


def near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """(id, group) of every document that ``ngram_jaccard_classes`` has a row for; group is its class."""
    return ngram_jaccard_classes(docs, **options).select(F.col("doc_id").alias("id"), F.col("class_id").alias("group"))
