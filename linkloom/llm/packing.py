"""Bounded-space online best-fit packing of documents into training sequences.

Documents arrive in a fixed order and are placed at once: into the open sequence with the
least free space that still suffices, found in a bitset with one bit for each amount of free
space. At most ``open_bins`` sequences are open; when a new one is needed beyond that, the
fullest closes for good. Because of that bound the packer's state doesn't grow with its input,
and documents stream through it.

The stream is cut into a fixed number of shards by a hash of the document; each is packed by
itself. So a document's place depends on the documents of its shard only.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.llm.common import release, slices, text_or_empty
from linkloom.llm.token_counts import DEFAULT_RANKS, token_counter

PIECES = "array<struct<piece:long,bin_id:long,bin_offset:long,n_tokens:long>>"


class Packer:
    """The open sequences: a queue for each amount of free space, and a bitset of the amounts that there are."""

    def __init__(self, capacity: int, open_bins: int):
        self.capacity, self.open_bins = capacity, open_bins
        self.bins = self.bits = self.n_open = 0
        self.at: dict[int, deque[int]] = {}

    def _take(self, free: int) -> int:
        queue = self.at[free]
        b = queue.popleft()
        if not queue:
            del self.at[free]
            self.bits ^= 1 << free
        self.n_open -= 1
        return b

    def place(self, length: int) -> list[tuple[int, int, int, int]]:
        """(piece, bin, offset, length) of the next item.

        An item longer than the capacity is cut: full pieces take a bin each, the rest is placed
        like any other item. An item of length 0 takes no space but has a place.
        """
        out = []
        while length > self.capacity:
            out.append((len(out), self.bins, 0, self.capacity))
            self.bins += 1
            length -= self.capacity
        fit = self.bits >> length
        if fit:
            free = length + (fit & -fit).bit_length() - 1
            b = self._take(free)
        else:
            if self.n_open >= self.open_bins:
                self._take((self.bits & -self.bits).bit_length() - 1)
            b, free = self.bins, self.capacity
            self.bins += 1
        out.append((len(out), b, self.capacity - free, length))
        left = free - length
        if left:
            if left in self.at:
                self.at[left].append(b)
            else:
                self.at[left] = deque([b])
                self.bits |= 1 << left
            self.n_open += 1
        return out


def _placed(docs: DataFrame, kept: list[str], capacity: int, separator: int, open_bins: int, shards: int, ranks_path: str) -> DataFrame:
    """The kept columns of every row, and its pieces. Only these columns are shuffled."""
    if capacity < 1 or open_bins < 1 or separator < 0 or shards < 1:
        raise ValueError("capacity, open_bins and shards must be positive, separator not negative")
    count = token_counter(ranks_path)
    text = text_or_empty(docs["text"])
    row = F.struct(*[docs[c].alias(f"c{k}") for k, c in enumerate(kept)]).alias("row")
    rows = docs.select(docs["doc_id"].cast("long").alias("id"), F.xxhash64(text).alias("tie"), row, *([] if "text" in kept else [text.alias("text")]))
    shape = rows.select("id", "tie", "row", F.lit(0).cast("long").alias("size")).schema

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            inside = pc.fill_null(pc.struct_field(batch.column("row"), kept.index("text")).cast(pa.string()), "") if "text" in kept else batch.column("text")
            for part in slices(pa.RecordBatch.from_arrays([*batch.columns[:3], inside], ["id", "tie", "row", "text"])):
                yield pa.RecordBatch.from_arrays([*part.columns[:3], pa.array(count(part.column("text")) + separator)], ["id", "tie", "row", "size"])
            release()

    sized = rows.mapInArrow(sizes, shape).withColumn("shard", F.pmod(F.xxhash64("id", "tie"), F.lit(shards)))
    ordered = sized.repartition(shards, "shard").sortWithinPartitions("shard", "id", "size", "tie").select("shard", "size", "row")
    out = ordered.select("row", F.lit(None).cast(PIECES).alias("pieces")).schema

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, packer = None, None
        for batch in batches:
            found = []
            for shard, size in zip(batch.column("shard").to_pylist(), batch.column("size").to_pylist()):
                if shard != now:
                    now, packer = shard, Packer(capacity, open_bins)
                found.append([(k, b + (shard << 32), at, n) for k, b, at, n in packer.place(size)])
            flat = np.array([x for pieces in found for x in pieces], np.int64).reshape(-1, 4)
            offsets = np.r_[0, np.cumsum([len(x) for x in found])].astype(np.int32)
            pieces = pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays([pa.array(flat[:, k].copy()) for k in range(4)], ["piece", "bin_id", "bin_offset", "n_tokens"]))
            yield pa.RecordBatch.from_arrays([batch.column("row"), pieces], ["row", "pieces"])
        release()

    return ordered.mapInArrow(place, out).select(*[F.col("row")[f"c{k}"].alias(c) for k, c in enumerate(kept)], "pieces")


def packed_documents(docs: DataFrame, *, capacity: int = 8192, separator: int = 1, open_bins: int = 256, shards: int = 128, ranks_path: str = DEFAULT_RANKS) -> DataFrame:
    """The rows of ``docs``, with a column ``pieces`` of where each goes: (piece, bin_id, bin_offset, n_tokens).

    A document needs the tokens of its text, by the vocabulary in ``ranks_path``, plus
    ``separator``. Documents longer than ``capacity`` have several pieces, numbered from 0,
    which together hold it all. Order within a shard: doc_id (nulls first), then length, then a
    hash of the text; rows that are alike in these are the same but for their other columns, and
    share out the places in any order. Null texts count as empty; repeated rows are placed each;
    an empty table gives an empty result; a column ``pieces`` of ``docs`` is replaced, others are
    kept. Each bin's tokens are those of its pieces, in order of bin_offset.
    """
    return _placed(docs, [c for c in docs.columns if c != "pieces"], capacity, separator, open_bins, shards, ranks_path)


def best_fit_packing(docs: DataFrame, *, capacity: int = 8192, separator: int = 1, open_bins: int = 256, shards: int = 128, ranks_path: str = DEFAULT_RANKS) -> DataFrame:
    """(doc_id, piece, bin_id, bin_offset, n_tokens): a row for every piece of every document, as ``packed_documents`` places them; its other columns are ignored, and texts aren't shuffled."""
    return _placed(docs.withColumn("doc_id", docs["doc_id"].cast("long")), ["doc_id"], capacity, separator, open_bins, shards, ranks_path).select("doc_id", F.inline("pieces"))
