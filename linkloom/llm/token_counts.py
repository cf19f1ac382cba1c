"""Token counts of byte-pair encodings, by merging with a heap over a linked list.

A text is cut into pieces by the vocabulary's pattern. Within a piece the adjacent pair of
lowest rank is popped from a heap and merged in a linked list, again and again; a piece has as
many tokens as bytes minus merges. No identifiers are made.

Texts are cut at single spaces in Arrow, and each different word of a slice of texts is counted
once. Counts of pieces are remembered by a worker.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator
from heapq import heapify, heappop, heappush
from math import nan

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from linkloom.llm.common import release, slices, text_or_empty

PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"
DEFAULT_RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"

#: Single bytes that are a piece by themselves after a word, with the default pattern.
_STOPS = frozenset(".,;:?!")

_counters: dict[tuple, Callable[[pa.Array], np.ndarray]] = {}


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks by byte string, from a file with a line of base64 and rank for each."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def tokens_in_piece(piece: bytes, ranks: dict[bytes, int]) -> int:
    """Symbols left when no adjacent pair has a rank; of equal ranks the leftmost pair merges first."""
    n = len(piece)
    if n < 2:
        return n
    symbol: list[bytes | None] = [piece[i : i + 1] for i in range(n)]
    after = list(range(1, n + 1))
    before = list(range(-1, n - 1))
    rank = ranks.get
    # an entry is the rank above the place of the left symbol; it is stale if the pair there has another rank by now
    heap = [r << 32 | i for i in range(n - 1) if (r := rank(piece[i : i + 2])) is not None]
    heapify(heap)
    merges = 0
    while heap:
        entry = heappop(heap)
        i = entry & 0xFFFFFFFF
        a = symbol[i]
        if a is None:
            continue
        j = after[i]
        if j >= n or rank(a + symbol[j]) != entry >> 32:
            continue
        a = symbol[i] = a + symbol[j]
        symbol[j] = None
        merges += 1
        k = after[i] = after[j]
        if k < n:
            before[k] = i
            r = rank(a + symbol[k])
            if r is not None:
                heappush(heap, r << 32 | i)
        h = before[i]
        if h >= 0:
            r = rank(symbol[h] + a)
            if r is not None:
                heappush(heap, r << 32 | h)
    return n - merges


def counter(ranks: dict[bytes, int], pattern: str = PATTERN, remembered: int = 700_000, cut_at_spaces: bool = True) -> Callable[[pa.Array], np.ndarray]:
    """Counts the tokens of each of an array of texts. Counts of pieces are remembered, up to so many at a time.

    ``cut_at_spaces``: cuts texts at each single space before the pattern is applied, so that
    most need one look-up for each different word. Right for patterns whose pieces hold a space
    only as their first character, such as the default one. Texts where white space meets white
    space are not cut.
    """
    find = regex.compile(pattern).findall

    class Pieces(dict):
        """Counts of the pieces seen of late; those before them are kept until as many new ones have come."""

        before: dict[str, int] = {}

        def __missing__(self, piece: str) -> int:
            n = self.before.get(piece)
            if n is None:
                n = tokens_in_piece(piece.encode(), ranks)
            if len(self) >= max(1, remembered // 2):
                self.before = dict(self)
                self.clear()
            self[piece] = n
            return n

    of_piece = Pieces().__getitem__
    plain = pattern == PATTERN

    def of_word(word: str) -> float:
        if plain and word.isalpha():
            return of_piece(" " + word)
        if plain and word[-1:] in _STOPS and word[:-1].isalpha():
            return of_piece(" " + word[:-1]) + 1
        # not a number where white space would meet the space that was cut out
        apart = word and not word[0].isspace() and not word[-1].isspace()
        return sum(map(of_piece, find(" " + word))) if apart else nan

    def whole(text: str) -> int:
        return sum(map(of_piece, find(text)))

    def beginning(word: str) -> float:
        return whole(word) if word and not word[-1].isspace() else nan

    def of_different(values: pa.Array, n: Callable[[str], float]) -> np.ndarray:
        different = pc.dictionary_encode(values)
        known = np.array(list(map(n, different.dictionary.to_pylist())), np.float64)
        return known[np.asarray(different.indices)]

    def count(texts: pa.Array) -> np.ndarray:
        if not len(texts):
            return np.zeros(0, np.int64)
        if not cut_at_spaces:
            return np.array([whole(t) for t in texts.to_pylist()], np.int64)
        lists = pc.split_pattern(texts, " ")
        values, start = lists.flatten(), lists.offsets.to_numpy().astype(np.int64)
        start = start - start[0]
        first = np.zeros(len(values), bool)
        first[start[:-1]] = True
        n = np.empty(len(values))
        n[first] = of_different(values.filter(pa.array(first)), beginning)
        n[~first] = of_different(values.filter(pa.array(~first)), of_word)
        sums = np.add.reduceat(n, start[:-1])
        for k in np.flatnonzero(np.isnan(sums)).tolist():
            sums[k] = whole(texts[k].as_py())
        return sums.astype(np.int64)

    return count


def _counter(path: str, *options: str | int | bool) -> Callable[[pa.Array], np.ndarray]:
    key = (path, *options)
    if key not in _counters:
        _counters[key] = counter(read_ranks(path), *options)
    return _counters[key]


def token_counter(ranks_path: str = DEFAULT_RANKS, pattern: str = PATTERN, remembered: int = 700_000, cut_at_spaces: bool = True) -> Callable[[pa.Array], np.ndarray]:
    """The counter for a vocabulary file, made where the work is done and kept by the worker."""

    def count(texts: pa.Array) -> np.ndarray:
        return _counter(ranks_path, pattern, remembered, cut_at_spaces)(texts)

    return count


def token_counts(docs: DataFrame, *, ranks_path: str = DEFAULT_RANKS, pattern: str = PATTERN, cut_at_spaces: bool = True, remembered: int = 700_000) -> DataFrame:
    """(doc_id, n_tokens) for each row of ``docs``, over its whole text.

    ``ranks_path`` is read where the work is done, so every executor must see it;
    ``cut_at_spaces`` and ``remembered`` are those of ``counter``. Null and
    empty texts have 0 tokens; a null doc_id stays null; repeated rows are counted each; an
    empty table gives an empty result; other columns are ignored.
    """
    n = token_counter(ranks_path, pattern, remembered, cut_at_spaces)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(n(part.column("text")))], ["doc_id", "n_tokens"])
            release()

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_or_empty(docs["text"]).alias("text")).mapInArrow(run, "doc_id long, n_tokens long")
