"""From lists of records that may be alike to classes: pairs within lists, verified links, connected components.

Nothing here holds a whole group: long lists are split into blocks, and every two blocks of a
list meet in a row of their own; links are verified in cells of bounded size, and a cell gives
back a row for each record, not for each link.

Records may be given homes: those of one home are all compared with each other, in blocks of
records and without a row for any pair, so their pairs needn't be made from lists.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.llm.common import cut, drop_cut, release


def in_blocks(postings: DataFrame, key: str, entry: Column, at_once: int, lengths: DataFrame | None = None) -> DataFrame:
    """(``key``, apart, entries): the lists of ``postings`` by ``key``, each with two entries at least.

    A list of more than ``at_once`` entries is split into blocks by a hash of id. Each block is
    a list, and so are every two blocks together; in the latter ``apart`` is true, and only
    entries whose fields ``block`` differ are to be paired. So every two entries of a key meet
    in one row, and no row has many more than twice ``at_once`` entries.

    With ``lengths``, the number n of entries of each key that has more than ``at_once`` or of
    more keys, ``postings`` have homes too, and entries are ordered by them. The home that has
    most entries of a long list has blocks of its own, which don't meet each other: entries of
    one home needn't meet.
    """
    homes = lengths is not None
    counted = lengths if homes else postings.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    heavy = counted.where(F.col("n") > at_once).select(F.col(key).alias("of"), "n")
    if homes:
        held = postings.join(heavy, F.col(key) == F.col("of"), "left_semi").groupBy(F.col(key).alias("in"), "home").agg(F.count(F.lit(1)).alias("held"))
        main = held.groupBy("in").agg(F.max(F.struct("held", "home")).alias("main"))
        heavy = heavy.join(main, F.col("of") == F.col("in")).select("of", "n", F.col("main.home").alias("main"), F.when(F.col("main.held") > 1, F.col("main.held")).otherwise(F.lit(0)).alias("held"))
    else:
        heavy = heavy.select("of", "n", F.lit(None).cast("long").alias("main"), F.lit(0).alias("held"))
    # blocks of the main home come first
    heavy = heavy.select("of", "main", F.ceil(F.col("held") / F.lit(at_once)).cast("int").alias("own"), F.ceil((F.col("n") - F.col("held")) / F.lit(at_once)).cast("int").alias("rest"))
    sized = postings.join(heavy, F.col(key) == F.col("of"), "left").withColumn("own", F.coalesce("own", F.lit(0))).withColumn("rest", F.coalesce("rest", F.lit(1)))
    is_main = (F.col("own") > 0) & (F.col("home") == F.col("main")) if homes else F.lit(False)
    sized = sized.withColumn("is_main", is_main).withColumn("block", F.when(F.col("is_main"), F.pmod(F.xxhash64("id"), F.greatest("own", F.lit(1)))).otherwise(F.col("own") + F.pmod(F.xxhash64("id"), F.greatest("rest", F.lit(1)))).cast("int"))
    every = F.when(F.col("own") + F.col("rest") == 1, F.array(F.lit(0))).when(F.col("is_main") & (F.col("rest") == 0), F.array().cast("array<int>"))
    spread = sized.withColumn("other", F.explode(every.otherwise(F.sequence(F.when(F.col("is_main"), F.col("own")).otherwise(F.lit(0)), F.col("own") + F.col("rest") - 1))))
    fields = F.struct("home", "id", entry.alias("code"), "block") if homes else F.struct("id", entry.alias("code"), "block")
    rows = spread.select(key, F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), fields.alias("entry"))
    return rows.repartition(key, "lo", "hi").groupBy(key, "lo", "hi").agg(F.array_sort(F.collect_list("entry")).alias("entries")).where(F.size("entries") > 1).select(key, (F.col("lo") != F.col("hi")).alias("apart"), "entries")


def pairs_of_lists(offsets: np.ndarray, at_once: int, homes: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(list, i, j) of all places i < j that lie in one list, in runs of about ``at_once``. List k has the places from offsets[k] to offsets[k + 1].

    With ``homes``, by which each list is ordered, places of one home aren't paired.
    """
    total = int(offsets[-1])
    of = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    partner = np.arange(total) + 1
    if homes is not None and total:
        edges = np.flatnonzero(np.r_[True, (homes[1:] != homes[:-1]) | (of[1:] != of[:-1]), True])
        partner = np.repeat(edges[1:], np.diff(edges))
    after = offsets[1:][of] - partner
    ends = np.cumsum(after)
    start = 0
    while start < total:
        stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + at_once, "right")))
        n = after[start:stop]
        if n.any():
            i = np.repeat(np.arange(start, stop), n)
            j = np.repeat(partner[start:stop] - (np.cumsum(n) - n), n) + np.arange(len(i))
            yield of[i], i, j
        start = stop


def _cell(judge: Callable[[list, np.ndarray, np.ndarray], np.ndarray]):
    def run(pairs: pa.Table, items: pa.Table) -> pa.Table:
        release()
        ids = items.column("id").to_numpy()
        order = np.argsort(ids, kind="stable")
        ids = ids[order]
        payload = items.column("payload").take(pa.array(order)).to_pylist()
        weight = items.column("weight").to_numpy()[order]
        a, b = (np.searchsorted(ids, pairs.column(x).to_numpy()) for x in "ab")
        keep = judge(payload, a, b)
        a, b = a[keep], b[keep]
        links = np.zeros(len(ids), np.int64)
        np.add.at(links, a, weight[b])
        np.add.at(links, b, weight[a])
        root = np.arange(len(ids))
        while True:
            least = np.minimum(root[a], root[b])
            before = root.copy()
            np.minimum.at(root, a, least)
            np.minimum.at(root, b, least)
            root = root[root]
            if (root == before).all():
                break
        some = links > 0
        return pa.table({"id": ids[some], "root": ids[root[some]], "links": links[some]})

    return run


def linked(found: DataFrame, with_payload: Callable[[DataFrame], DataFrame], judge: Callable[[list, np.ndarray, np.ndarray], np.ndarray], pairs_at_once: int) -> DataFrame:
    """(id, root, links): for each cell and id that has links there, their total weight and the smallest id they lead to within the cell.

    ``found``: candidates (a, b) with a < b, each once. ``with_payload`` adds weight and payload to rows (of, id).
    ``judge`` gets the payloads of a cell and the places of both sides, and says which pairs are
    links. Candidates go in groups by the smallest partner of ``a``, so that a payload is sent
    once for a whole group of records that are alike. A group of more pairs than
    ``pairs_at_once`` is split by hashes of both sides into cells.
    """
    least = found.groupBy(F.col("b").alias("a")).agg(F.min("a").alias("least"))
    grouped = found.join(least, "a", "left").withColumn("group", F.coalesce("least", "a")).drop("least")
    split = grouped.groupBy("group").agg(F.ceil(F.sqrt(F.count(F.lit(1)) / F.lit(pairs_at_once))).alias("splits")).where("splits > 1")

    def part(side: str) -> Column:
        return F.coalesce(F.pmod(F.xxhash64(side), "splits"), F.lit(0).cast("long"))

    cells = grouped.join(split, "group", "left").select("group", part("a").alias("part_a"), part("b").alias("part_b"), "a", "b")
    cell = F.struct("group", "part_a", "part_b").alias("cell")
    cells = cells.select(cell, "a", "b")
    needed = cells.select(F.col("cell").alias("of"), F.explode(F.array("a", "b")).alias("id")).distinct()
    return cells.groupBy("cell").cogroup(with_payload(needed).select("of", "id", "weight", "payload").groupBy("of")).applyInArrow(_cell(judge), "id long, root long, links long")


def _block(judge: Callable[[list, list | None], np.ndarray]):
    def run(group: pa.Table) -> pa.Table:
        release()
        block, ids, weight = (group.column(k).to_numpy() for k in ("block", "id", "weight"))
        sides = [np.flatnonzero(block == x) for x in np.unique(block)]
        cell = group.column("cell")[0].as_py()
        apart = cell["lo"] != cell["hi"]
        if apart and len(sides) < 2:
            return pa.table({k: np.zeros(0, np.int64) for k in ("id", "root", "links")})
        payload = [group.column("payload").take(pa.array(x)).to_pylist() for x in sides]
        alike = judge(payload[0], payload[1] if apart else None)
        x, y = sides[0], sides[-1]
        if not apart:
            np.fill_diagonal(alike, False)
        counted = alike.astype(np.float64)
        links = [counted @ weight[y], weight[x] @ counted]
        del counted
        root, none = [ids[x].astype(np.int64), ids[y].astype(np.int64)], np.iinfo(np.int64).max
        while True:
            first = np.minimum(root[0], np.where(alike, root[1], none).min(1))
            second = np.minimum(root[1], np.where(alike, first[:, None], none).min(0)) if apart else first
            if (first == root[0]).all() and (second == root[1]).all():
                break
            root = [first, second]
        out = [(ids[p][n > 0], r[n > 0], n[n > 0].astype(np.int64)) for p, r, n in list(zip(sides, root, links))[: 2 if apart else 1]]
        return pa.table({k: np.concatenate(v) for k, v in zip(("id", "root", "links"), zip(*out))})

    return run


def linked_at_home(items: DataFrame, judge: Callable[[list, list | None], np.ndarray], at_once: int, bytes_at_once: int) -> DataFrame:
    """What ``linked`` returns, of all pairs within the homes of ``items`` (home, id, weight, payload).

    ``judge`` gets the payloads of two blocks, or of one and None, and gives back a matrix that
    says which pairs are links. A home of more than ``at_once`` records or ``bytes_at_once`` is
    split into blocks by a hash of id; every two blocks are a cell.
    """
    sizes = items.groupBy("home").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("payload")).alias("bytes")).where("n > 1")
    blocks = F.ceil(F.greatest(F.col("n") / F.lit(at_once), F.col("bytes") / F.lit(bytes_at_once))).cast("int").alias("blocks")
    placed = items.join(sizes.select("home", blocks), "home").withColumn("block", F.pmod(F.xxhash64("id"), "blocks").cast("int"))
    spread = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cell = F.struct("home", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi")).alias("cell")
    return spread.select(cell, "block", "id", "weight", "payload").groupBy("cell").applyInArrow(_block(judge), "id long, root long, links long")


def components(edges: DataFrame, *, most_rounds: int = 60) -> DataFrame:
    """(id, group): for each id of the edges (a, b), the smallest id that it is connected with.

    Alternating large-star and small-star contraction; each round's edges are cut to the
    shared folder. The number of rounds grows with the logarithm of a component's size.
    """
    now = cut(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct())
    before = None
    for _ in range(most_rounds):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        last, now = now, cut(small)
        drop_cut(last)
        state = now.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if state == before:
            return now.select(F.col("u").alias("id"), F.col("v").alias("group")).unionByName(now.select(F.col("v").alias("id"), F.col("v").alias("group")).distinct())
        before = state
    raise RuntimeError(f"components didn't settle within {most_rounds} rounds")


def classes(links: DataFrame) -> DataFrame:
    """(id, class_id, links): for each id of what ``linked`` returns, the smallest id of its component and the sum of its links."""
    held = cut(links)
    groups = components(held.select(F.col("id").alias("a"), F.col("root").alias("b")))
    out = held.groupBy("id").agg(F.sum("links").alias("links")).join(groups, "id").select("id", F.col("group").alias("class_id"), "links")
    return out
