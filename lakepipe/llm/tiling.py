"""Benchmark decontamination by greedy string tiling.

Texts and test items are word sequences.  The seeds of an item are its runs of
``min_match`` words; a text is compared with the items it shares a seed with.
Each comparison tiles: Karp-Rabin hashes find the longest common runs of words
not yet covered, whose words are compared one by one; the longest are marked
first and no word is covered twice.  Tiles may stand in any order and anywhere
in the text, so a reordered or scattered passage is covered as well as a copied
one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from lakepipe.llm import text as tx

_TABLE_BITS = 20


@dataclass
class Seeds:
    """The seeds of one length: their hashes in order, the item of each, and a table of their upper bits."""

    length: int
    hashes: np.ndarray
    owner: np.ndarray
    table: np.ndarray


@dataclass
class Items:
    """A block of test items: their words and their seeds by length."""

    ids: list
    words: list[np.ndarray]
    seeds: list[Seeds]

    @classmethod
    def of(cls, rows: list[tuple], min_match: int) -> Items:
        ids = [r[0] for r in rows]
        data, off = tx.texts(pa.array([r[1] for r in rows], pa.string()))
        h, first = tx.word_hashes(data, off)
        words = [h[a:b] for a, b in zip(first[:-1], first[1:])]
        by_length: dict[int, list[int]] = {}
        for k, w in enumerate(words):
            if len(w):
                by_length.setdefault(min(min_match, len(w)), []).append(k)
        seeds = []
        for n, owners in sorted(by_length.items()):
            sets = [np.unique(tx.gram_hashes(words[k], n)) for k in owners]
            flat, owner = np.concatenate(sets), np.repeat(owners, [len(s) for s in sets])
            order = np.argsort(flat, kind="stable")
            table = np.zeros(1 << _TABLE_BITS, bool)
            table[(flat >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)] = True
            seeds.append(Seeds(n, flat[order], owner[order], table))
        return cls(ids, words, seeds)


def tiles(text: np.ndarray, item: np.ndarray, min_match: int) -> list[tuple[int, int, int]]:
    """Tiles (start in text, start in item, length) of two word sequences, longest first.

    Each round finds the longest run of words free in both by halving, marks
    runs of that length from the left, and goes on with the next longest.
    """
    free_t, free_i = np.ones(len(text), bool), np.ones(len(item), bool)
    found: list[tuple[int, int, int]] = []
    sums = tx.prefix_hashes(text), tx.prefix_hashes(item)
    longest = min(len(text), len(item))
    while True:
        low, high = min_match - 1, longest
        while low < high:
            n = (low + high + 1) // 2
            if _common(text, item, sums, free_t, free_i, n) is None:
                high = n - 1
            else:
                low = n
        if low < max(1, min_match):
            break
        longest = low
        while (at := _common(text, item, sums, free_t, free_i, low)) is not None:
            s, j = at
            free_t[s : s + low] = False
            free_i[j : j + low] = False
            found.append((s, j, low))
    return sorted(found, key=lambda m: (-m[2], m[0], m[1]))


def _common(text, item, sums, free_t, free_i, n: int) -> tuple[int, int] | None:
    """First (text, item) positions of a common run of ``n`` free words; equal hashes are held against the words."""
    t, i = _free_runs(free_t, n), _free_runs(free_i, n)
    if not len(t) or not len(i):
        return None
    ht, hi = tx.run_hashes(sums[0], t, n), tx.run_hashes(sums[1], i, n)
    for k in np.flatnonzero(np.isin(ht, hi)):
        for j in i[hi == ht[k]].tolist():
            if np.array_equal(text[t[k] : t[k] + n], item[j : j + n]):
                return int(t[k]), j
    return None


def _free_runs(free: np.ndarray, n: int) -> np.ndarray:
    if len(free) < n:
        return np.zeros(0, np.int64)
    total = np.concatenate([[0], np.cumsum(free)])
    return np.flatnonzero(total[n:] - total[:-n] == n)


def _windows(at: np.ndarray, n: int, size: int) -> np.ndarray:
    """Which of ``size`` positions lie in a run of ``n`` that starts at one of ``at``."""
    step = np.zeros(size + 1, np.int64)
    step[at] += 1
    np.subtract.at(step, at + n, 1)
    return np.cumsum(step[:-1]) > 0


def covered_words(words: np.ndarray, at: np.ndarray, item: np.ndarray, min_match: int) -> int:
    """Words of the item that its tiles in the whole text cover; ``at`` are the positions of the seeds in ``words``.

    A tile consists of seeds, so only words inside a seed are tiled.  One word
    that the item does not hold stands for each gap between them, so no tile
    reaches over it.
    """
    near = _windows(at, min_match, len(words))
    gap = np.uint64(0)
    while (item == gap).any():
        gap += np.uint64(1)
    keep = near.copy()
    keep[1:] |= near[:-1]  # one word after each stretch
    text = np.where(near, words, gap)[keep]
    return sum(n for _, _, n in tiles(text, item, min_match))


def shared(words: np.ndarray, first: np.ndarray, items: Items, coverage: float) -> Iterator[tuple[int, int, int]]:
    """(text, item, covered words) of the texts that reach the coverage of an item.

    An item is left out untiled only if its words inside seeds that the text
    holds, which no tiling can exceed, are too few.
    """
    for seeds in items.seeds:
        n = seeds.length
        grams = tx.gram_hashes(words, n)
        at = np.flatnonzero(seeds.table[(grams >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)])
        lo = np.searchsorted(seeds.hashes, grams[at], side="left")
        at = at[(lo < len(seeds.hashes)) & (seeds.hashes[np.minimum(lo, len(seeds.hashes) - 1)] == grams[at])]
        text = np.searchsorted(first, at, side="right") - 1
        inside = at + n <= first[text + 1]
        at, text = at[inside], text[inside]
        cuts = np.flatnonzero(np.diff(text)) + 1
        for mine in np.split(at, cuts) if len(at) else []:
            t = int(np.searchsorted(first, mine[0], side="right") - 1)
            a, b = int(first[t]), int(first[t + 1])
            held = grams[mine]
            # Of each seed once, so what is expanded is never more than the block's seeds.
            each = np.unique(held)
            lo = np.searchsorted(seeds.hashes, each, side="left")
            size = np.searchsorted(seeds.hashes, each, side="right") - lo
            owner = seeds.owner[np.repeat(lo, size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)]
            for o in np.unique(owner).tolist():
                item = items.words[o]
                own = tx.gram_hashes(item, n)
                bound = np.count_nonzero(_windows(np.flatnonzero(np.isin(own, each)), n, len(item)))
                if bound >= coverage * len(item):
                    got = covered_words(words[a:b], mine[np.isin(held, own)] - a, item, n)
                    if got >= coverage * len(item):
                        yield t, o, got


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    min_match: int = 5,
    coverage: float = 0.5,
    block_bytes: int = 32 << 20,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """(id, item_id, item_words, covered, coverage): the texts that hold at least ``coverage`` of a test item.

    One row per input row and item.  An item of fewer than ``min_match`` words
    is one seed, found where it stands whole; null and empty items and texts
    match nothing.  Repeated rows each get their findings; other columns
    are ignored.  The items are cut into blocks of ``block_bytes`` of text and
    each block goes to all tasks, so what is sent is bounded; more items mean
    more passes over the texts.
    """
    rows = docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t"))
    ids, items_type = (d.schema[c].dataType.simpleString() for d, c in ((docs, id_col), (benchmark, item_id)))
    schema = f"i {ids}, item {items_type}, item_words long, covered long"
    out = None
    for block in _blocks(benchmark.select(item_id, item_text), block_bytes):
        part = rows.mapInArrow(_matcher(Items.of(block, min_match), coverage, benchmark.schema[item_id].dataType), schema)
        out = part if out is None else out.unionByName(part)
    if out is None:
        out = docs.sparkSession.createDataFrame([], schema)
    return out.select(
        F.col("i").alias(id_col),
        F.col("item").alias(item_id),
        "item_words",
        "covered",
        (F.col("covered") / F.col("item_words")).alias("coverage"),
    )


def _blocks(items: DataFrame, limit: int) -> Iterator[list[tuple]]:
    """Streams the items through the driver in blocks of bounded size."""
    block, size = [], 0
    for r in items.toLocalIterator():
        block.append((r[0], r[1]))
        size += len((r[1] or "").encode())
        if size >= limit:
            yield block
            block, size = [], 0
    if block:
        yield block


def _covered(part: pa.RecordBatch, text_col: str, items: Items, coverage: float) -> list[tuple[int, int, int]]:
    """(text, item, covered words) of the texts of a slice that reach the coverage."""
    return sorted(shared(*tx.word_hashes(*tx.texts(part.column(text_col))), items, coverage))


def _matcher(items: Items, coverage: float, item_type):
    id_type = to_arrow_type(item_type)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tx.chunks(batch, "t"):
                found = _covered(part, "t", items, coverage)
                if found:
                    t, o, c = zip(*found)
                    yield pa.RecordBatch.from_arrays(
                        [
                            part.column("i").take(pa.array(t, pa.int64())),
                            pa.array([items.ids[k] for k in o], id_type),
                            pa.array([len(items.words[k]) for k in o], pa.int64()),
                            pa.array(c, pa.int64()),
                        ],
                        ["i", "item", "item_words", "covered"],
                    )

    return run


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    min_match: int = 5,
    coverage: float = 0.5,
    block_bytes: int = 32 << 20,
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """The rows of ``docs`` that hold no test item, all columns kept; each row is judged by its own text."""

    def keep(items: Items):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in tx.chunks(batch, text_col):
                    clean = np.ones(part.num_rows, bool)
                    clean[[t for t, _, _ in _covered(part, text_col, items, coverage)]] = False
                    yield part.filter(pa.array(clean))

        return run

    for block in _blocks(benchmark.select(item_id, item_text), block_bytes):
        docs = docs.mapInArrow(keep(Items.of(block, min_match)), docs.schema)
    return docs
