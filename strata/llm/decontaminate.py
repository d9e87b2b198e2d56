"""Benchmark passages in documents: SimHash windows, Hamming blocks, exact check.

For every benchmark item, windows of as many words as the item has slide over
every document, word by word. A window's SimHash adds up, bit by bit, the votes
of its weighted shingles (runs of five words; a shingle's weight is how often
the window holds it). Fingerprints are cut into ``BLOCKS`` blocks of 16 bits: two
that differ in at most ``radius`` bits differ in at most radius // BLOCKS bits
in some block, so comparing each block on its own finds every item within the
radius. What is found is then compared exactly:
similarity = sum of min / sum of max of the shingles' weights, which has to be
``threshold`` or more.

A window without any shingle of an item has similarity 0 to it, so an index of
the items' shingles says which documents, which windows and which items are
looked at; fingerprints then choose among these pairs. An item of fewer than
``WEAK`` different shingles, such as a phrase that repeats itself, has a fingerprint
that one shingle more or less may turn over; its windows are all compared
exactly. With ``WEAK`` and more the radius of 23 is over four standard deviations
beyond what windows of similarity 0.8 differ in.

Windows are compared by counts that slide along, one shingle in and one out, so
a document takes time by its length and the items that share shingles with it,
and memory by its length.

Items are taken ``item_block_bytes`` at a time; what executors get of them never
exceeds that, however large the benchmark is.

Defined cases: null or empty texts and items match nothing; an item with fewer
than five words has one shingle, all of it, and is matched by windows of as many
words; documents shorter than an item are compared as a whole; equal items each
match; of equally similar windows the first is reported; repeated rows are
judged each; empty tables give an empty result, or one in which nothing matches.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.support import in_slices, shingles_of, words_of

SHINGLE = 5
BLOCKS = 4
RADIUS = 23
THRESHOLD = 0.8
#: Different shingles that an item needs for its fingerprint to say something.
WEAK = 16


def simhash_windows(shingles: np.ndarray, begin: np.ndarray, n: int) -> np.ndarray:
    """Fingerprints of the windows of ``n`` shingles that start at ``begin``."""
    bits = np.unpackbits(shingles.view(np.uint8).reshape(-1, 8), axis=1).astype(np.int32) * 2 - 1
    total = np.vstack([np.zeros((1, 64), np.int32), np.cumsum(bits, axis=0, dtype=np.int32)])
    return np.packbits(total[begin + n] - total[begin] > 0, axis=1).view(np.uint64).ravel()


def similarity(a: Counter, b: Counter) -> float:
    low = sum((a & b).values())
    high = a.total() + b.total() - low
    return low / high if high else 0.0


@dataclass
class ItemIndex:
    """Benchmark items by their number of words, and the block index over their fingerprints."""

    ids: list
    words: list[int]
    counts: list[Counter]
    hashes: np.ndarray  # all items' shingles in order, each once
    owner_begin: np.ndarray  # where the items of each shingle begin in owners
    owners: np.ndarray
    prints: np.ndarray
    by_size: dict[int, np.ndarray]

    @classmethod
    def of(cls, rows: list[tuple]) -> ItemIndex:
        """``rows``: (item, text), in which every text has a word."""
        words, first = words_of([t for _, t in rows])
        shingles, begin = shingles_of(words, first, SHINGLE)
        sizes = np.diff(first)
        parts = [shingles[a:b] for a, b in zip(begin, begin[1:])]
        prints = np.array([simhash_windows(p, np.zeros(1, int), len(p))[0] for p in parts], np.uint64)
        by_size = {int(s): np.flatnonzero(sizes == s) for s in np.unique(sizes)}
        hashes, back = np.unique(shingles, return_inverse=True)
        pairs = np.unique(back * len(parts) + np.repeat(np.arange(len(parts)), np.diff(begin)))
        owner_begin = np.searchsorted(pairs // len(parts), np.arange(len(hashes) + 1))
        counts = [Counter(p.tolist()) for p in parts]
        return cls([i for i, _ in rows], sizes.tolist(), counts, hashes, owner_begin, pairs % len(parts), prints, by_size)

    def shared(self, shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place, item) of all shingles that items have."""
        at = np.minimum(np.searchsorted(self.hashes, shingles), len(self.hashes) - 1)
        place = np.flatnonzero(self.hashes[at] == shingles)
        low, high = self.owner_begin[at[place]], self.owner_begin[at[place] + 1]
        n = high - low
        items = self.owners[np.repeat(low - np.cumsum(n) + n, n) + np.arange(n.sum())]
        return np.repeat(place, n), items

    def within(self, prints: np.ndarray, items: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """(window, item) of all pairs whose fingerprints differ in at most ``radius`` bits."""
        flips = radius // BLOCKS
        theirs = self.prints[items]
        pairs = []
        for b in range(BLOCKS):
            part = ((prints >> np.uint64(16 * b)) & np.uint64(0xFFFF)).astype(np.uint16)
            values, back = np.unique(part, return_inverse=True)
            own = ((theirs >> np.uint64(16 * b)) & np.uint64(0xFFFF)).astype(np.uint16)
            order = np.argsort(back, kind="stable")
            ends = np.searchsorted(back[order], np.arange(len(values) + 1))
            for j, value in enumerate(own):
                # the values of this block within reach of the item's, then their windows
                for v in np.flatnonzero(np.bitwise_count(values ^ value) <= flips):
                    pairs.append(order[ends[v] : ends[v + 1]] * len(items) + j)
        if not pairs:
            return np.empty(0, int), np.empty(0, int)
        at, j = np.divmod(np.unique(np.concatenate(pairs)), len(items))
        near = np.bitwise_count(prints[at] ^ theirs[j]) <= radius
        return at[near], items[j[near]]


def _covering(places: np.ndarray, n: int, count: int) -> np.ndarray:
    """Begins, of ``count``, of the windows of ``n`` places that hold one of ``places``, ascending."""
    change = np.zeros(count + 1, np.int64)
    np.add.at(change, np.clip(places - n + 1, 0, count), 1)
    np.add.at(change, np.clip(places + 1, 0, count), -1)
    return np.flatnonzero(np.cumsum(change[:-1]) > 0)


def _best_window(own: list[int], begins: list[int], n: int, wanted: Counter) -> tuple[float, int]:
    """The largest similarity of the windows at the ascending ``begins`` to ``wanted``, and the first window that has it."""
    total, best = wanted.total() + n, (0, 0)
    held: Counter[int] = Counter()
    common, at = 0, None
    for begin in begins:
        if at is None or begin - at >= n:  # nothing of the window before is left
            held = Counter(own[begin : begin + n])
            common = (held & wanted).total()
        else:
            for k in range(at, begin):
                out, new = own[k], own[k + n]
                if held[out] <= wanted.get(out, 0):
                    common -= 1
                held[out] -= 1
                held[new] += 1
                if held[new] <= wanted.get(new, 0):
                    common += 1
        at = begin
        if common > best[0]:  # the similarity grows with what is common
            best = (common, begin)
    return best[0] / (total - best[0]), best[1]


def _matches(index: ItemIndex, words: np.ndarray, radius: int, threshold: float) -> dict[int, tuple[float, int]]:
    """Best (similarity, first word) of each item found in one document."""
    best: dict[int, tuple[float, int]] = {}
    sizes = np.array(index.words)
    # an item shorter than a shingle is one shingle of its own length
    for length in {SHINGLE, *(s for s in index.by_size if s < SHINGLE)}:
        own, _ = shingles_of(words, np.array([0, len(words)]), length)
        row = own.tolist()
        place, item = index.shared(own)
        right = np.minimum(sizes[item], SHINGLE) == length
        place, item = place[right], item[right]
        for size in np.unique(sizes[item]).tolist():
            here = sizes[item] == size
            n = max(1, min(size, len(words)) - length + 1)
            begins = _covering(np.unique(place[here]), n, len(own) - n + 1)
            if not len(begins):
                continue
            items = np.unique(item[here])
            weak = np.array([len(index.counts[j]) < WEAK for j in items])
            near: dict[int, np.ndarray] = {int(j): _covering(np.unique(place[here & (item == j)]), n, len(own) - n + 1) for j in items[weak]}
            if not weak.all():
                # only the stretch around the shared shingles is added up
                low, high = int(begins[0]), int(begins[-1]) + n
                prints = simhash_windows(own[low:high], begins - low, n)
                at, found = index.within(prints, items[~weak], radius)
                order = np.argsort(found, kind="stable")
                at, found = at[order], found[order]
                edge = np.flatnonzero(np.append(True, found[1:] != found[:-1])) if len(found) else []
                near |= {int(found[a]): np.sort(begins[at[a:b]]) for a, b in zip(edge, [*edge[1:], len(found)])}
            for j, some in near.items():
                value, begin = _best_window(row, some.tolist(), n, index.counts[j])
                if value >= threshold and value > best.get(j, (0.0, 0))[0]:
                    best[j] = (value, begin)
    return best


class _Finder:
    """Finds the documents that share a shingle with an item, and matches those."""

    def __init__(self, index: ItemIndex, radius: int, threshold: float):
        self.index, self.radius, self.threshold = index, radius, threshold
        self.lengths = [SHINGLE, *(s for s in index.by_size if s < SHINGLE)]
        self.marks = np.zeros(1 << 22, bool)
        self.marks[self._slot(index.hashes)] = True

    def _slot(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes & np.uint64(len(self.marks) - 1)).astype(np.int64)

    def find(self, texts: list[str | None]) -> Iterator[tuple[int, int, float, int]]:
        """(row, item number, similarity, first word)"""
        for a, b in in_slices(texts):
            words, first = words_of(texts[a:b])
            shares = np.zeros(b - a, bool)
            for length in self.lengths:
                shingles, begin = shingles_of(words, first, length)
                hit = np.flatnonzero(self.marks[self._slot(shingles)])
                hit = hit[np.isin(shingles[hit], self.index.hashes)]
                shares[np.searchsorted(begin, hit, "right") - 1] = True
            for i in np.flatnonzero(shares):
                best = _matches(self.index, words[first[i] : first[i + 1]], self.radius, self.threshold)
                for item, (value, at) in best.items():
                    yield a + int(i), item, value, at


def _item_blocks(benchmark: DataFrame, id_col: str, text_col: str, most: int) -> Iterator[list[tuple]]:
    """Items of at most ``most`` bytes together, or one."""
    block, size = [], 0
    rows = benchmark.select(id_col, text_col).where(F.length(text_col) > 0)
    for item, text in rows.toLocalIterator():
        if size and size + len(text) > most:
            yield block
            block, size = [], 0
        if len(words_of([text])[0]):
            block.append((item, text))
            size += len(text)
    if block:
        yield block


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    threshold: float = THRESHOLD,
    radius: int = RADIUS,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    item_block_bytes: int = 8 << 20,
) -> DataFrame:
    """id, item id, similarity, first_word for each document and item of which it holds a window."""
    kind, item_kind = dict(docs.dtypes)[id_col], dict(benchmark.dtypes)[item_id_col]
    schema = f"id {kind}, item {item_kind}, similarity double, first_word int"
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def search(index: ItemIndex) -> DataFrame:
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            finder = _Finder(shared.value, radius, threshold)
            for frame in frames:
                ids = frame["id"].tolist()
                out = [(ids[i], finder.index.ids[j], value, at) for i, j, value, at in finder.find(frame["text"].tolist())]
                yield pd.DataFrame(out, columns=["id", "item", "similarity", "first_word"])

        return rows.mapInPandas(run, schema)

    found = [search(ItemIndex.of(block)) for block in _item_blocks(benchmark, item_id_col, item_text_col, item_block_bytes)]
    if not found:
        found = [docs.sparkSession.createDataFrame([], schema)]
    return reduce(DataFrame.unionByName, found).withColumnsRenamed({"id": id_col, "item": item_id_col})


def drop_contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    threshold: float = THRESHOLD,
    radius: int = RADIUS,
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    item_block_bytes: int = 8 << 20,
) -> DataFrame:
    """The rows of ``docs`` that hold no window of any item, with all their columns."""

    def without(docs: DataFrame, index: ItemIndex) -> DataFrame:
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            finder = _Finder(shared.value, radius, threshold)
            for batch in batches:
                keep = np.ones(batch.num_rows, bool)
                keep[[i for i, *_ in finder.find(batch[text_col].to_pylist())]] = False
                yield batch.filter(pa.array(keep))

        return docs.mapInArrow(run, docs.schema)

    blocks = _item_blocks(benchmark, item_id_col, item_text_col, item_block_bytes)
    return reduce(without, map(ItemIndex.of, blocks), docs)
