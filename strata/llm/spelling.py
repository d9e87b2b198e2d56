"""Groups of spelling variants: words that differ by one inserted, deleted or replaced letter.

The vocabulary is a trie of frequency vectors: a word's length, then how many of its
letters belong to each group of ``GROUPS``, one group a level. Two words that
differ by one edit have vectors that differ by one at most upwards (surplus)
and by one at most downwards (deficit). So a word goes down the trie depth first
with a budget of one each and reaches the leaves whose words can be near it;
these are verified letter by letter. In a leaf of more than ``CROWD`` words only
those that share the first or the last half with the word are verified: an edit
leaves one half as it is.

The trie is spread over tasks by its top levels. A stored word lies in the part
of its own top levels; a searching word goes to the parts that its budget can
reach there. As many levels count as top levels as are needed to have at most
``PART`` words below any of them, and there is a part for every ``PART / 2`` words.

A word's form is its near word of largest count, if that is at least ``ratio``
times its own; its root is found by following forms, doubling the steps.

Defined cases: null and empty texts have no words; a null id counts as an empty
one in ``damaged_words``; ties for a form go to the smaller word in code-point
order; repeated rows are counted each; an empty table gives an empty result.
Columns other than id and text are not looked at.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.support import written

#: Letters that count together, common ones first; letters in no group make the last one.
GROUPS = ("e", "a", "i", "n", "s", "r", "t", "o", "l", "ud", "cmp", "gbfhv", "jkqwxyz")
PART = 16384
CROWD = 64
#: States of the search, and letters of pairs, that are in hand at once.
STATES = 1 << 16
LETTERS = 1 << 21
#: Different words that a task holds before it passes its counts on.
HELD = 300_000
RUNS = re.compile("[A-Za-zÀ-ÿ]+")
_ASCII_LOWER = {c: c + 32 for c in range(65, 91)}


def lowered(run: str) -> str:
    """A-Z in lower case, all else as it is."""
    return run.lower() if run.isascii() else run.translate(_ASCII_LOWER)


def damaged_words(df: DataFrame, every: int = 97, least_length: int = 5, least_count: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """word, n: the runs of letters in all texts, of which every ``every``-th (id, run) loses a letter, both by crc32."""
    rows = df.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.col(text_col).alias("text"))

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: Counter[str] = Counter()
        for frame in frames:
            for i, text in zip(frame["id"], frame["text"]):
                own: Counter[str] = Counter()
                for run, n in Counter(RUNS.findall(text or "")).items():
                    if len(run) >= least_length:
                        own[lowered(run)] += n
                start = zlib.crc32(f"{i}:".encode())
                for word, n in own.items():
                    h = zlib.crc32(word.encode(), start)
                    if h % every == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1 :]
                        if len(word) < least_length:
                            continue
                    total[word] += n
                if len(total) >= HELD:
                    yield pd.DataFrame({"word": list(total), "n": list(total.values())})
                    total.clear()
        if total:
            yield pd.DataFrame({"word": list(total), "n": list(total.values())})

    parts = rows.mapInPandas(count, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def vectors(words: list[str]) -> np.ndarray:
    """Length and letter counts of each group, a row for each word."""
    sizes = np.array([len(w) for w in words], np.int64)
    codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    group = np.full(max(256, int(codes.max(initial=0)) + 1), len(GROUPS))
    for g, letters in enumerate(GROUPS):
        group[[ord(c) for c in letters]] = g
    wide = len(GROUPS) + 1
    row = np.repeat(np.arange(len(words)), sizes)
    counts = np.bincount(row * wide + group[codes], minlength=len(words) * wide).reshape(-1, wide)
    return np.hstack([sizes[:, None], counts])


def reachable(vector: np.ndarray, top: int) -> np.ndarray:
    """The top levels (length and ``top`` groups) of words as long or one longer that the budget allows; -1 where a count is impossible."""
    steps = [(0, np.zeros(top, np.int64))]
    one = np.eye(top, dtype=np.int64)
    steps += [(0, u) for u in one] + [(0, -u) for u in one]
    steps += [(0, one[i] - one[j]) for i in range(top) for j in range(top) if i != j]
    steps += [(1, np.zeros(top, np.int64))] + [(1, u) for u in one]
    add = np.array([[longer, *step] for longer, step in steps])
    return vector[:, None, : top + 1] + add[None]


def _part_numbers(tops: np.ndarray, parts: int) -> np.ndarray:
    h = np.zeros(tops.shape[:-1], np.uint64)
    for level in range(tops.shape[-1]):
        h = (h ^ tops[..., level].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return (h % np.uint64(parts)).astype(np.int64)


class Trie:
    """Frequency vectors of some words: for each level the (parent, count) of its nodes, ascending."""

    def __init__(self, words: list[str]):
        rows = vectors(words)
        order = np.lexsort(rows.T[::-1])
        self.words, rows = [words[i] for i in order], rows[order]
        self.span = int(rows.max(initial=0)) + 2
        self.levels, node = [], np.zeros(len(rows), np.int64)
        for level in range(rows.shape[1]):
            key = node * self.span + rows[:, level]
            self.levels.append(key[np.append(True, key[1:] != key[:-1])] if len(key) else key)
            node = np.searchsorted(self.levels[-1], key)
        self.begins = np.searchsorted(node, np.arange(node.max(initial=-1) + 2))

    def leaves(self, words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(word, leaf, longer) in batches: the leaves that each of ``words`` reaches, of words as long (0) or one longer (1)."""
        rows = vectors(words)
        begin = np.arange(len(words))
        # word, node, surplus and deficit left, longer
        start = [np.concatenate([begin, begin]), np.zeros(2 * len(words), np.int64), np.ones(2 * len(words), np.int64), np.repeat([1, 0], len(words)), np.repeat([0, 1], len(words))]
        stack = [(0, start)]
        while stack:
            level, (word, node, more, less, longer) = stack.pop()
            if len(word) > STATES:
                half = len(word) // 2
                stack += [(level, [x[half:] for x in (word, node, more, less, longer)]), (level, [x[:half] for x in (word, node, more, less, longer)])]
                continue
            if level == len(self.levels):
                # what was spent must be what the lengths differ in
                done = (1 - more) - np.where(longer == 1, 0, 1 - less) == longer
                yield word[done], node[done], longer[done]
                continue
            found = []
            for step in (0, 1, -1) if level else (0,):
                able = np.flatnonzero(more > 0) if step == 1 else np.flatnonzero(less > 0) if step == -1 else np.arange(len(word))
                want = rows[word[able], level] + (step if level else longer[able])
                able, want = able[want >= 0], want[want >= 0]
                able, want = able[want < self.span], want[want < self.span]
                key = node[able] * self.span + want
                at = np.searchsorted(self.levels[level], key)
                hit = np.append(self.levels[level], -1)[at] == key
                able, at = able[hit], at[hit]
                found.append((word[able], at, more[able] - (step == 1), less[able] - (step == -1), longer[able]))
            stack.append((level + 1, [np.concatenate(x) for x in zip(*found)]))

    def near(self, words: list[str]) -> Iterator[tuple[int, int]]:
        """(number of a word, number in ``self.words``): all that are one edit apart and as long or longer than the word."""
        own, theirs = _Letters(words), _Letters(self.words)
        for word, leaf, longer in self.leaves(words):
            size = self.begins[leaf + 1] - self.begins[leaf]
            small = size <= CROWD
            n = size[small]
            at = np.repeat(self.begins[leaf[small]] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            yield from _verified(own, theirs, np.repeat(word[small], n), at, np.repeat(longer[small], n))
            for crowd in np.unique(leaf[~small]):
                here = ~small & (leaf == crowd)
                pairs = self._halves(words, word[here].tolist(), longer[here].tolist(), range(self.begins[crowd], self.begins[crowd + 1]))
                if pairs:
                    yield from _verified(own, theirs, *np.array(sorted(pairs)).T)

    def _halves(self, words: list[str], asking: list[int], longer: list[int], held: range) -> set[tuple[int, int, int]]:
        """(word, held word, longer) that share the first half of the word's length or the last one."""
        by = defaultdict(list)
        for more in set(longer):
            for y in held:
                n = len(self.words[y]) - more
                by[more, 0, self.words[y][: n - n // 2]].append(y)
                by[more, 1, self.words[y][len(self.words[y]) - n // 2 :]].append(y)
        out = set()
        for x, more in zip(asking, longer):
            n = len(words[x])
            for y in by.get((more, 0, words[x][: n - n // 2]), []) + by.get((more, 1, words[x][n - n // 2 :]), []):
                out.add((x, y, more))
        return out


class _Letters:
    """Code points of words, as a matrix for each length."""

    def __init__(self, words: list[str]):
        self.size = np.array([len(w) for w in words], np.int64)
        self.row, self.of = np.zeros(len(words), np.int64), {}
        for n in np.unique(self.size):
            at = np.flatnonzero(self.size == n)
            self.row[at] = np.arange(len(at))
            self.of[int(n)] = np.frombuffer("".join(words[i] for i in at).encode("utf-32-le"), np.uint32).reshape(len(at), n)


def _verified(own: _Letters, theirs: _Letters, x: np.ndarray, y: np.ndarray, longer: np.ndarray) -> Iterator[tuple[int, int]]:
    """The pairs that are one edit apart."""
    kind = 2 * own.size[x] + longer
    for n, more in (divmod(k, 2) for k in np.unique(kind).tolist()):
        here = np.flatnonzero(kind == 2 * n + more)
        for k in range(0, len(here), max(1, LETTERS // max(1, n))):
            at = here[k : k + max(1, LETTERS // max(1, n))]
            a, b = own.of[n][own.row[x[at]]], theirs.of[n + more][theirs.row[y[at]]]
            if more:
                ahead = np.cumprod(a == b[:, :n], axis=1, dtype=np.int8).sum(1, dtype=np.int64)
                behind = np.cumprod((a == b[:, 1:])[:, ::-1], axis=1, dtype=np.int8).sum(1, dtype=np.int64)
                good = ahead + behind >= n
            else:
                good = (a != b).sum(1) == 1
            yield from zip(x[at[good]].tolist(), y[at[good]].tolist())


def near_words(vocabulary: DataFrame) -> DataFrame:
    """(word, near, near_n): for each word of ``vocabulary`` (word, n; no word twice) all words one edit apart."""
    total = vocabulary.count()
    parts, top = max(1, -(-2 * total // PART)), 1

    def tops(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame({"top": [v.tobytes() for v in vectors(frame["word"].tolist()).astype(np.int32)]})

    # as bytes: a number of four for the length and for each group
    held = written(vocabulary.select("word").mapInPandas(tops, "top binary").groupBy("top").count(), "spelling-vectors") if total else None
    while held is not None and top < len(GROUPS):
        top += 1
        most = held.groupBy(F.substring("top", 1, 4 * (top + 1)).alias("top")).agg(F.sum("count").alias("n")).agg(F.max("n")).first()[0]
        if most <= PART:
            break

    def deal(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for k in range(0, len(frame), 4096):
                rows = frame.iloc[k : k + 4096]
                vector = vectors(rows["word"].tolist())
                yield rows.assign(part=_part_numbers(vector[:, : top + 1], parts), stored=True)
                goals = reachable(vector, top)
                able = (goals >= 0).all(2)
                key = np.arange(len(rows))[:, None] * parts + _part_numbers(goals, parts)
                at, part = np.divmod(np.unique(key[able]), parts)
                yield rows.iloc[at].assign(part=part, stored=False)

    def search(rows: pa.Table) -> pa.Table:
        stored, asking = rows.filter(rows["stored"]), rows.filter(pc.invert(rows["stored"]))
        trie, n = Trie(stored["word"].to_pylist()), dict(zip(stored["word"].to_pylist(), stored["n"].to_pylist()))
        words, own = asking["word"].to_pylist(), asking["n"].to_pylist()
        out = []
        for x, y in trie.near(words):
            near = trie.words[y]
            out.append((words[x], near, n[near]))
            if len(near) > len(words[x]):  # a longer word does not look for shorter ones
                out.append((near, words[x], own[x]))
        columns = zip(*out) if out else ([], [], [])
        return pa.table([pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.string(), pa.int64()))], names=["word", "near", "near_n"])

    dealt = vocabulary.select("word", "n").mapInPandas(deal, "word string, n long, part long, stored boolean")
    return dealt.groupBy("part").applyInArrow(search, "word string, near string, near_n long")


def spelling_groups(vocabulary: DataFrame, ratio: int = 2) -> DataFrame:
    """word, form, root, n, n_near, form_n for each row of ``vocabulary`` (word, n)."""
    vocabulary = written(vocabulary.select("word", "n"), "spelling-words")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("form")))
    near = near_words(vocabulary).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    chosen = vocabulary.join(near, "word", "left").withColumn("clear", F.coalesce(-F.col("best.less") >= ratio * F.col("n"), F.lit(False)))
    words = chosen.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(F.col("clear"), F.col("best.form")).alias("form"), F.when(F.col("clear"), -F.col("best.less")).alias("form_n"),
    )
    words = written(words, "spelling-forms")
    # counts at least double from form to form, so the chains are short and end
    roots = words.where("form is not null").select("word", F.col("form").alias("root"))
    while True:
        over = roots.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        step = written(roots.join(over, "root", "left").select("word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved")), "spelling-roots")
        roots = step.select("word", "root")
        if step.where("moved").isEmpty():
            break
    return words.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
