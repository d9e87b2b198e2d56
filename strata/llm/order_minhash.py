"""Near-duplicate classes by Order MinHash, verified by banded alignment.

A document is its row of five-word shingles, and each shingle carries how often
it has occurred before. A sketch holds the two shingles with the smallest
hashes, in the order in which they stand in the text, so it is sensitive to
moved text where a plain MinHash is not. Two sketches make a band;
documents that share a band are candidates. Two documents are linked if
similarity = L / (n + m - L) is ``threshold`` or more, where n and m are their
numbers of shingles and L is the length of the longest common subsequence,
found by an alignment within the band of diagonals that the threshold allows.

Equal texts are one node from the start. Of a bucket of more than ``SMALL``
candidates the member that shares most buckets with others, counted over the
whole table (an original has more than its copies), is compared with all
members; a group of copies has mostly one such hub in all its buckets, so it
costs about one comparison a copy. Members of one class need no further one. Then
buckets of up to ``SMALL`` members are compared in full, as far as their members
are in different classes, and in larger ones the first member outside the hub's
class is a second hub. The members of larger buckets that are then still in different
classes, such as many copies that differ too much from each other, meet by a
prefix filter: each orders its shingles from the rarest among these members to
the most common, and two documents that reach the threshold must share one of
their first ones, at places that their lengths allow. So every pair of a bucket
that could join two classes is compared, and pairs that cannot hardly ever are.

Defined cases: null and empty texts are equal; texts without words link only
when equal; a text with fewer than five words has one shingle; a class has the
smallest id of its members; a null id takes the class of an equal text that has
one, else null; rows that repeat an id are one document; empty tables give an
empty result.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.components import components
from strata.llm.support import give_back, in_slices, mix, shingles_of, words_of, written

SHINGLE = 5
SKETCHES = 40
ROWS = 2
#: Members of a bucket that is compared in full.
SMALL = 5
_U = np.uint64
_LAST = _U(0xFFFFFFFFFFFFFFFF)


def _occurrences(shingles: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """How often each shingle stands before in its own document."""
    key = mix(shingles ^ mix(doc.astype(_U)))
    order = np.argsort(key, kind="stable")
    new = np.append(True, np.diff(key[order]) != 0)
    out = np.empty(len(key), _U)
    begins = np.flatnonzero(new)
    out[order] = np.arange(len(key)) - np.repeat(begins, np.diff(np.append(begins, len(key))))
    return out


def _first_of(found: np.ndarray, begins: np.ndarray) -> np.ndarray:
    return found[np.searchsorted(found, begins)]


def band_keys(shingles: np.ndarray, begin: np.ndarray, sketches: int = SKETCHES, rows: int = ROWS) -> np.ndarray:
    """One row of band keys for each document with shingles."""
    n = np.diff(begin)
    has = np.flatnonzero(n)
    starts, doc = begin[:-1][has], np.repeat(np.arange(len(has)), n[has])
    base = mix(shingles ^ mix(_occurrences(shingles, doc) + _U(1)))
    seeds = mix(np.arange(1, sketches + 1, dtype=_U)) | _U(1)
    out = np.empty((len(has), sketches), _U)
    for s, seed in enumerate(seeds):
        value = base * seed
        low = np.minimum.reduceat(value, starts)
        at = _first_of(np.flatnonzero(value == low[doc]), starts)
        value[at] = _LAST
        second = np.minimum.reduceat(value, starts)
        at2 = _first_of(np.flatnonzero(value == second[doc]), starts)
        ahead = at <= at2
        out[:, s] = mix(mix(np.where(ahead, low, second)) + np.where(ahead, second, low))
    keys = np.zeros((len(has), sketches // rows), _U)
    for r in range(rows):
        keys = mix(keys + out[:, r::rows])
    return keys.view(np.int64)


def common_length(a: list, b: list, width: int) -> int:
    """Longest common subsequence of two rows, within ``width`` diagonals of the main one.

    One integer holds a column of the alignment, a bit for each place of ``a``
    in the band; a cleared bit is a place where the common length grows.
    """
    head = 0
    while head < min(len(a), len(b)) and a[head] == b[head]:
        head += 1
    a, b = a[head:], b[head:]
    tail = 0
    while tail < min(len(a), len(b)) and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    a, b = a[: len(a) - tail], b[: len(b) - tail]
    places = defaultdict(list)
    for i, x in enumerate(a):
        places[x].append(i)
    low, high, column, done = 0, min(len(a), width), 0, 0
    column = (1 << high) - 1
    for j, x in enumerate(b):
        if j > width and low < len(a):
            done += not column & 1
            column >>= 1
            low += 1
        if high < len(a):
            column |= 1 << (high - low)
            high += 1
        match = 0
        for i in places.get(x, ()):
            if low <= i < high:
                match |= 1 << (i - low)
        if match:
            both = column & match
            column = ((column + both) | (column - both)) & ((1 << (high - low)) - 1)
    return head + tail + done + (high - low) - column.bit_count()


def shingle_rows(text: str) -> tuple[list[int], np.ndarray]:
    """A text's shingles in order, and the set of them labelled by occurrence."""
    words, first = words_of([text])
    row, _ = shingles_of(words, first, SHINGLE)
    return row.tolist(), np.sort(mix(row ^ mix(_occurrences(row, np.zeros(len(row), np.int64)) + _U(1))))


def similarity(a: list, b: list, threshold: float) -> float:
    """L / (n + m - L) if that is ``threshold`` or more, else some smaller value."""
    total = len(a) + len(b)
    if not a or not b or min(len(a), len(b)) < threshold * max(len(a), len(b)) - 1e-9:
        return 0.0
    common = common_length(a, b, math.floor(total * (1 - threshold) / (1 + threshold) + 1e-9) + 1)
    return common / (total - common)


def _checked(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) with ``linked``."""

    def check(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[int, tuple] = {}
        for frame in frames:
            linked = []
            for a, ta, tb in zip(frame["a"], frame["text_a"], frame["text_b"]):
                if a not in seen:
                    if len(seen) >= 64:
                        seen.clear()
                    seen[a] = shingle_rows(ta)
                (row_a, set_a), (row_b, set_b) = seen[a], shingle_rows(tb)
                # what is common without regard to order bounds what is common in order
                common = len(row_a) + len(row_b) - len(np.setxor1d(set_a, set_b, assume_unique=True))
                possible = common >= 2 * threshold / (1 + threshold) * (len(row_a) + len(row_b)) - 1e-6
                linked.append(possible and similarity(row_a, row_b, threshold) >= threshold - 1e-12)
            yield frame[["a", "b"]].assign(linked=linked)
        give_back()

    full = pairs.join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b").join(
        texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a"
    )
    return full.select("a", "b", "text_a", "text_b").mapInPandas(check, "a long, b long, linked boolean")


def _could_link(nodes: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """(a, b): of the ``nodes`` (node, root), all pairs with different roots that share enough shingles for the threshold.

    Linked sets of n and m shingles differ in at most r(n + m) of them, with r as
    below. In any common order their first common shingle then has at most
    (n - m + r(n + m)) / 2 others before it in the one and (m - n + r(n + m)) / 2 in
    the other; shingles that no other node has come first and are only counted.
    """
    r = (1 - threshold) / (1 + threshold)

    def sets(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            marks = [shingle_rows(t)[1].view(np.int64) for t in frame["text"]]
            yield frame[["node", "root"]].assign(n=[len(m) for m in marks], marks=marks)

    own = texts.join(nodes, "node").select("node", "root", "text").mapInPandas(sets, "node long, root long, n long, marks array<long>")
    marks = written(own, "omh-sets").select("node", "root", "n", F.explode("marks").alias("mark"))
    shared = marks.join(marks.groupBy("mark").agg(F.count("*").alias("among")).where("among > 1"), "mark")
    rows = shared.groupBy("node", "root", "n").agg(F.sort_array(F.collect_list(F.struct("among", "mark"))).alias("marks"))
    rows = rows.withColumn("alone", F.col("n") - F.size("marks"))
    most = F.floor(F.col("n") * (1 - threshold) + 1e-6).cast("long") + 1 - F.col("alone")
    first = F.slice("marks", 1, F.greatest(most, F.lit(0)).cast("int"))
    first = rows.select("node", "root", "n", "alone", F.posexplode(first).alias("at", "mark"))
    first = written(first.select("node", "root", "n", (F.col("at") + F.col("alone")).alias("at"), "mark.mark"), "omh-first")
    # the most common root of a shingle does not meet itself
    main = first.groupBy("mark", "root").count().groupBy("mark").agg(F.max(F.struct("count", "root")).alias("main"), F.count("*").alias("roots"))
    main = main.where("roots > 1").select("mark", F.col("main.root").alias("main"))
    left = first.join(main, "mark").where("root <> main").select("mark", *(F.col(c).alias(f"{c}_x") for c in ("node", "root", "n", "at")))
    right = first.select("mark", *(F.col(c).alias(f"{c}_y") for c in ("node", "root", "n", "at")))
    apart = r * (F.col("n_x") + F.col("n_y")) + 1e-6
    near = (2 * F.col("at_x") <= F.col("n_x") - F.col("n_y") + apart) & (2 * F.col("at_y") <= F.col("n_y") - F.col("n_x") + apart)
    met = left.withColumnRenamed("mark", "mark_x").join(right, (F.col("mark_x") == F.col("mark")) & (F.col("root_x") != F.col("root_y")) & near)
    return met.select(F.least("node_x", "node_y").alias("a"), F.greatest("node_x", "node_y").alias("b")).distinct()


def _buckets(members: DataFrame) -> DataFrame:
    """(node, band, key) with the size of each bucket that has several members, and each node's weight."""
    sizes = members.groupBy("band", "key").agg(F.count("*").alias("size")).where("size > 1")
    members = written(members.join(sizes, ["band", "key"]), "omh-members")
    weight = members.groupBy("node").agg(F.sum("size").alias("weight"))
    return written(members.join(weight, "node"), "omh-buckets")


def _first_members(members: DataFrame, *keep: str) -> DataFrame:
    """Of each bucket the member of largest weight. The limit on the row number cuts every bucket to it before the shuffle."""
    order = Window.partitionBy("band", "key").orderBy(F.desc("weight"), "node")
    return members.withColumn("n", F.row_number().over(order)).where(F.col("n") == 1).select("band", "key", "node", *keep)


def _pairs(met: DataFrame) -> DataFrame:
    """(a, b) with a < b, each once, of rows (x, y)."""
    return met.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def near_duplicates(
    df: DataFrame, threshold: float = 0.8, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """id, class_id, n_copies (rows with this very text) for each row of ``df``."""
    kind = dict(df.dtypes)[id_col]
    rows = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    hashed = rows.withColumn("same", F.unhex(F.sha2("text", 256)))

    def sketch(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            texts, keys = frame["text"].tolist(), [[] for _ in range(len(frame))]
            for a, b in in_slices(texts):
                shingles, begin = shingles_of(*words_of(texts[a:b]), SHINGLE)
                if len(shingles):
                    for i, k in zip(np.flatnonzero(np.diff(begin)) + a, band_keys(shingles, begin)):
                        keys[i] = k
            yield frame[["id", "same"]].assign(bands=keys)
        give_back()

    sketched = written(hashed.mapInPandas(sketch, f"id {kind}, same binary, bands array<long>"), "omh-sketches")
    first = F.struct(F.col("id").isNull().alias("none"), "id", "bands")
    nodes = sketched.groupBy("same").agg(F.min(first).alias("n"), F.count("*").alias("n_copies"))
    # numbers of the different texts: written, they stay what they are
    nodes = written(nodes.select("same", "n_copies", "n.id", "n.bands", F.monotonically_increasing_id().alias("node")), "omh-nodes")
    members = nodes.select("node", F.posexplode("bands").alias("band", "key"))
    members = _buckets(members)
    wanted = nodes.join(members.select("node").distinct(), "node").select("node", F.col("same").alias("n_same"), F.col("id").alias("n_id"))
    texts = hashed.join(wanted, (F.col("same") == F.col("n_same")) & F.col("id").eqNullSafe(F.col("n_id")))
    texts = written(texts.groupBy("same", "id").agg(F.min("node").alias("node"), F.min("text").alias("text")).select("node", "text"), "omh-texts")

    # rows that repeat an id with another text are one document
    repeated = sketched.where("id is not null").groupBy("id").agg(F.min("same").alias("low"), F.max("same").alias("high"))
    repeated = sketched.join(repeated.where("low <> high").select("id", "low"), "id").select("same", "low").distinct()
    repeated = repeated.join(nodes.select("same", F.col("node").alias("a")), "same").join(
        nodes.select(F.col("same").alias("low"), F.col("node").alias("b")), "low"
    )
    edges = written(repeated.select("a", "b"), "omh-edges")
    seen, roots = None, None

    def compared(pairs: DataFrame) -> None:
        nonlocal edges, seen, roots
        found = written(_checked(pairs, texts, threshold), "omh-checked")
        seen = found.select("a", "b") if seen is None else seen.union(found.select("a", "b"))
        edges = edges.union(found.where("linked").select("a", "b"))
        roots = components(edges).withColumnRenamed("id", "node")

    large, small = (members.where(F.col("size") > SMALL), members.where(F.col("size") <= SMALL))
    hubs = written(_first_members(large).withColumnRenamed("node", "hub"), "omh-hubs")
    compared(_pairs(large.select("band", "key", "node").join(hubs, ["band", "key"]).where("node <> hub").select(F.col("node").alias("x"), F.col("hub").alias("y"))))

    def rooted_members(some: DataFrame) -> DataFrame:
        return some.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))

    def still_mixed(some: DataFrame) -> DataFrame:
        mixed = some.groupBy("band", "key").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high")
        return some.join(mixed.select("band", "key"), ["band", "key"])

    near = written(still_mixed(rooted_members(small)).select("band", "key", "node", "root"), "omh-small")
    others = near.select("band", "key", F.col("node").alias("other"), F.col("root").alias("other_root"))
    few = near.join(others, ["band", "key"]).where("node < other and root <> other_root").select(F.col("node").alias("x"), F.col("other").alias("y"))
    mixed = written(still_mixed(rooted_members(large)).select("band", "key", "node", "root", "weight"), "omh-mixed")
    hub_roots = rooted_members(hubs.withColumnRenamed("hub", "node")).select("band", "key", F.col("root").alias("hub_root"))
    second = _first_members(mixed.join(hub_roots, ["band", "key"]).where("root <> hub_root"), "root")
    second = second.select("band", "key", F.col("node").alias("hub"), F.col("root").alias("hub_root"))
    more = mixed.join(second, ["band", "key"]).where("root <> hub_root").select(F.col("node").alias("x"), F.col("hub").alias("y"))
    compared(_pairs(few.union(more)).join(seen, ["a", "b"], "left_anti"))

    apart = written(still_mixed(rooted_members(large)).select("node", "root").distinct(), "omh-apart")
    compared(written(_could_link(apart, texts, threshold).join(seen, ["a", "b"], "left_anti"), "omh-pairs"))
    rooted = nodes.select("same", "n_copies", "id", "node").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    classes = rooted.groupBy("root").agg(F.min("id").alias("class_id"))
    named = rooted.join(classes, "root").select("same", "n_copies", "class_id")
    return sketched.select("id", "same").join(named, "same").select(F.col("id").alias(id_col), "class_id", "n_copies")


def keep_one(df: DataFrame, threshold: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The row of each class whose id is the class's; of rows that repeat an id, all. Rows without id stay."""
    found = near_duplicates(df, threshold, id_col, text_col)
    gone = found.where(F.col("class_id") != F.col(id_col)).select(F.col(id_col).alias("_gone")).distinct()
    return df.join(gone, F.col(id_col) == F.col("_gone"), "left_anti")
