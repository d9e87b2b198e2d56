"""Toxicity scores from the nearest labelled examples by exact TF-IDF cosine.

The model is fitted on a bounded sample: per class the ``per_class`` labelled
rows with the smallest hash of their id, of texts up to ``example_bytes``. Terms
are the words of the examples, all of them; those whose presence does not depend
on the class (chi-squared below ``least_chi2``) weigh ``PLAIN`` of their TF-IDF,
unless no word's does, so that a telling word counts among hundreds of plain
ones. One more term stands for all words of a text that no example holds.
Document frequencies are counted over all documents.

The examples are ordered so that like ones stand together: halves of them are
split again and again along the direction in which they differ most. They lie
in an inverted index whose postings are cut into blocks of ``BLOCK`` neighbours,
each with its largest weight. A slice of texts is scored as sparse products:
first the telling words against all examples, and the plain words against the
blocks' largest weights, which bounds every block of every text. Then each text
visits blocks in the order of their bounds until no further one can hold one of
its ``k`` nearest examples, so the neighbours are exact. The vote is
sum(similarity x label) / (sum(similarity) + 0.5); a logistic curve, fitted on
the votes that the examples give each other and weighted to the classes' shares
among all labelled rows, turns it into a probability.

Texts of examples never reach the driver: tasks make word counts, vectors and
votes of them, and the driver keeps the index, which holds a number and a weight
for each different word of each example.

Defined cases: a null text, or one without a word, has vote 0 and the score of
that vote; an id with several labels counts as toxic if one
of them says so; null labels and ids teach nothing; without examples of both
classes every score is the share of toxic labels (0 without labels); ties
between neighbours go to the example that comes first in hash order; repeated
rows are scored each; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from strata.llm.support import give_back, in_slices, words_of, written

BLOCK = 64
PLAIN = 0.15
#: Texts times examples that are in hand at once.
CELLS = 1 << 18


def _ranges(begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the ranges in a row, and how many each range has."""
    n = end - begin
    return np.repeat(begin - (np.cumsum(n) - n), n) + np.arange(n.sum()), n


@dataclass
class ToxicityModel:
    terms: np.ndarray = field(default_factory=lambda: np.empty(0, np.uint64))  # sorted hashes
    idf: np.ndarray = field(default_factory=lambda: np.empty(0))
    telling: np.ndarray | None = None  # by term; the last stands for all other words
    ids: list = field(default_factory=list)
    labels: np.ndarray = field(default_factory=lambda: np.empty(0))
    k: int = 15
    curve: tuple[float, float] = (0.0, -40.0)
    # numbers of the examples in the order of the index; postings in order of (term, place in that order)
    place: np.ndarray | None = None
    post_at: np.ndarray | None = None
    post_weight: np.ndarray | None = None
    term_posts: np.ndarray | None = None
    # one entry for each term and block
    entry_block: np.ndarray | None = None
    entry_most: np.ndarray | None = None
    entry_begin: np.ndarray | None = None
    term_entries: np.ndarray | None = None

    def index(self, rows: np.ndarray, terms: np.ndarray, weights: np.ndarray) -> None:
        """``rows``, ``terms``, ``weights``: one item for each word of each example."""
        if self.telling is None:
            self.telling = np.zeros(len(self.terms) + 1, bool)
        n = len(self.labels)
        self.place = _like_together(rows, terms, weights, n, len(self.terms) + 1)
        at = np.empty(n, np.int32)
        at[self.place] = np.arange(n, dtype=np.int32)
        at = at[rows]
        order = np.lexsort((at, terms))
        t, e = terms[order], at[order]
        self.post_at, self.post_weight = e, weights[order]
        numbers = np.arange(len(self.terms) + 2)
        self.term_posts = np.searchsorted(t, numbers)
        block = e // BLOCK
        edge = np.flatnonzero(np.append(True, (t[1:] != t[:-1]) | (block[1:] != block[:-1]))) if len(t) else np.empty(0, int)
        self.entry_block = block[edge]
        self.entry_most = np.maximum.reduceat(self.post_weight, edge) if len(edge) else np.empty(0)
        self.entry_begin = np.append(edge, len(t))
        self.term_entries = np.searchsorted(t[edge], numbers)

    def nearest(self, terms: np.ndarray, weights: np.ndarray, but: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """Examples and cosines of the k nearest with a cosine above 0."""
        found, near, _ = self.nearest_to_each(np.zeros(len(terms), int), terms, weights, 1, np.array([but]))
        some = found[0] >= 0
        return found[0][some], near[0][some]

    def nearest_to_each(
        self, rows: np.ndarray, terms: np.ndarray, weights: np.ndarray, n: int, but: np.ndarray | None = None
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of ``n`` texts: the k nearest examples (-1: none), their cosines (0: none), and the blocks visited.

        ``rows`` ascend; ``but`` is an example that each text leaves out.
        """
        step, at = max(1, CELLS // max(1, len(self.labels))), _by_row(rows, n)
        but = np.full(n, -1) if but is None else but
        found, near, visits = np.full((n, self.k), -1), np.zeros((n, self.k)), np.zeros(n, int)
        for a in range(0, n if len(self.labels) else 0, step):
            b = min(n, a + step)
            here = slice(at[a], at[b])
            found[a:b], near[a:b], visits[a:b] = self._nearest(rows[here] - a, terms[here], weights[here], b - a, but[a:b])
        return found, near, visits

    def _nearest(self, rows, terms, weights, n, but):
        size = len(self.labels)
        blocks = -(-size // BLOCK)
        tell = self.telling[terms]
        post, m = _ranges(self.term_posts[terms[tell]], self.term_posts[terms[tell] + 1])
        cell = np.repeat(rows[tell], m) * (blocks * BLOCK) + self.post_at[post]
        exact = np.bincount(cell, np.repeat(weights[tell], m) * self.post_weight[post], n * blocks * BLOCK).reshape(n, blocks, BLOCK)
        # the plain words' entries, in order of (block, text): entries come in order of text
        plain = ~tell
        entry, m = _ranges(self.term_entries[terms[plain]], self.term_entries[terms[plain] + 1])
        text, share, block = np.repeat(rows[plain], m), np.repeat(weights[plain], m), self.entry_block[entry]
        bound = np.bincount(text * blocks + block, share * self.entry_most[entry], n * blocks).reshape(n, blocks)
        bound += exact.max(axis=2)
        order = np.argsort(block.astype(np.uint16), kind="stable")
        entry, share, key = entry[order], share[order], block[order].astype(np.int64) * n + text[order]
        turn = np.argsort(-bound, axis=1, kind="stable")
        best, best_id = np.full((n, self.k), -np.inf), np.full((n, self.k), size)
        visits, going = np.zeros(n, int), np.arange(n)
        for j in range(blocks):
            b = turn[going, j]
            most = bound[going, b]
            # a bound equal to the k-th cosine may still win a tie
            on = (most > 0) & (most >= best[going, -1] - 1e-9)
            going, b = going[on], b[on]
            if not len(going):
                break
            low, high = np.searchsorted(key, b * n + going), np.searchsorted(key, b * n + going, "right")
            at, m = _ranges(low, high)
            pair = np.repeat(np.arange(len(going)), m)
            post, m = _ranges(self.entry_begin[entry[at]], self.entry_begin[entry[at] + 1])
            cell = np.repeat(pair - b[pair], m) * BLOCK + self.post_at[post]
            score = exact[going, b] + np.bincount(cell, np.repeat(share[at], m) * self.post_weight[post], len(going) * BLOCK).reshape(-1, BLOCK)
            ids = np.append(self.place, np.full(blocks * BLOCK - size, size))[b[:, None] * BLOCK + np.arange(BLOCK)]
            score[(score <= 0) | (ids == but[going, None])] = -np.inf
            score, ids = np.hstack([best[going], score]), np.hstack([best_id[going], ids])
            first = np.lexsort((ids, -score), axis=1)[:, : self.k]
            best[going], best_id[going] = np.take_along_axis(score, first, 1), np.take_along_axis(ids, first, 1)
            visits[going] += 1
        none = best == -np.inf
        return np.where(none, -1, best_id), np.where(none, 0.0, best), visits

    def votes(self, found: np.ndarray, near: np.ndarray) -> np.ndarray:
        return (near * np.append(self.labels, 0)[found]).sum(1) / (near.sum(1) + 0.5)

    def score(self, vote: float | np.ndarray) -> float | np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.curve[0] * vote + self.curve[1], -40, 40)))

    def vectors(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, term, weight) in order of row: normalised TF-IDF over the vocabulary."""
        rows, terms, weights = [], [], []
        # a model without examples has no terms at all
        for a, b in in_slices(texts) if len(self.idf) else ():
            hashes, first = words_of(texts[a:b])
            key, n = np.unique(_hits(hashes, first, self.terms, True), return_counts=True)
            r, t = np.divmod(key, len(self.terms) + 1)
            w = (1 + np.log(n)) * self.idf[t]
            size = np.sqrt(np.bincount(r, w * w, b - a))
            rows.append(r + a)
            terms.append(t)
            weights.append(w / size[r])
        join = lambda x, kind: np.concatenate(x) if x else np.empty(0, kind)
        return join(rows, int), join(terms, int), join(weights, float)


def _hits(hashes: np.ndarray, first: np.ndarray, terms: np.ndarray, other: bool = False) -> np.ndarray:
    """row x (terms + 1) + term, for each word in the vocabulary; with ``other`` the rest has the last number."""
    at = np.searchsorted(terms, hashes)
    hit = np.append(terms, 0)[at] == hashes
    hit[at == len(terms)] = False
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    at[~hit] = len(terms)
    key = row * (len(terms) + 1) + at
    return key if other else key[hit]


def _like_together(rows: np.ndarray, terms: np.ndarray, weights: np.ndarray, n: int, n_terms: int) -> np.ndarray:
    """The examples' numbers in an order in which like ones are neighbours.

    A group is cut in two along the direction in which its vectors differ most,
    at a multiple of ``BLOCK``, until it fits into a block.
    """
    at, turn = _by_row(rows, n), np.cos(np.arange(n) * 2.3)
    out, stack = [], [np.arange(n)]
    while stack:
        group = stack.pop()
        if len(group) <= BLOCK:
            out.append(group)
            continue
        item, m = _ranges(at[group], at[group + 1])
        own, t, w = np.repeat(np.arange(len(group)), m), terms[item], weights[item]
        along = turn[group]
        for _ in range(6):  # power iteration
            along = along - along.mean()
            centre = np.bincount(t, along[own] * w, n_terms)
            along = np.bincount(own, centre[t] * w, len(group))
            along /= max(np.abs(along).max(), 1e-300)
        order = np.argsort(along, kind="stable")
        half = max(1, round(len(group) / (2 * BLOCK))) * BLOCK
        stack += [group[order[half:]], group[order[:half]]]
    return np.concatenate(out) if out else np.empty(0, int)


def _by_row(rows: np.ndarray, n: int) -> np.ndarray:
    return np.searchsorted(rows, np.arange(n + 1))


def _fit_curve(votes: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> tuple[float, float]:
    """Logistic regression of the label on the vote, with a weak pull of the slope to 0."""
    x, b = np.c_[votes, np.ones(len(votes))], np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -40, 40)))
        slope = x.T @ (weights * (labels - p)) - np.array([0.01, 0.0]) * b
        curve = (x * (weights * p * (1 - p))[:, None]).T @ x + np.diag([0.01, 1e-6])
        step = np.linalg.solve(curve, slope)
        b = b + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return float(b[0]), float(b[1])


def fit_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    k: int = 15,
    per_class: int = 1500,
    example_bytes: int = 32768,
    least_chi2: float = 20.0,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
) -> ToxicityModel:
    """A model from all rows of ``labels``; the caller leaves out what must not be learnt from."""
    known = (
        labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y"))
        .where(F.col("id").isNotNull() & F.col("y").isin(0, 1))
        .groupBy("id").agg(F.max("y").alias("y"))
    )
    shares = dict(known.groupBy("y").count().collect())
    total = sum(shares.values())
    prior = shares.get(1, 0) / total if total else 0.0
    model = ToxicityModel(k=k, curve=(0.0, float(np.log(prior / (1 - prior))) if 0 < prior < 1 else (40.0 if prior else -40.0)))
    chosen = [r for y in (0, 1) for r in known.where(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(per_class).collect()]
    if len(shares) < 2:
        return model
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    spark = docs.sparkSession
    picked = spark.createDataFrame([(r["id"], r["y"], n) for n, r in enumerate(chosen)], f"e_id {dict(texts.dtypes)['id']}, y int, n int")
    examples = (
        texts.where(F.octet_length("text").between(1, example_bytes))
        .join(F.broadcast(picked), F.col("id") == F.col("e_id"))  # at most 2 x per_class rows
        .groupBy("n", "y").agg(F.min("text").alias("text"), F.min("id").alias("id"))
    )
    examples = written(examples, "tox-examples")  # at most 2 x per_class texts of example_bytes
    found = sorted(tuple(r) for r in examples.select("n", "id", "y").collect())
    y = np.array([r[2] for r in found], float)
    if len(set(y.tolist())) < 2:
        return model

    seen = examples.select("y", "text").mapInPandas(_word_counts, "term long, bad long, good long")
    seen = seen.groupBy("term").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good")).toPandas()
    if not len(seen):
        return model
    vocabulary = seen["term"].to_numpy().view(np.uint64)
    order = np.argsort(vocabulary)
    model.terms, bad, good = vocabulary[order], seen["bad"].to_numpy()[order], seen["good"].to_numpy()[order]
    n, n1 = len(y), y.sum()
    n0 = n - n1
    seen = bad + good
    chi2 = n * (bad * (n0 - good) - good * (n1 - bad)) ** 2 / np.maximum(n1 * n0 * seen * (n - seen), 1e-9)
    telling = chi2 >= least_chi2
    counts = document_frequencies(texts, model.terms)
    idf = np.log((1 + counts[-1]) / (1 + counts[:-1])) + 1
    model.idf = np.append(np.where(telling | ~telling.any(), idf, PLAIN * idf), 1.0)
    model.telling = np.append(telling, False)
    model.labels, model.ids = y, [r[1] for r in found]

    number = {r[0]: k for k, r in enumerate(found)}
    shared = spark.sparkContext.broadcast(model)  # bounded by the sample's bounds

    def vectors(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows, terms, weights = shared.value.vectors(frame["text"].tolist())
            at = _by_row(rows, len(frame))
            cut = lambda x, kind: [x[a:b].astype(kind).tobytes() for a, b in zip(at, at[1:])]
            yield pd.DataFrame({"n": frame["n"], "terms": cut(terms, np.int32), "weights": cut(weights, np.float64)})

    held = sorted((number[r["n"]], r["terms"], r["weights"]) for r in examples.select("n", "text").mapInPandas(vectors, "n int, terms binary, weights binary").toLocalIterator())
    rows = np.repeat([k for k, _, _ in held], [len(t) // 4 for _, t, _ in held]).astype(np.int32)
    terms, weights = (np.frombuffer(b"".join(x), kind) for x, kind in (([t for _, t, _ in held], np.int32), ([w for _, _, w in held], np.float64)))
    del held
    model.index(rows, terms, weights)
    ready = spark.sparkContext.broadcast(model)

    def vote(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows, terms, weights = ready.value.vectors(frame["text"].tolist())
            but = np.array([number[k] for k in frame["n"]], int)
            yield pd.DataFrame({"k": but, "vote": ready.value.votes(*ready.value.nearest_to_each(rows, terms, weights, len(frame), but)[:2])})

    votes = np.zeros(n)
    for k, own in examples.select("n", "text").mapInPandas(vote, "k int, vote double").collect():
        votes[k] = own
    shared.unpersist()
    ready.unpersist()
    share = np.where(y == 1, shares[1] / n1, shares[0] / n0)
    model.curve = _fit_curve(votes, y, share * n / share.sum() / 1.0)
    return model


def _word_counts(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Each word's hash, and how many toxic and how many other examples hold it."""
    for frame in frames:
        texts, y = frame["text"].tolist(), frame["y"].to_numpy()
        for a, b in in_slices(texts):
            hashes, first = words_of(texts[a:b])
            row = np.repeat(np.arange(a, b), np.diff(first))
            order = np.lexsort((row, hashes))
            hashes, row = hashes[order], row[order]
            new = np.append(True, (hashes[1:] != hashes[:-1]) | (row[1:] != row[:-1]))[: len(hashes)]
            term, at = np.unique(hashes[new], return_inverse=True)
            bad = np.bincount(at, y[row[new]], len(term)).astype(np.int64)
            yield pd.DataFrame({"term": term.view(np.int64), "bad": bad, "good": np.bincount(at, minlength=len(term)) - bad})


def document_frequencies(texts: DataFrame, terms: np.ndarray) -> np.ndarray:
    """In how many of all texts each term occurs, and last the number of texts."""

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(len(terms) + 1, np.int64)
        for frame in frames:
            rows = frame["text"].tolist()
            total[-1] += len(rows)
            for a, b in in_slices(rows):
                hits = np.unique(_hits(*words_of(rows[a:b]), terms)) % (len(terms) + 1)
                total[:-1] += np.bincount(hits, minlength=len(terms))
        has = np.flatnonzero(total)
        yield pd.DataFrame({"term": has, "n": total[has]})

    out = np.zeros(len(terms) + 1, np.int64)
    for term, n in texts.select("text").mapInPandas(count, "term int, n long").groupBy("term").agg(F.sum("n")).collect():
        out[term] = n
    return out


def score_toxicity(df: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All columns of ``df`` with tox_score and, as tox_evidence, the nearest examples' ids, cosines and labels."""
    kept = df.drop("tox_score", "tox_evidence")
    shared = df.sparkSession.sparkContext.broadcast(model)  # bounded by the sample's bounds
    kind = df.schema[id_col].dataType
    why_type = f"array<struct<example: {kind.simpleString()}, cosine: double, toxic: int>>"
    schema = StructType([*kept.schema.fields, *StructType.fromDDL(f"tox_score double, tox_evidence {why_type}").fields])
    arrow_why = to_arrow_schema(schema).field("tox_evidence").type

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            texts, scores, why = batch[text_col].to_pylist(), [], []
            for a, b in in_slices(texts):
                found, near, _ = model.nearest_to_each(*model.vectors(texts[a:b]), b - a)
                scores.append(model.score(model.votes(found, near)))
                why += [
                    [{"example": model.ids[f], "cosine": s, "toxic": int(model.labels[f])} for f, s in zip(row, cosines) if f >= 0]
                    for row, cosines in zip(found[:, :3].tolist(), near[:, :3].tolist())
                ]
            scores = np.concatenate([*scores, np.empty(0)])
            columns = [*batch.columns, pa.array(scores, pa.float64()), pa.array(why, arrow_why)]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "tox_score", "tox_evidence"])
        give_back()

    return kept.mapInArrow(run, schema)


def held_out(id_col: str = "doc_id") -> Column:
    """Rows whose labels are for testing only."""
    return F.coalesce(F.crc32(F.encode(F.col(id_col).cast("string"), "UTF-8")) % 3 == 1, F.lit(False))
