"""Which tokens of two tokenizers stand for the same bytes, counted by inverted pair bitmaps.

A text is encoded by both tokenizers with a space before it. Tokens of A and B
are linked where their byte ranges overlap; byte offsets where both have a token
end cut the tokens into groups. As the ranges of each side follow each other
without a gap, a link is a stretch between two neighbouring token ends of either
side.

Documents are numbered within blocks of bounded size (``BLOCK_LINKS`` places of
pairs, ``BLOCK_DOCS`` documents). For each pair of ids a block holds compressed
bitmaps of its documents: plane p has the documents in which bit p of the
number of links is set. A bitmap is a list of 16-bit numbers, or a bit for each
document where that is shorter. Over a block the planes of a pair are OR-merged and
popcounted for its documents, and popcounted with weight 2^p for its links;
blocks hold different documents, so their counts add up. The bitmaps then serve
as postings: joined with the corpus-wide count of their pair they go back to
their block, and each document gets the sums over its links.

Defined cases: null and empty texts, and texts whose joined token bytes are not
the space and the text (such as one with U+2581), have no tokens, zeros and an
empty groups_sha256; strings of special tokens are plain text; repeated rows
count each; a null id is an id like any other; an empty table gives an empty
result. Columns other than id and text are not looked at.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType
from sentencepiece import SentencePieceProcessor

from strata.llm.bpe import _ODD_SPACE, ByteBpe
from strata.llm.support import in_slices, written

BLOCK_LINKS = 1 << 21
BLOCK_DOCS = 1 << 16
SPACE = "▁"
KEPT = 150_000
LONG = 256
#: Stands for the comma between two tokens of B, so that both sides can be counted.
NEXT_B = b"+"
#: Stretches that the libraries get as one text.
CHUNK = 256
# a space that ends a word's stretch; white space before it holds on to it
_STRETCH = re.compile(r" *[^ ]+(?:(?<=[\t\n\r]) +[^ ]+)*| +")
_BYTE = re.compile("<0x([0-9A-F]{2})>")
COUNTS = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"


class PieceBpe:
    """A sentencepiece model that puts a space before a text, and the bytes of its pieces."""

    def __init__(self, path: str):
        self.model = SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.bytes = [
            bytes([int(m[1], 16)]) if self.model.is_byte(i) and (m := _BYTE.fullmatch(p)) else p.replace(SPACE, " ").encode()
            for i, p in enumerate(pieces)
        ]
        # no piece goes on from a word into the space behind it: words are merged apart
        self.apart = not any(re.search(f"[^{SPACE}]{SPACE}", p) for p in pieces)


def vocabulary_size(path: str) -> int:
    """Ids of a sentencepiece model."""
    return SentencePieceProcessor(model_file=path).get_piece_size()


def _labels(n: int, ends: tuple[bytes, bytes]) -> list[bytes]:
    """The decimal id and what follows it: twice the id, plus one where the token is the last of its group."""
    return [b"%d%s" % (i >> 1, ends[i & 1]) for i in range(2 * n)]


@dataclass
class Aligned:
    """Of some texts in order: a row (n_a, n_b, n_groups, n_links) and a digest each, and the pair codes of all links."""

    counts: np.ndarray
    digests: list[str]
    codes: np.ndarray


class Aligner:
    """Texts are cut where a space follows a sign that is none: both tokenizers have a token end there.

    The alignment of a text is that of its stretches in a row, so those of up to
    ``LONG`` characters that were in use lately are kept.
    """

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = ByteBpe(path_a), PieceBpe(path_b)
        self.a.tokenizer.encode_special_tokens = True
        self.size_a, self.size_b = (np.array([len(x) for x in t.bytes]) for t in (self.a, self.b))
        self.say_a, self.say_b = _labels(len(self.size_a), (b",", b"|")), _labels(len(self.size_b), (NEXT_B, b";"))
        # stretches seen lately, and those of the time before
        self.known: dict[str, tuple | None] = {}
        self.older: dict[str, tuple | None] = {}

    def _stretches(self, text: str) -> list[str]:
        return [" " + text] if not self.b.apart or _ODD_SPACE.search(text) else _STRETCH.findall(" " + text)

    def _aligned(self, parts: list[str]) -> list[tuple[bytes, bytes] | None]:
        """Of each stretch, which begins with a space: groups and pair codes; none if a side's bytes differ."""
        # after white space a stretch would not be cut off from the next one
        alone = [k for k, p in enumerate(parts) if p[-1].isspace() or _ODD_SPACE.search(p[-1])]
        others = sorted(set(range(len(parts))).difference(alone))
        chunks = [[k] for k in alone] + [others[k : k + CHUNK] for k in range(0, len(others), CHUNK)]
        out: list[tuple | None] = [None] * len(parts)
        while chunks:
            texts = ["".join([parts[k] for k in chunk]) for chunk in chunks]
            side_a = [e.ids for e in self.a.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
            side_b = self.b.model.encode([t[1:] for t in texts], num_threads=1)
            same = [
                b"".join(map(self.a.bytes.__getitem__, a)) == text == b"".join(map(self.b.bytes.__getitem__, b))
                for a, b, text in zip(side_a, side_b, (t.encode() for t in texts))
            ]
            good = [k for k, ok in enumerate(same) if ok]
            numbers = [k for c in good for k in chunks[c]]
            if numbers:
                a, b = (np.array(list(chain.from_iterable(side[c] for c in good)), np.int64) for side in (side_a, side_b))
                for k, found in zip(numbers, self._split(a, b, [len(parts[k].encode()) for k in numbers])):
                    out[k] = found
            # which stretch it is that differs is seen by taking them one by one
            chunks = [[k] for chunk, ok in zip(chunks, same) if not ok and len(chunk) > 1 for k in chunk]
        return out

    def _split(self, a: np.ndarray, b: np.ndarray, sizes: list[int]) -> Iterator[tuple[bytes, bytes]]:
        """The alignment of the tokens of stretches in a row, for each stretch of so many bytes."""
        part_ends, end_a, end_b = np.cumsum(sizes), np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b])
        ends = np.sort(np.concatenate([end_a, end_b]), kind="stable")
        ends = ends[np.append(True, ends[1:] != ends[:-1])]
        of_a, of_b = np.searchsorted(end_a, ends), np.searchsorted(end_b, ends)
        both = (end_a[of_a] == ends) & (end_b[of_b] == ends)
        last_a, last_b = np.searchsorted(end_a, part_ends) + 1, np.searchsorted(end_b, part_ends) + 1
        last_link = 8 * (np.searchsorted(ends, part_ends) + 1)
        codes, say = (a[of_a] * len(self.size_b) + b[of_b]).tobytes(), self._said(a, b, of_a[both], of_b[both])
        from_link, from_token, join = 0, 0, b"".join
        for to_link, to_token in zip(last_link.tolist(), (last_a + last_b).tolist()):
            yield join(say[from_token:to_token]), codes[from_link:to_link]
            from_link, from_token = to_link, to_token

    def _said(self, a: np.ndarray, b: np.ndarray, close_a: np.ndarray, close_b: np.ndarray) -> list[bytes]:
        """Tokens in order of their groups, A's before B's; a group ends with the tokens ``close_a`` and ``close_b``."""
        last_a, last_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        last_a[close_a], last_b[close_b] = 1, 1
        before_a, before_b = np.append(0, close_b + 1), close_a + 1
        say = np.empty(len(a) + len(b), object)
        say[np.arange(len(a)) + before_a[np.cumsum(last_a) - last_a]] = [self.say_a[i] for i in (2 * a + last_a).tolist()]
        say[np.arange(len(b)) + before_b[np.cumsum(last_b) - last_b]] = [self.say_b[i] for i in (2 * b + last_b).tolist()]
        return say.tolist()

    def align(self, texts: list[str | None]) -> Aligned:
        rows = [self._stretches(t) if t else [] for t in texts]
        new: set[str] = set()
        new.update(*rows)
        new.difference_update(self.known)
        for part in new.intersection(self.older):
            self.known[part] = self.older[part]
        fresh = list(new.difference(self.older))
        found = dict(zip(fresh, self._aligned(fresh)))
        long = {p: found.pop(p) for p in fresh if len(p) > LONG}
        self.known.update(found)
        get = (self.known | long).__getitem__ if long else self.known.__getitem__
        flat = list(map(get, chain.from_iterable(rows)))
        if None in flat:  # what differs in a stretch could only be made up for by another one
            whole = {}
            for i, (text, row) in enumerate(zip(texts, rows)):
                if None in map(get, row):
                    rows[i], whole[" " + text] = [" " + text], self._aligned([" " + text])[0] or (b"", b"")
            flat = [whole[p] if p in whole else get(p) for p in chain.from_iterable(rows)]
        if len(self.known) > KEPT:
            self.known, self.older = {}, self.known
        says, codes = zip(*flat) if flat else ((), ())
        counts, digests, at = np.zeros((len(texts), 4), np.int64), [""] * len(texts), 0
        for i, row in enumerate(rows):
            say = b"".join(says[at : at + len(row)])
            at += len(row)
            if say:
                n_groups = say.count(b";")
                n_a, n_b = say.count(b",") + n_groups, say.count(NEXT_B) + n_groups
                counts[i] = n_a, n_b, n_groups, n_a + n_b - n_groups
                digests[i] = hashlib.sha256(say[:-1].replace(NEXT_B, b",")).hexdigest()
        return Aligned(counts, digests, np.frombuffer(b"".join(codes), np.int64))


@lru_cache(2)
def aligner(path_a: str, path_b: str) -> Aligner:
    return Aligner(path_a, path_b)


def pair_bitmaps(code: np.ndarray, doc: np.ndarray, n: np.ndarray, docs: int) -> dict[str, list | np.ndarray]:
    """The planes' bitmaps of a block of ``docs`` documents, from different places (code, doc) with ``n`` links each."""
    planes = []
    for p in range(int(n.max(initial=0)).bit_length()):
        has = np.flatnonzero(n >> p & 1)
        planes.append((code[has], np.full(len(has), p), doc[has]))
    code, plane, doc = (np.concatenate(x) for x in zip(*planes)) if planes else (np.empty(0, np.int64),) * 3
    order = np.lexsort((doc, plane, code))  # one block at a time
    code, plane, doc = code[order], plane[order], doc[order].astype("<u2")
    edge = np.flatnonzero(np.append(True, (code[1:] != code[:-1]) | (plane[1:] != plane[:-1]))) if len(code) else np.empty(0, np.int64)
    size = np.diff(np.append(edge, len(code)))
    dense = 2 * size > -(-docs // 8)
    raw = doc.tobytes()
    held = [raw[2 * e : 2 * (e + s)] for e, s in zip(edge.tolist(), size.tolist())]
    for i in np.flatnonzero(dense):
        bits = np.zeros(docs, bool)
        bits[doc[edge[i] : edge[i] + size[i]]] = True
        held[i] = np.packbits(bits).tobytes()
    code, plane = code[edge], plane[edge]
    # a pair's documents: the popcount of its planes' OR, which only pairs of several planes need
    n_docs = size.copy()
    first = np.append(True, code[1:] != code[:-1]) if len(code) else np.empty(0, bool)
    begins = np.flatnonzero(first)
    for i, j in zip(begins, np.append(begins[1:], len(code))):
        if j - i > 1:
            n_docs[i] = np.unique(doc[edge[i] : edge[j - 1] + size[j - 1]]).size
    n_docs[~first] = 0
    return {"code": code, "plane": plane, "dense": dense, "bitmap": held, "pair_docs": n_docs, "pair_links": size << plane}


def places_of(dense: bool, bitmap: bytes) -> np.ndarray:
    """The documents of a bitmap."""
    return np.flatnonzero(np.unpackbits(np.frombuffer(bitmap, np.uint8))) if dense else np.frombuffer(bitmap, "<u2").astype(np.int64)


def align_tokens(df: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Documents (block, doc, id, n_a, n_b, n_groups, n_links, groups_sha256) and bitmaps (block, code, plane, dense, bitmap, pair_docs, pair_links).

    A block is flushed before a slice of texts that would overfill it; a slice has a
    million characters, or one text. ``code`` is A's id times B's vocabulary size, plus B's id. Both are parts of one
    written table, so every text is encoded once.
    """
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    of_doc = f"id {dict(rows.dtypes)['id']}, doc int, {COUNTS}"
    of_pair = "code long, plane int, dense boolean, bitmap binary, pair_docs long, pair_links long"
    schema = StructType.fromDDL(f"block long, {of_doc}, {of_pair}")
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = aligner(path_a, path_b)
        part, block, docs, held, size = TaskContext.get().partitionId(), 0, 0, [], 0

        def made(**columns) -> pa.RecordBatch:
            n = len(next(iter(columns.values())))
            full = {"block": np.full(n, (part << 32) + block), **columns}
            return pa.record_batch([pa.array(full[f.name], f.type) if f.name in full else pa.nulls(n, f.type) for f in arrow], schema=arrow)

        def flushed() -> Iterator[pa.RecordBatch]:
            key, n = (np.concatenate(x) for x in zip(*held)) if held else (np.empty(0, np.int64),) * 2
            found = pair_bitmaps(key // BLOCK_DOCS, key % BLOCK_DOCS, n, docs)
            for k in range(0, len(found["code"]), 50_000):
                yield made(**{name: column[k : k + 50_000] for name, column in found.items()})

        for batch in batches:
            ids, texts = batch["id"], batch["text"].to_pylist()
            for i, j in in_slices(texts):
                for i in range(i, j, BLOCK_DOCS):
                    end = min(j, i + BLOCK_DOCS)
                    found = tokens.align(texts[i:end])
                    if docs and (docs + end - i > BLOCK_DOCS or size + len(found.codes) > BLOCK_LINKS):
                        yield from flushed()
                        block, docs, held, size = block + 1, 0, [], 0
                    # a place, and how many of the document's links are of that pair
                    place = np.repeat(np.arange(docs, docs + end - i), found.counts[:, 3])
                    key, n = np.unique(found.codes * BLOCK_DOCS + place, return_counts=True)
                    held.append((key, n))
                    size += len(key)
                    n_a, n_b, n_groups, n_links = found.counts.T.copy()
                    yield made(
                        id=ids.slice(i, end - i), doc=np.arange(docs, docs + end - i), n_a=n_a, n_b=n_b,
                        n_groups=n_groups, n_links=n_links, groups_sha256=found.digests,
                    )
                    docs += end - i
        if docs:
            yield from flushed()

    both = written(rows.mapInArrow(run, schema), "alignment")
    documents = both.where("code is null").select("block", "doc", "id", *[f.split()[0] for f in COUNTS.split(", ")])
    return documents, both.where("code is not null").select("block", "code", "plane", "dense", "bitmap", "pair_docs", "pair_links")


def pair_counts(bitmaps: DataFrame, n_b: int) -> DataFrame:
    """code, id_a, id_b, n_docs, n_links, and best: whether no other pair of its B id has more links."""
    pairs = bitmaps.groupBy("code").agg(F.sum("pair_docs").alias("n_docs"), F.sum("pair_links").alias("n_links"))
    pairs = written(pairs.select("code", (F.col("code") / n_b).cast("long").alias("id_a"), (F.col("code") % n_b).alias("id_b"), "n_docs", "n_links"), "pairs")
    most = pairs.groupBy("id_b").agg(F.max("n_links").alias("most"))
    return pairs.join(most, "id_b").select("code", "id_a", "id_b", "n_docs", "n_links", (F.col("n_links") == F.col("most")).alias("best"))


def link_scores(documents: DataFrame, bitmaps: DataFrame, counts: DataFrame) -> DataFrame:
    """The documents with n_best (links of a best pair) and count_sum (their pairs' links, summed over links)."""
    # the pairs grow with the texts: the join is a shuffle at any size
    scored = bitmaps.join(counts.hint("merge").select("code", F.col("n_links").alias("links"), "best"), "code")
    scored = scored.select(F.col("block").alias("of_block"), "plane", "dense", "bitmap", "links", "best")
    schema = StructType([*documents.drop("block", "doc").schema.fields, *StructType.fromDDL("n_best long, count_sum long").fields])
    arrow = to_arrow_schema(schema)

    def run(docs: pa.Table, planes: pa.Table) -> pa.Table:
        n = max(docs["doc"].to_pylist(), default=-1) + 1
        total = np.zeros((2, n), np.int64)
        weight = 1 << planes["plane"].to_numpy().astype(np.int64)
        links, best = planes["links"].to_numpy() * weight, planes["best"].to_numpy() * weight
        dense, held = planes["dense"].to_numpy(), planes["bitmap"].to_pylist()
        sparse = np.flatnonzero(~dense)
        if len(sparse):
            size = np.array([len(held[i]) // 2 for i in sparse])
            at = np.frombuffer(b"".join([held[i] for i in sparse]), "<u2")
            np.add.at(total[0], at, np.repeat(best[sparse], size))
            np.add.at(total[1], at, np.repeat(links[sparse], size))
        for i in np.flatnonzero(dense):
            at = places_of(True, held[i])
            total[:, at] += np.array([[best[i]], [links[i]]])
        own = docs["doc"].to_numpy()
        columns = {"n_best": pa.array(total[0][own]), "count_sum": pa.array(total[1][own])}
        return pa.table([columns[f.name] if f.name in columns else docs[f.name] for f in arrow], schema=arrow)

    return documents.groupBy("block").cogroup(scored.groupBy("of_block")).applyInArrow(run, schema)
