"""Encoding and decoding with a byte-level pair encoding, long texts in parallel halves.

A text of up to ``leaf_chars`` characters is encoded where it lies. A longer one
is halved until its leaves are short enough; the leaves are encoded as rows of
their own, on any executor, and joined pairwise in a tree. At each join the last
two units of the left side are encoded anew together with 1, 2, 4, ... units of the
right side, until the new units and the old ones agree on where a unit begins;
from there on the right side stands. (A unit is what the tokenizer's pattern
cuts off and merges separately; where one begins depends on nothing before
it.) A unit that spans a join, such as a long run of letters without a space, is
joined token by token in the same way: see ``bpe_merge.join_encodings``.

Short texts consist of few different stretches "spaces, then no spaces", and the
encoding of a text is that of its stretches in a row, so each Python worker
keeps some ``KEPT`` encoded stretches that were in use lately.

Defined cases: a null text counts as empty and has no ids; special tokens in a
text become their own id, as the tokenizer's default has it; repeated rows are
encoded each; an empty table gives an empty result.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from strata.llm.bpe_merge import byte_symbols, join_encodings
from strata.llm.support import give_back, in_slices

KEPT = 150_000
LEAF_CHARS = 1 << 16
# characters that are, or may be, white space beyond ASCII's; texts with them are not cut into stretches
_ODD_SPACE = re.compile("[\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200b\u2028\u2029\u202f\u205f\u3000\ufeff]")
_STRETCH = re.compile("[ \t\n\r]*[^ \t\n\r]+|[ \t\n\r]+")


@dataclass
class Encoded:
    """Ids of a stretch of text, unit by unit; ``starts`` holds where each unit begins, ``cuts`` its first id."""

    text: str
    starts: list[int]
    units: list[list[int]]

    def ids(self) -> list[int]:
        return [i for u in self.units for i in u]


class ByteBpe:
    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocab = spec["model"]["vocab"]
        byte_of = {c: b for b, c in byte_symbols().items()}
        self.symbols = {i: t for t, i in vocab.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*self.symbols, *self.special.values()]) + 1
        self.bytes = [b""] * size
        for t, i in vocab.items():
            self.bytes[i] = bytes(byte_of[c] for c in t)
        for t, i in self.special.items():
            self.bytes[i] = t.encode()
        self.specials = re.compile("|".join(map(re.escape, self.special))) if self.special else None
        # stretches seen lately, and those of the time before
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, as little-endian unsigned 32-bit integers."""
        known, older, new = self.known, self.older, set()
        rows = [None if _ODD_SPACE.search(t) else _STRETCH.findall(t) for t in texts]
        for parts in filter(None, rows):
            new.update(parts)
        new.difference_update(known)
        for part in new.intersection(older):
            known[part] = older[part]
        new = list(new.difference(older))
        for part, e in zip(new, self.tokenizer.encode_batch_fast(new, add_special_tokens=False)):
            known[part] = array("I", e.ids).tobytes()
        get = known.__getitem__
        out = [
            array("I", self.tokenizer.encode(t, add_special_tokens=False).ids).tobytes() if parts is None else b"".join(map(get, parts))
            for t, parts in zip(texts, rows)
        ]
        if len(known) > KEPT:
            self.known, self.older = {}, known
        return out

    def forget(self) -> None:
        """Drop the encoded stretches that are kept."""
        self.known, self.older = {}, {}

    def decode(self, ids: bytes) -> str:
        """The text of ids; bytes that are no UTF-8 become replacement characters."""
        return b"".join(map(self.bytes.__getitem__, array("I", ids))).decode("utf-8", "replace")

    def merge(self, symbols: str) -> list[int]:
        return [t.id for t in self.tokenizer.model.tokenize(symbols)] if symbols else []

    def units(self, text: str) -> Encoded:
        """A stretch without special tokens."""
        found = self.tokenizer.pre_tokenizer.pre_tokenize_str(text)
        return Encoded(text, [span[0] for _, span in found], [self.merge(s) for s, _ in found])

    def join(self, left: Encoded, right: Encoded) -> Encoded:
        """The encoding of both texts in a row."""
        if not left.text or not right.text:
            return right if not left.text else left
        # the pattern looks one sign past an apostrophe's unit, so the left side's last unit may begin elsewhere
        back = min(2, len(left.starts))
        begin = left.starts[-back]
        seam, last = len(left.text) - begin, left.starts[-1] - begin
        tail, many = left.text[begin:], 1
        while True:
            whole = many >= len(right.starts)
            window = tail + (right.text if whole else right.text[: right.starts[many]])
            found = self.tokenizer.pre_tokenizer.pre_tokenize_str(window)
            starts = [span[0] for _, span in found]
            # the last unit of a window may be cut off; all others begin and end as in the whole text
            theirs = set(right.starts[: many + 1])
            agreed = None if whole else next((s for s in starts[:-1] if s - seam in theirs), None)
            if whole or agreed is not None:
                break
            many *= 2
        keep = len(right.starts) if whole else right.starts.index(agreed - seam)
        new_starts, new_units = [], []
        for symbols, (a, b) in found:
            if agreed is not None and a >= agreed:
                break
            new_starts.append(begin + a)
            if a == last and b == seam + ([*right.starts, len(right.text)][1]):
                # the last unit of the left and the first of the right side in one
                new_units.append(join_encodings(left.units[-1], right.units[0], self.symbols.__getitem__, self.merge))
            else:
                new_units.append(self.merge(symbols))
        moved = [s + len(left.text) for s in right.starts[keep:]]
        return Encoded(left.text + right.text, left.starts[:-back] + new_starts + moved, left.units[:-back] + new_units + right.units[keep:])


@lru_cache(2)
def byte_bpe(path: str) -> ByteBpe:
    # each task has a core; threads of the library's own would only compete with other tasks
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    return ByteBpe(path)


def leaves(text: str, most: int) -> list[str]:
    """The leaves of a halving tree, in order; the same at every call."""
    if len(text) <= most:
        return [text]
    half = len(text) // 2
    return leaves(text[:half], most) + leaves(text[half:], most)


def join_tree(bpe: ByteBpe, parts: list[Encoded]) -> Encoded:
    while len(parts) > 1:
        parts = [bpe.join(*parts[i : i + 2]) if i + 1 < len(parts) else parts[i] for i in range(0, len(parts), 2)]
    return parts[0]


def segments(bpe: ByteBpe, text: str) -> list[tuple[bool, str]]:
    """(is special, text) in order: special tokens are cut out before anything else."""
    if not bpe.specials:
        return [(False, text)]
    out, at = [], 0
    for m in bpe.specials.finditer(text):
        out += [(False, text[at : m.start()]), (True, m[0])]
        at = m.end()
    return [s for s in [*out, (False, text[at:])] if s[1]]


def encode_documents(
    df: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", leaf_chars: int = LEAF_CHARS, digests: bool = False
) -> DataFrame:
    """id and ids (binary, little-endian unsigned 32-bit integers) for each row of ``df``.

    With ``digests`` instead of ids: n_tokens, ids_sha256 and, of the text that
    the ids decode to, decoded_sha256.
    """
    result = "n_tokens long, ids_sha256 string, decoded_sha256 string" if digests else "ids binary"

    def finish(bpe: ByteBpe, keys: list, ids: list[bytes]) -> pd.DataFrame:
        if not digests:
            return pd.DataFrame({"id": keys, "ids": ids})
        return pd.DataFrame(
            {
                "id": keys,
                "n_tokens": [len(i) // 4 for i in ids],
                "ids_sha256": [sha256(i).hexdigest() for i in ids],
                "decoded_sha256": [sha256(bpe.decode(i).encode()).hexdigest() for i in ids],
            }
        )

    kind = dict(df.select(F.col(id_col).alias("id")).dtypes)["id"]
    rows = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    long = F.length("text") > leaf_chars

    def direct(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = byte_bpe(tokenizer_path)
        for frame in frames:
            keys, texts = frame["id"].tolist(), frame["text"].tolist()
            for a, b in in_slices(texts):
                yield finish(bpe, keys[a:b], bpe.encode(texts[a:b]))
        # the worker goes on to other stages
        bpe.forget()
        give_back()

    def split(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = byte_bpe(tokenizer_path)
        for frame in frames:
            for id_, key, text in zip(frame["id"], frame["key"], frame["text"]):
                found = [
                    (segment, n, special, leaf)
                    for segment, (special, part) in enumerate(segments(bpe, text))
                    for n, leaf in enumerate([part] if special else leaves(part, leaf_chars))
                ]
                out = pd.DataFrame(found, columns=["segment", "leaf", "special", "part"])
                yield out.assign(id=id_, key=key)[["id", "key", "segment", "leaf", "special", "part"]]

    def encode(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = byte_bpe(tokenizer_path)
        for frame in frames:
            done = [
                Encoded(p, [0], [[bpe.special[p]]]) if special else bpe.units(p)
                for special, p in zip(frame["special"], frame["part"])
            ]
            yield frame.drop(columns="special").assign(
                starts=[np.array(e.starts, "<i4").tobytes() for e in done],
                sizes=[np.array([len(u) for u in e.units], "<i4").tobytes() for e in done],
                ids=[np.array(e.ids(), "<u4").tobytes() for e in done],
            )

    def assemble(frame: pd.DataFrame) -> pd.DataFrame:
        bpe, ids = byte_bpe(tokenizer_path), []
        copies = int(((frame["segment"] == 0) & (frame["leaf"] == 0)).sum())
        one = frame.drop_duplicates(["segment", "leaf"]).sort_values(["segment", "leaf"])
        for _, part in one.groupby("segment", sort=True):
            found = []
            for row in part.itertuples():
                flat = np.frombuffer(row.ids, "<u4").tolist()
                ends = np.cumsum(np.frombuffer(row.sizes, "<i4")).tolist()
                units = [flat[a:b] for a, b in zip([0, *ends], ends)]
                found.append(Encoded(row.part, np.frombuffer(row.starts, "<i4").tolist(), units))
            ids.append(np.array(join_tree(bpe, found).ids(), "<u4").tobytes())
        return finish(bpe, frame["id"].iloc[:1].tolist() * copies, [b"".join(ids)] * copies)

    short = rows.where(~long).mapInPandas(direct, f"id {kind}, {result}")
    leaf = f"id {kind}, key string, segment int, leaf int, special boolean, part string"
    done = f"id {kind}, key string, segment int, leaf int, part string, starts binary, sizes binary, ids binary"
    # equal rows have one key; their leaves are counted in assemble
    parts = rows.where(long).withColumn("key", F.sha2("text", 256)).mapInPandas(split, leaf)
    parts = parts.repartition("key", "segment", "leaf").mapInPandas(encode, done)
    whole = parts.groupBy("id", "key").applyInPandas(assemble, f"id {kind}, {result}")
    return short.unionByName(whole).withColumnRenamed("id", id_col)
