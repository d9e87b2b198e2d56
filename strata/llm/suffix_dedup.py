"""Removal of byte strings that an earlier document already holds.

Every byte is removed that lies in a ``length``-byte string which also starts in
a document with a smaller id. Strings do not cross documents, overlaps count,
and strings are judged on the input.

Not every suffix has to be sorted. Of each window of ``length`` bytes only one
suffix matters, the one at its anchor: the place whose next ``ANCHOR`` bytes have
the smallest hash. Equal windows have their anchor at the same place, so they
meet when the suffixes at the anchors are sorted. The work is a distributed
merge sort in two exchanges:

1. Documents are packed into runs. Each run sends the hashes of its anchors; the
   anchors that only one document has are answered "no" and go no further.
2. Each run sorts the suffixes at the other anchors, with the text left of them,
   and sends them as front-coded blocks: every suffix without the prefix it has
   in common with the one before. Per partition the blocks are merged by a tree
   of losers that compares only bytes beyond known common prefixes. Suffixes
   with a common prefix of an anchor are neighbours then, and the merge's common
   prefixes say which windows can be equal at all. Each run gets back, for each
   of its suffixes, which windows an earlier document has.

Equal suffixes of one run are sent once, with their smallest id, so copies cost
each run one entry. An anchor that over ``HOT`` documents share (a common line)
is not sent as one group if that takes more entries than its windows one by one,
and never if over ``GROUP * HOT`` share it: then the windows are dealt out by all
their bytes.

Defined cases: null texts count as empty; texts shorter than ``length`` stay as
they are; a null id counts as the largest; rows that repeat an id do not remove
anything from each other, but all lose what smaller ids have; an empty table
gives an empty result.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from strata.llm.loser_tree import common_prefix, merge_prefixed
from strata.llm.support import give_back, mix, power_tables, written

LENGTH = 50
HOT = 2000
#: An anchor of so many times HOT documents is never sent as one group.
GROUP = 10
RUN_BYTES = 4 << 20
#: Groups of up to so many different entries are compared by pairs, larger ones window by window.
PAIRED = 8
LAST_ID = (1 << 63) - 1
#: Bytes whose windows are worked on at once: their arrays stay in the processor's cache.
_PIECE = 1 << 17
_PLACE = np.uint64((1 << 24) - 1)
_VALUE = np.uint64((1 << 40) - 1)
_RESULT = ["n_bytes", "n_removed", "n_spans", "kept"]


def _pack(*arrays: np.ndarray | bytes) -> bytes:
    parts = [a if isinstance(a, bytes) else a.tobytes() for a in arrays]
    return zstandard.compress(struct.pack(f"<{len(parts) + 1}q", len(parts), *map(len, parts)) + b"".join(parts), 3)


def _unpack(data: bytes) -> list[bytes]:
    data = zstandard.decompress(data)
    (n,) = struct.unpack_from("<q", data)
    at, out = 8 * (n + 1), []
    for size in struct.unpack_from(f"<{n}q", data, 8):
        out.append(data[at : at + size])
        at += size
    return out


def _planes(values: np.ndarray) -> bytes:
    """40-bit numbers, byte by byte: the upper bytes of sorted ones compress well."""
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5].T).tobytes()


def _from_planes(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 5, 8), np.uint8)
    out[:, :5] = np.frombuffer(data, np.uint8).reshape(5, -1).T
    return out.view("<u8").ravel()


@dataclass
class Anchors:
    """Groups of neighbouring windows of a run that share their anchor."""

    key: np.ndarray  # partition << 40 | value, from the bytes at the anchor
    place: np.ndarray  # of the anchor, in its document
    low: np.ndarray  # where the first window begins
    high: np.ndarray  # where the last window begins
    doc: np.ndarray

    @classmethod
    def of(cls, texts: list[bytes], length: int, anchor: int, parts: int) -> Anchors:
        found, batch, size = [], [], 0
        for doc, text in enumerate(texts):
            # pieces of a very long text overlap, so that no window is lost
            for off in range(0, max(1, len(text) - length + 1), _PIECE - length):
                piece = text[off : off + _PIECE - 1]
                if size and size + len(piece) > _PIECE:
                    found.append(_batch_anchors(batch, length, anchor, parts))
                    batch, size = [], 0
                batch.append((doc, off, piece))
                size += len(piece)
        found.append(_batch_anchors(batch, length, anchor, parts))
        return cls(*(np.concatenate(x) for x in zip(*found)))


def _batch_anchors(batch: list[tuple[int, int, bytes]], length: int, anchor: int, parts: int) -> tuple[np.ndarray, ...]:
    data = np.frombuffer(b"".join(p for _, _, p in batch), np.uint8)
    windows = len(data) - length + 1
    if windows < 1:
        return np.empty(0, np.uint64), *(np.empty(0, np.int64) for _ in range(4))
    up, down = power_tables(len(data) + 1)
    total = np.empty(len(data) + 1, np.uint64)
    total[0] = 0
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=total[1:])
    n = len(data) - anchor + 1
    hashes = mix((total[anchor:] - total[:n]) * down[:n])
    # the place in the low bits: the smallest hash of a window tells where it is, the leftmost of equal ones
    least = (hashes & ~_PLACE) | np.arange(n, dtype=np.uint64)
    span, have = length - anchor + 1, 1
    while have < span:
        step = min(have, span - have)
        least = np.minimum(least[: len(least) - step], least[step:])
        have += step
    sizes = np.array([len(p) for _, _, p in batch])
    ends = np.cumsum(sizes)
    piece = np.repeat(np.arange(len(batch)), sizes)[:windows]
    begin = np.flatnonzero(np.arange(windows) + length <= ends[piece])
    place, piece = (least[begin] & _PLACE).astype(np.int64), piece[begin]
    edge = np.flatnonzero(np.append(True, (place[1:] != place[:-1]) | (piece[1:] != piece[:-1]))) if len(begin) else begin
    last = np.append(edge[1:], len(begin))[: len(edge)] - 1
    place, piece = place[edge], piece[edge]
    scrambled = mix(hashes[place] ^ np.uint64(0x5851F42D4C957F2D))
    key = (scrambled % np.uint64(parts)) << np.uint64(40) | ((scrambled >> np.uint64(20)) & _VALUE)
    shift = np.array([o for _, o, _ in batch])[piece] - (ends - sizes)[piece]
    doc = np.array([d for d, _, _ in batch])[piece]
    return key, place + shift, begin[edge] + shift, begin[last] + shift, doc


def _distinct(found: Anchors) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The keys of a run in order, in how many of its documents each occurs, and which of the keys each anchor has."""
    # documents stand in their order already
    order = np.argsort(found.key, kind="stable")
    key, doc = found.key[order], found.doc[order]
    other_key = np.append(True, key[1:] != key[:-1]) if len(key) else np.empty(0, bool)
    other = other_key | np.append(True, doc[1:] != doc[:-1]) if len(key) else other_key
    docs = np.add.reduceat(other.astype(np.int64), np.flatnonzero(other_key)) if len(key) else np.empty(0, np.int64)
    which = np.empty(len(key), np.int64)
    which[order] = np.cumsum(other_key) - 1
    return key[other_key], docs, which


def _how_sent(docs: np.ndarray, runs: np.ndarray, span: int, hot: int) -> np.ndarray:
    """0 for anchors that no other document has, 1 for those sent as a group, 2 for those sent window by window.

    Window by window, an anchor takes up to ``span`` entries in each of its runs; as a group, at most one for each
    document. What is less is sent, as long as the group is no large part of a task.
    """
    many = (docs > hot) & ((docs > span * runs) | (docs > GROUP * hot))
    return np.where(many, 2, docs > 1).astype(np.uint8)


@dataclass
class Entries:
    """The suffixes a run sends, sorted in each partition and each once, and where they stand."""

    parts: list[int]  # the partitions, in order
    begin: list[int]  # where the entries of each begin, and the end
    suffixes: list[bytes]  # from the anchor on
    lefts: list[bytes]  # what is left of the anchor
    ids: list[int]  # the smallest id of each
    seen: np.ndarray  # (document, first window, windows, entry, whether an earlier document of the run has it)

    @classmethod
    def of(cls, texts: list[bytes], ids: list[int], answers: np.ndarray, found: Anchors, length: int, parts: int) -> Entries:
        """``answers``: 0 no other document has it, 1 some have, 2 many; one for each distinct key."""
        answer = answers[_distinct(found)[2]]
        some, many = np.flatnonzero(answer == 1), np.flatnonzero(answer == 2)
        doc, place, low, high = (c[some].tolist() for c in (found.doc, found.place, found.low, found.high))
        part = (found.key[some] >> np.uint64(40)).tolist()
        count = (found.high[some] - found.low[some] + 1).tolist()
        suffixes = [texts[d][p : h + length] for d, p, h in zip(doc, place, high)]
        lefts = [texts[d][b:p] for d, b, p in zip(doc, low, place)]
        for d, b, h in zip(found.doc[many].tolist(), found.low[many].tolist(), found.high[many].tolist()):
            windows = [texts[d][p : p + length] for p in range(b, h + 1)]
            suffixes += windows
            lefts += [b""] * len(windows)
            part += [zlib.crc32(w) % parts for w in windows]
            doc += [d] * len(windows)
            low += range(b, h + 1)
            count += [1] * len(windows)
        out = cls([], [], [], [], [], np.empty((0, 5), np.int32))
        entry, earlier, last = [0] * len(doc), [0] * len(doc), None
        order = sorted(zip(part, suffixes, lefts, map(ids.__getitem__, doc), range(len(doc))))
        for at, suffix, left, own, n in order:
            if (at, suffix, left) != last:
                if last is None or at != last[0]:
                    out.parts.append(at)
                    out.begin.append(len(out.ids))
                last = (at, suffix, left)
                out.suffixes.append(suffix)
                out.lefts.append(left)
                out.ids.append(own)
            entry[n] = len(out.ids) - 1
            earlier[n] = out.ids[-1] < own
        out.begin.append(len(out.ids))
        out.seen = np.array([doc, low, count, entry, earlier], np.int32).T
        return out

    def block(self, n: int) -> bytes:
        """Front-coded: each suffix of the n-th partition without what it has in common with the one before."""
        a, b = self.begin[n], self.begin[n + 1]
        suffixes, lefts, common, tails, before = self.suffixes[a:b], self.lefts[a:b], [], [], b""
        for suffix in suffixes:
            same = common_prefix(before, suffix)
            common.append(same)
            tails.append(suffix[same:])
            before = suffix
        return _pack(
            np.array(common, "<u2"), np.array(list(map(len, suffixes)), "<u2"), np.array(list(map(len, lefts)), "<u2"),
            b"".join(tails), b"".join(lefts), np.array(self.ids[a:b], "<i8"),
        )


def _read_block(data: bytes) -> tuple[list[bytes], list[int], list[bytes], list[int]]:
    """(suffixes, common prefixes, left texts, ids)"""
    common, sizes, lefts, tails, left, ids = _unpack(data)
    common, suffixes, before, at = np.frombuffer(common, "<u2").tolist(), [], b"", 0
    for same, size in zip(common, np.frombuffer(sizes, "<u2").tolist()):
        before = before[:same] + tails[at : at + size - same]
        at += size - same
        suffixes.append(before)
    ends = np.cumsum(np.frombuffer(lefts, "<u2")).tolist()
    return suffixes, common, [left[a:b] for a, b in zip([0, *ends], ends)], np.frombuffer(ids, "<i8").tolist()


def _common_end(a: bytes, b: bytes) -> int:
    """Length of the common suffix."""
    n = min(len(a), len(b))
    x = int.from_bytes(a[len(a) - n :], "big") ^ int.from_bytes(b[len(b) - n :], "big")
    return ((x & -x).bit_length() - 1) // 8 if x else n


def _earlier_windows(group: list[tuple[int, int, int]], blocks: list, answers: list[list[int]], length: int) -> None:
    """For each suffix of a group, bit by bit, which of its windows a smaller id has."""
    least: dict[tuple[bytes, bytes], int] = {}
    nearest: list[int] = []  # of each different entry, the common prefix with the one before
    items, common = [], LAST_ID
    for run, at, same in group:
        block = blocks[run]
        entry, own = (block[0][at], block[2][at]), block[3][at]
        if same < common:
            common = same
        held = least.get(entry)
        if held is None:
            least[entry] = own
            nearest.append(common)
            common = LAST_ID
        elif own < held:
            least[entry] = own
        items.append((run, at, entry, own))
    bits = None
    if len(least) > 1:
        bits = (_by_pairs if len(least) <= PAIRED else _by_windows)(least, nearest, length)
    for run, at, entry, own in items:
        if least[entry] < own:
            answers[run][at] = (1 << (len(entry[1]) + len(entry[0]) - length + 1)) - 1
        elif bits:
            answers[run][at] = bits[entry]


def _by_pairs(least: dict[tuple[bytes, bytes], int], nearest: list[int], length: int) -> dict[tuple[bytes, bytes], int]:
    """For each different entry of a small group, which of its windows another one with a smaller id has."""
    entries, bits = list(least), dict.fromkeys(least, 0)
    for n, one in enumerate(entries):
        common = LAST_ID
        for m in range(n + 1, len(entries)):
            common = min(common, nearest[m])
            other = entries[m]
            # equal windows reach at least so far to the left of the anchor, and no farther than the texts there agree
            low, a, b = max(0, length - common), one[1], other[1]
            if low > len(a) or low > len(b) or a[len(a) - low :] != b[len(b) - low :]:
                continue
            high = _common_end(a, b)
            windows = (1 << (high - low + 1)) - 1
            if least[other] < least[one]:
                bits[one] |= windows << (len(a) - high)
            elif least[one] < least[other]:
                bits[other] |= windows << (len(b) - high)
    return bits


def _by_windows(least: dict[tuple[bytes, bytes], int], nearest: list[int], length: int) -> dict[tuple[bytes, bytes], int]:
    """What ``_by_pairs`` finds, for groups of any size.

    Equal windows have the anchor at the same place, so one place comes after the other and only the windows of one are held.
    """
    bits, first = dict.fromkeys(least, 0), []
    for n, entry in enumerate(least):
        # a window can be equal to another's only if its right part is a common prefix
        shared = max(nearest[n] if n else 0, nearest[n + 1] if n + 1 < len(nearest) else 0)
        first.append(length - min(shared, len(entry[0])))
    for back in range(max(0, min(first)), max(len(left) for _, left in least) + 1):
        smallest: dict[bytes, int] = {}
        placed = []
        for begin, (entry, own) in zip(first, least.items()):
            suffix, left = entry
            if begin <= back <= len(left):
                window = left[len(left) - back :] + suffix[: length - back]
                placed.append((entry, window, own))
                if own < smallest.get(window, LAST_ID):
                    smallest[window] = own
        for entry, window, own in placed:
            if smallest.get(window, LAST_ID) < own:
                bits[entry] |= 1 << (len(entry[1]) - back)
    return bits


def _merged(blocks: list, length: int, anchor: int) -> list[list[int]]:
    answers = [[0] * len(b[0]) for b in blocks]
    group: list[tuple[int, int, int]] = []
    for run, at, common in merge_prefixed([b[0] for b in blocks], [b[1] for b in blocks]):
        if common < anchor and group:
            if len(group) > 1:
                _earlier_windows(group, blocks, answers, length)
            group = []
        group.append((run, at, common))
    if len(group) > 1:
        _earlier_windows(group, blocks, answers, length)
    return answers


def _whole_signs(data: np.ndarray, gone: np.ndarray) -> np.ndarray:
    """What goes if no part of a UTF-8 sign may stay alone."""
    begins = np.flatnonzero((data & 0xC0) != 0x80)
    if not len(begins):
        return gone
    return np.repeat(np.logical_and.reduceat(gone, begins), np.diff(np.append(begins, len(data))))


def remove_repeats(
    df: DataFrame,
    length: int = LENGTH,
    whole_signs: bool = False,
    id_col: str = "doc_id",
    text_col: str = "text",
    partitions: int | None = None,
    hot: int = HOT,
    run_bytes: int = RUN_BYTES,
) -> DataFrame:
    """The columns of ``df`` with n_bytes, n_removed, n_spans (removed runs) and kept (the remaining bytes).

    With ``whole_signs`` a UTF-8 sign goes only if all its bytes do. Columns of
    ``df`` named like a result are left out. ``run_bytes`` should grow with the
    table, so that runs x partitions stays within some millions of blocks.
    """
    spark = df.sparkSession
    parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    anchor = max(length - 22, (length + 1) // 2)
    df = df.drop(*_RESULT)

    def rows_of(batch: pa.RecordBatch | pa.Table) -> tuple[list[int], list[bytes]]:
        ids = [LAST_ID if i is None else i for i in batch[id_col].to_pylist()]
        return ids, [b"" if t is None else t.encode("utf-8", "surrogatepass") for t in batch[text_col].to_pylist()]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def run(waiting: list) -> pa.RecordBatch:
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, waiting[0].schema) as out:
                for piece in waiting:
                    out.write_batch(piece)
            data = zstandard.compress(sink.getvalue().to_pybytes(), 3)
            return pa.RecordBatch.from_arrays(
                [pa.array([uuid.uuid4().int >> 65], pa.int64()), pa.array([data], pa.binary())], names=["run", "rows"]
            )

        waiting, size = [], 0
        for batch in batches:
            sizes = np.array([len(t or "") for t in batch[text_col].to_pylist()])
            begin = 0
            while begin < batch.num_rows:
                n = max(1, int(np.searchsorted(np.cumsum(sizes[begin:]), run_bytes - size, "right")))
                waiting.append(batch.slice(begin, n))
                size += int(sizes[begin : begin + n].sum()) + n
                begin += n
                if size >= run_bytes or begin < batch.num_rows:
                    yield run(waiting)
                    waiting, size = [], 0
        if waiting:
            yield run(waiting)

    def unpack(data: bytes) -> pa.Table:
        return pa.ipc.open_stream(zstandard.decompress(data)).read_all()

    def ask(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for run, data in zip(frame["run"], frame["rows"]):
                keys, docs, _ = _distinct(Anchors.of(rows_of(unpack(data))[1], length, anchor, parts))
                part = (keys >> np.uint64(40)).astype(np.int64)
                at = np.searchsorted(part, np.arange(parts + 1)).tolist()
                found = [(p, _pack(_planes(keys[a:b] & _VALUE), np.minimum(docs[a:b], 65535).astype("<u2")))
                         for p, (a, b) in enumerate(zip(at, at[1:])) if a < b]
                yield pd.DataFrame({"run": run, "part": [p for p, _ in found], "data": [d for _, d in found]})
        give_back()

    def answer(frame: pd.DataFrame) -> pd.DataFrame:
        read = [_unpack(d) for d in frame["data"]]
        values = [_from_planes(v) for v, _ in read]
        sizes = np.cumsum([0, *map(len, values)])
        _, back = np.unique(np.concatenate(values), return_inverse=True)
        docs = np.bincount(back, np.concatenate([np.frombuffer(d, "<u2") for _, d in read]))
        say = _how_sent(docs, np.bincount(back), length - anchor + 1, hot)[back]
        return frame[["run", "part"]].assign(data=[_pack(say[a:b]) for a, b in zip(sizes, sizes[1:])])

    def send(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for run, data, answers in zip(frame["run"], frame["rows"], frame["answers"]):
                ids, texts = rows_of(unpack(data))
                say = b"".join(_unpack(a["data"])[0] for a in sorted(answers if answers is not None else [], key=lambda a: a["part"]))
                own = Entries.of(texts, ids, np.frombuffer(say, np.uint8), Anchors.of(texts, length, anchor, parts), length, parts)
                if own.parts:
                    # where the suffixes stand comes back beside the answers; numbers below 0 are passed through
                    where = _pack(np.array(own.parts, "<i4"), own.seen.T.astype("<i4"))
                    yield pd.DataFrame(
                        {"run": run, "part": [*own.parts, -1 - run % parts], "data": [*map(own.block, range(len(own.parts))), where]}
                    )
        give_back()

    def merge(frame: pd.DataFrame) -> pd.DataFrame:
        if frame["part"].iloc[0] < 0:
            return frame
        found = _merged([_read_block(d) for d in frame["data"]], length, anchor)
        return frame[["run", "part"]].assign(data=[_pack(np.array(f, "<u4")) for f in found])

    def starts_of(told: list) -> tuple[np.ndarray, np.ndarray]:
        """(document, place) of all windows that an earlier document has, by document."""
        answers = {t["part"]: t["data"] for t in told}
        at, seen = _unpack(next(d for p, d in answers.items() if p < 0))
        doc, low, count, entry, earlier = np.frombuffer(seen, "<i4").reshape(5, -1).astype(np.int64)
        masks = np.concatenate([np.frombuffer(_unpack(answers[p])[0], "<u4") for p in np.frombuffer(at, "<i4").tolist()])
        mask = np.where(earlier > 0, np.uint32(0xFFFFFFFF), masks[entry])
        bit = np.arange(32)
        row, k = np.nonzero((mask[:, None] >> bit.astype(np.uint32) & 1).astype(bool) & (bit < count[:, None]))
        order = np.argsort(doc[row], kind="stable")
        return doc[row][order], (low[row] + k)[order]

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data, told in zip(batch["rows"], batch["bits"]):
                table = unpack(data.as_py())
                _, texts = rows_of(table)
                doc, start = starts_of(told.as_py()) if told.as_py() else (np.empty(0, np.int64),) * 2
                removed, spans, kept = [0] * len(texts), [0] * len(texts), list(texts)
                bound = np.searchsorted(doc, np.arange(len(texts) + 1))
                for d in np.unique(doc).tolist():
                    at = start[bound[d] : bound[d + 1]]
                    size = len(texts[d]) + 1
                    depth = np.bincount(at, minlength=size) - np.bincount(at + length, minlength=size)
                    gone, raw = np.cumsum(depth[:-1]) > 0, np.frombuffer(texts[d], np.uint8)
                    if whole_signs:
                        gone = _whole_signs(raw, gone)
                    removed[d] = int(gone.sum())
                    spans[d] = int(np.count_nonzero(np.diff(gone.astype(np.int8), prepend=0) == 1))
                    kept[d] = raw[~gone].tobytes()
                for name, values, kind in zip(_RESULT, ([len(t) for t in texts], removed, spans, kept), (pa.int64(), pa.int64(), pa.int64(), pa.binary())):
                    table = table.append_column(name, pa.array(values, kind))
                yield from table.to_batches()
        give_back()

    runs = written(df.mapInArrow(pack, "run long, rows binary"), "dedup-runs")
    blocks = "run long, part int, data binary"
    listed = F.collect_list(F.struct("part", "data"))
    asked = runs.mapInPandas(ask, blocks).groupBy("part").applyInPandas(answer, blocks).groupBy("run").agg(listed.alias("answers"))
    known = runs.join(asked, "run", "left")
    told = known.mapInPandas(send, blocks).groupBy("part").applyInPandas(merge, blocks).groupBy("run").agg(listed.alias("bits"))
    result = StructType([*df.schema.fields, *(StructField(n, LongType()) for n in _RESULT[:3]), StructField("kept", BinaryType())])
    return known.join(told, "run", "left").select("rows", "bits").mapInArrow(apply, result)
