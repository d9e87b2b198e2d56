"""Web archives: writing, reading back, and a globally ordered index of captures.

``write_archives`` turns each row into a WARC 1.1 record. Of the rows with equal
payloads of at least ``least_bytes`` bytes the one with the smallest id becomes
a response, the others revisits that name it and carry no payload. Spark's text
writer writes the records (every record ends with a line end, and header and
payload are UTF-8), so archives lie in any store that Spark reaches, and a lost
executor's files are written again. Files are compressed as a whole; offsets
count in the uncompressed archive.

``read_archives`` reads whole files of bounded size and cuts them by the
records' Content-Length. ``capture_index`` is an external merge: each archive's
captures are sorted where they are read, cut into pieces at splitters that a
sample of keys gives, and sent as packed pieces; each range merges its pieces
with a tree of losers by (url key, time, id), so that the ranges in order hold
every URL's captures in the order of time.

Defined cases: a null payload is empty; a null url becomes an empty target, a
null id is written as -1 and read as null; rows that repeat an id are all kept,
and of equal payloads under one id one is the response; empty payloads count as
equal payloads if ``least_bytes`` is 0; an empty table gives an empty archive.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import pickle
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.loser_tree import merge_runs

_RECORD = (
    "page_id long, record_type string, refers_to long, url string, captured string, payload_bytes long,"
    " payload_digest string, payload string, archive string, offset long, length long"
)
_INDEX = (
    "url_key string, captured string, page_id long, record_type string, refers_to long, payload_bytes long,"
    " payload_digest string, archive string, offset long, length long"
)
_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 of the SHA-1 of a text's UTF-8 bytes."""
    digest = F.sha1(F.encode(payload, "UTF-8"))
    signs = []
    for group in range(8):
        # 5 hexadecimal digits are 20 bits, which are 4 signs
        value = F.conv(F.substring(digest, 5 * group + 1, 5), 16, 10).cast("int")
        signs += [F.substring(F.lit(_ALPHABET), F.shiftright(value, 5 * (3 - n)).bitwiseAND(31) + 1, F.lit(1)) for n in range(4)]
    return F.concat(*signs)


def _clean(value: Column) -> Column:
    """A header's value: line ends and other control signs, and %, as %XX."""
    out = F.replace(value, F.lit("%"), F.lit("%25"))
    for code in [*range(32), 127]:
        out = F.replace(out, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    return out


def write_archives(
    df: DataFrame, path: str, least_bytes: int = 0, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html"
) -> None:
    rows = df.select(
        F.col(id_col).cast("long").alias("id"),
        F.coalesce(F.col(url_col), F.lit("")).alias("url"),
        F.coalesce(F.col(payload_col), F.lit("")).alias("payload"),
    )
    rows = rows.withColumns({"size": F.octet_length("payload").cast("long"), "same": F.unhex(F.sha2("payload", 256))})
    rank = F.struct(F.col("id").isNull().alias("none"), "id")
    first = rows.where(F.col("size") >= least_bytes).groupBy("same").agg(F.min(rank).alias("first"))
    known = rows.join(first, "same", "left")
    revisit = F.col("first").isNotNull() & ~F.col("first.id").eqNullSafe(F.col("id"))
    number = F.coalesce("id", F.lit(-1)).cast("string")
    line = "\r\n"
    head = [
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), F.when(revisit, "revisit").otherwise("response")),
        F.concat(F.lit("WARC-Record-ID: <urn:page:"), number, F.lit(">")),
        F.concat(F.lit("WARC-Target-URI: "), _clean(F.col("url"))),
        # the table holds no capture time: one page a second from a fixed day on
        F.concat(F.lit("WARC-Date: "), F.date_format(F.timestamp_seconds(F.lit(1704067200) + F.pmod(F.coalesce("id", F.lit(0)), F.lit(10**9))), "yyyy-MM-dd'T'HH:mm:ss'Z'")),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), base32_sha1(F.col("payload"))),
        F.concat(F.lit("WARC-Payload-Length: "), F.col("size").cast("string")),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: <urn:page:"), F.coalesce("first.id", F.lit(-1)).cast("string"), F.lit(">"))),
        F.when(revisit, "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
        F.lit("Content-Type: text/html"),
        F.concat(F.lit("Content-Length: "), F.when(revisit, F.lit(0)).otherwise(F.col("size")).cast("string")),
    ]
    # two line ends close a record; the last sign of the second is the text writer's own
    record = F.concat(F.concat_ws(line, *head), F.lit(2 * line), F.when(revisit, "").otherwise(F.col("payload")), F.lit("\r\n\r"))
    known.select(record.alias("value")).write.options(lineSep="\n", compression="gzip", maxRecordsPerFile=1000).text(path)


def _records(data: bytes) -> Iterator[tuple[dict[str, str], bytes, int, int]]:
    """(headers, payload, offset, length) of each record."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record begins at {at}")
        head = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])
        begin = end + 4
        stop = begin + int(head["Content-Length"])
        if data[stop : stop + 4] != b"\r\n\r\n":
            raise ValueError(f"the record at {at} does not end where it says")
        yield head, data[begin:stop], at, stop + 4 - at
        at = stop + 4


def _plain(value: str) -> str:
    return value if "%" not in value else "".join(
        p if n == 0 else chr(int(p[:2], 16)) + p[2:] for n, p in enumerate(value.split("%"))
    )


def _number(value: str | None) -> int | None:
    n = int(value.removeprefix("<urn:page:").removesuffix(">")) if value else -1
    return None if n == -1 else n


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Every record; a response's digest and length are those of the bytes that were read."""

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for archive, packed in zip(frame["path"], frame["content"]):
                data, out = gzip.decompress(packed), []
                for head, payload, offset, length in _records(data):
                    revisit = head["WARC-Type"] == "revisit"
                    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
                    told = head["WARC-Payload-Digest"].removeprefix("sha1:")
                    if not revisit and digest != told:
                        raise ValueError(f"the payload at {offset} of {archive} is damaged")
                    out.append((
                        _number(head["WARC-Record-ID"]), head["WARC-Type"], _number(head.get("WARC-Refers-To")),
                        _plain(head["WARC-Target-URI"]), head["WARC-Date"], int(head["WARC-Payload-Length"]) if revisit else len(payload),
                        told, None if revisit else payload.decode(), archive.rpartition("/")[2], offset, length,
                    ))
                names = [c.split()[0] for c in _RECORD.split(", ")]
                yield pd.DataFrame(out, columns=names).astype({"page_id": "Int64", "refers_to": "Int64"})

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")
    return files.mapInPandas(read, _RECORD)


def url_key(url: str) -> str:
    """Host labels from the last to the first, then path and query: pages of a site are neighbours."""
    host, slash, rest = url.partition("://")[2].partition("/")
    return ",".join(reversed(host.lower().split("."))) + ")" + slash + rest


def capture_index(records: DataFrame, ranges: int = 16, sample_keys: int = 4096) -> DataFrame:
    """Captures in global order: range by range, and by url key, time and id within a range (``place`` counts there).

    ``sample_keys`` bounds what the driver sees: keys with the smallest hashes,
    from which the splitters between ranges are taken. Splitters are whole keys
    with time and id, so a URL with very many captures spans several ranges.
    """
    keyed = F.udf(url_key, "string", useArrow=True)
    none = {n: F.coalesce(n, F.lit(-1)) for n in ("page_id", "refers_to")}
    rows = records.select("*", keyed("url").alias("url_key")).withColumns(none)
    names = [c.split()[0] for c in _INDEX.split(", ")]
    rows = rows.select(*names)
    sample = rows.select("url_key", "captured", "page_id").orderBy(F.xxhash64("archive", "offset")).limit(sample_keys).collect()
    keys = sorted(map(tuple, sample))
    splitters = sorted({keys[len(keys) * n // ranges] for n in range(1, ranges)}) if keys else []

    def pieces(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            captures = sorted(frame.itertuples(index=False, name=None))
            at = 0
            for n, splitter in enumerate([*splitters, None]):
                begin = at
                while at < len(captures) and (splitter is None or captures[at][:3] < splitter):
                    at += 1
                if at > begin:
                    yield pd.DataFrame({"range": [n], "piece": [zlib.compress(pickle.dumps(captures[begin:at]))]})

    def merge(frame: pd.DataFrame) -> pd.DataFrame:
        runs = [pickle.loads(zlib.decompress(p)) for p in frame["piece"]]
        out = pd.DataFrame(list(merge_runs(runs, lambda c: c)), columns=names)
        for name in ("page_id", "refers_to"):
            out[name] = out[name].astype("Int64").where(out[name] != -1)
        return out.assign(range=frame["range"].iloc[0], place=range(len(out)))

    packed = rows.mapInPandas(pieces, "range int, piece binary")
    return packed.groupBy("range").applyInPandas(merge, f"{_INDEX}, range int, place long")
