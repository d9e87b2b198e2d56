import hashlib
import random
from collections import Counter
from itertools import takewhile

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from strata.llm import token_alignment
from strata.llm.queries import op13_token_alignment
from strata.llm.token_alignment import Aligner, align_tokens, link_scores, pair_bitmaps, pair_counts, places_of, vocabulary_size
from tests.llm.cases import documents, rows_of

PATH_A, PATH_B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
SMALL = "/root/testdata/sf0.001"
COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.fixture(scope="module")
def plain_tokens():
    """(id, bytes) of each token by the libraries, as the definition says it."""
    a, b = Tokenizer.from_file(PATH_A), SentencePieceProcessor(model_file=PATH_B)
    a.encode_special_tokens = True
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [n for n in range(256) if n not in printable]
    byte = {chr(n): n for n in printable} | {chr(256 + k): n for k, n in enumerate(rest)}
    name = {i: t for t, i in a.get_vocab(with_added_tokens=False).items()}

    def tokens(text):
        side_a = [(i, bytes(byte[c] for c in name[i])) for i in a.encode(" " + text, add_special_tokens=False).ids]
        side_b = []
        for i in b.encode(text):
            p = b.id_to_piece(i)
            side_b.append((i, bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()))
        return side_a, side_b

    return tokens


def plain_alignment(tokens, text):
    """Counts, links and groups from the tokens' ranges."""
    if not text:
        return (0, 0, 0, 0), [], ""
    sides = tokens(text)
    if any(b"".join(x for _, x in side) != b" " + text.encode() for side in sides):
        return (0, 0, 0, 0), [], ""
    ranges = []
    for side in sides:
        ends = np.cumsum([len(x) for _, x in side]).tolist()
        ranges.append([(i, end - len(x), end) for (i, x), end in zip(side, ends)])
    links, first = [], 0
    for i, s, e in ranges[0]:
        while ranges[1][first][2] <= s:  # ends before this token and all later ones
            first += 1
        links += [(i, j) for j, u, v in takewhile(lambda x: x[1] < e, ranges[1][first:])]
    cuts = sorted({e for _, _, e in ranges[0]} & {e for _, _, e in ranges[1]})
    groups, at = [], [0, 0]
    for cut in cuts:
        parts = []
        for k, side in enumerate(ranges):
            begin = at[k]
            while at[k] < len(side) and side[at[k]][2] <= cut:
                at[k] += 1
            parts.append(",".join(str(i) for i, _, _ in side[begin : at[k]]))
        groups.append("|".join(parts))
    return (len(ranges[0]), len(ranges[1]), len(cuts), len(links)), links, hashlib.sha256(";".join(groups).encode()).hexdigest()


def expected(tokens, rows):
    every = [(i, plain_alignment(tokens, t)) for i, t in rows]
    count = Counter(p for _, (_, links, _) in every for p in links)
    most = {}
    for (_, b), n in count.items():
        most[b] = max(most.get(b, 0), n)
    return sorted(
        ((i, *counts, sum(count[p] == most[p[1]] for p in links), sum(count[p] for p in links), digest) for i, (counts, links, digest) in every),
        key=repr,
    )


def test_texts_of_odd_signs(plain_tokens):
    ours, pick = Aligner(PATH_A, PATH_B), random.Random(2)
    texts = ["", None, "a", " ", "  a", "a ", "<s> x </s><|endoftext|>", "▁", "a ▁b", "x\x00y", "​ a", "a b c", "a\n b\n  c d\t e", "\t \n x"]
    for signs in ("ab  ", "a \n\t\r", "é日 ▁　😀x ", "<s>|endoftx "):
        texts += ["".join(pick.choice(signs) for _ in range(pick.randint(1, 40))) for _ in range(150)]
    texts.append("q" * 3000)
    for _ in range(2):  # the second time from what was kept
        found = ours.align(texts)
        begin = np.cumsum(found.counts[:, 3]) - found.counts[:, 3]
        for i, t in enumerate(texts):
            counts, links, digest = plain_alignment(plain_tokens, t or "")
            assert tuple(found.counts[i].tolist()) == counts, t
            codes = found.codes[begin[i] : begin[i] + counts[3]]
            assert [divmod(c, 32000) for c in codes.tolist()] == links, t
            assert found.digests[i] == digest, t


def test_bitmaps_hold_every_place():
    pick = np.random.default_rng(3)
    key = np.unique(pick.integers(0, 40, 3000) * 70_000 + pick.integers(0, 900, 3000))
    code, doc, n = key // 70_000, key % 70_000, pick.integers(1, 20, len(key))
    code = np.where(code < 3, 0, code)
    key, at = np.unique(code * 70_000 + doc, return_index=True)
    code, doc, n = code[at], doc[at], n[at]
    found = pair_bitmaps(code, doc, n, 900)
    again = Counter()
    for c, p, d, b in zip(found["code"], found["plane"], found["dense"], found["bitmap"]):
        for place in places_of(d, b).tolist():
            again[int(c), place] += 1 << int(p)
    assert again == Counter(dict(zip(zip(code.tolist(), doc.tolist()), n.tolist())))
    assert any(found["dense"]) and not all(found["dense"])
    for name, weight in (("pair_docs", np.ones(len(n), int)), ("pair_links", n)):
        assert np.array_equal(np.bincount(found["code"], found[name]), np.bincount(code, weight))
    assert len(pair_bitmaps(code[:0], doc[:0], n[:0], 5)["code"]) == 0


@pytest.mark.parametrize("links", [1 << 21, 60])
def test_cases(spark, plain_tokens, monkeypatch, links):
    monkeypatch.setattr(token_alignment, "BLOCK_LINKS", links)
    df = documents(spark).withColumn("block", F.lit("clash")).withColumn("n_links", F.lit(0))
    rows = [(r["doc_id"], r["text"] or "") for r in df.collect()]
    docs, bitmaps = align_tokens(df, PATH_A, PATH_B)
    counts = pair_counts(bitmaps, vocabulary_size(PATH_B))
    assert rows_of(link_scores(docs, bitmaps, counts).withColumnRenamed("id", "doc_id"), *COLUMNS) == expected(plain_tokens, rows)
    pairs, in_docs = Counter(), Counter()
    for _, t in rows:
        found = plain_alignment(plain_tokens, t)[1]
        pairs.update(found)
        in_docs.update(set(found))
    assert {(r["id_a"], r["id_b"]): (r["n_docs"], r["n_links"]) for r in counts.collect()} == {p: (in_docs[p], n) for p, n in pairs.items()}
    for few in (df.limit(0), df.where("text is null")):
        docs, bitmaps = align_tokens(few, PATH_A, PATH_B)
        found = link_scores(docs, bitmaps, pair_counts(bitmaps, 32000)).collect()
        assert [(r["n_links"], r["count_sum"], r["groups_sha256"]) for r in found] == [(0, 0, "")] * few.count()


def test_query_over_the_whole_table(spark, plain_tokens):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    assert rows_of(op13_token_alignment(spark, SMALL), *COLUMNS) == expected(plain_tokens, rows)
