import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from strata.llm.bpe import ByteBpe, encode_documents, join_tree, leaves
from strata.llm.queries import op4_bpe_codec
from tests.llm.cases import documents, plain, rows_of

PATH = public_tokenizers.path("byte_bpe_50k.json")
SMALL = "/root/testdata/sf0.001"


def expected(rows):
    library, out = Tokenizer.from_file(PATH), []
    for i, t in rows:
        ids = library.encode(t, add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        out.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()))
    return sorted(out, key=repr)


def test_joined_halves_are_the_whole_texts_encoding():
    bpe, pick = ByteBpe(PATH), random.Random(2)
    kinds = [
        ["a", "b", "th", "in", "er", " ", "  ", "\n", "'s", "'ll", "'", "l", "1", "23", ".", "!!", "é", "日", "\xa0", "\x1c", "😀"],
        ["a", "b", "th", "er", "in", "e"], ["'", "l", "s", "ll", "re"], [" ", "\n", "  ", "x"],
    ]
    for _ in range(2000):
        text = "".join(pick.choice(kinds[pick.randrange(4)]) for _ in range(pick.randint(1, 40)))
        want = bpe.tokenizer.encode(text, add_special_tokens=False).ids
        assert join_tree(bpe, [bpe.units(x) for x in leaves(text, pick.randint(1, 9))]).ids() == want, text
        assert np.frombuffer(bpe.encode([text])[0], "<u4").tolist() == want
        assert bpe.decode(np.array(want, "<u4").tobytes()) == text


def test_ids_that_are_no_text():
    bpe = ByteBpe(PATH)
    half = bpe.tokenizer.encode("日", add_special_tokens=False).ids[:1]
    assert bpe.decode(np.array(half, "<u4").tobytes()) == bpe.tokenizer.decode(half, skip_special_tokens=False)


@pytest.mark.parametrize("leaf_chars", [1 << 16, 40])
def test_cases(spark, leaf_chars):
    df = documents(spark).union(documents(spark, [(60, "ab" * 500), (61, "x<|endoftext|> y" * 20), (61, "x<|endoftext|> y" * 20)]))
    df = df.withColumn("ids", F.lit(1)).withColumn("part", F.lit(1))
    got = encode_documents(df, PATH, leaf_chars=leaf_chars, digests=True)
    assert rows_of(got, "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == expected(plain(df))
    assert encode_documents(df.limit(0), PATH, leaf_chars=leaf_chars).count() == 0


def test_query_over_the_whole_table(spark):
    rows = plain(spark.read.parquet(f"{SMALL}/documents.parquet"))
    assert rows_of(op4_bpe_codec(spark, SMALL), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == expected(rows)
