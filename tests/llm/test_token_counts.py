import random
import time

import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from strata.llm.queries import op2_token_counts
from strata.llm.token_counts import PrefixCounts, PrefixTokenizer, count_tokens
from tests.llm.cases import documents, plain, rows_of

PATH = public_tokenizers.path("word_bpe_49k.json")
SMALL = "/root/testdata/sf0.001"


def expected(rows, budget):
    library = Tokenizer.from_file(PATH)
    n = [len(library.encode(t, add_special_tokens=False).ids) for _, t in rows]
    return sorted(((i, len(t.encode()), k, k > budget) for (i, t), k in zip(rows, n)), key=repr)


def test_every_prefix_counts_as_the_library_does():
    ours, library, pick = PrefixTokenizer(PATH), Tokenizer.from_file(PATH), random.Random(1)
    signs = "aabcdeeeiolnrstthé ' .,!19ßÉñ日本\x1c\xa0́-"
    for _ in range(300):
        text = "".join(pick.choice(signs) for _ in range(pick.randint(0, 25)))
        counts = PrefixCounts(ours, text)
        for n in range(len(text) + 1):
            assert counts.tokens(n) == len(library.encode(text[:n], add_special_tokens=False).ids), (text, n)
        fits = [n for n in range(len(text) + 1) if counts.tokens(n) <= 5]
        assert counts.tokens(counts.fit(5)) <= 5 and counts.fit(5) <= max(fits)


def test_prefixes_of_long_words_count_as_the_library_does():
    ours, library, pick = PrefixTokenizer(PATH), Tokenizer.from_file(PATH), random.Random(3)
    for signs, most in (("abcdeinorstABZ", 130), ("aB9+/=", 130), ("aé日本ßİΣ'sde\u0301\u0338=#", 130), ("日本語文字", 90), ("e\u0301a", 150), ("#'=\u0338-", 130), ("\x1c\xa0ab\u0301", 200)):
        for _ in range(3):
            text = "".join(pick.choice(signs) for _ in range(most))
            counts = PrefixCounts(ours, text)
            true = [len(library.encode(text[:n], add_special_tokens=False).ids) for n in range(most + 1)]
            assert [counts.tokens(n) for n in range(most + 1)] == true, text
            assert true[counts.fit(20)] <= 20


def test_words_of_200_000_characters():
    ours, library, pick = PrefixTokenizer(PATH), Tokenizer.from_file(PATH), random.Random(4)
    for signs in ("abcdefghijklmnopqrstuvwxyz", "ABCDEFghijklmnop0123456789+/"):
        word = "".join(pick.choice(signs) for _ in range(200_000))
        begin = time.monotonic()
        fit = PrefixCounts(ours, word).fit(2048)
        assert time.monotonic() - begin < 60
        n = [len(library.encode(word[:m], add_special_tokens=False).ids) for m in range(fit, fit + 40)]
        assert n[0] <= 2048 and min(n[1:]) > 2048
        assert len(ours.states) < 1_000_000


def test_cases(spark):
    df = documents(spark, [(1, "a<|endoftext|>b"), (2, "it's THE naïve"), (3, None), (4, ""), (5, "word " * 3000), (None, "x"), (5, "y"), (5, "y")])
    df = df.withColumn("n_tokens", F.lit("clash"))
    assert rows_of(count_tokens(df, PATH, 100), "doc_id", "n_bytes", "n_tokens", "over_limit") == expected(plain(df), 100)
    assert count_tokens(df.limit(0), PATH).count() == 0


def test_query_over_the_whole_table(spark):
    rows = plain(spark.read.parquet(f"{SMALL}/documents.parquet"))
    assert rows_of(op2_token_counts(spark, SMALL), "doc_id", "n_bytes", "n_tokens", "over_limit") == expected(rows, 2048)


def test_words_of_200_000_marks():
    ours, pick = PrefixTokenizer(PATH), random.Random(5)
    for signs in ("̸̧̖́", "ᅡᆨ", "͸"):
        word = "e" + "".join(pick.choice(signs) for _ in range(200_000))
        begin = time.monotonic()
        counts = PrefixCounts(ours, f"some words before {word} after")
        fit = counts.fit(2048)
        assert time.monotonic() - begin < 10
        assert fit in (len("some words before "), len("some words before e"))
        assert counts.tokens(fit) <= 2048 < counts.sums[-1]


def test_budget_ends_in_any_word():
    ours, library, pick = PrefixTokenizer(PATH), Tokenizer.from_file(PATH), random.Random(6)
    words = ["it's", "naïve", "the", "été", "x" * 80, "<|endoftext|>", "日本語", "12,5"]
    for _ in range(60):
        text = " ".join(pick.choice(words) for _ in range(20))
        true = [len(library.encode(text[:n], add_special_tokens=False).ids) for n in range(len(text) + 1)]
        budget = pick.randint(0, 40)
        found = ours.fit(text, spans := ours.spans(text), ours.counts(spans), budget)
        assert found == PrefixCounts(ours, text).fit(budget)
        assert true[found] <= budget
        # a short word may be cut anywhere, so nothing longer fits unless it ends within a special token's text
        if "<|" not in text:
            assert found >= max(n for n in range(len(text) + 1) if true[n] <= budget) - 1
