"""Exact token counts at every prefix of a text, by prefix dynamic programming.

For a piece of text that the tokenizer merges as a whole, the encoding of each
prefix ends in one token, and removing that token leaves the encoding of a
shorter prefix. So one pass finds the last token, and with it the count, of
every prefix: the last token is the only one that ends there and that may stand
after the last token of what is before it. Two tokens may stand together if
they are the encoding of their own joined text.

A text's counts are the running sums over its words and, within a word, the
counts of its prefixes; ``PrefixCounts`` answers how many tokens a prefix has
and how long a prefix fits a budget, without encoding again.

Words repeat, so each Python worker keeps the counts of the words it has seen,
``KEPT`` at most; beyond that it forgets them and goes on. Words and pieces of
more than ``LONG`` characters are not kept: their counts stand in arrays by
position, in which a budget's cut is looked up.

Defined cases: a null text counts as empty, with 0 bytes and tokens; strings of
special tokens inside a text count as one token each, as the tokenizer's
default has it; repeated rows are counted each; an empty table gives an empty
result.
"""

from __future__ import annotations

import json
import re
import unicodedata
from array import array
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from tokenizers.models import BPE

from strata.llm.bpe_merge import byte_symbols

KEPT = 500_000
LONG = 64
# separators in Python's eyes that are no white space in Unicode's
_ODD_SPACE = re.compile("[\x1c-\x1f]")
_ASCII_SPACE = re.compile("[ \t\n\r\x0b\x0c]+")
# letters that normalizing only makes lower-case, and that are one piece, with a sign behind them
_LATIN = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([,.;:!?]?)")
_BYTES = byte_symbols()
_SYMBOLS = {c: "".join(_BYTES[b] for b in chr(c).encode()) for c in range(0xC0, 0x100)}
_ONE = (1,)


class PrefixTokenizer:
    """Counts for a tokenizers file whose model is pair encoding with word ends."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.tokenizer = Tokenizer.from_file(path)
        model = spec["model"]
        self.end = model["end_of_word_suffix"] or ""
        closed, opened = set(), set()
        for token in model["vocab"]:
            if self.end and token.endswith(self.end):
                closed.add(token[: -len(self.end)])
            else:
                opened.add(token)
                if not self.end:
                    closed.add(token)
        # the model itself, and the same merges without word ends
        self.ended = self.tokenizer.model
        self.bare = BPE(model["vocab"], [tuple(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]])
        # a token that its own merges do not give never ends a prefix
        self.closed = {t for t in closed if len(self.ended.tokenize(t)) == 1}
        self.opened = {t for t in opened if len(self.bare.tokenize(t)) == 1}
        self.most_closed, self.most_opened = max(map(len, self.closed)), max(map(len, self.opened))
        self.closed_sizes, self.opened_sizes = _sizes_by_end(self.closed), _sizes_by_end(self.opened)
        self.special = {t["content"] for t in spec["added_tokens"]}
        self.specials = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self.pairs: dict[tuple[str, str, bool], bool] = {}
        self.states: dict[str, tuple[str, int]] = {}
        self.closings: dict[str, int] = {}
        self.words: dict[str, int] = {}
        self.latest: LongWord | None = None

    def _together(self, a: str, b: str, closed: bool) -> bool:
        key = (a, b, closed)
        if (known := self.pairs.get(key)) is None:
            got = (self.ended if closed else self.bare).tokenize(a + b)
            known = len(got) == 2 and got[0].value == a
            if len(self.pairs) > 2 * KEPT:
                self.pairs.clear()
            self.pairs[key] = known
        return known

    def _state(self, text: str) -> tuple[str, int]:
        """Last token and token count of a prefix that goes on; every shorter prefix is stored on the way."""
        if (known := self.states.get(text)) is not None:
            return known
        n = len(text)
        while n and text[:n] not in self.states:
            n -= 1
        states, opened, sizes, together = self.states, self.opened, self.opened_sizes, self._together
        for i in range(n + 1, len(text) + 1):
            for size in sizes.get(text[max(0, i - 2) : i], _ONE):
                token = text[i - size : i] if size <= i else ""
                if token in opened:
                    if size == i:
                        states[token] = (token, 1)
                        break
                    before = states[text[: i - size]]
                    if before[0] and together(before[0], token, False):
                        states[text[:i]] = (token, before[1] + 1)
                        break
        return states[text]

    def piece_count(self, piece: str) -> int:
        """Tokens of a piece, or of a prefix of one, in byte symbols, as a text of its own."""
        if len(piece) > LONG:
            return PieceCounts(self, piece).closed[-1]
        if (known := self.closings.get(piece)) is not None:
            return known
        if len(self.closings) + len(self.states) >= KEPT:
            self.closings.clear()
            self.states.clear()
        if piece[:-1]:
            self._state(piece[:-1])
        for size in self.closed_sizes.get(piece[-2:], _ONE):
            begin = len(piece) - size
            token = piece[begin:] if begin >= 0 else ""
            if token in self.closed:
                before = self.states[piece[:begin]] if begin else ("", 0)
                if not begin or (before[0] and self._together(before[0], token, True)):
                    self.closings[piece] = before[1] + 1
                    return before[1] + 1
        raise ValueError(f"the vocabulary has no tokens for {piece!r}")

    def pieces_of(self, word: str) -> list[str]:
        """What the tokenizer merges separately, in byte symbols."""
        if found := _LATIN.fullmatch(word):
            letters = found[1].lower().translate(_SYMBOLS)
            return [letters, found[2]] if found[2] else [letters]
        plain = self.tokenizer.normalizer.normalize_str(word) if self.tokenizer.normalizer else word
        return [p for p, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(plain)]

    def word_count(self, word: str) -> int:
        if (known := self.words.get(word)) is not None:
            return known
        if len(word) > LONG:
            return self.long_word(word).tokens(len(word))
        n = sum(map(self.piece_count, self.pieces_of(word)))
        if len(self.words) >= KEPT:
            self.words.clear()
        self.words[word] = n
        return n

    def long_word(self, word: str) -> LongWord:
        if self.latest is None or self.latest.word != word:
            self.latest = LongWord(self, word)
        return self.latest

    def cut(self, plain: str) -> list[tuple[str, tuple[int, int]]]:
        """The pieces of a normalized text in byte symbols, each with its place in the text."""
        return self.tokenizer.pre_tokenizer.pre_tokenize_str(plain)

    def spans(self, text: str) -> list[str]:
        """The words of a text; special tokens stand as words of their own."""
        if self.specials and "<|" in text and self.specials.search(text):
            out, at = [], 0
            for m in self.specials.finditer(text):
                out += [*self.spans(text[at : m.start()]), m[0]]
                at = m.end()
            return out + self.spans(text[at:])
        if _ODD_SPACE.search(text):
            return [w for w in _ASCII_SPACE.split(text) if w]
        return text.split()

    def count_of(self, word: str) -> int:
        return 1 if word in self.special else self.word_count(word)

    def counts(self, words: list[str]) -> list[int]:
        """Tokens of each word that ``spans`` has found."""
        get, slow = self.words.get, self.count_of
        return [n if (n := get(w)) is not None else slow(w) for w in words]

    def inside(self, word: str, n: int) -> int:
        """Tokens of the first ``n`` characters of a word."""
        if n >= len(word):
            return self.count_of(word)
        if len(word) > LONG:
            return self.long_word(word).tokens(n)
        return sum(map(self.piece_count, self.pieces_of(word[:n]))) if n else 0

    def fit(self, text: str, words: list[str], counts: list[int], budget: int) -> int:
        """The most characters from the start of a text that have at most ``budget`` tokens, given its words' counts.

        Only the word in which the budget ends is looked into; a long one is not cut
        before a sign that joins with what is before it, such as a combining mark.
        """
        left, k = budget, 0
        while k < len(words) and counts[k] <= left:
            left, k = left - counts[k], k + 1
        if k == len(words):
            return len(text)
        end = 0
        for word in words[:k]:
            end = text.index(word, end) + len(word)
        word, begin = words[k], text.index(words[k], end)
        places = reversed(self.long_word(word).at[:-1]) if len(word) > LONG and word not in self.special else range(len(word) - 1, 0, -1)
        # what comes before a word may end with its white space: that has no tokens
        inside = next((n for n in places if n and self.inside(word, n) <= left), 0)
        return begin + inside


def _sizes_by_end(tokens: set[str]) -> dict[str, tuple[int, ...]]:
    """By the last two symbols of a text: how long the tokens at its end may be, long ones first."""
    sizes: dict[str, set[int]] = {}
    for token in tokens:
        if len(token) > 1:
            sizes.setdefault(token[-2:], {1}).add(len(token))
    return {end: tuple(sorted(some, reverse=True)) for end, some in sizes.items()}


class PieceCounts:
    """By position in a piece: tokens of the prefix as a text of its own, and last token and count if it goes on."""

    def __init__(self, tokenizer: PrefixTokenizer, piece: str):
        self.tokenizer, self.piece = tokenizer, piece
        self.last, self.open, self.closed = array("q", [0]), array("q", [0]), array("q", [0])
        self._go_on()

    def _before(self, i: int, tokens: set[str], sizes: dict[str, tuple[int, ...]], closed: bool) -> int:
        for size in sizes.get(self.piece[max(0, i - 2) : i], _ONE):
            begin = i - size
            token = self.piece[begin:i] if begin >= 0 else ""
            if token in tokens:
                last = self.last[begin]
                if not begin or (last and self.tokenizer._together(self.piece[begin - last : begin], token, closed)):
                    return begin
        return -1

    def _go_on(self) -> None:
        t = self.tokenizer
        for i in range(len(self.last), len(self.piece) + 1):
            if (begin := self._before(i, t.closed, t.closed_sizes, True)) < 0:
                raise ValueError(f"the vocabulary has no tokens for {self.piece[:i]!r}")
            self.closed.append(self.open[begin] + 1)
            begin = self._before(i, t.opened, t.opened_sizes, False)
            self.last.append(i - begin if begin >= 0 else 0)
            self.open.append(self.open[begin] + 1 if begin >= 0 else 0)

    def with_end(self, i: int, end: str) -> int:
        """Tokens of the first ``i`` symbols and ``end``; looks back two tokens at most."""
        low = max(0, i - self.tokenizer.most_closed - 2 * self.tokenizer.most_opened)
        new = object.__new__(PieceCounts)
        new.tokenizer, new.piece = self.tokenizer, self.piece[low:i] + end
        new.last, new.open, new.closed = self.last[low : i + 1], self.open[low : i + 1], self.closed[low : i + 1]
        new._go_on()
        return new.closed[-1]


def _stands_alone(c: str) -> bool:
    """Whether normalizing never joins a character with what is before it."""
    if c.isascii():
        return True
    kind, n = unicodedata.category(c), ord(c)
    jamo = 0x1100 <= n <= 0x11FF or 0xA960 <= n <= 0xA97F or 0xD7B0 <= n <= 0xD7FF
    return kind[0] not in "MZ" and kind != "Cn" and not jamo and not c.isspace() and unicodedata.normalize("NFC", c) == c


class LongWord:
    """Token counts of a word's prefixes, each piece being cut and counted once."""

    def __init__(self, tokenizer: PrefixTokenizer, word: str):
        self.tokenizer, self.word = tokenizer, word
        # where characters begin that stand alone, in the word and in the normalized word
        self.at = [n for n, c in enumerate(word) if not n or _stands_alone(c)] + [len(word)]
        plain = [self._plain(word[a:b]) for a, b in zip(self.at, self.at[1:])]
        self.plain = "".join(plain)
        self.plain_at = [0, *accumulate(map(len, plain))]
        self.begins, self.ends, self.runs, self.sums = [], [], [], [0]
        for symbols, (begin, end) in tokenizer.cut(self.plain):
            run = PieceCounts(tokenizer, symbols) if end - begin > LONG else None
            self.begins.append(begin)
            self.ends.append(end)
            # a run and where its characters end, in symbols
            self.runs.append(run and (run, array("q", [0, *accumulate(len(c.encode()) for c in self.plain[begin:end])])))
            self.sums.append(self.sums[-1] + (run.closed[-1] if run else tokenizer.piece_count(symbols)))

    def _plain(self, part: str) -> str:
        normalizer = self.tokenizer.tokenizer.normalizer
        return (part.lower() if part.isascii() and not part.isspace() else normalizer.normalize_str(part)) if normalizer else part

    def tokens(self, chars: int) -> int:
        """Tokens of the word's first ``chars`` characters."""
        t = self.tokenizer
        k = bisect_right(self.at, chars) - 1
        end = self.plain_at[k]
        more = self._plain(self.word[self.at[k] : chars])
        p = bisect_left(self.ends, end)
        if p == len(self.ends) or self.begins[p] >= end:  # between pieces
            return self.sums[p] + sum(t.piece_count(s) for s, _ in t.cut(more))
        begin = self.begins[p]
        if end == self.ends[p] and not more:
            return self.sums[p + 1]
        if not self.runs[p]:
            return self.sums[p] + sum(t.piece_count(s) for s, _ in t.cut(self.plain[begin:end] + more))
        run, symbols = self.runs[p]
        if not more:
            return self.sums[p] + run.closed[symbols[end - begin]]
        # a run is of letters or of other signs, and goes on with what is like it
        first, *rest = t.cut(("a" if unicodedata.category(self.plain[begin])[0] == "L" else "#") + more)
        return self.sums[p] + run.with_end(symbols[end - begin], first[0][1:]) + sum(t.piece_count(s) for s, _ in rest)


class PrefixCounts:
    """The running counts of one text."""

    def __init__(self, tokenizer: PrefixTokenizer, text: str):
        self.tokenizer, self.text, at = tokenizer, text, 0
        self.words, self.ends = [], []
        for word in tokenizer.spans(text):
            at = text.index(word, at) + len(word)
            self.words.append(word)
            self.ends.append(at)
        self.sums = [0, *accumulate(map(tokenizer.count_of, self.words))]

    def tokens(self, chars: int) -> int:
        """Tokens of the text's first ``chars`` characters."""
        k = bisect_right(self.ends, chars)
        if k == len(self.words):
            return self.sums[k]
        begin = self.ends[k] - len(self.words[k])
        return self.sums[k] + (self.tokenizer.inside(self.words[k], chars - begin) if chars > begin else 0)

    def fit(self, budget: int) -> int:
        """The most characters from the start that have at most ``budget`` tokens."""
        counts = [b - a for a, b in zip(self.sums, self.sums[1:])]
        return self.tokenizer.fit(self.text, self.words, counts, budget)


@lru_cache(2)
def prefix_tokenizer(path: str) -> PrefixTokenizer:
    return PrefixTokenizer(path)


def count_tokens(
    df: DataFrame, tokenizer_path: str, budget: int = 2048, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """id, n_bytes, n_tokens, over_limit (n_tokens > budget), fit_chars (longest prefix within the budget)."""
    kind = dict(df.select(F.col(id_col).alias("id")).dtypes)["id"]
    rows = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokenizer = prefix_tokenizer(tokenizer_path)
        for frame in frames:
            n, fit = [], []
            for text in frame["text"]:
                words = tokenizer.spans(text)
                counts = tokenizer.counts(words)
                n.append(sum(counts))
                fit.append(len(text) if n[-1] <= budget else tokenizer.fit(text, words, counts, budget))
            yield pd.DataFrame(
                {"id": frame["id"], "n_bytes": [len(t.encode()) for t in frame["text"]], "n_tokens": n,
                 "over_limit": [m > budget for m in n], "fit_chars": fit}
            )

    schema = f"id {kind}, n_bytes long, n_tokens long, over_limit boolean, fit_chars long"
    return rows.mapInPandas(count, schema).withColumnRenamed("id", id_col)
