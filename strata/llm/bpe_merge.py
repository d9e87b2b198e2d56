"""What byte-pair encodings of joined texts have in common with those of the parts.

The merges of a pair encoding depend on symbols only. A row of tokens is the
encoding of its text exactly if each two neighbours are the encoding of their
own joined text, so two encodings can be joined by encoding a window around the
seam anew, once the window begins with a token of the left side and ends with
one of the right side.
"""

from __future__ import annotations

from collections.abc import Callable


def byte_symbols() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(other)}


def join_encodings(
    left: list[int], right: list[int], text: Callable[[int], str], encode: Callable[[str], list[int]]
) -> list[int]:
    """The encoding of the joined text of two encodings, from ever larger windows around the seam."""
    if not left or not right:
        return left + right
    width = 1
    while True:
        a, b = max(0, len(left) - width), min(len(right), width)
        window = encode("".join(map(text, left[a:] + right[:b])))
        # at its ends the window has to agree with what lies beyond it
        starts = a == 0 or window[0] == left[a]
        ends = b == len(right) or window[-1] == right[b - 1]
        if starts and ends and (len(window) > 1 or (a == 0 and b == len(right))):
            return left[:a] + window + right[b:]
        width *= 2
