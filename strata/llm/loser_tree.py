"""Merging sorted runs with trees of losers.

Each inner node of the tree keeps the source that lost there, so the next
winner is found with one comparison for each level above the last winner.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

_DONE = 1 << 62


def merge_runs(runs: Sequence[Iterator], key: Callable) -> Iterator:
    """The items of all sorted runs in order; equal keys in the order of the runs."""
    runs = [iter(r) for r in runs]
    heads = [next(r, None) for r in runs]
    keys = [(0, key(h), i) if h is not None else (1, None, i) for i, h in enumerate(heads)]
    tree = _tournament(len(runs), lambda a, b: keys[a] < keys[b] if keys[a][0] == keys[b][0] == 0 else keys[a][0] <= keys[b][0])
    if not runs:
        return
    while True:
        i = tree[0]
        if keys[i][0]:
            return
        yield heads[i]
        heads[i] = next(runs[i], None)
        keys[i] = (0, key(heads[i]), i) if heads[i] is not None else (1, None, i)
        node = (i + len(runs)) // 2
        while node:
            j = tree[node]
            if not keys[j][0] and (keys[i][0] or keys[j] < keys[i]):
                tree[node], i = i, j
            node //= 2
        tree[0] = i


def _tournament(n: int, less: Callable[[int, int], bool]) -> list[int]:
    """tree[0] the winner of all, tree[node] the loser at each inner node."""
    tree, winner = [0] * max(n, 1), [0] * n + list(range(n))
    for node in range(n - 1, 0, -1):
        a, b = winner[2 * node], winner[2 * node + 1]
        winner[node], tree[node] = (a, b) if less(a, b) else (b, a)
    tree[0] = winner[1] if n > 1 else 0
    return tree


def common_prefix(a: bytes, b: bytes, known: int = 0) -> int:
    """Length of the common prefix of two strings that agree in their first ``known`` bytes."""
    n = min(len(a), len(b))
    x = int.from_bytes(a[known:n], "big") ^ int.from_bytes(b[known:n], "big")
    return n - (x.bit_length() + 7) // 8


def merge_prefixed(runs: Sequence[Sequence[bytes]], prefixes: Sequence[Sequence[int]]) -> Iterator[tuple[int, int, int]]:
    """(run, position, common prefix with the item before) of all items of sorted runs, in order.

    ``prefixes`` holds each item's common prefix with the one before in its run.
    Every waiting item remembers its common prefix with the item that went out
    last. Of two items the one with the longer common prefix is the smaller; only
    when both are equal are bytes compared, and only those after that prefix.
    """
    n = len(runs)
    if not n:
        return
    at, sizes = [0] * n, [len(r) for r in runs]
    item = [r[0] if len(r) else None for r in runs]
    shared = [0 if s else -1 for s in sizes]  # with what went out last; -1 for a run that has ended

    def play(a: int, b: int) -> tuple[int, int]:
        """(winner, loser); the loser's common prefix becomes the one with the winner."""
        p, q = shared[a], shared[b]
        if p != q:
            return (a, b) if p > q else (b, a)
        if p < 0:
            return a, b
        x, y = item[a], item[b]
        if x == y:
            # copies are the usual case; the earlier run goes first
            if a > b:
                a, b = b, a
            shared[b] = len(x)
            return a, b
        if y < x:
            a, b = b, a
        shared[b] = p if x[p : p + 1] != y[p : p + 1] else common_prefix(x, y, p + 1)
        return a, b

    tree, winner = [0] * n, [0] * n + list(range(n))
    for node in range(n - 1, 0, -1):
        winner[node], tree[node] = play(winner[2 * node], winner[2 * node + 1])
    i = winner[1] if n > 1 else 0
    while shared[i] >= 0:
        yield i, at[i], shared[i]
        at[i] += 1
        if at[i] < sizes[i]:
            item[i], shared[i] = runs[i][at[i]], prefixes[i][at[i]]
        else:
            item[i], shared[i] = None, -1
        node = (i + n) // 2
        while node:
            j = tree[node]
            # the common cases of play(), without a call
            if shared[i] < shared[j]:
                tree[node], i = i, j
            elif shared[i] == shared[j] >= 0:
                i, tree[node] = play(i, j)
            node //= 2
