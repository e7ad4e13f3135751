"""Sorted runs of byte strings: front coding, and merging by a loser tree that
knows common prefixes.

A run is sorted and each string is kept as the length it shares with its
predecessor and the rest.  ``merge`` plays the heads of all runs in a tree of
losers.  Every head carries the length it shares with the string last put out;
of two heads the one that shares more is smaller, and only heads that share
equally much are compared, from there on.  No known prefix is ever compared
again, and the merged sequence comes with its own shared lengths.
"""

from __future__ import annotations

import numpy as np


def front_code(strings: list[bytes]) -> tuple[list[int], list[bytes]]:
    """Shared lengths and rests of a sorted list."""
    shared, rests, last = [], [], b""
    for s in strings:
        k = common(last, s, 0)
        shared.append(k)
        rests.append(s[k:])
        last = s
    return shared, rests


def front_decode(shared: list[int], rests: list[bytes]) -> list[bytes]:
    out, last = [], b""
    for k, rest in zip(shared, rests):
        last = last[:k] + rest
        out.append(last)
    return out


def common(a: bytes, b: bytes, known: int) -> int:
    """Length of the common prefix of ``a`` and ``b``, ``known`` of it given."""
    n = min(len(a), len(b))
    if a[known:n] == b[known:n]:
        return n
    x = int.from_bytes(a[known:n], "big") ^ int.from_bytes(b[known:n], "big")
    return n - (x.bit_length() + 7) // 8


def merge(runs: list[tuple[list[int], list[bytes]]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Merge runs given as (shared lengths, whole strings).

    Returns run number, place in the run and the length shared with the
    predecessor, for every string in merged order (equal strings in run order).
    """
    k = 1
    while k < len(runs):
        k *= 2
    texts = [r[1] for r in runs] + [[] for _ in range(k - len(runs))]
    own = [r[0] for r in runs] + [[] for _ in range(k - len(runs))]
    at = [0] * k
    head = [t[0] if t else None for t in texts]
    shares = [0] * k        # with the string last put out
    losers = [0] * k        # losers[0] is the winner

    def play(i: int, j: int) -> tuple[int, int]:
        """(winner, loser) of the heads i and j; sets what the loser shares."""
        a, b = head[i], head[j]
        if a is None or b is None:
            return (j, i) if a is None and b is not None else (i, j)
        if shares[i] != shares[j]:
            return (i, j) if shares[i] > shares[j] else (j, i)
        n = common(a, b, shares[i])
        if n == len(a) and (n < len(b) or i < j):
            first, second = i, j
        elif n == len(b) or n < len(a) and b[n] < a[n]:
            first, second = j, i
        else:
            first, second = i, j
        shares[second] = n
        return first, second

    def build(node: int) -> int:
        if node >= k:
            return node - k
        winner, losers[node] = play(build(2 * node), build(2 * node + 1))
        return winner

    winner = build(1) if k > 1 else 0
    total = sum(map(len, texts))
    out_run, out_at, out_shared = (np.empty(total, np.int64) for _ in range(3))
    for put in range(total):
        place = at[winner]
        out_run[put], out_at[put], out_shared[put] = winner, place, shares[winner]
        at[winner] = place = place + 1
        if place < len(texts[winner]):
            head[winner], shares[winner] = texts[winner][place], own[winner][place]
        else:
            head[winner] = None
        node = (winner + k) >> 1
        while node:
            winner, losers[node] = play(winner, losers[node])
            node >>= 1
    return out_run, out_at, out_shared
