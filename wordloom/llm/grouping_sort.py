"""Suffix sorting by grouping: a linear construction in two phases.

Phase 1 starts from one group for each first symbol and takes groups in descending order. Each member i points at
prev(i), the last position before it whose group is lower. Positions pointed at by more members of
the current group move further up: they leave their group for a new one right behind it. In the end a
group holds the suffixes that share their longest Lyndon prefix.

Phase 2 reads the order from the left. When a suffix is placed, the position before it and then the
chain of prev pointers from there take the next free places of their groups, until one is met that has its place.
No symbols are renamed and nothing is solved recursively.
"""

from __future__ import annotations


def suffix_order(symbols: list[int]) -> list[int]:
    """Suffix array of ``symbols``. The last symbol must be smaller than all others."""
    n = len(symbols)
    order = sorted(range(n), key=symbols.__getitem__)
    at = [0] * n  # a position's index in order
    head = [0] * n  # index where its group begins
    size = [0] * n  # by the group's first index
    start = 0
    for k, i in enumerate(order):
        if symbols[i] != symbols[order[start]]:
            start = k
        at[i], head[i] = k, start
        size[start] += 1
    prev = [-1] * n
    end = n
    while end > 0:
        begin = head[order[end - 1]]
        members = order[begin:end]
        if len(members) > 1:
            members.sort()
        pointed: dict[int, int] = {}
        for i in members:
            j = i - 1
            while j >= 0 and head[j] >= begin:
                j = prev[j]
            prev[i] = j
            if j >= 0:
                pointed[j] = pointed.get(j, 0) + 1
        # Positions with more pointers first; those of one group and count move together.
        moves: dict[tuple[int, int], list[int]] = {}
        for j, times in pointed.items():
            moves.setdefault((-times, head[j]), []).append(j)
        for _, g in sorted(moves) if len(moves) > 1 else moves:
            moved = moves[_, g]
            left = size[g]
            if left == len(moved):
                continue
            for j in moved:
                left -= 1
                last, k = order[g + left], at[j]
                order[k], order[g + left] = last, j
                at[last], at[j] = k, g + left
            size[g], size[g + left] = left, len(moved)
            for j in moved:
                head[j] = g + left
        end = begin
    free = head  # by position of the group's first index: reused as the next free place
    place = list(range(n))
    result = [-1] * n
    done = [False] * n
    result[0] = n - 1
    done[n - 1] = True
    for k in range(n):
        j = result[k] - 1
        while j >= 0 and not done[j]:
            g = free[j]
            result[place[g]] = j
            place[g] += 1
            done[j] = True
            j = prev[j]
    return result
