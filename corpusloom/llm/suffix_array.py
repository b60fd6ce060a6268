"""Suffix arrays by linear grouping.

First the suffixes are grouped by their Lyndon prefix: groups of equal first characters are processed in descending order, and
the previous-smaller pointers of a group's suffixes tell which lower suffixes are followed by it; these move, most
followers first, into new groups right behind their old ones. Then, going through the array from its start, each suffix
emits those whose next smaller suffix it is into the next free place of their groups. No suffix is renamed and nothing is
sorted recursively.
"""

from __future__ import annotations


def suffix_array(text: str) -> list[int]:
    """The starts of all suffixes of ``text`` in lexicographic order; the empty text has none."""
    n = len(text) + 1  # an end mark, smaller than all characters
    if n == 1:
        return []
    order, place, first = [0] * n, [0] * n, [0] * n  # suffixes in groups, where a suffix stands, where its group starts
    size: dict[int, int] = {}
    by_char: dict[str, list[int]] = {}
    for i, c in enumerate(text):
        by_char.setdefault(c, []).append(i)
    order[0], place[n - 1], size[0], at = n - 1, 0, 1, 1
    for c in sorted(by_char):
        members = by_char[c]
        size[at] = len(members)
        start = at
        for i in members:
            order[at], place[i], first[i] = i, at, start
            at += 1
    smaller = _group(n, order, place, first, size)
    return _emit(n, smaller, first)[1:]


def _group(n: int, order: list[int], place: list[int], first: list[int], size: dict[int, int]) -> list[int]:
    """Refine the groups in descending order; returns the previous-smaller pointers."""
    smaller = [-1] * n
    end = n - 1
    while end > 0:
        start = first[order[end]]
        followers: dict[int, int] = {}
        for i in sorted(order[start : end + 1]) if end > start else (order[end],):
            j = i - 1
            while j >= 0 and first[j] >= start:
                j = smaller[j]
            smaller[i] = j
            if j >= 0:
                followers[j] = followers.get(j, 0) + 1
        end = start - 1
        if not followers:
            continue
        if len(followers) == 1:
            (j,) = followers
            _move([j], order, place, first, size)
            continue
        by_number: dict[int, dict[int, list[int]]] = {}
        for j, number in followers.items():
            by_number.setdefault(number, {}).setdefault(first[j], []).append(j)
        for number in sorted(by_number, reverse=True):
            for members in by_number[number].values():
                _move(members, order, place, first, size)
    return smaller


def _move(members: list[int], order: list[int], place: list[int], first: list[int], size: dict[int, int]) -> None:
    """Make ``members`` of one group a group of their own right behind the rest of it."""
    group = first[members[0]]
    whole = size[group]
    new = group + whole - len(members)
    if new == group:
        return
    to = group + whole
    for j in members:
        to -= 1
        at, other = place[j], order[to]
        order[at], place[other] = other, at
        order[to], place[j] = j, to
        first[j] = new
    size[group] = whole - len(members)
    size[new] = len(members)


def _emit(n: int, smaller: list[int], first: list[int]) -> list[int]:
    free = list(range(n))  # the next free place of the group that starts here
    out = [0] * n
    out[0] = n - 1
    placed = [False] * n
    placed[n - 1] = True
    for i in range(n):
        j = out[i] - 1
        while j >= 0 and not placed[j]:
            group = first[j]
            out[free[group]] = j
            free[group] += 1
            placed[j] = True
            j = smaller[j]
    return out
