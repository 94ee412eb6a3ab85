"""Suffix array by linear grouping construction.

First every suffix is put in the group of its longest Lyndon prefix.  Groups
start as the letters' positions and are processed from the highest down.  For
each suffix of a group a pointer to the previous smaller suffix is found; the
Lyndon prefix of that suffix goes on with the group's, once per pointer to
it, so it moves to a new group just above its old one.  Then, since suffix i
is its Lyndon prefix followed by the suffix where that ends, walking over the
array from the smallest suffix on places the members of every group in order.
Nothing is renamed and solved again.
"""

from __future__ import annotations


def suffix_array(text: list[int]) -> list[int]:
    """Order of the suffixes of ``text``; a suffix that is a prefix of another comes first."""
    if not text:
        return []
    end = min(text) - 1
    t = [*text, end]
    n = len(t)

    members: list[list[int]] = []  # by group; those that moved on are skipped later
    letters: dict[int, int] = {}
    group = [0] * n
    order = sorted(set(t))
    for g, c in enumerate(order):
        letters[c] = g
        members.append([])
    for i, c in enumerate(t):
        g = group[i] = letters[c]
        members[g].append(i)
    length = [1] * len(members)  # of the Lyndon prefix
    below = list(range(-1, len(members) - 1))
    above = [*range(1, len(members)), -1]
    prev = [-1] * n
    done = bytearray(n)

    g = len(members) - 1
    while g >= 0:
        own = [i for i in members[g] if group[i] == g]
        own.sort()
        members[g] = own
        for i in own:
            done[i] = 1
        hits: dict[int, int] = {}
        for i in own:
            j = i - 1
            while j >= 0 and done[j]:
                j = prev[j]
            prev[i] = j
            if j >= 0:
                hits[j] = hits.get(j, 0) + 1
        if hits:
            more = length[g]
            by_count: dict[int, list[int]] = {}
            for j, k in hits.items():
                by_count.setdefault(k, []).append(j)
            for k in sorted(by_count, reverse=True) if len(by_count) > 1 else by_count:
                fresh: dict[int, int] = {}
                for j in by_count[k]:
                    old = group[j]
                    new = fresh.get(old)
                    if new is None:
                        new = fresh[old] = len(members)
                        members.append([])
                        length.append(length[old] + k * more)
                        up = above[old]
                        above.append(up)
                        below.append(old)
                        above[old] = new
                        if up >= 0:
                            below[up] = new
                    members[new].append(j)
                    group[j] = new
        g = below[g]

    # ascending: the end sign's group is the lowest of all
    g = 0
    while below[g] >= 0:
        g = below[g]
    start, at = [0] * len(members), 0
    while g >= 0:
        start[g] = at
        at += sum(1 for i in members[g] if group[i] == g)
        g = above[g]
    out = [-1] * n
    out[0] = n - 1
    for r in range(n):
        i = out[r]
        j = i - 1
        while j >= 0:
            g = group[j]
            if j + length[g] != i:
                break
            out[start[g]] = j
            start[g] += 1
            j = prev[j]
    return out[1:]
