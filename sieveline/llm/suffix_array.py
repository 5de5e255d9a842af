"""Suffix order of a sequence by linear grouping (Baier 2016).

Suffixes are first grouped by their longest Lyndon prefix, groups in lexicographic
order; then the order inside the groups is emitted.  Neither part recurses or
renames the sequence.
"""

from __future__ import annotations

from collections.abc import Sequence


def lyndon_groups(values: Sequence[int]) -> tuple[list[list[int]], list[int], list[int]]:
    """Groups from the last to the first, each suffix's group number, and each
    suffix's previous smaller suffix (-1 if none).

    Groups start as the suffixes of one first value and are taken in descending
    order.  When a group with context ``a`` is taken, every suffix of it hands ``a``
    to its previous smaller one, whose context it continues: a suffix that gets it
    ``k`` times leaves its own group for one just above, the higher the larger ``k``.
    """
    n = len(values)
    first: dict[int, list[int]] = {}
    for i, v in enumerate(values):
        first.setdefault(v, []).append(i)
    members = [first[v] for v in sorted(first)]
    group = [0] * n
    for g, own in enumerate(members):
        for i in own:
            group[i] = g
    below = list(range(-1, len(members) - 1))
    above = [*range(1, len(members)), -1]

    # left[i + 1] leads to the nearest suffix at or before i that is not taken yet
    left = list(range(n + 1))
    previous = [-1] * n
    taken = []
    g = len(members) - 1
    while g >= 0:
        own = [i for i in members[g] if group[i] == g]
        if own:
            taken.append(own)
            for i in own:
                left[i + 1] = i
            handed: dict[int, int] = {}
            for i in own:
                root = left[i + 1]
                while left[root] != root:
                    left[root] = left[left[root]]
                    root = left[root]
                left[i + 1] = root
                if root:
                    previous[i] = p = root - 1
                    handed[p] = handed.get(p, 0) + 1
            moved: dict[tuple[int, int], list[int]] = {}
            for p, k in handed.items():
                moved.setdefault((-k, group[p]), []).append(p)
            for k, h in sorted(moved):
                new = len(members)
                members.append(moved[k, h])
                for p in moved[k, h]:
                    group[p] = new
                over = above[h]
                below.append(h)
                above.append(over)
                above[h] = new
                if over >= 0:
                    below[over] = new
        g = below[g]
    return taken, group, previous


def suffix_array(values: Sequence[int]) -> list[int]:
    """Starts of the suffixes of ``values`` in ascending order; an end counts as
    smaller than any value."""
    taken, group, previous = lyndon_groups(values)
    n = len(values)
    at = dict.fromkeys((), 0)
    place = n
    for own in taken:
        place -= len(own)
        at[group[own[0]]] = place
    order = [0] * n
    placed = bytearray(n)
    s = n  # the empty suffix comes first
    for turn in range(n + 1):
        j = s - 1
        while j >= 0 and not placed[j]:
            g = group[j]
            order[at[g]] = j
            at[g] += 1
            placed[j] = 1
            j = previous[j]
        if turn < n:
            s = order[turn]
    return order
