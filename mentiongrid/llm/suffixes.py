"""Suffix arrays by linear grouping, and repeated windows found with them.

Suffixes are grouped by Lyndon prefix, the longest Lyndon word they start with. Groups start as equal
first symbols and are processed in descending order. When the group of prefix u is processed, every
member hangs from its previous smaller position p, found by hopping over positions of groups already
processed; the prefix w of p then grows to w u..u, so the group of p splits by how many members hang from
it. Afterwards the order inside the groups follows from the suffixes behind the prefixes, by going
once through the array while it is being filled; no names are given anew and nothing is sorted recursively.
"""

from __future__ import annotations

from collections.abc import Sequence


def suffix_array(text: Sequence[int]) -> list[int]:
    """Starts of all suffixes in order. The last symbol must be smaller than all others."""
    number = {symbol: i for i, symbol in enumerate(sorted(set(text)))}
    group = [number[symbol] for symbol in text]
    members: list[set[int]] = [set() for _ in number]
    for i, g in enumerate(group):
        members[g].add(i)
    below = list(range(-1, len(members) - 1))  # neighbours in the order of the groups
    above = [*range(1, len(members)), -1]
    smaller = [-1] * len(text)  # the previous position of a lower group
    done = [False] * len(members)

    current = len(members) - 1
    while current >= 0:
        hanging: dict[int, int] = {}
        for i in sorted(members[current]):  # so that pointers of earlier members are known
            p = i - 1
            while p >= 0 and (done[group[p]] or group[p] == current):
                p = smaller[p]
            smaller[i] = p
            if p >= 0:
                hanging[p] = hanging.get(p, 0) + 1
        done[current] = True
        splits: dict[int, dict[int, list[int]]] = {}
        for p, count in hanging.items():
            splits.setdefault(group[p], {}).setdefault(count, []).append(p)
        for old, parts in splits.items():
            for moved in parts.values():
                members[old].difference_update(moved)
            top = old
            for count in sorted(parts):
                if not members[old]:
                    members[old] = set(parts[count])  # nothing stays below this part: it keeps the number
                    continue
                new = len(members)
                members.append(set(parts[count]))
                done.append(False)
                for i in parts[count]:
                    group[i] = new
                up = above[top]
                below.append(top)
                above.append(up)
                above[top] = new
                if up >= 0:
                    below[up] = new
                top = new
        current = below[current]
    return _emit(group, above, below.index(-1), members, smaller)


def _emit(group: list[int], above: list[int], lowest: int, members: list[set[int]], smaller: list[int]) -> list[int]:
    free, at, g = [0] * len(members), 0, lowest
    while g >= 0:
        free[g], at, g = at, at + len(members[g]), above[g]
    n = len(group)
    order, placed = [-1] * n, [False] * n
    order[0], placed[n - 1] = n - 1, True
    free[group[n - 1]] += 1
    for k in range(n):
        p = order[k] - 1
        while p >= 0 and not placed[p]:
            place = free[group[p]]
            order[place], placed[p] = p, True
            free[group[p]] = place + 1
            p = smaller[p]
    return order


def least_owner(strings: list[bytes], owners: list[int], length: int) -> list[list[int]]:
    """For every window of `length` bytes of every string, the least owner of a string that has it.

    Windows are classes of neighbours in the suffix array of the strings, each followed by a separator.
    """
    text: list[int] = []
    where: list[tuple[int, int]] = []
    for s, string in enumerate(strings):
        text += [b + 2 for b in string]
        text.append(1)
        where += [(s, i) for i in range(len(string) + 1)]
    text.append(0)
    where.append((-1, 0))
    least = [[0] * max(0, len(s) - length + 1) for s in strings]
    window, alike = b"", []

    def close() -> None:
        if alike:
            owner = min(owners[s] for s, _ in alike)
            for s, i in alike:
                least[s][i] = owner

    for start in suffix_array(text):
        s, i = where[start]
        if s < 0 or i + length > len(strings[s]):
            continue
        this = strings[s][i : i + length]
        if this != window:
            close()
            window, alike = this, []
        alike.append((s, i))
    close()
    return least
