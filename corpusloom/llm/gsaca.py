"""Linear-time suffix sorting by grouping, without recursive renaming.

Phase one visits groups of suffixes from the largest to the smallest. All
suffixes of a group start with the same string, at the end of phase one their
longest Lyndon prefix. The previous-smaller pointer of a suffix leads past all
suffixes already visited to the nearest earlier one of a lower group; those
pointed at are moved out of their group into a higher one right behind it, by
how often the group points at them. Phase two fills the suffix array from the
left: a suffix that is emitted places, by the same pointers, the suffixes whose
Lyndon prefix ends where it starts, each at the next free place of its group.
"""

from __future__ import annotations


def suffix_array(text: list[int]) -> list[int]:
    """Start positions of the suffixes of ``text`` (integers from 1 up) in order."""
    end = len(text)
    first: dict[int, list[int]] = {}
    for i, c in enumerate(text):
        first.setdefault(c, []).append(i)
    # groups: member lists (stale entries are skipped), and a linked list from small to large
    members: list[list[int]] = [[end]]
    group = [0] * (end + 1)
    for k, c in enumerate(sorted(first), 1):
        members.append(first[c])
        for i in first[c]:
            group[i] = k
    above = [*range(1, len(members)), -1]
    below = [-1, *range(len(members) - 1)]
    prev = [-1] * (end + 1)
    done = [False] * (end + 1)
    ranked: list[list[int]] = []
    g = len(members) - 1
    while g >= 0:
        own = [s for s in members[g] if group[s] == g]
        if not own:
            g = below[g]
            continue
        members[g] = own
        ranked.append(own)
        points: dict[int, int] = {}
        for s in own:
            p = s - 1
            while p >= 0 and done[p]:
                p = prev[p]
            prev[s] = p
            done[s] = True
            if p >= 0:
                points[p] = points.get(p, 0) + 1
        if len(points) == 1:
            (p, _), = points.items()
            moved = {group[p]: {1: [p]}}
        else:
            moved = {}
            for p, times in points.items():
                moved.setdefault(group[p], {}).setdefault(times, []).append(p)
        for old, by_times in moved.items():
            last = old
            for times in sorted(by_times):
                new = len(members)
                members.append(by_times[times])
                for p in by_times[times]:
                    group[p] = new
                up = above[last]
                above.append(up)
                below.append(last)
                above[last] = new
                if up >= 0:
                    below[up] = new
                last = new
        g = below[g]
    ranked.reverse()
    start = [0] * len(members)
    at = 0
    for own in ranked:
        start[group[own[0]]] = at
        at += len(own)
    order = [-1] * (end + 1)
    placed = [False] * (end + 1)
    order[0] = end
    placed[end] = True
    for s in order:
        p = s - 1
        while p >= 0 and not placed[p]:
            k = group[p]
            order[start[k]] = p
            start[k] += 1
            placed[p] = True
            p = prev[p]
    return order[1:]
