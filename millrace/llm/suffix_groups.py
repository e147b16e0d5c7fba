"""Linear suffix sorting by grouping on Lyndon prefixes."""

from __future__ import annotations


def suffix_array(symbols: list[int]) -> list[int]:
    """Starts of all suffixes of a list of integers, in lexicographic order.

    Suffixes are kept in groups, at first by their first symbol. Groups are taken from the
    highest down. For each suffix of the group in hand its previous smaller suffix, the
    nearest one to the left in a lower group, is found over pointers of suffixes done
    before. What that suffix is known to begin with now goes on with the prefix of the
    group in hand, which no higher one can beat, so it moves to a new group just above the
    one it was in; one met more often, having more such prefixes in a row, moves above
    those met less often. In the end two suffixes share a group if and only if the longest
    Lyndon word that they begin with is the same.

    The order within groups then follows from one ascending pass: the suffixes that follow
    those Lyndon words come by in order, and each puts the suffixes it follows, which the
    pointers list, in the next place of their groups. Nothing is renamed or sorted again.
    """
    n = len(symbols)
    order = sorted(range(n), key=symbols.__getitem__)
    place = [0] * n
    group = [0] * n
    end = [0] * (n + 1)
    first = 0
    for index, suffix in enumerate(order):
        place[suffix] = index
        if symbols[suffix] != symbols[order[first]]:
            end[first] = index
            first = index
        group[suffix] = first
    if n:
        end[first] = n
    smaller = [-1] * n

    high = n
    while high:
        low = group[order[high - 1]]
        met: dict[int, int] = {}
        members = order[low:high]
        if high - low > 1:
            members.sort()
        for suffix in members:
            before = suffix - 1
            while before >= 0 and group[before] >= low:
                before = smaller[before]
            smaller[suffix] = before
            if before >= 0:
                met[before] = met.get(before, 0) + 1
        high = low
        if not met:
            continue
        by_count: dict[int, list[int]] = {}
        for suffix, count in met.items():
            by_count.setdefault(count, []).append(suffix)
        for count in sorted(by_count, reverse=True) if len(by_count) > 1 else by_count:
            moving = by_count[count]
            tops: dict[int, int] = {}
            for suffix in moving:
                home = group[suffix]
                last = end[home]
                if home not in tops:
                    tops[home] = last
                last -= 1
                end[home] = last
                other, at = order[last], place[suffix]
                order[at], place[other] = other, at
                order[last], place[suffix] = suffix, last
            for home, top in tops.items():
                start = end[home]
                end[start] = top
                if start != home:
                    for index in range(start, top):
                        group[order[index]] = start
    return _emit(n, group, smaller)


def _emit(n: int, group: list[int], smaller: list[int]) -> list[int]:
    """The order within groups from the groups and the previous-smaller pointers."""
    result = [-1] * n
    free = list(range(n))
    placed = bytearray(n)
    after = n  # the empty suffix comes first of all
    for index in range(n + 1):
        suffix = after - 1
        while suffix >= 0 and not placed[suffix]:
            home = group[suffix]
            result[free[home]] = suffix
            free[home] += 1
            placed[suffix] = 1
            suffix = smaller[suffix]
        if index < n:
            after = result[index]
    return result
