"""Suffix arrays by grouping, and repeated byte strings found with them.

`suffix_array` sorts in two phases. Phase one gathers the suffixes by their Lyndon prefix:
the groups are taken from the highest down, and each one lengthens the prefix known of the
previous smaller suffixes of its members, which moves those to groups of their own, above
the ones they leave. Phase two emits the suffixes from the least up: the one before an
emitted suffix, and on along the previous-smaller pointers, is the least one of its group
that is left. Nothing is renamed or sorted recursively.

`repeated_starts` needs the order of all strings of a fixed length. It cuts the bytes at
triggers, 4-grams with a certain hash, into phrases, which overlap by the trigger and so
are prefix-free; the suffix array of the phrase numbers is the byte order of the suffixes
at triggers. A string is repeated where one equals another both up to its first trigger
and, by the neighbours' common prefixes in that order, from there on.
"""

from collections import defaultdict

import numpy as np

from eventlens.llm.tokens import mixed

TRIGGER = 4  # bytes
RATES = (16, 4, 1)  # one of so many places is a trigger, about


def suffix_array(text: list[int]) -> list[int]:
    """The starts of the suffixes of ``text`` (integers above 0) in order."""
    s = [*text, 0]
    n = len(s)
    order = sorted(range(n), key=s.__getitem__)  # suffixes by group
    place = [0] * n
    group = [0] * n  # of a suffix: where its group begins in `order`
    size = [0] * n  # of a group, by where it begins
    begin = 0
    for at, i in enumerate(order):
        if s[i] != s[order[begin]]:
            begin = at
        place[i], group[i] = at, begin
        size[begin] += 1
    previous = [-1] * n  # the nearest suffix to the left in a lower group

    end = n - 1
    while end >= 0:
        begin = group[order[end]]
        members = sorted(order[begin:end + 1]) if end > begin else [order[end]]
        calls: dict[int, int] = {}
        for i in members:
            j = i - 1
            while j >= 0 and group[j] >= begin:
                j = previous[j]
            previous[i] = j
            if j >= 0:
                calls[j] = calls.get(j, 0) + 1
        if calls:
            by_count: dict[int, dict[int, list[int]]] = defaultdict(lambda: defaultdict(list))
            for j, count in calls.items():
                by_count[count][-1 if len(calls) == 1 else group[j]].append(j)
            for count in sorted(by_count, reverse=True):
                together: dict[int, list[int]] = defaultdict(list)
                for part in by_count[count].values():
                    for j in part:
                        together[group[j]].append(j)
                for old, moved in together.items():
                    left = size[old] - len(moved)
                    if not left:
                        continue
                    new = old + left
                    tail = new
                    going = set(moved)
                    for j in moved:
                        at = place[j]
                        if at >= new:
                            continue
                        while order[tail] in going:
                            tail += 1
                        other = order[tail]
                        order[at], order[tail] = other, j
                        place[other], place[j] = at, tail
                    for j in moved:
                        group[j] = new
                    size[old], size[new] = left, len(moved)
        end = begin - 1

    result = [-1] * n
    result[0] = n - 1
    free = list(range(n))  # of a group: its next free place
    done = bytearray(n)
    done[n - 1] = 1
    for at in range(n):
        j = result[at] - 1
        while j >= 0 and not done[j]:
            done[j] = 1
            begin = group[j]
            result[free[begin]] = j
            free[begin] += 1
            j = previous[j]
    return result[1:]


def _triggers(words: np.ndarray, rate: int) -> np.ndarray:
    """Whether a trigger begins at each place, given the four bytes there as numbers."""
    return mixed(words) % np.uint64(rate) == 0


def _common(eight: np.ndarray, u: np.ndarray, v: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Length of the common prefix of the bytes at u and v, up to ``most``."""
    length = np.zeros(len(u), np.int64)
    open_ = np.arange(len(u))
    while len(open_):
        apart = eight[u[open_] + length[open_]] ^ eight[v[open_] + length[open_]]
        same = apart == 0
        differing = open_[~same]
        low = apart[~same] & (~apart[~same] + np.uint64(1))  # the lowest bit that differs
        length[differing] += (np.log2(low.astype(np.float64)).astype(np.int64)) // 8
        open_ = open_[same]
        length[open_] += 8
        open_ = open_[length[open_] < most[open_]]
    return np.minimum(length, most)


def repeated_starts(groups: list[list[bytes]], length: int, rates=RATES) -> list[list[np.ndarray]]:
    """For each content of each group, which of its strings of ``length`` bytes also start at
    another place of the same group (one flag for each start).

    Groups with a string that has no trigger in it are sorted apart, with more triggers.
    """
    contents = [c for g in groups for c in g]
    of_group = np.repeat(np.arange(len(groups)), [len(g) for g in groups])
    sizes = np.array([len(c) for c in contents], np.int64)
    ends = np.cumsum(sizes)
    begins = ends - sizes
    raw = np.frombuffer(b"".join(contents), np.uint8)
    total = len(raw)
    padded = np.concatenate([raw, np.zeros(length + 16, np.uint8)]).astype(np.uint64)
    count = total + length + 8
    eight = np.zeros(count, np.uint64)
    for b in range(8):
        eight |= padded[b:b + count] << np.uint64(8 * b)
    owner = np.repeat(np.arange(len(contents)), sizes)

    places = np.arange(total)
    here = _triggers(eight[:total] & np.uint64(0xFFFFFFFF), rates[0]) & (places + TRIGGER <= ends[owner])
    cuts = np.flatnonzero(here)
    following = np.append(cuts, 2 * total + length)[np.searchsorted(cuts, places)]
    bare = (places + length <= ends[owner]) & (following + TRIGGER > places + length)
    apart = np.unique(of_group[owner[bare]])
    if len(apart):
        result: list = [None] * len(groups)
        others = np.setdiff1d(np.arange(len(groups)), apart)
        for chosen, with_rates in ((others, rates), (apart, rates[1:])):
            found = repeated_starts([groups[i] for i in chosen], length, with_rates) if len(chosen) else []
            for i, flags in zip(chosen, found):
                result[i] = flags
        return result

    of = owner[cuts]
    last = np.append(of[1:] != of[:-1], True)
    stops = np.where(last, ends[of], np.minimum(np.append(cuts[1:], total) + TRIGGER, ends[of]))
    joined = raw.tobytes()
    phrases = [joined[a:b] for a, b in zip(cuts.tolist(), stops.tolist())]
    number = {p: i for i, p in enumerate(sorted(set(phrases)), len(contents) + 1)}
    text, where, separator = [], [], 0
    for phrase, cut, ends_here in zip(phrases, cuts.tolist(), last.tolist()):
        text.append(number[phrase])
        where.append(cut)
        if ends_here:
            separator += 1
            text.append(separator)
            where.append(-1)
    at = np.array(where, np.int64)[np.array(suffix_array(text), np.int64)] if text else np.empty(0, np.int64)
    at = at[at >= 0]

    room = np.minimum(ends[owner[at]] - at, length)
    common = np.zeros(len(at), np.int64)
    if len(at) > 1:
        common[1:] = _common(eight, at[:-1], at[1:], np.minimum(room[:-1], room[1:]))
    # the trigger before, or the place before the content
    index = np.searchsorted(cuts, at)
    earlier = np.where(index > 0, cuts[index - 1], -1)
    before = np.maximum(earlier, begins[owner[at]] - 1)

    found = np.zeros(total, bool)
    active = np.arange(len(at))
    left = np.zeros(len(at), np.uint64)  # a number of the bytes between string start and trigger
    for gap in range(0, length - TRIGGER + 1):
        active = active[at[active] - gap > before[active]]
        if not len(active):
            break
        if gap:
            left[active] = mixed(left[active] * np.uint64(0x9E3779B97F4A7C15) + padded[at[active] - gap] + np.uint64(1))
        whole = active[at[active] - gap + length <= ends[owner[at[active]]]]
        label = np.cumsum(common < length - gap)
        keys = label[whole].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93) + left[whole]
        keys = mixed(keys + mixed(of_group[owner[at[whole]]].astype(np.uint64)))
        _, back, times = np.unique(keys, return_inverse=True, return_counts=True)
        found[at[whole[times[back] > 1]] - gap] = True
    flags = iter([found[b:e - length + 1] if e - b >= length else found[:0] for b, e in zip(begins, ends)])
    return [[next(flags) for _ in g] for g in groups]
