"""Plain Python versions of the operators that SQL does not express, over a list of texts."""

import collections
import hashlib
import re
import zlib

WORD = re.compile(r"[^\x20\x09-\x0D]+")
NOTICE_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: chr(c + 32) for c in range(65, 91)}


def sha(data):
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def license_base(text, phrases):
    words, starts, labels = NOTICE_WORD.findall((text or "").translate(LOWER)), [], set()
    for phrase, label in phrases:
        p = phrase.split()
        for k in range(len(words) - len(p) + 1):
            if words[k:k + len(p)] == p:
                starts.append(k)
                labels.add(label)
    return len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels))


def shingles(text, n=5):
    words = WORD.findall((text or "").translate(LOWER))
    if len(words) < n:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + n]) for i in range(len(words) - n + 1)}


def components(texts):
    """{id: (set size, component)} of {id: text}, all pairs compared."""
    sets, parent = {i: shingles(t) for i, t in texts.items()}, {i: i for i in texts}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(texts)
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def window_dedup(texts, size=50):
    """{id: (words, removed, kept text)}: windows that start in an earlier document go."""
    words = {i: WORD.findall(t or "") for i, t in texts.items()}
    first = {}
    for i in sorted(words):
        for k in range(len(words[i]) - size + 1):
            first.setdefault(tuple(words[i][k:k + size]), i)
    result = {}
    for i, w in words.items():
        gone = set()
        for k in range(len(w) - size + 1):
            if first[tuple(w[k:k + size])] < i:
                gone.update(range(k, k + size))
        result[i] = (len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone))
    return result


def byte_dedup(rows, size=400):
    """[(id, bytes, removed, spans, kept digest)] of [(id, text)]."""
    raws = [(i, (t or "").encode()) for i, t in rows]
    times = collections.Counter(raw[k:k + size] for _, raw in raws for k in range(len(raw) - size + 1))
    result = []
    for i, raw in raws:
        gone = bytearray(len(raw))
        for k in range(len(raw) - size + 1):
            if times[raw[k:k + size]] > 1:
                gone[k:k + size] = b"\1" * size
        spans = sum(1 for k in range(len(raw)) if gone[k] and not (k and gone[k - 1]))
        result.append((i, len(raw), sum(gone), spans, sha(bytes(b for b, g in zip(raw, gone) if not g))))
    return result


def leaks(docs, items, size=10):
    """[(id, words, hit, sorted items)] of [(id, text)] against [(item, text)]."""
    wanted = {}
    for item, text in items:
        words = NOTICE_WORD.findall((text or "").translate(LOWER))
        n = min(size, len(words))
        for k in range(len(words) - n + 1 if n else 0):
            wanted.setdefault(tuple(words[k:k + n]), set()).add("null" if item is None else str(item))
    result = []
    for i, text in docs:
        words, hit, names = NOTICE_WORD.findall((text or "").translate(LOWER)), set(), set()
        for n in {len(w) for w in wanted}:
            for k in range(len(words) - n + 1):
                if tuple(words[k:k + n]) in wanted:
                    hit.update(range(k, k + n))
                    names |= wanted[tuple(words[k:k + n])]
        result.append((i, len(words), len(hit), sorted(names)))
    return result


def rebuilt_conversations(rows):
    """{conversation: its turns (role, text)} of [(conversation, turn, role, text)], heads exchanged."""
    own = collections.defaultdict(list)
    for c, turn, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[1] is not None, r[1] or 0)):
        own[c].append((role or "", text or ""))
    result = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        result[c] = own.get(c - c % 5, [])[:h] + turns[h:]
    return result


def trie(convs):
    """Rows of the nodes of {conversation: turns}, as the operator has them."""
    members, ends = collections.defaultdict(list), collections.defaultdict(list)
    for c in sorted(convs):
        for d in range(len(convs[c]) + 1):
            members[tuple(convs[c][:d])].append(c)
        ends[tuple(convs[c])].append(c)
    result = []
    for path, own in members.items():
        below = [p for p in members if p[:len(path)] == path]
        parents = {p[:-1] for p in below if p}
        result.append((
            own[0], len(path), members[path[:-1]][0] if path else None, len(own),
            sum(len(p) == len(path) + 1 for p in below), sum(p not in parents for p in below),
            sum((len(members[p]) - 1) * len(p[-1][1].encode()) for p in below if p), sha(",".join(map(str, ends[path])))))
    return sorted(result, key=str)


def merkle(rows):
    """[(id, leaf, subroot, root, proof, folded, verified)] of [(id, source, lang, n_chars, text)]."""
    def leaf(values):
        return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))

    def tampered(row):
        lower = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0 and row[4] is not None
        return leaf([*row[:4], row[4].translate(LOWER)] if lower else row)

    def tree(level):
        levels = [level]
        while len(levels[-1]) > 1:
            levels.append([sha("".join(levels[-1][k:k + 16])) for k in range(0, len(levels[-1]), 16)])
        return levels

    def sides(levels, place):
        for level in levels[:-1]:
            start = place // 16 * 16
            yield "".join(level[start:place]), "".join(level[place + 1:start + 16])
            place //= 16

    by_source = collections.defaultdict(list)
    for row in rows:
        by_source[row[1]].append((row[0] is not None, row[0] or 0, leaf(row), row))
    names = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: tree([x[2] for x in sorted(by_source[s], key=lambda x: x[:3])]) for s in names}
    top = tree([trees[s][-1][0] for s in names])
    result = []
    for number, s in enumerate(names):
        for place, (_, _, own, row) in enumerate(sorted(by_source[s], key=lambda x: x[:3])):
            path = [*sides(trees[s], place), *sides(top, number)]
            folded = tampered(row)
            for left, right in path:
                folded = sha(left + folded + right)
            root = top[-1][0]
            result.append((row[0], own, trees[s][-1][0], root, sha("".join(a + b for a, b in path)), folded, folded == root))
    return sorted(result, key=str)
