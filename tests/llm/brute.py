"""Plain Python versions of the text operators, for small inputs."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def statistics(text):
    words = WORD.findall(text or "")
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {i + k for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for k in range(5)}
    seen, again = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            again += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), again, len(covered)


def repeated_windows(rows, length=50):
    """`(id, n_words, n_removed, kept)` for each (id, text)."""
    first = {}
    for doc, text in sorted(rows, key=lambda x: x[0]):
        words = WORD.findall(text or "")
        for i in range(len(words) - length + 1):
            first.setdefault(tuple(words[i : i + length]), doc)
    for doc, text in rows:
        words = WORD.findall(text or "")
        gone = set()
        for i in range(len(words) - length + 1):
            if first[tuple(words[i : i + length])] < doc:
                gone.update(range(i, i + length))
        yield doc, len(words), len(gone), " ".join(w for i, w in enumerate(words) if i not in gone)


def repeated_lines(rows, min_chars=20, min_docs=3):
    key = lambda line: line.strip(" \t\n\x0b\f\r").translate(LOWER)
    holders = defaultdict(set)
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders[key(line)].add(doc)
    common = {k: max(x) for k, x in holders.items() if len(x) >= min_docs}
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if common.get(key(x), doc) == doc]
        yield doc, len(lines), len(lines) - len(kept), "\n".join(kept)


def fingerprint(text):
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(x.encode(), 42) for x in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(rows, bits=2):
    """`(id, fingerprint, component)` for each (id, text)."""
    prints = [(doc, fingerprint(text)) for doc, text in rows]
    values = sorted({f for _, f in prints})
    parent = {f: f for f in values}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(values):
        for b in values[i + 1 :]:
            if (a ^ b).bit_count() <= bits and root(a) != root(b):
                parent[root(a)] = root(b)
    least = {}
    for doc, f in prints:
        least[root(f)] = min(least.get(root(f), doc), doc)
    return [(doc, f"{f:016x}", least[root(f)]) for doc, f in prints]


def edit_distance(item, words):
    """Least edits between the item and any stretch of the words."""
    row = list(range(len(item) + 1))
    best = row[-1]
    for word in words:
        new = [0]
        for i, x in enumerate(item):
            new.append(min(new[i] + 1, row[i + 1] + 1, row[i] + (x != word)))
        row = new
        best = min(best, row[-1])
    return best


def license_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def phrase_places(words, phrases):
    found = {name: [i for i in range(len(words)) if words[i : i + len(p.split())] == p.split()] for name, p in phrases.items()}
    every = [i for places in found.values() for i in places]
    return len(words), len(every), min(every, default=None), max(every, default=None), sorted(k for k, x in found.items() if x)


def first_of_similar(rows, similarity=0.8, length=5):
    """The (id, text) with the smallest id of each group of texts of similar word shingles."""
    def shingles(text):
        words = WORD.findall((text or "").translate(LOWER))
        return {tuple(words[i : i + length]) for i in range(max(1, len(words) - length + 1))} if words else set()

    sets = [shingles(t) for _, t in rows]
    group = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if group[i] != group[j] and (len(a & b) >= similarity * len(a | b)):
                group = [group[j] if x == group[i] else x for x in group]
    least = {}
    for (doc, _), g in zip(rows, group, strict=True):
        least[g] = min(least.get(g, doc), doc)
    return [(doc, t) for (doc, t), g in zip(rows, group, strict=True) if least[g] == doc]
