"""Plain Python versions of the manifest, the clusters and the personal data."""

from __future__ import annotations

import math
import re
import zlib
from collections import defaultdict

from brute import LOWER, sha


def leaf(row):
    values = [None if x is None else str(x) for x in row]
    return sha("".join("-" if x is None else f"{len(x.encode())}:{x}" for x in values))


def _tree(leaves):
    """Levels of digests, from the leaves to the last node."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([sha("".join(levels[-1][i : i + 8])) for i in range(0, len(levels[-1]), 8)])
    return levels


def _siblings(levels, i):
    """`(before, after)` of each level."""
    found = []
    for level in levels[:-1]:
        run = level[i // 8 * 8 : i // 8 * 8 + 8]
        found.append((run[: i % 8], run[i % 8 + 1 :]))
        i //= 8
    return found


def manifest(rows):
    """`(doc_id, leaf, subroot, root, proof, folded, verified)` for rows of `(doc_id, source, lang, n_chars, text)`."""
    groups = defaultdict(list)
    for row in rows:
        groups[row[2]].append((row[0], leaf(row), row))
    order = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    trees = []
    for lang in order:
        groups[lang].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees.append(_tree([x[1] for x in groups[lang]]))
    top = _tree([t[-1][0] for t in trees])
    for g, lang in enumerate(order):
        for i, (doc, own, row) in enumerate(groups[lang]):
            sides = _siblings(trees[g], i) + _siblings(top, g)
            folded = own
            if doc is not None and row[4] is not None and zlib.crc32(str(doc).encode()) % 3 == 0:
                folded = leaf((*row[:4], row[4].translate(LOWER)))
            for before, after in sides:
                folded = sha("".join([*before, folded, *after]))
            proof = sha("".join("".join(before + after) for before, after in sides))
            yield doc, own, trees[g][-1][0], top[-1][0], proof, folded, folded == top[-1][0]


def clusters(rows, k=40, rounds=5, dims=64):
    """`(id, cluster, distance, cluster inertia, inertia, centroid)` for (id, vector)."""
    kept = [
        (i, [math.floor(256 * x) for x in v]) for i, v in rows
        if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)
    ]
    centroids = [v for _, v in sorted(kept, key=lambda x: (sha(f"2:{'-' if x[0] is None else x[0]}"), x[1]))[:k]]

    def assigned():
        for _, v in kept:
            yield min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        members = defaultdict(list)
        for (_, v), (_, n) in zip(kept, list(assigned()), strict=True):
            members[n].append(v)
        for n, own in members.items():
            centroids[n] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    last = list(assigned())
    inertia = defaultdict(int)
    for d, n in last:
        inertia[n] += d
    for (i, _), (d, n) in zip(kept, last, strict=True):
        yield i, n, d, inertia[n], sum(inertia.values()), centroids[n]


KINDS = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def _luhn(digits):
    total = 0
    for i, x in enumerate(reversed(digits)):
        x = int(x) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def _holds(kind, text):
    digits = "".join(re.findall("[0-9]", text))
    if kind == "ip":
        return all(int(x) <= 255 for x in text.split("."))
    if kind == "card":
        return 14 <= len(digits) <= 19 and _luhn(digits)
    return 10 <= len(digits) <= 15 if kind == "phone" else True


def base_spans(text):
    """`(start, kind number, end)`, sorted."""
    found = [
        (m.start(), n, m.end()) for n, (kind, pattern) in enumerate(KINDS.items())
        for m in pattern.finditer(text or "") if _holds(kind, m[0])
    ]
    return sorted(found)


_LETTER = r"[^\W\d_]"
_TOKEN = re.compile(
    rf"(?<![^\W_])\+?\(?[0-9]++(?:[\x20().-]{{1,2}}+[0-9]++)*+(?![^\W_]|[@_%])"
    r"|(?<![^\W_])(?<![._%+@-])[A-Za-z._%+-]*+[0-9@][A-Za-z0-9@._%+-]*+"
)
_FORMS = [r"[^@]+@[^@]+", r"[0-9A-Fa-f]{1,4}(?:[.:][0-9A-Fa-f]{0,4}){3,7}", r"[0-9 .-]+", r"[0-9 ().+-]+"]
_SIZES = [(0, 10**9), (0, 10**9), (12, 19), (7, 15)]


def _fits(token):
    n = len(re.findall("[0-9]", token))
    return [bool(re.fullmatch(f, token)) and a <= n <= b for f, (a, b) in zip(_FORMS, _SIZES, strict=True)]


def _contexts(text, start, end, earlier, next_start):
    words = lambda x: ["#" if w[0].isdigit() else w for w in re.findall(rf"{_LETTER}+|[0-9]+", x.lower())]
    left = ["#" if earlier else "^", *words(text[max(earlier or 0, start - 48) : start])]
    right = [*words(text[end : min(end + 24, next_start)]), "$"][0]
    found = [f"{left[-1]} _", f"{left[-1]} _ {right}"]
    return found + [f"{left[-2]} {left[-1]} _"] if len(left) > 1 else found


def personal_data(rows, support=4.0, least=0.6, rounds=3):
    """`(id, base spans, all spans)` for (id, text)."""
    texts = {t or "" for _, t in rows}
    places, edges = [], set()
    for text in texts:
        base = base_spans(text)
        matches = [(n, m, _holds(kind, m[0])) for n, (kind, p) in enumerate(KINDS.items()) for m in p.finditer(text)]
        matches += [(4, m, True) for m in _TOKEN.finditer(text)]
        before, ends = {}, {}
        last = {}
        for n, m, ok in matches:
            before[n, m.start()] = last.get(n)
            if n in last:
                ends[n, last[n][0]] = m.start()
            last[n] = m.start(), m.end()
        for n, m, ok in matches:
            start, own = m.start(), m[0].rstrip("._%+@-") if n == 4 else m[0]
            end = start + len(own)
            if not ok or (n == 4 and any(a < end and start < b for a, _, b in base)):
                continue
            earlier = before[n, start]
            contexts = _contexts(text, start, m.end(), earlier[1] if earlier else None, ends.get((n, start), 10**9))
            forms = tuple(_fits(own)) if n == 4 else (False,) * 4
            places.append((text, n, start, end, own.lower(), forms, contexts))
            edges |= {(p, own.lower(), n, forms) for p in contexts}
    by_pattern = defaultdict(set)
    for p, *rest in edges:
        by_pattern[p].add(tuple(rest))
    sure, score = {}, {}
    for _ in range(rounds):
        score = {}
        for p, own in by_pattern.items():
            for k in range(4):
                seeds = sum(n == k for _, n, _ in own)
                unknown = [i for i, n, f in own if f[k]]
                got = sum(sure.get((i, k), 0.0) for i in unknown)
                held = seeds + got
                against = len(own) - seeds - len(unknown) + 0.5 * (len(unknown) - got)
                if seeds and round(held, 6) >= support and round(held / (held + against), 6) >= least:
                    score[p, k] = round(held / (held + against), 6)
        wrong = defaultdict(lambda: 1.0)
        for (p, k), s in score.items():
            for i, _, f in by_pattern[p]:
                if f[k]:
                    wrong[i, k] *= 1 - min(s, 0.999)
        sure = {x: 1 - w for x, w in wrong.items()}
    more = defaultdict(set)
    for text, n, start, end, _, forms, contexts in places:
        if n == 4 and (best := max(((score[p, k], -k) for p in contexts for k in range(4) if forms[k] and (p, k) in score), default=None)):
            more[text].add((start, -best[1], end))
    for doc, text in rows:
        base = base_spans(text)
        yield doc, base, sorted([*base, *more[text or ""]])
