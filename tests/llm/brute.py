"""Plain single-machine versions of the operators, for comparison."""

import hashlib
import re
import unicodedata
from collections import Counter, defaultdict

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FOLD = str.maketrans(UPPER, LOWER)
WORD = re.compile(r"[^\x20\x09-\x0D]+")
ITEM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(text or "")


def shingles(text):
    w = words((text or "").translate(FOLD))
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def components(docs):
    """{row number: (set size, smallest id reachable)} of [(doc_id, text)]."""
    sets = [shingles(t) for _, t in docs]
    root = list(range(len(docs)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(docs)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    low = defaultdict(list)
    for i, (d, _) in enumerate(docs):
        low[find(i)].append(d)
    low = {k: min((d for d in v if d is not None), default=None) for k, v in low.items()}
    return [(d, len(sets[i]), low[find(i)]) for i, (d, _) in enumerate(docs)]


def rules(text):
    text = text or ""
    w = words(text)
    n = len(w)
    windows = [tuple(w[i:i + 5]) for i in range(n - 4)]
    times = Counter(windows)
    covered = set()
    for i, x in enumerate(windows):
        if times[x] > 1:
            covered.update(range(i, i + 5))
    lines = [x for x in text.split("\n") if WORD.search(x)]
    symbols, chars = len(re.findall(r"[#*$%&|<>]", text)), sum(map(len, w))
    dup = len(lines) - len(set(lines))
    base = n < 10 or 100 * len(covered) > 20 * n
    kinds = [unicodedata.category(c) for c in text]
    bad = (100 * symbols > 15 * n or 100 * dup > 50 * len(lines) or chars < 2 * n or chars > 20 * n
           or 2 * kinds.count("Lu") > sum(k[0] == "L" for k in kinds))
    return n, chars, symbols, dup, len(covered), base, not (base or bad)


def repeats(docs, size=50):
    """Per (doc_id, text): the bytes and which of them go."""
    owner = {}
    raw = [(d, (t or "").encode()) for d, t in docs]
    for d, b in raw:
        if d is not None:
            for i in range(len(b) - size + 1):
                w = b[i:i + size]
                owner[w] = min(owner.get(w, d), d)
    out = []
    for d, b in raw:
        gone = bytearray(len(b))
        for i in range(len(b) - size + 1):
            if d is not None and owner[b[i:i + size]] < d:
                gone[i:i + size] = b"\1" * size
        out.append((d, b, gone))
    return out


def repeat_row(d, b, gone):
    spans = sum(1 for i in range(len(gone)) if gone[i] and (i == 0 or not gone[i - 1]))
    kept = bytes(x for x, y in zip(b, gone) if not y)
    return d, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()


def contamination(docs, items, size=10):
    windows = defaultdict(set)
    for i, t in items:
        w = ITEM_WORD.findall((t or "").translate(FOLD))
        if i is not None and w:
            for k in range(max(len(w) - size, 0) + 1):
                windows[tuple(w[k:k + size])].add(str(i))
    sizes = {len(x) for x in windows}
    out = []
    for d, t in docs:
        w = ITEM_WORD.findall((t or "").translate(FOLD))
        hit, found = set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                if tuple(w[k:k + n]) in windows:
                    hit.update(range(k, k + n))
                    found |= windows[tuple(w[k:k + n])]
        out.append((d, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return out
