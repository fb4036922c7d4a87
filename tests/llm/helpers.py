"""Plain versions of what the operators compute, for small tables."""

import re
from collections import defaultdict

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))

# doc_id, text: nulls, empties, blanks, ties, repeated rows and one long text.
ODD_TEXTS = [
    (1, None),
    (2, ""),
    (3, " \t\n"),
    (4, "one"),
    (5, "one"),
    (5, "one"),
    (6, "  one   two\nthree  "),
    (7, "é日本 ñ 😀 a\u00a0b \u3000 c"),
    (8, "word " * 30_000),
    (9, "x" * 50_000),
    (None, "a text without a number"),
]


def words(text):
    return WORD.findall((text or "").encode())


def shingle_set(text, size):
    found = WORD.findall((text or "").encode().translate(_LOWER))
    if len(found) < size:
        return frozenset([tuple(found)] if found else [])
    return frozenset(tuple(found[i : i + size]) for i in range(len(found) - size + 1))


def groups(sets, per_cent):
    """The smallest id that links lead to, for each id of ``sets``."""
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[:n]:
            both = len(sets[i] & sets[j])
            if both and 100 * both >= per_cent * (len(sets[i]) + len(sets[j]) - both):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return {i: root(i) for i in sets}


def without_repeats(rows, size):
    """``(all words, those left)`` for each of ``rows`` (id, text), whose ids are distinct or null."""
    first = defaultdict(lambda: None)
    split = [(i, words(t)) for i, t in rows]
    for i, w in split:
        for k in range(len(w) - size + 1):
            key = tuple(w[k : k + size])
            if i is not None and (first[key] is None or i < first[key]):
                first[key] = i
    out = []
    for i, w in split:
        gone = set()
        for k in range(len(w) - size + 1):
            least = first[tuple(w[k : k + size])]
            if i is not None and least is not None and least < i:
                gone.update(range(k, k + size))
        out.append((i, w, [x for k, x in enumerate(w) if k not in gone]))
    return out
