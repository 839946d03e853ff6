"""Small awkward tables, and plain-Python versions of what the operators compute."""

import hashlib
import re
from collections import Counter
from itertools import combinations

SCHEMA = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT, row STRUCT<a: INT>, g STRING"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def prose(seed, n, vocabulary=400):
    out, state = [], seed * 7919 + 1
    for _ in range(n):
        state = (state * 1103515245 + 12345) % (1 << 31)
        k = state >> 8
        out.append("wörd"[: 1 + k % 4] + str(k % vocabulary))
    return " ".join(out)


def awkward(many=12):
    """Null and empty texts, a long one, copies, near copies, ties, null ids and sources."""
    base = prose(1, 300)
    shared = prose(2, 160)
    rows = [
        (1, None, "en", "a"), (2, "", "en", "a"), (3, " \t\n ", None, "a"), (4, base, "en", "a"),
        (5, base, "en", "b"), (6, base.replace(" ", "\n", 7) + " tail", "en", None), (7, "One word", "en", "b"),
        (8, "one WORD", "en", "b"), (9, "x", "en", "a"), (10, shared + "\n" + prose(3, 50), "en", "a"),
        (11, prose(4, 70) + "\n" + shared, "en", "c"), (11, prose(4, 70) + "\n" + shared, "en", "c"),
        (None, base + " more", "en", "c"), (None, None, None, None), (12, "ab" * 2000, "en", "a"),
        (13, prose(5, 30_000, 5000), "en", "a"), (14, "漢字 «q» it's  don't ½", "zh", "a"),
    ]
    for i in range(many):
        words = prose(20, 60).split(" ")
        words[5 * i % 60] = f"edit{i}"
        rows.append((100 + i, " ".join(words), "en", "a"))
    return [(*r, len(r[1] or ""), (1,), "clash") for r in rows]


def table(spark, rows=None):
    return spark.createDataFrame(awkward() if rows is None else rows, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def shingles(text, size=5):
    w = words(text)
    if len(w) < size:
        return frozenset([tuple(w)] if w else [])
    return frozenset(zip(*[w[k:] for k in range(size)]))


def components(rows):
    """(doc_id, size of the set, least doc_id of the component) of each row."""
    sets = [shingles(r[1]) for r in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in combinations(range(len(rows)), 2):
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
            root[find(i)] = find(j)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[find(i)] = min(least.get(find(i), r[0]), r[0])
    return [(r[0], len(s), least.get(find(i)) if s else r[0]) for i, (r, s) in enumerate(zip(rows, sets))]


def without_repeats(rows, length=400):
    """(doc_id, bytes, removed, spans, sha256 of the rest) of each row."""
    texts = [(r[1] or "").encode() for r in rows]
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for r, t in zip(rows, texts):
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        kept = bytes(b for b, g in zip(t, gone) if not g)
        spans = len(re.findall(b"\1+", bytes(gone)))
        out.append((r[0], len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def same(found, expected):
    assert sorted(map(repr, found)) == sorted(map(repr, expected))
