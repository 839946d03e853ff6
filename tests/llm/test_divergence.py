import re
from collections import Counter, defaultdict

import numpy as np
from tests.llm.helpers import LOWER, awkward, empty, table

from celltide.llm import divergence as v

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def plain(rows, least=3, longest=200):
    docs = [(r[2] or "", r[3] or "", TERM.findall((r[1] or "").translate(LOWER))) for r in rows]
    seen, counts, groups = Counter(), defaultdict(Counter), {(lang, source) for lang, source, _ in docs}
    for lang, _, terms in docs:
        seen.update((lang, t) for t in set(terms))
    kept = defaultdict(list)
    for (lang, t), n in seen.items():
        if n >= least:
            kept[lang].append(t)
    for lang, source, terms in docs:
        counts[lang, source].update(t for t in terms if seen[lang, t] >= least)

    def p(count, total, lang):
        return 1 + 10**9 * (count + 1) // (total + len(kept[lang]))

    out = []
    for lang, source in groups:
        own = counts[lang, source]
        total = sum(own.values())
        whole = sum((counts[g] for g in groups if g[0] == lang), Counter())
        parts = {"pair": [], "term": []}
        for other in sorted(s for x, s in groups if x == lang and s != source):
            theirs = counts[lang, other]
            n = sum(theirs.values())
            parts["pair"].append((sum((p(own[t], total, lang) - p(theirs[t], n, lang)) ** 2 // p(theirs[t], n, lang)
                                      for t in kept[lang]), other))
        for t in kept[lang]:
            a, q = p(own[t], total, lang), p(whole[t], sum(whole.values()), lang) if kept[lang] else 1
            if own[t] and a > q:
                parts["term"].append(((a - q) ** 2 // q, t))
        for part, found in parts.items():
            found = sorted(found, key=lambda x: (-x[0], x[1].encode()))
            out += [(lang, source, part, item, value, k + 1) for k, (value, item) in enumerate(found)
                    if part == "pair" or k < longest]
    return sorted(out)


def told(df):
    return sorted(tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect())


def test_against_plain_counts(spark):
    """Also with several transducers of a language, read in several rounds, and blocks of few terms."""
    rows = [*awkward(), *[(900 + k, t, lang, s, 0, (1,), "g") for k, (t, lang, s) in enumerate([
        ("ÉCOLE École école été", "fr", "x"), ("école", "fr", "y"), ("été école Zürich zürich", "fr", ""), ("", "de", "x"),
        (None, "de", "y"), ("a ab abc abcd b bc 漢 漢字", "zz", "x"), ("abcd ab a 漢字", "zz", "x"), ("漢字 a abcd b " * 3000, "zz", None)])]]
    rows += [(2000 + k, b" ".join(words_of(k, 60 + 20 * k)).decode(), ("xx", "yy")[k % 2], "abc"[k % 3], 0, (1,), "g") for k in range(40)]
    want = plain(rows)
    assert len(want) > 300
    docs = table(spark, rows)
    assert told(v.audit(docs)) == want
    assert told(v.audit(docs, shard=37, round_bytes=4000, cells=64)) == want
    assert told(v.audit(docs, least=1, longest=5)) == plain(rows, 1, 5)


def test_empty_table(spark):
    assert v.audit(empty(spark)).collect() == []


def words_of(seed, n, letters="abc"):
    rng = np.random.default_rng(seed)
    return sorted({bytes(rng.choice(np.frombuffer(letters.encode(), np.uint8), rng.integers(1, 8))) for _ in range(n)})


def test_transducer_is_minimal_and_in_order():
    for seed, n in ((1, 300), (2, 40), (3, 1)):
        terms = words_of(seed, n)
        keys, target, skip, final = v.transducer(terms)
        text = b" ".join(terms) + b" ca cab zz a" + b"x" * 300
        data = np.frombuffer(text, np.uint8)
        start, end, _ = v.words(data, np.array([0, len(data)]), v.gaps())
        found = v.walk((keys, target, skip, final), data, start, end)
        known = {t: k for k, t in enumerate(terms)}
        assert found.tolist() == [known.get(text[a:b], -1) for a, b in zip(start, end)]
        # As many states as there are different futures of prefixes.
        futures = {frozenset(t[len(p):] for t in terms if t.startswith(p)) for t in terms for p in (t[:k] for k in range(len(t) + 1))}
        assert len(final) == len(futures)


def test_held_counters_are_passed_on(spark, monkeypatch):
    monkeypatch.setattr(v, "HELD", 50)
    assert told(v.audit(table(spark))) == plain(awkward())


def test_each_word_of_a_chunk_takes_its_way_once(spark, monkeypatch):
    """Repeated words are walked once for their chunk and language, and counted as often as they occur."""
    import types

    import numpy as np
    import pyarrow as pa

    from celltide.llm import divergence

    asked = []
    real = divergence.walk
    monkeypatch.setattr(divergence, "walk", lambda a, d, s, e: asked.append(len(s)) or real(a, d, s, e))
    parts = divergence.transducer([b"ab", b"b", b"c"])
    shards = types.SimpleNamespace(value=[(lang, 10, tuple(x.tobytes() for x in parts)) for lang in ("de", "en")])
    batch = pa.RecordBatch.from_pydict({
        "lang": ["de", "en", "de", "de"], "source": ["x", "x", "y", "x"],
        "text": ["ab AB ab zz b", "b b C", "c1c2ab", "ab zz zz"]})
    told = [r for b in divergence._recount(shards)(iter([batch])) for r in b.to_pylist()]
    counts = {}
    for r in told:
        key = (r["lang"], r["source"], r["ordinal"])
        counts[key] = counts.get(key, 0) + r["n"]
    assert counts == {("de", "x", 10): 4, ("de", "x", 11): 1, ("en", "x", 11): 2, ("en", "x", 12): 1,
                      ("de", "y", 10): 1, ("de", "y", 12): 2}
    assert sum(asked) == 6 and all(isinstance(n, int) for n in asked) and np.int64(sum(counts.values())) == 11
