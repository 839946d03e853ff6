"""Best-fit packing: token pieces into as few sequences of a fixed length as possible.

Large-item matching. Pieces above a third of the capacity share a sequence at most two at a time: from
the longest on, each is matched with the longest other one that still fits. Shorter pieces then go, from
the longest on, where the remaining gap is least, and a new sequence is begun where none fits.

Only lengths matter to the plan, and there are no more of them than the capacity. So the plan is made
once for the counts of all lengths (`plan`: a few rows per length, however many pieces there are), and
each piece finds its place by its rank among the pieces of its length. Ranks are counted in the task
that tokenizes, and the counts of the tasks before it are added by a window over (length, task).

Defined cases: a null text is empty; every document ends with the end id, so an empty one is one piece
of one token; documents longer than the capacity are cut into full pieces, the first of which may be
shorter; repeated rows are packed each; an empty table gives no sequence.
"""

from __future__ import annotations

import json
import os
import zlib
from bisect import bisect_left, insort
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from celltide.llm import textops
from celltide.llm.frames import as_text, load, materialize, shuffles
from celltide.session import small_batches

CAPACITY, END = 2048, 0
VOCABULARY = "byte_bpe_50k.json"
KNOWN_WORDS = 500_000  # words whose ids a worker remembers before it begins anew
CHUNK = 1 << 18  # bytes of text worked on at a time; the arrays made of it are many times as large
PIECES = (
    "doc_id BIGINT, piece INT, start BIGINT, length BIGINT, ids_crc32 BIGINT, part INT, nth BIGINT"
)

LETTER, DIGIT, SYMBOL, SPACE = range(4)


def _classes():
    out = np.full(256, SYMBOL, np.uint8)
    out[[*range(65, 91), *range(97, 123), *range(128, 256)]] = LETTER
    out[48:58] = DIGIT
    out[[32, *range(9, 14)]] = SPACE
    return out


def simple(data, offsets):
    """Texts of ASCII without control characters and of Latin letters in two bytes (U+00C0 to U+017F).

    Only these are split into words here; others go to the tokenizer as they are.
    """
    odd = (data < 32) & ((data < 9) | (data > 13)) | (data == 127)
    odd |= (data >= 0xC0) & ~((data >= 0xC3) & (data <= 0xC5))
    two = np.flatnonzero(data[:-1] == 0xC3)
    odd[two] |= (data[two + 1] < 0x80) | (data[two + 1] == 0x97) | (data[two + 1] == 0xB7)
    count = np.concatenate([[0], np.cumsum(odd)])
    return count[offsets[1:]] == count[offsets[:-1]]


def word_starts(data, offsets, classes):
    """Where the words begin that the tokenizer merges within: the published pattern of this family.

    A word is a run of letters, of digits or of other signs, with one blank before it if there is one;
    an English contraction; or white space, of which the last character before a word stands alone.
    """
    n = len(data)
    kind = classes[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    new = edge[:n].copy()
    new[1:] |= kind[1:] != kind[:-1]
    first = np.flatnonzero(new)
    last = np.append(first[1:], n) - 1
    follows = ~edge[last + 1]
    mark = np.zeros(n, bool)
    mark[first] = True
    gap = kind[first] == SPACE
    lone = last[gap & follows]
    mark[lone] = True
    blank = lone[data[lone] == 32]
    mark[blank + 1] = False
    apostrophe = first[(first == last) & (data[first] == 39) & follows]
    before = np.maximum(apostrophe - 1, 0)
    apostrophe = apostrophe[mark[apostrophe] | edge[apostrophe] | (data[before] != 32)]
    one = data[apostrophe + 1]
    inside = ~edge[np.minimum(apostrophe + 2, n)]
    two = np.where(inside, data[np.minimum(apostrophe + 2, n - 1)], 0)
    short = np.isin(one, np.frombuffer(b"stmd", np.uint8))
    long = (two == 101) & ((one == 114) | (one == 118)) | (one == 108) & (two == 108)
    for size, at in ((2, apostrophe[short]), (3, apostrophe[long])):
        mark[at + 1] = False
        after = at[at + size < n] + size
        mark[after[~edge[after] & (kind[after] == LETTER)]] = True
    return np.flatnonzero(mark)


def _by_rank(path):
    """Encoders of words parted by line feeds and of any one word, where ids rise with the merges."""
    import tiktoken

    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    byte = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
    vocab, merges = model["vocab"], model["merges"]
    pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
    ids = [vocab["".join(p)] for p in pairs]
    if ids != sorted(ids) or min(ids, default=256) < 256 or any(vocab[c] > 255 for c in byte):
        return None
    known = set(ids) | {vocab[c] for c in byte}
    ranks = {bytes(byte[c] for c in t): i for t, i in vocab.items() if i in known}
    return [
        tiktoken.Encoding("words", pat_str=p, mergeable_ranks=ranks, special_tokens={})
        for p in (r"[^\n]+|\n", r"[\s\S]+")
    ]


class Encoder:
    """Ids of whole texts. Each distinct word is merged once for a worker."""

    def __init__(self, vocabulary=VOCABULARY):
        from tokenizers import Tokenizer

        path = vocabulary
        if not os.path.isabs(path):
            import public_tokenizers

            path = public_tokenizers.path(vocabulary)
        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.quick = _by_rank(path)
        self.hasher, self.classes = textops.Hasher(), _classes()
        self._forget()

    def _forget(self):
        self.keys, self.ids, self.used = np.zeros(0, np.uint64), np.zeros(1 << 20, np.uint32), 0
        self.at, self.count = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def whole(self, text):
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _merged(self, words):
        """Ids of some words, and how many each has."""
        if not self.quick:
            lists = [self.whole(w.decode()) for w in words]
            return np.array([i for x in lists for i in x], np.uint32), np.array([len(x) for x in lists])
        many, single = self.quick
        broken = np.array([b"\n" in w for w in words], bool)
        feed = many.encode_ordinary("\n")[0]
        flat = np.array(many.encode_ordinary("\n".join(
            [w.decode() if not b else "x" for w, b in zip(words, broken)]) + "\n"), np.uint32)
        cut = np.flatnonzero(flat == feed)
        flat, count = np.delete(flat, cut), np.diff(cut, prepend=-1) - 1
        if broken.any():
            parts = np.split(flat, np.cumsum(count)[:-1])
            for i in np.flatnonzero(broken):
                parts[i] = np.array(single.encode_ordinary(words[i].decode()), np.uint32)
            flat, count = np.concatenate(parts), np.array([len(x) for x in parts])
        return flat, count

    def _learn(self, keys, words):
        flat, count = self._merged(words)
        while self.used + len(flat) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.ids[self.used : self.used + len(flat)] = flat
        to = np.searchsorted(self.keys, keys)
        self.keys = np.insert(self.keys, to, keys)
        self.at = np.insert(self.at, to, self.used + np.cumsum(count) - count)
        self.count = np.insert(self.count, to, count)
        self.used += len(flat)

    def _with_added(self, data, offsets):
        """Which texts hold an added token as text: it has an id of its own and splits the words around it."""
        out, raw = np.zeros(len(offsets) - 1, bool), data.tobytes()
        for token in self.added:
            at = raw.find(token)
            while at >= 0:
                row = int(np.searchsorted(offsets, at, "right")) - 1
                out[row] |= at + len(token) <= offsets[row + 1]
                at = raw.find(token, at + 1)
        return out

    def encode(self, data, offsets):
        """Ids of all texts of a batch in one array, and where each begins and the last ends."""
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        plain = simple(data, offsets) & ~self._with_added(data, offsets)
        if len(self.keys) > KNOWN_WORDS:
            self._forget()
        start = word_starts(data, offsets, self.classes)
        end = np.append(start[1:], len(data))
        key, one, word = np.unique(
            self.hasher.load(data).of(start, end), return_index=True, return_inverse=True)
        use = np.zeros(len(key), bool)
        use[word[plain[np.searchsorted(offsets, start, "right") - 1]]] = True
        where = np.searchsorted(self.keys, key)
        known = np.append(self.keys, np.uint64(0))[where] == key
        new = np.flatnonzero(use & ~(known & (where < len(self.keys))))
        if len(new):
            raw = data.tobytes()
            at = start[one[new]].tolist(), end[one[new]].tolist()
            self._learn(key[new], [raw[a:b] for a, b in zip(*at)])
            where = np.searchsorted(self.keys, key)
        where = np.minimum(where, max(len(self.keys) - 1, 0))
        at, count = np.append(self.at, 0)[where][word], np.append(self.count, 0)[where][word]
        bounds = np.searchsorted(start, offsets)
        odd = np.flatnonzero(~plain)
        for i in odd:
            count[bounds[i] : bounds[i + 1]] = 0
        total = np.concatenate([[0], np.cumsum(count)])
        out = self.ids[np.repeat(at - total[:-1], count) + np.arange(total[-1])]
        ends = total[bounds]
        if len(odd):
            parts = np.split(out, ends[1:-1])
            for i in odd:
                parts[i] = np.array(self.whole(data[offsets[i] : offsets[i + 1]].tobytes().decode()), np.uint32)
            out, ends = np.concatenate(parts), np.concatenate([[0], np.cumsum([len(x) for x in parts])])
        return out, ends


@lru_cache(maxsize=1)
def _encoder(vocabulary):
    """The encoder of this worker: it outlives a task, since short tasks would each read the vocabulary anew."""
    return Encoder(vocabulary)


def _tokenized(capacity, vocabulary):
    def fn(batches):
        encoder = _encoder(vocabulary)
        last = np.array([END], "<u4").tobytes()
        part, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for rows, data, offsets in textops.texts(batches, chunk=CHUNK):
            ids, ends = encoder.encode(data, offsets)
            ids = ids.astype("<u4")
            out = [[], [], [], [], [], []]
            for i in range(len(rows)):
                own = ids[ends[i] : ends[i + 1]].tobytes() + last
                n = len(own) // 4
                short, start = (n - 1) % capacity + 1, 0
                for piece in range((n - 1) // capacity + 1):
                    length = capacity if piece else short
                    crc = zlib.crc32(own[4 * start : 4 * (start + length)])
                    for column, value in zip(out, (i, piece, start, length, crc, seen[length])):
                        column.append(value)
                    seen[length] += 1
                    start += length
            take = pa.array(out[0], pa.int64())
            yield pa.record_batch({
                "doc_id": rows.column(0).take(take), "piece": pa.array(out[1], pa.int32()),
                "start": pa.array(out[2], pa.int64()), "length": pa.array(out[3], pa.int64()),
                "ids_crc32": pa.array(out[4], pa.int64()),
                "part": pa.array([part] * len(out[0]), pa.int32()), "nth": pa.array(out[5], pa.int64()),
            })

    return fn


def tokenize(docs: DataFrame, id_column="doc_id", text="text", capacity=CAPACITY, vocabulary=VOCABULARY):
    """The pieces of all documents: doc_id, piece, start, length, ids_crc32, and part and nth, the
    piece's rank among those of its length in its part."""
    docs = docs.select(F.col(id_column).cast("bigint").alias("doc_id"), as_text(docs, text).alias("text"))
    return materialize(docs.mapInArrow(_tokenized(capacity, vocabulary), PIECES), "pieces")


def plan(counts: dict[int, int], capacity=CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Where the pieces of each length go: rows (length, first rank, first sequence, times, offset).

    Of the pieces of a length from the first rank on, `times` go into each sequence from the first
    sequence on, one behind the other from `offset`.
    """
    left = {n: c for n, c in counts.items() if c}
    rank = dict.fromkeys(left, 0)
    rows, open_, gaps, sequences = [], {}, [], 0

    def begin(many):
        nonlocal sequences
        sequences += many
        return sequences - many

    def put(length, first, many, times, offset):
        rows.append((length, rank[length], first, times, offset))
        rank[length] += many * times
        left[length] -= many * times

    def leave(first, many, used):
        gap = capacity - used
        if gap and many:
            if gap not in open_:
                open_[gap] = []
                insort(gaps, gap)
            open_[gap].append((first, many))

    large = sorted(n for n in left if 3 * n > capacity)
    for i in range(len(large) - 1, -1, -1):
        n = large[i]
        while left[n]:
            j = bisect_left(large, capacity - n + 1) - 1
            while j >= 0 and not left[large[j]]:
                j -= 1
            m = large[j] if j >= 0 else None
            if m is None or (m == n and left[n] == 1):
                j = next((k for k in range(j - 1, -1, -1) if left[large[k]]), -1) if m == n else -1
                m = large[j] if j >= 0 else None
            if m is None:
                first, many = begin(left[n]), left[n]
                put(n, first, many, 1, 0)
                leave(first, many, n)
            elif m == n:
                many = left[n] // 2
                first = begin(many)
                put(n, first, many, 2, 0)
                leave(first, many, 2 * n)
            else:
                many = min(left[n], left[m])
                first = begin(many)
                put(n, first, many, 1, 0)
                put(m, first, many, 1, n)
                leave(first, many, n + m)
    for n in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        while left[n]:
            at = bisect_left(gaps, n)
            if at < len(gaps):
                gap = gaps[at]
                first, many = open_[gap].pop()
                if not open_[gap]:
                    del open_[gap], gaps[at]
            else:
                gap, many = capacity, -(-left[n] // (capacity // n))
                first = begin(many)
            times = min(gap // n, left[n])
            full = min(many, left[n] // times)
            put(n, first, full, times, capacity - gap)
            leave(first, full, capacity - gap + times * n)
            leave(first + full, many - full, capacity - gap)
    return rows


def _placed(rows):
    """sequence_id and offset of each piece by its length and rank."""

    def fn(batches):
        table = rows.value
        starts = table[:, 0] * (1 << 40) + table[:, 1]
        for batch in batches:
            length, rank = batch.column(5).to_numpy(), batch.column(6).to_numpy()
            size = batch.column(3).to_numpy()
            row = table[_find(table, starts, length, rank)]
            nth = rank - row[:, 1]
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in range(5)] + [
                    pa.array(row[:, 2] + nth // row[:, 3]), pa.array(row[:, 4] + nth % row[:, 3] * size)],
                ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    return fn


def _find(table, starts, length, rank):
    """The last row of each length that begins at the rank or before it."""
    lo = np.searchsorted(table[:, 0], length, "left")
    hi = np.searchsorted(table[:, 0], length, "right")
    while (hi - lo > 1).any():
        mid = (lo + hi) // 2
        below = (hi - lo > 1) & (table[np.minimum(mid, len(table) - 1), 1] <= rank)
        above = (hi - lo > 1) & ~below
        lo, hi = np.where(below, mid, lo), np.where(above, mid, hi)
    return lo


def pack(docs: DataFrame, id_column="doc_id", text="text", capacity=CAPACITY, vocabulary=VOCABULARY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset: one row for each piece."""
    spark = small_batches(docs.sparkSession)
    pieces = tokenize(docs, id_column, text, capacity, vocabulary)
    counted = pieces.groupBy("length", "part").agg(F.count("*").alias("n"))
    # A few rows for each part: no more files than tasks run at a time.
    files = min(shuffles(spark), spark.sparkContext.defaultParallelism)
    parts = materialize(counted.coalesce(files), "counts")
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    # No more rows than the capacity.
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    table = np.array(sorted(plan(counts, capacity)), np.int64).reshape(-1, 5)
    ranked = pieces.join(parts, ["length", "part"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", F.col("length").alias("size"),
        (F.col("before") + F.col("nth")).alias("rank"),
    )
    return ranked.mapInArrow(
        _placed(spark.sparkContext.broadcast(table)),
        "doc_id BIGINT, piece INT, start BIGINT, length BIGINT, ids_crc32 BIGINT, sequence_id BIGINT, offset BIGINT",
    )


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(load(spark, sf_dir, "documents"))
