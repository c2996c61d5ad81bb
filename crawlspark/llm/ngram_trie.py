"""Scores of a word bigram model, kept as Elias-Fano tries.

Model. P(w | v) = (c(v, w) - D) / c(v) for pairs seen in training, else a(v) P(w), where a(v) = D n(v) / c(v) is what the
discount ``D`` took from the n(v) followers of v (1 where v itself is new) and P(w) = (c(w) + k) / (N + k (V + 1)). Sums
stay at or below one. Texts begin behind a start mark and end with an end mark.

Trie. Words are 48-bit hashes, cut into shards by their first bits. A shard's first level holds its context words (their
hashes, monotone), monotone pointers to where each context's followers begin, and quantised a(v); the second level holds the
followers, made monotone by the context's rank in front, and quantised probabilities. Monotone sequences are Elias-Fano
coded: fixed low bits, and high bits as gaps in a bit vector with counts for selection. Levels are files that a task maps
into memory, reads, and removes. A pair is found by the context's rank, then by successor search among that context's
followers alone: the value's high bits select a bucket, and the low bits decide inside it. Training and held-out pairs are
looked up alike. Probabilities are rounded down, to 1/65536 of the shard's range.

Job. Counts of single words give N, V, c and the heavy contexts (over 1 / (4 shards) of all words: a list of at most
``HEAVY`` words), whose followers are dealt over several shards. A shard has about ``SHARD_WORDS`` training words, so their
number follows the input. Documents are packed into one block for each batch and shard, which names only the documents that
have pairs in it; texts longer than a batch are cut, each part with the word in front of it. A shard's task builds its tries
from the training pairs and scores every pair. Pairs that training has not seen go on to a join with the word counts.
Nothing is pruned: the model grows with the corpus.

Null and empty texts have the end mark only. Without training rows all words are unseen. Rows equal in id and text score
alike; null ids are scored.
"""

from __future__ import annotations

import os
import re
import tempfile

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlspark.llm.shared import staged

DISCOUNT, ADDED = 0.75, 0.1
WORD_BITS, FOLLOWER_BITS = 48, 40
START, END = 1, 2  # hashes kept free for the marks
BATCH_BYTES, CACHE = 7_000_000, 150_000
SHARD_WORDS, HEAVY, ASKED = 1_400_000, 1 << 18, 1 << 18
U = np.uint64


class EliasFano:
    """A monotone sequence of integers below ``universe``; its parts are arrays that may be mapped from a file."""

    def __init__(self, n: int, width: int, low: np.ndarray, high: np.ndarray, counts: np.ndarray):
        self.n, self.width, self.low, self.high, self.counts = n, width, low, high, counts

    @classmethod
    def encode(cls, values: np.ndarray, universe: int) -> EliasFano:
        n = len(values)
        width = max(0, (universe // max(n, 1)).bit_length() - 1)
        ones = (values >> U(width)).astype("int64") + np.arange(n)
        bits = np.zeros((int(ones[-1]) // 64 + 1) * 64 if n else 64, "uint8")
        bits[ones] = 1
        high = np.packbits(bits, bitorder="little").view("uint64")
        counts = np.concatenate([[0], np.cumsum(np.bitwise_count(high))]).astype("int64")
        if width:
            lows = (values & U((1 << width) - 1)).astype("<u8").view("uint8").reshape(n, 8)[:, :-(-width // 8)]
            low = np.ascontiguousarray(lows)
        else:
            low = np.zeros((n, 0), "uint8")
        return cls(n, width, low, high, counts)

    def __getitem__(self, index: np.ndarray) -> np.ndarray:
        """Values at positions."""
        out = (self._select(index, self.counts) - index).astype("uint64") << U(self.width)
        for k in range(self.low.shape[1]):
            out |= self.low[index, k].astype("uint64") << U(8 * k)
        return out

    def _select(self, rank: np.ndarray, counts: np.ndarray, flip: int = 0) -> np.ndarray:
        """Places of the set bits of these ranks in the high bits, of the unset ones with ``flip`` all ones."""
        at = np.searchsorted(counts, rank, "right") - 1
        rest, word = (rank - counts[at]).astype("uint64"), self.high[at] ^ U(flip)
        place = np.zeros(len(rank), "uint64")
        for step in (32, 16, 8, 4, 2, 1):
            ones = np.bitwise_count((word >> place) & U((1 << step) - 1)).astype("uint64")
            beyond = rest >= ones
            rest = np.where(beyond, rest - ones, rest)
            place = np.where(beyond, place + U(step), place)
        return at * 64 + place.astype("int64")

    def _bucket(self, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions from which on values have at least the high bits of each value, and those where they have more."""
        unset = np.arange(len(self.counts)) * 64 - self.counts
        high = (value >> U(self.width)).astype("int64")
        last = int(unset[-1])

        def passed(k):  # positions before the k-th unset bit, counted from 1
            inside = np.clip(k, 1, max(last, 1))
            found = self._select(inside - 1, unset, 2**64 - 1) - (inside - 1) if last else np.full(len(k), self.n)
            return np.where(k > last, self.n, np.where(k < 1, 0, found))
        return passed(high), passed(high + 1)

    def find(self, value: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The position of each value within its range of positions, -1 where it isn't there.

        A successor search: the bucket of the value's high bits, cut to the range, then its low bits."""
        first, behind = self._bucket(value)
        low, high = np.maximum(begin, first), np.minimum(end, behind)
        end = high.copy()
        while (open_ := low < high).any():
            at = np.flatnonzero(open_)
            middle = (low[at] + high[at]) // 2
            less = self[middle] < value[at]
            low[at[less]], high[at[~less]] = middle[less] + 1, middle[~less]
        inside = np.flatnonzero(low < end)
        out = np.full(len(value), -1)
        hit = inside[self[low[inside]] == value[inside]]
        out[hit] = low[hit]
        return out

    def parts(self) -> list[np.ndarray]:
        return [self.low, self.high, self.counts]


class Trie:
    """Both levels of a shard, mapped from files in ``folder``."""

    def __init__(self, folder: str, context: np.ndarray, follower: np.ndarray, count: np.ndarray, total: np.ndarray):
        """Rows are (context, follower) in order; ``total`` is c(v) of each row's context."""
        names, first, sizes = np.unique(context, return_index=True, return_counts=True)
        rank = np.repeat(np.arange(len(names)), sizes).astype("uint64")
        self.folder, self.files = folder, []
        self.contexts = self._mapped(EliasFano.encode(names, 1 << WORD_BITS))
        self.pointers = self._mapped(EliasFano.encode(np.append(first, len(context)).astype("uint64"), len(context) + 1))
        self.followers = self._mapped(EliasFano.encode(rank << U(FOLLOWER_BITS) | follower, max(1, len(names)) << FOLLOWER_BITS))
        self.chance = self._quantised(np.log10(np.maximum(count - DISCOUNT, 1e-9)) - np.log10(total))
        self.left = self._quantised(np.log10(DISCOUNT * sizes) - np.log10(total[first]) if len(first) else np.zeros(0))
        self.sizes = sizes

    def _file(self, array: np.ndarray) -> np.ndarray:
        if not array.size:
            return array
        name = os.path.join(self.folder, f"level-{len(self.files)}")
        array.tofile(name)
        self.files.append(name)
        return np.memmap(name, array.dtype, "r", shape=array.shape)

    def _mapped(self, sequence: EliasFano) -> EliasFano:
        sequence.low, sequence.high, sequence.counts = map(self._file, sequence.parts())
        return sequence

    def _quantised(self, log: np.ndarray) -> tuple[np.ndarray, float, float]:
        low, high = (float(log.min()), float(log.max())) if len(log) else (0.0, 0.0)
        step = (high - low) / 65535 or 1.0
        return self._file(np.floor((log - low) / step + 1e-9).astype("uint16")), low, step

    @staticmethod
    def _read(level, index):
        codes, low, step = level
        return codes[index] * step + low

    def lookup(self, context: np.ndarray, follower: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """log10 of each pair's probability, NaN where it isn't kept, and log10 of its context's backoff, 0 for new contexts."""
        n = len(context)
        new = np.append(True, context[1:] != context[:-1]) if n else np.zeros(0, bool)
        names = context[new]
        rank = self.contexts.find(names, np.zeros(len(names), "int64"), np.full(len(names), self.contexts.n))[np.cumsum(new) - 1]
        known = np.flatnonzero(rank >= 0)
        chance, left = np.full(n, np.nan), np.zeros(n)
        r = rank[known]
        left[known] = self._read(self.left, r)
        place = self.followers.find(r.astype("uint64") << U(FOLLOWER_BITS) | follower[known], self.pointers[r].astype("int64"), self.pointers[r + 1].astype("int64"))
        chance[known[place >= 0]] = self._read(self.chance, place[place >= 0])
        return chance, left


class Hasher:
    """48-bit hashes of the words of a text: runs of anything but ASCII white space, A-Z in lower case."""

    def __init__(self):
        self.kept: dict[bytes, int] = {}

    def __call__(self, text: str | None) -> np.ndarray:
        words = (text or "").encode().lower().split()
        kept = self.kept
        try:
            return np.fromiter(map(kept.__getitem__, words), "uint64", len(words))
        except KeyError:
            if len(kept) > CACHE:
                kept.clear()
            for w in words:
                if w not in kept:
                    kept[w] = max(3, xxhash.xxh3_64_intdigest(w) >> 64 - WORD_BITS)
            return np.fromiter(map(kept.__getitem__, words), "uint64", len(words))


def _mix(*keys) -> np.ndarray:
    h = np.zeros(len(keys[0]), "uint64")
    for k in keys:
        h = (h ^ k) * U(0x9E3779B97F4A7C15)
        h ^= h >> U(29)
    return h


_GAP = re.compile(r"[\x20\x09-\x0D]")


def _parts(text: str):
    """A text in parts of about ``BATCH_BYTES`` characters, cut at white space (a longer word stays whole)."""
    begin = 0
    while len(text) - begin > BATCH_BYTES and (gap := _GAP.search(text, begin + BATCH_BYTES)):
        yield text[begin:gap.start()]
        begin = gap.end()
    yield text[begin:]


def _batches(frames):
    """(row, words, first part?, last part?) of documents in lists of bounded characters and at most 60,000 parts.

    A row is its number in its frame, which comes with the list."""
    hasher = Hasher()
    for rows in frames:
        out, size = [], 0
        for k, text in enumerate(rows.column("text")):
            parts = list(_parts(text.as_py() or ""))
            for p, part in enumerate(parts):
                out.append((k, hasher(part), p == 0, p == len(parts) - 1))
                size += len(part)
                if size > BATCH_BYTES or len(out) >= 60_000:
                    yield rows, out
                    out, size = [], 0
        if out:
            yield rows, out


def word_counts(training: DataFrame) -> DataFrame:
    """(word, c): hashes of words and marks with their counts in the training texts."""
    def run(frames):
        for _, found in _batches(frames):
            ends = sum(last for *_, last in found)
            words, counts = np.unique(np.concatenate([x for _, x, _, _ in found] + [np.repeat(np.array([END, START], "uint64"), ends)]), return_counts=True)
            for k in range(0, len(words), 100_000):
                yield pa.RecordBatch.from_arrays([pa.array(words[k:k + 100_000].astype("int64")), pa.array(counts[k:k + 100_000])], names=["word", "c"])

    return training.select("text").mapInArrow(run, "word long, c long").groupBy("word").agg(F.sum("c").alias("c"))


def _pack(array: np.ndarray) -> bytes:
    return zstandard.compress(array.tobytes(), 1)


def _unpack(content: bytes, dtype: str) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(content), dtype)


def _shard(context: np.ndarray, follower: np.ndarray, shards: int, heavy: np.ndarray, spread: np.ndarray) -> np.ndarray:
    """The shard of each pair: by the context's hash; a heavy context's pairs also by the follower's."""
    out = (_mix(context) % U(shards)).astype("int64")
    if len(heavy):
        at = np.minimum(np.searchsorted(heavy, context), len(heavy) - 1)
        hot = heavy[at] == context
        out[hot] = ((_mix(context[hot]) + _mix(context[hot], follower[hot]) % spread[at[hot]]) % U(shards)).astype("int64")
    return out


def blocks(documents: DataFrame, shards: int, heavy: np.ndarray, spread: np.ndarray) -> DataFrame:
    """Pairs of each batch for each shard: their documents, then contexts, followers, place of the document, times."""
    names = ["shard", "ids", "ties", "held", "context", "follower", "place", "times"]

    def run(frames):
        before = START  # the word in front of a part that goes on
        for rows, found in _batches(frames):
            numbers = np.array([k for k, *_ in found])
            follower, context = [], []
            for _, words, first, last in found:
                chain = np.concatenate([np.array([START if first else before], "uint64"), words, np.array([END] * last, "uint64")])
                follower.append(chain[1:])
                context.append(chain[:-1])
                before = chain[-1]
            place = np.repeat(numbers, [len(x) for x in follower]).astype("uint64")
            follower, context = np.concatenate(follower), np.concatenate(context)
            _, at, times = np.unique(_mix(context, follower, place), return_index=True, return_counts=True)
            context, follower, place = context[at], follower[at], place[at].astype("int64")
            shard = _shard(context, follower, shards, heavy, spread)
            order = np.lexsort((context, shard))
            heads = np.flatnonzero(np.diff(shard[order], prepend=-1))
            known = np.unique(place)
            ids, ties, held = (np.zeros(rows.num_rows, t) for t in ("int64", "int64", "bool"))
            for array, column, null in ((ids, "doc_id", -2**63), (ties, "tie", 0), (held, "held", False)):
                array[known] = [null if (x := rows.column(column)[k].as_py()) is None else x for k in known.tolist()]
            out = []
            for begin, end in zip(heads, np.append(heads[1:], len(order)), strict=True):
                o = order[begin:end]
                own, number = np.unique(place[o], return_inverse=True)
                gaps = np.diff(context[o], prepend=U(0))
                six = follower[o].astype("<u8").view("uint8").reshape(-1, 8)[:, :6]
                out.append((int(shard[o[0]]), _pack(ids[own]), _pack(ties[own]), _pack(held[own]), _pack(gaps), _pack(np.ascontiguousarray(six)),
                            _pack(number.astype("uint16")), _pack(times[o].astype("uint32"))))
            for k in range(0, len(out), 1000):
                yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in out[k:k + 1000]], schema=pa.schema([("shard", pa.int32())] + [(n, pa.binary()) for n in names[1:]]))

    return documents.mapInArrow(run, "shard int, " + ", ".join(f"{n} binary" for n in names[1:]))


def _score_shard(frame: pd.DataFrame, heavy: np.ndarray, totals: np.ndarray, n: float, v: float) -> pd.DataFrame:
    """Sums for each document of a shard's blocks, the pairs that training has not seen, and followers of heavy contexts."""
    parts, offset = [], 0
    keys = []
    for r in frame.itertuples(index=False):
        ids = _unpack(r.ids, "int64")
        keys.append((ids, _unpack(r.ties, "int64"), _unpack(r.held, "bool")))
        six = _unpack(r.follower, "uint8").reshape(-1, 6)
        wide = np.zeros((len(six), 8), "uint8")
        wide[:, :6] = six
        parts.append((np.cumsum(_unpack(r.context, "uint64"), dtype="uint64"), wide.view("<u8").ravel(), _unpack(r.place, "uint16").astype("int32") + offset, _unpack(r.times, "uint32")))
        offset += len(ids)
    ids, ties, held = (np.concatenate(x) for x in zip(*keys, strict=True))
    context, follower, place, times = (np.concatenate(x) for x in zip(*parts, strict=True))
    del parts, frame
    short = follower >> U(WORD_BITS - FOLLOWER_BITS)
    # Each different pair once: how often training has it, and where it stands among the pairs.
    order = np.lexsort((short, context))
    new = np.ones(len(order), bool)
    new[1:] = (context[order[1:]] != context[order[:-1]]) | (short[order[1:]] != short[order[:-1]])
    first = np.flatnonzero(new)
    asked, asked_short = context[order[first]], short[order[first]]
    counts = np.add.reduceat(np.where(held[place], 0, times)[order], first, dtype="int64") if len(first) else np.zeros(0, "int64")
    which = np.empty(len(order), "int32")
    which[order] = np.cumsum(new) - 1
    del order, new, short
    seen = counts > 0
    counts, pair_context, pair_short = counts[seen], asked[seen], asked_short[seen]
    names, begin = np.unique(pair_context, return_index=True)
    sums = np.add.reduceat(counts, begin).astype("float64") if len(counts) else np.zeros(0)
    if len(heavy) and len(names):
        at = np.minimum(np.searchsorted(heavy, names), len(heavy) - 1)
        sums = np.where(heavy[at] == names, totals[at], sums)
    per_pair = np.repeat(sums, np.diff(np.append(begin, len(counts))))
    with tempfile.TemporaryDirectory() as folder:
        trie = Trie(folder, pair_context, pair_short, counts, per_pair)
        del pair_context, pair_short, per_pair
        found = [trie.lookup(asked[k:k + ASKED], asked_short[k:k + ASKED]) for k in range(0, len(asked), ASKED)]
        sizes = trie.sizes
        del trie
    chance, left = (np.concatenate([x[k] for x in found] or [np.zeros(0)]) for k in (0, 1))
    unseen = np.isnan(chance)
    hot = np.isin(asked, heavy) if len(heavy) else np.zeros(len(asked), bool)
    chance[unseen] = np.where(hot, 0.0, left)[unseen]
    at = np.minimum(np.searchsorted(names, asked), max(len(names) - 1, 0))
    c = np.where(names[at] == asked, sums[at], 0.0) if len(names) else np.zeros(len(asked))
    if len(heavy):  # a shard may hold a heavy context for held-out pairs only
        h = np.minimum(np.searchsorted(heavy, asked), len(heavy) - 1)
        c = np.where(heavy[h] == asked, totals[h], c)
    word = asked != START
    base = np.where(word, np.log10((c + ADDED) / (n + ADDED * (v + 1))), 0.0)
    known = word & (c > 0)
    del found, left, at, c, asked, asked_short

    def per_document(x):
        return np.bincount(place, x * times, len(ids))
    some = np.bincount(place, minlength=len(ids)) > 0
    out = {"doc_id": ids[some], "tie": ties[some], "score": per_document(chance[which])[some], "base": per_document(base[which])[some], "known": per_document(known[which])[some],
           "tokens": per_document(1)[some], "ends": per_document(follower == END)[some]}
    gone = np.flatnonzero(unseen[which])
    lost = {"doc_id": ids[place[gone]], "tie": ties[place[gone]], "word": follower[gone], "behind": np.where(hot[which[gone]], context[gone], U(0)), "tokens": times[gone]}
    del context, follower, which, place, times
    near = np.isin(names, heavy) if len(heavy) else np.zeros(len(names), bool)
    kinds = {"word": names[near], "tokens": sizes[near]}
    parts = [(kind, len(x["tokens"]), x) for kind, x in enumerate((out, lost, kinds))]
    columns = {"kind": np.concatenate([np.full(rows, kind, "int32") for kind, rows, _ in parts])}
    for name, kind in list(_TYPES.items())[1:]:
        columns[name] = np.concatenate([x[name].astype(kind) if name in x else np.zeros(rows, kind) for _, rows, x in parts])
    return pd.DataFrame(columns)


_TYPES = {"kind": "int32", "doc_id": "int64", "tie": "int64", "score": "float64", "base": "float64", "known": "int64", "tokens": "int64", "ends": "int64", "word": "int64", "behind": "int64"}
_SCHEMA = "kind int, doc_id long, tie long, score double, base double, known long, tokens long, ends long, word long, behind long"


def score(documents: DataFrame, held: Column, shards: int | None = None) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of each row of ``documents`` (doc_id, text).

    ``held`` is a condition on doc_id: the rows that are not learned from.
    """
    rows = documents.select("doc_id", "text", F.coalesce(held, F.lit(False)).alias("held"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("tie"))
    counts = staged(word_counts(rows.filter(~F.col("held"))), "words")
    n, v, ends = counts.filter(F.col("word") != START).agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1)), F.coalesce(F.max(F.when(F.col("word") == END, F.col("c"))), F.lit(0))).first()
    shards = shards or max(8, -(-n // SHARD_WORDS))
    # At most 4 * shards, and no more than HEAVY, words (and the start mark) can hold so large a share.
    part = max(1.0, n / min(4 * shards, HEAVY))
    found = sorted((r["word"], r["c"]) for r in counts.filter(F.col("c") >= part).collect() if r["word"] != END)
    heavy, totals = np.array([w for w, _ in found], "uint64"), np.array([c for _, c in found], "float64")
    spread = np.ceil(totals / part).astype("uint64")
    packed = blocks(rows, shards, heavy, spread)
    parts = staged(packed.groupBy("shard").applyInPandas(lambda f: _score_shard(f, heavy, totals, n, v), _SCHEMA), "scores")

    followers = {r["word"]: r["n"] for r in parts.filter("kind = 2").groupBy("word").agg(F.sum("tokens").alias("n")).collect()}
    backoff = [(int(w), float(np.log10(DISCOUNT * followers[w] / c))) for w, c in found if w in followers] + [(0, 0.0)]
    table = documents.sparkSession.createDataFrame(backoff, "_behind long, left double")
    denominator = n + ADDED * (v + 1)
    words = counts.select(F.col("word").alias("_word"), F.col("c"))
    lost = parts.filter("kind = 1").select("doc_id", "tie", "word", "behind", F.col("tokens").alias("n"))
    chance = F.log10((F.coalesce("c", F.lit(0)) + ADDED) / denominator)
    lost = (lost.join(words, F.col("word") == F.col("_word"), "left").join(F.broadcast(table), F.col("behind") == F.col("_behind"))
            .select("doc_id", "tie", (F.col("n") * (chance + F.col("left"))).alias("score")))
    zero = [F.lit(0.0).alias("base"), *[F.lit(0).cast("long").alias(c) for c in ("known", "tokens", "ends")]]
    every = parts.filter("kind = 0").select("doc_id", "tie", "score", "base", "known", "tokens", "ends").unionByName(lost.select("doc_id", "tie", "score", *zero))
    sums = every.groupBy("doc_id", "tie").agg(*[F.sum(c).alias(c) for c in ("score", "base", "known", "tokens", "ends")])
    # Rows equal in id and text were summed; each has one end mark.
    each = sums.withColumn("_", F.explode(F.sequence(F.lit(1).cast("long"), F.col("ends"))))
    last = float(np.log10((ends + ADDED) / denominator))
    null = F.lit(-2**63).cast("long")
    keyed = each.withColumn("doc_id", F.when(F.col("doc_id") != null, F.col("doc_id")))
    return keyed.select("doc_id", F.coalesce(held, F.lit(False)).alias("held_out"), F.expr("tokens div ends").alias("n_tokens"), (F.expr("known div ends") + (1 if ends else 0)).cast("long").alias("n_known"),
                        F.lit(n).cast("long").alias("train_tokens"), (F.col("base") / F.col("ends") + last).alias("base_score"), (F.col("score") / F.col("ends")).alias("score"))
