"""Ranked lexical search by best-first ranges of documents.

Index. Documents are packed into blocks of about ``TOKENS`` terms; a block keeps its documents in ascending id, its terms and
for each term the posting list (positions of documents, term frequencies). Blocks are rows of a table, written once; all
terms of all documents are in it, whatever is asked later.

Search. Counts over the whole index (documents, lengths, document frequencies of the asked terms) give the weights. A task
that reads a block turns the posting lists of the asked terms into impacts and lays a sparse table over them: level j holds
the largest impact, and where it stands, of every run of 2^j postings. The largest impact of a term among the documents
[a, b) is then two lookups, and the sum over an item's terms bounds the score of every document there. Search starts with the
whole block, always goes on with the intervals of the largest bounds, scores the document of the largest impact in each and
splits the interval there. It ends when no interval can hold a document better than the best ``k`` found: higher bound, or an
equal one with smaller ids to come. The best ``k`` of the blocks that a task has read so far prune the next ones, so a task
returns ``k`` rows an item; those of all tasks are ranked in windows, salted first.

Items are the stated queries, asked of all rows. They are dealt into chunks of ``ASKED`` bytes of text; each chunk takes one
pass over the index, and only one chunk's terms and weights are sent to the tasks at a time. Items without terms return
nothing. Null texts have no terms and don't count in N; rows repeated are documents of their own, null ids come last among
equal scores. Very long texts are blocks of their own. Further columns are left alone; two items of one id are two items.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from crawlspark.llm.shared import small_batches, staged, tasks

TOKENS, ASKED, BEST, FRONT = 1 << 19, 4_000_000, 50, 64
# Terms are runs of ASCII letters and digits and of all characters beyond ASCII; only A-Z change case.
TERMS = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def terms(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(TERMS).split()


def _block(rows: list[tuple[object, list[bytes]]], kind: pa.DataType) -> pa.RecordBatch:
    """Documents (id, terms) as one row: ids, lengths, terms, and postings sorted by term and document."""
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] if r[0] is not None else 0))
    known: dict[bytes, int] = {}
    lengths = np.array([len(t) for _, t in rows], "int64")
    ids = np.fromiter((known.setdefault(w, len(known)) for _, t in rows for w in t), "int64", int(lengths.sum()))
    codes, tf = np.unique(ids * len(rows) + np.repeat(np.arange(len(rows)), lengths), return_counts=True)
    heads = np.searchsorted(codes // len(rows), np.arange(len(known) + 1))
    one = lambda a, t: pa.array([a], pa.list_(t))
    return pa.RecordBatch.from_arrays([
        one([r[0] for r in rows], kind), one(lengths, pa.int64()), one([w.decode() for w in known], pa.string()), one(np.diff(heads).astype("int32"), pa.int32()),
        one((codes % len(rows)).astype("int32"), pa.int32()), one(tf.astype("int32"), pa.int32())], names=["ids", "lengths", "terms", "df", "docs", "tf"])


def index(documents: DataFrame) -> DataFrame:
    """The index: one row a block with ids, lengths, terms, df (by term) and docs, tf (postings, by term)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for rows in batches:
            for doc, text in zip(rows.column("doc_id"), rows.column("text"), strict=True):
                found = terms(text.as_py())
                if not found:
                    continue
                if held and size + len(found) > TOKENS:
                    yield _block(held, rows.schema.field("doc_id").type)
                    held, size = [], 0
                held.append((doc.as_py(), found))
                size += len(found)
        if held:
            yield _block(held, rows.schema.field("doc_id").type)

    kind = documents.schema["doc_id"].dataType.simpleString()
    with small_batches(documents.sparkSession):
        return staged(documents.select("doc_id", "text").mapInArrow(run, f"ids array<{kind}>, lengths array<long>, terms array<string>, df array<int>, docs array<int>, tf array<int>"), "index", large=True)


class Ranges:
    """The asked posting lists of one block with their sparse table. ``asked``: the chunk's terms and their weights."""

    def __init__(self, row: dict, asked: pa.Array, weights: np.ndarray, share: tuple[int, int]):
        self.n = len(row["ids"])
        df = row["df"].astype("int64")
        ends = np.cumsum(df)
        number = pc.index_in(row["terms"], asked).fill_null(-1).to_numpy()
        here = [(int(number[k]), k) for k in np.flatnonzero(number >= 0).tolist()]
        self.terms = {term: at for at, (term, _) in enumerate(here)}
        parts = [np.arange(ends[k] - df[k], ends[k]) for _, k in here]
        where = np.concatenate(parts) if parts else np.zeros(0, "int64")
        doc, tf = row["docs"][where].astype("int64"), row["tf"][where].astype("int64")
        n_all, l_all = share
        m = 100 - 50 + (50 * row["lengths"] * n_all) // max(l_all, 1)
        weight = np.repeat(np.array([weights[t] for t, _ in here], "int64"), [len(p) for p in parts])
        best = weight * ((1_000_000_000 * tf) // (1000 * tf + 20 * m[doc]))
        # Lists stand one behind the other, so one code finds a document in a list.
        self.codes = np.repeat(np.arange(len(here)), [len(p) for p in parts]) * self.n + doc
        self.impact, self.doc = best, doc
        self.levels, self.places = [best], [np.arange(len(best))]
        longest = max((len(p) for p in parts), default=0)
        for j in range(max(longest, 1).bit_length() - 1):
            half, last, spot = 1 << j, self.levels[-1], self.places[-1]
            right = last[half:] > last[:-half]
            self.levels.append(np.where(right, last[half:], last[:-half]))
            self.places.append(np.where(right, spot[half:], spot[:-half]))
        # As one flat array each, for lookups of many runs at once.
        self.starts = np.cumsum([0, *(len(x) for x in self.levels)])[:-1]
        self.flat, self.spots = np.concatenate(self.levels), np.concatenate(self.places)

    def bounds(self, lists: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bound of each interval [low, high) and the document of the largest impact in it."""
        a = np.searchsorted(self.codes, lists[:, None] * self.n + low)
        b = np.searchsorted(self.codes, lists[:, None] * self.n + high)
        some = b > a
        level = np.frexp(np.maximum(b - a, 1))[1] - 1
        left = np.where(some, self.starts[level] + a, 0)
        right = np.where(some, self.starts[level] + b - (1 << level), 0)
        x, y = self.flat[left], self.flat[right]
        most = np.where(some, np.maximum(x, y), 0)
        top = most.argmax(0)
        pick = np.arange(len(low))
        spot = np.where(x >= y, self.spots[left], self.spots[right])[top, pick]
        return most.sum(0), np.where(most[top, pick] > 0, self.doc[spot], low)

    def scores(self, lists: np.ndarray, docs: np.ndarray) -> np.ndarray:
        want = lists[:, None] * self.n + docs
        at = np.minimum(np.searchsorted(self.codes, want), len(self.codes) - 1)
        return np.where(self.codes[at] == want, self.impact[at], 0).sum(0)


def best(ranges: Ranges, item: list[int], k: int, floor: int) -> tuple[np.ndarray, np.ndarray]:
    """Scores and documents of a block that may belong to the best ``k``: every one that has its place among the block's
    own, but those scoring below ``floor``."""
    lists = np.array([ranges.terms[t] for t in item if t in ranges.terms], "int64")
    score, doc = np.zeros(0, "int64"), np.zeros(0, "int64")
    if not len(lists):
        return score, doc
    low, high = np.array([0]), np.array([ranges.n])
    bound, top = ranges.bounds(lists, low, high)
    while len(low):
        # Once k are kept, an equal score counts only for a document that stands before the last of them.
        open_ = (bound > score[-1]) | ((bound == score[-1]) & (low < doc[-1])) if len(score) == k else bound >= max(floor, 1)
        low, high, bound, top = low[open_], high[open_], bound[open_], top[open_]
        if not len(low):
            break
        if len(low) > FRONT:
            order = np.argpartition(-bound, FRONT)
            now, later = order[:FRONT], order[FRONT:]
        else:
            now, later = np.arange(len(low)), np.arange(0)
        found = ranges.scores(lists, top[now])
        keep = found >= max(floor, 1)
        score, doc = np.append(score, found[keep]), np.append(doc, top[now][keep])
        order = np.lexsort((doc, -score))[:k]
        score, doc = score[order], doc[order]
        a, b = np.append(low[now], top[now] + 1), np.append(top[now], high[now])
        a, b = a[a < b], b[a < b]
        more, split = ranges.bounds(lists, a, b) if len(a) else (np.zeros(0, "int64"), np.zeros(0, "int64"))
        low, high = np.append(low[later], a), np.append(high[later], b)
        bound, top = np.append(bound[later], more), np.append(top[later], split)
    return score, doc


def _arrays(rows: pa.RecordBatch, names: tuple[str, ...]) -> Iterator[dict]:
    for k in range(rows.num_rows):
        yield {c: v if c == "terms" else v.to_pylist() if c == "ids" else v.to_numpy(zero_copy_only=False) for c in names for v in [rows.column(c)[k].values]}


def frequencies(found: DataFrame, asked: list[str]) -> dict[str, int]:
    """Documents of the whole index that hold each of the asked terms."""
    shared = found.sparkSession.sparkContext.broadcast(asked)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = pa.array(shared.value, pa.string())
        total = np.zeros(len(wanted), "int64")
        for rows in batches:
            for row in _arrays(rows, ("terms", "df")):
                at = pc.index_in(row["terms"], wanted).fill_null(-1).to_numpy()
                total[at[at >= 0]] += row["df"][at >= 0]
        yield pa.RecordBatch.from_arrays([wanted, pa.array(total)], names=["term", "n"]).filter(pa.array(total > 0))

    counted = found.select("terms", "df").mapInArrow(run, "term string, n long").groupBy("term").agg(F.sum("n").alias("n"))
    with small_batches(found.sparkSession):
        return {r.term: r.n for r in counted.collect()}


def asked_chunks(items: DataFrame, limit: int = ASKED) -> Iterator[list[tuple[int, object, list[str]]]]:
    """Chunks of (number, item_id, distinct terms), each of at most ``limit`` bytes of terms or one item."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            found = [sorted({w.decode() for w in terms(t.as_py())}) for t in rows.column("text")]
            yield pa.RecordBatch.from_arrays([rows.column("item_id"), pa.array(found, pa.list_(pa.string()))], names=["item_id", "terms"])

    kind = items.schema["item_id"].dataType.simpleString()
    held, size = [], 0
    for row in items.select("item_id", "text").mapInArrow(run, f"item_id {kind}, terms array<string>").filter(F.size("terms") > 0).toLocalIterator():
        own = sum(map(len, row.terms)) + 64
        if held and size + own > limit:
            yield held
            held, size = [], 0
        held.append((len(held), row.item_id, row.terms))
        size += own
    if held:
        yield held


def _search(found: DataFrame, chunk: list[tuple[int, object, list[str]]], totals: tuple[int, int], k: int) -> DataFrame:
    """(number, doc_id, score): the best ``k`` of every task for each item of the chunk."""
    words = sorted(set(chain.from_iterable(t for _, _, t in chunk)))
    df = frequencies(found, words)
    asked = {w: at for at, w in enumerate(words)}
    # Terms stand in the order of their numbers.
    weights = np.array([math.floor(1000 * math.log((2 * totals[0] + 2) / (2 * df.get(w, 0) + 1))) for w in words], "int64")
    shared = found.sparkSession.sparkContext.broadcast((words, weights, [[asked[w] for w in t] for _, _, t in chunk]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, weights, items = shared.value
        wanted = pa.array(words, pa.string())
        top: list[list[tuple]] = [[] for _ in items]
        kind = None
        for rows in batches:
            kind = rows.schema.field("ids").type.value_type
            for row in _arrays(rows, ("ids", "lengths", "terms", "df", "docs", "tf")):
                ranges = Ranges(row, wanted, weights, totals)
                for number, item in enumerate(items):
                    held = top[number]
                    score, doc = best(ranges, item, k, -held[-1][0] if len(held) == k else 1)
                    if len(score):
                        more = ((-s, row["ids"][d] is None, row["ids"][d] if row["ids"][d] is not None else 0) for s, d in zip(score.tolist(), doc.tolist(), strict=True))
                        top[number] = sorted([*held, *more])[:k]
        if kind is not None:
            flat = [(number, None if lost else doc, -score) for number, held in enumerate(top) for score, lost, doc in held]
            numbers, docs, scores = zip(*flat, strict=True) if flat else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int64()), pa.array(docs, kind), pa.array(scores, pa.int64())], names=["number", "doc_id", "score"])

    kind = found.schema["ids"].dataType.elementType.simpleString()
    return found.mapInArrow(run, f"number long, doc_id {kind}, score long")


def search(documents: DataFrame, items: DataFrame, k: int = BEST, found: DataFrame | None = None) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` best documents (doc_id, text) of each item (item_id, text).

    ``found`` is an :func:`index` of the documents made before.
    """
    spark = documents.sparkSession
    found = index(documents) if found is None else found
    counts = found.select(F.size("ids").cast("long").alias("n"), F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x).alias("l"))
    n, total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("l"), F.lit(0))).first()
    item, doc = items.schema["item_id"].dataType.simpleString(), documents.schema["doc_id"].dataType.simpleString()
    out = []
    for chunk in asked_chunks(items):
        names = spark.createDataFrame([(at, name) for at, name, _ in chunk], f"number long, item_id {item}")
        order = [F.desc("score"), F.col("doc_id").asc_nulls_last()]
        salt = F.pmod(F.xxhash64("doc_id"), F.lit(max(1, tasks(found) // 4)))
        rows = _search(found, chunk, (n, total), k).withColumn("salt", salt)
        rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy("number", "salt").orderBy(*order))).filter(F.col("rank") <= k)
        rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy("number").orderBy(*order))).filter(F.col("rank") <= k)
        # A chunk's ids are at most as large as the chunk.
        with small_batches(spark):
            rows = staged(rows.join(F.broadcast(names), "number").select("item_id", "rank", "doc_id", "score"), "ranked")
        out.append(rows)
    if not out:
        return spark.createDataFrame([], f"item_id {item}, rank int, doc_id {doc}, score long")
    union = out[0]
    for rows in out[1:]:
        union = union.unionByName(rows)
    return union
