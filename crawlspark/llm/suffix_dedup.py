"""Removal of repeated passages by suffix sorting.

A byte goes if a string of ``LENGTH`` bytes over it also starts in a document with a smaller id. So all starts of such
strings must be sorted, over all documents, and equal ones brought together.

* Partition. Each string has an anchor, its ``GRAM``-byte piece of least hash (the leftmost of equals); equal strings have
  equal anchors. Consecutive strings with one anchor make a stretch of text, about twenty strings long; stretches go to
  shards by their anchor, packed into blocks for each batch and shard. Within a batch equal stretches are settled at
  once: only those of the smallest id go on, as one text with all its places, where starts at most ``LENGTH`` apart are one
  place: what goes at each of them touches. So a run of one byte is a few stretches, however long it is.
* Hot anchors. Anchors with more than about ``HOT`` different stretches, by a sample of one part in ``SAMPLE``, are split:
  strings that hold the 25 bytes from their anchor on go by the anchor and those bytes, the others by it and the 25 bytes
  before it. Equal strings still meet; what the sample says only moves the load.
* Prune. A string holds the 25 bytes on one side of its anchor, so a stretch can only repeat if the 25 bytes on its left or
  its right are those of another document's stretch. Equal stretches settle by their smallest id. Of stretches left alone
  on both sides nothing repeats.
* Sort. What is left is sorted by suffix, deep-shallow: multikey quicksort, eight bytes a symbol, to the depth ``SHALLOW``,
  and groups that still tie are ordered by blind tries, which look at one byte a branch and compare one string a walk.
  Neighbours that share ``LENGTH`` bytes repeat; all but those in the smallest document are removed.

Spans come back as one row for each document and shard, are joined with the documents, and united. Texts are UTF-8 bytes;
matches end at document borders; strings are judged on the input. Null and empty texts have nothing to remove; rows that
share an id stand at one place in the order of ids, so they don't remove each other's bytes, and each text of an id has its
own spans; null ids come first.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlspark.llm.shared import fresh, staged, tasks

LENGTH, GRAM, SIDE, SHALLOW = 50, 12, 25, 32
BATCH_BYTES = 3_000_000
PIECE_BYTES = 8_000_000
HOT, SAMPLE, PART = 1 << 14, 16, 1 << 16
U = np.uint64
NULL = -2**63


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> U(30))) * U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U(27))) * U(0x94D049BB133111EB)
    return h ^ (h >> U(31))


def _words(buffer: np.ndarray) -> np.ndarray:
    """The eight bytes from each position as a big-endian number; the buffer must have eight bytes to spare."""
    out = np.zeros(len(buffer) - 8, "uint64")
    for k in range(8):
        out <<= U(8)
        out |= buffer[k:len(buffer) - 8 + k]
    return out


def _word_at(buffer: np.ndarray, position: np.ndarray) -> np.ndarray:
    """The same at some positions; a shard's buffer is too large for a number at each byte."""
    out = np.zeros(len(position), "uint64")
    for k in range(8):
        out <<= U(8)
        out |= buffer[position + k]
    return out


def stretches(content: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(start, strings, anchor, document) of each stretch in a buffer of documents that end at ``ends``."""
    n = len(content)
    buffer = np.concatenate([content, np.zeros(LENGTH + 16, "uint8")])
    words = _words(buffer)
    grams = _mix(words[:n + LENGTH] ^ _mix(words[GRAM - 8:n + LENGTH + GRAM - 8] + U(1)))
    width = LENGTH - GRAM + 1
    best = (grams & ~U(0xFFFFFF)) | np.arange(len(grams), dtype="uint64")
    step = 1
    while 2 * step <= width:
        best = np.minimum(best[:-step], best[step:])
        step *= 2
    best = np.minimum(best[:n], best[width - step:n + width - step])
    anchor = (best & U(0xFFFFFF)).astype("int64")
    document = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
    valid = np.arange(n) + LENGTH <= ends[document]
    new = np.ones(n, bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (document[1:] != document[:-1])
    new &= valid
    start = np.flatnonzero(new)
    count = np.add.reduceat(valid.astype("int64"), start) if len(start) else np.zeros(0, "int64")
    return start, count, anchor[start], document[start]


def _digests(buffer: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """64-bit hashes of slices of up to 96 bytes; the buffer must have 104 bytes to spare."""
    out = length.astype("uint64") * U(0x9E3779B97F4A7C15)
    for k in range(0, int(length.max(initial=0)), 8):
        left = np.clip(length - k, 0, 8).astype("uint64")
        word = _word_at(buffer, start + k) >> ((U(8) - left) * U(8) & U(63))
        out = np.where(left > 0, _mix(out ^ word), out)
    return out


def _anchors(buffer: np.ndarray, anchor: np.ndarray) -> np.ndarray:
    return _mix(_word_at(buffer, anchor) ^ _mix(_word_at(buffer, anchor + GRAM - 8) + U(7)))


def hot_anchors(documents: DataFrame) -> np.ndarray:
    """Hashes of the anchors that a sample of the texts shows with many different stretches, sorted."""
    def count(parts):
        content = np.frombuffer(b"".join(parts), "uint8")
        start, strings, anchor, _ = stretches(content, np.cumsum([len(t) for t in parts]))
        buffer = np.concatenate([content, np.zeros(112, "uint8")])
        _, one = np.unique(_digests(buffer, start, strings + LENGTH - 1), return_index=True)
        found, n = np.unique(_anchors(buffer, anchor[one]), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(found.view("int64")), pa.array(n.astype("int64"))], names=["anchor", "n"])

    def run(frames):
        parts, size = [], 0
        for frame in frames:
            for i, t in zip(frame.column("doc_id"), frame.column("text"), strict=True):
                text, own = (t.as_py() or "").encode(), i.as_py()
                for base in range(0, len(text), PART):
                    if len(text) <= PART or zlib.crc32(f"{own}:{base}".encode()) % SAMPLE == 0:
                        parts.append(text[base:base + PART + LENGTH - 1])
                        size += len(parts[-1])
                        if size > BATCH_BYTES:
                            yield count(parts)
                            parts, size = [], 0
        if parts:
            yield count(parts)

    # A short text is taken whole, by its id; of a long one (by bytes) some parts are.
    chosen = documents.filter((F.octet_length("text") > PART) | (F.pmod(F.xxhash64("doc_id", F.length("text")), F.lit(SAMPLE)) == 0))
    counted = chosen.select("doc_id", "text").mapInArrow(run, "anchor long, n long").groupBy("anchor").agg(F.sum("n").alias("n"))
    hot = counted.filter(F.col("n") * SAMPLE > HOT).select("anchor").collect()
    return np.sort(np.array([r["anchor"] for r in hot], "int64").view("uint64"))


def blocks(documents: DataFrame, shards: int, hot: np.ndarray | None = None) -> DataFrame:
    """Stretches of each batch for each shard. ``settled`` spans repeat an earlier document of the batch."""
    names = ["ids", "ties", "text", "length", "anchor", "place", "places", "start", "reach", "settled_place", "settled_start", "settled_length"]
    hot = np.zeros(0, "uint64") if hot is None else hot

    def pack(array, dtype):
        return zstandard.compress(np.ascontiguousarray(array.astype(dtype)).tobytes(), 3)

    documents = documents if "tie" in documents.columns else documents.withColumn("tie", F.lit(0).cast("long"))

    def batch(ids, ties, texts, bases):
        content = np.frombuffer(b"".join(texts), "uint8")
        ends = np.cumsum([len(t) for t in texts])
        start, count, anchor, document = stretches(content, ends)
        if not len(start):
            return
        buffer = np.concatenate([content, np.zeros(112, "uint8")])
        begins = np.concatenate([[0], ends[:-1]])
        length = count + LENGTH - 1
        digest = _digests(buffer, start, length)
        own = ids[document]
        order = np.lexsort((own, digest))
        first = np.ones(len(order), bool)
        first[1:] = digest[order][1:] != digest[order][:-1]
        least = own[order][np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))]
        settled = own[order] > least
        # What goes at once needs no other stretch: it is united, and dealt to shards by document.
        gone = np.sort(order[settled])
        united = _united(start[gone] + document[gone], start[gone] + document[gone] + length[gone]) if len(gone) else np.zeros((0, 2), "int64")
        apart = ends + np.arange(len(ends))
        gone_document = np.searchsorted(apart, united[:, 0], side="right")
        gone_start = united[:, 0] - gone_document - begins[gone_document] + bases[gone_document]
        gone_length = united[:, 1] - united[:, 0]
        gone_shard = (_mix(ids[gone_document].view("uint64")) % U(shards)).astype("int64")
        # The others: one text each, with its places.
        kept, first = order[~settled], np.flatnonzero(first[~settled])
        new = np.ones(len(kept), bool)
        new[1:] = (document[kept][1:] != document[kept][:-1]) | (np.diff(start[kept]) > LENGTH)
        new[first] = True
        heads = np.flatnonzero(new)
        lead = kept[heads]
        place_start = start[lead] - begins[document[lead]] + bases[document[lead]]
        reach = start[kept[np.append(heads[1:], len(kept)) - 1]] - start[lead]
        place_cut = np.searchsorted(heads, np.append(first, len(kept)))
        texts_at = kept[first]
        key = _anchors(buffer, anchor[texts_at])
        middle = anchor[texts_at] - start[texts_at]
        text = np.arange(len(texts_at))
        skip, strings = np.zeros(len(text), "int64"), count[texts_at]
        if len(hot):
            split = np.flatnonzero(hot[np.minimum(np.searchsorted(hot, key), len(hot) - 1)] == key)
            before = np.clip(middle[split] - SIDE, 0, strings[split])
            side = np.full(len(split), SIDE)
            at = anchor[texts_at[split]]
            left, right = before > 0, before < strings[split]
            left_key = _mix(key[split] ^ _digests(buffer, np.where(left, at - SIDE, 0), side))
            right_key = _mix(key[split] ^ (_digests(buffer, np.where(right, at, 0), side) + U(1)))
            whole = np.ones(len(text), bool)
            whole[split] = False
            key = np.concatenate([key[whole], left_key[left], right_key[right]])
            skip = np.concatenate([skip[whole], np.zeros(left.sum(), "int64"), before[right]])
            strings = np.concatenate([strings[whole], before[left], (strings[split] - before)[right]])
            text = np.concatenate([text[whole], split[left], split[right]])
        shard = (key % U(shards)).astype("int64")
        order = np.lexsort((texts_at[text], shard))
        text, skip, strings = text[order], skip[order], strings[order]
        cuts = np.searchsorted(shard[order], np.arange(shards + 1))
        gone_order = np.argsort(gone_shard, kind="stable")
        gone_cuts = np.searchsorted(gone_shard[gone_order], np.arange(shards + 1))
        shared, shared_ties = pack(ids, "int64"), pack(ties, "int64")
        for s in np.flatnonzero(np.diff(cuts) + np.diff(gone_cuts)):
            span = strings[cuts[s]:cuts[s + 1]] + LENGTH - 1
            g = gone_order[gone_cuts[s]:gone_cuts[s + 1]]
            borders = np.flatnonzero(np.diff((np.cumsum(span) - 1) // PIECE_BYTES)) + 1
            for a, b in zip([0, *borders], [*borders, len(span)], strict=True):
                own, off, n = text[cuts[s] + a:cuts[s] + b], skip[cuts[s] + a:cuts[s] + b], span[a:b]
                from_ = start[texts_at[own]] + off
                at = np.repeat(from_ - (np.cumsum(n) - n), n) + np.arange(n.sum())
                places = np.diff(place_cut)[own]
                c = np.repeat(place_cut[own] - (np.cumsum(places) - places), places) + np.arange(places.sum())
                yield (int(s), shared, shared_ties, pack(content[at], "uint8"), pack(n, "uint8"), pack(middle[own] - off, "uint8"), pack(document[lead[c]], "uint32"), pack(places, "uint32"),
                       pack(place_start[c] + np.repeat(off, places), "uint32"), pack(reach[c], "uint32"),
                       pack(gone_document[g], "uint32"), pack(gone_start[g], "uint32"), pack(gone_length[g], "uint32"))
                g = g[:0]

    schema = pa.schema([("shard", pa.int32())] + [(n, pa.binary()) for n in names])

    def emit(parts):
        ids, ties, texts, bases = zip(*parts, strict=True)
        rows, size = [], 0
        for r in batch(np.array(ids, "int64"), np.array(ties, "int64"), texts, np.array(bases, "int64")):
            rows.append(dict(zip(schema.names, r, strict=True)))
            size += len(r[3])
            if size > PIECE_BYTES:
                yield pa.RecordBatch.from_pylist(rows, schema=schema)
                rows, size = [], 0
        yield pa.RecordBatch.from_pylist(rows, schema=schema)

    def run(frames):
        for frame in frames:
            parts, size = [], 0
            for i, tie, t in zip(frame.column("doc_id"), frame.column("tie"), frame.column("text"), strict=True):
                text = (t.as_py() or "").encode()
                # Positions in a batch have 24 bits: longer texts go in parts, each with the starts of its own strings.
                for base in range(0, max(1, len(text)), BATCH_BYTES):
                    part = text[base:base + BATCH_BYTES + LENGTH - 1]
                    if size + len(part) > BATCH_BYTES and parts:
                        yield from emit(parts)
                        parts, size = [], 0
                    parts.append((NULL if (x := i.as_py()) is None else x, tie.as_py(), part, base))
                    size += len(part)
            if parts:
                yield from emit(parts)

    return documents.mapInArrow(run, "shard int, " + ", ".join(f"{n} binary" for n in names))


def shallow(buffer: np.ndarray, position: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Multikey quicksort by eight-byte symbols down to ``SHALLOW`` bytes: the order, and the group of each sorted suffix.

    Every round sorts within the groups that still tie by their next symbol and splits them; others are left where they are.
    """
    order = np.arange(len(position))
    group = np.zeros(len(position), "int64")
    open_ = np.arange(len(position))
    for depth in range(0, SHALLOW, 8):
        if not len(open_):
            break
        part = order[open_]
        symbol = _word_at(buffer, position[part] + depth)
        inner = np.lexsort((symbol, group[open_]))
        order[open_] = part[inner]
        symbol, own = symbol[inner], group[open_]
        new = np.ones(len(open_), bool)
        new[1:] = (symbol[1:] != symbol[:-1]) | (own[1:] != own[:-1])
        heads = np.maximum.accumulate(np.where(new, open_, 0))
        group[open_] = heads
        size = np.bincount(np.cumsum(new) - 1)
        open_ = open_[np.repeat(size > 1, size)]
    return order, group


class BlindTrie:
    """Orders strings of one length that share a prefix; a branch holds a position and children by the byte there."""

    def __init__(self, depth: int):
        self.depth, self.root = depth, None  # a leaf is a list of members, a branch (position, {byte: child})

    def add(self, text: bytes, member: int) -> None:
        if self.root is None:
            self.root = [text, member]
            return
        node = self.root
        while isinstance(node, tuple):  # a blind walk: missing bytes follow any child
            byte = text[node[0]]
            node = node[1].get(byte) or next(iter(node[1].values()))
        other = node[0]
        if other == text:
            node.append(member)
            return
        apart = self.depth
        while other[apart] == text[apart]:
            apart += 1
        above, node = None, self.root
        while isinstance(node, tuple) and node[0] < apart:
            above, node = node, node[1][text[node[0]]]
        if isinstance(node, tuple) and node[0] == apart:
            node[1][text[apart]] = [text, member]
            return
        branch = (apart, {other[apart]: node, text[apart]: [text, member]})
        if above is None:
            self.root = branch
        else:
            above[1][text[above[0]]] = branch

    def ordered(self):
        """Members of equal strings, in the order of the strings."""
        open_ = [self.root]
        while open_:
            node = open_.pop()
            if isinstance(node, tuple):
                open_ += [node[1][b] for b in sorted(node[1], reverse=True)]
            else:
                yield node[1:]


def repeated(buffer: np.ndarray, position: np.ndarray, document: np.ndarray) -> np.ndarray:
    """For each suffix whether its first ``LENGTH`` bytes also start in a smaller document."""
    order, group = shallow(buffer, position)
    out = np.zeros(len(position), bool)
    cuts = np.flatnonzero(np.diff(group, prepend=-1))
    sizes = np.diff(np.append(cuts, len(group)))
    content = memoryview(np.ascontiguousarray(buffer))
    for begin, size in zip(cuts[sizes > 1].tolist(), sizes[sizes > 1].tolist(), strict=True):
        members = order[begin:begin + size].tolist()
        texts = [bytes(content[p:p + LENGTH]) for p in position[members].tolist()]
        if size == 2:
            equal = [members] if texts[0] == texts[1] else []
        else:
            trie = BlindTrie(SHALLOW)
            for text, member in zip(texts, members, strict=True):
                trie.add(text, member)
            equal = trie.ordered()
        for same in equal:
            if len(same) > 1:
                ids = document[same]
                out[np.array(same)[ids > ids.min()]] = True
    return out


def _shared(key: np.ndarray, ids: np.ndarray, has: np.ndarray) -> np.ndarray:
    """Where a key stands in two different documents."""
    out = np.zeros(len(key), bool)
    at = np.flatnonzero(has)
    if len(at):
        order = at[np.lexsort((ids[at], key[at]))]
        k, d = key[order], ids[order]
        new = np.ones(len(order), bool)
        new[1:] = k[1:] != k[:-1]
        heads = np.flatnonzero(new)
        last = np.append(heads[1:], len(order)) - 1
        out[order] = np.repeat(d[heads] != d[last], np.diff(np.append(heads, len(order))))
    return out


def settle(frame: pd.DataFrame) -> pd.DataFrame:
    """doc_id, tie and spans (begin, end) to remove, as pairs of 32-bit numbers, from a shard's blocks."""
    def unpack(content, dtype):
        return np.frombuffer(zstandard.decompress(content), dtype)

    texts, fields, places, gone, named, base = [], [], [], [], [], 0
    for r in frame.itertuples(index=False):
        ids = unpack(r.ids, "int64")
        named.append((ids, unpack(r.ties, "int64")))
        n, place = unpack(r.places, "uint32").astype("int64"), unpack(r.place, "uint32").astype("int64")
        texts.append(unpack(r.text, "uint8"))
        fields.append((unpack(r.length, "uint8").astype("int64"), unpack(r.anchor, "uint8").astype("int64"), ids[place[np.cumsum(n) - n]], n))
        places.append(((place + base).astype("int32"), unpack(r.start, "uint32").astype("int64"), unpack(r.reach, "uint32").astype("int64")))
        begin = unpack(r.settled_start, "uint32").astype("int64")
        gone.append((unpack(r.settled_place, "uint32").astype("int32") + np.int32(base), begin, begin + unpack(r.settled_length, "uint32")))
        base += len(ids)
    all_ids, all_ties = (np.concatenate(x) for x in zip(*named, strict=True))
    buffer = np.concatenate(texts + [np.zeros(112, "uint8")])
    del texts, named
    length, anchor, ids, n_places = (np.concatenate(x) for x in zip(*fields, strict=True))
    owner_of, start, reach = (np.concatenate(x) for x in zip(*places, strict=True))
    first_place = np.cumsum(n_places) - n_places

    def placed(at, begin, end):
        # What goes from a text goes at all its places.
        n = n_places[at]
        of = np.repeat(np.arange(len(at)), n)
        c = np.repeat(first_place[at] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        return owner_of[c], start[c] + begin[of], start[c] + reach[c] + end[of]
    found = [tuple(np.concatenate(x) for x in zip(*gone, strict=True))]
    offset = np.cumsum(length) - length
    middle = offset + anchor
    right, left = length - anchor >= SIDE, anchor >= SIDE
    side = np.full(len(length), SIDE)
    keys = [(_digests(buffer, np.where(right, middle, 0), side), right), (_digests(buffer, np.where(left, middle - SIDE, 0), side), left)]
    live = np.flatnonzero(_shared(keys[0][0], ids, right) | _shared(keys[1][0], ids, left))
    # Equal stretches: those of larger documents repeat throughout.
    digest = _digests(buffer, offset[live], length[live])
    order = np.lexsort((ids[live], digest))
    first = np.ones(len(order), bool)
    first[1:] = digest[order][1:] != digest[order][:-1]
    least = np.empty(len(order), "int64")
    least[order] = ids[live][order][np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))]
    later = ids[live] > least
    at = live[later]
    found.append(placed(at, np.zeros(len(at), "int64"), length[at]))
    live = live[~later]
    mixed = _shared(keys[0][0][live], ids[live], right[live]) | _shared(keys[1][0][live], ids[live], left[live])
    live = live[mixed]
    count = length[live] - LENGTH + 1
    inside = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    owner = np.repeat(live, count)
    on = repeated(buffer, offset[owner] + inside, ids[owner])
    at, inside = owner[on], inside[on]
    found.append(placed(at, inside, inside + LENGTH))

    # Texts are numbered in the order of id and tie, so that spans sort by one number.
    order = np.lexsort((all_ties, all_ids))
    new = np.ones(len(order), bool)
    new[1:] = (np.diff(all_ids[order]) != 0) | (np.diff(all_ties[order]) != 0)
    number = np.empty(len(order), "uint64")
    number[order] = np.cumsum(new) - 1
    heads = order[new]
    owner, begin, end = (np.concatenate(x) for x in zip(*found, strict=True))
    del found, buffer, keys, owner_of, start, reach
    owner = number[owner]
    order = np.argsort(owner << U(32) | begin.astype("uint64"))
    owner, begin, end = owner[order], begin[order], end[order]
    cuts = np.flatnonzero(np.diff(owner)) + 1
    rows = [(int(all_ids[heads[owner[a]]]), int(all_ties[heads[owner[a]]]), _united(begin[a:b], end[a:b]).astype("uint32").tobytes())
            for a, b in zip([0, *cuts], [*cuts, len(owner)], strict=True) if a < b]
    return pd.DataFrame(rows, columns=["doc_id", "tie", "spans"])


def _united(begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Spans, sorted by begin, with those that touch or overlap made one, as rows of (begin, end)."""
    reach = np.maximum.accumulate(end)
    new = np.ones(len(begin), bool)
    new[1:] = begin[1:] > reach[:-1]
    heads = np.flatnonzero(new)
    return np.stack([begin[heads], reach[np.append(heads[1:], len(begin)) - 1]], 1)


def tied(documents: DataFrame, key: str, tie: str) -> DataFrame:
    """``documents`` with the id (null as the smallest number) and what tells the texts of an id apart: 0 where it has one text
    only, else the text's hash. Unless an id has several texts, that is one narrow aggregation."""
    digest = F.xxhash64(F.coalesce("text", F.lit("")))
    rows = documents.withColumn(key, F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL).cast("long")))
    several = rows.groupBy(F.col(key).alias("_several")).agg(F.min(digest).alias("_low"), F.max(digest).alias("_high")).filter("_low <> _high").select("_several")
    several = staged(several, "several")
    if several.isEmpty():
        return rows.withColumn(tie, F.lit(0).cast("long"))
    (own,) = fresh(rows, "_several")
    joined = rows.join(several.withColumnRenamed("_several", own), F.col(key) == F.col(own), "left")
    return joined.withColumn(tie, F.when(F.col(own).isNotNull(), digest).otherwise(F.lit(0).cast("long"))).drop(own)


def spans(rows: DataFrame, shards: int | None = None) -> DataFrame:
    """_id, _tie (of ``rows``: doc_id, tie, text) and the lists of spans to remove, one list for each shard that has some."""
    shards = shards or 2 * tasks(rows)
    packed = blocks(rows, shards, hot_anchors(rows))
    found = packed.groupBy("shard").applyInPandas(settle, "doc_id long, tie long, spans binary")
    return staged(found.groupBy(F.col("doc_id").alias("_id"), F.col("tie").alias("_tie")).agg(F.collect_list("spans").alias("spans")), "spans", clean=True)


def remove(documents: DataFrame, shards: int | None = None, report: bool = False) -> DataFrame:
    """``documents`` with repeated passages removed from ``text`` (bytes that no longer form a character are dropped).

    With ``report``: doc_id, n_bytes, n_removed, n_spans, kept_sha256 of the remaining bytes instead.
    """
    own_key, own_tie, own_id, own_other, own_spans = fresh(documents, "_key", "_tie", "_id", "_other", "_spans")
    rows = tied(documents.select("doc_id", "text") if report else documents, own_key, own_tie)
    found = spans(rows.select("doc_id", F.col(own_tie).alias("tie"), "text"), shards).toDF(own_id, own_other, own_spans)
    joined = rows.join(found, (F.col(own_key) == F.col(own_id)) & (F.col(own_tie) == F.col(own_other)), "left").drop(own_key, own_tie, own_id, own_other)

    def cut(text, lists):
        text = (text or "").encode()
        if not lists:
            return text, 0, 0
        own = np.concatenate([np.frombuffer(x, "uint32").reshape(-1, 2) for x in lists]).astype("int64")
        own = own[np.argsort(own[:, 0], kind="stable")]
        united = np.minimum(_united(own[:, 0], own[:, 1]), len(text))
        united = united[united[:, 0] < united[:, 1]]
        edges = [0, *united.ravel().tolist(), len(text)]
        return b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)), int((united[:, 1] - united[:, 0]).sum()), len(united)

    names = documents.columns

    def run(batches):
        for rows_ in batches:
            done = [cut(t.as_py(), s.as_py()) for t, s in zip(rows_.column("text"), rows_.column(own_spans), strict=True)]
            if report:
                yield pa.RecordBatch.from_arrays([rows_.column("doc_id"), pa.array([len(x) + n for x, n, _ in done], pa.int64()), pa.array([n for _, n, _ in done], pa.int64()),
                                                  pa.array([k for _, _, k in done], pa.int64()), pa.array([hashlib.sha256(x).hexdigest() for x, _, _ in done])],
                                                 names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])
            else:
                texts = [None if t.as_py() is None else x.decode("utf-8", "ignore") for t, (x, _, _) in zip(rows_.column("text"), done, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()) if c == "text" else rows_.column(c) for c in names], names=names)

    if report:
        return joined.mapInArrow(run, f"doc_id {documents.schema['doc_id'].dataType.simpleString()}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    return joined.select(*names, own_spans).mapInArrow(run, documents.schema)
