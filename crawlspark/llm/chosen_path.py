"""Near-duplicate documents by a chosen-path set similarity join.

A document is its set of word shingles. Equal sets are one node, known by a digest; what follows works on nodes.

Candidates come from ``TREES`` independent trees over minwise values of ``COORDINATES`` hash functions. A tree's node picks
coordinates by a hash of its path, and each document goes on to the children named by its values there; a document of
similarity s to another follows it through a picked coordinate with probability s, and a tree node picks ``1 / threshold`` of
them on average, so pairs at the threshold keep meeting while others part. Tree nodes of up to ``NODE`` documents are compared
exhaustively by signature, larger ones branch on. A pair may link if its signatures agree in at least the threshold less five
standard deviations and its sizes allow it; of a tree node's such pairs a maximum spanning forest goes out, which says what
hangs together with one row a document. Near copies, which no coordinate parts, leave a large tree node before it branches:
those that may link with one document, its hub, go out as its star, together with all that could link with any of them. What is still large after ``DEPTH`` levels goes out as a star, too. The components of all these edges are clusters: two
documents that link and meet anywhere are in one.

Links are decided on the full sets, cluster by cluster. Only the texts of clusters are moved: a sieve of bits keeps most
others from the shuffle, and the join behind it is exact. A cluster is cut into blocks of about ``WEIGHT`` shingles, and every
block holds the cluster's hub besides, the document that most edges lead to. A set moves once to its block, where posting
lists count the common shingles of one document and all others of the block; hubs come first, and a document whose component
is the block's largest need not be counted against its own kind. What the hub's links have not joined across blocks is then
compared between blocks, again without those already joined. Blocks give back one row a document, its component; pairs are
never written. Two documents at the threshold miss each other at the first level with probability (1 - t) ^ (2 * TREES),
7e-12 at 0.8; deeper levels lose more, measured in the tests.

Null, empty and blank texts have the empty set and link with nothing. Each distinct set is a node of its own whatever the ids
of its rows, so two texts under one id keep their links apart; a component bears the smallest id of its rows, null ids
counting last. Very long texts are read whole, and a set larger than a block is a block. Further columns are left alone.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from crawlspark.llm.components import components
from crawlspark.llm.shared import fresh, released, staged

COORDINATES, TREES, DEPTH, NODE = 128, 8, 3, 128
DEVIATIONS = 5
HUBS, SHARE = 8, 8  # documents tried as the hub of a large tree node's near copies; the copies are 1 / SHARE of it at least
WEIGHT = 1 << 18  # shingles of a block
FRAME = 8 * WEIGHT  # bytes of candidate rows compared in one call, about
SIEVE = 64, 27  # bits of the sieve of wanted rows: for each of them, and at most (a power of two)
CACHE, PART = 100_000, 512  # words whose hashes a task keeps; rows it works on at a time
_RNG = np.random.default_rng(20240229)
MULTIPLIERS = _RNG.integers(1, 2**63, COORDINATES, dtype="uint64") * np.uint64(2) + np.uint64(1)
OFFSETS = _RNG.integers(0, 2**63, COORDINATES, dtype="uint64")
FACTOR = np.uint64(0x9E3779B97F4A7C15)


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Shingler:
    """Sets of hashed shingles; words are runs of anything but ASCII white space, A-Z in lower case."""

    def __init__(self, size: int):
        self.size, self.kept = size, {}

    def __call__(self, text: str | None) -> np.ndarray:
        words = (text or "").encode().lower().split()
        if not words:
            return np.zeros(0, "uint64")
        kept = self.kept
        if len(kept) > CACHE:
            kept.clear()
        try:
            hashes = np.fromiter(map(kept.__getitem__, words), "uint64", len(words))
        except KeyError:
            for w in words:
                if w not in kept:
                    kept[w] = xxhash.xxh3_64_intdigest(w)
            hashes = np.fromiter(map(kept.__getitem__, words), "uint64", len(words))
        n = min(self.size, len(words))
        total = np.zeros(len(words) - n + 1, "uint64")
        for k in range(n):
            total = total * FACTOR + hashes[k:len(words) - n + 1 + k]
        return np.unique(mixed(total ^ np.uint64(n)))


def signature(found: np.ndarray) -> np.ndarray:
    out = np.full(COORDINATES, 2**64 - 1, "uint64")
    for at in range(0, len(found), 4096):
        part = found[at:at + 4096]
        for k in range(0, COORDINATES, 32):
            np.minimum(out[k:k + 32], (part * MULTIPLIERS[k:k + 32, None] + OFFSETS[k:k + 32, None]).min(1), out=out[k:k + 32])
    return (mixed(out) >> np.uint64(32)).astype("uint32")


PICKS = np.random.default_rng(7).permutation(COORDINATES)[:2 * TREES]  # coordinates of the first levels, two a tree


def text_tie() -> F.Column:
    return F.unhex(F.md5(F.coalesce("text", F.lit(""))))


def parts(batches):
    for batch in batches:
        for at in range(0, batch.num_rows, PART):
            yield batch.slice(at, PART)


def sets(df: DataFrame, size: int) -> DataFrame:
    """doc_id, tie (hash of the text), n_shingles, digest (null for the empty set), heads (the values at ``PICKS``), brief
    (eight bits of each value)."""
    def run(batches):
        shingle = Shingler(size)
        for rows in parts(batches):
            counts, digests, heads, briefs = [], [], [], []
            for value in rows.column("text"):
                found = shingle(value.as_py())
                counts.append(len(found))
                digests.append(xxhash.xxh3_128_digest(found.tobytes()) if len(found) else None)
                signs = signature(found) if len(found) else None
                heads.append(None if signs is None else signs[PICKS].tobytes())
                briefs.append(None if signs is None else (signs & 255).astype("uint8").tobytes())
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), rows.column("tie"), pa.array(counts, pa.int64()), *(pa.array(c, pa.binary()) for c in (digests, heads, briefs))],
                                             names=["doc_id", "tie", "n_shingles", "digest", "heads", "brief"])

    kind = df.schema["doc_id"].dataType.simpleString()
    return df.select("doc_id", "text", text_tie().alias("tie")).mapInArrow(run, f"doc_id {kind}, tie binary, n_shingles long, digest binary, heads binary, brief binary")


def _numbers(seed: int, path: np.ndarray) -> np.ndarray:
    return mixed(path + np.uint64(seed % 2**64) * FACTOR)


def roots(nodes: DataFrame) -> DataFrame:
    """Every node under the first level of each tree: two coordinates a tree."""
    def run(batches):
        for rows in batches:
            heads = np.frombuffer(b"".join(rows.column("heads").to_pylist()), "uint32").reshape(-1, len(PICKS))
            for k, at in enumerate(PICKS):
                path = mixed(heads[:, k].astype("uint64") + np.uint64((int(at) << 32) + (k // 2 << 48)))
                yield pa.RecordBatch.from_arrays([rows.column("node"), pa.array(path.view("int64"))], names=["node", "path"])

    return nodes.select("node", "heads").mapInArrow(run, "node long, path long")


def branch(rows: DataFrame, percent: int) -> DataFrame:
    """Children of large nodes: 100 / percent coordinates on average, at least one, by the hash of the path."""
    more = 100 / percent - 1

    def run(batches):
        for batch in batches:
            path = batch.column("path").to_numpy(zero_copy_only=False).view("uint64")
            signs = np.frombuffer(b"".join(batch.column("brief").to_pylist()), "uint8").reshape(-1, COORDINATES)
            twice = _numbers(3, path) < np.uint64(int(more * 2**64) if more < 1 else 2**64 - 1)
            for turn in (0, 1):
                at = (_numbers(1 + turn, path) % np.uint64(COORDINATES)).astype("int64")
                child = mixed(path * FACTOR + np.uint64(turn) + (at.astype("uint64") << np.uint64(8)) + signs[np.arange(len(at)), at])
                on = np.ones(len(at), bool) if turn == 0 else twice
                chosen = batch.filter(pa.array(on))
                yield pa.RecordBatch.from_arrays([*(chosen.column(c) for c in ("node", "size", "brief")), pa.array(child[on].view("int64"))], names=["node", "size", "brief", "path"])

    return rows.select("node", "size", "brief", "path").mapInArrow(run, "node long, size long, brief binary, path long")


def least_agreement(percent: int) -> int:
    """Coordinates of ``COORDINATES`` in which the signatures of two documents that may link agree at least."""
    share = percent / 100
    return int(np.ceil(COORDINATES * (share - DEVIATIONS * (share * (1 - share) / COORDINATES) ** 0.5)))


def hubs_of(rows: DataFrame, percent: int) -> DataFrame:
    """(_path, hub, sign) of tree nodes where two of ``HUBS`` documents, taken by hash, may link: the one that agrees most."""
    tried = [F.min_by(F.struct("node", "brief"), F.xxhash64("node", F.lit(k))).alias(f"h{k}") for k in range(HUBS)]
    found = rows.groupBy(F.col("path").alias("_path")).agg(*tried)
    found = found.select("_path", F.array(*[f"h{k}.node" for k in range(HUBS)]).alias("nodes"), F.concat(*[f"h{k}.brief" for k in range(HUBS)]).alias("signs"))
    least = least_agreement(percent)

    def run(batches):
        for batch in batches:
            path, best, sign = [], [], []
            for p, nodes, signs in zip(*(batch.column(c).to_pylist() for c in ("_path", "nodes", "signs")), strict=True):
                signs = np.frombuffer(signs, "uint8").reshape(HUBS, COORDINATES)
                same = (signs[:, None] == signs).sum(2)
                same[np.equal.outer(nodes, nodes)] = 0  # the same document drawn again
                k = max(range(HUBS), key=lambda k: ((same[k] >= least).sum(), same[k].sum()))
                if same[k].max() >= least:
                    path.append(p), best.append(nodes[k]), sign.append(signs[k].tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(path, pa.int64()), pa.array(best, pa.int64()), pa.array(sign, pa.binary())], names=["_path", "hub", "sign"])

    return found.mapInArrow(run, "_path long, hub long, sign binary")


def measured(rows: DataFrame, hubs: DataFrame) -> DataFrame:
    """Rows of the tree nodes in ``hubs`` with hub and ``same``, the number of coordinates in which they agree with it."""
    def run(batches):
        for batch in batches:
            signs, hub = (np.frombuffer(b"".join(batch.column(c).to_pylist()), "uint8").reshape(-1, COORDINATES) for c in ("brief", "sign"))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("node", "size", "brief", "path", "n", "hub")), pa.array((signs == hub).sum(1))],
                                             names=["node", "size", "brief", "path", "n", "hub", "same"])

    rows = rows.join(hubs, F.col("path") == F.col("_path")).select("node", "size", "brief", "path", "n", "hub", "sign")
    return rows.mapInArrow(run, "node long, size long, brief binary, path long, n long, hub long, same long")


def star_sizes(rows: DataFrame, percent: int) -> DataFrame:
    """(_path, core) of the tree nodes in ``measured`` rows whose star is worth it: how many near copies the hub has.

    Agreement is a distance turned round: what may link with a near copy of the hub agrees with the hub in twice the least
    agreement less ``COORDINATES`` at least. That goes into the star, too, and must not outnumber the near copies.
    """
    least = least_agreement(percent)
    core, near = (F.sum((F.col("same") >= x).cast("long")) for x in (least, 2 * least - COORDINATES))
    found = rows.groupBy(F.col("path").alias("_path")).agg(core.alias("core"), near.alias("_near"), F.first("n").alias("_n"))
    return found.filter((2 * F.col("core") >= F.col("_near")) & (SHARE * F.col("core") >= F.col("_n"))).select("_path", "core")


def _forest(weight: np.ndarray) -> list[tuple[int, int]]:
    """Edges of a maximum spanning forest of a symmetric matrix; zero is no edge."""
    n = len(weight)
    best, parent, left = np.zeros(n), np.full(n, -1), np.ones(n, bool)
    out = []
    for _ in range(n):
        v = int(np.argmax(np.where(left, best, -1)))
        if best[v] > 0:
            out.append((int(parent[v]), v))
        left[v] = False
        closer = weight[v] > best
        best, parent = np.where(closer, weight[v], best), np.where(closer, v, parent)
    return out


def _edges(frame: pd.DataFrame, percent: int) -> pd.DataFrame:
    """Spanning forests (a, b), a < b, of the pairs that may link in each tree node of a frame."""
    frame = frame.drop_duplicates(["path", "node"]).sort_values(["path", "node"], ignore_index=True)
    path, ids, size = (frame[c].to_numpy() for c in ("path", "node", "size"))
    signs = np.frombuffer(b"".join(frame["brief"]), "uint8").reshape(-1, COORDINATES)
    least = least_agreement(percent) / COORDINATES
    heads = np.flatnonzero(np.append(True, path[1:] != path[:-1]))
    sizes = np.diff(np.append(heads, len(path)))
    # Nodes of two, most of all, at once.
    i = heads[sizes == 2]
    i = i[np.minimum(size[i], size[i + 1]) * 100 >= np.maximum(size[i], size[i + 1]) * percent]
    i = i[(signs[i] == signs[i + 1]).mean(1) >= least]
    found = [np.stack([ids[i], ids[i + 1]], 1)]
    for begin, n in zip(heads[sizes > 2].tolist(), sizes[sizes > 2].tolist(), strict=True):
        z = size[begin:begin + n]
        x, y = np.nonzero(np.triu(np.minimum(z[:, None], z) * 100 >= np.maximum(z[:, None], z) * percent, 1))
        same = np.concatenate([(signs[begin + x[k:k + 8192]] == signs[begin + y[k:k + 8192]]).mean(1) for k in range(0, max(len(x), 1), 8192)])
        x, y, same = x[same >= least], y[same >= least], same[same >= least]
        if len(x):
            weight = np.zeros((n, n))
            weight[x, y] = weight[y, x] = same
            edges = np.array(_forest(weight))
            found.append(np.stack([ids[begin + edges.min(1)], ids[begin + edges.max(1)]], 1))
    return pd.DataFrame(np.concatenate(found).astype("int64"), columns=["a", "b"])


def candidates(nodes: DataFrame, percent: int) -> DataFrame:
    """Distinct edges (a, b) that hold together what may link."""
    def counted(rows):
        n = rows.groupBy("path").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").withColumnRenamed("path", "_path")
        return rows.join(n, F.col("path") == F.col("_path")).drop("_path")

    brief = nodes.select(F.col("node").alias("_node"), F.col("n_shingles").alias("size"), "brief")
    first = staged(roots(nodes), "roots")
    level = released(staged(counted(first).join(brief, F.col("node") == F.col("_node")).drop("_node"), "level"), first)
    found, kept = [], []
    for depth in range(DEPTH + 1):
        kept.append(level)
        small, large = level.filter(F.col("n") <= NODE), level.filter(F.col("n") > NODE)
        if depth < DEPTH and not large.isEmpty():
            hubs = staged(hubs_of(large, percent), "hubs")
            kept.append(hubs)
            if not hubs.isEmpty():
                rows = staged(measured(large, hubs), "measured")
                sizes = staged(star_sizes(rows, percent), "sizes")
                kept += [rows, sizes]
                rows = rows.join(sizes, F.col("path") == F.col("_path"))
                star = rows.filter(F.col("same") >= 2 * least_agreement(percent) - COORDINATES).filter("node <> hub")
                found.append(star.select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")))
                # Near copies have met all that they may link with; the others go on without them.
                rest = rows.filter(F.col("same") < least_agreement(percent)).select("node", "size", "brief", "path", (F.col("n") - F.col("core")).alias("n"))
                small = small.unionByName(rest.filter(F.col("n").between(2, NODE)))
                large = large.join(sizes, F.col("path") == F.col("_path"), "left_anti").unionByName(rest.filter(F.col("n") > NODE))
        packs = max(1, small.count() * 3 * COORDINATES // (2 * FRAME))
        packed = small.withColumn("pack", F.pmod(F.xxhash64("path"), F.lit(packs)))
        found.append(packed.groupBy("pack").applyInPandas(lambda frame: _edges(frame, percent), "a long, b long"))
        if large.isEmpty():
            break
        if depth == DEPTH:
            hubs = large.groupBy("path").agg(F.min("node").alias("a")).withColumnRenamed("path", "_path")
            found.append(large.join(hubs, F.col("path") == F.col("_path")).select("a", F.col("node").alias("b")).filter("a <> b"))
        else:
            children = staged(branch(large, percent).dropDuplicates(["path", "node"]), "children")
            level = released(staged(counted(children), "level"), children)
    edges = found[0]
    for more in found[1:]:
        edges = edges.unionByName(more)
    return released(staged(edges.distinct(), "edges"), *kept)


class _Union:
    """Components under growth; each has its number of members at its root."""

    def __init__(self, labels: np.ndarray):
        first: dict[int, int] = {}
        self.root = [first.setdefault(x, k) for k, x in enumerate(labels.tolist())]
        self.size = np.bincount(self.root, minlength=len(self.root)).tolist()
        self.left = len(first)

    def find(self, k: int) -> int:
        while self.root[k] != k:
            self.root[k] = k = self.root[self.root[k]]
        return k

    def join(self, a: int, b: int) -> None:
        a, b = self.find(a), self.find(b)
        if a != b:
            if self.size[a] < self.size[b]:
                a, b = b, a
            self.root[b] = a
            self.size[a] += self.size[b]
            self.left -= 1


def block_components(ids: np.ndarray, labels: np.ndarray, hub: np.ndarray, found: list[np.ndarray], percent: int) -> np.ndarray:
    """For each set of a block the smallest id (node) that it is joined to, by links inside the block or equal labels before.

    Common shingles of one set with all others are counted along posting lists, hubs first, then sets outside the largest
    component only: a link between two components has at least one end there.
    """
    lengths = np.array([len(x) for x in found])
    heads = np.cumsum(lengths) - lengths
    owner = np.repeat(np.arange(len(found)), lengths)
    _, number, times = np.unique(np.concatenate(found), return_inverse=True, return_counts=True)
    order = np.argsort(number, kind="stable")
    lists, starts = owner[order], np.cumsum(times) - times
    union = _Union(labels)
    for k in np.lexsort((ids, -lengths, ~hub)).tolist():
        if union.left == 1:
            break
        if not hub[k] and 2 * union.size[union.find(k)] > len(ids):
            continue
        own = number[heads[k]:heads[k] + lengths[k]]
        own = own[times[own] > 1]
        n = times[own]
        places = np.repeat(starts[own] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        common = np.bincount(lists[places], minlength=len(found))
        for other in np.flatnonzero(100 * common >= percent * (lengths + lengths[k] - common)).tolist():
            union.join(k, other)
    root = np.array([union.find(k) for k in range(len(ids))])
    least = np.full(len(ids), np.iinfo("int64").max)
    np.minimum.at(least, root, ids)
    return least[root]


def _settled(frame: pd.DataFrame, percent: int) -> pd.DataFrame:
    """(a, b): each node of the blocks in a frame with the smallest node that it is joined to."""
    out = []
    for _, part in frame.groupby("block", sort=False):
        part = part.drop_duplicates("node").sort_values("node")
        if len(part) > 1:
            ids = part["node"].to_numpy()
            least = block_components(ids, part["label"].to_numpy(), part["hub"].to_numpy(), [np.frombuffer(x, "uint64") for x in part["shingles"]], percent)
            out.append(pd.DataFrame({"a": ids[ids != least], "b": least[ids != least]}))
    return pd.concat(out) if out else pd.DataFrame({"a": [], "b": []}).astype("int64")


def _joined(placed: DataFrame, full: DataFrame, percent: int) -> DataFrame:
    """Edges that the blocks give: ``placed`` has block, pack, node, label, hub."""
    rows = placed.join(full.select(F.col("node").alias("_node"), "shingles"), F.col("node") == F.col("_node")).drop("_node")
    return rows.groupBy("pack").applyInPandas(lambda frame: _settled(frame, percent), "a long, b long")


def sieved(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """``rows`` without most of those whose (doc_id, tie) isn't in ``wanted``; no row that is wanted goes.

    One bit for each hash, in bitmaps of 4 KB that are broadcast: 16 MB at most, whatever the number of rows.
    """
    bits = min(max((SIEVE[0] * wanted.count()).bit_length(), 15), SIEVE[1])
    place = F.pmod(F.xxhash64("doc_id", "tie"), F.lit(1 << bits))
    held = wanted.select(place.alias("_place")).distinct()
    held = held.groupBy(F.shiftright("_place", 15).alias("_map")).agg(F.bitmap_construct_agg(F.col("_place").bitwiseAND(F.lit(32767))).alias("_bits"))
    inner = F.col("_place").bitwiseAND(F.lit(32767))
    byte = F.conv(F.hex(F.expr("substring(_bits, cast((_place & 32767) >> 3 as int) + 1, 1)")), 16, 10).cast("int")
    found = rows.withColumn("_place", place).join(F.broadcast(held), F.shiftright("_place", 15) == F.col("_map"))
    return found.filter(F.getbit(byte, (inner.bitwiseAND(F.lit(7))).cast("int")) == 1).select(*rows.columns)


def full_sets(documents: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """(node, shingles) of the nodes in ``wanted`` (node, doc_id, tie), from the rows that have their id and text."""
    by_row = wanted.select("node", F.col("doc_id").alias("_id"), F.col("tie").alias("_tie"))
    rows = sieved(documents.select("doc_id", "text", text_tie().alias("tie")), wanted)
    rows = rows.join(by_row, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("tie") == F.col("_tie"))).select("node", "text")

    def run(batches):
        shingle = Shingler(size)
        for batch in parts(batches):
            found = [shingle(t.as_py()).tobytes() for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(found, pa.binary())], names=["node", "shingles"])

    return rows.mapInArrow(run, "node long, shingles binary").dropDuplicates(["node"])


def links(documents: DataFrame, nodes: DataFrame, size: int, percent: int) -> DataFrame:
    """(node, component) of the nodes that link with others; a component is named by its smallest node."""
    edges = candidates(nodes, percent)
    clusters = components(edges).select(F.col("node").alias("_node"), F.col("component").alias("cluster"))
    degree = edges.select(F.explode(F.array("a", "b")).alias("_end")).groupBy("_end").agg(F.count(F.lit(1)).alias("degree"))
    members = nodes.join(clusters, F.col("node") == F.col("_node")).join(degree, F.col("node") == F.col("_end"))
    members = released(staged(members.select("node", "cluster", "doc_id", "tie", "n_shingles", "degree"), "members"), edges)
    full = staged(full_sets(documents, members, size), "sets")

    shape = members.groupBy("cluster").agg(F.sum("n_shingles").alias("weight"), F.max(F.struct("degree", -F.col("node"))).alias("top"))
    shape = shape.select(F.col("cluster").alias("_cluster"), "weight", (-F.col("top.col2")).alias("top"), F.ceil(F.col("weight") / WEIGHT).cast("long").alias("blocks"))
    placed = members.join(shape, F.col("cluster") == F.col("_cluster"))
    part = F.pmod(F.xxhash64("node", F.lit(1)), F.col("blocks"))
    hub = F.col("node") == F.col("top")
    placed = placed.select("node", "cluster", "n_shingles", "weight", "blocks", hub.alias("hub"), F.explode(F.when(hub, F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).otherwise(F.array(part))).alias("part"))
    packs = max(1, (members.agg(F.sum("n_shingles").alias("n")).first().n or 0) // WEIGHT)
    pack = F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("cluster"), F.lit(packs))).otherwise(F.xxhash64("cluster", "part"))
    placed = staged(placed.select("node", "cluster", "hub", "part", "blocks", F.col("node").alias("label"), F.xxhash64("cluster", "part").alias("block"), pack.alias("pack")), "placed")
    first = staged(_joined(placed, full, percent), "joined")

    # Clusters of several blocks whose parts the hub has not joined: block against block, without what is joined already.
    spread = placed.filter((F.col("blocks") > 1) & (~F.col("hub") | (F.col("part") == 0)))
    if spread.isEmpty():
        return released(components(first), members, full, placed, first)
    known = components(first)
    names = known.select(F.col("node").alias("_node"), F.col("component").alias("_label"))
    spread = spread.join(names, F.col("node") == F.col("_node"), "left").select("node", "cluster", "hub", "part", "blocks", F.coalesce("_label", "node").alias("label"))
    spread = staged(spread, "spread")
    big = spread.groupBy("cluster", "label").agg(F.count(F.lit(1)).alias("n")).groupBy("cluster").agg(F.max(F.struct("n", "label")).alias("most"), F.count(F.lit(1)).alias("labels")).filter("labels > 1")
    big = big.select(F.col("cluster").alias("_cluster"), F.col("most.label").alias("main"))
    open_ = spread.join(big, F.col("cluster") == F.col("_cluster")).drop("_cluster")
    odd = F.col("label") != F.col("main")
    # Sets outside a cluster's main component, dealt into blocks of their own, meet all blocks of the cluster.
    share = open_.groupBy("cluster").agg(F.greatest(F.lit(1), F.ceil(F.max("blocks") * F.sum(odd.cast("long")) / F.count(F.lit(1)))).cast("long").alias("cuts")).withColumnRenamed("cluster", "_cluster")
    open_ = open_.join(share, F.col("cluster") == F.col("_cluster")).drop("_cluster")
    every = open_.select("node", "cluster", "label", F.col("part").alias("right"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("cuts") - 1)).alias("left"))
    cut = F.pmod(F.xxhash64("node", F.lit(2)), F.col("cuts"))
    alone = open_.filter(odd).select("node", "cluster", "label", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("right"), cut.alias("left"))
    tiles = every.unionByName(alone.select(every.columns)).withColumn("block", F.xxhash64("cluster", "left", "right"))
    tiles = tiles.select("node", "label", F.lit(False).alias("hub"), "block", F.col("block").alias("pack"))
    second = staged(_joined(tiles, full, percent), "joined")
    return released(components(first.unionByName(second)), members, full, placed, first, spread, second, known)


def grouped(documents: DataFrame, size: int, percent: int) -> DataFrame:
    """doc_id, tie, n_shingles, node (null without words), best (doc_id and tie of the row that stands for the group)."""
    found = staged(sets(documents, size), "sets")
    row = F.struct(F.col("doc_id").isNull().alias("lost"), "doc_id", "tie")
    nodes = found.filter(F.col("digest").isNotNull()).groupBy("digest").agg(F.min(row).alias("row"), F.first("n_shingles").alias("n_shingles"), F.first("heads").alias("heads"), F.first("brief").alias("brief"))
    nodes = staged(nodes.select("digest", "row.doc_id", "row.tie", "row", "n_shingles", "heads", "brief").withColumn("node", F.monotonically_increasing_id()), "nodes")
    joined = links(documents, nodes, size, percent).select(F.col("node").alias("_n"), "component")
    named = nodes.join(joined, F.col("node") == F.col("_n"), "left").select("digest", "node", "row", F.coalesce("component", "node").alias("group"))
    least = named.groupBy("group").agg(F.min("row").alias("best")).withColumnRenamed("group", "_group")
    named = named.join(least, F.col("group") == F.col("_group")).select(F.col("digest").alias("_digest"), "node", "best")
    rows = found.select("doc_id", "tie", "n_shingles", "digest").join(named, F.col("digest") == F.col("_digest"), "left").select("doc_id", "tie", "n_shingles", "node", "best")
    return released(staged(rows, "rows"), found, nodes)


def near_duplicates(documents: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept (doc_id = component_id) of each row of ``documents`` (doc_id, text)."""
    component = F.coalesce(F.col("best.doc_id").cast("long"), F.col("doc_id").cast("long"))
    return grouped(documents, size, percent).select("doc_id", "n_shingles", component.alias("component_id"), (F.col("doc_id") == component).alias("kept"))


def deduplicated(documents: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """``documents`` with one row of each group of near duplicates: one of the smallest id, null ids last. Rows without words
    stay, as nothing equals them."""
    own_id, own_tie, row_tie, place = fresh(documents, "_id", "_kept", "_tie", "_place")
    rows = grouped(documents, size, percent).filter(F.col("doc_id").eqNullSafe(F.col("best.doc_id")) & (F.col("tie") == F.col("best.tie")))
    chosen = staged(rows.select(F.col("doc_id").alias(own_id), F.col("tie").alias(own_tie)).distinct(), "kept")
    has_word = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    found = documents.filter(has_word).withColumn(row_tie, text_tie()).join(chosen, F.col("doc_id").eqNullSafe(F.col(own_id)) & (F.col(row_tie) == F.col(own_tie)))
    # Rows equal in id and text stand together after the join; the first of them stays.
    line = Window.partitionBy(F.col("doc_id"), F.col(row_tie)).orderBy(F.xxhash64(*[F.col(c) for c in documents.columns if c != "text"]))
    found = found.withColumn(place, F.row_number().over(line)).filter(F.col(place) == 1)
    return found.select(*documents.columns).unionByName(documents.filter(~has_word))
