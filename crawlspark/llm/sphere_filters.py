"""Near-duplicate embeddings by spherical-cap filters.

Filters are directions on the sphere; a vector belongs to each filter whose direction is within a cap of it (inner product
at least ``alpha``). Directions form a structured random product code: after a random rotation the space is cut in two
halves, each has its own list of random unit vectors, and each pair of them is a filter. A vector's filters are listed by
decoding: it takes the entries of the first list that can reach ``alpha`` at all, and for each the head of the sorted
second list, so the work goes with the number of filters found and not with their product. Vectors that share a filter
are compared in double precision. Similar vectors share about ``HITS`` filters at the threshold, more above it, so a pair
at the threshold is missed with probability about exp(-HITS). The caps shrink and the code grows with the number of
vectors, so that a filter holds about ``CAP`` of evenly spread vectors at every size.

A pair that meets in several filters counts in the first one only. Filters with many members are compared in tiles of
``TILE`` by ``TILE``, so none has to fit one task, and a tile returns sums and a component leader for each member, never
its pairs. Equal vectors are compared once and counted by their number.

Vectors that are null, zero, or hold null or non-finite components link with nothing. Vectors link with those of their own
length only; each length that two vectors have gets a code of its own, made in the tasks that meet it. Each different vector
is a node, so rows that share an id keep links of their own; a row without an id has no links. An empty table has an empty
result. Other columns, labels among them, are not looked at.
"""

from __future__ import annotations

from statistics import NormalDist

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlspark.llm.components import components
from crawlspark.llm.shared import staged

HITS, CAP, TILE, PACK = 18, 32, 256, 16
LEAST_SHARE, MOST_SHARE = 1e-9, 2e-3


class Code:
    """Filters for vectors of a length, for about ``n`` of them, and a threshold."""

    def __init__(self, dimension: int, n: int, cosine: float, seed: int = 1):
        rng, normal = np.random.default_rng(seed), NormalDist()
        share = min(MOST_SHARE, max(LEAST_SHARE, CAP / max(n, 1)))
        z = normal.inv_cdf(1 - share)
        again = 1 - normal.cdf((z - cosine * (z + 1 / z)) / (1 - cosine**2) ** 0.5)  # a pair at the threshold, the other one in
        self.entries = int(np.ceil((HITS / again / share) ** 0.5))
        self.fewest = int(HITS / again)
        self.rotation = np.linalg.qr(rng.standard_normal((dimension, dimension)))[0]
        self.half = dimension // 2
        self.lists = [self._units(rng, self.entries, self.half), self._units(rng, self.entries, dimension - self.half)]
        # The cap of this share of the filters, from the sums that random unit vectors have with them.
        sums = []
        for v in self._units(rng, 400, dimension):
            a, b = self.scores(v[None])
            sums.append(np.sort(self._top(a[0], b[0], int(4 * share * self.entries**2) + 8))[::-1])
        joined = np.sort(np.concatenate(sums))[::-1]
        self.least = float(joined[min(len(joined) - 1, int(share * self.entries**2 * len(sums)))])

    @staticmethod
    def _units(rng, n, d):
        v = rng.standard_normal((n, max(d, 1)))
        return v / np.linalg.norm(v, axis=1, keepdims=True)

    @staticmethod
    def _top(a, b, k):
        """The largest ``k`` sums of one entry of each list."""
        a, b = np.sort(a)[::-1], np.sort(b)[::-1]
        rows = [a[i] + b[:max(1, k // (i + 1))] for i in range(min(len(a), k))]
        return np.sort(np.concatenate(rows))[::-1][:k]

    def scores(self, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        v = v @ self.rotation
        first, second = v[:, :self.half], v[:, self.half:]
        return (first @ self.lists[0].T if self.half else np.zeros((len(v), self.entries))), second @ self.lists[1].T

    def decode(self, v: np.ndarray) -> list[np.ndarray]:
        """The filters of each unit vector, ascending; where the code is thin, the cap widens until ``fewest`` are in it."""
        out = []
        for a, b in zip(*self.scores(v), strict=True):
            order, least = np.argsort(-b), self.least
            falling = -b[order]
            while True:
                rows = np.flatnonzero(a + b[order[0]] >= least)
                ends = np.searchsorted(falling, a[rows] - least, side="right")
                if ends.sum() >= min(self.fewest, self.entries**2):
                    break
                least -= 0.05 * abs(self.least) + 1e-3
            out.append(np.sort(np.concatenate([i * self.entries + order[:e] for i, e in zip(rows, ends, strict=True)]).astype("int64")))
        return out


def vectors(df: DataFrame, key: str, column: str) -> DataFrame:
    """key, content: the vector's doubles as bytes, null where it can't link."""
    def run(batches):
        for rows in batches:
            content = []
            for value in rows.column(column):
                v = np.array([np.nan if x is None else x for x in value.as_py() or []], "float64")
                fine = len(v) and np.isfinite(v).all() and v.any()
                content.append(v.tobytes() if fine else None)
            yield pa.RecordBatch.from_arrays([rows.column(key), pa.array(content, pa.binary())], names=[key, "content"])

    return df.select(key, column).mapInArrow(run, f"{key} {df.schema[key].dataType.simpleString()}, content binary")


def units(content) -> np.ndarray:
    v = np.stack([np.frombuffer(c, "float64") for c in content])
    v = v / np.abs(v).max(1, keepdims=True)
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def _leaders(linked: np.ndarray) -> np.ndarray:
    labels = np.arange(len(linked))
    while True:
        new = np.minimum(labels, np.where(linked, labels[None, :], len(linked)).min(1))
        new = np.minimum(new, new[new])
        if (new == labels).all():
            return labels
        labels = new


def compare(frame: pd.DataFrame, cosine: float) -> pd.DataFrame:
    """node, links, leader of the members of each filter or tile in a frame."""
    out = []
    for (_, f, _, _), part in frame.groupby(["bytes", "filter", "low", "high"], sort=False):
        part = part.drop_duplicates("node").sort_values("node")
        if len(part) < 2:
            continue
        ids, v = part["node"].to_numpy(), units(part["content"])
        linked = v @ v.T >= cosine
        np.fill_diagonal(linked, False)
        side = part["side"].to_numpy()
        linked &= (side[:, None] != side[None, :]) | (side[:, None] == 2)
        some = linked.any(1)
        if not some.any():
            continue
        linked, ids, n = linked[some][:, some], ids[some], part["n"].to_numpy()[some]
        before = [x[x < f] for x in (np.frombuffer(b, "int64") for b in part["filters"].to_numpy()[some])]
        names, place = np.unique(np.concatenate(before), return_inverse=True)
        held = np.zeros((len(ids), len(names)), "float32")
        held[np.repeat(np.arange(len(ids)), [len(x) for x in before]), place] = 1
        linked &= held @ held.T == 0  # pairs that met in an earlier filter count there
        some = linked.any(1)
        out.append(pd.DataFrame({"node": ids[some], "links": (linked @ n)[some], "leader": ids[_leaders(linked)][some]}))
    return pd.concat(out) if out else pd.DataFrame({"node": [], "links": [], "leader": []}).astype("int64")


def links(df: DataFrame, key: str = "vec_id", column: str = "embedding", cosine: float = 0.9) -> DataFrame:
    """key, n_links, component_id, kept for each row of ``df``."""
    rows = staged(vectors(df, key, column).withColumn("digest", F.sha2("content", 256)), "vectors")
    usable = rows.filter(F.col("digest").isNotNull() & F.col(key).isNotNull())
    groups = usable.groupBy("digest", F.length("content").alias("bytes")).agg(F.min(key).cast("long").alias("least"), F.count(F.lit(1)).alias("n"))
    groups = staged(groups.withColumn("node", F.monotonically_increasing_id()), "groups")
    # One row for each length of vector that occurs more than once.
    lengths = {r["bytes"]: r["n"] for r in groups.groupBy("bytes").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").collect()}
    named = groups.select(F.col("digest").alias("_digest"), "bytes", "least", "node", "n")
    contents = usable.groupBy("digest").agg(F.min("content").alias("content"))
    nodes = contents.join(named.filter(F.col("bytes").isin(list(lengths))), F.col("digest") == F.col("_digest")).select("node", "n", "content")

    def decode(batches):
        codes = {}
        for batch in batches:
            content = batch.column("content").to_pylist()
            found = [None] * len(content)
            size = np.array([len(c) for c in content], "int64")
            for length in np.unique(size).tolist():
                if length not in codes:
                    codes[length] = Code(length // 8, lengths[length], cosine)
                at = np.flatnonzero(size == length).tolist()
                for k, x in zip(at, codes[length].decode(units([content[k] for k in at])), strict=True):
                    found[k] = x
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in ("node", "n", "content")] + [pa.array([x.tobytes() for x in found], pa.binary()), pa.array([x.tolist() for x in found], pa.list_(pa.int64()))],
                                             names=["node", "n", "content", "filters", "each"])

    decoded = staged(nodes.mapInArrow(decode, "node long, n long, content binary, filters binary, each array<long>"), "decoded")
    met = decoded.select("node", F.length("content").alias("bytes"), F.explode("each").alias("filter"))
    counts = met.groupBy(F.col("bytes").alias("_bytes"), F.col("filter").alias("_filter")).agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
    blocks = F.ceil(F.col("members") / TILE).cast("int")
    # A row here is a filter of a vector, but Spark sizes an exploded list by that of its vectors: hinted, or it would broadcast them.
    dealt = met.join(counts.hint("merge"), (F.col("filter") == F.col("_filter")) & (F.col("bytes") == F.col("_bytes"))).withColumn("blocks", blocks)
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("node", F.lit(1)), F.col("blocks")).cast("int"))
    tiled = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    low, high = F.least("block", "other"), F.greatest("block", "other")
    side = F.when(F.col("block") == F.col("other"), 2).when(F.col("block") < F.col("other"), 0).otherwise(1)
    pack = F.when(F.col("blocks") == 1, F.xxhash64("bytes", F.expr(f"filter div {PACK}"))).otherwise(F.xxhash64("bytes", "filter", low, high))
    placed = tiled.select("node", "bytes", "filter", low.alias("low"), high.alias("high"), side.alias("side"), pack.alias("pack"))
    content = decoded.select(F.col("node").alias("_node"), "n", "content", "filters").hint("merge")
    full = placed.join(content, F.col("node") == F.col("_node")).drop("_node")
    found = staged(full.groupBy("pack").applyInPandas(lambda frame: compare(frame, cosine), "node long, links long, leader long"), "links")

    sums = found.groupBy("node").agg(F.sum("links").alias("links")).withColumnRenamed("node", "_a")
    joined = components(found.select(F.col("node").alias("a"), F.col("leader").alias("b"))).withColumnRenamed("node", "_b")
    summed = named.join(sums, F.col("node") == F.col("_a"), "left").join(joined, F.col("node") == F.col("_b"), "left")
    summed = staged(summed.select("_digest", (F.coalesce("links", F.lit(0).cast("long")) + F.col("n") - 1).alias("n_links"), F.coalesce("component", "node").alias("_named"), "least"), "summed")
    least = summed.groupBy("_named").agg(F.min("least").alias("component_id")).withColumnRenamed("_named", "_component")
    summed = summed.join(least, F.col("_named") == F.col("_component")).select("_digest", "n_links", "component_id")
    out = rows.select(key, "digest").join(summed, (F.col("digest") == F.col("_digest")) & F.col(key).isNotNull(), "left")
    component = F.coalesce("component_id", F.col(key).cast("long"))
    return out.select(key, F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), component.alias("component_id"), F.coalesce(F.col(key) == component, F.lit(False)).alias("kept"))
