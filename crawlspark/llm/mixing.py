"""Mixing sources to target weights.

Each source's texts, in the order of their ids, are one stream of words, packed into blocks of ``BLOCK`` words (the last
may be shorter). Targets are words per source: shares of the total by weight, at most ``MOST`` times a source's size,
what is above reshared until nothing is. A target becomes a number of slots. Output shards draw how many of their slots
each source fills from a multinomial over what the sources have left, so shards differ by chance and totals stand. A
source's slot k takes block ``permute(k mod blocks)`` of pass ``k div blocks``, a keyed pseudorandom permutation of the
source's blocks for each pass, so no block comes a second time before all others came once, and none more than ``MOST``
times. Slots meet blocks in a join by (source, block).

Sources are rows like any other, whatever their number: targets come from a water level, found by a few sums over the
sources, and each shard's draw is made for ``GROUP`` sources at a time, neighbours in code point order, a group giving
every shard an equal part of its slots. Only sums go to the driver. Positions of texts in their source's stream are prefix sums over id ranges, so no source has to fit one task. Runs with
equal input and seed agree. Null sources are a source, the last; null and empty texts have size 0 and are never taken;
rows that share an id are ordered by a hash of their text, equal ones are interchangeable and numbered, each with a place
of its own in the stream. Null ids come first.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from crawlspark.llm.shared import fresh, released, staged, tasks
from crawlspark.operators.ids import with_rank

BLOCK = 32
MOST = 3
SHARDS = 64
GROUP = 4096
SLOT_RUN = 20_000


def size_of(text) -> F.Column:
    """Number of words, runs of anything but ASCII white space."""
    return F.when(text.isNull(), 0).otherwise(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+"))).cast("long")


def level(sources: DataFrame) -> float:
    """Words per unit of weight at which the sources' targets, none above its ``limit``, meet the total size.

    A source whose share is above its limit gives the excess back, which lifts the level for the others; the level only
    rises, so each round is one sum over the sources, and it ends when no further source reaches its limit.
    """
    total, found, before = None, 0.0, None
    while found != before:
        above = F.col("weight") * F.lit(found) > F.col("limit")
        sums = sources.agg(F.sum("source_size").alias("total"), F.sum(F.when(above, F.col("limit"))).alias("held"),
                           F.sum(F.when(~above, F.col("weight"))).alias("free")).first()
        total = float(sums.total or 0)
        if not sums.free:
            return float("inf") if total and sums.held else 0.0
        before, found = found, max(found, (total - (sums.held or 0.0)) / sums.free)
    return found


def draw(slots: np.ndarray, shards: int, seed: int, group: int = 0) -> np.ndarray:
    """Slots of each source (column) in each shard (row): multinomial draws over what is left, so that columns sum to ``slots``."""
    left, out = slots.astype("int64").copy(), np.zeros((shards, len(slots)), "int64")
    for k in range(shards):
        rng, want = np.random.default_rng([seed, group, k]), int(left.sum() // (shards - k))
        while want:
            got = np.minimum(rng.multinomial(want, left / left.sum()), left)
            out[k] += got
            left -= got
            want -= int(got.sum())
    return out


def permute(index: np.ndarray, size: np.ndarray, key: np.ndarray) -> np.ndarray:
    """A keyed permutation of 0 .. size - 1, row by row: a four-round Feistel network on the next even number of bits,
    repeated until the value is in range."""
    half = np.maximum(1, (np.ceil(np.log2(np.maximum(size, 2))).astype("int64") + 1) // 2).astype("uint64")
    mask = (np.uint64(1) << half) - np.uint64(1)
    value, limit, key = index.astype("uint64"), size.astype("uint64"), key.astype("uint64")
    todo = np.ones(len(value), bool)
    while todo.any():
        v, h, m, k = value[todo], half[todo], mask[todo], key[todo]
        left, right = v >> h, v & m
        for turn in range(4):
            mixed = (right + k + np.uint64(turn * 0x9E3779B97F4A7C15 % 2**64)) * np.uint64(0xBF58476D1CE4E5B9)
            mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
            left, right = right, left ^ ((mixed ^ (mixed >> np.uint64(32))) & m)
        value[todo] = left << h | right
        todo[todo] = value[todo] >= limit[todo]
    return value.astype("int64")


def positions(sizes: DataFrame) -> DataFrame:
    """``start``: words of the same source before each row, rows in order of id, a prefix sum over ranges of ids.
    ``copy`` numbers rows that are equal in id, text and source, from 1; a range holds all of them."""
    order = ["doc_id", "tie"]
    ranged = staged(sizes.repartitionByRange(tasks(sizes), *order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id()), "ranged", clean=True)
    # One row for each source and range: the sums before it.
    parts = ranged.groupBy("source", "part").agg(F.sum("size").alias("words"))
    before = parts.withColumn("before", F.sum("words").over(Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)))
    inner = Window.partitionBy("part", "source").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    equal = Window.partitionBy("part", "source", *order).orderBy("inside")
    # Rows of no words share their place; a tie in order is as good as any, as the rows are equal.
    local = ranged.withColumn("inside", F.coalesce(F.sum("size").over(inner), F.lit(0))).withColumn("copy", F.row_number().over(equal).cast("long"))
    joined = local.alias("l").join(before.alias("b"), (F.col("l.part") == F.col("b.part")) & F.col("l.source").eqNullSafe(F.col("b.source")))
    placed = joined.select("l.doc_id", "l.tie", "l.source", "l.copy", "l.size", (F.col("inside") + F.coalesce("before", F.lit(0))).alias("start"))
    return released(staged(placed, "placed", clean=True), ranged)


def plan(sizes: DataFrame, weights: dict | None = None, most: float = MOST) -> DataFrame:
    """One row per source: source, source_size, weight, target, blocks, slots and its rank from 0, by code point, null last.
    Weights default to 1, 2, 3, repeating; of ``weights`` given, sources it doesn't name weigh nothing."""
    found = staged(sizes.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn("_none", F.col("source").isNull()), "sources", clean=True)
    ranked = with_rank(found, ["_none", "source"]).withColumn("rank", F.col("rank") - 1).drop("_none")
    if weights is None:
        ranked = ranked.withColumn("weight", (1 + F.col("rank") % 3).cast("double"))
    else:
        given = sizes.sparkSession.createDataFrame([(s, float(w)) for s, w in weights.items()], "_named string, weight double")
        ranked = ranked.join(given, F.col("source").eqNullSafe(F.col("_named")), "left").drop("_named").fillna(0.0, ["weight"])
    ranked = staged(ranked.withColumn("limit", F.lit(float(most)) * F.col("source_size")), "ranked", clean=True)
    at = level(ranked)
    share = F.when(F.col("weight") == 0, 0.0).otherwise(F.col("weight") * F.lit(at))
    full = F.greatest("source_size", F.lit(1).cast("long"))
    goal = ranked.withColumns({"target": F.least(share, F.col("limit")), "blocks": F.expr(f"(source_size + {BLOCK - 1}) div {BLOCK}")})
    # Full passes, then blocks of the next one.
    goal = goal.withColumn("_whole", F.least(F.floor(F.col("target") / full + 1e-12).cast("double"), F.lit(float(most))))
    rest = F.rint((F.col("target") - F.col("_whole") * F.col("source_size")) * F.col("blocks") / full)
    slots = F.least(F.col("_whole") * F.col("blocks") + rest, F.lit(float(most)) * F.col("blocks")).cast("long")
    out = goal.withColumn("slots", slots).select("source", "source_size", "weight", "target", "blocks", "slots", "rank")
    return staged(out, "plan")


def _key(seed: int, source: str | None) -> int:
    return int.from_bytes(hashlib.blake2b(f"{seed} {source is None} {source or ''}".encode(), digest_size=7).digest(), "big")


def runs(sources: DataFrame, seed: int = 0, shards: int = SHARDS) -> DataFrame:
    """The draws: shard, source, first and n (its slots of the source, counted per source), blocks, key."""
    def drawn_of(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("rank")
        counts = draw(frame["slots"].to_numpy("int64"), shards, seed, int(frame["group"].iloc[0]))
        starts = np.cumsum(counts, 0) - counts
        shard, at = np.nonzero(counts)
        names = [None if pd.isna(s) else s for s in frame["source"]]
        keys = np.array([_key(seed, s) for s in names], "int64")
        return pd.DataFrame({"shard": shard.astype("int32"), "source": pd.Series([names[i] for i in at], dtype="object"), "first": starts[shard, at],
                             "n": counts[shard, at], "blocks": np.maximum(1, frame["blocks"].to_numpy("int64"))[at], "key": keys[at]})

    grouped = sources.select("source", "blocks", "slots", "rank", F.expr(f"rank div {GROUP}").alias("group")).groupBy("group")
    return grouped.applyInPandas(drawn_of, "shard int, source string, first long, n long, blocks long, key long")


def slots(sources: DataFrame, seed: int = 0, shards: int = SHARDS) -> DataFrame:
    """The mix: shard, source, slot (counted per source), pass, block."""
    drawn_runs = runs(sources, seed, shards)
    # A shard's share of a source is cut into runs first, and the runs are dealt out, so that no task makes all slots of a source.
    cut = drawn_runs.withColumn("at", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(SLOT_RUN).cast("long")))).repartition(tasks(sources), "shard", "source", "at")
    each = cut.select("shard", "source", "blocks", "key", F.explode(F.sequence(F.col("first") + F.col("at"), F.col("first") + F.least(F.col("at") + SLOT_RUN, F.col("n")) - 1)).alias("slot"))

    @F.pandas_udf("long")
    def block_of(slot: pd.Series, blocks: pd.Series, key: pd.Series) -> pd.Series:
        turn, index = np.divmod(slot.to_numpy(), blocks.to_numpy())
        return pd.Series(permute(index, blocks.to_numpy(), key.to_numpy().astype("uint64") + turn.astype("uint64") * np.uint64(0xD1B54A32D192ED03)))

    return each.select("shard", "source", "slot", F.expr("slot div blocks").cast("int").alias("pass"), block_of("slot", "blocks", "key").alias("block"))


def pieces(placed: DataFrame) -> DataFrame:
    """The words of each text that fall into each block of its source: doc_id, tie, source, copy, block, first (word in the text), words."""
    full = placed.filter(F.col("size") > 0)
    first, last = F.expr(f"start div {BLOCK}"), F.expr(f"(start + size - 1) div {BLOCK}")
    cut = full.withColumn("block", F.explode(F.sequence(first, last)))
    begin = F.greatest(F.col("block") * BLOCK - F.col("start"), F.lit(0).cast("long"))
    end = F.least((F.col("block") + 1) * BLOCK - F.col("start"), F.col("size"))
    return cut.select("doc_id", "tie", "source", "copy", "block", begin.alias("first"), (end - begin).alias("words"))


def drawn(placed: DataFrame, mix: DataFrame) -> DataFrame:
    """Pieces in the mix: each piece with the passes that take it."""
    taken = mix.groupBy("source", "block").agg(F.sort_array(F.collect_list("pass")).alias("passes"))  # MOST entries at most
    p, t = pieces(placed).alias("p"), taken.alias("t")
    return p.join(t, F.col("p.source").eqNullSafe(F.col("t.source")) & (F.col("p.block") == F.col("t.block"))).select("p.*", "t.passes")


def sizes(documents: DataFrame) -> DataFrame:
    text = F.col("text")
    return documents.select("doc_id", F.xxhash64("text").alias("tie"), F.col("source").cast("string").alias("source"), size_of(text).alias("size"))


def mix(documents: DataFrame, weights: dict | None = None, seed: int = 0, most: float = MOST) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(sources, texts placed in their source's stream, slots of the mix) of ``documents`` (doc_id, text, source)."""
    placed = positions(sizes(documents))
    sources = plan(placed, weights, most)
    # Written, so that Spark joins slots by their true size: what unfolds from a few rows looks small enough to broadcast.
    return sources, placed, staged(slots(sources, seed), "slots", clean=True)


def taken_words(documents: DataFrame, weights=None, seed: int = 0) -> DataFrame:
    """doc_id, source, size, source_size, target, taken: how much of each text the mix takes, repeats counted."""
    sources, placed, chosen = mix(documents, weights, seed)
    none = F.lit(0).cast("long")
    own = placed.select("doc_id", "tie", "source", "size", F.lit(1).cast("long").alias("rows"), none.alias("words"))
    took = drawn(placed, chosen).select("doc_id", "tie", "source", F.lit(None).cast("long").alias("size"), none.alias("rows"), (F.col("words") * F.size("passes")).alias("words"))
    sums = own.unionByName(took).groupBy("doc_id", "tie", "source").agg(F.max("size").alias("size"), F.sum("rows").alias("rows"), F.sum("words").alias("words"))
    # Rows that are equal in id, text and source share their words.
    each = sums.withColumn("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))))
    # Written rows, so Spark broadcasts the sources only where they are few.
    out = each.join(sources.select(F.col("source").alias("_source"), "source_size", "target"), F.col("source").eqNullSafe(F.col("_source")))
    share = F.expr("words div rows") + F.when(F.col("row") <= F.col("words") % F.col("rows"), 1).otherwise(0)
    return out.select("doc_id", "source", "size", "source_size", "target", share.cast("long").alias("taken"))


def mixed_documents(documents: DataFrame, weights=None, seed: int = 0) -> DataFrame:
    """The mix as rows of ``documents``: for each pass that takes words of a text, one row with those words.

    A text taken whole stays as it is; of others the taken runs of words stay, as they stand in the text, one run a line.
    ``n_chars`` is counted anew where the column exists.
    """
    _, placed, chosen = mix(documents, weights, seed)
    key = ["doc_id", "tie", "source", "copy"]
    taken = (drawn(placed, chosen).select(*key, "first", "words", F.explode("passes").alias("_pass"))
             .groupBy(*key, "_pass").agg(F.sort_array(F.collect_list(F.struct("first", "words"))).alias("_runs")))
    own_id, own_tie, own_source, own_copy, own_pass, own_runs, row_tie, row_copy = fresh(
        documents, "_id", "_tie", "_source", "_copy", "_pass", "_runs", "_row", "_number")
    taken = taken.toDF(own_id, own_tie, own_source, own_copy, own_pass, own_runs)
    rows = _numbered(documents, placed, row_tie, row_copy)
    joined = rows.join(taken, F.col("doc_id").eqNullSafe(F.col(own_id)) & (F.col(row_tie) == F.col(own_tie))
                       & F.col("source").cast("string").eqNullSafe(F.col(own_source)) & (F.col(row_copy) == F.col(own_copy)))

    @F.pandas_udf("string")
    def cut(text: pd.Series, chosen: pd.Series) -> pd.Series:
        return pd.Series([_cut(t, r) for t, r in zip(text, chosen, strict=True)], dtype="object")

    out = joined.withColumn("text", cut("text", F.to_json(own_runs)))
    if "n_chars" in documents.columns:
        out = out.withColumn("n_chars", F.length("text").cast(documents.schema["n_chars"].dataType))
    return out.select(*documents.columns)


def _numbered(documents: DataFrame, placed: DataFrame, tie: str, number: str) -> DataFrame:
    """``documents`` with the hash of the text and the number of each row among those equal to it in id, text and source.

    Only rows of ids, texts and sources that stand twice are brought together for that.
    """
    rows = documents.withColumn(tie, F.xxhash64("text"))
    twice = staged(placed.filter("copy = 2").select("doc_id", "tie", "source"), "twice", clean=True)
    if twice.isEmpty():
        return rows.withColumn(number, F.lit(1).cast("long"))
    same = (F.col("doc_id").eqNullSafe(F.col("_t_id")) & (F.col(tie) == F.col("_t_tie"))
            & F.col("source").cast("string").eqNullSafe(F.col("_t_source")))
    own_id, own_tie, own_source = fresh(rows, "_id", "_tie", "_source")
    twice = twice.toDF(own_id, own_tie, own_source)
    same = (F.col("doc_id").eqNullSafe(F.col(own_id)) & (F.col(tie) == F.col(own_tie))
            & F.col("source").cast("string").eqNullSafe(F.col(own_source)))
    others = [c for c, t in rows.dtypes if c not in ("text", tie) and "map<" not in t]
    order = Window.partitionBy("doc_id", tie, F.col("source").cast("string")).orderBy(F.xxhash64(*others))
    again = rows.join(twice, same, "left_semi").withColumn(number, F.row_number().over(order).cast("long"))
    return rows.join(twice, same, "left_anti").withColumn(number, F.lit(1).cast("long")).unionByName(again)


def _cut(text: str, runs: str) -> str:
    import json
    import re

    spans = [m.span() for m in re.finditer(r"[^\x20\x09-\x0D]+", text)]
    merged: list[list[int]] = []
    for run in json.loads(runs):
        begin, end = run["first"], run["first"] + run["words"]
        if merged and merged[-1][1] >= begin:
            merged[-1][1] = max(end, merged[-1][1])
        else:
            merged.append([begin, end])
    if merged == [[0, len(spans)]]:
        return text
    return "\n".join(text[spans[a][0]:spans[b - 1][1]] for a, b in merged)
