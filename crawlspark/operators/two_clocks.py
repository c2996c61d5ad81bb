"""The fetch schedule where a host and an address each have a clock, and a request takes both.

A request starts when it has arrived and both clocks are free, and keeps both for its delay. Hosts with several addresses
and addresses with several hosts couple the clocks, so no window over one key gives the starts.

* **Clocks that matter.** A host seen with one address only never is busier than that address, and an address of one host
  never is busier than a host with several; such clocks are left out, and what they were before the batch is a floor on
  the arrival. The clocks left over, joined by the requests that take two, form components that don't touch each other.
* **Maps.** On the free times of a component's clocks a request acts as a max-plus matrix: both its clocks become the
  larger of the two and of the arrival, plus the delay. Such matrices compose, so a component's line is cut into chunks at
  range partition borders, whose matrices (only clocks they touch; one constant a clock) are made in parallel.
* **Busy clocks.** A full matrix grows with the square of the clocks, so it has the busiest ones of a component only, at
  most ``BUSY``. The other clocks are rarely taken: what a chunk finds on them at its head is a constant, at first nothing,
  then what the chunk before made of it in the last round. Rounds go on while a first request of a chunk starts before such
  a clock is free. Starts only grow, towards the right ones, and are right once no clock is taken twice; each round settles
  one more chunk of a line at least, most often all that are left.
* **Tree.** Neighbouring chunks are composed pairwise up to the whole line, by joins and maxima over (component, block,
  from, to) rows. Then free times go down the tree: a block's left half starts with the block's times, its right half with
  what the left half makes of them. Depth is the logarithm of the number of chunks; no component is ever one group.
* **Starts.** Each chunk is walked once, from the free times at its head.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crawlspark.checkpoints import checkpointed
from crawlspark.operators import politeness, skew
from crawlspark.operators.graph import connected

CHUNK_ROWS = 100_000
BUSY, SHARE = 64, 16  # clocks of a component in its matrices: at most so many, each with 1 / SHARE of a chunk's rows at least
_CONSTANT = ""  # the source of a matrix entry that no clock feeds


def _floored(requests: DataFrame, free: DataFrame | None, key: str) -> DataFrame:
    """``_from`` not before the key's clock before the batch. A floor on all requests of a clock is the same as a start
    value of the clock, as its first request waits for it and the others wait for the first."""
    if free is None:
        return requests
    known = free.filter(F.col(key).isNotNull()).select(key, F.col("free_at").alias("_free"))
    return skew.lookup(requests, known, key).withColumn("_from", F.greatest("_from", F.coalesce("_free", "_from"))).drop("_free")


def _clocks(requests: DataFrame) -> DataFrame:
    """``_a`` and, for requests that take two clocks that matter, ``_b``."""
    pairs = checkpointed(requests.select("domain", "ip").distinct())
    addresses = pairs.groupBy("domain").agg(F.count(F.lit(1)).alias("_ips"))
    hosts = pairs.filter(F.col("ip").isNotNull()).groupBy("ip").agg(F.count(F.lit(1)).alias("_hosts"))
    pairs = pairs.join(addresses, "domain").join(hosts, "ip", "left")
    alone = F.col("_ips") == 1
    by_host = F.col("ip").isNull() | ~alone
    by_address = F.col("ip").isNotNull() & ((F.col("_hosts") > 1) | alone)
    host, address = F.concat(F.lit("h"), "domain"), F.concat(F.lit("a"), "ip")
    pairs = pairs.select(F.col("domain").alias("_d"), F.col("ip").alias("_i"), F.when(by_host, host).otherwise(address).alias("_a"), F.when(by_host & by_address, address).alias("_b"))
    pairs = checkpointed(pairs)
    parts = connected(pairs.filter(F.col("_b").isNotNull()).select(F.col("_a").alias("a"), F.col("_b").alias("b")))
    parts = parts.select(F.col("node").alias("_node"), "component")
    pairs = pairs.join(parts, F.col("_a") == F.col("_node"), "left").select("_d", "_i", "_a", "_b", F.coalesce("component", "_a").alias("_part"))
    return requests.join(pairs, (F.col("domain") == F.col("_d")) & F.col("ip").eqNullSafe(F.col("_i"))).drop("_d", "_i")


def _walk(a: list, b: list, at: list, delay: list, free: dict) -> list:
    """Starts of requests in order, from the free times at the head of the chunk."""
    out = []
    for one, two, start, wait in zip(a, b, at, delay, strict=True):
        start = max(start, free.get(one, start), free.get(two, start))
        out.append(start)
        free[one] = start + wait
        if two is not None:
            free[two] = start + wait
    return out


def _matrix(a: list, b: list, at: list, delay: list, rare: dict | None = None) -> list[tuple[str, str, object]]:
    """Entries (from, to, weight) of what a chunk does to its clocks. Rows that two clocks share are one table. The clocks
    in ``rare`` are no sources, but have the given time (None: unknown, thus no bound) at the head, and have no entries."""
    # clock: weights by source, what to add to them, constant
    rows: dict[str, tuple[dict, object, object]] = {clock: ({}, 0, least) for clock, least in (rare or {}).items()}
    for one, two, start, wait in zip(a, b, at, delay, strict=True):
        table, more, least = rows.get(one) or ({one: 0}, 0, None)
        if two is not None:
            other, extra, low = rows.get(two) or ({two: 0}, 0, None)
            if other is table:
                more = max(more, extra)
            else:
                if len(other) > len(table):
                    table, more, other, extra = other, extra, table, more
                table = dict(table)
                for source, weight in other.items():
                    weight += extra - more
                    if table.get(source, weight) <= weight:
                        table[source] = weight
            least = low if least is None else least if low is None else max(least, low)
        least = start if least is None else max(least, start)
        rows[one] = row = (table, more + wait, least + wait)
        if two is not None:
            rows[two] = row
    out = []
    for clock, (table, more, least) in rows.items():
        if rare and clock in rare:
            continue
        out.append((_CONSTANT, clock, least))
        out += [(source, clock, weight + more) for source, weight in table.items()]
    return out


_LINE = ("_a", "_b", "_from", "delay")
_BLOCK = ("part", "block")


def _spanning(ranged: DataFrame, spanning: DataFrame) -> DataFrame:
    """The rows of the chunks of components that several chunks share."""
    # At most two components of a chunk go on in another one, so this table is bounded by the number of chunks.
    return ranged.join(F.broadcast(spanning), ["_part", "_chunk"]).select("_part", "block", "arrival", "id", *_LINE)


def _lists(line) -> list[list]:
    line = line.sort_by([("arrival", "ascending"), ("id", "ascending")])
    return [line.column(c).to_pylist() for c in _LINE]


def _dictionary(table, key: str, value: str) -> dict:
    return dict(zip(table.column(key).to_pylist(), table.column(value).to_pylist(), strict=True))


def _matrices(rows: DataFrame, rare: DataFrame, number: str) -> DataFrame:
    """(part, block, src, dst, w) of each chunk; ``rare`` has its clocks that are rarely taken (part, block, clock, free)."""
    def run(key, line, known):
        import pyarrow as pa

        found = _matrix(*_lists(line), _dictionary(known, "clock", "free")) if line.num_rows else []
        src, dst, w = zip(*found, strict=True) if found else ((), (), ())
        return pa.table({"part": pa.array([key[0].as_py()] * len(src), pa.string()), "block": pa.array([key[1].as_py()] * len(src), pa.int64()), "src": pa.array(src, pa.string()),
                         "dst": pa.array(dst, pa.string()), "w": pa.array(w, pa.int64() if number == "long" else pa.float64())})

    return rows.groupBy("_part", "block").cogroup(rare.groupBy(*_BLOCK)).applyInArrow(run, f"part string, block long, src string, dst string, w {number}")


def _left(rows: DataFrame, rare: DataFrame, times: DataFrame, number: str) -> DataFrame:
    """(part, block, clock, first, free) of the rare clocks of each chunk: the first start on one, and when it is free."""
    known = rare.select(*_BLOCK, "clock", "free", F.lit(True).alias("rare")).unionByName(times.select(*_BLOCK, "clock", "free", F.lit(False).alias("rare")))

    def run(key, line, known):
        import pyarrow as pa

        lists, first = _lists(line), {}
        free = {c: t for c, t in _dictionary(known, "clock", "free").items() if t is not None}
        for one, two, start in zip(*lists[:2], _walk(*lists, free), strict=True):
            first.setdefault(one, start)
            if two is not None:
                first.setdefault(two, start)
        clocks = [c for c, own in _dictionary(known, "clock", "rare").items() if own]
        kind = pa.int64() if number == "long" else pa.float64()
        return pa.table({"part": pa.array([key[0].as_py()] * len(clocks), pa.string()), "block": pa.array([key[1].as_py()] * len(clocks), pa.int64()), "clock": pa.array(clocks, pa.string()),
                         "first": pa.array([first[c] for c in clocks], kind), "free": pa.array([free[c] for c in clocks], kind)})

    return rows.groupBy("_part", "block").cogroup(known.groupBy(*_BLOCK)).applyInArrow(run, f"part string, block long, clock string, first {number}, free {number}")


def _rare(rows: DataFrame, number: str) -> DataFrame:
    """(part, block, clock, free) of the clocks that are not among a component's busiest, free unknown."""
    taken = rows.select("_part", "block", F.explode(F.array("_a", "_b")).alias("clock")).filter("clock IS NOT NULL")
    taken = checkpointed(taken.groupBy(F.col("_part").alias("part"), "block", "clock").agg(F.count(F.lit(1)).alias("n")))
    size = rows.groupBy(F.col("_part").alias("part")).agg((F.count(F.lit(1)) / (SHARE * F.countDistinct("block"))).alias("least"))
    clocks = taken.groupBy("part", "clock").agg(F.sum("n").alias("n")).join(size, "part").filter("n >= least")
    busiest = clocks.withColumn("place", F.row_number().over(Window.partitionBy("part").orderBy(F.desc("n"), "clock"))).filter(F.col("place") <= BUSY)
    return taken.join(busiest, ["part", "clock"], "left_anti").select(*_BLOCK, "clock", F.lit(None).cast(number).alias("free"))


def _parents(rows: DataFrame, even: bool) -> DataFrame:
    return rows.filter((F.col("block") % 2 == 0) == F.lit(even)).withColumn("block", F.shiftright("block", 1))


def _touched(rows: DataFrame, name: str) -> DataFrame:
    return rows.select(*_BLOCK, F.col("dst").alias(name)).distinct()


def _composed(rows: DataFrame) -> DataFrame:
    """Matrices of pairs of neighbouring blocks: first the left one, then the right one."""
    left, right = _parents(rows, True), _parents(rows, False)
    through = left.select(*_BLOCK, F.col("src").alias("_src"), F.col("dst").alias("src"), F.col("w").alias("_w"))
    fed = right.join(through, [*_BLOCK, "src"], "left").select(
        *_BLOCK, F.coalesce("_src", "src").alias("src"), "dst", (F.col("w") + F.coalesce("_w", F.lit(0))).alias("w"))
    kept = left.join(_touched(right, "dst"), [*_BLOCK, "dst"], "left_anti").select(fed.columns)
    return fed.unionByName(kept).groupBy(*_BLOCK, "src", "dst").agg(F.max("w").alias("w"))


def _descended(times: DataFrame, rows: DataFrame) -> DataFrame:
    """(part, block, clock, free) at the head of each block of a level, from those of the level above.

    A block gets the clocks that it touches and that are known at its head."""
    left = _parents(rows, True)
    sources = times.select(*_BLOCK, F.col("clock").alias("src"), "free")
    after = left.join(sources, [*_BLOCK, "src"]).select(*_BLOCK, F.col("dst").alias("clock"), (F.col("w") + F.col("free")).alias("free"))
    after = after.unionByName(left.filter(F.col("src") == _CONSTANT).select(*_BLOCK, F.col("dst").alias("clock"), F.col("w").alias("free")))
    after = after.unionByName(times.join(_touched(left, "clock"), [*_BLOCK, "clock"], "left_anti").select(after.columns))
    after = after.groupBy(*_BLOCK, "clock").agg(F.max("free").alias("free"))
    heads = times.withColumn("block", F.col("block") * 2).unionByName(after.withColumn("block", F.col("block") * 2 + 1))
    return heads.join(_touched(rows, "clock"), [*_BLOCK, "clock"], "left_semi")


def _heads(ranged: DataFrame, sizes: DataFrame, number: str) -> DataFrame:
    """(_chunk, clock, free): the free times at the head of each chunk that starts inside a component's line."""
    line = Window.partitionBy("_part").orderBy("_chunk")
    blocks = sizes.withColumns({"block": (F.row_number().over(line) - 1).cast("long"), "blocks": F.count(F.lit(1)).over(Window.partitionBy("_part"))})
    blocks = checkpointed(blocks.filter("blocks > 1"))
    most = blocks.agg(F.max("blocks").alias("n")).first().n
    times = ranged.sparkSession.createDataFrame([], f"part string, block long, clock string, free {number}")
    if most is None:  # no line is cut
        return times.select(F.col("block").alias("_head"), "clock", "free")
    rows = checkpointed(_spanning(ranged, blocks.select("_part", "_chunk", "block")))
    rare = checkpointed(_rare(rows, number))
    some = not rare.isEmpty()
    before = Window.partitionBy("part", "clock").orderBy("block")
    while True:
        levels = [checkpointed(_matrices(rows, rare, number))]
        while 1 << len(levels) < most:
            levels.append(checkpointed(_composed(levels[-1])))
        found = times
        for level in reversed(levels):
            found = checkpointed(_descended(found, level))
        if not some:
            break
        left = checkpointed(_left(rows, rare, found, number).withColumn("before", F.lag("free").over(before)))
        if left.filter("before > first").isEmpty():
            break
        rare = left.select(*_BLOCK, "clock", F.col("before").alias("free"))
    found = found.unionByName(rare.filter("free IS NOT NULL"))
    named = blocks.select(F.col("_part").alias("part"), "block", "_chunk")
    return found.join(named, [*_BLOCK]).select(F.col("_chunk").alias("_head"), "clock", "free")


def _numeric(requests: DataFrame) -> str:
    whole = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
    return "long" if all(isinstance(requests.schema[c].dataType, whole) for c in ("arrival", "delay")) else "double"


def schedule(requests: DataFrame, domain_free: DataFrame | None = None, ip_free: DataFrame | None = None, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Add ``start`` to each request (id, domain, ip, arrival, delay), as if each was taken in the order of arrival and id.

    ``ip`` is null for hosts without an address. ``domain_free`` (domain, free_at) and ``ip_free`` (ip, free_at) are the
    clocks before the batch; :func:`free_times` gives those after it. Further columns are kept.
    """
    number = _numeric(requests)
    columns = requests.columns
    rows = requests.withColumns({"arrival": F.col("arrival").cast(number), "delay": F.col("delay").cast(number)}).withColumn("_from", F.col("arrival"))
    rows = _floored(_floored(rows, domain_free, "domain"), ip_free, "ip")
    rows = checkpointed(_clocks(rows))
    order = ["_part", "arrival", "id"]
    chunks = max(1, -(-rows.count() // chunk_rows))
    # Written once, so that a partition number names the same rows on every read.
    ranged = checkpointed(rows.repartitionByRange(chunks, *order).withColumn("_chunk", F.spark_partition_id()))
    sizes = ranged.groupBy("_part", "_chunk").agg(F.count(F.lit(1)).alias("n"))
    heads = _heads(ranged, sizes, number)

    def run(line, known):
        import pyarrow as pa

        line = line.sort_by([(c, "ascending") for c in order])
        free = dict(zip(known.column("clock").to_pylist(), known.column("free").to_pylist(), strict=True))
        starts = _walk(*(line.column(c).to_pylist() for c in _LINE), free)
        return line.select(columns).append_column("start", pa.array(starts, pa.int64() if number == "long" else pa.float64()))

    schema = T.StructType([*ranged.select(*columns).schema.fields, T.StructField("start", T.LongType() if number == "long" else T.DoubleType())])
    return ranged.groupBy("_chunk").cogroup(heads.groupBy("_head")).applyInArrow(run, schema)


def free_times(scheduled: DataFrame, domain_free: DataFrame | None = None, ip_free: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(domain, free_at) and (ip, free_at) after the batch."""
    addressed = scheduled.filter(F.col("ip").isNotNull())
    return politeness.next_available(scheduled, "domain", domain_free), politeness.next_available(addressed, "ip", ip_free)
