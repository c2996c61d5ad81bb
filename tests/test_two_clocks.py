import random

import pytest
from pyspark.sql import functions as F

from crawlspark.operators import graph, two_clocks

SCHEMA = "id long, domain string, ip string, arrival long, delay long, note string"


def loop(rows, domains, addresses):
    """One request after the other, as a crawler takes them."""
    domains, addresses, out = dict(domains), dict(addresses), {}
    for number, domain, ip, arrival, delay, _ in sorted(rows, key=lambda r: (r[3], r[0])):
        start = max(arrival, domains.get(domain, arrival), addresses.get(ip, arrival) if ip else arrival)
        out[number] = start
        domains[domain] = start + delay
        if ip:
            addresses[ip] = start + delay
    return out, domains, addresses


def made(seed, n, hosts, ips, spread):
    rng = random.Random(seed)
    own = {d: rng.sample(range(ips), rng.choice([1, 1, 2, 3])) for d in range(hosts)}
    rows = []
    for k in range(n):
        d = min(rng.randrange(hosts), rng.randrange(hosts))
        ip = rng.choice(own[d])
        rows.append((k, f"d{d}", None if rng.random() < 0.1 else f"i{ip}", rng.randrange(spread), rng.randint(0, 9), f"n{k}"))
    return rows


@pytest.mark.parametrize("seed,n,hosts,ips,spread,chunk", [(1, 300, 12, 9, 200, 20), (2, 400, 40, 40, 4000, 15), (3, 250, 3, 2, 10, 11), (4, 120, 60, 60, 300, 1000), (5, 200, 1, 3, 50, 9)])
def test_equals_a_sequential_loop(spark, seed, n, hosts, ips, spread, chunk):
    rows = made(seed, n, hosts, ips, spread)
    domains, addresses = {"d0": 33, "d1": 500, "gone": 7}, {"i0": 90, "i1": 12, "lost": 3}
    requests = spark.createDataFrame(rows, SCHEMA)
    before = (spark.createDataFrame(list(domains.items()), "domain string, free_at long"), spark.createDataFrame(list(addresses.items()), "ip string, free_at long"))
    done = two_clocks.schedule(requests, *before, chunk_rows=chunk).cache()
    starts, domains, addresses = loop(rows, domains, addresses)
    got = done.collect()
    assert done.columns == [*requests.columns, "start"]
    assert {r.id: r.start for r in got} == starts and len(got) == len(rows)
    assert all(r.note == f"n{r.id}" for r in got)
    d, i = two_clocks.free_times(done, *before)
    assert {r.domain: r.free_at for r in d.collect()} == domains
    assert {r.ip: r.free_at for r in i.collect()} == addresses


def test_odd_batches(spark):
    assert two_clocks.schedule(spark.createDataFrame([], SCHEMA)).collect() == []
    one = spark.createDataFrame([(1, "a", None, 5, 2, None)], SCHEMA)
    assert [r.start for r in two_clocks.schedule(one).collect()] == [5]
    fractions = one.withColumn("delay", F.lit(0.5)).unionByName(one.withColumns({"id": F.lit(2), "delay": F.lit(0.25)}))
    assert sorted(r.start for r in two_clocks.schedule(fractions).collect()) == [5.0, 5.5]


def test_matrix_of_a_chunk_acts_like_the_chunk():
    rng = random.Random(8)
    for _ in range(60):
        n = rng.randint(1, 25)
        a, b = [f"h{rng.randrange(4)}" for _ in range(n)], [rng.choice([None, f"a{rng.randrange(4)}"]) for _ in range(n)]
        at, delay = sorted(rng.randrange(40) for _ in range(n)), [rng.randint(0, 9) for _ in range(n)]
        free = {c: rng.randrange(80) for c in {*a, *b} - {None}}
        after = {}
        for source, clock, weight in two_clocks._matrix(a, b, at, delay):
            after[clock] = max(after.get(clock, weight), weight + (free[source] if source else 0))
        two_clocks._walk(a, b, at, delay, free)
        assert after == free


def test_no_component_is_one_group(spark):
    """Hosts that share all addresses form one component; its chunks stay near the size asked for."""
    rows = made(6, 2000, 5, 3, 100)
    seen = []
    plain = two_clocks._heads

    def look(ranged, sizes, number):
        seen.extend(sizes.collect())
        return plain(ranged, sizes, number)

    two_clocks._heads = look
    try:
        done = two_clocks.schedule(spark.createDataFrame(rows, SCHEMA), chunk_rows=100)
        assert {r.id: r.start for r in done.collect()} == loop(rows, {}, {})[0]
    finally:
        two_clocks._heads = plain
    assert len({r["_part"] for r in seen}) == 1 and max(r.n for r in seen) < 400


@pytest.mark.parametrize("busy,spread", [(8, 200), (0, 4000)])
def test_matrices_hold_busy_clocks_only(spark, monkeypatch, busy, spread):
    """Many hosts on few addresses: entries of a chunk don't grow with the square of its hosts, and starts stay right."""
    rows = made(12, 600, 60, 3, spread)
    domains, addresses = {"d0": 33, "d7": 900}, {"i0": 90}
    before = (spark.createDataFrame(list(domains.items()), "domain string, free_at long"), spark.createDataFrame(list(addresses.items()), "ip string, free_at long"))
    monkeypatch.setattr(two_clocks, "BUSY", busy, raising=False)
    plain, most = two_clocks._matrices, []

    def look(*args):
        found = plain(*args)
        most.append(max((r["count"] for r in found.groupBy("part", "block").count().collect()), default=0))
        return found

    monkeypatch.setattr(two_clocks, "_matrices", look)
    done = two_clocks.schedule(spark.createDataFrame(rows, SCHEMA), *before, chunk_rows=150)
    assert {r.id: r.start for r in done.collect()} == loop(rows, domains, addresses)[0]
    assert max(most) <= (busy + 1) * busy


def test_components(spark):
    rng = random.Random(3)
    edges = [(f"n{k}", f"n{k + 1}") for k in range(40)] + [(f"m{rng.randrange(30)}", f"m{rng.randrange(30)}") for _ in range(25)] + [("x", "x2"), ("x", "x2")]
    parent = {v: v for e in edges for v in e if e[0] != e[1]}
    for _ in range(len(parent)):
        for a, b in edges:
            if a != b:
                parent[a] = parent[b] = min(parent[a], parent[b])
    got = {r.node: r.component for r in graph.connected(spark.createDataFrame(edges, "a string, b string")).collect()}
    assert set(got) == set(parent)
    assert all((got[a] == got[b]) == (parent[a] == parent[b]) for a in got for b in got)
    assert all(got[c] == c for c in got.values())
