"""Politeness over the event stream, with users as hosts."""

from __future__ import annotations

from pyspark.sql import functions as F

from crawlspark.operators import politeness, two_clocks


def _before(t):
    """When some hosts become free, from the requests themselves."""
    return t.fx_requests.filter("host % 3 = 0").groupBy("host").agg((F.min("arrival") + 3600).alias("free_at"))


def _scheduled(t):
    return politeness.schedule(t.fx_requests, _before(t))


def _waits(t):
    requests = t.fx_requests.select("id", F.col("host").cast("string").alias("domain"), (F.col("host") % 7).cast("string").alias("ip"),
                                    F.col("arrival").alias("now"))
    by_domain = requests.filter("id % 50 = 0").groupBy("domain").agg(F.max("now").alias("free_at"))
    by_ip = requests.filter("id % 30 = 0").groupBy("ip").agg((F.min("now") + 5000).alias("free_at"))
    return politeness.wait_times(requests, by_domain, by_ip).select("id", "wait")


def _two_clocks(t):
    domains = t.fx_shared_requests.filter("id % 40 = 0").groupBy("domain").agg((F.min("arrival") + 300).alias("free_at"))
    addresses = t.fx_shared_requests.filter("id % 25 = 0 AND ip IS NOT NULL").groupBy("ip").agg((F.min("arrival") + 900).alias("free_at"))
    done = two_clocks.schedule(t.fx_shared_requests, domains, addresses, chunk_rows=5_000)
    return done.select("id", "domain", "ip", "start")


QUERIES = {
    "schedule_two_clocks": _two_clocks,
    "wait_times": _waits,
    "fetch_schedule": lambda t: _scheduled(t).select("id", "host", "start"),
    # The same schedule with the clocks cut into chunks, as a host with very many requests needs it.
    "fetch_schedule_chunked": lambda t: politeness.schedule(t.fx_requests, _before(t), max_clock_rows=50).select("id", "host", "start"),
    "next_available": lambda t: politeness.next_available(_scheduled(t), before=_before(t)),
    "required_delays": lambda t: t.fx_requests.select("id", politeness.required_delay(F.when(F.col("id") % 3 > 0, F.col("delay"))).alias("delay")),
    "clock_keys": lambda t: t.fx_fetches.select("seq", politeness.clock_key(F.col("ip"), F.split_part("requested_url", F.lit("/"), F.lit(3))).alias("clock")),
}

_BEFORE = "SELECT host, min(arrival) + 3600 AS free_at FROM fx_requests WHERE host % 3 = 0 GROUP BY host"
# start is the largest, over the requests so far, of its arrival plus the delays from there to here.
_STARTS = f"""SELECT id, host, delay, before + max(floor_at - before) OVER (PARTITION BY host ORDER BY arrival, id) AS start
    FROM (SELECT r.*, greatest(arrival, coalesce(free_at, arrival)) AS floor_at,
      coalesce(sum(delay) OVER (PARTITION BY r.host ORDER BY arrival, id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
      FROM fx_requests r LEFT JOIN ({_BEFORE}) AS b ON b.host = r.host) AS w"""
_SCHEDULE = f"SELECT id, host, CAST(start AS BIGINT) AS start FROM ({_STARTS}) AS s"



def starts_sql(requests: str, columns: str) -> str:
    """Text that schedules ``requests`` (id, domain, ip, arrival, delay, floor_at): starts grow along the two lines of each
    request, of its host and of its address, until none has to wait longer."""
    return f"""rq AS ({requests}),
    rq_next AS (SELECT lag(id) OVER (PARTITION BY domain ORDER BY arrival, id) AS pred, id, delay FROM rq
      UNION SELECT lag(id) OVER (PARTITION BY ip ORDER BY arrival, id), id, delay FROM rq WHERE ip IS NOT NULL),
    rq_start(id, start, delay) USING KEY (id) AS (SELECT id, floor_at, delay FROM rq
      UNION SELECT n.id, max(w.start + w.delay) AS start, n.delay FROM rq_start AS w JOIN rq_next AS n ON n.pred = w.id JOIN recurring.rq_start AS o ON o.id = n.id
      WHERE w.start + w.delay > o.start GROUP BY n.id, n.delay)
    SELECT {columns} FROM rq JOIN rq_start ON rq_start.id = rq.id"""


ORACLES = {
    "schedule_two_clocks": "WITH RECURSIVE " + starts_sql("""SELECT q.*, greatest(arrival, coalesce(d.free_at, arrival), coalesce(i.free_at, arrival)) AS floor_at FROM fx_shared_requests q
        LEFT JOIN (SELECT domain, min(arrival) + 300 AS free_at FROM fx_shared_requests WHERE id % 40 = 0 GROUP BY domain) AS d ON d.domain = q.domain
        LEFT JOIN (SELECT ip, min(arrival) + 900 AS free_at FROM fx_shared_requests WHERE id % 25 = 0 AND ip IS NOT NULL GROUP BY ip) AS i ON i.ip = q.ip""",
        "rq.id, domain, ip, CAST(start AS BIGINT) AS start"),
    "wait_times": """SELECT r.id, greatest(coalesce(d.free_at - r.arrival, 0), coalesce(i.free_at - r.arrival, 0), 0) AS wait FROM fx_requests r
        LEFT JOIN (SELECT host, max(arrival) AS free_at FROM fx_requests WHERE id % 50 = 0 GROUP BY host) AS d ON d.host = r.host
        LEFT JOIN (SELECT host % 7 AS ip, min(arrival) + 5000 AS free_at FROM fx_requests WHERE id % 30 = 0 GROUP BY 1) AS i ON i.ip = r.host % 7""",
    "fetch_schedule": _SCHEDULE,
    "fetch_schedule_chunked": _SCHEDULE,
    "next_available": f"""SELECT host, CAST(max(free_at) AS BIGINT) AS free_at FROM (SELECT host, start + delay AS free_at FROM ({_STARTS}) AS s
        UNION ALL {_BEFORE}) AS a GROUP BY host""",
    "required_delays": "SELECT id, CASE WHEN id % 3 > 0 THEN delay ELSE 5 END AS delay FROM fx_requests",
    "clock_keys": "SELECT seq, coalesce(ip, split_part(requested_url, '/', 3)) AS clock FROM fx_fetches",
}
