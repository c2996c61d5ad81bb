"""Lexical search, collocations and compression bands, against plain versions of themselves."""

import base64
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from crawlspark.llm import compression_bands, impact_ranges, tiled_phrases
from crawlspark.llm.shared import small_batches

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, rank int, term string, block long"
LONG = "alpha beta gamma. " * 4000


def lower(text):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")


def table(spark, rows):
    return spark.createDataFrame([(i, t, lang, "s", 1, 0.5, 3, "x", 9) for i, t, lang in rows], SCHEMA)


@pytest.fixture(scope="module")
def documents(spark):
    rng = random.Random(11)
    words = ["".join(rng.choice(["ta", "mo", "Re", "li", "é", "7", "-", "sk"]) for _ in range(rng.randint(1, 3))) for _ in range(60)]
    weights = [1 / (k + 1) for k in range(len(words))]
    rows = []
    for k in range(150):
        text = "".join(w + rng.choice([" ", " ", " ", "\t", ", ", ".\n", "  ", "\r\n"]) for w in rng.choices(words, weights, k=rng.randint(1, 120)))
        rows.append((k * 2, text, rng.choice(["en", "fr", None])))
    rows += [rows[3], rows[3], (7, rows[3][1], "en"), (8, None, "en"), (9, "", None), (10, " .,\n", "zz"), (None, "Taréli mo nobody's id", "en"), (None, rows[5][1], "fr"), (11, LONG, "la"), (11, LONG, "la"), (12, "x" * 300_000, "la"),
             (13, "a\x00b \x7f c😀d É", "en")]
    rows += [(1000 + k, "one hot text of ten words stands here many times", "en") for k in range(200)]
    rng.shuffle(rows)
    return rows


def plain_terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower(text))


def plain_search(rows, items, k):
    found = [(i, Counter(plain_terms(t))) for i, t, _ in rows]
    found = [(i, c, sum(c.values())) for i, c in found if c]
    n, total, df = len(found), sum(x[2] for x in found), Counter(w for x in found for w in x[1])
    out = []
    for item, text in items:
        asked = set(plain_terms(text))
        scored = []
        for doc, c, size in found:
            m = 100 - 50 + (50 * size * n) // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[w] + 1))) * (1_000_000_000 * c[w] // (1000 * c[w] + 20 * m)) for w in asked if w in c)
            if score > 0:
                scored.append((-score, doc is None, doc, score))
        out += [(item, r, x[2], x[3]) for r, x in enumerate(sorted(scored, key=lambda x: x[:2] + (x[2] or 0,))[:k], 1)]
    return out


ITEMS = [(1, "tamo li TA é skré"), (2, None), (3, ""), (4, "nowhere-to be found zzz"), (5, "one hot text"), (5, "alpha"), (None, "ta mo"), (6, "ta " * 50 + "mo 7 sk li é one")]


@pytest.mark.parametrize("size", [1, 200, 1 << 19])
def test_search_equals_brute_force(spark, documents, size, monkeypatch):
    monkeypatch.setattr(impact_ranges, "TOKENS", size)
    items = spark.createDataFrame([(i, t, "e") for i, t in ITEMS], "item_id long, text string, score string")
    for k in (1, 7, 50):
        got = impact_ranges.search(table(spark, documents).repartition(3), items, k).collect()
        key = lambda r: (r[0] is not None, r[0] or 0, r[1], r[3])
        assert sorted(map(tuple, got), key=key) == sorted(plain_search(documents, ITEMS, k), key=key)


def group_mb(found):
    """MB of the largest row group of a staged frame, and its rows."""
    files = [r.f for r in found.sparkSession.read.parquet(found.staged_in).selectExpr("_metadata.file_path AS f").distinct().collect()]
    read = [pq.ParquetFile(f.split(":", 1)[-1]).metadata for f in files]
    return max(m.row_group(k).total_byte_size for m in read for k in range(m.num_row_groups)) / 1e6, found.count()


def wide(spark, rows=40, words=30_000):
    """Texts of words of their own, in one partition, and the words."""
    texts = [(k, " ".join(f"{n:x}" for n in np.random.default_rng(k).integers(1 << 40, 1 << 44, words)), "en") for k in range(rows)]
    return table(spark, texts).coalesce(1)


def test_index_is_read_in_a_few_blocks(spark, monkeypatch):
    monkeypatch.setattr(impact_ranges, "TOKENS", 30_000)
    most, rows = group_mb(impact_ranges.index(wide(spark)))
    assert rows == 40 and most < 10  # else a reader decodes all blocks of a file at once


def test_python_gets_small_batches(spark):
    rows = spark.range(48, numPartitions=1).selectExpr("id", "sequence(id, id + 262143) AS many")  # 2 MB each

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"rows": pa.array([b.num_rows]), "bytes": pa.array([b.nbytes])})

    before = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")
    with small_batches(spark):
        got = rows.mapInArrow(sizes, "rows long, bytes long").collect()
    assert sum(r.rows for r in got) == 48 and max(r.bytes for r in got) < 16e6
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == before


def test_search_in_chunks_and_on_empty_tables(spark, documents, monkeypatch):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    want = sorted(map(str, impact_ranges.search(table(spark, documents), items, 5).collect()))
    monkeypatch.setattr(impact_ranges.asked_chunks, "__defaults__", (1,))
    assert sorted(map(str, impact_ranges.search(table(spark, documents), items, 5).collect())) == want
    assert impact_ranges.search(table(spark, []), items).collect() == []
    assert impact_ranges.search(table(spark, documents), items.limit(0)).collect() == []


def test_search_scores_few_documents(monkeypatch):
    """Bounds prune: a term that a few documents hold is not looked up in all others."""
    rows = [(k, [b"common"] * (1 + k % 7) + ([b"rare"] if k % 500 == 3 else [])) for k in range(5000)]
    block = impact_ranges._block(rows, __import__("pyarrow").int64())
    row = next(impact_ranges._arrays(block, ("ids", "lengths", "terms", "df", "docs", "tf")))
    pa = __import__("pyarrow")
    ranges = impact_ranges.Ranges(row, pa.array(["common", "rare"]), np.array([1, 5000]), (5000, 25000))
    seen = []
    plain = ranges.scores
    monkeypatch.setattr(ranges, "scores", lambda lists, docs: seen.extend(docs.tolist()) or plain(lists, docs))
    score, doc = impact_ranges.best(ranges, [0, 1], 5, 1)
    full = plain(np.array([0, 1]), np.arange(5000))
    order = np.lexsort((np.arange(5000), -full))[:5]
    assert doc.tolist() == order.tolist() and score.tolist() == full[order].tolist()
    assert len(seen) < 1500


def plain_phrases(rows, least, cover, best):
    f, total = defaultdict(Counter), Counter()
    for _, text, lang in rows:
        for piece in re.split(r"[.,;:!?\n-\r]", lower(text)):
            w = re.findall(r"[^ \t]+", piece)
            total[lang or "und"] += len(w)
            for size in (1, 2, 3):
                f[lang or "und"].update(tuple(w[i:i + size]) for i in range(len(w) - size + 1))
    out = []
    for lang, c in f.items():
        cand = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        most = Counter()
        for p, a in cand.items():
            if len(p) == 3:
                for q in (p[:2], p[1:]):
                    most[q] = max(most[q], a)
        rows = []
        for p, a in cand.items():
            if len(p) == 2 and 100 * most[p] >= cover * a and most[p]:
                continue
            score, k = min((1_000_000 * a * a // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), " ".join(p), a, c[p[:k]], c[p[k:]], total[lang], score))
        out += [(lang, r, *x[3:]) for r, x in enumerate(sorted(rows)[:best], 1)]
    return out


@pytest.mark.parametrize("size,side", [(1, 256), (37, 4), (500, 8), (1 << 20, 256)])
def test_phrases_equal_brute_force(spark, documents, size, side, monkeypatch):
    monkeypatch.setattr(tiled_phrases, "TOKENS", size)
    monkeypatch.setattr(tiled_phrases, "SIDE", side)
    docs = documents if size > 1 else documents[::9]
    docs = [d for d in docs if size > 500 or len(d[1] or "") < 5000]
    for least, cover, best in ((10, 50, 2000), (3, 90, 15)):
        got = tiled_phrases.top_phrases(table(spark, docs).repartition(2), best, least, cover).collect()
        assert sorted(map(tuple, got)) == sorted(plain_phrases(docs, least, cover, best))
        if size > 1:
            assert got


def test_phrases_of_odd_tables(spark):
    assert tiled_phrases.top_phrases(table(spark, [])).collect() == []
    assert tiled_phrases.top_phrases(table(spark, [(1, None, None), (2, "", "en"), (3, "a b", "en")])).collect() == []


def test_blocks_of_words_are_read_a_few_at_a_time(spark, monkeypatch):
    monkeypatch.setattr(tiled_phrases, "TOKENS", 30_000)
    most, rows = group_mb(tiled_phrases.blocks(wide(spark)))
    assert rows >= 40 and most < 10  # else a reader decodes all blocks of a file at once


def test_words_and_pairs_are_not_broadcast(spark, documents, monkeypatch):
    plans, large, write = {}, set(), tiled_phrases.staged

    def kept(df, name="stage", **more):
        plans[name, len(plans)] = df._jdf.queryExecution().sparkPlan().toString()
        large.update([name] if more.get("large") else [])
        return write(df, name, **more)

    monkeypatch.setattr(tiled_phrases, "staged", kept)
    plans["phrases", 0] = tiled_phrases.phrases(table(spark, documents))._jdf.queryExecution().sparkPlan().toString()
    assert {"blocks", "ranks"} <= large
    joins = [line for plan in plans.values() for line in plan.splitlines() if "Join" in line]
    assert sum("SortMergeJoin" in x for x in joins) >= 9
    # Only the first place of each partition and the number of words of each language are small at any size.
    assert not [x for x in joins if "BroadcastHashJoin" in x and "_part" not in x and "_lang" not in x]


def test_tiles_count_like_a_dictionary():
    rng = np.random.default_rng(3)
    x, y = (np.minimum(rng.zipf(1.3, 50_000), 10**12) for _ in range(2))
    a, b, n = tiled_phrases.tile_counts(x, y)
    assert dict(zip(zip(a.tolist(), b.tolist(), strict=True), n.tolist(), strict=True)) == Counter(zip(x.tolist(), y.tolist(), strict=True))
    assert len(a) == len(set(zip(a.tolist(), b.tolist(), strict=True)))


def test_scores_are_exact_beyond_64_bits(spark):
    a, left, right = 900_000_000_000_007, 987_654_321_098_765, 999_999_999_999_999
    row = spark.createDataFrame([(a, left, right)], "a long, l long, r long").select(tiled_phrases._score("a", "l", "r").alias("s")).first()
    assert row.s == 1_000_000 * a * a // (left * right)


def plain_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    grams = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    covered = {j for i in range(len(words) - 2) if grams[tuple(words[i:i + 3])] > 1 for j in range(i, i + 3)}
    seen, lines = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            lines += line in seen
            seen.add(line)
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), lines, len(covered), failed


def test_base_rules_equal_brute_force(spark, documents):
    rows = [*documents, (50, "a # b\na # b\n\n \nA # b\r\na # b x \x1c \x85 　 <|>", "en"), (51, "so it is so it is so", "en"), (52, "a b a b a b", "en")]
    got = compression_bands.measure(table(spark, rows).repartition(3)).collect()
    assert sorted(map(str, ((r.doc_id, *r[1:6], r.base_failed) for r in got))) == sorted(str((i, *plain_counts(t))) for i, t, _ in rows)
    assert all(r.kept == (not r.base_failed and r.reason is None) for r in got)
    assert compression_bands.measure(table(spark, [])).collect() == []


def test_bands_reject_junk_and_keep_prose(spark):
    rng = random.Random(4)
    sylls = "the an re in on er ti es or te of ed is it al ar st nd to nt".split()
    lexicon = ["".join(rng.choices(sylls, k=rng.randint(1, 4))) for _ in range(4000)]
    weights = [1 / (k + 3) for k in range(len(lexicon))]

    def prose(n):
        return " ".join(w + ("." if rng.random() < 0.08 else "") for w in rng.choices(lexicon, weights, k=n))

    def noise(n):
        return " ".join(base64.b64encode(rng.randbytes(9)).decode() for _ in range(n))

    def same(n):
        return "\n".join(f"{k} buy now cheap offers click here today" for k in range(n))

    good = [(k, prose(n), "en") for k, n in enumerate([60, 100, 300, 1000, 3000, 20_000] * 5)]
    bad = [(100, noise(60), "en"), (101, noise(2000), "en"), (102, same(60), "en"), (103, same(4000), "en"), (104, prose(5000) + "\n" + noise(1200), "en"), (105, prose(1500) + same(300), "en"), (106, "ab " * 500, "en")]
    got = {r.doc_id: r for r in compression_bands.measure(table(spark, good + bad)).collect()}
    assert [i for i, _, _ in good if not got[i].kept] == []
    assert [i for i, _, _ in bad if got[i].kept] == []
    assert got[101].reason.startswith("incompressible") and got[104].reason == "incompressible chunks" and got[103].reason.startswith("repetitive")
    kept = compression_bands.passing(table(spark, good + bad))
    assert kept.columns == table(spark, []).columns and {r.doc_id for r in kept.collect()} == {i for i, _, _ in good}
