"""Homomorphic multiset fingerprints of documents, in DataFrame functions alone.

A document is the multiset of its paragraphs (lines with at least one word). Each paragraph is hashed to a wide vector;
a document's vector is their sum, each lane modulo a power of two. So order doesn't matter, and adding or removing a
paragraph adds or subtracts its vector (``plus``, ``minus``). A paragraph's vector has two parts:

* ``IDENTITY`` lanes of uniform 32-bit hashes of the whole paragraph: equal sums mean equal multisets, up to chance.
* 64 lanes that count, over its three-word shingles, the shingles whose 64-bit hash has that bit set. Read as sums of
  +1 and -1 these lanes keep lengths: the mean square of two documents' difference estimates how many shingles they
  don't share. ``likeness`` turns that into 1 for equal vectors and about 0 for unrelated ones (standard error 0.13).

Null and empty texts have the zero vector; they are like each other, and unlike everything else. Texts that differ only
in the order of paragraphs, in blank lines or in blanks at the ends of a line share the vector, equal texts always do.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crawlspark.llm.shared import staged, tasks

IDENTITY = 8
MODULUS = 1 << 32
PAIRS = 32  # sums that hold two lanes of 32 bits each


def _identity(lines: Column, k: int) -> Column:
    return F.aggregate(lines, F.lit(0).cast("long"), lambda total, line: (total + F.shiftrightunsigned(F.xxhash64(F.lit(k), line), 32)) % MODULUS)


def vectors(df: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """One row for each distinct ``keys`` (which must tell the texts apart): keys, identity, lanes, shingles."""
    lines = F.filter(F.transform(F.split(F.coalesce(F.col(text), F.lit("")), "\n"), lambda line: F.btrim(line, F.lit(" \t\r\x0b\x0c"))), lambda line: line != "")
    whole = df.select(*keys, lines.alias("_lines"))
    identity = F.array(*[_identity(F.col("_lines"), k) for k in range(IDENTITY)])
    words = F.split("_line", "[ \t\r\x0b\x0c]+")
    one = whole.select(*keys, identity.alias("identity"), F.explode_outer("_lines").alias("_line")).select(*keys, "identity", words.alias("w"))
    rest = F.greatest(F.size("w"), F.lit(1))
    shingles = F.arrays_zip(F.col("w").alias("a"), F.slice("w", 2, rest).alias("b"), F.slice("w", 3, rest).alias("c"))
    each = one.select(*keys, "identity", F.inline_outer(shingles)).toDF(*keys, "identity", "a", "b", "c")
    # A line without a shingle is a document without lines: its one row counts nothing.
    hashed = each.select(*keys, "identity", F.when(F.col("a").isNotNull(), F.xxhash64("a", "b", "c")).alias("h"))
    low = F.lit((1 << 32) + 1).cast("long")
    sums = [F.sum(F.shiftrightunsigned("h", k).bitwiseAND(low)).alias(f"s{k}") for k in range(PAIRS)]
    out = hashed.groupBy(*keys, "identity").agg(F.count("h").alias("shingles"), *sums)
    pairs = [F.coalesce(F.col(f"s{k}"), F.lit(0).cast("long")) for k in range(PAIRS)]
    lanes = F.array(*[p.bitwiseAND(F.lit(MODULUS - 1)) for p in pairs], *[F.shiftrightunsigned(p, 32) for p in pairs])
    return out.select(*keys, "identity", lanes.alias("lanes"), "shingles")


def _join(a: Column, b: Column, sign: int) -> Column:
    def lane(x, y):
        return F.pmod(x + sign * y, F.lit(MODULUS))
    return F.struct(F.zip_with(a["identity"], b["identity"], lane).alias("identity"), F.zip_with(a["lanes"], b["lanes"], lane).alias("lanes"),
                    (a["shingles"] + sign * b["shingles"]).alias("shingles"))


def plus(a: Column, b: Column) -> Column:
    """The vector (a struct of identity, lanes, shingles) of two documents' paragraphs together."""
    return _join(a, b, 1)


def minus(a: Column, b: Column) -> Column:
    """The vector of a document without the paragraphs of another."""
    return _join(a, b, -1)


def fingerprint(vector: Column) -> Column:
    """The vector as lowercase hex, eight digits a lane."""
    return F.array_join(F.transform(F.concat(vector["identity"], vector["lanes"]), lambda lane: F.lpad(F.lower(F.hex(lane)), 8, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """From 0 to 1, by the lanes that keep lengths."""
    def signed(v):
        return F.transform(v["lanes"], lambda lane: (2 * lane - v["shingles"]).cast("double"))

    def total(lanes):
        return F.aggregate(lanes, F.lit(0.0), lambda t, x: t + x)
    x, y = signed(a), signed(b)
    apart = total(F.zip_with(x, y, lambda p, q: (p - q) * (p - q)))
    norms = total(F.transform(x, lambda p: p * p)) + total(F.transform(y, lambda q: q * q))
    return F.when((a["identity"] == b["identity"]) & (a["lanes"] == b["lanes"]), 1.0).when(norms == 0, 0.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), 1 - apart / norms)))


def with_next(documents: DataFrame, most_ranges: int = 1_000) -> DataFrame:
    """range, place, doc_id, tie, text of each row, and next_id, next_tie, next_text of the row after it by id; the first
    follows the last. Range and place number the rows, so rows that are equal in id and text stay apart.

    Rows are dealt to ranges of ids, cut at quantiles (at most ``most_ranges`` numbers go to the driver), and each range
    also gets the first row of the range after it; so texts are shuffled once, and no task sees more than its range.
    Rows of one id stand in the order of a hash of their text; null ids come first.
    """
    rows = documents.select("doc_id", F.xxhash64("text").alias("tie"), F.coalesce("text", F.lit("")).alias("text"))
    n = max(1, min(most_ranges, tasks(documents) * 2))
    cuts = rows.agg(F.percentile_approx("doc_id", [k / n for k in range(1, n)] or [0.5], 10_000).alias("q")).first()["q"]
    cuts = sorted(set(cuts or []))[:n - 1]
    bounds = F.array(*[F.lit(c).cast("long") for c in cuts]) if cuts else F.array().cast("array<long>")
    dealt = rows.withColumn("range", F.when(F.col("doc_id").isNull(), 0).otherwise(F.size(F.filter(bounds, lambda c: c < F.col("doc_id")))))
    firsts = sorted((r["range"], r["first"]["doc_id"], r["first"]["tie"]) for r in dealt.groupBy("range").agg(F.min(F.struct("doc_id", "tie")).alias("first")).collect())
    schema = "range int, first_id long, first_tie long"
    before = documents.sparkSession.createDataFrame([(firsts[k - 1][0], i, t) for k, (_, i, t) in enumerate(firsts)], schema)
    # At most one row of three numbers for each range.
    guests = dealt.drop("range").join(F.broadcast(before), F.col("doc_id").eqNullSafe(F.col("first_id")) & (F.col("tie") == F.col("first_tie")))
    guests = guests.dropDuplicates(["range", "doc_id", "tie"]).select("doc_id", "tie", "text", "range", F.lit(True).alias("guest"))
    all_rows = dealt.withColumn("guest", F.lit(False)).unionByName(guests)
    after = Window.partitionBy("range").orderBy("guest", "doc_id", "tie")
    return (all_rows.withColumns({"place": F.row_number().over(after), **{f"next_{c}": F.lead(c if c != "id" else "doc_id").over(after) for c in ("id", "tie", "text")}})
            .filter(~F.col("guest")).drop("guest"))


def halved(documents: DataFrame) -> DataFrame:
    """Each document beside its edited text: the last half of its code points replaced by the first of the next document."""
    n = F.length("text")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - F.floor(n / 2).cast("int")), F.substring(F.col("next_text"), F.lit(1), F.floor(n / 2).cast("int")))
    return with_next(documents).withColumn("edited", edited).drop("next_text")


def edit_report(documents: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next for each document."""
    row = ["range", "place", "doc_id", "tie", "next_id", "next_tie"]
    keys = [*row, "kind", "n_chars", "digest"]
    pairs = halved(documents)
    texts = F.array(F.struct(F.lit(0).alias("kind"), F.col("text").alias("text")), F.struct(F.lit(1).alias("kind"), F.col("edited").alias("text")))
    each = pairs.select(*row, F.inline(texts))
    each = each.select(*row, "kind", F.length("text").cast("long").alias("n_chars"),
                       F.when(F.col("kind") == 1, F.sha2(F.col("text").cast("binary"), 256)).alias("digest"), "text")
    found = vectors(each, keys).withColumn("v", F.struct("identity", "lanes", "shingles"))
    found = staged(found.select(*keys, "v"), "vectors")
    own, edited = found.filter("kind = 0").alias("o"), found.filter("kind = 1").alias("e")
    after = found.filter("kind = 0").groupBy("doc_id", "tie").agg(F.first("v").alias("v")).alias("n")
    same_row = (F.col("o.range") == F.col("e.range")) & (F.col("o.place") == F.col("e.place"))
    is_next = F.col("o.next_id").eqNullSafe(F.col("n.doc_id")) & F.col("o.next_tie").eqNullSafe(F.col("n.tie"))
    rows = own.join(edited, same_row).join(after, is_next)
    return rows.select("o.doc_id", "o.n_chars", F.col("e.digest").alias("edited_sha256"), fingerprint(F.col("o.v")).alias("fingerprint"),
                       fingerprint(F.col("e.v")).alias("edited_fingerprint"), likeness(F.col("o.v"), F.col("e.v")).alias("near_edited"),
                       likeness(F.col("o.v"), F.col("n.v")).alias("near_next"))
