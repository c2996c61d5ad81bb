"""Quality rules from compression: texts that zstandard shrinks too well or hardly at all are rejected.

A text is compressed whole and in fixed chunks of ``CHUNK`` bytes of its UTF-8 form. What a ratio (bytes before to bytes
after) says depends on the length: a frame of zstandard has some bytes of its own and finds more to refer to the longer the
text, so each length has a band of its own (``BANDS``), and below 64 bytes nothing is judged. A ratio above its band is
repetitive, one below it incompressible (keys, encoded binaries, random characters). A text is rejected if its whole ratio
is outside the band of its length, or if chunks outside theirs hold more than ``SHARE`` of its bytes: the whole ratio misses
a passage of junk in a long text, chunks miss repeats further apart than a chunk.

Base rules count in the same pass: words are runs of anything but ASCII white space; a text fails with fewer than
``LEAST_WORDS`` words, or with more than half of its words in windows of three words that stand in it twice or more.

The pass is one ``mapInArrow`` over the rows, without a shuffle; a task holds one text's words at a time. Bands are fixed
values, so a row's verdict depends on its text alone and not on the table. Null and empty texts have no words: they fail the
base rules, with ratios of null. Very long texts are read whole; they only have more chunks. Rows repeated, with null ids or
with further columns each get their own verdict.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

LEVEL, CHUNK, SHARE, LEAST_WORDS = 3, 4096, 0.3, 50
# From this many bytes on: least and largest ratio. Plain prose stays inside with a margin of a third at least.
BANDS = ((64, 0.70, 2.2), (128, 0.95, 2.5), (256, 1.15, 3.0), (512, 1.25, 3.4), (1024, 1.38, 3.8), (4096, 1.45, 4.2), (16384, 1.50, 4.8), (262144, 1.50, 6.0))
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def band(n_bytes: int) -> tuple[float, float] | None:
    """Least and largest ratio for a text of this length; None below the first band."""
    found = None
    for least, low, high in BANDS:
        if n_bytes >= least:
            found = low, high
    return found


def outside(data: bytes, ratio: float) -> int:
    """1 above the band of this length, -1 below it, else 0."""
    limits = band(len(data))
    return 0 if limits is None else int(ratio > limits[1]) - int(ratio < limits[0])


def repeated_words(words: list[bytes]) -> int:
    """Words covered by windows of three words that occur twice or more."""
    n = len(words) - 2
    if n < 2:
        return 0
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), "int64", len(words))
    pairs = np.unique(ids[:-1] * len(known) + ids[1:], return_inverse=True)[1]
    _, which, counts = np.unique(pairs[:-1] * len(known) + ids[2:], return_inverse=True, return_counts=True)
    again = counts[which] > 1
    covered = np.zeros(len(words), bool)
    for k in range(3):
        covered[k:n + k] |= again
    return int(covered.sum())


def base_counts(text: str, words: list[bytes]) -> tuple[int, ...]:
    """Values of ``COUNTS``."""
    lines, seen = 0, set()
    for line in text.split("\n"):
        if line.strip(SPACES):
            lines += line in seen
            seen.add(line)
    chars = len(text) - sum(map(text.count, SPACES))
    return len(words), chars, sum(map(text.count, SYMBOLS)), lines, repeated_words(words)


def verdict(data: bytes, packer: zstandard.ZstdCompressor) -> tuple[float | None, float | None, float | None, float, str | None]:
    """Ratio of the whole text, least and largest ratio of its chunks, share of its bytes in chunks outside their band, reason."""
    if not data:
        return None, None, None, 0.0, None
    whole = len(data) / len(packer.compress(data))
    chunks = [data[at:at + CHUNK] for at in range(0, len(data), CHUNK)]
    ratios = [whole] if len(chunks) == 1 else [len(c) / len(packer.compress(c)) for c in chunks]
    signs = [outside(c, r) for c, r in zip(chunks, ratios, strict=True)]
    share = sum(len(c) for c, s in zip(chunks, signs, strict=True) if s) / len(data)
    sign = outside(data, whole)
    reason = {1: "repetitive", -1: "incompressible"}.get(sign)
    if reason is None and share > SHARE:
        reason = "repetitive chunks" if sum(signs) > 0 else "incompressible chunks"
    return whole, min(ratios), max(ratios), share, reason


def judged(texts: pa.ChunkedArray | pa.Array) -> list[tuple]:
    """(five counts, n_bytes, ratio, least and largest chunk ratio, bad share, reason, base_failed, kept) of each text."""
    packer = zstandard.ZstdCompressor(level=LEVEL)
    out = []
    for value in texts:
        text = value.as_py() or ""
        data = text.encode("utf-8", "surrogatepass")
        counts = base_counts(text, data.split())
        found = verdict(data, packer)
        failed = counts[0] < LEAST_WORDS or 100 * counts[4] > 50 * counts[0]
        out.append((*counts, len(data), *found, failed, not failed and found[-1] is None))
    return out


_COLUMNS = [*((c, pa.int64()) for c in (*COUNTS, "n_bytes")), *((c, pa.float64()) for c in ("ratio", "least_chunk", "largest_chunk", "bad_share")), ("reason", pa.string()), ("base_failed", pa.bool_()), ("kept", pa.bool_())]


def measure(documents: DataFrame) -> DataFrame:
    """doc_id, the counts, the ratios, ``reason`` (null if the bands let the text pass), base_failed and kept of each row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            # A few rows at a time, so that output never waits for a batch of long texts.
            for at in range(0, rows.num_rows, 1024):
                part = rows.slice(at, 1024)
                columns = zip(*judged(part.column("text")), strict=True)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *(pa.array(c, kind) for c, (_, kind) in zip(columns, _COLUMNS, strict=True))], names=["doc_id", *(n for n, _ in _COLUMNS)])

    kind = documents.schema["doc_id"].dataType.simpleString()
    numbers = ", ".join(f"{c} long" for c in (*COUNTS, "n_bytes"))
    return documents.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, {numbers}, ratio double, least_chunk double, largest_chunk double, bad_share double, reason string, base_failed boolean, kept boolean")


def passing(documents: DataFrame) -> DataFrame:
    """The rows of ``documents`` that are kept, all their columns as they were."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            yield rows.filter(pa.array([r[-1] for r in judged(rows.column("text"))], pa.bool_()))

    return documents.mapInArrow(run, documents.schema)
