"""SentencePiece encoding and decoding of merge-type models, by backtracking.

A sequence of pieces is the encoding of a text exactly when each adjacent pair is: merging the two pieces' characters
anew gives the same two pieces. So an encoder need not merge the text. It takes the longest piece at each place (all
pieces at a place come from one Aho-Corasick run over the reversed text), goes on while adjacent pieces are compatible,
and steps back where they are not. The encoding of every prefix is unique, hence a place that failed once has failed for
good; a bitfield keeps those places, and each is left at most once.

No piece holds a space mark behind another character, and none holds a character outside the vocabulary, so words are
encoded on their own; encodings of words and verdicts on pairs are kept in dictionaries of bounded size.

Nulls count as empty texts. An empty text has the end id alone and decodes to the empty text. Further columns stay.
"""

from __future__ import annotations

import math
import re
from array import array
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

SPACE = "▁"
# Kinds of pieces in a model file: fixed values of its format.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
MERGE_TYPE = 2
# Entries a dictionary may hold before it is emptied; of words those of the time before stay at hand.
WORDS, PAIRS = 100_000, 200_000
# Characters of text that one output batch stands for.
BATCH_BYTES = 2_000_000


class Model:
    """The pieces of a merge-type model with byte fallback, read from the bytes of its file."""

    def __init__(self, content: bytes):
        from sentencepiece import sentencepiece_model_pb2 as pb

        proto = pb.ModelProto()
        proto.ParseFromString(content)
        spec, trainer = proto.normalizer_spec, proto.trainer_spec
        plain = not spec.precompiled_charsmap and not spec.remove_extra_whitespaces and spec.escape_whitespaces
        kinds = {p.type for p in proto.pieces}
        if trainer.model_type != MERGE_TYPE or not plain or trainer.treat_whitespace_as_suffix or USER_DEFINED in kinds or UNUSED in kinds:
            raise ValueError("a merge-type model with identity normalization and no user-defined or unused pieces is needed")
        if BYTE not in kinds:
            raise ValueError("a model with byte fallback is needed")
        self.prefix = spec.add_dummy_prefix
        self.eos = next(i for i, p in enumerate(proto.pieces) if p.type == CONTROL and p.piece == (trainer.eos_piece or "</s>"))
        self.ids = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == NORMAL}
        self.scores = {p.piece: p.score for p in proto.pieces if p.type == NORMAL}
        self.names = [p.piece for p in proto.pieces]
        self.bytes = {int(p.piece[1:-1], 16): i for i, p in enumerate(proto.pieces) if p.type == BYTE}
        out = {NORMAL: lambda p: p.piece.replace(SPACE, " ").encode(), BYTE: lambda p: bytes([int(p.piece[1:-1], 16)]),
               CONTROL: lambda p: b"", UNKNOWN: lambda p: " ⁇ ".encode()}
        self.surfaces = [out[p.type](p) for p in proto.pieces]
        characters = {c for piece in self.ids for c in piece}
        if any(SPACE in p.lstrip(SPACE) for p in self.ids) or not characters <= self.ids.keys():
            raise ValueError("a model is needed whose pieces hold the space mark only in front, and no character without a piece")
        self.foreign = re.compile(f"([^{re.escape(''.join(sorted(characters)))}])")
        self.newline_apart = "\n" not in characters
        self.automaton = ahocorasick.Automaton()
        for piece, i in self.ids.items():
            self.automaton.add_word(piece[::-1], i)
        self.automaton.make_automaton()
        self.lengths = [len(name) for name in self.names]
        self.shorter = [-1] * len(self.names)  # the longest piece that is a proper prefix
        for piece, i in self.ids.items():
            self.shorter[i] = next((self.ids[piece[:k]] for k in range(len(piece) - 1, 0, -1) if piece[:k] in self.ids), -1)
        self.traces: dict[int, list[tuple[float, str, str]] | None] = {}
        self.pairs: dict[int, bool] = {}
        self.words: dict[str, bytes] = {}
        self.bare: dict[str, bytes] = {}
        self.before: dict[int, dict[str, bytes]] = {}

    def merges(self, piece: int) -> list[tuple[float, str, str]] | None:
        """How a piece's own characters merge, the best-scored pair first, the leftmost among equals: after each merge its
        score and the first and last symbol. None if they don't merge to the piece."""
        if piece not in self.traces:
            text, scores, trace = self.names[piece], self.scores, []
            symbols = list(text)
            while len(symbols) > 1:
                best, at = None, -1
                for i in range(len(symbols) - 1):
                    score = scores.get(symbols[i] + symbols[i + 1])
                    if score is not None and (best is None or score > best):
                        best, at = score, i
                if best is None:
                    break
                symbols[at:at + 2] = [symbols[at] + symbols[at + 1]]
                trace.append((best, symbols[0], symbols[-1]))
            self.traces[piece] = trace if len(symbols) == 1 else None
        return self.traces[piece]

    def compatible(self, left: int, right: int) -> bool:
        """Whether the characters of two adjacent pieces, merged anew together, give the two pieces."""
        key = left << 20 | right
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= PAIRS:
                self.pairs.clear()
            known = self.pairs[key] = self.stays_apart(left, right)
        return known

    def stays_apart(self, left: int, right: int) -> bool:
        """Both sides' merges are replayed in the order of the common queue; a merge across the border ends it."""
        before, after, scores, none = self.merges(left), self.merges(right), self.scores, -math.inf
        if before is None or after is None:
            return False
        last, first = self.names[left][-1], self.names[right][0]
        i = j = 0
        while True:
            across = scores.get(last + first)
            a = before[i][0] if i < len(before) else none
            b = after[j][0] if j < len(after) else none
            if across is not None and across > a and across >= b:
                return False
            if a is none and b is none:
                return True
            if a >= b:
                last = before[i][2]
                i += 1
            else:
                first = after[j][1]
                j += 1

    def backtrack(self, text: str) -> list[int]:
        """Pieces of a text of known characters."""
        size = len(text)
        if size == 1:
            return [self.ids[text]]
        longest = [0] * size
        seen = -1
        for end, piece in self.automaton.iter(text[::-1]):  # the longest comes first at each end
            if end != seen:
                longest[end] = piece
                seen = end
        longest.reverse()
        lengths, shorter, pairs = self.lengths, self.shorter, self.pairs
        piece, at, last = longest[0], 0, -1
        if lengths[piece] == size:
            if self.merges(piece) is not None:
                return [piece]
            piece = shorter[piece]  # any other sequence has pairs, which check both of their pieces
        failed = bytearray(size // 8 + 1)
        pieces: list[int] = []
        while True:
            while piece >= 0:
                end = at + lengths[piece]
                if not failed[end >> 3] >> (end & 7) & 1 and (
                        last < 0 or (known if (known := pairs.get(last << 20 | piece)) is not None else self.compatible(last, piece))):
                    break
                piece = shorter[piece]
            if piece >= 0:
                pieces.append(piece)
                if end == size:
                    return pieces
                at, last, piece = end, piece, longest[end]
            else:
                failed[at >> 3] |= 1 << (at & 7)
                piece = pieces.pop()
                at -= lengths[piece]
                last = pieces[-1] if pieces else -1
                piece = shorter[piece]

    def chunk(self, text: str) -> array:
        """A text without a space mark behind another character, characters outside the vocabulary as their bytes."""
        ids = array("i")
        for k, part in enumerate(self.foreign.split(text)):
            if k % 2:
                ids.extend(self.bytes[b] for b in part.encode())
            elif part:
                ids.extend(self.backtrack(part))
        return ids

    def known(self, kept: dict[str, bytes], word: str, text: str) -> bytes:
        if len(kept) >= WORDS:
            self.before[id(kept)] = dict(kept)
            kept.clear()
        found = kept[word] = self.before.get(id(kept), {}).get(word) or self.chunk(text).tobytes()
        return found

    def encode(self, text: str) -> array:
        """Ids of a text, without an end id."""
        ids = array("i")
        if not text:
            return ids
        text = text.replace(SPACE, " ")
        words, bare = self.words, self.bare
        for k, line in enumerate(text.split("\n") if self.newline_apart else [text]):
            parts = line.split(" ")
            if k:
                ids.extend(self.bytes[b] for b in b"\n")
            if k or not self.prefix:
                first, parts = parts[0], parts[1:]
                if first:
                    ids.frombytes(bare.get(first) or self.known(bare, first, first))
            marks = 0
            for word in parts:
                if word:
                    if marks:
                        word, marks = SPACE * marks + SPACE + word, 0
                        ids.frombytes(bare.get(word) or self.known(bare, word, word))
                    else:
                        ids.frombytes(words.get(word) or self.known(words, word, SPACE + word))
                else:
                    marks += 1
            if marks:
                ids.extend(self.chunk(SPACE * marks))
        return ids

    def decode(self, ids) -> str:
        """The text of ids; the space mark that encoding puts in front is dropped, broken bytes become U+FFFD."""
        content = b"".join(map(self.surfaces.__getitem__, ids))
        if self.prefix and content[:1] == b" ":
            first = next(i for i in ids if self.surfaces[i])
            if self.names[first][:1] == SPACE:
                content = content[1:]
        return content.decode("utf-8", "replace")


@lru_cache(maxsize=2)
def _model(content: bytes) -> Model:
    return Model(content)


def _read(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def encode(df: DataFrame, model_path: str, text: str = "text", ids: str = "ids", decoded: str | None = None, end: bool = True) -> DataFrame:
    """``df`` with the ids of each text (array of ints), and if ``decoded`` is named, with the text that these ids decode to.

    ``model_path`` is read once on the driver; the file's bytes (half a megabyte for 32,000 pieces) go with the tasks.
    """
    content = _read(model_path)
    fields = [T.StructField(ids, T.ArrayType(T.IntegerType()))] + ([T.StructField(decoded, T.StringType())] if decoded else [])
    taken = {f.name for f in fields}
    kept = [c for c in df.columns if c not in taken]
    schema = T.StructType([df.schema[c] for c in kept] + fields)

    def run(batches):
        pa.default_memory_pool().release_unused()  # a worker may have run other stages before
        model = _model(content)
        for whole in batches:
            texts = whole.column(text)
            first = size = 0
            values, offsets, back = array("i"), [0], []
            for k in range(len(texts)):
                value = texts[k].as_py() or ""
                own = model.encode(value)
                if end:
                    own.append(model.eos)
                values.extend(own)
                offsets.append(len(values))
                if decoded:
                    back.append(model.decode(own))
                size += len(value)
                if size > BATCH_BYTES or k == len(texts) - 1:
                    rows = whole.slice(first, k + 1 - first)
                    lists = pa.ListArray.from_arrays(pa.array(np.array(offsets, "int32")), pa.array(np.frombuffer(values, "int32") if len(values) else np.zeros(0, "int32")))
                    yield pa.RecordBatch.from_arrays([rows.column(c) for c in kept] + [lists] + ([pa.array(back, pa.string())] if decoded else []),
                                                     names=kept + [f.name for f in fields])
                    first, size = k + 1, 0
                    values, offsets, back = array("i"), [0], []

    return df.mapInArrow(run, schema)


def decode(df: DataFrame, model_path: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``df`` with the text of each row's ids; a null list decodes to the empty text, null ids are skipped."""
    content = _read(model_path)
    kept = [c for c in df.columns if c != decoded]
    schema = T.StructType([df.schema[c] for c in kept] + [T.StructField(decoded, T.StringType())])

    def run(batches):
        model = _model(content)
        for rows in batches:
            texts = [model.decode([i for i in row.as_py() or [] if i is not None]) for row in rows.column(ids)]
            yield pa.RecordBatch.from_arrays([rows.column(c) for c in kept] + [pa.array(texts, pa.string())], names=schema.names)

    return df.mapInArrow(run, schema)
