"""SentencePiece ids by a streaming Viterbi search, and back."""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .text import chunks, flat_bytes

MODEL_FILE = "/opt/tokenizers/piece_bpe_32k.model"
BLANK = "▁"
CACHED_UNITS = 150_000
CACHED_LENGTH = 48
BATCH_BYTES = 1 << 20  # of texts or ids that are turned at once
UNKNOWN_PENALTY = 10.0  # below the lowest score of a piece


_NONE = float("-inf")


@dataclass
class Vocabulary:
    """Pieces with ids and scores, as read from a model file; small enough to travel with every task."""

    surface: list[bytes]  # by id: what it stands for in a text, blanks already turned back
    ids: dict[str, tuple[int, float]]
    byte_ids: list[int] | None  # by byte value, if the model falls back to bytes
    unknown_id: int
    prefix: bool  # a blank is put before the text
    longest: int = 0
    unknown_score: float = 0.0
    trie: dict = field(default_factory=dict, repr=False)

    def __post_init__(self):
        self.longest = max(map(len, self.ids), default=1)
        self.unknown_score = min((s for _, s in self.ids.values()), default=0.0) - UNKNOWN_PENALTY

    def grow(self) -> dict:
        """Pieces by character: {c: (nodes that go on, id or -1, score)}."""
        if not self.trie:
            for piece, (i, score) in self.ids.items():
                level = self.trie
                for c in piece:
                    node = level.setdefault(c, [{}, -1, 0.0])
                    level = node[0]
                node[1:] = i, score
        return self.trie


def load(model_file: str = MODEL_FILE) -> Vocabulary:
    """Read a model that leaves texts as they are but for blanks; it is read on the driver only."""
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    with open(model_file, "rb") as f:
        proto.ParseFromString(f.read())
    rules = proto.normalizer_spec
    if rules.precompiled_charsmap or rules.remove_extra_whitespaces or not rules.escape_whitespaces:
        raise ValueError("only models without text normalisation are supported")
    normal, unknown, control, user, unused, byte = 1, 2, 3, 4, 5, 6
    surface, ids, byte_ids, unknown_id = [], {}, [-1] * 256, 0
    for i, p in enumerate(proto.pieces):
        surface.append(p.piece.replace(BLANK, " ").encode())
        if p.type in (normal, user):
            ids[p.piece] = (i, p.score)
        elif p.type == byte:
            value = int(p.piece[3:5], 16)
            byte_ids[value], surface[-1] = i, bytes([value])
        elif p.type == unknown:
            unknown_id, surface[-1] = i, " ⁇ ".encode()
        elif p.type == control:
            surface[-1] = b""
    return Vocabulary(surface, ids, byte_ids if min(byte_ids) >= 0 else None, unknown_id, rules.add_dummy_prefix)


class StreamingViterbi:
    """Best segmentation of a text that arrives in parts.

    Boundaries are settled from left to right: once all pieces that begin before a boundary have been tried, its best path
    is known.  The text ahead is needed no further than the longest piece reaches.  Where no piece found so far crosses a
    boundary, every path runs through it, and the ids up to it are final and leave the window; where pieces keep crossing,
    the best paths of the surviving boundaries are followed back until they meet, and the ids up to there leave.
    """

    def __init__(self, words: Vocabulary):
        self.words, self.trie = words, words.grow()
        self._reset()

    def _reset(self) -> None:
        self.text, self.at, self.far = "", 0, 0  # since the last commit: text, next boundary to settle, furthest end of a piece
        self.best, self.start, self.piece = [0.0], [0], [-1]  # by boundary: score, and start and id of the last piece
        self.check = 4 * self.words.longest

    def feed(self, part: str, last: bool = False) -> list[int]:
        """Take more text; the ids that have become final, all of them if it is the ``last`` part."""
        text = self.text = self.text + part if self.text else part
        size, root, unknown, ids = len(text), self.trie, self.words.unknown_score, []
        best, start, piece, at, far = self.best, self.start, self.piece, self.at, self.far
        room = size + 1 - len(best)
        best += [_NONE] * room
        start += [0] * room
        piece += [-1] * room
        done, stop = 0, size if last else size - self.words.longest
        while at < stop:
            if far == at > done:
                ids += self._path(done, at)
                done = at
            elif at - done >= self.check:
                done, found = self._meeting(done, at, far)
                ids += found
            score, level, end, alone = best[at], root, at, True
            while end < size:
                node = level.get(text[end])
                if node is None:
                    break
                end += 1
                level, i, value = node
                if i >= 0:
                    if end - at == 1:
                        alone = False
                    value += score
                    if value > best[end]:
                        best[end], start[end], piece[end] = value, at, i
                    if end > far:
                        far = end
            at += 1
            if alone:  # no piece for the character itself
                if score + unknown > best[at]:
                    best[at], start[at], piece[at] = score + unknown, at - 1, -1
                if at > far:
                    far = at
        if last:
            ids += self._path(done, size)
            self._reset()
            return ids
        # scores count from the last commit on and stay small in a long text
        base = best[done]
        self.best = [b - base for b in best[done:]]
        self.start, self.piece, self.text = [max(0, s - done) for s in start[done:]], piece[done:], text[done:]
        self.at, self.far = at - done, far - done
        return ids

    def _path(self, since: int, at: int) -> list[int]:
        """Ids of the best path from one boundary to another."""
        ids, start, piece = [], self.start, self.piece
        while at > since:
            if piece[at] < 0:
                ids.extend(reversed(self._unknown(self.text[start[at]])))
            else:
                ids.append(piece[at])
            at = start[at]
        ids.reverse()
        return ids

    def _meeting(self, since: int, at: int, far: int) -> tuple[int, list[int]]:
        """The last boundary that the best paths to all surviving ones share, and the ids up to it."""
        alive = {b for b in range(at, far + 1) if self.best[b] > _NONE}
        while len(alive) > 1:
            last = max(alive)
            alive.discard(last)
            alive.add(max(since, self.start[last]))
        meet = alive.pop()
        self.check = 4 * self.words.longest + at - meet
        return meet, self._path(since, meet)

    def _unknown(self, c: str) -> list[int]:
        if self.words.byte_ids is None:
            return [self.words.unknown_id]
        return [self.words.byte_ids[b] for b in c.encode()]


class Encoder(dict):
    """Ids (as packed 32-bit numbers) by unit, a unit being a stretch that no piece can cross at either end."""

    def __init__(self, words: Vocabulary):
        super().__init__()
        self.words = words
        self.older: dict[str, bytes] = {}
        self.search = StreamingViterbi(words)
        self.pairs = {pair for piece in words.ids for pair in zip(piece, piece[1:])}
        inner = any(BLANK in piece.lstrip(BLANK) for piece in words.ids)
        apart = "" if any("\n" in piece for piece in words.ids) else "\n"
        # blanks start a unit unless a piece holds one further on; a line end that no piece holds is a unit
        self.units = re.compile(f"{BLANK}*[^{BLANK}{apart}]+|{BLANK}+" + ("|\n" if apart else "")) if not inner else re.compile("(?s).+")

    def __missing__(self, unit: str) -> bytes:
        packed = self.older.get(unit)
        if packed is None:
            pairs = self.pairs
            cuts = [i for i, pair in enumerate(zip(unit, unit[1:]), 1) if pair not in pairs]  # neighbours that no piece holds together
            if cuts:
                packed = b"".join([self[unit[a:b]] for a, b in zip([0, *cuts], [*cuts, len(unit)])])
            else:
                packed = array("i", self.search.feed(unit, last=True)).tobytes()
        if len(unit) <= CACHED_LENGTH:
            if len(self) >= CACHED_UNITS:  # what is still in use comes back from the older half
                self.older = dict(self)
                self.clear()
            self[unit] = packed
        return packed

    def encode(self, text: str) -> bytes:
        """All ids of a text."""
        if not text:
            return b""
        text = text.replace(" ", BLANK)
        if self.words.prefix:
            text = BLANK + text
        return b"".join(map(self.__getitem__, self.units.findall(text)))


def decode_ids(words: Vocabulary, ids: list[int]) -> str:
    """The text of a list of ids; bytes that are no valid text become replacement characters."""
    text = b"".join(map(words.surface.__getitem__, ids))
    return (text[1:] if words.prefix and text.startswith(b" ") else text).decode("utf-8", "replace")


_ENCODERS: dict[int, Encoder] = {}


def _encoder(key: int, words: Vocabulary) -> Encoder:
    """One encoder for each Python worker, so that the units found in one task serve the next."""
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(words)
    return _ENCODERS[key]


def _with(docs: DataFrame, name: str, kind: T.DataType) -> T.StructType:
    if name in docs.columns:
        raise ValueError(f"the table has a column {name}; choose another name")
    return T.StructType([*docs.schema.fields, T.StructField(name, kind)])


def _id_lists(packed: list[bytes | None]) -> pa.ListArray:
    """Packed ids as a column of lists."""
    size = np.array([0 if p is None else len(p) // 4 for p in packed], np.int64)
    values = np.frombuffer(b"".join(p for p in packed if p), np.int32)
    return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(size)].astype(np.int32)), pa.array(values), mask=pa.array([p is None for p in packed]))


def encode(docs: DataFrame, words: Vocabulary, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with the ids of each whole text; a null text has null, an empty one no ids. Other columns pass through."""
    schema, at = _with(docs, ids, T.ArrayType(T.IntegerType())), docs.columns.index(text)
    sent = docs.sparkSession.sparkContext.broadcast(words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(sent.id if hasattr(sent, "id") else id(sent), sent.value)
        for whole in batches:
            _, start, end = flat_bytes(whole.column(at))
            for part in chunks(start, end, BATCH_BYTES):
                batch = whole.slice(part.start, part.stop - part.start)
                packed = [None if t is None else encoder.encode(t) for t in batch.column(at).to_pylist()]
                yield pa.RecordBatch.from_arrays([*batch.columns, _id_lists(packed)], schema.names)

    return docs.mapInArrow(run, schema)


def decode(rows: DataFrame, words: Vocabulary, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``rows`` with the text of their ids; null ids give null, no ids an empty text. Other columns pass through.

    An encoded text comes back as it was, but for U+2581, which the model cannot tell from a blank.
    """
    schema, at = _with(rows, text, T.StringType()), rows.columns.index(ids)
    sent = rows.sparkSession.sparkContext.broadcast(words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = sent.value
        for whole in batches:
            offsets = whole.column(at).offsets.to_numpy()
            for part in chunks(offsets[:-1], offsets[1:], BATCH_BYTES // 4):
                batch = whole.slice(part.start, part.stop - part.start)
                column = batch.column(at)
                flat, ends, real = column.flatten().to_numpy(), column.offsets.to_numpy(), column.is_valid().to_numpy(zero_copy_only=False)
                first = ends[0]
                texts = [decode_ids(words, flat[a - first : b - first].tolist()) if r else None for a, b, r in zip(ends[:-1], ends[1:], real)]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], schema.names)

    return rows.mapInArrow(run, schema)


def round_trip(docs: DataFrame, words: Vocabulary, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_ids, ids, same): ids of every text, and whether decoding gives the text again.

    Both ways in one pass, so that a task needs one Python worker.  A null text has null ids and counts as the same.
    """
    sent = docs.sparkSession.sparkContext.broadcast(words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = sent.value
        encoder = _encoder(sent.id if hasattr(sent, "id") else id(sent), words)
        for whole in batches:
            _, start, end = flat_bytes(whole.column(1))
            for part in chunks(start, end, BATCH_BYTES):
                batch = whole.slice(part.start, part.stop - part.start)
                texts = batch.column(1).to_pylist()
                packed = [None if t is None else encoder.encode(t) for t in texts]
                same = [t is None or decode_ids(words, array("i", p).tolist()) == t.replace(BLANK, " ") for t, p in zip(texts, packed)]
                yield pa.RecordBatch.from_arrays([batch.column(0), _id_lists(packed), pa.array(same, pa.bool_())], ["doc_id", "ids", "same"])

    kept = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    schema = T.StructType([kept.schema["doc_id"], T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("same", T.BooleanType())])
    return kept.mapInArrow(run, schema).select("doc_id", F.coalesce(F.size("ids"), F.lit(0)).alias("n_ids"), "ids", "same")
