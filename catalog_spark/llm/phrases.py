"""Removal of passages that occur more than once, by automata of the repeated phrases.

A window is ``length`` consecutive words; a word goes if a window over it has the same words as a window elsewhere.

1. Texts.  Equal texts are one row with the number of their copies, in a table bucketed by a digest of the text, so the
   later joins with it do not move the texts again.
2. Anchors.  Each window picks the word gram with the smallest hash inside it; equal windows pick equal grams.  The
   windows that pick one gram in a row are a run.  Runs whose gram occurs once in the whole corpus cannot recur.
3. Confirming.  The words of the other runs are cut out, equal stretches are counted once, and shards of them, dealt by
   gram, are compared by their words: windows that stand in two places, copies included, recur.  Their longest chains are
   the phrases.  Every stretch of a document gives the phrases it holds itself, so none is found only in part.
4. Automata.  The phrases of a shard are compiled into one Aho-Corasick automaton over word numbers, and the stretches of
   all documents that lead to the shard are streamed through it; every match marks its words in every text it stands in.
5. Removal.  Texts meet their marked spans in the bucketed table.

A gram with more different stretches than one shard should hold is dealt window by window, so that equal windows still
meet.  A shard with very many stretches to search is copied to several tasks.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators.skew import lookup_join
from ..session import materialize, scratch, work_folder
from .text import chunks, flat_bytes, hashed, spans

LENGTH = 35
GRAM = 12  # words of an anchor
CHUNK_BYTES = 1 << 20
LONG_BYTES = 1 << 22  # a longer text is read in parts
SHARD_BYTES = 1 << 22  # of stretches whose phrases make one automaton
HOT_BYTES = 1 << 20  # a gram with more bytes of different stretches is dealt by window
COPY_BYTES = 1 << 26  # of stretches that one copy of a shard's automaton searches
TASK_BYTES = 1 << 23
PLACE = np.dtype([("key", "V16"), ("first", "<i4")])
_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)
_BLANKS = np.array([9, 10, 11, 12, 13, 32], np.uint8)


class Words:
    """The words of texts that lie in order in ``data``: their text, bytes and hashes."""

    def __init__(self, data: np.ndarray, start: np.ndarray, end: np.ndarray):
        self.data = data
        found = [spans(data, start, end, False)] if (end - start).max(initial=0) <= LONG_BYTES else list(self._by_parts(start, end))
        self.owner, self.at, self.to = (np.concatenate(x) for x in zip(*found))
        self.count = np.bincount(self.owner, minlength=len(start))
        self.first = np.cumsum(self.count) - self.count

    def _by_parts(self, start: np.ndarray, end: np.ndarray):
        for i, (a, e) in enumerate(zip(start.tolist(), end.tolist())):
            while True:
                b = min(e, a + LONG_BYTES)
                while b < e and self.data[b] not in _BLANKS:  # to the end of the word
                    blank = np.flatnonzero(np.isin(self.data[b : b + LONG_BYTES], _BLANKS))
                    b = b + int(blank[0]) if len(blank) else min(e, b + LONG_BYTES)
                owner, at, to = spans(self.data, np.array([a]), np.array([b]), False)
                yield owner + i, at, to
                if b >= e:
                    break
                a = b

    def hashes(self) -> np.ndarray:
        cuts = np.r_[np.arange(0, len(self.at), CHUNK_BYTES), len(self.at)]
        return np.concatenate([hashed(self.data, self.at[a:b], self.to[a:b]) for a, b in zip(cuts, cuts[1:])] or [np.zeros(0, np.uint64)])

    def joined(self, which: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(bytes, ends): the words one after another with a blank behind each, and where each starts, with the end of the last."""
        at, to = (self.at, self.to) if which is None else (self.at[which], self.to[which])
        size = to - at + 1
        ends = np.r_[0, np.cumsum(size)]
        out = np.full(ends[-1], 32, np.uint8)
        for low in range(0, len(at), CHUNK_BYTES):
            part = slice(low, low + CHUNK_BYTES)
            letters = size[part] - 1
            place = np.arange(letters.sum()) - np.repeat(np.cumsum(letters) - letters, letters)
            out[np.repeat(ends[:-1][part], letters) + place] = self.data[np.repeat(at[part], letters) + place]
        return out, ends


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of ``width`` neighbours from each place on."""
    size = 1
    while size * 2 <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    rest = width - size
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def runs_of(words: Words, length: int) -> tuple[np.ndarray, ...]:
    """(text, first window, number of windows, anchor) of the runs of windows that pick the same gram."""
    gram = min(GRAM, length)
    windows = np.maximum(0, words.count - length + 1)
    if not windows.any():
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)
    single = words.hashes()
    grams = np.zeros(len(single) - gram + 1, np.uint64)
    for i in range(gram):
        grams = grams * _BASE + single[i : len(grams) + i]
    mixed = grams * _MIX
    mixed ^= mixed >> np.uint64(29)
    placed = (mixed & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
    picked = (_least(placed, length - gram + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    text = np.repeat(np.arange(len(windows)), windows)
    window = np.arange(len(text)) - np.repeat(np.cumsum(windows) - windows, windows)
    picked = picked[words.first[text] + window]
    new = np.flatnonzero(np.r_[True, (picked[1:] != picked[:-1]) | (text[1:] != text[:-1])])
    return text[new], window[new], np.diff(np.r_[new, len(text)]), grams[picked[new]]


def _anchors(length: int):
    """Arrow function (key, copies, text) -> (anchor, key, first, n, copies), a row a run."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, start, end = flat_bytes(batch.column("text"))
            copies = batch.column("copies").to_numpy()
            for part in chunks(start, end, CHUNK_BYTES):
                text, first, n, anchor = runs_of(Words(data, start[part], end[part]), length)
                text = text + part.start
                columns = [pa.array(anchor.view(np.int64)), batch.column("key").take(pa.array(text)), pa.array(first.astype(np.int32)), pa.array(n.astype(np.int32)), pa.array(copies[text])]
                yield pa.RecordBatch.from_arrays(columns, ["anchor", "key", "first", "n", "copies"])

    return run


def _stretches(length: int):
    """Arrow function (key, copies, text, runs) -> (anchor, n, text, copies, places): the words of each run, equal ones of a chunk once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, start, end = flat_bytes(batch.column("text"))
            copies, keys = batch.column("copies").to_numpy(), np.array(batch.column("key").to_pylist(), "V16")
            lists = batch.column("runs")
            offsets = lists.offsets.to_numpy()
            entries = lists.values
            for part in chunks(start, end, CHUNK_BYTES):
                words = Words(data, start[part], end[part])
                body, at = words.joined()
                low, high = offsets[part.start], offsets[part.stop]
                text = np.repeat(np.arange(part.stop - part.start), np.diff(offsets[part.start : part.stop + 1]))
                first, n, anchor = (entries.field(name).to_numpy()[low:high].astype(np.int64) for name in ("first", "n", "anchor"))
                begin = words.first[text] + first
                a, b = at[begin], at[begin + n + length - 1] - 1
                same = [hashed(body, a, b, kind) for kind in (0, 1)]  # two hashes: 128 bits
                order = np.lexsort((same[1], same[0], anchor))
                new = np.r_[True, (anchor[order][1:] != anchor[order][:-1]) | (same[0][order][1:] != same[0][order][:-1]) | (same[1][order][1:] != same[1][order][:-1])][: len(order)]
                at_group = np.flatnonzero(new)
                lead = order[at_group]
                place = np.empty(len(order), PLACE)
                place["key"], place["first"] = keys[part][text[order]], first[order]
                cuts = np.r_[at_group, len(order)]
                buffer = body.tobytes()
                columns = [
                    pa.array(anchor[lead]), pa.array(n[lead].astype(np.int32)), pa.array([buffer[x:y] for x, y in zip(a[lead].tolist(), b[lead].tolist())], pa.binary()),
                    pa.array(np.add.reduceat(copies[part][text[order]], at_group) if len(lead) else np.zeros(0, np.int64)),
                    pa.array([place[x:y].tobytes() for x, y in zip(cuts.tolist(), cuts[1:].tolist())], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["anchor", "n", "text", "copies", "places"])

    return run


def _by_window(length: int):
    """Arrow function (n, text, copies, places) -> the same with one row a window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n, text, copies, places in zip(*(batch.column(c).to_pylist() for c in ("n", "text", "copies", "places"))):
                words = text.split(b" ")
                shifted = []
                for i in range(n):
                    place = np.frombuffer(places or b"", PLACE).copy()
                    place["first"] += i
                    shifted.append(place.tobytes())
                cut = [b" ".join(words[i : i + length]) for i in range(n)]
                yield pa.RecordBatch.from_arrays([pa.array([1] * n, pa.int32()), pa.array(cut, pa.binary()), pa.array([copies] * n, pa.int64()), pa.array(shifted, pa.binary())], ["n", "text", "copies", "places"])

    return run


def recurring(number: np.ndarray, begin: np.ndarray, n: np.ndarray, copies: np.ndarray, length: int) -> np.ndarray:
    """For each of the ``n`` windows from each ``begin`` on in the word numbers, whether its words stand in two places.

    Words are ranked by pairs, fours and so on, so the comparison is of the words themselves.
    """
    rank, size = number.astype(np.int64), 1

    def pairs(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return np.unique(left * (int(rank.max(initial=0)) + 1) + right, return_inverse=True)[1]

    while size * 2 <= length:
        rank = np.r_[pairs(rank[:-size], rank[size:]), np.zeros(size, np.int64)] if len(rank) > size else rank
        size *= 2
    window = np.repeat(begin - (np.cumsum(n) - n), n) + np.arange(n.sum())
    kind = pairs(rank[window], rank[window + length - size])
    seen = np.bincount(kind, weights=np.repeat(np.minimum(copies, 2), n), minlength=1)
    return seen[kind] >= 2


def phrases_of(texts: pa.Array, n: np.ndarray, copies: np.ndarray, length: int) -> list[bytes]:
    """The longest chains of recurring windows in the stretches ``texts``, each once."""
    split = pc.split_pattern(texts.cast(pa.large_binary()), b" ")
    number = split.flatten().dictionary_encode().indices.to_numpy()
    begin = split.offsets.to_numpy()[:-1] - split.offsets[0].as_py()
    again = recurring(number, begin, n, copies, length)
    owner = np.repeat(np.arange(len(n)), n)
    window = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
    edge = np.r_[True, owner[1:] != owner[:-1]]
    before = np.r_[False, again[:-1]] & ~edge
    after = np.r_[again[1:], False] & ~np.r_[edge[1:], True]
    opens, closes = np.flatnonzero(again & ~before), np.flatnonzero(again & ~after)
    found, words_of = set(), (-1, [])
    bodies = texts.to_pylist() if len(opens) else []
    for i, a, b in zip(owner[opens].tolist(), window[opens].tolist(), window[closes].tolist()):
        if a == 0 and b == n[i] - 1:
            found.add(bodies[i])
            continue
        if words_of[0] != i:
            words_of = (i, bodies[i].split(b" "))
        found.add(b" ".join(words_of[1][a : b + length]))
    return sorted(found)


def _confirmed(length: int):
    """Arrow function over (shard, n, text, copies) sorted by shard -> (shard, text) of the phrases."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, held = None, []

        def made() -> pa.RecordBatch:
            table = pa.Table.from_batches(held).combine_chunks()
            text = table.column("text").combine_chunks()
            text = text if isinstance(text, pa.Array) else pa.concat_arrays(text.chunks)
            found = phrases_of(text, table.column("n").to_numpy().astype(np.int64), table.column("copies").to_numpy(), length)
            return pa.RecordBatch.from_arrays([pa.array([shard] * len(found), pa.int64()), pa.array(found, pa.binary())], ["shard", "text"])

        for batch in batches:
            shards = batch.column("shard").to_numpy()
            cuts = np.r_[0, np.flatnonzero(shards[1:] != shards[:-1]) + 1, len(shards)] if len(shards) else np.zeros(1, int)
            for a, b in zip(cuts.tolist(), cuts[1:].tolist()):
                if shard is not None and shards[a] != shard:
                    yield made()
                    held = []
                shard = int(shards[a])
                held.append(batch.slice(a, b - a))
        if held:
            yield made()

    return run


class Automaton:
    """Aho-Corasick automaton over the word numbers of phrases."""

    def __init__(self, phrases: list[bytes]):
        self.number: dict[bytes, int] = {}
        self.words = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for phrase in phrases:
            key = tuple(self.number.setdefault(w, len(self.number) + 1) for w in phrase.split(b" "))
            self.words.add_word(key, len(key))
        self.words.make_automaton()

    def covered(self, text: bytes) -> list[tuple[int, int]]:
        """(from, to) of the runs of words that phrases cover."""
        number = self.number
        out: list[tuple[int, int]] = []
        for last, size in self.words.iter(tuple([number.get(w, 0) for w in text.split(b" ")])):
            low = last - size + 1
            while out and out[-1][1] >= low:  # joins what it touches
                low = min(low, out.pop()[0])
            out.append((low, last + 1))
        return out


def _located(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (shard, copy, kind, text, places): phrases of a shard first, then stretches -> (key, low, high) of covered words."""
    at, phrases, automaton = None, [], None
    for batch in batches:
        keys, low, high = [], [], []
        for shard, copy, kind, text, places in zip(*(c.to_pylist() for c in batch.columns)):
            if (shard, copy) != at:
                at, phrases, automaton = (shard, copy), [], None
            if kind == 0:
                phrases.append(text)
                continue
            if phrases and automaton is None:
                automaton = Automaton(phrases)
            covered = automaton.covered(text) if automaton else []
            if covered:
                place = np.frombuffer(places, PLACE)
                for a, b in covered:
                    keys.append(place["key"].tobytes())
                    low.append(place["first"] + a)
                    high.append(place["first"] + b)
        if keys:
            n = sum(map(len, low))
            key = pa.Array.from_buffers(pa.binary(16), n, [None, pa.py_buffer(b"".join(keys))]).cast(pa.binary())
            yield pa.RecordBatch.from_arrays([key, pa.array(np.concatenate(low).astype(np.int32)), pa.array(np.concatenate(high).astype(np.int32))], ["key", "low", "high"])


def _kept(with_text: bool):
    """Arrow function (key, text, spans) -> (key, n_words, n_removed, kept_sha256[, kept_text])."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, start, end = flat_bytes(batch.column("text"))
            lists = batch.column("spans")
            offsets = lists.offsets.to_numpy()
            low, high = (lists.values.field(name).to_numpy().astype(np.int64) for name in ("low", "high"))
            size = np.where(lists.is_valid().to_numpy(zero_copy_only=False), np.diff(offsets), 0)
            for part in chunks(start, end, CHUNK_BYTES):
                words = Words(data, start[part], end[part])
                edges = np.zeros(len(words.at) + 1, np.int64)
                for i in np.flatnonzero(size[part]) + part.start:
                    own = slice(offsets[i], offsets[i + 1])
                    np.add.at(edges, words.first[i - part.start] + low[own], 1)
                    np.add.at(edges, words.first[i - part.start] + high[own], -1)
                keep = np.cumsum(edges)[:-1] == 0
                body, at = words.joined(np.flatnonzero(keep))
                buffer = body.tobytes()
                kept = np.bincount(words.owner[keep], minlength=part.stop - part.start)
                ends = np.cumsum(kept)
                texts = [buffer[a : max(a, b - 1)] for a, b in zip(at[ends - kept].tolist(), at[ends].tolist())]
                columns = [batch.column("key").slice(part.start, part.stop - part.start), pa.array(words.count.astype(np.int64)), pa.array((words.count - kept).astype(np.int64)), pa.array([hashlib.sha256(t).hexdigest() for t in texts])]
                names = ["key", "n_words", "n_removed", "kept_sha256"]
                yield pa.RecordBatch.from_arrays(columns + [pa.array([t.decode() for t in texts])] * with_text, names + ["kept_text"] * with_text)

    return run


def _key(text: Column) -> Column:
    """128 bits of a digest of the text; a null text is empty."""
    return F.substring(F.unhex(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)), 1, 16)


def _bucketed(texts: DataFrame) -> tuple[DataFrame, Callable[[], None]]:
    """``texts`` as a table bucketed by key, and what drops its name."""
    spark = texts.sparkSession
    name = f"phrases_{uuid.uuid4().hex}"
    writer = texts.write.bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), "key").option("compression", "zstd")
    writer.saveAsTable(name, format="parquet", path=work_folder(spark, "texts"))
    return spark.table(name), lambda: spark.sql(f"DROP TABLE {name}")


def _tasks(spark: SparkSession, size: int) -> int:
    return max(2 * spark.sparkContext.defaultParallelism, -(-size // TASK_BYTES))


def _dealt(stretches: DataFrame, hot: DataFrame, length: int) -> DataFrame:
    """``stretches`` (anchor, n, text, copies, places) with ``deal``, which equal windows share; those of hot anchors by window."""
    marked = lookup_join(stretches, hot, ["anchor"], "left", written=True)
    cold = marked.where("hot IS NULL").select(F.xxhash64("anchor").alias("deal"), "n", "text", "copies", "places")
    if hot.isEmpty():
        return cold
    cut = marked.where("hot").select("n", "text", "copies", "places").mapInArrow(_by_window(length), "n int, text binary, copies long, places binary")
    return cold.unionByName(cut.select(F.xxhash64("text").alias("deal"), "n", "text", "copies", "places"))


def _spans(texts: DataFrame, length: int, keep: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """(key, low, high): the words from ``low`` to before ``high`` of a text go."""
    spark = texts.sparkSession
    runs = keep(texts.mapInArrow(_anchors(length), "anchor long, key binary, first int, n int, copies long"), "runs")
    # written, so that the join below is between two plain shuffles, which Spark can split where an anchor is frequent
    again = keep(runs.groupBy("anchor").agg(F.sum("copies").alias("places")).where("places > 1").select("anchor"), "again")
    own = runs.join(again, "anchor").groupBy("key").agg(F.collect_list(F.struct("first", "n", "anchor")).alias("runs"))
    own = keep(own, "own")  # runs of one text, at most as many as its words
    cut = texts.join(own, "key").select("key", "copies", "text", "runs")
    stretches = keep(cut.mapInArrow(_stretches(length), "anchor long, n int, text binary, copies long, places binary"), "stretches")

    counted = keep(stretches.groupBy("anchor", "n", "text").agg(F.sum("copies").alias("copies")), "counted")
    size = F.sum(F.octet_length("text"))
    hot = keep(counted.groupBy("anchor").agg(size.alias("size")).where(F.col("size") > HOT_BYTES).select("anchor", F.lit(True).alias("hot")), "hot")
    dealt = _dealt(counted.withColumn("places", F.lit(None).cast("binary")), hot, length)
    total = dealt.agg(size).first()[0] or 0
    shard = F.pmod("deal", F.lit(-(-total // SHARD_BYTES) or 1)).alias("shard")
    if not hot.isEmpty():
        dealt = dealt.groupBy("deal", "n", "text").agg(F.sum("copies").alias("copies"))
    dealt = dealt.select(shard, "n", "text", "copies").repartition(_tasks(spark, total), "shard").sortWithinPartitions("shard")
    found = keep(dealt.mapInArrow(_confirmed(length), "shard long, text binary"), "phrases")

    search = keep(_dealt(stretches, hot, length).select(shard, "text", "places"), "search")
    size = F.sum(F.octet_length("text") + F.octet_length("places")).alias("size")
    sizes = search.groupBy("shard").agg(size)
    total = sizes.agg(F.sum("size")).first()[0] or 0
    split = materialize(sizes.where(F.col("size") > COPY_BYTES).select("shard", F.ceil(F.col("size") / COPY_BYTES).alias("of")), "split")
    of = F.coalesce("of", F.lit(1))
    first = lookup_join(found, split, ["shard"], "left", written=True).select("shard", F.explode(F.sequence(F.lit(0).cast("long"), of - 1)).alias("copy"), F.lit(0).alias("kind"), "text", F.lit(None).cast("binary").alias("places"))
    then = lookup_join(search, split, ["shard"], "left", written=True).select("shard", F.pmod(F.xxhash64("places"), of).alias("copy"), F.lit(1).alias("kind"), "text", "places")
    stream = first.unionByName(then).repartition(_tasks(spark, total), "shard", "copy").sortWithinPartitions("shard", "copy", "kind")
    return keep(stream.mapInArrow(_located, "key binary, low int, high int"), "spans")


def remove_repeated(documents: DataFrame, length: int = LENGTH, with_text: bool = False) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) of every document, and ``kept_text`` if asked for.

    A word goes if ``length`` consecutive words of its document, it among them, also stand elsewhere, in another document
    or the same one; the first occurrence goes like the others.  Words are stretches without ASCII white space, as they
    are.  What stays is joined by single blanks.  A null text has no words; one with fewer words than ``length`` stays
    whole.  Repeated rows are documents of their own, so both lose what they share; a null doc_id is kept as null.  Other
    columns are left out, and an empty table gives no rows.
    """
    if length < 1:
        raise ValueError("a window has at least one word")
    docs = documents.select("doc_id", _key(F.col("text")).alias("key"), F.coalesce("text", F.lit("")).alias("text"))
    texts, drop = _bucketed(docs.groupBy("key").agg(F.count("*").alias("copies"), F.first("text").alias("text")))
    try:
        with scratch(documents.sparkSession) as keep:
            spans_of = _spans(texts, length, keep).groupBy("key").agg(F.collect_list(F.struct("low", "high")).alias("spans"))
            marked = texts.join(spans_of, "key", "left").select("key", "text", "spans")
            schema = "key binary, n_words long, n_removed long, kept_sha256 string" + ", kept_text string" * with_text
            done = materialize(marked.mapInArrow(_kept(with_text), schema), "kept")
    finally:
        drop()
    return lookup_join(docs.select("doc_id", "key"), done, ["key"], written=True).drop("key")
