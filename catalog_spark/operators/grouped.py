"""Term counts of texts in groups: what leaves a group is packed, and no (text, term) row is shuffled.

A group holds the texts of about one task.  Its different terms, sorted and compressed, go to the parts that a hash deals
the terms to, where their numbers are added up; what a part finds out about its terms goes back to the groups in the same
order.  Counts within a text never leave its group: they are counted again where they are wanted, which takes less time
than writing them and far less disk.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_type

from ..session import materialize, release, remove, work_folder

WIDTHS = (np.uint8, np.uint16, np.uint32, np.int64)
BATCH = 100_000  # rows that a group hands on at once
SHARES = 2
ONE_NUMBER = 1 << 62  # a term and a text are sorted as one number below this


@dataclass(frozen=True)
class GroupedCounts:
    """Texts as words, (__group, row_id, __words), dealt by group; their terms go to ``parts`` parts."""

    texts: DataFrame
    row_id: str
    groups: int
    parts: int
    share: Column | None = None  # which groups these are, if not all
    whole: GroupedCounts | None = None

    def split(self) -> list[GroupedCounts]:
        """The same in up to ``SHARES`` shares, none of fewer groups than there are cores: what is shuffled of one can go before the next."""
        n = max(1, min(SHARES, self.groups // self.texts.sparkSession.sparkContext.defaultParallelism))
        shares = [F.col("__group") % n == i for i in range(n)]
        return [replace(self, texts=self.texts.where(share), share=share, whole=self) for share in shares] if n > 1 else [self]


def squeeze(values: np.ndarray) -> bytes:
    """Whole numbers in the narrowest of ``WIDTHS``, compressed; their size and width stand in front."""
    low, high = (int(values.min()), int(values.max())) if len(values) else (0, 0)
    kind = next((i for i, width in enumerate(WIDTHS[:3]) if low >= 0 and high <= np.iinfo(width).max), 3)
    plain = values.astype(WIDTHS[kind]).tobytes()
    return bytes([kind]) + len(plain).to_bytes(8, "little") + pa.compress(plain, "zstd", asbytes=True)


def stretch(packed: bytes) -> np.ndarray:
    """The array of ``squeeze``."""
    return np.frombuffer(pa.decompress(packed[9:], int.from_bytes(packed[1:9], "little"), "zstd"), WIDTHS[packed[0]])


def squeeze_terms(terms: pa.Array) -> bytes:
    """Terms, which have no line ends."""
    plain = pc.binary_join(pa.ListArray.from_arrays([0, len(terms)], terms), "\n")[0].as_buffer()
    return plain.size.to_bytes(8, "little") + pa.compress(plain, "zstd", asbytes=True)


def stretch_terms(packed: bytes) -> pa.Array:
    plain = pa.decompress(packed[8:], int.from_bytes(packed[:8], "little"), "zstd", asbytes=True)
    return pc.split_pattern(pa.array([plain], pa.binary()).view(pa.string()), "\n").flatten()


@dataclass(frozen=True)
class Counted:
    """The counts of one group: pairs (term, text) in order, their number, and the terms in order, which depends on the set of words only."""

    ids: pa.Array
    row: np.ndarray  # of ids, by pair
    term: np.ndarray  # by pair
    tf: np.ndarray
    words: pa.Array
    first: np.ndarray  # words of the terms, the second -1 where there is none
    second: np.ndarray

    def terms(self, chosen: np.ndarray) -> pa.Array:
        first, second = self.words.take(pa.array(self.first[chosen])), self.second[chosen]
        pairs = pc.binary_join_element_wise(first, self.words.take(pa.array(np.maximum(second, 0))), " ")
        return pc.if_else(pa.array(second < 0), first, pairs)

    def dealt(self, parts: int) -> list[np.ndarray]:
        """The terms of each part, in order."""
        if not len(self.first):
            return [np.zeros(0, np.int64)] * parts
        own = pd.util.hash_array(self.words.to_numpy(zero_copy_only=False), categorize=False)
        mixed = np.where(self.second < 0, own[self.first], own[self.first] * np.uint64(0x9E3779B97F4A7C15) + own[self.second])
        part = ((mixed * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(33)) % np.uint64(parts)
        order = np.argsort(part, kind="stable")
        return np.split(order, np.searchsorted(part[order], np.arange(1, parts, dtype=np.uint64)))


def count_terms(texts: pa.Table, row_id: str) -> Counted:
    """Uni- and bigrams of a group of texts; texts with one id count as one, and no pair crosses from one to the next."""
    encoded = pc.dictionary_encode(pa.concat_arrays(texts.column(row_id).chunks), null_encoding="encode")
    lists = pa.concat_arrays(texts.column("__words").chunks)
    text = np.repeat(np.arange(len(lists)), np.asarray(pc.fill_null(pc.list_value_length(lists), 0)))
    found = pc.dictionary_encode(lists.flatten())
    order = np.asarray(pc.sort_indices(found.dictionary)).astype(np.int64)
    words, rank = found.dictionary.take(pa.array(order)), np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    word = rank[np.asarray(found.indices)] if len(text) else np.zeros(0, np.int64)
    base = len(words) + 1
    inner = text[1:] == text[:-1]
    code = np.concatenate([word * base, (word[:-1] * base + word[1:] + 1)[inner]])
    row = np.asarray(encoded.indices)[np.concatenate([text, text[1:][inner]])]
    del found, rank, word, text, inner
    grams, ids = len(code), max(len(encoded.dictionary), 1)
    if base * base * ids < ONE_NUMBER:
        code *= ids
        code += row
        code.sort()
        starts = np.flatnonzero(np.diff(code, prepend=-1))
        code, row = np.divmod(code[starts], ids)
    else:
        order = np.lexsort((row, code))
        code, row = code[order], row[order]
        starts = np.flatnonzero((np.diff(code, prepend=-1) != 0) | (np.diff(row, prepend=-1) != 0))
        code, row = code[starts], row[starts]
    tf = np.diff(starts, append=grams).astype(np.int32)
    new = np.diff(code, prepend=-1) != 0
    first, second = np.divmod(code[new], base)
    return Counted(encoded.dictionary, row.astype(np.int32), np.cumsum(new, dtype=np.int32) - 1, tf, words, first, second - 1)


def _count(row_id: str, parts: int) -> Callable:
    """For each part the terms of a group, their texts and their number."""

    def run(key: tuple[pa.Scalar], texts: pa.Table) -> pa.Table:
        got = count_terms(texts, row_id)
        n = len(got.first)
        df, total = np.bincount(got.term, minlength=n), np.bincount(got.term, got.tf, minlength=n).astype(np.int64)
        dealt = [(p, own) for p, own in enumerate(got.dealt(parts)) if len(own)]
        rows = [(p, key[0].as_py(), squeeze_terms(got.terms(own)), squeeze(df[own]), squeeze(total[own])) for p, own in dealt]
        names = ["part", "__group", "terms", "df", "total"]
        types = [pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
        return pa.table([pa.array(column, t) for column, t in zip(zip(*rows) if rows else [()] * 5, types)], names=names)

    return run


def _add_up(least: int) -> Callable:
    """The terms of a part that enough texts have, numbered in order; and for each group the numbers of its terms (from 1, 0 if left out)."""

    def run(key: tuple[pa.Scalar], blocks: pa.Table) -> pa.Table:
        lists = [stretch_terms(x) for x in blocks.column("terms").to_pylist()]
        ends = np.cumsum([len(x) for x in lists])
        found = pc.dictionary_encode(pa.concat_arrays(lists))
        del lists
        at, n = np.asarray(found.indices), len(found.dictionary)
        df, total = (
            np.bincount(at, np.concatenate([stretch(x) for x in blocks.column(c).to_pylist()]), minlength=n).astype(np.int64) for c in ("df", "total")
        )
        kept = np.flatnonzero(df >= least)
        kept = kept[np.asarray(pc.sort_indices(found.dictionary.take(pa.array(kept)))).astype(np.int64)]
        number = np.zeros(n, np.int64)
        number[kept] = np.arange(1, len(kept) + 1)
        answers = [squeeze(number[x]) for x in np.split(at, ends[:-1])]
        m, g = len(kept), blocks.num_rows
        nulls = lambda k, t: pa.nulls(k, t)
        columns = {
            "part": pa.array(np.full(m + g, key[0].as_py(), np.int32)),
            "number": pa.concat_arrays([pa.array(np.arange(1, m + 1)), nulls(g, pa.int64())]),
            "term": pa.concat_arrays([found.dictionary.take(pa.array(kept)), nulls(g, pa.string())]),
            "df": pa.concat_arrays([pa.array(df[kept]), nulls(g, pa.int64())]),
            "total": pa.concat_arrays([pa.array(total[kept]), nulls(g, pa.int64())]),
            "__group": pa.concat_arrays([nulls(m, pa.int32()), pa.array(blocks.column("__group").to_pylist(), pa.int32())]),
            "numbers": pa.concat_arrays([nulls(m, pa.binary()), pa.array(answers, pa.binary())]),
        }
        return pa.table(columns)

    return run


def _answer(key: tuple[pa.Scalar], asked: pa.Table, vocabulary: pa.Table) -> pa.Table:
    """For each group which of its terms of this part the vocabulary has, their positions (as differences) and df."""
    number = vocabulary.column("number").to_numpy()
    rows = []
    for group, packed in zip(asked.column("__group").to_pylist(), asked.column("numbers").to_pylist()):
        wanted = stretch(packed).astype(np.int64)
        size = int(max(wanted.max(initial=0), number.max(initial=0))) + 1
        position, df = np.zeros((2, size), np.int64)
        position[number] = vocabulary.column("position").to_numpy() + 1
        df[number] = vocabulary.column("df").to_numpy()
        there = position[wanted] > 0
        known = wanted[there]
        rows.append((key[0].as_py(), group, squeeze(np.packbits(there)), squeeze(np.diff(position[known], prepend=0)), squeeze(df[known])))
    types = [pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
    return pa.table([pa.array(column, t) for column, t in zip(zip(*rows) if rows else [()] * 5, types)], names=["part", "__group", "there", "position", "df"])


def _weigh(row_id: str, id_type: pa.DataType, parts: int, documents: int, with_terms: bool) -> Callable:
    """(row_id, position, weight), with the term if wanted: tf x idf, the rows of each text scaled to unit length."""
    names = [row_id, "position", "weight", *(["term"] if with_terms else [])]
    types = [id_type, pa.int32(), pa.float64(), *([pa.string()] if with_terms else [])]

    def run(texts: pa.Table, answers: pa.Table) -> pa.Table:
        if not texts.num_rows or not answers.num_rows:
            return pa.table([pa.array([], t) for t in types], names=names)
        got = count_terms(texts, row_id)
        dealt = got.dealt(parts)
        position, idf = np.full(len(got.first), -1, np.int64), np.zeros(len(got.first))
        for answer in answers.to_pylist():
            own = dealt[answer["part"]]
            own = own[np.unpackbits(stretch(answer["there"]), count=len(own)).astype(bool)]
            position[own] = np.cumsum(stretch(answer["position"]).astype(np.int64)) - 1
            idf[own] = np.log((1.0 + documents) / (stretch(answer["df"]).astype(np.int64) + 1)) + 1.0
        known = np.flatnonzero(position[got.term] >= 0)
        row, term = got.row[known], got.term[known]
        weight = got.tf[known] * idf[term]
        weight /= np.sqrt(np.bincount(row, weight * weight, minlength=len(got.ids)))[row]
        batches = []
        for at in range(0, len(known), BATCH):
            part = slice(at, at + BATCH)
            columns = [got.ids.take(pa.array(row[part])).cast(id_type), pa.array(position[term[part]], pa.int32()), pa.array(weight[part])]
            batches.append(pa.record_batch(columns + ([got.terms(term[part])] if with_terms else []), names=names))
        return pa.Table.from_batches(batches, pa.schema(list(zip(names, types))))

    return run


def count_parts(counts: GroupedCounts, least: int) -> tuple[DataFrame, Callable[[], None]]:
    """A written table of two kinds of rows, and how to drop it.

    (part, number, term, df, total) of the terms that ``least`` texts have, and (part, __group, numbers) of all groups.
    """
    spark = counts.texts.sparkSession
    path = work_folder(spark, "parts")
    blocks = counts.texts.groupBy("__group").applyInArrow(_count(counts.row_id, counts.parts), "part int, __group int, terms binary, df binary, total binary")
    found = blocks.groupBy("part").applyInArrow(_add_up(least), "part int, number long, term string, df long, total long, __group int, numbers binary")
    found.write.option("compression", "zstd").parquet(path)
    schema = found.schema
    del blocks, found
    release(spark)
    return spark.read.schema(schema).parquet(path), lambda: remove(spark, path)


def answers(found: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(part, __group, there, position, df): the vocabulary's (part, number, position, df) as the groups asked, written."""
    asked = found.where("__group IS NOT NULL").select("part", "__group", "numbers").groupBy("part")
    known = vocabulary.select("part", "number", "position", "df").groupBy("part")
    return materialize(asked.cogroup(known).applyInArrow(_answer, "part int, __group int, there binary, position binary, df binary"), "answers")


def weights(counts: GroupedCounts, answered: DataFrame, documents: int, with_terms: bool) -> DataFrame:
    """(row_id, position, weight), with the term if wanted, of all texts."""
    field = counts.texts.schema[counts.row_id]
    fields = [T.StructField(counts.row_id, field.dataType), T.StructField("position", T.IntegerType()), T.StructField("weight", T.DoubleType())]
    if with_terms:
        fields.append(T.StructField("term", T.StringType()))
    run = _weigh(counts.row_id, to_arrow_type(field.dataType), counts.parts, documents, with_terms)
    asked = answered if counts.share is None else answered.where(counts.share)
    return counts.texts.groupBy("__group").cogroup(asked.groupBy("__group")).applyInArrow(run, T.StructType(fields))
