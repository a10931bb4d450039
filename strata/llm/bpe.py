"""Byte-level BPE by the ranks of a vocabulary file.

A text is split by the pattern of the rank files (``split``), and every word's
bytes are merged by rank: a fold with Spark's higher-order functions over the
array of the word's adjacent pairs, each looked up in a literal rank map. The
state of the fold is a string with one character for each piece, the character
being that of the piece's id, so a merge is one ``replace``. Words are merged
once: the most frequent ones (as many as ``dictionary`` allows) in a table of
distinct words that every task gets, the others where they stand. Decoding
concatenates the pieces' bytes.

In a vocabulary that was trained as such, every token is the merge of two
earlier ones, and a span that makes up a token has by then been merged as the
token alone would be. So one rank has one pair, and all its places can be
merged at once; ``Ranks`` checks this and refuses other files.
"""

from __future__ import annotations

import base64
import functools
import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import staged, tidy

#: Fixed value: how the rank files' tokenizers split a text.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_OTHER, _LETTER, _NUMBER, _SPACE = range(4)
_CHUNK = 3 << 20  # bytes of text that are split at a time (a longer text goes alone)
_COUNTED = 200_000  # distinct words that a task counts before it hands them on
_BUCKETS = 1 << 16
_DONE = "\u0001"  # before a word without another merge
_RAW = "\u0002"  # before a word that is still to be merged


def _character(token: int) -> str:
    """The character that stands for an id: no control character and no surrogate."""
    return chr(token + 0x100 if token < 0xD700 else token + 0x900)


def _tokens(codes: np.ndarray) -> np.ndarray:
    """Ids of characters' code points."""
    codes = codes.astype(np.int32)
    return np.where(codes < 0xD800, codes - 0x100, codes - 0x900)


class Ranks:
    """A rank file: lines of a token's bytes in base64 and its rank, which is its id."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        size = max(self.ranks.values()) + 1
        if size > 0xF700 or any(bytes([b]) not in self.ranks for b in range(256)):
            raise ValueError(f"{path}: up to {0xF700} ids, all single bytes among them, are supported")
        self.tokens = [b""] * size
        for token, rank in self.ranks.items():
            self.tokens[rank] = token
        buckets: list[dict] = [{} for _ in range(_BUCKETS)]
        for token, rank in self.ranks.items():
            if len(token) > 1:
                pair = "".join(_character(self.ranks[part]) for part in self._parts(token, rank))
                buckets[zlib.crc32(pair.encode()) % _BUCKETS][pair] = _character(rank) + pair
        self.rules = json.dumps(buckets, ensure_ascii=False, separators=(",", ":"))

    def _parts(self, token: bytes, rank: int) -> list[bytes]:
        """The two tokens that lower ranks merge a token's bytes to."""
        parts = [token[i:i + 1] for i in range(len(token))]
        while len(parts) > 2:
            best, at = min((self.ranks.get(parts[i] + parts[i + 1], rank), i) for i in range(len(parts) - 1))
            if best >= rank:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        if len(parts) != 2:
            raise ValueError(f"{token!r} is not the merge of two tokens of lower rank")
        return parts

    def merged(self, word: Column) -> Column:
        """A word's pieces, one character each: its bytes, merged by rank until no pair has a rank."""
        rules = F.from_json(F.lit(self.rules), "array<map<string,string>>")

        def rule(pair: Column) -> Column:  # the merged piece and the pair; null if it has no rank
            return rules[(F.crc32(pair.cast("binary")) % _BUCKETS).cast("int")][pair]

        def apply(pieces: Column, best: Column) -> Column:
            return F.coalesce(F.replace(pieces, F.substring(best, 2, 2), F.substring(best, 1, 1)),
                              F.concat(F.lit(_DONE), pieces))

        def step(pieces: Column, _: Column) -> Column:
            pairs = F.regexp_extract_all(pieces, F.lit("(?=(..))"), F.lit(1))
            best = F.array_min(F.transform(pairs, rule))  # characters sort as their ids
            return F.when(F.startswith(pieces, F.lit(_DONE)), pieces).otherwise(F.aggregate(F.array(best), pieces, apply))

        singles = "".join(map(chr, range(256)))
        pieces = "".join(_character(self.ranks[bytes([b])]) for b in range(256))
        start = F.translate(F.decode(word.cast("binary"), "ISO-8859-1"), singles, pieces)
        return F.ltrim(F.aggregate(F.sequence(F.lit(1), F.octet_length(word)), start, step), F.lit(_DONE))


@functools.cache
def _classes() -> np.ndarray:
    """Class of every code point."""
    out = np.full(0x110000, _OTHER, np.int8)
    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    for name, kind in ((r"\p{L}", _LETTER), (r"\p{N}", _NUMBER), (r"\s", _SPACE)):
        out[[ord(c) for c in regex.findall(name, every)]] = kind
    return out


def _words(texts: pa.StringArray) -> tuple[pa.StringArray, np.ndarray]:
    """The matches of ``PATTERN`` in texts (none is null), text by text, and where in them each text's begin."""
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = data.slice(offsets[0], offsets[-1] - offsets[0]) if data is not None else pa.py_buffer(b"")
    codes = np.frombuffer(str(data, "utf-8").encode("utf-32-le"), np.uint32)
    n = len(codes)
    width = np.ones(n, np.int8)
    for least in (0x80, 0x800, 0x10000):
        width += codes >= least
    at_byte = np.zeros(n + 1, np.int32)
    np.cumsum(width, out=at_byte[1:])
    first = np.searchsorted(at_byte, offsets - offsets[0])
    kind = _classes()[codes]
    begins = np.zeros(n + 4, bool)
    begins[first] = True
    begins[n:] = True
    run = begins.copy()
    run[1:n] |= kind[1:] != kind[:-1]
    cut = run.copy()
    # of white space before a word the last character stands alone, and a blank goes with the word
    last = np.flatnonzero(run[1:n] & ~begins[1:n] & (kind[:-1] == _SPACE))
    cut[last] = True
    cut[last[codes[last] == 0x20] + 1] = False
    # an apostrophe that starts a word takes certain letters with it
    mark = np.flatnonzero((codes == 0x27) & run[:n] & cut[:n])
    mark = mark[~begins[mark + 1]]
    after = np.concatenate([codes, np.zeros(3, np.uint32)])
    one, two = after[mark + 1], np.where(begins[mark + 2], 0, after[mark + 2])
    short = np.isin(one, [ord(c) for c in "stmd"])
    long = np.zeros(len(mark), bool)
    for x, y in ("re", "ve", "ll"):
        long |= (one == ord(x)) & (two == ord(y))
    cut[mark[short | long] + 1] = False
    cut[mark[short] + 2] = True
    cut[mark[long] + 3] = True
    starts = np.flatnonzero(cut[:n])
    bounds = pa.py_buffer(np.append(at_byte[starts], at_byte[-1]).astype(np.int32))
    return pa.StringArray.from_buffers(len(starts), bounds, data), np.searchsorted(starts, first)


def split(texts: list[str]) -> list[list[str]]:
    """The matches of ``PATTERN`` in each text, in order; none in an empty one."""
    words, bounds = _words(pa.array(texts, pa.string()))
    return [words[a:b].to_pylist() for a, b in zip(bounds, bounds[1:])]


def _chunks(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[tuple[pa.RecordBatch, pa.StringArray]]:
    """Rows with about ``_CHUNK`` bytes of text, and their texts with null as empty."""
    for batch in batches:
        if not batch.num_rows:
            continue
        texts = pc.fill_null(batch.column(text), "").cast(pa.string())
        ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
        at = 0
        while at < len(ends):
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + _CHUNK, side="right")))
            yield batch.slice(at, to - at), texts.slice(at, to - at)
            at = to


def word_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``(word, n)``: how often each distinct word occurs in all texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []

        def counted() -> pa.Table:
            return pa.concat_tables(held).group_by("word").aggregate([("n", "sum")]).rename_columns(["word", "n"])

        for _, texts in _chunks(batches, text):
            words, _ = _words(texts)
            found = pc.value_counts(words)
            held.append(pa.table({"word": found.field("values"), "n": found.field("counts")}))
            if sum(t.num_rows for t in held) > 2 * _COUNTED:
                held = [counted()]
                if held[0].num_rows > _COUNTED:
                    yield from held.pop().to_batches()
        if held:
            yield from counted().to_batches()

    rows = docs.select(text).mapInArrow(tidy(run), "word string, n long")
    return rows.groupBy("word").agg(F.sum("n").alias("n"))


def frequent_words(counts: DataFrame, most: int, longest: int = 32) -> DataFrame:
    """The words of at most ``longest`` bytes above a frequency that at most ``most`` of them reach.

    The frequency comes from a count of words by the logarithm of their frequency, so no task
    sorts or gathers the words."""
    short = counts.where(F.octet_length("word") <= longest)
    level = F.floor(F.log2("n") * 8).cast("int")
    found = short.groupBy(level.alias("level")).count().orderBy(F.desc("level")).collect()  # a few hundred rows
    total, least = 0, 1 << 30
    for row in found:
        total += row["count"]
        if total > most:
            break
        least = row["level"]
    return short.where(level >= least)


def encode(docs: DataFrame, ranks: Ranks, text: str = "text", ids: str = "ids", dictionary: int = 1_000_000) -> DataFrame:
    """``docs`` with the array ``ids`` of each whole text's token ids, as the rank file gives them without
    special tokens (a column of that name is replaced). Null and empty texts have none; repeated rows and
    null ids are rows like others; no rows give no rows. ``dictionary`` bounds the words that are merged
    beforehand and sent to all tasks (each of 32 bytes at most); it changes no result."""
    counts = staged(word_counts(docs, text), "bpe-words")
    common = staged(frequent_words(counts, dictionary).select("word", ranks.merged(F.col("word")).alias("pieces")), "bpe-common")
    known = common.toArrow()
    sent = docs.sparkSession.sparkContext.broadcast(known.combine_chunks())
    rest = [c for c in docs.columns if c != ids]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = sent.value
        known_words, known_pieces = (pa.concat_arrays(table.column(c).chunks or [pa.array([], pa.string())]) for c in range(2))
        for rows, texts in _chunks(batches, text):
            words, bounds = _words(texts)
            pieces = known_pieces.take(pc.index_in(words, known_words))
            unknown = pc.is_null(pieces)
            pieces = pc.if_else(unknown, pc.binary_join_element_wise(_RAW, words, ""), pieces)
            # an unknown word stands alone, known ones between two of them are joined
            unknown = unknown.to_numpy(zero_copy_only=False)
            starts = np.ones(len(words) + 1, bool)
            starts[1:-1] = unknown[1:] | unknown[:-1]
            starts[bounds] = True
            starts = np.flatnonzero(starts)
            parts = pc.binary_join(_lists(starts, pieces), "") if len(words) else pieces
            column = _lists(np.searchsorted(starts, bounds), parts)
            yield pa.RecordBatch.from_arrays([*(rows.column(c) for c in rest), column], [*rest, ids])

    schema = T.StructType([*docs.select(*rest).schema.fields, T.StructField(ids, T.ArrayType(T.StringType()))])
    found = docs.select(*rest).mapInArrow(tidy(run), schema)
    pieces = F.array_join(F.transform(ids, lambda x: F.when(
        F.startswith(x, F.lit(_RAW)), ranks.merged(F.substring(x, 2, 1 << 30))).otherwise(x)), "")
    return _as_ids(found.withColumn(ids, F.encode(pieces, "UTF-16LE")), ids)


def _lists(bounds: np.ndarray, values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), values)


def _as_ids(rows: DataFrame, ids: str) -> DataFrame:
    """Characters of pieces (two bytes each) as an array of ids."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(ids)
            units = [np.frombuffer(v.as_buffer(), np.uint16) for v in batch.column(at)]
            ends = np.concatenate([[0], np.cumsum([len(u) for u in units])]).astype(np.int32)
            flat = _tokens(np.concatenate([np.empty(0, np.uint16), *units]))
            column = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, pa.int32()))
            yield batch.set_column(at, ids, column)

    fields = [f if f.name != ids else T.StructField(ids, T.ArrayType(T.IntegerType())) for f in rows.schema.fields]
    return rows.mapInArrow(tidy(run), T.StructType(fields))


def decode(rows: DataFrame, ranks: Ranks, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """``rows`` with the bytes ``into`` that the ids stand for (null ids: none; a column of that name is
    replaced). An id that the vocabulary lacks fails the job."""
    tokens = ranks.tokens

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = pa.array(tokens, pa.binary())
        for batch in batches:
            if batch.num_rows:
                column = pc.fill_null(batch.column(ids), [])
                bounds = column.offsets.to_numpy()
                found = pieces.take(column.flatten())
                texts = pc.binary_join(_lists(bounds - bounds[0], found), b"")
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in rest), texts], [*rest, into])

    rest = [c for c in rows.columns if c != into]
    schema = T.StructType([*rows.select(*rest).schema.fields, T.StructField(into, T.BinaryType())])
    return rows.select(*rest).mapInArrow(tidy(run), schema)
