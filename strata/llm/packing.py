"""Vector bin packing of token sequences (dot-product heuristic).

Every document becomes its token ids plus an end id. Full windows of
``capacity`` ids are sequences of their own; the rest of each document is an
item with three demands: tokens, one segment, and loss-bearing tokens. A
sequence is filled by repeatedly placing the fitting item with the largest
dot product of its demands and the room that is left (both as shares of the
limits). When no item fits, the largest one is cut to fill the room, and its
rest goes back to the pool.

Packing runs inside each input partition with a bounded pool, so no row is
shuffled and no key can be hot. What is left at the end of a partition is laid
out in sequences whose lengths are powers of two, which need no padding.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import tidy

PIECES = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("start", T.LongType()),
    T.StructField("length", T.LongType()),
    T.StructField("ids", T.BinaryType()),
    T.StructField("doc_tokens", T.LongType()),
    T.StructField("loss_tokens", T.LongType()),
    T.StructField("sequence_id", T.LongType()),
    T.StructField("offset", T.LongType()),
])

_ARROW = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()),
                    ("doc_tokens", pa.int64()), ("loss_tokens", pa.int64()), ("sequence_id", pa.int64()),
                    ("offset", pa.int64())])


#: Texts of about two to the power of this many bytes are encoded at a time.
_TEXTS = 21


def _runs(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The indexes begin[0], begin[0] + 1, ... (size[0] of them), begin[1], ..."""
    ends = np.cumsum(size)
    return np.repeat(begin - (ends - size), size) + np.arange(int(ends[-1]) if len(ends) else 0)


def _bounds(group: np.ndarray) -> tuple[list[int], list[int]]:
    """Starts and ends of the runs of equal values."""
    cuts = (np.flatnonzero(np.diff(group)) + 1).tolist()
    return ([0, *cuts], [*cuts, len(group)]) if len(group) else ([], [])


class _Ids:
    """Id sequences end to end, one of each number."""

    def __init__(self, flat: np.ndarray, sizes: np.ndarray):
        self.flat, self.sizes = flat, sizes
        self.start = np.cumsum(sizes) - sizes

    def add(self, more: _Ids):
        self.__init__(np.concatenate([self.flat, more.flat]), np.concatenate([self.sizes, more.sizes]))

    def of(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        size = self.sizes[codes]
        return self.flat[_runs(self.start[codes], size)], size


def _numbered(values: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """The number of each value, and the distinct values by number."""
    coded = values.dictionary_encode()
    return coded.indices.to_numpy().astype(np.int64), coded.dictionary


class WordEncoder:
    """Token ids of whole texts; each distinct word is looked up once a call, and the
    ids of distinct parts of words are remembered up to a bound.

    The tokenizer drops white space and never joins characters across it, so a
    text's ids are those of its words in order. Texts are cut at blanks and
    line feeds only; any other white space stays inside a "word" and is left to
    the tokenizer. A word of letters with marks behind it has the ids of the
    letters and those of the marks. Plain Latin letters are lower-cased here,
    which is all that the tokenizer's normaliser does to them, and are encoded
    without it, many at once; the end of each shows in its last id, whose token
    carries the end-of-word suffix.
    """

    LIMIT = 300_000
    SLICE = 2_000
    #: Latin letters (without the one whose lower case is two characters), then marks other than the apostrophe
    PLAIN = "^(?P<core>[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f]+)(?P<marks>[!\"#$%&()*+,./:;<=>?@^_`{|}~-]*)$"
    LOWER = "^[a-z\u00df-\u00f6\u00f8-\u024f]+$"

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.whole = Tokenizer.from_file(path)
        suffix = getattr(self.whole.model, "end_of_word_suffix", None)
        self.letters = None
        if suffix:
            self.letters = Tokenizer(self.whole.model)  # the same vocabulary in memory, not another
            self.letters.pre_tokenizer = self.whole.pre_tokenizer
            self.is_end = np.array([(self.whole.id_to_token(i) or "").endswith(suffix)
                                    for i in range(self.whole.get_vocab_size())])
        self._reset()

    def _reset(self):
        self.parts = pa.array([], pa.large_string())
        self.part_ids = _Ids(np.empty(0, np.uint32), np.empty(0, np.int64))

    def _sliced(self, encode: Callable, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """``encode`` on ``SLICE`` words at a time: what it makes of a word beside its ids takes far more memory."""
        found = [encode(words[k:k + self.SLICE]) for k in range(0, len(words), self.SLICE)]
        ids, sizes = zip(*found)
        return np.concatenate(ids), np.concatenate(sizes)

    def _whole(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids = [e.ids for e in self.whole.encode_batch_fast(words, add_special_tokens=False)]
        return (np.fromiter((i for x in ids for i in x), np.uint32),
                np.fromiter(map(len, ids), np.int64, len(ids)))

    def _letters(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids = np.array(self.letters.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, np.uint32)
        ends = np.flatnonzero(self.is_end[ids]) + 1
        if len(ends) != len(words):  # the suffix doesn't mark the ends of these words
            return self._whole(words)
        return ids, np.diff(ends, prepend=0)

    def _known(self, parts: pa.Array) -> np.ndarray:
        """The numbers of distinct parts among those remembered; new ones are learned."""
        if len(self.parts) > self.LIMIT:
            self._reset()
        at = pc.index_in(parts, self.parts)
        fresh = at.is_null().to_numpy(zero_copy_only=False)
        codes = at.fill_null(0).to_numpy().astype(np.int64)
        codes[fresh] = len(self.parts) + np.arange(int(fresh.sum()))
        new = parts.filter(pa.array(fresh))
        self.part_ids.add(self._ids_of(new))
        self.parts = pa.concat_arrays([self.parts, new])
        return codes

    def _ids_of(self, parts: pa.Array) -> _Ids:
        """Ids of distinct parts: plain lower-case letters together, the rest one by one."""
        plain = np.zeros(len(parts), bool)
        if self.letters is not None:
            plain = pc.and_(pc.utf8_is_lower(parts), pc.match_substring_regex(parts, self.LOWER)).to_numpy(zero_copy_only=False)
        sizes = np.zeros(len(parts), np.int64)
        found = []
        for chosen, encode in ((plain, self._letters), (~plain, self._whole)):
            if chosen.any():
                got, sizes[chosen] = self._sliced(encode, parts.filter(pa.array(chosen)).to_pylist())
                found.append((np.flatnonzero(chosen), got))
        ends = np.cumsum(sizes)
        ids = np.empty(int(ends[-1]) if len(ends) else 0, np.uint32)
        for which, got in found:
            ids[_runs((ends - sizes)[which], sizes[which])] = got
        return _Ids(ids, sizes)

    def _of_words(self, words: pa.Array) -> _Ids:
        """Ids of distinct words: of their letters, then of the marks behind these."""
        split = pc.extract_regex(words, self.PLAIN)
        core = pc.coalesce(pc.utf8_lower(pc.struct_field(split, "core")), words)
        marks = pc.coalesce(pc.struct_field(split, "marks"), pa.scalar("", pa.large_string()))
        code, parts = _numbered(pa.concat_arrays([core, marks]))
        known = self._known(parts)
        ids, sizes = self.part_ids.of(known[code.reshape(2, -1).T.ravel()])
        return _Ids(ids, sizes.reshape(-1, 2).sum(axis=1))

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of each text; a null is empty."""
        if not len(texts):
            return []
        texts = pc.replace_substring(pc.fill_null(texts.cast(pa.large_string()), ""), "\n", " ")
        words = pc.split_pattern(texts, " ")
        code, distinct = _numbered(words.flatten())
        ids, sizes = self._of_words(distinct).of(code)
        last = np.cumsum(pc.list_value_length(words).to_numpy()) - 1
        return np.split(ids, np.cumsum(sizes)[last[:-1]])


class Packer:
    """Fills sequences from a pool of items under three limits."""

    def __init__(self, capacity: int, max_segments: int, max_loss: int, first_id: int):
        self.limits = np.array([capacity, max_segments, max_loss], float)
        self.capacity, self.max_segments, self.max_loss = capacity, max_segments, max_loss
        self.next_id = first_id
        self.pool: list[tuple] = []  # (doc_id, ids of the document, its loss-bearing tokens, start)
        self.rows: list[tuple] = []

    @staticmethod
    def loss(total: int, loss: int, start: int, end: int) -> int:
        """Loss-bearing tokens of a piece: they are the last ``loss`` of the document."""
        return max(0, end - max(start, total - loss))

    def emit(self, pieces: list[tuple]):
        offset = 0
        for doc, ids, loss, start, end in pieces:
            self.rows.append((doc, start, end - start, ids[start:end].tobytes(), len(ids),
                              self.loss(len(ids), loss, start, end), self.next_id, offset))
            offset += end - start
        self.next_id += 1

    def add(self, doc, ids: np.ndarray, loss: int):
        start = 0
        while len(ids) - start >= self.capacity and self.loss(len(ids), loss, start, start + self.capacity) <= self.max_loss:
            self.emit([(doc, ids, loss, start, start + self.capacity)])
            start += self.capacity
        if start < len(ids):
            self.pool.append((doc, ids, loss, start))

    def pack(self, keep: int):
        """Fill sequences until at most ``keep`` items are in the pool."""
        pool = self.pool
        tokens = np.array([len(i) - s for _, i, _, s in pool], float)
        losses = np.array([self.loss(len(i), lo, s, len(i)) for _, i, lo, s in pool], float)
        alive = np.ones(len(pool), bool)
        left = len(pool)
        while left > keep:
            room = self.limits.copy()
            pieces: list[tuple] = []
            while left and room[0] > 0 and room[1] > 0:
                fits = alive & (tokens <= room[0]) & (losses <= room[2])
                weight = room / (self.limits * self.limits)
                if fits.any():
                    k = int(np.argmax(np.where(fits, tokens * weight[0] + weight[1] + losses * weight[2], -1.0)))
                    doc, ids, loss, start = pool[k]
                    end = len(ids)
                    alive[k] = False
                    left -= 1
                else:
                    k = int(np.argmax(np.where(alive, tokens, -1.0)))
                    doc, ids, loss, start = pool[k]
                    # as many tokens as fit: the loss-free ones first, then those under the loss limit
                    end = int(min(start + room[0], max(start, len(ids) - loss) + room[2], len(ids)))
                    if end <= start:
                        break
                    pool[k] = (doc, ids, loss, end)
                    tokens[k] = len(ids) - end
                    losses[k] = self.loss(len(ids), loss, end, len(ids))
                pieces.append((doc, ids, loss, start, end))
                room -= (end - start, 1, self.loss(len(ids), loss, start, end))
            if not left and 0 < room[0] < self.capacity:
                self.tail(pieces)
            else:
                self.emit(pieces)
        self.pool = [p for p, a in zip(pool, alive) if a]

    def tail(self, pieces: list[tuple]):
        """Lay the pieces out in sequences whose lengths are powers of two."""
        total = sum(e - s for *_, s, e in pieces)
        queue = list(pieces)
        while total:
            size = 1 << (total.bit_length() - 1)
            total -= size
            part = []
            while size:
                doc, ids, loss, start, end = queue.pop(0)
                cut = min(end, start + size)
                part.append((doc, ids, loss, start, cut))
                size -= cut - start
                if cut < end:
                    queue.insert(0, (doc, ids, loss, cut, end))
            self.emit(part)

    def take(self) -> pa.RecordBatch:
        cols = list(zip(*self.rows)) or [()] * len(_ARROW)
        self.rows = []
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, _ARROW)], schema=_ARROW)


def pack_documents(docs: DataFrame, tokenizer_path: str, *, capacity: int = 4096, max_segments: int = 1024,
                   max_loss_tokens: int = 4096, end_id: int = 2, pool: int = 1024,
                   loss_tokens: str | None = None) -> DataFrame:
    """Pack ``docs(doc_id, text)`` into sequences of at most ``capacity`` tokens.

    Returns one row per piece (``PIECES``): ``ids`` holds the piece's token ids
    as little-endian unsigned 32-bit integers, ``start`` the document's ids
    before it, ``offset`` its place in the sequence. ``loss_tokens`` names a
    column with how many of a document's last tokens bear loss (null, or no
    column: all; values are clipped to the document). A sequence holds at most
    ``max_segments`` pieces and ``max_loss_tokens`` loss-bearing tokens.

    Null and empty texts are the end id alone. Rows with a null or repeated
    ``doc_id`` are packed like any other. Long texts span several sequences. An
    empty table gives no rows. Other columns are ignored.
    """
    assert capacity >= 1 and max_segments >= 1 and max_loss_tokens >= 1
    loss = F.col(loss_tokens).cast("long") if loss_tokens else F.lit(None).cast("long")
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                         loss.alias("loss"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordEncoder(tokenizer_path)
        # a sequence's id: the partition in the upper bits, a counter in the lower 40
        packer = Packer(capacity, max_segments, max_loss_tokens, TaskContext.get().partitionId() << 40)
        for batch in batches:
            lengths = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False)
            group = np.cumsum(lengths) >> _TEXTS
            for at, end in zip(*_bounds(group)):
                part = batch.slice(at, end - at)
                for doc, bears, ids in zip(part.column(0), part.column(2), encoder.encode(part.column(1))):
                    ids, bears = np.append(ids, np.uint32(end_id)), bears.as_py()
                    packer.add(doc.as_py(), ids, len(ids) if bears is None else min(max(bears, 0), len(ids)))
                    if len(packer.pool) >= pool:
                        packer.pack(pool // 2)
                yield packer.take()
        packer.pack(0)
        yield packer.take()

    return source.mapInArrow(tidy(run), PIECES)
