"""Removal of long passages that also start in an earlier document.

A byte goes if a string of ``length`` bytes that covers it also starts in a
document with a smaller id. Work flows in hash buckets, one for each shuffle
partition, and whatever a map task can settle among its own documents never
leaves it.

1. Anchors (see ``anchors``) cut every text into overlapping units: the
   ``length - k`` bytes before an anchor, the anchor, and ``length - k`` bytes
   behind it. A unit holds every string of ``length`` bytes that has its
   minimum there. Hashes of units go to the bucket of their anchor.
2. In a bucket, a unit that is equal to one of an earlier document is repeated
   as a whole. Units that share only the anchor are the ends of matches.
3. The bytes of those units go to buckets again, where a run-length
   Burrows-Wheeler index is built over them and each is streamed through it: a
   place with a match of ``length`` bytes whose first owner is an earlier
   document starts a repeated string. An anchor with more units than fit an
   index (a banner in many documents) goes another way: the strings of
   ``length`` bytes in its units are dealt by their own hashes, and each is
   compared with the smallest document that has it. A task sends a string once
   however many of its documents have it, so no bucket grows with one anchor.
4. The marks meet their texts and the bytes are cut out.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .anchors import Bytes, anchors
from .common import even_parts, mix64, staged, tidy

_UNIT = np.dtype([("anchor", "<u4"), ("unit", "<u8"), ("doc", "<i8"), ("pos", "<u4")])
#: One mark: the unit (place of its anchor, check of its hash) and the repeated bytes in it, from and to.
_MARK = np.dtype([("doc", "<i8"), ("pos", "<u4"), ("check", "<u4"), ("lo", "<u2"), ("hi", "<u2")])
_WHOLE = 65535
#: One string of ``length`` bytes of a hot anchor's units, by its place; such a mark has ``lo`` = _WHOLE.
_WINDOW = np.dtype([("hash", "<u8"), ("doc", "<i8"), ("pos", "<u4")])
#: Bytes of the units in one index.
_BLOCK = 1 << 18
#: Bytes of texts whose units a map task holds before it sends them (a unit takes more memory than its share of text).
_UNITS_OF = 1 << 23
#: Bytes of marked texts that are handled together.
_TEXTS = 1 << 18
#: An anchor with this many different units in one block of a map task is hot there.
_HOT = 256
_PIECE = np.dtype([("doc", "<i8"), ("pos", "<u4"), ("check", "<u4"), ("anchor", "<u8"), ("left", "<u2"), ("size", "<u2")])
HOT_ANCHORS, UNITS, MARKS, ENDS, HOT_UNITS, WINDOWS, TEXT = -1, 0, 1, 2, 3, 4, 9
_ROWS = pa.schema([("kind", pa.int32()), ("bucket", pa.int32()), ("blob", pa.binary())])
_SPARK_ROWS = "kind int, bucket int, blob binary"


def _dump(rows: np.ndarray, more: bytes = b"") -> bytes:
    """Columns one after the other, compressed."""
    raw = b"".join([len(rows).to_bytes(4, "little"), *(np.ascontiguousarray(rows[n]).tobytes() for n in rows.dtype.names), more])
    return zstandard.compress(raw, 1)


def _load(blob: bytes, dtype: np.dtype) -> tuple[np.ndarray, bytes]:
    raw = zstandard.decompress(blob)
    n, at = int.from_bytes(raw[:4], "little"), 4
    rows = np.empty(n, dtype)
    for name in dtype.names:
        size = n * dtype[name].itemsize
        rows[name] = np.frombuffer(raw[at:at + size], dtype[name])
        at += size
    return rows, raw[at:]


def _out(kind: int, buckets: np.ndarray, rows: np.ndarray) -> Iterator[tuple[int, int, bytes]]:
    """Rows of one kind, one blob for each bucket."""
    order = np.argsort(buckets, kind="stable")
    buckets, rows = buckets[order], rows[order]
    cuts = np.flatnonzero(np.diff(buckets)) + 1
    for part, at in zip(np.split(rows, cuts), [0, *cuts]):
        if len(part):
            yield kind, int(buckets[at]), _dump(part)


def _batch(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    cols = list(zip(*rows)) or [(), (), ()]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, _ROWS)], schema=_ROWS)


def _doc_bucket(doc: np.ndarray, buckets: int) -> np.ndarray:
    return (mix64(doc.astype(np.int64).view(np.uint64)) >> np.uint64(20)) % np.uint64(buckets)


def _first(*cols: np.ndarray) -> np.ndarray:
    """Where a sorted sequence of rows starts a new value."""
    new = np.ones(len(cols[0]), bool)
    if len(new):
        new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in cols])
    return new


class _Cutter:
    """Units of texts."""

    def __init__(self, length: int, k: int):
        self.length, self.k, self.side = length, k, length - k

    def ranges(self, pos: np.ndarray, start, end) -> tuple[np.ndarray, np.ndarray]:
        return np.maximum(pos - self.side, start), np.minimum(pos + self.length, end)

    def hashes(self, data: Bytes, pos: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        return mix64(data.hashes(lo, hi) + (pos - lo).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))

    def units(self, texts: list[bytes], docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Units of all texts and the full hashes of their anchors."""
        data = np.frombuffer(b"".join(texts), np.uint8)
        ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))
        starts = np.concatenate([[0], ends[:-1]])
        source = Bytes(data)
        pos, anchor = anchors(source, starts, ends, self.length, self.k)
        of = np.searchsorted(ends, pos, "right")
        lo, hi = self.ranges(pos, starts[of], ends[of])
        out = np.empty(len(pos), _UNIT)
        out["anchor"], out["unit"] = anchor & np.uint64(0xFFFFFFFF), self.hashes(source, pos, lo, hi)
        out["doc"], out["pos"] = docs[of], pos - starts[of]
        return out, anchor


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[int, int], Iterator[dict]]]:
    """Rows by (bucket, kind); each group's rows must be read before the next group."""
    def rows():
        for batch in batches:
            names = batch.schema.names
            for k in range(batch.num_rows):
                yield {n: batch.column(i)[k] for i, n in enumerate(names)}

    from itertools import groupby
    yield from groupby(rows(), key=lambda r: (r["bucket"].as_py(), r["kind"].as_py()))


def _mark_units(rows: np.ndarray) -> np.ndarray:
    out = np.zeros(len(rows), _MARK)
    out["doc"], out["pos"], out["check"] = rows["doc"], rows["pos"], rows["unit"] & np.uint64(0xFFFFFFFF)
    out["hi"] = _WHOLE
    return out


def cut_units(cutter: _Cutter, buckets: int, hot: int = _HOT) -> Callable:
    """Step 1: units by bucket, and marks for what repeats among the documents of one block.

    An anchor with ``hot`` different units or more in the block does not send them to its bucket, which only learns
    that it is hot; they are dealt by their own hashes.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def flush():
            units, anchor = (np.concatenate(c) for c in zip(*held))
            held.clear()
            order = np.lexsort((units["doc"], units["unit"], units["anchor"]))
            units, anchor = units[order], anchor[order]
            new = _first(units["anchor"], units["unit"])
            least = units["doc"][np.flatnonzero(new)][np.cumsum(new) - 1]
            again = units["doc"] > least
            rows = list(_out(MARKS, _doc_bucket(units["doc"][again], buckets), _mark_units(units[again])))
            new_anchor = _first(units["anchor"])
            group = np.cumsum(new_anchor) - 1
            many = np.bincount(group, weights=new) >= hot
            heads = np.flatnonzero(many[group])
            heads = heads[np.unique(anchor[heads], return_index=True)[1]]
            rows += _out(HOT_ANCHORS, (anchor[heads] >> np.uint64(32)) % np.uint64(buckets), units[heads])
            dealt, sent = ~again & many[group], ~again & ~many[group]
            rows += _out(HOT_UNITS, (units["unit"][dealt] >> np.uint64(32)) % np.uint64(buckets), units[dealt])
            rows += _out(UNITS, (anchor[sent] >> np.uint64(32)) % np.uint64(buckets), units[sent])
            return _batch(rows)

        for batch in batches:
            texts: list[bytes] = []
            ids: list[int] = []
            block = 0
            for k in range(batch.num_rows):
                text = batch.column(1)[k].as_buffer()
                if text.size >= cutter.length:
                    texts.append(text.to_pybytes())
                    ids.append(batch.column(0)[k].as_py())
                    block += text.size
                if texts and (block >= 1 << 18 or k == batch.num_rows - 1):
                    held.append(cutter.units(texts, np.array(ids, np.int64)))
                    size += block
                    texts, ids, block = [], [], 0
                if size >= _UNITS_OF:
                    size = 0
                    yield flush()
        if held:
            yield flush()

    return run


def find_units(docs: DataFrame, cutter: _Cutter, buckets: int) -> DataFrame:
    """Step 1 over ``docs``."""
    return docs.where("doc_id is not null and text is not null").select("doc_id", F.col("text").cast("binary").alias("text")) \
        .mapInArrow(tidy(cut_units(cutter, buckets)), _SPARK_ROWS)


def settle_units(cutter: _Cutter, buckets: int, block: int = _BLOCK) -> Callable:
    """Step 2: whole repeats become marks, ends of matches go back to their documents (``lo`` is 1 if their anchor
    is hot: known as such, or with more units than an index of ``block`` bytes takes)."""
    most = block // (2 * cutter.length - cutter.k)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[np.ndarray]] = {MARKS: [], ENDS: []}

        def flush():
            out = []
            for kind, parts in held.items():
                if parts:
                    rows = np.concatenate(parts)
                    out += _out(kind, _doc_bucket(rows["doc"], buckets), rows)
                    parts.clear()
            return _batch(out)

        known = np.empty(0, np.uint32)
        now = None
        for (bucket, kind), rows in _groups(batches):
            if bucket != now:
                now, known = bucket, known[:0]
            if kind == HOT_ANCHORS:
                known = np.unique(np.concatenate([_load(r["blob"].as_py(), _UNIT)[0]["anchor"] for r in rows]))
                continue
            if kind not in (UNITS, HOT_UNITS):
                for r in rows:
                    yield _batch([(kind, bucket, r["blob"].as_py())])
                continue
            units = np.concatenate([_load(r["blob"].as_py(), _UNIT)[0] for r in rows])
            units = units[np.lexsort((units["doc"], units["unit"], units["anchor"]))]
            new_anchor = _first(units["anchor"])
            new_unit = new_anchor | _first(units["unit"])
            least = units["doc"][np.flatnonzero(new_unit)][np.cumsum(new_unit) - 1]
            again = units["doc"] > least
            group = np.cumsum(new_anchor) - 1
            heads = np.flatnonzero(new_anchor)
            several = np.bincount(group, weights=new_unit) >= 2
            several &= np.minimum.reduceat(units["doc"], heads) < np.maximum.reduceat(units["doc"], heads)
            if kind == HOT_UNITS:
                hot = np.ones(len(heads), bool)
            else:
                hot = np.isin(units["anchor"][heads], known)
                hot |= several & (np.bincount(group, weights=~again) > most)
            end = ~again & (several | hot)[group]
            held[MARKS].append(_mark_units(units[again]))
            ends = _mark_units(units[end])
            ends["lo"] = hot[group[end]]
            held[ENDS].append(ends)
            if sum(len(x) for parts in held.values() for x in parts) > 500_000:
                yield flush()
        yield flush()

    return run


def _marks_of(rows) -> tuple[np.ndarray, Callable[[int], np.ndarray]]:
    marks = np.concatenate([np.empty(0, _MARK), *(_load(r["blob"].as_py(), _MARK)[0] for r in rows)])
    marks = marks[np.argsort(marks["doc"], kind="stable")]
    # the places of each document: a search in the rows' own field would copy that column at every call
    docs, first = np.unique(marks["doc"], return_index=True)
    places = dict(zip(docs.tolist(), zip(first.tolist(), [*first[1:].tolist(), len(marks)])))

    def of(doc):
        start, end = places.get(doc, (0, 0))
        return marks[start:end]

    return marks, of


@dataclass
class _Marked:
    """Marks of several texts that lie end to end: each mark's text ``of``, its place and range there, and where
    texts start. Marks whose unit is not in their text are left out (ids can repeat)."""

    source: Bytes
    start: np.ndarray
    size: np.ndarray
    of: np.ndarray
    marks: np.ndarray
    pos: np.ndarray
    lo: np.ndarray
    hi: np.ndarray

    @classmethod
    def check(cls, cutter: _Cutter, texts: list[bytes], marks: list[np.ndarray]) -> _Marked:
        size = np.fromiter(map(len, texts), np.int64, len(texts))
        start = np.cumsum(size) - size
        of = np.repeat(np.arange(len(texts)), np.fromiter(map(len, marks), np.int64, len(marks)))
        rows = np.concatenate(marks)
        source = Bytes(np.frombuffer(b"".join(texts), np.uint8))
        window = rows["lo"] == _WHOLE
        inside = rows["pos"].astype(np.int64) + np.where(window, cutter.length, cutter.k) <= size[of]
        rows, of, window = rows[inside], of[inside], window[inside]
        pos = rows["pos"].astype(np.int64)
        lo, hi = cutter.ranges(pos, 0, size[of])
        lo, hi = np.where(window, pos, lo), np.where(window, pos + cutter.length, hi)
        at = start[of]
        found = np.where(window, source.hashes(at + lo, at + hi), cutter.hashes(source, at + pos, at + lo, at + hi))
        good = (found & np.uint64(0xFFFFFFFF)) == rows["check"]
        return cls(source, start, size, of[good], rows[good], pos[good], lo[good], hi[good])

    def covered(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The bytes that lie in any of the ranges (places in all texts together)."""
        n = len(self.source.data)
        return np.cumsum(np.bincount(begin, minlength=n + 1) - np.bincount(end, minlength=n + 1))[:n] > 0

    def counts(self, bytes_: np.ndarray) -> np.ndarray:
        """How many of the chosen bytes each text has."""
        sums = np.concatenate([[0], np.cumsum(bytes_)])
        return sums[self.start + self.size] - sums[self.start]


def _with_rest_of_chars(data: np.ndarray, removed: np.ndarray) -> np.ndarray:
    """Removed bytes and the other bytes of their characters: a first byte and as many that continue as it asks for."""
    at = np.arange(len(data))
    first = np.maximum.accumulate(np.where((data & 0xC0) != 0x80, at, 0))
    size = np.select([data[first] >= 0xF0, data[first] >= 0xE0, data[first] >= 0xC0], [4, 3, 2], 1)
    char = np.where(at - first < size, first, at)
    return np.bincount(char, weights=removed, minlength=len(data))[char] > 0


def _mark_windows(rows: np.ndarray) -> np.ndarray:
    out = np.zeros(len(rows), _MARK)
    out["doc"], out["pos"], out["check"] = rows["doc"], rows["pos"], rows["hash"] & np.uint64(0xFFFFFFFF)
    out["lo"] = out["hi"] = _WHOLE
    return out


def _repeats(windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows by hash, and which of them an earlier document has too."""
    windows = windows[np.lexsort((windows["doc"], windows["hash"]))]
    new = _first(windows["hash"])
    return windows, windows["doc"] > windows["doc"][np.flatnonzero(new)][np.cumsum(new) - 1]


def cut_ends(cutter: _Cutter, buckets: int) -> Callable:
    """Step 3a: the bytes of the units at the ends of matches, by the bucket of their anchor; of hot anchors the strings
    of ``length`` bytes, by their own hashes, with marks for what repeats among the documents at hand."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, of = None, None
        texts: list[tuple[int, bytes, np.ndarray]] = []
        size = 0
        pieces: list[np.ndarray] = []
        data: list[bytes] = []
        windows: list[np.ndarray] = []

        def cut_held():
            ids = np.array([d for d, *_ in texts], np.int64)
            joined = b"".join(t for _, t, _ in texts)
            found = _Marked.check(cutter, [t for _, t, _ in texts], [m for *_, m in texts])
            texts.clear()
            at = found.start[found.of]
            lo, hi, pos = at + found.lo, at + found.hi, at + found.pos
            hot = found.marks["lo"] == 1
            if hot.any():
                begin = np.flatnonzero(found.covered(lo[hot], np.maximum(hi[hot] - cutter.length + 1, lo[hot])))
                which = np.searchsorted(found.start + found.size, begin, "right")
                part = np.empty(len(begin), _WINDOW)
                part["hash"], part["doc"] = found.source.hashes(begin, begin + cutter.length), ids[which]
                part["pos"] = begin - found.start[which]
                windows.append(part)
                if sum(map(len, windows)) > 2_000_000:
                    yield flush_windows()
            cold = np.flatnonzero(~hot)
            part = np.empty(len(cold), _PIECE)
            for name in ("doc", "pos", "check"):
                part[name] = found.marks[name][cold]
            part["anchor"] = found.source.hashes(pos[cold], pos[cold] + cutter.k) | np.uint64(1)
            part["left"], part["size"] = (pos - lo)[cold], (hi - lo)[cold]
            pieces.append(part)
            data.extend(joined[a:b] for a, b in zip(lo[cold].tolist(), hi[cold].tolist()))
            if len(data) > 100_000:
                yield flush()

        def flush_windows():
            rows, again = _repeats(np.concatenate(windows))
            windows.clear()
            out = list(_out(MARKS, _doc_bucket(rows["doc"][again], buckets), _mark_windows(rows[again])))
            rows = rows[~again]
            return _batch(out + list(_out(WINDOWS, (rows["hash"] >> np.uint64(32)) % np.uint64(buckets), rows)))

        def flush():
            rows, size = np.concatenate(pieces), np.concatenate(pieces)["size"].astype(np.int64)
            joined = b"".join(data)
            pieces.clear()
            data.clear()
            ends = np.cumsum(size)
            bucket = (rows["anchor"] >> np.uint64(32)) % np.uint64(buckets)
            order = np.argsort(bucket, kind="stable")
            cuts = np.flatnonzero(np.diff(bucket[order])) + 1
            return _batch([(ENDS, int(bucket[p[0]]), _dump(rows[p], b"".join(joined[ends[i] - size[i]:ends[i]] for i in p)))
                           for p in np.split(order, cuts) if len(p)])

        for (bucket, kind), rows in _groups(batches):
            if kind == ENDS:
                now, of = bucket, _marks_of(rows)[1]
                continue
            for r in rows:
                mine = of(r["doc_id"].as_py()) if now == bucket else ()
                if not len(mine) or not r["blob"].is_valid:
                    continue
                texts.append((r["doc_id"].as_py(), zstandard.decompress(r["blob"].as_py()), mine))
                size += len(texts[-1][1])
                if size > _TEXTS:
                    size = 0
                    yield from cut_held()
        if texts:
            yield from cut_held()
        if pieces:
            yield flush()
        if windows:
            yield flush_windows()

    return run


def match_ends(cutter: _Cutter, buckets: int, block: int = _BLOCK) -> Callable:
    """Step 3b: matching statistics of the units against indexes of at most ``block`` bytes of their bucket; strings of
    hot anchors against the smallest document that has them."""
    def shared(rows, key, have):
        """Whether a row's key occurs with another document."""
        order = np.lexsort((rows["doc"], key))
        new = _first(key[order])
        heads, docs = np.flatnonzero(new), rows["doc"][order]
        several = np.minimum.reduceat(docs, heads) < np.maximum.reduceat(docs, heads)
        out = np.zeros(len(rows), bool)
        out[order] = several[np.cumsum(new) - 1]
        return out & have

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (bucket, kind), group in _groups(batches):
            if kind == MARKS:
                for r in group:
                    yield _batch([(kind, bucket, r["blob"].as_py())])
                continue
            if kind == WINDOWS:
                windows, again = _repeats(np.concatenate([_load(r["blob"].as_py(), _WINDOW)[0] for r in group]))
                marks = _mark_windows(windows[again])
                yield _batch(list(_out(MARKS, _doc_bucket(marks["doc"], buckets), marks)))
                continue
            parts = [_load(r["blob"].as_py(), _PIECE) for r in group]
            rows, joined = np.concatenate([p[0] for p in parts]), b"".join(p[1] for p in parts)
            size = rows["size"].astype(np.int64)
            start = np.cumsum(size) - size
            # a shared string reaches half of the free bytes to the left or to the right of the anchor
            half = cutter.side // 2
            source = Bytes(np.frombuffer(joined, np.uint8))
            at = start + rows["left"]
            has_left, has_right = rows["left"] >= half, at + cutter.k + half <= start + size
            left = source.hashes(np.where(has_left, at - half, at), at + cutter.k)
            right = source.hashes(at, np.where(has_right, at + cutter.k + half, at))
            keep = np.flatnonzero(shared(rows, left, has_left) | shared(rows, right, has_right))
            del source
            keep = keep[np.argsort(rows["anchor"][keep], kind="stable")]
            # whole anchors, up to `block` bytes to an index; one anchor has no more (settle_units)
            heads = np.flatnonzero(_first(rows["anchor"][keep]))
            cuts, have = [], 0
            for head, more in zip(heads.tolist(), (np.add.reduceat(size[keep], heads) if len(heads) else heads).tolist()):
                if have + more > block:
                    cuts.append(head)
                    have = 0
                have += more
            found = []
            for chosen in np.split(keep, cuts):
                if not len(chosen):
                    continue
                strings = [joined[start[i]:start[i] + size[i]] for i in chosen]
                owner: dict[bytes, int] = {}
                for s, d in zip(strings, rows["doc"][chosen].tolist()):
                    owner[s] = min(d, owner.get(s, d))
                index = RunLengthIndex(list(owner), np.fromiter(owner.values(), np.int64, len(owner)), cutter.length)
                # the first document of an anchor has nothing before it
                new = _first(rows["anchor"][chosen])
                least = np.minimum.reduceat(rows["doc"][chosen], np.flatnonzero(new))[np.cumsum(new) - 1]
                later = np.flatnonzero(rows["doc"][chosen] > least)
                if not len(later):
                    continue
                chosen = chosen[later]
                _, first, which = index.stream([strings[i] for i in later])
                hit = np.flatnonzero(first < rows["doc"][chosen][which])
                if len(hit):
                    offset = hit - (np.cumsum(size[chosen]) - size[chosen])[which[hit]]
                    begins = np.flatnonzero((np.diff(hit, prepend=-2) != 1) | (np.diff(which[hit], prepend=-1) != 0))
                    marks = np.empty(len(begins), _MARK)
                    of = rows[chosen[which[hit[begins]]]]
                    for name in ("doc", "pos", "check"):
                        marks[name] = of[name]
                    marks["lo"] = offset[begins]
                    marks["hi"] = offset[np.append(begins[1:], len(hit)) - 1] + cutter.length
                    found.append(marks)
            if found:
                marks = np.concatenate(found)
                yield _batch(list(_out(MARKS, _doc_bucket(marks["doc"], buckets), marks)))

    from .rlbwt import RunLengthIndex
    return run


def remove_passages(docs: DataFrame, *, length: int = 50, whole_chars: bool = False) -> DataFrame:
    """``docs`` with ``kept`` (the bytes left of ``text``), ``n_bytes``,
    ``n_removed`` and ``n_spans`` (runs of removed bytes).

    Matches never cross documents and are judged on the input. A null text is
    empty and leaves an empty ``kept``; texts shorter than ``length`` stay. A
    row with a null ``doc_id`` stays as it is and takes nothing from others.
    Rows that repeat a ``doc_id`` are judged each by its own text, and nothing
    repeats because of a row with the same id. All other columns pass through;
    columns of the new names are replaced. An empty table gives no rows. With
    ``whole_chars`` the other bytes of a UTF-8 character that a removed run cuts
    through are left out of ``kept`` too; the counts stay those of the runs.
    """
    assert length >= 20
    cutter = _Cutter(length, max(8, length * 2 // 5))
    parts = even_parts(docs)
    buckets = parts
    new = ["kept", "n_bytes", "n_removed", "n_spans"]
    docs = docs.drop(*new).withColumn("doc_id", F.col("doc_id").cast("long"))
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]

    def dealt(df: DataFrame) -> DataFrame:
        return df.repartitionById(parts, "bucket").sortWithinPartitions("bucket", "kind")

    def compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Texts compressed before they are shuffled, with the bucket of their document."""
        press = zstandard.ZstdCompressor(3)
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                end, size = at, 0
                while end < batch.num_rows and size < 1 << 23:
                    size += batch.column(1)[end].as_buffer().size if batch.column(1)[end].is_valid else 0
                    end += 1
                part, at = batch.slice(at, end - at), end
                ids = part.column(0).fill_null(0).to_numpy(zero_copy_only=False)
                bucket = _doc_bucket(ids, buckets).astype(np.int32)
                blobs = [press.compress(t.as_buffer()) if t.is_valid else None for t in part.column(1)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(ids), TEXT, np.int32)), pa.array(bucket), pa.array(blobs, pa.binary()),
                     part.column(0), *(part.column(i) for i in range(2, part.num_columns))],
                    names=["kind", "bucket", "blob", "doc_id", *part.schema.names[2:]])

    def with_text(marks: DataFrame, columns: list[str]) -> DataFrame:
        more = ", rest " + T.StructType([docs.schema[c] for c in columns]).simpleString() if columns else ""
        texts = docs.select("doc_id", F.col("text").cast("binary").alias("text"),
                            *([F.struct(*columns).alias("rest")] if columns else []))
        texts = texts.mapInArrow(tidy(compress), T._parse_datatype_string(f"{_SPARK_ROWS}, doc_id long{more}"))
        return dealt(texts.unionByName(marks, allowMissingColumns=True))

    units = dealt(find_units(docs, cutter, buckets))
    settled = staged(units.mapInArrow(tidy(settle_units(cutter, buckets)), _SPARK_ROWS), "passages-settled")
    ends = with_text(settled.where(F.col("kind") == ENDS), []).mapInArrow(tidy(cut_ends(cutter, buckets)), _SPARK_ROWS)
    matched = staged(dealt(ends).mapInArrow(tidy(match_ends(cutter, buckets)), _SPARK_ROWS), "passages-matched")
    marks = settled.where(F.col("kind") == MARKS).unionByName(matched)
    both = with_text(marks, rest)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, of = None, None
        schema = None
        none = np.empty(0, _MARK)
        waiting: list[tuple] = []
        size = 0

        def cut_waiting():
            rows = [(d, t, len(t), 0, 0, more) for d, t, _, more in waiting]
            marked = [k for k, x in enumerate(waiting) if len(x[2])]
            if marked:
                found = _Marked.check(cutter, [waiting[k][1] for k in marked], [waiting[k][2] for k in marked])
                at, part = found.start[found.of], found.marks
                begin = at + found.lo + np.where(part["lo"] == _WHOLE, 0, part["lo"])
                end = np.where(part["hi"] == _WHOLE, at + found.hi, at + found.lo + part["hi"])
                removed = found.covered(begin, end)
                heads = removed.copy()
                heads[1:] &= ~removed[:-1]
                firsts = found.start[found.start < len(removed)]
                heads[firsts] = removed[firsts]
                gone, spans = found.counts(removed).tolist(), found.counts(heads).tolist()
                data = found.source.data
                if whole_chars:
                    removed = _with_rest_of_chars(data, removed)
                kept = data[~removed].tobytes()
                ends = np.cumsum(found.size - found.counts(removed)).tolist()
                for k, g, n, a, b in zip(marked, gone, spans, [0, *ends], ends):
                    rows[k] = (rows[k][0], kept[a:b], rows[k][2], g, n, rows[k][5])
            waiting.clear()
            cols = list(zip(*rows))
            arrays = [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.binary()), *(pa.array(c, pa.int64()) for c in cols[2:5])]
            names = ["doc_id", "kept", "n_bytes", "n_removed", "n_spans"]
            if rest:
                arrays.append(pa.array(cols[5], schema.field("rest").type))
                names.append("rest")
            return pa.RecordBatch.from_arrays(arrays, names=names)

        def watched():
            nonlocal schema
            for batch in batches:
                schema = batch.schema
                yield batch

        for (bucket, kind), rows in _groups(watched()):
            if kind == MARKS:
                now, of = bucket, _marks_of(rows)[1]
                continue
            for r in rows:
                text = zstandard.decompress(r["blob"].as_py()) if r["blob"].is_valid else b""
                mine = of(r["doc_id"].as_py()) if now == bucket else none
                waiting.append((r["doc_id"].as_py(), text, mine, r["rest"].as_py() if rest else None))
                size += len(text)
                if size > _TEXTS or len(waiting) >= 5000:
                    size = 0
                    yield cut_waiting()
        if waiting:
            yield cut_waiting()

    more = ", rest " + T.StructType([docs.schema[c] for c in rest]).simpleString() if rest else ""
    return both.mapInArrow(tidy(cut), T._parse_datatype_string(
        f"doc_id long, kept binary, n_bytes long, n_removed long, n_spans long{more}")) \
        .select("doc_id", *(["rest.*"] if rest else []), "kept", "n_bytes", "n_removed", "n_spans")
