"""Removal of passages that already stand in an earlier document, to the byte.

A passage is a string of ``LENGTH`` bytes, and a byte goes if any passage over it
also occurs in a document with a smaller id.

Equal passages have equal minimizers: the smallest hash among the shorter strings
in them. So documents are packed, and each pack tells, per bucket of hashes, which
minimizers it has. Those found in several packs come back, and only the passages
around them travel to their bucket. There, and inside each pack, a sparse suffix
array decides: suffixes that begin a passage are sorted by their first ``LENGTH``
bytes, which is where the longest-previous-factor array is cut off. In a run of
equal ones, in the order of documents, the previous smaller one is the first of
the run; all that belong to later documents go.

A minimizer that very many packs share is first settled among groups of packs, so
that its bucket gets one passage from each group and not one from each pack.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pavilion.llm import arrays, workers
from pavilion.llm.arrays import U
from pavilion.llm.storage import stored

LENGTH = 50
GRAM = 24
REACH = LENGTH - GRAM + 1
# Texts longer than this are worked on in pieces that overlap by LENGTH - 1 bytes.
PIECE_BYTES = 1 << 20
PACK_BYTES = 1 << 21
# A minimizer in more packs than this is settled in two steps.
HOT_PACKS = 32
# Bytes sorted at a time, where a minimizer does not need more.
SORT_BYTES = 1 << 15

_PACK = "pack long, ids binary, sizes binary, text binary, prints array<struct<bucket: int, prints: binary>>"
_SEGMENTS = "pack long, bucket int, hot boolean, prints binary, ids binary, docs binary, starts binary, counts binary, text binary"
# How the numbers of segments are stored, as compressed byte planes.
_KINDS = {"prints": "<u4", "ids": "<i8", "docs": "<i4", "starts": "<i8", "counts": "<i4"}


def _bytes(values, kind) -> bytes:
    return np.ascontiguousarray(values, dtype=kind).tobytes()


def _values(raw: bytes | None, kind) -> np.ndarray:
    return np.frombuffer(raw or b"", dtype=kind)


def _packed(prints: np.ndarray) -> bytes:
    """Sorted 32-bit numbers as steps, byte plane by byte plane, which compresses better."""
    return _planes(np.diff(prints.astype("<u4"), prepend=np.zeros(1, "<u4")), "<u4")


def _unpacked_prints(raw: bytes) -> np.ndarray:
    return np.cumsum(_of_planes(raw, "<u4"), dtype="<u4")


def _planes(values, kind) -> bytes:
    """Numbers byte plane by byte plane."""
    values = np.ascontiguousarray(values, dtype=kind)
    return values.view("u1").reshape(-1, values.itemsize).T.tobytes()


def _of_planes(raw: bytes, kind) -> np.ndarray:
    planes = np.frombuffer(raw, dtype="u1").reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def _pieces(texts: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Pieces of the texts, the text each is from, and where in it each begins."""
    pieces, docs, offsets = [], [], []
    for i, text in enumerate(texts):
        for at in range(0, max(len(text) - LENGTH + 1, 0), PIECE_BYTES):
            pieces.append(text[at : at + PIECE_BYTES + LENGTH - 1])
            docs.append(i)
            offsets.append(at)
    return pieces, np.array(docs, dtype=np.int64), np.array(offsets, dtype=np.int64)


class Runs:
    """Runs of passages with the same minimizer, over all texts of a pack."""

    def __init__(self, texts: list[bytes]):
        pieces, docs, offsets = _pieces(texts)
        self.buffer, begins = arrays.joined(pieces, b"\0")
        n = len(self.buffer)
        if not n:
            self.starts = self.counts = self.docs = self.at = np.zeros(0, dtype=np.int64)
            self.prints = np.zeros(0, dtype=U)
            return
        padded = np.concatenate([self.buffer, np.zeros(GRAM + 8, dtype=np.uint8)])
        words = np.lib.stride_tricks.as_strided(padded, (len(padded) - 7, 8), (1, 1))
        words = np.ascontiguousarray(words).view(U).ravel()
        least = words[:n] * U(0x9E3779B97F4A7C15)
        least ^= least >> U(29)
        least = (least + words[8 : n + 8]) * U(0xBF58476D1CE4E5B9)
        least ^= least >> U(32)
        least = (least + words[16 : n + 16]) * U(0x94D049BB133111EB)
        least ^= least >> U(31)
        # The smallest of REACH neighbours, by doubling.
        width = 1
        while width * 2 <= REACH:
            least[:-width] = np.minimum(least[:-width], least[width:])
            width *= 2
        if width < REACH:
            rest = REACH - width
            least[:-rest] = np.minimum(least[:-rest], least[rest:])
        lengths = np.diff(begins) - 1
        piece = np.repeat(np.arange(len(pieces)), lengths - LENGTH + 1)
        inside = np.arange(len(piece)) - np.repeat(np.cumsum(lengths - LENGTH + 1) - (lengths - LENGTH + 1), lengths - LENGTH + 1)
        at = begins[:-1][piece] + inside
        least = least[at]
        new = np.ones(len(at), dtype=bool)
        new[1:] = (least[1:] != least[:-1]) | (piece[1:] != piece[:-1])
        first = np.flatnonzero(new)
        self.prints = least[first]
        self.starts = at[first]
        self.counts = np.diff(np.concatenate([first, [len(at)]]))
        self.docs = docs[piece[first]]
        self.at = offsets[piece[first]] + inside[first]


def _gathered(buffer: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of segments of ``counts`` passages, and where each begins in them."""
    sizes = counts + LENGTH - 1
    begins = np.cumsum(sizes) - sizes
    return buffer[_runs_of(starts, sizes)], begins


def _suffix_ranks(text: np.ndarray) -> np.ndarray:
    """Ranks of all suffixes of ``text`` by their first LENGTH bytes."""
    n = len(text)
    padded = np.concatenate([text, np.zeros(8, dtype=np.uint8)]).astype(U)
    head = np.zeros(n, dtype=U)
    for j in range(6):
        head = (head << U(8)) | padded[j : n + j]
    bits = max(1, n.bit_length())
    if 3 * bits + bits <= 64 and 48 + bits <= 64:
        ranks = _dense((head << U(bits)) | np.arange(n, dtype=U), bits)
        for step in (6, 16):  # 6 bytes, then 18, then 50
            keys = ranks.astype(U)
            for by in (step, 2 * step):
                keys = (keys << U(bits)) | arrays.moved_up(ranks, by).astype(U)
            ranks = _dense((keys << U(bits)) | np.arange(n, dtype=U), bits)
        return ranks
    order = np.argsort(head)
    ranks = np.empty(n, dtype=np.int64)
    ranks[order] = np.cumsum(np.concatenate([[False], np.diff(head[order]) != 0]))
    for by in (6, 12, 24, 2):  # 12, 24, 48 and 50 bytes
        ranks = arrays.paired_ranks(ranks, arrays.moved_up(ranks, by))
    return ranks


def _dense(keyed: np.ndarray, bits: int) -> np.ndarray:
    """Dense ranks of keys that carry their index in the low ``bits``."""
    keyed = np.sort(keyed)
    index = (keyed & U((1 << bits) - 1)).astype(np.int64)
    keys = keyed >> U(bits)
    ranks = np.empty(len(keyed), dtype=np.int64)
    ranks[index] = np.cumsum(np.concatenate([[False], keys[1:] != keys[:-1]]))
    return ranks


def earlier(text: np.ndarray, begins: np.ndarray, counts: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """For each passage of segments in ``text``: does a smaller id have it too?

    Segments begin at ``begins``, hold ``counts`` passages and belong to ``ids``.
    """
    ranks = _suffix_ranks(text)
    before = np.cumsum(counts) - counts
    at = np.repeat(begins - before, counts) + np.arange(int(counts.sum()))
    order_of_ids, place = np.unique(ids, return_inverse=True)
    owner = np.repeat(place, counts)
    bits, low = len(at).bit_length(), max(1, len(order_of_ids).bit_length())
    if len(text).bit_length() + low + bits <= 64:
        keys = (ranks[at].astype(U) << U(low)) | owner.astype(U)
        keys = np.sort((keys << U(bits)) | np.arange(len(at), dtype=U))
        order = (keys & U((1 << bits) - 1)).astype(np.int64)
    else:
        order = np.lexsort((owner, ranks[at]))
    rank, owner = ranks[at[order]], owner[order]
    new = np.concatenate([[True], rank[1:] != rank[:-1]])
    found = np.empty(len(at), dtype=bool)
    found[order] = owner > owner[np.flatnonzero(new)][np.cumsum(new) - 1]
    return found


def _settled(text, begins, counts, prints, ids) -> np.ndarray:
    """``earlier`` for segments that follow each other in ``text``, ordered by their prints.

    Of equal segments the one with the smallest id stands for all, and the rest of
    later documents is found as a whole. Suffixes are sorted where a print has several
    different segments, some prints at a time.
    """
    if not len(counts):
        return np.zeros(0, dtype=bool)
    hashes = arrays.range_hashes(text, begins, begins + counts + LENGTH - 1)
    order = np.lexsort((ids, hashes, prints))
    new = np.ones(len(order), dtype=bool)
    new[1:] = (np.diff(prints[order]) != 0) | (hashes[order][1:] != hashes[order][:-1])
    stands = np.empty(len(order), dtype=np.int64)
    stands[order] = order[np.flatnonzero(new)][np.cumsum(new) - 1]
    chosen = np.sort(order[new])
    own = prints[chosen]
    edges = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1], [True]]))
    several = np.repeat(np.diff(edges) > 1, np.diff(edges))
    chosen = chosen[several]
    before = np.cumsum(counts) - counts
    first = np.zeros(int(counts.sum()), dtype=bool)
    if len(chosen):
        part, at = _gathered(text, begins[chosen], counts[chosen])
        sorted_part = _sorted_by_print(part, at, counts[chosen], prints[chosen], ids[chosen])
        first[_runs_of(before[chosen], counts[chosen])] = sorted_part
    found = first[_runs_of(before[stands], counts)]
    return found | np.repeat(ids > ids[stands], counts)


def _parts_by_print(prints: np.ndarray, lengths: np.ndarray) -> Iterator[np.ndarray]:
    """Indices of all segments of some prints at a time, about PIECE_BYTES of text."""
    order = np.argsort(prints, kind="stable")
    prints, ends = prints[order], np.cumsum(lengths[order])
    low = 0
    while low < len(order):
        high = int(np.searchsorted(ends, (ends[low - 1] if low else 0) + PIECE_BYTES, "right"))
        # Up to the end of a print.
        high = int(np.searchsorted(prints, prints[min(max(low, high - 1), len(prints) - 1)], "right"))
        yield order[low:high]
        low = high


def _runs_of(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers from each start on, ``lengths`` of them."""
    return np.repeat(starts - (np.cumsum(lengths) - lengths), lengths) + np.arange(int(lengths.sum()))


def _sorted_by_print(text, begins, counts, prints, ids) -> np.ndarray:
    found = []
    cuts = np.flatnonzero(np.concatenate([[True], prints[1:] != prints[:-1]]))
    ends = np.concatenate([begins, [len(text)]])
    stops = ends[np.append(cuts[1:], len(prints))]
    low = 0
    while low < len(cuts):
        # As many whole prints as fit, one at least.
        high = max(low + 1, int(np.searchsorted(stops, ends[cuts[low]] + SORT_BYTES, "right")))
        a, b = cuts[low], cuts[high] if high < len(cuts) else len(prints)
        found.append(earlier(text[ends[a] : ends[b]], begins[a:b] - ends[a], counts[a:b], ids[a:b]))
        low = high
    return np.concatenate(found)


def _pieces_left(found: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of passages not found, as segment, first passage in it, and number."""
    segment = np.repeat(np.arange(len(counts)), counts)
    inside = np.arange(len(segment)) - np.repeat(np.cumsum(counts) - counts, counts)
    keep = np.flatnonzero(~found)
    new = np.ones(len(keep), dtype=bool)
    new[1:] = (np.diff(keep) != 1) | (np.diff(segment[keep]) != 0)
    first = np.flatnonzero(new)
    return segment[keep][first], inside[keep][first], np.diff(np.concatenate([first, [len(keep)]]))


def _covered(found: np.ndarray, counts: np.ndarray, docs: np.ndarray, starts: np.ndarray):
    """Runs of found passages, as document, start in it, and number."""
    segment, first, number = _pieces_left(~found, counts)
    return docs[segment], starts[segment] + first, number


def _pack(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    press = zstandard.ZstdCompressor(level=3)
    number = TaskContext.get().partitionId() << 32
    for batch in batches:
        for rows, part in arrays.parts(batch, "text", PACK_BYTES):
            # Whole copies inside a pack have the same minimizers; one will do.
            prints = np.unique(Runs(list(dict.fromkeys(part))).prints)
            bucket = (prints % U(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            cuts = np.flatnonzero(np.diff(bucket[order], prepend=-1))
            told = [
                {"bucket": int(bucket[x[0]]), "prints": _packed(np.unique(prints[x] >> U(32)))}
                for x in np.split(order, cuts[1:])
                if len(x)
            ]
            kind = pa.list_(pa.struct([("bucket", pa.int32()), ("prints", pa.binary())]))
            known = rows["id"].is_valid().to_numpy(zero_copy_only=False)
            numbers = rows["id"].fill_null(0).to_numpy()
            yield workers.batch(
                pack=pa.array([number], pa.int64()),
                ids=pa.array([_bytes(numbers, "<i8") + _bytes(known, "u1")], pa.binary()),
                sizes=pa.array([_bytes([len(t) for t in part], "<i8")], pa.binary()),
                text=pa.array([press.compress(b"".join(part))], pa.binary()),
                prints=pa.array([told], kind),
            )
            number += 1


def _unpacked(pack: pa.Table) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Ids, which of them are not null, and texts."""
    sizes = _values(pack["sizes"][0].as_py(), "<i8")
    n = len(sizes)
    raw = pack["ids"][0].as_py()
    ids, known = _values(raw[: 8 * n], "<i8"), _values(raw[8 * n :], "u1") > 0
    whole = zstandard.ZstdDecompressor().decompress(pack["text"][0].as_py(), max_output_size=max(1, int(sizes.sum())))
    ends = np.cumsum(sizes)
    return ids, known, [whole[e - s : e] for s, e in zip(sizes.tolist(), ends.tolist(), strict=True)]


def _shared(group: pa.Table) -> pa.Table:
    """Per pack, the prints of this bucket that other packs have too, and the hot ones."""
    prints = [_unpacked_prints(p) for p in group["prints"].to_pylist()]
    values, counts = np.unique(np.concatenate(prints), return_counts=True)
    several, hot = values[counts > 1], values[counts > HOT_PACKS]
    out = [np.intersect1d(p, several, assume_unique=True) for p in prints]
    return pa.table(
        {
            "pack": group["pack"],
            "bucket": group["bucket"],
            "prints": pa.array([_packed(o) for o in out], pa.binary()),
            "hot": pa.array([_packed(np.intersect1d(o, hot, assume_unique=True)) for o in out], pa.binary()),
        }
    )


def _segment_row(press, pack, bucket, hot, prints, ids, docs, starts, counts, text) -> dict:
    numbers = zip(_KINDS.items(), (prints, ids, docs, starts, counts), strict=True)
    stored_numbers = {name: press.compress(_planes(values, kind)) for (name, kind), values in numbers}
    return {"pack": pack, "bucket": bucket, "hot": hot, **stored_numbers, "text": press.compress(text)}


def _numbers(table: pa.Table, name: str) -> list[np.ndarray]:
    """The numbers of each row of segments in a column."""
    unpress = zstandard.ZstdDecompressor()
    return [_of_planes(unpress.decompress(v), _KINDS[name]) for v in table[name].to_pylist()]


def _segment_table(rows: list[dict]) -> pa.Table:
    kinds = [("pack", pa.int64()), ("bucket", pa.int32()), ("hot", pa.bool_())]
    kinds += [(n, pa.binary()) for n in ("prints", "ids", "docs", "starts", "counts", "text")]
    return pa.Table.from_pylist(rows, schema=pa.schema(kinds))


def _covered_row(press, pack: int, docs, starts, counts) -> dict:
    return _segment_row(press, pack, -1, False, [], [], docs, starts, counts, b"")


def _segments(pack: pa.Table, shared: pa.Table, buckets: int) -> pa.Table:
    """What a pack settles by itself (bucket -1), and its segments for each bucket."""
    if not pack.num_rows:
        return _segment_table([])
    number = pack["pack"][0].as_py()
    ids, known, texts = _unpacked(pack)
    runs = Runs([t if k else b"" for t, k in zip(texts, known, strict=True)])
    rows: list[dict] = []
    press = zstandard.ZstdCompressor(level=3)
    if not len(runs.prints):
        return _segment_table(rows)
    owner = ids[runs.docs]
    # Minimizers of several documents of this pack.
    order = np.lexsort((owner, runs.prints))
    prints, owners = runs.prints[order], owner[order]
    new = np.concatenate([[True], prints[1:] != prints[:-1]])
    first = np.flatnonzero(new)
    last = np.concatenate([first[1:], [len(prints)]]) - 1
    several = (owners[first] != owners[last])[np.cumsum(new) - 1]
    here = order[several]
    found = np.zeros(int(runs.counts.sum()), dtype=bool)
    before = np.cumsum(runs.counts) - runs.counts
    if len(here):
        text, begins = _gathered(runs.buffer, runs.starts[here], runs.counts[here])
        settled = _settled(text, begins, runs.counts[here], runs.prints[here], owner[here])
        found[_runs_of(before[here], runs.counts[here])] = settled
        rows.append(_covered_row(press, number, *_covered(settled, runs.counts[here], runs.docs[here], runs.at[here])))
    # Of the minimizers that other packs have, the passages that are still open.
    bucket = (runs.prints % U(buckets)).astype(np.int64)
    code = (bucket.astype(U) << U(32)) | (runs.prints >> U(32))
    told, hot = [np.zeros(0, U)], [np.zeros(0, U)]
    for b, p, h in zip(shared["bucket"].to_pylist(), shared["prints"].to_pylist(), shared["hot"].to_pylist(), strict=True):
        told.append((U(b) << U(32)) | _unpacked_prints(p).astype(U))
        hot.append((U(b) << U(32)) | _unpacked_prints(h).astype(U))
    travels = np.isin(code, np.concatenate(told))
    is_hot = np.isin(code, np.concatenate(hot))
    segment, at, count = _pieces_left(found | ~np.repeat(travels, runs.counts), runs.counts)
    group = bucket[segment] * 2 + is_hot[segment]
    order = np.lexsort((runs.prints[segment], group))
    cuts = np.flatnonzero(np.diff(group[order], prepend=-1))
    for x in np.split(order, cuts[1:]):
        if not len(x):
            continue
        s = segment[x]
        text, _ = _gathered(runs.buffer, runs.starts[s] + at[x], count[x])
        rows.append(
            _segment_row(
                press, number, int(bucket[s[0]]), bool(is_hot[s[0]]), runs.prints[s] >> U(32), owner[s], runs.docs[s],
                runs.at[s] + at[x], count[x], text.tobytes(),
            )
        )
    return _segment_table(rows)


def _decide(group: pa.Table) -> pa.Table:
    """Covered passages of the segments of one bucket; of hot ones, also what is left.

    What packs have settled by themselves passes through.
    """
    if group["bucket"][0].as_py() < 0:
        return group.select(_segment_table([]).column_names)
    rest = group["hot"][0].as_py()
    unpress, press = zstandard.ZstdDecompressor(), zstandard.ZstdCompressor(level=3)
    parts = {name: _numbers(group, name) for name in _KINDS}
    row = np.repeat(np.arange(group.num_rows), [len(c) for c in parts["counts"]])
    sizes = [int(c.sum()) + len(c) * (LENGTH - 1) for c in parts["counts"]]
    prints, ids, docs, starts, counts = (np.concatenate(parts.pop(name)) for name in _KINDS)
    text, end = np.empty(sum(sizes), dtype=np.uint8), 0
    for packed, size in zip(group["text"], sizes, strict=True):
        raw = unpress.decompress(packed.as_py(), max_output_size=max(1, size))
        text[end : end + size] = np.frombuffer(raw, dtype=np.uint8)
        end += size
    lengths = counts.astype(np.int64) + LENGTH - 1
    begins = np.cumsum(lengths) - lengths
    # Runs of passages, as segment, first passage in it, and number.
    covered, left = [], []
    for x in _parts_by_print(prints, lengths):
        number = counts[x].astype(np.int64)
        part, at = _gathered(text, begins[x], number)
        found = _settled(part, at, number, prints[x].astype(np.int64), ids[x])
        for runs, gone in ((covered, ~found), (left, found)):
            if runs is covered or rest:
                segment, first, many = _pieces_left(gone, number)
                runs.append((x[segment], first, many))
    rows = []
    for runs, goes_on in ((covered, False), (left, True)):
        if not runs:
            continue
        segment, first, many = (np.concatenate(v) for v in zip(*runs, strict=True))
        for r, x in _by(row[segment]):
            s, pack = segment[x], group["pack"][r].as_py()
            if goes_on:
                own, _ = _gathered(text, begins[s] + first[x], many[x])
                rows.append(
                    _segment_row(
                        press, pack, group["bucket"][r].as_py(), False, prints[s], ids[s], docs[s],
                        starts[s] + first[x], many[x], own.tobytes(),
                    )
                )
            else:
                rows.append(_covered_row(press, pack, docs[s], starts[s] + first[x], many[x]))
    return _segment_table(rows)


def _by(groups: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """The indices of each group."""
    order = np.argsort(groups, kind="stable")
    cuts = np.flatnonzero(np.diff(groups[order], prepend=-1))
    for x in np.split(order, cuts[1:]):
        if len(x):
            yield int(groups[x[0]]), x


_RESULT = "id long, n_bytes long, spans array<struct<start: long, end: long>>, kept binary"


def _removed(pack: pa.Table, covered: pa.Table) -> pa.Table:
    """Each document of a pack with its removed spans and the bytes that are left."""
    ids, known, texts = _unpacked(pack) if pack.num_rows else ([], [], [])
    docs, starts, counts = (
        np.concatenate([np.zeros(0, np.int64), *_numbers(covered, name)]).astype(np.int64) for name in ("docs", "starts", "counts")
    )
    order = np.lexsort((starts, docs))
    docs, starts, ends = docs[order], starts[order], (starts + counts + LENGTH - 1)[order]
    cuts = np.searchsorted(docs, np.arange(len(ids) + 1))
    spans, kept = [], []
    for i, text in enumerate(texts):
        own: list[dict] = []
        parts, at = [], 0
        for a, b in zip(starts[cuts[i] : cuts[i + 1]].tolist(), ends[cuts[i] : cuts[i + 1]].tolist(), strict=True):
            if own and a <= own[-1]["end"]:
                own[-1]["end"] = max(own[-1]["end"], b)
            else:
                own.append({"start": a, "end": b})
        for span in own:
            parts.append(text[at : span["start"]])
            at = span["end"]
        spans.append(own)
        kept.append(b"".join([*parts, text[at:]]))
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    return pa.table(
        {
            "id": pa.array([i if k else None for i, k in zip(np.asarray(ids).tolist(), known, strict=True)], pa.int64()),
            "n_bytes": pa.array([len(t) for t in texts], pa.int64()),
            "spans": pa.array(spans, kind),
            "kept": pa.array(kept, pa.binary()),
        }
    )


def _spread(groups: int) -> Column:
    """A part number for ``pack``, whose low bits are alike where partitions hold few packs."""
    return F.pmod(F.xxhash64("pack"), F.lit(groups))


def without_repeated_passages(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``id_column``, ``n_bytes``, ``spans``, ``kept`` for every row of ``docs``.

    ``spans`` are the maximal runs of removed bytes, ``kept`` the other bytes of the
    UTF-8 text. A byte is removed if a string of ``LENGTH`` bytes that covers it also
    occurs in a row with a smaller id, in the input as it is. Repeats inside one text,
    or between rows that share an id, stay. Null texts are empty; a text shorter than
    ``LENGTH`` stays as it is, and so does a row without an id, which also takes
    nothing from others.
    """
    spark = docs.sparkSession
    buckets = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    given = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"))
    packs = stored(workers.mapped(given, lambda batches: _pack(batches, buckets), _PACK), "packs")
    groups = max(1, math.isqrt(packs.count()))
    prints = packs.select("pack", F.inline("prints"))
    shared = prints.groupBy("bucket").applyInArrow(_shared, "pack long, bucket int, prints binary, hot binary")
    texts = packs.drop("prints")
    segments = texts.groupBy("pack").cogroup(shared.groupBy("pack")).applyInArrow(
        lambda pack, told: _segments(pack, told, buckets), _SEGMENTS
    )
    # Cold minimizers are decided at once; hot ones among packs that share a part number.
    part = F.when(F.col("bucket") < 0, F.col("pack")).when(F.col("hot"), _spread(groups)).otherwise(0)
    segments = segments.withColumn("part", part)
    decided = segments.groupBy("bucket", "hot", "part").applyInArrow(_decide, _SEGMENTS)
    decided = stored(decided, "decided")
    rest = decided.where("bucket >= 0").groupBy("bucket").applyInArrow(_decide, _SEGMENTS)
    covered = decided.where("bucket < 0").unionByName(rest)
    covered = covered.select("pack", "docs", "starts", "counts")
    result = texts.groupBy("pack").cogroup(covered.groupBy("pack")).applyInArrow(_removed, _RESULT)
    return result.withColumnRenamed("id", id_column)
