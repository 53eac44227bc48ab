"""Token sequences of fixed length, filled along a space-filling curve through the documents.

Each document becomes token ids with an end id behind them, and a vector of hashed
token counts. The vectors of all documents give a covariance, whose leading
directions project a vector to four numbers; their place on a Hilbert curve is the
document's key. Sorted by that key in ranges, neighbours on the curve, such as
copies and texts of one language or subject, follow each other, and the stream of
their ids is cut every ``length`` ids. Only the last sequence can be shorter.

Ids are worked out once and kept in the shared folder. What is sorted is one key and
one count a document; ids move once, to the place that the sort has found for them.
"""

from __future__ import annotations

import json
import re
import sys
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from pavilion.llm import arrays, byte_pairs, workers
from pavilion.llm.storage import stored

LENGTH = 1024
BUCKETS, DIMENSIONS, BITS = 64, 4, 15
_REMEMBERED_WORDS = 300_000
_LONG_TEXT = 1_000_000

# Characters of which this module knows the kind that a byte-level tokenizer sees in them:
# ASCII, Latin, Cyrillic and plain punctuation. Texts with others are left to the library.
_STRANGE = re.compile("[^\t-\r -~¡-ɏЀ-ҁ‐-‧]")
_CONTROL = re.compile("[\0-\x08\x0e-\x1f\x7f]")
_LETTERS, _NUMBERS = "a-zA-ZªµºÀ-ÖØ-öø-ɏЀ-ҁ", "0-9²³¹¼½¾"
# Words of such a tokenizer: letters, numbers or other characters with a space before
# them, endings such as 's, and white space.
_WORDS = re.compile(
    rf" ?[{_LETTERS}]+|'(?:[stmd]|re|ve|ll)| ?[^\s{_LETTERS}{_NUMBERS}]+| ?[{_NUMBERS}]+|\s+(?!\S)|\s+"
)
# Where a word is sure to begin.
_CUT = re.compile(r"(?<=\S) (?=\S)")


class _Words(dict):
    """Packed ids by word: those met lately, and once more as many met before them."""

    def __init__(self, encoder: TextEncoder):
        super().__init__()
        self.encoder, self.older = encoder, {}

    def __missing__(self, word: str) -> bytes:
        if len(self) >= _REMEMBERED_WORDS:
            self.older = dict(self)
            self.clear()
        ids = self.older.get(word)
        if ids is None:
            ids = self.encoder.word(word)
        self[word] = ids
        return ids


class TextEncoder:
    """Ids of texts as the tokenizers library has them, worked out a word at a time; words met lately are remembered.

    ``told`` is the content of a byte-level tokenizer file. Ids are packed as
    little-endian unsigned numbers of ``kind``.
    """

    def __init__(self, told: str):
        self.library = Tokenizer.from_str(told)
        self.library.no_padding()
        self.library.no_truncation()
        rules = json.loads(told)
        simple = rules["pre_tokenizer"]
        # Any other file works too, text by text.
        self.plain = (
            rules["model"]["type"] == "BPE" and simple is not None and simple["type"] == "ByteLevel"
            and simple["use_regex"] and not simple["add_prefix_space"] and not rules["normalizer"]
            and not rules["model"].get("dropout") and not rules["model"].get("ignore_merges")
        )
        self.marks = [t["content"] for t in rules["added_tokens"]]
        self.kind = "<u2" if max(self.library.get_vocab(with_added_tokens=True).values()) < 1 << 16 else "<u4"
        self.letters = {byte: letter for letter, byte in byte_pairs._byte_letters().items()}
        self.pieces = self._ranked(rules["model"]) if self.plain else None
        self.words = _Words(self)

    def _ranked(self, model: dict) -> tiktoken.Encoding | None:
        """The same vocabulary as ranks, if merges come in the order of the ids that they make.

        Then merging by rank and by the list of merges are the same, and a word costs a third.
        """
        single = {letter: byte for byte, letter in self.letters.items()}
        ranks = {bytes(single[c] for c in t): i for t, i in model["vocab"].items() if all(c in single for c in t)}
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        made = [model["vocab"][a + b] for a, b in merges]
        ordered = all(a < b for a, b in zip(made, made[1:], strict=False))
        single_bytes = sum(len(t) == 1 for t in ranks)
        if not ordered or single_bytes != 256 or len(ranks) != 256 + len(made):
            return None
        return tiktoken.Encoding("words", pat_str=r"(?s:.+)", mergeable_ranks=ranks, special_tokens={})

    def word(self, word: str) -> bytes:
        if self.pieces is not None:
            found = self.pieces.encode_ordinary(word)
        else:
            letters = word.encode().decode("latin-1").translate(self.letters)
            found = [t.id for t in self.library.model.tokenize(letters)]
        ids = array("H" if self.kind == "<u2" else "I", found)
        if sys.byteorder == "big":
            ids.byteswap()
        return ids.tobytes()

    def whole(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, dtype=self.kind).tobytes()

    def text(self, text: str) -> bytes:
        strange = _STRANGE.search(text) if not text.isascii() else _CONTROL.search(text)
        if not self.plain or strange or any(m in text for m in self.marks):
            return self.whole(text)
        if len(text) <= _LONG_TEXT:
            return b"".join(map(self.words.__getitem__, _WORDS.findall(text)))
        out, at = [], 0
        while at < len(text):
            cut = _CUT.search(text, at + _LONG_TEXT)
            end = cut.start() if cut else len(text)
            out += map(self.words.__getitem__, _WORDS.findall(text[at:end]))
            at = end
        return b"".join(out)


_ENCODERS: dict[str, TextEncoder] = {}


def _encoder(told: str) -> TextEncoder:
    if told not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[told] = TextEncoder(told)
    return _ENCODERS[told]


def _hashed(size: int) -> np.ndarray:
    """Bucket of every id; those that count down have theirs behind all that count up."""
    mixed = np.arange(size, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)
    return (mixed % np.uint64(2 * BUCKETS)).astype(np.int64)


def vectors(found: list[np.ndarray], buckets: np.ndarray) -> np.ndarray:
    """A row for each document: signed token counts by bucket, damped, at length 127, as whole numbers."""
    docs = np.repeat(np.arange(len(found)) * 2 * BUCKETS, [len(f) for f in found])
    ids = np.concatenate([*found, np.zeros(0, np.uint16)])
    counts = np.bincount(docs + buckets[ids], minlength=2 * BUCKETS * len(found)).reshape(-1, 2, BUCKETS)
    counts = counts[:, 0] - counts[:, 1]
    damped = np.sign(counts) * np.sqrt(np.abs(counts))
    sizes = np.sqrt(np.einsum("ij,ij->i", damped, damped))
    return np.rint(127 * damped / np.where(sizes > 0, sizes, 1)[:, None]).astype(np.int8)


def _encode(told: str, end_id: int) -> Callable:
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(told)
        wide = np.dtype(encoder.kind)
        size = encoder.library.get_vocab_size(with_added_tokens=True)
        buckets = _hashed(max(size, end_id + 1, 1 << 16))
        last = np.array([end_id], dtype=wide).tobytes()
        for batch in batches:
            for part, texts in arrays.parts(batch, "text"):
                packed = [encoder.text(t.decode()) for t in texts]
                found = [np.frombuffer(p, dtype=wide) for p in packed]
                yield workers.batch(
                    row=part["row"],
                    id=part["id"],
                    ids=pa.array([p + last for p in packed], pa.binary()),
                    tokens=pa.array([len(f) + 1 for f in found], pa.int64()),
                    vector=pa.array([v.tobytes() for v in vectors(found, buckets)], pa.binary()),
                )

    return encode


def _vectors(batch: pa.RecordBatch) -> np.ndarray:
    raw = b"".join(batch["vector"].to_pylist())
    return np.frombuffer(raw, dtype=np.int8).reshape(-1, BUCKETS).astype(np.float64)


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Exact sums of products of a task's vectors, a one put before each."""
    total = np.zeros((BUCKETS + 1, BUCKETS + 1), dtype=np.int64)
    for batch in batches:
        vectors = np.column_stack([np.ones(batch.num_rows), _vectors(batch)])
        total += (vectors.T @ vectors).astype(np.int64)
    first, second = np.triu_indices(BUCKETS + 1)
    yield workers.batch(i=pa.array(first, pa.int32()), j=pa.array(second, pa.int32()), total=total[first, second])


def projection(vectors: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Mean, leading directions and spread along them of all rows' ``vector``.

    The sums are whole numbers, the same in whatever order tasks deliver them.
    """
    parts = workers.mapped(vectors.select("vector"), _moments, "i int, j int, total long")
    total = np.zeros((BUCKETS + 1, BUCKETS + 1))
    # A few thousand rows, whatever the number of documents.
    for r in parts.groupBy("i", "j").agg(F.sum("total").alias("total")).collect():
        total[r.i, r.j] = total[r.j, r.i] = r.total
    n = max(total[0, 0], 1.0)
    mean = total[0, 1:] / n
    values, directions = np.linalg.eigh(total[1:, 1:] / n - np.outer(mean, mean))
    leading = directions[:, ::-1][:, :DIMENSIONS]
    leading = leading * np.where(leading[np.abs(leading).argmax(axis=0), range(DIMENSIONS)] < 0, -1.0, 1.0)
    return mean, leading, np.sqrt(np.maximum(values[::-1][:DIMENSIONS], 1e-9))


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places on the Hilbert curve of rows of ``cells``, whole numbers below ``2 ** bits``.

    From the highest bit down, the part of the curve inside a cell is turned as the
    cells above it ask; what is left is a Gray code with the dimensions' bits in turn.
    """
    x = cells.astype(np.int64).copy()
    n = x.shape[1]
    for bit in range(bits - 1, 0, -1):
        low = (1 << bit) - 1
        for d in range(n):
            set_here = (x[:, d] >> bit & 1).astype(bool)
            swapped = (x[:, 0] ^ x[:, d]) & low
            x[:, 0] ^= np.where(set_here, low, swapped)
            x[:, d] ^= np.where(set_here, 0, swapped)
    for d in range(1, n):
        x[:, d] ^= x[:, d - 1]
    flip = np.zeros(len(x), dtype=np.int64)
    for bit in range(bits - 1, 0, -1):
        flip ^= np.where(x[:, n - 1] >> bit & 1, (1 << bit) - 1, 0)
    x ^= flip[:, None]
    key = np.zeros(len(x), dtype=np.int64)
    for bit in range(bits - 1, -1, -1):
        for d in range(n):
            key = key << 1 | x[:, d] >> bit & 1
    return key


def _keys(mean: np.ndarray, directions: np.ndarray, spread: np.ndarray) -> Callable:
    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # One deviation counts for every direction alike; far out, cells get wider.
            place = (_vectors(batch) - mean) @ directions / spread
            cells = np.floor((1 << BITS) / (1 + np.exp(-1.7 * np.clip(place, -20, 20))))
            key = hilbert_keys(np.minimum(cells, (1 << BITS) - 1), BITS)
            yield workers.batch(row=batch["row"], key=key, tokens=batch["tokens"])

    return keys


def _running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many ids lie before each row in its own part of the order."""
    total = 0
    for batch in batches:
        tokens = batch["tokens"].to_numpy()
        ends = total + np.cumsum(tokens)
        yield workers.batch(row=batch["row"], part=batch["part"], before=ends - tokens, tokens=batch["tokens"])
        total = int(ends[-1]) if len(ends) else total


def positions(keyed: DataFrame) -> DataFrame:
    """``row`` and ``position``: the number of ids before it in the order of ``key``, then ``row``."""
    order = keyed.repartitionByRange("key", "row").sortWithinPartitions("key", "row")
    order = order.select("row", "tokens", F.spark_partition_id().alias("part"))
    placed = stored(workers.mapped(order, _running, "row long, part int, before long, tokens long"), "positions")
    sums = placed.groupBy("part").agg(F.sum("tokens").alias("tokens"))
    earlier = F.sum("tokens").over(Window.orderBy("part")) - F.col("tokens")
    offsets = sums.select("part", earlier.alias("offset"))
    # One row a partition, whatever the number of documents.
    return placed.join(F.broadcast(offsets), "part").select("row", (F.col("offset") + F.col("before")).alias("position"))


def _cut(length: int, kind: str, names: list[str]) -> Callable:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, packed in arrays.parts(batch, "ids"):
                ids = np.frombuffer(b"".join(packed), dtype=kind).astype("<u4")
                tokens = np.array([len(p) for p in packed], dtype=np.int64) // np.dtype(kind).itemsize
                before = np.cumsum(tokens) - tokens
                position = part["position"].to_numpy().astype(np.int64)
                # A document has a piece in every sequence that it reaches into.
                counts = (position + tokens - 1) // length - position // length + 1
                source = np.repeat(np.arange(len(tokens)), counts)
                sequence = position[source] // length + np.arange(len(source)) - np.repeat(np.cumsum(counts) - counts, counts)
                begin = np.maximum(position[source], sequence * length)
                end = np.minimum((position + tokens)[source], (sequence + 1) * length)
                start = begin - position[source]
                places = 4 * (before[source] + start)
                raw = memoryview(ids).cast("B")
                pieces = [raw[a:b] for a, b in zip(places.tolist(), (places + 4 * (end - begin)).tolist(), strict=True)]
                columns = [part["id"].take(pa.array(source)), start, end - begin, np.fromiter(map(zlib.crc32, pieces), np.int64, len(pieces))]
                columns += [tokens[source], sequence, begin - sequence * length]
                if len(names) > len(columns):
                    columns.append(pa.array(map(bytes, pieces), pa.binary()))
                yield workers.batch(**dict(zip(names, columns, strict=True)))

    return cut


def packed(
    docs: DataFrame,
    tokenizer: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    length: int = LENGTH,
    end_id: int = 0,
    with_ids: bool = True,
) -> DataFrame:
    """Pieces of documents that fill sequences of ``length`` ids without a gap.

    One row per piece: the document's id under its own name, ``start`` (its ids
    before the piece), ``length``, ``ids_crc32`` (checksum of ``ids``), ``doc_tokens``
    (all its ids, with the end id), ``sequence_id``, ``offset`` and, unless left out,
    ``ids`` themselves (little-endian unsigned 32-bit numbers). Sequences count from 0; each but the last holds exactly ``length`` ids.

    ``tokenizer`` is the path of a file of the tokenizers library; the driver reads it.
    A null or empty text is its end id alone. A very long text runs through as many
    sequences as it fills. Repeated rows, equal ids and null ids are documents of their
    own; equal texts are neighbours. An empty table gives no rows. Other columns play no
    part, whatever their names; an id column with the name of another result is refused.
    """
    names = [id_column, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"]
    if len({n.lower() for n in names}) < len(names):
        raise ValueError(f"the id column cannot be called {id_column}")
    with open(tokenizer, encoding="utf-8") as file:
        told = file.read()
    kind = TextEncoder(told).kind
    if not 0 <= end_id < 1 << 8 * np.dtype(kind).itemsize:
        raise ValueError("the end id does not fit the ids")
    plain = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    plain = plain.select("id", "text", F.monotonically_increasing_id().alias("row"))
    id_type = plain.schema["id"].dataType
    fields = [("row", T.LongType()), ("id", id_type), ("ids", T.BinaryType()), ("tokens", T.LongType()), ("vector", T.BinaryType())]
    schema = T.StructType([T.StructField(n, t) for n, t in fields])
    # Hardly any two rows have equal ids: looking for them would be in vain.
    plainly = {"parquet.enable.dictionary": "false"}
    encoded = stored(workers.mapped(plain, _encode(told, end_id), schema), "encoded", **plainly)
    keyed = workers.mapped(
        encoded.select("row", "tokens", "vector"), _keys(*projection(encoded)), "row long, key long, tokens long"
    )
    # Ids go to their positions: only the narrow side is held in memory, a share of it in each task.
    meet = encoded.select("row", "id", "ids").join(positions(keyed).hint("shuffle_hash"), "row")
    kinds = [id_type, *[T.LongType()] * 6, T.BinaryType()]
    schema = T.StructType([T.StructField(n, t) for n, t in zip(names, kinds, strict=True)][: len(names) - (not with_ids)])
    return workers.mapped(meet.select("id", "ids", "position"), _cut(length, kind, schema.names), schema)


def sequences(pieces: DataFrame) -> DataFrame:
    """``sequence_id``, ``tokens`` and ``ids`` of every sequence, its pieces joined in order.

    A sequence has no more pieces than ids, so a row stays small.
    """
    piece = F.struct("offset", F.hex("ids").alias("ids"))
    joined = pieces.groupBy("sequence_id").agg(F.sum("length").alias("tokens"), F.sort_array(F.collect_list(piece)).alias("pieces"))
    return joined.select("sequence_id", "tokens", F.unhex(F.array_join(F.col("pieces.ids"), "")).alias("ids"))
