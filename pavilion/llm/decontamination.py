"""Documents that hold passages of a benchmark, found by suffix arrays.

The corpus is cut into shards of some megabytes. Each shard gets a suffix array
over its words: the suffixes that can begin a match, in the order of their first
words. Every distinct window of the benchmark is then searched in it by bisection,
which gives the stretch of the order that begins with it. Stretches are marked as a
whole, and a document meets an item once, however often either repeats a window.
Inside the words so marked, the longest verbatim match of a document and an item is
found from ranks of runs of 1, 2, 4, ... words. Shards are independent, so there is no
shuffle.

The benchmark is the query set and goes to the tasks in blocks of bounded size,
one pass over the documents for each.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pavilion.llm import arrays, workers
from pavilion.llm.arrays import U
from pavilion.llm.storage import fresh, stored

WINDOW_WORDS = 13
# Bytes of benchmark text that a task holds at a time.
BLOCK_BYTES = 8 << 20
# Suffixes enter the array if their first words, at most so many, occur in the benchmark.
START_WORDS = 4

_MATCH = T.StructType(
    [
        T.StructField("start", T.LongType()),
        T.StructField("words", T.LongType()),
        T.StructField("item", T.StringType()),
        T.StructField("item_start", T.LongType()),
    ]
)
_SPAN = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])


def _words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, and where each text begins among them."""
    buffer, begins = arrays.joined(texts)
    buffer = arrays.LOWER[buffer]
    starts, ends = arrays.word_bounds(buffer, arrays.NOT_ALNUM)
    return arrays.range_hashes(buffer, starts, ends), np.searchsorted(starts, begins)


def _ends(first: np.ndarray) -> np.ndarray:
    """For each word, where its text ends."""
    return np.repeat(first[1:], np.diff(first))


def _keys(ids: np.ndarray, ends: np.ndarray, at: np.ndarray, words: int, fill: int = 0) -> np.ndarray:
    """The ids of the ``words`` words from each position on, ``fill`` beyond the text, as sortable bytes."""
    places = at[:, None] + np.arange(words)
    inside = places < ends[at][:, None]
    keys = np.where(inside, ids[np.minimum(places, len(ids) - 1)] if len(ids) else 0, fill)
    return np.ascontiguousarray(keys, dtype=">u4").view(f"S{4 * words}").ravel()


class Block:
    """Benchmark items, ready to be searched for."""

    def __init__(self, items: list[tuple[str | None, bytes]], words: int = WINDOW_WORDS):
        self.window = words
        self.names = [name for name, _ in items]
        hashes, self.first = _words([text for _, text in items])
        # Word ids follow the order of the hashes; 0 is any word that the benchmark lacks.
        self.vocabulary = np.unique(hashes)
        self.ids = np.searchsorted(self.vocabulary, hashes) + 1
        lengths = np.diff(self.first)
        self.ends = _ends(self.first)
        self.item = np.repeat(np.arange(len(items)), lengths)
        position = np.arange(len(hashes)) - self.first[:-1][self.item]
        # A window starts wherever a whole one fits; a shorter item is one window.
        at = np.flatnonzero(position <= np.maximum(lengths - words, 0)[self.item])
        short = np.minimum(lengths, words)
        self.start = min(START_WORDS, int(short[lengths > 0].min(initial=START_WORDS)))
        # Distinct windows, and the items that have them. The fill tells a short window from a longer one.
        self.low, one, same = np.unique(_keys(self.ids, self.ends, at, words), return_index=True, return_inverse=True)
        self.high = _keys(self.ids, self.ends, at[one], words, 0xFFFFFFFF)
        self.lengths = short[self.item[at[one]]]
        owners = np.unique(same.astype(np.int64) * len(items) + self.item[at])
        self.owner = owners % max(len(items), 1)
        self.owned = np.searchsorted(owners // max(len(items), 1), np.arange(len(self.low) + 1))
        self.starts = np.unique(self._start_codes(self.ids)[at]) if len(at) else np.zeros(0, U)

    def _start_codes(self, ids: np.ndarray) -> np.ndarray:
        n, factors = len(ids), arrays.multipliers(START_WORDS, 4)
        codes = np.zeros(n, dtype=U)
        for j in range(self.start):
            codes[: max(0, n - j)] += ids[j:].astype(U) * factors[j]
        return codes

    def search(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Word offsets of the texts, their word ids, which words lie inside windows, and pairs of text and item.

        A pair is there once if the item has a window that occurs in the text.
        """
        hashes, first = _words(texts)
        none = np.zeros(0, dtype=np.int64)
        mask = np.zeros(len(hashes), dtype=bool)
        if not len(self.low) or not len(hashes):
            return first, none, mask, none, none
        place = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        ids = np.where(self.vocabulary[place] == hashes, place + 1, 0)
        ends = _ends(first)
        codes = self._start_codes(ids)
        near = np.minimum(np.searchsorted(self.starts, codes), len(self.starts) - 1)
        suffixes = np.flatnonzero(self.starts[near] == codes)
        if not len(suffixes):
            return first, ids, mask, none, none
        keys = _keys(ids, ends, suffixes, self.window)
        order = np.argsort(keys, kind="stable")
        suffixes, keys = suffixes[order], keys[order]
        lowest = np.searchsorted(keys, self.low, "left")
        highest = np.maximum(np.searchsorted(keys, self.high, "right"), lowest)
        for length in np.unique(self.lengths).tolist():
            own = (self.lengths == length) & (highest > lowest)
            begin = suffixes[arrays.spans_to_mask(lowest[own], highest[own], len(suffixes))]
            mask |= arrays.spans_to_mask(begin, begin + length, len(mask))
        # A suffix begins with one window of each length at most, so this is no longer than the suffixes are.
        found = highest - lowest
        which = np.repeat(np.arange(len(found)), found)
        inside = np.arange(len(which)) - np.repeat(np.cumsum(found) - found, found)
        doc = np.searchsorted(first, suffixes[lowest[which] + inside], "right") - 1
        met = np.unique(doc * len(self.low) + which)
        doc, which = met // len(self.low), met % len(self.low)
        counts = self.owned[which + 1] - self.owned[which]
        inside = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        item = self.owner[np.repeat(self.owned[which], counts) + inside]
        pairs = np.unique(np.repeat(doc, counts) * len(self.names) + item)
        return first, ids, mask, pairs // len(self.names), pairs % len(self.names)

    def longest(self, ids: np.ndarray, at: np.ndarray, item: int) -> tuple[int, int, int]:
        """The longest run of words that a text shares with an item: where in the text, how long, where in the item.

        ``at`` are the places of the text's marked words in ``ids``, in order. Of equally
        long runs it is the first of the text, and there the first of the item.
        """
        gap = np.concatenate([np.flatnonzero(np.diff(at) > 1) + 1, [len(at)]])
        words = np.insert(ids[at], gap, 0)  # runs do not go on over a gap
        places = np.insert(at, gap, -1)
        n, whole = len(words), np.concatenate([words, self.ids[self.first[item] : self.first[item + 1]]])

        def common(ranks: np.ndarray, size: int, length: int) -> tuple[np.ndarray, np.ndarray]:
            """Codes of the runs of ``length`` in text and item; runs of ``size``, at least half of it, have ``ranks``."""
            codes = ranks[: len(whole) - length + 1] * (len(whole) + 1) + ranks[length - size : len(whole) - size + 1]
            return codes[: max(n - length + 1, 0)], codes[n:]

        ranks, size = np.unique(whole, return_inverse=True)[1].astype(np.int64), 1
        while 2 * size <= min(n, len(whole) - n):
            doubled = arrays.paired_ranks(ranks[:-size], ranks[size:])
            if not np.isin(*common(doubled, 2 * size, 2 * size)).any():
                break
            ranks, size = doubled, 2 * size
        low, high = size, min(2 * size - 1, n, len(whole) - n)
        while low < high:
            middle = (low + high + 1) // 2
            if np.isin(*common(ranks, size, middle)).any():
                low = middle
            else:
                high = middle - 1
        text, other = common(ranks, size, low)
        start = int(np.isin(text, other).argmax())
        return int(places[start]), low, int((other == text[start]).argmax())


def _measure(block: Block, text: str, names: list[str], carried: bool) -> Callable:
    """A batch function that appends, or brings up to date, the four measure columns."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in arrays.parts(batch, text):
                first, ids, mask, docs, found = block.search(texts)
                plain = np.flatnonzero(mask)
                ranges = np.searchsorted(plain, first)
                old = {n: part[n].to_pylist() for n in names[1:]} if carried else {}
                if carried:
                    for i, spans in enumerate(old[names[1]]):
                        for span in spans:
                            mask[first[i] + span["start"] : first[i] + span["end"]] = True
                rows: list[list] = [[] for _ in texts]
                spans: list[list] = [[] for _ in rows]
                edges = np.flatnonzero(np.diff(np.concatenate([[False], mask, [False]])))
                for a, b in zip(edges[0::2], edges[1::2], strict=True):
                    i = int(np.searchsorted(first, a, "right")) - 1
                    while a < b:  # neighbouring texts touch
                        stop = min(int(b), int(first[i + 1]))
                        if stop > a:
                            spans[i].append({"start": int(a - first[i]), "end": int(stop - first[i])})
                        a, i = stop, i + 1
                items: list[set] = [set() for _ in rows]
                for d, item in zip(docs.tolist(), found.tolist(), strict=True):
                    name = block.names[item]
                    if name is not None:
                        items[d].add(name)
                    start, words, there = block.longest(ids, plain[ranges[d] : ranges[d + 1]], item)
                    rows[d].append({"start": start - int(first[d]), "words": words, "item": name, "item_start": there})
                if carried:
                    items = [a | set(b) for a, b in zip(items, old[names[2]], strict=True)]
                    rows = [b + a for a, b in zip(rows, old[names[3]], strict=True)]
                columns = {n: part[n] for n in part.schema.names if n not in names}
                columns |= {
                    names[0]: pa.array(np.diff(first)),
                    names[1]: pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                    names[2]: pa.array([sorted(x) for x in items], pa.list_(pa.string())),
                    names[3]: pa.array(
                        rows,
                        pa.list_(
                            pa.struct(
                                [("start", pa.int64()), ("words", pa.int64()), ("item", pa.string()), ("item_start", pa.int64())]
                            )
                        ),
                    ),
                }
                yield workers.batch(**columns)

    return measure


def _blocks(benchmark: DataFrame, id_column: str, text_column: str) -> Iterator[list]:
    """The distinct items in blocks of about ``BLOCK_BYTES``, one at a time."""
    items = benchmark.select(
        F.col(id_column).cast("string").alias("item"), F.col(text_column).alias("text")
    ).where("text IS NOT NULL").distinct()
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = max(1, math.ceil(size / BLOCK_BYTES))
    for k in range(count):
        block = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(count)) == k)
        yield [(row.item, row.text.encode()) for row in block.orderBy("item", "text").collect()]


def measured(
    docs: DataFrame,
    benchmark: DataFrame,
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
    window_words: int = WINDOW_WORDS,
) -> tuple[DataFrame, list[str]]:
    """``docs`` with four more columns, and their names.

    ``n_words`` is the number of words; ``spans`` are the runs of words inside any
    occurrence of a benchmark window, ``items`` the sorted ids of items that have
    one, and ``matches`` the longest verbatim match with each such item: first word,
    number of words, item and first word there (of equally long ones the first). Words are letters a-z (A-Z lower-cased),
    digits and everything beyond ASCII. A window is ``window_words`` consecutive
    words of an item, or all of a shorter item. Null texts have no words. An item
    without an id marks words but is not listed; repeated items count once, and so
    do items that share an id. Names that ``docs`` already has get underscores.
    """
    names = fresh(docs, "n_words", "spans", "items", "matches")
    types = [T.LongType(), T.ArrayType(_SPAN), T.ArrayType(T.StringType()), T.ArrayType(_MATCH)]
    schema = T.StructType([*docs.schema.fields, *map(T.StructField, names, types)])
    result, carried = docs, False
    for items in _blocks(benchmark, item_column, item_text_column):
        if carried:
            result = stored(result, "decontamination")
        function = _measure(Block(items, window_words), text_column, names, carried)
        result, carried = workers.mapped(result, function, schema), True
    return result, names


def n_hit(spans: str):
    """Number of words inside spans, as a column."""
    return F.aggregate(F.col(spans), F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])


def is_contaminated(n_words: str, spans: str):
    """True if a twentieth of the words or more are inside spans."""
    hit = n_hit(spans)
    return (hit > 0) & (20 * hit >= F.col(n_words))


def decontaminated(docs: DataFrame, benchmark: DataFrame, **columns: str) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, unchanged.

    Null and empty texts stay, and so do repeated rows, each judged alike; an empty
    benchmark leaves all rows. Columns of any other name are carried along.
    """
    result, (words, spans, *_) = measured(docs, benchmark, **columns)
    return result.where(~is_contaminated(words, spans)).select(*[F.col(f"`{c}`") for c in docs.columns])
