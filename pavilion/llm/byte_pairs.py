"""Byte-pair encoding of texts by a traversal of the trie of their words, and decoding.

A batch of texts is cut into words as the tokenizer file prescribes, and the
distinct words are inserted into a trie. Walking it depth first, each node gets
one value: the last token of the encoding of the prefix that leads to it. That
is the one token ending there which the encoding of the shorter prefix can be
followed by, so prefixes that words share are worked out once, and a word's
tokens are read off backwards from its end.

Words met before are remembered up to a bounded number. There is no shuffle.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import pre_tokenizers

from pavilion.llm import arrays, workers
from pavilion.llm.storage import fresh

_LETTER, _NUMBER, _OTHER, _SPACE, _END, _UNKNOWN = range(6)
_REMEMBERED_WORDS, _REMEMBERED_PAIRS = 300_000, 200_000


@lru_cache(maxsize=1)
def _kinds() -> np.ndarray:
    """Letter, number, white space or other, for every code point that Python knows."""
    kinds = np.full(0x110000, _OTHER, dtype=np.uint8)
    for code in range(0x110000):
        kind = unicodedata.category(chr(code))
        if kind[0] in "LN":
            kinds[code] = _LETTER if kind[0] == "L" else _NUMBER
        elif kind == "Cn":
            kinds[code] = _UNKNOWN
    # The code points with the property White_Space.
    spaces = [0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B)]
    kinds[[*spaces, 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]] = _SPACE
    return kinds


def _kinds_of(codes: np.ndarray) -> np.ndarray:
    """Kinds of the characters. For those newer than Python's tables, the tokenizers
    library is asked: it puts two characters of a kind into one word."""
    kinds = _kinds()[codes]
    for code in np.unique(codes[kinds == _UNKNOWN]).tolist():
        splits = pre_tokenizers.ByteLevel(add_prefix_space=False).pre_tokenize_str
        alike = (k for k, c in ((_LETTER, "a"), (_NUMBER, "1"), (_OTHER, "!")) if len(splits(c + chr(code))) == 1)
        _kinds()[code] = next(alike, _SPACE)
    return _kinds()[codes]


def _byte_letters() -> dict[str, int]:
    """The printable character that stands for each byte in the vocabulary file.

    Printable Latin-1 stands for itself; the other bytes get, in order, the
    characters from U+0100 on.
    """
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


def word_starts(codes: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Positions where words begin, in code points of texts that are each followed
    by one more character, at ``ends``; these also count as beginnings.

    Runs of letters, of numbers and of other characters are words, each with one
    plain space before it. Of white space before them the last character is apart
    from the rest. ``'s 't 're 've 'm 'll 'd`` are words if an apostrophe begins one.
    """
    kinds = _kinds_of(codes)
    kinds[ends] = _END
    n = len(codes)
    starts = np.ones(n, dtype=bool)
    starts[1:] = kinds[1:] != kinds[:-1]
    after = np.zeros(n, dtype=bool)
    after[1:] = kinds[:-1] == _END
    starts |= after
    space, solid = kinds == _SPACE, kinds < _SPACE
    last_space = space.copy()
    last_space[:-1] &= solid[1:]
    last_space[-1] = False
    starts |= last_space
    joined = np.zeros(n, dtype=bool)
    joined[1:] = (last_space & (codes == 0x20))[:-1]
    starts &= ~joined
    marks = np.flatnonzero((codes == 0x27) & starts)
    marks = marks[marks + 2 < n] if n else marks
    one, two = codes[marks + 1], codes[np.minimum(marks + 2, n - 1)]
    short = np.isin(one, [ord(c) for c in "stmd"])
    long = np.zeros(len(marks), dtype=bool)
    for pair in ("re", "ve", "ll"):
        long |= (one == ord(pair[0])) & (two == ord(pair[1]))
    for found, length in ((marks[short], 2), (marks[long], 3)):
        starts[found + 1] = False
        follow = found + length
        follow = follow[follow < n]
        starts[follow[kinds[follow] == _LETTER]] = True
    return np.flatnonzero(starts)


class Vocabulary:
    """Tokens, merges and special tokens of a byte-level tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            told = json.load(file)
        letters = _byte_letters()
        model = told["model"]
        simple = told["pre_tokenizer"]
        if model["type"] != "BPE" or simple["type"] != "ByteLevel" or told["normalizer"]:
            raise ValueError("only plain byte-level byte-pair tokenizers can be read")
        if simple["add_prefix_space"] or not simple["use_regex"]:
            raise ValueError("only tokenizers that split words and add no space can be read")
        special = {t["content"]: t["id"] for t in told["added_tokens"]}
        size = max([*model["vocab"].values(), *special.values()]) + 1
        self.tokens = [b""] * size
        for text, number in model["vocab"].items():
            self.tokens[number] = bytes(letters[c] for c in text)
        merges = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
        number = model["vocab"]
        self.merges = {(number[a], number[b]): (rank, number[a + b]) for rank, (a, b) in enumerate(merges)}
        self.special = special
        for text, at in special.items():
            self.tokens[at] = text.encode()
        self.name = hashlib.sha256(json.dumps(told, sort_keys=True).encode()).hexdigest()


class Encoder:
    """Encodes words; keeps what it has learnt about pairs of tokens and about words."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.single = {t: i for i, t in enumerate(vocabulary.tokens) if len(t) == 1}
        plain = {*range(len(vocabulary.tokens))} - {*vocabulary.special.values()}
        self._build([i for i in sorted(plain) if vocabulary.tokens[i] and self.merged(vocabulary.tokens[i]) == [i]])
        self.follows: dict[int, bool] = {}
        self.forget_words()

    def forget_words(self) -> None:
        """Give up the memory for words."""
        # A word's tokens are flat[begins[i] : begins[i + 1]], for its place i.
        self.places: dict[bytes, int] = {}
        self.flat, self.begins = array("I"), array("q", [0])

    def _build(self, tokens: list[int]) -> None:
        """An automaton whose state is the longest token beginning that the bytes so far end in.

        ``ends`` has the token that a state spells, or -1; ``shorter`` the state of the
        next shorter ending that is a token.
        """
        self.go: dict[int, int] = {}
        self.ends, children = [-1], [[]]
        for token in tokens:
            state = 0
            for byte in self.vocabulary.tokens[token]:
                key = state << 8 | byte
                if key not in self.go:
                    self.go[key] = len(self.ends)
                    self.ends.append(-1)
                    children.append([])
                    children[state].append((byte, self.go[key]))
                state = self.go[key]
            self.ends[state] = token
        self.fall = [0] * len(self.ends)
        self.shorter = [0] * len(self.ends)
        queue = [child for _, child in children[0]]
        for state in queue:
            back = self.fall[state]
            self.shorter[state] = back if self.ends[back] >= 0 else self.shorter[back]
            for byte, child in children[state]:
                self.fall[child] = self._step(back, byte)
                queue.append(child)

    def _step(self, state: int, byte: int) -> int:
        while True:
            after = self.go.get(state << 8 | byte)
            if after is not None or not state:
                return after or 0
            state = self.fall[state]

    def merged(self, text: bytes) -> list[int]:
        """The encoding by its definition: merge the best-ranked pair until none is left."""
        parts = [self.single[text[i : i + 1]] for i in range(len(text))]
        merges = self.vocabulary.merges
        while len(parts) > 1:
            best = min(
                ((merges[pair][0], i) for i, pair in enumerate(zip(parts[:-1], parts[1:], strict=True)) if pair in merges),
                default=None,
            )
            if best is None:
                break
            i = best[1]
            parts[i : i + 2] = [merges[parts[i], parts[i + 1]][1]]
        return parts

    def _learn(self, key: int) -> bool:
        """Do the two tokens of ``key`` stay apart when their bytes are encoded together?"""
        if len(self.follows) >= _REMEMBERED_PAIRS:
            self.follows.clear()
        first, second = key >> 32, key & 0xFFFFFFFF
        tokens = self.vocabulary.tokens
        apart = self.follows[key] = self.merged(tokens[first] + tokens[second]) == [first, second]
        return apart

    def _walk(self, new: list[bytes]) -> None:
        """Encode sorted words: a depth-first walk of their trie.

        In sorted order a word follows those it shares most with. The path from the
        root to it is kept, with the automaton's state and the last token at each node.
        """
        go, fall, ends, shorter, follows = self.go, self.fall, self.ends, self.shorter, self.follows
        sizes = [len(t) for t in self.vocabulary.tokens]
        path, states, last = b"", [0], [-1]
        for word in new:
            shared, most = 0, min(len(path), len(word))
            while shared < most and path[shared] == word[shared]:
                shared += 1
            del last[shared + 1 :], states[shared + 1 :]
            state = states[shared]
            for end in range(shared + 1, len(word) + 1):
                byte = word[end - 1]
                after = go.get(state << 8 | byte)
                while after is None and state:
                    state = fall[state]
                    after = go.get(state << 8 | byte)
                state = after or 0
                # Of the tokens that end here, longest first, the one that may follow.
                at = state if ends[state] >= 0 else shorter[state]
                while True:
                    token = ends[at]
                    if token < 0:
                        raise ValueError(f"no token ends the word {word[:end]!r}")
                    before = end - sizes[token]
                    if not before:
                        break
                    key = last[before] << 32 | token
                    apart = follows.get(key)
                    if apart if apart is not None else self._learn(key):
                        break
                    at = shorter[at]
                states.append(state)
                last.append(token)
            path, back, end = word, [], len(word)
            while end:
                back.append(last[end])
                end -= sizes[last[end]]
            self.places[word] = len(self.begins) - 1
            self.flat.extend(back[::-1])
            self.begins.append(len(self.flat))

    def encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Tokens of all known words, and where those of each of ``words`` begin and how many they are."""
        new = sorted({w for w in words if w not in self.places})
        if len(self.places) + len(new) > _REMEMBERED_WORDS and self.places:
            self.forget_words()
            new = sorted(set(words))
        self._walk(new)
        places = np.fromiter(map(self.places.__getitem__, words), np.int64, len(words))
        begins = np.array(self.begins, dtype=np.int64)
        return np.array(self.flat, dtype=np.uint32), begins[places], (begins[1:] - begins[:-1])[places]


_ENCODERS: dict[str, Encoder] = {}


def _encoder(vocabulary: Vocabulary) -> Encoder:
    if vocabulary.name not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[vocabulary.name] = Encoder(vocabulary)
    return _ENCODERS[vocabulary.name]


def _cut_at(text: str, special: list[str]) -> list[str]:
    """Pieces of plain text at even places, special tokens at odd ones."""
    pieces = [text]
    while True:
        rest = pieces[-1]
        found = min(((at, -len(s), s) for s in special if (at := rest.find(s)) >= 0), default=None)
        if found is None:
            return pieces
        at, _, token = found
        pieces[-1:] = [rest[:at], token, rest[at + len(token) :]]


def _runs(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """``values[s : s + n]`` for each start and length, one after the other."""
    before = np.cumsum(lengths) - lengths
    return values[np.repeat(starts - before, lengths) + np.arange(int(lengths.sum()))]


def encode_texts(encoder: Encoder, texts: list[str]) -> list[np.ndarray]:
    """Token ids of each text."""
    special = encoder.vocabulary.special
    pieces, owner, marks = [], [], []
    for i, text in enumerate(texts):
        cut = _cut_at(text, list(special)) if any(s in text for s in special) else [text]
        pieces += cut[0::2]
        owner += [i] * len(cut[0::2])
        marks += [special[s] for s in cut[1::2]] + [-1]
    whole = "\0".join([*pieces, ""])
    codes = np.frombuffer(whole.encode("utf-32-le"), dtype=np.uint32)
    ends = np.cumsum([len(p) + 1 for p in pieces]) - 1
    starts = word_starts(codes, ends)
    widths = 1 + (codes > 0x7F).astype(np.int64) + (codes > 0x7FF) + (codes > 0xFFFF)
    offsets = np.concatenate([[0], np.cumsum(widths)])
    plain = np.concatenate([starts, [len(codes)]])
    inside = np.ones(len(codes), dtype=bool)
    inside[ends] = False
    keep = inside[starts]
    begin, end = offsets[plain[:-1]][keep], offsets[plain[1:]][keep]
    raw = whole.encode()
    hashes = arrays.range_hashes(np.frombuffer(raw, dtype=np.uint8), begin, end)
    _, first, which = np.unique(hashes, return_index=True, return_inverse=True)
    words = [raw[a:b] for a, b in zip(begin[first].tolist(), end[first].tolist(), strict=True)]
    flat, places, sizes = encoder.encode(words)
    ids = _runs(flat, places[which], sizes[which])
    # Number of ids up to each piece's end.
    up_to = np.concatenate([[0], np.cumsum(sizes[which])])
    cuts = up_to[np.searchsorted(starts[keep], ends)]
    out: list[list[np.ndarray]] = [[] for _ in texts]
    begin_id = 0
    for i, mark, cut in zip(owner, marks, cuts.tolist(), strict=True):
        out[i].append(ids[begin_id:cut])
        if mark >= 0:
            out[i].append(np.array([mark], dtype=np.uint32))
        begin_id = cut
    return [parts[0] if len(parts) == 1 else np.concatenate(parts) for parts in out]


def _encode(vocabulary: Vocabulary, text: str, ids: str) -> Callable:
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(vocabulary)
        try:
            for batch in batches:
                for part, texts in arrays.parts(batch, text):
                    found = encode_texts(encoder, [t.decode() for t in texts])
                    columns = {n: part[n] for n in part.schema.names}
                    packed = pa.array([f.astype("<u4").tobytes() for f in found], pa.binary())
                    yield workers.batch(**columns, **{ids: packed})
        finally:
            # The process goes on to other tasks, perhaps of other kinds.
            encoder.forget_words()

    return encode


def _decode(vocabulary: Vocabulary, ids: str, text: str) -> Callable:
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = vocabulary.tokens
        sizes = np.array([len(t) for t in tokens], dtype=np.int64)
        flat, places = np.frombuffer(b"".join(tokens), dtype=np.uint8), np.cumsum(sizes) - sizes
        for batch in batches:
            for part, packed in arrays.parts(batch, ids):
                texts = []
                for one in packed:
                    numbers = np.frombuffer(one, dtype="<u4")
                    raw = _runs(flat, places[numbers], sizes[numbers]).tobytes()
                    texts.append(raw.decode("utf-8", errors="replace"))
                columns = {n: part[n] for n in part.schema.names}
                yield workers.batch(**columns, **{text: pa.array(texts, pa.string())})

    return decode


def encoded(docs: DataFrame, tokenizer: str, text_column: str = "text") -> tuple[DataFrame, str]:
    """``docs`` with the token ids of ``text_column``, and the name of the new column.

    ``tokenizer`` is the path of a byte-level tokenizer file; the driver reads it.
    The column ``ids`` (with underscores before it if ``docs`` has one) holds the
    ids as consecutive little-endian unsigned 32-bit numbers, see :func:`id_count`
    and :func:`decoded`. Special tokens of the file count where their text stands.
    Nothing is added, cut or padded. Null and empty texts have no ids.
    """
    (name,) = fresh(docs, "ids")
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.BinaryType())])
    return workers.mapped(docs, _encode(Vocabulary(tokenizer), text_column, name), schema), name


def decoded(df: DataFrame, tokenizer: str, ids_column: str = "ids") -> tuple[DataFrame, str]:
    """``df`` with the text of its ids, and the name of the new column, like ``decoded``.

    Bytes that are no UTF-8 are replaced as usual; null ids give an empty text.
    """
    (name,) = fresh(df, "decoded")
    schema = T.StructType([*df.schema.fields, T.StructField(name, T.StringType())])
    return workers.mapped(df, _decode(Vocabulary(tokenizer), ids_column, name), schema), name


def round_trip(docs: DataFrame, tokenizer: str, text_column: str = "text") -> tuple[DataFrame, str, str]:
    """:func:`encoded`, then :func:`decoded`, by one Python process per task; the names of both columns."""
    vocabulary, (ids, text) = Vocabulary(tokenizer), fresh(docs, "ids", "decoded")
    encode, decode = _encode(vocabulary, text_column, ids), _decode(vocabulary, ids, text)
    fields = [T.StructField(ids, T.BinaryType()), T.StructField(text, T.StringType())]
    schema = T.StructType([*docs.schema.fields, *fields])
    return workers.mapped(docs, lambda batches: decode(encode(batches)), schema), ids, text


def id_count(ids_column: str):
    """Number of ids, as a column."""
    return F.floor(F.octet_length(F.col(ids_column)) / 4)
