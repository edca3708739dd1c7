"""Byte-level BPE by corpus-level merge replay, and its inverse.

Documents stay where they are. A task takes its documents in blocks; the distinct words of
a block that it hasn't met form the block's corpus. All symbols of that corpus lie in one
arena of linked lists, and an inverted index maps each applicable token pair (by its rank)
to the positions where it stands. The merges are replayed over the whole corpus in rank
order, touching only the two neighbours of each merge. Words don't see each other, so the
index is read in slices of neighbouring ranks: a step takes the least pair of each word
that has one in the slice, and within a word the order of ranks is strict.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Callable, Iterator
from functools import cached_property
from heapq import heapify, heappop, heappush
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import text_blocks

#: Words that a task remembers with their ids, and bytes of them; beyond either it starts afresh.
MEMO_WORDS, MEMO_BYTES = 400_000, 32 << 20
#: Ranks of a slice of the index, as a power of two.
SLICE_BITS = 8
#: Words of so many bytes are replayed by themselves.
LONG_WORD = 100
#: Bytes of text whose new words make one arena.
ARENA_BYTES = 4 << 20
#: Ids that are decoded at once, or one row's.
DECODE_IDS = 1 << 20
#: Texts of so many characters are split piece by piece, into so many words at a time.
LONG_TEXT, PIECE_WORDS = 4_000_000, 200_000


#: Letters and numbers that Unicode has gained after version 16.0, whose classes the tiktoken library has (fixed values): the
#: ``regex`` package knows them, and they are neither here.
LATER = (
    "\u0558\u058b\u058c\u088f\u0c5c\u0cdc\u208f\u209d-\u209f\ua7ce\ua7cf\ua7d2\ua7d4\ua7dd\ua7e2\ua7f1\uab6c\uab6d\U000107bb-\U000107bf\U00010940-\U00010959\U00010ec5-\U00010ec7\U00010ed9-\U00010eee"
    "\U00011b0a\U00011db0-\U00011ddb\U00011de0-\U00011de9\U00011df1\U0001246f\U00012475-\U0001247f\U00012550-\U00012686\U00016ea0-\U00016eb8\U00016ebb-\U00016ed3\U00016ff2-\U00016ff6"
    "\U000187f8-\U000187ff\U00018cd6-\U00018cda\U00018d09-\U00018d20\U00018d80-\U00018df2\U00018e00-\U00019191\U000191a0-\U000191d2\U0001b123-\U0001b128\U0001b168\U0001d6a6\U0001df1f-\U0001df24"
    "\U0001df2b-\U0001df81\U0001df90-\U0001df96\U0001dfcd-\U0001dfff\U0001e6c0-\U0001e6de\U0001e6e0-\U0001e6e2\U0001e6e4\U0001e6e5\U0001e6e7-\U0001e6ed\U0001e6f0-\U0001e6f4\U0001e6fe\U0001e6ff"
    "\U0002b73a-\U0002b73f\U0002b81e\U0002cea2-\U0002cead\U000323b0-\U00033479\U0003d000-\U0003fc3f"
)


def word_pattern(pattern: str, later: bool = True) -> regex.Pattern:
    r"""The splitting pattern with ``\s`` as Unicode's White_Space, which is what the tiktoken
    library means by it (Python's ``\s`` also takes U+001C to U+001F), and ``\p{L}`` and ``\p{N}`` as of Unicode 16.0. Without
    ``later``, for texts without the code points of ``LATER``, as the package has them, which is faster."""
    spelt = pattern.replace(r"[^\s", r"[^\p{White_Space}").replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")
    if later:
        spelt = spelt.replace(r"\p{L}", rf"[\p{{L}}--[{LATER}]]").replace(r"\p{N}", rf"[\p{{N}}--[{LATER}]]")
    return regex.compile(spelt, regex.V1 if later else 0)


def _members(property_class: str, limit: int = 0x250) -> str:
    """The characters of a class below ``limit``, as they stand in a character set of ``re``."""
    is_member = regex.compile(property_class).match
    return "".join(re.escape(chr(c)) for c in range(limit) if is_member(chr(c)))


def splitter(pattern: str) -> Callable[[str], Iterator[list[str]]]:
    """Splits a text by the pattern, into one list or, a very long text, into several. Texts of Latin letters take the
    standard library's ``re``, in whose dialect the pattern's classes are spelt out up to U+024F; the others take ``regex``."""
    slow, careful = word_pattern(pattern, later=False), word_pattern(pattern)
    letters, numbers, spaces = _members(r"\p{L}"), _members(r"\p{N}"), _members(r"\p{White_Space}")
    spelt = pattern.replace(r"[^\s\p{L}\p{N}]", f"[^{spaces}{letters}{numbers}]").replace(r"\p{L}", f"[{letters}]").replace(r"\p{N}", f"[{numbers}]").replace(r"\s", f"[{spaces}]").replace(r"\S", f"[^{spaces}]")
    fast = slow if re.search(r"\\[pPwWdDbBX]", spelt) else re.compile(spelt)
    other, new = re.compile("[^\0-\u024f]").search, re.compile(f"[{LATER}]").search

    def split(text: str) -> Iterator[list[str]]:
        how = fast if not other(text) else careful if new(text) else slow
        if len(text) < LONG_TEXT:
            yield how.findall(text)
            return
        found = how.finditer(text)
        while piece := [m[0] for m in islice(found, PIECE_WORDS)]:
            yield piece

    return split


def read_ranks(lines: list[str]) -> list[bytes]:
    """Tokens by rank, from lines of base64 token and rank."""
    pairs = [line.split() for line in lines if line.strip()]
    tokens = [b""] * len(pairs)
    for token, rank in pairs:
        tokens[int(rank)] = base64.b64decode(token)
    return tokens


class Vocabulary:
    """A fixed list of tokens, as arrays: what encoder and decoder share. Its size doesn't depend on the corpus."""

    def __init__(self, tokens: list[bytes]):
        self.joined = np.frombuffer(b"".join(tokens), np.uint8)
        self.starts = np.zeros(len(tokens) + 1, np.int64)
        np.cumsum([len(t) for t in tokens], out=self.starts[1:])
        ranks = {t: i for i, t in enumerate(tokens)}
        self.by_byte = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        # Each way to cut a token into two tokens: the pairs that have a rank, and no others.
        made = [(a << 32 | b, i) for i, t in enumerate(tokens) for k in range(1, len(t)) if (a := ranks.get(t[:k], -1)) >= 0 and (b := ranks.get(t[k:], -1)) >= 0]
        made.sort()
        self.pair_keys = np.array([k for k, _ in made] or [-1], np.int64)
        self.pair_ranks = np.array([r for _, r in made] or [-1], np.int32)

    @cached_property
    def ranks(self) -> dict[bytes, int]:
        """Rank of each token."""
        joined, starts = self.joined.tobytes(), self.starts.tolist()
        return {joined[a:b]: i for i, (a, b) in enumerate(zip(starts, starts[1:]))}

    @cached_property
    def pairs(self) -> dict[int, int]:
        """Rank of each pair that has one."""
        return dict(zip(self.pair_keys.tolist(), self.pair_ranks.tolist(), strict=True))

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the token that two make together, or -1."""
        keys = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == keys, self.pair_ranks[at], np.int32(-1))

    def decode(self, ids: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of all ids, and the number of bytes of each run of ``sizes`` ids."""
        starts, counts = self.starts[ids], self.starts[ids + 1] - self.starts[ids]
        ends = np.cumsum(counts)
        places = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts - (ends - counts), counts)
        edges = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(sizes)])]
        return self.joined[places], np.diff(edges)


def replay(words: list[bytes], vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all words in one array, and how many each has: a word's own rank if it is a token, else what the merges leave of it."""
    own = np.fromiter((vocabulary.ranks.get(w, -1) for w in words), np.int32, len(words))
    length = np.fromiter(map(len, words), np.int64, len(words))
    token, short = own >= 0, (own < 0) & (length < LONG_WORD)
    long = ~token & ~short
    ids, sizes = _replay_short([words[k] for k in np.flatnonzero(short).tolist()], vocabulary)
    parts = [_replay_long(words[k], vocabulary) for k in np.flatnonzero(long).tolist()]
    all_sizes = np.ones(len(words), np.int64)
    all_sizes[short], all_sizes[long] = sizes, [len(p) for p in parts]
    out = np.empty(int(all_sizes.sum()), np.int32)
    out[np.repeat(short, all_sizes)] = ids
    out[np.repeat(token, all_sizes)] = own[token]
    out[np.repeat(long, all_sizes)] = np.fromiter(chain.from_iterable(parts), np.int32)
    return out, all_sizes


def _replay_long(word: bytes, vocabulary: Vocabulary) -> list[int]:
    """Merges of one long word: its index is a heap of (rank, place), so that equal pairs of a word go from the left."""
    pair = vocabulary.pairs.get
    symbol = vocabulary.by_byte[np.frombuffer(word, np.uint8)].tolist()
    n = len(symbol)
    after, before = [*range(1, n), -1], list(range(-1, n - 1))
    heap = [rank << 40 | i for i in range(n - 1) if (rank := pair(symbol[i] << 32 | symbol[i + 1], -1)) >= 0]
    heapify(heap)
    while heap:
        top = heappop(heap)
        rank, i = top >> 40, top & ((1 << 40) - 1)
        j = after[i]
        if j < 0 or symbol[i] < 0 or pair(symbol[i] << 32 | symbol[j], -1) != rank:
            continue
        symbol[i], symbol[j] = rank, -1
        k = after[i] = after[j]
        if k >= 0:
            before[k] = i
            if (made := pair(rank << 32 | symbol[k], -1)) >= 0:
                heappush(heap, made << 40 | i)
        if (p := before[i]) >= 0 and (made := pair(symbol[p] << 32 | rank, -1)) >= 0:
            heappush(heap, made << 40 | p)
    return [x for x in symbol if x >= 0]


def _distinct(places: np.ndarray) -> np.ndarray:
    """Places in order, each once."""
    places = np.sort(places)
    return places[np.append(True, places[1:] != places[:-1])] if len(places) else places


def _replay_short(words: list[bytes], vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Merges over the arena of all words."""
    data = np.frombuffer(b"".join(words), np.uint8)
    size = len(data)
    if not size:
        return np.zeros(0, np.int32), np.zeros(len(words), np.int64)
    word = np.repeat(np.arange(len(words), dtype=np.int32), [len(w) for w in words])
    symbol, place = vocabulary.by_byte[data], np.arange(size, dtype=np.int32)
    last = np.append(word[1:] != word[:-1], True)
    after = np.where(last, np.int32(-1), place + 1)
    before = np.where(np.append(True, last[:-1]), np.int32(-1), place - 1)
    # Rank of the pair that starts at a place, or -1.
    by_pair = vocabulary.rank_of(*(vocabulary.by_byte[x] for x in np.divmod(np.arange(1 << 16), 256)))
    rank_at = np.where(last, np.int32(-1), by_pair[data.astype(np.int32) << 8 | np.append(data[1:], np.uint8(0))])
    index: dict[int, list[np.ndarray]] = {}
    heap: list[int] = []

    def add(places: np.ndarray) -> None:
        """Put places into the index entries of their pairs' ranks."""
        slices = (rank_at[places] >> SLICE_BITS).astype(np.uint16)
        order = np.argsort(slices, kind="stable")
        places, slices = places[order], slices[order]
        cuts = [0, *(np.flatnonzero(slices[1:] != slices[:-1]) + 1).tolist(), len(places)]
        for a, b in zip(cuts, cuts[1:]):
            if a < b:
                at = int(slices[a])
                if at in index:
                    index[at].append(places[a:b])
                else:
                    index[at] = [places[a:b]]
                    heappush(heap, at)

    add(place[rank_at >= 0])
    while heap:
        now = heappop(heap)
        places = _distinct(np.concatenate(index.pop(now)))
        while len(places := places[rank_at[places] >> SLICE_BITS == now]):  # the others were taken by another merge meanwhile
            # Of each word the least rank, and its first place; the word's other places wait.
            order = rank_at[places].astype(np.int64) << 32 | places
            edge = np.append(True, word[places[1:]] != word[places[:-1]])
            least = np.minimum.reduceat(order, np.flatnonzero(edge))
            waiting = places[order != least[np.cumsum(edge) - 1]]
            i, rank = (least & 0xFFFFFFFF).astype(np.int32), (least >> 32).astype(np.int32)
            j = after[i]
            n, p = after[j], before[i]
            symbol[i], symbol[j], after[i], rank_at[j] = rank, -1, n, -1
            follows, leads = n >= 0, p >= 0
            before[n[follows]] = i[follows]
            rank_at[i] = np.where(follows, vocabulary.rank_of(rank, symbol[n]), np.int32(-1))
            p = p[leads]
            rank_at[p] = vocabulary.rank_of(symbol[p], rank[leads])
            made = np.concatenate([i, p])
            made = made[rank_at[made] >= 0]
            at = rank_at[made] >> SLICE_BITS
            add(made[at != now])
            places = _distinct(np.concatenate([waiting, made[at == now]]))
            if heap and heap[0] < now:  # pairs of lower ranks have come up: they go first
                if len(places):
                    index[now] = [places, *index.get(now, [])]
                    heappush(heap, now)
                break
    alive = symbol >= 0
    return symbol[alive], np.bincount(word[alive], minlength=len(words))


class _Numbers(dict):
    """A number for each word, in the order in which they come; ``fresh`` are those whose ids aren't known yet."""

    def __init__(self):
        self.fresh: list[str] = []

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        self.fresh.append(word)
        return number


class Encoder:
    """Ids of texts; remembers words and their ids in bounded memory."""

    def __init__(self, vocabulary: Vocabulary, pattern: str):
        self.vocabulary, self.split = vocabulary, splitter(pattern)
        self._forget()

    def _forget_if_full(self) -> None:
        if len(self.numbers) > MEMO_WORDS or self.bytes > MEMO_BYTES:
            self._forget()

    def _forget(self) -> None:
        self.numbers, self.bytes = _Numbers(), 0
        self.ids, self.starts = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def _number(self, text: str) -> Iterator[np.ndarray]:
        """Numbers of a text's words, in one array or, a very long text, in several."""
        for piece in self.split(text):
            yield np.fromiter(map(self.numbers.__getitem__, piece), np.int32, len(piece))

    def _ids(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of numbered words in one array, and how many each has."""
        if self.numbers.fresh:
            fresh = [w.encode() for w in self.numbers.fresh]
            self.numbers.fresh.clear()
            self.bytes += sum(map(len, fresh))
            ids, sizes = replay(fresh, self.vocabulary)
            self.ids = np.concatenate([self.ids, ids])
            self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(sizes)])
        starts, sizes = self.starts[at], self.starts[at + 1] - self.starts[at]
        ends = np.cumsum(sizes)
        return self.ids[np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)], sizes

    def texts(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts in one array, and how many each has."""
        if len(texts) == 1 and texts[0]:
            parts = []
            for at in self._number(texts[0]):
                parts.append(self._ids(at)[0])
                self._forget_if_full()
            return np.concatenate(parts), np.array([sum(map(len, parts))])
        numbers = [next(self._number(t)) if t else np.zeros(0, np.int32) for t in texts]
        ids, sizes = self._ids(np.concatenate(numbers))
        self._forget_if_full()
        ends = np.concatenate([[0], np.cumsum(sizes)])
        return ids, np.diff(ends[np.concatenate([[0], np.cumsum([len(x) for x in numbers])])])


def _rank_lines(spark: SparkSession, path: str) -> list[str]:
    """The vocabulary's lines: from a path that Spark reads, or from a file of the driver's machine.

    A vocabulary is a fixed file of about a megabyte, whatever the corpus."""
    if "://" in path:
        return [r[0] for r in spark.read.text(path).collect()]
    with open(path) as f:
        return f.read().splitlines()


def _vocabulary(spark: SparkSession, ranks_path: str):
    return spark.sparkContext.broadcast(Vocabulary(read_ranks(_rank_lines(spark, ranks_path))))


def _offsets(sizes: np.ndarray, kind=np.int32) -> pa.Array:
    return pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(kind))


def _decoded(ids: pa.Array, vocabulary: Vocabulary) -> Iterator[pa.Array]:
    """Decoded bytes of blocks of rows of an array of ids."""
    counts = pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = ids.flatten().to_numpy(zero_copy_only=False)
    ends = np.cumsum(counts)
    start, before = 0, 0
    while start < len(counts):
        stop = max(start + 1, int(np.searchsorted(ends, before + DECODE_IDS, side="right")))
        data, sizes = vocabulary.decode(flat[before : ends[stop - 1]], counts[start:stop])
        yield pa.Array.from_buffers(pa.binary(), stop - start, [None, _offsets(sizes).buffers()[1], pa.py_buffer(data)])
        start, before = stop, int(ends[stop - 1])


def bpe_encode(docs: DataFrame, ranks_path: str, pattern: str, *, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = (), decode: bool = False) -> DataFrame:
    """doc_id, the columns ``keep`` and ids (array of int) of every whole text, in place: no row moves.

    ``decode`` adds the column ``decoded`` of ``bpe_decode`` in the same pass. Null and empty texts give an
    empty array. Repeated rows give repeated results. Words of any length are replayed by the heap, in
    n log n. Other columns are not read. A worker holds one block of texts, and words it remembers up to
    MEMO_WORDS and MEMO_BYTES beyond those of a block.
    """
    shared = _vocabulary(docs.sparkSession, ranks_path)
    names = ["doc_id", *keep, "ids", *(["decoded"] if decode else [])]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(shared.value, pattern)
        for block in text_blocks(batches, "text", ARENA_BYTES):
            flat, sizes = encoder.texts(block.column("text").to_pylist())
            ids = pa.ListArray.from_arrays(_offsets(sizes), pa.array(flat))
            added = [ids, *([pa.concat_arrays(_decoded(ids, shared.value))] if decode else [])]
            yield pa.RecordBatch.from_arrays([*(block.column(c) for c in names[: 1 + len(keep)]), *added], names)

    rows = docs.select(F.col(id_col).alias("doc_id"), *keep, F.col(text_col).alias("text"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "text")
    return rows.mapInArrow(encode, f"{kinds}, ids array<int>{', decoded binary' if decode else ''}")


def bpe_decode(ids: DataFrame, ranks_path: str, *, ids_col: str = "ids") -> DataFrame:
    """``ids`` with the column ``decoded`` (binary) added: the tokens' bytes joined; null ids count as none."""
    shared = _vocabulary(ids.sparkSession, ranks_path)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for decoded in _decoded(batch.column(ids_col), shared.value):
                part = batch.slice(at, len(decoded))
                at += len(decoded)
                yield pa.RecordBatch.from_arrays([*part.columns, decoded], [*part.schema.names, "decoded"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ids.schema)
    return ids.mapInArrow(decode, f"{schema}, decoded binary")
