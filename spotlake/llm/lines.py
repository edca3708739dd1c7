"""Line dedup by an exact set-similarity join.

A line is the set of its words. Words are ordered by rarity over all lines, so that two
lines whose Jaccard similarity reaches the threshold share a word among the rarest few of
each (the prefix filter). Lengths and positions rule out more, and what is left is
verified on whole sets. A line goes if a line before it (by document and line number) matches
it; equal sets match without a join.

The corpus is read three times and its text moves only for lines with a likely match:

1. counts of words in 2**24 cells (an array of fixed size, which is then broadcast: rarity is a
   word's cell count, its hash breaks ties) and the 128-bit signature of each line;
2. postings (word, signature, bitmap, length, position, word before) of the prefixes, without words
   that stand alone; shuffled by word. Length, position, the word before and a bitmap of the words
   (words of one line whose bits the other lacks can't be common) tell which postings have a
   possible partner; those are set in a filter of fixed size;
3. the lines whose postings the filter lets through, shuffled by prefix word and compared
   inside each word's group. A pair is verified in the group of its first common prefix
   word alone. Only a number of links and the earliest match of each line leave a group. Groups
   above ``group_rows`` are dealt in pairs of blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from zlib import compress, decompress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from ..operators.ranges import dense_rank
from .common import checkpointed, numbered, ranked_id, text_blocks, text_bytes, token_spans, word_hashes, written

#: Least Jaccard similarity of matching lines.
THRESHOLD = Fraction(8, 10)
#: Cells of the word counts, bits of the filter, and cells of the table of split groups, as powers of two.
CELL_BITS, FILTER_BITS, SPLIT_BITS = 24, 28, 20
#: Cells of a row that hands over counts.
CHUNK = 1 << 18
#: Largest group that is compared as one.
GROUP_ROWS = 1024
#: Groups up to this size are compared pair by pair, larger ones as matrices.
SMALL_ROWS = 48
#: Postings of a word beyond which all count as having a possible partner without a look.
LOOK_ROWS = 8192
#: Bytes of line texts that a batch carries.
LINE_BYTES = 4 << 20

_LOW = np.uint64(0xFFFFFFFF)
_NULL_ID = np.iinfo(np.int64).max


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _ranges(firsts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers of all ranges, one after the other."""
    return np.repeat(firsts - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))


class _Lines:
    """Words of the lines of some texts; lines without words are left out."""

    def __init__(self, texts: list[bytes]):
        data = np.frombuffer(b"\n".join(texts) + b"\n" if texts else b"", np.uint8)
        ends = np.flatnonzero(data == 10)
        row = np.searchsorted(np.cumsum([len(x) + 1 for x in texts]), ends, side="right")
        number = np.arange(len(ends)) - np.searchsorted(row, row, side="left")
        starts, stops = token_spans(data)
        self.words = word_hashes(data, starts, stops)
        until = np.searchsorted(starts, ends)
        count = np.diff(until, prepend=0)
        used = count > 0
        self.row, self.number = row[used], number[used]
        self.first, self.count = (until - count)[used], count[used]
        self.data, self.line_ends, self.used = data, ends, np.flatnonzero(used)
        n = len(self.first)
        self.one = self.two = np.zeros(0, np.int64)
        if n:
            place = np.arange(len(self.words)) - np.repeat(self.first, self.count)
            weights = np.full(int(self.count.max()), 0x9FB21C651E98DF25, np.uint64)
            weights[0] = 1
            weights = np.cumprod(weights, dtype=np.uint64)[place]
            self.one = _mix(np.add.reduceat(self.words * weights, self.first)).view(np.int64)
            self.two = _mix(np.add.reduceat(_mix(self.words) * weights, self.first)).view(np.int64)

    def text(self, k: int) -> bytes:
        """The text of a line."""
        at = int(self.used[k])
        return self.data[(int(self.line_ends[at - 1]) + 1 if at else 0) : int(self.line_ends[at])].tobytes()

    def sets(self, keep: np.ndarray, counts: np.ndarray) -> "_Sets":
        return _Sets(self, keep, counts)


class _Sets:
    """The distinct words of the lines ``keep``, from rare to frequent, and a bitmap of each."""

    def __init__(self, lines: _Lines, keep: np.ndarray, counts: np.ndarray):
        sizes = lines.count[keep]
        word = lines.words[_ranges(lines.first[keep], sizes)]
        line = np.repeat(np.arange(len(keep)), sizes)
        rarity = counts[(word & np.uint64((1 << CELL_BITS) - 1)).astype(np.int64)]
        key = (line.astype(np.uint64) << np.uint64(42)) | (rarity.astype(np.uint64) << np.uint64(26)) | (word >> np.uint64(38))
        order = np.argsort(key)
        sorted_key = key[order]
        if len(keep) >= 1 << 22 or ((sorted_key[1:] == sorted_key[:-1]) & (word[order][1:] != word[order][:-1])).any():
            order = np.lexsort((word, rarity, line))
        word, line, rarity = word[order], line[order], rarity[order]
        new = np.ones(len(word), bool)
        new[1:] = (word[1:] != word[:-1]) | (line[1:] != line[:-1])
        self.word, self.rarity = word[new], rarity[new]
        line = line[new]
        self.head = np.flatnonzero(np.diff(line, prepend=-1))
        self.size = np.diff(np.append(self.head, len(line)))
        self.low = self.high = np.zeros(0, np.uint64)
        if len(self.head):
            bit = self.word >> np.uint64(57)
            one, low = np.uint64(1) << (bit & np.uint64(63)), bit < 64
            self.low = np.bitwise_or.reduceat(np.where(low, one, np.uint64(0)), self.head)
            self.high = np.bitwise_or.reduceat(np.where(low, np.uint64(0), one), self.head)

    def prefixes(self, threshold: Fraction) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The set, the position and the word of each prefix word that isn't alone, and a number for the prefix word before."""
        length = self.size - _at_least(threshold, self.size) + 1
        line = np.repeat(np.arange(len(self.size)), length)
        place = _ranges(self.head, length)
        shared = self.rarity[place] > 1
        line, place = line[shared], place[shared]
        position = place - self.head[line]
        before = np.where(position > 0, self.word[place - 1] >> np.uint64(32), np.uint64(0)).astype(np.uint32)
        return line, position, self.word[place], before


def _at_least(share: Fraction, n: np.ndarray) -> np.ndarray:
    """The smallest whole number not below share x n."""
    return -(-n * share.numerator // share.denominator)


def _possible(x: dict, i, j, share: Fraction) -> np.ndarray:
    """Whether the sets i and j can match and have their first common prefix word at their positions ``at``: by length and
    position, by the word before (it is not the first if that is common too), and by the bits that one has alone."""
    need = _at_least(share, x["size"][i] + x["size"][j])
    good = np.minimum(x["size"][i] - x["at"][i], x["size"][j] - x["at"][j]) >= need
    good &= (x["before"][i] != x["before"][j]) | (x["at"][i] == 0) | (x["at"][j] == 0)
    for p, q in ((i, j), (j, i)):
        alone = np.bitwise_count(x["low"][p] & ~x["low"][q]).astype(np.int64) + np.bitwise_count(x["high"][p] & ~x["high"][q])
        good &= x["size"][p] - alone >= need
    return good


def _other_lines(one: np.ndarray, x: dict, i, j) -> np.ndarray:
    """Whether the postings i and j are of two lines: by the 32 bits of the signature that travel, by size and position, or by the bitmap."""
    return (one[i] != one[j]) | (x["low"][i] != x["low"][j]) | (x["high"][i] != x["high"][j]) | (x["size"][i] != x["size"][j]) | (x["at"][i] != x["at"][j])


def _near_pairs(run: np.ndarray, length: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of places in the same run, for the runs of at most ``most`` rows, by distance. run: where the run of each place starts."""
    place = np.arange(len(run))
    live = np.flatnonzero((length > 1) & (length <= most))
    step = 1
    while len(live):
        live = live[place[live] + step < run[live] + length[live]]
        if len(live):
            yield live, live + step
        step += 1


def _whole_runs(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...], most: int | None = None) -> Iterator[pa.RecordBatch]:
    """Batches that end where a run of equal keys ends; a run above ``most`` rows comes in pieces."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        change = np.zeros(batch.num_rows - 1, bool)
        for k in keys:
            c = batch.column(k).to_numpy(zero_copy_only=False)
            change |= c[1:] != c[:-1]
        cut = int(np.flatnonzero(change)[-1]) + 1 if change.any() else 0
        if held and any(held[-1].column(k)[-1].as_py() != batch.column(k)[0].as_py() for k in keys):
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held = []
        if cut:
            yield pa.Table.from_batches([*held, batch.slice(0, cut)]).combine_chunks().to_batches()[0]
            held = []
        held.append(batch.slice(cut))
        if most and sum(x.num_rows for x in held) > most:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held = []
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _run_starts(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each place, where its run of equal keys starts and how long it is."""
    n = len(keys[0])
    new = np.ones(n, bool)
    new[1:] = False
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    heads = np.flatnonzero(new)
    sizes = np.diff(np.append(heads, n))
    return np.repeat(heads, sizes), np.repeat(sizes, sizes)


def _common(sets: _Sets, at: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each pair of sets: how many words are common, and how many of them stand before ``at`` in both."""
    pair = np.concatenate([np.repeat(np.arange(len(i)), sets.size[i]), np.repeat(np.arange(len(j)), sets.size[j])])
    place = np.concatenate([_ranges(sets.head[i], sets.size[i]), _ranges(sets.head[j], sets.size[j])])
    before = np.concatenate([place[: int(sets.size[i].sum())] < np.repeat(sets.head[i] + at[i], sets.size[i]), place[int(sets.size[i].sum()) :] < np.repeat(sets.head[j] + at[j], sets.size[j])])
    order = np.lexsort((sets.word[place], pair))
    word, pair, before = sets.word[place][order], pair[order], before[order]
    same = (word[1:] == word[:-1]) & (pair[1:] == pair[:-1])
    n = len(i)
    return np.bincount(pair[1:][same], minlength=n), np.bincount(pair[1:][same & before[1:] & before[:-1]], minlength=n)


def _matrix(sets: _Sets, rows: np.ndarray, at: np.ndarray, share: Fraction) -> np.ndarray:
    """Which of the sets ``rows`` match where their first common prefix word stands at ``at``."""
    size = sets.size[rows]
    place = _ranges(sets.head[rows], size)
    distinct, code = np.unique(sets.word[place], return_inverse=True)
    row = np.repeat(np.arange(len(rows)), size)
    has = np.zeros((len(rows), len(distinct)), np.float32)
    has[row, code] = 1
    match = has @ has.T >= _at_least(share, size[:, None] + size)
    np.fill_diagonal(match, False)
    if match.any():
        later = place - sets.head[rows][row] >= at[row]
        has[row[later], code[later]] = 0
        match &= has @ has.T == 0
    return match


def similar_lines(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", threshold: Fraction = THRESHOLD, group_rows: int = GROUP_ROWS) -> DataFrame:
    """One row per doc_id: n_lines (with words), n_links, removed (line numbers from 0, ascending) and class_id.

    A line links with every other line text (white space aside) whose word set has Jaccard similarity
    ``threshold`` or more with its own; n_links adds the links of a document's lines. A line is
    removed if a matching line, or one of the same words, stands before it: in a smaller doc_id, or
    earlier in its own. class_id is the smallest doc_id in which a match of one of its lines stands,
    its own included.

    Words are runs without ASCII white space, case and all, and lines end at line feeds. Lines
    without words (and null and empty texts) have no part: their documents have no lines, no
    links and their own class. Ids may be of any type that has an order; null ids are one document, the greatest (a class is null only if all of it is). Rows that
    repeat an id are one document whose lines of equal number are tied, and a tie stays. An empty table gives an empty result; other
    columns are not read. Words are compared by 64-bit hashes and lines told apart by 128 bits. A link is
    overlooked only if all postings of two lines look alike in 32 bits of their signatures, a bitmap of 128 and
    their numbers of words, or if the words before their first common one are different but agree in 32 bits.
    """
    named, docs = _whole_ids(docs, id_col, text_col)
    context = docs.sparkSession.sparkContext
    rows = docs.select(F.coalesce("id", F.lit(_NULL_ID)).alias("doc_id"), "text")
    cells, share = 1 << CELL_BITS, threshold / (1 + threshold)

    def survey(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(cells, np.uint32)
        names = ["doc_id", "number", "one", "two", "chunk", "counts"]
        for block in text_blocks(batches, "text"):
            lines = _Lines(text_bytes(block.column("text")))
            cell, n = np.unique((lines.words & np.uint64(cells - 1)).astype(np.uint32), return_counts=True)
            total[cell] += n.astype(np.uint32)
            doc = block.column("doc_id").to_numpy()[lines.row]
            yield pa.RecordBatch.from_arrays([pa.array(doc), pa.array(lines.number.astype(np.int32)), pa.array(lines.one), pa.array(lines.two), pa.nulls(len(doc), pa.int32()), pa.nulls(len(doc), pa.binary())], names)
        used = [k for k in range(cells // CHUNK) if total[k * CHUNK : (k + 1) * CHUNK].any()]
        packed = [compress(np.minimum(total[k * CHUNK : (k + 1) * CHUNK], 65535).astype(np.uint16).tobytes(), 1) for k in used]
        none = pa.nulls(len(used), pa.int64())
        yield pa.RecordBatch.from_arrays([none, pa.nulls(len(used), pa.int32()), none, none, pa.array(used, pa.int32()), pa.array(packed, pa.binary())], names)

    # A row for each line: as Parquet, whose columns of ids and numbers are small.
    surveyed = written(rows.mapInArrow(survey, "doc_id long, number int, one long, two long, chunk int, counts binary"))
    found = surveyed.where("chunk is null").select("doc_id", "number", "one", "two")

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, packed in zip(batch.column("chunk").to_pylist(), batch.column("counts").to_pylist(), strict=True):
                sums[k] = np.minimum(sums.get(k, 0) + np.frombuffer(decompress(packed), np.uint16).astype(np.uint32), 65535)
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([compress(x.astype(np.uint16).tobytes(), 1) for x in sums.values()], pa.binary())], ["chunk", "counts"])

    # 64 chunks of a fixed size: 32 MB in all.
    tallied = np.zeros(cells, np.uint16)
    for r in surveyed.where("chunk is not null").select("chunk", "counts").repartition("chunk").mapInArrow(add_up, "chunk int, counts binary").toLocalIterator():
        tallied[r["chunk"] * CHUNK : (r["chunk"] + 1) * CHUNK] = np.frombuffer(decompress(bytes(r["counts"])), np.uint16)
    counts = context.broadcast(tallied)

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for block in text_blocks(batches, "text"):
            lines = _Lines(text_bytes(block.column("text")))
            one, at = np.unique(lines.one, return_index=True)
            fresh = at[[x not in seen for x in one.tolist()]] if seen else at
            seen.update(one.tolist())
            if len(seen) > 1_000_000:
                seen.clear()
            sets = lines.sets(fresh, counts.value)
            line, position, word, before = sets.prefixes(threshold)
            named = (word << np.uint64(32)) | (lines.one[fresh][line].view(np.uint64) & _LOW)
            made = (named, sets.low[line], sets.high[line], sets.size[line] << 32 | position)
            yield pa.RecordBatch.from_arrays([*(pa.array(x.view(np.int64)) for x in made), pa.array(before.view(np.int32))], ["named", "low", "high", "placed", "before"])

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, before = None, 0  # the word that the batch before ended with, and its rows so far
        for batch in _whole_runs(batches, ("word",), 2 * LOOK_ROWS):
            word = batch.column("word").to_numpy()
            named, low, high, placed = (batch.column(k).to_numpy().view(np.uint64) for k in ("named", "low", "high", "placed"))
            one = _half(named)
            x = {"size": (placed >> np.uint64(32)).astype(np.int64), "at": (placed & _LOW).astype(np.int64), "before": batch.column("before").to_numpy(), "low": low, "high": high}
            run, length = _run_starts(word)
            live = np.zeros(len(word), bool)
            total = length.copy()
            if word[0] == last:  # the rest of a run that was cut: its partners may stand in the pieces before
                total[run == 0] += before
                live[run == 0] = True
            last, before = word[-1], int(total[-1])
            for i, j in _near_pairs(run, length, SMALL_ROWS):
                good = _other_lines(one, x, i, j) & _possible(x, i, j, share)
                live[i[good]] = live[j[good]] = True
            for head in np.unique(run[length > SMALL_ROWS]).tolist():
                rows_of = np.arange(head, head + int(length[head]))
                if len(rows_of) > LOOK_ROWS:
                    live[rows_of] = True
                    continue
                for at in range(0, len(rows_of), 256):
                    part = rows_of[at : at + 256, None]
                    good = _other_lines(one, x, part, rows_of[None, :]) & _possible(x, part, rows_of[None, :], share)
                    live[rows_of[at : at + 256]] |= good.any(axis=1)
            hot = np.unique(run[total > group_rows])
            key = np.concatenate([_key(word[live], one[live]), _key(np.zeros(int(live.sum()), np.int32), one[live])])
            key = np.unique(key & np.uint64((1 << FILTER_BITS) - 1)).astype(np.int64)
            made = (np.concatenate([key, word[hot].astype(np.int64) & ((1 << SPLIT_BITS) - 1)]), np.concatenate([np.zeros(len(key), np.int64), total[hot]]))
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in made], ["cell", "rows"])

    # Five numbers a posting: word and signature, the bitmap, length and position, and the word before.
    postings = rows.mapInArrow(post, "named long, low long, high long, placed long, before int")
    by_word = F.shiftright("named", 32).cast("int")
    looked = postings.repartition(by_word).sortWithinPartitions("named").select(by_word.alias("word"), "named", "low", "high", "placed", "before").mapInArrow(look, "cell long, rows long")
    at, bit = F.expr("cell >> 6"), F.expr("shiftleft(1L, cast(cell & 63 as int))")
    # Both tables that go to all tasks have a fixed size: 2**28 bits, and a number per cell.
    tables = checkpointed(looked.groupBy(F.when(F.col("rows") == 0, at).otherwise(-1 - F.col("cell")).alias("at")).agg(F.bit_or(F.when(F.col("rows") == 0, bit).otherwise(0)).alias("bits"), F.max("rows").alias("rows")))
    kept = tables.where("at >= 0").select("at", "bits").toArrow()
    filter_bits = np.zeros(1 << (FILTER_BITS - 6), np.uint64)
    filter_bits[kept["at"].to_numpy()] = kept["bits"].to_numpy().view(np.uint64)
    hot = tables.where("at < 0").select("at", "rows").toArrow()
    blocks = np.ones(1 << SPLIT_BITS, np.int32)
    blocks[-1 - hot["at"].to_numpy()] = -(-hot["rows"].to_numpy() // group_rows)
    passing, split = context.broadcast(filter_bits), context.broadcast(blocks)

    def passes(key: np.ndarray) -> np.ndarray:
        cell = (key & np.uint64((1 << FILTER_BITS) - 1)).astype(np.int64)
        return (passing.value[cell >> 6] >> (cell & 63).astype(np.uint64)) & np.uint64(1) == 1

    def bring(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, tuple[int, int]] = {}
        names = ["word", "i", "j", "block", "at", "doc", "number", "line"]
        for block in text_blocks(batches, "text"):
            lines = _Lines(text_bytes(block.column("text")))
            doc = block.column("doc_id").to_numpy()[lines.row]
            keep = []
            hit = np.flatnonzero(passes(_key(np.zeros(len(lines.one), np.int32), _half(lines.one.view(np.uint64)))))
            for k, s, place in zip(hit.tolist(), lines.one[hit].tolist(), zip(doc[hit].tolist(), lines.number[hit].tolist(), strict=True), strict=True):
                if (before := seen.get(s)) is None or place < before:  # only what is new to the task, or earlier
                    seen[s] = place
                    keep.append(k)
            if len(seen) > 1_000_000:
                seen.clear()
            keep = np.array(keep, np.int64)
            sets = lines.sets(keep, counts.value)
            line, position, word, _ = sets.prefixes(threshold)
            good = passes(_key(_half(word), _half(lines.one[keep][line].view(np.uint64))))
            line, position, word = line[good], position[good], word[good]
            n = split.value[_half(word).astype(np.int64) & ((1 << SPLIT_BITS) - 1)].astype(np.int64)
            own = (lines.two[keep][line].view(np.uint64) % n.astype(np.uint64)).astype(np.int64)
            pick, other = np.repeat(np.arange(len(line)), n), _ranges(np.zeros(len(n), np.int64), n)
            i, j = np.minimum(own[pick], other), np.maximum(own[pick], other)
            texts = {k: lines.text(int(keep[k])) for k in np.unique(line).tolist()}
            line = line[pick]
            # Batches of bounded bytes: a long line is in as many as it has words with a likely match.
            ends = np.cumsum([len(texts[k]) + 40 for k in line.tolist()], dtype=np.int64)
            at = 0
            while at < len(pick):
                p = slice(at, max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + LINE_BYTES, side="right"))))
                at = p.stop
                made = [word[pick[p]].view(np.int64), i[p].astype(np.int32), j[p].astype(np.int32), own[pick[p]].astype(np.int32), position[pick[p]].astype(np.int32), doc[keep[line[p]]], lines.number[keep[line[p]]].astype(np.int32)]
                yield pa.RecordBatch.from_arrays([*(pa.array(x) for x in made), pa.array([texts[k] for k in line[p].tolist()], pa.binary())], names)

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _whole_runs(batches, ("word", "i", "j")):
            lines = _Lines(batch.column("line").to_pylist())
            word, i, j, own, at, doc, number = (batch.column(k).to_numpy() for k in ("word", "i", "j", "block", "at", "doc", "number"))
            order = np.lexsort((number, doc, lines.two, lines.one, j, i, word))  # the earliest place of each line in each run
            new = np.ones(len(order), bool)
            new[1:] = False
            for c in (word, i, j, lines.one, lines.two):
                new[1:] |= c[order][1:] != c[order][:-1]
            order = order[new]
            word, i, j, own, at, doc, number = (c[order] for c in (word, i, j, own, at.astype(np.int64), doc, number))
            sets = lines.sets(order, counts.value)
            before = np.where(at > 0, sets.word[np.maximum(sets.head + at - 1, 0)], np.uint64(0))
            x = {"size": sets.size, "at": at, "low": sets.low, "high": sets.high, "before": before}
            rank = np.empty(len(order), np.int64)
            by_place = np.lexsort((number, doc))
            rank[by_place] = np.arange(len(order))
            links, least = np.zeros(len(order), np.int64), np.full(len(order), len(order))
            run, length = _run_starts(word, i, j)
            pairs = [(a[g], b[g]) for a, b in _near_pairs(run, length, SMALL_ROWS) for g in [((i[a] == j[a]) | (own[a] != own[b])) & _possible(x, a, b, share)]]
            a, b = (np.concatenate(c) for c in zip(*pairs, strict=True)) if pairs else (np.zeros(0, np.int64),) * 2
            for k in range(0, len(a), 20_000):
                p, q = a[k : k + 20_000], b[k : k + 20_000]
                common, before = _common(sets, at, p, q)
                good = (common >= _at_least(share, sets.size[p] + sets.size[q])) & (before == 0)
                p, q = p[good], q[good]
                links += np.bincount(p, minlength=len(links)) + np.bincount(q, minlength=len(links))
                np.minimum.at(least, p, rank[q])
                np.minimum.at(least, q, rank[p])
            for head in np.unique(run[length > SMALL_ROWS]).tolist():
                members = np.arange(head, head + int(length[head]))
                match = _matrix(sets, members, at[members], share)
                if i[head] != j[head]:
                    match &= own[members][:, None] != own[members]
                links[members] += match.sum(axis=1)
                least[members] = np.minimum(least[members], np.where(match, rank[members], len(order)).min(axis=1))
            hit = np.flatnonzero(links)
            at_least = by_place[least[hit]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in (lines.one[order][hit], lines.two[order][hit], links[hit], doc[at_least], number[at_least])], ["one", "two", "links", "doc_id", "number"])

    kinds = "word long, i int, j int, block int, at int, doc long, number int, line binary"
    groups = rows.mapInArrow(bring, kinds).repartition("word", "i", "j").sortWithinPartitions("word", "i", "j")
    matches = groups.mapInArrow(verify, "one long, two long, links long, doc_id long, number int")

    place = F.struct("doc_id", "number")
    every = found.select("one", "two", F.lit(0).cast("long").alias("links"), F.lit(1).alias("n"), place.alias("place")).unionAll(matches.select("one", "two", "links", F.lit(0), place))
    # Lines that stand alone go on without a row in the join.
    sets = checkpointed(every.groupBy("one", "two").agg(F.sum("links").alias("links"), F.sum("n").alias("n"), F.min("place").alias("least")).where("n > 1 or links > 0").drop("n"))
    judged = found.join(sets, ["one", "two"], "left").withColumn("gone", F.coalesce(F.col("least") < place, F.lit(False)))
    zero = F.lit(0).cast("long")
    by_doc = judged.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.sum(F.coalesce("links", zero)).alias("n_links"),
        F.array_sort(F.collect_set(F.when(F.col("gone"), F.col("number")))).alias("removed"),
        F.min(F.coalesce("least.doc_id", "doc_id")).alias("class_id"),
    )
    joined = rows.select("doc_id").distinct().join(by_doc, "doc_id", "left")
    known = lambda c: F.when(c != _NULL_ID, c)
    out = joined.select(
        known(F.col("doc_id")).alias("doc_id"),
        F.coalesce("n_lines", zero).alias("n_lines"),
        F.coalesce("n_links", zero).alias("n_links"),
        F.coalesce("removed", F.array().cast("array<int>")).alias("removed"),
        known(F.coalesce("class_id", "doc_id")).alias("class_id"),
    )
    if named is None:
        return out
    own, of_class = (named.select(F.col("id").alias(a), F.col("i").alias(b)) for a, b in (("_own", "doc_id"), ("_class", "class_id")))
    return out.join(own, "doc_id", "left").join(of_class, "class_id", "left").select(F.col("_own").alias("doc_id"), "n_lines", "n_links", "removed", F.col("_class").alias("class_id"))


def _whole_ids(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame | None, DataFrame]:
    """id (a long in the order of the ids, null where they are) and text of ``docs``; first, of ids that aren't whole numbers, what each stands for (id, i)."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    if isinstance(rows.schema["id"].dataType, IntegralType):
        return None, rows.select(F.col("id").cast("long").alias("id"), "text")
    named = checkpointed(dense_rank(rows, "id"))
    return named, rows.join(named, "id", "left").select(F.col("i").alias("id"), "text")


def _half(x: np.ndarray) -> np.ndarray:
    """The lower 32 bits, as they travel in a posting."""
    return x.astype(np.uint32).view(np.int32)


def _key(word: np.ndarray, one: np.ndarray) -> np.ndarray:
    """A number of a posting; that of a line has word 0."""
    return _mix(_mix(word.view(np.uint32).astype(np.uint64)) + one.view(np.uint32))


def drop_similar_lines(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """``docs`` with the later ones of matching lines taken out of each text; all rows and columns kept, whatever their names. Each row is a
    document of its own: rows that repeat an id come in any one order, and those of null ids last."""
    rows, row = numbered(docs)
    place, removed = f"{row}_place", f"{row}_removed"
    while {place, removed} & {c.lower() for c in docs.columns}:
        place, removed = f"{place}_", f"{removed}_"
    ranks = checkpointed(dense_rank(rows.select(ranked_id(id_col, row).alias("at")), "at").select(F.col("at.row").alias(row), F.col("i").alias(place)))
    ranked = rows.join(ranks, row)
    gone = similar_lines(ranked.select(F.col(place).alias("doc_id"), F.col(text_col).alias("text")), **how).where(F.size("removed") > 0)
    gone = checkpointed(gone.select(F.col("doc_id").alias(place), F.col("removed").alias(removed)))
    kept = F.filter(F.split(F.col(text_col), "\n", -1), lambda x, k: ~F.array_contains(F.col(removed), k))
    out = ranked.join(gone, place, "left")
    return out.withColumn(text_col, F.when(F.col(removed).isNull(), F.col(text_col)).otherwise(F.array_join(kept, "\n"))).select(*docs.columns)
