"""SimHash near-dedup with vantage-point trees.

Fingerprints are made where the documents lie; from there on only (doc_id, fingerprint)
moves, and equal fingerprints are one row.

Pairs within ``distance`` bits are found exactly. The 64 bits are cut into bands, and each
combination of bands defines a restricted Hamming distance, which never exceeds the full one;
by the pigeonhole principle two fingerprints within ``distance`` bits agree on all bits of at
least one combination. For each combination there is a vantage-point tree in its restricted
distance: every level deals the fingerprints into shells by their distance to a fixed vantage
point. The triangle bound says that partners differ by at most the search radius in their
distance to every vantage point, so all other branches are pruned; as the radius in the
tree's own distance is 0, a fingerprint's only branch is its own shell path, and each tree
costs one row per fingerprint. The overlap that the full distance would need at every
boundary (nearly all fingerprints, as Hamming distances crowd around 32) is what the bands
take the place of. A shard is a leaf of a tree; a leaf above ``leaf_rows`` is split
into blocks whose pairs are dealt to separate tasks.

``similar_groups`` asks for a Jaccard similarity instead: wide fingerprints of the shingle sets name candidates by the same trees,
and two texts are linked only after their sets were compared.

Inside a shard a local vantage point orders the members by full distance, and only those
within the triangle bound of each other are compared. A task reports a spanning forest of
its shard, never all pairs, and components are joined by alternating large-star and
small-star rounds.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from fractions import Fraction
from itertools import combinations
from math import acos, ceil, comb, log, pi, sqrt

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import FEW_ROWS, checkpointed, chosen_rows, numbered, ranked_id, text_blocks, text_bytes

#: Fingerprints link at this many differing bits or fewer; words in a shingle; seed of XXH64.
DISTANCE, SHINGLE_WORDS, SEED = 4, 4, 42
#: Levels of each tree; more levels than a mask has bits bring little.
LEVELS = 16
#: Comparisons that take as long as moving one row.
ROW_COST = 2000
#: A leaf with more members than this is split into blocks.
LEAF_ROWS = 4096
#: 64-bit words of a wide fingerprint, words in its shingles, and the similarity that counts as near.
WIDE, WIDE_SHINGLE_WORDS, SIMILARITY = 4, 5, 0.8
#: Probability with which a pair of just that similarity may share no leaf, and deviations of their differing bits that are allowed for.
MISSED, DEVIATIONS = 0.02, 3
#: Bytes of shingle sets that a task compares at once with as many others.
SET_BYTES = 64 << 20


def _shingle_hashes(text: bytes, words_per_shingle: int) -> np.ndarray:
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    if len(words) <= words_per_shingle:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    ends = np.cumsum([len(w) + 1 for w in words]).tolist()
    starts = [0, *ends[: len(words) - words_per_shingle]]
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[a : b - 1], SEED) for a, b in zip(starts, ends[words_per_shingle - 1 :], strict=True)], np.uint64)


def _majority(hashes: np.ndarray) -> int:
    """The bits that are 1 in over half of the hashes."""
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 4096):
        counts += np.unpackbits(hashes[at : at + 4096].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(hashes)).tobytes(), "big")


def fingerprint(text: bytes, words_per_shingle: int = SHINGLE_WORDS) -> int:
    """SimHash of a text's word shingles; 0 without words."""
    return _majority(_shingle_hashes(text, words_per_shingle))


def shingle_set(text: bytes, words_per_shingle: int) -> np.ndarray:
    """The distinct hashes of a text's word shingles, in order."""
    return np.unique(_shingle_hashes(text, words_per_shingle))


def wide_fingerprint(shingles: np.ndarray) -> list[int]:
    """SimHash of ``WIDE`` words of 64 bits of a set of hashes: of these, and of what a mixer makes of them and the word's number."""
    out = [_majority(shingles)]
    for k in range(1, WIDE):
        x = shingles + np.uint64(k * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        out.append(_majority(x ^ (x >> np.uint64(31))))
    return out


def alike(x: np.ndarray, y: np.ndarray, similarity: Fraction) -> bool:
    """Whether two sets (sorted) have at least this Jaccard similarity."""
    if len(x) > len(y):
        x, y = y, x
    part, whole = similarity.numerator, similarity.numerator + similarity.denominator
    need = part * (len(x) + len(y))
    if whole * len(x) < need:
        return False
    at = np.minimum(np.searchsorted(y, x), len(y) - 1)
    return whole * int((y[at] == x).sum()) >= need


def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", words_per_shingle: int = SHINGLE_WORDS) -> DataFrame:
    """doc_id and fp (the fingerprint's 64 bits as a long) of every whole text.

    A-Z are lower-cased and words are runs without ASCII white space; a text of fewer words than
    a shingle is one shingle, and one without words (null and empty ones too) has fingerprint 0.
    """

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in text_blocks(batches, "text"):
            made = np.array([fingerprint(t, words_per_shingle) for t in text_bytes(block.column("text"))], np.uint64)
            yield pa.RecordBatch.from_arrays([block.column("doc_id"), pa.array(made.view(np.int64))], ["doc_id", "fp"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(make, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, fp long")


def masks(distance: int, bands: int) -> list[int]:
    """Bits of each tree: all combinations of ``bands - distance`` bands."""
    if bands <= distance:
        raise ValueError("more bands than differing bits are needed")
    cuts = [64 * k // bands for k in range(bands + 1)]
    band = [(1 << cuts[k + 1]) - (1 << cuts[k]) for k in range(bands)]
    return [sum(c) for c in combinations(band, bands - distance)]


def bands_for(rows: int, distance: int) -> int:
    """Bands that make the least work for so many distinct fingerprints: each tree costs a row per fingerprint, and
    compares those that share one of 2**bits leaves. A row costs about as much as ``ROW_COST`` comparisons."""

    def work(bands: int) -> float:
        trees, bits = comb(bands, distance), 64 * (bands - distance) / bands
        return trees * (rows * ROW_COST + rows * rows / 2 ** (bits + 1))

    return min(range(distance + 1, distance + 5), key=work)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _leaves(fps: DataFrame, distance: int, bands: int) -> DataFrame:
    """A row (fp, leaf) for each fingerprint and tree; the leaf is a hash of the tree and the shell path."""
    points = [xxhash.xxh64_intdigest(b"vantage %d" % k) for k in range(LEVELS)]
    paths = []
    for tree, mask in enumerate(masks(distance, bands)):
        shells = [F.bit_count(F.col("fp").bitwiseXOR(F.lit(_signed(p))).bitwiseAND(F.lit(_signed(mask)))) for p in points]
        paths.append(F.xxhash64(F.lit(tree), *shells))
    return fps.select("fp", F.explode(F.array(*paths)).alias("leaf"))


def _find(parent: np.ndarray, x: int) -> int:
    while parent[x] != x:
        parent[x] = parent[parent[x]]
        x = parent[x]
    return x


def _one_each(parent: np.ndarray, a: int, partners: np.ndarray) -> list[tuple[int, int]]:
    """(a, b) for one partner b of each component among the partners."""
    roots = parent[partners]
    while (up := parent[roots]).size and (up != roots).any():
        roots = up
    return [(a, int(partners[k])) for k in np.unique(roots, return_index=True)[1]]


def _differing(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Bits in which fingerprints (their words along the last axis) differ."""
    return np.bitwise_count(x ^ y).sum(axis=-1, dtype=np.int64)


def forest(left: np.ndarray, right: np.ndarray | None, distance: int, linked: Callable[[int, int], bool] | None = None) -> list[tuple[int, int]]:
    """Spanning forest of the pairs within ``distance`` among ``left`` (or between both sides; a row of words each), as places
    in both sides, one after the other. With ``linked``, a pair must also pass it; it is asked only of pairs that no others connect.

    Both sides are ordered by their distance to one vantage point, so that the triangle bound
    leaves a window of the other side to compare with."""
    both = left if right is None else np.concatenate([left, right])
    far = _differing(both, left[0])
    parent = np.arange(len(both))
    own = np.argsort(far[: len(left)], kind="stable")
    other = own if right is None else len(left) + np.argsort(far[len(left) :], kind="stable")
    other_far, other_values = far[other], both[other]
    edges = []
    for at in range(0, len(own), 256):
        rows = own[at : at + 256]
        lo = at + 1 if right is None else int(np.searchsorted(other_far, far[rows[0]] - distance))
        hi = int(np.searchsorted(other_far, far[rows[-1]] + distance, side="right"))
        if lo >= hi:
            continue
        hits = _differing(both[rows][:, None], other_values[None, lo:hi]) <= distance
        if linked is not None:
            for a, hit in zip(rows.tolist(), hits, strict=True):
                partners = other[lo:hi][hit]
                while len(partners):
                    roots = partners
                    while (up := parent[roots]).size and (up != roots).any():
                        roots = up
                    x = _find(parent, a)
                    partners = partners[roots != x]
                    for k, b in enumerate(partners.tolist()):
                        if linked(a, b):
                            y = _find(parent, b)
                            parent[max(x, y)] = min(x, y)
                            edges.append((a, b))
                            break
                    else:
                        break
                    partners = partners[k + 1 :]
            continue
        i, j = np.nonzero(hits)
        pairs = zip(rows[i].tolist(), other[lo + j].tolist(), strict=True)
        if len(i) > 8 * len(rows):  # a dense group: one partner of each component will do
            pairs = (x for a, hit in zip(rows.tolist(), hits, strict=True) for x in _one_each(parent, a, other[lo:hi][hit]))
        for a, b in pairs:
            x, y = _find(parent, a), _find(parent, b)
            if x != y:
                parent[max(x, y)] = min(x, y)
                edges.append((a, b))
    return edges


def near_edges(fps: DataFrame, *, distance: int = DISTANCE, bands: int | None = None, leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """Edges (a, b) between the distinct fingerprints of ``fps`` (column fp), enough to connect all that
    pairs within ``distance`` connect. ``bands``: more of them make more trees with smaller leaves; left out,
    their number follows from that of the fingerprints."""
    leaves = _leaves(fps, distance, bands or bands_for(fps.count(), distance))
    return _edges_in_leaves(leaves, "fp", ("fp",), distance, leaf_rows)


def _edges_in_leaves(
    leaves: DataFrame, node: str, words: tuple[str, ...], distance: int, leaf_rows: int, *, sizes: DataFrame | None = None, shingles: str | None = None, similarity: Fraction = Fraction(0)
) -> DataFrame:
    """Edges (a, b) between nodes: a spanning forest of the pairs within ``distance`` of each leaf. ``leaves``: leaf, node, and the
    words of its fingerprint (of which the node may be one). ``sizes``: leaf and blocks (in how many it is dealt), if known. ``shingles``: a column
    of shingle sets, which must have the ``similarity`` too."""
    columns = list(dict.fromkeys([node, *words, *([shingles] if shingles else [])]))
    if sizes is None:
        # Written, so that a hot leaf can be split in the join.
        sizes = checkpointed(leaves.groupBy("leaf").agg(F.count(F.lit(1)).alias("n")).where("n > 1")).select("leaf", F.ceil(F.col("n") / leaf_rows).cast("int").alias("blocks"))
    dealt = leaves.join(sizes, "leaf").withColumn("block", F.pmod(F.xxhash64(node, "leaf"), F.col("blocks")).cast("int"))
    # Each row goes to the pairs of blocks that its own is in: one pair unless the leaf was split.
    with_block = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda k: F.struct(F.least(k, F.col("block")).alias("i"), F.greatest(k, F.col("block")).alias("j")))
    dealt = dealt.select("leaf", *columns, "block", F.explode(with_block).alias("pair"))
    keys = ["leaf", "i", "j"]
    dealt = dealt.select("leaf", "pair.i", "pair.j", "block", *columns)

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []

        def done() -> pa.RecordBatch:
            cols = [np.concatenate(c) for c in zip(*held, strict=True)]
            leaf, i, j, block = cols[:4]
            by_name = dict(zip(columns, cols[4:], strict=True))
            values = np.stack([by_name[w].view(np.uint64) for w in words], axis=1)
            cut = np.flatnonzero((leaf[1:] != leaf[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])) + 1
            found, linked = [], None
            for a, b in zip([0, *cut.tolist()], [*cut.tolist(), len(leaf)], strict=True):
                if b - a < 2:
                    continue
                place = np.arange(a, b)
                if shingles:
                    sets = [np.frombuffer(x, np.uint64) for x in by_name[shingles][a:b]]
                    linked = lambda x, y, place=place, sets=sets, a=a: alike(sets[place[x] - a], sets[place[y] - a], similarity)
                if i[a] == j[a]:
                    edges = forest(values[a:b], None, distance, linked)
                elif (first := block[a:b] == i[a]).any() and not first.all():
                    place = np.concatenate([place[first], place[~first]])
                    if shingles:
                        linked = lambda x, y, place=place, sets=sets, a=a: alike(sets[place[x] - a], sets[place[y] - a], similarity)
                    edges = forest(values[a:b][first], values[a:b][~first], distance, linked)
                else:
                    continue
                if edges:
                    found.append(place[np.array(edges)])
            ends = by_name[node][np.concatenate(found)] if found else np.zeros((0, 2), np.int64)
            return pa.RecordBatch.from_arrays([pa.array(ends[:, 0]), pa.array(ends[:, 1])], ["a", "b"])

        # Batches may end inside a shard: its rows wait for the rest of it.
        for batch in batches:
            if not batch.num_rows:
                continue
            cols = tuple(batch.column(k).to_numpy(zero_copy_only=False) for k in ("leaf", "i", "j", "block", *columns))
            same = (cols[0] == cols[0][-1]) & (cols[1] == cols[1][-1]) & (cols[2] == cols[2][-1])
            whole = int(len(same) - np.argmin(same[::-1])) if not same.all() else 0
            if whole:
                held.append(tuple(c[:whole] for c in cols))
                yield done()
                held = [tuple(c[whole:] for c in cols)]
            else:
                if held and any(held[-1][k][-1] != cols[k][0] for k in range(3)):
                    yield done()
                    held = []
                held.append(cols)
        if held:
            yield done()

    shards = dealt.repartition(*keys).sortWithinPartitions(*keys)
    return shards.mapInArrow(link, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """node and root (the smallest node, as a signed long, that edges connect it with) of every node of ``edges`` (a, b).

    Alternating large-star and small-star rounds until nothing changes; each round is a
    grouped minimum and a join, so no node's neighbours are gathered."""
    edges = checkpointed(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    while True:
        # Large star: larger neighbours move to the smallest neighbour (or the node itself).
        both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # Small star: smaller neighbours and the node itself move to the smallest one.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        after = checkpointed(moved.unionAll(least.select("u", F.col("m").alias("v"))).distinct())
        same = after.exceptAll(edges).limit(1).count() == 0 and after.count() == edges.count()
        edges = after
        if same:
            break
    return edges.groupBy("u").agg(F.min("v").alias("root")).withColumnRenamed("u", "node").unionAll(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def near_groups(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", words_per_shingle: int = SHINGLE_WORDS, distance: int = DISTANCE, bands: int | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (16 hex digits) and component_id, the smallest
    doc_id that links of ``distance`` bits or fewer reach (its own included).

    Equal fingerprints link, those of texts without words too. Rows that repeat an id each have
    their row. Null ids are never a component's id unless it has no other. An empty table
    gives an empty result. Other columns are not read.
    """
    prints = checkpointed(fingerprints(docs, id_col=id_col, text_col=text_col, words_per_shingle=words_per_shingle))
    # Of each fingerprint the smallest id: copies are one row from here on.
    nodes = checkpointed(prints.groupBy("fp").agg(F.min("doc_id").alias("first")))
    roots = components(near_edges(nodes.select("fp"), distance=distance, bands=bands))
    linked = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    least = checkpointed(linked.groupBy("root").agg(F.min("first").alias("component_id")))
    found = linked.join(least, "root").select("fp", "component_id")
    return prints.join(found, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def far_bits(similarity: float) -> tuple[float, float]:
    """Share of the bits in which wide fingerprints of texts with just this Jaccard similarity differ (their shingle sets being
    of one size), and how many they differ in at most but for chances beyond ``DEVIATIONS``."""
    share = acos(2 * similarity / (1 + similarity)) / pi
    n = 64 * WIDE
    return share, share * n + DEVIATIONS * sqrt(n * share * (1 - share))


def trees_for(rows: int, share: float) -> tuple[int, int]:
    """Bits that a tree looks at, and trees, that make the least work for so many fingerprints, while texts whose
    fingerprints differ in ``share`` of the bits share a leaf but for ``MISSED``."""

    def trees(bits: int) -> int:
        return ceil(log(MISSED) / log(1 - (1 - share) ** bits))

    bits = min(range(6, 33), key=lambda k: trees(k) * (rows * ROW_COST + WIDE * rows * rows / 2 ** (k + 1)))
    return bits, trees(bits)


def similar_groups(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    words_per_shingle: int = WIDE_SHINGLE_WORDS,
    similarity: float = SIMILARITY,
    leaf_rows: int = LEAF_ROWS,
    bits_and_trees: tuple[int, int] | None = None,
    key: str | None = None,
) -> DataFrame:
    """doc_id and component_id (the smallest doc_id that links reach, its own included) of every row of ``docs``.

    Texts link if the Jaccard similarity of their sets of word shingles is ``similarity`` or more, which is checked on the sets of every
    pair before it is linked. Candidates are pairs whose wide SimHash fingerprints differ in no more bits than ``far_bits``. The trees are
    those of ``near_edges``, but each looks at some bits drawn from all; partners agree on all of them in one tree at least, but for ``MISSED`` of the
    pairs at the very similarity, and fewer of more similar ones: whatever ``trees_for`` (or ``bits_and_trees``) chooses, such a pair may be overlooked
    with that chance, and no pair below the similarity is ever linked. Texts that candidates connect meet in one task, or in
    pairs of blocks where they are many, and their sets are compared but for pairs that verified links connect already.

    Equal sets are one node. Texts without words link with one another, shorter ones than a shingle are one shingle. Null ids are a component's id only if it has
    no other. Rows that repeat an id each have their row. An empty table gives an empty result; other columns are not read. ``key``: a field of the id (a struct) that is unique in itself.
    """
    share, most = far_bits(similarity)
    exact = Fraction(str(similarity))
    words = tuple(f"w{k}" for k in range(WIDE))

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in text_blocks(batches, "text"):
            sets = [shingle_set(t, words_per_shingle) for t in text_bytes(block.column("text"))]
            made = np.array([wide_fingerprint(x) for x in sets], np.uint64).reshape(-1, WIDE).view(np.int64)
            node = np.array([xxhash.xxh3_64_intdigest(x.tobytes()) for x in sets], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([block.column("doc_id"), pa.array(node), pa.array([len(x) for x in sets], pa.int32()), *(pa.array(made[:, k]) for k in range(WIDE))], ["doc_id", "node", "size", *words])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    prints = checkpointed(rows.mapInArrow(make, f"doc_id {kind}, node long, size int, {', '.join(f'{w} long' for w in words)}"))
    nodes = checkpointed(prints.groupBy("node", "size", *words).agg(F.min("doc_id").alias("first")))
    bits, trees = bits_and_trees or trees_for(nodes.count(), share)
    draw = np.random.default_rng(SEED)
    masks = np.zeros((trees, WIDE), np.uint64)
    for t in range(trees):
        for b in draw.choice(64 * WIDE, bits, replace=False).tolist():
            masks[t, b // 64] |= np.uint64(1) << np.uint64(b % 64)
    points = draw.integers(0, 1 << 63, (LEVELS, WIDE), np.uint64)

    def plant(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for each tree: the leaf is a hash of the tree and of the shells around the vantage points, in the distance over the tree's bits."""
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                values = np.stack([part.column(w).to_numpy() for w in words], axis=1).view(np.uint64)
                leaf = np.zeros((trees, part.num_rows), np.uint64)
                for t in range(trees):
                    leaf[t] = t + 1
                    for p in points:
                        leaf[t] = (leaf[t] ^ _differing(values & masks[t], p & masks[t]).astype(np.uint64)) * np.uint64(0x9FB21C651E98DF25)
                        leaf[t] ^= leaf[t] >> np.uint64(29)
                again = [np.tile(part.column(c).to_numpy(), trees) for c in ("node", *words)]
                yield pa.RecordBatch.from_arrays([pa.array(leaf.ravel().view(np.int64)), *(pa.array(x) for x in again)], ["leaf", "node", *words])

    leaves = nodes.select("node", *words).mapInArrow(plant, f"leaf long, node long, {', '.join(f'{w} long' for w in words)}")
    candidates = components(_edges_in_leaves(leaves, "node", words, int(most), leaf_rows)).select("node", F.col("root").alias("leaf"))
    # Texts that candidates connect bring their sets, one text of each node.
    suspects = checkpointed(nodes.join(candidates, "node"))
    of = lambda c: F.col(f"{c}.{key}") if key else F.col(c)
    brought = suspects.withColumnRenamed("node", "own").withColumn("_at", of("first"))
    few = key is not None and suspects.limit(FEW_ROWS // 4 + 1).count() <= FEW_ROWS // 4
    brought = brought.select("_at", "own", "leaf", *words)
    same = of("doc_id") == F.col("_at") if key else F.col("doc_id").eqNullSafe(F.col("_at"))
    texts = rows.join(F.broadcast(brought) if few else brought, same).select("text", "own", "leaf", *words)

    def bring(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in text_blocks(batches, "text"):
            sets = [shingle_set(t, words_per_shingle).tobytes() for t in text_bytes(block.column("text"))]
            # Of rows that repeat an id, those of the node.
            right = [k for k, (x, n) in enumerate(zip(sets, block.column("own").to_pylist(), strict=True)) if xxhash.xxh3_64_intdigest(x) == n % (1 << 64)]
            rest = [block.column(c).take(pa.array(right, pa.int64())) for c in ("leaf", "own", *words)]
            yield pa.RecordBatch.from_arrays([*rest, pa.array([sets[k] for k in right], pa.binary())], ["leaf", "node", *words, "shingles"])

    members = texts.mapInArrow(bring, f"leaf long, node long, {', '.join(f'{w} long' for w in words)}, shingles binary")
    blocks = F.greatest(F.ceil(F.count(F.lit(1)) / leaf_rows), F.ceil(F.sum(F.col("size").cast("long") * 8) / SET_BYTES)).cast("int")
    sizes = checkpointed(suspects.groupBy("leaf").agg(blocks.alias("blocks")))
    verified = _edges_in_leaves(members, "node", words, int(most), leaf_rows, sizes=sizes, shingles="shingles", similarity=exact)
    roots = components(verified).withColumn("of", F.col("node")).select("of", "root")
    linked = nodes.join(roots, nodes["node"] == roots["of"], "left").select("node", "first", F.coalesce("root", "node").alias("root"))
    least = checkpointed(linked.groupBy("root").agg(F.min("first").alias("component_id")))
    found = linked.join(least, "root").select("node", "component_id")
    return prints.join(found, "node").select("doc_id", "component_id")


def drop_near_copies(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """``docs`` with one row of each component of ``similar_groups`` (that of the smallest id; of repeated ids or null ones
    alone, any one), all columns kept, whatever their names. An empty table stays empty."""
    rows, row = numbered(docs)
    ranked = rows.select(ranked_id(id_col, row).alias("doc_id"), F.col(text_col).alias("text"))
    keep = similar_groups(ranked, key="row", **how).where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select("doc_id.row")
    return chosen_rows(rows, row, keep).select(*docs.columns)
