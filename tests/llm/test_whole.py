"""The operators on what used to be left out: cut runs, repeated and null ids, large tables."""

import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from spotlake.llm import exact_dedup, langid, lines, mixing, simhash
from test_operators import brute_lines


# --- op8


def test_line_dedup_of_a_cut_run(spark, monkeypatch):
    """A word with more postings than a piece holds, whose last piece is short."""
    monkeypatch.setattr(lines, "LOOK_ROWS", 30)
    batch = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10")
    try:
        for seed in range(3):
            r = random.Random(seed)
            vocabulary = [f"v{k}" for k in range(11)]
            rows = [(i, "\n".join(" ".join(r.sample(vocabulary, r.choice((4, 5, 6)))) for _ in range(3))) for i in range(120)]
            df = spark.createDataFrame(rows, "doc_id long, text string")
            got = {x.doc_id: (x.n_lines, x.n_links, x.removed, x.class_id) for x in lines.similar_lines(df, group_rows=30).collect()}
            assert got == brute_lines(rows)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)


def test_line_dedup_of_a_frequent_word(spark):
    """Pairs whose first common prefix word stands in more lines than are looked at, with production parameters; a thousand more
    lines of that word have no partner."""
    r, pairs, last = random.Random(1), 9_000, 1000
    frequent = [f"c{k}" for k in range(40)]
    rows = []
    for k in range(pairs):
        common = ["hot", *r.sample(frequent, 8)]
        rows += [(2 * k, " ".join([f"u{k}", *common])), (2 * k + 1, " ".join([f"v{k}", *common]))]
    rows += [(2 * pairs + k, " ".join([f"w{k}", "hot", *(f"x{k}_{i}" for i in range(8))])) for k in range(last)]
    fillers = [(10**6 + k, " ".join(r.sample(frequent, 20))) for k in range(45_000)]
    got = {x.doc_id: x for x in lines.similar_lines(spark.createDataFrame(rows + fillers, "doc_id long, text string")).collect()}
    assert all(got[2 * k].n_links >= 1 and got[2 * k + 1].removed == [0] and got[2 * k + 1].class_id <= 2 * k for k in range(pairs))
    assert sum(got[k].n_links for k in range(2 * pairs, 2 * pairs + last)) == 0


# --- rows with null and repeated ids

ENGLISH = "the house of the man and the dog is with them and the child of the woman is in the garden"
OTHER = "das haus und der hund ist mit dem mann und nicht mit der frau in dem garten und das kind auch"


def stored(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", k) for k, (i, t) in enumerate(rows)], "doc_id long, text string, lang string, source string, row int")


def test_identified_rows_go_by_their_own_text(spark):
    rows = [(None, ENGLISH), (1, ENGLISH), (1, "12 34 56"), (None, ""), (2, None), (2, ENGLISH)]
    assert {r.row for r in langid.keep_identified(stored(spark, rows)).collect()} == {0, 1, 5}


def test_one_row_of_each_group_stays(spark):
    rows = [(None, ENGLISH), (None, ENGLISH), (1, OTHER), (1, OTHER), (1, "x y z"), (0, "x  y z"), (3, "q"), (None, "q")]
    df = stored(spark, rows)
    for drop in (exact_dedup.drop_copies, simhash.drop_near_copies):
        got = drop(df)
        assert got.columns == df.columns
        kept = {r.row for r in got.collect()}
        assert len(kept) == 4 and len(kept & {0, 1}) == 1 and len(kept & {2, 3}) == 1 and kept & {4, 5, 6, 7} == {5, 6}, drop


def test_sampled_rows_go_by_their_own_cell(spark):
    """One id on rows of two sources, of which the large one is thinned; and no id on others."""
    rows = [(k, " ".join([f"w{k}"] * 200), "en", "large", k) for k in range(60)] + [(k, f"u{k}", "en", "small", 100 + k) for k in range(60)]
    rows += [(None, "a b", "en", "small", 300), (None, "c d", "en", "small", 301)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, row int")
    sampled = {r.row for r in mixing.mix(df, topics=1, keep=0.5, carry=("row",)).where("sampled").collect()}
    got = [r.row for r in mixing.sample_mix(df, topics=1, keep=0.5).collect()]
    assert sorted(got) == sorted(sampled)
    assert {300, 301} <= sampled and 0 < len([k for k in sampled if k < 100]) < 60


# --- near copies by similarity


def shingles(text):
    w = text.split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}


def test_similar_groups(spark):
    """Edited copies of five-word Jaccard 0.8 and more come together, unrelated texts don't, in small leaves too."""
    r = random.Random(12)
    vocabulary = [f"w{k}" for k in range(3000)]
    texts, base = [], []
    for b in range(120):
        w = [r.choice(vocabulary) for _ in range(r.randrange(60, 400))]
        texts.append(" ".join(w))
        base.append(b)
        for _ in range(r.randrange(3)):
            edited = list(w)
            for _ in range(r.randrange(1, 1 + max(1, len(w) // 50))):
                edited[r.randrange(len(w))] = r.choice(vocabulary)
            texts.append(" ".join(edited))
            base.append(b)
    texts += ["", None, "x", "x y", "y x", "x y z"]
    base += [-1, -1, -2, -3, -4, -5]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumns({"node": F.lit(1), "w0": F.lit("clash")})
    pairs = [(i, j) for i in range(len(texts) - 6) for j in range(i) if base[i] == base[j] and (lambda a, b: len(a & b) / len(a | b))(shingles(texts[i]), shingles(texts[j])) >= 0.8]
    assert len(pairs) > 50
    # Trees as at ten thousand, a million and fifteen million texts.
    for how in ({}, {"leaf_rows": 4}, *({"bits_and_trees": simhash.trees_for(n, simhash.far_bits(0.8)[0])} for n in (10_000, 1_000_000, 15_000_000))):
        got = {x.doc_id: x.component_id for x in simhash.similar_groups(df, **how).collect()}
        assert len(got) == len(texts)
        assert np.mean([got[i] == got[j] for i, j in pairs]) >= 0.95
        assert all(base[i] == base[c] and c <= i for i, c in got.items())
    assert simhash.similar_groups(df.limit(0)).count() == 0


def test_similar_groups_of_a_large_group(spark):
    """Hundreds of near copies of one text, beside others: one component, though leaves are split."""
    r = random.Random(13)
    w = [f"v{k}" for k in range(300)]
    near = []
    for k in range(600):
        edited = list(w)
        edited[r.randrange(300)] = f"n{k}"
        near.append(" ".join(edited))
    other = [" ".join(f"o{k}_{i}" for i in range(100)) for k in range(100)]
    df = spark.createDataFrame(list(enumerate(near + other)), "doc_id long, text string")
    got = {x.doc_id: x.component_id for x in simhash.similar_groups(df, leaf_rows=100).collect()}
    assert got == {**{k: 0 for k in range(600)}, **{600 + k: 600 + k for k in range(100)}}
    assert {x.doc_id for x in simhash.drop_near_copies(df).collect()} == {0, *range(600, 700)}


def test_no_text_goes_without_a_partner(spark):
    """Pairs of all similarities: what is linked is a union of links of 0.8 and more, at any setting of the trees."""
    r = random.Random(14)
    texts = []
    for b in range(150):
        w = [f"t{b}_{k}" for k in range(120)]
        texts.append(" ".join(w))
        for share in (0.008, 0.009, 0.016, 0.017, 0.025, 0.04):
            at = r.sample(range(120), max(1, round(120 * share)))
            texts.append(" ".join(f"e{b}_{share}_{k}" if k in at else x for k, x in enumerate(w)))
    texts += [" ".join(["na"] * 500 + [f"end{k}_{i}" for i in range(9)]) for k in range(20)]  # long runs of one word
    sets = [shingles(t) for t in texts]
    close = [(i, j) for i in range(len(texts)) for j in range(max(0, i - 30), i) if 10 * len(sets[i] & sets[j]) >= 8 * len(sets[i] | sets[j])]
    root = list(range(len(texts)))
    for i, j in close:
        a, b = sorted((root[i], root[j]))
        root = [a if x == b else x for x in root]
    assert 2 < len(close) / 150 < 12
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for how in ({}, {"bits_and_trees": (11, 22)}, {"bits_and_trees": (15, 44)}):
        got = {x.doc_id: x.component_id for x in simhash.similar_groups(df, **how).collect()}
        assert all(root[i] == root[c] for i, c in got.items())
        assert np.mean([got[i] == got[j] for i, j in close]) >= 0.95
        gone = set(got) - {x.doc_id for x in simhash.drop_near_copies(df, **how).collect()}
        assert gone == {i for i, c in got.items() if c != i} and gone <= {i for pair in close for i in pair}


# --- op10


def test_topics_are_fitted_on_all_documents(spark):
    """k-means over far more documents than the 4,000 that it was once fitted on, by numpy on one machine."""
    r = random.Random(3)
    texts = [" ".join(r.choice("abcdefghijklmnopqrst") * r.randrange(1, 4) for _ in range(r.randrange(8))) for _ in range(12_000)]
    df = spark.createDataFrame([(None, t) for t in texts], "doc_id long, text string").select("*", F.monotonically_increasing_id().alias("row"), F.xxhash64("text").alias("order"))
    at_rows = [(x.row, x.text, x.order) for x in df.collect()]
    made = np.rint(mixing._vectors(pa.array([t for _, t, _ in at_rows]))[1].astype(float) * mixing.VECTOR_ONE)
    seeds = {o: v for (_, t, o), v in zip(at_rows, made, strict=True) if t}
    at = mixing._centroids(np.array([seeds[o] for o in sorted(seeds)[:8]]))
    for _ in range(mixing.TOPIC_SWEEPS):
        own = np.argmax(made @ at.T, axis=1)
        at = np.array([mixing._centroids(made[own == k].sum(axis=0)[None, :])[0] if made[own == k].any() else at[k] for k in range(8)])
    want = dict(zip([k for k, _, _ in at_rows], np.argmax(made @ at.T, axis=1).tolist(), strict=True))
    for parts in (2, 7):
        got = mixing.topic_features(df.repartition(parts), id_col="row", text_col="text", keep=())
        assert {x.doc_id: x.topic for x in got.collect()} == want
    assert len(set(want.values())) == 8
