"""The pipeline's stages against brute-force versions of their decisions."""

import re

import corpus_pipeline
import public_tokenizers
import tiktoken
from spotlake.llm import bpe

SF = "/root/testdata/sf0.001"


def five_words(text):
    w = [x.lower() for x in re.split("[\\x20\\x09-\\x0D]+", text or "") if x]
    return frozenset(" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute_groups(texts):
    """Of each text the first one that links of Jaccard similarity 0.8 or more reach, by all pairs, and whether it has a link."""
    sets, root, near = [five_words(t) for t in texts], list(range(len(texts))), [False] * len(texts)
    for i, x in enumerate(sets):
        for j in range(i):
            y = sets[j]
            if 0.8 * max(len(x), len(y)) <= min(len(x), len(y)) and 10 * len(x & y) >= 8 * len(x | y):
                near[i] = near[j] = True
                a, b = sorted((root[i], root[j]))
                root = [a if r == b else r for r in root]
    return root, near


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    kept = []
    for _, stage in corpus_pipeline.STAGES[:4]:
        docs = stage(spark, docs, SF).cache()
        assert docs.columns == columns
        kept.append({r.doc_id: r.text for r in docs.collect()})
    every = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert len(kept[0]) > 0.99 * len(every)
    first = {}
    for i in sorted(kept[0]):
        first.setdefault(" ".join(kept[0][i].split()), i)
    assert set(kept[1]) == set(first.values())
    ids = sorted(kept[1])
    least, near = brute_groups([kept[1][i] for i in ids])
    wanted = {ids[c] for c in least}
    # The smallest of each group stays, what the trees miss may stay too, and nothing goes that has no partner.
    assert wanted <= set(kept[2]) and len(ids) - len(kept[2]) >= 0.95 * (len(ids) - len(wanted))
    assert all(has for i, has in zip(ids, near, strict=True) if i not in kept[2])
    assert set(kept[3]) <= set(kept[2])


def test_run(spark):
    got = corpus_pipeline.run(spark, SF).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    tokens = bpe.read_ranks(open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")).read().splitlines())
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks={t: i for i, t in enumerate(tokens)}, special_tokens={})
    assert got and all(r.ids == library.encode_ordinary(texts[r.doc_id]) for r in got)
    again = {r.doc_id for r in corpus_pipeline.run(spark, SF).collect()}
    assert again == {r.doc_id for r in got}
