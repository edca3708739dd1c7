"""Web archives, spelling groups and centroid clustering against brute force, round trips and damaged files."""

import base64
import gzip
import hashlib
import random
import re
import zlib
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from spotlake.llm import clusters, spelling, warc
from spotlake.llm.queries import QUERIES

# --- archives

PAGES = [
    (5, "http://a.example/x?y=1", "<p>same</p>"),
    (3, None, "<p>same</p>"),
    (3, "http://a.example/ü b\r\nX: y", "<p>same</p>"),
    (None, "", "<p>same</p>"),
    (7, "http://b.example", None),
    (8, "http://b.example", ""),
    (9, "u", "é" * 400_000),
    (10, "u", "\r\n\r\nWARC/1.1\r\n\r\n"),
    (11, "u", "x" * 3),
    (11, "u", "y" * 3),
]


def pages(spark, rows=PAGES):
    return spark.createDataFrame([(*r, "clash", 1, "z") for r in rows], "page_id long, url string, html string, path string, _row int, refers_id string").repartition(3)


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


@pytest.mark.parametrize("least", [0, 1, 12])
def test_archives_round_trip(spark, tmp_path, least):
    manifest = warc.write_archives(pages(spark), str(tmp_path / "w"), least=least, file_bytes=2000)
    assert manifest.agg(F.sum("records")).first()[0] == len(PAGES)
    got = warc.read_archives(manifest).withColumn("id", warc.page_in("record_id")).withColumn("to", warc.page_in("refers_to")).collect()
    assert len(got) == len(PAGES) and not any(r.fault for r in got)
    assert Counter((r.id, r.payload_digest, r.payload_bytes) for r in got) == Counter((None if i is None else str(i), digest(h), len((h or "").encode())) for i, _, h in PAGES)
    for text in {h or "" for _, _, h in PAGES}:
        group = [r for r in got if r.payload_digest == digest(text)]
        first = [r for r in group if r.record_type == "response"]
        if len(text.encode()) < least:
            assert len(first) == len(group)
            continue
        assert len(first) == 1 and bytes(first[0].payload) == text.encode()
        assert first[0].id == min((str(i) for i, _, h in PAGES if (h or "") == text and i is not None), key=int)
        assert all(r.to == first[0].id and r.refers_to == first[0].record_id and r.payload is None for r in group if r is not first[0])
    # Each member is one record, and any gzip reader reads the file.
    for f in manifest.collect():
        data = Path(f.path).read_bytes()
        assert len(data) == f.bytes
        members = 0
        while data:
            d = zlib.decompressobj(31)
            assert d.decompress(data).startswith(b"WARC/1.1\r\n") and d.eof
            data, members = d.unused_data, members + 1
        assert members == f.records and gzip.decompress(Path(f.path).read_bytes()).count(b"\r\n\r\n") >= members


def test_archives_empty_and_missing(spark, tmp_path):
    assert warc.write_archives(pages(spark, []), str(tmp_path / "w")).count() == 0
    paths = spark.createDataFrame([(None,), (str(tmp_path / "none.warc.gz"),)], "path string")
    got = warc.read_archives(paths).collect()
    assert len(got) == 1 and "can't be opened" in got[0].fault and got[0].record_id is None


def test_archives_damaged(spark, tmp_path):
    members = [warc.record("response", warc.record_id(k, k), None, "u", bytes(random.Random(k).randbytes(5000))) for k in range(6)]
    starts = [sum(map(len, members[:k])) for k in range(6)]
    broken = bytearray(b"".join(members))
    broken[starts[1] + 3000] ^= 255  # inside a member
    broken[starts[3] + 1] ^= 255  # its magic number
    (tmp_path / "a.warc.gz").write_bytes(broken[: starts[5] + 2000])  # and the end is missing
    wrong = gzip.decompress(members[0]).replace(b"sha1:", b"sha1:A", 1)
    short = gzip.decompress(members[1]).replace(b"Content-Length: 5", b"Content-Length: 6", 2)
    for name, data in (("b", gzip.compress(wrong) + members[2]), ("c", gzip.compress(short) + members[2]), ("d", b"junk" * 100_000 + members[2]), ("e", gzip.compress(b"text") + members[2]), ("f", b"\x1f")):
        (tmp_path / f"{name}.warc.gz").write_bytes(data)
    rows = warc.read_archives(spark.createDataFrame([(str(p),) for p in tmp_path.glob("*.gz")], "path string")).collect()
    by = {n: sorted(((r.offset, r.fault, r.record_id) for r in rows if Path(r.path).name[0] == n), key=lambda x: x[0]) for n in "abcdef"}
    assert [r[0] for r in by["a"] if r[1] is None] == [starts[0], starts[2], starts[4]]
    assert [r[0] for r in by["a"] if r[1]] == [starts[1], starts[3], starts[5]]
    assert "payload's digest" in by["b"][0][1] and "less than" in by["c"][0][1] and "no record" in by["e"][0][1]
    for n in "bcde":
        assert len(by[n]) == 2 and by[n][1][1:] == (None, "urn:page:2:2")
    assert len(by["f"]) == 1 and by["f"][0][1]


def test_few_or_many_groups_alike(spark, tmp_path, monkeypatch):
    def shape():
        got = warc.read_archives(warc.write_archives(pages(spark)), payloads=False)
        return sorted((r.record_type, str(r[0]), str(r[1]), r.payload_digest) for r in got.select(warc.page_in("record_id"), warc.page_in("refers_to"), "record_type", "payload_digest").collect())

    few = shape()
    monkeypatch.setattr(warc, "FEW_GROUPS", 0)
    assert shape() == few


# --- spelling


def slipped(key, run):
    run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
    h = zlib.crc32(f"{key}:{run}".encode())
    return run if h % 31 else run[: h % len(run)] + run[h % len(run) + 1 :]


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def groups(n):
    """Of word counts, what an operator should return, by comparing all pairs."""
    near = {w: [v for v in n if one_edit(w, v)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 10 * n[w] else None
    out = {}
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, n[w], len(near[w]), n[form[w]] if form[w] is not None else None)
    return out


def rows_of(df):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


def test_spelling_of_documents(spark):
    sf = "/root/testdata/sf0.001"
    count = Counter(slipped(r.doc_id, x) for r in spark.read.parquet(f"{sf}/documents.parquet").collect() for x in re.findall("[A-Za-zÀ-ÿ]+", r.text or ""))
    want = groups({w: c for w, c in count.items() if len(w) >= 7 and c >= 2})
    assert any(v[0] for v in want.values())
    assert rows_of(QUERIES["op12_spelling"](spark, sf)) == want


@pytest.mark.parametrize("full", [1, 8, 1024])
def test_spelling_of_crowded_words(spark, full):
    """Few letters, so that keys are crowded and cut again and again; runs of one letter, where an edit has several places."""
    draw = random.Random(full)
    n = {}
    for _ in range(900):
        w = "".join(draw.choice("abÿ") for _ in range(draw.choice((7, 7, 8, 8, 9, 12))))
        n[w] = draw.choice((2, 3, 20, 30, 300, 4000))
    n |= {"a" * k: k for k in range(7, 14)} | {"é" * 5000: 2, "é" * 4999 + "e": 20, "é" * 5001: 200}
    texts = [(k, " ".join([w] * c)) for k, (w, c) in enumerate(n.items())]
    docs = spark.createDataFrame([(k, t, w, 1) for (k, t), w in zip(texts, n, strict=True)], "doc_id long, text string, word string, n int")
    want = groups(n)
    assert max(v[3] for v in want.values()) > 5 and len({v[1] for v in want.values()}) < len(n)
    assert rows_of(spelling.spelling_groups(docs, full=full)) == want


def test_spelling_edges(spark):
    rows = [(None, None), (None, ""), (1, "ABCDEFÉ×÷ abcdefÉ×÷"), (1, "ABCDEFÉ×÷"), (2, "abcdefg1abcdefg_abcdef"), (None, "nullids nullids")]
    got = rows_of(spelling.spelling_groups(spark.createDataFrame(rows, "doc_id long, text string")))
    assert got == {"abcdefÉ×÷": (None, "abcdefÉ×÷", 3, 0, None), "abcdefg": (None, "abcdefg", 2, 0, None), "nullids": (None, "nullids", 2, 0, None)}
    assert spelling.spelling_groups(spark.createDataFrame([], "doc_id long, text string")).count() == 0


# --- clusters


def brute(rows, k=8, rounds=10):
    kept = [(i, [(x * 1024).__floor__() for x in v]) for i, v in rows if v is not None and len(v) == 64 and all(x is not None and abs(x) < float("inf") for x in v)]
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"3:{r[0]}".encode()).hexdigest() if r[0] is not None else "z", r[1]))
    centres = [v for _, v in order[:k]]

    def far(a, b):
        return sum((x - y) ** 2 for x, y in zip(a, b, strict=True))

    def assign():
        return [min(range(len(centres)), key=lambda c: (far(v, centres[c]), c)) for _, v in kept]

    for _ in range(rounds):
        best = assign()
        for c in range(len(centres)):
            own = [v for (_, v), b in zip(kept, best, strict=True) if b == c]
            if own:
                centres[c] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    best = assign()
    away = [far(v, centres[b]) for (_, v), b in zip(kept, best, strict=True)]
    total = {c: sum(d for d, b in zip(away, best, strict=True) if b == c) for c in set(best)}
    long = lambda d: d if d < 1 << 63 else None
    return [(i, b, long(d), long(total[b]), long(sum(away)), hashlib.sha256(",".join(map(str, centres[b])).encode()).hexdigest()) for (i, _), b, d in zip(kept, best, away, strict=True)]


def vectors(spark, rows, kind="float"):
    return spark.createDataFrame([(i, v, 3, "x", 1) for i, v in rows], f"vec_id long, embedding array<{kind}>, cluster int, vector string, n int").repartition(3)


def same(spark, rows, kind="float", **how):
    got = clusters.cluster_vectors(vectors(spark, rows, kind), **how)
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(brute(rows, **{{"clusters": "k", "rounds": "rounds"}[k]: v for k, v in how.items()}), key=key)


def test_clusters(spark):
    draw = random.Random(5)
    grid = lambda: [draw.choice((-1.5, -0.25, 0.0, 0.5, 1.0)) for _ in range(64)]
    odd = [(None, grid()), (900, None), (901, []), (902, [0.5] * 63), (903, [0.5] * 65), (904, [None] + [0.5] * 63), (905, [float("nan")] + [0.5] * 63), (906, [float("-inf")] + [0.5] * 63)]
    twins = [0.125] * 64
    same(spark, [*((k, grid()) for k in range(150)), *odd, (3, twins), (3, twins), *((k, twins) for k in range(200, 240))])
    # Values of two kinds only: many ties.
    same(spark, [(k, [draw.choice((-0.001, 0.001))] * 64) for k in range(60)], rounds=3)
    same(spark, [(k, grid()) for k in range(5)])
    same(spark, [])
    same(spark, odd[1:])


def test_clusters_of_huge_values(spark):
    draw = random.Random(6)
    rows = [(k, [draw.choice((1.0, -1.0)) * 2.0 ** draw.choice((0, 3, 14, 16, 29, 60, 126)) for _ in range(64)]) for k in range(40)]
    same(spark, rows, rounds=4)
    same(spark, [(k, [draw.uniform(-1e5, 1e5) for _ in range(64)]) for k in range(40)], "double", clusters=3)


def test_bisectors_agree_with_distances():
    import numpy as np

    draw = np.random.default_rng(7)
    centres = draw.integers(-3, 4, (8, 5)).tolist()
    x = draw.integers(-4, 5, (500, 5))
    far = ((x[:, None] - np.array(centres)[None]) ** 2).sum(axis=2)
    assert (clusters.nearest(x, *clusters.bisectors(centres, True)) == far.argmin(axis=1)).all()
