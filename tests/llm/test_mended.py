"""Long and odd inputs that earlier forms of the operators were slow on, crashed on or got wrong."""

import base64
import time
from pathlib import Path

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from spotlake.llm import bpe, html, langid, lines, media, mixing, pii

GOOD = "<p>The text of the page is in the block and it is of the kind that is long enough for all the readers.</p>"
TEXT = html.main_text(GOOD)


@pytest.mark.parametrize(
    "page, want",
    [
        (f"<div class='content'>{GOOD * 3}</div><article><h2>Teaser</h2><p>Short.</p></article>", [TEXT] * 3),
        (f"<div>{GOOD * 2}</div>" + "<article><h2>Teaser</h2><p>Short.</p></article>" * 5, [TEXT] * 2),
        (f"<article>{GOOD}</article><article>{GOOD}</article><div>{GOOD}</div>", [TEXT] * 2),  # posts of a thread
        (f"<main><p>Short.</p></main><div>{GOOD * 3}</div>", ["Short."]),
        (f"<div>{GOOD}<p>Short.</p></div>", [TEXT, "Short."]),
        (f"<article>{GOOD}<p>Short.</p></article><p>{TEXT[:40]}</p>", [TEXT, "Short."]),
    ],
)
def test_teasers_threads_and_pages_without_article(page, want):
    assert html.main_text(page) == "\n".join(want)


def seconds(work, *args):
    began = time.thread_time()
    work(*args)
    return time.thread_time() - began


@pytest.mark.parametrize("form", ["<b>|</i>", "<div>|x</p>", "<i><div>|<b>|</i>", "<div><b>|<p></p>", "<div class=ad>|<main>", "<h1>|", "<li><b>|", "<head>|<body>", "<article class=notice>x|", "<dl><dt>|<dd>"])
def test_long_pages_take_linear_time(form):
    page = lambda n: "".join(part * n for part in form.split("|"))
    assert seconds(html.main_text, page(40_000)) < 20 * max(0.05, seconds(html.main_text, page(4_000)))


@pytest.mark.parametrize("cue", ["token=", "api_key: ", "-://", "password='", "token=....", "user=a", "secret", "a://"])
def test_repeated_cues_take_linear_time(cue):
    assert seconds(pii.find_spans, cue * 40_000) < 20 * max(0.05, seconds(pii.find_spans, cue * 4_000))


def test_words_of_every_code_point_split_as_the_library_does():
    lines = Path(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")).read_bytes().splitlines()
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    split = bpe.splitter(public_tokenizers.PATTERN)
    for start in range(0, 0x110000, 256):
        chars = [chr(c) for c in range(start, start + 256) if not 0xD800 <= c < 0xE000]
        if start >= 0x34000 and start % 0x4000:
            continue  # far planes: one block of many
        for suffix in ("'ll", "a", "1", " ", "\n "):
            text = "\n".join(c + suffix for c in chars)
            assert library.encode_ordinary(text) == [t for piece in split(text) for w in piece for t in library.encode_ordinary(w)], (hex(start), suffix)


def test_null_and_empty_are_apart(spark):
    rows = [(k, "one two three four five six", s, lang) for k, (s, lang) in enumerate([(None, "en"), ("", "en"), ("", "en"), ("a", None), ("a", "zz"), ("a", "zz"), ("a", "en")])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    mixed = {r.doc_id: r for r in mixing.mix(docs).collect()}
    assert [mixed[k].source for k in range(4)] == [None, "", "", "a"] and mixed[3].lang is None
    # One document against two: flattened shares give the single ones more weight a token.
    assert mixed[0].weight > mixed[1].weight == mixed[2].weight and mixed[3].weight > mixed[4].weight == mixed[5].weight
    de, en = "der die das und ist nicht ein eine mit von auf", "the and that with for this from they are was were"
    rows = [(k, de if k < 40 else en, "de" if k < 40 else "en", None if k < 40 else "") for k in range(80)] + [(100, "der the und and ein for", None, None), (101, "der the und and ein for", None, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    found = {r.doc_id: r for r in langid.identify(docs).where(F.col("doc_id") >= 100).collect()}
    assert found[100].language != found[101].language or found[100].posterior != found[101].posterior


@pytest.mark.parametrize("n", [20_000, 80_000])
def test_one_long_line_with_a_near_copy(spark, n):
    words = [f"w{k}" for k in range(n)]
    rows = [(1, " ".join(words)), (2, " ".join(["x", "y", *words[2:]])), (3, " ".join(f"v{k}" for k in range(n)))]
    got = {r.doc_id: (r.n_links, r.removed, r.class_id) for r in lines.similar_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: (1, [], 1), 2: (1, [0], 1), 3: (0, [], 3)}


def test_ids_of_lines(spark):
    line, near = "a b c d e f g h i j", "a b c d e f g h i k"
    make = lambda kind, rows: spark.createDataFrame([(*r, [9], "x", 1) for r in rows], f"doc_id {kind}, text string, _removed_lines array<int>, _row string, _row_place int")
    # A null id stays null, comes last, and its later line goes.
    docs = make("long", [(None, f"only one\n{line}"), (7, near), (None, None)])
    got = {r.doc_id: (r.n_lines, r.n_links, r.removed, r.class_id) for r in lines.similar_lines(docs).collect()}
    assert got == {7: (1, 1, [], 7), None: (2, 1, [1], 7)}
    out = lines.drop_similar_lines(docs)
    assert out.columns == docs.columns and sorted(map(str, out.collect())) == sorted(map(str, make("long", [(None, "only one"), (7, near), (None, None)]).collect()))
    # Texts as ids go by their order.
    docs = make("string", [("b", line), ("a", near), ("c", "other text"), (None, line)])
    got = {r.doc_id: (r.n_links, r.removed, r.class_id) for r in lines.similar_lines(docs).collect()}
    assert got == {"a": (1, [], "a"), "b": (1, [0], "a"), "c": (0, [], "c"), None: (1, [0], "a")}
    assert sorted(r.text for r in lines.drop_similar_lines(docs).collect()) == ["", "", near, "other text"]
    # Rows that repeat an id are documents of their own where lines are dropped.
    assert sorted(r.text for r in lines.drop_similar_lines(make("int", [(1, line), (1, line), (1, near)])).collect())[:2] == ["", ""]
    assert lines.drop_similar_lines(docs.limit(0)).count() == 0


def plain_dc(data):
    """Width, height and the mean of each 8x8 block of a grey baseline JPEG, bit by bit as the standard has it."""
    at, tables, quant, interval = 2, {}, {}, 0
    assert data[:2] == b"\xff\xd8"
    while True:
        marker, size = data[at + 1], int.from_bytes(data[at + 2 : at + 4], "big")
        body = data[at + 4 : at + 2 + size]
        at += 2 + size
        if marker == 0xDB:
            quant[body[0] & 15] = body[1]
        elif marker == 0xC0:
            height, width, table = int.from_bytes(body[1:3], "big"), int.from_bytes(body[3:5], "big"), body[8]
        elif marker == 0xDD:
            interval = int.from_bytes(body, "big")
        elif marker == 0xC4:
            while body:
                counts, code, k = body[1:17], 0, 17
                codes = tables[body[0]] = {}
                for length, n in enumerate(counts, 1):
                    for _ in range(n):
                        codes[length, code] = body[k]
                        code, k = code + 1, k + 1
                    code <<= 1
                body = body[k:]
        elif marker == 0xDA:
            dc, ac = tables[body[2] >> 4], tables[16 | body[2] & 15]
            break
    bits = ""
    state = {"at": at}

    def fill():
        nonlocal bits
        b = data[state["at"]]
        state["at"] += 2 if b == 255 else 1
        bits += f"{b:08b}"

    def take(n):
        nonlocal bits
        while len(bits) < n:
            fill()
        out, bits = bits[:n], bits[n:]
        return int(out, 2) if n else 0

    def symbol(codes):
        code = length = 0
        while (length, code) not in codes:
            code, length = code << 1 | take(1), length + 1
        return codes[length, code]

    out, last = [], 0
    for k in range(-(-width // 8) * -(-height // 8)):
        if interval and k and k % interval == 0:
            bits, last = "", 0
            assert data[state["at"]] == 255 and data[state["at"] + 1] == 0xD0 + (k // interval - 1) % 8
            state["at"] += 2
        n = symbol(dc)
        v = take(n)
        last += v - (1 << n) + 1 if n and v < 1 << n - 1 else v
        k = 1
        while k < 64:
            x = symbol(ac)
            if not x:
                break
            k += 1 + (x >> 4)
            take(x & 15)
        out.append(last * quant[table] / 8 + 128)
    return width, height, out


@pytest.mark.parametrize("text", ["", "plain text", "\xff\x00é\n" * 300, "x" * 5000, "".join(chr(k) for k in range(1, 3000) if not 0xD800 <= k < 0xE000)])
def test_stored_images_by_a_plain_decoder(text):
    payload = text.encode().ljust(max(1, -(-len(text.encode()) // 192)) * 192)
    (data,) = media.jpeg_encode([payload])
    (image,) = media.jpeg_thumbnails([data])[0]
    width, height, means = plain_dc(data)
    assert (image[0], image[1]) == (width, height) and [float(x) for x in image[3].ravel().tolist()] == means
    assert bytes(int(x) for x in means)[: len(payload)] == payload
