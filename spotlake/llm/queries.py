"""The registered queries of this subpackage: thin forms of its operators with fixed results."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import bpe_encode
from .clusters import CLUSTERS, DIMENSIONS, ROUNDS, SALT, SCALE, cluster_vectors
from .common import table, written
from .exact_dedup import msd_groups
from .html import declared_language, extract_pages
from .langid import identify, page_host
from .lines import similar_lines
from .media import jpeg_features, jpeg_store
from .mixing import mix
from .pii import BASE_KINDS, pii_spans, span_text
from .simhash import near_groups
from .spelling import SLIPS, spelling_groups
from .urls import filter_urls
from .warc import page_in, read_archives, write_archives

#: The vocabulary that the queries encode with.
RANKS = "byte_bpe_multi_50k.tiktoken"


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii_spans(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE_KINDS))
    counts = [F.expr(f"cast(size(filter(spans, s -> s.kind = '{k}')) as long)").alias(f"n_{k}") for k in BASE_KINDS]
    private = F.expr("cast(size(filter(spans, s -> s.kind <> 'url')) as long)").alias("n_private")
    return found.select("doc_id", *counts, private, F.sha2(span_text(base), 256).alias("base_sha256"), span_text(F.col("spans")).alias("spans"))


def digests(encoded: DataFrame, *keep: str) -> DataFrame:
    """doc_id, the columns ``keep``, n_tokens, ids_sha256 and decoded_sha256 of encoded documents with their ids decoded."""
    return encoded.select(
        "doc_id",
        *keep,
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op3_byte_level_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(RANKS)
    return digests(bpe_encode(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN, decode=True))


def op4_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = jpeg_store(table(spark, sf_dir, "documents"))
    # The stored form's own figures are taken before it is read back.
    stored = stored.withColumns({"media_bytes": F.length("media").cast("long"), "media_sha256": F.sha2("media", 256)})
    return jpeg_features(stored).select(
        "doc_id",
        "n_bytes",
        F.length("payload").cast("long").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_sha256"),
        F.crc32(F.expr("substring(payload, -16, 16)")).alias("tail_crc32"),
        "media_bytes",
        "media_sha256",
        F.concat_ws(":", F.concat_ws("x", F.col("width").cast("string"), F.col("height").cast("string")), "thumb_hash").alias("feature"),
    )


def op5_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(table(spark, sf_dir, "documents"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_lines(table(spark, sf_dir, "documents"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of pages, which have all four kinds of evidence: their main text, the lang attribute, the address and the host."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html", declared_language(F.col("html")).alias("declared"), page_host(F.col("url")).alias("host"))
    texts = written(extract_pages(pages, keep=("declared", "host")))
    found = identify(texts, id_col="page_id", declared_col="declared", host_col="host", url_col="url")
    return found.withColumnRenamed("doc_id", "page_id")


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return msd_groups(table(spark, sf_dir, "documents"))


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written, and read back: a record that fails its checks fails the query."""
    pages = table(spark, sf_dir, "pages")
    kind = pages.schema["page_id"].dataType
    found = read_archives(write_archives(pages), payloads=False)
    sound = F.when(F.col("fault").isNull(), F.col("record_type")).otherwise(F.raise_error(F.concat_ws(": ", "path", "fault")).cast("string"))
    return found.select(page_in("record_id").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", sound.alias("record_type"), page_in("refers_to").cast(kind).alias("refers_to"))


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_groups(table(spark, sf_dir, "documents"), slips=SLIPS)


def op13_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster_vectors(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_html_extraction,
        op2_pii,
        op3_byte_level_bpe,
        op4_media_columns,
        op5_url_filters,
        op6_simhash,
        op7_exact_dedup,
        op8_line_dedup,
        op9_language_id,
        op10_mixing,
        op11_warc,
        op12_spelling,
        op13_clusters,
    )
}

#: DuckDB's RE2 and Java agree on these classes.
_NORMAL = r"regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')"


def _clusters_sql() -> str:
    """A common table for each round: the nearest centroid by squared distance, then the floor of the exact means."""
    d = DIMENSIONS
    away = f"list_sum(list_transform(range(1, {d + 1}), lambda i: (v.x[i] - c.x[i]) * (v.x[i] - c.x[i])))"
    finite = "len(list_filter(embedding, lambda e: e is not null and isfinite(e)))"
    parts = [
        f"v as materialized (select vec_id, list_transform(embedding, lambda e: cast(floor({SCALE} * cast(e as double)) as hugeint)) as x from embeddings where len(embedding) = {d} and {finite} = {d})",
        f"c0 as materialized (select row_number() over (order by h) - 1 as k, x from (select sha256('{SALT}' || vec_id) as h, x from v order by h limit {CLUSTERS}))",
    ]
    for r in range(ROUNDS + 1):
        nearest = "row_number() over (partition by vec_id order by d, k) = 1"
        parts.append(f"a{r} as materialized (select vec_id, k, d, x from (select v.vec_id, c.k, v.x, {away} as d from v, c{r} c) qualify {nearest})")
        if r < ROUNDS:
            mean = "(sum(e) - ((sum(e) % count(*)) + count(*)) % count(*)) // count(*)"
            flat = f"select k, unnest(range(1, {d + 1})) as i, unnest(x) as e from a{r}"
            means = f"select k, list(m order by i) as x from (select k, i, {mean} as m from ({flat}) group by k, i) group by k"
            parts.append(f"c{r + 1} as materialized (select c.k, coalesce(m.x, c.x) as x from c{r} c left join ({means}) m using (k))")
    last = f"a{ROUNDS}"
    return f"""with {", ".join(parts)}
        select vec_id, cast(k as integer) as cluster, cast(d as bigint) as distance, cast(sum(d) over (partition by k) as bigint) as cluster_inertia,
               cast(sum(d) over () as bigint) as inertia, (select sha256(array_to_string(x, ',')) from c{ROUNDS} c where c.k = {last}.k) as centroid_sha256 from {last}"""


#: A run with a slip: CRC-32 by a table of 256 entries over the UTF-8 bytes of the id, a colon and the run.
_CRC_STEPS = "list_reduce(range(8), lambda c, i: case when c & 1 = 1 then xor(c >> 1, 3988292384::ubigint) else c >> 1 end, n::ubigint)"

ORACLE_SQL: dict[str, str] = {
    "op7_exact_dedup": f"""
        with t as (select doc_id, {_NORMAL} as norm from documents)
        select doc_id, min(doc_id) over w as keep_id, count(*) over w as group_size,
               doc_id = min(doc_id) over w as kept, sha256(norm) as text_sha256
        from t window w as (partition by norm)""",
    "op11_warc": """
        with p as (select page_id, coalesce(html, '') as html from pages), f as (select *, min(page_id) over (partition by html) as first, sha1(html) as h from p)
        select page_id, cast(strlen(html) as bigint) as payload_bytes,
               array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                   1 + cast((cast('0x' || substr(h, cast(1 + 10 * (i // 8) as bigint), 10) as ubigint) >> cast(35 - 5 * (i % 8) as ubigint)) & 31 as bigint), 1)), '') as payload_digest,
               case when page_id = first then 'response' else 'revisit' end as record_type,
               case when page_id <> first then first end as refers_to
        from f""",
    "op12_spelling": f"""
        with recursive t as materialized (select list(c order by n) as crc from (select n, {_CRC_STEPS} as c from range(256) r(n))),
        runs as (select cast(doc_id as varchar) as id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\u00C0-\u00FF]+')) as run from documents),
        distinct_runs as (select id, run, count(*) as n from runs where length(run) >= 7 group by id, run),
        bytes as (select *, flatten(list_transform(string_split(id || ':' || run, ''), lambda ch: case when unicode(ch) < 128 then [unicode(ch)] else [195, unicode(ch) - 64] end)) as b from distinct_runs),
        hashed as (select run, n, xor(list_reduce(b, lambda c, x: xor(c >> 8, crc[cast(1 + xor(c & 255, x::ubigint) as bigint)]), 4294967295::ubigint), 4294967295::ubigint) as h from bytes, t),
        slipped as (select case when h % 31 = 0 then left(run, cast(h % length(run) as bigint)) || substr(run, cast(2 + h % length(run) as bigint)) else run end as word, n from hashed),
        words as materialized (select word, cast(sum(n) as bigint) as n from slipped where length(word) >= 7 group by word having sum(n) >= 2),
        gone as (select word, n, i, left(word, i - 1) || substr(word, i + 1) as k from (select *, unnest(range(1, length(word) + 1)) as i from words)),
        one as materialized (
            select a.word, b.word as near, b.n as near_n from gone a join gone b using (k, i) where a.word <> b.word
            union select a.word, b.word, b.n from gone a join words b on a.k = b.word union select b.word, a.word, a.n from gone a join words b on a.k = b.word),
        forms as materialized (select w.word, w.n, count(near) as n_near, max(near_n) as most, first(near order by near_n desc, encode(near)) as best from words w left join one using (word) group by w.word, w.n),
        links as materialized (select word, best as form from forms where most >= 10 * n),
        walk as (select word, form, 1 as step from links union all select walk.word, links.form, step + 1 from walk join links on walk.form = links.word),
        roots as (select word, arg_max(form, step) as root from walk group by word)
        select f.word, links.form, coalesce(root, f.word) as root, n, n_near, case when links.form is not null then most end as form_n
        from forms f left join links using (word) left join roots using (word)""",
    "op13_clusters": _clusters_sql(),
}
