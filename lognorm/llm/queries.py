"""The registered queries of the operators, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lognorm.llm import language_model, quality, toxicity, warc
from lognorm.llm.alignment import aligned
from lognorm.llm.common import fold, table
from lognorm.llm.decontaminate import contained_items
from lognorm.llm.nearest import nearest
from lognorm.llm.packing import packed
from lognorm.llm.runs import summaries
from lognorm.llm.secret_scan import find_secrets
from lognorm.llm.sentencepiece_codec import encoded
from lognorm.llm.simhash import near_duplicates
from lognorm.llm.url_filter import LISTED_PARTS, LOWER, RULES, UPPER, hosts_with_parts, judge
from lognorm.llm.warc import BASE32, derivatives, responses

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(f: Query) -> Query:
    REGISTRY[f.__name__] = f
    return f


@query
def op4_sentencepiece(spark, sf_dir):
    return encoded(table(spark, sf_dir, "documents"), check=True)


@query
def op8_simhash(spark, sf_dir):
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def span_list(column: str):
    return F.array_join(F.transform(column, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


@query
def op9_secret_scan(spark, sf_dir):
    found = find_secrets(table(spark, sf_dir, "documents"))
    number = lambda kind: F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long")
    return found.select(
        "doc_id", number("assign").alias("n_assign"), number("access").alias("n_access"), number("hex").alias("n_hex"),
        F.sha2(span_list("base").cast("binary"), 256).alias("base_sha256"), span_list("secrets").alias("spans"))


@query
def op10_decontamination(spark, sf_dir):
    return contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = f"regexp_extract_all({_LOWER}, '[^\\x20\\x09-\\x0D]+')"


def _shingles(name: str, table_name: str) -> str:
    return f"""{name}_w AS (SELECT {name}_id, {_WORDS} AS w FROM (SELECT {name}_id, text FROM {table_name})),
    {name}_s AS (SELECT DISTINCT {name}_id, n, array_to_string(w[i:i + n - 1], ' ') AS s
        FROM (SELECT {name}_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
              FROM {name}_w, (SELECT DISTINCT least(5, len(w)) AS n FROM item_w WHERE len(w) > 0)))"""


SQL["op10_decontamination"] = f"""
WITH {_shingles('item', 'benchmark')}, {_shingles('doc', 'documents')},
own AS (SELECT s.* FROM item_s s JOIN item_w w USING (item_id) WHERE s.n = least(5, len(w.w))),
sizes AS (SELECT item_id, count(*) AS shingles FROM own GROUP BY item_id),
hits AS (SELECT d.doc_id, o.item_id, count(*) AS shared FROM own o JOIN doc_s d USING (n, s) GROUP BY ALL)
SELECT doc_id, item_id, shared, shingles, shared / shingles AS containment
FROM hits JOIN sizes USING (item_id) WHERE shared >= 0.8 * shingles - 1e-9
"""


@query
def op3_url_filter(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return judge(pages, hosts_with_parts(pages))


_AFTER = "CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END"
_FITS = " UNION ALL ".join(
    f"SELECT page_id, url, '{h + p}' AS rule, '{kind}' AS kind FROM parts "
    f"WHERE (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')" for kind, h, p in RULES)
SQL["op3_url_filter"] = f"""
WITH rest AS (SELECT page_id, url, {_AFTER} AS r FROM pages),
cut AS (SELECT page_id, url, regexp_extract(r, '^[^/?#]*') AS raw, r FROM rest),
parts AS (SELECT page_id, url, translate(raw, '{UPPER}', '{LOWER}') AS host,
    regexp_extract(substr(r, length(raw) + 1), '^[^?#]*') AS path FROM cut),
fits AS ({_FITS}),
best AS (SELECT page_id, arg_max(rule, length(rule)) AS rule, arg_max(kind, length(rule)) AS kind FROM fits GROUP BY page_id)
SELECT p.page_id, p.host, p.path, b.rule, coalesce(b.kind, CASE
    WHEN len(list_intersect(regexp_split_to_array(p.host, '[.-]'), {list(LISTED_PARTS)})) > 0 THEN 'block' ELSE 'allow' END) AS verdict
FROM parts p LEFT JOIN best b USING (page_id)
"""


@query
def op5_warc_derivatives(spark, sf_dir):
    return derivatives(responses(table(spark, sf_dir, "pages")), ["page_id"])


def _sql_text(s: str) -> str:
    """A SQL expression for a string with control characters."""
    return "'" + s.replace("'", "''").replace("\r", "' || chr(13) || '").replace("\n", "' || chr(10) || '") + "'"


def _sql_digest(x: str) -> str:
    return f"""'sha1:' || list_aggregate(list_transform(range(32), lambda i: substr('{BASE32}', 1 + CAST(
        (CAST('0x' || substr(sha1({x}), 1 + 5 * CAST(floor(i / 4) AS INT), 5) AS INT) >> CAST(15 - 5 * (i % 4) AS INT)) & 31 AS INT), 1)), 'string_agg', '')"""


def _sql_id(kind: str, *parts: str) -> str:
    h = f"md5({' || chr(10) || '.join([repr(kind), *parts])})"
    return (f"'<urn:uuid:' || substr({h}, 1, 8) || '-' || substr({h}, 9, 4) || '-3' || substr({h}, 14, 3) || '-a' || "
            f"substr({h}, 18, 3) || '-' || substr({h}, 21, 12) || '>'")


def _sql_entities(x: str) -> str:
    names = ", ".join(f"'{k}': chr({ord(v)})" for k, v in warc.ENTITIES.items())
    name = f"regexp_extract(p, '{warc.ENTITY}', 1)"
    number = f"CASE WHEN regexp_matches({name}, '^#[xX]') THEN CAST('0x' || substr({name}, 3) AS BIGINT) WHEN starts_with({name}, '#') THEN CAST(substr({name}, 2) AS BIGINT) END"
    char = f"""CASE WHEN ({number}) BETWEEN 1 AND 55295 OR ({number}) BETWEEN 57344 AND 1114111 THEN chr(CAST({number} AS INT))
        ELSE map_extract_value(MAP {{{names}}}, {name}) END"""
    return f"""(string_split({x}, '&')[1] || coalesce(array_to_string(list_transform(string_split({x}, '&')[2:], lambda p:
        coalesce(({char}) || substr(p, length({name}) + 2), '&' || p)), ''), ''))"""


def _sql_plain(x: str) -> str:
    gone = f"regexp_replace(regexp_replace(regexp_replace({x}, {_sql_text(warc.HIDDEN)}, ' ', 'g'), {_sql_text(warc.BREAKS)}, chr(10), 'g'), '{warc.TAGS}', '', 'g')"
    return _sql_entities(gone)


_FIELDS = ["'source-record-id: ' || refers_to", "'conversion-record-id: ' || conversion_id", "'source-block-digest: ' || sbd",
           "'source-payload-digest: ' || spd", "'source-content-length: ' || strlen(source)", "'title: ' || title", "'language: ' || language",
           *[f"'source-http: ' || {_sql_text(line)}" for line in warc.HTTP_HEADERS.split('\r\n')]]
SQL["op5_warc_derivatives"] = f"""
WITH src AS (SELECT page_id, coalesce(url, '') AS target_uri, coalesce(html, '') AS html,
        {_sql_text(warc.HTTP_HEADERS)} || chr(13) || chr(10) || chr(13) || chr(10) || coalesce(html, '') AS source FROM pages),
ids AS (SELECT *, {_sql_id('response', 'page_id', 'target_uri')} AS refers_to, {_sql_digest('source')} AS sbd, {_sql_digest('html')} AS spd FROM src),
ids2 AS (SELECT *, {_sql_id('conversion', 'refers_to')} AS conversion_id, {_sql_id('metadata', 'refers_to')} AS metadata_id,
        regexp_extract(html, {_sql_text(warc.TITLE)}, 1) AS raw_title, regexp_extract(html, {_sql_text(warc.LANGUAGE)}, 1) AS language,
        {_sql_plain('html')} AS visible FROM ids),
ready AS (SELECT *, regexp_replace(regexp_replace({_sql_entities('raw_title')}, '[ \\t\\r\\n]+', ' ', 'g'), '^ | $', '', 'g') AS title,
        regexp_replace(regexp_replace(regexp_replace(visible, '[ \\t\\r\\f\\x0B\\x{{00A0}}]{{2,}}|[\\t\\r\\f\\x0B\\x{{00A0}}]', ' ', 'g'),
            ' ?\\n[ \\n]*', chr(10), 'g'), '^[ \\n]+|[ \\n]+$', '', 'g') AS plain FROM ids2),
made AS (
    SELECT page_id, refers_to, target_uri, conversion_id AS record_id, 'conversion' AS warc_type, 'text/plain; charset=utf-8' AS content_type, plain AS block FROM ready
    UNION ALL
    SELECT page_id, refers_to, target_uri, metadata_id, 'metadata', 'application/warc-fields',
        {" || chr(13) || chr(10) || ".join(_FIELDS)} || chr(13) || chr(10) FROM ready)
SELECT page_id, record_id, warc_type, refers_to, target_uri, '{warc.DATE}' AS date, content_type, strlen(block) AS content_length,
    {_sql_digest('block')} AS block_digest, {_sql_digest('block')} AS payload_digest, block FROM made
"""


def held_out(key, folds: int, remainder: int):
    return (fold(key, folds) == remainder).alias("held_out")


@query
def op1_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.scored(docs, model).select(
        "doc_id", held_out(F.col("doc_id"), toxicity.FOLDS, toxicity.HELD_OUT), "score", "predicted")


@query
def op7_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.scored(docs, model).select(
        "doc_id", held_out(F.col("doc_id"), quality.FOLDS, quality.HELD_OUT), "score", "predicted")


@query
def op2_nearest(spark, sf_dir):
    return nearest(table(spark, sf_dir, "embeddings"), "vec_id % 50 = 0")


@query
def op6_language_model(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    key = F.col("doc_id")
    found = language_model.score_corpus(docs, fold(key, 7) != 2)
    return found.select("doc_id", held_out(key, 7, 2), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query
def op11_alignment(spark, sf_dir):
    return aligned(table(spark, sf_dir, "documents"))


@query
def op12_packing(spark, sf_dir):
    return packed(table(spark, sf_dir, "documents"))


@query
def op13_runs(spark, sf_dir):
    return summaries(table(spark, sf_dir, "documents"), plant=True)
