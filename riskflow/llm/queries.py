"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from riskflow.llm import conversations, decontamination, exact_dedup, html_text, jaccard, langid, line_dedup, packing, repair, runs, token_counts as counting, toxicity, warc
from riskflow.llm.tokens import VOCABULARY

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(name: str, sql: str | None = None) -> Callable:
    def register(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[name] = f
        if sql:
            ORACLE_SQL[name] = sql
        return f

    return register


PIECES = "piece_bpe_32k.model"


@query("op1_language_id")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    unseen = langid.held_out(F.col("doc_id"), 4, 2)
    model = langid.fit(docs.filter(~unseen), public_tokenizers.path(PIECES))
    predicted = langid.predict(docs.select("doc_id", "text", unseen.alias("held_out")), model)
    return predicted.select("doc_id", "held_out", "lang_pred", "score")


@query("op2_ngram_jaccard")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicate_classes(table(spark, sf_dir, "documents"), width=3, percent=90)


@query("op3_token_counts")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counting.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY), limit=1024)


@query(
    "op4_line_dedup",
    """
    with l as (select doc_id, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) as i from documents),
     h as (select *, md5(line) as h from l),
     r as (select *, md5(coalesce(lag(h) over (partition by doc_id order by i), '') || h) as r from h),
     s as (select *, case when i = 1 or (lead(r) over d is not null and r < lag(r) over d and r <= lead(r) over d) then 1 else 0 end as s
       from r window d as (partition by doc_id order by i)),
     n as (select *, sum(s) over (partition by doc_id order by i) as nth from s),
     c as (select doc_id, nth, string_agg(line, chr(10) order by i) as chunk, count(*) as n from n group by 1, 2),
     e as (select *, row_number() over (partition by chunk order by doc_id, nth) as k from c where n > 1 and regexp_matches(chunk, '[^ \t\r\n]')),
     k as (select c.*, coalesce(e.k, 1) > 1 as gone from c left join e using (doc_id, nth))
    select d.doc_id, cast(coalesce(sum(n), 0) as bigint) as n_lines, cast(coalesce(sum(n) filter (gone), 0) as bigint) as n_removed_lines,
      cast(count(*) filter (gone) as bigint) as n_removed_chunks,
      case when any_value(d.text) is not null then coalesce(string_agg(chunk, chr(10) order by nth) filter (not gone), '') end as text
    from documents d left join k using (doc_id) group by d.doc_id
    """,
)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.without_repeated_chunks(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op5_toxicity")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    unseen = langid.held_out(F.col("doc_id"), 3, 1)
    model = toxicity.fit(docs, labels.filter(~unseen))
    scored = toxicity.score(docs.select("doc_id", "text", unseen.alias("held_out")), model, threshold=0.7)
    return scored.select("doc_id", "held_out", "score", "predicted")


@query("op6_decontamination")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = decontamination.contamination_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return report.drop("matches", "item_ids")


@query("op7_html_text")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


@query("op8_token_ids")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.encode_and_read_back(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY), end_id=2)


@query("op9_packing")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY), end_id=1, window=2048)


@query(
    "op10_exact_dedup",
    """
    with t as (select doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) as text_sha256
      from documents)
    select doc_id, max(doc_id) over g as keep_id, count(*) over g as group_size, doc_id = max(doc_id) over g as kept, text_sha256
    from t window g as (partition by text_sha256)
    """,
)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.duplicate_report(table(spark, sf_dir, "documents"))


@query("op11_conversation_repair")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair_of_damaged(table(spark, sf_dir, "conversations"))


@query(
    "op12_warc",
    """
    with p as (select page_id, encode(coalesce(html, '')) as b, sha1(coalesce(html, '')) as h from pages),
     d as (select *, list_aggregate(list_transform(range(32), lambda i:
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + cast(
           ((cast('0x' || substr(h || '0', cast(1 + 5 * i // 4 as bigint), 2) as int) // cast(pow(2, 3 - 5 * i % 4) as int)) % 32) as bigint), 1)),
         'string_agg', '') as payload_digest from p),
     r as (select *, row_number() over g as n, first(page_id) over g as response from d window g as (partition by b order by page_id nulls last))
    select page_id, octet_length(b) as payload_bytes, payload_digest, case when n = 1 then 'response' else 'revisit' end as record_type,
      case when n > 1 then response end as refers_to from r
    """,
)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.archived(table(spark, sf_dir, "pages"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op13_periodic_runs")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = runs.with_planted_repetition(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return runs.digests(runs.find_runs(docs))
