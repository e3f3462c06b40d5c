"""The registered queries of the subpackage and the corpus pipeline."""

import duckdb
import pytest

import corpus_pipeline
from riskflow.llm import common, line_dedup
from riskflow.llm.queries import ORACLE_SQL, QUERIES

from .test_dedup import LOWER, brute_classes
from .test_models import brute_contamination


def test_one_query_for_each_operator():
    assert sorted(int(n.removeprefix("op").split("_")[0]) for n in QUERIES) == list(range(1, 14))


PASSAGES_SQL = """
    with l as (select doc_id, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) as i from documents),
     h as (select *, md5(line) as h from l),
     r as (select *, md5(coalesce(lag(h) over (partition by doc_id order by i), '') || h) as r from h),
     s as (select *, case when i = 1 or (lead(r) over d is not null and r < lag(r) over d and r <= lead(r) over d) then 1 else 0 end as s
       from r window d as (partition by doc_id order by i)),
     n as (select *, sum(s) over (partition by doc_id order by i) as nth from s),
     p as (select doc_id, i, 2 as n, line || chr(10) || lead(line) over (partition by doc_id order by i) as t from l),
     u as (select doc_id, min(i) as i, count(*) as n, string_agg(line, chr(10) order by i) as t from n group by doc_id, nth having count(*) > 2
       union all select * from p where t is not null
       union all select doc_id, i, 1, line from l where len(regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+')) >= 50),
     e as (select *, row_number() over (partition by t order by doc_id, i) > 1 as again from u where regexp_matches(t, '[^ \t\r\n]')),
     g as (select distinct doc_id, unnest(range(i, i + n)) as i from e where again),
     k as (select l.*, g.i is not null as gone from l left join g using (doc_id, i)),
     m as (select *, gone and not coalesce(lag(gone) over (partition by doc_id order by i), false) as begins from k)
    select d.doc_id, count(i) as n_lines, count(*) filter (gone) as n_removed_lines, count(*) filter (begins) as n_removed_runs,
      case when any_value(d.text) is not null then coalesce(string_agg(line, chr(10) order by i) filter (not gone), '') end as text
    from documents d left join m using (doc_id) group by d.doc_id
    """


@pytest.mark.parametrize("name", [*sorted(ORACLE_SQL), "passages"])
def test_same_rows_as_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for table in ("documents", "pages"):
        con.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    if name == "passages":
        df, sql = line_dedup.without_repeated_passages(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")), PASSAGES_SQL
    else:
        df, sql = QUERIES[name](spark, sf_dir), ORACLE_SQL[name]
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    expected = sorted(repr(tuple(r[columns.index(c)] for c in df.columns)) for r in cursor.fetchall())
    assert sorted(repr(tuple(r)) for r in df.collect()) == expected


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_one_row_for_each_input_row(spark, name):
    sf_dir = "/root/testdata/sf0.001"
    key, table = {"op7": ("page_id", "pages"), "op11": ("conv_id", "conversations")}.get(name.split("_")[0], ("doc_id", "documents"))
    rows = QUERIES[name](spark, sf_dir).select(key).collect()
    ids = [r[key] for r in spark.read.parquet(f"{sf_dir}/{table}.parquet").select(key).collect()]
    ids = sorted(set(ids)) if table == "conversations" else ids
    assert {r[key] for r in rows} == set(ids)
    assert len(rows) == len(ids) or name.startswith("op9")


def test_stages_against_brute_force(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"]: r["text"] for r in docs.collect()}
        docs = common.stored(stage(spark, docs, sf_dir), name)
        kept[name] = docs.collect()
        ids = [r["doc_id"] for r in kept[name]]
        if name != "packing":
            assert docs.columns == columns and len(ids) == len(set(ids))
            assert all(before[r["doc_id"]] == r["text"] for r in kept[name])
        if name == "language_id":
            assert all(any(c.isalpha() for c in r["text"]) for r in kept[name]) and len(ids) > 0.95 * len(before)
        elif name == "exact_dedup":
            groups = {}
            for d, t in before.items():
                groups.setdefault(t.translate(LOWER), []).append(d)
            assert sorted(ids) == sorted(map(max, groups.values()))
        elif name == "ngram_jaccard":
            assert sorted(ids) == sorted({c for _, _, c in brute_classes(list(before.items()), 5, 80)})
        elif name == "decontamination":
            items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
            assert sorted(ids) == sorted(r[0] for r in brute_contamination(list(before.items()), items, 10) if not r[5])
        else:
            tokens = {}
            for r in kept[name]:
                tokens[r["doc_id"]] = tokens.get(r["doc_id"], 0) + r["length"]
            assert tokens == {r["doc_id"]: r["doc_tokens"] for r in kept[name]} and tokens.keys() == before.keys()
    assert sorted(map(tuple, corpus_pipeline.run(spark, sf_dir).select("doc_id", "start", "length", "ids_crc32").collect())) == sorted(
        (r["doc_id"], r["start"], r["length"], r["ids_crc32"]) for r in kept["packing"]
    )


def test_stages_take_odd_rows(spark):
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (3, "123", None, "s", 3), (None, "the and of the words", "en", None, 20), (4, "the and of the text", "en", "s", 1), (4, "the and of the text", "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for table in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            assert stage(spark, table, "/root/testdata/sf0.001").count() >= 0
