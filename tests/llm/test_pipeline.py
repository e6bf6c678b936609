from __future__ import annotations

import corpus_pipeline
from quarterlens.llm import decontaminate, language, near_dedup, registry, secrets
from quarterlens.llm.common import materialize, table

from .conftest import SF


def test_stages_take_effect(spark, documents):
    docs = documents
    sizes = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = materialize(stage(spark, docs, SF), f"test-{name}")
        assert out.columns == documents.columns
        docs = out
        sizes.append(docs.count())
    assert sizes[0] >= sizes[1] > sizes[2] > sizes[3] == sizes[4]
    benchmark = table(spark, SF, "benchmark")
    assert decontaminate.leaks(docs, benchmark).count() == 0
    assert secrets.scan_secrets(docs).agg({"n_hex": "sum", "n_access": "sum", "n_assign": "sum"}).first() == (0, 0, 0)
    assert {r.lang_pred for r in language.identify(docs).select("lang_pred").distinct().collect()} <= {"en", "de", "es", "fr"}
    assert near_dedup.near_duplicates(docs).where("not kept").count() <= 2  # redaction may make texts alike
    assert all(r.n_chars == len(r.text) for r in docs.collect())


def test_run_equals_its_stages(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    assert rows and {"doc_id", "taken", "target"} <= set(rows[0].asDict())
    assert sorted(map(str, rows)) == sorted(map(str, registry.pipeline(spark, SF).collect()))


def test_odd_rows_pass_all_stages(spark, odd_documents, tmp_path):
    documents, sf = odd_documents.drop("component_id"), str(tmp_path)
    documents.write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([(1, "one two")], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    rows = corpus_pipeline.run(spark, sf).collect()
    assert sorted(r.doc_id or 0 for r in rows) == [0, 1, 8]


def test_documents_of_unlearned_languages_go(spark):
    # 10,000 documents: a model of 1,000 cannot tell this Dutch from its languages.
    documents = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    planted = {
        "it": "Il presidente della repubblica ha dichiarato che ieri il governo ha approvato una nuova legge sulle pensioni",
        "nl": "De regering heeft gisteren een nieuwe wet aangenomen over de pensioenen van alle werknemers in het land",
        "fi": "Presidentti sanoi eilen että hallitus on hyväksynyt uuden lain kaikkien työntekijöiden eläkkeistä maassa",
        "ru": "Президент заявил вчера что правительство приняло новый закон о пенсиях для всех работников страны",
        "zh": "总统昨天表示政府通过了一项关于全国所有员工养老金的新法律",
        "soup": "xqzv kjwp zzrt bvxq wqpl jkxz qqvt hjkl zxcv mnbq wrtp plkj xqwz vbnm jjqx",
    }
    rows = [(10 ** 9 + i, t, None, "planted", len(t)) for i, t in enumerate(planted.values())]
    docs = documents.select("doc_id", "text", "lang", "source", "n_chars")
    docs = docs.unionByName(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"))
    kept = {r.doc_id for r in language.known_language(docs).select("doc_id").collect()}
    assert kept == {r.doc_id for r in documents.where("text rlike '\\\\p{L}'").select("doc_id").collect()}
