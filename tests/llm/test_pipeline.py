"""The pipeline's stages on the smallest documents: what each keeps and changes."""

import corpus_pipeline
from catalogflow.llm import decontaminate, jaccard, secrets
from catalogflow.session import read_table

FOLDER = "/root/testdata/sf0.001"


def test_stages_take_effect_and_keep_the_columns(spark, tmp_path):
    docs = read_table(spark, FOLDER, "documents")
    odd = spark.createDataFrame([(90001, None, None, "s", 0), (90002, "?? 12", "en", "s", 5), (90003, 'Text with token = "abcdef0123456789abcd" in it', "en", "s", 46)], docs.schema)
    now = docs.unionByName(odd)
    columns, seen = now.columns, {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, now, FOLDER).write.parquet(str(tmp_path / str(k)))
        seen[name], now = now, spark.read.parquet(str(tmp_path / str(k)))
        if k < 4:
            assert now.columns == columns
    ids = lambda df: sorted(r.doc_id for r in df.select("doc_id").collect())
    assert set(ids(seen["language_id"])) - set(ids(seen["near_duplicates"])) == {90001, 90002}
    groups = jaccard.similar(seen["near_duplicates"], 80, 100, 5).collect()
    assert ids(seen["decontamination"]) == sorted(r.doc_id for r in groups if r.doc_id == r.component_id)
    leaked = decontaminate.find(seen["decontamination"], read_table(spark, FOLDER, "benchmark")).filter("size(leaks) > 0")
    assert sorted(ids(seen["secret_scans"]) + ids(leaked)) == ids(seen["decontamination"]) and leaked.count()
    clean = seen["packing"]
    assert ids(clean) == ids(seen["secret_scans"]) and secrets.scan(clean).filter("size(secrets) > 0").count() == 0
    row = clean.filter("doc_id = 90003").first()
    assert row.text == 'Text with [SECRET]" in it' and row.n_chars == len(row.text)
    assert sorted({r.doc_id for r in now.select("doc_id").collect()}) == ids(clean)


def test_near_duplicates_know_documents_by_id_and_text(spark):
    same = "one two three four five six seven eight nine ten eleven twelve"
    own = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"
    other = "red orange yellow green blue violet white black brown grey pink gold"
    rows = [(1, same), (2, same), (2, own), (None, same), (None, other), (None, other), (7, own + " nu"), (8, ""), (8, ""), (9, None), (None, None)]
    docs = spark.createDataFrame([(i, t, k, "x") for k, (i, t) in enumerate(rows)], "doc_id bigint, text string, _near int, _key string")
    kept = corpus_pipeline.near_duplicates(spark, docs, FOLDER)
    assert kept.columns == docs.columns
    got = sorted((r.doc_id is None, r.doc_id or 0, r.text or "") for r in kept.collect())
    assert got == sorted([(False, 1, same), (False, 2, own), (True, 0, other), (False, 8, ""), (False, 8, ""), (False, 9, ""), (True, 0, "")])


def test_stages_of_empty_tables_and_clashing_names(spark):
    base = read_table(spark, FOLDER, "documents")
    clash = base.limit(60).selectExpr("*", "1 AS _leaks", "'a' AS _lang_pred", "2.0D AS _lang_score", "3 AS _near", "4 AS _again", "5 AS _secrets")
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, base.filter("false"), FOLDER).count() == 0, name
        out = stage(spark, clash.unionByName(clash), FOLDER)
        if name != "packing":
            assert out.columns == clash.columns and out.filter("_leaks = 1 AND _lang_pred = 'a' AND _near = 3 AND _again = 4 AND _secrets = 5").count() == out.count(), name
        else:
            assert out.count() >= 120
    assert corpus_pipeline.secret_scans(spark, base.select("doc_id", "text"), FOLDER).columns == ["doc_id", "text"]
