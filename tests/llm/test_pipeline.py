from pyspark.sql import functions as F

import corpus_pipeline
from contigloom.llm import leaks, near, quality, secrets
from contigloom.llm.queries import table, tokenizer_path
from contigloom.session import settle
from tests.conftest import SF
from tests.llm.cases import DOCS, ODD, docs, prose
from tests.llm.test_near import brute as near_brute
from tests.llm.test_packing import whole_ids


def test_each_stage_does_its_work_on_what_the_last_one_kept(spark, tmp_path):
    docs, seen = table(spark, SF, "documents"), []
    columns = docs.columns
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        seen.append(docs)
        assert k == len(corpus_pipeline.STAGES) - 1 or docs.columns == columns
    texts = [{r["doc_id"]: r["text"] for r in s.collect()} for s in seen[:-1]]
    start = table(spark, SF, "documents")
    assert set(texts[0]) == {r["doc_id"] for r in quality.quality_rules(start).filter("kept").collect()}
    ids = sorted(texts[0])
    classes = near_brute([texts[0][i] for i in ids])
    assert set(texts[1]) == {ids[i] for i, (top, _) in classes.items() if top == i}
    leaked = {r["doc_id"] for r in leaks.leaked(seen[1], table(spark, SF, "benchmark")).collect()}
    assert set(texts[2]) == set(texts[1]) - leaked
    assert set(texts[3]) == set(texts[2]) and not any(secrets.base_spans(t) for t in texts[3].values())
    assert all(texts[3][i] == t for i, t in texts[2].items() if not secrets.base_spans(t))
    lengths = {}
    for r in docs.collect():
        lengths[r["doc_id"]] = lengths.get(r["doc_id"], 0) + r["length"]
    assert lengths == {i: len(whole_ids(t)) for i, t in texts[3].items()}


def test_run_gives_the_last_stage(spark):
    assert set(corpus_pipeline.run(spark, SF).columns) == {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"}
    assert tokenizer_path().endswith(".json") and near.THRESHOLD == 0.8


CLASHING = {"spans_": "'mine'", "changed_": "7", "row_": "2.5D", "kept": "'k'", "hash": "1", "found_": "cast(null as string)", "tokens": "'t'"}


def test_every_stage_takes_nulls_repeats_and_clashing_names(spark):
    good = [prose(80 + i, i) for i in range(60)]
    secret = prose(90, 70) + " password=abcdefgh12345 " + "AKIA" + "B2" * 10
    texts = [*enumerate([*ODD, *good, secret, good[0]]), (None, prose(90, 71)), (3, prose(90, 72)), (8, good[0])]
    rows = docs(spark, texts).withColumns({c: F.expr(e) for c, e in CLASHING.items()})
    rows = rows.withColumns({c: F.when(F.col("doc_id") % 7 != 0, F.col(c)) for c in ("lang", "source", "n_chars")})
    columns, kept = rows.columns, rows
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, SF)
        assert kept.columns == columns, name
        kept = settle(kept)
    got = kept.collect()
    assert all((r["spans_"], r["changed_"], r["row_"], r["kept"]) == ("mine", 7, 2.5, "k") for r in got)
    ids = [r["doc_id"] for r in got]
    n = len(ODD)
    assert None in ids and ids.count(n) <= 1 and n + 61 not in ids and len(ids) == len(set(ids)) > 40
    clean = next(r for r in got if r["doc_id"] == n + 60)
    assert "password=" not in clean["text"] and "AKIA" not in clean["text"] and clean["n_chars"] in (None, len(clean["text"]))
    packed = corpus_pipeline.packing_stage(spark, rows, SF)
    assert packed.count() >= len(texts) and {r["doc_id"] for r in packed.collect()} == {i for i, _ in texts}


def test_every_stage_takes_an_empty_table(spark):
    none = spark.createDataFrame([], DOCS)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, SF).count() == 0, name


def test_a_task_of_the_secrets_stage_has_one_python_worker(spark):
    # a second one is kept by its executor, and later learns words for the packing like the first
    rows = docs(spark, [*ODD, prose(90, 70) + " password=abcdefgh12345 " + "AKIA" + "B2" * 10, "secret = 0123456789abcdef" * 2])
    clean = corpus_pipeline.secret_stage(spark, rows, SF)
    assert clean._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
    scanned = secrets.scan(rows, None)
    want = {r["doc_id"]: (r["text"], len(r["text"] or "")) for r in secrets.redacted(scanned).collect()}
    assert {r["doc_id"]: (r["text"], r["n_chars"] or 0) for r in clean.collect()} == want
    assert sum("<secret>" in (text or "") for text, _ in want.values()) == 2


def test_the_secrets_stage_learns_from_every_finding(spark, monkeypatch):
    # 1,600 secrets of one label, each with a key of its own; 30 plain candidates
    rows = docs(spark, [f"token={i:04d}{i * 7919:012x}" for i in range(1_600)] + [f"see page {i:06d}abcdef{i * 104729:012x}" for i in range(30)])
    learnt = []
    monkeypatch.setattr(secrets.CharNet, "fit", lambda net, x, y: learnt.append((int((1 - y).sum()), int(y.sum()))))
    corpus_pipeline.secret_stage(spark, rows, SF)
    found = {r["label"]: r["count"] for r in secrets.findings(rows).groupBy("label").count().collect()}
    assert found[1] >= 1_600 and learnt == [(found[0], found[1])]
