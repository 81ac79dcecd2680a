import corpus_pipeline
from tests.llm import test_decontam, test_simhash, test_substring

SF = "/root/testdata/sf0.001"


def test_stages_equal_brute_force(spark, tmp_path):
    """Each stage on what the one before it kept; toxicity is held to its labels, the others to brute force."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    kept = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        if k < 4:
            assert out.columns == columns
        out.write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        kept.append([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()] if k < 4 else docs.collect())
    clean, near, cut, pure, mixed = kept
    ids = [i for i, _ in clean]
    comp = test_simhash.components(ids, [test_simhash.plain(t) for _, t in clean])
    assert sorted(i for i, _ in near) == sorted(i for i, c in zip(ids, comp) if i == c)
    assert sorted(i for i, _ in cut) == sorted(i for i, _ in near)
    exp = {r[0]: r for r in test_substring.brute(near, 200)}
    whole = dict(near)
    for i, t in cut:
        extra = len(t.encode()) - (exp[i][1] - exp[i][2])
        assert 0 <= extra <= 6 * exp[i][3]  # a character covered in part stays
        if not exp[i][2]:
            assert t == whole[i]
    marks = {r[0]: r[5] for r in test_decontam.brute(cut, bench)}
    assert sorted(i for i, _ in pure) == sorted(i for i, m in marks.items() if not m)
    assert sorted(r.doc_id for r in mixed) == sorted(i for i, _ in pure)
    assert all(0 <= r.taken <= 3 * r["size"] for r in mixed)


def test_run_equals_stages_and_reruns_agree(spark):
    a = sorted(tuple(r) for r in corpus_pipeline.run(spark, SF).collect())
    assert a == sorted(tuple(r) for r in corpus_pipeline.run(spark, SF).collect()) and a


def test_clashing_columns_nulls_and_repeats_go_through(spark, docs_of):
    extra = ["uid long", "_uid long", "_spans string", "score double", "fp long", "component long", "n_chars long", "contaminated string"]
    rows = [(1, "some words here", "en", "a"), (1, "other words there", "en", None), (None, None, None, None), (None, "lonely text", "de", "a"), (2, "", "en", "b"), (3, "some words here", "en", "a")]
    docs = docs_of(rows, extra)
    for _, stage in corpus_pipeline.STAGES[:4]:
        docs2 = stage(spark, docs, SF)
        assert docs2.columns == docs.columns
        got = sorted((r.doc_id is None, r.doc_id or 0, r.text or "") for r in docs2.collect())
        exp = rows if stage is not corpus_pipeline.drop_near_duplicates else [r for r in rows if r[0] != 3 and r[1] is not None]
        assert got == sorted((r[0] is None, r[0] or 0, r[1] or "") for r in exp)
    assert corpus_pipeline.mix(spark, docs, SF).count() == len(rows)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.filter("false"), SF).count() == 0
