import pytest

from tablelens.llm import decontam, simhash, substring, warc

PART = "spark.sql.files.minPartitionNum"


@pytest.fixture()
def cut_anew(spark):
    """Collects a frame after the scans' partitions have changed, as when cores come or go between two jobs."""

    def collect(df):
        spark.conf.set(PART, "1")
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        return df.collect()

    yield collect
    spark.conf.unset(PART)
    spark.conf.unset("spark.sql.files.openCostInBytes")


def test_rows_keep_their_numbers_when_scans_are_cut_anew(spark, docs_of, cut_anew):
    words = lambda i: " ".join(f"w{i}x{j}" for j in range(60))
    twin = words(7) + " " + words(8)
    rows = [(i, words(i)) for i in range(40)] + [(100 + i, twin) for i in range(20)]
    docs = docs_of(rows)
    bench = spark.createDataFrame([(1, twin)], "item_id long, text string")
    pages = spark.createDataFrame([(i, f"http://x/{i}", t) for i, t in rows], "page_id long, url string, html string")
    path = docs.inputFiles()[0].rsplit("/", 1)[0] + "-pages"
    pages.repartition(3).write.parquet(path)
    outs = [simhash.deduplicate(docs), substring.cut_texts(docs), decontam.drop_contaminated(docs, bench), warc.records(spark.read.parquet(path))]
    once, cut, clean, archived = (cut_anew(x) for x in outs)
    assert sorted(r.doc_id for r in once if r.doc_id >= 40) == [100] and len({r.doc_id for r in once}) == len(once) == 41
    assert {r.doc_id for r in cut if r.text == ""} == {7, 8} | {100 + i for i in range(20)}
    assert {r.doc_id for r in clean} == {i for i in range(40) if i not in (7, 8)}
    assert len(archived) == 60 and {r.page_id for r in archived if r.record_type == "revisit"} == {100 + i for i in range(19)}
