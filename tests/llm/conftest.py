import hashlib

import pytest

EDGE_TEXTS = [
    None, "", " \n\t ", "one", "one two", "One TWO three", "one two three four five six seven eight nine ten",
    "ONE two, three-four five six seven eight nine ten eleven", "émigré naïve ÉCOLE 東京 один два", "a b c d",
]


def sha(b: bytes) -> str:
    return hashlib.sha256(b).hexdigest()


@pytest.fixture()
def docs_of(spark, tmp_path):
    """Texts (or (id, text) or (id, text, lang, source)) as a written documents table, scanned from files."""
    made = [0]

    def make(rows, extra=()):
        full = []
        for i, r in enumerate(rows):
            r = r if isinstance(r, tuple) else (i, r)
            full.append((*r, *("en", "s")[len(r) - 2 :]) if len(r) < 4 else r)
        names = [x.split()[0] for x in extra]
        schema = "doc_id long, text string, lang string, source string" + "".join(f", {x}" for x in extra)
        df = spark.createDataFrame([(*r, *([None] * len(names))) for r in full], schema)
        made[0] += 1
        path = str(tmp_path / f"docs{made[0]}")
        df.repartition(3).write.parquet(path)
        return spark.read.parquet(path)

    return make
