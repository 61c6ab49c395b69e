import re

import public_tokenizers
import pytest

import __spark_entry__ as entry
import corpus_pipeline

from .test_repetition import plain as plain_rules
from .test_sanitise import plain as plain_entities
from .test_simhash import plain_fingerprint, plain_groups
from .test_tokens import check_packing, whole

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """(input rows, output) of each stage."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("stage") / str(i))
        stage(spark, docs, SF).write.parquet(path)
        result = spark.read.parquet(path)
        out.append((docs, result))
        docs = result
    return out


def test_stages_return_the_columns_of_documents(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "quality classifier", "simhash near-dedup", "pii", "packing"]
    for docs, result in stages[:-1]:
        assert result.dtypes == docs.dtypes


def test_quality_rules(stages):
    docs, result = stages[0]
    rows = docs.collect()
    short = [r for r in rows if len(r.text or "") < 30_000]  # brute force compares all pairs of positions
    want = {r.doc_id for r in short if len((r.text or "").split()) < 1500 and plain_rules(r.text)["kept"]}
    sure = {r.doc_id for r in short if len((r.text or "").split()) < 1500}
    kept = {r.doc_id for r in result.collect()}
    assert kept & sure == want and len(sure) > 0.8 * len(rows) and 0 < len(kept) < len(rows)


def test_quality_classifier(spark, stages):
    docs, result = stages[1]
    kept = {r.doc_id for r in result.collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    known = [(r.doc_id in kept, labels[r.doc_id]) for r in docs.collect() if r.doc_id in labels]
    assert sum(k for k, q in known if q) >= 0.95 * sum(q for _, q in known)
    assert not any(k for k, q in known if not q)


def test_near_dedup(stages):
    docs, result = stages[2]
    rows = [(r.doc_id, plain_fingerprint(r.text)) for r in docs.collect()]
    assert sorted(r.doc_id for r in result.collect()) == sorted(set(plain_groups(rows).values()))


def test_pii(stages):
    docs, result = stages[3]
    before, after = ({r.doc_id: r for r in x.collect()} for x in (docs, result))
    assert before.keys() == after.keys()
    for i, r in after.items():
        assert r.n_chars == len(r.text)
        left = [k for k, _, _ in plain_entities(r.text)]
        assert not left
        placeholders = re.findall(r"\[(?:EMAIL|IP|CARD|PHONE|TERM)\]", r.text)
        assert placeholders or r.text == before[i].text or not plain_entities(before[i].text)


def test_packing(stages):
    docs, result = stages[4]
    rows = docs.collect()
    ids = [x + b"\0\0\0\0" for x in whole(public_tokenizers.path("byte_bpe_50k.json"), [r.text for r in rows])]
    check_packing(result.collect(), [(r.doc_id, x) for r, x in zip(rows, ids)])


def test_run(spark, stages):
    got = entry.queries()["pipeline"](spark, SF)
    assert got.columns == stages[-1][1].columns
    key = ["doc_id", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, got.select(key).collect())) == sorted(map(tuple, stages[-1][1].select(key).collect()))


def test_odd_tables(spark):
    """Nulls in any column, repeated rows, an empty table."""
    text = "The cat sat on the mat and the dog lay by the door of a house that was for sale. " + " ".join("word" + chr(97 + i) for i in range(20))
    rows = [(1, text, None, None, None), (1, text, None, None, None), (None, "An " + text + " to me@example.org", "en", "x", 9), (2, None, "en", "s", 0),
            (3, "", None, "s", None), (4, "BUY!! " * 50, "en", "s", 300)]
    schema = spark.read.parquet(f"{SF}/documents.parquet").schema
    for data in (rows, []):
        docs = spark.createDataFrame(data, schema)
        for name, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SF)
            docs = spark.createDataFrame(docs.collect(), docs.schema)
        assert docs.select("doc_id").distinct().count() == (2 if data else 0)
