import re

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from stratamart.llm.quality_classifier import fit, score
from tests.llm.test_decontamination import brute as contaminated
from tests.llm.test_jaccard_join import brute as groups
from tests.llm.test_packing import check as check_pieces
from tests.llm.test_secret_scan import brute as secrets

SF = "/root/testdata/sf0.001"


def redacted(text, spans):
    covered = [False] * len(text)
    for span in filter(None, spans.split(",")):
        _, a, b = span.split(":")
        covered[int(a) : int(b)] = [True] * (int(b) - int(a))
    marked = "".join("\0" if hit else c for c, hit in zip(text, covered, strict=True))
    return re.sub("\0+", "[SECRET]", marked)


def test_against_plain_python(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    good = {r.doc_id for r in score(docs, fit(docs, labels)).where("predicted = 1").collect()}
    rows = [(r.doc_id, r.text) for r in docs.collect() if r.doc_id in good]
    first = {doc_id for doc_id, _, group in groups(rows, 5, 80) if doc_id == group}
    rows = [r for r in rows if r[0] in first]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    held = {r[0] for r in contaminated(rows, items)}
    rows = [r for r in rows if r[0] not in held]
    spans = {r[0]: r[-1] for r in secrets(rows)}
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {k: [*tokenizer.encode(redacted(t, spans[k]), add_special_tokens=False).ids, 1] for k, t in rows}
    pieces = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id for r in pieces} == ids.keys()
    assert 100 < len(ids) < docs.count() and held
    check_pieces(pieces, ids)


def test_stages_keep_the_columns_of_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == docs.columns


def test_stages_take_empty_and_odd_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    odd = spark.createDataFrame(
        [(None, None, None, None, None), (1, None, "en", "s", 0), (1, "", None, None, None), (2, "a b", "en", "s", 3)], docs.schema
    )
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0
    for _, stage in corpus_pipeline.STAGES[1:-1]:
        assert stage(spark, odd, SF).count() == 4
    assert corpus_pipeline.STAGES[-1][1](spark, odd, SF).count() == 4
