import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from stratamart.llm.packing import WordEncoder, pack_documents

PATH = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = [
    None,
    "",
    "a  b",
    "x\n\ny",
    " lead",
    "trail ",
    "a\n",
    "it's <|endoftext|> ok",
    "tab\there",
    "\n",
    "  ",
    "é ü\nß",
    " 's 't",
    "wide space\xa0here",
    "end. of, words.,; 12a a12 --",
    "word " * 3000,
    "same",
    "same",
]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def test_ids_are_the_tokenizers(tokenizer):
    encoder = WordEncoder(PATH)
    for text in [x or "" for x in TEXTS]:
        got = np.frombuffer(encoder.encode(text), "<u4").tolist()
        assert got == tokenizer.encode(text, add_special_tokens=False).ids, text


def check(rows, ids):
    """Every id in exactly one piece, pieces gapless in their sequences, right digests, little padding."""
    docs, sequences = {}, {}
    for r in rows:
        docs.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append(r)
        whole = ids[r.doc_id]
        assert r.doc_tokens == len(whole)
        assert r.ids_crc32 == zlib.crc32(np.asarray(whole[r.start : r.start + r.length], "<u4").tobytes())
    for doc_id, whole in ids.items():
        at = 0
        for r in sorted(docs[doc_id], key=lambda r: r.start):
            assert r.start == at and r.length > 0
            at += r.length
        assert at == len(whole)
    padding = 0
    for pieces in sequences.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048
        padding += 0 if at & (at - 1) == 0 else 2048 - at
    return padding


def test_pieces_cover_documents(spark, tokenizer):
    df = spark.createDataFrame([(k, x, "clash") for k, x in enumerate(TEXTS)], "doc_id long, text string, tier string")
    rows = pack_documents(df.coalesce(1), PATH).collect()
    ids = {k: [*tokenizer.encode(x or "", add_special_tokens=False).ids, 1] for k, x in enumerate(TEXTS)}
    assert check(rows, ids) < 2048


def test_given_documents(spark, tokenizer):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = pack_documents(df.coalesce(1), PATH, pool_tokens=20_000).collect()
    ids = {r.doc_id: [*tokenizer.encode(r.text, add_special_tokens=False).ids, 1] for r in df.collect()}
    assert check(rows, ids) < 2048
    loads = {}
    for r in rows:
        loads[r.step_group] = loads.get(r.step_group, 0) + r.length
    assert max(loads.values()) <= 3 * 32 * 2048


def test_empty_table_and_null_ids(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert pack_documents(empty, PATH).count() == 0
    nulls = spark.createDataFrame([(None, "a"), (None, "a")], "doc_id long, text string")
    assert pack_documents(nulls, PATH).where(F.col("doc_id").isNull()).count() == 2
