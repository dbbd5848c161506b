"""Each stage's columns and decisions on a small table, then all five in turn."""

import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline


def test_stages(spark, odd, tmp_path):
    docs = odd
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        result = stage(spark, docs, "")
        if name != "packing":
            assert result.columns == docs.columns
        result.write.parquet(f"{tmp_path}/{name}")
        before, docs = docs, spark.read.parquet(f"{tmp_path}/{name}")
        seen[name] = docs
    known = {r.doc_id for r in seen["language_id"].collect()}
    assert known == {1, 2, 6, 7, 8, None}
    lines = {r.doc_id for r in seen["line_dedup"].collect()}
    assert lines == {1, 6, 7, 8, None}
    assert {r.doc_id for r in seen["ngram_join"].collect()} == lines
    encode = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")).encode
    left = [(r.doc_id, [*encode(r.text, add_special_tokens=False).ids, 1]) for r in before.collect()]
    pieces = docs.collect()
    assert sum(r.length for r in pieces) == sum(len(ids) for _, ids in left)
    for r in pieces:
        assert any(
            r.doc_id == i and r.ids_crc32 == zlib.crc32(np.array(ids[r.start : r.start + r.length], dtype="<u4").tobytes())
            for i, ids in left)


def test_an_empty_corpus_gives_nothing(spark, tmp_path):
    none = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    none.write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
