"""The pipeline's stages against what each operator says, on the smallest tables."""

import hashlib

import public_tokenizers
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from modlens.llm import bpe, decontaminate, jaccard, secrets
from modlens.llm.common import saved

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "near_duplicates", "decontamination", "secrets", "tokens"]
    now, texts = docs, {r["doc_id"]: r["text"] for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = saved(stage(spark, now, SF), name)
        assert after.columns == docs.columns
        before_ids, ids = {r["doc_id"] for r in now.select("doc_id").collect()}, {r["doc_id"] for r in after.select("doc_id").collect()}
        assert ids <= before_ids and len(ids) > 0.6 * len(before_ids)
        if name == "near_duplicates":
            found = jaccard.near_duplicates(now).collect()
            assert ids == {r["component_id"] for r in found}
        if name == "decontamination":
            found = decontaminate.find_contamination(now, spark.read.parquet(f"{SF}/benchmark.parquet")).where(~decontaminate.is_contaminated())
            assert ids == {r["doc_id"] for r in found.collect()}
        if name == "secrets":
            assert ids == before_ids
            spans = {r["doc_id"]: r["spans"] for r in secrets.find_secrets(now).collect()}
            for r in after.collect():
                masks = 0
                text, end = "", 0
                for s in spans[r["doc_id"]]:
                    if s["start"] > end or (not masks and s["start"] == 0):
                        text += texts[r["doc_id"]][end : s["start"]] + "[REDACTED]"
                        masks += 1
                    end = max(end, s["end"])
                assert r["text"] == text + texts[r["doc_id"]][end:] and r["n_chars"] == len(r["text"])
        now = after
    out = {r["doc_id"]: r for r in corpus_pipeline.run(spark, SF).collect()}
    tokens = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks={t: i for i, t in enumerate(tokens)}, special_tokens={})
    last = {r["doc_id"]: r["text"] for r in now.collect()}
    assert set(out) == set(last)
    for i, text in last.items():
        ids = library.encode_ordinary(text)
        assert out[i]["n_tokens"] == len(ids) and out[i]["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_empty_and_odd_documents(spark):
    rows = [(1, None, "en", "s", 0), (2, "", "en", "s", 0), (None, "some words of a text", "en", None, None), (None, "some words of a text", "en", None, None)]
    docs = spark.createDataFrame(rows, spark.read.parquet(f"{SF}/documents.parquet").schema)
    for table in (docs, docs.limit(0)):
        now = table
        for _, stage in corpus_pipeline.STAGES[1:]:
            now = saved(stage(spark, now, SF), "odd")
        assert now.count() == (3 if table is docs else 0)
        assert now.where(F.col("n_tokens") < 0).count() == 0
