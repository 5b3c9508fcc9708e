"""The pipeline against the stages' brute-force versions, one after the other."""

from collections import Counter

import numpy as np
import public_tokenizers
from test_ngram_join import brute_force as groups
from test_suffix_dedup import brute_force as cuts

import corpus_pipeline
from riskloom.llm import mixing, toxicity, unigram

SF = "/root/testdata/sf0.001"


def test_stages_return_documents(spark, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, docs, SF).columns == docs.columns
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "ngram_join", "suffix_dedup", "mixing", "sentence_pieces"]


def test_run(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    index = toxicity.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    toxic = {r.doc_id for r in toxicity.score(docs, index).collect() if r.predicted}
    rows = [r.asDict() for r in docs.collect() if r.doc_id not in toxic]
    keep = {c for _, _, c in groups(rows, 5, 80)}
    rows = [r for r in rows if r["doc_id"] in keep]
    gone = {d: n for d, n, removed, _, _ in cuts(rows, 100) if removed}
    seen, left = set(), []
    for r in sorted(rows, key=lambda r: r["doc_id"]):
        text = r["text"].encode()
        out = bytearray(len(text))
        for i in range(len(text) - 99):
            s = text[i : i + 100]
            if s in seen:
                out[i : i + 100] = b"\1" * 100
            seen.add(s)
        rest = bytes(b for b, g in zip(text, out) if not g).decode("utf-8", "ignore")
        if r["doc_id"] not in gone or rest:
            left.append((r["doc_id"], rest, r["lang"], r["source"], len(rest)))
    frame = spark.createDataFrame(left, docs.schema)
    pieces = unigram.Pieces(public_tokenizers.path("piece_bpe_32k.model"))
    expected = Counter()
    texts = {r[0]: r[1] for r in left}
    for r in mixing.mix(frame).collect():
        expected[r.doc_id, len(pieces.encode(texts[r.doc_id])) // 4] += int(r.taken / r.size + 0.5) if r.size else 1
    got = corpus_pipeline.run(spark, SF).collect()
    assert Counter((r.doc_id, r.n_pieces) for r in got) == +expected
    assert all(r.decoded for r in got) and np.all([r.ids_crc32 >= 0 for r in got])
