"""Token counts and token files against the libraries, on odd texts and on a table."""

import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from riskloom.llm import queries
from riskloom.llm.perfect_hash import PerfectHash, fingerprint, key_hash
from riskloom.llm.token_counts import PieceCounter, count_tokens
from riskloom.llm.token_files import Encoder, Shard, read_token_files, write_token_files

SF = "/root/testdata/sf0.001"
MODEL, WORDS = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("word_bpe_49k.json")


def counted(rows, library):
    return Counter((r["doc_id"], len((r["text"] or "").encode()), len(library.encode(r["text"] or ""))) for r in rows)


@pytest.fixture(scope="module")
def pieces():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def test_counts_are_the_library_s(spark, odd_docs, no_docs, pieces):
    for docs in (odd_docs, spark.read.parquet(f"{SF}/documents.parquet")):
        got = count_tokens(docs, MODEL, 4096).collect()
        assert Counter((r.doc_id, r.n_bytes, r.n_tokens) for r in got) == counted(docs.collect(), pieces)
        assert all(r.over_limit == (r.n_tokens > 4096) for r in got)
    assert count_tokens(no_docs, MODEL, 4096).count() == 0


def test_counts_of_random_texts(pieces):
    random = np.random.default_rng(1)
    letters = list("ab  ▁\n\té<>s/0.") + ["你", "\U0001f600", "▁▁", "  "]
    texts = ["".join(random.choice(letters, random.integers(0, 40))) for _ in range(3000)]
    assert PieceCounter(MODEL).count(texts) == [len(pieces.encode(t)) for t in texts]


def expected_files(rows, library):
    out, start = Counter(), 0
    order = sorted(rows, key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, r["text"] is not None, (r["text"] or "").encode()))
    for r in order:
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids + [2]
        out[(r["doc_id"], start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))] += 1
        start += len(ids)
    return out


def test_files_hold_the_library_s_ids(spark, odd_docs, no_docs):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(WORDS)
    for docs in (odd_docs, spark.read.parquet(f"{SF}/documents.parquet")):
        got = read_token_files(write_token_files(docs, WORDS, end_id=2)).collect()
        assert Counter((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in got) == expected_files(docs.collect(), library)
    assert read_token_files(write_token_files(no_docs, WORDS, end_id=2)).count() == 0


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_encoder_on_random_texts(name):
    encoder = Encoder(public_tokenizers.path(name))
    assert encoder.by_word == (name == "word_bpe_49k.json")
    random = np.random.default_rng(2)
    letters = list("aZ'st  \n\té<|>.9\x1ć̱H \x85") + ["<|endoftext|>", "<|ENDOFTEXT|>", "<|StartOfText|>", "<|startoftext|>", "你", "İ", "Σ"]
    for _ in range(2000):
        text = "".join(random.choice(letters, random.integers(0, 30)))
        assert np.frombuffer(encoder.encode(text.encode()), encoder.dtype).tolist() == encoder._ids(text), repr(text)


def test_keyed_access_knows_strangers(spark):
    docs = spark.createDataFrame([(i * 7, f"text {i} of many") for i in range(500)], "doc_id long, text string").coalesce(1)
    row = write_token_files(docs, WORDS, end_id=2).filter("n_docs > 0").first()
    shard = Shard(row.path, row.width)
    own = shard.table["ids"]
    offsets, lengths = shard.locate(own, np.zeros(len(own)), np.zeros(len(own)))
    assert (offsets >= 0).all() and shard.read(int(offsets[3]), int(lengths[3]))[-1] == 2
    strange = np.arange(10_000, 20_000) * 7 + 1
    assert (shard.locate(strange, np.zeros(len(strange)), np.zeros(len(strange)))[0] >= 0).sum() <= 1


def test_perfect_hash_is_minimal():
    for n in (0, 1, 2, 63, 5000):
        hashes = key_hash(np.arange(n), np.zeros(n), np.zeros(n, bool))
        found = PerfectHash.build(hashes).find(hashes)
        assert sorted(found.tolist()) == list(range(n))
        assert len(fingerprint(hashes)) == n


def test_queries(spark):
    n = spark.read.parquet(f"{SF}/documents.parquet").count()
    assert queries.op2_token_files(spark, SF).count() == n
    assert queries.op5_token_counts(spark, SF).count() == n


def test_a_hot_id_fills_several_shards(spark):
    from tokenizers import Tokenizer

    rows = [(None if i % 2 else i, f"{chr(97 + i % 26)} text {i} <|ENDOFTEXT|>" if i % 6 else "the same text") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        manifest = write_token_files(docs, WORDS, end_id=2)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    got = read_token_files(manifest).collect()
    library = Tokenizer.from_file(WORDS)
    assert Counter((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in got) == expected_files(docs.collect(), library)
    assert max(r.n_docs for r in manifest.collect()) < 1000  # 1500 rows have no id
