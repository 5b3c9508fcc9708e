"""The segmentation against a search over the whole text, and exact round trips."""

import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from riskloom.llm import queries, unigram

SF = "/root/testdata/sf0.001"
MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def pieces():
    return unigram.Pieces(MODEL)


def whole(pieces, text):
    """The best score of a text by one search from its start to its end."""
    s = " " + text
    best = [0] + [None] * len(s)
    for i in range(len(s)):
        for size in range(1, min(pieces.longest, len(s) - i) + 1):
            hit = pieces.pieces.get(s[i : i + size])
            if hit is None and size > 1:
                continue
            score = hit[1] if hit else pieces.byte_score * len(s[i].encode())
            if best[i + size] is None or best[i] + score > best[i + size]:
                best[i + size] = best[i] + score
    return best[-1] if text else 0


def scored(pieces, ids):
    score = {i: s for i, s in pieces.pieces.values()}
    return sum(score.get(i, pieces.byte_score) for i in np.frombuffer(ids, "<i4").tolist())


def texts(n, size):
    rng = random.Random(6)
    letters = list("etaoin  srh.\n▁é0") + ["你", "\U0001f600", "   ", "ing", "tion"]
    return ["".join(rng.choice(letters) for _ in range(rng.randrange(size))) for _ in range(n)]


def test_best_and_round_trip(pieces):
    for text in texts(300, 60) + ["", " ", "  a", "a  ", "▁"]:
        ids = pieces.encode(text)
        assert pieces.decode(ids) == text and scored(pieces, ids) == whole(pieces, text)


@pytest.mark.parametrize("chunk", [1, 5, 16, 17, 40])
def test_chunks(pieces, chunk):
    for text in texts(80, 150) + ["a" * 90, " " * 50, "ab" * 40]:
        s = " " + text
        parts = [s[k : k + chunk + pieces.longest] for k in range(0, len(s), chunk)]
        ends = [min(len(s) - k, chunk) for k in range(0, len(s), chunk)]
        at = unigram.states([pieces.matrix(p, e) for p, e in zip(parts, ends)])
        if chunk < pieces.longest:
            # a piece may reach over several short chunks: states only, no chunk holds its trace
            continue
        ids = b"".join(pieces.between(p, b, e + f) for p, e, b, f in zip(parts, ends, at, at[1:]))
        if text:
            assert pieces.decode(ids) == text and scored(pieces, ids) == whole(pieces, text)


def test_products_are_associative():
    rng = np.random.default_rng(0)
    a, b, c = (np.where(rng.random((6, 6)) < 0.3, unigram.NONE, rng.integers(-99, 0, (6, 6))) for _ in range(3))
    assert (unigram.combine(unigram.combine(a, b), c) == unigram.combine(a, unigram.combine(b, c))).all()


@pytest.mark.parametrize("chunk", [unigram.CHUNK, 64])
def test_documents(spark, odd_docs, no_docs, pieces, monkeypatch, chunk):
    monkeypatch.setattr(unigram, "CHUNK", chunk)
    for docs in (odd_docs, spark.read.parquet(f"{SF}/documents.parquet")):
        encoded = unigram.encode(docs, MODEL)
        rows = encoded.collect()
        score = Counter((r.doc_id, pieces.decode(bytes(r.ids)), scored(pieces, bytes(r.ids))) for r in rows)
        assert score == Counter((r["doc_id"], r["text"] or "", whole(pieces, r["text"] or "")) for r in docs.collect())
        assert Counter(map(tuple, unigram.decode(encoded, MODEL).collect())) == Counter((r["doc_id"], r["text"] or "") for r in docs.collect())
        assert all(r.decoded for r in unigram.digests(docs, MODEL).collect())
    assert unigram.encode(no_docs, MODEL).count() == 0


def test_query(spark, pieces):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = queries.op7_sentence_pieces(spark, SF).collect()
    assert len(rows) == len(docs) and all(r.decoded for r in rows)
    for r in rows:
        if len(docs[r.doc_id]) < unigram.CHUNK:
            ids = pieces.encode(docs[r.doc_id])
            assert (r.n_pieces, r.ids_crc32) == (len(ids) // 4, zlib.crc32(ids))
