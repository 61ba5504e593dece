"""Queries that must not do the same work once a token or once a use."""

import pyarrow as pa

from pairloom.operators import encode, scoring
from pairloom.plans import catalog
from pairloom.sources import corpus

from conftest import SMALL


def test_vectors_are_looked_up_once_a_token_of_a_document(spark, monkeypatch):
    asked, real = [], scoring.embedding_lookup
    monkeypatch.setattr(scoring, "embedding_lookup", lambda tokens, vectors: asked.append(tokens.count()) or real(tokens, vectors))
    found = catalog.embedding_lookup(spark, SMALL).collect()
    assert asked[0] * 2 < sum(r["n_tokens"] for r in found)


def test_documents_are_encoded_once_to_be_scored(spark, monkeypatch):
    calls, real = [], encode.encode_documents
    monkeypatch.setattr(encode, "encode_documents", lambda *a, **k: calls.append(1) or real(*a, **k))
    assert catalog.score_documents(spark, SMALL).count() and len(calls) == 1


def test_invalid_bytes_are_dropped_slice_by_slice(monkeypatch):
    monkeypatch.setattr(corpus, "ROWS", 2)
    raw = pa.array([b"a\xff", None, b"\xe4\xb8", "é".encode() + b"\xc3", b""], pa.binary())
    assert corpus._without_invalid.func(raw).to_pylist() == ["a", None, "", "é", ""]
