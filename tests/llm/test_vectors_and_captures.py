"""Searches and captures against brute force, their edges, and the whole pipeline."""

import importlib
import re
from collections import defaultdict
from urllib.parse import urlsplit

import numpy as np
import pytest
from pyspark.sql import functions as F

import compare
from conftest import SMALL
from pairloom.llm import maxscore, neighbours, queries, warc

LARGER = SMALL.replace("0.001", "0.01")
NAN, INF = float("nan"), float("inf")


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(0, [1.0, 0.0, 0.0]), (1, [1.0, 0.0, 0.0]), (2, [1.0, 0.0, -0.0]), (3, [0.0, 2.0, 0.0]), (4, None), (5, [0.0, 0.0, 0.0]), (6, [NAN, 1.0, 1.0]),
            (7, [INF, 1.0, 1.0]), (8, [None, 1.0, 1.0]), (9, [1.0, 1.0]), (None, [1.0, 1.0, 1.0]), (10, [0.9, 0.1, 0.0])]
    return spark.createDataFrame([(*r, 1.0, 1) for r in rows], "vec_id long, embedding array<float>, score double, rank int")


def test_neighbours_recall_and_distances(spark):
    rows = spark.read.parquet(f"{LARGER}/embeddings.parquet").toPandas().sort_values("vec_id")
    ids, x = rows["vec_id"].to_numpy(), np.stack(rows["embedding"].to_numpy()).astype(float)
    found = neighbours.nearest(spark.read.parquet(f"{LARGER}/embeddings.parquet"), 10, F.col("vec_id") % 20 == 0).toPandas()
    hits = []
    for q, group in found.groupby("query_id"):
        apart = np.sqrt(((x - x[np.searchsorted(ids, q)]) ** 2).sum(axis=1))
        group = group.sort_values("rank")
        assert list(group["rank"]) == list(range(1, 11)) and q not in set(group["vec_id"])
        assert np.allclose(apart[np.searchsorted(ids, group["vec_id"])], group["score"], atol=1e-12) and (np.diff(group["score"]) >= 0).all()
        best = [i for i in np.lexsort((ids, apart)) if ids[i] != q][:10]
        hits.append(len(set(ids[best]) & set(group["vec_id"])) / 10)
    assert len(hits) == (ids % 20 == 0).sum() and np.mean(hits) >= 0.9


def test_neighbours_of_odd_rows(odd):
    got = defaultdict(list)
    for r in neighbours.nearest(odd, 2).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append(r["vec_id"])
    assert got[0] == [1, 2] and got[1] == [0, 2] and got[2] == [0, 1] and set(got) == {0, 1, 2, 3, 10} and got[10] == [0, 1]
    assert neighbours.nearest(odd.filter("false")).count() == 0


def test_many_copies_are_searched_once(spark):
    rows = [(i, [1.0, 2.0, 3.0] if i % 3 else [float(i), 1.0, 0.0]) for i in range(3000)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = neighbours.nearest(frame, 10, F.col("vec_id").isin(1, 2999)).collect()
    assert {(r["query_id"], r["vec_id"]) for r in found} == {(1, i) for i in (2, 4, 5, 7, 8, 10, 11, 13, 14, 16)} | {
        (2999, i) for i in (1, 2, 4, 5, 7, 8, 10, 11, 13, 14)}


def test_products_equal_sql(spark):
    query, sql = queries.QUERIES["op7_maxscore"], queries.ORACLE["op7_maxscore"]
    assert compare.difference(query(spark, LARGER), compare.connect(LARGER), sql) is None


def test_products_of_sparse_rows_with_ties():
    rng = np.random.default_rng(3)
    weights = rng.integers(-3, 4, (2500, 12)) * (rng.random((2500, 12)) < 0.3)
    ids = rng.permutation(2500)
    shard, order = maxscore.Shard(ids, weights), np.argsort(ids)
    for query in rng.integers(-3, 4, (40, 12)) * (rng.random((40, 12)) < 0.6):
        found, scores = shard.top(query, 20)
        full = (weights @ query)[order]
        best = np.lexsort((np.arange(2500), -full))[:20]
        assert list(found) == list(best) and list(scores) == list(full[best])


def test_products_of_odd_rows(odd):
    got = defaultdict(list)
    for r in maxscore.top_products(odd, 3).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    assert set(got) == {0, 1, 2, 3, 5, 9, 10} and got[0] == [(1, 4096), (2, 4096), (9, 4096)] and got[5] == [(0, 0), (1, 0), (2, 0)]
    assert maxscore.top_products(odd.filter("false")).count() == 0
    doubled = odd.filter("vec_id in (0, 3)").unionByName(odd.filter("vec_id = 3"))
    assert [(r["query_id"], r["vec_id"]) for r in maxscore.top_products(doubled, 5, F.col("vec_id") == 0).collect()] == [(0, 3), (0, 3)]


@pytest.mark.parametrize("kind", [np.float32, np.float64, np.int64])
def test_products_in_every_type_pass_rows_over(kind):
    """Exact in every type; few rows outlive the essential terms once the score to beat is known."""
    rng = np.random.default_rng(7)
    middles = rng.normal(size=(20, 32))
    weights = np.floor(16 * (middles[rng.integers(0, 20, 6000)] + 0.3 * rng.normal(size=(6000, 32)))).astype(np.int64)
    ids, queries = np.arange(6000), weights[::100]
    shard = maxscore.Shard(ids, weights, kind)
    query, row, score = shard.best(queries, 10, names=ids[::100])
    full = queries @ weights.T
    full[np.arange(60), ids[::100]] = maxscore.NEVER
    want = [np.lexsort((ids, -f))[:10] for f in full]
    assert list(row) == list(np.concatenate(want)) and list(score) == [full[q, r] for q, r in zip(query, row, strict=True)]
    assert shard.pairs == 60 * 6000 and shard.probed < 0.2 * shard.pairs
    again = maxscore.Shard(ids, weights, kind)
    goal = np.array([f[w[-1]] for f, w in zip(full, want, strict=True)])
    assert list(again.best(queries, 10, goal, ids[::100])[1]) == list(row) and again.probed < 0.05 * again.pairs


def test_products_over_many_shards(spark, monkeypatch):
    """Several shards and blocks, a third of all rows of one id, lengths that differ."""
    monkeypatch.setattr(maxscore, "SHARD", 40)
    monkeypatch.setattr(maxscore, "EARLY", 7)
    monkeypatch.setattr(maxscore, "QUERIES", 11)
    rng = np.random.default_rng(9)
    rows = [(int(i), [float(x) for x in rng.integers(-4, 5, rng.integers(0, 6))]) for i in [*range(1, 400), *[0] * 200]]
    got = defaultdict(list)
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    for r in maxscore.top_products(frame, 6, (F.col("vec_id") % 20 == 0) & (F.col("vec_id") > 0), 1).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((-r["score"], r["vec_id"]))
    vectors = dict(rows[:399])
    assert set(got) == {i for i in vectors if i % 20 == 0}
    for i, found in got.items():
        every = sorted((-int(sum(a * b for a, b in zip(vectors[i], v))), j) for j, v in rows if j != i)
        assert found == every[:6]


@pytest.mark.parametrize(
    "url,want",
    [("HTTP://WWW.Example.com:80/a/?b=2&a=1&utm_x=9#f", "http://example.com/a?a=1&b=2"), ("https://user:pw@h:443", "https://h/"),
     ("https://h:8443/", "https://h:8443/"), ("not a url", "not a url"), (None, None), ("", ""), ("http://h/p?", "http://h/p")],
)
def test_canonical_url(spark, url, want):
    frame = spark.createDataFrame([(url,)], "url string")
    assert frame.select(warc.canonical_url("url")).first()[0] == want


def plain_url(url):
    parts = urlsplit(url)
    query = "&".join(sorted(p for p in parts.query.split("&") if p and not p.lower().startswith("utm_")))
    path = parts.path if len(parts.path) <= 1 else parts.path.removesuffix("/")
    return f"{parts.scheme}://{parts.hostname.removeprefix('www.')}{path or '/'}" + (f"?{query}" if query else "")


def brute_revisits(rows):
    full, out = defaultdict(list), {}
    for r in rows:
        if r["kind"] == "response":
            full[plain_url(r["url"])].append(r)
    for r in rows:
        if r["kind"] != "revisit":
            continue
        earlier = [f for f in full[plain_url(r["url"])] if f["date"] < r["date"]]
        if not earlier:
            out[r["record_id"]] = ("no_original", None, None, None)
            continue
        old = max(earlier, key=lambda f: (f["date"], f["record_id"]))
        new_h, old_h = r["headers"], old["headers"]
        if "etag" in new_h and "etag" in old_h:
            kind, same = "etag", re.sub("^W/", "", new_h["etag"]) == re.sub("^W/", "", old_h["etag"])
        elif "last-modified" in new_h and "last-modified" in old_h:
            kind, same = "last-modified", new_h["last-modified"] == old_h["last-modified"]
        else:
            kind, same = "digest", r["digest"] == old["digest"]
        headers = old_h | {k: v for k, v in new_h.items() if k in warc.PERMITTED} if same else None
        out[r["record_id"]] = ("resolved" if same else "mismatch", old["record_id"], kind, headers)
    return out


@pytest.mark.parametrize("one_url", [False, True])
def test_revisits(spark, one_url):
    records = queries.captures(spark.read.parquet(f"{LARGER}/pages.parquet"))
    if one_url:  # every capture of one address, over many parts
        records = records.withColumn("url", F.lit("http://h/x"))
    got = {r["record_id"]: (r["outcome"], r["original_id"], r["validator"], r["headers"]) for r in warc.resolve_revisits(records).collect()}
    assert got == brute_revisits(records.collect()) and len(got) == records.count() // 2


def test_revisits_of_odd_rows(spark):
    kind = "record_id string, kind string, url string, date long, status int, headers map<string,string>, digest string, outcome string"
    rows = [("a", "response", "http://h/", 1, 200, {"etag": "1"}, "d", "c"), ("b", "response", "http://h/", 5, 404, {"etag": "2"}, "d", "c"),
            ("c", "revisit", "http://h", 5, 304, {"etag": "1"}, None, "c"), ("d", "revisit", None, 5, 304, None, None, "c"),
            ("e", "revisit", "http://h/", None, 304, None, None, "c"), ("f", "revisit", "http://h/", 9, 304, None, None, "c"),
            ("g", "revisit", "http://h/", 1, 304, {"etag": "1"}, None, "c"), ("c", "revisit", "http://h", 5, 304, {"etag": "1"}, None, "c"), (None, None, None, None, None, None, None, None)]
    frame = spark.createDataFrame(rows, kind)
    got = sorted((r["record_id"], r["outcome"]) for r in warc.resolve_revisits(frame).collect())
    assert got == [("c", "resolved"), ("c", "resolved"), ("d", "no_original"), ("e", "no_original"), ("f", "unchecked"), ("g", "no_original")]
    assert warc.resolve_revisits(frame.filter("false")).count() == 0
    payloads = spark.createDataFrame([("a", "body")], "record_id string, payload string")
    assert [r["payload"] for r in warc.with_payload(warc.resolve_revisits(frame), payloads).orderBy("record_id").collect()] == ["body", "body", None, None, None, None]


def test_pipeline_stage_by_stage(spark):
    """Each stage's decisions against their own definition, on what the stage before kept."""
    from test_copies import brute_survivors
    from test_text_operators import check_packed
    from tokenizers import Tokenizer

    pipeline = importlib.import_module("corpus_pipeline")
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    kept = {r["doc_id"] for r in queries.op2_weak_label_quality(spark, SMALL).filter("keep").collect()}
    good = pipeline.quality_stage(spark, docs, SMALL).cache()
    assert {r["doc_id"] for r in good.collect()} == kept and good.columns == docs.columns
    texts = [(r["doc_id"], r["text"]) for r in good.select("doc_id", "text").collect()]
    firsts = {texts[k][0] for k in brute_survivors(texts)}
    alone = pipeline.copies_stage(spark, good, SMALL).cache()
    assert {r["doc_id"] for r in alone.collect()} == firsts and alone.columns == docs.columns
    safe = pipeline.secrets_stage(spark, alone, SMALL).cache()
    assert safe.columns == docs.columns and safe.count() == alone.count()
    assert not safe.filter(F.col("text").rlike('(?i)token = "[0-9a-f]{40}"')).count()
    mixed = pipeline.mixing_stage(spark, safe, SMALL).cache()
    assert mixed.columns == docs.columns and mixed.exceptAll(safe).count() == 0
    known = Tokenizer.from_file(queries.vocabulary("byte_bpe_50k.json"))
    texts = {r["doc_id"]: r["text"] for r in mixed.collect()}
    rows = pipeline.packing_stage(spark, mixed, SMALL).collect()
    assert {r["doc_id"] for r in rows} == set(texts)
    check_packed(rows, 2048, lambda i: [*known.encode(texts[i], add_special_tokens=False).ids, 1])
    assert sorted(map(tuple, pipeline.run(spark, SMALL).select("doc_id", "start", "ids_crc32").collect())) == sorted((r["doc_id"], r["start"], r["ids_crc32"]) for r in rows)
