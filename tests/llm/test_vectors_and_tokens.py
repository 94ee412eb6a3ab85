"""Whitening, hard negatives and byte-level BPE on small fixtures with every edge case, against brute force."""

import base64
import hashlib
import random

import duckdb
import numpy as np
import pandas as pd
import public_tokenizers
import pytest
import regex
import tiktoken

from tarmac.llm import byte_bpe, hard_negatives, whitening

from .conftest import edge_rows

VECTORS = "vec_id long, embedding array<float>, label int, id string, x string, dim string"


def vector_rows(n: int = 320, dim: int = 12):
    """Clustered vectors with null, NaN and infinite entries, null ids and labels, equal rows and repeated ids."""
    rng = np.random.default_rng(7)
    centres = rng.standard_normal((4, dim))
    rows = [(i, [float(v) for v in (centres[i % 4] + rng.standard_normal(dim) * 0.4) / 4], i % 4) for i in range(n)]
    v = rows[0][1]
    rows += [(0, v, 0), (0, v, 0), (100, rows[5][1], 0), (100, v, 2), (200, None, 1), (7, [*v[:-1], None], 1), (None, v, 1),
             (300, v, None), (8, [*v[:-1], float("nan")], 0), (9, [*v[:-1], float("-inf")], 0), (4, [-c for c in v], 3)]
    return [(*r, "id", "x", "dim") for r in rows]


def good(v) -> bool:
    return v is not None and all(c is not None and np.isfinite(c) for c in v)


@pytest.mark.parametrize("kind", ["random", "rank", "equal", "zero", "graded", "multiple"])
def test_bidiagonal_solver_equals_lapack(kind):
    rng = np.random.default_rng(2)
    for d in [1, 2, 3, 8, 33, 64]:
        a = {"random": rng.standard_normal((90, d)), "rank": rng.standard_normal((90, 1)) @ rng.standard_normal((1, d)),
             "equal": np.ones((90, d)), "zero": np.zeros((90, d)), "graded": rng.standard_normal((90, d)) * 10.0 ** -np.arange(d),
             "multiple": np.concatenate([np.eye(d) * 3] * 2)}[kind]
        r = np.linalg.qr(np.concatenate([a, np.zeros((d, d))]), mode="r")
        diagonal, above, p = whitening.bidiagonalise(r)
        want = np.linalg.svd(a, compute_uv=False) ** 2
        want = np.concatenate([want, np.zeros(d)])[:d]
        assert np.allclose(whitening.squared_singular_values(diagonal, above), want, rtol=1e-10, atol=1e-14 * want[0])
        values, vectors, trace = whitening.principal(r, 8)
        assert np.abs(vectors.T @ vectors - np.eye(min(8, d))).max() < 1e-12
        assert np.abs(a.T @ (a @ vectors) - vectors * values).max() <= 1e-12 * max(want[0], 1e-300)
        assert np.isclose(trace, want.sum())


def test_whitening_equals_numpy_on_usable_rows(spark, monkeypatch):
    monkeypatch.setattr(whitening, "STACK_BYTES", 1)  # factors are stacked two by two, in several rounds
    rows = vector_rows()
    got = whitening.whiten(spark.createDataFrame(rows, VECTORS).repartition(9), 5).toPandas()
    kept = [(i, v) for i, v, *_ in rows if good(v)]
    x = np.floor(1024 * np.array([v for _, v in kept], dtype=np.float32).astype(float)).astype(np.int64) + 100000
    n, total = len(x), x.sum(0)
    c = x - x.mean(0)
    values, vectors = np.linalg.eigh(c.T @ c / n)
    values, vectors = values[::-1][:5], vectors[:, ::-1][:, :5]
    want = c @ vectors / np.sqrt(values)
    assert len(got) == 5 * n and set(got["n"]) == {n} and got["identity_error"].nunique() == 1 and got["identity_error"].max() < 1e-9
    assert np.allclose(got.drop_duplicates("component").sort_values("component")["explained"], values / np.trace(c.T @ c / n), rtol=1e-9)
    dev = ((n * x - total) ** 2).sum(1)
    assert sorted(zip(map(int, got["deviation"]), got["component"])) == sorted((int(d), k) for d in dev for k in range(1, 6))
    for k in range(5):
        mine = got[got["component"] == k + 1].sort_values(["deviation", "whitened"])
        sign = np.sign(np.dot(mine.groupby("deviation")["whitened"].first(), pd.Series(want[:, k], index=dev).groupby(level=0).first()))
        assert np.allclose(np.sort(mine["whitened"] * sign), np.sort(want[:, k]), atol=1e-9)


def test_whitening_edges(spark):
    def run(rows):
        df = spark.createDataFrame([(*r, "", "", "") for r in rows], VECTORS)
        return sorted((tuple(r) for r in whitening.whiten(df, 8).collect()), key=str)

    assert run([]) == [] and run([(1, None, 0), (2, [], 0)]) == []
    equal = run([(1, [0.5, 0.25], 0), (2, [0.5, 0.25], 0)])
    assert len(equal) == 4 and all(r[4] is None and r[5] == 0 and r[6] == 0 and r[3] == 0 for r in equal)
    lengths = run([(1, [0.5], 0), (2, [1.5], 0), (None, [0.0, 1.0], 0), (4, [1.0, 0.0], 0), (5, [3e38, -3e38], 0)])
    assert [(r[0], r[1], r[2]) for r in lengths if r[0] in (1, 2)] == [(1, 1, 2), (2, 1, 2)]
    assert all(abs(abs(r[4]) - 1) < 1e-12 for r in lengths if r[0] in (1, 2))
    assert sum(r[0] is None for r in lengths) == 2 and {r[2] for r in lengths if r[0] == 5} == {3}


def brute_negatives(rows):
    kept = [(i, (lb + 1) % 10 if i % 7 == 0 else lb, [int(np.floor(256 * float(np.float32(c)))) for c in v])
            for i, v, lb, *_ in rows if i is not None and lb is not None and good(v)]
    out = []
    for at, (aid, label, a) in enumerate(kept):
        if aid % 100:
            continue
        others = [(-sum(p * q for p, q in zip(a, c)), i, lb) for k, (i, lb, c) in enumerate(kept) if k != at and len(c) == len(a)]
        for ps, pid, _ in sorted(o for o in others if o[2] == label)[:5]:
            hard = sorted(o for o in others if o[2] != label and 30 * -ps <= 100 * -o[0] <= 90 * -ps)[:10]
            out += [(aid, pid, k, i, -ps, -s) for k, (s, i, _) in enumerate(hard, 1)]
    return sorted(out)


def mined(spark, rows, **more):
    from pyspark.sql import functions as F

    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    df = spark.createDataFrame(rows, VECTORS)
    return sorted(map(tuple, hard_negatives.hard_negatives(df, F.col("id") % 100 == 0, label, **more).collect()))


def test_hard_negatives_equal_brute_force_and_sql(spark, monkeypatch):
    rows = vector_rows()
    want = brute_negatives(rows)
    assert want and mined(spark, rows) == want
    monkeypatch.setattr(hard_negatives, "ANCHOR_BYTES", 100)
    assert mined(spark, rows, block_rows=50) == want
    frame = pd.DataFrame([r[:3] for r in rows], columns=["vec_id", "embedding", "label"])
    db = duckdb.connect()
    db.register("frame", frame)
    db.execute("CREATE VIEW embeddings AS SELECT CAST(vec_id AS BIGINT) AS vec_id, CAST(embedding AS FLOAT[]) AS embedding, CAST(label AS INTEGER) AS label FROM frame")
    frame_rows = [(None if pd.isna(i) else int(i), v, lb) for i, v, lb in zip(frame["vec_id"], frame["embedding"], frame["label"])]
    assert len(frame_rows) == len(rows)
    assert sorted(db.sql(hard_negatives.SQL).fetchall()) == want


def test_hard_negatives_edges(spark):
    assert mined(spark, []) == [] and mined(spark, [(100, None, 1, "", "", "")]) == []
    many = [(100, [1.0, 0.5], 1, "", "", "")] * 40 + [(3, [0.5, 0.5], 2, "", "", "")] * 30 + [(5, [], 1, "", "", ""), (400, [1.0], 1, "", "", "")]
    assert mined(spark, many) == brute_negatives(many)
    assert mined(spark, [(100, [3e38, 1.0], 1, "", "", ""), (1, [3e38, 1.0], 1, "", "", ""), (2, [1.0, 3e38], 2, "", "", "")]) is not None


@pytest.mark.parametrize("big", [3, 300, 1 << 20, 1 << 33])
def test_packed_fields_give_exact_scores(big):
    rng = np.random.default_rng(3)
    for _ in range(20):
        d, n = int(rng.integers(1, 9)), int(rng.integers(1, 40))
        v = rng.integers(-big, big, (n, d))
        f = hard_negatives.Fields.of(int(v.min()), int(v.max()), d)
        want = [max(-1 << 63, min((1 << 63) - 1, sum(int(a) * int(b) for a, b in zip(r, v[0])))) for r in v]
        assert hard_negatives.scores(v[0], hard_negatives.pack(v, f), v.sum(1), f).tolist() == want


def reference(path):
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def ranks():
    return public_tokenizers.path(byte_bpe.RANKS)


def random_texts(seed: int, n: int, longest: int):
    rnd = random.Random(seed)
    alphabets = ["ab", "abc ", "\n\t  ", "aA1!\U0001f600", "日本語中文", "ก้าวไกล", "αβγ", "é ß", "acgt", "'s're'LL"]
    return ["".join(rnd.choice(rnd.choice(alphabets)) for _ in range(rnd.randint(0, longest))) for _ in range(n)]


def test_byte_bpe_equals_the_library(ranks):
    vocab, want, cut = byte_bpe.Vocabulary(ranks), reference(ranks), regex.compile(public_tokenizers.PATTERN)
    rnd = random.Random(1)
    texts = random_texts(5, 400, 300) + ["", "a" * 3000, " " * 3001 + "x", "ab" * 2000, "日本" * 1500, "\n" * 900, "1" * 700,
                                         "".join(rnd.choice("acgt") for _ in range(9000)), "".join(rnd.choice("日本語中文字化一是不了人我") for _ in range(5000))]
    for text, ids in zip(texts, vocab.encode(texts, cut)):
        assert ids.tolist() == want.encode_ordinary(text)
        assert vocab.decode(ids.tolist()) == text.encode()
    assert all(len(p) <= byte_bpe.CACHE_BYTES for p in vocab.cache)


def test_byte_bpe_with_ranks_in_any_order(tmp_path):
    rnd = random.Random(2)
    more = list({bytes(rnd.choice(b"abc") for _ in range(rnd.randint(2, 5))) for _ in range(150)})
    rnd.shuffle(more)
    path = tmp_path / "odd.tiktoken"
    path.write_bytes(b"".join(base64.b64encode(t) + b" %d\n" % i for i, t in enumerate([bytes([b]) for b in range(256)] + more)))
    vocab, want, cut = byte_bpe.Vocabulary(str(path)), reference(path), regex.compile(public_tokenizers.PATTERN)
    texts = ["".join(rnd.choice("abc") for _ in range(rnd.choice([5, 20, 90, 250, 600, 1500]))) for _ in range(300)]
    assert [i.tolist() for i in vocab.encode(texts, cut)] == [want.encode_ordinary(t) for t in texts]


def test_byte_bpe_on_documents(spark, docs, no_docs, ranks, tmp, monkeypatch):
    monkeypatch.setattr(byte_bpe, "SLICE_PIECES", 500)  # long texts go in slices
    want = reference(ranks)
    got = byte_bpe.decode(byte_bpe.encode(docs)).collect()
    rows = [(i, want.encode_ordinary(t or ""), (t or "").encode()) for i, t, *_ in edge_rows()]
    assert sorted(((r["doc_id"], r["ids"], bytes(r["decoded"])) for r in got), key=str) == sorted(rows, key=str)
    assert byte_bpe.encode(no_docs).collect() == []
    odd = spark.createDataFrame([(1, None), (2, []), (3, [99999999]), (4, [-1])], "decoded_from long, ids array<int>")
    assert [(r[0], None if r[2] is None else bytes(r[2])) for r in sorted(byte_bpe.decode(odd).collect())] == [(1, None), (2, b""), (3, None), (4, None)]
    docs.select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{tmp}/bpe/documents.parquet")
    rows = byte_bpe.op13_byte_bpe(spark, f"{tmp}/bpe").collect()
    sha = lambda b: hashlib.sha256(b).hexdigest()
    assert sorted((tuple(r) for r in rows), key=str) == sorted(
        ((i, len(want.encode_ordinary(t or "")), sha(" ".join(map(str, want.encode_ordinary(t or ""))).encode()), sha((t or "").encode()))
         for i, t, *_ in edge_rows()), key=str)
