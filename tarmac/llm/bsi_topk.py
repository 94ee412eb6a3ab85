"""Exact top-k inner-product search on a bit-sliced index.

Components become integers, floor(256 * x).  Rows are dealt into blocks of
about ``BLOCK_ROWS``; a block stores, per attribute (dimension) and bit, one
bitmap over its rows (the values' offset from the block's minimum, so slices
are unsigned).  A query's score over a block is built by bitmap arithmetic:
the query's component is written in signed binary digits, each digit adds the
attribute's slices (or their complements, for a negative digit) at its
weight, and carry-save adders reduce all slices of a weight to one.  The
result is the bit-sliced score, off by a constant per query and block.

The k best rows are then taken from the most significant slice downward: rows
with a one are kept as long as they are at most k; otherwise the candidates
shrink to them.  Rows still undecided after the last slice tie at the
boundary and are resolved exactly, by smaller vec_id.  Each (query, block)
sends at most k rows on; a rank per query over those gives the answer.

Blocks of queries meet blocks of rows by an equi-join on block numbers, so a
task holds one block of each, whatever the table's size.

Defined results: null vectors and vectors with null or non-finite components
take no part; vectors meet only vectors of equal length; rows repeating a
vec_id are rows like any other, and only a query's own row is no candidate of
it; equal rows are stored once with their number, of which at most k + 1 are
looked at, and a query row that occurs several times is answered as often;
null ids take no part; fewer than k candidates give all of them; empty tables
give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from tarmac.llm.common import stored, table

SCALE = 256
K = 5
BLOCK_ROWS = 8192
QUERY_BYTES = 1 << 21  # of the queries' components in one block

INDEX = "dim int, block int, rows int, bits int, low long, ids binary, slices binary"
HITS = "query long, query_id long, vec_id long, score long"


def _pack(bits: np.ndarray) -> np.ndarray:
    """Boolean (..., rows) to bitmaps of 64-bit words (..., words)."""
    n = bits.shape[-1]
    wide = np.zeros(bits.shape[:-1] + (-(-n // 64) * 64,), dtype=bool)
    wide[..., :n] = bits
    return np.packbits(wide, axis=-1, bitorder="little").view("<u8")


def _set_bits(bitmap: np.ndarray, most: int | None = None) -> np.ndarray:
    at = np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))
    return at if most is None else at[:most]


def build_block(pdf: pd.DataFrame) -> pd.DataFrame:
    """One block of rows (dim, block, id, q) to its bit slices; ids ascend."""
    pdf = pdf.sort_values("id")
    dim = int(pdf["dim"].iloc[0])
    values = np.array(pdf["q"].tolist(), dtype=np.int64).reshape(len(pdf), dim)
    low = int(values.min()) if values.size else 0
    up = values - low
    bits = max(1, int(up.max()).bit_length()) if values.size else 1
    slices = np.stack([_pack(((up >> b) & 1).T.astype(bool)) for b in range(bits)], axis=1)
    return pd.DataFrame([(dim, int(pdf["block"].iloc[0]), len(pdf), bits, low,
                          pdf["id"].to_numpy("<i8").tobytes(), slices.tobytes())],
                        columns=["dim", "block", "rows", "bits", "low", "ids", "slices"])


def _digits(q: int) -> list[tuple[int, int]]:
    """Signed binary digits (weight, +1 or -1) of ``q`` without two neighbours, so few additions."""
    out, w = [], 0
    while q:
        if q & 1:
            d = 2 - (q & 3)
            out.append((w, d))
            q -= d
        q >>= 1
        w += 1
    return out


def score_slices(query: np.ndarray, slices: np.ndarray, low: int) -> tuple[list[np.ndarray], int]:
    """Bit slices of the scores, least significant first, and the constant to add to them."""
    _, bits, words = slices.shape
    by_weight: dict[int, list[np.ndarray]] = {}
    const = 0
    for d, q in enumerate(query.tolist()):
        const += q * low
        for w, sign in _digits(q):
            part = slices[d] if sign > 0 else ~slices[d]
            if sign < 0:  # -u = ~u - (2^bits - 1)
                const -= ((1 << bits) - 1) << w
            for b in range(bits):
                by_weight.setdefault(w + b, []).append(part[b])
    out, w = [], 0
    while any(k >= w for k in by_weight):
        level = by_weight.pop(w, [])
        acc = np.array(level, dtype="<u8").reshape(len(level), words)
        while len(acc) > 1:
            if len(acc) == 2:
                acc = np.concatenate([acc, np.zeros((1, words), dtype="<u8")])
            t = len(acc) // 3 * 3
            a, b, c, rest = acc[0:t:3], acc[1:t:3], acc[2:t:3], acc[t:]
            x = a ^ b
            by_weight.setdefault(w + 1, []).extend((a & b) | (c & x))
            acc = np.concatenate([x ^ c, rest])
        out.append(acc[0] if len(acc) else np.zeros(words, dtype="<u8"))
        w += 1
    return out, const


def _ones(bitmap: np.ndarray) -> int:
    return int(np.bitwise_count(bitmap).sum())


def top_rows(score: list[np.ndarray], allowed: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k rows with the highest scores; boundary ties go to the lowest positions."""
    sure, maybe = np.zeros_like(allowed), allowed
    n_sure = 0
    for s in reversed(score):
        ones = maybe & s
        n = _ones(ones)
        if n_sure + n > k:
            maybe = ones
        else:
            sure, n_sure, maybe = sure | ones, n_sure + n, maybe & ~s
    return np.concatenate([_set_bits(sure), _set_bits(maybe, k - n_sure)])


def _value(score: list[np.ndarray], at: int) -> int:
    return sum(int(s[at >> 6] >> np.uint64(at & 63) & np.uint64(1)) << w for w, s in enumerate(score))


def search_block(query_ids: np.ndarray, queries: np.ndarray, inside: np.ndarray, ids: np.ndarray, slices: np.ndarray,
                 low: int, k: int) -> Iterator[tuple[int, int, int]]:
    """(number of the query, id, score) of the best rows of a block; ``inside`` tells which queries are rows of it."""
    everyone = _pack(np.ones(len(ids), dtype=bool))
    for i, (qid, q, own) in enumerate(zip(query_ids.tolist(), queries, inside.tolist())):
        allowed = everyone
        score, const = score_slices(q, slices, low)
        if own:  # one of the rows with the query's id and its score by itself is the query
            self_score = sum(v * v for v in q.tolist()) - const
            for at in range(*np.searchsorted(ids, [qid, qid + 1]).tolist()):
                if _value(score, at) == self_score:
                    allowed = everyone.copy()
                    allowed[at >> 6] &= ~np.uint64(1 << (at & 63))
                    break
        for at in top_rows(score, allowed, k).tolist():
            yield i, int(ids[at]), _value(score, at) + const


def _search(k: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for r in pdf.itertuples(index=False):
                slices = np.frombuffer(r.slices, dtype="<u8").reshape(r.dim, r.bits, -(-r.rows // 64))
                keys, qids = np.frombuffer(r.keys, dtype="<i8"), np.frombuffer(r.query_ids, dtype="<i8")
                inside = np.frombuffer(r.own, dtype="<i8") == r.block
                hits = search_block(qids, np.frombuffer(r.queries, dtype="<i8").reshape(len(qids), r.dim), inside,
                                    np.frombuffer(r.ids, dtype="<i8"), slices, int(r.low), k)
                yield pd.DataFrame([(int(keys[i]), int(qids[i]), at, s) for i, at, s in hits],
                                   columns=["query", "query_id", "vec_id", "score"])

    return run


ASKED = "dim int, qblock int, keys binary, query_ids binary, own binary, queries binary"


def _query_block(pdf: pd.DataFrame) -> pd.DataFrame:
    dim = int(pdf["dim"].iloc[0])
    numbers = [pdf[c].to_numpy("<i8").tobytes() for c in ("key", "id", "block")]
    return pd.DataFrame([(dim, int(pdf["qblock"].iloc[0]), *numbers, np.array(pdf["q"].tolist(), dtype="<i8").reshape(len(pdf), dim).tobytes())],
                        columns=["dim", "qblock", "keys", "query_ids", "own", "queries"])


def quantise(vectors: DataFrame, id_col: str, vec_col: str, scale: int = SCALE) -> DataFrame:
    """(id, q array<long>, dim, n, key) of the valid vectors, equal rows counted."""
    x = F.transform(vec_col, lambda v: v.cast("double"))
    ok = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return (
        vectors.filter(F.col(id_col).isNotNull() & F.col(vec_col).isNotNull()).filter(ok)
        .select(F.col(id_col).cast("long").alias("id"), F.transform(x, lambda v: F.floor(v * scale).cast("long")).alias("q"))
        .groupBy("id", "q").agg(F.count(F.lit(1)).alias("n"))
        .withColumn("dim", F.size("q")).withColumn("key", F.xxhash64("id", "q"))
    )


def topk(vectors: DataFrame, is_query, k: int = K, id_col: str = "vec_id", vec_col: str = "embedding",
         block_rows: int = BLOCK_ROWS, query_bytes: int = QUERY_BYTES) -> DataFrame:
    """Rows (query_id, rank, vec_id, score); ``is_query`` is a column expression on ``id``."""
    spark = vectors.sparkSession
    q = stored(quantise(vectors, id_col, vec_col), "bsi-rows")
    n, nq, size = q.agg(F.count(F.lit(1)), F.count(F.when(is_query, 1)), F.sum(F.when(is_query, 8 * F.col("dim")))).first()
    blocks = max(1, -(-n // block_rows))
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # as few query blocks as memory allows, as the index is sent to each; a small index is not left to a few tasks
    qblocks = max(1, -(-(size or 0) // query_bytes), min(-(-partitions // blocks), nq))
    q = q.withColumn("block", F.pmod("key", F.lit(blocks)).cast("int"))
    copies = F.explode(F.sequence(F.lit(1), F.least("n", F.lit(k + 1)).cast("int")))
    index = q.withColumn("copy", copies).select("dim", "block", "id", "q").groupBy("dim", "block").applyInPandas(build_block, INDEX)
    asked = (q.filter(is_query).withColumn("qblock", F.pmod(F.xxhash64("key"), F.lit(qblocks)).cast("int"))
             .select("dim", "qblock", "key", "id", "block", "q").groupBy("dim", "qblock").applyInPandas(_query_block, ASKED))
    index = stored(index, "bsi-index")
    tasks = max(partitions, min(blocks * qblocks, 20_000))
    left = index.withColumn("qblock", F.explode(F.sequence(F.lit(0), F.lit(qblocks - 1)))).repartition(tasks, "dim", "block", "qblock")
    right = asked.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).repartition(tasks, "dim", "block", "qblock")
    hits = left.join(right, ["dim", "block", "qblock"]).mapInPandas(_search(k), HITS)
    w = Window.partitionBy("query", "query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = hits.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
    asked_often = q.filter(is_query).select(F.col("key").alias("query"), F.col("id").alias("query_id"), "n")
    return (ranked.join(asked_often, ["query", "query_id"]).withColumn("_", F.explode(F.sequence(F.lit(1).cast("long"), "n")))
            .select("query_id", "rank", "vec_id", "score"))


def op2_bsi_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0)


SQL = """
WITH v AS (
  SELECT *, row_number() OVER (ORDER BY vec_id, q) AS r
  FROM (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)
), s AS (
  SELECT a.r AS ar, a.vec_id AS query_id, b.r AS br, b.vec_id,
         CAST(coalesce(list_sum(list_transform(list_zip(a.q, b.q), lambda z: z[1] * z[2])), 0) AS BIGINT) AS score
  FROM v a JOIN v b ON a.r <> b.r AND len(a.q) = len(b.q) WHERE a.vec_id % 50 = 0
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY ar ORDER BY score DESC, vec_id, br) AS rank FROM s) WHERE rank <= 5
"""
