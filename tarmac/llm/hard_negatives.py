"""Hard-negative mining by Kronecker-packed products.

Components become integers, floor(256 * x).  A block of rows is stored as wide integers: for every dimension, the
components of several rows, made non-negative by a bias, stand in separated fields of one 64-bit word.  One
multiplication of a word with an anchor's (biased) component multiplies all its fields, and the sum over the dimensions
holds the rows' scores side by side: a field is as wide as the largest possible sum, so none runs into the next.  Taking
the fields apart and the biases off gives exact integer scores.  Where a sum needs more than 64 bits, Python's integers of
any width take the words' place, with as many fields in one.

A first pass finds every anchor's positives, a second one the negatives between its positives' bounds; each pass keeps
the best few of every (anchor, block) and ranks those.  Blocks of anchors meet blocks of rows by an equi-join on block
numbers, so a task holds one block of each.

Defined results: rows with a null id, a null label, a null vector or a null or non-finite component take no part; vectors
meet only vectors of their length; rows repeating an id are rows like any other, and only an anchor's own row is none of
its candidates; equal rows are stored once with their number, of which at most as many as can be returned are looked at;
ties go to the smaller id; a positive with no row in its bounds (always, where its score is negative) gives no rows;
components beyond a long saturate, as do scores; empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tarmac.llm.common import stored, table

SCALE = 256
POSITIVES, NEGATIVES = 5, 10
LOW, HIGH = 30, 90  # percent of the positive's score
BLOCK_ROWS = 8192
ANCHOR_BYTES = 1 << 21  # of the anchors' components in one block
WIDE_FIELDS = 64  # fields of one integer wider than a word
WORD = 64
LONG = (1 << 63) - 1

HITS = "anchor long, dim int, aid long, positive int, positive_id long, positive_score long, other_id long, score long"


class Fields(NamedTuple):
    """How components share a wide integer: value + bias, ``width`` bits each."""

    bias: int
    width: int

    @property
    def native(self) -> bool:
        return self.width <= WORD

    @property
    def count(self) -> int:
        return WORD // self.width if self.native else WIDE_FIELDS

    @classmethod
    def of(cls, low: int, high: int, dim: int) -> Fields:
        return cls(-low, max(1, ((high - low) ** 2 * dim).bit_length()))


def pack(values: np.ndarray, f: Fields) -> np.ndarray:
    """Integers (dimension, words) of a matrix (rows, dimension); row i is field i // words of word i % words."""
    rows, dim = values.shape
    words = -(-rows // f.count)
    kind = np.uint64 if f.native else object
    biased = np.full((words * f.count, dim), 0, dtype=kind)
    biased[:rows] = (values + f.bias).astype(kind) if f.native else values.astype(object) + f.bias
    out = np.zeros((dim, words), dtype=kind)
    for k in range(f.count):
        part = biased[k * words:(k + 1) * words].T
        out |= part << (np.uint64(k * f.width) if f.native else k * f.width)
    return out


def scores(anchor: np.ndarray, packed: np.ndarray, sums: np.ndarray, f: Fields) -> np.ndarray:
    """Exact inner products of one vector with all packed rows; ``sums`` are the rows' own component sums."""
    kind = np.uint64 if f.native else object
    biased = [int(a) + f.bias for a in anchor.tolist()]
    total = np.zeros(packed.shape[1], dtype=kind)
    for a, words in zip(biased, packed):
        if a:
            total += words * (np.uint64(a) if f.native else a)
    mask = (1 << f.width) - 1
    if f.native:
        parts = [(total >> np.uint64(k * f.width)) & np.uint64(mask) for k in range(f.count)]
    else:
        parts = [np.array([t >> k * f.width & mask for t in total.tolist()], dtype=object) for k in range(f.count)]
    raw = np.concatenate(parts)[:len(sums)]
    # sum (a + bias)(c + bias) = score + bias * sum(c) + bias * sum(a + bias)
    if f.native and f.width < 62:
        return raw.astype(np.int64) - f.bias * sums - f.bias * sum(biased)
    exact = raw.astype(object) - f.bias * sums.astype(object) - f.bias * sum(biased)
    return np.array([max(-LONG - 1, min(LONG, int(s))) for s in exact], dtype=np.int64)


def quantise(vectors: DataFrame, label: Column, id_col: str, vec_col: str, scale: int = SCALE) -> DataFrame:
    """(id, label, q array<long>, dim, n) of the valid rows, equal rows counted."""
    x = F.transform(vec_col, lambda v: v.cast("double"))
    ok = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return (vectors.filter(F.col(id_col).isNotNull() & label.isNotNull() & F.col(vec_col).isNotNull()).filter(ok)
            .select(F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"),
                    F.transform(x, lambda v: F.floor(v * scale)).alias("q"))
            .groupBy("id", "label", "q").agg(F.count(F.lit(1)).alias("n"))
            .withColumn("dim", F.size("q")).withColumn("key", F.xxhash64("id", "label", "q")))


def _matrix(column: pd.Series, dim: int) -> np.ndarray:
    return np.array(column.tolist(), dtype=np.int64).reshape(len(column), dim)


def _build(fields: dict[int, Fields]) -> Callable:
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("id")  # stable selections then take the smaller id
        dim = int(pdf["dim"].iloc[0])
        values = _matrix(pdf["q"], dim)
        f = fields[dim]
        packed = pack(values, f)
        words = packed.tobytes() if f.native else b"".join(int(v).to_bytes(-(-f.width * f.count // 8), "little") for v in packed.ravel())
        sums = values.sum(1) if f.native else np.array([0] * len(values))
        wide = values.astype("<i8").tobytes() if not f.native else b""
        return pd.DataFrame([(dim, int(pdf["block"].iloc[0]), len(pdf), pdf["id"].to_numpy("<i8").tobytes(),
                              pdf["label"].to_numpy("<i8").tobytes(), sums.astype("<i8").tobytes(), words, wide)],
                            columns=["dim", "block", "rows", "ids", "labels", "sums", "words", "wide"])

    return run


INDEX = "dim int, block int, rows int, ids binary, labels binary, sums binary, words binary, wide binary"


def _unpacked(r, f: Fields) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(ids, labels, component sums, packed words) of a stored block."""
    ids, labels = np.frombuffer(r.ids, dtype="<i8"), np.frombuffer(r.labels, dtype="<i8")
    words = -(-int(r.rows) // f.count)
    if f.native:
        return ids, labels, np.frombuffer(r.sums, dtype="<i8"), np.frombuffer(r.words, dtype="<u8").reshape(int(r.dim), words)
    size = -(-f.width * f.count // 8)
    packed = np.array([int.from_bytes(r.words[i:i + size], "little") for i in range(0, len(r.words), size)], dtype=object)
    wide = np.frombuffer(r.wide, dtype="<i8").reshape(int(r.rows), int(r.dim)).astype(object)
    return ids, labels, wide.sum(1) if wide.size else np.zeros(len(ids), dtype=object), packed.reshape(int(r.dim), words)


def best(score: np.ndarray, allowed: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest scores among the allowed ones; rows stand by id, so ties go to the smaller."""
    at = np.flatnonzero(allowed)
    if len(at) > k:
        bound = np.partition(score[at], len(at) - k)[len(at) - k]
        over = at[score[at] > bound]
        at = np.concatenate([over, at[score[at] == bound][:k - len(over)]])
    return at


def bounds(positive: int, low: int = LOW, high: int = HIGH) -> tuple[int, int]:
    """Least and greatest score of a hard negative: low * p <= 100 * s <= high * p."""
    return -(-low * positive // 100), high * positive // 100


def _mine(fields: dict[int, Fields], k: int, low: int, high: int, negatives: bool) -> Callable:
    """Best candidates of every anchor in every block: positives, or negatives of each of its positives."""

    def one(a, dim: int, block: int, held) -> Iterator[tuple]:
        ids, labels, sums, packed = held
        s = scores(np.asarray(a["q"], dtype=np.int64), packed, sums, fields[dim])
        same = labels == a["label"]
        if negatives:
            for i, (pid, ps) in enumerate(zip(a["positive_ids"], a["positive_scores"])):
                least, most = bounds(int(ps), low, high)
                for at in best(s, ~same & (s >= least) & (s <= most), k).tolist():
                    yield a["key"], dim, a["id"], i, int(pid), int(ps), int(ids[at]), int(s[at])
            return
        if a["block"] == block:  # one of the rows that equal the anchor is the anchor
            own = np.flatnonzero(same & (ids == a["id"]) & (s == a["self"]))
            same[own[:1]] = False
        for at in best(s, same, k).tolist():
            yield a["key"], dim, a["id"], 0, None, None, int(ids[at]), int(s[at])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for r in pdf.itertuples(index=False):
                held = _unpacked(r, fields[int(r.dim)])
                found = [h for a in r.anchors for h in one(a, int(r.dim), int(r.block), held)]
                out = pd.DataFrame(found, columns=[c.split()[0] for c in HITS.split(", ")])
                yield out.astype({"positive_id": "Int64", "positive_score": "Int64"})

    return run


def _ranked(hits: DataFrame, by: list[str], k: int) -> DataFrame:
    w = Window.partitionBy(*by).orderBy(F.col("score").desc(), "other_id")
    return hits.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def hard_negatives(vectors: DataFrame, is_anchor: Column, label: Column, positives: int = POSITIVES, negatives: int = NEGATIVES,
                   low: int = LOW, high: int = HIGH, id_col: str = "vec_id", vec_col: str = "embedding",
                   block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Rows (anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``is_anchor`` is a column expression on ``id``, ``label`` one on the table.
    """
    spark = vectors.sparkSession
    rows = stored(quantise(vectors, label, id_col, vec_col), "negatives-rows")
    facts = rows.groupBy("dim").agg(F.min(F.array_min("q")).alias("low"), F.max(F.array_max("q")).alias("high"),
                                    F.count(F.lit(1)).alias("n"), F.count(F.when(is_anchor, 1)).alias("anchors")).collect()
    facts = [r for r in facts if r["anchors"]]
    fields = {r["dim"]: Fields.of(r["low"] or 0, r["high"] or 0, r["dim"]) for r in facts}
    looked_at = max(positives, negatives) + 1
    n = max((r["n"] for r in facts), default=0)
    blocks = max(1, -(-n // block_rows))
    widest = max((r["dim"] for r in facts), default=1)
    lanes = max([1, *(-(-r["anchors"] * 8 * max(1, r["dim"]) // ANCHOR_BYTES) for r in facts)])
    rows = rows.filter(F.col("dim").isin([*fields])) if facts else rows.limit(0)
    rows = rows.withColumn("block", F.pmod("key", F.lit(blocks)).cast("int"))
    each = rows.withColumn("copy", F.explode(F.sequence(F.lit(1), F.least("n", F.lit(looked_at)).cast("int"))))
    index = stored(each.select("dim", "block", "id", "label", "q").groupBy("dim", "block").applyInPandas(_build(fields), INDEX),
                   "negatives-index")
    anchors = rows.filter(is_anchor).select("key", "dim", "id", "label", "q", "n", "block")
    anchors = anchors.withColumn("self", F.aggregate("q", F.lit(0).cast("decimal(38,0)"), lambda s, v: (s + v.cast("decimal(19,0)") * v).cast("decimal(38,0)")))
    most = F.lit(LONG).cast("decimal(38,0)")
    anchors = anchors.withColumn("self", F.least("self", most).cast("long"))
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(blocks * lanes, 20_000))

    def met(asked: DataFrame, *more: str) -> DataFrame:
        """Every block of rows with every block of anchors (an array of structs)."""
        lane = F.pmod(F.xxhash64("key", "id"), F.lit(lanes)).cast("int").alias("lane")
        grouped = asked.select("dim", lane, F.struct("key", "id", "label", "q", "block", "self", *more).alias("a"))
        grouped = grouped.groupBy("dim", "lane").agg(F.collect_list("a").alias("anchors"))
        right = grouped.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
        left = index.withColumn("lane", F.explode(F.sequence(F.lit(0), F.lit(lanes - 1))))
        return (left.repartition(tasks, "dim", "block", "lane").join(right.repartition(tasks, "dim", "block", "lane"), ["dim", "block", "lane"]))

    first = met(anchors).mapInPandas(_mine(fields, positives, low, high, False), HITS)
    found = _ranked(first, ["anchor", "dim", "aid"], positives)
    found = stored(found.groupBy(F.col("anchor").alias("key"), "dim", F.col("aid").alias("id"))
                   .agg(F.sort_array(F.collect_list(F.struct("rank", "other_id", "score"))).alias("p"))
                   .select("key", "dim", "id", F.col("p.other_id").alias("positive_ids"), F.col("p.score").alias("positive_scores")),
                   "negatives-positives")
    asked = anchors.join(found, ["key", "dim", "id"])
    second = met(asked, "positive_ids", "positive_scores").mapInPandas(_mine(fields, negatives, low, high, True), HITS)
    ranked = _ranked(second, ["anchor", "dim", "aid", "positive"], negatives)
    copies = anchors.select(F.col("key").alias("anchor"), "dim", F.col("id").alias("aid"), "n")
    return (ranked.join(copies, ["anchor", "dim", "aid"]).withColumn("_", F.explode(F.sequence(F.lit(1).cast("long"), "n")))
            .select(F.col("aid").alias("anchor_id"), "positive_id", "rank", F.col("other_id").alias("negative_id"),
                    "positive_score", F.col("score").alias("negative_score")))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Anchors are the rows with ids divisible by 100; ids divisible by 7 carry the next label."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0, label)


SQL = """
WITH v AS (
  SELECT *, row_number() OVER (ORDER BY vec_id, label, q) AS r
  FROM (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)
), s AS (
  SELECT a.r AS ar, a.vec_id AS anchor_id, b.r AS br, b.vec_id, a.label = b.label AS same,
         CAST(coalesce(list_sum(list_transform(list_zip(a.q, b.q), lambda z: z[1] * z[2])), 0) AS BIGINT) AS score
  FROM v a JOIN v b ON a.r <> b.r AND len(a.q) = len(b.q) WHERE a.vec_id % 100 = 0
), p AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY ar ORDER BY score DESC, vec_id, br) AS k FROM s WHERE same) WHERE k <= 5
), n AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.ar, p.k ORDER BY s.score DESC, s.vec_id, s.br) AS rank
  FROM p JOIN s ON p.ar = s.ar AND NOT s.same AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score
)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10
"""
