"""Language identification with error-correcting output codes.

Every language has a codeword; bit b splits the languages in two, and a binary
n-gram classifier per bit (naive Bayes on hashed byte trigrams) predicts it.
Decoding is loss-weighted: the language whose codeword has the smallest sum
of exponential losses of the bits' margins, each bit weighted by how well it
separates the training data, wins; a close second flags the row ambiguous.

Learning reads every training row once: tasks count trigram buckets per
language, Spark sums them, and the driver receives ``BUCKETS`` x languages
numbers (at most ``MAX_LANGS`` languages, checked).  Codewords: all 2^(L-1)-1
splits up to five languages, beyond that splits drawn from a hash.

Features: text as UTF-8, A-Z lower-cased, runs of other ASCII characters as
one blank.  Only the text is an input of a prediction.  Defined results: null
texts and texts without a letter are ``und`` with score 0, as is every text
if nothing was learned; with one learned language all texts with a letter get
it with score 1; repeated rows are answered each.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.llm.common import table
from tarmac.llm.hashing import text_chunks

BUCKETS = 1 << 13
MAX_LANGS = 500
AMBIGUOUS = 0.1  # decoded probability lead below which a row is flagged
SHARPNESS = 12.0  # scale of the losses when they become probabilities
CHUNK = 1 << 21  # bytes per numpy step

# bytes to symbols: letters a-z 1..26, non-ASCII bytes 27..154, everything else 0
_SYMBOL = np.zeros(256, dtype=np.int32)
_SYMBOL[ord("a"):ord("z") + 1] = np.arange(1, 27)
_SYMBOL[ord("A"):ord("Z") + 1] = np.arange(1, 27)
_SYMBOL[128:] = np.arange(27, 155)


def trigrams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every trigram, and each text's first position in that array (with the end)."""
    raw = np.frombuffer(b"  ".join([b"", *texts, b""]), dtype=np.uint8)
    sym = _SYMBOL[raw]
    owner = np.concatenate([[0], np.cumsum(np.array([len(t) + 2 for t in texts], dtype=np.int64))]) + 1
    keep = np.ones(len(sym), dtype=bool)
    keep[1:] = (sym[1:] != 0) | (sym[:-1] != 0)
    at = np.concatenate([[0], np.cumsum(keep)])
    s = sym[keep].astype(np.uint32)
    if len(s) < 3:
        return np.zeros(0, dtype=np.int64), np.zeros(len(texts) + 1, dtype=np.int64)
    h = (s[:-2] * np.uint32(0x9E3779B1)) ^ (s[1:-1] * np.uint32(0x85EBCA77)) ^ (s[2:] * np.uint32(0xC2B2AE3D))
    h ^= h >> np.uint32(15)
    bucket = ((h * np.uint32(0x27D4EB2F)) >> np.uint32(19)).astype(np.int64)
    return bucket, np.minimum(at[np.minimum(owner, len(sym))], len(bucket))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task: (lang, bucket, n) of the trigrams of its rows."""
    sums: dict[str, np.ndarray] = {}
    for batch in batches:
        langs = batch.column("lang").to_pylist()
        for start, texts in text_chunks(batch.column("text"), CHUNK):
            bucket, first = trigrams(texts)
            own = np.array(langs[start:start + len(texts)], dtype=object)
            row = np.repeat(np.arange(len(texts)), np.diff(first))
            bucket = bucket[first[0]:first[-1]]
            for lang in set(own):
                n = np.bincount(bucket[(own == lang)[row]], minlength=BUCKETS)
                sums[lang] = sums.get(lang, 0) + n
    for lang, n in sums.items():
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_pydict({"lang": pa.array([lang] * len(at), pa.string()),
                                          "bucket": pa.array(at, pa.int32()), "n": pa.array(n[at], pa.int64())})


def codewords(langs: list[str]) -> np.ndarray:
    """(languages, bits) of +1 and -1; no bit is constant and no two bits are equal or opposite."""
    k = len(langs)
    if k <= 5:
        columns = [[1] + [1 if m >> i & 1 else -1 for i in range(k - 1)] for m in range((1 << (k - 1)) - 1)]
        return np.array(columns, dtype=np.float64).reshape(len(columns), k).T
    columns: dict[tuple, None] = {}
    seed = 0
    while len(columns) < 10 * int(np.ceil(np.log2(k))):
        bits = [1 if hashlib.sha256(f"{seed}:{lang}".encode()).digest()[0] & 1 else -1 for lang in langs]
        seed += 1
        if len(set(bits)) == 2:
            columns[tuple(b * bits[0] for b in bits)] = None
    return np.array(list(columns), dtype=np.float64).T


class Model:
    """Languages, codewords, and per bit the weights of the buckets and the bit's own weight."""

    def __init__(self, langs: list[str], counts: np.ndarray):
        self.langs, self.code = langs, codewords(langs)
        p = (counts + 0.5) / (counts + 0.5).sum(axis=1, keepdims=True)  # per language, so all weigh the same
        bits = self.code.shape[1]
        self.weights = np.zeros((BUCKETS, bits), dtype=np.float32, order="F")
        self.trust = np.ones(bits)
        for b in range(bits):
            one, two = p[self.code[:, b] > 0].mean(axis=0), p[self.code[:, b] < 0].mean(axis=0)
            w = np.log(one) - np.log(two)
            self.weights[:, b] = w
            # mean margin a trigram gives on the worst language: how well the bit separates
            self.trust[b] = max(1e-3, float(((p @ w) * self.code[:, b]).min()))
        self.trust /= self.trust.sum() or 1

    def predict(self, texts: list[bytes]) -> tuple[list[str], np.ndarray, np.ndarray]:
        bucket, first = trigrams(texts)
        n = np.diff(first)
        total = np.zeros((len(texts), self.weights.shape[1]))
        some = n > 0
        if some.any():
            for b in range(total.shape[1]):
                total[some, b] = np.add.reduceat(self.weights[:, b][bucket], first[:-1][some])[: some.sum()]
                # reduceat's last segment runs to the end of the array
                last = np.flatnonzero(some)[-1]
                total[last, b] = self.weights[:, b][bucket[first[last]:first[last + 1]]].sum()
        margin = total / np.maximum(n, 1)[:, None]
        loss = np.exp(-np.clip(margin[:, None, :] * self.code[None], -30, 30)) @ self.trust
        z = -SHARPNESS * (loss - loss.min(axis=1, keepdims=True))
        p = np.exp(z)
        p /= p.sum(axis=1, keepdims=True)
        best = p.argmax(axis=1)
        top = p[np.arange(len(texts)), best]
        p[np.arange(len(texts)), best] = 0
        lead = top - (p.max(axis=1) if p.shape[1] > 1 else 0)
        return [self.langs[i] for i in best], top, lead


def learn(training: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Model | None:
    rows = (training.filter(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull())
            .select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang")))
    sums = rows.mapInArrow(_count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    per = sums.groupBy("lang").agg(F.collect_list("bucket").alias("b"), F.collect_list("n").alias("n"))
    got = per.orderBy("lang").limit(MAX_LANGS + 1).collect()  # BUCKETS numbers a row
    if len(got) > MAX_LANGS:
        raise ValueError(f"more than {MAX_LANGS} languages")
    if not got:
        return None
    counts = np.zeros((len(got), BUCKETS))
    for i, r in enumerate(got):
        counts[i, r["b"]] = r["n"]
    return Model([r["lang"] for r in got], counts)


def identify(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text",
             carry: dict[str, Column] | None = None) -> DataFrame:
    """Per row: id, ``carry`` columns, lang_pred, score, ambiguous."""
    carry = carry or {}
    d = docs.select(F.col(id_col), *[c.alias(n) for n, c in carry.items()],
                    F.when(F.col(text_col).rlike(r"\p{L}"), F.col(text_col)).alias("_text"))
    schema = d.drop("_text").schema.add("lang_pred", "string").add("score", "double").add("ambiguous", "boolean")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            valid = batch.column("_text").is_valid().to_numpy(zero_copy_only=False)
            for start, texts in text_chunks(batch.column("_text"), CHUNK):
                if model is None:
                    langs, score, lead = ["und"] * len(texts), np.zeros(len(texts)), np.zeros(len(texts))
                else:
                    langs, score, lead = model.predict(texts)
                ok = valid[start:start + len(texts)]
                kept = batch.slice(start, len(texts))
                columns = [kept.column(c) for c in kept.schema.names if c != "_text"]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array([x if y else "und" for x, y in zip(langs, ok)], pa.string()),
                     pa.array(np.where(ok, score, 0.0), pa.float64()), pa.array(ok & (lead < AMBIGUOUS), pa.bool_())],
                    names=schema.names)

    return d.mapInArrow(run, schema)


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    # a null id has no checksum and is not held out
    held_out = F.coalesce(held_out, F.lit(False))
    return identify(docs, learn(docs.filter(~held_out)), carry={"held_out": held_out})
