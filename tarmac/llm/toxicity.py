"""Toxicity by a classifier chain.

Categories are predicted one after the other by linear (logistic) models; a
later model sees the earlier categories' probabilities.  In training those
probabilities come from models that did not see the row (out-of-fold, five
folds by a hash of the id), so the chain learns from the quality they have at
prediction time; the final models are fitted on all sampled rows.

Training uses at most about ``MAX_LABELLED`` labelled rows, chosen by a hash
of the id.  Word statistics over them select, per category, the ``WORDS``
words with the strongest association; the rest of the features are shares of
character classes and lengths.  Prediction reads every whole text.

Defined results: null texts and texts without a word have probability 0 and
are not flagged; without labelled rows of both classes a category has
probability 0 everywhere; labels that repeat an id count once (their
maximum); labels with a null category are not used; repeated rows are
answered each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.llm.common import kept_by_worker, table, whole_row
from tarmac.llm.hashing import LETTERS, text_chunks, word_hashes

MAX_LABELLED = 10_000
WORDS = 128
MIN_ROWS = 3  # rows a word must be in to be selected
FOLDS = 5
THRESHOLD = 0.5

_CLASS = np.full(256, 4, dtype=np.uint8)  # other signs
_CLASS[97:123] = _CLASS[128:] = 0
_CLASS[65:91] = 1
_CLASS[48:58] = 2
_CLASS[[32, 9, 10, 13]] = 3
_SIGNS = b"|#$%&*!?<>{}[]/\\@=+_"
_CLASS[list(_SIGNS)] = np.arange(5, 5 + len(_SIGNS))
N_CLASSES = 5 + len(_SIGNS)
SHARES = N_CLASSES + 2


def shares(texts: list[bytes], n_words: np.ndarray) -> np.ndarray:
    """Per text: square roots of the shares of character classes, log word count, mean word length."""
    out = np.zeros((len(texts), SHARES), dtype=np.float32)
    for i, t in enumerate(texts):
        c = np.bincount(_CLASS[np.frombuffer(t, dtype=np.uint8)], minlength=N_CLASSES)
        out[i, :N_CLASSES] = np.sqrt(c / max(1, len(t)))
        out[i, N_CLASSES] = np.log1p(n_words[i]) / 10
        out[i, N_CLASSES + 1] = min(1.0, (c[0] + c[1]) / max(1, n_words[i]) / 20)
    return out


def densities(hashes: np.ndarray, first: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Per text and selected word (sorted hashes): log of one plus occurrences per thousand words."""
    n = np.diff(first)
    out = np.zeros((len(n), len(words)), dtype=np.float32)
    if len(words) and len(hashes):
        at = np.minimum(np.searchsorted(words, hashes), len(words) - 1)
        hit = np.flatnonzero(words[at] == hashes)
        row = np.searchsorted(first, hit, side="right") - 1
        np.add.at(out, (row, at[hit]), 1)
    return np.log1p(out * (1000 / np.maximum(n, 1))[:, None]).astype(np.float32)


def features(texts: list[bytes], groups: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(features, word counts): per category the words' densities and their sum, then the shares."""
    h, first = word_hashes(texts, LETTERS)
    n = np.diff(first)
    parts = []
    for words in groups:
        d = densities(h, first, words)
        total = np.log1p(np.expm1(d).sum(axis=1, keepdims=True))
        parts += [d, total]
    return np.concatenate([*parts, shares(texts, n)], axis=1), n


def fit(x: np.ndarray, y: np.ndarray, l2: float = 1e-4, steps: int = 300) -> np.ndarray:
    """Weights (bias last) of a logistic model; both classes weigh as they are; accelerated gradient steps."""
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-3
    z = np.concatenate([(x - mean) / scale, np.ones((len(x), 1), dtype=np.float32)], axis=1).astype(np.float32)
    w = np.zeros(z.shape[1], dtype=np.float32)
    v, rate = w.copy(), 4.0 / max(1.0, float(np.linalg.eigvalsh((z.T @ z).astype(np.float64))[-1]) / len(z))
    for k in range(steps):
        g = z.T @ (1 / (1 + np.exp(-np.clip(z @ v, -30, 30))) - y).astype(np.float32) / len(z)
        g[:-1] += l2 * v[:-1]
        new = v - rate * g
        v, w = new + (k / (k + 3)) * (new - w), new
    w = w.astype(np.float64)
    w[:-1] /= scale
    w[-1] -= float(w[:-1] @ mean)
    return w


def probability(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x @ w[:-1] + w[-1], -30, 30)))


class Chain:
    def __init__(self, categories: list[str], groups: list[np.ndarray], weights: list[np.ndarray | None]):
        self.categories, self.groups, self.weights = categories, groups, weights

    def predict(self, texts: list[bytes]) -> np.ndarray:
        x, n = features(texts, self.groups)
        out = np.zeros((len(texts), len(self.categories)))
        for c, w in enumerate(self.weights):
            if w is not None:
                out[:, c] = probability(x, w)
            x = np.concatenate([x, out[:, c:c + 1]], axis=1)
        out[n == 0] = 0
        return out


def fit_chain(x: np.ndarray, labels: np.ndarray, folds: np.ndarray) -> list[np.ndarray | None]:
    """One model per column of ``labels``, in order."""
    out: list[np.ndarray | None] = []
    for c in range(labels.shape[1]):
        y, oof = labels[:, c], np.zeros(len(x), dtype=np.float32)
        both = 0 < y.sum() < len(y)
        out.append(fit(x, y) if both else None)
        for f in np.unique(folds) if both and c + 1 < labels.shape[1] else []:
            seen, held = folds != f, folds == f
            if 0 < y[seen].sum() < seen.sum():
                oof[held] = probability(x[held], fit(x[seen], y[seen]))
        x = np.concatenate([x, oof[:, None]], axis=1)
    return out


def sample_labels(labels: DataFrame, categories: dict[str, Column], id_col: str,
                  most: int = MAX_LABELLED) -> DataFrame:
    """(id, y array<double>): one row per labelled id, about ``most`` of them by a hash of the id."""
    rows = labels.filter(F.col(id_col).isNotNull()).select(
        F.col(id_col), *[c.cast("double").alias(f"_y{i}") for i, c in enumerate(categories.values())])
    names = [f"_y{i}" for i in range(len(categories))]
    rows = rows.dropna(subset=names).groupBy(id_col).agg(*[F.max(n).alias(n) for n in names])
    n = rows.count()
    if n > most:
        rows = rows.filter(F.pmod(F.xxhash64(id_col), F.lit(1_000_000)) < int(1_000_000 * most / n))
    return rows.select(id_col, F.array(*names).alias("_y"))


def _word_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task: (word, rows with it in all, per category), summed over the task's rows."""
    words, marks = [], []
    for batch in batches:
        ys = np.array(batch.column("_y").to_pylist()).reshape(batch.num_rows, -1)
        for start, texts in text_chunks(batch.column("text")):
            h, first = word_hashes(texts, LETTERS)
            row = np.repeat(np.arange(len(texts)), np.diff(first))
            order = np.lexsort((row, h))
            h, row = h[order], row[order]
            new = np.ones(len(h), dtype=bool)
            new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
            words.append(h[new])
            marks.append(np.concatenate([np.ones((new.sum(), 1)), ys[start + row[new]]], axis=1))
    if words:
        w, at = np.unique(np.concatenate(words), return_inverse=True)
        m = np.concatenate(marks)
        sums = [np.bincount(at, weights=m[:, c]) for c in range(m.shape[1])]
        for lo in range(0, len(w), 50_000):
            part = slice(lo, lo + 50_000)
            yield pa.RecordBatch.from_pydict({
                "word": pa.array(w[part].view(np.int64)), "rows": pa.array(sums[0][part].astype(np.int64)),
                "pos": pa.array([list(t) for t in zip(*[s[part].astype(np.int64).tolist() for s in sums[1:]])],
                                pa.list_(pa.int64()))})


def select_words(sample: DataFrame, totals: list[float], n: int, words: int = WORDS) -> list[np.ndarray]:
    """Per category the word hashes most associated with it, over all sampled rows."""
    counts = sample.select("text", "_y").mapInArrow(_word_rows, "word long, rows long, pos array<bigint>")
    sums = counts.groupBy("word").agg(
        F.sum("rows").alias("rows"), *[F.sum(F.get("pos", F.lit(c))).alias(f"p{c}") for c in range(len(totals))]
    ).filter(F.col("rows") >= MIN_ROWS)
    out = []
    for c, total in enumerate(totals):
        # standardised difference between rows seen and rows expected with the category
        expected = F.col("rows") * (total / max(1, n))
        z = (F.col(f"p{c}") - expected) / F.sqrt(expected * (1 - total / max(1, n)) + 0.5)
        top = sums.select("word", z.alias("z")).orderBy(F.col("z").desc(), "word").limit(words).collect()
        out.append(np.sort(np.array([r["word"] for r in top if r["z"] > 3], dtype=np.int64).view(np.uint64)))
    return out


def learn(docs: DataFrame, labels: DataFrame, categories: dict[str, Column], id_col: str = "doc_id",
          text_col: str = "text", most: int = MAX_LABELLED) -> Chain:
    """``categories``: name -> expression over the columns of ``labels`` (1 or 0), in chain order."""
    names = list(categories)
    ids = sample_labels(labels, categories, id_col, most)
    sample = (docs.select(F.col(id_col), F.col(text_col).alias("text")).filter("text IS NOT NULL")
              .join(F.broadcast(ids), id_col))  # about ``most`` ids, by parameter
    total = sample.agg(F.count(F.lit(1)).alias("n"), *[F.sum(F.get("_y", F.lit(c))).alias(f"y{c}") for c in range(len(names))]).first()
    if not total["n"]:
        return Chain(names, [np.zeros(0, dtype=np.uint64)] * len(names), [None] * len(names))
    groups = select_words(sample, [total[f"y{c}"] for c in range(len(names))], total["n"])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, texts in text_chunks(batch.column("text")):
                x, _ = features(texts, groups)
                part = batch.slice(start, len(texts))
                yield pa.RecordBatch.from_arrays(
                    [part.column("fold"), part.column("_y"), pa.array([v.tobytes() for v in x], pa.binary())],
                    names=["fold", "y", "x"])

    fold = F.pmod(F.xxhash64(id_col, F.lit(1)), F.lit(FOLDS)).cast("int").alias("fold")
    got = (sample.select(fold, "_y", "text").mapInArrow(rows, "fold int, y array<double>, x binary")
           .orderBy("fold", "x").toPandas())  # sample rows x features, bounded by the parameters
    x = np.stack([np.frombuffer(v, dtype=np.float32) for v in got["x"]])
    y = np.array(got["y"].tolist(), dtype=np.float32)
    return Chain(names, groups, fit_chain(x, y, got["fold"].to_numpy()))


def score(docs: DataFrame, chain: Chain, id_col: str = "doc_id", text_col: str = "text",
          threshold: float = THRESHOLD) -> DataFrame:
    """Id, ``p_<category>`` for each category, and ``<last category>`` boolean."""
    names = [f"p_{c}" for c in chain.categories]
    return _scored(docs.select(F.col(id_col), F.col(text_col).alias("_text")), chain, names, chain.categories[-1], threshold)


def kept(docs: DataFrame, chain: Chain, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns, that the last category does not flag."""
    d = docs.select(whole_row(docs), F.col(text_col).alias("_text"))
    names = [f"p{i}" for i in range(len(chain.categories))]
    return _scored(d, chain, names, "flag", threshold).filter("NOT flag").select("row.*")


def _scored(d: DataFrame, chain: Chain, names: list[str], flag: str, threshold: float) -> DataFrame:
    schema = d.drop("_text").schema
    for c in names:
        schema = schema.add(c, "double")
    schema = schema.add(flag, "boolean")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept_by_worker(None)
        for batch in batches:
            for start, texts in text_chunks(batch.column("_text")):
                p = chain.predict(texts)
                part = batch.slice(start, len(texts))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], *[pa.array(p[:, c]) for c in range(p.shape[1])], pa.array(p[:, -1] >= threshold)],
                    names=schema.names)

    return d.mapInArrow(run, schema)


def categories() -> dict[str, Column]:
    return {"low_quality": 1 - F.col("quality"), "toxic": F.col("toxic")}


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score(docs, learn(docs, table(spark, sf_dir, "labels"), categories()))
