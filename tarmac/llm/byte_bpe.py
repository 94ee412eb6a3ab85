"""Byte-level BPE encoding and decoding with rank files, on length-bucketed padded matrices.

A text is cut into the matches of a pattern.  Distinct matches that a worker has not met yet are put, by their length in
bytes, into padded matrices of token ids (at first single bytes).  Each round looks the ranks of a matrix's new
neighbouring pairs up in a hash table; every row merges its leftmost pair of least rank and closes the gap (compaction),
and rows without a ranked pair are finished and leave.  A match that is a token itself needs no merges.

A match longer than ``LONG_BYTES`` is first cut where no token of the vocabulary can stand across (no token holds the
bytes around the cut).  What is still longer merges, in one row, all its pairs of least rank in a round, from the left;
wherever that could differ from one merge after the other (a merge makes a pair of lower rank) only the merges up to
there are done.  So texts and matches may have any length.

Defined results: a null text is empty and has no ids; null ids decode to null, and so do ids outside the vocabulary;
repeated rows are encoded each; an empty table gives no rows.  Bytes that are no UTF-8 become U+FFFD before encoding.
A worker keeps the ids of at most ``CACHE_PIECES`` matches.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from tarmac.llm.common import kept_by_worker, table

RANKS = "byte_bpe_50k.tiktoken"
CACHE_PIECES = 300_000
CACHE_BYTES = 64
LONG_BYTES = 256
CELLS = 1 << 18  # of one matrix
SLICE_PIECES = 100_000  # matches held at a time
PAD = np.int64((1 << 31) - 1)  # no token, and no rank
SPREAD = np.uint64(0x9E3779B97F4A7C15)


class PairTable:
    """Hash table (open addressing) from a pair of token ids to the rank of their joined bytes."""

    def __init__(self, left: np.ndarray, right: np.ndarray, rank: np.ndarray):
        bits = max(4, int(2 * len(rank)).bit_length())
        self._shift, self._mask = np.uint64(64 - bits), np.int64((1 << bits) - 1)
        self._keys = np.full(1 << bits, -1, dtype=np.int64)
        self._ranks = np.full(1 << bits, PAD, dtype=np.int64)
        keys = left << 32 | right
        at, todo = self._slot(keys), np.arange(len(keys))
        while len(todo):
            free = todo[self._keys[at[todo]] < 0]
            self._keys[at[free]] = keys[free]  # of several in one slot the last one stays
            self._ranks[at[free]] = rank[free]
            todo = todo[self._keys[at[todo]] != keys[todo]]
            at[todo] = (at[todo] + 1) & self._mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * SPREAD) >> self._shift).astype(np.int64)

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left << 32 | right
        at = self._slot(keys)
        held = self._keys[at]
        out = np.where(held == keys, self._ranks[at], PAD)
        miss = (held != keys) & (held >= 0)
        while miss.any():
            where = np.nonzero(miss)
            slot = (at[where] + 1) & self._mask
            at[where], held = slot, self._keys[slot]
            out[where] = np.where(held == keys[where], self._ranks[slot], PAD)
            miss[where] = (held != keys[where]) & (held >= 0)
        return out


class Vocabulary:
    """A rank file: bytes of every token, pair ranks, and where tokens can stand across two bytes."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f) if a}
        self.tokens = [None] * (max(self.ranks.values(), default=-1) + 1)
        for t, r in self.ranks.items():
            self.tokens[r] = t
        self.single = np.array([self.ranks[bytes([b])] for b in range(256)], dtype=np.int64)
        splits = [(self.ranks[t[:k]], self.ranks[t[k:]], r) for t, r in self.ranks.items()
                  for k in range(1, len(t)) if t[:k] in self.ranks and t[k:] in self.ranks]
        self.pair = PairTable(*np.array(splits, dtype=np.int64).reshape(-1, 3).T)
        self._two = np.zeros(1 << 16, dtype=bool)
        self._three = np.zeros(1 << 24, dtype=bool)
        for t in self.ranks:
            if len(t) == 2:
                self._two[int.from_bytes(t, "big")] = True
            for k in range(len(t) - 2):
                self._three[int.from_bytes(t[k:k + 3], "big")] = True
        self.whole = {t: r.to_bytes(4, "little") for t, r in self.ranks.items()}
        self.cache: dict[str, bytes] = {}  # ids as little-endian 32-bit integers
        self._once: list[str] = []

    # -- matches to ids

    def _spanned(self, raw: np.ndarray) -> np.ndarray:
        """For every place between two bytes: whether a token may stand across it."""
        wide = raw.astype(np.int64)
        across = self._two[wide[:-1] << 8 | wide[1:]]
        if len(raw) > 2:
            three = self._three[wide[:-2] << 16 | wide[1:-1] << 8 | wide[2:]]
            across[:-1] |= three
            across[1:] |= three
        return across

    def merge_rows(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merged ids of the rows of a padded matrix, one row after the other, and how many each has."""
        rows, sizes, flat = [], [], []
        row = np.arange(len(ids))
        ranks = self.pair(ids[:, :-1], ids[:, 1:])
        while len(ids):
            n, width = ids.shape
            at = ranks.argmin(axis=1) if width > 1 else np.zeros(n, dtype=np.int64)
            least = ranks[np.arange(n), at] if width > 1 else np.full(n, PAD)
            over = least == PAD
            if over.any():
                done = ids[over]
                real = done != PAD
                rows.append(row[over])
                sizes.append(real.sum(axis=1))
                flat.append(done[real])
                ids, ranks, row, at, least = ids[~over], ranks[~over], row[~over], at[~over], least[~over]
                n = len(ids)
                if not n:
                    break
            each = np.arange(n)
            keep = np.ones((n, width), dtype=bool)
            keep[each, at + 1] = False
            ids[each, at] = least
            ids = ids[keep].reshape(n, width - 1)  # compaction: the merged right half goes
            kept = np.ones((n, width - 1), dtype=bool)
            kept[each, at] = False
            ranks = ranks[kept].reshape(n, width - 2)
            left, right = at > 0, at < width - 2
            ranks[each[left], at[left] - 1] = self.pair(ids[each[left], at[left] - 1], ids[each[left], at[left]])
            ranks[each[right], at[right]] = self.pair(ids[each[right], at[right]], ids[each[right], at[right] + 1])
        row, size = np.concatenate(rows), np.concatenate(sizes)
        back = np.argsort(row)
        starts = (np.cumsum(size) - size)[back]
        size = size[back]
        place = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        return np.concatenate(flat)[np.repeat(starts, size) + place], size

    def merge_long(self, ids: np.ndarray) -> np.ndarray:
        """Merged ids of one long row: all pairs of least rank in a round, as far as that equals single merges."""
        ranks = self.pair(ids[:-1], ids[1:])
        while len(ranks) and (least := ranks.min()) != PAD:
            hits = np.flatnonzero(ranks == least)
            run = np.diff(hits, prepend=-2) != 1
            place = np.arange(len(hits)) - np.maximum.accumulate(np.where(run, np.arange(len(hits)), 0))
            hits = hits[place % 2 == 0]  # of pairs that overlap the left one merges
            before = ids[np.maximum(hits - 1, 0)]
            joined = np.diff(hits, prepend=-3) == 2
            before = np.where(joined, least, before)
            after = ids[np.minimum(hits + 2, len(ids) - 1)]
            lower = (hits > 0) & (self.pair(before, np.full_like(before, least)) <= least)
            lower |= (hits + 2 < len(ids)) & (self.pair(np.full_like(after, least), after) <= least)
            if lower.any():
                hits = hits[:int(lower.argmax()) + 1]
            keep = np.ones(len(ids), dtype=bool)
            keep[hits + 1] = False
            ids[hits] = least
            ids = ids[keep]
            at = hits - np.arange(len(hits))
            ranks = self._reranked(ranks, keep, ids, at)
        return ids

    def _reranked(self, ranks: np.ndarray, keep: np.ndarray, ids: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Pair ranks after a compaction; only the pairs beside the merged places ``at`` are looked up."""
        ranks = np.append(ranks, PAD)[keep][:-1]  # a pair goes with its left half
        for first in (at[at > 0] - 1, at[at < len(ids) - 1]):
            ranks[first] = self.pair(ids[first], ids[first + 1])
        return ranks

    def merged(self, pieces: list[bytes], whole: bool = True) -> list[bytes]:
        """Ids of every match, as little-endian 32-bit integers; with ``whole`` a match that is a token stands for itself."""
        out = [b""] * len(pieces)
        buckets: dict[int, list[int]] = {}
        for i, p in enumerate(pieces):
            token = self.whole.get(p) if whole else None
            if token is not None:
                out[i] = token
            elif len(p) > LONG_BYTES:
                out[i] = self._long(p)
            elif p:
                buckets.setdefault((len(p) - 1).bit_length(), []).append(i)
        for bucket, rows in buckets.items():
            step = max(1, CELLS >> bucket)
            for lo in range(0, len(rows), step):
                part = rows[lo:lo + step]
                lengths = np.array([len(pieces[i]) for i in part])
                ids = np.full((len(part), int(lengths.max())), PAD, dtype=np.int64)
                raw = np.frombuffer(b"".join([pieces[i] for i in part]), dtype=np.uint8)
                ids[np.arange(ids.shape[1]) < lengths[:, None]] = self.single[raw]
                flat, size = self.merge_rows(ids)
                data, end = flat.astype("<i4").tobytes(), 0
                for i, k in zip(part, (4 * size).tolist()):
                    out[i] = data[end:end + k]
                    end += k
        return out

    def _long(self, piece: bytes) -> bytes:
        raw = np.frombuffer(piece, dtype=np.uint8)
        ends = np.concatenate([np.flatnonzero(~self._spanned(raw)) + 1, [len(raw)]]).tolist()
        parts, lo = [], 0
        for hi in ends:
            parts.append((lo, hi))
            lo = hi
        distinct = list(dict.fromkeys(piece[a:b] for a, b in parts if b - a <= LONG_BYTES))
        short = dict(zip(distinct, self.merged(distinct, whole=False)))
        return b"".join(short[piece[a:b]] if b - a <= LONG_BYTES else self.merge_long(self.single[raw[a:b]]).astype("<i4").tobytes()
                        for a, b in parts)

    # -- texts

    def learn(self, pieces: set[str]) -> None:
        """Put the ids of matches not met yet into the cache."""
        new = [p for p in pieces if p not in self.cache]
        self.cache.update(zip(new, self.merged([p.encode() for p in new])))
        self._once += [p for p in new if len(p) > CACHE_BYTES]

    def trim(self) -> None:
        for p in self._once:
            del self.cache[p]
        self._once = []
        if len(self.cache) > CACHE_PIECES:  # matches met early are the frequent ones
            self.cache = dict(islice(self.cache.items(), CACHE_PIECES // 2))

    def encode(self, texts: list[str], pattern) -> Iterator[np.ndarray]:
        """Ids of every text; at most ``SLICE_PIECES`` matches of long texts are held at a time."""
        for group in _groups(texts):
            short = [pattern.findall(t) if len(t) <= SLICE_PIECES else None for t in group]
            self.learn(set(chain.from_iterable(p for p in short if p)))
            done = [None if p is None else np.frombuffer(b"".join(map(self.cache.__getitem__, p)), dtype="<i4") for p in short]
            self.trim()
            for text, ids in zip(group, done):
                yield self._encode_long(text, pattern) if ids is None else ids

    def _encode_long(self, text: str, pattern) -> np.ndarray:
        found, out = (m.group() for m in pattern.finditer(text)), []
        while pieces := list(islice(found, SLICE_PIECES)):
            self.learn(set(pieces))
            out.append(np.frombuffer(b"".join(map(self.cache.__getitem__, pieces)), dtype="<i4"))
            self.trim()
        return np.concatenate(out) if out else np.zeros(0, dtype=np.int32)

    def decode(self, ids: list[int]) -> bytes | None:
        if ids and (min(ids) < 0 or max(ids) >= len(self.tokens)):
            return None
        try:
            return b"".join(map(self.tokens.__getitem__, ids))
        except TypeError:  # a rank without a token
            return None


def _groups(texts: list[str]) -> Iterator[list[str]]:
    """Texts in groups of at most 256 and about ``SLICE_PIECES`` characters times four."""
    group: list[str] = []
    size = 0
    for t in texts:
        group.append(t)
        size += len(t)
        if len(group) == 256 or size >= 4 * SLICE_PIECES:
            yield group
            group, size = [], 0
    if group:
        yield group


def vocabulary(path: str) -> Vocabulary:
    """The worker's tables of a rank file."""
    return kept_by_worker(f"bytes {path}", lambda: Vocabulary(path))


def _place(path: str | None) -> str:
    import public_tokenizers

    return path or public_tokenizers.path(RANKS)


def encode(docs: DataFrame, path: str | None = None, pattern: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id, ids array<int>)."""
    d = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    schema = StructType([d.schema["_id"], *StructType.fromDDL("ids array<int>").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import public_tokenizers
        import regex

        vocab, cut = vocabulary(_place(path)), regex.compile(pattern or public_tokenizers.PATTERN)
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                texts = [t.decode("utf-8", "replace") for t in part.column("_text").cast(pa.large_binary()).to_pylist()]
                ids = list(vocab.encode(texts, cut))
                ends = np.concatenate([[0], np.cumsum([len(i) for i in ids])]).astype(np.int32)
                flat = pa.array(np.concatenate(ids) if ids else np.zeros(0, dtype=np.int32))
                yield pa.RecordBatch.from_arrays([part.column("_id"), pa.ListArray.from_arrays(pa.array(ends), flat)], names=schema.names)

    return d.mapInArrow(run, schema).withColumnRenamed("_id", id_col)


def decode(encoded: DataFrame, path: str | None = None, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """The rows with a further column of the decoded bytes."""
    schema = StructType([*encoded.schema.fields, StructField(out_col, BinaryType())])
    place = len(encoded.columns)
    at = encoded.columns.index(ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(_place(path))
        for batch in batches:
            for lo in range(0, batch.num_rows, 64):
                part = batch.slice(lo, 64)
                raw = [None if ids is None else vocab.decode(ids) for ids in part.column(at).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns[:place], pa.array(raw, pa.binary())], names=schema.names)

    return encoded.mapInArrow(run, schema)


def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = encode(table(spark, sf_dir, "documents"))
    digests = decode(encoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                                    F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"), "ids"))
    return digests.select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))
