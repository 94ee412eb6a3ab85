"""Sequence packing: non-negative least squares on the histogram of piece lengths.

Texts become token ids (and one closing id).  Whole windows are cut off first;
of the rest, half a window is cut off where it fits, so every other piece is
shorter than half a window.  Lengths below ``FINE`` tokens count as they are,
longer ones are rounded up to ``STEP`` tokens, so rounding costs a few percent
of a window at most, whatever the lengths.  Shallow combinations of these sizes
that fill a window (three sizes, or copies of one and a filler) are the
columns of a matrix; solving it against the histogram with non-negative least
squares gives how often to use each.  Repeats are rounded down, and the few
pieces left are packed greedily, largest first, on counts.  The histogram has
at most ``FINE + WINDOW / STEP`` numbers, which is all the driver sees.

A piece's place follows from its rank among the pieces of its length: ranks
are cut into stretches, one per use of the length in a combination.

Sequences are padded to the window unless their length is a power of two.
Defined results: a null text is empty and gives the closing id alone;
repeated rows are packed each, pieces of one id and start in the order of their
length and checksum; an empty table gives no rows; a word's ids do
not depend on its neighbours (the tokenizer drops white space), so words and
their parts are encoded once per worker and cached, at most ``CACHE_WORDS`` of
them between two stretches of text.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from bisect import bisect_right
from codecs import charmap_decode
from collections.abc import Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tarmac.llm.common import bucketed_rank, kept_by_worker, stored, table

WINDOW = 4096
STEP = 16
FINE = 256  # tokens; shorter pieces are not rounded
END_ID = 2
CACHE_WORDS = 400_000
CACHE_CHARS = 48
TOKENIZER = "word_bpe_49k.json"
CLOSE = "</w>"  # written behind a part's last token in the vocabulary
STRETCH = 1 << 21  # bytes of text encoded at once
GAP = re.compile("[ \t\n\r]")

# Latin-1 bytes: lower case with white space as spaces, and the kinds the tokenizer's pattern tells apart
LOWER = bytes(32 if b in b"\t\n\v\f\r \x85\xa0" else ord(chr(b).lower()) for b in range(256))
SPACE, LETTER, SIGN, ALONE = range(4)
OTHER, END = b"A", b"B"  # marks of a word with other characters and of a text's end: capitals, which lower case does not have
KIND = np.array([SPACE if b == 32 else LETTER if chr(LOWER[b]) == chr(b) and chr(b).isalpha() else
                 ALONE if chr(b).isnumeric() or bytes([b]) in (OTHER, END) else SIGN for b in range(256)], dtype=np.uint8)

PIECES = "start long, length long, ids_crc32 long, doc_tokens long, ids binary"


class WordEncoder(dict):
    """Part of a text -> token ids as little-endian 32-bit bytes, filled as parts are met; kept per Python worker, see ``encoder``.

    The tokenizer lower-cases a text and parts it where letters, digits, signs
    and white space meet.  Here the parts of many texts are found at once on
    their Latin-1 bytes, told apart by Arrow, and each new one goes to the
    tokenizer's model.  Words with other characters or special tokens are
    encoded by the whole tokenizer; they are keys as ``str``, parts as ``bytes``.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks fill the cores
        from tokenizers import Tokenizer, pre_tokenizers

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.parts = Tokenizer(self.tokenizer.model)  # for parts with spaces between
        self.parts.pre_tokenizer = pre_tokenizers.Split(" ", "removed")
        size = self.tokenizer.get_vocab_size()
        self.closes = np.array([(self.tokenizer.id_to_token(i) or "").endswith(CLOSE) for i in range(size)])
        # byte-level tokenizers write bytes as characters: printable ones as themselves, the rest from 256 on
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in plain]
        written = {b: chr(256 + i) for i, b in enumerate(rest) if b != 32}
        self.written = "".join(written.get(b, chr(b)) for b in range(256))

    def latin(self, text: str, others: list[str]) -> bytes:
        """The text in lower case, one byte a character; words that have other characters are marked and added to ``others``."""
        if "<|" not in text:
            try:
                return text.encode("latin-1").translate(LOWER)
            except UnicodeEncodeError:
                pass
        out = []
        for word in GAP.split(text):
            if not word.isascii() and max(word) > "\u00ff" or any(t in word for t in self.special):
                others.append(word)
                out.append(OTHER)
            else:
                out.append(word.encode("latin-1").translate(LOWER))
        return b" ".join(out)

    def encode_parts(self, parts: list[bytes]) -> list[bytes]:
        """The ids of each part, in the same order, by the tokenizer's model."""
        if not parts:
            return []
        lines = [b" ".join(parts[lo:lo + 256]) for lo in range(0, len(parts), 256)]
        lines = [charmap_decode(line.decode("latin-1").encode(), "strict", self.written)[0] for line in lines]
        ids = np.array(list(chain.from_iterable(e.ids for e in self.parts.encode_batch_fast(lines))), dtype="<u4")
        ends = np.flatnonzero(self.closes[ids]) + 1  # a part's last token, and no other, has the closing suffix
        if len(ends) != len(parts):
            model = self.tokenizer.model  # a vocabulary without such suffixes, or without some byte
            return [array("I", [t.id for t in model.tokenize(p)]).tobytes() for line in lines for p in line.split(" ")]
        ids, ends = ids.tobytes(), (4 * ends).tolist()
        return [ids[a:b] for a, b in zip([0, *ends], ends)]

    def texts(self, texts: list[str], end: bytes = b"") -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in one row, ``end`` behind each, and where each text's ids end."""
        self.trim()
        others: list[str] = []
        found = text_parts(b"".join([self.latin(t, others) + END for t in texts])).dictionary_encode()
        at, keys = found.indices.to_numpy(), found.dictionary.to_numpy(zero_copy_only=False).tolist()
        ids = list(map(self.get, keys))
        closing = at == keys.index(END)
        ids[keys.index(END)] = end
        if others:
            other = keys.index(OTHER)
            ids[other] = b""
            words = list(dict.fromkeys(others))
            place = {w: len(keys) + i for i, w in enumerate(words)}
            at = at.copy()
            at[at == other] = [place[w] for w in others]
            ids += [self.word(w) for w in words]
        new = [i for i, x in enumerate(ids) if x is None]
        parts = [keys[i] for i in new]
        for i, part, x in zip(new, parts, self.encode_parts(parts)):
            ids[i] = x
            if len(part) <= CACHE_CHARS:
                self[part] = x
        row = pa.array(ids, pa.large_binary()).take(pa.array(at))
        _, offsets, values = row.buffers()
        ends = np.frombuffer(offsets, dtype=np.int64)[1:len(row) + 1][closing] // 4
        return np.frombuffer(values or b"", dtype="<u4")[:ends[-1]], ends

    def word(self, word: str) -> bytes:
        """The ids of a word by the whole tokenizer."""
        ids = self.get(word)
        if ids is None:
            ids = array("I", self.tokenizer.encode(word, add_special_tokens=False).ids).tobytes()
            if len(word) <= CACHE_CHARS:
                self[word] = ids
        return ids

    def text(self, text: str) -> bytes:
        """The ids of one text; long ones are taken by stretches that end at white space."""
        out, at = [], 0
        while gap := GAP.search(text, at + STRETCH):
            out.append(self.texts([text[at:gap.start()]])[0].tobytes())
            at = gap.end()
        return b"".join([*out, self.texts([text[at:]])[0].tobytes()])

    def trim(self) -> None:
        if len(self) > CACHE_WORDS:  # words met early are the frequent ones
            kept = dict(islice(self.items(), CACHE_WORDS // 2))
            self.clear()
            self.update(kept)


def text_parts(text: bytes) -> pa.Array:
    """The parts of lower-case Latin-1 text that ends with ``END``, in order.

    Parts are runs of one kind but white space, single digits and marks, and an
    apostrophe with one of 's 't 're 've 'm 'll 'd where no sign stands before it.
    """
    chars = np.frombuffer(text, dtype=np.uint8)
    kind = KIND[chars]
    starts = np.ones(len(chars), dtype=np.uint8)
    starts[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == ALONE)
    at = np.flatnonzero(chars == ord("'"))
    at = at[(starts[at] == 1) & (kind[at + 1] == LETTER)]  # END follows the last
    first, both = chars[at + 1], chars[at + 1] * np.int64(256) + chars[at + 2]
    size = np.where(np.isin(both, [a * 256 + b for a, b in (b"re", b"ve", b"ll")]), 2, np.isin(first, list(b"stmd")))
    at, size = at[size > 0], size[size > 0]
    starts[at + 1] = 0
    starts[at + 1 + size] = 1
    starts[kind == SPACE] = 2
    starts = np.frombuffer(starts.tobytes().translate(None, b"\2"), dtype=np.uint8)
    offsets = np.append(np.flatnonzero(starts), len(starts)).astype("<i4")
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(text.translate(None, b" "))])


def encoder(path: str) -> WordEncoder:
    """The worker's encoder for a vocabulary file."""
    return kept_by_worker(f"words {path}", lambda: WordEncoder(path))


def cuts(n: int, window: int = WINDOW) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces."""
    out = [(s, window) for s in range(0, n - window + 1, window)]
    start = len(out) * window
    if n - start >= window // 2:
        out.append((start, window // 2))
        start += window // 2
    if n > start:
        out.append((start, n - start))
    return out


def pieces(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text",
           window: int = WINDOW, keep_ids: bool = False) -> DataFrame:
    """Rows (id, start, length, ids_crc32, doc_tokens, ids); ``ids`` is null unless asked for."""
    d = docs.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    schema = d.drop("_text").schema
    for part in PIECES.split(", "):
        schema = schema.add(*part.split(" "))
    end = np.array([END_ID], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import public_tokenizers

        enc = encoder(path or public_tokenizers.path(TOKENIZER))
        for batch in batches:
            size = pc.binary_length(batch.column("_text")).to_numpy()
            new = np.diff(np.cumsum(size, dtype=np.int64) // STRETCH, prepend=-1) > 0
            new[1:] |= size[:-1] >= STRETCH  # a long text stands alone
            first_rows = np.flatnonzero(new).tolist()
            for lo, hi in zip(first_rows, [*first_rows[1:], batch.num_rows]):
                part = batch.slice(lo, hi - lo)
                texts = part.column("_text").to_pylist()
                if len(texts) == 1:
                    ids = np.frombuffer(enc.text(texts[0]) + end, dtype="<u4")
                    ends = [len(ids)]
                else:
                    ids, ends = enc.texts(texts, end)
                    ends = ends.tolist()
                row, out = [], []
                for i, (first, last) in enumerate(zip([0, *ends], ends)):
                    own, n = ids[first:last], last - first
                    for start, length in cuts(n, window):
                        piece = own[start:start + length]
                        row.append(i)
                        out.append((start, length, zlib.crc32(piece), n, piece.tobytes() if keep_ids else None))
                columns = [pa.array(c, t) for c, t in zip(zip(*out), [pa.int64()] * 4 + [pa.binary()])]
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(row)), *columns], names=schema.names)

    return d.mapInArrow(run, schema)


def combinations(sizes: list[int], window: int) -> list[dict[int, int]]:
    """Shallow fillings of a window by ``sizes`` (ascending): {size: copies}; three sizes, or copies of one and a filler."""
    there, found = set(sizes), {}

    def add(*parts: int) -> None:
        found[tuple(sorted(parts))] = {x: parts.count(x) for x in parts}

    for i, a in enumerate(sizes):
        for b in sizes[i:]:
            c = window - a - b
            if c < b:
                break
            if c in there:
                add(a, b, c)
        most = window // a
        for k in {most, max(1, most - 1), max(1, most - 2), max(1, 3 * most // 4), max(1, most // 2 + 1)}:
            filler = bisect_right(sizes, window - k * a)
            add(*[a] * k, *sizes[max(0, filler - 1):filler])
    return list(found.values())


def nnls(a: np.ndarray, b: np.ndarray, rounds: int = 1000) -> np.ndarray:
    """x >= 0 minimising |a x - b|: grow a set of free columns by the steepest gradient, drop those that turn negative."""
    x, free = np.zeros(a.shape[1]), np.zeros(a.shape[1], dtype=bool)
    tol = 1e-9 * max(1.0, float(np.abs(a.T @ b).max(initial=0)))
    for _ in range(rounds):
        grad = a.T @ (b - a @ x)
        grad[free] = -np.inf
        j = int(grad.argmax())
        if not grad[j] > tol:
            break
        free[j] = True
        while True:
            z = np.zeros_like(x)
            z[free] = np.linalg.lstsq(a[:, free], b, rcond=None)[0]
            low = free & (z <= 0)
            if not low.any():
                x = z
                break
            step = np.min(x[low] / np.maximum(x[low] - z[low], 1e-300))
            x = x + step * (z - x)
            free &= x > 1e-12
            x[~free] = 0
            if not free.any():
                break
    return x


def plan(histogram: dict[int, int], window: int) -> list[tuple[dict[int, int], int]]:
    """[(combination, repeats)] that uses every counted piece exactly once; ``histogram`` is {size: pieces}."""
    left = {u: n for u, n in histogram.items() if n}
    out: list[tuple[dict[int, int], int]] = []

    def use(combo: dict[int, int], times: int) -> None:
        if times > 0:
            out.append((combo, times))
            for u, k in combo.items():
                left[u] -= k * times

    rows = sorted(left)
    combos = combinations(rows, window)
    if combos:
        place = {u: i for i, u in enumerate(rows)}
        a = np.zeros((len(rows), len(combos)))
        for j, c in enumerate(combos):
            for u, k in c.items():
                a[place[u], j] = k
        h = np.array([left[u] for u in rows], dtype=float)
        weight = np.array(rows, dtype=float)[:, None]  # a misplaced piece costs its length
        x = nnls(a * weight, h * weight[:, 0])
        for j in np.argsort(-x, kind="stable"):
            fits = min(left[u] // k for u, k in combos[j].items())
            use(combos[j], min(int(x[j] + 1e-6), fits))
    while any(left.values()):
        combo, room = {}, window
        for u in sorted(left, reverse=True):
            k = min(left[u], room // u)
            if k:
                combo[u], room = k, room - k * u
        use(combo, min(left[u] // k for u, k in combo.items()))
    return out


def pack(found: DataFrame, id_col: str = "doc_id", window: int = WINDOW) -> DataFrame:
    """Give every piece its ``sequence_id`` and ``offset``."""
    spark = found.sparkSession
    rounded = F.least(F.ceil(F.col("length") / STEP) * STEP, F.lit(window))
    p = found.withColumn("_u", F.when(F.col("length") < FINE, F.col("length")).otherwise(rounded).cast("int"))
    histogram = {r["_u"]: r["n"] for r in p.groupBy("_u").agg(F.count(F.lit(1)).alias("n")).collect()}
    slots, base, used = [], 0, dict.fromkeys(histogram, 0)
    for combo, times in plan(histogram, window):
        for u, k in combo.items():
            slots.append((u, used[u], used[u] + k * times, base, times))
            used[u] += k * times
        base += times
    slots = spark.createDataFrame(slots, "_u int, _lo long, _hi long, _base long, _times long")
    ranked = bucketed_rank(p, ["_u"], [id_col, "start", "length", "ids_crc32"], "_rank", buckets=512)
    placed = ranked.join(F.broadcast(slots), [  # one row per use of a length, bounded by the plan
        ranked["_u"] == slots["_u"], F.col("_rank") >= F.col("_lo"), F.col("_rank") < F.col("_hi")]
    ).withColumn("sequence_id", F.col("_base") + (F.col("_rank") - F.col("_lo")) % F.col("_times"))
    before = (Window.partitionBy("sequence_id").orderBy(F.col("length").desc(), id_col, "start", "_rank")
              .rowsBetween(Window.unboundedPreceding, -1))
    return placed.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)).cast("long")).select(
        *found.columns, "sequence_id", "offset")


def pack_documents(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text",
                   keep_ids: bool = False) -> DataFrame:
    """Pieces with their places; texts are encoded once, pieces are written to the shared folder in between."""
    found = pieces(docs, path, id_col, text_col, keep_ids=keep_ids)
    return pack(stored(found if keep_ids else found.drop("ids"), "pieces"), id_col)


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))
