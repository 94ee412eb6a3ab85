"""Suffix-array dedup: remove every byte covered by a long string that also starts elsewhere.

Texts are UTF-8 bytes; a string of ``span`` bytes is repeated if it starts at
two places, in any documents, the same one included; matches never cross
documents.  All occurrences go.

1. Every window of ``span`` bytes picks a content-defined anchor (``winnow``),
   so equal windows pick equal anchors at the same offset.  Only anchors whose
   fingerprint occurs at two places can lie in a repeated string.
2. Around those the bytes that such a string could cover are cut out, and
   contexts of one fingerprint meet in a block.  Fingerprints with more than
   ``PART`` contexts are dealt out as pairs of parts, so each two contexts
   still meet and a task holds a bounded number.
3. Contexts that share too little around the anchor with any other to hold a
   repeated string are left out (``may_repeat``).  Of the others, a block's
   right sides (from the anchor on) are put in order by a suffix
   array (``suffix_array``) over their letters, the left sides by their
   reversed bytes.  For every offset of the anchor in the string, the classes
   of rights that agree far enough and of lefts that agree far enough are runs
   of those orders; a string is repeated if two contexts share both classes.
   This is exact; fingerprints only decide who meets.
4. Spans are merged per text and cut out.

The same runs over words (``WORDS``): a string is then ``span`` words in a row,
whatever white space lies between, words are compared by all their bytes, and
in scripts without spaces each character is a word (``hashing.word_bounds``).
A cut then takes the white space up to the next word along.

A rule of so many bytes and one of so many words mark different texts: 51
short words can be 101 bytes, and 400 bytes can be 30 words.  ``passage``
therefore counts, next to the bytes removed, the words of every text that
stand in a passage of so many words that also starts elsewhere.

Texts that occur twice or more are sent as one, and covered whole if they
hold a string at all.  Defined results: a null text is empty; texts shorter
than ``span`` lose nothing by themselves; repeated rows are copies of each
other, so they are covered whole; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tarmac.llm.common import Scratch, kept_by_worker, table, whole_row
from tarmac.llm.hashing import CHUNK, exact_word_hashes, text_chunks, word_bounds
from tarmac.llm.suffix_array import suffix_array
from tarmac.llm.winnow import GRAM, Anchors

SPAN = 400
PASSAGE = 51  # words of a passage that op1 counts: over fifty
WORD_GRAM = 8  # words that a fingerprint covers
LETTER = 80  # bytes of a letter of the suffix array
PART = 8192
BROADCAST_ROWS = 100_000  # fingerprints with large blocks sent to all tasks; beyond, a shuffle
SEEN = 200_000  # texts a task remembers to send copies once
BATCH = 16_384  # contexts that one suffix array holds, blocks permitting
SOUGHT = 1 << 18  # bytes of texts whose anchors are sought at once, so that the arrays fit a core's cache
STRETCHES = 4  # ranges of offsets whose common units are compared before the suffix array

SPANS = "th binary, lo long, hi long"


def _steps(texts: list[bytes]) -> Iterator[list[bytes]]:
    """The texts in lists of about ``CHUNK`` bytes."""
    some, size = [], 0
    for t in texts:
        some.append(t)
        size += len(t)
        if size >= CHUNK:
            yield some
            some, size = [], 0
    if some:
        yield some


class Bytes:
    """Strings counted in bytes."""

    size, gram, fewest = 1, GRAM, staticmethod(lambda span: span)

    @staticmethod
    def anchors(find: Anchors, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return find(texts)

    @staticmethod
    def parts(texts: list[bytes]) -> Iterator[Callable[[int, int], bytes]]:
        """Of every text a function for its units from lo up to hi."""
        for raw in texts:
            yield lambda lo, hi, raw=raw: raw[lo:hi]

    @staticmethod
    def coded(contexts: pa.ChunkedArray) -> list[bytes]:
        """Contexts with ``size`` bytes a unit, equal units alike."""
        return contexts.to_pylist()

    @staticmethod
    def bytes_of(raw: bytes, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
        """The spans in bytes."""
        return spans


class Words:
    """Strings counted in words."""

    size, gram, fewest = 4, WORD_GRAM, staticmethod(lambda span: 2 * span - 1)  # bytes of the shortest such text

    @staticmethod
    def anchors(find: Anchors, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        raw, starts, ends, first = word_bounds(texts)
        return find.of_units(exact_word_hashes(raw, starts, ends), first)

    @staticmethod
    def parts(texts: list[bytes]) -> Iterator[Callable[[int, int], bytes]]:
        for some in _steps(texts):
            raw, starts, ends, first = word_bounds(some)
            raw = raw.tobytes()
            for lo, hi in zip(first[:-1].tolist(), first[1:].tolist()):
                words = [raw[a:b] for a, b in zip(starts[lo:hi].tolist(), ends[lo:hi].tolist())]
                yield lambda lo, hi, words=words: b" ".join(words[lo:hi])

    @staticmethod
    def coded(contexts: pa.ChunkedArray) -> list[bytes]:
        words = pc.split_pattern(contexts.cast(pa.large_binary()).combine_chunks(), pattern=b" ")
        raw = (words.flatten().dictionary_encode().indices.to_numpy() + 1).astype("<u4").tobytes()
        at = (4 * (words.offsets.to_numpy().astype(np.int64) - words.offsets[0].as_py())).tolist()
        return [raw[lo:hi] for lo, hi in zip(at, at[1:])]

    @staticmethod
    def bytes_of(raw: bytes, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
        _, starts, _, _ = word_bounds([raw])
        at = [0, *starts[1:].tolist(), len(raw)]
        return [(at[lo], at[min(hi, len(at) - 1)]) for lo, hi in spans]


BYTES, WORDS = Bytes(), Words()


def _padded(parts: list[bytes], width: int) -> np.ndarray:
    return np.frombuffer(b"".join([p.ljust(width, b"\0") for p in parts]), dtype=np.uint8).reshape(len(parts), width)


def _agree(rows: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Equal leading bytes of each row and the one before it in ``order`` (0 for the first)."""
    out = np.zeros(len(order), dtype=np.int64)
    for lo in range(1, len(order), 4096):
        a, b = rows[order[lo - 1: lo - 1 + 4096][: len(order) - lo]], rows[order[lo: lo + 4096]]
        differ = a != b
        out[lo: lo + len(b)] = np.where(differ.any(axis=1), differ.argmax(axis=1), rows.shape[1])
    return out


def right_order(rights: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of the right sides by suffix array, where equal ones stand once, and the bytes each agrees on with the one before."""
    once: dict[bytes, int] = {}
    which = np.array([once.setdefault(r, len(once)) for r in rights], dtype=np.int64)
    letters = -(-width // LETTER)
    rows = _padded(list(once), letters * LETTER)
    names = np.unique(rows.reshape(-1, LETTER).copy().view(f"S{LETTER}").ravel(), return_inverse=True)[1]
    names = names.reshape(len(once), letters) + 2
    text = np.concatenate([names, np.ones((len(once), 1), dtype=names.dtype)], axis=1)  # 1 ends a right side
    step = letters + 1
    order = np.array([i // step for i in suffix_array(text.ravel().tolist()) if i % step == 0], dtype=np.int64)
    place = np.empty(len(once), dtype=np.int64)
    place[order] = np.arange(len(once))
    by = np.argsort(place[which], kind="stable")
    at = place[which][by]
    return by, np.where(np.diff(at, prepend=-1) > 0, _agree(rows, order)[at], rows.shape[1])


def repeated(before: np.ndarray, contexts: list[bytes], span: int, size: int = 1) -> list[tuple[int, int, int]]:
    """(context, first offset, last offset): strings that start 'offset' units left of the anchor and are repeated.

    A unit has ``size`` bytes.
    """
    m, most = len(contexts), int(before.max(initial=0))
    rights = [c[b * size:(b + span) * size] for c, b in zip(contexts, before.tolist())]
    lefts = _padded([c[:b * size][::-1] for c, b in zip(contexts, before.tolist())], max(1, most * size))
    length = np.array([len(r) // size for r in rights], dtype=np.int64)
    r_order, r_agree = right_order(rights, span * size)
    l_order = np.argsort(lefts.copy().view(f"S{lefts.shape[1]}").ravel(), kind="stable")
    l_agree = _agree(lefts, l_order) // size
    r_agree //= size
    r_most, l_most = np.empty(m, dtype=np.int64), np.empty(m, dtype=np.int64)  # agreed on with any other
    r_most[r_order], l_most[l_order] = (np.maximum(a, np.append(a[1:], 0)) for a in (r_agree, l_agree))
    flags = np.zeros((most + 3, m), dtype=np.int8)
    r_class, l_class = np.empty(m, dtype=np.int64), np.empty(m, dtype=np.int64)
    for s in range(most + 1):
        fits = np.flatnonzero((np.minimum(before, l_most) >= s) & (np.minimum(length, r_most) >= span - s))
        if len(fits) < 2:
            continue
        r_class[r_order] = np.cumsum(r_agree < span - s)
        l_class[l_order] = np.cumsum(l_agree < s)
        key = r_class[fits] * (m + 1) + l_class[fits]
        by = np.argsort(key)
        same = key[by[1:]] == key[by[:-1]]
        twice = np.zeros(len(fits), dtype=bool)
        twice[by[1:]] |= same
        twice[by[:-1]] |= same
        flags[s + 1, fits[twice]] = 1
    edge = np.diff(flags, axis=0).T
    row, first = np.nonzero(edge > 0)
    _, last = np.nonzero(edge < 0)
    return list(zip(row.tolist(), first.tolist(), (last - 1).tolist()))


def may_repeat(before: list[int], contexts: list[bytes], span: int, reach: int, size: int = 1) -> list[int]:
    """Contexts that can hold a repeated string; the others share too little around the anchor with any.

    A string that starts from lo up to hi units left of the anchor holds the lo units before the anchor and the
    ``span - hi`` from it on; a repeated one's are those of another context.  A unit has ``size`` bytes.
    """
    edges = [reach * k // STRETCHES for k in range(STRETCHES)] + [reach + 1]
    viable = bytearray(len(contexts))
    for lo, hi in zip(edges, [e - 1 for e in edges[1:]]):
        first: dict[bytes, int] = {}
        left, right = lo * size, (span - hi) * size
        for i, (b, c) in enumerate(zip(before, contexts)):
            at = b * size
            if at < left or len(c) - at < right:
                continue
            j = first.setdefault(c[at - left:at + right], i)
            if j != i:
                viable[i] = viable[j] = 1
    return [i for i, v in enumerate(viable) if v]


def _find_anchors(anchors: Anchors, unit: Bytes | Words) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept_by_worker(None)
        seen: set[bytes] = set()
        for batch in batches:
            for start, texts in text_chunks(batch.column("text"), SOUGHT):
                hashes = batch.column("th").slice(start, len(texts)).to_pylist()
                new = []
                for i, th in enumerate(hashes):  # copies in this task are sent once
                    if th not in seen and len(texts[i]) >= unit.fewest(anchors.span):
                        new.append(i)
                        if len(seen) < SEEN:
                            seen.add(th)
                owner, place, fp = unit.anchors(anchors, [texts[i] for i in new])
                if not len(fp):
                    continue
                by = np.lexsort((place, fp, owner))
                owner, place, fp = owner[by], place[by], fp[by]
                first = np.flatnonzero(np.r_[True, (owner[1:] != owner[:-1]) | (fp[1:] != fp[:-1])])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([hashes[i] for i in new], pa.binary()).take(pa.array(owner[first])),
                     pa.ListArray.from_arrays(pa.array(np.r_[first, len(fp)], pa.int32()), pa.array(place)),
                     pa.array(fp[first].view(np.int64))], names=["th", "places", "fp"])

    return run


def _cut_contexts(span: int, reach: int, unit: Bytes | Words) -> Callable:
    """Rows (th, fp, places, before, context): contexts of a text, equal ones once with all their places."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 64):
                part = batch.slice(lo, 64)
                out: dict[tuple, list[int]] = {}
                th, text, at = (part.column(c).to_pylist() for c in ("th", "text", "at"))
                for th, part_of, at in zip(th, unit.parts([t.encode() for t in text]), at):
                    for a in at:
                        for p in a["places"]:
                            lo_p = max(0, p - reach)
                            out.setdefault((th, a["fp"], p - lo_p, part_of(lo_p, p + span)), []).append(p)
                if out:
                    th, fp, before, ctx = zip(*out)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(th, pa.binary()), pa.array(fp, pa.int64()),
                         pa.array(list(out.values()), pa.list_(pa.int64())), pa.array(before, pa.int64()), pa.array(ctx, pa.binary())],
                        names=["th", "fp", "places", "before", "context"])

    return run


def _merged(lo: np.ndarray, hi: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unions of overlapping or touching [lo, hi) of the same owner."""
    if not len(lo):
        return lo, hi, own
    far = int(hi.max()) + 2  # owners lie on one line, apart from each other
    by = np.lexsort((lo, own))
    lo, hi = lo[by] + own[by] * far, hi[by] + own[by] * far
    reach = np.maximum.accumulate(hi)
    first = np.flatnonzero(np.r_[True, lo[1:] > reach[:-1]])
    last = np.r_[first[1:] - 1, len(lo) - 1]
    own = own[by][first]
    return lo[first] - own * far, reach[last] - own * far, own


def _spans_of_blocks(span: int, reach: int, unit: Bytes | Words) -> Callable:
    """Repeated spans per text from rows sorted by block."""

    def spans(rows: pa.Table) -> pa.RecordBatch:
        th, places, before = (rows.column(c).to_pylist() for c in ("th", "places", "before"))
        contexts = unit.coded(rows.column("context"))
        once: dict[tuple, int] = {}
        for i, key in enumerate(zip(th, (p[0] for p in places))):  # a context may be in several blocks of parts
            once.setdefault(key, i)
        keep = list(once.values())
        # (row, stretch before the place, stretch after it); contexts at several places are covered whole
        found = [(i, before[i], len(contexts[i]) // unit.size - before[i]) for i in keep if len(places[i]) > 1]
        keep = [keep[k] for k in may_repeat([before[i] for i in keep], [contexts[i] for i in keep], span, reach, unit.size)]
        found += [(keep[k], last, span - first) for k, first, last in repeated(
            np.array([before[i] for i in keep], dtype=np.int64), [contexts[i] for i in keep], span, unit.size)] if keep else []
        names = {t: k for k, t in enumerate(dict.fromkeys(th))}
        n = np.array([len(places[i]) for i, _, _ in found], dtype=np.int64)
        at = np.array([p for i, _, _ in found for p in places[i]], dtype=np.int64)
        own = np.repeat(np.array([names[th[i]] for i, _, _ in found], dtype=np.int64), n)
        lo, hi = (at + sign * np.repeat(np.array([f[k] for f in found], dtype=np.int64), n) for k, sign in ((1, -1), (2, 1)))
        lo, hi, own = _merged(lo, hi, own)
        return pa.RecordBatch.from_arrays(
            [pa.array(list(names), pa.binary()).take(pa.array(own)), pa.array(lo), pa.array(hi)], names=["th", "lo", "hi"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) < BATCH:
                continue
            rows = pa.Table.from_batches(held)
            key = np.stack([rows.column(c).to_numpy() for c in ("fp", "i", "j")])
            edge = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1
            if len(edge):  # the last block may go on
                yield spans(rows.slice(0, int(edge[-1])))
                held = rows.slice(int(edge[-1])).combine_chunks().to_batches()
        if held:
            yield spans(pa.Table.from_batches(held))

    return run


def find_spans(docs: DataFrame, span: int = SPAN, id_col: str = "doc_id", text_col: str = "text",
               unit: Bytes | Words = BYTES) -> tuple[DataFrame, DataFrame]:
    """(texts: id, th per row with the text; spans: th, spans array<(lo, hi)> in units, merged; a whole text may go on)."""
    anchors = Anchors(span, unit.gram)
    spark = docs.sparkSession
    scratch = Scratch(spark, "dedup")
    text = F.coalesce(F.col(text_col), F.lit(""))
    d = docs.select(F.col(id_col).alias("id"), F.unhex(F.md5(text)).alias("th"), text.alias("text"))
    rows = scratch.stored(d.select("id", "th", F.octet_length("text").cast("long").alias("n_bytes")), "texts")
    per_text = rows.filter(F.col("n_bytes") >= unit.fewest(span)).groupBy("th").agg(
        F.min("id").alias("_id"), F.count(F.lit(1)).alias("copies"), F.first("n_bytes").alias("n_bytes"))

    found = scratch.stored(d.select("th", "text").mapInArrow(_find_anchors(anchors, unit), "th binary, places array<bigint>, fp long"), "anchors")
    spot = F.xxhash64("th")
    shared = (found.groupBy("fp").agg(F.min(spot).alias("x"), F.max(spot).alias("y"), F.max(F.size("places")).alias("n"))
              .filter("x <> y OR n > 1").select("fp"))
    at = (found.join(shared, "fp").groupBy("th").agg(F.collect_set(F.struct("places", "fp")).alias("at"))
          .join(per_text, "th").select(F.col("th").alias("_th"), "_id", "at"))
    cut = scratch.stored(
        d.join(at, (F.col("th") == F.col("_th")) & F.col("id").eqNullSafe(F.col("_id")))
        .select("th", "text", "at").mapInArrow(
            _cut_contexts(span, anchors.width - 1, unit),
            "th binary, fp long, places array<bigint>, before long, context binary"), "contexts")
    # texts with an anchor hold a string
    whole = scratch.stored(per_text.filter("copies > 1").join(found.select("th").distinct(), "th", "left_semi")
                           .select("th", F.lit(0).cast("long").alias("lo"), F.col("n_bytes").alias("hi")), "whole")
    scratch.drop("anchors")
    large = scratch.stored(cut.groupBy("fp").agg(F.count(F.lit(1)).alias("size")).filter(F.col("size") > PART), "large")
    few = large.count() <= BROADCAST_ROWS
    cut = cut.join(F.broadcast(large) if few else large, "fp", "left")
    parts = F.coalesce(F.ceil(F.col("size") / PART), F.lit(1)).cast("int")
    cut = cut.withColumn("part", F.pmod(F.xxhash64("th", F.get("places", F.lit(0))), parts).cast("int"))
    cut = cut.withColumn("o", F.explode(F.sequence(F.lit(0), parts - 1))).select(
        "th", "fp", "places", "before", "context", F.least("part", "o").alias("i"), F.greatest("part", "o").alias("j"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    spans = (cut.repartition(n, "fp", "i", "j").sortWithinPartitions("fp", "i", "j")
             .mapInArrow(_spans_of_blocks(span, anchors.width - 1, unit), SPANS))
    merged = F.aggregate(
        F.sort_array(F.collect_set(F.struct("lo", "hi"))),
        F.array().cast("array<struct<lo:bigint,hi:bigint>>"),
        lambda a, s: F.when((F.size(a) > 0) & (F.element_at(a, -1)["hi"] >= s["lo"]), F.concat(
            F.slice(a, 1, F.size(a) - 1),
            F.array(F.struct(F.element_at(a, -1)["lo"].alias("lo"),
                             F.greatest(F.element_at(a, -1)["hi"], s["hi"]).alias("hi"))))
        ).otherwise(F.concat(a, F.array(s))))
    spans = spans.unionByName(whole).groupBy("th").agg(merged.alias("spans"))
    spans = scratch.stored(spans, "spans")
    scratch.drop("texts", "contexts", "large", "whole")
    return d, spans


def _words_in(texts: list[bytes], spans: list[list[dict] | None]) -> list[int]:
    """Words of each text inside its spans of words; only a span of a whole text goes on, to the text's bytes."""
    whole = [i for i, found in enumerate(spans) if found and found[-1]["hi"] >= len(texts[i])]
    n = dict(zip(whole, (k for some in _steps([texts[i] for i in whole]) for k in np.diff(word_bounds(some)[3]).tolist())))
    return [sum(min(s["hi"], n.get(i, s["hi"])) - s["lo"] for s in found or []) for i, found in enumerate(spans)]


def _cut(docs: DataFrame, row: Column, span: int, id_col: str, text_col: str, unit: Bytes | Words, with_text: bool,
         passage: int | None = None) -> DataFrame:
    """(row, n_bytes, n_removed, n_spans, kept_sha256, and the kept text and the words in passages if asked for)."""
    _, spans = find_spans(docs, span, id_col, text_col, unit)
    text = F.coalesce(F.col(text_col), F.lit(""))
    found = spans.select(F.col("th").alias("th2"), "spans")
    if passage:  # both kinds of spans come with one join
        _, more = find_spans(docs, passage, id_col, text_col, WORDS)
        found = found.join(more.select(F.col("th").alias("th2"), F.col("spans").alias("passages")), "th2", "full")
    full = docs.select(row.alias("row"), text.alias("text"), F.unhex(F.md5(text)).alias("th")).join(
        found, F.col("th") == F.col("th2"), "left").select("row", "text", "spans", *(["passages"] if passage else []))
    counted = ("n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept_text string" * with_text
               + ", n_repeated_words long" * bool(passage))
    schema = StructType([full.schema["row"], *StructType.fromDDL(counted).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(lo, 256) for b in batches for lo in range(0, b.num_rows, 256)):
            sizes, removed, counts, digests, kept_texts = [], [], [], [], []
            for text, found in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist()):
                raw, at, kept = text.encode(), 0, []
                for lo, hi in unit.bytes_of(raw, [(s["lo"], s["hi"]) for s in found]) if found else []:
                    kept.append(raw[at:lo])
                    at = hi
                kept = b"".join([*kept, raw[at:]])
                sizes.append(len(raw))
                removed.append(len(raw) - len(kept))
                counts.append(len(found or []))
                digests.append(hashlib.sha256(kept).hexdigest())
                if with_text:
                    kept_texts.append(kept.decode("utf-8", "ignore") if found else text)
            out = [pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(counts, pa.int64()),
                   pa.array(digests, pa.string())] + [pa.array(kept_texts, pa.string())] * with_text
            if passage:
                texts = [text.encode() for text in batch.column("text").to_pylist()]
                out.append(pa.array(_words_in(texts, batch.column("passages").to_pylist()), pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column("row"), *out], names=schema.names)

    return full.mapInArrow(run, schema)


def cut(docs: DataFrame, span: int = SPAN, id_col: str = "doc_id", text_col: str = "text",
        keep_all: bool = False, unit: Bytes | Words = BYTES, passage: int | None = None) -> DataFrame:
    """Per row: id (or all columns), n_bytes, n_removed, n_spans, kept_sha256; with ``keep_all`` these begin with _ and the
    kept text follows; with ``passage`` n_repeated_words, the words in passages of so many words that also start elsewhere.

    In the kept text a character that lost some of its bytes goes whole; the digest is over the kept bytes.
    """
    out = _cut(docs, whole_row(docs) if keep_all else F.col(id_col), span, id_col, text_col, unit, keep_all, passage)
    if not keep_all:
        return out.withColumnRenamed("row", id_col)
    return out.select("row.*", *[F.col(c).alias("_" + c) for c in out.columns[1:]])


def cut_texts(docs: DataFrame, span: int = SPAN, id_col: str = "doc_id", text_col: str = "text",
              length_col: str = "n_chars", unit: Bytes | Words = BYTES) -> DataFrame:
    """``docs`` with the kept texts in place (null stays null), and their lengths if there is a column for them."""
    out = _cut(docs, whole_row(docs), span, id_col, text_col, unit, True)
    new = {text_col: F.when(F.col("row")[text_col].isNotNull(), F.col("kept_text"))}
    if length_col in docs.columns:
        new[length_col] = F.when(F.col("n_removed") > 0, F.length("kept_text").cast(docs.schema[length_col].dataType)).otherwise(
            F.col("row")[length_col])
    return out.select(*[new.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns])


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Removal by 400 bytes; the passages of over fifty words are counted, not removed."""
    return cut(table(spark, sf_dir, "documents"), passage=PASSAGE)
