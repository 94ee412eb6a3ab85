"""N-gram Jaccard join with signature trees, exact, to connected components.

A document's set holds the 64-bit hashes of its distinct word shingles.
Documents with equal sets form a class; from there on classes are joined.

1. Blocks.  Two sets with similarity at least t share a shingle among the
   first n - ceil(t n) + 1 of each in any common order, so classes sharing one
   of those shingles form a block, and no other pair can link.  The order is:
   shingles seen often in some part of the corpus last, then by hash; the
   order affects only the size of the blocks, never the result.  Blocks with
   equal members are taken once.
2. Trees.  A block's classes, by size, are the leaves of a signature tree;
   each node holds the OR of its token bitmaps and its size range.  A dual
   traversal drops node pairs whose sizes are too different, whose maximum
   possible overlap is below what the smallest pair would need, or that lie in
   one component already.  Blocks above ``BLOCK`` classes are dealt out as
   pairs of parts, so no task holds more than two parts.
3. Surviving pairs are checked once more by longer bitmaps where sets are
   large, and verified on their whole sets.  A first round only tries
   neighbours in each block; its links are joined to components, and the full
   traversal then looks for links between different components.  So a group
   of thousands of near copies costs its members, not its pairs.

Defined results: null, empty and wordless texts have an empty set and are
their own component; texts with fewer words than a shingle have one shingle;
repeated rows are documents; component ids are the smallest non-null id.
Two different shingles or sets are taken as equal if their 64-bit hashes are.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from tarmac.llm.common import Scratch, kept_by_worker, table, whole_row
from tarmac.llm.components import components
from tarmac.llm.hashing import NO_SPACE, mix, text_chunks, word_hashes

SHINGLE = 4
NUM, DEN = 85, 100  # link: DEN * intersection >= NUM * union
BITS = 4096
LEAF, FAN = 32, 8
STEP = 8192  # pairs of rows compared at a time
HELD_PAIRS = 1 << 16  # candidate pairs a task holds before it hands them on
SEEN = 200_000  # sets a task remembers to send copies once
BLOCK = 2048
OFTEN_LOCAL = 4  # shingle seen in so many documents of a task's stretch
STRETCH = 1 << 21  # shingles per stretch
BROADCAST_ROWS = 300_000  # classes whose texts are picked out by a broadcast; beyond, by a shuffle
OFTEN_MOST = 100_000  # shingles moved to the end of the order, at most


def shingle_sets(texts: list[bytes], width: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes per text."""
    words, first = word_hashes(texts, NO_SPACE)
    n = np.diff(first)
    spread = np.zeros(0, dtype=np.uint64)
    if len(words) >= width:
        spread = words[: len(words) - width + 1].copy()
        for k in range(1, width):
            spread = mix(spread) + words[k: len(words) - width + 1 + k]
        spread = mix(spread)
    out = []
    for i, k in enumerate(n.tolist()):
        at = int(first[i])
        if k >= width:
            out.append(np.unique(spread[at:at + k - width + 1]))
        elif k:
            h = words[at:at + 1].copy()
            for j in range(1, k):
                h = mix(h) + words[at + j:at + j + 1]
            out.append(mix(h + np.uint64(k)))
        else:
            out.append(np.zeros(0, dtype=np.uint64))
    return out


def set_hash(s: np.ndarray) -> int:
    """Signed 64-bit hash of a set."""
    total = mix(s * np.uint64(0x9E3779B97F4A7C15)).sum(dtype=np.uint64) if len(s) else np.uint64(0)
    return int(mix(np.array([total], dtype=np.uint64) + np.uint64(len(s))).view(np.int64)[0])


def need(na, nb, num: int, den: int):
    """Smallest intersection that links sets of these sizes."""
    return -(-num * (na + nb) // (num + den))


def fold(b: np.ndarray, size: int) -> np.ndarray:
    """A bitmap of ``size`` bytes as made directly, from a longer one."""
    return np.bitwise_or.reduce(b.reshape(-1, size), axis=0)


def wide_bitmap(s: np.ndarray, bits: int) -> bytes | None:
    """For sets above ``bits`` shingles a bitmap with about a bit per shingle."""
    return bitmap(s, 1 << min(20, len(s).bit_length())).tobytes() if len(s) > bits else None


def bitmap(s: np.ndarray, bits: int) -> np.ndarray:
    at = (s >> np.uint64(11)) % np.uint64(bits)
    flags = np.zeros(bits, dtype=bool)
    flags[at.astype(np.int64)] = True
    return np.packbits(flags, bitorder="little")


class Rule:
    """The join's parameters, as shipped to tasks."""

    def __init__(self, width: int = SHINGLE, num: int = NUM, den: int = DEN, bits: int = BITS):
        self.width, self.num, self.den, self.bits = width, num, den, bits

    def prefix(self, n: int) -> int:
        return n - -(-self.num * n // self.den) + 1

    def profile(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(kind 0: id, h, n, sig, bitmaps) per row; (kind 1: count as n, shingle as sig) for shingles seen often in a stretch."""
        held: list[np.ndarray] = []
        names = ["kind", "id", "h", "n", "sig", "bits", "wide"]

        def often() -> pa.RecordBatch:
            v, c = np.unique(np.concatenate(held), return_counts=True)
            v, c = v[c >= OFTEN_LOCAL], c[c >= OFTEN_LOCAL]
            none = pa.nulls(len(v), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(np.ones(len(v), np.int32)), none, none,
                                               pa.array(c.astype(np.int64)), pa.array(v.view(np.int64)),
                                               pa.nulls(len(v), pa.binary()), pa.nulls(len(v), pa.binary())], names=names)

        kept_by_worker(None)
        for batch in batches:
            for start, texts in text_chunks(batch.column("text")):
                sets = shingle_sets(texts, self.width)
                part = batch.slice(start, len(texts))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.zeros(len(texts), np.int32)), part.column("id"), part.column("h"),
                     pa.array([len(s) for s in sets], pa.int64()), pa.array([set_hash(s) for s in sets], pa.int64()),
                     pa.array([bitmap(s, self.bits).tobytes() for s in sets], pa.binary()),
                     pa.array([wide_bitmap(s, self.bits) for s in sets], pa.binary())], names=names)
                held.extend(sets)
                if sum(map(len, held)) >= STRETCH:
                    yield often()
                    held.clear()
        if held:
            yield often()

    def prefixes(self, often: np.ndarray) -> Callable:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            seen: set[int] = set()
            for batch in batches:
                for _, texts in text_chunks(batch.column("text")):
                    tokens, sigs, sizes, lens = [], [], [], []
                    for s in shingle_sets(texts, self.width):
                        sig = set_hash(s)
                        if not len(s) or sig in seen:  # copies in this task send one prefix
                            continue
                        if len(seen) < SEEN:
                            seen.add(sig)
                        if len(often):
                            at = np.minimum(np.searchsorted(often, s), len(often) - 1)
                            late = often[at] == s
                            s = np.concatenate([s[~late], s[late]])
                        tokens.append(s[: self.prefix(len(s))])
                        sigs.append(sig)
                        sizes.append(len(s))
                        lens.append(len(tokens[-1]))
                    if tokens:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.concatenate(tokens).view(np.int64)),
                             pa.array(np.repeat(np.array(sigs, dtype=np.int64), lens)),
                             pa.array(np.repeat(np.array(sizes, dtype=np.int64), lens))], names=["token", "sig", "n"])

        return run

    def whole_sets(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, texts in text_chunks(batch.column("text")):
                wanted = batch.column("sig").slice(start, len(texts)).to_pylist()
                sets = shingle_sets(texts, self.width)
                kept = [(sig, s) for sig, s in zip(wanted, sets) if set_hash(s) == sig]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([g for g, _ in kept], pa.int64()),
                     pa.array([s.astype("<u8").tobytes() for _, s in kept], pa.binary())], names=["sig", "shingles"])

    # ---- signature trees ----

    def possible(self, n: np.ndarray, bits: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Which row pairs can reach the needed overlap by size and bitmap; every bit of one that the other lacks
        is at least one shingle that is not shared."""
        x, y = bits[a], bits[b]
        most = np.minimum(n[a] - np.bitwise_count(x & ~y).sum(axis=1, dtype=np.int64),
                          n[b] - np.bitwise_count(y & ~x).sum(axis=1, dtype=np.int64))
        return most >= need(n[a], n[b], self.num, self.den)

    def neighbours(self, n: np.ndarray, bits: np.ndarray, comp: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of rows that stand one or two places apart, in steps."""
        for k in (1, 2):
            for lo in range(0, len(n) - k, STEP):
                a = np.arange(lo, min(lo + STEP, len(n) - k))
                ok = self.possible(n, bits, a, a + k)
                yield a[ok], a[ok] + k

    def traverse(self, n: np.ndarray, bits: np.ndarray, comp: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Row pairs (sizes ascending) in different components that the tree cannot rule out, in steps."""
        levels = [self._nodes([(i, min(i + LEAF, len(n))) for i in range(0, len(n), LEAF)], n, bits, comp)]
        while len(levels[-1]["lo"]) > 1:
            low = levels[-1]
            k = range(0, len(low["lo"]), FAN)
            levels.append(self._nodes([(low["lo"][i], low["hi"][min(i + FAN, len(low["lo"])) - 1]) for i in k], n, bits, comp))
        i = j = np.zeros(1, dtype=np.int64)
        for depth in range(len(levels) - 1, -1, -1):
            i, j = self._prune(levels[depth], i, j)
            if depth:
                width = len(levels[depth - 1]["lo"])
                step = np.arange(FAN)
                ci = (i[:, None, None] * FAN + step[None, :, None] + 0 * step[None, None, :]).ravel()
                cj = (j[:, None, None] * FAN + 0 * step[None, :, None] + step[None, None, :]).ravel()
                ok = (ci <= cj) & (ci < width) & (cj < width)
                i, j = ci[ok], cj[ok]
        leaf, step, many = levels[0], np.arange(LEAF), STEP // LEAF ** 2
        for at in range(0, len(i), many):
            a = (leaf["lo"][i[at:at + many]][:, None, None] + step[None, :, None] + 0 * step).ravel()
            b = (leaf["lo"][j[at:at + many]][:, None, None] + 0 * step[None, :, None] + step).ravel()
            ok = (a < b) & (b < len(n))
            a, b = a[ok], b[ok]
            ok = (n[b] * self.num <= n[a] * self.den) & (comp[a] != comp[b])
            a, b = a[ok], b[ok]
            ok = self.possible(n, bits, a, b)
            yield a[ok], b[ok]

    @staticmethod
    def _nodes(spans: list[tuple[int, int]], n, bits, comp) -> dict[str, np.ndarray]:
        lo, hi = (np.array(x, dtype=np.int64) for x in zip(*spans))
        slack = n - np.bitwise_count(bits).sum(axis=1, dtype=np.int64)
        first, last = np.minimum.reduceat(comp, lo), np.maximum.reduceat(comp, lo)
        return {"lo": lo, "hi": hi, "least": n[lo], "most": n[hi - 1], "or": np.bitwise_or.reduceat(bits, lo, axis=0),
                "slack": np.maximum.reduceat(slack, lo), "one": first == last, "comp": first}

    def _prune(self, node: dict[str, np.ndarray], i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        ok = node["least"][j] * self.num <= node["most"][i] * self.den
        ok &= ~(node["one"][i] & node["one"][j] & (node["comp"][i] == node["comp"][j]))
        i, j = i[ok], j[ok]
        common = np.bitwise_count(node["or"][i] & node["or"][j]).sum(axis=1, dtype=np.int64)
        most = np.minimum(np.minimum(node["most"][i], node["most"][j]),
                          common + np.minimum(node["slack"][i], node["slack"][j]))
        ok = most >= need(node["least"][i], node["least"][j], self.num, self.den)
        return i[ok], j[ok]

    def block_pairs(self, search: str) -> Callable:
        """Candidate pairs (a < b) of every block in rows sorted by block and size."""
        find = getattr(self, search)

        def of_block(rows: pa.Table) -> Iterator[np.ndarray]:
            n, sig, comp, part = (rows.column(c).to_numpy() for c in ("n", "sig", "comp", "part"))
            bits = np.frombuffer(b"".join(rows.column("bits").to_pylist()), dtype="<u8").reshape(len(n), -1)
            across = rows.column("i")[0].as_py() != rows.column("j")[0].as_py()  # pairs inside a part have a block of their own
            for a, b in find(n, bits, comp):
                ok = sig[a] != sig[b]
                if across:
                    ok &= part[a] != part[b]
                a, b = sig[a[ok]], sig[b[ok]]
                if len(a):
                    yield np.stack([np.minimum(a, b), np.maximum(a, b)])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found: list[np.ndarray] = []
            rest: pa.Table | None = None

            def out() -> pa.RecordBatch:
                pairs = np.unique(np.concatenate(found, axis=1), axis=1)
                found.clear()
                return pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], names=["a", "b"])

            def take(rows: pa.Table) -> Iterator[pa.RecordBatch]:
                for pairs in of_block(rows) if len(rows) > 1 else ():
                    found.append(pairs)
                    if sum(p.shape[1] for p in found) > HELD_PAIRS or len(found) > 2000:
                        yield out()

            for batch in batches:
                rows = pa.Table.from_batches([batch])
                rows = rows if rest is None else pa.concat_tables([rest, rows])
                key = np.stack([rows.column(c).to_numpy() for c in ("token", "i", "j")])
                edge = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1
                edge = [0, *edge.tolist()]
                for lo, hi in zip(edge, edge[1:]):
                    yield from take(rows.slice(lo, hi - lo))
                rest = rows.slice(edge[-1])  # a block may go on in the next batch
            if rest is not None:
                yield from take(rest)
            if found:
                yield out()

        return run

    def wide_possible(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Pairs that can still reach the needed overlap by their long bitmaps."""
        for batch in (b.slice(lo, 256) for b in batches for lo in range(0, b.num_rows, 256)):
            ok = []
            for na, nb, x, y in zip(*(batch.column(c).to_pylist() for c in ("na", "nb", "wa", "wb"))):
                if x is None or y is None:
                    ok.append(True)
                    continue
                x, y = np.frombuffer(x, dtype=np.uint8), np.frombuffer(y, dtype=np.uint8)
                size = min(len(x), len(y))
                x, y = fold(x, size), fold(y, size)
                most = min(na - int(np.bitwise_count(x & ~y).sum()), nb - int(np.bitwise_count(y & ~x).sum()))
                ok.append(most >= need(na, nb, self.num, self.den))
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    def linked(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Pairs whose whole sets link."""
        for batch in (b.slice(lo, 64) for b in batches for lo in range(0, b.num_rows, 64)):
            sets = [[np.frombuffer(x, dtype="<u8") for x in batch.column(c).to_pylist()] for c in ("sa", "sb")]
            ok = []
            for x, y in zip(*sets):
                common = len(x) + len(y) - len(np.unique(np.concatenate([x, y])))
                ok.append(self.den * common >= self.num * (len(x) + len(y) - common))
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))


def _blocks(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """(token, sig, n, size): classes per shared shingle, blocks with equal members once."""
    by = Window.partitionBy("token")
    once = F.lag("sig").over(by.orderBy("sig"))
    rows = rows.withColumn("_p", once).filter("_p IS NULL OR _p <> sig").drop("_p")
    rows = rows.select(
        "*", F.count(F.lit(1)).over(by).alias("size"), F.bit_xor(F.xxhash64("sig")).over(by).alias("s1"),
        F.bit_xor(F.xxhash64("sig", F.lit(1))).over(by).alias("s2")).filter("size > 1")
    rows = scratch.stored(rows, "shared")
    kept = rows.groupBy("s1", "s2", "size").agg(F.min("token").alias("token")).select("token")
    blocks = scratch.stored(rows.drop("s1", "s2").join(kept, "token", "left_semi"), "blocks")
    scratch.drop("shared")
    return blocks


def _candidates(blocks: DataFrame, classes: DataFrame, comps: DataFrame | None, rule: Rule, search: str) -> DataFrame:
    """Distinct pairs (a, b) left by ``search`` in all blocks."""
    info = classes.select("sig", "bits")
    if comps is None:
        info = info.withColumn("comp", F.col("sig"))
    else:
        info = info.join(comps.select(F.col("node").alias("sig"), "root"), "sig", "left").select(
            "sig", "bits", F.coalesce("root", "sig").alias("comp"))
        live = (blocks.join(info.select("sig", "comp"), "sig").groupBy("token")
                .agg(F.min("comp").alias("x"), F.max("comp").alias("y")).filter("x <> y").select("token"))
        blocks = blocks.join(live, "token", "left_semi")
    # parts of a large block meet pairwise: a row goes to the pairs its part is in
    parts = F.ceil(F.col("size") / BLOCK).cast("int")
    d = blocks.withColumn("part", F.pmod(F.xxhash64("sig"), parts).cast("int"))
    other = F.explode(F.sequence(F.lit(0), parts - 1))
    d = d.withColumn("o", other).select(
        "token", "sig", "n", "part", F.least("part", "o").alias("i"), F.greatest("part", "o").alias("j"))
    d = d.join(info, "sig")
    spark = d.sparkSession
    d = (d.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "token", "i", "j")
         .sortWithinPartitions("token", "i", "j", "n", F.xxhash64("sig", "token")))
    return d.mapInArrow(rule.block_pairs(search), "a long, b long").distinct()


def _verify(pairs: DataFrame, docs: DataFrame, classes: DataFrame, rule: Rule, scratch: Scratch) -> DataFrame:
    """Pairs (u, v) whose whole sets link, written; only classes that are in a pair have their sets rebuilt from the text."""
    one, two = (classes.select(F.col("sig").alias(c), F.col("n").alias(f"n{c}"), F.col("wide").alias(f"w{c}")) for c in "ab")
    pairs = scratch.stored(pairs.join(one, "a").join(two, "b").select("a", "b", "na", "nb", "wa", "wb")
                           .mapInArrow(rule.wide_possible, "a long, b long"), "pairs")
    asked = pairs.select(F.col("a").alias("sig")).unionByName(pairs.select(F.col("b").alias("sig"))).distinct()
    wanted = scratch.stored(classes.join(asked, "sig").select("sig", "_id", "_h"), "wanted")
    if wanted.count() <= BROADCAST_ROWS:
        wanted = F.broadcast(wanted)
    sets = scratch.stored(
        docs.join(wanted, (F.col("h") == F.col("_h")) & F.col("id").eqNullSafe(F.col("_id")))
        .select("sig", "text").mapInArrow(rule.whole_sets, "sig long, shingles binary"), "sets")
    one = sets.select(F.col("sig").alias("a"), F.col("shingles").alias("sa"))
    two = sets.select(F.col("sig").alias("b"), F.col("shingles").alias("sb"))
    links = scratch.stored(
        pairs.join(one, "a").join(two, "b").select("a", "b", "sa", "sb")
        .mapInArrow(rule.linked, "a long, b long").select(F.col("a").alias("u"), F.col("b").alias("v")), "links")
    scratch.drop("pairs", "wanted", "sets")
    return links


def group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rule: Rule | None = None,
          scratch: Scratch | None = None) -> DataFrame:
    """Per row: id, n_shingles, component_id, text_hash, component.

    ``component`` is the component's own key (its smallest class; null for an empty set): ids may be null or repeat.
    """
    rule = rule or Rule()
    scratch = scratch or Scratch(docs.sparkSession, "jaccard")
    d = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("h"), F.col(text_col).alias("text"))
    scanned = scratch.stored(d.mapInArrow(rule.profile, "kind int, id long, h long, n long, sig long, bits binary, wide binary"), "profiles")
    rows = scanned.filter("kind = 0 AND n > 0")
    often = (scanned.filter("kind = 1").groupBy("sig").agg(F.sum("n").alias("n"))
             .orderBy(F.col("n").desc(), "sig").limit(OFTEN_MOST).select("sig").collect())
    often = np.sort(np.array([r["sig"] for r in often], dtype=np.int64).view(np.uint64))

    blocks = _blocks(d.select("text").mapInArrow(rule.prefixes(often), "token long, sig long, n long"), scratch)
    classes = scratch.stored(rows.groupBy("sig").agg(
        F.min(F.struct("id", "h")).alias("one"), F.min("id").alias("least"), F.first("n").alias("n"),
        F.first("bits").alias("bits"), F.first("wide").alias("wide"),
    ).select("sig", "n", F.col("one.id").alias("_id"), F.col("one.h").alias("_h"), "least", "bits", "wide"), "classes")

    # first the next two in each block, so that most of a large group is one component before the full traversal
    near = _verify(_candidates(blocks, classes, None, rule, "neighbours"), d, classes, rule, scratch)
    comps = scratch.stored(components(near, scratch), "comps")
    scratch.drop("links", "cc")
    far = _verify(_candidates(blocks, classes, comps, rule, "traverse"), d, classes, rule, scratch)
    comps = components(comps.select(F.col("node").alias("u"), F.col("root").alias("v")).unionByName(far), scratch)
    scratch.drop("blocks", "links", "comps")

    of_class = classes.select("sig", "least").join(comps.withColumnRenamed("node", "sig"), "sig", "left")
    least = of_class.filter("root IS NOT NULL").groupBy("root").agg(F.min("least").alias("all_least"))
    of_class = of_class.join(least, "root", "left").select(
        "sig", F.coalesce("all_least", "least").alias("component_id"), F.coalesce("root", "sig").alias("component"))
    full = rows.select("id", "h", "n", "sig").join(of_class, "sig").select("id", "h", "n", "component_id", "component")
    empty = scanned.filter("kind = 0 AND n = 0").select(
        "id", "h", "n", F.col("id").alias("component_id"), F.lit(None).cast("long").alias("component"))
    return full.unionByName(empty).select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id",
                                          F.col("h").alias("text_hash"), "component")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rule: Rule | None = None) -> DataFrame:
    """The rows of ``docs``, all columns, that stay: of every component the document with the smallest id.

    Documents without a set all stay; rows that repeat id and text stay once.
    """
    scratch = Scratch(docs.sparkSession, "jaccard")
    found = group(docs, id_col, text_col, rule, scratch)
    whole = found.filter("n_shingles > 0").groupBy("component").agg(
        F.min(F.struct(F.col(id_col).isNull(), F.col(id_col).alias("id"), F.col("text_hash").alias("h"))).alias("k"))
    stay = whole.select("k.id", "k.h").unionByName(
        found.filter("n_shingles = 0").select(F.col(id_col).alias("id"), F.col("text_hash").alias("h")).distinct())
    # plain equal keys without nulls: rows dealt out for the join lie right for dropping repeats, so texts move once
    def keys(key: Column, h: Column) -> list[Column]:
        return [F.coalesce(key, F.lit(0).cast("long")).alias("key"), key.isNull().alias("none"), h.alias("hash")]

    stay = scratch.stored(stay.select(*keys(F.col("id"), F.col("h"))), "stay")
    scratch.drop("profiles", "classes", "cc")
    d = docs.select(whole_row(docs), *keys(F.col(id_col).cast("long"), F.xxhash64(text_col)))
    return d.join(stay, ["key", "none", "hash"], "left_semi").dropDuplicates(["key", "none", "hash"]).select("row.*")


def op10_jaccard_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group(table(spark, sf_dir, "documents")).drop("text_hash", "component")
