"""Sharding by balanced label propagation (DataFrame operations only).

Documents are linked when their texts are equal.  Every document starts in
the shard given by a hash of its id.  In each round a joint count of (group,
shard) gives every document its neighbours' shards; documents move to the
shard where most of their neighbours are, as far as that shard's quota has
room, and the next round starts from there.  Documents without links have no
edge to cut, so they fill what the quotas leave.  The law is ``rows``: shard
sizes in rows differ by one at most.

Documents of one group and shard are interchangeable, so the rounds work on
counts per (group, shard), at most ``shards`` rows per group, never on pairs.
A group larger than a shard's quota is cut into as few shards as have room.
A group's documents are numbered inside ``BUCKETS`` hash buckets of their
ids, so the documents of a group that holds a third of all rows are spread
over that many tasks.

Defined results: a null text counts as empty text (one group, size 1);
repeated rows are documents of their own; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tarmac.llm.common import bucketed_rank, stored, table

SHARDS = 8
BUCKETS = 256  # a multiple of any shard count used
ROUNDS = 8


def _quotas(n: int, shards: int) -> list[int]:
    return [n // shards + (s < n % shards) for s in range(shards)]


def _loads(cells: DataFrame, shards: int) -> list[int]:
    """Linked documents per shard: ``shards`` numbers."""
    got = {r["s"]: r["n"] for r in cells.groupBy("s").agg(F.sum("n").alias("n")).collect()}
    return [got.get(s, 0) for s in range(shards)]


def _longs(xs: list[int]) -> Column:
    return F.array(*[F.lit(x).cast("long") for x in xs])


def _before(df: DataFrame, key: str, name: str) -> DataFrame:
    """Rows' ``n`` summed over the rows of the same ``key`` that come earlier, in two levels."""
    d = df.withColumn("_b", F.pmod(F.xxhash64("gid"), F.lit(BUCKETS)))
    w = Window.partitionBy(key).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    sums = (d.groupBy(key, "_b").agg(F.sum("n").alias("_n"))
            .withColumn("_off", F.coalesce(F.sum("_n").over(w), F.lit(0))).drop("_n"))
    inside = Window.partitionBy(key, "_b").orderBy("gid", "s").rowsBetween(Window.unboundedPreceding, -1)
    return (d.withColumn("_in", F.coalesce(F.sum("n").over(inside), F.lit(0)))
            .join(F.broadcast(sums), [key, "_b"])  # at most shards x BUCKETS rows
            .withColumn(name, F.col("_off") + F.col("_in")).drop("_b", "_off", "_in"))


def _round(cells: DataFrame, room: list[int]) -> DataFrame:
    """Each cell's rows wish to go to the fullest shard of their group that they may enter; quotas decide."""
    spots = F.transform(F.collect_list(F.struct("n", "s")), lambda c: F.struct(
        c["n"].alias("n"), (-c["s"]).alias("neg"), F.get(_longs(room), c["s"]).alias("room")))
    groups = cells.groupBy("gid").agg(spots.alias("spots"))
    best = F.array_max(F.filter("spots", lambda c: c["room"] > 0))
    wish = (cells.join(groups.select("gid", best.alias("best")), "gid")
            .withColumn("t", F.when((F.col("best.n") > F.col("n"))
                                    | ((F.col("best.n") == F.col("n")) & (-F.col("best.neg") < F.col("s"))),
                                    -F.col("best.neg")))
            .select("gid", "s", "n", "t"))
    movers = _before(wish.filter("t IS NOT NULL"), "t", "before")
    ok = F.greatest(F.lit(0), F.least("n", F.get(_longs(room), F.col("t")) - F.col("before")))
    moved = movers.select("gid", "s", "n", "t", ok.cast("long").alias("m"))
    return (
        moved.select("gid", F.explode(F.array(
            F.struct(F.col("t").alias("s"), F.col("m").alias("n"), F.col("m").alias("moved")),
            F.struct("s", (F.col("n") - F.col("m")).alias("n"), F.lit(0).cast("long").alias("moved")))).alias("c"))
        .select("gid", "c.*")
        .unionByName(wish.filter("t IS NULL").select("gid", "s", "n", F.lit(0).cast("long").alias("moved")))
        .filter("n > 0")
        .groupBy("gid", "s").agg(F.sum("n").alias("n"), F.sum("moved").alias("moved"))
    )


def _relieve(cells: DataFrame, loads: list[int], quotas: list[int]) -> DataFrame:
    """Shards above their quota (possible when nearly every document is linked) hand the excess to those below."""
    excess = [max(0, a - q) for a, q in zip(loads, quotas)]
    need, spans, at = sum(excess), [], 0
    for s, (a, q) in enumerate(zip(loads, quotas)):
        take = min(max(0, q - a), need - at)
        spans.append((s, at, at + take))
        at += take
    base = [sum(excess[:s]) for s in range(len(excess))]
    d = _before(cells.select("gid", "s", "n"), "s", "before")
    ex, b0 = F.get(_longs(excess), F.col("s")), F.get(_longs(base), F.col("s"))
    d = d.withColumn("out", F.greatest(F.lit(0), F.least("n", ex - F.col("before")))).withColumn("lo", b0 + F.col("before"))
    cut = lambda lo, hi: F.greatest(F.lit(0), F.least(F.col("lo") + F.col("out"), F.lit(hi)) - F.greatest("lo", F.lit(lo)))
    parts = F.array(F.struct("s", (F.col("n") - F.col("out")).cast("long").alias("n")),
                    *[F.struct(F.lit(s).alias("s"), cut(lo, hi).cast("long").alias("n")) for s, lo, hi in spans])
    return (d.select("gid", F.explode(parts).alias("c")).select("gid", "c.*").filter("n > 0")
            .groupBy("gid", "s").agg(F.sum("n").alias("n")))


def propagate(cells: DataFrame, quotas: list[int], rounds: int = ROUNDS) -> DataFrame:
    """(gid, s, n) cells of linked groups after the rounds; every round's result is written, so lineage stays short."""
    shards = len(quotas)
    loads = _loads(cells, shards)
    for _ in range(rounds):
        room = [max(0, q - a) for a, q in zip(loads, quotas)]
        after = stored(_round(cells, room), "shard-round")
        moved = after.agg(F.sum("moved")).first()[0] or 0
        cells = after.drop("moved")
        loads = _loads(cells, shards)
        if not moved:
            break
    if any(a > q for a, q in zip(loads, quotas)):
        cells = stored(_relieve(cells, loads, quotas), "shard-relieved")
    return cells


def assign(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text",
           rounds: int = ROUNDS) -> DataFrame:
    """Per document: id, size, text_crc32, law, shard, slot, grown_shard."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    h = F.xxhash64(F.col(id_col))
    base = stored(docs.select(
        F.col(id_col).alias("id"), (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("crc"), F.unhex(F.md5(text)).alias("gid"),
        F.pmod(h, F.lit(BUCKETS)).cast("int").alias("b"),
        F.pmod(F.shiftright(h, 20), F.lit(16)).cast("int").alias("c")), "shard-docs")

    of_gid = Window.partitionBy("gid")
    parts = stored(
        base.groupBy("gid", "b").agg(F.count(F.lit(1)).alias("n"))
        .withColumn("total", F.sum("n").over(of_gid))
        .withColumn("off", F.coalesce(
            F.sum("n").over(of_gid.orderBy("b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))),
        "shard-parts")
    n_docs = parts.agg(F.sum("n")).first()[0] or 0
    quotas = _quotas(n_docs, shards)
    cells = (parts.filter("total > 1").groupBy("gid", (F.col("b") % shards).alias("s")).agg(F.sum("n").alias("n")))
    cells = propagate(stored(cells, "shard-cells"), quotas, rounds)

    # a linked document's rank in its group falls into one shard's stretch
    up_to = Window.partitionBy("gid").orderBy("s")
    stretch = (cells.withColumn("hi", F.sum("n").over(up_to))
               .groupBy("gid").agg(F.sort_array(F.collect_list(F.struct("hi", "s"))).alias("stretch")))
    # documents without links fill what is left of the quotas
    left = [q - a for a, q in zip(_loads(cells, shards), quotas)]
    ends = [sum(left[: s + 1]) for s in range(shards)]
    fill = F.array(*[F.struct(F.lit(e).cast("long").alias("hi"), F.lit(s).alias("s")) for s, e in enumerate(ends)])

    d = base.join(parts.join(stretch, "gid", "left").drop("n"), ["gid", "b"])
    alone = F.col("total") == 1
    key = [F.when(~alone, F.col("gid")), F.col("b"), F.when(alone, F.col("c"))]
    d = d.withColumn("rn", F.row_number().over(Window.partitionBy(*key).orderBy("id", "size", "crc")) - 1)
    before = Window.partitionBy("k").orderBy("b", "c").rowsBetween(Window.unboundedPreceding, -1)
    singles = (base.join(parts.filter("total = 1").select("gid", "b"), ["gid", "b"], "left_semi")
               .groupBy("b", "c").agg(F.count(F.lit(1)).alias("n")).withColumn("k", F.lit(1))
               .withColumn("soff", F.coalesce(F.sum("n").over(before), F.lit(0)))
               .select("b", "c", "soff"))  # BUCKETS x 16 rows at most
    d = d.join(F.broadcast(singles), ["b", "c"], "left")
    rank = F.when(alone, F.col("soff") + F.col("rn")).otherwise(F.col("off") + F.col("rn"))
    d = d.withColumn("rank", rank).withColumn("spots", F.when(alone, fill).otherwise(F.col("stretch")))
    d = d.withColumn("shard", F.get(F.filter("spots", lambda c: F.col("rank") < c["hi"]), F.lit(0))["s"])
    d = stored(d.select("id", "size", "crc", "shard"), "shard-placed")
    return bucketed_rank(d, ["shard"], ["id", "size", "crc"], "slot").select(
        F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), F.lit("rows").alias("law"),
        F.col("shard").cast("int").alias("shard"), F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))


def op4_balanced_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign(table(spark, sf_dir, "documents"))
