"""Connected components: right roots, no round where there is nothing to do, no table read once for each end."""

import random

from tarmac.llm.common import Scratch
from tarmac.llm.components import _star, components


class Counted(Scratch):
    def __init__(self, spark):
        super().__init__(spark, "counted")
        self.written = 0

    def stored(self, df, name):
        self.written += 1
        return super().stored(df, name)


def edges(spark, pairs):
    return spark.createDataFrame(pairs, "u long, v long")


def found(spark, pairs, scratch=None):
    rows = [tuple(r) for r in components(edges(spark, pairs), scratch).collect()]
    assert len(rows) == len(set(rows))
    return sorted(rows)


def by_hand(pairs):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for u, v in pairs:
        if u is not None and v is not None and u != v:
            a, b = find(u), find(v)
            root[max(a, b)] = min(a, b)
    return sorted((x, find(x)) for x in root)


def test_components_equal_union_find(spark):
    rnd = random.Random(5)
    path = [(i, i + 1) for i in range(40)]
    hubs = [(1000, 1000 + i) for i in range(1, 50)] + [(2050, 2000 + i) for i in range(50)] + [(1049, 2000)]
    loose = [(rnd.randint(-300, -1), rnd.randint(-300, -1)) for _ in range(150)]
    pairs = path + hubs + loose + loose[:20] + [(v, u) for u, v in loose[20:40]] + [(7, 7), (5000, 5000), (None, 3), (3, None), (None, None)]
    rnd.shuffle(pairs)
    assert found(spark, pairs) == by_hand(pairs)
    assert found(spark, []) == []


def test_stars_take_no_round_and_none_is_run_to_see_that_nothing_changes(spark):
    scratch = Counted(spark)
    stars = [(5, i) for i in range(6, 30)] + [(i, 40) for i in range(41, 60)] + [(5, 6), (6, 5)]
    assert found(spark, stars, scratch) == by_hand(stars)
    assert scratch.written == 1  # the edges alone
    scratch = Counted(spark)
    assert found(spark, [(1, 2), (2, 3)], scratch) == [(1, 1), (2, 1), (3, 1)]
    assert scratch.written == 2


def test_a_round_reads_a_table_in_one_go_for_both_ends(spark, tmp_path):
    edges(spark, [(2, 1), (3, 2)]).write.parquet(f"{tmp_path}/edges")
    e = spark.read.parquet(f"{tmp_path}/edges")
    plan = _star(_star(e, True), False)._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in plan
    assert plan.count("Join") == 3  # the large star stands in the plan twice, and is computed once
