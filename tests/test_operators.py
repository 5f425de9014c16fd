import random
from collections import defaultdict
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from chartloom.operators import relational as rel
from chartloom.operators.nesting import Nested, first_row, last_row, nest, nest_list, nest_set, one_per_day
from chartloom.operators.windows import latest_n


def values(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_flags(rows):
    for off, on, kind in ((False, True, "boolean"), (0, 1, "int")):
        df = rows(f"id int, voided {kind}", (1, off), (2, on), (3, None))
        assert values(rel.not_voided(df).select("id")) == [(1,), (3,)]
        assert values(rel.not_voided(df, null_is_live=False).select("id")) == [(1,)]
        assert values(rel.preferred(df, "voided").select("id")) == [(2,)]


def test_projection_helpers(rows):
    df = rows("a int, b string", (1, None))
    assert rel.project(df, {"b": "x", "a": "y"}).columns == ["x", "y"]
    assert values(rel.fill_strings(df)) == [(1, "")]
    dated = rel.ensure_build_date(df, F.lit("now"))
    assert rel.ensure_build_date(dated, F.lit("later")).first().build_date == "now"
    assert rel.rename_map(df, {"a": "z", "missing": "m"}).columns == ["z", "b"]


@pytest.mark.parametrize("spread", [False, True])
@pytest.mark.parametrize("small", [False, True])
def test_lookup_left_keeps_rows_without_key(rows, spread, small):
    facts = rows("id int, k int", *[(i, i % 5 if i % 3 else None) for i in range(60)])
    dim = rows("k int, name string", *[(i, f"n{i}") for i in range(3)])
    got = rel.lookup(facts, rel.Dimension(dim, small), "k", "left", prefix="d_", spread_nulls=spread)
    assert got.columns == ["id", "k", "d_name"]
    want = [(i, k, f"n{k}" if k is not None and k < 3 else None) for i in range(60) for k in [i % 5 if i % 3 else None]]
    assert values(got) == sorted(want, key=repr)


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("share", [0.5, 0.05, 0.001])
def test_lookup_hot(rows, how, share):
    keys = [None] * 30 + [1] * 40 + [2] * 10 + list(range(3, 43)) + [999]
    facts = rows("id int, k int", *enumerate(keys))
    dim = rows("key int, name string", *[(i, f"n{i}") for i in range(30)])
    got = rel.lookup_hot(facts, dim, ("k", "key"), how, share)
    found = {i: f"n{i}" for i in range(30)}
    want = [(i, k, found.get(k)) for i, k in enumerate(keys) if how == "left" or k in found]
    assert got.columns == ["id", "k", "name"] and values(got) == sorted(want, key=repr)


def test_frequent_keys(rows):
    df = rows("k string", *[("a",)] * 50, *[("b",)] * 30, *[(str(i),) for i in range(20)], *[(None,)] * 40)
    assert {"a", "b"} <= set(rel.frequent_keys(df, "k", 0.2)) and None not in rel.frequent_keys(df, "k", 0.01)


def test_lookup_in_two_roles(rows):
    facts = rows("a int, b int", (1, 2))
    dim = rows("k int, name string", (1, "x"), (2, "y"))
    got = rel.lookup(rel.lookup(facts, dim, [("a", "k")], prefix="a_"), dim, [("b", "k")], prefix="b_")
    assert values(got) == [(1, 2, "x", "y")]


def test_size_check(rows):
    df = rows("a string", *[("x" * 100,) for _ in range(50)])
    assert rel.fits_broadcast(df, 10_000) and not rel.fits_broadcast(df, 5_000)


def test_key_joins_with_nulls(rows):
    a, b = rows("k int", (1,), (2,), (None,)), rows("k int", (2,), (2,), (None,))
    for measure in (False, True):
        assert values(rel.restrict_to(a, b, "k", measure)) == [(2,)]
        assert values(rel.missing_from(a, b, "k", measure)) == [(1,), (None,)]


def test_latest_n_with_ties_prunes_before_the_shuffle(rows, capsys):
    df = rows("p int, t int, id int", *[(1, i // 4, i) for i in range(40)], *[(2, 7, i) for i in range(3)])
    got = latest_n(df.repartition(3, "id"), "p", "t", 10, tiebreak="id")
    assert values(got) == sorted([(1, i // 4, i) for i in range(30, 40)] + [(2, 7, i) for i in range(3)], key=repr)
    got.explain()
    assert "row_number(), 10, Partial" in capsys.readouterr().out


def test_first_last_and_day(rows):
    df = rows("k int, ts string, id int, v string", (1, "2020-01-01 10:00:00", 2, None), (1, "2020-01-01 10:00:00", 1, "b"), (1, "2020-01-02 00:00:00", 3, "c"))
    df = df.withColumn("ts", F.to_timestamp_ntz("ts"))
    assert [(r.id, r.v) for r in first_row(df, "k", ["ts", "id"]).collect()] == [(1, "b")]
    assert [(r.id, r.v) for r in last_row(df, "k", ["ts", "id"]).collect()] == [(3, "c")]
    days = one_per_day(df, "ts", ["v"], by=["k"], tiebreak=["id"])
    assert sorted(r.v for r in days.collect()) == ["b", "c"]


# -- nesting ----------------------------------------------------------------------------------


def brute_force(data, key, element, distinct):
    groups = defaultdict(list)
    for row in data:
        groups[row[key]].append(tuple(row[i] for i in element))
    return {k: sorted(set(v) if distinct else v, key=repr) for k, v in groups.items()}


def put_together(df, name):
    found = defaultdict(list)
    for row in df.collect():
        found[row["k"]] += [tuple(x) for x in row[name]]
    return {k: sorted(v, key=repr) for k, v in found.items()}


@pytest.fixture(scope="module")
def skewed():
    """A third of the rows in one key, a third copies of one row, NULL keys, small groups."""
    random.seed(1)
    data = [(1, i, i % 7) for i in range(1000)]
    data += [(2, 5, 5)] * 1000
    data += [(random.randrange(3, 60), random.randrange(9), random.randrange(3)) for _ in range(900)]
    data += [(None, i, 0) for i in range(120)]
    return data


@pytest.mark.parametrize("part_rows", [10, 100, 10_000])
@pytest.mark.parametrize("distinct", [True, False])
def test_nested_groups_are_whole_and_parts_are_bounded(rows, skewed, part_rows, distinct):
    df = rows("k int, a int, b int", *skewed)
    fields = {"a": "a", "b": "b"}
    if distinct:
        got = nest_set(df, "k", fields, "x", part_rows=part_rows)
    else:
        got = nest_list(df, "k", fields, ["a"], "x", part_rows=part_rows)
    got = got.persist()
    assert put_together(got, "x") == brute_force(skewed, 0, (1, 2), distinct)
    sizes = [len(r.x) for r in got.collect()]
    assert max(sizes) <= part_rows
    keys = [(r.k, r.part) for r in got.collect()]
    assert len(keys) == len(set(keys)) and {k for k, p in keys if p == 0} == {r[0] for r in skewed}
    if part_rows == 10_000:
        assert all(p == 0 for _, p in keys)
    if distinct and part_rows == 100:
        # a thousand copies of one element are no large set
        assert [p for k, p in keys if k == 2] == [0]
    # The parts of a group, one after another, are the whole array in order, filled from the front.
    by_key = {}
    for r in sorted(got.collect(), key=lambda r: r.part):
        by_key.setdefault(r.k, []).append([tuple(x) for x in r.x])
    for key, parts in by_key.items():
        assert all(len(p) == part_rows for p in parts[:-1])
        own = [(a, b) for k, a, b in skewed if k == key]
        assert [x for p in parts for x in p] == sorted(set(own) if distinct else own)
    got.unpersist()


def test_a_crowded_key_leaves_the_others_as_they_are(rows, skewed):
    df = rows("k int, a int, b int", *skewed)
    fields = {"a": "a", "b": "b"}
    few = nest_list(df.where("k > 2"), "k", fields, ["a"], "x", part_rows=200)
    all_ = nest_list(df, "k", fields, ["a"], "x", part_rows=200)
    assert all_.where("part > 0").count() > 0
    assert values(few) == values(all_.where("k > 2"))


def test_nested_list_is_ordered(rows):
    df = rows("k int, o int, v string", (1, 2, "b"), (1, 1, "z"), (1, 2, "a"), (1, None, "n"))
    got = nest_list(df, "k", F.col("v"), ["o"], "x").first()
    assert got.x == ["n", "z", "a", "b"]


def test_condition_leaves_an_empty_array(rows):
    df = rows("k int, v int", (1, None), (2, 5), (2, None), (2, 5))
    got = nest_set(df, "k", F.struct("v"), "x", when=F.col("v").isNotNull())
    assert values(got.select("k", F.size("x"))) == [(1, 0), (2, 1)]


@pytest.mark.parametrize("part_rows", [2, 1000])
def test_several_arrays_and_first_values(rows, part_rows):
    df = rows(
        "k int, name string, a int, b int",
        *[(1, "n1" if a else "n0", a, b) for a in range(5) for b in range(3)],
        (2, None, 1, 1),
    )
    arrays = [Nested("as", F.struct("a")), Nested("bs", F.struct("b"))]
    got = nest(df, "k", arrays, {"name": "name"}, ["name"], part_rows)
    found = put_together(got, "as"), put_together(got, "bs")
    assert found[0] == {1: [(i,) for i in range(5)], 2: [(1,)]}
    assert found[1] == {1: [(i,) for i in range(3)], 2: [(1,)]}
    assert {(r.k, r.name) for r in got.collect()} == {(1, "n0"), (2, None)}


def test_a_cheaper_bound_gives_the_same(rows, skewed):
    df = rows("k int, a int, b int", *skewed)
    plain = nest_list(df, "k", F.struct("a", "b"), name="x", part_rows=50)
    bounded = nest_list(df, "k", F.struct("a", "b"), name="x", part_rows=50, large=True)
    assert put_together(plain, "x") == put_together(bounded, "x")


def test_one_day_is_spread(rows):
    from chartloom.operators import nesting

    day = datetime(2020, 1, 1)
    df = rows("k int, t timestamp, v string", *[(1, day, f"the same beginning {i:05}") for i in range(3000)])
    array = Nested("x", F.struct("t", "v"), distinct=False, order_by=("t",))
    piles = nesting._counted(df, ["k"], array)
    (row,) = nesting._borders(piles, ["k"], 80).collect()
    entries = [b["e"]["v"] for b in row["__borders"]]
    assert 100 <= len(entries) <= nesting.RANGES and entries == sorted(entries)
    got = nest_list(df, "k", F.struct("v"), ["t"], "x", part_rows=80).orderBy("part").collect()
    assert [e.v for r in got for e in r.x] == [f"the same beginning {i:05}" for i in range(3000)]
    assert [len(r.x) for r in got] == [80] * 37 + [40]


@pytest.mark.parametrize("task_rows", [0, 100, 10_000])
@pytest.mark.parametrize("large", [None, True])
def test_groups_of_a_task_are_cut_and_larger_ones_ranked(rows, skewed, monkeypatch, task_rows, large):
    from chartloom.operators import nesting

    made = []
    monkeypatch.setattr(nesting, "TASK_ROWS", task_rows)
    monkeypatch.setattr(nesting, "written", lambda df, label, own=nesting.written: made.append(label) or own(df, label))
    df = rows("k int, a int, b int", *skewed)
    arrays = [Nested("x", F.struct("a", "b"), distinct=False, order_by=("a",)), Nested("y", F.struct("b"))]
    got = {}
    for r in nest(df, "k", arrays, {"least": "a"}, ["a"], part_rows=30, large=large).collect():
        got.setdefault(r.k, {})[r.part] = (r.least, [tuple(e) for e in r.x], [e.b for e in r.y])
    for key, parts in got.items():
        own = sorted((a, b) for k, a, b in skewed if k == key)
        assert sorted(parts) == list(range(len(parts)))
        assert {p[0] for p in parts.values()} == {own[0][0]}
        assert [parts[p][1] for p in sorted(parts)] == [own[i : i + 30] for i in range(0, len(own), 30)]
        ys = sorted({b for _, b in own})
        assert [parts[p][2] for p in sorted(parts)][: len(ys) // 30 + 1] == [ys[i : i + 30] for i in range(0, len(ys) // 30 * 30 + 1, 30)]
    assert got.keys() == {k for k, _, _ in skewed}
    # Groups that fit a task are neither ranked nor written down.
    assert ("array-parts" in made) == (task_rows < 10_000)
    assert made == [] or task_rows < 10_000 or large
