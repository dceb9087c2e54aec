from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from riskflow.plans import lookup, ordering, shared


def test_running_sums_match_brute_force(spark):
    draw = random.Random(5)
    rows = [(draw.choice("ab"), i, draw.randrange(9)) for i in range(500)]
    draw.shuffle(rows)
    df = spark.createDataFrame(rows, "g string, o int, n bigint").repartition(7)
    out = ordering.running_sums(df, [F.desc("o")], {"upto": "n"}, ["g"], {"all_n": "n"})
    expected = {}
    for g in "ab":
        total = 0
        for _, o, n in sorted((r for r in rows if r[0] == g), key=lambda r: -r[1]):
            total += n
            expected[g, o] = total
    got = out.collect()
    assert {(r["g"], r["o"]): r["upto"] for r in got} == expected
    assert {(r["g"], r["all_n"]) for r in got} == {(g, sum(n for h, _, n in rows if h == g)) for g in "ab"}


def test_positions_in_groups_with_a_null_group(spark):
    rows = [(None if i % 5 == 0 else "x" if i % 3 else "y", i) for i in range(300)]
    df = spark.createDataFrame(rows, "g string, o int").repartition(5)
    for few in (True, False):
        got = ordering.with_positions(df, ["o"], ["g"], few_groups=few, size="size").collect()
        assert len(got) == 300
        for g in (None, "x", "y"):
            members = sorted(o for h, o in rows if h == g)
            mine = sorted((r["o"], r["position"]) for r in got if r["g"] == g)
            assert mine == [(o, i) for i, o in enumerate(members)]
            assert {r["size"] for r in got if r["g"] == g} == {len(members)}


def test_positions_use_no_single_task_over_rows(spark, plan):
    df = ordering.with_positions(spark.range(1000), ["id"])
    text = plan(df)
    assert text.count("SinglePartition") <= 1  # the summary of the stretches


def test_positions_of_nothing(spark):
    assert ordering.with_positions(spark.range(0), ["id"]).count() == 0


@pytest.mark.parametrize("limit", [None, 0])
@pytest.mark.parametrize("weight", ["n", None])
def test_lookup_keeps_every_row_once(spark, limit, weight):
    rows = [(i, None if i % 7 == 0 else i % 4, "p" if i % 2 else None) for i in range(2000)]
    df = spark.createDataFrame(rows, "id int, a int, b string").repartition(6)
    keys = [(a, b, 1000 if a == 1 else 1, a * 10) for a in range(3) for b in ("p", "q")]
    table = shared.materialize(spark.createDataFrame(keys, "ka int, kb string, n bigint, v int"), "keys")
    out = lookup.lookup_join(df, table, [("a", "ka"), ("b", "kb")], ["v"], weight=weight, max_rows=limit)
    assert out.columns == ["id", "a", "b", "v"]
    got = {r["id"]: r["v"] for r in out.collect()}
    assert out.count() == 2000 and len(got) == 2000
    for i, a, b in rows:
        assert got[i] == (a * 10 if a in (0, 1, 2) and b == "p" else None)


def test_measure(spark):
    table = spark.createDataFrame([(1, "abc", 5), (2, None, 6)], "k int, s string, n bigint")
    size = lookup.measure(table, "n")
    assert (size.rows, size.weight) == (2, 11)
    assert size.fits() and not size.fits(max_rows=1) and not size.fits(max_bytes=10)


def test_shared_folder_is_the_clusters(spark):
    named = spark.conf.get("spark.checkpoint.dir", "")
    if named:
        assert shared.shared_folder(spark) == named.rstrip("/")
    assert shared.new_path(spark, "x") != shared.new_path(spark, "x")


def test_a_long_summary_is_stored_not_fetched(spark, monkeypatch):
    from riskflow.plans import ordering

    monkeypatch.setattr(ordering, "MAX_FETCHED", 3)
    rows = spark.range(40).select("id", (F.col("id") % 11).alias("g"))
    got = ordering.with_positions(rows, ["id"], ["g"], few_groups=True).collect()
    assert all(r["position"] == r["id"] // 11 for r in got) and len(got) == 40


def test_working_tables_go_and_lasting_ones_stay(spark):
    import threading

    from riskflow.plans.shared import file_system, materialize, new_path, working_tables

    def there(df):
        path = df.inputFiles()[0].rsplit("/", 1)[0]
        fs, p = file_system(spark, path)
        return fs.exists(p)

    rows = spark.range(3)
    with working_tables(spark):
        outer = materialize(rows, "outer")
        with working_tables(spark):
            inner, kept = materialize(rows, "inner"), materialize(rows, "kept", lasting=True)
            names = [outer.inputFiles(), inner.inputFiles(), kept.inputFiles()]
            elsewhere = []
            worker = threading.Thread(target=lambda: elsewhere.append(new_path(spark, "x")))
            worker.start()
            worker.join()
        assert [there(outer), there(kept)] == [True, True] and not there(inner)
    assert "work-" not in names[2][0] and "work-" not in elsewhere[0] and kept.count() == 3
    assert not there(outer)
    with pytest.raises(ZeroDivisionError):
        with working_tables(spark):
            lost = materialize(rows, "lost")
            1 / 0
    assert not there(lost)
