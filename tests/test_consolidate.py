"""Components of overlapping files, and consolidation that shuffles only what can have copies."""

import datetime as dt
import random

import pytest

from senslake.operators import consolidate as cons

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "file_key string, device_id string, datetime timestamp_ntz, value double, note string"


def rows(rng, files):
    out = []
    for device, key, first, n, step in files:
        for i in range(n):
            out.append((key, device, T0 + dt.timedelta(seconds=first + i * step), float(rng.randrange(2)), rng.choice([None, "a"])))
    return out


@pytest.fixture(scope="module")
def chunks(spark):
    rng = random.Random(4)
    data = rows(rng, [("a", "a_01-Jan-2024", 0, 20, 60), ("a", "a_02-Jan-2024", 5000, 20, 60), ("a", "a_03-Jan-2024", 6140, 5, 60),  # touches the one before
                      ("a", "a_09-Jan-2024", 90000, 30, 7000), ("b", "b_01-Jan-2024", 0, 20, 60), ("b", "b_x", 30, 40, 30),
                      (None, "odd", 0, 10, 60), (None, None, 90, 4, 30), ("c", "c_twice", 0, 10, 0), ("d", "d_long", 0, 5, 10), ("d", "d_in", 20, 1, 1), ("d", "d_after", 41, 3, 1)])
    data += [("e_1", "e", None, 1.0, None), ("e_1", "e", None, 1.0, None), ("e_2", "e", None, 1.0, None), ("e_2", "e", T0, 2.0, None)]
    data += [("f_half", "f", T0 + dt.timedelta(microseconds=m), 1.0, "x") for m in (0, 500000)]
    data += [("g_old", "g", dt.datetime(1969, 12, 31, 23, 59, s), 1.0, "x") for s in (58, 59)] + [("g_new", "g", dt.datetime(1970, 1, 1), 1.0, "x")]
    return spark.createDataFrame(data, SCHEMA).repartition(3)


def test_components(chunks):
    got = {(r["device_id"], r["file_key"]): r for r in cons.overlap_components(cons.file_ranges(chunks)).collect()}
    part = {k: (r["component"], r["alone"], r["distinct_times"]) for k, r in got.items()}
    assert [part["a", f"a_0{d}-Jan-2024"] for d in (1, 2, 3, 9)] == [(1, True, True), (2, False, True), (2, False, True), (3, True, True)]
    assert part["b", "b_01-Jan-2024"][:2] == part["b", "b_x"][:2] == (1, False)
    assert part[None, "odd"][:2] == part[None, None][:2] == (1, False)
    assert part["c", "c_twice"] == (1, True, False) and part["f", "f_half"] == (1, True, False)
    assert part["d", "d_long"][:2] == part["d", "d_in"][:2] == (1, False) and part["d", "d_after"][:2] == (2, True)
    assert part["e", "e_1"] == (0, False, False) and part["e", "e_2"] == (1, True, False)
    assert part["g", "g_old"] == (1, True, True) and part["g", "g_new"] == (2, True, True)
    assert got["a", "a_09-Jan-2024"]["rows"] == 30


def test_equals_consolidation_of_everything(spark, chunks):
    a = cons.consolidate_overlaps(chunks, ["value", "note"])
    b = cons.consolidate(chunks, ["value", "note"]).select(*a.columns)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0 and a.count() > 100
    empty = cons.consolidate_overlaps(spark.createDataFrame([], SCHEMA), ["value", "note"])
    assert empty.columns == a.columns and empty.count() == 0


def test_files_that_pass_are_not_exchanged(spark, tmp_dir):
    """The branch of the passing rows reaches the result from its scan over a broadcast join alone."""
    data = rows(random.Random(1), [("a", f"a_0{d}-Jan-2024", d * 86400, 50, 60) for d in range(1, 9)])
    spark.createDataFrame(data, SCHEMA).write.parquet(f"{tmp_dir}/x")
    out = cons.consolidate_overlaps(spark.read.parquet(f"{tmp_dir}/x"), ["value", "note"])
    plan = out._jdf.queryExecution().executedPlan().initialPlan().toString()
    union = plan[plan.index("Union"):].splitlines()
    second = next(i for i, x in enumerate(union) if x.startswith("+- "))
    assert any("BroadcastHashJoin" in x for x in union[1:second]) and not any("Exchange hashpartitioning" in x for x in union[1:second])
    assert any("Exchange hashpartitioning" in x for x in union[second:])
    assert out.count() == 400
