import random

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from tessera.operators.dictionary import grow_ids
from tessera.sources import files

SCHEMA = "file int, line int, key string"


def first_seen(steps):
    ids = {}
    for rows in steps:
        for _, _, key in sorted(rows, key=lambda r: r[:2]):
            if key is not None:
                ids.setdefault(key, len(ids))
    return ids


def grown(spark, steps, parts):
    known = None
    for rows in steps:
        df = spark.createDataFrame(rows, SCHEMA).repartition(parts)
        known = grow_ids(known, df, "key", "id", F.struct("file", "line")).checkpoint()
    return known


@pytest.mark.parametrize("parts", [1, 7])
def test_ids_follow_first_positions_and_old_ones_stay(spark, parts):
    rnd = random.Random(2)
    steps = [[(f, n, rnd.choice([None, "hot"] + [f"w{rnd.randint(0, 40 * (step + 1))}"] * 3))
              for f in range(3) for n in range(60)] for step in range(3)]
    want = first_seen(steps)
    rows = grown(spark, steps, parts).collect()
    assert {r["key"]: r["id"] for r in rows} == want and len(rows) == len(want)
    assert sorted(want.values()) == list(range(len(want)))
    before = first_seen(steps[:1])
    assert all(want[key] == at for key, at in before.items()) and len(before) < len(want)


def test_nothing_new_and_nothing_at_all(spark):
    one = [(0, 0, "b"), (0, 1, "a")]
    assert {r["key"]: r["id"] for r in grown(spark, [one, one, []], 2).collect()} == {"b": 0, "a": 1}
    assert {r["key"]: r["id"] for r in grown(spark, [[], [(0, 0, None)], one], 2).collect()} == {"b": 0, "a": 1}
    tied = grown(spark, [[(0, 0, "z"), (0, 0, "y"), (0, 0, "x")]], 3)       # equal positions: by key
    assert {r["key"]: r["id"] for r in tied.collect()} == {"x": 0, "y": 1, "z": 2}


@pytest.mark.parametrize("text, kept, lost", [("1,a\nbad\n2,b,c\n\n", 2, 2), ("bad\nworse\n", 0, 2), ("1,a\n2,b\n", 2, 0)])
def test_rejected_baskets_are_counted_in_the_same_scan(spark, tmp_path, text, kept, lost):
    path = tmp_path / "baskets.txt"
    path.write_text(text)
    seen = Observation()
    df = files.read_basket_lines(spark, str(path), 3, rejects=seen)
    assert df._jdf.queryExecution().executedPlan().toString().count("FileScan text") == 1
    assert len(df.collect()) == kept
    assert seen.get == {"lines": kept + lost, "rejected": lost}
    assert files.count_rejected_baskets(spark, str(path)) == lost
    assert sorted(files.read_basket_lines(spark, str(path)).collect()) == sorted(df.collect())


@pytest.mark.parametrize("rows, lost", [("a,b,4.5\na,c,x\nb,b,\n", 2), ("a,b,no\n", 1), ("a,b,1\n", 0), ("", 0)])
def test_rejected_ratings_are_counted_in_the_same_scan(spark, tmp_path, rows, lost):
    path = tmp_path / "ratings.csv"
    path.write_text("user_id,business_id,stars\n" + rows)
    seen = Observation()
    df = files.read_ratings_csv(spark, str(path), rejects=seen)
    assert df._jdf.queryExecution().executedPlan().toString().count("FileScan csv") == 1
    n = df.count()
    assert seen.get == {"lines": n + lost, "rejected": lost} and n + lost == rows.count("\n")
