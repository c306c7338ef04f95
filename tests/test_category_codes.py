"""Dense category codes by range ranks, against a sort on the driver of a small table."""

import random

from riskspark.operators import features


def test_codes_by_ranges_equal_sorted_values(spark):
    rng = random.Random(3)
    rows = [(i, f"v{rng.randrange(5000):05d}" if i % 11 else None, rng.choice(["a", "b", "hot", "hot", "hot"])) for i in range(20000)]
    df = spark.createDataFrame(rows, "id long, big string, hot string")
    for small in (0, 10**9):  # by ranges, and by one window where the dictionary is small
        got = {(r.id, r.name): (r.value, r.code) for r in features.coded_cells(df, ["id"], ["big", "hot"], small=small).collect()}
        codes = {c: {v: k for k, v in enumerate(sorted({r[j] for r in rows if r[j] is not None}))} for j, c in ((1, "big"), (2, "hot"))}
        want = {(r[0], c): (r[j], codes[c][r[j]] if r[j] is not None else -1) for r in rows for j, c in ((1, "big"), (2, "hot"))}
        assert got == want
