"""Results that the last bit of a sum decides, against SQL run by one thread."""

import math

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq

from tempograin import registry


def compared(spark, folder, events, name):
    """Sorted rows of the query and of its SQL over events."""
    pq.write_table(events, f"{folder}/events.parquet", row_group_size=len(events))
    c = duckdb.connect(config={"threads": 1})
    c.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{folder}/events.parquet')")
    df = registry.queries()[name](spark, str(folder))
    want = c.execute(f"SELECT {', '.join(df.columns)} FROM ({registry.oracle_sql()[name]})").fetchall()
    return sorted(map(tuple, df.collect()), key=repr), sorted(want, key=repr)


def test_beats_of_equal_chains(spark, tmp_path):
    """Coarse strengths give many chains of one score; users without spread, or with values that are no finite
    numbers, have a beat at their first step; a spread may be however small."""
    rng = np.random.default_rng(1)
    users = [np.round(rng.integers(0, g + 1, rng.integers(3, 120)) / 100, 2).tolist() for g in (1, 10, 100) for _ in range(80)]
    users += [[5], [0, 0], [3, 3, 3], [2] * 20, [None, None, 4], [0] * 12 + [1], [None]]
    users += [[1, math.nan, 2, 9, 9, 9, 1], [1, 2, 9, math.inf, 9, 9], [1, 9, 2, -math.inf], [x * 1e-12 for x in users[200]], [-x for x in users[201]]]
    values = [x for user in users for x in user]
    events = pa.table({"event_id": np.arange(len(values)), "user_id": np.repeat(np.arange(len(users)), [len(x) for x in users]), "value": pa.array(values, pa.float64())})
    got, want = compared(spark, tmp_path, events, "beat_track")
    assert len(want) > 2000 and got == want


def test_means_between_roundings(spark, tmp_path):
    """Times whose mean ends with 5 behind the last digit, over files that tasks read in parts."""
    rng = np.random.default_rng(2)
    n = 60_000
    events = pa.table({"event_id": np.arange(n), "ts": pa.array(np.arange(n), pa.timestamp("us")), "user_id": rng.integers(0, 1500, n), "event_type": np.array(["view", "purchase", "error"])[rng.integers(0, 3, n)], "value": np.round(rng.exponential(50, n), 1)})
    _, want = compared(spark, tmp_path, events, "dscore_mean_sd")
    (tmp_path / "parts").mkdir()
    (tmp_path / "parts" / "events.parquet").mkdir()
    for i in range(8):
        pq.write_table(events.slice(n // 8 * i, n // 8), f"{tmp_path}/parts/events.parquet/{i}.parquet")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100k")
    try:
        df = registry.queries()["dscore_mean_sd"](spark, f"{tmp_path}/parts")
        assert len(want) == 1500 and sorted(map(tuple, df.collect()), key=repr) == want
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
