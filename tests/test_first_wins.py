"""First-wins state: equal to the batch operator over all rows, in any order of arrival."""

import json
import random

import pytest
from lodestar import streaming as ST
from lodestar.operators.dedupe import first_wins
from pyspark.sql import types as T

SCHEMA = T.StructType().add("k", "string").add("page", "long").add("pos", "long").add("v", "string")


@pytest.mark.parametrize("seed", [1, 2])
def test_stream_equals_first_wins_of_all_rows(spark, tmp_path, seed):
    rng = random.Random(seed)
    rows = [{"k": rng.choice(["a", "b", "c", "d", None]), "page": rng.choice([None, 0, 1, 2]), "pos": i, "v": f"v{i}"} for i in range(60)]
    rng.shuffle(rows)
    read = []

    def upsert(batch, batch_id):
        batch.write.mode("overwrite").parquet(ST.batch_path(str(tmp_path / "out"), batch_id))
        read.append(batch.count())

    for b in range(3):
        (tmp_path / "in").mkdir(exist_ok=True)
        (tmp_path / "in" / f"{b}.json").write_text("\n".join(json.dumps(r) for r in rows[b * 20:b * 20 + 20]))
        stream = ST.landed_stream(spark, str(tmp_path / "in"), SCHEMA)
        ST.run_available(ST.first_wins_stream(stream, "k", ["page", "pos"]), None, str(tmp_path / "ckpt"),
                         foreach_batch=upsert, mode="update")
    got = ST.first_rows(spark.read.parquet(str(tmp_path / "out")), "k", ["page", "pos"]).select("k", "page", "pos", "v")
    want = first_wins(spark.createDataFrame([tuple(r.values()) for r in rows], SCHEMA), "k", ["page", "pos"])
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    # A batch writes its own rows at most, one per key and the rows without one.
    nulls = [sum(r["k"] is None for r in rows[b * 20:b * 20 + 20]) for b in range(3)]
    assert all(n <= 4 + free for n, free in zip(read, nulls)) and len(read) == 3
