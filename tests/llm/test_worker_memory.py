"""What a worker holds at once is bounded, whatever the session's rows a batch."""

import random
import tracemalloc

import pyarrow as pa
from hearth.llm import group_join
from hearth.llm.common import BATCH, BATCH_BYTES, ship


def test_arrow_batches_are_bounded_by_bytes(spark):
    ship(spark)
    rows = spark.range(3000, numPartitions=1).selectExpr("id", "repeat('0123456789', 1000) as text")

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], ["n", "bytes"])

    found = rows.mapInArrow(sizes, "n long, bytes long").collect()
    assert sum(r.n for r in found) == 3000
    assert max(r.bytes for r in found) < 2 * BATCH  # 30 MB in one batch before


def test_a_bound_of_the_session_stays(spark):
    before = spark.conf.get(BATCH_BYTES, None)
    try:
        spark.conf.set(BATCH_BYTES, "1048576")
        ship(spark)
        assert spark.conf.get(BATCH_BYTES) == "1048576"
    finally:
        spark.conf.unset(BATCH_BYTES) if before is None else spark.conf.set(BATCH_BYTES, before)


def test_shingles_of_many_texts_take_little_memory():
    rng = random.Random(1)
    words = [f"w{i}" for i in range(20_000)]
    texts = [" ".join(rng.choices(words, k=300)) for _ in range(2_500)]  # 4.8 MB
    one_by_one = [group_join.shingle_sets([t])[0] for t in texts[:50]]
    tracemalloc.start()
    try:
        sets = group_join.shingle_sets(texts)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert all((a == b).all() for a, b in zip(one_by_one, sets)) and len(sets) == len(texts)
    assert peak < 30e6  # 48 MB before
