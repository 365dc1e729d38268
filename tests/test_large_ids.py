"""Capture queries on event ids beyond those of the small tables."""

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq

SMALL = "/root/testdata/sf0.001/events.parquet"
#: The first id whose product with 2^45 leaves 64 bits.
FIRST = 1 << 18


def test_write_typed_keeps_ids_beyond_the_product(spark, tmp_path):
    from strobe.plans.capture_queries import write_typed

    events = pq.read_table(SMALL)
    ids = events.column("event_id").to_pylist()
    half = len(ids) // 2
    ids = ids[:half] + [FIRST * (1 + i % 3) + x for i, x in enumerate(ids[half:])]
    pq.write_table(events.set_column(events.schema.get_field_index("event_id"), "event_id", pa.array(ids)), tmp_path / "events.parquet")
    assert max(ids) * (1 << 45) > pc.max(pa.array([2**63 - 1])).as_py()
    big = [r.big for r in write_typed(spark, str(tmp_path)).select("big").collect()]
    assert len(set(big)) == len(big) == len(ids)
    # as the SQL says where the product fits, and every other id can be told from its value
    back = lambda x: (((x ^ 1) % 2**64) >> 45 | ((x ^ 1) % 2**64) << 19) % 2**64
    assert sorted(back(x) for x in big) == sorted(ids)
    assert {x * (1 << 45) + 1 for x in ids if x < FIRST} <= set(big)
