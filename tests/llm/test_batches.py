"""What a task holds at a time: batches end by bytes, and one pass needs one Python process."""

from __future__ import annotations

import pyarrow as pa
import pytest

from peerlight.llm import bpe
from peerlight.llm.common import BATCH_BYTES, bound_batches
from peerlight.llm.decontaminate import find_contamination
from peerlight.llm.queries import vocabulary

LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"


@pytest.fixture
def unset(spark):
    spark.conf.unset(LIMIT)
    yield spark
    spark.conf.unset(LIMIT)


def python_passes(df) -> int:
    return df._jdf.queryExecution().executedPlan().toString().count("MapInArrow")


def test_batches_end_by_bytes(unset):
    rows = unset.range(12).selectExpr("id", "repeat('x', 3000000) AS text").coalesce(1)
    bound_batches(unset)
    sizes = rows.mapInArrow(lambda batches: (pa.record_batch({"n": [b.nbytes]}) for b in batches), "n long").collect()
    assert max(r["n"] for r in sizes) < BATCH_BYTES + 4_000_000


def test_a_limit_of_the_session_is_kept(unset):
    unset.conf.set(LIMIT, "12345")
    bound_batches(unset)
    assert unset.conf.get(LIMIT) == "12345"


def test_operators_bound_their_batches(unset):
    docs = unset.createDataFrame([(1, "a b, a b. a b")], "doc_id long, text string")
    items = unset.createDataFrame([("i", "a b")], "item_id string, text string")
    for run in (
        lambda: bpe.bpe_encode(docs, *vocabulary()),
        lambda: find_contamination(docs, items),
    ):
        unset.conf.unset(LIMIT)
        run()
        assert unset.conf.get(LIMIT) == str(BATCH_BYTES)


def test_one_search_pass_per_slice(spark):
    """Hits are counted by the last search: another process per task would count against its executor."""
    docs = spark.createDataFrame([(1, "u v w x"), (2, None), (3, "v w")], "doc_id long, text string")
    items = spark.createDataFrame([("a", "v w"), ("b", "w x"), (None, "u")], "item_id string, text string")
    want = {1: (4, 4, ["a", "b"]), 2: (0, 0, []), 3: (2, 2, ["a"])}
    for slice_bytes in (1 << 20, 4):
        found = find_contamination(docs, items, slice_bytes=slice_bytes)
        assert {r["doc_id"]: (r["n_words"], r["n_hit"], r["items"]) for r in found.collect()} == want
        assert slice_bytes == 4 or python_passes(found) == 1
