"""Memory of a group of anchors, and that the slices it is taken in do not show in the result."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from test_text_operators import brute_repeats, documents
from test_whole_job import repeated_rows

from tidewater.llm import substring_dedup


def unit_table(texts, buckets):
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array(range(len(texts)), pa.int64()), "text": texts})
    cut = pa.Table.from_batches(substring_dedup._cut_units(iter([batch]), buckets)).combine_chunks()
    return cut.filter(pc.equal(cut["bucket"], 0))


def test_a_group_of_anchors_takes_few_times_its_rows():
    rng = np.random.default_rng(5)
    letters = np.frombuffer(b"abcdefghijklmnopqrstuvwxyz ", dtype=np.uint8)
    got = unit_table([letters[rng.integers(0, 27, 100_000)].tobytes().decode() for _ in range(60)], 1)
    tracemalloc.start()
    substring_dedup._decide(got, 1)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got.nbytes > 5 << 20 and peak < 4 * got.nbytes


@pytest.mark.parametrize("some", [1, 7, 1 << 17])
def test_slices_of_anchors_do_not_show(spark, monkeypatch, some):
    monkeypatch.setattr(substring_dedup, "SLICE_ENTRIES", some)
    rng = random.Random(8)
    passages = ["".join(rng.choices("abcdef ", k=rng.randint(40, 150))) for _ in range(8)]
    texts = [" ".join(rng.choices(passages, k=rng.randint(0, 5))) + str(i % 9) for i in range(60)]
    rows = [*enumerate(texts), (3, texts[4]), (None, texts[5]), (70, None)]
    buckets = 1 if some == 7 else 3
    whole = unit_table(texts, buckets)
    monkeypatch.setattr(substring_dedup, "SLICE_ENTRIES", 1 << 30)
    want = substring_dedup._decide(whole, buckets)
    monkeypatch.setattr(substring_dedup, "SLICE_ENTRIES", some)
    assert substring_dedup._decide(whole, buckets).equals(want) and want.num_rows
    assert repeated_rows(substring_dedup.repeated_spans(documents(spark, rows)).collect()) == brute_repeats(rows)


def test_kept_texts_are_shuffled_once(spark):
    docs = documents(spark, [(i, f"text {i} " * 20) for i in range(40)] + [(None, "none " * 30), (0, None)])
    out = substring_dedup.remove_repeats(docs)
    plan = out._jdf.queryExecution().executedPlan().toString()
    after = plan[: plan.index("FlatMapCoGroupsInArrow")]  # of the kept texts and of the other columns
    assert after.count("Exchange hashpartitioning") == 2 and out.count() == 42
