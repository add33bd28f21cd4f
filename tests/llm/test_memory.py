"""What a worker holds while it reads texts: every worker of an executor holds as much at once."""

import tracemalloc
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest

from tallybrook.llm import quality


@pytest.mark.parametrize("what", ["weights", "labelled weights", "counts"])
def test_a_batch_of_texts_needs_little_memory(what):
    rng = np.random.default_rng(0)
    texts = [" ".join(f"w{n}" for n in rng.integers(0, 50_000, 500)) for _ in range(1_500)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts), pa.array(np.arange(len(texts)) % 2 == 0)], ["text", "good"])
    held = rng.integers(0, 9, (2, quality.BUCKETS))
    ratios = quality.log_ratios(held[0], held[1] * 0.3)
    run = {"weights": lambda: quality._scorer(SimpleNamespace(value=ratios.astype(np.float32)), "weight"),
           "labelled weights": lambda: quality._rate(SimpleNamespace(value=(*held, 0.3, ratios))),
           "counts": lambda: quality._count}[what]()
    # The counts themselves are two arrays of 8 MB.
    most = 48e6 if what == "counts" else 32e6
    tracemalloc.start()
    try:
        for _ in run([batch]):
            pass
        assert tracemalloc.get_traced_memory()[1] < most
    finally:
        tracemalloc.stop()
