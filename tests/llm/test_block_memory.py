"""Memory of vectorised steps: what a worker holds at once does not grow with its batch."""

from __future__ import annotations

import random
import tracemalloc

import numpy as np
import pyarrow as pa

from tallyhouse.llm import alignment, substrings


def test_anchors_of_a_large_batch_are_found_in_small_steps():
    rng = np.random.default_rng(3)
    texts = [bytes(rng.integers(97, 123, 4000, np.uint8)).decode() for _ in range(1000)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(1000)), pa.array(range(1000)), pa.array(texts)], [*substrings.KEY, "text"])
    tracemalloc.start()
    try:
        rows = sum(part.num_rows for part in substrings._block_rows(iter([batch])))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert rows > 1000
    assert peak < 100 << 20, f"{peak >> 20} MB for 4 MB of text"


def test_steps_do_not_change_the_blocks():
    rng = random.Random(4)
    texts = ["".join(rng.choices("abé ", k=rng.choice([0, 10, 700, 3000]))) for _ in range(600)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(600)), pa.array(range(600)), pa.array(texts)], [*substrings.KEY, "text"])
    usual = pa.Table.from_batches(substrings._block_rows(iter([batch])))
    alone = pa.Table.from_batches([x for i in range(600) for x in substrings._block_rows(iter([batch.slice(i, 1)]))])
    assert usual.to_pydict() == alone.to_pydict()


def test_alignment_blocks_are_bounded_in_bytes():
    texts = ["日本語 " * 400, None, "", "word " * 300] * 400
    sizes = [sum(len((t or "").encode()) for t in texts[a:b]) for a, b in alignment._blocks(texts)]
    assert sum(sizes) == sum(len((t or "").encode()) for t in texts)
    assert max(sizes) < (512 << 10) + 5000
