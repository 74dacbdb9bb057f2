"""What a worker of the near-copy join holds while it hashes texts."""

from __future__ import annotations

import tracemalloc

import numpy as np
import pyarrow as pa

from arborlit.llm import ngram_join


def test_hashing_holds_little_beside_the_texts():
    rng = np.random.default_rng(7)
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 5000, 400)) for _ in range(2000)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(2000), pa.int64()), pa.array(texts)], names=["doc_id", "text"])
    tracemalloc.start()
    sizes = [len(tokens) for _, tokens in ngram_join._sets(iter([batch]), 5)]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(sizes) == 2000 and min(sizes) > 300
    assert peak < 32 << 20
