"""What tasks of the pipeline hold beside their batch."""

from __future__ import annotations

import tracemalloc

import numpy as np
import pyarrow as pa

from corpusops.llm import near_copies, weak_labels
from corpusops.llm.words import slices


def batch_of_texts() -> pa.RecordBatch:
    words = [f"w{i}" for i in range(20_000)]
    rng = np.random.default_rng(11)
    texts = [" ".join(words[i] for i in rng.integers(0, len(words), 300)) for _ in range(2_000)]
    return pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])


def peak_mb(work) -> float:
    tracemalloc.start()
    try:
        work()
        return tracemalloc.get_traced_memory()[1] / 2**20
    finally:
        tracemalloc.stop()


def test_arrays_over_a_batch_stay_small():
    batch = batch_of_texts()

    def scored():
        for _, texts in slices([batch], "text"):
            weak_labels.votes(texts)
            weak_labels.features(texts)

    def shingled():
        for _, texts in slices([batch], "text"):
            near_copies.shingles(near_copies.lowered(texts), near_copies.SHINGLE_WORDS)

    assert peak_mb(scored) < 16
    assert peak_mb(shingled) < 16


def test_common_shingles_are_read_from_the_packed_bitmap():
    rng = np.random.default_rng(2)
    packed = rng.integers(0, 256, near_copies.BITMAP // 8).astype(np.uint8)
    hashes = rng.integers(0, 1 << 63, 5_000).astype(np.uint64) * np.uint64(2) + np.uint64(1)
    known = np.unpackbits(packed, bitorder="little").astype(bool)
    assert (near_copies.is_common(packed, hashes) == known[(hashes % np.uint64(near_copies.BITMAP)).astype(np.int64)]).all()
    assert peak_mb(lambda: near_copies.is_common(packed, hashes)) < 1
