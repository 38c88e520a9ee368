"""What a task of the n-gram counts holds at a time."""

import tracemalloc

import numpy as np
import pyarrow as pa

from skylattice.llm import kneser_ney


def test_pairs_are_unpacked_in_place():
    """The same pairs, in little more than the bytes of the columns kept."""
    rng = np.random.default_rng(1)
    parts = []
    for _ in range(20):
        u = np.sort(rng.integers(0, 50_000, 20_000))
        parts.append((u, rng.integers(0, 50_000, 20_000), rng.integers(1, 9, 20_000)))
    blobs = pa.chunked_array([pa.array([kneser_ney.packed([np.diff(u, prepend=0), v, c]) for u, v, c in parts], pa.binary())])
    tracemalloc.start()
    got = kneser_ney._unpacked_pairs(blobs, 50_000)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert all((g == np.concatenate(p)).all() for g, p in zip(got, zip(*parts)))
    assert got[0].dtype == got[1].dtype == np.uint32 and most < 1.3 * sum(g.nbytes for g in got)


def test_texts_are_taken_a_few_at_a_time():
    """A group is given out before the batch is read to its end, and none has too many words."""
    taken = []
    texts = ("word " * 60_000 for i in range(50) if taken.append(i) is None)
    first = next(kneser_ney.token_groups(texts))
    assert len(taken) < 10 and sum(len(t) // 6 for t in first) <= 250_000
