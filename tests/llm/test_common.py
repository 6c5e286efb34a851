from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

from precedent.llm.common import trimmed


def _resident_mb():
    return int(Path("/proc/self/statm").read_text().split()[1]) * 4096 / 1e6


def test_the_batches_are_the_same():
    batches = [pa.RecordBatch.from_pydict({"n": [i, i + 1]}) for i in range(3)]
    assert list(trimmed(iter(batches))) == batches
    assert list(trimmed([])) == []


@pytest.mark.skipif(not Path("/proc/self/statm").exists(), reason="reads /proc")
def test_memory_that_a_worker_freed_goes_back():
    # Too small for pages of their own; the last ones keep the heap from shrinking by itself.
    held = [np.ones(12_000) for _ in range(2_000)]
    kept = held[::200] + held[-1:]
    del held
    before = _resident_mb()
    list(trimmed([]))
    assert before - _resident_mb() > 100
    assert len(kept) == 11
