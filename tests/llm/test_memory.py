"""What a Python worker holds at a time and keeps between batches."""

import platform
import subprocess
import sys
import tracemalloc
from pathlib import Path

import numpy as np
import pytest

from tillwatch.llm import neardup

ROOT = Path(__file__).resolve().parents[2]
KEPT = """
import re
import pandas as pd
from tillwatch.llm.common import pieces

def anonymous():
    return int(re.search(r"Anonymous: +([0-9]+)", open("/proc/self/smaps_rollup").read())[1]) / 1024

frames = (pd.DataFrame({"text": ["a b", None]}) for _ in range(2))
before, pinned = anonymous(), []
for part, texts in pieces(frames, "text"):
    blocks = [bytes(100_000) for _ in range(1500)]
    for k, block in enumerate(blocks):
        blocks[k] = block + b"x"
    pinned.append(blocks[-1])
    assert anonymous() - before > 100
    del blocks, block
print(anonymous() - before)
"""


@pytest.mark.skipif(platform.libc_ver()[0] != "glibc", reason="only this C library is asked to give memory back")
def test_memory_used_for_a_batch_goes_back_to_the_system():
    found = subprocess.run([sys.executable, "-c", KEPT], cwd=ROOT, capture_output=True, text=True, check=True, timeout=100)
    assert float(found.stdout) < 50


def test_blocks_of_copies_count_shared_shingles_in_bounded_memory(monkeypatch):
    rng = np.random.default_rng(5)

    def flat(sets):
        return np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(s) for s in sets]), len(sets)

    x = [np.unique(rng.integers(0, 50, 20)).astype(np.uint64) for _ in range(9)]
    y = [np.unique(rng.integers(0, 60, n)).astype(np.uint64) for n in (20, 0, 35, 1, 20)]
    want = [[len(np.intersect1d(a, b)) for b in y] for a in x]
    for held in (1, 7, 1 << 19):
        monkeypatch.setattr(neardup, "HELD_SHARED", held)
        assert neardup.shared_counts(*flat(x), *flat(y)).tolist() == want
    copies = [np.arange(1000, dtype=np.uint64) + np.uint64(k) for k in range(neardup.BLOCK)]
    tracemalloc.start()
    shared = neardup.shared_counts(*flat(copies), *flat(copies))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert shared[0].tolist() == [1000 - k for k in range(neardup.BLOCK)]
    assert peak < 48e6  # 16 million shared shingles: over 300 MB at a time
