"""What a worker holds at once, and from one task to the next."""

import os
import tracemalloc

import numpy as np
import pytest

from cohortloom.llm import common, decontamination, toxicity


def test_kept_until_let_go():
    made = []
    common.let_go()
    for _ in range(2):
        common.kept("thing", lambda: made.append(1) or len(made))
    assert len(made) == 1
    common.let_go()
    assert common.kept("thing", lambda: made.append(1) or len(made)) == 2
    common.let_go()


def test_a_batch_of_windows_is_small():
    words = [b"%d" % k for k in range(400)]
    index = decontamination.ItemIndex([(1, words)])
    hashes = np.random.default_rng(1).integers(0, 1 << 63, decontamination.BATCH_WORDS).astype(np.uint64)
    tracemalloc.start()
    index.near(hashes)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 64e6


def test_pairs_of_terms_take_little_more_than_their_table():
    rng = np.random.default_rng(2)
    docs = [np.unique(rng.integers(0, 500, 20)).astype(np.uint32) for _ in range(8000)]
    y = (np.arange(8000) % 20 == 0).astype(np.float64)
    table = 4 * 8000 * 500
    tracemalloc.start()
    toxicity._in_pairs(docs, y, np.arange(500, dtype=np.uint32), np.zeros(500, bool))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 2.2 * table


def _resident():
    with open("/proc/self/statm") as file:
        return int(file.read().split()[1]) * os.sysconf("SC_PAGE_SIZE")


@pytest.mark.skipif(not os.path.exists("/proc/self/statm"), reason="needs Linux")
def test_what_is_let_go_goes_back_to_the_system():
    common.let_go()
    pins = []
    # Blocks that the worker frees lie between others that it still holds.
    common.kept("blocks", lambda: [bytes(20_000) for k in range(6000) if not pins.append(bytes(2000))])
    before = _resident()
    common.let_go()
    assert before - _resident() > 50e6


def test_a_fit_takes_few_numbers_for_each_term_of_a_document():
    rng = np.random.default_rng(3)
    labels = (np.arange(4000) % 5 == 0).astype(int)
    docs = [np.unique(rng.integers(400 * k, 400 * k + 600, 200)).astype(np.uint32) for k in labels]
    tracemalloc.start()
    toxicity.fit(docs, labels)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 105 * sum(map(len, docs))
