import numpy as np
import pytest

from regionscore.llm import common


def direct(data, start, end):
    h = 0
    for k, byte in enumerate(data[start:end].tolist()):
        h = (h + int(common._BYTE[byte]) * pow(common._BASE, k, 2**64)) % 2**64
    h ^= (end - start) * 0xD6E8FEB86659FD93 % 2**64
    return int(common.mixed(np.array([h], np.uint64))[0])


@pytest.mark.parametrize("n", [0, 1, common.SEGMENT - 1, common.SEGMENT, common.SEGMENT + 1, 3 * common.SEGMENT + 17])
def test_hashes_of_spans_over_segments(n):
    rng = np.random.default_rng(n)
    data = rng.integers(0, 256, n, dtype=np.uint8)
    starts = rng.integers(0, n + 1, 60)
    ends = np.minimum(starts + rng.integers(0, 400, 60), n)
    starts[:1], ends[:1] = 0, n
    some = common.span_hashes(data, starts, ends)
    assert some.tolist() == [direct(data, a, b) for a, b in zip(starts.tolist(), ends.tolist())]
    order = np.argsort(starts)
    assert (common.span_hashes(data, starts[order], ends[order]) == some[order]).all()
    assert len(common.span_hashes(data, starts[:0], ends[:0])) == 0


def test_a_long_text_takes_memory_for_its_spans_only():
    import tracemalloc

    data = np.full(24 << 20, 97, np.uint8)
    tracemalloc.start()
    common.span_hashes(data, np.array([0, 5]), np.array([len(data), len(data) - 1]))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 8 << 20
