import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm.suffix_arrays import common_prefixes, suffix_array


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.integers(2, 4), min_size=1, max_size=12), min_size=1, max_size=10))
def test_order_and_prefixes(segments):
    s = np.array([c for x in segments for c in [*x, 1]] + [0], dtype=np.int32)
    want = sorted(range(len(s)), key=lambda i: s[i:].tolist())
    sa = suffix_array(s)
    assert sa.tolist() == want
    ends = np.flatnonzero(s <= 1)
    stop = ends[np.searchsorted(ends, np.arange(len(s)))]
    prefix = common_prefixes(s, sa, stop)
    for i, j in zip(want[1:], want[:-1], strict=True):
        n = 0
        while i + n < stop[i] and j + n < stop[j] and s[i + n] == s[j + n]:
            n += 1
        assert prefix[i] == n
