import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from strata.llm.rlbwt import RunLengthIndex

TEXT = st.text("abc", max_size=30).map(str.encode)


@settings(max_examples=300, deadline=None)
@given(st.lists(TEXT, min_size=1, max_size=8), st.lists(TEXT, min_size=1, max_size=5), st.integers(8, 12))
def test_matching_statistics_equal_brute_force(strings, patterns, length):
    strings = [s for s in dict.fromkeys(strings) if s] or [b"a"]
    owners = np.arange(len(strings))[::-1].copy()
    lengths, first, which = RunLengthIndex(strings, owners, length).stream(patterns)
    k = 0
    for n, pattern in enumerate(patterns):
        for i in range(len(pattern)):
            rest = pattern[i:i + length]
            best = max(j for j in range(len(rest) + 1) if any(rest[:j] in s for s in strings))
            assert (lengths[k], which[k]) == (best, n)
            if best == length:
                assert first[k] == min(o for s, o in zip(strings, owners.tolist()) if rest in s)
            k += 1


@pytest.mark.parametrize("byte", [b"\x00", b"\xff", b"a"])
def test_one_symbol(byte):
    index = RunLengthIndex([byte * 60, byte * 55], np.array([7, 3]), 50)
    lengths, first, _ = index.stream([byte * 52])
    assert lengths.tolist()[:3] == [50, 50, 50] and first[0] == 3
    assert len(index.run_start) <= 6
