import numpy as np
import pytest

from dwell.llm import mph


@pytest.mark.parametrize("n", [0, 1, 2, 63, 1000, 50_000])
def test_slots_are_a_permutation(n):
    keys = np.random.default_rng(n).integers(0, 2**64, n, dtype=np.uint64)
    h, arrays = mph.from_bytes(mph.to_bytes(mph.PerfectHash.build(keys), a=np.arange(n)))
    assert sorted(h.slots(keys).tolist()) == list(range(n)) and len(h) == n and arrays["a"].tolist() == list(range(n))
    assert h.slots(np.zeros(0, np.uint64)).tolist() == []
    strange = np.random.default_rng(n + 1).integers(0, 2**64, 500, dtype=np.uint64)
    at = h.slots(strange)
    assert at.min(initial=-1) >= -1 and at.max(initial=-1) < max(n, 1)


def test_keys_that_no_level_places_still_get_slots(monkeypatch):
    monkeypatch.setattr(mph, "MAX_LEVELS", 1)
    keys = np.arange(1000, dtype=np.uint64)
    assert sorted(mph.PerfectHash.build(keys).slots(keys).tolist()) == list(range(1000))
