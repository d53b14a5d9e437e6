"""Helpers shared by the operators."""

import pytest

from myosig.llm import common


def test_lean_passes_every_batch_and_releases_at_the_end(monkeypatch):
    calls = []
    monkeypatch.setattr(common, "release", lambda: calls.append(1))
    run = common.lean(lambda batches: (b * 2 for b in batches))
    assert list(run(iter([1, 2, 3]))) == [2, 4, 6]
    assert len(calls) == 4  # one per batch and one for the pass
    assert list(run(iter([]))) == [] and len(calls) == 5


def test_lean_hands_errors_on_and_releases(monkeypatch):
    calls = []
    monkeypatch.setattr(common, "release", lambda: calls.append(1))

    def fails(batches):
        for _ in batches:
            raise ValueError("bad batch")
        yield 0

    with pytest.raises(ValueError, match="bad batch"):
        list(common.lean(fails)(iter([1])))
    assert calls


def test_release_is_harmless():
    common.release()
    common.release()
