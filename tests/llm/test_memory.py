"""Workers hand memory back when they fall idle, once for each time."""

import pytest

from tickloom.llm import units


class Done(Exception):
    pass


def test_idle_workers_give_memory_back_once(monkeypatch):
    looks = iter([None, object(), None, None, None, None, object(), None, None])
    given = []

    def look():
        try:
            return next(looks)
        except StopIteration:
            raise Done from None

    monkeypatch.setattr(units.TaskContext, "get", staticmethod(look))
    monkeypatch.setattr(units.time, "sleep", lambda s: None)
    monkeypatch.setattr(units, "_give_back", lambda: given.append(1))
    with pytest.raises(Done):
        units._watch_idle()
    assert len(given) == 2
