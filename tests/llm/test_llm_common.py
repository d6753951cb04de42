import sys
import weakref

from promolens.llm import common


class Thing:
    pass


def test_a_worker_keeps_only_the_last_operators_object(monkeypatch):
    """Workers outlive an operator's stages: its words must not stay beside the next one's."""
    monkeypatch.delitem(sys.modules, "_kept_by_worker", raising=False)
    first = weakref.ref(common.kept_by_worker("words", Thing))
    assert common.kept_by_worker("words", Thing) is first()  # from task to task
    second = weakref.ref(common.kept_by_worker("ids", Thing))
    assert first() is None and common.kept_by_worker("ids", Thing) is second()
    common.let_go()
    assert second() is None
    assert isinstance(common.kept_by_worker("words", Thing), Thing)
    monkeypatch.delitem(sys.modules, "_kept_by_worker")
