import pytest


@pytest.fixture(autouse=True)
def small_flow_budget(monkeypatch):
    """The flow's searches take a few fits in tests; the queries' default is the full budget."""
    from segscore.plans import catalog
    monkeypatch.setattr(catalog, "FLOW_BUDGET", "small")
