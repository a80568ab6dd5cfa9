import __spark_entry__ as E
from tests.conftest import SF


def test_flow_fit_score_save_load(spark):
    q = E.queries()
    a = q["risk_scores"](spark, SF)
    b = q["risk_scores_reloaded"](spark, SF)
    assert a.count() == 150
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    gate = {r["model"]: r["passed"] for r in q["risk_gate"](spark, SF).collect()}
    assert "ALL" in gate and len(gate) >= 2
