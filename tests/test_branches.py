"""The fixtures reach every branch of the trading rules, so the oracle rows prove something."""
from conftest import SF_MID

from tickframe.plans import load_all


def test_ledger_reasons_and_outcomes(spark):
    rows = load_all()["trade_ledger"][0](spark, SF_MID).collect()
    assert {r.exit_reason for r in rows} == {"STOP", "SIGNAL", "OPEN"}
    assert any(r.ret > 0 for r in rows) and any(r.ret < 0 for r in rows)


def test_exit_reasons(spark):
    rows = load_all()["stream_exits"][0](spark, SF_MID).collect()
    assert {r.exit_reason for r in rows} == {"SIGNAL_OFF", "TAKE_PROFIT", "STOP_LOSS", "TRAILING_ROCKET"}


def test_signals_of_both_kinds(spark):
    rows = load_all()["signal_flag"][0](spark, SF_MID).collect()
    assert {r.signal for r in rows} == {0, 1}
