"""Every registered query against its SQL oracle (DuckDB) on sf0.001: same columns, same multiset of rows."""

import dataclasses

import pytest

from ledgerline.plans import catalog
from tests.conftest import SF_SMALL
from tools.check_oracles import rows_of

catalog.load_all()
ORACLES, QUERIES = catalog.ORACLES, catalog.QUERIES


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_query_matches_oracle(spark, duck, key):
    df = QUERIES[key](spark, SF_SMALL)
    got = df.collect()
    cur = duck.execute(ORACLES[key])
    names = [d[0] for d in cur.description]
    want = cur.fetchall()
    assert sorted(df.columns) == sorted(names)
    assert rows_of(df.columns, got) == rows_of(names, want)


def test_oracle_tables_are_not_the_operators_registries():
    import pathlib
    import re

    import ledgerline.plans as plans

    shared = ("DELINQUENCY_RULES|DELINQUENCY_DEFAULT|BEHAVIOUR_LADDER|TRANSITION_TEXT|AGE_JUMPS|CONTRACT_LADDER|CONTRACT_DEFAULT|RECEIPT_CODE_LABELS|"
              "RECEIPT_TYPES|RECEIPT_NOTES|RECEIPT_BANKS|TRANSACTION_TYPES|SEGMENT_RULES|LEGACY_KEYWORDS|AGEING_SEGMENTS|ROLL_RATES|MANDATE_CUTOFFS|"
              "CHANNELS|OUTCOMES|POLICY_RULES|DEBT_REVIEW_REQUESTED|LOW_INCOME|SCORECARDS|SEGMENTS|fixed_segments|REPORT_MEASURES|SCORE_AVERAGES|"
              "OUTPUT_FLAGS|ACTIVATION_FLAGS|DECISION_SERVICES")
    for path in pathlib.Path(plans.__path__[0]).glob("q_*.py"):
        if path.name == "q_dormancy.py":  # its CHANNELS are column names
            continue
        assert not re.findall(rf"\b(?!OT\.)[A-Z]{{1,2}}\.(?:{shared})\b", re.sub(r"\bO[TD]\.", "oracle.", path.read_text())), path


@pytest.mark.parametrize("key,module,registry,change", [
    ("contract_treatment", "contracts", "CONTRACT_LADDER", lambda r: [r[1], r[0], *r[2:]]),
    ("flag_age_jumps", "behaviour", "AGE_JUMPS", lambda r: [(*r[0][:2], "other"), *r[1:]]),
    ("account_transition", "behaviour", "TRANSITION_TEXT", lambda r: [(r[0][0], "other"), *r[1:]]),
    ("segment_by_ageing", "portfolio", "AGEING_SEGMENTS", lambda r: [("0", "other"), *r[1:]]),
    ("score_campaign", "scorecards", "SCORECARDS", lambda r: {**r, "cam": (dataclasses.replace(r["cam"][0], top=111), *r["cam"][1:])}),
    ("score_established", "scorecards", "SCORECARDS", lambda r: {**r, "est": (*r["est"][:3], dataclasses.replace(r["est"][3], null="zero"), *r["est"][4:])}),
    ("score_new", "scorecards", "SCORECARDS", lambda r: {**r, "new": (*r["new"][:7], dataclasses.replace(r["new"][7], blank_points=72))}),
    ("decision_waterfall", "decisioning", "SEGMENTS", lambda r: [*r[:11], dataclasses.replace(r[11], grades=(("615x590", "7"), *r[11].grades[1:]))]),
    ("decision_waterfall", "decisioning", "SEGMENTS", lambda r: [*r[:3], r[4], r[3], *r[5:]]),
    ("decision_report", "decisioning", "SCORE_AVERAGES", lambda r: r[1:]),
    ("filter_one_hots", "filters", "DECISION_SERVICES", lambda r: [(r[0][0], r[1][1]), (r[1][0], r[0][1]), *r[2:]]),
])
def test_a_wrong_registry_entry_is_found(spark, duck, monkeypatch, key, module, registry, change):
    import importlib

    m = importlib.import_module(f"ledgerline.operators.{module}")
    monkeypatch.setattr(m, registry, change(getattr(m, registry)))
    df = QUERIES[key](spark, SF_SMALL)
    cur = duck.execute(ORACLES[key])
    names = [d[0] for d in cur.description]
    assert rows_of(df.columns, df.collect()) != rows_of(names, cur.fetchall())
