"""The bundled spec sets give the same rows as the library operators."""

import pytest

from calyx.operators import aggregates as A
from calyx.operators.writes import read_table
from calyx.plans import specs as S
from calyx.sources import tables as T

SF = "/root/testdata/sf0.001"

CASES = {
    "daily": ("2024-01-10", {"attempts_per_kind": A.daily_by_type, "attempts_per_learner": A.daily_by_user}),
    "monthly": ("2024-01-20", {"learner_months": A.monthly_user_attempts,
                               "lesson_months": A.monthly_lesson_stats,
                               "activity_calendar": A.monthly_daily_activity,
                               "month_totals": A.monthly_summary}),
    "prev_week": ("2024-01-17", {"last_week_kinds": A.prev_week_by_type,
                                 "last_week_learners": A.prev_week_by_user,
                                 "last_week_totals": A.prev_week_summary}),
}


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("name", sorted(CASES))
def test_example_specs_match_operators(spark, tmp_table, name):
    ds, expected = CASES[name]
    att = T.attempts(spark, SF)
    specs = S.example_specs(name)
    res = S.run_aggregates(spark, specs, ds, {"attempts": att}, tmp_table("tables"),
                           tmp_table("exports"), {"attempts": "created_at"})
    assert {r.spec.name for r in res} == set(expected)
    for r in res:
        want = expected[r.spec.name](att, ds)
        got = read_table(spark, r.path).select(*want.columns)
        assert _rows(got) == _rows(want), r.spec.name
        if r.spec.export:
            assert r.exported
    # a re-run leaves the same tables (replace / upsert are idempotent)
    again = S.run_aggregates(spark, specs, ds, {"attempts": att}, res[0].path.rsplit("/", 1)[0],
                             None, {"attempts": "created_at"})
    for r in again:
        want = expected[r.spec.name](att, ds)
        assert _rows(read_table(spark, r.path).select(*want.columns)) == _rows(want)
