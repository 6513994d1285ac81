import json

from calyx.__main__ import main
from calyx.operators.writes import read_table
from calyx.sources import records as R

SF = "/root/testdata/sf0.001"


def test_cli_specs_daily_backfill(spark, tmp_table, capsys):
    wh, ex, landing = tmp_table("wh"), tmp_table("ex"), tmp_table("landing")
    assert main(["specs", "--specs", "daily", "--ds", "2024-01-10", "--events",
                 f"{SF}/events.parquet", "--warehouse", wh, "--exports", ex]) == 0
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert [o["spec"] for o in out] == ["attempts_per_kind", "attempts_per_learner"]
    R.api_records(spark, SF).write.json(landing)
    assert main(["daily", "--landing", landing, "--ds", "2024-01-10", "--warehouse", wh]) == 0
    daily = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert read_table(spark, daily["agg"]).count() > 0
    assert main(["backfill", "--events", f"{SF}/events.parquet", "--kind", "month",
                 "--start", "2024-01-01", "--end", "2024-02-01", "--warehouse", wh]) == 0
    bf = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert read_table(spark, bf["table"]).select("period_start").distinct().count() == 1
