"""The command line: build, sync twice, report (in-process, shared session)."""

import json
import os

import pytest

from sparkmart.__main__ import main

SF = "/root/testdata/sf0.001"
FLAT = ["--fact-partition", "none"]
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")


def test_build_sync_report(spark, tmp_path, capsys):
    wh, tgt = str(tmp_path / "wh"), str(tmp_path / "tgt")
    assert main(["build", "--sf-dir", SF, "--out", wh, "--now", "2002-01-01", "--as-of", "1998-07-01", *FLAT]) == 0
    counts = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert counts["fact_orders"] == counts["raw_order"] > 0

    main(["sync", "--source", wh, "--target", tgt, *FLAT])
    first = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert [r["rows_synced"] for r in first][3] == counts["fact_orders"]
    main(["sync", "--source", wh, "--target", tgt, *FLAT])
    second = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert [r["rows_synced"] for r in second] == [0, 0, 0, 0]

    # A later load changes nothing it should not, and the sync moves only what is newer.
    main(["load", "--sf-dir", SF, "--out", wh, *FLAT])
    assert json.loads(capsys.readouterr().out.strip().splitlines()[-1])["fact_orders"] == counts["fact_orders"]

    main(["report", "--warehouse", wh, "--view", "monthly"])
    months = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert len(months) == 80 and months[0]["mom_growth_pct"] is None


def test_rank_report_written_to_files(spark, tmp_path, capsys):
    wh, out = str(tmp_path / "wh"), str(tmp_path / "rank")
    main(["build", "--sf-dir", SF, "--out", wh, "--now", "2002-01-01", "--as-of", "1998-07-01", *FLAT])
    capsys.readouterr()
    main(["report", "--warehouse", wh, "--view", "rank", "--out", out])
    assert json.loads(capsys.readouterr().out.strip().splitlines()[-1]) == [{"written": out}]
    ranks = spark.read.parquet(out)
    assert ranks.where("revenue_rank = 1").count() >= 1
    assert ranks.agg({"revenue_rank": "max"}).first()[0] <= ranks.count()
