import os

from changefeed.__main__ import main
from changefeed.schema import ALL_TABLES
from conftest import record


def test_jobs(spark, log_folder, tmp_path, capsys):
    lines = [record(f"e{i}", f"2024-01-01T{i // 60:02}:{i % 60:02}:00Z", wiki=f"w{i % 2}") for i in range(300)]
    path, root, out = log_folder(lines + lines[:5]), str(tmp_path / "root"), str(tmp_path / "out")
    main(["backfill", "--root", root, "--path", path])
    main(["counts", "--root", root])
    main(["dup-check", "--root", root])
    printed = capsys.readouterr().out
    assert "OK-NO-DUPLICATES" in printed and "recentchange | 300" in printed
    assert main(["freshness", "--root", root]) == 1
    assert "False" in capsys.readouterr().out
    assert main(["verdict", "--root", root]) == 1
    assert "False | False | False | True | False" in capsys.readouterr().out
    main(["export", "--root", root, "--out", out, "--path", path])
    assert spark.read.parquet(f"{out}/edits_per_minute_by_wiki").count() == 297
    assert spark.read.parquet(f"{out}/bronze_recentchange_sample").count() == 300
    assert spark.read.text(f"{out}/sample_events").count() == 305
    main(["maintain", "--root", root, "--orphans"])
    assert "row_count=300" in capsys.readouterr().out
    main(["rebuild", "--root", root, "--out", f"{out}/gold"])
    assert spark.read.parquet(f"{out}/gold/gold.edits_per_minute_by_wiki").count() == 300
    main(["drift", "--root", root, "--out", out])
    assert main(["counts", "--root", root]) == 0
    assert "recentchange | 300" in capsys.readouterr().out
    assert os.path.isdir(f"{root}/metrics/progress")
    for table in ALL_TABLES:
        spark.sql(f"DROP TABLE IF EXISTS {table.full_name}")


def test_load_take_over_and_refresh(spark, log_folder, tmp_path, capsys):
    line = lambda i: record(f"e{i}", f"2024-01-01T{i // 60:02}:{i % 60:02}:00Z", wiki=f"w{i % 2}")
    path, root, out = log_folder([line(i) for i in range(100)]), str(tmp_path / "root"), str(tmp_path / "gold")
    main(["load", "--root", root, "--path", path])
    assert "recentchange 100" in capsys.readouterr().out
    main(["refresh", "--root", root, "--out", out])
    log_folder([line(i) for i in range(100, 130)])
    try:
        main(["backfill", "--root", root, "--path", path, "--max-files", "1"])
        main(["dup-check", "--root", root])
        assert "130 | 130 | OK-NO-DUPLICATES" in capsys.readouterr().out
        main(["refresh", "--root", root, "--out", out])
        assert "edits_per_minute_by_wiki 2" in capsys.readouterr().out
        assert spark.read.parquet(f"{out}/gold.edits_per_minute_by_wiki").count() == 130
    finally:
        for table in ALL_TABLES:
            spark.sql(f"DROP TABLE IF EXISTS {table.full_name}")
