"""The commands over a folder of snapshots."""

from test_discovery import Web

from millrace import __main__ as cli


def test_from_dump_to_export(spark, tmp_path, capsys):
    state = f"{tmp_path}/state"
    (tmp_path / "dump.csv").write_text("id,name,size,country,website\n1,lumen dairy,10001+,india,www.lumendairy.com/\n2,gravel pit,1001-5000,norway,gravelpit.com\n3,tiny,1-10,india,\n")
    assert cli.main(["ingest-dump", str(tmp_path / "dump.csv"), "--state", state]) == 0
    web = Web().put("https://www.lumendairy.com/", "Jobs > /jobs", plain=5).put("https://www.lumendairy.com/jobs", title="Jobs")
    web.company("x", None, "")
    web.tables(spark)[1].write.parquet(f"{tmp_path}/fetches")
    assert cli.main(["discover", "--state", state, "--fetches", f"{tmp_path}/fetches", "--limit", "5"]) == 0
    assert cli.main(["report", "--state", state]) == 0
    assert cli.main(["countries", "--state", state]) == 0
    assert cli.main(["export", "--state", state, "--out", f"{tmp_path}/out", "--country", "INDIA", "--per-company"]) == 0
    out = capsys.readouterr().out
    assert "1 India" in out and "1 Norway" in out and "1 rows" in out
    (csv,) = (tmp_path / "out").glob("part-*.csv")
    assert csv.read_text().splitlines()[1].startswith("1,Lumen Dairy,10001,")
    assert cli.main(["export", "--state", state, "--out", f"{tmp_path}/no", "--type", "zoo"]) == 2
    assert cli.main(["discover", "--state", state, "--fetches", f"{tmp_path}/fetches", "--status", "zoo"]) == 2
