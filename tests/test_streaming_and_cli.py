import json

import pytest

from lamella import cli
from lamella.streaming import latest


def test_stream_keeps_the_latest(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "1.json").write_text('{"k": "a", "v": 2, "t": "two"}\n{"k": "b", "v": 1, "t": "one"}\n')
    schema = spark.read.json(str(source)).schema
    query = latest.keep_table(latest.read_appended(spark, str(source), schema), "k", "v", str(tmp_path / "out"), str(tmp_path / "check"))
    query.processAllAvailable()
    (source / "2.json").write_text('{"k": "a", "v": 1, "t": "late"}\n{"k": "b", "v": 3, "t": "three"}\n')
    query.processAllAvailable()
    query.stop()
    assert sorted((r["k"], r["t"]) for r in spark.read.parquet(str(tmp_path / "out/1")).collect()) == [("a", "two"), ("b", "three")]


def test_stream_windows(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/1.json").write_text('{"ts": "2024-01-01T00:10:00Z", "k": "a"}\n{"ts": "2024-01-01T00:20:00Z", "k": "a"}\n{"ts": "2024-01-01T02:00:00Z", "k": "b"}\n')
    stream = latest.read_appended(spark, str(tmp_path / "in"), "ts timestamp, k string")
    query = latest.counts_by_window(stream, "ts", "k").writeStream.format("memory").queryName("windows").outputMode("complete").start()
    query.processAllAvailable()
    query.stop()
    assert sorted((r["k"], r["n"]) for r in spark.sql("select * from windows").collect()) == [("a", 2), ("b", 1)]


def test_config(tmp_path):
    (tmp_path / "raw").mkdir()
    path = tmp_path / "c.toml"
    path.write_text('raw_root = "raw"\noutput_root = "out"\n')
    with pytest.raises(ValueError, match="no inventory"):
        cli.load_config(str(path))
    (tmp_path / "raw/image_inventory.csv").write_text("x")
    assert cli.load_config(str(path)).output_root == tmp_path / "out"
    path.write_text('raw_root = "raw"\noutput_root = "raw/out"\n')
    with pytest.raises(ValueError, match="outside"):
        cli.load_config(str(path))


def test_verbs(tmp_path, capsys):
    (tmp_path / "catalog.json").write_text(json.dumps({"summary": {"images": 3}}))
    assert cli.main(["report", "--catalog", str(tmp_path)]) == 0 and json.loads(capsys.readouterr().out) == {"images": 3}
    assert cli.main(["report", "--catalog", str(tmp_path / "none")]) == 2 and "lamella:" in capsys.readouterr().err
    for verb in ("train", "predict", "benchmark"):
        with pytest.raises(SystemExit):
            cli.main([verb])


def test_scan_gives_every_finding(spark, tmp_path, capsys):
    import subprocess

    for i in range(1200):
        (tmp_path / f"f{i:04}.txt").write_text("a@b.example")
    (tmp_path / ".env").write_text("password = 'abcdefgh'")
    args = cli.parser().parse_args(["scan", "--root", str(tmp_path)])
    assert cli.run(args) == {"findings": 1201}
    out = capsys.readouterr().out.splitlines()
    assert len(out) == 1201 and json.loads(out[0]) == {"path": ".env", "rule": "credential-assignment"} and json.loads(out[-1])["path"] == "f1199.txt"
    for p in tmp_path.glob("f*.txt"):
        p.unlink()
    git = lambda *a: subprocess.run(["git", "-C", str(tmp_path), *a], check=True, capture_output=True)
    git("init", "-q")
    (tmp_path / "gone.txt").write_text("a@b.example")
    (tmp_path / "ignored.txt").write_text("plain")
    (tmp_path / "link.csv").symlink_to("ignored.txt")
    git("add", "gone.txt", "ignored.txt", "link.csv")
    (tmp_path / "gone.txt").unlink()
    (tmp_path / ".gitignore").write_text("ignored.txt\nprivate.txt\n")
    (tmp_path / "private.txt").write_text("a@b.example")
    (tmp_path / "clean.txt").write_text("plain")
    assert cli.run(args)["findings"] == 6
    assert [tuple(json.loads(x).values()) for x in capsys.readouterr().out.splitlines()] == [
        (".env", "credential-assignment"), ("gone.txt", "staged-email-address"), ("ignored.txt", "ignored-tracked-file"),
        ("link.csv", "staged-dataset-or-model-artifact"), ("link.csv", "staged-symlink"), ("link.csv", "symlink"),
    ]
