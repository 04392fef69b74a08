import json
import sys
from pathlib import Path


def test_bench_prints_one_json_line(spark, monkeypatch, capsys):
    root = Path(__file__).resolve().parents[1]
    monkeypatch.syspath_prepend(str(root))
    monkeypatch.setenv("BENCH_SF_DIR", "/root/testdata/sf0.001")
    monkeypatch.setenv("BENCH_CPUS", "2")
    monkeypatch.setattr(sys, "argv", ["bench.py", "class_counts", "describe_table"])
    import bench
    bench.main()
    lines = [ln for ln in capsys.readouterr().out.splitlines() if ln.strip()]
    assert len(lines) == 1
    out = json.loads(lines[0])
    assert out["unit"] == "sec" and out["sf"] == 0.001 and out["failed"] == []
    assert set(out["queries"]) == {"class_counts", "describe_table"}
    assert out["value"] == round(sum(out["queries"].values()), 3)
