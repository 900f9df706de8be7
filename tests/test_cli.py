"""`python -m tollgate` entry point on the fixture bundles."""

import json

from tollgate.__main__ import main


def test_cli_gates_all_bundles_and_writes_reports(spark, bundles_root, tmp_path, capsys):
    out = tmp_path / "reports"
    main(["--data-root", str(bundles_root), "--bundle", "*", "--reports-dir", str(out),
          "--reference-ts", "2026-03-03T17:42:35Z"])
    text = capsys.readouterr().out
    assert "Blocked: 11 bundle(s)" in text and "Warning only: 1 bundle(s)" in text
    docs = [json.loads(line) for f in (out / "release_decision").rglob("*.json")
            for line in f.read_text().splitlines() if line]
    assert len(docs) == 12 and all("timestamp" in d for d in docs)
    assert (out / "validation_summary").is_dir() and (out / "defect_summary").is_dir()
