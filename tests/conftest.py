"""Shared fixtures: one local Spark session, fixture bundles in a temp dir."""

from __future__ import annotations

import os
import sys
import tempfile
from pathlib import Path

import pytest

REPO = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(REPO))
sys.path.insert(0, str(REPO / "tests"))

TESTDATA = Path(os.environ.get("TOLLGATE_TESTDATA", "/root/testdata"))
REFERENCE_TS = "2026-03-03T17:42:35Z"


@pytest.fixture(scope="session")
def spark():
    from tollgate.session import build_session, checkpoint_dir

    s = build_session("local[4]", shuffle_partitions=8)
    checkpoint_dir(s, tempfile.mkdtemp(prefix="tollgate-test-ckpt-"))
    yield s
    s.stop()


# Columns of the feeds.
COLUMNS = {
    "candidates": "candidate_id,birth_date,email,first_name,last_name,created_ts,source_system",
    "exam_results": "exam_result_id,candidate_id,exam_code,exam_date,attempt_number,score,score_scaled,pass_fail,exam_location,file_received_ts",
    "certification_status": "cert_status_id,candidate_id,certification_level,certification_status,certified_ts,status_source,status_effective_ts",
    "disciplinary_flags": "flag_id,candidate_id,flag_type,flag_date,notes",
}


def candidate(cid, email=None):
    return [cid, "1990-02-03", email or f"c{cid}@mail.test", "First", "Last", "2026-01-05T08:00:00Z", "portal"]


def exam(eid, cid, day="2026-02-20", score="80", result="Pass", received="2026-02-27T13:42:35Z", attempt="1"):
    return [eid, cid, "EX-1", day, attempt, score, score, result, "Online", received]


def cert(sid, cid, status="Certified", since="2026-02-21T08:00:00Z"):
    return [sid, cid, "Base", status, since, "System", since]


def write_feed(folder: Path, feed: str, rows, drop: str | None = None) -> None:
    names = COLUMNS[feed].split(",")
    keep = [i for i, n in enumerate(names) if n != drop]
    folder.mkdir(parents=True, exist_ok=True)
    lines = [",".join(names[i] for i in keep), *(",".join(str(r[i]) for i in keep) for r in rows)]
    (folder / f"{feed}.csv").write_text("\n".join(lines) + "\n")


def write_bundle(root: Path, name: str, candidates, exams, certs, flags=None, drop: str | None = None) -> Path:
    folder = root / name
    write_feed(folder, "candidates", candidates)
    write_feed(folder, "exam_results", exams, drop)
    write_feed(folder, "certification_status", certs)
    if flags is not None:
        write_feed(folder, "disciplinary_flags", flags)
    return folder


@pytest.fixture(scope="session")
def bundles_root(tmp_path_factory) -> Path:
    """All fixture bundles side by side: <root>/<bundle>/<feed>.csv. Each has one fault; "good" is only stale."""
    root = tmp_path_factory.mktemp("bundles")
    write_bundle(root, "good", [candidate(11), candidate(12)], [exam("E11", 11), exam("E12", 12, score="41", result="Fail")],
                 [cert("S11", 11), cert("S12", 12, "Not Certified")])
    write_bundle(root, "duplicate-candidate-id", [candidate(21), candidate(21, "other@mail.test")], [exam("E21", 21)], [cert("S21", 21)])
    write_bundle(root, "missing-required-column", [candidate(31)], [exam("E31", 31, score="77")], [cert("S31", 31)], drop="score")
    write_bundle(root, "invalid-score", [candidate(41)], [exam("E41", 41, score="140")], [cert("S41", 41)])
    write_bundle(root, "future-exam-date", [candidate(51)], [exam("E51", 51, day="2026-07-01", received="2026-07-01T09:00:00Z")], [cert("S51", 51)])
    write_bundle(root, "stale-file-timestamp", [candidate(61)], [exam("E61", 61, result="Fail", received="2026-02-15T05:42:35Z")], [cert("S61", 61, "Not Certified")])
    write_bundle(root, "cert-status-inconsistent-with-exam", [candidate(71)], [exam("E71", 71)], [cert("S71", 71, "Needs Review")])
    write_bundle(root, "orphan-certification-row", [candidate(81)], [exam("E81", 81)], [cert("S81", 81), cert("S89", 89)])
    write_bundle(root, "disciplinary-flag-missing-candidate", [candidate(91)], [exam("E91", 91)], [cert("S91", 91)],
                 flags=[["D1", 91, "Conduct", "2026-02-01", "closed"], ["D2", 99, "Conduct", "2026-02-02", "open"]])
    write_bundle(root, "regression-duplicate-exam-attempt", [candidate(101)], [exam("E101a", 101), exam("E101b", 101)], [cert("S101", 101)])
    write_bundle(root, "regression-lagging-exam-file", [candidate(111)], [exam("E111", 111, result="Fail", received="2026-02-06T07:00:00Z")], [cert("S111", 111, "Needs Review")])
    write_bundle(root, "regression-missing-candidate-join", [candidate(123)], [exam("E122", 122)], [cert("S122", 122)])
    return root


def sf_dir(sf: str) -> str:
    d = TESTDATA / f"sf{sf}"
    if not d.exists():
        pytest.skip(f"testdata sf{sf} not available")
    return str(d)
