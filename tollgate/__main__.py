"""``python -m tollgate``: gate one bundle (or all, ``--bundle '*'``) and write reports."""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from .plans.gate import GateConfig, ReleaseGate
from .session import build_session, checkpoint_dir


def main(argv: Sequence[str] | None = None) -> None:
    ap = argparse.ArgumentParser(description="Run the release gate and write its reports.")
    ap.add_argument("--data-root", default="data", help="folder holding <bundle>/<feed>.csv")
    ap.add_argument("--bundle", default="good", help="bundle name, or '*' for every bundle")
    ap.add_argument("--reports-dir", default="reports", help="where the JSON reports go")
    ap.add_argument("--reference-ts", default=None,
                    help="reference clock (ISO timestamp); default: now")
    ap.add_argument("--master", default=None, help="Spark master (default: from the environment)")
    ap.add_argument("--checkpoint-dir", default=None,
                    help="shared folder for lineage cuts (default: spark.checkpoint.dir)")
    a = ap.parse_args(argv)
    spark = build_session(a.master)
    if a.checkpoint_dir and not spark.conf.get("spark.checkpoint.dir", None):
        checkpoint_dir(spark, a.checkpoint_dir)     # only when the session names none
    bundles = a.bundle if a.bundle == "*" else (a.bundle,)
    gate = ReleaseGate(spark, GateConfig(data_root=a.data_root, bundles=bundles,
                                         reports_dir=a.reports_dir, reference_ts=a.reference_ts))
    gate.run()
    out = gate.write_reports()
    decisions = gate.report.release_decision()
    for r in decisions.groupBy("status").count().orderBy("status").collect():
        print(f"{r['status']}: {r['count']} bundle(s)")
    for r in decisions.where("status <> 'Ready'").orderBy("bundle").limit(20).collect():
        print(f"  {r['bundle']}: {r['status']} - {r['decision_reason']}")
    gate.close()
    print("reports:", out)


if __name__ == "__main__":
    main()
