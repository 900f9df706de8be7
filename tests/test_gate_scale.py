"""The gate's Spark work does not grow with the number of bundles."""

import shutil

from tollgate.plans.gate import GateConfig, ReleaseGate


def _jobs(spark, root, group):
    sc = spark.sparkContext
    sc.setJobGroup(group, group)
    try:
        gate = ReleaseGate(spark, GateConfig(data_root=str(root), reference_ts="2026-03-03T17:42:35Z"))
        rep = gate.run()
        n = rep.outcomes.select("bundle").distinct().count()
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    return n, len(sc.statusTracker().getJobIdsForGroup(group))


def test_job_count_is_independent_of_bundle_count(spark, bundles_root, tmp_path):
    small, large = tmp_path / "small", tmp_path / "large"
    names = sorted(p.name for p in bundles_root.iterdir() if p.is_dir())
    for b in names:
        shutil.copytree(bundles_root / b, small / b)
        for i in range(5):
            shutil.copytree(bundles_root / b, large / f"{b}-{i}")
    n_small, jobs_small = _jobs(spark, small, "gate-small")
    n_large, jobs_large = _jobs(spark, large, "gate-large")
    assert (n_small, n_large) == (12, 60)
    # 5x the bundles, (nearly) the same jobs: AQE may add or drop a few small
    # stages once measured sizes change, but nothing is planned per bundle.
    assert jobs_large < 1.2 * jobs_small, (jobs_small, jobs_large)
