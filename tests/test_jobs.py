"""The scheduled jobs end to end on stand-in inputs written as parquet: their appended
ledgers, folded to current state, equal the registered queries' results."""

import os
import tempfile

from fleetwarden import jobs
from fleetwarden.plans import standins as S
from fleetwarden.plans.registry import QUERIES
from fleetwarden.sources import current_state

from .conftest import SF_SMALL


def _rows(df, cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_index_job_matches_registry(spark):
    root = tempfile.mkdtemp(prefix="fw-job-")
    hub = os.path.join(root, "hub")
    S.servers(spark, SF_SMALL).write.parquet(f"{hub}/servers")
    S.run_databases(spark, SF_SMALL).write.parquet(f"{hub}/databases")
    before, after = os.path.join(root, "before"), os.path.join(root, "after")
    S._catalog_snapshot(spark, SF_SMALL, "before").write(before)
    S._catalog_snapshot(spark, SF_SMALL, "after").write(after)
    S.actions(spark, SF_SMALL).write.parquet(f"{hub}/actions")
    S.connect_failed(spark, SF_SMALL).write.parquet(f"{hub}/connect_failed")
    out = os.path.join(root, "out")
    jobs.main(["index", "--hub", hub, "--before", before, "--after", after, "--run-ts", S.RUN_TS, "--out", out])
    cols = ["run_key", "fk_pk_id_db_j", "det_clocking", "det_perc_bloat", "det_perc_bloat_after", "det_index_name"]
    assert _rows(current_state(spark, f"{out}/run_ledger", "run_ledger"), cols) == _rows(QUERIES["run_ledger_fold"](spark, SF_SMALL), cols)
    ecols = ["fk_pk_id_db_k", "err_label", "err_code"]
    assert _rows(current_state(spark, f"{out}/run_errors", "run_errors"), ecols) == _rows(QUERIES["run_error_rows"](spark, SF_SMALL), ecols)


def test_slice_job_matches_registry(spark):
    root = tempfile.mkdtemp(prefix="fw-sjob-")
    hub = os.path.join(root, "hub")
    S.servers(spark, SF_SMALL).write.parquet(f"{hub}/servers")
    S.databases(spark, SF_SMALL).write.parquet(f"{hub}/databases")
    S.pg_ini(spark, SF_SMALL).write.parquet(f"{hub}/pg_ini")
    S.logs(spark, SF_SMALL).write.parquet(f"{root}/logs")
    S.log_files(spark, SF_SMALL).write.parquet(f"{root}/files")
    out = os.path.join(root, "out")
    args = ["slice", "--hub", hub, "--logs", f"{root}/logs", "--files", f"{root}/files", "--out", out, "--strip-domain", S.HOST_DOMAIN]
    runs = S.slice_runs(spark, SF_SMALL)
    for name, part in (("one", "hour(run_ts) < 12"), ("two", "hour(run_ts) >= 12"), ("two", "hour(run_ts) >= 12")):
        folder = f"{root}/runs-{name}"
        runs.where(part).write.mode("overwrite").parquet(folder)
        jobs.main([*args, "--runs", folder, "--batch-ts", f"2024-02-0{1 + (name == 'two')} 00:00:00"])
    cols = ["server_id", "pk_id_pgini", "run_ts", "log_mod", "log_size", "log_slice_size", "log_name", "log_slice_name"]
    assert _rows(current_state(spark, f"{out}/slice_ledger", "slice_ledger"), cols) == _rows(QUERIES["slice_ledger_fold"](spark, SF_SMALL), cols)
    # both batches' slices are there, and the retried one only once
    assert spark.read.parquet(f"{out}/slices").count() == QUERIES["slice_rows"](spark, SF_SMALL).count()
    got, want = current_state(spark, f"{out}/slice_errors", "slice_errors"), QUERIES["slice_error_rows"](spark, SF_SMALL)
    assert got.count() == want.count()
