"""The validation gate per micro-batch of a Structured Streaming source.

Each batch is gated against a fixed contract inside ``foreachBatch``:
findings and a run record are written to their tables, and the batch rows
go to the published or the quarantine sink by the gate decision. Writes are
keyed by the batch id, so a replayed batch after a failure overwrites its
own output instead of duplicating it (exactly-once per batch folder).

Row-count and fingerprint checks compare a batch with the whole contracted
snapshot and always differ for a slice of it, so they are reported but do
not decide the routing here (``decide_on``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from quaystone.operators.gate import run_gate
from quaystone.operators.runs import append_run, run_record
from quaystone.plans.contract import DatasetContract

SNAPSHOT_ONLY_CHECKS = ("SCALE_DRIFT_ROW_COUNT", "INTEGRITY_SHA256_MATCH")


def gate_batches(stream: DataFrame, contract: DatasetContract, *, out_root: str, checkpoint: str,
                 trigger_once: bool = True, decide_on=None):
    """Start a streaming query that gates every micro-batch.

    ``out_root`` gets ``published/batch=<id>``, ``quarantine/batch=<id>`` and
    ``findings/batch=<id>`` parquet folders and the records ``runs``. A batch has
    rows in one of the first two only, also when a replay decides otherwise.
    """
    ignore = set(SNAPSHOT_ONLY_CHECKS if decide_on is None else ())

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        report = run_gate(batch, contract, run_id=f"batch-{batch_id}")
        blocking = [f for f in report.findings if f.severity == "ERROR" and f.check_id not in ignore]
        report.findings_df(spark).write.mode("overwrite").parquet(f"{out_root}/findings/batch={batch_id}")
        target, other = ("quarantine", "published") if blocking else ("published", "quarantine")
        batch.limit(0).write.mode("overwrite").parquet(f"{out_root}/{other}/batch={batch_id}")
        batch.write.mode("overwrite").parquet(f"{out_root}/{target}/batch={batch_id}")
        append_run(run_record(spark, run_id=report.run_id, report=report, rows=batch.count(), columns=len(batch.columns),
                              status="halted_validation" if blocking else "completed", validate_only=True), f"{out_root}/runs")

    writer = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    if trigger_once:
        writer = writer.trigger(availableNow=True)
    return writer.start()
