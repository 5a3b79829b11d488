"""Publication slots: which run serves which slot, and which slots are done."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.operators.windows import latest_slot

# The lanes' times, in minutes after midnight (UTC).
LANES = {
    "texas-news": (139, 859),
    "osu-news": (697, 1057, 1417),
    "osu-sports": (727,),
    "texas-sports": (763,),
}


def run_slots(runs: DataFrame, lane: str = "lane", at: str = "created_at") -> DataFrame:
    """Adds the slot that each run serves; null for an unknown lane."""
    slot: Column = F.lit(None).cast("timestamp")
    for name, minutes in LANES.items():
        slot = F.when(F.col(lane) == name, latest_slot(F.col(at), list(minutes))).otherwise(slot)
    return runs.withColumn("slot", slot)


def confirmed(jobs: DataFrame, keys: list[str]) -> DataFrame:
    """Runs with a maintenance job that completed and published, and succeeded or was confirmed."""
    ok = (F.col("job") == "maintain") & (F.col("status") == "completed") & F.col("published")
    return jobs.where(ok & ((F.col("conclusion") == "success") | F.col("confirmed"))).select(*keys).distinct()


def plan(runs: DataFrame, jobs: DataFrame) -> DataFrame:
    """Adds ``eligible``: no other run of its slot, nor an earlier attempt of itself, has a receipt.

    runs: run_id, attempt, lane, slot; jobs: run_id, attempt, job, status, conclusion, published, confirmed.
    """
    done = runs.join(confirmed(jobs, ["run_id", "attempt"]), ["run_id", "attempt"], "left_semi")
    per_slot = done.groupBy("lane", "slot").agg(
        F.count_distinct("run_id").alias("n_runs"), F.min("run_id").alias("some_run")
    )
    own = done.groupBy("run_id").agg(F.min("attempt").alias("first_receipt"))
    out = runs.join(per_slot, ["lane", "slot"], "left").join(own, "run_id", "left")
    other = (F.coalesce("n_runs", F.lit(0)) > 1) | (F.coalesce(F.col("some_run") != F.col("run_id"), F.lit(False)))
    earlier = F.coalesce(F.col("first_receipt") < F.col("attempt"), F.lit(False))
    return out.withColumn("eligible", F.col("slot").isNull() | ~(other | earlier)).drop("n_runs", "some_run", "first_receipt")
