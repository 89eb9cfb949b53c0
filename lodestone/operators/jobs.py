"""Job state as tables: enqueue, claim, recover, retry, report, and the rate-limit schedule."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestone.operators.gold import insert_absent

STATUSES = ("PENDING", "RUNNING", "SUCCESS", "FAILED")


def enqueue(jobs: DataFrame, documents: DataFrame, stages: list[str], version: str) -> DataFrame:
    """Jobs that are missing: one per document and stage."""
    wanted = documents.select("document_id", F.explode(F.array(*map(F.lit, stages))).alias("stage"), F.lit(version).alias("stage_version"), F.lit("PENDING").alias("status"))
    return insert_absent(jobs, wanted, ["document_id", "stage", "stage_version"])


def pending(jobs: DataFrame, stages: list[str] | None = None, version: str | None = None) -> DataFrame:
    out = jobs.filter("status = 'PENDING'")
    if stages:
        out = out.filter(F.col("stage").isin(*stages))
    return out.filter(F.col("stage_version") == version) if version else out


def claim(jobs: DataFrame, n: int, worker: str, now: Column, lease_seconds: int) -> DataFrame:
    """The ``n`` lowest pending jobs, marked as running under a lease.

    The driver plans one claim at a time; :func:`commit_claim` then writes the new state once, and a second
    claim on the same state finds its file there and is refused, so no job is handed out twice.
    """
    return pending(jobs).orderBy("job_id").limit(n).withColumn("status", F.lit("RUNNING")).withColumn("worker_id", F.lit(worker)).withColumn("lease_expires", now + F.make_interval(secs=F.lit(lease_seconds)))


def commit_claim(jobs: DataFrame, claimed: DataFrame, path: str, generation: int) -> DataFrame:
    """The next state of ``jobs``, written as ``path/<generation>``; fails if that generation exists."""
    state = jobs.join(claimed.select("job_id"), "job_id", "left_anti").unionByName(claimed, allowMissingColumns=True)
    state.write.mode("errorifexists").parquet(f"{path}/{generation:08d}")
    return jobs.sparkSession.read.parquet(f"{path}/{generation:08d}")


def is_stale(now: Column, cutoff: Column) -> Column:
    expired = F.col("lease_expires") < now
    return (F.col("status") == "RUNNING") & F.coalesce(expired, F.col("started_at") < cutoff, F.lit(False))


def recover(jobs: DataFrame, now: Column, cutoff: Column) -> DataFrame:
    stale = is_stale(now, cutoff)
    cleared = {c: F.when(~stale, F.col(c)) for c in ("worker_id", "lease_expires") if c in jobs.columns}
    return jobs.withColumns(cleared | {"error": F.when(stale, "recovered after its lease ran out").otherwise(F.col("error")), "status": F.when(stale, "PENDING").otherwise(F.col("status"))})


def fail(jobs: DataFrame, failed: DataFrame, most: int = 20_000) -> DataFrame:
    """Marks ``(job_id, message)`` as failed, counts the attempt and cuts the message."""
    j = jobs.join(failed.withColumn("hit", F.lit(True)), "job_id", "left")
    hit = F.coalesce("hit", F.lit(False))
    return j.withColumns({"error": F.when(hit, F.substring("message", 1, most)).otherwise(F.col("error")), "retry_count": F.col("retry_count") + hit.cast("int"), "status": F.when(hit, "FAILED").otherwise(F.col("status"))}).drop("hit", "message")


def retry_failed(jobs: DataFrame, prefix: str = "", document_id: str | None = None) -> DataFrame:
    hit = (F.col("status") == "FAILED") & F.col("stage").startswith(prefix)
    if document_id is not None:
        hit = hit & (F.col("document_id") == document_id)
    return jobs.withColumn("status", F.when(hit, "PENDING").otherwise(F.col("status")))


def status_totals(jobs: DataFrame) -> DataFrame:
    """``(stage, stage_version, status, jobs)`` at two levels: details, and one row per status with a null stage."""
    levels = jobs.groupingSets([["stage", "stage_version", "status"], ["status"]], "stage", "stage_version", "status")
    return levels.agg(F.count("*").alias("jobs"))


def status_report(jobs: DataFrame) -> DataFrame:
    return jobs.groupBy("stage", "stage_version", "status").agg(F.count("*").alias("jobs"))


def reusable_chunks(wanted: DataFrame, done: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """Chunks still to do and chunks whose stored success is reused."""
    good = done.filter("status = 'SUCCESS'").select(*keys)
    return wanted.join(good, keys, "left_anti"), wanted.join(good, keys, "left_semi")


def prepare_chunks(wanted: DataFrame, stored: DataFrame, keys: list[str]) -> DataFrame:
    """Chunk jobs of a run: stored successes stay, all others start over as pending without output or error."""
    kept = stored.filter("status = 'SUCCESS'").join(wanted.select(*keys).distinct(), keys, "left_semi")
    fresh = wanted.join(kept.select(*keys), keys, "left_anti").withColumn("status", F.lit("PENDING"))
    return kept.unionByName(fresh, allowMissingColumns=True)


def run_statistics(jobs: DataFrame, calls: DataFrame) -> DataFrame:
    """One row: documents that succeeded and failed, requests, and tokens in and out."""
    done = jobs.agg(F.countDistinct(F.when(F.col("status") == "SUCCESS", F.col("document_id"))).alias("documents_succeeded"), F.countDistinct(F.when(F.col("status") == "FAILED", F.col("document_id"))).alias("documents_failed"))
    spent = calls.agg(F.count("*").alias("requests"), *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("input_tokens", "output_tokens")])
    return done.crossJoin(spent)


def rate_limit_schedule(requests: DataFrame, per_minute: float, tokens_per_minute: float, seconds: str = "t", tokens: str = "tokens", order: list[str] | None = None, by: list[str] | None = None) -> DataFrame:
    """Adds ``cost``, ``scheduled`` and ``wait`` under a virtual schedule of requests and tokens.

    ``scheduled`` is the prefix cost plus the running maximum of arrival less prefix cost.  One limiter
    is one sequence, so its rows pass one ordered window; give ``by`` the limiter key to run many.
    """
    cost = F.greatest(F.lit(60.0 / per_minute), F.col(tokens) * F.lit(60.0 / tokens_per_minute))
    over = Window.partitionBy(*(by or [])).orderBy(*(order or [seconds]))
    before = F.coalesce(F.sum("cost").over(over.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    out = requests.withColumn("cost", cost).withColumn("before", before).withColumn("slack", F.col(seconds) - F.col("before"))
    scheduled = F.col("before") + F.max("slack").over(over.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return out.withColumn("scheduled", scheduled).withColumn("wait", F.col("scheduled") - F.col(seconds)).drop("before", "slack")


def backoff_seconds(attempt: int, base: float, retry_after: float = 0.0, jitter: float = 0.0) -> float:
    """Doubling delay up to a minute, with up to a quarter of jitter, never below ``retry_after``."""
    delay = min(base * 2**attempt, 60.0)
    return max(delay * (1 + 0.25 * jitter), retry_after)


def is_retryable(status: int | None, transport: bool = False) -> bool:
    return transport or status in (408, 429) or (status is not None and status >= 500)
