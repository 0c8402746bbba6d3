"""Quarantined events sent once more, after their table has been registered or what failed has been mended."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowtide import files
from rowtide.sinks.quarantine import read_quarantine
from rowtide.sources.control import key_lookup, stored_rows
from rowtide.streaming.apply import ChangeApplier

# Reasons that another control table, catalog or store can do away with.
CURABLE = ("no_key", "no_catalog", "write_failed")

ID = "reject_id"
DONE = "done"


def with_id(rejects: DataFrame) -> DataFrame:
    """Quarantine rows with a name that is the same at every reading; equal rows share it."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("writer", "batch_id", "origin", "reason", "schema", "table", "value")]
    return rejects.withColumn(ID, F.sha2(F.to_json(F.array(*parts)), 256))


def _rounds(spark: SparkSession, folder: str) -> dict[int, bool]:
    """Numbers of the rounds so far, and whether each has ended."""
    numbers = [int(n.partition("=")[2]) for n in files.child_names(spark, folder) if n.startswith("round=")]
    return {n: files.exists(spark, f"{folder}/round={n}/{DONE}") for n in sorted(numbers)}


def settled(spark: SparkSession, folder: str) -> DataFrame | None:
    """Ids of the rejects that rounds which have ended have sent."""
    ended = [f"{folder}/round={n}/sent" for n, done in _rounds(spark, folder).items() if done]
    return spark.read.schema(f"{ID} string").parquet(*ended).distinct() if ended else None


def open_rejects(spark: SparkSession, quarantine: str, folder: str) -> DataFrame:
    """Quarantine rows that no round has settled; ``folder`` is where rounds are written down."""
    rejects, sent = with_id(read_quarantine(spark, quarantine)), settled(spark, folder)
    return rejects if sent is None else rejects.join(sent, ID, "left_anti")


def curable_rejects(rejects: DataFrame, control: DataFrame, catalog: DataFrame, reasons: Sequence[str] = CURABLE) -> DataFrame:
    """Rejects for one of the reasons whose table has a key and columns by now."""
    why = F.element_at(F.split("reason", ":"), 1)
    named = key_lookup(rejects.filter(why.isin(list(reasons))), control).filter(F.coalesce("table_id", F.lit("")) != "")
    known = catalog.select(F.col("database").alias("schema"), "table").distinct()
    return named.join(known, ["schema", "table"], "left_semi").select(*rejects.columns)


def replay_rejects(applier: ChangeApplier, reasons: Sequence[str] = CURABLE) -> int:
    """One round: what can be applied today goes through the applier; returns the number of rejects sent.

    ``applier`` needs a name of its own. A round first writes down what it sends, then applies it, then marks itself as
    done; one that is cut short is repeated with the same rejects, which under ``event_order`` changes nothing. What is
    rejected again stands in the quarantine once more, under the applier's name.
    """
    spark, folder = applier.spark, f"{applier.root}/replay/{applier.name}"
    rounds = _rounds(spark, folder)
    number = next((n for n, done in rounds.items() if not done), max(rounds, default=-1) + 1)
    path = f"{folder}/round={number}"
    if not files.exists(spark, f"{path}/sent/_SUCCESS"):
        control = stored_rows(applier.control(), f"{path}/control")
        known = stored_rows(applier.catalog().select("database", "table").distinct(), f"{path}/known")
        rows = curable_rejects(open_rejects(spark, applier.quarantine_path, folder), control, known, reasons)
        rows.select(ID, "value").write.mode("overwrite").parquet(f"{path}/sent")
        for name in ("control", "known"):
            files.delete(spark, f"{path}/{name}")
    sent = spark.read.schema(f"{ID} string, value string").parquet(f"{path}/sent")
    count = sent.count()
    if count:
        applier(sent.select("value"), number)
    files.write_new(spark, f"{path}/{DONE}", str(count))
    return count
