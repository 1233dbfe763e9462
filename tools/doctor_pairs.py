"""Gold over millions of distinct (doctor id, name) pairs: time, scratch size, what is left behind.

Usage: python tools/doctor_pairs.py [rows] [cpus]. Prints a table for STAGES.md. Silver rows are
made up for this measurement only: ids and names are drawn independently, 9,000 by
1,000, as the message producer draws them.
"""

from __future__ import annotations

import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from visitflow.operators import gold  # noqa: E402
from visitflow.plans.batch import write_gold_tables  # noqa: E402
from visitflow.session import local_session, scratch_path  # noqa: E402


def _size(folder: str) -> float:
    walk = os.walk(folder.replace("file:", ""))
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in walk for f in names) / 1e6


def main() -> None:
    rows = int(sys.argv[1]) if len(sys.argv) > 1 else 3_000_000
    cpus = sys.argv[2] if len(sys.argv) > 2 else "4"
    shared = tempfile.mkdtemp(prefix="visitflow-pairs-")
    spark = local_session(cpus, extra={"spark.checkpoint.dir": f"file:{shared}"})
    draw = lambda seed, n: F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(n))
    pick = lambda seed, *names: F.element_at(F.array(*map(F.lit, names)), (draw(seed, len(names)) + 1).cast("int"))
    silver = spark.range(rows).select(
        F.concat(F.lit("2024-01-"), F.lpad((draw(1, 28) + 1).cast("string"), 2, "0"), F.lit("T08:00:00")).alias("timestamp"),
        draw(2, 100).cast("int").alias("age"),
        (draw(3, 300) / 10).alias("wbc"),
        (draw(4, 200) / 10 + 5).alias("hgb"),
        pick(5, "MALE", "FEMALE").alias("gender"),
        pick(6, "MILD", "MODERATE", "SEVERE").alias("severity"),
        (draw(6, 3) + 1).cast("int").alias("severity_score"),
        pick(7, "YOUNG_ADULT", "MIDDLE_AGED", "SENIOR", "ELDERLY").alias("age_group"),
        pick(8, "LOW", "NORMAL", "HIGH").alias("wbc_status"),
        pick(9, "LOW", "NORMAL", "HIGH").alias("hgb_status"),
        pick(10, "LATEX", "NO ALLERGY").alias("allergy"),
        (draw(11, 9000) + 1000).cast("int").alias("doctor_id"),
        F.concat(F.lit("DR. NAME"), draw(12, 1000).cast("string")).alias("doctor_name"),
        pick(13, "I10", "E11.9").alias("diagnosis_code"),
        pick(13, "A", "B").alias("diagnosis_desc"),
    )
    path = f"file:{shared}/silver"
    silver.write.parquet(path)
    silver = spark.read.parquet(path)
    pairs = silver.select("doctor_id", "doctor_name").distinct().count()
    agg = scratch_path(spark, "pairs-aggregate")
    t0 = time.perf_counter()
    gold.store_aggregate(gold.aggregate_all(silver), agg)
    stored_s = time.perf_counter() - t0
    times = []
    for run in range(2):
        t0 = time.perf_counter()
        write_gold_tables(silver, f"file:{shared}/gold{run}")
        times.append(time.perf_counter() - t0)
    scratch = [d for d in os.listdir(os.path.dirname(agg.replace("file:", ""))) if d.startswith("gold-aggregate")]
    print("| silver rows | silver MB | doctor pairs | stored aggregate MB (doctors / rest) | aggregate s | nine tables s (1st, 2nd run) | left in scratch |")
    print("| --- | --- | --- | --- | --- | --- | --- |")
    print(
        f"| {rows} | {_size(path):.0f} | {pairs} | {_size(agg + '/grain=top_doctors'):.1f} / "
        f"{_size(agg) - _size(agg + '/grain=top_doctors'):.1f} | {stored_s:.1f} | {times[0]:.1f}, {times[1]:.1f} | {len(scratch)} folders |"
    )
    spark.stop()


if __name__ == "__main__":
    main()
