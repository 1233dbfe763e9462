"""Silver cleaning: dedupe, validate, standardise, classify.

Order matters (it is part of the semantics): the dedupe on ``id`` runs *before*
the validity filter, so a dirty first delivery suppresses a later clean
redelivery of the same id. ``dedupe="after_validation"`` offers the other
order explicitly.

Scale notes
-----------
* Batch dedupe is ``row_number() over (partition by id order by delivery_seq)
  = 1``. Spark plans it as a *partial* WindowGroupLimit before the shuffle and
  a final one after it, so a hot id (a replayed message, or the null/empty id)
  is cut to one row per map task before it crosses the network; no task ever
  receives more than (number of map tasks) rows of one id.
* The id part of the validity filter only reads the partition key, so Catalyst
  pushes it below the window: null and empty ids never reach the shuffle.
  The age/lab checks stay above the dedupe, which is what keeps the order rule.
* On a stream the dedupe is the state-store ``dropDuplicates(["id"])``; arrival
  order across micro-batches decides which delivery wins. Rows without an id are
  filtered before it, so they are no hot key. ``salt_buckets`` adds a first
  ``(id, salt)`` stage so a hot id is spread over several tasks.
* All standardisation is one ``select`` of built-in expressions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from visitflow.functions import rules
from visitflow.schema import DELIVERY_SEQ

_RN = "__first_delivery_rank"


def dedupe_first_delivery(
    df: DataFrame, key: str = "id", order_by: Sequence[str | Column] = (DELIVERY_SEQ,)
) -> DataFrame:
    """Keep one row per ``key``: the first in arrival order (batch) or the first seen (stream).

    Null keys form one group, as in ``dropDuplicates``.
    """
    if df.isStreaming:
        return df.dropDuplicates([key])
    w = Window.partitionBy(key).orderBy(*order_by)
    return df.withColumn(_RN, F.row_number().over(w)).filter(F.col(_RN) == 1).drop(_RN)


def dedupe_stream_salted(df: DataFrame, salt_buckets: int, key: str = "id") -> DataFrame:
    """Stream dedupe for streams where one id may carry a large share of a micro-batch.

    Stage 1 dedupes on ``(id, salt)``, with the salt taken from the delivery's
    arrival order, so the deliveries of a hot id are spread over
    ``salt_buckets`` state partitions; stage 2 dedupes on ``id`` and receives
    at most ``salt_buckets`` rows per id. The result is the same as one
    ``dropDuplicates([id])`` (the first micro-batch holding an id wins), at the
    cost of a second, smaller state.
    """
    salt = "__dedupe_salt"
    salted = df.withColumn(salt, F.pmod(F.xxhash64(F.col(DELIVERY_SEQ)), F.lit(salt_buckets)))
    return salted.dropDuplicates([key, salt]).dropDuplicates([key]).drop(salt)


def dedupe_within_watermark(
    df: DataFrame, time_col: str, delay: str, key: str = "id"
) -> DataFrame:
    """Stream dedupe with bounded state: ids are forgotten once the watermark passes.

    A redelivery that arrives more than ``delay`` after the watermark has moved
    past its first delivery is *not* suppressed. A record whose event time is
    older than the watermark (latest event time seen minus ``delay``) is dropped
    as late, so ``delay`` must exceed the stream's disorder; the query's progress
    counts such rows (``streaming.silver.late_rows``).
    """
    return df.withWatermark(time_col, delay).dropDuplicatesWithinWatermark([key])


def quality_filter(df: DataFrame) -> DataFrame:
    """Drop rows outside the clinical ranges or without id / first name."""
    return df.filter(rules.quality_predicate())


def standardise(df: DataFrame) -> DataFrame:
    """Apply every mapping rule in one projection; adds the derived columns.

    Rule order of the reference: gender map, upper-casing, allergy label, age
    band, lab classes, severity score (on the upper-cased severity), metadata
    stamps, then null defaults.
    """
    severity_upper = F.upper(F.col("severity"))
    replaced = {
        "gender": rules.gender_label("gender"),
        **{c: F.upper(F.col(c)) for c in rules.UPPERCASE_COLUMNS},
        "allergy": rules.allergy_label("allergy"),
    }
    derived = {
        "age_group": rules.age_band("age"),
        "wbc_status": rules.wbc_class("wbc"),
        "hgb_status": rules.hgb_class("hgb"),
        "severity_score": rules.severity_score(severity_upper),
        "processed_date": F.current_timestamp(),
        "data_quality_status": F.lit(rules.QUALITY_LABEL),
    }
    out = []
    for name in df.columns:
        out.append(replaced[name].alias(name) if name in replaced else F.col(name))
    out.extend(expr.alias(name) for name, expr in derived.items())
    return df.select(*out).fillna({c: rules.UNKNOWN for c in rules.DEFAULTED_COLUMNS})


def clean(
    df: DataFrame,
    dedupe: str = "before_validation",
    order_by: Sequence[str | Column] = (DELIVERY_SEQ,),
    salt_buckets: int | None = None,
) -> DataFrame:
    """Bronze (decoded) rows -> silver rows.

    ``dedupe``: ``"before_validation"`` (reference order), ``"after_validation"``
    or ``"none"``. ``salt_buckets`` (streams only) switches to the salted
    two-stage dedupe for hot ids.
    """

    def first(d: DataFrame) -> DataFrame:
        if salt_buckets and d.isStreaming:
            return dedupe_stream_salted(d, salt_buckets)
        return dedupe_first_delivery(d, order_by=order_by)

    if dedupe == "before_validation":
        if df.isStreaming:
            # Rows without an id can't survive validation; left in, they would all be one
            # key of the state store. (In batch Catalyst pushes this below the window.)
            df = df.filter(rules.present("id"))
        df = quality_filter(first(df))
    elif dedupe == "after_validation":
        df = first(quality_filter(df))
    elif dedupe == "none":
        df = quality_filter(df)
    else:
        raise ValueError(f"unknown dedupe mode {dedupe!r}")
    return standardise(df)
