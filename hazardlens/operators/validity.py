"""What was known of an asset at a moment: validity intervals from imports, and an as-of join."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hazardlens.functions.ordering import first_row
from hazardlens.functions.text import is_blank
from hazardlens.operators.axes import asset_context

DAY = 86_400
# intervals and moments meet by stretches of this many seconds
BUCKET = 32 * DAY


def seconds(c):
    """A date or time as text as seconds of UTC."""
    return F.unix_timestamp(F.col(c).try_cast("timestamp") if isinstance(c, str) else c)


def context_intervals(history: DataFrame, order: Sequence[str] = ("source_file", "seq")) -> DataFrame:
    """``asset_name``, its context, ``import_id``, ``valid_from``, ``valid_to`` (exclusive, null if still valid).

    An import says what holds from its moment to that of the next import; of imports of
    one moment the last by id counts. An asset that the next import lacks is not known
    from then on, until an import has it again. Neighbouring intervals with the same
    context are one, under the id of the first. The context of an import is its first row
    of the asset. Rows without a name or a readable moment are left out.
    """
    at = seconds("imported_at")
    rows = history.where(~is_blank("assetName") & at.isNotNull())
    named = rows.select("import_id", at.alias("valid_from"), *order, *asset_context(rows))
    context = [c for c in named.columns if c not in ("import_id", "valid_from", "asset_name", *order)]
    # as many rows as imports; a moment belongs to its last import and ends with the next moment
    moments = named.groupBy("valid_from").agg(F.max("import_id").alias("import_id"))
    until = moments.withColumn("valid_to", F.lead("valid_from").over(Window.partitionBy(F.lit(0)).orderBy("valid_from")))
    first = named.groupBy("asset_name", "import_id", "valid_from").agg(first_row(F.struct(*context), order).alias("context"))
    known = first.join(until, ["valid_from", "import_id"])
    # an import's row of an asset goes on with the one before if that ends here and says the same
    asset = Window.partitionBy("asset_name").orderBy("valid_from")
    same = (F.lag("valid_to").over(asset) == F.col("valid_from")) & F.lag("context").over(asset).eqNullSafe(F.col("context"))
    started = known.withColumn("_starts", F.when(F.coalesce(same, F.lit(False)), 0).otherwise(1))
    run = started.withColumn("_run", F.sum("_starts").over(asset))
    whole = run.groupBy("asset_name", "_run").agg(
        F.min_by("context", "valid_from").alias("context"),
        F.min_by("import_id", "valid_from").alias("import_id"),
        F.min("valid_from").alias("valid_from"),
        F.max_by(F.struct("valid_to"), "valid_from").alias("_last"),
    )
    return whole.select("asset_name", "context.*", "import_id", "valid_from", F.col("_last.valid_to").alias("valid_to"))


def as_of(moments: DataFrame, intervals: DataFrame, at: str, key: str = "asset_name", bucket: int = BUCKET) -> DataFrame:
    """Each row of ``moments`` with the interval of its key that holds at ``at`` (seconds), null where none does.

    Intervals of a key do not overlap. An interval is listed once for each stretch of
    ``bucket`` seconds that it touches, and a moment meets those of its own stretch only, so
    a key with many moments is dealt by time too. An open interval ends, for the listing,
    with the last moment asked for.
    """
    # one row, of one number
    last = moments.agg(F.max(at).alias("_last"))
    ends = F.least(F.coalesce(F.col("valid_to") - 1, F.col("_last")), F.col("_last"))
    listed = intervals.join(F.broadcast(last)).where(F.col("valid_from") <= F.col("_last"))
    listed = listed.withColumn("_bucket", F.explode(F.sequence(F.floor(F.col("valid_from") / bucket), F.floor(ends / bucket))))
    found = listed.withColumnRenamed(key, "_key").drop("_last")
    inside = (F.col(at) >= F.col("valid_from")) & (F.col("valid_to").isNull() | (F.col(at) < F.col("valid_to")))
    on = (F.col(key) == F.col("_key")) & (F.col("_here") == F.col("_bucket")) & inside
    dealt = moments.withColumn("_here", F.floor(F.col(at) / bucket))
    return dealt.join(found, on, "left").drop("_key", "_here", "_bucket")
