"""Change data capture into slowly changing dimensions.

``seq`` is a list of columns that orders the events of a key; give a unique tiebreak last.
Events may come late and in any order: results depend on the sequence alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.operators import windows as w
from lakeloom.operators.joins import join_null_safe
from lakeloom.operators.quality import CheckFailed

START, END = "__START_AT", "__END_AT"


def _flag(condition: str | None) -> Column:
    return F.lit(False) if condition is None else F.coalesce(F.expr(condition), F.lit(False))


def _after_truncate(events: DataFrame, seq: list[str], truncate_when: str | None) -> DataFrame:
    """Events later than the newest truncate event."""
    if truncate_when is None:
        return events
    newest = events.filter(_flag(truncate_when)).agg(F.max(F.struct(*seq)).alias("m")).scalar()
    cut = events.withColumn("_cut", newest)
    return cut.filter(F.col("_cut").isNull() | (F.struct(*seq) > F.col("_cut"))).drop("_cut")


def skip_null_rows(events: DataFrame, tracked: list[str]) -> DataFrame:
    """Events whose tracked columns are all null are ignored."""
    return events.filter(F.coalesce(*[F.col(c).cast("string") for c in tracked]).isNotNull())


def scd1(events: DataFrame, keys: list[str], seq: list[str], delete_when: str | None = None,
         truncate_when: str | None = None, ignore_nulls: str | None = None, exclude: list[str] = ()) -> DataFrame:
    """Current row per key: the latest event by ``seq`` wins.

    ``ignore_nulls`` is None, ``"keep_old"`` (a null leaves the older value) or
    ``"skip_row"`` (events with all values null are ignored).  ``exclude`` columns are left
    out.  All steps are aggregates with partial combine."""
    live = _after_truncate(events, seq, truncate_when)
    values = [c for c in live.columns if c not in {*keys, *seq, *exclude}]
    out_columns = [c for c in events.columns if c not in exclude]
    if ignore_nulls == "skip_row":
        live = live.filter(_flag(delete_when) | F.coalesce(
            *[F.col(c).cast("string") for c in values]).isNotNull())
    if ignore_nulls != "keep_old":
        # the latest event decides: a delete as latest event removes the key
        latest = w.latest_per_key(live.withColumn("_del", _flag(delete_when)), keys, seq)
        return latest.filter(~F.col("_del")).select(*out_columns)
    if delete_when is not None:
        gone = live.filter(_flag(delete_when)).groupBy(*keys).agg(F.max(F.struct(*seq)).alias("_gone"))
        live = join_null_safe(live, gone, keys, "left").filter(
            F.col("_gone").isNull() | (F.struct(*seq) > F.col("_gone"))).drop("_gone")
    order = F.struct(*seq)
    newest = live.groupBy(*keys).agg(
        F.max(order).alias("_seq"),
        *[F.max_by(c, F.when(F.col(c).isNotNull(), order)).alias(c) for c in values])
    return newest.select(*[F.col(f"_seq.{c}").alias(c) if c in seq else F.col(c) for c in out_columns])


def scd1_apply(state: DataFrame, batch: DataFrame, keys: list[str], seq: list[str],
               delete_when: str | None = None) -> DataFrame:
    """State after one more batch.  The state keeps a ``_deleted`` row per removed key, so a
    late event cannot bring the key back; ``scd1_view`` hides those rows."""
    marked = batch.withColumn("_deleted", _flag(delete_when)).select(*state.columns)
    return w.latest_per_key(state.unionByName(marked), keys, seq)


def scd1_view(state: DataFrame) -> DataFrame:
    return state.filter(~F.col("_deleted")).drop("_deleted")


def scd2(events: DataFrame, keys: list[str], seq: list[str], delete_when: str | None = None,
         ignore_nulls: bool = False, exclude: list[str] = (), untracked: list[str] = (),
         hot: w.Hot | None = None) -> DataFrame:
    """History rows with ``__START_AT`` and ``__END_AT`` (null while current).

    Start and end are the first column of ``seq``.  Neighbours that differ in no tracked
    column are one version; a delete event closes the version before it."""
    names = [c for c in events.columns if c not in {*exclude}]
    values = [c for c in names if c not in {*keys, *seq}]
    tracked = [c for c in values if c not in set(untracked)]
    rows = events.withColumn("_del", _flag(delete_when))
    hot = hot or w.hot_keys(events, keys)  # counted once, on the raw events
    unique = rows.groupBy(*keys, *seq).agg(F.max(F.struct("_del", *values)).alias("_row")).select(
        *keys, *seq, "_row.*")
    if ignore_nulls:
        # a value is carried forward until the next delete, which starts another life
        lives = w.with_windows(unique.withColumn("_one", F.col("_del").cast("int")), keys, seq,
                               {"_life": w.running("sum", "_one")}, hot=hot)
        tagged = lives.withColumns({f"_t_{c}": F.when(F.col(c).isNotNull() & ~F.col("_del"), F.struct("_life", F.col(c).alias("v")))
                                    for c in values})
        filled = w.with_windows(tagged, keys, seq, {f"_v_{c}": w.running("last", f"_t_{c}") for c in values}, hot=hot)
        unique = filled.select(*keys, *seq, "_del", *[
            F.when(F.col(f"_v_{c}._life") == F.col("_life"), F.col(f"_v_{c}.v")).alias(c) for c in values])
    state = unique.withColumn("_state", F.struct("_del", *tracked))
    marked = w.with_windows(state, keys, seq, {"_before": w.lag("_state")}, hot=hot)
    changed = marked.filter(~F.col("_state").eqNullSafe(F.col("_before"))).drop("_state", "_before")
    closed = w.with_windows(changed.withColumn("_at", F.col(seq[0])), keys, seq, {END: w.lead("_at")}, hot=hot)
    return closed.filter(~F.col("_del")).select(*names, F.col(seq[0]).alias(START), END)


def scd2_refresh(published: DataFrame, events: DataFrame, batch: DataFrame, keys: list[str], seq: list[str],
                 **options) -> DataFrame:
    """History after one more batch: the chains of the batch's keys are rebuilt from all
    their events (so late and deleting events land right), other keys are kept."""
    touched = batch.select(*keys).distinct()
    chain = join_null_safe(events.unionByName(batch), touched, keys, "left_semi")
    kept = join_null_safe(published, touched, keys, "left_anti")
    return kept.unionByName(scd2(chain, keys, seq, **options))


def current_rows(history: DataFrame) -> DataFrame:
    """The open version of each key."""
    return history.filter(F.col(END).isNull()).drop(START, END)


def version_counts(history: DataFrame, keys: list[str], at_least: int = 2) -> DataFrame:
    return (history.groupBy(*keys).agg(F.count(F.lit(1)).alias("versions"))
            .filter(F.col("versions") >= at_least))


def history_audit(history: DataFrame, keys: list[str]) -> DataFrame:
    """All versions of the keys that have more than one, labelled Current or Historical."""
    several = history.join(version_counts(history, keys), keys, "left_semi")
    return several.withColumn("version_status", F.when(F.col(END).isNull(), "Current").otherwise("Historical"))


def original_and_modified(events: DataFrame, keys: list[str], seq: list[str]) -> DataFrame:
    """First and latest event of every key that has several, side by side in ``original`` and
    ``modified``: one aggregate with partial combine."""
    values = F.struct(*[c for c in events.columns if c not in keys])
    pair = events.groupBy(*keys).agg(F.min_by(values, F.struct(*seq)).alias("original"), F.max_by(values, F.struct(*seq)).alias("modified"),
                                     F.min(F.struct(*seq)).alias("_first"), F.max(F.struct(*seq)).alias("_last"))
    return pair.filter("_first <> _last").drop("_first", "_last")


def scd2_merge(dim: DataFrame, source: DataFrame, keys: list[str], tracked: list[str], as_of) -> DataFrame:
    """Manual type 2 step on a dimension with ``is_current``, ``start_date``, ``end_date``:
    a changed current row is closed and its new version inserted in the same run.

    A null key is a key like any other.  Two source rows for one key raise CheckFailed, since each
    would open a version of its own."""
    if source.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").head(1):
        raise CheckFailed("several source rows for one key")
    day = F.lit(as_of).cast("date")
    arriving = source.select(*keys, F.struct(*tracked).alias("_new"))
    left = dim.withColumn("_cur", F.col("is_current"))
    on_current = arriving.withColumn("_cur", F.lit(True))
    joined = join_null_safe(left, on_current, [*keys, "_cur"], "left")
    changed = F.col("_new").isNotNull() & ~F.struct(*tracked).eqNullSafe(F.col("_new"))

    def version(values, current, start, end):
        return F.struct(values.alias("v"), current.alias("is_current"), start.alias("start_date"), end.alias("end_date"))

    old = F.struct(*tracked)
    none = F.lit(None).cast("date")
    versions = F.when(changed, F.array(
        version(old, F.lit(False), F.col("start_date"), day),
        version(F.col("_new"), F.lit(True), day, none),
    )).otherwise(F.array(version(old, F.col("is_current"), F.col("start_date"), F.col("end_date"))))
    names = [*keys, *tracked, "is_current", "start_date", "end_date"]
    kept = joined.select(*keys, F.explode(versions).alias("_r")).select(
        *keys, "_r.v.*", "_r.is_current", "_r.start_date", "_r.end_date")
    fresh = join_null_safe(source, dim.filter("is_current").select(*keys), keys, "left_anti").select(
        *keys, *tracked, F.lit(True).alias("is_current"), day.alias("start_date"), none.alias("end_date"))
    return kept.select(*names).unionByName(fresh.select(*names))


def scd0(events: DataFrame, keys: list[str], seq: list[str]) -> DataFrame:
    """The first row of each key is kept for ever."""
    return w.first_per_key(events, keys, seq)


def scd3(events: DataFrame, keys: list[str], seq: list[str], column: str,
         hot: w.Hot | None = None) -> DataFrame:
    """Current value and the one before its last change."""
    hot = hot or w.hot_keys(events, keys)
    chain = scd2(events.select(*keys, *seq, column), keys, seq, hot=hot)
    ordered = w.with_windows(chain, keys, [START], {f"previous_{column}": w.lag(column)}, hot=hot)
    return ordered.filter(F.col(END).isNull()).select(
        *keys, F.col(column).alias(f"current_{column}"), f"previous_{column}")


def as_of_join(facts: DataFrame, history: DataFrame, keys: list[str], ts: str, values: list[str],
               hot: w.Hot | None = None) -> DataFrame:
    """Each fact with the version valid at its time (start <= time < end), else nulls.

    Facts and versions are put in one time line per key and the last version start is
    carried forward: linear in both inputs and split for hot keys, with no pairs formed."""
    state = F.struct(F.col(END).alias("end"), *values)
    starts = history.select(*keys, F.col(START).alias("_t"), F.lit(0).alias("_side"),
                            state.alias("_state"), F.lit(None).cast(facts.select(F.struct("*").alias("f")).schema["f"].dataType).alias("_fact"))
    rows = facts.select(*keys, F.col(ts).alias("_t"), F.lit(1).alias("_side"),
                        F.lit(None).cast(starts.schema["_state"].dataType).alias("_state"), F.struct("*").alias("_fact"))
    line = w.with_windows(starts.unionByName(rows), keys, ["_t", "_side"], {"_valid": w.running("last", "_state")}, hot=hot)
    found = line.filter("_side = 1")
    open_now = F.col("_valid.end").isNull() | (F.col("_t") < F.col("_valid.end"))
    return found.select("_fact.*", *[F.when(open_now, F.col(f"_valid.{v}")).alias(v) for v in values])
