"""Edit audit: compare a master table with a batch of entries or with another master."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zoneflow.functions.stats import exact_percentiles
from zoneflow.functions.text import float_text
from zoneflow.session import checked_broadcast, compile_in_parts, is_small, nan_to_null, written

NORMAL_RANGE = (0.05, 0.95)


@dataclass
class AuditLogs:
    update_log: DataFrame
    warning_log: DataFrame


def epoch_to_timestamp(c: Column | str) -> Column:
    """Epoch milliseconds to a timestamp in whole seconds, in the session (UTC) zone."""
    return F.date_trunc("second", F.timestamp_millis(c))


def numeric_columns(df: DataFrame, pk: str) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, (T.DoubleType, T.FloatType)) and f.name != pk]


def string_columns(df: DataFrame, pk: str) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and f.name != pk]


def normal_ranges(master: DataFrame, columns: list[str]) -> dict[str, tuple[float, float] | None]:
    """5th and 95th percentile per numeric column of the master; None if it is all null."""
    found = exact_percentiles(master, columns, list(NORMAL_RANGE))
    return {c: None if v[NORMAL_RANGE[0]] is None else (v[NORMAL_RANGE[0]], v[NORMAL_RANGE[1]])
            for c, v in found.items()}


def duplicate_keys(df: DataFrame, pk: str) -> DataFrame:
    return df.groupBy(pk).agg(F.count("*").alias("n")).where("n > 1")


def keys_with_n_rows(df: DataFrame, pk: str, n: int) -> DataFrame:
    return df.groupBy(pk).agg(F.count("*").alias("n")).where(F.col("n") == n).select(pk)


def _old(c: str) -> Column:
    return F.col(f"old__{c}")


def _new(c: str) -> Column:
    return F.col(f"new__{c}")


def _digests(columns: list[str]) -> list[Column]:
    """128 bits of a row in two numbers. Hashes skip nulls, so which columns are null is hashed too."""
    nulls = [F.isnull(c) for c in columns]
    return [F.xxhash64(F.lit(seed), *nulls, *columns).alias(f"_d{seed}") for seed in (1, 2)]


def _matched(left: DataFrame, right: DataFrame, pk: str, how: str) -> DataFrame:
    """Joined on the key, null keys with each other; the key comes from whichever side has it."""
    both = left.join(right.withColumnRenamed(pk, "_key"), F.col(pk).eqNullSafe(F.col("_key")), how)
    return both.withColumn(pk, F.coalesce(pk, "_key")).drop("_key") if how == "full_outer" else both.drop("_key")


def edits(master: DataFrame, entries: DataFrame, pk: str, mode: str) -> DataFrame:
    """(pk, edit_type) of the keys that are logged: all keys of entries, or those whose rows differ between
    two masters. Only key and digest of a row move; they combine per key before the shuffle."""
    if mode not in ("entries", "masters"):
        raise ValueError(f"mode must be 'entries' or 'masters', not {mode!r}")
    columns = entries.columns

    def side(df: DataFrame, new: bool) -> DataFrame:
        return df.select(pk, F.lit(new).alias("_new"), *_digests(columns))

    new, old = F.col("_new"), ~F.col("_new")
    keys = side(master, False).unionByName(side(entries, True)).groupBy(pk).agg(
        F.count_if(old).alias("_old_rows"), F.count_if(new).alias("_new_rows"),
        *[F.max(F.when(which, F.col(d))).alias(f"{d}_{name}") for d in ("_d1", "_d2") for which, name in ((old, "old"), (new, "new"))])
    differs = ~(F.col("_d1_old").eqNullSafe(F.col("_d1_new")) & F.col("_d2_old").eqNullSafe(F.col("_d2_new")))
    repeated = (F.col("_old_rows") > 1) | (F.col("_new_rows") > 1)
    complaint = F.raise_error(F.concat(F.lit("repeated key: "), F.coalesce(F.col(pk).cast("string"), F.lit("null"))))
    return keys.where(F.col("_new_rows") > 0 if mode == "entries" else repeated | differs).select(pk, (
        F.when(repeated, complaint.cast("string"))
        .when(F.col("_old_rows") == 0, "C").when(F.col("_new_rows") == 0, "D").otherwise("U")
    ).alias("edit_type"))


def pair_rows(master: DataFrame, entries: DataFrame, pk: str, mode: str) -> DataFrame:
    """Key, ``old__*`` and ``new__*`` columns and ``edit_type``: entries with their master
    rows, or the rows of two masters that differ. Whole rows move only for logged keys."""
    if mode == "entries" and is_small(entries.select(pk)):
        # A batch of checked size: cut the master to the touched keys without a shuffle.
        touched = F.broadcast(entries.select(F.col(pk).alias("_key")).distinct())
        master = master.join(touched, F.col(pk).eqNullSafe(F.col("_key")), "left_semi")
    found = written(edits(master, entries, pk, mode), "edits")
    listed = F.broadcast(found) if is_small(found) else found

    def side(df: DataFrame, name: str, types: list[str]) -> DataFrame:
        rows = _matched(df, listed.where(F.col("edit_type").isin(types)), pk, "inner")
        return rows.select(pk, F.col("edit_type").alias(f"_{name}_type"), *[F.col(c).alias(f"{name}__{c}") for c in df.columns])

    pairs = _matched(side(entries, "new", ["C", "U"]), side(master, "old", ["U", "D"]), pk, "full_outer")
    return pairs.withColumn("edit_type", F.coalesce("_new_type", "_old_type")).drop("_new_type", "_old_type")


def _listed(items: list[tuple[Column, Column]]) -> Column:
    """The texts whose condition holds. Arrays put together are compiled, a lambda over one is not."""
    none = F.array().cast("array<string>")
    return F.concat(*[F.when(condition, F.array(text)).otherwise(none) for condition, text in items]) if items else none


def _count(conditions: list[Column]) -> Column:
    return reduce(add, [c.cast("int") for c in conditions], F.lit(0))


def updates(
    master: DataFrame,
    entries: DataFrame,
    pk: str = "recid",
    mode: str = "entries",
    city: str | None = "city_name",
    editor: str | None = "editor",
    edit_date: str | None = "edit_date",
    main_version: int = 1,
    numeric: list[str] | None = None,
    bounds: dict[str, tuple[float, float] | None] | None = None,
) -> AuditLogs:
    """Update log (one row per created, updated or deleted key) and warning log.

    Both tables share one schema; ``pk`` must be unique in each, a repeated key fails the
    job; a null key is a key. Keys and row digests are compared first, and whole rows are fetched and
    written to the shared folder for logged keys only: nothing stays cached. Ranges come from ``bounds`` or the master's percentiles. A text value is novel when
    its column in the master never holds it; only the distinct changed values are looked up.
    """
    compile_in_parts(entries.sparkSession)
    columns = entries.columns
    master = nan_to_null(master.select(*columns))
    entries = nan_to_null(entries)
    numeric = numeric_columns(entries, pk) if numeric is None else numeric
    strings = string_columns(entries, pk)
    bounds = normal_ranges(master, numeric) if bounds is None else bounds

    pairs = written(pair_rows(master, entries, pk, mode), "pairs")
    is_update, is_deleted = F.col("edit_type") == "U", F.col("edit_type") == "D"

    changed = {c: ~_old(c).eqNullSafe(_new(c)) for c in columns}
    listed = _listed([(is_update & changed[c], F.lit(c)) for c in columns])
    n_changed = _count(list(changed.values()))
    from_null = _count([_old(c).isNull() for c in numeric]) - _count([_new(c).isNull() for c in numeric])
    to_null = _count([_old(c).isNotNull() & _new(c).isNull() for c in numeric])

    range_warnings = []
    for c in numeric:
        if bounds.get(c) is None:
            continue
        low, high = bounds[c]
        value = F.coalesce(_new(c), F.when(is_deleted, _old(c)))
        outside = (value < low) | (value > high)
        range_warnings.append((
            outside & (~is_update | changed[c]),
            F.concat(F.lit(f"{c} value is out of range (val = "), float_text(value), F.lit(")")),
        ))

    log = _with_novel(pairs, master, strings, pk) if strings else pairs.withColumn("_novel", _listed([]))

    def newer(c: str | None) -> Column:
        return F.when(is_deleted, _old(c)).otherwise(_new(c)) if c in columns else F.lit(None).cast("string")

    def row(side: str) -> Column:
        return F.struct(*[F.col(f"{side}__{c}").alias(c) for c in columns])

    stale = (_new(edit_date) < _old(edit_date)) if edit_date in columns else F.lit(None).cast("boolean")
    log = log.select(
        pk,
        newer(city).alias("city_name"),
        "edit_type",
        listed.alias("cols_updated"),
        F.when(is_update, from_null).alias("updated_from_nan"),
        F.when(is_update, to_null).alias("updated_to_nan"),
        F.when(is_update, n_changed - from_null).alias("changed_vals"),
        _listed(range_warnings).alias("_range"),
        "_novel",
        newer(editor).alias("editor"),
        newer(edit_date).alias("edit_timestamp"),
        F.lit(main_version).alias("main_version"),
        stale.alias("stale_edit"),
        F.when(F.col("edit_type") != "C", row("old")).alias("old_row"),
        F.when(~is_deleted, row("new")).alias("new_row"),
    ).select(
        "*",
        F.size("_range").alias("out_of_range"),
        F.concat("_range", "_novel").alias("warnings"),
    ).drop("_range", "_novel")
    return AuditLogs(log, warnings_of(log, pk))


def _with_novel(pairs: DataFrame, master: DataFrame, strings: list[str], pk: str) -> DataFrame:
    """``pairs`` with ``_novel``: warnings of values the master does not hold, in column order. A value
    equal to its old one is in the master, so only changed and created cells are looked at."""
    created, update = F.col("edit_type") == "C", F.col("edit_type") == "U"
    asked = {c: created | (update & (_old(c) != _new(c))) for c in strings}
    cells = pairs.select(pk, F.inline(F.array_compact(F.array(*[
        F.when(_new(c).isNotNull() & asked[c], F.struct(F.lit(i).alias("_col"), _new(c).alias("_val")))
        for i, c in enumerate(strings)
    ]))))
    values = written(cells.select("_col", "_val").distinct(), "values")
    small = is_small(values)
    known = master.select(F.inline(F.array(*[
        F.struct(F.lit(i).alias("_col"), F.col(c).alias("_val")) for i, c in enumerate(strings)
    ])))
    # Few changed values filter the master where it is read; many are compared with its
    # distinct values, which combine before the shuffle.
    known = known if small else known.distinct()
    known = known.join(F.broadcast(values) if small else values, ["_col", "_val"], "left_semi").distinct()
    unseen = values.join(known, ["_col", "_val"], "left_anti")

    def warning(value: Column, name: Column) -> Column:
        return F.concat(F.lit('"'), value, F.lit('" not in other row records for '), name)

    if small:
        # No more than the values, which were measured: pairs meet them where they lie, column by column.
        unseen, log, found = written(unseen, "unseen"), pairs, []
        for i in sorted(r["_col"] for r in unseen.select("_col").distinct().collect()):
            c, value = strings[i], F.col(f"_unseen{i}")
            of_column = F.broadcast(unseen.where(F.col("_col") == i).select(F.col("_val").alias(f"_unseen{i}")))
            log = log.join(of_column, asked[c] & (_new(c) == value), "left")
            found.append((value.isNotNull(), warning(value, F.lit(c))))
        return log.select(*pairs.columns, _listed(found).alias("_novel"))
    names = F.array(*[F.lit(c) for c in strings])
    novel = cells.join(unseen, ["_col", "_val"]).groupBy(pk).agg(F.array_sort(F.collect_list(F.struct("_col", "_val"))).alias("_cells"))
    novel = novel.select(pk, F.transform("_cells", lambda x: warning(x["_val"], F.get(names, x["_col"]))).alias("_novel"))
    log = _matched(pairs, novel, pk, "left")
    return log.withColumn("_novel", F.coalesce("_novel", _listed([])))


def warnings_of(log: DataFrame, pk: str) -> DataFrame:
    return log.select(
        F.col("city_name").alias("city"), "editor", "edit_timestamp", pk,
        F.explode("warnings").alias("warning"),
    )


def parcels_affected(log: DataFrame, parcels: DataFrame, pk: str = "recid", geom: str = "geom_id") -> DataFrame:
    """Number of parcels with a geometry per logged key; null where the key has none listed."""
    counts = parcels.groupBy(pk).agg(F.count(geom).alias("num_parcels_affected"))
    return log.join(counts, pk, "left")


def changed_rows(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows that occur exactly once in the two tables together."""
    both = new.unionByName(old, allowMissingColumns=True)
    return both.groupBy(*both.columns).agg(F.count("*").alias("_n")).where("_n = 1").drop("_n")


def keys_added_dropped(old: DataFrame, new: DataFrame, pk: str = "recid") -> DataFrame:
    """(pk, change) with change 'added' or 'dropped'; only keys are shuffled, combined first."""
    sides = old.select(pk, F.lit(1).alias("o"), F.lit(0).alias("n")).unionByName(
        new.select(pk, F.lit(0).alias("o"), F.lit(1).alias("n"))
    )
    return (
        sides.groupBy(pk).agg(F.max("o").alias("o"), F.max("n").alias("n"))
        .where("o + n = 1")
        .select(pk, F.when(F.col("n") == 1, "added").otherwise("dropped").alias("change"))
    )


def table_as_of(master: DataFrame, log: DataFrame, cutoff, pk: str = "recid") -> DataFrame:
    """The master with all logged edits strictly before ``cutoff`` applied.

    ``log`` holds pk, edit_type, edit_timestamp and ``new_row`` (a struct of the master's
    columns); the last edit per key counts. Only touched keys move: master rows without edits
    are kept by an anti join.
    """
    order = F.struct("edit_timestamp", *[c for c in ("batch_id", "main_version") if c in log.columns])
    edited = log.where(F.col("edit_timestamp") < cutoff)
    # measured and kept by key only; rows are neither
    kept = master.join(checked_broadcast(edited.select(pk).distinct()), pk, "left_anti")
    last = edited.groupBy(pk).agg(F.max_by(F.struct("edit_type", "new_row"), order).alias("e")).select("e.*")
    rows = last.where(F.col("edit_type") != "D").select("new_row.*")
    return kept.unionByName(rows.select(*master.columns))
