"""Keyed state: newest row per key, history, merge, and change rows.

No operator here ever brings all rows of a key together. Newest-row selection
uses ``row_number() = 1``, which Spark turns into a group limit before the
shuffle: a key with a third of all rows sends one row per task. Operators that
need the previous row of a key work per (key, time slice) and exchange only the
slice boundaries, see ``with_previous``.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clinlake.functions.keys import packed_id, unpacked_id


def _has_variant(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return any(_has_variant(f.dataType) for f in kind.fields)
    if isinstance(kind, T.ArrayType):
        return _has_variant(kind.elementType)
    return isinstance(kind, (T.VariantType, T.MapType))


def row_hash(df: DataFrame) -> Column:
    """Hash of all hashable columns: a stable tiebreak between equal sequences."""
    return F.xxhash64(*[F.col(f"`{f.name}`") for f in df.schema.fields if not _has_variant(f.dataType)])


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
) -> DataFrame:
    """The single greatest row per key under ``order`` (descending columns)."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")


ID_COLUMN = re.compile(r"(_uuid|(?<!patient)(?<!practitioner)_natural_key)$")


def id_columns(df: DataFrame) -> list[str]:
    """Text columns that hold hashes by their name: ``*_uuid``, and the natural keys that are composed."""
    return [f.name for f in df.schema.fields if f.dataType == T.StringType() and ID_COLUMN.search(f.name)]


def with_packed_ids(df: DataFrame, step: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``step`` over ``df`` with its id columns as bytes, so that its shuffle moves half as much of them."""
    names = id_columns(df)
    out = step(df.withColumns({n: packed_id(F.col(n)) for n in names}) if names else df)
    kept = [n for n in names if n in out.columns]
    return out.withColumns({n: unpacked_id(F.col(n)) for n in kept}) if kept else out


def scd1(
    df: DataFrame,
    keys: Sequence[str],
    sequence_by: str | Column,
    except_cols: Sequence[str] = (),
    tiebreak: Sequence[str] | None = None,
) -> DataFrame:
    """Current state: greatest sequence per key wins, late rows lose.

    Equal sequences fall back to ``tiebreak`` columns, by default a hash of the
    row, so the result does not depend on partitioning or task retries.
    """
    sequence = F.col(sequence_by) if isinstance(sequence_by, str) else sequence_by
    breakers = [F.col(c) for c in tiebreak] if tiebreak is not None else [row_hash(df)]
    order = [sequence.desc_nulls_last(), *[b.desc_nulls_last() for b in breakers]]
    return latest_per_key(df, keys, order).drop(*except_cols)


REPEATED = 100_000


def among_repeated(df: DataFrame, key: str | Sequence[str], step: Callable[[DataFrame], DataFrame], most: int = REPEATED) -> DataFrame:
    """``step``, which keeps one row per ``key`` (a column or several), over the rows whose key comes more than once; the others stay where they are.

    A row that is alone under its key is its newest, so it needs neither sort nor shuffle. Keys are counted by
    hash in a pass of their own, which reads nothing but the key. With up to ``most`` repeated hashes the rows are told
    apart by a join with these; beyond that ``step`` takes all rows.
    """
    hashed = F.xxhash64(*([key] if isinstance(key, str) else key))
    counted = df.select(hashed.alias("_h")).groupBy("_h").agg(F.count(F.lit(1)).alias("_n"))
    found = counted.where("_n > 1").select("_h").limit(most + 1).collect()
    if not found:
        return df
    if len(found) > most:
        return step(df)
    repeated = F.broadcast(df.sparkSession.createDataFrame(found, "_h long"))
    marked = df.withColumn("_h", hashed)
    newest = step(marked.join(repeated, "_h", "left_semi").select(*df.columns))
    return marked.join(repeated, "_h", "left_anti").select(*newest.columns).unionByName(newest)


SLICE_ROWS = 4_000_000


def slice_count(df: DataFrame) -> int:
    """Time slices for ``with_previous``: even if one key holds all rows, a slice stays near SLICE_ROWS."""
    return max(16, math.ceil(df.count() / SLICE_ROWS))


def with_previous(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    cols: Sequence[str],
    prefix: str = "prev_",
    slices: int | None = None,
    following: bool = False,
) -> DataFrame:
    """``lag`` (or ``lead``) of ``cols`` by ``order`` within ``keys``, safe for hot keys.

    Rows are cut into ``slices`` time slices at quantiles of ``order`` and the window
    runs per (key, slice). The last (first) row of each slice is copied as a border
    row into the key's next (previous) non-empty slice, where the window picks it up.
    Border rows are one pre-aggregated row per (key, slice), so a key has at most
    ``slices`` of them, and its rows spread over as many tasks. The input is
    shuffled for the borders (pre-aggregated) and for the window.
    Without ``slices``, their number follows the row count (one counting pass).
    ``order`` must be unique within a key. Adds ``{prefix}exists`` and the columns.
    """
    slices = slice_count(df) if slices is None else slices
    share = [i / slices for i in range(1, slices)]
    position = F.col(order)
    if isinstance(df.schema[order].dataType, T.TimestampType):
        position = F.unix_micros(position)
    elif isinstance(df.schema[order].dataType, T.DateType):
        position = F.unix_date(position)
    cuts = df.select(position.alias("_p")).agg(F.percentile_approx("_p", share, max(10_000, 10 * slices))).scalar()
    sliced = (
        df.withColumn("_p", position)
        .withColumn("_cuts", cuts)
        .withColumn("_slice", F.size(F.filter("_cuts", lambda c: c < F.col("_p"))))
        .drop("_cuts", "_p")
    )
    pick, step = (F.min_by, F.lag) if following else (F.max_by, F.lead)
    carried = list(dict.fromkeys([order, *cols]))
    edges = sliced.groupBy(*keys, "_slice").agg(pick(F.struct(*carried), F.col(order)).alias("_edge"))
    neighbours = Window.partitionBy(*keys).orderBy("_slice")
    borders = (
        edges.withColumn("_slice", step("_slice").over(neighbours))
        .where("_slice IS NOT NULL")
        .select(*keys, "_slice", *[F.col(f"_edge.{c}").alias(c) for c in carried if c not in keys])
    )
    rows = sliced.withColumn("_own", F.lit(True)).unionByName(
        borders.withColumn("_own", F.lit(False)), allowMissingColumns=True
    )
    direction = F.col(order).desc() if following else F.col(order).asc()
    inside = Window.partitionBy(*keys, "_slice").orderBy(direction)
    neighbour = F.lag(F.struct(*cols)).over(inside)
    found = rows.withColumn("_neighbour", neighbour).where("_own")
    return found.select(
        *df.columns,
        F.col("_neighbour").isNotNull().alias(f"{prefix}exists"),
        *[F.col(f"_neighbour.{c}").alias(f"{prefix}{c}") for c in cols],
    )


def scd2(
    df: DataFrame,
    keys: Sequence[str],
    sequence_by: str,
    track: Sequence[str],
    slices: int | None = None,
) -> DataFrame:
    """History rows that open only when a tracked column changes.

    Works on the whole ordered input, so late rows land where they belong.
    Adds ``valid_from``, ``valid_to`` (NULL = current) and ``surrogate_key``.
    """
    df = latest_per_key(df, [*keys, sequence_by], [row_hash(df).desc()])  # equal sequences: one row, by hash
    slices = slice_count(df) if slices is None else slices
    seen = with_previous(df, keys, sequence_by, list(track), slices=slices)
    changed = F.lit(False)
    for c in track:
        changed = changed | ~F.col(c).eqNullSafe(F.col(f"prev_{c}"))
    opened = seen.where(~F.col("prev_exists") | changed).select(*df.columns)
    bounded = with_previous(opened, keys, sequence_by, [sequence_by], prefix="next_", slices=slices, following=True)
    return bounded.select(
        F.sha2(F.concat_ws("|", *keys, F.col(sequence_by).cast("string")), 256).alias("surrogate_key"),
        *[c for c in df.columns if c != sequence_by],
        F.col(sequence_by).alias("valid_from"),
        F.col(f"next_{sequence_by}").alias("valid_to"),
    )


def change_feed(
    log: DataFrame,
    keys: Sequence[str],
    version: str,
    deleted: str | None = None,
    from_version=None,
    commit_time: str | None = None,
    processed_at: Column | None = None,
    slices: int | None = None,
) -> DataFrame:
    """insert / update_preimage / update_postimage / delete rows of a keyed log.

    ``log`` holds one row per key and version; ``deleted`` names a tombstone flag.
    A delete reports the values it removed.
    """
    flag = F.coalesce(F.col(deleted), F.lit(False)) if deleted else F.lit(False)
    base = log.withColumn("_gone", flag)
    payload = [c for c in log.columns if c not in {*keys, version, deleted, commit_time}]
    seen = with_previous(base, keys, version, [*payload, "_gone"], slices=slices)
    alive_before = F.col("prev_exists") & ~F.col("prev__gone")
    new = F.struct(*[F.col(c) for c in payload])
    old = F.struct(*[F.col(f"prev_{c}").alias(c) for c in payload])

    def change(kind: str, image: Column) -> Column:
        return F.struct(F.lit(kind).alias("_change_type"), image.alias("_image"))

    changes = (
        F.when(F.col("_gone") & alive_before, F.array(change("delete", old)))
        .when(F.col("_gone"), F.array().cast(T.ArrayType(_change_schema(log, payload))))
        .when(alive_before, F.array(change("update_preimage", old), change("update_postimage", new)))
        .otherwise(F.array(change("insert", new)))
    )
    rows = seen if from_version is None else seen.where(F.col(version) >= F.lit(from_version))
    rows = rows.withColumn("_change", F.explode(changes))
    stamp = F.col(commit_time) if commit_time else F.lit(None).cast("timestamp")
    return rows.select(
        *keys,
        *[F.col(f"_change._image.{c}").alias(c) for c in payload],
        F.col("_change._change_type").alias("_change_type"),
        F.col(version).alias("_commit_version"),
        stamp.alias("_commit_timestamp"),
        (processed_at if processed_at is not None else F.current_timestamp()).alias("_processed_at"),
    )


def _change_schema(log: DataFrame, payload: Sequence[str]) -> T.StructType:
    image = T.StructType([T.StructField(c, log.schema[c].dataType) for c in payload])
    return T.StructType([T.StructField("_change_type", T.StringType()), T.StructField("_image", image)])


def merge_upsert(
    base: DataFrame | None,
    stage: DataFrame,
    on: Sequence[str],
    update_cols: Sequence[str],
) -> DataFrame:
    """Matched rows take ``update_cols`` from ``stage``, the rest is inserted.

    With no base this is the first load. A full outer join on the key reads each
    side once. Keys are unique on both sides (staged duplicates are reduced to
    one row, by hash), so no partition can be skewed by a key. A NULL key matches nothing: such rows
    of the base stay as they are, and a staged one is inserted.
    """
    stage = latest_per_key(stage, on, [row_hash(stage).desc()])
    if base is None:
        return stage
    left = base.select(*[F.col(c).alias(f"_b_{c}") for c in base.columns], F.lit(True).alias("_in_base"))
    right = stage.select(*[F.col(c).alias(f"_s_{c}") for c in base.columns], F.lit(True).alias("_staged"))
    joined = left.join(right, [F.col(f"_b_{k}") == F.col(f"_s_{k}") for k in on], "full")
    is_new = F.col("_in_base").isNull()

    def pick(c: str) -> Column:
        if c in update_cols:
            return F.when(F.col("_staged"), F.col(f"_s_{c}")).otherwise(F.col(f"_b_{c}"))
        return F.when(is_new, F.col(f"_s_{c}")).otherwise(F.col(f"_b_{c}"))

    return joined.select(*[pick(c).alias(c) for c in base.columns])


def source_links(resolved: DataFrame, key: str, sources: str) -> DataFrame:
    """All (natural key, source row id) pairs ever seen, with no array per key.

    A per-key array would put an unbounded group into one row; the pair table
    holds the same facts and joins back on the key.
    """
    return resolved.select(key, F.explode(sources).alias("source_uuid")).distinct()
