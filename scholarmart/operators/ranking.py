"""Global order without a single-task window; top-k; pages."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scholarmart.session import materialize, shuffle_width


def _slices(df: DataFrame, order: Sequence[Column], slices: int | None) -> DataFrame:
    n = slices or max(shuffle_width(df.sparkSession), 1)
    ranged = df.repartitionByRange(n, *order).withColumn("_slice", F.spark_partition_id())
    # range bounds come from a sample, so the slices are fixed before they are read twice
    return materialize(ranged)


def running(df: DataFrame, order: Sequence[Column], totals: Mapping[str, Column], slices: int | None) -> DataFrame:
    """Add the running value of every total in a global order.

    Rows are range-partitioned by the order; each slice is summed, the sums of the
    earlier slices are added. Only one row per slice is ever brought together.
    ``order`` must be unique, so that equal values spread over slices.
    """
    ranged = _slices(df, order, slices)
    sums = ranged.groupBy("_slice").agg(*[F.sum(c).alias(f"_t_{k}") for k, c in totals.items()])
    earlier = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = sums.select(
        "_slice",
        *[F.coalesce(F.sum(f"_t_{k}").over(earlier), F.lit(0)).alias(f"_o_{k}") for k in totals],
        *[F.sum(f"_t_{k}").over(whole).alias(f"_total_{k}") for k in totals],
    )
    inside = Window.partitionBy("_slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    joined = ranged.join(F.broadcast(offsets), "_slice")  # as many rows as slices
    return joined.withColumns({f"_run_{k}": F.col(f"_o_{k}") + F.sum(c).over(inside) for k, c in totals.items()})


def global_row_number(df: DataFrame, order: Sequence[Column], name: str, slices: int | None = None) -> DataFrame:
    out = running(df, order, {"n": F.lit(1)}, slices)
    return out.select(*df.columns, F.col("_run_n").cast("long").alias(name))


def global_ntile(df: DataFrame, tiles: int, order: Sequence[Column], name: str, slices: int | None = None) -> DataFrame:
    """NTILE over the whole frame: sizes differ by at most one, the first tiles are the larger ones."""
    out = running(df, order, {"n": F.lit(1)}, slices)
    row, total = F.col("_run_n") - 1, F.col("_total_n")
    small = F.floor(total / tiles)
    extra = total % tiles
    head = extra * (small + 1)
    tile = F.when(row < head, F.floor(row / (small + 1))).otherwise(
        extra + F.floor(F.coalesce(F.try_divide(row - head, small), F.lit(0)))
    )
    return out.select(*df.columns, (tile + 1).cast("int").alias(name))


def tile_starts(rows: int, tiles: int) -> list[int]:
    """Where the second and later tiles of NTILE begin, counted from zero; tiles without rows are left out."""
    small, extra = divmod(rows, tiles)
    starts = (j * small + min(j, extra) for j in range(1, tiles))
    return [s for s in starts if s < rows]


def _reached(value: Column, tie: Column, at: object, first: object) -> Column:
    """Whether a row is at or behind a cut; nulls come first."""
    behind = value.isNotNull() if at is None else F.coalesce(value > F.lit(at), F.lit(False))
    there = value.isNull() if at is None else value.eqNullSafe(F.lit(at))
    return behind | (there if first is None else there & (tie >= F.lit(first)))


def ntile_by_counts(df: DataFrame, tiles: Mapping[str, tuple[str, int]], tie: str, slices: int | None = None) -> DataFrame:
    """NTILE columns ``name: (measure, tiles)`` in rising order of the measure, then of ``tie``, which must be unique and not null.

    Rows are counted per distinct value, and running sums over these counts tell in which value a tile begins. Only the rows of
    such a value (at most ``tiles - 1`` of them) are put in order, over many tasks however many rows share it, to find the first ``tie`` of the tile. Then every
    row compares itself with the cuts: the frame is neither sorted nor shuffled nor written. ``df`` is computed three times.
    Null measures come first, as in Spark's ascending order; an empty frame stays empty.
    """
    measures = list(dict.fromkeys(m for m, _ in tiles.values()))
    counts = materialize(df.groupBy(*measures).agg(F.count("*").alias("_n")))
    total = counts.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
    starts = {name: tile_starts(total, n) for name, (_, n) in tiles.items()}
    wanted = {m: sorted({s for name, (of, _) in tiles.items() if of == m for s in starts[name]}) for m in measures}

    # (measure, place) -> the value that place falls into; as many rows as there are tiles
    values: dict[tuple[str, int], object] = {}
    shared: list[tuple[str, object, int, list[int]]] = []  # values that a tile begins inside of
    for measure, places in wanted.items():
        if not places:
            continue
        run = running(counts.groupBy(measure).agg(F.sum("_n").alias("_n")), [F.col(measure).asc()], {"n": F.col("_n")}, slices)
        begin = F.col("_run_n") - F.col("_n")
        holds = F.exists(F.array(*map(F.lit, places)), lambda p: (begin <= p) & (p < F.col("_run_n")))
        for value, first, n in run.filter(holds).select(measure, begin.cast("long"), "_n").collect():
            inside = [p for p in places if first <= p < first + n]
            values.update({(measure, p): value for p in inside})
            if any(p > first for p in inside):
                shared.append((measure, value, n, [p - first for p in inside if p > first]))
                values.update({(measure, p): (value, len(shared) - 1, p - first) for p in inside if p > first})

    ties: dict[tuple[int, int], object] = {}
    if shared:
        groups = F.array_compact(F.array(*[F.when(F.col(m).eqNullSafe(F.lit(v)), g) for g, (m, v, _, _) in enumerate(shared)]))
        rows = df.select(F.explode(groups).alias("_g"), F.col(tie).alias("_tie"))
        offsets = [sum(n for _, _, n, _ in shared[:g]) for g in range(len(shared))]
        targets = {offsets[g] + place + 1: (g, place) for g, (_, _, _, inside) in enumerate(shared) for place in inside}
        ordered = running(rows, [F.col("_g").asc(), F.col("_tie").asc()], {"n": F.lit(1)}, slices)
        hits = ordered.filter(F.col("_run_n").isin(list(targets))).select("_run_n", "_tie")
        ties = {targets[at]: first for at, first in hits.collect()}

    def tile(name: str) -> Column:
        measure, number = tiles[name][0], F.lit(1)
        for place in starts[name]:
            found = values[measure, place]
            at, first = (found[0], ties[found[1], found[2]]) if isinstance(found, tuple) else (found, None)
            number = number + _reached(F.col(measure), F.col(tie), at, first).cast("int")
        return number.cast("int").alias(name)

    return df.select(*df.columns, *[tile(name) for name in tiles])


def cumulative_share(df: DataFrame, measure: str, tie_break: str, slices: int | None = None) -> DataFrame:
    """Position by falling measure and the share of the total reached so far."""
    order = [F.col(measure).desc_nulls_last(), F.col(tie_break).asc()]
    out = running(df, order, {"n": F.lit(1), "v": F.col(measure)}, slices)
    share = F.try_divide(F.col("_run_v"), F.col("_total_v"))
    return out.select(*df.columns, F.col("_run_n").cast("long").alias("posicion"), share.alias("share_acumulado"))


def top_k(df: DataFrame, k: int, *order: Column) -> DataFrame:
    """The first ``k`` rows of an order; each task keeps only ``k`` rows."""
    return df.orderBy(*order).limit(k)


def numbered_top_k(df: DataFrame, k: int, order: Sequence[Column], name: str) -> DataFrame:
    """Top ``k`` rows with their position; the window sees ``k`` rows at most."""
    return top_k(df, k, *order).withColumn(name, F.row_number().over(Window.orderBy(*order)))


def top_k_per_group(df: DataFrame, keys: Sequence[str], k: int, order: Sequence[Column], name: str = "posicion") -> DataFrame:
    """First ``k`` rows of every group; the limit is applied before the shuffle as well."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(name, F.row_number().over(w)).filter(F.col(name) <= k)


def rank_within(df: DataFrame, keys: Sequence[str], order: Sequence[Column], name: str = "posicion") -> DataFrame:
    """Position of every row inside its group."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))


def spread_rank(df: DataFrame, keys: Sequence[str], order: Sequence[Column], name: str = "posicion", slices: int | None = None) -> DataFrame:
    """Position of every row inside its group, when one group may hold most rows.

    Rows are cut into slices of about equal size by (keys, order), so a large group lies in several. Only a group that comes over from the slice before
    needs an offset, one for each slice: what it has in earlier slices. ``order`` must be unique within a group.
    """
    ranged = _slices(df, [*map(F.col, keys), *order], slices)
    counts = ranged.groupBy("_slice", *keys).agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_before", F.sum("_n").over(earlier)).filter("_before is not null")
    offsets = offsets.select(F.col("_slice").alias("_of"), *[F.col(k).alias(f"_key_{k}") for k in keys], "_before")
    same = F.col("_slice") == F.col("_of")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_key_{k}"))
    inside = F.row_number().over(Window.partitionBy("_slice", *keys).orderBy(*order))
    numbered = ranged.withColumn("_inside", inside).join(F.broadcast(offsets), same, "left")  # at most one row for each slice
    return numbered.select(*df.columns, (F.col("_inside") + F.coalesce("_before", F.lit(0))).cast("long").alias(name))


def page_after(df: DataFrame, size: int, order: Mapping[str, bool], after: Sequence[object] | None = None) -> DataFrame:
    """The page behind the row with these values; ``order`` has the columns, the last one unique, with true for falling ones.

    What a page costs does not depend on its number: rows up to ``after``, the values of the last row seen, are filtered in the scan, and
    each task keeps ``size`` rows. Nulls come last in either direction.
    """
    if after is not None:
        behind, equal = F.lit(False), F.lit(True)
        for (name, falling), value in zip(order.items(), after, strict=True):
            column = F.col(name)
            if value is None:
                equal = equal & column.isNull()
                continue
            further = (column < F.lit(value)) if falling else (column > F.lit(value))
            behind = behind | (equal & (further | column.isNull()))
            equal = equal & (column == F.lit(value))
        first, value = next(iter(order)), after[0]
        if value is not None:  # a plain bound, which files are skipped by
            behind = behind & (F.col(first).isNull() | ((F.col(first) <= F.lit(value)) if order[first] else (F.col(first) >= F.lit(value))))
        df = df.filter(behind)
    return top_k(df, size, *[F.col(c).desc_nulls_last() if falling else F.col(c).asc_nulls_last() for c, falling in order.items()])


def last_of(page_: DataFrame, order: Mapping[str, bool]) -> tuple | None:
    """The token for the next page: the values of the last row, or None behind the end."""
    rows = page_.select(*order).tail(1)
    return tuple(rows[0]) if rows else None


def page(df: DataFrame, number: int, size: int, order: Sequence[Column]) -> DataFrame:
    """Rows of one result page, counted from one."""
    top = numbered_top_k(df, number * size, order, "posicion")
    return top.filter(F.col("posicion") > (number - 1) * size)


def latest_version(df: DataFrame, key: str, version: str) -> DataFrame:
    """The newest version of every key; an aggregate, so a key with many versions is combined early."""
    values = [c for c in df.columns if c != key]
    return (
        df.groupBy(key)
        .agg(F.max_by(F.struct(*values), F.col(version)).alias("_row"))
        .select(key, *[F.col(f"_row.{c}").alias(c) for c in values])
        .select(*df.columns)
    )


def rank_groups(df: DataFrame, measure: str, name: str) -> DataFrame:
    """RANK by falling measure over aggregated groups.

    The rank is one plus the number of groups ahead; groups with equal measure
    share it. Counts per measure are summed globally, ties never gather in one task.
    """
    counts = df.groupBy(measure).agg(F.count("*").alias("_n"))
    order = [F.col(measure).desc_nulls_last()]
    run = running(counts, order, {"n": F.col("_n")}, None)
    ranks = run.select(measure, (F.col("_run_n") - F.col("_n") + 1).cast("long").alias(name))
    ranks = ranks.withColumnRenamed(measure, "_measure")
    return df.join(ranks, F.col(measure).eqNullSafe(F.col("_measure"))).select(*df.columns, name)
