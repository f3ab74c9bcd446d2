"""Building blocks that keep every operator bounded per task.

* ``neighbours``       row number / previous / next row per key, splitting hot keys
* ``top_per_group``    k best rows per group, salted so that no task sees a whole group
* ``group_quantiles``  exact interpolated quantiles without holding a group in one task

Each takes a ``row_bound``: a known upper bound on the rows of the input (a table's row
count is one for anything filtered from it). When the bound itself is small, the plain
built-in operator is used; otherwise, or when nothing is known, the split form is.
"""

from __future__ import annotations

import math
import struct
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from decisionlake.sources.storage import cut

#: Rows that one task may sort or hold as a single group.
TASK_ROWS = 5_000_000
#: Rows of a side that may be broadcast.
BROADCAST_ROWS = 200_000
SALTS = 256
#: Rows whose exact percentiles one aggregate may hold as objects.
QUANTILE_ROWS = 1_000_000
#: Rows of a bracket that are counted value by value.
BRACKET_ROWS = 100_000
#: Groups times values whose quantile brackets the driver may hold.
FEW_CELLS = 1_000


def is_small(row_bound: int | None, limit: int = TASK_ROWS) -> bool:
    return row_bound is not None and row_bound <= limit


def small_side(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast a side after checking its size; leave the strategy to AQE beyond it."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


# --------------------------------------------------------------------------- windows


def neighbours(
    df: DataFrame,
    key: str,
    position: str,
    *,
    tie: Sequence[str] = (),
    number: str | None = None,
    behind: tuple[str, Sequence[str]] | None = None,
    ahead: tuple[str, Sequence[str]] | None = None,
    row_bound: int | None = None,
    task_rows: int = TASK_ROWS,
) -> DataFrame:
    """Add the row number and the previous / next row of each key, in ``position`` order.

    ``behind`` and ``ahead`` are ``(name, columns)`` and become struct columns, NULL at the edge;
    NULL positions come first and NULL keys are a key. Keys with at most ``task_rows`` rows use one
    plain window. Hotter keys are range-sorted into slices; every slice is windowed on its own and
    the seams are closed with one summary row per slice.
    """
    if is_small(row_bound, task_rows):
        return _plain_neighbours(df, key, position, tie, number, behind, ahead)
    hot = cut(
        df.groupBy(F.col(key).alias("_key")).agg(F.count("*").alias("_n")).filter(F.col("_n") > task_rows), "hot-keys"
    )
    if hot.isEmpty():
        return _plain_neighbours(df, key, position, tie, number, behind, ahead)
    hot = small_side(hot)
    cold = df.join(hot, F.col(key).eqNullSafe(F.col("_key")), "left_anti")
    sliced = _slice_hot_rows(df, hot, key, [position, *tie])
    return _plain_neighbours(cold, key, position, tie, number, behind, ahead).unionByName(
        _sliced_neighbours(sliced, key, position, tie, number, behind, ahead)
    )


def _plain_neighbours(df, key, position, tie, number, behind, ahead):
    w = Window.partitionBy(key).orderBy(position, *tie)
    added = {}
    if number:
        added[number] = (F.row_number().over(w) - 1).cast("bigint")
    if behind:
        added[behind[0]] = F.lag(F.struct(*behind[1])).over(w)
    if ahead:
        added[ahead[0]] = F.lead(F.struct(*ahead[1])).over(w)
    return df.withColumns(added)


def _slice_hot_rows(df, hot, key, order):
    """Rows of hot keys, written in ranges of key and order; a range of a key is its ``_slice``.

    A range holds the rows of a sample's share of all hot rows, however they are spread over keys and
    positions, NULL ones included; rows equal in key and order, ``tie`` included, share a range.
    """
    rows = df.join(hot, F.col(key).eqNullSafe(F.col("_key"))).drop("_key", "_n")
    ranged = rows.repartitionByRange(F.col(key).asc_nulls_first(), *[F.col(c).asc_nulls_first() for c in order])
    return cut(ranged.withColumn("_slice", F.spark_partition_id()), "hot-rows")


def _sliced_neighbours(sliced, key, position, tie, number, behind, ahead):
    w = Window.partitionBy(key, "_slice").orderBy(position, *tie)
    first, last = F.col("_seam_row") == 0, F.col("_seam_back") == 0
    added = {"_seam_row": (F.row_number().over(w) - 1).cast("bigint"),
             "_seam_back": (F.count("*").over(Window.partitionBy(key, "_slice")) - F.row_number().over(w)).cast("bigint")}
    seams = [F.count("*").alias("_seam_rows")]
    if behind:
        added[behind[0]] = F.lag(F.struct(*behind[1])).over(w)
        seams.append(F.max(F.when(last, F.struct(*behind[1]))).alias("_seam_last"))
    if ahead:
        added[ahead[0]] = F.lead(F.struct(*ahead[1])).over(w)
        seams.append(F.max(F.when(first, F.struct(*ahead[1]))).alias("_seam_first"))
    numbered = sliced.withColumns(added)

    across = Window.partitionBy(key).orderBy("_slice")
    edges = numbered.groupBy(key, "_slice").agg(*seams)
    edge_columns = {
        "_seam_before": F.coalesce(
            F.sum("_seam_rows").over(across.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        )
    }
    if behind:
        edge_columns["_seam_previous"] = F.lag("_seam_last").over(across)
    if ahead:
        edge_columns["_seam_next"] = F.lead("_seam_first").over(across)
    edges = edges.withColumns(edge_columns).drop("_seam_rows", "_seam_last", "_seam_first")
    edges = edges.withColumnsRenamed({key: "_seam_key", "_slice": "_seam_slice"})

    same = F.col(key).eqNullSafe(F.col("_seam_key")) & (F.col("_slice") == F.col("_seam_slice"))
    out = numbered.join(edges, same)
    if number:
        out = out.withColumn(number, F.col("_seam_row") + F.col("_seam_before"))
    if behind:
        out = out.withColumn(behind[0], F.when(first, F.col("_seam_previous")).otherwise(F.col(behind[0])))
    if ahead:
        out = out.withColumn(ahead[0], F.when(last, F.col("_seam_next")).otherwise(F.col(ahead[0])))
    return out.drop("_slice", *[c for c in out.columns if c.startswith("_seam_")])


def number_in_blocks(
    df: DataFrame, groups: Sequence[str], block: Column, order: Sequence[Column | str], name: str
) -> DataFrame:
    """Zero-based row number per group, where ``block`` is a prefix of the order.

    Each (group, block) is numbered alone and shifted by the sizes of earlier blocks, so
    that a group of any size is spread over as many tasks as it has blocks.
    """
    df = df.withColumn("_block", block)
    sizes = df.groupBy(*groups, "_block").agg(F.count("*").alias("_size"))
    earlier = Window.partitionBy(*groups).orderBy("_block").rowsBetween(
        Window.unboundedPreceding, -1
    )
    sizes = sizes.withColumn("_shift", F.coalesce(F.sum("_size").over(earlier), F.lit(0))).drop("_size")
    inside = Window.partitionBy(*groups, "_block").orderBy(*order)
    return (
        df.withColumn("_seam_row", F.row_number().over(inside) - 1)
        .join(sizes, [*groups, "_block"])
        .withColumn(name, (F.col("_seam_row") + F.col("_shift")).cast("bigint"))
        .drop("_block", "_seam_row", "_shift")
    )


def top_per_group(
    df: DataFrame,
    groups: Sequence[str],
    order: Sequence[Column | str],
    k: int,
    *,
    salt: Sequence[str] | None = None,
    name: str = "rank",
    row_bound: int | None = None,
    task_rows: int = TASK_ROWS,
) -> DataFrame:
    """The first ``k`` rows of each group in a total order, ranked from 1.

    Spark drops rows past ``k`` before the shuffle; with many input tasks a hot group
    would still send ``tasks x k`` rows to one reducer, so a first round ranks inside
    salts of the group.
    """
    if salt and not is_small(row_bound, task_rows):
        salted = Window.partitionBy(*groups, "_salt").orderBy(*order)
        df = (
            df.withColumn("_salt", F.pmod(F.xxhash64(*salt), F.lit(SALTS)))
            .withColumn("_salted", F.row_number().over(salted))
            .filter(F.col("_salted") <= k)
            .drop("_salt", "_salted")
        )
    w = Window.partitionBy(*groups).orderBy(*order)
    return df.withColumn(name, F.row_number().over(w)).filter(F.col(name) <= k)


# ------------------------------------------------------------------------- quantiles


def group_quantiles(
    df: DataFrame,
    groups: Sequence[str],
    values: Sequence[str],
    probabilities: Sequence[float],
    *,
    row_bound: int | None = None,
    task_rows: int = QUANTILE_ROWS,
    few_cells: int | None = None,
) -> DataFrame:
    """Exact, linearly interpolated quantiles: one array column ``<value>_q`` per value.

    Up to ``task_rows`` rows, Spark's exact ``percentile`` is used; it holds a group's distinct
    values in one task. Beyond that, where groups are few (actions, slices, models), the wanted
    ranks are bracketed by mergeable sketches, the brackets are counted exactly and narrowed, and
    only the values inside a narrow bracket are ever sorted: scans, but no shuffle of the data.
    With more than ``FEW_CELLS`` groups times values nothing of a group reaches the driver: values
    are counted and range-sorted once, and the wanted ranks are read from the ranges they fall in.
    """
    if row_bound is None:
        row_bound = df.count()
    if is_small(row_bound, task_rows):
        wanted = F.array(*[F.lit(float(p)) for p in probabilities])
        return df.groupBy(*groups).agg(
            *[F.percentile(v, wanted).alias(f"{v}_q") for v in values]
        )
    long = _long_values(df, groups, values)
    few_cells = FEW_CELLS if few_cells is None else few_cells
    if groups and long.select(*groups, "v").distinct().limit(few_cells + 1).count() > few_cells:
        return _ranged_quantiles(long, list(groups), list(values), list(probabilities))
    return _bracketed_quantiles(df, list(groups), list(values), list(probabilities), task_rows)


def _long_values(df: DataFrame, groups: Sequence[str], values: Sequence[str]) -> DataFrame:
    """``groups``, the number ``v`` of a value column and the value ``x``."""
    return df.select(
        *groups,
        F.explode(F.array(*[
            F.struct(F.lit(i).alias("v"), F.col(v).cast("double").alias("x"))
            for i, v in enumerate(values)
        ])).alias("_e"),
    ).select(*groups, "_e.v", "_e.x")


def left_out_quantiles(
    df: DataFrame, part: str, sides: Sequence[int], groups: Sequence[str], values: Sequence[str],
    probabilities: Sequence[float], *, row_bound: int | None = None, task_rows: int = QUANTILE_ROWS,
) -> DataFrame:
    """``group_quantiles`` per ``side`` and group, where a side has the rows whose ``part`` is another number.

    A row is not repeated for each side that it is in: values are counted and range-sorted once per part, and
    only the ranges that hold a wanted rank are added up side by side.
    """
    if row_bound is None:
        row_bound = df.count()
    if is_small(row_bound * len(sides), task_rows):
        return group_quantiles(
            without_part(df, part, sides), ["side", *groups], values, probabilities,
            row_bound=row_bound * len(sides), task_rows=task_rows,
        )
    long = _long_values(df, [part, *groups], values)
    return _ranged_quantiles(long, list(groups), list(values), list(probabilities), part, sides)


def without_part(df: DataFrame, part: str, sides: Sequence[int]) -> DataFrame:
    """Every row once for each ``side`` other than its part."""
    return df.withColumn("side", F.explode(F.filter(F.array(*[F.lit(s) for s in sides]), lambda s: s != F.col(part))))


def _ranged_quantiles(long, groups, values, probabilities, part=None, sides=()):
    """Quantiles of any number of groups from one global sort; no task holds more than a range of it.

    Equal values are one row with a count, so that a value of any frequency is no hot key. The ranges
    before a range add up to the rank at which it begins; ranges without a wanted rank are not read again.
    With ``part`` the quantiles are those of ``left_out_quantiles``.
    """
    cell = [*groups, "v"]
    parts = [part] if part else []
    keys = [F.col(c).asc_nulls_first() for c in cell]
    counted = long.filter(F.col("x").isNotNull()).groupBy(*parts, *cell, (F.col("x") + F.lit(0.0)).alias("x")).agg(F.count("*").alias("n"))
    ranged = counted.repartitionByRange(*keys, F.col("x").asc()).withColumn("_range", F.spark_partition_id())
    ranged = cut(ranged, "ranged")
    # a row per cell and range
    seams = ranged.groupBy(*parts, *cell, "_range").agg(F.sum("n").alias("inside"))
    inner = list(cell)
    if part:
        groups, cell = ["side", *groups], ["side", *cell]
        seams = without_part(seams, part, sides).groupBy(*cell, "_range").agg(F.sum("inside").alias("inside"))
    before = Window.partitionBy(*cell).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    seams = seams.withColumns({
        "start": F.coalesce(F.sum("inside").over(before), F.lit(0)),
        "total": F.sum("inside").over(Window.partitionBy(*cell)),
    })
    at = [F.lit(float(p)) * (F.col("total") - 1) for p in probabilities]
    ends = [f(a).cast("bigint") for a in at for f in (F.floor, F.ceil)]
    asked = seams.select(*cell, "_range", "start", "total", F.array_distinct(F.filter(
        F.array(*ends), lambda r: (r >= F.col("start")) & (r < F.col("start") + F.col("inside"))
    )).alias("ranks")).filter(F.size("ranks") > 0)
    same = F.col("r._range") == F.col("a._range")
    for c in inner:
        same = same & F.col(f"r.{c}").eqNullSafe(F.col(f"a.{c}"))
    if part:
        same = same & (F.col(f"r.{part}") != F.col("a.side"))
    read = ranged.alias("r").join(asked.alias("a"), same).select(
        *[f"a.{c}" for c in cell], "r._range", "r.x", "r.n", "a.start", "a.total", "a.ranks"
    )
    if part:
        read = read.groupBy(*cell, "_range", "x", "start", "total", "ranks").agg(F.sum("n").alias("n"))
    running = Window.partitionBy(*cell, "_range").orderBy("x")
    read = read.withColumn("upto", F.col("start") + F.sum("n").over(running))
    hits = read.select(*cell, "total", "x", F.explode(F.filter(
        "ranks", lambda r: (r < F.col("upto")) & (r >= F.col("upto") - F.col("n"))
    )).alias("rank"))
    # at most two ranks per probability and cell
    found = hits.groupBy(*cell).agg(F.max("total").alias("total"), F.map_from_entries(F.collect_list(F.struct("rank", "x"))).alias("of"))

    def interpolated(a: Column) -> Column:
        low, high = F.floor(a).cast("bigint"), F.ceil(a).cast("bigint")
        x, y, share = F.col("of")[low], F.col("of")[high], a - low
        return F.when(x == y, x).otherwise((1 - share) * x + share * y)

    each = found.select(*cell, F.array(*[interpolated(a) for a in at]).alias("q"))
    # a group whose values are all missing has NULL in place of an array
    own = without_part(long.select(part, *groups[1:]).distinct(), part, sides) if part else long
    present = own.select(*groups).distinct().withColumns({"v": F.lit(None).cast("int"), "q": F.lit(None).cast("array<double>")})
    return each.unionByName(present).groupBy(*groups).agg(*[
        F.max(F.when(F.col("v") == i, F.col("q"))).alias(f"{v}_q") for i, v in enumerate(values)
    ])


_GRID = 1000


def _ordinal(x: float) -> int:
    """Doubles as integers in the same order, with NaN last as Spark sorts it."""
    if math.isnan(x):
        return 1 << 63
    bits = struct.unpack("<q", struct.pack("<d", x + 0.0))[0]
    return bits if bits >= 0 else -(bits & ((1 << 63) - 1))


def _between(lo: float, hi: float) -> float:
    """The double halfway between two, counted in doubles: ``lo`` itself if they are neighbours."""
    at = (_ordinal(lo) + min(_ordinal(hi), _ordinal(math.inf) + 1)) // 2
    size = struct.unpack("<d", struct.pack("<q", abs(at)))[0]
    return math.copysign(size, at)


def _same(bracket: dict) -> bool:
    return _ordinal(bracket["lo"]) == _ordinal(bracket["hi"])


def _interpolated(a: float, b: float, share: float) -> float:
    """Between two neighbours; equal ones, infinities too, stand for themselves."""
    return a if a == b else (1 - share) * a + share * b


def _bracketed_quantiles(df, groups, values, probabilities, task_rows):
    spark = df.sparkSession
    long = _long_values(df, groups, values)
    cells = [
        row.asDict()
        for row in long.groupBy(*groups, "v")
        .agg(F.count("x").alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi"))
        .collect()
    ]
    wanted = {}
    for c, cell in enumerate(cells):
        for p in probabilities if cell["n"] else ():
            at = p * (cell["n"] - 1)
            for rank in {math.floor(at), math.ceil(at)}:
                wanted[(c, rank)] = {
                    "lo": cell["lo"], "hi": cell["hi"], "below": 0, "inside": cell["n"]
                }

    cell_schema = T.StructType(
        [df.schema[g] for g in groups]
        + [T.StructField("v", T.IntegerType()), T.StructField("cell", T.IntegerType())]
    )
    cell_frame = spark.createDataFrame(
        [tuple(cell[g] for g in groups) + (cell["v"], c) for c, cell in enumerate(cells)],
        cell_schema,
    )
    left = long.filter(F.col("x").isNotNull()).alias("l")
    same = F.col("l.v") == F.col("c.v")
    for g in groups:
        same = same & F.col(f"l.{g}").eqNullSafe(F.col(f"c.{g}"))
    points = left.join(small_side(cell_frame).alias("c"), same).select("cell", "x")

    def open_brackets(limit):
        return [k for k, b in wanted.items() if not _same(b) and b["inside"] > limit]

    def inside(keys, bounds):
        frame = spark.createDataFrame(
            [(k[0], i, *bounds[k]) for i, k in enumerate(keys)],
            "cell int, bracket int, lo double, hi double",
        )
        return points.join(F.broadcast(frame), "cell").filter(F.col("x").between(F.col("lo"), F.col("hi")))

    while keys := open_brackets(min(task_rows, BRACKET_ROWS)):
        whole = {k: (wanted[k]["lo"], wanted[k]["hi"]) for k in keys}
        grid = [i / _GRID for i in range(_GRID + 1)]
        # brackets of a cell that are still the same range share a sketch
        shared = {(k[0], _ordinal(whole[k][0]), _ordinal(whole[k][1])): k for k in keys}
        sketch = {
            row["bracket"]: row["q"]
            for row in inside(list(shared.values()), whole)
            .groupBy("bracket")
            .agg(F.percentile_approx("x", grid, 10 * _GRID).alias("q"))
            .collect()
        }
        number = {r: i for i, r in enumerate(shared)}
        guess = {}
        for k in keys:
            b, i = wanted[k], number[k[0], _ordinal(whole[k][0]), _ordinal(whole[k][1])]
            at = (k[1] - b["below"]) / b["inside"] * _GRID
            lo = sketch[i][max(0, math.floor(at) - 1)]
            hi = sketch[i][min(_GRID, math.ceil(at) + 1)]
            if (lo, hi) == whole[k]:
                hi = _between(lo, hi)
            guess[k] = (lo, hi)
        counted = spark.createDataFrame(
            [(k[0], i, *whole[k], *guess[k]) for i, k in enumerate(keys)],
            "cell int, bracket int, lo double, hi double, glo double, ghi double",
        )
        counts = {
            row["bracket"]: row
            for row in points.join(F.broadcast(counted), "cell")
            .filter(F.col("x").between(F.col("lo"), F.col("hi")))
            .groupBy("bracket")
            .agg(
                F.count_if(F.col("x") < F.col("glo")).alias("under"),
                F.count_if(F.col("x") <= F.col("ghi")).alias("upto"),
                F.max(F.when(F.col("x") < F.col("glo"), F.col("x"))).alias("last_under"),
                F.min(F.when(F.col("x") > F.col("ghi"), F.col("x"))).alias("first_over"),
            )
            .collect()
        }
        for i, k in enumerate(keys):
            b, row, rank = wanted[k], counts[i], k[1] - wanted[k]["below"]
            before = (b["lo"], b["hi"])
            if rank < row["under"]:
                b.update(hi=row["last_under"], inside=row["under"])
            elif rank < row["upto"]:
                b.update(lo=guess[k][0], hi=guess[k][1], below=b["below"] + row["under"],
                         inside=row["upto"] - row["under"])
            else:
                b.update(lo=row["first_over"], below=b["below"] + row["upto"],
                         inside=b["inside"] - row["upto"])
            if (b["lo"], b["hi"]) == before:
                raise AssertionError(f"a bracket did not shrink: {b}")

    found = {k: b["lo"] for k, b in wanted.items() if _same(b)}
    rest = [k for k in wanted if k not in found]
    if rest:
        frame = spark.createDataFrame(
            [(k[0], i, wanted[k]["lo"], wanted[k]["hi"], k[1] - wanted[k]["below"])
             for i, k in enumerate(rest)],
            "cell int, bracket int, lo double, hi double, rank bigint",
        )
        per_value = (
            points.join(F.broadcast(frame), "cell")
            .filter(F.col("x").between(F.col("lo"), F.col("hi")))
            .groupBy("bracket", "rank", "x")
            .agg(F.count("*").alias("n"))
        )
        running = Window.partitionBy("bracket").orderBy("x")
        hits = (
            per_value.withColumn("upto", F.sum("n").over(running))
            .filter((F.col("rank") < F.col("upto")) & (F.col("rank") >= F.col("upto") - F.col("n")))
            .select("bracket", "x")
            .collect()
        )
        found.update({rest[row["bracket"]]: row["x"] for row in hits})

    out = {}
    for c, cell in enumerate(cells):
        group = tuple(cell[g] for g in groups)
        quantiles = None
        if cell["n"]:
            quantiles = []
            for p in probabilities:
                at = p * (cell["n"] - 1)
                lower, upper = math.floor(at), math.ceil(at)
                a, b = found[(c, lower)], found[(c, upper)]
                quantiles.append(a if lower == upper else _interpolated(a, b, at - lower))
        out.setdefault(group, {})[cell["v"]] = quantiles
    schema = T.StructType(
        [df.schema[g] for g in groups]
        + [T.StructField(f"{v}_q", T.ArrayType(T.DoubleType())) for v in values]
    )
    rows = [g + tuple(q.get(i) for i in range(len(values))) for g, q in out.items()]
    if not rows and not groups:
        rows = [(None,) * len(values)]
    return spark.createDataFrame(rows, schema)
