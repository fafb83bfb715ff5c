"""Sorts, top-k, positions in a sort order and exact quantiles."""

from __future__ import annotations

import functools
import operator
from collections.abc import Iterator
from decimal import Decimal, localcontext
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weft.operators.keymarks import has_collation, with_marks
from weft.operators.names import fresh
from weft.sources.scratch import stored

SKETCH = 4096  # size of the sketches that bracket exact quantiles
LONG_RUN = 64  # rows of a key in a batch that are summed apart from other keys
SLACK = 0.003  # of a rank; some twice the error of such a sketch


def sort_by(df: DataFrame, *order: str | Column, ties: list[str] | None = None) -> DataFrame:
    """Global sort. ``ties`` make the order total and let the range partitioning
    cut a key that has very many rows."""
    return df.orderBy(*order, *(ties or []))


def top(df: DataFrame, n: int, *columns: str, ties: list[str] | None = None) -> DataFrame:
    """The ``n`` largest rows, descending; each task keeps only ``n`` rows."""
    return df.orderBy(*[F.desc(c) for c in columns], *(ties or [])).limit(n)


def take_ordered(df: DataFrame, n: int, *columns: str) -> DataFrame:
    """The ``n`` smallest rows, ascending."""
    return df.orderBy(*columns).limit(n)


def sorted_within_keys(df: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Rows laid out by key with sorted values, for writing or batch mapping.

    Ranges cover keys and values, so a key with very many rows is cut as well.
    """
    order = [*keys, *values]
    return df.repartitionByRange(*order).sortWithinPartitions(*order)


def running_totals(
    df: DataFrame, keys: list[str], order: list[str], weight: str, *, name: str = "start"
) -> DataFrame:
    """Sum of ``weight`` over the rows before this one, per key.

    Null weights count as nothing; the sum has the type that ``sum`` gives. Rows that
    are equal in ``order`` come in any order. ``keys`` may be empty for one order of
    all rows.

    Rows are exchanged once, by ranges of keys and order, whatever the sizes of the
    keys, so a hot key lies in several ranges and equal values can be parted too. In
    a range they are sorted and summed up batch by batch. Only the key that a range
    begins with can have rows in earlier ranges: its total there, one row per range,
    is added afterwards. The ranges are kept in scratch storage, so that both passes
    see the same ones. Where one key ends is told by marks (see with_marks).
    """
    weigh, m1, m2, tie = fresh(df.columns, "w", "m1", "m2", "tie")
    kind = df.select(F.sum(weight)).schema[0].dataType
    weighted = df.withColumn(weigh, F.coalesce(F.col(weight).cast(kind), F.lit(0).cast(kind)))
    given = with_marks(weighted, keys, [m1, m2]).withColumn(tie, F.monotonically_increasing_id())
    by = [*keys, *order, tie]
    ranged = given.repartitionByRange(*by).sortWithinPartitions(*by)
    return _totals(ranged.select(*df.columns, weigh, m1, m2), name)


def _totals(laid: DataFrame, name: str) -> DataFrame:
    """Sums of the weights before each row of its key, where rows of a key lie together.

    The last three columns of ``laid`` are the weight and the marks of the key; the
    others come back with the sum as ``name``.
    """
    *columns, weigh, m1, m2 = laid.columns
    before, end, part, at, whole, first, last, base, own = fresh(
        laid.columns, "before", "end", "part", "at", "whole", "first", "last", "base", "key"
    )
    kind = laid.schema[weigh].dataType
    width = len(columns)
    added = T.StructType.fromDDL(f"{m1} long, {m2} int, {part} int, {at} long, {whole} boolean").fields
    sums = [T.StructField(before, kind), T.StructField(end, kind)]
    schema = T.StructType([*[laid.schema[c] for c in columns], *sums, *added])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, place, first, last, held = TaskContext.get().partitionId(), 0, None, None, None
        for batch in batches:
            n = batch.num_rows
            if n == 0:
                continue
            w, m1, m2 = batch.columns[width:]
            a, b = m1.to_numpy(), m2.to_numpy()
            new = np.ones(n, bool)
            new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
            first = first or (a[0], b[0])
            new[0] = last != (a[0], b[0])
            end, before = _sums(w, np.flatnonzero(new), held)
            last, held = (a[-1], b[-1]), end[n - 1]
            made = [
                *batch.columns[:width],
                before,
                end,
                m1,
                m2,
                pa.array(np.full(n, number, np.int32)),
                pa.array(np.arange(place, place + n)),
                pa.array((a == first[0]) & (b == first[1])),
            ]
            place += n
            yield pa.RecordBatch.from_arrays(made, schema.names)

    placed = stored(laid.mapInArrow(add, schema), "ranges")
    # Of each range the key that it begins with and the one that it ends with.
    key, leads = F.struct(m1, m2), F.col(whole)
    head = F.max_by(F.when(leads, F.col(end)), F.when(leads, F.col(at)))
    per_range = placed.groupBy(part).agg(
        F.struct(F.min_by(key, at).alias("key"), head.alias("sum"), F.lit(True).alias("leads")).alias(first),
        F.struct(F.max_by(key, at).alias("key"), F.max_by(end, at).alias("sum"), F.lit(False).alias("leads")).alias(last),
    )
    one_key = F.col(f"{first}.key") == F.col(f"{last}.key")
    entries = F.when(one_key, F.array(first)).otherwise(F.array(first, last))
    runs = per_range.select(part, F.explode(entries).alias(own))
    earlier = Window.partitionBy(f"{own}.key").orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    bases = runs.select(part, own, F.sum(f"{own}.sum").over(earlier).alias(base))
    bases = bases.filter(F.col(f"{own}.leads") & F.col(base).isNotNull()).select(part, base)
    # At most one row per shuffle partition.
    joined = placed.join(F.broadcast(bases), part, "left")
    zero = F.lit(0).cast(kind)
    more = F.when(leads, F.coalesce(F.col(base), zero)).otherwise(zero)
    kept = [f"`{c}`" for c in columns if c != name]
    return joined.select(*kept, (F.col(before) + more).cast(kind).alias(name))


def with_position(
    df: DataFrame, keys: list[str] | None = None, *, name: str = "position", gathered: bool = False
) -> DataFrame:
    """Numbers rows from 0 as they lie in the frame's partitions, per key if given.

    Nothing is exchanged without ``keys``: rows are written with their partition and
    their place in it, and the rows of earlier partitions, one number per partition, are
    added. ``gathered`` says that the rows of a key lie together, going on from one
    partition to the next if need be, as :func:`sorted_within_keys` lays them; then
    neither are they with keys. Otherwise rows are brought together by key first.
    """
    part, at, base, one, m1, m2 = fresh(df.columns, "part", "at", "base", "one", "m1", "m2")
    laid = df.withColumn(at, F.monotonically_increasing_id())
    if keys and gathered and not has_collation(df, keys):
        marked = with_marks(df.withColumn(one, F.lit(1).cast("long")), keys, [m1, m2])
        return _totals(marked.select(*df.columns, one, m1, m2), name)
    if keys:
        return running_totals(laid.withColumn(one, F.lit(1)), keys, [at], one, name=name).drop(at, one)
    # The number of a row in its partition is in the lower 33 bits.
    place = F.col(at).bitwiseAND(F.lit((1 << 33) - 1))
    placed = stored(laid.withColumns({part: F.shiftright(at, 33), at: place}), "places")
    sizes = placed.groupBy(part).agg(F.count(F.lit(1)).alias(one))
    earlier = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    # One row per partition.
    bases = sizes.select(part, F.coalesce(F.sum(one).over(earlier), F.lit(0)).alias(base))
    numbered = placed.join(F.broadcast(bases), part)
    return numbered.select(*[f"`{c}`" for c in df.columns if c != name], (F.col(base) + F.col(at)).alias(name))


def _sums(w: pa.Array, starts: np.ndarray, held) -> tuple[pa.Array, pa.Array]:
    """Running sums with and without the row itself; each run of rows begins at one
    of ``starts``, but a first run without a start goes on from ``held``."""
    goes_on = held is not None and not (len(starts) and starts[0] == 0)
    if pa.types.is_integer(w.type):
        sums = _long_sums(w.to_numpy(), starts, held.as_py() if goes_on else 0)
        if sums is None:
            raise OverflowError("a running total leaves the range of long")
        return pa.array(sums[0]), pa.array(sums[1])
    if pa.types.is_floating(w.type):
        sums = _double_sums(w.to_numpy(), starts, held.as_py() if goes_on else 0.0)
        return pa.array(sums[0]), pa.array(sums[1])
    carry = held.as_py() if goes_on else Decimal(0)
    units, carried = _units(w), _units(pa.array([carry], w.type))
    sums = None if units is None or carried is None else _long_sums(units, starts, int(carried[0]))
    if sums is not None:
        return _from_units(sums[0], w.type), _from_units(sums[1], w.type)
    values, end, before = w.to_pylist(), [], []
    with localcontext(prec=76):  # exact for any two decimals of 38 digits
        for low, high in zip([0, *starts], [*starts, len(w)]):
            if low < high:
                sums = list(accumulate(values[low:high], initial=Decimal(0) if low else carry))
                before += sums[:-1]
                end += sums[1:]
    return pa.array(end, w.type), pa.array(before, w.type)


def _long_sums(values: np.ndarray, starts: np.ndarray, carry: int) -> tuple[np.ndarray, np.ndarray] | None:
    """``_sums`` of longs; nothing if a sum could leave their range."""
    if abs(float(carry)) + np.abs(values.astype(float)).sum() >= 2**63:
        return None
    n = len(values)
    before = np.cumsum(values) - values
    bases = np.full(n, -carry, np.int64)
    if len(starts):
        bases[starts[0] :] = np.repeat(before[starts], np.diff(np.r_[starts, n]))
    before = before - bases
    return before + values, before


def _double_sums(values: np.ndarray, starts: np.ndarray, carry: float) -> tuple[np.ndarray, np.ndarray]:
    """``_sums`` of doubles, rounded as if each run were added up row by row.

    Long runs are summed one after the other, all short ones together, row by row.
    """
    lows = starts if len(starts) and starts[0] == 0 else np.r_[0, starts].astype(np.int64)
    lengths, totals = np.diff(np.r_[lows, len(values)]), np.zeros(len(lows))
    totals[:1] = carry
    before, end = np.empty(len(values)), np.empty(len(values))
    long = lengths > LONG_RUN
    with np.errstate(invalid="ignore", over="ignore"):  # infinities are summed like others
        for low, length, total in zip(lows[long], lengths[long], totals[long]):
            sums = np.cumsum(np.r_[total, values[low : low + length]])
            before[low : low + length], end[low : low + length] = sums[:-1], sums[1:]
        lows, lengths, totals = lows[~long], lengths[~long], totals[~long]
        for step in range(lengths.max(initial=0)):
            more = lengths > step
            lows, lengths, totals = lows[more], lengths[more], totals[more]
            before[lows + step] = totals
            totals = totals + values[lows + step]
            end[lows + step] = totals
    return end, before


def _units(column: pa.Array) -> np.ndarray | None:
    """Decimals as longs that count units of the last place; nothing if one is too large."""
    if not pa.types.is_decimal128(column.type):
        return None
    halves = np.frombuffer(column.buffers()[1], np.int64).reshape(-1, 2)
    low, high = halves[column.offset : column.offset + len(column)].T
    return low if np.array_equal(high, low >> 63) else None


def _from_units(units: np.ndarray, kind: pa.DataType) -> pa.Array:
    halves = np.stack([units, units >> 63], axis=1)
    made = pa.Array.from_buffers(kind, len(units), [None, pa.py_buffer(np.ascontiguousarray(halves))])
    made.validate(full=True)  # raises if a sum has too many digits
    return made


def explode_range(df: DataFrame, low: Column, high: Column, name: str) -> DataFrame:
    """One row per integer from ``low`` to ``high``, both included.

    Done in blocks, so that no row ever carries a long array.
    """
    block = 4096
    begin, stop, number = fresh([*df.columns, name], "low", "high", "block")
    kept = df.withColumns({begin: low, stop: high})
    blocks = F.sequence(F.expr(f"{begin} div {block}"), F.expr(f"{stop} div {block}"))
    kept = kept.withColumn(number, F.explode(blocks))
    first = F.greatest(begin, F.col(number) * block)
    last = F.least(stop, F.col(number) * block + block - 1)
    return kept.withColumn(name, F.explode(F.sequence(first, last))).drop(begin, stop, number)


def quantiles(df: DataFrame, column: str, shares: dict[str, float]) -> DataFrame:
    """Exact quantiles of a number: the smallest value that covers each share of the
    rows. Nulls are left out. One row, one column per share; see quantile_table."""
    table = quantile_table(df, [column], shares)
    return table.select(*[F.col(f"{q}.v0").alias(q) for q in shares])


def _sketched(df: DataFrame, column: str) -> tuple[Column, bool]:
    """The column as its sketch takes it, and whether as whole numbers. The cast keeps
    the order of values, though different ones may become equal."""
    whole = isinstance(df.schema[column].dataType, T.IntegralType)
    return F.col(f"`{column}`").cast("long" if whole else "double"), whole


def quantile_sketches(df: DataFrame, columns: list[str], *, size: int = SKETCH) -> DataFrame:
    """``(field, n, whole, sketch)``: a mergeable KLL sketch of each numeric column, with
    its number of values. One scan; a sketch takes some 100 kB at the default size, however
    many rows there are, so sketches can be stored with parts of a table and used later."""
    return df.agg(F.array(*sketch_measures(df, columns, size)).alias("rows")).select(F.inline("rows"))


def sketch_measures(df: DataFrame, columns: list[str], size: int = SKETCH) -> list[Column]:
    """The rows of :func:`quantile_sketches` as aggregates, to be had with others."""
    rows = []
    for c in columns:
        value, whole = _sketched(df, c)
        sketch = (F.kll_sketch_agg_bigint if whole else F.kll_sketch_agg_double)(value, size)
        rows.append(
            F.struct(F.lit(c).alias("field"), F.count(value).alias("n"), F.lit(whole).alias("whole"), sketch.alias("sketch"))
        )
    return rows


def merged_sketches(sketches: DataFrame) -> DataFrame:
    """One sketch for each field, from those of several parts of a table."""
    filled = lambda whole: F.when(F.col("whole") == whole, F.col("sketch"))
    return sketches.filter("n > 0").groupBy("field", "whole").agg(
        F.sum("n").alias("n"),
        F.kll_merge_agg_bigint(filled(True)).alias("long_sketch"),
        F.kll_merge_agg_double(filled(False)).alias("double_sketch"),
    )


def _brackets(sketches: DataFrame, shares: dict[str, float]) -> dict[str, tuple[int, list]]:
    """For each field its number of values, and two values around each share."""
    points = [p for s in shares.values() for p in (max(0.0, s - SLACK), min(1.0, s + SLACK))]
    at = F.array(*[F.lit(float(p)) for p in points])
    # Sketches leave NaN out; one of nothing else has no quantiles.
    longs = F.col("whole") & (F.kll_sketch_get_n_bigint("long_sketch") > 0)
    doubles = ~F.col("whole") & (F.kll_sketch_get_n_double("double_sketch") > 0)
    rows = merged_sketches(sketches).select(
        "field",
        "n",
        F.when(longs, F.kll_sketch_get_quantile_bigint("long_sketch", at)).alias("longs"),
        F.when(doubles, F.kll_sketch_get_quantile_double("double_sketch", at)).alias("doubles"),
    )
    return {r["field"]: (r["n"], r["longs"] if r["doubles"] is None else r["doubles"]) for r in rows.collect()}


def quantile_table(
    df: DataFrame, columns: list[str], shares: dict[str, float], *, sketches: DataFrame | None = None
) -> DataFrame:
    """Exact quantiles of several numeric columns: ``(field, ...)`` with a struct per
    share, in which ``v0``, ``v1``, ... stand for the different column types.

    Two scans, whatever the number of columns. The first makes sketches, which bracket
    each rank with a known error; it falls away if ``sketches`` of all parts of ``df`` are
    given (see :func:`quantile_sketches`). The second writes the few values inside the
    brackets and counts those below. The rank is settled among what was written. A bracket
    that misses its rank, of which the counts tell, takes another scan of that column.
    Without rows the quantiles are null.
    """
    kinds = list(dict.fromkeys(df.schema[c].dataType for c in columns))
    found = _brackets(quantile_sketches(df, columns) if sketches is None else sketches, shares)
    bounds, single, counts, ranks = {}, {}, [], {}
    for i, c in enumerate(columns):
        n, values = found.get(c, (0, None))
        exact = not isinstance(df.schema[c].dataType, T.DecimalType)
        for j, share in enumerate(shares.values()):
            if n:
                low, high = values[2 * j : 2 * j + 2] if values else (0, 0)
                value, _ = _sketched(df, c)
                ranks[i, j] = max(1, _ceil_share(n, share))
                if low == high and exact:
                    single[i, j] = F.lit(low)  # a value with many rows, if the counts agree
                else:
                    bounds[i, j] = value.between(low, high)
                counts.append(F.count_if(value < low).alias(f"l{i}_{j}"))
                counts.append(F.count_if(value <= high).alias(f"h{i}_{j}"))

    def cells(inside: dict[tuple[int, int], Column], values: dict[tuple[int, int], Column]) -> Column:
        """For each rank its value, if it lies inside."""
        made = []
        for (i, j), within in inside.items():
            kind = df.schema[columns[i]].dataType
            own = [values[i, j].cast(kind) if k == kind else F.lit(None).cast(k) for k in kinds]
            value = F.struct(*[v.alias(f"v{t}") for t, v in enumerate(own)])
            made.append(F.when(within, F.struct(F.lit(i).alias("_i"), F.lit(j).alias("_j"), value.alias("_v"))))
        return F.inline(F.array_compact(F.array(*made)))

    settled = None
    if ranks:
        own = {(i, j): F.col(f"`{columns[i]}`") for i, j in ranks}
        if bounds:
            # The counts belong to the scan that writes, whose tasks count once each.
            counted = Observation()
            settled = stored(df.observe(counted, *counts).select(cells(bounds, own)), "inside")
            totals = counted.get
        else:
            totals = df.agg(*counts).first().asDict()
        known, missed = {}, {}
        for (i, j), rank in ranks.items():
            below, upto = totals[f"l{i}_{j}"], totals[f"h{i}_{j}"]
            if not below < rank <= upto:
                missed[i, j] = own[i, j].isNotNull()
            elif (i, j) in single:
                known[i, j], ranks[i, j] = F.lit(True), 1
            else:
                ranks[i, j] = rank - below
        if missed and settled is not None:
            gone = [(F.col("_i") == i) & (F.col("_j") == j) for i, j in missed]
            settled = settled.filter(~functools.reduce(operator.or_, gone))
        more = [df.select(cells(missed, own))] if missed else []
        more += [df.sparkSession.range(1).select(cells(known, single))] if known else []
        given = [*([settled] if settled is not None else []), *more]
        settled = functools.reduce(DataFrame.unionByName, given)
    names = df.sparkSession.createDataFrame(list(enumerate(columns)), "_i int, field string")
    empty = F.lit(None).cast(T.StructType([T.StructField(f"v{t}", k) for t, k in enumerate(kinds)]))
    if settled is None:
        return names.select("field", *[empty.alias(q) for q in shares])
    counted = settled.groupBy("_i", "_j", "_v").agg(F.count(F.lit(1)).alias("_n"))
    placed = running_totals(counted, ["_i", "_j"], ["_v"], "_n", name="_start")
    wanted = F.lit(None)
    for (i, j), rank in ranks.items():
        wanted = F.when((F.col("_i") == i) & (F.col("_j") == j), rank).otherwise(wanted)
    hit = (F.col("_start") < wanted) & (F.col("_start") + F.col("_n") >= wanted)
    picks = [F.max(F.when(F.col("_j") == j, F.col("_v"))).alias(q) for j, q in enumerate(shares)]
    found = placed.filter(hit).groupBy("_i").agg(*picks)
    # One row per column on both sides.
    return names.join(F.broadcast(found), "_i", "left").select("field", *shares)


def _ceil_share(total: int, share: float) -> int:
    whole = int(total * share)
    return whole if whole == total * share else whole + 1
