"""Operators on sampled streams: smoothing, moving z-scores, fits and normalisation.

Streams are long tables, one row a sample of a channel of a session (`blockname`), numbered by
`sample_idx`. Long channels are cut in chunks of samples; each chunk gets the samples just outside it
as a halo, so a window never needs a whole channel in one task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

from tracewell.operators.scan import by_size, met, together
from tracewell.sources.scratch import saved

CHUNK = 1 << 16  # samples of a channel in one window partition
SLIDE = 32  # samples of a window that are summed anew for each sample
UNIT, SLACK = 1 << 40, 1 << 10  # a window's length as placed on its chunk, and what rounding may move a place by
SESSION = ["blockname", "channel"]


def moving_average(streams: DataFrame, windows: DataFrame, edges: str = "partial", value: str = "raw_au", out: str = "au_smooth_ma", chunk: int = CHUNK) -> DataFrame:
    """Centred moving average of k samples a channel; `windows` has (blockname, channel, k).

    `partial` averages what there is at the ends of a channel and, for even k, reaches k/2 samples
    back and k/2 - 1 on; `drop` keeps full windows only and reaches k/2 - 1 back and k/2 on. A window
    of no sample, or null, passes samples through. Nulls don't count; a window that holds a NaN or an
    infinity has no average.

    One window node serves all lengths. In each chunk samples are placed at sample / k, so a window reaches
    one half back and on whatever its k, and its sum is the difference of two prefix sums, whose frames
    grow by a row at a time. A prefix sum is kept in two parts, of which the first is exact while it is below
    2^43, and the second is less than 2^-10 a sample."""
    told = windows.select(*SESSION, F.greatest(F.coalesce(F.col("k").cast("int"), F.lit(0)), F.lit(0)).alias("_k"))
    rows = met(streams, saved(told, "windows"), SESSION, "left").withColumn("_k", F.coalesce("_k", F.lit(0)))
    back, on = ("_k div 2", "(_k - 1) div 2") if edges == "partial" else ("(_k - 1) div 2", "_k div 2")
    own = F.floor(F.col("sample_idx") / chunk)
    near = F.sequence(F.floor((F.col("sample_idx") - F.expr(on)) / chunk), F.floor((F.col("sample_idx") + F.expr(back)) / chunk))
    near = F.when(F.col("_k") > 1, near).otherwise(F.array(own))
    rows = rows.withColumn("_own", own).withColumn("_chunk", F.explode(near))
    rows = rows.withColumn("_at", F.expr(f"(sample_idx - _chunk * {chunk}L) * {UNIT}L div greatest(_k, 1)"))
    finite = F.abs(F.col(value).cast("double")) < float("inf")
    v = F.when(finite, F.col(value).cast("double"))
    rows = rows.withColumn("_v", v).withColumn("_hi", F.floor(F.col("_v") * 1024) / 1024).withColumn("_lo", F.col("_v") - F.col("_hi"))
    rows = rows.withColumn("_odd", F.when(F.col(value).isNotNull() & ~finite, 1))
    ordered = Window.partitionBy(*SESSION, "_chunk").orderBy("_at")
    less, more = UNIT // 2 - SLACK, UNIT // 2 + SLACK
    reach = (less, -more) if edges == "partial" else (more, -less)
    parts = {}
    for side, to in zip(("z", "a"), reach, strict=True):
        frame = ordered.rangeBetween(Window.unboundedPreceding, to)
        parts |= {f"_{side}_{c}": F.coalesce(F.sum(f"_{c}").over(frame), F.lit(0.0)) for c in ("hi", "lo")}
        parts |= {f"_{side}_n": F.count("_v").over(frame), f"_{side}_odd": F.count("_odd").over(frame), f"_{side}_all": F.count(F.lit(1)).over(frame)}
    done = rows.withColumns(parts).where("_chunk = _own")
    of = lambda c: F.col(f"_z_{c}") - F.col(f"_a_{c}")
    mean = F.when(of("odd") == 0, F.try_divide(of("hi") + of("lo"), of("n")))
    done = done.withColumn(out, F.when(F.col("_k") == 0, F.col(value)).otherwise(mean))
    if edges == "drop":
        done = done.where((F.col("_k") == 0) | (of("all") == F.col("_k")))
    return done.select(*streams.columns, out)


def moving_zscore(streams: DataFrame, before: int, value: str, keys: list[str], order: str = "sample_idx", chunk: int = CHUNK) -> DataFrame:
    """Adds `<value>_moving`: each sample against mean and deviation of the `before` samples ahead of
    it, itself not among them; null for the first ones and where nothing varies. Up to SLIDE samples are added up
    for each sample.

    Beyond, the cost of a sample doesn't follow from `before`: samples lie in blocks of that many, and those ahead of
    one are the end of a block and the start of the next. Counts, means and squared deviations are
    gathered from each block's start on and from its end back, row by row, and the two are merged; nothing is
    subtracted, so large drifts cost no digits. Chunks hold whole blocks, with the block ahead as a halo."""
    if before <= SLIDE:
        own = F.floor(F.col(order) / chunk)
        near = F.sequence(own, F.floor((F.col(order) + before) / chunk))
        frame = Window.partitionBy(*keys, "_chunk").orderBy(order).rowsBetween(-before, -1)
        rows = streams.withColumn("_own", own).withColumn("_chunk", F.explode(near))
        rows = rows.withColumns({"_mu": F.avg(value).over(frame), "_sd": F.stddev_samp(value).over(frame), "_n": F.count(value).over(frame)}).where("_chunk = _own")
        z = F.when(F.col("_n") == before, F.try_divide(F.col(value) - F.col("_mu"), F.col("_sd")))
        return rows.withColumn(f"{value}_moving", z).select(*streams.columns, f"{value}_moving")
    size = max(1, chunk // before) * before
    own = F.floor(F.col(order) / size)
    rows = streams.withColumn("_own", own).withColumn("_chunk", F.explode(F.array_distinct(F.array(own, F.floor((F.col(order) + before) / size)))))
    rows = rows.withColumn("_block", F.floor(F.col(order) / before)).where((F.col("_chunk") == F.col("_own")) | ((F.col("_block") + 1) * before == F.col("_chunk") * size))
    part = Window.partitionBy(*keys, "_chunk", "_block")
    told = {"n": F.count(value), "m": F.avg(value), "s": F.var_pop(value), "lo": F.min(value), "hi": F.max(value)}
    rows = rows.withColumns({f"_e{c}": f.over(part.orderBy(F.desc(order)).rowsBetween(Window.unboundedPreceding, 0)) for c, f in told.items()})
    rows = rows.withColumns({f"_b{c}": f.over(part.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)) for c, f in told.items()})
    ahead = Window.partitionBy(*keys, "_chunk").orderBy("_block", order)
    rows = rows.withColumns({f"_l{c}": F.lag(f"_e{c}", before).over(ahead) for c in told}).where("_chunk = _own")
    n1, n2 = F.coalesce("_ln", F.lit(0)), F.coalesce("_bn", F.lit(0))
    m1, m2, s1, s2 = (F.coalesce(c, F.lit(0.0)) for c in ("_lm", "_bm", "_ls", "_bs"))
    n = n1 + n2
    mean = m1 + (m2 - m1) * F.try_divide(n2, n)
    spread = n1 * s1 + n2 * s2 + (m2 - m1) * (m2 - m1) * F.try_divide(n1 * n2, n)
    varies = F.greatest("_lhi", "_bhi") > F.least("_llo", "_blo")
    z = F.when((n == before) & varies, F.try_divide(F.col(value) - mean, F.sqrt(F.try_divide(spread, n - 1))))
    return rows.withColumn(f"{value}_moving", z).select(*streams.columns, f"{value}_moving")


def sample_time(streams: DataFrame, info: DataFrame, zero_based: bool = False) -> DataFrame:
    """Adds `time` in seconds from the sample's number and the channel's rate `fs`."""
    first = 0 if zero_based else 1
    return streams.join(info.select(*SESSION, "fs"), SESSION).withColumn("time", (F.col("sample_idx") + first) / F.col("fs")).drop("fs")


def fiber_id(channel: str = "channel") -> Column:
    """Fibre of a detector's letters: 2 for C or D, else 1 for A or B, else null."""
    return F.when(F.col(channel).rlike("[CD]"), "2").when(F.col(channel).rlike("[AB]"), "1")


def paired(streams: DataFrame, signals: DataFrame, value: str = "au_smooth_ma", trim: Column | None = None) -> DataFrame:
    """Signal beside control, sample by sample: `signals` has (blockname, signal_wavelength,
    control_wavelength); a channel belongs to the wavelength that its name contains."""
    rows = streams if trim is None else streams.where(F.col("time") > trim)
    rows = rows.withColumn("fiber_id", fiber_id()).withColumn("_wave", F.regexp_extract("channel", r"(\d{3})", 1))
    names = ["signal_wavelength", "control_wavelength"]
    one = F.struct(F.col("_wave").alias("wave"), F.col(value).alias("v"))
    place = Window.partitionBy("blockname", "fiber_id", "sample_idx")
    held = rows.select("blockname", "fiber_id", "sample_idx", "time", "_wave", F.col(value).alias("signal"), F.collect_list(one).over(place).alias("_waves"))  # a value a channel
    pairs = held.join(signals.select("blockname", F.col(names[0]).alias("_wave"), *names), ["blockname", "_wave"])
    beside = F.filter("_waves", lambda c: c["wave"] == F.col("control_wavelength"))
    return pairs.select("blockname", "fiber_id", "sample_idx", "time", *names, "signal", F.explode(beside).alias("_c")).withColumn("control", F.col("_c.v")).drop("_c")


def polynomial_fits(df: DataFrame, keys: list[str], fits: list[tuple[str, str, int | str, str]], most: int = 4) -> DataFrame:
    """For each (x, y, degree, out) adds `out`, the least-squares polynomial of y on x in each group. A
    degree is a number, or names a column with one value a group, `most` at most. Rows with a null x or y
    don't count for their fit. With fewer distinct x than coefficients the polynomials that vanish on all of
    them are left out. Null keys are a group. Groups of up to TOGETHER rows are fitted whole, many in one task;
    both ways are least squares in polynomials that are orthogonal on the group's own x."""
    return by_size(df, keys, TOGETHER, lambda rows: _whole(rows, keys, [Polynomials(fits, most)]), lambda rows: _polynomial_fits(rows, keys, fits, most))


def _polynomial_fits(df: DataFrame, keys: list[str], fits: list[tuple[str, str, int | str, str]], most: int) -> DataFrame:
    """`polynomial_fits` of groups of any size.

    The fit is worked out in polynomials that are orthogonal on the group's own x, q0, q1, ..., given
    by their three-term recurrence, so that powers of x never meet in an ill-conditioned system. Three
    aggregates with map-side sums, a small table each: the range of every x and the mean of every y; sums of
    Chebyshev polynomials of the scaled x, which give the recurrence; and sums of q times q and q times y
    over the rows, whose almost diagonal system gives the coefficients and takes back what rounding has left of
    orthogonality."""
    xs, ys = (list(dict.fromkeys(f[i] for f in fits)) for i in (0, 1))
    told = list(dict.fromkeys(f[2] for f in fits if isinstance(f[2], str)))
    tops = [most if isinstance(f[2], str) else f[2] for f in fits]
    half, mid = (lambda x: (F.max(x) / 2 - F.min(x) / 2)), (lambda x: (F.max(x) / 2 + F.min(x) / 2))
    spans = [F.when(half(x) > 1e-200, half(x)).otherwise(1.0).alias(f"_s_{x}") for x in xs]
    scale = df.groupBy(*keys).agg(*[mid(x).alias(f"_m_{x}") for x in xs], *spans, *[F.avg(y).alias(f"_y_{y}") for y in ys], *[F.max(c).alias(f"_d_{c}") for c in told])
    scale = saved(scale, "fit-scales")
    at = lambda x: (F.col(x) - F.col(f"_m_{x}")) / F.col(f"_s_{x}")
    wide = [f"_{n}_{x}" for n in "ms" for x in xs]
    rows = met(df, scale.select(*keys, *wide), keys)
    rows = rows.select(*keys, *[F.when(F.col(y).isNotNull(), at(x)).alias(f"_t{i}") for i, (x, y, _, _) in enumerate(fits)])
    rows = _chebyshev(rows, tops)
    sums = rows.groupBy(*keys).agg(*[_sums([F.col(f"_t{i}_{k}") for k in range(2 * top + 1)]).alias(f"_c{i}") for i, top in enumerate(tops)])
    bases = saved(_by_group(met(sums, scale, keys), {f"_r{i}": (lambda r, i=i, top=top: _recurrence(np.asarray(r[f"_c{i}"]), top)) for i, top in enumerate(tops)}, [f"_c{i}" for i in range(len(fits))]), "fit-bases")
    rows = met(df, bases.drop(*[f"_d_{c}" for c in told]), keys)
    rows = rows.select(*keys, *[f"_r{i}" for i in range(len(fits))], *[c for i, (x, y, _, _) in enumerate(fits) for c in (F.when(F.col(y).isNotNull(), at(x)).alias(f"_t{i}"), (F.col(y) - F.col(f"_y_{y}")).alias(f"_v{i}"))])
    rows = _orthogonal(rows, tops)
    gathered = []
    for i, top in enumerate(tops):
        q = [F.col(f"_q{i}_{k}") for k in range(top + 1)]
        gathered.append(_sums([q[a] * q[b] for a in range(top + 1) for b in range(a + 1)] + [p * F.col(f"_v{i}") for p in q]).alias(f"_c{i}"))
    own = [(lambda r, f=f: r[f"_d_{f[2]}"] if isinstance(f[2], str) else f[2]) for f in fits]
    solve = {f"_b{i}": (lambda r, i=i, top=top: _solved(np.asarray(r[f"_c{i}"]), top, min(top, int(own[i](r))))) for i, top in enumerate(tops)}
    solved = _by_group(met(rows.groupBy(*keys).agg(*gathered), bases, keys), solve, [*[f"_c{i}" for i in range(len(fits))], *[f"_d_{c}" for c in told]])
    out = _orthogonal(met(df, saved(solved, "fits"), keys).withColumns({f"_t{i}": at(f[0]) for i, f in enumerate(fits)}), tops)
    values = [sum((F.element_at(f"_b{i}", k + 1) * F.col(f"_q{i}_{k}") for k in range(top + 1)), F.col(f"_y_{fits[i][1]}")) for i, top in enumerate(tops)]
    return out.select(*df.columns, *[v.alias(f[3]) for v, f in zip(values, fits, strict=True)])


def _by_group(table: DataFrame, columns: dict[str, Callable[[dict], list[float]]], used: list[str]) -> DataFrame:
    """A table of one row a group with more columns, arrays that follow from a row; `used` go."""
    schema = StructType([f for f in table.schema.fields if f.name not in used] + [StructField(c, ArrayType(DoubleType())) for c in columns])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = b.to_pylist()
            kept = [b.column(f.name) for f in schema.fields[: -len(columns)]]
            made = [pa.array([f(r) for r in rows], pa.list_(pa.float64())) for f in columns.values()]
            yield pa.RecordBatch.from_arrays([*kept, *made], names=schema.names)

    return table.mapInArrow(run, schema)


def _sums(columns: list[Column]) -> Column:
    return F.array(*[F.coalesce(F.sum(c), F.lit(0.0)) for c in columns])


def _chebyshev(rows: DataFrame, tops: list[int]) -> DataFrame:
    """Adds `_t<i>_<k>`, the Chebyshev polynomials of `_t<i>` up to 2 * top, a step of all fits at a time, as
    each needs the two before it."""
    rows = rows.withColumns({f"_t{i}_0": F.when(F.col(f"_t{i}").isNotNull(), 1.0) for i in range(len(tops))} | {f"_t{i}_1": F.col(f"_t{i}") for i, top in enumerate(tops) if top})
    for k in range(2, 2 * max(tops) + 1):
        rows = rows.withColumns({f"_t{i}_{k}": 2 * F.col(f"_t{i}") * F.col(f"_t{i}_{k - 1}") - F.col(f"_t{i}_{k - 2}") for i, top in enumerate(tops) if k <= 2 * top})
    return rows


def _orthogonal(rows: DataFrame, tops: list[int]) -> DataFrame:
    """Adds `_q<i>_<k>`, the orthogonal polynomials at `_t<i>`. `_r<i>` holds their recurrence: 1 / b0,
    then a and 1 / b and b of each step."""
    r = lambda i, k: F.element_at(f"_r{i}", k)
    rows = rows.withColumns({f"_q{i}_0": F.when(F.col(f"_t{i}").isNotNull(), r(i, 1)) for i in range(len(tops))})
    for k in range(max(tops)):
        steps = {}
        for i, top in enumerate(tops):
            if k < top:
                step = (F.col(f"_t{i}") - r(i, 3 * k + 2)) * F.col(f"_q{i}_{k}")
                steps[f"_q{i}_{k + 1}"] = (step - r(i, 3 * k + 4) * F.col(f"_q{i}_{k - 1}") if k else step) * r(i, 3 * k + 3)
        rows = rows.withColumns(steps)
    return rows


def _recurrence(sums: np.ndarray, top: int) -> list[float]:
    """The recurrence of the polynomials that are orthonormal on points, from their sums of Chebyshev
    polynomials up to 2 * top. A polynomial that all but vanishes on the points gets 1 / b = 0, and
    so do those after it."""
    n = sums[0]
    if n <= 0:
        return [0.0] * (3 * top + 1)
    grid = np.array([[(sums[i + j] + sums[abs(i - j)]) / 2 for j in range(top + 1)] for i in range(top + 1)])

    def times_t(c: np.ndarray) -> np.ndarray:
        out = np.zeros(top + 1)
        out[1:] += c[:-1] / 2
        out[: top] += c[1:] / 2
        if top:
            out[1] += c[0] / 2  # t T0 = T1
        return out

    out, before, q, b = [1 / np.sqrt(n)], np.zeros(top + 1), np.eye(top + 1)[0] / np.sqrt(n), 0.0
    for _ in range(top):
        up = times_t(q)
        a = up @ grid @ q
        new = up - a * q - b * before
        for old in (before, q):  # once more, for what rounding has left
            new -= (new @ grid @ old) * old
        size = new @ grid @ new
        small = size <= 1e-13 * (up @ grid @ up) or not q.any()
        nb = 0.0 if small else float(np.sqrt(size))
        out += [float(a), 0.0 if small else 1 / nb, float(b)]
        before, q, b = q, new * 0 if small else new / nb, nb
    return out


def polynomial_fit(df: DataFrame, keys: list[str], x: str, y: str, degree: int, out: str) -> DataFrame:
    return polynomial_fits(df, keys, [(x, y, degree, out)])


def _solved(sums: np.ndarray, top: int, degree: int) -> list[float]:
    """Coefficients of the first `degree` + 1 orthogonal polynomials from the lower triangle of their
    products and their products with y, filled up with zeros to `top`."""
    m, grid = top + 1, np.zeros((top + 1, top + 1))
    grid[np.tril_indices(m)] = sums[: m * (m + 1) // 2]
    grid += np.tril(grid, -1).T
    live = [k for k in range(degree + 1) if grid[k, k] > 1e-3]  # 1, but for those that vanish
    out = np.zeros(m)
    if live:
        out[live] = np.linalg.solve(grid[np.ix_(live, live)], sums[m * (m + 1) // 2 :][live])
    return out.tolist()


def polynomial(coefficients: str, degree: int, at: Column) -> Column:
    """The polynomial at a place, by its array of coefficients."""
    value = F.lit(0.0)
    for k in range(degree, -1, -1):
        value = value * at + F.element_at(coefficients, k + 1)
    return value


EPSILON, ALPHA = 1.35, 1e-4  # of the robust fit: where its loss turns linear, and its penalty
TOGETHER = 1 << 18  # rows of a group that is fitted in one task


def huber_fit(df: DataFrame, keys: list[str], x: str, y: str, out: str, degree: int = 4, epsilon: float = EPSILON, alpha: float = ALPHA, rounds: int = 100) -> DataFrame:
    """Adds `out`, a robust polynomial of `y` on `x` in each group: the minimum of Huber's joint loss
    over coefficients and scale (`huber_states`). Rows with a null x or y don't count and get null."""

    def spread(rows: DataFrame) -> DataFrame:
        fits = _huber_spread(rows, keys, x, y, degree, epsilon, alpha, rounds).drop("_sigma", "_n")
        value = polynomial("_c", degree, (F.col(x) - F.col("_m")) / F.col("_s"))
        return met(rows, fits, keys, "left").withColumn(out, F.when(F.col(y).isNotNull(), value)).drop("_m", "_s", "_c")

    return by_size(df, keys, TOGETHER, lambda rows: _whole(rows, keys, [Huber(x, y, out, degree, epsilon, alpha, rounds)]), spread)


def huber_states(df: DataFrame, keys: list[str], x: str, y: str, degree: int = 4, epsilon: float = EPSILON, alpha: float = ALPHA, rounds: int = 100) -> DataFrame:
    """A row a group: the coefficients `_c` on (x - _m) / _s and the scale `_sigma` where Huber's joint loss
    is least, by reweighted least squares on scaled features, converged.

    Groups of up to TOGETHER rows are worked out whole, many in one task, larger ones in rounds
    (`_huber_spread`). Both ways take the same steps."""
    rows = df.select(*keys, F.col(x).cast("double").alias("_x"), F.col(y).cast("double").alias("_y"))
    fields = [StructField("_m", DoubleType()), StructField("_s", DoubleType()), StructField("_n", LongType()), StructField("_sigma", DoubleType()), StructField("_c", ArrayType(DoubleType()))]
    schema = StructType([f for f in rows.schema.fields if f.name in keys] + fields)
    fit = Huber("_x", "_y", "", degree, epsilon, alpha, rounds)

    def alone(part: DataFrame) -> DataFrame:
        return together(part.where("_x IS NOT NULL AND _y IS NOT NULL"), keys, lambda table, firsts: fit.states(table.select(keys), Groups(table, firsts)), schema)

    return saved(by_size(rows, keys, TOGETHER, alone, lambda part: _huber_spread(part, keys, "_x", "_y", degree, epsilon, alpha, rounds)), "huber-fits")


def _huber_spread(df: DataFrame, keys: list[str], x: str, y: str, degree: int, epsilon: float, alpha: float, rounds: int) -> DataFrame:
    """`huber_states` of groups of any size. Every round is one aggregate of weighted moments over the groups
    still moving, so no task holds them; what is known of those groups (coefficients and scale) is a row
    each of a small table, one written a round. Groups that have settled are left where they were written."""
    known = saved(df.where(F.col(x).isNotNull() & F.col(y).isNotNull()).select(*keys, F.col(x).cast("double").alias("_x"), F.col(y).cast("double").alias("_y")), "huber-rows")
    start = saved(known.groupBy(*keys).agg(F.avg("_x").alias("_m"), F.when(F.stddev_pop("_x") > 0, F.stddev_pop("_x")).otherwise(1.0).alias("_s"), F.count("*").alias("_n"), F.percentile_approx("_y", 0.5, 10_000).alias("_mid")), "huber-starts")
    middle = met(known, start, keys).groupBy(*keys).agg(F.greatest(F.lit(1e-12), 1.4826 * F.percentile_approx(F.abs(F.col("_y") - F.col("_mid")), 0.5, 10_000)).alias("_sigma"))
    moving = saved(met(start.drop("_mid"), middle, keys).withColumns({"_c": F.lit(None).cast("array<double>"), "_done": F.lit(False)}), "huber")
    columns = [*keys, "_m", "_s", "_n", "_sigma", "_c"]
    settled = moving.where("_done").select(columns)
    for _ in range(rounds):
        if moving.isEmpty():
            break
        moved = saved(_huber_round(known, moving, keys, degree, epsilon, alpha), "huber")
        settled, moving = settled.unionByName(moved.where("_done").select(columns)), moved.where("not _done")
    return saved(settled.unionByName(moving.select(columns)), "huber-fits")


def _huber_step(sums: np.ndarray, sigma: float, old: np.ndarray | None, n: int, inner: float, outer: int, degree: int, epsilon: float, alpha: float) -> tuple[float, np.ndarray, bool]:
    """Scale and coefficients after one step from weighted moments (of t up to 2 * degree, then of t and y),
    the squares inside the bound and the number outside it; and whether they have settled."""
    ridge = alpha * np.eye(degree + 1)
    ridge[0, 0] = 0.0
    grid = np.array([[sums[i + j] for j in range(degree + 1)] for i in range(degree + 1)]) / sigma + ridge
    new = np.linalg.lstsq(grid, np.asarray(sums[2 * degree + 1 :]) / sigma, rcond=1e-12)[0]
    # The scale that minimises n * sigma + sum of losses, for the split inside / outside.
    free, scale = n - epsilon**2 * outer, sigma
    if old is not None and free > 0 and inner == inner:
        scale = max(1e-12, float(np.sqrt(inner / free)))
    done = old is not None and np.max(np.abs(new - old)) <= 1e-9 * (1 + np.max(np.abs(new))) and abs(scale - sigma) <= 1e-9 * sigma
    return scale, new, bool(done)


def _huber_round(known: DataFrame, state: DataFrame, keys: list[str], degree: int, epsilon: float, alpha: float) -> DataFrame:
    """The state after one more round: moments under the weights that the old state gives."""
    rows = met(known, state, keys)
    t = (F.col("_x") - F.col("_m")) / F.col("_s")
    rest = F.abs(F.col("_y") - polynomial("_c", degree, t))
    bound = epsilon * F.col("_sigma")
    rows = rows.withColumns({"_t": t, "_r": rest}).withColumn("_w", F.when(F.col("_r").isNull() | (F.col("_r") <= bound), 1.0).otherwise(bound / F.col("_r")))
    power = [F.col("_w")]
    for _ in range(2 * degree):
        power.append(power[-1] * F.col("_t"))
    sums = F.array(*[F.sum(p) for p in power], *[F.sum(p * F.col("_y")) for p in power[: degree + 1]])
    inside = F.col("_r") <= bound
    gathered = rows.groupBy(*keys, "_m", "_s", "_n", "_sigma", "_c").agg(sums.alias("_sums"), F.sum(F.when(inside, F.col("_r") * F.col("_r"))).alias("_in"), F.count_if(~inside).alias("_out"))

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for sums, sigma, old, n, inner, outer in zip(b["_sums"], b["_sigma"], b["_c"], b["_n"], b["_in"], b["_out"], strict=True):
                out.append(_huber_step(np.asarray(sums), sigma, None if old is None else np.asarray(old), n, inner, outer, degree, epsilon, alpha))
            yield b[[*keys, "_m", "_s", "_n"]].assign(_sigma=[o[0] for o in out], _c=[o[1].tolist() for o in out], _done=[o[2] for o in out])

    return gathered.mapInPandas(solve, state.select(*keys, "_m", "_s", "_n", "_sigma", "_c", "_done").schema)


def normalised(df: DataFrame, keys: list[str], deltas: list[str]) -> DataFrame:
    """Adds `<delta>_zscore` and `<delta>_dff` from one aggregate a group, joined back."""
    stats = saved(df.groupBy(*keys).agg(*[f(d).alias(f"_{n}_{d}") for d in deltas for n, f in (("m", F.avg), ("s", F.stddev_samp))]), "deviations")
    out = met(df, stats, keys)
    for d in deltas:
        mean, high = F.col(f"_m_{d}"), 100 + F.col(f"_m_{d}")
        out = out.withColumn(f"{d}_zscore", F.try_divide(F.col(d) - mean, F.col(f"_s_{d}"))).withColumn(f"{d}_dff", F.try_divide(F.col(d) - mean, high))
    return out.drop(*[f"_{n}_{d}" for d in deltas for n in "ms"])


class Groups:
    """Columns of a table of whole groups as numbers, each with what isn't null, and sums by group."""

    def __init__(self, table: pa.Table, firsts: np.ndarray) -> None:
        self.table, self.firsts, self.sizes = table, firsts, np.diff(np.append(firsts, table.num_rows))
        self.made: dict[str, tuple[np.ndarray, np.ndarray]] = {}

    def column(self, name: str) -> tuple[np.ndarray, np.ndarray]:
        if name not in self.made:
            c = self.table.column(name)
            self.made[name] = c.cast(pa.float64()).fill_null(0.0).to_numpy(), c.is_valid().to_numpy()
        return self.made[name]

    def sum(self, v: np.ndarray) -> np.ndarray:
        return np.add.reduceat(v, self.firsts)

    def least(self, v: np.ndarray, there: np.ndarray) -> np.ndarray:
        return np.minimum.reduceat(np.where(there, v, np.inf), self.firsts)

    def most(self, v: np.ndarray, there: np.ndarray) -> np.ndarray:
        return np.maximum.reduceat(np.where(there, v, -np.inf), self.firsts)

    def each(self, of_group: np.ndarray) -> np.ndarray:
        """A group's value beside each of its rows."""
        return np.repeat(of_group, self.sizes)


def _whole(df: DataFrame, keys: list[str], steps: list) -> DataFrame:
    """The columns that the steps add, one after the other, in one pass over whole groups."""
    added = [c for s in steps for c in s.adds]
    kept = [c for c in df.columns if c not in added]

    def work(table: pa.Table, firsts: np.ndarray) -> pa.Table:
        groups = Groups(table, firsts)
        with np.errstate(all="ignore"):
            for s in steps:
                groups.made |= s.columns(groups)
        for c in added:
            values, there = groups.made[c]
            table = table.append_column(c, pa.array(values, pa.float64(), mask=~there))
        return table

    return together(df.select(kept), keys, work, StructType([f for f in df.schema.fields if f.name in kept] + [StructField(c, DoubleType()) for c in added]))


class Polynomials:
    """The fits of `polynomial_fits`."""

    def __init__(self, fits: list[tuple[str, str, int | str, str]], most: int) -> None:
        self.fits, self.most, self.adds = fits, most, [f[3] for f in fits]

    def columns(self, g: Groups) -> dict[str, tuple[np.ndarray, np.ndarray]]:
        out, bases = {}, {}
        for x, y, degree, name in self.fits:
            (v, there), (p, known) = g.column(y), g.column(x)
            n = g.sum(there.astype(float))
            mean = np.where(n > 0, g.sum(v) / n, np.nan)
            top = self.most if isinstance(degree, str) else degree
            use = there & known
            base = (x, top, use.tobytes())  # signal and control over the same times share theirs
            if base not in bases:
                lo, hi = g.least(p, known), g.most(p, known)
                half = hi / 2 - lo / 2
                t = (p - g.each(hi / 2 + lo / 2)) / g.each(np.where(half > 1e-200, half, 1.0))
                bases[base] = _basis(g, np.where(known, t, 0.0), use, top)
            rest, fit = np.where(use, v - g.each(mean), 0.0), g.each(mean)
            asked = g.most(*g.column(degree)) if isinstance(degree, str) else np.full(len(n), top)
            for k, q in enumerate(bases[base]):
                fit = fit + g.each(np.where(k <= asked, g.sum(rest * q), 0.0)) * q
            out[name] = fit, known & g.each(n > 0)
        return out


def _basis(g: Groups, t: np.ndarray, use: np.ndarray, top: int) -> list[np.ndarray]:
    """Polynomials of t up to `top` that are orthonormal on the rows in use, at all rows. One that all but vanishes
    on them is 0, and so are those after it."""
    on = (lambda v: g.sum(v)) if use.all() else (lambda v: g.sum(np.where(use, v, 0.0)))
    n = g.sum(use.astype(float))
    out = [g.each(np.where(n > 0, 1 / np.sqrt(n), 0.0))]
    for k in range(top):
        new = up = t * out[k]
        for _ in range(2):  # once more, for what rounding has left
            for old in out[::-1]:
                new = new - g.each(on(new * old)) * old
        size = on(new * new)
        small = size <= 1e-13 * on(up * up)
        out.append(new * g.each(np.where(small, 0.0, 1 / np.sqrt(size))) if not small.all() else np.zeros(len(t)))
    return out


class Residuals:
    """What the fits leave of signal and control."""

    adds = property(lambda self: DELTAS)

    def columns(self, g: Groups) -> dict[str, tuple[np.ndarray, np.ndarray]]:
        return {d: (g.column(a)[0] - g.column(b)[0], g.column(a)[1] & g.column(b)[1]) for d, (a, b) in zip(DELTAS, RESIDUALS, strict=True)}


class Scores:
    """The columns of `normalised`."""

    def __init__(self, deltas: list[str]) -> None:
        self.deltas, self.adds = deltas, [f"{d}_{k}" for d in deltas for k in ("zscore", "dff")]

    def columns(self, g: Groups) -> dict[str, tuple[np.ndarray, np.ndarray]]:
        out = {}
        for d in self.deltas:
            v, there = g.column(d)
            n = g.sum(there.astype(float))
            mean = g.sum(np.where(there, v, 0.0)) / n
            off = v - g.each(mean)
            sd = np.sqrt(g.sum(np.where(there, off * off, 0.0)) / (n - 1))
            varies = (n > 1) & (g.least(v, there) != g.most(v, there)) & (sd != 0)
            out[f"{d}_zscore"] = off / g.each(sd), there & g.each(varies)
            out[f"{d}_dff"] = off / g.each(100 + mean), there & g.each(mean != -100)
        return out


class Huber:
    """The robust fits of `huber_fit`, the steps of all groups side by side."""

    def __init__(self, x: str, y: str, out: str, degree: int = 4, epsilon: float = EPSILON, alpha: float = ALPHA, rounds: int = 100) -> None:
        self.x, self.y, self.out, self.adds = x, y, out, [out]
        self.degree, self.epsilon, self.alpha, self.rounds = degree, epsilon, alpha, rounds

    def columns(self, g: Groups) -> dict[str, tuple[np.ndarray, np.ndarray]]:
        (x, known), (y, there) = g.column(self.x), g.column(self.y)
        use = known & there
        n = g.sum(use.astype(np.int64))
        some, ends = n > 0, np.cumsum(n)
        mean, spread, _, c = self.fit(x[use], y[use], (ends - n)[some], n[some])
        whole = np.zeros((len(n), 2 + c.shape[1]))
        whole[some] = np.column_stack([mean, spread, c])
        t, value = (x - g.each(whole[:, 0])) / g.each(np.where(some, whole[:, 1], 1.0)), np.zeros(len(x))
        for k in range(self.degree, -1, -1):
            value = value * t + g.each(whole[:, 2 + k])
        return {self.out: (value, use)}

    def states(self, keys: pa.Table, g: Groups) -> pa.Table:
        with np.errstate(all="ignore"):
            mean, spread, sigma, c = self.fit(g.column(self.x)[0], g.column(self.y)[0], g.firsts, g.sizes)
        c = pa.FixedSizeListArray.from_arrays(pa.array(c.ravel()), c.shape[1]).cast(pa.list_(pa.float64()))
        out = keys.take(pa.array(g.firsts))
        for name, v in (("_m", mean), ("_s", spread), ("_n", g.sizes.astype(np.int64)), ("_sigma", sigma), ("_c", c)):
            out = out.append_column(name, v if isinstance(v, pa.Array) else pa.array(v))
        return out

    def fit(self, x: np.ndarray, y: np.ndarray, firsts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Mean and spread of x, scale and coefficients of each group."""
        top, groups = self.degree, len(firsts)
        if not groups:
            return np.zeros(0), np.zeros(0), np.zeros(0), np.zeros((0, top + 1))
        each = lambda v: np.repeat(v, sizes)
        mean = np.add.reduceat(x, firsts) / sizes
        spread = np.sqrt(np.add.reduceat((x - each(mean)) ** 2, firsts) / sizes)
        spread[~((spread > 0) & (np.minimum.reduceat(x, firsts) != np.maximum.reduceat(x, firsts)))] = 1.0
        sigma = np.maximum(1e-12, 1.4826 * _middle(np.abs(y - each(_middle(y, firsts, sizes))), firsts, sizes))
        ridge = self.alpha * np.eye(top + 1)
        ridge[0, 0] = 0.0
        powers = ((x - each(mean)) / each(spread))[None, :] ** np.arange(2 * top + 1)[:, None]
        coefficients, scales = np.full((groups, top + 1), np.nan), sigma.copy()
        left, c = np.arange(groups), None  # groups still moving
        for _ in range(10 * self.rounds):
            if c is None:
                w, scale = np.ones(len(y)), sigma
            else:
                rest = np.abs(y - sum(np.repeat(c[:, k], sizes) * powers[k] for k in range(top + 1)))
                bound = np.repeat(self.epsilon * sigma, sizes)
                inside = rest <= bound
                w = np.where(inside, 1.0, bound / np.maximum(rest, 1e-300))
                # The scale that minimises n * sigma + sum of losses, for the split inside / outside.
                free = sizes - self.epsilon**2 * np.add.reduceat((~inside).astype(float), firsts)
                scale = np.where(free > 0, np.maximum(1e-12, np.sqrt(np.add.reduceat(np.where(inside, rest * rest, 0.0), firsts) / np.where(free > 0, free, 1.0))), sigma)
            sums = np.add.reduceat(w * powers, firsts, axis=1) / sigma
            right = np.add.reduceat((w * y) * powers[: top + 1], firsts, axis=1) / sigma
            grid = sums.T[:, np.add.outer(np.arange(top + 1), np.arange(top + 1))] + ridge
            new = _least_squares(grid, right.T)
            if c is None:
                done = ~np.isfinite(new).all(1)
            else:
                done = (np.abs(new - c).max(1) <= 1e-9 * (1 + np.abs(new).max(1))) & (np.abs(scale - sigma) <= 1e-9 * sigma) | ~np.isfinite(new).all(1)
            c, sigma = new, scale
            coefficients[left], scales[left] = c, sigma
            if done.any():
                stay = ~done
                rows = np.repeat(stay, sizes)
                left, c, sigma, sizes = left[stay], c[stay], sigma[stay], sizes[stay]
                if not len(left):
                    break
                y, powers, firsts = y[rows], powers[:, rows], np.cumsum(sizes) - sizes
        return mean, spread, scales, coefficients


def _middle(v: np.ndarray, firsts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The lower median of each group."""
    order = np.lexsort((v, np.repeat(np.arange(len(firsts)), sizes)))
    return v[order][firsts + (sizes + 1) // 2 - 1]


def _least_squares(grids: np.ndarray, rights: np.ndarray) -> np.ndarray:
    """The shortest least-squares solution of each symmetric system; NaN where one isn't finite."""
    fine = np.isfinite(grids).all((1, 2)) & np.isfinite(rights).all(1)
    values, vectors = np.linalg.eigh(np.where(fine[:, None, None], grids, 0.0))
    large = np.abs(values) > 1e-12 * np.abs(values).max(1, keepdims=True)
    inverse = np.where(large, 1 / np.where(large, values, 1.0), 0.0)
    out = (vectors @ (inverse * (vectors.transpose(0, 2, 1) @ np.where(fine[:, None], rights, 0.0)[:, :, None])[:, :, 0])[:, :, None])[:, :, 0]
    return np.where(fine[:, None], out, np.nan)


FIT_KEYS = ["blockname", "fiber_id", "signal_wavelength", "control_wavelength"]
DELTAS = ["delta_signal_fitted_control", "delta_signal_poly", "delta_control_poly"]
RESIDUALS = [("signal", "control_fitted"), ("signal", "poly_signal"), ("control", "poly_control")]


def fitted(pairs: DataFrame, degree_control: int | str = 3, degree_time: int | str = 4, model: str = "polynomial", keys: list[str] | None = None) -> DataFrame:
    """Fits of a session's paired signals, their residuals, z-scores and dF/F. Every step reads the pairs
    anew, so they should be a written table. Degrees are numbers or columns."""
    keys = keys or FIT_KEYS
    fits = [("time", "signal", degree_time, "poly_signal"), ("time", "control", degree_time, "poly_control")]
    first = [("control", "signal", degree_control, "control_fitted")] if model != "huber" else []
    return fitted_deltas(pairs, keys, [*first, *fits], [Huber("control", "signal", "control_fitted")] if model == "huber" else [])


def fitted_deltas(pairs: DataFrame, keys: list[str], fits: list[tuple[str, str, int | str, str]], before: list[Huber] | None = None) -> DataFrame:
    """The fits of signal and control, their residuals (DELTAS), z-scores and dF/F, in one pass for groups of up to
    TOGETHER rows."""
    before = before or []

    def spread(rows: DataFrame) -> DataFrame:
        for f in before:
            rows = huber_fit(rows, keys, f.x, f.y, f.out, f.degree, f.epsilon, f.alpha, f.rounds)
        rows = _polynomial_fits(rows, keys, fits, 4)
        return normalised(rows.withColumns({d: F.col(a) - F.col(b) for d, (a, b) in zip(DELTAS, RESIDUALS, strict=True)}), keys, DELTAS)

    return by_size(pairs, keys, TOGETHER, lambda rows: _whole(rows, keys, [*before, Polynomials(fits, 4), Residuals(), Scores(DELTAS)]), spread)


def stream_info(samples: DataFrame, time: str = "time") -> DataFrame:
    """Sampling rate, size, first and last time of each channel: fs is one over the mean step."""
    out = samples.groupBy(*SESSION).agg(F.count("*").alias("size"), F.min(time).alias("start_time"), F.max(time).alias("end_time"))
    return out.withColumn("fs", F.try_divide(F.col("size") - 1, F.col("end_time") - F.col("start_time")))
