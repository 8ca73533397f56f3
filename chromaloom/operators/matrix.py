"""Contact matrices, normalisation and matrix analytics.

A matrix is (res, c1, c2, b1, b2, n): counts per bin pair, upper triangle on one
chromosome, canonical chromosome order otherwise.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import names
from .pairs import mapq_filter
from .support import BROADCAST_ROWS, cut, cut_measuring, lookup_join

# fixed values: resolutions of a standard map, and the finer ones of a deep map
RESOLUTIONS = (2_500_000, 1_000_000, 500_000, 250_000, 100_000, 50_000, 25_000, 10_000, 5_000, 2_000, 1_000)
DEEP_RESOLUTIONS = (500, 200, 100, 50, 20, 10)
FRAGMENT_FACTORS = (500, 200, 100, 50, 20, 5, 2, 1)

PIXEL = ["c1", "c2", "b1", "b2"]


def _levels(df: DataFrame, sizes, first) -> DataFrame:
    """Counts at every size; each level sums the largest finer level that divides it."""
    built: dict[int, DataFrame] = {}
    for size in sorted(set(sizes)):
        divisors = [s for s in built if size % s == 0]
        if divisors:
            step = size // max(divisors)
            finer = built[max(divisors)]
            built[size] = (finer.groupBy("c1", "c2", F.expr(f"b1 div {step}").alias("b1"), F.expr(f"b2 div {step}").alias("b2"))
                           .agg(F.sum("n").alias("n")))
        else:
            built[size] = first(df, size)
    return reduce(DataFrame.unionByName, [
        m.select(F.lit(size).cast("bigint").alias("res"), *PIXEL, "n") for size, m in built.items()])


def _binned(a: Column, b: Column) -> list[Column]:
    """Two bins in storage order: swapped on one chromosome when the first is larger."""
    swap = (F.col("c1") == F.col("c2")) & (a > b)
    return [F.when(swap, b).otherwise(a).alias("b1"), F.when(swap, a).otherwise(b).alias("b2")]


def contact_matrix(pairs: DataFrame, resolutions=RESOLUTIONS, q: int | None = None,
                   sizes: DataFrame | None = None) -> DataFrame:
    """Matrices at all resolutions from one pass over the pairs.

    Only the finest levels read the pairs; coarser ones add up finer bins. Pairs on
    chromosomes outside ``sizes`` are dropped.
    """
    kept = pairs if q is None else mapq_filter(pairs, q)
    narrow = kept.select("c1", "p1", "c2", "p2")
    if sizes is not None:
        chroms, n = cut_measuring(sizes.select("chrom"), F.count("*"))
        for i in (1, 2):
            narrow = lookup_join(narrow, chroms.withColumnRenamed("chrom", f"c{i}"), [f"c{i}"], "inner", salt_from=["p1", "p2"], small=n <= BROADCAST_ROWS)

    def first(df: DataFrame, size: int) -> DataFrame:
        a, b = F.expr(f"p1 div {size}"), F.expr(f"p2 div {size}")
        return df.groupBy("c1", "c2", *_binned(a, b)).agg(F.count("*").alias("n"))

    return _levels(narrow, resolutions, first)


def fragment_matrix(pairs: DataFrame, factors=FRAGMENT_FACTORS, q: int | None = None) -> DataFrame:
    """Matrices over runs of ``factor`` fragments; ``res`` is the factor."""
    kept = pairs if q is None else mapq_filter(pairs, q)

    def first(df: DataFrame, size: int) -> DataFrame:
        a, b = F.expr(f"f1 div {size}"), F.expr(f"f2 div {size}")
        return df.groupBy("c1", "c2", *_binned(a, b)).agg(F.count("*").alias("n"))

    return _levels(kept.select("c1", "f1", "c2", "f2"), factors, first)


def homolog_matrices(pairs: DataFrame, resolutions=RESOLUTIONS, separate: bool = False) -> DataFrame:
    """Matrices of homolog contacts, together or one set per homolog without the suffix."""
    if not separate:
        return contact_matrix(pairs, resolutions)
    own = pairs.withColumn("homolog", F.regexp_extract("c1", "-([ra])$", 1))
    plain = own.withColumns({c: names.strip_homolog(F.col(c)) for c in ("c1", "c2")})
    parts = [contact_matrix(plain.where(F.col("homolog") == h), resolutions).withColumn("homolog", F.lit(h))
             for h in ("r", "a")]
    return parts[0].unionByName(parts[1])


def intra(matrix: DataFrame) -> DataFrame:
    return matrix.where("c1 = c2").withColumnRenamed("c1", "chrom").drop("c2")


def mirrored(matrix: DataFrame, value: str = "n") -> DataFrame:
    """Both triangles of the intra-chromosomal matrices: (res, chrom, i, j, value)."""
    cells = F.when(F.col("b1") == F.col("b2"), F.array(F.struct(F.col("b1").alias("i"), F.col("b2").alias("j")))).otherwise(
        F.array(F.struct(F.col("b1").alias("i"), F.col("b2").alias("j")), F.struct(F.col("b2").alias("i"), F.col("b1").alias("j"))))
    return intra(matrix).select("res", "chrom", F.explode(cells).alias("x"), value).select("res", "chrom", "x.*", value)


def row_sums(matrix: DataFrame) -> DataFrame:
    return (mirrored(matrix).groupBy("res", "chrom", F.col("i").alias("bin")).agg(F.sum("n").cast("double").alias("total")))


def norm_vectors(matrix: DataFrame, kind: str = "VC", iters: int = 50, min_total: float = 0.0,
                 cut_every: int = 5) -> DataFrame:
    """Factor per bin: VC (row sum), VC_SQRT (its root) or BALANCE; (res, chrom, kind, bin, v)."""
    if kind == "VC":
        vectors = row_sums(matrix).withColumn("v", F.col("total"))
    elif kind == "VC_SQRT":
        vectors = row_sums(matrix).withColumn("v", F.sqrt("total"))
    elif kind == "BALANCE":
        vectors = _balanced(matrix, iters, min_total, cut_every)
    else:
        raise ValueError(f"unknown normalisation: {kind}")
    return vectors.select("res", "chrom", F.lit(kind).alias("kind"), "bin", "v")


def _balanced(matrix: DataFrame, iters: int, min_total: float, cut_every: int) -> DataFrame:
    """x <- x / sqrt(x * (M x)), so that all rows of diag(x) M diag(x) add up to 1.

    The mirrored matrix is stored once; every round is one join on the column and one
    grouped sum on the row, and the vector is checkpointed every few rounds. Factors are
    1 / x, so that normalised counts are n / (v_i * v_j) for every kind.
    """
    full = cut(mirrored(matrix))
    totals = full.groupBy("res", "chrom", "i").agg(F.sum("n").alias("t")).where(F.col("t") > min_total)
    x = cut(totals.select("res", "chrom", F.col("i").alias("bin"), (1.0 / F.sqrt("t")).alias("x")))
    keep = x.select("res", "chrom", F.col("bin").alias("i"))
    if min_total > 0:
        full = cut(full.join(keep, ["res", "chrom", "i"], "left_semi"))
    # the vector has one entry per bin of the genome, which sets its size
    small = x.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    for done in range(1, iters + 1):
        weights = x.select("res", "chrom", F.col("bin").alias("j"), "x")
        weighted = lookup_join(full, weights, ["res", "chrom", "j"], "inner", salt_from=["i"], small=small)
        sums = weighted.groupBy("res", "chrom", F.col("i").alias("bin")).agg(F.sum(F.col("n") * F.col("x")).alias("s"))
        x = (x.join(sums, ["res", "chrom", "bin"])
             .select("res", "chrom", "bin", (F.col("x") / F.sqrt(F.col("x") * F.col("s"))).alias("x")))
        if done % cut_every == 0 and done < iters:
            x = cut(x)
    return x.withColumn("v", 1.0 / F.col("x"))


# Balancing by Newton steps: largest residual, steps, and rounds of the solver inside a step.
TOLERANCE = 1e-6
NEWTON_STEPS = 30
SOLVER_ROUNDS = 8
# Contacts of the sparsest row that is kept over those of the mean row.
LEAST_SHARE = 0.1


def balanced(matrix: DataFrame, tolerance: float = TOLERANCE, least_share: float = LEAST_SHARE, steps: int = NEWTON_STEPS, rounds: int = SOLVER_ROUNDS) -> DataFrame:
    """Balancing that ends when it has converged: (res, chrom, bin, v, residual, steps).

    x with all row sums of diag(x) M diag(x) equal to 1 is where the convex function x' M x / 2 -
    sum(log x) is least. Each step solves Newton's equation for log x by conjugate gradients, with
    the row sums as preconditioner; a product with M is one join and one grouped sum. Maps are
    solved side by side; one whose largest deviation from 1 is below ``tolerance`` stays as it is,
    and the rounds end when all are. ``residual`` is that deviation, per map, as it is in the end. Sparse
    rows, whose contacts are less than ``least_share`` of the mean row's, are left out: with them a map
    may have no balance at all. Factors are 1 / x.
    """
    place, per_map = ["res", "chrom", "i"], Window.partitionBy("res", "chrom")
    full = cut(mirrored(matrix))
    sums = full.groupBy(*place).agg(F.sum("n").cast("double").alias("t")).withColumn("mean", F.avg("t").over(per_map))
    dense, n_rows = cut_measuring(sums.where(F.col("t") >= least_share * F.col("mean")).select(*place), F.count("*"))
    full = cut(full.join(dense, place, "left_semi").join(dense.withColumnRenamed("i", "j"), ["res", "chrom", "j"], "left_semi"))
    totals = full.groupBy(*place).agg(F.sum("n").cast("double").alias("t"))
    small = n_rows <= BROADCAST_ROWS

    def times(df: DataFrame, y: Column, name: str) -> DataFrame:
        """``df`` (a written table) with the product of the map and the column ``y`` of it."""
        vector = df.select("res", "chrom", F.col("i").alias("j"), y.alias("_y"))
        sums = lookup_join(full, vector, ["res", "chrom", "j"], "inner", salt_from=["i"], small=small).groupBy(*place).agg(F.sum(F.col("n") * F.col("_y")).alias(name))
        return df.join(sums, place, "left").withColumn(name, F.coalesce(name, F.lit(0.0)))

    def dot(a: str, b: str) -> Column:
        return F.sum(F.col(a) * F.col(b)).over(per_map)

    x = cut(totals.select(*place, (1.0 / F.sqrt("t")).alias("x"), F.lit(0).alias("steps")))
    for done in range(steps + 1):
        at = times(x, F.col("x"), "m").withColumn("s", F.col("x") * F.col("m")).drop("m")
        at = at.withColumn("residual", F.max(F.abs(F.col("s") - 1)).over(per_map)).withColumn("open", F.col("residual") > tolerance)
        state = cut(at.withColumns({"r": F.when(F.col("open"), 1 - F.col("s")).otherwise(0.0), "d": F.lit(0.0)}).withColumn("z", F.col("r") / F.col("s"))
                    .withColumns({"p": F.col("z"), "rz": dot("r", "z")}))
        if done == steps or state.where("open").isEmpty():
            return state.select("res", "chrom", F.col("i").alias("bin"), (1.0 / F.col("x")).alias("v"), "residual", "steps")
        for _ in range(rounds):
            moved = times(state, F.col("x") * F.col("p"), "m").withColumn("q", F.col("s") * F.col("p") + F.col("x") * F.col("m")).drop("m")
            moved = moved.withColumn("a", F.coalesce(F.try_divide(F.col("rz"), dot("p", "q")), F.lit(0.0)))
            moved = moved.withColumns({"d": F.col("d") + F.col("a") * F.col("p"), "r": F.col("r") - F.col("a") * F.col("q")}).withColumn("z", F.col("r") / F.col("s"))
            moved = moved.withColumn("next", dot("r", "z")).withColumn("p", F.col("z") + F.coalesce(F.try_divide(F.col("next"), F.col("rz")), F.lit(0.0)) * F.col("p"))
            state = cut(moved.withColumn("rz", F.col("next")).drop("q", "a", "next"))
        # far from the solution a whole step may overshoot
        step = F.greatest(F.least("d", F.lit(1.0)), F.lit(-1.0))
        x = cut(state.select(*place, (F.col("x") * F.exp(step)).alias("x"), (F.col("steps") + F.col("open").cast("int")).alias("steps")))


def apply_norm(matrix: DataFrame, norm: DataFrame, rescale: bool = True, within: bool = True) -> DataFrame:
    """Add ``value`` = n / (v_i v_j) per pixel, scaled to the total of its chromosome pair.

    Bins without a factor give no value. ``norm`` holds one kind and is best a stored table.
    ``within`` keeps to pixels of one chromosome and names it ``chrom``; else each side takes
    the factor of its own chromosome.
    """
    pixels = intra(matrix) if within else matrix
    pair = ["chrom"] if within else ["c1", "c2"]
    v, weight = cut_measuring(norm.select("res", "chrom", "bin", "v"), F.count("*"))
    for i in (1, 2):
        chrom = "chrom" if within else f"c{i}"
        side = v.select("res", F.col("chrom").alias(chrom), F.col("bin").alias(f"b{i}"), F.col("v").alias(f"v{i}"))
        pixels = lookup_join(pixels, side, ["res", chrom, f"b{i}"], salt_from=["b1", "b2"], small=weight <= BROADCAST_ROWS)
    valued = pixels.withColumn("value", F.col("n") / F.nullif(F.col("v1") * F.col("v2"), F.lit(0.0))).drop("v1", "v2")
    if not rescale:
        return valued
    valued = cut(valued)
    diagonal = (F.col("b1") == F.col("b2")) & (F.lit(True) if within else F.col("c1") == F.col("c2"))
    weight = F.when(diagonal, 1).otherwise(2)
    scale = valued.where("value is not null").groupBy("res", *pair).agg(
        (F.sum(F.col("n") * weight) / F.sum(F.col("value") * weight)).alias("scale"))
    # a row per resolution and chromosome or pair of them
    scaled = lookup_join(valued, cut(scale), ["res", *pair], salt_from=["b1", "b2"])
    return scaled.withColumn("value", F.col("value") * F.col("scale")).drop("scale")


def expected(matrix: DataFrame, sizes: DataFrame, resolutions, value: str = "n") -> DataFrame:
    """Mean per diagonal over all possible bin pairs: (res, d, total, possible, expected).

    Possible pairs follow from chromosome lengths, so empty diagonals count too.
    """
    source = intra(matrix) if "c1" in matrix.columns else matrix
    totals = source.groupBy("res", (F.col("b2") - F.col("b1")).alias("d")).agg(F.sum(value).alias("total"))
    wanted = F.array(*[F.lit(r).cast("bigint") for r in resolutions])
    bins = sizes.withColumn("res", F.explode(wanted)).withColumn("nb", F.expr("length div res") + 1)
    possible = (bins.select("res", "nb", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("nb") - 1)).alias("d"))
                .groupBy("res", "d").agg(F.sum(F.col("nb") - F.col("d")).alias("possible")))
    return (possible.join(totals, ["res", "d"], "left")
            .select("res", "d", F.coalesce("total", F.lit(0)).alias("total"), "possible")
            .withColumn("expected", F.col("total") / F.col("possible")))


def observed_over_expected(matrix: DataFrame, exp: DataFrame, value: str = "n") -> DataFrame:
    source = intra(matrix) if "c1" in matrix.columns else matrix
    diagonal = source.withColumn("d", F.col("b2") - F.col("b1"))
    joined = lookup_join(diagonal, exp.select("res", "d", "expected"), ["res", "d"], salt_from=["b1"])
    return joined.withColumn("oe", F.col(value) / F.nullif("expected", F.lit(0.0))).drop("d", "expected")


PEARSON_BLOCK = 256
# columns of a block that are dense at a time
PEARSON_COLUMNS = 4096


def pearsons(oe: DataFrame, max_bins: int | None = None, block: int = PEARSON_BLOCK, rows: tuple[int, int] | None = None) -> DataFrame:
    """Correlation of every two rows of the O/E matrix: (res, chrom, i, j, r) with i <= j.

    Missing pixels are 0 and empty bins are left out. The answer has bins * bins entries;
    ``max_bins`` refuses a finer map than meant. ``rows`` asks for bins from the first up to, not
    including, the last against all others: fine maps are read by some rows at a time, and
    ``eigenvector`` needs no correlation at all. Rows are cut into blocks. Each pair of blocks
    is one task input: the pixels of two blocks, of which some columns are dense at a time.
    """
    cells = oe.where("oe is not null").select("res", "chrom", "b1", "b2", "oe")
    both = mirrored(cells.withColumns({"c1": F.col("chrom"), "c2": F.col("chrom")}).drop("chrom"), "oe")
    checked = both if max_bins is None else both.withColumn("i", F.when(F.col("i") < max_bins, F.col("i")).otherwise(
        F.raise_error(F.lit("resolution too fine for a correlation matrix")).cast("bigint")))
    active = checked.groupBy("res", "chrom").agg(F.count_distinct("i").alias("n_active"),
                                                 F.expr(f"max(i) div {block}").alias("last"))
    # one row per resolution and chromosome
    sized = lookup_join(checked, cut(active), ["res", "chrom"], salt_from=["i", "j"])
    mine = F.expr(f"i div {block}")
    sent = sized.select("res", "chrom", "n_active", "i", "j", "oe", mine.alias("mine"),
                        F.explode(F.sequence(F.lit(0).cast("bigint"), "last")).alias("other"))
    if rows is not None:
        wanted = (rows[0] // block, (rows[1] - 1) // block)
        sent = sent.where(F.col("mine").between(*wanted) | F.col("other").between(*wanted))
    keyed = sent.withColumns({"ba": F.least("mine", "other"), "bb": F.greatest("mine", "other")})

    def correlate(key: tuple, cells: pd.DataFrame) -> pd.DataFrame:
        res, chrom, ba, bb = key
        n = int(cells["n_active"].iloc[0])
        cols, place = np.unique(cells["j"].to_numpy(), return_inverse=True)
        ids, at = np.unique(cells["i"].to_numpy(), return_inverse=True)
        oe = cells["oe"].to_numpy()
        mean = np.bincount(at, oe, len(ids)) / n
        var = np.bincount(at, oe ** 2, len(ids)) / n - mean ** 2
        a, b = np.flatnonzero(ids // block == ba), np.flatnonzero(ids // block == bb)
        cov = -np.outer(mean[a], mean[b])
        for start in range(0, len(cols), PEARSON_COLUMNS):
            here = (place >= start) & (place < start + PEARSON_COLUMNS)
            dense = np.zeros((len(ids), min(PEARSON_COLUMNS, len(cols) - start)))
            dense[at[here], place[here] - start] = oe[here]
            cov += dense[a] @ dense[b].T / n
        with np.errstate(invalid="ignore", divide="ignore"):
            r = cov / np.sqrt(np.outer(var[a], var[b]))
        i, j = np.repeat(ids[a], len(b)), np.tile(ids[b], len(a))
        keep = i <= j
        return pd.DataFrame({"res": res, "chrom": chrom, "i": i[keep], "j": j[keep], "r": r.ravel()[keep]})

    found = keyed.drop("mine", "other").groupBy("res", "chrom", "ba", "bb").applyInPandas(
        correlate, "res bigint, chrom string, i bigint, j bigint, r double")
    if rows is not None:
        found = found.where(F.col("i").between(rows[0], rows[1] - 1) | F.col("j").between(rows[0], rows[1] - 1))
    return found.withColumn("r", F.nanvl("r", F.lit(None).cast("double")))


def eigenvector(oe: DataFrame, iters: int = 30, cut_every: int = 5) -> DataFrame:
    """First principal component per resolution and chromosome: (res, chrom, bin, v).

    ``oe`` has res, chrom, b1, b2 and oe. Power iteration on the correlation of its rows, which is
    never made: with m the means, s the deviations of the n rows that are not empty, a round takes
    x to (O (O' (x / s)) - n m m' (x / s)) / s, two sparse joins and sums whose size is that of the map.
    Rows without deviation have no component. The sign is a convention: the largest component is
    positive.
    """
    cells = oe.where("oe is not null").select("res", "chrom", "b1", "b2", "oe")
    full = cut(mirrored(cells.withColumns({"c1": F.col("chrom"), "c2": F.col("chrom")}).drop("chrom"), "oe"))
    per_chrom, place = Window.partitionBy("res", "chrom"), ["res", "chrom", "i"]
    sums = full.groupBy(*place).agg(F.sum("oe").alias("total"), F.sum(F.col("oe") * F.col("oe")).alias("squares"))
    sized = sums.withColumn("n", F.count("*").over(per_chrom)).withColumn("m", F.col("total") / F.col("n"))
    rows, n_rows = cut_measuring(sized.withColumn("s", F.sqrt(F.greatest(F.col("squares") / F.col("n") - F.col("m") * F.col("m"), F.lit(0.0)))).where("s > 0").select(*place, "m", "s"), F.count("*"))
    small = n_rows <= BROADCAST_ROWS

    def times(vector: DataFrame) -> DataFrame:
        """The map, which is symmetric, times a vector (res, chrom, i, y)."""
        weighted = lookup_join(full, vector.withColumnRenamed("i", "j"), ["res", "chrom", "j"], "inner", salt_from=["i"], small=small)
        return weighted.groupBy(*place).agg(F.sum(F.col("oe") * F.col("y")).alias("y"))

    def unit(df: DataFrame) -> DataFrame:
        return df.withColumn("v", F.col("v") / F.sqrt(F.sum(F.col("v") * F.col("v")).over(per_chrom)))

    x = unit(rows.select(*place, "m", "s", (1.0 + F.pmod(F.col("i") * 7, F.lit(11)) / 11.0).alias("v")))
    for done in range(1, iters + 1):
        seen = cut(times(x.select(*place, (F.col("v") / F.col("s")).alias("y"))))
        whole = seen.groupBy("res", "chrom").agg(F.sum("y").alias("z"))  # a row per resolution and chromosome
        moved = rows.join(times(seen), place).join(F.broadcast(whole), ["res", "chrom"])
        x = unit(moved.select(*place, "m", "s", ((F.col("y") - F.col("m") * F.col("z")) / F.col("s")).alias("v")))
        if done % cut_every == 0 and done < iters:
            x = cut(x)
    top = F.max_by("v", F.struct(F.round(F.abs("v"), 12), -F.col("i"))).over(per_chrom)
    return x.select("res", "chrom", F.col("i").alias("bin"), (F.col("v") * F.signum(top)).alias("v"))


def extract_region(matrix: DataFrame, res: int, region1: tuple[str, int, int], region2: tuple[str, int, int],
                   norm: DataFrame | None = None) -> DataFrame:
    """Pixels of a rectangle as (x, y, value): start positions of the two bins."""
    (ca, a0, a1), (cb, b0, b1) = sorted([region1, region2])
    inside = matrix.where((F.col("res") == res) & (F.col("c1") == ca) & (F.col("c2") == cb))

    def within(col: str, lo: int, hi: int) -> Column:
        return F.col(col).between(lo // res, hi // res)

    hit = within("b1", a0, a1) & within("b2", b0, b1)
    if ca == cb:
        hit = hit | (within("b2", a0, a1) & within("b1", b0, b1))
    part = inside.where(hit)
    if norm is not None:
        scaled = apply_norm(inside, norm, within=ca == cb)
        part = scaled.where(hit).withColumnRenamed("value", "_v")
    else:
        part = part.withColumn("_v", F.col("n").cast("double"))
    return part.select((F.col("b1") * res).alias("x"), (F.col("b2") * res).alias("y"), F.col("_v").alias("value"))
