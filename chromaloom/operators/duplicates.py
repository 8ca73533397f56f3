"""Near-duplicate removal.

Rule: within one contact block (chromosomes, fragments, strands), in position order, a
row is a duplicate when an earlier non-duplicate row lies within the wobble at both ends.
Duplicates never mark others.

The rule is solved without ever gathering a contact block. Rows at the same positions are
folded first, with map-side partial aggregation, because all but the first of them are
duplicates. The distinct positions then go to square tiles; a tile of side T holds at most
T * T of them however many reads there are. Tiles are solved independently with a third
state, *open*, for positions that wait for a neighbour tile. Open positions, if any, go
through further rounds together with what the last round settled next to them. The
earliest open position of each round is always settled, so the rounds end, and the result
does not depend on the tile size.

In a long chain of near positions every tile waits for the one before it. After a few rounds
the tiles of each round are therefore wider by a factor than those of the round before, and a tile
is walked by streaming its open positions; so the number of rounds grows with the logarithm of the
chain. No round sees positions that are settled, but for those next to an open one.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import flags, names
from .greedy import GROWTH, next_round, settle, spread
from .pairs import BLOCK
from .support import cut, cut_measuring

# a row of markers holds up to 36 reads
MARKER_ROWS = 25_000
# duplicates of a cell that are dealt over many tasks
HOT_CELL = 50_000

# a row of kept pairs holds a name, a block and two positions
KEPT_ROWS = 400_000

# fixed values: default wobble in bp and optical radius in pixels
WOBBLE = 4
OPTICAL_RADIUS = 50


# rounds with tiles of one size, whose points fit an array, before tiles widen
ROUNDS = 3


def _tile_side(wobble: int) -> int:
    return 32 * (wobble + 1)


def _solve_tile(wobble: int, rep_type: str, dims: int | None) -> Column:
    """Walk the ``points`` of one tile in order; returns its settled and open home points.

    ``kept`` and ``open`` hold the points still within reach of the walk, ``out`` the result.
    """
    if dims == 2:
        near = f"abs(y[0] - x.pos[0]) <= {wobble} and abs(y[1] - x.pos[1]) <= {wobble}"
    else:
        near = f"forall(zip_with(y, x.pos, (a, b) -> abs(a - b) <= {wobble}), ok -> ok)"

    def hits(seen: str) -> str:
        return f"exists(acc.{seen}, y -> {near})"

    def grown(seen: str, when: str) -> str:
        recent = f"filter(acc.{seen}, y -> y[0] >= x.pos[0] - {wobble})"
        return f"if(fate = '{when}', concat({recent}, array(x.pos)), acc.{seen})"

    out = f"array<struct<pos:array<bigint>,rep:{rep_type},known:boolean>>"
    return F.expr(f"""if(size(points) = 1, transform(points, x -> struct(x.pos as pos, x.rep as rep, true as known)),
      aggregate(points,
        struct(cast(array() as array<array<bigint>>) as kept, cast(array() as array<array<bigint>>) as open, cast(array() as {out}) as out),
        (acc, x) -> transform(
          array(case when x.known then 'keep' when {hits('kept')} then 'duplicate'
                     when x.home and not {hits('open')} then 'keep' else 'wait' end),
          fate -> struct(
            {grown('kept', 'keep')} as kept, {grown('open', 'wait')} as open,
            if(fate <> 'duplicate' and x.home and not x.known,
               concat(acc.out, array(struct(x.pos as pos, x.rep as rep, fate = 'keep' as known))), acc.out) as out))[0],
        acc -> acc.out))""")


def greedy_unique(points: DataFrame, key: list[str], wobble: int, side: int | None = None,
                  dims: int | None = None, rounds: int = ROUNDS) -> DataFrame:
    """Points that survive the rule; ``points`` has the key, ``pos`` (array) and ``rep``.

    Positions must be distinct within a key. ``dims`` is the length of ``pos`` when it is the
    same for all points. What is open after ``rounds`` rounds goes on in wider and wider tiles.
    """
    if wobble == 0:
        return points
    side = side or _tile_side(wobble)
    if side <= 2 * wobble:
        raise ValueError("tiles must be wider than twice the wobble")
    rep_type = points.schema["rep"].dataType.simpleString()
    tile, columns = ["t0", "t1"], [*key, "pos", "rep", "known"]
    solve = _solve_tile(wobble, rep_type, dims if dims == 2 else None)
    sent, found = spread(points.withColumn("known", F.lit(False)), columns, wobble, side), []
    for done in range(1, rounds + 1):
        home = F.col("n") == 0
        entry = F.struct("pos", "known", home.alias("home"), F.when(home, F.col("rep")).alias("rep"))
        tiles = (sent.groupBy(*key, *tile).agg(F.sort_array(F.collect_list(entry)).alias("points"))
                 .where(F.exists("points", lambda x: x["home"])))
        solved = tiles.select(*key, F.explode(solve).alias("x"))
        settled, left = cut_measuring(solved.select(*key, "x.*"), F.count_if(~F.col("known")))
        found.append(settled.where("known").drop("known"))
        if left == 0:
            return reduce(DataFrame.unionByName, found)
        wider = side if done < rounds else side * GROWTH
        sent = next_round(settled, key, columns, wobble, side, wider)
    found.append(settle(sent, key, wobble, wider, [F.col("pos")], by_position=True))
    return reduce(DataFrame.unionByName, found)


def _folded(pairs: DataFrame, key: list[str], carry: tuple[str, ...]) -> DataFrame:
    rep = F.struct("qname", *[c for c in carry if c != "qname"])
    # positions first: they tell rows apart sooner than the names of chromosomes when rows are sorted
    return (pairs.groupBy("p1", "p2", *key).agg(F.min(rep).alias("rep"))
            .select(*key, F.array("p1", "p2").alias("pos"), "rep"))


def unique_pairs(pairs: DataFrame, wobble: int = WOBBLE, exact: bool = False,
                 key: list[str] | None = None, carry: tuple[str, ...] = ()) -> DataFrame:
    """Deduplicated pairs with the key, positions, qname and the ``carry`` columns.

    The carried columns travel with the folded positions, so there is no join back to
    the input. ``qname`` identifies a pair; equal positions keep the lowest name.
    """
    key = key or BLOCK
    kept = greedy_unique(_folded(pairs, key, carry), key, 0 if exact else wobble, dims=2)
    return kept.select(*key, F.get("pos", F.lit(0)).alias("p1"), F.get("pos", F.lit(1)).alias("p2"), "rep.*")


def dedup(pairs: DataFrame, wobble: int = WOBBLE, exact: bool = False, optical: bool = False,
          key: list[str] | None = None) -> DataFrame:
    """All pairs with ``dup_class``: unique, pcr or optical."""
    key = key or BLOCK
    wobble = 0 if exact else wobble
    kept, rows = cut_measuring(unique_pairs(pairs, wobble, exact, key), F.count("*"))
    judged = _judged(pairs, kept, key, rows <= KEPT_ROWS)
    if optical:
        return _optical(cut(judged), kept, wobble, key)
    return judged.withColumn("dup_class", F.coalesce("dup_class", F.lit("pcr")))


def _judged(pairs: DataFrame, kept: DataFrame, key: list[str], small: bool) -> DataFrame:
    """Pairs with dup_class 'unique' or null; a position has one kept row.

    Few kept rows go to the pairs. Else both are dealt by name too, which spreads the rows of a hot position.
    """
    if small:
        first = kept.select(*key, "p1", "p2", F.col("qname").alias("_first"))
        joined = pairs.join(F.broadcast(first), [*key, "p1", "p2"], "left")
        return joined.select(*[F.col(c) for c in pairs.columns], F.when(F.col("qname") == F.col("_first"), "unique").alias("dup_class"))
    place = ["qname", *key, "p1", "p2"]
    return pairs.join(kept.select(*place, F.lit("unique").alias("dup_class")), place, "left").select(*pairs.columns, "dup_class")


def _optical(judged: DataFrame, kept: DataFrame, wobble: int, key: list[str]) -> DataFrame:
    """Split duplicates: optical when every row that marks them is its close neighbour on
    the flow cell.

    A square of side wobble + 1 holds at most one unique row, so the markers of the duplicates of a
    cell are among at most 36 rows, sent to the one to four cells within their reach and gathered
    per cell that has duplicates. The markers of a cell with very many duplicates go to those, so
    no such cell is gathered in one task; all other cells need one copy.
    """
    cell, site = 4 * (wobble + 1), [*key, "_a", "_b"]

    def cells(p: str) -> Column:
        return F.sequence(F.expr(f"(p{p} - {wobble}) div {cell}"), F.expr(f"(p{p} + {wobble}) div {cell}"))

    marked = judged.where("dup_class is null").withColumns({"_a": F.expr(f"p1 div {cell}"), "_b": F.expr(f"p2 div {cell}")})
    marker = F.struct("p1", "p2", "qname", names.illumina_tile(F.col("qname")).alias("tile"),
                      names.illumina_x(F.col("qname")).alias("x"), names.illumina_y(F.col("qname")).alias("y"))
    sent = kept.select(*key, marker.alias("m"), cells("2").alias("_bs"), F.explode(cells("1")).alias("_a")).select(*key, "m", "_a", F.explode("_bs").alias("_b"))
    near, n_near = cut_measuring(sent.join(marked.groupBy(*site).agg(F.count("*").alias("_n")), site).groupBy(*site)
                                 .agg(F.max("_n").alias("_n"), F.collect_list("m").alias("_markers")), F.count("*"))
    tile, x, y = (f(F.col("qname")) for f in (names.illumina_tile, names.illumina_x, names.illumina_y))
    marked = marked.withColumns({"_t": tile, "_x": x, "_y": y})
    if n_near <= MARKER_ROWS:
        placed = marked.join(F.broadcast(near.drop("_n")), site, "left")
    else:
        hot, others = (near.where(c).drop("_n") for c in (F.col("_n") > HOT_CELL, F.col("_n") <= HOT_CELL))
        placed = marked.join(F.broadcast(hot), site).unionByName(
            marked.join(F.broadcast(hot.select(*site)), site, "left_anti").join(others.hint("merge"), site, "left"))

    def marks(m: Column) -> Column:
        earlier = F.struct(m["p1"], m["p2"], m["qname"]) < F.struct("p1", "p2", "qname")
        return earlier & (F.abs(m["p1"] - F.col("p1")) <= wobble) & (F.abs(m["p2"] - F.col("p2")) <= wobble)

    def beside(m: Column) -> Column:
        together = ((m["tile"] == F.col("_t")) & (F.abs(m["x"] - F.col("_x")) < OPTICAL_RADIUS)
                    & (F.abs(m["y"] - F.col("_y")) < OPTICAL_RADIUS))
        return F.coalesce(together, F.lit(False))

    pcr = F.exists("_markers", lambda m: marks(m) & ~beside(m))
    duplicates = placed.withColumn("dup_class", F.when(pcr, "pcr").otherwise("optical"))
    return judged.where("dup_class is not null").unionByName(duplicates.select(*judged.columns))


def mark_duplicates(tagged: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Set the duplicate bit on every record of a duplicate read.

    Records without a contact (ambiguous or unmapped reads) pass by the join; a read that
    makes a contact has at most four records.
    """
    flagged = verdicts.where("dup_class <> 'unique'").select(F.col("qname").alias("_name"), F.lit(True).alias("_dup"))
    contact = F.col("rt").between(0, 5) | (F.col("rt") == 9)
    part = tagged.where(contact).withColumn("_name", names.read_base_name(F.col("qname")))
    marked = (part.join(flagged, "_name", "left")
              .withColumn("flag", F.when(F.col("_dup"), flags.set_flag(F.col("flag"), flags.DUPLICATE)).otherwise(F.col("flag")))
              .select(*tagged.columns))
    return marked.unionByName(tagged.where(~F.coalesce(contact, F.lit(False))))


def count_duplicates(alignments: DataFrame, single_end: bool = False) -> DataFrame:
    """Primary duplicate records of first ends; single-end also counts singletons apart."""
    flag = F.col("flag")
    if single_end:
        primary = flags.has_flag(flag, flags.DUPLICATE) & flags.lacks_flag(flag, flags.SECONDARY)
        solo = F.coalesce(F.col("rt") == 7, F.lit(False))
        return alignments.agg(F.count_if(primary & ~solo).alias("dups"), F.count_if(primary & solo).alias("singdups"))
    first = flags.PAIRED | flags.FIRST | flags.DUPLICATE
    hit = flags.has_flag(flag, first) & flags.lacks_flag(flag, flags.SECONDARY)
    return alignments.agg(F.count_if(hit).alias("dups"))


def duplicate_report(classified: DataFrame) -> DataFrame:
    """Counts and shares of unique, PCR and optical pairs with the library size."""
    from .statistics import library_complexity
    counts = classified.agg(
        F.count("*").alias("total"),
        *[F.count_if(F.col("dup_class") == c).alias(c) for c in ("unique", "pcr", "optical")])
    shares = {f"{c}_pct": F.round(F.col(c) * 100.0 / F.greatest("total", F.lit(1)), 2) for c in ("unique", "pcr", "optical")}
    return counts.withColumns(shares).withColumn(
        "complexity", library_complexity(F.col("unique"), F.col("unique") + F.col("pcr")))


def conservation(before: DataFrame, classified: DataFrame) -> DataFrame:
    """Row counts in, kept and removed, and whether they agree."""
    total = before.agg(F.count("*").alias("sorted_rows"))
    parts = classified.agg(F.count_if(F.col("dup_class") == "unique").alias("unique_rows"),
                           F.count_if(F.col("dup_class") != "unique").alias("dup_rows"))
    # two one-row aggregates side by side
    return total.withColumn("one", F.lit(1)).join(parts.withColumn("one", F.lit(1)), "one").drop("one").withColumn(
        "conserved", F.col("sorted_rows") == F.col("unique_rows") + F.col("dup_rows"))
