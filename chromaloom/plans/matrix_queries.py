"""Queries over contact matrices and their features."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import features, fragments, matrix, pairs, tracks
from ..operators.domains import domains as find_domains
from ..operators.support import cut
from . import flow
from .inputs import derive
from .registry import query

RESOLUTIONS = (2_500_000, 1_000_000, 500_000, 250_000, 100_000)

_PIX = """
select {res} as res, c1, c2, case when c1 = c2 and p1 > p2 then p2 // {res} else p1 // {res} end as b1,
 case when c1 = c2 and p1 > p2 then p1 // {res} else p2 // {res} end as b2, count(*) as n from @uniq where q1 >= 1 and q2 >= 1 group by all"""


def _pixels(*res: int) -> str:
    return " union all ".join(_PIX.format(res=r) for r in res)


_TYPED = "cast(res as bigint) as res, c1, c2, cast(b1 as bigint) as b1, cast(b2 as bigint) as b2, n"


def _matrix(spark, d, resolutions=RESOLUTIONS):
    sizes = fragments.chrom_sizes(flow.sites(spark, d))
    return matrix.contact_matrix(flow.unique_contacts(spark, d), resolutions, 1, sizes)


@query("contact_matrix", f"select {_TYPED} from ({_pixels(*RESOLUTIONS)}) x")
def contact_matrix(spark, d):
    return _matrix(spark, d)


def _frag(f: int) -> str:
    return f"""select {f} as res, c1, c2, case when c1 = c2 then least(f1 // {f}, f2 // {f}) else f1 // {f} end as b1,
 case when c1 = c2 then greatest(f1 // {f}, f2 // {f}) else f2 // {f} end as b2, count(*) as n from @uniq group by all"""


@query("fragment_matrix", f"select {_TYPED} from ({' union all '.join(_frag(f) for f in (500, 100, 20, 5))}) x")
def fragment_matrix(spark, d):
    return matrix.fragment_matrix(flow.unique_contacts(spark, d), (500, 100, 20, 5))


def _mirror(res: int) -> str:
    return f"""
px as (select * from ({_pixels(res)}) x where c1 = c2),
full_ as (select c1 as chrom, b1 as i, b2 as j, n from px union all select c1, b2, b1, n from px where b1 <> b2),
rs as (select chrom, i, cast(sum(n) as double) as total from full_ group by all)
"""


def _diagonals(res: int, source: str = "px", value: str = "n") -> str:
    return f"""
tot as (select b2 - b1 as d, sum({value}) as total from {source} group by 1),
poss as (select d, sum(nb - d) as possible from (select nb, unnest(range(0, nb)) as d from (select max(pos) // {res} + 1 as nb from @sites group by chrom)) group by d),
ex as (select p.d, coalesce(total, 0) as total, possible, coalesce(total, 0) / cast(possible as double) as expected from poss p left join tot t on t.d = p.d)
"""


_MIRROR = _mirror(100_000)
_EXPECTED = _diagonals(100_000)

_SCALED = """
raw as (select p.c1 as chrom, p.b1, p.b2, p.n, p.n / sqrt(a.total * b.total) as value, case when b1 = b2 then 1 else 2 end as w from px p
 join rs a on a.chrom = p.c1 and a.i = p.b1 join rs b on b.chrom = p.c1 and b.i = p.b2),
factor as (select chrom, sum(n * w) / sum(value * w) as scale from raw group by chrom),
vals as (select chrom, b1, b2, n, value * scale as value from raw join factor using (chrom))
"""

_CORRELATED = """oe as (select c1 as chrom, b1, b2, n / expected as v from px join ex on ex.d = b2 - b1),
f as (select chrom, b1 as i, b2 as j, v from oe union all select chrom, b2, b1, v from oe where b1 <> b2),
rows_ as (select chrom, i, sum(v) as s, sum(v * v) as ss from f group by all), k as (select chrom, count(*) as n from rows_ group by chrom),
dots as (select a.chrom, a.i, b.i as j, sum(a.v * b.v) as dot from f a join f b on a.chrom = b.chrom and a.j = b.j and a.i <= b.i group by all),
corr as (select x.chrom, x.i, y.i as j,
 (coalesce(dot, 0) / n - x.s / n * y.s / n) / nullif(sqrt((x.ss / n - x.s / n * x.s / n) * (y.ss / n - y.s / n * y.s / n)), 0) as r
from rows_ x join rows_ y on x.chrom = y.chrom and x.i <= y.i join k on k.chrom = x.chrom left join dots t on t.chrom = x.chrom and t.i = x.i and t.j = y.i)
"""


def _rounds(n: int, first: str, step: str) -> str:
    """``n`` rounds of an iteration as a chain of blocks x0, x1, ..."""
    blocks = [f"x0 as materialized ({first})"]
    blocks += [f"x{i} as materialized ({step.format(x=f'x{i - 1}')})" for i in range(1, n + 1)]
    return ",\n".join(blocks)


@query("norm_vectors", f"""
with {_MIRROR} select chrom, kind, cast(i as bigint) as bin, round(case kind when 'VC' then total else sqrt(total) end, 6) as v
from rs, (values ('VC'), ('VC_SQRT')) k(kind)""")
def norm_vectors(spark, d):
    m = cut(_matrix(spark, d, (100_000,)))
    vectors = matrix.norm_vectors(m, "VC").unionByName(matrix.norm_vectors(m, "VC_SQRT"))
    return vectors.select("chrom", "kind", "bin", F.round("v", 6).alias("v"))


@query("normalised_matrix", f"""
with {_MIRROR}, {_SCALED} select chrom, cast(b1 as bigint) as b1, cast(b2 as bigint) as b2, n, round(value, 6) as value from vals""")
def normalised_matrix(spark, d):
    m = cut(_matrix(spark, d, (100_000,)))
    scaled = matrix.apply_norm(m, cut(matrix.norm_vectors(m, "VC_SQRT")))
    return scaled.select("chrom", "b1", "b2", "n", F.round("value", 6).alias("value"))


_BALANCE = _rounds(10, "select chrom, i, 1 / sqrt(total) as x from rs",
                   "select v.chrom, v.i, v.x / sqrt(v.x * s.s) as x from {x} v join (select f.chrom, f.i, sum(f.n * w.x) as s from full_ f"
                   " join {x} w on w.chrom = f.chrom and w.i = f.j group by all) s on s.chrom = v.chrom and s.i = v.i")


@query("balanced_vectors", f"with {_mirror(250_000)}, {_BALANCE} select chrom, cast(i as bigint) as bin, round(1 / x, 6) as v from x10")
def balanced_vectors(spark, d):
    m = cut(_matrix(spark, d, (250_000,)))
    return matrix.norm_vectors(m, "BALANCE", iters=10).select("chrom", "bin", F.round("v", 6).alias("v"))


_EXPECTED = """
tot as (select b2 - b1 as d, sum(n) as total from px group by 1),
poss as (select d, sum(nb - d) as possible from (select nb, unnest(range(0, nb)) as d from (select max(pos) // 100000 + 1 as nb from @sites group by chrom)) group by d),
ex as (select p.d, coalesce(total, 0) as total, possible, coalesce(total, 0) / cast(possible as double) as expected from poss p left join tot t on t.d = p.d)
"""


# without sparse rows, plain rounds until nothing moves any more
_CONVERGED = _rounds(60, "select chrom, i, 1 / sqrt(sum(n)) as x from fl group by all",
                     "select v.chrom, v.i, v.x / sqrt(v.x * s.s) as x from {x} v join (select f.chrom, f.i, sum(f.n * w.x) as s from fl f"
                     " join {x} w on w.chrom = f.chrom and w.i = f.j group by all) s on s.chrom = v.chrom and s.i = v.i")


@query("converged_balance", f"""
with {_mirror(500_000)}, kept as (select chrom, i from rs qualify total >= 0.1 * avg(total) over (partition by chrom)),
fl as materialized (select f.* from full_ f join kept a on a.chrom = f.chrom and a.i = f.i join kept b on b.chrom = f.chrom and b.i = f.j), {_CONVERGED}
select chrom, cast(i as bigint) as bin, round(1 / x, 3) as v, true as converged from x60""")
def converged_balance(spark, d):
    """Balancing that ends by its residual."""
    found = matrix.balanced(cut(_matrix(spark, d, (500_000,))), tolerance=1e-9)
    return found.select("chrom", "bin", F.round("v", 3).alias("v"), (F.col("residual") < 1e-9).alias("converged"))


@query("expected_by_distance", f"""
with {_MIRROR}, {_EXPECTED} select cast(d as bigint) as d, cast(total as bigint) as total, cast(possible as bigint) as possible, round(expected, 6) as expected from ex""")
def expected_by_distance(spark, d):
    sizes = fragments.chrom_sizes(flow.sites(spark, d))
    exp = matrix.expected(_matrix(spark, d, (100_000,)), sizes, (100_000,))
    return exp.select("d", "total", "possible", F.round("expected", 6).alias("expected"))


@query("observed_over_expected", f"""
with {_MIRROR}, {_EXPECTED} select c1 as chrom, cast(b1 as bigint) as b1, cast(b2 as bigint) as b2, round(n / expected, 6) as oe from px join ex on ex.d = b2 - b1""")
def observed_over_expected(spark, d):
    sizes = fragments.chrom_sizes(flow.sites(spark, d))
    m = cut(_matrix(spark, d, (100_000,)))
    oe = matrix.observed_over_expected(m, cut(matrix.expected(m, sizes, (100_000,))))
    return oe.select("chrom", "b1", "b2", F.round("oe", 6).alias("oe"))


@query("pearson_correlation", f"""
with {_MIRROR}, {_EXPECTED}, {_CORRELATED} select chrom, cast(i as bigint) as i, cast(j as bigint) as j, round(r, 6) as r from corr""")
def pearson_correlation(spark, d):
    sizes = fragments.chrom_sizes(flow.sites(spark, d))
    m = cut(_matrix(spark, d, (100_000,)))
    oe = matrix.observed_over_expected(m, cut(matrix.expected(m, sizes, (100_000,))))
    return matrix.pearsons(oe, block=16).select("chrom", "i", "j", F.round("r", 6).alias("r"))


@query("correlation_of_rows", f"""
with {_MIRROR}, {_EXPECTED}, {_CORRELATED} select chrom, cast(i as bigint) as i, cast(j as bigint) as j, round(r, 6) as r from corr where i between 10 and 19 or j between 10 and 19""")
def correlation_of_rows(spark, d):
    """Some rows of the correlation against all others."""
    sizes = fragments.chrom_sizes(flow.sites(spark, d))
    m = cut(_matrix(spark, d, (100_000,)))
    oe = matrix.observed_over_expected(m, cut(matrix.expected(m, sizes, (100_000,))))
    return matrix.pearsons(oe, block=8, rows=(10, 20)).select("chrom", "i", "j", F.round("r", 6).alias("r"))


_UNIT = "select chrom, i, v / sqrt(sum(v * v) over (partition by chrom)) as v from ({}) u"
_POWER = _rounds(10, _UNIT.format("select distinct chrom, i, 1.0::double + ((i * 7) % 11) / 11.0::double as v from sym"),
                 _UNIT.format("select s.chrom, s.i, sum(s.r * w.v) as v from sym s join {x} w on w.chrom = s.chrom and w.i = s.j group by all"))


@query("compartment_eigenvector", f"""
with {_mirror(250_000)}, {_diagonals(250_000)}, {_CORRELATED}, sym as (select chrom, i, j, r from corr where r is not null
 union all select chrom, j, i, r from corr where r is not null and i <> j), {_POWER},
top as (select chrom, arg_max(v, {{'m': round(abs(v), 12), 'o': -i}}) as t from x10 group by chrom)
select x.chrom, cast(i as bigint) as bin, round(v * sign(t), 6) as v from x10 x join top using (chrom)""")
def compartment_eigenvector(spark, d):
    sizes = fragments.chrom_sizes(flow.sites(spark, d))
    m = cut(_matrix(spark, d, (250_000,)))
    oe = matrix.observed_over_expected(m, cut(matrix.expected(m, sizes, (250_000,))))
    return matrix.eigenvector(oe, iters=10).select("chrom", "bin", F.round("v", 6).alias("v"))


@query("extract_region", f"""
with {_MIRROR} select cast(b1 * 100000 as bigint) as x, cast(b2 * 100000 as bigint) as y, cast(n as double) as value from px
 where c1 = 'chr1' and ((b1 between 5 and 20 and b2 between 10 and 40) or (b2 between 5 and 20 and b1 between 10 and 40))""")
def extract_region(spark, d):
    m = _matrix(spark, d, (100_000,))
    return matrix.extract_region(m, 100_000, ("chr1", 500_000, 2_000_000), ("chr1", 1_000_000, 4_000_000))


@query("homolog_matrices", """
with c as (select homolog as c1, min(ip) as p1, max(ip) as p2 from @linked l join @phased_reads p on l.qname = p.qname and l.rname = p.rname
 where rt between 0 and 5 and rnext in ('=', '*') group by l.qname, homolog having count(*) = 2)
select cast(100000 as bigint) as res, right(c1, 1) as homolog, left(c1, -2) as c1, cast(p1 // 100000 as bigint) as b1, cast(p2 // 100000 as bigint) as b2, count(*) as n from c group by all""")
def homolog_matrices(spark, d):
    records = cut(flow.linked(spark, d))
    contacts = tracks.assign_homologs(records, flow.homologs(records))
    return matrix.homolog_matrices(contacts, (100_000,), separate=True).select("res", "homolog", "c1", "b1", "b2", "n")


# loops of the fixture: pairs of loci that many supplier and part keys share
def _loops(spark, d):
    raw = pairs.canonical_pair(derive(spark, d, "raw_pairs")).where("c1 = c2 and q1 % 12 = 0")
    start = {i: F.expr(f"p{i} div 100000 * 100000") for i in (1, 2)}
    lo, hi = F.least(start[1], start[2]), F.greatest(start[1], start[2])
    return raw.select("c1", lo.alias("x1"), (lo + 100_000).alias("x2"), "c2", hi.alias("y1"), (hi + 100_000).alias("y2")).distinct()


_LOOPS = """
lp as (select distinct c1, least(p1 // 100000, p2 // 100000) as cx, greatest(p1 // 100000, p2 // 100000) as cy from @canon where c1 = c2 and q1 % 12 = 0)
"""


@query("aggregate_peaks", f"""
with {_MIRROR}, {_LOOPS} select cast(b1 - cx as bigint) as dx, cast(b2 - cy as bigint) as dy, cast(sum(n) as bigint) as total from px p join lp on lp.c1 = p.c1
 and abs(b1 - cx) <= 3 and abs(b2 - cy) <= 3 where cy - cx >= 8 group by all""")
def aggregate_peaks(spark, d):
    return features.apa(_matrix(spark, d, (100_000,)), _loops(spark, d), 100_000, window=3, min_dist=8)


@query("aggregate_peak_scores", f"""
with {_MIRROR}, {_LOOPS}, s as (select b1 - cx as dx, b2 - cy as dy, sum(n) as total from px p join lp on lp.c1 = p.c1
 and abs(b1 - cx) <= 3 and abs(b2 - cy) <= 3 where cy - cx >= 8 group by all),
a as (select sum(case when dx = 0 and dy = 0 then total else 0 end) as centre, sum(total) as every, sum(case when dx <= -2 and dy <= -2 then total else 0 end) / 4.0 as ul,
 sum(case when dx <= -2 and dy >= 2 then total else 0 end) / 4.0 as ur, sum(case when dx >= 2 and dy <= -2 then total else 0 end) / 4.0 as ll,
 sum(case when dx >= 2 and dy >= 2 then total else 0 end) / 4.0 as lr from s)
select cast(centre as bigint) as centre, round(centre / ((every - centre) / 48.0), 6) as p2m, round(centre / nullif(ul, 0), 6) as p2ul, round(centre / nullif(ur, 0), 6) as p2ur,
 round(centre / nullif(ll, 0), 6) as p2ll, round(centre / nullif(lr, 0), 6) as p2lr from a""")
def aggregate_peak_scores(spark, d):
    summed = features.apa(_matrix(spark, d, (100_000,)), _loops(spark, d), 100_000, window=3, min_dist=8)
    scores = features.apa_scores(summed, window=3, corner=2)
    return scores.select("centre", *[F.round(c, 6).alias(c) for c in ("p2m", "p2ul", "p2ur", "p2ll", "p2lr")])


def _values(spark, d, res):
    sizes = fragments.chrom_sizes(flow.sites(spark, d))
    m = cut(_matrix(spark, d, (res,)))
    scaled = cut(matrix.apply_norm(m, cut(matrix.norm_vectors(m, "VC_SQRT"))))
    exp = cut(matrix.expected(scaled, sizes, (res,), "value"))
    return scaled.where(F.col("res") == res), exp.where(F.col("res") == res), sizes


def _around(res: int) -> str:
    """Cells around every pixel with the regions they belong to."""
    return f"""
{_mirror(res)}, {_SCALED}, {_diagonals(res, "vals", "value")}, nb as (select chrom, max(pos) // {res} + 1 as nb from @sites group by chrom),
off as (select a.v as di, b.v as dj, a.v <> 0 and b.v <> 0 and greatest(abs(a.v), abs(b.v)) > 1 as donut, a.v >= 1 and b.v <= -1 and (a.v > 1 or b.v < -1) as lower_left,
 abs(a.v) <= 1 and abs(b.v) > 1 as horizontal, abs(b.v) <= 1 and abs(a.v) > 1 as vertical from (select unnest(range(-3, 4)) as v) a, (select unnest(range(-3, 4)) as v) b),
cells as (select v.chrom, v.b1, v.b2, v.n, v.value, o.*, coalesce(m.value, 0) as m, e.expected as e from vals v join nb using (chrom) cross join off o
 left join vals m on m.chrom = v.chrom and m.b1 = v.b1 + o.di and m.b2 = v.b2 + o.dj join ex e on e.d = v.b2 + o.dj - v.b1 - o.di
 where v.b2 < nb.nb and v.b1 + o.di >= 0 and v.b2 + o.dj < nb.nb and v.b2 + o.dj >= v.b1 + o.di)
"""


def _region(name: str) -> str:
    return (f"sum(case when {name} then m end) / nullif(sum(case when {name} then c.e end), 0)"
            " * any_value(x.expected) * any_value(c.n / c.value)")


@query("loop_surroundings", f"""
with {_around(25_000)}
select c.chrom, cast(b1 as bigint) as b1, cast(b2 as bigint) as b2, c.n, {", ".join(
    f"round({_region(r)}, 4) as {r}"
    for r in features.REGIONS)} from cells c join ex x on x.d = c.b2 - c.b1 group by c.chrom, b1, b2, c.n""")
def loop_surroundings(spark, d):
    values, exp, sizes = _values(spark, d, 25_000)
    found = features.local_expected(values, exp, sizes, 25_000, 1, 3, tile=32)
    return found.select("chrom", "b1", "b2", "n", *[F.round(r, 4).alias(r) for r in features.REGIONS])


_CHUNK = "cast(greatest(ceil(log2(greatest({}, 1e-9)) * 3), 0) as int)"


def _tops(res: int) -> str:
    """Enriched pixels (pk) and their greedy choice (walk where not near) with neighbours one bin away."""
    return f"""
with recursive {_around(res)}, le as (select c.chrom, b1, b2, c.n, {", ".join(f"{_region(r)} as {r}" for r in features.REGIONS)}
 from cells c join ex x on x.d = c.b2 - c.b1 group by c.chrom, b1, b2, c.n),
ok as (select * from le where {" and ".join(f"{r} is not null" for r in features.REGIONS)}),
tally as ({" union all ".join(f"select '{r}' as region, {_CHUNK.format(r)} as chunk, n, count(*) as pixels from ok group by all" for r in features.REGIONS)}),
ab as (select *, sum(pixels) over (partition by region, chunk order by n desc) as above, sum(pixels) over (partition by region, chunk) as total from tally),
lim as (select region, chunk, min(n) as least from ab where total * greatest(least(1 - coalesce(list_sum(list_transform(range(0, n),
 lambda k: exp(-pow(2, chunk / 3.0) + k * ln(pow(2, chunk / 3.0)) - lgamma(k + 1)))), 0), 1), 0) / above <= {features.FDR} group by all),
pk as (select ok.* from ok {" ".join(f"join lim l{i} on l{i}.region = '{r}' and l{i}.chunk = {_CHUNK.format(r)} and ok.n >= l{i}.least" for i, r in enumerate(features.REGIONS))}
 where ok.n >= {features.FOLD_NEAR} * donut and ok.n >= {features.FOLD_NEAR} * lower_left and ok.n >= {features.FOLD_LINE} * horizontal
 and ok.n >= {features.FOLD_LINE} * vertical and ok.n >= {features.FOLD_ANY} * least(donut, lower_left)),
od as (select *, row_number() over (partition by chrom order by n desc, b1, b2) as rn from pk),
walk as (select chrom, rn, b1, b2, n, [{{'a': b1, 'b': b2}}] as kept, false as near from od where rn = 1
 union all
 select o.chrom, o.rn, o.b1, o.b2, o.n, case when len(list_filter(w.kept, lambda x: abs(x.a - o.b1) <= 1 and abs(x.b - o.b2) <= 1)) > 0 then w.kept
 else list_append(w.kept, {{'a': o.b1, 'b': o.b2}}) end, len(list_filter(w.kept, lambda x: abs(x.a - o.b1) <= 1 and abs(x.b - o.b2) <= 1)) > 0
 from walk w join od o on o.chrom = w.chrom and o.rn = w.rn + 1)
"""


@query("loop_pixels", _tops(25_000) + "select chrom as c1, cast(b1 * 25000 as bigint) as x1, cast(b2 * 25000 as bigint) as y1, n from walk where not near")
def loop_pixels(spark, d):
    """Strongest pixel of every loop."""
    values, exp, sizes = _values(spark, d, 25_000)
    return features.loops(values, exp, sizes, 25_000).select("c1", "x1", "y1", "n")


@query("loops", _tops(25_000) + """,
ow as (select p.chrom, p.b1, p.b2, arg_max({'a': t.b1, 'b': t.b2}, {'n': t.n, 'a': -t.b1, 'b': -t.b2}) as t from pk p
 join walk t on not t.near and t.chrom = p.chrom and abs(t.b1 - p.b1) <= 1 and abs(t.b2 - p.b2) <= 1 group by all)
select w.chrom as c1, cast(w.b1 * 25000 as bigint) as x1, cast(w.b1 * 25000 + 25000 as bigint) as x2, w.chrom as c2, cast(w.b2 * 25000 as bigint) as y1, cast(w.b2 * 25000 + 25000 as bigint) as y2,
 w.n, count(*) as members from ow join walk w on not w.near and w.chrom = ow.chrom and w.b1 = t.a and w.b2 = t.b group by all""")
def loops(spark, d):
    """Loops with the pixels whose strongest near top they are."""
    values, exp, sizes = _values(spark, d, 25_000)
    return features.loops(values, exp, sizes, 25_000)


# loop lists of three resolutions made one; limits that leave some loops of each kind
LOOP_RESOLUTIONS, _NEAR, _STRONG = (25_000, 50_000, 100_000), 500_000, 12


def _close(a: str, b: str, res: int) -> str:
    return f"{a}.chrom = {b}.chrom and abs({a}.x + {a}.res // 2 - {b}.x - {b}.res // 2) <= {2 * res} and abs({a}.y + {a}.res // 2 - {b}.y - {b}.res // 2) <= {2 * res}"


_FINE, _MIDDLE, _COARSE = LOOP_RESOLUTIONS
_LISTS = ", ".join(f"l{k} as materialized ({_tops(res)} select chrom, b1 * {res} as x, b2 * {res} as y, n, {res} as res from walk where not near)" for k, res in enumerate(LOOP_RESOLUTIONS))
_MERGED = f"""{_LISTS},
m1 as (select a.* from l0 a where exists (select 1 from l1 b where {_close("a", "b", _MIDDLE)}) or a.y - a.x < {_NEAR} or a.n > {_STRONG}
 union all select b.* from l1 b where not exists (select 1 from l0 a where {_close("a", "b", _MIDDLE)})),
ml as materialized (select * from m1 union all select b.* from l2 b where not exists (select 1 from m1 a where {_close("a", "b", _COARSE)}))
"""


def _merged_loops(spark, d):
    lists = {}
    for res in LOOP_RESOLUTIONS:
        values, exp, sizes = _values(spark, d, res)
        lists[res] = features.loops(values, exp, sizes, res, 1, 3)
    return features.merged_loops(lists, _NEAR, _STRONG)


@query("merged_loops", f"with {_MERGED} select chrom as c1, cast(x as bigint) as x1, cast(y as bigint) as y1, n, cast(res as bigint) as res from ml")
def merged_loops(spark, d):
    """Loops of three resolutions as one list."""
    return _merged_loops(spark, d).select("c1", "x1", "y1", "n", "res")


@query("merged_loop_peaks", f"""
with {_mirror(100_000)}, {_MERGED}, lp as (select chrom as c1, (2 * x + res) // 2 // 100000 as cx, (2 * y + res) // 2 // 100000 as cy from ml)
select cast(b1 - cx as bigint) as dx, cast(b2 - cy as bigint) as dy, cast(sum(n) as bigint) as total from px p join lp on lp.c1 = p.c1
 and abs(b1 - cx) <= 3 and abs(b2 - cy) <= 3 where cy - cx >= 4 group by all""")
def merged_loop_peaks(spark, d):
    """Pixels around the loops of the merged list added up."""
    return features.apa(_matrix(spark, d, (100_000,)), _merged_loops(spark, d), 100_000, window=3, min_dist=4)


@query("domains", f"""
with recursive {_MIRROR}, {_SCALED}, nb as (select chrom, max(b2) + 1 as nb from vals where value is not null group by 1),
m as (select chrom, b1 as i, b2 as j, value from vals union all select chrom, b2, b1, value from vals where b1 <> b2),
starts as (select chrom, nb, unnest(range(0, nb)) as r from nb),
pref as (select x.chrom, x.r, x.r + d as j, (coalesce(u.value, 0) - coalesce(w.value, 0)) / (coalesce(u.value, 0) + coalesce(w.value, 0)) as p
 from (select chrom, r, unnest(range(1, nb)) as d from starts) x left join m u on u.chrom = x.chrom and u.i = x.r - d and u.j = x.r left join m w on w.chrom = x.chrom and w.i = x.r and w.j = x.r + d
 where coalesce(u.value, 0) + coalesce(w.value, 0) > 0),
dom as (select chrom, r as a, r + s as b, (r + r + s) // 2 as mid, (s // 2 + 1) * (s - s // 2) as cells from (select *, unnest(range(4, nb)) as s from starts) where r + s < nb),
sc as (select q.chrom, a, b, round(sum(case when r > mid then p + sign(p) else - p - sign(p) end) / (4 * any_value(cells)), 9) as score
 from dom q join pref f on f.chrom = q.chrom and r between a and b and (r <= mid and j between 2 * r - a + 1 and b or r > mid and j between b + 1 and 2 * r - a) group by all),
od as (select *, row_number() over (partition by chrom order by score desc, a, b) as rn from sc where score >= 0.3),
walk as (select chrom, rn, a, b, score, [{{'a': a, 'b': b}}] as kept, false as near from od where rn = 1
 union all
 select o.chrom, o.rn, o.a, o.b, o.score, case when len(list_filter(w.kept, lambda x: abs(x.a - o.a) <= 4 and abs(x.b - o.b) <= 4)) > 0 then w.kept else list_append(w.kept, {{'a': o.a, 'b': o.b}}) end,
 len(list_filter(w.kept, lambda x: abs(x.a - o.a) <= 4 and abs(x.b - o.b) <= 4)) > 0 from walk w join od o on o.chrom = w.chrom and o.rn = w.rn + 1)
select chrom, cast(a * 100000 as bigint) as start, cast((b + 1) * 100000 as bigint) as "end", round(score, 6) as score from walk where not near""")
def domains(spark, d):
    values, _, _ = _values(spark, d, 100_000)
    return find_domains(values, 100_000, min_score=0.3, tile=16).withColumn("score", F.round("score", 6))


_MOTIF_INPUT = """
pk as (select distinct c1 as chrom, p1 // 1000 * 1000 as "start", p1 // 1000 * 1000 + 1000 as "end" from @canon where q2 % 3 = 0),
mt as (select distinct c1 as chrom, p1 as "start", p1 + 20 as "end", case when s1 = 0 then '+' else '-' end as strand from @canon where q1 % 5 = 0),
an as (select distinct 1 as side, c1 as chrom, cx * 100000 as "start", cx * 100000 + 100000 as "end" from lp union select 2, c1, cy * 100000, cy * 100000 + 100000 from lp)
"""


def _motif_twin(loops_: str, x1: str, x2: str, y1: str, y2: str) -> str:
    """Motifs of the anchors of a table of loops with the given ends."""
    return f"""
pk as (select distinct c1 as chrom, p1 // 1000 * 1000 as "start", p1 // 1000 * 1000 + 1000 as "end" from @canon where q2 % 3 = 0),
mt as (select distinct c1 as chrom, p1 as "start", p1 + 20 as "end", case when s1 = 0 then '+' else '-' end as strand from @canon where q1 % 5 = 0),
an as (select distinct 1 as side, chrom, {x1} as "start", {x2} as "end" from {loops_} union select 2, chrom, {y1}, {y2} from {loops_})
"""


_ONE_MOTIF = """bm as (select distinct m.* from mt m join pk p on m.chrom = p.chrom and m."start" < p."end" and m."end" > p."start"),
one as (select a.side, a.chrom, a."start", a."end", min(b."start") as ms, min(b."end") as me, min(b.strand) as strand from an a join bm b on a.chrom = b.chrom and b."start" < a."end" and b."end" > a."start"
 group by all having count(*) = 1)
select chrom, cast("start" as bigint) as "start", cast("end" as bigint) as "end", side, cast(ms as bigint) as motif_start, cast(me as bigint) as motif_end, strand,
 strand = (case when side = 1 then '+' else '-' end) as convergent from one"""


@query("merged_loop_motifs", f"with {_MERGED}, {_motif_twin('ml', 'x', 'x + res', 'y', 'y + res')}, {_ONE_MOTIF}")
def merged_loop_motifs(spark, d):
    """Motifs of the anchors of the merged list."""
    canonical = pairs.canonical_pair(derive(spark, d, "raw_pairs"))
    start = F.expr("p1 div 1000 * 1000")
    peaks = canonical.where("q2 % 3 = 0").select(F.col("c1").alias("chrom"), start.alias("start"), (start + 1000).alias("end")).distinct()
    motifs = canonical.where("q1 % 5 = 0").select(
        F.col("c1").alias("chrom"), F.col("p1").alias("start"), (F.col("p1") + 20).alias("end"),
        F.when(F.col("s1") == 0, "+").otherwise("-").alias("strand")).distinct()
    return features.anchor_motifs(_merged_loops(spark, d), peaks, motifs)


@query("anchor_motifs", f"""
with {_LOOPS}, {_MOTIF_INPUT}, bm as (select distinct m.* from mt m join pk p on m.chrom = p.chrom and m."start" < p."end" and m."end" > p."start"),
one as (select a.side, a.chrom, a."start", a."end", min(b."start") as ms, min(b."end") as me, min(b.strand) as strand from an a join bm b on a.chrom = b.chrom and b."start" < a."end" and b."end" > a."start"
 group by all having count(*) = 1)
select chrom, cast("start" as bigint) as "start", cast("end" as bigint) as "end", side, cast(ms as bigint) as motif_start, cast(me as bigint) as motif_end, strand,
 strand = (case when side = 1 then '+' else '-' end) as convergent from one""")
def anchor_motifs(spark, d):
    canonical = pairs.canonical_pair(derive(spark, d, "raw_pairs"))
    start = F.expr("p1 div 1000 * 1000")
    peaks = canonical.where("q2 % 3 = 0").select(F.col("c1").alias("chrom"), start.alias("start"), (start + 1000).alias("end")).distinct()
    motifs = canonical.where("q1 % 5 = 0").select(
        F.col("c1").alias("chrom"), F.col("p1").alias("start"), (F.col("p1") + 20).alias("end"),
        F.when(F.col("s1") == 0, "+").otherwise("-").alias("strand")).distinct()
    return features.anchor_motifs(_loops(spark, d), peaks, motifs)
