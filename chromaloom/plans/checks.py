"""Plain-SQL twins of the operators, as named building blocks.

``sql(final)`` prefixes ``final`` with the blocks it names as @block, directly or not.
"""

from __future__ import annotations

import re

from .inputs import STATEMENTS


def ref_len(c: str) -> str:
    return rf"coalesce(list_sum(list_transform(regexp_extract_all({c}, '(\d+)[MDNX=]', 1), lambda x: cast(x as bigint))), 0)"


def query_len(c: str) -> str:
    return rf"coalesce(list_sum(list_transform(regexp_extract_all({c}, '(\d+)[MISX=]', 1), lambda x: cast(x as bigint))), 0)"


def span_len(c: str) -> str:
    return rf"coalesce(list_sum(list_transform(regexp_extract_all({c}, '(\d+)[MDNX=SH]', 1), lambda x: cast(x as bigint))), 0)"


def lead_clip(c: str) -> str:
    return rf"coalesce(try_cast(regexp_extract({c}, '^(\d+)[SH]', 1) as bigint), 0)"


def trail_clip(c: str) -> str:
    return rf"coalesce(try_cast(regexp_extract({c}, '(\d+)[SH]$', 1) as bigint), 0)"


BLOCKS: dict[str, str] = dict(STATEMENTS)

BLOCKS["canon"] = """
select qname, experiment, case when keep then s1 else s2 end as s1, case when keep then c1 else c2 end as c1,
 case when keep then p1 else p2 end as p1, case when keep then s2 else s1 end as s2,
 case when keep then c2 else c1 end as c2, case when keep then p2 else p1 end as p2,
 case when keep then q1 else q2 end as q1, case when keep then q2 else q1 end as q2,
 case when keep then seq1 else seq2 end as seq1, case when keep then seq2 else seq1 end as seq2,
 case when keep then cigar1 else cigar2 end as cigar1, case when keep then cigar2 else cigar1 end as cigar2
from (select *, (c1 < c2 or (c1 = c2 and (s1 < s2 or (s1 = s2 and p1 <= p2)))) as keep from @raw_pairs)
"""

BLOCKS["bounds"] = """
select coalesce(u.chrom, l.chrom) as chrom, coalesce(u.idx, l.idx + 1) as frag, l.pos as lo, u.pos as hi
from @sites u full join @sites l on u.chrom = l.chrom and u.idx = l.idx + 1"""
BLOCKS["placed"] = """
select r.*, cast(coalesce(a.idx + 1, 0) as bigint) as f1, cast(coalesce(b.idx + 1, 0) as bigint) as f2 from @canon r
 asof left join @sites a on r.c1 = a.chrom and r.p1 >= a.pos
 asof left join @sites b on r.c2 = b.chrom and r.p2 >= b.pos
"""
BLOCKS["pairs"] = """
select p.*, least(low1, high1) as d1, low1 <= coalesce(high1, low1) as near1, least(low2, high2) as d2, low2 <= coalesce(high2, low2) as near2 from (
 select p.*, a.lo as lo1, a.hi as hi1, b.lo as lo2, b.hi as hi2, case when f1 = 0 then p1 else abs(p1 - a.lo) end as low1, abs(p1 - a.hi) as high1,
  case when f2 = 0 then p2 else abs(p2 - b.lo) end as low2, abs(p2 - b.hi) as high2
 from @placed p left join @bounds a on p.c1 = a.chrom and p.f1 = a.frag left join @bounds b on p.c2 = b.chrom and p.f2 = b.frag) p
"""


def greedy_blocks(prefix: str, source: str, key: str, wobble: int = 4) -> None:
    """Islands of near first positions, then one pass over each island in order."""
    order = "p1, p2, qname"
    on = " and ".join(f"i.{k} = s.{k}" for k in ("isl",))
    BLOCKS[f"{prefix}_gap"] = f"""
select *, case when p1 - lag(p1) over w <= {wobble} then 0 else 1 end as fresh
from @{source} window w as (partition by {key} order by {order})"""
    BLOCKS[f"{prefix}_num"] = f"""
select *, sum(fresh) over (order by {key}, {order} rows unbounded preceding) as isl from @{prefix}_gap"""
    BLOCKS[f"{prefix}_isl"] = f"""
select *, row_number() over (partition by isl order by {order}) as rn from @{prefix}_num"""
    near = (f"len(list_filter(s.kept, lambda k: abs(k.a - i.p1) <= {wobble} and abs(k.b - i.p2) <= {wobble})) > 0")
    BLOCKS[f"{prefix}_walk"] = f"""
select isl, rn, qname, [{{'a': p1, 'b': p2}}] as kept, false as dup from @{prefix}_isl where rn = 1
union all
select i.isl, i.rn, i.qname, case when {near} then s.kept else list_append(s.kept, {{'a': i.p1, 'b': i.p2}}) end, {near}
from @{prefix}_walk s join @{prefix}_isl i on {on} and i.rn = s.rn + 1"""


greedy_blocks("dd", "pairs", "c1, c2, f1, f2, s1, s2")
BLOCKS["verdicts"] = "select i.*, w.dup from @dd_isl i join @dd_walk w on i.isl = w.isl and i.rn = w.rn"
BLOCKS["uniq"] = "select * exclude (dup) from @verdicts where not dup"
BLOCKS["status"] = """
select *, case when c1 = c2 and f1 = f2 then 'intra_fragment' when least(q1, q2) < 1 then 'below_mapq' else 'contact' end as status
from @uniq"""
BLOCKS["contacts"] = """
select *, abs(p1 - p2) as d, c1 = c2 as same,
 case when c1 <> c2 then null when s1 = s2 and s1 = 0 then 'right' when s1 = s2 then 'left'
  when s1 = 0 and p1 < p2 then 'inner' when s1 = 0 then 'outer' when p1 < p2 then 'outer' else 'inner' end as orientation,
 case when c1 <> c2 then 'inter' when abs(p1 - p2) < 10 then 'very_short' when abs(p1 - p2) < 20000 then 'short' else 'long' end as rng
from @status where status = 'contact'"""
BLOCKS["recs"] = f"""
select split_part(qname, '/', 1) as qname, rec_no, split, mapq, cigar, flag, sec, s, c, e, mapped, p, pos,
 greatest(case when sec then p when s = 0 then p + {lead_clip('cigar')} + {ref_len('cigar')} - 1
  else p - {ref_len('cigar')} + 1 - {trail_clip('cigar')} end, 0) as ip,
 case when s = 0 and sec then pos + {ref_len('cigar')} - 1 else pos end as ep
from (select *, case when s = 16 then pos + {ref_len('cigar')} - 1 + (case when sec then 0 else {trail_clip('cigar')} end)
   when not sec and {lead_clip('cigar')} > 0 then greatest(pos - {lead_clip('cigar')}, 1) else pos end as p
 from (select *, (flag & 16) as s, (flag & 256) > 0 as sec, (flag & 4) = 0 as mapped, replace(rname, '_', '') as c,
   (flag & 64) > 0 as e from @alignments))"""

_rec = "{'c': c, 's': s, 'p': p, 'ip': ip, 'ep': ep, 'q': mapq, 'rec': rec_no, 'sec': sec, 'mapped': mapped, 'e': e, 'cigar': cigar}"
BLOCKS["groups"] = "select qname, count(*) as k, min(split) as split, " + ", ".join(
    f"any_value({_rec}) filter (where rec_no = {i}) as r{i}" for i in (1, 2, 3, 4)) + " from @recs group by qname"


def _close(i: int, j: int) -> str:
    return (f"(r{i}.c = r{j}.c and abs(r{i}.p - r{j}.p) < 1000 and r{i}.s <> r{j}.s and r{i}.e <> r{j}.e"
            f" and (r{i}.sec or r{j}.sec))")


def _primary(i: int, j: int) -> str:
    return f"(case when not r{i}.sec then r{i} else r{j} end)"


def _other(i: int, j: int) -> str:
    return f"(case when not r{i}.sec then r{j} else r{i} end)"


_plan = [
    ("k = 2", "r1", "r2", "r2"),
    (f"k = 3 and ({_close(1, 2)} or {_close(1, 3)} or {_close(2, 3)}) and r1.e = r2.e", _primary(1, 2), "r3", _other(1, 2)),
    (f"k = 3 and ({_close(1, 2)} or {_close(1, 3)} or {_close(2, 3)}) and r1.e = r3.e", _primary(1, 3), "r2", _other(1, 3)),
    (f"k = 3 and ({_close(1, 2)} or {_close(1, 3)} or {_close(2, 3)})", _primary(2, 3), "r1", _other(2, 3)),
    (f"k = 4 and {_close(1, 3)} and {_close(2, 4)}", _primary(1, 3), _primary(2, 4), _other(2, 4)),
    (f"k = 4 and {_close(1, 4)} and {_close(2, 3)}", _primary(1, 4), _primary(2, 3), _other(2, 3)),
    (f"k = 4 and {_close(1, 2)} and {_close(3, 4)}", _primary(1, 2), _primary(3, 4), _other(3, 4)),
]


def _choose(n: int) -> str:
    return "case " + " ".join(f"when {x[0]} then {x[n]}" for x in _plan) + " end"


BLOCKS["chosen"] = f"select *, {_choose(1)} as a, {_choose(2)} as b, ({_choose(3)}).ip as inside from @groups"
BLOCKS["judged"] = """
select *, case when k = 1 then (case when r1.mapped then 'singleton' else 'unmapped' end) when a is null then 'ambiguous'
 when not (a.mapped and b.mapped) then 'unmapped' when k = 2 then 'normal' else 'chimeric' end as status from @chosen"""
BLOCKS["ranked"] = """
select *, status in ('normal', 'chimeric') as ok,
 (a.c < b.c or (a.c = b.c and (a.s < b.s or (a.s = b.s and a.p <= b.p)))) as keep from @judged"""


def _sides() -> str:
    out = []
    for field in ("s", "c", "p", "q", "cigar", "rec"):
        out.append(f"case when not ok then null when keep then a.{field} else b.{field} end as {field}1")
        out.append(f"case when not ok then null when keep then b.{field} else a.{field} end as {field}2")
    out.append("case when not ok then null when keep then a.ip else inside end as ip1")
    out.append("case when not ok then null when keep then inside else a.ip end as ip2")
    return ", ".join(out)


BLOCKS["classified"] = f"""
select qname, k, split, status, case status when 'normal' then 0 when 'chimeric' then (case k when 3 then 2 else 4 end)
 when 'singleton' then 7 when 'ambiguous' then 8 end as rt, {_sides()} from @ranked"""
BLOCKS["tagged"] = """
select x.qname, x.rec_no, x.flag, x.rname, x.pos, x.mapq, x.cigar, x.split,
 case when g.status in ('normal', 'chimeric') then (case when rec_no = rec1 then g.rt when rec_no = rec2 then g.rt + 1 else 9 end) else g.rt end as rt,
 case when rec_no = rec1 then ip1 when rec_no = rec2 then ip2 end as ip,
 case when rec_no = rec1 then ip2 when rec_no = rec2 then ip1 end as mp,
 case when rec_no = rec1 then q2 when rec_no = rec2 then q1 end as mate_mapq,
 case when rec_no = rec1 then c2 when rec_no = rec2 then c1 end as mate_chrom
from @alignments x join @classified g on x.qname = g.qname"""
BLOCKS["linked"] = """
select * exclude (mate_chrom), case when mate_chrom is null then '*' when mate_chrom = rname then '=' else mate_chrom end as rnext from @tagged"""
BLOCKS["homologs"] = """
select qname, concat(rname, case when cast(substr(qname, 3) as bigint) % 3 = 0 then '-a' else '-r' end) as homolog, rt
 from @linked where rt between 0 and 5 and rt % 2 = cast(substr(qname, 3) as bigint) % 2
union all
select qname, concat(rname, '-r') as homolog, rt from @linked where rt between 0 and 5 and cast(substr(qname, 3) as bigint) % 9 = 0"""
BLOCKS["phased_reads"] = """
select qname, regexp_replace(homolog, '-[ra]$', '') as rname, min(homolog) as homolog, list(rt) as rts
from @homologs group by 1, 2 having min(homolog) = max(homolog)"""


def _named(text: str) -> list[str]:
    return list(dict.fromkeys(re.findall(r"@(\w+)", text)))


def _counted(text: str) -> str:
    """Write count_if(x) as count(case when x then 1 end), which has the usual integer type."""
    while "count_if(" in text:
        start = text.index("count_if(")
        at, depth = start + len("count_if("), 1
        while depth:
            depth += {"(": 1, ")": -1}.get(text[at], 0)
            at += 1
        inner = text[start + len("count_if("):at - 1]
        text = f"{text[:start]}count(case when {inner} then 1 end){text[at:]}"
    return text


def sql(final: str) -> str:
    """One statement: the blocks that ``final`` names as @block, in order, then ``final``.

    ``final`` may bring blocks of its own in a leading WITH.
    """
    order: list[str] = []

    def visit(text: str, own: str | None = None) -> None:
        for name in _named(text):
            if name != own and name not in order:
                visit(BLOCKS[name], name)
                order.append(name)

    def plain(text: str) -> str:
        return re.sub(r"@(\w+)", r"x_\1", _counted(text.strip()))

    visit(final)
    if not order:
        return plain(final)
    ctes = ",\n".join(f"x_{n} as {'' if n.endswith('_walk') else 'materialized '}({plain(BLOCKS[n])})" for n in order)
    own = re.match(r"\s*with(\s+recursive)?\s", final)
    rest = ",\n" + plain(final[own.end():]) if own else "\n" + plain(final)
    return f"with recursive {ctes}{rest}"
