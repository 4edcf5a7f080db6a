"""DuckDB SQL of the conversation trie and the Merkle manifest."""
from __future__ import annotations


def crc32_sql(text: str) -> str:
    """Unsigned CRC-32 of an ASCII string, bit by bit (3988292384 is the reflected polynomial)."""
    step = "lambda v, i: case when v & 1 = 1 then xor(v >> 1, 3988292384::bigint) else v >> 1 end"
    octets = f"list_transform(string_split({text}, ''), lambda x: ascii(x)::bigint)"
    return (f"xor(list_reduce(list_concat([4294967295::bigint], {octets}), "
            f"lambda c, b: list_reduce(list_concat([xor(c, b)], range(8)), {step})), 4294967295::bigint)")


def _field(c: str) -> str:
    return f"case when {c} is null then '-' else concat(strlen(cast({c} as varchar)), ':', {c}) end"


_HEAD = " || ".join(_field(c) for c in ("doc_id", "source", "lang", "n_chars"))

MERKLE = f"""
with recursive rows as (
  select doc_id, source, sha256({_HEAD} || {_field('text')}) as leaf,
         case when doc_id is not null and {crc32_sql("coalesce(cast(doc_id as varchar), '0')")} % 2 = 0 and text is not null
              then sha256({_HEAD} || {_field("replace(text, chr(10), '')")})
              else sha256({_HEAD} || {_field('text')}) end as changed
  from documents),
leaves as (select *, row_number() over (partition by source order by doc_id nulls first, leaf) - 1 as pos from rows),
inner_level(source, l, a) as (
  select source, 0, list(leaf order by pos) from leaves group by source
  union all
  select source, l + 1, list_transform(range(0, len(a), 3), lambda i: sha256(array_to_string(a[i + 1:i + 3], ''))) from inner_level where len(a) > 1),
subroots as (select source, a[1] as subroot, l as top, row_number() over (order by source nulls first) - 1 as no from inner_level where len(a) = 1),
outer_level(l, a) as (
  select 0, list(subroot order by no) from subroots having count(*) > 0
  union all
  select l + 1, list_transform(range(0, len(a), 3), lambda i: sha256(array_to_string(a[i + 1:i + 3], ''))) from outer_level where len(a) > 1),
roots as (select a[1] as root from outer_level where len(a) = 1),
steps as (
  select f.source, f.pos, f.doc_id, f.leaf, f.changed, s.subroot, l.l as step, l.a as a, f.pos // cast(pow(3, l.l) as bigint) as idx
  from leaves f join subroots s on f.source is not distinct from s.source join inner_level l on l.source is not distinct from f.source and l.l < s.top
  union all
  select f.source, f.pos, f.doc_id, f.leaf, f.changed, s.subroot, s.top + l.l, l.a, s.no // cast(pow(3, l.l) as bigint)
  from leaves f join subroots s on f.source is not distinct from s.source join outer_level l on len(l.a) > 1
  union all
  select f.source, f.pos, f.doc_id, f.leaf, f.changed, s.subroot, -1, null, null
  from leaves f join subroots s on f.source is not distinct from s.source),
sided as (
  select *, case when step < 0 then changed else array_to_string(a[idx - idx % 3 + 1:idx], '') end as x,
         case when step < 0 then '' else array_to_string(a[idx + 2:idx - idx % 3 + 3], '') end as y
  from steps),
proofs as (
  select source, pos, any_value(doc_id) as doc_id, any_value(leaf) as leaf, any_value(subroot) as subroot,
         sha256(coalesce(string_agg(x || y, '' order by step) filter (where step >= 0), '')) as proof_sha256,
         list_reduce(list(struct_pack(x := x, y := y) order by step), lambda f, s: struct_pack(x := sha256(s.x || f.x || s.y), y := '')).x as folded_root
  from sided group by source, pos)
select doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root as verified from proofs, roots
"""

TRIE = f"""
with turns as (
  select conv_id as c, digest, strlen(coalesce(text, '')) as size,
         row_number() over (partition by conv_id order by turn nulls first, substr(digest, 1, 30)) - 1 as pos
  from (select *, sha256(concat(strlen(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, ''))) as digest
        from conversations where conv_id is not null) x),
counted as (select c, count(*) as n, c - ((c % 5) + 5) % 5 as first, {crc32_sql("cast(c as varchar)")} % 9 as h from turns group by c),
convs as (select a.c, a.first, a.h, least(a.h, coalesce(b.n, 0)) as lent, least(a.h, coalesce(b.n, 0)) + greatest(a.n - a.h, 0) as length
          from counted a left join counted b on a.first = b.c),
rebuilt as (
  select t.c, t.pos - v.h + v.lent as pos, digest, size, length from turns t join convs v on t.c = v.c where t.pos >= v.h
  union all
  select v.c, t.pos, digest, size, length from convs v join turns t on t.c = v.first where t.pos < v.h),
prefixes as (
  select c, pos + 1 as depth, sha256(string_agg(digest, ',') over (partition by c order by pos rows between unbounded preceding and current row)) as k, size, length from rebuilt
  union all
  select c, 0, '', 0, length from convs),
steps as (select *, lag(k) over (partition by c order by depth) as above from prefixes),
nodes as (select depth, k, any_value(above) as above, any_value(size) as size, min(c) as conv_id, count(*) as n_convs,
                 sha256(coalesce(string_agg(cast(c as varchar), ',' order by c) filter (where length = depth), '')) as ends_sha256
          from steps group by depth, k),
children as (select depth - 1 as depth, above as k, count(*) as n_children from nodes where depth > 0 group by depth, above),
weighed as (select n.*, coalesce(n_children, 0) as n_children, p.conv_id as parent_conv_id
            from nodes n left join children using (depth, k) left join nodes p on p.depth = n.depth - 1 and p.k = n.above),
sums as (select s.depth, s.k, sum(case when w.n_children = 0 then 1 else 0 end) as n_leaves, sum((w.n_convs - 1) * w.size) as saved_tokens
         from weighed w join steps s on s.c = w.conv_id and s.depth <= w.depth group by s.depth, s.k)
select conv_id, cast(depth as bigint) as depth, parent_conv_id, n_convs, n_children, cast(n_leaves as bigint) as n_leaves,
       cast(saved_tokens as bigint) as saved_tokens, ends_sha256
from weighed join sums using (depth, k)
"""
