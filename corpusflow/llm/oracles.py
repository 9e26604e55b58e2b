"""SQL of the trie and of the manifest, by other ways than the operators: prefix keys instead of rounds, one level at a time."""

from __future__ import annotations

from corpusflow.llm.merkle import FANOUT, FIELDS

#: CRC-32 (reversed polynomial 0xEDB88320) of a decimal, by a table made of eight steps for each byte.
_CRC = """crc as (select list(v order by i) as t from (select i, list_reduce(list_concat([i], range(8)), lambda c, k: xor(c >> 1, 3988292384 * (c & 1))) as v from range(256) r(i)))"""


def _crc32(said: str) -> str:
    codes = f"list_transform(range(1, length({said}) + 1), lambda k: cast(ascii(substr({said}, k, 1)) as bigint))"
    return f"xor(list_reduce(list_concat([4294967295], {codes}), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)"


TRIE_SQL = f"""
  with {_CRC},
  said as (select conv_id, turn, coalesce(text, '') as text, sha256(concat(octet_length(encode(coalesce(role, ''))), ':', coalesce(role, ''), coalesce(text, ''))) as digest from conversations where conv_id is not null),
  old as (select conv_id, digest, octet_length(encode(text)) as n_bytes, row_number() over w - 1 as idx from said window w as (partition by conv_id order by turn nulls first, digest)),
  named as (select conv_id, count(*) as n, cast(conv_id as varchar) as s from old group by conv_id),
  kept as (select conv_id, n, conv_id - conv_id % 5 as base, {_crc32("s")} % 9 as h from named, crc),
  based as (select k.*, least(k.h, coalesce(b.n, 0)) as taken from kept k left join named b on b.conv_id = k.base),
  turns as (select b.conv_id, o.idx + 1 as depth, digest, n_bytes from based b join old o on o.conv_id = b.base and o.idx < b.taken
    union all select b.conv_id, b.taken + o.idx - b.h + 1, digest, n_bytes from based b join old o on o.conv_id = b.conv_id and o.idx >= b.h),
  lengths as (select conv_id, taken + greatest(n - h, 0) as length from based),
  p as (select conv_id, depth, n_bytes, sha256(string_agg(digest, '') over (partition by conv_id order by depth)) as key from turns
    union all select conv_id, 0, 0, '' from lengths),
  nodes as (select depth, key, min(conv_id) as conv_id, count(*) as n_convs, min(n_bytes) as n_bytes,
    sha256(coalesce(string_agg(cast(conv_id as varchar), ',' order by conv_id) filter (depth = length), '')) as ends_sha256 from p join lengths using (conv_id) group by depth, key),
  up as (select n.*, q.conv_id as parent_conv_id from nodes n left join p a on a.conv_id = n.conv_id and a.depth = n.depth - 1 left join nodes q on q.depth = a.depth and q.key = a.key),
  kids as (select u.*, (select count(*) from up c where c.depth = u.depth + 1 and c.parent_conv_id = u.conv_id) as n_children from up u),
  below as (select a.depth, a.key, count(*) filter (k.n_children = 0) as n_leaves, cast(sum((k.n_convs - 1) * k.n_bytes) as bigint) as saved_tokens from kids k join p a on a.conv_id = k.conv_id and a.depth <= k.depth group by 1, 2)
  select conv_id, cast(depth as bigint) as depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 from kids join below using (depth, key)"""


def _leaf(text: str) -> str:
    parts = [f"coalesce(octet_length(encode({v})) || ':' || {v}, '-')" for v in (f"cast({c} as varchar)" if c != "text" else text for c in FIELDS)]
    return f"sha256({' || '.join(parts)})"


def _tree(name: str, leaves: str) -> str:
    """Nodes of all levels over leaves (tree, idx, n, node), and for each leaf and level the nodes of its run that stand before and after its own."""
    return f"""{name}(tree, level, idx, n, node) as (select tree, 0, idx, n, node from {leaves}
      union all select tree, level + 1, idx // {FANOUT}, (n + {FANOUT - 1}) // {FANOUT}, sha256(string_agg(node, '' order by idx)) from {name} where n > 1 group by tree, level, idx // {FANOUT}, n),
    {name}_steps as (select l.tree, l.idx, x.level, coalesce(string_agg(x.node, '' order by x.idx) filter (x.idx < l.idx // cast({FANOUT} ** x.level as bigint)), '') as before,
      coalesce(string_agg(x.node, '' order by x.idx) filter (x.idx > l.idx // cast({FANOUT} ** x.level as bigint)), '') as after
      from {leaves} l join {name} x on x.tree is not distinct from l.tree and x.n > 1 and x.idx // {FANOUT} = l.idx // cast({FANOUT} ** (x.level + 1) as bigint) group by l.tree, l.idx, x.level)"""


MERKLE_SQL = f"""
  with recursive {_CRC},
  hit as (select *, coalesce({_crc32("cast(doc_id as varchar)")} % 2 = 0, false) as hit from documents, crc),
  leaves as (select doc_id, source as tree, {_leaf("text")} as node, {_leaf("case when hit then replace(text, chr(10), '') else text end")} as now from hit),
  placed as (select *, row_number() over (partition by tree order by doc_id nulls first, node) - 1 as idx, count(*) over (partition by tree) as n from leaves),
  {_tree("low", "placed")},
  tops as (select 'all' as tree, tree as source, node, row_number() over (order by tree nulls first) - 1 as idx, count(*) over () as n from low where n = 1),
  {_tree("high", "tops")},
  root as (select node as root from high where n = 1),
  steps as (select l.tree, l.idx, level, before, after from low_steps l
    union all select p.tree, p.idx, 1000 + h.level, before, after from placed p join tops t on t.source is not distinct from p.tree join high_steps h on h.idx = t.idx),
  numbered as (select *, row_number() over (partition by tree, idx order by level) as k from steps),
  proofs as (select tree, idx, sha256(string_agg(before || after, '' order by k)) as proof_sha256, max(k) as depth from numbered group by 1, 2),
  fold(tree, idx, k, node) as (select tree, idx, cast(0 as bigint), now from placed
    union all select f.tree, f.idx, f.k + 1, sha256(s.before || f.node || s.after) from fold f join numbered s on s.tree is not distinct from f.tree and s.idx = f.idx and s.k = f.k + 1)
  select p.doc_id, p.node as leaf, t.node as subroot, root, coalesce(q.proof_sha256, sha256('')) as proof_sha256, f.node as folded_root, f.node = root as verified
  from placed p join tops t on t.source is not distinct from p.tree left join proofs q on q.tree is not distinct from p.tree and q.idx = p.idx
    join fold f on f.tree is not distinct from p.tree and f.idx = p.idx and f.k = coalesce(q.depth, 0), root"""
