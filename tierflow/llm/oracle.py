"""SQL for the queries that SQL can express, over the same tables."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_OP5 = rf"""
with doc_words as (
  select doc_id, regexp_extract_all(
    translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from documents
), item_words as (
  select item_id, regexp_extract_all(
    translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from benchmark
), item_windows as (
  select distinct item_id, least(len(w), 13) as n,
    array_to_string(w[i : i + least(len(w), 13) - 1], ' ') as k
  from (select *, unnest(range(1, greatest(len(w) - 12, 1) + 1)) as i
        from item_words where len(w) > 0)
), sizes as (select distinct n from item_windows
), doc_windows as (
  select doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') as k
  from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as i
        from doc_words, sizes where len(w) >= n)
), matches as (
  select doc_id, d.i, d.n, item_id
  from doc_windows d join item_windows m on d.n = m.n and d.k = m.k
), hits as (
  select doc_id, count(distinct p) as n_hit
  from (select doc_id, unnest(range(i, i + n)) as p from matches) group by doc_id
), items as (
  select doc_id, count(*) as n_items, string_agg(s, ',' order by s) as names
  from (select distinct doc_id, cast(item_id as varchar) as s from matches)
  group by doc_id
)
select doc_id, cast(len(w) as bigint) as n_words,
  cast(coalesce(n_hit, 0) as bigint) as n_hit,
  cast(coalesce(n_items, 0) as bigint) as n_items,
  sha256(coalesce(names, '')) as items_sha256,
  coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
from doc_words left join hits using (doc_id) left join items using (doc_id)
"""

_OP8 = rf"""
with recursive doc_words as (
  select doc_id, regexp_extract_all(
    translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x20\x09-\x0D]+') as w
  from documents
), shingles as (
  select distinct doc_id, array_to_string(w[i : i + 4], ' ') as s
  from (select *, unnest(range(1, greatest(len(w) - 4, 1) + 1)) as i
        from doc_words where len(w) > 0)
), sizes as (select doc_id, count(*) as n from shingles group by doc_id
), rare as (
  -- In one order of all shingles, two sets of similarity 0.75 have a common shingle
  -- among the first n - ceil(0.75 n) + 1 of both; the full sets then decide.
  select doc_id, s from (
    select doc_id, s, n, row_number() over (partition by doc_id order by df, s) as r
    from shingles join (select s, count(*) as df from shingles group by s) using (s)
    join sizes using (doc_id)) where r <= n - ceil(0.75 * n) + 1
), pairs as (
  select distinct a.doc_id as a, b.doc_id as b
  from rare a join rare b on a.s = b.s and a.doc_id < b.doc_id
), shared as (
  select a, b, count(*) as m from pairs
  join shingles x on x.doc_id = a join shingles y on y.doc_id = b and y.s = x.s
  group by a, b
), links as (
  select a, b from shared join sizes x on x.doc_id = a join sizes y on y.doc_id = b
  where 100 * m >= 75 * (x.n + y.n - m)
), two_way as (select a, b from links union select b, a from links
), reach as (
  select doc_id as node, doc_id as root from documents where doc_id is not null
  union
  select two_way.b, root from reach join two_way on two_way.a = reach.node
), least as (select node, min(root) as root from reach group by node)
select doc_id, cast(coalesce(n, 0) as bigint) as n_shingles, root as component_id,
  doc_id = root as kept
from documents left join sizes using (doc_id) join least on node = doc_id
"""

_OP9 = f"""
select doc_id, max(doc_id) over same as keep_id, count(*) over same as group_size,
  doc_id = max(doc_id) over same as kept, sha256(body) as text_sha256
from (select doc_id, translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}') as body
      from documents)
window same as (partition by body)
"""

_SAID = "</s>[INST] ok [/INST]"
_CONTROL = (
    r"\\|<\|im_start\|>|<\|im_sep\|>|<\|im_end\|>|<s>|</s>|\[INST\]|\[/INST\]"
    r"|<<SYS>>|<</SYS>>|<\|startoftext\|>|<\|endoftext\|>"
)

_OP11 = f"""
with turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text
  from conversations
  union all select -1, 0, 'user', '{_SAID}'
  union all select -1, 1, 'assistant', '{_SAID}'
), sized as (
  -- Marks of 12, 10 and 10 characters; an escape for each backslash and control string.
  select *, 32 + length(role) + length(text) + len(regexp_extract_all(role, '{_CONTROL}'))
    + len(regexp_extract_all(text, '{_CONTROL}')) as chars
  from turns
), placed as (
  select *, row_number() over same as place, sum(chars) over same as upto from sized
  window same as (partition by conv_id order by turn nulls first, role, text
    rows between unbounded preceding and current row)
)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by place)) as turns_sha256,
  cast(coalesce(sum(length(text)) filter (where role = 'assistant'), 0) as bigint)
    as loss_chars,
  sha256(coalesce(string_agg(text, '' order by place) filter (where role = 'assistant'), ''))
    as loss_sha256,
  cast(coalesce(sum(upto) filter (where role = 'assistant'), 0) + max(upto)
    - coalesce(max(upto) filter (where role = 'assistant'), 0) as bigint)
    as formatted_chars
from placed group by conv_id
"""

#: Relation ``crc_steps``: what a checksum's register takes in for each value of its low byte.
_CRC_STEPS = """
crc_steps as (
  select list(step order by byte) as steps from (
    select byte, list_reduce(list_prepend(byte, range(8)), lambda r, i:
      case when r & 1 = 1 then xor(r >> 1, 3988292384) else r >> 1 end) as step
    from (select unnest(range(256)) as byte))
)"""


def _crc32(text: str) -> str:
    """The unsigned checksum of an ASCII text, beside ``crc_steps``."""
    return (
        "xor(4294967295, list_reduce(list_prepend(4294967295, list_transform("
        f"range(1, length({text}) + 1), lambda k: cast(ascii(substr({text}, k, 1)) as bigint))), "
        "lambda r, b: xor(r >> 8, steps[(xor(r, b) & 255) + 1])))"
    )


_OP12 = rf"""
with {_CRC_STEPS}, given as (
  select doc_id, {_crc32("cast(doc_id as varchar)")} as h,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w
  from documents, crc_steps
), planned as (
  select doc_id, w, len(w) as n, h % 10 = 0 and len(w) > 0 as planted,
    (h // 10) % greatest(len(w), 1) as a, 3 + (h // 10) % 8 as parts
  from given
), words as (
  select doc_id, n, i,
    w[1 + case when planted and i >= a then a + (i - a) % (1 + (n - a) // parts) else i end]
      as word
  from (select *, unnest(range(n)) as i from planned)
), matches as (
  -- A run of period q has n >= 4 q words, and its words but the last q recur q later.
  select x.doc_id, y.i - x.i as q, x.i as i
  from words x join words y
    on x.doc_id = y.doc_id and x.word = y.word and y.i > x.i and 4 * (y.i - x.i) <= x.n
), stretches as (
  select doc_id, q, min(i) as s, count(*) + q as length
  from (select *, i - row_number() over (partition by doc_id, q order by i) as island
        from matches)
  group by doc_id, q, island having count(*) + q >= greatest(6, 4 * q)
), runs as (
  -- A stretch whose smallest period is less lies in a stretch of that one.
  select * from stretches x where not exists (
    select * from stretches y where y.doc_id = x.doc_id and y.q < x.q and y.s <= x.s
      and y.s + y.length >= x.s + x.length)
), listed as (
  select doc_id, count(*) as n_runs,
    string_agg(s || ',' || length || ',' || q || chr(10), '' order by s, q) as lines
  from runs group by doc_id
), best as (
  select doc_id, s, length, q from runs
  qualify row_number() over (partition by doc_id order by length desc, s, q) = 1
), dropped as (
  select distinct doc_id, i
  from (select doc_id, unnest(range(s + q, s + length)) as i from runs)
), kept as (
  select doc_id, string_agg(word, ' ' order by i) as body
  from words anti join dropped using (doc_id, i) group by doc_id
)
select doc_id, cast(coalesce(n_runs, 0) as bigint) as n_runs, cast(s as bigint) as start,
  cast(length as bigint) as length, cast(q as bigint) as period,
  cast(1000 * length // q as bigint) as exponent_milli,
  sha256(coalesce(lines, '')) as runs_sha256, sha256(coalesce(body, '')) as collapsed_sha256
from documents left join listed using (doc_id) left join best using (doc_id)
  left join kept using (doc_id)
"""

_OP13 = rf"""
with {_CRC_STEPS}, turns as (
  select conv_id, row_number() over (
      partition by conv_id order by turn nulls first, role, text) as place,
    coalesce(role, '') as role, coalesce(text, '') as text
  from conversations where conv_id is not null
), convs as (
  select conv_id, conv_id - conv_id % 20 as base,
    {_crc32("cast(conv_id as varchar)")} % 4 as h
  from (select distinct conv_id from turns), crc_steps
), heads as (
  select convs.conv_id, place, role, text
  from convs join turns on turns.conv_id = base and place <= h
), taken as (
  select convs.conv_id, h, count(place) as n
  from convs left join heads using (conv_id) group by convs.conv_id, h
), rebuilt as (
  select * from heads
  union all
  select conv_id, n + place - h, role, text
  from turns join taken using (conv_id) where place > h
), prefixes as (
  select conv_id, place as depth, string_agg(sha256(role) || sha256(text), '') over (
      partition by conv_id order by place) as node,
    len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) as words
  from rebuilt
  union all
  select conv_id, 0, '', 0 from convs
), ended as (
  select *, lag(node) over same as parent,
    depth = max(depth) over (partition by conv_id) as is_end
  from prefixes window same as (partition by conv_id order by depth)
), nodes as (
  select node, depth, any_value(parent) as parent, min(conv_id) as conv_id,
    count(*) as n_convs, (count(*) - 1) * any_value(words) as saved,
    string_agg(cast(conv_id as varchar), ',' order by conv_id) filter (where is_end) as ends
  from ended group by node, depth
), children as (
  select parent as node, count(*) as n_children from nodes where depth > 0 group by parent
), subtrees as (
  select above.node, count(*) filter (where n_children is null) as n_leaves,
    sum(below.saved) as saved_tokens
  from nodes below join prefixes above
    on above.conv_id = below.conv_id and above.depth <= below.depth
  left join children on children.node = below.node
  group by above.node
)
select nodes.conv_id, cast(nodes.depth as bigint) as depth,
  up.conv_id as parent_conv_id, nodes.n_convs,
  coalesce(n_children, 0) as n_children, n_leaves,
  cast(saved_tokens as bigint) as saved_tokens,
  sha256(coalesce(nodes.ends, '')) as ends_sha256
from nodes join subtrees using (node) left join children using (node)
  left join nodes up on up.node = nodes.parent and nodes.depth > 0
"""

LLM_ORACLE = {
    "op5_decontamination": _OP5,
    "op8_near_dedup": _OP8,
    "op9_exact_dedup": _OP9,
    "op11_chat_format": _OP11,
    "op12_periodic_runs": _OP12,
    "op13_prefix_trie": _OP13,
}
