"""SQL for the registered queries, run by DuckDB on the same tables.

Written from the operators' definitions, not from their plans: nothing here is shared with
the DataFrame code but fixed values and the roles that the tables play.
"""

from __future__ import annotations

from corpusflow.functions.catalogs import PREDICATES, capabilities, rubric, tasks

_SEED = 20260915


def _h8(x: str) -> str:
    """First eight bytes of a text's SHA-256 as an unsigned number."""
    return f"cast(concat('0x', substr(sha256({x}), 1, 16)) as ubigint)"


def _split(group: str) -> str:
    b = f"({_h8(f'concat({_SEED}, chr(58), {group})')} % 10000)"
    return f"case when {b} < 9000 then 'train' when {b} < 9500 then 'development' else 'test' end"


def _turns(image: str) -> str:
    return f"list_extract([2,2,2,2,3,3,3,3,4,5,6], cast({_h8(f'''concat({_SEED}, chr(58), {image}, ':turn-count')''')} % 11 as int) + 1)"


def _values(rows: list[tuple]) -> str:
    def one(x: object) -> str:
        if isinstance(x, list | tuple):
            return "[" + ", ".join(map(one, x)) + "]"
        return str(x) if isinstance(x, int) else "'" + str(x).replace("'", "''") + "'"

    return ", ".join("(" + ", ".join(map(one, r)) + ")" for r in rows)


_METADATA = """
  select page_id,
    case when page_id % 17 = 0 then upper(concat(substr(sha256(url), 1, 16), 'x')) else substr(sha256(url), 1, 16) end as ImageID,
    case when page_id % 11 = 0 then 'validation' else 'train' end as Subset,
    case when page_id % 7 = 0 then 'https://example.org/nc/' else concat('https://creativecommons.org/licenses/by/', list_extract(['2.0', '2.5', '3.0', '4.0'], cast(page_id % 4 + 1 as int)), '/') end as License,
    case when page_id % 13 = 0 then ' ' else concat('author ', page_id) end as Author,
    url as Landing,
    list_extract(['0', '90.0', '270', '45', '0.0'], cast(page_id % 5 + 1 as int)) as Rotation
  from pages"""

_REASON = """case when not regexp_full_match(ImageID, '[0-9a-f]{16}') then 'invalid_id' when Subset <> 'train' then 'not_train' when page_id % 19 = 0 then 'evaluation_id'
  when License not in ('https://creativecommons.org/licenses/by/2.0/', 'https://creativecommons.org/licenses/by/2.5/', 'https://creativecommons.org/licenses/by/3.0/', 'https://creativecommons.org/licenses/by/4.0/') then 'unsupported_license'
  when trim(Author) = '' or not starts_with(Landing, 'https://') then 'missing_attribution' when Rotation not in ('0', '90', '180', '270', '0.0', '90.0', '180.0', '270.0') then 'unknown_rotation' else 'eligible' end"""
_DEGREES = "case Rotation when '0' then 0 when '0.0' then 0 when '90' then 90 when '90.0' then 90 when '180' then 180 when '180.0' then 180 when '270' then 270 when '270.0' then 270 end"

_UNIT = """
  raw as (select vec_id, list_transform(embedding, lambda x: cast(x as double)) as v from embeddings),
  unit as (select vec_id, list_transform(v, lambda x: x / sqrt(list_sum(list_transform(v, lambda y: y * y)))) as u from raw),
  near as (select a.vec_id as left_id, b.vec_id as right_id, list_sum(list_transform(range(1, len(a.u) + 1), lambda i: a.u[i] * b.u[i])) as c
    from unit a join unit b on a.vec_id < b.vec_id)"""

_WEIGHTS = "w as (select lang as tag, count(*) as weight from documents group by 1)"


def _quota(total: int | str, more: int = 0) -> str:
    return f"""{_WEIGHTS.replace("count(*)", f"count(*) + {more}")},
  p as (select tag, {total} * weight // (select sum(weight) from w) as f, {total} * weight % (select sum(weight) from w) as rest from w),
  q as (select tag, cast(f + case when row_number() over (order by rest desc, tag) <= {total} - (select sum(f) from p) then 1 else 0 end as bigint) as quota from p)"""


_JUDGED = """j as (select d.doc_id, d.lang, case quality when 1 then 'MET' when 0 then 'NOT_MET' else 'UNKNOWN' end as a,
  case toxic when 0 then 'MET' when 1 then 'NOT_MET' else 'UNKNOWN' end as b from documents d left join labels l on d.doc_id = l.doc_id)"""
_AGREE = "case when {a} = 'ERROR' or {b} = 'ERROR' then 'ERROR' when {a} = {b} and {a} in ('MET', 'NOT_MET') then {a} else 'UNKNOWN' end"

_MESSAGES = "m as (select cast(conv_id as varchar) as conversation_id, cast(turn as int) as position, role, text as content from conversations)"

_TURNS = f"""t0 as (select cast(user_id as varchar) as conversation_id, event_id from events),
  t1 as (select conversation_id, cast(row_number() over (partition by conversation_id order by event_id) as int) as turn_index from t0),
  t2 as (select *, {_h8("concat(conversation_id, ':', turn_index)")} % 100 as b from t1),
  t as (select conversation_id, turn_index, case when b < 80 then 'COMMITTED' when b < 90 then 'REJECTED' when b < 97 then 'ABSTAINED' else 'ERROR' end as status from t2),
  stops as (select conversation_id, count(*) as n_turns, min(case when status <> 'COMMITTED' then turn_index end) as at from t group by 1),
  pre as (select s.conversation_id, s.n_turns, coalesce(s.at - 1, s.n_turns) as committed_turns, t.status as stop_status from stops s left join t on s.conversation_id = t.conversation_id and s.at = t.turn_index),
  acc as (select conversation_id, n_turns, cast(committed_turns as bigint) as committed_turns, stop_status, case when stop_status is null then case when n_turns >= 2 then 'QUALITY_CANDIDATE' else 'REJECTED' end
    when stop_status in ('REJECTED', 'ABSTAINED') and committed_turns >= 2 then 'QUALITY_CANDIDATE' else stop_status end as status from pre)"""

_POOL = """pool as (select cast(o_orderkey as varchar) as conversation_id, c_mktsegment as language, cast(o_custkey as varchar) as image_id, cast(c_nationkey as varchar) as visual_group_id,
  o_orderstatus as task_family, case when o_orderkey % 9 = 0 then 'evaluation' else 'training' end as purpose from orders join customer on o_custkey = c_custkey),
  hashed as (select *, sha256(concat('20260915:', conversation_id)) as h from pool where purpose = 'training'),
  one as (select * from hashed qualify row_number() over (partition by image_id order by h, conversation_id) <= 1),
  chosen as (select * from one qualify row_number() over (partition by visual_group_id order by h, conversation_id) <= 6)"""

_CALLS = """c as (select event_id as seq, event_type as stage, concat('model', user_id % 2) as model_repo, sha256(concat(event_type, ':', user_id % 50)) as request_hash,
  sha256(cast(event_id as varchar)) as response_hash, coalesce(cast(json_extract_string(props, '$.k') as bigint), 0) as input_tokens, value, case when event_id % 10 = 3 then 'INVALID' else 'COMPLETE' end as status, ts from events),
  done as (select * from c where status = 'COMPLETE')"""

_TOKENS = r"""tok as (select *, regexp_extract_all(content, '(\s*)([\p{L}\p{N}_]+|[^\p{L}\p{N}_\s])', 1) as gaps, regexp_extract_all(content, '(\s*)([\p{L}\p{N}_]+|[^\p{L}\p{N}_\s])', 2) as words from m),
  ends as (select *, list_transform(range(1, len(words) + 1), lambda i: list_sum(list_transform(range(1, i + 1), lambda k: length(gaps[k]) + length(words[k])))) as e from tok)"""

_FOLD = "replace(lower({}), 'ß', 'ss')"


def _json_text(x: str) -> str:
    return f"to_json({x})"


_RUBRIC_ROWS = _values([(r[0], r[2], r[4]) for r in rubric()])
_TASK_ROWS = _values([(n, t, f, list(c)) for n, t, f, c in tasks()])
_CAPS = "[" + ", ".join(f"'{c}'" for c in capabilities()) + "]"


def _predicates() -> str:
    listed = {"history_binding_ids": 3, "computation_ids": 5, "exhaustive_scope_ids": 7, "format_requirements": 2, "requirements": 4, "claims": 6}
    out = []
    for name, sql in PREDICATES.items():
        for column, n in listed.items():
            sql = sql.replace(f"size({column}) > 0", f"doc_id % {n} = 0")
        sql = {"has_natural_language_answer": "doc_id % 2 = 0", "turn_index > 1": "doc_id % 4 + 1 > 1", "requires_witness_check": "false", "profile = 'limitation'": "doc_id % 10 = 0", "profile = 'false_premise'": "doc_id % 10 = 1"}.get(sql, sql)
        out.append(f"(applies_when = '{name}' and {sql})")
    return " or ".join(out)


ORACLE_SQL: dict[str, str] = {
    "split_after_contamination": f"""
      with g as (select sha256(text) as digest, min(doc_id) as group_id, max(cast(exists (select 1 from benchmark b where contains(d.text, b.text)) as int)) as ev from documents d group by 1)
      select lang, case when ev = 1 then 'evaluation' else {_split("group_id")} end as split, count(*) as n
      from documents d join g on sha256(d.text) = g.digest group by 1, 2""",
    "rights_window_filter": """
      with r(id, p, q, t, until) as (values ('r0', true, true, true, cast(null as timestamp)), ('r1', true, true, false, null), ('r2', false, true, true, null),
        ('r3', true, true, true, timestamp '2026-01-01 00:00:00'), ('r4', true, false, true, timestamp '2026-01-01 00:00:01')),
      j as (select d.doc_id, concat('r', d.doc_id % 6) as rights_record_id, r.* from documents d left join r on concat('r', d.doc_id % 6) = r.id)
      select rights_record_id, case when id is null then 'RIGHTS_REFERENCE_MISSING' when not (p and (until is null or timestamp '2026-01-01 00:00:00' < until)) then 'RIGHTS_NOT_PERMITTED'
        when doc_id % 2 = 0 and not (t and q) then 'RIGHTS_NOT_PERMITTED' else 'usable' end as reason, count(*) as n from j group by 1, 2""",
    "eligibility_reason_counts": f"with m as ({_METADATA}) select {_REASON} as reason, count(*) as n from m group by 1",
    "validation_eligibility": f"""with m as ({_METADATA}) select Subset = 'validation' and starts_with(License, 'https://creativecommons.org/licenses/by/') and Landing <> '' as eligible,
      coalesce({_DEGREES}, 0) as rotation, count(*) as n from m group by 1, 2""",
    "train_metadata_sample": f"with m as ({_METADATA}) select ImageID, sha256(concat('{_SEED}:', ImageID)) as rank_hash, {_DEGREES} as rotation from m where {_REASON} = 'eligible' order by 2 limit 20",
    "probed_train_sample": f"""with m as ({_METADATA}) select ImageID, sha256(concat('{_SEED}:', ImageID)) as rank_hash from m
      where {_REASON} = 'eligible' and cast('0x' || substr(sha256(concat('file:', ImageID)), 1, 16) as ubigint) % 3 = 0 order by 2 limit 4""",
    "pinned_provenance": f"""with m as ({_METADATA}) select case when page_id % 5 = 0 then 'OPEN_IMAGES_PIN_MISSING' else 'OPEN_IMAGES_PIN_PROVENANCE_MISMATCH' end as reason, count(*) as n from m
      where page_id % 5 = 0 or page_id % 3 = 0 group by 1""",
    "image_gates": """
      with i as (select p_partkey * 20011 as n_bytes, list_extract(['JPEG', 'PNG', 'GIF', 'WEBP'], cast(p_partkey % 4 + 1 as int)) as format, case when p_partkey % 9 = 0 then 2 else 1 end as frames,
        p_partkey % 9000 + 100 as width, p_size * 150 as height from part)
      select case when n_bytes > 20971520 then 'IMAGE_TOO_LARGE' when format not in ('JPEG', 'PNG', 'WEBP') then 'IMAGE_FORMAT_UNSUPPORTED' when frames <> 1 then 'ANIMATED_IMAGE_UNSUPPORTED'
        when width * height > 40000000 then 'IMAGE_PIXEL_LIMIT' when least(width, height) < 128 then 'IMAGE_EDGE_TOO_SHORT' else 'eligible' end as reason, count(*) as n from i group by 1""",
    "hash_rank_sample": f"select doc_id, sha256(concat('{_SEED}:', doc_id)) as rank_hash from documents order by 2 limit 50",
    "hash_rank_first_successes": f"""
      with top as (select doc_id, sha256(concat('{_SEED}:', doc_id)) as rank_hash from documents order by 2 limit 200)
      select top.* from top join labels using (doc_id) where quality = 1 order by rank_hash limit 10""",
    "exact_copy_antijoin": "select lang, count(*) as n from documents where sha256(text) not in (select sha256(text) from benchmark) and doc_id not in (select item_id from benchmark) group by 1",
    "duplicate_ids_semijoin": f"""
      with top as (select doc_id, sha256(text) as digest from documents order by sha256(concat('{_SEED}:', doc_id)) limit 100)
      select sha256(text) as digest, count(*) as n from documents where sha256(text) in (select digest from top) group by 1 having count(*) <> 1""",
    "near_vectors": """
      with one as (select vec_id, list_transform(embedding, lambda x: cast(x as double)) as v from embeddings),
      raw as (select * from one union all select vec_id + 1000000000, list_transform(v, lambda x, i: case when (i - 1) % 5 = 0 then x * 0.4::double else x end) from one),
      unit as (select vec_id, list_transform(v, lambda x: x / sqrt(list_sum(list_transform(v, lambda y: y * y)))) as u from raw),
      near as (select a.vec_id as left_id, b.vec_id as right_id, list_sum(list_transform(range(1, len(a.u) + 1), lambda i: a.u[i] * b.u[i])) as c from unit a join unit b on a.vec_id < b.vec_id)
      select left_id, right_id, round(c, 6) as cosine from near where c >= 0.9""",
    "similar_pairs": f"with {_UNIT} select left_id, right_id, round(c, 6) as cosine from near where c >= 0.40",
    "visual_components": f"""
      with recursive {_UNIT}, e as (select left_id as a, right_id as b from near where c >= 0.40 union all select right_id, left_id from near where c >= 0.40),
      reach(a, b) as (select vec_id, vec_id from embeddings union select r.a, e.b from reach r join e on r.b = e.a),
      root as (select a, min(b) as root from reach group by 1),
      ids as (select root, sha256(concat('[', string_agg(concat('"', a, '"'), ',' order by cast(a as varchar)), ']')) as visual_group_id from root group by 1)
      select a as image_id, visual_group_id from root join ids using (root)""",
    "declared_groups": """
      with recursive o as (select o_orderkey as id, concat(o_custkey, '|', strftime(o_orderdate, '%Y-%m')) as k1, concat(o_custkey, '|', o_orderpriority) as k2 from orders),
      e as (select o.id as a, g.m as b from o join (select k1, min(id) as m from o group by 1) g using (k1) union select o.id, g.m from o join (select k2, min(id) as m from o group by 1) g using (k2)),
      both_ as (select a, b from e union select b, a from e),
      reach(a, b) as (select id, id from o union select r.a, x.b from reach r join both_ x on r.b = x.a)
      select root, count(*) as n, max(a) as last_id from (select a, min(b) as root from reach group by 1) group by 1""",
    "apportion_quotas": f"with {_quota(97)} select tag, quota from q",
    "exact_schedule": f"""
      with {_quota("(select count(*) from documents)", 3)}, s as (select tag, unnest(range(0, quota)) as o from q),
      r as (select tag, row_number() over (order by sha256(concat('{_SEED}:languages:', tag, ':', o)), tag) - 1 as ordinal from s),
      d as (select doc_id, row_number() over (order by doc_id) - 1 as ordinal from documents)
      select r.ordinal, doc_id, tag from r join d using (ordinal)""",
    "weighted_roles": f"""
      with c as (select distinct cast(conv_id as varchar) as conversation_id from conversations), b as (select *, {_h8("conversation_id")} % 6 as p from c)
      select conversation_id, case when p < 3 then 'generator_a' when p < 4 then 'generator_b' else 'generator_c' end as role from b""",
    "planned_turns": f"with c as (select distinct cast(conv_id as varchar) as image_id from conversations) select image_id, {_turns('image_id')} as planned_turns from c",
    "instruction_candidates": f"""
      with tasks(position, task_id, family, required) as (values {_TASK_ROWS}),
      i as (select cast(doc_id as varchar) as image_id, case when doc_id % 3 = 0 then ['the visible image'] else ['left', 'right'] end as scopes from documents),
      x as (select image_id, scopes, list_filter({_CAPS}, lambda c: {_h8("concat(image_id, ':', c)")} % 100 < 50) as caps from i),
      ok as (select image_id, scopes, task_id, family, row_number() over (partition by image_id order by position) - 1 as k from x, tasks where list_has_all(caps, required)),
      s as (select image_id, task_id, family, scopes[cast(k % len(scopes) as int) + 1] as visible_scope from ok),
      c as (select *, sha256(concat('{_SEED}:', image_id, ':1:', task_id, ':', visible_scope)) as candidate_id from s),
      r as (select *, cast(row_number() over (partition by image_id order by sha256(concat('{_SEED}:', image_id, ':1:', candidate_id))) - 1 as int) as position from c)
      select image_id, task_id, family, visible_scope, candidate_id, position from r where position < 8""",
    "judge_consensus": f"with {_JUDGED} select lang, {_AGREE.format(a='a', b='b')} as verdict, count(*) as n from j group by 1, 2",
    "question_fit": f"""with {_JUDGED}, f as (select case when a = 'NOT_MET' then 'NOT_MET' when a = 'MET' and doc_id % 5 <> 0 then 'MET' else 'UNKNOWN' end as fit, b from j)
      select fit, {_AGREE.format(a='fit', b='b')} as agreed, count(*) as n from f group by 1, 2""",
    "gate_aggregate": f"""
      with r(template_id, applies_when, use) as (values {_RUBRIC_ROWS}),
      x as (select doc_id, quality, toxic, template_id, use, {_h8("concat(doc_id, ':', template_id)")} % 100 as k from labels, r),
      v as (select *, case when k < 90 then 'MET' when k < 93 then 'NOT_MET' when k < 96 then 'UNKNOWN' when k < 99 then 'NOT_APPLICABLE' else 'ERROR' end as raw, case when quality = 1 then 'MET' else 'NOT_MET' end as cover from x),
      o as (select doc_id, use, case template_id when 'C_COVERAGE' then {_AGREE.format(a='raw', b='cover')} when 'C_COMPUTATION' then case when doc_id % 4 = 1 then 'UNKNOWN' else raw end
        when 'C_SET_COMPLETE' then case when doc_id % 3 = 0 then case when raw = 'MET' then 'UNKNOWN' else raw end when toxic = 1 then 'NOT_MET' else raw end else raw end as verdict from v)
      select doc_id, count(*) as n_items, case when bool_or(use = 'gate' and verdict = 'ERROR') then 'ERROR' when bool_or(use = 'gate' and verdict = 'NOT_MET') then 'FAIL'
        when bool_or(use = 'gate' and verdict in ('UNKNOWN', 'NOT_EVALUATED')) then 'ABSTAIN' else 'PASS' end as aggregate from o group by 1""",
    "rubric_applicability": f"""
      with r(template_id, applies_when, use) as (values {_RUBRIC_ROWS}),
      x as (select doc_id, template_id from documents, r where {_predicates()}),
      s as (select template_id, unnest(case template_id when 'R_REQUIREMENT' then ['r1', 'r2'] when 'F_FORMAT' then ['f1', 'f2'] when 'C_CLAIM' then ['a1', 'a2'] when 'H_BINDING' then ['b1', 'b2'] else ['turn'] end) as subject_id from x)
      select template_id, subject_id, count(*) as n from s group by 1, 2""",
    "capability_report": f"""with {_JUDGED}, o as (select {_split("doc_id")} as split, lang as stratum, doc_id % 2 = 0 as want, {_AGREE.format(a='a', b='b')} as v from j)
      select split, stratum, count(*) as total, count(*) filter (v in ('MET', 'NOT_MET') and (v = 'MET') = want) as correct, count(*) filter (v not in ('MET', 'NOT_MET')) as unknown from o group by 1, 2""",
    "transcript_validity": f"""with {_MESSAGES}, n as (select *, row_number() over (partition by conversation_id order by position) - 1 as e from m)
      select conversation_id, count(*) as n_messages, bool_and(position = e) as contiguous, bool_and(role = case when e % 2 = 0 then 'user' else 'assistant' end) as alternating from n group by 1""",
    "history_prefix_hash": f"""
      with {_MESSAGES}, j as (select *, concat('{{"content":', {_json_text("content")}, ',"message_id":"', conversation_id, ':', case when position % 2 = 0 then 'q' else 'a' end, ':', position // 2 + 1, '","role":"', role, '","turn_index":', position // 2 + 1, '}}') as o from m)
      select a.conversation_id, cast(a.position // 2 + 1 as int) as turn_index, count(b.o) as n_history, sha256(concat('[', coalesce(string_agg(b.o, ',' order by b.position), ''), ']')) as history_hash
      from j a left join j b on a.conversation_id = b.conversation_id and b.position < a.position where a.position % 2 = 0 group by 1, 2""",
    "accepted_prefix": f"with {_TURNS} select * from acc",
    "trailing_turns": f"with {_TURNS} select t.status, count(*) as n from t join stops s using (conversation_id) where t.turn_index > s.at group by 1",
    "conversation_summary": f"""
      with {_TURNS}, d as (select *, case when cast(conversation_id as int) % 3 = 0 then 'unclassified' else concat('set', cast(conversation_id as int) % 3) end as dataset from acc)
      select dataset, status as key, count(*) as n from d group by 1, 2 union all select dataset, 'conversations', count(*) from d group by 1 union all select dataset, 'committed_turns', cast(sum(committed_turns) as bigint) from d group by 1""",
    "repeated_questions": f"""
      with {_MESSAGES}, u as (select conversation_id, position, content from m where role = 'user' union all select conversation_id, position + 100, concat('  ', upper(content), ' ?!') from m where role = 'user' and cast(conversation_id as int) % 2 = 0),
      n as (select conversation_id, position, rtrim(trim(regexp_replace({_FOLD.format("content")}, '\\s+', ' ', 'g')), '.!?。！？ ') as k from u)
      select conversation_id, position, first_position from (select *, min(position) over (partition by conversation_id, k) as first_position from n) where first_position < position""",
    "prompt_echo": f"""
      with d as (select doc_id, trim(regexp_replace({_FOLD.format("text")}, '\\s+', ' ', 'g')) as t from documents), p as (select item_id, trim(regexp_replace({_FOLD.format("text")}, '\\s+', ' ', 'g')) as s from benchmark)
      select doc_id as text_id, item_id as prompt_id from d join p on (length(s) >= 80 and contains(t, s)) or (length(t) >= 80 and contains(s, t))""",
    "answer_tokens": f"""with {_MESSAGES}, {_TOKENS} select conversation_id, position, len(words) as n_tokens,
      sha256(array_to_string(list_transform(range(1, len(words) + 1), lambda i: concat(cast(e[i] - length(words[i]) as bigint), ':', cast(e[i] as bigint), ':', words[i])), ' ')) as tokens_hash from ends""",
    "claim_spans": f"""with {_MESSAGES}, {_TOKENS} select conversation_id, position, case when len(words) >= 6 then substr(content, cast(e[3] - length(words[3]) as bigint) + 1, cast(e[6] - e[3] + length(words[3]) as bigint)) end as span,
      case when len(words) >= 6 then cast(e[3] - length(words[3]) as bigint) end as start_at, case when len(words) >= 6 then cast(e[6] as bigint) end as end_at from ends where role = 'assistant'""",
    "span_repair": f"""
      with {_MESSAGES}, q as (select *, substr(content, 4, 5) as quote from m where role = 'user'),
      o as (select *, list_filter(range(0, greatest(length(content) - length(quote), 0) + 1), lambda i: substr(content, i + 1, length(quote)) = quote) as hits from q)
      select conversation_id, position, quote, case when 7 + length(quote) <= length(content) and substr(content, 8, length(quote)) = quote then 7 when length(quote) > 0 and len(hits) = 1 then cast(hits[1] as bigint) end as start_at from o""",
    "training_export": f"""
      with {_MESSAGES}, n as (select *, row_number() over (partition by conversation_id order by position) - 1 as e from m),
      ok as (select conversation_id, count(*) as c from n group by 1 having bool_and(position = e and role = case when e % 2 = 0 then 'user' else 'assistant' end) and count(*) between 4 and 12),
      r as (select m.conversation_id, ok.c, string_agg(concat('{{"content":[', case when position = 0 then concat('{{"type":"image","text":null,"image":"img-', m.conversation_id, '"}},') else '' end,
        '{{"type":"text","text":', {_json_text("content")}, ',"image":null}}],"role":"', role, '"}}'), ',' order by position) as j from m join ok using (conversation_id) group by 1, 2)
      select conversation_id, c as n_messages, sha256(concat('{{"conversation_id":"', conversation_id, '","messages":[', j, ']}}')) as record_hash from r""",
    "set_compare": """
      with l as (select l_orderkey, l_linenumber, lpad(cast(l_partkey as varchar), 8, '0') as part, l_returnflag from lineitem),
      e as (select distinct l_orderkey, part from l),
      r as (select l_orderkey, part from l where l_returnflag <> 'R' union all select l_orderkey, unnest([max(part), 'extra']) from l where l_linenumber = 2 and l_orderkey % 3 = 0 group by 1),
      rc as (select l_orderkey, part, count(*) as n from r group by 1, 2),
      k as (select coalesce(e.l_orderkey, rc.l_orderkey) as l_orderkey, coalesce(e.part, rc.part) as part, e.part is not null as want, coalesce(n, 0) as n from e full join rc on e.l_orderkey = rc.l_orderkey and e.part = rc.part),
      s as (select l_orderkey, coalesce(string_agg(part, ',' order by part) filter (want and n = 0), '') as missing, coalesce(string_agg(part, ',' order by part) filter (not want), '') as unexpected,
        coalesce(string_agg(part, ',' order by part) filter (n > 1), '') as duplicates from k group by 1)
      select l_orderkey, case when missing = '' and unexpected = '' and duplicates = '' then 'MET' else 'NOT_MET' end as verdict, missing, unexpected, duplicates from s""",
    "count_compare": """
      with c as (select l_orderkey, l_returnflag as f, count(*) as n from lineitem group by 1, 2),
      s as (select l_orderkey, coalesce(string_agg(f, ',' order by f) filter (n < 2), '') as missing, coalesce(string_agg(f, ',' order by f) filter (n > 2), '') as unexpected from c group by 1)
      select l_orderkey, case when missing = '' and unexpected = '' then 'MET' else 'NOT_MET' end as verdict, missing, unexpected from s""",
    "exact_arithmetic": """
      select l_orderkey, count(*) as n, cast(sum(cast(l_extendedprice as decimal(18,2))) * 100 as bigint) as total_cents, case when count(*) < 2 or l_orderkey % 5 = 0 then 'NOT_MET' else 'MET' end as verdict from lineitem group by 1""",
    "computation_check": """
      select l_orderkey, case when l_orderkey % 11 = 0 then 'UNKNOWN' when l_orderkey % 7 = 0 or l_orderkey % 13 = 0 then 'NOT_MET' else 'MET' end as verdict from lineitem group by 1""",
    "requirement_ledger": """
      with recursive e as (select user_id as u, row_number() over w as k, list_extract(['introduce', 'retain', 'override', 'revoke', 'introduce'], cast(event_id % 5 + 1 as int)) as action,
        coalesce(concat('q', lag(event_id) over w), '') as old, concat('q', event_id) as new from events window w as (partition by user_id order by event_id)),
      s(u, k, active, stopped, error) as (select distinct user_id, cast(0 as bigint), cast([] as varchar[]), false, cast(null as varchar) from events
        union all select u, k, case when error is not null or action = 'retain' then active when action = 'introduce' then list_append(active, new)
          when action = 'revoke' then list_filter(active, lambda x: x <> old) else list_append(list_filter(active, lambda x: x <> old), new) end, stopped or error is not null, error
        from (select s.u, e.k, e.action, e.old, e.new, s.active, s.stopped, case when s.stopped then 'STOPPED' when action <> 'introduce' and not list_contains(s.active, old) then 'UNKNOWN_REQUIREMENT'
          when action in ('introduce', 'override') and new <> old and list_contains(s.active, new) then 'DUPLICATE_REQUIREMENT' end as error from s join e on s.u = e.u and e.k = s.k + 1))
      select coalesce(error, 'none') as error, count(*) as n, cast(max(len(active)) as int) as most_active from s where k > 0 group by 1""",
    "pool_bounds": f"""
      with {_POOL}, p as (select * from pool where purpose = 'training'), i as (select language, image_id, least(count(*), 3) as n from p group by 1, 2), g as (select language, visual_group_id, least(count(*), 6) as n from p group by 1, 2)
      select language, (select count(*) from p where p.language = l.language) as available, (select cast(sum(n) as bigint) from i where i.language = l.language) as by_image_id,
        (select cast(sum(n) as bigint) from g where g.language = l.language) as by_visual_group_id from (select distinct language from p) l""",
    "capped_selection": f"with {_POOL} select conversation_id, image_id, visual_group_id from chosen",
    "tight_selection": f"""
      with {_POOL}, p as (select * from pool where purpose = 'training' and language in ('BUILDING', 'MACHINERY'))
      select language, count(*) as available, cast((select count(distinct visual_group_id) // 2 from p) as bigint) as selected, 'OPTIMAL' as status, true as met from p group by 1""",
    "selection_audit": f"""
      with {_POOL}, facts as (select count(*) as n, max(i) as i, max(g) as g, bool_or(purpose = 'evaluation') as ev from (select *, count(*) over (partition by image_id) as i, count(*) over (partition by visual_group_id) as g from chosen)),
      l as (select language, count(*) as n from chosen group by 1)
      select 'selected' as key, n from facts union all select 'image_maximum', i from facts union all select 'visual_group_maximum', g from facts
      union all select concat('family:', task_family), count(*) from chosen group by 1
      union all select 'violation:TARGET_COUNT_MISMATCH', 1 from facts where n <> 150
      union all select 'violation:LANGUAGE_QUOTA_MISMATCH', 1 where (select count(*) from l) <> 1 or (select max(n) from l where language = 'BUILDING') <> 30
      union all select 'violation:IMAGE_MAXIMUM_EXCEEDED', 1 from facts where i > 1 union all select 'violation:VISUAL_GROUP_MAXIMUM_EXCEEDED', 1 from facts where g > 5
      union all select 'violation:EVALUATION_SOURCE_SELECTED', 1 from facts where ev""",
    "call_profile": f"""with {_CALLS} select stage, model_repo, count(*) as calls, cast(sum(input_tokens) as bigint) as input_tokens, cast(sum(input_tokens * 2) as bigint) as output_tokens,
      cast(sum(cast(round(value) as bigint)) as bigint) as total_duration_ms, round(sum(cast(round(value) as bigint)) / count(*), 2) as mean_duration_ms from done group by 1, 2""",
    "completion_gaps": f"""
      with {_CALLS}, g as (select *, greatest(0, coalesce(round((epoch_us(ts) - epoch_us(lag(ts) over (order by seq))) / 1000), 0)) as ms from done)
      select stage, model_repo, count(*) as calls, cast(sum(input_tokens) as bigint) as input_tokens, cast(sum(input_tokens * 2) as bigint) as output_tokens, cast(sum(ms) as bigint) as total_duration_ms from g group by 1, 2""",
    "run_wall": f"""
      with {_CALLS}, w as (select count(*) as n, greatest(0, cast(round((epoch_us(arg_max(ts, seq)) - epoch_us(arg_min(ts, seq))) / 1000) as bigint)) as ms from done)
      select n as completed_calls, ms as wall_duration_ms, case when ms > 0 then round(n / (ms / 60000), 2) else 0.0 end as calls_per_minute from w""",
    "first_write_wins": f"with {_CALLS} select stage, request_hash, min(seq) as seq, arg_min(status, seq) as status from c group by 1, 2",
    "cache_lookup": f"""
      with {_CALLS}, f as (select stage, request_hash, arg_min(status, seq) as status from c group by 1, 2),
      a as (select stage, case when seq % 7 = 0 then sha256(cast(seq as varchar)) else request_hash end as request_hash from c)
      select a.stage, count(*) as requests, count(f.status) as hits from a left join f on a.stage = f.stage and a.request_hash = f.request_hash and f.status = 'COMPLETE' group by 1""",
    "budget_running": """
      with e as (select user_id as run_id, event_id as seq, list_extract(['reserve', 'reserve', 'finalize', 'release'], cast(row_number() over (partition by user_id order by event_id) % 4 + 1 as int)) as action, event_id % 90 as actual from events),
      b as (select run_id, seq, action, cast(sum(case when action = 'reserve' then 1 else 0 end) over w as bigint) as requests, cast(sum(case when action = 'finalize' then actual else 0 end) over w as bigint) as output_tokens,
        cast(sum(case when action = 'reserve' then 100 else -100 end) over w as bigint) as reserved_tokens from e window w as (partition by run_id order by seq rows unbounded preceding))
      select run_id, seq, requests, output_tokens, reserved_tokens, case when action = 'reserve' and requests > 20 then 'REQUEST_BUDGET_EXHAUSTED' when action = 'reserve' and output_tokens + reserved_tokens > 1200 then 'OUTPUT_TOKEN_BUDGET_EXHAUSTED'
        when reserved_tokens < 0 then 'BUDGET_RESERVATION_MISMATCH' end as error from b""",
    "content_addressing": "select sha256(text) as digest, concat('texts/', substr(sha256(text), 1, 2), '/', sha256(text)) as path, max(octet_length(encode(text))) as n_bytes, count(*) as n_rows from documents group by 1, 2",
    "blob_roundtrip": "select lang, count(*) as n from documents group by 1",
    "ledger_verification": f"""with {_CALLS} select count(*) filter (event_id % 20 <> 1) as artifacts, count(*) filter (event_id % 20 <> 1 and event_id % 50 = 7) as corrupt, count(*) as model_calls,
      (select count(*) from done where seq % 20 = 1) as missing_responses from events""",
    "strict_json": """select case event_id % 6 when 1 then 'INVALID_JSON' when 2 then 'JSON_ROOT_NOT_OBJECT' when 3 then 'NON_FINITE_JSON_NUMBER' when 4 then 'DUPLICATE_JSON_KEY' else 'OK' end as outcome, count(*) as n from events group by 1""",
    "completion_envelopes": """select case when event_id % 31 = 0 then 'MODEL_CHOICE_COUNT' when event_id % 7 <> 0 and event_id % 17 = 0 then 'MODEL_FINISH_REASON' when event_id % 13 = 0 then 'MODEL_MESSAGE_INVALID'
      when event_id % 11 = 0 then 'MODEL_CONTENT_EMPTY' when event_id % 7 = 0 and event_id % 2 = 1 then 'MODEL_FINISH_REASON' when event_id % 1100 > 1024 then 'MODEL_USAGE_INVALID' else 'OK' end as outcome, count(*) as n from events group by 1""",
    "media_suffixes": """select case when page_id % 3 = 0 then '.png' when page_id % 2 = 0 then '.jpeg' else 'unsupported' end as suffix, count(*) as n from pages group by 1""",
    "remaining_turns": f"""
      with c as (select distinct cast(conv_id as varchar) as conversation_id from conversations), p as (select conversation_id, {_turns("conversation_id")} as n from c)
      select conversation_id, cast(unnest(range(case when cast(conversation_id as int) % 2 = 0 then 3 else 1 end, n + 1)) as int) as turn_index from p""",
}
