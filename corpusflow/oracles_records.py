"""SQL for the queries of ``queries_records``, run by DuckDB on the same tables."""

from __future__ import annotations

from corpusflow.functions.catalogs import SCOPES, STAGE_FIELDS, rubric
from corpusflow.oracles import _CALLS, _CAPS, _MESSAGES, _METADATA, _POOL, _SEED, _TASK_ROWS, _TURNS, _UNIT, _h8, _split, _turns, _values
from corpusflow.oracles import ORACLE_SQL as _CORE

_STAGES = _values([(s, f.replace(" ", ",")) for s, f in STAGE_FIELDS.items()])
_FIELDS = _values([(s, ",".join(sorted({"target_language", "question", *({"candidate_answer", "image_views"} & set(f))}))) for s, f in SCOPES.items()])
_AXES = _values([(axis, scope, use) for _, axis, _, scope, use in rubric()])
_ALWAYS = _values([(t,) for t, _, when, _, _ in rubric() if when == "always"])

_ASKED = f"""{_MESSAGES}, asked as (select concat(conversation_id, case when position % 2 = 0 then ':q:' else ':a:' end, position // 2 + 1) as id, concat('  Please ', content, ' ?!') as c from m where role = 'user'),
  quoted as (select id, 'content' as kind, 'persistent' as lifetime, c, c as q, 0 as place from asked
    union all select id, 'format', 'local', c, substr(c, 10, 12), case when substr(c, 3, length(substr(c, 10, 12))) = substr(c, 10, 12) then 2
      when strpos(substr(c, strpos(c, substr(c, 10, 12)) + 1), substr(c, 10, 12)) = 0 then strpos(c, substr(c, 10, 12)) - 1 end from asked),
  cleaned as (select *, regexp_replace(q, '[ \\t\\r\\n.,;:?!]+$', '') as t, length(q) - length(regexp_replace(q, '^\\s+', '')) as space from quoted),
  cut as (select *, space + case when kind = 'content' then length(substr(t, space + 1)) - length(regexp_replace(substr(t, space + 1), '^(?i)(?:please\\s+|can you\\s+)', '')) else 0 end as cut from cleaned),
  spans as (select id, kind, lifetime, place is not null and cut < length(t) as ok, place + cut as start_at, place + length(t) as end_at, substr(t, cut + 1) as text from cut)"""

ORACLE_SQL: dict[str, str] = {
    "metadata_scan": f"with m as ({_METADATA}) select Subset, License, count(*) as n from m group by 1, 2",
    "jsonl_roundtrip": "select lang, count(*) as n, cast(sum(length(text)) as bigint) as chars from documents group by 1",
    "json_lines": """
      with d as (select cast(coalesce(to_json(source), 'null') as varchar) as s, doc_id, cast(coalesce(to_json(lang), 'null') as varchar) as l from documents)
      select concat('{"doc_id":', doc_id, ',"lang":', l, ',"source":', s, '}') as line, 'compact' as form from d
      union all select concat('{"source": ', s, ', "doc_id": ', doc_id, ', "lang": ', l, '}'), 'spaced' from d""",
    "file_digests": "select item_id, cast(octet_length(encode(text)) + 1 as bigint) as length, sha256(concat(text, chr(10))) as sha256 from benchmark",
    "fixture_keys": f"""
      with c as (select lang, split, stratum, number, accept, concat({_SEED}, ':', lang, ':', split, ':', stratum, ':', number) as k
        from (select distinct lang from documents where lang is not null), (values ('development'), ('confirmation')) p(split), range(3) t(number), (values (true), (false)) a(accept),
          (values ('attribute_spatial'), ('count_set'), ('text_language'), ('table_calculation'), ('format_constraint'), ('history_transition'), ('limitation_false_premise'), ('policy_injection')) s(stratum))
      select sha256(concat(k, case when accept then ':True' else ':False' end)) as fixture_id, sha256(k) as image_id, split, stratum, lang as target_language, number, accept as expected_accept from c""",
    "blob_store": "select count(distinct text) as first_count, count(distinct text) as second_count from documents",
    "run_copy": "select count(*) as artifacts, cast(0 as bigint) as corrupt, count(*) as model_calls, cast(0 as bigint) as missing_responses from events",
    "ledger_columns": "select event_type as stage, count(*) as calls, cast(0 as bigint) as duration_ms from events group by 1",
    "image_files": """
      select 'read' as reason, count(*) as n, cast(sum(octet_length(encode(text)) + 1) as bigint) as bytes from benchmark
      union all select reason, count(*), 0 from benchmark, (values ('IMAGE_NOT_FILE'), ('IMAGE_PATH_ESCAPE')) t(reason) group by 1""",
    "ingest_plan": f"""
      with s as (select page_id as k, case when page_id % 3 = 1 then 'evaluation' else 'training' end as purpose, sha256(cast(page_id // 40 as varchar)) as pixel from pages),
      r as (select *, case when k % 5 in (2, 3) or purpose = 'training' and k % 5 <> 0 then 'RIGHTS_NOT_PERMITTED' when k % 13 = 0 then 'IMAGE_NOT_FILE' when k % 10 = 0 then 'IMAGE_FORMAT_UNSUPPORTED'
        when k % 200 + 100 < 128 then 'IMAGE_EDGE_TOO_SHORT' end as reason, sha256(concat('{{"pixel":"', pixel, '","source_id":"p', k, '"}}')) as id from s),
      g as (select pixel, bool_or(purpose = 'evaluation') as e, sha256(concat('[', string_agg(concat('"', id, '"'), ',' order by id), ']')) as g from r where reason is null group by 1)
      select case when e then 'evaluation' else 'training' end as purpose, case when e then 'evaluation' else {_split("g")} end as split, count(*) as n from r join g using (pixel) where reason is null group by 1, 2
      union all select reason, 'failed', count(*) from r where reason is not null group by 1""",
    "export_bundle": """
      with c as (select conv_id, count(*) as n from conversations where conv_id % 3 = 0 group by 1)
      select part, cast(case when part in ('training', 'selection') then count(*) else sum(n) end as bigint) as n, count(*) as conversations from c, (values ('training'), ('ratings'), ('provenance'), ('selection')) p(part) group by 1""",
    "two_writers": f"""
      with {_CALLS}, b as (select count(distinct text) as n from documents), k as (select count(*) as n from (select distinct stage, request_hash from c))
      select 'blobs' as kind, n as n_rows, n as n_keys, n as n_added from b union all select 'calls', n, n, n from k""",
    "synthesis_resume": """
      with c as (select cast(conv_id as varchar) as c, least(2, greatest(1, count(*) // 2)) as planned from conversations group by conv_id),
      tried as (select c, t, call, min(a) filter (cast('0x' || substr(sha256(concat_ws(':', c, t, call, a)), 1, 4) as int) % 4 <> 0) as good
        from c, range(1, 3) r(t), range(2) s(a), (values ('question_generation'), ('answer_generation'), ('review_a'), ('review_b'), ('answer_repair'), ('repaired_review_a'), ('repaired_review_b')) k(call) group by all),
      wide as (select c, t, max(good) filter (call = 'question_generation') as q, max(good) filter (call = 'answer_generation') as a, max(good) filter (call = 'review_a') as ra, max(good) filter (call = 'review_b') as rb,
        max(good) filter (call = 'answer_repair') as m, max(good) filter (call = 'repaired_review_a') as sa, max(good) filter (call = 'repaired_review_b') as sb,
        cast('0x' || substr(sha256(concat_ws(':', c, t, 'verdict', 'False')), 1, 4) as int) % 3 <> 0 as met, cast('0x' || substr(sha256(concat_ws(':', c, t, 'verdict', 'True')), 1, 4) as int) % 3 <> 0 as mended from tried group by all),
      state as (select *, q is not null and a is not null and ra is not null and rb is not null as judged from wide),
      turn as (select *, judged and not met and m is not null as repaired, case when not judged then 'ERROR' when met then 'COMMITTED' when m is null then 'REJECTED' when sa is null or sb is null then 'ERROR' when mended then 'COMMITTED' else 'REJECTED' end as status,
        case when q is null or a is null then 'MODEL_CONTENT_EMPTY' when not judged or (not met and m is not null and (sa is null or sb is null)) then 'MODEL_SCHEMA_MISMATCH' else '-' end as failure from state),
      made as (select turn.* from turn join c using (c) where t = 1 or (planned = 2 and exists (select 1 from turn f where f.c = turn.c and f.t = 1 and f.status = 'COMMITTED'))),
      asked as (select 'question_generation' as call, q as good from made union all select 'answer_generation', a from made where q is not null union all select 'review_a', ra from made where q is not null and a is not null
        union all select 'review_b', rb from made where q is not null and a is not null and ra is not null union all select 'answer_repair', m from made where judged and not met
        union all select 'repaired_review_a', sa from made where repaired union all select 'repaired_review_b', sb from made where repaired and sa is not null),
      record as (select call, a from asked, range(2) r(a) where a <= coalesce(good, 1))
      select concat_ws(' ', t, status, repaired, failure) as name, count(*) as n from made group by 1 union all select concat_ws(' ', call, a), count(*) from record group by 1 union all select 'calls made', count(*) from record""",
    "requirement_stream": _CORE["requirement_ledger"],
    "stream_append": "select event_type, count(distinct user_id) as n from events group by 1",
    "windowed_rates": f"with {_CALLS} select strftime(time_bucket(interval 1 hour, ts), '%Y-%m-%d %H') as hour, stage, count(*) as calls, cast(sum(2 * input_tokens) as bigint) as output_tokens from c group by 1, 2",
    "catalog_capabilities": f"""
      with tasks(position, task_id, family, required) as (values {_TASK_ROWS}), need as (select unnest(required) as capability, count(*) as tasks from tasks group by 1),
      shown as (select capability, count(*) as images from documents, (select unnest({_CAPS}) as capability) where {_h8("concat(doc_id, ':', capability)")} % 100 < 50 group by 1)
      select capability, tasks, coalesce(images, 0) as images from need left join shown using (capability)""",
    "rubric_catalog": f"select axis, input_scope, use, count(*) as n from (values {_AXES}) r(axis, input_scope, use) group by 1, 2, 3",
    "stage_fields": f"select stage, fields, 'MODEL_INFORMATION_LEAK' as forbidden, 'MODEL_PAYLOAD_FIELD' as unknown from (values {_STAGES}) s(stage, fields)",
    "scope_fields": f"select input_scope, fields, (select count(*) from conversations) as n from (values {_FIELDS}) s(input_scope, fields)",
    "language_gates": r"""
      with d as (select lang, case doc_id % 9 when 0 then concat(' ', chr(9), ' ') when 1 then '12 % !' else text end as t from documents)
      select lang, regexp_matches(t, '\p{L}') as letters, coalesce(regexp_matches(t, '\S'), false) as filled, count(*) as n from d group by 1, 2, 3""",
    "model_outputs": f"with {_MESSAGES} select conversation_id, position, case when content is null or position % 4 = 2 then 'UNSUPPORTED' else 'OK' end as status, cast(case when position % 4 <> 2 then length(content) end as int) as chars from m",
    "joined_reasons": "with r as (select doc_id, substr(concat_ws(' | ', lang, source, substr(text, 1, 400)), 1, 240) as r from documents) select doc_id, cast(length(r) as int) as chars, sha256(r) as digest from r",
    "evaluation_spread": """
      with g as (select sha256(text) as g, max(doc_id % 37 = 0) as e from documents group by 1)
      select lang, case when e then 'evaluation' else 'training' end as purpose, count(*) as n from documents d join g on sha256(d.text) = g.g group by 1, 2""",
    "training_exclusions": f"with m as ({_METADATA}) select distinct ImageID as image_id from m where page_id % 5 = 0 or page_id % 3 = 0 or page_id % 7 = 0",
    "manifest_errors": "select * from (values ('rights', 'OK'), ('rights repeated', 'DUPLICATE_RIGHTS_ID'), ('rights window', 'RIGHTS_WINDOW'), ('rights missing', 'RIGHTS_REFERENCE_MISSING')) t(checked, outcome)"
    + "".join(
        f" union all select '{t}.{k}', case when count(*) > count(distinct {k}) then 'DUPLICATE_ID' else 'OK' end from {t}"
        for t, k in (("documents", "doc_id"), ("documents", "source"), ("embeddings", "vec_id"), ("lineitem", "l_orderkey"), ("orders", "o_orderkey"))
    ),
    "chosen_instructions": f"""
      with c as ({_CORE["instruction_candidates"]}),
      a as (select cast(doc_id as varchar) as image_id, doc_id % 10 as place from documents),
      s as (select a.image_id, place, case when place = 9 then 'unknown' else candidate_id end as id, task_id from a left join c on a.image_id = c.image_id and a.place = c.position)
      select image_id, 1 as turn_index, case when place <> 9 then id end as candidate_id, case when place <> 9 then task_id end as task_id, case when id is null then 'NO_SUITABLE_CANDIDATE' else 'SELECTED' end as status from s""",
    "message_references": f"""
      with {_MESSAGES} select a.conversation_id, a.position, case when b.position is not null then concat(b.conversation_id, case when b.position % 2 = 0 then ':q:' else ':a:' end, b.position // 2 + 1) end as source_message_id
      from m a left join m b on a.conversation_id = b.conversation_id and b.position = a.position - 1""",
    "first_dialogues": "with d as (select lpad(cast(doc_id as varchar), 12, '0') as image_id from documents) select * from (select row_number() over (order by image_id) - 1 as ordinal, image_id from d) where ordinal < 100",
    "detailed_status": f"""
      with {_TURNS} select conversation_id, committed_turns, case when status = 'QUALITY_CANDIDATE' and committed_turns <> {_turns("conversation_id")} then 'REJECTED' else status end as status from acc""",
    "export_reasons": """
      with c as (select conv_id as k, count(*) // 2 as n from conversations group by 1)
      select case when k % 23 = 0 then 'PILOT_EXPORT_FORBIDDEN' when k % 19 = 0 then 'AUDIT_REQUIRED' when k % 17 = 0 then 'CONVERSATION_NOT_ACCEPTED' when k % 13 = 0 then 'EVALUATION_IMAGE_EXPORT'
        when n not between 2 and 6 then 'TURN_COUNT_INVALID' when k % 11 = 0 and n <> 1 then 'UNCOMMITTED_TURN_EXPORT' else 'EXPORTED' end as reason, count(*) as n from c group by 1""",
    "candidate_patterns": f"""
      with {_MESSAGES}, q as (select * from m where role = 'user')
      select conversation_id, concat('family', min(position) % 3) as task_family, sha256(concat('[', string_agg(concat('"task', position, '"'), ',' order by position), ']')) as semantic_family,
        string_agg(case when position % 4 = 0 then 'normal' else 'limitation' end, '/' order by position) as pattern from q group by 1""",
    "progress_counts": "select event_id as ordinal, event_type as status, count(*) over (partition by event_type order by event_id rows unbounded preceding) as n_so_far from events",
    "set_verification": """
      with g as (select l_orderkey as k, count(distinct l_partkey) as e, count(distinct l_partkey) filter (l_returnflag <> 'R') as r from lineitem group by 1)
      select k as l_orderkey, case when k % 11 = 0 or k % 13 = 0 then null when k % 2 = 0 then case when k % 5 = 0 then 'NOT_MET' else 'MET' end when e = r then 'MET' else 'NOT_MET' end as verdict from g""",
    "requirement_spans": f"""
      with {_ASKED} select id as source_message_id, kind, cast(case when ok then start_at end as bigint) as start_at, cast(case when ok then end_at end as bigint) as end_at, case when ok then sha256(text) end as text_hash from spans""",
    "requirement_inventories": f"""
      with {_ASKED}, marked as (select *, {_h8("id")} % 10 as mark from spans),
      used as (select *, sha256(concat('{{"end":', end_at, ',"kind":"', kind, '","lifetime":"', lifetime, '","source_message_id":"', id, '","start":', start_at, ',"text":', to_json(text), '}}')) as rid from marked where kind = 'content' or mark % 2 = 1),
      g as (select id, any_value(mark) as mark, bool_and(ok) as ok, count(*) as n, count(distinct rid) as d, string_agg(rid, ',' order by start_at, end_at, kind, lifetime) as ids from used group by 1)
      select id as key, cast(case when ok and mark not in (3, 5) and n = d then n end as int) as n, case when ok and mark not in (3, 5) and n = d then ids end as ids from g""",
    "claim_unions": f"""
      with {_MESSAGES}, a as (select concat(conversation_id, ':', position) as key, content as c, substr(content, 1, 6) as x, substr(content, 4, 9) as y from m where role = 'assistant'),
      p as (select *, case when 5 + length(y) <= length(c) and substr(c, 6, length(y)) = y then 5 when y <> '' and strpos(substr(c, strpos(c, y) + 1), y) = 0 then strpos(c, y) - 1 end as place from a),
      s as (select key, case when length(c) >= 3 and place is not null then list_distinct([[0, length(x)], [3, 3 + length(y)], [place, place + length(y)]]) end as spans from p)
      select key, cast(len(spans) as int) as n, array_to_string(list_transform(list_sort(spans), lambda v: concat(v[1], ':', v[2])), ',') as spans from s""",
    "identities": """
      with r as (select event_id, event_type, sha256(concat('{"model_lock":"lock","request":"', user_id, '"}')) as h from events)
      select event_id, h as request_hash, sha256(concat('{"request":"', h, '","run":"run","stage":"', event_type, '"}')) as call_id from r""",
    "image_identities": """select page_id, sha256(concat('{"pixel":"', sha256(html), '","source_id":', to_json(url), '}')) as image_id from pages""",
    "item_identities": f"""
      with {_MESSAGES}, t as (select conversation_id, cast(position // 2 + 1 as int) as turn_index from m where role = 'user')
      select conversation_id, turn_index, template_id, sha256(concat('{{"attempt":0,"context_hash":"context","conversation_id":"', conversation_id, '","subject_id":"turn","template_id":"', template_id, '","turn_index":', turn_index, '}}')) as item_id
      from t, (values {_ALWAYS}) r(template_id)""",
    "pool_identity": f"""
      with {_POOL} select sha256(concat('[', string_agg(concat('{{"conversation_id":"', conversation_id, '","image_id":"', image_id, '","language":"', language, '","pattern":"normal/normal","purpose":"', purpose,
        '","semantic_family":"', conversation_id, '","task_family":"', task_family, '","visual_group_id":"', visual_group_id, '"}}'), ',' order by conversation_id), ']')) as pool_hash from pool""",
    "commits": """
      with z as (select count(*) filter (conv_id = 0) > 0 as known, count(*) as n from conversations)
      select 'new turns' as attempt, 'OK' as outcome, n as rows from z union all select 'turns already there', 'DUPLICATE_COMMIT', 0 union all select 'repeated turns', 'DUPLICATE_COMMIT', 0 union all select 'new run', 'OK', 1
      union all select 'same run', 'OK', case when known then 0 else 1 end from z union all select 'other configuration', case when known then 'RUN_CONFIG_MISMATCH' else 'OK' end, 0 from z""",
    "visual_grouping": f"""
      with recursive {_UNIT}, k as (select vec_id as id, case when vec_id % 5 = 0 then vec_id // 15 end as pixel, case when vec_id % 7 = 0 then vec_id // 21 end as declared from embeddings),
      l as (select left_id as a, right_id as b from near where c >= 0.45 union select x.id, y.id from k x join k y on x.pixel = y.pixel and x.id < y.id union select x.id, y.id from k x join k y on x.declared = y.declared and x.id < y.id),
      e as (select a, b from l union all select b, a from l), reach(a, b) as (select id, id from k union select r.a, e.b from reach r join e on r.b = e.a),
      root as (select a, min(b) as root from reach group by 1),
      ids as (select root, sha256(concat('[', string_agg(concat('"', a, '"'), ',' order by cast(a as varchar)), ']')) as visual_group_id from root group by 1)
      select a as image_id, visual_group_id from root join ids using (root)""",
}
