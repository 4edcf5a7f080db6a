"""DuckDB SQL for the queries that SQL expresses at reasonable cost."""
from __future__ import annotations

from . import chat_rotation, line_dedup, mixing, quality_rules
from .oracle_trees import MERKLE, TRIE

#: Whole weights of the sources, earliest deadline first slot by slot over their windows (release
#: j m / w rounded down, deadline (j + 1) m / w rounded up; all blocks of a source compete, also
#: after its rows have run out), and the rows' places. One stretch of the operator: up to
#: mixing.PERIOD slots, as with up to 64,000 rows of even sources.
MIX = f"""
with recursive sized as (select source, count(*) as n, sqrt(cast(count(*) as double)) as weight from documents group by source),
weighed as (select source, (n + {mixing.BLOCK_ROWS} - 1) // {mixing.BLOCK_ROWS} as blocks, greatest(cast(round(weight / sum(weight) over () * {mixing.WEIGHT_UNITS}) as bigint), 1) as w,
                   row_number() over (order by source nulls last) as no from sized),
one as (select list(w order by no) as ws, cast(sum(w) as bigint) as m from weighed having count(*) > 0),
ends as (select max((blocks * m + w - 1) // w) as stop from weighed, one),
slots(t, had, best) as (
  select cast(-1 as bigint), list_transform(ws, lambda x: 0::bigint), cast(0 as bigint) from one
  union all
  select t + 1, list_transform(had, lambda x, i: x + case when i = b then 1 else 0 end), b
  from (select t, had, list_sort(list_filter(list_transform(had, lambda x, i: struct_pack(
               due := case when x * m // ws[i] <= t + 1 then ((x + 1) * m + ws[i] - 1) // ws[i] end, i := cast(i as bigint))), lambda d: d.due is not null))[1].i as b
        from slots, one, ends where t + 1 < stop) s),
plan as (select best as no, t as slot, row_number() over (partition by best order by t) - 1 as b from slots where t >= 0),
placed as (select d.doc_id, d.source, s.no, s.w, row_number() over (partition by d.source order by md5(cast(d.doc_id as varchar)), d.doc_id) - 1 as place
           from documents d join weighed s on d.source is not distinct from s.source)
select doc_id, source, cast(p.b as bigint) as mix_block, cast(p.b * m // placed.w as bigint) as mix_release,
       cast(((p.b + 1) * m + placed.w - 1) // placed.w as bigint) as mix_deadline, p.slot as mix_slot, cast(place % {mixing.BLOCK_ROWS} as integer) as mix_row
from placed join plan p on p.no = placed.no and p.b = place // {mixing.BLOCK_ROWS}, one
"""

CHAT = f"""
with turns as (
  select conv_id, turn, case when trim(coalesce(role, '')) = '' then '{chat_rotation.NOBODY}' else regexp_replace(trim(role), '[ \\t\\n\\x0B\\f\\r<>|]+', '_', 'g') end as name,
         regexp_replace(coalesce(text, ''), '<\\|(im_start|im_end)\\|>', '<| \\1 |>', 'g') as body, coalesce(turn // {chat_rotation.PART_TURNS}, -1) as part
  from conversations),
placed as (select *, (row_number() over (partition by conv_id, part order by turn nulls first, name, body) - 1) // {chat_rotation.PART_TURNS} as piece from turns),
speakers as (select distinct conv_id, name as perspective from turns where name <> '{chat_rotation.SYSTEM}'),
pieces as (
  select t.conv_id, perspective, part, piece, turn, name, body, name = perspective as own,
         '{chat_rotation.START}' || case when name = perspective then 'assistant' when name = '{chat_rotation.SYSTEM}' then '{chat_rotation.SYSTEM}' else 'user name=' || name end || chr(10) as head,
         body || '<|im_end|>' || chr(10) as rest
  from placed t join speakers s on t.conv_id is not distinct from s.conv_id),
numbered as (select *, row_number() over w as i, sum(length(head) + length(rest)) over (w rows between unbounded preceding and current row) as stop
             from pieces window w as (partition by conv_id, perspective, part, piece order by turn nulls first, name, body))
select conv_id, perspective, cast(part as bigint) as part, cast(piece as bigint) as piece, string_agg(head || rest, '' order by i) as text, count(*) as n_turns,
       cast(max(stop) as bigint) as n_chars,
       coalesce(string_agg(concat(stop - length(rest), ':', stop), ',' order by i) filter (where own), '') as train_spans,
       string_agg(case when own then '1' else '0' end, '' order by i) as train_mask
from numbered group by conv_id, perspective, part, piece
"""

_TRIM = r"regexp_replace(x, '^[ \t\x0B\f\r]+|[ \t\x0B\f\r]+$', '', 'g')"
LINES = f"""
with pages as (select distinct source as host, text from documents),
totals as (select host, count(*) as total from pages group by host),
lines as (select distinct host, text, unnest(list_transform(string_split(text, chr(10)), lambda x: {_TRIM})) as line from pages),
often as (select host, line, count(*) as pages from lines where line <> '' group by host, line having count(*) >= {line_dedup.MIN_PAGES}),
cut as (select o.host, list(line) as keys from often o join totals t on o.host is not distinct from t.host
        where o.pages > {line_dedup.MAX_RATIO} * total group by o.host),
kept as (select doc_id, source, text, string_split(text, chr(10)) as a,
                list_filter(string_split(text, chr(10)), lambda x: not list_contains(coalesce(keys, []), {_TRIM})) as b
         from documents d left join cut c on d.source is not distinct from c.host)
select doc_id, source, case when text is null then null else array_to_string(b, chr(10)) end as text,
       cast(coalesce(len(a) - len(b), 0) as bigint) as n_dropped_lines
from kept
"""

_BITS = quality_rules.BIT
QUALITY = rf"""
with docs as (select row_number() over () as r, doc_id, coalesce(text, '') as text from documents),
words as (select r, unnest(w) as word, generate_subscripts(w, 1) as i from (select r, regexp_extract_all(text, '[^\x20\x09-\x0D]+') as w from docs) x),
windows as (select r, i, word as a, lead(word) over v as b, lead(word, 2) over v as c from words window v as (partition by r order by i)),
twice as (select w.r, w.i from windows w join (select r, a, b, c from windows where c is not null group by r, a, b, c having count(*) > 1) t
          on w.r = t.r and w.a = t.a and w.b = t.b and w.c = t.c),
covered as (select r, count(distinct i + k) as n_repeat_words from twice, (values (0), (1), (2)) o(k) group by r),
counted as (select r, count(*) as n_words, sum(length(word)) as word_chars, sum(length(regexp_replace(word, '[^\p{{L}}]', '', 'g'))) as n_letters,
                   sum(length(regexp_replace(word, '[^A-ZÀ-ÖØ-Þ]', '', 'g'))) as n_upper from words group by r),
tops as (select r, max(n) as top_word_count from (select r, word, count(*) as n from words group by r, word) x group by r),
lines as (select r, line, count(*) as n from (select r, unnest(string_split(text, chr(10))) as line from docs) x
          where regexp_matches(line, '[^\x20\x09-\x0D]') group by r, line),
dups as (select r, sum(n) as n_lines, sum(n - 1) as n_dup_lines from lines group by r),
ledger as (
  select doc_id, cast(coalesce(n_words, 0) as bigint) as n_words, cast(coalesce(word_chars, 0) as bigint) as word_chars,
         cast(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) as bigint) as n_symbols, cast(coalesce(n_dup_lines, 0) as bigint) as n_dup_lines,
         cast(coalesce(n_repeat_words, 0) as bigint) as n_repeat_words, cast(coalesce(n_lines, 0) as bigint) as n_lines,
         cast(coalesce(n_letters, 0) as bigint) as n_letters, cast(coalesce(n_upper, 0) as bigint) as n_upper, cast(coalesce(top_word_count, 0) as bigint) as top_word_count
  from docs left join counted using (r) left join tops using (r) left join dups using (r) left join covered using (r)),
masked as (
  select *, cast(case when n_words < 50 then {_BITS['too_few_words']} else 0 end + case when 100 * n_repeat_words > 50 * n_words then {_BITS['repeated_windows']} else 0 end
    + case when n_symbols > {quality_rules.MAX_SYMBOLS_PER_WORD}::double * n_words then {_BITS['symbol_words']} else 0 end
    + case when n_dup_lines > {quality_rules.MAX_DUP_LINE_SHARE}::double * n_lines then {_BITS['duplicate_lines']} else 0 end
    + case when word_chars < {quality_rules.MIN_MEAN_WORD}::double * n_words or word_chars > {quality_rules.MAX_MEAN_WORD}::double * n_words then {_BITS['odd_word_length']} else 0 end
    + case when n_letters < {quality_rules.MIN_LETTER_SHARE}::double * word_chars then {_BITS['few_letters']} else 0 end
    + case when n_upper > {quality_rules.MAX_UPPER_SHARE}::double * n_letters then {_BITS['shouting']} else 0 end
    + case when top_word_count > {quality_rules.MAX_TOP_WORD_SHARE}::double * n_words then {_BITS['top_word']} else 0 end as bigint) as failure_mask
  from ledger)
select *, failure_mask & 3 <> 0 as base_failed, failure_mask = 0 as kept from masked
"""

_V2 = quality_rules.policy_mask("v2")
ABLATION = f"""
with judged as ({QUALITY}),
masks as (select failure_mask & {_V2} as mask, count(*) as n from judged group by 1),
rules as (select * from (values {", ".join(f"('{r}', {b}::bigint)" for r, b in _BITS.items() if b & _V2)}) v(rule, bit))
select rule, bit, cast(coalesce(sum(n) filter (where mask & bit <> 0), 0) as bigint) as n_failed, cast(coalesce(sum(n) filter (where mask = bit), 0) as bigint) as n_only_this_rule,
       cast(coalesce(sum(n) filter (where mask = 0), 0) as bigint) as n_kept, cast(coalesce(sum(n) filter (where mask & ~bit = 0), 0) as bigint) as n_kept_without
from masks, rules group by rule, bit
"""

ORACLE_SQL = {"quality_ablation": ABLATION, "op1_mix_sources": MIX, "op3_chat_rotation": CHAT, "op5_line_dedup": LINES, "op6_quality_rules": QUALITY,
              "op11_conversation_trie": TRIE, "op12_merkle_manifest": MERKLE}
