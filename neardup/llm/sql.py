"""DuckDB twins of the queries that SQL can express."""

from __future__ import annotations

_OP4 = r"""
with w as (
  select doc_id, coalesce(text, '') as text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws,
    list_filter(string_split(coalesce(text, ''), chr(10)),
      lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as ls
  from documents
), windows as (
  select doc_id, i, array_to_string(ws[i : i + 7], ' ') as win
  from (select doc_id, ws, unnest(range(1, len(ws) - 6)) as i from w)
), repeated as (
  select doc_id, i from (
    select doc_id, i, count(*) over (partition by doc_id, win) as n from windows
  ) where n > 1
), covered as (
  select doc_id, sum(least(8, i - coalesce(prev, i - 8)))::bigint as n from (
    select doc_id, i, lag(i) over (partition by doc_id order by i) as prev from repeated
  ) group by doc_id
), m as (
  select w.doc_id, len(ws)::bigint as n_words,
    length(array_to_string(ws, ''))::bigint as word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::bigint as n_symbols,
    (len(ls) - len(list_distinct(ls)))::bigint as n_dup_lines,
    coalesce(covered.n, 0)::bigint as n_repeat_words,
    len(ls)::bigint as n_lines,
    length(regexp_replace(text, '[^!]+', '', 'g'))::bigint as n_exclamations
  from w left join covered using (doc_id)
), b as (
  select *,
    (case when n_words < 20 then 1 else 0 end
    + case when 100 * n_repeat_words > 30 * n_words then 2 else 0 end
    + case when 100 * n_symbols > 10 * n_words then 4 else 0 end
    + case when 100 * n_dup_lines > 30 * n_lines then 8 else 0 end
    + case when word_chars < 2 * n_words or word_chars > 15 * n_words then 16 else 0 end
    + case when 100 * n_exclamations > 10 * n_words then 32 else 0 end)::bigint as fail_bits
  from m
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  (fail_bits & 3) <> 0 as base_failed, (fail_bits & 39) = 0 as kept, fail_bits,
  case fail_bits & 39 when 1 then 'few_words' when 2 then 'repeated_windows' when 4 then 'symbols'
    when 32 then 'exclamations'
  end as only_rule
from b
"""

_FILL = """
{name}_in as (
  select {group}, {cap} as c, {weight} as w, {budget} as b from {source}
), {name}_open as (
  select *, w > 0 and c * sum(w) over (
      partition by {parent} order by case when w > 0 then c::double / w::double end nulls last, {own}
      rows between current row and unbounded following)
    + w * coalesce(sum(c) over (
      partition by {parent} order by case when w > 0 then c::double / w::double end nulls last, {own}
      rows between unbounded preceding and 1 preceding), 0) <= b * w as is_full
  from {name}_in
), {name} as (
  select *, case when is_full then c when w > 0 then
      (b - coalesce(sum(case when is_full then c end) over (partition by {parent}), 0)) * w
      // sum(case when not is_full then w end) over (partition by {parent})
    else 0 end as own
  from {name}_open
)
"""

_OP8 = (
    r"""
with d as (
  select doc_id, lang, source,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as n,
    'domain' || (coalesce(try_cast(regexp_extract(source, '([0-9]+)$', 1) as int), 0) % 4) as l0,
    coalesce(lang, '') as l1, coalesce(source, '') as l2
  from documents
), leaf as (
  select l0, l1, l2, sum(n)::hugeint as t from d group by all
), l0s as (
  select l0, sum(t) * 2 as cap from leaf group by all
), l1s as (
  select l0, l1, sum(t) * 2 as cap from leaf group by all
), l2s as (
  select l0, l1, l2, sum(t) * 2 as cap from leaf group by all
), """
    + _FILL.format(
        name="f0",
        group="l0",
        cap="cap",
        weight="(case l0 when 'domain0' then 4 when 'domain1' then 3 "
        "when 'domain2' then 2 else 1 end)::hugeint",
        budget="(select sum(t) * 70 // 100 from leaf)",
        source="l0s",
        parent="0",
        own="l0",
    )
    + ", "
    + _FILL.format(
        name="f1",
        group="l0, l1",
        cap="cap",
        weight="(case l1 when 'en' then 3 else 1 end)::hugeint",
        budget="own",
        source="l1s join f0 using (l0)",
        parent="l0",
        own="l1",
    )
    + ", "
    + _FILL.format(
        name="f2",
        group="l0, l1, l2",
        cap="l2s.cap",
        weight="(case when l0 = 'domain0' and l1 = 'en' and l2 = 'src0' then 2 else 1 end)::hugeint",
        budget="f1.own",
        source="l2s join f1 using (l0, l1)",
        parent="l0, l1",
        own="l2",
    )
    + r""", plan as (
  select l0, l1, l2, own as budget, case when t > 0 then own // t else 0 end as epochs,
    own - case when t > 0 then own // t else 0 end * t as rest
  from f2 join leaf using (l0, l1, l2)
), placed as (
  select d.*, epochs, rest,
    sum(n) over (partition by l0, l1, l2
      order by md5('17:' || epochs::bigint || ':' || coalesce(doc_id::varchar, ''))) as upto
  from d join plan using (l0, l1, l2)
)
select doc_id, lang, source, n as n_tokens,
  (epochs + case when epochs < 2 and upto <= rest then 1 else 0 end)::bigint as copies
from placed
"""
)

_OP13 = r"""
with labelled as (
  select doc_id, max((quality = 1)::int) as good, max((toxic = 1)::int) as toxic
  from labels group by doc_id
), d as (
  select doc_id, coalesce(source, '') as part, coalesce(text, '') as text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws,
    coalesce(min(doc_id) over (partition by coalesce(text, '')) < doc_id, false) as is_copy
  from documents
), failed as (
  select part, coalesce(good, 0) as good, coalesce(toxic, 0) as toxic,
    case when len(ws) < 200 then 1 else 0 end
    + case when 100 * len(list_distinct(ws)) < 50 * len(ws) then 2 else 0 end
    + case when 100 * length(regexp_replace(text, '[^A-Z]+', '', 'g')) > 2 * length(text)
        then 4 else 0 end
    + case when regexp_matches(text, '[#$%&*|]') then 8 else 0 end
    + case when is_copy then 16 else 0 end as bits
  from d left join labelled using (doc_id)
), counts as (
  select part, bits, count(*) as n, sum(good) as n_good, sum(toxic) as n_toxic
  from failed group by all
), f(l, b) as (
  values ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)
), orders as (
  select [a.l, b.l, c.l, d.l, e.l] as ls, [a.b, b.b, c.b, d.b, e.b] as bs
  from f a, f b, f c, f d, f e
  where a.b + b.b + c.b + d.b + e.b = 31 and len(list_distinct([a.l, b.l, c.l, d.l, e.l])) = 5
), steps as (
  select array_to_string(ls, '') as filter_order, step::int as step, bs[step] as own,
    coalesce(list_sum(bs[1 : step - 1]), 0)::bigint as before
  from orders, (select unnest(range(1, 6)) as step)
), audited as (
  select part, filter_order, step, own,
    sum(case when bits & (before | own) = 0 then n else 0 end)::bigint as kept,
    sum(case when bits & before = 0 and bits & own <> 0 then n else 0 end)::bigint as removed,
    sum(case when bits & before <> 0 and bits & own <> 0 then n else 0 end)::bigint as redundant,
    sum(case when bits = own then n else 0 end)::bigint as unique_fails,
    sum(case when bits & before = 0 and bits & own <> 0 then n_good else 0 end)::bigint as good_lost,
    sum(case when bits & before = 0 and bits & own <> 0 then n_toxic else 0 end)::bigint as toxic_lost
  from counts, steps group by all
)
select part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  sum(removed) over (partition by part, own)::bigint as shapley
from audited
"""


def llm_sql() -> dict[str, str]:
    return {"op4_quality_rules": _OP4, "op8_mixing": _OP8, "op13_audit": _OP13}
