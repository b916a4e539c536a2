"""DuckDB SQL for the queries that SQL can express."""

OP2 = r"""
with docs as (select row_number() over () as rid, doc_id, coalesce(text, '') as text from documents),
lines as (
  select rid, doc_id, pos, line,
         translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
  from (select rid, doc_id, unnest(string_split(text, chr(10))) as line,
               generate_subscripts(string_split(text, chr(10)), 1) as pos from docs)
),
often as (select key, max(doc_id) as keeper from lines where length(key) >= 20
          group by key having count(distinct doc_id) >= 3),
marked as (select l.*, o.key is not null and l.doc_id <> o.keeper as gone from lines l left join often o on l.key = o.key)
select any_value(doc_id) as doc_id, count(*) as n_lines, count(*) filter (gone) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by pos) filter (not gone), '')) as kept_sha256
from marked group by rid
"""

OP10 = r"""
with docs as (select row_number() over () as rid, doc_id, lang, source, coalesce(text, '') as text from documents),
split as (select *, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') as w,
                 list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as ls from docs),
win as (select rid, i, list_slice(w, i, i + 7) as g
        from (select rid, w, unnest(range(1, len(w) - 6)) as i from split where len(w) >= 8)),
hits as (select rid, i from win qualify count(*) over (partition by rid, g) > 1),
spans as (select rid, least(8, coalesce(lead(i) over (partition by rid order by i) - i, 8)) as step from hits),
rep as (select rid, sum(step)::bigint as n from spans group by rid),
stat as (
  select doc_id, lang, source, len(w)::bigint as n_words,
         coalesce(length(array_to_string(w, '')), 0)::bigint as word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::bigint as n_symbols,
         (len(ls) - len(list_distinct(ls)))::bigint as n_dup_lines, len(ls) as n_ls,
         coalesce(rep.n, 0)::bigint as n_repeat_words
  from split left join rep using (rid)),
ratios as materialized (select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed,
  [(n_symbols + 1) / (n_words + 20.0), (n_dup_lines + 1) / (n_ls + 10.0), case when n_words > 0 then word_chars / n_words else 0.0 end] as r
  from stat),
vals as (select lang, source, m, r[m] as v from (select *, unnest([1, 2, 3]) as m from ratios where not base_failed)),
est as materialized (select lang, source, m, pow(1.02, ceil(ln(v) / ln(1.02))) as hi from vals),
own as (select lang, source, m, count(*) as n, ln(quantile_disc(hi, 0.25) / 1.02) as a, ln(quantile_disc(hi, 0.75)) as b from est group by all),
whole as (select m, ln(quantile_disc(hi, 0.25) / 1.02) as a, ln(quantile_disc(hi, 0.75)) as b from est group by m),
lim as (select lang, source, m,
          exp(least((n * (own.b + 2.5 * (own.b - own.a)) + 100 * (whole.b + 2.5 * (whole.b - whole.a))) / (n + 100),
                    whole.b + 3.5 * (whole.b - whole.a))) as l
        from own join whole using (m)),
lims as (select lang, source, list(l order by m) as l from lim group by lang, source)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not base_failed and r[1] <= l[1] and r[2] <= l[2] and r[3] <= l[3] as kept
from ratios left join lims on ratios.lang is not distinct from lims.lang and ratios.source is not distinct from lims.source
"""

OP11 = r"""
with pieces as (
  select coalesce(lang, 'und') as lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[.,;:!?\x0A-\x0D]')) as piece
  from documents),
ws as (select lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') as w from pieces),
totals as (select lang, sum(len(w)) as n from ws group by lang),
grams as (select lang, m, unnest(list_transform(range(1, len(w) - m + 2), lambda i: w[i:i + m - 1])) as p
          from ws, (select unnest([1, 2, 3, 4, 5]) as m) where len(w) >= m),
freq as (select lang, m, p, count(*) as a from grams group by all having count(*) >= 100),
longer as (select f.lang, f.a, list_slice(f.p, s.i, s.i + s.k - 1) as q
           from freq f, (select i, k from (select unnest([1, 2, 3, 4]) as i), (select unnest([2, 3, 4]) as k)) s
           where s.k < f.m and s.i + s.k - 1 <= f.m),
swallowed as (select distinct c.lang, c.p from freq c join longer l on l.lang = c.lang and l.q = c.p and l.a >= c.a),
cuts as (select f.lang, f.p, f.m, f.a, k, list_slice(f.p, 1, k) as x, list_slice(f.p, k + 1, f.m) as y
         from freq f, (select unnest([1, 2, 3, 4]) as k) where k < f.m),
scores as (select c.lang, c.p, c.a, c.k, x.a as l, y.a as r, t.n,
                  (1000::hugeint * c.a::hugeint * t.n::hugeint) // (x.a::hugeint * y.a::hugeint) as score
           from cuts c join freq x on x.lang = c.lang and x.p = c.x join freq y on y.lang = c.lang and y.p = c.y
           join totals t on t.lang = c.lang),
weakest as (select * from scores qualify row_number() over (partition by lang, p order by score, k) = 1),
ranked as (select w.lang, row_number() over (partition by w.lang order by w.score desc, w.a desc, array_to_string(w.p, ' ')) as rank,
                  array_to_string(w.p, ' ') as phrase, w.a, w.l, w.r, w.n, w.score
           from weakest w left join swallowed s on s.lang = w.lang and s.p = w.p where s.p is null)
select lang, rank, phrase, a, l, r, n::bigint as n, score::bigint as score from ranked where rank <= 2000
"""

OP12 = """
with d as (select doc_id, sha256(coalesce(text, '')) as text_sha256 from documents),
g as (select text_sha256, max(doc_id) as keep_id, count(*) as group_size from d group by text_sha256)
select doc_id, keep_id, group_size, doc_id is not distinct from keep_id as kept, text_sha256 from d join g using (text_sha256)
"""

ORACLE_SQL = {
    "op2_line_dedup": OP2,
    "op10_quality_rules": OP10,
    "op11_phrase_collocations": OP11,
    "op12_exact_dedup": OP12,
}
