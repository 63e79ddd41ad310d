"""DuckDB SQL for the text operators that SQL can express."""

from __future__ import annotations

from accountwatch.llm.quality import STOP_WORDS

ORACLE: dict[str, str] = {}

_STOP = ", ".join(f"'{w}'" for w in dict.fromkeys(STOP_WORDS))

ORACLE["op6_quality_rules"] = f"""
with split as (
    select row_number() over () as r, doc_id, coalesce(text, '') as t,
           regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as w,
           list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) as lines
    from documents),
starts as (select r, w, unnest(range(1, len(w) - 6)) as i from split),
windows as (select r, i, w[i:i+7] as g from starts),
twice as (select r, i from (select r, i, count(*) over (partition by r, g) as c from windows) where c > 1),
covered as (select r, count(distinct i + k) as n from twice, range(0, 8) x(k) group by r),
base as (
    select s.doc_id, len(w) as n_words,
           coalesce(length(array_to_string(w, '')), 0) as word_chars,
           length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) as n_symbols,
           len(lines) as n_lines, len(lines) - len(list_distinct(lines)) as n_dup_lines,
           coalesce(c.n, 0) as n_repeat_words,
           len(list_filter(w, lambda x: x in ({_STOP}))) as n_stop
    from split s left join covered c on c.r = s.r),
judged as (select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed from base)
select doc_id, n_words::bigint as n_words, word_chars::bigint as word_chars, n_symbols::bigint as n_symbols,
       n_dup_lines::bigint as n_dup_lines, n_repeat_words::bigint as n_repeat_words, base_failed,
       not base_failed and n_words between 20 and 1000000
         and word_chars / n_words between 2.5 and 14.0 and n_symbols / word_chars <= 0.05
         and n_stop / n_words >= 0.02 and n_dup_lines / n_lines <= 0.5 as kept
from judged
"""

ORACLE["op10_exact_dedup"] = """
with bare as (
    select doc_id, length(coalesce(text, '')) as chars,
           sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g')) as text_sha256
    from documents),
ranked as (
    select *, count(*) over (partition by text_sha256) as group_size,
           first_value(doc_id) over w as keep_id, row_number() over w as place
    from bare window w as (partition by text_sha256 order by chars desc, doc_id nulls last))
select doc_id, text_sha256, keep_id, group_size, place = 1 as kept from ranked
"""

_LOWER = "translate(coalesce({}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_TERMS = "regexp_extract_all(" + _LOWER + ", '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"

ORACLE["op12_ranked_search"] = f"""
with cut as (select row_number() over () as r, doc_id, {_TERMS.format("text")} as t from documents),
held as (select r, doc_id, len(t)::bigint as n, t from cut where len(t) > 0),
sizes as (select count(*)::bigint as docs, sum(n)::bigint as terms from held),
asked as (select item_id, unnest({_TERMS.format("text")}) as term from benchmark),
needed as (select item_id, term, count(*)::bigint as times from asked group by all),
tfs as (select r, doc_id, n, term, count(*)::bigint as tf from (select r, doc_id, n, unnest(t) as term from held)
        where term in (select term from needed) group by all),
weights as (select term, floor(1000 * ln((2 * docs + 2)::double / (2 * count(*) + 1)::double))::bigint as w
            from tfs, sizes group by term, docs),
scores as (
    select item_id, r, doc_id,
           sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // terms))))::bigint as score
    from needed join tfs using (term) join weights using (term), sizes group by item_id, r, doc_id),
ranked as (
    select item_id, row_number() over (partition by item_id order by score desc, doc_id nulls last)::int as rank, doc_id, score
    from scores where score > 0)
select item_id, rank, doc_id, score from ranked where rank <= 20
"""

ORACLE["op11_collocations"] = f"""
with pieces as (select coalesce(lang, 'und') as lang,
                       unnest(regexp_split_to_array({_LOWER.format("text")}, '[.,;:!?\\x0A-\\x0D]')) as piece from documents),
cut as (select lang, regexp_extract_all(piece, '[^\\x20\\x09]+') as w from pieces),
sizes as (select lang, sum(len(w))::hugeint as n from cut group by lang),
starts as (select lang, w, unnest(range(1, len(w) + 1)) as i from cut),
grams as (select lang, m, array_to_string(w[i:i + m - 1], ' ') as phrase from starts, range(1, 6) t(m) where i + m - 1 <= len(w)),
counts as (select lang, m, phrase, count(*)::hugeint as f from grams group by all having count(*) >= 100),
candidates as (select *, string_split(phrase, ' ') as w from counts where m >= 2),
inner_parts as (
    select lang, array_to_string(w[i:i + s - 1], ' ') as phrase, max(f) as most
    from candidates, range(2, 5) a(s), range(1, 5) b(i) where s < m and i + s - 1 <= m group by all),
cuts as (
    select c.lang, c.phrase, c.f as a, x.f as l, y.f as r, n, k, (1000 * c.f * n) // (x.f * y.f) as score
    from candidates c join sizes using (lang), range(1, 5) t(k)
    join counts x on x.lang = c.lang and x.phrase = array_to_string(c.w[1:k], ' ')
    join counts y on y.lang = c.lang and y.phrase = array_to_string(c.w[k + 1:], ' ')
    where k < c.m),
lowest as (select * from cuts qualify row_number() over (partition by lang, phrase order by score, k) = 1),
ranked as (
    select l.lang, row_number() over (partition by l.lang order by score desc, a desc, l.phrase) as rank, l.phrase, a, l, r, n, score
    from lowest l left join inner_parts i on i.lang = l.lang and i.phrase = l.phrase where most is null or most < a)
select lang, rank, phrase, a::bigint as a, l::bigint as l, r::bigint as r, n::bigint as n, score::bigint as score
from ranked where rank <= 2000
"""
