"""DuckDB SQL of the text queries that SQL can express, each stated its own way.

op2 and op7 compare words and tokens themselves where the queries compare hashes,
op4 compares every pair of sets that share a shingle, op6 accumulates each
source's ranking at one go, op8 marks matches in the text and measures what
lies between the marks. They suit small tables; the queries suit large ones.
"""

from __future__ import annotations

from .common import WORD_PATTERN
from .secrets import PLACEHOLDERS, _NAMES

NGRAM_JACCARD = f"""
with recursive rows_ as materialized (
    select row_number() over () as rid, doc_id,
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as text
    from documents
), listed as (
    select rid, regexp_extract_all(text, '{WORD_PATTERN}') as words from rows_ where text is not null
), words as (
    select rid, unnest(words) as word, generate_subscripts(words, 1) as pos, len(words) as n from listed
), windows as (
    select rid, n, pos, word, lead(word, 1) over w as second, lead(word, 2) over w as third
    from words window w as (partition by rid order by pos)
), shingles as materialized (
    select distinct rid, case when n = 1 then word when n = 2 then word || ' ' || second else word || ' ' || second || ' ' || third end as shingle
    from windows where pos <= greatest(n - 2, 1)
), sets as materialized (
    select rid, count(*) as n, md5(string_agg(shingle, chr(10) order by shingle)) as content from shingles group by rid
), heads as materialized (
    select content, min(rid) as head, any_value(n) as n from sets group by content
), links as materialized (
    select a.rid as u, b.rid as v
    from shingles a join heads p on p.head = a.rid join shingles b on b.shingle = a.shingle join heads q on q.head = b.rid
    where a.rid != b.rid and 10 * least(p.n, q.n) >= 9 * greatest(p.n, q.n)
    group by a.rid, b.rid, p.n, q.n
    having 100 * count(*) >= 90 * (p.n + q.n - count(*))
), reach(head, other) as (
    select head, head from heads
    union
    select reach.head, links.v from reach join links on links.u = reach.other
), least_of as (
    select content, min(doc_id) as doc_id from sets join rows_ using (rid) group by content
), components as (
    select heads.content, min(least_of.doc_id) as component_id
    from heads join reach using (head) join heads far on far.head = reach.other join least_of on least_of.content = far.content
    group by heads.content
)
select rows_.doc_id, coalesce(sets.n, 0) as n_shingles,
       case when sets.n is null then rows_.doc_id else component_id end as component_id
from rows_ left join sets using (rid) left join components using (content)
"""

MIXING = f"""
with sized as materialized (
    select doc_id, source, text, coalesce(len(regexp_extract_all(text, '{WORD_PATTERN}')), 0)::bigint as size from documents
), sources as (
    select source, sum(size)::bigint as source_size, row_number() over (order by source nulls last) - 1 as place
    from sized group by source
), weighed as (
    select *, (place % 3 + 1)::double as weight, 3::double * source_size as most from sources
), filled as (
    select *, coalesce(sum(most) over lower_, 0) as full_, coalesce(sum(weight) over lower_, 0) as gone,
           sum(source_size) over ()::double as total, sum(weight) over () as weights
    from weighed
    window lower_ as (order by most / weight, place rows between unbounded preceding and 1 preceding)
), capped as (
    select *, most <= (total - full_) / (weights - gone) * weight as stops from filled
), aims as (
    select source, source_size,
           case when stops then most
                else (total - sum(if(stops, most, 0)) over ()) / (weights - sum(if(stops, weight, 0)) over ()) * weight end as target
    from capped
), parts as materialized (
    select *, floor(ratio)::bigint as whole, ratio - floor(ratio) as part, target - floor(ratio) * source_size as rest
    from (select *, if(source_size > 0, target / source_size, 0) as ratio from aims)
), classes as (
    select sized.source, length(bin(size)) as bits, sum(size)::bigint as words, any_value(rest) as rest
    from sized join parts on sized.source is not distinct from parts.source where part > 0 and size > 0 group by all
), pulled as (
    select *, rest - coalesce(sum(words) over (partition by source order by bits desc rows between unbounded preceding and 1 preceding), 0)::double as open_,
           sum(words * bits) over (partition by source order by bits desc rows between current row and unbounded following)::double as pull
    from classes
), first_ as (
    select source, max(bits) as from_, arg_max(open_, bits) as open_, arg_max(pull, bits) as pull from pulled where bits * open_ < pull group by source
), chances as (
    select classes.source, bits, case when from_ is null or bits > from_ then 1 else greatest(0, bits * open_ / pull) end as chance
    from classes left join first_ on classes.source is not distinct from first_.source
), drawn as (
    select sized.doc_id, sized.source, size, source_size, target, whole, part, rest, chance,
           (('0x' || md5('20:' || coalesce(doc_id::varchar, '') || ':' || md5(coalesce(text, ''))))[1:15]::bigint::double + 0.5::double) / 4503599627370496::double as u
    from sized join parts on sized.source is not distinct from parts.source
    left join chances on sized.source is not distinct from chances.source and length(bin(size)) = bits
), ranked as (
    select *, case when chance >= 1 then 0 when chance > 0 then u / (1 - u) / (chance / (1 - chance)) end as q from drawn
), summed as materialized (
    select *, sum(size) over (partition by source order by q nulls last, doc_id nulls last rows between unbounded preceding and current row) as upto from ranked
), ends as (
    select source, coalesce(max(upto) filter (q is not null and upto <= rest), 0) as reached from summed group by source
), judged as (
    select summed.*, part > 0 and q is not null and upto <= rest as inside, abs(size - (rest - reached)) as off, rest - reached as missing
    from summed join ends on summed.source is not distinct from ends.source
), closing as (
    select *, row_number() over (partition by source, (part > 0 and not inside and size > 0 and off < missing) order by off, q, doc_id nulls last) = 1
              and part > 0 and not inside and size > 0 and off < missing as closes
    from judged
)
select doc_id, size, source_size, target, (size * (whole + (inside or closes)::bigint))::bigint as taken from closing
"""

_ASSIGN = rf"""({_NAMES})["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""


def _matches(kind: str, number: int, pattern: str, value: str, least: int) -> str:
    """A select of (rid, kind, number, start, stop, value): marks \\1 and \\2 enclose each match."""
    return f"""
    select rid, '{kind}' as kind, {number} as number, start, start + length(found) as stop, value
    from (
        select rid, found, {value} as value, before - (pos - 2) as start
        from (
            select rid, pos, split_part(piece, chr(2), 1) as found,
                   sum(length(piece)) over (partition by rid order by pos rows between unbounded preceding and 1 preceding) as before
            from (
                select rid, unnest(pieces) as piece, generate_subscripts(pieces, 1) as pos
                from (select rid, string_split(regexp_replace(text, '{pattern}', chr(1) || '\\0' || chr(2), 'g'), chr(1)) as pieces from rows_)
            )
        )
        where pos > 1
    )
    where length(value) >= {least}"""


SECRETS = f"""
with rows_ as materialized (
    select row_number() over () as rid, doc_id, coalesce(source, '') as owner, coalesce(doc_id::varchar, '') as repo, translate(coalesce(text, ''), chr(1) || chr(2), chr(3) || chr(3)) as text
    from documents
), found as materialized (
    {_matches("assign", 0, _ASSIGN, f"regexp_extract(found, '{_ASSIGN}', 2)", 12)}
    union all
    {_matches("access", 1, "AKIA[A-Z0-9]+", "found", 18)}
    union all
    {_matches("hex", 2, "[0-9a-f]+", "found", 16)}
), held as (
    select value, count(distinct owner) as owners, count(distinct repo) as repos from found join rows_ using (rid) group by value
), judged as (
    select found.*, owners, repos, owners >= 3 or repos >= 10 as common,
           owners < 3 and repos < 10 and len(list_distinct(string_split(value, ''))) >= 8 and regexp_matches(value, '[A-Za-z]')
           and regexp_matches(value, '[0-9]') and not regexp_matches(lower(value), '{PLACEHOLDERS}') as live
    from found join held using (value)
), every_ as (
    select rid, kind, number, start, stop from judged
    union all
    select distinct rid, 'live', 3, stop - length(value), stop from judged where live
), written as (
    select rid, count(*) filter (number = 0) as n_assign, count(*) filter (number = 1) as n_access, count(*) filter (number = 2) as n_hex,
           string_agg(kind || ':' || start || ':' || stop, ',' order by start, number) filter (number < 3) as base,
           string_agg(kind || ':' || start || ':' || stop, ',' order by start, number, stop) as spans,
           count(*) filter (number = 3) as n_live
    from every_ group by rid
), examples as (
    select rid, count(*) filter (common) as n_example, string_agg(repos || '/' || owners, ',' order by start, number) as held_by from judged group by rid
)
select doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access, coalesce(n_hex, 0) as n_hex,
       sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans, coalesce(n_live, 0) as n_live, coalesce(n_example, 0) as n_example, coalesce(held_by, '') as held_by
from rows_ left join written using (rid) left join examples using (rid)
"""

#: Marks the ends of sentences; assumed to be in no text.
_CUT = "\x01\x03\x01"

SENTENCE_SPANS = f"""
with rows_ as materialized (select row_number() over () as rid, doc_id, text from documents),
marked as (
    select rid, doc_id, string_split(regexp_replace(text, '[.!?][\\x20\\x09-\\x0D]+|\\n[\\x20\\x09-\\x0D]*', '\\0{_CUT}', 'g'), '{_CUT}') as pieces
    from rows_ where text is not null
), pieces as materialized (
    select rid, doc_id, pos, piece, regexp_extract_all(piece, '{WORD_PATTERN}') as words
    from (select rid, doc_id, unnest(pieces) as piece, generate_subscripts(pieces, 1) as pos from marked)
), counted as (
    select *, sum(len(words)) over (partition by rid order by pos) as upto from pieces where len(words) > 0
), ahead as (
    select rid, doc_id, pos, upto - len(words) as before, upto as e0, lead(upto, 1) over w as e1, lead(upto, 2) over w as e2,
           array_to_string(words, ' ') as w0, array_to_string(lead(words, 1) over w, ' ') as w1, array_to_string(lead(words, 2) over w, ' ') as w2,
           lead(pos, 1) over w as p1, lead(pos, 2) over w as p2
    from counted window w as (partition by rid order by pos)
), ended as (
    select *, case when e0 >= before + 40 then 0 when e1 >= before + 40 then 1 when e2 is not null then 2 end as steps from ahead
), runs as (
    select rid, doc_id, pos as first, case steps when 0 then pos when 1 then p1 else p2 end as last,
           case steps when 0 then w0 when 1 then w0 || ' ' || w1 else w0 || ' ' || w1 || ' ' || w2 end as run
    from ended where case steps when 0 then e0 when 1 then e1 when 2 then e2 end - before >= 10
), again as (
    select rid, first, last from runs qualify row_number() over (partition by run order by doc_id nulls last, rid, first) > 1
), covered as (
    select distinct rid, pos from (select rid, unnest(range(first, last + 1)) as pos from again)
), kept as (
    select pieces.rid, string_agg(piece, '' order by pieces.pos) filter (covered.rid is null) as text,
           count(*) filter (len(words) > 0) as n_sentences, count(*) filter (len(words) > 0 and covered.rid is not null) as n_removed
    from pieces left join covered on covered.rid = pieces.rid and covered.pos = pieces.pos group by pieces.rid
)
select doc_id, case when rows_.text is not null then coalesce(kept.text, '') end as text, coalesce(n_sentences, 0) as n_sentences, coalesce(n_removed, 0) as n_removed
from rows_ left join kept using (rid)
"""

LINE_TEMPLATES = f"""
with rows_ as materialized (select row_number() over () as rid, doc_id, text from documents),
lines as materialized (
    select rid, doc_id, md5(text) as content, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) as pos
    from rows_ where text is not null
), tokens as (
    select rid, doc_id, content, pos,
           list_transform(regexp_extract_all(line, '{WORD_PATTERN}'), lambda x: if(regexp_matches(x, '[0-9]'), '<*>', x)) as tokens
    from lines
), classed as (
    select *, unnest(if(len(tokens) <= 5, [3], [0, 1, 2])) as class from tokens where len(tokens) >= 3
), keyed as materialized (
    select rid, doc_id, content, pos,
           class || ' ' || array_to_string(list_transform(tokens, lambda x, i: if(i > 2 and (i - 3) % 3 = class, '', x)), ' ') as template
    from classed
), recurring as (
    select template, min(doc_id) as first from keyed group by template having count(distinct content) >= 5
), dropped as (
    select distinct rid, pos from keyed join recurring using (template) where doc_id is distinct from first
), kept as (
    select lines.rid, count(*) as n_lines, count(dropped.rid) as n_dropped,
           string_agg(line, chr(10) order by lines.pos) filter (dropped.rid is null) as text
    from lines left join dropped on dropped.rid = lines.rid and dropped.pos = lines.pos group by lines.rid
)
select doc_id, case when rows_.text is not null then coalesce(kept.text, '') end as text, coalesce(n_lines, 0) as n_lines, coalesce(n_dropped, 0) as n_dropped
from rows_ left join kept using (rid)
"""

#: Terms as the contract states them; RE2 reads code points.
_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

LEXICAL_SEARCH = f"""
with texts as (
    select row_number() over () as rid, doc_id,
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as text
    from documents
), listed as (
    select rid, doc_id, regexp_extract_all(text, '{_TERM}') as terms from texts where text is not null
), sized as (
    select rid, doc_id, terms, len(terms) as n from listed where len(terms) > 0
), totals as (
    select count(*) as docs, sum(n)::bigint as total from sized
), words as (
    select rid, unnest(terms) as term from sized
), postings as (
    select rid, term, count(*) as tf from words group by rid, term
), frequencies as (
    select term, floor(1000 * ln((2 * docs + 2)::double / (2 * count(*) + 1)::double))::bigint as w
    from postings, totals group by term, docs
), asked as (
    select row_number() over () as iid, item_id,
           unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_TERM}')) as term
    from benchmark where text is not null
), lengths as (
    select rid, doc_id, 75 + (25 * n * docs) // total as m from sized, totals
), scored as (
    select iid, item_id, rid, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::bigint as score
    from asked join postings using (term) join frequencies using (term) join lengths using (rid)
    group by iid, item_id, rid, doc_id
), ranked as (
    select item_id, row_number() over (partition by iid order by score desc, doc_id nulls last, rid) as rank, doc_id, score
    from scored where score > 0
)
select item_id, rank::int as rank, doc_id, score from ranked where rank <= 20
"""

#: The CRC-32 of an id's decimal digits, byte by byte and bit by bit.
_CRC32 = """xor(list_reduce(list_transform(string_split(conv_id::varchar, ''), lambda s: ascii(s)::bigint),
    lambda crc, b: list_reduce([0, 1, 2, 3, 4, 5, 6, 7], lambda x, i: xor(x >> 1, (x & 1) * 3988292384), xor(crc, b)), 4294967295::bigint), 4294967295)"""

PREFIX_TRIE = f"""
with turns as (
    select conv_id, turn, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) as content,
           len(regexp_extract_all(coalesce(text, ''), '{WORD_PATTERN}')) as words
    from conversations where conv_id is not null
), own as (
    select conv_id, list(content order by turn nulls first, content) as contents, list(words order by turn nulls first, content) as counts
    from turns group by conv_id
), keyed as (
    select *, conv_id - conv_id % 20 as base, ({_CRC32} % 4)::int as h from own
), rebuilt as (
    select c.conv_id,
           list_concat(coalesce(list_slice(b.contents, 1, c.h), []), list_slice(c.contents, c.h + 1, len(c.contents))) as contents,
           list_concat(coalesce(list_slice(b.counts, 1, c.h), []), list_slice(c.counts, c.h + 1, len(c.counts))) as counts
    from keyed c left join own b on b.conv_id = c.base
), prefixes as materialized (
    select conv_id, depth, array_to_string(list_slice(contents, 1, depth), ' ') as path,
           array_to_string(list_slice(contents, 1, depth - 1), ' ') as above,
           case when depth = 0 then 0 else counts[depth] end as words, depth = len(contents) as ends
    from (select *, unnest(range(0, len(contents) + 1)) as depth from rebuilt)
), nodes as materialized (
    select path, any_value(above) as above, depth, any_value(words) as words, min(conv_id) as conv_id, count(*) as n_convs,
           sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (ends), '')) as ends_sha256
    from prefixes group by path, depth
), children as (
    select above as path, depth - 1 as depth, count(*) as n_children from nodes where depth > 0 group by all
), full_ as materialized (
    select n.*, coalesce(n_children, 0) as n_children, p.conv_id as parent_conv_id
    from nodes n left join children using (path, depth) left join nodes p on n.depth > 0 and p.path = n.above and p.depth = n.depth - 1
), subtree as (
    -- every node is under each prefix of its smallest member that is no longer than itself
    select a.path, a.depth, sum((u.n_convs - 1) * u.words)::bigint as saved_tokens, sum((u.n_children = 0)::int)::bigint as n_leaves
    from full_ u join prefixes a on a.conv_id = u.conv_id and a.depth <= u.depth group by a.path, a.depth
)
select conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256
from full_ join subtree using (path, depth)
"""
