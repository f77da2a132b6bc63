"""DuckDB SQL for the queries of the ten operators that SQL can express."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

ORACLES["op9_url_filter"] = r"""
with rules(rule, rhost, rpath, rverdict) as (values
    ('com/', 'com', '/', 'allow'),
    ('example.com/en/', 'example.com', '/en/', 'block'),
    ('www.example.com/en/', 'www.example.com', '/en/', 'allow'),
    ('net/es/', 'net', '/es/', 'block'),
    ('net/fr/', 'net', '/fr/', 'block')),
parsed as (
    select page_id,
        coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') as host,
        coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') as path
    from pages),
judged as (
    select page_id, host, path,
        (select arg_max(struct_pack(rule := rule, verdict := rverdict), length(rule)) from rules
         where (host = rhost or ends_with(host, '.' || rhost)) and starts_with(path, rpath)) as best
    from parsed)
select page_id, host, path, best.rule as rule, coalesce(best.verdict, 'allow') as verdict from judged
"""

ORACLES["op10_chat_format"] = r"""
with rows as (
    select conv_id, turn, role, coalesce(text, '') as text from conversations
    union all values (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
judged as (
    select *, regexp_matches(text, '<<SYS>>|\[INST\]|<s>|\[ROLE (?:-|[0-9A-F]*)\]|<</SYS>>|\[/INST\]|</s>|\[/ROLE\]') as conflict from rows),
whole as (
    select *, bool_or(conflict) over (partition by conv_id) as escaped from judged)
select conv_id, count(*) as n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
    cast(coalesce(sum(length(text)) filter (where role = 'assistant'), 0) as bigint) as loss_chars,
    sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (where role = 'assistant'), '')) as loss_sha256,
    cast(sum(2 + case role when 'system' then 15 when 'user' then 13 when 'assistant' then 7
             else 7 + 7 + 2 * strlen(role) end
        + length(case when escaped then regexp_replace(text, '(\\*)(<<SYS>>|\[INST\]|<s>|\[ROLE (?:-|[0-9A-F]*)\]|<</SYS>>|\[/INST\]|</s>|\[/ROLE\])', '\1\\\2', 'g') else text end)) as bigint) as formatted_chars
from whole group by conv_id
"""

ORACLES["op1_decontamination"] = r"""
with doc as (
    select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') as w from documents),
item as (
    select cast(item_id as varchar) as item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') as w from benchmark),
pieces as (
    select distinct item_id, least(10, len(w)) as n, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') as s
    from item, lateral (select unnest(range(1, greatest(1, len(w) - 8))) as i) where len(w) > 0),
lengths as (select distinct n from pieces),
windows as (
    select doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') as s
    from doc, lengths, lateral (select unnest(range(1, len(w) - n + 2)) as i) where len(w) >= n),
hits as (select doc_id, windows.n, i, item_id from windows join pieces using (n, s)),
words as (select doc_id, count(distinct p) as n_hit from (select doc_id, unnest(range(i, i + n)) as p from hits) group by doc_id),
found as (select doc_id, count(distinct item_id) as n_items, string_agg(distinct item_id, ',' order by item_id) as names from hits group by doc_id)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
    sha256(coalesce(names, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from doc left join words using (doc_id) left join found using (doc_id)
"""

ORACLES["op3_substring_dedup"] = r"""
with doc as (
    select doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w from documents),
windows as (
    select doc_id, i, sha256(array_to_string(w[i:i + 19], ' ')) as s
    from doc, lateral (select unnest(range(1, len(w) - 18)) as i) where len(w) >= 20),
judged as (select doc_id, i, row_number() over (partition by s order by doc_id, i) as r from windows),
gone as (select distinct doc_id, unnest(range(i, i + 20)) as p from judged where r > 1),
words as (select doc_id, unnest(w) as word, generate_subscripts(w, 1) as p from doc),
kept as (
    select doc_id, count(*) as n, string_agg(word, ' ' order by p) as t
    from words anti join gone using (doc_id, p) group by doc_id)
select doc_id, cast(len(w) as bigint) as n_words, len(w) - coalesce(n, 0) as n_removed, sha256(coalesce(t, '')) as kept_sha256
from doc left join kept using (doc_id)
"""

ORACLES["op2_warc"] = r"""
with payload as (select page_id, strlen(coalesce(html, '')) as n, sha1(coalesce(html, '')) as h from pages),
judged as (select *, min(page_id) over (partition by h, n) as least from payload)
select page_id, cast(n as bigint) as payload_bytes,
    array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        1 + ((cast('0x' || substr(h, 1 + (5 * i) // 4, 2) as integer) >> cast(3 - (5 * i) % 4 as integer)) & 31), 1)), '') as payload_digest,
    case when page_id = least then 'response' else 'revisit' end as record_type,
    case when page_id <> least then least end as refers_to
from judged
"""

ORACLES["op13_importance"] = r"""
with crc_table as (
    select list_transform(range(256), lambda i: list_reduce(range(8),
        lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, i)) as t),
doc as (
    select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') as w from documents),
item as (
    select list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') as w from benchmark),
doc_words as (select doc_id, unnest(w) as word from doc),
item_words as (select unnest(w) as word from item),
distinct_words as (select word, hex(encode(word)) as h from (select word from doc_words union select word from item_words)),
hashed as (
    select word, xor(list_reduce(list_transform(range(length(h) // 2), lambda i: cast('0x' || substr(h, 2 * i + 1, 2) as bigint)),
        lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8), 4294967295), 4294967295) % 10000 as bucket
    from distinct_words, crc_table),
here as (select bucket, count(*) as s from doc_words join hashed using (word) group by bucket),
there as (select bucket, count(*) as t from item_words join hashed using (word) group by bucket),
totals as (select (select coalesce(sum(s), 0) from here) as ss, (select coalesce(sum(t), 0) from there) as tt),
gains as (
    select bucket, cast(floor(1000 * ln(cast((coalesce(t, 0) + 1) * (ss + 10000) as double)
        / cast((coalesce(s, 0) + 1) * (tt + 10000) as double))) as bigint) as gain
    from here full join there using (bucket), totals),
weights as (select doc_id, sum(gain) as weight from doc_words join hashed using (word) join gains using (bucket) group by doc_id),
scored as (
    select doc_id, cast(len(w) as bigint) as n_features, cast(coalesce(weight, 0) as bigint) as weight,
        cast(coalesce(weight, 0) + floor(-1000 * ln(-ln((cast('0x' || substr(sha256('2024:' || doc_id), 1, 8) as bigint) + 0.5::double) / 4294967296))) as bigint) as score
    from doc left join weights using (doc_id)),
placed as (
    select doc_id, row_number() over (order by score desc, doc_id) as place, count(*) over () as n from scored where n_features >= 20)
select doc_id, n_features, weight, score, case when place <= 10 * n // 100 then place end as rank
from scored left join placed using (doc_id)
"""


def _codebook_sql(rounds: int) -> str:
    """Assigning and averaging, one pair of tables for each round, then the final assignment."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""
d{r} as materialized (
    select vec_id, p, e, cast(sum((a.x - b.x) * (a.x - b.x)) as bigint) as d from comp a join e{r} b using (p, c) group by vec_id, p, e),
a{r} as materialized (
    select vec_id, p, e, d from d{r} qualify row_number() over (partition by vec_id, p order by d, e) = 1)""")
        if r < rounds:
            steps.append(f"""
m{r} as materialized (
    select p, e, c, (s - ((s % n) + n) % n) // n as x
    from (select p, e, c, cast(sum(x) as bigint) as s, count(*) as n from a{r} join comp using (vec_id, p) group by p, e, c)),
e{r + 1} as materialized (
    select p, e, c, coalesce(m.x, o.x) as x from e{r} o left join m{r} m using (p, e, c))""")
    return ",".join(steps)


ORACLES["op12_codebooks"] = rf"""
with vec as materialized (
    select vec_id, label, list_transform(embedding, lambda x: cast(floor(4096 * cast(x as double)) as bigint)) as v
    from embeddings where len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
comp as materialized (
    select vec_id, (i * 8) // len(v) as p, i % (len(v) // 8) as c, v[i + 1] as x from vec, lateral (select unnest(range(len(v))) as i)),
e0 as materialized (
    select p, r - 1 as e, c, x from comp join (select vec_id, row_number() over (order by vec_id) as r from vec) using (vec_id) where r <= 16),
{_codebook_sql(6)},
coded as (
    select vec_id, string_agg(printf('%02x', e), '' order by p) as code, cast(sum(d) as bigint) as error from a6 group by vec_id)
select vec_id, code, error, cast(sum(error) over (partition by label) as bigint) as label_error,
    (select sha256(string_agg(x, ',' order by p, e, c)) from e6) as codebooks_sha256
from coded join vec using (vec_id)
"""

ORACLES["op11_embedding_dups"] = r"""
with recursive sound as materialized (
    select vec_id, cast(embedding as double[]) as v from embeddings
    where len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
        and len(list_filter(embedding, lambda x: x <> 0)) > 0),
links as materialized (
    select a.vec_id as a, b.vec_id as b from sound a join sound b
    on a.vec_id <> b.vec_id and len(a.v) = len(b.v) and list_cosine_similarity(a.v, b.v) >= 0.9),
reach(a, b) as (select a, b from links union select reach.a, links.b from reach join links on reach.b = links.a),
counted as (select a as vec_id, count(*) as n from links group by a),
least as (select a as vec_id, min(b) as m from reach group by a)
select vec_id, coalesce(n, 0) as n_links, least(vec_id, m) as component_id, m is null or vec_id <= m as kept
from embeddings left join counted using (vec_id) left join least using (vec_id)
"""
