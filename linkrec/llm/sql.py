"""DuckDB SQL of the llm queries that SQL can state."""

from linkrec.llm.licenses import TEMPLATES, THRESHOLD

#: CRC-32 over the UTF-8 bytes: the byte table from its polynomial, then one fold per text.
CRC = """
crc_table as (select list(c order by i) t from (
  select i, list_reduce(list_prepend(i, range(8)),
                        lambda c, k: case when c & 1 = 1 then xor(3988292384, c >> 1) else c >> 1 end) c
  from range(256) r(i))),
crcs as (select doc_id, text, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT,
    list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'),
                   lambda x: ('0x' || x)::BIGINT)),
    lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)]))) text_crc32
  from documents, crc_table)
"""

SHARDING = f"""
with {CRC},
scores as (select doc_id, text, text_crc32, s,
    -ln((('0x' || substr(md5(coalesce(doc_id::varchar, chr(0)) || '|' || s), 1, 13))::BIGINT + 0.5::DOUBLE)
        / 4503599627370496::DOUBLE) score
  from crcs, range(9) r(s)),
best as (select doc_id, text, text_crc32,
    arg_min(s, score) filter (s < 8) shard, arg_min(s, score) grown_shard
  from scores group by all)
select doc_id, strlen(coalesce(text, '')) + 1 as size, text_crc32, 'key' as law, shard::INT shard,
  row_number() over (partition by shard order by
     ('0x' || substr(md5(coalesce(doc_id::varchar, chr(0))), 1, 13))::BIGINT, doc_id) - 1 as slot,
  grown_shard::INT grown_shard
from best
"""

LINES = """
with docs as (select doc_id, string_split(coalesce(text, ''), chr(10)) ls from documents),
lines as (select doc_id, unnest(ls) line, generate_subscripts(ls, 1) pos from docs),
keys as (select *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') k from lines),
owners as (select k, min(doc_id) o from keys where length(k) >= 10 group by k),
marked as (select doc_id, line, pos, coalesce(doc_id > o, false) gone from keys left join owners using (k))
select doc_id, count(*) n_lines, count(*) filter (gone) n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by pos) filter (not gone), '')) kept_sha256
from marked group by doc_id
"""

_ROWS = ", ".join("('{}', '{}')".format(k, v.replace("'", "''")) for k, v in sorted(TEMPLATES.items()))
LICENSES = f"""
with units as (
  select doc_id, unnest(list_concat(string_split(text, chr(10)),
    list_filter(regexp_split_to_array(text, '\\n[ \\t\\r]*\\n'), lambda p: contains(trim(p, ' '), chr(10))))) u
  from documents where text is not null),
cut as (select doc_id, list_filter(regexp_split_to_array(lower(u), '[^\\p{{L}}\\p{{N}}]+'), lambda x: x <> '') w from units),
unit as (select doc_id, array_to_string(w, ' ') t, any_value(list_distinct([w[i] || ' ' || w[i + 1] for i in range(1, len(w))])) b,
    count(*) c from cut where len(w) > 1 group by doc_id, t),
raw(license, template) as (values {_ROWS}),
tw as (select license, list_filter(regexp_split_to_array(lower(template), '[^\\p{{L}}\\p{{N}}]+'), lambda x: x <> '') w from raw),
tb as (select license, list_distinct([w[i] || ' ' || w[i + 1] for i in range(1, len(w))]) b from tw),
pairs as (select doc_id, c, license, 2.0::DOUBLE * len(list_intersect(unit.b, tb.b)) / (len(unit.b) + len(tb.b)) dice
  from unit, tb where len(unit.b) between len(tb.b) / 2 and len(tb.b) * 2)
select doc_id, license, sum(c)::BIGINT n_units, round(max(dice), 6) dice from pairs
where dice >= {THRESHOLD} - 1e-9 group by doc_id, license
"""
