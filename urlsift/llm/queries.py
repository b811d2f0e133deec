"""Registered queries of the operators and, where SQL can say it, their DuckDB statements."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from urlsift.llm import collocations, conversation_trie, decontaminate, fixity, language_id, licenses, line_dedup, mixing, quality, secrets, simhash, token_counts, top_k
from urlsift.llm.common import read


def _part(name: str, n: int):
    """crc32 of an id as text, modulo n; null for a null id."""
    return F.crc32(F.col(name).cast("string").cast("binary")) % n


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from those whose remainder is not 1. A null id is held out."""
    docs = read(spark, sf_dir, "documents")
    held_out = F.coalesce(_part("doc_id", 3) == 1, F.lit(True))
    model = language_id.fit_languages(docs.filter(~held_out), F.col("text"), F.col("lang"))
    found = docs.select("doc_id", held_out.alias("held_out"), language_id.language(spark, model, F.col("text")).alias("p"))
    return found.select("doc_id", "held_out", "p.lang_pred", "p.score")


def op2_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings").select("vec_id", top_k.quantized(F.col("embedding")).alias("vector"))
    return top_k.top_k(vectors.filter("vec_id % 20 = 0"), vectors, 20)


OP2_SQL = r"""
with v as (
  select vec_id, list_transform(embedding, lambda x: floor(64 * x::double)) as w from embeddings
  where embedding is not null and vec_id is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
  select q.vec_id as query_id, c.vec_id, list_dot_product(q.w, c.w)::bigint as score
  from v q join v c on q.vec_id % 20 = 0 and q.vec_id <> c.vec_id
)
select query_id, row_number() over (partition by query_id order by score desc, vec_id)::integer as rank, vec_id, score
from scored qualify rank <= 20
"""


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    digest = F.sha2(F.array_join("item_ids", ","), 256)
    return found.select(
        F.col("id").alias("doc_id"), "n_words", "n_hit", "n_items", digest.alias("items_sha256"),
        decontaminate.is_contaminated().alias("contaminated"),
    )


def op3_near(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of op3_decontaminate, and beside them the items with proximity matches."""
    found = decontaminate.contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), near=True)
    digest = {c: F.sha2(F.array_join(c, ","), 256) for c in ("item_ids", "near_ids")}
    return found.select(
        F.col("id").alias("doc_id"), "n_words", "n_hit", "n_items", digest["item_ids"].alias("items_sha256"),
        decontaminate.is_contaminated().alias("contaminated"), "n_near", digest["near_ids"].alias("near_sha256"),
    )


OP3_SQL = r"""
with d as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from documents
), b as (
  select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from benchmark
), starts as (
  select item_id, w, least(len(w), 13) as size, unnest(range(1, greatest(len(w) - 13, 0) + 2)) as o from b where len(w) > 0
), windows as (
  select distinct item_id, size, array_to_string(w[o:o + size - 1], ' ') as phrase from starts
), places as (
  select doc_id, w, unnest(range(1, len(w) + 1)) as p from d
), phrases as (
  select doc_id, p, size, array_to_string(w[p:p + size - 1], ' ') as phrase
  from places, (select distinct size from windows) where p + size - 1 <= len(w)
), found as (
  select doc_id, p, size, item_id from phrases join windows using (size, phrase)
), hit as (
  select doc_id, count(distinct q) as n_hit from (select doc_id, unnest(range(p, p + size)) as q from found) group by doc_id
), listed as (
  select doc_id, count(*) as n_items, string_agg(item_id::varchar, ',' order by item_id::varchar) as ids
  from (select distinct doc_id, item_id from found) group by doc_id
)
select d.doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
       sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
from d left join hit using (doc_id) left join listed using (doc_id)
"""


def op4_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages as WARC records in files of a thousand, against a replica in which records whose id has crc32 remainder 5
    (of 64) have a changed byte and those of remainder 9 are lost. Returns every record that the audit finds."""
    pages = read(spark, sf_dir, "pages")
    data = fixity.record_bytes(F.col("page_id"), F.col("url"), F.col("html"))
    part = _part("page_id", 64)
    damaged = F.when(part == 5, F.concat(F.lit("w"), F.substring(data, 2, 2**31 - 1))).otherwise(data)

    def hashed(record):
        return F.sha2(record.cast("binary"), 256)

    length = F.octet_length(data).cast("long").alias("length")
    rows = pages.select(F.col("page_id").alias("number"), length, hashed(data).alias("hash"))
    kept = fixity.build(fixity.laid_out(rows, ["hash"]))
    theirs = pages.select(F.col("page_id").alias("number"), length, hashed(data).alias("own"), hashed(damaged).alias("hash"), part.alias("part"))
    placed = fixity.laid_out(theirs, ["own"]).filter("part is null or part <> 9")
    replica = fixity.build(placed)
    found = fixity.audit(kept, replica)
    kept.drop()
    replica.drop()
    return found


OP4_SQL = r"""
with records as (
  select page_id, 'WARC/1.0' || chr(13) || chr(10) || 'WARC-Type: resource' || chr(13) || chr(10) || 'WARC-Record-ID: <urn:page:'
         || coalesce(page_id::varchar, '') || '>' || chr(13) || chr(10) || 'WARC-Date: 1970-01-01T00:00:00Z' || chr(13) || chr(10)
         || 'WARC-Target-URI: ' || coalesce(url, '') || chr(13) || chr(10) || 'Content-Type: text/html' || chr(13) || chr(10)
         || 'Content-Length: ' || strlen(coalesce(html, ''))::varchar || chr(13) || chr(10) || chr(13) || chr(10)
         || coalesce(html, '') || chr(13) || chr(10) || chr(13) || chr(10) as data
  from pages
), hashed as (
  select *, strlen(data)::bigint as length, sha256(data) as hash, sha256('w' || substr(data, 2)) as broken,
         'pages-' || lpad((page_id // 1000)::varchar, 9, '0') || '.warc' as file
  from records
), placed as (
  select *, coalesce(sum(length) over (partition by file order by page_id, hash rows between unbounded preceding and 1 preceding),
                     0)::bigint as offset
  from hashed
), bits as (
  -- CRC-32 of the id's digits, a byte at a time and eight steps a byte
  select *, list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(page_id::varchar, ''), lambda c: ascii(c)::bigint)),
    lambda crc, byte: list_reduce([xor(crc, byte), 1, 2, 3, 4, 5, 6, 7, 8],
      lambda x, step: case when x % 2 = 1 then xor(x // 2, 3988292384) else x // 2 end)) as crc
  from placed
), judged as (
  select *, xor(crc, 4294967295) % 64 as part from bits
)
select file, "offset", length, case when part = 5 then length end as found_length, hash,
       case when part = 5 then broken end as found_hash, case when part = 5 then 'changed' else 'missing' end as damage
from judged where part in (5, 9)
"""


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.dedup_lines(read(spark, sf_dir, "documents"))
    return found.select("doc.doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


OP5_SQL = r"""
with lines as (
  select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as pos
  from documents
), keyed as (
  select doc_id, pos, line,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
  from lines
), owners as (
  select key, min(doc_id) as owner from keyed where length(key) >= 10 group by key
), judged as (
  select k.*, coalesce(o.owner <> k.doc_id, false) as gone from keyed k left join owners o on k.key = o.key and length(k.key) >= 10
)
select doc_id, count(*)::bigint as n_lines, (count(*) filter (where gone))::bigint as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where not gone), '')) as kept_sha256
from judged group by doc_id
"""


def op6_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixing.mix(read(spark, sf_dir, "documents")).taken()
    return found.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


def op6_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which slots of the schedule of op6_mix take words of each document."""
    return mixing.mix(read(spark, sf_dir, "documents")).slots().withColumnRenamed("id", "doc_id")


OP6_SQL = r"""
with d as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size,
         md5(coalesce(doc_id::varchar, '')) as key
  from documents
), sizes as (
  select source, sum(size)::bigint as source_size, row_number() over (order by source nulls last) as s from d group by source
), weighed as (
  select *, [5, 2, 1][(s - 1) % 3 + 1]::bigint as weight, 3 * source_size as cap from sizes
), levels as (
  select *, row_number() over o as rank,
         (sum(source_size) over () - coalesce(sum(cap) over (o rows between unbounded preceding and 1 preceding), 0))::double
         / (sum(weight) over (o rows between current row and unbounded following))::double as level
  from weighed window o as (order by cap / weight, s)
), targets as (
  select source, source_size, least(cap::double, weight * coalesce(
    (select arg_min(level, rank) from levels where weight * level <= cap), 0.0)) as target
  from levels
), placed as (
  select doc_id, size, source_size, target, floor(target)::bigint as quota,
         coalesce(sum(size) over (partition by d.source order by key, doc_id, size rows between unbounded preceding and 1 preceding),
                  0)::bigint as start
  from d join targets t on d.source is not distinct from t.source
)
select doc_id, size, source_size, target,
       case when size = 0 then 0
            else quota // source_size * size + greatest(0, least(start + size, quota % source_size) - start) end::bigint as taken
from placed
"""


#: A document is predicted good from this probability on.
GOOD = 0.3


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document, learned from labels whose remainder is not 0. A null id is held out."""
    docs = read(spark, sf_dir, "documents")
    held_out = F.coalesce(_part("doc_id", 5) == 0, F.lit(True))
    labels = read(spark, sf_dir, "labels").filter(~held_out).select("doc_id", "quality")
    model = quality.fit_quality(docs.filter(~held_out).select("doc_id", "text"), labels)
    found = docs.select("doc_id", held_out.alias("held_out"), quality.quality(spark, model, F.col("text")).alias("score"))
    return found.withColumn("predicted", (F.col("score") >= GOOD).cast("int"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read(spark, sf_dir, "documents"))
    digits = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return found.select(F.col("id").alias("doc_id"), digits.alias("fingerprint"), F.col("component").alias("component_id"))


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = read(spark, sf_dir, "documents").select("doc_id", licenses.licenses(F.col("text")).alias("f"))

    def labels(*spans: str):
        names = F.concat(*[F.transform(s, lambda x: x["label"]) for s in spans])
        return F.array_join(F.array_sort(F.array_distinct(names)), ",")

    first = F.transform("f.phrases", lambda x: x["first"])
    return found.select(
        "doc_id", "f.n_words", F.size("f.phrases").cast("long").alias("n_base"), F.array_min(first).alias("first_word"),
        F.array_max(first).alias("last_word"), labels("f.phrases").alias("base_labels"),
        labels("f.phrases", "f.notices").alias("labels"), "f.score",
    )


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = read(spark, sf_dir, "documents").select("doc_id", secrets.secrets(F.col("text")).alias("f"))
    return found.select("doc_id", "f.n_assign", "f.n_access", "f.n_hex", F.sha2("f.base", 256).alias("base_sha256"), "f.spans")


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document by the public byte-level vocabulary of 50,000 entries."""
    import public_tokenizers

    docs = read(spark, sf_dir, "documents")
    counter = token_counts.fit_counter(docs, F.col("text"), public_tokenizers.path("byte_bpe_50k.json"))
    found = docs.select("doc_id", F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"), token_counts.tokens(spark, counter, F.col("text")).alias("n_tokens"))
    return found.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


#: A document with more tokens doesn't fit.
TOKEN_LIMIT = 1024


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(read(spark, sf_dir, "documents"))


OP12_SQL = r"""
with pieces as (
  select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece
  from documents
), split as (
  select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from pieces
), places as (
  select lang, w, unnest(range(1, len(w) + 1)) as i from split
), counts as (
  select lang, size, array_to_string(w[i:i + size - 1], ' ') as phrase, count(*) as f
  from places, (select unnest([1, 2, 3, 4]) as size) where i + size - 1 <= len(w) group by all
), totals as (
  select lang, sum(f)::bigint as n from counts where size = 1 group by lang
), candidates as (
  select lang, size, phrase, string_split(phrase, ' ') as w, f as a from counts where size > 1 and f >= 30
), cuts as (
  select c.lang, c.phrase, c.a, k, l.f as l, r.f as r, (2000000::hugeint * c.a) // (l.f + r.f) as score
  from (select *, unnest(range(1, size)) as k from candidates) c
  join counts l on l.lang = c.lang and l.phrase = array_to_string(c.w[1:k], ' ')
  join counts r on r.lang = c.lang and r.phrase = array_to_string(c.w[k + 1:], ' ')
), scored as (
  select * from cuts qualify row_number() over (partition by lang, phrase order by score, k) = 1
), parts as (
  select lang, a as longer, array_to_string(w[i:i + n - 1], ' ') as phrase
  from (select *, unnest(range(2, size)) as n from candidates), (select unnest([1, 2, 3]) as i) where i + n - 1 <= size
), inside as (
  select lang, phrase, max(longer) as longer from parts group by all
), kept as (
  select s.* from scored s left join inside using (lang, phrase) where longer is null or 100 * longer < 80 * a
)
select lang, row_number() over (partition by lang order by score desc, a desc, encode(phrase)) as rank, phrase, a, l, r, n, score::bigint as score
from kept join totals using (lang) qualify rank <= 2000
"""


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.prefix_trie(read(spark, sf_dir, "conversations"))


OP13_SQL = r"""
with turns as (
  select conv_id as c, coalesce(role, '') as role, coalesce(text, '') as text,
         row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as j
  from conversations where conv_id is not null
), convs as (
  -- CRC-32 of the number's digits, a byte at a time and eight steps a byte
  select c, c - c % 5 as base, max(j) as own,
         xor(list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(c::varchar, ''), lambda x: ascii(x)::bigint)),
           lambda crc, byte: list_reduce([xor(crc, byte), 1, 2, 3, 4, 5, 6, 7, 8],
             lambda x, step: case when x % 2 = 1 then xor(x // 2, 3988292384) else x // 2 end)), 4294967295) % 9 as h
  from turns group by c
), placed as (
  select v.c, t.j as place, t.role, t.text from convs v join turns t on t.c = v.base and t.j <= v.h
  union all
  select v.c, t.j + 1000, t.role, t.text from convs v join turns t on t.c = v.c and t.j > v.h
), rebuilt as (
  select c, row_number() over (partition by c order by place) as d, role, text from placed
), prefixes as (
  select c, d, strlen(text) as bytes, list({'role': role, 'text': text}) over (partition by c order by d) as prefix from rebuilt
  union all
  select c, 0, 0, []::struct(role varchar, "text" varchar)[] from convs
), ends as (
  select c, max(d) as len from prefixes group by c
), nodes as (
  select min(c) as conv_id, d as depth, sha256(prefix::varchar || len(prefix)) as key, sha256(prefix[1:d - 1]::varchar || (d - 1)) as up, prefix,
         count(*) as n_convs, max(bytes) as bytes,
         sha256(coalesce(string_agg(c::varchar, ',' order by c) filter (where d = len), '')) as ends_sha256
  from prefixes join ends using (c) group by d, prefix
), grown as (
  select n.*, p.conv_id as parent_conv_id, (select count(*) from nodes k where k.depth = n.depth + 1 and k.prefix[1:n.depth] = n.prefix) as n_children
  from nodes n left join nodes p on p.depth = n.depth - 1 and p.prefix = n.prefix[1:n.depth - 1]
)
select n.conv_id, n.depth::bigint as depth, n.parent_conv_id, n.n_convs, n.n_children,
       count(*) filter (where u.n_children = 0) as n_leaves, sum((u.n_convs - 1) * u.bytes)::bigint as saved_tokens, n.ends_sha256
from grown n join grown u on u.depth >= n.depth and u.prefix[1:n.depth] = n.prefix
group by all
"""


QUERIES = {
    "op1_language_id": op1_language_id, "op2_top_k": op2_top_k, "op3_decontaminate": op3_decontaminate, "op3_near": op3_near,
    "op4_fixity": op4_fixity, "op5_line_dedup": op5_line_dedup, "op6_mix": op6_mix, "op6_slots": op6_slots, "op7_quality": op7_quality, "op8_simhash": op8_simhash,
    "op9_licenses": op9_licenses, "op10_secrets": op10_secrets, "op11_token_counts": op11_token_counts,
    "op12_collocations": op12_collocations, "op13_conversation_trie": op13_conversation_trie,
}

SQL: dict[str, str] = {
    "op2_top_k": OP2_SQL, "op3_decontaminate": OP3_SQL, "op4_fixity": OP4_SQL, "op5_line_dedup": OP5_SQL, "op6_mix": OP6_SQL,
    "op12_collocations": OP12_SQL, "op13_conversation_trie": OP13_SQL,
}
