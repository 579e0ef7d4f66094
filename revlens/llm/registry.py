"""Registered queries of the package and their DuckDB oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from revlens.llm import (
    ann, chat, decontamination, language, line_dedup, merkle, packing, pii, quality, resampling,
    secret_scan, simhash, warc,
)
from revlens.llm.common import crc32_mod, table

QueryFn = Callable[[SparkSession, str], DataFrame]

# Fixed value: the conversation the first contract adds, a user and an assistant row.
CONFLICT_TEXT = "</s>[INST] ok [/INST]"


def op1_chat_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations plus conversation -7, formatted and read back."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(CONFLICT_TEXT).alias("text"),
    )
    return chat.digest(chat.format_conversations(turns.unionByName(added)))


OP1_SQL = r"""
with src as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '</s>[INST] ok [/INST]'
  union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), t as (
  select *, text = regexp_replace(text, '[<\[]\\*/?(?:s>|INST\]|ROLE\])', '', 'g')
        and role = regexp_replace(role, '[<\[]\\*/?(?:s>|INST\]|ROLE\])', '', 'g') as plain,
         regexp_replace(text, '([<\[])(\\*/?(?:s>|INST\]|ROLE\]))', '\1\\\2', 'g') as etext,
         regexp_replace(role, '([<\[])(\\*/?(?:s>|INST\]|ROLE\]))', '\1\\\2', 'g') as erole
  from src
)
select conv_id, count(*) as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
       coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
       sha256(coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (role = 'assistant'), '')) as loss_sha256,
       sum(length(etext) + case role when 'user' then 13 when 'assistant' then 4
                                     else 26 + length(erole) end)::bigint as formatted_chars,
       sum(case when plain then 0 else 1 end)::bigint as n_escaped,
       true as identical
from t group by conv_id
"""


def op2_warc_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to WARC archives and read back through the chunk table."""
    folder = warc.archive_folder(spark)
    manifest = warc.write_archives(warc.decide(table(spark, sf_dir, "pages")), folder)
    return warc.page_records(warc.read_archives(manifest, folder))


OP2_SQL = f"""
with p as (select page_id, coalesce(html, '') as html from pages),
d as (select page_id, strlen(html)::bigint as payload_bytes, sha1(html) as payload_digest,
             max(page_id) over (partition by sha1(html), strlen(html)) as keeper from p),
r as (select *, payload_bytes >= {warc.MIN_REVISIT_BYTES} and keeper is not null
                and page_id is distinct from keeper as again from d)
select page_id, payload_bytes, payload_digest, case when again then 'revisit' else 'response' end as record_type,
       case when again then keeper end as refers_to,
       case when again then 1 else greatest(1, ceil(payload_bytes / {warc.CHUNK_BYTES}.0))::bigint end as n_chunks
from r
"""


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the boilerplate lines of their source."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return line_dedup.drop_boilerplate(docs, "source")


_Z2 = line_dedup.CONFIDENCE_Z * line_dedup.CONFIDENCE_Z

OP3_SQL = f"""
with p as (select row_number() over () as rid, doc_id, source, text from documents),
l as (select rid, doc_id, source, unnest(string_split(text, chr(10))) as line,
             generate_subscripts(string_split(text, chr(10)), 1) as pos from p),
u as (select source, text, row_number() over () as uid from (select distinct source, text from documents) x),
n as (select source, count(*)::double as total from u group by source),
ul as (select uid, source, unnest(string_split(text, chr(10))) as line from u),
c as (select source, trim(line, ' ') as line, count(distinct uid)::double as n from ul
      where trim(line, ' ') <> '' group by all having count(distinct uid) >= {line_dedup.MIN_PAGES}),
b as (select c.source, c.line from c join n on c.source is not distinct from n.source
      where (c.n / n.total + {_Z2} / (2 * n.total) - {line_dedup.CONFIDENCE_Z} * sqrt(c.n / n.total * (1 - c.n / n.total)
             / n.total + {_Z2} / (4 * n.total * n.total))) / (1 + {_Z2} / n.total) > {line_dedup.BOILERPLATE_RATIO}),
k as (select l.rid, string_agg(l.line, chr(10) order by l.pos) filter (b.line is null) as text,
             count(*) as n_lines, count(b.line) as n_dropped
      from l left join b on l.source is not distinct from b.source and trim(l.line, ' ') = b.line group by l.rid)
select p.doc_id, p.source, case when p.text is null then null else coalesce(k.text, '') end as text,
       case when p.text is null or p.text = '' then 0 else k.n_lines end as n_lines,
       coalesce(k.n_dropped, 0) as n_dropped
from p left join k using (rid)
"""


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secret spans of every document."""
    base = [kind for kind, *_ in secret_scan.BASE]
    found = secret_scan.scan(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", *[F.size(kind).cast("long").alias(f"n_{kind}") for kind in base],
        F.sha2(secret_scan.listed(base), 256).alias("base_sha256"),
        secret_scan.listed([*base, "random"]).alias("spans"))


def op5_kmeans_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest by inner product of every vector whose id is divisible by 20."""
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of every document, packed into sequences of 2048 ids."""
    return packing.pack(table(spark, sf_dir, "documents"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items found in every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontamination.find_items(docs, table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", (F.size("matches") > 0).alias("contaminated"),
                        F.array_distinct(F.transform("matches", lambda m: m["item_id"])).alias("item_ids"),
                        F.to_json("matches").alias("matches"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document; labels of ids whose crc32 mod 3 is 1 are held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    fold = crc32_mod("doc_id", 3)
    model = quality.fit(docs, table(spark, sf_dir, "labels"), fold != 1)
    scored = docs.select("doc_id", F.coalesce(fold == 1, F.lit(False)).alias("held_out"),
                         quality.score(F.col("text"), model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document; ids whose crc32 mod 4 is 2 are held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    fold = crc32_mod("doc_id", 4)
    profiles = language.learn(docs, fold != 2)
    return docs.select("doc_id", F.coalesce(fold == 2, F.lit(False)).alias("held_out"),
                       language.predict(F.col("text"), profiles).alias("p")).select(
        "doc_id", "held_out", "p.lang_pred", "p.score")


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, roots and proof of every document; half of the documents come back without their line ends."""
    docs = table(spark, sf_dir, "documents")
    received = F.when(crc32_mod("doc_id", 2) == 0, F.replace(F.col("text"), F.lit("\n"), F.lit("")))
    return merkle.prove(merkle.build_manifest(docs, received))


# crc32 of the UTF-8 bytes of {0}: a step a bit over a step a byte
_SQL_CRC32 = (
    "xor(4294967295, list_reduce(list_prepend(4294967295::bigint, list_transform(range(0, strlen({0})), "
    "lambda i: ('0x' || substr(hex(encode({0})), 2 * i::int + 1, 2))::bigint)), lambda c, b: list_reduce("
    "list_prepend(xor(c, b), range(0, 8)), lambda x, k: xor(x >> 1, 3988292384 * (x & 1)))))")


def _sql_field(c: str) -> str:
    return f"case when {c} is null then '-' else strlen({c}::varchar) || ':' || {c}::varchar end"


def _sql_climb(state: str, nodes: str, key: str, levels: int, tag: str) -> tuple[str, str, str]:
    """CTEs that climb ``levels`` levels of the trees of ``nodes`` (key, i, h, n) with the rows of ``state``."""
    ctes = []
    for k in range(levels):
        up, runs, on = f"{tag}n{k}", f"{tag}r{k}", f"{tag}s{k}"
        ctes += [
            f"{runs} as materialized (select {key}, i // 3 as i, max(n) as n, list(h order by i) as hs from {nodes} "
            f"group by {key}, i // 3)",
            f"{up} as materialized (select {key}, i, case when n > 1 then sha256(array_to_string(hs, '')) else hs[1] end "
            f"as h, (n + 2) // 3 as n from {runs})",
            f"{on} as materialized (select s.* exclude (i, f, p), s.i // 3 as i, "
            f"case when n = 1 then f else sha256(array_to_string(hs[1:s.i % 3], '') || f || "
            f"array_to_string(hs[s.i % 3 + 2:], '')) end as f, case when n = 1 then p else p || "
            f"array_to_string(hs[1:s.i % 3], '') || array_to_string(hs[s.i % 3 + 2:], '') end as p "
            f"from {state} s join {runs} r on s.{key} = r.{key} and s.i // 3 = r.i)"]
        state, nodes = on, up
    return ",\n".join(ctes), state, nodes


def _op11_sql(levels: int = 14, top_levels: int = 10) -> str:
    """Trees of up to 3^levels documents and 3^top_levels sources."""
    rest = " || ".join(_sql_field(c) for c in ("source", "lang", "n_chars"))
    inner, state, nodes = _sql_climb("s", "n", "tree", levels, "a")
    outer, last, root = _sql_climb("u", "m", "every", top_levels, "b")
    return f"""
with d as (select *, {_sql_field('doc_id')} || {rest} as head, case when doc_id is not null and
             {_SQL_CRC32.format("doc_id::varchar")} % 2 = 0 then replace(text, chr(10), '') else text end as got
           from documents),
l as (select doc_id, coalesce('=' || source, '') as tree, sha256(head || {_sql_field('text')}) as leaf,
             sha256(head || {_sql_field('got')}) as f from d),
s as materialized (select *, row_number() over (partition by tree order by doc_id nulls first, leaf) - 1 as i, '' as p
                   from l),
n as (select tree, i, leaf as h, count(*) over (partition by tree) as n from s),
{inner},
m as materialized (select 1 as every, tree, row_number() over (order by tree) - 1 as i, h, count(*) over () as n
                   from {nodes}),
u as (select s.* exclude (i), m.i, m.h as subroot, 1 as every from {state} s join m using (tree)),
{outer}
select doc_id, leaf, subroot, h as root, sha256(p) as proof_sha256, f as folded_root, f = h as verified,
       (length(p) // 64)::int as proof_nodes
from {last} join {root} using (every)"""


OP11_SQL = _op11_sql()


def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its importance weight towards the benchmark texts; the drawn twentieth has ranks."""
    drawn = resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


_SQL_WORDS = (r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
              r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")

OP12_SQL = f"""
with d as (select row_number() over () as rid, doc_id, coalesce({_SQL_WORDS}, []) as w from documents),
b as (select coalesce({_SQL_WORDS}, []) as w from benchmark),
df as (select rid, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]),
              list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))) as f from d),
bf as (select unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]),
              list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))) as f from b),
dn as materialized (select rid, f, count(*) as n from df group by all),
c as materialized (select f, {_SQL_CRC32.format("f")} % {resampling.BUCKETS} as bucket
                   from (select f from dn union select f from bf)),
dc as (select bucket, sum(n)::bigint as s from dn join c using (f) group by bucket),
bc as (select bucket, count(*) as t from bf join c using (f) group by bucket),
g as (select x as bucket, floor(1000 * ln((coalesce(t, 0) + 1) * ((select coalesce(sum(s), 0) from dc) + {resampling.BUCKETS})::double
             / ((coalesce(s, 0) + 1) * ((select coalesce(sum(t), 0) from bc) + {resampling.BUCKETS})::double)))::bigint as gain
      from range(0, {resampling.BUCKETS}) r(x) left join dc on dc.bucket = x left join bc on bc.bucket = x),
wt as (select rid, sum(n)::bigint as n_features, sum(n * gain)::bigint as weight
       from dn join c using (f) join g using (bucket) group by rid),
sc as (select doc_id, len(w) as n_words, coalesce(n_features, 0) as n_features, coalesce(weight, 0) as weight,
              coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('{resampling.NOISE_SEED}:' ||
              coalesce(doc_id::varchar, '')), 1, 8))::bigint + 0.5) / 4294967296.0)))::bigint as score
       from d left join wt using (rid)),
rk as (select *, row_number() over (order by n_words >= {resampling.MIN_WORDS} desc, score desc, doc_id) as r,
              floor(count(*) filter (n_words >= {resampling.MIN_WORDS}) over () * {resampling.PERCENT} / 100) as k from sc)
select doc_id, n_features, weight, score, case when r <= k then r end as rank from rk"""


def op13_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document: spans of the four forms and those that their contexts reveal."""
    found = pii.find_personal_data(table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return found.select("doc_id", *[count(kind).alias(f"n_{kind}") for kind in pii.KINDS],
                        F.sha2(pii.listed(F.col("base")), 256).alias("base_sha256"),
                        pii.listed(F.col("spans")).alias("spans"))


QUERIES: dict[str, tuple[QueryFn, str | None]] = {
    "op1_chat_round_trip": (op1_chat_round_trip, OP1_SQL),
    "op2_warc_chunks": (op2_warc_chunks, OP2_SQL),
    "op3_line_dedup": (op3_line_dedup, OP3_SQL),
    "op4_secrets": (op4_secrets, None),
    "op5_kmeans_tree": (op5_kmeans_tree, None),
    "op6_packing": (op6_packing, None),
    "op7_decontamination": (op7_decontamination, None),
    "op8_quality": (op8_quality, None),
    "op9_language": (op9_language, None),
    "op10_simhash": (op10_simhash, None),
    "op11_merkle": (op11_merkle, OP11_SQL),
    "op12_resampling": (op12_resampling, OP12_SQL),
    "op13_pii": (op13_pii, None),
    "pipeline": (corpus_pipeline.run, corpus_pipeline.ORACLE_SQL),
}
