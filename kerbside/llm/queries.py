"""The queries of this subpackage and, where SQL can say it, the same for DuckDB."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.llm import (
    bpe,
    chat,
    divergence,
    html_text,
    language,
    merkle,
    mixing,
    neighbours,
    pii,
    repair,
    rollups,
    similarity,
    toxicity,
)
from kerbside.llm.frames import n_words, stage, table
from kerbside.session import staging_path


def op1_pii_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in all documents; the field is trained on its small labelled table."""
    return pii.digests(table(spark, sf_dir, "documents"), pii.train(pii.labelled_table()))


def op2_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts on all documents, against references learned from all of them."""
    documents = table(spark, sf_dir, "documents")
    return divergence.judge(documents, divergence.learn(documents))


def op3_prefix_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Examples of all conversations and of one whose texts hold control strings."""
    odd = "\\### Assistant: </turn> ok"
    extra = spark.createDataFrame(
        [(-7, 0, "user", odd), (-7, 1, "assistant", odd)], "conv_id long, turn long, role string, text string"
    )
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return chat.digest(chat.expand(rows))


OP3_SQL = r"""
with rows as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '\### Assistant: </turn> ok'
  union all select -7, 1, 'assistant', '\### Assistant: </turn> ok'
), sized as (
  select *, row_number() over w as n,
    length(replace(replace(replace(role, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'))
    + length(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')) + length('<turn ') + length('></turn>') as chars
  from rows window w as (partition by conv_id order by turn nulls first, role, text)
), prefixes as (
  select *, sum(chars) over (partition by conv_id order by n) as prefix, max(n) over (partition by conv_id) as top from sized
)
select conv_id, max(top) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by n)) as turns_sha256,
  coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(text, '' order by n) filter (role = 'assistant'), '')) as loss_sha256,
  (sum(prefix) filter (role = 'assistant' or n = top))::bigint as formatted_chars
from prefixes group by conv_id
"""


#: A document is toxic from this score on.
TOXIC_FROM = 0.3

#: The vocabulary that the BPE queries use.
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents to tokens and back."""
    return bpe.round_trip(table(spark, sf_dir, "documents"), VOCABULARY)


def op5_tag_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages."""
    return html_text.extract(table(spark, sf_dir, "pages"))


def op6_block_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest vectors of each vector whose id is divisible by 100."""
    return neighbours.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


OP6_SQL = """
with vectors as (
  select vec_id, min(embedding) as embedding from embeddings
  where vec_id is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    and len(list_filter(embedding, lambda x: x <> 0)) > 0
  group by vec_id
), pairs as (
  select q.vec_id as query_id, c.vec_id, sqrt(list_reduce(list_transform(
    list_zip(q.embedding::double[], c.embedding::double[]), lambda x: (x[1] - x[2]) * (x[1] - x[2])), lambda x, y: x + y)) as score
  from vectors q join vectors c on q.vec_id <> c.vec_id and len(q.embedding) = len(c.embedding)
  where q.vec_id % 100 = 0
)
select query_id, (row_number() over (partition by query_id order by score, vec_id))::int as rank, vec_id, score
from pairs qualify rank <= 10
"""


#: Token counts of this query: words, and letter or digit runs and single other characters.
WORDS_1, PIECES_1 = r"[^\x20\x09-\x0D]+", r"[A-Za-z0-9]+|[^A-Za-z0-9\x20\x09-\x0D]"
#: What the revision of pieces-1 counts: digits stand alone.
PIECES_1B = r"[A-Za-z]+|[^A-Za-z\x20\x09-\x0D]"


def op7_token_rollups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals after four batches over all documents, one of them delivered twice.

    Inserts of all documents under words-1 and under pieces-1, a revision of
    every count under pieces-1, and deletes of every document whose text a
    smaller doc_id has, under both.
    """
    count = lambda pattern: F.coalesce(F.regexp_count("text", F.lit(pattern)), F.lit(0)).cast("long")
    documents = table(spark, sf_dir, "documents").select(
        "doc_id", "source", "lang", F.sha2("text", 256).alias("text_sha"),
        n_words().alias("w"), count(PIECES_1).alias("p"), count(PIECES_1B).alias("r"),
    )
    documents = stage(documents, "token-counts")
    first = documents.groupBy(F.col("text_sha").alias("sha")).agg(F.min("doc_id").alias("first_id"))
    copies = documents.join(first, F.col("text_sha").eqNullSafe(F.col("sha"))).where(F.col("doc_id") > F.col("first_id"))

    def change(rows: DataFrame, kind: str, version: str, tokens: str, old: str | None = None) -> DataFrame:
        return rows.select(
            F.lit(kind).alias("kind"), "source", "lang", F.lit(version).alias("tokenizer_version"),
            F.col(tokens).alias("tokens"), (F.col(old) if old else F.lit(None).cast("long")).alias("old_tokens"),
        )

    rollup = rollups.TokenRollup(spark, staging_path(spark, "token-rollups"))
    inserts = change(documents, "insert", "words-1", "w").unionByName(change(documents, "insert", "pieces-1", "p"))
    rollup.commit("1-inserts", inserts)
    rollup.commit("2-revisions", change(documents, "revise", "pieces-1", "r", "p"))
    rollup.commit("3-deletes", change(copies, "delete", "words-1", "w").unionByName(change(copies, "delete", "pieces-1", "r")))
    rollup.commit("1-inserts", inserts)
    return rollup.totals()


OP7_SQL = r"""
with counted as (
  select doc_id, source, lang, min(doc_id) over (partition by text) as first_id,
    coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) as w,
    coalesce(len(regexp_extract_all(text, '[A-Za-z]+|[^A-Za-z\x20\x09-\x0D]')), 0) as r
  from documents
), kept as (select * from counted where doc_id = first_id or doc_id is null)
select source, lang, 'words-1' as tokenizer_version, count(*)::bigint as docs, sum(w)::bigint as tokens from kept group by 1, 2
union all
select source, lang, 'pieces-1', count(*)::bigint, sum(r)::bigint from kept group by 1, 2
"""


def op8_pivotal_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that a mix of all documents takes from each."""
    plan = mixing.mix(table(spark, sf_dir, "documents"))
    return plan.select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


def op9_chosen_path_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate class and the number of links of all documents."""
    found = similarity.join(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "class_id", "n_links", "n_text_links")


def op10_toxic_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents, learned from the labels of three quarters of the ids."""
    documents = table(spark, sf_dir, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    model = toxicity.train(documents, table(spark, sf_dir, "labels").where(~held_out))
    scores = toxicity.score(documents, model)
    return scores.select(
        "doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"), "n_segments", "best_start", "best_end",
    )


def op11_byte_network(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of all documents, learned from three quarters of the ids."""
    documents = table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    found = language.identify(documents, language.train(documents.where(~held_out)))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op12_repair_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, damaged by rule, with their faults and cheapest repairs."""
    conversations = table(spark, sf_dir, "conversations")
    return repair.repair(repair.damage(conversations), conversations)


#: The checksum of ASCII texts, by its definition: 8 steps for each character.
CRC32_SQL = """xor(4294967295, list_reduce([4294967295::bigint] || flatten(list_transform(string_split({0}, ''),
  lambda ch: [ascii(ch)::bigint, -1, -1, -1, -1, -1, -1, -1, -1])),
  lambda c, x: case when x >= 0 then xor(c, x) when c % 2 = 1 then xor(c >> 1, 3988292384) else c >> 1 end))"""

OP12_SQL = r"""
with recursive hashed as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
    """ + CRC32_SQL.format("coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ')") + r""" % 20 as kind
  from conversations
), damaged as (
  select conv_id, turn, case when kind = 4 then 'user' else role end as role,
    case kind when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text,
    unnest(case kind when 0 then []::int[] when 3 then [0, 1] else [0] end) as copy
  from hashed
), placed as (
  select *, row_number() over (partition by conv_id order by turn nulls first, role, sha256(text), seen) - 1 as i, seen > 1 as again,
    not regexp_matches(text, '[^\x20\x09-\x0D]') as blank, not regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') as cut
  from (select *, row_number() over (partition by conv_id, role, text order by turn nulls first, copy) as seen from damaged)
), coded as (
  select *, case when blank then 1 when again then 2 when cut then 3 else 0 end as fault, left(role, 1) as r,
    left(role, 1) || lead(left(role, 1)) over (partition by conv_id order by i) as pair from placed
), counts as (
  select conv_id, count(*) as n, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0)::bigint as gaps,
    count(*) filter (fault = 1) as blank, count(*) filter (fault = 2) as duplicate, count(*) filter (fault = 3) as truncated,
    count(*) filter (pair not in ('su', 'ua', 'au')) as illegal
  from coded group by conv_id
), costs as (  -- from the end backwards: least costs from each state (0 begin, 1 after s, 2 after u, 3 after a)
  select conv_id, n as i, [0, 6, 3, 0]::bigint[] as v from counts
  union all
  select conv_id, i, [least(w[1], 3 + w[3], 6 + w[4]), least(w[2], 3 + w[3], 6 + w[4]), least(w[3], 3 + w[4]), least(w[4], 3 + w[3])]
  from (
    select c.conv_id, c.i, case when c.fault in (1, 2) then list_transform(k.v, lambda x: x + 4) else [
      least(4 + k.v[1], t + case c.r when 's' then least(k.v[2], 3 + k.v[3]) when 'u' then k.v[3] else 3 + k.v[3] end),
      least(4 + k.v[2], t + case c.r when 'u' then k.v[3] else 3 + k.v[3] end),
      least(4 + k.v[3], t + case c.r when 'a' then k.v[4] else 3 + k.v[4] end),
      least(4 + k.v[4], t + case c.r when 'u' then k.v[3] else 3 + k.v[3] end)] end as w
    from costs k join (select *, case when fault = 3 then 3 else 0 end as t from coded) c on c.conv_id is not distinct from k.conv_id and c.i = k.i - 1
  )
), walk as (  -- forward: the ASCII-least edit that is on a cheapest path
  select conv_id, 0::bigint as i, 0 as s, '' as audit, []::varchar[] as texts, false as done from counts
  union all
  select conv_id, case when edit in ('D', 'K', 'R') then i + 1 else i end,
    case edit when 'D' then s when 'K' then case r when 's' then 1 when 'u' then 2 else 3 end when 'E' then s else case when s = 2 then 3 else 2 end end,
    case edit when 'E' then audit else audit || edit end,
    case edit when 'K' then texts || [role || ':' || text] when 'R' then texts || [case when s = 2 then 'assistant' else 'user' end || ':' || text]
      when 'I' then texts || [case when s = 2 then 'assistant:' else 'user:' end] else texts end, edit = 'E'
  from (
    select w.*, c.r, c.role, c.text, case
      when c.i is null and here.v[w.s + 1] = 0 then 'E'
      when c.i is null then 'I'
      when here.v[w.s + 1] = 4 + after.v[w.s + 1] then 'D'
      when here.v[w.s + 1] = 3 + here.v[case when w.s = 2 then 4 else 3 end] then 'I'
      when c.r = case when w.s = 2 then 'a' else 'u' end then 'K'
      when c.r = 's' and w.s = 0 and here.v[1] = after.v[2] + case when c.fault = 3 then 3 else 0 end then 'K'
      else 'R' end as edit
    from walk w join costs here on here.conv_id is not distinct from w.conv_id and here.i = w.i
    left join coded c on c.conv_id is not distinct from w.conv_id and c.i = w.i
    left join costs after on after.conv_id is not distinct from w.conv_id and after.i = w.i + 1
    where not w.done
  )
)
select o.conv_id, coalesce(gaps, 0)::bigint as gaps, coalesce(blank, 0)::bigint as blank, coalesce(duplicate, 0)::bigint as duplicate,
  coalesce(truncated, 0)::bigint as truncated, coalesce(illegal, 0)::bigint as illegal, coalesce(k.v[1], 0)::bigint as cost,
  coalesce(audit, '') as audit, sha256(coalesce(array_to_string(texts, chr(10)), '')) as repaired_sha256
from (select distinct conv_id from conversations) o left join counts c on c.conv_id is not distinct from o.conv_id
left join costs k on k.conv_id is not distinct from o.conv_id and k.i = 0
left join (select * from walk where done) w on w.conv_id is not distinct from o.conv_id
"""


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest of all documents, some of them tampered with."""
    tampered = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    return merkle.manifest(table(spark, sf_dir, "documents"), tampered)


_FIELD = "coalesce(strlen({0}::varchar)::varchar || ':' || {0}::varchar, '-')"
_LEAF = " || ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", "{n}", "text"))

OP13_SQL = f"""
with recursive leaves as (
  select doc_id, lang, sha256({_LEAF.format(n="n_chars")}) as leaf,
    case when {CRC32_SQL.format("doc_id::varchar")} % 7 = 0 then sha256({_LEAF.format(n="(n_chars + 1)")}) end as bad
  from documents
), placed as (
  select *, row_number() over w - 1 as pos, count(*) over (partition by lang) as n from leaves window w as (partition by lang order by doc_id nulls first, leaf)
), nodes as (
  select lang, 0 as lvl, pos, leaf as digest, n from placed
  union all
  select lang, lvl + 1, pos // 2, sha256(string_agg(digest, '' order by pos)), (n + 1) // 2 from nodes where n > 1 group by lang, lvl, pos // 2, n
), subroots as (
  select lang, digest, lvl, row_number() over (order by lang nulls first) - 1 as pos, count(*) over () as n from nodes where n = 1
), above as (
  select 0 as lvl, pos, digest, n from subroots
  union all
  select lvl + 1, pos // 2, sha256(string_agg(digest, '' order by pos)), (n + 1) // 2 from above where n > 1 group by lvl, pos // 2, n
), own as (
  select p.lang, p.pos, l.lvl, (p.pos >> l.lvl) % 2 = 1 as odd, s.digest as sibling
  from placed p join (select distinct lang, lvl, n from nodes where n > 1) l on l.lang is not distinct from p.lang
  left join nodes s on s.lang is not distinct from p.lang and s.lvl = l.lvl and s.pos = xor(p.pos >> l.lvl, 1)
), higher as (
  select r.lang, r.lvl + l.lvl as lvl, (r.pos >> l.lvl) % 2 = 1 as odd, s.digest as sibling
  from subroots r join (select distinct lvl, n from above where n > 1) l on true
  left join above s on s.lvl = l.lvl and s.pos = xor(r.pos >> l.lvl, 1)
), path as (
  select * from own union all select p.lang, p.pos, h.lvl, h.odd, h.sibling from placed p join higher h on h.lang is not distinct from p.lang
), folds as (
  select lang, pos, 0 as lvl, coalesce(bad, leaf) as digest from placed
  union all
  select f.lang, f.pos, f.lvl + 1, sha256(case when odd then coalesce(sibling, '') || f.digest else f.digest || coalesce(sibling, '') end)
  from folds f join path p on p.lang is not distinct from f.lang and p.pos = f.pos and p.lvl = f.lvl
), folded as (select lang, pos, arg_max(digest, lvl) as digest from folds group by lang, pos),
proofs as (select lang, pos, sha256(coalesce(string_agg(sibling, '' order by lvl), '')) as proof_sha256 from path group by lang, pos)
select p.doc_id, p.leaf, r.digest as subroot, a.digest as root, coalesce(q.proof_sha256, sha256('')) as proof_sha256,
  f.digest as folded_root, f.digest = a.digest as verified
from placed p join subroots r on r.lang is not distinct from p.lang join (select digest from above where n = 1) a on true
left join proofs q on q.lang is not distinct from p.lang and q.pos = p.pos
join folded f on f.lang is not distinct from p.lang and f.pos = p.pos
"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pii_crf": op1_pii_crf,
    "op2_divergence": op2_divergence,
    "op3_prefix_targets": op3_prefix_targets,
    "op4_bpe": op4_bpe,
    "op5_tag_ratio": op5_tag_ratio,
    "op6_block_ann": op6_block_ann,
    "op7_token_rollups": op7_token_rollups,
    "op8_pivotal_mix": op8_pivotal_mix,
    "op9_chosen_path_join": op9_chosen_path_join,
    "op10_toxic_segments": op10_toxic_segments,
    "op11_byte_network": op11_byte_network,
    "op12_repair_paths": op12_repair_paths,
    "op13_merkle_manifest": op13_merkle_manifest,
}
ORACLE: dict[str, str] = {
    "op3_prefix_targets": OP3_SQL,
    "op6_block_ann": OP6_SQL,
    "op7_token_rollups": OP7_SQL,
    "op12_repair_paths": OP12_SQL,
    "op13_merkle_manifest": OP13_SQL,
}
