"""Registered queries of the pipeline operators, and their SQL twins where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.llm import (
    decontaminate,
    lexical,
    packing,
    pii,
    quality,
    quantise,
    repair,
    runs,
    simhash,
    substring,
    toxicity,
    unigram,
    warc,
)
from panelcast.llm.common import read_table


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash groups of all documents: 3-word shingles, at most 3 bits."""
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents"), shingle=3, k=3)


def op2_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents that repeat from smaller documents, removed."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring.remove_repeats(docs).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op3_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate embeddings of the whole table: cosine of at least 0.9."""
    return quantise.near_duplicates(read_table(spark, sf_dir, "embeddings"), threshold=0.9)


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unigram token counts of all documents."""
    return unigram.count_tokens(read_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as ids in Re-Pair files, and what the files hold when read back."""
    docs = read_table(spark, sf_dir, "documents")
    folder, manifest = repair.write_ids(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    return repair.read_ids(spark, folder, manifest, end_id=1).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents, learned outside the fold with crc32(doc_id) mod 3 = 1."""
    docs = read_table(spark, sf_dir, "documents")
    scores = toxicity.score(docs, toxicity.train(docs, read_table(spark, sf_dir, "labels")))
    return scores.select("doc_id", F.coalesce(toxicity.fold("doc_id", 3) == 1, F.lit(False)).alias("held_out"),
                         "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, with the item and the verified overlaps."""
    return decontaminate.contaminated(
        read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as WARC archives and read back in byte ranges."""
    folder, manifest = warc.write_archives(read_table(spark, sf_dir, "pages"))
    return warc.read_archives(spark, folder, manifest).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of all documents, learned outside the fold with crc32(doc_id) mod 5 = 0."""
    docs = read_table(spark, sf_dir, "documents")
    scores = quality.score(docs, quality.train(docs, read_table(spark, sf_dir, "labels")))
    return scores.select("doc_id", F.coalesce(toxicity.fold("doc_id", 5) == 0, F.lit(False)).alias("held_out"),
                         "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 1024 ids."""
    pieces = packing.pack(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset")


def _base_spans(column: str):
    """The spans of the base kinds as ``kind:start:end``, comma-joined."""
    base = F.filter(column, lambda s: s["kind"].isin(*pii.BASE_KINDS))
    return _joined(base)


def _joined(spans):
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op11_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in all documents: counts of the base kinds, a digest of their spans, all spans."""
    found = pii.find_pii(read_table(spark, sf_dir, "documents"))

    def count(kind: str):
        return F.size(F.filter("pii", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(kind) for kind in pii.BASE_KINDS]
    return found.select("doc_id", *counts, F.sha2(_base_spans("pii"), 256).alias("base_sha256"),
                        _joined(F.col("pii")).alias("spans"))


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """``doc_id, text``: in the documents whose crc32(doc_id) ends in 0 the words from some place on repeat.

    From word ``a = (h div 10) mod n`` on, word i becomes word ``a + (i - a) mod p``
    with ``p = 1 + (n - a) div (3 + (h div 10) mod 8)``.
    """
    rows = docs.select("doc_id", "text", F.crc32(F.col("doc_id").cast("string").cast("binary")).alias("h"))
    words = F.when(F.col("h") % 10 == 0, F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1)))
    split = rows.withColumn("words", words).withColumn("n", F.size("words"))
    split = split.withColumn("a", F.expr("if(n > 0, cast((h div 10) % n as int), null)")).withColumn(
        "p", F.expr("cast(1 + (n - a) div (3 + (h div 10) % 8) as int)"))
    repeated = F.expr("transform(sequence(0, n - 1), i -> words[if(i < a, i, a + (i - a) % p)])")
    return split.select("doc_id", F.when(F.col("n") > 0, F.array_join(repeated, " ")).otherwise(F.col("text")).alias("text"))


def op12_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words in all documents, some of which get long runs first."""
    found = runs.find_runs(with_planted_runs(read_table(spark, sf_dir, "documents")))
    first = F.col("runs")[0]
    best = F.aggregate("runs", first, lambda b, r: F.when(
        r["length"] * b["period"] > b["length"] * r["period"], r).otherwise(b))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("best", F.when(F.size("runs") > 0, best)).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"),
        F.col("best.length").alias("length"), F.col("best.period").alias("period"),
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op13_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best documents of each benchmark item by integer BM25-like scores."""
    return lexical.rank(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"), k=50)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash": op1_simhash,
    "op2_substring": op2_substring,
    "op3_embeddings": op3_embeddings,
    "op4_token_counts": op4_token_counts,
    "op5_token_files": op5_token_files,
    "op6_toxicity": op6_toxicity,
    "op7_decontamination": op7_decontamination,
    "op8_warc": op8_warc,
    "op9_quality": op9_quality,
    "op10_packing": op10_packing,
    "op11_pii": op11_pii,
    "op12_runs": op12_runs,
    "op13_lexical": op13_lexical,
}

ORACLES: dict[str, str] = {
    "op2_substring": r"""
        with w as (
          select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws from documents),
        g as (
          select doc_id, i, array_to_string(ws[i + 1 : i + 13], ' ') as k
          from (select doc_id, ws, unnest(range(0, len(ws) - 12)) as i from w)),
        f as (select k, min(doc_id) as least_id from g group by k),
        hit as (select distinct doc_id, i from g join f using (k) where least_id < doc_id),
        covered as (select distinct doc_id, unnest(range(i, i + 13)) as pos from hit),
        word as (select doc_id, unnest(ws) as word, unnest(range(0, len(ws))) as pos from w),
        kept as (
          select doc_id, string_agg(word, ' ' order by pos) as t, count(*) as n
          from word anti join covered using (doc_id, pos) group by doc_id)
        select w.doc_id, len(ws)::bigint as n_words, (len(ws) - coalesce(n, 0))::bigint as n_removed,
               sha256(coalesce(t, '')) as kept_sha256
        from w left join kept on kept.doc_id = w.doc_id""",
    "op3_embeddings": r"""
        with recursive v as (
          select vec_id, embedding::double[] as e from embeddings
          where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
            and len(list_filter(embedding, lambda x: x <> 0)) > 0),
        link as (
          select a.vec_id as a, b.vec_id as b from v a join v b on a.vec_id <> b.vec_id
          where list_cosine_similarity(a.e, b.e) >= 0.9),
        reach as (select a, b from link union select r.a, l.b from reach r join link l on l.a = r.b),
        n as (select a, count(*) as n from link group by a),
        c as (select a, min(b) as least_id from reach group by a)
        select vec_id, coalesce(n.n, 0)::bigint as n_links, least(vec_id, coalesce(least_id, vec_id)) as component_id,
               vec_id = least(vec_id, coalesce(least_id, vec_id)) as kept
        from embeddings left join n on n.a = vec_id left join c on c.a = vec_id""",
    "op8_warc": r"""
        with p as (
          select page_id, octet_length(encode(coalesce(html, ''))) as size, sha256(coalesce(html, '')) as digest
          from pages),
        f as (select digest, min(page_id) as least_id from p where size >= 100 group by digest)
        select page_id, size::bigint as payload_bytes, p.digest as payload_digest,
               case when least_id is null or least_id = page_id then 'response' else 'revisit' end as record_type,
               case when least_id <> page_id then least_id end as refers_to
        from p left join f on f.digest = p.digest""",
    "op11_pii": r"""
        with t as (select doc_id, coalesce(text, '') as text from documents),
        base(kind, place, pattern) as (values
          ('email', 0, '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+'),
          ('ip', 1, '[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+'),
          ('card', 2, '[0-9](?:[\x20-]?[0-9])+'),
          ('phone', 3, '\+[0-9][\x20().0-9-]+[0-9]'),
          ('url', 4, '\b(?:https?|ftp)://[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+(?::[0-9]+)?(?:/(?:[A-Za-z0-9/_.~%?=&#+-]*[A-Za-z0-9/_~%=&#+-])?)?'),
          ('account', 5, '\b(?:[Ii]ban|IBAN|[Aa]ccount|ACCOUNT|[Aa]cct|ACCT|[Ss]sn|SSN|[Pp]assport|PASSPORT|[Tt]oken|TOKEN|[Ss]ecret|SECRET|[Pp]assword|PASSWORD|[Aa]pi_key|API_KEY)\x20?[:=#]\x20?"?[A-Za-z0-9-]{6,64}')),
        m as (
          select doc_id, kind, place, regexp_extract_all(text, pattern) as found,
                 list_transform(string_split_regex(text, pattern), lambda x: length(x)) as gaps
          from t, base where regexp_matches(text, pattern)),
        s as (
          select doc_id, kind, place, unnest(found) as hit, unnest(range(1, len(found) + 1)) as k, found, gaps from m),
        p as (
          select doc_id, kind, place, hit,
                 list_sum(gaps[1 : k]) + coalesce(list_sum(list_transform(found[1 : k - 1], lambda x: length(x))), 0) as pos
          from s),
        spans as (
          select doc_id, kind, place, case when kind = 'account'
                   then regexp_extract(hit, '[:=#]\x20?"?([A-Za-z0-9-]{6,64})$', 1) else hit end as own,
                 (pos + length(hit) - length(own))::bigint as first, (pos + length(hit))::bigint as past
          from p),
        digits as (select *, regexp_replace(own, '[^0-9]', '', 'g') as d from spans),
        good as (
          select * from digits where case kind
            when 'ip' then list_max(list_transform(string_split(own, '.'), lambda x: try_cast(x as double))) <= 255
            when 'card' then length(d) between 13 and 19 and
              list_sum(list_transform(range(0, length(d)), lambda i:
                case when i % 2 = 0 then substr(d, length(d) - i, 1)::bigint
                     when substr(d, length(d) - i, 1)::bigint > 4 then 2 * substr(d, length(d) - i, 1)::bigint - 9
                     else 2 * substr(d, length(d) - i, 1)::bigint end)) % 10 = 0
            when 'phone' then length(d) between 9 and 15
            when 'account' then length(d) >= 4
            else true end),
        joined as (
          select doc_id, count(*) filter (kind = 'email') as n_email, count(*) filter (kind = 'ip') as n_ip,
                 count(*) filter (kind = 'card') as n_card, count(*) filter (kind = 'phone') as n_phone,
                 string_agg(kind || ':' || first || ':' || past, ',' order by place, first) filter (place < 4) as base,
                 string_agg(kind || ':' || first || ':' || past, ',' order by place, first) as spans
          from good group by doc_id)
        select t.doc_id, coalesce(n_email, 0) as n_email, coalesce(n_ip, 0) as n_ip, coalesce(n_card, 0) as n_card,
               coalesce(n_phone, 0) as n_phone, sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans
        from t left join joined on joined.doc_id = t.doc_id""",
    "op12_runs": r"""
        with d as (
          select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws,
                 xor(list_reduce(list_prepend(4294967295::bigint, list_transform(range(1, length(doc_id::varchar) + 1),
                       lambda i: ord(substr(doc_id::varchar, i, 1))::bigint)),
                   lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0],
                     lambda x, y: xor(x >> 1, (x & 1) * 3988292384))), 4294967295) as h
          from documents),
        e as (select *, len(ws) as n, case when len(ws) > 0 then (h // 10) % len(ws) end as a from d),
        f as (select *, 1 + (n - a) // (3 + (h // 10) % 8) as p from e),
        x as (
          select doc_id, n, case when h % 10 = 0 and n > 0
            then list_transform(range(0, n), lambda i: ws[1 + case when i < a then i else a + (i - a) % p end]) else ws end as ws
          from f),
        g as (
          select doc_id, i, ws[i + 1 : i + 3] as three
          from (select doc_id, ws, unnest(range(0, len(ws) - 2)) as i from x)),
        pair as (
          select u.doc_id, u.i, v.i - u.i as q from g u join g v on u.doc_id = v.doc_id and u.three = v.three and u.i < v.i),
        island as (
          select doc_id, q, i, i - row_number() over (partition by doc_id, q order by i) as k from pair),
        stretch as (
          select doc_id, q, min(i) as start, count(*) + 2 + q as length from island group by doc_id, q, k),
        run as (
          select doc_id, start, length, min(q) as period from stretch
          where length >= greatest(6, 4 * q) group by doc_id, start, length),
        gone as (select distinct doc_id, unnest(range(start + period, start + length)) as i from run),
        word as (select doc_id, unnest(ws) as word, unnest(range(0, len(ws))) as i from x),
        kept as (
          select doc_id, string_agg(word, ' ' order by i) as t from word anti join gone using (doc_id, i) group by doc_id),
        rs as (
          select doc_id, count(*) as n_runs,
                 string_agg(start || ',' || length || ',' || period || chr(10), '' order by start, period) as lines
          from run group by doc_id),
        best as (
          select * from run qualify row_number() over (
            partition by doc_id order by length::decimal(38, 18) / period desc, start, period) = 1)
        select x.doc_id, coalesce(n_runs, 0)::bigint as n_runs, start::bigint as start, length::bigint as length,
               period::bigint as period, ((1000 * length) // period)::bigint as exponent_milli,
               sha256(coalesce(lines, '')) as runs_sha256, sha256(coalesce(t, '')) as collapsed_sha256
        from x left join rs on rs.doc_id = x.doc_id left join best on best.doc_id = x.doc_id
          left join kept on kept.doc_id = x.doc_id""",
    "op13_lexical": r"""
        with w as (
          select doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from documents),
        d as (select doc_id, count(*) as n from w group by doc_id),
        s as (select count(*)::bigint as n_docs, sum(n)::bigint as n_terms from d),
        q as (
          select distinct item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from benchmark),
        tf as (select doc_id, term, count(*) as tf from w semi join q using (term) group by doc_id, term),
        df as (select term, count(*) as df from tf group by term),
        wt as (select term, floor(1000 * ln((2 * n_docs + 2)::double / (2 * df + 1)))::bigint as weight from df, s),
        part as (
          select doc_id, term, weight * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // n_terms))) as part
          from tf join d using (doc_id) join wt using (term), s),
        score as (
          select item_id, doc_id, sum(part)::bigint as score from q join part using (term)
          group by item_id, doc_id having sum(part) > 0)
        select item_id, row_number() over (partition by item_id order by score desc, doc_id)::integer as rank, doc_id, score
        from score qualify rank <= 50""",
}
