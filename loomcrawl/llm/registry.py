"""Queries and oracle SQL of this subpackage."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .clustering import cluster_vectors
from .collocation import collocations
from .common import table
from .exact_dedup import exact_groups
from .html_text import extract_text
from .mixing import mix_report
from .packing import PackParams, pack_report
from .pseudo_likelihood import score_documents
from .quality import quality_report
from .records import RecordParams, record_report
from .sharding import shard_report
from .simhash import simhash_report
from .substring import repeated_spans
from .suffix_dedup import repeat_report


def tokenizer_file(name: str) -> str:
    """Where a public tokenizer's file lies: in $TOKENIZER_DIR, or in the package public_tokenizers."""
    if told := os.environ.get("TOKENIZER_DIR"):
        return os.path.join(told, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_spans(table(spark, sf_dir, "documents"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_report(table(spark, sf_dir, "documents"))


def op3_pseudo_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_report(table(spark, sf_dir, "documents"))


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages"))


def op6_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return record_report(table(spark, sf_dir, "documents"), RecordParams(tokenizer_file("byte_bpe_50k.json")))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_report(table(spark, sf_dir, "documents"), PackParams(tokenizer_file("word_bpe_49k.json")))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_report(table(spark, sf_dir, "documents"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


def op12_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster_vectors(table(spark, sf_dir, "embeddings"))


def op13_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeat_report(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_simhash": op2_simhash,
    "op3_pseudo_likelihood": op3_pseudo_likelihood,
    "op4_mixing": op4_mixing,
    "op5_html_text": op5_html_text,
    "op6_token_records": op6_token_records,
    "op7_packing": op7_packing,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_sharding": op9_sharding,
    "op10_quality": op10_quality,
    "op11_collocations": op11_collocations,
    "op12_clustering": op12_clustering,
    "op13_suffix_dedup": op13_suffix_dedup,
}

def _clustering_sql(rounds: int = 3) -> str:
    """k-means as the contract of op12 has it: near (of all centroids the nearest) and moved (floors of means), once a round."""

    def near(i: int) -> str:
        return f"""
        near{i} as materialized (select vec_id, cluster, distance from
            (select v.vec_id, v.x, c.cluster, list_sum(list_transform(list_zip(v.x, c.x), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::bigint as distance from v, c{i} c)
            qualify row_number() over (partition by vec_id order by distance, cluster) = 1)"""

    def moved(i: int) -> str:
        return f"""
        means{i} as (select cluster, list((s - mod(mod(s, n) + n, n)) // n order by dim) as x from
            (select n{i}.cluster, u.dim, sum(u.e) as s, count(*) as n from near{i} n{i} join
                (select vec_id, unnest(x) as e, generate_subscripts(x, 1) as dim from v) u using (vec_id) group by 1, 2) group by cluster),
        c{i + 1} as materialized (select c.cluster, coalesce(m.x, c.x) as x from c{i} c left join means{i} m using (cluster))"""

    steps = ",".join(f"{near(i)},{moved(i)}" for i in range(rounds))
    return f"""
        with v as materialized (select vec_id, list_transform(embedding, lambda e: floor(64 * e::double)::hugeint) as x from embeddings
            where len(embedding) = 64 and len(list_filter(embedding, lambda e: e is null or not isfinite(e))) = 0),
        c0 as materialized (select row_number() over (order by sha256('1:' || vec_id)) - 1 as cluster, x from v qualify cluster < 16),{steps},{near(rounds)}
        select vec_id, cluster::int as cluster, distance, sum(distance) over (partition by cluster)::bigint as cluster_inertia, sum(distance) over ()::bigint as inertia,
               sha256(array_to_string(c.x, ',')) as centroid_sha256
        from near{rounds} join c{rounds} c using (cluster)"""


ORACLE_SQL: dict[str, str] = {
    "op4_mixing": r"""
        with d as (select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size from documents),
        s as (select source, sum(size)::bigint as source_size, 1 + (row_number() over (order by source nulls last) - 1) % 3 as weight from d group by source),
        c as (select *, 3 * source_size as cap,
                     coalesce(sum(3 * source_size) over (order by 3 * source_size / weight, source nulls last rows between unbounded preceding and 1 preceding), 0) as spent,
                     sum(weight) over (order by 3 * source_size / weight, source nulls last rows between current row and unbounded following) as free,
                     sum(source_size) over () as total from s),
        l as (select (total - spent)::double / free::double as level, (total - spent)::hugeint as remaining, free::hugeint as free from c where cap * free >= (total - spent) * weight order by cap / weight, source nulls last limit 1),
        t as (select source, source_size, case when cap * l.free < l.remaining * weight then cap::double else l.level * weight end as target from c, l),
        j as (select doc_id, size, source_size, target, case when source_size > 0 then target / source_size else 0 end as rate from d join t on d.source is not distinct from t.source)
        select doc_id, size, source_size, target,
               (floor(rate) + case when ('0x' || substr(md5('mix:' || coalesce(doc_id::varchar, '')), 1, 13))::bigint / 4503599627370496.0 < rate - floor(rate) then 1 else 0 end)::bigint as copies,
               size * (floor(rate) + case when ('0x' || substr(md5('mix:' || coalesce(doc_id::varchar, '')), 1, 13))::bigint / 4503599627370496.0 < rate - floor(rate) then 1 else 0 end)::bigint as taken
        from j""",
    "op8_exact_dedup": """
        with d as (select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t from documents)
        select doc_id, max(doc_id) over (partition by t) as keep_id, count(*) over (partition by t) as group_size,
               doc_id = max(doc_id) over (partition by t) as kept, sha256(t) as text_sha256
        from d""",
    "op11_collocations": r"""
        with p as (select coalesce(lang, 'und') as lang, regexp_extract_all(unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')), '[^ \t]+') as w from documents),
        s as (select lang, w, m, unnest(range(1, len(w) - m + 2)) as i from p, range(1, 6) g(m) where len(w) >= m),
        f as materialized (select lang, m, array_to_string(w[i:i + m - 1], ' ') as phrase, count(*)::hugeint as a from s group by all),
        t as (select lang, sum(a)::hugeint as n from f where m = 1 group by 1),
        c as materialized (select *, string_split(phrase, ' ') as w from f where m > 1 and a >= 100),
        k as (select lang, w, m, a, phrase, unnest(range(1, m)) as k from c),
        x as (select k.lang, k.phrase, k.a, k.k, l.a as l, r.a as r, n, 1000 * k.a * n // (l.a * r.a) as score from k join t using (lang)
              join f l on l.lang = k.lang and l.phrase = array_to_string(w[1:k.k], ' ') join f r on r.lang = k.lang and r.phrase = array_to_string(w[k.k + 1:], ' ')
              qualify row_number() over (partition by k.lang, k.phrase order by score, k.k) = 1),
        h as (select distinct c.lang, c.phrase from c join c b on b.lang = c.lang and b.m > c.m and contains(' ' || b.phrase || ' ', ' ' || c.phrase || ' ') and 100 * b.a >= 100 * c.a)
        select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase, a::bigint as a, l::bigint as l, r::bigint as r, n::bigint as n, score::bigint as score
        from x anti join h using (lang, phrase) qualify rank <= 2000""",
    "op12_clustering": _clustering_sql(),
    "op13_suffix_dedup": """
        with d as materialized (select doc_id, hex(encode(coalesce(text, ''))) as x, len(x) // 2 as n from documents),
        w as (select doc_id, unnest(range(0, n - 99)) as s, x from d where n >= 100),
        k as materialized (select doc_id, s, substr(x, 2 * s + 1, 200) as k from w),
        f as (select k, min((doc_id, s)) as first from k group by k having count(*) > 1),
        r as materialized (select doc_id, s, lag(s) over (partition by doc_id order by s) as before from k join f using (k) where (doc_id, s) <> first),
        g as (select doc_id, s, sum(case when before is null or s > before + 100 then 1 else 0 end) over (partition by doc_id order by s) as run from r),
        o as materialized (select doc_id, run, min(s) as b, max(s) + 100 as e, lag(max(s) + 100, 1, 0) over (partition by doc_id order by run) as since from g group by doc_id, run),
        c as (select doc_id, sum(e - b)::bigint as n_removed, count(*) as n_spans, string_agg(substr(x, 2 * since + 1, 2 * (b - since)), '' order by run) as head, max(e) as e from o join d using (doc_id) group by doc_id)
        select d.doc_id, n::bigint as n_bytes, coalesce(n_removed, 0)::bigint as n_removed, coalesce(n_spans, 0)::bigint as n_spans,
               sha256(unhex(coalesce(head, '') || substr(x, 2 * coalesce(e, 0) + 1))) as kept_sha256
        from d left join c using (doc_id)""",
}
