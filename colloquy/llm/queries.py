"""The registered queries of this package and, where SQL can say it, their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from colloquy.llm import (
    content_sort, fertility, grid_codes, html_blocks, lengths, letter_trees, pareto_mix, partition_join, piece_bpe, prefix_targets, redirects, span_crf, toxicity,
)
from colloquy.llm.common import read_table
from colloquy.staging import stage

Query = Callable[[SparkSession, str], DataFrame]

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.tiktoken")
BYTE_BPE_MULTI = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
PATTERN = public_tokenizers.PATTERN
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)


def op1_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    return fertility.judge(docs, PIECES, BYTE_BPE_MULTI, PATTERN).drop("lang")


def op2_html_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_blocks.extract(pages).withColumn("n_chars", F.length("text").cast("long"))


def op3_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return pareto_mix.mix(docs).select("doc_id", "size", "source_size", "target", "taken")


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return content_sort.mark_duplicates(docs, keep="largest").select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op5_partition_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return partition_join.components(docs)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.score(docs, read_table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    return scored.select("doc_id", "held_out", "score", "predicted")


def op7_piece_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return digest_tokens(piece_bpe.round_trip(docs, BYTE_BPE, PATTERN))


def digest_tokens(decoded: DataFrame) -> DataFrame:
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )


def op8_span_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = span_crf.find(docs)

    def listed(spans: str) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = map(count, span_crf.BASE_KINDS)
    return found.select("doc_id", *counts, F.sha2(listed("base"), 256).alias("base_sha256"), listed("spans").alias("spans"))


def op9_redirects(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return redirects.judge(pages, RULES).select("page_id", "host", "path", "rule", "verdict")


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("text")
    counts = stage(lengths.histogram(lengths.with_length(docs, BYTE_BPE, PATTERN)), "lengths")
    return lengths.suffix_sums(counts)


def op11_letter_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return letter_trees.variants(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op12_grid_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grid_codes.compress(read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))


# A conversation that says what the template uses itself.
CONTROLS = r"\### Assistant: </turn> ok"


def op13_prefix_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = spark.createDataFrame([(-7, turn, role, CONTROLS) for turn, role in enumerate(("user", "assistant"))], "conv_id long, turn long, role string, text string")
    return prefix_targets.read_back(stage(prefix_targets.expand(turns.unionByName(said)), "expanded"))


QUERIES: dict[str, Query] = {
    "op1_fertility": op1_fertility,
    "op2_html_blocks": op2_html_blocks,
    "op3_pareto_mix": op3_pareto_mix,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_partition_join": op5_partition_join,
    "op6_toxicity": op6_toxicity,
    "op7_piece_bpe": op7_piece_bpe,
    "op8_span_crf": op8_span_crf,
    "op9_redirects": op9_redirects,
    "op10_token_counts": op10_token_counts,
    "op11_letter_trees": op11_letter_trees,
    "op12_grid_codes": op12_grid_codes,
    "op13_prefix_targets": op13_prefix_targets,
}

def _quantiser_sql(rounds: int = 4) -> str:
    """Codebooks fitted in as many steps, each a table of its own."""

    def nearest(book: str) -> str:
        return f"""select vec_id, p, v, min({{'d': list_inner_product(v, v) - 2 * list_inner_product(v, c) + list_inner_product(c, c), 'e': e}}) as best
                   from parts join {book} using (p) group by vec_id, p, v"""

    steps = []
    for r in range(1, rounds + 1):
        steps.append(f"near{r} as materialized ({nearest(f'book{r - 1}')})")
        steps.append(f"""book{r} as materialized (
          select b.p, b.e, coalesce(m.c, b.c) as c
          from book{r - 1} b left join (
            select p, e, list(mean order by i) as c
            from (select p, best.e as e, i, floor(sum(x) / count(*)) as mean from (select p, best, unnest(v) as x, generate_subscripts(v, 1) as i from near{r}) group by p, best.e, i)
            group by p, e
          ) m using (p, e)
        )""")
    chain = ", ".join(steps)
    return f"""
        with kept as (
          select vec_id, label, list_transform(embedding, lambda x: floor(1024 * x::double)) as whole
          from embeddings
          where len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
        ), parts as materialized (
          select vec_id, p, whole[p * len(whole) // 4 + 1 : (p + 1) * len(whole) // 4] as v from kept, (select unnest(range(4)) as p)
        ), book0 as materialized (
          select p, row_number() over (partition by p order by vec_id nulls last) - 1 as e, v as c
          from parts qualify row_number() over (partition by p order by vec_id nulls last) <= 256
        ), {chain}, last as materialized (
          {nearest(f"book{rounds}")}
        ), coded as (
          select k.vec_id, any_value(k.label) as label, string_agg(right('0' || lower(hex(best.e)), 2), '' order by p) as code, sum(best.d)::bigint as error
          from last join kept k on last.vec_id is not distinct from k.vec_id group by k.vec_id
        )
        select vec_id, code, error, (sum(error) over (partition by label))::bigint as label_error,
               (select sha256(string_agg(x::bigint::varchar, ',' order by p, e, i)) from (select p, e, unnest(c) as x, generate_subscripts(c, 1) as i from book{rounds})) as codebooks_sha256
        from coded
    """


SQL: dict[str, str] = {
    "op3_pareto_mix": r"""
        with recursive sized as (
          select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size
          from documents
        ), docs as (
          select *, case when size > 0 then length(bin(size)) else 0 end + 8 as odds from sized
        ), sources as (
          select source, sum(size)::bigint as source_size,
                 (row_number() over (order by source nulls last) - 1) % 3 + 1 as weight
          from docs group by source
        ), rounds as (  -- share out, stop the ones above their cap, share out again
          select 0 as round, source, source_size, weight, false as stopped,
                 (sum(source_size) over ())::double as free_words, (sum(weight) over ())::double as free_weight
          from sources
          union all
          select round + 1, source, source_size, weight, stop,
                 sum(source_size) over () - coalesce(sum(3 * source_size) filter (where stop) over (), 0),
                 sum(weight) filter (where not stop) over ()
          from (select *, stopped or weight * free_words / free_weight >= 3 * source_size as stop from rounds)
          where round <= (select count(*) from sources)
        ), targets as (
          select source, source_size,
                 case when stopped then (3 * source_size)::double else (weight * free_words) / free_weight end as target
          from rounds where round = (select count(*) from sources)
        ), bands as (
          select source, odds, sum(size)::double as words from docs where size > 0 group by source, odds
        ), tries as (
          select b.source, b.odds,
                 (t.target - 3 * coalesce((sum(words) over (partition by b.source order by odds desc rows between unbounded preceding and 1 preceding)), 0))
                 / (sum(words * odds) over (partition by b.source order by odds rows between unbounded preceding and current row)) as try
          from bands b join targets t on b.source is not distinct from t.source
        ), scales as (
          select source, coalesce(arg_max(try, odds) filter (where try * odds < 3), 3.0) as scale
          from tries group by source
        ), expected as (
          select d.doc_id, d.source, d.size, t.source_size, t.target,
                 case when d.size > 0 then least(3.0::double, s.scale * d.odds) else 0.0 end as e,
                 (('0x' || substr(md5(coalesce(d.doc_id::varchar, '') || '/' || d.size::varchar), 1, 13))::bigint::double + 0.5) / 4503599627370496.0::double as u
          from docs d join targets t on d.source is not distinct from t.source
          left join scales s on d.source is not distinct from s.source
        ), ranked as (
          select *, floor(e) as sure, e - floor(e) as p,
                 case when e > floor(e) then (u / (1 - u)) / ((e - floor(e)) / (1 - (e - floor(e)))) end as q
          from expected
        ), missing as (
          select source, any_value(target) - sum(size * sure) as m from ranked group by source
        ), running as (
          select r.*, m.m,
                 sum(case when p > 0 then size else 0 end) over (partition by r.source order by q / (1 + q) nulls last, doc_id, size) as until,
                 sum(size) over (partition by r.source, q, doc_id, size) as own
          from ranked r join missing m on r.source is not distinct from m.source
        )
        select doc_id, size, source_size, target,
               (size * (sure + case when p > 0 and 2 * until - own <= 2 * m then 1 else 0 end))::bigint as taken
        from running
    """,
    # Aliases come from canonical links and refresh redirects; the component of a page is
    # what it reaches along them in either direction.
    "op9_redirects": r"""
        with recursive urls as (
          select page_id, html, case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end as rest
          from pages
        ), split as (
          select page_id, html, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
                 regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path, regexp_extract(rest, '^[^/?#]*([^#]*)', 1) as whole_path
          from urls
        ), rules(rule, domain, start, verdict) as (
          values ('com/', 'com', '/', 'allow'), ('example.com/en/', 'example.com', '/en/', 'block'),
                 ('www.example.com/en/', 'www.example.com', '/en/', 'allow'), ('net/es/', 'net', '/es/', 'block'), ('net/fr/', 'net', '/fr/', 'block')
        ), tags as (
          select host, path, host || whole_path as node, unnest(list_concat(
                   list_transform(list_filter(regexp_extract_all(bare, '(?is)<link\b[^>]*>'), lambda t: regexp_matches(t, '(?is)\brel\s*=\s*["'']?[^"''>]*\bcanonical\b')),
                                  lambda t: regexp_extract(t, '(?is)\bhref\s*=\s*["'']?\s*([^"''\s>]+)', 1)),
                   list_transform(list_filter(regexp_extract_all(bare, '(?is)<meta\b[^>]*>'), lambda t: regexp_matches(t, '(?is)\bhttp-equiv\s*=\s*["'']?\s*refresh\b')),
                                  lambda t: regexp_extract(t, '(?is)\burl\s*=\s*["'']?\s*([^"''\s>;]+)', 1)))) as target
          from (select host, path, whole_path, regexp_replace(html, '(?s)<!--.*?(-->|$)', '', 'g') as bare from split where host <> '')
        ), whole as (
          select node, case when contains(target, '://') then substr(target, strpos(target, '://') + 3)
                                  when starts_with(target, '//') then substr(target, 3)
                                  when starts_with(target, '/') then host || target
                                  when starts_with(target, '?') then host || path || target
                                  when starts_with(target, '#') then node
                                  else host || case when contains(path, '/') then regexp_extract(path, '^(.*/)', 1) else '/' end || target end as rest
          from tags where target <> ''
        ), edges as (
          select node as a,
                 translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') || regexp_extract(rest, '^[^/?#]*([^#]*)', 1) as b
          from whole where rest <> ''
        ), sides as (
          select a, b from edges union select b, a from edges
        ), reach as (
          select a as node, a as seen from sides union select r.node, e.b from reach r join sides e on r.seen = e.a
        ), parts as (
          select node, regexp_extract(seen, '^([^/?]*)', 1) as host, regexp_extract(seen, '^[^/?]*([^?]*)', 1) as path from reach
        ), ruled as (
          select p.host, p.path, arg_max(rule, length(rule)) as rule, arg_max(verdict, length(rule)) as verdict
          from (select distinct host, path from split union select distinct host, path from parts) p
          join rules r on (p.host = domain or ends_with(p.host, '.' || domain)) and starts_with(p.path, start)
          group by p.host, p.path
        ), blocked as (
          select distinct node from parts join ruled using (host, path) where verdict = 'block'
        )
        select s.page_id, s.host, s.path, r.rule,
               coalesce(r.verdict, case when b.node is not null then 'block' end, 'allow') as verdict
        from split s
        left join ruled r on s.host = r.host and s.path = r.path
        left join blocked b on s.host || s.whole_path = b.node
    """,
    "op4_exact_dedup": """
        with t as (
          select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as body
          from documents
        )
        select doc_id,
               max(doc_id) over (partition by body) as keep_id,
               count(*) over (partition by body) as group_size,
               row_number() over (partition by body order by doc_id desc nulls last) = 1 as kept,
               sha256(body) as text_sha256
        from t
    """,
    "op5_partition_join": r"""
        with recursive worded as (
          select doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w
          from documents
        ), shingles as (
          select distinct doc_id, unnest(case when len(w) < 5 then [array_to_string(w, ' ')]
                                         else list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) end) as s
          from worded where len(w) > 0
        ), sizes as (
          select doc_id, count(*) as n from shingles group by doc_id
        ), shared as (
          select a.doc_id as a, b.doc_id as b, count(*) as c
          from shingles a join shingles b on a.s = b.s and a.doc_id <> b.doc_id group by a.doc_id, b.doc_id
        ), links as (
          select a, b from shared join sizes x on x.doc_id = a join sizes y on y.doc_id = b where 100 * c >= 80 * (x.n + y.n - c)
        ), reach as (
          select doc_id, doc_id as other from documents union select r.doc_id, l.b from reach r join links l on r.other = l.a
        )
        select d.doc_id, coalesce(any_value(z.n), 0)::bigint as n_shingles, min(r.other) as component_id
        from documents d join reach r using (doc_id) left join sizes z using (doc_id)
        group by d.doc_id
    """,
    # The checksum is worked out four bits at a time, the lower ones of a byte first.
    "op11_letter_trees": r"""
        with recursive steps as materialized (
          select list_transform(range(16), lambda i: list_reduce(list_prepend(i, range(4)), lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)) as t
        ), runs as (
          select key, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as run, count(*) as c
          from (select coalesce(doc_id::varchar, '') as key, unnest(regexp_extract_all(text, '[A-Za-z\x{00C0}-\x{00FF}]+')) as run from documents)
          where length(run) >= 6 group by 1, 2
        ), bytes as (
          select run, c, hex(encode(key || ':' || run)) as h from runs
        ), halves as (
          select run, c, list_transform(range(1, len(h) + 1), lambda j: strpos('0123456789ABCDEF', substr(h, j + (case when j % 2 = 1 then 1 else -1 end), 1)) - 1) as b from bytes
        ), marked as (
          select run, c, xor(list_reduce(list_prepend(4294967295::bigint, b), lambda x, y: xor(t[(xor(x, y) & 15) + 1], x >> 4)), 4294967295) as mark from halves, steps
        ), words as materialized (
          select word, sum(c)::bigint as n
          from (select c, case when mark % 199 = 0 then left(run, (mark % length(run))::int) || substr(run, (mark % length(run))::int + 2) else run end as word from marked)
          where length(word) >= 6 group by word having sum(c) >= 5
        ), cuts as materialized (
          select word, n, i, left(word, i::int - 1) || substr(word, i::int + 1) as rest from (select word, n, unnest(range(1, length(word) + 1)) as i from words)
        ), pairs as (
          select a.word, b.word as other, b.n as other_n from cuts a join cuts b on a.rest = b.rest and a.i = b.i and a.word <> b.word
          union select a.word, b.word, b.n from cuts a join words b on a.rest = b.word
          union select b.word, a.word, a.n from cuts a join words b on a.rest = b.word
        ), best as (
          select word, count(*) as n_near, min({'minus': -other_n, 'word': other}) as top from pairs group by word
        ), forms as materialized (
          select w.word, w.n, coalesce(n_near, 0) as n_near,
                 case when -top.minus >= 5 * w.n then top.word end as form, case when -top.minus >= 5 * w.n then -top.minus end as form_n
          from words w left join best using (word)
        ), path as (
          select word, word as at, form as next from forms
          union all select p.word, f.word, f.form from path p join forms f on p.next = f.word
        )
        select f.word, f.form, p.at as root, f.n, f.n_near, f.form_n from forms f join path p on f.word = p.word and p.next is null
    """,
    "op12_grid_codes": _quantiser_sql(),
    "op13_prefix_targets": r"""
        with turns as (
          select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
          union all select -7, 0, 'user', '\### Assistant: </turn> ok' union all select -7, 1, 'assistant', '\### Assistant: </turn> ok'
        ), sized as (
          select *, 14 + length(role) + length(text) + len(regexp_extract_all(role || text, '\\|</turn>')) + len(regexp_extract_all(role, ': '))
                    + len(regexp_extract_all(role, '#')) - len(regexp_extract_all(role, '#+')) + len(regexp_extract_all(text, '#')) - len(regexp_extract_all(text, '#+')) as chars
          from turns
        )
        select conv_id, count(*) as n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, md5(text))) as turns_sha256,
               coalesce(sum(length(text)) filter (where role = 'assistant'), 0)::bigint as loss_chars,
               sha256(coalesce(string_agg(text, '' order by turn nulls first, role, md5(text)) filter (where role = 'assistant'), '')) as loss_sha256,
               sum(chars)::bigint as formatted_chars
        from sized group by conv_id
    """,
}
