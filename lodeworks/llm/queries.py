"""One registered query per operator, over whole tables, and their SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from . import byte_bpe, centroids, language, licences, mixing, near_duplicates, neighbours, packing, quality_rules, rule_ensemble, secret_scan, substring_dedup, whitening
from .shared import held_out, learnable, table, written

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


@query
def op1_language_backoff(spark, sf_dir):
    """Learned from four fifths of the documents, applied to all."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language.fit(docs, learn=learnable(F.col("doc_id")))
    found = language.predict(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


@query
def op2_fm_index_dedup(spark, sf_dir):
    """Windows of 13 words, over all documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = substring_dedup.remove_repeats(docs)
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op3_mix_sources(spark, sf_dir):
    """All sources at equal weight, as many documents as there are: every copy with its text."""
    return mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source"))


ORACLES["op3_mix_sources"] = """
with recursive counts as (select source, count(*) as n from documents group by source),
rated as (
  select source, (select count(*) from documents)::double / (select count(*) from counts) / n as rate from counts),
split as (select source, greatest(ceil(rate / 16), 1)::int as parts, rate / greatest(ceil(rate / 16), 1) as mean from rated),
terms as (
  select source, parts, k, sum(exp(k * ln(mean) - mean - lgamma(k + 1)))
    over (partition by source order by k rows unbounded preceding) as c
  from split, range(97) t(k)),
draws as (
  select d.doc_id, s.source, j,
    (('0x' || substr(md5('7|' || d.doc_id || '|' || j), 1, 13))::bigint + 0.5) / (1::bigint << 52)::double as u
  from documents d join split s on d.source is not distinct from s.source, range(1, 100) r(j) where j <= s.parts),
counted as (
  select doc_id, sum((select count(*) from terms t where t.source is not distinct from draws.source and t.c <= draws.u)) as n
  from draws group by doc_id)
select d.doc_id, d.text, d.lang, d.source, r.copy::int as copy
from documents d join counted c using (doc_id), lateral (select unnest(range(c.n::bigint)) as copy) r
"""


@query
def op4_rule_ensemble_quality(spark, sf_dir):
    """Learned from labels of four fifths of the documents, applied to all."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = rule_ensemble.fit_on_labels(docs, table(spark, sf_dir, "labels"), learnable(F.col("doc_id")))
    return rule_ensemble.judge(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


@query
def op5_hash_prefix_forest(spark, sf_dir):
    """Queries: vectors whose id is divisible by 50, as the contract fixes; candidates: all vectors."""
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return neighbours.nearest(rows, rows.where("vec_id % 50 = 0"))


@query
def op6_ngram_ratio_rules(spark, sf_dir):
    """Target: documents labelled good, whose ratios set the threshold. Raw corpus: all documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    good = table(spark, sf_dir, "labels").where("quality = 1").select("doc_id").distinct()
    # labels grow with the documents: one plan at every size, not a broadcast while they are few
    marked = docs.join(good.withColumn("good", F.lit(True)).hint("merge"), "doc_id", "left")
    model = quality_rules.ratios(marked, F.col("good"))
    # every text is judged once: the threshold comes from the verdicts' own ratios, which are small and stored
    judged = written(quality_rules.judge(docs, model).drop("text"), "judged")
    least = quality_rules.least_of(judged.join(good.hint("merge"), "doc_id", "left_semi"))
    return judged.withColumn("kept", F.col("kept") & (F.col("mean_ratio") >= least))


@query
def op7_licence_inheritance(spark, sf_dir):
    """Every document is a file below the directories of its source and language."""
    docs = table(spark, sf_dir, "documents")
    path = F.concat_ws("/", F.coalesce("source", F.lit("unknown")), F.coalesce("lang", F.lit("unknown")), F.concat(F.col("doc_id").cast("string"), F.lit(".txt")))
    files = docs.select("doc_id", path.alias("path"), "text")
    return licences.scan(files).drop("text")


def _op7_sql() -> str:
    """Patterns and the scale of weights are stated anew here; only the templates' texts are the operator's."""
    quoted = lambda x: "'" + x.replace("'", "''") + "'"
    texts = ", ".join(f"({i}, {quoted(name)}, {quoted(text)})" for i, (name, text) in enumerate(licences.TEMPLATES))
    cue = r"(?i)(licence|license|copyright|spdx|\bcc[ -]by\b|\bcc0\b|creative commons|public domain|permission is hereby|redistribution and use)"
    term = r"[0-9a-z]+(?:[-.][0-9a-z]+)*"
    return f"""
with texts(template, licence, text) as (values {texts}),
terms as (select template, licence, unnest(regexp_extract_all(lower(text), '{term}')) as term from texts),
counts as (select template, licence, term, count(*) as tf from terms group by all),
known as (select term, ln((1 + (select count(*) from texts)) / (1 + count(distinct template))) + 1 as idf from terms group by term),
lengths as (select template, sqrt(sum((tf * idf) ** 2)) as length from counts join known using (term) group by template),
vectors as (select term, template, licence, tf * idf / length as weight from counts join known using (term) join lengths using (template)),
files as (
  select doc_id, coalesce(source, 'unknown') || '/' || coalesce(lang, 'unknown') as folder, doc_id || '.txt' as name,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^ \\t\\n\\x0B\\f\\r]')) as lines
  from documents where regexp_matches(text, '{cue}')),
marked as (
  select *, list_filter(lines, lambda x: regexp_matches(x, '{cue}')) as named,
    list_transform(lines, lambda x: regexp_replace(x, '^[ \\t\\n\\x0B\\f\\r/*#;%!<>-]+', '')) as plain
  from files),
held as (
  select distinct doc_id, unnest(list_concat(
    named,
    list_filter(flatten(list_transform(named, lambda x: string_split(regexp_replace(x, '([.!?])[ \\t]+([A-Z(])', '\\1' || chr(10) || '\\2', 'g'), chr(10)))),
      lambda x: regexp_matches(x, '{cue}')),
    list_transform(list_filter(range(1, len(plain) + 1), lambda i: regexp_matches(plain[i], '{cue}')),
      lambda i: array_to_string(plain[greatest(i - 1, 1):i + 3], ' ')))) as passage
  from marked),
counted as (
  select passage, term, count(*) as tf
  from (select passage, unnest(regexp_extract_all(lower(passage), '{term}')) as term from (select distinct passage from held))
  group by all),
weighed as (select passage, term, tf * coalesce(idf, ln(1 + (select count(*) from texts)) + 1) as x from counted left join known using (term)),
norms as (select passage, sqrt(sum(x * x)) as norm from weighed group by passage),
identified as (
  select passage, regexp_replace(regexp_extract(passage, '(?i)spdx-license-identifier:[ \\t(]*([A-Za-z0-9.+-]+)', 1), '(?i)(-only|-or-later|\\+)$', '') as id
  from (select distinct passage from held)),
scored as (
  select passage, licence, round(sum(x * weight) / any_value(norm), 9) as score
  from weighed join vectors using (term) join norms using (passage) group by passage, template, licence
  union all
  select passage, coalesce((select any_value(licence) from texts where lower(licence) = lower(id)), id), 1.0 from identified where id <> ''),
own as (
  select doc_id, licence, score from held join scored using (passage) where score >= 0.7
  qualify row_number() over (partition by doc_id order by score desc, licence) = 1),
sole as (
  select f.folder, o.licence from own o join marked f using (doc_id) where len(f.lines) = len(f.named)
  qualify row_number() over (partition by f.folder order by o.score desc, o.licence, f.name) = 1),
every as (select doc_id, coalesce(source, 'unknown') || '/' || coalesce(lang, 'unknown') as folder from documents)
select e.doc_id, e.folder || '/' || e.doc_id || '.txt' as path, o.licence as own_licence, o.score as own_score,
  coalesce(o.licence, s.licence) as licence, case when o.licence is null then s.folder end as licence_from
from every e left join own o using (doc_id) left join sole s using (folder)
"""


ORACLES["op7_licence_inheritance"] = _op7_sql()


@query
def op8_blob_ledger_secrets(spark, sf_dir):
    """A first run: the ledger is empty, so every blob is scanned once."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found, _ = secret_scan.scan(docs)
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("spans", lambda s: s["kind"].isin("assign", "access", "hex"))
    return found.select(
        "doc_id", count("assign"), count("access"), count("hex"),
        F.sha2(secret_scan.joined(base), 256).alias("base_sha256"), secret_scan.joined(F.col("spans")).alias("spans"),
    )


@query
def op10_minhash_near_duplicates(spark, sf_dir):
    """Four-word shingles at 80 percent, over all documents."""
    return near_duplicates.duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), width=4, percent=80)


@query
def op9_sum_of_squares_packing(spark, sf_dir):
    """All documents in sequences of 1,024 tokens."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.pack(packing.pieces(docs, public_tokenizers.path("byte_bpe_50k.json"), keep_ids=False))


@query
def op11_shallot_clusters(spark, sf_dir):
    """All vectors of 64 components around 40 centroids."""
    assigned, final = centroids.cluster(table(spark, sf_dir, "embeddings"))
    return centroids.with_inertia(assigned, final)


def _op11_sql(rounds: int = centroids.ROUNDS, k: int = centroids.CENTROIDS) -> str:
    steps = [
        f"""a{r} as materialized (
  select row, vec_id, v, k, d from (
    select row, vec_id, v, k, list_sum(list_transform(v, lambda x, i: (x - c[i]) * (x - c[i])))::bigint as d from kept, c{r})
  qualify row_number() over (partition by row order by d, k) = 1)"""
        for r in range(rounds + 1)
    ]
    moves = [
        f"""m{r} as (
  select k, i, sum(x)::hugeint as s, count(*)::hugeint as n
  from (select k, unnest(v) as x, unnest(range(1, 65)) as i from a{r}) group by k, i),
c{r + 1} as materialized (
  select c.k, coalesce(n.c, c.c) as c
  from c{r} c left join (select k, list(((s - ((s % n) + n) % n) // n)::bigint order by i) as c from m{r} group by k) n using (k))"""
        for r in range(rounds)
    ]
    parts = [p for r in range(rounds) for p in (steps[r], moves[r])] + [steps[rounds]]
    return f"""
with kept as materialized (
  select row_number() over () as row, vec_id, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as v
  from embeddings
  where len(embedding) = 64 and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = 64),
ranked as (select v, row_number() over (order by sha256('2:' || vec_id)) - 1 as k from kept),
c0 as materialized (select k::int as k, v as c from ranked where k < {k}),
{", ".join(parts)},
inertias as (select k, sum(d)::bigint as cluster_inertia from a{rounds} group by k)
select vec_id, k as cluster, d as distance, cluster_inertia, (select sum(d) from a{rounds})::bigint as inertia,
  sha256(array_to_string(c, ',')) as centroid_sha256
from a{rounds} join c{rounds} using (k) join inertias using (k)
"""


ORACLES["op11_shallot_clusters"] = _op11_sql()


@query
def op12_jacobi_davidson_whitening(spark, sf_dir):
    """All vectors on the 32 largest components."""
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


@query
def op13_chunked_byte_bpe(spark, sf_dir):
    """All documents to ids and back to bytes."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    coded = byte_bpe.encode(docs, path, public_tokenizers.PATTERN).drop("text")
    size = (F.octet_length("ids") / 4).cast("long")
    decoded = byte_bpe.decode("ids", path)
    return coded.select("doc_id", size.alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2(decoded, 256).alias("decoded_sha256"))


_KINDS = ", ".join(f"({i}, '{r.kind}', '{r.pattern.replace(chr(39), chr(39) * 2)}', {r.group}, {r.least})" for i, r in enumerate(secret_scan.RULES))
ORACLES["op8_blob_ledger_secrets"] = rf"""
with kinds(rank, kind, pattern, part, least) as (values {_KINDS}),
texts as (select distinct coalesce(text, '') as text from documents),
cut as (
  select text, rank, kind, least, regexp_extract_all(text, pattern) as whole, string_split_regex(text, pattern) as gaps,
    case when part = 0 then regexp_extract_all(text, pattern) else regexp_extract_all(text, pattern, 2) end as graded
  from texts, kinds where regexp_matches(text, pattern)),
found as (
  select text, rank, kind, least, unnest(range(1, len(whole) + 1)) as i, unnest(whole) as w, unnest(graded) as g, whole, gaps from cut),
spans as (
  select text, rank, kind, length(g) >= least as ok,
    (list_sum(list_transform(gaps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(whole[1:i - 1], lambda x: length(x))), 0))::bigint as s,
    length(w) as n
  from found),
named as (select text, rank, s, kind, kind || ':' || s || ':' || (s + n) as span from spans where ok),
told as (
  select text, count(*) filter (kind = 'assign') as n_assign, count(*) filter (kind = 'access') as n_access,
    count(*) filter (kind = 'hex') as n_hex, string_agg(span, ',' order by s, rank) as spans,
    string_agg(span, ',' order by s, rank) filter (kind in ('assign', 'access', 'hex')) as base
  from named group by text)
select doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access, coalesce(n_hex, 0) as n_hex,
  sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans
from documents d left join told t on coalesce(d.text, '') = t.text
"""
