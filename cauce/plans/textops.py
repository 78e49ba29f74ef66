"""Text corpus, features, retrieval and set-operation queries (T*, J13, J14, U02-U05, F26/F29/F30)."""

from __future__ import annotations

from pyspark.sql import functions as F

from cauce.functions import numeric as N
from cauce.functions import strings as S
from cauce.functions import text as TX
from cauce.operators import corpus as C, dense, inverted
from cauce.operators import retrieval as RT
from cauce.operators import term_blocks as TB
from cauce.operators.relational import top_n_per_group
from cauce.plans.facts import t
from cauce.plans.registry import query
from cauce.plans.sqlfrag import R

WS = S.PY_WS
WORDS = "regexp_extract_all(lower({0}), '[\\p{{L}}\\p{{N}}_]+')"
WORDS2 = "list_filter(regexp_extract_all(lower({0}), '[\\p{{L}}\\p{{N}}_]+'), lambda x: length(x) >= 2)"
# trim of all white space: DuckDB's trim takes the characters to strip
STRIP = "trim({0}, '" + S.WS_CHARS + "')"


def NORM(x: str) -> str:
    return f"trim(regexp_replace(nfc_normalize({x}), '{WS}+', ' ', 'g'))"


def REDACT(x: str) -> str:
    return (f"regexp_replace(regexp_replace({x}, '{S.EMAIL_PATTERN}', '[CORREO]', 'g'), "
            f"'{S.URL_PATTERN}', '[URL]', 'g')")


def labelled_docs(spark, sf):
    """documents ⋈ labels (left): label = quality, family = source."""
    lab = t(spark, sf, "labels").select("doc_id", F.col("quality").alias("label"))
    return t(spark, sf, "documents").select("doc_id", "text", "source", "lang").join(lab, "doc_id", "left")


LABELLED_SQL = """ld AS (SELECT d.doc_id, d.text, d.source, d.lang, l.quality AS label
       FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""


@query("t01_corpus_audit", sql=f"""
WITH {LABELLED_SQL},
pt AS (SELECT text, count(*) AS c, count(DISTINCT label) AS nl FROM ld GROUP BY text)
SELECT count(*) AS rows, count(*) - count(DISTINCT doc_id) AS repeated_ids,
  count(*) FILTER (WHERE label IS NULL) AS missing_labels, count(DISTINCT source) AS families,
  count(*) FILTER (WHERE length({STRIP.format('text')}) < 10) AS short_texts,
  (SELECT CAST(coalesce(sum(CASE WHEN c > 1 THEN c - 1 END), 0) AS BIGINT) FROM pt) AS duplicate_texts,
  (SELECT count(*) FILTER (WHERE nl > 1) FROM pt) AS conflicting_texts
FROM ld
""")
def t01(spark, sf):
    return C.corpus_audit(labelled_docs(spark, sf), "doc_id", "text", "label", "source")


PREP_SQL = LABELLED_SQL + f""",
pr AS (SELECT *, {REDACT(NORM('text'))} AS text_processed,
         CASE WHEN text IS NULL OR {STRIP.format('text')} = '' THEN 'texto ausente'
              WHEN length({STRIP.format('text')}) < 10 THEN 'texto insuficiente'
              WHEN label IS NULL THEN 'etiqueta ausente' END AS qr FROM ld),
fi AS (SELECT text_processed AS k, min(doc_id) AS first_id FROM pr WHERE qr IS NULL GROUP BY 1),
st AS (SELECT pr.*, fi.first_id,
         CASE WHEN qr IS NOT NULL THEN 'cuarentena' WHEN fi.first_id != pr.doc_id THEN 'duplicado' ELSE 'conservar' END AS state,
         CASE WHEN qr IS NOT NULL THEN qr WHEN fi.first_id != pr.doc_id THEN 'clave ya vista' ELSE 'ok' END AS reason,
         CASE WHEN qr IS NULL AND fi.first_id != pr.doc_id THEN fi.first_id END AS equivalent_id
       FROM pr LEFT JOIN fi ON pr.text_processed IS NOT DISTINCT FROM fi.k)"""


@query("t02_prepared_corpus", sql=f"""
WITH {PREP_SQL}
SELECT doc_id, state, md5(text_processed) AS processed_md5, text_processed != text AS changed FROM st
""")
def t02(spark, sf):
    p = C.prepare(labelled_docs(spark, sf), "doc_id", "text", "label")
    return p.select("doc_id", "state", F.md5("text_processed").alias("processed_md5"),
                    (F.col("text_processed") != F.col("text")).alias("changed"))


@query("w03_decision_register", sql=f"""
WITH {PREP_SQL}
SELECT doc_id AS id_original, state, reason, equivalent_id FROM st
""")
def w03(spark, sf):
    return C.decision_register(C.prepare(labelled_docs(spark, sf), "doc_id", "text", "label"), "doc_id")


SPLIT_SQL = LABELLED_SQL + """,
fam AS (SELECT source, row_number() OVER (ORDER BY md5('42' || source), source) AS rk,
               count(*) OVER () AS n FROM (SELECT DISTINCT source FROM ld)),
sp AS (SELECT ld.*, CASE WHEN rk <= floor(n * 0.7) THEN 'train'
                         WHEN rk <= floor(n * 0.7) + floor(n * 0.15) THEN 'validation' ELSE 'test' END AS split
       FROM ld LEFT JOIN fam ON ld.source IS NOT DISTINCT FROM fam.source)"""


def split_docs(spark, sf):
    return C.family_split(labelled_docs(spark, sf), "source", seed=42)


@query("t03_family_split", sql=f"WITH {SPLIT_SQL} SELECT doc_id, source, split FROM sp")
def t03(spark, sf):
    return split_docs(spark, sf).select("doc_id", "source", "split")


@query("t04_conflict_quarantine", sql=f"""
WITH {LABELLED_SQL},
bad AS (SELECT text FROM ld GROUP BY text HAVING count(DISTINCT label) > 1)
SELECT doc_id FROM ld WHERE text NOT IN (SELECT text FROM bad)
""")
def t04(spark, sf):
    return C.drop_conflicting_groups(labelled_docs(spark, sf), "text", "label").select("doc_id")


@query("t05_split_violations", sql=f"""
WITH {SPLIT_SQL}
SELECT count(*) - count(DISTINCT doc_id) AS duplicate_ids,
  count(*) FILTER (WHERE text IS NULL OR {STRIP.format('text')} = '') AS empty_texts,
  count(*) FILTER (WHERE split IS NULL) AS unassigned_rows,
  3 - count(DISTINCT split) AS missing_splits,
  (SELECT count(*) FROM (SELECT source FROM sp GROUP BY source HAVING count(DISTINCT split) > 1)) AS families_in_several_splits,
  (SELECT count(*) FROM (SELECT text FROM sp GROUP BY text HAVING count(DISTINCT split) > 1)) AS texts_in_several_splits,
  (SELECT coalesce(max(nl) - min(nl), 0) FROM (SELECT split, count(DISTINCT label) AS nl FROM sp
     WHERE label IS NOT NULL GROUP BY split)) AS label_coverage_gap
FROM sp
""")
def t05(spark, sf):
    return C.split_violations(split_docs(spark, sf), "doc_id", "text", "source", "label")


@query("t07_split_report", sql=f"""
WITH {SPLIT_SQL}
SELECT split, count(*) AS rows, count(DISTINCT source) AS families, count(label) AS labelled,
  count(DISTINCT label) AS labels, count(*) / (SELECT count(*) FROM sp) AS share FROM sp GROUP BY split
""")
def t07(spark, sf):
    return C.split_report(split_docs(spark, sf), "source", "label")


def CANON(x: str) -> str:
    return f"trim(lower(trim(regexp_replace(nfc_normalize({x}), '{WS}+', ' ', 'g'))), ' .,:;!?¿¡\"')"


@query("t08_text_leakage", sql=f"""
SELECT d.doc_id AS left_id, b.item_id AS right_id FROM documents d JOIN benchmark b
  ON md5({CANON('d.text')}) = md5({CANON('b.text')})
""")
def t08(spark, sf):
    return C.text_leakage(t(spark, sf, "documents"), "doc_id", "text", t(spark, sf, "benchmark"), "item_id", "text")


@query("t08_containment_leakage", sql="""
SELECT b.item_id AS pid, d.doc_id FROM documents d, benchmark b WHERE contains(d.text, b.text)
""")
def t08b(spark, sf):
    return RT.containment_pairs(t(spark, sf, "documents"), "doc_id", "text", t(spark, sf, "benchmark"), "item_id", "text")


TF1_SQL = f"""dt AS (SELECT doc_id AS id, {WORDS2.format('text')} AS ws FROM documents),
dtf AS (SELECT id, term, count(*) AS tf FROM (SELECT id, unnest(ws) AS term FROM dt) GROUP BY ALL),
dfs AS (SELECT term, count(*) AS df FROM dtf GROUP BY term),
idf AS (SELECT term, df, ln((1 + (SELECT count(*) FROM documents)) / (1 + df)) + 1 AS idf FROM dfs),
dw AS (SELECT id, term, tf * idf AS w FROM dtf JOIN idf USING (term)),
dwn AS (SELECT id, term, w / sqrt(sum(w * w) OVER (PARTITION BY id)) AS weight FROM dw)"""


def doc_postings(spark, sf, ngram_max=1):
    return C.term_counts(t(spark, sf, "documents"), "doc_id", "text", ngram_max=ngram_max)


@query("t09_vocabulary", sql=f"""
WITH {TF1_SQL}
SELECT term, count(*) AS df, sum(tf) AS total_tf FROM dtf GROUP BY term
""")
def t09(spark, sf):
    return doc_postings(spark, sf).groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("total_tf"))


def doc_tfidf(spark, sf, ngram_max=1):
    # read by the vocabulary and by the weights
    post = C.written(doc_postings(spark, sf, ngram_max), "postings")
    n = t(spark, sf, "documents").agg(F.count(F.lit(1))).scalar()
    idf = C.fit_idf(post, n)
    return C.tfidf(post, idf), idf, post


@query("t10_tfidf", sql=f"""
WITH {TF1_SQL}
SELECT id, term, {R('weight', 9)} AS weight FROM dwn
""")
def t10(spark, sf):
    w, _, _ = doc_tfidf(spark, sf)
    return w.select("id", "term", F.round("weight", 9).alias("weight"))


@query("t11_fit_train_transform_rest", sql=f"""
WITH {SPLIT_SQL},
tok AS (SELECT doc_id AS id, split, unnest({WORDS2.format('text')}) AS term FROM sp),
tf AS (SELECT id, split, term, count(*) AS tf FROM tok GROUP BY ALL),
vocab AS (SELECT DISTINCT term FROM tf WHERE split = 'train')
SELECT tf.id, tf.split, count(*) FILTER (WHERE v.term IS NULL) AS oov_terms,
  count(*) FILTER (WHERE v.term IS NOT NULL) AS known_terms
FROM tf LEFT JOIN vocab v ON tf.term = v.term WHERE tf.split != 'train' GROUP BY ALL
""")
def t11(spark, sf):
    sp = split_docs(spark, sf)
    post = C.term_counts(sp, "doc_id", "text").join(sp.select(F.col("doc_id").alias("id"), "split"), "id")
    train = post.filter(F.col("split") == "train")
    idf = C.fit_idf(train, sp.filter(F.col("split") == "train").agg(F.count(F.lit(1))).scalar())
    rest = post.filter(F.col("split") != "train")
    oov = C.oov_terms(rest, idf).groupBy("id", "split").agg(F.count(F.lit(1)).alias("oov_terms"))
    known = rest.join(idf.select("term").hint("merge"), "term").groupBy("id", "split") \
        .agg(F.count(F.lit(1)).alias("known_terms"))
    return oov.join(known, ["id", "split"], "full_outer").select(
        "id", "split", F.coalesce("oov_terms", F.lit(0)).alias("oov_terms"),
        F.coalesce("known_terms", F.lit(0)).alias("known_terms"))


@query("t12_top_terms", sql=f"""
WITH {TF1_SQL}
SELECT id, term, {R('weight', 9)} AS weight, rn FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY round(weight, 9) DESC, term) AS rn FROM dwn) WHERE rn <= 5
""")
def t12(spark, sf):
    w, _, _ = doc_tfidf(spark, sf)
    w = w.withColumn("weight", F.round("weight", 9))
    return top_n_per_group(w, "id", [F.desc("weight"), F.asc("term")], 5).select("id", "term", "weight", "rn")


# -------------------------------------------------------------- lexical search
def _tf12_sql(src: str, idcol: str, prefix: str) -> str:
    return f"""{prefix}t AS (SELECT {idcol} AS id, {WORDS2.format('text')} AS ws FROM {src}),
{prefix}tf AS (SELECT id, term, count(*) AS tf FROM (
   SELECT id, unnest(ws) AS term FROM {prefix}t
   UNION ALL SELECT id, ws[i] || ' ' || ws[i + 1] FROM {prefix}t, range(1, len(ws)) r(i)) GROUP BY ALL)"""


LEX_SQL = f"""{_tf12_sql('documents', 'doc_id', 'd')},
{_tf12_sql('benchmark', 'item_id', 'q')},
idf AS (SELECT term, ln((1 + (SELECT count(*) FROM documents)) / (1 + count(*))) + 1 AS idf FROM dtf GROUP BY term),
dw AS (SELECT id, term, tf * idf AS w FROM dtf JOIN idf USING (term)),
dwn AS (SELECT id, term, w / sqrt(sum(w * w) OVER (PARTITION BY id)) AS w FROM dw),
qw AS (SELECT id, term, tf * idf AS w FROM qtf JOIN idf USING (term)),
qwn AS (SELECT id, term, w / sqrt(sum(w * w) OVER (PARTITION BY id)) AS w FROM qw),
sc AS (SELECT q.id AS qid, d.id AS item_id, sum(q.w * d.w) AS score FROM qwn q JOIN dwn d USING (term) GROUP BY ALL),
allp AS (SELECT q.qid, d.doc_id AS item_id, coalesce(sc.score, 0.0) AS score
         FROM (SELECT DISTINCT id AS qid FROM qwn) q CROSS JOIN documents d
         LEFT JOIN sc ON sc.qid = q.qid AND sc.item_id = d.doc_id),
rk AS (SELECT qid, item_id, score, row_number() OVER (PARTITION BY qid ORDER BY round(score, 9) DESC, item_id) AS rank FROM allp)"""


def lexical_search(spark, sf, k=3):
    """(1,2)-gram TF-IDF fitted on documents; benchmark items are the queries.

    Documents are held in blocks (:mod:`cauce.operators.term_blocks`): a term's frequency is added up
    over blocks and goes back once a block, and a block gives its documents' lengths over all their
    terms.  Terms leave a block with their weights only where some query asks for them, as the others
    count for frequencies and lengths alone.
    """
    docs = t(spark, sf, "documents")
    qpost = C.written(C.term_counts(t(spark, sf, "benchmark"), "item_id", "text", ngram_max=2), "query-postings")
    n = docs.agg(F.count(F.lit(1))).first()[0]
    blocks = TB.term_blocks(docs, "doc_id", "text", ngram_max=2)
    stats = TB.term_stats(blocks, qpost.select("term").distinct())
    queries = inverted.query_terms(C.tfidf(qpost, C.with_idf(TB.frequencies(stats), n), l2=False))
    index = inverted.cut_shards(TB.asked_weights(blocks, stats, n))
    return inverted.search_index(index, queries, k, docs.select(F.col("doc_id").alias("item_id")))


@query("t13_lexical_search", sql=f"""
WITH {LEX_SQL}
SELECT qid, item_id, {R('score', 9)} AS score, rank FROM rk WHERE rank <= 3
""")
def t13(spark, sf):
    return lexical_search(spark, sf).select("qid", "item_id", F.round("score", 9).alias("score"), "rank")


@query("t15_lexical_metrics", sql=f"""
WITH {LEX_SQL},
rel AS (SELECT b.item_id AS qid, d.doc_id AS item_id FROM documents d, benchmark b WHERE contains(d.text, b.text)),
top AS (SELECT * FROM rk WHERE rank <= 3),
pq AS (SELECT r.qid, count(*) AS n_rel,
          count(*) FILTER (WHERE t.item_id IS NOT NULL) AS hits, min(t.rank) AS first_hit
       FROM rel r LEFT JOIN top t ON r.qid = t.qid AND r.item_id = t.item_id GROUP BY r.qid)
SELECT {R('avg(hits * 1.0 / n_rel)', 9)} AS recall_at_k, {R('avg(coalesce(1.0 / first_hit, 0.0))', 9)} AS mrr,
  count(*) AS n_answerable FROM pq
""")
def t15b(spark, sf):
    ranking = lexical_search(spark, sf)
    rel = RT.containment_pairs(t(spark, sf, "documents"), "doc_id", "text", t(spark, sf, "benchmark"),
                               "item_id", "text").select(F.col("pid").alias("qid"), F.col("doc_id").alias("item_id"))
    m = RT.retrieval_metrics(ranking, rel)
    return m.select(F.round("recall_at_k", 9).alias("recall_at_k"), F.round("mrr", 9).alias("mrr"), "n_answerable")


# ---------------------------------------------------------------- dense search
def unit(col):
    return N.l2_normalize(F.transform(col, lambda x: x.cast("double")))


def label_centroids(emb):
    pe = emb.select("label", F.posexplode("embedding").alias("pos", "x"))
    per = pe.groupBy("label", "pos").agg(F.avg(F.col("x").cast("double")).alias("m"))
    return per.groupBy("label").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("pos", "m"))), lambda s: s["m"]).alias("centroid"))


DENSE_SQL = """
cen AS (SELECT label, list(m ORDER BY pos) AS c FROM (
  SELECT label, pos, avg(x) AS m FROM (SELECT label, unnest(CAST(embedding AS DOUBLE[])) AS x,
    generate_subscripts(embedding, 1) AS pos FROM embeddings) GROUP BY ALL) GROUP BY label),
cn AS (SELECT label, list_transform(c, lambda x: x / sqrt(list_sum(list_transform(c, lambda y: y * y)))) AS c FROM cen),
en AS (SELECT vec_id, label, list_transform(CAST(embedding AS DOUBLE[]),
         lambda x: x / sqrt(list_sum(list_transform(CAST(embedding AS DOUBLE[]), lambda y: y * y)))) AS v FROM embeddings),
sc AS (SELECT cn.label AS qid, en.vec_id AS item_id, list_dot_product(en.v, cn.c) AS score FROM cn, en),
rk AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY round(score, 9) DESC, item_id) AS rank FROM sc)"""


def dense_search(spark, sf, k=5):
    emb = t(spark, sf, "embeddings")
    cen = label_centroids(emb).select(F.col("label").alias("qid"), unit(F.col("centroid")).alias("v"))
    items = emb.select("vec_id", unit(F.col("embedding")).alias("v"))
    return dense.nearest(spark, items, "vec_id", "v", cen, "qid", "v", k)


@query("t14_dense_search", sql=f"""
WITH {DENSE_SQL}
SELECT qid, item_id, {R('score', 6)} AS score, rank FROM rk WHERE rank <= 5
""")
def t14(spark, sf):
    return dense_search(spark, sf).select("qid", "item_id", F.round("score", 6).alias("score"), "rank")


@query("t15_dense_metrics", sql=f"""
WITH {DENSE_SQL},
rel AS (SELECT label AS qid, vec_id AS item_id FROM embeddings),
top AS (SELECT * FROM rk WHERE rank <= 5),
pq AS (SELECT r.qid, count(*) AS n_rel, count(*) FILTER (WHERE t.item_id IS NOT NULL) AS hits, min(t.rank) AS first_hit
       FROM rel r LEFT JOIN top t ON r.qid = t.qid AND r.item_id = t.item_id GROUP BY r.qid)
SELECT {R('avg(hits * 1.0 / n_rel)', 9)} AS recall_at_k, {R('avg(coalesce(1.0 / first_hit, 0.0))', 9)} AS mrr,
  count(*) AS n_answerable FROM pq
""")
def t15(spark, sf):
    rel = t(spark, sf, "embeddings").select(F.col("label").cast("long").alias("qid"),
                                            F.col("vec_id").alias("item_id"))
    m = RT.retrieval_metrics(dense_search(spark, sf), rel)
    return m.select(F.round("recall_at_k", 9).alias("recall_at_k"), F.round("mrr", 9).alias("mrr"), "n_answerable")


@query("t16_best_threshold", sql=f"""
WITH s AS (SELECT value / 500 AS score, event_type = 'purchase' AS positive FROM events),
pn AS (SELECT count(*) FILTER (WHERE positive) AS P, count(*) FILTER (WHERE NOT positive) AS N FROM s),
lv AS (SELECT score AS v, count(*) FILTER (WHERE positive) AS pos, count(*) FILTER (WHERE NOT positive) AS neg FROM s GROUP BY 1),
cum AS (SELECT v, sum(pos) OVER (ORDER BY v) AS cpos, sum(neg) OVER (ORDER BY v) AS cneg, lead(v) OVER (ORDER BY v) AS nv FROM lv),
cand AS (
  SELECT (v + nv) / 2 AS threshold, ((P - cpos) / P + cneg / N) / 2 AS ba FROM cum, pn WHERE nv IS NOT NULL
  UNION ALL SELECT 0.0, ((SELECT count(*) FROM s WHERE positive AND score >= 0.0) / P
                        + (SELECT count(*) FROM s WHERE NOT positive AND score < 0.0) / N) / 2 FROM pn
  UNION ALL SELECT 1.01, ((SELECT count(*) FROM s WHERE positive AND score >= 1.01) / P
                         + (SELECT count(*) FROM s WHERE NOT positive AND score < 1.01) / N) / 2 FROM pn)
SELECT {R('arg_max(threshold, (ba, threshold))', 9)} AS threshold, {R('max(ba)', 9)} AS balanced_accuracy FROM cand
""")
def t16(spark, sf):
    e = t(spark, sf, "events").select((F.col("value") / 500).alias("score"),
                                      (F.col("event_type") == "purchase").alias("positive"))
    b = RT.best_threshold(e)
    return b.select(F.round("threshold", 9).alias("threshold"), F.round("balanced_accuracy", 9).alias("balanced_accuracy"))


# --------------------------------------------------------------- rule baseline
# Keyword rules of the toxicity baseline, two versions.
TOXIC_V1 = r"idiot|stupid|hate|dumm|idiota|odio|merde"
TOXIC_V2 = r"idiot|stupid|hate|dumm|idiota|odio|merde|kill|tonto|imbécil"


@query("t24_rule_vs_labels", sql=f"""
WITH j AS (SELECT l.toxic, CAST(regexp_matches(lower(d.text), '{TOXIC_V1}') AS INTEGER) AS r1,
                  CAST(regexp_matches(lower(d.text), '{TOXIC_V2}') AS INTEGER) AS r2
           FROM documents d JOIN labels l ON d.doc_id = l.doc_id)
SELECT count(*) AS n, count(*) FILTER (WHERE r2 = toxic) AS agree, count(*) FILTER (WHERE r2 != toxic) AS errors,
  count(*) FILTER (WHERE r2 = 1 AND toxic = 0) AS false_pos, count(*) FILTER (WHERE r2 = 0 AND toxic = 1) AS false_neg,
  count(*) FILTER (WHERE r1 != r2) AS changed_v1_v2 FROM j
""")
def t24(spark, sf):
    d = t(spark, sf, "documents").join(t(spark, sf, "labels"), "doc_id")
    low = F.lower("text")
    j = d.select("toxic", low.rlike(TOXIC_V1).cast("int").alias("r1"), low.rlike(TOXIC_V2).cast("int").alias("r2"))
    return j.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("r2") == F.col("toxic")).alias("agree"),
                 F.count_if(F.col("r2") != F.col("toxic")).alias("errors"),
                 F.count_if((F.col("r2") == 1) & (F.col("toxic") == 0)).alias("false_pos"),
                 F.count_if((F.col("r2") == 0) & (F.col("toxic") == 1)).alias("false_neg"),
                 F.count_if(F.col("r1") != F.col("r2")).alias("changed_v1_v2"))


# ------------------------------------------------------------ window pairs
def window_pair_counts(docs, text_col: str, max_dist: int = 2):
    """(center, context, n).  Either word of a pair is the other's context, so unordered pairs are counted and
    then turned both ways; a word beside itself counts twice."""
    w = docs.select(S.words(text_col).alias("ws"))
    met = F.flatten(F.array(*[_unordered(F.col("ws"), d) for d in range(1, max_dist + 1)]))
    n = S.explode_nonnull(w, met, "p").groupBy("p.a", "p.b").agg(F.count(F.lit(1)).alias("n"))
    same = F.array(F.struct(F.col("a").alias("center"), F.col("b").alias("context"), (2 * F.col("n")).alias("n")))
    both = F.array(F.struct(F.col("a").alias("center"), F.col("b").alias("context"), "n"),
                   F.struct(F.col("b").alias("center"), F.col("a").alias("context"), "n"))
    return n.select(F.inline(F.when(F.col("a") == F.col("b"), same).otherwise(both)))


def _unordered(words, d: int):
    m = F.greatest(F.size(words) - d, F.lit(0))
    z = F.arrays_zip(F.slice(words, 1, m).alias("a"), F.slice(words, d + 1, m).alias("b"))
    return F.transform(z, lambda s: F.struct(F.least(s["a"], s["b"]).alias("a"), F.greatest(s["a"], s["b"]).alias("b")))


@query("j13_window_pairs", sql=f"""
WITH w AS (SELECT doc_id, {WORDS.format('text')} AS ws FROM documents),
t AS (SELECT doc_id, ws[i] AS tok, i FROM w, range(1, len(ws) + 1) r(i))
SELECT a.tok AS center, b.tok AS context, count(*) AS n
FROM t a JOIN t b ON a.doc_id = b.doc_id AND abs(a.i - b.i) BETWEEN 1 AND 2 GROUP BY ALL
""")
def j13(spark, sf):
    return window_pair_counts(t(spark, sf, "documents"), "text")


# ------------------------------------------------------------- set operations (U)
@query("u02_set_overlap", sql=f"""
WITH a AS (SELECT DISTINCT unnest({WORDS.format('text')}) AS w FROM documents WHERE source < 'src5'),
b AS (SELECT DISTINCT unnest({WORDS.format('text')}) AS w FROM documents WHERE source >= 'src5')
SELECT (SELECT count(*) FROM (SELECT w FROM a INTERSECT SELECT w FROM b)) AS tp,
  (SELECT count(*) FROM (SELECT w FROM b EXCEPT SELECT w FROM a)) AS fp,
  (SELECT count(*) FROM (SELECT w FROM a EXCEPT SELECT w FROM b)) AS fn
""")
def u02(spark, sf):
    d = t(spark, sf, "documents")
    a = S.explode_nonnull(d.filter(F.col("source") < "src5"), S.words("text"), "w").distinct()
    b = S.explode_nonnull(d.filter(F.col("source") >= "src5"), S.words("text"), "w").distinct()
    tp = a.intersect(b).agg(F.count(F.lit(1))).scalar()
    fp = b.subtract(a).agg(F.count(F.lit(1))).scalar()
    fn = a.subtract(b).agg(F.count(F.lit(1))).scalar()
    return spark.range(1).select(tp.alias("tp"), fp.alias("fp"), fn.alias("fn"))


@query("u03_vocabulary_difference", sql=f"""
SELECT DISTINCT unnest({WORDS.format('text')}) AS term FROM documents WHERE lang = 'de'
EXCEPT SELECT DISTINCT unnest({WORDS.format('text')}) FROM documents WHERE lang = 'en'
""")
def u03(spark, sf):
    d = t(spark, sf, "documents")
    de = S.explode_nonnull(d.filter(F.col("lang") == "de"), S.words("text"), "term")
    en = S.explode_nonnull(d.filter(F.col("lang") == "en"), S.words("text"), "term")
    return de.subtract(en)


TURNS_SQL = f"""w AS (SELECT conv_id, turn, {WORDS.format('text')} AS ws FROM conversations),
p AS (SELECT a.conv_id, a.turn, a.ws AS wa, b.ws AS wb FROM w a JOIN w b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1)"""


def turn_pairs(spark, sf):
    c = t(spark, sf, "conversations").select("conv_id", "turn", S.words("text").alias("ws"))
    nxt = c.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("ws").alias("wb"))
    return c.withColumnRenamed("ws", "wa").join(nxt, ["conv_id", "turn"])


@query("u04_symmetric_difference", sql=f"""
WITH {TURNS_SQL}
SELECT conv_id, turn, len(list_filter(list_distinct(wa), lambda x: NOT list_contains(wb, x))) AS only_a,
  len(list_filter(list_distinct(wb), lambda x: NOT list_contains(wa, x))) AS only_b,
  len(list_filter(list_distinct(wa), lambda x: NOT list_contains(wb, x)))
    + len(list_filter(list_distinct(wb), lambda x: NOT list_contains(wa, x))) AS sym_diff FROM p
""")
def u04(spark, sf):
    p = turn_pairs(spark, sf)
    a_only, b_only = F.array_except("wa", "wb"), F.array_except("wb", "wa")
    return p.select("conv_id", "turn", F.size(a_only).alias("only_a"), F.size(b_only).alias("only_b"),
                    F.size(F.array_union(a_only, b_only)).alias("sym_diff"))


@query("u05_multiset_equal", sql=f"""
WITH {TURNS_SQL}
SELECT conv_id, turn, list_sort(wa) = list_sort(wb) AS same_multiset, list_sort(list_distinct(wa)) = list_sort(list_distinct(wb)) AS same_set FROM p
""")
def u05(spark, sf):
    p = turn_pairs(spark, sf)
    return p.select("conv_id", "turn", (F.array_sort("wa") == F.array_sort("wb")).alias("same_multiset"),
                    (F.array_sort(F.array_distinct("wa")) == F.array_sort(F.array_distinct("wb"))).alias("same_set"))


# --------------------------------------------------- Python-offset text operators (rows)
def SPANS(pattern: str, label: str, src: str = "documents", group: str = "doc_id") -> str:
    """DuckDB: one row a match with code-point offsets, from the lengths of the gaps between matches."""
    return f"""SELECT {group}, label, CAST(s AS INT) AS "start", CAST(s + length(m) AS INT) AS "end", m AS match FROM (
      SELECT {group}, '{label}' AS label, ms[i] AS m,
        list_sum(list_transform(gaps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: length(x))), 0) AS s
      FROM (SELECT {group}, regexp_extract_all(text, '{pattern}') AS ms, string_split_regex(text, '{pattern}') AS gaps FROM {src}),
        range(1, len(ms) + 1) r(i))"""


@query("f26_chunking", sql=f"""
WITH tok AS ({SPANS("[^" + WS[1:-1] + "]+", "T")}),
num AS (SELECT doc_id, "start", "end", row_number() OVER (PARTITION BY doc_id ORDER BY "start") - 1 AS i, count(*) OVER (PARTITION BY doc_id) AS n FROM tok),
win AS (SELECT doc_id, CAST(k AS INT) AS chunk_index, n FROM (SELECT DISTINCT doc_id, n FROM num), range(0, CAST(greatest(n - 10, 1) AS BIGINT), 50) r(k))
SELECT w.doc_id, chunk_index, min("start") AS "start", max("end") AS "end", substr(any_value(d.text), min("start") + 1, max("end") - min("start")) AS chunk
FROM win w JOIN num USING (doc_id) JOIN documents d USING (doc_id)
WHERE i >= chunk_index AND i < chunk_index + 60 GROUP BY w.doc_id, chunk_index
""")
def f26(spark, sf):
    d = t(spark, sf, "documents")
    ch = S.explode_nonnull(d, TX.chunk_offsets(F.col("text"), 60, 10), "c", "doc_id", "text")
    return ch.select("doc_id", "c.chunk_index", "c.start", "c.end",
                     F.substring("text", F.col("c.start") + 1, F.col("c.end") - F.col("c.start")).alias("chunk"))


# PII rules, two versions (v1 lenient, v2 strict) for span scoring.
PII_V1 = (("EMAIL", r"[\w.+-]+@[\w.-]+"), ("CARD", r"\b\d{13,19}\b"), ("SECRET", r"token = \"[0-9a-f]+\""))
PII_V2 = (("EMAIL", r"[\w.+-]+@[\w.-]+\.[A-Za-z]{2,}"), ("CARD", r"\b\d{16}\b"),
          ("SECRET", r"token = \"[0-9a-f]{40}\""))


V2_SQL = f"""{SPANS('[\\p{L}\\p{N}_.+-]+@[\\p{L}\\p{N}_.-]+[.][A-Za-z]{2,}', 'EMAIL')}
UNION ALL {SPANS('\\b[0-9]{16}\\b', 'CARD')} UNION ALL {SPANS('token = "[0-9a-f]{40}"', 'SECRET')}"""
V1_SQL = f"""{SPANS('[\\p{L}\\p{N}_.+-]+@[\\p{L}\\p{N}_.-]+', 'EMAIL')}
UNION ALL {SPANS('\\b[0-9]{13,19}\\b', 'CARD')} UNION ALL {SPANS('token = "[0-9a-f]+"', 'SECRET')}"""
BIO_SQL = f"""sp AS ({V2_SQL}), tk AS ({SPANS('[\\p{L}\\p{N}_]+|[^\\p{L}\\p{N}_' + WS[1:-1] + ']', 'T', '(SELECT * FROM documents WHERE doc_id IN (SELECT doc_id FROM sp))')}),
tg AS (SELECT tk.doc_id, tk.match AS token, tk."start", tk."end",
         coalesce(max_by(CASE WHEN sp."start" = tk."start" THEN 'B-' ELSE 'I-' END || sp.label, (sp."start", sp."end", sp.label)), 'O') AS tag
       FROM tk LEFT JOIN sp ON sp.doc_id = tk.doc_id AND tk."start" >= sp."start" AND tk."end" <= sp."end" GROUP BY ALL)"""


@query("f29_regex_spans", sql=f"""SELECT doc_id, "start", "end", label FROM ({V2_SQL})""")
def f29(spark, sf):
    d = t(spark, sf, "documents")
    return S.explode_nonnull(d, TX.regex_spans(F.col("text"), PII_V2), "s", "doc_id").select(
        "doc_id", "s.start", "s.end", "s.label")


@query("t18_span_scores", sql=f"""
WITH g AS (SELECT DISTINCT doc_id, "start", "end", label FROM ({V2_SQL})), p AS (SELECT DISTINCT doc_id, "start", "end", label FROM ({V1_SQL})),
m AS (SELECT (SELECT count(*) FROM (FROM g INTERSECT FROM p)) AS tp, (SELECT count(*) FROM (FROM p EXCEPT FROM g)) AS fp,
        (SELECT count(*) FROM (FROM g EXCEPT FROM p)) AS fn),
r AS (SELECT *, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS precision, CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END AS recall FROM m)
SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1 FROM r
""")
def t18(spark, sf):
    d = t(spark, sf, "documents")
    g = S.explode_nonnull(d, TX.regex_spans(F.col("text"), PII_V2), "s", "doc_id").select("doc_id", "s.*")
    p = S.explode_nonnull(d, TX.regex_spans(F.col("text"), PII_V1), "s", "doc_id").select("doc_id", "s.*")
    return RT.span_scores(g, p)


def tagged_docs(spark, sf):
    """doc_id, toks, tags of the documents that have spans.

    The spans are written once, so the filter on them never makes their UDF run twice and only
    documents with spans are tokenized."""
    d = t(spark, sf, "documents").select("doc_id", "text", TX.regex_spans(F.col("text"), PII_V2).alias("spans"))
    d = d.filter(F.size("spans") > 0).checkpoint(eager=True).select("doc_id", "spans", TX.token_offsets(F.col("text")).alias("toks"))
    return d.select("doc_id", "toks", TX.bio_tags(F.col("toks"), F.col("spans")).alias("tags"))


@query("f30_bio_spans", sql=f"""
WITH {BIO_SQL},
nx AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY "start") AS i, lag(tag) OVER (PARTITION BY doc_id ORDER BY "start") AS before FROM tg),
op AS (SELECT *, sum(CASE WHEN tag LIKE 'B-%' OR before IS NULL OR substr(before, 3) != substr(tag, 3) THEN 1 ELSE 0 END)
         OVER (PARTITION BY doc_id ORDER BY "start") AS run FROM nx)
SELECT doc_id, min("start") AS "start", max("end") AS "end", substr(any_value(tag), 3) AS label FROM op WHERE tag != 'O' GROUP BY doc_id, run
""")
def f30b(spark, sf):
    d = tagged_docs(spark, sf).select("doc_id", TX.bio_spans(F.col("toks"), F.col("tags")).alias("s"))
    return S.explode_nonnull(d, F.col("s"), "s", "doc_id").select("doc_id", "s.start", "s.end", "s.label")


@query("f30_bio_tags", sql=f"""WITH {BIO_SQL} SELECT doc_id, token, tag FROM tg WHERE tag != 'O'""")
def f30(spark, sf):
    d = tagged_docs(spark, sf)
    z = S.explode_nonnull(d, F.arrays_zip(F.col("toks.token").alias("token"), F.col("tags").alias("tag")), "z",
                          "doc_id")
    return z.select("doc_id", "z.token", "z.tag").filter(F.col("tag") != "O")


def SUSPICIOUS(x: str) -> str:
    return f"regexp_matches(lower({x}), '{S.SUSPICIOUS_PATTERN}')"


@query("t17_evidence_screening", sql=f"""
WITH {LEX_SQL},
e AS (SELECT rk.*, d.text, split_part(d.text, chr(10), 1) AS title, NOT {SUSPICIOUS('d.text')} AS safe
      FROM rk JOIN documents d ON d.doc_id = rk.item_id WHERE rank <= 3),
q AS (SELECT qid, count(*) FILTER (WHERE safe) AS n_allowed, count(DISTINCT text) FILTER (WHERE safe) AS n_texts,
        count(DISTINCT title) FILTER (WHERE safe) AS n_titles, arg_min(score, rank) FILTER (WHERE safe) AS best FROM e GROUP BY qid)
SELECT qid, n_allowed, n_texts, n_titles, {R('best', 6)} AS best_score,
  CASE WHEN {SUSPICIOUS('b.text')} THEN 'suspicious_question' WHEN n_allowed = 0 OR best < 0.1 THEN 'insufficient_evidence'
       WHEN n_texts > 1 AND n_titles = 1 THEN 'contradictory' ELSE 'answer' END AS decision
FROM q JOIN benchmark b ON b.item_id = q.qid
""")
def t17(spark, sf):
    ranked = lexical_search(spark, sf)
    questions = t(spark, sf, "benchmark").select(F.col("item_id").alias("qid"), F.col("text").alias("question"))
    docs = t(spark, sf, "documents").select(F.col("doc_id").alias("item_id"), "text",
                                            F.substring_index("text", "\n", 1).alias("title"))
    out = RT.screen_evidence(ranked.join(docs, "item_id"), threshold=0.1, questions=questions)
    return out.withColumn("best_score", F.round("best_score", 6))
