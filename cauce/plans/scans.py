"""Scan/state queries (S*) and scalar-function queries (F*) over the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from cauce.functions import dates as D
from cauce.functions import numeric as N
from cauce.functions import strings as S
from cauce.functions import text as TX
from cauce.plans.facts import t
from cauce.plans.registry import query
from cauce.plans.sqlfrag import R
from cauce.sources import sinks, state
from cauce.sources.tables import register_views

WS = S.PY_WS
WORDS_SQL = "regexp_extract_all(lower({0}), '[\\p{{L}}\\p{{N}}_]+')"
TOKENS_SQL = "regexp_extract_all(lower({0}), '[\\p{{L}}\\p{{N}}_]+|[^\\p{{L}}\\p{{N}}_\\s]')"


# ------------------------------------------------------------------ scans (S)
@query("s08_projected_scan", sql="SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderpriority = '1-URGENT'")
def s08(spark, sf):
    return t(spark, sf, "orders").filter(F.col("o_orderpriority") == "1-URGENT").select("o_orderkey", "o_orderdate")


WATERMARK = "2000-01-01 00:00:00"


@query("s09_incremental_scan", sql=f"""
SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate > TIMESTAMP '{WATERMARK}'
""")
def s09(spark, sf):
    return state.incremental_scan(t(spark, sf, "orders"), "o_orderdate", WATERMARK).select("o_orderkey", "o_orderdate")


@query("s09_next_watermark", sql=f"""
SELECT coalesce(CAST(max(o_orderdate) AS VARCHAR), '{WATERMARK}') AS watermark_after
FROM orders WHERE o_orderdate > TIMESTAMP '{WATERMARK}'
""")
def s09b(spark, sf):
    inc = state.incremental_scan(t(spark, sf, "orders"), "o_orderdate", WATERMARK)
    return inc.agg(state.next_watermark(inc, "o_orderdate", WATERMARK).alias("watermark_after"))


@query("s15_upsert_merge", sql="""
WITH target AS (SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders WHERE o_orderdate <= TIMESTAMP '2000-06-30'),
updates AS (SELECT o_orderkey, round(o_totalprice * 1.1, 3) AS o_totalprice, 'U' AS o_orderstatus FROM orders
            WHERE o_orderdate >= TIMESTAMP '2000-01-01')
SELECT * FROM target WHERE o_orderkey NOT IN (SELECT o_orderkey FROM updates)
UNION ALL SELECT * FROM updates
""")
def s15(spark, sf):
    o = t(spark, sf, "orders")
    target = o.filter(F.col("o_orderdate") <= F.lit("2000-06-30").cast("timestamp_ntz")) \
        .select("o_orderkey", "o_totalprice", "o_orderstatus")
    updates = o.filter(F.col("o_orderdate") >= F.lit("2000-01-01").cast("timestamp_ntz")) \
        .select("o_orderkey", F.round(F.col("o_totalprice") * 1.1, 3).alias("o_totalprice"),
                F.lit("U").alias("o_orderstatus"))
    return state.merge_frames(target, updates, "o_orderkey")


@query("s15_upsert_counts", sql="""
WITH target AS (SELECT o_orderkey FROM orders WHERE o_orderdate <= TIMESTAMP '2000-06-30'),
updates AS (SELECT o_orderkey FROM orders WHERE o_orderdate >= TIMESTAMP '2000-01-01')
SELECT count(*) FILTER (WHERE t.o_orderkey IS NULL) AS inserted, count(*) FILTER (WHERE t.o_orderkey IS NOT NULL) AS updated
FROM updates u LEFT JOIN target t ON u.o_orderkey = t.o_orderkey
""")
def s15b(spark, sf):
    o = t(spark, sf, "orders")
    tk = o.filter(F.col("o_orderdate") <= F.lit("2000-06-30").cast("timestamp_ntz")).select(
        "o_orderkey", F.lit(True).alias("_exists"))
    up = o.filter(F.col("o_orderdate") >= F.lit("2000-01-01").cast("timestamp_ntz")).select("o_orderkey")
    j = up.join(tk, "o_orderkey", "left")
    return j.agg(F.count_if(F.col("_exists").isNull()).alias("inserted"), F.count_if(F.col("_exists")).alias("updated"))


@query("s19_fingerprint")
def s19(spark, sf):
    return sinks.fingerprint(t(spark, sf, "orders"))


@query("s19_row_sha256", sql="""
SELECT c_custkey, sha256(c_name || '|' || c_mktsegment) AS row_sha256 FROM customer
""")
def s19b(spark, sf):
    c = t(spark, sf, "customer")
    return c.select("c_custkey", F.sha2(F.concat_ws("|", "c_name", "c_mktsegment"), 256).alias("row_sha256"))


@query("s22_newest_log_rows", sql="SELECT event_id, ts, event_type FROM events ORDER BY event_id DESC LIMIT 20")
def s22(spark, sf):
    return state.newest(t(spark, sf, "events").select("event_id", "ts", "event_type"), "event_id", 20)


@query("s24_temp_view_sql", sql="""
SELECT l_returnflag, l_linestatus, sum(l_quantity) AS sum_qty,
  sum(l_extendedprice * (1 - l_discount)) AS revenue, count(*) AS n
FROM lineitem WHERE l_shipdate <= TIMESTAMP '2000-12-01' GROUP BY l_returnflag, l_linestatus
""")
def s24(spark, sf):
    register_views(spark, sf, ["lineitem"])
    return spark.sql("""
      SELECT l_returnflag, l_linestatus, sum(l_quantity) AS sum_qty,
             sum(l_extendedprice * (1 - l_discount)) AS revenue, count(*) AS n
      FROM lineitem WHERE l_shipdate <= TIMESTAMP_NTZ '2000-12-01' GROUP BY l_returnflag, l_linestatus""")


# -------------------------------------------------------------- strings (F)
@query("f01_case_functions", sql="""
SELECT p_partkey, trim(p_name) AS trimmed, lower(p_name) AS lowered, upper(p_name) AS uppered,
  array_to_string(list_transform(string_split(p_name, ' '), lambda w: upper(left(w, 1)) || lower(substr(w, 2))), ' ') AS titled
FROM part
""")
def f01(spark, sf):
    p = t(spark, sf, "part")
    return p.select("p_partkey", F.trim("p_name").alias("trimmed"), F.lower("p_name").alias("lowered"),
                    F.upper("p_name").alias("uppered"), F.initcap("p_name").alias("titled"))


@query("f03_casefold_equal", sql="""
SELECT p_partkey, lower(trim(p_type)) = lower(trim(' Economy ')) AS is_economy FROM part
""")
def f03(spark, sf):
    return t(spark, sf, "part").select("p_partkey", S.casefold_equal("p_type", F.lit(" Economy ")).alias("is_economy"))


@query("f04_regex_format", sql="""
SELECT c_custkey, regexp_full_match(c_name, 'Customer#[0-9]{9}') AS name_ok,
  regexp_full_match(c_mktsegment, '[A-Z]+') AS segment_ok FROM customer
""")
def f04(spark, sf):
    c = t(spark, sf, "customer")
    return c.select("c_custkey", S.full_match("c_name", r"Customer#[0-9]{9}").alias("name_ok"),
                    S.full_match("c_mktsegment", "[A-Z]+").alias("segment_ok"))


@query("f05_first_number", sql="""
SELECT p_partkey, TRY_CAST(nullif(regexp_extract(p_brand, '([0-9.]+)', 1), '') AS DOUBLE) AS brand_no,
  TRY_CAST(nullif(regexp_extract(p_name, '([0-9.]+)', 1), '') AS DOUBLE) AS name_no FROM part
""")
def f05(spark, sf):
    return t(spark, sf, "part").select("p_partkey", S.first_number("p_brand").alias("brand_no"),
                                       S.first_number("p_name").alias("name_no"))


@query("f06_coerce_numeric", sql="""
SELECT c_custkey, TRY_CAST(substr(c_name, 10) AS BIGINT) AS name_number,
  TRY_CAST(c_mktsegment AS DOUBLE) AS segment_number FROM customer
""")
def f06(spark, sf):
    c = t(spark, sf, "customer")
    return c.select("c_custkey", F.substr("c_name", F.lit(10)).try_cast("long").alias("name_number"),
                    S.to_number("c_mktsegment").alias("segment_number"))


@query("f07_sentinel_to_null", sql="""
SELECT event_id, TRY_CAST(CASE WHEN trim(event_type) IN ('error', '?') THEN NULL ELSE CAST(value AS VARCHAR) END AS DOUBLE) AS clean_value
FROM events
""")
def f07(spark, sf):
    e = t(spark, sf, "events")
    v = F.when(F.col("event_type") == "error", F.lit("error")).otherwise(F.col("value").cast("string"))
    return e.select("event_id", S.to_number(S.sentinel_to_null(v, ("error", "?"))).alias("clean_value"))


@query("f09_date_parts", sql="""
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS od_date, hour(o_orderdate) AS od_hour,
  isodow(o_orderdate) - 1 AS od_day_of_week, month(o_orderdate) AS od_month FROM orders
""")
def f09(spark, sf):
    o = t(spark, sf, "orders")
    return o.select("o_orderkey", *[v.alias(k) for k, v in D.date_parts("o_orderdate", "od").items()])


@query("f10_month_key", sql="""
SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS n FROM orders GROUP BY 1
""")
def f10(spark, sf):
    return t(spark, sf, "orders").groupBy(D.month_key("o_orderdate").alias("month")).agg(F.count(F.lit(1)).alias("n"))


@query("f11_age_at_event", sql="""
SELECT l.l_orderkey, l.l_linenumber,
  CAST(year(l.l_shipdate) - year(o.o_orderdate) - CAST(month(l.l_shipdate) < month(o.o_orderdate) AS INTEGER) AS INTEGER) AS age_years
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
""")
def f11(spark, sf):
    o = t(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    li = t(spark, sf, "lineitem")
    return li.join(o, li.l_orderkey == o.o_orderkey).select(
        "l_orderkey", "l_linenumber", D.age_at("o_orderdate", "l_shipdate").alias("age_years"))


@query("f12_derived_measures", sql=f"""
SELECT l_orderkey, l_linenumber, {R('l_extendedprice * (1 - l_discount)', 4)} AS net,
  {R('l_extendedprice * (1 - l_discount) * (1 + l_tax)', 6)} AS gross,
  {R("CASE WHEN l_returnflag = 'R' THEN l_quantity * 1.60934 ELSE l_quantity END", 5)} AS qty_km
FROM lineitem
""")
def f12(spark, sf):
    li = t(spark, sf, "lineitem")
    unit = F.when(F.col("l_returnflag") == "R", F.lit("miles")).otherwise(F.lit("km"))
    return li.select("l_orderkey", "l_linenumber",
                     F.round(F.col("l_extendedprice") * (1 - F.col("l_discount")), 4).alias("net"),
                     F.round(F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax")), 6).alias("gross"),
                     F.round(N.miles_to_km(F.col("l_quantity"), unit), 5).alias("qty_km"))


@query("f13_guarded_division", sql=f"""
SELECT l_orderkey, l_linenumber, {R('l_tax / nullif(l_discount, 0)', 6)} AS tax_per_discount,
  {R('coalesce(l_tax / nullif(l_discount, 0), 0.0)', 6)} AS tax_per_discount_or_zero FROM lineitem
""")
def f13(spark, sf):
    li = t(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber",
                     F.round(N.safe_div("l_tax", "l_discount"), 6).alias("tax_per_discount"),
                     F.round(N.div_or_zero("l_tax", "l_discount"), 6).alias("tax_per_discount_or_zero"))


@query("f14_format_labels", sql=f"""
SELECT o_orderkey, '$' || printf('%.2f', {R('o_totalprice')}) AS amount_k,
  CASE WHEN {R('o_totalprice / 1000 - 250', 5)} > 0 THEN '+' ELSE '' END || printf('%.5f', {R('o_totalprice / 1000 - 250', 5)}) || '%' AS delta_label
FROM orders
""")
def f14(spark, sf):
    o = t(spark, sf, "orders")
    # round to the value's exact precision (o_totalprice has two decimals, so
    # /1000 has five): rounding shorter would let float noise decide ties
    k = F.round(F.col("o_totalprice"), 2)
    d = F.round(F.col("o_totalprice") / 1000 - 250, 5)
    return o.select("o_orderkey", N.money(k).alias("amount_k"),
                    N.pct_label(d, signed=True, decimals=5).alias("delta_label"))


@query("f15_split_unnest", sql="""
WITH p AS (SELECT trim(unnest(string_split(event_type || ';;' || CAST(user_id AS VARCHAR) || ';', ';'))) AS piece FROM events)
SELECT piece, count(*) AS n FROM p WHERE piece != '' GROUP BY piece
""")
def f15(spark, sf):
    e = t(spark, sf, "events")
    s = F.concat(F.col("event_type"), F.lit(";;"), F.col("user_id").cast("string"), F.lit(";"))
    p = e.select(F.explode(F.split(s, ";")).alias("piece")).select(F.trim("piece").alias("piece")) \
        .filter(F.col("piece") != "")
    return p.groupBy("piece").agg(F.count(F.lit(1)).alias("n"))


@query("f16_json_field", sql="""
SELECT CAST(json_extract(props, '$.k') AS INTEGER) AS k, count(*) AS n, round(avg(value), 4) AS avg_value
FROM events GROUP BY 1
""")
def f16(spark, sf):
    e = t(spark, sf, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    return e.groupBy(k.alias("k")).agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("value"), 4).alias("avg_value"))


@query("f16_from_json", sql="""
SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events
""")
def f16b(spark, sf):
    e = t(spark, sf, "events")
    return e.select("event_id", F.from_json("props", "k BIGINT")["k"].alias("k"))


@query("f17_normalize_text", sql=f"""
SELECT doc_id, md5(trim(regexp_replace(nfc_normalize(text), '{WS}+', ' ', 'g'))) AS norm_md5,
  length(trim(regexp_replace(nfc_normalize(text), '{WS}+', ' ', 'g'))) AS norm_len FROM documents
""")
def f17(spark, sf):
    d = t(spark, sf, "documents").withColumn("norm", TX.normalize("text"))
    return d.select("doc_id", F.md5("norm").alias("norm_md5"), F.length("norm").alias("norm_len"))


@query("f18_changed_by_nfc", sql="""
SELECT doc_id, text != nfc_normalize(text) AS changed, length(text) AS n_codepoints, strlen(text) AS n_bytes FROM documents
""")
def f18(spark, sf):
    d = t(spark, sf, "documents")
    return d.select("doc_id", TX.changed_by_nfc("text").alias("changed"), F.length("text").alias("n_codepoints"),
                    F.octet_length("text").alias("n_bytes"))


@query("f19_ascii_filter", sql="""
SELECT doc_id, md5(regexp_replace(text, '[^\\x09-\\x0D\\x20-\\x7E]', '', 'g')) AS ascii_md5 FROM documents
""")
def f19(spark, sf):
    return t(spark, sf, "documents").select("doc_id", F.md5(S.ascii_only("text")).alias("ascii_md5"))


@query("f20_redact", sql=f"""
SELECT doc_id, len(regexp_extract_all(text, '{S.EMAIL_PATTERN}')) AS n_emails,
  md5(regexp_replace(regexp_replace(text, '{S.EMAIL_PATTERN}', '[CORREO]', 'g'), '{S.URL_PATTERN}', '[URL]', 'g')) AS redacted_md5
FROM documents
""")
def f20(spark, sf):
    d = t(spark, sf, "documents")
    return d.select("doc_id", F.size(S.emails("text")).alias("n_emails"), F.md5(S.redact("text")).alias("redacted_md5"))


@query("f21_word_tokens", sql=f"""
SELECT doc_id, len({TOKENS_SQL.format('text')}) AS n_tokens,
  md5(array_to_string({TOKENS_SQL.format('text')}, ' ')) AS tokens_md5 FROM documents
""")
def f21(spark, sf):
    d = t(spark, sf, "documents").withColumn("tok", S.word_tokens("text"))
    return d.select("doc_id", F.size("tok").alias("n_tokens"), F.md5(F.array_join("tok", " ")).alias("tokens_md5"))


@query("f22_whitespace_vs_rule_tokens", sql=f"""
SELECT doc_id, len(list_filter(string_split_regex(text, '{WS}+'), lambda x: x != '')) AS n_ws_tokens,
  len({TOKENS_SQL.format('text')}) AS n_rule_tokens,
  len(list_filter(list_transform(string_split_regex(text, '[.!?]+{WS}+'), lambda x: trim(x)), lambda x: x != '')) AS n_sentences
FROM documents
""")
def f22(spark, sf):
    d = t(spark, sf, "documents")
    return d.select("doc_id", F.size(S.whitespace_tokens("text")).alias("n_ws_tokens"),
                    F.size(S.word_tokens("text")).alias("n_rule_tokens"),
                    F.size(S.sentences("text")).alias("n_sentences"))


@query("f23_bigram_counts", sql=f"""
WITH w AS (SELECT doc_id, {WORDS_SQL.format('text')} AS ws FROM documents),
b AS (SELECT ws[i] || ' ' || ws[i + 1] AS bigram FROM w, range(1, len(ws)) AS r(i))
SELECT bigram, count(*) AS n FROM b GROUP BY bigram
""")
def f23(spark, sf):
    w = t(spark, sf, "documents").select(S.words("text").alias("w"))
    d = S.explode_nonnull(w, S.word_ngrams(F.col("w"), 2), "bigram")
    return d.groupBy("bigram").agg(F.count(F.lit(1)).alias("n"))


def _rule_label_sql(col: str) -> str:
    whens = " ".join(f"WHEN regexp_matches({col}, '{p}') THEN '{lab}'" for lab, p in S.TICKET_RULES)
    return f"CASE {whens} ELSE '{S.TICKET_DEFAULT}' END"


@query("f24_rule_classifier", sql=f"""
SELECT doc_id, {_rule_label_sql('lower(text)')} AS rule_label FROM documents
""")
def f24(spark, sf):
    d = t(spark, sf, "documents")
    return d.select("doc_id", S.rule_label(F.lower("text"), S.TICKET_RULES, S.TICKET_DEFAULT).alias("rule_label"))


@query("f25_text_predicates", sql=f"""
SELECT doc_id, length(text) < 40 AS is_short, contains(text, '$') AS has_dollar, contains(text, '@') AS has_at,
  list_contains({WORDS_SQL.format('text')}, 'no') AS has_no FROM documents
""")
def f25(spark, sf):
    d = t(spark, sf, "documents")
    return d.select("doc_id", (F.length("text") < 40).alias("is_short"), F.col("text").contains("$").alias("has_dollar"),
                    F.col("text").contains("@").alias("has_at"), F.array_contains(S.words("text"), "no").alias("has_no"))


@query("f27_suspicious", sql=f"""
SELECT doc_id, regexp_matches(lower(text), '{S.SUSPICIOUS_PATTERN}') AS suspicious FROM documents
""")
def f27(spark, sf):
    return t(spark, sf, "documents").select("doc_id", S.suspicious("text").alias("suspicious"))


@query("f28_canonical_key", sql=f"""
SELECT md5(trim(lower(trim(regexp_replace(nfc_normalize(text), '{WS}+', ' ', 'g'))), ' .,:;!?¿¡"')) AS canonical_md5,
  count(*) AS n FROM documents GROUP BY 1
""")
def f28(spark, sf):
    d = t(spark, sf, "documents").select(S.canonical_key(TX.normalize("text")).alias("k"))
    return d.groupBy(F.md5("k").alias("canonical_md5")).agg(F.count(F.lit(1)).alias("n"))


def mean_vector(emb, col="embedding"):
    """Element-wise mean of an array column: one aggregate per position, bounded by the dimension."""
    pe = emb.select(F.posexplode(col).alias("pos", "x"))
    per = pe.groupBy("pos").agg(F.avg("x").alias("m"))
    return per.agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "m"))), lambda s: s["m"]).alias("mean"))


@query("f31_vector_maths", sql=f"""
WITH mv AS (SELECT list(m ORDER BY pos) AS mean FROM (
  SELECT pos, avg(x) AS m FROM (SELECT unnest(embedding) AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings) GROUP BY pos))
SELECT vec_id, {R('sqrt(list_sum(list_transform(embedding, lambda x: x * x)))', 6)} AS l2_norm,
  {R('list_dot_product(CAST(embedding AS DOUBLE[]), mv.mean) / (sqrt(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * x))) * sqrt(list_sum(list_transform(mv.mean, lambda x: x * x))))', 6)} AS cos_to_mean
FROM embeddings, mv
""")
def f31(spark, sf):
    e = t(spark, sf, "embeddings")
    # one-row side (bounded by construction): broadcast equi-join on a constant key
    mv = F.broadcast(mean_vector(e).withColumn("_one", F.lit(1)))
    j = e.withColumn("_one", F.lit(1)).join(mv, "_one")
    x = F.transform("embedding", lambda v: v.cast("double"))
    return j.select("vec_id", F.round(N.norm(x), 6).alias("l2_norm"),
                    F.round(N.cosine(x, F.col("mean")), 6).alias("cos_to_mean"))


@query("f32_softmax_per_user", sql=f"""
WITH m AS (SELECT *, exp(value / 100 - max(value / 100) OVER (PARTITION BY user_id)) AS e FROM events)
SELECT event_id, {R('e / sum(e) OVER (PARTITION BY user_id)', 9)} AS p,
  {R('1 / (1 + exp(-(value - 100) / 50))', 9)} AS sig
FROM m
""")
def f32(spark, sf):
    e = N.softmax_by(t(spark, sf, "events"), F.col("value") / 100, ["user_id"])
    return e.select("event_id", F.round("p", 9).alias("p"),
                    F.round(N.sigmoid((F.col("value") - 100) / 50), 9).alias("sig"))


@query("f33_perplexity", sql=f"""
SELECT event_type, {R('exp(avg(-ln(value / 500)))', 6)} AS perplexity,
  {R('avg(CASE WHEN value / 500 < 0.01 THEN 1.0 ELSE 0.0 END)', 6)} AS unknown_rate FROM events GROUP BY 1
""")
def f33(spark, sf):
    p = F.col("value") / 500
    return t(spark, sf, "events").groupBy("event_type").agg(
        F.round(F.exp(F.avg(-F.ln(p))), 6).alias("perplexity"),
        F.round(F.avg(F.when(p < 0.01, 1.0).otherwise(0.0)), 6).alias("unknown_rate"))


@query("f34_jaccard_turns", sql=f"""
WITH w AS (SELECT conv_id, turn, list_distinct({WORDS_SQL.format('text')}) AS ws FROM conversations),
p AS (SELECT a.conv_id, a.turn, a.ws AS wa, b.ws AS wb FROM w a JOIN w b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1)
SELECT conv_id, turn,
  {R('len(list_intersect(wa, wb)) * 1.0 / nullif(len(list_distinct(list_concat(wa, wb))), 0)', 6)} AS jaccard FROM p
""")
def f34(spark, sf):
    c = t(spark, sf, "conversations").select("conv_id", "turn", F.array_distinct(S.words("text")).alias("ws"))
    nxt = c.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("ws").alias("wb"))
    p = c.withColumnRenamed("ws", "wa").join(nxt, ["conv_id", "turn"])
    return p.select("conv_id", "turn", F.round(N.jaccard("wa", "wb"), 6).alias("jaccard"))


@query("f35_next_id", sql="""
SELECT 'Customer#' || lpad(CAST(max(TRY_CAST(substr(c_name, 10) AS BIGINT)) + 1 AS VARCHAR), 9, '0') AS next_id FROM customer
""")
def f35(spark, sf):
    c = t(spark, sf, "customer")
    return c.agg(S.padded_id("Customer#", F.max(S.id_number("c_name", 9)) + 1, 9).alias("next_id"))


@query("s12_overwrite_partitions", sql="""
SELECT year(o_orderdate) AS year, count(*) AS n,
  round(sum(CASE WHEN year(o_orderdate) = 2001 THEN 0.0 ELSE o_totalprice END), 2) AS total
FROM orders GROUP BY 1
""")
def s12(spark, sf):
    """Dynamic partition overwrite: a second write replaces only the years it contains."""
    import uuid as _uuid
    from cauce.session import scratch_path
    path = scratch_path(spark, f"s12-{_uuid.uuid4().hex}")
    o = t(spark, sf, "orders").withColumn("year", F.year("o_orderdate")).select("o_orderkey", "o_totalprice", "year")
    sinks.write_parquet(o, path, partition_by=["year"])
    latest = o.filter(F.col("year") == 2001).withColumn("o_totalprice", F.lit(0.0))
    sinks.overwrite_partitions(latest, path, ["year"])
    return spark.read.parquet(path).groupBy("year").agg(F.count(F.lit(1)).alias("n"),
                                                         F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("s23_pipeline_reload")
def s23(spark, sf):
    """Persist a fitted pipeline, reload it without fitting, compare predictions (must be equal)."""
    import uuid as _uuid
    from pyspark.ml import Pipeline, PipelineModel
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression
    from cauce.session import scratch_path
    path = scratch_path(spark, f"s23-{_uuid.uuid4().hex}")
    li = t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_extendedprice")
    model = Pipeline(stages=[VectorAssembler(inputCols=["l_quantity", "l_discount"], outputCol="features"),
                             LinearRegression(labelCol="l_extendedprice", maxIter=20)]).fit(li)
    model.write().overwrite().save(path)
    again = PipelineModel.load(path)
    a = model.transform(li).select("l_orderkey", "l_linenumber", F.col("prediction").alias("p1"))
    b = again.transform(li).select("l_orderkey", "l_linenumber", F.col("prediction").alias("p2"))
    j = a.join(b, ["l_orderkey", "l_linenumber"])
    return j.agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("p1") != F.col("p2")).alias("different"))
