"""Text fixtures and metric toys with the reference's rendered values."""

import math
import unicodedata

import pytest
from pyspark.sql import functions as F

from cauce.functions import numeric as N
from cauce.functions import strings as S
from cauce.functions import text as TX
from cauce.operators import corpus as C
from cauce.operators import metrics as MT
from cauce.operators import retrieval as RT


def test_nfc_composes(spark):
    raw = "contrasen" + "̃" + "a"
    df = spark.createDataFrame([(raw,)], "t string")
    r = df.select(TX.nfc("t").alias("n"), F.length("t").alias("l0"), F.length(TX.nfc("t")).alias("l1"),
                  TX.changed_by_nfc("t").alias("ch")).first()
    assert r["n"] == "contraseña" and (r["l0"], r["l1"]) == (11, 10) and r["ch"]


def test_normalize_keeps_case_accents(spark):
    df = spark.createDataFrame([("  No   quiero cancelar.  ",), ("sí",), ("si",)], "t string")
    out = [r[0] for r in df.select(TX.normalize("t")).collect()]
    assert out == ["No quiero cancelar.", "sí", "si"]


def test_redaction(spark):
    df = spark.createDataFrame([("Escríbeme a persona@example.invalid",), ("ver https://x.org/a y www.y.com",)], "t string")
    out = [r[0] for r in df.select(S.redact("t")).collect()]
    assert out == ["Escríbeme a [CORREO]", "ver [URL] y [URL]"]


def test_cleaning_cases_equal_nfc(spark):
    cases = ["No, no quiero", "Espera...¡ya!", "a@b.co", "café", "NO", "ke onda"]
    df = spark.createDataFrame([(c,) for c in cases], "t string")
    out = [r[0] for r in df.select(TX.normalize("t")).collect()]
    assert out == [unicodedata.normalize("NFC", c) for c in cases]


def test_tfidf_toy(spark):
    docs = spark.createDataFrame([(0, "pago pago cuenta"), (1, "pago tarjeta"), (2, "cuenta bloqueada")], "id int, text string")
    post = C.term_counts(docs, "id", "text")
    counts = {(r["id"], r["term"]): r["tf"] for r in post.collect()}
    vocab = sorted({t for _, t in counts})
    assert vocab == ["bloqueada", "cuenta", "pago", "tarjeta"]
    assert [[counts.get((i, t), 0) for t in vocab] for i in range(3)] == [[0, 1, 2, 0], [0, 0, 1, 1], [1, 1, 0, 0]]
    idf = {r["term"]: r["idf"] for r in C.fit_idf(post, 3).collect()}
    assert idf["pago"] == pytest.approx(math.log(4 / 3) + 1)
    w = {(r["id"], r["term"]): r["weight"] for r in C.tfidf(post, C.fit_idf(post, 3)).collect()}
    row0 = [round(w.get((0, t), 0.0), 6) for t in vocab]
    assert row0 == [0.0, 0.447214, 0.894427, 0.0]


def test_ngrams_order_sensitivity(spark):
    df = spark.createDataFrame([("pago cuenta bloqueada",), ("cuenta pago bloqueada",)], "t string")
    r = df.select(F.array_sort(S.words("t")).alias("u"), S.word_ngrams(S.words("t"), 2).alias("b"),
                  TX.ngrams(S.words("t"), 2).alias("b2")).collect()
    assert r[0]["u"] == r[1]["u"] and r[0]["b"] != r[1]["b"]
    assert r[0]["b"] == r[0]["b2"] == ["pago cuenta", "cuenta bloqueada"]


def test_oov_terms(spark):
    train = spark.createDataFrame([(0, "mi contraseña falla")], "id int, text string")
    other = spark.createDataFrame([(1, "hiperfoliozeta contraseña"), (2, "hiperfoliozeta")], "id int, text string")
    idf = C.fit_idf(C.term_counts(train, "id", "text"), 1)
    w = C.tfidf(C.term_counts(other, "id", "text"), idf)
    assert {r["id"] for r in w.collect()} == {1}            # doc 2 is all OOV: zero vector
    assert {r["term"] for r in C.oov_terms(C.term_counts(other, "id", "text"), idf).collect()} == {"hiperfoliozeta"}


def test_rule_spans(spark):
    df = spark.createDataFrame([("La aplicación AulaPro falla; el folio es INC-1001.",)], "t string")
    spans = df.select(TX.regex_spans(F.col("t")).alias("s")).first()["s"]
    assert [(s["start"], s["end"], s["label"]) for s in spans] == [(14, 21, "PRODUCTO"), (41, 49, "FOLIO")]


def test_bio_tags(spark):
    df = spark.createDataFrame([("El folio INC-1001 y AulaPro",)], "t string")
    r = df.select(TX.token_offsets(F.col("t")).alias("tok"), TX.regex_spans(F.col("t")).alias("sp"))
    tags = r.select(TX.bio_tags(F.col("tok"), F.col("sp"))).first()[0]
    assert tags == ["O", "O", "B-FOLIO", "I-FOLIO", "I-FOLIO", "O", "B-PRODUCTO"]


def test_span_scoring(spark):
    gold = spark.createDataFrame([(1, 8, 15, "FOLIO")], "doc_id int, start int, end int, label string")
    pred = spark.createDataFrame([(1, 8, 14, "FOLIO")], "doc_id int, start int, end int, label string")
    r = RT.span_scores(gold, pred).first()
    assert (r["tp"], r["fp"], r["fn"], r["f1"]) == (0, 1, 1, 0.0)


def test_chunking_offsets(spark):
    text = " ".join(f"w{i}" for i in range(50)) + "  fin."
    df = spark.createDataFrame([(text,)], "t string")
    ch = df.select(F.explode(TX.chunk_offsets(F.col("t"), 18, 4)).alias("c")).select("c.*").collect()
    assert [c["chunk_index"] for c in ch] == [0, 14, 28, 42]
    for c in ch:
        piece = text[c["start"]:c["end"]]
        assert not piece.startswith(" ") and not piece.endswith(" ")
    assert ch[-1]["end"] == len(text)


def test_cosine_and_scale_invariance(spark):
    df = spark.createDataFrame([([1.0, 0.0], [1.0, 1.0], [10.0, 10.0])], "a array<double>, b array<double>, c array<double>")
    r = df.select(N.cosine("a", "b").alias("x"), N.cosine("a", "c").alias("y")).first()
    assert round(r["x"], 5) == 0.70711 and r["x"] == pytest.approx(r["y"])


def test_perplexity(spark):
    df = spark.createDataFrame([(0.5,), (0.25,)], "p double")
    assert df.agg(F.exp(F.avg(-F.ln("p")))).first()[0] == pytest.approx(math.sqrt(8))


def test_confusion_toy(spark):
    rows = [(0, 0)] * 8 + [(0, 1)] * 2 + [(1, 0)] * 4 + [(1, 1)] * 6
    df = spark.createDataFrame(rows, "actual int, predicted int")
    cm = {r["actual"]: (r["0"], r["1"]) for r in MT.confusion(df, "actual", "predicted", [0, 1]).collect()}
    assert cm == {0: (8, 2), 1: (4, 6)}
    rep = {r["class"]: r for r in MT.class_report(df, "actual", "predicted").collect()}
    assert rep[1]["precision"] == pytest.approx(0.75) and rep[1]["recall"] == pytest.approx(0.60)
    assert rep[0]["f1"] == pytest.approx(0.727273, abs=1e-6) and rep[1]["f1"] == pytest.approx(0.666667, abs=1e-6)
    s = MT.summary_scores(MT.class_report(df, "actual", "predicted"), df, "actual", "predicted").first()
    assert s["accuracy"] == pytest.approx(0.70) and s["macro_f1"] == pytest.approx(0.696970, abs=1e-6)


def test_summary_scores_of_counts_whose_products_outgrow_a_long(spark):
    n = 200_000
    df = spark.range(n).select((F.col("id") % 2).cast("int").alias("actual"),
                               F.when(F.col("id") % 10 == 0, 1 - F.col("id") % 2).otherwise(F.col("id") % 2).cast("int").alias("predicted"))
    s = MT.summary_scores(MT.class_report(df, "actual", "predicted"), df, "actual", "predicted").first()
    # even ids are wrong where they end in 0: 80,000 of 100,000 zeros and all ones are right
    assert s["accuracy"] == pytest.approx(0.9) and s["kappa"] == pytest.approx(0.8)
    assert s["mcc"] == pytest.approx((0.9 * n * n - 0.5 * n * n) / math.sqrt((n * n - (0.16 + 0.36) * n * n) * 0.5 * n * n))


def test_confusion_zero_fills_missing_class(spark):
    df = spark.createDataFrame([(0, 0), (0, 1)], "actual int, predicted int")
    cm = {r["actual"]: (r["0"], r["1"]) for r in MT.confusion(df, "actual", "predicted", [0, 1]).collect()}
    assert cm == {0: (1, 1), 1: (0, 0)}


def test_leakage_detector_fires(spark):
    rows = [(i, f"texto numero {i}", i % 2, f"fam{i // 3}") for i in range(30)]
    df = spark.createDataFrame(rows, "id int, text string, label int, family string")
    split = C.family_split(df, "family")
    C.assert_split_ok(C.split_violations(split, "id", "text", "family", "label"))
    # controlled contamination: move one row of a train family to test
    fam = split.filter("split = 'train'").first()["family"]
    victim = split.filter(F.col("family") == fam).first()["id"]
    bad = split.withColumn("split", F.when(F.col("id") == victim, F.lit("test")).otherwise(F.col("split")))
    with pytest.raises(ValueError):
        C.assert_split_ok(C.split_violations(bad, "id", "text", "family", "label"))


def test_family_split_sizes(spark):
    rows = [(i, f"t{i}", 0, f"fam{i % 20}") for i in range(200)]
    df = spark.createDataFrame(rows, "id int, text string, label int, family string")
    fams = C.family_split(df, "family").groupBy("split").agg(F.count_distinct("family").alias("f")).collect()
    assert {r["split"]: r["f"] for r in fams} == {"train": 14, "validation": 3, "test": 3}


def test_prepare_decisions(spark):
    rows = [(1, "Texto original uno", 1), (2, "Texto  original uno", 1), (3, "corto", 1), (4, None, 1),
            (5, "Otro texto suficiente", None)]
    df = spark.createDataFrame(rows, "id int, text string, label int")
    reg = {r["id_original"]: (r["state"], r["reason"], r["equivalent_id"])
           for r in C.decision_register(C.prepare(df, "id", "text", "label"), "id").collect()}
    assert reg == {1: ("conservar", "ok", None), 2: ("duplicado", "clave ya vista", 1),
                   3: ("cuarentena", "texto insuficiente", None), 4: ("cuarentena", "texto ausente", None),
                   5: ("cuarentena", "etiqueta ausente", None)}


def test_threshold_ties_prefer_larger(spark):
    df = spark.createDataFrame([(0.2, False), (0.8, True)], "score double, positive boolean")
    r = RT.best_threshold(df).first()
    assert r["balanced_accuracy"] == 1.0 and r["threshold"] == pytest.approx(0.5)


def test_topk_sparse_chunking_is_exact(spark):
    docs = spark.createDataFrame([(i, f"pago cuenta {'tarjeta ' * (i % 3)}bloqueada doc{i}") for i in range(40)],
                                 "id long, text string")
    qs = spark.createDataFrame([(100 + j, f"pago {'cuenta ' * j}tarjeta") for j in range(6)], "id long, text string")
    post = C.term_counts(docs, "id", "text", ngram_max=2)
    idf = C.fit_idf(post, 40)
    dw, qw = C.tfidf(post, idf), C.tfidf(C.term_counts(qs, "id", "text", ngram_max=2), idf)
    whole = RT.topk_sparse(spark, dw, qw, 3)
    split = RT.topk_sparse(spark, dw, qw, 3, max_queries=2, max_postings=4)
    key = lambda d: sorted((r["qid"], r["rank"], r["item_id"], round(r["score"], 9)) for r in d.collect())
    assert key(whole) == key(split) and len(key(whole)) == 18


def test_text_helpers_build_arrays_part_by_part(spark, monkeypatch):
    import pyarrow as pa
    texts = [None, "", "cafe\u0301 a@b.com", "plain words", "\U0001F600 x\u0303 y", None, "1234567812345678 end"] * 5
    seen = []
    out = TX._in_parts(pa.array(texts + ["z" * TX.PART_BYTES] * 3), lambda p: seen.append(len(p)) or TX._nfc_part(p))
    assert len(seen) > 2 and max(seen) < len(texts) + 3
    assert out.to_pylist() == [x if x is None else unicodedata.normalize("NFC", x) for x in texts] + ["z" * TX.PART_BYTES] * 3
    d = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    rules = (("MAIL", r"\w+@\w+[.]com"), ("CARD", r"\b\d{16}\b"))
    got = {r.id: r for r in d.select("id", TX.nfc("text").alias("n"), TX.regex_spans("text", rules).alias("s"),
                                     TX.token_offsets("text").alias("t"), TX.chunk_offsets("text", 1, 0).alias("c")).collect()}
    assert got[0].n is None and got[0].s is None and got[0].t is None and got[0].c is None
    assert got[1].n == "" and got[1].s == [] and got[1].t == [] and got[1].c == []
    assert [tuple(x) for x in got[2].s] == [(6, 13, "MAIL")] and [tuple(x) for x in got[6].s] == [(0, 16, "CARD")]
    assert [x.token for x in got[3].t] == ["plain", "words"] and [tuple(x) for x in got[3].c] == [(0, 0, 5), (1, 6, 11)]
