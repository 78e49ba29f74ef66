import random

import pytest
from pyspark.sql import functions as F

from cauce.llm import sentencepiece_codec, token_counts
from cauce.llm.queries import QUERIES, tokenizer_path

SF = "/root/testdata/sf0.001"


def mixed_texts(n, seed):
    letters = list("aaabbthe in on  \n\t\r\x0b\x0c\x1c\x85\xa0é字🙂　'''srevdtlm0199²Ⅷ!?<|>​▁") + ["<|endoftext|>", "'re", "'ll", " the", "\n\n", "   ", "<0x0A>", "<s>", "www.", "x"]
    rng = random.Random(seed)
    return ["".join(rng.choice(letters) for _ in range(rng.randint(0, 30))) for _ in range(n)]


@pytest.fixture(scope="module")
def library():
    sentencepiece = pytest.importorskip("sentencepiece")
    return sentencepiece.SentencePieceProcessor(model_file=tokenizer_path("piece_bpe_32k.model"))


def test_pieces_are_the_librarys(library):
    use = sentencepiece_codec.Codec(tokenizer_path("piece_bpe_32k.model"))
    texts = mixed_texts(4000, 1) + [" " * k for k in range(40)] + ["a" * 300, "the " * 50, ""]
    got = [[i for w in words for i in w] for words in use.encode_batch(texts)]
    assert got == library.encode(texts)
    assert [use.decode(g) for g in got] == library.decode(got)
    assert all(use.decode(g) == t for g, t in zip(got, texts) if sentencepiece_codec.MARK not in t)


def test_forgetting_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(sentencepiece_codec, "REMEMBERED", 50)
    use = sentencepiece_codec.Codec(tokenizer_path("piece_bpe_32k.model"))
    for seed in range(5):
        texts = mixed_texts(60, seed)
        assert [[i for w in words for i in w] for words in use.encode_batch(texts)] == library.encode(texts)


def test_encode_query_and_round_trip(spark, library):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    rows = QUERIES["op7_sentencepiece"](spark, SF).collect()
    assert len(rows) == len(texts) and all(r.round_trip and r.ids == library.encode(texts[r.doc_id]) and r.n_pieces == len(r.ids) for r in rows)


def test_encode_cases(small, empty):
    model = tokenizer_path("piece_bpe_32k.model")
    out = sentencepiece_codec.encode(small, model)
    assert out.count() == small.count() and all(r.round_trip for r in out.collect())
    back = {(r.doc_id, r.text) for r in sentencepiece_codec.decode(out, model).collect()}
    assert back == {(r.doc_id, r.text or "") for r in small.collect()}
    rows = sentencepiece_codec.encode_rows(small, model)
    assert rows.columns == [*small.columns, "ids"] and rows.count() == small.count()
    assert sentencepiece_codec.encode(empty, model).count() == 0 and sentencepiece_codec.encode_rows(empty, model).count() == 0


@pytest.fixture(scope="module")
def tokenizer():
    tokenizers = pytest.importorskip("tokenizers")
    return tokenizers.Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))


def lengths(tokenizer, texts):
    return [len(e.ids) for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_counts_are_the_librarys(tokenizer):
    use = token_counts.Counter(tokenizer_path("byte_bpe_50k.json"))
    texts = mixed_texts(4000, 2) + ["", "a" * 400, " " * 30]
    assert use.count_batch(texts) == lengths(tokenizer, texts)


def test_every_prefix_count_is_the_librarys(tokenizer):
    use = token_counts.Counter(tokenizer_path("byte_bpe_50k.json"))
    for t in mixed_texts(300, 3):
        assert use.prefix_counts(t) == lengths(tokenizer, [t[:i] for i in range(len(t) + 1)])


def test_count_query(spark, tokenizer):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    rows = QUERIES["op8_token_counts"](spark, SF).collect()
    assert [r.n_tokens for r in rows] == lengths(tokenizer, [texts[r.doc_id] for r in rows])
    assert all(r.over_limit == (r.n_tokens > 1024) and r.n_bytes == len(texts[r.doc_id].encode()) for r in rows)


def test_budget_questions(small, empty, tokenizer):
    path = tokenizer_path("byte_bpe_50k.json")
    rows = token_counts.prefix_counts(small, path).select("counts", token_counts.count_at("counts", 12).alias("at"), token_counts.longest_prefix("counts", 5).alias("fits"))
    for r in rows.collect():
        assert r["at"] == r["counts"][min(12, len(r["counts"]) - 1)]
        assert r["counts"][r["fits"]] <= 5 and all(n > 5 for n in r["counts"][r["fits"] + 1:])
    assert token_counts.token_counts(empty, path).count() == 0
    got = token_counts.token_counts(small, path).where(F.col("doc_id").isin(3, 4)).collect()
    assert {(r.n_bytes, r.n_tokens, r.over_limit) for r in got} == {(0, 0, False)}
