import hashlib
import random
import re

import pytest

from cauce.llm import pii, secrets


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def plain_pii(t):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m[0].split("."))]
    for kind, pattern, ok in (("card", r"[0-9]([\x20-]?[0-9])+", lambda d: 16 <= len(d) <= 19 and luhn(d)), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda d: 8 <= len(d) <= 15)):
        out += [(kind, *m.span()) for m in re.finditer(pattern, t) if ok(re.sub("[^0-9]", "", m[0]))]
    return out


def plain_secrets(t):
    out = [(m.start(), 0, m.end(), "assign") for m in re.finditer(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", t) if len(m[1]) >= 6]
    out += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
    return [(k, a, e) for a, _, e, k in sorted(out)]


def digest(spans):
    return hashlib.sha256(",".join(f"{k}:{a}:{e}" for k, a, e in spans).encode()).hexdigest()


@pytest.fixture(scope="module")
def noisy(spark):
    rng = random.Random(5)
    personal = list("ab@.. ..1234567890-+()é🙂_%") + ["4111111111111111", "4111 1111 1111 1111", "x@y.zz", "1.2.3.4", "255.256.1.1", " +1 (705) 555-6638", "123-45-6789"]
    hidden = list("ab01 :='\"_-/") + ["password", "TOKEN", "api_key", "apikey", "secret", "AKIA", "ABCDEFGH1234", "abcdef0123456789", "deadbeef00", "="]
    rows = [(i, "".join(rng.choice(personal if i % 2 else hidden) for _ in range(rng.randint(0, 40))), f"s{i % 7}") for i in range(1500)]
    return {r[0]: r[1] for r in rows}, spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)


def test_pii_base_spans(noisy):
    texts, docs = noisy
    rows = pii.digest(pii.personal_data(docs)).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = plain_pii(texts[r.doc_id])
        assert r.base_sha256 == digest(want), texts[r.doc_id]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[0] == k for s in want) for k in pii.BASE]


def test_pii_learns_beyond_the_patterns(spark):
    rows = [(i, f"please call phone +1 (705) 555-{1000 + i} now" if i % 2 else f"phone (705) 555-{1000 + i} call") for i in range(200)]
    rows += [(900, "call tel (212) 555-0100 phone")]
    out = {r.doc_id: r for r in pii.digest(pii.personal_data(spark.createDataFrame(rows, "doc_id long, text string"))).collect()}
    assert out[900].spans == "phone_local:9:23" and out[900].n_phone == 0 and out[900].base_sha256 == digest([])


def test_secrets_base_spans(noisy):
    texts, docs = noisy
    for r in secrets.digest(secrets.secrets(docs)).collect():
        want = plain_secrets(texts[r.doc_id])
        assert r.base_sha256 == digest(want), texts[r.doc_id]
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(s[0] == k for s in want) for k in secrets.BASE]


def test_copied_and_live_secrets(spark):
    key = "ghp_a1B2c3D4e5F6g7H8i9J0"
    rows = [(i, f"use {key} here", f"owner{i}") for i in range(50)] + [(100, "use ghp_Zz9Yy8Xx7Ww6Vv5Uu4Tt here", "owner1")]
    out = {r.doc_id: r for r in secrets.digest(secrets.secrets(spark.createDataFrame(rows, "doc_id long, text string, source string"))).collect()}
    assert out[3].spans == "" and (out[3].n_live, out[3].n_copied) == (0, 1)
    assert out[100].spans == "issued:4:28" and (out[100].n_live, out[100].n_copied) == (1, 0)


def test_span_cases(small, empty):
    for run in (lambda d: pii.digest(pii.personal_data(d)), lambda d: secrets.digest(secrets.secrets(d))):
        assert run(small).count() == small.count()
        assert run(empty).count() == 0
    got = [r.spans for r in pii.digest(pii.personal_data(small)).where("doc_id = 7").collect()]
    assert sorted(got) == ["", "email:5:18,ip:64:72,card:43:62,phone:22:39"]


def test_long_runs_do_not_stall(spark):
    rows = [(1, "a" * 200_000 + "1" * 200_000, "s"), (2, "a@b" + ".c" * 20_000, "s"), (3, "token " * 30_000, "s"), (4, "1.2.3.4 " * 2000, "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.doc_id: r for r in pii.digest(pii.personal_data(docs)).collect()}
    assert got[2].n_email == 1 and got[4].n_ip == 2000 and got[1].n_card == 0
    assert secrets.digest(secrets.secrets(docs)).count() == 4


def test_every_pattern_takes_long_texts(spark):
    """Long texts of the pieces of each pattern: no deep recursion, no long backtracking, all spans."""
    pieces = ["x (at) y" + ".z" * 100_000, "a" * 150_000 + " b (at) c.d", "b [at] c [dot] d " * 600, "m@n.oo " * 3_000, "(705) 555-6638 " * 600,
              "123-45-6789 " * 600, "DE12 " + "ABCD " * 40_000, "Dr. Anna Lee " * 600, "+1 705 555 6638 " * 1_200, "4111 1111 1111 1111, " * 900]
    docs = spark.createDataFrame([(i, t, "s") for i, t in enumerate(pieces)], "doc_id long, text string, source string").repartition(4)
    got = {r.doc_id: r for r in pii.candidates(docs).select("doc_id", "base", "cand").collect()}
    spoken = [(c.start, c.end) for c in got[0].cand if c.kind == "email_spoken"]
    assert spoken == [(0, len(pieces[0]))] and [c.end for c in got[1].cand] == [len(pieces[1])]
    assert [c.start for c in got[2].cand] == list(range(0, len(pieces[2]), 17))
    assert [(s.start, s.end) for s in got[3].base] == [(7 * i, 7 * i + 6) for i in range(3_000)]
    assert len(got[8].base) == 1_200 and len(got[9].base) == 900
    assert secrets.digest(secrets.secrets(docs)).count() == len(pieces)


def test_entropy_of_the_whole_value(spark):
    rng = random.Random(3)
    key = "".join(rng.choice("abcdefghijkmnpqrstuvwxyzABCDEFGHJKLMNPQRSTUVWXYZ23456789") for _ in range(300))
    rows = [(1, "use ghp_" + "A" * 220 + key, "o1"), (2, "use ghp_" + "A" * 230 + "1b", "o2")]
    out = {r.doc_id: r for r in secrets.digest(secrets.secrets(spark.createDataFrame(rows, "doc_id long, text string, source string"))).collect()}
    assert out[1].spans == "issued:4:528" and out[2].spans == ""
