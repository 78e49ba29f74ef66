import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cauce.llm import calibration, decontaminate, near_dedup, quality_classifier, toxicity
from cauce.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def plain_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_band_is_the_edit_distance():
    rng = random.Random(1)
    for _ in range(4000):
        a = [rng.choice("abcd") for _ in range(rng.randint(0, 14))]
        b = list(a) if rng.random() < 0.5 else [rng.choice("abcd") for _ in range(rng.randint(0, 14))]
        for _ in range(rng.randint(0, 4)):
            at = rng.randint(0, len(b))
            b[at:at + rng.randint(0, 1)] = [rng.choice("abcd")] * rng.randint(0, 1)
        most, want = rng.randint(0, 6), plain_distance(a, b)
        assert near_dedup.edit_distance(a, b, most) == (want if want <= most else None)


def test_elements_are_labelled_and_ordered():
    words = b"a b c d e a b c d e f".split()
    e = near_dedup.elements(words)
    assert len(e) == 7 and len(set(e)) == 7  # a run that comes twice has two labels
    assert near_dedup.elements(words)[0] == near_dedup.elements(words[:5])[0]
    first = near_dedup.sketches(b"a b c d e f".split(), near_dedup.MULTIPLIERS[:1])
    assert (first == near_dedup.sketches(b"a b c d e f".split(), near_dedup.MULTIPLIERS[:1])).all()


def family(rng, words, n, edits):
    base = [rng.choice(words) for _ in range(rng.randint(60, 200))]
    out = [base]
    for _ in range(n - 1):
        copy = list(base)
        for _ in range(max(1, int(edits * len(copy)))):
            copy[rng.randrange(len(copy))] = rng.choice(words)
        out.append(copy)
    return [" ".join(x) for x in out]


def brute_classes(rows):
    parent = {i: i for i in range(len(rows))}

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    cut = [(t or "").split() for _, t in rows]
    for i in range(len(rows)):
        for j in range(i):
            n = max(len(cut[i]), len(cut[j]))
            if abs(len(cut[i]) - len(cut[j])) <= 0.2 * n and top(i) != top(j) and near_dedup.edit_distance(cut[i], cut[j], int(0.2 * n + 1e-9)) is not None:
                parent[max(top(i), top(j))] = min(top(i), top(j))
    least = {}
    for i, (d, _) in enumerate(rows):
        least[top(i)] = min(least.get(top(i), d), d)
    return {d: least[top(i)] for i, (d, _) in enumerate(rows)}


def test_classes_against_brute_force(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(3000)]
    passage = " ".join(rng.choice(words) for _ in range(60))
    texts = [t for k in range(25) for t in family(rng, words, rng.choice([1, 2, 5, 12]), rng.choice([0.01, 0.03, 0.06]))]
    texts += [passage + " " + " ".join(rng.choice(words) for _ in range(120)) for _ in range(40)]  # a passage is no copy
    texts += texts[:10] + ["", "", "one two", "one  two"]
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r.doc_id: r.class_id for r in near_dedup.labelled(docs).collect()}
    want = brute_classes(sorted(rows))
    assert got == want
    kept = {r.doc_id for r in near_dedup.keep_one(docs).collect()}
    assert kept == set(want.values())


def test_short_texts_against_brute_force(spark):
    """Among texts of at most SHORT words no near pair is lost."""
    rng = random.Random(17)
    words = [f"w{i}" for i in range(400)]
    texts = []
    for _ in range(150):
        base = [rng.choice(words) for _ in range(rng.randint(1, near_dedup.SHORT))]
        copy = list(base)
        for _ in range(near_dedup.allowed(len(base))):
            at = rng.randrange(len(copy))
            copy[at:at + rng.randint(0, 1)] = [rng.choice(words)] * rng.randint(0, 1)
        texts += [" ".join(base), " ".join(copy[:near_dedup.SHORT])]
    texts += ["a b c d", "a b c d e", "a b c", "", "  "]
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert {r.doc_id: r.class_id for r in near_dedup.labelled(docs).collect()} == brute_classes(rows)


@pytest.mark.parametrize("n, edits, least", [(6, 0.19, 1.0), (12, 0.19, 1.0), (30, 0.1, 0.97), (100, 0.15, 0.95), (100, 0.19, 0.8), (300, 0.19, 0.85)])
def test_recall_of_candidates(n, edits, least):
    rng = random.Random(n)
    words = [b"w%d" % i for i in range(3000)]
    found = 0
    for _ in range(100):
        a = [rng.choice(words) for _ in range(n)]
        b = list(a)
        for at in rng.sample(range(n), int(edits * n)):
            b[at] = rng.choice(words)
        found += not set(near_dedup.candidate_values(a).tolist()).isdisjoint(near_dedup.candidate_values(b).tolist())
    assert found >= least * 100


def template_pairs(rng, words, n, shared, own, edits):
    passage = [rng.choice(words) for _ in range(shared)]
    out = []
    for _ in range(n):
        text = passage + [rng.choice(words) for _ in range(own)]
        copy = [rng.choice(words) if rng.random() < edits else w for w in text]
        out += [" ".join(text), " ".join(copy)]
    return out


def test_pairs_that_share_a_passage(spark, monkeypatch):
    """Every pair of copies is found though all texts meet in the values of the passage, also when a value has many parts."""
    rng = random.Random(11)
    words = [f"w{i}" for i in range(4000)]
    texts = template_pairs(rng, words, 40, 150, 60, 0.08) + template_pairs(rng, words, 40, 100, 100, 0.08)
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    want = brute_classes(sorted(rows))
    assert len(set(want.values())) == 80
    for cell in (near_dedup.CELL, 16):
        monkeypatch.setattr(near_dedup, "CELL", cell)
        assert {r.doc_id: r.class_id for r in near_dedup.labelled(docs).collect()} == want


def test_bags_bound_the_distance():
    """Cells leave out only pairs that are not near."""
    rng = random.Random(12)
    texts = [[b"%d" % rng.randrange(30) for _ in range(rng.randint(0, 25))] for _ in range(61)]
    texts += [[w for w in t if rng.random() < 0.9] for t in texts]
    rows = [(i, i, i % 2, [7], b" ".join(t).decode()) for i, t in enumerate(texts)]
    got = {(max(p), min(p)) for p in near_dedup.open_pairs(7, rows, texts)}
    near = {(i, j) for i, a in enumerate(texts) for j, b in enumerate(texts[:i]) if i % 2 != j % 2
            and near_dedup.edit_distance(a, b, int(0.2 * max(len(a), len(b)) + 1e-9)) is not None}
    assert near and near <= got
    # links join the same classes as all near pairs, and are fewer than the members
    links = near_dedup.cell_links(7, rows)
    assert set(links) <= near and len(links) < len(rows) and joined(links) == joined(near)
    # a pair that shares a smaller value is tested there
    both = [(*r[:3], [3, 7] if r[0] < 10 else [7], r[4]) for r in rows]
    left = {(max(p), min(p)) for p in near_dedup.open_pairs(7, both, texts)}
    assert left == {p for p in got if p[0] >= 10}


def joined(pairs):
    """Classes of the ids in ``pairs``."""
    root = {}
    def top(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x
    for a, b in pairs:
        root[max(top(a), top(b))] = min(top(a), top(b))
    return {x: top(x) for x in list(root)}


def test_near_cases(small, empty):
    rows = near_dedup.labelled(small).collect()
    assert len(rows) == small.count()
    by_id = {r.doc_id: r.class_id for r in rows if r.doc_id not in (None, 7)}
    assert by_id[3] == by_id[4] == 3 and by_id[5] == by_id[6] == 5 and by_id[1] == 1
    kept = near_dedup.keep_one(small)
    assert kept.columns == small.columns
    assert kept.where("doc_id = 1").count() == 1 and kept.where("doc_id in (4, 6)").count() == 0
    assert near_dedup.labelled(empty).count() == 0 and near_dedup.keep_one(empty).count() == 0


def test_components_of_a_long_path(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 501), (501, 500)], "a long, b long")
    got = {r.node: r["class"] for r in near_dedup.components(links).collect()}
    assert got == {i: 0 for i in range(201)} | {500: 500, 501: 500}


@pytest.fixture(scope="module")
def items(spark):
    rng = random.Random(7)
    words = [f"t{i}" for i in range(5000)]
    texts = [" ".join(rng.choice(words) if rng.random() < 0.6 else rng.choice("the of and to in".split()) for _ in range(rng.randint(15, 150))) for _ in range(30)]
    return rng, words, texts, spark.createDataFrame(list(enumerate(texts)) + [(100, None), (101, "...")], "item_id long, text string")


def test_leaks_are_found_and_others_left(spark, items):
    rng, words, texts, benchmark = items
    filler = lambda n: " ".join(rng.choice(words) if rng.random() < 0.6 else rng.choice("the of and to in".split()) for _ in range(n))
    rows, want = [], set()
    for i, t in enumerate(texts):
        rows.append((i, f"{filler(rng.randint(0, 300))} {t.upper().replace(' ', ', ', 3)} {filler(rng.randint(0, 300))}"))
        want.add((i, i))
        loose = [rng.choice(words) if rng.random() < 0.1 else w for w in t.split()]
        rows.append((1000 + i, filler(100) + " " + " ".join(loose) + " " + filler(100)))
        want.add((1000 + i, i))
    rows += [(2000 + i, filler(400)) for i in range(200)] + [(3000, None), (3001, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, benchmark).collect()}
    assert {p for p in got if p[0] < 1000} == {p for p in want if p[0] < 1000}
    assert got <= want and len(got) >= 0.95 * len(want)
    assert {r.doc_id for r in decontaminate.keep_clean(docs, benchmark).collect()} == {d for d, _ in rows} - {d for d, _ in got}


def test_search_recall_against_brute_force(spark):
    """Candidates by latent cosine hold nearly all pairs that exact verification of every window finds."""
    index = next(decontaminate.indexes(spark.read.parquet(f"{SF}/benchmark.parquet")))
    found = every = 0
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        terms = decontaminate.terms_of(r.text)
        own = index.hits(r.text)
        for k, passage in enumerate(index.texts):
            if decontaminate.common_words(passage, terms) >= decontaminate.VERBATIM * len(passage) and any(
                    decontaminate.common_words(passage, terms[s:s + 2 * len(passage)]) >= decontaminate.VERBATIM * len(passage) for s in range(0, len(terms), 8)):
                every += 1
                found += index.items[k] in own
    assert every and found >= 0.9 * every


def test_blocks_of_a_large_benchmark(spark, items, monkeypatch):
    _, _, texts, benchmark = items
    monkeypatch.setattr(decontaminate, "BLOCK", 16)
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, benchmark).collect()}
    assert got == {(i, i) for i in range(len(texts))}


def test_recall_of_edited_copies_in_a_large_benchmark(spark):
    """Copies with a fifth to a third of their words replaced are found as well among 700 passages as among 100."""
    rng = random.Random(13)
    words, odds = [f"z{i}" for i in range(20000)], [1 / (i + 3) for i in range(20000)]
    draw = lambda n: rng.choices(words, odds, k=n)
    texts = [draw(rng.randint(15, 59)) for _ in range(700)]
    copies = []
    for t in texts:
        gone = set(rng.sample(range(len(t)), int(rng.uniform(0.2, 0.35) * len(t))))
        copies.append([draw(1)[0] if i in gone else w for i, w in enumerate(t)])
    share = {}
    for n in (100, 700):
        benchmark = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts[:n])], "item_id long, text string")
        built = list(decontaminate.indexes(benchmark))
        assert sum(len(x.texts) for x in built) == n
        assert all(np.allclose(np.linalg.norm(x.latent, axis=1), 1, atol=1e-3) for x in built)  # nothing is lost to the rank
        found = every = 0
        for i in range(0, n, n // 100):
            p, c = ([w.encode() for w in x] for x in (texts[i], copies[i]))
            common = decontaminate.common_words(p, c)
            if common >= 0.8 * len(p) or common >= 0.6 * len(p) and decontaminate.answered(p, c):
                every += 1
                doc = " ".join(draw(90) + copies[i] + draw(90))
                found += any(i in x.hits(doc) for x in built)
        share[n] = found / every
    assert share[700] >= 0.95


def test_decontamination_cases(spark, small, empty, items):
    benchmark = items[3]
    assert decontaminate.contaminated(small, benchmark).count() == 0
    assert decontaminate.keep_clean(small, benchmark).count() == small.count()
    assert decontaminate.contaminated(empty, benchmark).count() == 0
    assert decontaminate.contaminated(small, benchmark.where("1 = 0")).count() == 0
    assert decontaminate.keep_clean(small, benchmark.where("1 = 0")).columns == small.columns


def auc(rows):
    pos, neg = ([r.score for r in rows if r.label == v] for v in (1.0, 0.0))
    return np.mean([(p > n) + 0.5 * (p == n) for p in pos for n in neg])


def test_quality_held_out(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", F.col("quality").cast("double").alias("label"))
    rows = QUERIES["op6_quality_classifier"](spark, sf).join(labels, "doc_id").where("held_out").collect()
    assert len(rows) > 50 and auc(rows) > 0.95
    assert np.mean([r.predicted == r.label for r in rows]) > 0.95


def test_scores_ignore_held_out_labels_and_columns(spark, small, empty):
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(1, 9)] + [(1, None, 1), (None, 1, 1)], "doc_id long, quality int, toxic int")
    teach = lambda folds, fold: labels.where(~(F.crc32(F.col("doc_id").cast("string")) % folds == fold))
    for run, folds, fold in ((quality_classifier.quality, 3, 1), (toxicity.toxicity, 4, 2)):
        rows = sorted(map(str, run(small, labels).collect()))
        assert len(rows) == small.count()
        assert rows == sorted(map(str, run(small.drop("source"), teach(folds, fold)).collect()))
        assert run(empty, labels).count() == 0
        assert {r.score for r in run(small, labels.where("1 = 0")).collect()} == {0.5}


def test_isotonic_pools():
    xs, ys = calibration.isotonic([(0.0, 10, 1), (1.0, 10, 5), (2.0, 10, 3), (3.0, 10, 9)])
    assert list(xs) == [0.0, 1.5, 3.0] and (np.diff(ys) > 0).all()
    assert (np.diff(calibration.chance(np.linspace(-5, 8, 50), (xs, ys))) >= 0).all()
    assert calibration.chance(np.zeros(2), calibration.isotonic([])).tolist() == [0.5, 0.5]


@pytest.fixture(scope="module")
def insults(spark):
    rng = random.Random(9)
    words = [a + b for a in "ba be bi bo bu ka ke ki ko ku".split() for b in "ra re ri ro ru na ne ni".split()]
    rows, labels = [], []
    for i in range(900):
        lines = [[rng.choice(words) for _ in range(rng.randint(5, 15))] for _ in range(rng.randint(1, 8))]
        toxic = i % 5 == 0
        for _ in range(rng.randint(1, 3) if toxic else 0):
            line = rng.choice(lines)
            line[rng.randrange(len(line))] = "zork" + rng.choice(words)
        rows.append((i, "\n".join(" ".join(x) for x in lines)))
        labels.append((i, int(toxic)))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_toxic_words_with_new_endings(insults):
    docs, labels = insults
    rows = toxicity.toxicity(docs, labels).join(labels.select("doc_id", F.col("toxic").cast("double").alias("label")), "doc_id").where("held_out").collect()
    assert auc(rows) > 0.97 and np.mean([r.predicted == r.label for r in rows]) > 0.95
    spans = {r.doc_id: r.spans for r in toxicity.toxic_spans(docs, labels).collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    marked = [texts[d][s.start:s.end] for d, found in spans.items() for s in found]
    assert len(marked) > 100 and np.mean([m.startswith("zork") for m in marked]) > 0.95


def test_marginals_against_all_paths():
    rng = np.random.default_rng(2)
    chains = [[0, 1, 2, 1], [2], [1, 0], []]
    laid = toxicity.Chains(chains)
    e, trans = rng.normal(size=len(laid.words)), rng.normal(size=(2, 2))
    p, links = laid.marginals(e, trans)
    total = np.zeros((2, 2))
    for start, size in zip(laid.starts, laid.sizes):
        weigh = {}
        for code in range(1 << size):
            path = [code >> t & 1 for t in range(size)]
            weigh[tuple(path)] = np.exp(sum(e[start + t] * v for t, v in enumerate(path)) + sum(trans[a, b] for a, b in zip(path, path[1:])))
        z = sum(weigh.values())
        for t in range(size):
            assert p[start + t] == pytest.approx(sum(w for path, w in weigh.items() if path[t]) / z)
        for path, w in weigh.items():
            for a, b in zip(path, path[1:]):
                total[a, b] += w / z
    assert links == pytest.approx(total)


def test_spans_in_texts_that_grow_when_lowered():
    lower, origin = toxicity.lowered("İx Y")
    assert lower == "İx Y".lower() and len(origin) == len(lower)
    assert toxicity.located("A İx!", toxicity.lines_of("A İx!"), [np.array([0.1] + [0.9] * (len(toxicity.lines_of("A İx!")[0]) - 1))])[0]["start"] == 2


def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = docs
    sizes = [docs.count()]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, out, SF)
        assert out.columns == (docs.columns if k < 4 else [*docs.columns, "ids"])
        sizes.append(out.count())
    assert sizes == sorted(sizes, reverse=True) and sizes[1] == sizes[2] and sizes[4] == sizes[5]
    run = corpus_pipeline.run(spark, SF)
    assert run.count() == sizes[-1] and run.select("doc_id").distinct().count() == sizes[-1]
