"""Toxic spans and scores by a linear-chain conditional random field.

Labels mark documents, so tokens are labelled first, on a bounded sample of
labelled documents: a form (a word or its beginning) counts once for each
context it is found in, a context being the smallest-hash other word of its
line, so that near copies of one document count as one.  Forms found in toxic
documents PRECISION of the time or more, at equal numbers of lines, mark
tokens of toxic documents as toxic; all other tokens are not.

The field's chains are a text's lines (in pieces of CHAIN tokens).  A token's
evidence is a sum of hashed features of the word (itself, beginnings, endings)
and of its neighbours; transitions link the two states.  It is fitted by
gradient steps on the sample's chains that hold a marking form and one in
PLAIN of the others; forward and backward messages run over all chains of a
batch at once, position by position.

Scoring reads every text whole: marginals above one half give the offending
spans; the chance that some token is toxic, the largest and the summed
marginals and the length go into a logistic regression fitted on all
documents that teach.

Only documents whose crc32(doc_id as text) mod 4 is not 2 teach.  The sample
takes the SAMPLE documents of either label with the smallest id hash among
those of at most SAMPLE_CHARS characters.  Cases: null and empty texts have no
tokens and score by that; a null doc_id is never held out and has no label;
without both labels every score is one half; rows are kept as they are.
"""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame, functions as F

from cauce.llm.common import map_rows, prepare, saved
from cauce.llm.quality_classifier import held_out, labelled

SAMPLE, SAMPLE_CHARS = 1500, 20_000
FOLDS, HELD_OUT = 4, 2
THRESHOLD = 0.3
BUCKETS = 1 << 17
CHAIN = 512
STEPS, RATE, DECAY = 60, 0.4, 1e-5
PRECISION, MIN_CONTEXTS, MIN_SHARE = 0.8, 4, 0.002
PLAIN = 5
REMEMBERED = 300_000
LOW, HIGH = -20.0, 20.0

#: ASCII that is no letter or digit, but for line breaks, ends a word.
_BLANK = bytes(32 if c < 128 and c != 10 and not chr(c).isalnum() else c for c in range(256))


def lines_of(text: str | None) -> list[list[bytes]]:
    """Lower-case words by chain."""
    out = []
    for line in (text or "").lower().encode("utf-8", "surrogatepass").translate(_BLANK).split(b"\n"):
        words = line.split()
        out += [words[i:i + CHAIN] for i in range(0, len(words), CHAIN)]
    return out


def forms(word: bytes) -> list[bytes]:
    """The word and its beginnings of three to eight bytes."""
    return [b"=" + word] + [word[:k] for k in range(3, min(len(word), 9))]


def features(word: bytes) -> list[int]:
    parts = [b"=" + word, *[b"^" + word[:k] for k in (3, 4, 5, 6)], *[b"$" + word[-k:] for k in (3, 4)]]
    return [zlib.crc32(p) % BUCKETS for p in parts]


N_FEATURES = len(features(b""))


def form_hashes(word: bytes) -> np.ndarray:
    return np.array([zlib.crc32(f) for f in forms(word)], np.uint64)


def contexts(lines: list[list[bytes]], known: dict[bytes, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Form hashes and in how many contexts each is found."""
    pairs, found, held = np.zeros(0, np.uint64), [], 0
    for words in lines:
        if held > 1 << 20:  # keep distinct pairs only
            pairs, found, held = np.unique(np.concatenate([pairs, *found])), [], 0
        order = sorted({zlib.crc32(w[::-1]) for w in words})[:2]
        for w in set(words):
            if (h := known.get(w)) is None:
                h = known[w] = form_hashes(w)
            other = next((o for o in order if o != zlib.crc32(w[::-1])), 0)
            found.append(h << np.uint64(32) | np.uint64(other))
            held += len(h)
    pairs = np.unique(np.concatenate([pairs, *found]))
    return np.unique(pairs >> np.uint64(32), return_counts=True)


def marking_forms(toxic: list[list[bytes]], clean: list[list[bytes]], known: dict[bytes, np.ndarray]) -> set[int]:
    """Hashes of the forms that mark tokens; toxic and clean are chains."""
    (f, n), (g, m) = contexts(toxic, known), contexts(clean, known)
    at = np.minimum(np.searchsorted(g, f), max(len(g) - 1, 0))
    other = np.where(g[at] == f, m[at], 0) if len(g) else np.zeros(len(f))
    other = other * (len(toxic) / max(len(clean), 1))
    good = (n >= max(MIN_CONTEXTS, MIN_SHARE * len(toxic))) & (n >= PRECISION * (n + other + 1))
    return set(f[good].tolist())


class Chains:
    """Chains of word numbers laid out by position, longest first."""

    def __init__(self, chains: list[list[int]]):
        self.order = np.array(sorted(range(len(chains)), key=lambda i: -len(chains[i])), np.int64)
        sizes = np.array([len(chains[i]) for i in self.order], np.int64)
        self.sizes, self.longest = sizes, int(sizes[0]) if len(sizes) else 0
        self.alive = [int(np.searchsorted(-sizes, -t)) for t in range(self.longest)]  # chains longer than t
        self.starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]) if len(sizes) else np.zeros(0, np.int64)
        self.words = np.fromiter((w for i in self.order for w in chains[i]), np.int64, int(sizes.sum()))
        n = len(self.words)
        self.first = np.zeros(n, bool)
        self.first[self.starts[sizes > 0]] = True
        self.last = np.zeros(n, bool)
        self.last[(self.starts + sizes - 1)[sizes > 0]] = True

    def evidence(self, own: np.ndarray, before: np.ndarray, after: np.ndarray) -> np.ndarray:
        """Log odds of toxic by token from its word's and its neighbours' scores."""
        e = own[self.words]
        e[1:] += np.where(self.first[1:], 0.0, before[self.words[:-1]])
        e[:-1] += np.where(self.last[:-1], 0.0, after[self.words[1:]])
        return e

    def marginals(self, e: np.ndarray, trans: np.ndarray):
        """Per token the chance of toxic; the sum over links of the chances of each pair of states."""
        n = len(self.words)
        ahead = np.zeros((n, 2))
        back = np.zeros((n, 2))
        weigh = np.exp(trans)
        ex = np.exp(np.clip(e, -30, 30))
        m = np.ones((len(self.order), 2))
        for t, k in enumerate(self.alive):
            at = self.starts[:k] + t
            m = m[:k] if t == 0 else m[:k] @ weigh
            m = m * np.stack([np.ones(k), ex[at]], axis=1)
            m /= m.sum(axis=1, keepdims=True)
            ahead[at] = m
        for t in range(self.longest - 1, -1, -1):
            k = self.alive[t]
            at = self.starts[:k] + t
            on = self.alive[t + 1] if t + 1 < self.longest else 0
            b = np.ones((k, 2))
            if on:
                nxt = at[:on] + 1
                b[:on] = (back[nxt] * np.stack([np.ones(on), ex[nxt]], axis=1)) @ weigh.T
                b[:on] /= b[:on].sum(axis=1, keepdims=True)
            back[at] = b
        p = ahead * back
        p /= p.sum(axis=1, keepdims=True)
        left = np.flatnonzero(~self.last)
        link = ahead[left][:, :, None] * weigh[None] * (back[left + 1] * np.stack([np.ones(len(left)), ex[left + 1]], axis=1))[:, None, :]
        link /= link.sum(axis=(1, 2), keepdims=True)
        return p[:, 1], link.sum(axis=0)


def fit(chains: list[list[bytes]], labels: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """Weights (3 x BUCKETS: own word, word before, word after) and transitions of the field, by adaptive gradient steps."""
    number: dict[bytes, int] = {}
    ids = [[number.setdefault(w, len(number)) for w in c] for c in chains]
    laid = Chains(ids)
    y = np.fromiter((v for i in laid.order for v in labels[i]), float, len(laid.words))
    parts = np.array([features(w) for w in number], np.int64).reshape(-1, N_FEATURES)
    n, size = len(laid.words), len(number)
    weights, trans = np.zeros((3, BUCKETS)), np.zeros((2, 2))
    rate = (y.sum() + 1) / (n + 2)
    trans += np.log(np.array([[1 - rate, rate], [0.5, 0.5]]))
    seen_w, seen_t = np.full_like(weights, 1e-8), np.full_like(trans, 1e-8)
    left = np.flatnonzero(~laid.last)
    truth = np.array([[((y[left] == a) & (y[left + 1] == b)).sum() for b in (0, 1)] for a in (0, 1)], float)
    for _ in range(STEPS):
        scores = weights[:, parts].sum(axis=2)
        p, links = laid.marginals(laid.evidence(*scores), trans)
        wrong = y - p
        by_word = np.stack([np.bincount(laid.words, wrong, size), np.bincount(laid.words[:-1], np.where(laid.first[1:], 0, wrong[1:]), size),
                            np.bincount(laid.words[1:], np.where(laid.last[:-1], 0, wrong[:-1]), size)])
        grad = np.stack([np.bincount(parts.ravel(), np.repeat(g, N_FEATURES), BUCKETS) for g in by_word]) - DECAY * weights * n / 1000
        turn = truth - links
        seen_w += grad ** 2
        seen_t += turn ** 2
        weights += RATE * grad / np.sqrt(seen_w)
        trans += RATE * turn / np.sqrt(seen_t)
    return weights.astype(np.float32), trans


class Tagger:
    """Scores texts with a fitted field; words met before keep their numbers."""

    def __init__(self, weights: np.ndarray, trans: np.ndarray):
        self.weights, self.trans = weights, trans
        self.clear()

    def clear(self):
        self.number: dict[bytes, int] = {}
        self.scores = np.zeros((3, 0))

    def learn(self, words: set[bytes]) -> None:
        if len(self.number) + len(words) > REMEMBERED:
            self.clear()
        new = [w for w in words if w not in self.number]
        if new:
            self.number |= dict(zip(new, range(len(self.number), len(self.number) + len(new))))
            parts = np.array([features(w) for w in new], np.int64)
            self.scores = np.hstack([self.scores, self.weights[:, parts].sum(axis=2)])

    def tag(self, texts: list[str | None]):
        """Per text its chains of words, per chain the chances of toxic."""
        by_text = [lines_of(t) for t in texts]
        flat = [c for chains in by_text for c in chains]
        words = set().union(*flat) if flat else set()
        if not words <= self.number.keys():
            if len(self.number) + len(words - self.number.keys()) > REMEMBERED:
                self.clear()
            self.learn(words)
        get = self.number.__getitem__
        laid = Chains([list(map(get, c)) for c in flat])
        p = laid.marginals(laid.evidence(*self.scores), self.trans)[0] if flat else np.zeros(0)
        out: list = [None] * len(flat)
        for i, start, size in zip(laid.order, laid.starts, laid.sizes):
            out[i] = p[start:start + size]
        at = 0
        for chains in by_text:
            yield chains, out[at:at + len(chains)]
            at += len(chains)


def raw_score(chances: list[np.ndarray]) -> float:
    """Log odds that some token is toxic, within LOW and HIGH."""
    if not chances:
        return LOW
    none = float(np.log1p(-np.minimum(np.concatenate(chances), 1 - 1e-12)).sum())
    return float(np.clip(np.log(max(-np.expm1(none), 1e-12)) - none, LOW, HIGH))


def sample(docs: DataFrame, labels: DataFrame) -> list:
    """At most SAMPLE rows (text, label) of either label, each distinct text once."""
    short = docs.where(F.coalesce(F.length("text"), F.lit(0)) <= SAMPLE_CHARS)
    ids = saved(labelled(short.select(F.col("doc_id").cast("long")), labels, "toxic", FOLDS, HELD_OUT), "toxic-ids")
    picked = None
    for toxic in (True, False):
        own = ids.where((F.col("label") >= 0.5) == toxic).distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)
        picked = own if picked is None else picked.unionByName(own)
    picked = F.broadcast(saved(picked, "toxic-sample"))  # 2 * SAMPLE ids
    rows = short.select(F.col("doc_id").cast("long"), "text").join(picked, "doc_id").select("text", "label").distinct()
    return sorted(((r["text"] or "", r["label"] >= 0.5) for r in rows.collect()))


def trained(docs: DataFrame, labels: DataFrame):
    """(weights, transitions), or None without both labels."""
    one: dict[bytes, bytes] = {}  # equal words share one object
    return learned([([[one.setdefault(w, w) for w in c] for c in lines_of(t)], y) for t, y in sample(docs, labels)])


def learned(rows: list[tuple[list[list[bytes]], bool]]):
    toxic, clean = ([c for lines, y in rows if y == label for c in lines] for label in (True, False))
    if not toxic or not clean:
        return None
    known: dict[bytes, np.ndarray] = {}
    chosen = marking_forms(toxic, clean, known)
    marking = {w for w, h in known.items() if not chosen.isdisjoint(h.tolist())}
    chains, marks = [], []
    for chain, y in [(c, 1) for c in toxic] + [(c, 0) for c in clean]:
        own = [int(w in marking) for w in chain]
        if any(own) or zlib.crc32(b" ".join(chain)) % PLAIN == 0:
            chains.append(chain)
            marks.append([y * m for m in own])
    return fit(chains, marks) if chains else None


def document_numbers(chances: list[np.ndarray]) -> list[float]:
    """What a text's marginals say together: see the head of this module."""
    p = np.concatenate(chances) if chances else np.zeros(0)
    if not len(p):
        return [LOW, LOW, 0.0, 0.0, 0.0, 0.0]
    most = float(np.clip(p.max(), 1e-9, 1 - 1e-9))
    return [raw_score(chances), float(np.log(most / (1 - most))), float(np.log1p(p.sum())), float(p.sum() / len(p)) * 10,
            float(np.log1p((p > 0.5).sum())), float(np.log1p(len(p)))]


def regressed(rows: DataFrame, taught: DataFrame) -> DataFrame:
    """``rows`` with ``score``: logistic regression on x, fitted on the taught rows."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.functions import array_to_vector, vector_to_array

    vectors = taught.select(array_to_vector("x").alias("features"), "label").where("label in (0.0, 1.0)")
    model = LogisticRegression(regParam=1e-4, maxIter=60, probabilityCol="p").fit(vectors)
    return (model.transform(rows.withColumn("features", array_to_vector("x")))
            .withColumn("score", vector_to_array("p")[1]).drop("features", "p", "rawPrediction", "prediction"))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted, n_toxic of every document row."""
    prepare(docs.sparkSession)
    spark = docs.sparkSession
    docs = docs.select("doc_id", F.col("text").cast("string"))
    model = trained(docs, labels)
    if model is None:
        return docs.select("doc_id", held_out(FOLDS, HELD_OUT).alias("held_out"), F.lit(0.5).alias("score"), F.lit(1).alias("predicted"), F.lit(0).cast("long").alias("n_toxic"))
    sent = spark.sparkContext.broadcast(model)  # 3 x BUCKETS numbers

    def run(parts):
        tagger = Tagger(*sent.value)
        for p in parts:
            found = [(document_numbers(chances), sum(int((c > 0.5).sum()) for c in chances)) for _, chances in tagger.tag(p["text"])]
            yield {"doc_id": p["doc_id"], "x": [f[0] for f in found], "n_toxic": [f[1] for f in found]}

    rows = saved(map_rows(docs.select(F.col("doc_id").cast("long"), "text"), run, "doc_id long, x array<double>, n_toxic long"), "toxicity")
    scored = regressed(rows, saved(labelled(rows, labels, "toxic", FOLDS, HELD_OUT), "toxic-taught"))
    return scored.select("doc_id", held_out(FOLDS, HELD_OUT).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "n_toxic")


def toxic_spans(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, spans (start, end, chance; code points, end exclusive) of the tokens with a chance above one half."""
    prepare(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    schema = "doc_id long, spans array<struct<start:int,end:int,chance:double>>"
    model = trained(docs, labels)
    if model is None:
        return docs.select("doc_id", F.array().cast("array<struct<start:int,end:int,chance:double>>").alias("spans"))
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(parts):
        tagger = Tagger(*sent.value)
        for p in parts:
            yield {"doc_id": p["doc_id"], "spans": [located(t, chains, chances) for t, (chains, chances) in zip(p["text"], tagger.tag(p["text"]))]}

    return map_rows(docs, run, schema)


def located(text: str | None, chains: list[list[bytes]], chances: list[np.ndarray]) -> list[dict]:
    """Code-point spans of the toxic tokens, found by walking the words through the text."""
    out, at = [], 0
    lower, origin = lowered(text or "")
    for words, p in zip(chains, chances):
        for w, c in zip(words, p):
            word = w.decode("utf-8", "surrogatepass")
            at = lower.index(word, at)
            if c > 0.5:
                out.append({"start": origin[at], "end": origin[at + len(word) - 1] + 1, "chance": float(c)})
            at += len(word)
    return out


def lowered(text: str) -> tuple[str, list[int]]:
    """Lower-cased text and, for each of its characters, the place it comes from (a capital may give two)."""
    lower = text.lower()
    if len(lower) == len(text):
        return lower, list(range(len(text)))
    return lower, [i for i, c in enumerate(text) for _ in c.lower()]
