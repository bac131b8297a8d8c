"""Toxicity, importance resampling and vector codes: against plain versions and on odd input."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from closeworks.llm import importance_sampling, toxicity, vector_codes
from closeworks.llm.importance_sampling import Resampling, resample
from closeworks.llm.queries import QUERIES
from closeworks.llm.toxicity import Ftrl, Hasher, score_toxicity, train
from closeworks.llm.vector_codes import Codes, encode_vectors

DDL = "doc_id long, text string, _id long, _h long, _text string, score long, rank long, label string, n long, key string, place long, no_id string"
TARGET = "item_id long, text string, _text string, bucket long, n long"
VECTORS = "vec_id long, embedding array<float>, label int, id string, code string, error long, vector string, none string, key string"


def frame(spark, rows, ddl=DDL):
    """Rows with more columns, whose names the operators use inside."""
    width = ddl.count(",") + 1
    return spark.createDataFrame([tuple(r) + (None,) * (width - len(r)) for r in rows], ddl)


# --- toxicity ---------------------------------------------------------------


def plain_ftrl(examples, labels, ftrl):
    """One coordinate at a time, in dictionaries."""
    seen = Counter(f for x in examples for f in x.tolist())
    start = math.log((sum(labels) + 0.5) / (len(labels) + 1) / (1 - (sum(labels) + 0.5) / (len(labels) + 1)))
    z, n = Counter(), Counter()

    def weight(f):
        penalty = 0.0 if f == "bias" else ftrl.l1
        if abs(z[f]) <= penalty:
            return 0.0
        return -(z[f] - math.copysign(penalty, z[f])) / ((ftrl.beta + math.sqrt(n[f])) / ftrl.alpha + ftrl.l2)

    rng = np.random.default_rng(0)
    for _ in range(ftrl.epochs):
        for i in rng.permutation(len(examples)):
            used = [f for f in examples[i].tolist() if seen[f] > 1] + ["bias"]
            w = {f: weight(f) for f in used}
            g = 1 / (1 + math.exp(-(start + sum(w.values())))) - labels[i]
            for f in used:
                rate = (math.sqrt(n[f] + g * g) - math.sqrt(n[f])) / ftrl.alpha
                z[f] += g - rate * w[f]
                n[f] += g * g
    return {f: weight(f) for f in z if f != "bias" and weight(f)}, start + weight("bias")


@pytest.fixture(scope="module")
def marked():
    rng = random.Random(3)
    words = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 7))) for _ in range(80)]
    texts, labels = [], []
    for i in range(480):
        body = [rng.choice(words) for _ in range(rng.randint(3, 60))]
        if i % 4 == 0:
            body[rng.randrange(len(body))] = rng.choice(["vermin!", "Cretin", "dolt."])
        texts.append(" ".join(body))
        labels.append(int(i % 4 == 0))
    return texts, labels


def test_training_is_ftrl(marked):
    texts, labels = marked
    examples = [np.unique(Hasher().features(t)) for t in texts]
    ftrl = Ftrl(l1=1.0, epochs=3)
    found = train(examples, np.array(labels), ftrl)
    weights, bias = plain_ftrl(examples, labels, ftrl)
    assert found.hashes.tolist() == sorted(weights) and 0 < len(weights) < len(np.unique(np.concatenate(examples))) / 2
    assert np.allclose(found.values, [weights[f] for f in sorted(weights)], rtol=1e-5, atol=1e-6)
    assert math.isclose(found.bias, bias, rel_tol=1e-9)
    table = found.table()
    for x in examples[:20]:
        total = bias + sum(weights.get(f, 0.0) for f in x.tolist())
        assert math.isclose(found.score(np.r_[x, x], table), 1 / (1 + math.exp(-total)), rel_tol=1e-4)


def test_features_are_words_stems_pairs_and_skips():
    text = "One two, three FOUR onerous"
    hasher, words = Hasher(), ["one", "two", "three", "four", "onerous"]
    mask = (1 << 64) - 1

    def end(x):
        x &= mask
        x ^= x >> 29
        return (x * 0x94D049BB133111EB & mask) >> 32

    ids = [toxicity.word_hash(w) for w in words]
    expected = [end(i * 0xA0761D6478BD642F) for i in ids]
    expected.append(end(toxicity.word_hash("onero-") * 0xE7037ED1A0B428DB))
    for gap, a, b in toxicity.PAIRS:
        expected += [end(ids[i] * a + ids[i + gap] * b) for i in range(len(ids) - gap)]
    assert sorted(hasher.features(text).tolist()) == sorted(expected)
    assert hasher.features("").tolist() == hasher.features("... --").tolist() == []


def test_toxicity_of_a_frame(spark, marked):
    texts, labels = marked
    rows = [(i, t, 0, 0, "x") for i, t in enumerate(texts)]
    odd = [rows[0], rows[0], (None, texts[4]), (None, None), (900, None), (901, ""), (902, "word " * 300_000), (0, "another text")]
    marks = [(i, y, 7) for i, y in enumerate(labels)] + [(0, 0, 1), (5, None, 1), (None, 1, 1), (7777, 1, 1)]
    table = spark.createDataFrame(marks, "doc_id long, toxic int, _label long")
    ftrl = Ftrl(l1=3.0, epochs=4)
    found = score_toxicity(frame(spark, rows + odd), table, ftrl=ftrl).toPandas()
    assert len(found) == len(rows) + len(odd)
    assert found["score"].between(0, 1).all() and (found["predicted"] == (found["score"] >= 0.3)).all()
    fold = [not np.isnan(i) and zlib.crc32(str(int(i)).encode()) % 4 == 2 for i in found["doc_id"]]
    assert found["held_out"].tolist() == fold
    held = found[found["held_out"] & (found["doc_id"] < 480)]
    assert (held["predicted"] == held["doc_id"].map(lambda i: labels[int(i)])).mean() > 0.9
    # The same rows in another order, over other partitions, give the same scores; so do repeats.
    again = score_toxicity(frame(spark, (rows + odd * 3)[::-1]).repartition(7), table, ftrl=ftrl).toPandas()
    assert set(map(tuple, found.dropna().values)) == set(map(tuple, again.dropna().values))


def test_toxicity_bounds_the_sample(spark, marked):
    """Neither the number of examples nor that of their features passes its bound; a hot labelled id fills no more."""
    texts, labels = marked
    rows = frame(spark, [(i % 3, f"{t} {i}") for i, t in enumerate(texts)])
    keyed = rows.select(toxicity.id_of("doc_id").alias("_id"), toxicity.text_of("text").alias("_text"))
    keyed = keyed.withColumn("_h", toxicity.F.xxhash64("_text"))
    marks = spark.createDataFrame([(i, y) for i, y in enumerate(labels[:3])], "_id long, _label int")
    always = toxicity.F.lit(True)
    examples, given = toxicity.labelled_sample(keyed, marks, always, Ftrl(sample=20))
    assert len(examples) == len(given) == 20
    few, _ = toxicity.labelled_sample(keyed, marks, always, Ftrl(sample=20, features=500))
    assert 0 < len(few) < 20 and sum(map(len, few)) <= 500
    assert toxicity.labelled_sample(keyed, marks, always, Ftrl(features=0))[0] == []


def test_toxicity_with_nothing_to_learn(spark):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    found = score_toxicity(frame(spark, [(1, "a text"), (2, None)]), none).collect()
    assert [(r.score < 1e-9, r.predicted) for r in found] == [(True, 0)] * 2
    assert score_toxicity(frame(spark, []), none).count() == 0
    one = spark.createDataFrame([(1, 1)], "doc_id long, toxic int")
    assert score_toxicity(frame(spark, [(1, ""), (3, "b")]), one).count() == 2


def test_toxicity_held_out(spark):
    """Labels of the tables are in part without a sign in the text; those with one are found, clean texts are left alone."""
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic")
    rows = QUERIES["op11_toxicity"](spark, sf).filter("held_out").join(labels, "doc_id").toPandas()
    assert (rows["predicted"] == rows["toxic"]).mean() >= 0.93
    assert rows[rows["toxic"] == 0]["predicted"].mean() <= 0.02


# --- importance resampling --------------------------------------------------


def plain_resample(rows, target, r):
    def features(text):
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        runs = [" ".join(words[i : i + n]) for n in range(1, r.max_run + 1) for i in range(len(words) - n + 1)]
        return len(words), [zlib.crc32(x.encode()) % r.buckets for x in runs]

    docs = [(i, *features(t), t or "") for i, t in rows]
    s, t = Counter(b for _, _, f, _ in docs for b in f), Counter(b for _, x in target for b in features(x)[1])
    all_s, all_t = sum(s.values()) + r.buckets, sum(t.values()) + r.buckets
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1.0) * all_s / ((s[b] + 1.0) * all_t)))
    out = []
    for i, n, f, text in docs:
        h = int(hashlib.sha256(f"{r.seed}:{'null' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(map(gain, f))
        key = int.from_bytes(hashlib.blake2b(text.encode(), digest_size=8).digest(), "little", signed=True)
        out.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n, key])
    able = sorted((x for x in out if x[4] >= r.min_words), key=lambda x: (-x[3], x[0] is None, x[0] or 0, x[5], x[1]))
    ranks = {id(x): k + 1 for k, x in enumerate(able[: len(able) * r.percent // 100])}
    return Counter((*x[:4], ranks.get(id(x))) for x in out)


@pytest.fixture(scope="module")
def drawn():
    rng = random.Random(11)
    words = ["".join(rng.choices("abcdeé9", k=rng.randint(1, 5))) for _ in range(200)] + ["Straße", "日本", "\x7f", "a\x00b", "\xa0"]
    texts = [rng.choice([" ", "-", "\n"]).join(rng.choice(words) for _ in range(rng.randint(0, 60))) for _ in range(150)]
    rows = list(enumerate(texts)) + [(5, texts[5]), (5, texts[6]), (None, texts[7]), (None, None), (900, None), (901, "")]
    rows += [(None, texts[8])] * 40 + [(903, "w " * 200_000), (-4, texts[9])]
    return rows, [(i, " ".join(rng.choice(words) for _ in range(30))) for i in range(9)] + [(None, None), (9, "")]


@pytest.mark.parametrize("r", [Resampling(), Resampling(buckets=50, percent=55, max_run=2, seed=7), Resampling(percent=100, min_words=0)])
def test_resampling_against_a_plain_version(spark, drawn, r):
    rows, target = drawn
    found = resample(frame(spark, rows).repartition(5), frame(spark, target, TARGET), resampling=r)
    assert Counter(map(tuple, found.collect())) == plain_resample(rows, target, r)


@pytest.mark.parametrize("sorted_at_once", [1, 50_000])
def test_cutoff_of_any_scores(spark, monkeypatch, sorted_at_once):
    """Ties, one score only, a far outlier; also with brackets that must be halved, and sketches that miss."""
    monkeypatch.setattr(importance_sampling, "SORTED", sorted_at_once)
    rng = random.Random(2)
    for scores in ([5] * 30, [rng.randint(-3, 3) for _ in range(200)], [rng.randint(-10**6, 10**6) for _ in range(300)] + [10**15]):
        table = spark.createDataFrame([(s,) for s in scores], "score long")
        ordered = sorted(scores, reverse=True)
        for wanted in (1, len(scores) // 3, len(scores)):
            assert importance_sampling.cutoff_score(table, wanted, 0.01) == ordered[wanted - 1]
    monkeypatch.setattr(importance_sampling.F, "percentile_approx", lambda *_: importance_sampling.F.array(*map(importance_sampling.F.lit, (7, 9))))
    assert importance_sampling.cutoff_score(table, 150, 0.01) == ordered[149]


def test_resampling_of_little(spark, drawn):
    rows, target = drawn
    empty, none = frame(spark, []), frame(spark, [], TARGET)
    assert resample(empty, frame(spark, target, TARGET)).count() == resample(empty, none).count() == 0
    short = [(1, "a b"), (2, None)]
    assert [r["rank"] for r in resample(frame(spark, short), none).collect()] == [None, None]
    found = resample(frame(spark, rows), none)
    assert Counter(map(tuple, found.collect())) == plain_resample(rows, [], Resampling())


def test_alike_rows_are_dealt_to_several_ranges(spark):
    """A third of all rows without an id and with one text must not meet in one range."""
    rows = frame(spark, [(None, "word " * 30)] * 400)
    found = resample(rows, frame(spark, [], TARGET), resampling=Resampling(percent=100, ranges=8))
    assert sorted(r["rank"] for r in found.collect()) == list(range(1, 401))
    able = rows.select(importance_sampling.F.lit(1).alias("score")).withColumn("place", importance_sampling.F.monotonically_increasing_id())
    numbered = importance_sampling.number_rows(able, [importance_sampling.F.desc("score"), importance_sampling.F.asc("place")], 8)
    assert len(numbered.inputFiles()) >= 4


# --- vector codes -----------------------------------------------------------


def plain_codes(rows, codes):
    kept = [r for r in rows if r[1] and all(x is not None and math.isfinite(x) for x in r[1])]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    kept = [r for r in kept if len(r[1]) == len(kept[0][1])]
    whole = np.array([[math.floor(codes.scale * float(np.float32(x))) for x in r[1]] for r in kept], dtype=np.int64)
    step = whole.shape[1] // codes.parts
    pieces = [whole[:, k * step : (k + 1) * step] for k in range(codes.parts)]
    books = [p[: codes.entries].copy() for p in pieces]

    def assign(p, b):
        d = ((p[:, None] - b[None]) ** 2).sum(2)
        return d.argmin(1), d.min(1)

    for _ in range(codes.rounds):
        for p, b in zip(pieces, books):
            at = assign(p, b)[0]
            for e in range(len(b)):
                if (at == e).any():
                    b[e] = p[at == e].sum(0) // (at == e).sum()
    found = [assign(p, b) for p, b in zip(pieces, books)]
    error = sum(f[1] for f in found)
    by_label = Counter()
    for r, e in zip(kept, error):
        by_label[r[2]] += int(e)
    digest = hashlib.sha256(",".join(str(x) for b in books for x in b.ravel()).encode()).hexdigest()
    return Counter(
        (r[0], "".join(f"{f[0][i]:02x}" for f in found), int(error[i]), by_label[r[2]], digest) for i, r in enumerate(kept)
    )


@pytest.fixture(scope="module")
def points():
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(12, 8))
    near = [(centres[rng.integers(12)] + 0.05 * rng.normal(size=8)).astype(np.float32).tolist() for _ in range(500)]
    grid = [rng.integers(-1, 2, size=8).astype(float).tolist() for _ in range(200)]  # many ties
    rows = [(i, v, int(rng.integers(4)) if i % 5 else None) for i, v in enumerate(near + grid + [near[0]] * 300)]
    odd = [(5, near[7], 1), (5, near[7], 1), (None, near[8], 2), (None, None, 2), (2000, [], 1), (2001, None, None)]
    odd += [(2002, [1.0] * 7 + [None], 1), (2003, [float("nan")] * 8, 1), (2004, [float("inf")] + [0.0] * 7, 1), (2005, [1.0] * 4, 1)]
    return rows + odd


@pytest.mark.parametrize("codes", [Codes(), Codes(entries=5, rounds=2, leaf=3, block=64), Codes(parts=2, entries=40, scale=3), Codes(rounds=0)])
def test_codes_against_plain_k_means(spark, points, codes):
    found = encode_vectors(frame(spark, points, VECTORS).repartition(3), codes=codes)
    assert Counter(map(tuple, found.collect())) == plain_codes(points, codes)


def test_codes_of_few_and_equal_vectors(spark):
    few = [(3, [1.0, 2.0, 3.0, 4.0], 1), (1, [1.0, 2.0, 3.0, 4.0], None), (2, [0.0, -0.5, 0.0, 9.0], None)]
    assert Counter(map(tuple, encode_vectors(frame(spark, few, VECTORS)).collect())) == plain_codes(few, Codes())
    same = [(i, [0.25] * 8, i % 2) for i in range(600)]
    assert Counter(map(tuple, encode_vectors(frame(spark, same, VECTORS)).collect())) == plain_codes(same, Codes())
    for rows in ([], [(1, None, 1), (2, [float("nan")], 1)]):
        empty = encode_vectors(frame(spark, rows, VECTORS))
        assert empty.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"] and empty.count() == 0
    with pytest.raises(ValueError, match="parts"):
        encode_vectors(frame(spark, [(1, [1.0] * 6, 1)], VECTORS))


@pytest.mark.parametrize("kind", ["clusters", "line", "equal", "far"])
def test_trees_own_what_brute_force_gives(kind):
    rng = np.random.default_rng(1)
    points = {
        "clusters": (rng.integers(-900, 900, (20, 1, 6)) + rng.integers(-30, 30, (20, 60, 6))).reshape(-1, 6),
        "line": np.outer(np.arange(700) % 350, np.ones(6, np.int64)),
        "equal": np.full((500, 6), 7),
        "far": rng.integers(-vector_codes.LARGEST, vector_codes.LARGEST, (300, 6)),
    }[kind].astype(np.int64)
    tree = vector_codes.build_tree(points, 16)
    ordered = points[tree.place]
    assert sorted(tree.place.tolist()) == list(range(len(points)))
    for i in range(len(tree.first)):
        a, n = tree.first[i], tree.count[i]
        assert (ordered[a : a + n].sum(0) == tree.sums[i]).all()
        if tree.after[i] > i + 1:  # two halves, next to each other
            right = tree.after[i + 1]
            assert tree.count[i + 1] + tree.count[right] == n and tree.first[right] == a + tree.count[i + 1]
    entries = np.concatenate([points[:40], points[:5], points[::50] + 1])
    entries.setflags(write=False)
    d = np.array([[sum((int(x) - int(y)) ** 2 for x, y in zip(p, e)) for e in entries] for p in points[:300]], dtype=object)
    code, error = vector_codes.codes_of(tree, ordered, entries)
    assert code[:300].tolist() == [list(r).index(min(r)) for r in d] and error[:300].tolist() == [min(r) for r in d]
    n, sums = vector_codes.entry_sums(tree, ordered, entries)
    assert (n == np.bincount(code, minlength=len(entries))).all()
    for e in range(len(entries)):
        assert (sums[e] == points[code == e].sum(0)).all()
    if kind == "clusters":
        looked = sum(c for _, c, owner in vector_codes.owners(tree, ordered, entries[:12]) if not isinstance(owner, int))
        assert looked < len(points)  # some balls are owned as a whole
