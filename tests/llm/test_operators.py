"""Operators on small frames, against plain versions and on odd input."""

import hashlib
import random
import re
import tracemalloc
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from closeworks.llm import (
    decontamination,
    jaccard_join,
    language_id,
    packing,
    quality_classifier,
    quality_rules,
    secret_scans,
    seeds,
    substring_dedup,
    suffix_dedup,
    url_filters,
)
from closeworks.llm.components import components

DDL = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "_id string, _h long, _text string, node long, n long, region long, spans string, _row string, _t string, _words string"
)


def frame(spark, rows, ddl=DDL):
    """Documents with more columns, whose names the operators use inside."""
    width = ddl.count(",") + 1
    return spark.createDataFrame([tuple(r) + (None,) * (width - len(r)) for r in rows], ddl)


def words(rng, n, vocabulary):
    return [rng.choice(vocabulary) for _ in range(n)]


@pytest.fixture(scope="module")
def corpus():
    """Copies, near copies, shared passages, repeats inside a text, ties, odd white space, other scripts, a long text."""
    rng = random.Random(7)
    vocabulary = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 7))) for _ in range(400)] + ["é", "ß", "日本", "\x1c", "\xa0"]
    texts = [" ".join(words(rng, rng.randint(1, 160), vocabulary)) for _ in range(60)]
    passage, base = " ".join(words(rng, 60, vocabulary)), words(rng, 120, vocabulary)
    for i in range(12):
        texts.append(texts[i] + "\n" + passage + " " + " ".join(words(rng, 30, vocabulary)))
        edited = list(base)
        for _ in range(i % 4):
            edited[rng.randrange(120)] = "edit"
        texts.append(" ".join(edited))
    texts += ["", "one", "one", "a b c", "A B C", " \t lead and trail \n", "x y " * 90, "the " * 300, "z" * 350]
    texts.append("\n".join([passage] * 3) + " ".join(words(rng, 9000, vocabulary)))
    rows = [(i, t, "en", f"h{i % 3}", len(t)) for i, t in enumerate(texts)]
    return rows + [rows[3], rows[70], (900, None, None, None, None), (None, texts[5], "en", "h0", 1), (None, None, None, "h1", 0)]


def plain_repeats(rows, units, size):
    """Which units of each (id, text) are covered by a window that starts earlier."""
    earliest, out = {}, {}
    for key in sorted({(-(1 << 63) if r[0] is None else r[0], r[1] or "") for r in rows}):
        unit = units(key[1])
        gone = np.zeros(len(unit), dtype=bool)
        for j in range(len(unit) - size + 1):
            window = tuple(unit[j : j + size])
            if earliest.setdefault(window, (key, j)) != (key, j):
                gone[j : j + size] = True
        out[key] = (unit, gone)
    return out


@pytest.mark.parametrize("crowded", [False, True])
@pytest.mark.parametrize("kind", ["bytes", "words"])
def test_dedup_is_exact(spark, corpus, kind, crowded):
    limit = 1 if crowded else 256  # every mixed seed takes the way of the crowded ones
    if kind == "bytes":
        w = seeds.Windows(100, 32, suffix_dedup.text_bytes, max_fragments=limit)
        out = suffix_dedup.dedup_bytes(frame(spark, corpus), windows=w).toPandas()
        plain = plain_repeats(corpus, lambda t: list(t.encode()), 100)
        digest = lambda unit, gone: hashlib.sha256(bytes(u for u, g in zip(unit, gone) if not g)).hexdigest()
    else:
        w = seeds.Windows(20, 6, substring_dedup.word_symbols, max_fragments=limit)
        out = substring_dedup.dedup_words(frame(spark, corpus), windows=w).toPandas()
        plain = plain_repeats(corpus, lambda t: t.encode().split(), 20)
        digest = lambda unit, gone: hashlib.sha256(b" ".join(u for u, g in zip(unit, gone) if not g)).hexdigest()
    size = "n_bytes" if kind == "bytes" else "n_words"
    count = lambda values: Counter((None if i is None or i != i else int(i), int(n), int(r), k) for i, n, r, k in values)
    expected = []
    for r in corpus:
        unit, gone = plain[(-(1 << 63) if r[0] is None else r[0], r[1] or "")]
        expected.append((r[0], len(unit), int(gone.sum()), digest(unit, gone)))
    assert count(zip(out["doc_id"], out[size], out["n_removed"], out["kept_sha256"])) == count(expected)
    assert out["n_removed"].sum() > 0


def test_words_of_a_text_are_hashed_at_once(monkeypatch):
    """No call per word, however many different words a corpus has; equal words have equal hashes and others do not."""
    digests, calls = hashlib.blake2b, 0

    def counted(*args, **kwargs):
        nonlocal calls
        calls += 1
        return digests(*args, **kwargs)

    monkeypatch.setattr(hashlib, "blake2b", counted)
    distinct = [*(f"w{i}" for i in range(400_000)), "", "é", "日本", "\x00", "a\x00", "\x1c", "\xa0", "z" * 1000, "z" * 999 + "y"]
    found = substring_dedup.word_symbols(" ".join([*distinct, *distinct]))
    half = len(distinct) - 1  # the empty one is no word
    assert found.dtype == np.uint64 and len(found) == 2 * half and len(np.unique(found)) == half
    assert (found[:half] == found[half:]).all()
    assert (substring_dedup.word_symbols("b\n a\x00") == substring_dedup.word_symbols("a\x00 b")[::-1]).all()
    assert len(substring_dedup.word_symbols(" \t")) == 0
    assert calls == 0


def test_stretches_cover_all_windows(monkeypatch):
    rng = np.random.default_rng(1)
    symbols = rng.integers(0, 3, 5000).astype(np.uint8)
    w = seeds.Windows(100, 32, suffix_dedup.text_bytes)
    whole = seeds.seeds_of(symbols, w)
    monkeypatch.setattr(seeds, "STRETCH", 700)
    first, end, seed, _ = seeds.seeds_of(symbols, w)
    assert first[0] == 0 and end[-1] == 4901 and (first[1:] == end[:-1]).all()
    of = lambda f, e, s: np.repeat(s, e - f)
    assert (of(first, end, seed) == of(*whole[:3])).all()


def plain_components(rows):
    sets, parent = {}, {}
    for i, text in {(r[0], r[1]) for r in rows}:
        w = (text or "").encode().lower().split()
        grams = {tuple(w[j : j + 5]) for j in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
        sets[i] = grams
        parent[i] = i

    def root(x):
        return x if parent[x] == x else root(parent[x])

    order = sorted(sets, key=lambda x: -(1 << 63) if x is None else x)
    for n, a in enumerate(order):
        for b in order[:n]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((order.index(root(a)), order.index(root(b))))
                parent[order[y]] = order[x]
    return {i: (len(s), root(i)) for i, s in sets.items()}


def test_jaccard_components_are_exact(spark, corpus):
    rows = [r for r in corpus if r[0] is not None]
    expected = plain_components(rows)
    out = jaccard_join.near_duplicates(frame(spark, rows)).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in out) == Counter((r[0], *expected[r[0]]) for r in rows)


def test_regions_hold_only_what_can_link_there(spark):
    """Two pivots that share much but cannot link have nothing of each other; a set between two regions is in both."""
    sets = {1: range(100), 2: range(30, 130), 3: range(99), 4: range(10, 110), 5: range(500, 503), 6: range(20, 120)}
    of = lambda nodes: [(n, s) for n in nodes for s in sets[n]]

    def members(nodes, pivots):
        shingles = spark.createDataFrame(of(nodes), "node long, shingle long")
        sizes = spark.createDataFrame([(n, len(sets[n])) for n in nodes], "node long, n long")
        chosen = spark.createDataFrame([(p,) for p in pivots], "node long")
        return sorted((r.pivot, r.node, r.home) for r in jaccard_join._regions(shingles, sizes, chosen).collect())

    assert members([1, 2, 3, 5], [1, 2, 5]) == [(1, 1, True), (1, 3, True), (2, 2, True), (5, 5, True)]
    # 4 and 6 link and have different homes.
    both = [(1, 1, True), (1, 4, True), (1, 6, False), (2, 2, True), (2, 4, False), (2, 6, True)]
    assert members([1, 2, 4, 6], [1, 2]) == both


def test_jaccard_needs_several_rounds(spark):
    """Sets around several centres that share most of their shingles, close to the limit on both sides."""
    rng = random.Random(3)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(90):
        text = list(base)
        for _ in range(rng.choice([0, 1, 2, 3, 3, 4])):
            text[rng.randrange(60)] = f"e{rng.randrange(30)}"
        rows.append((i, " ".join(text[: rng.randint(45, 60)]), "en", "h", 0))
    expected = plain_components(rows)
    out = jaccard_join.near_duplicates(frame(spark, rows)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in out} == expected


def executed(df):
    """The nodes of the plan of ``df`` as it ran, with all of its stages; runs it."""
    plan = df._jdf.queryExecution().executedPlan()
    plan.execute().count()
    found, waiting = [], [plan]
    while waiting:
        node = waiting.pop()
        name = node.getClass().getSimpleName()
        found.append((name, node))
        inner = node.executedPlan() if name == "AdaptiveSparkPlanExec" else node.plan() if name.endswith("QueryStageExec") else None
        children = [inner] if inner is not None else [node.children().apply(i) for i in range(node.children().size())]
        waiting += [x for x in children if x.getClass().getSimpleName() != "ReusedExchangeExec"]
    return found


def test_a_common_passage_brings_no_pairs_of_groups(spark, monkeypatch):
    """Groups of near copies that all hold one passage: joins make no more rows than the sets have shingles."""
    rng, most = random.Random(5), 0
    passage, rows = [f"p{i}" for i in range(40)], []
    for g in range(100):
        base = [f"g{g}w{i}" for i in range(80)]
        for copy in range(3):
            text = list(base)
            text[rng.randrange(80)] = f"edit{copy}"
            rows.append((3 * g + copy, " ".join(passage + text), "en", "h", 0))
    kept = jaccard_join.stored

    def watched(df):
        nonlocal most
        most = max([most, *(n.metrics().apply("numOutputRows").value() for name, n in executed(df) if "Join" in name)])
        return kept(df)

    monkeypatch.setattr(jaccard_join, "stored", watched)
    sets = [(r[0], [int(x) for x in jaccard_join.shingle_set(r[1]).view(np.int64)]) for r in rows]
    whole = spark.createDataFrame(sets, "node long, shingles array<long>")
    links = jaccard_join.link_sets(whole, whole.select("node", F.size("shingles").cast("long").alias("n")))
    found = {r.node: r.component for r in components(links).collect()}
    assert found == {i: i - i % 3 for i, *_ in rows}
    assert most <= sum(len(s) for _, s in sets)


def test_a_passage_rarer_than_the_groups_brings_no_pairs(spark, monkeypatch):
    """A passage that comes before the shingles of each group in the order: sets do not meet other groups by it."""
    passage, most = list(range(20)), 0
    rows = [(g, 80, passage + [1000 * g + i for i in range(100, 160)]) for g in range(60)]
    sets = spark.createDataFrame(rows, "node long, n long, shingles array<long>")
    homes = spark.createDataFrame([(g, g, 0.0, True) for g in range(60)], "node long, home long, least double, linked boolean")
    kept = jaccard_join.stored

    def watched(df):
        nonlocal most
        most = max([most, *(n.metrics().apply("numOutputRows").value() for name, n in executed(df) if "Join" in name)])
        return kept(df)

    monkeypatch.setattr(jaccard_join, "stored", watched)
    found = jaccard_join._members(sets, sets.select("node", "n"), homes).collect()
    assert sorted((r.pivot, r.node, r.home) for r in found) == [(g, g, True) for g in range(60)]
    assert most <= sum(n for _, n, _ in rows)


def test_linked_sets_of_two_homes_meet(spark):
    """The set that is as far from its home or farther is sent to the home of the other, wherever the homes are."""
    rng = random.Random(17)
    sets = {}
    for i in range(120):
        base = set(range(100 * (i % 6), 100 * (i % 6) + rng.randint(3, 60)))
        sets[i] = base - set(rng.sample(sorted(base), rng.randint(0, len(base) // 6))) | set(rng.sample(range(600), rng.randint(0, 4)))
    home = {i: rng.randrange(120) for i in sets}
    least = {i: rng.choice([0.0, 0.1, 0.2, 0.4]) for i in sets}
    sizes = spark.createDataFrame([(i, len(s)) for i, s in sets.items()], "node long, n long")
    rows = spark.createDataFrame([(i, x) for i, s in sets.items() for x in s], "node long, shingle long")
    homes = spark.createDataFrame([(i, home[i], least[i]) for i in sets], "node long, home long, least double")
    met = {(r.a, r.b) for r in jaccard_join._meetings(jaccard_join._ordered(rows, sizes), sizes, homes).collect()}
    links = 0
    for a, x in sets.items():
        for b, y in sets.items():
            if home[a] != home[b] and least[b] <= least[a] and 100 * len(x & y) >= 75 * len(x | y):
                links += 1
                assert (a, home[b]) in met
    assert links > 50 and all(home[a] != b for a, b in met)
    assert len(met) < 0.5 * len(sets) ** 2


def test_first_shingles_meet_those_of_similar_sets(spark):
    """A set and any other that is as similar as either asks for share a first shingle, in the order of all sets."""
    rng = random.Random(13)
    sets = {i: set(rng.sample(range(30), rng.randint(1, 28))) for i in range(70)}
    rows = spark.createDataFrame([(i, x) for i, s in sets.items() for x in s], "node long, shingle long")
    sizes = spark.createDataFrame([(i, len(s)) for i, s in sets.items()], "node long, n long")
    asked = {i: rng.choice([0.3, 0.5, 0.55, 0.75]) for i in sets}
    own = F.udf(asked.get, "double")("node")
    first = jaccard_join._ordered(rows, sizes).withColumn("s", own).select("node", jaccard_join._first_shingles(F.col("s"))).collect()
    of = {i: {r.shingle for r in first if r.node == i} for i in sets}
    for a in sets:
        for b in sets:
            if a != b and len(sets[a] & sets[b]) >= max(asked[a], asked[b]) * len(sets[a] | sets[b]):
                assert of[a] & of[b]
    assert sum(map(len, of.values())) < 0.8 * sum(map(len, sets.values()))


def test_keep_one(spark, corpus):
    out = jaccard_join.keep_one(frame(spark, corpus))
    kept = out.toPandas()
    full = jaccard_join.near_duplicates(frame(spark, corpus)).toPandas()
    assert out.columns == frame(spark, []).columns
    assert sorted(kept["doc_id"].fillna(-1)) == sorted(set(full["component_id"].fillna(-1)))


def test_null_and_repeated_ids_are_rows_of_their_own(spark):
    """Unrelated rows without an id or with one id stay, and link nothing but what is near to their texts."""
    rng = random.Random(11)
    vocabulary = [f"v{i}" for i in range(500)]
    texts = [" ".join(words(rng, 60, vocabulary)) for _ in range(9)]
    near = lambda k: texts[k] + " end"
    rows = [(None, texts[0]), (None, texts[1]), (5, near(0)), (9, near(1)), (None, texts[2]), (None, texts[2] + " more")]
    rows += [(7, texts[3]), (7, texts[4]), (7, texts[3]), (20, near(3)), (21, near(4)), (None, texts[5]), (None, texts[5])]
    rows += [(7, texts[6]), (3, near(6)), (8, texts[7]), (8, near(7)), (None, ""), (11, ""), (None, near(8))]
    nodes = sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    plain = plain_components([(i, t) for i, (_, t) in enumerate(nodes)])
    of = {node: plain[i] for i, node in enumerate(nodes)}  # (shingles, first node)

    docs = frame(spark, [(i, t, "en", "h", 0) for i, t in rows])
    out = jaccard_join.near_duplicates(docs).collect()
    expected = Counter((r[0], of[r][0], nodes[of[r][1]][0]) for r in rows)
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in out) == expected
    kept = [(r.doc_id, r.text) for r in jaccard_join.keep_one(docs).collect()]
    assert sorted(of[r][1] for r in kept) == sorted({root for _, root in of.values()})
    assert all(r[0] == nodes[of[r][1]][0] for r in kept)


def test_components_of_a_chain(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 90), (95, 100), (7, 7)]
    found = {(r.node, r.component) for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {(i, 0) for i in range(41)} | {(n, 90) for n in (90, 95, 100)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def fewest_edits(item, text):
    """Fewest edits between an item and any part of a text."""
    x, places = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32), np.arange(len(text) + 1)
    row = np.zeros(len(text) + 1, dtype=int)
    for i, c in enumerate(item, 1):
        new = np.append(i, np.minimum(row[:-1] + (x != ord(c)), row[1:] + 1))
        row = np.minimum.accumulate(new - places) + places
    return int(row.min())


def test_leaks_within_the_budget(spark):
    rng = random.Random(11)
    letters = "abcdefghijklmnop  "
    items = [(i, "".join(rng.choices(letters, k=rng.randint(90, 260))).strip()) for i in range(6)] + [(50, "tiny"), (51, None), (52, "")]
    docs, expected = [], {}
    for d in range(60):
        text = items[d % 6][1]
        text = list(decontamination.normal(text))
        edits = rng.randint(0, 30)
        for _ in range(edits):
            at = rng.randrange(len(text))
            text[at : at + 1] = rng.choice([[], ["z"], [text[at], "z"]])
        around = ["".join(rng.choices(letters, k=rng.randint(0, 300))) for _ in range(2)]
        whole = decontamination.normal(around[0] + "".join(text) + around[1])
        docs.append((d, whole.upper() if d % 2 else whole, "en", "h", 0))
        for n, other in items[:6]:
            plain = decontamination.normal(other)
            best = fewest_edits(plain, whole)
            if best <= decontamination.Budget().edits(len(plain)):
                expected[d, n] = best
    docs += [(200, "a tiny one", None, None, None), (201, None, None, None, None), (None, "tiny", None, None, None), docs[0]]
    benchmark = spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, doc_id string")
    for block in (1 << 20, 200):
        rows = decontamination.find_leaks(frame(spark, docs), benchmark, block_chars=block).collect()
        found = {(r.doc_id, r.item_id) for r in rows}
        assert 10 < len(expected) < 50
        assert {(r.doc_id, r.item_id): r.edits for r in rows} == {**expected, (200, 50): 0, (None, 50): 0}
        texts = {d[0]: decontamination.normal(d[1] or "") for d in docs}
        plain = {i: decontamination.normal(t or "") for i, t in items}
        for r in rows:
            assert texts[r.doc_id][r.start : r.end] == r.matched
            assert edit_distance(plain[r.item_id], r.matched) == r.edits <= decontamination.Budget().edits(len(plain[r.item_id]))
        assert sum(r.doc_id == 0 for r in rows) in (0, 2)
        kept = decontamination.drop_leaked(frame(spark, docs), benchmark, block_chars=block)
        assert {r.doc_id for r in kept.collect()} == {d[0] for d in docs} - {d for d, _ in found}


@pytest.mark.parametrize("unit", ["-", "ab", "na na hey ", "0123456789abcdefghijklmnopqrstuvwxyz"])
def test_repeated_grams_are_not_paired(unit):
    """Slots hold what a count over all pairs gives, with each place once; long runs take bounded memory."""
    item = (unit * 1000)[:1000].strip()
    index = decontamination.Index([(7, item), (8, "x" * 40 + item[:150]), (9, item[:15])], decontamination.Budget())
    texts = [item[3:400], "x" * 30 + item[:500], "y" * 20, item[:14]]
    starts = np.cumsum([0] + [len(t) + 1 for t in texts])
    points = np.frombuffer("\0".join(texts).encode("utf-32-le"), dtype=np.uint32)
    plain = Counter()
    for t, text in enumerate(texts):
        for n, (_, other) in enumerate(index.items):
            step = index.budget.edits(len(other)) + 1
            grams = {}
            for p in range(len(other) - 9):
                grams.setdefault(other[p : p + 10], []).append(p)
            for a in range(len(text) - 9):
                plain.update({(t, n, (a - p) // step) for p in grams.get(text[a : a + 10], [])})
    for size in (64, index.SLOTS):
        index.SLOTS = size
        t, n, slot, held = (x.tolist() for x in index.slots(points, starts))
        assert dict(zip(zip(t, n, slot), held)) == plain
    long = decontamination.normal((unit * 200_000)[:200_000])
    tracemalloc.start()
    found = list(decontamination._texts_matches(index, [long]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [(n, e) for _, _, rows in found for n, _, _, e in rows if n != 1] == [(0, 0), (2, 0)]
    assert peak < 1 << 30


def test_secrets_against_plain_scan(spark):
    key = "AKIA" + "A1B2" * 4
    texts = [
        f'Token = "{"ab12" * 6}" and PASSWORD:hunter22 secret=short',
        f"{key} x {'0123456789abcdef' * 2}é token=token=abcdef",
        None, "", "apikey = 'x' api_key=' Zz9+/_.=-Q'",
        "opaque aB3dE5gH7jK9mN1pQ3sT5v here", 'token: "copied-example"', 'token: "copied-example"',
    ]
    rows = [(i, t, "en", f"o{i}", 0) for i, t in enumerate(texts)]
    rows += [(20 + i, 'token: "copied-example"', "en", f"x{i}", 0) for i in range(4)] + [rows[0], (None, texts[1], None, None, None)]
    out = secret_scans.scan_secrets(frame(spark, rows)).toPandas()
    by_id = {None if i != i else int(i): r for i, r in zip(out["doc_id"], out.itertuples())}
    assert len(out) == len(rows)
    for i, text, *_ in rows:
        spans = [(m.start(), "assign", m.end()) for m in secret_scans.ASSIGN.finditer(text or "") if len(m[2]) >= 6]
        spans += [(m.start(), "access", m.end()) for m in secret_scans.ACCESS.finditer(text or "") if len(m[0]) >= 20]
        spans += [(m.start(), "hex", m.end()) for m in re.finditer("[0-9a-f]+", text or "") if len(m[0]) >= 24]
        order = {"assign": 0, "access": 1, "hex": 2}
        spans.sort(key=lambda x: (x[0], order[x[1]]))
        r = by_id[i]
        count = Counter(k for _, k, _ in spans)
        assert (r.n_assign, r.n_access, r.n_hex) == (count["assign"], count["access"], count["hex"])
        base = ",".join(f"{k}:{s}:{e}" for s, k, e in spans)
        assert r.base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        assert [x for x in r.spans.split(",") if x and not x.startswith("opaque")] == (base.split(",") if base else [])
    assert "opaque" in by_id[5].spans and by_id[5].n_live == 1
    assert (by_id[6].n_live, by_id[6].n_example) == (0, 1)
    masked = {r.doc_id: r.text for r in secret_scans.redact_live(frame(spark, rows)).collect()}
    assert masked[6] == texts[6] and masked[2] is None and masked[5] == "opaque [secret] here"
    assert "hunter22" not in masked[0] and len(masked) == len({r[0] for r in rows})


def test_only_documents_with_live_spans_are_shuffled(spark):
    """Spans too many to be broadcast move the documents that have them, and no others."""
    rows = [(i, f"plain text {i}", "en", "h", 0) for i in range(400)] + [(400 + i, f"password: own-secret-{i}", "en", "h", 0) for i in range(9)]
    limit = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "-1")
    try:
        out = secret_scans.redact_live(frame(spark, rows))
        moved = sum(n.metrics().apply("shuffleRecordsWritten").value() for name, n in executed(out) if name == "ShuffleExchangeExec")
        texts = {r.doc_id: r.text for r in out.collect()}
    finally:
        spark.conf.set(limit, before)
    assert texts == {i: t if i < 400 else "[secret]" for i, t, *_ in rows}
    assert 0 < moved <= 50


def test_cascade_is_exact_and_grows_with_the_list(spark):
    listed = spark.range(0, 3000).selectExpr("concat('k', id * 7) as key")
    universe = spark.range(0, 20000).selectExpr("concat('k', id) as key")
    levels = url_filters.build_cascade(listed, universe)
    assert len(levels) > 2
    pairs = [url_filters.hash_pair(universe["key"], i) for i in range(len(levels))]
    from pyspark.sql import functions as F

    found = universe.select("key", url_filters.is_listed(levels)(F.array(F.array(*pairs)))[0].alias("hit"))
    got = {r.key for r in found.filter("hit").collect()}
    assert got == {f"k{i * 7}" for i in range(3000) if i * 7 < 20000}
    with pytest.raises(ValueError):
        url_filters.build_cascade(listed, universe, max_bytes=64)


def test_urls(spark):
    rule = url_filters.Rule
    rules = [rule("com", "/", "allow"), rule("a.com", "/x/", "block"), rule("b.org", "", "block")]
    urls = [
        ("http://A.com/x/1?q", "a.com", "/x/1", "a.com/x/", "block"),
        ("https://w.a.com/y#x", "w.a.com", "/y", "com/", "allow"),
        ("ftp://a.com", "a.com", "", None, "allow"),
        ("http://notb.org/", "notb.org", "/", None, "allow"),
        ("http://s.b.org", "s.b.org", "", "b.org", "block"),
        ("http://É.com/\n/x", "É.com", "/\n/x", "com/", "allow"),
        ("b.org/x", "", "", None, "allow"), ("", "", "", None, "allow"), (None, "", "", None, "allow"),
        ("x://y://b.org/", "y:", "//b.org/", None, "allow"),
    ]
    ddl = "page_id long, url string, host string, path string, rule string, verdict string, _keys string, key string"
    rows = [(i, u[0]) + (None,) * 6 for i, u in enumerate(urls)] + [(None, urls[0][0]) + (None,) * 6, (0, urls[0][0]) + (None,) * 6]
    out = url_filters.judge_urls(spark.createDataFrame(rows, ddl), rules).collect()
    expected = Counter((i, *u[1:]) for i, u in enumerate(urls)) + Counter([(None, *urls[0][1:]), (0, *urls[0][1:])])
    assert Counter(tuple(r) for r in out) == expected
    assert url_filters.judge_urls(spark.createDataFrame([], ddl), rules).count() == 0
    assert {r.verdict for r in url_filters.judge_urls(spark.createDataFrame(rows, ddl), []).collect()} == {"allow"}


def test_quality_rules_on_odd_rows(spark):
    line = "the same header line of this host"
    body = lambda i: " ".join(f"w{i}x{j}" for j in range(60))
    rows = [(i, f"{line}\n{body(i)}", "en", "h", 0) for i in range(12)]
    rows += [(100, "\n".join([line] * 9) + "\n" + " ".join(f"v{j}" for j in range(45)), "en", "h", 0)]
    rows += [(101, None, None, None, None), (102, "", "en", "h", 0), (None, body(1), "en", None, 0), rows[0]]
    rows += [(103, "a b c " * 40, "en", "g", 0), (104, "é# \x1c ß|", "en", "g", 0)]
    out = quality_rules.apply_rules(frame(spark, rows)).collect()
    assert len(out) == len(rows)
    by_id = {r.doc_id: r for r in out}
    assert by_id[0].kept and by_id[0].n_removed_words == 7
    assert not by_id[100].kept and by_id[100].n_dup_lines == 8
    strict = quality_rules.apply_rules(frame(spark, rows), limits=quality_rules.LineLimits(kept_share=0.9)).collect()
    assert not any(r.kept for r in strict if r.doc_id in range(12)) and not by_id[0].base_failed
    assert by_id[101].base_failed and by_id[101].n_words == 0 and by_id[None].kept
    assert by_id[103].n_repeat_words == 120 and by_id[103].base_failed
    assert (by_id[104].n_words, by_id[104].word_chars, by_id[104].n_symbols) == (3, 5, 2)
    cleaned = {r.doc_id: r.text for r in quality_rules.clean_documents(frame(spark, rows)).collect()}
    assert cleaned[0] == body(0) and 100 not in cleaned and 101 not in cleaned


def test_lines_are_counted_by_documents(spark):
    """Against a plain count: copies under their own ids count each, repeated rows and rows without an id by their text."""
    body = lambda i: "\n".join(" ".join(f"w{i}x{k}y{j}" for j in range(10)) for k in range(6))
    rows = [(i, body(0), "en", "h", 0) for i in range(10)] + [(20 + i, body(1), "en", "h", 0) for i in range(9)]
    rows += [(40, body(2), "en", "h", 0)] * 12 + [(None, body(3), "en", "h", 0)] * 12
    rows += [(60 + i, body(4), "en", f"h{i % 2}", 0) for i in range(18)]
    rows += [(90 + i, f"{body(5 + i)}\n  Some  SHARED line \nsome shared LINE", "en", None, 0) for i in range(11)]
    holders = {}
    normal = lambda line: " ".join(line.split()).lower()
    for i, text, _, host, _ in rows:
        for line in text.split("\n"):
            holders.setdefault((host, normal(line)), set()).add((i, text))
    expected = Counter()
    for i, text, _, host, _ in rows:
        lost = sum(len(x.split()) for x in text.split("\n") if len(holders[host, normal(x)]) >= 10)
        expected[i, lost, len(text.split()) - lost >= 0.5 * len(text.split())] += 1
    out = quality_rules.apply_rules(frame(spark, rows)).collect()
    assert Counter((r.doc_id, r.n_removed_words, r.kept) for r in out) == expected
    assert not any(r.kept for r in out if r.doc_id is not None and r.doc_id < 10)
    cleaned = Counter(r.doc_id for r in corpus_pipeline.quality_rules(spark, frame(spark, rows), "").collect())
    assert cleaned == Counter({i: n for (i, _, kept), n in expected.items() if kept})


def test_more_data_frees_no_line(spark):
    """One host at two sizes; the licence lines are on 2 to 5 % of the small one and on 0.4 to 1 % of the large one."""
    licences = ["All rights reserved.", "Licensed under the terms below."]
    body = lambda i: " ".join(f"w{i}x{j}" for j in range(60))

    def cleaned(size):
        texts = [body(i) for i in range(size)]
        texts = ["\n".join([x for x, n in zip(licences, (12, 30)) if i < n] + [t]) for i, t in enumerate(texts)]
        docs = frame(spark, [(i, t, "en", "h", len(t)) for i, t in enumerate(texts)])
        removed = {r.doc_id: r.n_removed_words for r in quality_rules.apply_rules(docs).collect()}
        assert removed == {i: (3 if i < 12 else 0) + (5 if i < 30 else 0) for i in range(size)}
        return {r.doc_id: (r.text, r.n_chars) for r in corpus_pipeline.quality_rules(spark, docs, "").collect()}

    for size in (600, 3000):
        assert cleaned(size) == {i: (body(i), len(body(i))) for i in range(size)}


def test_packing_limits():
    rng = np.random.default_rng(5)
    limits = packing.Limits(tokens=64, segments=3, loss_tokens=60, pool=8)
    packer = packing.Packer(limits, 10)
    sizes = rng.integers(1, 200, 80).tolist() + [1] * 20
    for doc, n in enumerate(sizes):
        packer.add(doc, np.arange(n, dtype="<u4"))
        if len(packer.pool) >= 16:
            packer.pack(8)
    packer.pack(0)
    per_doc, per_sequence = Counter(), {}
    for doc, start, length, _, total, sequence, offset, loss in sorted(packer.rows, key=lambda r: (r[5], r[6])):
        at = per_sequence.setdefault(sequence, [0, 0, 0])
        assert offset == at[0] and total == sizes[doc]
        per_sequence[sequence] = [at[0] + length, at[1] + 1, at[2] + loss]
        per_doc[doc] += length
    assert [per_doc[i] for i in range(len(sizes))] == sizes
    assert all(t <= 64 and s <= 3 and x <= 60 and t & (t - 1) == 0 for t, s, x in per_sequence.values())


def test_ids_are_those_of_the_tokenizer():
    path = public_tokenizers.path
    fast = packing.Encoder(path("byte_bpe_50k.json"), path("byte_bpe_50k.tiktoken"))
    plain = packing.Encoder(path("byte_bpe_50k.json"), None)
    rng = random.Random(2)
    letters = [chr(i) for i in range(256)] + [" "] * 50 + ["\n"] * 20 + list("abcé日œ")
    for _ in range(3000):
        text = "".join(rng.choices(letters, k=rng.randint(0, 60)))
        assert fast.encode(text).tolist() == plain.encode(text).tolist()
    assert packing.PATTERN == public_tokenizers.PATTERN
    # Special strings have an id of their own; white space of any length ends no encoder.
    named = Tokenizer.from_file(path("byte_bpe_50k.json"))
    assert fast.special
    for text in ("a <|endoftext|> b", "<|endoftext|>" * 3, "é日<|endoftext|>", *fast.special):
        ids = named.encode(text, add_special_tokens=False).ids
        assert fast.encode(text).tolist() == plain.encode(text).tolist() == ids
    for n in (packing.LONG_SPACE - 1, packing.LONG_SPACE, 3_000_000):
        text = "a" + " " * n + "b" + "\n" * n
        assert fast.encode(text).tolist() == named.encode(text, add_special_tokens=False).ids


def test_packing_odd_rows(spark):
    rows = [(1, None), (2, ""), (None, "a b"), (2, ""), (3, "word " * 5000)]
    out = packing.pack_documents(frame(spark, rows), public_tokenizers.path("byte_bpe_50k.json")).toPandas()
    assert out[out["doc_id"] == 2]["length"].tolist() == [1, 1]
    assert out[out["doc_id"].isna()]["length"].sum() == 3
    assert not out.duplicated(["sequence_id", "offset"]).any()


def test_quality_odd_rows(spark):
    rows = [(1, None), (2, ""), (None, "a b"), (2, ""), (3, "word " * 5000)]
    empty = spark.createDataFrame([], "doc_id long, quality int, _id long")
    out = quality_classifier.score_quality(frame(spark, rows), empty).collect()
    assert len(out) == 5 and {r.score for r in out} == {0.5}
    labels = spark.createDataFrame([(2, 0), (3, 1), (3, None), (None, 1), (77, 1)], "doc_id long, quality int")
    out = quality_classifier.score_quality(frame(spark, rows), labels).collect()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in out)
    assert not any(r.held_out for r in out if r.doc_id is None)
    assert quality_classifier.score_quality(frame(spark, []), labels).count() == 0


def test_quality_sample_is_bounded_by_rows(spark):
    """One labelled id has most rows, with many texts and many repeats."""
    rows = [(5, f"text number {i % 60}") for i in range(400)] + [(i, f"plain words {i}") for i in range(10, 16)]
    documents = spark.createDataFrame(rows, "_id long, _text string")
    marks = spark.createDataFrame([(5, 1), (5, 0)] + [(i, 0) for i in range(10, 16)], "_id long, _label int")
    always, some = F.lit(True), quality_classifier.Knn(sample=20)
    counts, given = quality_classifier.labelled_sample(documents, marks, always, some)
    assert len(counts) == len(given) == 20
    again, same = quality_classifier.labelled_sample(documents.repartition(7), marks, always, some)
    assert (again == counts).all() and (same == given).all()
    counts, given = quality_classifier.labelled_sample(documents, marks, always, quality_classifier.Knn())
    assert Counter(given.tolist()) == {1: 60, 0: 6}


def test_votes_against_all_cosines(spark):
    rng = random.Random(9)
    knn = quality_classifier.Knn(neighbours=4, block=7, rank=12)
    texts = [words(rng, rng.randint(3, 40), [f"v{i}" for i in range(60)] + ["BUY!!", "now"]) for _ in range(70)]
    features = quality_classifier.Features(knn)
    vectors = np.stack([features.vector(t if isinstance(t, str) else " ".join(t)) for t in texts])
    labels = np.array([rng.randint(0, 1) for _ in range(50)])
    model = quality_classifier.fit(vectors[:50], labels, knn)
    latent = model.latent(vectors).astype(float)
    for i, vote in enumerate(model.vote(model.latent(vectors))):
        cosines = sorted(((float(latent[i] @ v), n) for n, v in enumerate(latent[:50])), reverse=True)[:4]
        weights = [max(c, 1e-6) ** knn.power for c, _ in cosines]
        plain = sum(w * labels[n] for w, (_, n) in zip(weights, cosines)) / sum(weights)
        assert vote == pytest.approx(plain, abs=1e-4)


def test_language_odd_rows(spark):
    rows = [(i, t * 20, l) for i, (t, l) in enumerate([("the cat ", "en"), ("der hund ", "de")] * 20)]
    rows += [(100, None, "en"), (101, "", None), (102, "12 !?", "xx"), (None, "the cat", None), (103, "der hund", None), rows[0]]
    rows += [(104, "the cat " * 30 + "der hund " * 60, None)]
    out = language_id.identify_languages(frame(spark, rows)).collect()
    found = {r.doc_id: r for r in out}
    assert len(out) == len(rows)
    assert [found[i].lang_pred for i in (100, 101, 102, None, 103)] == ["und", "und", "und", "en", "de"]
    assert [x.lang for x in found[104].languages] == ["de", "en"] and found[104].lang_pred == "de"
    nothing = language_id.identify_languages(frame(spark, [(1, "abc", None)])).collect()
    assert nothing[0].lang_pred == "und" and nothing[0].score == 0
    assert language_id.identify_languages(frame(spark, [])).count() == 0


def test_empty_tables(spark):
    empty = frame(spark, [])
    benchmark = spark.createDataFrame([], "item_id long, text string")
    assert suffix_dedup.dedup_bytes(empty).count() == 0
    assert substring_dedup.dedup_words(empty).count() == 0
    assert jaccard_join.near_duplicates(empty).count() == 0
    assert secret_scans.scan_secrets(empty).count() == 0
    assert quality_rules.apply_rules(empty).count() == 0
    assert packing.pack_documents(empty, public_tokenizers.path("byte_bpe_50k.json")).count() == 0
    assert decontamination.find_leaks(empty, benchmark).count() == 0
    assert decontamination.drop_leaked(frame(spark, [(1, "x")]), benchmark).count() == 1
    for cleaned in (quality_rules.clean_documents(empty), jaccard_join.keep_one(empty), secret_scans.redact_live(empty)):
        assert cleaned.columns == empty.columns and cleaned.count() == 0
