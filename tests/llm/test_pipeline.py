"""The pipeline on a small corpus: the whole rows that each stage keeps, against plain Python."""

import random
import re

import pytest
from test_operators import fewest_edits, plain_components
from test_registered import check_pieces

import corpus_pipeline
from closeworks.llm.decontamination import Budget, normal

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
WORD = r"[^\x20\x09-\x0D]+"
HEADER, LICENCE = "Home   About Contact us", "All rights reserved by the people of this host."
ITEM = "the quick surveyor measured seventeen fields beside the river before the council asked for another map of the valley"


def prose(rng, n):
    return ["".join(rng.choices("abcdefghij", k=rng.randint(3, 8))) for _ in range(n)]


def lines(words):
    return "\n".join(" ".join(words[i : i + 12]) for i in range(0, len(words), 12))


@pytest.fixture(scope="module")
def corpus():
    """Each row is clean or has one fault that one stage is there for; some have two."""
    rng = random.Random(23)
    texts = [lines(prose(rng, 90)) for _ in range(12)]
    # Lines of a host: on 12 documents (removed), and on 9 (left).
    texts = [f"{HEADER}\n{t}" + (f"\n{LICENCE}" if i < 9 else "") for i, t in enumerate(texts)]
    rows = [(i, t, "en", "h0", len(t)) for i, t in enumerate(texts)]
    # Too short, too repetitive, depleted, null, empty.
    depleted = "\n".join([HEADER.upper()] * 15) + "\n" + lines(prose(rng, 30))
    odd = ["few words only", "again and again " * 30, depleted, None, "", " \n\t "]
    rows += [(100 + i, t, None, "h0", None if t is None else len(t)) for i, t in enumerate(odd)]
    # Exact copies, near copies and a chain of them, each on hosts of its own; rows that repeat; rows without an id.
    base, other = prose(rng, 100), lines(prose(rng, 80))
    rows += [(200 + i, other, "en", f"c{i % 3}", len(other)) for i in range(9)]
    for i in range(6):
        edited = list(base)
        edited[: 4 * i] = [f"e{j}" for j in range(4 * i)]
        rows.append((300 + i, lines(edited), "en", f"n{i}", 7))
    rows += [rows[-1], rows[0]]
    rows += [(None, lines(prose(rng, 60)), "en", None, 5) for _ in range(2)]
    # Benchmark items: whole, with an edit, and half of one.
    for i, part in enumerate([ITEM, ITEM.upper().replace("MAP", "PLAN"), ITEM[: len(ITEM) // 2]]):
        rows.append((400 + i, f"{lines(prose(rng, 60))} {part} {lines(prose(rng, 20))}", "en", "b", 0))
    # Secrets: of one owner, of five owners, two in one text that meet.
    secrets = ["password = hunter2hunter2", "AKIA" + "Q7W8" * 5, 'token: "' + "0a1b2c3d" * 4 + '"']
    for i, secret in enumerate(secrets):
        rows.append((500 + i, f"{lines(prose(rng, 55))} {secret} {lines(prose(rng, 5))} é", "en", "s", 1))
    for i in range(5):
        rows.append((510 + i, f"{lines(prose(rng, 60))}\npassword=exampleexample", "en", f"o{i}", 1))
    # By two owners in 16 documents, and by one owner in as many, each time with other words around it.
    for i in range(16):
        rows.append((520 + i, f"{lines(prose(rng, 60))} x password=twoownershold", "en", f"o{i % 2}", 1))
        rows.append((540 + i, f"{lines(prose(rng, 60))} x password=oneownerholds", "en", "o3", 1))
    return rows


def plain_rules(rows):
    plain = lambda line: " ".join(re.findall(WORD, line)).lower()
    holders = {}
    for i, text, _, host, _ in rows:
        for line in (text or "").split("\n"):
            if plain(line):
                holders.setdefault((host, plain(line)), set()).add((i, text))
    out = []
    for i, text, lang, host, n in rows:
        words = re.findall(WORD, text or "")
        windows = [tuple(words[j : j + 3]) for j in range(len(words) - 2)]
        repeated = {j + k for j, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
        above = [x for x in (text or "").split("\n") if len(holders.get((host, plain(x)), ())) >= 10]
        left = len(words) - sum(len(re.findall(WORD, x)) for x in above)
        if len(words) >= 50 and 2 * len(repeated) <= len(words) and 2 * left >= len(words):
            new = "\n".join(x for x in text.split("\n") if x not in above)
            out.append((i, new, lang, host, len(new) if above else n))
    return out


def plain_copies(rows):
    """The rows of a component are known by id and text; here only rows without a component lack an id."""
    named = plain_components([r for r in rows if r[0] is not None])
    return sorted({r for r in rows if r[0] is None or named[r[0]][1] == r[0]}, key=repr)


def plain_leaks(rows):
    item = normal(ITEM)
    return [r for r in rows if fewest_edits(item, normal(r[1])) > Budget().edits(len(item))]


def plain_masks(rows):
    kinds = [
        r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]{6,})""",
        r"(AKIA[A-Z0-9]{16,})",
        r"([0-9a-f]{24,})",
    ]
    spans = lambda text: [(*m.span(), m[1]) for k in kinds for m in re.finditer(k, text)]
    owners, repositories = {}, {}
    for i, text, _, owner, _ in rows:
        for _, _, secret in spans(text):
            owners.setdefault(secret, set()).add(owner)
            repositories.setdefault(secret, set()).add(i)
    is_live = lambda x: len(owners[x]) < 2 or (len(owners[x]) < 4 and len(repositories[x]) < 16)
    out = []
    for i, text, lang, owner, n in rows:
        live = [x for x in spans(text) if is_live(x[2])]
        hidden = {at for start, end, _ in live for at in range(start, end)}
        new = "".join("[secret]" * (at - 1 not in hidden) if at in hidden else c for at, c in enumerate(text))
        out.append((i, new, lang, owner, len(new) if live else n))
    return out


def test_rows_of_each_stage(spark, corpus, tmp_path):
    spark.createDataFrame(corpus, COLUMNS).write.parquet(str(tmp_path / "documents.parquet"))
    items = [(1, "demo", ITEM), (2, "demo", None), (3, "demo", "")]
    spark.createDataFrame(items, "item_id long, name string, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    gone, expected = {}, corpus
    for (name, stage), plain in zip(corpus_pipeline.STAGES, (plain_rules, plain_copies, plain_leaks, plain_masks)):
        before, expected = expected, plain(expected)
        docs = corpus_pipeline.stored(stage(spark, docs, str(tmp_path)))
        assert sorted(map(tuple, docs.collect()), key=repr) == sorted(expected, key=repr), name
        gone[name] = {r[0] for r in before} - {r[0] for r in expected}
    # The fixture does hold what each stage is for, and the clean rows stay.
    assert gone["quality_rules"] == set(range(100, 106))
    assert gone["near_duplicates"] > set(range(201, 209)) and 300 not in gone["near_duplicates"]
    assert gone["decontamination"] == {400, 401} and not gone["secret_scans"]
    texts = {r[0]: r[1] for r in expected}
    assert all("[secret]" in texts[i] for i in (500, 501, 502, 540, 555))
    assert "exampleexample" in texts[510] and "twoownershold" in texts[520] and "[secret]" not in texts[520]
    named = [r for r in expected if r[0] is not None]
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs.filter("doc_id IS NOT NULL"), str(tmp_path)).toPandas()
    check_pieces(pieces, spark.createDataFrame(named, COLUMNS).toPandas())
