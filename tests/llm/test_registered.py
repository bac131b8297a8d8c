"""The registered queries against their SQL, or against a plain version where SQL has no words for it."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from compare import compare, connect
from tokenizers import Tokenizer

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from closeworks.llm.decontamination import normal
from closeworks.llm.queries import QUERIES
from closeworks.llm.sql import SQL

SF = "/root/testdata/sf0.001"


def test_all_are_registered():
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert set(QUERIES) | {"pipeline"} <= set(queries()) and set(SQL) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(SQL))
def test_equal_to_sql(spark, name):
    assert compare(QUERIES[name](spark, SF), connect(SF), SQL[name]) == []


def check_pieces(pieces, documents):
    """All ids of all documents, each in one piece; sequences without gaps, none too long."""
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    by_doc = dict(list(pieces.sort_values("start").groupby("doc_id")))
    assert set(by_doc) == set(documents["doc_id"])
    for doc, text in zip(documents["doc_id"], documents["text"]):
        ids, at = tokenizer.encode(text or "", add_special_tokens=False).ids + [1], 0
        for piece in by_doc[doc].itertuples():
            part = np.array(ids[at : at + piece.length], dtype="<u4")
            assert (piece.start, piece.doc_tokens, piece.ids_crc32) == (at, len(ids), zlib.crc32(part.tobytes()))
            at += piece.length
        assert at == len(ids)
    ordered = pieces.sort_values(["sequence_id", "offset"])
    sums = ordered.groupby("sequence_id")["length"]
    assert (ordered["offset"] == sums.cumsum() - ordered["length"]).all()
    total = sums.sum()
    assert total.max() <= 2048 and (total & (total - 1) == 0).all()


def test_packing_round_trip(spark):
    documents = spark.read.parquet(f"{SF}/documents.parquet").toPandas()
    check_pieces(QUERIES["op6_packing"](spark, SF).toPandas(), documents)


def test_quality_held_out(spark):
    found = QUERIES["op5_quality_classifier"](spark, "/root/testdata/sf0.01")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = found.filter("held_out").join(labels, "doc_id").toPandas()
    assert (rows["predicted"] == rows["quality"]).mean() >= 0.95
    assert rows["score"].between(0, 1).all()
    assert [zlib.crc32(str(i).encode()) % 5 for i in rows["doc_id"]] == [0] * len(rows)


def test_language_held_out(spark):
    found = QUERIES["op7_language_id"](spark, "/root/testdata/sf0.01")
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    rows = found.filter("held_out").join(documents, "doc_id").toPandas()
    assert (rows["lang_pred"] == rows["lang"]).mean() >= 0.95
    assert [zlib.crc32(str(i).encode()) % 3 for i in rows["doc_id"]] == [1] * len(rows)


def test_leaks_with_every_exact_item(spark):
    documents = spark.read.parquet(f"{SF}/documents.parquet").toPandas()
    items = spark.read.parquet(f"{SF}/benchmark.parquet").toPandas()
    texts = {d: normal(t) for d, t in zip(documents["doc_id"], documents["text"])}
    exact = {
        (d, i) for d, t in texts.items() for i, x in zip(items["item_id"], items["text"]) if normal(x) in t
    }
    rows = QUERIES["op4_decontamination"](spark, SF).toPandas()
    found = {(r.doc_id, r.item_id) for r in rows.itertuples()}
    assert exact and exact <= found
    assert {(r.doc_id, r.item_id) for r in rows.itertuples() if r.edits == 0} == exact
    assert all(texts[r.doc_id][r.start : r.end] == r.matched for r in rows.itertuples())


def test_pipeline(spark):
    """Stage by stage: what goes and what stays."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stored(stage(spark, docs, SF))
        assert docs.columns == columns
        seen[name] = docs.toPandas().set_index("doc_id")
    rules = QUERIES["op9_quality_rules"](spark, SF).toPandas()
    assert set(seen["quality_rules"].index) == set(rules[rules["kept"]]["doc_id"])
    assert set(seen["near_duplicates"].index) < set(seen["quality_rules"].index)
    items = [normal(t) for t in spark.read.parquet(f"{SF}/benchmark.parquet").toPandas()["text"]]
    leaked = {i for i, t in seen["near_duplicates"]["text"].items() if any(x in normal(t) for x in items)}
    assert leaked.isdisjoint(seen["decontamination"].index)
    assert set(seen["secret_scans"].index) == set(seen["decontamination"].index)
    assert (seen["secret_scans"]["n_chars"] == seen["secret_scans"]["text"].str.len()).all()
    pieces = corpus_pipeline.run(spark, SF).toPandas()
    check_pieces(pieces, seen["secret_scans"].reset_index())
