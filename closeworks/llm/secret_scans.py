"""Secret scan with corpus-wide ownership frequency.

Patterns find candidates in every text. How many distinct repositories and owners hold the same
candidate, anywhere in the corpus, then tells published examples from credentials of one owner.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from closeworks.llm.common import NULL_ID, ROW_BITS, bitmap, has_bit, id_of, id_or_null, row_place, stored, text_of

# Fixed values of the base scan, in the order in which kinds are listed.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
# All of [0-9a-f]+ that have 24 characters or more: a run of hex digits is one match either way.
LONG_HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "opaque")

#: Candidates of the method itself: long runs that mix letters of both cases and digits.
OPAQUE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")

#: A candidate that at least so many owners hold is a copied example, and so is one that two or more owners hold in at least
#: so many repositories. What only one owner holds is that owner's, in however many repositories it stands.
EXAMPLE_OWNERS = 4
EXAMPLE_REPOSITORIES = 16

SPANS_TYPE = "array<struct<start:int,kind:int,end:int,secret:string>>"
SCAN_SCHEMA = (
    "_id long, _text_hash long, _owner string, _repository string, "
    f"n_assign long, n_access long, n_hex long, base_sha256 string, _found {SPANS_TYPE}"
)


def _opaque(value: str) -> bool:
    return (
        any(c.isdigit() for c in value) and any(c.isupper() for c in value) and any(c.islower() for c in value)
    )


def scan(text: str) -> list[tuple[int, int, int, str]]:
    """Base spans and the method's own candidates as (start, kind, end, secret), sorted.

    A candidate of the method that meets a base span is left to the base.
    """
    found = []
    lower = text.lower()
    if any(k in lower for k in KEYWORDS):
        found += [(m.start(), 0, m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end(), m[0]) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end(), m[0]) for m in LONG_HEX.finditer(text)]
    own = [(m.start(), 3, m.end(), m[0]) for m in OPAQUE.finditer(text) if _opaque(m[0])]
    found += [x for x in own if not any(x[0] < b[2] and b[0] < x[2] for b in found)]
    return sorted(found)


def span_text(spans: list[tuple[int, int, int, str]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e, _ in spans)


def _scan_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans of each text. Only hashes of the candidates leave the task, never the secrets."""
    fields = [("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32()), ("secret", pa.string())]
    carried = ["_id", "_text_hash", "_owner", "_repository"]
    for batch in batches:
        counts, digests, spans = ([], [], []), [], []
        for text in batch.column("_text").to_pylist():
            found = scan(text)
            base = [x for x in found if x[1] < 3]
            for kind in range(3):
                counts[kind].append(sum(x[1] == kind for x in base))
            digests.append(hashlib.sha256(span_text(base).encode()).hexdigest())
            spans.append([
                {"start": s, "kind": k, "end": e, "secret": hashlib.sha256(v.encode()).hexdigest()} for s, k, e, v in found
            ])
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(n) for n in carried], *[pa.array(c, pa.int64()) for c in counts],
             pa.array(digests, pa.string()), pa.array(spans, pa.list_(pa.struct(fields)))],
            names=[*carried, "n_assign", "n_access", "n_hex", "base_sha256", "_found"],
        )


def scan_secrets(
    documents: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    owner_col: str = "source",
    repository_col: str | None = None,
    example_owners: int = EXAMPLE_OWNERS,
    example_repositories: int = EXAMPLE_REPOSITORIES,
) -> DataFrame:
    """Spans of secrets, one row per row of ``documents``.

    ``doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_live, n_example, live``. ``spans`` has the base
    spans and, of the method's own candidates, those that are live: held by one owner only, or by fewer than
    ``example_owners`` distinct owners in fewer than ``example_repositories`` distinct repositories. ``live`` has the (start, end, owners, repositories) of all live spans. A null text is
    empty; a null owner is an owner of its own; without ``repository_col`` each document is a repository.
    Rows that repeat id and text count as one repository. Owners and repositories are counted over all rows:
    candidates are first combined per (secret, owner, repository), so a secret with many copies is spread
    over the tasks by its repositories, and then counted with partial sums.
    """
    text = text_of(text_col)
    repository = F.col(repository_col).cast("string") if repository_col else id_of(id_col).cast("string")
    rows = documents.select(
        id_of(id_col).alias("_id"),
        text.alias("_text"),
        F.xxhash64(text).alias("_text_hash"),
        F.coalesce(F.concat(F.lit("="), F.col(owner_col).cast("string")), F.lit("")).alias("_owner"),
        F.coalesce(repository, F.lit("")).alias("_repository"),
    )
    scanned = stored(rows.mapInArrow(_scan_batches, SCAN_SCHEMA))
    held = scanned.select(
        F.explode(F.array_distinct(F.transform("_found", lambda x: x["secret"]))).alias("secret"),
        "_owner", "_repository", "_id", "_text_hash",
    )
    frequency = (
        held.groupBy("secret", "_owner", "_repository").agg(F.lit(1).alias("one"))
        .groupBy("secret", "_owner").agg(F.count("*").alias("repositories"))
        .groupBy("secret").agg(F.count("*").alias("owners"), F.sum("repositories").alias("repositories"))
    )
    per_text = (
        held.select("secret", "_id", "_text_hash").distinct()
        .join(frequency, "secret")
        .groupBy("_id", "_text_hash")
        .agg(F.collect_list(F.struct("secret", "owners", "repositories")).alias("_known"))
    )
    joined = scanned.join(per_text, ["_id", "_text_hash"], "left")
    known = F.transform(
        F.col("_found"),
        lambda x: F.struct(
            x["start"].alias("start"), x["kind"].alias("kind"), x["end"].alias("end"),
            F.get(F.filter("_known", lambda k: k["secret"] == x["secret"]), F.lit(0)).alias("of"),
        ),
    )
    judged = joined.withColumn("_judged", known)
    is_live = lambda x: (x["of"]["owners"] < 2) | (
        (x["of"]["owners"] < example_owners) & (x["of"]["repositories"] < example_repositories)
    )
    named = lambda x: F.concat_ws(
        ":", F.get(F.array(*[F.lit(k) for k in KINDS]), x["kind"]), x["start"].cast("string"), x["end"].cast("string")
    )
    return judged.select(
        id_or_null().alias("doc_id"), "n_assign", "n_access", "n_hex", "base_sha256",
        F.array_join(F.transform(F.filter("_judged", lambda x: (x["kind"] < 3) | is_live(x)), named), ",").alias("spans"),
        F.size(F.filter("_judged", is_live)).cast("long").alias("n_live"),
        F.size(F.filter("_judged", lambda x: ~is_live(x))).cast("long").alias("n_example"),
        F.transform(
            F.filter("_judged", is_live),
            lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), x["of"]["owners"].alias("owners"),
                               x["of"]["repositories"].alias("repositories")),
        ).alias("live"),
        F.col("_text_hash").alias("text_hash"),
    )


MASK = "[secret]"


def redact_live(
    documents: DataFrame, example_owners: int = EXAMPLE_OWNERS, example_repositories: int = EXAMPLE_REPOSITORIES
) -> DataFrame:
    """``documents`` with every live span of its ``text`` replaced by ``[secret]`` and ``n_chars`` counted anew.

    Documents without live spans, and all other columns, stay as they are. Overlapping spans become one mask.
    Bits of a fixed number tell which documents may have some; only those are shuffled to meet their spans.
    """
    spans = stored(
        scan_secrets(documents, example_owners=example_owners, example_repositories=example_repositories)
        .filter("n_live > 0")
        .select(
            F.coalesce("doc_id", F.lit(NULL_ID)).alias("_id"), F.col("text_hash").alias("_text_hash"),
            F.transform("live", lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"))).alias("_live"),
        )
        .dropDuplicates(["_id", "_text_hash"])
    )
    names = documents.columns
    bits = bitmap(spans.select(row_place("_id", "_text_hash").alias("place")), ROW_BITS)

    def may_have(place: pd.Series) -> pd.Series:
        return pd.Series(has_bit(np.frombuffer(bits, dtype=np.uint8), place.to_numpy()))

    boxed = documents.select(
        id_of("doc_id").alias("_id"), F.xxhash64(text_of("text")).alias("_text_hash"),
        F.struct(*names).alias("_row"), F.col("text").cast("string").alias("_t"),
    ).withColumn("_may", F.pandas_udf(may_have, "boolean")(row_place("_id", "_text_hash")))
    rows = boxed.filter("_may").join(spans, ["_id", "_text_hash"], "left")
    masked = F.aggregate(
        "_live",
        F.struct(F.lit("").alias("out"), F.lit(0).alias("at")),
        lambda acc, s: F.when(s["start"] >= acc["at"], F.struct(
            F.concat(acc["out"], F.substring("_t", acc["at"] + 1, s["start"] - acc["at"]), F.lit(MASK)).alias("out"),
            s["end"].alias("at"),
        )).otherwise(F.struct(acc["out"].alias("out"), F.greatest(acc["at"], s["end"]).alias("at"))),
        lambda acc: F.concat(acc["out"], F.substring("_t", acc["at"] + 1, F.length("_t"))),
    )
    clean = F.col("_live").isNull()
    out = rows.withColumn("_new", F.when(clean, F.col("_t")).otherwise(masked))
    columns = {c: F.col(f"_row.{c}") for c in names} | {"text": F.col("_new")}
    if "n_chars" in names:
        counted = F.when(clean, columns["n_chars"]).otherwise(F.length("_new"))
        columns["n_chars"] = counted.cast(documents.schema["n_chars"].dataType)
    # Columns that are worked out anew have the same types in both parts.
    others = {c: F.col(f"_row.{c}") for c in names} | {"text": F.col("_t")}
    return (
        boxed.filter("NOT _may").select(*[others[c].alias(c) for c in names])
        .unionByName(out.select(*[columns[c].alias(c) for c in names]))
    )
