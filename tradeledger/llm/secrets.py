"""Secret scans: candidates by pattern, told apart by how many owners hold the same value.

Fixed kinds of candidates are always reported. Further opaque tokens are candidates too: they are
reported only if the value belongs to one owner, as a credential in use does. A value that many owners
hold, that several owners hold alike, or that stands in a large part of an owner's texts is a copied
example or a template. Only hashes of values leave the scan.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeledger.llm.batches import add_fields, pick
from tradeledger.session import cut_lineage

ASSIGN = re.compile(
    r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
OPAQUE = re.compile(r"[A-Za-z0-9+/_-]{20,}")

#: Kinds in the order of a tie; opaque tokens are the one that owner counts decide.
KINDS = ("assign", "access", "hex", "opaque")

#: Least Shannon entropy (bits a character) of an opaque token.
LEAST_ENTROPY = 3.5

#: Owners of a credential; the part of its repositories that its main owner must hold at least.
MOST_OWNERS, MAIN_SHARE = 2, 2 / 3

#: Part of the main owner's repositories beyond which a value is a template of that owner, and the number of
#: repositories that says nothing yet, however few the owner has. The limit grows with the owner.
TEMPLATE_SHARE, FEW_REPOSITORIES = 0.1, 100


def _opaque(value: str) -> bool:
    """Upper case, lower case and digits mixed, and close to random."""
    if not (re.search("[a-z]", value) and re.search("[A-Z]", value) and len(re.findall("[0-9]", value)) >= 3):
        return False
    n = len(value)
    return -sum(c / n * math.log2(c / n) for c in Counter(value).values()) >= LEAST_ENTROPY


def candidates(text: str) -> list[tuple[str, int, int, int]]:
    """(kind, start, end, hash of the value), code points, sorted by start and kind."""
    found = []
    for m in ASSIGN.finditer(text):
        if len(m[2]) >= 12:
            found.append(("assign", m.start(), m.end(), m[2]))
    if "AKIA" in text:
        found += [("access", m.start(), m.end(), m[0]) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    found += [("hex", m.start(), m.end(), m[0]) for m in HEX.finditer(text)]
    base = [(a, b) for _, a, b, _ in found]
    for m in OPAQUE.finditer(text):
        if _opaque(m[0]) and not any(a < m.end() and m.start() < b for a, b in base):
            found.append(("opaque", m.start(), m.end(), m[0]))
    found.sort(key=lambda x: (x[1], KINDS.index(x[0])))
    return [(k, a, b, xxhash.xxh3_64_intdigest(v.encode()) - 2**63) for k, a, b, v in found]


def scan(docs: DataFrame, keep: list[str]) -> DataFrame:
    """Columns ``keep`` and ``found``, the candidates of each text; a NULL text has none."""
    kind = pa.list_(
        pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("value", pa.int64())])
    )
    ddl = "array<struct<kind:string,start:bigint,end:bigint,value:bigint>>"

    def work(texts):
        out = []
        for text in texts.to_pylist():
            hits = candidates(text) if text else []
            out.append([{"kind": k, "start": a, "end": b, "value": v} for k, a, b, v in hits])
        return (out,)

    return add_fields(docs, ["text"], keep, [("found", ddl, kind)], work)


def ownership(found: DataFrame) -> DataFrame:
    """Owners and repositories of each candidate value, and what its main owner holds of both.

    value, owners, repositories, ``most`` (repositories of the owner that has most of them) and ``size``
    (all repositories of that owner, with candidates or without; the largest of equal owners). NULL counts
    as an owner and as a repository. Equal (value, owner, repository) rows meet before the shuffle, so a value in
    a third of all rows costs one row per task, owner and repository.
    """
    held = found.select(F.explode("found.value").alias("value"), "owner", "repository").distinct()
    by_owner = held.groupBy("value", "owner").agg(F.count(F.lit(1)).alias("repositories"))
    sizes = found.select("owner", "repository").distinct().groupBy("owner").agg(F.count(F.lit(1)).alias("size"))
    sizes = sizes.withColumnRenamed("owner", "owner_")
    sized = by_owner.join(sizes, F.col("owner").eqNullSafe(F.col("owner_")))
    main = F.max(F.struct("repositories", "size"))
    by_value = sized.groupBy("value").agg(
        F.count(F.lit(1)).alias("owners"), F.sum("repositories").alias("repositories"), main.alias("main")
    )
    return by_value.select(
        "value", "owners", "repositories", F.col("main.repositories").alias("most"), F.col("main.size").alias("size")
    )


def scan_secrets(
    docs: DataFrame,
    id_column: str = "doc_id",
    owner: str = "source",
    repository: str | None = None,
    most_owners: int = MOST_OWNERS,
    main_share: float = MAIN_SHARE,
    template_share: float = TEMPLATE_SHARE,
    few: int = FEW_REPOSITORIES,
) -> DataFrame:
    """One row per row of docs: the id and ``secrets``, sorted by start and kind.

    A secret has kind, start, end (code points, end exclusive), owners, repositories and ``live``: true if
    at most ``most_owners`` owners hold its value, one of them has ``main_share`` of its repositories or
    more, and these are at most ``few`` or ``template_share`` of all that this owner has. Opaque tokens are
    listed only if live. Repositories are counted per owner: equal names under two owners are two. Without a
    ``repository`` column they are the distinct texts, so copies count once.
    A NULL or empty text has no secrets; repeated rows get a row each.
    """
    rows = pick(docs, *dict.fromkeys([id_column, "text", owner, *([repository] if repository else [])]))
    place = F.col(repository) if repository else F.xxhash64("text")
    rows = rows.select(
        F.col(id_column).alias("id"), "text", F.col(owner).alias("owner"), place.alias("repository")
    )
    found = scan(rows, ["id", "owner", "repository"])
    # Row numbers are fixed by the written stage, so every later reading agrees on them.
    stage = cut_lineage(found.withColumn("row", F.monotonically_increasing_id()))
    held = ownership(stage)
    spans = stage.where(F.size("found") > 0).select("row", F.explode("found").alias("s"))
    own = (F.col("owners") <= most_owners) & (F.col("most") >= main_share * F.col("repositories"))
    live = own & (F.col("most") <= F.greatest(F.lit(float(few)), template_share * F.col("size")))
    judged = (
        spans.withColumn("value", F.col("s.value"))
        .join(held, "value")
        .withColumn("live", live)
        .where((F.col("s.kind") != "opaque") | F.col("live"))
    )
    order = F.array_position(F.array(*map(F.lit, KINDS)), F.col("s.kind"))
    secret = F.struct(
        F.col("s.start").alias("start"), order.alias("place"), F.col("s.kind").alias("kind"),
        F.col("s.end").alias("end"), "owners", "repositories", "live",
    )
    listed = judged.groupBy("row").agg(F.sort_array(F.collect_list(secret)).alias("secrets"))
    out = stage.select("row", "id").join(listed, "row", "left")
    none = F.array().cast(listed.schema["secrets"].dataType)
    return out.select(F.col("id").alias(id_column), F.coalesce("secrets", none).alias("secrets"))
