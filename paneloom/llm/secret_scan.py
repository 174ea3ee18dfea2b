"""Secret scan with corpus-wide ownership frequency.

A first pass over the whole texts finds candidates: three base kinds, which always count, and stricter
added kinds. Hashes of their values are then counted over distinct owners and repositories: a value that
many owners carry is a widely copied example, and so is one in many repositories, even if one owner
has them all (forks, vendored samples); one that stays with few of both looks live. Added
candidates become findings only if they look live; every finding is marked live or example.

Only hashes, spans and counts leave the pass. Counting a value's repositories goes by (hash, owner,
repository), then (hash, owner), then hash, all mergeable, so a value in a third of all rows is no
hot group; the join back splits hot values at run time.

Definitions: null and empty texts have no findings; offsets are code points, end exclusive; matches of a
kind are leftmost and don't overlap, and failing ones still use up their text. A null owner or
repository counts as one of its own. Repeated rows are kept apart.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paneloom.llm.common import numbered, text_of

MOST_OWNERS = 2  # a value that more owners carry is a copied example
MOST_REPOS = 10  # and one in more repositories (an owner's ones counted apart), whoever owns them
# The kinds in the order in which they are listed; the first three are the base.
KINDS = ("assign", "access", "hex", "private_key", "web_token", "code_host", "chat", "login_url")
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
# runs of one class of characters are maximal, so a least length changes no other match
_PLAIN = {
    "access": re.compile(r"AKIA[A-Z0-9]{14,}"),
    "hex": re.compile(r"[0-9a-f]{16,}"),
    "private_key": re.compile(r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----[A-Za-z0-9+/=\s]{64,}"),
    "web_token": re.compile(r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{16,}"),
    "code_host": re.compile(r"gh[pousr]_[A-Za-z0-9]{36,}"),
    "chat": re.compile(r"xox[abprs]-[A-Za-z0-9-]{20,}"),
    "login_url": re.compile(r"[a-z][a-z0-9+.-]{1,15}://[^\s/:@]{1,64}:[^\s/:@]{6,64}@"),
}
_HINTS = {"private_key": "PRIVATE KEY", "web_token": "eyJ", "login_url": "://"}


def candidates(text: str) -> list[tuple[int, int, int, str]]:
    """(start, number of the kind, end, value) by start, then kind."""
    found = []
    for m in _ASSIGN.finditer(text):
        if len(m[2]) >= 12:
            found.append((m.start(), 0, m.end(), m[2]))
    for kind, pattern in _PLAIN.items():
        if kind in _HINTS and _HINTS[kind] not in text:
            continue
        number = KINDS.index(kind)
        found += [(m.start(), number, m.end(), m[0]) for m in pattern.finditer(text)]
    return sorted(found)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Columns id, owner, repo, text to the first three and the candidates."""
    span = pa.struct(
        [("start", pa.int32()), ("kind", pa.int32()), ("stop", pa.int32()), ("hash", pa.binary())]
    )
    for batch in batches:
        rows = [
            [
                {"start": s, "kind": k, "stop": e, "hash": hashlib.sha256(v.encode()).digest()[:16]}
                for s, k, e, v in candidates(text)
            ]
            if text
            else []
            for text in batch.column(3).to_pylist()
        ]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(i) for i in range(3)), pa.array(rows, pa.list_(span))],
            names=["id", "owner", "repo", "found"],
        )


def ownership(found: DataFrame) -> DataFrame:
    """(hash, owner, repo) to hash, owners, repos."""
    return (
        found.groupBy("hash", "owner", "repo")
        .agg(F.lit(1).alias("one"))
        .groupBy("hash", "owner")
        .agg(F.count("*").alias("repos"))
        .groupBy("hash")
        .agg(F.count("*").alias("owners"), F.sum("repos").alias("repos"))
    )


def scan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    owner_col: str = "source",
    repo_col: str = "doc_id",
    most_owners: int = MOST_OWNERS,
    most_repos: int = MOST_REPOS,
) -> DataFrame:
    """One row per row of ``docs``: doc_id and ``found``, an array by start, then kind, of
    (start, kind, stop, hash, owners, repos, live)."""
    rows = numbered(
        docs.select(
            F.col(id_col).cast("long").alias("id"),
            F.col(owner_col).cast("string").alias("owner"),
            F.col(repo_col).cast("string").alias("repo"),
            text_of(text_col).alias("text"),
        ).mapInArrow(
            _extract,
            "id long, owner string, repo string, "
            "found array<struct<start int, kind int, stop int, hash binary>>",
        )
    )
    single = rows.select("row_key", "owner", "repo", F.explode("found").alias("f")).select(
        "row_key", "owner", "repo", "f.*"
    )
    counted = ownership(single.select("hash", "owner", "repo"))
    judged = (
        single.join(counted, "hash")
        .withColumn("live", (F.col("owners") <= most_owners) & (F.col("repos") <= most_repos))
        .where(F.col("live") | (F.col("kind") < 3))
        .groupBy("row_key")
        .agg(
            F.sort_array(
                F.collect_list(
                    F.struct("start", "kind", "stop", "hash", "owners", "repos", "live")
                )
            ).alias("found")
        )
    )
    return rows.select("row_key", F.col("id").alias("doc_id")).join(judged, "row_key", "left").select(
        "doc_id",
        F.coalesce(
            "found",
            F.expr(
                "cast(array() as array<struct<start int, kind int, stop int, hash binary,"
                " owners bigint, repos bigint, live boolean>>)"
            ),
        ).alias("found"),
    )


def digest(found: DataFrame) -> DataFrame:
    """The findings of ``scan`` as counts, the digest of the base spans, all spans, live and examples."""

    def number(condition):
        return F.size(F.filter("found", condition)).cast("long")

    names = F.array(*[F.lit(k) for k in KINDS])

    def listed(spans):
        return F.array_join(
            F.transform(
                spans,
                lambda s: F.concat_ws(
                    ":", F.element_at(names, s.kind + 1), s.start.cast("string"), s.stop.cast("string")
                ),
            ),
            ",",
        )

    return found.select(
        "doc_id",
        number(lambda s: s.kind == 0).alias("n_assign"),
        number(lambda s: s.kind == 1).alias("n_access"),
        number(lambda s: s.kind == 2).alias("n_hex"),
        F.sha2(listed(F.filter("found", lambda s: s.kind < 3)).cast("binary"), 256).alias("base_sha256"),
        listed(F.col("found")).alias("spans"),
        number(lambda s: s.live).alias("n_live"),
        number(lambda s: ~s.live).alias("n_example"),
    )
