"""Secret scan with corpus-wide ownership frequency.

Every candidate (kind, place, hash of the credential itself) is found in whole texts.
The hashes are then counted over the corpus by distinct repositories and owners:

* ``example``  the same credential stands in ``MIN_REPOS`` repositories or more and with
  ``MIN_OWNERS`` owners or more: copied documentation, test vectors, license hashes.
  Many repositories of one owner, or many owners in one repository, are no example;
* ``live``     it is rarer and looks like key material (length and entropy);
* ``weak``     it is rarer but does not.

Only distinct (hash, repository, owner) triples are counted, after a map-side combine,
so one credential in a third of all documents is no hot task.  The driver sees nothing.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import held

MIN_OWNERS = MIN_REPOS = 3
LIVE_LENGTH, LIVE_ENTROPY = 12, 3.0

#: Kinds in the order in which spans with the same start are listed.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
STEMS = ("password", "passwd", "secret", "token", "api")

SPAN = ("struct<kind:string,start:int,end:int,value_start:int,value_end:int,"
        "hash:binary,live_looking:boolean>")
SPAN_TYPE = pa.list_(pa.struct([
    ("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()),
    ("value_start", pa.int32()), ("value_end", pa.int32()),
    ("hash", pa.binary()), ("live_looking", pa.bool_())]))


def candidates(text: str | None) -> list[tuple[str, int, int, int, int]]:
    """``(kind, start, end, value start, value end)`` by start, then kind, in code points.

    ACCESS and HEX ask for the least length at once: a run that is too short fails
    wherever it is entered.  An assignment whose value is too short is still passed over.
    """
    if not text:
        return []
    found = []
    low = text.lower()
    if any(stem in low for stem in STEMS):
        found += [("assign", *m.span(), *m.span(2)) for m in ASSIGN.finditer(text)
                  if m.end(2) - m.start(2) >= 6]
    found += [("access", *m.span(), *m.span()) for m in ACCESS.finditer(text)]
    found += [("hex", *m.span(), *m.span()) for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def looks_live(value: str) -> bool:
    n = len(value)
    entropy = -sum(c / n * math.log2(c / n) for c in Counter(value).values())
    return n >= LIVE_LENGTH and entropy >= LIVE_ENTROPY


def _scan(columns: int, keep_text: bool, only: bool | None):
    """Appends ``__spans`` to rows whose last column is the text; ``only``: rows with / without."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = []
            for text in batch.column(columns - 1):
                text = text.as_py()
                spans.append([{
                    "kind": kind, "start": a, "end": b, "value_start": x, "value_end": y,
                    "hash": hashlib.sha256(text[x:y].encode("utf-8", "surrogatepass")).digest()[:16],
                    "live_looking": looks_live(text[x:y]),
                } for kind, a, b, x, y in candidates(text)])
            out = pa.RecordBatch.from_arrays(
                [*batch.columns[:columns if keep_text else columns - 1], pa.array(spans, SPAN_TYPE)],
                [*batch.schema.names[:columns if keep_text else columns - 1], "__spans"])
            yield out if only is None else out.filter(pa.array([bool(s) == only for s in spans]))
    return run


def _scanned(docs: DataFrame, text: str, keep_text: bool, only: bool | None = None) -> DataFrame:
    last = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c != text], F.col(f"`{text}`"))
    kept = last.schema.fields[:len(last.columns) if keep_text else -1]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    return last.mapInArrow(_scan(len(last.columns), keep_text, only),
                           f"{schema + ', ' if kept else ''}__spans array<{SPAN}>")


def ownership(spans: DataFrame, min_owners: int = MIN_OWNERS, min_repos: int | None = None) -> DataFrame:
    """``hash, n_repos, n_owners, copied`` from rows ``hash, repo, owner``; both counts decide.

    Where ``min_repos`` is not given, it is ``min_owners``.
    """
    least = min_owners if min_repos is None else min_repos
    return (spans.select("hash", "repo", "owner").distinct().groupBy("hash")
            .agg(F.count_distinct("repo").alias("n_repos"), F.count_distinct("owner").alias("n_owners"))
            .withColumn("copied", (F.col("n_owners") >= min_owners) & (F.col("n_repos") >= least)))


def owner_of(repo: Column) -> Column:
    """The part of a repository name before the first slash; all of it without one."""
    return F.substring_index(repo, "/", 1)


def _classed(found: DataFrame, min_owners: int, min_repos: int | None) -> DataFrame:
    """Adds ``n_repos, n_owners, class`` to the spans of rows ``uid, repo, owner, spans``; ``found`` is a written table."""
    each = found.select(
        "uid", F.coalesce("repo", F.lit("")).alias("repo"), F.coalesce("owner", F.lit("")).alias("owner"),
        F.posexplode("spans").alias("at", "s")).withColumn("hash", F.col("s.hash"))
    # Written, so that Spark can split the join on a credential that stands everywhere.
    counted = held(ownership(each, min_owners, min_repos), "owners")
    label = (F.when(F.col("copied"), "example").when(F.col("s.live_looking"), "live").otherwise("weak"))
    span = F.col("s").withField("n_repos", F.col("n_repos")).withField("n_owners", F.col("n_owners")).withField(
        "class", label)
    known = (each.select("uid", "at", "s", "hash").join(counted, "hash")
             .select("uid", F.struct("at", span.alias("s")).alias("p"))
             .groupBy("uid").agg(F.array_sort(F.collect_list("p")).alias("p")))      # the spans of one row
    return found.drop("spans").join(known, "uid").withColumn("spans", F.col("p.s")).drop("p")


def find_secrets(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", repo: str = "source",
                 owner: Column | None = None, min_owners: int = MIN_OWNERS,
                 min_repos: int | None = None) -> DataFrame:
    """``doc_id, spans`` for every row; each span carries ``n_repos, n_owners, class`` of its credential.

    ``owner`` is an expression over ``docs``; without one it is the part of ``repo`` before a
    slash, so names without slashes are owners with one repository each.

    Null and empty texts have no spans.  A missing repository or owner counts as one
    nameless one.  Repeated rows each get their result.  Other columns are not looked at.
    """
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(repo).cast("string").alias("repo"),
        (owner_of(F.col(repo).cast("string")) if owner is None else owner).alias("owner"),
        F.col(text).alias("text"))
    found = held(_scanned(rows, "text", False).withColumnRenamed("__spans", "spans")
                 .withColumn("uid", F.monotonically_increasing_id()), "candidates")
    empty = found.where("size(spans) = 0").select(
        "doc_id", F.expr(f"cast(array() as array<{SPAN[:-1]},n_repos:bigint,n_owners:bigint,class:string>>)").alias("spans"))
    classed = _classed(found.where("size(spans) > 0"), min_owners, min_repos)
    return classed.select("doc_id", "spans").union(empty)


def _redact(columns: int, marks: dict[str, str | None]):
    """Rows end with text and spans; the credential itself is replaced by the mark of its class."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, spans in zip(batch.column(columns - 2).to_pylist(), batch.column(columns - 1).to_pylist()):
                parts, at = [], 0
                for s in sorted(spans, key=lambda s: (s["value_start"], -s["value_end"])):
                    mark = marks.get(s["class"])
                    if mark is None or s["value_end"] <= at:
                        continue
                    if s["value_start"] >= at:
                        parts += [text[at:s["value_start"]], mark]
                    at = s["value_end"]
                out.append("".join(parts) + text[at:])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:columns - 2], pa.array(out, pa.string())],
                batch.schema.names[:columns - 1])
    return run


def redact_secrets(docs: DataFrame, text: str = "text", repo: str = "source", owner: Column | None = None,
                   min_owners: int = MIN_OWNERS, min_repos: int | None = None, live: str | None = "[SECRET]",
                   weak: str | None = "[SECRET]", example: str | None = "[EXAMPLE]") -> DataFrame:
    """``docs`` with credentials replaced by the mark of their class (None: left as they are).

    Same columns in the same order.  Rows without candidates are passed through
    unchanged and never shuffled; null texts stay null.  Overlapping credentials
    are replaced together, by the mark of the first.
    """
    marks = {"live": live, "weak": weak, "example": example}
    who = owner_of(F.col(repo).cast("string")) if owner is None else owner
    own = [c for c in docs.columns if c != text]
    clean = _scanned(docs, text, True, only=False).select(*[F.col(f"`{c}`") for c in docs.columns])
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in own]).alias("row"),
                       F.col(repo).cast("string").alias("repo"), who.alias("owner"),
                       F.col(f"`{text}`").alias("text"))
    found = held(_scanned(rows, "text", True, only=True).withColumnRenamed("__spans", "spans")
                 .withColumn("uid", F.monotonically_increasing_id()), "candidates")
    classed = _classed(found, min_owners, min_repos).select("row", "text", "spans")
    done = classed.mapInArrow(_redact(3, marks), rows.select("row", "text").schema)
    return clean.unionByName(done.select("row.*", F.col("text").alias(text)))
