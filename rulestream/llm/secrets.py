"""Secrets in texts, told apart by who else has them."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rulestream.llm.common import free_name, kept

# The kinds in their order, their patterns and their least lengths.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
VALUE = 6

#: Kinds that ownership adds: a live-looking value of one owner or few, and a value that many owners have.
ADDED = ("owned", "copied")
#: What any text with a secret holds; the others are not searched further.
HINT = r"(?i:password|passwd|secret|token|api_?key)|AKIA[A-Z0-9]{16}|[0-9a-f]{24}"
PLACEHOLDER = re.compile(r"example|sample|dummy|placeholder|changeme|your[_-]|x{4}|1234567|abcdef", re.IGNORECASE)
FOUND = "array<struct<start: int, rank: int, end: int, value_start: int, value_end: int, value: string, live: boolean>>"


def base_spans(text: str) -> list[tuple[int, int, int, int, int]]:
    """The spans of a text, by start and kind: start, kind's rank, end, and the value's start and end."""
    spans = [(m.start(), 0, m.end(), m.start(2), m.end(2)) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= VALUE]
    for rank, pattern in ((1, ACCESS), (2, HEX)):
        spans += [(m.start(), rank, m.end(), m.start(), m.end()) for m in pattern.finditer(text)]
    return sorted(spans)


def looks_live(value: str, kind: str = "hex") -> bool:
    """Whether a value of a kind may be in use.

    An access key is, unless it is an example or a mask. So is an assigned value, unless it is a placeholder or a mask;
    passwords need neither digits nor letters. A bare value has to look random: long enough, with letters and digits of
    high entropy, no placeholder.
    """
    if kind == "access":
        return "EXAMPLE" not in value and len(set(value[4:])) > 1
    if kind == "assign":
        return not PLACEHOLDER.search(value) and len({c for c in value if c.isalnum()}) > 1
    if len(value) < 8 or not re.search(r"\d", value) or not re.search(r"[A-Za-z]", value) or PLACEHOLDER.search(value):
        return False
    shares = [n / len(value) for n in Counter(value).values()]
    return -sum(p * math.log2(p) for p in shares) >= 2.5


def row_hash(key: str, text: str) -> Column:
    return F.xxhash64(F.col(key), F.col(text))


def candidates(docs: DataFrame, key: str, text: str, owner: str, repository: str) -> DataFrame:
    """Every row with its base spans; its text is left out."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([(n, t) for n, t in zip(names, types, strict=True)]))
        for batch in batches:
            column = pc.fill_null(pc.cast(batch.column("_text"), pa.large_string()), "")
            hinted = pc.match_substring_regex(column, HINT).to_pylist()
            rows = []
            for at, hint in enumerate(hinted):
                body = column[at].as_py() if hint else ""
                spans = base_spans(body) if hint else []
                values = [body[s[3] : s[4]] for s in spans]
                rows.append(
                    [
                        dict(zip(names, (*span, hashlib.sha256(v.encode()).hexdigest(), looks_live(v, KINDS[span[1]])), strict=True))
                        for span, v in zip(spans, values, strict=True)
                    ]
                )
            rest = [batch.column(c) for c in passed]
            yield pa.RecordBatch.from_arrays([*rest, pa.array(rows, type=kind)], names=[*passed, "_found"])

    passed = ("_key", "_row", "_body", "_owner", "_repository")
    names = ("start", "rank", "end", "value_start", "value_end", "value", "live")
    types = (*[pa.int32()] * 5, pa.string(), pa.bool_())
    kind = docs.schema[key].dataType.simpleString()
    return docs.select(
        F.col(key).alias("_key"),
        row_hash(key, text).alias("_row"),
        F.xxhash64(text).alias("_body"),
        F.col(owner).cast("string").alias("_owner"),
        F.col(repository).cast("string").alias("_repository"),
        F.col(text).alias("_text"),
    ).mapInArrow(search, f"_key {kind}, _row BIGINT, _body BIGINT, _owner STRING, _repository STRING, _found {FOUND}")


def ownership(found: DataFrame) -> DataFrame:
    """Distinct repositories and owners of each value over the whole corpus: value, owners, repositories, most, uses.

    ``most`` is the number of repositories of the owner who has the value in most of them. Copies of one text count for
    its first owner and repository only, so that copying a document makes none of its values an example. Each step combines before its shuffle, and the first spreads a value that a third of all
    rows have by their texts. A null owner or repository counts as one of its own.
    """
    uses = found.select(F.explode("_found.value").alias("value"), "_body", F.struct("_owner", "_repository").alias("_place"))
    by_text = uses.groupBy("value", "_body").agg(F.min("_place").alias("_place"), F.count("*").alias("uses"))
    places = by_text.select("value", "_place.*", "uses")
    by_repository = places.groupBy("value", "_owner", "_repository").agg(F.sum("uses").alias("uses"))
    by_owner = by_repository.groupBy("value", "_owner").agg(F.count("*").alias("repositories"), F.sum("uses").alias("uses"))
    return by_owner.groupBy("value").agg(
        F.count("*").alias("owners"),
        F.sum("repositories").alias("repositories"),
        F.max("repositories").alias("most"),
        F.sum("uses").alias("uses"),
    )


def secret_spans(
    docs: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    owner: str = "source",
    repository: str = "source",
    copied: int = 3,
) -> DataFrame:
    """Every row with the secrets of its whole text: key, ``_row``, base, added.

    ``base`` holds the spans of the fixed patterns, sorted by start and kind: kind, start, end, value_start,
    value_end, value (SHA-256), live. ``added`` holds, for the value of each base span, a span of kind
    ``copied`` if many distinct owners have the value in texts of their own and none of them has more than half of
    its repositories, or ``owned`` if that is not so and it looks live for its kind, with the numbers of owners, repositories and
    uses in the corpus. Many are ``copied`` owners at least, or the binary logarithm of the owners of the corpus if that is more.
    Positions are code points, ends exclusive. Null and empty texts have no spans. Repeated rows give equal rows.
    """
    found = kept(candidates(docs, key, text, owner, repository), "candidates")
    counts = kept(ownership(found), "ownership")
    many = max(copied, found.select("_owner").distinct().count().bit_length() - 1)
    each = found.select("_key", "_row", F.inline("_found")).join(counts, "value")
    widely = (F.col("owners") >= many) & (2 * F.col("most") <= F.col("repositories"))
    kind = F.when(widely, F.lit(ADDED[1])).when(F.col("live"), F.lit(ADDED[0]))
    rank = len(KINDS) + F.when(widely, 1).otherwise(0)
    added = (
        each.select(
            F.col("_key").alias("_k"),
            F.col("_row").alias("_r"),
            F.struct(
                F.col("value_start").alias("start"), rank.alias("rank"), F.col("value_end").alias("end"),
                kind.alias("kind"), "value", "owners", "repositories", "uses",
            ).alias("span"),
        )
        .where("span.kind IS NOT NULL")
        .groupBy("_k", "_r")
        .agg(F.array_sort(F.collect_set("span")).alias("added"))
    )
    names = F.array(*map(F.lit, KINDS))
    base = F.transform("_found", lambda x: x.withField("kind", F.get(names, x["rank"])))
    joined = found.join(added, found["_key"].eqNullSafe(added["_k"]) & (found["_row"] == added["_r"]), "left")
    return joined.select(F.col("_key").alias(key), "_row", base.alias("base"), "added")


def joined_spans(spans: Column) -> Column:
    """Spans as kind:start:end, joined by commas."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def all_spans(base: Column, added: Column) -> Column:
    """Base and added spans together, by start, then kind."""

    def same(x: Column) -> Column:
        return F.struct(x["start"].alias("start"), x["rank"].alias("rank"), x["end"].alias("end"), x["kind"].alias("kind"))

    return F.array_sort(F.concat(F.transform(base, same), F.transform(F.coalesce(added, F.array()), same)))


def redacted(docs: DataFrame, spans: DataFrame, *, key: str = "doc_id", text: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """The documents with every owned secret of their spans replaced by a mark; other columns as they are."""
    owned = F.filter("added", lambda x: x["kind"] == ADDED[0])
    places = F.transform(owned, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end")))

    def merge(merged: Column, x: Column) -> Column:
        last = F.element_at(merged, -1)
        wider = F.struct(last["start"].alias("start"), F.greatest(last["end"], x["end"]).alias("end"))
        overlaps = (F.size(merged) > 0) & (x["start"] < F.try_element_at(merged, F.lit(-1))["end"])
        return F.when(overlaps, F.concat(F.slice(merged, 1, F.size(merged) - 1), F.array(wider))).otherwise(
            F.concat(merged, F.array(x))
        )

    empty = F.array().cast("array<struct<start: int, end: int>>")
    names = [free_name(docs, name) for name in ("_hash", "_key", "_own", "_spans")]
    number, own_key, own_number, found = names
    own = (
        spans.where(F.exists("added", lambda x: x["kind"] == ADDED[0]))
        .select(F.col(key).alias(own_key), F.col("_row").alias(own_number), F.aggregate(places, empty, merge).alias(found))
        .dropDuplicates([own_key, own_number])
    )
    rows = docs.withColumn(number, row_hash(key, text))
    same = F.col(key).eqNullSafe(F.col(own_key)) & (F.col(number) == F.col(own_number))
    cut = F.aggregate(
        F.reverse(found), F.col(text), lambda body, x: F.overlay(body, F.lit(mark), x["start"] + 1, x["end"] - x["start"])
    )
    clean = F.when(F.col(found).isNull(), F.col(text)).otherwise(cut)
    return rows.join(own, same, "left").withColumn(text, clean).select(*docs.columns)
