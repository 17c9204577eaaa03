"""Secrets in texts: strong patterns, and weak parts that count only beside their complement.

Strong patterns are reported by themselves. Weak parts (access identifiers, credentials, opaque tokens, endpoints) are
joined with the other parts of their document by interval: a weak part is reported if a part of a complementary role
lies within ``scope`` code points of it. The join runs as ordered windows over each document's parts, so a document
with many parts costs a sort and never pairs. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyriver.llm.text import renamed

SCOPE = 256


def any_case(word: str) -> str:
    """A pattern of the word's ASCII letters in either case."""
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


def _assigned(keys: list[str], value: str) -> str:
    return f"(?:{'|'.join(keys)})" + r"""["']?\x20*[:=]\x20*["']?""" + f"({value})"


# Patterns by kind, in the order of the kinds.
_NAMES = [any_case(w) for w in ("password", "passwd", "secret", "token")] + [any_case("api") + "_?" + any_case("key")]
_IDENTIFIERS = [any_case(w) for w in ("username", "user", "login", "account")] + [
    any_case(a) + "_?" + any_case(b) for a, b in (("client", "id"), ("accesskey", "id"), ("access", "key"))
]
_CREDENTIALS = [any_case(w) for w in ("password", "passwd", "passphrase", "pass", "pwd", "secret", "token", "bearer", "auth")]
PATTERNS = {
    "assign": _assigned(_NAMES, "[A-Za-z0-9+/_.=-]+"),
    "access": "AKIA[A-Z0-9]+",
    "hex": "[0-9a-f]{32,}",
    "identifier": _assigned(_IDENTIFIERS, "[A-Za-z0-9+/_.@=-]{3,}"),
    "credential": _assigned(_CREDENTIALS, "[A-Za-z0-9+/_.=-]{4,}"),
    "opaque": "[A-Za-z0-9+/]{24,}",
    "endpoint": r"""(?:https?|ftps?|sftp|ssh|s3|jdbc:[a-z]+|redis|mongodb|postgres|postgresql|mysql|amqp)://[^\x00-\x20"'<>]+""",
}
KINDS = list(PATTERNS)
BASE = KINDS[:3]
ROLES = {
    "assign": "secret", "access": "identifier", "hex": "secret", "identifier": "identifier", "credential": "secret",
    "opaque": "secret", "endpoint": "endpoint",
}
COMPLEMENTS = {"identifier": ["secret"], "secret": ["identifier", "endpoint"], "endpoint": ["secret"]}


def _accepted(kind: str, whole: Column, value: Column | None) -> Column:
    if kind == "assign":
        return F.length(value) >= 8
    if kind == "access":
        return F.length(whole) >= 16
    if kind == "opaque":
        return whole.rlike("[0-9]") & whole.rlike("[A-Za-z]")
    return F.lit(True)


def _found(text: Column, kind: str) -> Column:
    """All matches of a kind in order: length of the gap before and of the match, and whether it is accepted."""
    pattern = F.lit(PATTERNS[kind])
    gaps = F.split(text, PATTERNS[kind], -1)
    wholes = F.regexp_extract_all(text, pattern, F.lit(0))
    values = F.regexp_extract_all(text, pattern, F.lit(1)) if kind == "assign" else wholes
    # zipped before the lambda: what a lambda refers to outside itself is computed for every element
    zipped = F.slice(F.arrays_zip(gaps, wholes, values), 1, F.size(wholes))

    def row(match: Column, i: Column) -> Column:
        return F.struct(
            F.lit(KINDS.index(kind)).alias("kind"),
            i.alias("i"),
            F.length(match["0"]).alias("gap"),
            F.length(match["1"]).alias("size"),
            _accepted(kind, match["1"], match["2"]).alias("ok"),
        )

    parts = "array<struct<kind: int, i: int, gap: int, size: int, ok: boolean>>"
    return F.when(text.rlike(PATTERNS[kind]), F.transform(zipped, row).cast(parts)).otherwise(F.array().cast(parts))


def find_credentials(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scope: int = SCOPE) -> DataFrame:
    """Every document's ``doc_id`` and ``spans``: an array of (start, end, kind), ordered by start, then kind.

    Starts and ends count code points, ends exclusive. Matches of one kind do not overlap. Weak matches that overlap a
    strong one are left out; the others need a complement within ``scope`` code points: an identifier or an endpoint
    needs a secret, a secret needs an identifier or an endpoint, strong or weak.

    Defined cases: a null or empty text has no spans. Rows that repeat an id come back as often, each with the spans of
    its own text; null ids too. Further columns are ignored; an empty table gives an empty result.
    """
    source = renamed(docs, id=id_col, text=text_col).withColumn("text", F.coalesce("text", F.lit("")))
    parts = F.concat(*[_found(F.col("text"), kind) for kind in KINDS])
    # copies of a row are counted and come back at the end; texts go no further than this
    keyed = source.select("id", F.xxhash64("text").alias("hash"), F.length("text").alias("length"), parts.alias("parts"))
    each = keyed.groupBy("id", "hash", "length").agg(F.first("parts").alias("parts"), F.count(F.lit(1)).alias("copies"))

    key = ["id", "hash", "length"]
    rows = each.select(*key, "copies", F.explode_outer("parts").alias("p")).select(*key, "copies", "p.*")
    along = Window.partitionBy(*key, "kind").orderBy("i")
    end = F.sum(F.col("gap") + F.col("size")).over(along)
    rows = rows.withColumn("end", end).withColumn("start", F.col("end") - F.col("size"))
    rows = rows.withColumn("ok", F.coalesce("ok", F.lit(False)))

    def of_role(role: str) -> Column:
        return F.col("ok") & F.col("kind").isin([i for i, k in enumerate(KINDS) if ROLES[k] == role])

    before = Window.partitionBy(*key).orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, 0)
    after = Window.partitionBy(*key).orderBy("start", "kind").rowsBetween(0, Window.unboundedFollowing)
    strong = F.col("ok") & (F.col("kind") < len(BASE))
    bounds = {"strong_end": F.max(F.when(strong, F.col("end"))).over(before),
              "strong_start": F.min(F.when(strong, F.col("start"))).over(after)}
    rows = rows.withColumns(bounds)
    free = F.coalesce(F.col("strong_end") <= F.col("start"), F.lit(True)) & F.coalesce(
        F.col("strong_start") >= F.col("end"), F.lit(True)
    )
    rows = rows.withColumn("ok", F.col("ok") & (strong | free))
    sides = {}
    for role in COMPLEMENTS:
        sides[f"{role}_end"] = F.max(F.when(of_role(role), F.col("end"))).over(before)
        sides[f"{role}_start"] = F.min(F.when(of_role(role), F.col("start"))).over(after)
    rows = rows.withColumns(sides)

    def near(role: str) -> Column:
        behind = F.coalesce(F.col(f"{role}_end") >= F.col("start") - scope, F.lit(False))
        return behind | F.coalesce(F.col(f"{role}_start") <= F.col("end") + scope, F.lit(False))

    linked = F.lit(False)
    for role, others in COMPLEMENTS.items():
        beside = near(others[0])
        for other in others[1:]:
            beside = beside | near(other)
        linked = linked | (of_role(role) & beside)
    kept = F.col("ok") & ((F.col("kind") < len(BASE)) | linked)
    span = F.struct("start", "kind", "end")
    spans = F.array_sort(F.collect_list(F.when(kept, span)))
    result = rows.groupBy(*key).agg(spans.alias("spans"), F.first("copies").alias("copies"))
    names = F.array(*[F.lit(k) for k in KINDS])
    spans = F.transform(
        "spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.get(names, s["kind"]).alias("kind"))
    )
    whole = result.select(F.col("id").alias("doc_id"), spans.alias("spans"), F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return whole.select("doc_id", "spans")


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of all spans, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def credential_digest(found: DataFrame) -> DataFrame:
    """Numbers of the strong kinds, digest of the strong spans, and all spans as text."""
    base = F.filter("spans", lambda s: s["kind"].isin(BASE))

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    counts = [count(kind) for kind in BASE]
    digest = F.sha2(span_text(base).cast("binary"), 256).alias("base_sha256")
    return found.select("doc_id", *counts, digest, span_text(F.col("spans")).alias("spans"))
