"""Secret scan with multipart credential linking (operator 7).

Strong patterns are reported wherever they match.  Weak ones (user names,
long random strings, endpoints) are common in clean text and are reported only
when the parts that complete a credential stand within ``scope`` characters:
a weak key needs an identifier or an endpoint, a weak identifier needs a
secret, an endpoint needs both an identifier and a secret.

The parts of a text are joined on their intervals by sorting them by start:
of each role, the part that ends last before and the one that starts first
after are the only ones that need comparing, so a text with k parts takes
k log k steps and no pair is written out.

Places come from the lengths of the matches and of the texts between them,
summed up over the matches of a text, so a match costs the same wherever it is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.llm.common import stage, text_key

# --- fixed values: base patterns, in the order in which kinds are listed --------
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_VALUE = 6
ACCESS = r"AKIA[A-Z0-9]{16,}"  # AKIA[A-Z0-9]+ of 20 or more: a run is matched to its end either way
HEX = r"[0-9a-f]{24,}"  # the same for runs of 24 or more
BASE_KINDS = ["assign", "access", "hex"]

#: Weak patterns: identifiers, random strings with letters and digits, endpoints.
USER = r"""(?i:user(?:_?name)?|login|client_?id|key_?id)["']?\x20*[:=]\x20*["']?[A-Za-z0-9._@-]{3,}"""
KEY = r"[A-Za-z0-9+/]{32,}={0,2}"
ENDPOINT = (r"""(?:https?|s?ftp|ssh|postgres(?:ql)?|mysql|mongodb|redis|amqp)://[^\x20\x09-\x0D"'<>]+"""
            r"|[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?::[0-9]{2,5})?")
PATTERNS = {"assign": ASSIGN, "access": ACCESS, "hex": HEX, "user": USER, "key": KEY, "endpoint": ENDPOINT}
KINDS = list(PATTERNS)
ROLE = {"assign": "secret", "hex": "secret", "key": "secret", "access": "identifier", "user": "identifier", "endpoint": "endpoint"}

SPANS = "array<struct<start: bigint, kind: int, end: bigint>>"


def _accepted(kind: str, match: Column) -> Column:
    if kind == "assign":
        return F.length(F.regexp_extract(match, ASSIGN, 2)) >= ASSIGN_VALUE
    if kind == "key":
        return match.rlike("[0-9]") & match.rlike("[A-Za-z]")
    return F.lit(True)


def _found(text: Column, kind: str) -> Column:
    """Matches of a kind in order: characters since the last match, own
    characters, accepted or not.  Null without a match."""
    matches = F.regexp_extract_all(text, F.lit(PATTERNS[kind]), F.lit(0))
    gaps = F.split(text, PATTERNS[kind], -1)
    both = F.zip_with(matches, F.slice(gaps, 1, F.greatest(F.size(matches), F.lit(1))), lambda m, g: F.struct(
        F.length(g).alias("gap"), F.length(m).alias("len"), _accepted(kind, m).alias("ok")))
    return F.when(F.size(matches) > 0, both)


def scan(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``text_key`` and the raw
    matches of each kind (null without one)."""
    t = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.col(doc_id).alias("doc_id"), text_key(F.col(text)).alias("text_key"),
                       *[_found(t, k).alias(k) for k in KINDS])


def parts(scanned: DataFrame) -> DataFrame:
    """Rows ``doc_id, text_key, kind, start, end`` (code points, end exclusive)
    of the accepted matches, once for equal rows."""
    matched = scanned.filter(F.coalesce(*[F.size(k) > 0 for k in KINDS], F.lit(False))).dropDuplicates(["doc_id", "text_key"])
    rows = None
    for n, kind in enumerate(KINDS):
        own = matched.select("doc_id", "text_key", F.lit(n).alias("kind"), F.posexplode(kind).alias("k", "m"))
        rows = own if rows is None else rows.unionByName(own)
    upto = W.partitionBy("doc_id", "text_key", "kind").orderBy("k").rowsBetween(W.unboundedPreceding, W.currentRow)
    end = F.sum(F.col("m.gap") + F.col("m.len")).over(upto)
    return (rows.withColumn("end", end).filter("m.ok")
            .select("doc_id", "text_key", "kind", (F.col("end") - F.col("m.len")).alias("start"), "end"))


def link(found: DataFrame, scope: int = 300) -> DataFrame:
    """The rows of :func:`parts` to report: the base kinds, and weak parts that
    overlap no base part and have their complement within ``scope``."""
    base = F.col("kind") < len(BASE_KINDS)
    order = W.partitionBy("doc_id", "text_key").orderBy("start", "kind")
    before, after = order.rowsBetween(W.unboundedPreceding, -1), order.rowsBetween(1, W.unboundedFollowing)
    marked = found.withColumns({
        "in_base": (F.max(F.when(base, F.col("end"))).over(before) > F.col("start"))
        | (F.min(F.when(base, F.col("start"))).over(after) < F.col("end"))})
    marked = marked.filter(base | ~F.coalesce("in_base", F.lit(False))).drop("in_base")
    near = {}
    for role in ("identifier", "secret", "endpoint"):
        own = F.col("kind").isin([n for n, k in enumerate(KINDS) if ROLE[k] == role])
        gap_before = F.col("start") - F.max(F.when(own, F.col("end"))).over(before)
        gap_after = F.min(F.when(own, F.col("start"))).over(after) - F.col("end")
        near[role] = F.coalesce(F.least(gap_before, gap_after) <= scope, F.lit(False))
    linked = marked.withColumns({f"near_{r}": c for r, c in near.items()})
    kind = F.col("kind")
    report = (base | ((kind == KINDS.index("user")) & F.col("near_secret"))
              | ((kind == KINDS.index("key")) & (F.col("near_identifier") | F.col("near_endpoint")))
              | ((kind == KINDS.index("endpoint")) & F.col("near_identifier") & F.col("near_secret")))
    return linked.filter(report).select(*found.columns)


def text_spans(scanned: DataFrame, scope: int = 300) -> DataFrame:
    """Rows ``doc_id, text_key, found``: the sorted spans to report of each
    distinct text that has any."""
    return link(parts(scanned), scope).groupBy("doc_id", "text_key").agg(
        F.sort_array(F.collect_list(F.struct("start", "kind", "end"))).alias("found"))


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    name = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(name, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def _with_spans(rows: DataFrame, spans: DataFrame) -> DataFrame:
    s = spans.withColumnsRenamed({"doc_id": "__id", "text_key": "__key", "found": "__found"})
    joined = rows.join(s, (rows["text_key"] == s["__key"]) & rows["doc_id"].eqNullSafe(s["__id"]), "left")
    return joined.withColumn("found", F.coalesce("__found", F.array().cast(SPANS))).drop("__id", "__key", "__found")


def find_secrets(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", scope: int = 300) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``found`` (spans by start, then
    kind), ``n_assign, n_access, n_hex``, ``base_sha256`` and ``spans``.

    Null and empty texts have no spans; equal spans of different kinds are all
    kept; repeated rows and null ids each give a row; an empty table gives an
    empty table; other columns are left out."""
    scanned = stage(scan(docs, text, doc_id), "secret_matches")
    rows = _with_spans(scanned.select("doc_id", "text_key"), text_spans(scanned, scope))
    base = F.filter("found", lambda s: s["kind"] < len(BASE_KINDS))
    kinds = F.transform("found", lambda s: s["kind"])
    counts = {f"n_{k}": (F.size("found") - F.size(F.array_remove(kinds, n))).cast("long") for n, k in enumerate(BASE_KINDS)}
    return rows.select("doc_id", "found", *[c.alias(n) for n, c in counts.items()],
                       F.sha2(span_text(base), 256).alias("base_sha256"), span_text(F.col("found")).alias("spans"))


def redact(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", scope: int = 300, mark: str = "[secret]") -> DataFrame:
    """``docs`` with every reported span of ``text`` replaced by ``mark``
    (overlapping spans by one).  Rows without spans stay as they are."""
    scanned = stage(scan(docs, text, doc_id), "secret_matches")
    keyed = docs.withColumn("__text_key", text_key(F.col(text)))
    spans = text_spans(scanned, scope).withColumnsRenamed({"doc_id": "__id", "text_key": "__key", "found": "__found"})
    joined = keyed.join(spans, (keyed["__text_key"] == spans["__key"]) & keyed[doc_id].eqNullSafe(spans["__id"]), "left")
    t = F.col(text)
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))
    folded = F.aggregate("__found", start, lambda acc, s: F.struct(
        F.greatest(acc["at"], s["end"]).alias("at"),
        F.when(s["start"] < acc["at"], acc["out"])
        .otherwise(F.concat(acc["out"], F.substring(t, acc["at"].cast("int") + 1, (s["start"] - acc["at"]).cast("int")), F.lit(mark))).alias("out")),
        lambda acc: F.concat(acc["out"], F.substring(t, acc["at"].cast("int") + 1, F.length(t))))
    return joined.withColumn(text, F.when(F.col("__found").isNull(), t).otherwise(folded)).select(*docs.columns)
