"""Find secrets in texts, and link the weak parts of credentials that are kept apart.

Three base kinds are reported wherever they stand: `assign` (a named value of eight
characters or more), `access` (a key identifier) and `hex` (a long hexadecimal number).

Other parts are too common to be reported alone: `identifier` (a named user, client or
key), `secret` (a long run of mixed letters and digits) and `endpoint` (a URL). They are
reported when complementary parts share a scope: no more than SCOPE code points lie between
the end of the one and the start of the other, however long either is. An identifier or an
endpoint is reported beside a secret, a secret beside an identifier or an endpoint. Base spans count as parts: `access` identifies, the others are
secrets. A weak part that overlaps a base span adds nothing and is left out.

The interval join is made on cells of SCOPE code points. A part lies in all cells that it
covers. Of each role only the first and the last code point in a cell that a part covers are
joined, which is all that the nearest neighbour depends on, so a text full of parts gives no
pairs of parts; a part looks into the cells that its scope reaches.

Only DataFrame functions are used. Positions come from the lengths of the pieces between
matches, summed up. Edge cases: a null text is empty; a text without spans has counts of
0, an empty `spans` and the digest of an empty text; an empty table gives no rows;
repeated rows give repeated results; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rentlake.llm.scratch import Scratch

SCOPE = 200
MASK = "[SECRET]"

# The base patterns, in the order in which spans of one start are listed.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{32,}"

# The weak parts. Words of an identifier may end longer ones, as in superuser.
IDENTIFIER = (
    r"""(?i:user|username|login|client_?id|account_?id|access_?key_?id|key_?id)"""
    r"""["']?\x20*[:=]\x20*["']?[A-Za-z0-9._@+-]{3,}"""
)
SECRET = r"[A-Za-z0-9+/_-]{20,}"
ENDPOINT = r"""[A-Za-z][A-Za-z0-9+.-]{0,30}://[^\x20\x09-\x0D"'<>]+"""

BASE = ("assign", "access", "hex")
KINDS = (*BASE, "identifier", "secret", "endpoint")
ROLES = {"assign": "secret", "access": "identifier", "hex": "secret"}
HITS = "array<struct<kind:string,at:int,gap:int,len:int,good:boolean>>"


def _hits(kind: str, pattern: str, good=None, first: Column | None = None) -> Column:
    """The matches of a pattern: number, code points since the match before, length, and
    whether the match counts. The patterns run again only on texts that match at all."""
    text = F.col("text")
    pieces = F.split(text, pattern, -1)
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    good = good or (lambda m: F.lit(True))
    pairs = F.zip_with(
        pieces, matches, lambda p, m: F.struct(F.length(p).alias("gap"), F.length(m).alias("len"), good(m).alias("good"))
    )
    hits = F.transform(
        F.filter(pairs, lambda s: s["len"].isNotNull()),
        lambda s, i: F.struct(F.lit(kind).alias("kind"), i.alias("at"), s["gap"].alias("gap"), s["len"].alias("len"), s["good"].alias("good")),
    )
    found = text.rlike(pattern) if first is None else first & text.rlike(pattern)
    return F.when(found, hits).otherwise(F.lit(None)).cast(HITS)


def _all_hits() -> Column:
    value = lambda m: F.length(F.regexp_extract(m, ASSIGN, 2)) >= 8
    mixed = lambda m: m.rlike("[0-9]") & m.rlike("[A-Z]") & m.rlike("[a-z]")
    text = F.col("text")
    kinds = [
        _hits("assign", ASSIGN, value),
        _hits("access", ACCESS, lambda m: F.length(m) >= 16, text.contains("AKIA")),
        _hits("hex", HEX),
        _hits("identifier", IDENTIFIER),
        _hits("secret", SECRET, mixed),
        _hits("endpoint", ENDPOINT, None, text.contains("://")),
    ]
    empty = F.array().cast(HITS)
    return F.concat(*(F.coalesce(k, empty) for k in kinds))


def candidate_parts(docs: DataFrame) -> DataFrame:
    """(row, doc_id, text_key, kind, start, end) of all matches that count; a text without any has one row without kind."""
    texts = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).withColumn(
        "row", F.monotonically_increasing_id()
    )
    hits = texts.select("row", "doc_id", F.xxhash64("text").alias("text_key"), F.explode_outer(_all_hits()).alias("h"))
    so_far = Window.partitionBy("row", "h.kind").orderBy("h.at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.sum(F.col("h.gap") + F.col("h.len")).over(so_far)
    return hits.select(
        "row",
        "doc_id",
        "text_key",
        F.col("h.good").alias("good"),
        F.col("h.kind").alias("kind"),
        (end - F.col("h.len")).alias("start"),
        end.alias("end"),
    )


def _weak_parts(parts: DataFrame) -> DataFrame:
    """Counting matches, without weak ones that overlap a base span, and the role of each."""
    base = F.col("kind").isin(*BASE)
    order = Window.partitionBy("row").orderBy("start")
    before = F.max(F.when(base, F.col("end"))).over(order.rangeBetween(Window.unboundedPreceding, Window.currentRow))
    after = F.min(F.when(base, F.col("start"))).over(order.rangeBetween(Window.currentRow, Window.unboundedFollowing))
    clash = F.coalesce(before > F.col("start"), F.lit(False)) | F.coalesce(after < F.col("end"), F.lit(False))
    role = F.col("kind")
    for kind, of in ROLES.items():
        role = F.when(F.col("kind") == kind, of).otherwise(role)
    return (
        parts.where("good")
        .withColumn("clash", clash)
        .where(base | ~F.col("clash"))
        .select("row", "kind", "start", "end", role.alias("role"), base.alias("base"))
    )


def linked_parts(parts: DataFrame) -> DataFrame:
    """(row, kind, start, end) of the weak parts with a complementary part in their scope."""
    first, last = F.floor(F.col("start") / SCOPE), F.floor((F.col("end") - 1) / SCOPE)
    evidence = (
        parts.select("row", F.col("role").alias("other"), "start", "end", F.explode(F.sequence(first, last)).alias("cell"))
        .groupBy("row", "other", "cell")
        .agg(
            F.min(F.greatest("start", F.col("cell") * SCOPE)).alias("low"),
            F.max(F.least("end", (F.col("cell") + 1) * SCOPE)).alias("high"),
        )
    )
    near = (F.col("low") <= F.col("end") + SCOPE) & (F.col("high") >= F.col("start") - SCOPE)
    reached = F.sequence(F.floor((F.col("start") - SCOPE - 1) / SCOPE), F.floor((F.col("end") + SCOPE) / SCOPE))
    complementary = F.when(F.col("role") == "secret", F.col("other") != "secret").otherwise(F.col("other") == "secret")
    return (
        parts.where(~F.col("base"))
        .withColumn("cell", F.explode(reached))
        .join(evidence, ["row", "cell"])
        .where(near & complementary)
        .select("row", "kind", "start", "end")
        .distinct()
    )


def _listed(spans: Column) -> Column:
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans, found, text_key) for every row of
    `docs` (doc_id, text). `found` has the spans as (start, rank, kind, end)."""
    scratch = Scratch(docs.sparkSession)
    rows = scratch.keep(candidate_parts(docs), "parts")
    parts = scratch.keep(_weak_parts(rows.where("kind is not null")), "roles")
    reported = linked_parts(parts).unionByName(parts.where("base").select("row", "kind", "start", "end"))
    every = rows.select("row", "doc_id", "text_key").distinct()
    rank = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    span = F.struct("start", rank.alias("rank"), "kind", "end")
    spans = reported.groupBy("row").agg(F.array_sort(F.collect_list(span)).alias("found"))
    found = F.coalesce("found", F.array().cast(spans.schema["found"].dataType))
    base = F.filter("found", lambda s: s["rank"] <= len(BASE))

    def number(kind: str) -> Column:
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return (
        every.join(spans, "row", "left")
        .withColumn("found", found)
        .select(
            "doc_id",
            *(number(kind) for kind in BASE),
            F.sha2(_listed(base), 256).alias("base_sha256"),
            _listed(F.col("found")).alias("spans"),
            "found",
            "text_key",
        )
    )


def redacted(docs: DataFrame) -> DataFrame:
    """`docs` with every reported span masked, and n_chars to match where there is such a column."""
    hits = scan(docs).where("spans != ''").select(F.struct("doc_id", "text_key").alias("_secret_key"), F.col("found").alias("_secret_found"))
    hits = hits.distinct()
    key = F.struct("doc_id", F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("text_key"))
    # Spans inside earlier ones are dropped, so that the ends grow with the starts.
    outer = F.expr(
        "aggregate(_secret_found, cast(array() as array<struct<start:bigint,end:bigint>>), (a, s) -> "
        "CASE WHEN size(a) > 0 AND a[size(a) - 1].end >= s.end THEN a "
        "ELSE concat(a, array(named_struct('start', s.start, 'end', s.end))) END)"
    )
    joined = docs.withColumn("_secret_key", key).join(hits, "_secret_key", "left").withColumn("_secret_spans", outer)
    ends = F.concat(F.array(F.lit(0).cast("long")), F.transform("_secret_spans", lambda s: s["end"]))
    starts = F.concat(F.transform("_secret_spans", lambda s: s["start"]), F.array(F.length("text").cast("long")))
    kept = F.zip_with(
        ends, starts, lambda e, s: F.substring(F.col("text"), (e + 1).cast("int"), F.greatest(s - e, F.lit(0)).cast("int"))
    )
    masked = F.when(F.col("_secret_found").isNull(), F.col("text")).otherwise(F.array_join(kept, MASK))
    out = joined.withColumn("text", masked)
    if "n_chars" in docs.columns:
        changed = F.when(F.col("_secret_found").isNull(), F.col("n_chars")).otherwise(F.length("text"))
        out = out.withColumn("n_chars", changed.cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)
