"""Secret scan on DataFrame functions alone: base patterns, and credentials put together from parts that lie close.

The text is scanned once per row in the JVM; what goes on is lengths. `split` and `regexp_extract_all` cut a text into gaps and
matches, and running sums of their lengths give every place in code points. Weak candidates (identifiers of other prefixes or
short ones, bare mixed tokens, service endpoints) are looked for only in texts that hold an identifier; each is reported when an
interval join finds the parts that complete it within `scope` characters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowsift.session import materialize

# The base patterns of the scan.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
ASSIGN_WORDS = ["password", "passwd", "secret", "token", "apikey", "api_key"]
# Weak parts, reported only in company.
WEAK_ID = r"\b(?:AKIA[A-Z0-9]{1,11}|(?:ASIA|AGPA|AIDA|AROA)[A-Z0-9]{8,})\b"
WEAK_KEY = r"(?<![A-Za-z0-9+/_.=-])(?=[a-z0-9+/]*+[A-Z])(?=[A-Z0-9+/]*+[a-z])(?=[A-Za-z+/]*+[0-9])[A-Za-z0-9+/]{20,}+={0,2}(?![A-Za-z0-9+/_=-])"
ENDPOINT = r"\bhttps?://[A-Za-z0-9.-]+(?::[0-9]+)?|(?<![A-Za-z0-9.@-])[a-z0-9-]+(?:\.[a-z0-9-]+)*\.amazonaws\.com"

KINDS = ["assign", "access", "hex", "weak_id", "weak_key", "endpoint"]
BASE = KINDS[:3]
#: A part may be so many characters away from what completes it.
SCOPE = 400


def _cut(text: Column, pattern: str, when: Column, value: int | None = None) -> Column:
    """Gap, length and length of group `value` of every match, as an array in order of place."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = found if value is None else F.regexp_extract_all(text, F.lit(pattern), F.lit(value))
    gaps = F.split(text, pattern, -1)
    rows = F.transform(
        F.arrays_zip(F.slice(gaps, F.lit(1), F.size(found)).alias("g"), found.alias("m"), values.alias("v")),
        lambda x: F.struct(F.length(x["g"]).alias("gap"), F.length(x["m"]).alias("size"), F.length(x["v"]).alias("value")),
    )
    return F.when(when, rows)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Matches of every row without their text: row number `row`, id, and an array of matches per kind."""
    text = F.coalesce(F.col("text"), F.lit(""))
    small, named = F.lower(text), F.lit(False)
    for word in ASSIGN_WORDS:
        named = named | F.contains(small, F.lit(word))
    owns_id = text.rlike(r"AKIA|ASIA|AGPA|AIDA|AROA")
    frame = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return frame.select(
        F.monotonically_increasing_id().alias("row"),
        "id",
        _cut(text, ASSIGN, named, 2).alias("assign"),
        _cut(text, ACCESS, F.contains(text, F.lit("AKIA"))).alias("access"),
        _cut(text, HEX, text.rlike(HEX)).alias("hex"),
        _cut(text, WEAK_ID, owns_id).alias("weak_id"),
        _cut(text, WEAK_KEY, owns_id).alias("weak_key"),
        _cut(text, ENDPOINT, owns_id).alias("endpoint"),
    )


def may_hold_secrets(text: Column) -> Column:
    """False only for texts in which no kind can match; cheap to test."""
    named = F.lit(False)
    for word in ASSIGN_WORDS:
        named = named | F.contains(F.lower(text), F.lit(word))
    return F.coalesce(named | text.rlike(r"AKIA|ASIA|AGPA|AIDA|AROA") | text.rlike(HEX), F.lit(False))


def _places(scanned: DataFrame) -> DataFrame:
    """One row per match: `row`, `kind` (number), `start`, `end`; base matches that fail their test are gone."""
    parts = F.array(
        *[F.struct(F.lit(i).alias("kind"), F.coalesce(F.col(k), F.expr("array()").cast("array<struct<gap:int,size:int,value:int>>")).alias("m"))
          for i, k in enumerate(KINDS)]
    )
    flat = scanned.select("row", F.explode(parts).alias("p")).select("row", "p.kind", F.posexplode("p.m").alias("pos", "m"))
    before = Window.partitionBy("row", "kind").orderBy("pos")
    end = F.sum(F.col("m.gap") + F.col("m.size")).over(before)
    placed = flat.select("row", "kind", (end - F.col("m.size")).alias("start"), end.alias("end"), F.col("m.value").alias("value"))
    return placed.where((F.col("kind") != 0) | (F.col("value") >= 8)).drop("value")


def _near(left: DataFrame, right: DataFrame, scope: int) -> DataFrame:
    """Rows of `left` with a row of `right` of the same text at most `scope` characters away and not overlapping.

    The distance is the gap: from the end of the earlier part to the start of the later one, however long either is. Interval
    join on bins as wide as the scope, by the two ends that face each other: on side 0 `right` comes first, its end is entered in
    its bin and the next, and meets the start of `left`; on side 1 its start is entered in its bin and the one before, and meets
    the end of `left`. A scope holds a bounded number of parts, so no bin of one text grows with the data.
    """
    of = lambda side, place, more=0: F.struct(F.lit(side).alias("side"), (F.floor(place / scope) + more).alias("bin"))
    one = left.withColumn("at", F.explode(F.array(of(0, F.col("start")), of(1, F.col("end")))))
    entries = F.explode(F.array(of(0, F.col("end")), of(0, F.col("end"), 1), of(1, F.col("start")), of(1, F.col("start"), -1)))
    two = right.select(F.col("row").alias("r"), F.col("start").alias("s"), F.col("end").alias("e"), entries.alias("near"))
    gap = F.when(F.col("at.side") == 0, F.col("start") - F.col("e")).otherwise(F.col("s") - F.col("end"))
    same = (F.col("row") == F.col("r")) & (F.col("at.side") == F.col("near.side")) & (F.col("at.bin") == F.col("near.bin"))
    return one.join(two, same & gap.between(0, scope), "left_semi").drop("at").distinct()


def link_parts(places: DataFrame, scope: int = SCOPE) -> DataFrame:
    """Weak parts that others complete: rows of `places` of the weak kinds.

    * A weak identifier needs a secret (assigned value or hex run) in its scope.
    * A bare key needs an identifier of either strength there.
    * An endpoint needs an identifier and a secret or bare key that is itself reported.
    """
    of = lambda *names: places.where(F.col("kind").isin([KINDS.index(n) for n in names]))
    strong_id, secret = of("access"), of("assign", "hex")
    ids = _near(of("weak_id"), secret, scope)
    keys = _near(of("weak_key"), strong_id.unionByName(of("weak_id")), scope)
    keys = _not_inside(keys, of("assign", "hex", "access"))
    points = _near(_near(of("endpoint"), strong_id.unionByName(ids), scope), secret.unionByName(keys), scope)
    return ids.unionByName(keys).unionByName(points)


def _not_inside(parts: DataFrame, others: DataFrame) -> DataFrame:
    """Parts that overlap no other."""
    o = others.select(F.col("row").alias("r"), F.col("start").alias("s"), F.col("end").alias("e"))
    return parts.join(o, (F.col("row") == F.col("r")) & (F.col("s") < F.col("end")) & (F.col("start") < F.col("e")), "left_anti")


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scope: int = SCOPE) -> DataFrame:
    """Every row with its spans: `id_col` and `spans`, an array of (kind, start, end) by start and kind.

    Places are code points, the end exclusive. Base kinds: `assign` (a named value of 8 characters or more), `access`, `hex`;
    `weak_id`, `weak_key` and `endpoint` only in company (`link_parts`). Null and empty texts have an empty array. Repeated rows
    and rows with a null id come back one by one; other columns are not read; an empty table gives an empty result.
    """
    scanned = materialize(scan(docs, id_col, text_col), "scan")
    any_match = " or ".join(f"size({k}) > 0" for k in KINDS)
    places = materialize(_places(scanned.where(any_match)), "places")
    spans = places.where(F.col("kind") < len(BASE)).unionByName(link_parts(places, scope))
    gathered = spans.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", "kind", "end"))).alias("found"))
    names = F.array(*[F.lit(k) for k in KINDS])
    joined = scanned.select("row", "id").join(gathered, "row", "left")
    empty = F.expr("array()").cast("array<struct<start:bigint,kind:int,end:bigint>>")
    return joined.select(
        F.col("id").alias(id_col),
        F.transform(
            F.coalesce("found", empty),
            lambda x: F.struct(F.get(names, x["kind"]).alias("kind"), x["start"].alias("start"), x["end"].alias("end")),
        ).alias("spans"),
    )


def span_text(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def redact(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with every stretch of overlapping spans replaced by `mark`. Spans come in order of their start."""
    runs = F.aggregate(
        spans,
        F.expr("array()").cast("array<struct<start:bigint,end:bigint>>"),
        lambda done, x: F.when(
            (F.size(done) > 0) & (x["start"] < F.element_at(done, -1)["end"]),
            F.concat(
                F.slice(done, F.lit(1), F.size(done) - 1),
                F.array(F.struct(F.element_at(done, -1)["start"].alias("start"), F.greatest(F.element_at(done, -1)["end"], x["end"]).alias("end"))),
            ),
        ).otherwise(F.concat(done, F.array(F.struct(x["start"].alias("start"), x["end"].alias("end"))))),
    )
    ends = F.transform(runs, lambda x: x["end"])
    starts = F.transform(runs, lambda x: x["start"])
    cuts = F.arrays_zip(
        F.concat(F.array(F.lit(0).cast("bigint")), ends).alias("a"), F.concat(starts, F.array(F.length(text).cast("bigint"))).alias("z")
    )
    kept = F.transform(cuts, lambda x: F.substring(text, (x["a"] + 1).cast("int"), (x["z"] - x["a"]).cast("int")))
    return F.when(F.size(spans) > 0, F.array_join(kept, mark)).otherwise(text)


def redact_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size_col: str = "n_chars", scope: int = SCOPE) -> DataFrame:
    """Rows of `docs`, all their columns, with every secret in their text replaced by a mark and `size_col` (if there) renewed.

    Only texts that may hold a secret are joined with their spans, by id and text, so repeated rows and null ids are safe.
    """
    suspect = may_hold_secrets(F.col(text_col))
    key = F.struct(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("hash"))
    found = find_secrets(docs.where(suspect).select(key.alias("key"), F.col(text_col).alias("text")), "key", "text", scope)
    found = found.where(F.size("spans") > 0).groupBy("key").agg(F.first("spans").alias("spans"))
    rows = docs.where(suspect).select(F.struct(*docs.columns).alias("row"), key.alias("key")).join(found, "key", "left")
    text = redact(F.col(f"row.{text_col}"), F.coalesce("spans", F.expr("array()").cast(found.schema["spans"].dataType)))
    size = F.when(F.size("spans") > 0, F.length(text)).otherwise(F.col(f"row.{size_col}")) if size_col in docs.columns else None
    new = {text_col: text, size_col: size}
    columns = [
        (new[c].cast(docs.schema[c].dataType) if c in new else F.col("row").getField(c)).alias(c) for c in docs.columns
    ]
    return docs.where(~suspect).unionByName(rows.select(*columns))
