"""Secrets in texts, with weak candidates linked across parts. DataFrame functions only.

Base findings stand by themselves: assignments of a value to a telling name, access identifiers, and
long hexadecimal runs. Weak candidates do not: a user or client name, a key-like value without a name, or an
endpoint is harmless alone. Each belongs to a side (identifier, secret, endpoint), spans an interval
around its place within its scope (a scope ends at a blank line), and is reported if parts of another
side that complete a credential fall into that interval: identifier and secret need each other, an endpoint
needs both.

The interval join does not form pairs. Parts are dealt into cells of one interval's length within their
scope, each cell keeps the outermost positions of each side, and a candidate looks up its own cell and the two
beside it. Cells hold one row whatever they contain, so crowded scopes cost no more than their parts.

Positions are code points, ends exclusive. Defined results: null and empty texts have no spans; repeated rows
each get the same result; a null doc_id is a value like any other; spans are sorted by start, then in the order
of KINDS, then by end.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from pulsefold.llm.tables import own_columns, stored

# The patterns of the base findings and the least length of what they find.
ASSIGN = r"""(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{24,}"
LEAST_VALUE, LEAST_ACCESS = 6, 20

# Weak parts: (kind, side, pattern).
WEAK = (
    ("login", "identifier", r"""\b(?:user|username|login|client_id|account)["']?\x20*[:=]\x20*["']?[A-Za-z0-9_.@-]{3,}"""),
    ("keylike", "secret", r"\b(?=[A-Za-z0-9+/]*[0-9])(?=[A-Za-z0-9+/]*[a-z])(?=[A-Za-z0-9+/]*[A-Z])[A-Za-z0-9+/]{32,}={0,2}"),
    ("endpoint", "endpoint", r"\b(?:https?|jdbc:[a-z]+|postgres|postgresql|mysql|mongodb|amqp|redis|s3)://[A-Za-z0-9_.:/@?&=%-]+"),
)
# A blank line ends a scope.
BREAK = r"\n[ \t\r]*\n"
KINDS = ("assign", "access", "hex", *[kind for kind, _, _ in WEAK])
BASE_SIDES = {"assign": "secret", "access": "identifier", "hex": "secret"}
SIDES = ("identifier", "secret", "endpoint")


@dataclass(frozen=True)
class Settings:
    """`reach`: the code points between a candidate's start and the starts of the parts that complete it."""

    reach: int = 400


def steps(text: Column, kind: str, pattern: str, group: int) -> Column:
    """Array of (kind, nth, gap, size, value) for the matches of `pattern` from the left: the code points between
    the match before and this one, its own, and those of the group asked for.

    Cutting the text at its matches gives the gaps, so no match is searched for twice.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else found
    zipped = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), found.alias("found"), value.alias("value"))
    rows = F.transform(zipped, lambda x, i: F.struct(
        F.lit(kind).alias("kind"), i.alias("nth"), F.length(x["gap"]).alias("gap"), F.length(x["found"]).alias("size"), F.length(x["value"]).alias("value")))
    # The last gap has no match behind it.
    rows = F.filter(rows, lambda x: x["size"].isNotNull())
    return F.when(text.rlike(pattern), rows).otherwise(F.array().cast("array<struct<kind:string,nth:int,gap:int,size:int,value:int>>"))


def parts(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, kind, side, at, end, scope of every base finding and weak part.

    Positions and scopes are running sums within one document, over its matches only.
    """
    text = F.col("text")
    patterns = [("assign", ASSIGN, 1), ("access", ACCESS, 0), ("hex", HEX, 0), *[(kind, pattern, 0) for kind, _, pattern in WEAK]]
    anything = text.rlike("|".join(f"(?:{pattern})" for _, pattern, _ in patterns))
    found = F.flatten(F.array(*[steps(text, *p) for p in patterns], steps(text, "break", BREAK, 0)))
    rows = docs.where(anything).select("doc_id", "text_key", F.explode(found).alias("x")).select("doc_id", "text_key", "x.*")
    # Equal rows of `documents` have equal matches; they count once here and meet every equal row again at the end.
    rows = rows.distinct().repartition("doc_id", "text_key")
    before = Window.partitionBy("doc_id", "text_key", "kind").orderBy("nth").rowsBetween(Window.unboundedPreceding, 0)
    placed = rows.withColumn("end", F.sum(F.col("gap") + F.col("size")).over(before)).withColumn("at", F.col("end") - F.col("size"))
    above = Window.partitionBy("doc_id", "text_key").orderBy("at", "kind").rowsBetween(Window.unboundedPreceding, 0)
    placed = placed.withColumn("scope", F.sum((F.col("kind") == "break").cast("int")).over(above))
    sides = {**BASE_SIDES, **{kind: side for kind, side, _ in WEAK}}
    side = F.create_map(*[F.lit(x) for pair in sides.items() for x in pair])[F.col("kind")]
    fails = ((F.col("kind") == "assign") & (F.col("value") < LEAST_VALUE)) | ((F.col("kind") == "access") & (F.col("size") < LEAST_ACCESS))
    return placed.where((F.col("kind") != "break") & ~fails).select("doc_id", "text_key", "kind", side.alias("side"), "at", "end", "scope")


def completed(found: DataFrame, settings: Settings) -> DataFrame:
    """The weak parts of `found` whose complementary parts lie within `reach` in their scope."""
    reach = settings.reach
    dealt = found.withColumn("cell", F.floor(F.col("at") / reach))
    place = ["doc_id", "text_key", "scope", "cell"]
    outermost = []
    for side in SIDES:
        own = F.when(F.col("side") == side, F.col("at"))
        outermost += [F.min(own).alias(f"first_{side}"), F.max(own).alias(f"last_{side}")]
    cells = dealt.groupBy(*place).agg(*outermost).withColumnsRenamed({c: f"c_{c}" for c in place})
    weak = dealt.where(~F.col("kind").isin(*BASE_SIDES)).withColumn("near", F.explode(F.array(F.col("cell") - 1, F.col("cell"), F.col("cell") + 1)))
    looked = weak.join(cells, F.col("doc_id").eqNullSafe(F.col("c_doc_id")) & (F.col("text_key") == F.col("c_text_key"))
                       & (F.col("scope") == F.col("c_scope")) & (F.col("near") == F.col("c_cell")))
    seen = [
        F.max(F.coalesce((F.col(f"last_{side}") >= F.col("at") - reach) & (F.col(f"first_{side}") <= F.col("at") + reach), F.lit(False))).alias(f"has_{side}")
        for side in SIDES
    ]
    sides = looked.groupBy("doc_id", "text_key", "kind", "side", "at", "end").agg(*seen)
    return sides.where(
        ((F.col("side") != "secret") | F.col("has_identifier")) & ((F.col("side") != "identifier") | F.col("has_secret"))
        & ((F.col("side") != "endpoint") | (F.col("has_identifier") & F.col("has_secret")))
    ).select("doc_id", "text_key", "kind", "at", "end")


def scan(documents: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Every row of `documents` (doc_id, text): its doc_id, text_key, and `found`, the sorted array of (at, rank, end, kind)."""
    docs = own_columns(documents, "doc_id", "text").withColumn("text_key", F.xxhash64("text"))
    all_parts = stored(parts(docs), "parts")
    base = all_parts.where(F.col("kind").isin(*BASE_SIDES)).select("doc_id", "text_key", "kind", "at", "end")
    rank = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    spans = base.unionByName(completed(all_parts, settings)).groupBy("doc_id", "text_key").agg(
        F.array_sort(F.collect_list(F.struct("at", rank.alias("rank"), "end", "kind"))).alias("found"))
    spans = spans.withColumnsRenamed({"doc_id": "s_doc_id", "text_key": "s_text_key"})
    rows = docs.select("doc_id", "text_key")
    return rows.join(spans, rows["doc_id"].eqNullSafe(F.col("s_doc_id")) & (rows["text_key"] == F.col("s_text_key")), "left").select(
        "doc_id", "text_key", F.coalesce("found", F.array().cast("array<struct<at:bigint,rank:bigint,end:bigint,kind:string>>")).alias("found"))


def report(documents: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans for every row of `documents`."""
    def listing(found: Column) -> Column:
        return F.array_join(F.transform(found, lambda x: F.concat_ws(":", x["kind"], x["at"].cast("string"), x["end"].cast("string"))), ",")

    found = F.col("found")
    base = F.filter(found, lambda x: x["kind"].isin(*BASE_SIDES))
    def of(kind: str) -> Column:
        return F.size(F.filter(found, lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return scan(documents, settings).select("doc_id", *map(of, BASE_SIDES), F.sha2(listing(base), 256).alias("base_sha256"), listing(found).alias("spans"))


def masked(documents: DataFrame, settings: Settings = Settings(), mark: str = "[secret]") -> DataFrame:
    """`documents` with every span in `text` replaced by `mark`, other columns as they are.

    Only rows with spans are shuffled by their key; overlapping spans are replaced once.
    """
    # Helper columns whose names no column of the caller can have.
    helper = "_" * (1 + max(map(len, documents.columns)))
    key, own_id, own_key, found = (f"{helper}{k}" for k in ("key", "id", "of", "found"))
    spans = scan(documents.select("doc_id", "text"), settings).where(F.size("found") > 0).distinct()
    spans = spans.withColumnsRenamed({"doc_id": own_id, "text_key": own_key, "found": found})
    keyed = documents.withColumn(key, F.xxhash64("text"))
    both = keyed.join(spans, keyed["doc_id"].eqNullSafe(F.col(own_id)) & (F.col(key) == F.col(own_key)), "left")
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))

    def step(done: Column, x: Column) -> Column:
        """Text up to the span, then the mark; of a span that begins inside another only the rest goes."""
        gap = F.substring(F.col("text"), (done["at"] + 1).cast("int"), (x["at"] - done["at"]).cast("int"))
        return F.when(x["at"] >= done["at"], F.struct(x["end"].alias("at"), F.concat(done["out"], gap, F.lit(mark)).alias("out"))).otherwise(
            F.struct(F.greatest(done["at"], x["end"]).alias("at"), done["out"].alias("out")))

    walked = F.aggregate(found, start, step)
    rest = F.substring(F.col("text"), (walked["at"] + 1).cast("int"), F.length("text"))
    text = F.when(F.size(found) > 0, F.concat(walked["out"], rest)).otherwise(F.col("text"))
    return both.withColumn("text", text).select(*[F.col(f"`{c}`") for c in documents.columns])
