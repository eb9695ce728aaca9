"""Secret scans with multipart linking: weak parts of a credential count only next to complementary ones."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartrail.llm.common import settled

#: code points from the end of one part to the start of another within which they belong to one credential
SCOPE = 200


@dataclass(frozen=True)
class Part:
    """A kind of span: what finds it, what it is part of a credential as, and whether it is reported alone.

    ``least`` is the least length of the group numbered ``group`` (0: the match); shorter matches are dropped
    after they were found, so they still take their place in the text.
    """

    kind: str
    pattern: str
    role: str
    strong: bool
    group: int = 0
    least: int = 0


#: patterns of the strong kinds, in the order in which kinds are listed, then of the weak ones (fixed values)
PARTS = (
    Part(
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        "secret",
        True,
        2,
        8,
    ),
    Part("access", r"AKIA[A-Z0-9]{12,}", "identifier", True),
    Part("hex", r"[0-9a-f]{32,}", "secret", True),
    Part(
        "ident",
        r"""((?i:access_?key_?id|client_?id|user_?name|user|login|account))["']?\x20*[:=]\x20*["']?([A-Za-z0-9_.@-]+)""",
        "identifier",
        False,
        2,
        3,
    ),
    Part("key", r"(?<![A-Za-z0-9+/_.=-])[A-Za-z0-9+/]{40}(?![A-Za-z0-9+/_.=-])", "secret", False),
    Part("endpoint", r"""(?:https?|ftp|ssh|jdbc:[a-z]+|postgres|mysql|redis|amqp|mongodb)://[^\x20\x09-\x0D"'<>]+""", "endpoint", False),
)
ROLES = ("identifier", "secret", "endpoint")


def matches(text: Column, part: Part) -> Column:
    """For every match in order: the code points since the last one, its length, and whether it is long enough."""
    pattern = F.lit(part.pattern)
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    between = F.split(text, part.pattern, -1)

    def one(pair: Column, i: Column) -> Column:
        match, gap = pair["0"], pair["1"]
        whole = F.lit(True)
        if part.least:
            whole = F.length(F.regexp_extract(match, part.pattern, part.group)) >= part.least
        size = F.length(match).alias("size")
        return F.struct(F.lit(part.kind).alias("kind"), i.alias("i"), F.length(gap).alias("gap"), size, whole.alias("whole"))

    # what follows the last match has no match beside it
    pairs = F.filter(F.transform(F.arrays_zip(found, between), one), lambda m: m["size"].isNotNull())
    return F.when(F.size(found) > 0, pairs)


def spans(docs: DataFrame, text: Column, row: str, kept: list[Column]) -> tuple[DataFrame, DataFrame]:
    """The rows of ``docs`` with ``kept`` and a number ``row``, and their spans ``(row, kind, start, end)``.

    Texts are read once; what moves are lengths of matches and of what lies between them, added up in order.
    """
    content = F.coalesce(text, F.lit(""))
    every = [matches(content, part) for part in PARTS]
    listed = F.flatten(F.filter(F.array(*every), lambda a: a.isNotNull()))
    rows = settled(docs.select(*kept, F.monotonically_increasing_id().alias(row), listed.alias("__parts")))
    parts = rows.where(F.size("__parts") > 0).select(row, F.explode("__parts").alias("p")).select(row, "p.*")
    # a window holds the matches of one kind in one text
    so_far = Window.partitionBy(row, "kind").orderBy("i")
    end = F.sum(F.col("gap") + F.col("size")).over(so_far.rowsBetween(Window.unboundedPreceding, 0))
    placed = parts.withColumn("end", end).where("whole")
    return rows.drop("__parts"), placed.select(row, "kind", (F.col("end") - F.col("size")).alias("start"), "end")


def linked(found: DataFrame, row: str, scope: int = SCOPE) -> DataFrame:
    """The spans that are reported: strong ones, and weak ones whose scopes meet complementary parts.

    The scope of a span reaches ``scope`` code points to either side. A weak secret needs an identifier or an
    endpoint in its scope, a weak identifier a secret, an endpoint both a secret and an identifier. A weak span
    inside a strong one is part of it and not reported. Reported spans that are at most ``scope`` apart, from one to the
    next, are parts of one ``credential``, which has a number. The interval join is a sweep: with the spans of a text
    in order, the furthest end before and the nearest start after decide whether a role is within reach.
    """
    by_kind = {p.kind: p for p in PARTS}
    place = {p.kind: i for i, p in enumerate(PARTS)}
    kinds = F.create_map(*[x for k, i in place.items() for x in (F.lit(k), F.lit(i))])
    roles = F.create_map(*[x for k, p in by_kind.items() for x in (F.lit(k), F.lit(p.role))])
    strong = F.col("kind").isin([k for k, p in by_kind.items() if p.strong])
    marked = found.withColumn("place", kinds[F.col("kind")]).withColumn("role", roles[F.col("kind")]).withColumn("strong", strong)
    order = Window.partitionBy(row).orderBy("start", "place")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    # what follows is what came before in the opposite order, so each frame grows by one span a row
    after = Window.partitionBy(row).orderBy(F.col("start").desc(), F.col("place").desc()).rowsBetween(Window.unboundedPreceding, -1)
    near = {}
    for role in ROLES:
        last = F.max(F.when(F.col("role") == role, F.col("end"))).over(before)
        following = F.min(F.when(F.col("role") == role, F.col("start"))).over(after)
        near[role] = F.coalesce(F.col("start") - last <= scope, F.lit(False)) | F.coalesce(following - F.col("end") <= scope, F.lit(False))
    covered = F.coalesce(F.max(F.when(F.col("strong"), F.col("end"))).over(before) >= F.col("end"), F.lit(False))
    swept = marked.withColumns({f"near_{role}": c for role, c in near.items()}).withColumn("covered", covered)
    complete = (
        F.when(F.col("role") == "secret", F.col("near_identifier") | F.col("near_endpoint"))
        .when(F.col("role") == "identifier", F.col("near_secret"))
        .otherwise(F.col("near_secret") & F.col("near_identifier"))
    )
    reported = swept.where(F.col("strong") | (complete & ~F.col("covered")))
    # parts whose scopes meet are one credential, numbered in the order of the text
    reach = F.max("end").over(before)
    begins = F.coalesce(F.col("start") - reach > scope, F.lit(True)).cast("int")
    numbered = reported.withColumn("__begins", begins).withColumn("credential", F.sum("__begins").over(order).cast("int"))
    return numbered.select(row, "kind", "place", "start", "end", "strong", "role", "credential")


def scan(docs: DataFrame, scope: int = SCOPE, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, secrets`` of every document, ``secrets`` an array of ``(start, place, kind, end, strong, role,
    credential)``.

    Spans are in code points, the end exclusive, sorted by start, then by the order of ``PARTS``. NULL and
    empty texts have none. Repeated ids and equal rows are scanned each for itself, NULL ids as well; an empty
    table gives no rows; other columns are not looked at.
    """
    rows, found = spans(docs, F.col(f"`{text}`"), "__row", [F.col(f"`{doc_id}`").alias("doc_id")])
    one = F.struct("start", "place", "kind", "end", "strong", "role", "credential")
    # as many spans as one text holds
    listed = linked(found, "__row", scope).groupBy("__row").agg(F.sort_array(F.collect_list(one)).alias("secrets"))
    return rows.join(listed, "__row", "left").select("doc_id", F.coalesce("secrets", F.array().cast(listed.schema["secrets"].dataType)).alias("secrets"))


def span_text(secrets: Column, strong_only: bool = False) -> Column:
    """``kind:start:end`` of all spans, joined by commas."""
    chosen = F.filter(secrets, lambda s: s["strong"]) if strong_only else secrets
    return F.array_join(F.transform(chosen, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def credential_text(secrets: Column) -> Column:
    """The credentials that have parts of two roles or more: ``number=kind:start+kind:start``, joined by commas."""
    numbers = F.array_distinct(F.transform(secrets, lambda s: s["credential"]))

    def parts(number: Column) -> Column:
        return F.filter(secrets, lambda s: s["credential"] == number)

    linked_ = F.filter(numbers, lambda n: F.size(F.array_distinct(F.transform(parts(n), lambda s: s["role"]))) > 1)

    def shown(number: Column) -> Column:
        each = F.transform(parts(number), lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string")))
        return F.concat_ws("=", number.cast("string"), F.array_join(each, "+"))

    return F.array_join(F.transform(linked_, shown), ",")


def count_kind(secrets: Column, kind: str) -> Column:
    return F.size(F.filter(secrets, lambda s: s["kind"] == kind)).cast("long")
