"""Secrets in documents, told from copied examples by who holds them (operator 11, native).

1. Base spans are the matches of three patterns over the whole text: assignments to
   names such as ``password``, access keys, hexadecimal keys. They always stay.
2. Candidates are further runs of at least 20 characters that look like a key: digits
   and letters of both cases, 12 different characters at least, not within a base span.
3. Over the whole corpus the hash of every value is counted by distinct owners and by
   distinct repositories of an owner. A value held by more than ``MAX_OWNERS`` owners or
   ``MAX_REPOSITORIES`` repositories is a widely copied example; others are live.
4. Live candidates are added as spans of kind ``owned``. Every span carries ``live``.

Only DataFrame functions are used. Splitting a text at a pattern and extracting its
matches gives their places: a match starts after all pieces and matches before it.
Counts are combined before each shuffle. A value that a third of all rows holds is dealt
by its hash and a salt where counts are joined to rows.

Cases: a null or empty text has no span. Rows are told apart by a number written with the
spans, so repeated rows and rows without an id each give a row; equal (owner, repository)
pairs count once, a null owner or repository counts as one. Spans are in code points, end
exclusive, ordered by start and then kind. Letters match in either case for A-Z only. An
empty table gives no row. Other columns are not read. Equality of values is that of
64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tellurion.llm.common import staged

ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: Whole runs of at least so many characters are the runs whose shorter ones are dropped.
ACCESS, HEX = r"AKIA[A-Z0-9]{16,}", r"[0-9a-f]{24,}"
CANDIDATE = r"[A-Za-z0-9+/_-]{20,}"
LEAST_VALUE, LEAST_DIFFERENT = 6, 12
KINDS = ("assign", "access", "hex", "owned")
OWNED = KINDS.index("owned")
MAX_OWNERS, MAX_REPOSITORIES = 2, 20
#: Places are summed in runs of so many matches.
RUN = 256
SALTS = 16

SPAN = "struct<start:bigint,kind:int,end:bigint,value:bigint>"


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once for the row."""
    return F.transform(F.array(value), body)[0]


def _total(sizes: Column) -> Column:
    return F.aggregate(sizes, F.lit(0).cast("long"), lambda total, size: total + size)


def sums_before(sizes: Column) -> Column:
    """For each place of an array the sum of all earlier elements."""

    def placed(own: Column, sums: Column) -> Column:
        return F.transform(
            own,
            lambda _, i: F.element_at(sums, (i / RUN).cast("int") + 1)
            + _total(F.slice(own, i - i % RUN + 1, i % RUN)),
        )

    def by_run(own: Column) -> Column:
        runs = F.transform(
            F.sequence(F.lit(0), (F.size(own) / RUN).cast("int")),
            lambda r: _total(F.slice(own, r * RUN + 1, RUN)),
        )
        return bound(
            runs,
            lambda totals: bound(
                F.transform(totals, lambda _, r: _total(F.slice(totals, F.lit(1), r))),
                lambda sums: placed(own, sums),
            ),
        )

    return bound(sizes, by_run)


def spans_of(text: Column, pattern: str, kind: int, value: Callable[[Column], Column]) -> Column:
    """All matches of a pattern as spans; ``value`` gives the secret within a match."""

    def built(found: Column) -> Column:
        sizes = F.transform(
            found["matches"], lambda m, i: (F.length(found["pieces"][i]) + F.length(m)).cast("long")
        )
        return bound(
            sums_before(sizes),
            lambda before: F.transform(
                found["matches"],
                lambda m, i: bound(
                    before[i] + F.length(found["pieces"][i]),
                    lambda start: F.struct(
                        start.alias("start"),
                        F.lit(kind).alias("kind"),
                        (start + F.length(m)).alias("end"),
                        value(m).alias("value"),
                    ),
                ),
            ),
        )

    found = F.struct(
        F.split(text, pattern, -1).alias("pieces"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("matches"),
    )
    none = F.array().cast(f"array<{SPAN}>")
    return bound(found, lambda f: F.when(F.size(f["matches"]) > 0, built(f)).otherwise(none))


def _assigned(match: Column) -> Column:
    """The value of an assignment, null if it is too short."""
    value = F.regexp_extract(match, "(?i)" + ASSIGN, 2)
    return F.when(F.length(value) >= LEAST_VALUE, F.xxhash64(value))


def _key_like(match: Column) -> Column:
    """The hash of a run that looks like a key, null for any other run."""
    mixed = match.rlike("[0-9]") & match.rlike("[A-Z]") & match.rlike("[a-z]")
    different = F.size(F.array_distinct(F.split(match, ""))) >= LEAST_DIFFERENT
    return F.when(mixed & different, F.xxhash64(match))


def _valued(spans: Column) -> Column:
    return F.filter(spans, lambda s: s["value"].isNotNull())


def located(text: Column) -> Column:
    """Base spans and candidates of a text, ordered by start and kind."""
    base = F.concat(
        _valued(spans_of(text, "(?i)" + ASSIGN, 0, _assigned)),
        spans_of(text, ACCESS, 1, F.xxhash64),
        spans_of(text, HEX, 2, F.xxhash64),
    )
    more = _valued(spans_of(text, CANDIDATE, OWNED, _key_like))

    def apart(own: Column) -> Column:
        return F.filter(
            more, lambda c: ~F.exists(own, lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"]))
        )

    return bound(base, lambda own: F.array_sort(F.concat(own, apart(own))))


def ownership(held: DataFrame) -> DataFrame:
    """Distinct owners and repositories of every value in ``value``, ``owner``, ``repository``."""
    by_repository = held.select("value", "owner", "repository").distinct()
    by_owner = by_repository.groupBy("value", "owner").agg(F.count(F.lit(1)).alias("repositories"))
    return by_owner.groupBy("value").agg(
        F.count(F.lit(1)).alias("owners"), F.sum("repositories").alias("repositories")
    )


def find_secrets(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    owner_col: str = "source",
    repository_col: str = "doc_id",
    max_owners: int = MAX_OWNERS,
    max_repositories: int = MAX_REPOSITORIES,
) -> DataFrame:
    """Each row's id and spans ``(start, kind, end, live)``: base ones and live candidates."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(owner_col).alias("owner"),
        F.col(repository_col).alias("repository"),
        located(text).alias("spans"),
    )
    # Written once, so the numbers of rows stay what they are.
    rows = staged(rows.withColumn("row", F.monotonically_increasing_id()), "secret-spans")

    held = rows.select("row", "owner", "repository", F.explode("spans.value").alias("value"))
    counted = ownership(held)
    live = counted.where(
        (F.col("owners") <= max_owners) & (F.col("repositories") <= max_repositories)
    ).select("value", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    dealt = held.select("row", "value", F.pmod(F.xxhash64("row"), F.lit(SALTS)).cast("int").alias("salt"))
    of_row = dealt.join(live, ["value", "salt"]).groupBy("row").agg(F.collect_set("value").alias("live"))

    def judged(span: Column) -> Column:
        return F.struct(
            span["start"].alias("start"),
            F.element_at(F.array(*(F.lit(k) for k in KINDS)), span["kind"] + 1).alias("kind"),
            span["end"].alias("end"),
            F.array_contains(F.col("live"), span["value"]).alias("live"),
        )

    joined = rows.join(of_row, "row", "left").withColumn(
        "live", F.coalesce("live", F.array().cast("array<bigint>"))
    )
    spans = F.filter(F.transform("spans", judged), lambda s: (s["kind"] != "owned") | s["live"])
    return joined.select("doc_id", spans.alias("spans"))


def written(spans: Column) -> Column:
    """Spans as ``kind:start:end``, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
