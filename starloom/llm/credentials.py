"""Secret scan by corpus-wide ownership frequency.

Candidates are values that look like credentials: the value of a password or
token assignment, access-key ids, long hexadecimal runs, and other long runs
of letters mixed with digits. Their hashes are counted over the whole corpus by
distinct repositories and owners. A value that many owners hold is a copied
example; one that a single owner holds in few repositories looks live; the
rest, a single owner's value in many repositories included, is unsure. Of the last, wide group of
candidates only live values are reported; spans of the first three kinds always
are, with their judgement beside them.

Offsets count code points, ends are exclusive. Matches are found left to right
without overlap, each kind by itself.

Defined results: a null text is empty; a null owner is one owner of its own, a
null repository likewise; repeated rows are scanned each by itself and count as
one repository; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.common import digest, free_name, numbered, with_few
from starloom.sources.workspace import Workspace

# Kind: pattern, group that holds the value, least length of that value. Fixed values.
KINDS = {
    "assign": (
        r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
        2,
        6,
    ),
    "access": (r"AKIA[A-Z0-9]+", 0, 20),
    "hex": (r"(?<![0-9a-f])[0-9a-f]{24,}", 0, 24),
    "live": (r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*[0-9])(?=[0-9+/_=-]*[A-Za-z])[A-Za-z0-9+/_=-]{16,}", 0, 16),
}
BASE = ("assign", "access", "hex")

# A value is live while one owner holds it in fewer repositories than these, an
# example from this many owners on. In between, and where one owner has it in
# many repositories, the copies speak for an example and the owner for a live value.
EXAMPLE_OWNERS = 3
MANY_REPOSITORIES = 20
MASK = "[SECRET]"


def matches(docs: DataFrame, row: str, owner: str, repository: str, work: Workspace) -> DataFrame:
    """(row, doc_id, owner, repo, one list of matches per kind or null), stored: a row per document."""
    text = F.coalesce(F.col("text"), F.lit(""))
    found = []
    for kind, (pattern, group, _) in KINDS.items():
        p = F.lit(pattern)
        cells = F.arrays_zip(
            F.transform(F.split(text, pattern, -1), lambda x: F.char_length(x)).alias("gap"),
            F.regexp_extract_all(text, p, F.lit(0)).alias("whole"),
            F.regexp_extract_all(text, p, F.lit(group)).alias("value"),
        )
        found.append(F.when(text.rlike(pattern), cells).alias(kind))
    holder = F.coalesce(F.col(owner).cast("string"), F.lit("")).alias("owner")
    return work.write(docs.select(row, "doc_id", holder, digest(F.col(repository)).alias("repo"), *found), "matches")


def candidates(hits: DataFrame, row: str, work: Workspace) -> DataFrame:
    """(row, owner, repo, kind, kind_no, start, end, hash): every match that is long enough, stored.

    Offsets are running sums of the lengths between and of the matches, per document.
    """
    each = None
    for number, (kind, (_, _, least)) in enumerate(KINDS.items()):
        one = hits.filter(F.col(kind).isNotNull()).select(row, "owner", "repo", F.posexplode(kind).alias("k", "m"))
        one = one.select(
            row,
            "owner",
            "repo",
            F.lit(kind).alias("kind"),
            F.lit(number).alias("kind_no"),
            "k",
            F.col("m.gap").alias("gap"),
            F.coalesce(F.char_length("m.whole"), F.lit(0)).alias("length"),
            F.col("m.value").alias("value"),
            (F.char_length("m.value") >= least).alias("good"),
        )
        each = one if each is None else each.unionByName(one)
    before = Window.partitionBy(row, "kind_no").orderBy("k")
    end = F.sum(F.col("gap") + F.col("length")).over(before)
    placed = each.withColumn("end", end).filter("good")
    placed = placed.select(
        row, "owner", "repo", "kind", "kind_no", (F.col("end") - F.col("length")).cast("bigint").alias("start"),
        F.col("end").cast("bigint").alias("end"), digest(F.col("value")).alias("hash"),
    )
    return work.write(placed, "candidates")


def ownership(found: DataFrame) -> DataFrame:
    """(hash, owners, repositories): in how many distinct places each value occurs.

    Repeats go first, inside the tasks: a value that fills a third of all rows
    leaves each task once per owner and repository.
    """
    places = found.groupBy("hash", "owner", "repo").agg(F.count("*").alias("n"))
    by_owner = places.groupBy("hash", "owner").agg(F.count("*").alias("repositories"))
    return by_owner.groupBy("hash").agg(F.count("*").alias("owners"), F.sum("repositories").alias("repositories"))


def scan(hits: DataFrame, row: str, work: Workspace) -> DataFrame:
    """(row, kind, kind_no, start, end, owners, repositories, judgement): the spans reported.

    ``judgement`` is ``live``, ``example`` or, between the two, ``unsure``.
    A live run that a span of another kind overlaps is not reported twice.
    """
    found = candidates(hits, row, work)
    known = work.write(ownership(found), "ownership")
    owners = F.col("owners")
    narrow = (owners == 1) & (F.col("repositories") < MANY_REPOSITORIES)
    judgement = F.when(narrow, "live").when(owners >= EXAMPLE_OWNERS, "example").otherwise("unsure")
    judged = found.join(known, "hash").withColumn("judgement", judgement)
    judged = judged.filter(F.col("kind").isin(*BASE) | (F.col("judgement") == "live"))
    judged = work.write(judged.select(row, "kind", "kind_no", "start", "end", "owners", "repositories", "judgement"), "judged")
    work.discard("candidates")
    work.discard("ownership")
    # Furthest end of the base spans that start before, nearest base start from here on.
    base_end = F.max(F.when(F.col("kind").isin(*BASE), F.col("end")))
    base_start = F.min(F.when(F.col("kind").isin(*BASE), F.col("start")))
    order = Window.partitionBy(row).orderBy("start", "kind_no")
    earlier = base_end.over(order.rowsBetween(Window.unboundedPreceding, -1))
    later = base_start.over(order.rowsBetween(1, Window.unboundedFollowing))
    overlaps = (F.coalesce(earlier, F.lit(0)) > F.col("start")) | (F.coalesce(later, F.col("end")) < F.col("end"))
    return judged.withColumn("overlaps", overlaps).filter(F.col("kind").isin(*BASE) | ~F.col("overlaps")).drop("overlaps")


def _listed(spans: Column) -> Column:
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def report(docs: DataFrame, work: Workspace, owner: str = "source", repository: str = "doc_id") -> DataFrame:
    """One row per document: doc_id, spans by start and kind, the counts by kind and
    judgement, and how many owners and repositories the most common of its values has."""
    row = free_name(docs, "row_number_")
    rows = matches(docs.withColumn(row, F.monotonically_increasing_id()), row, owner, repository, work)
    spans = scan(rows, row, work)
    listed = spans.groupBy(row).agg(
        F.array_sort(F.collect_list(F.struct("start", "kind_no", "end", "kind", "judgement", "owners", "repositories"))).alias("spans")
    )
    span = "start:bigint,kind_no:int,end:bigint,kind:string,judgement:string,owners:bigint,repositories:bigint"
    empty = F.array().cast(f"array<struct<{span}>>")
    joined = rows.select(row, "doc_id").join(listed, row, "left").withColumn("spans", F.coalesce("spans", empty))

    def count(field: str, value: str) -> Column:
        return F.size(F.filter("spans", lambda s: s[field] == value)).cast("bigint")

    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    return joined.select(
        "doc_id",
        *[count("kind", kind).alias(f"n_{kind}") for kind in BASE],
        F.sha2(_listed(base), 256).alias("base_sha256"),
        _listed(F.col("spans")).alias("spans"),
        count("judgement", "live").alias("n_live"),
        count("judgement", "example").alias("n_example"),
        count("judgement", "unsure").alias("n_unsure"),
        F.coalesce(F.array_max("spans.owners"), F.lit(0)).alias("most_owners"),
        F.coalesce(F.array_max("spans.repositories"), F.lit(0)).alias("most_repositories"),
    )


def redact(docs: DataFrame, work: Workspace, owner: str = "source", repository: str = "doc_id") -> DataFrame:
    """``docs`` with every span but copied examples masked in ``text``."""
    stored, row = numbered(docs, work, "rows")
    spans = scan(matches(stored, row, owner, repository, work), row, work).filter("judgement <> 'example'")
    work.discard("matches")
    order = Window.partitionBy(row).orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    reached = spans.withColumn("reached", F.coalesce(F.max("end").over(order), F.lit(0).cast("bigint")))
    cuts = free_name(stored, "cuts")
    listed = reached.groupBy(row).agg(F.array_sort(F.collect_list(F.struct("start", "end", "reached"))).alias(cuts))
    listed = work.write(listed, "cuts")
    text = F.col("text")

    def before(s: Column) -> Column:
        """The text from the last masked place up to this span, and its mask."""
        gap = text.substr((s["reached"] + 1).cast("int"), F.greatest(s["start"] - s["reached"], F.lit(0)).cast("int"))
        return F.when(s["start"] >= s["reached"], F.concat(gap, F.lit(MASK))).otherwise(F.lit(""))

    last = F.array_max(F.transform(cuts, lambda s: s["end"]))
    masked = F.concat(F.array_join(F.transform(cuts, before), ""), text.substr((last + 1).cast("int"), F.char_length(text)))
    joined = with_few(stored, listed, row, F.size(cuts) * 32 + 32).withColumn("text", F.when(F.col(cuts).isNull(), text).otherwise(masked))
    return joined.select(*docs.columns)
