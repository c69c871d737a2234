"""Secret scan with corpus-wide ownership frequency, DataFrame operations only.

Base rules, leftmost and non-overlapping per kind (``KINDS``): assignments,
access keys, long hex strings.  The method adds a fourth kind, ``mixed``:
40+ characters of ``[A-Za-z0-9+/_-]`` (and padding) that hold upper case, lower case
and digits.  Every candidate's value is hashed; per hash the corpus gives the number
of distinct repositories and owners.  A value in more than ``max_repos`` repositories
(however few their owners) or with more than ``max_owners`` owners is a widely copied
example, any other is owner-specific and live-looking.  Base spans always stay;
``mixed`` ones stay only when they are owner-specific.

Positions come from two passes of one pattern: the pieces between the matches
(``split``) and the matches (``regexp_extract_all``) alternate, so a running sum of
their code points gives every start.  Rows whose text has no match of a kind
skip both.

Plan: one pass over the texts leaves a narrow table of spans per row (written
once).  Candidates are hashed and counted as (hash, repository, owner) groups
first, which is summed before each shuffle; the counts meet the candidates
in a join on the hash that adaptive execution can split when one value
is everywhere; the classes go back to the rows by row number.

Edge cases: a null text is empty (no spans); a null repository or owner is one
value of its own; repeated rows are scanned each; columns of any other name
are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scenecast.llm.common import let, require, stored


@dataclass(frozen=True)
class Kind:
    """A pattern, the group that is the secret's value, and its least length."""

    name: str
    pattern: str
    value_group: int
    least: int


# The base rules.  Matches that are too short are dropped after
# matching, so what they cover is not matched again.
KINDS = (
    Kind("assign", r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?"
                   r"([A-Za-z0-9+/_.=-]+)", 1, 6),
    Kind("access", r"AKIA[A-Z0-9]+", 0, 20),
    Kind("hex", r"[0-9a-f]{24,}", 0, 24),
    Kind("mixed", r"[A-Za-z0-9+/_-]{40,}={0,2}", 0, 40),
)
BASE = ("assign", "access", "hex")
# A credential goes along with a few copies of its text (in the given tables up to 6
# repositories); examples stand in 51 or more.
MAX_REPOS, MAX_OWNERS = 10, 3
RUN = 128            # pieces whose running sums are taken together


def _mixed_ok(value: Column) -> Column:
    return value.rlike("[A-Z]") & value.rlike("[a-z]") & value.rlike("[0-9]")


def _sums(numbers: Column) -> Column:
    """0 and the running sums of a short array."""
    return F.aggregate(numbers, F.array(F.lit(0)), lambda acc, x: F.concat(
        acc, F.array(F.element_at(acc, -1) + x)))


def _placed(pieces: Column, kind: Kind, order: int) -> Column:
    """Spans from pieces (text before, match, value).

    An accumulator is copied at every step, so the running sums are taken over runs
    of ``RUN`` pieces and over the runs' totals, never over all pieces at once.
    """
    def size(p: Column) -> Column:
        return p["before"] + p["len"]

    def place(run: Column, at: Column) -> Column:
        return let(_sums(F.transform(run, size)), lambda ends: F.transform(
            run, lambda p, j: F.struct(
                (at + F.get(ends, j) + p["before"]).alias("start"), F.lit(order).alias("ord"),
                F.lit(kind.name).alias("kind"), (at + F.get(ends, j + 1)).alias("end"),
                p["v"].alias("value"))))

    def runs_of(p: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.greatest(F.size(p), F.lit(1)), F.lit(RUN)),
                           lambda i: F.slice(p, i, F.lit(RUN)))

    def place_all(runs: Column) -> Column:
        totals = F.transform(runs, lambda run: F.aggregate(
            run, F.lit(0), lambda n, p: n + size(p)))
        return let(_sums(totals), lambda ends: F.flatten(F.transform(
            runs, lambda run, i: place(run, F.get(ends, i)))))

    return let(pieces, lambda p: let(runs_of(p), place_all))


def spans_of(text: Column, kind: Kind, order: int) -> Column:
    """All spans of one kind as an array of structs (start, ord, kind, end, value)."""
    between = F.split(text, kind.pattern, -1)
    whole = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    value = whole if kind.value_group == 0 else F.regexp_extract_all(
        text, F.lit(kind.pattern), F.lit(kind.value_group))
    pieces = F.zip_with(whole, between, lambda m, b: F.struct(m.alias("m"), b.alias("b")))
    pieces = F.zip_with(F.slice(pieces, 1, F.size(whole)), value, lambda p, v: F.struct(
        F.char_length(p["b"]).alias("before"), F.char_length(p["m"]).alias("len"),
        v.alias("v")))
    ok = F.filter(_placed(pieces, kind, order), lambda s: F.char_length(s["value"]) >= kind.least)
    if kind.name == "mixed":
        ok = F.filter(ok, lambda s: _mixed_ok(s["value"]))
    none = F.array().cast("array<struct<start:int,ord:int,kind:string,end:int,value:string>>")
    return F.when(text.rlike(kind.pattern), ok).otherwise(none)


def _joined(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def ownership(candidates: DataFrame) -> DataFrame:
    """Distinct repositories and owners of every candidate hash.

    Input: (vhash, repo, owner) rows.  Groups shrink before each shuffle, so a
    value in a third of all rows costs one row per task, repository and owner.
    """
    pairs = candidates.groupBy("vhash", "repo", "owner").agg(F.count(F.lit(1)).alias("n"))
    return pairs.groupBy("vhash").agg(
        F.countDistinct(F.struct("repo")).alias("n_repos"),
        F.countDistinct(F.struct("owner")).alias("n_owners"),
        F.sum("n").alias("n_seen"))


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 repo_col: str | None = None, owner_col: str = "source",
                 max_owners: int = MAX_OWNERS, max_repos: int = MAX_REPOS) -> DataFrame:
    """Spans of every row with their class.

    ``repo_col`` names the repository (default: every document is one).  A value is live
    up to ``max_repos`` distinct repositories and ``max_owners`` distinct owners.
    Returns id, ``spans``: array of structs (start, ord, kind, end, value_hash,
    n_repos, n_owners, live) by start and kind order.
    """
    require(docs, id_col, text_col, owner_col)
    text = F.coalesce(F.col("_text"), F.lit(""))
    source = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"),
                         F.col(repo_col or id_col).cast("string").alias("repo"),
                         F.col(owner_col).cast("string").alias("owner"))
    found = F.concat(*(spans_of(text, k, i) for i, k in enumerate(KINDS)))
    hashed = F.transform("_found", lambda s: F.struct(
        s["start"].alias("start"), s["ord"].alias("ord"), s["kind"].alias("kind"),
        s["end"].alias("end"), F.sha2(s["value"], 256).alias("vhash")))
    rows = stored(source.select("_id", "repo", "owner", found.alias("_found"))
                  .select(F.monotonically_increasing_id().alias("_row"), "_id", "repo",
                          "owner", hashed.alias("_found")), "secret-spans")
    each = rows.filter(F.size("_found") > 0).select(
        "_row", "repo", "owner", F.explode("_found").alias("s")).select(
        "_row", "repo", "owner", "s.*")
    counts = stored(ownership(each.select("vhash", "repo", "owner")), "secret-owners")
    judged = each.join(counts, "vhash").withColumn(
        "live", (F.col("n_repos") <= max_repos) & (F.col("n_owners") <= max_owners))
    kept = judged.filter(F.col("kind").isin(*BASE) | F.col("live"))
    per_row = kept.groupBy("_row").agg(F.array_sort(F.collect_list(F.struct(
        "start", "ord", "kind", "end", F.col("vhash").alias("value_hash"), "n_repos",
        "n_owners", "live"))).alias("spans"))
    none = F.array().cast(per_row.schema["spans"].dataType)
    return (rows.select("_row", "_id").join(per_row, "_row", "left")
            .select(F.col("_id").alias(id_col), F.coalesce("spans", none).alias("spans")))


def digest(scanned: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts per kind, hash of the base spans and all spans as text."""
    def count(name: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == name)).cast("long")

    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    return scanned.select(
        id_col, *(count(k).alias(f"n_{k}") for k in BASE),
        F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"),
        F.size(F.filter("spans", lambda s: s["live"])).cast("long").alias("n_live"),
        F.size(F.filter("spans", lambda s: ~s["live"])).cast("long").alias("n_copied"))
