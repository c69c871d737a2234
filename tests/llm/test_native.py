"""Secret scan, line dedup and sharding against plain Python."""

import hashlib
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from scenecast.llm import line_dedup, secrets, sharding
from scenecast.llm.queries import op2_secret_scan, op3_line_dedup, table
from tests.conftest import SF_MID, SF_SMALL
from tests.llm.conftest import LINE

SPACE = " \t\n\x0b\x0c\r"
ASSIGN = re.compile(r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?"
                    r"([A-Za-z0-9+/_.=-]+)")
ACCESS, HEX = re.compile(r"AKIA[A-Z0-9]+"), re.compile(r"[0-9a-f]+")


def base_spans(text):
    """Base spans by the rules, each kind on its own."""
    text = text or ""
    found = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text)
             if len(m.group(2)) >= 6]
    found += [(m.start(), 1, "access", m.end()) for m in ACCESS.finditer(text)
              if len(m.group()) >= 20]
    found += [(m.start(), 2, "hex", m.end()) for m in HEX.finditer(text) if len(m.group()) >= 24]
    return sorted(found)


def joined(spans):
    return ",".join(f"{k}:{a}:{b}" for a, _, k, b in spans)


def test_secret_query_against_plain_python(spark):
    texts = {r["doc_id"]: r["text"] for r in table(spark, SF_MID, "documents").collect()}
    rows = op2_secret_scan(spark, SF_MID).collect()
    assert len(rows) == len(texts) and any(r["n_hex"] for r in rows)
    for r in rows:
        want = base_spans(texts[r["doc_id"]])
        kinds = Counter(k for _, _, k, _ in want)
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == (
            kinds["assign"], kinds["access"], kinds["hex"])
        assert r["base_sha256"] == hashlib.sha256(joined(want).encode()).hexdigest()
        assert r["spans"] == joined(want) or "mixed" in r["spans"]


HARD = ["password: token: abcdef123", "token==abcdef", "API_KEY='x-1_2.3' apikey=\"longenough\"",
        "\U0001f600 Secret = \U0001f600 secret:abcdefg", "AKIAAKIA" + "0" * 20, "AKIA123",
        "x" * 30 + "deadbeef" * 3, "a" * 23, "a" * 24 + "g" + "b" * 50, "token=" + "a" * 40,
        "passwd=short password=longer1 token:longer2", None, "",
        "Zx9+" * 12 + " " + "abc " * 4000 + "secret=0123456789"]


def test_secret_edges(make_docs, empty_docs):
    docs = make_docs(list(enumerate(HARD)) + [(3, HARD[3])]).withColumn("spans", F.lit(1))
    rows = secrets.digest(secrets.scan_secrets(docs)).collect()
    assert len(rows) == len(HARD) + 1
    for r in rows:
        want = base_spans(HARD[r["doc_id"]])
        assert r["base_sha256"] == hashlib.sha256(joined(want).encode()).hexdigest()
    assert secrets.scan_secrets(empty_docs).count() == 0


@pytest.mark.parametrize("n", [secrets.RUN - 1, secrets.RUN, secrets.RUN + 1, 40_000])
def test_secret_text_with_very_many_matches(make_docs, n):
    """Work grows with the matches, not with their square (minutes before for 40,000)."""
    text = "\U0001f600é" + " ".join(f"token={i:08d} {i:030x} pad" for i in range(n))
    row = secrets.digest(secrets.scan_secrets(make_docs([(1, text)]))).first()
    want = base_spans(text)
    assert (row["n_assign"], row["n_hex"]) == (n, n)
    assert row["spans"] == joined(want)


def test_secret_ownership(spark):
    key, own = "Kx3" * 16, "Qy7" * 16
    rows = [(i, f"see {key} here", f"owner{i % 4}") for i in range(40)]
    rows += [(i, f"see {own} here", "owner1") for i in range(40, 45)] + [(50, f"see {own}", "owner1")]
    docs = spark.createDataFrame(rows + [(60, f"token={key}", None)],
                                 "doc_id long, text string, source string")
    got = {r["doc_id"]: r for r in secrets.scan_secrets(docs).collect()}
    assert got[1]["spans"] == []                              # a copied example adds no span
    assert [(s["kind"], s["live"], s["n_owners"], s["n_repos"]) for s in got[41]["spans"]] == [
        ("mixed", True, 1, 6)]
    assert [(s["kind"], s["live"], s["n_owners"]) for s in got[60]["spans"]] == [
        ("assign", False, 5)]                               # base spans stay


def test_repositories_and_owners_both_decide(spark):
    hot, two, few, many = "Hx3" * 16, "Tx4" * 16, "Fx5" * 16, "Mx6" * 16
    rows = [(i, f"see {hot}", "hot") for i in range(30)]              # copied within one owner
    rows += [(40 + i, f"see {two}", f"owner{i}") for i in range(2)]   # shared by two owners
    rows += [(50 + i, f"see {few}", "hot") for i in range(secrets.MAX_REPOS)]
    rows += [(70 + i, f"see {many}", f"owner{i}") for i in range(secrets.MAX_OWNERS + 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r["doc_id"]: [s["live"] for s in r["spans"]] for r in secrets.scan_secrets(docs).collect()}
    assert got[0] == [] and got[70] == []
    assert got[40] == got[41] == got[50] == [True]
    base = docs.withColumn("text", F.regexp_replace("text", "see ", "token="))
    flags = {r["doc_id"]: (r["n_live"], r["n_copied"])
             for r in secrets.digest(secrets.scan_secrets(base)).collect()}
    assert flags[0] == flags[70] == (0, 1) and flags[40] == flags[50]
    assert flags[40][0] >= 1 and flags[40][1] == 0


def kept_lines(rows, min_chars=20, min_docs=3):
    """Line rule by brute force: per row the lines to keep as booleans."""
    def key(line):
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(SPACE))
    holders = defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            holders[key(line)].add(i)
    out = []
    for i, t in rows:
        flags = []
        for line in (t or "").split("\n"):
            docs = holders[key(line)]
            last = max((d for d in docs if d is not None), default=None)
            flags.append(len(key(line)) < min_chars or len(docs) < min_docs or i == last)
        out.append(flags)
    return out


def runs(flags):
    """Run lengths, kept first."""
    out, want = [0], True
    for f in flags:
        if f != want:
            out.append(0)
            want = not want
        out[-1] += 1
    return out + ([0] if not want else [])


def test_line_dedup_against_brute_force(spark, odd_docs, odd_texts, empty_docs):
    flags = kept_lines(odd_texts)
    want = sorted((str(i), len(f), f.count(False), tuple(runs(f)))
                  for (i, _), f in zip(odd_texts, flags))
    extra = odd_docs.withColumn("pos", F.lit("x")).withColumn("h1", F.lit(0))
    got = sorted((str(r["doc_id"]), r["n_lines"], r["n_dropped"], tuple(r["keep_runs"]))
                 for r in line_dedup.line_dedup(extra).collect())
    assert got == want and any(w[2] for w in want)
    texts = Counter((str(i), "\n".join(x for x, k in zip((t or "").split("\n"), f) if k))
                    for (i, t), f in zip(odd_texts, flags))
    applied = line_dedup.apply_keep(extra)
    assert Counter((str(r["doc_id"]), r["text"]) for r in applied.collect()) == texts
    assert line_dedup.line_dedup(empty_docs).count() == 0
    rows = [(r["doc_id"], r["text"]) for r in table(spark, SF_SMALL, "documents").collect()]
    small = {r["doc_id"]: r for r in op3_line_dedup(spark, SF_SMALL).collect()}
    for (i, t), f in zip(rows, kept_lines(rows)):
        text = "\n".join(x for x, k in zip((t or "").split("\n"), f) if k)
        assert small[i]["kept_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_text_with_very_many_runs_of_lines(make_docs):
    """Bitmap and text of a document whose every second line is dropped."""
    n = 40_000
    lines = [[f"shared line with number {i}" if i % 2 == 0 else f"own {d} line {i}"
              for i in range(n)] for d in range(3)]
    docs = make_docs([(d, "\n".join(x)) for d, x in enumerate(lines)])
    got = {r["doc_id"]: r for r in line_dedup.line_dedup(docs).collect()}
    assert got[0]["keep_runs"] == runs([i % 2 == 1 for i in range(n)])
    assert got[0]["n_dropped"] == n // 2 and got[2]["keep_runs"] == [n]
    cut = {r["doc_id"]: r["text"] for r in line_dedup.apply_keep(docs).collect()}
    assert cut == {0: "\n".join(lines[0][1::2]), 1: "\n".join(lines[1][1::2]),
                   2: "\n".join(lines[2])}


def test_line_in_a_third_of_all_documents(make_docs):
    rows = [(i, f"{LINE}\nthe own line of document number {i}") if i % 3 == 0 else
            (i, f"the own line of document number {i}") for i in range(300)]
    got = {r["doc_id"]: r["n_dropped"] for r in line_dedup.line_dedup(make_docs(rows)).collect()}
    assert sum(got.values()) == 99 and got[297] == 0


def brute_shards(rows, limit):
    """Extendible hashing one row at a time: split the oversized bucket until it fits."""
    def bits(i):
        return bin(int("1" + hashlib.md5(str("" if i is None else i).encode()).hexdigest()[:15],
                       16))[3:]
    todo, out = [("", rows)], {}
    while todo:
        prefix, members = todo.pop()
        size = sum(len((t or "").encode()) for _, t in members)
        if size <= limit:
            for i, _ in members:
                out.setdefault(i, set()).add((prefix, size))
        elif len(prefix) < 60:
            for bit in "01":
                todo.append((prefix + bit, [m for m in members if bits(m[0])[len(prefix)] == bit]))
    return out


@pytest.mark.parametrize("limit", [400, 3_000, 10 ** 9])
def test_sharding_against_splitting(make_docs, limit):
    rows = [(i, "x" * (i * 37 % 211)) for i in range(250)] + [(None, "n"), (300, None)]
    got = sharding.extendible_shards(make_docs(rows).withColumn("shard", F.lit(1)), limit=limit)
    want = brute_shards(rows, limit)
    got = got.collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r["shard"], r["shard_bytes"]) in want[r["doc_id"]]
        assert r["depth"] == len(r["shard"]) and r["shard_bytes"] <= limit


def test_sharding_of_copies_and_giants(make_docs, empty_docs):
    rows = [(1, "y" * 100)] * 25 + [(2, "z" * 5_000)] + [(i, "w" * 10) for i in range(3, 40)]
    got = sharding.extendible_shards(make_docs(rows), limit=1_000).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(i for i, _ in rows)
    sizes = defaultdict(int)
    for r in got:
        sizes[r["shard"]] += r["n_bytes"]
    assert all(s <= 1_000 for k, s in sizes.items() if s != 5_000)
    assert {r["shard_bytes"] for r in got if r["doc_id"] == 2} == {5_000}
    assert all(sizes[r["shard"]] == r["shard_bytes"] for r in got)
    assert sharding.extendible_shards(empty_docs).count() == 0


def test_first_occurrences_stream_from_sorted_ranges(spark, make_docs):
    """Between the range shuffle and the per-key counts there is a sort, and no other shuffle."""
    docs = make_docs([(i, "a line that stands in all the documents\nown line of document %d" % i)
                      for i in range(30)])
    lines = line_dedup.line_hashes(docs, "doc_id", "text", 20)
    ranged = lines.repartitionByRange(4, "h1", "h2", "doc_id")
    shared = line_dedup.surviving_docs(ranged, 3)
    plan = shared._jdf.queryExecution().executedPlan().toString()
    order = [plan.index(n) for n in ("HashAggregate(keys=[h1", "Window [row_number", "Sort [h1",
                                     "rangepartitioning(h1")]
    assert order == sorted(order) and "pos" in plan[plan.index("Sort [h1"):].split("\n")[0]
    between = plan[plan.index("Window [row_number"):plan.index("rangepartitioning(h1")]
    assert between.count("Exchange") == 1           # the range shuffle itself
    assert [(r["n_docs"], r["keeper"]) for r in shared.collect()] == [(30, 29)]
