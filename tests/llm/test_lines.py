import collections
import hashlib

from mortar.llm.lines import dedup_lines, line_digest

from .conftest import lower

BLANKS = " \t\n\x0b\x0c\r"


def brute(rows, min_chars=40, min_docs=5):
    holders = collections.defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            key = lower(line).strip(BLANKS)
            if len(key) >= min_chars and i is not None:
                holders[key].add(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = []
        for line in lines:
            who = holders.get(lower(line).strip(BLANKS), ())
            if len(who) < min_docs or i == max(who):
                kept.append(line)
        out.append((i, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


def got(df, **p):
    return sorted([tuple(r) for r in line_digest(df, **p).collect()], key=str)


SHARED = "This line is shared by very many documents, ÉÀ and all."
OTHER = "Another line that only four of the documents hold at all."


def cases():
    texts = [None, "", "\n", SHARED, f"a\n  {SHARED.upper().replace('É', 'É')}\t\nb", f"{SHARED}\n{SHARED}\n", f"x\n{SHARED}\r",
             f"{OTHER}\n{SHARED}", f"{OTHER}", f"{OTHER}", f"{OTHER}\nq", "short\nshort", " \t" * 30,
             "\n".join([SHARED] * 300 + [f"line number {i} of a very long text, quite long" for i in range(3000)])]
    return list(enumerate(texts))


def test_edges_against_brute_force(spark, docs_of):
    rows = cases() + [(4, cases()[4][1]), (None, SHARED), (3, "another text of document 3\n" + SHARED)]
    df = docs_of([t for _, t in rows], [i for i, _ in rows])
    assert got(df) == brute(rows)


def test_whole_table_against_brute_force(sf0001_docs):
    rows = [(r.doc_id, r.text) for r in sf0001_docs.collect()]
    assert got(sf0001_docs) == brute(rows)
    assert got(sf0001_docs, min_chars=5, min_docs=2) == brute(rows, 5, 2)


def test_hot_line_in_a_third_of_all_rows(docs_of):
    rows = [(i, f"own line of document {i} which is long enough to count\n" + (SHARED if i % 3 == 0 else "z"))
            for i in range(600)]
    assert got(docs_of([t for _, t in rows])) == brute(rows)


def test_empty_table_and_clashing_names(spark, docs_of):
    assert got(docs_of([])) == []
    df = docs_of([SHARED] * 6).selectExpr("*", "1 AS n_lines", "'k' AS keeper", "2 AS h", "3 AS _row_x", "4 AS pos")
    out = dedup_lines(df)
    assert set(out.columns) == {*df.columns, "n_dropped"}
    assert sorted((r.doc_id, r.text, r.keeper, r.n_lines) for r in out.collect()) == [
        *[(i, "", "k", 1) for i in range(5)], (5, SHARED, "k", 1)]
