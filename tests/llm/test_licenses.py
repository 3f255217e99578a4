from mortar.llm.licenses import BASE, NOTICES, license_digest, license_spans

from .conftest import words


def brute(rows):
    out = []
    for d, t in rows:
        w, starts, labels = words(t), [], set()
        for phrase, label in BASE.items():
            p = phrase.split()
            for i in range(len(w)):
                if w[i:i + len(p)] == p:
                    starts.append(i)
                    labels.add(label)
        out.append((d, len(w), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels))))
    return sorted(out, key=str)


def got(df):
    return sorted([tuple(r)[:6] for r in license_digest(df).collect()], key=str)


def test_edges_and_whole_table_against_brute_force(docs_of, sf0001_docs):
    texts = [None, "", "...", "mit", "MIT License", "mit mit license license", "gnu general public", "CC-BY cc by CC BY",
             "GNU general, public license; gnu General Public License\napache license", "é mit licensé",
             "apache " * 5000 + "license", "cc " * 3 + "by " * 3]
    rows = [*enumerate(texts), (4, "MIT License"), (4, "other"), (None, "cc by")]
    df = docs_of([t for _, t in rows], [i for i, _ in rows])
    assert got(df) == brute(rows)
    assert got(docs_of([])) == []
    assert got(sf0001_docs) == brute([(r.doc_id, r.text) for r in sf0001_docs.collect()])


def test_notices_with_small_changes(docs_of):
    notices = list(NOTICES)
    changed = notices[0].split()
    del changed[7]
    changed.insert(15, "really")
    df = docs_of([f"Intro. {notices[0]}!", "x y " + " ".join(changed), " ".join(notices[1].split()[:8]), "plain words only"])
    out = {r.doc_id: r for r in license_digest(df).collect()}
    assert out[0].labels == "mit-notice" and out[0].score == 1.0
    assert out[1].labels == "mit-notice" and 0.6 <= out[1].score < 1.0
    assert "notice" not in out[2].labels and out[3].labels == "" and out[3].score == 0.0
    span = [r for r in license_spans(df).collect() if r.doc_id == 0][0]
    assert (span.first_word, span.last_word) == (1, len(notices[0].split()))


def test_stray_votes_do_not_hide_a_notice(docs_of):
    notice = "this work is licensed under a creative commons attribution"
    stray = " creative commons attribution" * 12
    df = docs_of([notice + stray, "so creative commons attribution" + stray, notice + stray + " " + notice])
    out = {r.doc_id: r for r in license_digest(df).collect()}
    assert out[0].labels == "cc-notice" and out[0].score == 1.0 and out[1].labels == ""
    found = sorted((r.doc_id, r.first_word, r.last_word) for r in license_spans(df).collect())
    assert found == [(0, 0, 8), (2, 0, 8), (2, 45, 53)]
