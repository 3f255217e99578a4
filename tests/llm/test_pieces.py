import hashlib
import random

import pyarrow as pa
import pytest
import sentencepiece

import mortar.llm.pieces as pieces
from mortar.llm.pieces import CachedTokenizer, MergeTokenizer, encode_texts, model_path, read_model, token_digest

EDGES = ["", " ", "  a  b ", "\ta\n b", "a▁b", "é́ ﬁ Ａ", "\x00x", "🤖 hi", "a\xa0b", "<s> </s> <unk>", "\n\n\n   x", "<0x41>",
         " " * 50 + "hello" + " " * 37, "a" * 3000, "ab" * 500, "▁", "▁▁x", "x" + "日本語の" * 50, "word " * 20_000]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=model_path())


@pytest.fixture(scope="module")
def tokenizer():
    return MergeTokenizer(read_model(model_path()))


def test_same_ids_as_the_library(library, tokenizer):
    made = random.Random(1)
    letters = list("abcdeorthn  \n") + ["é", "ü", "▁", "日", "🤖", "0", "<", "\t", "=", "-"]
    pieces = [p for p in tokenizer.ids if len(p) > 1]
    texts = EDGES + ["".join(made.choice(letters) for _ in range(made.randint(1, 60))) for _ in range(1500)]
    texts += ["".join(made.choice(pieces) for _ in range(made.randint(1, 25))).replace("▁", " ") for _ in range(1500)]
    cached = CachedTokenizer(tokenizer)
    for text in texts:
        ids = library.encode(text)
        assert tokenizer.encode(text) == ids, text
        assert tokenizer.decode(ids) == library.decode(ids)
        assert cached.both(text) == (",".join(map(str, ids)), library.decode(ids))


def test_backtracking_equals_plain_merging(tokenizer):
    made = random.Random(2)
    for _ in range(800):
        text = "▁" + "".join(made.choice("abcdehilnorstu") for _ in range(made.randint(1, 24)))
        assert tokenizer.tokens(text) == tokenizer.merge(text)


def test_query_and_operator(library, docs_of, sf0001_docs):
    rows = [*enumerate([None, *EDGES]), *[(1000 + r.doc_id, r.text) for r in sf0001_docs.collect()]]
    df = docs_of([t for _, t in rows], [i for i, _ in rows])
    want = {}
    for i, t in rows:
        ids = library.encode(t or "")
        want[i] = (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                   hashlib.sha256(library.decode(ids).encode()).hexdigest())
    assert {r.doc_id: tuple(r)[1:] for r in token_digest(df).collect()} == want
    assert token_digest(docs_of([])).count() == 0
    out = encode_texts(docs_of(["a b", None]).selectExpr("*", "5 AS ids"))
    assert {r.doc_id: (r.ids, r.decoded, r.lang) for r in out.collect()} == {
        0: (",".join(map(str, library.encode("a b"))), "a b", "en"), 1: ("", "", "en")}


def test_rows_are_encoded_in_small_pieces(docs_of, monkeypatch):
    monkeypatch.setattr(pieces, "PIECE_BYTES", 10)
    texts = ["abcd", None, "", "ééé", "x" * 50, "y", "z" * 9, "w", None]
    batch = pa.RecordBatch.from_arrays([pa.array(range(9)), pa.array(texts)], names=["doc_id", "text"])
    parts = [p.to_pydict() for p in pieces.small_pieces(batch, 1)]
    assert [p["doc_id"] for p in parts] == [[0, 1, 2, 3], [4], [5, 6], [7, 8]]
    assert [t for p in parts for t in p["text"]] == texts
    out = encode_texts(docs_of(texts).coalesce(1)).collect()
    assert [(r.doc_id, r.text, r.decoded) for r in out] == [(i, t, t or "") for i, t in enumerate(texts)]


def test_cut_at_groups_of_characters(library, tokenizer):
    made = random.Random(3)
    for _ in range(1500):
        text = "".join(made.choice(["the", "qzx", "─", "ГДЕж", "據据数", "и", "5", "№", "£", " ", "  ", "▁", ",", '."', "…", "🤖", "\n",
                                    "é", "ß", "\r", "́"]) for _ in range(made.randint(1, 40)))
        assert tokenizer.encode(text) == library.encode(text), text
        assert CachedTokenizer(tokenizer).both(text)[1] == library.decode(library.encode(text))
    pieces = [p for p in tokenizer.ids if len(p) > 1 and "▁" not in p[1:]]  # no piece may be cut
    assert not [p for p in pieces if len(tokenizer.cuts(p)) > 1]
    for text in ["▁word,", "▁(word).", "▁▁x\ny", "▁12", "qz" * 40 + ",5"]:
        parts = tokenizer.cuts(text)
        assert "".join(parts) == text
        assert not {a[-1] + b[0] for a, b in zip(parts, parts[1:])} & tokenizer.side_by_side
    assert tokenizer.cuts("▁word,") == ["▁word", ","]
    assert tokenizer.cuts("▁12") == ["▁", "1", "2"]
    assert tokenizer.cuts("a──") == ["a", "──"]


def test_known_pairs_are_not_merged_or_looked_up_again(monkeypatch):
    tokenizer = MergeTokenizer(read_model(model_path()))
    made = random.Random(4)
    words = ["▁" + "".join(made.choice("abcdehilnorstu") for _ in range(12)) for _ in range(300)]
    first = [tokenizer.path(w) for w in words]
    assert False in tokenizer.fits.values()

    def asked(*_):
        raise AssertionError("a known pair was asked again")
    monkeypatch.setattr(tokenizer, "compatible", asked)
    monkeypatch.setattr(tokenizer, "merge", asked)
    assert [tokenizer.path(w) for w in words] == first


def test_full_caches(library, monkeypatch):
    for name in ("CACHE_PAIRS", "CACHE_PARTS", "CACHE_SEGMENTS"):
        monkeypatch.setattr(pieces, name, 3)
    cached = CachedTokenizer(MergeTokenizer(read_model(model_path())))
    made = random.Random(5)
    for _ in range(300):
        text = "".join(made.choice("abehnorst ,.\n5é🤖") for _ in range(made.randint(1, 40)))
        ids = library.encode(text)
        assert cached.both(text) == (",".join(map(str, ids)), library.decode(ids))
    assert len(cached.tokenizer.fits) <= 3 and len(cached.whole) <= 3 and len(cached.parts) <= 3


def test_entries_of_texts_that_decode_to_themselves_are_ids_alone(tokenizer):
    cached = CachedTokenizer(tokenizer)
    for text in ["word", "word,", "word.\nNext", "5🤖x", "(a"]:
        cached.both(text)
        assert isinstance(cached.whole[text], str), text
    assert all(isinstance(e, str) for e in cached.parts.values())
