"""SentencePiece (merge type) encoding and decoding by backtracking.

A text's encoding is the one token sequence in which every adjacent pair is
compatible: re-merging the two tokens' characters gives the same two tokens
again.  The search takes the longest match at each place (one Aho-Corasick
pass finds all matches), tries shorter ones where the pair is incompatible,
steps back where nothing fits, and marks the places it had to leave in a
bitfield so that none is tried twice.

A merge can only cross two characters that stand side by side in some piece.
Texts are cut where they do not: before every run of blanks, between
letters and punctuation, around digits and characters outside the vocabulary
(which become byte pieces), and in long runs between any two such characters.  The encodings of short segments are kept in a bounded cache.

Spark deals the rows; each task holds the vocabulary (a fixed table read from
the model file on the driver) and its cache, nothing else.

Defined cases: null is the empty text, which has no ids; texts of any length
are encoded whole; other input columns pass through.
"""

from __future__ import annotations

import hashlib
import re
import sys
from collections.abc import Iterator
from operator import add

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F, types as T

# Workers need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLANK = "▁"
# Segments, their parts and token pairs kept per generation of a worker's
# caches, and the longest segment kept: together about 200 MB.
CACHE_SEGMENTS = 200_000
CACHE_PARTS = 20_000
CACHE_PAIRS = 150_000
CACHE_CHARS = 48
# Texts are encoded, and their rows sent on, in pieces of about this many bytes.
PIECE_BYTES = 1 << 20


def model_path(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def read_model(path: str) -> list[tuple[str, float, str]]:
    """(piece, score, kind) by id; kind is 'byte', 'text' or 'other'."""
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    out = []
    for i in range(model.get_piece_size()):
        other = model.is_control(i) or model.is_unknown(i) or model.is_unused(i)
        kind = "byte" if model.is_byte(i) else "other" if other else "text"
        out.append((model.id_to_piece(i), model.get_score(i), kind))
    return out


class MergeTokenizer:
    """Encoder and decoder over one vocabulary."""

    def __init__(self, pieces: list[tuple[str, float, str]]):
        import ahocorasick
        self.pieces = [p for p, _, _ in pieces]
        self.kinds = [k for _, _, k in pieces]
        self.ids = {p: i for i, (p, _, k) in enumerate(pieces) if k == "text"}
        self.score = {p: s for p, s, k in pieces if k == "text"}
        self.byte_ids = {int(p[3:5], 16): i for i, (p, _, k) in enumerate(pieces) if k == "byte"}
        self.byte_values = {i: b for b, i in self.byte_ids.items()}
        self.unknown = next(i for i, (_, _, k) in enumerate(pieces) if k == "other")
        self.chars = {p for p in self.ids if len(p) == 1}
        self.matches = ahocorasick.Automaton()
        for p in self.ids:
            self.matches.add_word(p, (self.ids[p], len(p) - 1))
        self.matches.make_automaton()
        self.lengths = [len(p) for p in self.pieces]
        # the next option at a place: the longest piece that begins a piece, or -1
        self.shorter = [next((self.ids[p[:n]] for n in range(len(p) - 1, 0, -1) if p[:n] in self.ids), -1)
                        for p in self.pieces]
        self.said = [p.replace(BLANK, " ") if k == "text" else "" for p, _, k in pieces]
        self.side_by_side = {a + b for p in self.ids for a, b in zip(p, p[1:])}
        # runs of characters that pieces link with one another, and every other
        # character by itself; all with the blanks before them, if a piece may hold both
        shapes = [f"{BLANK}*[{re.escape(''.join(sorted(group)))}]+" for group in self.groups()]
        single = "".join(sorted(b for a, b in self.side_by_side if a == BLANK != b))
        shapes += [f"{BLANK}*[{re.escape(single)}]"] if single else []
        self.runs = re.compile("|".join([*shapes, f"{BLANK}+", "."]), re.DOTALL)
        self.numbers = [str(i) for i in range(len(self.pieces))]
        self.stable: dict[int, bool] = {}  # by piece, at most one entry for each
        self.fits: dict[int, bool] = {}
        self.older_fits: dict[int, bool] = {}
        self.split = re.compile(" +[^ ]*")

    def groups(self) -> list[set[str]]:
        """Characters reachable from one another by standing side by side in pieces; those always alone are left out.

        Blanks count for nothing here: they only begin a segment.
        """
        group = {c: {c} for c in self.chars if c != BLANK}
        for a, b in sorted(self.side_by_side):
            if a in group and b in group and group[a] is not group[b]:
                small, large = sorted((group[a], group[b]), key=len)
                large |= small
                group.update(dict.fromkeys(small, large))
        found = {id(g): g for c, g in group.items() if len(g) > 1 or c + c in self.side_by_side}
        return sorted(found.values(), key=lambda g: (-len(g), min(g)))

    def merge(self, text: str) -> list[str]:
        """Plain merging: the best-scored adjacent pair first, leftmost on a tie."""
        parts, score = list(text), self.score.get
        worst = float("-inf")
        gains = [score(a + b, worst) for a, b in zip(parts, parts[1:])]
        while gains:
            best = max(gains)
            if best == worst:
                break
            at = gains.index(best)
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
            del gains[at]
            if at < len(gains):
                gains[at] = score(parts[at] + parts[at + 1], worst)
            if at:
                gains[at - 1] = score(parts[at - 1] + parts[at], worst)
        return parts

    def compatible(self, left: int, right: int) -> bool:
        """Whether two tokens stay as they are when their characters are merged again; kept under ``fits``."""
        key = left * len(self.pieces) + right
        known = self.older_fits.get(key)
        if known is None:
            pair = [self.pieces[left], self.pieces[right]]
            known = self.merge("".join(pair)) == pair
        if len(self.fits) >= CACHE_PAIRS:
            self.older_fits = dict(self.fits)
            self.fits.clear()
        self.fits[key] = known
        return known

    def merges(self, token: int) -> bool:
        """Whether a token's characters merge to the token itself; kept under ``stable``."""
        known = self.stable[token] = self.merge(self.pieces[token]) == [self.pieces[token]]
        return known

    def path(self, text: str) -> list[int]:
        """Ids of a text whose characters are all in the vocabulary."""
        size, count, lengths, shorter = len(text), len(self.pieces), self.lengths, self.shorter
        longest = [0] * size
        for end, (i, n) in self.matches.iter(text):  # by end, so the longest match from a place comes last
            longest[end - n] = i
        fits, stable = self.fits.get, self.stable.get
        failed = None  # a bit for every place, once one has failed
        out: list[int] = []
        at, last, token = 0, -1, longest[0]
        while True:
            while token >= 0:
                end = at + lengths[token]
                if failed is None or not failed[end >> 3] >> (end & 7) & 1:
                    # a first token must be what its own characters merge to
                    known = fits(last * count + token) if at else stable(token)
                    if known is None:
                        known = self.compatible(last, token) if at else self.merges(token)
                    if known:
                        break
                token = shorter[token]
            if token >= 0:
                out.append(token)
                if end == size:
                    return out
                at, last = end, token
                token = longest[at]
            else:
                if failed is None:
                    failed = bytearray(size // 8 + 1)
                failed[at >> 3] |= 1 << (at & 7)
                left = out.pop()
                at -= lengths[left]
                last = out[-1] if out else -1
                token = shorter[left]

    def tokens(self, text: str) -> list[str]:
        return [self.pieces[i] for i in self.path(text)]

    def segment(self, text: str) -> list[int]:
        """Ids of one segment without a place where it can be cut, or of one outside character."""
        if text[0] in self.chars:
            return self.path(text)
        return [self.byte_ids.get(b, self.unknown) for b in text.encode("utf-8", "surrogatepass")]

    def cuts(self, text: str) -> list[str]:
        """The text cut around the characters outside ``runs``, and its long runs between any two that never meet."""
        parts = self.runs.findall(text)
        if len(text) <= CACHE_CHARS:
            return parts
        return [p for part in parts for p in (self.cuts_between(part) if len(part) > CACHE_CHARS else [part])]

    def cuts_between(self, text: str) -> list[str]:
        """The text cut between characters that no piece holds side by side."""
        side = self.side_by_side
        places = [i for i, pair in enumerate(map(add, text, text[1:]), 1) if pair not in side]
        if not places:
            return [text]
        return [text[a:b] for a, b in zip([0, *places], [*places, len(text)])]

    def segments(self, text: str) -> list[str]:
        """The text cut before every run of blanks; each less its first blank."""
        text = text.replace(BLANK, " ")
        if text and "  " not in text and text[0] != " " and text[-1] != " ":
            return text.split(" ")
        return [s[1:] for s in self.split.findall(" " + text)] if text else []

    def encode(self, text: str | None) -> list[int]:
        out: list[int] = []
        for s in self.segments(text or ""):
            for part in self.cuts(BLANK + s.replace(" ", BLANK)):
                out += self.segment(part)
        return out

    def spell(self, ids: list[int]) -> str:
        """The ids' text, blanks marked as spaces, with the leading blank kept."""
        said, values = self.said, self.byte_values
        if values.keys().isdisjoint(ids):
            return "".join([said[i] for i in ids])
        raw = bytearray()
        for i in ids:
            if i in values:
                raw.append(values[i])
            else:
                raw += said[i].encode()
        return raw.decode("utf-8", "replace")

    def decode(self, ids: list[int]) -> str:
        text = self.spell(ids)
        return text[1:] if text[:1] == " " else text


class Generations(dict):
    """A bounded cache: when full, it becomes the old generation, which is asked on a miss."""

    def __init__(self, make, size: int):
        super().__init__()
        self.make, self.size, self.old = make, size, {}

    def known(self, segment: str):
        entry = self.get(segment)
        return self.old.get(segment) if entry is None else entry

    def keep(self, segment: str, entry) -> None:
        if len(segment) <= CACHE_CHARS:
            if len(self) >= self.size:
                self.old = dict(self)
                self.clear()
            self[segment] = entry

    def __missing__(self, segment: str):
        entry = self.old.get(segment)
        if entry is None:
            entry = self.make(segment)
        self.keep(segment, entry)
        return entry


class CachedTokenizer:
    """text -> ("1,2,3", decoded text), with short segments and their parts kept.

    An entry is the ids as text, or with the decoded text where that is not
    simply the segment's own.
    """

    def __init__(self, tokenizer: MergeTokenizer):
        self.tokenizer = tokenizer
        self.parts = Generations(self._part, CACHE_PARTS)
        self.whole = Generations(self._whole, CACHE_SEGMENTS)

    def _part(self, part: str) -> str | tuple[str, str]:
        tokenizer = self.tokenizer
        ids = tokenizer.segment(part)
        text = ",".join([tokenizer.numbers[i] for i in ids])
        if part[0] in tokenizer.chars:  # the pieces of a path spell it
            return text
        said = tokenizer.spell(ids)
        return text if said == part else (text, said)

    def _first(self, part: str) -> str | tuple[str, str]:
        """The word before its punctuation, which is a segment of its own elsewhere."""
        word = part[1:]
        if BLANK in word:
            return self._part(part)
        entry = self.whole.known(word)
        if entry is None:
            entry = self._part(part)
            self.whole.keep(word, entry)
        return entry

    def _whole(self, segment: str) -> str | tuple[str, str]:
        parts = self.tokenizer.cuts(BLANK + segment.replace(" ", BLANK))
        if len(parts) == 1:
            return self._part(parts[0])
        entries = [self._first(parts[0]), *[self.parts[p] for p in parts[1:]]]
        try:
            return ",".join(entries)
        except TypeError:  # some part does not decode to itself
            pairs = [(e, p.replace(BLANK, " ")) if isinstance(e, str) else e for e, p in zip(entries, parts)]
        return ",".join([p[0] for p in pairs]), "".join([p[1] for p in pairs])

    def both(self, text: str | None) -> tuple[str, str]:
        whole = self.whole
        segments = self.tokenizer.segments(text or "")
        entries = [whole[s] for s in segments]
        try:
            return ",".join(entries), " ".join(segments)
        except TypeError:  # some segment does not decode to itself
            pairs = [(e, " " + s) if isinstance(e, str) else e for e, s in zip(entries, segments)]
        decoded = "".join([p[1] for p in pairs])
        return ",".join([p[0] for p in pairs]), decoded[1:] if decoded[:1] == " " else decoded


def _tokenizer(shared: dict) -> CachedTokenizer:
    """Built once a worker process: Spark keeps a broadcast value between tasks."""
    if "tokenizer" not in shared:
        shared["tokenizer"] = CachedTokenizer(MergeTokenizer(shared["pieces"]))
    return shared["tokenizer"]


def small_pieces(batch: pa.RecordBatch, text_at: int) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in pieces whose texts hold about PIECE_BYTES; a longer text is one of its own."""
    first, size = 0, 0
    for row, n in enumerate(pc.binary_length(batch.column(text_at)).to_pylist()):
        size += n or 0
        if size >= PIECE_BYTES:
            yield batch.slice(first, row + 1 - first)
            first, size = row + 1, 0
    if first < batch.num_rows:
        yield batch.slice(first)


def encode_texts(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``docs`` plus ``ids`` (comma-joined decimal ids) and ``decoded``."""
    return _with_tokens(docs, path, {"ids": T.StringType(), "decoded": T.StringType()},
                        lambda ids, decoded: (ids, decoded))


def token_digest(docs: DataFrame, path: str | None = None) -> DataFrame:
    """The contract's columns: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    def digest(ids: str, decoded: str):
        count = ids.count(",") + 1 if ids else 0
        return (count, hashlib.sha256(ids.encode()).hexdigest(),
                hashlib.sha256(decoded.encode("utf-8", "surrogatepass")).hexdigest())

    out = _with_tokens(docs.select("doc_id", "text"), path,
                       {"n_tokens": T.LongType(), "ids_sha256": T.StringType(), "decoded_sha256": T.StringType()},
                       digest)
    return out.drop("text")


def _with_tokens(docs: DataFrame, path: str | None, columns: dict[str, T.DataType], make) -> DataFrame:
    spark = docs.sparkSession
    vocabulary = spark.sparkContext.broadcast({"pieces": read_model(path or model_path())})
    taken = [f for f in docs.schema.fields if f.name.lower() not in columns]
    arrow = {T.LongType(): pa.int64(), T.StringType(): pa.string()}
    schema = T.StructType([*taken, *[T.StructField(n, t) for n, t in columns.items()]])
    text_at = [f.name for f in taken].index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = _tokenizer(vocabulary.value)
        for batch in batches:
            for piece in small_pieces(batch, text_at):
                rows = [make(*cache.both(t.as_py())) for t in piece.column(text_at)]
                made = [pa.array([r[k] for r in rows], arrow[t]) for k, t in enumerate(columns.values())]
                yield pa.RecordBatch.from_arrays([*piece.columns, *made], names=[f.name for f in schema.fields])

    return docs.select(*[F.col(f.name) for f in taken]).mapInArrow(run, schema)
