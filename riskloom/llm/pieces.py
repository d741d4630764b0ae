"""SentencePiece BPE encoding and decoding by a table of each prefix's last token.

A piece sequence is the encoding of a text exactly when every two neighbours stay apart
under the merge rules. So each prefix of a text has one last token: the piece that ends
there and is compatible with the last token of the prefix before it. An automaton over
the pieces lists those that end at each place; the ids are then read backwards through
the table. Nothing is merged at encoding time and the work is linear in the text.

Edge cases: null and empty texts give no ids; characters that no piece holds become byte
pieces (or the unknown id); texts of any length are encoded whole; equal rows give equal
results; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import pairwise

import ahocorasick
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from riskloom.llm.common import slices, small_batches, text_rows, tidy

SPACE = "▁"
CACHED = 100_000  # words, parts of words, and pairs of pieces that a worker remembers, twice at most
LONGEST_CACHED = 40
ODD = "~"  # behind the ids of a word that they do not decode to


class Recent(dict):
    """A bounded dictionary: when it is full it becomes the old one, which is still asked."""

    def __init__(self, most: int):
        self.most, self.old = most, {}

    def __missing__(self, key):
        found = self.old.get(key)
        if found is not None:
            self.add(key, found)
        return found

    def add(self, key, value) -> None:
        if len(self) >= self.most:
            self.old = dict(self)
            self.clear()
        self[key] = value


class PieceModel:
    """Pieces, merge order, and the prefix-table encoder of one BPE model without normalisation."""

    def __init__(self, path: str):
        library = sentencepiece.SentencePieceProcessor(model_file=path)
        self.text = [library.id_to_piece(i) for i in range(library.vocab_size())]
        self.unknown = library.unk_id()
        self.byte_id: dict[int, int] = {}
        order = []
        for i, piece in enumerate(self.text):
            if library.is_byte(i):
                self.byte_id[int(piece[3:5], 16)] = i
            elif not (library.is_control(i) or library.is_unknown(i) or library.is_unused(i)):
                order.append((-library.get_score(i), i))
        order.sort()
        self.rank = {self.text[i]: k for k, (_, i) in enumerate(order)}
        self.id = {self.text[i]: i for _, i in order}
        self.byte_of = {i: b for b, i in self.byte_id.items()}
        self.automaton = ahocorasick.Automaton()
        for piece in self.rank:
            if self._merge(piece) == [piece]:  # others are never output
                self.automaton.add_word(piece, (self.id[piece], len(piece)))
        self.automaton.make_automaton()
        self.apart = Recent(CACHED)
        self.halves: dict[str, list[str]] = {}  # by piece
        # two characters that stand together in no piece are never merged
        self.pairs = {a + b for piece in self.rank for a, b in pairwise(piece)}
        # where no piece continues a word with a space, words can be encoded one by one
        whole = any(SPACE in piece.lstrip(SPACE) for piece in self.rank)
        self.words_of = re.compile(".+" if whole else self._units(), re.DOTALL).findall
        self.spelled = [str(i) for i in range(len(self.text))]
        self.length = [len(t) for t in self.text]
        self.ids_of = Recent(CACHED)  # by word, as text
        self.part_ids = Recent(CACHED)

    def _units(self) -> str:
        """Letters and other characters as units of their own, each with the spaces before it.
        Letters that some piece joins with another character count as other ones."""
        joined: set[str] = set()
        while True:
            kept = "".join(map(re.escape, sorted(joined)))
            letter = re.compile(f"[^\\W\\d_{kept}]")
            mixed = {a if letter.match(a) else b for a, b in self.pairs if bool(letter.match(a)) != bool(letter.match(b)) and a != SPACE}
            if not mixed:
                break
            joined |= mixed
        other = f"(?:(?!{SPACE})[\\W\\d_{kept}])+"
        return f"{SPACE}*(?:{letter.pattern}+|{other})|{SPACE}+"

    def _merge(self, text: str, until: int = 1) -> list[str]:
        """The plain merge loop over the characters of a short string, or all but its last steps."""
        parts, none = list(text), len(self.rank)
        while len(parts) > until:
            ranks = [self.rank.get(a + b, none) for a, b in zip(parts, parts[1:], strict=False)]
            best = min(ranks)
            if best == none:
                break
            k = ranks.index(best)
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
        return parts

    def compatible(self, left: int, right: int) -> bool:
        """Whether the two pieces stay apart when their texts stand together.

        The pieces' last merges are undone from the latest on. They would have grown together
        had the two parts that touch been merged before the merge that is undone next."""
        key = left * len(self.text) + right
        found = self.apart[key]
        if found is None:
            found = self._stay_apart(self.text[left], self.text[right])
            self.apart.add(key, found)
        return found

    def _halves(self, piece: str) -> list[str] | None:
        """The two parts whose merge gave a piece; None for a character."""
        if len(piece) == 1:
            return None
        found = self.halves.get(piece)
        if found is None:
            found = self.halves[piece] = self._merge(piece, until=2)
        return found

    def _stay_apart(self, a: str, b: str) -> bool:
        rank, halves = self.rank, self._halves
        before = len(rank)  # a merge across must have a smaller rank to come first
        while True:
            across = rank.get(a + b)
            if across is not None and across < before:
                return False
            at_a, at_b = rank[a] if len(a) > 1 else -1, rank[b] if len(b) > 1 else -1
            if at_a < 0 and at_b < 0:
                return True
            # of equal ranks the left merge comes first
            if at_a > at_b:
                before, a = at_a, halves(a)[1]
            else:
                before, b = at_b + 1, halves(b)[0]

    def _encode_run(self, run: str) -> list[int] | None:
        """Ids of a string from the table of last tokens; None if a character is no piece."""
        last = [-1] * (len(run) + 1)
        known, size, compatible = self.apart.get, len(self.text), self.compatible
        for end, (piece, length) in self.automaton.iter(run):
            end += 1
            if last[end] < 0:
                if end == length:
                    last[end] = piece
                elif (before := last[end - length]) >= 0:
                    apart = known(before * size + piece)
                    if compatible(before, piece) if apart is None else apart:
                        last[end] = piece
        ids, at, length = [], len(run), self.length
        while at:
            piece = last[at]
            if piece < 0:
                return None
            ids.append(piece)
            at -= length[piece]
        ids.reverse()
        return ids

    def _parts(self, word: str) -> Iterator[str]:
        """The word cut where no piece reaches across."""
        start = 0
        for k in range(1, len(word)):
            if word[k - 1 : k + 1] not in self.pairs:
                yield word[start:k]
                start = k
        yield word[start:]

    def _encode_by_parts(self, word: str) -> list[int]:
        """Ids of a word some of whose characters are no pieces."""
        ids: list[int] = []
        for part in self._parts(word):
            found = self.part_ids[part]
            if found is None:
                found = self._encode_run(part)
                if found is None:  # a character that is no piece
                    found = [self.byte_id[b] for b in part.encode("utf-8")] if self.byte_id else [self.unknown]
                if len(part) <= LONGEST_CACHED:
                    self.part_ids.add(part, found)
            ids += found
        return ids

    def _add_word(self, word: str) -> str:
        ids, mark = self._encode_run(word), ""
        if ids is None:
            ids = self._encode_by_parts(word)
            mark = ODD if self.decoded(ids) != word else ""
        found = ",".join([self.spelled[i] for i in ids]) + mark
        if len(word) <= LONGEST_CACHED:
            self.ids_of.add(word, found)
        return found

    def encode_text(self, text: str) -> tuple[str, str]:
        """The ids of a text, as text, and what they decode to."""
        if not text:
            return "", ""
        words = self.words_of(SPACE + text.replace(" ", SPACE))
        found = list(map(self.ids_of.__getitem__, words))
        if None in found:
            for k, ids in enumerate(found):
                if ids is None:
                    found[k] = self._add_word(words[k])
        joined = ",".join(found)
        if ODD not in joined:  # every word comes back, and the text with them
            return joined, text if SPACE not in text else text.replace(SPACE, " ")
        joined = joined.replace(ODD, "")
        return joined, self._shown(words, found).replace(SPACE, " ").removeprefix(" ")

    def _shown(self, words: list[str], found: list[str]) -> str:
        """What the ids of words decode to, word by word."""
        return "".join(
            self.decoded([int(i) for i in ids[:-1].split(",")]) if ids.endswith(ODD) else word
            for word, ids in zip(words, found, strict=True)
        )

    def encode(self, text: str) -> list[int]:
        ids = self.encode_text(text)[0]
        return list(map(int, ids.split(","))) if ids else []

    def decoded(self, ids: list[int]) -> str:
        """The text of the ids, with the marks for spaces."""
        if self.byte_of.keys().isdisjoint(ids):
            return "".join(map(self.text.__getitem__, ids))
        parts = (bytes((self.byte_of[i],)) if i in self.byte_of else self.text[i].encode() for i in ids)
        return b"".join(parts).decode("utf-8", errors="replace")

    def decode(self, ids: list[int]) -> str:
        return self.decoded(ids).replace(SPACE, " ").removeprefix(" ")


_models: dict[str, PieceModel] = {}


def piece_model(path: str) -> PieceModel:
    """The model of a file, built once in a Python worker."""
    if path not in _models:
        _models[path] = PieceModel(path)
    return _models[path]


def piece_ids(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, ids array<int>, decoded``: each text's ids and the text they decode to."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = piece_model(model_path)
        for batch in slices(batches):
            texts = batch.column("text").to_pylist()
            ids = [model.encode(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(ids, pa.list_(pa.int32())),
                    pa.array([model.decode(i) for i in ids], pa.string()),
                ],
                names=["doc_id", "ids", "decoded"],
            )

    small_batches(docs.sparkSession)
    return text_rows(docs, id_col, text_col).mapInArrow(tidy(encode), "doc_id long, ids array<int>, decoded string")


def piece_digests(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` by the same encoder, without moving the ids."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = piece_model(model_path)
        for batch in slices(batches):
            counts, ids_hash, text_hash = [], [], []
            for text in batch.column("text").to_pylist():
                ids, shown = model.encode_text(text)
                counts.append(ids.count(",") + 1 if ids else 0)
                ids_hash.append(_sha256(ids))
                text_hash.append(_sha256(shown))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(counts, pa.int64()),
                    pa.array(ids_hash, pa.string()),
                    pa.array(text_hash, pa.string()),
                ],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    small_batches(docs.sparkSession)
    return text_rows(docs, id_col, text_col).mapInArrow(
        tidy(digest), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )


def _sha256(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8")).hexdigest()
