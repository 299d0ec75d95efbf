"""Encoding with a merge-type (byte-pair) SentencePiece model by backtracking, and decoding.

Such a model joins the adjacent pair whose union is the piece of the highest score,
the leftmost of equals, until no union is a piece. A row of pieces is the result for
its text exactly if each piece, and each two neighbours, come out unchanged when their
own text is merged: the first merge across a boundary would also be made if only the
two pieces beside it were there. Two rows of one text can't both be such a result, so a
search that goes back from the end of a word, tries the longest piece that ends there
first (an Aho-Corasick automaton finds it), then its shorter endings, checks each
against the piece behind it by merging the two anew, and turns back where nothing fits,
ends at the library's encoding. The row behind a position is the same on every way to
it, so a position from which nothing goes on is marked in a bitfield and not entered
again: the search is linear in the text.
"""

from __future__ import annotations

import re
from array import array
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from precis.llm.words import mapped

SPACE = "▁"
# Words of at most so many characters are remembered, up to twice so many of them, and so many pairs of pieces.
WORD_LENGTH = 40
CACHE_WORDS = 300_000
CACHE_PAIRS = 1_000_000
# A part of a batch ends when it has this many ids.
PART_IDS = 1 << 20


class PieceModel:
    """Pieces, scores and search of one model; raises ValueError if it isn't of the kind described above."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.processor = sp = SentencePieceProcessor(model_file=path)
        numbers = range(sp.get_piece_size())
        if any(sp.is_unused(i) for i in numbers) or not any(sp.is_byte(i) for i in numbers):
            raise ValueError("only models with byte fallback and without unused pieces")
        self._bytes = {int(sp.id_to_piece(i)[3:-1], 16): i for i in numbers if sp.is_byte(i)}
        special = {i for i in numbers if sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i)}
        self._ids = {sp.id_to_piece(i): i for i in numbers if i not in special}
        self._scores = {piece: sp.get_score(i) for piece, i in self._ids.items()}
        self.end = sp.eos_id()
        self._fit: dict[tuple[str, str], bool] = {}
        self._known: dict[str, tuple[int, ...]] = {}
        self._older: dict[str, tuple[int, ...]] = {}
        self._automaton = ahocorasick.Automaton()
        made = {piece for piece in self._ids if self.merged(piece) == [piece]}  # the merges never end at another
        for piece in made:
            if len(piece) > 1:  # a single character is tried anyway
                self._automaton.add_word(piece, piece)
        self._automaton.make_automaton()
        self._shorter: dict[str, str] = {}
        for piece in made:
            endings = (piece[i:] for i in range(1, len(piece)))
            if len(piece) > 1:
                self._shorter[piece] = next(x for x in endings if x in made or len(x) == 1)
        self._joined = {a + b for piece in self._ids for a, b in zip(piece, piece[1:], strict=False)}
        self._words = self._cutter()

    def _cutter(self) -> re.Pattern:
        """Cuts a text where no piece reaches across: before a space mark, and around characters that join no other."""
        longer = [p for p in self._ids if len(p) > 1]
        if any(SPACE in p.lstrip(SPACE) for p in longer):
            return re.compile(r".+", re.DOTALL)
        joining = set("".join(longer))
        alone = "".join(re.escape(c) for c in map(chr, range(128)) if c not in joining)
        return re.compile(f"{SPACE}*[^{SPACE}{alone}]+|{SPACE}+|[{alone}]")

    def merged(self, text: str) -> list[str]:
        """The pieces of a short text, by the merges themselves."""
        parts, score = list(text), self._scores.get
        while True:
            best, at = float("-inf"), -1
            for i in range(len(parts) - 1):
                found = score(parts[i] + parts[i + 1])
                if found is not None and found > best:
                    best, at = found, i
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def fits(self, left: str, right: str) -> bool:
        """Do two pieces stay as they are side by side?"""
        pair = (left, right)
        known = self._fit.get(pair)
        if known is None:
            if len(self._fit) >= CACHE_PAIRS:
                self._fit.clear()
            known = self._fit[pair] = self.merged(left + right) == [left, right]
        return known

    def split(self, word: str) -> list[str]:
        """The pieces of a word, single characters that are no piece among them."""
        # Matches with one end come longest first, and the last entry of a key stays.
        longest = dict(list(self._automaton.iter(word))[::-1])
        fit, shorter = self._fit.get, self._shorter.get
        failed, marked = bytearray(len(word) // 8 + 1), False
        out: list[str] = []
        end, after = len(word), None
        piece = longest.get(end - 1) or word[end - 1]
        while True:
            while piece is not None:
                start = end - len(piece)
                if not (marked and failed[start >> 3] >> (start & 7) & 1):
                    if after is None:
                        break
                    fits = fit((piece, after))
                    if self.fits(piece, after) if fits is None else fits:
                        break
                piece = shorter(piece)
            if piece is None:
                failed[end >> 3] |= 1 << (end & 7)
                marked = True
                end += len(after)
                piece = shorter(out.pop())
                after = out[-1] if out else None
                continue
            out.append(piece)
            if not start:
                return out[::-1]
            end, after = start, piece
            piece = longest.get(end - 1) or word[end - 1]

    def _word_ids(self, word: str) -> tuple[int, ...]:
        ids = self._older.get(word)
        if ids is None:
            if 1 < len(word) <= WORD_LENGTH and word[-2:] not in self._joined:  # no piece reaches across
                ids = self._ids_of(word[:-1]) + self._ids_of(word[-1])
            else:
                ids = tuple(chain.from_iterable(map(self._piece_ids, self.split(word))))
        if len(word) <= WORD_LENGTH:
            if len(self._known) >= CACHE_WORDS:
                self._older, self._known = self._known, {}
            self._known[word] = ids
        return ids

    def _ids_of(self, word: str) -> tuple[int, ...]:
        ids = self._known.get(word)
        return self._word_ids(word) if ids is None else ids

    def _piece_ids(self, piece: str) -> tuple[int, ...]:
        number = self._ids.get(piece)
        return tuple(self._bytes[b] for b in piece.encode()) if number is None else (number,)

    def encode(self, text: str) -> list[int]:
        words = self._words.findall(self.processor.normalize(text))
        known = list(map(self._known.get, words))
        if None in known:
            known = [self._word_ids(w) if ids is None else ids for w, ids in zip(words, known, strict=True)]
        return list(chain.from_iterable(known))

    def decode(self, ids: list[int]) -> str:
        return self.processor.decode(ids)


_models: dict[str, PieceModel] = {}


def model(path: str) -> PieceModel:
    if path not in _models:
        _models[path] = PieceModel(path)
    return _models[path]


def encoded(df: DataFrame, key: str, text: str, path: str, add_end: bool = True, decode: bool = False) -> DataFrame:
    """``(key, ids)`` of every row: the ids that the sentencepiece library gives the whole text, without sampling.

    ``path`` is a model file that every worker can read. With ``add_end`` the end id
    follows; with ``decode`` a column ``decoded`` holds the text that the ids give back.
    A null text is empty: no id but the end, and an empty text back. Rows are handled
    one by one, so null or repeated keys, repeated rows and an empty table stay as they
    are, and other columns don't matter. No shuffle; a worker holds one batch, the
    model, and bounded numbers of known words and pairs of pieces.
    """
    kind = df.schema[key].dataType.simpleString()
    schema = f"key {kind}, ids array<int>" + ", decoded string" * decode

    def run(batch):
        pieces = model(path)
        flat, offsets, texts, first = array("i"), [0], [], 0
        for i, value in enumerate(batch.column(1)):
            ids = pieces.encode(value.as_py() or "")
            if add_end:
                ids.append(pieces.end)
            flat.extend(ids)
            offsets.append(len(flat))
            if decode:
                texts.append(pieces.decode(ids))
            if len(flat) >= PART_IDS or i == batch.num_rows - 1:
                arrays = [
                    batch.column(0).slice(first, i + 1 - first),
                    pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.frombuffer(flat, np.int32))),
                ]
                names = ["key", "ids"]
                if decode:
                    arrays.append(pa.array(texts, pa.string()))
                    names.append("decoded")
                yield pa.RecordBatch.from_arrays(arrays, names=names)
                flat, offsets, texts, first = array("i"), [0], [], i + 1

    return mapped(df.select(F.col(key).alias("key"), F.col(text).alias("text")), run, schema)


def decoded(df: DataFrame, key: str, ids: str, path: str) -> DataFrame:
    """``(key, text)``: the text of every row of ids. A null row gives a null text, an empty one an empty text.

    A null id in a row, or one that the model lacks, is an error, as in the library.
    """
    kind = df.schema[key].dataType.simpleString()

    def run(batch):
        pieces = model(path)
        texts = [None if x is None else pieces.decode(x) for x in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["key", "text"])

    return mapped(df.select(F.col(key).alias("key"), F.col(ids).alias("ids")), run, f"key {kind}, text string")
