"""Token ids of whole texts, with a memo of the pieces between single spaces and line feeds.

Both vocabularies split a text into pre-tokens before any merge, and no pre-token
reaches across a single space or line feed that stands between two other characters.
So the ids of a text are the joined ids of its pieces, and pieces repeat far more often
than texts do. Texts with any other run of white space go to the tokenizer whole.
"""

from __future__ import annotations

import array
import os
import re
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

WHITE_RUN = re.compile(r"\s[ \n]|[ \n]\s")
RUNS = ("  ", " \n", "\n ", "\n\n")
#: White space other than space and line feed; only texts with some of it need the slower search for runs.
OTHER_SPACES = [c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n"]
#: A memo's generation in pieces. Two generations are held, of pieces seen twice, at about 140 bytes each: with the words some 130 MB a worker.
MEMO_PIECES = 400_000
#: Pre-tokens held below the pieces.
MEMO_WORDS = 200_000
#: Pieces whose spans are held.
SPAN_PIECES = 200_000
MEMO_CHARS = 64
#: Slots (a byte each) that tell whether a piece was seen before; a power of two.
SEEN_SLOTS = 1 << 20
TOKEN_BYTES = 4


def byte_bpe_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def word_bpe_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def load_tokenizer(path: str):
    """One ``tokenizers`` object; a worker has one core, so its thread pool stays off."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


if array.array("I").itemsize != TOKEN_BYTES or sys.byteorder != "little":
    raise RuntimeError("ids are packed by arrays, which need a little-endian platform with a 32-bit unsigned int")


def pack_ids(ids: list[int]) -> bytes:
    """Little-endian unsigned 32-bit integers."""
    return array.array("I", ids).tobytes()


# A word of Latin letters, whose case and composition are the same everywhere, and then marks.
# Such a piece has exactly two pre-tokens, so the model can be asked for them directly.
PLAIN_PIECE = re.compile("(\n?)([A-Za-zÀ-ÖØ-öø-įı-ſ]+)([.,;:!?]*)")


def byte_letters() -> dict[int, str]:
    """The printable letter that byte-level vocabularies use for each byte: itself, or the next from 256 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(256, 512))
    return {b: chr(b if b in plain else next(others)) for b in range(256)}


class Memo(dict):
    """Packed ids by piece.

    A piece is held from its second time on, since most are seen only once. When a generation is
    full the one before it is dropped; a piece of the older one that is used again moves on.
    """

    def __init__(self, encode: Callable[[str], bytes], older: dict[str, bytes] | None = None):
        super().__init__()
        self.encode, self.older, self.seen = encode, older or {}, bytearray(SEEN_SLOTS)

    def __missing__(self, piece: str) -> bytes:
        if (found := self.older.get(piece)) is None:
            found = self.encode(piece)
            slot = hash(piece) & SEEN_SLOTS - 1
            if not self.seen[slot]:
                self.seen[slot] = 1
                return found
            if len(piece) > MEMO_CHARS:
                return found
        self[piece] = found
        return found

    def aged(self) -> Memo:
        """The memo to go on with."""
        if len(self) <= MEMO_PIECES:
            return self
        self.older = {}
        return Memo(self.encode, self)


def has_run(text: str) -> bool:
    """Whether white space stands next to a space or line feed."""
    return any(r in text for r in RUNS) or any(c in text for c in OTHER_SPACES) and bool(WHITE_RUN.search(text))


class PieceEncoder:
    """Encodes texts to packed ids."""

    def __init__(self, path: str):
        self.tokenizer = load_tokenizer(path)
        self.tokenize = self.tokenizer.model.tokenize
        self.memo = Memo(self._alone)
        self.words: tuple[dict[str, bytes], dict[str, bytes]] = ({}, {})
        self.keeps_space = bool(self._ids("a b") != self._ids("a  b"))
        self.lowers = self._ids("A") == self._ids("a")
        letters = byte_letters()
        self.letters = {chr(b): x for b, x in letters.items()}
        self.space = letters[0x20]
        self.feed = pack_ids(self._ids("\n")) if self.keeps_space else b""

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _pieces(self, text: str) -> list[str] | None:
        if not self.keeps_space:
            return text.replace("\n", " ").split(" ")
        if has_run(text) or text[:1].isspace():
            return None
        return ("\n" + text).replace("\n", " \n").split(" ")[1:]

    def _pre_token(self, text: str, spaced: bool) -> bytes:
        """Ids of one pre-token; ``spaced``: a space leads it."""
        held = self.words[spaced]
        if (found := held.get(text)) is None:
            if len(held) >= MEMO_WORDS:
                held.clear()
            spelt = text if text.isascii() else "".join(map(self.letters.__getitem__, text.encode().decode("latin-1")))
            found = held[text] = pack_ids([x.id for x in self.tokenize(self.space + spelt if spaced else spelt)])
        return found

    def _alone(self, piece: str) -> bytes:
        if piece.isascii() and piece.isalpha():
            return self._pre_token(piece.lower() if self.lowers else piece, self.keeps_space)
        if plain := PLAIN_PIECE.fullmatch(piece):
            feed, word, marks = plain.groups()
            if self.lowers:
                word = word.lower()
            packed = self._pre_token(word, self.keeps_space and not feed)
            if marks:
                packed += self._pre_token(marks, False)
            return self.feed + packed if feed else packed
        lead = "" if not self.keeps_space or piece[:1] == "\n" else " "
        return pack_ids(self._ids(lead + piece))

    def encode(self, texts: list[str]) -> list[bytes]:
        out = []
        for text in texts:
            pieces = self._pieces(text)
            if pieces is None:
                out.append(pack_ids(self._ids(text)))
                continue
            out.append(b"".join(map(self.memo.__getitem__, pieces))[len(self.feed) :])
            self.memo = self.memo.aged()
        return out


class SpanEncoder:
    """Character spans of the tokens of texts, put together from the spans inside their pieces.

    A memo gives each piece a row in tables of its length, its number of tokens and their spans.
    """

    def __init__(self, coder: PieceEncoder):
        self.coder = coder
        self.tokenizer = coder.tokenizer
        self.skipped = len(coder.feed) // TOKEN_BYTES
        self._forget()

    def _forget(self) -> None:
        self.rows: dict[str, int] = {}
        self.lengths, self.counts, self.spans = array.array("q"), array.array("q"), array.array("i")

    def _whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).offsets, np.int64).reshape(-1, 2)

    def _row(self, piece: str) -> int:
        spaced = self.coder.keeps_space and piece[:1] != "\n"
        written = " " + piece if spaced else piece
        if self.coder.keeps_space and piece.isascii() and (plain := PLAIN_PIECE.fullmatch(piece)) and not plain[1]:
            # the model's own spans count bytes of its spelling, which has two for the space and one for any other character
            tokenize, at = self.tokenizer.model.tokenize, 1 + len(plain[2])
            found = [(max(0, x.offsets[0] - 1), x.offsets[1] - 1) for x in tokenize(self.coder.space + plain[2])]
            if plain[3]:
                found += [(at + x.offsets[0], at + x.offsets[1]) for x in tokenize(plain[3])]
        else:
            found = self.tokenizer.encode(written, add_special_tokens=False).offsets
        for a, b in found:
            self.spans.append(a)
            self.spans.append(b)
        self.counts.append(len(found))
        # without kept spaces the separator after a piece is counted with it
        self.lengths.append(len(written) if self.coder.keeps_space else len(piece) + 1)
        row = self.rows[piece] = len(self.counts) - 1
        return row

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """One array of rows ``start, end`` for each text, all of whose pieces are held at once."""
        if len(self.rows) > SPAN_PIECES:
            self._forget()
        wanted: list[list[int] | None] = []
        get = self.rows.get
        for text in texts:
            pieces = self.coder._pieces(text)
            if pieces is None:
                wanted.append(None)
                continue
            rows = list(map(get, pieces))
            if None in rows:
                rows = [self._row(p) if (r := get(p)) is None else r for p in pieces]
            wanted.append(rows)
        lengths, counts = np.frombuffer(self.lengths, np.int64), np.frombuffer(self.counts, np.int64)
        first, spans = np.cumsum(counts) - counts, np.frombuffer(self.spans, np.int32).reshape(-1, 2)
        out = []
        for text, rows in zip(texts, wanted, strict=True):
            if rows is None:
                out.append(self._whole(text))
                continue
            row = np.array(rows, np.int64)
            size, n = lengths[row], counts[row]
            starts = np.cumsum(size) - size - (1 if self.coder.keeps_space else 0)
            total = int(n.sum())
            at = np.repeat(first[row] - (np.cumsum(n) - n), n) + np.arange(total)
            out.append((spans[at] + np.repeat(starts, n)[:, None])[self.skipped :])
        return out


#: The encoder of this Python worker; another vocabulary takes its place, so that only one is in memory.
_ENCODERS: dict[str, PieceEncoder] = {}


def encoder(path: str) -> PieceEncoder:
    if path not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[path] = PieceEncoder(path)
    return _ENCODERS[path]


def in_blocks(batch: pa.RecordBatch, chars: int = 1_000_000) -> Iterator[list[tuple]]:
    """Consecutive rows ``(id, text)`` of a batch in lists of about ``chars`` characters; null texts are empty."""
    block, size = [], 0
    for doc, text in zip(batch["doc_id"], batch["text"], strict=True):
        block.append((doc.as_py(), text.as_py() or ""))
        size += len(block[-1][1])
        if size >= chars:
            yield block
            block, size = [], 0
    if block:
        yield block
