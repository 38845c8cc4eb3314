"""A piece vocabulary read from a SentencePiece file, as an Aho-Corasick automaton.

The file's pieces and scores are read as a unigram model: a text's segmentation is the one
with the highest sum of scores. Characters that no single-character piece covers cost
``unknown`` and become their UTF-8 bytes. Sums are exact: the scores of the public file
are whole numbers, and doubles hold them without rounding.
"""

from __future__ import annotations

import re
from functools import lru_cache

import ahocorasick
import sentencepiece

SPACE = "▁"
#: Below the lowest score; the public tokenizer library uses the same distance.
UNKNOWN_PENALTY = 10.0
#: Units a worker remembers; the memory is emptied when it is full.
REMEMBERED = 500_000
#: Units up to this length are remembered.
SHORT = 64
LOWEST = float("-inf")


class Vocabulary:
    def __init__(self, model: bytes):
        file = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.pieces = [file.id_to_piece(i) for i in range(file.get_piece_size())]
        self.byte_ids = {}
        self.plain = {}
        lowest = 0.0
        for i, piece in enumerate(self.pieces):
            if file.is_byte(i):
                self.byte_ids[int(piece[3:5], 16)] = i
            elif not (file.is_control(i) or file.is_unknown(i) or file.is_unused(i)):
                self.plain[piece] = (file.get_score(i), i)
                lowest = min(lowest, file.get_score(i))
        self.byte_values = {i: b for b, i in self.byte_ids.items()}
        self.unknown = lowest - UNKNOWN_PENALTY
        self.unk_id = file.unk_id()
        self.automaton = ahocorasick.Automaton()
        for piece, (score, i) in self.plain.items():
            self.automaton.add_word(piece, (len(piece), score, i))
        self.automaton.make_automaton()
        self.singles = {p for p in self.plain if len(p) == 1}
        self.longest = max(map(len, self.plain))
        self.unit = self._unit()

    def _unit(self) -> re.Pattern:
        """Cuts a text where no piece can cross, so that every path passes the cut."""
        inner = any(SPACE in p.lstrip(SPACE) for p in self.plain)
        line = any("\n" in p and len(p) > 1 for p in self.plain)
        if inner or line:
            return re.compile(r"(?s).+")
        return re.compile(f"{SPACE}+[^{SPACE}\n]*|[^{SPACE}\n]+|\n")

    def units(self, text: str) -> list[str]:
        """The marked text in units; a leading space mark is added, as the file asks."""
        return self.unit.findall(SPACE + text.replace(" ", SPACE)) if text else []

    def fallback(self, char: str) -> tuple[int, ...]:
        """Ids of a character that no piece covers."""
        if not self.byte_ids:
            return (self.unk_id,)
        return tuple(self.byte_ids[b] for b in char.encode())


@lru_cache(2)
def vocabulary(model: bytes) -> Vocabulary:
    return Vocabulary(model)


def read_model(path: str) -> bytes:
    """The file as bytes; the driver reads it once and tasks carry it."""
    with open(path, "rb") as file:
        return file.read()


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")
