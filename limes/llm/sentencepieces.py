"""Operator 1: SentencePiece BPE encoding by a merge-type prefix table, and decoding.

BPE merging gives every prefix of a text exactly one last token.  A token t that ends at position i is that token
if and only if it merges to itself and stands unmerged beside the last token of the prefix that t leaves (their pair
is *compatible*: merging the two strings together gives back the two tokens).  So one pass over the automaton's matches fills a
table of last tokens, and the ids are read backwards from the end; no priority queue runs over the text.

Texts fall into chunks at borders that no piece of the vocabulary crosses; equal chunks are encoded once per worker.
"""

from __future__ import annotations

import re
from functools import lru_cache

import ahocorasick
import numpy as np
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from limes.llm.common import map_batches, prepare

SPACE = "▁"
LETTERS = "A-Za-zÀ-ÖØ-öø-ɏͰ-ϿЀ-ӿ"
#: Chunks and token pairs that a worker remembers; beyond that it starts anew.
REMEMBERED = 500_000
NEVER = float("inf")


class Chunks(dict):
    """Chunk of text -> its ids as little-endian bytes; bounded."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, chunk: str) -> bytes:
        found = np.array(self.encode(chunk), dtype="<u4").tobytes()
        if len(chunk) <= 40:
            if len(self) >= REMEMBERED:
                self.clear()
            self[chunk] = found
        return found


class PrefixTable:
    """Encoder for a SentencePiece BPE model with identity normalisation and byte fallback."""

    def __init__(self, model: str):
        self.library = p = sentencepiece.SentencePieceProcessor(model_file=model)
        self.bos, self.eos = p.bos_id(), p.eos_id()
        self.pieces = {p.id_to_piece(i): i for i in range(p.get_piece_size()) if not (p.is_control(i) or p.is_unknown(i) or p.is_byte(i) or p.is_unused(i))}
        self.ranks = {s: -p.get_score(i) for s, i in self.pieces.items()}
        self.characters = {s for s in self.pieces if len(s) == 1}
        self.text_of = {i: s for s, i in self.pieces.items()}
        self.bytes = [p.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.automaton = ahocorasick.Automaton()
        for s, i in self.pieces.items():
            self.automaton.add_word(s, (len(s), i))
        self.automaton.make_automaton()
        bare = [s.lstrip(SPACE) for s in self.pieces]
        if any(SPACE in s for s in bare):
            self.split = lambda text: [text]
        elif any(re.search(f"[{LETTERS}][^{LETTERS}]|[^{LETTERS}][{LETTERS}]", s) for s in bare):
            self.split = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+").findall
        else:
            self.split = re.compile(f"{SPACE}*[{LETTERS}]+|{SPACE}*[^{LETTERS}{SPACE}]+|{SPACE}+").findall
        self.compatible: dict[tuple[int, int], bool] = {}
        self.chunks = Chunks(self.ids)

    def name(self, token: int) -> str:
        """Characters outside the vocabulary are tokens too: the code point's complement."""
        return self.text_of[token] if token >= 0 else chr(~token)

    def merged(self, text: str) -> list[int]:
        """Ids of a few characters by merging the best pair, leftmost first, again and again."""
        parts, rank = list(text), self.ranks.get
        pairs = [rank(a + b, NEVER) for a, b in zip(parts, parts[1:])]
        while pairs and (best := min(pairs)) < NEVER:
            k = pairs.index(best)
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
            del pairs[k]
            if k:
                pairs[k - 1] = rank(parts[k - 1] + parts[k], NEVER)
            if k < len(pairs):
                pairs[k] = rank(parts[k] + parts[k + 1], NEVER)
        return [self.pieces.get(s, ~ord(s[0])) for s in parts]

    def fits(self, before: int, token: int) -> bool:
        """Whether token stands unmerged after before (0: at the start)."""
        key = (before, token)
        found = self.compatible.get(key)
        if found is None:
            if len(self.compatible) >= REMEMBERED:
                self.compatible.clear()
            text = self.name(token)
            found = self.merged(text) == [token] if before == 0 else self.merged(self.name(before) + text) == [before, token]
            self.compatible[key] = found
        return found

    def last_tokens(self, text: str) -> tuple[list[int], list[int]]:
        """For each prefix of text: its last token, and that token's length."""
        last, size = [0] * (len(text) + 1), [0] * (len(text) + 1)
        if not self.characters.issuperset(text):
            for k, c in enumerate(text):
                if c not in self.characters:  # no piece, so a token of its own unless a longer piece holds it
                    last[k + 1] = ~ord(c)
        known, fits = self.compatible, self.fits
        for end, (length, token) in self.automaton.iter(text):
            end += 1
            if not size[end]:
                at = end - length
                before = last[at]
                if at and not size[at]:
                    self.alone(last, size, at)
                ok = known.get((before, token))
                if fits(before, token) if ok is None else ok:
                    last[end], size[end] = token, length
        self.alone(last, size, len(text))
        return last, size

    @staticmethod
    def alone(last: list[int], size: list[int], at: int) -> None:
        """Positions up to at that no match has filled end in a character that is no piece."""
        while at and not size[at]:
            size[at] = 1
            at -= 1

    def ids(self, chunk: str) -> list[int]:
        last, size = self.last_tokens(chunk)
        at, back = len(chunk), []
        while at:
            token = last[at]
            if token >= 0:
                back.append(token)
            else:
                back.extend(self.bytes[b] for b in reversed(chr(~token).encode()))
            at -= size[at]
        return back[::-1]

    def encode(self, text: str) -> bytes:
        """Begin id, the ids of the whole text, end id, as little-endian unsigned 32-bit integers."""
        inner = b"".join(map(self.chunks.__getitem__, self.split(SPACE + text.replace(" ", SPACE)))) if text else b""
        return b"".join((self.bos.to_bytes(4, "little"), inner, self.eos.to_bytes(4, "little")))


@lru_cache(maxsize=2)
def encoder(model: str) -> PrefixTable:
    return PrefixTable(model)


def encode_decode(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of docs: id, n_tokens, ids_le (the ids, little-endian unsigned 32 bit) and decoded.

    A null text is encoded as the empty one: begin and end id only.  Ids may be null or repeated: every row is encoded
    by itself, texts of any length whole.  Other columns, whatever their names, are left out; an empty table gives an empty result.  model is a path on every executor.
    """

    def run(rows: dict[str, list]) -> dict[str, object]:
        table = encoder(model)
        ids = [table.encode(t or "") for t in rows["text"]]
        decoded = []
        for x in range(0, len(ids), 64):
            decoded += table.library.decode([np.frombuffer(b, "<u4").tolist() for b in ids[x : x + 64]], num_threads=1)
        return {"n_tokens": [len(b) // 4 for b in ids], "ids_le": ids, "decoded": decoded}

    prepare(docs.sparkSession)
    source = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return map_batches(source, run, "n_tokens long, ids_le binary, decoded string", "id").withColumnRenamed("id", id_col)
