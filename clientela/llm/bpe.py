"""BPE by backtracking, with decoding from an offset table.

A tokenizer file of the word-end kind is read: NFC, white space runs to one
space, lower case, split into contractions, letter runs, single digits and runs
of other characters, then byte-level BPE whose last byte of a word is a symbol
of its own. Encoding does no merges. Tokens that start at each position come
from an Aho-Corasick automaton over the reversed word, longest first, and a
token may follow another if the pair is compatible, that is, if BPE of the two
strings put together gives these two tokens. A sequence all of whose pairs are
compatible is the result of the merges, so the encoder takes the longest
compatible token, tries the next shorter one at a dead end and steps back
otherwise; a position that led to a dead end is never entered again, which
makes it linear in the word.

Defined results: null text counts as the empty text and has no tokens; texts of
any length are encoded whole; repeated rows are encoded each; an empty table
gives an empty table; other columns of the input are not looked at.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Iterable, Iterator
from functools import cache, lru_cache
from math import inf

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from clientela.llm.text import slices
from clientela.llm.words_memo import WordMemo, token_ids

# The pattern and the white space of the tokenizer file, and its word end.
SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PIECE = rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{SPACE}\p{{L}}\p{{N}}]+"
WORD_END = "</w>"

PAIR_TABLE = 1_000_000
UNKNOWN_LETTER = "\u00a4"
# Characters that are letters or numbers to the regex module, but not to the
# tables of the tokenizer's library; and capitals whose lower case is younger than Python's.
YOUNG = (
    (0x0558, 0x0558), (0x058B, 0x058C), (0x088F, 0x088F), (0x0C5C, 0x0C5C), (0x0CDC, 0x0CDC),
    (0x208F, 0x208F), (0x209D, 0x209F), (0xA7CE, 0xA7CF), (0xA7D2, 0xA7D2), (0xA7D4, 0xA7D4),
    (0xA7DD, 0xA7DD), (0xA7E2, 0xA7E2), (0xA7F1, 0xA7F1), (0xAB6C, 0xAB6D), (0x107BB, 0x107BF),
    (0x10940, 0x10959), (0x10EC5, 0x10EC7), (0x10ED9, 0x10EEE), (0x11B0A, 0x11B0A),
    (0x11DB0, 0x11DDB), (0x11DE0, 0x11DE9), (0x11DF1, 0x11DF1), (0x1246F, 0x1246F),
    (0x12475, 0x1247F), (0x12550, 0x12686), (0x16EA0, 0x16EB8), (0x16EBB, 0x16ED3),
    (0x16FF2, 0x16FF6), (0x187F8, 0x187FF), (0x18CD6, 0x18CDA), (0x18D09, 0x18D20),
    (0x18D80, 0x18DF2), (0x18E00, 0x19191), (0x191A0, 0x191D2), (0x1B123, 0x1B128),
    (0x1B168, 0x1B168), (0x1D6A6, 0x1D6A6), (0x1DF1F, 0x1DF24), (0x1DF2B, 0x1DF81),
    (0x1DF90, 0x1DF96), (0x1DFCD, 0x1DFFF), (0x1E6C0, 0x1E6DE), (0x1E6E0, 0x1E6E2),
    (0x1E6E4, 0x1E6E5), (0x1E6E7, 0x1E6ED), (0x1E6F0, 0x1E6F4), (0x1E6FE, 0x1E6FF),
    (0x2B73A, 0x2B73F), (0x2B81E, 0x2B81E), (0x2CEA2, 0x2CEAD), (0x323B0, 0x33479),
    (0x3D000, 0x3FC3F),
)
YOUNG_LOWER = {0x1C89: 0x1C8A, 0xA7CB: 0x0264, 0xA7CC: 0xA7CD, 0xA7DA: 0xA7DB, 0xA7DC: 0x019B}
YOUNG_LOWER |= {0xA7CE: 0xA7CF, 0xA7D2: 0xA7D3, 0xA7D4: 0xA7D5}
YOUNG_LOWER |= {0x10D50 + k: 0x10D70 + k for k in range(22)}
YOUNG_LOWER |= {0x16EA0 + k: 0x16EBB + k for k in range(25)}


def byte_letters() -> list[str]:
    """The letter that stands for each byte: itself if printable, else one from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    letter = {b: chr(b) for b in shown} | {b: chr(0x100 + n) for n, b in enumerate(hidden)}
    return [letter[b] for b in range(256)]


@cache
def _young_letters() -> dict[int, str]:
    return {c: UNKNOWN_LETTER for low, high in YOUNG for c in range(low, high + 1)}


class Bpe:
    """Encoder and decoder of one tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        if model.get("end_of_word_suffix") != WORD_END or model.get("byte_fallback"):
            raise ValueError("only byte-level BPE with word ends is supported")
        vocab: dict[str, int] = model["vocab"]
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.vocab, self.added = vocab, added
        self.piece = regex.compile(PIECE)
        self.split_added = regex.compile(
            "(" + "|".join(regex.escape(t) for t in sorted(added, key=len, reverse=True)) + ")"
        ) if added else None
        self._read_merges(vocab, [tuple(m) for m in model["merges"]])
        self._build_automaton()
        self.pairs: dict[tuple[int, int], bool] = {}
        strings = {i: t for t, i in vocab.items()} | {i: t for t, i in added.items()}
        # The offset table: strings one after the other, each with the space that decoding puts
        # behind it, and the offset of each.
        self.table = pa.array(
            [strings[i] + " " if i in strings else "" for i in range(max(strings) + 1)],
            pa.large_string(),
        )

    # Tables ---------------------------------------------------------------------------

    def _read_merges(self, vocab: dict[str, int], merges: list[tuple[str, str]]) -> None:
        """Symbols 0-255 are bytes inside a word, 256-511 bytes at its end, then the merges."""
        letters = byte_letters()
        self.token_id = [vocab[x] for x in letters] + [vocab[x + WORD_END] for x in letters]
        symbol = {x: b for b, x in enumerate(letters)}
        symbol |= {x + WORD_END: 256 + b for b, x in enumerate(letters)}
        self.spelled = [chr(k) for k in range(512)]
        self.left, self.right = list(range(512)), list(range(512))
        self.merge: dict[tuple[int, int], int] = {}
        for a, b in merges:
            x, y = symbol[a], symbol[b]
            made = len(self.spelled)
            if a + b in symbol or (x, y) in self.merge:
                raise ValueError("a token with two merges is not supported")
            # Components come before what is made of them: ranks rise in time.
            symbol[a + b] = self.merge[x, y] = made
            self.left.append(x)
            self.right.append(y)
            self.spelled.append(self.spelled[x] + self.spelled[y])
            self.token_id.append(vocab[a + b])

    def _spines(self, a: int, b: int) -> tuple[list[int], list[int]]:
        """Symbols at the border of a and b, from whole tokens to single bytes."""
        last, first = [a], [b]
        while last[-1] >= 512:
            last.append(self.right[last[-1]])
        while first[-1] >= 512:
            first.append(self.left[first[-1]])
        return last, first

    def _meet(self, a: int, b: int) -> bool:
        """No merge across the border comes before both a and b are made."""
        last, first = self._spines(a, b)
        i, j = len(last) - 1, len(first) - 1
        while i or j:
            ends_x = last[i - 1] if i else inf
            ends_y = first[j - 1] if j else inf
            across = self.merge.get((last[i], first[j]), inf)
            # Of equal merges the leftmost comes first, so a tie on the right is lost.
            if across < ends_x and across <= ends_y:
                return False
            if ends_x <= ends_y:
                i -= 1
            else:
                j -= 1
        return True

    def _build_automaton(self) -> None:
        """Automaton over reversed tokens; next shorter token with which each one begins."""
        total = len(self.spelled)
        made = [True] * total
        for k in range(512, total):
            a, b = self.left[k], self.right[k]
            made[k] = made[a] and made[b] and self._meet(a, b)
        known = {self.spelled[k]: k for k in range(total) if made[k]}
        self.automaton = ahocorasick.Automaton()
        for text, k in known.items():
            self.automaton.add_word(text[::-1], k)
        self.automaton.make_automaton()
        self.shorter = [-1] * total
        for text, k in known.items():
            self.shorter[k] = next(
                (known[text[:n]] for n in range(len(text) - 1, 0, -1) if text[:n] in known), -1
            )

    def compatible(self, a: int, b: int) -> bool:
        """The pair table, filled as pairs are met."""
        known = self.pairs.get((a, b))
        if known is None:
            if len(self.pairs) >= PAIR_TABLE:
                self.pairs.clear()
            known = self.pairs[a, b] = (a, b) not in self.merge and self._meet(a, b)
        return known

    # Encoding -------------------------------------------------------------------------

    def _symbols(self, word: str) -> list[int]:
        """Symbols of one word, whose bytes come as characters and whose last is a word end."""
        size = len(word)
        longest = [-1] * size
        for end, token in self.automaton.iter(word[::-1]):
            at = size - 1 - end
            if longest[at] < 0 or len(self.spelled[token]) > len(self.spelled[longest[at]]):
                longest[at] = token
        if len(self.spelled[longest[0]]) == size:
            return [longest[0]]
        dead = bytearray(size + 1)
        path: list[int] = []
        at, token = 0, longest[0]
        while True:
            while token >= 0:
                then = at + len(self.spelled[token])
                if not dead[then] and (not path or self.compatible(path[-1], token)):
                    break
                token = self.shorter[token]
            if token < 0:
                dead[at] = 1
                token = path.pop()
                at -= len(self.spelled[token])
                token = self.shorter[token]
                continue
            path.append(token)
            at = then
            if at == size:
                return path
            token = longest[at]

    def _piece_ids(self, piece: str) -> list[int]:
        raw = piece.encode("utf-8")
        word = raw[:-1].decode("latin-1") + chr(256 + raw[-1])
        return [self.token_id[k] for k in self._symbols(word)]

    def _plain_ids(self, text: str) -> list[int]:
        text = unicodedata.normalize("NFC", text)
        # Lower case character by character: no rule for a sigma at the end of a word.
        text = "".join(map(str.lower, text)) if "Σ" in text else text.lower()
        shown = text
        if not text.isascii() and not text.isprintable():  # as young characters are to Python
            text = text.translate(YOUNG_LOWER)
            shown = text.translate(_young_letters())
        return [
            i for m in self.piece.finditer(shown) for i in self._piece_ids(text[m.start() : m.end()])
        ]

    def encode(self, text: str) -> list[int]:
        if self.split_added is None or "<" not in text:
            return self._plain_ids(text)
        ids: list[int] = []
        for part in self.split_added.split(text):
            if part in self.added:
                ids.append(self.added[part])
            elif part:
                ids += self._plain_ids(part)
        return ids

    def encode_words(self, distinct: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Number of ids of each word, and the ids of all words one after the other."""
        found = [self.encode(word) for word in distinct]
        ids = np.fromiter((i for own in found for i in own), np.uint32)
        return np.fromiter(map(len, found), np.int64, len(found)), ids

    # Decoding -------------------------------------------------------------------------

    def decoded(self, ids: np.ndarray) -> tuple[memoryview, np.ndarray]:
        """Bytes of all ids one after the other, and the offset of each (one more at the end)."""
        taken = self.table.take(pa.array(ids))
        size = len(taken) + 1
        offsets = np.frombuffer(taken.buffers()[1], np.int64, size, taken.offset * 8)
        return memoryview(taken.buffers()[2] or b""), offsets

    def decode(self, ids: Iterable[int]) -> str:
        data, offsets = self.decoded(np.asarray(list(ids), np.int64))
        return bytes(data[offsets[0] : max(offsets[0], offsets[-1] - 1)]).decode("utf-8")


@lru_cache(maxsize=2)
def _loaded(path: str) -> tuple[Bpe, WordMemo]:
    bpe = Bpe(path)
    return bpe, WordMemo(bpe.encode_words, bpe.encode_words)


def encode_decode(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids (array of int) and the decoded text of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, memo = _loaded(path)
        for piece in slices(batches):
            ids, starts = token_ids(piece["text"], memo)
            data, at = bpe.decoded(ids)
            texts = [
                bytes(data[at[a] : max(at[a], at[b] - 1)]).decode("utf-8")
                for a, b in zip(starts[:-1], starts[1:], strict=True)
            ]
            lists = pa.ListArray.from_arrays(
                pa.array(starts.astype(np.int32)), pa.array(ids.astype(np.int32))
            )
            yield pa.RecordBatch.from_arrays(
                [piece["doc_id"], lists, pa.array(texts, pa.string())], ["doc_id", "ids", "decoded"]
            )

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, ids array<int>, decoded string"
    )


def round_trip_digests(docs: DataFrame, path: str) -> DataFrame:
    """Token count, sha-256 of the ids and sha-256 of the text decoded from them, for each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, memo = _loaded(path)
        for piece in slices(batches):
            ids, starts = token_ids(piece["text"], memo)
            raw = memoryview(ids.astype("<u4", copy=False)).cast("B")
            data, at = bpe.decoded(ids)
            encoded, decoded = [], []
            for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
                encoded.append(hashlib.sha256(raw[4 * a : 4 * b]).hexdigest())
                decoded.append(hashlib.sha256(data[at[a] : max(at[a], at[b] - 1)]).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [piece["doc_id"], pa.array(np.diff(starts)), pa.array(encoded), pa.array(decoded)],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
