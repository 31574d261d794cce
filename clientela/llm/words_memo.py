"""Token ids of many texts from the ids of their distinct words."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from clientela.llm.text import bytes_of, coded, sums, words

#: Strings to the number of ids of each, and the ids of all one after the other.
Encode = Callable[[list[str]], tuple[np.ndarray, np.ndarray]]

MEMO_STRINGS = 400_000
#: Longer strings are encoded where they stand and not remembered.
MEMO_CHARS = 64
#: Characters that end many words. No apostrophe: with letters it is a piece of its own.
TAIL = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
#: Largest UTF-8 byte of characters below U+0240: there, letters are letters to every library
#: and lower case has one exception, the dotted capital I.
PLAIN_BYTE = 0xC8
DOTTED = "İ"
LETTERS = r"^\p{L}+"


def id_lists(length: np.ndarray, ids: np.ndarray) -> pa.LargeListArray:
    """Lists of these lengths, cut from the ids one after the other."""
    return pa.LargeListArray.from_arrays(
        np.concatenate(([0], np.cumsum(length, dtype=np.int64))), pa.array(ids, pa.uint32())
    )


class Memo:
    """Ids of the strings that were encoded last, a bounded number of them."""

    def __init__(self, encode: Encode, size: int = MEMO_STRINGS):
        self.encode, self.size = encode, size
        self.strings = pa.array([], pa.large_string())
        self.lists = id_lists(np.empty(0, np.int64), np.empty(0, np.uint32))

    def ids(self, distinct: pa.Array) -> pa.LargeListArray:
        """The ids of each string. Only what is not remembered is encoded."""
        at = pc.index_in(distinct, value_set=self.strings).fill_null(-1)
        at = at.to_numpy(zero_copy_only=False).astype(np.int64)
        missing = at < 0
        if missing.any():
            at[missing] = len(self.strings) + np.arange(missing.sum())
            fresh = distinct.filter(pa.array(missing))
            made = id_lists(*self.encode(fresh.to_pylist()))
            self.strings = pa.concat_arrays([self.strings, fresh])
            self.lists = pa.concat_arrays([self.lists, made])
        found = self.lists.take(pa.array(at))
        if missing.any():
            self._shrink()
        return found

    def _shrink(self) -> None:
        short = pc.less_equal(pc.utf8_length(self.strings), MEMO_CHARS)
        if not pc.all(short).as_py():
            self.strings, self.lists = self.strings.filter(short), self.lists.filter(short)
        if len(self.strings) > self.size:
            self.strings = self.strings.slice(len(self.strings) - self.size // 2)
            self.lists = self.lists.slice(len(self.lists) - self.size // 2)


class WordMemo:
    """Ids of words for a tokenizer that lowers case and cuts letters from what is no letter.

    A word of letters with punctuation behind is put together from the ids of its
    letters in lower case and of its tail, so that far fewer strings are encoded.
    """

    def __init__(self, letters: Encode, other: Encode):
        self.letters, self.other = Memo(letters), Memo(other)

    def ids(self, distinct: pa.Array) -> pa.LargeListArray:
        """The ids of each word."""
        stems = pc.utf8_rtrim(distinct, TAIL)
        sizes = pc.binary_length(stems).to_numpy(zero_copy_only=False)
        data, offsets = bytes_of(stems)
        full = sizes > 0
        plain = np.zeros(len(distinct), np.bool_)
        plain[full] = np.maximum.reduceat(data, offsets[:-1][full]) <= PLAIN_BYTE
        plain &= pc.utf8_is_alpha(stems).to_numpy(zero_copy_only=False)
        plain &= ~pc.match_substring(stems, DOTTED).to_numpy(zero_copy_only=False)
        stem_of, kinds = coded(pc.utf8_lower(stems.filter(pa.array(plain))))
        ids = self.letters.ids(kinds)
        # What is no plain stem: tails of plain ones, and other words whole. "" has no ids.
        cut = pc.binary_length(distinct).to_numpy(zero_copy_only=False) > sizes
        tailed = np.flatnonzero(~plain | cut)
        rest = distinct.take(pa.array(tailed))
        behind = pc.replace_substring_regex(rest, LETTERS, "")
        tail_of, tails = coded(pc.if_else(pa.array(plain[tailed]), behind, rest))
        more = self.other.ids(tails)
        nothing = id_lists(np.zeros(1, np.int64), np.empty(0, np.uint32))
        pieces = pa.concat_arrays([nothing, ids, more])
        first = np.zeros(len(distinct), np.int64)
        second = np.zeros(len(distinct), np.int64)
        first[plain] = 1 + stem_of
        second[tailed] = 1 + len(ids) + tail_of
        both = pieces.take(pa.array(np.stack((first, second), axis=1).ravel()))
        length = pc.list_value_length(both).to_numpy(zero_copy_only=False)
        return id_lists(length.reshape(-1, 2).sum(1), both.flatten().to_numpy())


def token_ids(texts: pa.Array, memo: WordMemo) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts one after the other, and where each text's ids start and end.

    Right for tokenizers that never join characters across the six ASCII white
    space characters and drop these.
    """
    flat, offsets = words(texts)
    codes, distinct = coded(flat)
    lists = memo.ids(distinct)
    length = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    tokens = lists.take(pa.array(codes)).flatten().to_numpy()
    ends = np.cumsum(sums(length[codes], offsets))
    return tokens, np.concatenate(([0], ends)).astype(np.int64)
